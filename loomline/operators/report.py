"""Counts, rates and reconciliation of a job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def final_report(lines: DataFrame, records: DataFrame) -> DataFrame:
    """One row; COMPLETE only with a record for every line and no technical error."""
    total = F.lit(lines.count()).alias("total")
    by = lambda s: F.count_if(F.col("status") == s)
    r = records.agg(F.count(F.lit(1)).alias("completed"), by("INHERITED_R3").alias("inherited"), by("LOCAL_OK").alias("local_ok"), by("REVIEW").alias("review"), by("TECHNICAL_ERROR").alias("technical_errors"))
    out = r.withColumn("total", total)
    done = (F.col("completed") == F.col("total")) & (F.col("technical_errors") == 0)
    return out.select("total", "completed", (F.col("total") - F.col("completed")).alias("remaining"), "inherited", "local_ok", "review", "technical_errors", F.when(done, "COMPLETE").otherwise("COMPLETE_WITH_ERRORS").alias("status"))


def usage_totals(requests: DataFrame) -> DataFrame:
    """Sum of every usage counter by phase; repeated log rows count once."""
    once = requests.dropDuplicates(["request_id"])
    return once.select("phase", F.explode("usage").alias("counter", "n")).groupBy("phase", "counter").agg(F.sum("n").alias("total"))


def throughput(requests: DataFrame, remaining: int) -> DataFrame:
    """Lines a minute and the time left for ``remaining`` lines.
    Times under a millisecond count as one, times under a second of the whole as
    one second."""
    once = requests.dropDuplicates(["request_id"])
    s = F.greatest(F.lit(0.001), F.coalesce("elapsedSeconds", F.lit(0.0)))
    tokens = F.coalesce(F.get(F.array(F.col("usage")["completion_tokens"]), F.lit(0)), F.lit(0))
    per = once.agg(F.count(F.lit(1)).alias("requests"), F.sum("accepted").alias("accepted"), F.sum(s).alias("seconds"), F.sum(tokens).alias("tokens"))
    minutes = F.greatest(F.lit(1 / 60), F.col("seconds") / 60)
    per = per.withColumn("per_minute", F.col("accepted") / minutes).withColumn("tokens_per_second", F.when(F.col("tokens") > 0, F.col("tokens") / F.col("seconds")).otherwise(0.0))
    eta = F.col("remaining") / F.col("per_minute")
    hm = F.concat(F.floor(eta / 60).cast("string"), F.lit("h"), F.lpad(F.ceil(eta % 60).cast("string"), 2, "0"))
    return per.withColumn("remaining", F.lit(remaining).cast("bigint")).withColumn("eta", F.when(F.col("per_minute") > 0, hm))


def request_rates(requests: DataFrame) -> DataFrame:
    """Acceptance and speed by phase; repeated log rows count once."""
    once = requests.dropDuplicates(["request_id"])
    return once.groupBy("phase").agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("itemCount").alias("items"),
        F.sum("accepted").alias("accepted"),
        (F.sum("accepted") / F.sum("itemCount")).alias("acceptance"),
        F.count_if(F.col("parseError").isNotNull()).alias("parse_errors"),
        F.max("elapsedSeconds").alias("slowest"),
    )


def reconciliation(lines: DataFrame, records: DataFrame) -> DataFrame:
    """Per file: source lines = translated + fallback + blocked."""
    both = lines.select("file", "key").join(records.select("key", "status"), "key", "left")
    state = F.when(F.col("status").isNull(), "blocked").when(F.col("status") == "TECHNICAL_ERROR", "fallback").otherwise("translated")
    n = lambda s: F.count_if(F.col("s") == s)
    return both.withColumn("s", state).groupBy("file").agg(F.count(F.lit(1)).alias("source"), n("translated").alias("translated"), n("fallback").alias("fallback"), n("blocked").alias("blocked"))


def repeated_keys(lines: DataFrame) -> DataFrame:
    return lines.groupBy("key").agg(F.count(F.lit(1)).alias("lines")).filter("lines > 1")
