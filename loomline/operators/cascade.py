"""The cascade of attempts, and the safety gates over primary batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.operators.qa import accepted_status
from loomline.operators.running import running_sums

#: Attempts of a line in order: one in its batch, repairs, one in a small batch,
#: single ones.
REPAIRS, SINGLES = 2, 2
LAST = 1 + REPAIRS + 1 + SINGLES
# Error codes of unstructured responses, and of texts that a repair
# request must not show.
STRUCTURED = "^(?:INVALID_JSON:|JSON_ROOT_NOT_OBJECT$|MISSING_STRUCTURED_KEY$)"


def phase_of(attempt: Column) -> Column:
    return (
        F.when(attempt == 1, "PRIMARY")
        .when(attempt <= 1 + REPAIRS, "PRIMARY_REPAIR")
        .when(attempt == 2 + REPAIRS, "RECOVERY_SMALL_BATCH")
        .when(attempt <= LAST, "RECOVERY_SINGLE")
    )


def outcomes(attempts: DataFrame) -> DataFrame:
    """One row per key from attempts(key, attempt_no, ok, errors, warnings).

    The first good attempt wins; later ones are never made, so they don't count.
    A repaired or singly recovered line carries a warning for it.  A key with all
    attempts failed is a TECHNICAL_ERROR with the distinct errors of its single
    attempts; one with attempts left is PENDING.  Attempts beyond the last are
    ignored.  Everything is one aggregate by key of at most LAST rows.
    """
    a = attempts.filter((F.col("attempt_no") >= 1) & (F.col("attempt_no") <= LAST))
    row = F.struct("attempt_no", "ok", "errors", "warnings")
    per = a.groupBy("key").agg(F.array_sort(F.collect_list(row)).alias("a"), F.max("attempt_no").alias("made"))
    good = F.filter("a", lambda x: x.ok)
    per = per.withColumn("first", F.when(F.size(good) > 0, F.get(good, F.lit(0))))
    n = F.col("first.attempt_no")
    recovered = ((n > 1) & (n <= 1 + REPAIRS)) | (n > 2 + REPAIRS)
    warnings = F.array_distinct(F.concat(F.coalesce("first.warnings", F.array().cast("array<string>")), F.when(recovered, F.array(F.lit("RECOVERED_AFTER_QA_REJECTION"))).otherwise(F.array().cast("array<string>"))))
    singles = F.filter("a", lambda x: x.attempt_no > 2 + REPAIRS)
    errors = F.array_distinct(F.flatten(F.transform(singles, lambda x: x.errors)))
    errors = F.when(F.size(errors) == 0, F.array(F.lit("MODEL_RETRY_EXHAUSTED"))).otherwise(errors)
    won, lost = F.col("first").isNotNull(), F.col("made") >= LAST
    none = F.array().cast("array<string>")
    return per.select(
        "key",
        F.when(won, accepted_status(warnings)).when(lost, "TECHNICAL_ERROR").otherwise("PENDING").alias("status"),
        F.when(won, phase_of(n)).alias("phase"),
        F.when(won, F.when((n > 1) & (n <= 1 + REPAIRS), n).otherwise(1)).when(lost, SINGLES + 1).alias("attempts"),
        F.when(won, warnings).otherwise(none).alias("warnings"),
        F.when(~won & lost, errors).otherwise(none).alias("errors"),
    )


CONTAMINATED = "^(?:UNEXPECTED_CJK|UNCHANGED_ENGLISH|POSSIBLE_ENGLISH_LEAK|PROTECTED_TERM_MISSING:|UNRESTORED_MARKER|MODEL_META_LEAK|EMPTY|MISSING_STRUCTURED_KEY)"


def repair_projection(rows: DataFrame, *more: str) -> DataFrame:
    """What a repair request shows of (key, japanese, candidate, errors): Japanese
    not after a CJK error, no contaminated candidate, and the problems.  ``more``
    columns are kept."""
    cjk = F.array_contains("errors", "UNEXPECTED_CJK")
    bad = F.exists("errors", lambda e: e.rlike(CONTAMINATED))
    return rows.select(
        *more,
        "key",
        F.when(~cjk, F.coalesce("japanese", F.lit(""))).alias("japanese"),
        F.when(bad, "").otherwise(F.coalesce("candidate", F.lit(""))).alias("previous"),
        F.when(F.size("errors") == 0, F.array(F.lit("RETRANSLATE_REQUIRED"))).otherwise(F.col("errors")).alias("problems"),
        F.when(cjk, "ENGLISH_ONLY").alias("repair_source"),
    )


@dataclass(frozen=True)
class Limits:
    pilot_items: int = 100
    pilot_acceptance: float = 0.98
    structured_batches: int = 1
    batch_wide: int = 0
    unresolved_items: int = 2
    unresolved_rate: float = 0.01


COUNTERS = ["items", "accepted", "direct", "repaired", "unresolved", "raw_wide", "wide", "raw_structured_items", "raw_structured_batches", "structured_items", "structured_batches"]


def batch_results(requests: DataFrame, failures: DataFrame) -> DataFrame:
    """Results of primary batches from the request and failure logs.

    A batch is a PILOT or PRIMARY request; batches are numbered from 0 in the order
    of their request ids.  PRIMARY_REPAIR requests belong to the batch before them.
    Structured failures of a batch are its lines whose reasons say so; they count
    as unrecovered as far as lines of the batch stayed unresolved.  Repeated log
    rows count once.
    """
    once = requests.groupBy("request_id").agg(F.first("phase").alias("phase"), F.first("itemCount").alias("items"), F.first("accepted").alias("ok"))
    kinds = F.filter(F.map_values("reasons"), lambda r: F.exists(r, lambda e: e.rlike(STRUCTURED)))
    broken = failures.groupBy("request_id").agg(F.max(F.coalesce(F.size(kinds), F.lit(0))).alias("broken"))
    once = once.filter("phase in ('PILOT', 'PRIMARY', 'PRIMARY_REPAIR')").join(broken, "request_id", "left")
    main = F.col("phase") != "PRIMARY_REPAIR"
    numbered = running_sums(once.withColumn("is_batch", F.when(main, 1).otherwise(0)), "request_id", ["is_batch"])
    per = numbered.filter("run_is_batch > 0").groupBy((F.col("run_is_batch") - 1).alias("batch_id")).agg(
        F.sum(F.when(main, F.col("items"))).alias("items"),
        F.sum(F.when(main, F.col("ok"))).alias("direct"),
        F.sum(F.when(~main, F.col("ok")).otherwise(0)).alias("fixed"),
        F.sum(F.when(main, F.coalesce("broken", F.lit(0))).otherwise(0)).alias("raw_structured_items"),
    )
    per = per.withColumn("repaired", F.least("fixed", F.col("items") - F.col("direct")))
    per = per.withColumn("accepted", F.col("direct") + F.col("repaired")).withColumn("unresolved", F.col("items") - F.col("accepted"))
    per = per.withColumn("structured_items", F.least("raw_structured_items", "unresolved"))
    flag = lambda c: F.when(c, 1).otherwise(0).cast("bigint")
    return per.withColumns(
        {
            "raw_wide": flag((F.col("direct") == 0) & (F.col("items") > 0)),
            "wide": flag((F.col("accepted") == 0) & (F.col("items") > 0)),
            "raw_structured_batches": flag(F.col("raw_structured_items") > 0),
            "structured_batches": flag(F.col("structured_items") > 0),
        }
    ).select("batch_id", *[F.col(c).cast("bigint").alias(c) for c in COUNTERS])


def running_counters(batches: DataFrame) -> DataFrame:
    return running_sums(batches, "batch_id", COUNTERS)


def gates(counters: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Adds the gate that each batch would trip, the most urgent first."""
    more = F.col("batch_id") < F.lit(counters.agg(F.max("batch_id")).first()[0])
    c = F.col
    grown = more & (c("run_unresolved") > limits.unresolved_items)
    gate = (
        F.when(c("run_structured_batches") > limits.structured_batches, "STRUCTURED_OUTPUT_FAILURE")
        .when(c("run_wide") > limits.batch_wide, "UNRECOVERED_BATCH_WIDE_FAILURE")
        .when(grown & (c("run_items") < limits.pilot_items), "EARLY_RECOVERY_GROWTH")
        .when(grown & (c("run_items") >= limits.pilot_items) & (c("run_unresolved") / c("run_items") > limits.unresolved_rate), "UNRESOLVED_RATE_TOO_HIGH")
    )
    return counters.withColumn("gate", gate)


def pilot_batches(batches: DataFrame, pilot_items: int = 100) -> DataFrame:
    """The fewest leading batches (batch_id, items) that reach the pilot size."""
    run = running_sums(batches, "batch_id", ["items"])
    return run.filter(F.col("run_items") - F.col("items") < pilot_items)


def until_first_gate(gated: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The batches that a run makes: up to the first that trips a gate, and no more
    than the pilot if too few of its lines are accepted."""
    cut = gated.agg(F.min(F.when(F.col("gate").isNotNull(), F.col("batch_id")))).first()[0]
    pilot = pilot_batches(gated.select("batch_id", "items", "accepted"), limits.pilot_items)
    end, rate = pilot.agg(F.max("batch_id"), F.sum("accepted") / F.sum("items")).first()
    stops = [x for x in (cut, end if rate is not None and rate < limits.pilot_acceptance else None) if x is not None]
    return gated.filter(F.col("batch_id") <= min(stops)) if stops else gated


def pilot_verdict(batches: DataFrame, limits: Limits = Limits()) -> DataFrame:
    p = pilot_batches(batches.select("batch_id", "items", "accepted", "direct"), limits.pilot_items)
    rate = lambda c: F.sum(c) / F.sum("items")
    out = p.agg(F.count(F.lit(1)).alias("batches"), F.sum("items").alias("items"), rate("accepted").alias("acceptance"), rate("direct").alias("direct_rate"))
    return out.withColumn("verdict", F.when(F.col("acceptance") < limits.pilot_acceptance, "PILOT_ACCEPTANCE_TOO_LOW").otherwise("PASSED"))
