"""Resuming a job from its append-only logs.

All joins are by key; the line side has one row per key.  The newest record of a
line is found by an aggregate of a bigint, so a key with very many records is one
row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import compose, line_feeds, strip
from loomline.functions.tokens import keeps_source
from loomline.operators.qa import Glossary, checked
from loomline.operators.skew import many_to_one
from loomline.session import written


def line_index(job: DataFrame) -> DataFrame:
    """One line per key, the last in job order; lines without a key have none."""
    last = job.filter(F.col("key").isNotNull()).groupBy("key").agg(F.max("ord").alias("ord"))
    return job.join(last.select("ord"), "ord", "left_semi")


def latest_records(log: DataFrame, lines: DataFrame) -> DataFrame:
    """The newest log row of each key among those with the line's source hash.

    The hash filter comes before the choice: a stale row never hides a good one.
    """
    match = many_to_one(log.select("seq", "key", "sourceHash"), lines.select("key", "sourceHash"), ["key", "sourceHash"])
    return log.join(match.groupBy("key").agg(F.max("seq").alias("seq")).select("seq"), "seq", "left_semi")


def revalidated(log: DataFrame, lines: DataFrame, glossary: Glossary) -> DataFrame:
    """The newest record of each key with its route under the present rules.

    valid: accepted (an inherited text without a new check); requeued: has text
    that fails; failed: an empty technical error; none: other empty records.
    """
    new = compose(latest_records(log, lines).select("seq", "key", "vietnamese", "status", F.col("vietnamese").alias("composed")), "composed")
    both = new.join(compose(lines, "english", "japanese").select("key", "id", "english", "japanese"), "key")
    has = F.coalesce(F.col("vietnamese") != "", F.lit(False))
    trusted = has & F.col("status").eqNullSafe("INHERITED_R3")
    route = (
        F.when(trusted, "valid")
        .when(has & F.col("check.ok"), "valid")
        .when(has, "requeued")
        .when(F.col("status").eqNullSafe("TECHNICAL_ERROR"), "failed")
        .otherwise("none")
    )
    out = checked(both, glossary, candidate="composed").withColumn("route", route)
    return out.select("key", "seq", "status", "vietnamese", "composed", "route", "check")


def failure_backlog(failures: DataFrame, lines: DataFrame, valid: DataFrame) -> DataFrame:
    """Known keys of the failure log that have no valid record."""
    keys = failures.select(F.explode("keys").alias("key")).distinct()
    return keys.join(lines.select("key"), "key", "left_semi").join(valid.select("key"), "key", "left_anti")


class Resume:
    """Everything that a restarted run derives from job, log and failure log."""

    def __init__(self, job: DataFrame, log: DataFrame, failures: DataFrame, glossary: Glossary):
        self.job, self.glossary = job, glossary
        self.lines = line_index(job)
        self.routes = written(revalidated(log, self.lines, glossary), "routes")
        self.valid = self.routes.filter("route = 'valid'")
        self.backlog = failure_backlog(failures, self.lines, self.valid)
        failed = self.routes.filter("route in ('requeued', 'failed')").select("key")
        self.historical = failed.union(self.backlog).distinct()

    def metadata(self) -> DataFrame:
        """Metadata lines with the text they must have: kept, added or corrected.
        ``error`` is what would stop the run."""
        rows = compose(self.lines.filter(keeps_source(F.col("id"))), "english").withColumn("target", strip(line_feeds(F.col("english"))))
        now = self.routes.select("key", "route", F.col("composed").alias("__now"))
        same = (F.col("route") == "valid") & (strip(line_feeds(F.col("__now"))) == F.col("target"))
        act = F.when(F.coalesce(same, F.lit(False)), "kept").when(F.col("route").eqNullSafe("requeued"), "corrected").otherwise("added")
        out = checked(rows.join(now, "key", "left").withColumn("action", act), self.glossary, candidate="target")
        return out.select("key", "action", "target", F.when(~F.col("check.ok"), F.array_join("check.errors", ",")).alias("error"))

    def inherited(self) -> DataFrame:
        """Flagged lines that have neither a valid record nor a metadata text."""
        rows = self.job.filter("inheritedR3 and key is not null").groupBy("key").agg(F.min("ord").alias("ord"))
        rows = self.job.join(rows.select("ord"), "ord", "left_semi").filter(~keeps_source(F.col("id")))
        return rows.join(self.valid.select("key"), "key", "left_anti").select("key", F.col("currentVietnamese").alias("vietnamese"))

    def records(self) -> DataFrame:
        """(key, status, vietnamese): one row per key that is done."""
        meta = self.metadata()
        done = self.valid.join(meta.filter("action != 'kept'").select("key"), "key", "left_anti").select("key", "status", "vietnamese")
        locked = meta.filter("action != 'kept'").select("key", F.lit("LOCAL_OK").alias("status"), F.col("target").alias("vietnamese"))
        return done.unionByName(locked).unionByName(self.inherited().select("key", F.lit("INHERITED_R3").alias("status"), "vietnamese"))

    def _pending(self) -> DataFrame:
        return self.job.join(self.records().select("key"), "key", "left_anti")

    def fresh(self) -> DataFrame:
        return self._pending().join(self.historical, "key", "left_anti").select("ord", "key")

    def recovery(self) -> DataFrame:
        return self._pending().join(self.historical, "key", "left_semi").select("ord", "key")

    def active_backlog(self) -> DataFrame:
        return self.backlog.join(self.records().select("key"), "key", "left_anti")


def overlaid(job: DataFrame, records: DataFrame) -> DataFrame:
    """What goes downstream: the stored text, or English where there is none."""
    text = records.select("key", F.col("status").alias("__status"), F.col("vietnamese").alias("__text"))
    use = F.col("__text").isNotNull() & (F.col("__text") != "") & (F.col("__status") != "TECHNICAL_ERROR")
    return job.join(text, "key", "left").select("ord", "key", F.when(use, F.col("__text")).otherwise(F.col("english")).alias("text"), F.when(use, "translated").otherwise("fallback").alias("origin"))
