"""Processing only what is new or changed since the last successful run.

A table is held in hash partitions of its key.  Every partition has a
fingerprint: its row count and the sums of both halves of a 64-bit row hash.
The sums are additive, so they come out of one aggregate with map-side combine
and need no order.  Partitions with equal fingerprints are skipped; the others
are recomputed, and each is replaced by dynamic partition overwrite.

Everything a run writes - changes, what was made of them, the new state of the
recomputed partitions and the fingerprints - lies under the number of the run and
counts only once the run's commit file stands, which is created as a whole.  A
failed run leaves files that nobody reads; its retry has the same number, clears
and rewrites them.  So after a failure at any step no record is skipped, and none
stands twice in the outputs of the committed runs.  An effect that ``process`` has
outside of the rows it returns cannot be taken back by a retry.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.session import content, exists, names, parts_for, plan_bytes, publish, remove, work_dir, written

PART, RUN = "__part", "__run"
_PRINTS = f"{PART} int, n bigint, low bigint, high bigint, at int"


def partition_of(key: str, parts: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(parts)).cast("int")


def fingerprints(df: DataFrame, part: str, columns: list[str]) -> DataFrame:
    """part, n, low, high.  Nulls hash as such: a null and a missing row differ
    through n.  Half hashes below 2^32 cannot overflow the sums under 2^31 rows."""
    h = F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])
    return df.select(F.col(part), h.alias("__h")).groupBy(part).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("__h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftrightunsigned(F.col("__h"), 32)).alias("high"),
    )


def changed_partitions(before: DataFrame, after: DataFrame, part: str = PART) -> list[int]:
    """Partitions whose fingerprints differ or that only one side has.  The list
    is bounded by the number of partitions."""
    b = before.select(part, F.struct("n", "low", "high").alias("b"))
    a = after.select(part, F.struct("n", "low", "high").alias("a"))
    return sorted(r[0] for r in b.join(a, part, "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select(part).collect())


class IncrementalTable:
    """The state (key, version) that the last successful run has taken up.

    ``parts`` counts for a new table only; later runs use the table's own.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, version: str, parts: int = 32):
        self.spark, self.root, self.key, self.version = spark, root, key, version
        done = self.runs()
        self.parts = json.loads(content(spark, f"{root}/commits/{done[-1]:08d}"))["parts"] if done else parts

    def runs(self) -> list[int]:
        """Numbers of the committed runs."""
        return [int(n) for n in names(self.spark, f"{self.root}/commits") if n.isdigit()]

    def _kind(self, what: str) -> str:
        key = f"`{self.key}` string"
        return {"state": f"{key}, `{self.version}` string", "changes": f"{key}, change string"}[what] + f", {RUN} int, {PART} int"

    def _pairs(self, what: str, pairs: list[tuple[int, int]], kind: str | None) -> DataFrame:
        """The rows of the given (run, partition) folders; no other is listed."""
        base = f"{self.root}/{what}"
        paths = [p for r, k in pairs if exists(self.spark, p := f"{base}/{RUN}={r}/{PART}={k}")]
        if not paths:
            return self.spark.createDataFrame([], kind)
        reader = self.spark.read.option("basePath", base)
        return (reader.schema(kind) if kind else reader).parquet(*paths)

    def _prints(self, run: int) -> DataFrame:
        if not run:
            return self.spark.createDataFrame([], _PRINTS)
        return self.spark.read.schema(_PRINTS).parquet(f"{self.root}/prints/{RUN}={run}")

    def _state(self, run: int, parts: list[int] | None = None) -> DataFrame:
        rows = self._prints(run)
        if parts is not None:
            rows = rows.filter(F.col(PART).isin(parts))
        return self._pairs("state", [(r["at"], r[PART]) for r in rows.select("at", PART).collect()], self._kind("state"))

    def state(self) -> DataFrame:
        done = self.runs()
        return self._state(done[-1] if done else 0).select(self.key, self.version)

    def outputs(self) -> DataFrame | None:
        """What ``process`` returned in all committed runs; None before the first."""
        pairs = [(r, p) for r in self.runs() for p in json.loads(content(self.spark, f"{self.root}/commits/{r:08d}"))["wrote"]]
        return self._pairs("outputs", pairs, None) if pairs else None

    def place(self, df: DataFrame) -> DataFrame:
        return df.filter(F.col(self.key).isNotNull()).select(self.key, self.version).distinct().withColumn(PART, partition_of(self.key, self.parts))

    def begin(self, current: DataFrame) -> Run:
        return Run(self, current)

    def changes(self, current: DataFrame) -> DataFrame:
        """(key, change) of each key of ``current`` that is ``new`` or ``changed``
        against the state.

        Several versions of one key in ``current`` count as changed when any of
        them differs from the state.  Null keys name no record and are left out;
        a null version is a version like any other.  Versions compare exactly.
        An empty ``current`` gives no row, an empty state only ``new`` ones.
        """
        return self.begin(current).changes().select(self.key, "change")

    def run(self, current: DataFrame, process: Callable[[DataFrame], DataFrame | None]) -> list[int]:
        """One run: the rows that ``process(changes)`` returns, which must keep the
        key, become part of ``outputs`` with the commit, or not at all."""
        r = self.begin(current)
        made = process(r.changes().select(self.key, "change"))
        if r.todo:
            r.commit(made)
        return r.todo

    def step(self, name: str) -> None:
        """Called after each step that writes; tests stop runs here."""


class Run:
    """One attempt at the next run."""

    def __init__(self, table: IncrementalTable, current: DataFrame):
        self.table, done = table, table.runs()
        self.before = done[-1] if done else 0
        self.number = self.before + 1
        for what in ("state", "changes", "outputs", "prints"):  # of a failed attempt
            remove(table.spark, f"{table.root}/{what}/{RUN}={self.number}")
        self.placed = written(table.place(current), "current")
        self.prints = written(fingerprints(self.placed, PART, [table.key, table.version]), "prints")
        self.todo = changed_partitions(table._prints(self.before), self.prints)
        table.step("fingerprints")

    def _write(self, rows: DataFrame, what: str) -> list[int]:
        """Replaces this run's partitions; returns those that have rows."""
        t, path = self.table, f"{self.table.root}/{what}"
        rows = rows.filter(F.col(PART).isin(self.todo)).withColumn(RUN, F.lit(self.number))
        rows.repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(RUN, PART).parquet(path)
        t.step(what)
        return [int(n.partition("=")[2]) for n in names(t.spark, f"{path}/{RUN}={self.number}") if n.startswith(PART)]

    def changes(self) -> DataFrame:
        t = self.table
        if not self.todo:
            return t.spark.createDataFrame([], t._kind("changes"))
        old = t._state(self.before, self.todo).select(PART, t.key, F.struct(F.col(t.version).alias("v")).alias("__old"))
        what = (
            self.placed.filter(F.col(PART).isin(self.todo)).join(old, [PART, t.key], "left")
            .withColumn("__c", F.when(F.col("__old").isNull(), "new").when(~F.col("__old.v").eqNullSafe(F.col(t.version)), "changed"))
            .filter(F.col("__c").isNotNull())
            .groupBy(PART, t.key)
            .agg(F.min("__c").alias("change"))
        )
        got = self._write(what, "changes")
        return t._pairs("changes", [(self.number, p) for p in got], t._kind("changes"))

    def commit(self, made: DataFrame | None = None) -> None:
        """The present rows become the state of the recomputed partitions."""
        t = self.table
        wrote = [] if made is None else self._write(made.withColumn(PART, partition_of(t.key, t.parts)), "outputs")
        self._write(self.placed, "state")
        new = F.col(PART).isin(self.todo)
        kept = t._prints(self.before).filter(~new)
        prints = self.prints.filter(new).withColumn("at", F.lit(self.number)).unionByName(kept)
        prints.coalesce(1).write.mode("overwrite").parquet(f"{t.root}/prints/{RUN}={self.number}")
        t.step("prints")
        publish(t.spark, f"{t.root}/commits/{self.number:08d}", json.dumps({"parts": t.parts, "wrote": wrote}))
        t.step("commit")


def due_lines(job: DataFrame, log: DataFrame, runs: DataFrame, parts: int | None = None, root: str | None = None) -> DataFrame:
    """Job lines that the next run must take up, as (key, change).

    The state is what the log held at T, the greatest finished_at of a COMPLETE
    run: per key the source hash of the row with the greatest (updatedAt, seq)
    up to T.  Without a COMPLETE run every line is new.  A key with very many
    log rows is one row per map task before the shuffle.  ``parts`` follows from
    the size of the job table unless given.
    """
    spark = job.sparkSession
    at = runs.filter("outcome = 'COMPLETE'").agg(F.unix_micros(F.max("finished_at"))).first()[0]
    then = (
        log.filter(F.col("key").isNotNull() & (F.col("updatedAt") <= F.timestamp_micros(F.lit(at).cast("bigint"))))
        .groupBy("key")
        .agg(F.max_by("sourceHash", F.struct("updatedAt", "seq")).alias("sourceHash"))
    )
    held = IncrementalTable(spark, root or work_dir(spark, "due"), "key", "sourceHash", parts or parts_for(plan_bytes(job), 16))
    first = held.begin(then)
    if first.todo:
        first.commit()
    return held.changes(job)
