"""Exactly one copy of every message of an at-least-once log.

The store is a Parquet table in partitions of arrival blocks and an append-only
identifier index (identifier -> partition) in hash buckets.  A delivery is merged
like this:

1. the index tells in which partitions earlier copies of its messages lie; only
   the buckets of the delivery's identifiers are read;
2. identifiers that the index doesn't know are appended to it, with the partition
   of their first copy;
3. only the partitions so found, and the blocks that the delivery itself writes
   to, are read and combined with the incoming rows;
4. one winner per identifier is recomputed (the lowest ``order`` value) by an
   aggregate with map-side combine, so a message with any number of copies is
   one row per map task;
5. the affected partitions are replaced by dynamic partition overwrite; no other
   partition is touched.  Where a partition holds rows already, its new rows are
   staged beside the table first, and a journal file says so.

After a failure between or in any two steps the store is whole again with the next
merge.  The index is written before the messages: an entry without a message only
names the partition in which the message will be filed.  A journal names staged
partitions that may be half replaced; the next merge replaces them again, which
gives the same rows.  Without a journal no stored row was touched.  So merging the
same delivery again leaves exactly one copy of each message, and merging another
one first does no harm.

Defined cases: rows with a null in any identifier column have no identity and
are all kept; equal ``order`` values of one identifier are a contract violation
(both rows stay); an empty delivery changes nothing; additional columns are
carried along whatever they are called.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators.skew import hot_split_join
from loomline.session import content, exists, names, parts_for, plan_bytes, publish, remove, work_dir, written

PART, BUCKET = "__part", "__bucket"
#: Bytes of a file, about: so many tasks write one partition.
FILE_BYTES = 128 << 20


class MessageStore:
    def __init__(self, spark: SparkSession, root: str, identity: list[str], order: str, block: Column, buckets: int = 64, salts: int = 1):
        """identity: the columns that name a message; order: a unique bigint, the
        lowest wins; block: the arrival block of a row as an int; buckets of the
        index; salts: tasks that write one partition."""
        self.spark, self.root, self.identity, self.order, self.block = spark, root, identity, order, block.cast("int")
        self.buckets, self.salts = buckets, salts
        self.messages_path, self.index_path, self.staged_path, self.journal = f"{root}/messages", f"{root}/index", f"{root}/staged", f"{root}/journal"

    def messages(self) -> DataFrame:
        return self.spark.read.parquet(self.messages_path)

    def index(self, buckets: list[int] | None = None) -> DataFrame:
        """Entries of the given buckets, or of all."""
        rows = self.spark.read.parquet(self.index_path)
        return rows if buckets is None else rows.filter(F.col(BUCKET).isin(buckets))

    def step(self, name: str) -> None:
        """Called after each step that writes; tests stop merges here."""

    def _known(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.identity])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.identity), F.lit(self.buckets)).cast("int")

    def recover(self) -> None:
        """Ends a replacement that was cut off, or drops what it had staged."""
        if not exists(self.spark, self.journal):
            remove(self.spark, self.staged_path)
            return
        if content(self.spark, self.journal):
            self._overwrite(self.spark.read.parquet(self.staged_path))
        remove(self.spark, self.journal)
        remove(self.spark, self.staged_path)

    def _losers(self, narrow: DataFrame) -> DataFrame:
        """order and partition of all copies but the winner.

        Only identifiers with several copies take part in the join back, and
        the copies of hot identifiers are not shuffled for it.
        """
        best = written(narrow.groupBy(*self.identity).agg(F.min(self.order).alias("__best"), F.count(F.lit(1)).alias("__n")).filter("__n > 1"), "best")
        total = best.agg(F.sum("__n")).first()[0] or 0
        rows = hot_split_join(narrow, best, self.identity, "__n", total)
        return written(rows.filter(F.col(self.order) > F.col("__best")).select(self.order, PART, "__stored"), "losers")

    def _homes(self, narrow: DataFrame) -> DataFrame | None:
        """(identity, __n, __old): the partition of each identifier of the delivery
        that has one; None without an index.  The others get their entry here, the
        partition of the copy that wins, so none of their copies has to move."""
        ids = narrow.groupBy(*self.identity).agg(F.min_by(PART, self.order).alias("__new"), F.count(F.lit(1)).alias("__n")).withColumn(BUCKET, self._bucket())
        if exists(self.spark, self.index_path):
            ids = written(ids, "ids")
            few = sorted(r[0] for r in ids.select(BUCKET).distinct().collect())  # at most ``buckets``
            entries = self.index(few).groupBy(*self.identity, BUCKET).agg(F.min(PART).alias("__old"))
            home = written(ids.join(entries, [*self.identity, BUCKET], "left"), "home")
            fresh = home.filter("__old is null")
        else:
            home = None
            fresh = written(ids, "ids")
        if not fresh.isEmpty():
            entries = fresh.select(*self.identity, F.col("__new").alias(PART), BUCKET)
            entries.repartition(BUCKET).write.mode("append").option("compression", "zstd").partitionBy(BUCKET).parquet(self.index_path)
        self.step("index")
        return home

    def merge(self, incoming: DataFrame) -> list[int]:
        """Takes up one delivery; returns the partitions that were replaced."""
        self.recover()
        incoming = incoming.withColumn(PART, F.coalesce(self.block, F.lit(-1)))
        narrow = incoming.filter(self._known()).select(*self.identity, self.order, PART, F.lit(False).alias("__stored"))
        home = self._homes(narrow)
        there: list[int] = []
        placed, again = incoming, None
        if exists(self.spark, self.messages_path):
            # As long as the table has partitions at most, like every list here.
            there = [r[0] for r in home.filter("__old is not null").select("__old").union(incoming.select(PART)).distinct().collect()] if home is not None else []
            have = {int(n.partition("=")[2]) for n in names(self.spark, self.messages_path) if n.startswith(PART)}
            there = sorted(have.intersection(there))
            stored = self.messages().filter(F.col(PART).isin(there))
            again = incoming.select(self.order).join(stored.select(self.order), self.order)
            placed = incoming.join(again, self.order, "left_anti")
        if home is not None:
            # A message is filed with its first copy: only those that move are joined.
            known = home.filter("__old is not null").select(*self.identity, F.col("__old").alias("__home"), "__n")
            total = known.agg(F.sum("__n")).first()[0] or 0
            moves = hot_split_join(narrow, known, self.identity, "__n", total).filter(F.col("__home") != F.col(PART)).select(self.order, "__home")
            placed = placed.join(moves, self.order, "left").withColumn(PART, F.coalesce("__home", PART)).select(incoming.columns)
        narrow = placed.filter(self._known()).select(*self.identity, self.order, PART, F.lit(False).alias("__stored"))
        if again is not None:
            narrow = narrow.unionByName(stored.filter(self._known()).select(*self.identity, self.order, PART, F.lit(True).alias("__stored")))
        losers = self._losers(narrow)
        lost = losers.select(self.order, PART)
        # Partitions that get a row or lose one; the others stay as they are.
        got = placed.select(self.order, PART).join(lost, [self.order, PART], "left_anti").select(PART)
        changed = sorted(r[0] for r in got.union(losers.filter("__stored").select(PART)).distinct().collect())
        if not changed:
            return []
        rewritten = [p for p in changed if p in there]
        if rewritten:
            placed = placed.unionByName(self.messages().filter(F.col(PART).isin(rewritten)).select(incoming.columns))
        if rewritten:
            # Rows of partitions that hold none yet are staged as well: one pass.
            with self._once_shuffled():
                self._without(placed, lost).write.mode("overwrite").option("compression", "zstd").partitionBy(PART).parquet(self.staged_path)
            self.step("staged")
            publish(self.spark, self.journal, "staged")
            self.step("journal")
            self._overwrite(self.spark.read.parquet(self.staged_path))
            self.step("messages")
            remove(self.spark, self.journal)
            remove(self.spark, self.staged_path)
        else:
            with self._once_shuffled():
                self._overwrite(self._without(placed, lost))
            self.step("messages")
        return changed

    @contextmanager
    def _once_shuffled(self):
        """Lets a join use a partitioning by some of its keys."""
        conf, name = self.spark.conf, "spark.sql.requireAllClusterKeysForCoPartition"
        before = conf.get(name)
        conf.set(name, "false")
        try:
            yield
        finally:
            conf.set(name, before)

    def _without(self, placed: DataFrame, lost: DataFrame) -> DataFrame:
        """``placed`` without ``lost``.  Rows are shuffled once, by partition and
        salt; the losers come to them in the same partitioning."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        salt = F.pmod(F.xxhash64(self.order), F.lit(self.salts))
        put = lambda df: df.withColumn("__salt", salt).repartition(n, PART, "__salt")
        return put(placed).join(put(lost), [PART, "__salt", self.order], "left_anti").select(placed.columns)

    def _overwrite(self, rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(PART).parquet(self.messages_path)


def surplus_deliveries(log: DataFrame, identity: list[str], order: str, batch: str, blocks: int | None = None, deliveries: int = 2, root: str | None = None) -> DataFrame:
    """order values of the rows of ``log`` that a store fed with it does not keep.

    The batches are merged in ``deliveries`` consecutive deliveries, as they
    came.  Rows without identity are never surplus; ties cannot occur because
    ``order`` is unique.  An empty log gives no row.  ``blocks`` follows from the
    size of the log unless given.
    """
    spark = log.sparkSession
    size = plan_bytes(log)
    blocks = blocks or parts_for(size, 24, 4 * FILE_BYTES)
    low, high = log.agg(F.min(batch), F.max(batch)).first()
    if low is None:
        low = high = 0
    span = high - low + 1
    block = F.floor((F.coalesce(F.col(batch), F.lit(low)) - low) * blocks / span)
    store = MessageStore(spark, root or work_dir(spark, "messages"), identity, order, block, parts_for(size, 16), parts_for(size // blocks, 1, FILE_BYTES))
    for d in range(deliveries):
        a, b = low + span * d // deliveries, low + span * (d + 1) // deliveries
        at = F.coalesce(F.col(batch), F.lit(low))
        store.merge(log.filter((at >= a) & (at < b)))
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in identity])
    if not exists(spark, store.messages_path):
        return log.filter(F.lit(False)).select(order)
    return log.filter(known).select(order).join(store.messages().select(order), order, "left_anti")
