"""Greedy packing of an ordered queue into request batches, and their budgets.

A batch takes the next line unless it is full by count or the line would exceed
the size limit; a single oversize line is a batch of its own.  The rule looks
sequential, but where a batch ends depends only on where it starts.  So every
chunk of the queue works out, for each of the few positions at which the first
batch can start in it, where the last one ends; chaining these small tables gives
every chunk its true start, and the chunks then mark their batches in parallel.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.text import utf16_length
from loomline.session import written

#: Lines of a chunk, about.  The driver holds max_items rows and numbers a chunk.
CHUNK = 200_000
LINE_OVERHEAD = 200


def line_weight(english: Column, japanese: Column) -> Column:
    blank = lambda c: F.coalesce(c, F.lit(""))
    return (utf16_length(blank(english)) + utf16_length(blank(japanese)) + LINE_OVERHEAD).cast("bigint")


def _next(weights: np.ndarray, max_items: int, max_weight: int) -> np.ndarray:
    """Where the batch that starts at each place ends."""
    s = np.r_[0, np.cumsum(weights)]
    n = np.searchsorted(s, s[:-1] + max_weight, side="right") - 1
    at = np.arange(len(weights))
    return np.clip(n, at + 1, at + max_items)


def _beside(placed: DataFrame, rows: list[tuple], kind: str) -> DataFrame:
    """Adds what the driver knows of each chunk, a few numbers."""
    if len(rows) == 1:
        named = [p.strip().split(" ") for p in kind.split(",")[1:]]
        return placed.withColumns({n: F.lit(v).cast(t) if not isinstance(v, list) else F.array(*map(F.lit, v)).cast(t) for (n, t), v in zip(named, rows[0][1:], strict=True)})
    few = placed.sparkSession.createDataFrame(rows, kind)
    return placed.join(F.broadcast(few) if len(rows) <= 100_000 else few, "c")


def greedy_batches(queue: DataFrame, order: str, weight: str, max_items: int = 10, max_weight: int = 5200, chunk: int = CHUNK) -> DataFrame:
    """Adds batch_id, from 0 in queue order.

    ``order`` is unique; null weights count 0; an empty queue gives no batch.
    """
    spark = queue.sparkSession
    rows = written(queue.select(F.col(order).alias("o"), F.coalesce(F.col(weight), F.lit(0)).cast("bigint").alias("w")), "queue")
    n = rows.count()
    parts = max(1, n // chunk)
    placed = written(rows.repartitionByRange(parts, "o").sortWithinPartitions("o").withColumn("c", F.spark_partition_id()), "chunks")
    first = Window.partitionBy("c").orderBy("o")
    head = placed.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= max_items).orderBy("o").select("c", "w").collect()
    sizes = {r.c: r["count"] for r in placed.groupBy("c").count().collect()}
    order_of = sorted(sizes)  # range partitions, so their numbers are in order
    # What follows each chunk: one pass from the back, so linear in the chunks.
    heads: dict[int, list[int]] = {}
    for r in head:
        heads.setdefault(r.c, []).append(r.w)
    after, nxt = [], []
    for c in reversed(order_of):
        after.append((c, nxt))
        nxt = (heads[c] + nxt)[:max_items]
    placed = _beside(placed, after, "c int, halo array<bigint>")

    def ends(f: pd.DataFrame) -> pd.DataFrame:
        c = int(f["c"].iloc[0])
        w = f.sort_values("o")["w"].to_numpy(np.int64)
        step = _next(np.r_[w, np.asarray(f["halo"].iloc[0], dtype=np.int64)], max_items, max_weight)
        exits, counts = [], []
        for e in range(max_items):
            at, k = e, 0
            while at < len(w):
                at, k = int(step[at]), k + 1
            exits.append(at - len(w))
            counts.append(k)
        return pd.DataFrame({"c": [c], "exits": [exits], "counts": [counts]})

    table = {r.c: r for r in placed.groupBy("c").applyInPandas(ends, "c int, exits array<int>, counts array<int>").collect()}
    entry, number, starts = 0, 0, []
    for c in order_of:
        starts.append((c, entry, number))
        number += table[c].counts[entry]
        entry = table[c].exits[entry]

    def mark(f: pd.DataFrame) -> pd.DataFrame:
        c = int(f["c"].iloc[0])
        f = f.sort_values("o")
        w = f["w"].to_numpy(np.int64)
        step = _next(np.r_[w, np.asarray(f["halo"].iloc[0], dtype=np.int64)], max_items, max_weight)
        at, number = int(f["at"].iloc[0]), int(f["number"].iloc[0])
        start = np.zeros(len(w), dtype=np.int64)
        while at < len(w):
            start[at] = 1
            at = int(step[at])
        return pd.DataFrame({"o": f["o"], "batch_id": number - 1 + np.cumsum(start)})

    placed = _beside(placed, starts, "c int, at int, number bigint")
    got = placed.groupBy("c").applyInPandas(mark, f"o {placed.schema['o'].dataType.simpleString()}, batch_id bigint")
    return queue.join(got.withColumnRenamed("o", order), order)


def token_budget(batches: DataFrame, english: str, max_tokens: int = 3072) -> DataFrame:
    """Per batch: lines, source length and the response budget."""
    per = batches.groupBy("batch_id").agg(F.count(F.lit(1)).alias("lines"), F.sum(utf16_length(F.coalesce(F.col(english), F.lit("")))).alias("chars"))
    need = F.ceil(F.col("chars") * 0.72) + F.col("lines") * 24 + 128
    return per.withColumn("budget", F.least(F.lit(max_tokens), F.greatest(F.lit(384), need)).cast("bigint"))


# Where the seeds of each phase begin and their steps.
SEED = 211


def phase_seed(phase: Column, batch: Column, item: Column, attempt: Column, base: int = SEED) -> Column:
    return F.lit(base) + (
        F.when(phase.isin("PILOT", "PRIMARY"), batch)
        .when(phase == "PRIMARY_REPAIR", 300000 + batch * 100 + item * 10 + attempt)
        .when(phase == "RECOVERY_SMALL_BATCH", 100000 + batch)
        .when(phase == "RECOVERY_SINGLE", 200000 + item * 10 + attempt)
    )


def batch_terms(batches: DataFrame, english: str, terms: list[str], case_sensitive: bool) -> DataFrame:
    """(batch_id, term) of the terms that occur in the batch's English.  Terms are
    literals of a checked glossary; a batch's lines are combined map-side."""
    from loomline.functions.tokens import term_count

    text = F.coalesce(F.col(english), F.lit(""))
    hits = F.array_compact(F.array(*[F.when(term_count(text, t, case_sensitive) > 0, t) for t in terms])) if terms else F.array().cast("array<string>")
    return batches.select("batch_id", F.explode(hits).alias("term")).distinct()
