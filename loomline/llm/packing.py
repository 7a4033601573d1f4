"""Problem 5: filling containers of fixed capacity.

Variable-capacity best-fit decreasing.  A container may be opened in any of a
few permitted sizes up to the capacity: the one of least expected cost per used
unit is opened, judged by what still has to be placed; at the end every container
is downsized to the smallest permitted size that holds its contents.  What a new
container can expect is estimated in two ways, with and without counting on the
room in open ones; both packings are planned and the cheaper one is taken.

Best fit only looks at lengths, so it is run on the histogram of lengths (at most
capacity + 1 entries, whatever the number of items): items of one length go to
the containers of one residual in a single step, which gives exactly the packing
that the item-by-item algorithm gives.  The outcome is a table of segments
"items of length L with ranks a.. go k at a time into containers b..".  The items
are then numbered within their length and looked up there, which is a map.

Numbering does not gather a length in one task: a length is divided by a hash
into ``SALTS`` parts that are numbered apart and shifted by the parts' counts.

Defined cases: null lengths count 0; items of length 0 are spread over the
containers; an item longer than the capacity is cut into pieces of the capacity
and a rest, no other item is cut; equal lengths are placed in the order of a hash
part and of ident; ident must be unique; no items give no rows; a capacity that
is null or under 1 is refused.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.session import written

SALTS = 32
#: Permitted container sizes as parts of the capacity.
SIZES = (0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875, 1.0)
#: What a container costs besides its size, as a part of the capacity.
OVERHEAD = 0.05
_SHIFT = 40


class Plan:
    """Packing of a histogram {length: count} into containers."""

    def __init__(self, histogram: dict[int, int], capacity: int, sizes: tuple[float, ...] = SIZES, overhead: float = OVERHEAD, count_room: bool = False):
        self.capacity = capacity
        self.sizes = sorted({max(1, round(capacity * s)) for s in sizes} | {capacity})
        self.segments: list[tuple[int, int, int, int]] = []  # length, first rank, first bin, items a bin
        self.bins = 0
        self.done: list[tuple[int, int, int]] = []  # first bin, bins, used
        self._open: dict[int, list[tuple[int, int, int]]] = {}  # residual -> [(first bin, bins, size)]
        self._keys: list[int] = []
        self.overhead = overhead * capacity
        left = sum(n * c for n, c in histogram.items())
        room = 0  # residual of all open containers
        for length in sorted((n for n in histogram if n > 0), reverse=True):
            count, rank = histogram[length], 0
            while count:
                at = bisect_left(self._keys, length)
                if at == len(self._keys):
                    room += self._open_bins(length, count, left - room * count_room)
                    continue
                residual = self._keys[at]
                start, n, size = self._pop(residual)
                each = residual // length
                full = min(n, count // each)
                if full:
                    self._put(length, rank, start, full, each, residual, size)
                    if n > full:
                        self._push(residual, start + full, n - full, size)
                    moved = full * each
                else:
                    self._put(length, rank, start, 1, count, residual, size)
                    if n > 1:
                        self._push(residual, start + 1, n - 1, size)
                    moved = count
                rank, count, left, room = rank + moved, count - moved, left - moved * length, room - moved * length
        for residual, ranges in self._open.items():
            self.done += [(b, n, size - residual) for b, n, size in ranges]
        if histogram.get(0) and not self.bins:
            self.done.append((0, 1, 0))
            self.bins = 1
        self.done.sort()

    def cost(self) -> float:
        """Size of all containers after downsizing, and their overhead."""
        return sum(n * (self.sizes[bisect_left(self.sizes, used)] + self.overhead) for _, n, used in self.done)

    def _open_bins(self, length: int, count: int, expected: int) -> int:
        """Opens containers of the least-cost size; returns their room."""

        def cost(size: int) -> float:
            return (size + self.overhead) / max(length, min(size, expected))

        size = min((s for s in self.sizes if s >= length), key=lambda s: (cost(s), -s))
        wanted = -(-count // (size // length))
        n = min(wanted, max(1, expected // size)) if expected > 0 else wanted
        self._push(size, self.bins, n, size)
        self.bins += n
        return n * size

    def _put(self, length: int, rank: int, start: int, n: int, each: int, residual: int, size: int) -> None:
        self.segments.append((length, rank, start, each))
        self._push(residual - each * length, start, n, size)

    def _push(self, residual: int, start: int, n: int, size: int) -> None:
        if residual not in self._open:
            self._open[residual] = []
            insort(self._keys, residual)
        self._open[residual].append((start, n, size))

    def _pop(self, residual: int) -> tuple[int, int, int]:
        ranges = self._open[residual]
        got = ranges.pop()
        if not ranges:
            del self._open[residual]
            self._keys.remove(residual)
        return got


def best_plan(histogram: dict[int, int], capacity: int, sizes: tuple[float, ...] = SIZES, overhead: float = OVERHEAD) -> Plan:
    return min((Plan(histogram, capacity, sizes, overhead, room) for room in (False, True)), key=Plan.cost)


def pieces_of(items: DataFrame, ident: str, capacity: Column) -> DataFrame:
    """ident, piece, start, length; needs the column __length."""
    n = F.greatest(F.lit(1), F.ceil(F.col("__length") / capacity)).cast("int")
    out = items.withColumn("piece", F.explode(F.sequence(F.lit(0), n - 1)))
    start = F.col("piece") * capacity
    return out.withColumn("start", start).withColumn("length", F.least(capacity, F.col("__length") - start))


def pack(items: DataFrame, ident: str, length: Column, profiles: list[tuple[str, int]]) -> DataFrame:
    """profile, batch, batch_size, ident, piece, start, length: every item in one
    container of each profile, or cut into pieces if longer than its capacity."""
    for _, capacity in profiles:
        if capacity is None or capacity < 1:
            raise ValueError("a capacity must be 1 or more")
    narrow = written(items.select(ident, F.coalesce(length, F.lit(0)).cast("bigint").alias("__length")), "lengths")
    # Every item is packed once for each profile.
    limits = F.array(*[F.struct(F.lit(i).alias("p"), F.lit(c).cast("bigint").alias("c")) for i, (_, c) in enumerate(profiles)])
    each = narrow.select(ident, "__length", F.explode(limits).alias("__l")).select(ident, "__length", F.col("__l.p").alias("__p"), F.col("__l.c").alias("__capacity"))
    pieces = pieces_of(each, ident, F.col("__capacity")).drop("__length", "__capacity")
    pieces = pieces.withColumn("__salt", F.pmod(F.xxhash64(ident, "piece"), F.lit(SALTS)).cast("int"))
    counts = written(pieces.groupBy("__p", "length", "__salt").agg(F.count(F.lit(1)).alias("__n")), "counts")
    histogram: list[dict[int, int]] = [{} for _ in profiles]
    for r in counts.groupBy("__p", "length").agg(F.sum("__n").alias("n")).collect():  # at most capacity + 1 a profile
        histogram[r[0]][r[1]] = r[2]
    plans = [best_plan(h, c) for h, (_, c) in zip(histogram, profiles, strict=True)]
    before = Window.partitionBy("__p", "length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.withColumn("__shift", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    order = Window.partitionBy("__p", "length", "__salt").orderBy(ident, "piece")
    ranked = pieces.withColumn("__rank", F.row_number().over(order) - 1).join(shift, ["__p", "length", "__salt"]).withColumn("__rank", F.col("__rank") + F.col("__shift"))
    ranked = ranked.select("__p", F.col(ident).alias("__ident"), "piece", "start", "length", "__rank")
    widest = max((c for _, c in profiles), default=0) + 1
    keys, seg, bins = [], [], []
    for p, plan in enumerate(plans):
        for n, rank, start, each in plan.segments:
            keys.append(((p * widest + n) << _SHIFT) + rank)
            seg.append((rank, start, each))
        sizes = np.array(plan.sizes)
        for start, n, used in plan.done:
            bins.append(((p << _SHIFT) + start, sizes[np.searchsorted(sizes, used)]))
    by = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
    keys_a, seg_a = np.array(keys, dtype=np.int64)[by], np.array(seg, dtype=np.int64).reshape(-1, 3)[by]
    bins_a = np.array(sorted(bins), dtype=np.int64).reshape(-1, 2)
    totals, names = np.array([p.bins for p in plans], dtype=np.int64), np.array([n for n, _ in profiles], dtype=object)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            p, n, rank = (f[c].to_numpy(np.int64) for c in ("__p", "length", "__rank"))
            batch = np.zeros(len(f), dtype=np.int64)
            some = n > 0
            if some.any():
                at = np.searchsorted(keys_a, ((p * widest + n) << _SHIFT)[some] + rank[some], side="right") - 1
                s = seg_a[at]
                batch[some] = s[:, 1] + (rank[some] - s[:, 0]) // s[:, 2]
            batch[~some] = rank[~some] % np.maximum(totals[p[~some]], 1)
            at = np.searchsorted(bins_a[:, 0], (p << _SHIFT) + batch, side="right") - 1
            yield pd.DataFrame({"profile": names[p], "batch": batch, "batch_size": bins_a[at, 1], ident: f["__ident"], "piece": f["piece"], "start": f["start"], "length": f["length"]})

    kind = narrow.schema[ident].dataType.simpleString()
    return ranked.mapInPandas(place, f"profile string, batch bigint, batch_size bigint, `{ident}` {kind}, piece int, start bigint, length bigint")


def fill_report(packed: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per profile: batches, the least possible number, used, opened and free units."""
    per = packed.groupBy("profile", "batch").agg(F.sum("length").alias("used"), F.max("batch_size").alias("size"))
    per = per.groupBy("profile").agg(F.count(F.lit(1)).alias("batches"), F.sum("used").alias("used"), F.sum("size").alias("opened"), F.max("used").alias("fullest"))
    out = per.join(F.broadcast(profiles.select("profile", "capacity")), "profile")  # one row a profile
    return out.select("profile", "capacity", "batches", F.greatest(F.lit(1), F.ceil(F.col("used") / F.col("capacity"))).alias("least_batches"), "used", "opened", "fullest", (F.col("opened") - F.col("used")).alias("free"), (F.col("used") / (F.col("batches") * F.col("capacity"))).alias("fill"))
