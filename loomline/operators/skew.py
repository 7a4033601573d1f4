"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.session import written

#: A key is hot when it holds at least this share of all counted rows.
HOT_SHARE = 1 / 500


def hot_split_join(rows: DataFrame, dim: DataFrame, keys: list[str], count: str, total: int, share: float = HOT_SHARE) -> DataFrame:
    """Inner join of many rows with a dimension that has one row per key.

    ``dim[count]`` is the number of counted rows of the key, ``total`` their
    sum.  Keys with at least ``share`` of the rows number at most ``1/share``,
    so they are broadcast and their rows are never shuffled; all other rows
    meet in a shuffle join, in which no key is hot.  Null keys don't match.
    An empty side gives an empty result.  Columns of ``rows`` that share a name
    with a non-key column of ``dim`` are not allowed.
    """
    clash = (set(rows.columns) & set(dim.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    least = max(1000, int(total * share))
    hot = dim.filter(F.col(count) >= least)
    cold = dim.filter(F.col(count) < least)
    few = F.broadcast(hot)
    return rows.join(few, keys, "inner").unionByName(rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, "inner"))


def many_to_one(rows: DataFrame, dim: DataFrame, keys: list[str], share: float = HOT_SHARE) -> DataFrame:
    """Inner join with a dimension of one row per key, whose keys may be hot in
    ``rows``.

    The rows are counted by key first (map-side combine, keys only).  The at most
    ``1/share`` hot keys' dimension rows are broadcast, so their rows stay where
    they are; the rest meets in a shuffle join.  Without a hot key that is all.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= 1000)
    counts = written(counts, "hot")
    if counts.isEmpty():
        return rows.join(dim, keys, "inner")
    hot = counts.filter(F.col("__n") >= int(rows.count() * share)).select(*keys)
    few = F.broadcast(dim.join(F.broadcast(hot), keys, "left_semi"))
    return rows.join(few, keys, "inner").unionByName(rows.join(F.broadcast(hot), keys, "left_anti").join(dim, keys, "inner"))
