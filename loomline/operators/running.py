"""Running sums in a global order without a single-task window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, order: str, columns: list[str], chunk: int = 100_000) -> DataFrame:
    """Adds run_<column>, the sum up to and with the row, by the bigint ``order``.

    Rows are summed within chunks of ``chunk`` order values in parallel; a window
    over the chunk totals, of which there are one per chunk, gives what came
    before.  ``order`` must be unique; null columns count 0.
    """
    at = F.floor(F.col(order) / chunk)
    df = df.withColumn("__chunk", at)
    inner = Window.partitionBy("__chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = df.groupBy("__chunk").agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"__t_{c}") for c in columns])
    before = Window.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("__chunk", *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__b_{c}") for c in columns])
    out = df.join(base, "__chunk")
    for c in columns:
        out = out.withColumn(f"run_{c}", F.col(f"__b_{c}") + F.sum(F.coalesce(F.col(c), F.lit(0))).over(inner))
    return out.drop("__chunk", *[f"__b_{c}" for c in columns])
