"""The newest record of each key, kept up to date from a stream of log files.

State is a Parquet table in hash partitions of the key.  A micro-batch reduces its
rows to one per key, reads only the partitions of those keys and replaces these.
Newest is a matter of the order column alone, so a micro-batch that is replayed after
a failure gives the same rows and needs no number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators.incremental import PART, partition_of
from loomline.session import exists, work_dir, written


class LatestTable:
    def __init__(self, spark: SparkSession, root: str, schema: str, key: str = "key", order: str = "seq", parts: int = 8, salts: int = 1):
        """parts, salts: partitions, and the tasks that write one; their product times the
        size of a file is about the size of the state."""
        self.spark, self.path, self.schema, self.key, self.order, self.parts, self.salts = spark, f"{root}/latest", schema, key, order, parts, salts

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], f"{self.schema}, {PART} int")
        return self.spark.read.schema(f"{self.schema}, {PART} int").parquet(self.path)

    def upsert(self, rows: DataFrame) -> None:
        rows = written(rows.filter(F.col(self.key).isNotNull()).withColumn(PART, partition_of(self.key, self.parts)), "micro")
        touched = [r[0] for r in rows.select(PART).distinct().collect()]  # at most ``parts``
        if not touched:
            return
        both = rows.unionByName(self.read().filter(F.col(PART).isin(touched)))
        best = both.groupBy(self.key).agg(F.max(self.order).alias(self.order))
        new = written(both.join(best, [self.key, self.order], "left_semi").dropDuplicates([self.key]), "merged")
        new.repartition(PART, F.pmod(F.xxhash64(self.key, F.lit(1)), F.lit(self.salts))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.path)


def latest_stream(spark: SparkSession, folder: str, schema: str, lines: DataFrame, table: LatestTable, checkpoint: str | None = None, files_per_batch: int = 4):
    """Starts a query that takes up all files of ``folder`` and ends.  Only rows
    with the present source hash of their line are taken."""
    known = lines.select("key", "sourceHash")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return (
        source.writeStream.foreachBatch(lambda rows, _: table.upsert(rows.join(known, ["key", "sourceHash"], "left_semi").select(rows.columns)))
        .option("checkpointLocation", checkpoint or work_dir(spark, "stream"))
        .trigger(availableNow=True)
        .start()
    )
