"""Job files, append-only JSON-lines logs, reports and the result bundle."""

from __future__ import annotations

import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.session import exists, hadoop_path, names, publish
from loomline.sources import schemas

_BAD = "__corrupt"


def read_job(spark: SparkSession, path: str) -> DataFrame:
    """Lines of JSON job files with ``ord``, their place in the job, from 1."""
    jobs = spark.read.schema(schemas.JOB).option("multiLine", True).json(path)
    return jobs.select("jobId", F.posexplode("items").alias("p", "i")).select("jobId", (F.col("p") + 1).cast("bigint").alias("ord"), "i.*")


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """(term, target, ord); target null means the term stays as it is."""
    g = spark.read.schema(schemas.GLOSSARY).option("multiLine", True).json(path)
    keep = g.select(F.posexplode_outer("keepExact").alias("p", "term")).filter("term is not null")
    n = keep.count()
    entries = F.map_entries("translateAs")
    out = g.select(F.posexplode(entries).alias("p", "e")).select(F.col("e.key").alias("term"), F.col("e.value").alias("target"), (F.col("p") + 1 + n).cast("int").alias("ord"))
    return keep.select("term", F.lit(None).cast("string").alias("target"), (F.col("p") + 1).cast("int").alias("ord")).unionByName(out)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank and torn lines are skipped, wherever they are."""
    rows = spark.read.schema(f"{schema}, {_BAD} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).json(path)
    kept = rows.filter(F.col(_BAD).isNull())
    # A column besides the marker must be read, or Spark doesn't parse the lines.
    return kept.select([c for c in rows.columns if c != _BAD])


def append_log(df: DataFrame, path: str) -> None:
    """One commit for all rows; a failed job leaves no part of them."""
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report of one row, replaced as a whole."""
    report.coalesce(1).write.mode("overwrite").json(path)


def ordered(records: DataFrame) -> DataFrame:
    """The records as a result holds them: by key in dictionary order."""
    return records.orderBy(F.expr("key collate UNICODE"), "key")


def write_bundle(records: DataFrame, report: DataFrame, folder: str, job_id: str, job_hash: str) -> str:
    """Result folder and archive beside it: ordered translations, report and manifest.

    ``folder`` must not exist yet and must be one that driver and executors share, of
    any file system that Spark knows.  The records are written by the executors; the
    archive is streamed part by part through the driver, never held there.
    """
    spark = records.sparkSession
    if exists(spark, folder):
        raise FileExistsError(folder)
    ordered(records).write.json(f"{folder}/translations")
    write_report(report, f"{folder}/report")
    publish(spark, f"{folder}/manifest.json", json.dumps({"jobId": job_id, "jobHash": job_hash, "report": report.first().asDict()}, indent=2, default=str))
    jvm = spark.sparkContext._jvm
    target, fs = hadoop_path(spark, f"{folder}.zip")
    out = jvm.java.util.zip.ZipOutputStream(fs.create(target, True))
    try:
        for sub in ("translations", "report", ""):
            for name in names(spark, f"{folder}/{sub}".rstrip("/")):
                path, _ = hadoop_path(spark, "/".join(x for x in (folder, sub, name) if x))
                if name[0] in "._" or fs.getFileStatus(path).isDirectory():
                    continue
                out.putNextEntry(jvm.java.util.zip.ZipEntry("/".join(x for x in (sub, name) if x)))
                part = fs.open(path)
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
                part.close()
                out.closeEntry()
    finally:
        out.close()
    return f"{folder}.zip"


def read_bundle(spark: SparkSession, archive: str) -> DataFrame:
    """The translations of a bundle's archive.  An archive is one stream, so it is
    read by one task, line by line."""

    def lines(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in frames:
            for raw in f.column("content"):
                with zipfile.ZipFile(pa.BufferReader(raw.as_buffer())) as z:
                    for name in sorted(n for n in z.namelist() if n.startswith("translations/")):
                        with z.open(name) as part:
                            while some := part.readlines(1 << 20):
                                yield pa.RecordBatch.from_arrays([pa.array([x.decode().rstrip("\n") for x in some], pa.string())], names=["value"])

    rows = spark.read.format("binaryFile").load(archive).select("content").mapInArrow(lines, "value string")
    return rows.select(F.from_json("value", "key string, status string, vietnamese string").alias("r")).select("r.*")


def forbidden_files(spark: SparkSession, root: str, patterns: list[str]) -> DataFrame:
    """(path, sha256) of the files under a folder whose path fits a pattern."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    hit = files.filter(F.col("path").rlike("|".join(f"(?:{p})" for p in patterns)))
    return hit.select("path", F.sha2("content", 256).alias("sha256"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


