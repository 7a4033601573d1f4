"""Tables, shared work folder and materialisation.

Everything that must outlive a stage is written to the folder that the cluster
names in ``spark.checkpoint.dir``.  Only a local session may fall back to a
folder of its own.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}
_SHIPPED: set[str] = set()
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers, once an application, so that
    executors need no installation."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    # Batches to Python are bounded by size as well, as texts may be very long.
    if spark.conf.get(_ARROW_BYTES, None) in (None, str(2**31 - 1)):
        spark.conf.set(_ARROW_BYTES, str(32 << 20))
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="loomline-code-")  # on the driver, which serves it
    atexit.register(shutil.rmtree, folder, True)
    keep = shutil.copytree(here, f"{folder}/src/loomline", ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/loomline", "zip", os.path.dirname(keep)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """Folder of this application inside the shared checkpoint folder."""
    ship(spark)
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="loomline-")
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(base)
        root = _ROOTS[app] = f"{base.rstrip('/')}/loomline-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, root)
    return _ROOTS[app]


def _remove(spark: SparkSession, root: str) -> None:
    try:
        remove(spark, root)
    except Exception:  # the session is gone already
        pass


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


def work_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: the rows are written to the shared folder and read back.

    Unlike a cache this survives the loss of any executor, and unlike a row
    checkpoint later reads prune columns.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer partitions than there are cores, dealt out to all of them.

    Only small inputs have so few, so what is shuffled is at most a scan partition
    for each core; any larger input stays where it is.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a plan's size; for a file scan the bytes of its files.
    0 where it knows nothing, as for rows that come from the driver."""
    n = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return n if n < 1 << 60 else 0


def parts_for(size: int, least: int, part_bytes: int = 256 << 20) -> int:
    """So many partitions that none holds more than about ``part_bytes``."""
    return max(least, -(-size // part_bytes))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it is missing.  For folders of a few entries."""
    p, fs = hadoop_path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def publish(spark: SparkSession, path: str, text: str) -> None:
    """Creates a small file as a whole: readers see all of it or nothing.  The file
    must not exist, so of two writers one fails."""
    p, fs = hadoop_path(spark, path)
    part, _ = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(part, p):
        fs.delete(part, False)
        raise FileExistsError(path)


def content(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    p, fs = hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()
