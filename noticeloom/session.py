"""Session helpers shared by all operators: table access, shared storage, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDER: ContextVar[str] = ContextVar("folder", default="")
#: Largest relation, in estimated bytes, that may be broadcast.
BROADCAST_BYTES = 8 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none (tests on one machine) a temporary folder is
    set, once a session.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.noticeloom.sharedDir", "")
    if not conf:
        conf = tempfile.mkdtemp(prefix="noticeloom-")
        spark.conf.set("spark.noticeloom.sharedDir", conf)
    return conf.rstrip("/")


def written(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back.

    Cuts the lineage, so a lost executor costs a re-read and not a recomputation; the
    written schema replaces any inference.
    """
    spark = df.sparkSession
    path = f"{_FOLDER.get() or shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """What is ``written`` inside is deleted at the end; results must be stored elsewhere by then."""
    folder = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    token = _FOLDER.set(folder)
    try:
        yield folder
    finally:
        _FOLDER.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(scan: DataFrame) -> DataFrame:
    """Rows read from storage in at least as many partitions as there are cores.

    For work that is heavy per row: a table of few bytes comes in fewer partitions than the
    cluster has cores. Larger scans are left as they are, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan (an over-estimate for joins)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its estimated size is below ``limit``, else unchanged.

    Beyond the limit the join is left to Catalyst (sort-merge, AQE skew handling).
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df
