"""Incremental runs as a stream: new captures in, unseen keys out, once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_records(spark: SparkSession, folder: str, schema: str, source: str = "source", key: str = "chave") -> DataFrame:
    """Records of newly arrived Parquet files, the first of each source and key over all runs.

    The keys seen are the stream's state (RocksDB on large states, by the session's
    setting); late records of past years are an ordinary filter of the caller.
    """
    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.where(F.col(key).isNotNull()).dropDuplicates([source, key])


def run_once(records: DataFrame, out: str, checkpoint: str) -> None:
    """All that has arrived since the last run, appended to ``out``; exactly once by the checkpoint."""
    records.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
