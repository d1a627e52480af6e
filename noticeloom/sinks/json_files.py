"""Notices as JSON, one per key (the last write of a key wins), and the run log."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.constants import DOMAIN_SCHEMA
from noticeloom.functions.text import file_key
from noticeloom.operators.normalize import DOMAIN


def keyed(records: DataFrame, order: str) -> DataFrame:
    """``file, json``: one row per file key, the last by ``order``; nulls are written, not left out."""
    anonymous = F.concat(F.lit("edital_anonimo_"), F.col(order).cast("string"))
    rows = records.select(file_key(F.coalesce("nome", F.lit("")), anonymous).alias("file"), F.col(order).alias("__at"), *[F.col(f"`{c}`") for c in DOMAIN])
    last = rows.groupBy("file").agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in DOMAIN]), "__at").alias("last"))
    return last.select("file", F.to_json("last", {"ignoreNullFields": "false"}).alias("json"))


def write_partitioned(records: DataFrame, order: str, path: str) -> None:
    """B1 at scale: text files of one JSON a line, spread by a hash of the key, overwritten as a whole."""
    keyed(records, order).select("json").write.mode("overwrite").text(path)


def write_files(records: DataFrame, order: str, folder: str) -> DataFrame:
    """B1 as the portal's consumers expect it: ``folder/<key>.json`` with indent 4, on shared storage.

    Executors write their own files (into place by a rename, so a repeated task does no
    harm); ``file, written`` comes back, and only what was written may be registered.
    """
    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            done = []
            for name, text in zip(batch["file"], batch["json"]):
                try:
                    temporary = os.path.join(folder, f".{name}.{os.getpid()}")
                    with open(temporary, "w", encoding="utf-8") as f:
                        json.dump(json.loads(text), f, indent=4, ensure_ascii=False)
                    os.replace(temporary, os.path.join(folder, f"{name}.json"))
                    done.append(True)
                except OSError:
                    done.append(False)
            yield pd.DataFrame({"file": batch["file"], "written": done})

    return keyed(records, order).mapInPandas(put, "file string, written boolean")


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """All ``*.json`` of a folder with their base name; unreadable files are left out."""
    raw = spark.read.schema(DOMAIN_SCHEMA + ", _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", "*.json").json(folder)
    named = raw.select("*", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("file"))
    return named.where("_corrupt_record is null").drop("_corrupt_record")


def folder_stats(spark: SparkSession, folder: str) -> DataFrame:
    """``n_json`` and the sorted names of other files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", False).load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"))
    is_json = F.col("name").endswith(".json")
    return files.agg(F.count_if(is_json).alias("n_json"), F.array_join(F.sort_array(F.collect_list(F.when(~is_json, F.col("name")))), ", ").alias("others"))


def rendered_log(log: DataFrame) -> DataFrame:
    """The run log as lines of a table, newest first (``stamp, flow, result, note``)."""
    line = F.format_string("| %s | %s | %s | %s |", "stamp", "flow", "result", F.replace("note", F.lit("|"), F.lit("/")))
    return log.orderBy(F.desc("stamp"), "flow").select(line.alias("line"))
