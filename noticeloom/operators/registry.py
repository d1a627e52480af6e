"""The registry of processed keys as a table ``source, chave, seq``; JSON only at its border."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeloom.constants import AGENCY_SOURCES, SOURCES
from noticeloom.functions.text import filled, stripped
from noticeloom.session import small, written

SCHEMA = "source string, chave string, seq bigint"


def known_sources(df: DataFrame) -> DataFrame:
    return df.where(F.col("source").isin(SOURCES))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """The registry file ``{source: [keys]}``; a missing or broken file is an empty registry."""
    schema = ", ".join(f"{s} array<string>" for s in SOURCES)
    try:
        raw = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
        pairs = F.explode(F.create_map(*[x for s in SOURCES for x in (F.lit(s), F.coalesce(F.col(s), F.array().cast("array<string>")))]))
        rows = raw.select(pairs.alias("source", "keys")).select("source", F.posexplode("keys").alias("seq", "chave"))
        return rows.select("source", "chave", F.col("seq").cast("bigint").alias("seq"))
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], SCHEMA)
        raise


def write_json(registry: DataFrame) -> DataFrame:
    """One row with the registry as JSON, keys in order; every known source has its list."""
    lists = known_sources(registry).groupBy("source").agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", "chave"))), lambda x: x["chave"]).alias("keys"))
    every = registry.sparkSession.createDataFrame([(s,) for s in SOURCES], "source string").join(lists, "source", "left")
    keys = F.coalesce("keys", F.array().cast("array<string>"))
    return every.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("source", keys.alias("keys"))))).alias("m")).select(F.to_json("m").alias("json"))


def appended(registry: DataFrame, new: DataFrame, order: str) -> DataFrame:
    """Rows to append: unseen, non-empty keys of known sources, numbered on in their order.

    The first of equal new keys counts. The new keys are sorted by range over all tasks and
    numbered inside each range; a range goes on where the ranges before it end, so that a
    source with most of the keys is no single task. The registry is read once more, for its
    greatest ``seq``.
    """
    fresh = known_sources(new).where(filled(F.col("chave")).isNotNull()).groupBy("source", "chave").agg(F.min(order).alias("__at"))
    fresh = fresh.join(registry.select("source", "chave"), ["source", "chave"], "left_anti")
    ranges = written(fresh.repartitionByRange("source", "__at", "chave").withColumn("__range", F.spark_partition_id()), "registry-ranges")
    counts = ranges.groupBy("source", "__range").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))  # one row a range
    last = registry.groupBy("source").agg(F.max("seq").alias("__last"))
    starts = counts.select("source", "__range", F.coalesce(before, F.lit(0)).alias("__before")).join(last, "source", "left")
    n = F.row_number().over(Window.partitionBy("source", "__range").orderBy("__at", "chave"))
    numbered = ranges.withColumn("__n", n).join(small(starts), ["source", "__range"])
    return numbered.select("source", "chave", (F.coalesce("__last", F.lit(-1)) + F.col("__before") + F.col("__n")).cast("bigint").alias("seq"))


def rebuilt(registry: DataFrame, records: DataFrame, file_key: str) -> DataFrame:
    """``source, chave`` of the registry and of the written records: file key for fapes, link for the others.

    Records of agencies that are no source add nothing. Order is by key (sort when writing).
    """
    agency = F.upper(stripped("orgão_fomento"))
    source = F.try_element_at(F.create_map(*[F.lit(x) for kv in AGENCY_SOURCES.items() for x in kv]), agency)
    key = F.when(source == "fapes", F.col(file_key)).otherwise(filled(stripped("link")))
    found = records.select(source.alias("source"), key.alias("chave"))
    old = known_sources(registry).select("source", "chave")
    return old.unionByName(found).where("source is not null and chave is not null").distinct()


def counts(registry: DataFrame) -> DataFrame:
    """Keys per source."""
    return registry.where("chave is not null").groupBy("source").agg(F.count("*").alias("n"))


def deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    """``source, n_before, n_after, added``."""
    both = counts(before).withColumnRenamed("n", "n_before").join(counts(after).withColumnRenamed("n", "n_after"), "source", "full_outer").na.fill(0)
    return both.withColumn("added", F.col("n_after") - F.col("n_before"))


def keys_of(registry: DataFrame, source: str) -> DataFrame:
    """The keys of one source in order; none for an unknown source."""
    return registry.where(F.col("source") == source).orderBy("seq").select("chave")


def contains(registry: DataFrame, source: str, key: str) -> bool:
    """X8."""
    return not registry.where((F.col("source") == source) & (F.col("chave") == key)).isEmpty()


def without(registry: DataFrame, source: str) -> DataFrame:
    """T4: the registry without one source's keys, for a replay."""
    return registry.where(~F.col("source").eqNullSafe(F.lit(source)))
