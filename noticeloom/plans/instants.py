"""Problem 2 over the notice tables: every date of ``edital`` and ``raw_edital`` as one UTC instant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.functions.timestamps import with_utc
from noticeloom.session import small, table


def date_values(edital: DataFrame, raw: DataFrame) -> DataFrame:
    """One row per date value: ``tabela, row_id, campo, pos, source, valor``."""
    ed = edital.select(
        F.lit("edital").alias("tabela"), F.col("edital_id").alias("row_id"), "source",
        F.stack(F.lit(2), F.lit("data_abertura"), F.col("data_abertura"), F.lit("data_encerramento"), F.col("data_encerramento")).alias("campo", "valor"),
    ).select("tabela", "row_id", "campo", F.lit(0).alias("pos"), "source", "valor")
    rw = raw.select("raw_id", "source", F.posexplode(F.col("raw_cronograma")["data"]).alias("pos", "valor")).select(
        F.lit("raw_edital").alias("tabela"), F.col("raw_id").alias("row_id"), F.lit("raw_cronograma").alias("campo"), "pos", "source", "valor"
    )
    return ed.unionByName(rw).where("valor is not null")


def instants(edital: DataFrame, raw: DataFrame, sources: DataFrame) -> DataFrame:
    """``tabela, row_id, campo, pos, utc``, one row per value that names one moment.

    A source without an entry in ``sources`` has no zone, so only its values that name a
    zone come out. Deliveries of the same raw record are one case: the earliest instant
    stands if they ever differ.
    """
    zones = sources.select("source", F.col("fuso").alias("__fuso")).dropDuplicates(["source"])
    values = date_values(edital, raw).join(small(zones), "source", "left")
    found = with_utc(values, "valor", "__fuso").where("utc is not null")
    return found.groupBy("tabela", "row_id", "campo", "pos").agg(F.min("utc").alias("utc"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instants(table(spark, sf_dir, "edital"), table(spark, sf_dir, "raw_edital"), table(spark, sf_dir, "fonte"))
