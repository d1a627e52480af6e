"""One run of a portal: captured pages to registered notices; and the runner over all portals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.text import file_key
from noticeloom.operators.classify import extracted as run_extractor
from noticeloom.operators.normalize import domain_records, split_valid, with_raw_columns
from noticeloom.operators.registry import appended
from noticeloom.operators.select import unseen
from noticeloom.session import written


def run(
    raw: DataFrame, registry: DataFrame, source: str, order: str = "pos", key: str = "url",
    extractor: Callable[[bytes, str], str | None] | None = None, sink: Callable[[DataFrame], None] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(domain records, rejected raw records, registry rows to append)``.

    Records already registered are left out before anything else runs on them; a record that
    fails is rejected alone; the registry rows derive from what was written.
    """
    raw = with_raw_columns(raw).withColumn("source", F.lit(source))
    if order not in raw.columns:
        raw = raw.withColumn(order, F.monotonically_increasing_id())
    fresh = unseen(raw.withColumn("__key", file_key(F.col("title")) if source == "fapes" else F.col(key)), registry, "source", "__key").drop("__key")
    good, rejected = split_valid(fresh)
    column = None
    if extractor is not None:
        good = good.withColumn("__row", F.concat_ws(" ", F.col(order).cast("string"), "url"))
        answers = written(run_extractor(good, extractor, "__row"), "extracted")
        good = good.join(answers, "__row", "left")
        column = F.col("extracted")
    records = written(domain_records(good, column), "domain")
    if sink is not None:
        sink(records)
    keys = records.select(F.lit(source).alias("source"), (file_key(F.col("nome")) if source == "fapes" else F.col("link")).alias("chave"), order)
    return records, rejected, appended(registry, keys, order)


def run_all(flows: list[tuple[str, Callable[[], int]]], log: Callable[[str, int], None] | None = None) -> int:
    """The flows in their order, a log entry for each; the first failure ends the run."""
    for name, flow in flows:
        try:
            code = flow()
        except Exception:
            code = 1
        if log is not None:
            log(name, code)
        if code:
            return code
    return 0
