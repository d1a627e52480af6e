"""Portals end to end over captured pages: listing, exclusion, detail, records, sink, registry."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.operators.normalize import with_raw_columns
from noticeloom.operators.select import first_of, pages_before_stop, unseen
from noticeloom.plans.pipeline import run
from noticeloom.session import written
from noticeloom.sources import portals

#: Captured pages: of which portal and kind, their number in the listing, address, text, and the form target behind which they lay.
PAGES = "source string, kind string, page_no int, url string, html string, target string"
#: Captured files: address, declared type, bytes.
FILES = "url string, content_type string, content binary"


def fetched(requests: DataFrame, fetch: Callable[[str], tuple[str, bytes] | None], key: str = "url") -> DataFrame:
    """``FILES`` rows for the distinct addresses of ``requests``, by a function of the caller.

    The function runs on the executors, once an address; one that fails or gives nothing has
    no row, and the others are not touched by it.
    """

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url in batch["url"]:
                try:
                    got = fetch(url)
                except Exception:
                    got = None
                if got is not None:
                    rows.append((url, *got))
            yield pd.DataFrame(rows, columns=["url", "content_type", "content"])

    return requests.where(F.col(key).isNotNull()).select(F.col(key).alias("url")).distinct().mapInPandas(get, FILES)


def documents_only(files: DataFrame, portal: str) -> DataFrame:
    """A10: the files that a portal accepts as a PDF: by declared type or by ending, and of CNPq by type alone."""
    typed = F.coalesce(F.lower("content_type").contains("pdf"), F.lit(False))
    named = F.lower("url").endswith(".pdf")
    return files.where((typed if portal == "cnpq" else typed | named) & F.col("content").isNotNull())


def with_content(raw: DataFrame, files: DataFrame, main: str = "main_url") -> DataFrame:
    """The records with the bytes of their main document, where they were captured."""
    if main not in raw.columns:
        return raw
    kept = files.select(F.col("url").alias("__main"), F.col("content").alias("pdf_content")).dropDuplicates(["__main"])
    return raw.drop("pdf_content").join(kept, F.col(main) == F.col("__main"), "left").drop("__main", main)


def joined_pages(recognized: DataFrame, key: str = "file", page: str = "page_no", text: str = "markdown") -> DataFrame:
    """One text for each document, its recognized pages in order, each after a line break."""
    lines = F.transform(F.sort_array(F.collect_list(F.struct(page, text))), lambda p: F.concat(F.lit("\n"), F.coalesce(p[text], F.lit(""))))
    return recognized.groupBy(key).agg(F.array_join(lines, "").alias("text"))  # the pages of one document


def skip_set(spark: SparkSession, registry: DataFrame, source: str, folder: str | None) -> DataFrame:
    """The registry's keys, and for a portal known by file keys also those of the files already written."""
    keys = registry.select("source", "chave")
    if folder is None or source != "fapes":
        return keys
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder)  # names only, nothing is opened
    return keys.unionByName(files.select(F.lit(source).alias("source"), F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.json$", "").alias("chave")))


def listed(portal: portals.Portal, pages: DataFrame, year: int, max_pages: int | None = None) -> DataFrame:
    """What the listing pages of a portal name, all pages and start addresses as one, each address once.

    ``max_pages`` is the page limit of L3; a portal with gates by page stops at the first
    page that has nothing of the year (L4).
    """
    own = pages.where((F.col("source") == portal.source) & (F.col("kind") == "listing"))
    if max_pages is not None:
        own = own.where(F.col("page_no") <= max_pages)
    found = portal.listing(own, year) if portal.by_year else portal.listing(own)
    if portal.source == "finep":
        found = found.withColumnRenamed("page", "__page").join(own.select(F.col("url").alias("__page"), "page_no"), "__page")
        return first_of(pages_before_stop(found, "page_no", F.col("in_range")), ["url"], ["page_no", "pos"])
    if portal.source == "prppg_ifes":
        return found.where((F.coalesce("start_date", F.lit("")) == "") | F.col("start_date").startswith(str(year)))
    return found


def raw_records(portal: portals.Portal, pages: DataFrame, year: int, known: DataFrame, max_pages: int | None = None) -> DataFrame:
    """F8: records of one portal: its listing without what is known, joined with the captured detail pages.

    Where the listing has the records themselves (no detail page), they are passed on.
    """
    found = listed(portal, pages, year, max_pages).withColumn("source", F.lit(portal.source))
    if portal.detail is None:
        return found
    details = pages.where((F.col("source") == portal.source) & (F.col("kind") == "detail"))
    if portal.source == "prppg_ifes":  # behind a form: the page was captured under the listing's form target
        join = details.select(F.col("url").alias("__url"), "html", F.col("target").alias("__target"))
        both = found.join(join, found["target"] == F.col("__target")).select(F.col("__url").alias("url"), "title", "status", "start_date", "end_date", "html")
        both = unseen(both.withColumn("source", F.lit(portal.source)), known, "source", "url")
    else:
        both = unseen(found, known, "source", "url").select("url", "title").join(details.select("url", "html"), "url")
    return portal.detail(both, year) if portal.detail_by_year else portal.detail(both)


def ingest(portal: portals.Portal, pages: DataFrame, registry: DataFrame, year: int, files: DataFrame | None = None, folder: str | None = None, max_pages: int | None = None, **more) -> tuple[DataFrame, DataFrame, DataFrame, dict[str, int]]:
    """``(records, rejected, registry rows to append, totals)`` of one portal.

    ``totals`` counts what was extracted, accepted and rejected.
    """
    spark = pages.sparkSession
    known = skip_set(spark, registry, portal.source, folder)
    raw = raw_records(portal, pages, year, known, max_pages)
    raw = with_content(raw, documents_only(files, portal.source)) if files is not None else raw.drop("main_url")
    raw = written(with_raw_columns(raw).withColumn("pos", F.monotonically_increasing_id()), "flow-raw")
    skipped = known.withColumn("seq", F.lit(-1).cast("bigint")).join(registry.select("source", "chave"), ["source", "chave"], "left_anti")
    records, rejected, added = run(raw, registry.select("source", "chave", "seq").unionByName(skipped), portal.source, **more)
    return records, rejected, added, {"extracted": raw.count(), "accepted": records.count(), "rejected": rejected.count()}


def ingest_all(pages: DataFrame, registry: DataFrame, year: int, **more) -> DataFrame:
    """The records of all portals as one table, in the order of the portals."""
    out = None
    for portal in portals.PORTALS:
        records = ingest(portal, pages, registry, year, **more)[0].withColumn("source", F.lit(portal.source))
        out = records if out is None else out.unionByName(records, allowMissingColumns=True)
    return out
