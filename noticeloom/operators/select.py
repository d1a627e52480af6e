"""Choices among many: main documents by score, first, last and best of a key, sections, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.constants import CAPES_NEGATIVE, GENERIC_TITLES, PROEX_NEGATIVE, PROEX_POSITIVE, PRPPG_NEGATIVE, PRPPG_POSITIVE
from noticeloom.functions.text import contains_any, filled, stripped
from noticeloom.session import small


def _best(items: Column, score, least: int | None) -> Column:
    """The item of the highest score, the first of equals; null unless above ``least``."""
    scored = F.transform(items, lambda x, i: F.struct(score(x).alias("score"), (-i).alias("at"), x.alias("item")))
    top = F.array_max(scored)
    return F.when(top["score"] > least, top["item"]) if least is not None else top["item"]


def _points(cond: Column, n: int) -> Column:
    return F.when(cond, n).otherwise(0)


def main_pdf_by_path(items: Column) -> Column:
    """G1: link of the best attachment by path and words; null if none is above 0."""
    def score(a: Column) -> Column:
        text = F.concat_ws(" ", a["titulo"], a["link"])
        return _points(F.lower(a["link"]).contains("/centrais-de-conteudo/editais/"), 5) + _points(contains_any(text, ["edital"]), 4) + _points(contains_any(text, ["chamada", "publica", "pública"]), 3) - _points(contains_any(text, CAPES_NEGATIVE), 6)

    return _best(items, score, 0)["link"]


def main_pdf_by_words(items: Column) -> Column:
    """Best PDF by title and link; null if none is above 0."""
    def score(a: Column) -> Column:
        text = F.concat_ws(" ", a["titulo"], a["link"])
        return _points(contains_any(text, PROEX_POSITIVE), 6) + _points(contains_any(text, ["edital"]), 4) - _points(contains_any(text, PROEX_NEGATIVE), 7)

    return _best(F.filter(items, lambda a: a["tipo"] == "pdf"), score, 0)


def main_pdf_by_title(items: Column) -> Column:
    """Best PDF by title, whatever its score."""
    def score(a: Column) -> Column:
        return _points(contains_any(a["titulo"], PRPPG_POSITIVE), 5) + _points(contains_any(a["titulo"], ["edital"]), 4) - _points(contains_any(a["titulo"], PRPPG_NEGATIVE), 6)

    return _best(F.filter(items, lambda a: a["tipo"] == "pdf"), score, None)


def main_document(docs: Column, kind: str = "document_type") -> Column:
    """The first document of kind ``edital``, else the first."""
    return F.coalesce(F.get(F.filter(docs, lambda d: d[kind] == "edital"), F.lit(0)), F.get(docs, F.lit(0)))


def nested(rows: DataFrame, block: list[str], order: str, fields: list[str], kind: str = "document_type") -> DataFrame:
    """one row for each block: its main document and the others nested under it, in order.

    A block is a group of links on a page; exact copies of the main document vanish.
    """
    docs = F.sort_array(F.collect_list(F.struct(F.col(order).alias("__at"), *fields)))
    grouped = rows.groupBy(*block).agg(docs.alias("docs")).withColumn("main", main_document(F.col("docs"), kind))
    same = lambda d: F.struct(*[d[f] for f in fields]).eqNullSafe(F.struct(*[F.col("main")[f] for f in fields]))
    others = F.transform(F.filter("docs", lambda d: ~same(d)), lambda d: F.struct(*[d[f].alias(f) for f in fields]))
    return grouped.select(*block, *[F.col("main")[f].alias(f) for f in fields], others.alias("attachments"))


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; aggregated before the shuffle, so a key may have any number of rows."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return first.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def last_title_of(df: DataFrame, key: str, title: str, order: str) -> DataFrame:
    """Each key with its last title, at its first position (``first_pos``)."""
    return df.groupBy(key).agg(F.max_by(title, order).alias(title), F.min(order).alias("first_pos"))


def _generic(title: Column) -> Column:
    return F.lower(stripped(title)).isin([*GENERIC_TITLES, ""])


def best_title(titles: Column) -> Column:
    """Titles of one link in order, folded: a generic one gives way, then the longer one wins."""
    def step(acc: Column, t: Column) -> Column:
        better = acc.isNull() | (_generic(acc) & ~_generic(t)) | (~_generic(t) & ~_generic(acc) & (F.length(t) > F.length(acc)))
        return F.when(better, t).otherwise(acc)

    return F.aggregate(titles, F.lit(None).cast("string"), step)


def best_title_of(df: DataFrame, key: str, title: str, order: str) -> DataFrame:
    """G6 as an aggregation: each key with the title that ``best_title`` keeps of its titles in order.

    Of generic titles the first stays; null where a key has no title. Nothing is collected, so
    a key may hold any number of rows.
    """
    t = F.col(title)
    rank = F.struct((~_generic(t)).alias("real"), F.when(_generic(t), 0).otherwise(F.length(t)).alias("len"), (-F.col(order)).alias("at"))
    return df.groupBy(key).agg(F.max_by(t, F.when(t.isNotNull(), rank)).alias("title"))


def ordered_distinct(*arrays: Column) -> Column:
    """The arrays one after the other, each value at its first place."""
    return F.array_distinct(F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays]))


def merged_attachments(raw: Column, nested_docs: Column) -> Column:
    """H8: structured attachments, then the nested documents in the same shape."""
    none = F.array().cast("array<struct<titulo:string,link:string,tipo:string>>")
    tail = F.transform(nested_docs, lambda d: F.struct(d["title"].alias("titulo"), d["url"].alias("link"), d["document_type"].alias("tipo")))
    return F.concat(F.coalesce(raw, none), F.coalesce(tail, none))


def sections(df: DataFrame, page: str, pos: str, opens: Column, closes: Column | None = None) -> DataFrame:
    """Numbers entries of a page: ``opens`` starts one, rows after ``closes`` are left out.

    Rows before the first entry have entry 0 and are left out as well.
    """
    w = Window.partitionBy(page).orderBy(pos)
    out = df.withColumn("entry", F.sum(opens.cast("int")).over(w))
    if closes is not None:
        out = out.withColumn("__closed", F.sum(closes.cast("int")).over(w)).where("__closed = 0").drop("__closed")
    return out.where("entry > 0")


def pages_before_stop(df: DataFrame, page: str, in_range: Column) -> DataFrame:
    """L4: pages before the first one all of whose items are out of range (an item list pruned early)."""
    per = df.groupBy(page).agg(F.count_if(in_range).alias("kept"), F.count_if(~in_range).alias("skipped"))
    stop = per.where("kept = 0 and skipped > 0").agg(F.min(page).alias("__stop"))
    return df.crossJoin(F.broadcast(stop)).where(F.col("__stop").isNull() | (F.col(page) < F.col("__stop"))).drop("__stop").where(in_range)


def unseen(df: DataFrame, registry: DataFrame, source: str, key: str) -> DataFrame:
    """rows whose source and key are not in the registry (``source, chave``)."""
    seen = registry.where("chave is not null").select(F.col("source").alias("__s"), F.col("chave").alias("__k")).distinct()
    return df.join(small(seen), (df[source] == F.col("__s")) & (df[key] == F.col("__k")), "left_anti")


def with_lookup(df: DataFrame, table: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """``value`` looked up by ``key``, ``default`` where there is none."""
    one = table.select(key, F.col(value).alias("__v")).dropDuplicates([key])
    return df.join(small(one), key, "left").withColumn(value, F.coalesce("__v", F.lit(default))).drop("__v")


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("Column", "DataFrame", "Window", "F", "annotations", "filled")]
