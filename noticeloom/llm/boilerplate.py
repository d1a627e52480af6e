"""Problem 5: page boilerplate by differencing each page against the nearest pages of its host.

Pages are ordered by host and URL path (one range shuffle, so a host with a third of all
pages spans many tasks) and each is paired with the next ``NEAR`` pages of its host. The
lines of a pair are aligned by longest common subsequence (bit-parallel) on line keys: letter
case, blanks, numbers, weekdays and months apart, titles of other notices all alike, of a
path through the site the first step; and a second time on keys without names. Only lines
whose key was aligned on some pair of near pages can be deleted. Since notices of one host
share formulas too, such a line is not deleted outright: how often its key stands before
the page's own heading, between heading and text, inside the text, or behind it, counted
over all pages, tells page furniture from formulas; it only ever saves lines.

Cases: null and blank texts have no lines; blank lines are never listed; of repeated ids one
row counts; a page without a heading of its own loses only lines whose key is furniture
elsewhere; a text that is only the notice loses nothing; rows without URL are compared
within their source; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.llm.titles import plain, read_title, same_subject
from noticeloom.session import small, table, written

#: Neighbours on each side of a page.
NEAR = 4
#: Least share of positions inside the text, of those inside and behind it, for a formula of notices.
INSIDE = 0.62
#: Least share of one kind of position, for a key to be of that kind wherever it stands.
MOSTLY = 0.85
#: Least share of positions before a heading, for lines alike but for names to be furniture.
BEFORE = 0.15

_HEAD, _OTHER, _DATED, _LABEL = 1, 2, 4, 8
# --- fixed values -------------------------------------------------------------------
WEEKDAYS = "segunda-feira terca-feira quarta-feira quinta-feira sexta-feira sabado domingo".split()
MONTHS = "janeiro fevereiro marco abril maio junho julho agosto setembro outubro novembro dezembro".split()
NOTICE_KINDS = "edital chamada convocatoria selecao cp".split()
# ------------------------------------------------------------------------------------
_NAMES = re.compile(r"\b(?:" + "|".join(WEEKDAYS + MONTHS) + r")\b")
_LABELLED = re.compile(r"^([^\W\d]+(?: [^\W\d]+)?): \S")
_PATH = re.compile(r"^([^>»/|:]{1,40}?) ?(?:>|»|/|\||::) \S")
_TITLE = re.compile(r"^(?:[a-z/]+ - )?(?:" + "|".join(NOTICE_KINDS) + r")\b.{0,60}?\d{1,4} ?/ ?(?:19|20)\d\d")


@lru_cache(maxsize=50_000)
def line_key(line: str) -> str:
    text = re.sub(r"\s+", " ", plain(line)).strip()
    return re.sub(r"\d+", "0", _NAMES.sub("@", text))


@lru_cache(maxsize=50_000)
def loose_key(line: str) -> str:
    """The key without names: capitalized words inside the line, and one before a comma at its start."""
    line = re.sub(r"^\s*[^\W\d_]+,", "@,", line.strip())
    return line_key(line[:1] + re.sub(r"\b[A-ZÀ-Þ][a-zß-ÿ]+", "@", line[1:]))


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence.

    Bit-parallel: after each line of ``a`` an integer has a zero bit at each line of ``b`` at
    which the length grows; the way back reads lengths off these integers.
    """
    at: dict[int, int] = {}
    for j, y in enumerate(b):
        at[y] = at.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    grows, v = [full], full
    for x in a:
        u = v & at.get(x, 0)
        v = (v + u | v - u) & full
        grows.append(v)
    out = []
    i, j = len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i - 1, j - 1
            continue
        upto = (1 << j + 1) - 1
        if (grows[i] & upto).bit_count() == (grows[i + 1] & upto).bit_count():
            i -= 1  # as long without this line of a
        else:
            j -= 1
    return out[::-1]


def _page(raw_id: int, host: str, title: str | None, text: str) -> dict:
    keys, kinds, numbers, loose = [], [], [], []
    own_key = line_key(title or "")
    number, year, words = read_title(title)
    found = False
    for no, line in enumerate(text.split("\n")):
        key = line_key(line)
        if not key:
            continue
        kind = 0
        if _TITLE.match(plain(line).strip()):
            n, y, w = read_title(line)
            same = (n, y) == (number, year) and bool(w) and same_subject(" ".join(w), " ".join(words), 0.6)
            kind |= _HEAD if not found and (key == own_key or same) else 0 if same else _OTHER
        elif own_key and key == own_key and not found:
            kind |= _HEAD
        found |= bool(kind & _HEAD)
        kind |= _DATED if "0/0/0" in key or "0-0-0" in key else 0
        if not kind & (_HEAD | _OTHER | _DATED) and (m := _LABELLED.match(key)):
            kind |= _LABEL
            key = m[1] + ":"
        if kind & _OTHER:
            key = "@ title"
        elif not kind & _HEAD and (m := _PATH.match(key)):
            key = m[1] + " > @"
        loose.append(xxhash.xxh3_64_intdigest(loose_key(line)) - 2**63)
        keys.append(xxhash.xxh3_64_intdigest(key) - 2**63)
        kinds.append(kind)
        numbers.append(no)
    return {"raw_id": raw_id, "host": host, "keys": keys, "kinds": kinds, "numbers": numbers, "loose": loose, "shared": np.zeros(len(keys), bool), "named": np.zeros(len(keys), bool)}


def compared(pages: DataFrame) -> DataFrame:
    """``raw_id, line_no, key, loose, kind, aligned, named`` (aligned by the keys without names) of each line that is not blank."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        window: deque[dict] = deque()

        def rows(p: dict) -> pd.DataFrame:
            return pd.DataFrame({"raw_id": p["raw_id"], "line_no": p["numbers"], "key": p["keys"], "loose": p["loose"], "kind": p["kinds"], "aligned": p["shared"], "named": p["named"]})

        for batch in batches:
            out = []
            for raw_id, host, title, text in zip(batch["raw_id"], batch["host"], batch["title"], batch["text"]):
                page = _page(raw_id, host, title, text)
                for other in window:
                    if other["host"] == host:
                        for i, j in aligned(other["keys"], page["keys"]):
                            other["shared"][i] = page["shared"][j] = True
                        for i, j in aligned(other["loose"], page["loose"]):
                            other["named"][i] = page["named"][j] = True
                window.append(page)
                if len(window) > NEAR:
                    out.append(rows(window.popleft()))
            if out:
                yield pd.concat(out, ignore_index=True)
        if window:
            yield pd.concat([rows(p) for p in window], ignore_index=True)

    return pages.mapInPandas(compare, "raw_id bigint, line_no int, key bigint, loose bigint, kind int, aligned boolean, named boolean")


def furniture_lines(raw: DataFrame) -> DataFrame:
    """``raw_id, line_no``: the lines of ``raw_description`` that are not part of the notice."""
    address = F.regexp_replace(F.lower(F.trim("url")), r"^[a-z]+://(www\.)*", "")
    pages = raw.where("raw_description is not null").select(
        F.col("raw_id").cast("bigint").alias("raw_id"),
        F.coalesce(F.nullif(F.regexp_extract(address, r"^([^/:?#]+)", 1), F.lit("")), F.concat(F.lit("source "), F.coalesce("source", F.lit("")))).alias("host"),
        F.coalesce(F.regexp_extract(address, r"^[^/?#]*(/[^#]*)?", 1), F.lit("")).alias("path"),
        "title", F.col("raw_description").alias("text"),
    ).dropDuplicates(["raw_id"])
    pages = pages.repartitionByRange("host", "path", "raw_id").sortWithinPartitions("host", "path", "raw_id").select("raw_id", "host", "title", "text")
    lines = written(compared(pages), "page-lines")
    has = lambda bit: F.col("kind").bitwiseAND(bit) != 0
    heads = lines.groupBy("raw_id").agg(F.min(F.when(has(_HEAD), F.col("line_no"))).alias("head"))
    lines = lines.join(heads, "raw_id")
    # shared by near pages somewhere
    known = lines.where("aligned").select("key").distinct().withColumn("known", F.lit(True))
    lines = lines.join(small(written(known, "page-keys")), "key", "left")
    # lines that differ only in names and stand before headings elsewhere
    before = F.count_if(F.col("line_no") < F.col("head"))
    named = lines.groupBy("loose").agg(before.alias("pre"), F.count("head").alias("n"), F.max("named").alias("met")).where("met")
    named = named.select("loose", "met", F.when((F.col("pre") > 0) & (F.col("pre") >= BEFORE * F.col("n")), _OTHER).alias("furniture"))
    lines = lines.join(small(written(named, "page-loose")), "loose", "left")
    lines = lines.withColumn("shared", F.coalesce("known", F.lit(False))).withColumn("kind", F.when(F.col("shared") | has(_HEAD), F.col("kind")).otherwise(F.col("kind").bitwiseOR(F.coalesce("furniture", F.lit(0)))))
    lines = lines.withColumn("seed", ~F.col("shared") & ~has(_HEAD) & ~has(_OTHER) & ~has(_LABEL))
    body = lines.where(F.col("seed") & (F.col("head").isNull() | (F.col("line_no") > F.col("head")))).groupBy("raw_id").agg(F.min("line_no").alias("first"), F.max("line_no").alias("last"))
    lines = lines.join(body, "raw_id", "left").withColumn(
        "place",
        F.when(has(_HEAD), "head").when(F.col("line_no") < F.col("head"), "pre").when(F.col("first").isNull() | (F.col("line_no") < F.col("first")), "rem").when(F.col("line_no") <= F.col("last"), "in").otherwise("post"),
    ).select("raw_id", "line_no", "key", "kind", "shared", (F.col("shared") | F.coalesce("met", F.lit(False))).alias("met"), "place", F.col("head").isNotNull().alias("headed"), F.col("first").isNotNull().alias("bodied"))
    lines = written(lines, "page-places")
    at = lambda place: F.count_if(F.col("place") == place)
    stats = lines.where((F.col("shared") | has(_LABEL)) & F.col("headed") & F.col("bodied")).groupBy("key").agg(at("pre").alias("pre"), at("rem").alias("rem"), at("in").alias("ins"), at("post").alias("post"))
    total = F.col("pre") + F.col("rem") + F.col("ins") + F.col("post")
    kinds = stats.select(
        "key",
        (F.col("pre") >= MOSTLY * total).alias("is_pre"),
        (F.col("rem") >= MOSTLY * total).alias("is_rem"),
        (F.col("ins") + 1 >= INSIDE * (F.col("ins") + F.col("post") + 1.5)).alias("is_text"),
    )
    lines = lines.join(small(written(kinds, "page-stats")), "key", "left")
    furniture = (
        F.when(has(_HEAD), False)
        .when(F.col("place") == "pre", True)
        .when(has(_OTHER), True)
        .when(~F.col("shared") & ~has(_LABEL), F.lit(False))
        .when(F.col("is_rem") & (F.col("headed") | ~has(_DATED)), True)
        .when(has(_DATED), False)
        .when(F.col("is_pre"), True)
        .otherwise(~F.coalesce("is_text", F.lit(True)))
    )
    return lines.where(F.col("met") & furniture).select("raw_id", "line_no")


def main_text(raw: DataFrame) -> DataFrame:
    """``raw_id, text``: the descriptions without the lines of :func:`furniture_lines`."""
    gone = furniture_lines(raw).groupBy("raw_id").agg(F.collect_set("line_no").alias("gone"))
    texts = raw.where("raw_description is not null").select(F.col("raw_id").cast("bigint").alias("raw_id"), F.split("raw_description", "\n", -1).alias("lines")).dropDuplicates(["raw_id"])
    kept = F.filter("lines", lambda line, i: F.coalesce(~F.array_contains("gone", i), F.lit(True)))
    return texts.join(gone, "raw_id", "left").select("raw_id", F.array_join(kept, "\n").alias("text"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return furniture_lines(table(spark, sf_dir, "raw_edital"))
