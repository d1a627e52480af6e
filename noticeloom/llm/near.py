"""Problem 3: groups of records whose word sets nearly agree, by a generalised pigeonhole search.

Each word set becomes a vector of minwise symbols (one byte each). Symbols are grouped into
partitions, alike ones together (by their measured rate of chance agreement). A partition
with threshold t is probed with keys that any two vectors share there if they differ in at
most t of its symbols: t = 0 the whole partition, t = 1 each way to leave out one symbol,
t = -1 not at all. The thresholds are allocated by dynamic programming over all partitions:
least estimated work (keys plus candidate pairs, the latter estimated from second-moment
sketches over all records) under a bound on the chance that a pair at exactly the wanted
similarity is missed. Candidates pass a 128-bit sketch comparison inside the join, whose
own chance to lose such a pair is part of the bound, and are then verified on the true
word sets.

The classical bound (thresholds that sum to the distance guarantee a hit) needs as many
partitions as words may differ, here 34 of some 3 words each, which nearly every pair
shares somewhere; hence the bound on the miss chance (``MISS``) in its place.

Cases: null or blank texts and rows without words have no partner; equal word sets form one
class whose first row stands for it in the search; repeated ids are one row; other columns
are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.llm.minwise import family
from noticeloom.llm.titles import unmarked
from noticeloom.session import BROADCAST_BYTES, spread, table, written

WIDTH, PARTITIONS = 5, 40
SYMBOLS = WIDTH * PARTITIONS
#: Chance that a pair at exactly the wanted similarity is missed, and the part of it that the sketch may take.
MISS, MISS_SKETCH = 0.002, 0.0002
#: Work of one key against one candidate pair.
KEY_WORK = 40.0
_CELLS = 512
_BITS = 128

_WORD = re.compile("[a-z0-9]+")
_ASCII = bytes(range(128))
_APART = bytes(c if chr(c) in "abcdefghijklmnopqrstuvwxyz0123456789" else 32 for c in range(256))
#: Bytes of combining characters (U+0300 to U+036F) and second and later bytes of all others.
_DROPPED = bytes([0xCC, 0xCD, *range(0x80, 0xC0)])


def words_of(text: str) -> set[str]:
    """Runs of a-z and 0-9 after lower case and removal of diacritics (NFKD)."""
    return {w.decode() for w in _prepared(text).split()}


@lru_cache(maxsize=100_000)
def _usual(ch: str) -> bool:
    """Whether a character outside ASCII is a mark of the usual block, or neither a mark nor written in its bytes."""
    return "\u0300" <= ch <= "\u036f" or not unicodedata.combining(ch) and not "\u0370" <= ch <= "\u037f"


def _prepared(text: str) -> bytes:
    """The words with blanks between: marks vanish, all else but a-z and 0-9 separates."""
    text = unicodedata.normalize("NFKD", text.lower())
    raw = text.encode("utf-8", "replace")
    if text.isascii() or all(map(_usual, set(raw.translate(None, _ASCII).decode()))):
        return raw.translate(_APART, _DROPPED)
    return " ".join(_WORD.findall(unmarked(text))).encode()


#: Texts, and bytes of them, hashed at once.
_TEXTS, _BYTES = 2_048, 1 << 20
_BASE = 0x9E3779B97F4A7C15
_HASH = np.uint64((1 << 48) - 1)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of the rolling hash modulo 2^64, and of its inverse."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(size, base, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def _chunk_hashes(texts: list[bytes]) -> list[np.ndarray]:
    joined = b" ".join(texts) + b" "
    u = np.frombuffer(joined, np.uint8)
    inside = np.zeros(len(u) + 1, np.int8)
    inside[1:] = u != 32
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(1 << max(10, (len(u) - 1).bit_length()))
    total = np.zeros(len(u) + 1, np.uint64)
    np.cumsum(u.astype(np.uint64) * power[: len(u)], out=total[1:])
    h = (total[end] - total[start]) * inverse[start]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    text = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(np.searchsorted(start, np.concatenate(([0], np.cumsum(size))))))
    both = text << np.uint64(48) | h >> np.uint64(16)
    both.sort()
    both = both[np.concatenate(([True], both[1:] != both[:-1]))[: len(both)]]
    cut = np.searchsorted(both, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(48))
    both &= _HASH
    return [both[x:y] for x, y in zip(cut[:-1], cut[1:])]


def word_hashes(texts: Iterable[str]) -> Iterator[np.ndarray]:
    """The distinct words of each text as ascending 48-bit hashes; many texts are hashed in one go."""
    held, size = [], 0
    for text in texts:
        held.append(_prepared(text))
        size += len(held[-1])
        if len(held) == _TEXTS or size > _BYTES:
            yield from _chunk_hashes(held)
            held, size = [], 0
    if held:
        yield from _chunk_hashes(held)


def _set_hash(h: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit hashes of a set of word hashes."""
    mixed = h * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    both = np.array([mixed.sum(), (mixed * np.uint64(0xC2B2AE3D27D4EB4F) ^ mixed >> np.uint64(29)).sum()], np.uint64).view(np.int64)
    return int(both[0]), int(both[1])


def sketches(texts: DataFrame) -> DataFrame:
    """``id, text`` to ``id, low, high (hash of the set), symbols, s0, s1 (the first symbols' low bits)``."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = (x.astype(np.uint32) for x in family(SYMBOLS, 11))
        for batch in batches:
            ids, low, high, symbols = [], [], [], []
            for i, h in zip(batch["id"], word_hashes(batch["text"])):
                if not len(h):
                    continue
                one, two = _set_hash(h)
                ids.append(i)
                low.append(one)
                high.append(two)
                x = h.astype(np.uint32)[:, None] * a
                x += b
                symbols.append((x.min(axis=0) >> np.uint32(8)).astype(np.uint8))
            if ids:
                m = np.stack(symbols)
                bits = np.packbits(m[:, :_BITS] & 1, axis=1)
                s = np.ascontiguousarray(bits).view(np.int64)
                yield pd.DataFrame({"id": ids, "low": low, "high": high, "symbols": [r.tobytes() for r in m], "s0": s[:, 0], "s1": s[:, 1]})

    return texts.mapInPandas(sketch, "id bigint, low bigint, high bigint, symbols binary, s0 bigint, s1 bigint")


def _columns(order: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """All possible keys: per partition its whole, then each way to leave out one symbol."""
    out = []
    for p in range(PARTITIONS):
        part = order[p * WIDTH : (p + 1) * WIDTH]
        out += [(p, part)] + [(p, np.delete(part, k)) for k in range(WIDTH)]
    return out


def _mixed(m: np.ndarray, which: np.ndarray, seed: int) -> np.ndarray:
    """64-bit keys of the symbols ``which`` of each row of ``m``."""
    x = np.zeros(len(m), np.uint64)
    for w in which:
        x = (x << np.uint64(8)) | m[:, w].astype(np.uint64)
    x = (x + np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _alone(rows: DataFrame) -> np.ndarray:
    """Number of pairs of all rows that agree in each single symbol, from its value counts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((SYMBOLS, 256), np.int64)
        for batch in batches:
            if len(batch):
                m = np.frombuffer(b"".join(batch["symbols"]), np.uint8).reshape(-1, SYMBOLS)
                for c in range(SYMBOLS):
                    total[c] += np.bincount(m[:, c], minlength=256)
        if total.any():
            c, cell = np.indices(total.shape)
            yield pd.DataFrame({"c": c.ravel(), "cell": cell.ravel(), "n": total.ravel()})

    sums = rows.select("symbols").mapInPandas(count, "c int, cell int, n bigint").groupBy("c", "cell").agg(F.sum("n").cast("double").alias("n"))
    pairs = np.zeros(SYMBOLS)
    for r in sums.groupBy("c").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs")).collect():  # one row for each symbol
        pairs[r["c"]] = r["pairs"]
    return pairs


def _moments(rows: DataFrame, columns: list[np.ndarray]) -> np.ndarray:
    """Estimated number of pairs of all rows that agree in each of ``columns`` (sets of symbols).

    A signed-counter sketch of the second moment: each task adds up its rows, Spark the tasks.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(columns), _CELLS))
        n = 0
        for batch in batches:
            if not len(batch):
                continue
            m = np.frombuffer(b"".join(batch["symbols"]), np.uint8).reshape(-1, SYMBOLS)
            n += len(m)
            for c, which in enumerate(columns):
                key = _mixed(m, which, c)
                sign = 1.0 - 2.0 * (key & np.uint64(1)).astype(float)
                total[c] += np.bincount((key >> np.uint64(55)).astype(np.int64), weights=sign, minlength=_CELLS)
        if n:
            c, cell = np.indices(total.shape)
            yield pd.DataFrame({"c": c.ravel(), "cell": cell.ravel(), "v": total.ravel(), "n": np.where((c == 0) & (cell == 0), n, 0).ravel()})

    sums = rows.select("symbols").mapInPandas(count, "c int, cell int, v double, n bigint").groupBy("c", "cell").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    got = sums.groupBy("c").agg(F.sum(F.col("v") * F.col("v")).alias("f2"), F.sum("n").alias("n")).collect()  # one row for each column
    n = sum(r["n"] for r in got)
    pairs = np.zeros(len(columns))
    for r in got:
        pairs[r["c"]] = max(0.0, (r["f2"] - n) / 2)
    return pairs


def allocate(cost: np.ndarray, gain: np.ndarray, need: float, steps: int = 400) -> list[int]:
    """One option for each partition: least total ``cost`` with total ``gain`` of at least ``need``.

    ``cost[p, o]`` and ``gain[o]``; dynamic programming over the gain in ``steps`` steps
    (rounded down, so the need is really met).
    """
    unit = need / steps
    worth = np.floor(gain / unit).astype(int)
    best = np.full(steps + 1, np.inf)
    best[0] = 0
    choice = []
    for p in range(len(cost)):
        new, took = np.full(steps + 1, np.inf), np.zeros((steps + 1, 2), int)
        for s in range(steps + 1):
            if math.isfinite(best[s]):
                for o in range(cost.shape[1]):
                    t = min(steps, s + worth[o])
                    if best[s] + cost[p, o] < new[t]:
                        new[t], took[t] = best[s] + cost[p, o], (o, s)
        best = new
        choice.append(took)
    if not math.isfinite(best[steps]):
        return [cost.shape[1] - 1] * len(cost)  # not to be met: everything at the widest threshold
    out, s = [], steps
    for took in reversed(choice):
        o, s = took[s]
        out.append(int(o))
    return out[::-1]


def plan(classes: DataFrame, similarity: float) -> list[np.ndarray]:
    """The symbol sets to probe with, from counts over all classes."""
    columns = _columns(np.argsort(_alone(classes), kind="stable"))
    pairs = _moments(classes, [which for _, which in columns]).reshape(PARTITIONS, WIDTH + 1)
    n = classes.count()
    agree = similarity + (1 - similarity) / 256
    hit0 = agree**WIDTH
    hit1 = hit0 + WIDTH * agree ** (WIDTH - 1) * (1 - agree)
    cost = np.stack([np.zeros(PARTITIONS), pairs[:, 0] + KEY_WORK * n, pairs[:, 1:].sum(axis=1) + KEY_WORK * n * WIDTH], axis=1)
    options = allocate(cost, np.array([0.0, -math.log1p(-hit0), -math.log1p(-hit1)]), -math.log(MISS - MISS_SKETCH))
    chosen = []
    for p, o in enumerate(options):
        own = [which for q, which in columns if q == p]
        chosen += [] if o == 0 else own[:1] if o == 1 else own[1:]
    return chosen


def _probes(classes: DataFrame, chosen: list[np.ndarray]) -> DataFrame:
    """``key, id, s0, s1`` for each probe of each class."""

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            m = np.frombuffer(b"".join(batch["symbols"]), np.uint8).reshape(-1, SYMBOLS)
            keys = np.stack([_mixed(m, which, 10_000 + c) for c, which in enumerate(chosen)], axis=1).view(np.int64)
            k = len(chosen)
            yield pd.DataFrame({"key": keys.ravel(), "id": np.repeat(batch["id"].to_numpy(), k), "s0": np.repeat(batch["s0"].to_numpy(), k), "s1": np.repeat(batch["s1"].to_numpy(), k)})

    return classes.select("id", "symbols", "s0", "s1").mapInPandas(probe, "key bigint, id bigint, s0 bigint, s1 bigint")


def _far(similarity: float) -> int:
    """Sketch bits that may differ, so that a pair at the wanted similarity is lost with a chance of at most ``MISS_SKETCH``."""
    p = (1 - similarity) * (1 - 1 / 256) / 2
    t, kept = -1, 0.0
    while kept < 1 - MISS_SKETCH and t < _BITS:
        t += 1
        kept += math.comb(_BITS, t) * p**t * (1 - p) ** (_BITS - t)
    return t


def near_classes(texts: DataFrame, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """``(pairs a, b, similarity of class representatives; membership id, cls)`` of ``id, text`` rows.

    a < b; a class's representative is the least id with its word set.
    """
    texts = texts.where("text is not null").dropDuplicates(["id"]) if not _unique(texts) else texts.where("text is not null")
    rows = written(sketches(spread(texts)), "near-symbols")
    first = rows.groupBy("low", "high").agg(F.min("id").alias("cls"))
    members = rows.select("id", "low", "high").join(first, ["low", "high"]).select("id", "cls")
    copies = written(members.where("id <> cls"), "near-copies")
    gone = copies.select("id")
    classes = rows.join(F.broadcast(gone) if copies.count() * 24 <= BROADCAST_BYTES else gone, "id", "left_anti")
    chosen = plan(classes, similarity)
    probes = _probes(classes, chosen)
    a = probes.select("key", F.col("id").alias("a"), F.col("s0").alias("p0"), F.col("s1").alias("p1"))
    b = probes.select("key", F.col("id").alias("b"), F.col("s0").alias("q0"), F.col("s1").alias("q1"))
    far = F.bit_count(F.col("p0").bitwiseXOR(F.col("q0"))) + F.bit_count(F.col("p1").bitwiseXOR(F.col("q1")))
    candidates = a.join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & (far <= _far(similarity))).select("a", "b")
    candidates = written(candidates.distinct(), "near-candidates")
    return verified(texts, candidates, similarity), rows.select("id").join(copies, "id", "left").select("id", F.coalesce("cls", "id").alias("cls"))


def _unique(texts: DataFrame) -> bool:
    return bool(texts.select((F.count("*") == F.count_distinct("id")).alias("u")).first()["u"])


def verified(texts: DataFrame, candidates: DataFrame, similarity: float) -> DataFrame:
    """The candidates ``a, b`` whose word sets truly agree to ``similarity``."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "words": [(h >> np.uint64(16)).astype(np.uint32).tobytes() for h in word_hashes(batch["text"])]})

    @F.pandas_udf("double")
    def jaccard(x: pd.Series, y: pd.Series) -> pd.Series:
        n, m = x.str.len().to_numpy() // 4, y.str.len().to_numpy() // 4
        pair = np.arange(len(n), dtype=np.uint64) << np.uint64(32)
        merged = np.concatenate([np.frombuffer(b"".join(z), np.uint32) | np.repeat(pair, k) for z, k in ((x, n), (y, m))])
        merged.sort()
        again = merged[1:][merged[1:] == merged[:-1]] >> np.uint64(32)
        both = np.bincount(again.astype(np.int64), minlength=len(n))
        return pd.Series(both / (n + m - both))

    wanted = written(candidates.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "near-ids")
    found = spread(texts).join(F.broadcast(wanted) if wanted.count() * 24 <= BROADCAST_BYTES else wanted, "id", "left_semi").mapInPandas(sets, "id bigint, words binary")
    x, y = found.withColumnsRenamed({"id": "a", "words": "wa"}), found.withColumnsRenamed({"id": "b", "words": "wb"})
    pairs = candidates.join(x, "a").join(y, "b").withColumn("similarity", jaccard("wa", "wb"))
    return pairs.where(F.col("similarity") >= similarity).select("a", "b", "similarity")


def near_pairs(texts: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``a, b``: all pairs of rows, copies included, whose word sets agree to ``similarity``."""
    pairs, members = near_classes(texts, similarity)
    members = written(members, "near-members")
    x, y = members.withColumnsRenamed({"id": "x", "cls": "a"}), members.withColumnsRenamed({"id": "y", "cls": "b"})
    across = pairs.join(x, "a").join(y, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    many = members.groupBy("cls").agg(F.count("*").alias("n")).where("n > 1").select("cls")
    copies = members.join(many, "cls")
    inside = copies.alias("p").join(copies.alias("q"), "cls").where("p.id < q.id").select(F.col("p.id").alias("a"), F.col("q.id").alias("b"))
    return across.unionByName(inside)


def notice_texts(edital: DataFrame) -> DataFrame:
    has_text = F.length(F.trim(F.regexp_replace("descrição", r"(?U)\s+", " "))) > 0
    return edital.where(has_text).select(F.col("edital_id").cast("bigint").alias("id"), F.concat_ws(" ", F.coalesce("nome", F.lit("")), "descrição").alias("text"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_pairs(notice_texts(table(spark, sf_dir, "edital")), 0.7)
    return found.select(F.col("a").alias("edital_id_a"), F.col("b").alias("edital_id_b"))
