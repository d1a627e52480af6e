"""Problem 6: freely entered values to the closest entry of a reference list.

BK-trees under the Levenshtein distance, a true metric, hold the reference entries (their
content words without accents, written together) and, for words in another order and for
cut-off words, the entries' words and the beginnings of those. A value is looked up in rings
of growing radius: within a radius every entry comes out, so the first ring that holds an
entry that fits word by word has the closest one; the widest ring is wide enough for
whatever can still fit. The least distance, then the least ``ref_id``, wins.

Values and reference meet in groups of at most ``SHARD`` entries and about ``GROUP`` values,
shuffled by shard and salt; the shards' winners merge. Nothing passes through the driver.

Cases: null and blank values are no case; a value equal to an entry of its field is none
either; a value that fits none has ``ref_id`` 0; a field without entries gives 0; ties go
to the least ``ref_id``; repeated rows give equal results; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.llm.titles import STOP_WORDS, off_by, plain
from noticeloom.session import small, table, written

#: Entries in one shard, values in one group.
SHARD, GROUP = 20_000, 20_000
#: Share of letters that may differ in a word; and in a whole value whose blanks differ.
WORD_SLIP, WHOLE_SLIP = 0.3, 0.2
# --- fixed values -------------------------------------------------------------------
#: Words that people put around a value without changing what it means.
AROUND = "tema area cat categoria linha etc outros outro geral".split()
# ------------------------------------------------------------------------------------

_STOP = frozenset(STOP_WORDS)
_AROUND = frozenset(AROUND)
_LETTERS = regex.compile("[a-z0-9]+")
_WORDS = regex.compile(r"[a-z0-9]+\.?")


def content(value: str, around: bool = True) -> list[str]:
    """Content words of a value (an abbreviation keeps its dot)."""
    found = [w for w in _WORDS.findall(plain(value))]
    bare = [w for w in found if w.rstrip(".") not in _STOP and not w.rstrip(".").isdigit()]
    if around:
        bare = [w for w in bare if w.rstrip(".") not in _AROUND]
    return bare or found


class Pattern:
    """A word prepared for many distances (Levenshtein, bit-parallel)."""

    def __init__(self, word: str):
        self.word, self.size = word, len(word)
        self.at: dict[str, int] = {}
        for i, ch in enumerate(word):
            self.at[ch] = self.at.get(ch, 0) | (1 << i)

    def distance(self, other: str) -> int:
        if not self.size or not other:
            return self.size or len(other)
        full, last, at = (1 << self.size) - 1, 1 << (self.size - 1), self.at
        pv, mv, score = full, 0, self.size
        for ch in other:
            eq = at.get(ch, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | ~(xh | pv) & full
            mh = pv & xh
            if ph & last:
                score += 1
            elif mh & last:
                score -= 1
            ph = ph << 1 | 1
            pv = (mh << 1 | ~(xv | ph)) & full
            mv = ph & xv
        return score


def levenshtein(a: str, b: str) -> int:
    return Pattern(a).distance(b)


class BKTree:
    """Burkhard-Keller tree: children hang at their distance from the parent."""

    def __init__(self, words: Iterable[str]):
        self.root: tuple[str, dict] | None = None
        for w in words:
            self.add(w)

    def add(self, word: str) -> None:
        if self.root is None:
            self.root = (word, {})
            return
        node, pattern = self.root, Pattern(word)
        while True:
            d = pattern.distance(node[0])
            if d == 0:
                return
            if d not in node[1]:
                node[1][d] = (word, {})
                return
            node = node[1][d]

    def within(self, word: str, most: int, met: dict[str, int] | None = None) -> list[tuple[int, str]]:
        """Every entry at a distance of at most ``most``; ``met`` keeps the distances for a wider ring."""
        out, todo, pattern = [], [self.root] if self.root else [], Pattern(word)
        met = {} if met is None else met
        while todo:
            here, children = todo.pop()
            d = met.get(here)
            if d is None:
                d = met[here] = pattern.distance(here)
            if d <= most:
                out.append((d, here))
            if children:
                todo += [child for k, child in children.items() if d - most <= k <= d + most]
        return out


class Letters:
    """Least number of edits that any of ``words`` needs, judged by its letters alone (swaps change none)."""

    def __init__(self, words: Iterable[str]):
        words = list(words)
        self.counts = np.stack([self._count(w) for w in words]) if words else np.zeros((0, 36), np.int16)

    @staticmethod
    def _count(word: str) -> np.ndarray:
        codes = np.frombuffer(word.encode("ascii", "replace"), np.uint8).astype(np.int16)
        codes = np.where(codes >= 97, codes - 87, codes - 48)
        return np.bincount(np.clip(codes, 0, 35), minlength=36).astype(np.int16)

    def least(self, word: str) -> int:
        if not len(self.counts):
            return 1 << 20
        apart = self._count(word) - self.counts
        return int(np.maximum(np.maximum(apart, 0).sum(1), np.maximum(-apart, 0).sum(1)).min())


def slips(size: int) -> int:
    """Slips (one letter too much, missing, wrong, or two swapped) that a word of ``size`` letters may have."""
    return max(1, round(WORD_SLIP * size))


class Lookup:
    """One field's reference entries in trees: whole entries, their words, beginnings of words."""

    def __init__(self, entries: Iterable[tuple[int, str]]):
        self.whole: dict[str, list[tuple[int, tuple[str, ...]]]] = {}
        self.entries: dict[int, tuple[str, ...]] = {}
        self.having: dict[str, set[int]] = {}
        for ref, term in sorted(entries):
            words = tuple(w.rstrip(".") for w in content(term, around=False))
            self.entries[ref] = words
            for w in words:
                self.having.setdefault(w, set()).add(ref)
            for k in range(len(words)):  # lost blanks leave no words to reorder: the entry from each of its words on
                self.whole.setdefault("".join(words[k:] + words[:k]), []).append((ref, words[k:] + words[:k]))
            full = "".join(_LETTERS.findall(plain(term)))  # lost blanks
            if full != "".join(words):
                self.whole.setdefault(full, []).append((ref, (full,)))
        self.begins: dict[str, set[str]] = {}
        for w in self.having:
            for k in range(2, len(w)):
                self.begins.setdefault(w[:k], set()).add(w)
        self.ordered = sorted(self.whole)
        self.tree, self.word_tree, self.begin_tree = BKTree(self.ordered), BKTree(sorted(self.having)), BKTree(sorted(self.begins))
        self.letters, self.word_letters = Letters(self.ordered), Letters(sorted(self.having))
        self.longest = max(map(len, self.ordered), default=0)
        self.find = lru_cache(maxsize=100_000)(self._find)
        self.words_near = lru_cache(maxsize=100_000)(self._words_near)
        self.asked = lru_cache(maxsize=2_000)(lambda word: (self.word_letters.least(word), {}, {}))

    def _words_near(self, word: str, most: int) -> dict[str, int]:
        """Reference words that ``word`` (cut off if it ends with a dot) may stand for, with their distance up to ``most``."""
        stem = word.rstrip(".")
        wide = min(most, 2 * slips(len(stem) + slips(len(stem)) + 1))  # a swap is two edits of the metric
        out = {}
        least, met, begun = self.asked(stem)
        if least <= min(wide, slips(len(stem) + 4)):  # else no word is in reach by its letters alone
            for d, w in self.word_tree.within(stem, wide, met):
                s = slips(max(len(stem), len(w)))
                if d <= s or off_by(stem, w, s) <= s:
                    out[w] = d
        if len(stem) >= (2 if word.endswith(".") else 3) and stem not in self.having:
            for w in self.begins.get(stem, ()):  # cut off without a slip
                if len(w) > len(stem) + 1:
                    out[w] = 0
            if word.endswith(".") and most > 0 and len(stem) >= 3 and stem not in self.begins:
                for d, beginning in self.begin_tree.within(stem, min(most, 2), begun):
                    if d <= 1 or off_by(stem, beginning, 1) <= 1:
                        for w in self.begins[beginning]:
                            out[w] = min(out.get(w, d), d)
        return out

    def _by_words(self, words: tuple[str, ...], most: int) -> tuple[int, int] | None:
        """Least ``(distance, ref_id)`` up to ``most`` of the entries whose words the value's stand for, in any order."""
        near = [self.words_near(w, most) for w in words]
        refs: set[int] | None = None
        for options in sorted(near, key=len):
            mine = set().union(*(self.having[w] for w in options)) if options else set()
            refs = mine if refs is None else refs & mine
            if not refs:
                return None
        best = None
        for ref in refs or ():
            entry = self.entries[ref]
            if len(entry) == len(words):
                d = _assigned(near, list(entry))
                if d is not None and d <= most and (best is None or (d, ref) < best):
                    best = (d, ref)
        return best

    def _by_whole(self, words: tuple[str, ...], most: int, met: dict[str, int]) -> tuple[int, int] | None:
        """Least ``(distance, ref_id)`` up to ``most`` of the entries that the value fits as a whole."""
        reading = tuple(w.rstrip(".") for w in words)
        best = None
        for d, text in self.tree.within("".join(reading), most, met):
            for ref, order in self.whole[text]:
                if (best is None or (d, ref) < best) and self._fits(reading, order, d):
                    best = (d, ref)
        return best

    def _find(self, words: tuple[str, ...]) -> tuple[int, int] | None:
        """``(distance, ref_id)`` of the closest entry that the value fits, or None."""
        joined = "".join(w.rstrip(".") for w in words)
        widest = sum(2 * slips(len(w) + slips(len(w)) + 1) for w in words)
        # by its letters alone no entry may be in reach
        least, met = self.letters.least(joined), {}
        whole = least <= max(sum(slips(len(w) + slips(len(w)) + 1) for w in words), WHOLE_SLIP * self.longest)
        most = 0
        while True:
            found = [f for f in (self._by_words(words, most), self._by_whole(words, most, met) if whole and least <= most else None) if f]
            if found:
                return min(found)
            if most >= widest:
                break
            most = min(widest, max(most + 1, most * 2))
        if words and words[-1].endswith(".") and len(joined) >= 6:  # cut off, and its blanks lost
            i = bisect_left(self.ordered, joined)
            refs = []
            while i < len(self.ordered) and self.ordered[i].startswith(joined):
                refs += [ref for ref, _ in self.whole[self.ordered[i]]]
                i += 1
            if refs:
                return 0, min(refs)
        less = tuple(w for w in words if not w[:1].isdigit() and not any(off_by(w.rstrip("."), x, 1) <= 1 for x in AROUND if len(x) >= 3) and len(w.rstrip(".")) > 1)
        if less and less != words:
            return self._find(less)
        for x in AROUND if words else ():  # written together with what follows
            if len(words[0]) > len(x) + 3 and words[0].startswith(x):
                rest = words[0][len(x) :]
                for cut in (rest[2:] if rest.startswith("de") else None, rest):
                    if cut and (found := self._find((cut, *words[1:]))):
                        return found
        return None

    @staticmethod
    def _fits(reading: tuple[str, ...], order: tuple[str, ...], d: int) -> bool:
        """Word by word, or with few slips over all (words cut or joined elsewhere)."""
        if d <= WHOLE_SLIP * sum(map(len, order)):
            return True
        return len(reading) == len(order) and all(off_by(x, y, s) <= s for x, y, s in ((x, y, slips(max(len(x), len(y)))) for x, y in zip(reading, order)))


def _assigned(near: list[dict[str, int]], entry: list[str]) -> int | None:
    """Least total distance with a different word of ``entry`` for each of ``near``, or None (successive shortest paths)."""
    n = len(entry)
    far = 1 << 20
    cost = [[options.get(w, far) for w in entry] for options in near]
    u, v, match = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        match[0], at, way = i, 0, [0] * (n + 1)
        least, used = [far * n * 4] * (n + 1), [False] * (n + 1)
        while match[at]:
            used[at] = True
            row, delta, to = match[at], far * n * 4, 0
            for j in range(1, n + 1):
                if not used[j]:
                    reduced = cost[row - 1][j - 1] - u[row] - v[j]
                    if reduced < least[j]:
                        least[j], way[j] = reduced, at
                    if least[j] < delta:
                        delta, to = least[j], j
            for j in range(n + 1):
                if used[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            at = to
        while at:
            match[at] = match[way[at]]
            at = way[at]
    total = sum(cost[match[j] - 1][j - 1] for j in range(1, n + 1))
    return total if total < far else None


def looked_up(values: DataFrame, reference: DataFrame) -> DataFrame:
    """``campo, palavras, ref_id`` for the distinct ``campo, palavras`` (content words) of ``values``."""
    refs = reference.where("termo is not null").select("campo", "ref_id", "termo").dropDuplicates(["campo", "ref_id"])
    shards = max(1, -(-refs.count() // SHARD))
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(4 * tasks, -(-values.count() // GROUP))
    refs = refs.withColumn("shard", F.pmod(F.xxhash64("campo", "ref_id"), F.lit(shards)).cast("int")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    split = values.select("campo", "palavras", F.pmod(F.xxhash64("palavras"), F.lit(salts)).cast("int").alias("salt")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def match(mine: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        trees = {campo: Lookup(zip(rows["ref_id"], rows["termo"])) for campo, rows in own.groupby("campo")}
        found = [trees[c].find(tuple(v.split())) if c in trees else None for c, v in zip(mine["campo"], mine["palavras"])]
        return pd.DataFrame({"campo": mine["campo"], "palavras": mine["palavras"], "d": [f[0] if f else 1 << 30 for f in found], "ref_id": [f[1] if f else 0 for f in found]})

    # few bytes but much work a row: a number of tasks that isn't reduced by size
    left, right = (df.repartition(tasks, "shard", "salt").groupBy("shard", "salt") for df in (split, refs))
    parts = left.cogroup(right).applyInPandas(match, "campo string, palavras string, d int, ref_id bigint")
    if shards == 1:
        return parts.select("campo", "palavras", "ref_id")
    return parts.groupBy("campo", "palavras").agg(F.min(F.struct("d", "ref_id"))["ref_id"].alias("ref_id"))


def _read(values: DataFrame) -> DataFrame:
    """``campo, valor`` with ``palavras``, the content words."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(palavras=[" ".join(content(v)) for v in batch["valor"]])

    return values.mapInPandas(read, "campo string, valor string, palavras string")


def canonical_values(values: DataFrame, reference: DataFrame) -> DataFrame:
    """Adds ``ref_id`` to every row of ``values`` whose ``valor`` is not blank and not letter for letter an entry."""
    blank = F.length(F.trim(F.regexp_replace("valor", r"(?U)\s+", " "))) == 0
    exact = reference.where("termo is not null").select("campo", F.col("termo").alias("valor")).distinct()
    open_values = values.where("valor is not null").where(~blank).join(small(exact), ["campo", "valor"], "left_anti")
    distinct = written(_read(open_values.select("campo", "valor").distinct()), "free-values")
    found = looked_up(written(distinct.select("campo", "palavras").distinct(), "free-words"), reference)
    mapping = written(distinct.join(found, ["campo", "palavras"]).select("campo", "valor", "ref_id"), "canonical")
    return open_values.join(small(mapping), ["campo", "valor"])


def free_values(edital: DataFrame) -> DataFrame:
    categories = edital.select(F.col("edital_id").cast("bigint").alias("edital_id"), F.lit("categoria").alias("campo"), F.lit(0).alias("pos"), F.col("categoria").alias("valor"))
    tags = edital.select(F.col("edital_id").cast("bigint").alias("edital_id"), F.lit("tags").alias("campo"), F.posexplode("tags").alias("pos", "valor"))
    return categories.unionByName(tags)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = canonical_values(free_values(table(spark, sf_dir, "edital")), table(spark, sf_dir, "termo_ref"))
    return found.select("edital_id", "campo", "pos", "ref_id")
