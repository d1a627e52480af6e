"""Problem 1: new batches against all history, through a persisted minwise index.

What a row says of its call are at most two nodes: its title (number, year, content words)
and its link. The index is a folder of Parquet files cut into buckets by a hash
(``bucket=n`` directories). A row of it is a node with its minwise band keys (over the
title's letter trigrams, bound to number and year so that calls of other numbers never meet;
one key for a link), the call it belongs to, and the words or the link, so that hits are
verified without reading any record again. Titles go by the hash of number and year, so all
keys of a title lie in one bucket: a batch of n rows opens at most 2 n buckets, whatever the
history. The number of buckets doubles whenever they hold more than ``PER_BUCKET`` nodes on
average, so the rows read follow the batch. Nodes of one place come together once, whole (not
once for each key and again for the words); there a batch finds the nodes with one of its keys,
verifies, and appends the nodes that the index lacks.

The words stand in the index in place of the whole signatures: the closer look compares
words, and nothing it would accept is rejected by a similarity estimated before.

Cases: null or blank titles and links have no node and repeat nothing; a title without
number, year or subject is only found by its link; rows with equal titles or links are one
node, never pairs; repeated ids are one row; an empty batch changes nothing; other columns
are ignored. An index opened again at its path goes on where it stood.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from noticeloom.llm.minwise import bands, grams, signature
from noticeloom.llm.titles import read_link, read_title, same_subject
from noticeloom.session import BROADCAST_BYTES, scratch, shared_dir, spread, table, written

#: Listing pages that stand for no single call, as ``read_link`` writes them.
LISTINGS = frozenset({"fapes.example/editais-abertos"})
BANDS, ROWS = 10, 2
#: Buckets of a new index, and nodes a bucket holds on average at most.
BUCKETS, PER_BUCKET = 16, 10_000
#: Nodes and edges of a batch that one task puts together; more are put together by rounds over all tasks.
TOGETHER = 500_000
#: Content words that a title needs at least, for its subject to count as named.
LEAST_WORDS = 2

_READ = "id bigint, batch_no int, named bigint, words string, link string, name_keys array<bigint>"
_NODES = "node bigint, call bigint, place bigint, words string, keys array<bigint>"


def read_rows(df: DataFrame, id_col: str, title: str, link: str, batch: str, issuers: Iterable[str], listings: frozenset[str] = LISTINGS) -> DataFrame:
    """``id, batch_no, named (number and year as one, or null), words, link, name_keys`` of each row."""
    known = tuple(sorted(issuers))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for i, no, t, u in zip(rows["id"], rows["batch_no"], rows["title"], rows["link"]):
                number, year, words = read_title(t, known)
                named, keys = None, []
                if number and year and len(words) >= LEAST_WORDS:
                    named = number * 10_000 + year
                    salt = np.uint64(xxhash.xxh3_64_intdigest(str(named)))
                    features = np.fromiter({g for w in words for g in grams(w)}, np.uint64) ^ salt
                    keys = bands(signature(features, BANDS * ROWS), ROWS)
                out.append((i, no, named, " ".join(words) if named else None, read_link(u, listings), keys))
            yield pd.DataFrame(out, columns=["id", "batch_no", "named", "words", "link", "name_keys"]).astype({"named": "Int64"})

    slim = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{title}`").alias("title"), F.col(f"`{link}`").alias("link"), F.col(f"`{batch}`").cast("int").alias("batch_no"))
    return slim.where("id is not null and batch_no is not null").mapInPandas(read, _READ)


@F.pandas_udf(BooleanType())
def _same_subject(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([x is not None and y is not None and same_subject(x, y) for x, y in zip(a, b)], dtype=bool)


def verified(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs of titles (content words in columns ``a`` and ``b``) that name the same subject."""
    return pairs.where(_same_subject(a, b))


def _counted(df: DataFrame, label: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``df`` written, and measures of it observed while it was written."""
    seen = Observation()
    out = written(df.observe(seen, *[m.alias(name) for name, m in measures.items()]), label)
    try:
        return out, seen.get
    except Py4JJavaError:  # a plan found empty on the way observes nothing
        return out, out.agg(*[m.alias(name) for name, m in measures.items()]).first().asDict()


def _light(df: DataFrame, rows: int, width: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows of ``width`` bytes are few enough.

    A batch broadcasts many times and the driver holds each for a while: a quarter of the usual bound.
    """
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES // 4 else df


def _slim(nodes: DataFrame, call: Column) -> DataFrame:
    """Nodes as ``_meet`` takes them: of each key the upper half, which together with the place tells keys apart."""
    keys = F.when(F.col("words").isNotNull(), F.transform("keys", lambda k: F.shiftright(k, 32).cast("int")))
    return nodes.select("node", "place", call.alias("call"), "words", keys.alias("keys"))


def _numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def _keyed(rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """``(key bound to its place, row)`` of each key; a link has one, its place."""
    lists = rows["keys"].combine_chunks() if isinstance(rows, pa.Table) else rows["keys"]
    has = _numbers(pc.is_valid(lists)).astype(bool)
    at = np.repeat(np.arange(rows.num_rows), np.where(has, _numbers(pc.fill_null(pc.list_value_length(lists), 0)), 1))
    key = np.zeros(len(at), np.uint64)
    key[has[at]] = _numbers(pc.list_flatten(lists)).astype(np.int64).view(np.uint64) & np.uint64(0xFFFFFFFF)
    return _numbers(rows["place"])[at].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ key, at


def _spans(lo: np.ndarray, hi: np.ndarray, most: int = 1_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(i, each number from lo[i] to below hi[i])``, about ``most`` at a time."""
    n = hi - lo
    ends, start = np.cumsum(n), 0
    while start < len(n):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
        part = n[start:stop]
        i = np.repeat(np.arange(start, stop), part)
        yield i, np.arange(len(i)) - np.repeat(np.cumsum(part) - part, part) + lo[i]
        start = stop


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, known, call`` of nodes that share a key and name the same subject.

    The batch's nodes (no ``call``) come first and stay, the index's pass by.
    """
    mine: list[pa.RecordBatch] = []
    kept: tuple | None = None

    def pairs(rows: pa.Table | pa.RecordBatch, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, old: bool) -> Iterator[pa.RecordBatch]:
        batch, _, order, at_mine = kept
        node, place, words = _numbers(batch["node"]), _numbers(batch["place"]), batch["words"]
        o_node, o_place, o_words = _numbers(rows["node"]), _numbers(rows["place"]), rows["words"]
        for i, pos in _spans(lo, hi):
            both = np.unique(at_mine[order[pos]].astype(np.int64) * rows.num_rows + at[i])
            a, b = both // rows.num_rows, both % rows.num_rows
            if not old:
                keep = (a != b) & (place[a] == place[b])
                a, b = np.divmod(np.unique(np.minimum(a, b)[keep] * rows.num_rows + np.maximum(a, b)[keep]), rows.num_rows)
            else:
                keep = place[a] == o_place[b]
                a, b = a[keep], b[keep]
            same = node[a] == o_node[b]
            look = np.flatnonzero(~same)
            (u, at_u), (v, at_v) = np.unique(a[look], return_inverse=True), np.unique(b[look], return_inverse=True)
            of_u, of_v = words.take(pa.array(u)).to_pylist(), o_words.take(pa.array(v)).to_pylist()
            same[look] = [of_u[x] is not None and of_v[y] is not None and same_subject(of_u[x], of_v[y]) for x, y in zip(at_u, at_v)]
            a, b = a[same], b[same]
            if len(a):
                calls = pa.array(_numbers(rows["call"])[b], pa.int64()) if old else pa.nulls(len(a), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(o_node[b]), calls], names=["node", "known", "call"])

    def own() -> Iterator[pa.RecordBatch]:
        nonlocal kept
        if not mine:
            return
        batch = pa.Table.from_batches(mine)
        keys, at = _keyed(batch)
        order = np.argsort(keys, kind="stable")
        kept = batch, keys[order], order, at
        yield from pairs(batch, np.arange(1, len(keys) + 1), np.searchsorted(keys[order], keys[order], "right"), at[order], False)

    for rows in batches:
        known = pc.is_valid(rows["call"])
        new, old = rows.filter(pc.invert(known)), rows.filter(known)
        if new.num_rows:
            mine.append(new)
        if old.num_rows:
            if kept is None:
                yield from own()
            if kept is not None:
                keys, at = _keyed(old)
                yield from pairs(old, np.searchsorted(kept[1], keys, "left"), np.searchsorted(kept[1], keys, "right"), at, True)
    if kept is None:
        yield from own()


class HistoryIndex:
    """The persisted index: ``seen(batch)`` gives the repeats of a batch and takes the batch in."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS, per_bucket: int = PER_BUCKET):
        self.spark, self.per_bucket = spark, per_bucket
        self.path = path or f"{shared_dir(spark)}/history-{uuid.uuid4().hex}"
        self.buckets, self.parts, self.size, self.turn = buckets, 0, 0, 0
        self.filled: set[int] = set()  # buckets that have files
        self.opened: list[int] = []  # number of buckets each batch has opened
        try:
            last = spark.read.parquet(f"{self.path}/state").orderBy(F.desc("parts")).first()
        except AnalysisException:
            last = None
        if last:
            self.buckets, self.parts, self.size, self.turn, self.filled = last["buckets"], last["parts"], last["size"], last["turn"], set(map(int, filter(None, last["filled"].split(","))))

    def _nodes(self, numbers: Iterable[int]) -> DataFrame:
        """The index's nodes of some buckets; no other directory is listed or read."""
        paths = [f"{self.path}/nodes-{self.turn}/bucket={n}" for n in sorted(self.filled.intersection(numbers))]
        return self.spark.read.schema(_NODES).parquet(*paths) if paths else self.spark.createDataFrame([], _NODES)

    def aliases(self) -> DataFrame | None:
        """``old, root``: calls that turned out to be an earlier one."""
        return self.spark.read.schema("old bigint, root bigint").parquet(f"{self.path}/aliases-{self.parts - 1}") if self.parts > 1 else None

    def _store(self, nodes: DataFrame) -> None:
        """Appends nodes to their buckets, from as many tasks as there are buckets to share out."""
        seen, measures = Observation(), [F.count("*").alias("n"), F.collect_set("bucket").alias("filled")]
        nodes = nodes.withColumn("bucket", F.pmod("place", F.lit(self.buckets)).cast("int"))
        nodes.observe(seen, *measures).repartition("bucket").sortWithinPartitions("bucket", "node").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/nodes-{self.turn}")
        try:
            got = seen.get
        except Py4JJavaError:  # a plan found empty on the way observes nothing
            got = nodes.agg(*measures).first()
        self.size += got["n"]
        self.filled.update(got["filled"])

    def _regrown(self) -> None:
        """Doubles the buckets until they are small enough; each node is rewritten once a doubling."""
        if self.size <= self.buckets * self.per_bucket:
            return
        nodes = self._nodes(self.filled)
        while self.size > self.buckets * self.per_bucket:
            self.buckets *= 2
        self.turn, self.size, self.filled = self.turn + 1, 0, set()
        self._store(nodes)

    def seen(self, rows: DataFrame) -> DataFrame:
        """``id, call``: every row of the batch with the first row of its call (itself if new)."""
        with scratch(self.spark):
            self._take(rows)
        return self.spark.read.schema("id bigint, call bigint").parquet(f"{self.path}/found/part={self.parts - 1}")

    def _take(self, rows: DataFrame) -> None:
        rows = rows.withColumn("by_title", F.when(F.col("named").isNotNull(), F.xxhash64("named", "words"))).withColumn("by_link", F.when(F.col("link").isNotNull(), F.xxhash64(F.lit("link"), "link")))
        titles = rows.where("by_title is not null").groupBy(F.col("by_title").alias("node")).agg(F.min("id").alias("first"), F.first(F.xxhash64("named")).alias("place"), F.first("words").alias("words"), F.first("name_keys").alias("keys"))
        links = rows.where("by_link is not null").groupBy(F.col("by_link").alias("node")).agg(F.min("id").alias("first")).select("node", "first", F.col("node").alias("place"), F.lit(None).cast("string").alias("words"), F.array("node").alias("keys"))
        hit = F.collect_set(F.pmod("place", F.lit(self.buckets)).cast("int"))  # at most as many numbers as there are buckets
        nodes, got = _counted(titles.unionByName(links), "batch-nodes", n=F.count("*"), hit=hit)
        n = got["n"]
        # nodes that share a key, in the batch and with the index: all keys of a title lie at its place
        together = _slim(nodes, F.lit(None).cast("bigint"))
        if self.parts:
            self.opened.append(len(self.filled.intersection(got["hit"])))
            together = together.unionByName(_slim(self._nodes(got["hit"]), F.col("call")))
        pairs = together.repartition("place").sortWithinPartitions(F.col("call").isNotNull()).mapInArrow(_meet, "node bigint, known bigint, call bigint")
        older = self.aliases()
        if older is not None:
            pairs = pairs.join(older, pairs["call"] == older["old"], "left").select("node", "known", F.coalesce("root", "call").alias("call"))
        of_rows = rows.where("by_title is not null and by_link is not null").select(F.col("by_title").alias("node"), F.col("by_link").alias("known"), F.lit(None).cast("bigint").alias("call")).distinct()
        pairs, met_by = _counted(pairs.unionByName(of_rows), "batch-pairs", edges=F.count_if(F.col("call").isNull()))
        edges, hits = pairs.where("call is null").select(F.col("node").alias("a"), F.col("known").alias("b")), pairs.where("call is not null")
        start = nodes.select("node", "first").join(hits.groupBy("node").agg(F.min("call").alias("call")), "node", "left").select("node", F.least("first", "call").alias("first"))
        labels = written(components(start, edges, n + met_by["edges"]), "batch-labels")
        t, k = _light(labels.select(F.col("node").alias("by_title"), F.col("label").alias("lt")), n, 24), _light(labels.select(F.col("node").alias("by_link"), F.col("label").alias("lk")), n, 24)
        out = rows.select("id", "by_title", "by_link").join(t, "by_title", "left").join(k, "by_link", "left").groupBy("id").agg(F.min(F.least("id", "lt", "lk")).alias("call"))
        out.write.mode("overwrite").parquet(f"{self.path}/found/part={self.parts}")
        self._append(nodes, _light(labels, n, 24), hits, n)

    def found(self) -> DataFrame:
        """``id, call`` of all batches so far."""
        return self.spark.read.schema("id bigint, call bigint, part int").parquet(f"{self.path}/found").drop("part")

    def _append(self, nodes: DataFrame, labels: DataFrame, hits: DataFrame, n: int) -> None:
        """Takes in the batch's nodes that the index lacks, and notes calls that turned out to be one."""
        new = nodes.join(labels, "node").select("node", F.col("label").alias("call"), "place", "words", "keys")
        if self.parts:
            new = new.join(hits.where("node = known").select("node"), "node", "left_anti")
            one = hits.select("node", "call").join(labels, "node").where("call <> label").groupBy(F.col("call").alias("old")).agg(F.min("label").alias("root"))
            older = self.aliases()
            if older is not None:
                kept = older.alias("x").join(one.alias("y"), F.col("x.root") == F.col("y.old"), "left").select("x.old", F.coalesce("y.root", "x.root").alias("root"))
                one = one.unionByName(kept)
            one.write.mode("overwrite").parquet(f"{self.path}/aliases-{self.parts}")
        if not self.parts:  # room for as much again
            while 2 * n > self.buckets * self.per_bucket:
                self.buckets *= 2
        self._store(new)
        self._regrown()
        self.parts += 1
        state = {"buckets": self.buckets, "parts": self.parts, "size": self.size, "turn": self.turn, "filled": ",".join(map(str, sorted(self.filled)))}
        self.spark.range(1).select(*[F.lit(v).alias(k) for k, v in state.items()]).coalesce(1).write.mode("append").parquet(f"{self.path}/state")


def _put_together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of all nodes and edges (``node, to, edge``; ``to`` is a node's ``first`` or an edge's other end): ``node, label``."""
    up: dict[int, int] = {}
    least: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = up[x]
        return x

    for rows in batches:
        edge = rows["edge"].to_numpy(bool)
        least.update(zip(rows["node"][~edge].tolist(), rows["to"][~edge].tolist()))
        for a, b in zip(rows["node"][edge].tolist(), rows["to"][edge].tolist()):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    best: dict[int, int] = {}
    for x, first in least.items():
        r = root(x)
        best[r] = min(first, best.get(r, first))
    yield pd.DataFrame({"node": pd.Series(list(least), dtype="int64"), "label": pd.Series([best[root(x)] for x in least], dtype="int64")})


def components(start: DataFrame, edges: DataFrame, size: int | None = None) -> DataFrame:
    """``node, label``: the least ``first`` in each node's connected component.

    ``start`` holds ``node, first``, ``edges`` pairs of nodes. If they are counted (``size``)
    and at most ``TOGETHER``, one task does it; else each round passes the least
    label on to the neighbours twice; then whoever shares a label also shares its
    improvement, so long chains shorten by jumps. Only nodes with an edge take part. Ends
    when a round changes nothing.
    """
    if size is not None and size <= TOGETHER:
        # no nulls: pandas would make floats of 64-bit numbers
        all_of_it = start.select("node", F.col("first").alias("to"), F.lit(False).alias("edge")).unionByName(edges.select(F.col("a").alias("node"), F.col("b").alias("to"), F.lit(True).alias("edge")))
        return all_of_it.repartition(1).mapInPandas(_put_together, "node bigint, label bigint")
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = start.withColumnRenamed("first", "label").join(both.select(F.col("a").alias("node")).distinct(), "node", "left_semi")
    labels, got = _counted(linked, "labels", n=F.count("*"))
    n = got["n"]

    def passed(now: DataFrame) -> DataFrame:
        seen = both.join(_light(now.select(F.col("node").alias("b"), "label"), n, 24), "b").select(F.col("a").alias("node"), "label", F.lit(None).cast("bigint").alias("old"))
        return now.select("node", "label", "old").unionByName(seen).groupBy("node").agg(F.min("label").alias("label"), F.min("old").alias("old"))

    turn = 0
    while True:
        turn += 1
        new = passed(passed(labels.withColumn("old", F.col("label"))))
        if turn % 2 == 0:
            new = written(new, "labels")
            jump = new.groupBy("old").agg(F.min("label").alias("jump"))
            new = new.join(_light(jump, n, 24), "old").select("node", F.least("label", "jump").alias("label"), "old")
        labels, got = _counted(new, "labels", changed=F.count_if(F.col("label") < F.col("old")))
        labels = labels.select("node", "label")
        if not got["changed"]:
            return start.join(_light(labels, n, 24), "node", "left").select("node", F.coalesce("label", "first").alias("label"))


def repeats(edital: DataFrame, issuers: Iterable[str], path: str | None = None) -> DataFrame:
    """``edital_id_a, edital_id_b``: every repeat with the first row of its call, batch by batch."""
    spark = edital.sparkSession
    rows = read_rows(spread(edital), "edital_id", "nome", "link", "batch_no", issuers)
    staged = written(rows, "history-rows", ["batch_no"])
    index = HistoryIndex(spark, path)
    for (no,) in sorted(staged.select("batch_no").distinct().collect()):  # one row a batch
        index.seen(staged.where(F.col("batch_no") == no))
    if not index.parts:
        return spark.createDataFrame([], "edital_id_a bigint, edital_id_b bigint")
    return index.found().where("id <> call").select(F.col("call").alias("edital_id_a"), F.col("id").alias("edital_id_b"))


def issuer_words(fonte: DataFrame) -> list[str]:
    """The words of the issuers' short names; ``fonte`` is a reference table of bounded size."""
    return sorted({w for (s,) in fonte.select("sigla").where("sigla is not null").distinct().collect() for w in s.lower().split("/")})


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "edital"), issuer_words(table(spark, sf_dir, "fonte")))
