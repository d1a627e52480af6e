"""Problem 7: items into containers of fixed capacity by best-two-fit.

Items are spread over groups of bounded size by a hash (a source or text that fills a third
of the table is spread like any other), each group is packed by one task, and the items of
the containers left with much room are packed again in fewer groups until one is left.

Cases: null and empty texts have no tokens and go into no container; a text above the
capacity, and only such a text, is cut into pieces of the capacity and a rest; ties in size
are broken by id; repeated rows are items of their own; an empty table gives none; other
columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.llm.tokens import VOCABULARY, token_counts
from noticeloom.session import table, written

CAPACITY = 2048
#: Items in one group, and the share of a container that may stay empty before it is packed again.
GROUP, ROOM = 20_000, 0.01


def best_two_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Containers as lists of item indices (each size between 1 and ``capacity``).

    A container takes the largest item that fits, again and again; then its smallest item
    is exchanged for the two waiting ones that fill the widened gap best, if they do so
    better than before.
    """
    pool: dict[int, list[int]] = defaultdict(list)
    for i in sorted(range(len(sizes)), key=lambda i: -i):
        pool[sizes[i]].append(i)
    present = 0
    for s in pool:
        present |= 1 << s

    def largest(most: int) -> int:
        return (present & ((1 << (most + 1)) - 1)).bit_length() - 1 if most > 0 else -1

    def take(s: int) -> int:
        nonlocal present
        item = pool[s].pop()
        if not pool[s]:
            present &= ~(1 << s)
        return item

    def give(item: int) -> None:
        nonlocal present
        pool[sizes[item]].append(item)
        present |= 1 << sizes[item]

    out = []
    while present:
        held: list[int] = []
        gap = capacity
        while gap and (s := largest(gap)) > 0:
            held.append(take(s))
            gap -= s
        if gap and held and present:
            small = held[-1]
            room = gap + sizes[small]
            best, pair = sizes[small], None
            a = largest(room - 1)
            while a > 0 and 2 * a >= best:
                twice = len(pool[a]) > 1
                b = largest(min(a, room - a)) if twice or room - a < a else largest(a - 1)
                if b > 0 and a + b > best:
                    best, pair = a + b, (a, b)
                    if best == room:
                        break
                a = largest(a - 1)
            if pair:
                held.pop()
                held += [take(pair[0]), take(pair[1])]
                give(small)
        out.append(held)
    return out


def _packed(items: DataFrame, groups: int, capacity: int, label: str) -> DataFrame:
    """``container, fill`` added to ``doc_id, part, size``, by ``groups`` tasks."""

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "doc_id", "part", "copy"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        rows["container"], rows["fill"] = "", 0
        names, fills = [""] * len(rows), [0] * len(rows)
        sizes = rows["size"].tolist()
        for n, held in enumerate(best_two_fit(sizes, capacity)):
            fill = sum(sizes[i] for i in held)
            for i in held:
                names[i], fills[i] = f"{label}-{key[0]}-{n}", fill
        return rows.assign(container=names, fill=fills)[["doc_id", "part", "copy", "size", "container", "fill"]]

    grouped = items.select("doc_id", "part", "copy", "size", F.pmod(F.xxhash64("doc_id", "part", "copy"), F.lit(groups)).cast("int").alias("grp"))
    return grouped.groupBy("grp").applyInPandas(pack, "doc_id bigint, part int, copy bigint, size int, container string, fill int")


def containers(sized: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, part, size, container, fill`` for rows of ``doc_id, n_tokens``.

    ``part`` numbers the pieces of an item that alone exceeds ``capacity``; ``fill`` is what
    its container holds in all.
    """
    rows = sized.where("n_tokens > 0").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("n_tokens").cast("bigint").alias("n"), F.monotonically_increasing_id().alias("copy"))
    rows = written(rows, "pack-items")
    parts = rows.select("doc_id", "copy", "n", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / capacity).cast("int") - 1)).alias("part"))
    parts = parts.select("doc_id", "copy", "part", F.least(F.lit(capacity), F.col("n") - F.col("part") * capacity).cast("int").alias("size"))
    full = parts.where(F.col("size") == capacity).select("doc_id", "part", "size", F.concat_ws("-", F.lit("full"), "doc_id", "copy", "part").alias("container"), F.lit(capacity).alias("fill"))
    waiting, done, turn = parts.where(F.col("size") < capacity), full, 0
    n = waiting.count()
    while True:
        groups = max(1, -(-n // GROUP))
        packed = written(_packed(waiting, groups, capacity, f"t{turn}"), "packed")
        tight = packed if groups == 1 else packed.where(F.col("fill") >= (1 - ROOM) * capacity)
        done = done.unionByName(tight.select("doc_id", "part", "size", "container", "fill"))
        if groups == 1:
            return done
        waiting = packed.where(F.col("fill") < (1 - ROOM) * capacity).select("doc_id", "copy", "part", "size")
        left, turn = waiting.count(), turn + 1
        if -(-left // GROUP) >= groups:  # no progress: what is left stays as packed
            return done.unionByName(packed.where(F.col("fill") < (1 - ROOM) * capacity).select("doc_id", "part", "size", "container", "fill"))
        n = left


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return containers(token_counts(docs.where("text is not null")))
