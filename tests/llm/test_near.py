import random

import numpy as np
import pytest

from noticeloom.llm.near import allocate, near_classes, near_pairs, words_of

VOCABULARY = [f"w{i}" for i in range(3000)]


def brute(rows, t):
    sets = {i: words_of(x) for i, x in rows if x and words_of(x)}
    ids = sorted(sets)
    return {(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b])}


@pytest.mark.parametrize("t", [0.7, 0.8])
def test_recall_and_precision(spark, t):
    rng = random.Random(3)
    rows = []
    for base in range(60):
        words = rng.sample(VOCABULARY, 80)
        for k in range(5):
            kept = words[: 80 - rng.randint(0, 16)] + rng.sample(VOCABULARY, rng.randint(0, 8))
            rng.shuffle(kept)
            rows.append((base * 5 + k, " ".join(kept)))
    want = brute(rows, t)
    got = near_pairs(spark.createDataFrame(rows, "id bigint, text string"), t).collect()
    assert len(got) == len({tuple(r) for r in got})
    got = {tuple(r) for r in got}
    assert got <= want and len(got) >= 0.99 * len(want) > 50


def test_copies_nulls_and_empty(spark):
    rows = [(1, "a b c d"), (2, "D; C. B, Á"), (3, "a b c d"), (4, None), (5, ""), (6, " ... "), (7, "x y"), (3, "a b c d"), (8, "word " * 30_000)]
    df = spark.createDataFrame([(i, x, "k") for i, x in rows], "id bigint, text string, key string").select("id", "text")
    assert sorted(map(tuple, near_pairs(df, 0.8).collect())) == [(1, 2), (1, 3), (2, 3)]
    pairs, members = near_classes(df, 0.8)
    assert pairs.count() == 0 and {r.id: r.cls for r in members.collect()} == {1: 1, 2: 1, 3: 1, 7: 7, 8: 8}
    assert near_pairs(df.limit(0), 0.8).count() == 0


def test_allocation():
    cost = np.array([[0.0, 1.0, 9.0], [0.0, 5.0, 9.0], [0.0, 2.0, 9.0]])
    assert allocate(cost, np.array([0.0, 1.0, 3.0]), 2.0) == [1, 0, 1]
    assert allocate(cost, np.array([0.0, 1.0, 3.0]), 100.0) == [2, 2, 2]
