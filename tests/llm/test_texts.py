"""Splitting, packing, mixing and page furniture."""

import random

import pytest
from pyspark.sql import functions as F

from noticeloom.llm.boilerplate import aligned, furniture_lines, main_text
from noticeloom.llm.mix import mixed
from noticeloom.llm.pack import best_two_fit, containers
from noticeloom.llm.split import merged, split_documents, split_text
from noticeloom.llm.tokens import token_counts, token_ends, tokenizer


def long_text(kind, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnoéãç") for _ in range(rng.randint(2, 9)))
    if kind == "prose":
        return "\n\n".join(" ".join(word() for _ in range(rng.randint(20, 160))) + "." for _ in range(60))
    if kind == "one line":
        return " ".join(word() for _ in range(4000))
    if kind == "no blanks":
        return "".join(word() for _ in range(3000))
    if kind == "blanks":
        return "a" + " " * 30_000 + "b" + "\n" * 9_000
    return "😀é漢" * 3000


@pytest.mark.parametrize("kind", ["prose", "one line", "no blanks", "blanks", "symbols"])
def test_pieces(kind):
    text, enc = long_text(kind), tokenizer()
    pieces = split_text(text)
    assert len(pieces) > 1 or kind == "blanks"
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for (a, b, n, _), (c, _, _, shared) in zip(pieces, pieces[1:]):
        assert a < c <= b and shared <= 128
    assert all(len(enc.encode_ordinary(text[a:b])) <= 2048 for a, b, _, _ in pieces)
    whole = text[: pieces[0][1]] + "".join(text[p[1] : q[1]] for p, q in zip(pieces, pieces[1:]))
    assert whole == text
    if kind == "prose":
        assert all(text[: b].endswith("\n\n") for _, b, _, _ in pieces[:-1])
        assert all(q[3] == 128 for q in pieces[1:])


def test_merging_prefers_weak_boundaries():
    assert merged([3, 3, 3, 3], [1, 5, 1], 6) == [0, 2]
    assert merged([5, 5], [1], 9) == [0, 1] and merged([4], [], 9) == [0]


def test_split_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "short", "x"), (4, long_text("prose"), "x"), (4, long_text("prose"), "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, start string")
    got = split_documents(df)
    assert {r.doc_id for r in got.collect()} == {4} and got.where("piece_no = 0").count() == 2 and split_documents(df.limit(0)).count() == 0


def test_tokens(spark):
    assert token_ends("olá mundo")[-1] == len("olá mundo".encode()) and len(token_ends("")) == 0
    df = spark.createDataFrame([(1, None), (2, ""), (3, "um dois")], "i int, text string")
    assert {r.i: r.n_tokens for r in token_counts(df).collect()} == {1: None, 2: 0, 3: len(tokenizer().encode_ordinary("um dois"))}


def test_best_two_fit():
    rng = random.Random(2)
    sizes = [rng.randint(1, 900) for _ in range(4000)]
    bins = best_two_fit(sizes, 2048)
    assert sorted(i for b in bins for i in b) == list(range(4000)) and all(sum(sizes[i] for i in b) <= 2048 for b in bins)
    assert len(bins) <= -(-sum(sizes) // 2048) + 2
    assert best_two_fit([], 9) == [] and best_two_fit([9, 9], 9) == [[0], [1]] or len(best_two_fit([9, 9], 9)) == 2


def test_containers(spark):
    rows = [(1, 5000), (2, 2048), (3, 0), (4, None), (5, 1000), (5, 1000), (6, 40), (7, 1)]
    got = containers(spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint").withColumn("fill", F.lit("x"))).collect()
    per = {}
    for r in got:
        per[r.container] = per.get(r.container, 0) + r.size
    assert all(v <= 2048 for v in per.values()) and {r.container: r.fill for r in got} == per
    assert sorted((r.doc_id, r.part, r.size) for r in got) == [(1, 0, 2048), (1, 1, 2048), (1, 2, 904), (2, 0, 2048), (5, 0, 1000), (5, 0, 1000), (6, 0, 40), (7, 0, 1)]
    assert containers(spark.createDataFrame([], "doc_id bigint, n_tokens bigint")).count() == 0


def test_many_groups(spark, monkeypatch):
    from noticeloom.llm import pack

    monkeypatch.setattr(pack, "GROUP", 200)
    rng = random.Random(5)
    rows = [(i, rng.randint(1, 800)) for i in range(3000)]
    got = containers(spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint")).collect()
    assert sorted(r.doc_id for r in got) == list(range(3000))
    per = {}
    for r in got:
        per[r.container] = per.get(r.container, 0) + r.size
    assert max(per.values()) <= 2048 and len(per) <= 1.02 * sum(n for _, n in rows) / 2048 + 2


def test_mixture(spark):
    rng = random.Random(7)
    rows = [(i, s, rng.randint(50, 150)) for i, s in enumerate(["a"] * 4000 + ["b"] * 700 + ["c"] * 300 + ["z"] * 100)] + [(9998, None, 5), (9999, "a", None)]
    goals = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.1, 2), ("none", 0.1, 4), (None, 0.5, 1)], "source string, peso_alvo double, max_repeticoes int")
    chosen, report = mixed(spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint"), goals)
    limit = {"a": 1, "b": 3, "c": 2}
    assert all(1 <= r.copies <= limit[r.source] for r in chosen.collect())
    shares = {r.source: r for r in report.collect()}
    for s, want in (("a", 5 / 9), ("b", 3 / 9), ("c", 1 / 9)):
        assert abs(shares[s].share_reached - want) < 0.005
    assert shares["none"].tokens_chosen == 0 and abs(sum(r.share_reached for r in shares.values()) - 1) < 1e-9
    empty = mixed(spark.createDataFrame([], "doc_id bigint, source string, n_tokens bigint"), goals)
    assert empty[0].count() == 0


def test_chances_grow_with_size(spark):
    """Over many seeds a text is drawn as often as its size says, and the longest always."""
    rows = [(i, "a", 10 * (i % 10 + 1)) for i in range(200)] + [(900, "a", 4000)]
    sized = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    goals = spark.createDataFrame([("a", 1.0, 1)], "source string, peso_alvo double, max_repeticoes int")
    total = 8_000
    drawn = {}
    for seed in range(12):
        chosen, report = mixed(sized, goals, total, seed)
        got = chosen.collect()
        assert abs(sum(r.n_tokens * r.copies for r in got) - total) <= 100
        for r in got:
            drawn[r.n_tokens] = drawn.get(r.n_tokens, 0) + 1
    assert drawn[4000] == 12
    # factor: what is left after the certain text, over the sum of squares of the others
    factor = 4000 / sum(n * n for _, _, n in rows[:-1])
    for n in (30, 60, 100):
        assert abs(drawn.get(n, 0) / (20 * 12) - n * factor) < 0.12


def page(no, host="h", body=None, chrome=True):
    rng = random.Random(no)
    name = lambda: "".join(rng.choice("bdgklmnprstvz") + rng.choice("aeiou") for _ in range(4)).capitalize()
    title = f"EDITAL Nº {no}/2024 - ENERGIA {name()} - CAMPUS {name()}"
    text = body or f"O programa {name()} apoia {no * 7} grupos do vale {name()}.\nObjetivo\nSerão {no} etapas em {name()} com relatório {name()}.\nOs casos omissos serão resolvidos.\nVisitas a {name()} e {name()} estão previstas.\nEncerramento: {no % 28 + 1:02d}/02/2024"
    if chrome:
        return title, f"Menu\nBusca\nInício > {no}\n{title}\nAtualizado em {no % 28 + 1:02d}/01/2024\n{text}\n\nLeia também\nEDITAL Nº {no + 500}/2023 - OUTRO ASSUNTO - POLO Y\nTelefone: {no}\n© 2024 {host}"
    return title, text


def test_furniture(spark):
    rows = []
    for no in range(1, 61):
        title, text = page(no)
        rows.append((no, title, f"https://h.example/editais/{no}", text, "s"))
    rows += [(100, "t", None, None, "s"), (101, None, None, "", "s"), (102, "x", "https://h.example/editais/9z", page(900, chrome=False)[1], "s"), rows[0]]
    raw = spark.createDataFrame(rows, "raw_id bigint, title string, url string, raw_description string, source string").withColumn("key", F.lit(1))
    got = {}
    for r in furniture_lines(raw).collect():
        assert r.line_no not in got.setdefault(r.raw_id, set())
        got[r.raw_id].add(r.line_no)
    assert all(got[no] == {0, 1, 2, 4, 12, 13, 14, 15} for no in range(1, 61)), [(n, sorted(g)) for n, g in got.items() if g != {0, 1, 2, 4, 12, 13, 14, 15}][:3]
    assert set(got) == set(range(1, 61))
    kept = {r.raw_id: r.text for r in main_text(raw).collect()}
    assert kept[1].startswith("EDITAL Nº 1/2024") and "Telefone" not in kept[1] and kept[101] == ""
    assert furniture_lines(raw.limit(0)).count() == 0


def test_alignment():
    assert aligned([1, 2, 3, 4], [2, 4, 9]) == [(1, 0), (3, 1)] and aligned([], [1]) == []
