import random

from hypothesis import given, settings
from hypothesis import strategies as st

from noticeloom.llm import canonical
from noticeloom.llm.canonical import BKTree, Lookup, canonical_values, content, levenshtein


def slow(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@settings(deadline=None, max_examples=200)
@given(st.text("abcd", max_size=9), st.text("abcd", max_size=9))
def test_distance(a, b):
    assert levenshtein(a, b) == slow(a, b)


def test_tree_equals_scan():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 8))) for _ in range(300)})
    tree = BKTree(iter(words))
    for q in words[::20] + ["", "zzz"]:
        for r in range(4):
            assert sorted(tree.within(q, r)) == sorted((slow(q, w), w) for w in words if slow(q, w) <= r)


REF = [(1, "tags", "energia solar"), (2, "tags", "saúde mental"), (3, "tags", "internet das coisas"), (4, "tags", "agricultura familiar"), (9, "categoria", "pesquisa"), (10, "categoria", None)]


def test_lookup():
    look = Lookup([(r, t) for r, f, t in REF if f == "tags"])
    found = lambda v: (look.find(tuple(content(v))) or (0, 0))[1]
    for value, want in {"ENERGIA  SOLAR;": 1, "enegria solar": 1, "familiar, agricultura": 4, "agri. familiar": 4, "energia nuclear": 0, "saúde bucal": 0, "SaÃºde mental": 2, "internetdascoisas": 3, "tema internet coisas - outros": 3, "x": 0, "energia solar 2026": 1, "a" * 5000: 0, "eneg. solar": 1, "solarenergia": 1, "linhadeenergia solar": 1, "energiasol.": 1, "saúed menatl": 2, "agri.s familiar": 4, "internet cosias das": 3, "": 0}.items():
        assert found(value) == want, value


def test_values(spark):
    ref = spark.createDataFrame([(r, f, t) for r, f, t in REF], "ref_id bigint, campo string, termo string")
    rows = [(1, "tags", 0, "energia solar"), (1, "tags", 1, "Energia Solar"), (1, "tags", 2, " "), (2, "tags", 0, None), (2, "categoria", 0, "energia solar"), (3, "nada", 0, "x"), (4, "tags", 0, "Energia Solar"), (4, "categoria", 0, "pesqiusa")]
    values = spark.createDataFrame(rows, "edital_id bigint, campo string, pos int, valor string").withColumnRenamed("edital_id", "d")
    got = sorted((r.d, r.campo, r.pos, r.ref_id) for r in canonical_values(values, ref).collect())
    assert got == [(1, "tags", 1, 1), (2, "categoria", 0, 0), (3, "nada", 0, 0), (4, "categoria", 0, 9), (4, "tags", 0, 1)]
    assert canonical_values(values.limit(0), ref).count() == 0
    assert {r.ref_id for r in canonical_values(values, ref.limit(0)).collect()} == {0}


def test_shards_agree(spark, monkeypatch):
    ref = spark.createDataFrame([(r, f, t) for r, f, t in REF], "ref_id bigint, campo string, termo string")
    values = spark.createDataFrame([("tags", "enegria solar"), ("tags", "zzz"), ("tags", "saude metnal")], "campo string, palavras string")
    one = {tuple(r) for r in canonical.looked_up(values, ref).collect()}
    monkeypatch.setattr(canonical, "SHARD", 2)
    assert {tuple(r) for r in canonical.looked_up(values, ref).collect()} == one


def test_closest_in_any_order_equals_scan():
    """The rings and trees find what a comparison with every entry finds."""
    from itertools import permutations

    from noticeloom.llm.canonical import slips
    from noticeloom.llm.titles import off_by

    rng = random.Random(4)
    terms = [(i, " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(4, 7))) for _ in range(rng.randint(1, 5)))) for i in range(1, 40)]
    look = Lookup(terms)
    for _ in range(150):
        words = rng.choice(terms)[1].split()
        rng.shuffle(words)
        i = rng.randrange(len(words))
        words[i] = words[i][:2] + rng.choice("abcde") + words[i][3:]
        best = None
        for ref, term in terms:
            entry = term.split()
            whole = min(slow("".join(words), "".join(entry[k:] + entry[:k])) for k in range(len(entry)))
            options = [whole] if whole <= canonical.WHOLE_SLIP * len("".join(entry)) else []
            if len(entry) == len(words):
                for order in permutations(entry):
                    if all(off_by(a, b, slips(max(len(a), len(b)))) <= slips(max(len(a), len(b))) for a, b in zip(words, order)):
                        options.append(sum(slow(a, b) for a, b in zip(words, order)))
            if options and (best is None or (min(options), ref) < best):
                best = (min(options), ref)
        assert look.find(tuple(words)) == best, words
