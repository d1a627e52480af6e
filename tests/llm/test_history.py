from noticeloom.llm.history import HistoryIndex, components, repeats
from noticeloom.llm.titles import plain, read_link, read_title, repaired, same_subject

SCHEMA = "edital_id bigint, nome string, link string, batch_no int, words string"
A = "CHAMADA FAPES Nº 12/2020 - BOLSAS DE INICIAÇÃO EM ENERGIA SOLAR NO SEMIÁRIDO - CAMPUS GOBERÓ"


def table(spark, rows):
    return spark.createDataFrame([(i, n, u, b, "other") for i, n, u, b in rows], SCHEMA)


def found(spark, rows):
    return sorted(map(tuple, repeats(table(spark, rows), ["fapes"]).collect()))


def test_repeats(spark):
    rows = [
        (1, A, "https://www.x.example/a/1", 0), (2, A.replace("12/2020", "13/2020"), None, 0), (3, "  ", " ", 0), (4, None, None, 0),
        (5, "(REABERTO) " + A.lower().replace("energia", "enegria"), None, 1),  # slip and decoration
        (6, "SOLAR NO SEMIÁRIDO", "http://X.example:80/a/1/?utm_source=b#topo", 1),  # only the link
        (7, A.replace("GOBERÓ", "TUZIMÍ"), None, 1), (8, A.replace("2020", "2021"), None, 2),  # another place, another year
        (9, "CHAMADA 12/2020", None, 2), (10, None, "https://www.fapes.example/editais-abertos", 2), (11, None, "https://www.fapes.example/editais-abertos/", 3),
        (12, A.replace("13/", "12/"), "https://y.example/f.pdf", 3), (13, "nada", "http://www.y.example/f%2Epdf", 4),  # link of a repeat
        (14, A.encode().decode("cp1252", "ignore"), None, 4), (15, " ", None, 4),
    ]
    want = [(1, i) for i in (5, 6, 12, 13, 14)]
    assert found(spark, rows) == want
    # all in one batch, and twice delivered
    assert found(spark, [(i, n, u, 0) for i, n, u, _ in rows]) == want
    assert found(spark, rows + rows) == want


def test_two_calls_that_turn_out_one(spark):
    rows = [(1, A, None, 0), (2, "x", "https://x.example/a", 0), (3, A, "https://x.example/a", 1), (4, "y", "https://x.example/a", 2)]
    assert found(spark, rows) == [(1, 3), (1, 4)] or found(spark, rows) == [(1, 2), (1, 3), (1, 4)]


def test_empty_and_resume(spark, tmp_path):
    assert found(spark, []) == []
    rows = [(i, A if i % 2 else A.replace("12/", f"{i}/"), None, i // 4) for i in range(1, 12)]
    assert found(spark, rows) == [(1, i) for i in range(3, 12, 2)]
    index = HistoryIndex(spark, str(tmp_path))
    assert index.parts == 0


def test_hot_call(spark):
    rows = [(i, A, None, i % 3) for i in range(3000)] + [(5000 + i, A.replace("12/", f"{i + 20}/"), None, 1) for i in range(50)]
    got = found(spark, rows)
    assert len(got) == 2999 and {a for a, _ in got} == {0}


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    start = spark.createDataFrame([(i, i) for i in [*range(41), 100, 101, 200]], "node bigint, first bigint")
    assert {r.node: r.label for r in components(start, edges).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200}


def test_reading():
    assert read_title("EDITAL N. 303-2026: X Y") [:2] == (303, 2026) and read_title(None) == (0, 0, [])
    assert read_title("chamada 359 de 2024 energia solar")[2] == ["energia", "solar"]
    assert repaired("PÃšBLICA") == "PÚBLICA" and plain("PÃšBLICA") == plain("PÚBLICA") == "publica"
    assert read_link("https://a.example/x?b=2&a=1&gclid=z") == read_link("http://www.A.example:80/x/?a=1&b=2") and read_link("https://a.example/") is None
    assert same_subject("energia solar polo goberó", "energai solar polo gobero") and not same_subject("energia solar campus gobero", "energia solar campus tuzimi")


def test_cost_follows_the_batch(spark, tmp_path):
    """A batch of 40 rows against 10 and 100 times the history opens and reads about the same."""
    from noticeloom.llm.history import HistoryIndex, read_rows

    read = []
    for size in (300, 3_000, 30_000):
        old = spark.range(size).selectExpr("id as edital_id", "concat('EDITAL Nº ', id % 997 + 1, '/', 2000 + id % 23, ' - BOLSAS ', md5(cast(id as string))) as nome", "concat('https://x.example/', id) as link", "0 as batch_no")
        new = spark.range(40).selectExpr("id + 100000 as edital_id", "concat('EDITAL Nº ', id + 1, '/2010 - OUTRA ', md5(cast(-id as string))) as nome", "concat('https://x.example/', id) as link", "1 as batch_no")
        index = HistoryIndex(spark, str(tmp_path / str(size)), buckets=4, per_bucket=20)
        opened = []
        nodes = index._nodes
        index._nodes = lambda numbers, nodes=nodes, opened=opened: opened.append(nodes(numbers)) or opened[-1]  # what is read is kept
        for rows in (old, new):
            opened.clear()
            index.seen(read_rows(rows, "edital_id", "nome", "link", "batch_no", []))
        found = {r.id: r.call for r in index.found().where("id >= 100000").collect()}
        assert found == {100000 + i: i for i in range(40)}
        assert index.buckets >= size // 20 and index.opened[-1] <= 80
        read.append(opened[0].count())
    print("rows read:", read)
    assert read[2] < 3 * read[1] and read[2] < 2_400


def test_opened_again(spark, tmp_path):
    from noticeloom.llm.history import HistoryIndex, read_rows

    rows = [(i, A if i % 2 else A.replace("12/", f"{i}/"), None, 0, "") for i in range(1, 12)]
    HistoryIndex(spark, str(tmp_path)).seen(read_rows(spark.createDataFrame(rows, SCHEMA), "edital_id", "nome", "link", "batch_no", ["fapes"]))
    again = HistoryIndex(spark, str(tmp_path))
    assert again.parts == 1 and again.size == 6
    late = [(50, A, None, 1, ""), (51, A.replace("12/", "4/"), None, 1, "")]
    again.seen(read_rows(spark.createDataFrame(late, SCHEMA), "edital_id", "nome", "link", "batch_no", ["fapes"]))
    assert {r.id: r.call for r in again.found().where("id >= 50").collect()} == {50: 1, 51: 4}


def test_small_batches_are_put_together_in_one_task(spark, monkeypatch):
    """Labels without a round over all tasks, with ids that no float holds."""
    from noticeloom.llm import history

    far = 2**62
    edges = spark.createDataFrame([(far + i, far + i + 1) for i in range(40)] + [(7, -5), (-5, 7)], "a bigint, b bigint")
    start = spark.createDataFrame([(far + i, far + 41 - i) for i in range(41)] + [(7, far + 3), (-5, far + 5), (200, 9)], "node bigint, first bigint")
    want = {far + i: far + 1 for i in range(41)} | {7: far + 3, -5: far + 3, 200: 9}
    monkeypatch.setattr(history, "written", None)  # nothing is written on the way
    got = components(start, edges, 86).collect()
    assert len(got) == 44 and {r.node: r.label for r in got} == want
