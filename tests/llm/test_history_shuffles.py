from noticeloom.llm import history
from noticeloom.llm.history import HistoryIndex, read_rows
from tests.llm.test_match_shuffles import shuffled_rows


def test_the_index_is_shuffled_once_a_node(spark, tmp_path, monkeypatch):
    """Not once a key: no broadcast helps here, as with larger batches."""
    monkeypatch.setattr(history, "_light", lambda df, rows, width: df)
    old = spark.range(3000).selectExpr("id as edital_id", "concat('EDITAL Nº ', id % 97 + 1, '/2010 - BOLSAS ', md5(cast(id as string))) as nome", "cast(null as string) as link", "0 as batch_no")
    new = spark.range(40).selectExpr("id + 100000 as edital_id", "concat('EDITAL Nº ', id % 97 + 1, '/2010 - BOLSAS ', md5(cast(id as string))) as nome", "cast(null as string) as link", "1 as batch_no")
    index = HistoryIndex(spark, str(tmp_path))
    rows = [read_rows(x, "edital_id", "nome", "link", "batch_no", []) for x in (old, new)]
    index.seen(rows[0])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = shuffled_rows(spark, lambda: index.seen(rows[1]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {r.id: r.call for r in index.found().where("id >= 100000").collect()} == {100000 + i: i for i in range(40)}
    assert n < 2 * 3000
