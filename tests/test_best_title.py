"""The best title of every link, generic ones and hot links included."""

from pyspark.sql import functions as F

from noticeloom.operators.select import best_title
from noticeloom.plans import catalogue

HOT = "https://www.fapes.example/editais-abertos"
TITLES = {
    HOT: ["clique aqui", "Edital 1", None, "Edital 22", "Edital 33", " Baixar "],
    "u1": ["clique aqui", "Nº 1"],
    "u2": ["Nº 2", "clique aqui"],
    "u3": ["pdf", "download"],
    "u4": [None, None],
    "u5": [None, " PDF ", "", "x"],
}


def test_generic_titles_and_hot_link(spark, tmp_path):
    rows = [(i * 100 + j, k, t) for i, (k, ts) in enumerate(TITLES.items()) for j, t in enumerate(ts)] + [(9999, None, "Edital sem link")]
    spark.createDataFrame(rows[::-1], "edital_id bigint, link string, nome string").write.parquet(str(tmp_path / "edital.parquet"))
    got = {r.link: r.title for r in catalogue.QUERIES["best_title_per_link"](spark, str(tmp_path)).collect()}
    assert got == {HOT: "Edital 22", "u1": "Nº 1", "u2": "Nº 2", "u3": "pdf", "u4": None, "u5": "x"}
    folded = spark.createDataFrame(list(TITLES.items()), "link string, titles array<string>").select("link", best_title(F.col("titles")).alias("title"))
    assert got == {r.link: r.title for r in folded.collect()}
