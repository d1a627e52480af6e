"""Every link of the notices, resolved as ``urljoin`` does it."""

import re
from urllib.parse import urljoin

from noticeloom.plans import catalogue

BASE = "https://portal.example/"


def resolved(link):
    h = re.sub(r"^[a-z]+://[^/]+/", "", link)
    return BASE + "lista" if h == "" else h if h.startswith("http") else urljoin(BASE, h)


def check(spark, folder):
    want = {r.edital_id: resolved(r.link) for r in spark.read.parquet(f"{folder}/edital.parquet").where("link is not null").collect()}
    rows = catalogue.QUERIES["resolved_links"](spark, folder).collect()
    assert len(rows) == len(want) and {r.edital_id: r.url for r in rows} == want


def test_all_links(spark, tmp_path):
    tails = ["", "a/b.pdf", "e.aspx?cod=1", "?q=1", "#topo", "a#b", "a?u=http://c/d", "x:y/z", "../a", "a/../b", "a/./b", "a/..", "a/.", "/d/e", "a//b", "a?b#c", "a;p=1"]
    links = [f"https://h.example{port}/{t}" for port in ("", ":8443") for t in tails] + ["https://h.example", None]
    spark.createDataFrame(list(enumerate(links)), "edital_id bigint, link string").write.parquet(str(tmp_path / "edital.parquet"))
    check(spark, str(tmp_path))


def test_links_of_the_tables(spark, data):
    check(spark, data)
