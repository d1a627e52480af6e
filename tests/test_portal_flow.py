"""Portals end to end: captured pages to records and registry rows."""

import json

from noticeloom.plans import flow
from noticeloom.sources import portals
from tests.test_portals import PRPPG_LIST

CARD = '<ul><li><div class="content"><h4>Chamada CNPq</h4><div class="inscricao"><ul><li>25/02/2026 a 13/04/2026</li></ul></div></div><input value="x?idDivulgacao=7"></li></ul>'
LONG = "Texto que descreve a chamada com bem mais do que sessenta letras, para que conte."
PRPPG = '<div id="Conteudo_pnlDetalhesEdital"><h4>Voltar Edital 3</h4><table class="gvwTable"><tr><th>Anexos</th></tr></table></div>'
PAGES = [
    ("conif", "listing", 1, "l", '<h3><a href="/editais/2026/um">Chamada um</a></h3><h3><a href="/editais/2026/velho">Já vista</a></h3>', None),
    ("conif", "detail", 1, "https://portal.conif.org.br/editais/2026/um", f'<h1>Chamada um</h1><p>{LONG}</p><a href="/e.pdf">Edital</a>', None),
    ("conif", "detail", 1, "https://portal.conif.org.br/editais/2026/velho", f"<h1>Já vista</h1><p>{LONG}</p>", None),
    ("capes", "listing", 1, "l", '<h2>Editais Abertos</h2><ul><li><a href="/capes/a-2026">A</a></ul>', None),
    ("capes", "detail", 1, "https://www.gov.br/capes/a-2026", f"<h1>Programa A</h1><p>{LONG}</p>", None),
    ("cnpq", "listing", 1, "l", CARD, None),
    ("finep", "listing", 1, "l1", '<div>Prazo para envio de propostas até: 15/09/2026 <a href="/chamadapublica/1">Chamada boa</a></div>', None),
    ("finep", "listing", 2, "l2", '<div>Prazo para envio de propostas até: 15/09/2020 <a href="/chamadapublica/2">Chamada velha</a></div>', None),
    ("finep", "listing", 3, "l3", '<div>Prazo para envio de propostas até: 15/09/2026 <a href="/chamadapublica/3">Chamada tarde</a></div>', None),
    ("finep", "detail", 1, "http://www.finep.gov.br/chamadapublica/1", "<body><h2>Seleção para novos materiais</h2>Esta Seleção Pública visa X.</body>", None),
    ("finep", "detail", 1, "http://www.finep.gov.br/chamadapublica/3", "<body><h2>Seleção que vem tarde demais</h2></body>", None),
    ("proex_ifes", "listing", 1, "l", '<h2>Editais abertos</h2><h3>2026</h3><p><strong>Edital 01/2026</strong></p><p><a href="/e.pdf">Edital 01</a></p>', None),
    ("prppg_ifes", "listing", 1, "l", PRPPG_LIST, None),
    ("prppg_ifes", "detail", 1, "https://sigpesq.ifes.edu.br/d?cod=3", PRPPG, "ctl1$btnDetalhes"),
    ("fapes", "listing", 1, "https://f.example/editais-abertos-pesquisa-4", '<div class="item-edital"><h4>G</h4><a href="/d/5.pdf">Edital 5</a></div><div class="item-edital"><h4>H</h4><a href="/d/6.pdf">Edital 6</a></div>', None),
]


def registry(spark):
    return spark.createDataFrame([("conif", "https://portal.conif.org.br/editais/2026/velho", 0)], "source string, chave string, seq bigint")


def test_each_portal(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, flow.PAGES)
    (tmp_path / "edital_6.json").write_text(json.dumps({"nome": "EDITAL 6"}))
    files = flow.fetched(spark.createDataFrame([("https://portal.conif.org.br/e.pdf",), ("http://x/broken",), (None,)], "url string"), lambda u: ("application/pdf", b"%PDF") if u.endswith("pdf") else 1 / 0)
    want = {"fapes": ["EDITAL 5"], "finep": ["SELEÇÃO PARA NOVOS MATERIAIS"], "conif": ["CHAMADA UM"], "prppg_ifes": ["EDITAL 3"], "proex_ifes": ["EDITAL 01/2026"], "capes": ["PROGRAMA A"], "cnpq": ["CHAMADA CNPQ"]}
    for portal in portals.PORTALS:
        records, rejected, added, totals = flow.ingest(portal, pages, registry(spark), 2026, files, str(tmp_path))
        rows = records.collect()
        assert [r.nome for r in rows] == want[portal.source], portal.source
        keys = [tuple(r)[:2] for r in added.collect()]
        assert keys == [(portal.source, "edital_5" if portal.source == "fapes" else rows[0].link)] and rejected.count() == 0
        assert totals["accepted"] == 1 and totals["rejected"] == 0 and totals["extracted"] == (2 if portal.source == "fapes" else 1)
        if portal.source == "cnpq":
            assert (rows[0].data_abertura, rows[0].data_encerramento) == ("2026-02-25", "2026-04-13")


def test_all_as_one(spark):
    got = flow.ingest_all(spark.createDataFrame(PAGES, flow.PAGES), registry(spark), 2026).groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in got} == {p.source: 2 if p.source == "fapes" else 1 for p in portals.PORTALS}


def test_files_and_pages(spark):
    files = spark.createDataFrame([("a.pdf", "text/html", b"x"), ("b", "application/PDF", b"x"), ("c.doc", None, b"x"), ("d.pdf", "application/pdf", None)], flow.FILES)
    assert sorted(r.url for r in flow.documents_only(files, "proex_ifes").collect()) == ["a.pdf", "b"] and [r.url for r in flow.documents_only(files, "cnpq").collect()] == ["b"]
    read = spark.createDataFrame([("f", 2, "dois"), ("f", 1, "um"), ("g", 1, None)], "file string, page_no int, markdown string")
    assert {r.file: r.text for r in flow.joined_pages(read).collect()} == {"f": "\num\ndois", "g": "\n"}
