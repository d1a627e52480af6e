"""Portal parsers on small pages of each portal's shape."""

from noticeloom.sources import portals


def page(spark, html, url="https://x.example/a", **more):
    row = {"url": url, "html": html} | more
    return spark.createDataFrame([row], ", ".join(f"{k} string" for k in row))


def test_conif(spark):
    listing = '<h3><a href="/editais/2026/um">Chamada um</a></h3><p><a href="/editais/2026/um">Leia Mais</a></p><h3>Dois <a href="/editais/2026/dois">Leia mais</a></h3><a href="/editais/2025/x">Velho</a>'
    got = {r.url: r.title for r in portals.conif_listing(page(spark, listing), 2026, "https://c.example").collect()}
    assert got["https://c.example/editais/2026/dois"].startswith("Dois")
    assert set(got) == {"https://c.example/editais/2026/um", "https://c.example/editais/2026/dois"}
    detail = '<h1>Chamada um</h1><p>22 março 2026</p><p>Texto que descreve a chamada com mais de quarenta letras.</p><ul><li><a href="/a/edital.pdf">Edital</a><li><a href="/a/anexo.docx">Anexo I</a><li><a href="/b.pdf"></a><li><a href="/x">Outro</a><li><a href="/a.pdf">Edital aqui</a></ul>'
    r = portals.conif_detail(page(spark, detail, "https://c.example/a.pdf", title="t"), 2026, "https://c.example").first()
    assert r.title == "Chamada um" and [tuple(e) for e in r.raw_cronograma] == [("data de publicação", "2026-03-22")] and r.raw_description.startswith("Texto")
    assert [(a.titulo, a.tipo) for a in r.raw_anexos] == [("Edital", "anexo"), ("Anexo I", "anexo"), ("Documento", "anexo")] and r.main_url == "https://c.example/a/edital.pdf" and r.raw_tags == ["conif", "2026"]


def test_capes(spark):
    base = "https://www.gov.br"
    listing = '<div><h2>Editais Abertos</h2></div><div><ul><li><a href="/capes/a-2026">A</a><li><a href="/capes/a-2026">B</a><li><a href="/capes/b-2024">C</a><li><a href="/capes/x.pdf">D</a><li><a href="/mec/y">E</a><li><a href="/capes/z"></a></ul></div>'
    assert [(r.url, r.title) for r in portals.capes_listing(page(spark, listing), 2026, base).collect()] == [(f"{base}/capes/a-2026", "A")]
    detail = '<h1>Programa</h1><div class="govbr-destaque-titulo">' + "x" * 70 + "</div><p>" + "d" * 70 + '</p><a href="/m/manual.pdf">Manual</a><a href="/m/edital-2026.pdf">Edital</a><a href="/m/sem.pdf"></a><script>u="https://www.gov.br/s/chamada.pdf"</script>'
    r = portals.capes_detail(page(spark, detail, title="t"), 2026, base).first()
    assert r.main_url == f"{base}/m/edital-2026.pdf" and r.raw_description == "d" * 70
    assert [(a.titulo, a.tipo) for a in r.raw_anexos] == [("Manual", "anexo"), ("Edital", "anexo"), ("sem.pdf", "anexo"), ("chamada.pdf", "anexo")]
    assert portals.capes_detail(page(spark, detail, title="t"), 2027, base).count() == 0


def test_cnpq(spark):
    from pyspark.sql import functions as F

    from noticeloom.operators.schedule import closing_date, normalized, opening_date

    card = '<ul><li><div class="content"><h4>Chamada 5</h4><p>Texto</p><ul><li>Edital: <a href="/e.pdf">link</a></li></ul><div class="inscricao"><ul><li>25/02/2026 a 13/04/2026</li></ul></div></div><input value="x?idDivulgacao=7"></li></ul>'
    r = portals.cnpq_cards(page(spark, card), 2026, "http://m.example").collect()
    assert len(r) == 1 and r[0].title == "Chamada 5" and r[0].url == "http://m.example/x?idDivulgacao=7"
    assert [tuple(e) for e in r[0].raw_cronograma] == [("abertura das inscrições", "2026-02-25"), ("encerramento das inscrições", "2026-04-13")]
    assert [tuple(a) for a in r[0].raw_anexos] == [("Edital", "http://m.example/e.pdf", "anexo")]
    assert portals.cnpq_cards(page(spark, card), 2027, "http://m.example").count() == 0
    # the events are read as opening and closing further on
    plan = F.col("raw_cronograma")
    both = portals.cnpq_cards(page(spark, card), 2026).select(opening_date(normalized(plan)).alias("a"), closing_date(plan, normalized(plan)).alias("b")).first()
    assert tuple(both) == ("2026-02-25", "2026-04-13")
    bare = '<li><div class="content"><h4>Sem link</h4></div></li>'
    assert [x.url for x in portals.cnpq_cards(page(spark, bare), 2026).collect()] == ["Sem link"]


def test_proex(spark):
    html = """<h3>2026</h3><p><strong>Edital 0/2026</strong></p><p><a href="/z.pdf">Edital zero</a></p><h2>Editais abertos</h2><h3>Anos 2026</h3><h3>2026</h3>
    <p><strong>Edital 01/2026</strong></p><p><a href="/r.pdf">Resultado</a><a href="/e.pdf">Edital 01</a><a href="/form">Inscrição</a></p><p><strong>Edital 02/2026</strong></p><p><a href="/f.docx">Ficha</a></p>
    <p><strong>Edital 01/2026</strong></p><p><a href="/g.pdf">Edital outra vez</a></p><h3>Outros</h3><p><strong>Edital 03/2026</strong></p><p><a href="/h.pdf">Edital 03</a></p>"""
    got = {r.title: r for r in portals.proex_records(page(spark, html), 2026, "https://p.example").collect()}
    # no record without a main PDF, before the section or behind it
    assert set(got) == {"Edital 01/2026"} and got["Edital 01/2026"].url == "https://p.example/e.pdf"
    assert [a.titulo for a in got["Edital 01/2026"].raw_anexos] == ["Resultado", "Edital 01"]


PRPPG_LIST = """<table id="Conteudo_gvwLista"><tr><td class="font-weight-bold"><table class="w-100"><tr><td><span class="badge badge-info">Encerrado</span></td></tr><tr><td>Resumo do edital</td></tr></table>Edital 3 <span class="badge badge-outline-dark">30/03/2026 até 01/11/2026</span></td><td><a id="x_btnDetalhes" href="javascript:__doPostBack('ctl1$btnDetalhes','')">ver</a></td></tr>
<tr class="gvwPager"><td><a href="javascript:__doPostBack('g','Page$2')">2</a><a href="javascript:__doPostBack('g','Page$3')">3</a></td></tr></table><input id="__VIEWSTATE" name="__VIEWSTATE" value="abc">"""


def test_prppg(spark):
    r = portals.prppg_listing(page(spark, PRPPG_LIST)).collect()
    assert [(x.status, x.target, x.start_date, x.end_date, x.summary) for x in r] == [("encerrado", "ctl1$btnDetalhes", "2026-03-30", "2026-11-01", "Resumo do edital")] and r[0].title.endswith("Edital 3")
    detail = """<div id="Conteudo_pnlDetalhesEdital"><h4>Voltar Edital 3</h4><p class="card-subtitle">Sub</p><p>Antes</p><b>Informações gerais</b><p>Info</p>
    <table class="gvwTable"><tr><th>Cronograma</th><th>Data</th></tr><tr><td>Inscrição</td><td>30/03/2026 a 01/11/2026</td></tr><tr><td>Depois</td><td>a definir</td></tr></table>
    <table class="gvwTable"><tr><th>Anexos</th></tr><tr><td>PDF</td><td><a href="javascript:__doPostBack('dl$1','')">Edital 3</a></td><td>1 MB</td></tr></table></div>"""
    d = portals.prppg_detail(page(spark, detail, title="t", status="aberto", start_date="", end_date=""), 2026).collect()
    assert len(d) == 1 and d[0].title == "Edital 3" and d[0].main_url.endswith("#downloadTarget=dl%241") and d[0].raw_description == "Sub\n\nInfo"
    assert [tuple(e) for e in d[0].raw_cronograma] == [("início do período do edital", "2026-03-30"), ("fim do período do edital", "2026-11-01"), ("Inscrição", "2026-03-30")]
    assert [tuple(a)[::2] for a in d[0].raw_anexos] == [("Edital 3", "pdf")]
    assert portals.prppg_detail(page(spark, detail, title="t", status="aberto", start_date="2025-01-01", end_date=""), 2026).count() == 0


def test_paging(spark):
    pages = spark.createDataFrame([("https://s.example/l", 1, PRPPG_LIST)], "url string, page_no int, html string")
    got = sorted((r.target, r.argument, r.fields["__VIEWSTATE"]) for r in portals.postback_requests(pages, portals.prppg_listing(pages)).collect())
    assert got == [("ctl00$Conteudo$gvwLista", "Page$2", "abc"), ("ctl00$Conteudo$gvwLista", "Page$3", "abc"), ("ctl1$btnDetalhes", "", "abc")]
    assert portals.postback_requests(pages, portals.prppg_listing(pages), 2).count() == 2
    lists = spark.createDataFrame([("https://f.example/a", 1, '<a href="/a?p=2">2</a>'), ("https://f.example/b", 4, '<a href="/b5">Próxima Página</a><a href="/no">9</a>'), ("https://f.example/c", 1, "<p>2</p>")], "url string, page_no int, html string")
    assert sorted(r.next for r in portals.next_page(lists).collect()) == ["https://f.example/a?p=2", "https://f.example/b5"]


def test_finep(spark):
    listing = '<div>Prazo para envio de propostas até: 15/09/2026 <h3><a href="/chamadapublica/1">Chamada boa</a></h3></div><div>Prazo para envio de propostas até: 15/09/2020 <a href="/chamadapublica/2">Chamada velha</a></div>'
    got = {r.url: r.in_range for r in portals.finep_listing(page(spark, listing), 2026, "http://f.example").collect()}
    assert got == {"http://f.example/chamadapublica/1": True, "http://f.example/chamadapublica/2": False}
    detail = """<body><div><h2>Um menu muito comprido</h2>Tema (s): 5G; rádio Documentos</div><div class="item-page"><h2>Chamadas Públicas</h2><h2>Seleção para novos materiais</h2><p>Esta Seleção Pública visa X.</p><p>Orçamento: 5</p><p>Data de Publicação: 01/02/2026</p><p>Prazo para envio de propostas até: 15/09/2026</p><p>Tema (s): energia; água Documentos</p>
    <table><tr><th>Data de publicação</th><th>Nome do documento</th></tr><tr><td>01/02/2026</td><td>Edital</td><td><a href='/x'>ver</a><a href='/e.pdf'>baixar</a></td></tr></table>
    <table><tr><th>Documento</th></tr><tr><td>02/02/2026</td><td>Anexo</td><td><a href='images/y'>baixar</a></td></tr></table></div></body>"""
    r = portals.finep_detail(page(spark, detail, title="t"), "http://f.example").first()
    assert r.title == "Seleção para novos materiais" and r.raw_description == "Esta Seleção Pública visa X." and r.raw_tags == ["energia", "água"] and r.document_type == "edital" and r.is_main
    assert [e.data for e in r.raw_cronograma] == ["2026-02-01", "2026-09-15"]
    assert [tuple(a) for a in r.raw_anexos] == [("Edital", "http://f.example/e.pdf", "Documentos"), ("Anexo", "http://f.example/images/y", "Documentos")]


def test_fapes(spark):
    html = '<div class="panel accordion-group"><h4> Edital 5 de 2026 </h4><a href="/d/anexo_1.pdf">Anexo I</a><a href="/d/edital_5.pdf">baixar</a><a href="/d/edital_5.pdf">Edital 5/2026</a><a href="/sobre">Sobre</a></div><table><tr><td><a href="/z.pdf">Z</a></td></tr></table>'
    r = portals.fapes_blocks(page(spark, html, "https://f.example/editais-abertos-pesquisa-4"), "https://f.example").collect()
    assert [(x.title, x.url, x.group_id, x.source_category, [a.document_type for a in x.attachments]) for x in r] == [("Edital 5/2026", "https://f.example/d/edital_5.pdf", "Edital 5 de 2026", "pesquisa", ["anexo"])]
    bare = '<table><tr><td><a href="/z.pdf">Chamada Z</a></td></tr></table><table><tr><td>x</td></tr></table>'
    r = portals.fapes_blocks(page(spark, bare, "https://f.example/editais-abertos-extensao")).collect()
    assert [(x.title, x.group_id, x.source_category) for x in r] == [("Chamada Z", "Grupo desconhecido", "extensão")]
    rows = '<div class="view-editais"><table><tr class="edital-row"><td class="col-titulo">Linha</td><td><a href="/q.docx">Chamada Q</a></td></tr></table></div>'
    assert [(x.title, x.group_id) for x in portals.fapes_blocks(page(spark, rows)).collect()] == [("Chamada Q", "Linha")]
