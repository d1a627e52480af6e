"""The seven portals: what a captured listing page and a captured detail page say.

Input is a table of captured pages (``url, html``); fetching is outside the plan, behind a
function of the caller. Every parser is one projection over the page's nodes, so the year
gates and the registry's anti-join stay ordinary filters that run before any detail page is
parsed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.constants import FAPES_BLOCKS, FAPES_DOCUMENT, FINEP_DEADLINE, FINEP_DOCUMENT, FINEP_PUBLISHED, FINEP_STOPS, FINEP_THEMES
from noticeloom.functions.dates import br_to_iso, date_range, deadline_year, in_window, latest_year, long_date, start_end
from noticeloom.functions.links import absolute, attachment_type, detail_attachment, download_link, is_document, is_pdf, postback_target, total_pages, url_category
from noticeloom.functions.text import filled, link_title, section, squeezed, stripped, without_back_link
from noticeloom.operators.classify import document_kind
from noticeloom.operators.html import anchors, first, hidden_fields, inside, nodes, rows, table_by_heading, tagged, with_class
from noticeloom.operators.schedule import primary_period
from noticeloom.operators.select import best_title, first_of, last_title_of, main_pdf_by_path, main_pdf_by_title, main_pdf_by_words, nested, sections

# --- fixed values: where each portal lives
BASES = {"conif": "https://portal.conif.org.br", "capes": "https://www.gov.br", "cnpq": "http://memoria2.cnpq.br", "finep": "http://www.finep.gov.br", "proex_ifes": "https://proex.ifes.edu.br", "prppg_ifes": "https://sigpesq.ifes.edu.br", "fapes": "https://fapes.es.gov.br"}
# ------------------------------------------------------------------------------------
_DAY = r"^\d{2}/\d{2}/\d{4}$"


def parsed(pages: DataFrame) -> DataFrame:
    """``pages`` with ``nodes`` in place of ``html``, parsed once."""
    return pages.withColumn("nodes", nodes("html")).drop("html")


def _attachment(title: Column, link: Column, kind: Column) -> Column:
    return F.struct(title.alias("titulo"), link.alias("link"), kind.alias("tipo"))


def conif_listing(pages: DataFrame, year: int, base: str = BASES["conif"]) -> DataFrame:
    """Links of the year with their last title, in order of first appearance."""
    a = parsed(pages).select("nodes", F.explode(anchors(F.col("nodes"))).alias("a")).where(F.col("a.href").contains(f"/editais/{year}/"))
    heading = first(F.filter("nodes", lambda n: n["tag"].isin("h1", "h2", "h3", "h4") & (n["pos"] < F.col("a.pos")) & (n["end"] >= F.col("a.pos"))))["text"]
    title = F.when((F.col("a.text") == "") | (F.lower("a.text") == "leia mais"), heading).otherwise(F.col("a.text"))
    links = a.select(absolute(F.col("a.href"), F.lit(base)).alias("url"), title.alias("title"), F.col("a.pos").alias("pos")).where(filled(F.col("title")).isNotNull())
    return last_title_of(links, "url", "title", "pos")


def conif_detail(pages: DataFrame, year: int, base: str = BASES["conif"]) -> DataFrame:
    """The raw fields of a detail page (``url, title`` from the listing)."""
    n = F.col("nodes")
    title = F.coalesce(filled(first(tagged(n, "h1", "h2"))["text"]), F.col("title"))
    dates = F.filter(F.transform(F.concat(tagged(n, "time"), tagged(n, "p"), tagged(n, "div"), tagged(n, "span")), lambda x: long_date(x["text"])), lambda d: d.isNotNull())
    text = first(F.filter(tagged(n, "p", "div"), lambda x: (F.length(x["text"]) >= 40) & (x["text"] != title) & ~F.lower(x["text"]).contains("assine nossa newsletter")))["text"]
    docs = parsed(pages).select("url", title.alias("title"), first(dates).alias("published"), text.alias("raw_description"), F.transform(anchors(n), lambda a: F.struct(a["href"].alias("href"), a["text"].alias("titulo"))).alias("found"))
    one = docs.select("url", F.posexplode("found").alias("pos", "f")).select("url", "pos", "f.titulo", absolute(F.col("f.href"), F.lit(base)).alias("link"))
    kept = first_of(one.where(detail_attachment(F.col("link"), F.col("titulo")) & (F.col("link") != F.col("url"))), ["url", "link"], ["pos"])
    label = F.coalesce(filled(F.col("titulo")), F.lit("Documento"))
    lists = kept.groupBy("url").agg(F.sort_array(F.collect_list(F.struct("pos", _attachment(label, F.col("link"), F.lit("anexo")).alias("a")))).alias("l"))
    out = docs.drop("found").join(lists, "url", "left").withColumn("raw_anexos", F.transform("l", lambda x: x["a"])).drop("l")
    schedule = F.when(F.col("published").isNotNull(), F.array(F.struct(F.lit("data de publicação").alias("evento"), F.col("published").alias("data"))))
    main = first(F.filter("raw_anexos", lambda a: F.lower(a["titulo"]).contains("edital") & is_pdf(a["link"])))["link"]
    return out.select("url", "title", F.lit("CONIF").alias("raw_agency"), "raw_description", schedule.alias("raw_cronograma"), F.array(F.lit("conif"), F.lit(str(year))).alias("raw_tags"), "raw_anexos", main.alias("main_url"))


def capes_listing(pages: DataFrame, year: int, base: str = BASES["capes"]) -> DataFrame:
    """C4: links of the section of open calls: first of equal URLs, no PDFs, no past years."""
    p = parsed(pages).withColumn("h", first(F.filter(tagged(F.col("nodes"), "h2", "h3"), lambda x: x["text"].contains("Editais Abertos"))))
    p = p.withColumn("block", first(F.filter("nodes", lambda x: x["tag"].isin("div", "ul") & (x["pos"] > F.col("h")["pos"]))))
    a = p.select(F.explode(anchors(inside(F.col("nodes"), F.col("block")))).alias("a")).select(absolute(F.col("a.href"), F.lit(base)).alias("url"), F.col("a.text").alias("title"), F.col("a.pos").alias("pos"))
    seen = F.coalesce(latest_year(F.concat_ws(" ", "title", "url")) >= year, F.lit(True))
    return first_of(a.where(~is_pdf(F.col("url")) & F.col("url").contains("gov.br/capes") & filled(F.col("title")).isNotNull() & seen), ["url"], ["pos"])


def capes_detail(pages: DataFrame, year: int, base: str = BASES["capes"]) -> DataFrame:
    """Labelled PDF links, then bare PDF addresses in the source; main PDF by score; year gate."""
    n = F.col("nodes")
    bare = pages.select("url", F.posexplode(F.regexp_extract_all("html", F.lit(r"https?://[^\s\"'<>]+?\.pdf"), F.lit(0))).alias("pos", "link")).select("url", "link", F.lit("").alias("titulo"), F.lit(1).alias("turn"), "pos")
    title = F.coalesce(filled(first(tagged(n, "h1"))["text"]), F.col("title"))
    text = first(F.filter(tagged(n, "p", "div"), lambda x: (F.length(x["text"]) >= 60) & (x["text"] != title) & ~F.coalesce(x["cls"].contains("govbr-destaque-titulo"), F.lit(False))))["text"]
    p = parsed(pages).select("url", title.alias("title"), text.alias("raw_description"), anchors(n).alias("found"))
    labelled = p.select("url", F.explode("found").alias("a")).select("url", absolute(F.col("a.href"), F.lit(base)).alias("link"), F.col("a.text").alias("titulo"), F.lit(0).alias("turn"), F.col("a.pos").alias("pos")).where(is_pdf(F.col("link")))
    # labelled: the last label at the first place; bare ones only if not seen before
    named = labelled.unionByName(bare).withColumn("titulo", F.coalesce(filled(F.col("titulo")), F.element_at(F.split("link", "/"), -1)))
    per = named.groupBy("url", "link").agg(F.min(F.struct("turn", "pos")).alias("at"), F.max_by("titulo", F.struct(-F.col("turn"), "pos")).alias("titulo"))
    lists = per.groupBy("url").agg(F.sort_array(F.collect_list(F.struct("at", _attachment(F.col("titulo"), F.col("link"), F.lit("anexo")).alias("a")))).alias("l"))
    out = p.drop("found").join(lists, "url", "left").withColumn("raw_anexos", F.coalesce(F.transform("l", lambda x: x["a"]), F.array().cast("array<struct<titulo:string,link:string,tipo:string>>"))).drop("l")
    out = out.withColumn("main_url", main_pdf_by_path(F.col("raw_anexos")))
    seen = latest_year(F.concat_ws(" ", "title", "url", "main_url", F.array_join(F.transform("raw_anexos", lambda a: a["titulo"]), " ")))
    return out.where(F.coalesce(seen >= year, F.lit(True))).select("url", "title", F.lit("CAPES").alias("raw_agency"), "raw_description", F.array(F.lit("capes")).alias("raw_tags"), "raw_anexos", "main_url")


def cnpq_cards(pages: DataFrame, year: int, base: str = BASES["cnpq"]) -> DataFrame:
    """One record for each card of the page; those that closed before the year are left out."""
    p = parsed(pages)
    n = F.col("nodes")
    contents = F.filter(n, lambda x: (x["tag"] == "div") & F.array_contains(F.split(F.coalesce(x["cls"], F.lit("")), r"\s+"), "content"))
    card = p.select("nodes", F.explode(contents).alias("c")).withColumn("card", first(F.filter(n, lambda x: (x["tag"] == "li") & (x["pos"] < F.col("c.pos")) & (x["end"] >= F.col("c.end"))))).where("card is not null")
    body, whole = inside(n, F.col("c")), inside(n, F.col("card"))
    items = F.filter(body, lambda x: (x["tag"] == "li") & (F.size(F.filter(n, lambda y: (y["tag"] == "a") & (y["pos"] > x["pos"]) & (y["pos"] <= x["end"]))) > 0))
    links = F.transform(items, lambda x: F.struct(
        F.coalesce(filled(F.regexp_replace(F.regexp_replace(x["text"], r"(?i) link\b", ""), r"^[\s:]+|[\s:]+$", "")), F.lit("Documento")).alias("titulo"),
        first(F.filter(n, lambda y: (y["tag"] == "a") & (y["pos"] > x["pos"]) & (y["pos"] <= x["end"])))["href"].alias("href"),
    ))
    title = first(tagged(body, "h4"))["text"]
    direct = first(F.filter(tagged(whole, "input"), lambda x: F.coalesce(x["value"].rlike(r"idDivulgacao=\d+"), F.lit(False))))["value"]
    linked = first(F.filter(tagged(whole, "a"), lambda x: F.coalesce(x["href"].contains("idDivulgacao="), F.lit(False))))["href"]
    period = date_range(first(tagged(inside(n, first(with_class(body, "inscricao"))), "li"))["text"])
    out = card.select(title.alias("title"), first(tagged(body, "p"))["text"].alias("raw_description"), links.alias("links"), F.coalesce(direct, linked, first(links)["href"]).alias("permalink"), period.alias("period"), F.col("card")["pos"].alias("pos"))
    out = out.where("title is not null").where(F.coalesce(filled(F.substring("period.end", 1, 4)).cast("int") >= year, F.lit(True)))
    both = F.array(F.struct(F.lit("abertura das inscrições").alias("evento"), F.col("period.start").alias("data")), F.struct(F.lit("encerramento das inscrições").alias("evento"), F.col("period.end").alias("data")))
    host = base.rstrip("/")
    resolve = lambda h: F.when(h.startswith("http"), h).otherwise(F.concat(F.lit(host + "/"), F.regexp_replace(h, "^/+", "")))
    return out.select(
        F.coalesce(resolve(F.col("permalink")), F.col("title")).alias("url"), "title", F.lit("CNPq").alias("raw_agency"), "raw_description",
        F.filter(both, lambda e: F.coalesce(e["data"], F.lit("")) != "").alias("raw_cronograma"), F.array(F.lit("cnpq")).alias("raw_tags"),
        F.transform("links", lambda x: _attachment(x["titulo"], resolve(x["href"]), F.lit("anexo"))).alias("raw_anexos"), "pos",
    )


def proex_records(pages: DataFrame, year: int, base: str = BASES["proex_ifes"]) -> DataFrame:
    """The year's section cut at its title tags; one record per title that has a main PDF.

    The section follows the heading that is the year, after the one of the open calls, up to
    the next heading of that kind; a title met again closes the entry before it.
    """
    n = F.col("nodes")
    p = parsed(pages).withColumn("open", first(F.filter(tagged(n, "h2"), lambda x: squeezed(x["text"]).contains("Editais abertos"))))
    level = lambda x, other: (x["pos"] > F.col(other)["pos"]) & (x["parent"] == F.col(other)["parent"])
    p = p.withColumn("start", first(F.filter(tagged(n, "h3"), lambda x: level(x, "open") & (squeezed(x["text"]) == str(year)))))
    p = p.withColumn("stop", F.coalesce(first(F.filter(tagged(n, "h3"), lambda x: level(x, "start")))["pos"], F.size("nodes"))).where("start is not null")
    part = F.filter(n, lambda x: (x["pos"] > F.col("start")["end"]) & (x["pos"] < F.col("stop")) & ((x["parent"] == F.col("start")["parent"]) | ((x["tag"] == "a") & (x["href"] != ""))))
    flat = p.select("url", "nodes", F.explode(part).alias("x"))
    within = lambda *tags: F.exists("nodes", lambda y: y["tag"].isin(*tags) & (y["pos"] > F.col("x.pos")) & (y["pos"] <= F.col("x.end")))
    opens = F.col("x.tag").isin("p", "h3", "h4") & ~within("a") & F.col("x.text").contains(str(year)) & (within("strong") | F.col("x.tag").startswith("h")) & F.lower(squeezed(F.col("x.text"))).rlike("^(edital|chamada)")
    marked = flat.select("url", F.col("x.pos").alias("pos"), F.col("x.tag").alias("tag"), F.col("x.href").alias("href"), squeezed(F.col("x.text")).alias("text"), opens.alias("opens"))
    entries = sections(marked.where("opens or tag = 'a'"), "url", "pos", F.col("opens"))
    titles = first_of(entries.where("opens").select("url", "entry", F.col("text").alias("title")), ["url", "title"], ["entry"])
    links = entries.where("tag = 'a' and text <> ''").select("url", "entry", "pos", F.col("text").alias("titulo"), absolute(F.col("href"), F.lit(base)).alias("link")).where(is_document(F.col("link")))
    links = first_of(links.join(titles.select("url", "entry"), ["url", "entry"], "left_semi"), ["url", "link"], ["pos"])
    lists = links.groupBy("url", "entry").agg(F.sort_array(F.collect_list(F.struct("pos", _attachment(F.col("titulo"), F.col("link"), attachment_type(F.col("link"))).alias("a")))).alias("l"))
    out = titles.join(lists, ["url", "entry"]).withColumn("raw_anexos", F.transform("l", lambda x: x["a"])).withColumn("main", main_pdf_by_words(F.col("raw_anexos"))).where("main is not null")
    return out.select(F.col("main.link").alias("url"), "title", F.lit("PROEX/IFES").alias("raw_agency"), F.lit("").alias("raw_description"), F.lit("aberto").alias("raw_status"), F.array(F.lit("proex"), F.lit("ifes"), F.lit(str(year))).alias("raw_tags"), "raw_anexos", "entry")


def prppg_listing(pages: DataFrame) -> DataFrame:
    """Rows of the listing table without the pager: status, title, summary, form target, dates."""
    n = F.col("nodes")
    p = parsed(pages).withColumn("table", first(F.filter(n, lambda x: x["id"] == "Conteudo_gvwLista")))
    own = F.filter(n, lambda x: (x["tag"] == "tr") & (x["parent"] == F.col("table")["pos"]) & ~F.array_contains(F.split(F.coalesce(x["cls"], F.lit("")), r"\s+"), "gvwPager"))
    r = p.select("url", "nodes", F.explode(own).alias("r"))
    within = inside(n, F.col("r"))
    badges = with_class(within, "badge-outline-dark")
    status = first(F.filter(tagged(with_class(within, "badge"), "span"), lambda x: ~x["cls"].contains("badge-outline-dark")))["text"]
    inner = F.filter(with_class(within, "w-100"), lambda x: x["tag"] == "table")
    second = F.get(F.filter(tagged(within, "tr"), lambda x: F.exists(inner, lambda t: t["pos"] == x["parent"])), F.lit(1))
    link = first(F.filter(tagged(within, "a"), lambda x: F.coalesce(x["href"].contains("btnDetalhes"), F.lit(False))))
    name = first(F.filter(with_class(within, "font-weight-bold"), lambda x: x["tag"] == "td"))["text"]
    when = F.coalesce(first(tagged(badges, "span"))["text"], F.lit(""))
    dates = start_end(when)
    return r.select(
        "url", F.col("r.pos").alias("pos"), F.coalesce(filled(F.lower(status)), F.lit("aberto")).alias("status"), squeezed(F.when(when != "", F.replace(name, when, F.lit(""))).otherwise(name)).alias("title"),
        F.coalesce(first(tagged(inside(n, second), "td"))["text"], F.lit("")).alias("summary"), postback_target(link["href"]).alias("target"), dates["start"].alias("start_date"), dates["end"].alias("end_date"),
    ).where("title is not null and target is not null")


def prppg_detail(pages: DataFrame, year: int) -> DataFrame:
    """Schedule and attachment tables of a detail page (``start_date, end_date`` from the listing)."""
    n = F.col("nodes")
    box = first(F.filter(n, lambda x: x["id"] == "Conteudo_pnlDetalhesEdital"))
    p = parsed(pages).withColumn("box", box).where("box is not null").withColumn("d", inside(n, F.col("box")))
    d = F.col("d")
    cell = lambda c, i: F.get(c, F.lit(i))
    link = lambda c: first(F.filter(d, lambda x: (x["tag"] == "a") & (x["pos"] > cell(c, 1)["pos"]) & (x["pos"] <= cell(c, 1)["end"])))
    files = F.transform(F.filter(rows(d, table_by_heading(d, "anexos")), lambda c: F.size(c) == 3), lambda c: F.struct(link(c)["text"].alias("titulo"), F.coalesce(filled(F.lower(cell(c, 0)["text"])), F.lit("anexo")).alias("tipo"), postback_target(F.coalesce(link(c)["href"], F.lit(""))).alias("target")))
    files = F.filter(files, lambda f: F.coalesce(f["target"], F.lit("")) != "")
    steps = F.transform(F.filter(rows(d, table_by_heading(d, "cronograma")), lambda c: F.size(c) == 2), lambda c: F.struct(F.get(c, F.lit(0))["text"].alias("evento"), start_end(F.get(c, F.lit(1))["text"])["start"].alias("start"), start_end(F.get(c, F.lit(1))["text"])["end"].alias("end")))
    bold = first(F.filter(tagged(d, "b"), lambda x: F.lower(x["text"]).contains("informações gerais")))
    info = first(F.filter(tagged(d, "p"), lambda x: x["pos"] > bold["pos"]))
    p = p.withColumn("steps", steps).withColumn("files", files)
    period = primary_period(F.col("steps"))
    listed = filled(F.col("start_date"))
    begin, end = F.coalesce(listed, period["start"]), F.when(listed.isNotNull(), F.col("end_date")).otherwise(period["end"])
    edges = F.filter(F.array(F.struct(F.lit("início do período do edital").alias("evento"), begin.alias("data")), F.struct(F.lit("fim do período do edital").alias("evento"), end.alias("data"))), lambda e: F.coalesce(e["data"], F.lit("")) != "")
    plan = F.concat(edges, F.transform(F.filter("steps", lambda s: F.coalesce(s["start"], F.lit("")) != ""), lambda s: F.struct(s["evento"].alias("evento"), s["start"].alias("data"))))
    subtitle = first(tagged(with_class(d, "card-subtitle"), "p"))["text"]
    out = p.select(
        "url", without_back_link(squeezed(F.coalesce(first(tagged(d, "h4"))["text"], F.col("title")))).alias("title"), F.lit("PRPPG/IFES").alias("raw_agency"), F.concat_ws("\n\n", filled(subtitle), filled(info["text"])).alias("raw_description"),
        F.col("status").alias("raw_status"), plan.alias("raw_cronograma"), F.array(F.lit("prppg"), F.lit("ifes"), F.lit(str(year))).alias("raw_tags"), F.transform("files", lambda f: F.struct(f["titulo"].alias("titulo"), f["target"].alias("target"), f["tipo"].alias("tipo"))).alias("files"), begin.alias("begin"),
    ).where(F.coalesce(F.col("begin").startswith(str(year)), F.lit(False)))
    anexos = F.transform("files", lambda f: _attachment(f["titulo"], download_link(F.col("url"), f["target"]), f["tipo"]))
    return out.withColumn("raw_anexos", anexos).withColumn("main_url", main_pdf_by_title(F.col("raw_anexos"))["link"]).drop("files", "begin")


def finep_listing(pages: DataFrame, year: int, base: str = BASES["finep"]) -> DataFrame:
    """Each link with whether its deadline is in this year or the next, read from the three elements around it."""
    n = F.col("nodes")
    a = parsed(pages).select("url", "nodes", F.explode(tagged(n, "a")).alias("a")).where(F.col("a.href").contains("chamadapublica/"))
    around = F.filter("nodes", lambda x: (x["pos"] < F.col("a.pos")) & (x["end"] >= F.col("a.end")))
    near = F.slice(F.reverse(around), 1, 3)
    block = F.coalesce(first(F.filter(near, lambda x: x["text"].rlike("Prazo|Data de"))), F.try_element_at(near, F.lit(-1)))
    title = F.coalesce(filled(F.col("a.text")), F.lit("Chamada FINEP"))
    out = a.select(F.col("url").alias("page"), absolute(F.col("a.href"), F.lit(base)).alias("url"), title.alias("title"), F.col("a.pos").alias("pos"), F.coalesce(in_window(deadline_year(block["text"]), year), F.lit(False)).alias("in_range"))
    return first_of(out, ["page", "url"], ["pos"]).where(F.length("title") >= 5)


def finep_detail(pages: DataFrame, base: str = BASES["finep"]) -> DataFrame:
    """Title, objective, dates, themes and documents tables of a detail page.

    What counts is the text of the element that holds the notice, not of the menus around it.
    """
    n = F.col("nodes")
    p = parsed(pages)
    main = lambda x: (x["tag"].isin("main", "article")) | F.coalesce(x["id"] == "content", F.lit(False)) | F.arrays_overlap(F.split(F.coalesce(x["cls"], F.lit("")), r"\s+"), F.array(F.lit("content"))) | ((x["tag"] == "div") & F.array_contains(F.split(F.coalesce(x["cls"], F.lit("")), r"\s+"), "item-page"))
    dated = first(F.filter(n, lambda x: main(x) & F.lower(x["text"]).contains("data de publicação")))
    stated = first(F.filter(tagged(n, "div"), lambda x: F.lower(x["text"]).contains("esta seleção pública")))
    whole = F.coalesce(first(tagged(n, "body")), first(n))
    p = p.withColumn("box", F.coalesce(dated, whole))
    p = p.withColumn("box", F.when(F.col("box")["text"].contains("Esta Seleção Pública") | stated.isNull(), F.col("box")).otherwise(stated))
    text = F.col("box")["text"]
    own = inside(n, F.col("box"))
    title = F.coalesce(first(F.filter(tagged(own, "h2"), lambda x: ~x["text"].contains("Chamadas Públicas") & (F.length(x["text"]) > 15)))["text"], F.col("title"))
    objective = F.coalesce(filled(section(text, "Esta Seleção Pública", FINEP_STOPS)), filled(section(text, "Esta seleção pública", FINEP_STOPS)), F.substring(text, 1, 2000))
    published = filled(F.regexp_extract(text, FINEP_PUBLISHED, 1))
    deadline = filled(F.regexp_extract(text, FINEP_DEADLINE, 1))
    plan = F.filter(F.array(F.struct(F.lit("Data de publicação").alias("evento"), br_to_iso(published).alias("data")), F.struct(F.lit("Prazo de envio da proposta").alias("evento"), br_to_iso(deadline).alias("data"))), lambda e: e["data"].isNotNull())
    # themes are read behind the deadline, or else the date of publication: before them stands the menu
    at = F.coalesce(F.nullif(F.instr(text, "Prazo para envio"), F.lit(0)), F.nullif(F.instr(text, "Data de Publicação"), F.lit(0)), F.lit(1))
    themes = F.regexp_extract(F.substring(text, at, F.length(text)), FINEP_THEMES, 1)
    tags = F.filter(F.transform(F.split(themes, ";"), lambda t: squeezed(t)), lambda t: F.length(t) > 1)
    p = p.withColumn("own", own)

    def files(ns: Column) -> Column:
        tables = F.filter(tagged(ns, "table"), lambda t: F.lower(F.coalesce(first(tagged(inside(ns, t), "thead", "tr"))["text"], F.lit(""))).contains("documento"))
        lines = F.flatten(F.transform(tables, lambda t: F.filter(rows(ns, t), lambda c: F.size(c) >= 2)))
        links = lambda c: F.filter(ns, lambda x: (x["tag"] == "a") & (F.coalesce(x["href"], F.lit("")) != "") & (x["pos"] > F.get(c, F.lit(0))["pos"]) & (x["pos"] <= F.try_element_at(c, F.lit(-1))["end"]))
        document = lambda h: F.lower(h).rlike(FINEP_DOCUMENT) | h.contains("/images/")
        kept = F.filter(lines, lambda c: (F.length(F.get(c, F.lit(1))["text"]) >= 2) & (F.get(c, F.lit(0))["text"].rlike(_DAY) | ~F.get(c, F.lit(1))["text"].rlike(_DAY)))
        found = F.transform(kept, lambda c: F.struct(F.get(c, F.lit(1))["text"].alias("titulo"), F.coalesce(first(F.filter(links(c), lambda x: document(x["href"])))["href"], first(links(c))["href"]).alias("href")))
        return F.filter(found, lambda f: f["href"].isNotNull())

    p = p.withColumn("inner", files(F.col("own"))).withColumn("found", F.when(F.size("inner") > 0, F.col("inner")).otherwise(files(n)))
    host = base.rstrip("/") + "/"
    resolve = lambda h: F.when(h.startswith("http"), h).otherwise(F.concat(F.lit(host), F.regexp_replace(h, "^/+", "")))
    anexos = F.transform("found", lambda f: _attachment(f["titulo"], resolve(f["href"]), F.lit("Documentos")))
    return p.select(
        "url", title.alias("title"), F.lit("chamada pública").alias("source_category"), F.lit("FINEP").alias("raw_agency"), objective.alias("raw_description"), F.lit("edital").alias("document_type"), F.lit(True).alias("is_main"),
        F.when(F.size(plan) > 0, plan).alias("raw_cronograma"), F.when(F.size(tags) > 0, tags).alias("raw_tags"), F.when(F.size(anexos) > 0, anexos).alias("raw_anexos"),
    )


def fapes_blocks(pages: DataFrame, base: str = BASES["fapes"]) -> DataFrame:
    """Document links of each block of a page, classified, nested under the block's main one.

    Blocks are the accordions, panels and rows of the portal; a page without any falls back
    to its tables with a PDF link. The first heading of a block names its group.
    """
    n = F.col("nodes")
    has = lambda x, cls: F.array_contains(F.split(F.coalesce(x["cls"], F.lit("")), r"\s+"), cls)
    views = F.filter(n, lambda x: (x["tag"] == "div") & has(x, "view-editais"))
    panel = lambda x: (x["tag"] == "div") & F.arrays_overlap(F.split(F.coalesce(x["cls"], F.lit("")), r"\s+"), F.array(*[F.lit(c) for c in FAPES_BLOCKS]))
    row = lambda x: (x["tag"] == "tr") & has(x, "edital-row") & F.exists(views, lambda v: (v["pos"] < x["pos"]) & (x["pos"] <= v["end"]))
    blocks = F.filter(n, lambda x: panel(x) | row(x))
    tables = F.filter(tagged(n, "table"), lambda t: F.exists(n, lambda x: (x["tag"] == "a") & F.coalesce(x["href"].endswith(".pdf"), F.lit(False)) & (x["pos"] > t["pos"]) & (x["pos"] <= t["end"])))
    b = parsed(pages).select(F.col("url").alias("page"), "nodes", F.posexplode(F.when(F.size(blocks) > 0, blocks).otherwise(tables)).alias("block", "b"))
    b = b.withColumn("within", inside(n, F.col("b")))
    heading = first(F.filter("within", lambda x: x["tag"].isin("h3", "h4", "strong") | has(x, "title") | ((x["tag"] == "td") & has(x, "col-titulo"))))
    b = b.withColumn("group_id", F.coalesce(filled(stripped(heading["text"])), F.lit("Grupo desconhecido")))
    links = b.select("page", "block", "group_id", F.explode(anchors(F.col("within"))).alias("a"))
    links = links.where(F.lower("a.href").rlike(FAPES_DOCUMENT) | F.lower("a.text").contains("baixar"))
    href = F.when(F.col("a.href").startswith("/"), F.concat(F.lit(base.rstrip("/")), F.col("a.href"))).otherwise(F.col("a.href"))
    links = links.select("page", "block", "group_id", F.col("a.pos").alias("pos"), href.alias("url"), F.col("a.text").alias("text"))
    links = links.withColumn("title", link_title(F.col("text"), F.col("url")))
    per = links.groupBy("page", "block", "group_id", "url").agg(F.min("pos").alias("pos"), F.sort_array(F.collect_list(F.struct("pos", "title"))).alias("titles"))
    docs = per.select("page", "block", "group_id", "url", "pos", best_title(F.transform("titles", lambda t: t["title"])).alias("title")).withColumn("document_type", document_kind(F.col("title")))
    out = nested(docs, ["page", "block", "group_id"], "pos", ["title", "url", "document_type"])
    return out.withColumn("source_category", url_category(F.col("page"))).withColumn("raw_agency", F.lit("FAPES")).withColumn("is_main", F.lit(True))


def next_page(pages: DataFrame, page_no: str = "page_no") -> DataFrame:
    """``url, page_no, next``: the address behind the link to the next page, where a listing has one."""
    n = F.col("nodes")
    by_word = first(F.filter(anchors(n), lambda a: a["text"].contains("Próxima")))["href"]
    by_number = first(F.filter(anchors(n), lambda a: a["text"] == (F.col(page_no) + 1).cast("string")))["href"]
    found = parsed(pages).select("url", page_no, F.coalesce(by_word, by_number).alias("href")).where("href is not null")
    return found.select("url", page_no, absolute(F.col("href"), F.col("url")).alias("next"))


def postback_requests(pages: DataFrame, listed: DataFrame, max_pages: int | None = None) -> DataFrame:
    """The form posts that a captured listing page calls for: ``url, target, argument, fields``.

    One for each later page of the pager (from the first page only, up to ``max_pages``) and
    one for each row of ``listed``; ``fields`` are the page's hidden state.
    """
    n = F.col("nodes")
    p = parsed(pages).select("url", "page_no", "nodes", hidden_fields(n).alias("fields"))
    pager = inside(n, first(F.filter(n, lambda x: x["id"] == "Conteudo_gvwLista")))
    last = total_pages(F.transform(F.filter(tagged(pager, "a"), lambda a: a["href"].isNotNull()), lambda a: a["href"]))
    last = F.least(last, F.lit(max_pages)) if max_pages is not None else last
    more = p.where("page_no = 1").withColumn("last", last).where("last > 1").select("url", F.lit("ctl00$Conteudo$gvwLista").alias("target"), F.explode(F.sequence(F.lit(2), F.col("last"))).alias("k"), "fields")
    more = more.select("url", "target", F.concat(F.lit("Page$"), F.col("k").cast("string")).alias("argument"), "fields")
    rows_ = listed.select("url", "target").join(p.select("url", "fields"), "url").select("url", "target", F.lit("").alias("argument"), "fields")
    return more.unionByName(rows_)


@dataclass(frozen=True)
class Portal:
    """What the pipeline template needs to know of a portal."""

    source: str
    listing: Callable[..., DataFrame]
    detail: Callable[..., DataFrame] | None
    by_year: bool = True  # the listing is read for one year
    detail_by_year: bool = True


PORTALS = [
    Portal("fapes", fapes_blocks, None, by_year=False),
    Portal("finep", finep_listing, finep_detail, detail_by_year=False),
    Portal("conif", conif_listing, conif_detail),
    Portal("prppg_ifes", prppg_listing, prppg_detail, by_year=False),
    Portal("proex_ifes", proex_records, None),
    Portal("capes", capes_listing, capes_detail),
    Portal("cnpq", cnpq_cards, None),
]
