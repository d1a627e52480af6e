"""The core queries over the notice tables and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeloom.constants import CAPES_NEGATIVE, END_TOKENS, FINEP_STOPS, MONTHS, OPENING_TOKENS, PROEX_NEGATIVE, PROEX_POSITIVE, PRPPG_NEGATIVE, PRPPG_POSITIVE, START_TOKENS
from noticeloom.functions import dates, links, text
from noticeloom.operators import registry as reg
from noticeloom.operators import schedule as sched
from noticeloom.operators import select as sel
from noticeloom.operators.classify import document_kind, settled_category
from noticeloom.operators.html import anchors, nodes
from noticeloom.operators.normalize import domain_records, record_from_answer, split_valid
from noticeloom.plans.instants import p2_found
from noticeloom.session import table
from noticeloom.sinks.json_files import keyed, rendered_log
from noticeloom.sources import portals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p2_found": p2_found}
ORACLE: dict[str, str] = {}
#: White space, for RE2.
WS = r"[\s\x{00a0}\x{2000}-\x{200a}\x{3000}]"


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def _any(column: str, tokens: list[str]) -> str:
    return "(" + " or ".join(f"contains(lower({column}), '{t}')" for t in tokens) + ")"


def _file_key(column: str, fallback: str = "'edital_anonimo'") -> str:
    base = rf"regexp_replace(regexp_replace({column}, '[^\p{{L}}\p{{N}} ._-]', '', 'g'), '\s+$', '')"
    base = f"coalesce(nullif({base}, ''), {fallback})"
    return f"lower(replace(case when length({base}) > 150 then {base}[1:140] || '_' || md5({column})[1:6] else {base} end, ' ', '_'))"


_ISO, _BR = r"(\d{4})-(\d{2})-(\d{2})", r"(\d{2})/(\d{2})/(\d{4})"


_RANGE = rf"regexp_extract(v, '({_BR})\s+a\s+({_BR})', 1)"


def _br(column: str, first: int = 1) -> str:
    return f"nullif(regexp_extract({column}, '{_BR}', 3) || '-' || regexp_extract({column}, '{_BR}', 2) || '-' || regexp_extract({column}, '{_BR}', 1), '--')"


def _first_iso(column: str) -> str:
    months = " ".join(f"when contains(lower({column}), '{m}') then '-{i:02d}-01'" for i, m in enumerate(MONTHS, 1))
    return f"""coalesce(nullif(regexp_extract({column}, '{_ISO}', 0), ''), {_br(column)},
      nullif(regexp_extract({column}, '20\\d{{2}}', 0), '') || case {months}
        when contains(lower({column}), 'final de') or contains(lower({column}), 'fim de') then '-12-31'
        when contains(lower({column}), 'início de') or contains(lower({column}), 'começo de') then '-01-01'
        when contains(lower({column}), 'meados de') then '-06-15' end)"""


def _last_date(column: str) -> str:
    br = f"regexp_extract_all({column}, '{_BR}')[-1]"
    return f"coalesce(regexp_extract_all({column}, '{_ISO}')[-1], {br}[7:10] || '-' || {br}[4:5] || '-' || {br}[1:2], '')"


# --- text -----------------------------------------------------------------------------
@query(f"select edital_id, upper(trim(regexp_replace(nome, '{WS}+', ' ', 'g'))) as title from edital")
def title_clean(spark, d):
    return table(spark, d, "edital").select("edital_id", text.notice_title(F.col("nome")).alias("title"))


@query(rf"""select raw_id, fetched_at, case when contains(upper(coalesce(nullif(raw_agency, ''), 'FAPES')), 'FAPES') then 'FAPES' else upper(raw_agency) end as agency,
  coalesce(nullif(lower(regexp_replace(raw_status, '^{WS}+|{WS}+$', '', 'g')), ''), 'aberto') as status from raw_edital""")
def agency_and_status(spark, d):
    return table(spark, d, "raw_edital").select("raw_id", "fetched_at", text.agency(F.col("raw_agency")).alias("agency"), text.status(F.col("raw_status")).alias("status"))


@query(f"select edital_id, {_file_key('nome')} as file_key from edital where nome is not null")
def notice_file_key(spark, d):
    return table(spark, d, "edital").where("nome is not null").select("edital_id", text.file_key(F.col("nome")).alias("file_key"))


@query(f"""with t as (select edital_id, u.titulo as titulo, u.link as link from (select edital_id, unnest(anexos) as u from edital))
  select edital_id, link, case when trim(lower(coalesce(titulo, ''))) in ('baixar', 'clique aqui', 'download', 'pdf', '') then replace(regexp_replace(string_split(link, '/')[-1], '\\.(pdf|docx)', '', 'g'), '_', ' ') else trim(titulo) end as title from t""")
def attachment_link_title(spark, d):
    a = table(spark, d, "edital").select("edital_id", F.inline("anexos"))
    return a.select("edital_id", "link", text.link_title(F.col("titulo"), F.col("link")).alias("title"))


@query("""with t as (select doc_id, text, instr(text, '1. ') as a from documents where text is not null),
  r as (select doc_id, a, case when a > 0 then substring(text, a) else '' end as rest from t),
  e as (select doc_id, rest, list_min(list_filter([instr(rest, '2. '), instr(rest, 'DISPOSIÇÕES'), instr(rest, 'CRONOGRAMA')], lambda p: p > 1)) as e from r)
  select doc_id, trim(regexp_replace(case when e is null then rest else substring(rest, 1, e - 1) end, '[\\s\\x{00a0}\\x{0085}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g')) as section from e""")
def first_section_text(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", text.section(F.col("text"), "1. ", ["2. ", "DISPOSIÇÕES", "CRONOGRAMA"]).alias("section"))


@query("""select edital_id, batch_no, 'Registry `' || source || '`: ' || (batch_no * 10) || ' -> ' || (batch_no * 10 + length(nome)) || ' (delta ' || length(nome) || '); `data/output/` com ' || edital_id || ' JSONs; arquivos não-JSON: ' || replace(coalesce(nullif(status, ''), 'nenhum'), '|', '/') || '.' || case when batch_no <> 0 then ' Fluxo encerrou com exit code ' || batch_no || '.' else '' end as note from edital where source is not null""")
def run_observation(spark, d):
    e = table(spark, d, "edital").where("source is not null")
    before = (F.col("batch_no") * 10).cast("long")
    return e.select("edital_id", "batch_no", text.observation(F.col("source"), before, before + F.length("nome"), F.col("edital_id"), F.col("status"), F.col("batch_no")).alias("note"))


@query("select doc_id, coalesce(contains(lower(text), '429') or (contains(lower(text), 'rate') and contains(lower(text), 'limit')), false) as limited from documents")
def rate_limit_messages(spark, d):
    return table(spark, d, "documents").select("doc_id", text.rate_limited(F.col("text")).alias("limited"))


# --- dates ----------------------------------------------------------------------------
@query(f"select edital_id, {_first_iso('data_abertura')} as opening, {_first_iso('data_encerramento')} as closing from edital")
def iso_date_cascade(spark, d):
    return table(spark, d, "edital").select("edital_id", dates.first_iso_date(F.col("data_abertura")).alias("opening"), dates.first_iso_date(F.col("data_encerramento")).alias("closing"))


@query(rf"""with t as (select edital_id, data_abertura as v, regexp_replace(data_abertura, '^{WS}+|{WS}+$', '', 'g') as s from edital),
  u as (select *, case when regexp_matches(s, '^\d{{2}}/\d{{2}}/\d{{4}}$') then try_cast(s[7:10] || '-' || s[4:5] || '-' || s[1:2] as date) end as b,
    regexp_replace(lower(v), '\s+de\s+', ' ', 'g') as l from t),
  w as (select *, list_position({MONTHS!r}, replace(regexp_extract(l, '(\d{{1,2}})\s+([a-zç]+)\s+(\d{{4}})', 2), 'marco', 'março')) as m from u)
  select edital_id, coalesce(strftime(b, '%Y-%m-%d'), v) as br, case when m > 0 then regexp_extract(l, '(\d{{1,2}})\s+([a-zç]+)\s+(\d{{4}})', 3) || '-' || lpad(m::varchar, 2, '0') || '-' || lpad(regexp_extract(l, '(\d{{1,2}})\s+([a-zç]+)\s+(\d{{4}})', 1), 2, '0') end as long_date from w""")
def br_and_long_date(spark, d):
    v = F.col("data_abertura")
    return table(spark, d, "edital").select("edital_id", dates.br_to_iso(v).alias("br"), dates.long_date(v).alias("long_date"))


@query(rf"""with t as (select raw_id, fetched_at, i as pos, raw_cronograma[i + 1].data as v from (select raw_id, fetched_at, raw_cronograma, unnest(range(len(raw_cronograma))) as i from raw_edital)),
  f as (select *, regexp_extract_all(v, '{_BR}') as b, regexp_extract_all(v, '{_ISO}') as s from t)
  select raw_id, fetched_at, pos::int as pos, {_last_date('v')} as last_date,
   coalesce(case when len(b) > 0 then b[1][7:10] || '-' || b[1][4:5] || '-' || b[1][1:2] else s[1] end, '') as start_date,
   coalesce(case when len(b) > 1 then b[-1][7:10] || '-' || b[-1][4:5] || '-' || b[-1][1:2] when len(b) = 0 and len(s) > 1 then s[-1] end, '') as end_date,
   coalesce({_br(_RANGE)}, '') as range_start from f where v is not null""")
def schedule_text_dates(spark, d):
    t = table(spark, d, "raw_edital").select("raw_id", "fetched_at", F.posexplode(F.col("raw_cronograma")["data"]).alias("pos", "v")).where("v is not null")
    se, rng = dates.start_end(F.col("v")), dates.date_range(F.col("v"))
    return t.select("raw_id", "fetched_at", "pos", dates.last_schedule_date(F.col("v")).alias("last_date"), se["start"].alias("start_date"), se["end"].alias("end_date"), rng["start"].alias("range_start"))


# day by day: the n-th of the following days that is a working day (60 days hold more than 40)
@query("""with t as (select o_orderkey, o_orderdate::date as d, (o_custkey % 40)::int as n from orders)
  select o_orderkey, n, strftime(case when n = 0 then d else list_filter(list_transform(range(1, 61), lambda k: d + k::int), lambda x: isodow(x) <= 5)[n] end, '%Y-%m-%d') as business, strftime(d + n, '%Y-%m-%d') as calendar from t""")
def day_arithmetic(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), (F.col("o_custkey") % 40).cast("int").alias("n"))
    return o.select("o_orderkey", "n", dates.plus_business_days(F.col("d"), F.col("n")).alias("business"), dates.plus_days(F.col("d"), F.col("n"), F.col("d")).alias("calendar"))


@query(r"""with t as (select edital_id, list_max(list_transform(regexp_extract_all(nome || ' ' || coalesce(link, ''), '(?:^|[^\p{L}\p{N}_])(20\d{2})(?:[^\p{L}\p{N}_]|$)', 1), lambda y: y::int)) as y from edital)
  select edital_id, y as year, (y is null or y >= 2024) as not_past, coalesce(y between 2024 and 2025, false) as in_window from t""")
def year_gates(spark, d):
    y = table(spark, d, "edital").select("edital_id", dates.latest_year(F.concat(F.col("nome"), F.lit(" "), F.coalesce("link", F.lit("")))).alias("year"))
    return y.select("edital_id", "year", (F.col("year").isNull() | (F.col("year") >= 2024)).alias("not_past"), dates.in_window(F.col("year"), 2024).alias("in_window"))


@query(rf"""select edital_id, year(try_cast(regexp_extract(x, '^(\d{{2}})/(\d{{2}})/(\d{{4}})', 3) || '-' || regexp_extract(x, '^(\d{{2}})/(\d{{2}})/(\d{{4}})', 2) || '-' || regexp_extract(x, '^(\d{{2}})/(\d{{2}})/(\d{{4}})', 1) as date))::int as year
  from (select edital_id, regexp_replace(data_encerramento, '^{WS}+', '') as x from edital where data_encerramento is not null)""")
def deadline_years(spark, d):
    e = table(spark, d, "edital").where("data_encerramento is not null")
    return e.select("edital_id", dates.deadline_year(F.concat(F.lit("Prazo para envio de propostas até: "), text.stripped(F.col("data_encerramento")))).alias("year"))


@query("""select edital_id, strftime(timezone('America/Sao_Paulo', timezone('UTC', ingested_at)), '%Y-%m-%d %H:%M:%S') || ' ' || case when h < 0 then '-' else '+' end || lpad((abs(h) // 60)::int::varchar, 2, '0') || ':' || lpad((abs(h) % 60)::int::varchar, 2, '0') as stamp
  from (select edital_id, ingested_at, date_diff('minute', ingested_at, timezone('America/Sao_Paulo', timezone('UTC', ingested_at))) as h from edital)""")
def local_run_stamps(spark, d):
    return table(spark, d, "edital").select("edital_id", dates.local_stamp(F.col("ingested_at")).alias("stamp"))


# --- links ----------------------------------------------------------------------------
@query(r"""with t as (select edital_id, u.link as link from (select edital_id, unnest(anexos) as u from edital)),
  p as (select *, lower(trim(regexp_replace(regexp_replace(link, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '[?#;].*$', ''))) as path from t)
  select edital_id, link, coalesce(nullif(regexp_extract(path, '\.(pdf|docx|doc|odt|ods|zip|rar)$', 1), ''), 'anexo') as kind, coalesce(ends_with(lower(link), '.pdf'), false) as is_pdf,
   coalesce(regexp_matches(lower(link), '\.(pdf|docx|doc|odt|ods|zip|rar)'), false) as mentions from p""")
def attachment_kinds(spark, d):
    a = table(spark, d, "edital").select("edital_id", F.inline("anexos"))
    u = F.col("link")
    return a.select("edital_id", "link", links.attachment_type(u).alias("kind"), links.is_pdf(u).alias("is_pdf"), links.mentions_document(u).alias("mentions"))


@query(None)
def resolved_links(spark, d):
    # tested against urljoin, link by link
    t = table(spark, d, "edital").where("link is not null")
    href = F.regexp_replace("link", r"^[a-z]+://[^/]+/", "")
    return t.select("edital_id", links.absolute(href, F.lit("https://portal.example/"), F.lit("https://portal.example/lista")).alias("url"))


@query("""with t as (select link, edital_id, nome, row_number() over (partition by link order by edital_id) as a, row_number() over (partition by link order by edital_id desc) as b from edital where link is not null)
  select f.link, f.edital_id as first_id, f.nome as first_title, l.nome as last_title from t f join t l on f.link = l.link where f.a = 1 and l.b = 1""")
def link_first_and_last_wins(spark, d):
    e = table(spark, d, "edital").where("link is not null").select("link", "edital_id", "nome")
    first = sel.first_of(e, ["link"], ["edital_id"]).select("link", F.col("edital_id").alias("first_id"), F.col("nome").alias("first_title"))
    return first.join(sel.last_title_of(e, "link", "nome", "edital_id").select("link", F.col("nome").alias("last_title")), "link")


@query(f"""select raw_id, fetched_at, u.url as href, regexp_replace(u.title, '^{WS}+|{WS}+$', '', 'g') as text from (select raw_id, fetched_at, unnest(attachments) as u from raw_edital) where u.url <> '' and u.title is not null""")
def html_anchors(spark, d):
    raw = table(spark, d, "raw_edital")
    html = F.concat(F.lit("<ul><li>"), F.array_join(F.transform("attachments", lambda a: F.concat(F.lit('<a href="'), a["url"], F.lit('"> '), a["title"], F.lit(" </a>"))), "<li>"), F.lit("</ul>"))
    pages = raw.where("attachments is not null").select("raw_id", "fetched_at", nodes(html).alias("nodes"))
    return pages.select("raw_id", "fetched_at", F.explode(anchors(F.col("nodes"))).alias("a")).select("raw_id", "fetched_at", "a.href", "a.text")


# --- choices ----------------------------------------------------------------------------
def _main_sql(score: str, where: str, having: str) -> str:
    return f"""with t as (select edital_id, u.titulo as titulo, u.link as link, u.tipo as tipo, i from (select edital_id, unnest(anexos) as u, unnest(range(len(anexos))) as i from edital)),
      s as (select *, coalesce(titulo || ' ', '') || coalesce(link, '') as txt from t where {where}), r as (select *, {score} as score from s), k as (select *, row_number() over (partition by edital_id order by score desc, i) as n from r)
      select edital_id, link as main_link from k where n = 1 {having}"""


def _pts(cond: str, n: int) -> str:
    return f"(case when {cond} then {n} else 0 end)"


def _typed(df: DataFrame) -> DataFrame:
    return df.select("edital_id", "anexos")


@query(_main_sql(_pts("contains(lower(link), '/centrais-de-conteudo/editais/')", 5) + "+" + _pts(_any("txt", ["edital"]), 4) + "+" + _pts(_any("txt", ["chamada", "publica", "pública"]), 3) + "-" + _pts(_any("txt", CAPES_NEGATIVE), 6), "true", "and score > 0"))
def main_attachment_by_path(spark, d):
    e = _typed(table(spark, d, "edital")).withColumn("main_link", sel.main_pdf_by_path(F.col("anexos")))
    return e.where("main_link is not null").select("edital_id", "main_link")


@query(_main_sql(_pts(_any("txt", PROEX_POSITIVE), 6) + "+" + _pts(_any("txt", ["edital"]), 4) + "-" + _pts(_any("txt", PROEX_NEGATIVE), 7), "ends_with(lower(link), '.pdf')", "and score > 0"))
def main_attachment_by_words(spark, d):
    pdfs = F.transform("anexos", lambda a: F.struct(a["titulo"].alias("titulo"), a["link"].alias("link"), F.when(F.lower(a["link"]).endswith(".pdf"), "pdf").alias("tipo")))
    e = table(spark, d, "edital").select("edital_id", sel.main_pdf_by_words(pdfs)["link"].alias("main_link"))
    return e.where("main_link is not null")


@query(_main_sql(_pts(_any("titulo", PRPPG_POSITIVE), 5) + "+" + _pts(_any("titulo", ["edital"]), 4) + "-" + _pts(_any("titulo", PRPPG_NEGATIVE), 6), "ends_with(lower(link), '.pdf')", ""))
def main_attachment_by_title(spark, d):
    pdfs = F.transform("anexos", lambda a: F.struct(a["titulo"].alias("titulo"), a["link"].alias("link"), F.when(F.lower(a["link"]).endswith(".pdf"), "pdf").alias("tipo")))
    e = table(spark, d, "edital").select("edital_id", sel.main_pdf_by_title(pdfs)["link"].alias("main_link"))
    return e.where("main_link is not null")


@query("""with r as (select distinct raw_id, group_id, document_type, title from raw_edital where group_id is not null),
  m as (select group_id, raw_id as main_id, row_number() over (partition by group_id order by case when document_type = 'edital' then 0 else 1 end, raw_id) as n from r)
  select r.raw_id, r.group_id, m.main_id from r join m on r.group_id = m.group_id and m.n = 1""")
def group_main_document(spark, d):
    r = table(spark, d, "raw_edital").where("group_id is not null").select("raw_id", "group_id", "document_type", "title").distinct()
    # a group may hold a tenth of all rows: aggregated, not collected
    rank = F.struct(F.when(F.col("document_type") == "edital", 0).otherwise(1).alias("k"), F.col("raw_id").alias("id"))
    mains = r.groupBy("group_id").agg(F.min(rank)["id"].alias("main_id"))
    return r.join(mains, "group_id").select("raw_id", "group_id", "main_id")


@query("""with t as (select edital_id, u.titulo as titulo, u.link as link, i from (select edital_id, unnest(anexos) as u, unnest(range(len(anexos))) as i from edital)),
  k as (select *, case when regexp_matches(lower(titulo), 'anexo|formulário|declaração') then 'anexo' when regexp_matches(lower(titulo), 'alteração|retificação|aditivo') then 'alteração' else 'edital' end as kind from t),
  m as (select *, row_number() over (partition by edital_id order by case when kind = 'edital' then 0 else 1 end, i) as n from k)
  select m.edital_id, any_value(m.titulo) as main_title, any_value(m.kind) as main_kind, count(k.edital_id) filter (where k.titulo is distinct from m.titulo or k.link is distinct from m.link or k.kind is distinct from m.kind)::int as n_attachments
  from m join k on m.edital_id = k.edital_id where m.n = 1 group by m.edital_id""")
def nested_documents(spark, d):
    docs = table(spark, d, "edital").select("edital_id", F.posexplode("anexos").alias("pos", "a")).select("edital_id", "pos", "a.titulo", "a.link", document_kind(F.col("a.titulo")).alias("kind"))
    return sel.nested(docs, ["edital_id"], "pos", ["titulo", "link", "kind"], "kind").select("edital_id", F.col("titulo").alias("main_title"), F.col("kind").alias("main_kind"), F.size("attachments").alias("n_attachments"))


@query(r"""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents where text is not null),
  e as (select *, sum(case when regexp_matches(line, '^\d+\. ') then 1 else 0 end) over (partition by doc_id order by pos) as entry from l)
  select doc_id, entry::bigint as entry, count(*) as n_lines, sum(length(line))::bigint as n_chars from e where entry > 0 group by all""")
def section_islands(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    cut = sel.sections(lines, "doc_id", "pos", F.col("line").rlike(r"^\d+\. "))
    return cut.groupBy("doc_id", "entry").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


@query("""with t as (select edital_id, list_concat(coalesce(tags, []), [categoria, source]) as l from edital), u as (select edital_id, unnest(l) as tag, generate_subscripts(l, 1) as i from t),
  f as (select edital_id, tag, min(i) as i from u where tag is not null group by all) select edital_id, string_agg(tag, '|' order by i) as tags from f group by edital_id""")
def ordered_distinct_tags(spark, d):
    e = table(spark, d, "edital")
    return e.select("edital_id", F.array_join(sel.ordered_distinct(F.col("tags"), F.array("categoria", "source")), "|").alias("tags"))


@query(f"""with t as (select link, edital_id, nome, lower(regexp_replace(nome, '^{WS}+|{WS}+$', '', 'g')) in ('baixar', 'clique aqui', 'download', 'pdf', '') as generic from edital where link is not null),
  k as (select link, nome, row_number() over (partition by link order by nome is null, generic, case when generic then 0 else length(nome) end desc, edital_id) as n from t) select link, nome as title from k where n = 1""")
def best_title_per_link(spark, d):
    # every link, the one with a tenth of all rows too
    return sel.best_title_of(table(spark, d, "edital").where("link is not null"), "link", "nome", "edital_id")


@query("""with per as (select batch_no, count(*) filter (where y = 2027) as kept, count(*) filter (where y <> 2027) as skipped from (select batch_no, try_cast(regexp_extract(nome, '/(20[0-9]{2})', 1) as int) as y from edital) where y is not null group by 1),
  stop as (select min(batch_no) as s from per where kept = 0 and skipped > 0)
  select edital_id, batch_no from (select edital_id, batch_no, try_cast(regexp_extract(nome, '/(20[0-9]{2})', 1) as int) as y from edital), stop where y = 2027 and (s is null or batch_no < s)""")
def pages_until_stop(spark, d):
    y = F.nullif(F.regexp_extract("nome", "/(20[0-9]{2})", 1), F.lit("")).cast("int")
    e = table(spark, d, "edital").select("edital_id", "batch_no", y.alias("y")).where("y is not null")
    return sel.pages_before_stop(e, "batch_no", F.col("y") == 2027).select("edital_id", "batch_no")


# --- registry ---------------------------------------------------------------------------
@query("select raw_id, fetched_at, r.source, url from raw_edital r where not exists (select 1 from registro g where g.source = r.source and g.chave = r.url)")
def registry_unseen(spark, d):
    raw = table(spark, d, "raw_edital").select("raw_id", "fetched_at", "source", "url")
    return sel.unseen(raw, table(spark, d, "registro"), "source", "url")


@query("""with n as (select source, link as chave, min(edital_id) as first_at from edital where link is not null and link <> '' and source is not null group by all),
  f as (select n.* from n where not exists (select 1 from registro g where g.source = n.source and g.chave = n.chave)), l as (select source, max(seq) as last from registro group by 1)
  select f.source, chave, (coalesce(last, -1) + row_number() over (partition by f.source order by first_at, chave))::bigint as seq from f left join l on f.source = l.source""")
def registry_append(spark, d):
    new = table(spark, d, "edital").select("source", F.col("link").alias("chave"), "edital_id")
    return reg.appended(table(spark, d, "registro"), new, "edital_id")


@query(f"""with a as (select upper(trim("orgão_fomento")) as a, trim(link) as link, {_file_key('nome')} as k from edital),
  f as (select case a when 'FAPES' then 'fapes' when 'FINEP' then 'finep' when 'CONIF' then 'conif' when 'PRPPG/IFES' then 'prppg_ifes' when 'PROEX/IFES' then 'proex_ifes' when 'CAPES' then 'capes' when 'CNPQ' then 'cnpq' end as source, case when a = 'FAPES' then k else nullif(link, '') end as chave from a)
  select source, chave from registro where chave is not null and source is not null union select source, chave from f where source is not null and chave is not null""")
def registry_rebuild(spark, d):
    e = table(spark, d, "edital").withColumn("file", text.file_key(F.col("nome")))
    return reg.rebuilt(table(spark, d, "registro"), e, "file")


@query("""with b as (select source, count(*) as n from registro where chave is not null group by 1), n as (select distinct source, link from edital where link is not null and link <> ''),
  f as (select n.* from n where not exists (select 1 from registro g where g.source = n.source and g.chave = n.link)), a as (select source, count(*) as n from (select source, chave from registro where chave is not null union all select source, link from f) group by 1)
  select coalesce(b.source, a.source) as source, coalesce(b.n, 0) as n_before, coalesce(a.n, 0) as n_after, coalesce(a.n, 0) - coalesce(b.n, 0) as added from b full join a on b.source = a.source""")
def registry_delta(spark, d):
    before = table(spark, d, "registro").select("source", "chave", "seq")
    new = table(spark, d, "edital").select("source", F.col("link").alias("chave"), "edital_id")
    return reg.deltas(before, before.unionByName(reg.appended(before, new, "edital_id")))


@query("select r.raw_id, r.fetched_at, coalesce(f.host, 'desconhecido') as host from raw_edital r left join fonte f on r.source = f.source")
def host_lookup(spark, d):
    raw = table(spark, d, "raw_edital").select("raw_id", "fetched_at", "source")
    return sel.with_lookup(raw, table(spark, d, "fonte"), "source", "host", "desconhecido").select("raw_id", "fetched_at", "host")


# --- normalization ----------------------------------------------------------------------
@query(rf"select count(*) filter (where ok) as accepted, count(*) filter (where not ok) as rejected from (select coalesce(regexp_replace(title, '^{WS}+|{WS}+$', '', 'g') <> '', false) as ok from raw_edital)")
def quarantine_counts(spark, d):
    good, bad = split_valid(table(spark, d, "raw_edital"))
    return good.agg(F.count("*").alias("accepted")).crossJoin(bad.agg(F.count("*").alias("rejected")))


@query(None)
def schedule_normalized(spark, d):
    raw = table(spark, d, "raw_edital").select("raw_id", "fetched_at", sched.normalized(F.col("raw_cronograma")).alias("s"))
    return raw.select("raw_id", "fetched_at", F.posexplode("s").alias("pos", "i")).select("raw_id", "fetched_at", "pos", "i.evento", "i.data")


_SCHEDULE = rf"""with t as (select edital_id, i, cronograma[i].evento as ev, cronograma[i].data as v from (select edital_id, cronograma, unnest(range(1, len(cronograma) + 1)) as i from edital)),
  n as (select edital_id, i, trim(ev) as ev, v, {_first_iso("trim(regexp_replace(coalesce(v, ''), '\\(.*?\\)', '', 'g'))")} as iso from t)"""


@query(rf"""{_SCHEDULE},
  p as (select edital_id, min(struct_pack(i := i, d := iso)) filter (where {_any('ev', OPENING_TOKENS)}) as a, min(struct_pack(i := i, d := iso)) filter (where {_any('ev', START_TOKENS)}) as b, min(struct_pack(i := i, d := iso)) as c from n where regexp_matches(iso, '^\d{{4}}-\d{{2}}-\d{{2}}') group by 1)
  select e.edital_id, coalesce(nullif(a.d, '2026-01-01'), nullif(b.d, '2026-01-01'), nullif(c.d, '2026-01-01'), '2026-01-01') as opening from edital e left join p on e.edital_id = p.edital_id""")
def opening_dates(spark, d):
    e = table(spark, d, "edital")
    return e.select("edital_id", sched.opening_date(sched.normalized(F.col("cronograma"))).alias("opening"))


@query(rf"""{_SCHEDULE},
  m as (select *, nullif({_last_date("coalesce(v, '')")}, '') as own from n),
  q as (select edital_id, min(struct_pack(i := i, d := coalesce(own, iso))) filter (where coalesce(own, iso) is not null and {_any('ev', END_TOKENS)}) as a, min(struct_pack(i := i, d := own)) filter (where own is not null and {_any('ev', START_TOKENS)}) as b from m group by 1)
  select e.edital_id, coalesce(a.d, b.d, '') as closing from edital e left join q on e.edital_id = q.edital_id""")
def closing_dates(spark, d):
    e = table(spark, d, "edital")
    raw = F.coalesce("cronograma", F.array().cast("array<struct<evento:string,data:string>>"))
    return e.select("edital_id", sched.closing_date(raw, sched.normalized(F.col("cronograma"))).alias("closing"))


def _schedules(spark: SparkSession, d: str) -> DataFrame:
    """``tabela, row_id, fetched_at, s``: the schedules of both tables, relative dates too; an empty one for none."""
    e = table(spark, d, "edital").select(F.lit("edital").alias("tabela"), F.col("edital_id").alias("row_id"), F.col("cronograma").alias("s"))
    r = table(spark, d, "raw_edital").select(F.lit("raw_edital").alias("tabela"), F.col("raw_id").alias("row_id"), "fetched_at", F.col("raw_cronograma").alias("s"))
    both = e.unionByName(r, allowMissingColumns=True)
    return both.withColumn("s", F.coalesce("s", F.array().cast("array<struct<evento:string,data:string>>"))).select("tabela", "row_id", "fetched_at", "s")


@query(None)
def opening_dates_all(spark, d):
    # both tables, with the relative dates that SQL does not resolve
    return _schedules(spark, d).select("tabela", "row_id", "fetched_at", sched.opening_date(sched.normalized(F.col("s"))).alias("opening"))


@query(None)
def closing_dates_all(spark, d):
    return _schedules(spark, d).select("tabela", "row_id", "fetched_at", sched.closing_date(F.col("s"), sched.normalized(F.col("s"))).alias("closing"))


@query("""select raw_id, fetched_at, (coalesce(len(raw_anexos), 0) + coalesce(len(attachments), 0))::int as n, coalesce(raw_anexos[1].link, attachments[1].url) as first_link, coalesce(attachments[-1].url, raw_anexos[-1].link) as last_link from raw_edital""")
def attachments_merged(spark, d):
    raw = table(spark, d, "raw_edital").select("raw_id", "fetched_at", sel.merged_attachments(F.col("raw_anexos"), F.col("attachments")).alias("a"))
    return raw.select("raw_id", "fetched_at", F.size("a").alias("n"), F.get("a", F.lit(0))["link"].alias("first_link"), F.try_element_at("a", F.lit(-1))["link"].alias("last_link"))


@query("select doc_id, case when regexp_matches(lower(titulo), 'anexo|formulário|declaração') then 'anexo' when regexp_matches(lower(titulo), 'alteração|retificação|aditivo') then 'alteração' else 'edital' end as kind from documents")
def document_kinds(spark, d):
    return table(spark, d, "documents").select("doc_id", document_kind(F.col("titulo")).alias("kind"))


@query(f"""with t as (select edital_id, lower(regexp_replace(coalesce(categoria, ''), '^{WS}+|{WS}+$', '', 'g')) as a from edital)
  select edital_id, case when a in ('divulgação de conhecimento', 'extensão', 'inovação') then a when contains(a, 'divulgação de conhecimento') or contains('divulgação de conhecimento', a) then 'divulgação de conhecimento'
   when contains(a, 'extensão') or contains('extensão', a) then 'extensão' else 'inovação' end as category from t""")
def settled_categories(spark, d):
    return table(spark, d, "edital").select("edital_id", settled_category(F.col("categoria")).alias("category"))


@query("""select edital_id, upper(coalesce(nome, '')) as nome, upper(coalesce("orgão_fomento", 'FAPES')) as agency, lower(coalesce(categoria, 'outros')) as category, coalesce(array_to_string(nullif(tags, []), '|'), 'fapes|edital|inovação') as tags, coalesce(len(cronograma), 0)::int as n_events from edital""")
def records_from_answers(spark, d):
    e = table(spark, d, "edital")
    answer = F.to_json(F.struct("nome", "descrição", "orgão_fomento", "categoria", "cronograma", "tags"))
    r = e.select("edital_id", record_from_answer(answer).alias("r"))
    return r.select("edital_id", "r.nome", F.col("r.orgão_fomento").alias("agency"), F.col("r.categoria").alias("category"), F.array_join("r.tags", "|").alias("tags"), F.size("r.cronograma").alias("n_events"))


@query(rf"""with t as (select *, upper(trim(regexp_replace(title, '{WS}+', ' ', 'g'))) as tt, coalesce(upper(raw_agency), '') as ag, coalesce(raw_description, '') as de, coalesce(document_type, 'edital') as kind from raw_edital where coalesce(regexp_replace(title, '^{WS}+|{WS}+$', '', 'g') <> '', false)),
  u as (select *, contains(ag, 'FINEP') as finep, lower(de || ' ' || tt) as txt, case when ag = '' or contains(ag, 'FAPES') then 'FAPES' else ag end as agency, case kind when 'anexo' then '[ANEXO] ' when 'alteração' then '[ALTERAÇÃO] ' else '' end || tt as nome from t),
  w as (select *, case when contains(txt, 'extensão') then 'extensão' when contains(txt, 'pesquisa') then 'pesquisa' when contains(txt, 'inovação') then 'inovação' end as word from u)
  select raw_id, fetched_at, nome, agency as orgao, case when finep then case when de <> '' then 'inovação' else coalesce(nullif(source_category, ''), 'outros') end else coalesce(word, nullif(source_category, ''), 'outros') end as categoria,
   coalesce(nullif(de, ''), 'Edital de fomento ' || agency || ': ' || nome) as descricao, url as link from w""")
def domain_record(spark, d):
    good, _ = split_valid(table(spark, d, "raw_edital"))
    r = domain_records(good)
    return r.select("raw_id", "fetched_at", "nome", F.col("orgão_fomento").alias("orgao"), "categoria", F.col("descrição").alias("descricao"), "link")


@query(None)
def domain_json(spark, d):
    good, _ = split_valid(table(spark, d, "raw_edital"))
    return keyed(domain_records(good), "raw_id")


@query("""select '| ' || strftime(ingested_at, '%Y-%m-%d') || ' | ' || coalesce(source, '-') || ' | Sucesso | ' || replace(coalesce(nome, '-'), '|', '/') || ' |' as line from edital""")
def run_log_lines(spark, d):
    log = table(spark, d, "edital").select(F.date_format("ingested_at", "yyyy-MM-dd").alias("stamp"), F.coalesce("source", F.lit("-")).alias("flow"), F.lit("Sucesso").alias("result"), F.coalesce("nome", F.lit("-")).alias("note"))
    return rendered_log(log)


# --- portals: a page for each record, in the shape of the portal ---------------------------
def _pages(spark: SparkSession, d: str, source: str, html: list) -> DataFrame:
    raw = table(spark, d, "raw_edital").where("title is not null").select("raw_id", F.translate("title", "<>&", "   ").alias("title")).distinct()
    parts = [F.col(x[1:]).cast("string") if x.startswith("$") else F.lit(x) for x in html]
    return raw.select(F.concat(F.lit(f"https://{source}.example/"), F.col("raw_id")).alias("url"), F.concat(*parts).alias("html"))


_TITLES = f"with t as (select distinct raw_id, translate(title, '<>&', '   ') as plain from raw_edital where title is not null), r as (select raw_id, regexp_replace(plain, '^{WS}+|{WS}+$', '', 'g') as title from t)"


@query(f"{_TITLES} select 'https://portal.conif.org.br/editais/2026/' || raw_id as url, title from r where title <> ''")
def listing_conif(spark, d):
    return portals.conif_listing(_pages(spark, d, "conif", ['<h3><a href="/editais/2026/', "$raw_id", '">', "$title", '</a></h3><a href="/editais/2025/x">antigo</a>']), 2026).select("url", "title")


@query(f"{_TITLES} select 'https://www.gov.br/capes/pt-br/' || raw_id as url, title from r where title <> '' and coalesce(list_max(list_transform(regexp_extract_all(title || ' ', '(?:^|[^\\p{{L}}\\p{{N}}_])(20\\d{{2}})(?:[^\\p{{L}}\\p{{N}}_]|$)', 1), lambda y: y::int)) >= 2020, true)")
def listing_capes(spark, d):
    return portals.capes_listing(_pages(spark, d, "capes", ['<h2>Editais Abertos</h2><ul><li><a href="/capes/pt-br/', "$raw_id", '">', "$title", '</a><li><a href="/capes/a.pdf">PDF</a></ul><a href="/capes/x">fora</a>']), 2020).select("url", "title")


@query(f"{_TITLES} select 'http://memoria2.cnpq.br/x?idDivulgacao=' || raw_id as url, title, '2026-02-25' as opens, '2026-04-13' as closes from r")
def listing_cnpq(spark, d):
    cards = portals.cnpq_cards(_pages(spark, d, "cnpq", ['<ul><li><div class="content"><h4>', "$title", '</h4><div class="inscricao"><ul><li>25/02/2026 a 13/04/2026</li></ul></div></div><input value="x?idDivulgacao=', "$raw_id", '"></li></ul>']), 2026)
    plan = F.col("raw_cronograma")
    return cards.select("url", "title", sched.opening_date(sched.normalized(plan)).alias("opens"), sched.closing_date(plan, sched.normalized(plan)).alias("closes"))


@query(f"{_TITLES} select 'http://www.finep.gov.br/chamadapublica/' || raw_id as url, case when title = '' then 'Chamada FINEP' else title end as title, raw_id % 2 = 0 as in_range from r where title = '' or length(title) >= 5")
def listing_finep(spark, d):
    year = F.when(F.element_at(F.split("url", "/"), -1).cast("long") % 2 == 0, "2026").otherwise("2020")
    pages = _pages(spark, d, "finep", ['<div>Prazo para envio de propostas até: 15/09/@ <a href="/chamadapublica/', "$raw_id", '">', "$title", "</a></div>"])
    return portals.finep_listing(pages.withColumn("html", F.replace("html", F.lit("@"), year)), 2026).select("url", "title", "in_range")


@query("select 'https://proex.ifes.edu.br/f' || raw_id || '.pdf' as url, 'Edital ' || raw_id || '/2026' as title, 2 as n_attachments from (select distinct raw_id from raw_edital where title is not null) where raw_id % 3 > 0")
def listing_proex(spark, d):
    name = F.when(F.element_at(F.split("url", "/"), -1).cast("long") % 3 > 0, "Edital").otherwise("Resultado")
    pages = _pages(spark, d, "proex", ["<h2>Editais abertos</h2><h3>2026</h3><p><strong>Edital ", "$raw_id", '/2026</strong></p><p><a href="/f', "$raw_id", '.pdf">@</a><a href="/form">Ficha</a><a href="/x', "$raw_id", '.docx">Anexo</a></p><h3>2025</h3><p><strong>Edital 1/2026</strong></p><p><a href="/z.pdf">Edital</a></p>'])
    # without a main document there is no record: a result is none
    records = portals.proex_records(pages.withColumn("html", F.replace(F.replace("html", F.lit("@"), name), F.when(name == "Resultado", F.lit("/f")).otherwise(F.lit("\x00")), F.lit("/r"))), 2026)
    return records.select("url", "title", F.size("raw_anexos").alias("n_attachments"))


@query("select 'aberto' as status, 'Edital n. ' || raw_id as title, 'k' || raw_id || '$btnDetalhes' as target, '2026-03-30' as start_date, '2026-11-01' as end_date from (select distinct raw_id from raw_edital where title is not null)")
def listing_prppg(spark, d):
    pages = _pages(spark, d, "prppg", ['<table id="Conteudo_gvwLista"><tr><td class="font-weight-bold">Edital n. ', "$raw_id", ' <span class="badge badge-outline-dark">30/03/2026 até 01/11/2026</span></td><td><a href="javascript:__doPostBack(\'k', "$raw_id", "\x01btnDetalhes','')\">ver</a></td></tr><tr class=\"gvwPager\"><td>1</td></tr></table>"])
    return portals.prppg_listing(pages.withColumn("html", F.replace("html", F.lit("\x01"), F.lit("$")))).select("status", "title", "target", "start_date", "end_date")


@query("select 'Edital n. ' || raw_id as title, 'https://fapes.es.gov.br/d/' || raw_id || '.pdf' as url, 'Grupo ' || raw_id as group_id, 'pesquisa' as source_category, 1 as n_attachments from (select distinct raw_id from raw_edital where title is not null)")
def blocks_fapes(spark, d):
    pages = _pages(spark, d, "fapes", ['<div class="item-edital"><h4>Grupo ', "$raw_id", '</h4><a href="/d/a', "$raw_id", '.pdf">Anexo ', "$raw_id", '</a><a href="/d/', "$raw_id", '.pdf">baixar</a><a href="/d/', "$raw_id", '.pdf">Edital n. ', "$raw_id", "</a></div>"])
    blocks = portals.fapes_blocks(pages.withColumn("url", F.concat("url", F.lit("/editais-abertos-pesquisa-4"))))
    return blocks.select("title", "url", "group_id", "source_category", F.size("attachments").alias("n_attachments"))
