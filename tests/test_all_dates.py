"""Opening, closing and deadline dates of every row, relative dates too, against a row-by-row restatement."""

import random
import re
from datetime import date

from noticeloom.constants import END_TOKENS, OPENING_TOKENS, START_TOKENS
from noticeloom.plans import catalogue
from tests.test_schedule import EVENTS, TEXTS, resolved

S = "array<struct<evento:string,data:string>>"


def has(event, tokens):
    return any(t in event.lower() for t in tokens)


def opening(items):
    dated = [(e, v) for e, v in resolved(items) if re.match(r"\d{4}-\d{2}-\d{2}", v)]
    for tokens in (OPENING_TOKENS, START_TOKENS, [""]):
        first = next((v for e, v in dated if has(e, tokens)), "2026-01-01")
        if first != "2026-01-01":
            return first
    return "2026-01-01"


def last(text):
    if found := re.findall(r"\d{4}-\d{2}-\d{2}", text):
        return found[-1]
    return "-".join(found[-1].split("/")[::-1]) if (found := re.findall(r"\d{2}/\d{2}/\d{4}", text)) else None


def closing(items):
    rows = [(e, last(raw), v if re.match(r"\d{4}-\d{2}-\d{2}", v) else None) for (_, raw), (e, v) in zip(items, resolved(items))]
    ends = (own or v for e, own, v in rows if (own or v) and has(e, END_TOKENS))
    return next(ends, None) or next((own for e, own, _ in rows if own and has(e, START_TOKENS)), "")


def check(spark, folder):
    read = lambda name, key, col: [(name, r[key], [(i.evento or "", i.data or "") for i in r[col] or []]) for r in spark.read.parquet(f"{folder}/{name}.parquet").collect()]
    rows = read("edital", "edital_id", "cronograma") + read("raw_edital", "raw_id", "raw_cronograma")
    for query, column, f in (("opening_dates_all", "opening", opening), ("closing_dates_all", "closing", closing)):
        got = [(r.tabela, r.row_id, r[column]) for r in catalogue.QUERIES[query](spark, folder).collect()]
        assert sorted(got) == sorted((t, i, f(s)) for t, i, s in rows)
    return rows


def test_relative_dates(spark, tmp_path):
    rng = random.Random(9)
    events = [*EVENTS, "Abertura das inscrições", "Prazo para envio", "Término"]
    cases = [[(rng.choice(events), rng.choice(TEXTS)) for _ in range(rng.randint(0, 7))] for _ in range(300)] + [None, [(None, None)]]
    spark.createDataFrame(list(enumerate(cases)), f"edital_id bigint, cronograma {S}").write.parquet(str(tmp_path / "edital.parquet"))
    spark.createDataFrame([(i, "2026-01-01", c) for i, c in enumerate(cases)], f"raw_id bigint, fetched_at string, raw_cronograma {S}").write.parquet(str(tmp_path / "raw_edital.parquet"))
    check(spark, str(tmp_path))
    assert catalogue.QUERIES["opening_dates"](spark, str(tmp_path)).count() == len(cases) == catalogue.QUERIES["opening_dates_all"](spark, str(tmp_path)).where("tabela = 'edital'").count()


def test_schedules_of_the_tables(spark, data):
    check(spark, data)


def year(v):
    m = re.match(r"\s*(\d{2})/(\d{2})/(\d{4})", v)
    try:
        return date(int(m[3]), int(m[2]), int(m[1])).year if m else None
    except ValueError:
        return None


def test_deadline_years(spark, tmp_path, data):
    values = ["01/02/2026", " 01/02/2026", "\t01/02/2026", " 05/06/2025 18h", "\n 31/12/2024", "31/02/2026", "sem data", "", "2026-01-01", None]
    spark.createDataFrame(list(enumerate(values)), "edital_id bigint, data_encerramento string").write.parquet(str(tmp_path / "edital.parquet"))
    for folder in (str(tmp_path), data):
        want = {r.edital_id: year(r.data_encerramento) for r in spark.read.parquet(f"{folder}/edital.parquet").where("data_encerramento is not null").collect()}
        got = catalogue.QUERIES["deadline_years"](spark, folder).collect()
        assert len(got) == len(want) and {r.edital_id: r.year for r in got} == want
