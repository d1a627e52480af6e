"""Schedules against a row-by-row restatement in Python."""

import random
import re
from datetime import date, timedelta

from pyspark.sql import functions as F

from noticeloom.constants import MONTHS, SCHEDULE_STOP_WORDS
from noticeloom.functions import dates
from noticeloom.operators import schedule as sched


def iso(text):
    if m := re.search(r"(\d{4})-(\d{2})-(\d{2})", text):
        return m[0]
    if m := re.search(r"(\d{2})/(\d{2})/(\d{4})", text):
        return f"{m[3]}-{m[2]}-{m[1]}"
    low, year = text.lower(), re.search(r"20\d{2}", text)
    for i, name in enumerate(MONTHS, 1):
        if name in low and year:
            return f"{year[0]}-{i:02d}-01"
    for words, end in ((("final de", "fim de"), "12-31"), (("início de", "começo de"), "01-01"), (("meados de",), "06-15")):
        if year and any(w in low for w in words):
            return f"{year[0]}-{end}"
    return None


def later(day, n, business):
    try:
        d = date.fromisoformat(day)
    except ValueError:
        return None
    if not business:
        return (d + timedelta(days=n)).isoformat()
    while n:
        d += timedelta(days=1)
        n -= d.weekday() < 5
    return d.isoformat()


def resolved(items):
    out, known = [], {}
    for event, raw in items:
        event, raw = event.strip(), raw.strip()
        clean = re.sub(r"\(.*?\)", "", raw).strip()
        got = iso(clean)
        m = None if got else re.search(r"(\d+)\s+dias(\s+úteis)?\s+(?:após|a partir\s+d[aeo]|d[aeo])\s+(.+)", clean, re.I)
        if m:
            trigger = re.sub(r"divulgação\s+d[ao]\s+", "", re.sub(r"publicação\s+d[ao]\s+", "", m[3].strip().lower())).replace("resultado homologado", "homologação").strip()
            need = set(re.findall(r"\w+", trigger)) - set(SCHEDULE_STOP_WORDS)
            for name in sorted(known, key=len, reverse=True):
                if need and need <= set(re.findall(r"\w+", name)) or trigger in name:
                    got = later(known[name], int(m[1]), bool(m[2])) or (known[name] if m[2] else raw)
                    break
        got = got or raw
        out.append((event, got))
        if re.match(r"\d{4}-\d{2}-\d{2}", got):
            known[event.lower()] = got
    return out


EVENTS = ["Publicação do edital", "Resultado preliminar", "Resultado final", "Homologação", "Encerramento das inscrições", "Início das inscrições", "Recurso", " Resultado final "]
TEXTS = [
    "2024-02-10", "15/03/2024", "março de 2025", "fim de 2026", "em breve", "", "5 dias após o resultado final", "10 dias úteis após a publicação", "3 (três) dias a partir da divulgação do resultado preliminar",
    "2 dias úteis após o resultado homologado", "99/99/2026", "7 dias da homologação", "1 DIAS ÚTEIS A PARTIR DE RECURSO", "de 01/01/2024 a 05/02/2024", "0 dias úteis após o recurso", "meados de 2024",
]


def test_normalized_equals_restatement(spark):
    rng = random.Random(4)
    cases = [[(rng.choice(EVENTS), rng.choice(TEXTS)) for _ in range(rng.randint(0, 9))] for _ in range(700)]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, s array<struct<evento:string,data:string>>")
    got = {r.i: [tuple(x) for x in r.o] for r in df.select("i", sched.normalized(F.col("s")).alias("o")).collect()}
    wrong = [(cases[i], got[i], resolved(cases[i])) for i in got if got[i] != resolved(cases[i])]
    assert wrong == []
    assert sum(t != x[1] for c in cases for (_, x), (_, t) in zip(zip(c, c), resolved(c))) > 100


def test_nulls(spark):
    df = spark.createDataFrame([(None,), ([],), ([(None, None)],)], "s array<struct<evento:string,data:string>>")
    assert [[tuple(x) for x in r[0]] for r in df.select(sched.normalized(F.col("s"))).collect()] == [[], [], [("", "")]]


def test_business_days(spark):
    df = spark.createDataFrame([("2024-02-%02d" % d, n) for d in range(1, 29) for n in range(0, 30)], "d string, n int")
    for r in df.select("d", "n", dates.plus_business_days(F.col("d"), F.col("n")).alias("o")).collect():
        assert r.o == later(r.d, r.n, True)


def test_opening_and_closing(spark):
    s = [("Prazo para envio", "01/02/2026 a 05/03/2026"), ("Início", "2026-01-10"), ("Publicação do edital", "2026-01-01"), ("Publicação", "05/01/2026")]
    df = spark.createDataFrame([(s,)], "s array<struct<evento:string,data:string>>")
    n = sched.normalized(F.col("s"))
    # a genuine sentinel date falls through to the start events
    assert df.select(sched.opening_date(n), sched.closing_date(F.col("s"), n)).first()[:] == ("2026-01-10", "2026-03-05")


def test_scalars(spark):
    one = spark.range(1)
    lit = F.lit
    assert one.select(dates.long_date(lit("5 agosto 2025")), dates.long_date(lit("16 de junho de 2026")), dates.long_date(lit("sem data"))).first()[:] == ("2025-08-05", "2026-06-16", None)
    assert tuple(one.select(dates.date_range(lit("25/02/2026  a  13/04/2026"))).first()[0]) == ("2026-02-25", "2026-04-13")
    assert tuple(one.select(dates.date_range(lit("sem datas"))).first()[0]) == ("", "")
    assert one.select(dates.deadline_year(lit("Prazo para envio de propostas até: 15/09/2026")), dates.in_window(lit(2027), 2026), dates.in_window(lit(None).cast("int"), 2026)).first()[:] == (2026, True, False)
    assert one.select(dates.local_stamp(lit("2026-03-31 15:00:00"))).first()[0] == "2026-03-31 12:00:00 -03:00"
