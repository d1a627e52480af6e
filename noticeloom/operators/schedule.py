"""Ordered schedules (arrays of ``evento, data``): resolution of relative dates, opening and closing dates.

All of it is array expressions over one row, so schedules never leave their row or the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeloom.constants import DEFAULT_OPENING, END_TOKENS, OPENING_TOKENS, PERIOD_TOKENS, SCHEDULE_STOP_WORDS, START_TOKENS
from noticeloom.functions.dates import first_iso_date, last_schedule_date, plus_business_days, plus_days
from noticeloom.functions.text import contains_any, filled, stripped

_RELATIVE = r"(?iu)(\d+)\s+dias(\s+úteis)?\s+(?:após|a partir\s+d[aeo]|d[aeo])\s+(.+)"
_KNOWN = "array<struct<name:string,date:string,words:array<string>>>"
_OUT = "array<struct<evento:string,data:string>>"


def _starts_iso(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\d{4}-\d{2}-\d{2}"), F.lit(False))


def _words(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))


def normalized(schedule: Column) -> Column:
    """H1: every item with its date resolved; what cannot be resolved keeps its text.

    An item's own date comes first; else "N dias (úteis) após <event>" is counted from the
    earlier resolved event whose words include those of the trigger, or whose name contains
    it, the longest name first. A repeated event keeps its place and takes the later date.
    """
    def parsed(item: Column) -> Column:
        event, raw = stripped(F.coalesce(item["evento"], F.lit(""))), stripped(F.coalesce(item["data"], F.lit("")))
        clean = stripped(F.regexp_replace(raw, r"\(.*?\)", ""))
        trigger = F.lower(stripped(F.regexp_extract(clean, _RELATIVE, 3)))
        trigger = F.regexp_replace(F.regexp_replace(trigger, r"publicação\s+d[ao]\s+", ""), r"divulgação\s+d[ao]\s+", "")
        trigger = stripped(F.replace(trigger, F.lit("resultado homologado"), F.lit("homologação")))
        return F.struct(
            event.alias("event"), raw.alias("raw"), first_iso_date(clean).alias("iso"),
            filled(F.regexp_extract(clean, _RELATIVE, 1)).try_cast("int").alias("n"),
            (F.regexp_extract(clean, _RELATIVE, 2) != "").alias("business"),
            trigger.alias("trigger"), F.array_except(_words(trigger), F.array(*[F.lit(w) for w in SCHEDULE_STOP_WORDS])).alias("needed"),
        )

    def step(acc: Column, x: Column) -> Column:
        fits = lambda k: (
            ((F.size(x["needed"]) > 0) & (F.size(F.array_except(x["needed"], k["words"])) == 0)) | k["name"].contains(x["trigger"])
        )
        # longest name first, of equals the earlier one
        best = F.array_max(F.transform(F.filter(acc["known"], fits), lambda k: F.struct(F.length(k["name"]).alias("len"), (-F.array_position(F.transform(acc["known"], lambda y: y["name"]), k["name"])).alias("pos"), k["date"].alias("date"))))["date"]
        moved = F.when(x["business"], plus_business_days(best, x["n"])).otherwise(plus_days(best, x["n"], x["raw"]))
        date = F.coalesce(x["iso"], F.when(x["n"].isNotNull() & best.isNotNull(), moved), x["raw"])
        return F.get(F.transform(F.array(date), lambda d: _remember(acc, x, d)), F.lit(0))

    def _remember(acc: Column, x: Column, d: Column) -> Column:
        name = F.lower(x["event"])
        entry = F.struct(name.alias("name"), d.alias("date"), _words(name).alias("words"))
        seen = F.exists(acc["known"], lambda k: k["name"] == name)
        known = F.when(seen, F.transform(acc["known"], lambda k: F.when(k["name"] == name, entry).otherwise(k))).otherwise(F.array_append(acc["known"], entry))
        return F.struct(
            F.array_append(acc["out"], F.struct(x["event"].alias("evento"), d.alias("data"))).alias("out"),
            F.when(_starts_iso(d), known).otherwise(acc["known"]).alias("known"),
        )

    start = F.struct(F.array().cast(_OUT).alias("out"), F.array().cast(_KNOWN).alias("known"))
    items = F.transform(F.coalesce(schedule, F.array().cast(_OUT)), parsed)
    return F.aggregate(items, start, step, lambda acc: acc["out"])


def opening_date(schedule: Column) -> Column:
    """H2 over a normalized schedule: publication, else a start event, else the first dated event."""
    first = lambda cond: F.get(F.filter(schedule, lambda i: _starts_iso(i["data"]) & cond(i)), F.lit(0))["data"]
    passes = [first(lambda i: contains_any(i["evento"], OPENING_TOKENS)), first(lambda i: contains_any(i["evento"], START_TOKENS)), first(lambda i: F.lit(True))]
    return F.coalesce(*[F.nullif(p, F.lit(DEFAULT_OPENING)) for p in passes], F.lit(DEFAULT_OPENING))


def closing_date(raw: Column, schedule: Column) -> Column:
    """H3: last date of an end event's own text (else its resolved date), then of a start event's own text."""
    pairs = F.zip_with(raw, schedule, lambda r, n: F.struct(n["evento"].alias("evento"), filled(last_schedule_date(F.coalesce(r["data"], F.lit("")))).alias("own"), F.when(_starts_iso(n["data"]), n["data"]).alias("resolved")))
    end = F.get(F.filter(pairs, lambda p: F.coalesce(p["own"], p["resolved"]).isNotNull() & contains_any(p["evento"], END_TOKENS)), F.lit(0))
    start = F.get(F.filter(pairs, lambda p: p["own"].isNotNull() & contains_any(p["evento"], START_TOKENS)), F.lit(0))
    return F.coalesce(end["own"], end["resolved"], start["own"], F.lit(""))


def primary_period(rows: Column) -> Column:
    """H9 over ``array<struct<evento, start, end>>``: a period event, else one with both ends, else one with a start."""
    has = lambda c: F.coalesce(c != "", F.lit(False))
    picks = [
        F.get(F.filter(rows, lambda r: has(r["start"]) & contains_any(r["evento"], PERIOD_TOKENS)), F.lit(0)),
        F.get(F.filter(rows, lambda r: has(r["start"]) & has(r["end"])), F.lit(0)),
        F.get(F.filter(rows, lambda r: has(r["start"])), F.lit(0)),
    ]
    got = F.coalesce(*picks)
    return F.struct(F.coalesce(got["start"], F.lit("")).alias("start"), F.coalesce(got["end"], F.lit("")).alias("end"))
