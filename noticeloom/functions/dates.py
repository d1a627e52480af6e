"""Date functions over strings: column expressions only, no calendar check unless said."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeloom.constants import MONTHS
from noticeloom.functions.text import filled, stripped

ISO, BR = r"(\d{4})-(\d{2})-(\d{2})", r"(\d{2})/(\d{2})/(\d{4})"


def _joined(c: Column, pattern: str, order: tuple[int, int, int]) -> Column:
    parts = [F.regexp_extract(c, pattern, i) for i in order]
    return F.when(parts[0] != "", F.concat_ws("-", *parts))


def first_iso_date(c: Column) -> Column:
    """ISO, else DD/MM/YYYY, else month name and year, else a vague part of a year; null if none."""
    low = F.lower(c)
    year = filled(F.regexp_extract(c, r"20\d{2}", 0))
    month = None
    for i, name in enumerate(MONTHS, 1):
        month = F.when(low.contains(name), f"-{i:02d}-01") if month is None else month.when(low.contains(name), f"-{i:02d}-01")
    vague = (
        F.when(low.contains("final de") | low.contains("fim de"), "-12-31")
        .when(low.contains("início de") | low.contains("começo de"), "-01-01")
        .when(low.contains("meados de"), "-06-15")
    )
    return F.coalesce(_joined(c, ISO, (1, 2, 3)), _joined(c, BR, (3, 2, 1)), F.concat(year, F.coalesce(month, vague)))


def plus_business_days(date: Column, days: Column) -> Column:
    """The day ``days`` working days later (closed form); unchanged for 0 days and what is no day."""
    d = date.try_cast("date")
    wd = F.weekday(d)
    start = F.least(wd, F.lit(4))
    moved = F.date_add(d, (start - wd + days + 2 * F.floor((start + days) / 5)).cast("int"))
    ok = date.rlike(r"^\d{4}-\d{2}-\d{2}$") & d.isNotNull() & (days > 0)
    return F.when(ok, F.date_format(moved, "yyyy-MM-dd")).otherwise(date)


def plus_days(date: Column, days: Column, otherwise: Column) -> Column:
    """Calendar days later; ``otherwise`` where the date does not exist."""
    d = F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}$"), date.try_cast("date"))
    return F.coalesce(F.date_format(F.date_add(d, days), "yyyy-MM-dd"), otherwise)


def last_schedule_date(c: Column) -> Column:
    """The last ISO date, else the last DD/MM/YYYY, else empty."""
    iso, br = F.try_element_at(F.regexp_extract_all(c, F.lit(ISO), F.lit(0)), F.lit(-1)), F.try_element_at(F.regexp_extract_all(c, F.lit(BR), F.lit(0)), F.lit(-1))
    return F.coalesce(iso, _joined(br, BR, (3, 2, 1)), F.lit(""))


def br_to_iso(c: Column) -> Column:
    """DD/MM/YYYY of an existing day as ISO, anything else unchanged."""
    t = stripped(c)
    return F.coalesce(F.date_format(F.when(t.rlike(rf"^{BR}$"), _joined(t, BR, (3, 2, 1))).try_cast("date"), "yyyy-MM-dd"), c)


def long_date(c: Column) -> Column:
    """Day, Portuguese month (``marco`` too) and year, with or without "de"; null if none or no month."""
    low = F.regexp_replace(F.lower(c), r"\s+de\s+", " ")
    pattern = r"(\d{1,2})\s+([a-zç]+)\s+(\d{4})"
    name = F.replace(F.regexp_extract(low, pattern, 2), F.lit("marco"), F.lit("março"))
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name)
    day, year = F.regexp_extract(low, pattern, 1), F.regexp_extract(low, pattern, 3)
    return F.when((year != "") & (month > 0), F.concat(year, F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), F.lpad(day, 2, "0")))


def deadline_year(c: Column) -> Column:
    """Year of "Prazo para envio de propostas até: DD/MM/YYYY", null if the day does not exist."""
    day = F.regexp_extract(c, rf"(?iu)prazo para envio de propostas at[ée]:?\s*({BR})", 1)
    return F.year(_joined(day, BR, (3, 2, 1)).try_cast("date"))


def date_range(c: Column) -> Column:
    """``struct(start, end)`` of "DD/MM/YYYY a DD/MM/YYYY", both empty if there is none."""
    pattern = rf"({BR})\s+a\s+({BR})"
    a, b = F.regexp_extract(c, pattern, 1), F.regexp_extract(c, pattern, 5)
    return F.struct(F.coalesce(_joined(a, BR, (3, 2, 1)), F.lit("")).alias("start"), F.coalesce(_joined(b, BR, (3, 2, 1)), F.lit("")).alias("end"))


def start_end(c: Column) -> Column:
    """First and last DD/MM/YYYY (ISO if there is none); one date only: the end is empty."""
    br, iso = F.regexp_extract_all(c, F.lit(BR), F.lit(0)), F.regexp_extract_all(c, F.lit(ISO), F.lit(0))
    found = F.when(F.size(br) > 0, F.transform(br, lambda d: F.concat_ws("-", F.substring(d, 7, 4), F.substring(d, 4, 2), F.substring(d, 1, 2)))).otherwise(iso)
    return F.struct(
        F.coalesce(F.get(found, F.lit(0)), F.lit("")).alias("start"),
        F.when(F.size(found) > 1, F.try_element_at(found, F.lit(-1))).otherwise(F.lit("")).alias("end"),
    )


def latest_year(c: Column) -> Column:
    """The greatest ``20xx`` that stands as a word; null if none."""
    return F.array_max(F.transform(F.regexp_extract_all(c, F.lit(r"(?U)\b(20\d{2})\b"), F.lit(1)), lambda y: y.cast("int")))


def in_window(year: Column, reference: int) -> Column:
    """The reference year or the next; null is not."""
    return F.coalesce(year.between(reference, reference + 1), F.lit(False))


def local_stamp(utc: Column, zone: str = "America/Sao_Paulo") -> Column:
    """A UTC wall time as local time with its offset, ``+HH:MM``."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz"))
    minutes = F.timestamp_diff("MINUTE", utc.cast("timestamp_ntz"), local)
    offset = F.format_string("%s%02d:%02d", F.when(minutes < 0, "-").otherwise("+"), F.floor(F.abs(minutes) / 60), F.abs(minutes) % 60)
    return F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), F.lit(" "), offset)
