"""Mixed timestamp spellings to one UTC instant.

Everything is a JVM expression: an ordered cascade of anchored patterns, each of which
rewrites a value into one canonical field list, followed by strict calendar checks and one
zone conversion. Session time zone and ANSI mode have no influence.

Cases and their results: null, blank, free text, days or times that do not exist, months
without a day, spans and relative terms give null; surrounding and repeated white space
(NBSP and tabs too) is ignored; an unknown zone name gives null; 24:00 is the next day's
00:00; two-digit years are 20xx; a bare day is its 00:00.
"""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------
PT_MONTHS = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"]
EN_MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
#: Fixed offsets of zone abbreviations, in minutes.
ABBREVIATIONS = {"z": 0, "utc": 0, "gmt": 0, "brt": -180, "brst": -120, "amt": -240, "cet": 60, "cest": 120}
#: Places named in words and their civil time.
PLACES = {"brasilia": "America/Sao_Paulo", "manaus": "America/Manaus", "bruxelas": "Europe/Brussels", "fortaleza": "America/Fortaleza", "sao paulo": "America/Sao_Paulo", "lisboa": "Europe/Lisbon", "londres": "Europe/London"}
# ------------------------------------------------------------------------------------



def zone_table(spark: SparkSession) -> DataFrame:
    """Every zone name this module knows, lower case, with its region or its fixed offset.

    Bounded by the time zone database (some 600 rows), hence broadcast without a check.
    """
    rows = {z.lower(): (z, None) for z in available_timezones() if "/" in z}
    rows |= {name: (region, None) for name, region in PLACES.items()}
    rows |= {name: (None, minutes) for name, minutes in ABBREVIATIONS.items()}
    return spark.createDataFrame([(k, *v) for k, v in sorted(rows.items())], "__ts_key string, __ts_reg string, __ts_fixed int")


_DAY = r"(\d{1,2})"
_CLOCK = r"(\d{1,2})(?:h|:(?=\d))(\d{2})?(?:min)?(?::(\d{2}))?"
_PLACE = r"(?: ?\(?(?:horário|hora) (?:de|do) ([a-zà-ÿ ]+)\)?)"
_ABBR = r"(?: ?((?:gmt|utc)[+-]\d{1,2}(?::?\d{2})?|utc|gmt|brst|brt|amt|cest|cet|z|[+-]\d{2}:?\d{2}))"
_ZONE = rf"(?:{_PLACE}|{_ABBR})?"
_WEEKDAY = r"(?:(?:segunda|terça|quarta|quinta|sexta)-feira|sábado|domingo|[a-z]{3})"
_MONTH = r"([a-zç]{3,9})\.?"

#: (name, pattern, canonical fields). Fields: year;month;day;hour;minute;second;fraction;am/pm;zone.
#: The first pattern that matches the whole value decides.
CASCADE: list[tuple[str, str, str]] = [
    ("iso_day", r"^(\d{4})-(\d{2})-(\d{2})$", "$1;$2;$3;;;;;;"),
    ("iso_time", r"^(\d{4})-(\d{2})-(\d{2})[t ](\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)? ?(z|[+-]\d{2}(?::?\d{2})?|utc|gmt|brst|brt|amt|cest|cet|\[?[a-z_]+/[a-z_/]+\]?)?$", "$1;$2;$3;$4;$5;$6;$7;;$8"),
    ("compact", r"^(\d{4})(\d{2})(\d{2})(?:t(\d{2})(\d{2})(\d{2})?(z|[+-]\d{2}:?\d{2})?)?$", "$1;$2;$3;$4;$5;$6;;;$7"),
    ("digits", rf"^{_DAY}([/.-])(\d{{1,2}})\2(\d{{4}}|\d{{2}})(?:(?:,| -| às| as)? {_CLOCK}{_ZONE})?$", "$4;$3;$1;$5;$6;$7;;;$8$9"),
    ("until_digits", rf"^até [aà]s {_CLOCK} de {_DAY}([/.-])(\d{{1,2}})\5(\d{{4}}|\d{{2}}){_ZONE}$", "$7;$6;$4;$1;$2;$3;;;$8$9"),
    ("month_slash", rf"^{_DAY}([/.-]){_MONTH}\2(\d{{4}}|\d{{2}})(?:(?:,| -| às| as)? {_CLOCK}{_ZONE})?$", "$4;$3;$1;$5;$6;$7;;;$8$9"),
    ("long", rf"^(?:{_WEEKDAY}, )?(\d{{1,2}})[ºo°]?(?: de)? {_MONTH}(?: de)? (\d{{4}})(?:(?:,| -| às| as)? {_CLOCK}{_ZONE})?$", "$3;$2;$1;$4;$5;$6;;;$7$8"),
    ("time_of_long", rf"^(?:até [aà]s )?{_CLOCK} (?:do dia|de) (\d{{1,2}})[ºo°]?(?: de)? {_MONTH}(?: de)? (\d{{4}}){_ZONE}$", "$6;$5;$4;$1;$2;$3;;;$7$8"),
    ("time_of_digits", rf"^{_CLOCK} do dia {_DAY}([/.-])(\d{{1,2}})\5(\d{{4}}|\d{{2}}){_ZONE}$", "$7;$6;$4;$1;$2;$3;;;$8$9"),
    ("mail", rf"^(?:[a-z]{{3}}, )?(\d{{1,2}}) {_MONTH} (\d{{4}}) (\d{{2}}):(\d{{2}})(?::(\d{{2}}))? ?([+-]\d{{4}}|[a-z]{{1,4}})$", "$3;$2;$1;$4;$5;$6;;;$7"),
    ("us", rf"^{_MONTH} (\d{{1,2}}), (\d{{4}})(?: (\d{{1,2}}):(\d{{2}})(?::(\d{{2}}))? ?(am|pm){_ZONE})?$", "$3;$1;$2;$4;$5;$6;;$7;$8$9"),
]


def tidy(value: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.lower(F.trim(F.regexp_replace(value, r"(?U)[\s ​﻿]+", " ")))


def _month_map() -> Column:
    pairs: dict[str, str] = {}
    for names in (EN_MONTHS, PT_MONTHS):
        for i, name in enumerate(names, 1):
            pairs[name] = pairs[name[:3]] = str(i)
    pairs |= {"marco": "3", "sept": "9"}
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def canonical_fields(value: Column) -> Column:
    """The canonical field list of a value, or null where no pattern matches."""
    v = tidy(value)
    out = None
    for _, pattern, fields in CASCADE:
        hit, new = v.rlike(pattern), F.regexp_replace(v, pattern, fields)
        out = F.when(hit, new) if out is None else out.when(hit, new)
    return out


def with_utc(df: DataFrame, value: str, default_zone: str, out: str = "utc") -> DataFrame:
    """Adds ``out``: the UTC instant of string column ``value`` as ``YYYY-MM-DDTHH:MM:SS.ffffffZ``.

    ``default_zone`` names the column with the zone of values that name none (null: UTC is
    *not* assumed, the value stays without an instant). Wall times that occur twice mean the
    earlier instant, skipped ones move forward by the gap. Helper columns carry a prefix
    that other columns cannot clash with and are dropped again; other columns stay as they are.
    """
    p = "__ts_"
    c = lambda name: F.col(p + name)
    field = lambda i: F.nullif(F.get(c("f"), F.lit(i)), F.lit(""))
    num = lambda x: x.try_cast("int")
    df = df.withColumn(p + "v", tidy(F.col(f"`{value}`")))
    df = df.withColumn(p + "f", F.split(canonical_fields(F.col(f"`{value}`")), ";", -1))
    month = F.coalesce(num(field(1)), num(F.try_element_at(_month_map(), field(1))))
    year = F.when(F.length(field(0)) == 2, num(field(0)) + 2000).otherwise(num(field(0)))
    df = df.withColumns({
        p + "day": F.format_string("%04d-%02d-%02d 00:00:00", year, month, num(field(2))).try_cast("timestamp_ntz"),
        p + "ok": F.coalesce(month.between(1, 12) & num(field(2)).between(1, 31) & year.between(1, 9999), F.lit(False)),
        p + "h": F.when(field(7).isNull(), F.coalesce(num(field(3)), F.lit(0))).when(num(field(3)).between(1, 12), num(field(3)) % 12 + F.when(field(7) == "pm", 12).otherwise(0)).otherwise(F.lit(99)),
        p + "m": F.coalesce(num(field(4)), F.lit(0)),
        p + "s": F.coalesce(num(field(5)), F.lit(0)),
        p + "us": F.coalesce(num(F.substring(F.rpad(field(6), 9, "0"), 1, 6)), F.lit(0)),
        p + "z": F.translate(F.translate(field(8), "áãíóâéç", "aaioaec"), "[]()", ""),
    })
    clock_ok = (c("h").between(0, 23) | ((c("h") == 24) & (c("m") == 0) & (c("s") == 0))) & c("m").between(0, 59) & c("s").between(0, 59)
    z = F.trim(c("z"))
    digits = F.regexp_replace(F.regexp_extract(z, r"^(?:gmt|utc)?([+-]\d{1,2}(?::?\d{2})?)$", 1), ":", "")
    sign = F.when(digits.startswith("-"), -1).otherwise(1)
    hh = num(F.regexp_extract(digits, r"^[+-](\d{1,2}?)(?:\d{2})?$", 1))
    plain = F.regexp_extract(digits, r"^[+-](\d{1,2})$", 1)
    offset = F.when(
        digits != "",
        F.when(plain != "", sign * num(plain) * 60).otherwise(sign * (hh * 60 + num(F.regexp_extract(digits, r"(\d{2})$", 1)))),
    )
    df = df.withColumns({
        p + "local": F.when(
            c("ok") & clock_ok,
            F.timestamp_add("MICROSECOND", (c("h") * 3600 + c("m") * 60 + c("s")).cast("long") * 1_000_000 + c("us"), c("day")),
        ),
        p + "off": offset,
        p + "key": F.when(z.isNull(), F.lower(F.col(f"`{default_zone}`"))).otherwise(z),
    })
    df = df.join(F.broadcast(zone_table(df.sparkSession)), p + "key", "left")
    shift = F.coalesce(c("off"), c("fixed"))
    count = F.when(c("v").rlike(r"^\d{10}$"), c("v").try_cast("long") * 1_000_000).when(c("v").rlike(r"^\d{13}$"), c("v").try_cast("long") * 1000).when(c("v").rlike(r"^\d{16}$"), c("v").try_cast("long"))
    instant = (
        F.when(count.isNotNull(), F.timestamp_add("MICROSECOND", count, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))
        .when(shift.isNotNull(), F.timestamp_add("MINUTE", -shift, c("local")))
        .when(c("reg").isNotNull() & c("local").isNotNull(), F.convert_timezone(c("reg"), F.lit("UTC"), c("local")))
    )
    df = df.withColumn(out, F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return df.drop(*[p + x for x in ("v", "f", "day", "ok", "h", "m", "s", "us", "z", "local", "off", "key", "reg", "fixed")])
