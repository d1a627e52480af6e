"""Text functions: column expressions only.

Blanks are Unicode white space (``(?U)\\s``), letters ``\\p{L}``, case folding is Java's.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeloom.constants import GENERIC_TITLES


def squeezed(c: Column) -> Column:
    """Runs of white space (NBSP too) as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def stripped(c: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def filled(c: Column) -> Column:
    """Null for the empty string."""
    return F.nullif(c, F.lit(""))


def notice_title(c: Column) -> Column:
    """Squeezed and in upper case."""
    return F.upper(squeezed(c))


def agency(c: Column, default: str = "FAPES") -> Column:
    """Upper case; null, empty and every spelling that contains the default are the default."""
    up = F.upper(F.coalesce(filled(c), F.lit(default)))
    return F.when(up.contains(default), default).otherwise(up)


def status(c: Column) -> Column:
    """D3: stripped lower case, ``aberto`` where there is none."""
    return F.coalesce(filled(F.lower(stripped(c))), F.lit("aberto"))


def file_key(name: Column, fallback: Column | str = "edital_anonimo", hashed: int = 150) -> Column:
    """Base name of a notice's file: letters, digits and `` ._-``; long names are cut and hashed."""
    base = F.regexp_replace(F.regexp_replace(name, r"[^\p{L}\p{N} ._-]", ""), r"\s+$", "")
    base = F.coalesce(filled(base), F.lit(fallback) if isinstance(fallback, str) else fallback)
    cut = F.when(F.length(base) > hashed, F.concat(F.substring(base, 1, 140), F.lit("_"), F.substring(F.md5(name.cast("binary")), 1, 6))).otherwise(base)
    return F.lower(F.replace(cut, F.lit(" "), F.lit("_")))


def link_title(text: Column, url: Column) -> Column:
    """A generic or empty link text is replaced by the file name of the link."""
    name = F.regexp_replace(F.element_at(F.split(url, "/"), -1), r"\.(pdf|docx)", "")
    generic = F.lower(stripped(F.coalesce(text, F.lit("")))).isin([*GENERIC_TITLES, ""])
    return F.when(generic, F.replace(name, F.lit("_"), F.lit(" "))).otherwise(stripped(text))


def without_back_link(c: Column) -> Column:
    """Squeezed, without a leading "Voltar"."""
    return squeezed(F.regexp_replace(squeezed(c), r"^Voltar\s*", ""))


def contains_any(c: Column, tokens: list[str]) -> Column:
    """The lower-cased text contains one of the tokens."""
    low = F.lower(c)
    out = low.contains(tokens[0])
    for t in tokens[1:]:
        out = out | low.contains(t)
    return F.coalesce(out, F.lit(False))


def section(text: Column, start: str, stops: list[str]) -> Column:
    """C20: squeezed text from ``start`` to the nearest of ``stops``; empty without ``start``."""
    at = F.instr(text, start)
    rest = F.substring(text, at, F.length(text))
    ends = F.array_min(F.filter(F.array(*[F.instr(rest, s) for s in stops]), lambda p: p > 1))
    cut = F.when(ends.isNotNull(), F.substring(rest, F.lit(1), ends - 1)).otherwise(rest)
    return F.when(at > 0, squeezed(cut)).otherwise(F.lit(""))


def rate_limited(message: Column) -> Column:
    """Whether an error message speaks of a rate limit."""
    low = F.lower(message)
    return F.coalesce(low.contains("429") | (low.contains("rate") & low.contains("limit")), F.lit(False))


def observation(source: Column, before: Column, after: Column, files: Column, others: Column, code: Column) -> Column:
    """What a run's log row says; bars would break the table and become slashes."""
    text = F.format_string(
        "Registry `%s`: %d -> %d (delta %d); `data/output/` com %d JSONs; arquivos não-JSON: %s.%s",
        source, before, after, after - before, files, F.coalesce(filled(others), F.lit("nenhum")), F.when(code != 0, F.format_string(" Fluxo encerrou com exit code %d.", code)).otherwise(F.lit("")),
    )
    return F.replace(text, F.lit("|"), F.lit("/"))
