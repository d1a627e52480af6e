"""Injectable classification and extraction, with deterministic defaults and retry for rate limits."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import TypeVar

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.constants import DOMAIN_SCHEMA, FINEP_CATEGORIES
from noticeloom.functions.text import stripped

T = TypeVar("T")


def document_kind(title: Column) -> Column:
    """Kind of a document by the words of its title."""
    low = F.lower(title)
    return F.when(low.rlike("anexo|formulário|declaração"), "anexo").when(low.rlike("alteração|retificação|aditivo"), "alteração").otherwise("edital")


def settled_category(answer: Column) -> Column:
    """A classifier's answer as one of the allowed categories: exact, else one inside the other, else the last."""
    a = F.lower(stripped(F.coalesce(answer, F.lit(""))))
    out = F.when(a.isin(FINEP_CATEGORIES), a)
    for allowed in FINEP_CATEGORIES:
        out = out.when(a.contains(allowed) | F.lit(allowed).contains(a), allowed)
    return out.otherwise(FINEP_CATEGORIES[-1])


def retried(call: Callable[[], T], tries: int = 10, wait: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> T:
    """``call`` again after a growing pause while it fails for a rate limit; other errors pass."""
    for attempt in range(tries):
        try:
            return call()
        except Exception as error:
            text = str(error).lower()
            if attempt + 1 == tries or not ("429" in text or "rate" in text and "limit" in text):
                raise
            sleep(wait * 2**attempt)
    raise RuntimeError("no attempt made")


def extracted(df: DataFrame, extractor: Callable[[bytes, str], str | None] | None, key: str, pdf: str = "pdf_content", title: str = "title") -> DataFrame:
    """``key, extracted`` (a domain record) of the rows with a PDF; null where nothing came out.

    ``extractor(pdf, file name)`` gives JSON or null; an error counts as null. Without one
    nothing is extracted. The PDF bytes go no further than this operator.
    """
    record = "struct<" + ", ".join(f"{n}:{t}" for n, t in (x.split(" ", 1) for x in DOMAIN_SCHEMA.split(", "))) + ">"
    rows = df.where(F.col(pdf).isNotNull()).select(key, F.col(pdf).alias("pdf"), F.col(title).alias("title"))
    if extractor is None:
        return rows.select(key, F.lit(None).cast(record).alias("extracted"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for pdf_bytes, name in zip(batch["pdf"], batch["title"]):
                try:
                    out.append(retried(lambda: extractor(pdf_bytes, f"{name}.pdf"), tries=3, wait=15.0))
                except Exception:
                    out.append(None)
            yield pd.DataFrame({key: batch[key], "answer": out})

    answers = rows.mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, answer string")
    return answers.select(key, F.from_json("answer", record, {"mode": "PERMISSIVE"}).alias("extracted"))
