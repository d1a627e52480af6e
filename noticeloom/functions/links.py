"""Link functions: absolute addresses, kinds of attachments, form targets."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from noticeloom.constants import DOCUMENT_EXTENSIONS
from noticeloom.functions.text import filled, stripped


@F.pandas_udf(StringType())
def _joined(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([None if h is None else urljoin(b or "", h) for b, h in zip(base, href)])


def absolute(href: Column, base: Column, listing: Column | None = None) -> Column:
    """Empty is the listing page, ``http…`` stays, the rest is joined to ``base``.

    Plain relative paths are joined by the JVM; only ``//host``, ``?query``, ``#part`` and
    dotted paths go through Python.
    """
    h = stripped(F.replace(href, F.lit("\t"), F.lit("")))
    root = F.regexp_extract(base, r"^([a-z]+://[^/?#]+)", 1)
    plain = h.rlike(r"^/?[^/?#:.][^?#:]*$") & ~h.contains("./") & ~h.contains("//") & ~h.rlike(r"/\.\.?$")
    whole_host = base.rlike(r"^[a-z]+://[^/?#]+/?$")
    return (
        F.when(F.coalesce(h, F.lit("")) == "", listing if listing is not None else base)
        .when(h.startswith("http"), h)
        .when(plain & (h.startswith("/") | whole_host), F.concat(root, F.lit("/"), F.regexp_replace(h, "^/+", "")))
        .otherwise(_joined(base, h))
    )


def attachment_type(url: Column) -> Column:
    """The document extension at the end of the address's path, else ``anexo``."""
    path = F.lower(F.trim(F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"[?#;].*$", "")))
    return F.coalesce(filled(F.regexp_extract(path, r"\.(" + "|".join(DOCUMENT_EXTENSIONS) + ")$", 1)), F.lit("anexo"))


def is_document(url: Column) -> Column:
    return attachment_type(url) != "anexo"


def mentions_document(href: Column) -> Column:
    """A document extension anywhere in the address."""
    return F.coalesce(F.lower(href).rlike(r"\.(" + "|".join(DOCUMENT_EXTENSIONS) + ")"), F.lit(False))


def is_pdf(url: Column) -> Column:
    """D16."""
    return F.coalesce(F.lower(url).endswith(".pdf"), F.lit(False))


def detail_attachment(url: Column, label: Column) -> Column:
    """A PDF, or a label that speaks of an attachment, correction, result or call."""
    return is_pdf(url) | F.coalesce(F.lower(label).rlike("anexo|retifica|resultado|edital"), F.lit(False))


def url_category(url: Column) -> Column:
    """Category of a start page from its address."""
    last = F.get(F.split(F.replace(F.element_at(F.split(url, "/"), -1), F.lit("editais-abertos-"), F.lit("")), "-"), F.lit(0))
    return (
        F.when(url.contains("difusao"), "divulgação de conhecimento")
        .when(url.contains("extensao"), "extensão").when(url.contains("pesquisa"), "pesquisa")
        .when(url.contains("inovacao"), "inovação").when(url.contains("internacional"), "internacional").otherwise(last)
    )


def postback_target(href: Column) -> Column:
    """C13."""
    return F.regexp_extract(href, r"__doPostBack\('([^']+)'", 1)


def total_pages(hrefs: Column) -> Column:
    """C14: the greatest page named in pager links, 1 at least."""
    pages = F.transform(hrefs, lambda h: F.coalesce(filled(F.regexp_extract(h, r"Page\$(\d+)", 1)).cast("int"), F.lit(1)))
    return F.greatest(F.lit(1), F.coalesce(F.array_max(pages), F.lit(1)))


def quoted(c: Column) -> Column:
    """Percent-encoding of everything but letters, digits and ``_.-~``."""
    return F.replace(F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def download_link(detail: Column, target: Column) -> Column:
    """Address of an attachment behind a form target."""
    return F.concat(detail, F.lit("#downloadTarget="), quoted(target))
