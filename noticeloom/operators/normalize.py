"""Raw records to domain records: one chain of narrow column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.constants import CATEGORY_WORDS, DOMAIN_SCHEMA, EVENT, RAW_SCHEMA
from noticeloom.functions.text import agency, filled, notice_title, status, stripped
from noticeloom.operators.classify import settled_category
from noticeloom.operators.schedule import closing_date, normalized, opening_date
from noticeloom.operators.select import merged_attachments, ordered_distinct

DOMAIN = ["nome", "descrição", "orgão_fomento", "categoria", "status", "data_abertura", "data_encerramento", "link", "cronograma", "tags", "anexos"]


def with_raw_columns(df: DataFrame) -> DataFrame:
    """``df`` with every column of the raw schema (missing ones null)."""
    for field in RAW_SCHEMA.replace(">, ", ">|").split(", "):
        for part in field.split("|"):
            name, kind = part.split(" ", 1)
            if name not in df.columns:
                df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def split_valid(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(records with a title, rejected records)``; a null or blank title rejects a record, not the run."""
    ok = F.coalesce(stripped("title") != "", F.lit(False))
    return raw.where(ok), raw.where(~ok)


def _appended(tags: Column, value: Column, cond: Column) -> Column:
    return F.when(cond & ~F.array_contains(tags, value), F.array_append(tags, value)).otherwise(tags)


def domain_records(raw: DataFrame, extracted: Column | None = None, category: Column | None = None) -> DataFrame:
    """The eleven domain columns, all other columns kept.

    ``extracted``: a column with what was read from the PDF (null: nothing); ``category``: a
    classifier's answer for descriptions of agencies that need one.
    """
    none = F.array().cast("array<string>")
    raw = raw.withColumns({
        "__title": notice_title(F.col("title")), "__agency": agency(F.col("raw_agency")), "__status": status(F.col("raw_status")),
        "__desc": F.coalesce("raw_description", F.lit("")), "__kind": F.coalesce("document_type", F.lit("edital")),
        "__raw": F.coalesce("raw_cronograma", F.array().cast(f"array<{EVENT}>")), "__finep": F.coalesce(F.upper("raw_agency").contains("FINEP"), F.lit(False)),
        "__anexos": merged_attachments(F.col("raw_anexos"), F.col("attachments")),
    })
    raw = raw.withColumn("__schedule", normalized(F.col("__raw")))
    raw = raw.withColumns({"__open": opening_date(F.col("__schedule")), "__close": closing_date(F.col("__raw"), F.col("__schedule"))})
    text = F.lower(F.concat_ws(" ", "__desc", "__title"))
    word = None
    for w in CATEGORY_WORDS:
        word = F.when(text.contains(w), w) if word is None else word.when(text.contains(w), w)
    answer = settled_category(category if category is not None else F.lit(CATEGORY_WORDS[-1]))
    raw = raw.withColumn("__word", word).withColumn(
        "__category",
        F.when(F.col("__finep"), F.when(F.col("__desc") != "", answer).otherwise(F.coalesce(filled(F.col("source_category")), F.lit("outros")))).otherwise(F.coalesce("__word", filled(F.col("source_category")), F.lit("outros"))),
    )
    own = F.coalesce("raw_tags", none)
    default = F.when(F.col("__finep"), F.array(F.lit("finep"), F.lit("chamada pública"))).otherwise(F.array(F.lit("fapes"), F.lit("documento")))
    tags = F.when(F.size(own) > 0, own).otherwise(default)
    for kind in ("anexo", "alteração"):
        tags = _appended(tags, F.lit(kind), F.col("__kind") == kind)
    raw = raw.withColumn("__tags", tags)
    raw = raw.withColumn("__tags", _appended(F.col("__tags"), F.when(F.col("__finep"), F.col("__category")).otherwise(F.col("__word")), F.col("__finep") | F.col("__word").isNotNull()))
    raw = raw.withColumn("__tags", _appended(F.col("__tags"), F.lit("bolsa"), text.contains("bolsa")))
    prefix = F.when(F.col("__kind") == "anexo", "[ANEXO] ").when(F.col("__kind") == "alteração", "[ALTERAÇÃO] ").otherwise("")
    name = F.concat(prefix, F.col("__title"))
    basic = {
        "nome": name, "descrição": F.coalesce(filled(F.col("__desc")), F.concat(F.lit("Edital de fomento "), "__agency", F.lit(": "), name)),
        "orgão_fomento": F.col("__agency"), "categoria": F.col("__category"), "status": F.col("__status"), "data_abertura": F.col("__open"),
        "data_encerramento": F.col("__close"), "link": F.col("url"), "cronograma": F.col("__schedule"), "tags": F.col("__tags"), "anexos": F.col("__anexos"),
    }
    if extracted is not None:
        x = extracted
        use = x.isNotNull() & F.col("pdf_content").isNotNull() & F.col("__kind").isin("edital", "alteração")
        changed = F.col("__kind") == "alteração"
        read_tags = F.coalesce(x["tags"], none)
        merged = {
            "nome": F.when(changed, F.concat(F.lit("[ALTERAÇÃO] "), x["nome"])).otherwise(x["nome"]), "descrição": x["descrição"], "orgão_fomento": F.col("__agency"),
            "categoria": F.coalesce(filled(F.col("source_category")), x["categoria"]), "status": F.col("__status"), "data_abertura": F.col("__open"),
            "data_encerramento": F.coalesce(filled(F.col("__close")), x["data_encerramento"]), "link": F.col("url"), "cronograma": F.col("__schedule"),
            "tags": ordered_distinct(F.when(changed, F.array_append(read_tags, F.lit("alteração"))).otherwise(read_tags), own), "anexos": F.col("__anexos"),
        }
        basic = {k: F.when(use, merged[k]).otherwise(basic[k]) for k in basic}
    kept = [c for c in raw.columns if not c.startswith("__") and c not in DOMAIN]
    return raw.select(*[F.col(f"`{c}`") for c in kept], *[v.alias(k) for k, v in basic.items()])


def record_from_answer(answer: Column) -> Column:
    """A language model's JSON as a domain record, with a default for each field."""
    event = "struct<evento:string,etapa:string,data:string>"
    parsed = F.from_json(answer, f"nome string, `descrição` string, `orgão_fomento` string, categoria string, cronograma array<{event}>, tags array<string>")
    default_tags = F.array(*[F.lit(t) for t in ("fapes", "edital", "inovação")])
    tags = F.coalesce(parsed["tags"], F.array().cast("array<string>"))
    items = F.transform(F.coalesce(parsed["cronograma"], F.array().cast(f"array<{event}>")), lambda i: F.struct(F.coalesce(i["evento"], i["etapa"], F.lit("")).alias("evento"), F.coalesce(i["data"], F.lit("")).alias("data")))
    return F.when(parsed.isNotNull(), F.struct(
        F.upper(F.coalesce(parsed["nome"], F.lit(""))).alias("nome"), F.coalesce(parsed["descrição"], F.lit("")).alias("descrição"),
        F.upper(F.coalesce(parsed["orgão_fomento"], F.lit("FAPES"))).alias("orgão_fomento"), F.lower(F.coalesce(parsed["categoria"], F.lit("outros"))).alias("categoria"),
        items.alias("cronograma"), F.when(F.size(tags) > 0, tags).otherwise(default_tags).alias("tags"),
    ))


__all__ = ["DOMAIN", "DOMAIN_SCHEMA", "domain_records", "record_from_answer", "split_valid", "with_raw_columns"]
