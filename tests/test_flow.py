"""Registry, normalization, sinks, pipeline and stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from noticeloom.functions import links, text
from noticeloom.operators import registry as reg
from noticeloom.operators.classify import retried
from noticeloom.operators.normalize import domain_records, with_raw_columns
from noticeloom.operators.select import best_title
from noticeloom.plans import pipeline
from noticeloom.sinks.json_files import folder_stats, read_files, write_files
from noticeloom.streaming.incremental import new_records, run_once


def raw(spark, **fields):
    return with_raw_columns(spark.createDataFrame([fields], ", ".join(f"{k} {'binary' if k == 'pdf_content' else 'string'}" for k in fields)))


def test_registry(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps({"fapes": ["a", "b"], "finep": ["x"]}))
    r = reg.read_json(spark, str(path))
    assert sorted((x.source, x.chave, x.seq) for x in r.collect()) == [("fapes", "a", 0), ("fapes", "b", 1), ("finep", "x", 0)]
    assert reg.read_json(spark, str(tmp_path / "none.json")).count() == 0
    new = spark.createDataFrame([("fapes", "c", 2), ("fapes", "a", 1), ("fapes", "c", 9), ("zz", "q", 1), ("finep", "", 1), ("cnpq", "n", 5)], "source string, chave string, at int")
    added = reg.appended(r, new, "at")
    assert sorted(map(tuple, added.collect())) == [("cnpq", "n", 0), ("fapes", "c", 2)]
    back = json.loads(reg.write_json(r.unionByName(added)).first().json)
    assert back["fapes"] == ["a", "b", "c"] and back["capes"] == [] and len(back) == 7
    assert reg.contains(r, "fapes", "a") and not reg.contains(r, "zz", "a")
    assert [x.chave for x in reg.keys_of(r, "fapes").collect()] == ["a", "b"]
    assert {x.source: x.added for x in reg.deltas(r, r.unionByName(added)).collect()} == {"fapes": 1, "finep": 0, "cnpq": 1}


def test_domain_record(spark):
    r = domain_records(raw(spark, title="  edital  de teste ", url="u", raw_agency="Fapes-ES", raw_description="Ação de extensão com bolsa", document_type="anexo")).first().asDict(recursive=True)
    assert r["nome"] == "[ANEXO] EDITAL DE TESTE" and r["orgão_fomento"] == "FAPES" and r["categoria"] == "extensão" and r["status"] == "aberto"
    assert r["tags"] == ["fapes", "documento", "anexo", "extensão", "bolsa"] and r["data_abertura"] == "2026-01-01" and r["data_encerramento"] == "" and r["cronograma"] == []


def test_pipeline(spark, tmp_path):
    rows = raw(spark, title="Chamada 1", url="u1", raw_agency="cnpq").unionByName(raw(spark, title=" ", url="u2")).unionByName(raw(spark, title="Chamada 3", url="u3"))
    registry = spark.createDataFrame([("cnpq", "u3", 0)], "source string, chave string, seq bigint")
    records, rejected, added = pipeline.run(rows, registry, "cnpq", sink=lambda d: write_files(d.withColumn("n", F.lit(1)), "n", str(tmp_path)).collect())
    assert [r.nome for r in records.collect()] == ["CHAMADA 1"] and rejected.count() == 1 and [tuple(r) for r in added.collect()] == [("cnpq", "u1", 1)]
    assert os.listdir(tmp_path) == ["chamada_1.json"]
    (tmp_path / "broken.json").write_text("{")
    (tmp_path / "note.txt").write_text("x")
    assert [(r.file, r.nome) for r in read_files(spark, str(tmp_path)).collect()] == [("chamada_1", "CHAMADA 1")]
    assert folder_stats(spark, str(tmp_path)).first()[:] == (2, "note.txt")


def test_extraction(spark):
    rows = raw(spark, title="Chamada 1", url="u1", raw_agency="cnpq", pdf_content=b"%PDF-1.4", document_type="alteração")
    registry = spark.createDataFrame([], "source string, chave string, seq bigint")

    def extractor(pdf, name):
        return json.dumps({"nome": "LIDO", "categoria": "pesquisa", "tags": ["a"]})

    r = pipeline.run(rows, registry, "cnpq", extractor=extractor)[0].first()
    assert r.nome == "[ALTERAÇÃO] LIDO" and r.categoria == "pesquisa" and r.tags == ["a", "alteração"]
    failing = pipeline.run(rows, registry, "cnpq", extractor=lambda p, n: 1 / 0)[0].first()
    assert failing.nome == "[ALTERAÇÃO] CHAMADA 1"


def test_runner_and_retry():
    log, waits, calls = [], [], []
    assert pipeline.run_all([("a", lambda: 0), ("b", lambda: 3), ("c", lambda: 0)], lambda n, c: log.append((n, c))) == 3
    assert log == [("a", 0), ("b", 3)]

    def limited():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("429 too many")
        return 5

    assert retried(limited, sleep=waits.append) == 5 and waits == [60.0, 120.0]
    with pytest.raises(ValueError):
        retried(lambda: int("x"), sleep=waits.append)


def test_stream(spark, tmp_path):
    schema, src, out, mark = "source string, chave string", str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")
    put = lambda rows: spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
    for rows, total in (([("a", "1"), ("a", "1"), ("a", None)], 1), ([("a", "1"), ("b", "1")], 2), ([("b", "1")], 2)):
        put(rows)
        run_once(new_records(spark, src, schema), out, mark)
        assert spark.read.schema(schema).parquet(out).count() == total


def test_links_and_text(spark):
    one = spark.range(1)
    lit = F.lit
    got = one.select(*[links.absolute(lit(h), lit("https://a.example"), lit("https://a.example/l")) for h in ("", "http://b/x", "/x/y.pdf", "x", "//c/d", "?q=1", "../z", "#f")]).first()[:]
    assert got == ("https://a.example/l", "http://b/x", "https://a.example/x/y.pdf", "https://a.example/x", "https://c/d", "https://a.example?q=1", "https://a.example/z", "https://a.example#f")
    assert one.select(links.quoted(lit("a b~*$/é"))).first()[0] == "a%20b~%2A%24%2F%C3%A9"
    assert one.select(links.total_pages(F.array(lit("x"), lit("javascript:__doPostBack('g','Page$12')")))).first()[0] == 12
    assert one.select(text.file_key(lit("Edital Nº 1/2026 (x)"))).first()[0] == "edital_nº_12026_x"
    assert one.select(text.file_key(lit("///"))).first()[0] == "edital_anonimo" and len(one.select(text.file_key(lit("a" * 200))).first()[0]) == 147
    assert one.select(best_title(F.array(lit("baixar"), lit("Edital"), lit("Edital 5"), lit("pdf")))).first()[0] == "Edital 5"
