"""Tables, extraction plan, search answers and small functions."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from indexloom import seeds
from indexloom.functions import scalars
from indexloom.operators import discovery
from indexloom.plans import extraction, tables
from indexloom.sources import providers, readers


def test_bootstrap_is_idempotent(spark, tmp_path):
    folder = str(tmp_path)
    for _ in range(2):
        tables.bootstrap(spark, folder)
    assert tables.read(spark, folder, "criteria").count() == len(seeds.CRITERIA)
    assert tables.read(spark, folder, "trusted_sources").count() == len(tables.TRUSTED)
    assert tables.read(spark, folder, "criterion_scores").count() == 0


def test_upserts_follow_the_keys(spark, tmp_path):
    folder = str(tmp_path)
    one = spark.createDataFrame([(1, "XA", "Old", ["A"], 1)], "id bigint, iso_code string, name string, aliases array<string>, q int")
    two = spark.createDataFrame([(9, "XA", "New", ["B"], 2), (2, "XB", "Other", None, 1)], "id bigint, iso_code string, name string, aliases array<string>, q int")
    tables.write(one, folder, "countries", ["q"])
    got = {r.iso_code: r for r in tables.write(two, folder, "countries", ["q"]).collect()}
    assert (got["XA"].id, got["XA"].name, got["XA"].aliases) == (1, "New", ["A"]) and got["XB"].name == "Other"
    ind = spark.createDataFrame([(1, 1, "s", "i", None, 1.0), (1, 1, "s", "i", 2020, 2.0)], "country_id bigint, pi_criterion_number int, source_name string, indicator_name string, source_year int, indicator_value double")
    for _ in range(2):
        after = tables.write(ind, folder, "external_indicators", ["indicator_value"])
    assert sorted(r.source_year or 0 for r in after.collect()) == [0, 0, 2020]  # null years pile up


def test_replaced_documents_leave_no_old_sections(spark, tmp_path):
    folder, schema = str(tmp_path), "document_id bigint, section_index int, section_text_original string"
    tables.write(spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], schema), folder, "section_extractions", ["section_index"])
    got = tables.write(spark.createDataFrame([(1, 0, "new")], schema), folder, "section_extractions", ["section_index"], replace_by=["document_id"])
    assert {(r.document_id, r.section_text_original) for r in got.collect()} == {(1, "new"), (2, "c")}


def test_extraction_plan(spark):
    law = "The controller shall protect personal data of each person whatever the purpose of its processing may have been before."
    docs = spark.createDataFrame([(1, f"Art. 1 {law}\nArt. 2 {law} B\nArt. 3 The tax rate of the year is set by the assembly in its session of spring and holds for all until it ends.", "en"), (2, "short", "en"), (3, None, "en")], "doc_id int, t string, lang string")
    cut = extraction.gated_sections(docs, "doc_id", "t", "lang")
    assert sorted((r.section_index, r.outcome) for r in cut.collect()) == [(0, "pass"), (1, "pass"), (2, "no-signal")]
    asked = extraction.requests(cut, "doc_id", scalars.filled("Read {{this}}: {t}", t=F.col("text")))
    answers = providers.called(asked, lambda p: '{"rights": ["access", "access"], "dpa": "Office", "notes": "n"}' if p.endswith("B") else '{"rights": [], "dpa": null}')
    got = extraction.extracted(cut, asked, answers, "doc_id")
    rec = extraction.records(got, "doc_id", ["rights"], {"dpa": "string"}).collect()
    assert len(rec) == 1 and (rec[0].rights, rec[0].dpa, rec[0].notes, rec[0].n_sections, rec[0].n_signal, rec[0].n_errors) == (["access"], "Office", "[§1] n", 3, 1, 1)
    due = got.select("doc_id", "section_index", "all_null", F.col("text").alias("section_text_original"), F.lit(None).cast("array<float>").alias("embedding"), F.lit(None).cast("string").alias("embedded_hash"))
    assert extraction.due_vectors(due, "doc_id", 20).first().payload == law[:20]
    assert extraction.merged_schema(StructType.fromDDL("a int, b string"), StructType.fromDDL("b string, c int")).fieldNames() == ["a", "b", "c", "notes"]


def test_search_answers_and_sources(spark):
    rows = [("q1", '{"organic_results": [{"link": "http://a.b/x", "title": "T"}, {"title": "no link"}]}'), ("q2", '{"error": "limit"}'), ("q3", None), ("q4", "no json")]
    found, failed = readers.search_results(spark.createDataFrame(rows, "q string, response string"), ["q"])
    assert [(r.q, r.url, r.position, r.domain) for r in found.collect()] == [("q1", "http://a.b/x", 1, "a.b")]
    assert {r.q: r.error for r in failed.collect()} == {"q2": "limit", "q3": "no answer", "q4": "no answer"}
    got, errors = readers.collected({"good": lambda: spark.range(2), "bad": lambda: spark.read.parquet("/nowhere")})
    assert got.count() == 2 and errors["good"] is None and "Exception" in errors["bad"]
    answer = spark.createDataFrame([('{"name": "Ostrana", "iso_code": "xbx"}', None), (None, "failed")], "response string, error string")
    assert readers.entity_rows(answer).collect() == [("Ostrana", "XB", "", [], [])]


def test_small_functions(spark):
    df = spark.createDataFrame([("court_decision", "zh", "TW"), ("x", "en", None)], "t string, l string, r string")
    assert [tuple(r) for r in df.select(scalars.titled(F.col("t")), scalars.search_language(F.col("l"), F.col("r"))).collect()] == [("Court Decision", "zh-TW"), ("X", "en")]
    gaps = spark.createDataFrame([(" None ",), ("n/a",), (None,), ("no budget",)], "g string")
    assert [r[0] for r in gaps.select(discovery.meaningful(F.col("g"))).collect()] == [False, False, False, True]
    again = providers.retried(spark.createDataFrame([("a",), ("b",)], "request_key string"), spark.createDataFrame([("a", "ok", None, 1), ("b", "", None, 1)], "request_key string, response string, error string, tokens bigint"), spark.createDataFrame([("a", "1"), ("b", "2")], "request_key string, payload string"), lambda p: p + "!")
    assert {r.request_key: r.response for r in again.collect()} == {"a": "ok", "b": "2!"}
    assert providers.query_vectors(spark).count() == 14
