"""The scoring plan end to end, with a provider of recorded rules."""

import json

from pyspark.sql import functions as F

from indexloom import seeds
from indexloom.plans import scoring
from indexloom.sources import providers


def test_scores_to_ranked_index(spark):
    docs = spark.createDataFrame([(1, 7, "constitution", "C", [1]), (2, 7, "treaty", "T", [13]), (3, 8, "constitution", "D", [1])], "document_id int, country_id int, document_type string, official_name string, criteria_ids array<int>")
    vectors = spark.createDataFrame([(1, 10, [1.0, 0.0], "right to privacy", False), (2, 11, [0.0, 1.0], "treaty text", False), (3, 12, [1.0, 0.1], "privacy too", False), (3, 13, [1.0, 0.0], "nothing", True), (3, 14, None, "none", False)], "document_id int, id int, embedding array<double>, section_text_original string, all_null boolean")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (13, [0.0, 1.0])], "criterion_number int, query_embedding array<double>")
    records = spark.createDataFrame([(1, 8, 1, "Office", "fined", 0.9, None)], "id int, country_id int, pi_criterion_number int, enforcing_body string, summary string, reliability_score double, sanction_date date")
    indicators = spark.createDataFrame([(1, 7, 1, 2024, 3.5)], "id int, country_id int, pi_criterion_number int, source_year int, indicator_value double")
    texts = scoring.evidence_texts(vectors, docs, queries, records, indicators)
    got = {(r.country_id, r.criterion_number): r.evidence for r in texts.collect()}
    assert set(got) == {(7, 1), (7, 13), (8, 1)}
    assert got[(7, 1)] == "[1] constitution — C (similarity: 1.0)\nright to privacy\n\n---\n\n[2] indicator\n2024 3.5"
    assert "fined" in got[(8, 1)] and "nothing" not in got[(8, 1)]

    asked = scoring.requests(texts, 2026, "rules")
    answers = providers.called(asked, lambda p: json.dumps({"criterion_score": 5 if "right" in p else 9 if "treaty" in p else 2.5, "confidence": "high"}))
    good, bad = scoring.parsed_scores(asked.select("country_id", "criterion_number", "request_key").join(answers, "request_key"))
    assert bad.count() == 1 and {(r.country_id, r.criterion_score) for r in good.collect()} == {(7, 5.0), (8, 2.5)}

    columns = ["country_id", "criterion_number", "criterion_score", "legal_subscore", "enforcement_subscore", "confidence", "information_opacity", "q"]
    new = good.withColumn("q", F.lit(1)).select(*columns)
    out = {r.country_id: (r.final_score, r.rank) for r in scoring.index_after(new.limit(0), new, seeds.criteria(spark), "q", least=1).collect()}
    assert out == {7: (5.0, 1), 8: (2.5, 2)}


def test_parsing_defaults(spark):
    rows = [(4, '{"criterion_score": 3}'), (1, '{"criterion_score": "x"}'), (1, "{}"), (1, None), (2, '{"criterion_score": 0.9}'), (2, '{"criterion_score": 5.1}'), (3, '{"criterion_score": 4.0, "confidence": "medium", "information_opacity": true}')]
    good, bad = scoring.parsed_scores(spark.createDataFrame(rows, "criterion_number int, response string"))
    got = {r.criterion_number: r for r in good.collect()}
    assert set(got) == {3, 4} and bad.count() == 5
    assert (got[4].legal_subscore, got[4].enforcement_subscore, got[4].confidence) == (3.0, 3.0, "low")
    assert got[3].legal_subscore is None and got[3].confidence == "medium" and got[3].information_opacity is False
