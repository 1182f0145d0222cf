"""Index, coverage, rank and sensitivity: golden rows and edge cases."""

import pytest
from pyspark.sql import functions as F

from indexloom import seeds
from indexloom.operators import index, sensitivity

SCHEMA = "country_id int, criterion_number int, dimension string, criterion_score double, confidence string, legal_subscore double, enforcement_subscore double, information_opacity boolean"
GOLDEN = [
    (1, "legal", 5.0, "high", 5.0, None), (2, "legal", 5.0, "high", 5.0, None), (3, "enforcement", 4.0, "medium", None, 4.0), (4, "mixed", 3.4, "medium", 4.0, 3.0),
    (5, "mixed", 3.4, "medium", 4.0, 3.0), (6, "enforcement", 3.0, "medium", 4.0, 2.0), (7, "mixed", 3.4, "medium", 4.0, 3.0), (8, "enforcement", 4.0, "medium", 5.0, 3.0),
    (9, "mixed", 2.8, "low", 4.0, 2.0), (10, "legal", 3.0, "low", 3.0, None), (11, "enforcement", 3.0, "medium", 4.0, 2.0), (12, "enforcement", 3.0, "medium", 3.0, 2.0),
    (13, "legal", 4.0, "medium", 4.0, None), (14, "enforcement", 4.4, "medium", 5.0, 4.0),
]


def rows(spark, *groups):
    return spark.createDataFrame([(g, n, d, s, c, lv, e, False) for g, group in groups for n, d, s, c, lv, e in group], SCHEMA)


def test_golden(spark):
    got = index.index_scores(rows(spark, (1, GOLDEN)), ["country_id"]).first()
    assert (got.legal_score, got.enforcement_score, got.final_score) == (4.2857, 3.2955, 3.6916)
    assert (got.category, got.criteria_count, got.missing_criteria, got.partial_coverage) == ("Significant protections and safeguards", 14, [], False)


def test_one_pool_zero_subscore_and_unknown_confidence(spark):
    got = {r.country_id: r for r in index.index_scores(rows(spark, (1, [(1, "legal", 5.0, "odd", None, None)]), (2, [(4, "mixed", 3.0, "high", 0.0, None)])), ["country_id"]).collect()}
    assert (got[1].final_score, got[1].enforcement_score, got[1].partial_coverage, got[1].missing_criteria) == (5.0, None, True, list(range(2, 15)))
    assert (got[2].legal_score, got[2].enforcement_score) == (3.0, 3.0)  # zero falls back to the criterion's score


def test_weights(spark):
    three = rows(spark, (1, [(1, "legal", 5.0, "high", None, None), (2, "legal", 3.0, "medium", None, None), (10, "legal", 1.0, "low", None, None)]))
    assert index.index_scores(three, ["country_id"]).first().legal_score == round(7.5 / 2.1, 4)
    assert index.index_scores(three, ["country_id"], weighted=False).first().legal_score == 3.0


def test_penalised_fills_up_and_hides_partial_coverage(spark):
    got = index.index_scores(rows(spark, (1, [(1, "legal", 5.0, "high", None, None)])), ["country_id"], strategy="penalise_as_1").first()
    assert (got.criteria_count, got.partial_coverage, got.missing_criteria) == (14, False, [])
    assert got.final_score < 5.0
    with pytest.raises(ValueError):
        index.with_missing(rows(spark, (1, GOLDEN)), ["country_id"], "other")


@pytest.mark.parametrize(("n", "partial"), [(12, False), (11, True)])
def test_coverage_gate(spark, n, partial):
    assert index.index_scores(rows(spark, (1, GOLDEN[:n])), ["country_id"]).first().partial_coverage is partial


def test_rank_is_a_permutation_and_ties_go_to_the_key(spark):
    df = rows(spark, *[(c, [(n, d, s, k, lv, e) for n, d, s, k, lv, e in GOLDEN]) for c in (5, 3, 4)], (9, GOLDEN[:3]))
    got = {r.country_id: r.rank for r in index.ranked(index.index_scores(df, ["country_id"]), "country_id").collect()}
    assert got == {3: 1, 4: 2, 5: 3, 9: None}


def test_empty_and_null_rows(spark):
    empty = spark.createDataFrame([(1, None, "legal", 5.0, "high", None, None, False), (1, 2, "legal", None, None, None, None, None)], SCHEMA)
    assert index.index_scores(empty, ["country_id"]).count() == 0
    assert index.ranked(index.index_scores(empty, ["country_id"]), "country_id").count() == 0


@pytest.mark.parametrize(("score", "at"), [(5.0, 0), (4.1, 0), (4.09, 1), (3.6916, 1), (3.1, 2), (2.6, 3), (2.1, 4), (1.6, 5), (1.1, 6), (1.0, 6)])
def test_bands(spark, score, at):
    from indexloom.functions.scalars import banded

    assert spark.range(1).select(banded(F.lit(score), seeds.INDEX_BANDS)).first()[0] == (seeds.INDEX_BANDS[at][1])


def test_sweep_swaps_and_ties(spark):
    legal, enf = [(1, "legal", 5.0, "high", None, None), (3, "enforcement", 1.0, "high", None, None)], [(1, "legal", 1.0, "high", None, None), (3, "enforcement", 5.0, "high", None, None)]
    swept = sensitivity.sweep(rows(spark, (1, legal), (2, enf)), "country_id")
    got = {r.w_legal: r for r in sensitivity.compared(swept, "country_id").collect()}
    assert got[1.0].spearman == -1.0 and got[1.0].moved == 2 and got[0.4].spearman == 1.0
    assert got[0.5].spearman is None  # a tie makes the ranks constant
    assert {r.avg_rank for r in swept.where("w_legal = 0.5").collect()} == {1.5}
    assert sensitivity.matrix(swept, "country_id", "final_score").columns == ["country_id", "w_100", "w_060", "w_050", "w_040", "w_030", "w_000"]
