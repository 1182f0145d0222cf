"""The scoring plan: evidence of every entity and criterion, a provider's answers, parsed scores, the ranked index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexloom.functions.scalars import cache_key, json_object
from indexloom.operators import evidence, index, upsert

KEYS = ["country_id", "criterion_number"]


def evidence_texts(vectors: DataFrame, documents: DataFrame, queries: DataFrame, records: DataFrame, indicators: DataFrame, least: float = 0.35, k: int = 20) -> DataFrame:
    """One text of evidence an entity and criterion: similar sections of its documents, records, indicators.

    ``vectors``: document_id, id, embedding, section_text_original; ``queries``: criterion_number, query_embedding.  The
    k best sections of a criterion are sought among the documents mapped to it, as one set-based plan for all."""
    mapped = documents.select("document_id", "country_id", "document_type", "official_name", F.explode("criteria_ids").alias("for_criterion"))
    embedded = vectors.where("embedding IS NOT NULL AND NOT all_null").select("document_id", "id", "embedding", "section_text_original")
    near = evidence.similar_in_blocks(embedded, queries, "id", "embedding", "criterion_number", "query_embedding", within=["document_id"], least=least, k=None).drop("place")
    kept = near.join(mapped, (near.document_id == mapped.document_id) & (near.criterion_number == mapped.for_criterion)).drop(mapped.document_id)
    top = evidence.first_k(kept, KEYS, [F.desc("similarity"), "id"], k)
    texts = top.join(embedded.select("id", F.col("section_text_original").alias("body")), "id")
    head = F.concat_ws(" ", F.concat_ws(" — ", "document_type", "official_name"), F.format_string("(similarity: %s)", F.round("similarity", 3)))
    sections = texts.select(*KEYS, "place", head.alias("head"), "body")
    r = evidence.top_records(records.withColumnRenamed("pi_criterion_number", "criterion_number"), KEYS)
    r = r.select(*KEYS, "place", F.concat(F.lit("record — "), F.coalesce("enforcing_body", F.lit("unknown"))).alias("head"), F.col("summary").alias("body"))
    i = evidence.latest_indicators(indicators.withColumnRenamed("pi_criterion_number", "criterion_number"), KEYS)
    i = i.select(*KEYS, "place", F.lit("indicator").alias("head"), F.concat_ws(" ", F.col("source_year"), F.col("indicator_value")).alias("body"))
    return evidence.formatted(evidence.united(("section", sections), ("record", r), ("indicator", i)), KEYS, "head", "body")


def requests(texts: DataFrame, year: int, model: str) -> DataFrame:
    """Requests to a scoring provider, keyed by entity, criterion, year and model."""
    key = cache_key(F.col("country_id").cast("string"), F.col("criterion_number").cast("string"), F.lit(str(year)), F.lit(model))
    return texts.select(*KEYS, key.alias("request_key"), F.col("evidence").alias("payload"))


def parsed_scores(answers: DataFrame, response: str = "response") -> tuple[DataFrame, DataFrame]:
    """(score rows, rejected answers): a numeric criterion_score from 1 to 5 is required, the rest has defaults.

    A criterion with sub-scores takes the score where one is missing; opacity is false."""
    v = json_object(F.col(response))

    def number(name: str) -> Column:
        return F.try_variant_get(v, f"$.{name}", "double")

    score, mixed = number("criterion_score"), F.col("criterion_number").isin(4, 5, 7, 9, 14)
    out = answers.select(
        "*", score.alias("criterion_score"), F.when(mixed, F.coalesce(number("legal_subscore"), score)).otherwise(number("legal_subscore")).alias("legal_subscore"),
        F.when(mixed, F.coalesce(number("enforcement_subscore"), score)).otherwise(number("enforcement_subscore")).alias("enforcement_subscore"),
        F.coalesce(F.try_variant_get(v, "$.confidence", "string"), F.lit("low")).alias("confidence"), F.coalesce(F.try_variant_get(v, "$.rationale", "string"), F.lit("")).alias("rationale"),
        F.lit(False).alias("information_opacity"),
    )
    good = F.coalesce(F.col("criterion_score").between(1.0, 5.0) & F.coalesce(F.col("legal_subscore").between(1.0, 5.0), F.lit(True)) & F.coalesce(F.col("enforcement_subscore").between(1.0, 5.0), F.lit(True)), F.lit(False))
    return out.where(good), out.where(~good)


def index_after(stored: DataFrame, new: DataFrame, criteria: DataFrame, seq: str, **how: object) -> DataFrame:
    """The ranked index after ``new`` score rows were upserted into ``stored`` (keys: entity, criterion)."""
    update = [c for c in stored.columns if c not in KEYS]
    scores = upsert.upsert(stored, new, KEYS, update, [F.col(seq).desc_nulls_last()])
    with_dimension = scores.join(F.broadcast(criteria.select("criterion_number", "dimension")), "criterion_number")  # 14 rows
    return index.ranked(index.index_scores(with_dimension, ["country_id"], **how), "country_id")
