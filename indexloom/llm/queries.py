"""The queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexloom.llm import boilerplate, encoding, language, leaks, neardup, pieces, residue, subjects, tokens
from indexloom.llm.common import stored, table


def _repaired(spark: SparkSession, sf_dir: str, once: bool, carry: list[str] = ()) -> DataFrame:
    contents, samples = table(spark, sf_dir, "document_contents"), table(spark, sf_dir, "lang_samples")
    model = encoding.fitted(samples, contents, "lang", "text", "extracted_text")
    return encoding.repaired(contents, model, "content_id", "extracted_text", carry, once)


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of document_contents: its text, restored where it was decoded wrongly."""
    return _repaired(spark, sf_dir, True).withColumnRenamed("id", "content_id")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired(spark, sf_dir, False).where("garbled").select(F.col("id").alias("content_id")).distinct()


def _clean(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, boilerplate.Weights]:
    """id, text with the right encoding, content_type and url of document_contents, and the weights of furniture."""
    weights = boilerplate.fitted(table(spark, sf_dir, "document_contents"), "extracted_text", "content_type", corpus=table(spark, sf_dir, "documents"))
    clean = _repaired(spark, sf_dir, False, ["content_type", "url"])
    return clean.select("id", "text", F.col("carried_content_type").alias("content_type"), F.col("carried_url").alias("url")), weights


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Furniture is told by its words, so garbled lines are restored first; that changes no line's number."""
    clean, weights = _clean(spark, sf_dir)
    lines = boilerplate.furniture_lines(clean.where("content_type = 'html'"), weights, "id", "text", message=residue.message)
    return lines.select(F.col("id").alias("content_id"), "line_no")


def p2_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """content_id and main body of every row of document_contents."""
    clean, weights = _clean(spark, sf_dir)
    return boilerplate.main_text(clean, weights, "id", "text", "content_type", message=residue.message).select(F.col("id").alias("content_id"), "text").distinct()


def _residue(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tuple]:
    """The main bodies (id, text, carried_url) of all rows, and the model of residue."""
    clean, weights = _clean(spark, sf_dir)
    bodies = stored(boilerplate.main_text(clean, weights, "id", "text", "content_type", carry=["url"], message=residue.message, around=True))
    return bodies, residue.fitted(bodies, "text", "carried_url", "around")


def p6_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """content_id, residue, probability and the deciding sentence of the main body of every row with a text."""
    bodies, model = _residue(spark, sf_dir)
    return residue.judged(bodies, model, "id", "text").withColumnRenamed("id", "content_id")


def p6_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold, precision and recall against the weak labels on hosts the classifier was not trained on."""
    return spark.createDataFrame(sorted(_residue(spark, sf_dir)[1][2].items()), "measure string, value double")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_judged(spark, sf_dir).where("residue").select("content_id").distinct()


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables of sections; each is cut on its own, then united."""
    extractions = table(spark, sf_dir, "section_extractions").select(F.lit("section_extractions").alias("source_table"), "document_id", "section_index", F.col("section_text_original").alias("text"))
    sections = table(spark, sf_dir, "document_sections").select(F.lit("document_sections").alias("source_table"), "document_id", "section_index", "text")
    return pieces.split_pieces(extractions.unionByName(sections), "text", ["source_table", "document_id", "section_index"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_pieces(spark, sf_dir).where("piece_no = 1").select("source_table", "document_id", "section_index").distinct()


def p4_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang and confidence of every document with a letter."""
    model = language.fitted(table(spark, sf_dir, "lang_samples"))
    return language.document_languages(table(spark, sf_dir, "documents"), model, "doc_id", "text").withColumnRenamed("id", "doc_id")


def p4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, line_no, lang and confidence of the lines of sections in several languages."""
    model = language.fitted(table(spark, sf_dir, "lang_samples"))
    return language.line_languages(table(spark, sf_dir, "section_extractions"), model, "id", "section_text_original")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a missing or wrong label (line -1), and the lines of mixed sections."""
    model = language.fitted(table(spark, sf_dir, "lang_samples"))
    docs = table(spark, sf_dir, "documents")
    right = language.document_languages(docs, model, "doc_id", "text", carry="detected_language")
    wrong = right.where(~language.named_language(F.col("carried")).eqNullSafe(F.col("lang")))
    a = wrong.select(F.lit("documents").alias("source_table"), F.col("id").alias("record_id"), F.lit(-1).alias("line_no"), "lang")
    lines = language.line_languages(table(spark, sf_dir, "section_extractions"), model, "id", "section_text_original")
    return a.unionByName(lines.select(F.lit("section_extractions").alias("source_table"), F.col("id").alias("record_id"), "line_no", "lang")).distinct()


def _near(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return neardup.near_duplicates(table(spark, sf_dir, "section_extractions"), "id", "section_text_original", words=3, threshold=0.7)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.pairs_of_ids(*_near(spark, sf_dir))


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(*_near(spark, sf_dir))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_ids(table(spark, sf_dir, "documents"))


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those of p8_leaks that hold an exact passage."""
    return p8_leaks(spark, sf_dir).where("kind = 'exact'").select("doc_id", "item_id")


def p9_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, subject_code and n_sentences of every document's subjects."""
    docs = table(spark, sf_dir, "documents")
    model, rows = subjects.learned(docs, table(spark, sf_dir, "subject_labels"), table(spark, sf_dir, "lang_samples"))
    found = subjects.subjects(docs, model) if rows is None else subjects.of_learned(model, rows)
    return found.withColumnRenamed("id", "doc_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects that subject_areas lists."""
    areas = table(spark, sf_dir, "subject_areas").select(F.lower(F.trim("subject_code")).alias("subject_code")).distinct()
    return p9_subjects(spark, sf_dir).join(areas, "subject_code", "left_semi").select("doc_id", "subject_code").distinct()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_restored, p2_found, p2_main, p3_found, p3_pieces, p4_found, p4_documents, p4_lines, p5_found, p5_groups, p6_found, p6_judged, p6_measures, p7_ids, p8_found, p8_leaks, p9_found, p9_subjects)
}

SQL: dict[str, str] = {
    "p3_found": """
        SELECT DISTINCT 'section_extractions' AS source_table, document_id, section_index
        FROM section_extractions WHERE length(section_text_original) > 2000
        UNION
        SELECT DISTINCT 'document_sections' AS source_table, document_id, section_index
        FROM document_sections WHERE length(text) > 2000""",
}
