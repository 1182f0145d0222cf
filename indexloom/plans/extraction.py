"""The extraction plan: documents to sections, gates, a provider's answers, one record a document, vectors that are due."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from indexloom.functions import text
from indexloom.functions.scalars import cache_key, has_no_signal, json_object
from indexloom.operators import merge


def gated_sections(documents: DataFrame, id_col: str, text_col: str, lang_col: str, least: int = 100, signal: bool = True) -> DataFrame:
    """Sections with their outcome; too short ones vanish, blocked ones stay with an error message and no fields."""
    cut = text.sections(documents.where(F.col(text_col).isNotNull()), text_col, lang_col, keep=[id_col])
    out = cut.withColumn("outcome", text.gate(F.col("text"), least, signal)).where("outcome <> 'short'")
    return out.withColumn("error_message", F.when(F.col("outcome") != "pass", "pre-filter:no-signal"))


def requests(sections: DataFrame, id_col: str, prompt: Column) -> DataFrame:
    """Requests for the sections that pass, keyed by document, section and text, so a changed text is asked anew."""
    key = cache_key(F.col(id_col).cast("string"), F.col("section_index").cast("string"), F.md5("text"))
    return sections.where("outcome = 'pass'").select(id_col, "section_index", key.alias("request_key"), prompt.alias("payload"))


def extracted(sections: DataFrame, asked: DataFrame, answers: DataFrame, id_col: str) -> DataFrame:
    """Every gated section with extracted_fields (JSON), all_null and error_message, in one table."""
    got = asked.select(id_col, "section_index", "request_key").join(answers.select("request_key", "response", F.col("error").alias("__error")), "request_key", "left")
    out = sections.join(got.drop("request_key"), [id_col, "section_index"], "left")
    fields = F.to_json(json_object(F.col("response")))
    broken = F.when(F.col("response").isNotNull() & fields.isNull(), "invalid json")
    return out.select(*sections.columns[:-1], fields.alias("extracted_fields"), has_no_signal(fields).alias("all_null"), F.coalesce("error_message", "__error", broken).alias("error_message"))


def records(sections: DataFrame, id_col: str, lists: list[str], scalars: dict[str, str], notes: str = "notes") -> DataFrame:
    """One record a document: lists without repeats, first scalars, notes; n_sections, n_signal and n_errors."""
    schema = ", ".join([*(f"{c} array<string>" for c in lists), *(f"{c} {t}" for c, t in scalars.items()), f"{notes} string"])
    rows = sections.withColumn("f", F.from_json("extracted_fields", schema)).select(id_col, "section_index", "all_null", "error_message", "f.*")
    merged = merge.merged(rows, [id_col], "section_index", lists=lists, scalars=list(scalars), notes=notes)
    counts = sections.groupBy(id_col).agg(F.count("*").alias("n_sections"), F.count_if(~F.col("all_null")).alias("n_signal"), F.count_if(F.col("error_message") != "").alias("n_errors"))
    return merged.join(counts, id_col)


def due_vectors(sections: DataFrame, id_col: str, chars: int = 1200) -> DataFrame:
    """Requests to an embedding provider: sections with a signal whose vector is missing or of another text."""
    stale = F.col("embedding").isNull() | ~F.col("embedded_hash").eqNullSafe(F.md5("section_text_original"))
    rows = sections.where(~F.col("all_null") & stale)
    return rows.select(id_col, "section_index", cache_key(F.col(id_col).cast("string"), F.col("section_index").cast("string"), F.md5("section_text_original")).alias("request_key"), F.substring("section_text_original", 1, chars).alias("payload"))


def merged_schema(*schemas: StructType) -> StructType:
    """Union of schemas: fields by first sight, and ``notes`` always."""
    fields = {f.name: f for s in schemas for f in reversed(s.fields)}
    order = dict.fromkeys([f.name for s in schemas for f in s.fields])
    from pyspark.sql.types import StringType

    order["notes"] = None
    return StructType([fields.get(n, StructField(n, StringType())) for n in order])


def status(documents: DataFrame, sections: DataFrame, id_col: str) -> DataFrame:
    """sections, with_signal and status of every document: 'success' where a section has a signal, 'partial' where there
    are sections only, 'failed' without any.  Counted before the join, so a hot document is one row."""
    counts = sections.groupBy(id_col).agg(F.count("*").alias("n"), F.count_if(~F.coalesce(F.col("all_null"), F.lit(True))).alias("m"))
    n, m = (F.coalesce(F.col(c), F.lit(0)) for c in ("n", "m"))
    named = F.when(m > 0, "success").when(n > 0, "partial").otherwise("failed")
    return documents.join(counts, id_col, "left").select(*documents.columns, n.alias("sections"), m.alias("with_signal"), named.alias("status"))


def demonstration(sections: DataFrame, most: int = 20, score: float = 8.0) -> DataFrame:
    """The first ``most`` sections of each document, all with one score (the demonstration's cap is its feature)."""
    return sections.where(F.col("section_index") < most).withColumn("score", F.lit(score))
