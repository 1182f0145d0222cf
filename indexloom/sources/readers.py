"""Scans: tables, snapshots, delimited indicators, JSON embedded in pages, raw files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from indexloom.functions.scalars import decimal_of, host_of, linear_score, or_default, year_of


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def snapshot(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """The last JSON snapshot written by ``sinks.snapshot``; the schema is stated, never inferred."""
    return spark.read.schema(schema).json(f"{folder}/latest")


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, modificationTime, length and content of files: downloads that are already there."""
    return spark.read.option("pathGlobFilter", pattern).format("binaryFile").load(path)


def scored_csv(spark: SparkSession, path: str, year: int, name_col: str = "Country_EN", code_col: str = "ISO") -> DataFrame:
    """Index files with ';' and decimal commas: code, name, raw and normalised score of ``year``; bad numbers are dropped.

    The score column is named after the year or plainly; a byte order mark before the header is passed over."""
    df = spark.read.option("sep", ";").option("header", True).csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    score = f"Score {year}" if f"Score {year}" in df.columns else "Score"
    raw = decimal_of(df[score])
    return df.select(F.upper(F.trim(df[code_col])).alias("code"), df[name_col].alias("name"), F.lit(year).alias("source_year"), raw.alias("indicator_value"), linear_score(raw).alias("indicator_normalised")).where(raw.isNotNull())


def embedded_json(pages: DataFrame, html_col: str, script_id: str, schema: str, keep: list[str] = ()) -> DataFrame:
    """The objects of a JSON array in ``<script id=...>`` of each page, one row each; pages without it give none."""
    text = F.regexp_extract(html_col, rf"(?s)<script[^>]*\bid=[\"']{script_id}[\"'][^>]*>\s*(.*?)\s*</script>", 1)
    return pages.select(*keep, F.explode(F.from_json(F.nullif(text, F.lit("")), f"array<struct<{schema}>>")).alias("x")).select(*keep, "x.*")


def case_indicators(cases: DataFrame, entities: DataFrame) -> DataFrame:
    """Cases (c, d, f: country, date, fine) joined with entities by upper-cased name: year and amount (1 if unknown)."""
    e = entities.select(F.col("id").alias("country_id"), F.upper("name").alias("c_name"))
    return cases.join(e, F.upper("c") == F.col("c_name")).select("country_id", year_of(F.col("d")).alias("source_year"), or_default(decimal_of(F.col("f").cast("string")), 1.0).alias("indicator_value"))


def scraped(pages: DataFrame, html_col: str, score_class: str, status_class: str, keep: list[str] = ()) -> DataFrame:
    """Score and status text of elements with the given classes."""

    def inner(cls: str) -> Column:
        return F.nullif(F.trim(F.regexp_extract(html_col, rf"(?s)<[^>]*\bclass=[\"'][^\"']*\b{cls}\b[^\"']*[\"'][^>]*>\s*([^<]*)", 1)), F.lit(""))

    return pages.select(*keep, decimal_of(inner(score_class)).alias("indicator_value"), inner(status_class).alias("status"))


def search_results(responses: DataFrame, keep: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(results, failed) of recorded search answers: url, title, snippet, position (from 1) and domain; soft errors fail.

    A result without an address is dropped; an answer that is no JSON or carries an error is in ``failed``."""
    item = "link: string, title: string, snippet: string"
    parsed = responses.withColumn("r", F.from_json("response", f"struct<error: string, organic_results: array<struct<{item}>>>"))
    bad = F.col("response").isNull() | F.col("r.error").isNotNull() | F.try_parse_json("response").isNull()
    rows = parsed.where(~bad).select(*keep, F.posexplode("r.organic_results").alias("at", "x")).where("x.link <> ''")
    found = rows.select(*keep, F.col("x.link").alias("url"), F.col("x.title").alias("title"), F.col("x.snippet").alias("snippet"), (F.col("at") + 1).alias("position"), host_of(F.col("x.link")).alias("domain"))
    return found, parsed.where(bad).select(*keep, F.coalesce("r.error", F.lit("no answer")).alias("error"))


def collected(sources: dict[str, Callable[[], DataFrame]]) -> tuple[DataFrame | None, dict[str, str | None]]:
    """(union of the sources that can be read, error of each source or None): a failing one does not stop the others."""
    out, errors = None, {}
    for name, read in sources.items():
        try:
            part = read().withColumn("source_name", F.lit(name))
            part.schema  # noqa: B018 - analysis fails here, not in the middle of the union
        except Exception as e:  # noqa: BLE001
            errors[name] = f"{type(e).__name__}: {e}"[:200]
            continue
        errors[name] = None
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out, errors


def entity_rows(answers: DataFrame) -> DataFrame:
    """Seed rows of entities from a provider's JSON: code in capitals and two letters, lists never null."""
    r = F.from_json("response", "struct<name: string, iso_code: string, region: string, languages: array<string>, aliases: array<string>>")
    none = F.array().cast("array<string>")
    rows = answers.where("error IS NULL").select(r.alias("r")).where("r.name <> ''")
    return rows.select(F.col("r.name").alias("name"), F.substring(F.upper("r.iso_code"), 1, 2).alias("iso_code"), F.coalesce("r.region", F.lit("")).alias("region"), F.coalesce("r.languages", none).alias("languages"), F.coalesce("r.aliases", none).alias("aliases"))
