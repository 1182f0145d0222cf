"""The engine's tables: schemas, keys, which columns an upsert changes; created where absent, back-filled where older."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession

from indexloom import seeds
from indexloom.operators.upsert import missing_only, read_version, upsert, with_columns, write_version


@dataclass(frozen=True)
class Table:
    """``kept``: columns that an upsert of a known key leaves alone; ``nulls_distinct``: keys with a null never meet."""

    schema: str
    keys: list[str]
    kept: list[str] = field(default_factory=list)
    nulls_distinct: bool = False
    added: dict[str, tuple[str, object]] = field(default_factory=dict)


#: Columns and unique keys of the tables.  Null source years and models make keys that never meet.
TABLES = {
    "criteria": Table("criterion_number int, criterion_name string, dimension string, trusted_domains array<string>", ["criterion_number"]),
    "countries": Table("id bigint, iso_code string, name string, region string, languages array<string>, aliases array<string>", ["iso_code"], kept=["id", "aliases"]),
    "documents": Table(
        "id bigint, country_id bigint, document_type string, official_name string, source_url string, content_type string, char_count int, detected_language string, criteria_ids array<int>, information_opacity boolean",
        ["country_id", "official_name"], kept=["id", "document_type"], added={"information_opacity": ("boolean", False)},
    ),
    "section_extractions": Table(
        "document_id bigint, section_index int, section_header string, section_text_original string, split_tier_used string, extraction_dimension string, extracted_fields string, all_null boolean, error_message string, embedding array<float>, embedding_model string",
        ["document_id", "section_index"], kept=["embedding", "embedding_model"], added={"extraction_dimension": ("string", None)},
    ),
    "document_extractions": Table(
        "document_id bigint, extraction_dimension string, extracted_fields string, enforcement_body string, constitutional_privacy_right boolean, dpa_exists boolean, dpa_independence string, information_opacity_flag boolean, status string",
        ["document_id"],
    ),
    "enforcement_records": Table("id bigint, country_id bigint, pi_criterion_number int, source_type string, source_url string, enforcing_body string, sanction_amount decimal(20,2), sanction_date date, summary string, reliability_score double", ["id"], added={"reliability_score": ("double", 0.8)}),
    "trusted_sources": Table("domain string, country_code string, pi_criterion_number int, source_type string, requires_search boolean, reliability_score double", ["domain", "country_code", "pi_criterion_number"]),
    "criterion_scores": Table(
        "country_id bigint, criterion_number int, reference_year int, model_used string, criterion_score double, legal_subscore double, enforcement_subscore double, confidence string, rationale string, evidence_count int, retrieval_limited boolean",
        ["country_id", "criterion_number", "reference_year", "model_used"], kept=["retrieval_limited"], nulls_distinct=True,
    ),
    "country_index_scores": Table(
        "country_id bigint, reference_year int, model_used string, legal_score double, enforcement_score double, final_score double, pi_category string, rank int, criteria_count int, missing_criteria array<int>, partial_coverage boolean",
        ["country_id", "reference_year", "model_used"], kept=["rank"], nulls_distinct=True,
    ),
    "external_indicators": Table(
        "country_id bigint, pi_criterion_number int, source_name string, indicator_name string, source_year int, indicator_value double, indicator_normalised double",
        ["country_id", "pi_criterion_number", "source_name", "indicator_name", "source_year"], nulls_distinct=True,
    ),
}
#: Sources trusted for a criterion (null: any): domain, kind, criterion, whether it must be searched, reliability.
TRUSTED = [
    ("constituteproject.org", "institutional", 1, False, 1.0), ("hudoc.echr.coe.int", "institutional", 1, False, 1.0), ("gdprhub.eu", "institutional", 3, True, 0.9),
    ("edpb.europa.eu", "institutional", 3, False, 1.0), ("freedomhouse.org", "ngo", 14, False, 0.9), ("v-dem.net", "institutional", 14, False, 0.95), ("rsf.org", "ngo", 14, False, 0.85),
    ("treaty.un.org", "institutional", 13, False, 1.0), ("privacyinternational.org", "ngo", None, True, 0.85), ("eff.org", "ngo", None, True, 0.8), ("accessnow.org", "ngo", None, True, 0.8),
]


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table's last version, with columns that an older version lacks; empty where none was written."""
    t = TABLES[name]
    empty = spark.createDataFrame([], t.schema)
    try:
        df = with_columns(read_version(spark, f"{folder}/{name}"), t.added)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty
    return empty.unionByName(df, allowMissingColumns=True)


def write(df: DataFrame, folder: str, name: str, seq: list[Column | str], replace_by: list[str] | None = None) -> DataFrame:
    """Upserts ``df`` and gives the table after it.  Columns that ``df`` has and the table's spec does not keep are changed.

    ``replace_by``: rows of the table with the same values in these columns go first, so that a new run with fewer rows
    leaves none of the old behind."""
    t, now = TABLES[name], read(df.sparkSession, folder, name)
    if replace_by:
        now = now.join(df.select(*replace_by).distinct(), replace_by, "left_anti").select(*now.columns)
    update = [c for c in now.columns if c in df.columns and c not in t.keys and c not in t.kept]
    write_version(upsert(now, df, t.keys, update, seq, t.nulls_distinct), f"{folder}/{name}")
    return read(df.sparkSession, folder, name)


def bootstrap(spark: SparkSession, folder: str) -> None:
    """Every table, and the seed rows that are not there yet; a second call changes nothing."""
    trusted = spark.createDataFrame([(d, c, n, k, s, r) for d, k, n, s, r in TRUSTED for c in (None,)], TABLES["trusted_sources"].schema)
    for name, rows in {**dict.fromkeys(TABLES, None), "criteria": seeds.criteria(spark), "trusted_sources": trusted}.items():
        now = read(spark, folder, name)
        new = None if rows is None else _absent(rows, now, TABLES[name].keys)
        if new is not None and new.count():
            write_version(now.unionByName(new), f"{folder}/{name}")
        elif rows is None and not _exists(spark, f"{folder}/{name}"):
            write_version(now, f"{folder}/{name}")


def _absent(rows: DataFrame, now: DataFrame, keys: list[str]) -> DataFrame:
    """Seed rows by null-safe keys: a null in a seed's key means 'any', so it meets itself."""
    if len(keys) == 1:
        return missing_only(rows, now, keys)
    on = rows[keys[0]].eqNullSafe(now[keys[0]])
    for k in keys[1:]:
        on = on & rows[k].eqNullSafe(now[k])
    return rows.join(now, on, "left_anti")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        read_version(spark, path)
    except AnalysisException:
        return False
    return True
