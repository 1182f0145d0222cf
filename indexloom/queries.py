"""Queries over the test tables, one or more an operator, and the SQL that checks them.

Result columns are scalars (lists are joined), floats are rounded, and the order of nulls is stated on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indexloom import seeds
from indexloom.functions import scalars, text
from indexloom.operators import discovery, evidence, index, merge, resolve, retrieval, sensitivity, upsert
from indexloom.plans import extraction, scoring
from indexloom.sources import providers, readers
from indexloom.sources.readers import table
from indexloom.streaming import incremental

#: Criterion scores of nations, derived from all orders; a rule on nation and criterion leaves some missing (the same text
#: runs in both engines).
SCORES = """
SELECT country_id, criterion_number,
       CASE WHEN criterion_number IN (1, 2, 10, 13) THEN 'legal' WHEN criterion_number IN (4, 5, 7, 9) THEN 'mixed' ELSE 'enforcement' END AS dimension,
       CAST(10 + k % 41 AS DOUBLE) / 10 AS criterion_score,
       CASE WHEN criterion_number IN (4, 5, 7, 9, 14) AND k % 5 <> 0 THEN CAST(10 + (k * 3) % 41 AS DOUBLE) / 10 END AS legal_subscore,
       CASE WHEN criterion_number IN (4, 5, 7, 9, 14) AND k % 6 <> 0 THEN CAST(10 + (k * 7) % 41 AS DOUBLE) / 10 END AS enforcement_subscore,
       CASE k % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' ELSE 'unknown' END AS confidence,
       k % 10 = 0 AS information_opacity, 2026 AS reference_year
FROM (SELECT c.c_nationkey AS country_id, CAST(o.o_orderkey % 14 AS INT) + 1 AS criterion_number, MIN(o.o_orderkey) AS k
      FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
      WHERE o.o_orderstatus = 'P'
      GROUP BY c.c_nationkey, CAST(o.o_orderkey % 14 AS INT) + 1) base
WHERE (country_id * 7 + criterion_number * 3) % (5 + country_id % 7) > 0"""
_SCORES = SCORES.format(orders="orders", customer="customer")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query and its SQL under the function's name."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def scores(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(SCORES, orders=table(spark, sf, "orders"), customer=table(spark, sf, "customer"))


def _index_sql(filled: bool = False, weighted: bool = True) -> str:
    dims = ", ".join(f"({n}, '{d}')" for n, _, d, _ in seeds.CRITERIA)
    fill = f"""UNION ALL SELECT g.country_id, d.n, d.dim, 1.0, CASE WHEN d.dim IN ('legal', 'mixed') THEN 1.0 END, CASE WHEN d.dim IN ('enforcement', 'mixed') THEN 1.0 END, 'low', false
      FROM (SELECT DISTINCT country_id FROM scores) g CROSS JOIN (VALUES {dims}) d(n, dim)
      WHERE NOT EXISTS (SELECT 1 FROM scores s WHERE s.country_id = g.country_id AND s.criterion_number = d.n)""" if filled else ""
    weight = "CASE confidence WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.7 ELSE 0.4 END::DOUBLE" if weighted else "1.0::DOUBLE"
    bands = " ".join(f"WHEN f >= {b} THEN '{name}'" for b, name in seeds.INDEX_BANDS[:-1])
    return f"""
WITH scores AS ({_SCORES}),
rows AS (SELECT country_id, criterion_number, dimension, criterion_score, legal_subscore, enforcement_subscore, confidence, information_opacity FROM scores {fill}),
pools AS (SELECT *, {weight} AS w,
  CASE WHEN dimension = 'mixed' AND criterion_number IN (4, 5, 7, 9, 14) THEN coalesce(nullif(legal_subscore, 0), criterion_score) WHEN dimension IN ('legal', 'mixed') THEN criterion_score END::DOUBLE AS lv,
  CASE WHEN dimension = 'mixed' AND criterion_number IN (4, 5, 7, 9, 14) THEN coalesce(nullif(enforcement_subscore, 0), criterion_score) WHEN dimension IN ('enforcement', 'mixed') THEN criterion_score END::DOUBLE AS ev
  FROM rows),
means AS (SELECT country_id, sum(lv * w) / sum(w) FILTER (lv IS NOT NULL) AS l, sum(ev * w) / sum(w) FILTER (ev IS NOT NULL) AS e,
  count(DISTINCT criterion_number) AS n, string_agg(DISTINCT criterion_number::VARCHAR, ',') AS have, count(DISTINCT criterion_number) FILTER (information_opacity) AS o FROM pools GROUP BY 1),
finals AS (SELECT *, coalesce(0.4 * l + 0.6 * e, l, e, 1.0) AS f FROM means)
SELECT country_id, round(l + 1e-9, 4) AS legal_score, round(e + 1e-9, 4) AS enforcement_score, round(f + 1e-9, 4) AS final_score,
  CASE {bands} ELSE '{seeds.INDEX_BANDS[-1][1]}' END AS category, CAST(n AS INT) AS criteria_count, CAST(o AS BIGINT) AS opacity_count, n < 12 AS partial_coverage FROM finals"""


def _index(spark: SparkSession, sf: str, **how: object) -> DataFrame:
    return index.index_scores(scores(spark, sf), ["country_id"], **how)


@query(_index_sql())
def country_index(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf).drop("missing_criteria")


@query(_index_sql(filled=True))
def country_index_penalised(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf, strategy="penalise_as_1").drop("missing_criteria")


@query(_index_sql(weighted=False))
def country_index_unweighted(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf, weighted=False).drop("missing_criteria")


@query(f"""
WITH idx AS ({_index_sql()}), r AS (SELECT country_id, row_number() OVER (ORDER BY final_score DESC, country_id) AS rank FROM idx WHERE NOT partial_coverage)
SELECT n.n_name AS country_name, final_score, legal_score, enforcement_score, category AS pi_category, CAST(rank AS INT) AS rank, criteria_count
FROM idx JOIN nation n ON n.n_nationkey = idx.country_id LEFT JOIN r USING (country_id)""")
def index_ranked_export(spark: SparkSession, sf: str) -> DataFrame:
    ranked = index.ranked(_index(spark, sf), "country_id")
    nation = table(spark, sf, "nation")
    out = ranked.join(nation, ranked.country_id == nation.n_nationkey).select(F.col("n_name").alias("country_name"), "final_score", "legal_score", "enforcement_score", F.col("category").alias("pi_category"), "rank", "criteria_count")
    return out.orderBy(F.asc_nulls_last("rank"), "country_name")


@query(f"""
WITH s AS ({_SCORES}), g AS (SELECT DISTINCT country_id FROM s), n AS (SELECT unnest(range(1, 15)) AS n)
SELECT g.country_id, coalesce((SELECT string_agg(n.n::VARCHAR, ',' ORDER BY n.n) FROM n WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.country_id = g.country_id AND s.criterion_number = n.n)), '') AS missing FROM g""")
def missing_criteria(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf).select("country_id", F.array_join("missing_criteria", ",").alias("missing"))


@query(f"""
WITH s AS ({_SCORES}), d AS (SELECT DISTINCT doc_id, country_id, unnest(criteria_ids) AS criterion_number FROM documents),
covered AS (SELECT DISTINCT d.country_id, d.criterion_number FROM d JOIN section_extractions x ON x.document_id = d.doc_id WHERE x.embedding_model IS NOT NULL AND NOT x.all_null)
SELECT s.country_id, s.criterion_number, c.country_id IS NULL AS retrieval_limited FROM s LEFT JOIN covered c ON c.country_id = s.country_id AND c.criterion_number = s.criterion_number""")
def retrieval_limited(spark: SparkSession, sf: str) -> DataFrame:
    sections = table(spark, sf, "section_extractions").select("document_id", "all_null", F.col("embedding_model").isNotNull().alias("has_embedding"))
    out = evidence.lacking_evidence(scores(spark, sf).withColumn("country_id", F.col("country_id").cast("int")), table(spark, sf, "documents"), sections)
    return out.select(F.col("country_id").cast("bigint"), "criterion_number", "retrieval_limited")


_SWEEP = f"""
WITH s AS ({_SCORES}), x AS (SELECT s.*, w.w FROM s CROSS JOIN (VALUES (1.0::DOUBLE), (0.6), (0.5), (0.4), (0.3), (0.0)) w(w)),
p AS (SELECT country_id, w, CASE confidence WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.7 ELSE 0.4 END::DOUBLE AS c,
 CASE WHEN dimension = 'mixed' AND criterion_number IN (4, 5, 7, 9, 14) THEN coalesce(legal_subscore, w * legal_subscore + (1 - w) * enforcement_subscore, criterion_score) WHEN dimension IN ('legal', 'mixed') THEN criterion_score END AS lv,
 CASE WHEN dimension = 'mixed' AND criterion_number IN (4, 5, 7, 9, 14) THEN coalesce(enforcement_subscore, w * legal_subscore + (1 - w) * enforcement_subscore, criterion_score) WHEN dimension IN ('enforcement', 'mixed') THEN criterion_score END AS ev FROM x),
m AS (SELECT country_id, w, sum(lv * c) / sum(c) FILTER (lv IS NOT NULL) AS l, sum(ev * c) / sum(c) FILTER (ev IS NOT NULL) AS e FROM p GROUP BY 1, 2),
f AS (SELECT country_id, w AS w_legal, round(coalesce(l * w + e * (1 - w), l, e, 1.0) + 1e-9, 4) AS final_score FROM m),
long AS (SELECT country_id, w_legal, final_score, CASE {" ".join(f"WHEN final_score >= {b} THEN '{n}'" for b, n in seeds.SWEEP_BANDS[:-1])} ELSE '{seeds.SWEEP_BANDS[-1][1]}' END AS band,
 rank() OVER (PARTITION BY w_legal ORDER BY final_score DESC) + (count(*) OVER (PARTITION BY w_legal, final_score) - 1) / 2.0::DOUBLE AS avg_rank FROM f)"""


@query(f"{_SWEEP} SELECT * FROM long")
def sensitivity_long(spark: SparkSession, sf: str) -> DataFrame:
    return sensitivity.sweep(scores(spark, sf), "country_id")


@query(f"""{_SWEEP}, b AS (SELECT country_id, avg_rank AS br, band AS bb FROM long WHERE w_legal = 0.4)
SELECT w_legal, round(corr(avg_rank, br), 6) AS spearman, count(*) FILTER (abs(avg_rank - br) > 0) AS moved, count(*) FILTER (band <> bb) AS band_changes, max(abs(avg_rank - br)) AS max_shift FROM long JOIN b USING (country_id) GROUP BY 1""")
def sensitivity_summary(spark: SparkSession, sf: str) -> DataFrame:
    return sensitivity.compared(sensitivity.sweep(scores(spark, sf), "country_id"), "country_id")


@query(f"{_SWEEP} SELECT country_id, " + ", ".join(f"max(final_score) FILTER (w_legal = {w}) AS w_{round(w * 100):03d}" for w in seeds.SCENARIOS) + " FROM long GROUP BY 1")
def sensitivity_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return sensitivity.matrix(sensitivity.sweep(scores(spark, sf), "country_id"), "country_id", "final_score")


@query(r"""SELECT doc_id, md5(trim(regexp_replace(replace(text, chr(0), ''), '[\s\x0B\x1C-\x1F\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))) AS clean FROM documents""")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned texts of all documents, as hashes."""
    return table(spark, sf, "documents").select("doc_id", F.md5(text.clean_text(F.col("text"))).alias("clean"))


@query("SELECT doc_id, trim(official_name) || ' ' || document_type AS text FROM documents WHERE official_name IS NOT NULL AND document_type IS NOT NULL")
def html_text(spark: SparkSession, sf: str) -> DataFrame:
    """Visible text of small pages around names; nested, unclosed and dropped elements are in the unit tests."""
    esc = F.replace(F.replace(F.col("official_name"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    page = F.concat(F.lit("<html><head><style>p {}</style><script>var a = '<b>';</script></head><body><nav>Menu <b>x</b></nav><h1>"), esc, F.lit("</h1><p>"), F.col("document_type"), F.lit("</p><footer>End</footer></body></html>"))
    return text.html_text(table(spark, sf, "documents").where("official_name IS NOT NULL AND document_type IS NOT NULL").select("doc_id", page.alias("html")), "html").select("doc_id", "text")


_TIER1 = r"(?m)^(?:\d+\.\s|\d+\.\d+\s|§\s*\d+|Art(?:icle|\.)\s*\d+|第\d+条|제\d+조|المادة\s*\d+|Статья\s*\d+)"


@query(f"""
WITH d AS (SELECT doc_id, text, length(text) - length(replace(text, chr(10), '')) AS breaks FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, unnest(string_split_regex(text, '{_TIER1}')) AS part FROM d)
SELECT doc_id, count(*) AS n_parts FROM p WHERE regexp_matches(part, '[^\\s\\x0B\\x1C-\\x1F\\x{{0085}}\\x{{00A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]') GROUP BY 1 HAVING count(*) >= 3""")
def section_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of the documents that universal marks cut into three or more."""
    docs = table(spark, sf, "documents").where("text IS NOT NULL")
    return text.sections(docs, "text", keep=["doc_id"]).where("tier_used = 'tier1'").groupBy("doc_id").agg(F.count("*").alias("n_parts"))


@query()
def sections_all(spark: SparkSession, sf: str) -> DataFrame:
    """All sections of all documents, by the article label of their language where marks fail."""
    docs = table(spark, sf, "documents").where("text IS NOT NULL")
    return text.sections(docs, "text", "lang", keep=["doc_id"]).select("doc_id", "section_index", "header", F.length("text").alias("n_chars"), "tier_used")


@query(r"""
WITH d AS (SELECT doc_id, trim(regexp_replace(replace(text, chr(0), ''), '[\s\x0B\x1C-\x1F\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) AS t FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, t, unnest(range(0, CAST(ceil(length(t) / 2000.0) AS BIGINT))) AS i FROM d WHERE length(t) > 0),
p AS (SELECT doc_id, i, trim(substring(t, i * 2000 + 1, 2000)) AS part FROM c)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INT) AS section_index, CAST(length(part) AS INT) AS n_chars, md5(part) AS hash FROM p WHERE part <> ''""")
def sections_tier3(spark: SparkSession, sf: str) -> DataFrame:
    """Equal parts of cleaned texts (no line breaks are left, so all stays in the JVM)."""
    clean = table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", text.clean_text(F.col("text")).alias("t"))
    return clean.select("doc_id", F.posexplode(text.equal_parts(F.col("t"))).alias("section_index", "part")).select("doc_id", "section_index", F.length("part").alias("n_chars"), F.md5("part").alias("hash"))


_EDGE = r"[^\p{L}\p{N}_]"
_LITERAL = {"words": "|".join(seeds.SIGNAL_WORDS), "stems": "|".join(seeds.SIGNAL_STEMS), "parts": "|".join(seeds.SIGNAL_PARTS)}


@query(rf"""SELECT id, regexp_matches(section_text_original, '(?i)(^|{_EDGE})(?:(?:{_LITERAL["words"]})($|{_EDGE})|(?:{_LITERAL["stems"]}))') OR regexp_matches(section_text_original, '{_LITERAL["parts"]}') AS signal
FROM (SELECT DISTINCT id, section_text_original FROM section_extractions WHERE section_text_original IS NOT NULL) s""")
def signal_terms(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "section_extractions").where("section_text_original IS NOT NULL").select("id", "section_text_original").distinct()
    return rows.select("id", text.has_signal(F.col("section_text_original")).alias("signal"))


@query()
def gate_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """How many sections of a tier end at each gate; the patterns' own cases are in the unit tests."""
    rows = table(spark, sf, "section_extractions").select("split_tier_used", text.gate(F.col("section_text_original")).alias("outcome"))
    return rows.groupBy("split_tier_used", "outcome").agg(F.count("*").alias("n"))


_VEC = "WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings), q AS (SELECT vec_id AS query_id, e AS qe FROM v WHERE vec_id % 20 = 0)"


@query(f"""{_VEC}, s AS (SELECT query_id, vec_id, round(list_cosine_similarity(qe, e), 6) AS sim, row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(qe, e), 6) DESC, vec_id) AS place FROM v CROSS JOIN q)
SELECT query_id, vec_id, sim AS similarity, CAST(place AS INT) AS place FROM s WHERE sim >= 0.0 AND place <= 20""")
def cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 nearest vectors of each query vector (a stated query set against all rows)."""
    v = table(spark, sf, "embeddings")
    q = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    # each task's own 40 best are shuffled (a window's group limit); 40, so that ties after rounding are settled as the order says
    near = evidence.similar(v, q, "vec_id", "embedding", "query_id", "q", least=-0.0000005, k=40).withColumn("similarity", F.round("similarity", 6))
    return evidence.first_k(near.drop("place").where("similarity >= 0"), ["query_id"], [F.desc("similarity"), "vec_id"], 20)


@query(f"{_VEC} SELECT query_id, label, count(*) AS n FROM v CROSS JOIN q WHERE list_cosine_similarity(qe, e) >= 0.35 GROUP BY 1, 2")
def cosine_threshold_counts(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "embeddings")
    q = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    return evidence.near_counts(v, q, "vec_id", "embedding", "query_id", "q", ["label"])


_RECORDS = "(SELECT DISTINCT id, country_id, pi_criterion_number, reliability_score, sanction_date, enforcing_body FROM enforcement_records WHERE country_id IS NOT NULL AND pi_criterion_number IS NOT NULL)"


@query(f"""SELECT country_id, pi_criterion_number, id, CAST(place AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY country_id, pi_criterion_number
ORDER BY reliability_score DESC NULLS FIRST, sanction_date DESC NULLS FIRST, id) AS place FROM {_RECORDS} r) x WHERE place <= 10""")
def enforcement_top(spark: SparkSession, sf: str) -> DataFrame:
    rows = _records(spark, sf)
    return evidence.top_records(rows, ["country_id", "pi_criterion_number"]).select("country_id", "pi_criterion_number", "id", "place")


def _records(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "enforcement_records").where("country_id IS NOT NULL AND pi_criterion_number IS NOT NULL")
    return rows.select("id", "country_id", "pi_criterion_number", "reliability_score", "sanction_date", "enforcing_body").distinct()


_INDICATORS = "SELECT s_suppkey AS id, s_nationkey AS country_id, CAST(s_suppkey % 14 AS INT) + 1 AS pi_criterion_number, CASE WHEN s_suppkey % 9 <> 0 THEN CAST(2015 + s_suppkey % 11 AS INT) END AS source_year, s_acctbal AS indicator_value FROM {supplier}"


@query(f"""WITH i AS ({_INDICATORS.format(supplier="supplier")}),
e AS (SELECT 0 AS source_ord, country_id, pi_criterion_number, id, row_number() OVER (PARTITION BY country_id, pi_criterion_number ORDER BY reliability_score DESC NULLS FIRST, sanction_date DESC NULLS FIRST, id) AS place FROM {_RECORDS} r
UNION ALL SELECT 1, country_id, pi_criterion_number, id, row_number() OVER (PARTITION BY country_id, pi_criterion_number ORDER BY source_year DESC NULLS LAST, id) FROM i)
SELECT country_id, pi_criterion_number, CAST(source_ord AS INT) AS source_ord, CAST(place AS INT) AS place, id FROM e WHERE source_ord = 1 OR place <= 10""")
def evidence_union(spark: SparkSession, sf: str) -> DataFrame:
    i = spark.sql(_INDICATORS, supplier=table(spark, sf, "supplier")).withColumn("country_id", F.col("country_id").cast("int"))
    by = ["country_id", "pi_criterion_number"]
    both = evidence.united(("enforcement_record", evidence.top_records(_records(spark, sf), by)), ("external_indicator", evidence.latest_indicators(i, by)))
    return both.select(F.col("country_id").cast("bigint"), "pi_criterion_number", "source_ord", "place", "id")


@query(f"""WITH t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country_id, pi_criterion_number ORDER BY reliability_score DESC NULLS FIRST, sanction_date DESC NULLS FIRST, id) AS place FROM {_RECORDS} r) x WHERE place <= 10)
SELECT country_id, pi_criterion_number, CAST(count(*) AS INT) AS n_evidence, string_agg('[' || place || '] ' || coalesce(enforcing_body, 'unknown') || chr(10) || id::VARCHAR, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY place) AS evidence FROM t GROUP BY 1, 2""")
def evidence_text(spark: SparkSession, sf: str) -> DataFrame:
    by = ["country_id", "pi_criterion_number"]
    top = evidence.united(("enforcement_record", evidence.top_records(_records(spark, sf), by).withColumn("body", F.col("id").cast("string"))))
    return evidence.formatted(top, by, "enforcing_body", "body")


_SECTIONS = "(SELECT DISTINCT id, document_id, section_index, extracted_fields, section_header FROM section_extractions WHERE extracted_fields IS NOT NULL) s"


def _extracted(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "section_extractions").where("extracted_fields IS NOT NULL").select("id", "document_id", "section_index", "extracted_fields", "section_header").distinct()


@query(f"""SELECT id, json_extract_string(extracted_fields, '$.notes') AS notes, TRY_CAST(json_extract(extracted_fields, '$.scope_count') AS INT) AS scope_count, TRY_CAST(json_extract_string(extracted_fields, '$.consent') AS BOOLEAN) AS consent FROM {_SECTIONS}""")
def json_promote(spark: SparkSession, sf: str) -> DataFrame:
    return merge.promoted(_extracted(spark, sf), "extracted_fields", {"notes": "string", "scope_count": "int", "consent": "boolean"}).select("id", "notes", "scope_count", "consent")


def _ordered(spark: SparkSession, sf: str) -> DataFrame:
    p = merge.promoted(_extracted(spark, sf), "extracted_fields", {"notes": "string", "scope_count": "int"})
    return p.withColumn("ord", F.col("section_index").cast("bigint") * 10_000_000 + F.col("id")).withColumn("names", F.array("notes"))


_P = f"p AS (SELECT document_id, section_index, section_index::BIGINT * 10000000 + id AS ord, json_extract_string(extracted_fields, '$.notes') AS notes, TRY_CAST(json_extract(extracted_fields, '$.scope_count') AS INT) AS scope_count FROM {_SECTIONS})"


@query(f"WITH {_P} SELECT document_id, arg_min(scope_count, ord) FILTER (scope_count IS NOT NULL) AS scope_count FROM p WHERE section_index IS NOT NULL GROUP BY 1")
def doc_merge_first_nonnull(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merged(_ordered(spark, sf).where("section_index IS NOT NULL"), ["document_id"], "ord", scalars=["scope_count"])


@query(f"""WITH {_P}, f AS (SELECT document_id, notes, min(ord) AS o FROM p WHERE notes IS NOT NULL AND section_index IS NOT NULL GROUP BY 1, 2)
SELECT d.document_id, coalesce(string_agg(f.notes, ',' ORDER BY f.o), '') AS names FROM (SELECT DISTINCT document_id FROM p WHERE section_index IS NOT NULL) d LEFT JOIN f ON f.document_id IS NOT DISTINCT FROM d.document_id GROUP BY 1""")
def doc_merge_distinct_list(spark: SparkSession, sf: str) -> DataFrame:
    out = merge.merged(_ordered(spark, sf).where("section_index IS NOT NULL"), ["document_id"], "ord", lists=["names"])
    return out.select("document_id", F.array_join("names", ",").alias("names"))


@query(f"""WITH {_P} SELECT document_id, string_agg('[§' || ord || '] ' || notes, ' | ' ORDER BY ord) FILTER (notes <> '') AS notes FROM p WHERE section_index IS NOT NULL GROUP BY 1""")
def doc_notes(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merged(_ordered(spark, sf).where("section_index IS NOT NULL"), ["document_id"], "ord", notes="notes")


@query("SELECT id, all_null, coalesce(extracted_fields IN ('{}', '') OR NOT EXISTS (SELECT 1 FROM unnest(json_keys(extracted_fields)) k(k) WHERE coalesce(json_extract_string(extracted_fields, '$.' || k.k), '') NOT IN ('', '[]')), true) AS no_signal FROM (SELECT DISTINCT id, all_null, extracted_fields FROM section_extractions) s")
def all_null_test(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "section_extractions").select("id", "all_null", "extracted_fields").distinct()
    return rows.select("id", "all_null", scalars.has_no_signal(F.col("extracted_fields")).alias("no_signal"))


_URLS = "SELECT content_id, doc_id, url, fetched_at, extracted_text, char_count, attempt_no FROM {document_contents} WHERE url IS NOT NULL"
_U = "(SELECT DISTINCT content_id, doc_id, url, attempt_no, fetched_at, extraction_success, extracted_text FROM document_contents) c"


def _contents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "document_contents").select("content_id", "doc_id", "url", "attempt_no", "fetched_at", "extraction_success", "extracted_text").distinct()


@query(f"SELECT doc_id, url, min(content_id) AS content_id FROM {_U} WHERE url IS NOT NULL GROUP BY 1, 2")
def url_dedupe_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    return discovery.first_seen(_contents(spark, sf).where("url IS NOT NULL"), ["doc_id", "url"], ["content_id"]).select("doc_id", "url", "content_id")


@query("SELECT user_id, event_id, CAST(place AS INT) AS place FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) AS place FROM events) e WHERE place <= 5")
def top_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return discovery.top_k(table(spark, sf, "events"), ["user_id"], [F.desc_nulls_last("value"), "event_id"], 5).select("user_id", "event_id", "place")


@query("SELECT user_id, CAST(floor((place - 1) / 10.0) AS INT) AS batch, count(*) AS n FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events) e GROUP BY 1, 2")
def result_batches(spark: SparkSession, sf: str) -> DataFrame:
    return discovery.in_batches(table(spark, sf, "events"), ["user_id"], ["event_id"], 10).groupBy("user_id", "batch").agg(F.count("*").alias("n"))


@query(f"""SELECT host, n, first_seen FROM (SELECT regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1) AS host, count(*) AS n, min(content_id) AS first_seen FROM {_U} WHERE url IS NOT NULL GROUP BY 1) h ORDER BY n DESC, first_seen, host LIMIT 5""")
def domain_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return discovery.common_values(_contents(spark, sf).where("url IS NOT NULL").withColumn("host", scalars.host_of(F.col("url"))), "host", 5, "content_id")


@query("SELECT event_type, count(value) AS n, round(avg(value), 4) AS mean, min(value) AS least, max(value) AS most, count(*) FILTER (value < 20) AS bin_0, count(*) FILTER (value >= 20 AND value < 40) AS bin_1, count(*) FILTER (value >= 40 AND value < 60) AS bin_2, count(*) FILTER (value >= 60 AND value < 80) AS bin_3, count(*) FILTER (value >= 80) AS bin_4 FROM events GROUP BY 1")
def score_summary(spark: SparkSession, sf: str) -> DataFrame:
    return discovery.score_summary(table(spark, sf, "events"), ["event_type"], "value", (20, 40, 60, 80))


@query("SELECT event_id, value, (value >= 6.0 AND event_type IN ('error', 'purchase')) AS kept, concat_ws(',', CASE WHEN NOT coalesce(value BETWEEN 0 AND 50, false) THEN 'range' END, CASE WHEN NOT coalesce(event_type <> 'error', false) THEN 'kind' END) AS broken FROM events WHERE NOT coalesce(value BETWEEN 0 AND 50, false) OR NOT coalesce(event_type <> 'error', false)")
def validation_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that break a rule, with the rules' names, beside a filter by score and kind."""
    _, bad = discovery.valid(table(spark, sf, "events"), {"range": F.col("value").between(0, 50), "kind": F.col("event_type") != "error"})
    kept = (F.col("value") >= 6.0) & F.col("event_type").isin("error", "purchase")
    return bad.select("event_id", "value", kept.alias("kept"), F.array_join("broken", ",").alias("broken"))


@query(f"""SELECT content_id, contains(url, 'courts.') OR contains(url, 'dpa.') AS official FROM {_U} WHERE url IS NOT NULL""")
def domain_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _contents(spark, sf).where("url IS NOT NULL").select("content_id", discovery.any_part(F.col("url"), ["courts.", "dpa."]).alias("official"))


@query(f"""SELECT doc_id, arg_min(url, attempt_no * 100000000::BIGINT + content_id) FILTER (extraction_success AND length(extracted_text) >= 200) AS url, count(*) AS attempts, coalesce(bool_or(extraction_success AND length(extracted_text) >= 200), false) AS succeeded FROM {_U} GROUP BY 1""")
def first_success(spark: SparkSession, sf: str) -> DataFrame:
    rows = _contents(spark, sf).withColumn("ord", F.col("attempt_no").cast("bigint") * 100_000_000 + F.col("content_id"))
    good = F.col("extraction_success") & text.long_enough(F.col("extracted_text")).isNotNull()
    return retrieval.first_success(rows, ["doc_id"], "ord", good, ["url"])


@query("""SELECT content_id, CASE WHEN content_type = 'pdf' THEN 'pdf' WHEN content_type = 'docx' THEN 'docx' WHEN content_type = 'doc' THEN 'doc' WHEN content_type = 'html' THEN 'html' ELSE
CASE WHEN u LIKE '%.pdf' THEN 'pdf' WHEN u LIKE '%.docx' THEN 'docx' WHEN u LIKE '%.doc' THEN 'doc' ELSE 'html' END END AS kind
FROM (SELECT DISTINCT content_id, content_type, lower(regexp_replace(coalesce(url, ''), '[?#].*$', '')) AS u FROM document_contents) c""")
def content_types(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "document_contents").select("content_id", "content_type", "url").distinct()
    header = F.when(F.col("content_type") == "doc", "application/msword").otherwise(F.col("content_type"))
    return rows.select("content_id", text.content_type_of(header, F.col("url")).alias("kind"))


_SPLIT = "SELECT o_orderkey % 5000 AS k, o_totalprice AS price, o_orderpriority AS priority, o_orderkey AS seq FROM orders WHERE o_orderkey % 2 = {half}"


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders").select((F.col("o_orderkey") % 5000).alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"), F.col("o_orderkey").alias("seq"))
    return o.where("seq % 2 = 0"), o.where("seq % 2 = 1")


_LAST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC) AS n FROM ({q}) a) b WHERE n = 1)"
_T, _S = _LAST.format(q=_SPLIT.format(half=0).replace("% 5000", "% 2500")), _LAST.format(q=_SPLIT.format(half=1).replace("% 5000", "% 2500"))


@query(f"SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.k IS NOT NULL THEN s.price ELSE t.price END AS price, CASE WHEN t.k IS NOT NULL THEN t.priority ELSE s.priority END AS priority FROM {_T} t FULL OUTER JOIN {_S} s ON t.k = s.k")
def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The second half of the orders written over the first: price is updated, priority kept."""
    t, s = (x.withColumn("k", F.col("seq") % 2500) for x in _halves(spark, sf))
    return upsert.upsert(upsert.latest(t, ["k"], ["seq"]), s, ["k"], ["price"], ["seq"]).select("k", "price", "priority")


@query(f"""SELECT coalesce(t.k, s.k) AS k, coalesce(s.price, t.price) AS price FROM (SELECT * FROM {_T} x WHERE k % 3 <> 0) t FULL OUTER JOIN (SELECT * FROM {_S} x WHERE k % 3 <> 0) s ON t.k = s.k
UNION ALL SELECT NULL, price FROM {_T} x WHERE k % 3 = 0 UNION ALL SELECT NULL, price FROM {_S} x WHERE k % 3 = 0""")
def upsert_nulls_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that are null never meet."""
    t, s = (upsert.latest(x.withColumn("k", F.col("seq") % 2500), ["k"], ["seq"]).withColumn("k", F.when(F.col("k") % 3 != 0, F.col("k"))) for x in _halves(spark, sf))
    return upsert.upsert(t, s, ["k"], ["price"], ["seq"], nulls_distinct=True).select("k", "price")


@query("SELECT id, array_to_string(CASE WHEN list_contains(coalesce(aliases, []), upper(name)) THEN aliases ELSE list_append(coalesce(aliases, []), upper(name)) END, ',') AS aliases FROM countries")
def alias_append(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.appended_if_absent(table(spark, sf, "countries"), "aliases", F.upper("name")).select("id", F.array_join("aliases", ",").alias("aliases"))


@query("SELECT n_nationkey AS k FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_nationkey IS NOT NULL)")
def seed_missing_only(spark: SparkSession, sf: str) -> DataFrame:
    """Nations without a supplier."""
    seed = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"))
    return upsert.missing_only(seed, table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")), ["k"])


@query("""WITH c AS (SELECT user_id, substring(sha256(concat_ws('|', user_id::VARCHAR, event_type)), 1, 24) AS key, value, ts FROM events),
l AS (SELECT key, value, ts FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, value DESC) AS n FROM (SELECT key, ts, max(value) AS value FROM c GROUP BY 1, 2) g) x WHERE n = 1),
f AS (SELECT * FROM l WHERE epoch((SELECT max(ts) FROM events)) - epoch(ts) <= 864000)
SELECT r.key, f.value, f.key IS NOT NULL AS hit FROM (SELECT DISTINCT substring(sha256(concat_ws('|', user_id::VARCHAR, event_type)), 1, 24) AS key FROM events) r LEFT JOIN f ON r.key = f.key""")
def cache_hits_ttl(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of the last ten days count."""
    e = table(spark, sf, "events").withColumn("key", scalars.cache_key(F.col("user_id").cast("string"), F.col("event_type"))).withColumn("ts", F.date_trunc("second", "ts"))
    raw = table(spark, sf, "events").withColumn("key", scalars.cache_key(F.col("user_id").cast("string"), F.col("event_type")))
    cache = raw.groupBy("key", "ts").agg(F.max("value").alias("value"))
    now = raw.agg(F.max("ts")).scalar()
    last = upsert.latest(cache, ["key"], ["ts"])
    fresh = incremental.unexpired(last, "ts", now, 864_000)
    return upsert.cache_hits(e.select("key").distinct(), fresh.select("key", "value", "ts"), "key", F.lit(None).cast("timestamp"), None, "value", "ts").select("key", "value", "hit")


@query("SELECT s_suppkey, round(greatest(1.0, least(5.0, s_acctbal / 100 * 4 + 1)), 4) AS score, TRY_CAST(replace(replace(s_acctbal::VARCHAR, '.', ','), ',', '.') AS DOUBLE) AS parsed, coalesce(nullif(TRY_CAST(replace(replace(s_acctbal::VARCHAR, '.', ','), ',', '.') AS DOUBLE), 0), 1.0) AS amount FROM supplier")
def normalise_indicator(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.replace(F.col("s_acctbal").cast("string"), F.lit("."), F.lit(","))
    parsed = scalars.decimal_of(raw)
    return table(spark, sf, "supplier").select("s_suppkey", scalars.linear_score(F.col("s_acctbal")).alias("score"), parsed.alias("parsed"), scalars.or_default(parsed, 1.0).alias("amount"))


@query("SELECT name, regexp_replace(regexp_replace(trim(lower(name)), '[^a-z0-9\\s-]', '', 'g'), '\\s+', '-', 'g') AS slug, CASE length(name) % 3 WHEN 0 THEN 'Free' WHEN 1 THEN 'Partly Free' END AS status, CASE length(name) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 3.0 END::DOUBLE AS score FROM countries")
def slugs_and_status(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.length("name") % 3 == 0, "Free").when(F.length("name") % 3 == 1, "Partly Free")
    return table(spark, sf, "countries").select("name", scalars.slug(F.col("name")).alias("slug"), status.alias("status"), scalars.mapped(status, {k: v[0] for k, v in seeds.STATUS.items()}).alias("score"))


@query("SELECT doc_id, concat_ws(' ', official_name, CASE WHEN NOT contains(lower(official_name), 'site:' || lower(source)) THEN 'site:' || source END, CASE WHEN NOT contains(lower(official_name), 'filetype:') THEN 'filetype:' || lower(content_type) END) AS q FROM documents WHERE official_name IS NOT NULL AND source IS NOT NULL")
def search_strings(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").where("official_name IS NOT NULL AND source IS NOT NULL")
    return d.select("doc_id", scalars.search_string(F.col("official_name"), F.array("source"), F.col("content_type")).alias("q"))


@query("SELECT DISTINCT x.id FROM section_extractions x JOIN documents d ON d.doc_id = x.document_id WHERE x.all_null = false AND x.embedding_model IS NULL AND d.country_id = 4")
def pending_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Sections with a signal that still lack a vector, of one entity's documents."""
    docs = table(spark, sf, "documents").where("country_id = 4").select(F.col("doc_id").alias("document_id"))
    return table(spark, sf, "section_extractions").where("all_null = false AND embedding_model IS NULL").join(docs, "document_id", "left_semi").select("id").distinct()


@query("SELECT DISTINCT d.country_id FROM section_extractions x JOIN documents d ON d.doc_id = x.document_id WHERE x.embedding_model IS NOT NULL AND d.country_id IS NOT NULL")
def embedded_countries(spark: SparkSession, sf: str) -> DataFrame:
    x = table(spark, sf, "section_extractions").where("embedding_model IS NOT NULL").select(F.col("document_id").alias("doc_id"))
    return table(spark, sf, "documents").where("country_id IS NOT NULL").join(x, "doc_id", "left_semi").select("country_id").distinct()


@query(f"WITH s AS ({_SCORES}) SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (SELECT country_id FROM s)")
def scored_entities(spark: SparkSession, sf: str) -> DataFrame:
    s = scores(spark, sf).select(F.col("country_id").alias("n_nationkey"))
    return table(spark, sf, "nation").join(s, "n_nationkey", "left_semi").select("n_nationkey", "n_name")


@query("SELECT count(*) AS n, count(DISTINCT country_id) AS countries FROM documents WHERE list_contains(criteria_ids, 2)")
def criteria_membership(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where(F.array_contains("criteria_ids", 2)).agg(F.count("*").alias("n"), F.count_distinct("country_id").alias("countries"))


_NAMES = ", ".join(f"({n}, '{name}')" for n, name, _, _ in seeds.CRITERIA)


@query(f"""WITH c(n, name) AS (VALUES {_NAMES}) SELECT doc_id, coalesce(nullif((SELECT string_agg(c.name, ', ' ORDER BY c.n) FROM c WHERE list_contains(criteria_ids, c.n)), ''), '—') AS criteria, NOT (source_url IS NULL OR source_url = '') AS has_url FROM documents""")
def criteria_names(spark: SparkSession, sf: str) -> DataFrame:
    names = F.create_map(*[F.lit(x) for n, name, _, _ in seeds.CRITERIA for x in (n, name)])
    joined = F.array_join(F.transform(F.array_sort(F.array_distinct("criteria_ids")), lambda i: names[i]), ", ")
    return table(spark, sf, "documents").select("doc_id", F.coalesce(F.nullif(joined, F.lit("")), F.lit("—")).alias("criteria"), (F.coalesce(F.col("source_url"), F.lit("")) != "").alias("has_url"))


@query("SELECT t.document_type, t.n, d.dimension FROM (SELECT document_type, count(*) AS n FROM documents GROUP BY 1) t LEFT JOIN (VALUES " + ", ".join(f"('{t}', {repr(d) if d else 'NULL'})" for t, _, d in seeds.DOCUMENT_TYPES) + ") d(document_type, dimension) ON t.document_type = d.document_type")
def type_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "documents").groupBy("document_type").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(seeds.document_types(spark)), "document_type", "left").select("document_type", "n", "dimension")


@query("""WITH q(q) AS (SELECT name FROM countries UNION SELECT lower(name) FROM countries UNION SELECT iso_code FROM countries UNION SELECT unnest(aliases) FROM countries UNION SELECT name || 'x' FROM countries UNION SELECT 'Nowhere at all'),
h AS (SELECT q, c.id, CASE WHEN q = c.name THEN 1 WHEN list_contains(coalesce(c.aliases, []), q) THEN 2 WHEN trim(lower(q)) = lower(c.name) THEN 3 WHEN upper(trim(q)) = coalesce(c.iso_code, '') THEN 4
 WHEN levenshtein(trim(lower(q)), lower(c.name)) <= 2 AND length(trim(lower(q))) > 4 THEN 5 END AS s, levenshtein(trim(lower(q)), lower(c.name)) AS e FROM q CROSS JOIN countries c),
b AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s, e, id) AS n FROM h WHERE s IS NOT NULL)
SELECT q.q AS request, b.id AS entity_id, CASE b.s WHEN 1 THEN 'name' WHEN 2 THEN 'alias' WHEN 3 THEN 'folded' WHEN 4 THEN 'code' WHEN 5 THEN 'fuzzy' END AS stage FROM q LEFT JOIN b ON b.q = q.q AND b.n = 1""")
def country_resolution(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "countries")
    asked = c.select(F.explode(F.concat(F.array("name", F.lower("name"), "iso_code", F.concat("name", F.lit("x"))), F.coalesce("aliases", F.array().cast("array<string>")))).alias("request"))
    return resolve.resolved(asked.unionByName(spark.createDataFrame([("Nowhere at all",)], "request string")), c, "request")


@query("SELECT CAST(coalesce(v, -1) AS DOUBLE) AS v, CASE " + " ".join(f"WHEN v >= {b} THEN '{n}'" for b, n in seeds.PERCENT_BANDS[:-1]) + f" WHEN v IS NOT NULL THEN '{seeds.PERCENT_BANDS[-1][1]}' END AS band FROM (SELECT round(avg(value), 1) AS v FROM events GROUP BY user_id) e")
def percent_bands(spark: SparkSession, sf: str) -> DataFrame:
    means = table(spark, sf, "events").groupBy("user_id").agg(F.round(F.avg("value"), 1).alias("v"))
    return means.select(F.coalesce("v", F.lit(-1.0)).alias("v"), scalars.banded(F.col("v"), seeds.PERCENT_BANDS).alias("band"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.windowed(table(spark, sf, "events"), "ts", ["event_type"], "value").select("start", "event_type", "n", "total")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, sid""")
def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.sessions(table(spark, sf, "events"), "ts", ["user_id"]).select("user_id", "start", "n")


@query("SELECT event_type, count(*) AS calls, CAST(floor(sum(length(props)) / greatest(count(*), 1)) AS BIGINT) AS mean_tokens FROM events GROUP BY 1")
def usage_totals(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("calls"), F.sum(F.length("props")).alias("t"))
    return g.select("event_type", "calls", F.floor(F.col("t") / F.greatest("calls", F.lit(1))).cast("bigint").alias("mean_tokens"))


@query("SELECT doc_id, official_name FROM (SELECT doc_id, official_name, row_number() OVER (PARTITION BY country_id, official_name ORDER BY created_at DESC NULLS LAST, doc_id DESC) AS n FROM documents WHERE country_id IS NOT NULL AND official_name IS NOT NULL) d WHERE n = 1")
def republished_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The last arrival of each document of an entity."""
    docs = table(spark, sf, "documents").where("country_id IS NOT NULL AND official_name IS NOT NULL").select("doc_id", "country_id", "official_name", "created_at")
    return upsert.latest(docs, ["country_id", "official_name"], ["created_at", "doc_id"]).select("doc_id", "official_name")


@query("SELECT e.id AS country_id, 2021 AS source_year, 12.5::DOUBLE AS indicator_value FROM countries c JOIN countries e ON upper(e.name) = upper(c.name)")
def snapshot_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Cases embedded in pages, read by the JSON source and joined with entities."""
    c = table(spark, sf, "countries")
    page = F.concat(F.lit('<html><script id="cases">[{"c": "'), F.upper("name"), F.lit('", "d": "2021-05-0'), (F.col("id") % 9 + 1).cast("string"), F.lit('", "f": "12,5"}]</script></html>'))
    cases = readers.embedded_json(c.select(page.alias("html")), "html", "cases", "c: string, d: string, f: string")
    return readers.case_indicators(cases, c)


@query(f"""WITH r AS (SELECT o_orderkey AS id, CAST(o_orderkey % 14 AS INT) + 1 AS criterion_number, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 60 AS DOUBLE) / 10 END AS s, CASE WHEN o_orderkey % 3 = 0 THEN CAST(10 + o_orderkey % 41 AS DOUBLE) / 10 END AS l FROM orders)
SELECT id, s AS criterion_score, CASE WHEN criterion_number IN (4, 5, 7, 9, 14) THEN coalesce(l, s) ELSE l END AS legal_subscore, CASE WHEN criterion_number IN (4, 5, 7, 9, 14) THEN s END AS enforcement_subscore, 'low' AS confidence FROM r WHERE s BETWEEN 1 AND 5""")
def score_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Scores read from JSON answers; out of range and missing ones are rejected."""
    o = table(spark, sf, "orders")
    s = F.when(F.col("o_orderkey") % 7 != 0, (F.col("o_orderkey") % 60).cast("double") / 10)
    sub = F.when(F.col("o_orderkey") % 3 == 0, (10 + F.col("o_orderkey") % 41).cast("double") / 10)
    answers = o.select(F.col("o_orderkey").alias("id"), ((F.col("o_orderkey") % 14).cast("int") + 1).alias("criterion_number"), F.concat(F.lit("```json\n"), F.to_json(F.struct(s.alias("criterion_score"), sub.alias("legal_subscore"))), F.lit("\n```")).alias("response"))
    good, _ = scoring.parsed_scores(answers)
    return good.select("id", "criterion_score", "legal_subscore", "enforcement_subscore", "confidence")


@query("""WITH r AS (SELECT event_id % 200 AS grp, 'u' || (event_id % 37) AS url, event_id AS position FROM events), f AS (SELECT grp, url, min(position) AS position FROM r GROUP BY 1, 2),
s AS (SELECT DISTINCT event_id % 200 AS grp, 'u' || (event_id % 41) AS url, CAST((event_id % 200 + event_id % 41) % 11 AS DOUBLE) AS score FROM events),
t AS (SELECT f.*, s.score, row_number() OVER (PARTITION BY f.grp ORDER BY s.score DESC, f.position, f.url) AS place FROM f JOIN s ON s.grp = f.grp AND s.url = f.url WHERE s.score >= 6)
SELECT grp, url, position, score, CAST(place AS INT) AS place FROM t WHERE place <= 5""")
def scored_urls(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("grp", F.col("event_id") % 200)
    results = e.select("grp", F.concat(F.lit("u"), F.col("event_id") % 37).alias("url"), F.col("event_id").alias("position"))
    given = e.select("grp", F.concat(F.lit("u"), F.col("event_id") % 41).alias("url"), ((F.col("event_id") % 200 + F.col("event_id") % 41) % 11).cast("double").alias("score")).distinct()
    return discovery.scored_results(results, given, ["grp"])


@query("""WITH l AS (SELECT id, list_concat(coalesce(languages, []), coalesce(aliases, []), ['en']) AS l FROM countries), x AS (SELECT id, unnest(l) AS x, generate_subscripts(l, 1) AS o FROM l),
f AS (SELECT id, x, min(o) AS o FROM x GROUP BY 1, 2) SELECT id, string_agg(x, ',' ORDER BY o) AS merged FROM f GROUP BY 1""")
def merged_lists(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "countries").select("id", F.array_join(discovery.merged_lists(F.col("languages"), F.col("aliases"), F.array(F.lit("en"))), ",").alias("merged"))


@query("SELECT coalesce(max(s.reference_year), 0) AS latest FROM (" + _SCORES + ") s")
def latest_year(spark: SparkSession, sf: str) -> DataFrame:
    return scores(spark, sf).agg(F.coalesce(F.max("reference_year"), F.lit(0)).alias("latest"))


@query("SELECT succeeded, count(*) AS documents, sum(attempts) AS attempts FROM (SELECT doc_id, count(*) AS attempts, coalesce(bool_or(extraction_success), false) AS succeeded FROM (SELECT DISTINCT content_id, doc_id, extraction_success FROM document_contents) c GROUP BY 1) d GROUP BY 1")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "document_contents").select("content_id", "doc_id", "extraction_success").distinct()
    d = rows.groupBy("doc_id").agg(F.count("*").alias("attempts"), F.coalesce(F.bool_or("extraction_success"), F.lit(False)).alias("succeeded"))
    return d.groupBy("succeeded").agg(F.count("*").alias("documents"), F.sum("attempts").alias("attempts"))


@query("""SELECT doc_id, priority, document_type, official FROM (SELECT doc_id, CAST(doc_id % 11 AS INT) AS priority, document_type, coalesce(contains(source_url, 'courts.') OR contains(source_url, 'dpa.'), false) AS official FROM documents) d
WHERE priority >= 8 AND document_type IN ('data_protection_law', 'regulation', 'court_decision', 'law', 'guidance')""")
def priority_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of high priority and of some types, and whether their address is official."""
    docs = table(spark, sf, "documents").withColumn("priority", (F.col("doc_id") % 11).cast("int"))
    kept = discovery.of_types(discovery.high_priority(docs, "priority"), "document_type", ["data_protection_law", "regulation", "court_decision", "law", "guidance"])
    return kept.select("doc_id", "priority", "document_type", discovery.any_part(F.col("source_url"), ["courts.", "dpa."]).alias("official"))


@query(f"""WITH s AS ({_SCORES}), g AS (SELECT DISTINCT country_id FROM s), n AS (SELECT unnest([2, 3, 5, 7, 11, 13]) AS n)
SELECT g.country_id, CAST(n.n AS INT) AS criterion_number FROM g CROSS JOIN n WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.country_id = g.country_id AND s.criterion_number = n.n)""")
def criteria_to_score(spark: SparkSession, sf: str) -> DataFrame:
    """What is left to score of a subset of the criteria."""
    s = scores(spark, sf)
    return index.to_score(s.select("country_id").distinct(), s, ["country_id"], [2, 3, 5, 7, 11, 13])


@query("SELECT country_id, opacity FROM (WITH s AS (" + _SCORES + ") SELECT country_id, coalesce(string_agg(criterion_number::VARCHAR, ',' ORDER BY criterion_number) FILTER (information_opacity), '') AS opacity FROM s GROUP BY 1) o")
def opacity_criteria(spark: SparkSession, sf: str) -> DataFrame:
    return index.opacity_lists(scores(spark, sf), ["country_id"]).select("country_id", F.array_join("opacity_criteria", ",").alias("opacity"))


@query("""SELECT doc_id, array_to_string(list_filter(criteria_ids, lambda x: x IN (1, 2, 4, 8, 12)), ',') AS shared, coalesce(array_to_string(list_slice(criteria_ids, 1, 2), ','), '') AS first_two FROM
(SELECT DISTINCT doc_id, criteria_ids FROM documents WHERE criteria_ids IS NOT NULL AND len(list_distinct(criteria_ids)) = len(criteria_ids)) d""")
def schema_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The criteria of a document that a schema knows, in the document's order, and its first two."""
    docs = table(spark, sf, "documents").where("criteria_ids IS NOT NULL AND size(array_distinct(criteria_ids)) = size(criteria_ids)").select("doc_id", "criteria_ids").distinct()
    return docs.select("doc_id", F.array_join(scalars.shared(F.col("criteria_ids"), [1, 2, 4, 8, 12]), ",").alias("shared"), F.array_join(F.slice("criteria_ids", 1, 2), ",").alias("first_two"))


@query("""SELECT d.doc_id, CASE WHEN count(x.id) = 0 THEN 'failed' WHEN bool_or(NOT x.all_null) THEN 'success' ELSE 'partial' END AS status, count(x.id) AS sections, count(x.id) FILTER (NOT x.all_null) AS with_signal
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN (SELECT DISTINCT id, document_id, coalesce(all_null, true) AS all_null FROM section_extractions) x ON x.document_id = d.doc_id GROUP BY 1""")
def extraction_status(spark: SparkSession, sf: str) -> DataFrame:
    """Success with a signal in a section, partial with sections only, failed without any."""
    x = table(spark, sf, "section_extractions").select("id", F.col("document_id").alias("doc_id"), F.coalesce("all_null", F.lit(True)).alias("all_null")).distinct()
    return extraction.status(table(spark, sf, "documents").select("doc_id").distinct(), x, "doc_id").select("doc_id", "status", "sections", "with_signal")


@query("SELECT DISTINCT id, section_index, 8.0::DOUBLE AS score FROM section_extractions WHERE section_index < 20")
def capped_sections(spark: SparkSession, sf: str) -> DataFrame:
    """The demonstration's cap: the first sections, all of one score."""
    return extraction.demonstration(table(spark, sf, "section_extractions").select("id", "section_index")).distinct()


_STOP = {k: ", ".join(f"'{w}'" for w in v) for k, v in seeds.STOP_WORDS.items()}


@query("""WITH w AS (SELECT doc_id, regexp_extract_all(lower(substr(text, 1, 2000)), '[a-zà-öø-ÿąćęłńśźżœß]+|[а-яё]+|[一-鿿]') AS w, CASE WHEN doc_id % 3 = 0 THEN ['en', 'fr'] WHEN doc_id % 3 = 1 THEN [lang] END AS known FROM documents),
n AS (SELECT doc_id, known, greatest(len(w), 1) AS n, """ + ", ".join(f"len(list_filter(w, lambda x: x IN ({v}))) AS n_{k}" for k, v in _STOP.items()) + """, len(list_filter(w, lambda x: regexp_matches(x, '^[а-яё]'))) AS n_ru, 3 * len(list_filter(w, lambda x: regexp_matches(x, '[一-鿿]'))) AS n_zh FROM w),
l AS (SELECT doc_id, known, unnest([""" + ", ".join(f"{{'n': n_{k}, 'k': '{k}'}}" for k in [*seeds.STOP_WORDS, "ru", "zh"]) + """]) AS x FROM n),
b AS (SELECT doc_id, any_value(known) AS known, max(x.n) AS top, sum(x.n) AS total, arg_max(x.k, x.n * 100000 - ascii(x.k) * 256 - ascii(substr(x.k, 2, 1))) AS k FROM l GROUP BY 1),
d AS (SELECT doc_id, known, CASE WHEN top > 0 THEN k ELSE 'unknown' END AS detected, CASE WHEN top > 0 THEN round(top / total::DOUBLE, 6) ELSE 0.0 END AS probability FROM b)
SELECT doc_id, detected, probability, CASE WHEN known[1] <> '' AND NOT coalesce(list_contains(known, detected), false) AND probability < 0.80 THEN known[1] ELSE detected END AS language FROM d""")
def doc_language(spark: SparkSession, sf: str) -> DataFrame:
    """Language of all documents by their first 2,000 characters, and with the languages known beforehand."""
    docs = table(spark, sf, "documents")
    known = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("en"), F.lit("fr"))).when(F.col("doc_id") % 3 == 1, F.array("lang"))
    out = docs.select("doc_id", known.alias("known"), text.detected_language(F.col("text")).alias("d"))
    return out.select("doc_id", F.col("d.language").alias("detected"), F.round("d.probability", 6).alias("probability"), scalars.language_or_known(F.col("d.language"), F.col("d.probability"), F.col("known")).alias("language"))


@query()
def section_records(spark: SparkSession, sf: str) -> DataFrame:
    """One record a document from all its extracted sections."""
    x = table(spark, sf, "section_extractions").select("document_id", "section_index", "extracted_fields", "all_null", "error_message").distinct()
    return extraction.records(x, "document_id", [], {"scope_count": "int", "consent": "boolean"})


@query()
def evidence_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence of all entities and criteria, with hashed words in place of an embedding model's vectors."""
    x = table(spark, sf, "section_extractions").where("NOT all_null AND section_text_original IS NOT NULL").select("document_id", "id", "section_text_original", "all_null").distinct()
    vectors = providers.embedded(x, "section_text_original")
    ask = providers.query_vectors(spark)
    docs = table(spark, sf, "documents").where("criteria_ids IS NOT NULL AND country_id IS NOT NULL").select(F.col("doc_id").alias("document_id"), "country_id", "document_type", "official_name", "criteria_ids")
    r = table(spark, sf, "enforcement_records").where("country_id IS NOT NULL AND pi_criterion_number IS NOT NULL").select("id", "country_id", "pi_criterion_number", "enforcing_body", "summary", "reliability_score", "sanction_date").distinct()
    i = spark.sql(_INDICATORS, supplier=table(spark, sf, "supplier")).withColumn("country_id", F.col("country_id").cast("int"))
    return scoring.evidence_texts(vectors, docs, ask, r, i).select("country_id", "criterion_number", "n_evidence", F.length("evidence").alias("n_chars"))
