"""Every query of the subpackage runs at the smallest scale with the stated columns, and agrees with its SQL."""

import duckdb
import pytest

from indexloom.llm import encoding, queries

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": [("content_id", "bigint")], "p2_found": [("content_id", "bigint"), ("line_no", "int")], "p3_found": [("source_table", "string"), ("document_id", "bigint"), ("section_index", "int")],
    "p4_found": [("source_table", "string"), ("record_id", "bigint"), ("line_no", "int"), ("lang", "string")], "p5_found": [("id_a", "bigint"), ("id_b", "bigint")], "p6_found": [("content_id", "bigint")],
    "p7_ids": [("doc_id", "bigint"), ("ids", "array<int>")], "p8_found": [("doc_id", "bigint"), ("item_id", "bigint")], "p9_found": [("doc_id", "bigint"), ("subject_code", "string")],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    rows = df.collect()
    assert name not in COLUMNS or df.dtypes == COLUMNS[name]
    if name.endswith("_found"):
        assert len(rows) == len(set(rows))
    if name in queries.SQL:
        sql = queries.SQL[name]
        for t in ("section_extractions", "document_sections"):
            sql = sql.replace(f"FROM {t}", f"FROM '{DATA}/{t}.parquet'")
        assert sorted(map(tuple, rows)) == sorted(duckdb.sql(sql).fetchall())


def test_pages_are_restored_by_a_model_of_all_texts(spark, tmp_path, monkeypatch):
    # p2_found restores lines first; that model came from a sample of 2,000 texts
    labelled = [("fr", "Les règles sur caméras routières s’appliquent à péages."), ("en", "The controller must encrypt the records.")]
    texts = [f"Menu\nLes règles du dossier {i} s’appliquent à la même autorité.\nFiche {i}" for i in range(2_600)]
    spark.createDataFrame(labelled, "lang string, text string").write.parquet(f"{tmp_path}/lang_samples.parquet")
    spark.createDataFrame([(i, t, "html", "https://a.example/b") for i, t in enumerate(texts)], "content_id bigint, extracted_text string, content_type string, url string").write.parquet(f"{tmp_path}/document_contents.parquet")
    spark.createDataFrame([(1, labelled[0][1]), (2, labelled[1][1])], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    models, real = [], encoding.repaired
    monkeypatch.setattr(encoding, "repaired", lambda df, model, *a, **k: models.append(model) or real(df, model, *a, **k))
    queries.p2_found(spark, str(tmp_path))
    assert models == [encoding.fit(labelled, texts)]
