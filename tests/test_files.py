"""Files to text, and recorded search answers as a data source."""

import io
import json
import zipfile

from indexloom.sources import documents, search


def docx(*paragraphs):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def test_file_text(spark):
    rows = [(1, docx("One", " ", "Two"), "docx"), (2, b"<p>a<nav>b</nav></p>", "html"), (3, b"broken", "docx"), (4, b"%PDF", "pdf"), (5, None, "html"), (6, b"x", "doc")]
    df = spark.createDataFrame(rows, "id int, content binary, kind string")
    got = {r.id: (r.text, r.error) for r in documents.file_text(df, "content", "kind", ["id"], {"pdf": lambda b: "pages"}).collect()}
    assert got[1] == ("One\nTwo", None) and got[2] == ("a", None) and got[4] == ("pages", None) and got[5] == (None, None)
    assert got[3][0] is None and "BadZipFile" in got[3][1] and got[6] == (None, "no reader for doc")
    assert documents.file_text(df.limit(0), "content", "kind", ["id"]).count() == 0


def test_recorded_search(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"query": "q", "response": {"organic_results": [{"link": "http://a", "title": "A"}, {"title": "none"}, {"link": "http://b"}]}}))
    (tmp_path / "b.json").write_text(json.dumps({"query": "r", "response": {"error": "limit"}}))
    search.register(spark)
    rows = spark.read.format("recorded_search").load(str(tmp_path)).collect()
    assert {(r.query, r.position, r.url, r.error) for r in rows} == {("q", 1, "http://a", None), ("q", 3, "http://b", None), ("r", None, None, "limit")}
