"""Problem 3: pieces of oversized texts."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from indexloom.llm import pieces


def check(text, limit, overlap):
    spans = pieces.cut_spans(text, limit, overlap)
    assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(b - a <= limit for a, b in spans)
    assert all(c == b - overlap for (_, b), (c, _) in zip(spans, spans[1:]))
    assert "".join(text[a + (overlap if i else 0) : b] for i, (a, b) in enumerate(spans)) == text
    return spans


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab. \n。é", max_size=900), st.integers(40, 200), st.integers(0, 10))
def test_pieces_hold_all(text, limit, overlap):
    check(text, limit, overlap)


def test_cut_falls_between_topics():
    a, b = "Ships sail on the sea with cargo. " * 33, "Doctors treat patients in the ward. " * 33
    assert (0, len(a)) in check(a + b, 1300, 100)


@pytest.mark.parametrize("text", ["x" * 9000, "汉" * 5000, "é" * 2500, "word " * 3000])
def test_no_boundaries(text):
    check(text, 2000, 200)


def test_operator_edges(spark):
    rows = [(1, 0, "x" * 2001, 5), (1, 0, "x" * 2001, 5), (2, 0, "x" * 2000, None), (3, None, None, 1), (4, 1, "", 1), (None, 2, "word " * 50_000, 1)]
    df = spark.createDataFrame(rows, "document_id bigint, section_index int, body string, piece_no int")
    got = pieces.split_pieces(df, "body", ["document_id", "section_index"])
    assert got.where("document_id = 1").count() == 2 and {r.document_id for r in got.collect()} == {1, None}
    assert max(len(r.piece) for r in got.collect()) <= 2000
    assert pieces.split_pieces(df.limit(0), "body", ["document_id"]).count() == 0
    with pytest.raises(ValueError):
        pieces.cut_spans("a", 10, 9)
