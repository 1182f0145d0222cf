"""Problem 7: ids equal those of the public tokenizer; decoding is exact."""

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from indexloom.llm import tokens

CODEC = tokens.codec(tokens.default_vocabulary(), tokens.PATTERN)
REFERENCE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
REFERENCE.encode_special_tokens = True


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_ids_and_round_trip(text):
    ids = list(CODEC.encode_batch([text])[0])
    assert ids == REFERENCE.encode(text, add_special_tokens=False).ids and CODEC.decode(ids) == text


def test_operator_edges(spark):
    rows = [(1, "Hello <|endoftext|> мир 世界", 9), (2, "", 9), (3, None, None), (None, "x", 9), (4, "a\tb  \n" * 20_000, 9), (1, "Hello <|endoftext|> мир 世界", 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = tokens.token_ids(df)
    by = {r.doc_id: r.ids for r in got.collect()}
    assert got.count() == 6 and by[2] == [] and by[3] == []
    assert by[1] == REFERENCE.encode(rows[0][1], add_special_tokens=False).ids and by[4] == REFERENCE.encode(rows[4][1], add_special_tokens=False).ids
    assert {r.doc_id: r.text for r in tokens.decoded(got).collect()}[4] == rows[4][1]
    assert tokens.token_ids(df.limit(0)).count() == 0
