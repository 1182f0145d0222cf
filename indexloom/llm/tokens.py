"""Problem 7: encoding of a corpus with a public byte-level BPE vocabulary.

A sentencepiece BPE model is written straight from the vocabulary: every piece is the byte string of a rank, its bytes
mapped to printable characters, scored by the negative rank, with identity normalisation.  Pre-tokens are encoded by
that model; decoding maps the pieces back to bytes.  Nothing is trained.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Pre-token pattern of the vocabulary (fixed value of the public tokenizer).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens kept in a worker's cache, and the longest one worth keeping.
CACHE_ENTRIES, CACHE_CHARS = 150_000, 48


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def byte_characters() -> list[str]:
    """A printable character for each byte: the byte's own where it has one, else the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Codec:
    """Encodes and decodes with a rank file (``base64 rank`` a line); ids are the ranks."""

    def __init__(self, path: str, pattern: str = PATTERN) -> None:
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.bytes_as = byte_characters()
        self.table = {i: c for i, c in enumerate(self.bytes_as)}
        with open(path, "rb") as lines:
            ranked = sorted((int(rank), base64.b64decode(piece)) for piece, rank in map(bytes.split, lines))
        assert [r for r, _ in ranked] == list(range(len(ranked))), "ranks must be 0, 1, 2, ..."
        self.pieces = [b for _, b in ranked]
        model = pb.ModelProto()
        for rank, piece in ranked:
            model.pieces.add(piece=self._mapped(piece), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
        model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
        spec, norm = model.trainer_spec, model.normalizer_spec
        spec.model_type, spec.vocab_size, spec.unk_id = pb.TrainerSpec.BPE, len(model.pieces), len(ranked)
        spec.bos_id = spec.eos_id = spec.pad_id = -1
        norm.name, norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces = "identity", False, False, False
        self.model = SentencePieceProcessor(model_proto=model.SerializeToString())
        self.split = regex.compile(pattern).findall
        self.known: dict[str, array] = {}

    def _mapped(self, raw: bytes) -> str:
        return raw.decode("latin-1").translate(self.table)

    def encode_batch(self, texts: list[str | None]) -> list[array]:
        """The ids of each text; none for a null or empty text."""
        split = [self.split(t) if t else [] for t in texts]
        if len(self.known) > CACHE_ENTRIES:
            self.known = {}
        long: dict[str, array] = {}
        new = [p for p in set(chain.from_iterable(split)) if p not in self.known]
        for p, ids in zip(new, self.model.encode([self._mapped(p.encode("utf-8", "surrogatepass")) for p in new], num_threads=1) if new else [], strict=True):
            (self.known if len(p) <= CACHE_CHARS else long)[p] = array("i", ids)
        out = []
        for parts in split:
            ids = array("i")
            for p in parts:
                ids += self.known.get(p) or long[p]
            out.append(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "surrogatepass")


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def token_ids(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """``id_col`` (bigint) and ``ids`` (array<int>) of every row, in one pass without a shuffle.

    ``vocabulary``: path of a rank file, the 50k byte-level one by default; it must exist on every executor.
    A null or empty text gives an empty list, a null id stays null, strings that look like special tokens are ordinary
    text, repeated rows stay, an empty table gives an empty result; other columns, whatever their names, are not read.
    """
    path = vocabulary or default_vocabulary()
    cols = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = use.encode_batch(part.column(1).to_pylist())
                flat, ends = array("i"), array("i", [0])
                for x in ids:
                    flat += x
                    ends.append(len(flat))
                lists = pa.ListArray.from_arrays(pa.array(memoryview(ends), pa.int32()), pa.array(memoryview(flat), pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[id_col, "ids"])

    return cols.mapInArrow(run, f"`{id_col}` bigint, ids array<int>")


def decoded(df: DataFrame, vocabulary: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """The inverse: ``ids`` of every row back to ``text``; an empty list gives an empty text, a null one null."""
    from indexloom.llm.common import arrow_map

    path = vocabulary or default_vocabulary()
    key = df.columns[0]
    return arrow_map(
        df.select(df[key].cast("long").alias(key), "ids"),
        lambda c: {key: c[key], "text": [None if x is None else codec(path, pattern).decode(x) for x in c["ids"]]},
        f"`{key}` bigint, text string",
    )
