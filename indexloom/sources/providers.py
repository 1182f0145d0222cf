"""Services outside the engine (models, search, fetching) as tables of responses.

A provider answers a table of requests (request_key, payload) with request_key, response, error and tokens.  What it
answered is itself the cache: hits are joined, only misses are asked, and an error is a row, never an exception.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESPONSE = "request_key string, response string, error string, tokens bigint"


def recorded(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Answers from recorded responses; a request without one has an error."""
    known = responses.select("request_key", "response", "error", "tokens").withColumn("__known", F.lit(True))
    out = requests.select("request_key").join(known, "request_key", "left")
    return out.withColumn("error", F.when(F.col("__known"), F.col("error")).otherwise("no recorded response")).drop("__known")


def called(requests: DataFrame, call: Callable[[str], str], partitions: int | None = None) -> DataFrame:
    """Answers by a Python function, one request at a time inside Arrow batches; its exceptions become errors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    answer = call(payload)
                    rows.append((key, answer, None, len(payload or "") // 4 + len(answer or "") // 4))
                except Exception as e:  # noqa: BLE001
                    rows.append((key, None, f"{type(e).__name__}: {e}"[:500], 0))
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["request_key", "response", "error", "tokens"])

    asked = requests.select("request_key", "payload")
    return (asked.repartition(partitions) if partitions else asked).mapInArrow(run, RESPONSE)


def answered(requests: DataFrame, cache: DataFrame, call: Callable[[str], str]) -> tuple[DataFrame, DataFrame]:
    """(all answers, new ones to append to the cache); failed answers in the cache are asked again."""
    good = cache.where("error IS NULL")
    missing = requests.join(good.select("request_key"), "request_key", "left_anti")
    new = called(missing, call)
    return requests.select("request_key").join(good, "request_key").select("request_key", "response", "error", "tokens").unionByName(new), new


def hashed_vector(text: str, dims: int = 64) -> list[float]:
    """A deterministic stand-in for an embedding: words hashed onto signed dimensions."""
    out = [0.0] * dims
    for word in (text or "").lower().split():
        h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
        out[h % dims] += 1.0 if h >> 63 else -1.0
    return out


def usage(answers: DataFrame, by: list[str] = ()) -> DataFrame:
    """Calls, errors and tokens."""
    return answers.groupBy(*by).agg(F.count("*").alias("calls"), F.count("error").alias("errors"), F.sum("tokens").alias("tokens"))


def retried(requests: DataFrame, answers: DataFrame, smaller: DataFrame, call: Callable[[str], str]) -> DataFrame:
    """Answers in which those that failed or are empty were asked once more with the ``smaller`` payload of their key."""
    good = answers.where("error IS NULL AND response <> ''")
    again = smaller.join(requests.select("request_key"), "request_key", "left_semi").join(good.select("request_key"), "request_key", "left_anti")
    return good.unionByName(called(again, call))


def embedded(df: DataFrame, text_col: str, out_col: str = "embedding", chars: int = 1200, embed: Callable[[str], list[float]] = hashed_vector) -> DataFrame:
    """All columns and the vector of the text's first ``chars`` characters (an embedding model's limit); null for null."""
    schema = df.withColumn(out_col, F.lit(None).cast("array<double>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            vectors = [None if t is None else embed(t[:chars]) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(vectors, pa.list_(pa.float64()))], names=[*batch.schema.names, out_col])

    return df.mapInArrow(run, schema)


def query_vectors(spark: SparkSession, embed: Callable[[str], list[float]] = hashed_vector) -> DataFrame:
    """criterion_number and query_embedding of the fixed query sentences (a row a criterion)."""
    from indexloom.seeds import QUERY_SENTENCES

    return spark.createDataFrame([(n, embed(t)) for n, t in QUERY_SENTENCES.items()], "criterion_number int, query_embedding array<double>")
