"""Helpers shared by the corpus operators: table access, cut lineage, Arrow maps."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.  Where the session names none a local one serves sessions of one machine (tests);
    on a cluster that is an error, since executors would not see each other's files."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + os.path.join(tempfile.gettempdir(), "indexloom-checkpoint")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def stored(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: lineage is cut, executors may be lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/indexloom-{uuid.uuid4().hex}"
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """At most ``n`` distinct rows, those of the least hash of ``keys`` (all columns by default), whatever their order.

    Rows are first thinned by their hash to a few times ``n`` different ones, and copies become one, so that neither a
    sort nor the driver ever sees more than that, however many rows, copies or partitions there are."""
    names = keys or tuple(df.columns)
    different = max(df.agg(F.approx_count_distinct(F.xxhash64(*names), 0.03)).first()[0], 1)
    df = df.where(F.pmod(F.xxhash64(*names), F.lit(1 << 40)) < min(1 << 40, int((1 << 40) * (3 * n + 100) / different)))
    return df.distinct().orderBy(F.pmod(F.xxhash64(*names), F.lit(1 << 40)), *names).limit(n)


def arrow_map(df: DataFrame, rows: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Apply ``rows`` (columns of a batch as lists -> columns of any length) batch by batch."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = rows({n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)
