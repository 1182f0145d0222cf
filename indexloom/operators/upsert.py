"""Idempotent upserts, keyed caches and versioned tables on plain Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], seq: list[Column | str]) -> DataFrame:
    """The last row of each key by ``seq``; rows equal in ``seq`` are taken by their values, so reruns agree."""
    order = [*(F.col(s).desc_nulls_last() if isinstance(s, str) else s for s in seq), F.xxhash64(*df.columns)]
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update: list[str], seq: list[Column | str], nulls_distinct: bool = False) -> DataFrame:
    """``target`` after the last source row of each key has been written.

    A key that is there takes ``update`` from the source and keeps its other columns; a new key takes all columns that
    the source has.  ``nulls_distinct``: keys with a null never meet, as in a UNIQUE constraint, so such rows pile up.
    """
    if nulls_distinct:
        loose = F.lit(False)
        for k in keys:
            loose = loose | F.col(k).isNull()
        return upsert(target.where(~loose), source.where(~loose), keys, update, seq).unionByName(target.where(loose)).unionByName(source.where(loose).select(*[F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns]))
    t, s = target.withColumn("__t", F.lit(True)).alias("t"), latest(source, keys, seq).withColumn("__s", F.lit(True)).alias("s")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    columns = []
    for c in target.columns:
        old, new = F.col(f"t.{c}"), F.col(f"s.{c}") if c in source.columns else F.lit(None).cast(target.schema[c].dataType)
        if c in keys or c not in update:
            columns.append(F.when(F.col("t.__t"), old).otherwise(new).alias(c))
        else:
            columns.append(F.when(F.col("s.__s"), new).otherwise(old).alias(c))
    return t.join(s, on, "full_outer").select(*columns)


def appended_if_absent(df: DataFrame, list_col: str, item: Column) -> DataFrame:
    """``item`` at the end of the list unless it is there or null."""
    have = F.coalesce(F.col(list_col), F.array().cast(df.schema[list_col].dataType))
    return df.withColumn(list_col, F.when(item.isNotNull() & ~F.array_contains(have, item), F.array_append(have, item)).otherwise(F.col(list_col)))


def missing_only(seed: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Seed rows whose key the table lacks (ON CONFLICT DO NOTHING)."""
    return seed.join(table.select(*keys), keys, "left_anti")


def cache_hits(requests: DataFrame, cache: DataFrame, key: str, now: Column, ttl_seconds: int | None, value: str, cached_at: str) -> DataFrame:
    """The requests with the cached ``value`` and hit; an entry older than the TTL is none.  The last entry of a key counts."""
    entry = latest(cache, [key], [cached_at]).select(key, F.col(value), F.col(cached_at))
    if ttl_seconds is not None:
        entry = entry.where(F.unix_timestamp(now) - F.unix_timestamp(cached_at) <= ttl_seconds)
    return requests.join(entry.withColumn("__hit", F.lit(True)), key, "left").withColumn("hit", F.coalesce("__hit", F.lit(False))).drop("__hit")


def write_version(df: DataFrame, path: str) -> str:
    """A new version directory of a table, then the pointer to it; readers of the old version are not disturbed."""
    spark, name = df.sparkSession, f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    pointer = spark.createDataFrame([(name,)], "version string").withColumn("written_at", F.current_timestamp())
    pointer.coalesce(1).write.mode("append").parquet(f"{path}/_pointers")
    return name


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The version last pointed to."""
    last = spark.read.parquet(f"{path}/_pointers").orderBy(F.desc("written_at")).first()
    return spark.read.parquet(f"{path}/{last.version}")


def with_columns(df: DataFrame, wanted: dict[str, tuple[str, object]]) -> DataFrame:
    """Back-fills columns that a table lacks (name: type, default), as an additive migration does."""
    return df.withColumns({c: F.lit(v).cast(t) for c, (t, v) in wanted.items() if c not in df.columns})
