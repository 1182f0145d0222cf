"""Fetching in rank order: the first success of each document counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_success(attempts: DataFrame, by: list[str], order: str, success: Column, keep: list[str]) -> DataFrame:
    """A row a group: ``keep`` of the first successful attempt in ``order`` (null if none), attempts, succeeded."""
    hit = F.min_by(F.struct(*keep), F.when(success, F.struct(F.col(order), F.xxhash64(*keep))))
    out = attempts.groupBy(*by).agg(hit.alias("h"), F.count("*").alias("attempts"), F.coalesce(F.bool_or(success), F.lit(False)).alias("succeeded"))
    return out.select(*by, *[F.col(f"h.{c}").alias(c) for c in keep], "attempts", "succeeded")
