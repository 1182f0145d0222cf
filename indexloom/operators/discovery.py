"""Search results: filters, de-duplication, ranking, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_seen(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """The first row of each ``by`` in ``order``; a null key is a key of its own."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__n = 1").drop("__n")


def top_k(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first ``k`` rows of each group."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("place") <= k)


def in_batches(df: DataFrame, by: list[str], order: list, size: int) -> DataFrame:
    """Adds batch: the number (from 0) of the group's batch of ``size`` rows."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("batch", F.floor((place - 1) / size).cast("int"))


def any_part(text: Column, parts: list[str]) -> Column:
    """Whether ``text`` contains one of ``parts``; false for null."""
    found = F.lit(False)
    for p in parts:
        found = found | text.contains(p)
    return F.coalesce(found, F.lit(False))


def valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep all rules, the others with the names of the broken ones)."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    checked = df.withColumn("broken", broken)
    return checked.where(F.size("broken") == 0).drop("broken"), checked.where(F.size("broken") > 0)


def score_summary(df: DataFrame, by: list[str], score: str, cuts: tuple[float, ...] = (2, 4, 6, 8)) -> DataFrame:
    """Number, mean, least, greatest and a histogram with ``cuts`` of the scores."""
    v = F.col(score)
    edges = [float("-inf"), *cuts, float("inf")]
    bars = [F.count_if((v >= a) & (v < b)).alias(f"bin_{i}") for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    return df.groupBy(*by).agg(F.count(v).alias("n"), F.round(F.avg(v), 4).alias("mean"), F.min(v).alias("least"), F.max(v).alias("most"), *bars)


def common_values(df: DataFrame, value: str, k: int, order: str) -> DataFrame:
    """The ``k`` most frequent values, ties by first sight in ``order``."""
    return df.groupBy(value).agg(F.count("*").alias("n"), F.min(order).alias("first_seen")).orderBy(F.desc("n"), "first_seen", value).limit(k)


def scored_results(results: DataFrame, scores: DataFrame, by: list[str], url: str = "url", least: float | None = 6.0, k: int | None = 5) -> DataFrame:
    """Results with their score: the first result of an address counts, scores without one are dropped; the best ``k``."""
    first = first_seen(results, [*by, url], ["position"])
    out = first.join(scores, [*by, url])
    out = out if least is None else out.where(F.col("score") >= least)
    return out if k is None else top_k(out, by, [F.desc("score"), "position", url], k)


def merged_lists(*lists: Column) -> Column:
    """The items of all lists, first seen first, each once; null lists are empty."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*[F.coalesce(x, none) for x in lists]))


def meaningful(text: Column) -> Column:
    """Not one of the ways to say that there is nothing."""
    return ~F.lower(F.trim(F.coalesce(text, F.lit("")))).isin("", "none", "none significant", "none.", "n/a")


def high_priority(df: DataFrame, priority: str, least: float = 8) -> DataFrame:
    """Rows of at least this priority; null is none."""
    return df.where(F.col(priority) >= least)


def of_types(df: DataFrame, kind: str, kinds: list[str]) -> DataFrame:
    """Rows of exactly these kinds."""
    return df.where(F.col(kind).isin(kinds))
