"""Index of entities: pools of criterion scores, weighted means, blend, bands, coverage, rank.

All entities, years and models are computed by one aggregation; nothing loops over entities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexloom import seeds
from indexloom.functions.scalars import banded, confidence_weight

N = len(seeds.CRITERIA)


def with_missing(scores: DataFrame, keys: list[str], strategy: str = "exclude") -> DataFrame:
    """``penalise_as_1``: a row of score 1 and low confidence for each criterion that a group lacks; ``exclude``: as is."""
    if strategy == "exclude":
        return scores
    if strategy != "penalise_as_1":
        raise ValueError(f"unknown strategy {strategy!r}")
    have = scores.groupBy(*keys).agg(F.collect_set("criterion_number").alias("have"))
    lacking = have.select(*keys, F.explode(F.array_except(F.sequence(F.lit(1), F.lit(N)), "have")).alias("criterion_number"))
    dims = F.create_map(*[F.lit(x) for n, _, d, _ in seeds.CRITERIA for x in (n, d)])
    one, dim = F.lit(1.0), dims[F.col("criterion_number")]
    filled = lacking.select(
        *keys, "criterion_number", dim.alias("dimension"), one.alias("criterion_score"),
        F.when(dim.isin("legal", "mixed"), one).alias("legal_subscore"), F.when(dim.isin("enforcement", "mixed"), one).alias("enforcement_subscore"),
        F.lit("low").alias("confidence"), F.lit(False).alias("information_opacity"),
    )
    return scores.unionByName(filled, allowMissingColumns=True)


def pool_values(strict_null: bool = False, w_legal: Column | None = None) -> tuple[Column, Column]:
    """(value in the legal pool, value in the enforcement pool) of a score row, null where it is in neither.

    A mixed criterion counts with its sub-score.  A sub-score that is null or zero falls back to the criterion's score;
    with ``strict_null`` only null does, and the blend of both sub-scores by ``w_legal`` comes first.
    """
    dim, score = F.col("dimension"), F.col("criterion_score")
    mixed = (dim == "mixed") & F.col("criterion_number").isin(*seeds.SUBSCORED)
    if strict_null:
        blend = w_legal * F.col("legal_subscore") + (1 - w_legal) * F.col("enforcement_subscore")
        sub = [F.coalesce(c, blend, score) for c in ("legal_subscore", "enforcement_subscore")]
    else:
        sub = [F.coalesce(F.nullif(F.col(c), F.lit(0.0)), score) for c in ("legal_subscore", "enforcement_subscore")]
    return tuple(F.when(mixed, s).when(dim.isin(d, "mixed"), score) for s, d in zip(sub, ("legal", "enforcement"), strict=True))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum(v w) / Sum(w) over non-null values; the plain mean where the weights sum to zero; null without values."""
    w = F.when(value.isNotNull(), weight)
    return F.coalesce(F.sum(value * w) / F.nullif(F.sum(w), F.lit(0.0)), F.avg(value))


def rounded(value: Column, places: int = 4) -> Column:
    """Half up; a nudge far below a place makes ties go up whatever the order in which the terms were added."""
    return F.round(value + 1e-9, places)


def blend(legal: Column, enforcement: Column, w_legal: Column, w_enforcement: Column) -> Column:
    """Both: weighted; one: that one; none: 1."""
    return F.coalesce(legal * w_legal + enforcement * w_enforcement, legal, enforcement, F.lit(1.0))


def index_scores(scores: DataFrame, keys: list[str], w_legal: float = 0.4, w_enforcement: float = 0.6, strategy: str = "exclude", weighted: bool = True, least: int = 12) -> DataFrame:
    """A row a group: legal_score, enforcement_score, final_score (four places), category (of the unrounded score),
    criteria_count, missing_criteria, opacity_count and partial_coverage (fewer than ``least`` criteria).

    The count is taken after ``penalise_as_1`` has filled, so that strategy never leaves partial coverage.  Null
    criterion numbers and scores count for nothing."""
    rows = with_missing(scores.where("criterion_number IS NOT NULL AND criterion_score IS NOT NULL"), keys, strategy)
    legal, enforcement = pool_values()
    w = confidence_weight(F.col("confidence"), weighted)
    out = rows.groupBy(*keys).agg(
        weighted_mean(legal, w).alias("l"), weighted_mean(enforcement, w).alias("e"),
        F.array_sort(F.collect_set("criterion_number")).alias("have"),
        F.count_distinct(F.when(F.col("information_opacity"), F.col("criterion_number"))).alias("opacity_count"),
    )
    final = blend(F.col("l"), F.col("e"), F.lit(w_legal), F.lit(w_enforcement))
    return out.select(
        *keys, rounded(F.col("l")).alias("legal_score"), rounded(F.col("e")).alias("enforcement_score"), rounded(final).alias("final_score"),
        banded(final, seeds.INDEX_BANDS).alias("category"), F.size("have").alias("criteria_count"),
        F.array_except(F.sequence(F.lit(1), F.lit(N)), "have").alias("missing_criteria"), "opacity_count", (F.size("have") < least).alias("partial_coverage"),
    )


def ranked(index: DataFrame, entity: str, within: list[str] = ()) -> DataFrame:
    """Adds rank: by final score from the top, ties by the entity's key; null for partial coverage."""
    order = Window.partitionBy(*within, "partial_coverage").orderBy(F.desc("final_score"), entity)
    return index.withColumn("rank", F.when(~F.col("partial_coverage"), F.row_number().over(order)))


def averaged_rank(value: Column, within: list[str]) -> Column:
    """Rank from the top in which ties share the mean of their places."""
    by = Window.partitionBy(*within)
    return F.rank().over(by.orderBy(value.desc())) + (F.count("*").over(Window.partitionBy(*within, value)) - 1) / F.lit(2.0)


def to_score(entities: DataFrame, scored: DataFrame, keys: list[str], criteria: list[int] | None = None) -> DataFrame:
    """The criteria (of a subset, if given) that an entity has no score for: a small grid an entity, anti-joined."""
    wanted = F.array(*map(F.lit, sorted(set(criteria)) if criteria is not None else range(1, N + 1)))
    grid = entities.select(*keys, F.explode(wanted).alias("criterion_number"))
    return grid.join(scored.select(*keys, "criterion_number"), [*keys, "criterion_number"], "left_anti")


def opacity_lists(scores: DataFrame, keys: list[str]) -> DataFrame:
    """opacity_criteria: the numbers of the criteria whose information is opaque, in order, empty where none is."""
    opaque = F.when(F.col("information_opacity"), F.col("criterion_number"))
    return scores.groupBy(*keys).agg(F.array_sort(F.collect_set(opaque)).alias("opacity_criteria"))
