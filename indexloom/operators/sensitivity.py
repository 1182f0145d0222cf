"""How far the ranking depends on the weight of the legal pool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexloom import seeds
from indexloom.functions.scalars import banded, confidence_weight
from indexloom.operators.index import averaged_rank, blend, pool_values, rounded, weighted_mean


def sweep(scores: DataFrame, entity: str, scenarios: tuple[float, ...] = seeds.SCENARIOS) -> DataFrame:
    """entity, w_legal, final_score (four places), band and avg_rank (ties share it) for every scenario."""
    w = F.col("w_legal")
    rows = scores.where("criterion_number IS NOT NULL AND criterion_score IS NOT NULL").withColumn("w_legal", F.explode(F.array(*map(F.lit, scenarios))))
    legal, enforcement = pool_values(strict_null=True, w_legal=w)
    weight = confidence_weight(F.coalesce("confidence", F.lit("low")))
    out = rows.groupBy(entity, "w_legal").agg(weighted_mean(legal, weight).alias("l"), weighted_mean(enforcement, weight).alias("e"))
    final = rounded(blend(F.col("l"), F.col("e"), w, 1 - w))
    out = out.select(entity, "w_legal", final.alias("final_score"), banded(final, seeds.SWEEP_BANDS).alias("band"))
    return out.withColumn("avg_rank", averaged_rank(F.col("final_score"), ["w_legal"]))


def safe_corr(x: str, y: str) -> Column:
    """Pearson correlation; null where a side is constant (or there are fewer than two rows)."""
    return F.when((F.stddev_pop(x) > 0) & (F.stddev_pop(y) > 0), F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0)))


def compared(swept: DataFrame, entity: str, baseline: float = seeds.BASELINE) -> DataFrame:
    """Each scenario against the baseline: spearman, moved (entities whose rank changed), band_changes, max_shift."""
    base = swept.where(F.col("w_legal") == baseline).select(entity, F.col("avg_rank").alias("base_rank"), F.col("band").alias("base_band"))
    both = swept.join(base, entity)
    shift = F.abs(F.col("avg_rank") - F.col("base_rank"))
    return both.groupBy("w_legal").agg(
        F.round(safe_corr("avg_rank", "base_rank"), 6).alias("spearman"), F.count_if(shift > 0).alias("moved"),
        F.count_if(F.col("band") != F.col("base_band")).alias("band_changes"), F.max(shift).alias("max_shift"),
    )


def matrix(swept: DataFrame, entity: str, value: str, scenarios: tuple[float, ...] = seeds.SCENARIOS) -> DataFrame:
    """entity by scenario."""
    out = swept.groupBy(entity).pivot("w_legal", list(scenarios)).agg(F.first(value))
    return out.toDF(entity, *[f"w_{round(s * 100):03d}" for s in scenarios])
