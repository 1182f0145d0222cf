"""Sections' extracted fields merged into one record a document, in section order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Orders of a first-level part: a group of any size is put together from parts of at most about so many rows.
PART = 1_000


def in_order(order: Column, value: Column) -> Column:
    """Aggregate: the non-null values of a group as a list in ``order`` (ties by the value)."""
    held = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))))
    return F.transform(held, lambda x: x["v"])


def first_value(order: str, value: Column) -> Column:
    """Aggregate: the first non-null value in order; partial aggregates hold one row."""
    return F.min_by(value, F.when(value.isNotNull(), F.struct(F.col(order), value)))


def distinct_in_order(df: DataFrame, by: list[str], order: str, lists: list[str]) -> DataFrame:
    """Distinct items of each list column, first seen first.

    The first sight of each item is aggregated before anything is collected, so a hot group brings its distinct items
    together and not its rows."""
    names = F.array(*map(F.lit, lists))
    items = df.select(*by, F.col(order).alias("__o"), F.explode(F.arrays_zip(names.alias("c"), F.array(*[F.col(c) for c in lists]).alias("l"))).alias("x"))
    seen = items.select(*by, "__o", F.col("x.c").alias("c"), F.posexplode("x.l").alias("at", "v")).where("v IS NOT NULL")
    first = seen.groupBy(*by, "c", "v").agg(F.min(F.struct("__o", "at")).alias("f"))
    none = F.array().cast("array<string>")
    return first.groupBy(*by).agg(*[F.coalesce(F.transform(F.array_sort(F.collect_list(F.when(F.col("c") == c, F.struct("f", "v")))), lambda x: x["v"]), none).alias(c) for c in lists])


def merged(df: DataFrame, by: list[str], order: str, lists: list[str] = (), objects: list[str] = (), scalars: list[str] = (), notes: str | None = None) -> DataFrame:
    """``lists``: distinct strings, first seen first; ``objects``: all, in order; ``scalars``: first that is not null;
    ``notes``: '[§index] note' of each section, joined with ' | '.

    ``order`` is a whole number.  Objects and notes are put together in parts of PART orders first, so that no task sorts
    a whole hot group; what they become is one value by definition."""
    line = F.concat(F.lit("[§"), F.col(order), F.lit("] "), F.col(notes)) if notes else None
    part = df.groupBy(*by, F.floor(F.col(order) / PART).alias("__part")).agg(
        F.count("*").alias("__n"),
        *[F.flatten(in_order(F.col(order), F.col(c))).alias(c) for c in objects],
        *[first_value(order, F.col(c)).alias(c) for c in scalars],
        *([F.nullif(F.array_join(in_order(F.col(order), F.when(F.col(notes) != "", line)), " | "), F.lit("")).alias(notes)] if notes else []),
    )
    p = F.col("__part")
    out = part.groupBy(*by).agg(
        F.sum("__n").alias("__n"),
        *[F.flatten(in_order(p, F.col(c))).alias(c) for c in objects],
        *[first_value("__part", F.col(c)).alias(c) for c in scalars],
        *([F.nullif(F.array_join(in_order(p, F.col(notes)), " | "), F.lit("")).alias(notes)] if notes else []),
    ).drop("__n")
    if lists:
        got = distinct_in_order(df, by, order, lists)
        on = [out[k].eqNullSafe(got[k]) for k in by]
        condition = on[0]
        for c in on[1:]:
            condition = condition & c
        none = F.array().cast("array<string>")
        out = out.join(got, condition, "left").select(*[out[c] for c in out.columns], *[F.coalesce(got[c], none).alias(c) for c in lists])
    return out


def promoted(df: DataFrame, json_col: str, fields: dict[str, str]) -> DataFrame:
    """``fields`` (name: type) of a JSON text as columns; null where absent, malformed or of another type."""
    parsed = F.try_parse_json(F.col(json_col))
    return df.withColumns({name: F.try_variant_get(parsed, f"$.{name}", kind) for name, kind in fields.items()})


def combined_fields(first: Column, second: Column) -> Column:
    """Two JSON objects as one map of strings: the second's keys win, notes of both are joined with ' | '."""
    a, b = (F.coalesce(F.from_json(c, "map<string,string>"), F.create_map().cast("map<string,string>")) for c in (first, second))
    notes = F.nullif(F.concat_ws(" | ", F.nullif(a["notes"], F.lit("")), F.nullif(b["notes"], F.lit(""))), F.lit(""))
    out = F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)
    plain = F.map_filter(out, lambda k, _: k != "notes")
    return F.when(notes.isNotNull(), F.map_concat(plain, F.create_map(F.lit("notes"), notes))).otherwise(plain)
