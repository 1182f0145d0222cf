"""Sinks: snapshots, exports, matrices, versions of tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of the index export, in order.
EXPORT = ["country_name", "iso_code", "final_score", "legal_score", "enforcement_score", "pi_category", "rank", "criteria_count", "opacity_affected"]


def file_name(text: str) -> str:
    return re.sub(r"[/:]", "_", text)


def snapshot(df: DataFrame, folder: str, run: str) -> None:
    """JSON of a run, kept by its name, and the same as ``latest``; written once, then copied file by file."""
    df.write.mode("overwrite").json(f"{folder}/run_ts={file_name(run)}")
    spark = df.sparkSession
    spark.read.schema(df.schema).json(f"{folder}/run_ts={file_name(run)}").write.mode("overwrite").json(f"{folder}/latest")


def export_index(index: DataFrame, path: str, form: str = "csv") -> None:
    """One file of the ranked index (a row an entity, so it is small), by rank, those without a rank last."""
    rows = index.select(*EXPORT).orderBy(F.asc_nulls_last("rank"), "country_name").coalesce(1).write.mode("overwrite")
    rows.csv(path, header=True) if form == "csv" else rows.json(path)


def markdown(df: DataFrame, most: int = 1_000) -> str:
    """A small result as a Markdown table; more than ``most`` rows are an error, not a cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows)])
