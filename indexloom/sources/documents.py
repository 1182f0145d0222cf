"""Text of fetched files, by kind: html and docx with the standard library, pdf and doc by a hook of the caller."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.functions.text import visible_text

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_text(data: bytes) -> str:
    """Non-blank paragraphs of a Word file, one a line."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    paragraphs = ("".join(t.text or "" for t in p.iter(f"{_W}t")) for p in root.iter(f"{_W}p"))
    return "\n".join(p for p in paragraphs if p.strip())


def html_bytes_text(data: bytes) -> str:
    return visible_text(data.decode("utf-8", "replace")) or ""


def file_text(df: DataFrame, content_col: str, kind_col: str, keep: list[str], readers: dict[str, Callable[[bytes], str]] | None = None) -> DataFrame:
    """``keep``, text and error of every file.

    ``readers`` adds or replaces readers by kind; a kind without one, and a reader's exception, give an error and no
    text.  Null content gives neither."""
    known = {"html": html_bytes_text, "docx": docx_text} | (readers or {})
    rows = df.select(*keep, df[content_col].alias("__content"), df[kind_col].alias("__kind"))
    schema = df.select(*keep).withColumn("text", F.lit(None).cast("string")).withColumn("error", F.lit(None).cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, errors = [], []
            for data, kind in zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist(), strict=True):
                text = error = None
                if data is not None and kind not in known:
                    error = f"no reader for {kind}"
                elif data is not None:
                    try:
                        text = known[kind](data)
                    except Exception as e:  # noqa: BLE001
                        error = f"{type(e).__name__}: {e}"[:300]
                texts.append(text)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=[*keep, "text", "error"])

    return rows.mapInArrow(run, schema)
