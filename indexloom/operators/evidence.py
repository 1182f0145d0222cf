"""Evidence of a criterion: similar sections, records, indicators; united and formatted."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from indexloom.functions.scalars import cosine, norm


def _blocks(queries: DataFrame, n: int, order: list[str], most: int) -> list[DataFrame]:
    """The ``n`` queries in blocks of at most ``most`` rows."""
    if most < 1:
        raise ValueError(f"blocks of {most} query vectors; at least one is looked up at a time")
    if n <= most:
        return [queries]
    placed = queries.withColumn("__at", F.row_number().over(Window.orderBy(*order)) - 1)
    return [placed.where((F.col("__at") >= at) & (F.col("__at") < at + most)).drop("__at") for at in range(0, n, most)]


def similar(vectors: DataFrame, queries: DataFrame, id_col: str, vector_col: str, query_id: str, query_col: str, within: list[str] = (), least: float = 0.35, k: int | None = 20, max_queries: int = 10_000) -> DataFrame:
    """Per query (and group ``within``) the ``k`` most similar vectors of at least ``least``: ids, similarity, place.

    The queries are broadcast, at most ``max_queries`` of them at a time; vectors are read once for each such block and
    only their ids and similarities are shuffled.  Ties go to the lesser id; null or zero vectors and other lengths match nothing."""
    v = vectors.select(id_col, *within, F.col(vector_col).alias("__v"), norm(F.col(vector_col)).alias("__nv"))
    pairs = None
    for block in _blocks(queries.select(query_id, query_col), queries.count(), [query_id, query_col], max_queries):
        q = block.select(F.col(query_id), F.col(query_col).alias("__q"), norm(F.col(query_col)).alias("__nq"))
        part = v.join(F.broadcast(q), F.size("__v") == F.size("__q")).select(query_id, *within, id_col, cosine(F.col("__v"), F.col("__q"), F.col("__nv"), F.col("__nq")).alias("similarity"))
        part = part.where(F.col("similarity") >= least)
        pairs = part if pairs is None else pairs.unionByName(part)
    order = Window.partitionBy(query_id, *within).orderBy(F.desc("similarity"), id_col)
    out = pairs.withColumn("place", F.row_number().over(order))
    return out if k is None else out.where(F.col("place") <= k)


def similar_in_blocks(vectors: DataFrame, queries: DataFrame, id_col: str, vector_col: str, query_id: str, query_col: str, within: list[str] = (), least: float = 0.35, k: int | None = 20, max_queries: int = 10_000) -> DataFrame:
    """As ``similar``, for long vectors: an Arrow batch of vectors is multiplied with all queries of a block at once, and
    only the batch's own ``k`` best of each query and group leave it, so little is shuffled."""
    near = None
    for block in _blocks(queries.select(query_id, query_col), queries.count(), [query_id, query_col], max_queries):
        part = _near(vectors, block, id_col, vector_col, query_id, query_col, within, least, k)
        near = part if near is None else near.unionByName(part)
    order = Window.partitionBy(query_id, *within).orderBy(F.desc("similarity"), id_col)
    out = near.withColumn("place", F.row_number().over(order))
    return out if k is None else out.where(F.col("place") <= k)


def _near(vectors: DataFrame, queries: DataFrame, id_col: str, vector_col: str, query_id: str, query_col: str, within: list[str], least: float, k: int | None) -> DataFrame:
    """Per query of one block, and group, the near vectors; the ``k`` best of each batch."""
    rows = [r for r in queries.collect() if r[1] and any(r[1])]
    schema = vectors.select(id_col, *within).join(queries.select(query_id).limit(0)).select(query_id, *within, id_col).withColumn("similarity", F.lit(0.0)).schema
    sent = vectors.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [list(map(float, r[1])) for r in rows]))
    names = [query_id, *within, id_col, "similarity"]
    kind = to_arrow_schema(schema).field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, given = sent.value
        by_length: dict[int, list[int]] = {}
        for i, v in enumerate(given):
            by_length.setdefault(len(v), []).append(i)
        matrices = {n: np.array([given[i] for i in own]) for n, own in by_length.items()}
        matrices = {n: m / np.linalg.norm(m, axis=1, keepdims=True) for n, m in matrices.items()}
        for batch in batches:
            vec, last = batch.column(batch.num_columns - 1), batch.num_columns - 2
            sizes = vec.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for n, m in matrices.items():
                at = np.flatnonzero(sizes == n)
                if not len(at):
                    continue
                block = vec.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), n)
                length = np.linalg.norm(block, axis=1)
                at, block, length = at[length > 0], block[length > 0], length[length > 0]
                r, c = np.nonzero((sims := (block / length[:, None]) @ m.T) >= least)
                found.append((at[r], np.array(by_length[n])[c], sims[r, c]))
            if not found:
                continue
            row, col, sim = (np.concatenate(x) for x in zip(*found, strict=True))
            if k is not None and len(row):
                groups = np.zeros(batch.num_rows, np.int64)
                for j in range(last):
                    codes = batch.column(j).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                    groups = np.unique(groups * (int(codes.max(initial=0)) + 3) + codes + 1, return_inverse=True)[1]
                place_of_id = np.argsort(np.argsort(batch.column(last).to_numpy(zero_copy_only=False), kind="stable"))
                order = np.lexsort((place_of_id[row], -sim, groups[row], col))
                row, col, sim = row[order], col[order], sim[order]
                start = np.flatnonzero(np.append(True, (col[1:] != col[:-1]) | (groups[row][1:] != groups[row][:-1])))
                place = np.arange(len(row)) - np.repeat(start, np.diff(np.append(start, len(row))))
                row, col, sim = row[place < k], col[place < k], sim[place < k]
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array([ids[c] for c in col], kind), *[batch.column(j).take(taken) for j in range(last)], batch.column(last).take(taken), pa.array(sim)], names=names)

    return vectors.where(F.col(id_col).isNotNull()).select(*within, id_col, vector_col).mapInArrow(run, schema)


def near_counts(vectors: DataFrame, queries: DataFrame, id_col: str, vector_col: str, query_id: str, query_col: str, by: list[str], least: float = 0.35, max_queries: int = 10_000) -> DataFrame:
    """Per query and group ``by`` the number of vectors of at least ``least``; pairs are counted before anything is shuffled."""
    out = None
    for block in _blocks(queries.select(query_id, query_col), queries.count(), [query_id, query_col], max_queries):
        part = _near(vectors, block, id_col, vector_col, query_id, query_col, by, least, None)
        out = part if out is None else out.unionByName(part)
    return out.groupBy(query_id, *by).agg(F.count("*").alias("n"))


def first_k(df: DataFrame, by: list[str], order: list, k: int | None) -> DataFrame:
    """The first ``k`` rows of each group in ``order``, with their place."""
    out = df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return out if k is None else out.where(F.col("place") <= k)


def top_records(records: DataFrame, by: list[str], k: int = 10) -> DataFrame:
    """Most reliable, then latest records, unknown values first."""
    return first_k(records, by, [F.desc_nulls_first("reliability_score"), F.desc_nulls_first("sanction_date"), "id"], k)


def latest_indicators(indicators: DataFrame, by: list[str]) -> DataFrame:
    """All indicators, latest year first, unknown years last."""
    return first_k(indicators, by, [F.desc_nulls_last("source_year"), "id"], None)


def united(*sources: tuple[str, DataFrame]) -> DataFrame:
    """Union of differing evidence; source_type and source_ord (as given) tell where a row comes from."""
    out = None
    for i, (name, df) in enumerate(sources):
        part = df.withColumn("source_type", F.lit(name)).withColumn("source_ord", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def formatted(evidence: DataFrame, by: list[str], header: str, body: str, cap: int = 2000) -> DataFrame:
    """One text a group: numbered blocks in the order of source_ord and place."""
    rows = evidence.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("source_ord", "place", F.col(header).alias("h"), F.substring(body, 1, cap).alias("b")))).alias("rows"))
    blocks = F.transform("rows", lambda x, i: F.concat(F.lit("["), i + 1, F.lit("] "), F.coalesce(x["h"], F.lit("unknown")), F.lit("\n"), F.coalesce(x["b"], F.lit(""))))
    return rows.select(*by, F.size("rows").alias("n_evidence"), F.array_join(blocks, "\n\n---\n\n").alias("evidence"))


def lacking_evidence(scores: DataFrame, documents: DataFrame, sections: DataFrame, keys: list[str] = ("country_id", "criterion_number")) -> DataFrame:
    """The scores, with retrieval_limited: no embedded section with a signal belongs to a document of the same entity and criterion.

    The documents' criteria are exploded, so the anti-join is an equi-join."""
    embedded = sections.where("has_embedding AND NOT all_null").select("document_id").distinct()
    covered = documents.select(F.col("doc_id").alias("document_id"), "country_id", F.explode("criteria_ids").alias("criterion_number")).join(embedded, "document_id", "left_semi").select(*keys).distinct().withColumn("__covered", F.lit(True))
    return scores.join(covered, list(keys), "left").withColumn("retrieval_limited", F.col("__covered").isNull()).drop("__covered")
