"""Problem 5: near-duplicate texts by circulant MinHash, banding and exact Jaccard verification.

Two permutations are used: sigma spreads the shingles over the hash universe, pi, circularly shifted by k, gives
coordinate k of the signature.  Equal texts are one class; only class representatives are compared.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import stored

#: Bits of the hash universe of the permutations.  Exactness does not depend on it, verification uses whole shingles; texts
#: of a tenth of its size (400,000 words) that share nothing still agree in one coordinate of 20 only.
BITS = 22
UNIVERSE = 1 << BITS
_word = re.compile(r"[^\W_]+").findall
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@lru_cache(maxsize=1)
def permutation(length: int, seed: int = 7) -> np.ndarray:
    """pi, with its first ``length`` values once more at the end, so that a circular shift is a plain window."""
    pi = np.random.default_rng(seed).permutation(UNIVERSE).astype(np.uint32)
    return np.concatenate([pi, pi[:length]])


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``n`` words (given as 64-bit hashes)."""
    count = len(words) - n + 1
    h = np.zeros(max(count, 0), np.uint64)
    for i in range(n):
        h = (h ^ words[i : i + count]) * _M1
        h ^= h >> np.uint64(29)
    return np.unique(h * _M2)


class Sketcher:
    def __init__(self, n: int, bands: int, rows: int) -> None:
        self.n, self.bands, self.rows, self.cache = n, bands, rows, {}
        self.windows = np.lib.stride_tricks.sliding_window_view(permutation(bands * rows), bands * rows) if bands > 1 else None
        self.mix = (np.random.default_rng(11).integers(1, 1 << 62, rows).astype(np.uint64) << np.uint64(1)) | np.uint64(1)

    def shingles(self, text: str) -> np.ndarray:
        cache, ids = self.cache, []
        for w in _word(text.lower()):
            h = cache.get(w)
            if h is None:
                h = cache[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            ids.append(h)
        if len(cache) > 300_000:
            cache.clear()
        return shingle_hashes(np.array(ids, np.uint64), self.n)

    def band_keys(self, sets: list[np.ndarray]) -> np.ndarray:
        """One 64-bit key for each set and band; every set has at least one shingle."""
        out = np.empty((len(sets), self.bands), np.uint64)
        at = 0
        while at < len(sets):  # about 4,096 shingles at a time
            to, total = at, 0
            while to < len(sets) and (to == at or total + len(sets[to]) <= 4096):
                total += len(sets[to])
                to += 1
            sizes = [len(s) for s in sets[at:to]]
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            # sigma: a bijection of the hashes, of which the leading bits are the place in the universe
            place = (np.concatenate(sets[at:to]) * _M1 >> np.uint64(64 - BITS)).astype(np.int64)
            low = np.minimum.reduceat(self.windows[place], starts, axis=0)
            keys = (low.reshape(to - at, self.bands, self.rows).astype(np.uint64) * self.mix).sum(axis=2)
            out[at:to] = (keys ^ (keys >> np.uint64(31))) * _M3 + np.arange(self.bands, dtype=np.uint64) * _M2
            at = to
        return out


def band_keys(texts: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """Of (id, t, and columns that come along): id, those columns, m (number of distinct shingles) and keys, a key for each
    band; texts of fewer than ``n`` words have no row, and no text leaves its task."""
    along = [c for c in texts.columns if c not in ("id", "t")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = Sketcher(n, bands, rows)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = [use.shingles(t) for t in part.column(1).to_pylist()]
                full = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
                if len(full):
                    own = [sets[i] for i in full]
                    kept = part.take(pa.array(full))
                    keys = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * bands), pa.array(use.band_keys(own).reshape(-1).view(np.int64)))
                    yield pa.RecordBatch.from_arrays([kept.column(0), *[kept.column(2 + i) for i in range(len(along))], pa.array(np.array([len(s) for s in own], np.int32)), keys], names=["id", *along, "m", "keys"])

    kinds = dict(texts.dtypes)
    return texts.select("id", "t", *along).mapInArrow(run, ", ".join(["id bigint", *[f"{c} {kinds[c]}" for c in along], "m int, keys array<bigint>"]))


def similarities(pairs: DataFrame, n: int) -> DataFrame:
    """a, b and similarity of pairs (a, b, ta, tb) of texts, over all their distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = Sketcher(n, 1, 1)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                got, last, sa = [], None, None
                for ta, tb in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    sa, last = (sa, last) if ta == last else (use.shingles(ta), ta)
                    sb = use.shingles(tb)
                    both = len(np.intersect1d(sa, sb, assume_unique=True))
                    got.append(both / (len(sa) + len(sb) - both) if both else 0.0)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(got, pa.float64())], names=["class_a", "class_b", "similarity"])

    return pairs.select("a", "b", "ta", "tb").mapInArrow(run, "class_a bigint, class_b bigint, similarity double")


def near_duplicates(df: DataFrame, id_col: str, text_col: str, words: int = 5, threshold: float = 0.8, bands: int = 36, rows: int = 5) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``: members has id and class_id (the least id with the same text) of every row with a text of
    at least ``words`` words; links has class_a < class_b and similarity >= threshold of different classes.

    Words are runs of letters or digits, lower-cased; similarity is Jaccard over distinct runs of ``words`` words.
    With bands x rows signature coordinates a pair of similarity s is a candidate with 1 - (1 - s^rows)^bands; there is
    no cap on buckets, candidates or partners, and large buckets are split by the skew join.  Null ids and null, empty or shorter texts are in neither result;
    repeated rows count once; an empty table gives empty results; other columns are not read.
    """
    enough = r"[\p{L}\p{N}](?:[\p{L}\p{N}]*[^\p{L}\p{N}]+[\p{L}\p{N}]){%d}" % (words - 1)
    texts = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("t")).where(F.col("id").isNotNull() & F.col("t").rlike(enough))
    keyed = texts.select("id", F.xxhash64("t").alias("h1"), F.xxhash64(F.lit(1), "t").alias("h2"), F.length("t").alias("h3"), "t")
    same = ["h1", "h2", "h3"]
    # equal texts meet by their hashes; what is shuffled of a text is its band keys
    reps = band_keys(keyed, words, bands, rows).groupBy(*same).agg(F.min("id").alias("id"), F.first("m").alias("m"), F.first("keys").alias("keys"))
    rows_ = reps.select(F.explode("keys").alias("key"), "id", "m")
    a = rows_.select("key", F.col("id").alias("a"), F.col("m").alias("ma"))
    b = rows_.select("key", F.col("id").alias("b"), F.col("m").alias("mb"))
    alike = (F.col("ma") >= F.col("mb") * threshold) & (F.col("mb") >= F.col("ma") * threshold)  # sizes alone rule out the rest
    pairs = a.join(b, "key").where((F.col("a") < F.col("b")) & alike).select("a", "b").distinct()
    one = texts.groupBy("id").agg(F.min("t").alias("t"))
    both = pairs.join(one.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a").join(one.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b")
    members = keyed.select("id", *same).join(keyed.groupBy(*same).agg(F.min("id").alias("class_id")), same).select("id", "class_id").distinct()
    return members, similarities(both, words).where(F.col("similarity") >= threshold)


def pairs_of_ids(members: DataFrame, links: DataFrame) -> DataFrame:
    """id_a < id_b of all rows in one class or in linked classes (for results that are defined as pairs of ids)."""
    m = stored(members)
    a = m.select(F.col("id").alias("x"), F.col("class_id").alias("class_a"))
    b = m.select(F.col("id").alias("y"), F.col("class_id").alias("class_b"))
    across = links.join(a, "class_a").join(b, "class_b").select("x", "y")
    within = a.join(b.withColumnRenamed("class_b", "class_a"), "class_a").where("x < y").select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).where("id_a <> id_b").distinct()


def groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """id, class_id, group_id (least id reachable over links) and n_links of its class.

    Components by alternating large-star and small-star steps on class links; edges stay distributed, each step is
    written to the shared folder, and it ends when a step changes nothing.
    """
    links = stored(links)
    edges = stored(links.select(F.col("class_b").alias("u"), F.col("class_a").alias("v")))
    before, now = None, ()
    while now != before:
        before = now
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = stored(small)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    root = edges.groupBy("u").agg(F.min("v").alias("group_id"))
    degree = links.select(F.explode(F.array("class_a", "class_b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    return (
        members.join(root.withColumnRenamed("u", "class_id"), "class_id", "left").join(degree, "class_id", "left")
        .select("id", "class_id", F.coalesce("group_id", "class_id").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
