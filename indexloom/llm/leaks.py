"""Problem 8: passages of test items in the training text, by a distributed positional inverted index.

The index is partitioned by documents: a segment of documents holds, for each term, its postings (document, position).
It is made once for all items, however many there are: terms are hashes, and those outside the test items are not stored.  From each window of an item the rarest terms, by
document frequency over the whole corpus, are probed; the lists are intersected after subtracting the term's offset in
the item, so that the hits of one passage share a shift, and the surviving shifts are compared position by position.  All
postings of a document lie in one segment, so nothing but document frequencies and results is shuffled.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import stored

#: Rarest offsets of a window that all must be hit (twice as many are probed for near matches), items looked up at a time; for a near match, different offsets hit and drift in words.
PROBES, ITEM_BLOCK, NEAR, DRIFT = 2, 20_000, 6, 8
#: Documents of a segment, and terms of all items up to which a task is told them (beyond, the index holds every term).
SEGMENT, TERMS = 1_000, 1_000_000
_word = re.compile(r"[^\W_]+").findall
_marks = regex.compile(r"\p{M}+").sub


def words(text: str | None) -> list[str]:
    """Maximal runs of letters or digits after canonical decomposition, removal of combining marks, lower-casing."""
    if not text:
        return []
    return _word((text if text.isascii() else _marks("", unicodedata.normalize("NFD", text))).lower())


def term_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) >> 1


def positional_index(docs: DataFrame, id_col: str, text_col: str, terms: Iterable[str] | None = None) -> DataFrame:
    """A row for each segment: doc_ids; terms (hashes) and the starts of their postings; postings as doc (place in doc_ids)
    and position, sorted by term, document and position; n_docs of each term.  With ``terms`` only those are stored."""
    sent = docs.sparkSession.sparkContext.broadcast(None if terms is None else {w: term_hash(w) for w in terms})  # at most TERMS
    schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("terms", pa.list_(pa.int64())), *((n, pa.list_(pa.int32())) for n in ("starts", "n_docs", "doc", "position"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        made: dict[str, int] = {}

        def coded(text: str) -> list[int]:
            if known is not None:
                return [known.get(w, -1) for w in words(text)]
            if len(made) > 500_000:
                made.clear()
            return [made[w] if w in made else made.setdefault(w, term_hash(w)) for w in words(text)]

        for batch in batches:
            for at in range(0, batch.num_rows, SEGMENT):
                part = batch.slice(at, SEGMENT)
                texts = [coded(t) for t in part.column(1).to_pylist()]
                sizes = np.array([len(c) for c in texts])
                flat = np.array([x for c in texts for x in c], np.int64)
                doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
                pos = (np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
                held = np.flatnonzero(flat >= 0)
                order = held[np.argsort(flat[held], kind="stable")]
                term, doc, pos = flat[order], doc[order], pos[order]
                names, starts = np.unique(term, return_index=True)
                new = np.ones(len(term), np.int32)
                new[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
                n_docs = np.add.reduceat(new, starts) if len(starts) else new[:0]
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                row = [[ids], [names], *([x.astype(np.int32)] for x in (np.append(starts, len(term)), n_docs, doc, pos))]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).where("doc_id IS NOT NULL AND text <> ''")
    return texts.mapInArrow(run, "doc_ids array<bigint>, terms array<bigint>, starts array<int>, n_docs array<int>, doc array<int>, position array<int>")


def probe_offsets(item: list[int], df: dict[int, int], window: int, probes: int = PROBES) -> list[int]:
    """Offsets of an item such that every window of it holds its ``probes`` rarest offsets."""
    place = {o: i for i, o in enumerate(sorted(range(len(item)), key=lambda o: (df.get(item[o], 0), o)))}
    return sorted({o for s in range(len(item) - window + 1) for o in sorted(range(s, s + window), key=place.__getitem__)[:probes]})


class Prober:
    """Looks the items of a block up in segments."""

    def __init__(self, items: list[tuple[int, np.ndarray]], probes: list[tuple[int, int, int]], window: int, near: bool) -> None:
        self.items, self.window, self.near = items, window, near
        self.probes = sorted(probes)  # (term, item, offset)
        self.table = np.array(self.probes, np.int64).reshape(-1, 3)
        self.terms, first = np.unique(self.table[:, 0], return_index=True)
        self.first = np.append(first, len(self.table))

    def look_up(self, seg: dict[str, np.ndarray]) -> list[tuple[int, int, int, int]]:
        """(place of the document, item, longest run, near hits) of the segment's matches."""
        at = np.searchsorted(seg["terms"], self.terms)
        at[at == len(seg["terms"])] = 0
        hit = np.flatnonzero(seg["terms"][at] == self.terms) if len(seg["terms"]) else []
        docs, shifts, which = [], [], []
        for i in hit:
            a, b = seg["starts"][at[i]], seg["starts"][at[i] + 1]
            p = np.arange(self.first[i], self.first[i + 1])
            docs.append(np.tile(seg["doc"][a:b], len(p)))
            shifts.append((seg["position"][a:b][None, :] - self.table[p, 2][:, None]).reshape(-1))
            which.append(np.repeat(p, b - a))
        if not docs:
            return []
        doc, shift, p = np.concatenate(docs).astype(np.int64), np.concatenate(shifts).astype(np.int64), np.concatenate(which)
        pair = doc * len(self.items) + self.table[p, 1]
        best: dict[int, list[int]] = {}
        order = np.lexsort((shift, pair))
        pair, shift, offset = pair[order], shift[order], self.table[p, 2][order]
        new = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (shift[1:] != shift[:-1])))
        # an exact passage holds a whole window, and with it all offsets that are probed there
        many = np.flatnonzero(np.diff(np.append(new, len(pair))) >= (2 * PROBES if self.near else PROBES))
        forward = Forward(seg)
        for k in new[many]:
            key, of = int(pair[k]), self.items[int(pair[k]) % len(self.items)][1]
            run = forward.run(key // len(self.items), of, int(shift[k]), self.window)
            if run:
                best.setdefault(key, [0, 0])[0] = max(run, best.get(key, [0])[0])
        if self.near and len(pair) >= NEAR:
            # only where so many hits lie within the drift can so many offsets
            close = (pair[NEAR - 1 :] == pair[: 1 - NEAR]) & (shift[NEAR - 1 :] - shift[: 1 - NEAR] <= DRIFT)
            asked = np.unique(pair[: 1 - NEAR][close])
            for a, b in zip(np.searchsorted(pair, asked), np.searchsorted(pair, asked, "right"), strict=True):
                if (n := _near(shift[a:b], offset[a:b])) >= NEAR:
                    best.setdefault(int(pair[a]), [0, 0])[1] = n
        return [(k // len(self.items), k % len(self.items), run, n) for k, (run, n) in sorted(best.items())]


class Forward:
    """The terms of a segment's documents by position (-1: not a term of the items), made from the postings on demand."""

    def __init__(self, seg: dict[str, np.ndarray]) -> None:
        term = np.repeat(seg["terms"], np.diff(seg["starts"]))
        order = np.argsort(seg["doc"], kind="stable")
        self.term, self.pos = term[order], seg["position"][order]
        self.start = np.searchsorted(seg["doc"][order], np.arange(len(seg["doc_ids"]) + 1))
        self.made: dict[int, np.ndarray] = {}

    def run(self, doc: int, item: np.ndarray, shift: int, least: int) -> int:
        """Longest run of equal terms of the document and the item at this shift, if at least ``least``, else 0."""
        if doc not in self.made:
            a, b = self.start[doc], self.start[doc + 1]
            row = np.full(int(self.pos[a:b].max()) + 1, -1, np.int64)
            row[self.pos[a:b]] = self.term[a:b]
            self.made[doc] = row
        row = self.made[doc]
        low, high = max(0, -shift), min(len(item), len(row) - shift)
        if high - low < least:
            return 0
        same = row[low + shift : high + shift] == item[low:high]
        breaks = np.flatnonzero(~np.concatenate([[False], same, [False]]))
        longest = int(np.diff(breaks).max()) - 1
        return longest if longest >= least else 0


def _near(shift: np.ndarray, offset: np.ndarray, drift: int = DRIFT) -> int:
    """Most different offsets whose shifts (sorted) differ by at most ``drift``."""
    best, low, held = 0, 0, {}
    for s, o in zip(shift.tolist(), offset.tolist(), strict=True):
        held[o] = held.get(o, 0) + 1
        while s - shift[low] > drift:
            gone = int(offset[low])
            held[gone] -= 1
            if not held[gone]:
                del held[gone]
            low += 1
        best = max(best, len(held))
    return best


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 25, near: bool = True) -> DataFrame:
    """doc_id, item_id, longest_run, near_hits, item_words and kind of each document that holds a passage of an item.

    kind 'exact': at least ``window`` consecutive words of the item in order and without gaps; 'proximity' (only with
    ``near``): no such run, but NEAR different rare offsets of the item with shifts that differ by at most DRIFT words.
    Items are looked up in blocks of about ITEM_BLOCK, against all documents.  Null ids and texts, empty texts and items
    of fewer words than ``window`` match nothing; repeated rows count once; an empty table gives an empty result; other
    columns are not read.
    """
    wanted = items.select(items[item_id].cast("long").alias("item_id"), items[item_text].alias("item_text")).where("item_id IS NOT NULL AND item_text IS NOT NULL").distinct()
    blocks = max(1, -(-wanted.count() // ITEM_BLOCK))
    told = _item_terms(wanted)
    index = stored(positional_index(docs, doc_id, doc_text, told))
    counts = index.select(F.explode(F.arrays_zip("terms", "n_docs")).alias("x")).groupBy("x.terms").agg(F.sum("x.n_docs").alias("n"))
    counts = stored(counts) if blocks > 1 else counts
    found = None
    for b in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()  # about ITEM_BLOCK rows
        part = _block(index, counts, [(r.item_id, words(r.item_text)) for r in sorted(rows)], window, near)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("longest_run", "near_hits", "item_words")], F.min("kind").alias("kind"))


def _item_terms(wanted: DataFrame) -> list[str] | None:
    """The different terms of all items, or None where there are more than TERMS of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(sorted({w for t in batch.column(1).to_pylist() for w in words(t)}), pa.string())], names=["term"])

    terms = [r.term for r in wanted.mapInArrow(run, "term string").distinct().limit(TERMS + 1).toLocalIterator()]
    return sorted(terms) if len(terms) <= TERMS else None


def _block(index: DataFrame, counts: DataFrame, items: list[tuple[int, list[str]]], window: int, near: bool) -> DataFrame:
    spark = index.sparkSession
    coded = [(k, [term_hash(x) for x in w]) for k, w in items if len(w) >= window]
    asked = sorted({x for _, w in coded for x in w})
    df = {r.terms: r.n for r in counts.join(spark.createDataFrame([(x,) for x in asked], "terms bigint"), "terms", "left_semi").collect()}  # a row for each term of the block
    probes = [(w[o], n, o) for n, (_, w) in enumerate(coded) for o in probe_offsets(w, df, window, 2 * PROBES if near else PROBES)]
    sent = spark.sparkContext.broadcast(([(k, np.array(w, np.int64)) for k, w in coded], probes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, p = sent.value
        use = Prober(known, p, window, near)
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for r in range(batch.num_rows):
                seg = {n: batch.column(i)[r].values.to_numpy() for i, n in enumerate(batch.schema.names)}
                for doc, item, longest, hits in use.look_up(seg):
                    for to, v in zip(out, (int(seg["doc_ids"][doc]), known[item][0], longest, hits, len(known[item][1]), "exact" if longest else "proximity"), strict=True):
                        to.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], names=["doc_id", "item_id", "longest_run", "near_hits", "item_words", "kind"])

    columns = ["doc_ids", "terms", "starts", "doc", "position"]
    return index.select(*columns).mapInArrow(run, "doc_id bigint, item_id bigint, longest_run int, near_hits int, item_words int, kind string")
