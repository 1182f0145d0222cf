"""Problem 9: subject areas of documents, by truncated SVD and refined seed centroids.

Terms (words, pairs of Chinese characters) are weighted by inverse document frequency; a truncated singular value
decomposition of all documents gives the term vectors.  A sentence is the sum of its terms' vectors.  Seed
centroids come from hand labels, one for each subject and language and one for each language's general wording, and are
refined by assigning all sentences to the nearest and averaging anew.  A document has a subject when enough of
its sentences are nearest to it.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import stored

#: Least number and greatest share of documents with a term, most terms, dimensions, and terms that a task counts before it passes them on.
LEAST, COMMON, TERMS, DIMENSIONS, HELD = 4, 0.5, 9_000, 160, 1_000_000
#: Rounds of refinement, least similarity of a sentence to its centroid, known terms it must have, and sentences a document needs.
ROUNDS, SIMILAR, KNOWN, SENTENCES = 8, 0.35, 3, 3
#: For the seeds: documents' worth of prior in a term's counts, and information from which a term tells of a subject.
SMOOTH, TELLING = 2.0, 0.9
_term = re.compile(r"[一-鿿]+|[^\W\d_]+(?:['’][^\W\d_]+)?")
_pairs = re.compile("[一-\U0010ffff]").search
_end = re.compile(r"([.!?…。！？\n])(?:(?<=[。！？])\s*|(?<=\n)\n*|(?<=[.!?…])\s+(?=[^\W\d_a-zа-я]|[§«“\"(„]))").sub  # the sign comes first, so that it is searched for


def terms(sentence: str) -> list[str]:
    out: list[str] = []
    low = sentence.lower()
    found = _term.findall(low)
    if low.isascii() or not _pairs(low):
        return found
    for t in found:
        if t[0] >= "一":
            out += [t[i : i + 2] for i in range(len(t) - 1)]
        else:
            out.append(t)
    return out


class Parts(dict):
    """What ``make`` makes of the terms of what stands between two blanks, kept: no term spans a blank."""

    def __init__(self, make: Callable[[list[str]], tuple]) -> None:
        self.make = make

    def __missing__(self, part: str) -> tuple:
        if len(self) >= 300_000:
            self.clear()
        made = self[part] = self.make(terms(part))
        return made


def sentences(text: str) -> list[str]:
    """The sentences of a text; lines that end without a full stop or the like (headings) are none."""
    text = text if text.isascii() else unicodedata.normalize("NFC", text)
    return [s for x in _end("\\1\n", text).split("\n") if x and (s := x.strip()) and s[-1] in ".!?…。！？»”\")"]


class Model:
    """Vectors of the terms, centroids and the subject of each (None: general wording)."""

    def __init__(self, index: dict[str, int], vectors: np.ndarray, centroids: np.ndarray, subjects: list[str | None]) -> None:
        self.index, self.vectors, self.centroids, self.subjects = index, vectors, centroids, subjects

    def embed(self, sents: list[str]) -> np.ndarray:
        """Unit vectors of sentences (zero where fewer than KNOWN terms are known)."""
        get = self.index.get
        ids = [[i for t in terms(s) if (i := get(t)) is not None] for s in sents]
        return _unit(_sums(self.vectors, [i if len(i) >= KNOWN else [] for i in ids]))

    def assign(self, sents: list[str]) -> list[str | None]:
        """Subject of each sentence, None for general wording and what is like nothing."""
        if not sents:
            return []
        sims = self.embed(sents) @ self.centroids.T
        best = sims.argmax(1)
        return [self.subjects[b] if s >= SIMILAR else None for b, s in zip(best.tolist(), sims[np.arange(len(best)), best].tolist(), strict=True)]


def _sums(vectors: np.ndarray, ids: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(ids), vectors.shape[1]), np.float32)
    sizes = np.array([len(i) for i in ids])
    full = np.flatnonzero(sizes)
    at = 0
    while at < len(full):  # about 20,000 terms at a time
        to, total = at, 0
        while to < len(full) and (to == at or total + sizes[full[to]] <= 20_000):
            total += sizes[full[to]]
            to += 1
        part = full[at:to]
        flat = np.fromiter(chain.from_iterable(ids[i] for i in part), np.int64)
        n = sizes[part]
        out[part] = np.add.reduceat(vectors[flat], np.cumsum(n) - n, axis=0)
        at = to
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def truncated_svd(a: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Right singular vectors (columns x k) by random projection with two power steps."""
    return _svd(lambda q: a.T @ (a @ q), a.shape[1], min(k, *a.shape), seed)


def _svd(gram: Callable[[np.ndarray], np.ndarray], columns: int, k: int, seed: int = 1) -> np.ndarray:
    """As ``truncated_svd``, of a matrix of which only the product of its Gram matrix with others is asked."""
    q = np.random.default_rng(seed).standard_normal((columns, min(k + 10, columns)), np.float32)
    for _ in range(2):
        q, _ = np.linalg.qr(gram(q))
    z = gram(q).astype(np.float64)
    value, vector = np.linalg.eigh(q.T.astype(np.float64) @ z)
    keep = value > 1e-9 * max(value[-1], 1e-30)
    return np.linalg.svd((vector[:, keep] / np.sqrt(value[keep])).T @ z.T, full_matrices=False)[2][:k].T.astype(np.float32)


class Block:
    """Some documents: the labels of each, the numbers of their known terms by sentence, and document and language of each
    sentence (0 where no word tells it); once the terms have vectors, the length of each sentence's sum."""

    def __init__(self, labels: list[list[str]], ids: list[bytes], sizes: list[bytes], lang: list[bytes], norms: list[bytes] = ()) -> None:
        self.labels = labels
        self.norms = np.frombuffer(b"".join(norms), np.float32)
        self.ids = np.frombuffer(b"".join(ids), np.uint16).astype(np.int64)
        self.sizes = np.frombuffer(b"".join(sizes), np.int32).astype(np.int64)
        self.lang = np.frombuffer(b"".join(lang), np.uint8).astype(np.int64)
        self.doc = np.repeat(np.arange(len(labels)), [len(x) for x in lang])

    def longer(self, least: int = 2, more: np.ndarray | bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(terms, where each sentence starts, language, document, length) of the sentences of ``least`` known terms or more."""
        keep = (self.sizes >= least) & more
        sizes = self.sizes[keep]
        return self.ids[np.repeat(keep, self.sizes)], np.cumsum(sizes) - sizes, self.lang[keep], self.doc[keep], self.norms[keep] if len(self.norms) else np.zeros(0)

    def held(self, codes: dict[str, int]) -> np.ndarray:
        """Which subjects each document is labelled with."""
        out = np.zeros((len(self.labels), len(codes)), bool)
        for i, labels in enumerate(self.labels):
            out[i, [codes[s] for s in labels]] = True
        return out


def _lengths(vectors: np.ndarray, block: Block) -> np.ndarray:
    """Length of the sum of each sentence's terms."""
    out = np.zeros(len(block.sizes), np.float32)
    full = np.flatnonzero(block.sizes)
    ends = np.cumsum(block.sizes[full])
    starts = ends - block.sizes[full]
    at = 0
    while at < len(full):  # about 3,000 terms at a time, which stay in a core's cache
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + 3_000)))
        x = np.add.reduceat(vectors[block.ids[starts[at] : ends[to - 1]]], starts[at:to] - starts[at], axis=0)
        out[full[at:to]] = np.sqrt(np.einsum("ij,ij->i", x, x))
        at = to
    return out


def _by_key(vectors: np.ndarray, ids: np.ndarray, starts: np.ndarray, norms: np.ndarray, which: np.ndarray, key: np.ndarray, keys: int) -> list[np.ndarray]:
    """[sums of the unit vectors of the sentences ``which`` by key, their number]: terms are counted first, so that no
    sentence's vector is made."""
    sizes = np.diff(np.append(starts, len(ids)))
    own = np.repeat(which, sizes)
    weight = np.repeat(1 / np.maximum(norms[which], 1e-9), sizes[which])
    counts = np.bincount(np.repeat(key[which], sizes[which]) * len(vectors) + ids[own], weight, keys * len(vectors)).reshape(keys, -1)
    return [(counts.astype(np.float32) @ vectors).astype(float), np.bincount(key[which], minlength=keys).astype(float)]


def _gram_pass(block: Block, arg: tuple) -> list[np.ndarray]:
    """Product of the Gram matrix of the weighted documents with ``q``."""
    q, idf = arg
    out = np.zeros(q.shape, np.float32)
    # documents of a language come together, so that few terms are held by some of a group
    lang = np.bincount(block.doc * 256 + block.lang, np.maximum(block.sizes, 0), len(block.labels) * 256).reshape(-1, 256).argmax(1)
    place = np.argsort(np.argsort(lang, kind="stable"), kind="stable")
    both = np.repeat(place[block.doc], block.sizes) * len(idf) + block.ids
    pairs, times = np.unique(both, return_counts=True)
    doc, term = pairs // len(idf), pairs % len(idf)
    value = (1 + np.log(times)) * idf[term]
    value /= np.sqrt(np.bincount(doc, value * value, len(block.labels)))[doc]
    for at in range(0, len(block.labels), 128):
        low, high = np.searchsorted(doc, (at, at + 128))
        some, column = np.unique(term[low:high], return_inverse=True)
        a = np.zeros((min(128, len(block.labels) - at), len(some)), np.float32)
        a[doc[low:high] - at, column] = value[low:high]
        out[some] += a.T @ (a @ q[some])
    return [out]


def _label_pass(block: Block, arg: tuple) -> list[np.ndarray]:
    """Of labelled documents: [terms by subject, terms by language, languages by subject], a document's labels sharing it."""
    codes, n, langs = arg
    held = block.held(codes)
    share = held / np.maximum(held.sum(1, keepdims=True), 1)
    ids, starts, lang, doc, _ = block.longer()
    own = held.any(1)
    spoken = np.unique(doc * langs + lang)
    spoken = spoken[own[spoken // langs]]
    term = np.unique(np.repeat(doc * langs + lang, np.diff(np.append(starts, len(ids)))) * n + ids)
    term = term[own[term // n // langs]]
    counts = np.stack([np.bincount(term % n, share[term // n // langs, j], n) for j in range(len(codes))], axis=1)
    by_lang = np.bincount(term % n * langs + term // n % langs, minlength=n * langs).reshape(n, langs).astype(float)
    return [counts, by_lang, np.stack([np.bincount(spoken % langs, share[spoken // langs, j], langs) for j in range(len(codes))], axis=1)]


def _seed_pass(block: Block, arg: tuple) -> list[np.ndarray]:
    """Sums of the sentences to start from, by subject (the last: general wording) and language.

    A sentence of a labelled document whose terms tell most of a label of it seeds that subject; one with hardly a
    telling term seeds the general wording of its language."""
    vectors, tells, codes, langs = arg
    ids, starts, lang, doc, norms = block.longer()
    if not len(starts):
        return [np.zeros(((len(codes) + 1) * langs, vectors.shape[1])), np.zeros((len(codes) + 1) * langs)]
    strong = np.add.reduceat((tells > TELLING).astype(np.int32)[ids], starts, axis=0)
    j = np.add.reduceat(np.maximum(tells, 0)[ids], starts, axis=0).argmax(1)
    seed = (strong[np.arange(len(j)), j] >= 2) & block.held(codes)[doc, j]
    use = seed | ~strong.any(1)
    return _by_key(vectors, ids, starts, norms, use, np.where(seed, j, len(codes)) * langs + lang, (len(codes) + 1) * langs)


def _round_pass(block: Block, arg: tuple) -> list[np.ndarray]:
    """Sums of the sentences nearest to each centroid that hold a term that tells of its subject.

    A sentence is compared with the centroids of its language, one of no known language with all."""
    vectors, bits, codes, products, subject, spoken, free = arg
    total = [np.zeros((len(subject), vectors.shape[1])), np.zeros(len(subject))]
    held = block.held(codes)
    ok = np.append(held | ~held.any(1, keepdims=True), np.ones((len(held), 1), bool), axis=1)
    parts = []
    for k in np.unique(block.lang).tolist():
        own = np.flatnonzero(spoken == k) if k else np.arange(len(subject))
        ids, starts, _, doc, norms = block.longer(2, block.lang == k)
        if not len(own) or not len(starts):
            continue
        sims = np.stack([np.add.reduceat(products[c][ids], starts) for c in own], axis=1) / np.maximum(norms, 1e-9)[:, None]
        if not free:  # sentences of labelled documents go to their labels or to general wording
            sims[~ok[doc][:, subject[own]]] = -1.0
        best, top = own[sims.argmax(1)], sims.max(1)
        of = subject[best]
        holds = np.array([np.bitwise_or.reduceat(b[ids], starts) for b in bits])  # 62 subjects in each row, general wording among them
        parts.append((ids, np.diff(np.append(starts, len(ids))), norms, (top > 0.15) & (holds[of // 62, np.arange(len(of))] >> of % 62 & 1).astype(bool), best))
    if parts:
        ids, sizes, norms, own, best = (np.concatenate(x) for x in zip(*parts, strict=True))
        total = _by_key(vectors, ids, np.cumsum(sizes) - sizes, norms, own, best, len(subject))
    return total


def _products(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Of each centroid with all terms."""
    return np.ascontiguousarray((vectors @ centroids.T).T)


def _learned(run: Callable[[Callable, tuple], list[np.ndarray]], measure: Callable[[np.ndarray], None], vocab: list[str], df: dict[str, int], n_docs: int, codes: dict[str, int], langs: int) -> Model:
    """The model, of sums over all documents: ``run`` applies a pass to all blocks and adds up what it returns; ``measure``
    gives them the lengths of their sentences."""
    idf = np.log(n_docs / np.array([df[t] for t in vocab])).astype(np.float32)
    vectors = _svd(lambda q: run(_gram_pass, (q, idf))[0], len(vocab), min(DIMENSIONS, n_docs, len(vocab))) * idf[:, None]
    measure(vectors)
    index = {t: i for i, t in enumerate(vocab)}
    none = Model(index, vectors, np.zeros((1, vectors.shape[1]), np.float32), [None])
    if not codes:
        return none
    # how much a term tells of a subject is its smoothed pointwise information over the labelled documents
    counts, by_lang, prior = run(_label_pass, (codes, len(vocab), langs))
    prior = prior + 1e-3  # a language's documents may favour a subject
    prior /= prior.sum(1, keepdims=True)
    expected = by_lang @ prior / np.maximum(by_lang.sum(1, keepdims=True), 1e-9) + 1e-6
    tells = np.log((counts + SMOOTH * expected) / (counts.sum(1, keepdims=True) + SMOOTH) / expected).astype(np.float32)
    sums, n = run(_seed_pass, (vectors, tells, codes, langs))
    keys = [k for k in range(len(n)) if k % langs and n[k] >= 2]
    if not keys:
        return none
    names, subject, spoken = list(codes), np.array([k // langs for k in keys]), np.array([k % langs for k in keys])
    bits = np.zeros((len(codes) // 62 + 1, len(vocab)), np.int64)  # what each term tells of; general wording needs no such term
    for j in range(len(codes) + 1):
        bits[j // 62] |= (tells[:, j] > TELLING if j < len(codes) else np.ones(len(vocab), bool)).astype(np.int64) << j % 62
    c = _unit(sums[keys] / n[keys][:, None]).astype(np.float32)
    for r in range(ROUNDS):  # labels may be wrong: at last all are free
        sums, n = run(_round_pass, (vectors, bits, codes, _products(vectors, c), subject, spoken, r >= ROUNDS // 2))
        c = _unit(np.where(n[:, None] >= 2, sums / np.maximum(n, 1)[:, None], c)).astype(np.float32)
    return Model(index, vectors, c, [names[s] if s < len(names) else None for s in subject])


def _word_langs(spoken: dict[str, set[str]]) -> tuple[dict[str, int], int]:
    """(language number of words of one language only, number of languages with none)."""
    number = {k: i + 1 for i, k in enumerate(sorted({k for v in spoken.values() for k in v}))}
    return {t: number[next(iter(v))] for t, v in spoken.items() if len(v) == 1}, len(number) + 1


def _vocabulary(df: dict[str, int], n_docs: int) -> list[str]:
    return sorted((t for t, n in df.items() if LEAST <= n <= COMMON * n_docs + LEAST), key=lambda t: (-df[t], t))[:TERMS]


def _places(index: dict[str, int], word_lang: dict[str, int]) -> dict[str, int]:
    """Of each word its number + 1 (0: none) and, in the last byte, the number of its language."""
    return {t: (index.get(t, -1) + 1) << 8 | word_lang.get(t, 0) for t in {*index, *word_lang}}


def _held(text: str, get: Callable[[str], tuple[str, ...]]) -> set[str]:
    """The different terms of a text."""
    return set(chain.from_iterable(map(get, {p for s in sentences(text) for p in s.lower().split()})))


def _numbering(places: dict[str, int]) -> Parts:
    return Parts(lambda found: tuple(filter(None, map(places.get, found))))


def _numbered(texts: list[str], numbers: Parts) -> list[list[bytes]]:
    """[numbers of the known terms, how many each sentence has, its language], each by text."""
    out: list[list[bytes]] = [[], [], []]
    for at in range(0, len(texts), 256):
        found: list[int] = []
        ends, counts, get = [0], [0], numbers.__getitem__
        for t in texts[at : at + 256]:
            for s in sentences(t):
                found.extend(chain.from_iterable(map(get, s.lower().split())))
                ends.append(len(found))
            counts.append(len(ends) - 1)
        n = len(ends) - 1
        both = np.array(found, np.int64)
        of = np.repeat(np.arange(n), np.diff(ends))
        known, lang = both >> 8 > 0, both & 255
        width = int(lang.max(initial=0)) + 1
        spoken = np.bincount(of * width + lang, minlength=n * width).reshape(n, width)
        spoken[:, 0] = 0  # among equals the first language
        sizes = np.bincount(of[known], minlength=n).astype(np.int32)
        of_text = np.append(0, np.cumsum(sizes))[counts].tolist()
        for j, (x, where) in enumerate(((((both[known] >> 8) - 1).astype(np.uint16), of_text), (sizes, counts), (spoken.argmax(1).astype(np.uint8), counts))):
            out[j] += [x[a:b].tobytes() for a, b in zip(where, where[1:])]
    return out


def fit(docs: list[tuple[str, frozenset[str]]], lines: list[tuple[str, str]]) -> Model:
    """The model of (text, subjects labelled, none if unlabelled) documents and (language, line) samples."""
    spoken: dict[str, set[str]] = defaultdict(set)
    for lang, line in lines:
        for t in terms(line):
            spoken[t].add(lang)
    word_lang, langs = _word_langs(spoken)
    get = Parts(tuple).__getitem__
    df = Counter(t for text, _ in docs for t in _held(text, get))
    vocab = _vocabulary(df, len(docs))
    if not vocab or len(docs) < 2:
        return Model({}, np.zeros((1, 1), np.float32), np.zeros((1, 1), np.float32), [None])
    index = {t: i for i, t in enumerate(vocab)}
    block = Block([sorted(x) for _, x in docs], *_numbered([text for text, _ in docs], _numbering(_places(index, word_lang))))

    def measure(vectors: np.ndarray) -> None:
        block.norms = _lengths(vectors, block)

    codes = {s: j for j, s in enumerate(sorted({s for _, x in docs for s in x}))}
    return _learned(lambda f, arg: f(block, arg), measure, vocab, df, len(docs), codes, langs)


def fitted(docs: DataFrame, labels: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text", code_col: str = "subject_code") -> Model:
    return learned(docs, labels, samples, id_col, text_col, code_col)[0]


def learned(docs: DataFrame, labels: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text", code_col: str = "subject_code") -> tuple[Model, DataFrame | None]:
    """As ``fit``, and the documents as terms' numbers (None where there is no term).  Of all documents, all labels and all lines; documents frequencies, decomposition, seeds and rounds are
    sums over all documents, which Spark makes from their terms' numbers, stored once."""
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    marks = labels.select(labels[id_col].cast("long").alias("id"), F.lower(F.trim(code_col)).alias("code")).where("id IS NOT NULL AND code <> ''")
    marks = marks.groupBy("id").agg(F.sort_array(F.collect_set("code")).alias("codes"))
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("t")).where("t <> ''")
    lines = samples.select(F.lower(F.trim("lang")).alias("k"), F.col("text").cast("string").alias("t")).where("k <> '' AND t <> ''")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list({(k, w) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for w in terms(t)})
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.string()) for i in range(2)], names=["k", "w"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([*seen, None], pa.string()), pa.array([*seen.values(), n], pa.int64())], names=["w", "n"])

        seen, n = Counter(), 0
        get = Parts(tuple).__getitem__
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(_held(t, get))
                n += 1
                if len(seen) > HELD:
                    yield out()
                    seen, n = Counter(), 0
        yield out()

    spoken = lines.mapInArrow(words, "k string, w string").groupBy("w").agg(F.collect_set("k").alias("k"))
    word_lang, langs = _word_langs({r.w: set(r.k) for r in spoken.collect()})
    totals = stored(texts.select("t").mapInArrow(counted, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n")))
    n_docs = next((r.n for r in totals.where("w IS NULL").collect()), 0) or 0
    most = totals.where(F.col("w").isNotNull() & (F.col("n") >= LEAST) & (F.col("n") <= COMMON * n_docs + LEAST)).orderBy(F.desc("n"), "w").limit(TERMS)
    df = {r.w: r.n for r in most.collect()}
    vocab = _vocabulary(df, n_docs)
    if not vocab or n_docs < 2:
        return Model({}, np.zeros((1, 1), np.float32), np.zeros((1, 1), np.float32), [None]), None
    sent = send(_places({t: i for i, t in enumerate(vocab)}, word_lang))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _numbering(sent.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.binary()) for x in _numbered(batch.column(1).to_pylist(), numbers))], names=["id", "ids", "sizes", "langs"])

    # the numbers are shuffled for the labels, not the texts
    rows = texts.mapInArrow(numbered, "id bigint, ids binary, sizes binary, langs binary").join(marks, "id", "left").select(F.coalesce("codes", F.array().cast("array<string>")).alias("labels"), "ids", "sizes", "langs", "id")
    rows = stored(rows)
    codes = {r.c: j for j, r in enumerate(rows.select(F.explode("labels").alias("c")).distinct().orderBy("c").collect())}

    def measure(vectors: np.ndarray) -> None:
        nonlocal rows
        told = send(vectors)

        def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                block = Block(*(c.to_pylist() for c in batch.columns[:4]))
                each = np.split(_lengths(told.value, block), np.cumsum(np.bincount(block.doc, minlength=batch.num_rows))[:-1])
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([x.tobytes() for x in each], pa.binary()), batch.column(4)], names=["labels", "ids", "sizes", "langs", "norms", "id"])

        rows = stored(rows.mapInArrow(lengths, "labels array<string>, ids binary, sizes binary, langs binary, norms binary, id bigint"))

    def run(f: Callable, arg: tuple) -> list[np.ndarray]:
        told = send(arg)

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: list[np.ndarray] = []
            for batch in batches:
                for at in range(0, batch.num_rows, 4_096):
                    new = f(Block(*(c.to_pylist() for c in batch.slice(at, 4_096).columns)), told.value)
                    total = [a + b for a, b in zip(total, new, strict=True)] if total else new
            if total:
                yield pa.RecordBatch.from_arrays([pa.array([[x.tobytes() for x in total]], pa.list_(pa.binary())), pa.array([[f"{x.dtype.str}:" + ",".join(map(str, x.shape)) for x in total]], pa.list_(pa.string()))], names=["sums", "shapes"])

        def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, shapes = [], []
            for batch in batches:
                for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    new, shapes = [np.frombuffer(v, k.split(":")[0]) for v, k in zip(x, y, strict=True)], y
                    total = [a + b for a, b in zip(total, new, strict=True)] if total else new
            if total:
                yield pa.RecordBatch.from_arrays([pa.array([[x.tobytes() for x in total]], pa.list_(pa.binary())), pa.array([shapes], pa.list_(pa.string()))], names=["sums", "shapes"])

        schema = "sums array<binary>, shapes array<string>"
        got = rows.drop("id").mapInArrow(summed, schema).repartition(1).mapInArrow(together, schema).first()  # the driver gets one sum
        told.unpersist()
        return [np.frombuffer(x, k.split(":")[0]).reshape([int(n) for n in k.split(":")[1].split(",")]) for x, k in zip(got.sums, got.shapes, strict=True)]

    model = _learned(run, measure, vocab, df, n_docs, codes, langs)
    return model, rows


def subjects(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", least: int = SENTENCES) -> DataFrame:
    """id, subject_code and n_sentences of each subject that ``least`` sentences of a document deal with.

    Null, empty and short texts have no row; whole texts are read; repeated rows count once; an empty table gives an
    empty result; other columns are not read; nothing but the results is shuffled."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    texts = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text")).where("text <> ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                split = [sentences(t) for t in part.column(1).to_pylist()]
                got = iter(use.assign([s for d in split for s in d]))
                ids, codes, counts = [], [], []
                for i, d in zip(part.column(0).to_pylist(), split, strict=True):
                    for code, n in sorted(Counter(c for _ in d if (c := next(got)) is not None).items()):
                        if n >= least:
                            ids.append(i)
                            codes.append(code)
                            counts.append(n)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(codes, pa.string()), pa.array(counts, pa.int32())], names=["id", "subject_code", "n_sentences"])

    return texts.mapInArrow(run, "id bigint, subject_code string, n_sentences int").distinct()


def of_learned(model: Model, rows: DataFrame, least: int = SENTENCES) -> DataFrame:
    """As ``subjects``, of the documents that ``learned`` gives."""
    codes = sorted({c for c in model.subjects if c is not None})
    sent = rows.sparkSession.sparkContext.broadcast((_products(model.vectors, model.centroids), np.array([len(codes) if c is None else codes.index(c) for c in model.subjects])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            products, code = sent.value
            block = Block([[]] * batch.num_rows, *(batch.column(i).to_pylist() for i in range(1, 5)))
            ids, starts, _, doc, norms = block.longer(KNOWN)
            top, best = np.full(len(starts), -np.inf, np.float32), np.zeros(len(starts), np.int64)
            for c in range(len(products) if len(starts) else 0):
                sims = np.add.reduceat(products[c][ids], starts)
                more = sims > top
                top[more], best[more] = sims[more], c
            own = top >= SIMILAR * np.maximum(norms, 1e-9)
            counts = np.bincount(doc[own] * (len(codes) + 1) + code[best[own]], minlength=batch.num_rows * (len(codes) + 1)).reshape(batch.num_rows, -1)
            d, k = np.nonzero(counts[:, : len(codes)] >= least)
            yield pa.RecordBatch.from_arrays([batch.column(5).take(pa.array(d)), pa.array([codes[i] for i in k.tolist()], pa.string()), pa.array(counts[d, k].astype(np.int32))], names=["id", "subject_code", "n_sentences"])

    return rows.mapInArrow(run, "id bigint, subject_code string, n_sentences int").distinct()
