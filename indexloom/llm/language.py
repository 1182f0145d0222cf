"""Problem 4: language of documents and of the lines of mixed texts, by a linear-chain conditional random field.

Each word of a text is a node.  Its emission comes from hashed affix, character n-gram and lexicon features; transitions
are learned apart for neighbours in one line and across a line break.  Labels are the forward-backward marginals,
weighed by letters over a line or a document; the winner's share is the confidence.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import bounded_sample

#: Feature space, labelled lines used for training (bound of the sample), synthetic sequences, training steps, L2.
FEATURES, SAMPLE_LINES, SEQUENCES, STEPS, L2 = 1 << 15, 4_000, 500, 60, 2e-4
#: Share of a line that its own language must hold, and letters it needs, for the line to prove that a text is mixed; and
#: the least logarithm of its odds against the language of most of the text, which grows with the lines that were tried.
PROOF_SHARE, PROOF_LETTERS, PROOF_MARGIN = 0.8, 12, 3.0
_letters = re.compile(r"[^\W\d_]+").findall
#: Other codes and names of the languages.
CODES = {
    "eng": "en", "spa": "es", "fra": "fr", "fre": "fr", "deu": "de", "ger": "de", "por": "pt", "ita": "it", "nld": "nl", "dut": "nl",
    "pol": "pl", "rus": "ru", "zho": "zh", "chi": "zh", "cmn": "zh", "english": "en", "spanish": "es", "french": "fr", "german": "de",
    "portuguese": "pt", "italian": "it", "dutch": "nl", "polish": "pl", "russian": "ru", "chinese": "zh",
}


def _script(c: str) -> str:
    o = ord(c)
    if o < 0x250 or 0x1E00 <= o < 0x1F00:
        return "l"
    if 0x400 <= o < 0x530:
        return "c"
    return "h" if 0x4E00 <= o < 0xA000 or 0x3400 <= o < 0x4DC0 or 0x20000 <= o < 0x30000 else "o"


def features(word: str) -> list[int]:
    """Hashed features of a lower-cased word: itself, affixes, n-grams, script."""
    script = _script(word[0])
    names = ["s" + script]
    if script == "h":
        names += ["g" + c for c in sorted(set(word))]
    else:
        w = f"<{word}>"
        names += ["w" + word, *("p" + word[:n] for n in (1, 2, 3, 4)), *("e" + word[-n:] for n in (1, 2, 3, 4))]
        names += {"g" + w[i : i + n] for n in (2, 3) for i in range(len(w) - n + 1)}
        names += {"d" + c for c in word if ord(c) > 127}
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % FEATURES for x in names]


class Model:
    """Weights: features x languages, transitions in a line and across a break, and the start."""

    def __init__(self, langs: list[str]) -> None:
        n = len(langs)
        self.langs, self.w = langs, np.zeros((FEATURES, n), np.float32)
        self.inside, self.across, self.start = np.zeros((n, n), np.float32), np.zeros((n, n), np.float32), np.zeros(n, np.float32)

    def emission(self, word: str) -> np.ndarray:
        f = features(word)
        return self.w[f].sum(0) / np.sqrt(len(f))


def _chain(emit: np.ndarray, brk: np.ndarray, mask: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Scaled forward and backward messages of T x B chains; emit is T x B x L, already exponentiated."""
    t_max, _, _ = emit.shape
    a_in, a_br = np.exp(m.inside), np.exp(m.across)
    alpha, beta = np.empty_like(emit), np.ones_like(emit)
    x = np.exp(m.start) * emit[0]
    alpha[0] = x / x.sum(-1, keepdims=True)
    for t in range(1, t_max):
        x = alpha[t - 1] @ a_in
        if (b := brk[t]).any():
            x[b] = alpha[t - 1][b] @ a_br
        x *= emit[t]
        x /= x.sum(-1, keepdims=True)
        alpha[t] = x
    for t in range(t_max - 2, -1, -1):
        y = emit[t + 1] * beta[t + 1]
        x = y @ a_in.T
        if (b := brk[t + 1]).any():
            x[b] = y[b] @ a_br.T
        x /= x.sum(-1, keepdims=True)
        x[~mask[t + 1]] = 1.0
        beta[t] = x
    post = alpha * beta
    return post / post.sum(-1, keepdims=True), alpha, beta, a_in, a_br


def sequences(lines: list[tuple[str, str]], langs: list[str], n: int, seed: int = 3) -> list[tuple[list[str], list[int], list[bool]]]:
    """Synthetic code-switched texts of labelled lines: words, labels and 'first of a line' marks.

    A language goes on with probability 0.75 at a line break; now and then a foreign title is quoted inside a line."""
    rng = np.random.default_rng(seed)
    by = {k: [_letters(unicodedata.normalize("NFC", t).lower()) for lang, t in lines if lang == k] for k in langs}
    out = []
    for _ in range(n):
        words, labels, marks = [], [], []
        now = langs[rng.integers(len(langs))]
        for _ in range(rng.integers(1, 6)):
            if rng.random() > 0.75:
                now = langs[rng.integers(len(langs))]
            line = by[now][rng.integers(len(by[now]))]
            if rng.random() < 0.3:
                line = line[: rng.integers(1, 6)]
            own = [langs.index(now)] * len(line)
            if rng.random() < 0.08 and len(line) > 8:
                other = langs[rng.integers(len(langs))]
                title = by[other][rng.integers(len(by[other]))][:4]
                k = int(rng.integers(2, len(line) - 2))
                line, own = line[:k] + title + line[k:], own[:k] + [langs.index(other)] * len(title) + own[k:]
            words += line
            labels += own
            marks += [True] + [False] * (len(line) - 1) if line else []
        if words:
            out.append((words, labels, marks))
    return out


def train(lines: list[tuple[str, str]], n: int = SEQUENCES, steps: int = STEPS) -> Model:
    """Maximum likelihood with L2 by AdaGrad over the synthetic sequences; the same lines give the same model.
    Without lines the only language is 'und' (undetermined)."""
    m = Model(sorted({k for k, _ in lines}) or ["und"])
    if not lines:
        return m
    made = sequences(sorted(lines), m.langs, n)
    vocab = {w: i for i, w in enumerate(dict.fromkeys(w for words, _, _ in made for w in words))}
    feats = [features(w) for w in vocab]
    col = np.concatenate([np.array(f) for f in feats])
    row = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    scale = (1 / np.sqrt([len(f) for f in feats])).astype(np.float32)
    t_max, b, k = max(len(w) for w, _, _ in made), len(made), len(m.langs)
    ids, gold, brk = np.full((t_max, b), -1), np.zeros((t_max, b), int), np.zeros((t_max, b), bool)
    for j, (words, labels, marks) in enumerate(made):
        ids[: len(words), j], gold[: len(words), j], brk[: len(words), j] = [vocab[w] for w in words], labels, marks
    mask = ids >= 0
    total, eye = mask.sum(), np.eye(k, dtype=np.float32)
    order = np.argsort(col, kind="stable")
    used, starts = np.unique(col[order], return_index=True)
    acc = [np.full_like(x, 1e-8) for x in (m.w, m.inside, m.across, m.start)]
    for _ in range(steps):
        e = np.zeros((len(feats), k), np.float32)
        np.add.at(e, row, m.w[col])
        e *= scale[:, None]
        emit = np.exp(e - e.max(1, keepdims=True))[ids]
        emit[~mask] = 1.0
        post, alpha, beta, a_in, a_br = _chain(emit, brk, mask, m)
        unary = np.zeros((len(feats), k), np.float32)
        np.add.at(unary, ids[mask], post[mask] - eye[gold[mask]])
        g = np.zeros_like(m.w)
        g[used] = np.add.reduceat((unary * scale[:, None])[row][order], starts, axis=0)
        pair = [np.zeros((k, k), np.float32), np.zeros((k, k), np.float32)]
        for kind, a in ((0, a_in), (1, a_br)):
            on = mask[1:] & (brk[1:] == bool(kind))
            left, right = alpha[:-1][on], (emit[1:] * beta[1:])[on]
            z = np.einsum("ni,ij,nj->n", left, a, right)
            pair[kind] = (left / z[:, None]).T @ right * a
            np.add.at(pair[kind], (gold[:-1][on], gold[1:][on]), -1.0)
        grads = [g / total, pair[0] / total, pair[1] / total, (post[0] - eye[gold[0]]).sum(0) / total]
        for x, d, s in zip((m.w, m.inside, m.across, m.start), grads, acc, strict=True):
            d = d + L2 * x / 10
            s += d * d
            x -= 0.5 * d / np.sqrt(s)
    return m


class Tagger:
    """Labels texts with a model; the emissions of words are kept between batches."""

    def __init__(self, model: Model) -> None:
        self.m, self.index, self.used = model, {}, 1
        self.rows = np.ones((1 << 12, len(model.langs)), np.float32)

    def _ids(self, words: list[str]) -> list[int]:
        index = self.index
        for w in words:
            if w not in index:
                if self.used == len(self.rows):
                    self.rows = np.concatenate([self.rows, np.ones_like(self.rows)])
                e = self.m.emission(w)
                self.rows[self.used] = np.exp(e - e.max())
                index[w] = self.used
                self.used += 1
        return [index[w] for w in words]

    def margin(self, line: str, a: int, b: int) -> float:
        """Logarithm of the odds that a line's words are in language ``a`` and not in ``b``."""
        e = self.rows[self._ids(_letters(unicodedata.normalize("NFC", line).lower()))]
        return float(np.log((e[:, a] + 1e-30) / (e[:, b] + 1e-30)).sum())

    def shares(self, texts: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text, given as its lines: (lines x languages letter-weighted marginals, letters of each line).

        A line without letters is one node without evidence, so it takes its neighbours' language."""
        if self.used > 400_000:
            self.index, self.used, self.rows = {}, 1, self.rows[: 1 << 12]
        seqs = []
        for lines in texts:
            ids, line_of, weight = [], [], []
            for i, line in enumerate(lines):
                w = _letters((line if line.isascii() else unicodedata.normalize("NFC", line)).lower())
                ids += self._ids(w) if w else [0]
                line_of += [i] * max(len(w), 1)
                weight += map(len, w) if w else [0]
            seqs.append((np.array(ids, np.int64), np.array(line_of, np.int64), np.array(weight, np.float32)))
        out: list = [None] * len(texts)
        order = sorted(range(len(seqs)), key=lambda i: len(seqs[i][0]))
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and len(seqs[order[to]][0]) * (to + 1 - at) <= 120_000:
                to += 1
            part = order[at:to]
            at = to
            t_max = max(len(seqs[i][0]) for i in part)
            if not t_max:
                for i in part:
                    out[i] = (np.zeros((len(texts[i]), len(self.m.langs)), np.float32), np.zeros(len(texts[i]), np.float32))
                continue
            ids, brk, mask = np.zeros((t_max, len(part)), np.int64), np.zeros((t_max, len(part)), bool), np.zeros((t_max, len(part)), bool)
            for j, i in enumerate(part):
                n = len(seqs[i][0])
                ids[:n, j], mask[:n, j] = seqs[i][0], True
                brk[1:n, j] = np.diff(seqs[i][1]) > 0
            post = _chain(self.rows[ids], brk, mask, self.m)[0]
            for j, i in enumerate(part):
                _, line_of, weight = seqs[i]
                n, lines = len(line_of), len(texts[i])
                starts = np.searchsorted(line_of, np.arange(lines))
                w = weight[:, None] + 1e-3
                out[i] = (np.add.reduceat(post[:n, j] * w, starts, axis=0) if lines else np.zeros((0, len(self.m.langs)), np.float32), np.add.reduceat(weight, starts) if lines else np.zeros(0, np.float32))
        return out


def fitted(samples: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """The model of at most SAMPLE_LINES labelled texts (those of the least hash, so any order gives the same)."""
    rows = samples.select(F.lower(F.trim(lang_col)).alias("k"), F.col(text_col).alias("t")).where("k <> '' AND t IS NOT NULL")
    return train([(r.k, r.t) for r in bounded_sample(rows, SAMPLE_LINES).collect()])


def named_language(col: Column) -> Column:
    """Two-letter code that a label names, whatever its case, blanks, region or length; null where it names none."""
    first = F.regexp_extract(F.lower(F.trim(col)), r"^([a-z]+)", 1)
    known = F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])
    return F.when(F.length(first) == 2, first).otherwise(known[first])


def document_languages(df: DataFrame, model: Model, id_col: str, text_col: str, carry: str | None = None) -> DataFrame:
    """id, lang and confidence (0 to 1) of every row whose text has a letter; repeated rows count once.  The string
    column ``carry`` comes along as ``carried``, so that labels need no join.

    Null and empty texts and texts without letters have no row; whole texts are read; no shuffle of texts."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    carried = df[carry].cast("string") if carry else F.lit(None).cast("string")
    texts = df.select(df[id_col].cast("long").alias("id"), df[text_col].alias("text"), carried.alias("carried")).where(F.col("text").rlike(r"\p{L}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = Tagger(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                got = [s.sum(0) for s, _ in use.shares([t.split("\n") for t in part.column(1).to_pylist()])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([use.m.langs[int(x.argmax())] for x in got], pa.string()), pa.array([float(x.max() / x.sum()) for x in got], pa.float64()), part.column(2)],
                    names=["id", "lang", "confidence", "carried"],
                )

    done = texts.mapInArrow(run, "id bigint, lang string, confidence double, carried string").distinct()
    return done if carry else done.drop("carried")


def line_languages(df: DataFrame, model: Model, id_col: str, text_col: str, mixed_only: bool = True) -> DataFrame:
    """id, line_no, lang, confidence and mixed of each non-blank line; lines are cut at \\n only and numbered from 0.

    A text is mixed when lines that hold PROOF_LETTERS letters, PROOF_SHARE of them in one language, prove two or more
    languages, each but the main one by a line whose odds against it exceed PROOF_MARGIN and grow with the number of
    lines; otherwise all its lines take the text's language.  With ``mixed_only`` only mixed texts have rows.  Null,
    empty and blank texts have none; repeated rows count once; an empty table gives an empty result.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)
    texts = df.select(df[id_col].cast("long").alias("id"), df[text_col].alias("text"))
    texts = texts.where(F.instr("text", "\n") > 0) if mixed_only else texts.where("text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = Tagger(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                numbered = [[(n, x) for n, x in enumerate(t.split("\n")) if x.strip()] for t in part.column(1).to_pylist()]
                rows: tuple[list, ...] = ([], [], [], [], [])
                for id_, lines, (share, letters) in zip(part.column(0).to_pylist(), numbered, use.shares([[x for _, x in n] for n in numbered]), strict=True):
                    if not lines:
                        continue
                    own = share / np.maximum(share.sum(1, keepdims=True), 1e-9)
                    best = own.argmax(1)
                    proved = set(best[(own.max(1) >= PROOF_SHARE) & (letters >= np.where(np.isin(best, _dense(use.m.langs)), PROOF_LETTERS // 3, PROOF_LETTERS))].tolist())
                    if len(proved) > 1:  # other scripts prove themselves; close languages need a line that tells them apart
                        main, dense = int(share.sum(0).argmax()), _dense(use.m.langs)
                        least = PROOF_MARGIN + np.log(len(lines))
                        proved = {main} | {b for b in proved if b != main and (b in dense or main in dense or max(use.margin(lines[k][1], b, main) for k in np.flatnonzero(best == b)) >= least)}
                    mixed = len(proved) > 1
                    if not mixed:
                        best = np.full(len(lines), int(share.sum(0).argmax()))
                        if mixed_only:
                            continue
                    elif (weak := ~np.isin(best, list(proved))).any():
                        among = sorted(proved)
                        best[weak] = np.array(among)[own[weak][:, among].argmax(1)]
                    for (n, _), b, o in zip(lines, best, own, strict=True):
                        for to, v in zip(rows, (id_, n, use.m.langs[int(b)], float(o[int(b)]), mixed), strict=True):
                            to.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.string()), pa.array(rows[3], pa.float64()), pa.array(rows[4], pa.bool_())], names=["id", "line_no", "lang", "confidence", "mixed"])

    return texts.mapInArrow(run, "id bigint, line_no int, lang string, confidence double, mixed boolean").distinct()


def _dense(langs: list[str]) -> list[int]:
    """Languages whose letters are words or syllables, so that few letters say much."""
    return [i for i, k in enumerate(langs) if k in ("zh", "ja", "ko")]
