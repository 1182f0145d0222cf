"""Problem 2: main content of web pages, by the maximum-scoring subsequence of scored words.

Text taken from pages has lost its tags, so word sequences that only pages have stand for them: pages (html rows) and
documents fetched in other formats are the labels, and each run of one to three words (four characters in Chinese) gets
the logarithm of its odds.  A word known from documents scores positive, one that is covered by a page-only run
negative.  A linear scan finds the contiguous lines of the greatest sum; lines outside it and negative lines inside it
are furniture.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Callable, Container, Iterable, Iterator, Sequence
from functools import lru_cache
from math import ceil, exp, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import stored

#: Texts counted at a time, and distinct runs that a task holds before it passes them on.
TEXTS, HELD = 4_096, 2_000_000
#: Bits of a run's key, and of the place of a text among those counted at a time.
KEY_BITS, TEXT_BITS = 51, 12
#: Least pages with a run; odds from which a run is furniture; the same for runs of words that other texts use too and that
#: start no line; odds from which a run makes a line furniture that starts with it; how much one line can add to a region,
#: and how much it can take, so that furniture inside the text does not part it; odds of runs that many pages have; and
#: characters of other texts that are no mere message.  SHARE of the pages is the least where that is more than LEAST, so
#: that the number of runs kept is bounded however many pages there are.
LEAST, ODDS, PLAIN_ODDS, HEAD_ODDS, MOST, DROP, COMMON_ODDS, MESSAGE, SHARE = 4, 2.0, 4.2, 2.5, 12.0, 2.0, 4.2, 250, 1e-5
#: Signs that stand for the ends of a line are themselves written otherwise.
_MARKS = {"^": "ˆ", "$": "₴"}
LOST = "�"
_lost, _beyond, _holed = re.compile("�+"), re.compile(r"[^\x00-\x7f]"), re.compile(r"[^\W\d_]*�[^\W\d_�]*(?:�+[^\W\d_]*)*")
_token = re.compile(r"[一-鿿]|[^\W\d_一-鿿]+|\d+|[^\w\s]|_")
_plain_end = frozenset(".,;:!?)")
_holds_han, _holds_quotes = re.compile("[一-鿿]").search, re.compile("[«“„‘\"]").search
#: A blank on both sides of each Chinese character, and what stands for a line break between words.
SPACED, BREAK = {c: f" {chr(c)} " for c in range(0x4E00, 0xA000)}, ""
_quoted = re.compile("«[^«»]*»|“[^“”]*”|„[^„“”]*[“”]|‘[^‘’]*’(?![^\\W\\d_])|\"[^\"\n]*\"")


def unquoted(line: str) -> str:
    """The line without what it quotes; a line that is one quotation stays."""
    rest = _quoted.sub(" ", line) if any(c in line for c in "«“„‘\"") else line
    return rest if any(c.isalpha() for c in rest) else line


def tokens(line: str) -> list[str]:
    return ["0" if t[0].isdigit() else _MARKS.get(t, t) for t in _token.findall(line.lower())]


def _named(toks: Sequence[str], known: Container[str]) -> list[str]:
    """The words with the line's two ends; words outside ``known`` are one and the same name."""
    return ["^", *(t if t in known or not t[0].isalpha() else "N" for t in toks), "$"]


def _runs(toks: Sequence[str], known: Container[str]) -> list[str]:
    """The runs of a line with its two ends.

    The end counts only with the start: teasers end in the words that texts are made of.  A Chinese character alone says
    little: runs that hold some have three at least, or four from the start, and one other word or sign at most."""
    seq = _named(toks, known)
    last = len(seq) - 1
    han = [t >= "一" for t in seq]
    if not any(han):
        out = seq[:last]
        out += map(" ".join, zip(seq[: last - 1], seq[1:last]))
        out += map(" ".join, zip(seq[: last - 2], seq[1 : last - 1], seq[2:last]))
        if last < 3:
            out.append(" ".join(seq))
        return out
    out = []
    for n in (1, 2, 3, 4):
        for i in range(last - n + 2):
            if i + n > last and i:
                continue
            k = sum(han[i : i + n])
            if (n - k < 2 and n >= 3 or n == 4 and not i) if k else n < 4:
                out.append(" ".join(seq[i : i + n]))
    return out


class Weights:
    """Odds of runs, the words known from documents, and the words that are not names."""

    def __init__(self, odds: dict[str, float], legal: frozenset[str], known: frozenset[str]) -> None:
        self.odds, self.legal, self.known = odds, legal, known
        #: the same by their words, and the pairs that begin longer ones
        self.runs = {tuple(g.split(" ")): v for g, v in odds.items()}
        self.pairs = {r[:2] for r in self.runs if len(r) > 1}


def _words_of(text: str) -> list[str]:
    return [w for x in text.split("\n") if x.strip() for w in tokens(unquoted(x))]


def _runs_of(text: str, known: Container[str]) -> list[str]:
    return [g for x in {x for x in text.split("\n") if x.strip()} for g in _runs(tokens(unquoted(x)), known)]


class Parts(dict):
    """Numbers of what stands between blanks; ``new`` gives one to what has none."""

    def __init__(self, new: Callable[[str], int]) -> None:
        self.new = new

    def __missing__(self, part: str) -> int:
        return self.new(part)


class Counting:
    """Reads many texts at once: words are numbers, runs are hashes of KEY_BITS made of them by whole arrays.

    Codes of words are the same in every task: their hash, whether they begin with a letter and whether they are Chinese."""

    def __init__(self, known: Container[str] | None = None) -> None:
        self.known = known
        self.number: dict[str, int] = {}
        self.names: list[str] = []
        self.codes = np.zeros(1 << 12, np.uint64)
        for end in ("^", "$", "N"):
            self._add(end)
        self._forget()

    def _forget(self) -> None:
        """What stands between blanks, by number: its words, from where on in ``said``, and how many.  Number 0 is a break."""
        self.parts = Parts(self._part)
        self.parts[BREAK] = 0
        self.said, self.starts, self.sizes = array("q", (1, 0)), array("q", (0,)), array("q", (2,))

    def _add(self, word: str) -> int:
        at = self.number[word] = len(self.names)
        self.names.append(word)
        if at == len(self.codes):
            self.codes = np.concatenate([self.codes, np.zeros_like(self.codes)])
        self.codes[at] = code(word)
        return at

    def _part(self, part: str) -> int:
        k = self.parts[part] = len(self.parts)
        self.starts.append(len(self.said))
        if part.isascii() and part.isalpha():
            toks = (part,)
        elif part.isascii() and part[-1] in _plain_end and part[:-1].isalpha():
            toks = (part[:-1], part[-1])
        else:
            toks = tokens(part)
        for t in toks:
            if self.known is not None and t not in self.known and t[0].isalpha():
                t = "N"
            at = self.number.get(t)
            self.said.append(self._add(t) if at is None else at)
        self.sizes.append(len(toks))
        return k

    def words(self, texts: list[str], ends: bool) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words of all lines, with the ends of each line if ``ends``; place of the text of each)."""
        if len(self.parts) > 400_000:
            self._forget()
        all_, counts, get = array("q"), [], self.parts.__getitem__
        for t in texts:
            if BREAK in t:
                t = t.replace(BREAK, " ")
            if _holds_quotes(t):
                t = "\n".join(map(unquoted, t.split("\n")))
            if _holds_han(t):
                t = t.translate(SPACED)
            parts = f"\n{t}\n".lower().replace("\n", f" {BREAK} ").split()
            all_.extend(map(get, parts))
            counts.append(len(parts))
        part, of = np.array(all_, np.int64), np.repeat(np.arange(len(texts)), counts)
        said, starts, sizes = (np.array(x, np.int64) for x in (self.said, self.starts, self.sizes))
        if not ends:
            keep = part > 0
            part, of = part[keep], of[keep]
        n = sizes[part]
        total = int(n.sum())
        flat = said[np.arange(total) + np.repeat(starts[part] - (np.cumsum(n) - n), n)]
        of = np.repeat(of, n)
        if ends and total:  # every text begins with a line's end and ends with a line's start
            edge = np.append(True, of[1:] != of[:-1])
            inner = ~(edge | np.append(edge[1:], True))
            flat, of = flat[inner], of[inner]
        return flat, of

    def keys(self, runs: Iterable[tuple[str, ...]]) -> np.ndarray:
        """Sorted keys of runs given as their words."""
        by: dict[int, list[list[int]]] = {}
        for r in runs:
            by.setdefault(len(r), []).append([code(w) for w in r])
        out = [np.zeros(0, np.int64)]
        for n, rows in by.items():
            h = _spread(np.array(rows, np.uint64))
            key = h[:, 0]
            for i in range(1, n):
                key = _joined(key, h[:, i])
            out.append(_finished(key).astype(np.int64))
        return np.sort(np.concatenate(out))


_ENDS = {"^": 0, "$": 1, "N": 2}


@lru_cache(maxsize=200_000)
def code(word: str) -> int:
    if word in _ENDS:
        return _ENDS[word]
    return (xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) >> 16 | 1 << 47) & ~3 | word[0].isalpha() << 1 | (word >= "一")


def run_keys(codes: np.ndarray, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Of lines with their ends, for each length: (keys of the runs, place of the text of each, where they start, length)."""
    h = _spread(codes)
    first, last = codes == 0, codes == 1
    han = ((codes & np.uint64(1)).astype(bool) & ~last).astype(np.int8)
    mixed = np.zeros(len(codes), bool)
    if han.any():
        line = np.cumsum(first) - 1
        mixed = (np.bincount(line, weights=han) > 0)[line]
    key, k = h, han
    inside = ~last  # windows so far hold no end but as their last word
    for n in (1, 2, 3, 4):
        size = len(codes) - n + 1
        if size <= 0:
            return
        if n > 1:
            key = _joined(key[:size], h[n - 1 :])
            k = k[:size] + han[n - 1 :]
            inside = inside[:size] & ~first[n - 1 :]
        closed, plain = last[n - 1 :], ~mixed[:size]
        ok = inside[:size] & (~closed | first[:size])
        if n == 2:
            ok &= ~closed
        if n == 4:
            ok &= ~plain & (k > 0) & ((n - k < 2) | first[:size])
        else:
            ok &= plain | (k == 0) | ((n - k < 2) & (n >= 3))
        at = np.flatnonzero(ok)
        yield _finished(key[at]), of[at], at, n
        if n > 1:
            inside = inside & ~closed


_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _spread(codes: np.ndarray) -> np.ndarray:
    h = (codes + np.uint64(1)) * _MIX2
    return (h ^ (h >> np.uint64(32))) * _MIX


def _joined(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (key ^ (key >> np.uint64(31))) * _MIX + word


def _finished(key: np.ndarray) -> np.ndarray:
    return (key ^ (key >> np.uint64(29))) * _MIX2 >> np.uint64(64 - KEY_BITS)


def _once(keys: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, number of texts with each), of fewer texts than 2 ** TEXT_BITS."""
    both = np.sort(keys.astype(np.int64) << TEXT_BITS | of)
    if not len(both):
        return both, both
    one = both[np.append(True, both[1:] != both[:-1])] >> TEXT_BITS
    new = np.flatnonzero(np.append(True, one[1:] != one[:-1]))
    return one[new], np.diff(np.append(new, len(one)))


def _least(texts: int) -> int:
    """The least number of texts that a word or run must be in."""
    return max(LEAST, ceil(SHARE * texts))


def _rate(sizes: Sequence[int], counts: Sequence[int]) -> float:
    return max([0.5 / max(sum(sizes[1:]), 1), *(c / max(m, 1) for c, m in zip(counts[1:], sizes[1:], strict=True))])


def _weights(sizes: Sequence[int], words: list[tuple[str, int, int]], runs: Iterable[tuple[str, Sequence[int]]]) -> Weights:
    """Of texts by side, (word, texts, texts other than pages) and (run, texts by side)."""
    known = frozenset(w for w, n, _ in words if n >= _least(sum(sizes)) + 1)
    legal = frozenset(w for w, n, others in words if n >= _least(sum(sizes)) + 1 and others >= 2)
    odds = {}
    for g, counts in runs:
        if counts[0] < _least(sizes[0]) or not g.strip("^$N "):
            continue
        # the least number that chance leaves plausible, as a lone few pages beside many texts without a run prove little
        sure = max(counts[0] - 1.96 * counts[0] ** 0.5, 1e-9)
        w = log(counts[0] / sizes[0] / _rate(sizes, counts))
        if w + log(sure / counts[0]) > (PLAIN_ODDS if legal.issuperset(w for w in g.split(" ") if w != "N") else ODDS):
            odds[g] = round(w, 3)
    return Weights(odds, legal, known)


def fit(pages: list[str], *others: list[str]) -> Weights:
    """Odds from labelled texts: pages against the kind of other texts that has a run most often; once a text counts."""
    sides = [pages, *others]
    seen, beside = Counter(), Counter()
    for j, side in enumerate(sides):
        for t in side:
            held = set(_words_of(t))
            seen.update(held)
            if j:
                beside.update(held)
    sizes = [max(len(side), 1) for side in sides]
    known = {w for w, n in seen.items() if n >= _least(sum(sizes)) + 1}
    counts = [Counter(g for t in side for g in set(_runs_of(t, known))) for side in sides]
    return _weights(sizes, [(w, n, beside[w]) for w, n in seen.items()], ((g, [c[g] for c in counts]) for g in counts[0]))


class Scanner:
    """``message`` says which lines are no furniture whatever their words (2), and which are none where a page holds
    nothing else but furniture (1)."""

    def __init__(self, w: Weights, message: Callable[[str], int] = lambda _: 0) -> None:
        self.w, self.kept, self.parts, self.message = w, {}, {}, message
        self.alone = {r[0]: v for r, v in w.runs.items() if len(r) == 1}
        self.counting = Counting(w.known)
        self.keys = self.counting.keys(w.runs)
        self.legal = np.zeros(0, bool)
        self.masked: dict[str, str] = {}  # known words by what is left of them where letters are lost
        for k in sorted(w.known):
            if not k.isascii() and k[0].isalpha() and k < "一":
                self.masked.setdefault(_lost.sub(LOST, _beyond.sub(LOST, k)), k)

    def prepare(self, texts: Iterable[str]) -> None:
        """Scores, all at once, the lines of some texts that hold none of the runs."""
        if len(self.kept) > 300_000:
            self.kept.clear()
        lines = {y for t in texts for x in t.split("\n") if len(y := x.strip()) >= 40 and y not in self.kept and LOST not in y and " – " not in y}
        some = list(lines)
        for a in range(0, len(some), 4096):
            part = some[a : a + 4096]
            hit = np.zeros(len(part), bool)
            flat, of = self.counting.words(part, True)
            if len(self.counting.names) > len(self.legal):
                more = self.counting.names[len(self.legal) :]
                self.legal = np.append(self.legal, [t[0].isalnum() and t in self.w.legal for t in more])
            good = np.bincount(of, weights=self.legal[flat], minlength=len(part))
            for found, line, _, _ in run_keys(self.counting.codes[flat], of):
                hit[line[_among(found, self.keys)[0]]] = True
            for x, h, g in zip(part, hit.tolist(), good.tolist(), strict=True):
                if not h:
                    self.kept[x] = (min(MOST, g), 0.0)

    def score(self, line: str) -> tuple[float, float]:
        """(score of the line, highest odds of its words)."""
        if line not in self.kept:
            self.kept[line] = self._score(line)
        return self.kept[line]

    def _score(self, line: str) -> tuple[float, float]:
        text = unquoted(line).lower()
        if LOST in text:
            text = _holed.sub(lambda m: self.masked.get(_lost.sub(LOST, m[0]), m[0]), text)
        if _holds_han(text):
            text = text.translate(SPACED)
        head, dash, _ = text.partition(" – ")
        if dash and (of_head := self._weigh(head))[0] <= -1:  # a link's title before its teaser
            return of_head
        return self._weigh(text)

    def _part(self, part: str) -> tuple[list[str], list[str], float]:
        """(words, the same with names as one, words known from documents) of what stands between blanks."""
        toks = tokens(part)
        out = (toks, _named(toks, self.w.known)[1:-1], float(sum(t[0].isalnum() and t in self.w.legal for t in toks)))
        if len(part) < 24:
            if len(self.parts) > 200_000:
                self.parts.clear()
            self.parts[part] = out
        return out

    def _weigh(self, text: str) -> tuple[float, float]:
        seq, good, get = ["^"], 0.0, self.parts.get
        parts = [get(p) or self._part(p) for p in text.split()]
        for _, named, legal in parts:
            seq += named
            good += legal
        if len(seq) == 1:
            return 0.0, 0.0
        seq.append("$")
        alone, pairs, values = self.alone, self.w.pairs, self.w.runs
        hits = [(i, 1, alone[t]) for i, t in enumerate(seq) if t in alone]
        for i in [i for i, p in enumerate(zip(seq, seq[1:])) if p in pairs]:
            for n in (2, 3, 4):
                v = values.get(tuple(seq[i : i + n])) if i + n <= len(seq) else None
                if v is not None:
                    hits.append((i, n, v))
        cover, head = [0.0] * len(seq) if hits else None, 0.0
        for i, n, v in hits:
            if i <= 2 and n > 1:
                head = max(head, v)
            for k in range(i, i + n):
                if v > cover[k]:
                    cover[k] = v
        if cover is None:
            return min(MOST, good), 0.0
        toks = [t for words, _, _ in parts for t in words]
        words = [(t, c) for t, c in zip(toks, cover[1:-1], strict=True) if t[0].isalnum()]
        bad = sum(c for _, c in words)
        good = sum(1.0 for t, c in words if not c and t in self.w.legal)
        top = max(cover)
        if head >= HEAD_ODDS and not (bad < good and head < HEAD_ODDS + 0.7):
            return -min(max(head, bad), MOST), top
        return max(-MOST, min(MOST, good - bad)), top

    def furniture(self, text: str) -> list[int]:
        """Numbers of the furniture lines of a page."""
        lines = [x.strip() for x in text.split("\n")]
        scored = [self.score(x) for x in lines]
        best, low, high, total, start = 0.0, -1, -1, 0.0, 0
        for i, (s, _) in enumerate(scored):
            if total <= 0:
                total, start = 0.0, i
            total += max(s, -DROP)
            if total > best:
                best, low, high = total, start, i
        full = [i for i, x in enumerate(lines) if x]
        if high < 0:  # nothing but furniture or a message: the messages, else the sentence least like furniture, and lines beside them no page has often
            if said := {k for k, i in enumerate(full) if self.message(lines[i])}:
                low, high = min(said), max(said)
                return [i for k, i in enumerate(full) if k not in said and not (low - 1 <= k <= high + 1 and scored[i][1] < COMMON_ODDS)]
            best_ = min(range(len(full)), key=lambda k: (lines[full[k]][-1] not in ".!?…。！？", scored[full[k]][1], k), default=0)
            low, high = best_, best_
            while low > 0 and scored[full[low - 1]][1] < COMMON_ODDS:
                low -= 1
            while high + 1 < len(full) and scored[full[high + 1]][1] < COMMON_ODDS:
                high += 1
            return full[:low] + full[high + 1 :]
        return [i for i in full if scored[i][0] < (-0.5 if low <= i <= high else 0.5) and self.message(lines[i]) < 2]


def fitted(df: DataFrame, text_col: str, kind_col: str, page_kind: str = "html", corpus: DataFrame | None = None, corpus_col: str = "text") -> Weights:
    """As ``fit``, of all pages and other texts of ``df`` and all texts of ``corpus`` (texts that never were pages).

    Other texts that may be a mere message are left out.  Words and runs are counted by Spark; the driver gets the known
    words and the runs whose odds are those of furniture."""
    page = F.col(kind_col).eqNullSafe(page_kind)
    of = df.select(page.alias("page"), F.col(text_col).cast("string").alias("t")).where("t <> ''")
    rows = of.where(F.col("page") | (F.length("t") >= MESSAGE)).select(F.when(F.col("page"), 0).otherwise(1).alias("side"), "t")
    if corpus is not None:
        rows = rows.unionByName(corpus.select(F.lit(2).alias("side"), F.col(corpus_col).cast("string").alias("t")).where("t <> ''"))
    coded = stored(rows.distinct().mapInArrow(_coded, "side int, codes binary, more binary, g string, n0 bigint, n1 bigint, n2 bigint"))
    pages, others = coded.where("side = 0").select("side", "codes", "more"), coded.where("side > 0").select("side", "codes", "more")
    found = {r.side: r.n for r in coded.where("side >= 0").groupBy("side").agg(F.count("*").alias("n")).collect()}
    sizes = [max(found.get(j, 0), 1) for j in range(3 if found.get(2) else 2)]
    send = df.sparkSession.sparkContext.broadcast

    totals = coded.where("side < 0").groupBy("g").agg(*[F.sum(n).alias(n) for n in ("n0", "n1", "n2")])
    n_all = F.col("n0") + F.col("n1") + F.col("n2")
    words = [(r.g, r.n0 + r.n1 + r.n2, r.n1 + r.n2) for r in totals.where(n_all >= _least(sizes[0])).toLocalIterator()]
    known = send(np.sort(np.array([2, *(code(w) for w, n, _ in words if n >= _least(sum(sizes)) + 1)], np.uint64)))

    def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(side of each text, its words' codes with names as one, place of the text of each)."""
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                held = part.column(1).to_pylist()
                codes = np.frombuffer(b"".join(held), np.uint32) | np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint16).astype(np.uint64) << np.uint64(32)
                ask = np.flatnonzero(codes & np.uint64(2))
                place = np.minimum(np.searchsorted(known.value, codes[ask]), len(known.value) - 1)
                codes[ask[known.value[place] != codes[ask]]] = 2
                yield part.column(0).to_numpy(zero_copy_only=False), codes, np.repeat(np.arange(len(held)), [len(x) // 4 for x in held])

    def page_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def out() -> pa.RecordBatch:
            keys, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order]
            new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys[new]), pa.array(np.add.reduceat(n, new).astype(np.int64))], names=["key", "n"])

        for _, codes, of in in_parts(batches):
            held += [x for keys, text, _, _ in run_keys(codes, of) if len((x := _once(keys, text))[0])]
            if sum(len(k) for k, _ in held) > HELD:
                yield out()
        if held:
            yield out()

    # runs of pages that could be furniture if no other text had them
    rate = 0.5 / max(sum(sizes[1:]), 1)
    enough = max(_least(sizes[0]), exp(ODDS) * rate * sizes[0])
    of_pages = pages.mapInArrow(page_runs, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= enough)
    got = sorted((r.key, r.n) for r in of_pages.toLocalIterator())
    keys, n0 = np.array([k for k, _ in got], np.int64), np.array([n for _, n in got], np.int64)
    asked = send(keys)

    def other_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((3, max(len(asked.value), 1)), np.int64)
        for sides, codes, of in in_parts(batches):
            for found, text, _, _ in run_keys(codes, of):
                where, place = _among(found, asked.value)
                both = np.sort(place << TEXT_BITS | text[where])
                if len(both):
                    both = both[np.append(True, both[1:] != both[:-1])]
                    np.add.at(counts, (sides[both & ((1 << TEXT_BITS) - 1)], both >> TEXT_BITS), 1)
        held = np.flatnonzero(counts.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int64)), *[pa.array(c[held]) for c in counts[1:]]], names=["place", "n1", "n2"])

    beside = np.zeros((2, max(len(keys), 1)), np.int64)
    for r in others.mapInArrow(other_runs, "place bigint, n1 bigint, n2 bigint").groupBy("place").agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2")).toLocalIterator():
        beside[:, r.place] = r.n1, r.n2
    rates = np.maximum.reduce([np.full(len(keys), rate), *[beside[j - 1, : len(keys)] / sizes[j] for j in range(1, len(sizes))]])
    few = np.flatnonzero(np.log(n0 / sizes[0] / rates) > ODDS - 1e-9) if len(keys) else np.zeros(0, np.int64)
    named = send(keys[few])

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = np.zeros(len(named.value), bool)
        for _, codes, of in in_parts(batches):
            places, runs = [], []
            for found, _, at, n in run_keys(codes, of):
                where, place = _among(found, named.value)
                fresh, i = np.unique(place, return_index=True)
                keep = ~done[fresh]
                done[fresh] = True
                places += fresh[keep].tolist()
                runs += [codes[a : a + n].tolist() for a in at[where[i[keep]]]]
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(runs, pa.list_(pa.int64()))], names=["place", "run"])

    spelling = {code(w): w for w, _, _ in words} | {v: k for k, v in _ENDS.items()}
    of_run = []
    for r in pages.mapInArrow(spelt, "place bigint, run array<bigint>").groupBy("place").agg(F.min("run").alias("run")).toLocalIterator():
        i = few[r.place]
        of_run.append((" ".join(spelling[c] for c in r.run), [int(n0[i]), *(int(x) for x in beside[: len(sizes) - 1, i])]))
    return _weights(sizes, words, of_run)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each (side, text) with the codes of its lines' words, and at the end one for each word with the number of
    texts of each side that hold it (side -1)."""
    names = ["side", "codes", "more", "g", "n0", "n1", "n2"]
    use, counts = Counting(), np.zeros((3, 1 << 12), np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            part = batch.slice(at, TEXTS)
            sides, texts = part.column(0), part.column(1).to_pylist()
            flat, of = use.words(texts, True)
            if len(use.names) > counts.shape[1]:
                counts = np.concatenate([counts, np.zeros((3, max(len(use.names) - counts.shape[1], counts.shape[1])), np.int64)], axis=1)
            both = np.sort(flat << TEXT_BITS | of)
            both = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
            np.add.at(counts, (sides.to_numpy(zero_copy_only=False)[both & ((1 << TEXT_BITS) - 1)], both >> TEXT_BITS), 1)
            ends = np.append(0, np.cumsum(np.bincount(of, minlength=len(texts))))
            codes = use.codes[flat]
            halves = [(codes & np.uint64(0xFFFFFFFF)).astype(np.uint32), (codes >> np.uint64(32)).astype(np.uint16)]
            held = [pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((ends * x.itemsize).astype(np.int32).tobytes()), pa.py_buffer(x.tobytes())]) for x in halves]
            none = pa.nulls(len(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([sides, *held, pa.nulls(len(texts), pa.string()), none, none, none], names=names)
    held = np.flatnonzero(counts.sum(0))
    held = held[held > 1]  # the ends are no words
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), -1, np.int32)), pa.nulls(len(held), pa.binary()), pa.nulls(len(held), pa.binary()), pa.array([use.names[i] for i in held], pa.string()), *[pa.array(c[held]) for c in counts]], names=names)


def _among(found: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``found`` are among the sorted ``keys``, their places there)."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = _bits(keys)
    maybe = np.flatnonzero(seen[(found >> np.uint64(KEY_BITS - 22)).astype(np.int64)])
    values = found[maybe].astype(np.int64)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    hit = keys[at] == values
    return maybe[hit], at[hit]


_bits_kept: list = [None, None]


def _bits(keys: np.ndarray) -> np.ndarray:
    """Which leading bits some key has, so that most others are told without a search."""
    if _bits_kept[0] is not keys:
        bits = np.zeros(1 << 22, bool)
        bits[keys >> (KEY_BITS - 22)] = True
        _bits_kept[:] = keys, bits
    return _bits_kept[1]


def furniture_lines(df: DataFrame, weights: Weights, id_col: str, text_col: str, message: Callable[[str], int] = lambda _: 0) -> DataFrame:
    """id and line_no of the furniture lines of every page; lines are cut at \\n only, from 0, blank ones counted.

    Blank lines are no furniture; null and empty texts have none; repeated rows count once; an empty table gives an
    empty result; whole texts are read, other columns are not."""
    sent = df.sparkSession.sparkContext.broadcast(weights)
    texts = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text")).where("text <> ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = None
        for batch in batches:
            use = use or Scanner(sent.value, message)
            ids, numbers = [], []
            use.prepare(batch.column(1).to_pylist())
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = use.furniture(t)
                ids += [i] * len(found)
                numbers += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32())], names=["id", "line_no"])

    return texts.mapInArrow(run, "id bigint, line_no int").distinct()


def main_text(df: DataFrame, weights: Weights, id_col: str, text_col: str, kind_col: str, page_kind: str = "html", carry: list[str] = (), message: Callable[[str], int] = lambda _: 0, around: bool = False) -> DataFrame:
    """id, text and the strings ``carry`` (as carried_<name>) of every row: the main body of pages, other rows as they are; null stays null.
    With ``around`` the different lines that were left out come along as one string, around."""
    sent = df.sparkSession.sparkContext.broadcast(weights)
    texts = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text"), df[kind_col].eqNullSafe(page_kind).alias("page"), *[df[c].cast("string").alias(f"carried_{c}") for c in carry])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = None
        for batch in batches:
            use = use or Scanner(sent.value, message)
            out, rest = [], []
            use.prepare(t for t, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True) if t and page)
            for t, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                rest.append(None)
                if t and page:
                    drop = set(use.furniture(t))
                    if around:
                        lines = t.split("\n")
                        rest[-1] = "\n".join(dict.fromkeys(lines[i].strip() for i in sorted(drop)))
                    t = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop).strip("\n")
                out.append(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), *[batch.column(3 + i) for i in range(len(carry))], *([pa.array(rest, pa.string())] if around else [])], names=["id", "text", *[f"carried_{c}" for c in carry], *(["around"] if around else [])])

    return texts.mapInArrow(run, ", ".join(["id bigint, text string", *[f"`carried_{c}` string" for c in carry], *(["around string"] if around else [])]))
