"""Problem 3: cutting oversized items at topic boundaries, with an overlap.

Lexical cohesion: at each natural boundary (paragraph, line, sentence) the words of the block before and of the block
after are compared by cosine; a boundary's depth is how far its similarity lies below the peaks at both sides.  In each
window the deepest valley is cut.
"""

from __future__ import annotations

import re
from collections import Counter
from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import arrow_map

#: Ends of a paragraph, a line and a sentence, by falling rank; the cut is at the match's end.
BOUNDARY = re.compile(r"(?P<p>\n[^\S\n]*\n\s*)|(?P<l>\n[^\S\n]*)|(?P<s>[.!?…]['\")\]»”’]*\s+(?=[^\W\d_a-zа-я]|[§«“\"(])|[。！？；]['”’»）]*)")
WORD = re.compile(r"[一-鿿]|[^\W\d_]+")
#: Words of a block on each side, the least share of a window that a piece fills, and what a stronger boundary adds to a depth.
BLOCK_WORDS, LEAST_FILL, BONUS = 40, 0.5, {"p": 0.15, "l": 0.08, "s": 0.0}


def _cosine(a: Counter, b: Counter) -> float:
    dot = sum(n * b[w] for w, n in a.items() if w in b)
    return dot / sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values())) if dot else 0.0


def valleys(text: str, block_words: int = BLOCK_WORDS) -> list[tuple[int, float]]:
    """(cut position, depth) of each natural boundary of ``text``, in order."""
    cuts = [(m.end(), m.lastgroup) for m in BOUNDARY.finditer(text) if 0 < m.end() < len(text)]
    if not cuts:
        return []
    words = [(m.start(), m.group().lower()) for m in WORD.finditer(text)]
    starts, i, sims = [w[0] for w in words], 0, []
    for cut, _ in cuts:
        while i < len(starts) and starts[i] < cut:
            i += 1
        sims.append(_cosine(Counter(w for _, w in words[max(0, i - block_words) : i]), Counter(w for _, w in words[i : i + block_words])))
    left, right = sims[:], sims[:]
    for k in range(1, len(sims)):  # the peak reached by climbing from the valley
        left[k] = max(sims[k], left[k - 1]) if sims[k - 1] >= sims[k] else sims[k]
    for k in range(len(sims) - 2, -1, -1):
        right[k] = max(sims[k], right[k + 1]) if sims[k + 1] >= sims[k] else sims[k]
    return [(cut, left[k] + right[k] - 2 * sims[k] + BONUS[kind]) for k, (cut, kind) in enumerate(cuts)]


def cut_spans(text: str, limit: int = 2000, overlap: int = 200, block_words: int = BLOCK_WORDS) -> list[tuple[int, int]]:
    """(start, end) of the pieces: each at most ``limit`` long; each start but the first is the end before less ``overlap``."""
    if not 0 <= overlap <= limit // 4:
        raise ValueError("overlap must lie between 0 and a quarter of limit")
    if len(text) <= limit:
        return [(0, len(text))]
    at, spans, start = valleys(text, block_words), [], 0
    k = 0
    while len(text) - start > limit:
        low, high = start + max(overlap + 1, int(limit * LEAST_FILL)), start + limit
        while k < len(at) and at[k][0] <= start + overlap:
            k += 1
        inside, j = [], k
        while j < len(at) and at[j][0] <= high:
            if at[j][0] >= low:
                inside.append((at[j][1], at[j][0]))
            j += 1
        end = max(inside)[1] if inside else _word_end(text, low, high)
        spans.append((start, end))
        start = end - overlap
    return [*spans, (start, len(text))]


def _word_end(text: str, low: int, high: int) -> int:
    """Last end of a clause, else of a word, in (low, high]; else ``high``, less a combining mark's distance."""
    for pattern in (r"[;:,，、；：]\s*", r"\s+"):
        ends = [m.end() for m in re.compile(pattern).finditer(text, low, high) if m.end() > low]
        if ends:
            return ends[-1]
    import unicodedata

    cut = high
    while cut > low and (unicodedata.combining(text[cut]) or text[cut] in "‍️" or text[cut - 1] == "‍"):
        cut -= 1
    return cut if cut > low else high


def split_pieces(df: DataFrame, text_col: str, key_cols: list[str], limit: int = 2000, overlap: int = 200) -> DataFrame:
    """The pieces of every text longer than ``limit`` characters: the keys, piece_no (from 0), start, n_pieces and piece.

    Shorter, empty and null texts have no pieces (they need no cut).  Pieces without the overlap concatenate to the
    text.  Repeated rows count once; null keys stay null; other columns are not read, so clashing names do no harm.
    """
    short = df.select(*[df[k].alias(f"k{i}") for i, k in enumerate(key_cols)], df[text_col].alias("text")).where(F.length("text") > limit)
    kinds = dict(short.dtypes)

    def run(c: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in (*(f"k{i}" for i in range(len(key_cols))), "piece_no", "start", "n_pieces", "piece")}
        for r, text in enumerate(c["text"]):
            spans = cut_spans(text, limit, overlap)
            for no, (a, b) in enumerate(spans):
                for i in range(len(key_cols)):
                    out[f"k{i}"].append(c[f"k{i}"][r])
                for n, v in (("piece_no", no), ("start", a), ("n_pieces", len(spans)), ("piece", text[a:b])):
                    out[n].append(v)
        return out

    schema = ", ".join(f"k{i} {kinds[f'k{i}']}" for i in range(len(key_cols))) + ", piece_no int, start int, n_pieces int, piece string"
    done = arrow_map(short.distinct(), run, schema)
    return done.select(*[done[f"k{i}"].alias(k) for i, k in enumerate(key_cols)], "piece_no", "start", "n_pieces", "piece")
