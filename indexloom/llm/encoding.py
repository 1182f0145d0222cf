"""Problem 1: text that was decoded with the wrong encoding, repaired by minimum description length.

Every candidate reading of a line (a chain of wrong decodings undone) is compressed with a zstandard dictionary of each
language; characters outside the language's alphabet are escaped.  The chain is charged once for a text and a little
for each line; the shortest description wins, and where no chain saves enough the text stays as it is.
"""

from __future__ import annotations

import codecs
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indexloom.llm.common import stored

#: Size of the dictionaries, and the prices (bytes) of an escaped character, of a chain used in a text, of its steps to
#: UTF-8 and others, and of a line it is used for.
DICT_BYTES, LEVEL, ESCAPE, CHAIN, STEP, SWAP, LINE = 65_536, 3, 3.0, 3.0, 1.0, 4.0, 0.5
#: Share of the texts from which a line is frequent, bits of the key of a pair of characters, and what a pair that was not seen counts.
OFTEN, PAIR_BITS, UNSEEN = 0.0015, 16, 0.02
#: What is cut from both ends of a line.
BLANK = " \t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Bytes that one character read anew can save at most (a match goes on in place of a literal and a new match), and what marks a character that a swap does not know.
SAVED, BAR = 8.0, 1_000
#: Single-byte encodings that text is read in by mistake.
SINGLE = ("latin-1", "cp1252", "cp1250", "cp1251", "iso8859-2", "iso8859-5", "iso8859-15", "cp437", "cp850", "cp852", "cp866", "mac-roman", "mac-cyrillic", "koi8-r", "cp1254")
MULTI = ("gb18030", "big5", "cp932")
#: Fixed values: (encoding it was read in, encoding it was written in), where neither is UTF-8.
SWAPS = tuple(
    (a, b)
    for b, read in {
        "cp1250": ("cp1252", "latin-1", "iso8859-2", "mac-roman", "cp852"), "iso8859-2": ("cp1252", "latin-1", "cp1250"),
        "cp1251": ("cp1252", "latin-1", "koi8-r", "cp866", "iso8859-5", "mac-cyrillic", "mac-roman", "cp437", "cp850"), "koi8-r": ("cp1251", "cp1252", "latin-1", "cp866", "iso8859-5", "mac-roman", "cp437"),
        "cp866": ("cp1251", "cp1252", "latin-1", "koi8-r", "cp437", "cp850", "mac-roman"), "iso8859-5": ("cp1251", "cp1252", "latin-1", "koi8-r", "mac-roman"),
        "gb18030": ("latin-1", "cp1252", "cp1251", "cp1250", "mac-roman", "cp437", "cp850", "big5"), "big5": ("latin-1", "cp1252", "gb18030"),
        "cp1252": ("mac-roman", "cp437", "cp850", "cp1250", "cp1251", "iso8859-2", "koi8-r", "cp866"), "mac-roman": ("cp1252", "latin-1"), "cp850": ("cp1252", "latin-1"), "cp437": ("cp1252", "latin-1"), "cp852": ("cp1252", "cp1250", "latin-1"),
    }.items()
    for a in read
)
#: Signs that texts of every language may hold.
COMMON = "·•«»“”„‘’–—…©§°"
_signs = frozenset(COMMON)
#: What is left of bytes that could not be decoded: the replacement character, and that character read wrongly again.
LOST = re.compile("�|ï¿½|锟斤拷|ďż˝|пїЅ|я┐╜|├»┬┐┬╜|Ôªø|∩┐╜")
#: Letters that an encoding could not hold leave question marks: one between letters, or two and more where a word goes on.
ASKED = re.compile(r"(?<=[^\W\d_])\?(?=[^\W\d_=])(?![^\s?]*=)|\?{2,}(?=[^\W\d_])")
ASKED_TWICE = re.compile(r"(?<!\?)\?{2,}(?!\?)(?!$)", re.M)


def lost(text: str) -> int:
    """Characters of a text that are lost for good: replacement characters, and question marks in place of letters."""
    n = len(LOST.findall(text))
    if "?" in text:
        sure, maybe = len(ASKED.findall(text)), len(ASKED_TWICE.findall(text))
        n += max(sure, maybe) if sure or maybe > 1 else 0
    return n


class _Bytes:
    """A single-byte encoding in which bytes without a character stand for themselves."""

    def __init__(self, name: str) -> None:
        self.table = "".join(bytes([b]).decode(name, "ignore") or chr(b) for b in range(256))
        self.map = codecs.charmap_build(self.table)

    def encode(self, s: str) -> bytes:
        return codecs.charmap_encode(s, "strict", self.map)[0]

    def decode(self, b: bytes) -> str:
        return codecs.charmap_decode(b, "strict", self.table)[0]


class _Codec:
    def __init__(self, name: str) -> None:
        self.name = name

    def encode(self, s: str) -> bytes:
        return s.encode(self.name)

    def decode(self, b: bytes) -> str:
        return b.decode(self.name)


CODECS = {n: _Bytes(n) for n in SINGLE} | {n: _Codec(n) for n in (*MULTI, "utf-8")}


def _pairs(name: str) -> re.Pattern:
    """Matches where characters read in a single-byte encoding spell a UTF-8 sequence of two bytes or more."""
    table = CODECS[name].table
    lead, next_ = (re.escape("".join(table[b] for b in r)) for r in (range(0xC2, 0xF5), range(0x80, 0xC0)))
    return re.compile(f"[{lead}][{next_}]")


SPELLS = {n: _pairs(n) for n in SINGLE}
_high = re.compile(r"[^\x00-\x7e]").findall
_control = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]").findall
_double = re.compile(r"[^\x00-\x7f]{2}").search
_letters = re.compile(r"[^\W\d_]+").findall
_wide = re.compile("[\u2e80-\U0010ffff]")


@lru_cache(maxsize=None)
def _swap_table(pair: tuple[str, str]) -> dict[str, str] | None:
    """Characters beyond ASCII as the other encoding has their bytes; None where that is no matter of single bytes."""
    read, written = (CODECS[n] for n in pair)
    if not (isinstance(read, _Bytes) and isinstance(written, _Bytes)):
        return None
    return {read.table[b]: written.table[b] for b in range(0x80, 0x100)}


def _undone(s: str, read: str, written: str) -> str | None:
    try:
        out = CODECS[written].decode(CODECS[read].encode(s))
    except (UnicodeError, ValueError):
        return None
    return out if out != s else None


#: Capitals inside a word, two scripts in a word, and signs right after a letter, which cost an escape each.
_odd = re.compile("(?<=[a-zß-öø-ÿа-џ])[À-ÖØ-ÞЀ-Я]|(?<=[A-Za-zÀ-ÖØ-ſ])[Ѐ-ӿ一-鿿]|(?<=[Ѐ-ӿ])[A-Za-zÀ-ÖØ-ſ]|(?<=[一-鿿])[A-Za-zÀ-ÖØ-ſ]|(?<=[^\\W\\d_])[§©®±¶¤¦¨¬¯´¸¼½¾¢£¥¹²³€†‡‰™]").findall
_chunks = re.compile(r"([ \t�]+)")


def _partly(s: str, read: str) -> str | None:
    """As ``_undone`` to UTF-8, word by word: words that cannot be undone stay, a few bytes that are gone in a long one
    are replaced, and a last byte that was taken for a blank (U+00A0) is put back."""
    parts = _chunks.split(s)
    codec, blank = CODECS[read], CODECS[read].table[0xA0] if read in SINGLE else ""
    for i, p in enumerate(parts):
        if p.isascii() or p.isspace():
            continue
        new = _undone(p, read, "utf-8") or (blank and _undone(p + blank, read, "utf-8"))
        if not new and len(p) > 8:
            try:
                new = codec.encode(p).decode("utf-8", "replace")
            except (UnicodeError, ValueError):
                continue
            if 5 * new.count("�") > len(_high(new)):
                continue
        parts[i] = new or p
    out = "".join(parts)
    return out if out != s else None


def readings(line: str, depth: int = 3, swaps: Iterable[tuple[str, str]] = SWAPS) -> dict[str, tuple[str, ...]]:
    """The other texts a line may stand for, each with its shortest chain of steps (read>written)."""
    out: dict[str, tuple[str, ...]] = {}
    front = {line: ()}
    for d in range(depth):
        new: dict[str, tuple[str, ...]] = {}
        for s, chain in front.items():
            spelt = (n for n in SINGLE if SPELLS[n].search(s)) if _double(s) else ()
            for read in (*spelt, *(MULTI if _wide.search(s) else ())):
                t = _undone(s, read, "utf-8")
                if t is None and not d and read in ("latin-1", "cp1252", "cp1250", "cp1251", "mac-roman", "cp437", "cp850", "gb18030"):
                    t = _partly(s, read)
                if t is not None and t != line and t not in out and t not in new and len(_control(t)) <= len(_control(line)):
                    new[t] = (*chain, f"{read}>utf-8")
            if not d:
                for read, written in swaps:
                    t = _undone(s, read, written)
                    if t is not None and t not in new:
                        out.setdefault(t, (f"{read}>{written}",))
        out |= {t: c for t, c in new.items() if t not in out}
        front = {t: c for t, c in new.items() if not t.isascii()}
    return out


class Coder:
    """Description lengths of lines: a dictionary and an alphabet for each language.

    What is asked of characters is kept in arrays, a row a character: the languages that lack it, and for each swap of
    single-byte encodings what becomes of it.  So the price of the escapes of every swap is known before any is made."""

    def __init__(self, dictionaries: dict[str, bytes], alphabets: dict[str, str]) -> None:
        self.alphabets = {k: frozenset(v) for k, v in alphabets.items()}
        self.langs = list(alphabets)
        self.known = frozenset().union(*self.alphabets.values()) | set(COMMON)
        self.press = {}
        for k, d in dictionaries.items():
            use = zstandard.ZstdCompressionDict(d)
            use.precompute_compress(level=LEVEL)
            self.press[k] = zstandard.ZstdCompressor(level=LEVEL, dict_data=use, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.kept: dict[str, list[tuple[float, tuple[str, ...], str]]] = {}
        self.odd_of: dict[str, int] = {}
        # words that a dictionary holds, and for each the swaps that make another such word of it (bits)
        self.vocabulary = {w for d in dictionaries.values() for w in _letters(d.decode("utf-8", "ignore")) if not w.isascii()}
        self.turns: dict[str, int] = {}
        self.calm: dict[str, bool] = {}
        self.tables = [(pair, t) for pair in SWAPS if (t := _swap_table(pair)) is not None]
        self.double = [pair for pair in SWAPS if _swap_table(pair) is None]
        n, p, k = 1 << 10, len(self.tables), len(self.langs)
        self.rows: dict[str, int] = {}
        self.lacks, self.unknown = np.zeros((n, k), np.float32), np.zeros(n, np.float32)
        self.swapped, self.strange, self.moved = np.zeros((n, p * k), np.float32), np.zeros((n, p), np.float32), np.zeros((n, p), np.float32)

    def _lacking(self, c: str) -> list[bool]:
        return [c not in self.alphabets[k] for k in self.langs]

    def _row(self, c: str) -> int:
        """The place of a character; those that no single-byte swap knows have what they become at BAR."""
        at = self.rows.get(c)
        if at is None:
            at = self.rows[c] = len(self.rows)
            if at == len(self.lacks):
                for name in ("lacks", "unknown", "swapped", "strange", "moved"):
                    old = getattr(self, name)
                    setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
            self.lacks[at], self.unknown[at] = self._lacking(c), c not in self.known
            for j, (_, table) in enumerate(self.tables):
                new = table.get(c)
                self.swapped[at, j * len(self.langs) : (j + 1) * len(self.langs)] = BAR if new is None else self._lacking(new)
                self.strange[at, j] = BAR if new is None else new not in self.known
                self.moved[at, j] = new != c
        return at

    def _calm(self, part: str) -> bool:
        """Whether all words between two blanks are known, and no swap or UTF-8 reading makes other known words of them."""
        ok = self.calm.get(part)
        if ok is None:
            ok = self._turned(part) == 0 and not any(
                t in self.vocabulary for w in _letters(part) if not w.isascii() for read in (*SINGLE, *MULTI) if (t := _undone(w, read, "utf-8"))
            ) and not any(SPELLS[read].search(part) and _undone(part, read, "utf-8") for read in SINGLE)
            if len(self.calm) < 400_000:
                self.calm[part] = ok
        return ok

    def _turned(self, line: str) -> int | None:
        """The swaps (bits) that make a known word of a word of the line; None where a word or sign is not known."""
        bits, rest = 0, line
        for w in set(_letters(line)):
            if not w.isascii():
                k = self.turns.get(w)
                if k is None:
                    if w not in self.vocabulary:
                        return None
                    k = sum(1 << j for j, (pair, _) in enumerate(self.tables) if _undone(w, *pair) in self.vocabulary)
                    self.turns[w] = k
                bits |= k
                rest = rest.replace(w, "")
        return bits if _signs.issuperset(_high(rest)) else None

    def odd(self, line: str) -> int:
        """Odd neighbours; none of them span a blank, and words come again."""
        n, kept = 0, self.odd_of
        for w in line.split():
            if not w.isascii():
                k = kept.get(w)
                if k is None:
                    k = len(_odd(w))
                    if len(kept) < 200_000:
                        kept[w] = k
                n += k
        return n

    def _counted(self, line: str) -> tuple[np.ndarray, np.ndarray]:
        counts = Counter(_high(line))
        return np.array([self._row(c) for c in counts], np.int64), np.array(list(counts.values()), np.float32)

    def _prices(self, line: str) -> np.ndarray:
        """Price of the escapes by language: characters outside the alphabet, odd neighbours."""
        at, n = self._counted(line)
        return ESCAPE * (n @ self.lacks[at] + self.odd(line))

    def escapes(self, line: str) -> list[tuple[float, str]]:
        """(price of the escapes, language), cheapest first."""
        return self._sorted(self._prices(line))

    def cost(self, line: str, escapes: list[tuple[float, str]], most: float = 1e9, took: dict[str, float] | None = None) -> float:
        """Least length over the languages; those whose escapes alone reach ``most`` are passed over.  ``took`` gets the
        lengths without escapes."""
        raw, best = line.encode("utf-8", "surrogatepass"), most
        for price, k in escapes:
            if price >= best:
                break
            n = float(len(self.press[k].compress(raw)))
            if took is not None:
                took[k] = n
            best = min(best, price + n)
        return best

    def spelt(self, line: str) -> bool:
        """Whether the line can be read as UTF-8 that was taken for another encoding."""
        return not line.isascii() and any("utf-8" in c[0] for c in readings(line, 1, ()).values())

    def doubtful(self, line: str) -> bool:
        """Whether characters are lost, or the escapes of another reading alone are cheaper by more than two chains."""
        if LOST.search(line) or self.spelt(line):
            return True
        at, n = self._counted(line)
        least = float((ESCAPE * (n @ self.lacks[at] + self.odd(line))).min())
        if least <= 2 * CHAIN:
            return False
        found, prices = self._swaps(at, n, least)
        if len(found) and float(prices.min()) + 2 * CHAIN < least:
            return True
        others = (t for pair in self.double if (t := _undone(line, *pair)))
        return any(float(self._prices(t).min()) + 2 * CHAIN < least for t in (*others, *self._strange_words(line)))

    def gains(self, line: str) -> list[tuple[float, tuple[str, ...], str]]:
        """(bytes saved, chain, text) of each reading that is shorter than the line as it stands."""
        if line.isascii():
            return []
        if line not in self.kept:
            if len(self.kept) > 50_000:
                self.kept.clear()
            self.kept[line] = self._gains(line)
        return self.kept[line]

    def _gains(self, line: str) -> list[tuple[float, tuple[str, ...], str]]:
        # words that a dictionary holds are matches: only what makes other known words of them can be shorter
        get = self.calm.get
        if all(p.isascii() or get(p) or self._calm(p) for p in line.split()):
            return []
        turned = self._turned(line)
        at, n = self._counted(line)
        prices = ESCAPE * (n @ self.lacks[at] + self.odd(line))
        least = float(prices.min())
        # a reading with more strange characters than the line is no candidate
        others = readings(line, swaps=self.double if least or _double(line) else ())
        if least:
            others |= {t: c for t, c in self._strange_words(line).items() if t not in others}
        priced = [(t, c, 0.0, p) for t, c in others.items() if (least or self.known.issuperset(_high(t))) and (p := self._prices(t)).min() <= least]
        swaps = self._swaps(at, n, least) if turned != 0 or least else ([], [])
        moved = n @ self.moved[at] if swaps[0] else None
        for j, p in zip(*swaps, strict=True):
            pair = self.tables[j][0]
            if turned is not None and not least and not turned >> j & 1:
                continue
            t = _undone(line, *pair)
            if t is not None and t not in others:
                others[t] = (f"{pair[0]}>{pair[1]}",)
                p = p + ESCAPE * self.odd(t)
                if p.min() <= least:
                    priced.append((t, others[t], float(moved[j]), p))
        if not priced:
            return []
        took: dict[str, float] = {}
        own, found = self.cost(line, self._sorted(prices), took=took), []
        known = np.array([k in took for k in self.langs])
        length = np.array([took.get(k, 0.0) for k in self.langs])
        for text, chain, m, p in priced:
            if m:  # languages that cannot describe it shorter, however well the moved characters fit, are passed over
                p = np.where(p + length - SAVED * m * known < own, p, 1e9)
            c = self.cost(text, self._sorted(p), own)
            if c < own:
                found.append((own - c, chain, text))
        return sorted(found, key=lambda x: (-x[0], x[1]))

    def _sorted(self, prices: np.ndarray) -> list[tuple[float, str]]:
        return sorted(zip(prices.tolist(), self.langs, strict=True))

    def _swaps(self, at: np.ndarray, n: np.ndarray, least: float) -> tuple[list[int], np.ndarray]:
        """The swaps of single bytes that can be candidates for lines with these characters: all of them map, some are
        moved, no more are unknown, and the escapes alone cost no more than the line's; and those prices by language."""
        able = (self.strange[at].sum(0) <= self.unknown[at].sum()) & self.moved[at].any(0)
        if not able.any():
            return [], np.zeros((0, len(self.langs)))
        price = ESCAPE * (n @ self.swapped[at]).reshape(len(self.tables), -1)
        able &= price.min(1) <= least
        return np.flatnonzero(able).tolist(), price[able]

    def _strange_words(self, line: str) -> dict[str, tuple[str, ...]]:
        """Readings in which only words with strange characters change, where the line holds right words beside them."""
        parts = _chunks.split(line)
        held = [i for i, p in enumerate(parts) if not p.isascii() and not p.isspace()]
        prices = {i: float(self._prices(parts[i]).min()) for i in held}
        strange = [i for i in held if prices[i]]
        out: dict[str, tuple[str, ...]] = {}
        if 0 < len(strange) < len(held):
            changed: dict[tuple[str, str], dict[int, str]] = {}
            for i in strange:
                at, n = self._counted(parts[i])
                for pair in [*(self.tables[j][0] for j in self._swaps(at, n, prices[i])[0]), *(self.double if _wide.search(parts[i]) else ())]:
                    t = _undone(parts[i], *pair)
                    if t is not None and self._prices(t).min() < prices[i]:
                        changed.setdefault(pair, {})[i] = t
            for (read, written), new in changed.items():
                out.setdefault("".join(new.get(i, p) for i, p in enumerate(parts)), (f"{read}>{written}",))
        return out

    def repair(self, text: str) -> tuple[str, list[str], int]:
        """The text with its best readings, the chains used, and the characters lost for good."""
        lines = text.split("\n")
        gains = [self.gains(x.strip("\r")) for x in lines]
        # signs that every language may hold do not tell which of them was meant, so they pay for no chain
        by_line = [{c: gain - LINE for gain, c, t in reversed(g) if not _signs.issuperset(_high(x + t))} for x, g in zip(lines, gains, strict=True)]
        total, paid, saved = Counter(), set(), [0.0] * len(lines)
        while True:  # a chain is paid for by what it saves beyond the chains that are paid already
            more: Counter = Counter()
            for best, so_far in zip(by_line, saved, strict=True):
                for chain, gain in best.items():
                    if gain > so_far and chain not in paid:
                        more[chain] += gain - so_far
            total = total or more
            worth = [(gain - price, c) for c, gain in more.items() if gain > (price := CHAIN + sum(STEP if x.endswith(">utf-8") else SWAP for x in c))]
            if not worth:
                break
            paid.add(chosen := max(worth)[1])
            saved = [max(n, best.get(chosen, 0.0)) for best, n in zip(by_line, saved, strict=True)]
        used: Counter = Counter()
        for i, g in enumerate(gains):
            # among near equal readings the chain that explains more of the text
            pick = max(((gain + min(total[c], 200.0) * 0.03, c, t) for gain, c, t in g if c in paid and gain > LINE), default=None)
            if pick:
                lines[i] = pick[2] + "\r" * lines[i].endswith("\r")
                used[pick[1]] += 1
        fixed = "\n".join(lines)
        return fixed, [" ".join(c) for c in sorted(used)], lost(fixed)


class Sorter:
    """Tells the language of many lines at once, by the code lengths of pairs of characters, and counts their characters."""

    def __init__(self, pairs: dict[str, Counter], coder: Coder) -> None:
        self.coder, self.langs = coder, coder.langs
        self.bits = np.zeros((1 << PAIR_BITS, len(self.langs)), np.float32)
        for j, k in enumerate(self.langs):
            n = np.zeros(1 << PAIR_BITS)
            n[list(pairs[k])] = list(pairs[k].values())
            self.bits[:, j] = -np.log2((n + UNSEEN) / (n.sum() + UNSEEN * len(n)))
        # the row of each character, 0 for those of no alphabet
        self.row = np.zeros(0x110000, np.int32)
        chars = sorted(frozenset().union(*coder.alphabets.values()))
        self.row[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.lacks = np.array([[1.0] * len(self.langs), *(coder._lacking(c) for c in chars)], np.float32)
        self.totals: Counter = Counter()
        self.chars: dict[tuple[str, str], int] = Counter()
        self.top: dict[str, list[tuple[int, int, str]]] = {k: [] for k in self.langs}

    def read(self, lines: list[str], times: list[int]) -> None:
        """Counts lines with the number of texts each is in; those of another reading are left out."""
        at = 0
        while at < len(lines):  # some 200,000 characters at a time
            to, size = at, 0
            while to < len(lines) and (to == at or size + len(lines[to]) < 200_000):
                size += len(lines[to])
                to += 1
            self._read(lines[at:to], np.array(times[at:to], np.int64))
            at = to

    def _read(self, lines: list[str], times: np.ndarray) -> None:
        keys, ends = _pair_keys(lines)
        cost = np.add.reduceat(self.bits[keys], np.append(0, ends[:-1] + 1), axis=0) / 8
        codes = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        line = np.cumsum(codes == 10)
        high = np.flatnonzero(codes > 0x7E)
        codes, line = codes[high].astype(np.int64), line[high]
        lacking = np.zeros(cost.shape, np.float32)
        if len(high):
            new = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
            lacking[line[new]] = ESCAPE * np.add.reduceat(self.lacks[self.row[codes]], new, axis=0)
        best = (cost + lacking).argmin(1)
        # a line that its language holds altogether brings no character that is new to it
        for i in np.flatnonzero(lacking[np.arange(len(best)), best]).tolist():
            if self.coder.doubtful(lines[i]):
                times[i] = 0
        for j, n in enumerate(np.bincount(best, times, len(self.langs)).tolist()):
            self.totals[self.langs[j]] += int(n)
        if len(high):
            both = np.unique(line << 21 | codes)
            of, char = both >> 21, both & 0x1FFFFF
            both = best[of] << 21 | char
            values, inverse = np.unique(both, return_inverse=True)
            for v, n in zip(values.tolist(), np.bincount(inverse, times[of]).tolist(), strict=True):
                if n:
                    self.chars[(self.langs[v >> 21], chr(v & 0x1FFFFF))] += int(n)
        for j, n, x in zip(best.tolist(), times.tolist(), lines, strict=True):
            if n:
                self.top[self.langs[j]].append((-n, _order(x), x))
        for k, held in self.top.items():
            if len(held) > 4_000:
                self.top[k] = _first(held)

    def rows(self) -> Iterator[tuple[str, str | None, int, str | None]]:
        """(language, character, texts, none), (language, none, texts, none) for all lines, and (language, none, texts, line)."""
        yield from ((k, c, n, None) for (k, c), n in self.chars.items())
        yield from ((k, None, n, None) for k, n in self.totals.items() if n)
        yield from ((k, None, -n, x) for k, held in self.top.items() for n, _, x in _first(held))


def _pair_keys(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(keys of the pairs of characters, each line with an end on both sides; where the lines end)."""
    codes = np.frombuffer("\n".join(["", *lines, ""]).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return (codes[:-1] * np.uint32(0x9E3779B1) ^ codes[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - PAIR_BITS), np.flatnonzero(codes[1:] == 10)


def _order(line: str) -> int:
    """An order of equally frequent lines that their letters have no part in."""
    return zlib.crc32(line.encode("utf-8", "surrogatepass"))


def _first(held: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The most frequent lines, as many as twice a dictionary holds."""
    held.sort()
    sizes = np.cumsum([len(x.encode("utf-8", "surrogatepass")) + 1 for _, _, x in held])
    return held[: int(np.searchsorted(sizes, 2 * DICT_BYTES)) + 1]


def _start(by: dict[str, list[str]], letters: dict[str, Counter]) -> Coder:
    return Coder({k: "\n".join(v).encode("utf-8", "surrogatepass")[-DICT_BYTES:] for k, v in by.items()}, {k: COMMON + "".join(v) for k, v in letters.items()})


def _letters_of(lines: Iterable[str]) -> Counter:
    return Counter(c for t in lines for c in {*t, *t.upper()} if c > "\x7e")


def _made(first: Coder, by: dict[str, list[str]], letters: dict[str, Counter], texts: int, rows: Iterable[tuple[str, str | None, int, str | None]]) -> tuple[dict[str, bytes], dict[str, str]]:
    """Dictionaries and alphabets of what ``Sorter.rows`` counted over so many texts."""
    fresh, totals, lines = {k: Counter() for k in by}, Counter(), {k: [] for k in by}
    for k, c, n, line in rows:
        if line is not None:
            lines[k].append((-n, _order(line), line))
        elif c is None:
            totals[k] += n
        else:
            fresh[k][c] += n
    dictionaries = {}
    for k, own in lines.items():
        # the most frequent first; those of a clear reading as another text are left out
        clear = [(-n, x) for n, _, x in _first(own) if not LOST.search(x) and not first.spelt(x) and not (first.escapes(x)[0][0] and any(g[0] > 2 * CHAIN for g in first.gains(x)))]
        least = max(3, OFTEN * texts)
        # what is frequent lies at the end, where matches are cheapest
        dictionaries[k] = "\n".join([*(x for n, x in reversed(clear) if n < least), *by[k], *(x for n, x in reversed(clear) if n >= least)]).encode("utf-8", "surrogatepass")[-DICT_BYTES:]
    # a sign seen once in a thousand of a language's lines belongs to its alphabet
    alphabets = {k: "".join(sorted({*COMMON, *letters[k], *(c for c, n in fresh[k].items() if n >= max(3, totals[k] / 1000))})) for k in by}
    return dictionaries, alphabets


def fit(labelled: list[tuple[str, str]], texts: list[str]) -> tuple[dict[str, bytes], dict[str, str]]:
    """Dictionaries and alphabets of the languages, from labelled lines and the lines of texts of the corpus.

    A corpus line is used if no other reading of it exists; it goes to the language that describes it shortest."""
    by: dict[str, list[str]] = {}
    for k, t in sorted(labelled):
        by.setdefault(k, []).append(t)
    letters = {k: _letters_of(v) for k, v in by.items()}
    first = _start(by, letters)
    sorter = Sorter({k: Counter(_pair_keys(v)[0].tolist()) for k, v in by.items()}, first)
    seen: Counter = Counter(x for t in texts for x in {z.strip(BLANK) for z in t.split("\n")} if x)
    if by:
        sorter.read(list(seen), list(seen.values()))
    return _made(first, by, letters, len(texts), sorter.rows())


def fitted(samples: DataFrame, corpus: DataFrame, lang_col: str, sample_col: str, text_col: str) -> tuple[dict[str, bytes], dict[str, str]]:
    """As ``fit``, of all labelled texts and all texts of the corpus, counted by Spark.

    The driver gets the counts of characters and pairs, and of each language as many lines as twice its dictionary holds."""
    rows = samples.select(F.lower(F.trim(lang_col)).alias("k"), F.col(sample_col).cast("string").alias("t")).where("k <> '' AND t IS NOT NULL").distinct()

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters: dict[str, Counter] = {}
        pairs: dict[str, Counter] = {}
        for batch in batches:
            held: dict[str, list[str]] = {}
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(k, []).append(t)
            for k, v in held.items():
                letters.setdefault(k, Counter()).update(_letters_of(v))
                for t in v:
                    pairs.setdefault(k, Counter()).update(_pair_keys([t])[0].tolist())
        out = [(k, c, None, n) for k, v in letters.items() for c, n in v.items()] + [(k, None, p, n) for k, v in pairs.items() for p, n in v.items()]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["k", "c", "p", "n"])

    by: dict[str, list[str]] = {}
    so_far = Window.partitionBy("k").orderBy(F.xxhash64("t"), "t").rowsBetween(Window.unboundedPreceding, -1)
    for r in rows.select("k", "t", F.coalesce(F.sum(F.octet_length("t") + 1).over(so_far), F.lit(0)).alias("size")).where(F.col("size") < DICT_BYTES).orderBy("k", "t").toLocalIterator():
        by.setdefault(r.k, []).append(r.t)
    letters, pairs = {k: Counter() for k in by}, {k: Counter() for k in by}
    for r in rows.mapInArrow(labelled, "k string, c string, p bigint, n bigint").groupBy("k", "c", "p").agg(F.sum("n").alias("n")).toLocalIterator():
        if r.c is None:
            pairs[r.k][r.p] = r.n
        else:
            letters[r.k][r.c] = r.n
    letters = {k: Counter(dict(sorted(v.items()))) for k, v in letters.items()}
    if not by:
        return {}, {}
    sent = samples.sparkSession.sparkContext.broadcast((by, letters, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, letters, pairs = sent.value
        sorter = Sorter(pairs, _start(by, letters))
        for batch in batches:
            sorter.read(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        out = list(sorter.rows())
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))], names=["k", "c", "n", "line"])

    texts = corpus.select(F.col(text_col).cast("string").alias("t")).where("t <> ''").distinct()
    lines = texts.select(F.explode(F.array_distinct(F.transform(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANK))))).alias("line")).where("line <> ''")
    counted = stored(lines.groupBy("line").agg(F.count("*").alias("n")).mapInArrow(run, "k string, c string, n bigint, line string"))
    n_texts = texts.select(F.count("*")).first()[0]
    counts = counted.where("line IS NULL").groupBy("k", "c").agg(F.sum("n").alias("n"))
    so_far = Window.partitionBy("k").orderBy(F.desc("n"), F.crc32("line"), "line").rowsBetween(Window.unboundedPreceding, -1)
    top = counted.where("line IS NOT NULL").select("k", "n", "line", F.coalesce(F.sum(F.octet_length("line") + 1).over(so_far), F.lit(0)).alias("size")).where(F.col("size") < 2 * DICT_BYTES)
    got = [(r.k, r.c, r.n, None) for r in counts.toLocalIterator()] + [(r.k, None, r.n, r.line) for r in top.toLocalIterator()]
    return _made(_start(by, letters), by, letters, n_texts, got)


def repaired(df: DataFrame, model: tuple[dict[str, bytes], dict[str, str]], id_col: str, text_col: str, carry: list[str] = (), once: bool = True) -> DataFrame:
    """id, text (restored where possible), garbled, lost (characters that cannot be restored) and chains of every row.

    Null and empty texts are not garbled and stay as they are; ASCII lines are not changed; repeated rows give one row;
    whole texts are read; an empty table gives an empty result; of other columns only the strings ``carry`` are read; they come along as carried_<name>.
    Without ``once`` repeated rows stay and no text is shuffled (for callers whose own result is distinct).
    """
    sent = df.sparkSession.sparkContext.broadcast(model)
    texts = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text"), *[df[c].cast("string").alias(f"carried_{c}") for c in carry])
    texts = texts.distinct() if once else texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = None
        for batch in batches:
            use = use or Coder(*sent.value)
            got = [(t, [], lost(t) if t else 0) if not t or t.isascii() else use.repair(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([bool(g[1] or g[2]) for g in got]), pa.array([g[2] for g in got], pa.int32()), pa.array([g[1] for g in got], pa.list_(pa.string())), *[batch.column(2 + i) for i in range(len(carry))]],
                names=["id", "text", "garbled", "lost", "chains", *[f"carried_{c}" for c in carry]],
            )

    return texts.mapInArrow(run, ", ".join(["id bigint, text string, garbled boolean, lost int, chains array<string>", *[f"`carried_{c}` string" for c in carry]]))
