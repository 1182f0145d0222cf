"""Problem 6: template residue, filler and error pages, by a regularised linear classifier.

Sentences are classified in windows of words, so that a placeholder in a long sentence counts as much as in a short one;
a text is residue when one of its windows is.  Features are hashed word and shape n-grams, length and title features.
The labels are weak: response-status lines and phrases in all texts, besides lines that pages have around
their text as negatives; the threshold is chosen, and the classifier measured, on hosts that it was not trained on.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.boilerplate import Parts, unquoted
from indexloom.llm.common import stored

#: Feature space, passes, how far a pass goes, bias, L2, weight of a positive window, share of hosts held out.
FEATURES, PASSES, RATE, BIAS, L2, POSITIVE, HELD_OUT = 1 << 17, 16, 0.4, -2.0, 1e-6, 3.0, 5
#: Sentences read at a time, and what the windows of a kind that are no residue count at most, to those that are.
PART, PLAIN = 16_384, 10.0
#: Thresholds to choose from.
STEPS = np.arange(0.45, 0.75, 0.05)
#: Words of a window, and words from one to the next.
WINDOW, STRIDE = 12, 3
#: Probability from which a window is residue where no held-out host tells better.
THRESHOLD = 0.5
#: Weak labels.  Response status, messages, filler in the languages of the corpus, and forms of placeholders.
STATUS = re.compile(
    r"^\s*(http\s*)?(error\s+|status\s+)?[45]\d\d\b[\s:–-]*(not found|forbidden|bad gateway|bad request|unauthorized|internal server error|service unavailable|gateway time-?out|gone)\b|"
    r"^\s*(error|erreur|fehler|errore|erro|fout|błąd|ошибка|错误)\s*[45]\d\d\b",
    re.I,
)
PHRASES = [
    "javascript", "turn on scripts", "needs scripts", "session has expired", "sign in again", "sesión ha caducado", "vuelva a identificarse",
    "session a expiré", "reconnectez", "sitzung ist abgelaufen", "erneut an", "sessão expirou", "entre de novo", "sessione scaduta",
    "effettuare di nuovo", "sessie is verlopen", "log opnieuw", "sesja wygasła", "zaloguj się ponownie", "сеанс истёк", "войдите снова", "会话已过期",
    "重新登录", "access denied", "not a robot", "acceso denegado", "accès refusé", "zugriff verweigert", "acesso negado", "accesso negato",
    "toegang geweigerd", "odmowa dostępu", "brak dostępu", "доступ запрещён", "доступ закрыт", "拒绝访问", "访问被拒绝", "due to maintenance",
    "temporarily unavailable", "no disponible por mantenimiento", "indisponible", "nicht verfügbar", "wartung", "manutenç", "manutenzione",
    "onderhoud", "prace konserwacyjne", "przerwa techniczna", "недоступ", "技术维护", "系统维护", "维护", "too many requests", "checking your browser",
    "has been moved or deleted", "page you are looking for", "could not find that", "something went wrong", "try again later", "fatal error",
    "no results for your query", "page demandée", "página solicitada", "página pedida", "angeforderte seite", "pagina richiesta", "gevraagde pagina",
    "żądanej strony", "запрошенная страница", "请求的页面", "requested document could not", "permission to view", "lorem ipsum", "dolor sit amet",
    "consectetur", "blindtext", "texto de ejemplo", "texto de exemplo", "testo di esempio", "testo di prova", "voorbeeldtekst", "tekst przykładowy",
    "пример текста", "образец текста", "示例文本", "占位", "replace this paragraph", "sustituya este párrafo", "remplacez ce paragraphe",
    "ersetzen sie diesen absatz", "substitua este parágrafo", "sostituire questo paragrafo", "vervang deze alinea", "zastąp ten akapit",
    "замените этот абзац", "请将本段替换", "content goes here", "short description of the section", "coming soon", "test test", "do not publish",
]
PATTERNS = re.compile(r"启用.{0,6}脚本|on line \d|texte d[’']exemple", re.I)
FORMS = re.compile(
    r"\{\{.*?\}?\}|\{%|%\}|<%|%>|\$!?\{\w|@@\w+@@|#[A-Z][A-Z_]+#|#N#|%[A-Z]{2,}[A-Z_ ]*%|__[A-Z]\w*__|<<[A-Z][A-Z_ ]*>>|\[\[\w[\w.]*\]\]|"
    r"\[(INSERT|TO BE|YOUR|Your|object) [^\]]*\]|(?<![A-Za-z0-9_])(?:undefined|NaN|XX/XX/XXXX)(?![A-Za-z0-9_])"
)
#: Signs without which no form matches but the three words at its end.
_form_sign = re.compile(r"[{%<$@#_\[]").search
_sentence = re.compile(r"([.!?…。！？])(?:(?<=[。！？])\s*|(?<=[.!?…])\s+(?=[^\W\d_]))").sub  # the sign comes first, so that it is searched for
_unspaced = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]").search
_word = re.compile(r"[一-鿿]|[^\W\d_一-鿿]+|\d+|[^\w\s]+|_+")


def sentences(text: str) -> list[tuple[str, bool]]:
    """(sentence without its quotations, whether it opens the text) of a text."""
    out: list[tuple[str, bool]] = []
    for line in text.split("\n"):
        line = unquoted(line)
        out += [(y, not out) for x in _sentence("\\1\n", line).split("\n") if (y := x.strip())]
    return out


@lru_cache(maxsize=1)
def _phrases() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for p in PHRASES:
        made.add_word(p, p)
    made.make_automaton()
    return made


def weak_label(sentence: str) -> bool:
    low = sentence.lower()
    return bool(
        next(_phrases().iter(low), None)
        or ("启用" in low or "on l" in low or "texte d" in low) and PATTERNS.search(sentence)
        or (_form_sign(sentence) or "undefined" in low or "nan" in low or "xx/" in low) and FORMS.search(sentence)
        or len(sentence) < 160 and STATUS.match(sentence)
    )


_script = re.compile(r"javascript|scripts?\b|脚本", re.I).search


def message(line: str) -> int:
    """2 for a line that the weak labels take for a message, filler or unfilled template, 1 for a notice that scripts are
    needed, which pages have around their text as well, else 0."""
    return 0 if not weak_label(line) else 1 if _script(line) else 2


_classes = {c: "0" for c in range(48, 58)}
_classes |= {c: ("a" if chr(c).islower() else "A") for c in range(0x530) if chr(c).isalpha()}
_squeeze = re.compile(r"([aA0汉])\1+")
_sign = re.compile(r"[^\w\s.,;:()–’'-]|_").search
_near_sign = re.compile(r"(?=(..?[^aA0汉 .,;:()–’'-].?.?))")
_beside_han = re.compile(r"汉[aA]+|[aA]+汉")
_han = re.compile("[一-鿿]+")


def shape(text: str) -> str:
    """Letters and digits become classes, runs of a class one character, signs stay."""
    s = text.translate(_classes)
    return _squeeze.sub(r"\1", s if s.isascii() else _han.sub("汉", s))


@lru_cache(maxsize=200_000)
def _hash(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass"))


def part_features(part: str) -> tuple[list[int], list[int]]:
    """(hashes of the words of what stands between two blanks, features of the shapes around its signs and of letters
    between Chinese characters)."""
    if part.isascii():  # a word, or one before a sign that has no shape
        if part.isalpha():
            return [_hash(part.lower())], []
        if part[-1] in ".,;:" and part[:-1].isalpha():
            return [_hash(part[:-1].lower()), _hash(part[-1])], []
    words = [_hash("0" if x[0].isdigit() else x) for x in _word.findall(part.lower())]
    signs: set[int] = set()
    if _sign(part):
        signs.update(_hash("\0" + x) for x in _near_sign.findall(shape(f" {part} ")))
    if not part.isascii() and _han.search(part):
        signs.update(_hash("\2" + x) for x in _beside_han.findall(shape(part)))
    return words, [x % FEATURES for x in signs]


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Reader:
    """Reads sentences as windows: for each, the features of its words, pairs of words and shapes, its length and place."""

    def __init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        """What stands between blanks, by number: its words and its other features, from where on and how many."""
        self.parts = Parts(self._part)
        self.said, self.starts, self.sizes, self.shapes, self.shape_starts, self.shape_sizes = (array("q") for _ in range(6))

    def _part(self, part: str) -> int:
        k = self.parts[part] = len(self.parts)
        for got, held, starts, sizes in zip(part_features(part), (self.said, self.shapes), (self.starts, self.shape_starts), (self.sizes, self.shape_sizes), strict=True):
            starts.append(len(held))
            sizes.append(len(got))
            held.extend(got)
        return k

    def windows(self, found: list[tuple[str, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(features, place of the word each belongs to, first and last word of each window, its sentence, its own
        feature) of (sentence, opens) rows."""
        if len(self.parts) > 300_000 or len(self.said) > 3_000_000:
            self._forget()
        part, counts, get = array("q"), [], self.parts.__getitem__
        for s, _ in found:
            parts = s.split()
            part.extend(map(get, parts))
            counts.append(len(parts))
        part = np.array(part, np.int64)
        said, starts, sizes, shapes, shape_starts, shape_sizes = (np.array(x, np.int64) for x in (self.said, self.starts, self.sizes, self.shapes, self.shape_starts, self.shape_sizes))
        own = sizes[part]
        begins = np.append(0, np.cumsum(own))
        w = said[_spans(starts[part], own)]
        n = np.diff(begins[np.append(0, np.cumsum(counts, dtype=np.int64))])
        of_shapes = shape_sizes[part]
        extra, where = shapes[_spans(shape_starts[part], of_shapes)], np.repeat(begins[:-1] + own // 2, of_shapes)
        first = np.cumsum(n) - n
        pairs = (w[:-1] * 0x9E3779B1 ^ w[1:] * 0x85EBCA6B) >> 7
        inner = np.ones(len(w), bool)
        inner[first[n > 0]] = False
        inner = np.flatnonzero(inner)  # words that follow one in the same sentence
        feats = np.concatenate([w, pairs[inner - 1] if len(inner) else w[:0], extra]) % FEATURES
        place = np.concatenate([np.arange(len(w)), inner, where])
        count = np.where(n > WINDOW, 1 + -(-(n - WINDOW) // STRIDE), (n > 0).astype(np.int64))
        sentence = np.repeat(np.arange(len(n)), count)
        step = np.arange(len(sentence)) - np.repeat(np.cumsum(count) - count, count)
        begin = first[sentence] + np.minimum(step * STRIDE, np.maximum(n[sentence] - WINDOW, 0))
        end = np.minimum(begin + WINDOW, first[sentence] + n[sentence])
        opens = np.array([o for _, o in found], bool)[sentence] if len(found) else np.zeros(0, bool)
        kinds = np.array([_hash(f"\1{size}{o}") % FEATURES for size in map(lambda k: max(k, 4), range(WINDOW + 1)) for o in (False, True)], np.int64)
        return feats, place, np.stack([begin, end], axis=1), sentence, kinds[2 * (end - begin) + opens] if len(begin) else begin


def _logits(w: np.ndarray, b: float, read: tuple) -> np.ndarray:
    """The logit of each window: the sum of its features' weights over the root of their number."""
    feats, place, span, _, kind = read
    if not len(span):
        return np.zeros(0)
    order = np.argsort(place, kind="stable")
    value = np.append(0.0, np.cumsum(w[feats[order]], dtype=np.float64))
    # a pair belongs to its second word, so the first word of a window brings none of those before it
    at = place[order]
    low, high = np.searchsorted(at, span[:, 0]), np.searchsorted(at, span[:, 1])
    return (value[high] - value[low] + w[kind]) / np.sqrt(high - low + 1) + b


class Block:
    """Some sentences as windows: their features in the order of the words, the range of features of each window, its own
    feature, whether it is residue by the weak labels, whether its host is held out, whether it is a whole sentence, and
    how often it counts."""

    def __init__(self, feats: np.ndarray, low: np.ndarray, high: np.ndarray, kind: np.ndarray, marks: np.ndarray, often: np.ndarray) -> None:
        self.feats, self.low, self.high, self.kind = (x.astype(np.int64) for x in (feats, low, high, kind))
        self.label, self.held, self.whole = ((marks >> i & 1).astype(bool) for i in range(3))
        self.often, self.scale = often.astype(np.float64), 1 / np.sqrt(self.high - self.low + 1)

    @staticmethod
    def read(keys: list[tuple[str, bool, int, str]], reader: Reader) -> list[np.ndarray]:
        """The arrays of the windows of (sentence, opens, times, host)."""
        feats, place, span, sentence, kind = reader.windows([k[:2] for k in keys])
        order = np.argsort(place, kind="stable")
        low, high = (np.searchsorted(place[order], span[:, i]) for i in range(2))
        count = np.bincount(sentence, minlength=len(keys))
        first = np.cumsum(count) - count
        label = np.zeros(len(span), bool)
        for i, (s, _, _, _) in enumerate(keys):
            if weak_label(s):
                if count[i] == 1:
                    label[first[i]] = True
                elif count[i]:
                    spots = [m.span() for m in _word.finditer(s)]
                    begin = span[first[i], 0]
                    for j in range(first[i], first[i] + count[i]):
                        label[j] = weak_label(s[spots[span[j, 0] - begin][0] : spots[span[j, 1] - begin - 1][1]])
        held = np.array([zlib.crc32(h.encode("utf-8", "surrogatepass")) % HELD_OUT == 0 for _, _, _, h in keys], bool)[sentence]
        often = np.array([min(n, 50) for _, _, n, _ in keys], np.uint8)[sentence]
        marks = label.astype(np.uint8) | held.astype(np.uint8) << 1 | (count[sentence] == 1).astype(np.uint8) << 2
        return [feats[order].astype(np.int32), low.astype(np.int32), high.astype(np.int32), kind.astype(np.int32), marks, often]

    @staticmethod
    def packed(arrays: list[np.ndarray]) -> bytes:
        """Arrays of ``read`` as one short string, since every pass carries it."""
        feats, low, high, kind, marks, often = arrays
        sizes = np.array([len(feats), len(low)], np.int32)
        held = (sizes, feats, np.diff(low, prepend=np.int32(0)), high - low, kind, marks, often)
        return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in held))

    @classmethod
    def unpacked(cls, held: bytes) -> Block:
        raw = zstandard.ZstdDecompressor().decompress(held)
        n, m = np.frombuffer(raw, np.int32, 2).tolist()
        feats, steps, sizes, kind = np.split(np.frombuffer(raw, np.int32, n + 3 * m, 8), [n, n + m, n + 2 * m])
        marks, often = np.split(np.frombuffer(raw, np.uint8, 2 * m, 8 + 4 * (n + 3 * m)), 2)
        low = np.cumsum(steps, dtype=np.int64)
        return cls(feats, low, low + sizes, kind, marks, often)

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Of weights and, last, the bias."""
        value = np.zeros(len(self.feats) + 1)
        np.cumsum(x[self.feats], out=value[1:])
        return (value[self.high] - value[self.low] + x[self.kind]) * self.scale + x[-1]


#: Where the kinds of ``_kinds`` stand among the marks of a block (bits: residue, held out, whole).
MARKS = [held << 1 | whole << 2 | label for held in (0, 1) for whole in (0, 1) for label in (0, 1)]


def _kinds(block: Block, _: None) -> list[np.ndarray]:
    """Windows by (whether the host is held out, whether a whole sentence, whether residue)."""
    return [np.bincount(block.held * 4 + block.whole * 2 + block.label, minlength=8)]


def _descents(block: Block, arg: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """How much all windows count, and the gradient, for the model of the hosts that are not held out, and of all: (weights
    and bias, how much the windows of each kind count) of each."""
    out = []
    for x, weight in arg:
        z = block.logits(x)
        c = block.often * weight[block.held * 4 + block.whole * 2 + block.label]
        g = c * (1 / (1 + np.exp(-z)) - block.label)
        own = g * block.scale
        n = len(block.feats) + 1
        each = np.cumsum(np.bincount(block.low, own, n) - np.bincount(block.high, own, n))[:-1]
        out.append(np.concatenate([[c.sum()], np.bincount(block.feats, each, FEATURES) + np.bincount(block.kind, own, FEATURES), [g.sum()]]))
    return out


def _counts(block: Block, x: np.ndarray) -> list[np.ndarray]:
    """Of the held-out windows, for each threshold: residue that is found, windows found, residue; and windows."""
    held = block.held
    p, y, often = 1 / (1 + np.exp(-block.logits(x)[held])), block.label[held], block.often[held]
    return [np.array([[often[(p >= t) & y].sum(), often[p >= t].sum(), often[y].sum(), len(p)] for t in STEPS])]


class Descent:
    """AdaGrad by whole passes: ``x`` are weights and, last, the bias.  Gradients are sums, and what one window brings is
    little evidence in a table of any size."""

    def __init__(self, n: int) -> None:
        self.x, self.acc = np.zeros(n), np.ones(n)
        self.x[-1] = BIAS

    def tell(self, gradient: np.ndarray, total: float) -> None:
        g = gradient + np.append(L2 * total * self.x[:-1], 0.0)
        g[-1] = 0.0  # what is made of unknown words is no residue, so the bias stays
        self.acc += g * g
        self.x -= RATE * g / np.sqrt(self.acc)


def _learned(run: Callable[[Callable, object], list[np.ndarray]]) -> tuple[np.ndarray, float, dict[str, float]]:
    """The model, of sums over all windows: ``run`` applies a pass to all blocks and adds up what it returns (nothing where
    there is none).

    Windows that are no residue (whole sentences, and windows of longer ones) are weighed down to PLAIN times the windows
    that are, so that the size of a corpus does not change the odds."""
    kinds = run(_kinds, None)
    if not kinds or not kinds[0].sum():
        return np.zeros(FEATURES, np.float32), -10.0, {"threshold": THRESHOLD}
    number = kinds[0].reshape(2, 2, 2).astype(float)  # held, whole, label
    weights = []
    for some in (number[:1].sum(0), number.sum(0)):
        plain = np.minimum(1.0, PLAIN * max(some[:, 1].sum(), 1.0) / np.maximum(some[:, 0], 1.0))
        weights.append(np.stack([plain, np.full(2, POSITIVE)], axis=1).ravel())
    weights = [np.append(weights[0], np.zeros(4)), np.append(weights[1], weights[1])]
    seen, final = descents = [Descent(FEATURES + 1), Descent(FEATURES + 1)]
    for _ in range(PASSES):
        for d, got in zip(descents, run(_descents, [(d.x, w) for d, w in zip(descents, weights, strict=True)]), strict=True):
            d.tell(got[1:], got[0])
    counts = run(_counts, seen.x)[0] if number[0].sum() else np.zeros((len(STEPS), 4))
    return final.x[:-1].astype(np.float32), float(final.x[-1]), _measures(counts)


def _measures(counts: np.ndarray) -> dict[str, float]:
    measures = {"threshold": THRESHOLD, "windows": float(counts[0, 3]), "precision": 0.0, "recall": 0.0}
    if counts[0, 3]:
        # a text has many windows, so precision counts twice; among equals the one nearest to the default
        best = [(round(1.25 * hit / max(said + 0.25 * true, 1), 3), -abs(t - THRESHOLD), t, hit / max(said, 1), hit / max(true, 1)) for t, (hit, said, true, _) in zip(STEPS, counts.tolist(), strict=True)]
        _, _, t, precision, recall = max(best)
        measures |= {"threshold": round(float(t), 2), "precision": float(precision), "recall": float(recall)}
    return measures


def fit(rows: list[tuple[str, str]], furniture: list[tuple[str, str]] = ()) -> tuple[np.ndarray, float, dict[str, float]]:
    """(weights, bias, measures on unseen hosts) of (text, host) rows, by logistic regression with AdaGrad, besides lines
    around texts, with their hosts, which are negatives where they carry no weak label.

    The hosts whose hash is divisible by HELD_OUT are held out to choose the threshold and to measure precision and recall
    against the weak labels; then the final model is trained on all rows."""
    times: Counter = Counter()
    host_of: dict[tuple[str, bool], str] = {}
    for text, host in rows:
        for key in sentences(text):
            times[key] += 1
            host_of[key] = min(host_of.get(key, host), host)
    for s in {s for line, _ in furniture for s, _ in sentences(line)}:
        if not weak_label(s):
            times[(s, False)] += 1
            host_of.setdefault((s, False), s)
    keys = sorted((s, opens, n, host_of[(s, opens)]) for (s, opens), n in times.items())
    reader = Reader()
    blocks = [Block(*Block.read(keys[at : at + PART], reader)) for at in range(0, len(keys), PART)]
    return _learned(lambda f, arg: [sum(x) for x in zip(*(f(b, arg) for b in blocks), strict=True)])


def fitted(df: DataFrame, text_col: str, url_col: str, furniture_col: str | None = None) -> tuple[np.ndarray, float, dict[str, float]]:
    """As ``fit``, of all sentences of all texts, and of the lines of ``furniture_col``, which stood around them.

    Different sentences are told apart by Spark and their features stored once; each pass sums the gradient over all of
    them, so that a message counts alike however many sentences there are.  A task holds some sentences, the driver sums."""
    spark = df.sparkSession
    host = F.coalesce(F.regexp_extract(url_col, r"^[^:/?#]+://([^/?#]*)", 1), F.lit(""))
    rows = df.select(F.col(text_col).cast("string").alias("t"), host.alias("h"), (F.col(furniture_col) if furniture_col else F.lit(None)).cast("string").alias("f"))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times: Counter = Counter()
            around: set[str] = set()
            for t, h, f in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if t:
                    times.update((s, o, h) for s, o in sentences(t))
                if f:
                    around.update(s for x in set(f.split("\n")) for s, _ in sentences(x))
            out = [(s, o, h, n, 0) for (s, o, h), n in times.items()] + [(s, False, None, 0, 1) for s in around if not weak_label(s)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int64()))], names=["s", "o", "h", "n", "f"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            for at in range(0, batch.num_rows, PART):
                got = Block.read(list(zip(*(c.to_pylist() for c in batch.slice(at, PART).columns), strict=True)), reader)
                kinds = np.bincount(got[4], minlength=8)
                yield pa.RecordBatch.from_arrays([pa.array([Block.packed(got)], pa.binary()), pa.array([kinds.tolist()], pa.list_(pa.int64()))], names=["block", "marks"])

    found = rows.mapInArrow(told, "s string, o boolean, h string, n bigint, f bigint")
    keys = found.groupBy("s", "o").agg((F.sum("n") + F.max("f")).alias("n"), F.coalesce(F.min("h"), F.col("s")).alias("h"))
    blocks = stored(keys.mapInArrow(read, "block binary, marks array<bigint>"))

    def run(f: Callable, arg: object) -> list[np.ndarray]:
        if f is _kinds:  # these were counted when the blocks were made
            got = blocks.agg(*[F.sum(F.col("marks")[i]).alias(str(i)) for i in range(8)]).first()
            return [np.array(got)[MARKS]] if got[0] is not None else []
        sent = spark.sparkContext.broadcast(arg)

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: list[np.ndarray] = []
            for batch in batches:
                for held in batch.column(0):
                    new = f(Block.unpacked(held.as_buffer()), sent.value)
                    total = [a + b for a, b in zip(total, new, strict=True)] if total else new
            if total:
                yield sums(total)

        def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: list[np.ndarray] = []
            for batch in batches:
                for x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    new = [np.frombuffer(v, k.split(":")[0]).reshape([int(n) for n in k.split(":")[1].split(",")]) for v, k in zip(x, y, strict=True)]
                    total = [a + b for a, b in zip(total, new, strict=True)] if total else new
            if total:
                yield sums(total)

        def sums(total: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([[x.tobytes() for x in total]], pa.list_(pa.binary())), pa.array([[f"{x.dtype.str}:" + ",".join(map(str, x.shape)) for x in total]], pa.list_(pa.string()))], names=["sums", "shapes"])

        schema = "sums array<binary>, shapes array<string>"
        got = blocks.select("block").mapInArrow(summed, schema).repartition(1).mapInArrow(together, schema).first()  # the driver gets one sum
        sent.unpersist()
        return [np.frombuffer(x, k.split(":")[0]).reshape([int(n) for n in k.split(":")[1].split(",")]) for x, k in zip(got.sums, got.shapes, strict=True)] if got else []

    return _learned(run)


class Judge:
    def __init__(self, w: np.ndarray, b: float) -> None:
        self.w, self.b, self.reader = w.astype(np.float64), b, Reader()

    def probabilities(self, texts: list[str]) -> list[tuple[float, str]]:
        """(highest probability of a window, the sentence it is in) of each text."""
        # a lone word is a name or the rest of a sentence, but not where its script has no blanks or it is a message itself
        found = [[x for x in sentences(t) if not (x[0].rstrip(".").isalpha() and not _unspaced(x[0]) and not weak_label(x[0]))] for t in texts]
        flat = [x for f in found for x in f]
        read = self.reader.windows(flat)
        z = _logits(self.w, self.b, read)
        best = np.full(len(flat), -np.inf)
        np.maximum.at(best, read[3], z)
        out, at = [], 0
        for f in found:
            own = best[at : at + len(f)]
            k = int(own.argmax()) if len(own) else -1
            out.append((float(1 / (1 + np.exp(-own[k]))), flat[at + k][0]) if k >= 0 and own[k] > -np.inf else (0.0, ""))
            at += len(f)
        return out

    def probability(self, text: str) -> tuple[float, str]:
        return self.probabilities([text])[0]


def judged(df: DataFrame, model: tuple, id_col: str, text_col: str) -> DataFrame:
    """id, residue, probability and sentence (the one that decides) of every row with a text.

    Null and empty texts are no cases and have no row; repeated rows give one row; whole texts are read; an empty table
    gives an empty result; other columns are not read."""
    sent = df.sparkSession.sparkContext.broadcast((model[0], model[1]))
    threshold = model[2].get("threshold", THRESHOLD) if len(model) > 2 else THRESHOLD
    texts = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text")).where(F.trim("text") != "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = None
        for batch in batches:
            use = use or Judge(*sent.value)
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                got = use.probabilities(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([g[0] >= threshold for g in got]), pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.string())], names=["id", "residue", "probability", "sentence"])

    return texts.mapInArrow(run, "id bigint, residue boolean, probability double, sentence string").distinct()
