"""Text columns: cleaning, markup, sections, gates.  All but markup and newline-aware chunks stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexloom import seeds

#: White space as Unicode has it, with the separators U+001C to U+001F.
BLANKS = r"(?U)[\s\x1c-\x1f]+"
BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def clean_text(text: Column, keep_breaks: bool = False) -> Column:
    """No NULs, runs of blanks as one, ends trimmed; with ``keep_breaks`` line by line, empty lines dropped."""
    text = F.regexp_replace(text, "\x00", "")
    if keep_breaks:
        lines = F.transform(F.split(text, BREAKS), lambda x: F.trim(F.regexp_replace(x, BLANKS, " ")))
        return F.array_join(F.filter(lines, lambda x: x != ""), "\n")
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def long_enough(text: Column, least: int = 200) -> Column:
    """The text, or null below ``least`` characters."""
    return F.when(F.length(text) >= least, text)


def content_type_of(header: Column, url: Column, body: Column | None = None) -> Column:
    """Kind of a fetched file by its header, else its address, else its first bytes, else html."""
    h, u = F.lower(header), F.lower(F.regexp_replace(url, r"[?#].*$", ""))
    by_header = F.when(h.contains("pdf"), "pdf").when(h.contains("wordprocessingml") | h.contains("docx"), "docx").when(h.contains("msword"), "doc").when(h.contains("html"), "html")
    by_url = F.when(u.endswith(".pdf"), "pdf").when(u.endswith(".docx"), "docx").when(u.endswith(".doc"), "doc").when(u.endswith(".html") | u.endswith(".htm"), "html")
    kinds = [by_header, by_url]
    if body is not None:
        start = F.hex(F.substring(body, 1, 4))
        kinds.append(F.when(start == "25504446", "pdf").when(start == "504B0304", "docx").when(start == "D0CF11E0", "doc"))
    return F.coalesce(*kinds, F.lit("html"))


class _Visible(HTMLParser):
    """Text outside the dropped elements, whatever they hold and however they nest."""

    DROPPED = frozenset({"script", "style", "nav", "footer", "header", "noscript"})

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.parts: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.DROPPED:
            self.open.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not self.open and data.strip():
            self.parts.append(data.strip())


def visible_text(html: str | None) -> str | None:
    if html is None:
        return None
    reader = _Visible()
    reader.feed(html)
    reader.close()
    return " ".join(reader.parts)


def html_text(df: DataFrame, html_col: str, out_col: str = "text") -> DataFrame:
    """All columns and the visible text of ``html_col``, by Arrow batches; null stays null."""
    kept = [c for c in df.columns if c != out_col]
    schema = df.select(*[df[c] for c in kept]).withColumn(out_col, F.lit(None).cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(h) for h in batch.column(batch.schema.get_field_index(html_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out_col])

    return df.select(*[df[c] for c in kept]).mapInArrow(run, schema)


def _parts(text: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(text, pattern, -1), lambda x: F.regexp_replace(x, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")), lambda x: x != "")


def marked_parts(text: Column, marks: list[str]) -> Column:
    """Trimmed, non-blank parts of a text between line starts that match one of ``marks``; the marks are dropped."""
    return _parts(text, "(?md)^(?:" + "|".join(marks) + ")")


def equal_parts(text: Column, size: int = seeds.CHUNK) -> Column:
    """Parts of ``size`` characters of a text without line breaks; blank ones are dropped."""
    n = F.ceil(F.length(text) / size).cast("int")
    cuts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(cuts, lambda i: F.trim(F.substring(text, i * size + 1, size))), lambda x: x != "")


def line_parts(text: str, size: int = seeds.CHUNK) -> list[str]:
    """Parts of at most ``size`` characters, cut at the last line break of each window, which stays with the next."""
    out, start = [], 0
    while start < len(text):
        end = start + size
        if end < len(text) and (at := text.rfind("\n", start, end)) > start:
            end = at
        if part := text[start:end].strip():
            out.append(part)
        start = end
    return out


def sections(df: DataFrame, text_col: str, lang_col: str | None = None, keep: list[str] = (), least: int = seeds.LEAST_SECTIONS, size: int = seeds.CHUNK, with_breaks: bool = True) -> DataFrame:
    """One row a section: ``keep``, section_index (from 0), header, text and tier_used.

    Tier 1 cuts at marks that hold in any language, tier 2 at the article label of the text's language, each if it gives
    ``least`` parts; else tier 3 cuts by size.  A text without a line break takes the closed form inside the JVM, one
    with breaks is folded in Python; ``with_breaks=False`` leaves that branch out for texts known to have none.
    """
    text = F.col("__text")
    one = marked_parts(text, seeds.SECTION_MARKS)
    two = F.array().cast("array<string>")
    if lang_col:
        for code, label in seeds.ARTICLE_LABELS.items():
            two = F.when(F.lower(F.col("__lang")) == code, marked_parts(text, [label])).otherwise(two)
    base = df.select(*[df[c] for c in keep], df[text_col].alias("__text"), (df[lang_col] if lang_col else F.lit(None).cast("string")).alias("__lang"))
    tiers = base.withColumn("__one", one).withColumn("__two", two)
    chosen = tiers.withColumn("tier_used", F.when(F.size("__one") >= least, "tier1").when(F.size("__two") >= least, "tier2").otherwise("tier3"))
    marked = chosen.where("tier_used <> 'tier3'").select(*keep, "tier_used", F.posexplode(F.when(F.col("tier_used") == "tier1", F.col("__one")).otherwise(F.col("__two"))).alias("section_index", "text"))
    rest = chosen.where("tier_used = 'tier3'").select(*keep, "tier_used", "__text")
    flat = rest if not with_breaks else rest.where(F.instr("__text", "\n") == 0)
    out = marked.unionByName(flat.select(*keep, "tier_used", F.posexplode(equal_parts(text, size)).alias("section_index", "text")))
    if with_breaks:
        broken = rest.where(F.instr("__text", "\n") > 0)
        schema = broken.select(*keep, "tier_used", F.lit(0).alias("section_index"), F.lit("").alias("text")).schema

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [line_parts(t, size) for t in batch.column(batch.num_columns - 1).to_pylist()]
                row = pa.array([i for i, p in enumerate(found) for _ in p], pa.int64())
                columns = [batch.column(i).take(row) for i in range(batch.num_columns - 1)]
                columns += [pa.array([k for p in found for k in range(len(p))], pa.int32()), pa.array([x for p in found for x in p], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "section_index", "text"])

        out = out.unionByName(broken.mapInArrow(fold, schema))
    return out.select(*keep, "section_index", header_of(F.col("text")).alias("header"), "text", "tier_used")


def header_of(text: Column) -> Column:
    """First line, trimmed; null where that is empty."""
    return F.nullif(F.trim(F.substring_index(text, "\n", 1)), F.lit(""))


def is_noise(text: Column) -> Column:
    """Empty, a structural noise pattern in a line, or mostly short lines."""
    pattern = "(?imUd)" + "|".join(f"(?:{p})" for p in seeds.NOISE)
    lines = F.split(F.regexp_replace(text, f"(?:{BREAKS})$", ""), BREAKS)
    short = F.size(F.filter(lines, lambda x: F.length(F.trim(x)) < seeds.SHORT_CHARS))
    mostly_short = (F.size(lines) >= seeds.SHORT_LINES) & (short > seeds.SHORT_SHARE * F.size(lines))
    return F.coalesce((text == "") | text.rlike(pattern) | mostly_short, F.lit(True))


def has_signal(text: Column, words: list[str] = seeds.SIGNAL_WORDS, stems: list[str] = seeds.SIGNAL_STEMS, parts: list[str] = seeds.SIGNAL_PARTS) -> Column:
    """Whether a whole word, a word's beginning or a part of an unspaced script is among the signal terms.

    One alternation for each of the two scans, with boundaries that other engines' patterns can express too."""
    edge = r"[^\p{L}\p{N}_]"
    pattern = rf"(?iu)(^|{edge})(?:(?:{'|'.join(words)})($|{edge}){'|(?:' + '|'.join(stems) + ')' if stems else ''})"
    found = text.rlike(pattern)
    return F.coalesce(found | text.rlike("|".join(parts)) if parts else found, F.lit(False))


def gate(text: Column, least: int = 100, signal: bool = True, **terms: list[str]) -> Column:
    """'short', 'noise', 'no-signal' or 'pass': the first gate that a section does not pass."""
    out = F.when(F.coalesce(F.length(text), F.lit(0)) < least, "short").when(is_noise(text), "noise")
    return (out.when(~has_signal(text, **terms), "no-signal") if signal else out).otherwise("pass")


def detected_language(text: Column, chars: int = 2000) -> Column:
    """language and probability by the first ``chars`` characters: the share of the language's frequent words among those of
    all languages; Cyrillic words and Chinese characters (of which three count as much as a word each) tell by script.
    Without any of them, and for null, 'unknown' with probability 0; ties go to the code that comes first."""
    words = F.regexp_extract_all(F.lower(F.substring(text, 1, chars)), F.lit("([a-zà-öø-ÿąćęłńśźżœß]+|[а-яё]+|[一-鿿])"), F.lit(1))

    def held(known: list[str]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(known)))

    found = {k: held(v) for k, v in seeds.STOP_WORDS.items()}
    found["ru"] = F.size(F.filter(words, lambda w: w.rlike("^[а-яё]")))
    found["zh"] = 3 * F.size(F.filter(words, lambda w: w.rlike("[一-鿿]")))
    scores = F.array(*[F.struct(n.alias("n"), F.lit(-i).alias("first"), F.lit(k).alias("k")) for i, (k, n) in enumerate(sorted(found.items()))])
    best, total = F.array_max(scores), F.aggregate(scores, F.lit(0), lambda a, x: a + x["n"])
    known = text.isNotNull() & (best["n"] > 0)
    return F.struct(F.when(known, best["k"]).otherwise("unknown").alias("language"), F.when(known, best["n"] / total).otherwise(0.0).alias("probability"))
