"""Scalar columns: addresses, keys, normalising, parsing, vectors, banding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from indexloom import seeds


def host_of(url: Column) -> Column:
    """Authority of an address, with user and port; empty where there is none."""
    return F.coalesce(F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1), F.lit(""))


def slug(text: Column) -> Column:
    """Lower case, only letters a-z, digits and hyphens, blanks as hyphens."""
    kept = F.regexp_replace(F.trim(F.lower(text)), r"[^a-z0-9\s-]", "")
    return F.regexp_replace(kept, r"\s+", "-")


def linear_score(raw: Column, most: float = 100.0) -> Column:
    """0..``most`` onto 1..5, clipped, to four places."""
    return F.round(F.greatest(F.lit(1.0), F.least(F.lit(5.0), raw / most * 4 + 1)), 4)


def decimal_of(text: Column) -> Column:
    """A number written with a decimal comma or point; null if it is none."""
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double")


def year_of(date_text: Column) -> Column:
    """Year of a date written year first; null if there is none."""
    return F.nullif(F.regexp_extract(date_text, r"^(\d{4})", 1), F.lit("")).cast("int")


def or_default(value: Column, default: float) -> Column:
    """``value``, or the default for null and zero."""
    return F.coalesce(F.nullif(value, F.lit(0).cast("double")), F.lit(default))


def mapped(key: Column, table: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]


def cache_key(*parts: Column, chars: int = 24) -> Column:
    """Hash of the parts, as cache tables are keyed."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, chars)


def list_key(items: Column) -> Column:
    """One string of a list, whatever its order."""
    return F.array_join(F.array_sort(items), "|")


def banded(value: Column, bands: list[tuple[float, str]]) -> Column:
    """Label of the highest lower bound that ``value`` reaches (bounds fall); null stays null."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, label in bands:
        out = out.when(value >= bound, label) if bound != float("-inf") else out.otherwise(label)
    return out


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine similarity; null where a vector is zero or lengths differ.  Norms may be given, made once a row."""
    length = (norm(a) if norm_a is None else norm_a) * (norm(b) if norm_b is None else norm_b)
    return F.when((F.size(a) == F.size(b)) & (length > 0), dot(a, b) / F.nullif(length, F.lit(0.0)))


def without_fences(text: Column) -> Column:
    """A JSON answer without the code fence around it."""
    return F.trim(F.regexp_replace(F.trim(text), r"(?s)^```[A-Za-z]*\s*|\s*```$", ""))


def json_object(text: Column) -> Column:
    """A parsed JSON answer (variant); null where it is none, also after mending trailing commas and single quotes."""
    plain = without_fences(text)
    mended = F.regexp_replace(F.regexp_replace(plain, r",\s*([}\]])", "$1"), r"(?<=[\[{,:])\s*'([^']*)'|'([^']*)'\s*(?=[:,}\]])", "\"$1$2\"")
    return F.coalesce(F.try_parse_json(plain), F.try_parse_json(mended))


def has_no_signal(fields: Column, keys: list[str] | None = None) -> Column:
    """Whether every field (JSON text) is null, an empty list or an empty string; ``keys``: the fields that count."""
    values = F.from_json(fields, "map<string,string>")
    if keys is not None:
        values = F.map_filter(values, lambda k, _: k.isin(keys))
    return F.coalesce(F.forall(F.map_values(values), lambda v: v.isNull() | v.isin("", "[]")), F.lit(True))


def search_string(query: Column, sites: Column, file_type: Column) -> Column:
    """The query with each site: and filetype: that it does not hold yet, in any case."""
    lower = F.lower(query)
    missing = F.filter(F.coalesce(sites, F.array().cast("array<string>")), lambda s: ~lower.contains(F.concat(F.lit("site:"), F.lower(s))))
    ending = F.when(file_type.isNotNull() & ~lower.contains("filetype:"), F.concat(F.lit("filetype:"), F.lower(file_type)))
    return F.concat_ws(" ", query, F.transform(missing, lambda s: F.concat(F.lit("site:"), s)), ending)


def file_type_hint(text: Column) -> Column:
    upper = F.upper(text)
    return F.when(upper.contains("PDF"), "pdf").when(upper.contains("HTML"), "html")


def confidence_weight(confidence: Column, weighted: bool = True) -> Column:
    return F.coalesce(mapped(confidence, seeds.CONFIDENCE), F.lit(seeds.DEFAULT_CONFIDENCE)) if weighted else F.lit(1.0)


def titled(name: Column) -> Column:
    """A snake-case name as a title."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def search_language(lang: Column, region: Column) -> Column:
    """Language code for a search: Chinese needs its script."""
    return F.when(F.lower(lang) == "zh", F.when(F.upper(region).isin("TW", "HK", "MO"), "zh-TW").otherwise("zh-CN")).otherwise(lang)


def language_or_known(lang: Column, probability: Column, known: Column) -> Column:
    """The detected language; the first known one where it is none of them and its probability is below 0.80."""
    first = F.try_element_at(known, F.lit(1))
    other = ~F.coalesce(F.exists(known, lambda x: x.eqNullSafe(lang)), F.lit(False))
    return F.when(first.isNotNull() & (first != "") & other & (probability < 0.80), first).otherwise(lang)


def filled(template: str, **columns: Column) -> Column:
    """A prompt: ``{name}`` in the template stands for a column, null for nothing; ``{{`` and ``}}`` are braces."""
    import string

    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(F.coalesce(columns[name].cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def shared(values: Column, others: list) -> Column:
    """The distinct values that are among the others too, in the order of the values; null for null."""
    return F.array_intersect(values, F.array(*map(F.lit, others)))
