"""Cleaning, markup, sections and gates."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indexloom.functions import scalars, text


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize(("raw", "clean"), [("  a\x00b \t\n c  ", "ab c"), ("", ""), ("  x　y\x1c", "x y"), (None, None)])
def test_clean(spark, raw, clean):
    assert one(spark, text.clean_text, raw) == clean


def test_clean_keeps_breaks(spark):
    assert one(spark, lambda c: text.clean_text(c, keep_breaks=True), " a  b \r\n\n c\t") == "a b\nc"


def test_visible_text_drops_nested_elements():
    page = "<html><header>H</header><nav>a<nav>b</nav>c</nav><main><p>One <b>two</b></p><noscript>n</noscript><script>1 < 2</script>&amp; three</main><footer>f"
    assert text.visible_text(page) == "One two & three"
    assert text.visible_text("") == "" and text.visible_text(None) is None and text.visible_text("no tags <") == "no tags <"


def test_html_text_keeps_columns_and_nulls(spark):
    df = spark.createDataFrame([(1, "<p>x</p>", "old"), (2, None, None)], "id int, html string, text string")
    assert {(r.id, r.text) for r in text.html_text(df, "html").collect()} == {(1, "x"), (2, None)}
    assert text.html_text(df.limit(0), "html").count() == 0


def test_tiers(spark):
    df = spark.createDataFrame(
        [(1, "Art. 1 a\nx\nArt. 2 b\nArt. 3 c", "en"), (2, "Artículo 1\nUno\nArtículo 2\nDos\nArtículo 3\nTres", "es"), (3, "prose " * 1000, "en"), (4, "", "en"), (5, None, "en"), (6, "line\n" * 900, "xx")],
        "id int, t string, lang string",
    )
    got = text.sections(df.where("t IS NOT NULL"), "t", "lang", keep=["id"]).collect()
    by = {i: sorted(((r.section_index, r.header, r.text, r.tier_used) for r in got if r.id == i)) for i in range(1, 7)}
    assert [x[:3] for x in by[1]] == [(0, "a", "a\nx"), (1, "b", "b"), (2, "c", "c")] and {x[3] for x in by[1]} == {"tier1"}
    assert [x[2] for x in by[2]] == ["Uno", "Dos", "Tres"] and {x[3] for x in by[2]} == {"tier2"}
    assert len(by[3]) == 3 and {x[3] for x in by[3]} == {"tier3"} and not by[4] and not by[5]
    assert len(by[6]) > 1 and all(len(x[2]) <= 2000 for x in by[6])


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \n", max_size=300), st.integers(5, 40))
def test_line_parts_lose_nothing_but_blanks(t, size):
    parts = text.line_parts(t, size)
    assert "".join("".join(parts).split()) == "".join(t.split())
    assert all(0 < len(p) <= size for p in parts)


@pytest.mark.parametrize("noise", ["a ..... 5", "TABLE OF CONTENTS", "1", "42", "-----", "=====", "© 2021 X", "Page 3 of 12", "This page has been archived", "\n".join(["x"] * 8 + ["y" * 80] * 2), "", None])
def test_noise(spark, noise):
    assert one(spark, text.is_noise, noise) is True


@pytest.mark.parametrize("plain", ["a\nb\nc", "the © data belongs to all", "The controller shall keep the register of processing for five years."])
def test_no_noise(spark, plain):
    assert one(spark, text.is_noise, plain) is False


@pytest.mark.parametrize(
    ("t", "found"),
    [("on Personal Data", True), ("a fine.", True), ("anonymised files", True), ("PRIVACY", True), ("Die Überwachung endet", True), ("关于个人数据的规定", True), ("metadata", False), ("mandate", False), ("Penalties", False), ("the tax rate", False), ("", False), (None, False)],
)
def test_signal(spark, t, found):
    assert one(spark, text.has_signal, t) is found


def test_gate_order(spark):
    assert one(spark, text.gate, "short") == "short"
    assert one(spark, text.gate, "1 " * 80) == "noise"
    assert one(spark, text.gate, "The tax rate of the year is set by the assembly in its session of spring and holds for all until it ends.") == "no-signal"
    assert one(spark, lambda c: text.gate(c, signal=False), "The tax rate of the year is set by the assembly in its session of spring and holds for all until it ends.") == "pass"


def test_content_type(spark):
    df = spark.createDataFrame([("application/pdf", "x", b""), (None, "http://a/b.DOCX?x=1", b""), (None, "http://a/b", b"%PDF-1"), (None, None, b"")], "h string, u string, b binary")
    assert [r[0] for r in df.select(text.content_type_of(F.col("h"), F.col("u"), F.col("b"))).collect()] == ["pdf", "docx", "pdf", "html"]


def test_language_or_known(spark):
    rows = [("ca", 0.5, ["es", "eu"]), ("ca", 0.8, ["es"]), ("eu", 0.5, ["es", "eu"]), ("unknown", 0.0, ["es"]), ("ca", 0.5, []), ("ca", 0.5, None)]
    df = spark.createDataFrame(rows, "lang string, p double, known array<string>")
    got = [r[0] for r in df.select(scalars.language_or_known(F.col("lang"), F.col("p"), F.col("known"))).collect()]
    assert got == ["es", "ca", "eu", "es", "ca", "ca"]
