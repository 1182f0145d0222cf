"""Problems 2 and 6: furniture of pages, residue and messages."""

import re

import numpy as np
import pytest

from indexloom.llm import boilerplate, residue

LEGAL = [
    "The controller shall notify the supervisory authority of each breach without delay.",
    "Every file on medical records or patient charts carries the code {n}.",
    "Inspectors in Sekeberg found that tax returns were kept with bank accounts for {n} days.",
    "Article {n}",
    "a) hospitals;",
]
NAV = ["Home", "About us", "Site map", "Contact", "Legislation"]
FOOT = ["(c) All rights reserved. 2020 Example Office", "Privacy notice | Accessibility | Terms of use"]


def page(i, teaser=False):
    body = [x.format(n=i) for x in LEGAL]
    extra = ["You may also like", f"New ruling on soil samples – {LEGAL[0]}"] if teaser else ["Share this page"]
    return "\n".join(["We use cookies to improve your visit.", *NAV, f"Decision number {i} of the office", *body[:2], *extra, *body[2:], *FOOT])


@pytest.fixture(scope="module")
def weights():
    others = ["\n".join([f"Decision number {i} of the office", *[x.format(n=i) for x in LEGAL]]) + "\nThe ruling on soil samples stands for the holder." for i in range(60)]
    return boilerplate.fit([page(i, i % 2 == 0) for i in range(60)], others)


def test_all_pages_count(spark):
    pages = [(page(i) + ("\nVolver arriba" if i % 600 == 0 else ""), "html") for i in range(8_000)]
    others = ["\n".join([f"Decision number {i} of the office", *[x.format(n=i) for x in LEGAL]]) for i in range(6_000)]
    df = spark.createDataFrame(pages + [(x, "pdf") for x in others], "t string, kind string")
    got = boilerplate.fitted(df, "t", "kind")
    assert "^ volver arriba" in got.odds  # 14 pages of 8,000
    want = boilerplate.fit([t for t, _ in pages], others)
    assert (got.odds, got.legal, got.known) == (want.odds, want.legal, want.known)


@pytest.mark.parametrize("teaser", [False, True])
def test_furniture(weights, teaser):
    text = page(77, teaser)
    lines = text.split("\n")
    found = {lines[i] for i in boilerplate.Scanner(weights).furniture(text)}
    want = {"We use cookies to improve your visit.", *NAV, *FOOT, *(["You may also like", f"New ruling on soil samples – {LEGAL[0]}"] if teaser else ["Share this page"])}
    assert found == want


def test_quotes_blanks_and_messages(weights):
    scan = boilerplate.Scanner(weights)
    quoting = f"{LEGAL[0]} The text says “We use cookies to improve your visit.” in its second part."
    assert scan.furniture(f"Home\n\n{quoting}\nSite map") == [0, 3]
    assert scan.furniture("Home\nAbout us\nAccess is denied.\nSite map") == [0, 1, 3]
    assert scan.furniture("") == [] and scan.furniture("\n \n") == []


def test_page_operator_edges(spark, weights):
    rows = [(1, page(5), "html", "u"), (1, page(5), "html", "u"), (2, None, "html", "u"), (3, "", "html", None), (4, page(6), "pdf", "u"), (None, page(7), "html", "u"), (5, page(8) + "\nword" * 60_000, "html", "u")]
    df = spark.createDataFrame(rows, "content_id bigint, t string, kind string, text string")
    got = boilerplate.furniture_lines(df.where("kind = 'html'"), weights, "content_id", "t")
    assert {r.id for r in got.collect()} == {1, None, 5} and got.where("id = 1").count() == len(set(boilerplate.Scanner(weights).furniture(page(5))))
    main = {r.id: r.text for r in boilerplate.main_text(df, weights, "content_id", "t", "kind").collect()}
    assert "Home" not in main[1] and main[2] is None and main[3] == "" and main[4] == page(6)
    assert boilerplate.furniture_lines(df.limit(0), weights, "content_id", "t").count() == 0
    assert boilerplate.main_text(df.limit(0), weights, "content_id", "t", "kind").count() == 0
    assert boilerplate.Scanner(boilerplate.fit([], [])).furniture("a\nb") == []  # nothing learned: all is body


MESSAGES = ["404 Not Found", "Your session has expired. Sign in again to continue.", "Please enable JavaScript to view this page.", "Lorem ipsum dolor sit amet consectetur", "Error 500 – Internal Server Error", "Texto de ejemplo texto de ejemplo.", "Service temporarily unavailable due to maintenance until 03.04.2020."]
FILLED = ["The {{country_name}} of the office", "carries the code ${amount} of Act 5", "the [INSERT LAW TITLE] holds", "in @@authority@@ of the", "the undefined NaN of"]


@pytest.fixture(scope="module")
def judge():
    good = [("\n".join(x.format(n=i) for x in LEGAL), f"h{i % 17}.example") for i in range(150)]
    bad = [(m, f"h{i}.example") for i in range(6) for m in MESSAGES] + [(f"{LEGAL[0]}\n{f} {i}.", f"h{i}.example") for i in range(12) for f in FILLED]
    w, b, measures = residue.fit(good + bad)
    assert measures["precision"] > 0.9 and measures["recall"] > 0.9  # on hosts that were not trained on
    return w, b


def test_residue(judge):
    use = residue.Judge(*judge)
    for text in [*MESSAGES, *(f"{LEGAL[1]}\n{f} 99." for f in FILLED)]:
        assert use.probability(text)[0] >= residue.THRESHOLD, text
    for text in ["\n".join(x.format(n=404) for x in LEGAL), f"{LEGAL[0]} The page says “404 Not Found” to all.", "The file […] of Bosto [sic] carries the code 404.", ""]:
        assert use.probability(text)[0] < residue.THRESHOLD, text


def test_residue_of_letters_only():
    bad = ["拒绝访问", "系统维护中", "示例文本示例文本", "undefined", "NaN"]
    good = [("\n".join(x.format(n=i) for x in [*LEGAL, "数据控制者不得出售个人信息", "个人信息保护办法"]), f"h{i % 17}.example") for i in range(150)]
    w, b, _ = residue.fit(good + [(m, f"h{i}.example") for i in range(12) for m in bad])
    use = residue.Judge(w, b)
    for text in bad:
        assert use.probability(text)[0] >= residue.THRESHOLD, text
    assert use.probability("个人信息保护办法")[0] < residue.THRESHOLD and use.probability("Sekeberg.") == (0.0, "")


def test_residue_operator_edges(spark, judge):
    rows = [(1, MESSAGES[0], 1.0), (1, MESSAGES[0], 1.0), (2, None, None), (3, " ", 0.0), (4, (LEGAL[0] + " ") * 3_000, 0.0), (None, MESSAGES[1], 0.0)]
    df = spark.createDataFrame(rows, "content_id bigint, body string, probability double")
    got = {r.id: r for r in residue.judged(df, judge, "content_id", "body").collect()}
    assert set(got) == {1, 4, None} and got[1].residue and not got[4].residue and got[None].residue
    assert residue.judged(df.limit(0), judge, "content_id", "body").count() == 0
    assert residue.fit([])[1] < 0


def test_placeholders_beside_chinese_and_in_long_sentences(judge):
    assert residue.weak_label("药店与XX/XX/XXXX个人信息法") and residue.weak_label("条undefined款") and not residue.weak_label("undefinedness")
    use = residue.Judge(*judge)
    long = " ".join([LEGAL[0].rstrip("."), "and", LEGAL[2].format(n=3).rstrip(".")] * 6)
    assert use.probability(f"{long} for {{{{country_name}}}} of the office {long}.")[0] >= residue.THRESHOLD
    assert use.probability(f"{long} for Sekeberg of the office {long}.")[0] < residue.THRESHOLD


def test_messages_stay_and_lost_letters_are_matched(weights):
    scan = boilerplate.Scanner(weights, residue.message)
    assert scan.furniture("We use cookies to improve your visit.\nHome\nPlease enable JavaScript to view this page.\nSite map") == [0, 1, 3]
    lines = [*NAV, "Lorem ipsum dolor sit amet", LEGAL[0], *FOOT]
    assert scan.furniture("\n".join(lines)) == [0, 1, 2, 3, 4, 7, 8]
    accents = boilerplate.fit(["\n".join(["Publicações", "Notícias", x.format(n=i)]) for i in range(60) for x in LEGAL[:2]], [x.format(n=i) for i in range(60) for x in LEGAL[:3]])
    assert boilerplate.Scanner(accents).furniture(f"Publica��es\nNot�cias\n{LEGAL[0]}") == [0, 1]


def test_residue_is_learned_from_all_texts(spark, monkeypatch):
    # long texts without rare signs, of which a sample of 2,500 was read; one word in them marks residue
    rows = [(f"The controller number {i} must encrypt the records of the office in the town of Sekeberg.", f"h{i % 40}.example") for i in range(6_000)]
    rows += [(f"Lorem ipsum dolor sit amet {i} consectetur.", f"h{i % 40}.example") for i in range(60)]
    df = spark.createDataFrame([(t, f"https://{h}/a", "Home\nAll news") for t, h in rows], "t string, u string, f string")
    w, b, measures = residue.fit(rows, [("Home", "Home"), ("All news", "All news")])
    got_w, got_b, got = residue.fitted(df.repartition(5), "t", "u", "f")
    assert np.allclose(got_w, w, atol=1e-5) and abs(got_b - b) < 1e-6 and got == measures
    assert got["windows"] > 20_000 / residue.HELD_OUT and got["recall"] > 0.9
    monkeypatch.setattr(residue, "PART", 1_000)
    several = residue.fitted(df, "t", "u", "f")
    use = residue.Judge(*several[:2])
    assert several[2]["windows"] == got["windows"] and use.probability(rows[-1][0])[0] >= several[2]["threshold"] > use.probability(rows[0][0])[0]


def test_residue_counts_alike_in_large_tables(spark, monkeypatch):
    # messages that many pages hold are few different sentences; models of parts that were averaged lost them
    plain = [(f"The controller number {i} must encrypt the records of the office in the town of Sekeberg{i % 900}.", f"h{i % 40}.example") for i in range(6_000)]
    rows = plain + [(m, f"h{i}.example") for i in range(40) for m in MESSAGES]
    df = spark.createDataFrame([(t, f"https://{h}/a") for t, h in rows], "t string, u string").repartition(4)
    monkeypatch.setattr(residue, "PART", 400)
    w, b, measures = residue.fitted(df, "t", "u")
    use = residue.Judge(w, b)
    for text in MESSAGES:
        assert use.probability(text)[0] >= measures["threshold"], text
    assert use.probability(plain[7][0])[0] < measures["threshold"]


def test_weak_labels_are_those_of_the_patterns():
    for text in ["Fatal error ON LINE 12", "texte d’exemple", "请启用浏览器脚本", "{{x}}", "{% if %}", "<% x %>", "${a}", "$a b", "@@a@@", "#N#", "%NAME%", "__A__", "<<A B>>", "[[a.b]]", "[INSERT x]", "an undefined b", "NaN", "XX/XX/XXXX", "nan", "Error 404", "see error 404", "404 Not Found", "the online line"]:
        want = any(p in text.lower() for p in residue.PHRASES) or residue.PATTERNS.search(text) or residue.FORMS.search(text) or residue.STATUS.search(text)
        assert residue.weak_label(text) == bool(want), text


def test_windows_are_stored_short_and_words_read_once(monkeypatch):
    """A pass carries blocks of sentences as one short string; what stands between two blanks is read once."""
    read = []
    plain = residue.part_features
    monkeypatch.setattr(residue, "part_features", lambda x: read.append(x) or plain(x))
    keys = [(f"The {{{{customer.name.of.this.template}}}} of Tisodal n° {i % 7}, 个人信息 ABC, no more than that and nothing else at all.", i % 2 == 0, 1 + i, f"h{i % 9}") for i in range(300)]
    got = residue.Block.read(keys, residue.Reader())
    assert len(read) == len(set(read))
    held = residue.Block.packed(got)
    one, two = residue.Block(*got), residue.Block.unpacked(held)
    assert len(held) < sum(x.nbytes for x in got) / 4
    x = np.random.default_rng(0).standard_normal(residue.FEATURES + 1)
    assert one.logits(x).tolist() == two.logits(x).tolist() and one.often.tolist() == two.often.tolist()
    assert residue._kinds(two, None)[0].tolist() == np.bincount(got[4], minlength=8)[residue.MARKS].tolist() == residue._kinds(one, None)[0].tolist()


def test_sentences_end_as_before():
    end = re.compile(r"(?<=[.!?…])\s+(?=[^\W\d_])|(?<=[。！？])\s*")
    rng = np.random.default_rng(1)
    for _ in range(5_000):
        line = "".join(rng.choice(list("aBЯ .!?…。！？\t　一12_’"), rng.integers(40)))
        assert [s for s, _ in residue.sentences(line)] == [y for x in end.split(line) if (y := x.strip())]
