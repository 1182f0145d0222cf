"""Problem 9: subjects of documents."""

import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest

from indexloom.llm import subjects

TOPICS = {"health": ["hospital wards", "medical records", "patient charts", "vaccination lists"], "finance": ["bank accounts", "tax returns", "loan contracts", "credit scores"], "sport": ["football clubs", "match tickets", "doping samples", "stadium entry"]}
GENERAL = ["The controller must encrypt the access files under the act of the year.", "Each processor shall notify the authority without undue delay after a breach.", "A public body may retain such records where the purpose has not lapsed."]


def sentence(rng, topic):
    a, b = rng.sample(TOPICS[topic], 2)
    return rng.choice([f"The rules on {a} apply to {b} in the town.", f"Every file on {a} or {b} carries a code.", f"Inspectors found that {a} were kept with {b} for days."])


def document(rng, topics, n=5):
    return " ".join(rng.sample([sentence(rng, t) for t in topics for _ in range(n)] + rng.choices(GENERAL, k=5), len(topics) * n + 5))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    docs = [(document(rng, [t]), frozenset([t])) for t in TOPICS for _ in range(25)] + [(document(rng, list(TOPICS)[:2]), frozenset()) for _ in range(10)]
    return subjects.fit(docs, [("en", s) for s in GENERAL] + [("en", sentence(rng, t)) for t in TOPICS])


def test_held_out(model):
    rng = random.Random(2)
    for topics in (["health"], ["finance"], ["sport"], ["health", "sport"]):
        for _ in range(10):
            got = model.assign(subjects.sentences(document(rng, topics)))
            assert {t for t in TOPICS if got.count(t) >= 3} == set(topics)


def test_svd_finds_the_leading_space():
    rng = np.random.default_rng(0)
    a = (rng.standard_normal((60, 5)) @ rng.standard_normal((5, 40))).astype(np.float32)
    v = subjects.truncated_svd(a, 5)
    assert np.allclose(a @ v @ v.T, a, atol=1e-2)


def test_operator_edges(spark, model):
    rng = random.Random(3)
    d = document(rng, ["health"])
    rows = [(1, d, "x"), (1, d, "x"), (2, None, None), (3, "", "x"), (4, sentence(rng, "health"), "x"), (5, (d + " ") * 60, "x"), (None, d, "x"), (6, "Hospital wards\nMedical records\nPatient charts\n" * 3, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, subject_code string")
    got = {(r.id, r.subject_code) for r in subjects.subjects(df, model).collect()}
    assert got == {(1, "health"), (5, "health"), (None, "health")}
    assert subjects.subjects(df.limit(0), model).count() == 0
    assert subjects.fit([], []).assign(["Any text at all."]) == [None]


def test_all_documents_are_read(spark):
    # more documents than the 600 without a label that were read, half of them with words of their own
    rng = random.Random(4)
    docs = [(i, document(rng, [t]), t) for i, t in enumerate(t for t in TOPICS for _ in range(20))]
    docs += [(1_000 + i, " ".join(f"The clerks of ward{i % 100} {rng.choice(['count', 'weigh', 'sort'])} every parcel and stamp." for _ in range(3)), None) for i in range(1_000)]
    lines = [("en", s) for s in GENERAL] + [("en", sentence(rng, t)) for t in TOPICS]
    df = spark.createDataFrame([d[:2] for d in docs], "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(i, t) for i, _, t in docs if t] * 2, "doc_id bigint, subject_code string")
    got = subjects.fitted(df, labels, spark.createDataFrame(lines, "lang string, text string"))
    own = subjects.fit([(text, frozenset([t] if t else [])) for _, text, t in docs], lines)
    assert got.index == own.index and got.subjects == own.subjects
    sents = [sentence(rng, t) for t in TOPICS for _ in range(5)]
    assert got.assign(sents) == own.assign(sents) == [t for t in TOPICS for _ in range(5)]


def test_stored_documents_give_the_subjects_of_their_texts(spark):
    # the numbers that the model was learned from are used again, so no text is split twice more
    rng = random.Random(5)
    docs = [(i, document(rng, [t]), t) for i, t in enumerate(t for t in TOPICS for _ in range(20))]
    rows = [d[:2] for d in docs] + [(None, docs[0][1]), (0, docs[0][1]), (900, ""), (901, None), (902, sentence(rng, "health")), (903, "12. 13!")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(i, t) for i, _, t in docs], "doc_id bigint, subject_code string")
    samples = spark.createDataFrame([("en", s) for s in GENERAL] + [("en", sentence(rng, t)) for t in TOPICS], "lang string, text string")
    model, stored = subjects.learned(df, labels, samples)
    got = sorted(map(str, subjects.of_learned(model, stored).collect()))
    assert got == sorted(map(str, subjects.subjects(df, model).collect())) and len(got) >= 61
    assert subjects.learned(df.limit(0), labels, samples)[1] is None


def test_gram_products_of_languages_apart():
    rng = np.random.default_rng(6)
    sizes = [rng.integers(0, 6, 4).astype(np.int32) for _ in range(300)]
    block = subjects.Block([[]] * 300, [rng.integers(0, 50, int(n.sum())).astype(np.uint16).tobytes() for n in sizes], [n.tobytes() for n in sizes], [rng.integers(0, 3, 4).astype(np.uint8).tobytes() for _ in sizes])
    idf, q = rng.random(50).astype(np.float32) + 0.1, rng.standard_normal((50, 4)).astype(np.float32)
    doc = np.repeat(block.doc, block.sizes)
    counts = np.bincount(doc * 50 + block.ids, minlength=300 * 50).reshape(300, 50)
    a = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-9)
    assert np.allclose(subjects._gram_pass(block, (q, idf))[0], a.T @ (a @ q), atol=1e-3)


def test_words_are_read_once(monkeypatch):
    """What stands between two blanks is read once in each of the two counts, however many sentences hold it."""
    read = []
    plain = subjects.terms
    monkeypatch.setattr(subjects, "terms", lambda x: read.append(x) or plain(x))
    docs = [("The court heard the case. A judge ruled on it.\nShips left port; 法院审理案件。 Ships came.", frozenset({"law"}))] * 40
    subjects.fit(docs, [])
    assert read and max(Counter(read).values()) <= 2


def test_sentence_ends_as_before():
    """Ends are found from their sign; the sentences are those of the ends told from behind."""
    end = re.compile(r"(?<=[.!?…])\s+(?=[^\W\d_a-zа-я]|[§«“\"(„])|(?<=[。！？])\s*|\n+")
    rng = random.Random(3)
    for _ in range(5_000):
        text = unicodedata.normalize("NFC", "".join(rng.choice("aBЯяñ .!?…。！？\n\t\x85　一«“\"(„§12_’") for _ in range(rng.randrange(40))))
        assert subjects.sentences(text) == [s for x in end.split(text) if x and (s := x.strip()) and s[-1] in ".!?…。！？»”\")"]


def test_terms_by_parts_are_those_of_the_sentence():
    for s in ("L’État, c’est moi 国家法院 ok.", "ΛΟΓΟΣ ΟΔΟΣ. 한국 법원", "x-y's 12a_b 法a院", ""):
        get = subjects.Parts(tuple).__getitem__
        assert [t for p in s.lower().split() for t in get(p)] == subjects.terms(s)
