"""Problem 4: languages of documents and lines."""

import pytest
from pyspark.sql import functions as F

from indexloom.llm import language
from indexloom.llm.common import table

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def samples(spark):
    return [(r.lang, r.text) for r in table(spark, DATA, "lang_samples").collect()]


@pytest.fixture(scope="module")
def model(samples):
    return language.train([x for i, x in enumerate(samples) if i % 4], n=250, steps=40)


def test_held_out_accuracy(samples, model):
    held = [x for i, x in enumerate(samples) if i % 4 == 0]
    got = language.Tagger(model).shares([[t] for _, t in held])
    assert sum(model.langs[int(s.sum(0).argmax())] == k for (k, _), (s, _) in zip(held, got)) >= 0.97 * len(held)


def test_marginals_sum_to_one(model):
    import numpy as np

    rng = np.random.default_rng(0)
    emit = rng.random((5, 3, len(model.langs))).astype(np.float32)
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], bool)
    emit[~mask] = 1
    post = language._chain(emit, np.zeros((5, 3), bool), mask, model)[0]
    assert np.allclose(post.sum(-1), 1, atol=1e-4)
    # against the sum over all paths of the shortest chain
    a, e = np.exp(model.inside), emit[:2, 2] * np.stack([np.exp(model.start), np.ones(len(model.langs))])
    joint = e[0][:, None] * a * e[1][None, :]
    assert np.allclose(post[0, 2], joint.sum(1) / joint.sum(), atol=1e-3) and np.allclose(post[1, 2], joint.sum(0) / joint.sum(), atol=1e-3)


def test_nothing_to_learn_from(spark):
    got = language.document_languages(spark.createDataFrame([(1, "text")], "id bigint, t string"), language.train([]), "id", "t").first()
    assert (got.lang, got.confidence) == ("und", 1.0)


def test_mixed_lines(spark, model, samples):
    by = {}
    for k, t in samples:
        by.setdefault(k, []).append(t.replace("\n", " "))
    mixed = f"{by['en'][0]}\n\n{by['ru'][0]}\n12\n{by['es'][0]}"
    quoted = f"{by['en'][1]} (see “{' '.join(by['fr'][0].split()[:4])}”)\n{by['en'][2]}"
    df = spark.createDataFrame([(1, mixed, "x"), (1, mixed, "x"), (2, quoted, "x"), (3, None, None), (4, "\n", "x"), (5, by["en"][0], None), (None, mixed, "x")], "id bigint, t string, lang string")
    got = {(r.id, r.line_no): r for r in language.line_languages(df, model, "id", "t").collect()}
    assert {k: v.lang for k, v in got.items() if k[0] == 1} == {(1, 0): "en", (1, 2): "ru", (1, 3): got[(1, 3)].lang, (1, 4): "es"}
    assert {k[0] for k in got} == {1, None} and all(0 <= r.confidence <= 1 for r in got.values())
    assert language.line_languages(df.limit(0), model, "id", "t").count() == 0
    every = language.line_languages(df, model, "id", "t", mixed_only=False)
    assert {r.id for r in every.collect()} == {1, 2, 5, None} and every.where("id = 2 AND mixed").count() == 0


def test_documents(spark, model, samples):
    k, t = samples[0]
    df = spark.createDataFrame([(1, t, "a"), (1, t, "a"), (2, "1234", None), (3, "", None), (4, None, None), (5, (t + " ") * 200, None)], "doc_id bigint, text string, lang string")
    got = {r.id: r for r in language.document_languages(df, model, "doc_id", "text").collect()}
    assert set(got) == {1, 5} and got[1].lang == k and 0 <= got[1].confidence <= 1
    assert language.document_languages(df.limit(0), model, "doc_id", "text").count() == 0
    assert set(language.document_languages(df, model, "doc_id", "text", carry="lang").columns) == {"id", "lang", "confidence", "carried"}


@pytest.mark.parametrize(("label", "code"), [("EN", "en"), (" en", "en"), ("en_XX", "en"), ("es-AR", "es"), ("deu", "de"), ("ger", "de"), ("English", "en"), ("cs", "cs"), ("unknown", None), ("n/a", None), ("??", None), ("", None), (None, None), ("und", None)])
def test_labels(spark, label, code):
    got = spark.createDataFrame([(label,)], "x string").select(language.named_language(F.col("x"))).first()[0]
    assert got == code


def test_long_chinese_runs_are_read_whole():
    head, tail = "数据控制者不得出售个人信息法官命令", "除外主管部门每年复核"
    assert set(language.features(head)) < set(language.features(head + tail)) and len(language.features("字" * 30 + "据")) == 3
