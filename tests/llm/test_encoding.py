"""Problem 1: wrong decodings are undone, right text stays."""

import pytest

from indexloom.llm import encoding

LINES = {
    "fr": ["Les règles sur caméras routières s’appliquent à péages à Tisodal.", "Décision relative à plaques d’immatriculation à Tisodal", "L’autorité de contrôle doit notifier les données personnelles après une évaluation documentée."],
    "es": ["Las normas sobre órdenes de detención se aplican a salas de pruebas en Lova.", "Según el § 2 de la Ley, el responsable no podrá divulgar los ficheros seudonimizados.", "Legislación y publicación oficial"],
    "pl": ["Każdy operator ma obowiązek usunąć każdy profil pochodny, zgodnie z § 2 ustawy.", "Przepisy z działu obejmują zwolnienia lekarskie, jeżeli wniosek złożono na piśmie.", "Strona główna"],
    "ru": ["Дела имеют код 354, надзорное ведомство обязано сообщить про договоры.", "Статья 2. Оператор данных не вправе раскрывать особые категории.", "Новости"],
    "zh": ["数据控制者不得出售个人信息，见第449号公告，如以书面提出请求。", "检查单位须说明理由后使用同意书。", "首页"],
    "en": ["The controller must encrypt personal data, under § 142 of Act 1946/2011, where the purpose has lapsed.", "“All rights reserved” – see notice no. 5241.", "Published on 02.03.2014"],
}


@pytest.fixture(scope="module")
def model():
    texts = ["\n".join(v) for v in LINES.values()] * 4
    return encoding.fit([(k, x) for k, v in LINES.items() for x in v for _ in range(3)], texts)


@pytest.fixture(scope="module")
def coder(model):
    return encoding.Coder(*model)


@pytest.mark.parametrize(("lang", "written", "read"), [("fr", "utf-8", "cp1252"), ("es", "utf-8", "latin-1"), ("pl", "utf-8", "cp1250"), ("ru", "utf-8", "cp1252"), ("ru", "cp1251", "latin-1"), ("zh", "utf-8", "latin-1"), ("zh", "gb18030", "latin-1"), ("es", "utf-8", "mac-roman"), ("fr", "utf-8", "cp437"), ("pl", "cp1250", "cp1252"), ("ru", "koi8-r", "cp1251")])
def test_round_trip(coder, lang, written, read):
    text = "\n".join(LINES[lang])
    bad = encoding.CODECS[read].decode(encoding.CODECS[written].encode(text)) if written != "utf-8" else encoding.CODECS[read].decode(text.encode())
    fixed, chains, lost = coder.repair(bad)
    assert fixed == text and chains and not lost


@pytest.mark.parametrize(("written", "read"), [("cp1250", "cp1252"), ("iso8859-2", "latin-1")])
def test_lines_that_fit_the_alphabet_of_another_language(model, written, read):
    alphabets = model[1] | {"fr": model[1]["fr"] + "êëæñ¿", "pl": model[1]["pl"] + "ąćęłńóśźż"}
    lines = ["Pielęgniarki piszę rejestr w każdym urzędzie.", "Sędziowie piszę rejestr w każdym urzędzie."]
    pl = "\n".join([*LINES["pl"], *lines]).encode()
    coder = encoding.Coder(model[0] | {"pl": pl}, alphabets)
    bad = [encoding.CODECS[read].decode(encoding.CODECS[written].encode(x)) for x in lines]
    assert all(set(encoding._high(x)) <= set(alphabets["fr"]) for x in bad)  # clean as they stand
    assert coder.repair("\n".join(bad))[0] == "\n".join(lines)


def test_twice_and_some_lines(coder):
    text = LINES["fr"][0]
    once = encoding.CODECS["cp1252"].decode(text.encode())
    twice = encoding.CODECS["cp1252"].decode(once.encode())
    assert coder.repair(twice + "\n" + LINES["fr"][1])[0] == text + "\n" + LINES["fr"][1]
    assert coder.repair(f"{LINES['fr'][1]}\r\n{once}\r")[0] == f"{LINES['fr'][1]}\r\n{text}\r"


@pytest.mark.parametrize("text", ["\n".join(v) for v in LINES.values()] + ["ÉCOLE DES ÂGES", "permis d’émission", "学校", "", "plain", "«SÃO» “MANHÔ", "What?? No."])
def test_right_text_stays(coder, text):
    fixed, chains, lost = coder.repair(text)
    assert (fixed, chains, lost) == (text, [], 0)


def test_lost_characters():
    assert encoding.lost("c�maras") and encoding.lost("est?? claro y dilaci??n") and not encoding.lost("Really? Yes?") and not encoding.lost("see http://a/b?c=d")


def test_operator_edges(spark, model):
    bad = encoding.CODECS["cp1252"].decode(LINES["es"][0].encode())
    rows = [(1, bad, "x"), (1, bad, "x"), (2, None, None), (3, "", "x"), (None, bad, None), (4, "long " * 40_000 + bad, "y"), (5, "ASCII only", "y")]
    df = spark.createDataFrame(rows, "content_id bigint, extracted_text string, text string")
    got = encoding.repaired(df, model, "content_id", "extracted_text").collect()
    by = {r.id: r for r in got}
    assert len(got) == 6 and by[1].text == LINES["es"][0] and by[1].garbled and by[None].garbled and by[4].garbled
    assert by[2].text is None and not by[2].garbled and by[3].text == "" and not by[5].garbled
    assert encoding.repaired(df.limit(0), model, "content_id", "extracted_text").count() == 0
    assert encoding.repaired(df, model, "content_id", "extracted_text", carry=["text"]).columns[-1] == "carried_text"


def test_all_texts_are_counted(spark):
    # more texts than the sample of 2,000 had, a few of them with a sign that no labelled line has, and copies, which count once
    texts = [f"{LINES['fr'][i % 3]}\nFiche {i}" for i in range(6_000)]
    texts[5_990:] = [f"Le cœur du dossier {i} relève de la même autorité." for i in range(10)]
    labelled = [(k, x) for k, v in LINES.items() for x in v]
    samples = spark.createDataFrame(labelled * 2, "lang string, text string")
    corpus = spark.createDataFrame([(t,) for t in [*texts, *texts[:500]]], "t string")
    got = encoding.fitted(samples, corpus.repartition(5), "lang", "text", "t")
    assert got == encoding.fit(labelled, texts)
    assert "œ" in got[1]["fr"]
