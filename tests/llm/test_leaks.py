"""Problem 8: leaked passages against brute force."""

import random

from indexloom.llm import leaks


def brute(docs, items, n):
    grams = {}
    for i, t in items:
        w = leaks.words(t)
        for k in range(len(w) - n + 1):
            grams.setdefault(tuple(w[k : k + n]), set()).add(i)
    found = set()
    for d, t in docs:
        w = leaks.words(t)
        for k in range(len(w) - n + 1):
            found |= {(d, i) for i in grams.get(tuple(w[k : k + n]), ())}
    return found


def test_exact_equals_brute_force(spark):
    rng = random.Random(4)
    words = [f"t{i}" for i in range(60)]  # few words, so that chance hits are many
    items = [(i, " ".join(rng.choices(words, k=rng.randint(5, 60)))) for i in range(30)]
    docs = []
    for d in range(300):
        w = rng.choices(words, k=rng.randint(0, 120))
        if rng.random() < 0.5:
            src = rng.choice(items)[1].split()
            a = rng.randrange(len(src))
            part = src[a : a + rng.randint(3, 40)]
            if rng.random() < 0.3 and len(part) > 4:
                part[len(part) // 2] = "gap"
            k = rng.randrange(len(w) + 1)
            w = w[:k] + part + w[k:]
        docs.append((d, " ".join(w)))
    got = leaks.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items + items[:3], "item_id bigint, text string"), window=12)
    rows = got.collect()
    assert {(r.doc_id, r.item_id) for r in rows if r.kind == "exact"} == brute(docs, items, 12)
    assert all(r.longest_run >= 12 for r in rows if r.kind == "exact") and all(r.longest_run == 0 for r in rows if r.kind == "proximity")


def test_words():
    assert leaks.words("Café № 5, ÉTÉ_x") == ["cafe", "5", "ete", "x"] and leaks.words(None) == [] and leaks.words("café") == ["cafe"]


def test_edges(spark):
    item = " ".join(f"word{i}" for i in range(30))
    near = " ".join(f"word{i}" if i % 6 else "other" for i in range(30))
    rows = [(1, item, 0), (1, item, 0), (2, None, 0), (3, "", 0), (None, item, 0), (4, "x " * 50_000 + item, 0), (5, near, 0), (6, " ".join(item.split()[:24]), 0)]
    rows += [(10 + i, "word0 word6 word12 word18 word24", 0) for i in range(5)]  # so that the words that differ are not the rarest
    docs = spark.createDataFrame(rows, "doc_id bigint, body string, item_id int")
    items = spark.createDataFrame([(7, item, "t"), (8, "too short", "t"), (9, None, "t"), (None, item, "t")], "item_id bigint, text string, body string")
    got = {r.doc_id: r for r in leaks.leaks(docs, items, doc_text="body").collect()}
    assert {d for d, r in got.items() if r.kind == "exact"} == {1, 4} and got[1].longest_run == 30 and got[1].item_id == 7
    assert got[5].kind == "proximity" and set(got) <= {1, 4, 5, 6}
    assert leaks.leaks(docs.limit(0), items, doc_text="body").count() == 0 and leaks.leaks(docs, items.limit(0), doc_text="body").count() == 0


def planted(seed=9):
    """Documents of Zipf-like words, half of them with an item of which every tenth word is another, dropped or doubled."""
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(3_000)]
    weight = [1 / (i + 5) for i in range(3_000)]
    items = [(i, " ".join(rng.choices(words, weight, k=rng.randint(30, 70)))) for i in range(40)]
    docs, true = [], set()
    for d in range(400):
        w = rng.choices(words, weight, k=rng.randint(20, 200))
        if d % 2:
            i, text = rng.choice(items)
            part = [y for x in text.split() for y in ([x] if rng.random() > 0.1 else rng.choice([[rng.choice(words)], [], [x, x]]))]
            k = rng.randrange(len(w) + 1)
            w = w[:k] + part + w[k:]
            true.add((d, i))
        docs.append((d, " ".join(w)))
    return docs, items, true


def test_near_matches_are_found_by_one_index(spark, monkeypatch):
    docs, items, true = planted()
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    made = []
    index = leaks.positional_index
    monkeypatch.setattr(leaks, "positional_index", lambda *a: made.append(1) or index(*a))
    rows = leaks.leaks(d, i).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert len(got & true) >= 0.9 * len(true) and len(got & true) >= 0.9 * len(got)
    monkeypatch.setattr(leaks, "ITEM_BLOCK", 7)  # six blocks, and every term is stored
    monkeypatch.setattr(leaks, "TERMS", 10)
    assert sorted(map(tuple, leaks.leaks(d, i).collect())) == sorted(map(tuple, rows)) and len(made) == 2
