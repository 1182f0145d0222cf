"""Problem 5: near-duplicates against brute force."""

import itertools
import random
import re

from indexloom.llm import neardup


def brute(rows, n, threshold):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        if s := {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}:
            sets[i] = s
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        base = rng.choices(words, k=rng.randint(20, 80))
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.randint(0, 3)):
            other = base[:]
            for _ in range(rng.randint(0, 5)):
                other[rng.randrange(len(other))] = rng.choice(words)
            rows.append((len(rows), " ".join(other).upper() if rng.random() < 0.3 else " ".join(other) + "!"))
    return rows + [(1000 + i, "the same text under many ids") for i in range(30)]


def test_pairs_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows + rows[:5], "id bigint, text string")
    got = neardup.pairs_of_ids(*neardup.near_duplicates(df, "id", "text", words=3, threshold=0.7))
    assert {(r.id_a, r.id_b) for r in got.collect()} == brute(rows, 3, 0.7)


def test_groups_are_components(spark):
    rows = corpus(2)
    members, links = neardup.near_duplicates(spark.createDataFrame(rows, "id bigint, text string"), "id", "text", words=3, threshold=0.7)
    got = {r.id: r for r in neardup.groups(members, links).collect()}
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in brute(rows, 3, 0.7):
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    assert {i: r.group_id for i, r in got.items()} == {i: root(i) for i in got} and len(got) == len(rows)
    assert {r.class_id for i, r in got.items() if i >= 1000} == {1000}


def test_long_chain_of_links(spark):
    n = 40
    members = spark.createDataFrame([(i, i) for i in range(n)], "id bigint, class_id bigint")
    links = spark.createDataFrame([(i, i + 1, 0.9) for i in range(n - 1)], "class_a bigint, class_b bigint, similarity double")
    assert {r.group_id for r in neardup.groups(members, links).collect()} == {0}


def test_edges(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "two words", 1), (4, "two words", 1), (None, "a b c d", 1), (5, "a b c d", 1), (6, "A, b c D", 1), (7, "z " * 60_000, 1), (8, "z " * 60_000, 2)]
    df = spark.createDataFrame(rows, "id bigint, t string, text int")
    got = neardup.pairs_of_ids(*neardup.near_duplicates(df, "id", "t", words=3, threshold=0.7))
    assert {tuple(r) for r in got.collect()} == {(5, 6), (7, 8)}
    empty = neardup.near_duplicates(df.limit(0), "id", "t")
    assert neardup.pairs_of_ids(*empty).count() == 0 and neardup.groups(*empty).count() == 0


def test_signature_agreement_estimates_jaccard():
    import numpy as np

    use = neardup.Sketcher(3, 400, 1)
    rng = np.random.default_rng(3)
    both = rng.integers(0, 1 << 63, 300).astype(np.uint64) * np.uint64(2)
    a, b = np.unique(both[:240]), np.unique(both[60:])
    k = use.band_keys([a, b])
    assert abs((k[0] == k[1]).mean() - 180 / 300) < 0.08


def test_long_texts_without_common_words_are_no_candidates():
    import numpy as np

    use = neardup.Sketcher(3, 36, 5)
    keys = use.band_keys([neardup.shingle_hashes(np.arange(k * 10**6, k * 10**6 + 200_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 3) for k in range(8)])
    assert all(len(set(keys[:, b].tolist())) == 8 for b in range(36))


def test_long_chains_end_in_one_group(spark):
    n = 3_000
    members = spark.range(n).selectExpr("id", "id AS class_id")
    links = spark.range(n - 1).selectExpr("id AS class_a", "id + 1 AS class_b", "0.9D AS similarity")
    got = neardup.groups(members, links)
    assert got.where("group_id = 0").count() == n and got.where("n_links = 2").count() == n - 2
