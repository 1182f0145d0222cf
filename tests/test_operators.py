"""Merging, upserts, caches, discovery, retrieval, resolution, vectors, sources and streaming."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indexloom.functions import scalars
from indexloom.operators import discovery, evidence, merge, resolve, retrieval, upsert
from indexloom.sources import config, providers, readers, sinks
from indexloom.streaming import incremental


def test_merge(spark):
    df = spark.createDataFrame([(1, 2, ["b", "a"], None, "x"), (1, 1, ["a", None], "DPA", ""), (1, 3, None, "late", "y"), (2, 1, None, None, None)], "d int, i int, l array<string>, s string, n string")
    got = {r.d: r for r in merge.merged(df, ["d"], "i", lists=["l"], scalars=["s"], notes="n").collect()}
    assert (got[1].l, got[1].s, got[1].n) == (["a", "b"], "DPA", "[§2] x | [§3] y")
    assert (got[2].l, got[2].s, got[2].n) == ([], None, None)
    many = spark.range(3_000).select(F.lit(1).alias("d"), F.col("id").alias("i"), F.array((F.col("id") % 7).cast("string")).alias("l"), F.lit("n").alias("n"))
    one = merge.merged(many, ["d"], "i", lists=["l"], notes="n").first()  # a hot group, over several parts
    assert one.l == [str(i) for i in range(7)] and one.n.split(" | ") == [f"[§{i}] n" for i in range(3_000)]
    assert merge.merged(df, ["d"], "i", objects=["l"]).where("d = 1").first().l == ["a", None, "b", "a"]


def test_promoted_and_combined(spark):
    df = spark.createDataFrame([('{"a": 1, "b": true}',), ("broken",), (None,)], "j string")
    assert [(r.a, r.b) for r in merge.promoted(df, "j", {"a": "int", "b": "boolean"}).collect()] == [(1, True), (None, None), (None, None)]
    two = spark.createDataFrame([('{"k": "1", "notes": "x"}', '{"k": "2", "notes": "y"}')], "a string, b string").select(merge.combined_fields(F.col("a"), F.col("b")).alias("m")).first().m
    assert two == {"k": "2", "notes": "x | y"}


def test_upsert(spark):
    t = spark.createDataFrame([(1, "a", "keep"), (None, "n", "keep")], "k int, v string, w string")
    s = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (2, "d", 1), (None, "m", 1)], "k int, v string, q int")
    once = upsert.upsert(t, s, ["k"], ["v"], ["q"])
    assert {tuple(r) for r in once.collect()} == {(1, "c", "keep"), (2, "d", None), (None, "m", "keep")}
    assert {tuple(r) for r in upsert.upsert(once, s, ["k"], ["v"], ["q"]).collect()} == {tuple(r) for r in once.collect()}
    loose = upsert.upsert(t, s, ["k"], ["v"], ["q"], nulls_distinct=True)
    assert sorted(r.v for r in loose.collect() if r.k is None) == ["m", "n"]
    assert upsert.upsert(t.limit(0), s.limit(0), ["k"], ["v"], ["q"]).count() == 0


def test_versions_cache_and_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.write_version(spark.range(3), path)
    upsert.write_version(spark.range(5), path)
    assert upsert.read_version(spark, path).count() == 5
    cache = spark.sql("SELECT * FROM VALUES ('a', 1, timestamp'2024-01-01 00:00:00'), ('a', 2, timestamp'2024-01-02 00:00:00'), ('b', 3, timestamp'2023-01-01 00:00:00') x(k, v, at)")
    req = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    got = upsert.cache_hits(req, cache, "k", F.lit("2024-01-03 00:00:00").cast("timestamp"), 86_400 * 30, "v", "at")
    assert {(r.k, r.v, r.hit) for r in got.collect()} == {("a", 2, True), ("b", None, False), ("c", None, False)}
    assert upsert.with_columns(req, {"n": ("int", 7), "k": ("string", "z")}).first().n == 7
    assert upsert.appended_if_absent(spark.createDataFrame([(["x"],), (None,)], "a array<string>"), "a", F.lit("x")).collect() == [(["x"],), (["x"],)]
    assert upsert.missing_only(req, cache, ["k"]).collect() == [("c",)]


def test_discovery_and_retrieval(spark):
    df = spark.createDataFrame([(1, "u", 1, 5.0), (1, "u", 0, 6.0), (1, "w", 2, None)], "d int, u string, q int, s double")
    assert {(r.u, r.q) for r in discovery.first_seen(df, ["d", "u"], ["q"]).collect()} == {("u", 0), ("w", 2)}
    assert [r.place for r in discovery.top_k(df, ["d"], [F.desc_nulls_last("s")], 2).collect()] == [1, 2]
    good, bad = discovery.valid(df, {"score": F.col("s") > 5})
    assert good.count() == 1 and {tuple(r.broken) for r in bad.collect()} == {("score",)}
    got = retrieval.first_success(df, ["d"], "q", F.col("s") > 1, ["u", "s"]).first()
    assert (got.u, got.s, got.attempts, got.succeeded) == ("u", 6.0, 3, True)
    assert retrieval.first_success(df, ["d"], "q", F.col("s") > 100, ["u"]).first().u is None


def test_resolution(spark):
    e = spark.createDataFrame([(1, "Valmeria", "XA", ["VM"]), (2, "Ostrana", "XB", None)], "id int, name string, iso_code string, aliases array<string>")
    q = spark.createDataFrame([("Valmeria",), ("VM",), ("ostrana",), ("xb",), ("Valmeri",), ("zzz",), (None,)], "q string")
    got = {r.q: (r.entity_id, r.stage) for r in resolve.resolved(q, e, "q").collect()}
    assert got == {"Valmeria": (1, "name"), "VM": (1, "alias"), "ostrana": (2, "folded"), "xb": (2, "code"), "Valmeri": (1, "fuzzy"), "zzz": (None, None), None: (None, None)}
    assert resolve.resolved(q.limit(0), e, "q").count() == 0 and {r.stage for r in resolve.resolved(q, e.limit(0), "q").collect()} == {None}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text("abc", min_size=5, max_size=8), st.text("abc", min_size=5, max_size=8))
def test_deletions_meet_within_two_edits(spark, a, b):
    def left(x):
        one = {x[:i] + x[i + 1 :] for i in range(len(x))}
        return {x} | one | {y[:i] + y[i + 1 :] for y in one for i in range(len(y))}

    row = spark.createDataFrame([(a, b)], "a string, b string").select(resolve.deletions(F.col("a")), resolve.deletions(F.col("b")), F.levenshtein("a", "b")).first()
    assert set(row[0]) == left(a) and set(row[1]) == left(b)
    assert row[2] > 2 or set(row[0]) & set(row[1])


def test_similar(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 0.0]), (4, None), (5, [1.0]), (6, [1.0, 0.0])], "id int, v array<double>")
    q = spark.createDataFrame([(9, [2.0, 0.0])], "qid int, q array<double>")
    got = evidence.similar(v, q, "id", "v", "qid", "q").orderBy("place").collect()
    assert [r.id for r in got] == [1, 6, 2] and got[0].similarity == 1.0
    assert evidence.similar(v.limit(0), q, "id", "v", "qid", "q").count() == 0
    with pytest.raises(ValueError):
        evidence.similar(v, q, "id", "v", "qid", "q", max_queries=0)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(-10, 10), min_size=1, max_size=5), st.lists(st.floats(0, 3), min_size=5, max_size=5))
def test_weighted_mean_lies_between(values, weights):
    w = weights[: len(values)]
    if sum(w) > 0:
        mean = sum(a * b for a, b in zip(values, w)) / sum(w)
        assert min(values) - 1e-6 <= mean <= max(values) + 1e-6


def test_blocks_agree_with_columns(spark):
    v = spark.range(400).select("id", (F.col("id") % 3).alias("g"), F.array(*[F.sin(F.col("id") * (i + 1)) for i in range(6)]).alias("v"))
    v = v.unionByName(spark.createDataFrame([(900, 0, None), (901, 1, [0.0] * 6), (902, 2, [1.0]), (903, None, [1.0] + [0.0] * 5)], "id bigint, g bigint, v array<double>"))
    q = spark.createDataFrame([(1, [1.0, 0.5, 0.0, 0.0, 0.0, 0.2]), (2, [0.0, 0.0, 1.0, 0.0, -1.0, 0.0]), (3, [0.0] * 6)], "qid int, q array<double>")
    for within, k in (([], 7), (["g"], 3), (["g"], None)):
        a, b = ({(r.qid, r.id, r.place): r.similarity for r in f(v, q, "id", "v", "qid", "q", within=within, least=0.3, k=k).collect()} for f in (evidence.similar, evidence.similar_in_blocks))
        assert a.keys() == b.keys() and all(abs(a[x] - b[x]) < 1e-9 for x in a) and a
    assert evidence.similar_in_blocks(v.limit(0), q, "id", "v", "qid", "q").count() == 0


@pytest.mark.parametrize("f", [evidence.similar, evidence.similar_in_blocks])
def test_more_queries_than_a_block(spark, f):
    v = spark.range(40).select("id", F.array((F.col("id") % 7 + 1).cast("double"), (F.col("id") % 5).cast("double")).alias("v"))
    q = v.where("id < 11").select(F.col("id").alias("qid"), F.col("v").alias("q")).union(v.where("id = 3"))
    one, many = (f(v, q, "id", "v", "qid", "q", k=4, max_queries=n).collect() for n in (12, 5))
    assert len(one) == 44 and sorted((r.qid, r.id, r.place, round(r.similarity, 9)) for r in one) == sorted((r.qid, r.id, r.place, round(r.similarity, 9)) for r in many)


def test_scalars(spark):
    df = spark.createDataFrame([("http://u@a.b:80/c?d", "1.234,5"), ("no address", "x")], "u string, n string")
    got = df.select(scalars.host_of(F.col("u")), scalars.decimal_of(F.col("n")), scalars.slug(F.col("u"))).collect()
    assert [r[0] for r in got] == ["u@a.b:80", ""] and got[1][1] is None and got[1][2] == "no-address"
    assert spark.createDataFrame([("3,5",)], "n string").select(scalars.decimal_of(F.col("n"))).first()[0] == 3.5
    js = spark.createDataFrame([('```json\n{"a": 1,}\n```',), ("{'a': 'b'}",), ("nothing",)], "j string").select(scalars.json_object(F.col("j")).alias("v"))
    assert [r.v is not None for r in js.collect()] == [True, True, False]
    empty = spark.createDataFrame([("{}",), ('{"a": null, "b": "", "c": []}',), ('{"a": false}',), (None,)], "j string")
    assert [r[0] for r in empty.select(scalars.has_no_signal(F.col("j"))).collect()] == [True, True, False, True]
    s = spark.createDataFrame([("law site:A.b", ["a.B", "c.d"], "PDF"), ("x", None, None)], "q string, s array<string>, t string")
    assert [r[0] for r in s.select(scalars.search_string(F.col("q"), F.col("s"), F.col("t"))).collect()] == ["law site:A.b site:c.d filetype:pdf", "x"]


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿ISO;Country_EN;Score 2024\nab;X;82,5\ncd;Y;bad\n", encoding="utf-8")
    got = readers.scored_csv(spark, str(tmp_path / "a.csv"), 2024).collect()
    assert [(r.code, r.indicator_value, r.indicator_normalised) for r in got] == [("AB", 82.5, 4.3)]
    page = '<script id="et-cases">[{"c": "SPAIN", "d": "2020-01-02", "f": "0"}]</script><div class="score big"> 61 </div><span class="status">Partly Free</span>'
    pages = spark.createDataFrame([(1, page), (2, "<p>none</p>"), (3, None)], "id int, html string")
    cases = readers.embedded_json(pages, "html", "et-cases", "c: string, d: string, f: string")
    assert readers.case_indicators(cases, spark.createDataFrame([(7, "Spain")], "id int, name string")).collect() == [(7, 2020, 1.0)]
    assert readers.scraped(pages, "html", "score", "status", ["id"]).where("id = 1").first()[1:] == (61.0, "Partly Free")
    sinks.snapshot(spark.range(2), str(tmp_path / "s"), "2024/01")
    sinks.snapshot(spark.range(3), str(tmp_path / "s"), "2024/02")
    assert readers.snapshot(spark, str(tmp_path / "s"), "id bigint").count() == 3
    assert sinks.markdown(spark.range(1)) == "| id |\n|---|\n| 0 |"
    with pytest.raises(ValueError):
        sinks.markdown(spark.range(3), most=2)
    (tmp_path / "c.json").write_text(json.dumps({"scoring": {"legal_weight": 0.5}}))
    assert config.load(str(tmp_path / "c.json")).legal_weight == 0.5
    (tmp_path / "d.json").write_text('{"odd": 1}')
    with pytest.raises(ValueError):
        config.load(str(tmp_path / "d.json"))


def test_providers(spark):
    req = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", "3")], "request_key string, payload string")
    cache = spark.createDataFrame([("a", "cached", None, 1), ("b", None, "failed", 0)], "request_key string, response string, error string, tokens bigint")
    every, new = providers.answered(req, cache, lambda p: str(int(p) + 1))
    got = {r.request_key: r for r in every.collect()}
    assert got["a"].response == "cached" and got["c"].response == "4" and "ValueError" in got["b"].error
    assert {r.request_key for r in new.collect()} == {"b", "c"}
    assert {r.error for r in providers.recorded(req, cache).collect()} == {None, "failed", "no recorded response"}
    assert providers.usage(every).first().errors == 1 and len(providers.hashed_vector("a b", 8)) == 8


def test_streams(spark, tmp_path):
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    spark.createDataFrame([(1, "a", 1)], "k int, v string, q int").write.parquet(src)
    upsert.write_version(spark.createDataFrame([(1, "old", 0), (2, "b", 0)], "k int, v string, q int"), tgt)
    for _ in range(2):  # the second run finds nothing new
        incremental.upserting(incremental.files(spark, src, "k int, v string, q int"), tgt, ["k"], ["v", "q"], ["q"], str(tmp_path / "chk")).awaitTermination()
    assert {tuple(r) for r in upsert.read_version(spark, tgt).collect()} == {(1, "a", 1), (2, "b", 0)}
    ev = str(tmp_path / "ev")
    spark.sql("SELECT * FROM VALUES (timestamp'2024-01-01 00:00:00', 'x', 1.0D), (timestamp'2024-01-01 00:10:00', 'x', 2.0D), (timestamp'2024-01-03 00:00:00', 'y', 3.0D) t(ts, u, v)").write.parquet(ev)
    stream = incremental.deduplicated(incremental.files(spark, ev, "ts timestamp, u string, v double"), ["u"], "ts")
    q = stream.writeStream.format("memory").queryName("deduped").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.u for r in spark.table("deduped").collect()} == {"x", "y"} and spark.table("deduped").count() == 2
    batch = spark.read.parquet(ev)
    assert incremental.windowed(batch, "ts", ["u"], "v").count() == 2
    assert incremental.sessions(batch, "ts", ["u"]).count() == 2


def test_small_operators_of_plans(spark):
    from pyspark.sql import functions as F

    from indexloom.functions import scalars, text
    from indexloom.operators import discovery, index
    from indexloom.plans import extraction

    df = spark.createDataFrame([(1, 9.0, "law"), (2, 7.9, "law"), (3, None, "law"), (4, 8.0, None), (5, 8.0, "Law")], "id int, p double, kind string")
    assert [r.id for r in discovery.high_priority(df, "p").orderBy("id").collect()] == [1, 4, 5] and [r.id for r in discovery.of_types(df, "kind", ["law"]).orderBy("id").collect()] == [1, 2, 3]
    scored = spark.createDataFrame([(1, 2), (1, 3)], "country_id int, criterion_number int")
    left = index.to_score(spark.createDataFrame([(1,), (2,)], "country_id int"), scored, ["country_id"], [3, 2, 5, 5])
    assert sorted(map(tuple, left.collect())) == [(1, 5), (2, 2), (2, 3), (2, 5)]
    docs, sections = spark.createDataFrame([(1,), (2,), (3,)], "doc int"), spark.createDataFrame([(1, False), (1, True), (2, None)], "doc int, all_null boolean")
    assert {r.doc: r.status for r in extraction.status(docs, sections, "doc").collect()} == {1: "success", 2: "partial", 3: "failed"}
    one = spark.range(1).select(scalars.shared(F.array(F.lit(4), F.lit(1), F.lit(9)), [1, 4]).alias("s"), text.detected_language(F.lit("The law of the land and the rights")).alias("a"), text.detected_language(F.lit("12")).alias("b"), text.detected_language(F.lit(None).cast("string")).alias("c"), text.detected_language(F.lit("数据控制者")).alias("d")).first()
    assert one.s == [4, 1] and (one.a.language, one.b.language, one.b.probability, one.c.language, one.d.language) == ("en", "unknown", 0.0, "unknown", "zh")
