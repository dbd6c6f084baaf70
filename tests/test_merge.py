import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiteloom.functions import text as X
from kiteloom.operators import merge as M
from kiteloom.streaming.incremental import merge_state

ENT = "entity_id long, file_stem string, ord long, name string, type string, description string, frequency long"
TRI = "triple_id long, file_stem string, ord long, source_file string, chunk_index string, evidence_id string, head string, relation string, tail string, evidence string"


def entities(spark, *names):
    return spark.createDataFrame([(i, "f", i, *n) for i, n in enumerate(names)], ENT)


def triples(spark, *rows):
    return spark.createDataFrame([(i, "f", i, "s", "0", f"T{i}", *r) for i, r in enumerate(rows)], TRI)


@pytest.mark.parametrize(
    "name, want",
    [("传输控制协议", "TCP"), ("慢启动算法", "慢启动"), ("X协议", "X协议"), (" TCP　", "TCP"), ("慢启动算法机制", "慢启动算法"), ("服务质量机制", "QoS"), ("", ""), ("协议", "协议")],
)
def test_normalize_name(spark, name, want):
    assert spark.range(1).select(X.normalize_name(F.lit(name)).alias("n")).first()["n"] == want


def test_normalize_name_null_and_own_aliases(spark):
    df = spark.createDataFrame([(None,), ("甲",)], "n string").select(X.normalize_name(F.col("n"), {"甲": "A"}).alias("n"))
    assert [r["n"] for r in df.collect()] == [None, "A"]


def test_valid_entities_bounds(spark):
    raw = entities(spark, ("a", "concept", None, 1), ("ab", " Concept ", None, None), ("x" * 31, "concept", None, 1), (None, "concept", "d", 1), ("ab", "device", None, 1), ("ab", None, None, 1), ("  ", "metric", None, -3), ("ab" + " " * 29, "concept", None, 1))
    assert [tuple(r) for r in M.valid_entities(raw).select("name", "type", "description", "frequency").collect()] == [("ab", "concept", "", 1)]


def test_merge_entities_first_type_and_description(spark, rows):
    raw = entities(spark, ("传输控制协议", "protocol", "", 1), ("TCP", "concept", "first", 1), ("TCP", "protocol", "second", 1))
    assert rows(M.merge_entities(M.valid_entities(raw)), "name", "type", "description", "frequency") == [("TCP", "protocol", "first", 3)]


def test_merge_triples(spark, rows):
    e = M.merge_entities(M.valid_entities(entities(spark, ("TCP", "protocol", "", 1), ("UDP", "protocol", "", 1))))
    t = triples(
        spark, ("TCP", "contains", "UDP", "one"), ("传输控制协议", "Contains ", "UDP", "two"), ("TCP", "contains", "UDP", "one"), ("TCP", "contains", "nobody", "x"),
        ("TCP", "contains", "传输控制协议", "x"), ("TCP", "is_a", "UDP", "x"), (None, "contains", "UDP", "x"), ("TCP", "contains", "UDP", None),
    )
    assert rows(M.merge_triples(M.valid_triples(t), e), "head", "relation", "tail", "frequency", "evidences") == [("TCP", "contains", "UDP", 4, ["one", "two"])]


def test_empty_tables(spark):
    e, t = M.merge_graph(spark.createDataFrame([], ENT), spark.createDataFrame([], TRI))
    assert e.count() == t.count() == 0
    assert M.graph_stats(e, t).count() == 0


def test_mapping_joins_entities_and_drops_self_loops(spark, rows):
    raw = entities(spark, ("alpha", "concept", "", 1), ("beta", "concept", "", 1), ("gamma", "concept", "", 1))
    t = triples(spark, ("alpha", "contains", "beta", ""), ("gamma", "contains", "beta", ""))
    m = spark.createDataFrame([("alpha", "gamma"), ("gamma", "gamma")], "name string, canonical string")
    e, tt = M.merge_graph(raw, t, m)
    assert rows(e, "name", "frequency") == [("beta", 1), ("gamma", 2)]
    assert rows(tt, "head", "tail", "frequency") == [("gamma", "beta", 2)]


def test_round_robin_takes_relations_in_turn(spark, rows):
    t = M.stated(triples(spark, *[("aa", "contains", f"b{i}", "") for i in range(4)], ("aa", "applied_to", "cc", "")))
    get = lambda n: rows(M.context_round_robin(t, n).where("name = 'aa'"), "position", "relation")
    assert get(3) == [(1, "applied_to"), (2, "contains"), (3, "contains")]
    assert get(5) == get(0) == [(1, "contains"), (2, "contains"), (3, "contains"), (4, "contains"), (5, "applied_to")]  # all fit: as they come


def test_context_of_names(spark):
    raw = entities(spark, ("传输控制协议", "", "one", 1), ("TCP", "Protocol", "one", 1), ("TCP", "concept", "two", 1), (" ", "concept", "x", 1), *[("TCP", "concept", f"d{i}", 1) for i in range(3)])
    t = triples(spark, ("TCP", "contains", "TCP", "e"), ("TCP", "", None, ""))
    got = {r["name"]: r for r in M.entity_context(M.mentions(raw), M.stated(t)).collect()}
    c = got["TCP"]
    assert set(got) == {"TCP"} and (c["type"], c["frequency"], c["total_descriptions"], c["descriptions"]) == ("protocol", 6, 5, ["one", "two", "d0"])
    assert c["total_triples"] == 2 and [x["id"] for x in c["triples"]] == ["f:T0", "f:T1"] and c["relations"] == {"": 1, "contains": 1}
    none = M.entity_context(M.mentions(raw.limit(0)), M.stated(t))
    assert none.first()["frequency"] == 0 and M.entity_context(M.mentions(raw.limit(0)), M.stated(t.limit(0))).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["aa", "bb", "TCP", "传输控制协议"]), st.sampled_from(["protocol", "concept"]), st.sampled_from(["", "d1", "d2"]), st.integers(1, 5)), min_size=1, max_size=12), st.integers(0, 12))
def test_merge_is_independent_of_partitions_and_batches(spark, names, cut):
    raw = entities(spark, *names)
    want = sorted(map(tuple, M.merge_entities(M.valid_entities(raw)).collect()))
    assert sorted(map(tuple, M.merge_entities(M.valid_entities(raw.repartition(7))).collect())) == want
    a, b = raw.where(F.col("entity_id") < cut), raw.where(F.col("entity_id") >= cut)
    both = merge_state(M.merge_entities(M.valid_entities(b)), M.merge_entities(M.valid_entities(a)))
    assert sorted(map(tuple, both.select("name", "type", "description", "frequency", "at").collect())) == want


def test_text_functions(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first()["x"]
    assert get(X.compact_name(F.lit("T.C-P (x)"))) == "tcpx"
    assert X.norm_name_text("ＴＣＰ（传输）-v2") == "tcpv2" and X.norm_name_text(None) == ""
    assert get(X.tokens_of(F.lit("TCP 拥塞 a b2"))) == ["tcp", "拥", "塞", "b2"]
    assert get(X.token_estimate(F.lit("TCP 拥塞, ok_1!"))) == 6 and get(X.token_estimate(F.lit(None).cast("string"))) == 0
    assert get(X.names_overlap(F.lit("a"), F.lit("ab"))) is False and get(X.names_overlap(F.lit("ab"), F.lit("xaby"))) is True and get(X.names_overlap(F.lit(""), F.lit(""))) is False
    assert get(X.encode_row(F.lit(" a "), F.lit("concept"), F.lit(""))) == "实体类型：concept；实体名：a"
    assert get(X.encode_row(F.lit(" "), F.lit("concept"), F.lit("d"))) is None
    assert get(X.clip(F.lit("abcdef"), 3)) == "abc…" and get(X.clip(F.lit("abc"), 3)) == "abc"
    assert get(X.clean_ids(F.array(F.lit(" T1 "), F.lit("T1"), F.lit(None), F.lit("")))) == ["T1"]
    assert get(X.reply_json(F.lit('text\n```json\n{"a": 1}\n```\n'))) == '{"a": 1}' and get(X.reply_json(F.lit("no"))) is None
    assert X.first_object_text('x {bad} {"a": "}"} y') == '{"a": "}"}' and X.first_object_text("{") is None and X.first_object_text(None) is None
    assert get(X.book_stem(F.lit("/x/abc_page_0012.png"))) == "abc" and get(X.image_page(F.lit("/x/abc_page_0012.png"))) == 12 and get(X.image_page(F.lit("abc.png"))) == 0
    assert get(X.has_evidence(F.array(F.lit(" ")), F.lit("x"))) is True and get(X.has_evidence(F.array(F.lit(" ")), F.lit(None).cast("string"))) is False
    assert abs(get(X.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.8), F.lit(0.6)))) - 0.8) < 1e-12
