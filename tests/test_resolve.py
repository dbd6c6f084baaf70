import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fakes import most_rows
from kiteloom.models import Scripted
from kiteloom.operators import judging as J
from kiteloom.operators import merge as M
from kiteloom.operators import resolve as R

C = "candidate_id int, left_name string, right_name string, left_type string, right_type string, score double"
T = "head string, relation string, tail string"


def test_rules_in_order(spark):
    c = spark.createDataFrame(
        [(1, "TCP", "传输控制协议", "protocol", "concept", 0.9), (2, "TCP", "传输控制协议", "protocol", "protocol", 0.9), (3, "alpha", "beta", "concept", "concept", 0.9), (4, "alpha", "gamma", "concept", "concept", None), (5, "alpha", None, "concept", "concept", 0.1)], C
    )
    t = spark.createDataFrame([("beta", "contains", "alpha"), ("TCP", "contains", "传输控制协议")], T)
    got = {r["candidate_id"]: (r["decision"], r["reason_code"]) for r in R.pair_rules(c, t).collect()}
    assert got[1] == ("keep_separate", "TYPE_MISMATCH") and got[2] == ("merge", "STRONG_NAME_EQUIVALENCE")
    assert got[3] == ("keep_separate", "DIRECT_RELATION_SELF_LOOP_RISK")
    assert got[4] == got[5] == ("needs_llm", "AMBIGUOUS_REQUIRES_LLM")


def test_budget(spark):
    c = spark.createDataFrame([(i, f"a{i}", f"b{i}", "concept", "concept", float(i)) for i in range(4)], C)
    got = R.budget_split(R.pair_rules(c, spark.createDataFrame([], T)), 1).collect()
    assert {r["candidate_id"]: r["route"] for r in got} == {3: "review", 0: "skipped", 1: "skipped", 2: "skipped"}


def test_components_against_union_find(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["name"]: r["cluster"] for r in R.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for x in parent}
    assert R.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_cluster_vetoes(spark):
    pairs = [*itertools.combinations("abcde", 2), ("k", "l"), ("l", "m"), ("x", "y"), ("p", "q")]
    accepted = spark.createDataFrame([(a * 2, b * 2) for a, b in pairs], "left_name string, right_name string")
    t = spark.createDataFrame([("yy", "contains", "xx")], T)
    got = {r["cluster"]: r["reason_code"] for r in R.cluster_conflicts(accepted, t).collect()}
    assert got == {"aa": "CLUSTER_TOO_LARGE", "kk": "INCOMPLETE_PAIRWISE_CLUSTER", "xx": "DIRECT_RELATION_IN_CLUSTER"}
    e = spark.createDataFrame([("pp", 1), ("qq", 5)], "name string, frequency long")
    assert sorted(map(tuple, R.canonical_mapping(accepted, e, t).collect())) == [("pp", "qq"), ("qq", "qq")]


def test_canonical_pick_order(spark):
    m = spark.createDataFrame([("bb", 1), ("a", 1), ("ccc", 1)], "name string, cluster long")
    f = spark.createDataFrame([("bb", 3), ("ccc", 3)], "name string, frequency long")
    assert R.canonical_pick(m, f).first()["canonical"] == "bb"
    assert R.canonical_pick(m, f, spark.createDataFrame([("a",)], "name string")).first()["canonical"] == "a"


JUDGED = "i int, decision string, canonical_name string, supporting_evidence_ids array<string>, conflict_evidence_ids array<string>, shown_ids array<string>, truncated boolean, left_name string, right_name string, left_type string, right_type string, reason_code string, reason string"


def test_judge_is_not_trusted(spark):
    said = lambda i, d, c, s, x, cut=False, left="A", right="B", kind="p": (i, d, c, s, x, ["T1", "T2"], cut, left, right, "p", kind, "CODE", "why")
    rows = [
        said(1, "merge", "A", ["T1"], []), said(2, " Merge ", "A", ["T9", "T1"], []), said(3, "merge", "C", ["T1"], []), said(4, "merge", "A", [], None), said(5, "merge", "A", ["T1"], ["T2"]), said(6, "merge", "A", ["T1"], [], True),
        said(7, "maybe", None, [], []), said(8, None, None, [], []), said(9, "merge", " A ", [" T1", "T1", None], ["T9"]), said(10, "keep_separate", None, ["T9"], []), said(11, "merge", "A", ["T1"], [], False, "A", "B", "q"),
        said(12, "merge", "x1", ["T1"], [], False, "x1", "x2"), said(13, "unsure", "A", [], []),
    ]
    df = spark.createDataFrame(rows, JUDGED)
    t = spark.createDataFrame([("x2", "contains", "x1")], T)
    got = {r["i"]: (r["decision"], r["method"], r["reason_code"], r["canonical_name"]) for r in R.validated(df, t).collect()}
    assert got[1] == ("merge", "llm_recheck", "CODE", "A")
    assert [got[i][0] for i in (2, 3, 4, 5, 7, 8, 10, 13)] == ["unsure"] * 8 and all(got[i][3] is None for i in (2, 3, 4, 5, 6, 7, 8, 10, 11, 12, 13))
    assert got[6][:3] == ("unsure", "llm_recheck", "TRUNCATED_CONTEXT")
    assert got[9] == ("merge", "llm_recheck", "CODE", "A")  # a conflict that was not shown is left out
    assert got[11] == ("keep_separate", "rules_after_llm", "TYPE_MISMATCH", None) and got[12][:3] == ("keep_separate", "rules_after_llm", "DIRECT_RELATION_SELF_LOOP_RISK")
    loose = {r["i"]: r["decision"] for r in R.validated(df, t, require_support=False, allow_truncated=True).collect()}
    assert loose[4] == loose[6] == "merge" and loose[2] == "unsure"
    lost = df.where("i <= 2").withColumns({"parsed": F.col("i") == 2, "error": F.when(F.col("i") == 2, "down")})
    assert {r["i"]: (r["decision"], r["reason_code"], r["reason"]) for r in R.judgement(lost).collect()} == {1: ("unsure", "LLM_INVALID_JSON", ""), 2: ("unsure", "LLM_REQUEST_FAILED", "down")}


ENT = "entity_id long, file_stem string, ord long, name string, type string, description string, frequency long"
TRI = "triple_id long, file_stem string, ord long, source_file string, chunk_index string, evidence_id string, head string, relation string, tail string, evidence string"


def handshakes(spark, more=()):
    names = [("三次握手", "mechanism", "d1"), ("三路握手", "mechanism", "d2"), ("可靠传输", "concept", "d3"), *more]
    e = spark.createDataFrame([(i, "c", i, *n, 1) for i, n in enumerate(names)], ENT)
    t = spark.createDataFrame([(i, "c", i, "book.md", "1", f"T{i}", h, "applied_to", "可靠传输", f"{h}用于可靠传输") for i, h in enumerate(("三次握手", "三路握手"))], TRI)
    return e, t


def pair(spark, left="三次握手", right="三路握手", kind="mechanism", score=0.9):
    return lambda entities: spark.createDataFrame([(left, right, kind, kind, score)], "left_name string, right_name string, left_type string, right_type string, score double")


def test_a_judged_merge_joins_the_graph(spark, rows):
    e, t = handshakes(spark)

    class Keen:
        def judge(self, question):
            q = json.loads(question)
            assert q["left"]["descriptions"][0]["id"] == "L_DESC_1" and "score" not in question and q["right"]["triples"][0]["id"] == "R_TRIPLE_1"
            return json.dumps({"decision": "merge", "canonical_name": "三次握手", "reason_code": "SAME_MECHANISM", "supporting_evidence_ids": ["L_DESC_1", "R_TRIPLE_1"]})

    m = J.merge_directory(e, t, pair(spark), Keen)
    assert rows(m.entities, "name", "frequency") == [("三次握手", 2), ("可靠传输", 1)] and rows(m.triples, "head", "frequency") == [("三次握手", 2)]
    assert rows(m.decisions, "decision", "method", "reason_code") == [("merge", "llm_recheck", "SAME_MECHANISM")]
    assert rows(m.summary, "strategy", "candidates", "reviewed", "skipped", "merged") == [("recheck", 1, 1, 0, 1)]


@pytest.mark.parametrize(
    "reply, code",
    [('{"decision": "merge", "canonical_name": "三次握手", "supporting_evidence_ids": ["FAKE"]}', "LLM_RECHECK"), ("[1]", "LLM_INVALID_JSON"), ("no", "LLM_INVALID_JSON"), (ValueError("down"), "LLM_REQUEST_FAILED"), ('{"decision": "merge", "canonical_name": "其他", "supporting_evidence_ids": ["L_DESC_1"], "reason_code": " "}', "LLM_RECHECK"), ('{"decision": "merge", "canonical_name": "三次握手", "supporting_evidence_ids": [1]}', "LLM_RECHECK")],
)
def test_a_reply_that_cannot_be_trusted_merges_nothing(spark, rows, reply, code):
    e, t = handshakes(spark)
    m = J.merge_directory(e, t, pair(spark), lambda: Scripted([reply]))
    assert rows(m.decisions, "decision", "reason_code") == [("unsure", code)] and m.entities.count() == 3


def test_a_cut_context_merges_nothing_unless_allowed(spark, rows):
    more = [("三次握手", "mechanism", f"more {i}") for i in range(3)]
    e, t = handshakes(spark, more)
    reply = '{"decision": "merge", "canonical_name": "三次握手", "supporting_evidence_ids": ["L_DESC_1"]}'
    get = lambda **o: rows(J.merge_directory(e, t, pair(spark), lambda: Scripted([reply]), J.MergeOptions(**o)).decisions, "decision", "reason_code")
    assert get() == [("unsure", "TRUNCATED_CONTEXT")] and get(allow_truncated=True) == [("merge", "LLM_RECHECK")]


def test_strategies(spark, rows):
    e, t = handshakes(spark)
    def get(s, **o):
        return J.merge_directory(e, t, pair(spark, score=0.86), lambda: Scripted([]), J.MergeOptions(s, **o))
    assert rows(get("rules").decisions, "decision", "method", "reason_code") == [("unsure", "rules_only", "LLM_RECHECK_DISABLED")]
    assert get("direct").entities.count() == 2 and get("direct", similarity_threshold=0.9).entities.count() == 3
    assert get("none").decisions.count() == 0 and J.merge_directory(e, t).entities.count() == 3
    none = J.merge_directory(e.limit(0), t.limit(0), lambda x: pair(spark)(x).limit(0), lambda: Scripted([]))
    assert none.entities.count() == none.triples.count() == none.decisions.count() == 0
    with pytest.raises(ValueError):
        J.MergeOptions("other")


def test_budget_of_reviews(spark, rows):
    e, t = handshakes(spark, [("四次挥手", "mechanism", "d4")])
    def both(x):
        return pair(spark)(x).union(pair(spark, "三次握手", "四次挥手", score=0.95)(x))
    m = J.merge_directory(e, t, both, lambda: Scripted(["no"]), J.MergeOptions(max_pairs=1))
    assert rows(m.decisions, "right_name", "method", "reason_code") == [("三路握手", "llm_recheck_skipped", "MAX_PAIRS_EXCEEDED"), ("四次挥手", "llm_recheck", "LLM_INVALID_JSON")]
    assert [r["judged"] for r in m.decisions.collect()] == [False, True]


def test_descriptions_come_from_the_entity_met_first(spark, rows):
    """After resolution merged entities are merged again, each with the description it has."""
    e = spark.createDataFrame([(0, "c", 0, "甲甲", "concept", "", 1), (1, "c", 1, "乙乙", "concept", "second", 1), (2, "c", 2, "甲甲", "concept", "own", 1)], ENT)
    m = spark.createDataFrame([("甲甲", "乙乙"), ("乙乙", "乙乙")], "name string, canonical string")
    got, _ = M.merge_graph(e, spark.createDataFrame([], TRI), m)
    assert rows(got, "name", "description", "frequency") == [("乙乙", "own", 3)]


def test_judges_of_evaluation(spark, rows):
    tiers = spark.createDataFrame([("a", "p", "exact_norm", "A", 1), ("b", "p", "substring", "bx", 1), ("b", "p", "substring", "by", 2), ("c", "p", "substring", "cx", 1)], "gold_name string, gold_type string, tier string, name string, rank long")
    pool = spark.createDataFrame([("bx", "p", "d" * 300, 1, 1), ("by", "p", "", 2, 2), ("cx", "p", "", 1, 3)], "name string, type string, description string, frequency long, at int")

    class Picks:
        def judge(self, question):
            q = json.loads(question)
            assert all(len(c["description"]) <= 201 for c in q["candidates"])
            return 'I say {"matched_indices": [1, 7, "0", 1]}' if q["gold"]["name"] == "b" else "{"

    align = J.align_entities(tiers, pool, Picks)
    assert rows(align) == [("a", "p", "A"), ("b", "p", "by")]
    gold = spark.createDataFrame([("a", "p"), ("b", "p"), ("c", "p"), ("", "p")], "name string, type string")
    assert tuple(J.align_summary(gold, align).first()) == (3, 2, 1)
    g = spark.createDataFrame([("a", "p", "contains", "b", "p"), ("a", "p", "applied_to", "b", "p")], "head string, head_type string, relation string, tail string, tail_type string")
    pred = spark.createDataFrame([("A", "depends_on", "by")], "head string, relation string, tail string")

    class Same:
        def judge(self, question):
            return json.dumps({"equivalent": json.loads(question)["gold"]["relation"] == "contains"})

    assert rows(J.judge_relations(g, align, pred, Same)) == [("contains", "depends_on")]


def test_knn_candidates(spark, rows):
    v = [(1, "p", [1.0, 0.0]), (2, "p", [0.8, 0.6]), (3, "p", [0.28, 0.96]), (4, "q", [1.0, 0.0]), (5, "p", None), (6, "p", [0.0, 0.0]), (7, "p", [float("nan"), 1.0]), (8, "p", [1.0, 0.0])]
    df = spark.createDataFrame(v, "node_id long, type string, embedding array<float>")
    got = rows(R.knn_candidates(df, 0.75, k=3, block=2, dim=2), "left_id", "right_id")
    assert got == [(1, 2), (1, 8), (2, 3), (2, 8)]


@pytest.mark.parametrize("block", [None, 1500])
def test_knn_candidates_against_all_pairs(spark, rows, block):
    """Many blocks and tiles, exact copies, a dense topic of which all pairs are close, and another type."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(4500, 4))
    x[500:900] = x[0] + 0.01 * rng.normal(size=(400, 4))
    x[900:1000] = x[1]
    x = x.astype(np.float32)
    kinds = np.where(np.arange(4500) % 9 == 0, "q", "p")
    ids = rng.permutation(4500)
    df = spark.createDataFrame([(int(i), str(t), e.tolist()) for i, t, e in zip(ids, kinds, x)], "node_id long, type string, embedding array<float>")
    got = rows(R.knn_candidates(df, 0.99, k=5, dim=4, **({} if block is None else {"block": block})))
    y = x.astype(float)
    y /= np.sqrt((y * y).sum(1, keepdims=True))
    want = []
    for i in range(4500):
        s = np.round(y @ y[i], 6)
        near = sorted((-s[j], int(ids[j])) for j in np.flatnonzero((s >= 0.99) & (kinds == kinds[i])) if j != i)[:5]
        want += [(int(ids[i]), j, -float(t)) for t, j in near if ids[i] < j]
    assert [r[:2] for r in got] == [r[:2] for r in sorted(want, key=repr)]
    assert np.allclose([r[2] for r in got], [r[2] for r in sorted(want, key=repr)], atol=1e-9)


def test_vectors_of_a_type_meet_in_as_few_blocks_as_they_fit_in(spark):
    x = np.random.default_rng(3).normal(size=(4500, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, "p", e.tolist()) for i, e in enumerate(x)], "node_id long, type string, embedding array<float>")
    most = most_rows(spark)
    assert R.knn_candidates(df, 0.95, dim=16).count() < 100
    assert most() == 4500
