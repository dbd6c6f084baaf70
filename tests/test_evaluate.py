import pytest
from pyspark.sql import functions as F

from fakes import most_rows
from kiteloom.operators import evaluate as V

T = "head string, head_type string, relation string, tail string, tail_type string, evidenced boolean"


def frame(spark, *rows):
    return spark.createDataFrame([(*r, True) if len(r) == 5 else r for r in rows], T)


def test_strict_counts(spark):
    pred = frame(spark, ("a", "p", "contains", "b", "c"), ("a", "p", "contains", "b", "c"), ("x", "p", "contains", "b", "c"))
    gold = frame(spark, ("a", "p", "contains", "b", "c"))
    r = V.strict(pred, gold, V.TRIPLE).first()
    assert (r["tp"], r["fp"], r["fn"], r["precision"], r["recall"], r["f1"]) == (1, 1, 0, 0.5, 1.0, 0.666667)


def test_strict_of_nothing_is_zero(spark):
    e = spark.createDataFrame([], T)
    r = V.strict(e, e, V.TRIPLE).first()
    assert tuple(r) == (0, 0, 0, 0.0, 0.0, 0.0)


def test_evidence_coverage(spark):
    pred = frame(spark, ("a", "p", "contains", "b", "c", True), ("x", "p", "contains", "b", "c", False))
    r = V.evidence_coverage(pred, frame(spark, ("a", "p", "contains", "b", "c"))).first()
    assert (r["predicted"], r["true"]) == (0.5, 1.0)


def test_errors_are_sorted_and_limited(spark):
    pred = frame(spark, ("b", "p", "contains", "b", "c"), ("a", "p", "contains", "b", "c"))
    gold = spark.createDataFrame([], T)
    assert [r["head"] for r in V.errors(pred, gold, "fp", 1).collect()] == ["a"]
    assert V.errors(pred, gold, "fn", 5).count() == 0 and V.errors(pred, gold, "fp", 0).count() == 0
    with pytest.raises(ValueError):
        V.errors(pred, gold, "fp", -1)


RAW_E = "entity_id long, file_stem string, ord long, name string, type string, extractor_version string"
RAW_T = "file_stem string, source_file string, head string, relation string, tail string, evidence string"


def test_raw_types_come_from_the_own_chunk_and_the_last_one_holds(spark):
    e = spark.createDataFrame([(1, "f", 0, " a ", "concept", "zs"), (2, "f", 1, "a", "metric", "zs"), (3, "g", 0, "b", "metric", "zs"), (4, "f", 2, "a", " ", "zs"), (5, "f", 3, "a", "protocol", "fs")], RAW_E)
    t = V.raw_triples(spark.createDataFrame([("f", "s", "a", "Contains", " b ", None), ("f", "s", "a", "contains", " ", None)], RAW_T))
    kinds = V.types_by_chunk(e, {"zs": F.col("extractor_version") == "zs"})
    r = V.raw_typed(t, kinds, ["zs"]).first()
    assert (r["head_zs"], r["tail_zs"], r["relation"], r["tail"]) == ("metric", "", "Contains", "b") and t.count() == 1


def test_raw_scores_keep_what_is_not_valid(spark, rows):
    """Unknown relations and self loops count; chunks that a run did not extract give it no predictions; gold needs a source."""
    e = spark.createDataFrame([(1, "f", 0, "a", "concept", "zs"), (2, "g", 0, "a", "concept", "fs")], RAW_E)
    t = spark.createDataFrame([("f", "s", "a", "unheard", "a", ""), ("g", "s", "a", "contains", "b", ""), ("h", None, "x", "contains", "y", "")], RAW_T)
    runs = {r: F.col("extractor_version") == r for r in ("zs", "fs")}
    got = rows(V.raw_scores(V.raw_sides(e, t, runs), ["zs", "fs"]).where("scope = 'triple'"), "run", "tp", "fp", "fn")
    assert got == [("fs", 1, 0, 1), ("zs", 1, 0, 1)]
    assert rows(V.raw_coverage(e, t, runs)) == [("fs", 1, 1), ("zs", 1, 1)]
    none = V.raw_scores(V.raw_sides(e.limit(0), t.limit(0), runs), ["zs", "fs"])
    assert none.count() == 0


def test_run_scores(spark, rows):
    e = spark.createDataFrame([("TCP", "protocol", 1, True), ("window", "concept", 2, True), ("window", "metric", 1, False)], "name string, type string, at int, zs boolean")
    t = spark.createDataFrame([("TCP", "contains", "window"), ("TCP", "contains", "TCP协议")], "head string, relation string, tail string")
    got = rows(V.run_scores(V.run_sides(e, t, {"zs": F.col("zs")}), ["zs"]), "scope", "tp", "fp", "fn")
    assert got == [("entity", 1, 1, 1), ("relation", 0, 1, 1), ("triple", 0, 1, 1)]


def brute(pred, gold, close):
    g = [i for i, x in enumerate(gold) if any(close(x, y) for y in pred)]
    p = [i for i, x in enumerate(pred) if any(close(y, x) for y in gold)]
    return len(g), len(pred) - len(p), len(gold) - len(g)


def test_relaxed_tiers_against_loops(spark):
    names = ["tcp", "tcpcontrol", "a", "ab", "", "control"]
    pred = [(h, "p", r, t, "c") for h in names for t in names[:3] for r in ("contains",) if h and t] * 2
    gold = [(h, "p", r, t, "c") for h in names[1:] for t in names for r in ("contains", "depends_on") if h and t and len(h) != 2]
    inside = lambda a, b: a == b or len(a) > 1 and len(b) > 1 and (a in b or b in a)
    sub = lambda g, p: g[1:3] == p[1:3] and g[4] == p[4] and inside(g[0], p[0]) and inside(g[3], p[3])
    head = lambda g, p: g[1:3] == p[1:3] and g[4] == p[4] and inside(g[0], p[0])
    fp, fg = frame(spark, *pred), frame(spark, *gold)
    assert tuple(V.substring_match(V.normed(fp), V.normed(fg)).first())[:3] == brute(pred, gold, sub)
    assert tuple(V.head_relation_match(V.normed(fp), V.normed(fg)).first())[:3] == brute(pred, gold, head)
    none = V.normed(fp.limit(0))
    assert tuple(V.substring_match(none, none).first())[:3] == (0, 0, 0)


def test_a_frequent_head_does_not_bring_all_its_rows_together(spark):
    n = 300
    kinds = ("p", "contains")
    pred = [("tcp", *kinds, f"pred{i:03}", "c") for i in range(n)] + [("tcp", *kinds, "window", "c"), ("udp", *kinds, "same", "c")]
    gold = [("tcp", *kinds, f"gold{i:03}", "c") for i in range(n)] + [("tcp", *kinds, "windowsize", "c"), ("udp", *kinds, "same", "c")]
    most = most_rows(spark)
    got = tuple(V.substring_match(V.normed(frame(spark, *pred)), V.normed(frame(spark, *gold))).first())[:3]
    assert got == (2, n, n)
    assert n < most() < 40 * n  # a few rows for each text's pairs of characters, not n for each row


def test_names_are_compared_in_their_compatibility_form(spark):
    pred, gold = frame(spark, ("ＴＣＰ", "p", "contains", "b（x）", "c")), frame(spark, ("tcp", "p", "contains", "b", "c"), ("(x)", "p", "contains", "!", "c"))
    assert tuple(V.strict(V.normed(pred), V.normed(gold), V.TRIPLE).first())[:3] == (1, 0, 1)  # punctuation alone is given, so it counts
    assert tuple(V.substring_match(V.normed(pred), V.normed(gold)).first())[:3] == (1, 0, 0)


def test_inside_against_loops(spark, rows):
    texts = ["a", "b", "ab", "aab", "abab", "ba", "", "界", "世界", "世世界"]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    want = sorted((x, y) for x in texts for y in texts if x and y and x != y and x in y)
    assert rows(V.inside(df, df.withColumnRenamed("x", "y"))) == sorted(want, key=repr)


E = "name string, type string, description string, at int"


def test_aliases(spark, rows):
    pred = spark.createDataFrame([("tcp", "p", "transfer, 传输控制", 1), ("x", "c", "", 2)], E)
    gold = spark.createDataFrame([("TCP", "p", "", 1), ("传输控制", "q", "", 2)], E)
    assert rows(V.entity_match(pred, gold), "tier", "tp", "fp", "fn") == [("alias", 1, 3, 1), ("name_norm", 1, 1, 1)]
    # the end is no gold entity of its type, but one of its name's aliases is gold's under another type
    pt = frame(spark, ("tcp", "c", "contains", "x", "c"))
    gt = frame(spark, ("TCP", "c", "contains", "x", "c"))
    r = V.alias_match(pt, gt, V.alias_index(pred, True), V.alias_index(gold, False)).first()
    assert tuple(r)[:3] == (1, 0, 0)


def test_candidate_tiers(spark, rows):
    pool = spark.createDataFrame([("TCP", "p", "", 1), ("tcp", "c", "", 2), ("TCP Reno", "p", "", 3), ("!", "p", "", 4), ("流量", "p", "UDP报文", 5)], E)
    gold = spark.createDataFrame([("tcp", "p"), ("reno", "p"), ("udp", "p"), ("zz 量", "q"), ("zz", "c"), (" ", "p")], "name string, type string")
    got = rows(V.candidate_tiers(gold, pool), "gold_name", "tier", "name", "rank")
    assert got == [("reno", "substring", "!", 2), ("reno", "substring", "TCP Reno", 1), ("tcp", "exact_norm", "TCP", 1), ("udp", "substring", "!", 1), ("udp", "substring", "流量", 2)]
    shared = V.candidate_tiers(spark.createDataFrame([("ab 量大", "p")], "name string, type string"), pool.where("name != '!'"))
    assert rows(shared, "tier", "name") == [("token_overlap", "流量")]


def test_attribute_accuracy(spark, rows):
    pred = frame(spark, ("a", "p", "contains", "b", "c"), ("a", "q", "contains", "b", "c"), ("z", "q", "contains", "b", "c"))
    gold = frame(spark, ("a", "p", "depends_on", "b", "c"))
    assert rows(V.attribute_accuracy(pred, gold), "attribute", "total", "correct") == [("head_type", 2, 1), ("relation", 2, 0), ("tail_type", 2, 2)]


def test_judge_recall(spark, rows):
    gold = frame(spark, ("a", "p", "contains", "b", "c"), ("a", "p", "depends_on", "b", "c"), ("z", "p", "contains", "b", "c"))
    pred = frame(spark, ("A", "p", "contains", "B", "c"))
    align = spark.createDataFrame([("a", "p", "A"), ("b", "c", "B")], "gold_name string, gold_type string, pred_name string")
    same = spark.createDataFrame([("depends_on", "contains")], "gold_relation string, pred_relation string")
    judged = V.judge_recall(gold, align, pred, same)
    assert rows(judged, "head", "relation", "match_kind") == [("a", "contains", "exact_relation"), ("a", "depends_on", "relation_judge"), ("z", "contains", "missed")]
    assert tuple(V.recall_summary(judged).first()) == (3, 1, 1, 1, 0.666667)
    assert V.recall_summary(judged.limit(0)).first()["recall"] == 0.0
