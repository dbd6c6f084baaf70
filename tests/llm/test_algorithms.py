import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kiteloom.llm import canonical, components, neighbors, packing, survivorship

# --------------------------------------------------------------------------------------------------------- components


def union_find(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("beta, rounds", [(0.3, 3), (0.9, 2)])
def test_groups_of_chains_stars_and_noise(spark, beta, rounds):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    star = [(5000, 6000 + i) for i in range(80)]
    noise = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(3, 3), (None, 4), (4, None), (7, 8), (8, 7), (7, 8)]
    pairs = chain + star + noise
    df = spark.createDataFrame(pairs, "left_id long, right_id long").withColumn("group_id", F.lit("clash"))
    got = {r["node_id"]: r["group_id"] for r in components.connected_groups(df, beta=beta, rounds=rounds).collect()}
    assert got == union_find(pairs)


def test_groups_of_nothing(spark):
    df = spark.createDataFrame([(1, 1), (None, None)], "left_id long, right_id long")
    assert components.connected_groups(df).collect() == []
    assert components.connected_groups(df.limit(0)).collect() == []


def test_merge_words(spark):
    df = spark.createDataFrame([(1, 2, w) for w in ("merge", " MERGE\t", "keep_separate", "unsure", None, "merged")], "left_id long, right_id long, decision string")
    assert components.merge_pairs(df).count() == 2


# ------------------------------------------------------------------------------------------------------- survivorship

ROW = "entity_id long, mention_key string, name string, description string, frequency long, canonical_name string, extractor_version string, extracted_at timestamp_ntz"


def rows_of(spark, *rows):
    from datetime import datetime

    return spark.createDataFrame([(*r[:7], datetime(2026, 1, r[7]) if r[7] else None) for r in rows], ROW)


def test_best_rows(spark):
    df = rows_of(
        spark,
        (1, "k", "a", "Says something.", 0, "a", "zs-nocheck", 9), (2, "k", "b", "Cut off bef", 3, "c", "FS_Recheck", 1), (3, "k", "b", "也说了。", None, "b", " fs-recheck ", None), (4, "k", "a", "N/A", 5, "  ", "fs-recheck", 2),
        (5, "one", "a", "Text.", 1, "a", "fs-recheck", 1), (6, "none", None, None, None, None, None, None), (7, "none", "x", "…", -1, "needs_llm", None, None), (8, None, "x", "T.", 1, "x", None, 1), (9, None, "x", "T.", 1, "x", None, 1),
        (10, "tie", "x", "T one.", 1, "x", "fs-recheck", 4), (11, "tie", "x", "T two.", 1, "x", "fs-recheck", 4), (12, "tie", "x", "T new.", 1, "y", "zs-recheck", 5),
    )
    got = {r["mention_key"]: tuple(r)[1:] for r in survivorship.best_rows(df.withColumn("n", F.lit(1))).collect()}
    assert got == {"k": (3, 4, 3), "none": (0, 0, 0), "tie": (10, 10, 10)}
    assert survivorship.best_rows(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        survivorship.best_rows(df, nulls="other")


@pytest.mark.parametrize("text, ok", [("It works.", True), ("它工作。", True), ("It wor", False), ("It works...", False), ("它工作……", False), ("？？？", False), ("null", False), ("(no description)", False), ("待补充", False), ("", False), ("　", False), (None, False), ("Is it?", True), ("He said it.”", True), ("x" * 100_000 + ".", True)])
def test_usable_description(spark, text, ok):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(survivorship.usable_description(F.col("d")).alias("u")).first()["u"] is ok


def test_currency_orders_rows_without_time(spark):
    # elsewhere "old" is followed by "new", so of two undated rows the one with "new" is the later
    known = [(i, f"k{i // 2}", "old" if i % 2 == 0 else "new", None, None, "old" if i % 2 == 0 else "new", "fs-recheck", 1 + i % 2) for i in range(8)]
    undated = [(20, "u", "old", "T.", 1, "old", "fs-recheck", None), (21, "u", "new", "T.", 1, "new", "fs-recheck", None)]
    df = rows_of(spark, *known, *undated)
    rule = survivorship.value_precedence(df).first()
    assert (rule["before"], rule["after"], rule["support"]) == ("old", "new", 4)
    pick = lambda nulls: survivorship.best_rows(df, nulls).where("mention_key = 'u'").first()["canon_from"]
    assert (pick("oldest"), pick("currency")) == (20, 21)


@pytest.mark.parametrize("few", [16, 0])
def test_the_topologically_latest_value_is_taken(spark, monkeypatch, few):
    monkeypatch.setattr(survivorship, "FEW", few)
    # a is followed by b ten times and b by c once: c is the latest, though b has more support
    steps = [("a", "b")] * 10 + [("b", "c")]
    known = [(10 * k + i, f"k{k}", v, None, None, v, "fs-recheck", 1 + i) for k, pair in enumerate(steps) for i, v in enumerate(pair)]
    undated = [(900 + i, "u", v, "T.", 1, v, "fs-recheck", None) for i, v in enumerate("abcd")]
    df = rows_of(spark, *known, *undated)
    assert {r["canonical_name"]: r["currency"] for r in survivorship.currency_rank(df).where("mention_key = 'u'").collect()} == {"a": 0, "b": 1, "c": 2, "d": 0}
    assert survivorship.best_rows(df, "currency").where("mention_key = 'u'").first()["canon_from"] == 902


def test_cycles_break_at_the_weakest_precedence():
    assert survivorship.latest_ranks([(5, "a", "b"), (4, "b", "c"), (1, "c", "a"), (2, "c", "d")]) == {"a": 0, "b": 1, "c": 2, "d": 3}
    assert survivorship.latest_ranks([]) == {}
    rng = random.Random(3)
    for _ in range(50):
        edges = [(rng.randrange(1, 9), *rng.sample("pqrstuv", 2)) for _ in range(12)]
        edges = list({frozenset(e[1:]): e for e in edges}.values())
        rank = survivorship.latest_ranks(edges)
        assert set(rank) == {v for _, *pair in edges for v in pair}
        against = [e for e in edges if rank[e[1]] >= rank[e[2]]]
        for n, a, b in against:  # a chain of stronger or equal precedences leads back
            seen, grown = {b}, True
            while grown:
                more = {y for m, x, y in edges if x in seen and m >= n and (m, x, y) not in against} - seen
                seen, grown = seen | more, bool(more)
            assert a in seen


# ---------------------------------------------------------------------------------------------------------- neighbors


def clouds(n, dim, seed):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((max(1, n // 8), dim))
    return centers[rng.integers(len(centers), size=n)] + 0.12 * rng.standard_normal((n, dim))


def brute(ids, m, least, top):
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    np.fill_diagonal(s, -2)
    out = set()
    for k in range(len(ids)):
        for j in sorted(range(len(ids)), key=lambda j: (-s[k, j], ids[j]))[:top]:
            if s[k, j] >= least:
                out.add((min(ids[k], ids[j]), max(ids[k], ids[j])))
    return out


def test_similar_pairs_against_brute_force(spark):
    m = clouds(1500, 16, 2).astype(np.float32)
    m[100:130] = m[99]  # copies
    m[200] = 3 * m[201]  # another length
    data = [(i, m[i].tolist()) for i in range(len(m))]
    bad = [(9001, None), (9002, [0.0] * 16), (9003, [1.0]), (9004, [float("nan")] * 16), (9005, [float("inf")] + [0.0] * 15), (9006, []), (None, m[0].tolist())]
    df = spark.createDataFrame(data + bad, "node_id long, embedding array<float>").withColumn("u", F.lit("clash"))
    got = {(r["node_a"], r["node_b"]) for r in neighbors.similar_pairs(df, 0.9, 5, dim=16, leaf=60, rounds=3).collect()}
    want = brute(list(range(len(m))), m.astype(np.float64), 0.9, 5)
    assert len(got & want) / len(want) >= 0.97 and len(got & want) / len(got) >= 0.97
    copies = set(range(99, 130))
    assert {p for p in got if set(p) <= copies} == {p for p in want if set(p) <= copies}


def test_crowded_leaves_are_met_in_pieces(spark, monkeypatch):
    """A sample too small for leaves of the size asked for: pieces keep to it, and the rounds make good what pieces part."""
    monkeypatch.setattr(neighbors, "SAMPLE", 32)
    m = clouds(1500, 16, 2).astype(np.float32)
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(len(m))], "node_id long, embedding array<float>")
    c = neighbors.Collection(df, dim=16, leaf=40)
    assert c.trees.depth <= 2  # at most 4 leaves for 1,500 vectors
    got = {(r["node_a"], r["node_b"]) for r in c.pairs(0.9, 5).collect()}
    want = brute(list(range(len(m))), m.astype(np.float64), 0.9, 5)
    assert len(got & want) / len(want) >= 0.9 and len(got & want) / len(got) >= 0.9


def test_pieces_keep_groups_apart_and_are_of_one_size():
    rng = np.random.default_rng(1)
    leaves = np.sort(np.concatenate([np.repeat(k, n) for k, n in ((0, 3), (1, 250), (2, 1), (3, 40))]))
    df = pd.DataFrame({"leaf": leaves, "u": np.arange(len(leaves))})
    for _ in range(20):
        cuts = np.sort(rng.integers(0, len(df), 6))
        parts = [df.iloc[a:b] for a, b in zip([0, *cuts], [*cuts, len(df)])]
        got = list(neighbors._pieces(iter(parts), ["leaf"], 20))
        assert all(g["leaf"].nunique() == 1 and len(g) < 40 for g in got) and pd.concat(got)["u"].tolist() == df["u"].tolist()
        assert all(len(g) >= 20 for g in got if g["leaf"].iloc[0] in (1, 3))


def test_similar_pairs_of_few(spark):
    one = spark.createDataFrame([(1, [1.0, 0.0])], "node_id long, embedding array<float>")
    assert neighbors.similar_pairs(one, dim=2).collect() == []
    assert neighbors.similar_pairs(one.limit(0), dim=2).collect() == []
    two = one.union(spark.createDataFrame([(2, [2.0, 0.0]), (3, [0.0, 1.0])], one.schema))
    assert [tuple(r)[:2] for r in neighbors.similar_pairs(two, dim=2).collect()] == [(1, 2)]


# ---------------------------------------------------------------------------------------------------------- canonical

QUALIFIERS, OBJECTS, KINDS = [("Rapid", "快速"), ("Nested", "嵌套"), ("Quiet", "静默")], [("Bridge", "桥接"), ("Mirror", "镜像"), ("Stream", "流式")], [("Protocol", "协议"), ("Latency", "时延"), ("Control", "控制")]


def reference(spark):
    grid = list(itertools.product(QUALIFIERS, OBJECTS, KINDS))
    rows = [(i, a[1] + b[1] + c[1], f"{a[0]} {b[0]} {c[0]}", f"{a[0][:2]}{b[0][0]}{c[0][0]}".upper()) for i, (a, b, c) in enumerate(grid, 1) if i % 4]
    return spark.createDataFrame(rows + [(99, None, None, None)], "canon_id long, name_zh string, name_en string, abbr string")


@pytest.mark.parametrize(
    "name, want",
    [
        ("rapid bridge protocol", "Rapid Bridge Protocol"), ("Bridge Protocol (Rapid)", "Rapid Bridge Protocol"), ("Protocol for Bridge, Rapid", "Rapid Bridge Protocol"), ("the Rapid-Bridge Protocol method", "Rapid Bridge Protocol"),
        ("Rapid Brigde Protocl", "Rapid Bridge Protocol"), ("RapidBridge Protocol", "Rapid Bridge Protocol"), ("Rаpid Bridge Prоtocol", "Rapid Bridge Protocol"), ("Ｒａｐｉｄ Bridge Protocol", "Rapid Bridge Protocol"), ("Rapid Bridge", "Rapid Bridge Protocol"), ("快速桥接", "Rapid Bridge Protocol"),
        ("快速桥接技术", "Rapid Bridge Protocol"), ("所谓快速桥接协议", "Rapid Bridge Protocol"), ("快速橋接協議", "Rapid Bridge Protocol"), ("快桥速接协议", "Rapid Bridge Protocol"), ("《快速桥接协议》", "Rapid Bridge Protocol"), ("桥接协议(快速)", "Rapid Bridge Protocol"), ("RABP", None), ("R.A.B.P.", "Rapid Bridge Protocol"),
        ("Rapid Bridge Protocol (RABP)", "Rapid Bridge Protocol"), ("RAPID BRIDGE CONTROL", "Rapid Bridge Control"), ("Rapid Mirror Protocol", 0), ("Nested Stream Throughput", 0), ("Lab bench", 0), ("教材", 0), ("σ", 0), ("x" * 50_000, 0), ("快的" * 20_000, 0), ("rapid bridge " * 5_000, 0),
    ],
)
def test_to_canonical(spark, name, want):
    ref = reference(spark)
    ids = {r["name_en"]: r["canon_id"] for r in ref.collect()}
    usage = canonical.Usage(frozenset({"the", "for", "method"}), ("所谓",), ("技术",), "的", "protocol")
    got = canonical.to_canonical(spark.createDataFrame([(1, name)], "entity_id long, name string"), ref, usage=usage).collect()
    if want is None:  # equal to a form
        assert got == []
    else:
        assert [r["canon_id"] for r in got] == [ids.get(want, 0)]


def test_to_canonical_edges(spark):
    ref = reference(spark)
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \u3000\u200b"), (4, "rapid bridge protocol"), (4, "rapid bridge protocol"), (5, "Rapid Bridge Protocol")], "entity_id long, name string").withColumn("canon_id", F.lit(0))
    assert [r["entity_id"] for r in canonical.to_canonical(df, ref).collect()] == [4, 4]
    assert [r["canon_id"] for r in canonical.to_canonical(df, ref.limit(0)).orderBy("entity_id").collect()] == [0, 0, 0]
    assert canonical.to_canonical(df.limit(0), ref).count() == 0


CITIES = [(1, None, "Berlin", "BER"), (2, None, "New York", "NYC"), (3, None, "San Francisco Bay Area", None), (4, None, "Selective Window Mechanism", None), (5, "上海", "Shanghai", None), (6, None, "São Paulo", None), (7, None, "Rio de Janeiro", None), (8, None, "Software Engineer", None), (9, None, "Senior Data Engineer", None), (10, None, "Data Engineer", None)]


@pytest.mark.parametrize(
    "name, want",
    [
        ("Berlni", 1), ("BERLIN", 1), ("New Yrok", 2), ("newyork", 2), ("Nwe York", 2), ("York, New", 2), ("N.Y.C.", 2), ("San Fransisco Bay Area", 3), ("bay area of san francisco", 3), ("Selective Windw Mechanism", 4), ("上海", None), ("Sao Paulo", 6), ("Ｓão　Ｐaulo", 6), ("Rio de Janiero", 7),
        ("Sofware Enginere", 8), ("Senior Software Engineer", 0), ("data engineer", 10), ("senoir data engineer", 9), ("engineer", 0), ("Munich", 0), ("Bern", 0), ("York", 0),
    ],
)
def test_any_list_of_names(spark, name, want):
    """Cities and job titles: entries of one word to four, no language's usage but one word left out."""
    ref = spark.createDataFrame(CITIES, "canon_id long, name_zh string, name_en string, abbr string")
    got = canonical.to_canonical(spark.createDataFrame([(1, name)], "entity_id long, name string"), ref, usage=canonical.Usage(frozenset({"of"}))).collect()
    assert [r["canon_id"] for r in got] == ([] if want is None else [want])


def test_whole_forms_in_a_join(spark, rows):
    ref = spark.createDataFrame(CITIES, "canon_id long, name_zh string, name_en string, abbr string")
    names = ["Berlni", "Berlin", "new york", "SAN FRANCISCO BAY AREA", "Sao Paulo", "sofware enginere", "上诲", None, " ", "nothing like it", "σ", "x" * 30_000]
    df = spark.createDataFrame(list(enumerate(names)) + [(2, "new york")], "entity_id long, name string").withColumn("form", F.lit("clash"))
    want = [(0, 1), (2, 2), (2, 2), (3, 3), (4, 6), (5, 8), (6, 0), (9, 0), (10, 0), (11, 0)]
    assert rows(canonical.to_canonical_joined(df, ref), "entity_id", "canon_id") == sorted(want, key=repr)
    assert {r["canon_id"] for r in canonical.to_canonical_joined(df, ref.limit(0)).collect()} == {0} and canonical.to_canonical_joined(df.limit(0), ref).count() == 0


def test_longer_lists_are_refused_with_the_other_way(spark, monkeypatch):
    monkeypatch.setattr(canonical, "MAX_ENTRIES", 3)
    ref = spark.createDataFrame(CITIES, "canon_id long, name_zh string, name_en string, abbr string")
    with pytest.raises(ValueError, match="to_canonical_joined"):
        canonical.to_canonical(spark.createDataFrame([(1, "x")], "entity_id long, name string"), ref)


def test_distance_weights():
    assert canonical.distance("ab", "ba") < canonical.distance("ab", "abb") < canonical.distance("abc", "ab") < canonical.distance("ab", "ac")
    assert canonical.distance("", "abc") == pytest.approx(2.7) and canonical.distance("same", "same") == 0


# ------------------------------------------------------------------------------------------------------------ packing


def test_first_fit_decreasing_against_a_scan():
    rng = random.Random(3)
    for _ in range(30):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(0, 60))]
        free, want = [], [0] * len(sizes)
        for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
            at = next((i for i, f in enumerate(free) if f >= sizes[k]), None)
            if at is None:
                free.append(100)
                at = len(free) - 1
            free[at] -= sizes[k]
            want[k] = at
        assert packing.first_fit_decreasing(sizes, 100) == want
    with pytest.raises(ValueError):
        packing.first_fit_decreasing([101], 100)


def test_pack_keeps_documents_whole(spark):
    texts = ["word " * n for n in (1, 3, 500, 40, 40, 40, 7)] + [None, "", " \n\u200b", "中文" * 30, "word " * 40]
    docs = spark.createDataFrame([(i if i < 11 else 5, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, container_id string")
    got = packing.pack(docs, capacity=64, group_size=4).toPandas()
    count = {i: len(packing.encoder(packing.VOCABULARY, packing.ranks_of(packing.VOCABULARY)).encode_ordinary(t)) for i, t in enumerate(texts) if t and t.strip(" \n\u200b")}
    assert got.groupby("container_id")["n_tokens"].sum().max() <= 64
    for i, n in count.items():
        i = min(i, 11) if i != 11 else 5
        mine = got[got["doc_id"] == i]
        assert mine["n_tokens"].sum() == n * (2 if i == 5 else 1)
        if n <= 64:
            assert (mine["piece"] == 0).all()
    assert set(got["doc_id"]) == {0, 1, 2, 3, 4, 5, 6, 10}
    assert packing.pack(docs.limit(0), capacity=64).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, capacity=0)


def test_greedy_search_against_brute_force(spark):
    m = clouds(1200, 16, 4).astype(np.float32)
    m[50:60] = m[49]
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(len(m))] + [(9000, None)], "node_id long, embedding array<float>")
    c = neighbors.Collection(df, dim=16, k=10, leaf=60)
    got = neighbors.search(c, df.where("node_id % 50 = 0"), k=5).toPandas()
    u = m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    hit = 0
    for q, mine in got.groupby("node_id")["neighbor"]:
        s = np.round(u @ u[q], 6)
        s[q] = -2
        hit += sum(s[v] >= np.sort(s)[-5] for v in mine)
    assert len(got) == 24 * 5 and hit / len(got) >= 0.9
    exact = neighbors.nearest_exact(c, df.where("node_id % 50 = 0"), k=5, block=7).toPandas()
    for q, mine in exact.groupby("node_id"):
        s = np.round(u @ u[q], 6)
        s[q] = -2
        assert sorted(mine["rank"]) == [1, 2, 3, 4, 5] and np.allclose(np.sort(mine["cosine"])[::-1], np.sort(s)[::-1][:5], atol=1e-5)
    assert neighbors.nearest_exact(c, df.limit(0)).count() == 0
    assert set(got[got["node_id"] == 50]["neighbor"]) <= set(range(49, 60)) and neighbors.search(c, df.limit(0)).count() == 0
