"""Queries on resolution and on views of the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_name
from ..models import DescribedJudge
from ..operators import graph as G
from ..operators import judging as J
from ..operators import merge as M
from ..operators import resolve as R
from ..session import table
from . import sqlparts as S
from .merging import SIDES, graph_of, triples_of

BUDGET = 200


def _candidates(spark, sf) -> DataFrame:
    return table(spark, sf, "merge_candidates")


def _ruled(spark, sf) -> DataFrame:
    return R.pair_rules(_candidates(spark, sf), triples_of(spark, sf))


def knn_candidates(spark, sf):
    return R.knn_candidates(table(spark, sf, "entity_vectors"), 0.78)


def rescored_candidates(spark, sf):
    """Candidates of the earlier run with the cosine their vectors have now."""
    return R.score_pairs(_candidates(spark, sf).select("candidate_id", "left_id", "right_id"), table(spark, sf, "entity_vectors")).select("candidate_id", "cosine")


def pair_rules(spark, sf):
    return _ruled(spark, sf).select("candidate_id", "decision", "reason_code")


def budget_split(spark, sf):
    return R.budget_split(_ruled(spark, sf), BUDGET).select("candidate_id", "route")


def merge_audit_counts(spark, sf):
    return R.audit_counts(R.budget_split(_ruled(spark, sf), BUDGET))


def _accepted(spark, sf) -> DataFrame:
    return _ruled(spark, sf).where("decision = 'merge' and left_id != right_id")


def components(spark, sf):
    return R.components(_accepted(spark, sf), "left_id", "right_id").select(F.col("name").alias("node_id"), "cluster")


def _decided(spark, sf) -> DataFrame:
    d = table(spark, sf, "merge_decisions")
    word = F.lower(F.regexp_replace("decision", r"[\s_]+", ""))
    return d.where((word == "merge") & F.col("left_name").isNotNull() & F.col("right_name").isNotNull() & (F.col("left_name") != F.col("right_name")))


def cluster_conflicts(spark, sf):
    return R.cluster_conflicts(_decided(spark, sf), triples_of(spark, sf))


def canonical_pick(spark, sf):
    d = _decided(spark, sf)
    members = R.components(d, "left_name", "right_name")
    return R.canonical_pick(members, table(spark, sf, "entity_vectors").where("name is not null").select("name", "frequency"), d.where("canonical_name is not null").select(F.col("canonical_name").alias("name")))


def decisions_validated(spark, sf):
    """Decisions of the earlier run as a judge's replies: what was shown are the ids of the triples of either name, and the
    context was cut where there are more than eight triples or three descriptions of one of them."""
    d = table(spark, sf, "merge_decisions").select("decision_id", "left_id", "right_id", "left_name", "right_name", "decision", "canonical_name", "reason_code", "reason", "supporting_evidence_ids", "conflict_evidence_ids")
    kinds = table(spark, sf, "entity_vectors").select("node_id", "type")
    d = d.join(kinds.toDF("left_id", "left_type"), "left_id", "left").join(kinds.toDF("right_id", "right_type"), "right_id", "left")
    raw = table(spark, sf, "triples_raw")
    ids = M.stated(raw).select(F.substring_index("id", ":", -1).alias("t"), F.explode(F.array_distinct(F.array("head", "tail"))).alias("name")).groupBy("name").agg(F.collect_set(F.nullif("t", F.lit(""))).alias("ids"))
    c = M.entity_context(M.mentions(table(spark, sf, "entities_raw")), M.stated(raw))
    about = c.select("name", ((F.col("total_triples") > 8) | (F.col("total_descriptions") > 3)).alias("cut")).join(ids, "name", "left")
    for side in ("left", "right"):
        d = d.withColumn(f"{side}_n", normalize_name(F.col(f"{side}_name"))).join(about.toDF(f"{side}_n", f"{side}_cut", f"{side}_ids"), f"{side}_n", "left")
    none = F.array().cast("array<string>")
    d = d.withColumn("shown_ids", F.array_union(F.coalesce("left_ids", none), F.coalesce("right_ids", none))).withColumn("truncated", F.coalesce("left_cut", F.lit(False)) | F.coalesce("right_cut", F.lit(False)))
    joined = lambda k: F.array_join(F.sort_array(k), ",").alias(k)
    return R.validated(d, M.valid_triples(raw)).select("decision_id", "decision", "method", "reason_code", "canonical_name", joined("supporting_evidence_ids"), joined("conflict_evidence_ids"))


def _merge_candidates(spark, sf):
    """Candidates of the earlier run between entities of the merged graph."""

    def find(entities: DataFrame) -> DataFrame:
        a, b = normalize_name(F.col("left_name")), normalize_name(F.col("right_name"))
        c = _candidates(spark, sf).where("score <= 1").select(F.least(a, b).alias("left_name"), F.greatest(a, b).alias("right_name"), "score").where((a != b))
        one = c.groupBy("left_name", "right_name").agg(F.max("score").alias("score"))
        kinds = entities.select("name", "type")
        return one.join(kinds.toDF("left_name", "left_type"), "left_name").join(kinds.toDF("right_name", "right_type"), "right_name")

    return find


def _merged(spark, sf, strategy: str = "recheck") -> J.Merged:
    return J.merge_directory(table(spark, sf, "entities_raw"), table(spark, sf, "triples_raw"), _merge_candidates(spark, sf), DescribedJudge, J.MergeOptions(strategy, similarity_threshold=0.78))


def judge_context(spark, sf):
    """What a judge is shown of each candidate pair."""
    first = M.merge_entities(M.valid_entities(table(spark, sf, "entities_raw")))
    pairs = _merge_candidates(spark, sf)(first).where("score >= 0.78")
    c = J.pair_context(pairs, M.entity_context(M.mentions(table(spark, sf, "entities_raw")), M.stated(table(spark, sf, "triples_raw"))))
    return c.select("left_name", "right_name", "truncated", F.array_join("shown_ids", " ").alias("shown"), *[F.col(f"{s}.{k}").alias(f"{s}_{k}") for s in ("left", "right") for k in ("omitted_descriptions", "omitted_triples")])


def judged_merge(spark, sf):
    """The decision on every candidate pair, with a judge that merges what has descriptions."""
    return _merged(spark, sf).decisions.select("left_name", "right_name", "decision", "method", "reason_code", "canonical_name", F.size("supporting_evidence_ids").cast("bigint").alias("support"))


def merge_summary(spark, sf):
    return _merged(spark, sf).summary


def merged_graph(spark, sf):
    """The graph after resolution, in its order."""
    return _merged(spark, sf).triples.select("head", "head_type", "relation", "tail", "tail_type", "frequency", F.to_json("evidences").alias("evidences"))


def merged_graph_entities(spark, sf):
    return _merged(spark, sf).entities.select("name", "type", "description", "frequency")


def rules_only_merge(spark, sf):
    """The decisions without a judge."""
    return _merged(spark, sf, "rules").decisions.select("left_name", "right_name", "decision", "method", "reason_code", "canonical_name")


def ordered_candidates(spark, sf):
    """Candidate pairs from the most similar on."""
    c = _candidates(spark, sf).where("score is not null").select("candidate_id", "left_name", "right_name", "score")
    return J.ordered_candidates(c)


def _view(spark, sf) -> tuple[DataFrame, DataFrame]:
    e, t = graph_of(spark, sf)
    return G.nodes_of(e), G.links_of(t)


def top_nodes(spark, sf):
    return G.top_nodes(_view(spark, sf)[0], 1000)


def induced_subgraph(spark, sf):
    n, l = _view(spark, sf)
    return G.induced_links(l, G.top_nodes(n, 1000), 4000)


def graph_meta(spark, sf):
    n, l = _view(spark, sf)
    top = G.top_nodes(n, 1000)
    return G.view_meta(n, l, top, G.induced_links(l, top, 4000))


def visible_links(spark, sf):
    return G.visible(*_view(spark, sf), ["Metric"], ["COMPARED_WITH"])[1].select("source", "type", "target", "frequency")


def neighbors(spark, sf):
    return G.neighbors(_view(spark, sf)[1])


def out_degree(spark, sf):
    return G.out_degree(_view(spark, sf)[1])


def degree_summary(spark, sf):
    return G.degree_summary(*_view(spark, sf))


def cumulative_share(spark, sf):
    return G.cumulative_share(_view(spark, sf)[0])


def parallel_edges(spark, sf):
    return G.parallel_edges(_view(spark, sf)[1])


def node_radius(spark, sf):
    return G.drawing(_view(spark, sf)[0])


def link_width(spark, sf):
    return G.link_widths(_view(spark, sf)[1])


def graph_counts(spark, sf):
    return G.graph_counts(*_view(spark, sf))


QUERIES = {
    f.__name__: f
    for f in (
        knn_candidates, rescored_candidates, pair_rules, budget_split, merge_audit_counts, components, cluster_conflicts, canonical_pick, decisions_validated,
        judge_context, judged_merge, rules_only_merge, merge_summary, merged_graph, merged_graph_entities, ordered_candidates, link_width, graph_counts, top_nodes, induced_subgraph, graph_meta, visible_links, neighbors, out_degree, degree_summary, cumulative_share, parallel_edges, node_radius,
    )
}

_LINKS = f"lk AS MATERIALIZED (SELECT DISTINCT least(h, x) AS lo, greatest(h, x) AS hi FROM (SELECT {S.normalize('head')} AS h, {S.normalize('tail')} AS x FROM t) WHERE h <> x)"
_STRONG = lambda a, b: f"({S.normalize(a)} = {S.normalize(b)} OR {S.compact(a)} = {S.compact(b)})"
_PAIR = lambda a, b: f"EXISTS (SELECT 1 FROM lk WHERE lo = least({S.normalize(a)}, {S.normalize(b)}) AND hi = greatest({S.normalize(a)}, {S.normalize(b)}))"
_FLAG = f"""nm AS MATERIALIZED (SELECT *, {S.normalize('left_name')} AS nl, {S.normalize('right_name')} AS nr FROM merge_candidates),
fl AS MATERIALIZED (SELECT nm.*, lk.lo IS NOT NULL AS linked FROM nm LEFT JOIN lk ON lk.lo = least(nl, nr) AND lk.hi = greatest(nl, nr))"""
_RULED = f"""WITH {S.T}, {_LINKS}, {_FLAG},
ru AS MATERIALIZED (SELECT *, CASE WHEN reason_code = 'STRONG_NAME_EQUIVALENCE' THEN 'merge' WHEN reason_code = 'AMBIGUOUS_REQUIRES_LLM' THEN 'needs_llm' ELSE 'keep_separate' END AS decision
FROM (SELECT *, CASE WHEN left_type IS DISTINCT FROM right_type THEN 'TYPE_MISMATCH' WHEN coalesce({_STRONG('left_name', 'right_name')}, false) THEN 'STRONG_NAME_EQUIVALENCE'
  WHEN linked THEN 'DIRECT_RELATION_SELF_LOOP_RISK' ELSE 'AMBIGUOUS_REQUIRES_LLM' END AS reason_code FROM fl))"""
_SPLIT = f"""{_RULED},
ins AS (SELECT candidate_id FROM ru WHERE decision = 'needs_llm' ORDER BY coalesce(score, '-inf'::DOUBLE) DESC, left_name, right_name, candidate_id LIMIT {BUDGET}),
ro AS MATERIALIZED (SELECT *, CASE WHEN decision <> 'needs_llm' THEN 'rules' WHEN candidate_id IN (SELECT candidate_id FROM ins) THEN 'review' ELSE 'skipped' END AS route FROM ru)"""
_REACH = lambda src: f"""bi AS MATERIALIZED (SELECT a AS x, b AS y FROM {src} UNION SELECT b, a FROM {src}),
reach(name, other) AS (SELECT x, x FROM bi UNION SELECT r.name, bi.y FROM reach r JOIN bi ON r.other = bi.x),
mem AS MATERIALIZED (SELECT name, min(other) AS cluster FROM reach GROUP BY name)"""  # noqa: E731
_DECIDED = """pr AS MATERIALIZED (SELECT DISTINCT least(left_name, right_name) AS a, greatest(left_name, right_name) AS b FROM merge_decisions
WHERE regexp_replace(lower(decision), '[\\s_]+', '', 'g') = 'merge' AND left_name IS NOT NULL AND right_name IS NOT NULL AND left_name <> right_name)"""
_CASE = lambda col, table_: f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table_.items()) + " END"
_VIEW = S.GRAPH + f""",
no AS MATERIALIZED (SELECT * FROM (SELECT {_CASE('type', G.NODE_LABELS)} AS label, name, description, frequency FROM me) WHERE label IS NOT NULL),
li AS MATERIALIZED (SELECT head AS source, tail AS target, {_CASE('relation', G.EDGE_LABELS)} AS type, frequency, to_json(evidences)::VARCHAR AS evidences FROM tt),
tn AS MATERIALIZED (SELECT * FROM no ORDER BY frequency DESC, name, label LIMIT 1000),
tl AS MATERIALIZED (SELECT * FROM li WHERE source IN (SELECT name FROM tn) AND target IN (SELECT name FROM tn) ORDER BY frequency DESC, source, type, target LIMIT 4000)
"""
_FINE = lambda a: f"len({a}) = 64 AND list_bool_and(list_transform({a}, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform({a}, lambda x: x <> 0))"

_IDS = lambda c: f"list_sort(list_distinct(list_filter(list_transform(coalesce({c}, []), lambda x: {S.strip('x')}), lambda x: x <> '')))"
_CUT = "(coalesce({a}.total, 0) > 8 OR coalesce({b}.total, 0) > 3)"
#: Accepted and other decisions on candidate pairs between merged entities: cd, ru (rules), de (decisions).
_DECIDE = lambda judged: f"""WITH RECURSIVE {S.E}, {S.T}, {S.ME}, {_LINKS}, {SIDES},
cd AS MATERIALIZED (SELECT lo AS left_name, hi AS right_name, a.type AS left_type, b.type AS right_type, a.frequency AS lf, b.frequency AS rf, score FROM (SELECT least(l, r) AS lo, greatest(l, r) AS hi, max(score) AS score FROM (
  SELECT {S.normalize('left_name')} AS l, {S.normalize('right_name')} AS r, score FROM merge_candidates WHERE score <= 1) WHERE l <> r GROUP BY 1, 2) JOIN me a ON a.name = lo JOIN me b ON b.name = hi WHERE score >= 0.78),
cn AS MATERIALIZED (SELECT cd.*, {S.normalize('left_name')} AS nl, {S.normalize('right_name')} AS nq FROM cd),
ru AS MATERIALIZED (SELECT cn.*, CASE WHEN left_type <> right_type THEN 'TYPE_MISMATCH' WHEN {_STRONG('left_name', 'right_name')} THEN 'STRONG_NAME_EQUIVALENCE' WHEN lk.lo IS NOT NULL THEN 'DIRECT_RELATION_SELF_LOOP_RISK' ELSE 'AMBIGUOUS_REQUIRES_LLM' END AS code,
  CASE WHEN (-lf, length(left_name), left_name) <= (-rf, length(right_name), right_name) THEN left_name ELSE right_name END AS best FROM cn LEFT JOIN lk ON lk.lo = least(nl, nq) AND lk.hi = greatest(nl, nq)),
bu AS MATERIALIZED (SELECT left_name, right_name FROM ru WHERE code = 'AMBIGUOUS_REQUIRES_LLM' ORDER BY score DESC, left_name, right_name LIMIT {{budget}}),
sh AS MATERIALIZED (SELECT ru.*, lm.total AS ld, rm.total AS rd, {_CUT.format(a='lt', b='lm')} OR {_CUT.format(a='rt', b='rm')} AS cut FROM ru LEFT JOIN nt lt ON lt.name = left_name LEFT JOIN nt rt ON rt.name = right_name LEFT JOIN mt_ lm ON lm.name = left_name LEFT JOIN mt_ rm ON rm.name = right_name),
de AS MATERIALIZED (
  SELECT left_name, right_name, CASE WHEN code = 'STRONG_NAME_EQUIVALENCE' THEN 'merge' ELSE 'keep_separate' END AS decision, 'rules' AS method, code AS reason_code, CASE WHEN code = 'STRONG_NAME_EQUIVALENCE' THEN best END AS canonical_name, 0 AS support FROM ru WHERE code <> 'AMBIGUOUS_REQUIRES_LLM'
  {judged})""".replace("{budget}", str(BUDGET))  # noqa: E731
_WITH_JUDGE = _DECIDE("""UNION ALL SELECT left_name, right_name, 'unsure', 'llm_recheck_skipped', 'MAX_PAIRS_EXCEEDED', NULL, 0 FROM ru WHERE code = 'AMBIGUOUS_REQUIRES_LLM' AND (left_name, right_name) NOT IN (SELECT (left_name, right_name) FROM bu)
  UNION ALL SELECT left_name, right_name, CASE WHEN ld > 0 AND rd > 0 AND NOT cut THEN 'merge' ELSE 'unsure' END, 'llm_recheck', CASE WHEN ld > 0 AND rd > 0 THEN CASE WHEN cut THEN 'TRUNCATED_CONTEXT' ELSE 'DESCRIBED' END ELSE 'LLM_RECHECK' END,
    CASE WHEN ld > 0 AND rd > 0 AND NOT cut THEN left_name END, CASE WHEN ld > 0 AND rd > 0 THEN 2 ELSE 0 END FROM sh JOIN bu USING (left_name, right_name)""")
_RULES_ALONE = _DECIDE("UNION ALL SELECT left_name, right_name, 'unsure', 'rules_only', 'LLM_RECHECK_DISABLED', NULL, 0 FROM ru WHERE code = 'AMBIGUOUS_REQUIRES_LLM'")
_RESOLVED = f"""{_WITH_JUDGE},
pr AS MATERIALIZED (SELECT DISTINCT left_name AS a, right_name AS b FROM de WHERE decision = 'merge'), {_REACH('pr')},
sz AS (SELECT cluster, count(*) AS size FROM mem GROUP BY cluster),
ip AS MATERIALIZED (SELECT a.cluster, a.name AS a, b.name AS b, {S.normalize('a.name')} AS na, {S.normalize('b.name')} AS nb FROM mem a JOIN mem b ON a.cluster = b.cluster AND a.name < b.name JOIN sz ON sz.cluster = a.cluster AND sz.size <= 4 WHERE NOT {_STRONG('a.name', 'b.name')}),
bad AS MATERIALIZED (SELECT cluster FROM sz WHERE size > 4 UNION SELECT ip.cluster FROM ip LEFT JOIN pr ON pr.a = ip.a AND pr.b = ip.b LEFT JOIN lk ON lk.lo = least(na, nb) AND lk.hi = greatest(na, nb) WHERE pr.a IS NULL OR lk.lo IS NOT NULL),
mp AS MATERIALIZED (SELECT mem.name, c.canonical FROM mem JOIN (SELECT cluster, arg_min(mem.name, {{'p': CASE WHEN mem.name IN (SELECT canonical_name FROM de WHERE decision = 'merge') THEN 0 ELSE 1 END, 'f': -me.frequency, 'l': length(mem.name), 'n': mem.name}}) AS canonical FROM mem JOIN me ON me.name = mem.name GROUP BY cluster) c USING (cluster)
  WHERE cluster NOT IN (SELECT cluster FROM bad)),
fe AS MATERIALIZED (SELECT n AS name, arg_min(type, pos) AS type, coalesce(arg_min(description, pos) FILTER (WHERE description <> ''), '') AS description, sum(frequency)::BIGINT AS frequency
  FROM (SELECT me.*, {S.normalize('coalesce(mp.canonical, me.name)')} AS n FROM me LEFT JOIN mp ON mp.name = me.name) WHERE length(n) >= 2 GROUP BY n),
t1 AS (SELECT {S.normalize('head')} AS head, relation, {S.normalize('tail')} AS tail, evidence, pos FROM t),
t2 AS (SELECT coalesce(h.canonical, head) AS head, relation, coalesce(x.canonical, tail) AS tail, evidence, pos FROM t1 LEFT JOIN mp h ON h.name = head LEFT JOIN mp x ON x.name = tail),
t3 AS (SELECT {S.normalize('head')} AS head, relation, {S.normalize('tail')} AS tail, evidence, pos FROM t2 WHERE head <> tail),
ft AS MATERIALIZED (SELECT head, relation, tail, sum(n)::BIGINT AS frequency, coalesce(list(evidence ORDER BY pos) FILTER (WHERE evidence <> ''), []) AS evidences FROM (
  SELECT head, relation, tail, evidence, count(*) AS n, min(pos) AS pos FROM t3 WHERE head <> tail AND head IN (SELECT name FROM fe) AND tail IN (SELECT name FROM fe) GROUP BY ALL) GROUP BY head, relation, tail)"""

SQL = {
    "knn_candidates": f"""WITH v AS MATERIALIZED (SELECT node_id, type, embedding::DOUBLE[] AS e FROM entity_vectors WHERE type IS NOT NULL AND CASE WHEN embedding IS NULL THEN false WHEN len(embedding) <> 64 THEN false ELSE {_FINE('embedding')} END),
p AS (SELECT l.node_id AS left_id, r.node_id AS right_id, round(list_cosine_similarity(l.e, r.e), 6) AS score FROM v l JOIN v r ON l.type = r.type AND l.node_id <> r.node_id),
k AS (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY score DESC, right_id) AS n FROM p)
SELECT left_id, right_id, score FROM k WHERE n <= 10 AND score >= 0.78 AND left_id < right_id""",
    "rescored_candidates": f"""WITH v AS MATERIALIZED (SELECT node_id, embedding::DOUBLE[] AS e FROM entity_vectors WHERE CASE WHEN embedding IS NULL THEN false WHEN len(embedding) <> 64 THEN false ELSE {_FINE('embedding')} END)
SELECT candidate_id, round(list_cosine_similarity(l.e, r.e), 6) AS cosine FROM merge_candidates LEFT JOIN v l ON left_id = l.node_id LEFT JOIN v r ON right_id = r.node_id""",
    "decisions_validated": f"""WITH {S.T}, {_LINKS}, {SIDES},
ev AS (SELECT name, list(DISTINCT evidence_id) FILTER (WHERE evidence_id <> '') AS ids FROM n GROUP BY name),
ab AS MATERIALIZED (SELECT coalesce(nt.name, mt_.name) AS name, coalesce(nt.total, 0) > 8 OR coalesce(mt_.total, 0) > 3 AS cut FROM nt FULL JOIN mt_ ON nt.name = mt_.name),
d AS MATERIALIZED (SELECT m.*, lv.type AS lt, rv.type AS rt, {S.normalize('left_name')} AS nl, {S.normalize('right_name')} AS nq FROM merge_decisions m LEFT JOIN entity_vectors lv ON lv.node_id = left_id LEFT JOIN entity_vectors rv ON rv.node_id = right_id),
f AS MATERIALIZED (SELECT d.*, lower({S.text('decision')}) AS w, {S.strip('d.canonical_name')} AS cn, {_IDS('supporting_evidence_ids')} AS s0, {_IDS('conflict_evidence_ids')} AS c0, coalesce(le.ids, []) || coalesce(re.ids, []) AS shown,
  coalesce(la.cut, false) OR coalesce(ra.cut, false) AS cut, lk.lo IS NOT NULL AS linked FROM d LEFT JOIN ev le ON le.name = nl LEFT JOIN ev re ON re.name = nq LEFT JOIN ab la ON la.name = nl LEFT JOIN ab ra ON ra.name = nq LEFT JOIN lk ON lk.lo = least(nl, nq) AND lk.hi = greatest(nl, nq)),
g AS MATERIALIZED (SELECT *, list_filter(s0, lambda x: list_contains(shown, x)) AS s1, list_filter(c0, lambda x: list_contains(shown, x)) AS c1,
  CASE WHEN lt IS DISTINCT FROM rt THEN 'TYPE_MISMATCH' WHEN coalesce({_STRONG('left_name', 'right_name')}, false) THEN NULL WHEN linked THEN 'DIRECT_RELATION_SELF_LOOP_RISK' END AS hard FROM f),
h AS (SELECT *, len(s1) = len(s0) AS known, coalesce(cn IN (left_name, right_name), false) AND len(s1) = len(s0) AND len(c1) = 0 AND len(s1) > 0 AS fine FROM g),
i AS (SELECT *, CASE WHEN w = 'merge' THEN CASE WHEN fine THEN 'merge' ELSE 'unsure' END WHEN known AND w IN ('keep_separate', 'unsure') THEN w ELSE 'unsure' END AS dec FROM h),
j AS (SELECT *, hard IS NULL AND dec = 'merge' AND cut AS late FROM i)
SELECT decision_id, CASE WHEN hard IS NOT NULL THEN 'keep_separate' WHEN late THEN 'unsure' ELSE dec END AS decision, CASE WHEN hard IS NOT NULL THEN 'rules_after_llm' ELSE 'llm_recheck' END AS method,
  CASE WHEN hard IS NOT NULL THEN hard WHEN late THEN 'TRUNCATED_CONTEXT' ELSE coalesce(nullif({S.strip('reason_code')}, ''), 'LLM_RECHECK') END AS reason_code,
  CASE WHEN hard IS NULL AND NOT late AND dec = 'merge' THEN cn END AS canonical_name, CASE WHEN hard IS NULL THEN array_to_string(s1, ',') ELSE '' END AS supporting_evidence_ids, CASE WHEN hard IS NULL THEN array_to_string(c1, ',') ELSE '' END AS conflict_evidence_ids FROM j""",
    "judge_context": f"""{_WITH_JUDGE},
sd AS (SELECT left_name, right_name, unnest(['L', 'R']) AS side, unnest([left_name, right_name]) AS name FROM cd),
si AS (SELECT sd.*, coalesce(nt.total, 0) AS tt, coalesce(mt_.total, 0) AS dd FROM sd LEFT JOIN nt USING (name) LEFT JOIN mt_ USING (name)),
wd AS (SELECT left_name, right_name, string_agg(w, ' ' ORDER BY side) AS shown, bool_or(tt > 8 OR dd > 3) AS truncated, max(CASE WHEN side = 'L' THEN greatest(dd - 3, 0) END) AS left_omitted_descriptions, max(CASE WHEN side = 'L' THEN greatest(tt - 8, 0) END) AS left_omitted_triples,
  max(CASE WHEN side = 'R' THEN greatest(dd - 3, 0) END) AS right_omitted_descriptions, max(CASE WHEN side = 'R' THEN greatest(tt - 8, 0) END) AS right_omitted_triples
  FROM (SELECT *, nullif(array_to_string(list_transform(range(1, least(dd, 3) + 1), lambda i: side || '_DESC_' || i) || list_transform(range(1, least(tt, 8) + 1), lambda i: side || '_TRIPLE_' || i), ' '), '') AS w FROM si) GROUP BY 1, 2)
SELECT left_name, right_name, truncated, coalesce(shown, '') AS shown, left_omitted_descriptions, left_omitted_triples, right_omitted_descriptions, right_omitted_triples FROM wd""",
    "judged_merge": _WITH_JUDGE + "\nSELECT left_name, right_name, decision, method, reason_code, canonical_name, support::BIGINT AS support FROM de",
    "rules_only_merge": _RULES_ALONE + "\nSELECT left_name, right_name, decision, method, reason_code, canonical_name FROM de",
    "merge_summary": _WITH_JUDGE + "\nSELECT 'recheck' AS strategy, count(*) AS candidates, count(*) FILTER (WHERE method = 'llm_recheck') AS reviewed, count(*) FILTER (WHERE reason_code = 'MAX_PAIRS_EXCEEDED') AS skipped, count(*) FILTER (WHERE decision = 'merge') AS merged FROM de",
    "merged_graph": _RESOLVED + "\nSELECT head, coalesce(h.type, '') AS head_type, relation, tail, coalesce(x.type, '') AS tail_type, ft.frequency, to_json(evidences)::VARCHAR AS evidences FROM ft LEFT JOIN fe h ON h.name = head LEFT JOIN fe x ON x.name = tail",
    "merged_graph_entities": _RESOLVED + "\nSELECT name, type, description, frequency FROM fe",
    "ordered_candidates": "SELECT candidate_id, left_name, right_name, score FROM merge_candidates WHERE score IS NOT NULL ORDER BY score DESC, left_name, right_name",
    "link_width": _VIEW + "SELECT source, type, target, round(0.6 + 3.4 * coalesce(frequency, 1)::DOUBLE / (SELECT max(frequency) FROM li)::DOUBLE, 6) AS width FROM li",
    "graph_counts": _VIEW + "SELECT (SELECT count(*) FROM no) AS nodes, (SELECT count(*) FROM li) AS relationships",
    "pair_rules": _RULED + "\nSELECT candidate_id, decision, reason_code FROM ru",
    "budget_split": _SPLIT + "\nSELECT candidate_id, route FROM ro",
    "merge_audit_counts": _SPLIT + """
SELECT count(*) AS candidates, count(*) FILTER (WHERE route = 'review') AS reviewed, count(*) FILTER (WHERE route = 'skipped') AS skipped,
  count(*) FILTER (WHERE decision = 'merge') AS merged, count(*) FILTER (WHERE decision = 'keep_separate') AS kept_separate FROM ro""",
    "components": _RULED.replace("WITH", "WITH RECURSIVE", 1) + f",\nac AS MATERIALIZED (SELECT DISTINCT least(left_id, right_id) AS a, greatest(left_id, right_id) AS b FROM ru WHERE decision = 'merge' AND left_id <> right_id),\n{_REACH('ac')}\nSELECT name AS node_id, cluster FROM mem",
    "cluster_conflicts": f"""WITH RECURSIVE {S.T}, {_LINKS}, {_DECIDED}, {_REACH('pr')},
sz AS (SELECT cluster, count(*) AS size FROM mem GROUP BY cluster),
ip AS MATERIALIZED (SELECT a.cluster, sz.size, a.name AS a, b.name AS b, {S.normalize('a.name')} AS na, {S.normalize('b.name')} AS nb FROM mem a JOIN mem b ON a.cluster = b.cluster AND a.name < b.name JOIN sz ON sz.cluster = a.cluster AND sz.size <= 4 WHERE NOT {_STRONG('a.name', 'b.name')}),
wr AS (SELECT ip.cluster, ip.size, ip.a, ip.b, CASE WHEN pr.a IS NULL THEN 'INCOMPLETE_PAIRWISE_CLUSTER' WHEN lk.lo IS NOT NULL THEN 'DIRECT_RELATION_IN_CLUSTER' END AS why
  FROM ip LEFT JOIN pr ON pr.a = ip.a AND pr.b = ip.b LEFT JOIN lk ON lk.lo = least(na, nb) AND lk.hi = greatest(na, nb))
SELECT cluster, size, 'CLUSTER_TOO_LARGE' AS reason_code FROM sz WHERE size > 4
UNION ALL SELECT cluster, size, arg_min(why, {{'x': a, 'y': b}}) FROM wr WHERE why IS NOT NULL GROUP BY cluster, size""",
    "canonical_pick": f"""WITH RECURSIVE {_DECIDED}, {_REACH('pr')},
fq AS (SELECT name, sum(frequency)::BIGINT AS f FROM entity_vectors WHERE name IS NOT NULL GROUP BY name),
pf AS (SELECT DISTINCT canonical_name AS name FROM merge_decisions WHERE regexp_replace(lower(decision), '[\\s_]+', '', 'g') = 'merge' AND left_name IS NOT NULL AND right_name IS NOT NULL AND left_name <> right_name AND canonical_name IS NOT NULL)
SELECT cluster, arg_min(name, {{'p': CASE WHEN name IN (SELECT name FROM pf) THEN 0 ELSE 1 END, 'f': -coalesce(f, 0), 'l': length(name), 'n': name}}) AS canonical, count(*) AS size FROM mem LEFT JOIN fq USING (name) GROUP BY cluster""",
    "top_nodes": _VIEW + "SELECT * FROM tn",
    "induced_subgraph": _VIEW + "SELECT * FROM tl",
    "graph_meta": _VIEW + """SELECT (SELECT count(*) FROM no) AS nodes_total, (SELECT count(*) FROM li) AS links_total, (SELECT count(*) FROM tn) AS nodes_returned, (SELECT max(frequency) FROM tn) AS max_node_frequency,
  (SELECT count(*) FROM tl) AS links_returned, (SELECT max(frequency) FROM tl) AS max_link_frequency, (SELECT count(*) FROM li) - (SELECT count(*) FROM tl) AS links_dropped,
  (SELECT count(*) FROM tn) < (SELECT count(*) FROM no) OR (SELECT count(*) FROM tl) < (SELECT count(*) FROM li) AS truncated""",
    "visible_links": _VIEW + "SELECT source, type, target, frequency FROM li WHERE type <> 'COMPARED_WITH' AND source IN (SELECT name FROM no WHERE label <> 'Metric') AND target IN (SELECT name FROM no WHERE label <> 'Metric')",
    "neighbors": _VIEW + "SELECT source AS name, target AS neighbor FROM li UNION SELECT target, source FROM li",
    "out_degree": _VIEW + "SELECT source, count(*) AS degree FROM li GROUP BY source ORDER BY degree DESC, source LIMIT 10",
    "degree_summary": _VIEW + """, d AS (SELECT name, count(*) AS d FROM (SELECT source AS name FROM li UNION ALL SELECT target FROM li) GROUP BY name)
SELECT count(*) AS nodes, count(d) AS connected, round(avg(d), 6) AS mean_degree, round(avg(frequency), 6) AS mean_frequency FROM no LEFT JOIN d USING (name)""",
    "cumulative_share": _VIEW + """, b AS (SELECT name, frequency FROM no ORDER BY frequency DESC, name LIMIT 10)
SELECT name, frequency, round((sum(frequency) OVER (ORDER BY frequency DESC, name))::DOUBLE / (SELECT sum(frequency) FROM no)::DOUBLE, 6) AS share FROM b""",
    "parallel_edges": _VIEW + f""", p AS (SELECT source, type, target, row_number() OVER (PARTITION BY least(source, target), greatest(source, target) ORDER BY source, target, type) - 1 AS place FROM li)
SELECT source, type, target, place, coalesce(([{', '.join(map(str, G.CURVES))}]::DOUBLE[])[place + 1], 0.6::DOUBLE) AS curvature FROM p""",
    "node_radius": _VIEW + "SELECT name, label, round(2.5 + 8.5 * ln(frequency::DOUBLE + 1) / ln((SELECT max(frequency) FROM no)::DOUBLE + 1), 6) AS radius, round(100 * frequency::DOUBLE / (SELECT max(frequency) FROM no)::DOUBLE, 6) AS bar FROM no",
}
