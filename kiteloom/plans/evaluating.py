"""Queries on evaluation. Predicted graphs are merged from the zs or the fs runs' entities, gold from all runs'."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import compact_name
from ..operators import evaluate as V
from ..operators import merge as M
from ..session import table
from . import sqlparts as S

RUNS = ("zs", "fs")


def _version():
    return F.regexp_replace(F.lower(F.coalesce("extractor_version", F.lit(""))), "[^a-z]", "")


def _runs():
    return {r: _version().startswith(r) for r in RUNS}


def graph(spark, sf, run: str) -> tuple[DataFrame, DataFrame]:
    """Merged entities and typed triples; run is zs, fs or gold (all runs)."""
    raw = table(spark, sf, "entities_raw")
    if run != "gold":
        raw = raw.where(_version().startswith(run))
    return M.merge_graph(raw, table(spark, sf, "triples_raw"))


def _pair(spark, sf, run: str = "zs"):
    (pe, pt), (ge, gt) = graph(spark, sf, run), graph(spark, sf, "gold")
    return pe, pt, ge, gt


def _scores(spark, sf) -> DataFrame:
    e = M.valid_entities(table(spark, sf, "entities_raw"), "extractor_version")
    return V.run_scores(V.run_sides(e, M.valid_triples(table(spark, sf, "triples_raw")), _runs()), list(RUNS))


def strict_eval_entities(spark, sf):
    return _scores(spark, sf).where("run = 'zs' and scope = 'entity'").drop("run", "scope")


def strict_eval_triples(spark, sf):
    return _scores(spark, sf).where("run = 'zs' and scope = 'triple'").drop("run", "scope")


def relation_level_eval(spark, sf):
    return _scores(spark, sf).where("run = 'zs' and scope = 'relation'").drop("run", "scope")


def evidence_coverage(spark, sf):
    _, pt, _, gt = _pair(spark, sf)
    return V.evidence_coverage(pt.withColumn("evidenced", F.size("evidences") > 0), gt)


def false_positives_topn(spark, sf):
    _, pt, _, gt = _pair(spark, sf)
    return V.errors(pt, gt, "fp", 20)


def false_negatives_topn(spark, sf):
    _, pt, _, gt = _pair(spark, sf)
    return V.errors(pt, gt, "fn", 20)


def attribute_accuracy(spark, sf):
    _, pt, _, gt = _pair(spark, sf, "fs")
    return V.attribute_accuracy(pt, gt)


def derived_entities(spark, sf):
    return V.entities_from(graph(spark, sf, "gold")[1])


def _raw(spark, sf) -> DataFrame:
    return V.raw_sides(table(spark, sf, "entities_raw"), table(spark, sf, "triples_raw"), _runs())


def raw_eval(spark, sf):
    return V.raw_scores(_raw(spark, sf), list(RUNS))


def raw_attributes(spark, sf):
    """Attribute accuracy of the zs runs' raw triples."""
    sides = _raw(spark, sf)
    return V.attribute_accuracy(sides.where("side = 'zs'"), sides.where("side = 'gold'"))


def raw_chunks(spark, sf):
    return V.raw_coverage(table(spark, sf, "entities_raw"), table(spark, sf, "triples_raw"), _runs())


def zs_fs_compare(spark, sf):
    return V.compare(_scores(spark, sf), ["scope"])


def eval_name_norm(spark, sf):
    _, pt, _, gt = _pair(spark, sf)
    return V.strict(V.normed(pt), V.normed(gt), V.TRIPLE)


def eval_entities_relaxed(spark, sf):
    pe, _, ge, _ = _pair(spark, sf)
    return V.entity_match(pe, ge)


def eval_substring(spark, sf):
    _, pt, _, gt = _pair(spark, sf)
    return V.substring_match(V.normed(pt), V.normed(gt))


def eval_head_relation(spark, sf):
    _, pt, _, gt = _pair(spark, sf)
    return V.head_relation_match(V.normed(pt), V.normed(gt))


def eval_alias(spark, sf):
    pe, pt, ge, gt = _pair(spark, sf)
    return V.alias_match(pt, gt, V.alias_index(pe, True), V.alias_index(ge, False))


def _reference(spark, sf) -> DataFrame:
    c = table(spark, sf, "canonical_entities")
    return c.select(F.explode(F.array_compact(F.array("name_zh", "name_en", "abbr"))).alias("name"), "type")


def candidate_tiers(spark, sf):
    """Names of the reference list against the merged entities of their type."""
    return V.candidate_tiers(_reference(spark, sf), M.merge_entities(M.valid_entities(table(spark, sf, "entities_raw"))))


def judge_recall(spark, sf):
    """Gold triples of all runs against those of the fs runs; ends are aligned by their compact names, and a judge calls
    relations equivalent that begin with letters of the same half of the alphabet."""
    _, pt, _, gt = _pair(spark, sf, "fs")
    g = V.entities_from(gt).toDF("gold_name", "gold_type").withColumn("k", compact_name(F.col("gold_name")))
    p = pt.select(F.explode(F.array("head", "tail")).alias("pred_name")).distinct().withColumn("k", compact_name(F.col("pred_name")))
    some = lambda df, c: df.select(F.col("relation").alias(c)).distinct().withColumn("half", F.col(c) < "b")
    judged = some(gt, "gold_relation").join(some(pt, "pred_relation"), "half").where("gold_relation != pred_relation")
    return V.judge_recall(gt, g.join(p, "k"), pt, judged).groupBy("match_kind").agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        strict_eval_entities, strict_eval_triples, relation_level_eval, evidence_coverage, false_positives_topn, false_negatives_topn, attribute_accuracy, derived_entities, raw_eval, raw_attributes,
        raw_chunks, zs_fs_compare, eval_name_norm, eval_entities_relaxed, eval_substring, eval_head_relation, eval_alias, candidate_tiers, judge_recall,
    )
}


def _run(run: str) -> str:
    return f"e_{run} AS (SELECT * FROM e WHERE regexp_replace(lower(coalesce(extractor_version, '')), '[^a-z]', '', 'g') LIKE '{run}%')"


def _graph(run: str) -> str:
    """CTEs me_<run>, tt_<run>."""
    source = "e" if run == "gold" else f"e_{run}"
    head = "" if run == "gold" else _run(run) + ",\n"
    mt = S.MT.replace("mt AS", f"mt_{run} AS").replace("FROM me)", f"FROM me_{run})")
    tt = S.TT.replace("tt AS", f"tt_{run} AS").replace("mt.*", "m.*").replace("FROM mt ", f"FROM mt_{run} m ").replace("JOIN me h ON mt.", f"JOIN me_{run} h ON m.").replace("JOIN me x ON mt.", f"JOIN me_{run} x ON m.")
    return head + S.merged_entities(source, f"me_{run}") + ",\n" + mt + ",\n" + tt


def _with(*runs: str) -> str:
    return f"WITH {S.E},\n{S.T},\n" + ",\n".join(_graph(r) for r in runs)


def _score(tp: str, fp: str, fn: str) -> str:
    safe = lambda a, b: f"round(CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a})::DOUBLE / ({b}) END, 6)"
    return f"{tp}::BIGINT AS tp, {fp}::BIGINT AS fp, {fn}::BIGINT AS fn, {safe(tp, f'{tp} + {fp}')} AS precision, {safe(tp, f'{tp} + {fn}')} AS recall, {safe(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')} AS f1"


def _strict(pred: str, gold: str, keys: list[str], extra: str = "") -> str:
    k = ", ".join(keys)
    return f"""SELECT {extra}{_score('a', 'b', 'c')} FROM (SELECT count(*) FILTER (WHERE p AND g) AS a, count(*) FILTER (WHERE p AND NOT g) AS b, count(*) FILTER (WHERE NOT p AND g) AS c
FROM (SELECT {k}, bool_or(p) AS p, bool_or(g) AS g FROM (SELECT {k}, true AS p, false AS g FROM {pred} UNION ALL SELECT {k}, false, true FROM {gold}) GROUP BY {k}))"""


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _compatible() -> str:
    """CTE kc: the characters whose compatibility form is another than their canonical one; with it and NFC any text's
    compatibility form can be written in SQL."""
    form = unicodedata.normalize
    pairs = [(c, form("NFKC", c)) for c in map(chr, (*range(0xA0, 0xD800), *range(0xE000, sys.maxunicode + 1))) if form("NFKC", c) != form("NFC", c)]
    return "kc(c, n) AS (VALUES " + ", ".join(f"({_quoted(c)}, {_quoted(n)})" for c, n in pairs) + ")"


def _forms(name: str, source: str) -> str:
    """CTE: compatibility form k and normalised name n of each text s that ``source`` selects."""
    return f"""{name} AS MATERIALIZED (SELECT s, k, {S.norm_ascii('k')} AS n FROM (
  SELECT s, nfc_normalize(string_agg(coalesce(kc.n, x.c), '' ORDER BY i)) AS k FROM (SELECT s, i, substr(s, i, 1) AS c FROM (SELECT s, unnest(range(1, length(s) + 1)) AS i FROM ({source}) WHERE s <> '')) x LEFT JOIN kc ON kc.c = x.c GROUP BY s))"""


def _normed(source: str, name: str) -> str:
    return f"{name} AS MATERIALIZED (SELECT coalesce(h.n, '') AS head, head_type, relation, coalesce(x.n, '') AS tail, tail_type FROM {source} LEFT JOIN nf h ON h.s = head LEFT JOIN nf x ON x.s = tail WHERE {S.text('head')} <> '' AND head_type <> '' AND relation <> '' AND {S.text('tail')} <> '' AND tail_type <> '')"


def _tier(keys: list[str], close: str, given: str = "true") -> str:
    k = ", ".join(keys)
    return f""",
g AS (SELECT row_number() OVER () AS i, {k} FROM ng WHERE {given}), p AS (SELECT row_number() OVER () AS i, {k} FROM np WHERE {given}),
m AS MATERIALIZED (SELECT g.i AS gi, p.i AS pi FROM g JOIN p ON g.relation = p.relation AND g.head_type = p.head_type AND g.tail_type = p.tail_type AND {close})
SELECT {_score('a', '(np_ - b)', '(ng_ - a)')} FROM (SELECT (SELECT count(DISTINCT gi) FROM m) AS a, (SELECT count(DISTINCT pi) FROM m) AS b, (SELECT count(*) FROM g) AS ng_, (SELECT count(*) FROM p) AS np_)"""


_K5 = ", ".join(V.TRIPLE)
_NORMED = f"""{_with("zs", "gold")},
{_compatible()},
{_forms("nf", "SELECT DISTINCT name AS s FROM me_gold UNION SELECT name FROM me_zs")},
{_normed("tt_zs", "np")},
{_normed("tt_gold", "ng")}"""
# pieces of descriptions are cut before they are brought to their compatibility form, as the operator does
_ALIASES = f"""pc AS MATERIALIZED (SELECT name, type, pos, unnest(regexp_split_to_array(description, '[,，;；/、]| or | and |\\s+又称\\s+|\\s+又叫\\s+')) AS s FROM me_zs),
{_forms("pf", "SELECT DISTINCT s FROM pc")},
ip AS MATERIALIZED (SELECT n AS alias, type, name, min(pos) AS pos FROM (SELECT n, type, name, pos FROM me_zs JOIN nf ON s = name WHERE n <> '' UNION ALL SELECT n, type, name, pos FROM pc JOIN pf USING (s) WHERE length(n) BETWEEN 2 AND 59) GROUP BY ALL),
ig AS MATERIALIZED (SELECT n AS alias, type, name, pos FROM me_gold JOIN nf ON s = name WHERE n <> '')"""
_HELD = lambda idx: f"{idx}_other AS MATERIALIZED (SELECT i.name, arg_min(c.canon, {{'p': i.pos, 'n': i.alias, 't': i.type}}) AS other FROM {idx} i JOIN canon c USING (alias, type) GROUP BY i.name)"
_KEYED = lambda n, src, idx: f"""{n} AS (SELECT coalesce(oh.canon, ah.other, h.n, '') AS head, head_type, relation, coalesce(ot.canon, at_.other, x.n, '') AS tail, tail_type FROM {src}
  LEFT JOIN nf h ON h.s = head LEFT JOIN nf x ON x.s = tail
  LEFT JOIN canon oh ON oh.alias = h.n AND oh.type = head_type LEFT JOIN canon ot ON ot.alias = x.n AND ot.type = tail_type
  LEFT JOIN {idx}_other ah ON ah.name = head LEFT JOIN {idx}_other at_ ON at_.name = tail WHERE head_type <> '' AND tail_type <> '')"""  # noqa: E731
_FLAGS = "regexp_replace(lower(coalesce(extractor_version, '')), '[^a-z]', '', 'g')"
_RAWS = ",\n".join(
    [
        f"WITH rt AS MATERIALIZED (SELECT * FROM (SELECT file_stem, {S.text('source_file')} <> '' AS sourced, {S.strip('head')} AS head, {S.strip('relation')} AS relation, {S.strip('tail')} AS tail FROM triples_raw) WHERE head <> '' AND relation <> '' AND tail <> '')",
        f"re AS MATERIALIZED (SELECT * FROM (SELECT file_stem, {_FLAGS} AS v, {S.at('entity_id')} AS pos, {S.strip('name')} AS name, {S.strip('type')} AS type FROM entities_raw WHERE file_stem IS NOT NULL) WHERE name <> '' AND type <> '')",
    ]
    + [f"k_{r} AS MATERIALIZED (SELECT file_stem, name, arg_max(type, pos) AS type FROM re WHERE {w} GROUP BY 1, 2)" for r, w in (("zs", "v LIKE 'zs%'"), ("fs", "v LIKE 'fs%'"), ("gold", "true"))]
    + [
        f"""r_{r} AS MATERIALIZED (SELECT rt.head, coalesce(h.type, '') AS head_type, rt.relation, rt.tail, coalesce(x.type, '') AS tail_type FROM rt
  LEFT JOIN k_{r} h ON rt.file_stem = h.file_stem AND rt.head = h.name LEFT JOIN k_{r} x ON rt.file_stem = x.file_stem AND rt.tail = x.name WHERE {w})"""
        for r, w in [(r, f"rt.file_stem IN (SELECT file_stem FROM rt WHERE sourced) AND rt.file_stem IN (SELECT file_stem FROM entities_raw WHERE {_FLAGS} LIKE '{r}%')") for r in RUNS] + [("gold", "sourced")]
    ]
    + [f"n_{r} AS (SELECT head AS name, head_type AS type FROM r_{r} UNION SELECT tail, tail_type FROM r_{r})" for r in (*RUNS, "gold")]
)
_ATTRIBUTES = lambda pred, gold: f""",
w AS (SELECT head, tail, min(head_type) AS a, min(relation) AS b, min(tail_type) AS c FROM {gold} GROUP BY head, tail),
m AS (SELECT DISTINCT {_K5}, a, b, c FROM {pred} JOIN w USING (head, tail)),
l AS (SELECT 'head_type' AS attribute, head_type = a AS ok FROM m UNION ALL SELECT 'relation', relation = b FROM m UNION ALL SELECT 'tail_type', tail_type = c FROM m)
SELECT attribute, count(*) AS total, count(*) FILTER (WHERE ok) AS correct, round(avg(ok::INT::DOUBLE), 6) AS accuracy FROM l GROUP BY attribute"""  # noqa: E731
_TOK = lambda x: rf"list_distinct(list_filter(regexp_extract_all(lower(coalesce({x}, '')), '[\x{{4e00}}-\x{{9fff}}]|[a-z0-9]+'), lambda y: length(y) > 1 OR regexp_matches(y, '[\x{{4e00}}-\x{{9fff}}]')))"

SQL = {
    "strict_eval_entities": _with("zs", "gold") + "\n" + _strict("me_zs", "me_gold", V.ENTITY),
    "strict_eval_triples": _with("zs", "gold") + "\n" + _strict("tt_zs", "tt_gold", V.TRIPLE),
    "relation_level_eval": _with("zs", "gold") + "\n" + _strict("tt_zs", "tt_gold", V.RELATION),
    "evidence_coverage": _with("zs", "gold")
    + f"\nSELECT round(coalesce(avg(CASE WHEN e THEN 1.0::DOUBLE ELSE 0.0 END), 0), 6) AS predicted, round(coalesce(avg(CASE WHEN e THEN 1.0::DOUBLE ELSE 0.0 END) FILTER (WHERE hit), 0), 6) AS \"true\" FROM (SELECT p.*, g.head IS NOT NULL AS hit FROM (SELECT {_K5}, bool_or(len(evidences) > 0) AS e FROM tt_zs GROUP BY ALL) p LEFT JOIN (SELECT DISTINCT {_K5} FROM tt_gold) g USING ({_K5}))",
    "false_positives_topn": _with("zs", "gold") + f"\nSELECT {_K5} FROM (SELECT {_K5} FROM tt_zs EXCEPT SELECT {_K5} FROM tt_gold) ORDER BY {_K5} LIMIT 20",
    "false_negatives_topn": _with("zs", "gold") + f"\nSELECT {_K5} FROM (SELECT {_K5} FROM tt_gold EXCEPT SELECT {_K5} FROM tt_zs) ORDER BY {_K5} LIMIT 20",
    "attribute_accuracy": _with("fs", "gold") + _ATTRIBUTES("tt_fs", "tt_gold"),
    "derived_entities": _with("gold") + "\nSELECT head AS name, head_type AS type FROM tt_gold UNION SELECT tail, tail_type FROM tt_gold",
    "raw_eval": _RAWS + "\n" + "\nUNION ALL ".join(_strict(f"{p}_{r}", f"{p}_gold", k, f"'{r}' AS run, '{s}' AS scope, ") for r in RUNS for s, p, k in (("entity", "n", V.ENTITY), ("triple", "r", V.TRIPLE), ("relation", "r", V.RELATION))),
    "raw_attributes": _RAWS + _ATTRIBUTES("r_zs", "r_gold"),
    "raw_chunks": f"""WITH g AS (SELECT DISTINCT file_stem FROM triples_raw WHERE file_stem IS NOT NULL AND {S.text('source_file')} <> ''),
h AS (SELECT file_stem, bool_or({_FLAGS} LIKE 'zs%') AS zs, bool_or({_FLAGS} LIKE 'fs%') AS fs FROM entities_raw WHERE file_stem IS NOT NULL GROUP BY 1)
SELECT run, count(*) FILTER (WHERE CASE run WHEN 'zs' THEN zs ELSE fs END) AS matched, count(*) FILTER (WHERE NOT coalesce(CASE run WHEN 'zs' THEN zs ELSE fs END, false)) AS missing FROM g LEFT JOIN h USING (file_stem), (VALUES ('zs'), ('fs')) r(run) GROUP BY run""",
    "zs_fs_compare": _with("zs", "fs", "gold")
    + ",\n"
    + ",\n".join(f"c_{r} AS (" + "\nUNION ALL ".join(_strict(f"{p}_{r}", f"{p}_gold", k, f"'{s}' AS scope, ") for s, p, k in (("entity", "me", V.ENTITY), ("triple", "tt", V.TRIPLE), ("relation", "tt", V.RELATION))) + ")" for r in ("zs", "fs"))
    + """,
z AS (UNPIVOT (SELECT scope, precision, recall, f1 FROM c_zs) ON precision, recall, f1 INTO NAME metric VALUE zs),
f AS (UNPIVOT (SELECT scope, precision, recall, f1 FROM c_fs) ON precision, recall, f1 INTO NAME metric VALUE fs)
SELECT scope, metric, zs, fs, round(fs - zs, 6) AS delta FROM z JOIN f USING (scope, metric)""",
    "eval_name_norm": _NORMED + "\n" + _strict("np", "ng", V.TRIPLE),
    "eval_entities_relaxed": f"""{_NORMED},
{_ALIASES},
x AS (SELECT coalesce(n, '') AS name, type FROM me_zs LEFT JOIN nf ON s = name), y AS (SELECT coalesce(n, '') AS name, type FROM me_gold LEFT JOIN nf ON s = name),
z AS (SELECT alias AS name, type FROM ip), v AS (SELECT alias AS name, type FROM ig)
{_strict("x", "y", V.ENTITY, "'name_norm' AS tier, ")} UNION ALL {_strict("z", "v", V.ENTITY, "'alias' AS tier, ")}""",
    "eval_substring": _NORMED + _tier(V.TRIPLE, S.overlap("g.head", "p.head") + " AND " + S.overlap("g.tail", "p.tail"), "head <> '' AND tail <> ''"),
    "eval_head_relation": _NORMED + _tier(["head", "head_type", "relation", "tail_type"], S.overlap("g.head", "p.head")),
    "eval_alias": _NORMED + ",\n" + _ALIASES + ",\ncanon AS MATERIALIZED (SELECT alias, type, min(name) AS canon FROM ig GROUP BY alias, type),\n" + _HELD("ip") + ",\n" + _HELD("ig") + ",\n" + _KEYED("kp", "tt_zs", "ip") + ",\n" + _KEYED("kg", "tt_gold", "ig") + "\n" + _strict("kp", "kg", V.TRIPLE),
    "candidate_tiers": f"""WITH {S.E},\n{S.ME},
{_compatible()},
gs AS (SELECT DISTINCT name AS gold_name, type AS gold_type FROM (SELECT name_zh AS name, type FROM canonical_entities UNION ALL SELECT name_en, type FROM canonical_entities UNION ALL SELECT abbr, type FROM canonical_entities) WHERE trim(name) <> '' AND trim(type) <> ''),
{_forms("nf", "SELECT gold_name AS s FROM gs UNION SELECT name FROM me UNION SELECT description FROM me UNION SELECT name || ' ' || description FROM me")},
g AS MATERIALIZED (SELECT gold_name, gold_type, coalesce(n, '') AS gn, {_TOK('k')} AS gt FROM gs LEFT JOIN nf ON s = gold_name),
p AS MATERIALIZED (SELECT name, type, pos, coalesce(a.n, '') AS pn, coalesce(b.n, '') AS pd, {_TOK('c.k')} AS pt FROM me LEFT JOIN nf a ON a.s = name LEFT JOIN nf b ON b.s = description LEFT JOIN nf c ON c.s = name || ' ' || description),
a AS MATERIALIZED (SELECT gold_name, gold_type, 1 AS tier, name, pos, 1.0::DOUBLE AS score FROM g JOIN p ON gn = pn AND gn <> '' AND gold_type = type),
b AS MATERIALIZED (SELECT gold_name, gold_type, 2 AS tier, name, pos, 1.0::DOUBLE AS score FROM g JOIN p ON gold_type = type AND gn <> '' AND (contains(pn, gn) OR contains(gn, pn) OR contains(pd, gn)) WHERE (gold_name, gold_type) NOT IN (SELECT (gold_name, gold_type) FROM a)),
c AS (SELECT gold_name, gold_type, 3 AS tier, name, pos, len(list_intersect(gt, pt))::DOUBLE / len(list_distinct(gt || pt)) AS score FROM g JOIN p ON gold_type = type AND len(list_intersect(gt, pt)) > 0
  WHERE (gold_name, gold_type) NOT IN (SELECT (gold_name, gold_type) FROM a) AND (gold_name, gold_type) NOT IN (SELECT (gold_name, gold_type) FROM b)),
r AS (SELECT *, row_number() OVER (PARTITION BY gold_name, gold_type ORDER BY score DESC, pos) AS rank FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c))
SELECT gold_name, gold_type, ['exact_norm', 'substring', 'token_overlap'][tier] AS tier, name, rank FROM r WHERE rank <= 10""",
    "judge_recall": _with("fs", "gold")
    + f""",
eg AS MATERIALIZED (SELECT name, type, {S.compact('name')} AS k FROM (SELECT head AS name, head_type AS type FROM tt_gold UNION SELECT tail, tail_type FROM tt_gold)),
ep AS MATERIALIZED (SELECT name, {S.compact('name')} AS k FROM (SELECT head AS name FROM tt_fs UNION SELECT tail FROM tt_fs)),
al AS MATERIALIZED (SELECT eg.name AS gold_name, eg.type AS gold_type, ep.name AS pred_name FROM eg JOIN ep USING (k)),
l AS (SELECT DISTINCT head, relation, tail FROM tt_fs),
m AS (SELECT g.head, g.head_type, g.relation, g.tail, g.tail_type, bool_or(l.relation = g.relation) AS exact, bool_or((l.relation < 'b') = (g.relation < 'b')) AS judge
  FROM tt_gold g JOIN al h ON g.head = h.gold_name AND g.head_type = h.gold_type JOIN al x ON g.tail = x.gold_name AND g.tail_type = x.gold_type JOIN l ON l.head = h.pred_name AND l.tail = x.pred_name GROUP BY ALL)
SELECT CASE WHEN exact THEN 'exact_relation' WHEN judge THEN 'relation_judge' ELSE 'missed' END AS match_kind, count(*) AS n FROM tt_gold LEFT JOIN m USING ({_K5}) GROUP BY 1""",
}
