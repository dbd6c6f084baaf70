"""Queries on validity, normalisation and merging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import compact_name, normalize_name, strip
from ..operators import merge as M
from ..session import table
from . import sqlparts as S


def entities_of(spark: SparkSession, sf: str) -> DataFrame:
    return M.valid_entities(table(spark, sf, "entities_raw"))


def triples_of(spark: SparkSession, sf: str) -> DataFrame:
    return M.valid_triples(table(spark, sf, "triples_raw"))


def graph_of(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return M.merge_graph(table(spark, sf, "entities_raw"), table(spark, sf, "triples_raw"))


def valid_entities(spark, sf):
    return entities_of(spark, sf).drop("at")


def valid_triples(spark, sf):
    return triples_of(spark, sf).select("triple_id", "head", "relation", "tail", "evidence")


def normalize_names(spark, sf):
    e = table(spark, sf, "entities_raw").where("name is not null")
    return e.select("entity_id", normalize_name(F.col("name")).alias("once"), normalize_name(normalize_name(F.col("name"))).alias("twice"))


def compact_names(spark, sf):
    return table(spark, sf, "entities_raw").where("name is not null").select("entity_id", compact_name(F.col("name")).alias("compact"))


def merge_entities(spark, sf):
    return M.merge_entities(entities_of(spark, sf)).drop("at")


def merge_triples(spark, sf):
    _, t = graph_of(spark, sf)
    return t.select("head", "head_type", "relation", "tail", "tail_type", "frequency", F.to_json("evidences").alias("evidences"))


def graph_stats(spark, sf):
    return M.graph_stats(*graph_of(spark, sf))


def type_conflicts(spark, sf):
    return M.type_conflicts(entities_of(spark, sf))


def embedding_rows(spark, sf):
    return M.embedding_rows(entities_of(spark, sf))


def _loose(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Mentions and triples as context sees them, also where they aren't valid."""
    return M.mentions(table(spark, sf, "entities_raw")), M.stated(table(spark, sf, "triples_raw"))


def entity_context(spark, sf):
    c = M.entity_context(*_loose(spark, sf))
    ids = F.array_join(F.transform("triples", lambda x: x["id"]), " ")
    return c.select("name", "type", "frequency", "total_descriptions", "total_triples", F.array_join("descriptions", " | ").alias("descriptions"), ids.alias("triples"))


def relation_summary(spark, sf):
    return M.relation_summary(_loose(spark, sf)[1])


def context_round_robin(spark, sf):
    return M.context_round_robin(_loose(spark, sf)[1]).select("name", "relation", "id", "position")


def canonical_apply(spark, sf):
    """The mapping is the canonical names that an earlier run wrote beside the names."""
    raw = table(spark, sf, "entities_raw").where("name is not null and canonical_name is not null and trim(canonical_name) != ''")
    mapping = raw.groupBy(strip(F.col("name")).alias("name")).agg(F.min(strip(F.col("canonical_name"))).alias("canonical"))
    return M.apply_canonical(triples_of(spark, sf), mapping).select("triple_id", "head", "relation", "tail")


QUERIES = {f.__name__: f for f in (valid_entities, valid_triples, normalize_names, compact_names, merge_entities, merge_triples, graph_stats, type_conflicts, embedding_rows, entity_context, relation_summary, context_round_robin, canonical_apply)}

SIDES = f"""o AS MATERIALIZED (SELECT id, head, relation, tail, evidence, source_file, chunk_index, evidence_id, min(pos) AS pos FROM (
  SELECT coalesce(file_stem, '') || ':' || coalesce(evidence_id, '') AS id, evidence_id, {S.at('triple_id')} AS pos, coalesce({S.normalize('head')}, '') AS head, {S.text('relation')} AS relation, coalesce({S.normalize('tail')}, '') AS tail,
    {S.text('evidence')} AS evidence, {S.text('source_file')} AS source_file, {S.text('chunk_index')} AS chunk_index FROM triples_raw) GROUP BY ALL),
n AS MATERIALIZED (SELECT head AS name, * FROM o WHERE head <> '' UNION ALL SELECT tail AS name, * FROM o WHERE tail <> '' AND tail <> head),
nt AS MATERIALIZED (SELECT name, count(*) AS total FROM n GROUP BY name),
nr AS (SELECT n.*, total, row_number() OVER (PARTITION BY n.name, relation ORDER BY pos, id) AS turn FROM n JOIN nt USING (name)),
np AS MATERIALIZED (SELECT * FROM (SELECT name, relation, id, row_number() OVER (PARTITION BY name ORDER BY CASE WHEN total <= 8 THEN 0 ELSE turn END, CASE WHEN total <= 8 THEN '' ELSE relation END, pos, id) AS position FROM nr) WHERE position <= 8),
ms AS MATERIALIZED (SELECT * FROM (SELECT {S.normalize('name')} AS name, lower({S.text('type')}) AS type, {S.text('description')} AS description, {S.at('entity_id')} AS pos FROM entities_raw) WHERE name <> ''),
md AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY name ORDER BY pos, description) AS r FROM (SELECT name, description, min(pos) AS pos FROM ms WHERE description <> '' GROUP BY 1, 2)),
mt_ AS MATERIALIZED (SELECT name, count(*) AS total FROM md GROUP BY name)"""

SQL = {
    "valid_entities": f"WITH {S.E} SELECT entity_id, name, type, description, frequency FROM e",
    "valid_triples": f"WITH {S.T} SELECT triple_id, head, relation, tail, evidence FROM t",
    "normalize_names": f"WITH o AS MATERIALIZED (SELECT entity_id, {S.normalize('name')} AS once FROM entities_raw WHERE name IS NOT NULL) SELECT entity_id, once, {S.normalize('once')} AS twice FROM o",
    "compact_names": f"SELECT entity_id, {S.compact('name')} AS compact FROM entities_raw WHERE name IS NOT NULL",
    "merge_entities": f"WITH {S.E}, {S.ME} SELECT name, type, description, frequency FROM me",
    "merge_triples": S.GRAPH + "SELECT head, head_type, relation, tail, tail_type, frequency, to_json(evidences)::VARCHAR AS evidences FROM tt",
    "graph_stats": S.GRAPH
    + """SELECT CASE WHEN grouping(type) = 1 THEN 'total_entities' ELSE 'entities_by_type' END AS stat, coalesce(type, '') AS key, count(*) AS n FROM me GROUP BY GROUPING SETS ((), (type))
UNION ALL SELECT CASE WHEN grouping(relation) = 1 THEN 'total_triples' ELSE 'triples_by_relation' END, coalesce(relation, ''), count(*) FROM tt GROUP BY GROUPING SETS ((), (relation))""",
    "type_conflicts": f"""WITH {S.E}, b AS (SELECT {S.normalize('name')} AS name, type, sum(frequency)::BIGINT AS f FROM e GROUP BY 1, 2)
SELECT name, string_agg(type || '=' || f, '; ' ORDER BY type) AS types FROM b GROUP BY name HAVING count(*) > 1""",
    "embedding_rows": f"""WITH {S.E}, o AS (SELECT name, type, sum(frequency)::BIGINT AS frequency, coalesce(arg_min(description, pos) FILTER (WHERE description <> ''), '') AS description FROM e GROUP BY name, type)
SELECT name, type, frequency, description, '实体类型：' || type || '；实体名：' || name || CASE WHEN description <> '' THEN '；定义：' || substr(description, 1, 160) ELSE '' END AS encoded FROM o""",
    "entity_context": f"""WITH {SIDES},
w AS (SELECT name, count(*) AS frequency, arg_min(type, pos) FILTER (WHERE type <> '') AS type FROM ms GROUP BY name),
d AS (SELECT name, string_agg(description, ' | ' ORDER BY r) AS texts FROM md WHERE r <= 3 GROUP BY name),
x AS (SELECT name, string_agg(id, ' ' ORDER BY position) AS ids FROM np GROUP BY name)
SELECT coalesce(w.name, nt.name) AS name, coalesce(type, '') AS type, coalesce(frequency, 0) AS frequency, coalesce(mt_.total, 0) AS total_descriptions, coalesce(nt.total, 0) AS total_triples, coalesce(texts, '') AS descriptions, coalesce(ids, '') AS triples
FROM w FULL JOIN nt ON w.name = nt.name LEFT JOIN d ON d.name = coalesce(w.name, nt.name) LEFT JOIN x ON x.name = coalesce(w.name, nt.name) LEFT JOIN mt_ ON mt_.name = coalesce(w.name, nt.name)""",
    "relation_summary": f"WITH {SIDES} SELECT name, relation, count(*) AS n FROM n GROUP BY name, relation",
    "context_round_robin": f"WITH {SIDES} SELECT name, relation, id, position FROM np",
    "canonical_apply": f"""WITH {S.T},
m AS (SELECT {S.strip('name')} AS name, min({S.strip('canonical_name')}) AS canonical FROM entities_raw WHERE name IS NOT NULL AND canonical_name IS NOT NULL AND trim(canonical_name) <> '' GROUP BY 1)
SELECT triple_id, coalesce(h.canonical, head) AS head, relation, coalesce(x.canonical, tail) AS tail FROM t LEFT JOIN m h ON t.head = h.name LEFT JOIN m x ON t.tail = x.name
WHERE coalesce(h.canonical, head) <> coalesce(x.canonical, tail)""",
}
