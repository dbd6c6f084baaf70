"""The queries of this subpackage and the SQL that some of them can be checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import abuse, canonical, components, disguise, leakage, markup, neighbors, packing, scans, survivorship


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return neighbors.similar_pairs(table(spark, sf, "entity_vectors"), k=10, rounds=3).select("node_a", "node_b")


def p1_search(spark: SparkSession, sf: str) -> DataFrame:
    """The five most similar nodes of every node whose id is divisible by 50, by greedy search on the graph of all."""
    nodes = table(spark, sf, "entity_vectors")
    return neighbors.search(neighbors.Collection(nodes), nodes.where("node_id % 50 = 0"))


#: How these courses write names: words that carry no meaning, and that a name without its kind stands for a protocol.
COURSES = canonical.Usage(
    fillers=frozenset("a an the of for in called scheme method approach technique algorithm mechanism".split()),
    before=("所谓", "所谓的", "一种", "该"), after=("等", "技术", "方案", "方式", "方法", "算法", "机制", "见下文", "见上文", "如下", "策略"), inside="的式", last_word="protocol",
)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return canonical.to_canonical(table(spark, sf, "entities_raw"), table(spark, sf, "canonical_entities"), usage=COURSES).select("entity_id", "canon_id")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return survivorship.best_rows(table(spark, sf, "entities_raw"))


def p3_currency(spark: SparkSession, sf: str) -> DataFrame:
    """As p3_found, but rows without a timestamp are ordered by learned currency instead of as the oldest."""
    return survivorship.best_rows(table(spark, sf, "entities_raw"), nulls="currency")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    names = disguise.disguised_values(table(spark, sf, "entities_raw"), "entities_raw", "entity_id", ["name"])
    ends = disguise.disguised_values(table(spark, sf, "triples_raw"), "triples_raw", "triple_id", ["head", "tail"])
    return names.union(ends).select("src", "row_id", "field")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return scans.noise_lines(table(spark, sf, "ocr_pages"), table(spark, sf, "chunks"))


def p5_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return scans.repaired(table(spark, sf, "ocr_pages"), table(spark, sf, "chunks"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return components.connected_groups(components.merge_pairs(table(spark, sf, "merge_decisions")))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    chunks = markup.markup_kinds(table(spark, sf, "chunks"), "chunks", "chunk_id", "content")
    return chunks.union(markup.markup_kinds(table(spark, sf, "triples_raw"), "triples_raw", "triple_id", "evidence"))


def p7_clean(spark: SparkSession, sf: str) -> DataFrame:
    chunks = markup.without_markup(table(spark, sf, "chunks"), "chunks", "chunk_id", "content")
    return chunks.union(markup.without_markup(table(spark, sf, "triples_raw"), "triples_raw", "triple_id", "evidence"))


def p8_packed(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items")).select("doc_id", "item_id")


def p9_leaked_items(spark: SparkSession, sf: str) -> DataFrame:
    """Of each leaked item how many documents hold part of it, and the most of it that one document holds."""
    found = leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))
    return found.groupBy("item_id").agg(F.count("*").alias("documents"), F.max("coverage").alias("most_covered"), F.max("longest").alias("longest"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return abuse.found(table(spark, sf, "documents"), table(spark, sf, "doc_labels"))


def p10_source_rates(spark: SparkSession, sf: str) -> DataFrame:
    return abuse.source_rates(table(spark, sf, "documents"), table(spark, sf, "doc_labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_search": p1_search,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_currency": p3_currency,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p5_repaired": p5_repaired,
    "p6_found": p6_found,
    "p7_found": p7_found,
    "p7_clean": p7_clean,
    "p8_packed": p8_packed,
    "p9_found": p9_found,
    "p9_leaked_items": p9_leaked_items,
    "p10_found": p10_found,
    "p10_source_rates": p10_source_rates,
}

SQL: dict[str, str] = {
    "p3_found": r"""
WITH r AS (
  SELECT mention_key AS k, entity_id AS id, name, canonical_name AS canon, frequency, description AS d,
    CASE regexp_replace(lower(extractor_version), '[^a-z]', '', 'g')
      WHEN 'fsrecheck' THEN 0 WHEN 'zsrecheck' THEN 1 WHEN 'fsnocheck' THEN 2 WHEN 'zsnocheck' THEN 3 ELSE 4 END AS trust,
    coalesce(-epoch_us(extracted_at), 9223372036854775807) AS age
  FROM entities_raw WHERE mention_key IS NOT NULL),
u AS (
  SELECT *, coalesce(regexp_matches(trim(d, ' ' || chr(12288)), '[.。!！?？]$') AND NOT regexp_matches(d, '(\.\s*\.|…)\s*$')
      AND regexp_matches(d, '\pL.*\pL') AND lower(trim(d)) NOT IN ('n/a', 'null', 'none', 'unknown', 'tbd', 'see above', '(no description)'), false) AS okd,
    coalesce(frequency >= 1, false) AS okf,
    coalesce(length(trim(canon, ' ' || chr(12288))) > 0
      AND EXISTS (SELECT 1 FROM entities_raw e WHERE e.mention_key = r.k AND e.name = r.canon), false) AS okc
  FROM r)
SELECT k AS mention_key,
  coalesce(arg_min(id, (trust, age, id)) FILTER (WHERE okd), 0)::BIGINT AS descr_from,
  coalesce(arg_min(id, (trust, age, id)) FILTER (WHERE okf), 0)::BIGINT AS freq_from,
  coalesce(arg_min(id, (trust, age, id)) FILTER (WHERE okc), 0)::BIGINT AS canon_from
FROM u GROUP BY k HAVING count(*) >= 2""",
    "p6_found": r"""
WITH RECURSIVE e AS (
  SELECT DISTINCT left_id AS a, right_id AS b FROM merge_decisions
  WHERE regexp_replace(lower(decision), '[\s_]+', '', 'g') = 'merge' AND left_id <> right_id),
bi AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(node_id, other) AS (
  SELECT a, a FROM bi UNION SELECT r.node_id, x.b FROM reach r JOIN bi x ON r.other = x.a)
SELECT node_id, min(other) AS group_id FROM reach GROUP BY node_id""",
}
