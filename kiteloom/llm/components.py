"""Consolidating pairwise matches into groups: connected components by low-diameter decomposition.

Every vertex draws an exponential shift; a vertex joins the cluster of the source that minimises distance minus shift,
so clusters grow as if from shifted start times. A level grows them for a few rounds, contracts each cluster to one
super-vertex, drops edges inside clusters and repeated ones, and recurses on the edges that are left; the assignments
of the levels are composed at the end. A label only ever travels along edges, so however few rounds are run, a cluster
stays inside one component and no link is lost. Rounds are joins on the vertex and map-side combined minima, so a hub
with a third of all edges is a skewed join key that adaptive execution splits, never one group held by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch


def connected_groups(
    pairs: DataFrame, left: str = "left_id", right: str = "right_id", beta: float = 0.3, rounds: int = 3, seed: int = 11
) -> DataFrame:
    """``node_id BIGINT, group_id BIGINT``: every vertex of a pair with the smallest vertex linked to it.

    Null ends and self pairs link nothing and add no vertex; repeated and swapped pairs count once; an empty input gives
    an empty result; other columns are ignored. beta is the rate of the exponential shifts, rounds the growth steps of a
    level.
    """
    spark: SparkSession = pairs.sparkSession
    scratch = Scratch(spark, "components")
    a, b = F.col(left).cast("bigint"), F.col(right).cast("bigint")
    edges = scratch.cut(
        pairs.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
        .where(a.isNotNull() & b.isNotNull() & (a != b))
        .distinct()
    )
    levels: list[DataFrame] = []
    level = 0
    while not edges.isEmpty():
        member = scratch.cut(_grow(edges, beta, rounds, seed + level))
        levels.append(member)
        lu = member.select(F.col("node").alias("u"), F.col("label").alias("lu"))
        lv = member.select(F.col("node").alias("v"), F.col("label").alias("lv"))
        contracted = scratch.cut(
            edges.join(lu, "u")
            .join(lv, "v")
            .where("lu != lv")
            .select(F.least("lu", "lv").alias("u"), F.greatest("lu", "lv").alias("v"))
            .distinct()
        )
        scratch.drop(edges)
        edges, level = contracted, level + 1
    if not levels:
        return spark.createDataFrame([], "node_id bigint, group_id bigint")
    above = levels[-1]
    for member in reversed(levels[:-1]):
        up = above.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        above = member.join(up, "label", "left").select("node", F.coalesce("higher", "label").alias("label"))
    above = scratch.cut(above)
    smallest = above.groupBy("label").agg(F.min("node").alias("group_id"))
    return above.join(smallest, "label").select(F.col("node").alias("node_id"), "group_id")


def _grow(edges: DataFrame, beta: float, rounds: int, seed: int) -> DataFrame:
    """``node, label``: clusters after some rounds of growth from exponentially shifted starts."""
    both = edges.select(F.col("u").alias("src"), F.col("v").alias("dst")).union(
        edges.select(F.col("v").alias("src"), F.col("u").alias("dst"))
    )
    ends = both.select(F.col("src").alias("dst")).distinct().select(F.col("dst").alias("src"), "dst")
    reach = both.withColumn("w", F.lit(1.0)).union(ends.withColumn("w", F.lit(0.0)))
    unit = (F.pmod(F.xxhash64("src", F.lit(seed)), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    start = F.log(unit) / beta  # minus an exponential shift
    state = reach.groupBy("dst").agg(F.min(F.struct((start + F.col("w")).alias("key"), F.col("src").alias("label"))).alias("best"))
    for _ in range(rounds - 1):
        now = state.select(F.col("dst").alias("src"), "best.key", "best.label")
        state = (
            reach.join(now, "src")
            .groupBy("dst")
            .agg(F.min(F.struct((F.col("key") + F.col("w")).alias("key"), F.col("label").alias("label"))).alias("best"))
        )
    return state.select(F.col("dst").alias("node"), F.col("best.label").alias("label"))


def merge_pairs(decisions: DataFrame) -> DataFrame:
    """Pairs that a merge decision links, whatever the case and spacing of the word."""
    word = F.lower(F.regexp_replace("decision", r"(?U)[\s_]+", ""))
    return decisions.where(word == "merge").select("left_id", "right_id")
