"""Views of the merged graph: top nodes, induced subgraph, neighbourhoods, degrees, figures for drawing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schema import EDGE_LABELS, NODE_LABELS


def limit_of(value: str | None, default: int | None) -> int | None:
    """A limit from a setting: not given or no number is the default, zero and below is no limit (None)."""
    try:
        n = int(value) if value else None
    except ValueError:
        n = None
    return default if n is None else n if n > 0 else None


def _labels(column: str, table: dict[str, str]):
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.col(column))


def nodes_of(entities: DataFrame) -> DataFrame:
    """Nodes with the label of their type; unknown types are left out."""
    return entities.select(_labels("type", NODE_LABELS).alias("label"), "name", "description", "frequency").where("label is not null")


def links_of(triples: DataFrame) -> DataFrame:
    """Edges with their label; unknown relations are left out. Evidences are JSON text."""
    return triples.select(F.col("head").alias("source"), F.col("tail").alias("target"), _labels("relation", EDGE_LABELS).alias("type"), "frequency", F.to_json("evidences").alias("evidences")).where("type is not null")


def top_nodes(nodes: DataFrame, limit: int | None = 1000) -> DataFrame:
    ranked = nodes.orderBy(F.desc("frequency"), "name", "label")
    return ranked.limit(limit) if limit is not None else ranked


def induced_links(links: DataFrame, nodes: DataFrame, limit: int | None = 4000) -> DataFrame:
    """The most frequent edges with both ends among the nodes."""
    n = nodes.select("name").distinct()
    inside = links.join(n.withColumnRenamed("name", "source"), "source", "left_semi").join(n.withColumnRenamed("name", "target"), "target", "left_semi")
    ranked = inside.orderBy(F.desc("frequency"), "source", "type", "target")
    return ranked.limit(limit) if limit is not None else ranked


def view_meta(nodes: DataFrame, links: DataFrame, shown_nodes: DataFrame, shown_links: DataFrame) -> DataFrame:
    """One row of totals, what is shown, the largest frequencies, and whether anything was left out."""
    n, l = nodes.agg(F.count("*").alias("nodes_total")), links.agg(F.count("*").alias("links_total"))
    sn = shown_nodes.agg(F.count("*").alias("nodes_returned"), F.max("frequency").alias("max_node_frequency"))
    sl = shown_links.agg(F.count("*").alias("links_returned"), F.max("frequency").alias("max_link_frequency"))
    one = n.crossJoin(l).crossJoin(sn).crossJoin(sl)  # one row each
    return one.withColumn("links_dropped", F.col("links_total") - F.col("links_returned")).withColumn("truncated", (F.col("nodes_returned") < F.col("nodes_total")) | (F.col("links_returned") < F.col("links_total")))


def visible(nodes: DataFrame, links: DataFrame, hidden_labels: list[str], hidden_types: list[str]) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of shown kinds; an edge needs both of its ends."""
    n = nodes.where(~F.col("label").isin(hidden_labels)) if hidden_labels else nodes
    l = links.where(~F.col("type").isin(hidden_types)) if hidden_types else links
    names = n.select("name").distinct()
    return n, l.join(names.withColumnRenamed("name", "source"), "source", "left_semi").join(names.withColumnRenamed("name", "target"), "target", "left_semi")


def neighbors(links: DataFrame) -> DataFrame:
    """``name, neighbor``: both directions, each pair once."""
    return links.select(F.col("source").alias("name"), F.col("target").alias("neighbor")).union(links.select("target", "source")).distinct()


def out_degree(links: DataFrame, top: int = 10) -> DataFrame:
    return links.groupBy("source").agg(F.count("*").alias("degree")).orderBy(F.desc("degree"), "source").limit(top)


def degree_summary(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """One row: nodes, those with an edge, mean degree over those, mean frequency."""
    ends = links.select(F.explode(F.array("source", "target")).alias("name")).groupBy("name").agg(F.count("*").alias("d"))
    m = nodes.select("name", "frequency").join(ends, "name", "left")
    return m.agg(F.count("*").alias("nodes"), F.count("d").alias("connected"), F.round(F.avg("d"), 6).alias("mean_degree"), F.round(F.avg("frequency"), 6).alias("mean_frequency"))


def cumulative_share(nodes: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent nodes with their running share of all mentions."""
    best = nodes.orderBy(F.desc("frequency"), "name").limit(top)
    w = W.orderBy(F.desc("frequency"), "name").rowsBetween(W.unboundedPreceding, 0)
    run = best.withColumn("s", F.sum("frequency").over(w))
    return run.crossJoin(nodes.agg(F.sum("frequency").alias("all"))).select("name", "frequency", F.round(F.col("s") / F.col("all"), 6).alias("share"))


def parallel_edges(links: DataFrame) -> DataFrame:
    """Edges with their place among those between the same two nodes, and the curvature to draw them with."""
    w = W.partitionBy(F.least("source", "target"), F.greatest("source", "target")).orderBy("source", "target", "type")
    out = links.select("source", "type", "target", (F.row_number().over(w) - 1).cast("bigint").alias("place"))
    curves = F.array(*[F.lit(x) for x in CURVES])
    return out.withColumn("curvature", F.coalesce(F.try_element_at(curves, (F.col("place") + 1).cast("int")), F.lit(0.6)))


#: Curvature of the first parallel edges; 0.6 beyond.
CURVES = (0.0, 0.3, -0.3, 0.5, -0.5)


def drawing(nodes: DataFrame) -> DataFrame:
    """Radius of each node and the share of its bar."""
    top = nodes.agg(F.max("frequency").alias("m"))
    f, m = F.col("frequency").cast("double"), F.col("m").cast("double")
    return nodes.crossJoin(top).select("name", "label", F.round(2.5 + 8.5 * F.log(f + 1) / F.log(m + 1), 6).alias("radius"), F.round(100 * f / m, 6).alias("bar"))


def link_widths(links: DataFrame) -> DataFrame:
    """Width to draw each edge with, by its share of the largest frequency; a missing frequency counts as 1."""
    top = links.agg(F.max("frequency").alias("m"))
    width = 0.6 + 3.4 * F.coalesce("frequency", F.lit(1)).cast("double") / F.col("m").cast("double")
    return links.crossJoin(top).select("source", "type", "target", F.round(width, 6).alias("width"))  # one row


def graph_counts(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """One row: nodes and relationships."""
    return nodes.agg(F.count("*").alias("nodes")).crossJoin(links.agg(F.count("*").alias("relationships")))
