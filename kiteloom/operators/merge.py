"""Raw entities and triples to one merged graph: validity, normalisation, aggregation, context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import encode_row, normalize_name, strip, text_or_empty
from ..schema import ENTITY_TYPES, RELATION_TYPES


def order_of(row_id: str) -> Column:
    """Scan order: file, position in the file, row."""
    return F.struct(F.coalesce("file_stem", F.lit("")).alias("f"), F.coalesce("ord", F.lit(0)).alias("o"), F.col(row_id).alias("i"))


def valid_entities(raw: DataFrame, *keep: str) -> DataFrame:
    """Stripped and typed entities of a known type that aren't blank; the name as it is given, edges included, has 2 to 30
    characters. Missing or unusable frequencies are 1. ``keep``: other columns to carry along."""
    e = raw.where(F.length("name").between(2, 30)).select(
        "entity_id", order_of("entity_id").alias("at"), strip(F.col("name")).alias("name"), F.lower(strip(F.col("type"))).alias("type"),
        text_or_empty(F.col("description")).alias("description"), F.greatest(F.coalesce("frequency", F.lit(1)), F.lit(1)).alias("frequency"), *keep,
    )
    return e.where(F.col("type").isin(*ENTITY_TYPES) & (F.col("name") != ""))


def valid_triples(raw: DataFrame) -> DataFrame:
    """Stripped triples of a known relation whose ends are given and differ."""
    t = raw.select(
        "triple_id", order_of("triple_id").alias("at"), "source_file", "chunk_index", "evidence_id", strip(F.col("head")).alias("head"),
        F.lower(strip(F.col("relation"))).alias("relation"), strip(F.col("tail")).alias("tail"), text_or_empty(F.col("evidence")).alias("evidence"),
    )
    return t.where(F.col("relation").isin(*RELATION_TYPES) & (F.col("head") != "") & (F.col("tail") != "") & (F.col("head") != F.col("tail")))


def merge_entities(entities: DataFrame) -> DataFrame:
    """One row a normalised name: type of the first mention, summed frequency, first description that isn't empty."""
    n = entities.withColumn("name", normalize_name(F.col("name"))).where(F.length("name") >= 2)
    return n.groupBy("name").agg(
        F.min_by("type", "at").alias("type"),
        F.coalesce(F.min_by("description", F.when(F.col("description") != "", F.col("at"))), F.lit("")).alias("description"),
        F.sum("frequency").alias("frequency"),
        F.min("at").alias("at"),
    )


def known_triples(triples: DataFrame, entities: DataFrame) -> DataFrame:
    """Triples with normalised ends that differ and are names of merged entities."""
    t = triples.withColumn("head", normalize_name(F.col("head"))).withColumn("tail", normalize_name(F.col("tail"))).where("head != tail")
    names = entities.select("name")
    return t.join(names.withColumnRenamed("name", "head"), "head", "left_semi").join(names.withColumnRenamed("name", "tail"), "tail", "left_semi")


def merge_triples(triples: DataFrame, entities: DataFrame) -> DataFrame:
    """One row a (head, relation, tail): frequency, and the distinct evidences in order of first appearance.

    Equal evidences are merged before they are listed, so a list is as long as there are different ones.
    """
    t = known_triples(triples, entities)
    one = t.groupBy("head", "relation", "tail", "evidence").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    said = F.sort_array(F.collect_list(F.when(F.col("evidence") != "", F.struct("at", "evidence"))))
    return one.groupBy("head", "relation", "tail").agg(
        F.sum("n").alias("frequency"), F.transform(said, lambda x: x["evidence"]).alias("evidences"), F.min("at").alias("at")
    )


def typed_triples(merged: DataFrame, entities: DataFrame) -> DataFrame:
    """Merged triples with the types of their ends; missing types are empty."""
    kinds = entities.select("name", "type")
    h, t = kinds.select(F.col("name").alias("head"), F.col("type").alias("head_type")), kinds.select(F.col("name").alias("tail"), F.col("type").alias("tail_type"))
    return merged.join(h, "head", "left").join(t, "tail", "left").withColumns({c: F.coalesce(c, F.lit("")) for c in ("head_type", "tail_type")})


def graph_stats(entities: DataFrame, triples: DataFrame) -> DataFrame:
    """Totals and counts by type and by relation, each table read once; empty tables have no rows."""
    e = entities.groupingSets([[], ["type"]], "type").agg(F.count("*").alias("n"), F.grouping("type").alias("g"))
    t = triples.groupingSets([[], ["relation"]], "relation").agg(F.count("*").alias("n"), F.grouping("relation").alias("g"))
    said = lambda df, key, total, by: df.select(F.when(F.col("g") == 1, F.lit(total)).otherwise(F.lit(by)).alias("stat"), F.when(F.col("g") == 1, F.lit("")).otherwise(F.col(key)).alias("key"), "n")
    return said(e, "type", "total_entities", "entities_by_type").union(said(t, "relation", "total_triples", "triples_by_relation"))


def type_conflicts(entities: DataFrame) -> DataFrame:
    """Names with several types: each type with its frequency, sorted by type."""
    n = entities.withColumn("name", normalize_name(F.col("name")))
    by = n.groupBy("name", "type").agg(F.sum("frequency").alias("f"))
    many = by.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("type", "f"))).alias("types"))
    said = F.concat_ws("; ", F.transform("types", lambda x: F.concat_ws("=", x["type"], x["f"].cast("string"))))
    return many.where(F.size("types") > 1).select("name", said.alias("types"))


def embedding_rows(entities: DataFrame, max_description: int = 160) -> DataFrame:
    """Rows to embed: one a (name, type) with summed frequency, the first description that isn't blank, and the text."""
    one = entities.groupBy("name", "type").agg(
        F.sum("frequency").alias("frequency"),
        F.coalesce(F.min_by("description", F.when(strip(F.col("description")) != "", F.col("at"))), F.lit("")).alias("description"),
    )
    return one.withColumn("encoded", encode_row(F.col("name"), F.col("type"), F.col("description"), max_description))


def mentions(raw: DataFrame) -> DataFrame:
    """Mentions as context sees them, also where they aren't valid: normalised name, type, description."""
    e = raw.select(normalize_name(F.col("name")).alias("name"), F.lower(text_or_empty(F.col("type"))).alias("type"), text_or_empty(F.col("description")).alias("description"), order_of("entity_id").alias("at"))
    return e.where("name != ''")


def stated(raw: DataFrame) -> DataFrame:
    """Triples as context sees them, also where they aren't valid: normalised ends, what else is given, and an id."""
    said = {c: text_or_empty(F.col(c)) for c in ("relation", "evidence", "source_file", "chunk_index")}
    ident = F.concat_ws(":", F.coalesce("file_stem", F.lit("")), F.coalesce("evidence_id", F.lit("")))
    return raw.select(ident.alias("id"), F.coalesce(normalize_name(F.col("head")), F.lit("")).alias("head"), F.coalesce(normalize_name(F.col("tail")), F.lit("")).alias("tail"), *[c.alias(n) for n, c in said.items()], order_of("triple_id").alias("at"))


def _sides(triples: DataFrame) -> DataFrame:
    """Each different triple once for each of its ends that has a name."""
    one = triples.groupBy("id", "head", "relation", "tail", "evidence", "source_file", "chunk_index").agg(F.min("at").alias("at"))
    return one.withColumn("name", F.explode(F.array_distinct(F.array("head", "tail")))).where("name != ''")


def relation_summary(triples: DataFrame) -> DataFrame:
    """Different triples of each name by relation."""
    return _sides(triples).groupBy("name", "relation").agg(F.count("*").alias("n"))


def context_round_robin(triples: DataFrame, limit: int = 8) -> DataFrame:
    """The triples shown of each name, and ``position`` from 1: all of them in order if they are no more than the limit, else one
    of every relation in turn, relations in order of their names. A limit of zero or less shows all.

    Ranks are cut at the limit within (name, relation) before a name's triples meet, so a name's rows are never all sorted together.
    """
    sides = _sides(triples)
    turn = sides.withColumn("turn", F.row_number().over(W.partitionBy("name", "relation").orderBy("at", "id")))
    totals = sides.groupBy("name").agg(F.count("*").alias("total"))
    kept = turn.where(F.col("turn") <= limit) if limit > 0 else turn
    whole = (F.col("total") <= limit) | F.lit(limit <= 0)
    order = [F.when(whole, 0).otherwise(F.col("turn")), F.when(whole, "").otherwise(F.col("relation")), "at", "id"]
    placed = kept.join(totals, "name").withColumn("position", F.row_number().over(W.partitionBy("name").orderBy(*order)).cast("bigint"))
    return placed.where(F.col("position") <= limit) if limit > 0 else placed


def entity_context(entities: DataFrame, triples: DataFrame, limit: int = 8, descriptions: int = 3) -> DataFrame:
    """Of each name that a mention or a triple has: type (the first given), frequency (mentions), the first different
    descriptions and their number, the triples of ``context_round_robin`` and their number, relations with counts.

    Lists are as long as the limits, however often a name is met. Mentions and triples are those of ``mentions`` and ``stated``.
    """
    words = entities.groupBy("name").agg(F.count("*").alias("frequency"), F.min_by("type", F.when(F.col("type") != "", F.col("at"))).alias("type"))
    said = entities.where("description != ''").groupBy("name", "description").agg(F.min("at").alias("at"))
    first = said.withColumn("r", F.row_number().over(W.partitionBy("name").orderBy("at", "description"))).where(F.col("r") <= descriptions)
    texts = first.groupBy("name").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "description"))), lambda x: x["description"]).alias("descriptions"))
    numbers = said.groupBy("name").agg(F.count("*").alias("total_descriptions"))
    shown = context_round_robin(triples, limit)
    listed = shown.groupBy("name").agg(F.max("total").alias("total_triples"), F.sort_array(F.collect_list(F.struct("position", "id", "head", "relation", "tail", "evidence", "source_file", "chunk_index"))).alias("triples"))
    by = relation_summary(triples).groupBy("name").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("relation", "n")))).alias("relations"))
    out = words.join(listed, "name", "full").join(texts, "name", "left").join(numbers, "name", "left").join(by, "name", "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        "name", F.coalesce("type", F.lit("")).alias("type"), *[F.coalesce(c, zero).alias(c) for c in ("frequency", "total_descriptions", "total_triples")],
        F.coalesce("descriptions", F.array().cast("array<string>")).alias("descriptions"), F.coalesce("triples", F.array()).alias("triples"), F.coalesce("relations", F.create_map().cast("map<string,bigint>")).alias("relations"),
    )


def apply_canonical(triples: DataFrame, mapping: DataFrame) -> DataFrame:
    """Triples with their ends replaced by ``name, canonical``; ends that fall together are dropped."""
    h = mapping.select(F.col("name").alias("head"), F.col("canonical").alias("ch"))
    t = mapping.select(F.col("name").alias("tail"), F.col("canonical").alias("ct"))
    out = triples.join(h, "head", "left").join(t, "tail", "left")
    return out.withColumns({"head": F.coalesce("ch", "head"), "tail": F.coalesce("ct", "tail")}).drop("ch", "ct").where("head != tail")


def merge_graph(raw_entities: DataFrame, raw_triples: DataFrame, mapping: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Entities and typed triples of the merged graph. With a mapping ``name, canonical`` from resolution the merged
    entities are renamed and merged again, and triples are normalised before and after they are renamed."""
    entities, t = merge_entities(valid_entities(raw_entities)), valid_triples(raw_triples)
    if mapping is not None:
        m = mapping.select("name", "canonical")
        entities = merge_entities(entities.join(m, "name", "left").withColumn("name", F.coalesce("canonical", "name")).drop("canonical"))
        t = t.withColumns({c: normalize_name(F.col(c)) for c in ("head", "tail")})
        t = apply_canonical(t, m)
    return entities, typed_triples(merge_triples(t, entities), entities)


def ordered(merged: DataFrame) -> DataFrame:
    """By frequency, equal ones as they were first met."""
    return merged.orderBy(F.desc("frequency"), "at")
