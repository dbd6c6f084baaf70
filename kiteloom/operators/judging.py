"""What a judge is asked and what comes of it: context of candidate pairs, review, the whole merge with its audit."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import reply_json
from ..models import Calls, Judge
from ..session import Scratch
from . import merge as M
from . import resolve as R

_IDS = "array<string>"


def side_context(side: str) -> Column:
    """One side of a question from the columns of ``entity_context``: descriptions and triples with ids of their own."""
    text = F.transform("descriptions", lambda x, i: F.struct(F.concat(F.lit(f"{side}_DESC_"), (i + 1).cast("string")).alias("id"), x.alias("text")))
    triples = F.transform(
        "triples",
        lambda x, i: F.struct(
            F.concat(F.lit(f"{side}_TRIPLE_"), (i + 1).cast("string")).alias("id"), F.concat_ws(" ", x["head"], x["relation"], x["tail"]).alias("triple"),
            x["evidence"].alias("evidence"), x["source_file"].alias("source_file"), x["chunk_index"].alias("chunk_index"),
        ),
    )
    more_texts, more_triples = F.col("total_descriptions") - F.size("descriptions"), F.col("total_triples") - F.size("triples")
    return F.struct(
        "name", "type", "frequency", "total_descriptions", more_texts.alias("omitted_descriptions"), "total_triples", more_triples.alias("omitted_triples"),
        ((more_texts > 0) | (more_triples > 0)).alias("truncated"), F.col("relations").alias("relation_summary"), text.alias("descriptions"), triples.alias("triples"),
    )


def pair_context(pairs: DataFrame, context: DataFrame) -> DataFrame:
    """Pairs with ``left`` and ``right`` (what is shown of either side), ``shown_ids`` and ``truncated``; a name without
    context is shown with nothing. ``pairs`` has left_name and right_name; contexts are cut to their names first."""
    names = pairs.select(F.explode(F.array("left_name", "right_name")).alias("name")).distinct()
    zero, none = F.lit(0).cast("bigint"), F.lit("")
    known = names.join(context, "name", "left")
    fill = {"type": none, "frequency": zero, "total_descriptions": zero, "total_triples": zero, "descriptions": F.array().cast(_IDS), "triples": F.array(), "relations": F.create_map().cast("map<string,bigint>")}
    known = known.withColumns({c: F.coalesce(c, v) for c, v in fill.items()})
    out = pairs
    for side, letter in (("left", "L"), ("right", "R")):
        out = out.join(known.select(F.col("name").alias(f"{side}_name"), side_context(letter).alias(side)), f"{side}_name")
    ids = F.concat(*[F.transform(f"{s}.{c}", lambda x: x["id"]) for s in ("left", "right") for c in ("descriptions", "triples")])
    return out.withColumn("shown_ids", ids).withColumn("truncated", F.col("left.truncated") | F.col("right.truncated"))


#: What the judge is told.
TASK = "Decide whether two terms of a knowledge graph on computer networks name the same entity."
RULES = (
    "Judge from the evidence shown only, not from how sure you feel.",
    "merge: each term could stand for the other in every triple without a change of meaning.",
    "keep_separate: the terms are related but differ, or a contrast, a part or a dependence speaks against it.",
    "unsure: the evidence is not enough.",
    "canonical_name is one of allowed_canonical_names.",
)


def question(left: str = "left", right: str = "right") -> Column:
    """The question on a pair with context, as JSON."""
    words = lambda *x: F.array(*[F.lit(v) for v in x])
    reply = F.struct(*[F.lit(v).alias(k) for k, v in (("decision", "|".join(R.DECISIONS)), ("canonical_name", "text or null"), ("reason_code", "short code"), ("reason", "short"), ("supporting_evidence_ids", "list of ids"), ("conflict_evidence_ids", "list of ids"))])
    return F.to_json(F.struct(
        F.lit(TASK).alias("task"), words(*RULES).alias("decision_rules"), words(*R.DECISIONS).alias("allowed_decisions"),
        F.array("left_name", "right_name").alias("allowed_canonical_names"), F.col(left).alias("left"), F.col(right).alias("right"), reply.alias("output"),
    ))


def asked(questions: DataFrame, make: Callable[[], Judge], calls: Calls | None = None, key: str = "id", text: str = "question") -> DataFrame:
    """``key, reply, error`` of every question; failures are rows. Write it before it is used twice."""
    kind = dict(questions.dtypes)[key]
    calls = calls or Calls()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge, call = make(), calls.begin()
        for pdf in parts:
            rows = []
            for i, q in zip(pdf[key], pdf[text]):
                try:
                    rows.append((i, call(lambda q=q: judge.judge(q)), None))
                except Exception as error:
                    rows.append((i, None, str(error)[:500] or type(error).__name__))
            yield pd.DataFrame(rows, columns=[key, "reply", "error"])

    return questions.select(key, text).mapInPandas(run, f"{key} {kind}, reply string, error string")


def parsed_decisions(replies: DataFrame) -> DataFrame:
    """Replies with the fields of their JSON and ``parsed``, false where it is no object."""
    v = F.try_parse_json(reply_json(F.col("reply")))
    field = lambda k: F.try_variant_get(v, f"$.{k}", "string").alias(k)
    # only text counts as an id
    ids = lambda k: F.transform(F.filter(F.coalesce(F.try_variant_get(v, f"$.{k}", "array<variant>"), F.array().cast("array<variant>")), lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string")).alias(k)
    fine = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return replies.select("*", fine.alias("parsed"), *[field(k) for k in ("decision", "canonical_name", "reason_code", "reason")], ids("supporting_evidence_ids"), ids("conflict_evidence_ids"))


@dataclass(frozen=True)
class MergeOptions:
    """How a graph is merged. strategy: recheck, rules (no judge), direct (by similarity alone, which joins what is merely
    related) or none."""

    strategy: str = "recheck"
    candidate_threshold: float = 0.78
    similarity_threshold: float = 0.85
    max_pairs: int = 200
    context_triples: int = 8
    require_support: bool = True
    allow_truncated: bool = False
    max_cluster_size: int = 4
    complete_pairwise: bool = True
    aliases: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.strategy not in ("recheck", "rules", "direct", "none"):
            raise ValueError(f"unknown strategy: {self.strategy}")

    @property
    def threshold(self) -> float:
        return self.candidate_threshold if self.strategy == "recheck" else self.similarity_threshold


_DECISION = ("left_name", "right_name", "decision", "method", "reason_code", "canonical_name", "reason", "supporting_evidence_ids", "conflict_evidence_ids", "score")
_NO_DECISIONS = "left_name string, right_name string, decision string, method string, reason_code string, canonical_name string, reason string, supporting_evidence_ids array<string>, conflict_evidence_ids array<string>, score double"


@dataclass
class Merged:
    """A merged graph and how it came about; every part is a frame."""

    entities: DataFrame
    triples: DataFrame
    stats: DataFrame
    decisions: DataFrame
    cluster_conflicts: DataFrame
    type_conflicts: DataFrame
    summary: DataFrame


def ordered_candidates(candidates: DataFrame) -> DataFrame:
    """From the most similar on, equal ones by their names."""
    return candidates.orderBy(F.desc("score"), "left_name", "right_name")


def decide(candidates: DataFrame, triples: DataFrame, entities: DataFrame, context: DataFrame | None, make: Callable[[], Judge] | None, options: MergeOptions, calls: Calls | None = None) -> DataFrame:
    """The decision on every candidate ``left_name, right_name, left_type, right_type, score``, with ``judged`` (whether a
    judge was asked): rules, the judge within the budget, skipped beyond it."""
    scratch = Scratch(candidates.sparkSession, "decisions")
    f = entities.select("name", "frequency")
    c = candidates.join(f.toDF("left_name", "lf"), "left_name", "left").join(f.toDF("right_name", "rf"), "right_name", "left")
    c = c.withColumn("candidate_id", F.xxhash64("left_name", "right_name"))
    ruled = scratch.cut(R.with_rules(c, triples).withColumnsRenamed({"rule": "decision", "rule_code": "reason_code"}))
    order = lambda n, fr: F.struct(-F.coalesce(fr, F.lit(0)), F.length(n), F.col(n))
    first = F.when(order("left_name", "lf") <= order("right_name", "rf"), F.col("left_name")).otherwise(F.col("right_name"))
    none = F.array().cast(_IDS)

    def said(df: DataFrame, decision: Column, method: str, code: Column, reason: Column) -> DataFrame:
        name = F.when(decision == "merge", first)
        return df.select("left_name", "right_name", decision.alias("decision"), F.lit(method).alias("method"), code.alias("reason_code"), name.alias("canonical_name"), reason.alias("reason"), none.alias("supporting_evidence_ids"), none.alias("conflict_evidence_ids"), "score", F.lit(False).alias("judged"))

    by_rule = said(ruled.where("decision != 'needs_llm'"), F.col("decision"), "rules", F.col("reason_code"), F.lit(""))
    if options.strategy != "recheck":
        return by_rule.union(said(ruled.where("decision = 'needs_llm'"), F.lit("unsure"), "rules_only", F.lit("LLM_RECHECK_DISABLED"), F.lit("similarity only finds candidates")))
    routed = scratch.cut(R.budget_split(ruled, options.max_pairs) if options.max_pairs > 0 else ruled.withColumn("route", F.when(F.col("decision") == "needs_llm", "review").otherwise("rules")))
    skipped = said(routed.where("route = 'skipped'"), F.lit("unsure"), "llm_recheck_skipped", F.lit("MAX_PAIRS_EXCEEDED"), F.lit("beyond the budget of reviews"))
    pairs = routed.where("route = 'review'").select("candidate_id", "left_name", "right_name", "left_type", "right_type", "score")
    shown = scratch.cut(pair_context(pairs, context).withColumn("question", question()).drop("left", "right"))
    replies = scratch.cut(asked(shown, make, calls, "candidate_id"))
    judged = R.validated(parsed_decisions(replies).join(shown, "candidate_id"), triples, options.require_support, options.allow_truncated)
    return by_rule.union(skipped).union(judged.select(*_DECISION, F.lit(True).alias("judged")))


def merge_directory(raw_entities: DataFrame, raw_triples: DataFrame, candidates: Callable[[DataFrame], DataFrame] | None = None, make: Callable[[], Judge] | None = None, options: MergeOptions | None = None, calls: Calls | None = None) -> Merged:
    """Raw entities and triples to a graph whose entities are resolved, with the audit.

    First merge, candidates among its entities (``candidates`` gives left_name, right_name, left_type, right_type, score for them),
    decisions, clusters with vetoes, mapping, second merge. Without ``candidates`` nothing is resolved.
    """
    options = options or MergeOptions()
    spark = raw_entities.sparkSession
    scratch = Scratch(spark, "merge")
    valid, triples = M.valid_entities(raw_entities), M.valid_triples(raw_triples)
    conflicts = M.type_conflicts(valid)
    decisions = spark.createDataFrame([], _NO_DECISIONS).withColumn("judged", F.lit(False))
    vetoes, mapping = spark.createDataFrame([], "cluster string, size bigint, reason_code string"), None
    if candidates is not None and options.strategy != "none":
        first = scratch.cut(M.merge_entities(valid))
        close = scratch.cut(candidates(first).where(F.col("score") >= options.threshold))
        if options.strategy == "direct":
            members = scratch.cut(R.components(close, "left_name", "right_name"))
            mapping = members.join(R.canonical_pick(members, first).select("cluster", "canonical"), "cluster").select("name", "canonical")
        else:
            context = M.entity_context(M.mentions(raw_entities), M.stated(raw_triples), options.context_triples) if options.strategy == "recheck" else None
            decisions = scratch.cut(decide(close, triples, first, context, make, options, calls))
            accepted = scratch.cut(decisions.where("decision = 'merge'"))
            vetoes = scratch.cut(R.cluster_conflicts(accepted, triples, options.max_cluster_size, options.complete_pairwise))
            members = scratch.cut(R.components(accepted, "left_name", "right_name"))
            fine = members.join(vetoes.select("cluster"), "cluster", "left_anti")
            preferred = accepted.where("canonical_name is not null").select(F.col("canonical_name").alias("name"))
            mapping = fine.join(R.canonical_pick(fine, first, preferred).select("cluster", "canonical"), "cluster").select("name", "canonical")
        mapping = scratch.cut(mapping)
    entities, merged = M.merge_graph(raw_entities, raw_triples, mapping)
    entities = scratch.cut(entities)
    merged = scratch.cut(merged)
    counts = decisions.agg(F.count("*").alias("candidates"), F.count_if("judged").alias("reviewed"), F.count_if(F.col("reason_code") == "MAX_PAIRS_EXCEEDED").alias("skipped"), F.count_if(F.col("decision") == "merge").alias("merged"))
    summary = counts.select(F.lit(options.strategy).alias("strategy"), "*")
    in_order = decisions.orderBy("judged", F.desc("score"), "left_name", "right_name")
    return Merged(M.ordered(entities), M.ordered(merged), M.graph_stats(entities, merged), in_order, vetoes, conflicts.orderBy("name"), summary)


# ---------------------------------------------------------------------------------------------------------------------
# Judges of evaluation


def entity_questions(tiers: DataFrame, pool: DataFrame, most: int = 200) -> DataFrame:
    """``gold_name, gold_type, names, question``: what the judge is asked on gold entities that no candidate equals.

    ``tiers`` are those of ``candidate_tiers``; descriptions are clipped to ``most`` characters.
    """
    from ..functions.text import clip

    told = pool.groupBy("name", F.col("type").alias("gold_type")).agg(F.min_by("description", "at").alias("description"), F.sum("frequency").alias("frequency"))
    c = tiers.where("tier != 'exact_norm'").join(told, ["name", "gold_type"], "left")
    one = F.struct("rank", "name", clip(F.coalesce("description", F.lit("")), most).alias("description"), F.coalesce("frequency", F.lit(0)).alias("frequency"))
    g = c.groupBy("gold_name", "gold_type").agg(F.sort_array(F.collect_list(one)).alias("listed"))  # ten at most
    offered = F.transform("listed", lambda x, i: F.struct(i.alias("index"), x["name"].alias("name"), x["description"].alias("description"), x["frequency"].alias("frequency")))
    ask = F.to_json(F.struct(F.struct(F.col("gold_name").alias("name"), F.col("gold_type").alias("type")).alias("gold"), offered.alias("candidates"), F.lit("matched_indices: indices of the candidates that name the gold entity").alias("output")))
    return g.select("gold_name", "gold_type", F.transform("listed", lambda x: x["name"]).alias("names"), ask.alias("question"))


def align_entities(tiers: DataFrame, pool: DataFrame, make: Callable[[], Judge], calls: Calls | None = None) -> DataFrame:
    """``gold_name, gold_type, pred_name``: equal names align at once, of others those that the judge picks; a failed or
    unreadable reply picks none, and so do indices that were not offered."""
    from ..functions.text import first_object

    scratch = Scratch(tiers.sparkSession, "align")
    q = scratch.cut(entity_questions(tiers, pool).withColumn("id", F.xxhash64("gold_name", "gold_type")))
    replies = scratch.cut(asked(q, make, calls))
    picked = F.try_variant_get(F.try_parse_json(first_object("reply")), "$.matched_indices", "array<variant>")
    number = lambda x: F.when(F.schema_of_variant(x) == "BIGINT", F.try_variant_get(x, "$", "int"))
    got = replies.join(q, "id").select("gold_name", "gold_type", "names", F.explode(F.array_distinct(F.transform(picked, number))).alias("i"))
    judged = got.where("i >= 0 and i < size(names)").select("gold_name", "gold_type", F.element_at("names", F.col("i") + 1).alias("pred_name"))
    same = tiers.where("tier = 'exact_norm'").select("gold_name", "gold_type", F.col("name").alias("pred_name"))
    return same.union(judged).distinct()


def align_summary(gold: DataFrame, align: DataFrame) -> DataFrame:
    """One row: gold entities, those with a counterpart, those without."""
    g = gold.select(F.col("name").alias("gold_name"), F.col("type").alias("gold_type")).where("trim(gold_name) != '' and trim(gold_type) != ''").distinct()
    m = g.join(align.select("gold_name", "gold_type").distinct().withColumn("hit", F.lit(True)), ["gold_name", "gold_type"], "left")
    return m.agg(F.count("*").alias("total"), F.count("hit").alias("matched"), F.count_if(F.col("hit").isNull()).alias("unmatched"))


def judge_relations(gold: DataFrame, align: DataFrame, pred: DataFrame, make: Callable[[], Judge], calls: Calls | None = None) -> DataFrame:
    """``gold_relation, pred_relation``: relations that the judge calls equivalent, of those that meet between aligned ends of a
    gold triple without a triple of its own relation there. Each pair of relations is asked once."""
    from ..functions.text import first_object

    scratch = Scratch(gold.sparkSession, "relations")
    end = lambda c, p: align.select(F.col("gold_name").alias(c), F.col("gold_type").alias(f"{c}_type"), F.col("pred_name").alias(p)).distinct()
    links = pred.select(F.col("head").alias("ph"), F.col("tail").alias("pt"), F.col("relation").alias("pred_relation")).distinct()
    met = gold.select("head", "head_type", F.col("relation").alias("gold_relation"), "tail", "tail_type").distinct().join(end("head", "ph"), ["head", "head_type"]).join(end("tail", "pt"), ["tail", "tail_type"]).join(links, ["ph", "pt"])
    some = met.where("gold_relation != pred_relation").groupBy("gold_relation", "pred_relation").agg(F.min(F.struct("ph", "pt")).alias("x"))
    ask = F.to_json(F.struct(F.struct(F.col("x.ph").alias("head"), F.col("gold_relation").alias("relation"), F.col("x.pt").alias("tail")).alias("gold"), F.struct(F.col("x.ph").alias("head"), F.col("pred_relation").alias("relation"), F.col("x.pt").alias("tail")).alias("candidate"), F.lit("equivalent: whether the relations state the same fact").alias("output")))
    q = scratch.cut(some.select("gold_relation", "pred_relation", ask.alias("question")).withColumn("id", F.xxhash64("gold_relation", "pred_relation")))
    replies = scratch.cut(asked(q, make, calls))
    same = F.coalesce(F.try_variant_get(F.try_parse_json(first_object("reply")), "$.equivalent", "boolean"), F.lit(False))
    return q.join(replies.where(same).select("id"), "id").select("gold_relation", "pred_relation")
