"""Entity resolution: candidate pairs, rules, review budget, judged decisions, clusters and their vetoes, canonical names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import clean_ids, compact_name, cosine, normalize_name, strip, text_or_empty
from ..session import Scratch


def usable_vector(e: Column, dim: int = 64) -> Column:
    """dim finite values, not all zero."""
    fine = F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(e) == dim) & fine & F.exists(e, lambda x: x != 0), F.lit(False))


def knn_candidates(vectors: DataFrame, threshold: float, k: int = 10, block: int = 32768, dim: int = 64) -> DataFrame:
    """Pairs left_id < right_id of one type whose cosine reaches the threshold and of which the right one is among the
    left one's k nearest of that type (others than itself; equal scores by id). Exact; scores have six decimals.

    Every two vectors of a type meet once, block by block. The number of parts of a type follows from its size, so a task
    holds about two times ``block`` vectors however large the type is, and only each block's k best of a row leave it. All pairs are
    compared, which is what exact means; for more vectors than that allows there are approximate graphs.

    Single precision tells, with room for its error, which pairs may reach the threshold; only those are scored, in double
    precision, and put in order.
    """
    import numpy as np
    import pandas as pd

    sizes = vectors.where(F.col("type").isNotNull()).groupBy("type").agg(F.ceil(F.count("*") / block).cast("int").alias("parts")).where("parts > 1")  # few, whatever the number of types
    v = vectors.where(usable_vector(F.col("embedding"), dim) & F.col("type").isNotNull()).select(F.col("node_id").alias("id"), "type", "embedding")
    v = v.join(F.broadcast(sizes), "type", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    meeting = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.struct(F.least(i, "own").alias("b"), F.greatest(i, "own").alias("c"), (i < F.col("own")).alias("side")))
    blocks = v.select("type", "id", "embedding", F.explode(meeting).alias("m")).select("type", "m.*", "id", "embedding")
    room = (dim + 8) * 2.0**-23 + 5e-7  # of a product in single precision, and of rounding
    height, width = 512, 2048  # what stays in a core's cache

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
        x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)
        ids, side = pdf["id"].to_numpy(), pdf["side"].to_numpy(dtype=bool)
        own = bool(pdf["b"].iloc[0] == pdf["c"].iloc[0])
        del pdf
        order = np.argsort(side, kind="stable")
        x, ids, split = x[order], ids[order], len(side) if own else int((~side).sum())
        single, buffer = x.astype(np.float32), np.empty(height * width, np.float32)
        floor = np.full(len(x), threshold)  # no lower score is among a row's k best so far
        none = np.zeros(0, dtype=np.int64)
        left, right, score = [none], [none], [np.zeros(0)]

        def best() -> None:
            """Keeps each row's k best."""
            a, b, s = np.concatenate(left), np.concatenate(right), np.concatenate(score)
            order = np.lexsort((ids[b], -s, a))
            a, b, s = a[order], b[order], s[order]
            first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]][: len(a)])
            rank = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)]))
            floor[a[rank == k - 1]] = s[rank == k - 1]
            left[:], right[:], score[:] = [a[rank < k]], [b[rank < k]], [s[rank < k]]

        fresh = 0
        for i in range(0, split, height):
            n = min(height, split - i)
            for j in range(i if own else split, len(x), width):
                w = min(width, len(x) - j)
                s = np.matmul(single[i : i + n], single[j : j + w].T, out=buffer[: n * w].reshape(n, w)).ravel()
                at = np.flatnonzero(s >= threshold - room)
                if not len(at):
                    continue
                a, b = at // w + i, at % w + j
                may = (s[at] >= np.minimum(floor[a], floor[b]) - room) & (ids[a] != ids[b])
                if own:
                    may &= a < b
                a, b = a[may], b[may]
                if len(a) * 16 > n * w:
                    t = np.round((x[i : i + n] @ x[j : j + w].T)[a - i, b - j], 6)
                else:
                    t = np.round(np.einsum("ij,ij->i", x[a], x[b]), 6)
                for f, g in ((a, b), (b, a)):
                    good = t >= floor[f]
                    left.append(f[good])
                    right.append(g[good])
                    score.append(t[good])
                    fresh += int(good.sum())
                if fresh > 1_000_000:
                    best()
                    fresh = 0
        best()
        return pd.DataFrame({"left_id": ids[left[0]], "right_id": ids[right[0]], "score": score[0]})

    near = blocks.groupBy("type", "b", "c").applyInPandas(meet, "left_id bigint, right_id bigint, score double")
    ranked = near.withColumn("r", F.row_number().over(W.partitionBy("left_id").orderBy(F.desc("score"), "right_id"))).where(F.col("r") <= k)
    return ranked.where("left_id < right_id").select("left_id", "right_id", "score")


def score_pairs(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Pairs of ids with the cosine of their vectors, in the JVM; null where a usable vector is missing."""
    e = vectors.where(usable_vector(F.col("embedding"))).select("node_id", "embedding")
    out = pairs.join(e.toDF("left_id", "le"), "left_id", "left").join(e.toDF("right_id", "re"), "right_id", "left")
    return out.withColumn("cosine", F.round(cosine(F.col("le"), F.col("re")), 6)).drop("le", "re")


def strong_names(a: Column, b: Column) -> Column:
    """Names that normalise, or shrink to their letters, to the same."""
    return (normalize_name(a) == normalize_name(b)) | (compact_name(a) == compact_name(b))


def linked_pairs(triples: DataFrame) -> DataFrame:
    """``lo, hi``: unordered pairs of normalised names that some triple links."""
    h, t = normalize_name(F.col("head")), normalize_name(F.col("tail"))
    return triples.select(F.least(h, t).alias("lo"), F.greatest(h, t).alias("hi")).where("lo != hi").distinct()


def _linked(pairs: DataFrame, links: DataFrame, a: str, b: str) -> DataFrame:
    na, nb = normalize_name(F.col(a)), normalize_name(F.col(b))
    flagged = links.withColumn("linked", F.lit(True))
    return pairs.withColumns({"lo": F.least(na, nb), "hi": F.greatest(na, nb)}).join(flagged, ["lo", "hi"], "left").withColumn("linked", F.coalesce("linked", F.lit(False))).drop("lo", "hi")


def with_rules(pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """Pairs with ``rule`` and ``rule_code``: types differ, strong names, a direct relation, else for review, in this order."""
    c = _linked(pairs, linked_pairs(triples), "left_name", "right_name")
    same = F.coalesce(F.col("left_type") == F.col("right_type"), F.col("left_type").isNull() & F.col("right_type").isNull())
    code = (
        F.when(~same, "TYPE_MISMATCH")
        .when(F.coalesce(strong_names(F.col("left_name"), F.col("right_name")), F.lit(False)), "STRONG_NAME_EQUIVALENCE")
        .when(F.col("linked"), "DIRECT_RELATION_SELF_LOOP_RISK")
        .otherwise("AMBIGUOUS_REQUIRES_LLM")
    )
    what = F.when(F.col("rule_code") == "STRONG_NAME_EQUIVALENCE", "merge").when(F.col("rule_code") == "AMBIGUOUS_REQUIRES_LLM", "needs_llm").otherwise("keep_separate")
    return c.withColumn("rule_code", code).withColumn("rule", what).drop("linked")


def pair_rules(candidates: DataFrame, triples: DataFrame) -> DataFrame:
    """Decision and reason of the rules alone."""
    return with_rules(candidates, triples).withColumnsRenamed({"rule": "decision", "rule_code": "reason_code"})


def budget_split(ruled: DataFrame, budget: int) -> DataFrame:
    """``route``: rules, or for ambiguous pairs review for the first ``budget`` in order of score and names, skipped beyond.

    A global rank is needed only among ambiguous pairs; a take-ordered limit marks those within the budget, so the
    others are never sorted in one task.
    """
    unsure = ruled.where("decision = 'needs_llm'").select("candidate_id", F.coalesce("score", F.lit(float("-inf"))).alias("s"), "left_name", "right_name")
    inside = unsure.orderBy(F.desc("s"), "left_name", "right_name", "candidate_id").limit(budget).select("candidate_id", F.lit(True).alias("inside"))
    route = F.when(F.col("decision") != "needs_llm", "rules").when(F.col("inside"), "review").otherwise("skipped")
    return ruled.join(inside, "candidate_id", "left").withColumn("route", route).drop("inside")


DECISIONS = ("merge", "keep_separate", "unsure")


def judgement(judged: DataFrame, require_support: bool = True) -> DataFrame:
    """A judge's replies as untrusted input, before the rules are heard again.

    ``judged``: left_name, right_name, decision, canonical_name, reason_code, reason, supporting_evidence_ids,
    conflict_evidence_ids, shown_ids, and optionally ``parsed`` (whether the reply was an object) and ``error``. An unknown
    decision is unsure; a merge stays one only if its name is one of the pair, its support is not empty and was all shown, and no
    conflict that was shown is named. Support that was not shown makes any decision unsure; what was not shown is left out.
    """
    word = F.lower(text_or_empty(F.col("decision")))
    named = strip(F.col("canonical_name"))
    shown = F.coalesce("shown_ids", F.array().cast("array<string>"))
    said, against = clean_ids(F.col("supporting_evidence_ids")), clean_ids(F.col("conflict_evidence_ids"))
    support, conflict = F.array_intersect(said, shown), F.array_intersect(against, shown)
    known = F.size(support) == F.size(said)
    fine = F.coalesce(named.isin(F.col("left_name"), F.col("right_name")), F.lit(False)) & known & (F.size(conflict) == 0)
    fine = fine & (F.size(support) > 0) if require_support else fine
    decided = F.when(word == "merge", F.when(fine, "merge").otherwise("unsure")).when(known & word.isin(*DECISIONS), word).otherwise("unsure")
    code = F.coalesce(F.nullif(strip(F.col("reason_code")), F.lit("")), F.lit("LLM_RECHECK"))
    failed = F.col("error").isNotNull() if "error" in judged.columns else F.lit(False)
    unread = ~F.col("parsed") if "parsed" in judged.columns else F.lit(False)
    none = F.array().cast("array<string>")
    lost = failed | unread
    return judged.withColumns({
        "decision": F.when(lost, "unsure").otherwise(decided), "method": F.lit("llm_recheck"),
        "reason_code": F.when(failed, "LLM_REQUEST_FAILED").when(unread, "LLM_INVALID_JSON").otherwise(code),
        "reason": F.when(failed, F.col("error") if "error" in judged.columns else "").when(unread, "").otherwise(text_or_empty(F.col("reason"))),
        "canonical_name": F.when(~lost & (word == "merge") & fine, named),
        "supporting_evidence_ids": F.when(lost, none).otherwise(support), "conflict_evidence_ids": F.when(lost, none).otherwise(conflict),
    }).drop("parsed", "error")


def validated(judged: DataFrame, triples: DataFrame, require_support: bool = True, allow_truncated: bool = False) -> DataFrame:
    """``judgement``, and then the rules again: where they keep a pair separate it stays so, whatever the judge says, and a merge
    that was judged from a cut context (``truncated``) is unsure. ``judged`` also has left_type and right_type."""
    r = with_rules(judgement(judged, require_support), triples)
    hard = F.col("rule") == "keep_separate"
    cut = ~hard & (F.col("decision") == "merge") & F.coalesce("truncated", F.lit(False)) & F.lit(not allow_truncated)
    none = F.array().cast("array<string>")
    return r.withColumns({
        "decision": F.when(hard, "keep_separate").when(cut, "unsure").otherwise(F.col("decision")),
        "method": F.when(hard, "rules_after_llm").otherwise(F.col("method")),
        "reason_code": F.when(hard, F.col("rule_code")).when(cut, "TRUNCATED_CONTEXT").otherwise(F.col("reason_code")),
        "reason": F.when(hard, "the rules keep the pair separate").when(cut, "the judge did not see the whole context").otherwise(F.col("reason")),
        "canonical_name": F.when(hard | cut, F.lit(None).cast("string")).otherwise(F.col("canonical_name")),
        "supporting_evidence_ids": F.when(hard, none).otherwise(F.col("supporting_evidence_ids")), "conflict_evidence_ids": F.when(hard, none).otherwise(F.col("conflict_evidence_ids")),
    }).drop("rule", "rule_code")


def components(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """``name, cluster``: everything that pairs link, with the smallest member of its cluster.

    Rounds of two steps, each a join and a map-side combined minimum: every vertex and its neighbours are hung on the
    smallest of them, first those larger than the vertex, then those smaller; stars remain after a logarithmic number of
    rounds. Each round is a table in the shared folder, so lost executors cost one round at most.
    """
    spark = pairs.sparkSession
    scratch = Scratch(spark, "stars")
    e = scratch.cut(pairs.select(F.least(left, right).alias("v"), F.greatest(left, right).alias("u")).where("u != v").distinct())

    def mark(df: DataFrame) -> tuple:
        """Number of edges and two sums over them: equal only if a round changed nothing."""
        h = lambda seed: F.sum(F.pmod(F.xxhash64("u", "v", F.lit(seed)), F.lit(1 << 40)))
        return tuple(df.agg(F.count("*"), h(1), h(2)).collect()[0])

    state = mark(e)
    while True:
        both = e.select("u", "v").union(e.select(F.col("v"), F.col("u")).toDF("u", "v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        after = scratch.cut(small.where("u != v").distinct())
        scratch.drop(e)
        e, before, state = after, state, mark(after)
        if state == before:
            break
    return e.select(F.col("u").alias("name"), F.col("v").alias("cluster")).union(e.select("v", "v").distinct())


def cluster_conflicts(accepted: DataFrame, triples: DataFrame, largest: int = 4, complete: bool = True) -> DataFrame:
    """``cluster, size, reason_code``: clusters of accepted merges that must stay apart, with the first reason.

    Too large; else, over pairs of members in name order that aren't strong names, the first that was not accepted itself
    (if ``complete``) or that a triple links. Pairs are made only within clusters of at most ``largest`` members.
    """
    if largest < 1:
        raise ValueError("largest must be at least 1")
    scratch = Scratch(accepted.sparkSession, "clusters")
    pairs = scratch.cut(accepted.select(F.least("left_name", "right_name").alias("a"), F.greatest("left_name", "right_name").alias("b")).where("a != b").distinct())
    member = scratch.cut(components(pairs, "a", "b"))
    sized = member.groupBy("cluster").agg(F.count("*").alias("size"))
    big = sized.where(F.col("size") > largest).withColumn("reason_code", F.lit("CLUSTER_TOO_LARGE"))
    ok = member.join(sized.where(F.col("size") <= largest), "cluster")
    inside = ok.select("cluster", "size", F.col("name").alias("a")).join(ok.select("cluster", F.col("name").alias("b")), "cluster").where("a < b")
    inside = inside.where(~strong_names(F.col("a"), F.col("b"))).join(pairs.withColumn("taken", F.lit(True)), ["a", "b"], "left")
    inside = _linked(inside, linked_pairs(triples), "a", "b")
    why = F.when(F.col("taken").isNull() & F.lit(complete), "INCOMPLETE_PAIRWISE_CLUSTER").when(F.col("linked"), "DIRECT_RELATION_IN_CLUSTER")
    wrong = inside.withColumn("reason_code", why).where("reason_code is not null")
    first = wrong.groupBy("cluster", "size").agg(F.min_by("reason_code", F.struct("a", "b")).alias("reason_code"))
    return big.union(first)


def canonical_pick(members: DataFrame, frequencies: DataFrame, preferred: DataFrame | None = None) -> DataFrame:
    """``cluster, canonical``: a preferred name, else the most frequent, the shortest, the first. ``members``: name, cluster."""
    f = members.join(frequencies.groupBy("name").agg(F.sum("frequency").alias("f")), "name", "left")
    if preferred is not None:
        f = f.join(preferred.select("name").distinct().withColumn("p", F.lit(0)), "name", "left")
    else:
        f = f.withColumn("p", F.lit(None).cast("int"))
    order = F.struct(F.coalesce("p", F.lit(1)), -F.coalesce("f", F.lit(0)), F.length("name"), F.col("name"))
    return f.groupBy("cluster").agg(F.min_by("name", order).alias("canonical"), F.count("*").alias("size"))


def canonical_mapping(accepted: DataFrame, entities: DataFrame, triples: DataFrame, preferred: DataFrame | None = None) -> DataFrame:
    """``name, canonical`` for the members of clusters without a veto."""
    scratch = Scratch(accepted.sparkSession, "mapping")
    members = scratch.cut(components(accepted, "left_name", "right_name"))
    fine = members.join(cluster_conflicts(accepted, triples).select("cluster"), "cluster", "left_anti")
    return fine.join(canonical_pick(fine, entities, preferred).select("cluster", "canonical"), "cluster").select("name", "canonical")


def audit_counts(routed: DataFrame) -> DataFrame:
    """One row: candidates, reviewed, skipped, and decisions of the rules."""
    n = lambda c: F.count_if(c)
    return routed.agg(
        F.count("*").alias("candidates"), n(F.col("route") == "review").alias("reviewed"), n(F.col("route") == "skipped").alias("skipped"),
        n(F.col("decision") == "merge").alias("merged"), n(F.col("decision") == "keep_separate").alias("kept_separate"),
    )
