"""Measuring a predicted graph against gold: strict, raw, relaxed tiers, attributes, comparison, judge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import aliases_of, norm_name, normalize_name, strip, text_or_empty, tokens_of
from ..session import Scratch
from .merge import order_of

TRIPLE = ["head", "head_type", "relation", "tail", "tail_type"]
ENTITY = ["name", "type"]
RELATION = ["head_type", "relation", "tail_type"]


def score(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """Counts, precision, recall and F1; a ratio over nothing is 0."""
    safe = lambda a, b: F.round(F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0)), 6)
    return [
        tp.cast("bigint").alias("tp"), fp.cast("bigint").alias("fp"), fn.cast("bigint").alias("fn"),
        safe(tp, tp + fp).alias("precision"), safe(tp, tp + fn).alias("recall"), safe(F.lit(2) * tp, F.lit(2) * tp + fp + fn).alias("f1"),
    ]


def marked(pred: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of either side with ``in_pred`` and ``in_gold``, from one aggregation over both."""
    both = pred.select(*keys, F.lit(True).alias("p"), F.lit(False).alias("g")).union(gold.select(*keys, F.lit(False), F.lit(True)))
    return both.groupBy(*keys).agg(F.max("p").alias("in_pred"), F.max("g").alias("in_gold"))


def strict(pred: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """One row of counts and ratios over distinct keys."""
    m = marked(pred, gold, keys)
    n = lambda c: F.count_if(c)
    p, g = F.col("in_pred"), F.col("in_gold")
    return m.agg(n(p & g).alias("a"), n(p & ~g).alias("b"), n(~p & g).alias("c")).select(*score(F.col("a"), F.col("b"), F.col("c")))


def errors(pred: DataFrame, gold: DataFrame, side: str, top: int) -> DataFrame:
    """False positives (``side`` fp) or false negatives (fn), in order of the five fields, at most ``top``."""
    if top < 0:
        raise ValueError("top must not be negative")
    m = marked(pred, gold, TRIPLE)
    wrong = F.col("in_pred") & ~F.col("in_gold") if side == "fp" else ~F.col("in_pred") & F.col("in_gold")
    return m.where(wrong).select(*TRIPLE).orderBy(*TRIPLE).limit(top)


def evidence_coverage(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """Share of predicted triples with evidence, over all and over the true ones; ``pred`` has ``evidenced``."""
    one = pred.groupBy(*TRIPLE).agg(F.bool_or("evidenced").alias("e"))
    m = one.join(gold.select(*TRIPLE).distinct().withColumn("hit", F.lit(True)), TRIPLE, "left")
    share = lambda c: F.round(F.coalesce(F.avg(c), F.lit(0.0)), 6)
    return m.agg(share(F.col("e").cast("double")).alias("predicted"), share(F.when(F.col("hit"), F.col("e").cast("double"))).alias("true"))


def entities_from(triples: DataFrame) -> DataFrame:
    """Entities that triples name, for a gold set without entities."""
    return triples.select(F.explode(F.array(F.struct(F.col("head").alias("name"), F.col("head_type").alias("type")), F.struct(F.col("tail").alias("name"), F.col("tail_type").alias("type")))).alias("x")).select("x.*").distinct()


def raw_triples(raw: DataFrame) -> DataFrame:
    """Raw triples with head, relation and tail given; nothing else leaves one out."""
    t = raw.select("file_stem", "source_file", *[strip(F.col(c)).alias(c) for c in ("head", "relation", "tail")], text_or_empty(F.col("evidence")).alias("evidence"))
    return t.where("head != '' and relation != '' and tail != ''")


def types_by_chunk(entities: DataFrame, runs: dict[str, Column]) -> DataFrame:
    """``file_stem, name, type_<run>``: of each chunk's names the type that a run's entities give, the last of several; null
    without one. One pass over the entities, whatever the number of runs."""
    e = entities.select("file_stem", strip(F.col("name")).alias("name"), strip(F.col("type")).alias("type"), order_of("entity_id").alias("at"), *[c.alias(r) for r, c in runs.items()])
    e = e.where("name != '' and type != '' and file_stem is not null")
    return e.groupBy("file_stem", "name").agg(*[F.max_by("type", F.when(F.col(r), F.col("at"))).alias(f"type_{r}") for r in runs])


def _scopes(head: Column, head_type: Column, relation: Column, tail: Column, tail_type: Column) -> Column:
    """The keys of one triple: itself, its relation with the types of its ends, its two entities."""
    none = F.lit("")
    key = lambda scope, *x: F.struct(F.lit(scope).alias("scope"), *[c.alias(n) for c, n in zip([*x, *[none] * (5 - len(x))], "abcde")])
    return F.array(key("triple", head, head_type, relation, tail, tail_type), key("relation", head_type, relation, tail_type), key("entity", head, head_type), key("entity", tail, tail_type))


def _run_scores(keys: DataFrame, runs: list[str], keyed: list[str]) -> DataFrame:
    """``run, scope`` and scores of each run against gold, from rows of keys with ``side`` (a run or gold)."""
    sides = [*runs, "gold"]
    one = keys.groupBy(*keyed).agg(*[F.bool_or(F.col("side") == s).alias(s) for s in sides])
    n = lambda r, p, g: F.count_if((F.col(r) == p) & (F.col("gold") == g))
    counts = one.groupBy("scope").agg(*[F.struct(F.lit(r).alias("run"), n(r, True, True).alias("x"), n(r, True, False).alias("y"), n(r, False, True).alias("z")).alias(f"_{r}") for r in runs])
    long = counts.select("scope", F.explode(F.array(*[f"_{r}" for r in runs])).alias("c"))
    return long.select("c.run", "scope", *score(F.col("c.x"), F.col("c.y"), F.col("c.z")))


def raw_typed(triples: DataFrame, kinds: DataFrame, runs: list[str]) -> DataFrame:
    """Raw triples with the types of both ends by run, '' where the run's chunk has none, as ``head_<run>, tail_<run>``."""
    h = kinds.select("file_stem", F.col("name").alias("head"), *[F.col(f"type_{r}").alias(f"head_{r}") for r in runs])
    t = kinds.select("file_stem", F.col("name").alias("tail"), *[F.col(f"type_{r}").alias(f"tail_{r}") for r in runs])
    out = triples.join(h, ["file_stem", "head"], "left").join(t, ["file_stem", "tail"], "left")
    return out.withColumns({f"{e}_{r}": F.coalesce(f"{e}_{r}", F.lit("")) for e in ("head", "tail") for r in runs})


def raw_sides(entities: DataFrame, triples: DataFrame, runs: dict[str, Column]) -> DataFrame:
    """``side, head, head_type, relation, tail, tail_type``: raw triples as each run types them, in chunks that gold has and
    the run extracted, and as gold (the entities of all runs) types them; gold needs a source file."""
    sides = {**runs, "gold": F.lit(True)}
    t = raw_typed(raw_triples(triples), types_by_chunk(entities, sides), list(sides))
    chunks = entities.where("file_stem is not null").groupBy("file_stem").agg(*[F.bool_or(c).alias(f"has_{r}") for r, c in runs.items()])
    golden = t.where(text_or_empty(F.col("source_file")) != "").select("file_stem").distinct().withColumn("golden", F.lit(True))
    t = t.join(chunks, "file_stem", "left").join(golden, "file_stem", "left")
    here = {r: F.coalesce(F.col(f"has_{r}") & F.col("golden"), F.lit(False)) for r in runs} | {"gold": text_or_empty(F.col("source_file")) != ""}
    row = lambda r: F.when(here[r], F.struct(F.lit(r).alias("side"), F.col(f"head_{r}").alias("head_type"), F.col(f"tail_{r}").alias("tail_type")))
    long = t.select("head", "relation", "tail", F.explode(F.array_compact(F.array(*[row(r) for r in sides]))).alias("x"))
    return long.select("x.side", "head", "x.head_type", "relation", "tail", "x.tail_type")


def raw_scores(sides: DataFrame, runs: list[str]) -> DataFrame:
    """Of each run counts and ratios over distinct triples, relations and entities, all in one aggregation."""
    keys = sides.select("side", F.explode(_scopes(*[F.col(c) for c in TRIPLE])).alias("k")).select("side", "k.*")
    return _run_scores(keys, runs, ["scope", *"abcde"])


def raw_coverage(entities: DataFrame, triples: DataFrame, runs: dict[str, Column]) -> DataFrame:
    """``run, matched, missing``: chunks of gold triples that a run extracted, and those it did not."""
    gold = triples.where((text_or_empty(F.col("source_file")) != "") & F.col("file_stem").isNotNull()).select("file_stem").distinct()
    have = entities.where("file_stem is not null").groupBy("file_stem").agg(*[F.bool_or(c).alias(r) for r, c in runs.items()])
    m = gold.join(have, "file_stem", "left")
    n = lambda r: F.struct(F.lit(r).alias("run"), F.count_if(F.coalesce(r, F.lit(False))).alias("matched"), F.count_if(~F.coalesce(r, F.lit(False))).alias("missing"))
    return m.agg(*[n(r).alias(f"_{r}") for r in runs]).select(F.explode(F.array(*[f"_{r}" for r in runs])).alias("x")).select("x.*")


def run_sides(entities: DataFrame, triples: DataFrame, runs: dict[str, Column]) -> DataFrame:
    """``scope, side, a, b, c, d, e``: entities, typed triples and relations of the graph merged from each run's entities
    (``side`` gold: all), from one pass over either table.

    ``entities`` and ``triples`` are valid ones; a run's triple has both ends among its entities, of the first type given.
    """
    sides = {**runs, "gold": F.lit(True)}
    n = entities.select(normalize_name(F.col("name")).alias("name"), "type", "at", *[c.alias(r) for r, c in sides.items()]).where(F.length("name") >= 2)
    kinds = n.groupBy("name").agg(*[F.min_by("type", F.when(F.col(r), F.col("at"))).alias(r) for r in sides])
    none = F.lit("")
    named = lambda r: F.when(F.col(r).isNotNull(), F.struct(F.lit("entity").alias("scope"), F.lit(r).alias("side"), F.col("name").alias("a"), F.col(r).alias("b"), none.alias("c"), none.alias("d"), none.alias("e")))
    nodes = kinds.select(F.explode(F.array_compact(F.array(*[named(r) for r in sides]))).alias("x")).select("x.*")
    t = triples.select(normalize_name(F.col("head")).alias("head"), "relation", normalize_name(F.col("tail")).alias("tail")).where("head != tail").distinct()
    t = t.join(kinds.select(F.col("name").alias("head"), *[F.col(r).alias(f"h_{r}") for r in sides]), "head").join(kinds.select(F.col("name").alias("tail"), *[F.col(r).alias(f"t_{r}") for r in sides]), "tail")
    link = lambda r: F.when(F.col(f"h_{r}").isNotNull() & F.col(f"t_{r}").isNotNull(), F.struct(F.lit(r).alias("side"), F.slice(_scopes(F.col("head"), F.col(f"h_{r}"), F.col("relation"), F.col("tail"), F.col(f"t_{r}")), 1, 2).alias("k")))
    links = t.select(F.explode(F.array_compact(F.array(*[link(r) for r in sides]))).alias("x")).select("x.side", F.explode("x.k").alias("k")).select("k.scope", "side", *[f"k.{c}" for c in "abcde"])
    return nodes.union(links)


def run_scores(sides: DataFrame, runs: list[str]) -> DataFrame:
    return _run_scores(sides, runs, ["scope", *"abcde"])


def attribute_accuracy(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """Of predicted triples whose ends gold links, how many agree with it in head type, relation and tail type.

    Where gold has several values for a pair of ends the smallest is taken.
    """
    names = ("head_type", "relation", "tail_type")
    want = gold.groupBy("head", "tail").agg(*[F.min(c).alias(f"g_{c}") for c in names])
    m = pred.select(*TRIPLE).distinct().join(want, ["head", "tail"])
    long = m.select(F.explode(F.array(*[F.struct(F.lit(c).alias("attribute"), (F.col(c) == F.col(f"g_{c}")).alias("ok")) for c in names])).alias("x"))
    return long.groupBy("x.attribute").agg(F.count("*").alias("total"), F.count_if("x.ok").alias("correct"), F.round(F.avg(F.col("x.ok").cast("double")), 6).alias("accuracy"))


def compare(scores: DataFrame, keys: list[str], left: str = "zs", right: str = "fs") -> DataFrame:
    """Metric by metric the scores of two runs beside one another with their difference."""
    metrics = ("precision", "recall", "f1")
    long = scores.select("run", *keys, F.explode(F.create_map(*[x for m in metrics for x in (F.lit(m), F.col(m))])).alias("metric", "v"))
    both = long.groupBy(*keys, "metric").agg(*[F.max(F.when(F.col("run") == r, F.col("v"))).alias(r) for r in (left, right)])
    return both.withColumn("delta", F.round(F.col(right) - F.col(left), 6))


# ---------------------------------------------------------------------------------------------------------------------
# Relaxed tiers


def normed(triples: DataFrame) -> DataFrame:
    """Triples of which all five fields are given, with normalised ends, which may come out empty. Names are normalised once each."""
    given = triples.select(*TRIPLE)
    for c in TRIPLE:
        given = given.where(text_or_empty(F.col(c)) != "")
    return given.withColumns({"head": norm_name("head"), "tail": norm_name("tail")})


def _keys_inside(c: str) -> Column:
    """What a text is looked up under if a shorter one may stand in it: its pairs of neighbours and its single characters."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substr(F.col(c), i, F.lit(2)))
    return F.array_union(pairs, F.split(c, ""))


def inside(short: DataFrame, long: DataFrame) -> DataFrame:
    """``x, y``: texts ``x`` of ``short`` that stand in other texts ``y`` of ``long``; empty ones take no part.

    A text stands in another only if all its pairs of neighbours do, so it is looked up under the rarest of them; the other
    side is only spread over pairs that some shorter text has. So no frequent pair gathers all texts, and no two texts
    without it meet.
    """
    x = short.select("x").where("x != ''").distinct()
    y = long.select("y").where("y != ''").distinct()
    own = F.when(F.length("x") == 1, F.array("x")).otherwise(F.filter(_keys_inside("x"), lambda g: F.length(g) == 2))
    asked = x.select("x", F.explode(own).alias("g"))
    spread = y.select("y", F.explode(_keys_inside("y")).alias("g")).join(asked.select("g").distinct(), "g", "left_semi")
    often = spread.groupBy("g").agg(F.count("*").alias("n"))
    rarest = asked.join(often, "g", "left").groupBy("x").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")).alias("k")).where("k.n > 0")
    return rarest.select("x", F.col("k.g").alias("g")).join(spread, "g").where(F.contains("y", "x") & (F.col("x") != F.col("y"))).select("x", "y")


def overlapping(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """``g, p``: names of two sides that are equal, or of which one, of two characters at least, stands in the other."""
    g, p = gold.select("g").where("g != ''").distinct(), pred.select("p").where("p != ''").distinct()
    long = lambda df, c, name: df.where(F.length(c) >= 2).select(F.col(c).alias(name))
    same = g.join(p, F.col("g") == F.col("p")).select("g", "p")
    within = inside(long(g, "g", "x"), long(p, "p", "y")).select(F.col("x").alias("g"), F.col("y").alias("p"))
    around = inside(long(p, "p", "x"), long(g, "g", "y")).select(F.col("y").alias("g"), F.col("x").alias("p"))
    return same.union(within).union(around)


def _reduce(pred: DataFrame, gold: DataFrame, keys: list[str], names: list[str], given: str = "true") -> DataFrame:
    """Counts of gold rows with a close predicted one and of predicted rows without a close gold one: relation and types
    equal, and each of ``names`` (one or two) overlapping. Only rows that ``given`` holds for count; repeated ones count as often
    as they come but are compared once.

    A row that the other side has too is met by it. Only the others are looked for: under the other side's first names close to
    theirs, and there either under the second names close to theirs or among the rows, whichever are fewer. So a frequent
    pair of first names never brings all its rows together.
    """
    scratch = Scratch(pred.sparkSession, "relaxed")
    side = lambda df, a: df.select(*keys, *[F.lit(int(s == a)).alias(f"{s}_n") for s in "pg"])
    both = side(pred, "p").union(side(gold, "g")).groupBy(*keys).agg(F.sum("p_n").alias("p_n"), F.sum("g_n").alias("g_n"))
    m = scratch.cut(both).where(given)  # filters on names are kept from running Python on all that the rows come from
    same = [c for c in keys if c not in names]
    named = " and ".join(f"{c} != ''" for c in names)
    near = {c: scratch.cut(overlapping(m.where("g_n > 0").select(F.col(c).alias("g")), m.where("p_n > 0").select(F.col(c).alias("p")))) for c in names}

    def met(a: str, b: str) -> DataFrame:
        """Rows of side ``a`` that side ``b`` doesn't have but has a close one of."""
        rest = m.where(f"{a}_n > 0 and {b}_n = 0 and {named}").select(*keys, F.col(f"{a}_n").alias("n"))
        other = m.where(f"{b}_n > 0").select(*same, *[F.col(c).alias(f"o_{c}") for c in names])
        close = {c: near[c].select(F.col(a).alias(c), F.col(b).alias(f"o_{c}")) for c in names}
        first, *more = names
        held = other.groupBy(*same, f"o_{first}").agg(F.count("*").alias("rows"))
        hits = rest.join(close[first], first).join(held, [*same, f"o_{first}"])
        for c in more:
            hits = scratch.cut(hits.join(close[c].groupBy(c).agg(F.count("*").alias("around")), c))
            by_name = hits.where("around <= rows").join(close[c], c).join(other, [*same, f"o_{first}", f"o_{c}"], "left_semi")
            by_row = hits.where("around > rows").join(other, [*same, f"o_{first}"]).join(close[c], [c, f"o_{c}"], "left_semi")
            hits = by_name.select(*keys, "n").union(by_row.select(*keys, "n"))
        return hits.select(*keys, "n").distinct()

    def total(df: DataFrame, n: str, kind: str) -> DataFrame:
        return df.agg(F.coalesce(F.sum(n), F.lit(0)).alias("n")).select(F.lit(kind).alias("kind"), "n")
    equal = m.where(f"p_n > 0 and g_n > 0 and {named}").dropna(subset=same)
    parts = [total(m, "g_n", "all_g"), total(m, "p_n", "all_p"), total(equal, "g_n", "hit_g"), total(equal, "p_n", "hit_p"), total(met("g", "p"), "n", "hit_g"), total(met("p", "g"), "n", "hit_p")]
    rows = reduce(DataFrame.union, parts)
    n = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n"))).alias(kind)
    return rows.agg(*[n(k) for k in ("all_g", "all_p", "hit_g", "hit_p")]).select(*score(F.col("hit_g"), F.col("all_p") - F.col("hit_p"), F.col("all_g") - F.col("hit_g")))


def substring_match(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """Relation and types equal, ends inside one another either way; of normalised triples, those with an empty end left out."""
    return _reduce(pred, gold, TRIPLE, ["head", "tail"], "head != '' and tail != ''")


def head_relation_match(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """As ``substring_match``, the tail's name ignored."""
    keys = ["head", "head_type", "relation", "tail_type"]
    return _reduce(pred.select(*keys), gold.select(*keys), keys, ["head"])


def entity_match(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """``tier`` and scores of entities (name, type, description): by normalised names, and by aliases, which of predicted
    entities are also the pieces of their descriptions."""
    given = lambda df: df.where((text_or_empty(F.col("name")) != "") & (text_or_empty(F.col("type")) != ""))
    p, g = given(pred), given(gold)
    normal = lambda df: df.select(norm_name("name").alias("name"), "type")
    alias = lambda df, d: df.select(F.explode(aliases_of(F.col("name"), d)).alias("name"), "type")
    tiers = {"name_norm": (normal(p), normal(g)), "alias": (alias(p, F.col("description")), alias(g, F.lit("")))}
    parts = [strict(a, b, ENTITY).select(F.lit(t).alias("tier"), "*") for t, (a, b) in tiers.items()]
    return parts[0].union(parts[1])


def alias_index(entities: DataFrame, described: bool) -> DataFrame:
    """``alias, type, name, at``: the aliases of each entity; of those described also the pieces of the description."""
    e = entities.where((text_or_empty(F.col("name")) != "") & (text_or_empty(F.col("type")) != ""))
    return e.select(F.explode(aliases_of(F.col("name"), F.col("description") if described else F.lit(""))).alias("alias"), "type", "name", "at")


def alias_match(pred: DataFrame, gold: DataFrame, pred_index: DataFrame, gold_index: DataFrame) -> DataFrame:
    """Counts over triples whose ends are replaced by the smallest name that gold has under their alias.

    An end is looked up by its normalised name and type; without such an entry by the first alias of the own side's
    entities of just that name, of whatever type, that gold knows; else it is its normalised name.
    """
    canon = gold_index.groupBy("alias", "type").agg(F.min("name").alias("canon"))

    def keyed(triples: DataFrame, index: DataFrame) -> DataFrame:
        other = index.join(canon, ["alias", "type"]).groupBy("name").agg(F.min_by("canon", F.struct("at", "alias", "type")).alias("other"))
        out = triples.select(*TRIPLE)
        for c in TRIPLE:
            out = out.where(text_or_empty(F.col(c)) != "")
        for end in ("head", "tail"):
            own = canon.select(F.col("alias").alias("nn"), F.col("type").alias(f"{end}_type"), F.col("canon").alias("own"))
            out = out.withColumn("nn", norm_name(end)).join(own, ["nn", f"{end}_type"], "left").join(other.withColumnRenamed("name", end), end, "left")
            out = out.withColumn(end, F.coalesce("own", "other", "nn")).drop("own", "other", "nn")
        return out

    return strict(keyed(pred, pred_index), keyed(gold, gold_index), TRIPLE)


# ---------------------------------------------------------------------------------------------------------------------
# Judge recall

#: Tiers of candidates, from the one that needs no judge.
TIERS = ("exact_norm", "substring", "token_overlap")


def candidate_tiers(gold: DataFrame, pool: DataFrame, most: int = 10) -> DataFrame:
    """``gold_name, gold_type, tier, name, rank``: of the first tier that has any, the first ``most`` candidates of each gold
    entity among the predicted ones of its type.

    Tiers: equal normalised names; one name inside the other, or the gold name inside a description; shared tokens by
    Jaccard. An empty normalised name is inside every other one. ``gold`` is name, type; ``pool`` name, type, description, at.
    """
    scratch = Scratch(gold.sparkSession, "tiers")
    g = gold.select(F.col("name").alias("gold_name"), F.col("type").alias("gold_type")).where("trim(gold_name) != '' and trim(gold_type) != ''").distinct()
    g = scratch.cut(g.select("*", norm_name("gold_name").alias("gn"), tokens_of("gold_name").alias("gt")))
    said = F.concat_ws(" ", F.coalesce("name", F.lit("")), F.coalesce("description", F.lit("")))
    p = scratch.cut(pool.select("name", F.col("type").alias("gold_type"), "at", norm_name("name").alias("pn"), norm_name("description").alias("pd"), tokens_of(said).alias("pt")))
    key = ["gold_name", "gold_type"]
    found = lambda df, tier, v: df.select(*key, F.lit(tier).alias("tier"), "name", "at", v.alias("score"))
    one = F.lit(1.0)
    a = scratch.cut(found(g.where("gn != ''").join(p.withColumnRenamed("pn", "gn").drop("pd", "pt"), ["gn", "gold_type"]), 1, one))
    rest = scratch.cut(g.join(a.select(*key).distinct(), key, "left_anti"))
    asked = rest.where("gn != ''")
    pairs = (
        inside(asked.select(F.col("gn").alias("x")), p.select(F.col("pn").alias("y"))).select(F.col("x").alias("gn"), F.col("y").alias("pn"), F.lit(None).cast("string").alias("pd"))
        .union(inside(p.select(F.col("pn").alias("x")), asked.select(F.col("gn").alias("y"))).select(F.col("y").alias("gn"), F.col("x").alias("pn"), F.lit(None).cast("string")))
    )
    texts = inside(asked.select(F.col("gn").alias("x")), p.select(F.col("pd").alias("y"))).select(F.col("x").alias("gn"), F.col("y").alias("pd"))
    same = asked.select("gn").distinct().select("gn", F.col("gn").alias("pd"))
    by_name = asked.join(pairs.select("gn", "pn"), "gn").join(p.drop("pd", "pt"), ["pn", "gold_type"])
    by_text = asked.join(texts.union(same), "gn").join(p.drop("pn", "pt"), ["pd", "gold_type"])
    by_none = asked.join(p.where("pn = ''").drop("pn", "pd", "pt"), "gold_type")
    b = scratch.cut(found(by_name, 2, one).union(found(by_text, 2, one)).union(found(by_none, 2, one)).distinct())
    last = rest.join(b.select(*key).distinct(), key, "left_anti")
    shared = last.select(*key, F.size("gt").alias("m"), F.explode("gt").alias("x")).join(p.select("gold_type", "name", "at", F.size("pt").alias("k"), F.explode("pt").alias("x")), ["gold_type", "x"])
    inter = shared.groupBy(*key, "name", "at", "m", "k").agg(F.count("*").alias("n"))
    c = found(inter, 3, F.col("n") / (F.col("m") + F.col("k") - F.col("n")))
    ranked = a.union(b).union(c).withColumn("rank", F.row_number().over(W.partitionBy(*key).orderBy(F.desc("score"), "at"))).where(F.col("rank") <= most)
    names = F.array(*[F.lit(t) for t in TIERS])
    return ranked.select(*key, F.element_at(names, F.col("tier")).alias("tier"), "name", F.col("rank").cast("bigint").alias("rank"))


def judge_recall(gold: DataFrame, align: DataFrame, pred: DataFrame, equivalent: DataFrame) -> DataFrame:
    """Gold triples with ``match_kind``: by equal relation or by one that the judge's table ``gold_relation, pred_relation``
    calls equivalent between aligned ends of some predicted triple, else missed. ``align`` is ``gold_name, gold_type, pred_name``."""
    end = lambda c, p: align.select(F.col("gold_name").alias(c), F.col("gold_type").alias(f"{c}_type"), F.col("pred_name").alias(p)).distinct()
    links = pred.select(F.col("head").alias("ph"), F.col("tail").alias("pt"), F.col("relation").alias("pr")).distinct()
    g = gold.select(*TRIPLE)
    met = g.distinct().join(end("head", "ph"), ["head", "head_type"]).join(end("tail", "pt"), ["tail", "tail_type"]).join(links, ["ph", "pt"])
    same = equivalent.select(F.col("gold_relation").alias("relation"), F.col("pred_relation").alias("pr")).distinct().withColumn("same", F.lit(True))
    judged = met.join(same, ["relation", "pr"], "left")
    best = judged.groupBy(*TRIPLE).agg(F.bool_or(F.col("pr") == F.col("relation")).alias("exact"), F.bool_or(F.coalesce("same", F.lit(False))).alias("judge"))
    kind = F.when(F.col("exact"), "exact_relation").when(F.col("judge"), "relation_judge").otherwise("missed")
    return g.join(best, TRIPLE, "left").select(*TRIPLE, kind.alias("match_kind"))


def recall_summary(judged: DataFrame) -> DataFrame:
    """One row: gold triples, hits of either kind, misses, recall."""
    n = lambda k: F.count_if(F.col("match_kind") == k)
    one = judged.agg(F.count("*").alias("total"), n("exact_relation").alias("exact_relation"), n("relation_judge").alias("relation_judge"), n("missed").alias("missed"))
    return one.withColumn("recall", F.round(F.coalesce(F.try_divide(F.col("total") - F.col("missed"), F.col("total")), F.lit(0.0)), 6))
