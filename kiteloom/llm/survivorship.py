"""Best representative of each duplicate group, chosen field by field.

A row is ordered by how far its run is trusted, then by currency (the timestamp), then by id. For rows without a
timestamp, ``value_precedence`` learns from the timestamped rows of all groups which value usually follows which
(currency reasoning), ``currency_rank`` turns those precedences into a per-group partial order, and the topologically
latest value may be taken (``nulls="currency"``); ``nulls="oldest"`` puts them last instead.
All steps on rows are grouped aggregates with map-side combine, so a key with a third of all rows never meets in one
task; only the precedences among its distinct values do.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..session import Scratch

#: Runs from the most to the least trusted.
TRUST = ("fs-recheck", "zs-recheck", "fs-nocheck", "zs-nocheck")
#: What is written where there is no description, in lower case without spaces and brackets.
VOID = (
    "n/a", "na", "null", "none", "nil", "nan", "unknown", "undefined", "tbd", "todo", "nodescription", "seeabove", "sameasabove",
    "ditto", "empty", "missing", "placeholder", "notavailable", "notprovided", "无", "暂无", "同上", "无描述", "暂无描述", "未提供", "待补充", "未知", "不详", "略", "空", "见上",
)
#: Distinct values of a key up to which the rules between any two are asked for.
FEW = 16
#: Ends of a sentence.
ENDS = "[.。!！?？]"

_SPACE = r"(?U)[\s\p{Cf}]+"


def trust_rank(version: Column) -> Column:
    """0 for the most trusted run; unknown and null runs come last. Case, spaces and separators don't matter."""
    v = F.regexp_replace(F.lower(version), "[^a-z]", "")
    rank = F.lit(len(TRUST))
    for i, t in reversed(list(enumerate(TRUST))):
        rank = F.when(v == t.replace("-", ""), i).otherwise(rank)
    return F.coalesce(rank, F.lit(len(TRUST)))


def usable_description(text: Column) -> Column:
    """Says something (letters beyond a void word) and ends its sentence; a trailing ellipsis is a cut."""
    bare = F.regexp_replace(F.lower(text), r"(?U)[\s\p{Cf}\p{P}]+", "")
    void = [w for v in VOID for w in {v, v.replace("/", "")}]
    tail = F.regexp_replace(text, r"(?U)[\s\p{Cf}\"'”’」』)）\]】》]+$", "")
    ended = tail.rlike(ENDS + "$") & ~tail.rlike(r"(\.\s*\.|…|。\s*。)$")
    return F.coalesce((F.length(bare) >= 2) & bare.rlike(r"\p{L}") & ~bare.isin(*void) & ended, F.lit(False))


def usable_frequency(freq: Column) -> Column:
    return F.coalesce(freq >= 1, F.lit(False))


def _not_blank(c: Column) -> Column:
    return F.coalesce(F.length(F.regexp_replace(c, _SPACE, "")) > 0, F.lit(False))


def best_rows(rows: DataFrame, nulls: str = "oldest") -> DataFrame:
    """One row per non-null mention_key with two rows or more: the rows that supply description, frequency and canonical name.

    ``mention_key, descr_from, freq_from, canon_from`` are entity_ids, 0 where no row has a usable value. A canonical
    name is usable if it is not blank and equals the name of a row of its group byte for byte; that is found by grouping
    names and canonical names by (key, value), so no list of a group's names is ever built. Rows without entity_id take
    no part; repeated rows of one id count once each for the group's size. nulls: "oldest" or "currency".
    """
    if nulls not in ("oldest", "currency"):
        raise ValueError("nulls must be 'oldest' or 'currency'")
    base = rows.where(F.col("mention_key").isNotNull()).select(
        "mention_key", F.col("entity_id").cast("bigint").alias("id"), F.col("name"), F.col("canonical_name").alias("canon"),
        F.col("description").alias("descr"), F.col("frequency").alias("freq"), trust_rank(F.col("extractor_version")).alias("trust"),
        F.col("extracted_at").cast("timestamp_ntz").alias("at"),
    )
    base = base.withColumn("age", F.coalesce(-F.unix_micros(F.col("at").cast("timestamp")), F.lit((1 << 63) - 1)))
    if nulls == "currency":
        base = base.join(currency_rank(rows).select("mention_key", F.col("canonical_name").alias("canon"), "currency"), ["mention_key", "canon"], "left")
        base = base.withColumn("late", F.when(F.col("at").isNull(), -F.coalesce("currency", F.lit(0.0))).otherwise(F.lit(0.0)))
    else:
        base = base.withColumn("late", F.lit(0.0))
    order = F.struct("trust", "age", "late", "id")
    ok = F.col("id").isNotNull()
    fields = base.groupBy("mention_key").agg(
        F.count("*").alias("n"),
        F.min(F.when(ok & usable_description(F.col("descr")), order)).alias("d"),
        F.min(F.when(ok & usable_frequency(F.col("freq")), order)).alias("f"),
    )
    none = F.lit(None).cast("struct<trust:int,age:bigint,late:double,id:bigint>")
    as_name = base.where(F.col("name").isNotNull()).select("mention_key", F.col("name").alias("value"), F.lit(True).alias("named"), none.alias("o"))
    as_canon = base.where(ok & _not_blank(F.col("canon"))).select("mention_key", F.col("canon").alias("value"), F.lit(False).alias("named"), order.alias("o"))
    canon = (
        as_name.union(as_canon)
        .groupBy("mention_key", "value")
        .agg(F.max("named").alias("named"), F.min("o").alias("o"))
        .where(F.col("named") & F.col("o").isNotNull())
        .groupBy("mention_key")
        .agg(F.min("o").alias("c"))
    )
    zero = F.lit(0).cast("bigint")
    return (
        fields.where("n >= 2")
        .join(canon, "mention_key", "left")
        .select(
            "mention_key",
            F.coalesce("d.id", zero).alias("descr_from"),
            F.coalesce("f.id", zero).alias("freq_from"),
            F.coalesce("c.id", zero).alias("canon_from"),
        )
    )


def value_precedence(rows: DataFrame) -> DataFrame:
    """``before, after, support``: how often, over all groups, one canonical name is directly followed by another.

    Learned from timestamped rows only: within a key, rows are put in order of extracted_at and each change from one
    value to the next counts once. The net support of the two directions is kept, so that precedence is a partial order
    as far as the data has one.
    """
    from pyspark.sql import Window as W

    seen = (
        rows.where("mention_key is not null and extracted_at is not null and canonical_name is not null")
        .groupBy("mention_key", "canonical_name", "extracted_at")
        .agg(F.min("entity_id").alias("id"))
    )
    w = W.partitionBy("mention_key").orderBy("extracted_at", "id")
    steps = seen.withColumn("before", F.lag("canonical_name").over(w)).where("before is not null and before != canonical_name")
    a, b = F.col("before"), F.col("canonical_name")
    net = steps.groupBy(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).agg(F.sum(F.when(a < b, 1).otherwise(-1)).alias("net"))
    up = F.col("net") > 0
    return net.where("net != 0").select(
        F.when(up, F.col("x")).otherwise(F.col("y")).alias("before"),
        F.when(up, F.col("y")).otherwise(F.col("x")).alias("after"),
        F.abs("net").cast("bigint").alias("support"),
    )


def latest_ranks(edges: Iterable[tuple[int, str, str]]) -> dict[str, int]:
    """Of (support, before, after) the rank of every value: the most values in a row that come before it.

    Precedences are taken from the strongest to the weakest (equal ones by value); one that would close a cycle is the
    weakest of that cycle and is left out. So a value with a successor that is kept never has the highest rank.
    """
    after: dict[str, list[str]] = defaultdict(list)

    def reaches(a: str, b: str) -> bool:
        seen, todo = {a}, [a]
        while todo:
            if (x := todo.pop()) == b:
                return True
            new = [y for y in after[x] if y not in seen]
            seen.update(new)
            todo += new
        return False

    missing: Counter = Counter()
    for _, a, b in sorted(edges, key=lambda e: (-e[0], e[1], e[2])):
        if not reaches(b, a):
            after[a].append(b)
            missing[b] += 1
    rank = dict.fromkeys(after, 0)
    todo = [x for x in rank if not missing[x]]
    while todo:
        x = todo.pop()
        for y in after[x]:
            rank[y] = max(rank[y], rank[x] + 1)
            missing[y] -= 1
            if not missing[y]:
                todo.append(y)
    return rank


@F.pandas_udf(ArrayType(StructType([StructField("value", StringType()), StructField("rank", IntegerType())])))
def _ranks(lists: pd.Series) -> pd.Series:
    return lists.map(lambda edges: [{"value": v, "rank": r} for v, r in latest_ranks((e["support"], e["before"], e["after"]) for e in edges).items()])


def currency_rank(rows: DataFrame) -> DataFrame:
    """``mention_key, canonical_name, currency``: the value's rank in the order that the learned precedences give among
    the key's own values, by longest path, with cycles broken at their weakest precedence. The topologically latest value
    of a key has the highest; values that no precedence of the key names have 0.

    Only the precedences among one key's distinct values are listed together, never its rows.
    """
    scratch = Scratch(rows.sparkSession, "currency")
    values = scratch.cut(rows.where("mention_key is not null and canonical_name is not null").select("mention_key", "canonical_name").distinct())
    rules = scratch.cut(value_precedence(rows))
    sized = values.groupBy("mention_key").agg(F.count("*").alias("d"))
    # a key of a few values asks for the rules between them; one of many looks its values' rules up, and keeps those between two
    few = values.join(sized.where((F.col("d") > 1) & (F.col("d") <= FEW)), "mention_key").groupBy("mention_key").agg(F.collect_list("canonical_name").alias("vs"))
    pairs = few.select("mention_key", F.explode("vs").alias("before"), "vs").select("mention_key", "before", F.explode("vs").alias("after")).where("before != after")
    many = values.join(sized.where(F.col("d") > FEW).select("mention_key"), "mention_key")
    a, b = many.select("mention_key", F.col("canonical_name").alias("before")), many.select("mention_key", F.col("canonical_name").alias("after"))
    held = pairs.join(rules, ["before", "after"]).select("mention_key", "support", "before", "after").union(a.join(rules, "before").join(b, ["mention_key", "after"]).select("mention_key", "support", "before", "after"))
    ranks = held.groupBy("mention_key").agg(F.collect_list(F.struct("support", "before", "after")).alias("edges")).select("mention_key", F.explode(_ranks("edges")).alias("x"))
    ranked = ranks.select("mention_key", F.col("x.value").alias("canonical_name"), F.col("x.rank").cast("double").alias("currency"))
    return values.join(ranked, ["mention_key", "canonical_name"], "left").fillna(0.0, ["currency"])
