"""Filling containers of fixed capacity by first-fit decreasing, in randomised groups of documents.

Token counts come from a public tokenizer whose vocabulary file is a parameter. Documents are dealt at random into
groups of about ``group_size``, so each group is packed alone and no task ever holds more than that; within a group
items go, longest first, into the first container with room, found in a tournament tree over the containers' free space
in logarithmic time. An item longer than a container is split into full containers and a rest, which is packed like any
other item; nothing else is ever split.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..session import Scratch

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How the tokenizer cuts a text before pairs are merged.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict[str, object] = {}


def ranks_of(vocabulary: str) -> dict[bytes, int]:
    """The ranks in a vocabulary file, which only the driver needs to reach."""
    with open(vocabulary, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def encoder(vocabulary: str, ranks: dict[bytes, int]):
    """The tokenizer of a vocabulary's ranks, made once a worker."""
    if vocabulary not in _encoders:
        import tiktoken

        _encoders[vocabulary] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[vocabulary]


def token_count(spark: SparkSession, text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a text; null stays null. Strings of special tokens count as ordinary text. The ranks (about a megabyte) are
    broadcast."""
    shared = spark.sparkContext.broadcast(ranks_of(vocabulary))

    @F.pandas_udf(IntegerType())
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(vocabulary, shared.value)
        for s in parts:
            yield pd.Series([None if x is None else len(enc.encode_ordinary(x)) for x in s], dtype="Int32")

    return count(text)


class FirstFit:
    """Free space of containers in a tournament tree: a node holds the most free space below it."""

    def __init__(self, capacity: int, leaves: int):
        self.capacity, self.size = capacity, 1
        while self.size < max(1, leaves):
            self.size *= 2
        self.most = [capacity] * (2 * self.size)

    def put(self, size: int) -> int:
        """The first container with room for the item, counted from 0."""
        most, i = self.most, 1
        if most[1] < size:
            raise ValueError("no container has room")
        while i < self.size:
            i *= 2
            if most[i] < size:
                i += 1
        most[i] -= size
        at = i - self.size
        while i > 1:
            i //= 2
            most[i] = max(most[2 * i], most[2 * i + 1])
        return at


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The container of each item; equal sizes keep their order. Items must not exceed the capacity."""
    fit, out = FirstFit(capacity, len(sizes)), [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        out[k] = fit.put(sizes[k])
    return out


_OUT = "doc_id bigint, piece int, first_token int, n_tokens int, container_id bigint"


def pack(
    documents: DataFrame, capacity: int = 2048, group_size: int = 20_000, seed: int = 7, vocabulary: str = VOCABULARY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, piece, first_token, n_tokens, container_id``: every non-blank document, one row a piece.

    piece counts from 0, first_token is where the piece starts in its document. Null and blank texts (white space and
    characters that do not show) are left out; repeated rows are packed once each, by their own rows; an empty table
    gives no rows. Which group a row falls in depends on the seed, its values and where it lies.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    spark = documents.sparkSession
    scratch = Scratch(spark, "packing")
    shown = F.length(F.regexp_replace(F.col(text), r"(?U)[\s\p{Cf}\p{Mn}\x00-\x1f]+", "")) > 0
    counted = scratch.cut(
        documents.where(shown).select(F.col(doc_id).cast("bigint").alias("doc_id"), token_count(spark, F.col(text), vocabulary).alias("n")).where("n > 0")
    )
    rows = counted.count()
    groups = max(1, -(-rows // group_size))
    # full containers of long documents need no packing; only their rest is an item
    whole = (
        counted.where(F.col("n") > capacity)
        .select("doc_id", "n", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / capacity).cast("int") - 1)).alias("piece"))
        .select("doc_id", "piece", (F.col("piece") * capacity).alias("first_token"), F.lit(capacity).alias("n_tokens"))
    )
    rest = counted.select(
        "doc_id",
        F.when(F.col("n") > capacity, F.floor(F.col("n") / capacity)).otherwise(0).cast("int").alias("piece"),
        F.when(F.col("n") > capacity, F.col("n") % capacity).otherwise(F.col("n")).cast("int").alias("n_tokens"),
    ).where("n_tokens > 0")
    rest = rest.withColumn("first_token", F.col("piece") * capacity)
    # a random number of the row's own, so that copies of one id do not crowd one group
    salt = F.pmod(F.xxhash64("doc_id", "n_tokens", F.lit(seed)) + F.floor(F.rand(seed) * groups).cast("bigint"), F.lit(groups))
    dealt = rest.withColumn("grp", salt)

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        at = first_fit_decreasing(pdf["n_tokens"].tolist(), capacity)
        pdf["container_id"] = pdf["grp"] * (1 << 32) + pd.Series(at, index=pdf.index)
        return pdf[["doc_id", "piece", "first_token", "n_tokens", "container_id"]]

    packed = dealt.groupBy("grp").applyInPandas(fill, _OUT)
    # each full container has a number of its own: negative, from the document and the piece
    alone = whole.select("doc_id", "piece", "first_token", "n_tokens", (-1 - F.monotonically_increasing_id()).cast("bigint").alias("container_id"))
    return packed.union(alone)
