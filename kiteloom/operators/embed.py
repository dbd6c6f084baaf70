"""Embedding of texts through an injected model, with a cache keyed by model, form, size and text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cache_key
from ..models import Calls, Embedder
from ..session import Scratch
from .merge import embedding_rows
from .resolve import knn_candidates


def embed_missing(rows: DataFrame, cache: DataFrame | None, make: Callable[[], Embedder], model: str, form: str, dims: int, batch: int = 64, text: str = "encoded", calls: Calls | None = None) -> DataFrame:
    """``key, vector`` of texts that the cache (``key, vector``) does not hold; equal texts are sent once.

    A reply of another number of vectors, or of vectors of another size, raises. Write it, then append it to the cache.
    """
    want = rows.where(F.col(text).isNotNull()).select(cache_key(F.col(text), model, form, dims).alias("key"), F.col(text).alias("text")).dropDuplicates(["key"])
    if cache is not None:
        want = want.join(cache.select("key"), "key", "left_anti")

    calls = calls or Calls()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, call = make(), calls.begin()
        for pdf in parts:
            out: list[list[float]] = []
            texts = pdf["text"].tolist()
            for i in range(0, len(texts), batch):
                got = call(lambda i=i: client.embed(texts[i : i + batch]))
                if len(got) != len(texts[i : i + batch]):
                    raise ValueError("the model returned another number of vectors")
                if any(len(v) != dims for v in got):
                    raise ValueError(f"the model returned vectors of another size than {dims}")
                out += got
            yield pd.DataFrame({"key": pdf["key"], "vector": out})

    return want.mapInPandas(run, "key string, vector array<float>")


def with_vectors(rows: DataFrame, cache: DataFrame, model: str, form: str, dims: int, text: str = "encoded") -> DataFrame:
    """Rows with their vectors from the cache."""
    return rows.withColumn("key", cache_key(F.col(text), model, form, dims)).join(cache, "key", "left").drop("key")


def candidates_by(make: Callable[[], Embedder], model: str, dims: int, cache: DataFrame | None = None, threshold: float = 0.78, k: int = 50, max_description: int = 160, structured: bool = True, calls: Calls | None = None) -> Callable[[DataFrame], DataFrame]:
    """A function from merged entities to candidate pairs (left_name, right_name, left_type, right_type, score) of their
    embeddings: of one type, the right one among the left one's k nearest, similar enough. left_name is the smaller one."""

    def find(entities: DataFrame) -> DataFrame:
        scratch = Scratch(entities.sparkSession, "embedding")
        form = "structured" if structured else "plain"
        rows = scratch.cut(embedding_rows(entities, max_description).where("encoded is not null"))
        fresh = scratch.cut(embed_missing(rows, cache, make, model, form, dims, calls=calls))
        known = fresh if cache is None else cache.select("key", "vector").unionByName(fresh)
        v = with_vectors(rows, known, model, form, dims).select(F.xxhash64("name", "type").alias("node_id"), "name", "type", F.col("vector").alias("embedding"))
        v = scratch.cut(v)
        pairs = knn_candidates(v, threshold, k, dim=dims)
        a, b = (v.select(F.col("node_id").alias(f"{s}_id"), F.col("name").alias(f"{s}_n"), "type") for s in ("left", "right"))
        named = pairs.join(a, "left_id").join(b.drop("type"), "right_id")
        return named.select(F.least("left_n", "right_n").alias("left_name"), F.greatest("left_n", "right_n").alias("right_name"), F.col("type").alias("left_type"), F.col("type").alias("right_type"), "score").groupBy("left_name", "right_name", "left_type", "right_type").agg(F.max("score").alias("score"))

    return find
