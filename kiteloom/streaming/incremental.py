"""Extensions: extraction results merged as they arrive, and request rates over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import merge_entities, valid_entities
from ..sources.files import delete, exists, names

_STATE = "name string, type string, description string, frequency bigint, at struct<f:string,o:bigint,i:bigint>"


def merge_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two sets of merged entities as one: first type, first description that isn't empty, summed frequency. Associative, so
    batches may come in any split."""
    return old.unionByName(new).groupBy("name").agg(
        F.min_by("type", "at").alias("type"),
        F.coalesce(F.min_by("description", F.when(F.col("description") != "", F.col("at"))), F.lit("")).alias("description"),
        F.sum("frequency").alias("frequency"),
        F.min("at").alias("at"),
    )


def stream_entities(spark: SparkSession, raw: DataFrame, state: str, checkpoint: str, every: int = 16) -> StreamingQuery:
    """Merged entities of a stream of raw ones: each batch adds a table of its own, and every so many batches the tables are
    merged into one; ``latest_state`` merges what there is. So a batch costs what it holds, not what came before.

    A batch that runs again after a failure writes its own table again, so nothing counts twice; tables that a merged one covers
    are deleted after it is whole.
    """

    def step(batch: DataFrame, number: int) -> None:
        own = f"{state}/b{number:09d}"
        covered = max((int(n[1:]) for n in _whole(spark, state, "m")), default=-1)
        if number <= covered:  # already in the merged table
            return
        merge_entities(valid_entities(batch)).write.mode("overwrite").parquet(own)
        if number % every == every - 1:
            latest_state(spark, state).write.mode("overwrite").parquet(f"{state}/m{number:09d}")
            for n in names(spark, state):
                if n[0] in "bm" and n != f"m{number:09d}" and int(n[1:]) <= number:
                    delete(spark, f"{state}/{n}")

    return raw.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _whole(spark: SparkSession, state: str, kind: str) -> list[str]:
    return [n for n in names(spark, state) if n.startswith(kind) and exists(spark, f"{state}/{n}/_SUCCESS")]


def latest_state(spark: SparkSession, state: str) -> DataFrame:
    """The merged entities of all batches so far."""
    last = max(_whole(spark, state, "m"), default=None)
    later = [n for n in _whole(spark, state, "b") if last is None or n[1:] > last[1:]]
    parts = [spark.read.parquet(f"{state}/{n}") for n in ([last] if last else []) + later]
    out = spark.createDataFrame([], _STATE)
    for p in parts:
        out = out.unionByName(p)
    return merge_state(out.limit(0), out)


def request_rates(events: DataFrame, width: str = "60 seconds", late: str = "10 minutes") -> DataFrame:
    """Requests and errors by window of event time; later events than ``late`` are left out by the watermark."""
    e = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return e.groupBy(F.window("at", width)).agg(F.count("*").alias("requests"), F.count_if(F.col("event_type") == "error").alias("errors"))
