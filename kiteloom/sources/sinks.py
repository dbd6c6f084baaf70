"""Writers of the pipeline's results, and the reports on one-row results."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import Writer, delete, exists, file_system, write_text
from .readers import raw_file_key


def write_partitioned(df: DataFrame, path: str, by: list[str], form: str = "parquet") -> None:
    """Rows in folders by key; only the folders written to are replaced, so a run can be repeated."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).format(form).save(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, characters beyond ASCII as they are."""
    df.write.mode("overwrite").json(path)


def ocr_markdown(pages: DataFrame, by: str = "book", model: str = "") -> DataFrame:
    """``book, markdown``: pages as Markdown under front matter with counts, the first model named (else ``model``) and the last
    time of processing. by: the column whose value is a document of its own. Durations and token counts that aren't given are left out."""
    ok = F.coalesce(F.col("status") == "success", F.lit(False))
    have = lambda c: F.col(c) if c in pages.columns else F.lit(None).cast("string")
    said = lambda label, v: F.when(v.isNotNull(), F.concat(F.lit(f"**{label}:** "), v.cast("string"), F.lit("  ")))
    code = lambda c: F.concat(F.lit("`"), have(c), F.lit("`"))
    two = lambda c: F.format_string("%.2f", have(c).cast("double"))
    given = lambda c, v: F.when(have(c).isNotNull(), v)
    lost = F.col("status") == "failed"
    body = F.when(ok & (F.coalesce("text", F.lit("")) != ""), F.col("text")).when(lost, "_No text extracted._").otherwise("_Empty page._")
    section = F.concat_ws(
        "\n", F.concat(F.lit("## Page "), F.coalesce("page_number", F.lit(0)).cast("string")), F.lit(""), said("Image", code("image_path")), said("Processed", have("processed_at")),
        said("Duration", given("duration_seconds", F.concat(two("duration_seconds"), F.lit("s")))), said("Model", code("model")), said("Confidence", given("confidence", two("confidence"))),
        said("Prompt Tokens", have("prompt_tokens")), said("Completion Tokens", have("completion_tokens")), said("Total Tokens", have("total_tokens")),
        F.when(lost, said("Status", F.col("status"))), F.when(lost, said("Error", have("error"))), F.lit(""), body,
    )
    p = pages.where(F.col(by).isNotNull()).select(F.col(by).alias("book"), F.coalesce("page_number", F.lit(0)).alias("n"), "page_id", section.alias("s"), ok.alias("ok"), have("model").alias("model"), have("processed_at").alias("processed_at"))
    g = p.groupBy("book").agg(
        F.sort_array(F.collect_list(F.struct("n", "page_id", "s"))).alias("a"), F.count("*").alias("total"), F.count_if("ok").alias("good"),
        F.min_by("model", F.when(F.col("model").isNotNull(), F.struct("n", "page_id"))).alias("model"),
        F.max_by("processed_at", F.when(F.col("processed_at").isNotNull(), F.struct("n", "page_id"))).alias("at"),
    )
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v.cast("string"))
    front = F.concat_ws(
        "\n", F.lit("---"), line("source", F.col("book")), line("pages", F.col("total")), line("successful_pages", F.col("good")), line("failed_pages", F.col("total") - F.col("good")),
        line("ocr_model", F.coalesce("model", F.lit(model))), line("processed_at", F.coalesce("at", F.lit(""))), F.lit("---"), F.lit(""),
    )
    return g.select("book", F.concat_ws("\n", front, F.array_join(F.transform("a", lambda x: x["s"]), "\n\n---\n\n")).alias("markdown"))


def write_files(df: DataFrame, folder: str, name: str, content: str) -> int:
    """One file a row, named by the column ``name`` below a folder that all executors share; the number written.

    Each file is written beside its place and then moved there, so a task that runs again does no harm. Content is text or bytes.
    """
    root = folder.removeprefix("file:")

    def write(parts):
        for pdf in parts:
            for n, text in zip(pdf["name"], pdf["content"]):
                path = Path(root) / n
                path.parent.mkdir(parents=True, exist_ok=True)
                part = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
                part.write_bytes(text.encode("utf-8") if isinstance(text, str) else bytes(text))
                part.replace(path)
            yield pd.DataFrame({"n": [len(pdf)]})

    rows = df.select(F.col(name).alias("name"), F.col(content).alias("content")).where("name is not null and content is not null")
    return rows.mapInPandas(write, "n bigint").agg(F.sum("n")).collect()[0][0] or 0


def chunk_json(chunks: DataFrame, source: str = "source_file") -> DataFrame:
    """``name, json``: the chunks of each source file as one file's array, in their order, fields in theirs. A source file's chunks
    are what one file holds."""
    row = F.struct("chunk_index", F.struct("titles", "content", "token_count", "page_number", "chunk_index", F.col(source).alias("source_file")).alias("c"))
    g = chunks.groupBy(source).agg(F.sort_array(F.collect_list(row)).alias("a"))
    stem = F.regexp_replace(F.regexp_replace(source, r"^.*[/\\\\]", ""), r"\.[^.]+$", "")
    return g.select(F.concat(stem, F.lit(".json")).alias("name"), F.to_json(F.transform("a", lambda x: x["c"]), {"pretty": "true", "ignoreNullFields": "false"}).alias("json"))


def extraction_json(extracted: DataFrame) -> DataFrame:
    """``name, json``: one file a chunk of ``extract_chunks``, with its stats and what was dropped; failed chunks have none."""
    ok = extracted.where("status = 'success'")
    whole = F.struct("chunk_index", "source_file", "titles", "extractor_version", "stats", "entities", "triples", "dropped")
    return ok.select(F.concat(raw_file_key(F.col("source_file"), F.coalesce(F.col("chunk_index").cast("int"), F.lit(0))), F.lit(".json")).alias("name"), F.to_json(whole, {"pretty": "true", "ignoreNullFields": "false"}).alias("json"))


def append_cache(vectors: DataFrame, path: str) -> None:
    vectors.write.mode("append").parquet(path)


def upsert(spark: SparkSession, df: DataFrame, path: str, keys: list[str]) -> None:
    """Rows replace those with equal keys and are added else; repeating it changes nothing.

    The new table is written beside the old one; the old one is set aside, the new one takes its place, and only then the old one
    goes. A crash leaves one of the two whole; ``settle``, which the next upsert begins with, finishes what was begun.
    """
    settle(spark, path)
    fresh = df.dropDuplicates(keys)
    if exists(spark, path):
        fresh = fresh.unionByName(spark.read.parquet(path).join(fresh.select(*keys), keys, "left_anti"), allowMissingColumns=True)
    base = path.rstrip("/")
    fresh.write.mode("overwrite").parquet(f"{base}.new")
    fs, now = file_system(spark, base)
    new, old = file_system(spark, f"{base}.new")[1], file_system(spark, f"{base}.old")[1]
    if fs.exists(now):
        fs.rename(now, old)
    fs.rename(new, now)
    fs.delete(old, True)


def settle(spark: SparkSession, path: str) -> None:
    """After a crash: a table that was set aside comes back if none has taken its place."""
    base = path.rstrip("/")
    fs, now = file_system(spark, base)
    old = file_system(spark, f"{base}.old")[1]
    if fs.exists(old):
        if fs.exists(now):
            fs.delete(old, True)
        else:
            fs.rename(old, now)


def import_graph(spark: SparkSession, nodes: DataFrame, links: DataFrame, path: str) -> tuple[int, int, int]:
    """Upserts nodes by (label, name) and edges by (source, type, target) under a folder; returns nodes, edges attempted,
    and edges written, which have both ends among the nodes."""
    upsert(spark, nodes, f"{path}/nodes", ["label", "name"])
    names = spark.read.parquet(f"{path}/nodes").select("name").distinct()
    held = links.join(names.withColumnRenamed("name", "source"), "source", "left_semi").join(names.withColumnRenamed("name", "target"), "target", "left_semi")
    upsert(spark, held, f"{path}/links", ["source", "type", "target"])
    return nodes.count(), links.count(), held.count()


def clear_graph(spark: SparkSession, path: str) -> None:
    delete(spark, path)


def graph_json(spark: SparkSession, merged, path: str) -> None:
    """A ``Merged`` graph as one JSON file for export: entities, triples, stats and, where there is any, the audit. Rows come
    to the driver one by one; the graph in Parquet has no such limit."""
    plain = lambda r, drop=("at",): json.dumps({k: v for k, v in r.asDict(True).items() if k not in drop}, ensure_ascii=False, default=str)

    def array(f: Writer, df: DataFrame, drop=("at",)) -> None:
        f.write("[")
        for i, r in enumerate(df.toLocalIterator()):
            f.write((",\n" if i else "\n") + plain(r, drop))
        f.write("]")

    stats: dict = {}
    for r in merged.stats.collect():  # a few rows
        if r["key"]:
            stats.setdefault(r["stat"], {})[r["key"]] = r["n"]
        else:
            stats[r["stat"]] = r["n"]
    summary = merged.summary.collect()[0].asDict()
    with Writer(spark, path) as f:
        f.write('{"entities": ')
        array(f, merged.entities)
        f.write(', "triples": ')
        array(f, merged.triples.select("head", "head_type", "relation", "tail", "tail_type", "frequency", "evidences"))
        f.write(f', "stats": {json.dumps(stats, ensure_ascii=False)}, "merge_audit": {{"summary": {json.dumps(summary)}, "decisions": ')
        array(f, merged.decisions, ("judged",))
        f.write(', "cluster_conflicts": ')
        array(f, merged.cluster_conflicts)
        f.write(', "entity_type_conflicts": ')
        array(f, merged.type_conflicts)
        f.write("}}\n")


def align_json(spark: SparkSession, align: DataFrame, path: str) -> None:
    """An alignment for later runs; gold entities are a bounded set."""
    g = align.groupBy("gold_name", "gold_type").agg(F.sort_array(F.collect_list("pred_name")).alias("matched_pred_names"))
    write_text(spark, path, json.dumps([r.asDict() for r in g.orderBy("gold_name", "gold_type").collect()], ensure_ascii=False, indent=2))
