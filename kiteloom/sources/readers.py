"""Readers of the pipeline's files, with declared schemas and a scan order."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import book_stem, has_evidence, image_page, strip
from ..operators.markdown import page_bodies
from ..schema import CHUNK, ENTITY_TYPES, EXTRACTION, GRAPH, RELATION_TYPES
from .files import exists, read_bytes


def list_files(spark: SparkSession, path: str, endings: tuple[str, ...], recursive: bool = True) -> DataFrame:
    """``path, length, modified`` of files with one of the endings, in any case; a missing folder gives no rows.

    Contents are never read: only the listing's columns are selected.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    match = F.lower("path").rlike("(" + "|".join(e.replace(".", r"\.") for e in endings) + ")$")
    return files.select("path", "length", F.col("modificationTime").alias("modified")).where(match)


def input_documents(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """PDF and PowerPoint files with the way each is rendered, sorted by path."""
    kind = F.when(F.lower("path").endswith(".pdf"), "pdf").otherwise("slides")
    return list_files(spark, path, (".pdf", ".ppt", ".pptx"), recursive).withColumn("kind", kind).orderBy("path")


def with_content(spark: SparkSession, listed: DataFrame, path: str, recursive: bool = True) -> DataFrame:
    """Listed files with their contents, which are read for them alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", "content")
    return listed.join(files, "path")


def page_images(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Page images with their book (the folder under ``path``, else the stem without _page_N) and page number."""
    images = list_files(spark, path, (".png",), recursive)
    inside = F.regexp_replace("path", r"^(file:)?/*", "/")
    below = F.regexp_replace(F.substring_index(inside, path.rstrip("/") + "/", -1), r"^/+", "")
    folder = F.when(F.instr(below, "/") > 0, F.substring_index(below, "/", 1))
    return images.select("path", F.coalesce(folder, book_stem(F.col("path"))).alias("book"), image_page(F.col("path")).alias("page")).orderBy("book", "page", "path")


def markdown_files(spark: SparkSession, path: str, recursive: bool = False, glob: str = "*.md") -> DataFrame:
    """``path, book, page, text``: one row a file."""
    files = spark.read.option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", glob).text(path, wholetext=True)
    name = F.col("_metadata.file_path")
    return files.select(name.alias("path"), book_stem(name).alias("book"), image_page(name).alias("page"), F.col("value").alias("text"), F.col("_metadata.file_modification_time").alias("modified"))


def page_markdown(spark: SparkSession, path: str) -> DataFrame:
    """Pages named *_page_N.md of all books below a folder; books without such a file don't appear."""
    return markdown_files(spark, path, recursive=True, glob="*_page_*.md")


def chunk_files(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of JSON files that hold an array of chunks each, with the file and the place in it."""
    files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    items = F.from_json("value", f"array<{CHUNK.simpleString()}>")
    return files.select(F.col("_metadata.file_name").alias("file"), F.posexplode(items).alias("place", "c")).select("file", "place", "c.*")


def loose_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``file, place, content``: chunks of JSON that is a list, or an object with one under chunks, items or data; entries
    are text or objects with content or text."""
    files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    v = F.try_parse_json("value")
    listed = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), *[F.try_variant_get(v, f"$.{k}", "array<variant>") for k in ("chunks", "items", "data")])
    rows = files.select(F.col("_metadata.file_name").alias("file"), F.posexplode(listed).alias("place", "x"))
    field = lambda k: F.try_variant_get("x", f"$.{k}", "string")
    whole = F.when(F.schema_of_variant("x") == "STRING", F.try_variant_get("x", "$", "string"))
    return rows.select("file", "place", F.coalesce(whole, field("content"), field("text"), F.lit("")).alias("content"))


def raw_extractions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Entities and triples of extraction files, one object a file, not recursive. ``ord`` is the place in the file, triples
    have ids ``stem:T1`` and on."""
    files = spark.read.schema(EXTRACTION).option("multiLine", True).option("pathGlobFilter", "*.json").json(path)
    base = files.withColumn("file_stem", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", ""))
    e = base.select("file_stem", F.posexplode("entities").alias("ord", "x")).select("file_stem", F.col("ord").cast("bigint").alias("ord"), "x.name", "x.type", "x.description", F.lit(1).cast("bigint").alias("frequency"))
    t = base.select("file_stem", "source_file", F.col("chunk_index").cast("string").alias("chunk_index"), F.posexplode("triples").alias("ord", "x"))
    t = t.select(
        "file_stem", F.col("ord").cast("bigint").alias("ord"), F.concat_ws(":", "file_stem", F.concat(F.lit("T"), F.col("ord") + 1)).alias("evidence_id"), "source_file", "chunk_index",
        "x.head", "x.relation", "x.tail", "x.evidence", "x.evidence_span", "x.review",
    )
    return e, t


def triple_files(spark: SparkSession, path: str) -> DataFrame:
    """``group, files, entities, triples``: JSON files below a folder by the first part of their path below it ("." for its
    own files), with what they hold; files that are no objects hold nothing."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path, wholetext=True)
    below = F.substring_index(F.regexp_replace(F.col("_metadata.file_path"), r"^(file:)?/*", "/"), path.rstrip("/").removeprefix("file:") + "/", -1)
    v = F.try_parse_json("value")
    n = lambda k: F.coalesce(F.size(F.try_variant_get(v, f"$.{k}", "array<variant>")), F.lit(0))
    rows = files.select(F.when(F.instr(below, "/") > 0, F.substring_index(below, "/", 1)).otherwise(".").alias("group"), n("entities").alias("e"), n("triples").alias("t"))
    return rows.groupBy("group").agg(F.count("*").alias("files"), F.sum("e").alias("entities"), F.sum("t").alias("triples")).orderBy("group")


def raw_file_key(source_file: Column, chunk_index: Column) -> Column:
    """Stem of the extraction file of a chunk."""
    return F.format_string("%s_chunk_%04d", book_stem(source_file), chunk_index)


class PayloadError(ValueError):
    """A graph or gold file that cannot be read, with the reason."""


_FIELDS = {"entities": ("name", "type"), "triples": ("head", "head_type", "relation", "tail", "tail_type")}
_ALLOWED = {"type": ENTITY_TYPES, "head_type": ENTITY_TYPES, "tail_type": ENTITY_TYPES, "relation": RELATION_TYPES}


def _check_item(item, where: str, fields: tuple[str, ...], known: bool) -> None:
    if not isinstance(item, dict):
        raise PayloadError(f"{where} must be an object")
    for field in fields:
        if field not in item:
            raise PayloadError(f"{where} missing required field: {field}")
        value = item[field]
        if not isinstance(value, str):
            raise PayloadError(f"{where}.{field} must be a string")
        if not value.strip():
            raise PayloadError(f"{where}.{field} must not be empty")
        if known and field in _ALLOWED and value.strip() not in _ALLOWED[field]:
            raise PayloadError(f"{where} has invalid {field}: {value.strip()!r}; expected one of: {', '.join(sorted(_ALLOWED[field]))}")
    if not isinstance(item.get("evidence", ""), str):
        raise PayloadError(f"{where} field evidence must be a string")
    said = item.get("evidences", [])
    if not isinstance(said, list):
        raise PayloadError(f"{where} field evidences must be a list")
    for i, x in enumerate(said):
        if not isinstance(x, str):
            raise PayloadError(f"{where}.evidences[{i}] must be a string")


def check_payload(spark: SparkSession, path: str, what: str, known: bool = True, required: tuple[str, ...] = ("triples",)) -> dict:
    """The object in a JSON file; PayloadError if it is missing, not UTF-8, no JSON or no object, or if a field is missing,
    blank, of another kind, or (``known``) a type or relation that there isn't."""
    try:
        payload = json.loads(read_bytes(spark, path).decode("utf-8"))
    except FileNotFoundError:
        raise PayloadError(f"{what} file not found: {path}") from None
    except UnicodeDecodeError:
        raise PayloadError(f"{what} file is not valid UTF-8 text: {path}") from None
    except ValueError as error:
        raise PayloadError(f"{what} file is not valid JSON: {path}: {error}") from None
    if not isinstance(payload, dict):
        raise PayloadError(f"{what} file must contain a JSON object: {path}")
    for name, fields in _FIELDS.items():
        if name not in payload and name in required:
            raise PayloadError(f"{what} missing required field: {name}")
        items = payload.get(name, [])
        if not isinstance(items, list):
            raise PayloadError(f"{what}.{name} must be a list")
        for i, item in enumerate(items):
            _check_item(item, f"{what}.{name}[{i}]", fields, known)
    return payload


def graph_file(spark: SparkSession, path: str, what: str = "graph", known: bool = True) -> tuple[DataFrame, DataFrame]:
    """Entities and triples of a merged graph or gold file, checked, fields stripped; triples have ``evidenced``."""
    check_payload(spark, path, what, known)
    g = spark.read.schema(GRAPH).option("multiLine", True).option("mode", "FAILFAST").json(path)
    e = g.select(F.posexplode("entities").alias("at", "x")).select(strip(F.col("x.name")).alias("name"), strip(F.col("x.type")).alias("type"), F.coalesce("x.description", F.lit("")).alias("description"), F.coalesce("x.frequency", F.lit(1)).alias("frequency"), "at")
    t = g.select(F.posexplode("triples").alias("at", "x")).select("x.*", "at")
    fields = {c: strip(F.col(c)) for c in _FIELDS["triples"]}
    return e, t.withColumns(fields).withColumn("evidenced", has_evidence(F.col("evidences"), F.col("evidence")))


def gold_by_chunk(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """Gold triples with the file stem of their chunk's extraction, those without a source file left out; and how many
    there are in all. The source file is a chunk file, whose ending is dropped."""
    _, t = graph_file(spark, path, "gold", known=False)
    total = t.count()
    source = strip(F.coalesce("source_file", F.lit("")))
    stem = F.regexp_replace(F.regexp_replace(source, r"^.*[/\\\\]", ""), r"\.[^.]+$", "")
    keyed = t.where(source != "").withColumn("file_stem", F.format_string("%s_chunk_%04d", stem, F.coalesce("chunk_index", F.lit(0))))
    return keyed, total


def cached_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page Markdown read as results of an earlier run: ``path, book, page, text, processed_at, duration_seconds, status``.

    The text is the page's body, or all of it where there is no body; the time is the file's; blank files are no results.
    """
    p = page_markdown(spark, path)
    body = page_bodies("text")
    whole = strip(F.col("text"))
    return p.where(whole != "").select(
        "path", "book", "page", F.coalesce(F.nullif(body, F.lit("")), whole).alias("text"), F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("processed_at"),
        F.lit(0.0).alias("duration_seconds"), F.lit("success").alias("status"),
    )


def alignments(spark: SparkSession, path: str) -> DataFrame | None:
    """``gold_name, gold_type, pred_name`` of an earlier alignment; None without one."""
    if not exists(spark, path):
        return None
    a = spark.read.schema("gold_name string, gold_type string, matched_pred_names array<string>").option("multiLine", True).json(path)
    return a.select("gold_name", "gold_type", F.explode("matched_pred_names").alias("pred_name"))


def embedding_cache(spark: SparkSession, path: str, model: str, form: str, dims: int) -> DataFrame | None:
    """``key, vector`` of one signature; None without a cache. Vectors of another size are left out."""
    if not exists(spark, path):
        return None
    c = spark.read.parquet(path)
    return c.where(F.col("key").startswith(f"{model}::{form}::{dims}::") & (F.size("vector") == dims))
