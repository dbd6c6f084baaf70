"""Commands: one for each stage of the pipeline, evaluation, and the run of several stages.

Each takes only --config; everything else is read from its section of ``run``. Models, renderers and readers of images are
named under ``plugins`` (see ``config.plugin``).
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as C
from . import reports
from .functions.text import book_stem, clip, image_page, token_estimate
from .models import settings_of
from .operators import embed, extract, graph, judging
from .operators import evaluate as V
from .operators import markdown as D
from .session import get_spark
from .sources import readers, render, sinks
from .sources.files import exists, write_text

log = logging.getLogger(__name__)


class Stop(Exception):
    """Ends a command with a message and exit code 1."""


def _now() -> str:
    return datetime.now(UTC).isoformat().replace("+00:00", "Z")


def _need(config: dict, name: str):
    made = C.plugin(config, name)
    if made is None:
        raise Stop(f"plugins.{name} must name a module and function")
    return made


def _calls(config: dict, task: str):
    """Attempts and rate of a task's section; the usual ones without such a section."""
    return settings_of(config, task).calls() if config.get(task) else None


def _there(spark: SparkSession, path: str, what: str) -> str:
    if not exists(spark, path):
        raise Stop(f"{what} not found: {path}")
    return path


def _single(run: dict, section: str) -> str | None:
    if run.get("output") and not run.get("input_file"):
        raise Stop(f"run.{section}.output requires run.{section}.input_file")
    return run.get("input_file")


def _report(ok: int, failed: int, what: str) -> int:
    print(f"{what}: {ok} succeeded, {failed} failed")
    return 1 if failed else 0


def pages(spark: SparkSession, config: dict) -> int:
    """Documents to page images; one that fails doesn't end the run."""
    run = config["run"]["pdf_to_png"]
    one = run["input_file"]
    folder = str(Path(one).parent) if one else run["pdf_dir"]
    _there(spark, one or folder, "document" if one else "folder")
    listed = readers.input_documents(spark, folder, bool(run["recursive"]))
    if one:
        listed = listed.where(F.col("path").endswith("/" + Path(one).name))
    if listed.isEmpty():
        print(f"no documents in {folder}")
        return 0
    office, timeout = run["libreoffice"], run["ppt_timeout"]
    convert = lambda source, out: render.slides_to_pdf(source, out, office, timeout)
    done = render.render(readers.with_content(spark, listed, folder, bool(run["recursive"])), _need(config, "renderer"), int(run["dpi"]), convert=convert)
    done = done.persist()
    try:
        sinks.write_files(done, run["image_dir"], "name", "image")
        rows = render.run_summary(done).collect()  # a row a document
    finally:
        done.unpersist()
    for r in rows:
        if r["status"] == "failed":
            print(f"failed: {r['path']} ({r['error']})", file=sys.stderr)
    _report(sum(r["status"] == "success" for r in rows), sum(r["status"] == "failed" for r in rows), "documents")
    return 1 if one and rows[0]["status"] == "failed" else 0


def text(spark: SparkSession, config: dict) -> int:
    """Page images to a Markdown file each; pages with a file that isn't blank are skipped unless forced."""
    run = config["run"]["png_to_text"]
    one = _single(run, "png_to_text")
    folder = str(Path(one).parent) if one else run["image_dir"]
    _there(spark, one or folder, "image" if one else "folder")
    images = readers.page_images(spark, folder, bool(run["recursive"]))
    if one:
        images = images.where(F.col("path").endswith("/" + Path(one).name))
    stem = F.regexp_replace(F.regexp_replace("path", r"^.*/", ""), r"\.[^.]+$", "")
    images = images.withColumn("name", F.concat(book_stem(F.col("path")), F.lit("/"), stem, F.lit(".md")))
    out = run["text_dir"]
    if not run["force_ocr"] and not one and exists(spark, out):
        there = readers.cached_pages(spark, out).select(F.concat(F.col("book"), F.lit("/"), F.regexp_extract("path", r"([^/]+)$", 1)).alias("name"))
        images = images.join(there, "name", "left_anti")
    if images.isEmpty():
        print("no new images")
        return 0
    content = readers.with_content(spark, images, folder).withColumnRenamed("content", "image")
    read = render.read_pages(content.select("path", "image"), _need(config, "reader"), calls=_calls(config, "ocr")).persist()
    try:
        # images of one name in several folders are told apart by their path
        rows = read.join(images, "path").withColumns({"page_number": F.col("page"), "image_path": F.col("path"), "page_id": F.xxhash64("path"), "model": F.lit(config.get("ocr", {}).get("model")).cast("string")})
        md = sinks.ocr_markdown(rows.where("status = 'success'"), "path").join(images.select(F.col("path").alias("book"), "name"), "book")
        if one and run["output"]:
            write_text(spark, run["output"], md.collect()[0]["markdown"])
        else:
            sinks.write_files(md, out, "name", "markdown")
        counts = {r["status"]: r["count"] for r in read.groupBy("status").count().collect()}
        for r in read.where("status = 'failed'").select("path", clip(F.col("error"), 150).alias("error")).toLocalIterator():
            print(f"failed: {r['path']} ({r['error']})", file=sys.stderr)
    finally:
        read.unpersist()
    return _report(counts.get("success", 0), counts.get("failed", 0), "pages")


def combine(spark: SparkSession, config: dict) -> int:
    """Page files of each book's folder to one file a book."""
    run = config["run"]["kg_md_combine"]
    folder = _there(spark, run["markdown_dir"], "folder")
    p = readers.markdown_files(spark, folder, True, run["page_glob"])
    base = F.regexp_replace("path", r"^(file:)?/*", "/")
    book = F.regexp_extract(base, r"([^/]+)/[^/]+$", 1)
    p = p.select(book.alias("book"), "page", "path", D.page_bodies("text").alias("text")).where(F.col("text") != "")
    merged = D.merged_books(p.select("book", F.col("page").alias("page_number"), F.col("path").alias("page_id"), "text"), heads=False)
    n = sinks.write_files(merged.withColumn("name", F.concat("book", F.lit(".md"))), folder, "name", "text")
    print(f"{n} books merged")
    return 0


def chunk(spark: SparkSession, config: dict) -> int:
    """Markdown files to a JSON file of chunks each."""
    run = config["run"]["md_chunk"]
    one = _single(run, "md_chunk")
    _there(spark, one or run["markdown_dir"], "Markdown")
    files = readers.markdown_files(spark, one, False, "*") if one else readers.markdown_files(spark, run["markdown_dir"], bool(run["recursive"]))
    chunks = D.chunks_of(files.select("path", "text"), "path", "text", int(run["max_tokens"]))
    made = sinks.chunk_json(chunks.withColumnRenamed("path", "source_file"))
    if one and run["output"]:
        rows = made.collect()  # one file
        write_text(spark, run["output"], rows[0]["json"] if rows else "[]")
        print(f"chunks written to {run['output']}")
        return 0
    print(f"{sinks.write_files(made, run['chunk_dir'], 'name', 'json')} files chunked to {run['chunk_dir']}")
    return 0


def extraction(spark: SparkSession, config: dict) -> int:
    """Chunk files to a JSON file of entities and triples for each chunk; chunks that have one are skipped."""
    run = config["run"]["kg_extract"]
    try:
        o = extract.ExtractOptions(run["mode"], bool(run["review"]), bool(run["strict_evidence"]), bool(run["keep_dropped"]), run["extractor_version"], extract.prompts_of(config, run["mode"]))
    except ValueError as error:
        raise Stop(f"run.kg_extract.{error}") from None
    out = run["output_dir"] or extract.output_folder(run["mode"], bool(run["review"]))
    chunks = readers.chunk_files(spark, _there(spark, run["input"], "chunks"))
    if chunks.isEmpty():
        raise Stop(f"no chunks in {run['input']}")
    # a chunk's source is the file it was read from
    keyed = chunks.withColumns({"source_file": F.col("file"), "chunk_id": F.xxhash64("file", "place"), "stem": readers.raw_file_key(F.col("file"), F.coalesce("chunk_index", F.lit(0)))})
    if not run["no_skip"] and exists(spark, out):
        done = readers.list_files(spark, out, (".json",), False).select(F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("stem"))
        keyed = keyed.join(done, "stem", "left_anti")
    got = extract.extract_chunks(keyed, _need(config, "extractor"), o, _calls(config, "extract")).persist()
    try:
        n = sinks.write_files(sinks.extraction_json(got), out, "name", "json")
        lost = got.where("status = 'failed'").count()
    finally:
        got.unpersist()
    return _report(n, lost, "chunks")


def merge(spark: SparkSession, config: dict) -> int:
    """Extraction files to one merged graph with its audit."""
    run = config["run"]["kg_merge"]
    e, t = readers.raw_extractions(spark, _there(spark, run["input_dir"], "folder"))
    e = e.withColumn("entity_id", F.col("ord"))
    t = t.withColumns({"triple_id": F.col("ord"), "evidence_id": F.substring_index("evidence_id", ":", -1)})
    emb = run["embedding"] or {}
    check = emb.get("llm_recheck") or {}
    strategy = "none" if not emb.get("enabled") else "recheck" if check.get("enabled") else "direct" if emb.get("direct_merge_without_recheck") else "rules"
    o = judging.MergeOptions(
        strategy, float(emb.get("candidate_threshold", 0.78)), float(emb.get("similarity_threshold", 0.85)), int(check.get("max_pairs", 200)), int(check.get("context_triples_per_entity", 8)),
        bool(check.get("require_supporting_evidence", True)), bool(check.get("allow_merge_with_truncated_context", False)), int(check.get("max_cluster_size", 4)), bool(check.get("require_complete_pairwise_cluster", True)),
    )
    find = judge = None
    if strategy != "none":
        s = settings_of(config, emb.get("task_name", "entity_embed"))
        cache = emb.get("cache_path")
        find = embed.candidates_by(_need(config, "embedder"), s.model, s.embedding_dimensions or int(emb.get("dimensions", 64)), readers.embedding_cache(spark, cache, s.model, "structured", s.embedding_dimensions or 64) if cache else None, o.threshold, int(emb.get("faiss_top_k", 50)), int(emb.get("max_desc_chars", 160)), calls=s.calls())
        judge = _need(config, "judge") if strategy == "recheck" else None
    merged = judging.merge_directory(e, t, find, judge, o, _calls(config, check.get("task_name", "entity_merge_review")))
    sinks.graph_json(spark, merged, run["output"])
    print(f"merged graph written to {run['output']}")
    return 0


def load(spark: SparkSession, config: dict) -> int:
    """A merged graph to the graph's tables."""
    run = config["run"]["kg_neo4j"]
    if not run["import_file"] and not run["stats"]:
        raise Stop("run.kg_neo4j.import_file or run.kg_neo4j.stats must be set")
    target = run["uri"]
    if run["import_file"]:
        e, t = readers.graph_file(spark, _there(spark, run["import_file"], "file"), known=False)
        if run["clear"]:
            sinks.clear_graph(spark, target)
        nodes, tried, written = sinks.import_graph(spark, graph.nodes_of(e), graph.links_of(t), target)
        print(f"imported: {nodes} entities, {tried} relations ({written} with both ends)")
    if run["stats"]:
        n, l = (spark.read.parquet(f"{target}/{x}") for x in ("nodes", "links"))
        print(json.dumps(graph.graph_counts(n, l).collect()[0].asDict(), indent=2))
    return 0


def _pair(spark: SparkSession, run: dict, section: str, known: bool):
    for k in ("pred", "gold"):
        if not run.get(k):
            raise Stop(f"run.{section}.{k} must be set")
    return readers.graph_file(spark, run["pred"], "pred", known), readers.graph_file(spark, run["gold"], "gold", known)


def _out(spark: SparkSession, path: str | None, report: dict) -> None:
    said = json.dumps(report, ensure_ascii=False, indent=2)
    if path:
        write_text(spark, path, said + "\n")
        print(f"report written to {path}")
    else:
        print(said)


def evaluate(spark: SparkSession, config: dict) -> int:
    run = config["run"]["kg_eval"]
    pred, gold = _pair(spark, run, "kg_eval", True)
    report = reports.strict_report(pred, gold, _now(), int(run["top_errors"]), pred_path=run["pred"], gold_path=run["gold"])
    _out(spark, run["output_json"], report)
    if run["output_md"]:
        write_text(spark, run["output_md"], reports.strict_markdown(report))
    return 0


def evaluate_raw(spark: SparkSession, config: dict) -> int:
    """Raw extractions of two kinds of runs against gold triples of known chunks."""
    run = config["run"]["kg_eval_raw"]
    if not run["gold"]:
        raise Stop("run.kg_eval_raw.gold must be set")
    gold, total = readers.gold_by_chunk(spark, run["gold"])
    gold_sides = gold.select(F.lit("gold").alias("side"), *V.TRIPLE)
    found: dict[str, dict] = {}
    for name in ("zs", "fs"):
        folder = run[f"{name}_raw_dir"]
        if not folder:
            continue
        e, t = readers.raw_extractions(spark, _there(spark, folder, "folder"))
        chunks = readers.list_files(spark, folder, (".json",), False).select(F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("file_stem"))
        wanted = gold.select("file_stem").distinct().join(chunks, "file_stem", "left_semi")
        kinds = V.types_by_chunk(e.withColumn("entity_id", F.col("ord")), {name: F.lit(True)})
        typed = V.raw_typed(V.raw_triples(t).join(wanted, "file_stem", "left_semi"), kinds, [name])
        sides = typed.select(F.lit(name).alias("side"), "head", F.col(f"head_{name}").alias("head_type"), "relation", "tail", F.col(f"tail_{name}").alias("tail_type")).union(gold_sides)
        scores = [r.asDict() for r in V.raw_scores(sides, [name]).collect()]
        acc = [r.asDict() for r in V.attribute_accuracy(sides.where(F.col("side") == name), sides.where("side = 'gold'")).collect()]
        n, covered = gold.select("file_stem").distinct().count(), wanted.count()
        meta = {"raw_dir": folder, "gold_path": run["gold"], "evaluated_at": _now(), "gold_total_triples": total, "gold_covered_chunks": n, "chunks_matched_raw": covered, "chunks_missing_raw": n - covered}
        found[name] = reports.raw_report(scores, acc, name, **meta)
    if len(found) == 2:
        found["comparison"] = reports.comparison(found["zs"], found["fs"], _now())
        if run["output_md"]:
            write_text(spark, run["output_md"], reports.comparison_markdown(found["comparison"]))
    if run["output_json"]:
        at = Path(run["output_json"])
        for name, r in found.items():
            _out(spark, str(at.with_name(f"{at.stem}_{name}{at.suffix}")), r)
    else:
        _out(spark, None, found)
    return 0


def evaluate_relaxed(spark: SparkSession, config: dict) -> int:
    run = config["run"]["kg_eval_relaxed"]
    report = reports.relaxed_report(*_pair(spark, run, "kg_eval_relaxed", False))
    print(reports.relaxed_markdown(report, run["name"] or run["pred"]))
    if run["output_json"]:
        _out(spark, run["output_json"], report)
    return 0


def evaluate_judge(spark: SparkSession, config: dict) -> int:
    """Recall of gold triples with ends aligned and relations compared by a judge."""
    run = config["run"]["kg_eval_judge"]
    (pe, pt), (ge, gt) = _pair(spark, run, "kg_eval_judge", False)
    judge = _need(config, "judge")
    align = readers.alignments(spark, run["align_cache"]) if run["align_cache"] else None
    if align is None:
        align = judging.align_entities(V.candidate_tiers(ge, pe), pe, judge, _calls(config, "eval_entity_match")).persist()
        if run["align_cache"]:
            sinks.align_json(spark, align, run["align_cache"])
    count = judging.align_summary(ge, align)
    if run["align_only"]:
        _out(spark, run["output_json"], {"align_count": count.collect()[0].asDict()})
        return 0
    judged = V.judge_recall(gt, align, pt, judging.judge_relations(gt, align, pt, judge, _calls(config, "eval_triple_match")))
    _out(spark, run["output_json"], reports.judge_report(judged, count, pred_path=run["pred"], gold_path=run["gold"]))
    return 0


def inventory(spark: SparkSession, config: dict) -> int:
    """What the data folder holds: files by ending, characters, chunks, tokens, triples by folder."""
    run = config["run"]["inventory"]
    base = run["data_dir"].rstrip("/")

    def files(folder: str, *endings: str) -> int:
        return readers.list_files(spark, f"{base}/{folder}", endings).count()

    counts = {"PDF files": files("pdf", ".pdf"), "Slide files": files("pdf", ".ppt", ".pptx"), "PNG files": files("png", ".png"), "Markdown files": files("markdown", ".md")}
    size = lambda c: F.coalesce(F.sum(c), F.lit(0))
    if counts["Markdown files"]:
        m = readers.markdown_files(spark, f"{base}/markdown", True).agg(size(F.length("text")), size(F.length(F.regexp_replace("text", r"[\s\p{Z}\x{85}]+", "")))).collect()[0]
        counts |= {"Markdown characters": m[0], "Markdown characters but white space": m[1]}
    if files("chunks", ".json"):
        c = readers.loose_chunks(spark, f"{base}/chunks").agg(F.count("*"), size(token_estimate(F.col("content")))).collect()[0]
        counts |= {"Chunk files": files("chunks", ".json"), "Chunks": c[0], "Chunk tokens": c[1]}
    groups = [r.asDict() for r in readers.triple_files(spark, f"{base}/triples").collect()] if files("triples", ".json") else []
    counts |= {"Entities": sum(g["entities"] for g in groups), "Triples": sum(g["triples"] for g in groups)}
    report = reports.inventory_markdown(counts, groups, _now(), base)
    if run["output"]:
        write_text(spark, run["output"], report)
    print(report)
    return 0


#: Stages of the pipeline in their order.
STAGES: dict[str, Callable[[SparkSession, dict], int]] = {"pdftopng": pages, "pngtotext": text, "kgmdcombine": combine, "mdchunk": chunk, "kgextract": extraction, "kgmerge": merge, "kgneo4j": load}
#: Other names of stages.
ALIASES = {"combine": "kgmdcombine", "merge_md": "kgmdcombine", "neo4j": "kgneo4j"}


def stage_name(said: str) -> str:
    name = said.strip().lower().replace("-", "_")
    name = ALIASES.get(name, name)
    if name not in STAGES:
        raise Stop(f"unknown stage {said!r}; expected one of: {', '.join(STAGES)}")
    return name


def selected(first: str | None, last: str | None, no_graph: bool) -> list[str]:
    """Stages from the first to the last; without the graph the merge is the last. Stop if the first comes after the last."""
    order = list(STAGES)
    end = stage_name(last) if last is not None else order[-1]
    if no_graph and end == "kgneo4j":
        end = "kgmerge"
    a, b = order.index(stage_name(first)) if first is not None else 0, order.index(end)
    if a > b:
        raise Stop("from_stage must not be after to_stage")
    return order[a : b + 1]


def pipeline(spark: SparkSession, config: dict) -> int:
    """Stages one after the other; one that fails ends the run with its code."""
    run = config["run"]["pipeline"]
    for name in selected(run["from_stage"], run["to_stage"], bool(run["no_neo4j"])):
        print(f"=== {name} ===", flush=True)
        if done := STAGES[name](spark, config):
            print(f"stage {name!r} exited with {done}", file=sys.stderr)
            return done
    return 0


COMMANDS: dict[str, tuple[Callable[[SparkSession, dict], int], str]] = {
    "run": (pipeline, "Run the pipeline from documents to the graph"),
    "pdftopng": (pages, "Render documents to page images"),
    "pngtotext": (text, "Read page images to Markdown"),
    "kgmdcombine": (combine, "Put the pages of each book together"),
    "mdchunk": (chunk, "Cut Markdown into chunks"),
    "kgextract": (extraction, "Extract entities and triples from chunks"),
    "kgmerge": (merge, "Merge extractions to one graph"),
    "kgneo4j": (load, "Load the merged graph into the graph's tables"),
    "kgeval": (evaluate, "Evaluate a merged graph strictly"),
    "kgevalraw": (evaluate_raw, "Evaluate raw extractions"),
    "kgevalrelaxed": (evaluate_relaxed, "Evaluate a merged graph by relaxed tiers"),
    "kgevaljudge": (evaluate_judge, "Evaluate recall with a judge"),
    "inventory": (inventory, "Report what the data folder holds"),
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="kiteloom", description="From documents to a measured knowledge graph.")
    parser.add_argument("--list", action="store_true", help="show all commands")
    commands = parser.add_subparsers(dest="command")
    for name, (_, what) in COMMANDS.items():
        commands.add_parser(name, help=what, description=what).add_argument("--config", help="YAML file; else config.yaml of the working folder")
    args = parser.parse_args(argv)
    if args.list or not args.command:
        width = max(map(len, COMMANDS))
        print("\n".join(f"{n:<{width}}  {what}" for n, (_, what) in COMMANDS.items()) if args.list else parser.format_help())
        return 0
    try:
        return COMMANDS[args.command][0](spark or get_spark(), C.load(args.config))
    except (Stop, readers.PayloadError, ValueError) as error:
        print(f"Error: {error}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    raise SystemExit(main())
