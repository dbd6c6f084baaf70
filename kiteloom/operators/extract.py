"""Extraction: parsing of model replies, the evidence gate, incremental skip, and the operators that call models."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import reply_json, strip
from ..models import Calls, Extractor
from ..schema import ENTITY_TYPES, RELATION_TYPES
from ..session import Scratch


def _said(item: Column, path: str) -> Column:
    return F.coalesce(strip(F.try_variant_get(item, path, "string")), F.lit(""))


def parse_replies(replies: DataFrame, key: str = "reply_id", reply: str = "reply") -> DataFrame:
    """``key, status, entities, triples``: valid items of each reply as arrays of structs.

    A reply that is no JSON object, or whose fields are no lists, is ``failed``; one without JSON is ``empty``. Items that
    aren't objects and items that are not valid are left out.
    """
    v = replies.withColumn("v", F.try_parse_json(reply_json(F.col(reply))))
    v = v.withColumn("shape", F.schema_of_variant("v"))
    ok = F.col("shape").startswith("OBJECT") & ~F.coalesce(F.try_variant_get("v", "$.entities", "string").isNotNull() & F.try_variant_get("v", "$.entities", "array<variant>").isNull(), F.lit(False))
    v = v.withColumn("status", F.when(F.col("v").isNull(), "empty").when(ok, "ok").otherwise("failed"))
    listed = {n: F.coalesce(F.try_variant_get("v", f"$.{n}", "array<variant>"), F.array().cast("array<variant>")) for n in ("entities", "triples")}
    entity = lambda x: F.struct(_said(x, "$.name").alias("name"), F.lower(_said(x, "$.type")).alias("type"), _said(x, "$.description").alias("description"))
    triple = lambda x: F.struct(
        _said(x, "$.head").alias("head"), F.lower(_said(x, "$.relation")).alias("relation"), _said(x, "$.tail").alias("tail"), _said(x, "$.evidence").alias("evidence"),
        F.coalesce(F.nullif(F.lower(_said(x, "$.review.decision")), F.lit("")), F.lit("keep")).alias("decision"),
        F.coalesce(F.nullif(F.upper(_said(x, "$.review.reason_code")), F.lit("")), F.lit("SUPPORTED")).alias("reason_code"), _said(x, "$.review.reason").alias("reason"),
        F.try_variant_get(x, "$.evidence_span.start", "int").alias("span_start"), F.try_variant_get(x, "$.evidence_span.end", "int").alias("span_end"),
    )
    e = F.filter(F.transform(listed["entities"], entity), lambda x: x["type"].isin(*ENTITY_TYPES) & F.length(x["name"]).between(2, 30))
    t = F.filter(F.transform(listed["triples"], triple), lambda x: x["relation"].isin(*RELATION_TYPES) & (x["head"] != "") & (x["tail"] != "") & (x["head"] != x["tail"]))
    return v.select(key, "status", e.alias("entities"), t.alias("triples"))


def span_of(content: Column, evidence: Column) -> tuple[Column, Column]:
    """Start and end of the evidence in the content, in characters, counted from 0; -1 where it is not."""
    start = F.instr(content, evidence) - 1
    return start, start + F.length(evidence)


def why_dropped(t, content: Column, strict: bool = True) -> Column:
    """Null if a triple is kept, else the reason. ``t(name)`` gives its fields: head, tail, evidence, decision, span_start,
    span_end; None for fields it does not have.

    Order: the reviewer's drop, evidence not in the content, a given span that differs, head not in the evidence, tail not in it.
    Empty evidence passes the content and fails at the head.
    """
    reason = F.when(t("decision") == "drop", "LOW_CONFIDENCE_DROP") if t("decision") is not None else F.when(F.lit(False), "")
    if not strict:
        return reason
    ev = t("evidence")
    start, end = span_of(content, ev)
    reason = reason.when(~F.contains(content, ev), "EVIDENCE_NOT_IN_CHUNK")
    if t("span_start") is not None:
        given = t("span_start").isNotNull() | t("span_end").isNotNull()
        reason = reason.when(given & (~t("span_start").eqNullSafe(start) | ~t("span_end").eqNullSafe(end)), "SPAN_MISMATCH")
    return reason.when(~F.contains(ev, t("head")), "HEAD_NOT_IN_EVIDENCE").when(~F.contains(ev, t("tail")), "TAIL_NOT_IN_EVIDENCE")


def gate(triples: DataFrame, chunks: DataFrame, strict: bool = True) -> DataFrame:
    """Triples with ``reason_code``: null if kept, else why dropped; and the span of the evidence in its chunk.

    See ``why_dropped``. A triple whose chunk doesn't exist has no content to be in.
    Triples: source_file, chunk_index, head, tail, evidence; optionally decision, span_start, span_end.
    """
    c = chunks.where("source_file is not null and chunk_index is not null").groupBy("source_file", F.col("chunk_index").cast("string").alias("chunk_index")).agg(F.min_by("content", "chunk_id").alias("content"))
    t = triples.join(c, ["source_file", "chunk_index"], "left").withColumn("content", F.coalesce("content", F.lit("")))
    reason = why_dropped(lambda n: F.col(n) if n in triples.columns else None, F.col("content"), strict)
    start, end = span_of(F.col("content"), F.col("evidence"))
    inside = F.contains("content", F.col("evidence")) & F.lit(strict)
    return t.withColumns({"reason_code": reason, "start": F.when(inside, start.cast("bigint")), "end": F.when(inside, end.cast("bigint"))}).drop("content")


def gate_stats(gated: DataFrame) -> DataFrame:
    """Of each chunk how many triples were proposed, kept and dropped."""
    kept = F.col("reason_code").isNull()
    return gated.groupBy("source_file", "chunk_index").agg(F.count("*").alias("proposed"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"))


def not_done(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work without a result yet; null keys are never done."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


#: Modes of extraction and the key of their prompt.
MODES = {"fs": "fs", "few-shot": "fs", "few_shot": "fs", "default": "fs", "zs": "zs", "zero-shot": "zs", "zero_shot": "zs"}
PROPOSE = (
    "List the entities and relations that the text states, as JSON with entities (name, type, description) and triples "
    f"(head, relation, tail, evidence). Types: {', '.join(ENTITY_TYPES)}. Relations: {', '.join(RELATION_TYPES)}. Evidence is quoted word by word and holds both ends."
)
REVIEW = (
    "Check each triple against the chunk. Answer with JSON: triples, each with head, relation, tail, evidence and review "
    "(decision keep or drop, reason_code, reason)."
)


def prompt_key(mode: str | None) -> str:
    """fs or zs; anything unknown or missing is fs."""
    return MODES.get((mode or "").strip().lower(), "fs")


def prompts_of(config: dict, mode: str | None) -> tuple[str, str]:
    """The prompts to propose and to review with, from extract.prompts, else built in."""
    section = config.get("extract")
    given = section.get("prompts") if isinstance(section, dict) else None
    given, key = given if isinstance(given, dict) else {}, prompt_key(mode)

    def first(names: tuple[str, ...], default: str) -> str:
        return next((given[n].strip() for n in names if isinstance(given.get(n), str) and given[n].strip()), default)

    return first((key, "fs", "few_shot", "default"), PROPOSE), first((f"review_{key}", "review", "review_default"), REVIEW)


def output_folder(mode: str, review: bool, root: str = "data/triples") -> str:
    return f"{root}/raw-{prompt_key(mode)}{'-recheck' if review else ''}"


def propose(chunks: DataFrame, make: Callable[[], Extractor], content: str = "content", prompt: str = PROPOSE, calls: Calls | None = None) -> DataFrame:
    """``chunk_id, status, reply, error``: a model's reply for each chunk; failures are rows, empty chunks are not sent.

    ``make`` is called once a task, so a client lives as long as its task; calls are repeated and paced as ``calls`` says. Write
    the result before it is used twice: model calls under a recomputed lineage would be paid again.
    """
    sent = chunks.where(F.length(strip(F.coalesce(content, F.lit("")))) > 0).select("chunk_id", F.col(content).alias("content"))
    calls = calls or Calls()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, call = make(), calls.begin()
        for pdf in parts:
            rows = []
            for i, text in zip(pdf["chunk_id"], pdf["content"]):
                try:
                    rows.append((i, "success", call(lambda text=text: model.extract(text, prompt)), None))
                except Exception as error:
                    rows.append((i, "failed", None, str(error)[:500]))
            yield pd.DataFrame(rows, columns=["chunk_id", "status", "reply", "error"])

    return sent.mapInPandas(run, "chunk_id bigint, status string, reply string, error string")


@dataclass(frozen=True)
class ExtractOptions:
    mode: str = "fs"
    review: bool = False
    strict: bool = True
    keep_dropped: bool = True
    version: str = "kgextract_v2"
    prompts: tuple[str, str] = (PROPOSE, REVIEW)

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of: {', '.join(sorted(MODES))}")


def extract_chunks(chunks: DataFrame, make: Callable[[], Extractor], options: ExtractOptions | None = None, calls: Calls | None = None) -> DataFrame:
    """One row a chunk: ``chunk_id, source_file, chunk_index, titles, extractor_version, status, error, stats, entities,
    triples, dropped``, as one extraction file holds it.

    Chunks are proposed for, then, with ``review``, their triples are sent again with the chunk; where nothing valid comes back
    the proposed ones hold. What the gate drops is kept with its reason (``keep_dropped``). A chunk whose calls fail or whose
    reply is no object is ``failed`` and has no lists; an empty chunk has empty ones and costs no call.
    """
    o = options or ExtractOptions()
    scratch = Scratch(chunks.sparkSession, "extract")
    base = chunks.select("chunk_id", "source_file", "chunk_index", "titles", F.coalesce("content", F.lit("")).alias("content"))
    replies = scratch.cut(propose(base, make, prompt=o.prompts[0], calls=calls))
    got = parse_replies(replies.where("status = 'success'"), "chunk_id").withColumnRenamed("status", "parsed")
    rows = base.join(replies.drop("reply"), "chunk_id", "left").join(got, "chunk_id", "left")
    rows = rows.withColumn("status", F.when(F.col("status") == "failed", "failed").when(F.col("parsed") == "failed", "failed").otherwise("success"))
    if o.review:
        rows = scratch.cut(rows)
        said = F.transform("triples", lambda x: F.struct(x["head"].alias("head"), x["relation"].alias("relation"), x["tail"].alias("tail"), x["evidence"].alias("evidence")))
        sent = rows.where((F.col("status") == "success") & (F.size("triples") > 0)).select("chunk_id", F.to_json(F.struct(F.col("content").alias("chunk"), said.alias("triples"))).alias("content"))
        second = scratch.cut(propose(sent, make, prompt=o.prompts[1], calls=calls))
        checked = parse_replies(second.where("status = 'success'"), "chunk_id").select("chunk_id", F.col("status").alias("again"), F.col("triples").alias("reviewed"))
        lost = second.where("status = 'failed'").select("chunk_id", F.col("error").alias("late"))
        rows = rows.join(checked, "chunk_id", "left").join(lost, "chunk_id", "left")
        rows = rows.withColumns({
            "triples": F.when(F.size("reviewed") > 0, F.col("reviewed")).otherwise(F.col("triples")), "error": F.coalesce("error", "late"),
            "status": F.when(F.col("late").isNotNull() | (F.col("again") == "failed"), "failed").otherwise(F.col("status")),
        })

    def judged(x: Column) -> Column:
        start, end = span_of(F.col("content"), x["evidence"])
        found = F.contains("content", x["evidence"]) & F.lit(o.strict)
        span = F.when(found, F.struct(start.alias("start"), end.alias("end"))).when(x["span_start"].isNotNull() | x["span_end"].isNotNull(), F.struct(x["span_start"].alias("start"), x["span_end"].alias("end")))
        return F.struct(*[x[c].alias(c) for c in ("head", "relation", "tail", "evidence", "decision", "reason_code", "reason")], span.alias("evidence_span"), why_dropped(lambda n: x[n], F.col("content"), o.strict).alias("why"))

    all_ = F.transform("triples", judged)
    review = lambda d, c, r: F.struct(d.alias("decision"), c.alias("reason_code"), r.alias("reason"))
    item = lambda x: [*[x[c].alias(c) for c in ("head", "relation", "tail", "evidence")], x["evidence_span"].alias("evidence_span")]
    kept = F.transform(F.filter("judged", lambda x: x["why"].isNull()), lambda x: F.struct(*item(x), review(x["decision"], x["reason_code"], x["reason"]).alias("review")))
    out = F.transform(F.filter("judged", lambda x: x["why"].isNotNull()), lambda x: F.struct(F.struct(*item(x)).alias("candidate"), review(F.lit("drop"), x["why"], F.when(x["why"] == "LOW_CONFIDENCE_DROP", x["reason"]).otherwise("")).alias("review")))
    rows = rows.withColumn("judged", all_).withColumns({"triples": kept, "dropped": out})
    none = {c: F.when(F.col("status") == "success", F.coalesce(c, F.array())) for c in ("entities", "triples", "dropped")}
    if not o.keep_dropped:
        none["dropped"] = F.slice(none["dropped"], 1, 0)
    rows = rows.withColumns(none)
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    stats = F.struct(n("entities").alias("proposed_entities"), (n("triples") + n("dropped")).alias("proposed_triples"), n("triples").alias("kept_triples"), n("dropped").alias("dropped_triples"))
    error = F.when(F.col("status") == "failed", F.coalesce("error", F.lit("the reply is no object with lists")))
    return rows.select("chunk_id", "source_file", "chunk_index", "titles", F.lit(o.version).alias("extractor_version"), "status", error.alias("error"), F.when(F.col("status") == "success", stats).alias("stats"), "entities", "triples", "dropped")
