"""Queries on texts: extraction, the evidence gate, tokens, inventories, pages and Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import token_estimate
from ..models import RuleExtractor
from ..operators import extract as X
from ..operators import markdown as D
from ..session import table
from . import sqlparts as S
from .merging import triples_of


def _gated(spark, sf) -> DataFrame:
    """Triples as a reviewer might return them: the first of each chunk is to be dropped, the second has a span at the start."""
    t = triples_of(spark, sf)
    second = F.col("evidence_id") == "T2"
    t = t.withColumns({"decision": F.when(F.col("evidence_id") == "T1", "drop").otherwise("keep"), "span_start": F.when(second, 0), "span_end": F.when(second, F.length("evidence"))})
    return X.gate(t, table(spark, sf, "chunks"))


def evidence_gate(spark, sf):
    return _gated(spark, sf).select("triple_id", F.coalesce("reason_code", F.lit("KEPT")).alias("reason_code"))


def evidence_span(spark, sf):
    return _gated(spark, sf).where("start is not null").select("triple_id", "start", "end")


def gate_stats(spark, sf):
    return X.gate_stats(_gated(spark, sf))


def parse_model_json(spark, sf):
    """Each raw triple and its ends as a model's fenced reply, parsed and validated again."""
    t = table(spark, sf, "triples_raw")
    item = F.struct(*[F.coalesce(c, F.lit("")).alias(c) for c in ("head", "relation", "tail", "evidence")])
    named = F.array(*[F.struct(F.col(c).alias("name"), F.col("relation").alias("description"), F.lit(" Concept ").alias("type")) for c in ("head", "tail")])
    reply = F.concat(F.lit("Here it is:\n```json\n"), F.to_json(F.struct(named.alias("entities"), F.array(item).alias("triples"))), F.lit("\n```\nDone."))
    got = X.parse_replies(t.select(F.col("triple_id").alias("reply_id"), reply.alias("reply")))
    names = F.array_join(F.transform("entities", lambda x: x["name"]), "|")
    return got.select(F.col("reply_id").alias("triple_id"), "status", names.alias("names"), F.explode("triples").alias("x")).select("triple_id", "status", "names", "x.head", "x.relation", "x.tail", "x.evidence", "x.decision")


def rule_extraction(spark, sf):
    """Extraction of every chunk by sentence patterns, with the evidence checked."""
    got = X.extract_chunks(table(spark, sf, "chunks"), RuleExtractor)
    return got.select("chunk_id", "status", *[F.col(f"stats.{c}").cast("bigint").alias(c) for c in ("proposed_entities", "proposed_triples", "kept_triples", "dropped_triples")])


def token_counts(spark, sf):
    return table(spark, sf, "chunks").select("chunk_id", token_estimate(F.col("content")).cast("bigint").alias("tokens"))


def doc_inventory(spark, sf):
    d = table(spark, sf, "documents")
    return d.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(
        F.count("*").alias("documents"), F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("bigint").alias("characters"),
        F.sum(F.coalesce(F.length(F.regexp_replace("text", r"[\s\p{Z}\x{85}]+", "")), F.lit(0))).cast("bigint").alias("visible"),
        F.sum(token_estimate(F.col("text"))).cast("bigint").alias("tokens"),
    )


def triple_rollup(spark, sf):
    """Triples by the first part of their file's name, and in all."""
    t = table(spark, sf, "triples_raw").select(F.coalesce(F.nullif(F.regexp_extract("file_stem", r"^([^_]+)_", 1), F.lit("")), F.lit(".")).alias("part"), "source_file")
    out = t.rollup("part").agg(F.count("*").alias("triples"), F.count_distinct("source_file").alias("files"), F.grouping("part").alias("g"))
    return out.select(F.when(F.col("g") == 1, F.lit("total")).otherwise(F.col("part")).alias("part"), "triples", "files")


def page_merge(spark, sf):
    return D.merged_books(table(spark, sf, "ocr_pages")).select("book", "pages", F.md5("text").alias("md5"))


def ocr_rollup(spark, sf):
    return D.ocr_rollup(table(spark, sf, "ocr_pages"))


def incremental_skip(spark, sf):
    """Chunks that no triple has been extracted from yet."""
    c = table(spark, sf, "chunks").select("chunk_id", "source_file", F.col("chunk_index").cast("string").alias("chunk_index"))
    return X.not_done(c, table(spark, sf, "triples_raw"), ["source_file", "chunk_index"])


def chunk_pages(spark, sf):
    """Books merged from their pages, cleaned and chunked."""
    return D.chunks_of(D.merged_books(table(spark, sf, "ocr_pages")), "book", "text", mode="complete")


def clean_markdown(spark, sf):
    return table(spark, sf, "chunks").select("chunk_id", D.cleaned("content").alias("x")).select("chunk_id", "x.clean", "x.pages")


def header_tree(spark, sf):
    t = D.header_tree(table(spark, sf, "chunks"), "chunk_id", "content")
    return t.select("chunk_id", *[F.col(c).cast("bigint").alias(c) for c in ("node", "parent", "level")], "title", F.array_join("path", " > ").alias("path"))


def rolling_requests(spark, sf):
    """Requests of a user in the 60 seconds up to each of theirs, errors among them."""
    e = table(spark, sf, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    w = W.partitionBy("user_id").orderBy("us").rangeBetween(-60_000_000, 0)
    return e.select("event_id", F.count("*").over(w).alias("requests"), F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).over(w).cast("bigint").alias("errors"))


QUERIES = {f.__name__: f for f in (evidence_gate, evidence_span, gate_stats, parse_model_json, rule_extraction, token_counts, doc_inventory, triple_rollup, page_merge, ocr_rollup, incremental_skip, chunk_pages, clean_markdown, header_tree, rolling_requests)}

_GATED = f"""WITH {S.T},
c AS (SELECT source_file, chunk_index::VARCHAR AS chunk_index, arg_min(coalesce(content, ''), chunk_id) AS content FROM chunks WHERE source_file IS NOT NULL AND chunk_index IS NOT NULL GROUP BY 1, 2),
x AS (SELECT t.*, coalesce(c.content, '') AS content FROM t LEFT JOIN c USING (source_file, chunk_index)),
g AS MATERIALIZED (SELECT *, CASE WHEN evidence_id = 'T1' THEN 'LOW_CONFIDENCE_DROP' WHEN NOT contains(content, evidence) THEN 'EVIDENCE_NOT_IN_CHUNK' WHEN evidence_id = 'T2' AND strpos(content, evidence) > 1 THEN 'SPAN_MISMATCH' WHEN NOT contains(evidence, head) THEN 'HEAD_NOT_IN_EVIDENCE' WHEN NOT contains(evidence, tail) THEN 'TAIL_NOT_IN_EVIDENCE' END AS reason_code FROM x)
"""
_TOKENS = r"len(regexp_extract_all(coalesce({}, ''), '[\x{{4e00}}-\x{{9fff}}]|[A-Za-z0-9_]+|[^\s]'))"

_LINES = rf"""l AS (SELECT chunk_id, unnest(range(1, len(p) + 1)) AS i, unnest(p) AS x FROM (
  SELECT chunk_id, string_split(regexp_replace(regexp_replace(content, '\A---\n.*?\n---\n', '', 's'), '```icon:[^`]*```', '', 'g'), chr(10)) AS p FROM chunks WHERE content IS NOT NULL)),
c AS (SELECT *, CASE WHEN s = '' THEN 'blank' WHEN regexp_matches(s, '^## Page \d+') THEN 'head' WHEN regexp_matches(s, '^<!--\s*Page\s*\d+\s*-->') THEN 'mark'
  WHEN regexp_matches(s, '^[•·]\s*\d+\s*[•·]$') OR regexp_matches(s, '^(?:第\s*\d+\s*章|运输层|网络层|应用层|[^a-zA-Z]{{2,}})[\s\pZ]+\d+$') THEN 'furniture'
  WHEN {" OR ".join(f"starts_with(s, '{m}')" for m in D.METADATA)} THEN 'meta' ELSE 'text' END AS kind FROM (SELECT *, {S.strip('x')} AS s FROM l)),
d AS (SELECT *, count(*) FILTER (WHERE kind = 'head') OVER (PARTITION BY chunk_id ORDER BY i) AS page, lag(kind) OVER (PARTITION BY chunk_id ORDER BY i) AS before FROM c),
e AS (SELECT *, count(*) FILTER (WHERE kind = 'text') OVER (PARTITION BY chunk_id, page ORDER BY i) AS texts FROM d),
f AS (SELECT *, kind = 'meta' AND page > 0 AND texts = 0 AS led FROM e),
o AS (SELECT chunk_id, i, led, CASE WHEN kind = 'blank' THEN CASE WHEN before IS DISTINCT FROM 'blank' THEN ltrim(x, ' 　') END WHEN kind = 'head' THEN '<!-- Page ' || regexp_extract(s, '^## Page (\d+)', 1) || ' -->' WHEN kind = 'mark' THEN x
  WHEN kind = 'furniture' OR led THEN NULL WHEN {S.strip(r"regexp_replace(x, '\s*\.{{3,}}\s*\d+', '', 'g')".replace("{{", "{").replace("}}", "}"))} <> '' THEN ltrim(regexp_replace(x, '\s*\.{{3,}}\s*\d+', '', 'g'), ' 　') END AS y FROM f)"""
_HEADS = r"'(?m)^(#{1,6})\s+(.+)$'"

SQL = {
    "clean_markdown": f"""WITH {_LINES}, g AS (SELECT chunk_id, string_agg(y, chr(10) ORDER BY i) AS clean, bool_or(led) AS any_led FROM o GROUP BY chunk_id)
SELECT k.chunk_id, CASE WHEN k.content IS NOT NULL THEN coalesce(clean, '') END AS clean, CASE WHEN coalesce(any_led, false) THEN NULL ELSE '{{}}' END AS pages FROM chunks k LEFT JOIN g USING (chunk_id)""",
    "header_tree": f"""WITH RECURSIVE h AS MATERIALIZED (SELECT chunk_id, node, length(marks) AS level, {S.strip('t')} AS title FROM (
  SELECT chunk_id, unnest(regexp_extract_all(content, {_HEADS}, 1)) AS marks, unnest(regexp_extract_all(content, {_HEADS}, 2)) AS t, unnest(range(0, len(regexp_extract_all(content, {_HEADS})))) AS node FROM chunks WHERE content IS NOT NULL)),
u AS MATERIALIZED (SELECT h.*, coalesce((SELECT max(j.node) FROM h j WHERE j.chunk_id = h.chunk_id AND j.node < h.node AND j.level < h.level), -1) AS parent FROM h),
w(chunk_id, node, path) AS (SELECT chunk_id, node, title FROM u WHERE parent = -1 UNION ALL SELECT u.chunk_id, u.node, w.path || ' > ' || u.title FROM u JOIN w ON u.chunk_id = w.chunk_id AND u.parent = w.node)
SELECT u.chunk_id, node, parent, level, title, path FROM u JOIN w USING (chunk_id, node)
UNION ALL SELECT chunk_id, 0, -1, 0, '', '' FROM chunks WHERE content IS NOT NULL AND len(regexp_extract_all(content, {_HEADS})) = 0""",
    "evidence_gate": _GATED + "SELECT triple_id, coalesce(reason_code, 'KEPT') AS reason_code FROM g",
    "evidence_span": _GATED + "SELECT triple_id, strpos(content, evidence) - 1 AS start, strpos(content, evidence) - 1 + length(evidence) AS \"end\" FROM g WHERE contains(content, evidence)",
    "gate_stats": _GATED + "SELECT source_file, chunk_index, count(*) AS proposed, count(*) FILTER (WHERE reason_code IS NULL) AS kept, count(*) FILTER (WHERE reason_code IS NOT NULL) AS dropped FROM g GROUP BY 1, 2",
    "parse_model_json": f"""WITH {S.T}, r AS (SELECT triple_id, {S.text('head')} AS h, {S.text('tail')} AS x FROM triples_raw)
SELECT triple_id, 'ok' AS status, concat_ws('|', CASE WHEN length(h) BETWEEN 2 AND 30 THEN h END, CASE WHEN length(x) BETWEEN 2 AND 30 THEN x END) AS names, head, relation, tail, evidence, 'keep' AS decision FROM t JOIN r USING (triple_id)""",
    "token_counts": f"SELECT chunk_id, {_TOKENS.format('content')} AS tokens FROM chunks",
    "doc_inventory": rf"""SELECT coalesce(source, '') AS source, count(*) AS documents, sum(coalesce(length(text), 0))::BIGINT AS characters,
  sum(coalesce(length(regexp_replace(text, '[\s\pZ\x{{85}}\x0B]+', '', 'g')), 0))::BIGINT AS visible, sum({_TOKENS.format('text')})::BIGINT AS tokens FROM documents GROUP BY 1""",
    "triple_rollup": """WITH t AS (SELECT coalesce(nullif(regexp_extract(file_stem, '^([^_]+)_', 1), ''), '.') AS part, source_file FROM triples_raw)
SELECT CASE WHEN grouping(part) = 1 THEN 'total' ELSE part END AS part, count(*) AS triples, count(DISTINCT source_file) AS files FROM t GROUP BY ROLLUP (part)""",
    "page_merge": """SELECT book, count(*) AS pages, md5(string_agg('## Page ' || coalesce(page_number, 0) || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY coalesce(page_number, 0), page_id)) AS md5
FROM ocr_pages WHERE book IS NOT NULL AND text IS NOT NULL GROUP BY book""",
    "ocr_rollup": """SELECT coalesce(book, '') AS book, count(*) AS total, count(*) FILTER (WHERE status = 'success') AS succeeded, count(*) FILTER (WHERE status IS DISTINCT FROM 'success') AS failed,
  arg_min(model, page_id) FILTER (WHERE model IS NOT NULL) AS model, arg_max(processed_at, page_id) FILTER (WHERE processed_at IS NOT NULL) AS processed_at FROM ocr_pages GROUP BY 1""",
    "incremental_skip": "SELECT chunk_id, source_file, chunk_index::VARCHAR AS chunk_index FROM chunks c WHERE NOT EXISTS (SELECT 1 FROM triples_raw t WHERE t.source_file = c.source_file AND t.chunk_index = c.chunk_index::VARCHAR)",
    "rolling_requests": """SELECT event_id, count(*) OVER w AS requests, (sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w)::BIGINT AS errors FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW)""",
}
