"""Pieces of the SQL that results are checked against."""

from __future__ import annotations

from ..schema import ALIASES, ENTITY_TYPES, RELATION_TYPES, SUFFIXES


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\pZ\x{{85}}]+|[\s\pZ\x{{85}}]+$', '', 'g')"


def text(x: str) -> str:
    return f"coalesce({strip(x)}, '')"


def _alias(x: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ALIASES.items()) + " END"


def normalize(x: str) -> str:
    s = strip(x)
    bare = f"regexp_replace({s}, '({'|'.join(SUFFIXES)})$', '')"
    return f"coalesce({_alias(s)}, CASE WHEN length({bare}) >= 2 THEN coalesce({_alias(bare)}, CASE WHEN {bare} <> {s} THEN {bare} END) END, {s})"


def compact(x: str) -> str:
    return rf"""lower(regexp_replace({normalize(x)}, '[\s\-_/\\.,，。:：;；()（）\[\]【】{{}}<>《》"''`]+', '', 'g'))"""


def norm_ascii(x: str) -> str:
    return (
        rf"regexp_replace(lower(regexp_replace(coalesce({x}, ''), '[(（][^)）]*[)）]', '', 'g')), "
        rf"""'[\s\x{{3000}}\-_/\\.,;:!?"''`~@#$%^&*+=<>|()\[\]{{}}—–·、，。；：！？「」『』《》【】（）]+', '', 'g')"""
    )


def overlap(a: str, b: str) -> str:
    return f"({a} <> '' AND {b} <> '' AND ({a} = {b} OR (length({a}) >= 2 AND length({b}) >= 2 AND (contains({a}, {b}) OR contains({b}, {a})))))"


def listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def at(row_id: str) -> str:
    return f"{{'f': coalesce(file_stem, ''), 'o': coalesce(ord, 0), 'i': {row_id}}}"


#: Valid entities.
E = f"""e AS MATERIALIZED (
  SELECT * FROM (
    SELECT entity_id, extractor_version, {at('entity_id')} AS pos, {strip('name')} AS name, lower({strip('type')}) AS type,
      {text('description')} AS description, greatest(coalesce(frequency, 1), 1) AS frequency FROM entities_raw WHERE length(name) BETWEEN 2 AND 30)
  WHERE type IN ({listed(ENTITY_TYPES)}) AND name <> '')"""
#: Valid triples.
T = f"""t AS MATERIALIZED (
  SELECT * FROM (
    SELECT triple_id, {at('triple_id')} AS pos, file_stem, source_file, chunk_index, evidence_id, {strip('head')} AS head, lower({strip('relation')}) AS relation,
      {strip('tail')} AS tail, {text('evidence')} AS evidence FROM triples_raw)
  WHERE relation IN ({listed(RELATION_TYPES)}) AND head <> '' AND tail <> '' AND head <> tail)"""


def merged_entities(source: str, name: str) -> str:
    """Merged entities of a table of valid ones."""
    return f"""{name} AS MATERIALIZED (
  SELECT n AS name, arg_min(type, pos) AS type, coalesce(arg_min(description, pos) FILTER (WHERE description <> ''), '') AS description,
    sum(frequency)::BIGINT AS frequency, min(pos) AS pos
  FROM (SELECT *, {normalize('name')} AS n FROM {source}) WHERE length(n) >= 2 GROUP BY n)"""


#: Merged entities, merged triples and typed triples.
ME = merged_entities("e", "me")
MT = f"""mt AS MATERIALIZED (
  SELECT head, relation, tail, sum(n)::BIGINT AS frequency, coalesce(list(evidence ORDER BY pos) FILTER (WHERE evidence <> ''), []) AS evidences, min(pos) AS pos
  FROM (
    SELECT head, relation, tail, evidence, count(*) AS n, min(pos) AS pos
    FROM (SELECT {normalize('head')} AS head, relation, {normalize('tail')} AS tail, evidence, pos FROM t)
    WHERE head <> tail AND head IN (SELECT name FROM me) AND tail IN (SELECT name FROM me)
    GROUP BY ALL)
  GROUP BY head, relation, tail)"""
TT = """tt AS MATERIALIZED (
  SELECT mt.*, coalesce(h.type, '') AS head_type, coalesce(x.type, '') AS tail_type
  FROM mt LEFT JOIN me h ON mt.head = h.name LEFT JOIN me x ON mt.tail = x.name)"""
GRAPH = f"WITH {E},\n{T},\n{ME},\n{MT},\n{TT}\n"
