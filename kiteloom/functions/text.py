"""Column functions on names and texts; all but the Unicode and brace ones stay in the JVM."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..schema import ALIASES, SUFFIXES

_EDGES = r"^[\s\p{Z}\x{85}]+|[\s\p{Z}\x{85}]+$"
#: What does not count when names are compared for strong equality.
_LOOSE = r"""[\s\-_/\\.,，。:：;；()（）\[\]【】{}<>《》"'`]+"""
#: Punctuation and brackets that don't count when names are compared in evaluation.
_NAME_PUNCT = re.compile(r"[\s　\-_/\\.,;:!?\"'`~@#$%^&*+=<>|()\[\]{}—–·、，。；：！？「」『』《》【】（）]+")
_NAME_PAREN = re.compile(r"[\(（][^\)）]*[\)）]")


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, _EDGES, "")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def normalize_name(name: Column, aliases: dict[str, str] | None = None) -> Column:
    """Alias of the stripped name, else alias of it without one suffix, else it without the suffix if two characters are left."""
    table = ALIASES if aliases is None else {**ALIASES, **aliases}
    known = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    s = strip(name)
    bare = F.regexp_replace(s, f"({'|'.join(SUFFIXES)})$", "")
    shorter = F.when(F.length(bare) >= 2, F.coalesce(F.try_element_at(known, bare), F.when(bare != s, bare)))
    return F.coalesce(F.try_element_at(known, s), shorter, s)


def compact_name(name: Column) -> Column:
    return F.lower(F.regexp_replace(normalize_name(name), _LOOSE, ""))


def norm_name_text(s: str | None) -> str:
    if not s:
        return ""
    s = _NAME_PAREN.sub("", unicodedata.normalize("NFKC", s)).lower()
    return _NAME_PUNCT.sub("", s).strip()


@F.pandas_udf(StringType())
def norm_name(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Compatibility form without brackets, punctuation and case; null and blank become empty."""
    for s in parts:
        yield s.map(norm_name_text)


#: What stands between the names in a description.
_PIECES = re.compile(r"[,，;；/、]| or | and |\s+又称\s+|\s+又叫\s+")


def alias_texts(name: str | None, description: str | None) -> list[str]:
    """The normalised name and the normalised pieces of a description that are 2 to 59 characters long, each once."""
    own = norm_name_text(name)
    said = [norm_name_text(x) for x in _PIECES.split(description or "")]
    return list(dict.fromkeys([own] * bool(own) + [x for x in said if 1 < len(x) < 60]))


@F.pandas_udf(ArrayType(StringType()))
def aliases_of(names: pd.Series, descriptions: pd.Series) -> pd.Series:
    return pd.Series([alias_texts(n, d) for n, d in zip(names, descriptions)], dtype=object)


_TOKENS = re.compile(r"[一-鿿]|[a-z0-9]+")


@F.pandas_udf(ArrayType(StringType()))
def tokens_of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Distinct CJK characters and runs of two or more ASCII letters and digits of the compatibility form, in lower case."""
    for s in parts:
        found = [_TOKENS.findall(unicodedata.normalize("NFKC", x or "").lower()) for x in s]
        yield pd.Series([list(dict.fromkeys(t for t in ts if len(t) > 1 or t > "z")) for ts in found], dtype=object)


def names_overlap(a: Column, b: Column) -> Column:
    """Equal, or both of two or more characters and one inside the other; empty names match nothing."""
    inside = F.contains(a, b) | F.contains(b, a)
    return (a != "") & (b != "") & ((a == b) | ((F.length(a) >= 2) & (F.length(b) >= 2) & inside))


def token_estimate(c: Column) -> Column:
    """CJK characters, runs of ASCII letters, digits and underscores, and other signs; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(r"[\x{4e00}-\x{9fff}]|[A-Za-z0-9_]+|[^\s]")), F.lit(0))


def encode_row(name: Column, kind: Column, description: Column, max_description: int = 160, structured: bool = True) -> Column:
    """Text of an entity for embedding; blank fields are left out, a blank name gives null."""
    fields = [(F.lit("实体类型"), text_or_empty(kind)), (F.lit("实体名"), text_or_empty(name)), (F.lit("定义"), F.substring(text_or_empty(description), 1, max_description))]
    said = [F.when(v != "", F.concat(k, F.lit("："), v) if structured else v) for k, v in fields]
    return F.when(text_or_empty(name) != "", F.concat_ws("；" if structured else " | ", *said))


def cache_key(text: Column, model: str, form: str, dims: int) -> Column:
    return F.concat_ws("::", F.lit(model), F.lit(form), F.lit(str(dims)), F.sha1(text))


def clip(c: Column, most: int, mark: str = "…") -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit(mark))).otherwise(c)


def clean_ids(ids: Column) -> Column:
    """Stripped, non-blank, each once, in order of first appearance; null becomes empty."""
    stripped = F.transform(F.coalesce(ids, F.array().cast("array<string>")), strip)
    return F.array_distinct(F.filter(stripped, lambda x: x.isNotNull() & (x != "")))


def has_evidence(evidences: Column, evidence: Column) -> Column:
    many = F.exists(F.coalesce(evidences, F.array().cast("array<string>")), lambda x: text_or_empty(x) != "")
    return many | (text_or_empty(evidence) != "")


def reply_json(reply: Column) -> Column:
    """The JSON part of a model's reply as text: what is fenced, else the whole reply; null if it is not JSON."""
    fenced = F.regexp_extract(reply, r"(?s)```(?:json)?\s*\n(.*?)```", 1)
    body = strip(F.when(fenced != "", fenced).otherwise(reply))
    return F.when(F.try_parse_json(body).isNotNull(), body)


def first_object_text(s: str | None) -> str | None:
    """The first balanced {...} that is JSON, by depth of braces outside of strings; None if there is none."""
    if not s:
        return None
    depth, start, quoted, escaped = 0, -1, False, False
    for i, ch in enumerate(s):
        if quoted:
            escaped, quoted = (not escaped and ch == "\\"), not (ch == '"' and not escaped)
        elif ch == '"' and depth:
            quoted = True
        elif ch == "{":
            start = i if not depth else start
            depth += 1
        elif ch == "}" and depth:
            depth -= 1
            if not depth:
                try:
                    json.loads(s[start : i + 1])
                    return s[start : i + 1]
                except ValueError:
                    start = -1
    return None


@F.pandas_udf(StringType())
def first_object(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(first_object_text)


def cosine(a: Column, b: Column) -> Column:
    """Inner product over norms with a floor of 1e-12, in double precision."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.greatest(F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))), F.lit(1e-12))
    return dot / (norm(a) * norm(b))


def book_stem(path: Column) -> Column:
    stem = F.regexp_replace(F.regexp_replace(path, r"^.*[/\\]", ""), r"\.[^.]+$", "")
    return F.regexp_replace(stem, r"_page_\d+$", "")


def image_page(path: Column) -> Column:
    """The number after _page_, 0 without one."""
    return F.coalesce(F.nullif(F.regexp_extract(path, r"_page_(\d+)", 1), F.lit("")).cast("int"), F.lit(0))


def folder_name(stem: Column) -> Column:
    """A book's name as the name of a folder."""
    safe = strip(F.regexp_replace(stem, r"[/\\\\]", "_"))
    return F.when(safe == "", F.lit("document")).otherwise(safe)


def page_label(n: Column) -> Column:
    return F.format_string("%04d", n)


#: Media types by ending.
_MEDIA = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "webp": "image/webp", "bmp": "image/bmp", "svg": "image/svg+xml", "tif": "image/tiff", "tiff": "image/tiff"}


def media_type(path: Column) -> Column:
    """By the ending of a file's name; image/png if it tells nothing."""
    known = F.create_map(*[F.lit(x) for kv in _MEDIA.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))), F.lit("image/png"))


def data_url(content: Column, path: Column | None = None) -> Column:
    """An image as a URL that holds it."""
    media = F.lit("image/png") if path is None else media_type(path)
    # base64 breaks lines after 76 characters
    return F.concat(F.lit("data:"), media, F.lit(";base64,"), F.regexp_replace(F.base64(content), r"\s", ""))


def parsed_evidences(text: Column) -> Column:
    """The list that JSON text holds; text that is no such list is its only element; null and empty give none."""
    listed = F.try_variant_get(F.try_parse_json(text), "$", "array<string>")
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.coalesce(listed, F.array(text)))


def escape_cell(c: Column) -> Column:
    """For a table cell of Markdown."""
    return F.regexp_replace(F.regexp_replace(c, r"\|", r"\\\\|"), r"\r?\n", " ")
