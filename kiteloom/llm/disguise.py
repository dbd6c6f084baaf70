"""Visually identical text with different characters, brought to one form by a compiled longest-match transducer.

The mapping is computed once from Unicode data and a short list of look-alike letters, checked for conflicts, and compiled to
a transducer whose states are grapheme clusters: from a base it goes on over every mark, and over characters that do not show,
as long as they make a longer cluster, and only then writes what the whole cluster stands for. One pass from left to right rewrites
widths, compatibility ideographs and radicals, decomposed accents, invisible characters, spaces and hyphens; letters that
only look Latin are resolved as the pass leaves the word they stand in: a word wholly of another script, and Greek letters
standing alone as symbols, are left as they are. Stretches in which no character can begin a change are copied.
Case, typos, ordinary spaces and quotes, composed accents and traditional Chinese are never touched.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata as ud
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Letters of other scripts with the Latin letter each looks like.
LOOKALIKES = {
    # Cyrillic
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "ё": "ë", "ї": "ï", "Ё": "Ë", "Ї": "Ï",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ѵ": "V", "Ԝ": "W", "Х": "X", "Ү": "Y",
    # Greek
    "α": "a", "ϲ": "c", "ι": "i", "ϳ": "j", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "γ": "y",
    "Α": "A", "Β": "B", "Ϲ": "C", "Ε": "E", "Η": "H", "Ι": "I", "Ϳ": "J", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ζ": "Z",
    # Armenian and Latin extensions
    "օ": "o", "ս": "u", "ց": "g", "հ": "h", "ո": "n", "ı": "i", "ɑ": "a", "ɡ": "g", "ꜱ": "s", "ʏ": "y", "ᴏ": "o", "ᴄ": "c",
}
#: Characters drawn as a hyphen-minus.
HYPHENS = "‐‑‒⁃−﹘﹣－"
#: Characters without a picture that are no format characters by category.
BLANKS = "͏ᅟᅠ឴឵ㅤﾠ"

def _invisible(ch: str) -> bool:
    cp = ord(ch)
    return ud.category(ch) == "Cf" or ch in BLANKS or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF or 0x180B <= cp <= 0x180F


@functools.lru_cache(1)
def mapping() -> dict[str, str]:
    """Source cluster to target, without the look-alikes, which need their word. Raises on a conflict or an open chain."""
    table: dict[str, str] = {}
    composed: list[tuple[str, str]] = []

    def put(src: str, to: str) -> None:
        if table.setdefault(src, to) != to:
            raise ValueError(f"conflict: {src!r} to {table[src]!r} and {to!r}")

    for cp in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF or 0xE000 <= cp <= 0xF8FF:
            continue
        ch = chr(cp)
        cat = ud.category(ch)
        if cat == "Cn":
            continue
        if _invisible(ch):
            put(ch, "")
        elif cat == "Zs":
            put(ch, " ")
        elif ch in HYPHENS:
            put(ch, "-")
        elif ch in LOOKALIKES:
            pass
        elif cat[0] in "LN" or cat == "So" and 0x2E80 <= cp <= 0x2FDF:
            flat = ud.normalize("NFKC", ch)
            # superscripts, fractions and circled digits carry meaning; letters, ideographs, radicals and wide digits do not
            kind = ud.decomposition(ch).split(" ")[0]
            if flat != ch and kind not in ("<super>", "<sub>", "<fraction>", "<circle>", "<square>"):
                put(ch, flat)
        if cat[0] == "L" and len(d := ud.normalize("NFD", ch)) > 1 and ud.normalize("NFC", d) == ch:
            composed.append((d, ch))
    for d, ch in composed:
        put(d, table.get(ch, ch))
        if len(d) > 2 and len(two := ud.normalize("NFC", d[:-1])) == 1:
            put(two + d[-1], table.get(ch, ch))
    for src, to in table.items():
        if any(c in table for c in to):
            raise ValueError(f"{src!r} maps to {to!r}, which is mapped again")
    for src, to in LOOKALIKES.items():
        if src in table or to in table or to in LOOKALIKES or len(to) != 1:
            raise ValueError(f"look-alike {src!r} to {to!r} is mapped in another way too")
    return table


def _class(chars: frozenset[str]) -> str:
    """A character class of a pattern, neighbours as ranges."""
    out: list[list[int]] = []
    for cp in sorted(map(ord, chars)):
        if out and cp == out[-1][1] + 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out) + "]"


def _in_word(ch: str) -> bool:
    """Letters, but ideographs and Hangul, which stand for themselves."""
    return ch.isalnum() and not ch.isdecimal() and not ("⺀" <= ch <= "鿿" or "가" <= ch <= "힣" or "豈" <= ch <= "﫿")


class Transducer:
    """``write``: target of a source character. ``step``: from a cluster (by what it stands for so far) and a mark to the longer
    cluster. ``begins`` finds characters that can begin a change."""

    def __init__(self) -> None:
        table = mapping()
        self.write = {k: v for k, v in table.items() if len(k) == 1}
        self.step: dict[tuple[str, str], str] = {}
        for k, v in table.items():
            if len(k) > 1:  # the longest part before the last mark is a cluster of its own
                self.step[ud.normalize("NFC", k[:-1]), k[-1]] = v
        self.bases = {a for a, _ in self.step}
        self.order = {m: ud.combining(m) for _, m in self.step}
        # a Latin letter may be the strange one in a word of a script that has look-alikes
        scripts = {_script(c) for c in LOOKALIKES} - {"LATIN"}
        theirs = {c for c in map(chr, range(0x370, 0x590)) if _in_word(c) and _script(c) in scripts}
        self.first = frozenset((*self.write, *LOOKALIKES, *self.order, *theirs))
        self.begins = re.compile(_class(self.first))

    def rewrite(self, text: str) -> str:
        if self.first.isdisjoint(text):
            return text
        out: list[str] = []
        at = 0
        while m := self.begins.search(text, at):
            start = m.start()
            while start > at and _in_word(text[start - 1]):  # its word, and the base of a mark
                start -= 1
            out.append(text[at:start])
            at = self._run(text, start, out)
        out.append(text[at:])
        return "".join(out)

    def longest(self, base: str, marks: str) -> tuple[str, str]:
        """The longest cluster that a base and its marks make, and the marks left over. Marks are taken in canonical order; one
        reaches the base only over marks of a lower class."""
        if base not in self.bases:
            return base, marks
        left = ""
        for m in sorted(marks, key=lambda c: self.order.get(c, 0)):
            free = not left or self.order.get(left[-1], 255) < self.order[m]
            if free and (longer := self.step.get((base, m))) is not None:
                base = longer
            else:
                left += m
        return base, left

    def _run(self, text: str, i: int, out: list[str]) -> int:
        """Writes on from position i to where no change can go on; that position."""
        word: list[tuple[str, str]] = []
        base, marks = "", ""

        def end_word() -> None:
            letters = "".join(x for x, _ in word)
            for (x, left), y in zip(word, _resolved(letters)):
                out.extend((y, left) if x == y else self.longest(y, left))
            word.clear()

        def leave() -> None:
            """The cluster is whole."""
            nonlocal base, marks
            whole, left = self.longest(base, marks)
            if base and _in_word(base):
                word.append((whole, left))
            else:
                end_word()
                out.append(whole + left)
            base, marks = "", ""

        while i < len(text):
            c = text[i]
            to = self.write.get(c)
            if to == "":
                pass  # shows nothing; the cluster may go on after it
            elif base and c in self.order:
                marks += c
            elif to is None and not _in_word(c) and c not in self.order:
                break
            else:
                if base:
                    leave()
                for x in (to or c)[:-1]:
                    base = x
                    leave()
                base = (to or c)[-1]
            i += 1
        leave()
        end_word()
        return i


@functools.lru_cache(1)
def _transducer() -> Transducer:
    return Transducer()


def _script(ch: str) -> str:
    return ud.name(ch, "?").split(" ")[0]


def _resolved(word: str) -> str:
    """A word with the letters that only look like those of its script replaced."""
    if word.isascii():
        return word
    scripts = {_script(c) for c in word if c.isalpha()}
    if len(scripts) < 2:
        odd = all(c in LOOKALIKES and _script(c) == "LATIN" for c in word if c.isalpha())
        return "".join(LOOKALIKES.get(c, c) for c in word) if odd else word
    flat = "".join(LOOKALIKES.get(c, c) for c in word)
    if all(_script(c) == "LATIN" for c in flat if c.isalpha()):
        return flat
    # a word of another script with strange letters: follow the script most of its letters belong to
    main = max(sorted(scripts), key=lambda s: sum(_script(c) == s for c in word))
    if main == "LATIN":
        return flat
    back = {v: k for k, v in LOOKALIKES.items() if _script(k) == main}
    return "".join(back.get(LOOKALIKES.get(c, c), c) if _script(c) != main else c for c in word)


def consistent(text: str | None) -> str | None:
    """The one form of a text; null stays null. Texts that look the same come out equal; applying it again changes nothing."""
    if text is None or text.isascii():
        return text
    return _transducer().rewrite(text)


@F.pandas_udf(StringType())
def _consistent(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(consistent, na_action="ignore")


#: Plain ASCII and unified ideographs are in no source cluster, so such values skip the Python worker.
_MAYBE = r"[^\x00-\x7f\x{4e00}-\x{9fff}]"


def consistent_column(c: Column) -> Column:
    """``consistent`` as a column expression, evaluated in Arrow batches."""
    return _consistent(c)


def disguised_values(df: DataFrame, src: str, row_id: str, fields: list[str]) -> DataFrame:
    """``src, row_id, field, value, consistent``: one row per value that isn't in its consistent form.

    Nulls and blank ASCII values are no cases; repeated rows each come out; an empty table gives no rows. Values that can
    hold no source cluster are dropped before the Python worker.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x")
    long = df.select(F.col(row_id).cast("bigint").alias("row_id"), pairs).select("row_id", "x.field", "x.value")
    seen = long.where(F.col("value").rlike(_MAYBE)).withColumn("consistent", _consistent("value"))
    return seen.where("value != consistent").select(F.lit(src).alias("src"), "row_id", "field", "value", "consistent")
