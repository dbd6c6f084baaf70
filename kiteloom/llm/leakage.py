"""Evaluation texts that leak into training text, by greedy string tiling.

The windows of the evaluation items are hashed as Karp-Rabin hashes run; a document meets an item where the two share a
window (the seed). From the seeds the longest common runs are grown, and they are marked from the longest down so that
they never overlap: a run that a longer tile has cut comes back with what is left of it. The share of an item that its tiles
cover also tells of passages in another order, and may be asked for (``coverage``).
Items up to a bounded size are broadcast and documents read where they lie. Beyond it the seeds are joined: of either side the least
hashes of neighbouring windows, at least one of which lies in every shared run; documents without a seed of any item are left
where they are, and only pairs that share one are tiled.
"""

from __future__ import annotations

import heapq
import re
import unicodedata as ud
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch

#: Least length of a shared run, in words for items in English and in letters and digits for Chinese ones.
LEAST = {"en": 13, "zh": 25}
#: Characters of item text that are broadcast.
BLOCK_CHARS = 4_000_000
#: Bits of the filter of seeds, where items are more.
FILTER_BITS = 1 << 26

_BASE = np.uint64(0x9E3779B97F4A7C15)
_RUN = re.compile(r"[^\W_]+")


def _flat(text: str) -> str:
    """Lower case, one width, without characters that do not show."""
    if not text.isascii():
        text = ud.normalize("NFKC", text)
        text = "".join(c for c in text if c.isalnum() or c.isspace() or not _hidden(c))
    return text.lower()


def _hidden(c: str) -> bool:
    return ud.category(c) in ("Cf", "Mn", "Me") or c in "ᅟᅠㅤ"


class Stream:
    """The tokens of one text, by the words or by the letters and digits of the text, as 64-bit numbers."""

    _known: dict[str, int] = {}

    @classmethod
    def words(cls, flat: str) -> np.ndarray:
        known = cls._known
        if len(known) > 500_000:
            known.clear()
        out = []
        for w in _RUN.findall(flat):
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh64_intdigest(w)
            out.append(h)
        return np.array(out, dtype=np.uint64)

    @staticmethod
    def letters(flat: str) -> np.ndarray:
        s = "".join(_RUN.findall(flat))
        return (np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)


def running(tokens: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of n tokens, modulo 2**64; by doubling, so in about 2 log n passes."""
    if len(tokens) < n:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out, power, done = None, tokens, 0  # power: hashes of windows of a power of two
        size, base, k = 1, _BASE, n
        while k:
            if k & 1:
                m = len(tokens) - (done + size) + 1
                part = power[done : done + m]
                out = part.copy() if out is None else out[:m] * base + part
                done += size
            k >>= 1
            if k:
                m = len(tokens) - 2 * size + 1
                power = power[:m] * base + power[size : size + m]
                size, base = 2 * size, base * base
    return out


class Items:
    """Items of one language: their tokens, and where each window stands."""

    def __init__(self, rows: list[tuple[int, str]], lang: str):
        self.n, self.read = LEAST[lang], Stream.words if lang == "en" else Stream.letters
        self.tokens = {i: self.read(_flat(t)) for i, t in rows}
        self.at: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i, tok in self.tokens.items():
            for p, h in enumerate(running(tok, self.n).tolist()):
                self.at[h].append((i, p))
        self.sorted = np.array(sorted(self.at), dtype=np.uint64)

    def hits(self, tokens: np.ndarray) -> np.ndarray:
        """Positions of windows that some item holds too."""
        h = running(tokens, self.n)
        if not len(h) or not len(self.sorted):
            return np.zeros(0, dtype=np.int64)
        j = np.searchsorted(self.sorted, h)
        j[j == len(self.sorted)] = 0
        return np.flatnonzero(self.sorted[j] == h)

    def tiles(self, tokens: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """Item to (tiles, longest tile, item tokens covered)."""
        positions = self.hits(tokens)
        if not len(positions):
            return {}
        h = running(tokens, self.n)
        diagonals: dict[tuple[int, int], list[int]] = defaultdict(list)
        for p in positions.tolist():
            for i, q in self.at[int(h[p])]:
                if np.array_equal(tokens[p : p + self.n], self.tokens[i][q : q + self.n]):
                    diagonals[i, p - q].append(p)
        matches: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for (i, d), ps in diagonals.items():
            first = last = ps[0]
            for p in [*ps[1:], None]:
                if p is None or p != last + 1:
                    matches[i].append((last - first + self.n, first, first - d))
                    first = p
                last = p
        return {i: self._tiled(found, len(tokens), len(self.tokens[i])) for i, found in matches.items()}

    def _tiled(self, found: list[tuple[int, int, int]], n_doc: int, n_item: int) -> tuple[int, int, int]:
        """(tiles, longest tile, item tokens covered) of matches (length, place in the document, place in the item)."""
        in_doc, in_item = np.zeros(n_doc, bool), np.zeros(n_item, bool)
        count = longest = 0
        heap = [(-length, p, q) for length, p, q in found]
        heapq.heapify(heap)
        while heap:
            size, p, q = heapq.heappop(heap)
            free = ~(in_doc[p : p - size] | in_item[q : q - size])
            if free.all():
                in_doc[p : p - size] = in_item[q : q - size] = True
                count, longest = count + 1, max(longest, -size)
                continue
            # a longer tile has cut it: what is left comes in its turn
            edges = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
            for a, b in edges.reshape(-1, 2).tolist():
                if b - a >= self.n:
                    heapq.heappush(heap, (a - b, p + a, q + a))
        return count, longest, int(in_item.sum())


_OUT = "doc_id bigint, item_id bigint, tiles int, longest int, coverage double"


def language(lang: str | None, text: str) -> str:
    """en or zh as given, whatever its case; else by what most letters of the text are."""
    said = (lang or "").strip().lower()
    if said in LEAST:
        return said
    letters = [c for c in text if c.isalpha()]
    return "zh" if 2 * sum("㐀" <= c <= "鿿" for c in letters) > len(letters) else "en"


def seeds(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hashes of windows a little shorter than n, the least of every few neighbours: two texts that share n tokens in a row
    share one of them."""
    k = max(1, n - 4)
    h = running(tokens, k)
    if len(h) < n - k + 1:
        return np.zeros(0, dtype=np.int64)
    mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(np.lib.stride_tricks.sliding_window_view(mixed, n - k + 1).min(axis=1)).view(np.int64)


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", coverage: float = 0.0) -> DataFrame:
    """``doc_id, item_id, tiles, longest, coverage``: every document and item that share a run of the least length, of which
    the document's tiles cover at least the share ``coverage``.

    coverage is the share of the item's tokens under tiles. Null and empty texts share nothing; repeated documents each
    come out; items with a null id or text take no part; an item of another language than en and zh, or of none, is read as the
    one that most of its letters are of; two items that share a passage are both reported. Texts are read whole.
    """
    base = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text", "lang")
    total = base.agg(F.sum(F.length("text").cast("bigint"))).collect()[0][0] or 0
    docs = documents.where(F.col(text).isNotNull()).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    found = _broadcast(docs, base) if total <= BLOCK_CHARS else _joined(docs, base)
    return found.where(F.col("coverage") >= coverage)


def _broadcast(docs: DataFrame, base: DataFrame) -> DataFrame:
    rows = [(r["item_id"], r["text"], language(r["lang"], r["text"])) for r in base.collect()]  # BLOCK_CHARS characters at most
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = [Items([(i, t) for i, t, l in shared.value if l == lang], lang) for lang in LEAST]
        for pdf in parts:
            out = []
            for d, t in zip(pdf["doc_id"], pdf["text"]):
                flat = _flat(t)
                for s in sets:
                    if s.tokens:
                        for i, (n, longest, covered) in s.tiles(s.read(flat)).items():
                            out.append((d, i, n, longest, covered / len(s.tokens[i])))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "tiles", "longest", "coverage"])

    return docs.mapInPandas(search, _OUT)


def _joined(docs: DataFrame, base: DataFrame) -> DataFrame:
    """For items of any number: documents that hold a seed of some item are written out with their seeds, seeds are joined, and
    each pair is tiled once."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "leakage")
    reads = {"en": Stream.words, "zh": Stream.letters}

    def item_seeds(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for i, t, l in zip(pdf["item_id"], pdf["text"], pdf["lang"]):
                lang = language(l, t)
                out += [(lang, h, i) for h in seeds(reads[lang](_flat(t)), LEAST[lang]).tolist()]
            yield pd.DataFrame(out, columns=["lang", "h", "item_id"])

    asked = scratch.cut(base.mapInPandas(item_seeds, "lang string, h bigint, item_id bigint"))
    # bits of all items' seeds, or-ed part by part: a filter of a fixed size that lets a few others through
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
        for pdf in parts:
            at = pdf["h"].to_numpy().view(np.uint64) % np.uint64(FILTER_BITS)
            np.bitwise_or.at(own, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7))).astype(np.uint8))
        yield pd.DataFrame({"bits": [own.tobytes()]})

    for r in asked.select("h").coalesce(16).mapInPandas(fold, "bits binary").toLocalIterator():
        bits |= np.frombuffer(r["bits"], dtype=np.uint8)
    shared = spark.sparkContext.broadcast(bits)

    def doc_seeds(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shared.value
        for pdf in parts:
            out = []
            for d, t in zip(pdf["doc_id"], pdf["text"]):
                flat = _flat(t)
                for lang, read in reads.items():
                    h = seeds(read(flat), LEAST[lang])
                    at = h.view(np.uint64) % np.uint64(FILTER_BITS)
                    if len(h := h[(held[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]):
                        out.append((d, t, lang, h.tolist()))
            yield pd.DataFrame(out, columns=["doc_id", "text", "lang", "hs"])

    hits = docs.mapInPandas(doc_seeds, "doc_id bigint, text string, lang string, hs array<bigint>")
    hits = scratch.cut(hits.withColumn("uid", F.monotonically_increasing_id()))
    pairs = hits.select("uid", "lang", F.explode("hs").alias("h")).join(asked, ["lang", "h"]).select("uid", "item_id").distinct()

    def tile(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for d, t, lang, i, x in zip(pdf["doc_id"], pdf["text"], pdf["lang"], pdf["item_id"], pdf["item"]):
                one = Items([(i, x)], lang)
                for _, (n, longest, covered) in one.tiles(one.read(_flat(t))).items():
                    out.append((d, i, n, longest, covered / len(one.tokens[i])))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "tiles", "longest", "coverage"])

    both = pairs.join(hits.drop("hs"), "uid").join(base.select("item_id", F.col("text").alias("item")), "item_id")
    return both.select("doc_id", "text", "lang", "item_id", "item").mapInPandas(tile, _OUT)
