"""Noise in text from scanned pages: running headers, page numbers, words cut at line ends, misrecognised characters.

Counts over the whole corpus come first: words (cut words put together), ideographs in their context, and lines at the
edges of pages. A rare word meets the frequent words it shares character q-grams with in an inverted join; a boosted ranker,
trained on frequent words that are corrupted the way scanners do, decides which of them it stands for, if any, with
the support each confusion has in the corpus among its features. Ideographs are judged by the contexts in which another
one is the rule. Furniture and joins are decided on pairs of lines. The tables that result are far smaller than the text
and are broadcast up to a checked size, and beyond it joined to the texts that need them; every text is then read whole.
"""

from __future__ import annotations

import functools
import re
import unicodedata as ud
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .boost import Boost
from .lines import MOST_PAGES, Lines, cut_features
from .lines import train as train_lines
from .markup import _inline

#: Entries of a table of corrections that are broadcast.
BLOCK = 1_000_000
#: Frequent words on which the ranker of corrections and the classifier of cuts are trained, at most; all words are ranked and looked up.
MOST_WORDS = 3000
#: What scanners take characters for, as (read, meant).
CONFUSIONS = (("c", "e"), ("0", "o"), ("5", "s"), ("1", "l"), ("!", "i"), ("li", "h"), ("ii", "u"), ("9", "g"), ("vv", "w"), ("rn", "m"), ("cl", "d"), ("1", "i"), ("8", "b"), ("6", "b"), ("|", "l"), ("o", "0"), ("nn", "m"), ("tl", "h"), ("f", "t"), ("m", "rn"), ("h", "li"), ("u", "ii"), ("w", "vv"))
HYPHENS = "-­‐‑–¬"
_HYPHENS = frozenset(HYPHENS)

_CJK = re.compile(r"[㐀-鿿]")
_WORD = re.compile(r"[A-Za-zÀ-ɏ0-9!|]*[A-Za-zÀ-ɏ][A-Za-zÀ-ɏ0-9!|]*")
_CUT = re.compile(rf"([A-Za-zÀ-ɏ0-9!|]*[A-Za-zÀ-ɏ0-9!|])[{HYPHENS}]\s*$")
_GOES_ON = re.compile(r"\s*([a-zà-ɏ0-9!|]*[a-zà-ɏ][a-zà-ɏ0-9!|]*)")
_DIGITS = re.compile(r"\d+")
_NO_LETTERS = {i: None for i in range(128) if not chr(i).isalpha()}
_LETTERS = re.compile(r"[^\W\d_㐀-鿿]+")
_COMMENT = re.compile(r"^\s*(?:<!--.*?-->\s*)+")
_ASIDE = re.compile(r"<!--.*?(?:-->|$)|\{\{[^{}]*(?:\}\}|$)|\s+")
_STOP = re.compile(r"[.。!！?？;；:：,，]\s*$")
_ROMAN = re.compile(r"(?=[ivxlc])(?:c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})", re.I)
_NUMBER = re.compile(r"(?:[-–—~•·.*\[(|]\s*)?(?:(?:page|pg\.?|p\.|第)\s*)?([0-9lOoI]{1,5})(?:\s*页)?(?:\s*(?:/|of)\s*[0-9]{1,5})?(?:\s*[-–—~•·*\])|])?", re.I)
_CHAPTER = re.compile(r"(?:chapter\s*[0-9lO]+|第\s*[0-9lO](?:\s*[0-9lO])*\s*章)(?=\s|$|[^\d])", re.I)
_EDGE = re.compile(r"^\s*[0-9]{1,5}\s{2,}|\s{2,}[0-9]{1,5}\s*$|^\s*[0-9]{1,5}\s+(?=[^\W\d])|(?<=[^\W\d])\s+[0-9]{1,5}\s*$")


def _roman(s: str) -> int:
    at = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
    v = [at[c] for c in s.lower()]
    return sum(-a if a < b else a for a, b in zip(v, v[1:] + [0]))


def page_number(line: str) -> int | None:
    """The number of a line that holds nothing but a page's number; None for other lines."""
    if len(line) - line.count(" ") > 32:  # more signs than the patterns have
        return None
    s = " ".join((line if line.isascii() else ud.normalize("NFKC", line)).split())
    if not s:
        return None
    if m := _NUMBER.fullmatch(s):
        digits = m.group(1).translate(str.maketrans("lIOo", "1100"))
        if any(c.isdigit() for c in m.group(1)):
            return int(digits)
    if _ROMAN.fullmatch(s.strip("-–—~•·[]() ")):
        return _roman(s.strip("-–—~•·[]() "))
    return None


def line_key(line: str) -> str:
    """What a running header has in common on all pages: its letters, and the chapter's number, without the page's."""
    s = line if line.isascii() else ud.normalize("NFKC", line)
    chapter = _CHAPTER.search(s)
    s = _EDGE.sub(" ", s).lower()
    letters = s.translate(_NO_LETTERS) if s.isascii() else "".join(c for c in s if c.isalpha())
    return ("".join(re.findall(r"\d", chapter.group())) + "§" if chapter else "") + letters


@functools.lru_cache(200_000)
def _pairs(key: str) -> frozenset[str]:
    """The pairs of neighbours in a key."""
    return frozenset(key[i : i + 2] for i in range(len(key) - 1))


def _alike(a: str, b: str, least: float = 0.86) -> bool:
    """Whether two keys agree in at least this share of their characters, in order. Most that don't are told by their pairs
    of neighbours: characters in agreement in few stretches have nearly as many pairs in common."""
    both = len(a) + len(b)
    agree = -int(-(least * both / 2) // 1)  # characters of either that must agree
    stretches = both - 2 * agree + 1
    if len(_pairs(a) & _pairs(b)) < agree - stretches - (len(a) - 1 - len(_pairs(a))):
        return False
    return SequenceMatcher(None, a, b, autojunk=False).ratio() >= least


def _mask(text: str) -> list[str]:
    """The lines with inline markup taken out, each at its place; lines of code and of formulas, and those that hold nothing
    but comments or templates, are blank."""
    out, fence = [], False
    for line in text.split("\n"):
        s = line.strip()
        if s.startswith(("```", "~~~")) or re.match(r"(?i)</?(?:pre|code)\b", s):
            fence = not fence if s.startswith(("```", "~~~")) else not s.startswith("</")
            out.append("")
        elif fence or s.startswith(("$$", "\\[", "\\begin", "\\end", "\\sum", "{|", "|")) or s.startswith(("<!--", "{{")) and not _ASIDE.sub("", s):
            out.append("")
        elif re.search(r"[<>&\\*_`~\[\]{}'$]", line):
            clean = _inline(_COMMENT.sub("", line)).replace("\n", "")
            out.append(re.sub(r"[*_`~<>\[\]{}\\$]+|''+", "", re.sub(r"\$[^$]*\$", " ", clean)))
        else:
            out.append(line)
    return out


def _follow(lines: list[str], i: int, skip: set[int]) -> int | None:
    """The next line of text after line i, over furniture and blank lines."""
    return next((j for j in range(i + 1, len(lines)) if j not in skip and lines[j].strip()), None)


def _goes_on(lines: list[str], i: int, skip: set[int]) -> tuple[str, int, int, str, int] | None:
    """(first part, where it starts, line of the rest, rest, where that ends) of a word cut at the end of line i."""
    if lines[i].rstrip()[-1:] not in _HYPHENS or not (cut := _CUT.search(lines[i])):
        return None
    j = _follow(lines, i, skip)
    if j is None or not (m := _GOES_ON.match(lines[j])):
        return None
    return cut.group(1).lower(), cut.start(1), j, m.group(1).lower(), m.end()


def _words(lines: list[str], skip: set[int]) -> Iterator[tuple[int, list[str], tuple[str, int, str] | None]]:
    """Of each line of running text its words in lower case, and a word that is cut at its end: (first part, line of the
    rest, rest). The rest is no word of its line."""
    carried: dict[int, int] = {}
    for i, line in enumerate(lines):
        if i in skip or not line:
            continue
        start, cut = carried.pop(i, 0), _goes_on(lines, i, skip)
        if cut:
            carried[cut[2]] = cut[4]
        found = _WORD.findall((line[start : cut[1]] if cut else line[start:] if start else line).lower())
        if "!" in line or "|" in line:
            found = [w if w[0] in "!|" and len(w) > 1 and w[-1] not in "!|" else w.rstrip("!|") for w in found]
        yield i, [w for w in found if len(w) > 1], (cut[0], cut[2], cut[3]) if cut else None


def _runs(lines: list[str], skip: set[int]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Paragraphs of running text without white space, between ^ and $, each run of digits as 0 and of other letters as a;
    with where each line starts in it."""
    now, at = ["^"], []
    size = 1
    for i, line in enumerate(lines):
        if i in skip:
            continue
        if not line or line.isspace():
            if at:
                yield "".join(now) + "$", at
            now, at, size = ["^"], [], 1
            continue
        s = _LETTERS.sub("a", _DIGITS.sub("0", "".join(line.split())))
        at.append((size, i))
        now.append(s)
        size += len(s)
    if at:
        yield "".join(now) + "$", at


def _edges(lines: list[str]) -> list[int]:
    """Positions of the first two and the last two lines that aren't blank."""
    full = [i for i, x in enumerate(lines) if x.strip()]
    return sorted({*full[:2], *full[-2:]})


def _aside(lines: list[str], src: str, titles: list[str]) -> tuple[set[int], set[int], set[int]]:
    """Lines with page numbers, lines at the edges of a page, and all that may be no running text, before the corpus is counted."""
    numbers = {i for i, x in enumerate(lines) if page_number(x) is not None}
    edges = set(_edges([x if i not in numbers else "" for i, x in enumerate(lines)])) if src == "ocr_pages" else set()
    own = {line_key(t) for t in titles if t}
    beside = {j for i in numbers for j in (i - 1, i + 1) if 0 <= j < len(lines)} if src != "ocr_pages" else edges
    skip = numbers | {i for i, x in enumerate(lines) if not _STOP.search(x) and (i in beside or own and line_key(x) in own or _CHAPTER.search(x))}
    return numbers, edges, skip


# ---------------------------------------------------------------------------------------------------------------------
# Counts over all texts


def _counted(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """``what, a, b, c, n, m``: words (a), contexts (a, b, c) and lines (a: book, b: key), counted; texts are
    ``src, row_id, book, page, titles, text``. Each task adds up its own first."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        other: Counter = Counter()
        words: Counter = Counter()
        contexts: Counter = Counter()

        def rows() -> pd.DataFrame:
            out = [(*k, n, other[k]) for k, n in total.items()]
            out += [("word", w, "", "", n, 0) for w, n in words.items()]
            out += [("context", *k, n, 0) for k, n in contexts.items() if "㐀" <= k[1] <= "鿿"]
            for x in (total, other, words, contexts):
                x.clear()
            return pd.DataFrame(out, columns=["what", "a", "b", "c", "n", "m"])

        for pdf in parts:
            for src, book, page, titles, text in zip(pdf["src"], pdf["book"], pdf["page"], pdf["titles"], pdf["text"]):
                lines = _mask(text)
                numbers, edges, skip = _aside(lines, src, titles)
                for i, x in enumerate(lines):
                    if src == "ocr_pages" and i not in numbers and 3 < len(x.strip()) and not _STOP.search(x):
                        k = ("line", book or "", line_key(x), "")
                        total[k] += 1
                        other[k] += i in edges
                        if i in edges and (c := _CHAPTER.search(ud.normalize("NFKC", x))) and page is not None and page == page:
                            total["chapter", book or "", line_key(x).split("§")[0], f"{int(page):07d}"] += 1
                for _, found, cut in _words(lines, skip):
                    words.update(found)
                    if cut:
                        words[cut[0] + cut[2]] += 1
                for run, _ in _runs(lines, skip):
                    contexts.update(zip(run, run[1:], run[2:]))
            if len(total) + len(words) + len(contexts) > 400_000:
                yield rows()
        yield rows()

    raw = texts.mapInPandas(count, "what string, a string, b string, c string, n bigint, m bigint")
    return scratch.cut(raw.groupBy("what", "a", "b", "c").agg(F.sum("n").alias("n"), F.sum("m").alias("m")))


# ---------------------------------------------------------------------------------------------------------------------
# Misread words


def _grams(w: str) -> list[str]:
    s = f"^{w}$"
    return sorted({s[i : i + 2] for i in range(len(s) - 1)})


def _difference(w: str, v: str) -> tuple[str, str]:
    """What is left of two words without what they begin and end with in common."""
    a = 0
    while a < min(len(w), len(v)) and w[a] == v[a]:
        a += 1
    b = 0
    while b < min(len(w), len(v)) - a and w[-1 - b] == v[-1 - b]:
        b += 1
    return w[a : len(w) - b], v[a : len(v) - b]


def _features(w: str, v: str, nw: float, nv: float, support: float, x: str, y: str) -> list[float]:
    """Of a rare word w that may stand for v; x, y is what was read for what, in the place the corpus shows the least."""
    shared = len(set(_grams(w)) & set(_grams(v))) / max(1, len(_grams(w)))
    return [np.log1p(nv) - np.log1p(nw), np.log1p(nw), len(v), shared, len(x), len(y), float(any(not c.isalpha() for c in x)), float((x, y) in CONFUSIONS), np.log1p(support)]


def _ranker(words: dict[str, float], seed: int = 1) -> Boost:
    """Trained on frequent words corrupted by the known confusions against their neighbours among frequent words."""
    rng = np.random.default_rng(seed)
    common = sorted((w for w in words if w.isalpha() and len(w) > 2), key=lambda w: (-words[w], w))[:MOST_WORDS]
    rows, y = [], []
    by_gram = defaultdict(list)
    for w in common:
        for g in _grams(w):
            by_gram[g].append(w)
    for w in common:
        fits = [(x, m) for x, m in CONFUSIONS if m in w]
        near = Counter(v for g in _grams(w) for v in by_gram[g] if v != w and abs(len(v) - len(w)) < 3).most_common(2)
        for x, m in (fits[k] for k in rng.permutation(len(fits))[:4]):
            at = [i for i in range(len(w)) if w.startswith(m, i)]
            i = at[rng.integers(len(at))]
            bad = w[:i] + x + w[i + len(m) :]
            if bad in words:
                continue
            n = max(1.0, words[w] * rng.uniform(0.0005, 0.05))
            rows.append(_features(bad, w, n, words[w], rng.integers(3, 200), *_difference(bad, w)))
            y.append(1)
            for v, _ in near[:1]:
                rows.append(_features(bad, v, n, words[v], rng.integers(0, 3), *_difference(bad, v)))
                y.append(0)
        for v, _ in near:  # two words of the language, one of them rare
            rows.append(_features(w, v, max(1.0, words[w] * rng.uniform(0.001, 1)), words[v], rng.integers(0, 3), *_difference(w, v)))
            y.append(0)
    return Boost().fit(np.array(rows), np.array(y)) if sum(y) > 10 else Boost(0)


def _steps(w: str, v: str, pairs: dict[str, list[tuple[str, str]]], most: int = 3) -> list[tuple[str, str]] | None:
    """The confusions by which v was read as w, at most so many places; None if there are none such. ``pairs`` are listed by
    the first character read."""
    seen: set[tuple[int, int, int]] = set()

    def go(i: int, j: int, left: int) -> list[tuple[str, str]] | None:
        while True:
            if i == len(w) and j == len(v):
                return []
            if (i, j, left) in seen:
                return None
            seen.add((i, j, left))
            if left:
                for x, m in pairs.get(w[i : i + 1], ()):
                    if w.startswith(x, i) and v.startswith(m, j) and (rest := go(i + len(x), j + len(m), left - 1)) is not None:
                        return [(x, m), *rest]
            if i == len(w) or j == len(v) or w[i] != v[j]:
                return None
            i, j = i + 1, j + 1

    return go(0, 0, most) or None


def usable_confusions(support: DataFrame) -> DataFrame:
    """Of ``x, y, support`` the confusions of this corpus: those known, and others that are read for letters and that many
    words show. Ordinary words differ in letters only, so few pairs are left, however many words there are."""
    known = F.struct("x", "y").isin(*(F.struct(F.lit(x), F.lit(y)) for x, y in CONFUSIONS))
    shown = (F.col("support") >= 10) & ~F.col("x").rlike(r"^\p{L}+$") & F.col("y").rlike(r"^\p{L}+$")
    return support.where((F.length("x") <= 2) & (F.length("y") <= 2) & (F.col("support") >= 2) & (known | shown))


def word_corrections(counts: DataFrame, ratio: float = 10.0, least: float = 0.5) -> DataFrame:
    """``word, meant``: rare words and what they stand for. ``counts`` is ``word, n``."""
    spark = counts.sparkSession
    scratch = Scratch(spark, "words")
    whole = F.concat(F.lit("^"), "word", F.lit("$"))
    grams = F.array_sort(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(whole) - 1), lambda i: F.substr(whole, i, F.lit(2)))))
    listed = scratch.cut(counts.select("word", "n", grams.alias("gs")))
    often = listed.where("n >= 5").where(F.col("word").rlike(r"^\p{L}+$")).select(F.col("word").alias("v"), F.col("n").alias("nv"), F.col("gs").alias("gv"))
    # a word meets the words that are ten times as frequent as itself and share at least half of its q-grams; one that does
    # shares one of its rarest, so only these are looked up, and q-grams that most words have gather nothing
    spread = often.select("v", "nv", "gv", F.explode("gv").alias("g"))
    common = spread.groupBy("g").agg(F.count("*").alias("df"))
    rare = listed.select("word", F.explode("gs").alias("g")).join(common, "g", "left").groupBy("word").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "g"))).alias("r"))
    need = F.ceil((F.length("word") - 2) / 2)  # q-grams that must be shared
    probe = F.slice("r", F.lit(1), F.greatest(F.size("r") - F.greatest(need, F.lit(1)) + 1, F.lit(1)).cast("int"))
    asked = rare.select("word", F.explode(F.transform(probe, lambda x: x["g"])).alias("g")).join(listed, "word").select(F.col("word").alias("w"), F.col("n").alias("nw"), F.col("gs").alias("gw"), "g")
    met = asked.join(spread, "g").where((F.col("nv") >= ratio * F.col("nw")) & (F.abs(F.length("w") - F.length("v")) <= 2) & (F.size(F.array_intersect("gw", "gv")) * 2 >= F.length("w") - 2))

    def differences(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            d = [_difference(w, v) for w, v in zip(pdf["w"], pdf["v"])]
            pdf["x"], pdf["y"] = [a for a, _ in d], [b for _, b in d]
            yield pdf

    cand = scratch.cut(met.select("w", "v", "nw", "nv").distinct().mapInPandas(differences, "w string, v string, nw bigint, nv bigint, x string, y string"))
    support = cand.where("x != '' and y != ''").groupBy("x", "y").agg(F.count("*").alias("support"))
    pairs = {(r["x"], r["y"]): r["support"] for r in usable_confusions(support).collect()}
    train = {r["word"]: float(r["n"]) for r in counts.where("n >= 20").orderBy(F.desc("n"), "word").limit(MOST_WORDS).collect()}
    shared = spark.sparkContext.broadcast((pairs, _ranker(train)))

    def rank(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, ranker = shared.value
        by_first = defaultdict(list)
        for x, m in pairs:
            by_first[x[0]].append((x, m))
        for pdf in parts:
            steps = [_steps(w, v, by_first) for w, v in zip(pdf["w"], pdf["v"])]
            pdf = pdf[[x is not None for x in steps]]
            if not len(pdf):
                continue
            least_shown = [min(x, key=lambda s: (pairs[s], s)) for x in steps if x]
            x = np.array([_features(w, v, nw, nv, pairs[s], *s) for w, v, nw, nv, s in zip(pdf["w"], pdf["v"], pdf["nw"], pdf["nv"], least_shown)])
            p = ranker.predict(x)
            yield pd.DataFrame({"w": pdf["w"], "v": pdf["v"], "p": p, "nv": pdf["nv"]})[p >= least]

    ranked = cand.mapInPandas(rank, "w string, v string, p double, nv bigint")
    best = ranked.groupBy("w").agg(F.max(F.struct("p", "nv", "v")).alias("b"))
    return best.select(F.col("w").alias("word"), F.col("b.v").alias("meant"))


def _wider(texts: DataFrame, asked: list[tuple[str, str, str, str]]) -> DataFrame:
    """``ch, meant, a, b``: of each asked context (p, ch, n, meant), for each pair of two signs before and after it, how
    often ch (a) and meant (b) stand there."""
    spots = defaultdict(list)
    for p, ch, n, meant in asked:
        spots[p + ch + n].append((p, ch, n, meant, True))
        spots[p + meant + n].append((p, ch, n, meant, False))
    signs = re.compile(f"[{''.join(sorted({c for x in asked for c in (x[1], x[3])}))}]")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            total: Counter = Counter()
            for src, titles, text in zip(pdf["src"], pdf["titles"], pdf["text"]):
                if not signs.search(text):
                    continue
                lines = _mask(text)
                for run, _ in _runs(lines, _aside(lines, src, titles)[2]):
                    for m in signs.finditer(run):
                        k = m.start()
                        for p, ch, n, meant, odd in spots.get(run[k - 1 : k + 2], ()):
                            total[p, ch, n, meant, run[max(0, k - 3) : k - 1], run[k + 2 : k + 4], odd] += 1
            yield pd.DataFrame([(*x, k) for x, k in total.items()], columns=["p", "ch", "n", "meant", "l", "r", "odd", "k"])

    seen = texts.select("src", "titles", "text").mapInPandas(count, "p string, ch string, n string, meant string, l string, r string, odd boolean, k bigint")
    k = F.col("k")
    return seen.groupBy("p", "ch", "n", "meant", "l", "r").agg(F.sum(F.when(F.col("odd"), k).otherwise(0)).alias("a"), F.sum(F.when(F.col("odd"), 0).otherwise(k)).alias("b")).select("ch", "meant", "a", "b")


def ideograph_corrections(counts: DataFrame, texts: DataFrame | None = None, ratio: float = 8.0, share: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Contexts ``p, ch, n, meant`` in which a character stands for another, and ``ch, meant, share``: characters that mostly do.

    ``counts`` is ``p, ch, n, k``. In a context one character is the rule; a character that is met, as a rule, where the same
    other one is ``ratio`` times as frequent, is a misreading of that one. Where all this is in one context, another word may
    stand there: then two more signs on either side decide, in which the other one has to be the rule as well. They are
    counted in ``texts``; such a character is only judged in that context.
    """
    from pyspark.sql import Window as W

    rule = counts.withColumn("top", F.max(F.struct("k", "ch")).over(W.partitionBy("p", "n")))
    odd = rule.where((F.col("top.ch") != F.col("ch")) & (F.col("top.k") >= ratio * F.col("k"))).select("p", "ch", "n", "k", F.col("top.ch").alias("meant"))
    total = counts.groupBy("ch").agg(F.sum("k").alias("total"))
    pair = odd.groupBy("ch", "meant").agg(F.sum("k").alias("k"), F.count("*").alias("contexts"))
    judged = pair.join(total, "ch").join(total.select(F.col("ch").alias("meant"), F.col("total").alias("meant_total")), "meant")
    likely = judged.where((F.col("meant_total") >= 4 * F.col("total")) & (F.col("k") / F.col("total") >= share))
    taken = likely.where("contexts >= 2").select("ch", "meant", (F.col("k") / F.col("total")).alias("share"))
    if texts is not None:
        one = likely.where("contexts = 1").select("ch", "meant", "total")
        asked = [(r["p"], r["ch"], r["n"], r["meant"]) for r in odd.join(one, ["ch", "meant"]).collect()]  # by share, at most two a character
        if asked:
            strong = _wider(texts, asked).where((F.col("a") > 0) & (F.col("b") >= ratio * F.col("a"))).groupBy("ch", "meant").agg(F.sum("a").alias("a"))
            taken = taken.union(strong.join(one, ["ch", "meant"]).where(F.col("a") / F.col("total") >= share).select("ch", "meant", F.lit(0.0).alias("share")))
    best = Scratch(counts.sparkSession, "ideographs").cut(taken.groupBy("ch").agg(F.max(F.struct("share", "meant")).alias("b")).select("ch", "b.meant", "b.share"))  # read twice
    return odd.join(best.select("ch", "meant"), ["ch", "meant"]).select("p", "ch", "n", "meant"), best


# ---------------------------------------------------------------------------------------------------------------------
# Lines


class Reader:
    """What the corpus tells, applied to one text."""

    def __init__(self, words: dict[str, str], contexts: dict[tuple[str, str, str], str], always: dict[str, str], everywhere: set[str], judge: Lines | None = None, frequent: frozenset[str] = frozenset()):
        self.words, self.contexts, self.always, self.everywhere = words, contexts, always, everywhere
        self.judge, self.frequent = judge, frequent
        self.sized: dict[int, list[str]] = defaultdict(list)
        for k in everywhere:
            self.sized[len(k)].append(k)
        odd = sorted({ch for _, ch, _ in contexts} | set(always))
        self.odd = re.compile(f"[{''.join(odd)}]") if odd else None

    def furniture(self, lines: list[str], src: str, page: int | None, titles: list[str], keys: set[str], starts: dict[str, int]) -> dict[int, str]:
        out: dict[int, str] = {}
        for i, x in enumerate(lines):
            n = page_number(x)
            if n is not None and (src != "ocr_pages" or page is None or n == page):
                out[i] = "page_number"
        own = {line_key(t) for t in titles if t and len(line_key(t)) > 3} if src != "ocr_pages" else set()
        known = keys | own
        edges = set(_edges([x if i not in out else "" for i, x in enumerate(lines)])) if src == "ocr_pages" else set(range(len(lines)))
        for i, x in enumerate(lines):
            if i in out or i not in edges or len(x.strip()) <= 3 or _STOP.search(x) or re.search(rf"[{HYPHENS}]\s*$", x):
                continue
            about = self.about(lines, i, out, known)
            # a chapter's heading where the chapter starts is text
            if (about[0] or about[1] or about[2]) and self.judge.furniture(about) >= 0.5 and not (about[2] and self._starts(lines, i, x, line_key(x), src, page, starts)):
                out[i] = "header"
        return out

    def about(self, lines: list[str], i: int, numbers: dict[int, str], known: set[str]) -> tuple[float, ...]:
        """What line i is judged by: whether it is a running line of its book or of several, nearly one, a chapter's; whether it
        stands beside a page number, at the edge, alone, after a line that goes on in it; its length and a number at its side."""
        x = lines[i]
        key = line_key(x)
        same = key in known or key in self.everywhere
        apart = self._apart(lines, i, numbers)
        like = not same and apart and self._like(key, known) is not None
        flat = ud.normalize("NFKC", x)
        chapter = _CHAPTER.match(_EDGE.sub("", flat).strip()) is not None
        before = next((lines[j] for j in range(i - 1, -1, -1) if lines[j].strip()), "")
        goes_on = bool(before) and not _STOP.search(before) and x.lstrip()[:1].islower()
        alone = (i == 0 or not lines[i - 1].strip()) + (i + 1 == len(lines) or not lines[i + 1].strip())
        return (float(same), float(like), float(chapter), float(i - 1 in numbers or i + 1 in numbers), float(apart), float(alone), float(goes_on), float(min(len(x.strip()) // 20, 4)), float(_EDGE.search(flat) is not None))

    def cut(self, lines: list[str], i: int, skip: set[int]) -> bool:
        """Whether the last word of line i is cut and the next line goes on with it."""
        g = _goes_on(lines, i, skip)
        return g is not None and self.judge.cut(cut_features(g[0], g[3], g[2] - i, self.frequent)) >= 0.5

    def _like(self, key: str, known: set[str]) -> str | None:
        """The key itself if it is known, here or everywhere, else a known one that hardly differs."""
        if key in known or key in self.everywhere:
            return key
        if len(key) < 6:
            return None
        near = (k for n in range(len(key) - 3, len(key) + 4) for k in self.sized.get(n, ()))
        return next((k for k in chain((k for k in known if -4 < len(key) - len(k) < 4), near) if _alike(key, k)), None)

    def running(self, text: str) -> set[str]:
        """Keys of the lines running in several books that some line of the text may be; more than are used in the end."""
        keys = {line_key(x) for x in _mask(text) if 3 < len(x.strip()) and not _STOP.search(x)}
        return {k for key in keys if (k := self._like(key, set())) is not None}

    @staticmethod
    def _apart(lines: list[str], i: int, numbers: dict[int, str]) -> bool:
        """Beside a page number, or the first or last line that holds more."""
        full = [k for k, x in enumerate(lines) if x.strip() and numbers.get(k) != "page_number"]
        return i in (full[0], full[-1]) or i - 1 in numbers or i + 1 in numbers

    @staticmethod
    def _starts(lines: list[str], i: int, line: str, key: str, src: str, page: int | None, starts: dict[str, int]) -> bool:
        """A chapter's heading where the chapter starts: alone, without a page number, on the first page of the chapter."""
        if _EDGE.search(ud.normalize("NFKC", line).strip().removeprefix("第")) and re.search(r"\s{2,}\d+\s*$|^\s*\d+\s{2,}", ud.normalize("NFKC", line)):
            return False
        if i + 1 < len(lines) and lines[i + 1].strip():
            return False
        first = starts.get(key.split("§")[0])
        if first is None or page is None:
            return first is None and src == "ocr_pages"
        return page == first if src == "ocr_pages" else page <= first <= page + 3

    def kinds(self, text: str, src: str, page: int | None, titles: list[str], keys: set[str], starts: dict[str, int]) -> list[tuple[int, str]]:
        """(line, kind), lines counted from 1."""
        lines = _mask(text)
        marks = self.furniture(lines, src, page, titles, keys, starts)
        out = {(i + 1, k) for i, k in marks.items()}
        skip = set(marks)
        for i, x in enumerate(lines):
            if x and i not in skip and self.cut(lines, i, skip):
                out.add((i + 1, "hyphen"))
        for i, _, _ in self.misread(lines, skip):
            out.add((i + 1, "misread"))
        return sorted(out)

    def asked(self, text: str, src: str, page: int | None, titles: list[str], keys: set[str], starts: dict[str, int]) -> set[tuple[str, str, str]]:
        """All that is looked up in a text: words as (word, "", ""), what cuts are judged by as (word, "", "often") and contexts."""
        lines = _mask(text)
        skip = set(self.furniture(lines, src, page, titles, keys, starts))
        out = set()
        for _, found, cut in _words(lines, skip):
            out.update((w, "", "") for w in found)
            if cut:
                out.add((cut[0] + cut[2], "", ""))
                out.update((w, "", "often") for w in (cut[0] + cut[2], cut[0], cut[2]))
        for run, _ in _runs(lines, skip):
            out.update((run[m.start() - 1], m.group(), run[m.end()]) for m in _CJK.finditer(run))
        return out

    def misread(self, lines: list[str], skip: set[int]) -> Iterator[tuple[int, str, str]]:
        """(line, what it holds, what is meant)."""
        for i, found, cut in _words(lines, skip):
            for w in found:
                if w in self.words:
                    yield i, w, self.words[w]
            if cut and (meant := self.words.get(cut[0] + cut[2])) is not None:
                a, j, b = cut  # the part that differs
                if not meant.startswith(a):
                    yield i, a, meant[: max(1, len(meant) - len(b))] if meant.endswith(b) else meant
                if not meant.endswith(b):
                    yield j, b, meant[len(a) :] if meant.startswith(a) else meant
        if self.odd is None:
            return
        for run, at in _runs(lines, skip):
            for m in self.odd.finditer(run):
                k = m.start()
                p, ch, n = run[k - 1], run[k], run[k + 1]
                if (meant := self.contexts.get((p, ch, n)) or self.always.get(ch)) is not None:
                    yield at[bisect_right(at, (k, 1 << 60)) - 1][1], p + ch + n, p + meant + n

    def repair(self, text: str, src: str, page: int | None, titles: list[str], keys: set[str], starts: dict[str, int]) -> str:
        """Continuous paragraphs: furniture gone, cut words and lines put together, misread characters replaced."""
        lines, masked = text.split("\n"), _mask(text)
        skip = set(self.furniture(masked, src, page, titles, keys, starts))
        fixes: dict[int, list[tuple[str, str]]] = defaultdict(list)
        for i, a, b in self.misread(masked, skip):
            fixes[i].append((a, b))
        whole = {i for i in range(len(lines)) if i not in skip and masked[i] and self.cut(masked, i, skip)}
        paragraphs, now, glued = [], "", False
        for i, line in enumerate(lines):
            if i in skip:
                continue
            for a, b in fixes[i]:
                line = re.sub(re.escape(a), lambda m, b=b: b.capitalize() if m.group()[:1].isupper() else b, line, count=1, flags=re.I) if a.isascii() else line.replace(a.strip("^$"), b.strip("^$"), 1)
            s = line.strip()
            if not s or re.match(r"[-*+#>|]|\d+[.)]\s|```", s) or re.fullmatch(r"[\d\s.%-]+(?:ms)?", s) or re.search(r"\S\s{3,}\S", s):
                if not glued and (s or now):
                    paragraphs.append(now)
                    now = ""
                if s:
                    paragraphs.append(s)
                continue
            if glued or not now:
                now += s
            else:
                now += s if _CJK.match(now[-1]) or _CJK.match(s[0]) or s[0] in "，。；：？！" or now[-1] in "，。；：？！" else f" {s}"
            glued = i in whole
            if glued:
                now = re.sub(rf"[{HYPHENS}]\s*$", "", now)
        paragraphs.append(now)
        return "\n".join(p for p in paragraphs if p)


def _texts(pages: DataFrame | None, chunks: DataFrame | None) -> DataFrame:
    parts = []
    if pages is not None:
        parts.append(pages.where("text is not null").select(F.lit("ocr_pages").alias("src"), F.col("page_id").cast("bigint").alias("row_id"), "book", F.col("page_number").cast("int").alias("page"), F.array().cast("array<string>").alias("titles"), "text"))
    if chunks is not None:
        stem = F.regexp_replace(F.regexp_replace("source_file", r"^.*/", ""), r"\.\w+$", "")
        parts.append(chunks.where("content is not null").select(F.lit("chunks").alias("src"), F.col("chunk_id").cast("bigint").alias("row_id"), stem.alias("book"), F.col("page_number").cast("int").alias("page"), F.coalesce("titles", F.array().cast("array<string>")).alias("titles"), F.col("content").alias("text")))
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1])


def _arguments(r) -> tuple:
    """Of a row what a reader is asked with."""
    keys, first = set(), {}
    for x in [] if r.profile is None else r.profile:
        keys.add(x["b"])
        if x["first"] is not None and x["first"] == x["first"]:
            first[x["b"]] = int(x["first"])
    running = getattr(r, "running", None)
    keys.update([] if running is None else running)
    page = None if r.page is None or r.page != r.page else int(r.page)
    return r.text, r.src, page, list(r.titles), keys, first


def _with_running(rows: DataFrame, everywhere: DataFrame, blocks: int) -> DataFrame:
    """``rows``, which have a ``uid``, with the lines running in several books (b) that lines of the text may be; these are
    read in blocks, since a line is found in one of them or in none."""
    spark = rows.sparkSession
    found = None
    for k in range(blocks):
        shared = spark.sparkContext.broadcast({r["b"] for r in everywhere.where(F.pmod(F.xxhash64("b"), F.lit(blocks)) == k).collect()})

        def match(parts: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            reader = Reader({}, {}, {}, shared.value)
            for pdf in parts:
                yield pd.DataFrame([(uid, b) for uid, text in zip(pdf["uid"], pdf["text"]) for b in reader.running(text)], columns=["uid", "b"])

        part = rows.select("uid", "text").mapInPandas(match, "uid bigint, b string")
        found = part if found is None else found.union(part)
    return rows.join(found.groupBy("uid").agg(F.collect_set("b").alias("running")), "uid", "left")


def _with_fixes(rows: DataFrame, words: DataFrame, contexts: DataFrame, frequent: DataFrame, lines: tuple) -> DataFrame:
    """``rows``, which have a ``uid``, with the corrections and frequent words (a, b, c, meant) that the text of each one asks for."""
    shared = rows.sparkSession.sparkContext.broadcast(lines)

    def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader({}, {}, {}, *shared.value)
        for pdf in parts:
            yield pd.DataFrame([(r.uid, *x) for r in pdf.itertuples(index=False) for x in reader.asked(*_arguments(r))], columns=["uid", "a", "b", "c"])

    asked = rows.mapInPandas(ask, "uid bigint, a string, b string, c string")
    none = F.lit("")
    known = words.select(F.col("word").alias("a"), none.alias("b"), none.alias("c"), "meant").union(contexts.select("p", "ch", "n", "meant"))
    known = known.union(frequent.select("a", none, F.lit("often"), none))
    fixes = asked.join(known, ["a", "b", "c"]).groupBy("uid").agg(F.collect_list(F.struct("a", "b", "c", "meant")).alias("fixes"))
    return rows.join(fixes, "uid", "left")


def _judge(rows: DataFrame, everywhere: DataFrame, words: frozenset[str], look_up: Callable[[set[str]], frozenset[str]]) -> Lines:
    """The classifiers of line pairs, trained on a sample of pages by a hash of their ids and on cuts of ``words``; ``look_up``
    gives those of some words that are frequent."""
    n = rows.count()
    chance = F.pmod(F.xxhash64("src", "row_id"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, MOST_PAGES / max(1, n)))
    taken = rows.where(chance).collect()[:MOST_PAGES]
    some = [r["b"] for r in everywhere.limit(MOST_PAGES).collect()]
    pages, keys = [], set(some)
    for r in taken:
        text, _, _, titles, own, _ = _arguments(r)
        keys |= own
        known = own | {line_key(t) for t in titles if t}
        pages.append([x for x in _mask(text) if page_number(x) is None and line_key(x) not in known and not _CHAPTER.search(x)])
    keys = sorted(k for k in keys if len(k) > 3 and "§" not in k)
    reader = Reader({}, {}, {}, set(some))

    def describe(lines: list[str], i: int, known: set[str]) -> tuple[float, ...]:
        return reader.about(lines, i, {j: "page_number" for j, x in enumerate(lines) if page_number(x) is not None}, known)

    return train_lines(pages, keys, words, describe, look_up=look_up)


def _read(pages: DataFrame | None, chunks: DataFrame | None, out: str, each) -> DataFrame:
    """``each(reader, row)`` over all texts, with the corpus counted first; ``out`` is the schema of what it yields."""
    texts = _texts(pages, chunks)
    spark = texts.sparkSession
    scratch = Scratch(spark, "scans")
    counted = _counted(texts, scratch)
    lines = counted.where("what = 'line' and m >= 1 and length(b) >= 4")
    total = counted.where("what = 'line'").groupBy("b").agg(F.sum("n").alias("all_n"), F.sum("m").alias("all_m"), F.countDistinct("a").alias("books"))
    # a running line stands at the edges of pages and comes again
    running = total.where((F.col("all_m") >= 4) & (F.col("all_m") >= 0.9 * F.col("all_n")))
    everywhere = scratch.cut(running.where("books >= 3 and all_m >= 10").select("b"))
    keyed = lines.where("a != ''").join(running.select("b"), "b").select("a", "b")
    starts = counted.where("what = 'chapter' and a != ''").groupBy("a", "b").agg(F.min("c").cast("int").alias("first"))
    profile = keyed.withColumn("first", F.lit(None).cast("int")).unionByName(starts).groupBy("a").agg(F.collect_list(F.struct("b", "first")).alias("profile")).withColumnRenamed("a", "book")
    words = scratch.cut(word_corrections(counted.where("what = 'word'").select(F.col("a").alias("word"), "n")))
    contexts, always = ideograph_corrections(counted.where("what = 'context'").select(F.col("a").alias("p"), F.col("b").alias("ch"), F.col("c").alias("n"), F.col("n").alias("k")), texts)
    contexts, always = scratch.cut(contexts), scratch.cut(always)
    chars = {r["ch"]: r["meant"] for r in always.where("share >= 0.6").collect()}  # one row a character
    rows = texts.join(profile, "book", "left").select("src", "row_id", "page", "titles", "text", "profile")
    frequent = scratch.cut(counted.where("what = 'word' and n >= 5").where(F.col("a").rlike(r"^\p{L}+$")).select("a", "n"))
    w, c, often, seen, whole = {}, {}, frozenset(), set(), max(words.count(), contexts.count(), frequent.count()) <= BLOCK
    if whole:
        often = frozenset(r["a"] for r in frequent.select("a").collect())

    def look_up(asked: set[str]) -> frozenset[str]:
        if whole:
            return often
        some = spark.createDataFrame([(x,) for x in sorted(asked)], "a string")
        return frozenset(r["a"] for r in frequent.join(F.broadcast(some), "a", "left_semi").select("a").collect())

    judge = _judge(rows, everywhere, frozenset(r["a"] for r in frequent.orderBy(F.desc("n"), "a").limit(MOST_WORDS).collect()), look_up)
    blocks = -(-everywhere.count() // BLOCK)
    if not whole or blocks > 1:
        rows = scratch.cut(rows.withColumn("uid", F.monotonically_increasing_id()))
    if blocks > 1:
        rows = _with_running(rows, everywhere, blocks)
    else:
        seen = {r["b"] for r in everywhere.collect()}
    if whole:
        w = {r["word"]: r["meant"] for r in words.collect()}
        c = {(r["p"], r["ch"], r["n"]): r["meant"] for r in contexts.collect()}
    else:
        rows = _with_fixes(rows, words, contexts, frequent, (seen, judge))
    shared = spark.sparkContext.broadcast((w, c, chars, seen, judge, often))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(*shared.value)
        if not whole:
            reader.odd = _CJK
        for pdf in parts:
            found = []
            for r in pdf.itertuples(index=False):
                if not whole:
                    fixes = [] if r.fixes is None else r.fixes
                    reader.words = {x["a"]: x["meant"] for x in fixes if not x["b"] and not x["c"]}
                    reader.frequent = frozenset(x["a"] for x in fixes if not x["b"] and x["c"])
                    reader.contexts = {(x["a"], x["b"], x["c"]): x["meant"] for x in fixes if x["b"]}
                found += [(r.src, r.row_id, *x) for x in each(reader, _arguments(r))]
            yield pd.DataFrame(found, columns=[f.split()[0] for f in out.split(", ")])

    return rows.mapInPandas(run, out)


def noise_lines(pages: DataFrame | None, chunks: DataFrame | None) -> DataFrame:
    """``src, row_id, line_no, kind``: lines with header, page_number, hyphen or misread noise.

    Null and empty texts give no rows; repeated rows each come out; empty tables give no rows; texts without book, page or
    titles are judged by what the whole corpus tells. Texts are read whole.
    """
    return _read(pages, chunks, "src string, row_id bigint, line_no bigint, kind string", lambda reader, args: reader.kinds(*args))


def repaired(pages: DataFrame | None, chunks: DataFrame | None) -> DataFrame:
    """``src, row_id, text``: the repaired text of every row with a text."""
    return _read(pages, chunks, "src string, row_id bigint, text string", lambda reader, args: [(reader.repair(*args),)])
