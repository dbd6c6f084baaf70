"""Mapping freely written names to a reference list, with misses reported.

The list's forms and words are its own dictionary. A name is read as words of the list, each found in a symmetric-delete
dictionary (all strings with up to n characters deleted on both sides) and ranked by weighted Damerau-Levenshtein distance; words
that are run together or pulled apart are put right. It stands for the entry that consists of just these words, in whatever
order and however many they are; so a name cannot be taken for an entry that differs from it in a whole word, however
close the spelling. Names that can't be read so are looked up as a whole in a second such dictionary. Where the list gives
forms in two scripts, ideographic words are paired with the others by what the names of all entries with one word have in
common, and written-together names are cut into them. Ties go to what the corpus writes exactly so most often.

A list of a proven size (``MAX_ENTRIES`` rows, checked) is broadcast as it is and its dictionaries are made once a task;
``to_canonical_joined`` is for longer ones and looks whole forms up in a join on deletions. What is special in a language or field
(words without meaning, the kind that a name without one stands for) is a ``Usage``, which is empty unless given.
"""

from __future__ import annotations

import re
import unicodedata as ud
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType

from .disguise import consistent

MAX_ENTRIES = 20_000
#: Traditional characters and their simplified forms.
SIMPLIFIED = {
    "動": "动", "測": "测", "時": "时", "頻": "频", "譜": "谱", "視": "视", "圖": "图", "會": "会", "話": "话", "輪": "轮", "詢": "询", "協": "协", "議": "议", "網": "网", "關": "关", "擬": "拟",
    "預": "预", "緩": "缓", "層": "层", "級": "级", "開": "开", "銷": "销", "邊": "边", "鄰": "邻", "擁": "拥", "載": "载", "發": "发", "現": "现", "檢": "检", "驗": "验", "帶": "带", "寬": "宽",
    "壓": "压", "縮": "缩", "隨": "随", "機": "机", "隊": "队", "適": "适", "應": "应", "顯": "显", "樸": "朴", "彈": "弹", "門": "门", "對": "对", "稱": "称", "撲": "扑", "複": "复", "復": "复",
    "綴": "缀", "標": "标", "傳": "传", "輸": "输", "檔": "档", "虛": "虚", "擴": "扩", "餘": "余", "佈": "布", "週": "周", "塊": "块", "換": "换", "並": "并", "與": "与", "權": "权", "遲": "迟",
    "連": "连", "結": "结", "構": "构", "統": "统", "計": "计", "資": "资", "訊": "讯", "線": "线", "電": "电", "腦": "脑", "碼": "码", "雙": "双", "單": "单", "點": "点", "變": "变", "環": "环",
    "節": "节", "組": "组", "編": "编", "號": "号", "錯": "错", "誤": "误", "據": "据", "數": "数", "庫": "库", "務": "务", "業": "业", "術": "术", "學": "学", "實": "实", "際": "际", "靈": "灵",
    "運": "运", "過": "过", "進": "进", "還": "还", "這": "这", "該": "该", "們": "们", "個": "个", "為": "为", "來": "来", "條": "条", "簡": "简", "體": "体", "處": "处", "類": "类", "風": "风",
    "長": "长", "場": "场", "間": "间", "題": "题", "響": "响", "護": "护", "選": "选", "擇": "择", "優": "优", "勢": "势", "總": "总", "繼": "继", "續": "续", "維": "维", "監": "监", "製": "制",
    "準": "准",
}


@dataclass(frozen=True)
class Usage:
    """What a language or field leaves out or adds when it writes names: words without meaning, what may stand before, after and
    inside of names in ideographs without meaning, and the last word that is meant where none is written."""

    fillers: frozenset[str] = frozenset()
    before: tuple[str, ...] = ()
    after: tuple[str, ...] = ()
    inside: str = ""
    last_word: str | None = None


_CJK = r"[㐀-鿿]"


def distance(a: str, b: str) -> float:
    """Weighted Damerau-Levenshtein: a swap of neighbours or a doubled letter costs less than a lost or added one, a
    replaced one the most."""
    before: list[float] = []
    prev = [0.9 * j for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        row = [0.9 * i]
        for j, y in enumerate(b, 1):
            lost = 0.8 if i > 1 and a[i - 2] == x else 0.9
            added = 0.8 if j > 1 and b[j - 2] == y else 0.9
            cost = min(prev[j] + lost, row[j - 1] + added, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and x != y:
                cost = min(cost, before[j - 2] + 0.7)
            row.append(cost)
        before, prev = prev, row
    return prev[-1]


def _deletes(word: str, most: int) -> Iterator[str]:
    for n in range(min(most, len(word) - 1) + 1):
        for gone in combinations(range(len(word)), n):
            yield "".join(c for i, c in enumerate(word) if i not in gone)


def _most(word: str) -> int:
    """Edits that a word may be away from a term."""
    return 2 if len(word) >= 6 else 1 if len(word) >= 4 else 0


class DeleteIndex:
    """Terms within a bounded edit distance, found through deletions alone."""

    def __init__(self, terms: dict[str, float], most: Callable[[str], int]):
        self.terms, self.most = terms, most
        self.longest = max((len(t) + most(t) for t in terms), default=0)
        self.table: dict[str, list[str]] = defaultdict(list)
        for t in terms:
            for d in set(_deletes(t, most(t))):
                self.table[d].append(t)

    def best(self, word: str) -> str | None:
        """The nearest term by distance, then weight, then spelling; None if none is near enough."""
        if word in self.terms:
            return word
        return min(near)[2] if (near := self.near(word)) else None

    def near(self, word: str) -> list[tuple[float, float, str]]:
        """(distance, minus weight, term) of all terms that are near enough."""
        if len(word) > self.longest:  # none is
            return []
        found = {t for d in set(_deletes(word, self.most(word))) for t in self.table.get(d, ())}
        return [x for x in ((distance(word, t), -self.terms[t], t) for t in found) if x[0] <= min(self.most(x[2]), self.most(word))]


def _simple(text: str) -> str:
    return "".join(SIMPLIFIED.get(c, c) for c in text)


def _plain(text: str) -> str:
    """Lower case without accents; letters, digits, ideographs and single spaces only."""
    flat = "".join(c for c in ud.normalize("NFD", text.lower()) if ud.category(c) != "Mn")
    return " ".join(re.findall(r"[a-z0-9]+|[㐀-鿿]+", flat))


class Matcher:
    """Built from the reference list; ``match`` maps one name to canon_id, 0 for none."""

    def __init__(self, entries: list[tuple[int, str | None, str | None, str | None]], counts: dict[int, int] | None = None, usage: Usage = Usage()):
        self.counts, self.usage = counts or {}, usage
        self.abbr: dict[str, int] = {}
        self.whole: dict[str, int] = {}
        self.words_of: dict[int, tuple[str, ...]] = {}
        seen: Counter = Counter()
        named: dict[str, list[str]] = defaultdict(list)
        for cid, zh, en, abbr in entries:
            if abbr and abbr.strip():
                self.abbr.setdefault(re.sub(r"[^a-z0-9]", "", abbr.lower()), cid)
            for form in (zh, en):
                if form and form.strip():
                    self.whole.setdefault(_plain(consistent(form)).replace(" ", ""), cid)
            if en and (words := _plain(en).split()):
                self.words_of[cid] = tuple(words)
                seen.update(words)
                for w in set(words):
                    if zh:
                        named[w].append(_simple(zh))
        # an ideographic word and the other one of the same entries stand for each other
        self.ideo = {w: common for w, names in named.items() if len(names) >= 2 and (common := self._common(names))}
        self.word_of_ideo = {z: w for w, z in self.ideo.items()}
        self.ideo_index = DeleteIndex({z: 1.0 for z in self.word_of_ideo}, lambda z: 1)
        self.longest_ideo = max(map(len, self.word_of_ideo), default=0)
        for cid, zh, _, _ in entries:  # entries without a form in the other script
            if cid not in self.words_of and zh and (cuts := self._cut(_plain(zh).replace(" ", ""))):
                self.words_of[cid] = min(cuts, key=lambda c: (len(c), c))
        self.by_words: dict[tuple[str, ...], int] = {}
        for cid, words in sorted(self.words_of.items()):
            self.by_words.setdefault(tuple(sorted(words)), cid)
        self.lengths = {len(words) for words in self.words_of.values()}
        self.last_of = {cid: words[-1] for cid, words in self.words_of.items()}
        self.words = DeleteIndex({w: float(n) for w, n in seen.items()}, _most)
        weight = lambda cid: 1.0 + self.counts.get(cid, 0)
        self.forms = DeleteIndex({f: weight(cid) for f, cid in self.whole.items()}, lambda f: (1 if len(f) >= 4 else 0) if re.search(_CJK, f) else _most(f))

    @staticmethod
    def _common(names: list[str]) -> str:
        """The longest string that all names hold."""
        first = min(names, key=len)
        return next((first[i : i + n] for n in range(len(first), 0, -1) for i in range(len(first) - n + 1) if all(first[i : i + n] in x for x in names)), "")

    # -- one name

    def match(self, name: str) -> int:
        text = _plain(_simple(consistent(name)))
        squashed = text.replace(" ", "")
        if not squashed:
            return 0
        if squashed in self.whole:
            return self.whole[squashed]
        tokens = re.findall(r"[a-z0-9]+", text)
        spelt = "".join(tokens) if len(tokens) > 2 and all(len(w) == 1 for w in tokens) else None
        words = [spelt] if spelt else [w for w in tokens if w not in self.usage.fillers]
        runs = re.findall(f"{_CJK}+", text)
        if runs:
            hit = self._ideographs(runs)
            return (self._short(words, "".join(runs)) if hit is None and words else hit) or 0
        hit = self._short(words, "")
        hit = self._spelt(words) if hit is None else hit
        if hit is None and len(words) > 2:  # a full name beside its abbreviation
            ends = [(t, rest) for t, rest in ((words[0], words[1:]), (words[-1], words[:-1])) if t in self.abbr or self.words.best(t) is None and self._shortens(t, rest)]
            hit = next((x for _, rest in sorted(ends, key=lambda e: e[0] not in self.abbr) if (x := self._spelt(rest)) is not None), None)
        if hit is None and (form := self.forms.best("".join(words))):
            hit = self.whole[form]
        return hit or 0

    def _entry(self, words: tuple[str, ...] | list[str]) -> int:
        """The entry of just these words, also without the last word that is meant; 0 for another thing."""
        key = tuple(sorted(words))
        if key in self.by_words or self.usage.last_word is None or self.usage.last_word in key:
            return self.by_words.get(key, 0)
        return self.by_words.get(tuple(sorted((*key, self.usage.last_word))), 0)

    def _short(self, words: list[str], ideographs: str) -> int | None:
        """An abbreviation, alone, in the plural or beside its last word in either script."""
        joined = "".join(words)
        for form in (joined, joined.removesuffix("s")):
            if form in self.abbr:
                cid = self.abbr[form]
                return cid if self._strip(ideographs) in ("", self.ideo.get(self.last_of.get(cid, ""), "")) else None
        if len(words) == 2 and words[0] in self.abbr and not ideographs and self.words.best(words[1]) == self.last_of.get(self.abbr[words[0]]):
            return self.abbr[words[0]]
        return None

    @staticmethod
    def _shortens(t: str, words: list[str]) -> bool:
        """Whether the letters of t stand in the words in this order, its first one first."""
        rest = iter("".join(words))
        return t[:1] == words[0][:1] and all(c in rest for c in t)

    def _strip(self, text: str) -> str:
        for _ in range(2):
            for a in self.usage.before:
                text = text.removeprefix(a)
            for a in self.usage.after:
                text = text.removesuffix(a)
        return text

    def _cut(self, text: str) -> list[tuple[str, ...]]:
        """All ways to cut a text into ideographic words of the list, as the words they stand for."""
        ways: list[list[tuple[str, ...]]] = [[()]] + [[] for _ in text]
        for j in range(1, len(text) + 1):
            for i in range(max(0, j - self.longest_ideo), j):
                if ways[i] and (w := self.word_of_ideo.get(text[i:j])):
                    ways[j] += [(*x, w) for x in ways[i]]
        return ways[len(text)]

    def _near_cuts(self, text: str) -> list[tuple[float, float, tuple[str, ...]]]:
        """(distance, minus weight, words) of sequences of words that the text is one edit away from."""
        if len(text) < 3 or len(text) > 1 + self.longest_ideo * max(map(len, self.words_of.values()), default=0):
            return []
        found: set[tuple[str, ...]] = set()
        for k in range(len(text) - 1):  # neighbours swapped, maybe over the edge of two words
            found.update(self._cut(text[:k] + text[k + 1] + text[k] + text[k + 2 :]))
        heads = {i: c for i in range(len(text) + 1) if (c := self._cut(text[:i]))}
        tails = {j: c for j in range(len(text) + 1) if (c := self._cut(text[j:]))}
        for i, before in heads.items():
            for j, after in tails.items():
                if 0 < j - i <= self.longest_ideo + 1:
                    for _, _, z in self.ideo_index.near(text[i:j]):
                        found.update((*a, self.word_of_ideo[z], *b) for a in before for b in after)
        out = []
        for words in found:
            full = "".join(self.ideo[w] for w in words)
            if (d := distance(text, full)) <= 1 and len(full) >= 4:
                cid = self._entry(words)
                if not cid and len(words) not in self.lengths:  # no other thing of the list's kind either
                    continue
                whole = tuple(sorted(words)) in self.by_words
                out.append((d, -(1.0 + self.counts.get(cid, 0)) if cid and whole else 0.0 if cid else -0.5, words))
        return out

    def _ideographs(self, runs: list[str]) -> int | None:
        """None if there is nothing but words without meaning; 0 for another thing."""
        runs = [r for r in runs if self._strip(r)]
        if not runs:
            return None
        orders = ["".join(runs)] + (["".join(runs[1:] + runs[:1])] if len(runs) > 1 else [])
        tries: list[str] = []
        for text in orders:
            for x in dict.fromkeys((text, self._strip(text))):
                tries.append(x)
                tries += [x[:i] + x[i + 1 :] for i, c in enumerate(x) if c in self.usage.inside] if len(x) <= self.forms.longest + 1 else []
        tries = list(dict.fromkeys(tries))
        for x in tries:
            if cuts := [c for c in self._cut(x) if len(c) in self.lengths or self._entry(c)]:
                return max(self._entry(c) for c in cuts)
            if x in self.whole:
                return self.whole[x]
        near = [(*n[:2], 0, self._entry(n[2])) for x in tries for n in self._near_cuts(x)]
        near += [(*n[:2], 1, self.whole[n[2]]) for x in tries for n in self.forms.near(x)]
        if not near:
            return None if len("".join(runs)) <= 2 else 0
        return min(near)[3]

    def _spelt(self, tokens: list[str]) -> int | None:
        """None if the tokens can't be read as words of the list, or are too few of an entry's to tell; 0 for another thing."""
        words = self._words(tokens) or self._one_unread(tokens)
        if words is None or len(set(words)) < len(words) and tuple(sorted(words)) not in self.by_words:
            return None
        hit = self._entry(words)
        return hit or (0 if len(words) > 2 else None)

    def _one_unread(self, tokens: list[str]) -> list[str] | None:
        """Tokens of which one is misspelt beyond the dictionary: the nearest word of the list, if no other is about as near."""
        known = [self.words.best(t) for t in tokens]
        if len(tokens) < 3 or len(tokens) not in self.lengths or known.count(None) != 1:
            return None
        i = known.index(None)
        if not 3 <= len(tokens[i]) <= self.words.longest:
            return None
        near = sorted((distance(tokens[i], w), w) for w in self.words.terms if abs(len(w) - len(tokens[i])) <= 2)
        close = [w for d, w in near if d <= 2.0 and d - near[0][0] < 0.5]
        if len(close) > 1:  # the only one that makes an entry of the rest
            close = [w for w in close if self._entry([k or w for k in known])]
        return [k or close[0] for k in known] if len(close) == 1 else None

    def _words(self, tokens: list[str]) -> list[str] | None:
        """Known words that the tokens spell, joined or split where need be; None if a token fits none."""
        out, i = [], 0
        while i < len(tokens):
            t = tokens[i]
            joined = self.words.best(t + tokens[i + 1]) if i + 1 < len(tokens) else None
            alone = self.words.best(t)
            if joined and (t + tokens[i + 1] in self.words.terms or alone is None):
                out.append(joined)
                i += 2
                continue
            if alone is None:
                pieces = self._split(t, 3)
                if pieces is None:
                    return None
                out += pieces
            else:
                out.append(alone)
            i += 1
        return out

    def _split(self, t: str, most: int) -> list[str] | None:
        best: tuple[float, list[str]] | None = None
        for i in range(4, min(len(t) - 3, self.words.longest + 1)):
            if (a := self.words.best(t[:i])) is None:
                continue
            rest = self.words.best(t[i:])
            tail = [rest] if rest else self._split(t[i:], most - 1) if most > 2 else None
            if tail:
                cost = distance(t, "".join([a, *tail]))
                if best is None or cost < best[0]:
                    best = (cost, [a, *tail])
        return best[1] if best else None


def reference_entries(reference: DataFrame) -> list[tuple[int, str | None, str | None, str | None]]:
    """The reference list on the driver; raises beyond MAX_ENTRIES rows, which bounds what is broadcast."""
    rows = reference.select("canon_id", "name_zh", "name_en", "abbr").where("canon_id is not null").limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"the reference list has more than {MAX_ENTRIES} entries; use to_canonical_joined")
    return sorted((tuple(r) for r in rows), key=repr)


def _shown(names: DataFrame, row_id: str, name: str) -> DataFrame:
    bare = names.select(F.col(row_id).cast("bigint").alias(row_id), F.col(name).alias(name))
    return bare.where(F.length(F.regexp_replace(F.col(name), r"(?U)[\s\p{Cf}\p{Mn}]+", "")) > 0)


def to_canonical(names: DataFrame, reference: DataFrame, row_id: str = "entity_id", name: str = "name", usage: Usage = Usage()) -> DataFrame:
    """``entity_id, name, canon_id``: a row per row whose name is neither null, blank nor byte-equal to a form of an entry.

    canon_id is 0 for names that stand for no entry (the report of misses). Blank means white space and characters that
    do not show. Repeated rows each come out; an empty reference list maps everything to 0; other columns are dropped.
    Nothing is shuffled but the exact counts of the entries, at most one row an entry.
    """
    spark = names.sparkSession
    entries = reference_entries(reference)
    forms = [(f, cid) for cid, *fs in entries for f in fs if f is not None]
    exact = spark.createDataFrame(forms, "form string, canon_id bigint")
    bare = _shown(names, row_id, name)
    small = F.broadcast(exact)  # MAX_ENTRIES * 3 forms at most
    counted = bare.join(small, bare[name] == small["form"]).groupBy("canon_id").count().collect() if forms else []
    counts = {r["canon_id"]: r["count"] for r in counted}
    shared = spark.sparkContext.broadcast((entries, counts, usage))

    @F.pandas_udf(LongType())
    def find(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher, known = Matcher(*shared.value), {}
        for s in parts:
            out = []
            for x in s:
                if x not in known:
                    if len(known) > 200_000:
                        known.clear()
                    known[x] = matcher.match(x)
                out.append(known[x])
            yield pd.Series(out, dtype="int64")

    rest = bare.join(F.broadcast(exact.select(F.col("form").alias(name)).distinct()), name, "left_anti") if forms else bare
    return rest.select(row_id, name, find(name).alias("canon_id"))


#: Characters of a form from whose beginning deletions are made; what follows is compared in full.
PREFIX = 10


def to_canonical_joined(names: DataFrame, reference: DataFrame, row_id: str = "entity_id", name: str = "name") -> DataFrame:
    """As ``to_canonical``, for a reference list of any length: whole forms only, in a join on deletions of both sides'
    distinct forms, so neither the list nor a name's rows meet in one task. Words are not read apart, so order counts."""

    @F.pandas_udf(StringType())
    def plain(s: pd.Series) -> pd.Series:
        return s.map(lambda x: _plain(_simple(consistent(x))).replace(" ", ""), na_action="ignore")

    @F.pandas_udf(ArrayType(StringType()))
    def deletions(s: pd.Series) -> pd.Series:
        return s.map(lambda x: list(dict.fromkeys(_deletes(x[:PREFIX], _most(x)))))

    @F.pandas_udf(DoubleType())
    def away(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([distance(x, y) for x, y in zip(a, b)], dtype="float64")

    listed = reference.where("canon_id is not null").select(F.col("canon_id").cast("bigint").alias("canon_id"), F.explode(F.array_compact(F.array("name_zh", "name_en", "abbr"))).alias("form"))
    bare = _shown(names, row_id, name).join(listed.select(F.col("form").alias(name)).distinct(), name, "left_anti")
    exact = _shown(names, row_id, name).groupBy(name).count().join(listed, F.col("form") == F.col(name)).groupBy("canon_id").agg(F.sum("count").alias("n"))
    forms = listed.select("canon_id", plain("form").alias("f")).where("f != ''").groupBy("f").agg(F.min("canon_id").alias("canon_id")).join(exact, "canon_id", "left")
    keys = bare.select(name).distinct().withColumn("k", plain(name))
    asked = keys.where("k != ''").select("k").distinct()
    same = asked.join(forms, F.col("k") == F.col("f")).select("k", "canon_id", F.lit(0.0).alias("d"), F.coalesce("n", F.lit(0)).alias("n"), "f")
    left = asked.join(same.select("k"), "k", "left_anti")
    met = left.select("k", F.explode(deletions("k")).alias("x")).join(forms.select("canon_id", "f", F.coalesce("n", F.lit(0)).alias("n"), F.explode(deletions("f")).alias("x")), "x").select("k", "canon_id", "f", "n").distinct()
    short = F.least(F.length("f"), F.length("k"))
    allowed = F.when(short >= 6, 2).when(short >= 4, 1).otherwise(0)
    near = met.where(F.abs(F.length("k") - F.length("f")) <= allowed).select("k", "canon_id", away("k", "f").alias("d"), "n", "f").where(F.col("d") <= allowed)
    best = same.union(near).groupBy("k").agg(F.min(F.struct("d", (-F.col("n")).alias("m"), "f", "canon_id")).alias("b")).select("k", F.col("b.canon_id").alias("canon_id"))
    found = keys.join(best, "k", "left").select(name, F.coalesce("canon_id", F.lit(0).cast("bigint")).alias("canon_id"))
    return bare.join(found, name).select(row_id, name, "canon_id")
