"""Abusive, hateful or sexual content: every document scored by a bag of subword embeddings with a linear softmax.

A text is read sentence by sentence, brought to one form (characters that stand in for others, letters set apart,
stretched or replaced by signs), and each sentence is the mean of the embeddings of its hashed character n-grams, so an
unseen misspelling shares most of its vectors with the word it hides. Embeddings and softmax are trained together in
numpy on labelled documents: a label holds for some sentence of its document, so training alternates between choosing
the sentences that carry the label and fitting. The labelled sample is bounded by ``MAX_LABELLED``; scoring reads every
document whole, in batches, with n-gram hashes computed for a whole batch at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .disguise import consistent

CATEGORIES = ("abusive", "hateful", "sexual")
#: Labelled documents that are read for training, at most: half of them of a category, half ok, at random.
MAX_LABELLED = 12_000
#: Sentences of ok documents that are fitted, at most.
MAX_SENTENCES = 15_000
#: Mean log ratio of a sentence's n-grams in documents of its category to those in others, below which it belongs to these.
AWAY = -0.6
BUCKETS = 1 << 18
SIZES = (1, 2, 3, 4, 5)
MAX_SENTENCE = 600

#: Signs written for letters inside a word.
_LEET = str.maketrans({"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "|": "l", "0": "o", "$": "s", "5": "s", "7": "t", "+": "t"})
_SPACED = re.compile(r"(?<![A-Za-z])(?:[A-Za-z][-._* ]){2,}[A-Za-z](?![A-Za-z])")
_SIGNED = re.compile(r"(?<![\w@$!|+#*])(?=[\w@$!|+#*]*[A-Za-z])(?=[\w@$!|+#*]*[0-9@$!|+#*])[A-Za-z@$!|+#*0-9]{3,20}(?![\w@$|+#*])")
_CJK_GAP = re.compile(r"(?<=[㐀-鿿])[ \t*·.\-_|/~]{1,2}(?=[㐀-鿿])")
_END = re.compile(r"(?<=[.!?])(?:\s+|(?=[㐀-鿿]))|[。！？；\n]+")


def _signed(m: re.Match) -> str:
    w = m.group()
    if sum(c.isalpha() for c in w) * 2 < len(w) or w.isalnum() and re.fullmatch(r"[A-Za-z]+\d+|[A-Z0-9]+", w):
        return w
    return w.translate(_LEET)


def plain(text: str) -> str:
    """One form of a text for reading: disguises, spaced and stretched words and signs for letters undone, lower case."""
    s = consistent(text)
    s = re.sub(r"[*_~`]{1,3}(?=\w)|(?<=\w)[*_~`]{1,3}(?!\w)", "", s)
    s = _SPACED.sub(lambda m: re.sub(r"[-._* ]", "", m.group()), s)
    s = _SIGNED.sub(_signed, s)
    s = _CJK_GAP.sub("", s)
    s = re.sub(r"([^\W\d_])\1{2,}", r"\1", s)
    s = re.sub(r"\d+", "0", s)
    return s.lower()


def sentences(text: str) -> list[str]:
    out = []
    for s in _END.split(plain(text)):
        s = " ".join(s.split())
        while len(s) > MAX_SENTENCE:  # a text without sentence ends is read in pieces
            out.append(f" {s[:MAX_SENTENCE]} ")
            s = s[MAX_SENTENCE - 50 :]
        if s:
            out.append(f" {s} ")
    return out


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts in one array, and the text each belongs to."""
    lens = np.array([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), lens)
    ids, own = [], []
    with np.errstate(over="ignore"):
        h = np.zeros(len(codes), dtype=np.uint64)
        for n in SIZES:
            m = len(codes) - n + 1
            if m <= 0:
                break
            h = (h[:m] * np.uint64(0x100000001B3)) ^ (codes[n - 1 :] + np.uint64(0x9E3779B97F4A7C15))
            mixed = h * np.uint64(0xBF58476D1CE4E5B9)
            inside = owner[:m] == owner[n - 1 :]
            wide = codes[n - 1 :] > 0x2E7F
            inside &= wide if n < 3 else ~wide if n > 3 else True  # ideographs by one to three, letters by three to five
            ids.append(((mixed >> np.uint64(40)) % np.uint64(BUCKETS))[inside].astype(np.int64))
            own.append(owner[:m][inside])
    return (np.concatenate(ids), np.concatenate(own)) if ids else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class Model:
    """Embeddings E and a linear softmax W, b over their mean; class 0 is ok."""

    def __init__(self, dim: int = 12, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.e = (rng.standard_normal((BUCKETS, dim)) * 0.05).astype(np.float32)
        self.w = (rng.standard_normal((dim, len(CATEGORIES) + 1)) * 0.1).astype(np.float32)
        self.b = np.zeros(len(CATEGORIES) + 1, dtype=np.float32)

    def logits_table(self) -> np.ndarray:
        return (self.e @ self.w).astype(np.float32)

    def fit(self, texts: list[str], labels: np.ndarray, weights: np.ndarray, epochs: int = 4, rate: float = 0.5, seed: int = 3, batch: int = 256) -> "Model":
        """Adagrad over batches; weights are per text."""
        rng = np.random.default_rng(seed)
        ids, own = grams(texts)
        order = np.argsort(own, kind="stable")
        ids, starts = ids[order], np.searchsorted(own[order], np.arange(len(texts) + 1))
        ge, gw, gb = np.full(BUCKETS, 1e-6, np.float32), np.full_like(self.w, 1e-6), np.full_like(self.b, 1e-6)
        for _ in range(epochs):
            for at in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // batch)):
                lens = starts[at + 1] - starts[at]
                at, lens = at[lens > 0], lens[lens > 0]
                if not len(at):
                    continue
                rows = np.concatenate([ids[starts[i] : starts[i + 1]] for i in at])
                seg = np.concatenate(([0], np.cumsum(lens)[:-1]))
                mean = np.add.reduceat(self.e[rows], seg, axis=0) / lens[:, None]
                z = mean @ self.w + self.b
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(at)), labels[at]] -= 1
                g = p * (weights[at] / weights[at].mean())[:, None] / len(at)
                dmean = g @ self.w.T
                dw, db = mean.T @ g, g.sum(0)
                gw += dw * dw
                gb += db * db
                self.w -= rate * dw / np.sqrt(gw)
                self.b -= rate * db / np.sqrt(gb)
                per = np.repeat(dmean / lens[:, None], lens, axis=0)
                uniq, inv = np.unique(rows, return_inverse=True)
                de = np.zeros((len(uniq), self.e.shape[1]), np.float32)
                o = np.argsort(inv, kind="stable")
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(inv[o])) + 1))
                de[:] = np.add.reduceat(per[o], cuts, axis=0)
                ge[uniq] += (de * de).mean(1)
                self.e[uniq] -= rate * de / np.sqrt(ge[uniq])[:, None]
        return self

    def sentence_probabilities(self, texts: list[str], table: np.ndarray | None = None) -> np.ndarray:
        return probabilities(texts, self.logits_table() if table is None else table, self.b)


def probabilities(texts: list[str], table: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Class probabilities of sentences from the n-grams' logits."""
    ids, own = grams(texts)
    z = np.zeros((len(texts), table.shape[1]))
    for c in range(table.shape[1]):
        z[:, c] = np.bincount(own, weights=table[ids, c], minlength=len(texts))
    z = z / np.maximum(np.bincount(own, minlength=len(texts)), 1)[:, None] + b
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _documents_with(texts: list[list[str]]) -> np.ndarray:
    """Of each n-gram the number of documents (lists of sentences) that hold it."""
    total = np.zeros(BUCKETS)
    for k in range(0, len(texts), 500):
        part = texts[k : k + 500]
        ids, own = grams([s for ss in part for s in ss])
        of = np.repeat(np.arange(len(part)), [len(ss) for ss in part])
        total += np.bincount(np.unique(of[own] * np.int64(BUCKETS) + ids) % BUCKETS, minlength=BUCKETS)
    return total


def train(labelled: list[tuple[str, int]], seed: int = 3) -> Model:
    """From (text, class) pairs.

    In each document with a label the sentence is chosen whose n-grams set labelled documents other than this one apart
    from ok documents the most, unless it belongs to another category; a document without such a sentence is taken for a wrong
    label. Then, in turns, a model is fitted and reads all sentences again: those of labelled documents that it finds are chosen, and those of ok documents
    that it takes for something else come to the ``MAX_SENTENCES`` ok sentences that are fitted.
    """
    bad = [(ss, c) for t, c in labelled if c and (ss := sentences(t))]
    fine = [ss for t, c in labelled if c == 0 and (ss := sentences(t))]
    if not bad:
        return Model(seed=seed)
    ok = sorted({s for ss in fine for s in ss}, key=lambda s: xxhash.xxh64_intdigest(s, seed))
    flat = [s for ss, _ in bad for s in ss]
    of = np.repeat(np.arange(len(bad)), [len(ss) for ss, _ in bad])
    cls = np.array([c for _, c in bad])[of]
    with_ = {c: _documents_with([ss for ss, k in bad if k == c]) for c in set(cls.tolist())}
    every = sum(with_.values())
    others = np.maximum(every - 1, 0)  # a document does not support itself
    odds = np.log((others + 0.02) / len(bad)) - np.log((_documents_with(fine) + 0.5) / (len(fine) + 1))
    odds = np.where(others < 1, -1.0, np.clip(odds, -3, 3))
    ids, own = grams(flat)
    size = np.maximum(np.bincount(own, minlength=len(flat)), 1)
    score = np.bincount(own, weights=odds[ids], minlength=len(flat)) / size
    # a sentence that is at home in documents of other categories does not carry this one, but is nothing ok either
    for c, held in with_.items():
        n = sum(k == c for _, k in bad)
        lean = np.log((np.maximum(held - 1, 0) + 0.5) / n) - np.log((every - held + 0.5) / max(len(bad) - n, 1))
        away = np.bincount(own, weights=lean[ids], minlength=len(flat)) / size < AWAY
        score[(cls == c) & away & (score > 0)] = 0.0
    known = set(ok)
    score[[s in known for s in flat]] = -3
    best = np.full(len(bad), -9.0)
    np.maximum.at(best, of, score)
    chosen = (score == best[of]) & (score > 0.3)
    beside = ~chosen & (score < 0)
    hard: list[str] = []
    model = None
    for turn in range(3):
        plain_ok = ok[: MAX_SENTENCES * 2 // 3]
        texts = plain_ok + hard + [flat[i] for i in np.flatnonzero(beside)[: MAX_SENTENCES // 3]] + [flat[i] for i in np.flatnonzero(chosen)]
        y = np.concatenate([np.zeros(len(texts) - chosen.sum(), dtype=np.int64), cls[chosen]])
        counts = np.bincount(y, minlength=len(CATEGORIES) + 1)
        weight = np.where(y == 0, 1.0, np.sqrt(counts[0] / np.maximum(counts, 1))[y])
        model = Model(seed=seed).fit(texts, y, weight)
        if turn == 2:
            break
        p = model.sentence_probabilities(flat)
        voiced = p[np.arange(len(flat)), cls]
        chosen = (voiced > 0.5) & (score > -0.5) | chosen & (voiced > 0.2)
        beside = ~chosen & (p[:, 0] > 0.7) & (score < 0)
        wrong = 1 - np.concatenate([model.sentence_probabilities(ok[k : k + 5000])[:, 0] for k in range(0, len(ok), 5000)]) if ok else np.zeros(0)
        most = np.argsort(-wrong, kind="stable")[: MAX_SENTENCES // 3]
        hard = list(dict.fromkeys(hard + [ok[i] for i in most if wrong[i] > 0.1]))[: MAX_SENTENCES // 2]
    return model


def labelled_sample(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, seed: int = 3) -> list[tuple[str, int]]:
    """(text, class) of labelled documents, at most ``most``, half of a category and half ok.

    Labels are read whatever their case and spacing; unknown labels and null texts are left out; of two raters who
    disagree the category with more votes holds, ok on a tie.
    """
    word = F.lower(F.regexp_replace("label", r"(?U)\s+", ""))
    cls = F.when(word == "ok", 0)
    for i, c in enumerate(CATEGORIES, 1):
        cls = cls.when(word == c, i)
    votes = labels.select("doc_id", cls.alias("cls")).where("cls is not null and doc_id is not null").groupBy("doc_id", "cls").count()
    one = votes.groupBy("doc_id").agg(F.max(F.struct("count", -F.col("cls"))).alias("m")).select("doc_id", (-F.col("m.col2")).alias("cls"))
    texts = documents.where("text is not null").select("doc_id", "text").join(one, "doc_id")
    order = F.xxhash64("doc_id", F.lit(seed))
    rows = texts.where("cls > 0").orderBy(order).limit(most // 2).collect() + texts.where("cls = 0").orderBy(order).limit(most // 2).collect()
    return [(r["text"], r["cls"]) for r in rows]


_SCORES = StructType([StructField(c, DoubleType()) for c in CATEGORIES])


def score_documents(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, source, abusive, hateful, sexual``: for every document the highest probability over its sentences.

    Null and empty texts score 0; repeated rows each come out. The model (embeddings times softmax, a table of fixed
    size) is broadcast.
    """
    spark = documents.sparkSession
    model = train(labelled_sample(documents, labels, most))
    shared = spark.sparkContext.broadcast((model.logits_table(), model.b))

    @F.pandas_udf(_SCORES)
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table, b = shared.value
        for s in parts:
            out = np.zeros((len(s), len(CATEGORIES)))
            texts: list[str] = []
            owner: list[int] = []

            def flush() -> None:
                if texts:
                    p = probabilities(texts, table, b)[:, 1:]
                    np.maximum.at(out, np.array(owner), p)
                    texts.clear()
                    owner.clear()

            size = 0
            for k, t in enumerate(s):
                if t is None:
                    continue
                for x in sentences(t):
                    texts.append(x)
                    owner.append(k)
                    size += len(x)
                if size > 400_000:
                    flush()
                    size = 0
            flush()
            yield pd.DataFrame(out, columns=list(CATEGORIES))

    scored = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", score("text").alias("p"))
    return scored.select("doc_id", "source", *[F.col(f"p.{c}").alias(c) for c in CATEGORIES])


def found(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, most: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, category``: one row for each category that a document's text voices."""
    scored = score_documents(documents, labels, most)
    each = F.array(*[F.when(F.col(c) >= threshold, F.lit(c)) for c in CATEGORIES])
    return scored.select("doc_id", F.explode(F.array_compact(each)).alias("category"))


def source_rates(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``source, documents, abusive, hateful, sexual, any_rate``: rates per source; a null source is a source of its own."""
    scored = score_documents(documents, labels)
    hit = [(F.col(c) >= threshold).cast("double") for c in CATEGORIES]
    return scored.groupBy("source").agg(
        F.count("*").alias("documents"), *[F.avg(h).alias(c) for h, c in zip(hit, CATEGORIES)], F.avg(F.greatest(*hit)).alias("any_rate")
    )
