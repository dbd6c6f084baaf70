"""Classifiers of line pairs: which lines at a page's edge are furniture, and which line ends cut a word that the next line goes on with.

There are no labelled lines, so they are made: running headers and footers, with and without page numbers and misread letters,
are put into clean pages of the corpus, and words of clean lines are cut; the pages' own edge lines, chapter headings where a
chapter starts and hyphens after which another word follows are the other class. What a line is judged by are its relations to
its neighbours and what the corpus tells of it; these are few and mostly yes or no, so answers are kept.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np

from .boost import Boost

#: Pages on which the classifiers are trained, at most; all pages are read.
MOST_PAGES = 600


class Lines:
    """``furniture`` and ``cut``: probabilities for the features of one line or pair."""

    def __init__(self, furniture: Boost, cut: Boost):
        self._furniture, self._cut = furniture, cut
        self.furniture = functools.lru_cache(100_000)(lambda x: float(self._furniture.predict(np.array([x]))[0]))
        self.cut = functools.lru_cache(100_000)(lambda x: float(self._cut.predict(np.array([x]))[0]))

    def __reduce__(self):
        return Lines, (self._furniture, self._cut)


def cut_features(first: str, rest: str, gap: int, words: frozenset[str]) -> tuple[float, ...]:
    """Of a line that ends with ``first`` and a hyphen and a following one that begins with ``rest``."""
    whole, tail = first + rest in words, rest in words
    return (float(whole), float(tail), float(first in words), float(min(len(first), 4)), float(min(len(rest), 4)), float(min(gap, 3)))


def _misread(rng: np.random.Generator, s: str) -> str:
    i = int(rng.integers(len(s)))
    return s[:i] + "xqzjkv"[int(rng.integers(6))] + s[i + 1 :]


def train(pages: list[list[str]], keys: list[str], words: frozenset[str], describe, seed: int = 4, look_up: Callable[[set[str]], frozenset[str]] | None = None) -> Lines:
    """From clean pages (lines), the corpus's running lines by key, and words to cut; ``look_up(asked)`` holds those of the asked
    words that are frequent in the corpus, by default those of ``words``.

    ``describe(lines, i, known)`` gives the features of line i where the keys of ``known`` are running lines of the page's book.
    """
    rng = np.random.default_rng(seed)
    rows: list[tuple[float, ...]] = []
    labels: list[int] = []
    listed = sorted(words)

    def add(lines: list[str], i: int, known: set[str], label: int) -> None:
        rows.append(describe(lines, i, known))
        labels.append(label)

    for lines in pages:
        full = [i for i, x in enumerate(lines) if x.strip()]
        if len(full) < 3:
            continue
        n = int(rng.integers(1, 400))
        own = {keys[int(k)] for k in rng.integers(0, len(keys), 3)} if keys else {"runningheadofabook"}
        key = sorted(own)[0]
        # a header or footer, as it is, with a page number on either side, misread, or of a chapter
        shown = _misread(rng, key) if len(key) >= 8 and rng.random() < 0.25 else key
        chapter = f"Chapter {int(rng.integers(1, 12))}  " if rng.random() < 0.3 else ""
        head = [f"{chapter}{shown}", f"{n}  {chapter}{shown}", f"{chapter}{shown}  {n}"][int(rng.integers(3))]
        if chapter:  # the corpus may not have shown it
            own = own | {f"{chapter.split()[1]}§chapter{key}"} if rng.random() < 0.5 else set()
        top = rng.random() < 0.6
        page = [head, *([""] if rng.random() < 0.3 else []), *lines] if top else [*lines, *([""] if rng.random() < 0.5 else []), head]
        add(page, 0 if top else len(page) - 1, own, 1)
        # the page's own edges, and a line within
        for i in (full[0], full[-1], full[int(rng.integers(len(full)))]):
            add(lines, i, own, 0)
    made: list[tuple[str, str, str, str, int]] = []
    long = [w for w in listed if len(w) >= 5]
    for _ in range(4 * len(pages) if len(long) > 10 else 0):
        w, other = long[int(rng.integers(len(long)))], listed[int(rng.integers(len(listed)))]
        k, gap = int(rng.integers(2, len(w) - 1)), 1 + int(rng.random() < 0.2) * int(rng.integers(1, 4))
        a, b = w[:k], w[k:]
        if rng.random() < 0.3:  # a cut word may be misread or not be frequent
            a, b = (_misread(rng, a), b) if rng.random() < 0.5 else (a, _misread(rng, b))
        made.append((a, b, w, other, gap))
    if look_up is not None and made:
        words = look_up({x for a, b, w, other, _ in made for x in (a + b, a, b, a + other, w + other, w, other)})
    cuts: list[tuple[float, ...]] = []
    cut_labels: list[int] = []
    for a, b, w, other, gap in made:
        cuts.append(cut_features(a, b, gap, words))
        cut_labels.append(1)
        if a + other not in words and w + other not in words:
            cuts.append(cut_features(w, other, gap, words))  # short- and long-lived: another word follows
            cut_labels.append(0)
    fit = lambda x, y: Boost().fit(np.array(x), np.array(y)) if len({*y}) == 2 else None
    return Lines(fit(rows, labels) or Boost(0), fit(cuts, cut_labels) or Boost(0))
