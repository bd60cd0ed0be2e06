"""Periodic runs of words by maximal pairs.

A pair of places ``i < j`` is maximal if the words before them differ and the common part that begins
at both, of ``L`` words, can't be extended behind either. The stretch from ``i`` to ``j + L`` then has
period ``j - i`` and no neighbouring word extends it; with ``j - i <= L`` it holds two periods. So the
maximal pairs within that distance are the runs, once for every multiple of the smallest period, which
is the least one of its stretch.

Suffixes of all texts of a batch are ordered by prefix doubling, and the ranks of the doublings give the
common parts of neighbours. Common parts of half the least length are enough for a run, so only such
stretches of the order are looked at. A stretch whose suffixes all follow the same word has no pair.
The others are walked bottom-up along their tree of LCP intervals: an interval keeps its places, and the
places of every left word; where two children meet, the places of the smaller one look for places of
the other within ``L`` words that follow another word.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import arrow_rows, col
from statloom.llm.tokens import Words, words

MIN_WORDS = 12  # of a run


def suffix_ranks(doc: np.ndarray, number: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """Ranks of all places by their first 1, 2, 4, ... words; the last list is the order of the suffixes.

    Places have equal ranks if they are in one text and hold the same words, all before its end
    (``last``, the place behind the text's last word). Only places with equal ranks are ordered again.
    """
    n = len(number)
    rank = np.zeros(n, dtype=np.int64)
    key = doc * (int(number.max(initial=0)) + 1) + number
    ranks: list[np.ndarray] = []
    active, step = np.arange(n), 0
    while len(active):
        if step:
            after = active + step
            inside = after < last[active]
            key = rank[active] * (n + 1) + np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
        order = np.argsort(key, kind="stable")
        place, key = active[order], key[order]
        former = rank[place]
        fresh = np.ones(len(place), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        whole = np.ones(len(place), dtype=bool)
        whole[1:] = former[1:] != former[:-1]
        at = np.arange(len(place))
        head = np.maximum.accumulate(np.where(fresh, at, 0))
        rank = rank.copy()
        rank[place] = former + head - np.maximum.accumulate(np.where(whole, at, 0))
        ranks.append(rank.astype(np.int32) if n < 1 << 31 else rank)
        alone = fresh & np.append(fresh[1:], True)
        active, step = place[~alone], max(1, 2 * step)
    return ranks


def common_parts(ranks: list[np.ndarray], last: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """Per suffix how many words it shares with the one before it in the order; 0 if fewer than ``least``."""
    lcp = np.zeros(len(order), dtype=np.int64)
    level = min(int(least).bit_length() - 1, len(ranks) - 1)  # the longest doubling within ``least``
    if len(order) < 2:
        return lcp
    near = np.flatnonzero(ranks[level][order[1:]] == ranks[level][order[:-1]]) + 1
    i, j, total = order[near - 1].copy(), order[near].copy(), np.zeros(len(near), dtype=np.int64)
    ends = last[i], last[j]
    for k in range(len(ranks) - 1, -1, -1):
        inside = (i < ends[0]) & (j < ends[1])
        equal = inside & (ranks[k][np.where(inside, i, 0)] == ranks[k][np.where(inside, j, 0)])
        for x in (i, j, total):
            x += equal << k
    lcp[near] = np.where(total >= least, total, 0)
    return lcp


class _Interval:
    """Places of an LCP interval in order, and the places after every left word."""

    __slots__ = ("after", "places")

    def __init__(self, place: int, word: int) -> None:
        self.places, self.after = [place], {word: [place]}


def _join(a: _Interval, b: _Interval, depth: int, left: np.ndarray, found: list) -> _Interval:
    """The interval of two children; their maximal pairs within ``depth`` words go to ``found``."""
    if len(a.places) < len(b.places):
        a, b = b, a
    for word, places in b.after.items():
        for place in places:
            low, high = place - depth, place + depth
            first, behind = bisect_left(a.places, low), bisect_right(a.places, high)
            if behind - first <= len(a.after):  # few places within reach: look at each
                partners = [x for x in a.places[first:behind] if left[x] != word]
            else:  # few left words: look at each word's places
                partners = [x for w, own in a.after.items() if w != word for x in own[bisect_left(own, low) : bisect_right(own, high)]]
            found.extend((min(place, x), max(place, x), depth) for x in partners)
    for place in b.places:
        insort(a.places, place)
    for word, places in b.after.items():
        own = a.after.setdefault(word, [])
        for place in places:
            insort(own, place)
    return a


def maximal_pairs(order: np.ndarray, lcp: np.ndarray, left: np.ndarray) -> np.ndarray:
    """``(i, j, L)``: all maximal pairs with ``j - i <= L`` among suffixes with ``lcp > 0`` in between."""
    heads = np.flatnonzero(lcp == 0)
    if not len(order):
        return np.empty((0, 3), dtype=np.int64)
    sizes = np.diff(np.append(heads, len(order)))
    words_before = left[order]
    mixed = np.minimum.reduceat(words_before, heads) != np.maximum.reduceat(words_before, heads)
    twos = heads[mixed & (sizes == 2)]
    a, b, depth = order[twos], order[np.minimum(twos + 1, len(order) - 1)], lcp[np.minimum(twos + 1, len(order) - 1)]
    two = np.stack([np.minimum(a, b), np.maximum(a, b), depth], axis=1)
    found: list[tuple[int, int, int]] = []
    for head, size in zip(heads[mixed & (sizes > 2)].tolist(), sizes[mixed & (sizes > 2)].tolist()):
        places, depths = order[head : head + size].tolist(), lcp[head : head + size].tolist()
        before = dict(zip(places, words_before[head : head + size].tolist()))
        open_ones: list[tuple[int, _Interval]] = []
        current = _Interval(places[0], before[places[0]])
        for place, depth in zip([*places[1:], None], [*depths[1:], 0]):
            while open_ones and open_ones[-1][0] >= depth:
                deep, held = open_ones.pop()
                current = _join(held, current, deep, before, found)
            if place is not None:
                open_ones.append((depth, current))
                current = _Interval(place, before[place])
    many = np.array(found, dtype=np.int64).reshape(-1, 3)
    pairs = np.concatenate([two, many])
    return pairs[pairs[:, 1] - pairs[:, 0] <= pairs[:, 2]]


def runs_of(w: Words, least: int = MIN_WORDS) -> np.ndarray:
    """``(start, length, period)`` of all runs, ordered; starts count through all words of the batch."""
    if not len(w.number):
        return np.empty((0, 3), dtype=np.int64)
    last = w.bounds[1:][w.doc]
    ranks = suffix_ranks(w.doc, w.number, last)
    order = np.empty(len(w.number), dtype=np.int64)
    order[ranks[-1]] = np.arange(len(w.number))
    left = np.full(len(w.number), -1, dtype=np.int64)  # a text's first word follows none
    left[1:] = np.where(w.doc[1:] == w.doc[:-1], w.number[:-1], -1)
    pairs = maximal_pairs(order, common_parts(ranks, last, order, max(1, -(-least // 2))), left)
    start, period = pairs[:, 0], pairs[:, 1] - pairs[:, 0]
    length = period + pairs[:, 2]
    rows = np.stack([start, length, period], axis=1)[length >= least]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    smallest = np.ones(len(rows), dtype=bool)
    smallest[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[smallest]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` for every row.

    ``runs`` lists ``(start, length, period)`` by start, then period: stretches of at least ``min_words``
    consecutive words and two periods that no neighbouring word extends, with their smallest period.
    Words are parted by blanks and line ends and compared by their bytes; starts count words from 0.
    ``collapsed`` holds the words, joined by one space, that no run contains after its first period.

    A NULL or empty text has no words, no runs and an empty ``collapsed``. NULL ids and repeated rows
    give a row each, an empty table none; other columns are left behind. A task holds about 4 MB of texts
    at once, or one longer text, at about 100 bytes a word and 4 more for every doubling of its longest
    repeat.
    """

    def step(batch):
        w = words(batch.column("text"))
        found = runs_of(w, min_words)
        begins = w.bounds
        keep = np.zeros(len(w.number) + 1, dtype=np.int64)
        np.add.at(keep, found[:, 0] + found[:, 2], 1)
        np.add.at(keep, found[:, 0] + found[:, 1], -1)
        keep = np.cumsum(keep[:-1]) == 0
        docs = w.doc[found[:, 0]] if len(found) else np.empty(0, dtype=np.int64)
        rows = [{"start": s, "length": n, "period": p} for s, n, p in np.column_stack([found[:, 0] - begins[docs], found[:, 1:]]).tolist()]
        cuts = np.searchsorted(docs, np.arange(len(begins))).tolist()
        return {
            "doc_id": batch.column("doc_id"),
            "n_words": np.diff(begins),
            "runs": [rows[a:b] for a, b in zip(cuts[:-1], cuts[1:])],
            "collapsed": [t.decode() for t in w.joined(keep)],
        }

    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    texts = df.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    return arrow_rows(texts, schema, step, "text")
