"""Periodic runs of words within a text, by longest common extensions on suffix trees.

Ukkonen's algorithm builds the suffix trees of the words and of their reversal.
Euler tours of the trees with tables of range minima give the deepest common
ancestor of two leaves, so the longest common extension of two places, to the
right or to the left, takes constant time. Every run has a Lyndon root: the
distance from a place to the next smaller suffix, in one of two orders of the
words, is its period. So each place has two candidates, which are extended in
both directions.

Before that a text is sieved: in a run every word follows the same word as a
period before, so stretches of word pairs that the text already had are marked,
and only they, widened by the longest period they allow, go into trees. The
sieve loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

LEAST_WORDS = 6
LEAST_PERIODS = 4

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_RUN_ARROW = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


def suffix_tree(text: list[int]) -> tuple[list[int], list[int], dict[int, int], int]:
    """Ukkonen's tree of `text`, whose last symbol occurs once: where the edge into each node
    starts and ends, and the child of node v by symbol c under v * width + c."""
    n, width = len(text), max(text) + 1
    start, end, link, child_of = [0], [0], [0], {}
    node = edge = length = pending = 0
    for i, symbol in enumerate(text):
        pending += 1
        newest = 0
        while pending:
            if not length:
                edge = i
            key = node * width + text[edge]
            child = child_of.get(key)
            if child is None:
                child_of[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if newest:
                    link[newest] = node
                newest = node
            else:
                size = min(end[child], i + 1) - start[child]
                if length >= size:
                    edge += size
                    length -= size
                    node = child
                    continue
                at = start[child]
                if text[at + length] == symbol:
                    length += 1
                    if newest:
                        link[newest] = node
                    break
                middle = len(start)
                start += (at, i)
                end += (at + length, n)
                link += (0, 0)
                child_of[key] = middle
                child_of[middle * width + symbol] = middle + 1
                start[child] = at + length
                child_of[middle * width + text[at + length]] = child
                if newest:
                    link[newest] = middle
                newest = middle
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - pending + 1
    return start, end, child_of, width


class Extensions:
    """Longest common extensions of the suffixes of `words`, which are 1 or more, and their order."""

    def __init__(self, words: list[int]):
        text = [*words, 0]
        start, end, child_of, width = suffix_tree(text)
        nodes = len(start)
        keys = np.fromiter(child_of, np.int64, len(child_of))
        order = np.argsort(keys)
        children = np.fromiter(child_of.values(), np.int64, len(child_of))[order]
        begin = np.searchsorted(keys[order] // width, np.arange(nodes + 1)).tolist()
        children = children.tolist()
        # Euler tour: each node where it is entered, with the depth of the node it is entered from
        first, above, leaves = [0] * len(text), [], []
        todo = [(0, 0, 0)]
        while todo:
            node, depth, over = todo.pop()
            here = len(above)
            above.append(over)
            a, b = begin[node], begin[node + 1]
            if a == b:
                suffix = len(text) - depth
                first[suffix] = here
                leaves.append(suffix)
            for child in reversed(children[a:b]):
                todo.append((child, depth + end[child] - start[child], depth))
        self.first = np.array(first, np.int64)
        self.rank = np.empty(len(text), np.int64)
        self.rank[leaves] = np.arange(len(text))
        self.least = [np.array(above, np.int32)]
        step = 1
        while 2 * step <= nodes:
            last = self.least[-1]
            self.least.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at i and j, which differ."""
        a, b = self.first[i], self.first[j]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level).tolist():
            some = np.flatnonzero(level == k)
            table = self.least[k]
            out[some] = np.minimum(table[lo[some]], table[hi[some] - (1 << k)])
        return out


def _next_smaller(rank: list[int]) -> list[int]:
    """The nearest later place with a smaller value; the number of places if there is none."""
    n = len(rank)
    out, open_places = [n] * n, []
    for i, value in enumerate(rank):
        while open_places and rank[open_places[-1]] > value:
            out[open_places.pop()] = i
        open_places.append(i)
    return out


def runs_of(words: np.ndarray, least_words: int = LEAST_WORDS,
            least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """(start, length, period) of all maximal runs of a sequence, in order, by suffix trees."""
    n = len(words)
    words = np.unique(words, return_inverse=True)[1] + 1
    ahead, back = Extensions(words.tolist()), Extensions(words[::-1].tolist())
    places, roots = [], []
    for rank in (ahead.rank, -ahead.rank):
        after = np.array(_next_smaller(rank.tolist()), np.int64)[:n]
        some = np.flatnonzero((after < n) & (least_periods * (after - np.arange(n)) <= n))
        places.append(some)
        roots.append(after[some] - some)
    i, p = np.concatenate(places), np.concatenate(roots)
    right = ahead.common(i, i + p)
    left = np.zeros(len(i), np.int64)
    inner = np.flatnonzero(i > 0)
    left[inner] = back.common(n - i[inner], n - i[inner] - p[inner])
    start, length = i - left, left + p + right
    long_enough = length >= np.maximum(least_words, least_periods * p)
    found = np.unique(np.stack([start, length, p], 1)[long_enough], axis=0)
    # a multiple of a period is no period of its own
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def stretches(words: np.ndarray, least_words: int = LEAST_WORDS,
              least_periods: int = LEAST_PERIODS) -> list[tuple[int, int]]:
    """Ranges of places outside of which no run lies; `words` holds each word's first place.

    A run of period q and L words repeats L - q - 1 pairs of words. Of m repeated
    pairs in a row, a run takes as many at most, so q <= (m + 1) / (periods - 1).
    """
    n = len(words)
    # from the least run's second period on; for one word as the period, all but the first
    needed = least_words - max(1, least_words // least_periods) - 1
    if n < least_words or (words != np.arange(n)).sum() <= needed:
        return []
    pair = words[:-1] * n + words[1:]
    order = np.argsort(pair, kind="stable")
    again = np.zeros(n + 1, np.int8)
    again[1 + order[1:][pair[order][1:] == pair[order][:-1]]] = 1
    edges = np.flatnonzero(again[1:] != again[:-1])
    out: list[tuple[int, int]] = []
    for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if y - x < needed:
            continue
        a, b = max(0, x - (y - x + 1) // (least_periods - 1) - 1), min(n, y + 2)
        while out and a <= out[-1][1]:
            before = out.pop()
            a, b = min(a, before[0]), max(b, before[1])
        out.append((a, b))
    return out


def text_runs(words: list, least_words: int = LEAST_WORDS,
              least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """(start, length, period) of all runs of a list of words, by start, then period."""
    place: dict = {}
    firsts = np.fromiter(map(place.setdefault, words, count()), np.int64, len(words))
    found = [runs_of(firsts[a:b], least_words, least_periods) + np.array([a, 0, 0])
             for a, b in stretches(firsts, least_words, least_periods)]
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def _found(batches: Iterator[pa.RecordBatch], least_words: int, least_periods: int,
           order_of) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, sizes, rows, collapsed = [], [0], [], []  # of all rows of the batch
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = (text or "").encode().split()  # at 0x20 and 0x09 to 0x0D
            places = order_of(name, len(words)) if order_of else None
            if places is not None:
                words = [words[k] for k in places]
            n_words.append(len(words))
            found = text_runs(words, least_words, least_periods)
            if len(found):
                kept = np.ones(len(words), bool)
                for start, length, period in found.tolist():
                    kept[start + period:start + length] = False
                words = [words[k] for k in np.flatnonzero(kept)]
            sizes.append(sizes[-1] + len(found))
            rows.append(found)
            collapsed.append(b" ".join(words))
        table = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
        runs = pa.StructArray.from_arrays([pa.array(table[:, k]) for k in range(3)],
                                          fields=list(_RUN_ARROW))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()),
             pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), runs),
             pa.array(collapsed, pa.binary()).cast(pa.string())],
            ["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str = "text", id_column: str = "doc_id",
                  least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS,
                  order_of: Callable[[object, int], Sequence[int] | None] | None = None
                  ) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row.

    A run is a longest stretch of words that repeat at the distance of its
    smallest period, of `least_words` words and `least_periods` periods or more.
    `runs` lists start (word number), length and period, by start, then period;
    `collapsed` is the text without the words after any run's first period, its
    words joined by a space. `order_of`, given the id and number of words, may
    tell which words to read instead. Null texts and those without words have
    no runs and collapse to the empty string; repeated rows are treated alike,
    an empty table gives no rows, and other columns are not read.
    """
    schema = T.StructType([docs.schema[id_column], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)),
                           T.StructField("collapsed", T.StringType())])
    return docs.select(id_column, text).mapInArrow(
        partial(_found, least_words=least_words, least_periods=least_periods, order_of=order_of),
        schema)


def longest(runs: str = "runs"):
    """The run of greatest length (then smallest start, then period) of a column of runs; null if
    there is none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(best.isNotNull(), F.struct(
        (-best["start"]).alias("start"), best["length"].alias("length"),
        (-best["period"]).alias("period")))
