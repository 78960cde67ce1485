"""Jaro-Winkler similarity over Arrow batches."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

# Fixed values of the measure: prefix weight, longest prefix counted, and the
# Jaro score above which the prefix counts.
PREFIX_WEIGHT = 0.1
PREFIX_MAX = 4
BOOST_ABOVE = 0.7
MATRIX_BYTES = (16, 32, 64)  # longest words of the groups that are compared as matrices


def _as_matrix(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    width = max(int(lengths.max(initial=0)), 1)
    flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8)
    return flat.reshape(len(words), width), lengths


def _one_pair(a: bytes, b: bytes) -> float:
    """Similarity of one pair in time linear in its length.

    Places of each byte of `b` are taken in order; those that fell behind the
    reach of the current byte of `a` can never be reached again.
    """
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    places = [np.flatnonzero(np.frombuffer(b, np.uint8) == byte).tolist() for byte in range(256)]
    at = [0] * 256
    hit_a, hit_b = [], []
    for i, byte in enumerate(a):
        own, k = places[byte], at[byte]
        while k < len(own) and own[k] < i - reach:
            k += 1
        if k < len(own) and own[k] <= i + reach:
            hit_a.append(byte)
            hit_b.append(own[k])
            k += 1
        at[byte] = k
    m = len(hit_a)
    if not m:
        return 0.0
    swaps = sum(x != b[j] for x, j in zip(hit_a, sorted(hit_b))) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3.0
    prefix = 0
    while prefix < min(PREFIX_MAX, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * PREFIX_WEIGHT * (1.0 - jaro) if jaro > BOOST_ABOVE else jaro


def jaro_winkler(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Similarity of each (left, right) pair of byte strings; an empty side gives 0.

    Pairs are grouped by length, so that a long word makes no other pair's work
    longer; those above MATRIX_BYTES are taken one by one.
    """
    out = np.zeros(len(left))
    longest = np.array([max(len(a), len(b)) for a, b in zip(left, right)], np.int64)
    done = np.zeros(len(left), bool)
    for limit in MATRIX_BYTES:
        some = np.flatnonzero(~done & (longest <= limit))
        if len(some):
            out[some] = _by_columns([left[i] for i in some], [right[i] for i in some])
        done[some] = True
    for i in np.flatnonzero(~done):
        out[i] = _one_pair(left[i], right[i])
    return out


def _by_columns(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Works down the columns of padded byte matrices, all pairs at once."""
    n = len(left)
    if n == 0:
        return np.zeros(0)
    a, la = _as_matrix(left)
    b, lb = _as_matrix(right)
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    rows = np.arange(n)
    place = np.arange(b.shape[1])[None, :]
    in_b = place < lb[:, None]
    taken_a = np.zeros(a.shape, dtype=bool)
    taken_b = np.zeros(b.shape, dtype=bool)
    for i in range(a.shape[1]):
        fits = ((b == a[:, i:i + 1]) & in_b & ~taken_b & (np.abs(place - i) <= reach[:, None])
                & (i < la)[:, None])
        hit = fits.any(axis=1)
        taken_b[rows[hit], fits.argmax(axis=1)[hit]] = True
        taken_a[:, i] = hit
    matched = taken_a.sum(axis=1)
    # matched bytes of each side, moved to the front in their own order
    front_a = np.take_along_axis(a, np.argsort(~taken_a, axis=1, kind="stable"), axis=1)
    front_b = np.take_along_axis(b, np.argsort(~taken_b, axis=1, kind="stable"), axis=1)
    width = min(a.shape[1], b.shape[1])
    compared = np.arange(width)[None, :] < matched[:, None]
    swaps = ((front_a[:, :width] != front_b[:, :width]) & compared).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (matched / la + matched / lb + (matched - swaps) / matched) / 3.0
    jaro = np.where(matched > 0, jaro, 0.0)
    head = min(PREFIX_MAX, width)
    alike = (a[:, :head] == b[:, :head]) & (np.arange(head)[None, :] < np.minimum(la, lb)[:, None])
    prefix = np.cumprod(alike, axis=1).sum(axis=1)
    return np.where(jaro > BOOST_ABOVE, jaro + prefix * PREFIX_WEIGHT * (1.0 - jaro), jaro)


def score_series(left: pd.Series, right: pd.Series) -> pd.Series:
    """Score a batch, each distinct pair once; NULL on either side gives 0."""
    out = np.zeros(len(left))
    known = (left.notna() & right.notna()).to_numpy()
    if known.any():
        left_codes, left_words = pd.factorize(left[known])
        right_codes, right_words = pd.factorize(right[known])
        codes, distinct = pd.factorize(left_codes * len(right_words) + right_codes)
        scores = jaro_winkler(
            [left_words[i].encode() for i in distinct // len(right_words)],
            [right_words[i].encode() for i in distinct % len(right_words)])
        out[known] = scores[codes]
    return pd.Series(out)


def jaro_winkler_column(left: Column, right: Column) -> Column:
    @F.pandas_udf(T.DoubleType())
    def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
        return score_series(a, b)

    return similarity(left, right)


# Ship this module's functions with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
