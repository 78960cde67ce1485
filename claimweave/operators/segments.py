"""Keys for joining strings within an edit distance, by parts that edits leave whole.

A string cut into k + 1 segments keeps one of them through any k edits. So two
strings within k edits share a segment of one as a substring of the other, no
further from its place than the edits allow. The likeness (one minus the
distance over the longer length) fixes k by the lengths. One side of a join
takes the `segments` of its strings, the other the `windows` of its own: strings
at least that alike have a key in common. Lengths are in characters.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SLACK = 1e-9  # rounding never makes a limit tighter


def _whole(x: Column) -> Column:
    return F.floor(x).cast("int")


def _edits(likeness: float, longest: Column) -> Column:
    return _whole(longest * (1.0 - likeness) + _SLACK)


def _cuts(length: Column, edits: Column) -> Column:
    """Number, start and size of each of `edits` + 1 segments, the longer ones last."""
    parts = edits + 1
    size = _whole(length / parts)
    plain = parts - (length - size * parts)
    return F.transform(F.sequence(F.lit(0), edits), lambda i: F.struct(
        i.alias("i"), (i * size + F.greatest(F.lit(0), i - plain)).alias("start"),
        (size + (i >= plain).cast("int")).alias("size")))


def _checked(likeness: float) -> float:
    if not 0.5 < likeness <= 1:
        raise ValueError("segments tell strings apart from a likeness above one half on")
    return likeness


def _key(length: Column, edits: Column, number: Column, part: Column) -> Column:
    return F.xxhash64(length, edits, number, part)


def segments(text: Column, likeness: float) -> Column:
    """Array of the keys of the segments of `text`, for partners of every possible length."""
    t = _checked(likeness)
    length = F.length(text)
    most = _edits(t, _whole(length / t + _SLACK))
    return F.array_distinct(F.flatten(F.transform(
        F.sequence(_edits(t, length), most), lambda k: F.transform(
            _cuts(length, k), lambda x: _key(length, k, x["i"],
                                             F.substring(text, x["start"] + 1, x["size"]))))))


def windows(text: Column, likeness: float) -> Column:
    """Array of the keys of the substrings of `text` that may be a partner's segment.

    With k edits in all and lengths that differ by d, a segment is shifted by
    (d - k) / 2 to (d + k) / 2 places.
    """
    t = _checked(likeness)
    own = F.length(text)
    shortest, longest = F.ceil(own * t - _SLACK).cast("int"), _whole(own / t + _SLACK)

    def of_length(length: Column) -> Column:
        edits = _edits(t, F.greatest(length, own))
        ahead = _whole((edits + own - length) / 2)
        back = _whole((edits - own + length) / 2)

        def of_segment(x: Column) -> Column:
            first = F.greatest(F.lit(0), x["start"] - back)
            last = F.least(own - x["size"], x["start"] + ahead)
            return F.when(first <= last, F.transform(F.sequence(first, last), lambda at: _key(
                length, edits, x["i"], F.substring(text, at + 1, x["size"])))).otherwise(F.array())

        return F.flatten(F.transform(_cuts(length, edits), of_segment))

    return F.array_distinct(F.flatten(F.transform(F.sequence(shortest, longest), of_length)))
