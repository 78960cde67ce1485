"""Repeated line runs, by a suffix array over line sequences; later copies are deleted.

Suffixes of the documents' line sequences are ranked by prefix doubling: ranks
of runs of 2^k lines come from pairs of ranks of half that length, sorted. All
suffixes with a common prefix of n lines form one interval of the suffix array,
whose smallest place is the first copy of that run. Only runs that occur twice
stay in the doubling, so unique lines cost one hash. A line goes if it lies in
a run of at least `min_words` words of which an earlier copy exists.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .pieces import slices
from .storage import stored, unused

MIN_WORDS = 5
WORD = r"[^\x20\x09-\x0D]+"


def _document(text: str, id_column: str) -> Column:
    return F.struct(F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"))


def lines(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc, place, line_no, h1, h2, words) of every line with a word.

    `doc` is the id with a hash of the text, so that rows of one id with other
    texts are documents of their own. `place` counts such lines within the
    document, `line_no` all of them; the line's identity is a 128-bit hash of
    its exact characters.
    """
    numbered = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(
        i.alias("line_no"), x.alias("line"), F.regexp_count(x, F.lit(WORD)).alias("words")))
    with_words = F.filter(numbered, lambda x: x["words"] > 0)
    return (docs.select(_document(text, id_column).alias("doc"), F.posexplode(with_words).alias("place", "x"))
            .select("doc", "place", "x.line_no", F.xxhash64("x.line").alias("h1"),
                    F.xxhash64(F.lit(1), "x.line").alias("h2"), "x.words"))


def _ranked(runs: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Rows whose key occurs twice or more, with the key's rank in sorted order."""
    several = runs.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    # sorted by range, ids rise with the order of the keys
    ranks = stored(several.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()),
                   f"{label}-ranks")
    return stored(runs.join(ranks, keys).drop(*keys), label)


def _next(runs: DataFrame, gap: int) -> DataFrame:
    """Each run with the rank of the run that begins `gap` lines after it."""
    later = runs.select("doc", (F.col("place") - gap).alias("place"), F.col("rank").alias("after"))
    return runs.join(later, ["doc", "place"])


def _needed(all_lines: DataFrame, min_words: int) -> DataFrame:
    """Shortest runs of `min_words` words or more that begin or end at each repeated line."""
    def shortest(words: Column) -> Column:
        total = F.aggregate(words, F.struct(F.lit(0).alias("n"), F.lit(0).alias("sum")),
                            lambda s, w: F.when(s["sum"] >= min_words, s).otherwise(
                                F.struct((s["n"] + 1).alias("n"), (s["sum"] + w).alias("sum"))))
        return F.when(total["sum"] >= min_words, total["n"])

    # every line here has a word, so min_words of them are enough; a gap ends the run
    near = Window.partitionBy("doc").orderBy("place")
    ahead = F.collect_list(F.struct("place", "words")).over(near.rowsBetween(0, min_words - 1))
    behind = F.collect_list(F.struct("place", "words")).over(near.rowsBetween(1 - min_words, 0))
    placed = all_lines.select("doc", "place", ahead.alias("ahead"), behind.alias("behind"))

    def joined(rows: Column, step: int) -> Column:
        row = F.filter(rows, lambda x, i: x["place"] == F.col("place") + i * step)
        return F.transform(row, lambda x: x["words"])

    forward = shortest(joined(F.col("ahead"), 1))
    backward = shortest(joined(F.reverse("behind"), -1))
    return placed.select("doc", F.explode(F.array(
        F.struct(F.col("place").alias("place"), forward.alias("n")),
        F.struct((F.col("place") - backward + 1).alias("place"), backward.alias("n"))
    )).alias("run")).select("doc", "run.place", "run.n").filter("n is not null").distinct()


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text",
                 id_column: str = "doc_id") -> DataFrame:
    """(doc, line_no) of every line in a run of `min_words` words with an earlier copy.

    Documents are in order of their ids (null first), lines in order of their
    place; the first copy of every line stays. Repeated rows, alike in id and
    text, count as one document and lose the same lines.
    """
    found = stored(lines(docs, text, id_column).dropDuplicates(["doc", "place"]), "lines")
    level = _ranked(found, ["h1", "h2"], "runs-0")
    here = level.select("doc", "place", "line_no")
    runs = stored(_needed(level, min_words), "needed")
    longest = runs.agg(F.max("n")).first()[0] or 0
    size, later = 1, None
    level = level.select("doc", "place", "rank")
    while size <= longest:
        # runs of size to 2 * size - 1 lines are told by their first and last `size` lines
        first = runs.filter(F.col("n").between(size, 2 * size - 1)).join(level, ["doc", "place"])
        last = level.select("doc", F.col("place").alias("_end"), F.col("rank").alias("after"))
        told = (first.withColumn("_end", F.col("place") + F.col("n") - size)
                .join(last, ["doc", "_end"]).drop("_end"))
        told = stored(told, f"told-{size}")
        # an interval of the suffix array; its smallest place is the first copy
        # stored, so that either side of the join comes straight from a shuffle and the adaptive
        # skew join can split the interval of a very frequent line
        interval = stored(told.groupBy("n", "rank", "after").agg(
            F.min(F.struct("doc", "place")).alias("first"), F.count("*").alias("_n"))
            .filter("_n > 1").drop("_n"), f"intervals-{size}")
        copies = (told.join(interval, ["n", "rank", "after"])
                  .filter(F.struct("doc", "place") > F.col("first"))
                  .select("doc", F.explode(F.sequence("place", F.col("place") + F.col("n") - 1))
                          .alias("place")))
        later = copies if later is None else later.unionByName(copies)
        if 2 * size <= longest:
            level = _ranked(_next(level, size).withColumnRenamed("rank", "before"),
                            ["before", "after"], f"runs-{2 * size}")
        size *= 2
    if later is None:
        return here.select("doc", "line_no").limit(0)
    return later.distinct().join(here, ["doc", "place"]).select("doc", "line_no")


def _without(batches: Iterator[pa.RecordBatch], text: str, count: bool) -> Iterator[pa.RecordBatch]:
    """The last column lists the lines to leave out; `delete_repeats` does the same without Python."""
    for batch in slices(batches):
        at, last = batch.schema.get_field_index(text), batch.num_columns - 1
        texts, lists = batch.column(at).to_pylist(), batch.column(last).to_pylist()
        for i, gone in enumerate(lists):
            if gone:
                gone = set(gone)
                texts[i] = "\n".join(x for n, x in enumerate(texts[i].split("\n"))
                                     if n not in gone)
        arrays = [pa.array(texts, pa.string()) if i == at else batch.column(i)
                  for i in range(last)]
        if count:
            arrays.append(pa.array([len(x or ()) for x in lists], pa.int32()))
        yield pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(len(arrays))])


def _kept(x: Column) -> Column:
    """The lines of `x.lines` whose numbers are not in the sorted `x.gone`, joined again.

    They are cut out as the stretches between the numbers, so the work is linear in the lines.
    """
    edges = F.concat(F.array(F.lit(-1)), x["gone"], F.array(F.size(x["lines"])))
    starts = F.slice(edges, F.lit(1), F.size(edges) - 1)
    stretches = F.zip_with(starts, F.slice(edges, F.lit(2), F.size(edges) - 1), lambda a, b:
                           F.slice(x["lines"], a + 2, b - a - 1))
    return F.array_join(F.flatten(stretches), "\n")


def delete_repeats(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text",
                   id_column: str = "doc_id", count_column: str | None = "n_removed") -> DataFrame:
    """The rows of `docs`, their texts without later copies of runs.

    Lines without a word stay, and null texts. A document is never removed; its
    text may become empty. `count_column`, if named, gets the number of removed
    lines, in place of a column of that name; all other columns stay. The lines
    are left out in place: no batch of whole texts leaves the executor's heap.
    """
    if count_column:
        docs = docs.drop(count_column)
    doc, lines_gone = unused("_doc", docs), unused("_gone", docs)
    gone = (later_copies(docs, min_words, text, id_column)
            .groupBy(F.col("doc").alias(doc)).agg(F.collect_list("line_no").alias(lines_gone)))
    joined = docs.withColumn(doc, _document(text, id_column)).join(gone, doc, "left")
    # an array of one, as each text is to be split once
    once = F.array(F.struct(F.split(text, "\n", -1).alias("lines"),
                            F.array_sort(lines_gone).alias("gone")))
    left = F.when(F.col(lines_gone).isNull(), F.col(text)).otherwise(
        F.transform(once, _kept)[0])
    count = [F.coalesce(F.array_size(lines_gone), F.lit(0)).alias(count_column)] if count_column else []
    return joined.select(*[left.alias(c) if c == text else F.col(c) for c in docs.columns], *count)
