import random
import re

import pyarrow as pa
import pytest

from claimweave.llm import line_runs


def plain(rows, min_words):
    """Texts without later copies, by comparing the shortest long enough runs one by one."""
    def size(line):
        return len(re.findall(r"[^\x20\x09-\x0D]+", line))

    def runs(sizes):
        for i in range(len(sizes)):
            for step in (1, -1):
                total, j = 0, i
                while 0 <= j < len(sizes):
                    total += sizes[j]
                    if total >= min_words:
                        yield min(i, j), max(i, j)
                        break
                    j += step

    seen, out = set(), {}
    for key in sorted({(i is not None, i or 0, t) for i, t in rows if t is not None}):
        lines = key[2].split("\n")
        kept = [(n, x) for n, x in enumerate(lines) if size(x)]
        gone = set()
        for a, b in sorted(set(runs([size(x) for _, x in kept]))):
            run = tuple(x for _, x in kept[a:b + 1])
            if run in seen:
                gone |= {n for n, _ in kept[a:b + 1]}
            seen.add(run)
        out[key[1:]] = "\n".join(x for n, x in enumerate(lines) if n not in gone)
    return out


@pytest.mark.parametrize("min_words,seed", [(1, 1), (5, 2), (9, 3), (30, 4)])
def test_matches_plain_version(frame, min_words, seed):
    rng = random.Random(seed)
    lines = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(0, 7))) for _ in range(12)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(0, 20)))) for i in range(30)]
    rows += [(90, rows[3][1]), (91, "before\n" + rows[3][1] + "\nafter")]
    got = line_runs.delete_repeats(frame(rows), min_words).collect()
    want = plain(rows, min_words)
    assert {r["doc_id"]: r["text"] for r in got} == {i: want[i, t] for i, t in rows}


def test_odd_rows_and_columns(frame, odd_rows):
    docs = frame(odd_rows, clashing=True)
    got = line_runs.delete_repeats(docs, 5)
    assert sorted(got.columns) == sorted(docs.columns)
    assert line_runs.delete_repeats(docs, 5, count_column=None).columns == docs.columns
    rows = got.collect()
    assert len(rows) == len(odd_rows) and sum(r["text"] is None for r in rows) == 2
    # rows without an id come first; later copies of their text lose all lines
    assert [r["text"] for r in rows if r["doc_id"] in (1, 2)] == [""] * 3
    first = [r for r in rows if r["doc_id"] is None and r["text"]]
    assert len(first) == 1 and first[0]["text"] == odd_rows[0][1]
    assert all(r["text"] == t for r in rows for i, t in odd_rows
               if r["doc_id"] == i and i in (4, 5, 7, 9, 10, 11))


def test_rows_of_one_id_with_other_texts(frame):
    rows = [(1, "one two three four five six"), (1, "seven eight nine ten eleven twelve"),
            (2, "seven eight nine ten eleven twelve\none two three four five six")]
    got = {(r["doc_id"], r["n_removed"]) for r in line_runs.delete_repeats(frame(rows)).collect()}
    assert got == {(1, 0), (2, 2)}


def test_empty_table_and_no_repeats(frame):
    assert line_runs.delete_repeats(frame([])).collect() == []
    assert line_runs.delete_repeats(frame([(1, "a b c d e f")])).first()["text"] == "a b c d e f"


def test_lines_are_left_out_of_few_rows_at_once():
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(1200)), pa.array(["a\nb\nc"] * 1200),
         pa.array([[i % 3] if i % 2 else None for i in range(1200)], pa.list_(pa.int32()))],
        ["doc_id", "text", "gone"])
    got = list(line_runs._without(iter([batch]), "text", True))
    assert max(x.num_rows for x in got) <= 500
    rows = [row for x in got for row in zip(*(c.to_pylist() for c in x.columns))]
    left = {0: "b\nc", 1: "a\nc", 2: "a\nb"}
    assert rows == [(i, left[i % 3] if i % 2 else "a\nb\nc", i % 2) for i in range(1200)]


def test_no_batch_of_texts_leaves_the_heap(frame):
    same = "\n".join(f"a line of five words {i}" for i in range(3000))
    rows = [(1, same), (2, "own\n" + same + "\n\nend"), (3, None), (4, "own\n" + same)]
    got = line_runs.delete_repeats(frame(rows))
    assert "InArrow" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r["doc_id"], r["text"], r["n_removed"]) for r in got.collect()} == {
        (1, same, 0), (2, "own\n\nend", 3000), (3, None, 0), (4, "", 3001)}
