import random

import numpy as np
import pytest

from claimweave.llm import decontaminate as d

STOCK = [f"w{i}" for i in range(400)]


def sentence(rng, n):
    return " ".join(rng.choices(STOCK, [1 / (i + 3) for i in range(len(STOCK))], k=n))


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(1)
    items = [(i, sentence(rng, rng.randrange(10, 70)) + f". Answer: unique{i} w{i}") for i in range(30)]
    rows, leaks = [], set()
    for i in range(200):
        text = sentence(rng, rng.randrange(20, 400)).split()
        if i % 4 == 0:
            item = items[i // 4 % 30]
            told = item[1].split()
            if i % 8 == 0:  # a paraphrase: every sixth word another
                told = [w if k % 6 != 2 else f"other{k}" for k, w in enumerate(told)]
            at = rng.randrange(len(text))
            text[at:at] = told
            leaks.add((i, item[0]))
        rows.append((i, " ".join(text)))
    return rows, items, leaks


def pairs(found):
    return {(r["doc_id"], r["item_id"]) for r in found.collect()}


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_subsequence_by_bits():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(0, 12))] for _ in range(2))
        assert d.common_subsequence(np.array(a, int), np.array(b, int)) == plain_lcs(a, b)


def test_planted_items_are_found(spark, frame, planted):
    rows, items, leaks = planted
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = d.contaminated(frame(rows), bench)
    assert pairs(found) == leaks
    assert pairs(d.contaminated(frame(rows), bench, items_at_once=7)) == leaks


def test_cosine_candidates_against_brute_force(spark, frame, planted):
    """Every document and item whose words pass the checks, compared without the latent space."""
    rows, items, leaks = planted
    brute = set()
    for i, text in rows:
        words = text.lower().replace(".", " ").replace(":", " ").split()
        for item, told in items:
            target = told.lower().replace(".", " ").replace(":", " ").split()
            for at in range(0, max(1, len(words) - len(target) + 1)):
                part = words[max(0, at - 4):at + len(target) + 4]
                if len(set(part) & set(target)) >= 0.5 * len(set(target)) and \
                        plain_lcs(target, part) >= d.COMMON * len(target):
                    brute.add((i, item))
                    break
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = pairs(d.contaminated(frame(rows), bench))
    assert len(brute & found) >= 0.9 * len(brute)


def test_verbatim_items_of_all_lengths(spark, frame):
    rng = random.Random(7)
    few = " ".join(rng.choices(["red", "green", "blue", "black", "white"], k=30))
    items = [(i, sentence(rng, n)) for i, n in enumerate((8, 60, 90, 91, 128, 300, 320, 321, 1000))]
    items += [(20, few), (21, "hapax"), (22, "hapax legomenon"), (23, "three rare ones"),
              (24, "seven words that stand in one text"), (25, "three rare ones")]
    rows = [(i, sentence(rng, rng.randrange(100, 500))) for i in range(60)]
    for i, told in items:
        for copy in range(3):
            text = sentence(rng, rng.randrange(100, 1500)).split()
            at = rng.randrange(len(text))
            rows.append((1000 + 10 * i + copy, " ".join([*text[:at], told, *text[at:]])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = pairs(d.contaminated(frame(rows), bench))
    leaks = {(1000 + 10 * i + copy, i) for i, _ in items for copy in range(3)}
    assert leaks <= found
    assert not {p for p in found if p[0] < 1000 and p[1] in (20, 21, 22, 23, 24, 25)}


def test_sketch_does_not_depend_on_partitions(frame, planted):
    docs = frame(planted[0])
    one, many = (d.latent_space(docs.repartition(n)).table for n in (1, 7))
    assert np.allclose(one @ one.T[:, :50], many @ many.T[:, :50], atol=1e-3)


def test_packed_sums_are_the_sketch(frame, planted):
    """TF'(TF S) by dense matrices, and the passages of each feature."""
    rows = planted[0]
    tf = []
    for _, hashed in d.document_words([t for _, t in rows]):
        features = (hashed & np.uint64(d.FEATURES - 1)).astype(int)
        tf += [np.bincount(features[at:at + d.PASSAGE], minlength=d.FEATURES)
               for at in range(0, len(features), d.PASSAGE)]
    tf = np.array(tf)
    want = tf.T @ (tf @ d._signs().astype(int))
    batch = frame(rows).select("text").toArrow().combine_chunks().to_batches()[0]
    (got,) = d._sketched(iter([batch]))
    got = got.to_pandas().set_index("feature")
    assert got.loc[-1, "found"] == len(tf)
    told = got.drop(index=-1)
    assert (told["found"].to_numpy() == (tf > 0).sum(axis=0)[told.index]).all()
    assert (told.drop(columns="found").to_numpy() == want[told.index]).all()
    assert set(told.index) == set(np.flatnonzero(tf.sum(axis=0)))


def test_a_single_text(spark, frame, planted):
    _, items, _ = planted
    rng = random.Random(9)
    docs = frame([(1, f"{sentence(rng, 90)} {items[3][1]} {sentence(rng, 90)}")])
    assert d.latent_space(docs).table.shape[1] <= d.PROJECTED
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert pairs(d.contaminated(docs, bench)) == {(1, 3)}
    assert d.latent_space(frame([])).table.shape == (d.FEATURES + 1, d.PROJECTED)


def test_answers():
    assert d.answer_of("Question: what? Answer: blue") == "blue"
    assert d.answer_of("First. Second one.\n") == "Second one."
    assert d.answer_of("Answer:") == "Answer:"


def test_odd_rows(spark, frame, odd_rows):
    items = [(1, odd_rows[0][1].split("\n")[0]), (1, odd_rows[0][1].split("\n")[0]), (2, None),
             (3, ""), (4, "!!!"), (5, "no such words anywhere in it at all"), (None, "x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = pairs(d.contaminated(frame(odd_rows, clashing=True), bench))
    assert {(1, 1), (2, 1), (None, 1), (7, None)} <= got
    assert not {i for _, i in got} & {2, 3, 4, 5}
    assert pairs(d.contaminated(frame([]), bench)) == set()
    assert pairs(d.contaminated(frame(odd_rows), bench.limit(0))) == set()
