import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimweave.llm import bpe, prefix_counts as pc

RANKS = P.path("byte_bpe_50k.tiktoken")
LIBRARY = P.path("byte_bpe_50k.json")
ALPHABET = list("aeHt's  \n\t'’re ll ve1²½ـ \x1c\x85　!?<|>endoftxé中") + ["<|endoftext|>", "'re", "   "]


@pytest.fixture(scope="module")
def parts():
    ranks = bpe.read_ranks(RANKS)
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    worker = pc._Worker(*pc.read_library_file(LIBRARY))
    return bpe.Vocabulary(ranks), theirs, worker.ready(), Tokenizer.from_file(LIBRARY)


def test_perfect_hash_is_minimal():
    keys = [f"key {i}".encode() for i in range(5000)]
    table = bpe.PerfectHash(keys)
    assert sorted(table.find(k) for k in keys) == list(range(5000))
    assert table.find(b"no key") == -1 and bpe.PerfectHash([]).find(b"x") == -1


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=30).map("".join) | st.text(max_size=40))
def test_ids_and_counts_are_the_libraries(parts, text):
    vocabulary, theirs, (table, special), library = parts
    ids = bpe.encode_text(text, bpe.PieceCache(vocabulary))
    assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(text)
    assert bpe.decode_ids(ids, vocabulary.bytes_of) == text.encode()
    counts = np.cumsum(pc.text_steps(text, table, special)).tolist()
    assert counts == [len(library.encode(text[:n], add_special_tokens=False).ids)
                      for n in range(1, len(text) + 1)]


def test_all_code_points(parts):
    vocabulary, theirs, (table, special), library = parts
    rng = random.Random(5)
    text = "".join(chr(rng.choice([rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x110000)]))
                   for _ in range(30000))
    ids = bpe.encode_text(text, bpe.PieceCache(vocabulary))
    assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(text)
    assert pc.text_steps(text, table, special).sum() == len(
        library.encode(text, add_special_tokens=False).ids)


def test_cuts_of_long_texts_change_nothing(parts, monkeypatch):
    from claimweave.llm import pieces
    vocabulary, theirs, (table, special), library = parts
    text = "it's  what we've said\n\n and 12 more\t things " * 50
    monkeypatch.setattr(pieces, "SEGMENT_CHARS", 37)
    ids = bpe.encode_text(text, bpe.PieceCache(vocabulary))
    assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(text)
    assert pc.text_steps(text, table, special).sum() == len(library.encode(text).ids)


def test_round_trip_of_odd_rows(frame, odd_rows, parts):
    theirs = parts[1]
    docs = frame(odd_rows, clashing=True)
    got = bpe.round_trip(docs, RANKS).collect()
    want = []
    for i, text in odd_rows:
        ids = theirs.encode_ordinary(text or "")
        data = np.array(ids, "<u4").tobytes()
        want.append((i or -1, len(ids), hashlib.sha256(data).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted((r[0] or -1, *r[1:]) for r in got) == sorted(want)
    back = bpe.decode(bpe.encode(docs, RANKS), RANKS).collect()
    assert sorted(bytes(r["bytes"]) for r in back) == sorted((t or "").encode() for _, t in odd_rows)


def test_counts_of_odd_rows_and_stored_prefixes(frame, odd_rows, parts):
    library = parts[3]
    counted = pc.prefix_counts(frame(odd_rows, clashing=True), LIBRARY)
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in counted.collect())
    assert got == sorted((i or -1, len((t or "").encode()), len(library.encode(t or "").ids))
                         for i, t in odd_rows)
    asked = counted.filter("doc_id = 8").select(
        pc.count_at(F.col("prefix_steps"), F.lit(25)).alias("at"),
        pc.fitting_prefix(F.col("prefix_steps"), F.lit(10)).alias("fit")).first()
    text = next(t for i, t in odd_rows if i == 8)
    sizes = [len(library.encode(text[:n]).ids) for n in range(len(text) + 1)]
    assert asked["at"] == sizes[25]
    assert asked["fit"] == max(n for n, size in enumerate(sizes) if size <= 10)


def test_empty_tables(frame):
    assert bpe.round_trip(frame([]), RANKS).count() == 0
    assert pc.prefix_counts(frame([]), LIBRARY).count() == 0
