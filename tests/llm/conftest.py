import os
import random
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_words import words  # noqa: E402

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])
# columns with names that the operators use themselves
CLASHING = T.StructType([*SCHEMA.fields, *(T.StructField(n, T.StringType()) for n in (
    "id", "fp", "doc", "_doc", "_gone", "_id", "n_removed", "score", "row", "cell", "label", "n"))])

SENTENCES = [
    "The quick brown fox jumps over the lazy dog while nine others watch it from afar.",
    "Der schnelle Fuchs springt über den faulen Hund und läuft danach in den Wald zurück.",
    "Le renard brun saute par-dessus le chien paresseux, puis s'en va vers la forêt là-bas.",
    "El zorro marrón salta sobre el perro perezoso y después vuelve despacio al bosque."]
LANGS = ("en", "de", "fr", "es")


@pytest.fixture
def frame(spark):
    """Documents of (doc_id, text), with rows of one id and clashing columns as asked for."""
    def make(rows, clashing=False):
        full = [(i, t, LANGS[(i or 0) % 4], f"s{(i or 0) % 3}", len(t or "")) for i, t in rows]
        if clashing:
            full = [(*r, *["x"] * (len(CLASHING.fields) - len(SCHEMA.fields))) for r in full]
        return spark.createDataFrame(full, CLASHING if clashing else SCHEMA)
    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    rng = random.Random(3)
    long = " ".join(words(rng, 12) + "." + "\n" * (i % 3 == 0) for i in range(4000))
    same = "\n".join(SENTENCES)
    return [(1, same), (2, same), (2, same), (3, None), (4, ""), (5, " \n\t\n "), (6, long),
            (None, same), (None, None), (7, "x"), (8, "\n".join(reversed(SENTENCES))),
            (9, "日本語のテキスト。" * 40), (10, "a" * 70000), (11, "🙂é " * 30)]
