"""The operators as queries over a folder of test tables, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (bpe, chunks, collocations, decontaminate, langid, line_runs, outliers,
               periodic_runs, prefix_counts, pseudonyms, quality, simhash, toxicity)

TOKEN_LIMIT = 512


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(_documents(spark, sf_dir))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"),
                        "component_id")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_documents(spark, sf_dir),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op3_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return line_runs.delete_repeats(docs)


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(pseudonyms.KEY_SETTING, pseudonyms.TEST_KEY)
    return pseudonyms.pseudonyms(_documents(spark, sf_dir), key).select(
        "doc_id", "text", F.size("found").alias("n_found"),
        F.array_join(F.array_distinct(F.col("found.kind")), ",").alias("kinds"))


def op5_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judged(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    held_out = langid.fold("doc_id", 4) == 2
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out)
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(_documents(spark, sf_dir), benchmark)


def op8_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = prefix_counts.prefix_counts(_documents(spark, sf_dir),
                                          public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens",
                          (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op9_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.whole_passages(_documents(spark, sf_dir))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    held_out = langid.fold("doc_id", 5) == 0
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    held_out = langid.fold("doc_id", 3) == 1
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out)
    model = quality.fit(docs, labels)
    return quality.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def planted_order(doc_id: int | None, n_words: int) -> np.ndarray | None:
    """Places of the words that make a tenth of the documents periodic from some word on.

    Those without an id are left as they are.
    """
    if doc_id is None or not n_words:
        return None
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return None
    start = g % n_words
    period = 1 + (n_words - start) // (3 + g % 8)
    places = np.arange(n_words)
    places[start:] = start + (places[start:] - start) % period
    return places


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_documents(spark, sf_dir), order_of=planted_order)
    best = periodic_runs.longest("runs")
    told = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_simhash, op2_byte_bpe, op3_line_runs, op4_pseudonyms, op5_outliers, op6_toxicity,
        op7_decontaminate, op8_prefix_counts, op9_chunks, op10_langid, op11_quality, op12_periodic_runs,
        op13_collocations, pipeline)}


COLLOCATIONS_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
        coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
sequences AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w
    FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM sequences WHERE len(w) > 0),
phrases AS (
    SELECT lang, w[i:i + k - 1] AS words, count(*) AS f
    FROM places, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM phrases WHERE len(words) = 1 GROUP BY lang),
frequent AS (SELECT lang, words, f FROM phrases WHERE f >= 100),
spans AS (
    SELECT lang, f, words, unnest(range(2, len(words))) AS k FROM frequent WHERE len(words) > 2),
inner_phrases AS (
    SELECT lang, f, words[i:i + k - 1] AS words
    FROM (SELECT *, unnest(range(1, len(words) - k + 2)) AS i FROM spans)),
hidden AS (
    SELECT DISTINCT s.lang, s.words
    FROM inner_phrases AS b JOIN frequent AS s ON s.lang = b.lang AND s.words = b.words
    WHERE 100 * b.f >= 100 * s.f),
cuts AS (
    SELECT c.lang, c.words, c.f AS a, k, x.f AS l, y.f AS r,
           (1000 * c.f::HUGEINT * t.n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score, t.n
    FROM (SELECT *, unnest(range(1, len(words))) AS k FROM frequent
          ANTI JOIN hidden USING (lang, words)) AS c
    JOIN frequent AS x ON x.lang = c.lang AND x.words = c.words[1:k]
    JOIN frequent AS y ON y.lang = c.lang AND y.words = c.words[k + 1:]
    JOIN totals AS t ON t.lang = c.lang),
lowest AS (
    SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score
    FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest QUALIFY rank <= 2000
"""


def all_sql() -> dict[str, str]:
    """DuckDB SQL where a method's result can be told in it; tests hold the others against plain
    versions."""
    return {"op13_collocations": COLLOCATIONS_SQL}
