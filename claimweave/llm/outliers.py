"""Quality rules and robust multivariate outliers, with DataFrame functions only.

Rules on words, symbols and repetition fail a document outright. The others are
judged together, by language and source: their statistics, transformed to a
comparable scale, get a location and covariance by minimum covariance
determinant (several deterministic starts, concentration steps over the nearer
three quarters, then one reweighting), and a vector too far off by Mahalanobis
distance is rejected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import stored

SPACES = " \t\n\x0b\f\r"
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
WINDOW = 8
SIZE = 5                    # statistics in a vector
# least standard deviation of each, so that one that is nearly always zero does not decide alone
FLOORS = (0.7, 0.1, 0.5, 0.7, 0.8)
LEAST_ROWS = 50             # smaller groups are pooled by language, then over all; below it all stay
NEARER = 0.75
STEPS = 4
CHI_MEDIAN, CHI_975 = 4.351, 12.833   # of the chi-squared distribution with 5 degrees of freedom
CUTOFF = 20.0
SALTS = 16


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of `value`, which is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _words(text: Column) -> Column:
    return let(F.btrim(text, F.lit(SPACES)), lambda t: F.when(
        t == "", F.array().cast("array<string>")).otherwise(F.split(t, GAP)))


def _window_hashes(words: Column) -> Column:
    """Hashes of all runs of 8 words, by doubling."""
    def doubled(hashes: Column, gap: int) -> Column:
        return let(hashes, lambda h: let(F.greatest(F.size(h) - gap, F.lit(0)), lambda n: F.zip_with(
            F.slice(h, 1, n), F.slice(h, gap + 1, n), lambda a, b: F.xxhash64(a, b))))

    single = F.transform(words, lambda w: F.xxhash64(w))
    return doubled(doubled(doubled(single, 1), 2), 4)


def _repeated_words(hashes: Column) -> Column:
    """Words covered by windows that occur twice or more."""
    def covered(sorted_windows: Column) -> Column:
        def same(x, i):
            return F.coalesce(F.get(sorted_windows, i)["h"] == x["h"], F.lit(False))

        places = F.sort_array(F.transform(
            F.filter(sorted_windows, lambda x, i: same(x, i - 1) | same(x, i + 1)),
            lambda x: x["i"]))
        return F.aggregate(
            places, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
            lambda s, p: F.struct((p + WINDOW).alias("end"),
                                  (s["n"] + p + WINDOW - F.greatest(s["end"], p)).alias("n")))["n"]

    # most texts repeat nothing, which counting different hashes tells without sorting
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
               .otherwise(let(F.sort_array(F.transform(h, lambda x, i: F.struct(
                   x.alias("h"), i.alias("i")))), covered)))


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def statistics(docs: DataFrame, text: str = "text", id_column: str = "doc_id",
               lang: str = "lang", source: str = "source") -> DataFrame:
    """(id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed).

    Null texts count as empty. Repeated rows are counted each.
    """
    counted = docs.select(
        F.col(id_column), F.col(lang).alias("lang"), F.col(source).alias("source"),
        F.coalesce(F.col(text), F.lit("")).alias("_text")).select(
        id_column, "lang", "source",
        let(_words(F.col("_text")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeated_words(_window_hashes(w)).alias("n_repeat_words"))).alias("_of"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _repeated_lines(F.col("_text")).alias("n_dup_lines"))
    return counted.select(
        id_column, "lang", "source", "_of.n_words", "_of.word_chars", "n_symbols", "n_dup_lines",
        "_of.n_repeat_words",
        ((F.col("_of.n_words") < 20)
         | (100 * F.col("_of.n_repeat_words") > 30 * F.col("_of.n_words"))).alias("base_failed"))


def vector() -> Column:
    """Transformed statistics; logarithms bring counts and shares to similar spreads."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return F.array(F.log1p("n_words"), F.log(chars / words),
                   F.log1p(100 * F.col("n_symbols") / chars), F.log1p("n_dup_lines"),
                   F.log1p(100 * F.col("n_repeat_words") / words))


def _attach(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Join a table with one row per key; rows of a hot key are spread over salts."""
    many = rows.withColumn("_salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    one = table.withColumn("_salt", F.explode(F.lit(list(range(SALTS)))))
    return many.join(one, [key, "_salt"]).drop("_salt")


def _quantiles(binned: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """For each key the first bin at which the given share of rows is reached."""
    along = Window.partitionBy(*keys).orderBy("bin")
    whole = Window.partitionBy(*keys)
    return (binned.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
            .withColumn("upto", F.sum("n").over(along))
            .withColumn("all", F.sum("n").over(whole))
            .groupBy(*keys).agg(*[F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("bin")))
                                  .alias(name) for name, share in shares.items()]))


def _start(rows: DataFrame) -> DataFrame:
    """Squared distances by two starts: scaled by quartiles, summed up or the largest."""
    fine = 64  # bins per unit
    each = rows.select("cell", F.posexplode("x").alias("at", "value")).select(
        "cell", "at", F.floor(F.col("value") * fine).alias("bin"))
    quartiles = _quantiles(each, ["cell", "at"], {"low": 0.25, "mid": 0.5, "high": 0.75})
    per_cell = quartiles.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct(
        "at", ((F.col("mid") + 0.5) / fine).alias("mid"),
        ((F.col("high") - F.col("low")) / (1.349 * fine)).alias("scale")))).alias("q"))
    joined = _attach(rows, per_cell, "cell")
    floors = F.array(*map(F.lit, FLOORS))
    off = F.zip_with("x", F.zip_with("q", floors, lambda q, f: F.struct(
        q["mid"].alias("mid"), F.greatest(q["scale"], f).alias("scale"))),
        lambda x, q: (x - q["mid"]) / q["scale"])
    starts = joined.withColumn("off", off).select("row", "cell", "x", F.explode(F.array(
        F.struct(F.lit(0).alias("start"), F.aggregate(
            "off", F.lit(0.0), lambda s, v: s + v * v).alias("d2")),
        F.struct(F.lit(1).alias("start"), F.array_max(
            F.transform("off", lambda v: v * v)).alias("d2")))).alias("s"))
    return starts.select("row", "cell", F.struct("cell", "s.start").alias("unit"), "x", "s.d2")


def _bin(d2: Column) -> Column:
    return F.floor(F.log(d2 + 1e-9) * 32)


def _estimate(chosen: DataFrame) -> DataFrame:
    """(unit, m, p, logdet): mean, inverse covariance and log determinant of each unit's rows.

    The covariance has the squared floors added to its diagonal, and is inverted
    by sweeping its pivots in turn.
    """
    x = [F.col("x")[i] for i in range(SIZE)]
    moments = chosen.groupBy("unit").agg(
        F.array(*map(F.avg, x)).alias("m"),
        F.array(*[F.covar_pop(x[i], x[j]) + (FLOORS[i] ** 2 if i == j else 0)
                  for i in range(SIZE) for j in range(SIZE)]).alias("c"))

    def swept(state: Column, k: Column) -> Column:
        c = state["c"]

        def at(i, j):
            return F.get(c, i * SIZE + j)

        def cell(ij: Column) -> Column:
            i, j = F.floor(ij / SIZE).cast("int"), ij % SIZE
            pivot = at(k, k)
            return (F.when((i == k) & (j == k), -1 / pivot).when(i == k, at(k, j) / pivot)
                    .when(j == k, at(i, k) / pivot).otherwise(at(i, j) - at(i, k) * at(k, j) / pivot))

        return F.struct(F.transform(F.lit(list(range(SIZE * SIZE))), cell).alias("c"),
                        (state["logdet"] + F.log(at(k, k))).alias("logdet"))

    done = F.aggregate(F.lit(list(range(SIZE))),
                       F.struct(F.col("c"), F.lit(0.0).alias("logdet")), swept)
    return moments.select("unit", "m", done.alias("done")).select(
        "unit", "m", F.transform("done.c", lambda v: -v).alias("p"), "done.logdet")


def _distance() -> Column:
    off = [F.col("x")[i] - F.col("m")[i] for i in range(SIZE)]
    terms = [off[i] * off[j] * F.col("p")[i * SIZE + j] * (1 if i == j else 2)
             for i in range(SIZE) for j in range(i, SIZE)]
    return sum(terms[1:], terms[0])


def _measured(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    return (_attach(rows.drop("d2"), estimates, "unit")
            .withColumn("d2", F.greatest(_distance(), F.lit(0.0))).drop("m", "p", "logdet"))


def _scaled(rows: DataFrame) -> DataFrame:
    """Distances reduced to the median that the chi-squared distribution has, if theirs is larger.

    A smaller median comes from the floors and is left, for these are the spread to judge by.
    """
    median = _quantiles(rows.select("unit", _bin(F.col("d2")).alias("bin")), ["unit"],
                        {"mid": 0.5})
    factor = F.greatest(F.exp((F.col("mid") + 0.5) / 32) / CHI_MEDIAN, F.lit(1.0))
    return (_attach(rows, median, "unit").withColumn("d2", F.col("d2") / factor).drop("mid"))


def robust_distances(rows: DataFrame) -> DataFrame:
    """(row, d2) for rows (row, cell, x): squared distance within the row's cell."""
    current = stored(_start(rows), "mcd-start")
    for step in range(STEPS):
        limit = _quantiles(current.select("unit", _bin(F.col("d2")).alias("bin")), ["unit"],
                           {"most": NEARER})
        nearer = _attach(current, limit, "unit").filter(_bin(F.col("d2")) <= F.col("most"))
        estimates = stored(_estimate(nearer), f"mcd-estimate-{step}")
        current = stored(_measured(current, estimates), f"mcd-step-{step}")
    # of the starts, the one with the smallest determinant; the first of equal ones
    best = estimates.groupBy(F.col("unit.cell").alias("cell")).agg(
        F.min(F.struct("logdet", "unit.start")).alias("best")).select(
        F.struct(F.col("cell"), F.col("best.start").alias("start")).alias("unit"))
    chosen = stored(_scaled(_attach(current, best, "unit")), "mcd-chosen")
    final = _estimate(chosen.filter(F.col("d2") <= CHI_975))
    return _scaled(_measured(chosen, final)).select("row", "d2")


def judged(docs: DataFrame, text: str = "text", id_column: str = "doc_id", lang: str = "lang",
           source: str = "source", cutoff: float = CUTOFF, least_rows: int = LEAST_ROWS) -> DataFrame:
    """The columns of `statistics`, `d2` and `kept` of every row.

    Estimates cover all rows that pass the rules. Groups with fewer than
    `least_rows` such rows are pooled with the small ones of their language, and
    these with those of the other languages; what is still too small to estimate
    from is kept and has no distance. A null language or source is a group of its
    own. Rows that fail the rules have no distance and are not kept.
    """
    table = stored(statistics(docs, text, id_column, lang, source)
                   .withColumn("row", F.monotonically_increasing_id())
                   .withColumn("x", vector()), "quality")
    named = table.filter("not base_failed").select(
        "row", "x", F.to_json(F.struct("lang", "source"), {"ignoreNullFields": "false"})
        .alias("own"), F.to_json(F.struct("lang"), {"ignoreNullFields": "false"}).alias("wider"))

    def cells(rows: DataFrame, key: str, other: Column) -> DataFrame:
        size = rows.groupBy(key).agg(F.count("*").alias("size"))
        return (_attach(rows, size, key)
                .withColumn(key, F.when(F.col("size") >= least_rows, F.col(key)).otherwise(other))
                .drop("size"))

    first = cells(named, "own", F.concat(F.lit("small groups of "), F.col("wider")))
    second = cells(first.withColumnRenamed("own", "cell"), "cell", F.lit("small groups"))
    sizes = second.groupBy("cell").agg(F.count("*").alias("size"))
    usable = stored(_attach(second, sizes, "cell").filter(F.col("size") >= least_rows)
                    .select("row", "cell", "x"), "quality-cells")
    return table.join(robust_distances(usable), "row", "left").select(
        id_column, "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "d2",
        (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)).alias("kept"))
