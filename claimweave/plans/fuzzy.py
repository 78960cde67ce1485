"""Weighted fuzzy matching across systems."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.similarity import jaro_winkler_column
from ..operators.agreement import SHORT_NAME, Agreement, Model, agreements
from ..operators.segments import segments, windows
from ..operators.skew import attach, meet
from ..session import stored

COMPONENTS = ("last_name_score", "first_name_score", "dob_score", "phone_score",
              "address_score", "email_score")
TRAITS = ("first", "last", "dob", "phone", "email", "street", "city", "zip")


def _filled(column: str) -> Column:
    return F.when(F.col(column) != "", F.col(column))


def with_profile(spine: DataFrame) -> DataFrame:
    """Spine records with the traits that are compared and a digest of them."""
    traits = spine.select(
        "nid", F.col("source_system").alias("system"),
        F.lower("first_name").alias("first"), F.lower("last_name").alias("last"), "dob",
        _filled("phone").alias("phone"), _filled("email").alias("email"),
        F.lower("address_line1").alias("street"),
        F.lower(F.coalesce("city", F.lit(""))).alias("city"), _filled("zip").alias("zip"))
    marked = [F.coalesce(F.col(t).cast("string"), F.lit("\0")) for t in TRAITS]
    return traits.withColumn("profile", F.md5(F.concat_ws("\x1f", "system", *marked)))


def profiles(tagged: DataFrame) -> DataFrame:
    """Distinct trait combinations per system; `rep` is the smallest record of each.

    Copies of a record, however many, are compared once.
    """
    return tagged.groupBy("profile", "system", *TRAITS).agg(
        F.min("nid").alias("rep"), F.count("*").alias("n"))


def _same_day_of(shifted: Column) -> Column:
    return F.when(F.dayofmonth(shifted) == F.dayofmonth("dob"), shifted)


def _dob_variants(kind: str) -> list[Column]:
    d = F.col("dob")
    if kind == "equal":
        return [d]
    if kind == "near":
        return [F.date_add(d, k) for k in (-2, -1, 1, 2)]
    if kind == "year":
        return [_same_day_of(F.add_months(d, k)) for k in (-12, 12)]
    if kind == "swap":
        return [F.when(F.dayofmonth(d) <= 12,
                       F.make_date(F.year(d), F.dayofmonth(d), F.month(d)))]
    raise ValueError(kind)


def _short(name: str) -> Column:
    return F.when(F.octet_length(name) > SHORT_NAME, F.lit("\0long")).otherwise(F.col(name))


def _keys(sets: list[Agreement], shifted: bool) -> Column:
    keys = []
    for number, wanted in enumerate(sets):
        usable = F.lit(True)
        names = ("first", "last") if wanted.names else ()
        for column in (*wanted.columns, *names):
            usable = usable & F.col(column).isNotNull()
        dates = [F.lit(None).cast("date")]
        if wanted.dob:
            dates = [v for k in wanted.dob for v in _dob_variants(k)] if shifted else [F.col("dob")]
        for day in dates:
            ok = usable & day.isNotNull() if wanted.dob else usable
            keys.append(F.when(ok, F.xxhash64(F.lit(number), *wanted.columns,
                                              *[_short(n) for n in names], day)))
    return F.explode(F.array_distinct(F.filter(F.array(*keys), lambda k: k.isNotNull())))


def _block_keys(shifted: bool) -> Column:
    """Keys of the plain blocks: name start, birth year within one, phone, zip."""
    start = F.left("last", F.lit(3))
    year = F.year("dob")
    keys = [F.when(start.isNotNull(), F.xxhash64(F.lit(0), start)),
            F.when(F.col("phone").isNotNull(), F.xxhash64(F.lit(2), "phone")),
            F.when(F.col("zip").isNotNull(), F.xxhash64(F.lit(3), "zip"))]
    for k in ((-1, 0, 1) if shifted else (0,)):
        keys.append(F.when(year.isNotNull(), F.xxhash64(F.lit(1), year + k)))
    return F.explode(F.filter(F.array(*keys), lambda k: k.isNotNull()))


def match_keys(model: Model) -> tuple[Column, Column]:
    """Exploded keys of a profile as the smaller system's and as the larger one's.

    Two profiles that could reach the threshold share a key.
    """
    sets = agreements(model)
    if sets is None:
        return _block_keys(True), _block_keys(False)
    return _keys(sets, True), _keys(sets, False)


def _sides(people: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The profiles of `people` with a larger system in `others`, and those of `others` with a
    smaller one in `people`; the rest are in no pair of systems, so they need no keys."""
    least, most = people.agg(F.min("system")).first()[0], others.agg(F.max("system")).first()[0]
    return people.filter(F.col("system") < F.lit(most)), others.filter(F.col("system") > F.lit(least))


def candidates(people: DataFrame, rows: int, model: Model = Model(), mode: str = "pruned",
               against: DataFrame | None = None) -> DataFrame:
    """(rep_a, rep_b): profile pairs of different systems that could reach the threshold.

    `pruned` joins on the agreements the threshold implies; `blocks` joins on
    the plain blocks, which is also the way taken when no agreement is implied.
    One narrow join on an 8-byte key serves all keys. A hash collision only adds
    a pair that scoring drops. `against` gives other profiles for the second
    side; `rows` bounds both.
    """
    sets = agreements(model) if mode == "pruned" else None
    if sets is None:
        left_keys, right_keys, per_row = _block_keys(True), _block_keys(False), 6
    else:
        left_keys, right_keys = _keys(sets, True), _keys(sets, False)
        per_row = sum(len(_dob_variants(k)) for s in sets for k in s.dob) + len(sets)
    smaller, larger = _sides(people, people if against is None else against)
    left = smaller.select(left_keys.alias("k"), F.col("rep").alias("rep_a"),
                          F.col("system").alias("sa"))
    right = larger.select(right_keys.alias("k"), F.col("rep").alias("rep_b"),
                          F.col("system").alias("sb"))
    return (meet(left, right, "k", "rep_a", "rep_b", rows * per_row)
            .filter(F.col("sa") < F.col("sb")).select("rep_a", "rep_b").distinct())


def _in_block() -> Column:
    same_start = F.left("last_a", F.lit(3)) == F.left("last_b", F.lit(3))
    close_year = F.abs(F.year("dob_a") - F.year("dob_b")) <= 1
    blocks = (same_start, close_year, F.col("phone_a") == F.col("phone_b"),
              F.col("zip_a") == F.col("zip_b"))
    out = F.lit(False)
    for block in blocks:
        out = out | F.coalesce(block, F.lit(False))
    return out


def _dob_relation() -> dict[str, Column]:
    a, b = F.col("dob_a"), F.col("dob_b")
    return {
        "equal": a == b,
        "near": F.abs(F.datediff(a, b)) <= 2,
        "year": (F.month(a) == F.month(b)) & (F.dayofmonth(a) == F.dayofmonth(b))
        & (F.abs(F.year(a) - F.year(b)) == 1),
        "swap": (F.year(a) == F.year(b)) & (F.month(a) == F.dayofmonth(b))
        & (F.dayofmonth(a) == F.month(b)),
    }


def _place_relation() -> dict[str, Column]:
    zips = F.col("zip_a") == F.col("zip_b")
    city = zips & (F.col("city_a") == F.col("city_b"))
    return {"street": city & (F.col("street_a") == F.col("street_b")), "city": city, "zip": zips}


def _level(relations: dict[str, Column], levels, weight: str | None) -> Column:
    """First relation that holds, as its level, or as level times weight."""
    def value(level):
        if weight is None:
            return F.lit(Decimal(level)).cast("decimal(4,3)")
        return F.lit(float(Decimal(level) * Decimal(weight)))
    out = None
    for name, level in levels:
        out = (F if out is None else out).when(relations[name], value(level))
    return out.otherwise(value("0"))


def score(pairs: DataFrame, people: DataFrame, model: Model = Model()) -> DataFrame:
    """Score profile pairs; keep those at or above the threshold, with all components."""
    def side(tag):
        return people.select(F.col("rep").alias(f"rep_{tag}"),
                             *[F.col(t).alias(f"{t}_{tag}") for t in TRAITS])

    dob, place = _dob_relation(), _place_relation()
    phone = {"same": F.col("phone_a") == F.col("phone_b")}
    email = {"same": F.col("email_a") == F.col("email_b")}
    yes = (("same", "1.0"),)
    wide = pairs.join(side("a"), "rep_a").join(side("b"), "rep_b").filter(_in_block())
    named = wide.select(
        "rep_a", "rep_b",
        jaro_winkler_column(F.col("last_a"), F.col("last_b")).alias("_last"),
        jaro_winkler_column(F.col("first_a"), F.col("first_b")).alias("_first"),
        _level(dob, model.dob_levels, model.dob).alias("_dob"),
        _level(phone, yes, model.phone).alias("_phone"),
        _level(place, model.address_levels, model.address).alias("_place"),
        _level(email, yes, model.email).alias("_email"),
        _level(dob, model.dob_levels, None).alias("dob_score"),
        _level(phone, yes, None).alias("phone_score"),
        _level(place, model.address_levels, None).alias("address_score"),
        _level(email, yes, None).alias("email_score"))
    total = (F.col("_last") * float(model.last_name) + F.col("_first") * float(model.first_name)
             + F.col("_dob") + F.col("_phone") + F.col("_place") + F.col("_email"))
    return (named.withColumn("confidence", F.round(total, 3).cast("decimal(4,3)"))
            .filter(F.col("confidence") >= F.lit(Decimal(model.threshold)))
            .select("rep_a", "rep_b", "confidence",
                    F.col("_last").cast("decimal(4,3)").alias("last_name_score"),
                    F.col("_first").cast("decimal(4,3)").alias("first_name_score"),
                    "dob_score", "phone_score", "address_score", "email_score"))


def fuzzy_members(tagged: DataFrame, people: DataFrame, scored: DataFrame,
                  rows: int) -> DataFrame:
    """(nid, rep, confidence): records of matched profiles with their best score."""
    best = (scored.select(F.col("rep_a").alias("rep"), "confidence")
            .unionByName(scored.select(F.col("rep_b").alias("rep"), "confidence"))
            .groupBy("rep").agg(F.max("confidence").alias("confidence")))
    matched = people.select("profile", "rep", "n").join(best, "rep")
    return attach(tagged.select("nid", "profile"), matched, "profile", "nid", rows).select(
        "nid", "rep", "confidence")


def record_pairs(scored: DataFrame, members: DataFrame, rows: int) -> DataFrame:
    """Profile pairs written out as record pairs, as large as the answer itself.

    A profile with many records is spread by pairs of rows in either join.
    `rows` bounds the rows of the members and of the pairs of profiles.
    """
    def side(tag):
        return members.select(F.col("rep").alias(f"rep_{tag}"), F.col("nid").alias(f"nid_{tag}"))

    half = stored(meet(scored, side("a"), "rep_a", "rep_b", "nid_a", rows), "pair-halves")
    return meet(half, side("b"), "rep_b", "nid_a", "nid_b", max(rows, half.count())).drop(
        "rep_a", "rep_b")


def _likeness(left: str, right: str) -> Column:
    """One minus the edit distance over the longer length; NULL gives 0."""
    longest = F.greatest(F.length(left), F.length(right))
    ratio = 1.0 - F.levenshtein(left, right) / longest
    return F.coalesce(F.when(longest > 0, ratio).otherwise(F.lit(1.0)), F.lit(0.0))


EDIT_THRESHOLD = "0.75"
EDIT_NAME, EDIT_DOB, EDIT_PLACE = 0.3, 0.2, 0.2
EDIT_KEYS = 1000  # keys of one record, for names of usual length


def name_likeness(threshold: str, place: float) -> float:
    """How alike both names must be in sum, at an address score of `place` and equal birth years."""
    # a score counts from half a thousandth below the threshold on
    least = float(threshold) - 0.0005 - 1e-9
    return (least - EDIT_DOB - EDIT_PLACE * place) / EDIT_NAME


def edit_candidates(people: DataFrame, rows: int, threshold: str = EDIT_THRESHOLD) -> DataFrame:
    """(rep_a, rep_b): profile pairs of different systems that the edit-distance score can accept.

    Without an equal zip nearly all must come from the names, so both have a
    segment in common. With an equal zip, or zip and city, the better name
    alone is that alike; with an equal street there is nothing to derive, and
    the address is the key. Nothing is lost; names may be NULL, which counts as
    empty.
    """
    levels = dict(Model().address_levels)
    both = min(1.0, name_likeness(threshold, 0.0) - 1)
    better = min(1.0, name_likeness(threshold, float(Decimal(levels["city"]))) / 2)
    first, last = (F.coalesce(F.col(c), F.lit("")) for c in ("first", "last"))

    def keys(take) -> Column:
        names = F.flatten(F.transform(take(last, both), lambda x: F.transform(
            take(first, both), lambda y: F.xxhash64(F.lit(0), x, y))))
        near = [F.when(F.col("zip").isNotNull(), F.transform(
            take(name, better), lambda x: F.xxhash64(F.lit(number), "zip", x)))
            for number, name in ((1, last), (2, first))]
        home = F.when(F.col("zip").isNotNull() & F.col("street").isNotNull(),
                      F.array(F.xxhash64(F.lit(3), "zip", "city", "street")))
        return F.explode(F.flatten(F.array(
            names, *(F.coalesce(x, F.array().cast("array<bigint>")) for x in (*near, home)))))

    smaller, larger = _sides(people, people)
    left = smaller.select(keys(segments).alias("k"), F.col("rep").alias("rep_a"),
                          F.col("system").alias("sa"))
    right = larger.select(keys(windows).alias("k"), F.col("rep").alias("rep_b"),
                          F.col("system").alias("sb"))
    # one record's keys are bounded by the length of its names
    return (meet(left, right, "k", "rep_a", "rep_b", rows * EDIT_KEYS)
            .filter(F.col("sa") < F.col("sb")).select("rep_a", "rep_b").distinct())


def edit_distance_score(pairs: DataFrame, people: DataFrame,
                        threshold: str = EDIT_THRESHOLD) -> DataFrame:
    """Alternative score of the given profile pairs that lie in a plain block: 0.3 first name,
    0.3 last name, 0.2 birth-year distance, 0.2 address; pairs from `threshold` on."""
    traits = ("first", "last", "dob", "phone", "street", "city", "zip")

    def side(tag):
        return people.select(F.col("rep").alias(f"rep_{tag}"),
                             *[F.col(t).alias(f"{t}_{tag}") for t in traits])

    wide = (pairs.join(side("a"), "rep_a").join(side("b"), "rep_b").filter(_in_block())
            .withColumn("address_score", _level(_place_relation(), Model().address_levels, None)))
    years = F.abs(F.year("dob_a") - F.year("dob_b"))
    dated = F.coalesce(1.0 - F.least(years, F.lit(100)) / 100.0, F.lit(0.0))
    total = (_likeness("first_a", "first_b") * EDIT_NAME + _likeness("last_a", "last_b") * EDIT_NAME
             + dated * EDIT_DOB + F.col("address_score").cast("double") * EDIT_PLACE)
    return (wide.withColumn("edit_score", F.round(total, 3).cast("decimal(4,3)"))
            .filter(F.col("edit_score") >= F.lit(Decimal(threshold)))
            .select("rep_a", "rep_b", "edit_score"))
