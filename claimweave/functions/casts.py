"""Text-to-type rules of the cleaned layer, as column expressions.

None of them fails on bad input: what cannot be read becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def title_case(col) -> Column:
    """First letter upper, the rest lower; NULL reads as the empty string."""
    t = F.trim(_c(col))
    return F.concat_ws("", F.upper(F.left(t, F.lit(1))), F.lower(F.substr(t, F.lit(2))))


def digits_only(col, strip_country_code: bool = False) -> Column:
    """Digits of a phone number; on request without the leading 1 of an 11-digit one."""
    digits = F.regexp_replace(_c(col), "[^0-9]", "")
    if strip_country_code:
        digits = F.regexp_replace(digits, r"^1(\d{10})$", "$1")
    return digits


def npi(col) -> Column:
    t = F.trim(_c(col))
    return F.when(t.rlike("^[0-9]{10}$"), t)


def one_of(col, values) -> Column:
    t = F.lower(F.trim(_c(col)))
    return F.when(t.isin(*values), t)


def one_of_exact(col, values) -> Column:
    t = F.trim(_c(col))
    return F.when(t.isin(*values), t)


def one_of_or(col, values, default: str) -> Column:
    t = F.upper(F.trim(_c(col)))
    return F.when(t.isin(*values), t).otherwise(F.lit(default))


def _iso_day(col) -> Column:
    """Year-month-day text with `-`, `/` or a space between the parts, rewritten with `-`."""
    return F.regexp_replace(F.trim(_c(col)), r"^(\d{4})([-/ ])(\d{1,2})\2(\d{1,2})", "$1-$3-$4")


def to_date(col) -> Column:
    """Whole dates only: Spark alone would also take `2024` and `2024-01`."""
    t = _iso_day(col)
    return F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}($|[ T]\d{1,2}:)"), t.try_cast("date"))


def to_timestamp(col) -> Column:
    """Timestamp without zone; a bare day is midnight, a bare time is not accepted."""
    t = F.regexp_replace(_iso_day(col), r"^(\S+) +", "$1 ")
    ok = t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}($|[ T]\d{1,2}:\d)")
    return F.when(ok, t.try_cast("timestamp_ntz"))


def to_int(col) -> Column:
    """Integers, also written with a fraction or exponent; halves round away from zero."""
    t = F.trim(_c(col))
    ok = t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.when(ok, F.round(t.try_cast("decimal(38,10)"), 0).try_cast("int"))


def to_decimal(col, precision: int, scale: int) -> Column:
    return _c(col).try_cast(f"decimal({precision},{scale})")


def to_bool(col) -> Column:
    c = _c(col)
    return F.when(c == F.trim(c), c.try_cast("boolean"))


RULES = {
    "text": lambda c: F.trim(c),
    "upper": lambda c: F.upper(F.trim(c)),
    "lower": lambda c: F.lower(F.trim(c)),
    "title": title_case,
    "digits": digits_only,
    "prefix": lambda c, n: F.left(F.trim(c), F.lit(n)),
    "npi": npi,
    "one_of": one_of,
    "one_of_exact": one_of_exact,
    "one_of_or": one_of_or,
    "date": to_date,
    "timestamp": to_timestamp,
    "int": to_int,
    "decimal": to_decimal,
    "bool": to_bool,
}


def clean_value(name: str, rule: str, *args) -> Column:
    return RULES[rule](F.col(name), *args)


def key_text(name: str, rule: str) -> Column:
    """The text a key column is grouped by: trimmed, in the case its rule gives it."""
    t = F.trim(F.col(name))
    if rule in ("upper", "one_of_or"):
        return F.upper(t)
    if rule in ("lower", "one_of"):
        return F.lower(t)
    return t
