"""Organisation and person names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Legal forms dropped from the end of an organisation name.
LEGAL_FORMS = ("LLC", "INC", "CORP", "LLP", "PLLC", "PA", "PC", r"P\.A\.", r"P\.C\.")


def organisation_name(col, strict: bool = False) -> Column:
    """Upper-cased name without its legal form.

    By default the form may follow without a space, so `GRAND SPA` loses `PA`;
    `strict` asks for a separator before the form and removes it with it.
    """
    gap = r"[\s,]+" if strict else r"\s*"
    pattern = rf"(?i){gap}({'|'.join(LEGAL_FORMS)})\s*$"
    return F.trim(F.regexp_replace(F.upper(col), pattern, ""))


def name_part(col, index: int) -> Column:
    """First (1) or last (-1) word of a name that has a space, else `Unknown`."""
    c = F.col(col) if isinstance(col, str) else col
    part = F.trim(F.split_part(c, F.lit(" "), F.lit(index)))
    return F.coalesce(F.when(c.contains(" "), part), F.lit("Unknown"))


def split_full_name(col) -> tuple[Column, Column]:
    """(first word, everything after it), empty where missing."""
    c = F.col(col) if isinstance(col, str) else col
    words = F.split(c, " ", 2)
    return (F.coalesce(F.get(words, F.lit(0)), F.lit("")),
            F.coalesce(F.get(words, F.lit(1)), F.lit("")))
