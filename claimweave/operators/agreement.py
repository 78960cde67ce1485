"""Which fields two records must agree on to be able to reach a score.

The weighted score adds discrete parts (phone, email, address, birth date) and
two name similarities that equality keys cannot capture. Giving both names full
marks leaves a bound the discrete parts must reach; the smallest combinations
that reach it are the join keys. Every pair at or above the threshold agrees on
at least one of them, so joining on these keys loses nothing.

Where the discrete parts only just suffice, full marks for both names means that
the names are equal. With `by_names` equal names are one more field: unlike ones
leave a loss of at least UNLIKE of one name's weight. That holds for names of up
to SHORT_NAME bytes; longer ones count as equal to each other.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from itertools import product

ADDRESS_COLUMNS = {None: (), "zip": ("zip",), "city": ("zip", "city"),
                   "street": ("zip", "city", "street")}

SHORT_NAME = 48
# Two names that differ, one of them with at most SHORT_NAME bytes, lose a third of 1/49 of the
# Jaro score at least, of which the longest common prefix gives back four tenths.
UNLIKE = Decimal("0.004")


@dataclass(frozen=True)
class Model:
    """Weights, levels and threshold of the weighted score."""

    last_name: str = "0.20"
    first_name: str = "0.15"
    dob: str = "0.25"
    phone: str = "0.20"
    address: str = "0.10"
    email: str = "0.10"
    threshold: str = "0.70"
    dob_levels: tuple = (("equal", "1.0"), ("near", "0.9"), ("year", "0.6"), ("swap", "0.5"))
    address_levels: tuple = (("street", "1.0"), ("city", "0.8"), ("zip", "0.5"))
    by_names: bool = False  # candidates also by equal names; the accepted pairs are the same


@dataclass(frozen=True)
class Agreement:
    columns: tuple[str, ...]
    dob: tuple[str, ...]  # birth-date relations that count; empty = any
    names: bool = False  # equal first and last names, or longer than SHORT_NAME


def _dominates(big: tuple, small: tuple) -> bool:
    return all(b >= s for b, s in zip(big, small))


def agreements(model: Model) -> list[Agreement] | None:
    """Smallest sufficient field combinations, or None if names alone could suffice."""
    need = (Decimal(model.threshold) - Decimal("0.0005") - Decimal("1e-9")
            - Decimal(model.last_name) - Decimal(model.first_name))
    # what equal names are worth more than the best unlike ones
    equal = UNLIKE * min(Decimal(model.last_name), Decimal(model.first_name))
    name_kinds, need = ((0, 1), need + equal) if model.by_names else ((0,), need)
    places = [(None, Decimal(0))] + [(n, Decimal(v)) for n, v in reversed(model.address_levels)]
    dobs = [(None, Decimal(0))] + [(n, Decimal(v)) for n, v in model.dob_levels]

    def minimal(dob_value: Decimal) -> list[tuple]:
        enough = [
            (p, e, a, n) for p, e, a, n in product((0, 1), (0, 1), range(len(places)), name_kinds)
            if dob_value * Decimal(model.dob) + p * Decimal(model.phone)
            + e * Decimal(model.email) + places[a][1] * Decimal(model.address)
            + n * equal >= need
        ]
        return [c for c in enough if not any(o != c and _dominates(c, o) for o in enough)]

    undated = minimal(Decimal(0))
    if (0, 0, 0, 0) in undated:
        return None
    kinds: dict[tuple, list] = {combo: [] for combo in undated}
    for name, value in dobs[1:]:
        for combo in minimal(value):
            if not any(_dominates(combo, u) for u in undated):
                kinds.setdefault(combo, []).append(name)
    return [
        Agreement(tuple(c for c, on in (("phone", combo[0]), ("email", combo[1])) if on)
                  + ADDRESS_COLUMNS[places[combo[2]][0]], tuple(names), bool(combo[3]))
        for combo, names in kinds.items()
    ]
