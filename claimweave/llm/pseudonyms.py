"""Format-preserving pseudonyms for personal data.

Values are found by pattern and validated (check digits, real dates, octets in
range); a keyed Feistel network then permutes them within their own format. The
same value has the same pseudonym in every document, different values have
different ones, and a checked number stays valid.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator
from functools import partial
from hashlib import blake2b
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

KEY_SETTING = "spark.claimweave.pseudonymKey"
TEST_KEY = "key for tests, set your own"
ROUNDS = 8
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Feistel:
    """Keyed permutations of sequences of symbols with a radix each."""

    def __init__(self, key: str):
        self.key = blake2b(key.encode(), digest_size=32).digest()

    def _drawn(self, kind: str, turn: int, shape: tuple, half: tuple, size: int) -> int:
        told = repr((kind, turn, shape, half)).encode()
        n = (size.bit_length() + 7) // 8 + 8
        out, at = b"", 0
        while len(out) < n:
            out += blake2b(told + bytes([at]), key=self.key, digest_size=64).digest()
            at += 1
        return int.from_bytes(out[:n]) % size

    def permute(self, kind: str, symbols: list[int], radices: list[int]) -> list[int]:
        """Another sequence of the same radices; a bijection for each kind and shape.

        The halves change in turn: the number one half stands for is moved, within
        its range, by an amount drawn from the other half.
        """
        cut, shape = len(symbols) // 2, tuple(radices)
        halves = [list(symbols[:cut]), list(symbols[cut:])]
        ranges = [radices[:cut], radices[cut:]]
        for turn in range(ROUNDS):
            side = turn % 2
            moved, size = 0, prod(ranges[side])
            for symbol, radix in zip(halves[side], ranges[side]):
                moved = moved * radix + symbol
            moved = (moved + self._drawn(kind, turn, shape, tuple(halves[1 - side]), size)) % size
            for i in range(len(halves[side]) - 1, -1, -1):
                moved, halves[side][i] = divmod(moved, ranges[side][i])
        return halves[0] + halves[1]

    def within(self, kind: str, value: int, size: int) -> int:
        """A permutation of 0 .. size - 1: bits are permuted until the result is in range."""
        bits = max(2, (size - 1).bit_length())
        while True:
            permuted = self.permute(kind, [value >> i & 1 for i in range(bits)], [2] * bits)
            value = sum(b << i for i, b in enumerate(permuted))
            if value < size:
                return value

    def characters(self, kind: str, text: str) -> str:
        """Digits, small and capital ASCII letters change within their class; others stay."""
        classes = [next((c for c in (_DIGITS, _LOWER, _UPPER) if x in c), None) for x in text]
        places = [i for i, c in enumerate(classes) if c]
        new = self.permute(kind, [classes[i].index(text[i]) for i in places],
                           [len(classes[i]) for i in places])
        out = list(text)
        for i, symbol in zip(places, new):
            out[i] = classes[i][symbol]
        return "".join(out)


def _digits_into(text: str, digits: str) -> str:
    rest = iter(digits)
    return "".join(next(rest) if c in _DIGITS else c for c in text)


def luhn_digit(digits: str) -> str:
    """The digit that makes `digits` and it pass the check of card numbers."""
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d)
                for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def _card(text: str, net: Feistel) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    body = net.characters("card", digits[:-1])
    return _digits_into(text, body + luhn_digit(body))


def _iban_check(country: str, rest: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97


def _iban(text: str, net: Feistel) -> str | None:
    plain = text.replace(" ", "")
    country, rest = plain[:2], plain[4:]
    if not 15 <= len(plain) <= 34 or f"{_iban_check(country, rest):02d}" != plain[2:4]:
        return None
    new = net.characters("iban" + country, rest)
    told = iter(f"{country}{_iban_check(country, new):02d}{new}")
    return "".join(c if c == " " else next(told) for c in text)


def _day(at: dt.date, net: Feistel) -> dt.date:
    """The pseudonym of a date. Days above the twelfth stay above it, others below: so a date that
    can be read in one order only still can, and no two dates are written alike."""
    new = at
    while True:
        new = dt.date.fromordinal(FIRST_DAY + net.within(
            "date", new.toordinal() - FIRST_DAY, LAST_DAY - FIRST_DAY + 1))
        if (new.day > 12) == (at.day > 12):
            return new


def _date(text: str, net: Feistel) -> str | None:
    """Year first, else day first, else month first where only that makes a date."""
    parts = re.split(r"[-/.]", text)
    orders = ["ymd"] if len(parts[0]) == 4 else ["dmy", "mdy"]
    for order in orders:
        told = dict(zip(order, map(int, parts)))
        try:
            at = dt.date(told["y"], told["m"], told["d"])
        except ValueError:
            continue
        new = _day(at, net)
        written = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        return text[len(parts[0])].join(written[x] for x in order)
    return None


def _address(text: str, net: Feistel) -> str | None:
    octets = [int(x) for x in text.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    return ".".join(map(str, net.permute("ip", octets, [256] * 4)))


def _phone(text: str, net: Feistel) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 8 <= len(digits) <= 15:
        return None
    country = re.match(r"\+\d{1,3}(?=\D)|", text).group()  # stays
    return country + net.characters("phone", text[len(country):])


def _social(text: str, net: Feistel) -> str | None:
    area, group, serial = text.split("-")
    if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000":
        return None
    # each part stays in its own range of valid numbers
    areas = [a for a in range(1, 900) if a != 666]
    new = net.permute("ssn", [areas.index(int(area)), int(group) - 1, int(serial) - 1],
                      [len(areas), 99, 9999])
    return f"{areas[new[0]]:03d}-{new[1] + 1:02d}-{new[2] + 1:04d}"


def _mail(text: str, net: Feistel) -> str:
    name, domain = text.rsplit("@", 1)
    return f"{net.characters('mail', name)}@{domain}"


def _secret(text: str, net: Feistel) -> str:
    label, value = re.fullmatch(r"([^=:]*[=:]\s*[\"'])(.*)", text).groups()
    return label + net.characters("secret", value)


# at each place the first kind whose pattern matches and whose value is valid counts
KINDS: tuple[tuple[str, str, Callable[[str, Feistel], str | None]], ...] = (
    ("mail", r"(?<![\w.+-])[\w.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", _mail),
    ("date", r"(?<![\d./-])(?:(?:19|20)\d\d([-/.])\d\d\1\d\d|\d\d([-/.])\d\d\2(?:19|20)\d\d)"
             r"(?![./-]?\d)", _date),
    ("ip", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", _address),
    ("iban", r"(?<!\w)[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", _iban),
    ("ssn", r"(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-])", _social),
    ("card", r"(?<!\d)\d(?:[ -]?\d){12,}(?!\d)", _card),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\d)"
              r"|(?<![\w(])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
              r"|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])", _phone),
    ("secret", r"(?i:\b(?:token|password|passwd|secret|api_?key))\s*[=:]\s*[\"'][^\"'\n]{6,}", _secret),
)
_PATTERNS = [(name, re.compile(pattern), make) for name, pattern, make in KINDS]
_NUMBER = re.compile(r"\d+")


def _usual(sizes: list[int]) -> bool:
    """Whether digits of card numbers are written in such groups."""
    return len(sizes) == 1 or sizes in ([4, 6, 4], [4, 6, 5]) or \
        all(n == 4 for n in sizes[:-1]) and sizes[-1] <= 4


def _cards(pattern: re.Pattern, text: str, net: Feistel) -> Iterator[tuple[int, int, str]]:
    """Valid numbers among neighbouring groups of digits, whatever short numbers are next to them.

    The whole run of groups comes first, then what is grouped like a card
    number, then any other groups; of those the first and longest.
    """
    for run in pattern.finditer(text):
        groups = [m.span() for m in _NUMBER.finditer(text, *run.span())]
        sizes = [b - a for a, b in groups]
        free = [True] * len(groups)
        for allowed in (lambda i, j: j - i == len(sizes), lambda i, j: _usual(sizes[i:j]),
                        lambda i, j: True):
            i = 0
            while i < len(groups):
                ends, total, j = [], 0, i
                while j < len(groups) and free[j] and total + sizes[j] <= 19:
                    total += sizes[j]
                    j += 1
                    if total >= 13 and allowed(i, j):
                        ends.append(j)
                i += 1
                for j in reversed(ends):
                    start, end = groups[i - 1][0], groups[j - 1][1]
                    new = _card(text[start:end], net)
                    if new is not None:
                        yield start, end, new
                        free[i - 1:j] = [False] * (j - i + 1)
                        i = j
                        break


def _ibans(pattern: re.Pattern, text: str, net: Feistel) -> Iterator[tuple[int, int, str]]:
    """Valid numbers, without words in capitals that follow them."""
    match = pattern.search(text)
    while match:
        start, at = match.start(), match.start() + 1
        told = match.group()
        while told:
            new = _iban(told, net)
            if new is not None:
                at = start + len(told)
                yield start, at, new
                break
            told = told.rpartition(" ")[0]
        match = pattern.search(text, at)


# kinds whose pattern may take a neighbour along
_PARTS = {"card": _cards, "iban": _ibans}
# every kind but secrets has a digit or an @; a text without either, "=" and ":" is left alone
_HINT = re.compile(r"[0-9@=:]")


def pseudonymise(text: str, net: Feistel) -> tuple[str, list[tuple[str, int, int]]]:
    """`text` with pseudonyms, and (kind, start, end) of the values found in the original."""
    if not _HINT.search(text):
        return text, []
    found: list[tuple[int, int, str, str]] = []
    for name, pattern, make in _PATTERNS:
        if name in _PARTS:
            found += [(start, end, name, new) for start, end, new in _PARTS[name](pattern, text, net)]
            continue
        for match in pattern.finditer(text):
            start, end = match.span()
            new = make(match.group(), net)
            if new is not None:
                found.append((start, end, name, new))
    rank = {name: i for i, (name, _, _) in enumerate(_PATTERNS)}
    found.sort(key=lambda f: (f[0], rank[f[2]]))
    out, spans, at = [], [], 0
    for start, end, name, new in found:
        if start >= at:
            out += [text[at:start], new]
            spans.append((name, start, end))
            at = end
    return "".join([*out, text[at:]]), spans


def _rewrite(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    net = Feistel(key)
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                     ("stop", pa.int32())]))
    for batch in batches:
        texts, spans = [], []
        for text in batch.column(1).to_pylist():
            new, found = (None, []) if text is None else pseudonymise(text, net)
            texts.append(new)
            spans.append([{"kind": k, "start": a, "stop": b} for k, a, b in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(spans, spans_type)],
            ["id", "text", "found"])


def pseudonyms(docs: DataFrame, key: str, text: str = "text",
               id_column: str = "doc_id") -> DataFrame:
    """(id, text, found) of every row: the text with pseudonyms, and what was found.

    `found` lists kind, start and stop (characters of the original text). Null
    texts stay null and have nothing found; repeated rows are treated alike;
    other columns are ignored. Values that fail their check are left as they are.
    """
    span = T.StructType([T.StructField("kind", T.StringType()),
                         T.StructField("start", T.IntegerType()),
                         T.StructField("stop", T.IntegerType())])
    schema = T.StructType([docs.schema[id_column], T.StructField("text", T.StringType()),
                           T.StructField("found", T.ArrayType(span))])
    return docs.select(id_column, text).mapInArrow(partial(_rewrite, key=key), schema)
