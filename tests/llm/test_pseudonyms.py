import datetime as dt
import random
import re

import pytest

from claimweave.llm.pseudonyms import Feistel, luhn_digit, pseudonymise, pseudonyms

NET = Feistel("k")


def card(rng, n=16):
    body = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return body + luhn_digit(body)


@pytest.mark.parametrize("radices", [[10, 10], [10] * 3, [26, 10, 2], [7], [2] * 9])
def test_permutation(radices):
    every = [[]]
    for r in radices:
        every = [[*x, s] for x in every for s in range(r)]
    assert sorted(NET.permute("t", x, radices) for x in every) == every
    assert NET.permute("t", every[0], radices) != Feistel("other").permute("t", every[0], radices) \
        or len(radices) < 3


def test_within_is_a_permutation():
    assert sorted(NET.within("d", i, 77) for i in range(77)) == list(range(77))


def test_formats_and_checks():
    rng = random.Random(1)
    number = card(rng)
    text = (f"Card {number}, {number[:4]} {number[4:8]} {number[8:12]} {number[12:]}. Mail "
            "jo.Doe7@mail1.example.com or call +1 (017) 555-7713 / 555-123-4567; born 1984-02-29, "
            "29.02.1984; at 10.0.255.1; ssn 123-45-6789; iban GB82 WEST 1234 5698 7654 32; "
            'token = "04dbebab91ab85687d33"')
    new, spans = pseudonymise(text, NET)
    assert [k for k, _, _ in spans] == ["card", "card", "mail", "phone", "phone", "date", "date",
                                       "ip", "ssn", "iban", "secret"]
    values = [text[a:b] for _, a, b in spans]
    assert not any(v in new for v in values)
    cards = [re.sub(r"\D", "", x) for x in re.findall(r"\d{16}|\d{4}(?: \d{4}){3}", new)[:2]]
    assert cards[0] == cards[1] and luhn_digit(cards[0][:-1]) == cards[0][-1]
    dates = re.search(r"born (\d{4})-(\d\d)-(\d\d), (\d\d)\.(\d\d)\.(\d{4})", new).groups()
    assert dates[:3] == dates[:2:-1] and dt.date(*map(int, dates[:3]))
    iban = re.search(r"iban ([A-Z0-9 ]+);", new).group(1)
    plain = iban.replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert len(iban) == len("GB82 WEST 1234 5698 7654 32") and "@mail1.example.com" in new


def test_orders_of_dates():
    """A date has one pseudonym in every order it is written in; different dates differ."""
    first, late = dt.date(1980, 1, 1), {}
    for n in range(0, 4000, 3):
        day = first + dt.timedelta(n)
        told = pseudonymise(f"{day:%Y-%m-%d} {day:%d.%m.%Y} {day:%m/%d/%Y}", NET)[0].split()
        new = dt.datetime.strptime(told[0], "%Y-%m-%d").date()
        assert told[1] == f"{new:%d.%m.%Y}"
        assert (new.day > 12) == (day.day > 12)
        if day.day > 12:
            assert told[2] == f"{new:%m/%d/%Y}"
        assert late.setdefault(told[2], day) == day
    assert pseudonymise("13/32/1980 13-13-1980", NET)[1] == []


def test_invalid_values_stay():
    rng = random.Random(2)
    wrong = card(rng)
    wrong = wrong[:-1] + str((int(wrong[-1]) + 1) % 10)
    for text in (f"number {wrong}", "2023-02-30", "300.1.2.3", "1.2.3.4.5", "666-12-3456",
                 "GB83 WEST 1234 5698 7654 32", "version 3.14", "108.", "no digits at all", ""):
        assert pseudonymise(text, NET) == (text, [])


@pytest.mark.parametrize("before, after", [
    ("card ", " 12 items"), ("qty 2 ", ""), ("", " 123"), ("4 ", " 2 3"), ("1234 5678 9012 ", ""),
    ("555-123-4567 ", " 2024"), ("12-", "-7"), ("1 2 3 4 5 6 7 8 9 ", " 1 2 3 4 5 6 7 8 9")])
def test_cards_next_to_short_numbers(before, after):
    rng = random.Random(5)
    for _ in range(30):
        plain = card(rng)
        for number in (plain, " ".join(plain[i:i + 4] for i in range(0, 16, 4))):
            new, spans = pseudonymise(before + number + after, NET)
            assert number not in new and any(k == "card" for k, _, _ in spans)


def test_cards_keep_their_pseudonym_next_to_others():
    new = pseudonymise("4111111111111111", NET)[0]
    assert pseudonymise("card 4111111111111111 12 items", NET)[0] == f"card {new} 12 items"
    assert pseudonymise("4111111111111111 4111111111111111", NET)[0] == f"{new} {new}"


def test_ibans_next_to_capitals():
    for number in ("AT611904300234573201", "AT61 1904 3002 3457 3201"):
        new = pseudonymise(number, NET)[0]
        assert new != number
        for before, after in (("", " BIC"), ("", " GIBA ATWW"), ("NR12 ABCD 1234 ", ""), ("", " 12")):
            assert pseudonymise(before + number + after, NET)[0] == before + new + after
        assert pseudonymise(f"{number} {number}", NET)[0] == f"{new} {new}"


def test_equal_values_stay_linked_and_others_apart(frame):
    rng = random.Random(3)
    numbers = [card(rng) for _ in range(50)]
    rows = [(i, f"pay {numbers[i % 50]} now") for i in range(100)]
    got = {r["doc_id"]: r["text"] for r in pseudonyms(frame(rows), "k").collect()}
    assert all(got[i] == got[i + 50] for i in range(50)) and len(set(got.values())) == 50


def test_odd_rows(frame, odd_rows):
    got = pseudonyms(frame(odd_rows, clashing=True), "k").collect()
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in got) == sorted(
        (i or -1, t or "") for i, t in odd_rows)
    assert sum(r["text"] is None for r in got) == 2 and not any(r["found"] for r in got)
    assert pseudonyms(frame([]), "k").collect() == []
