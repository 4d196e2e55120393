import hashlib
import itertools
import random
import re
from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii

P = pii.Pseudonyms(b"key")


@settings(deadline=None)
@given(st.integers(1, 10**30), st.data())
def test_feistel_is_a_permutation_of_its_range(n, data):
    x, y = data.draw(st.integers(0, n - 1)), data.draw(st.integers(0, n - 1))
    a, b = P.f(x, n, "t"), P.f(y, n, "t")
    assert 0 <= a < n and (a == b) == (x == y)


def test_small_range_is_covered():
    assert sorted(P.f(x, 1000, "t") for x in range(1000)) == list(range(1000))


def test_values_keep_their_format_and_validity():
    text = "a 4111 1111 1111 1111 b 9807915762804490? IBAN DE89 3704 0044 0532 0130 00, 078-05-1120, 2021-03-04, 4.3.2021 and March 4, 2021; 10.0.0.255, +1 (974) 555-3436, Jo.Do-1@mail7.example.com!"
    new, kinds = P.text(text)
    assert kinds.count("date") == 3 and {"card", "iban", "ssn", "ip", "phone", "email"} <= set(kinds)
    shape = lambda t: re.sub("[0-9]+", "9", re.sub("[A-Za-z]", "a", t))
    card = re.search(r"a ([0-9 ]{19}) b", new)[1].replace(" ", "")
    assert pii.luhn_digit(card[:-1]) == card[-1]
    iban = re.search(r"IBAN ([A-Z0-9 ]+),", new)[1].replace(" ", "")
    assert iban[:2] == "DE" and int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    iso = date.fromisoformat(re.search(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", new)[0])
    d, m, y = map(int, re.search(r"([0-9]+)\.([0-9]+)\.([0-9]{4}) and", new).groups())
    assert date(y, m, d) == iso  # one day, two formats
    assert all(int(b) < 256 for b in re.search(r"; ([0-9.]+),", new)[1].split("."))
    assert new.endswith(".com!") and "Jo.Do-1@mail7" not in new and "555-3436" not in new
    assert shape(new.split(",")[0]) == shape(text.split(",")[0])
    assert P.text(text) == (new, kinds)  # linked everywhere


@pytest.mark.parametrize("text", ["4111 1111 1111 1112", "2021-02-30", "300.1.1.1", "000-12-1234", "version 3.0, 12 apples in 1999", "a@b", "x" * 100000 + "@", "1" * 5000, "DE00 3704 0044 0532 0130 00"])
def test_what_fails_validation_stays(text):
    assert P.text(text) == (text, [])


def _valid_iban(plain):
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


@pytest.mark.parametrize("iban", ["ES91 2100 0418 4502 0005 1332", "AT611904300234573201", "PL61 1090 1014 0000 0712 1981 2874", "SE45 5000 0000 0583 9825 7466", "HU42 1177 3016 1111 1018 0000 0000", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"])
@pytest.mark.parametrize("after", ["", " BIC", " 2024", " BIC 2024", " A1", " IS PAID", ", BIC", " and"])
def test_words_after_an_iban(iban, after):
    new, kinds = P.text(f"to {iban}{after}")
    got = new[3 : 3 + len(iban)]
    assert kinds == ["iban"] and got != iban and new == f"to {got}{after}" and _valid_iban(got.replace(" ", ""))
    assert P.text(f"to {iban}.")[0] == f"to {got}."


@pytest.mark.parametrize("text, address", [("_jo.doe@mail.com", "jo.doe@mail.com"), ("--jo@x.com", "jo@x.com"), ("see...jo@x.com", "jo@x.com"), ("%+.jo@x.com,", "jo@x.com")])
def test_marks_before_an_address(text, address):
    new, kinds = P.text(text)
    assert kinds == ["email"] and new == text.replace(address, P.text(address)[0]) and address not in new


def test_value_inside_an_invalid_match():
    new, kinds = P.text("AB12 4111 1111 1111 1111 1111")
    assert not _valid_iban("AB1241111111111111111111") and kinds == ["card"] and new.startswith("AB12 ") and new.endswith(" 1111") and "4111 1111" not in new


def test_other_key_other_pseudonyms():
    assert P.text("10.1.2.3")[0] != pii.Pseudonyms(b"other").text("10.1.2.3")[0]


def all_days():
    return [pii.FIRST_DAY + timedelta(n) for n in range((pii.LAST_DAY - pii.FIRST_DAY).days + 1)]


def test_dates_are_one_to_one_in_every_writing():
    """Every day of two centuries: written month first, and day first where only that is a date, wide and narrow."""
    seen: dict[str, str] = {}
    by_day = {}
    for d in all_days():
        ways = [f"{d.month:02d}/{d.day:02d}/{d.year}", f"{d.month}/{d.day}/{d.year}", f"{d.day}.{d.month}.{d.year}", f"{d.day:02d}.{d.month:02d}.{d.year}", d.isoformat()]
        if d.day > 12:
            ways += [f"{d.day:02d}/{d.month:02d}/{d.year}", f"{d.day}/{d.month}/{d.year}"]
        new = [P.text(w)[0] for w in ways]
        day = date.fromisoformat(new[4])
        by_day[d] = day
        for w, n in zip(ways, new, strict=True):
            assert [len(x) for x in re.split("[./-]", n)] == [len(x) for x in re.split("[./-]", w)]
            assert seen.setdefault(n, w) == w  # different writings and days stay different
            p = [int(x) for x in re.split("[./-]", n)]
            order = (2, 0, 1) if "/" in n and p[0] <= 12 else (2, 1, 0) if "-" not in n else (0, 1, 2)
            assert date(*(p[i] for i in order)) == day  # all writings of a day tell one other day
    assert sorted(by_day.values()) == all_days()


def test_small_numbers_are_one_to_one():
    """Permutations within a class, over whole small ranges."""
    for n, same in ((1000, lambda x: x % 3 == 0), (5000, lambda x: (x < 500, x % 7 > 1)), (100, lambda x: x == 5)):
        new = [P.f.among(x, n, "t", same) for x in range(n)]
        assert sorted(new) == list(range(n)) and all(same(a) == same(b) for a, b in enumerate(new))
    ssns = [f"{a:03d}-{g:02d}-{s:04d}" for a in (1, 665, 667, 899) for g in (1, 50, 99) for s in range(1, 10000, 7)]
    new = [P.text(s)[0] for s in ssns]
    assert len(set(new)) == len(new) and all(x[:3] not in ("000", "666") and x[0] != "9" and x[4:6] != "00" and x[7:] != "0000" for x in new)
    phones = [f"+43 664 {n:03d} {m}" for n in range(1000) for m in (1234, 9999)]
    new = [P.text(x)[0] for x in phones]
    assert len(set(new)) == len(new) and all(re.fullmatch(r"\+43 [1-9][0-9]{2} [0-9]{3} [0-9]{4}", x) for x in new)


@pytest.mark.parametrize("ways", [["+49 151 1234567", "+491511234567", "+49 (151) 1234567", "+49-151-1234-567"], ["+1 (974) 555-3436", "(974) 555-3436", "974-555-3436", "+19745553436", "974.555.3436"], ["+352 621 123 456", "+352621123456"]])
def test_one_phone_number_in_several_writings(ways):
    new = [P.text(w) for w in ways]
    assert all(k == ["phone"] for _, k in new)
    own = {re.sub("[^0-9]", "", n)[-len(re.sub("[^0-9]", "", ways[0])) + pii.calling_code(re.sub("[^0-9]", "", ways[0])) :] for n, _ in new}
    assert len(own) == 1 and all(re.sub("[0-9]", "9", n) == re.sub("[0-9]", "9", w) and n != w for w, (n, _) in zip(ways, new, strict=True))
    assert all(n.startswith(w[: len(w) - len(w.lstrip("+")) + pii.calling_code(re.sub("[^0-9]", "", w))]) for w, (n, _) in zip(ways, new, strict=True) if w[0] == "+")
    if ways[0].startswith("+1"):
        assert re.fullmatch("[2-9][0-9]{2}[2-9][0-9]{6}", own.pop())


def plain_feistel(x, n, tweak, key=b"key"):
    """The permutation written out a second time."""
    key = hashlib.blake2b(key, digest_size=32).digest()
    a = next(k for k in itertools.count(max(1, int((n - 1) ** 0.5) - 2)) if k * k >= n)
    b = (n + a - 1) // a
    size = max(a, b).bit_length() // 8 + 9
    while True:
        left, right = x // b, x % b
        for i in range(10):
            half = left if i % 2 else right
            r = int.from_bytes(hashlib.blake2b(f"{tweak}|{i}|{half}".encode() + b"\0", key=key, digest_size=size).digest(), "big")
            left, right = (left, (right + r) % b) if i % 2 else ((left + r) % a, right)
        x = left * b + right
        if x < n:
            return x


def plain_day(d):
    kind = (d.day > 9, d.day > 12, d.month > 9)
    days = [x for x in all_days() if (x.day > 9, x.day > 12, x.month > 9) == kind]
    return days[plain_feistel(days.index(d), len(days), f"date{kind}")]


def plain_card(digits):
    x = int(digits[:-1])
    while True:
        x = plain_feistel(x, 10 ** (len(digits) - 1), f"card{len(digits) - 1}")
        body = f"{x:0{len(digits) - 1}d}"
        total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(body)))
        if len(set(body + str(-total % 10))) > 1:
            return body + str(-total % 10)


def plain_phone(country, own):
    x, n = int(own), len(own)
    valid = lambda d: country == "1" and n == 10 and d[0] in "23456789" and d[3] in "23456789"
    while True:
        x = plain_feistel(x, 10**n, f"phone{country}:{n}")
        new = f"{x:0{n}d}"
        if (new[0] == "0") == (own[0] == "0") and valid(new) == valid(own):
            return new


def test_against_brute_force(spark):
    """Texts put together from words and values whose pseudonyms are computed a second way."""
    rng = random.Random(4)
    values = []
    for d in (date(1987, 6, 5), date(1950, 7, 7), date(1954, 1, 27), date(2024, 12, 31)):
        n = plain_day(d)
        values += [(d.isoformat(), n.isoformat()), (f"{d.day}.{d.month}.{d.year}", f"{n.day}.{n.month}.{n.year}"), (f"{d.month:02d}/{d.day:02d}/{d.year}", f"{n.month:02d}/{n.day:02d}/{n.year}"), (f"{pii.MONTHS[d.month - 1]} {d.day}, {d.year}", f"{pii.MONTHS[n.month - 1]} {n.day}, {n.year}")]
    for card in ("4111111111111111", "5500005555555559"):
        new = plain_card(card)
        values += [(card, new), (" ".join(card[i : i + 4] for i in range(0, 16, 4)), " ".join(new[i : i + 4] for i in range(0, 16, 4)))]
    for own in ("9745553436", "2125550100"):
        new = plain_phone("1", own)
        values += [(f"{f}({own[:3]}) {own[3:6]}-{own[6:]}", f"{f}({new[:3]}) {new[3:6]}-{new[6:]}") for f in ("", "+1 ")]
    values.append(("+491511234567", "+49" + plain_phone("49", "1511234567")))
    index = ((78 - 1) * 99 + 4) * 9999 + 1119
    n = plain_feistel(index, 898 * 99 * 9999, "ssn")
    area = n // 9999 // 99 + 1
    values.append(("078-05-1120", f"{area + (area >= 666):03d}-{n // 9999 % 99 + 1:02d}-{n % 9999 + 1:04d}"))
    rows, want = [], {}
    for i in range(120):
        text, new = "", ""
        for _ in range(rng.randint(0, 8)):
            word = rng.choice(["on ", "the 12 of, ", "é: ", "version 3.0; ", "\n"])
            a, b = rng.choice(values)
            text, new = text + word + a + ", ", new + word + b + ", "
        rows.append((i, text))
        want[i] = new
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in pii.pseudonymise(df, b"key").collect()} == want


def test_documents(docs):
    got = {r.doc_id: r.text for r in pii.pseudonymise(docs, b"key").collect()}
    emails = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    for r in docs.collect():
        assert len(got[r.doc_id]) == len(r.text)
        for e in emails.findall(r.text):
            assert e not in got[r.doc_id]


def test_odd_rows(odd, none):
    got = pii.pseudonymise(odd).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 10 and by[2].text is None and by[3].text == "" and by[1].text == by[7].text and "555-3436" not in by[1].text
    assert by[1]["pii_kinds"] == "x" and by[1]["pii_kinds_"] == ["phone"] * 9
    assert pii.pseudonymise(none).count() == 0
    assert pii.stage(odd).columns == odd.columns
