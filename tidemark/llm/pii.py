"""Personal numbers, dates and addresses replaced by format-preserving pseudonyms.

A value is found by its form, validated (check digits, number ranges, the calendar), and
mapped by a keyed Feistel permutation of all values of its format: digits stay digits,
separators and letter case stay, check digits are computed anew.  The permutation
depends on the key and the kind only, so equal values get equal pseudonyms in every
document and different values stay different.

A date is permuted as a day, among the days whose parts are as wide and whose day and month
could be taken for each other just as well, so one day written in several ways stays one
day, and what is written and how it is read stays as it was.  A phone number is permuted
behind its country's calling code, however it is grouped; one without a code is North
American.  Its first digit stays a zero or stays none, and a valid North American number
stays valid.

Defined cases: a null text stays null, an empty one empty; repeated rows get equal
results; a value that fails its validation is no value of that kind and stays, and the
search goes on after its first character.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from datetime import date, timedelta
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import arrow_rows, fresh
from .textbytes import release

#: English month names.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
_MONTH = {m[:3].lower(): i for i, m in enumerate(MONTHS, 1)}
_NAMES = "|".join([*MONTHS, *(m[:3] for m in MONTHS if len(m) > 3)])

FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)

PATTERN = re.compile(
    r"(?P<email>(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9]))"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9]))"
    r"|(?P<date>(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9]|[./-][0-9]))"
    rf"|(?P<named>(?<![A-Za-z0-9])(?:[0-9]{{1,2}} (?:{_NAMES}),? [0-9]{{4}}|(?:{_NAMES}) [0-9]{{1,2}}, ?[0-9]{{4}})(?![A-Za-z0-9]))"
    r"|(?P<ip>(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9]))"
    r"|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9]))"
    r"|(?P<card>(?<![0-9])(?:[0-9]{4}(?P<sep>[ -])[0-9]{4}(?P=sep)[0-9]{4}(?P=sep)[0-9]{4}|[0-9]{4}(?P<sep2>[ -])[0-9]{6}(?P=sep2)[0-9]{5}|[0-9]{13,19})(?![0-9]))"
    r"|(?P<phone>(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|\+[0-9]{1,3}[ .-]?[0-9]{1,2}(?:[ .-]?[0-9]{2}){4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9]))"
)
#: Lengths of the countries' IBANs.
_LENGTHS = (
    "NO15 BE16 DK18 FI18 FK18 FO18 GL18 NL18 SD18 MK19 SI19 AT20 BA20 EE20 KZ20 LT20 LU20 MN20 XK20 CH21 HR21 LI21 LV21 BG22 BH22 CR22 DE22 GB22 GE22 IE22 ME22 RS22 VA22 AE23 GI23 IL23 IQ23 "
    "OM23 SO23 TL23 AD24 CZ24 ES24 MD24 PK24 RO24 SA24 SE24 SK24 TN24 VG24 LY25 PT25 ST25 IS26 TR26 BI27 DJ27 FR27 GR27 IT27 MC27 MR27 SM27 AL28 AZ28 BY28 CY28 DO28 GT28 HN28 HU28 LB28 NI28 "
    "PL28 SV28 BR29 EG29 PS29 QA29 UA29 JO30 KW30 MU30 MT31 SC31 LC32 RU33"
)
IBAN_LENGTH = {x[:2]: int(x[2:]) for x in _LENGTHS.split()}
#: Calling codes of one and two digits; all others have three.
_CODES = (
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
)
CALLING_CODES = frozenset(_CODES.split())
#: A text without any of these holds no value.
HINT = re.compile(r"[0-9@]")


class Feistel:
    """Keyed permutations of 0..n-1: ten unbalanced rounds, walked until the value is inside."""

    def __init__(self, key: bytes, rounds: int = 10):
        self.key, self.rounds = hashlib.blake2b(key, digest_size=32).digest(), rounds

    def __call__(self, x: int, n: int, tweak: str) -> int:
        if n < 2:
            return x
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        size = max(a, b).bit_length() // 8 + 9
        while True:
            left, right = divmod(x, b)
            for i in range(self.rounds):
                if i % 2:
                    right = (right + self._round(left, i, tweak, size)) % b
                else:
                    left = (left + self._round(right, i, tweak, size)) % a
            x = left * b + right
            if x < n:
                return x

    def _round(self, half: int, i: int, tweak: str, size: int) -> int:
        data = f"{tweak}|{i}|{half}".encode()
        out, k = b"", 0
        while len(out) < size:
            out += hashlib.blake2b(data + bytes([k]), key=self.key, digest_size=min(64, size)).digest()
            k += 1
        return int.from_bytes(out[:size], "big")

    def symbols(self, text: str, tweak: str) -> str:
        """Digits among digits, letters among letters; case and every other character stay."""
        value, size = 0, 1
        for c in text:
            base = 10 if c in "0123456789" else 26 if c.isascii() and c.isalpha() else 1
            value, size = value * base + (int(c) if base == 10 else ord(c.lower()) - 97 if base == 26 else 0), size * base
        value = self(value, size, f"{tweak}|{re.sub('[0-9]', '9', re.sub('[A-Za-z]', 'a', text))}")
        out = []
        for c in reversed(text):
            if c in "0123456789":
                value, d = divmod(value, 10)
                c = str(d)
            elif c.isascii() and c.isalpha():
                value, d = divmod(value, 26)
                c = chr((65 if c.isupper() else 97) + d)
            out.append(c)
        return "".join(reversed(out))


    def among(self, x: int, n: int, tweak: str, same) -> int:
        """Permutes the part of 0..n-1 where ``same`` is what it is for ``x``: walks on until it is."""
        want, x = same(x), self(x, n, tweak)
        while same(x) != want:
            x = self(x, n, tweak)
        return x


def luhn_digit(digits: str) -> str:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _ibans(v: str) -> list[str]:
    """What of a match may be the IBAN: its country's length first, then the longest; words may have joined at the end."""
    cuts = [v, *(v[: m.start()] for m in reversed(list(re.finditer(" ", v))))]
    size = lambda x: len(x) - x.count(" ")
    return sorted((x for x in cuts if size(x) >= 15), key=lambda x: size(x) != IBAN_LENGTH.get(v[:2]))


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits, or for IBANs letters and digits, replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isascii() and c.isalnum() else c for c in shape)


def _day(y: int, m: int, d: int) -> date | None:
    try:
        got = date(y, m, d)
    except ValueError:
        return None
    return got if FIRST_DAY <= got <= LAST_DAY else None


def day_class(d: date) -> tuple[bool, bool, bool]:
    """What of a day shows in any writing: widths of day and month, and whether the day could be a month."""
    return d.day > 9, d.day > 12, d.month > 9


@lru_cache(1)
def days_by_class() -> dict[tuple[bool, bool, bool], list[int]]:
    """The days of the range, as numbers from its first, that may stand for each other."""
    out: dict[tuple[bool, bool, bool], list[int]] = {}
    for n in range((LAST_DAY - FIRST_DAY).days + 1):
        out.setdefault(day_class(FIRST_DAY + timedelta(n)), []).append(n)
    return out


def calling_code(digits: str) -> int:
    """Digits of the country's code at the beginning of an international number."""
    return next((n for n in (1, 2) if digits[:n] in CALLING_CODES), 3)


class Pseudonyms:
    def __init__(self, key: bytes):
        self.f = Feistel(key)
        self.of = lru_cache(1 << 16)(self._of)

    def _of(self, kind: str, value: str) -> str | None:
        """The pseudonym of a value of that form, or None if it isn't valid."""
        return getattr(self, "_" + kind)(value)

    def _email(self, v: str) -> str | None:
        local, _, domain = v.partition("@")
        if ".." in v or local.endswith("."):
            return None
        name, _, top = domain.rpartition(".")
        return f"{self.f.symbols(local, 'local')}@{self.f.symbols(name, 'domain')}.{top}"

    def _iban(self, v: str) -> str | None:
        plain = v.replace(" ", "")
        if not 15 <= len(plain) <= 34 or int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
            return None
        rest = self.f.symbols(plain[4:], "iban" + plain[:2])
        return _refill(v, plain[:2] + _iban_check(plain[:2], rest) + rest)

    def _shift(self, d: date) -> date:
        kind = day_class(d)
        days = days_by_class()[kind]
        at = bisect_left(days, (d - FIRST_DAY).days)
        return FIRST_DAY + timedelta(days[self.f(at, len(days), f"date{kind}")])

    def _date(self, v: str) -> str | None:
        p = [int(x) for x in re.split("[-/.]", v)]
        wide = lambda new, i, w: f"{new:0{w}d}" if len(re.split('[-/.]', v)[i]) == w else str(new)
        if "-" in v:
            d = _day(*p)
            return self._shift(d).isoformat() if d else None
        if "/" in v:  # month first where that is a date, else day first
            d, us = (_day(p[2], p[0], p[1]), True) if _day(p[2], p[0], p[1]) else (_day(p[2], p[1], p[0]), False)
        else:
            d, us = _day(p[2], p[1], p[0]), False
        if d is None:
            return None
        new, sep = self._shift(d), "/" if "/" in v else "."
        first, second = (new.month, new.day) if us else (new.day, new.month)
        return f"{wide(first, 0, 2)}{sep}{wide(second, 1, 2)}{sep}{new.year:04d}"

    def _named(self, v: str) -> str | None:
        word = re.search("[A-Za-z]+", v)[0]
        day, year = map(int, re.findall("[0-9]+", v))
        d = _day(year, _MONTH[word[:3].lower()], day)
        if d is None:
            return None
        new = self._shift(d)
        month = MONTHS[new.month - 1]
        parts = iter([str(new.day), f"{new.year:04d}"])
        return re.sub("[0-9]+", lambda _: next(parts), v.replace(word, month if len(word) > 3 else month[:3]))

    def _ip(self, v: str) -> str | None:
        """Permuted among the addresses whose parts have as many digits."""
        parts = v.split(".")
        if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
            return None
        low, size = (0, 10, 100), (10, 90, 156)
        n, total = 0, 1
        for p in parts:
            k = len(p) - 1
            n, total = n * size[k] + int(p) - low[k], total * size[k]
        n = self.f(n, total, "ip" + ".".join(str(len(p)) for p in parts))
        out = []
        for p in reversed(parts):
            n, d = divmod(n, size[len(p) - 1])
            out.append(str(d + low[len(p) - 1]))
        return ".".join(reversed(out))

    def _ssn(self, v: str) -> str | None:
        a, g, s = map(int, v.split("-"))
        if a in (0, 666) or a > 899 or not g or not s:
            return None
        index = ((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1
        n = self.f(index, 898 * 99 * 9999, "ssn")
        n, s = divmod(n, 9999)
        a, g = divmod(n, 99)
        return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{s + 1:04d}"

    def _card(self, v: str) -> str | None:
        digits = re.sub("[^0-9]", "", v)
        if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        n = len(digits) - 1
        whole = lambda x: (own := f"{x:0{n}d}") + luhn_digit(own)
        new = self.f.among(int(digits[:-1]), 10**n, f"card{n}", lambda x: len(set(whole(x))) == 1)
        return _refill(v, whole(new))

    def _phone(self, v: str) -> str | None:
        digits = re.sub("[^0-9]", "", v)
        if not 8 <= len(digits) <= 15:
            return None
        code = calling_code(digits) if v[0] == "+" else 0
        country, own = digits[:code] or "1", digits[code:]
        n = len(own)

        def form(x: int) -> tuple[bool, bool]:
            d = f"{x:0{n}d}"
            return d[0] == "0", country == "1" and n == 10 and d[0] > "1" and d[3] > "1"

        new = self.f.among(int(own), 10**n, f"phone{country}:{n}", form)
        return _refill(v, digits[:code] + f"{new:0{n}d}")

    def text(self, text: str) -> tuple[str, list[str]]:
        """The text with its values replaced, and their kinds in order."""
        if not HINT.search(text):
            return text, []
        kinds: list[str] = []

        out, done, at = [], 0, 0
        while m := PATTERN.search(text, at):
            kind = m.lastgroup if m.lastgroup not in ("sep", "sep2") else "card"
            for value in _ibans(m[0]) if kind == "iban" else (m[0],):
                if (new := self.of(kind, value)) is not None:
                    break
            else:  # another value may begin inside
                at = m.start() + 1
                continue
            kinds.append("date" if kind == "named" else kind)
            out += [text[done : m.start()], new]
            done = at = m.start() + len(value)
        return "".join([*out, text[done:]]), kinds


def pseudonymise(docs: DataFrame, key: bytes = b"tidemark", text: str = "text", kinds: str | None = "pii_kinds") -> DataFrame:
    """``docs`` with personal values in ``text`` replaced; ``kinds`` (array) lists what was.

    Other columns pass unchanged, whatever their names (a column named as ``kinds`` has
    the new one called by that name with an underscore); ``kinds=None`` leaves it out.
    """
    arrow_rows(docs.sparkSession)
    kinds = kinds and fresh(docs, kinds)
    schema = T.StructType([*docs.schema.fields, *([T.StructField(kinds, T.ArrayType(T.StringType()))] if kinds else [])])

    def run(batches):
        own = Pseudonyms(key)
        for b in batches:
            at = b.schema.get_field_index(text)
            got = [(None, []) if t is None else own.text(t) for t in b.column(at).to_pylist()]
            cols = b.columns
            cols[at] = pa.array([g[0] for g in got], b.schema.field(at).type)
            names = b.schema.names
            if kinds:
                cols, names = [*cols, pa.array([g[1] for g in got], pa.list_(pa.string()))], [*names, kinds]
            yield pa.RecordBatch.from_arrays(cols, names)
        release()

    return docs.mapInArrow(run, schema)


def stage(docs: DataFrame, key: bytes = b"tidemark") -> DataFrame:
    """Documents with pseudonyms; the length follows the text."""
    return pseudonymise(docs, key, kinds=None).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)
