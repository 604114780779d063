"""Format-preserving pseudonyms for personal data.

E-mail local parts, card and bank account numbers, social security and phone
numbers, IPv4 addresses and dates are found, validated, and replaced by a keyed
permutation of the values of the same form: check digits and calendars hold,
separators stay. The permutation is a Feistel network on numbers below any
bound, walked on until it lands in the allowed set, and depends on the key, the
kind and the form alone. So equal values stay equal in all documents, different
ones stay different, and who has the key can go back. A phone number is the same
in all notations; a date is the same in all notations of equal digit widths.

The key is the caller's: there is no default.
"""

from __future__ import annotations

import datetime
import hmac
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from webcorpus.llm.texts import chunks
from webcorpus.session import ddl

ROUNDS = 8
KINDS = ("email", "card", "iban", "ssn", "phone", "ip", "date")
#: Calling codes of one and of two digits; all others have three.
CODES_1 = ("1", "7")
CODES_2 = (
    "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46",
    "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63",
    "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
)

_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY

#: Digits and what may stand between them.
_NUMERIC = re.compile(r"\d[\d .()/+-]*")
_NUMBER = re.compile(
    r"(?<![\w+])(?:"
    r"(?P<date>\d{4}-\d\d-\d\d|\d\d?/\d\d?/\d{4}|\d\d?\.\d\d?\.\d{4})"
    r"|(?P<ip>\d{1,3}(?:\.\d{1,3}){3}(?!\.\d))"
    r"|(?P<card>\d{13,19}|\d{4}(?P<sep>[ -])\d{4}(?P=sep)\d{4}(?P=sep)\d{1,7}"
    r"|\d{4}(?P<gap>[ -])\d{6}(?P=gap)\d{5})"
    r"|(?P<ssn>\d{3}-\d\d-\d{4})"
    r"|(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{1,4}){1,4}"
    r"|\(\d{3}\) ?\d{3}[ -]\d{4}|\d{3}(?P<dot>[ .-])\d{3}(?P=dot)\d{4})"
    r")(?![\w])"
)
_IBAN = re.compile(r"(?<![\w])[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![\w])")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}")


class Permuter:
    """Keyed permutations; `back=True` gives their inverses."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back = key, back

    def _f(self, tweak: str, turn: int, half: int) -> int:
        mark = f"{tweak}|{turn}|{half}".encode()
        return int.from_bytes(hmac.digest(self.key, mark, "sha256")[:16], "big")

    def _once(self, x: int, a: int, b: int, tweak: str) -> int:
        high, low = divmod(x, a)
        for turn in reversed(range(ROUNDS)) if self.back else range(ROUNDS):
            sign = -1 if self.back else 1
            if turn % 2:
                high = (high + sign * self._f(tweak, turn, low)) % b
            else:
                low = (low + sign * self._f(tweak, turn, high)) % a
        return high * a + low

    def number(
        self, x: int, size: int, tweak: str, allowed: Callable[[int], bool] = lambda _: True
    ) -> int:
        """Image of `x` among the allowed numbers below `size`; `x` must be one."""
        if size < 2:
            return x
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        while True:
            x = self._once(x, a, b, f"{tweak}|{size}")
            if x < size and allowed(x):
                return x

    def shaped(self, text: str, tweak: str) -> str:
        """Letters become letters of the same case and digits digits; the rest stays."""
        sizes = [(c, _alphabet(c)) for c in text]
        x, size = 0, 1
        for c, letters in sizes:
            if letters:
                x, size = x * len(letters) + letters.index(c), size * len(letters)
        shape = "".join(letters[:1] or c for c, letters in sizes)
        x = self.number(x, size, f"{tweak}|{shape}")
        out = []
        for c, letters in reversed(sizes):
            if letters:
                x, k = divmod(x, len(letters))
                c = letters[k]
            out.append(c)
        return "".join(reversed(out))


def _alphabet(c: str) -> str:
    if "0" <= c <= "9":
        return "0123456789"
    if "a" <= c <= "z":
        return "abcdefghijklmnopqrstuvwxyz"
    return "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if "A" <= c <= "Z" else ""


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _refill(form: str, digits: str) -> str:
    """`form` with its digits replaced in order."""
    rest = iter(digits)
    return re.sub(r"\d", lambda _: next(rest), form)


def luhn_digit(digits: str) -> str:
    """The check digit that makes `digits` and it valid."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def iban_digits(country: str, account: str) -> str:
    whole = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(whole) % 97:02d}"


def _card(found: str, p: Permuter) -> str | None:
    digits = _digits(found)
    body = digits[:-1]
    if luhn_digit(body) != digits[-1] or not int(digits):
        return None
    new = str(p.number(int(body), 10 ** len(body), "card")).zfill(len(body))
    return _refill(found, new + luhn_digit(new))


def _iban(found: str, p: Permuter) -> str | None:
    plain = found.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or iban_digits(country, account) != check:
        return None
    new = p.shaped(account, "iban" + country)
    new = country + iban_digits(country, new) + new
    rest = iter(new)
    return "".join(c if c == " " else next(rest) for c in found)


def _ssn_valid(x: int) -> bool:
    area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
    return bool(area and group and serial) and area != 666 and area < 900


def _ssn(found: str, p: Permuter) -> str | None:
    x = int(_digits(found))
    if not _ssn_valid(x):
        return None
    return _refill(found, f"{p.number(x, 10**9, 'ssn', _ssn_valid):09d}")


def _phone(found: str, p: Permuter) -> str | None:
    """The calling code stays. A number without one has ten digits and the code 1."""
    digits = _digits(found)
    size = 0
    if found[0] == "+":
        size = 1 if digits[:1] in CODES_1 else 2 if digits[:2] in CODES_2 else 3
    code, own = digits[:size] or "1", digits[size:]
    if not (8 if size else 10) <= len(digits) <= 15 or len(own) < 6:
        return None
    new = p.number(int(own), 10 ** len(own), f"phone{code}")
    return _refill(found, digits[:size] + str(new).zfill(len(own)))


def _ip(found: str, p: Permuter) -> str | None:
    parts = found.split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in parts):
        return None
    x = int.from_bytes(bytes(map(int, parts)), "big")
    return ".".join(map(str, p.number(x, 1 << 32, "ip").to_bytes(4, "big")))


def _date(found: str, p: Permuter) -> str | None:
    """Days of 1900 to 2099. Day before month, unless the second number is over 12."""
    sep = re.search(r"\D", found)[0]
    a, b, c = found.split(sep)
    month_first = sep == "/" and int(b) > 12
    year, month, day = (a, b, c) if sep == "-" else (c, a, b) if month_first else (c, b, a)
    try:
        x = datetime.date(int(year), int(month), int(day)).toordinal() - _FIRST_DAY
    except ValueError:
        return None
    if not 0 <= x < _DAYS:
        return None

    # A number of one digit stays one, or the form would change and not go back. A
    # date written month first must show that it is, or it would not be read so again.
    widths = (len(month), len(day))

    def fits(n: int) -> bool:
        new = datetime.date.fromordinal(_FIRST_DAY + n)
        if month_first and new.day <= 12:
            return False
        return all(w == 2 or v < 10 for w, v in zip(widths, (new.month, new.day)))

    n = p.number(x, _DAYS, "date-m" if month_first else "date", fits)
    new = datetime.date.fromordinal(_FIRST_DAY + n)
    if sep == "-":
        return new.isoformat()
    month, day = f"{new.month:0{widths[0]}d}", f"{new.day:0{widths[1]}d}"
    first, second = (month, day) if month_first else (day, month)
    return f"{first}{sep}{second}{sep}{new.year}"


_MAKERS = {"card": _card, "iban": _iban, "ssn": _ssn, "phone": _phone, "ip": _ip, "date": _date}


class Masker:
    """Pseudonyms for texts, with a bounded memory of values seen."""

    def __init__(self, key: bytes, back: bool = False):
        permuter = Permuter(key, back)
        self.make = lru_cache(100_000)(lambda kind, found: _MAKERS[kind](found, permuter))
        self.local = lru_cache(100_000)(lambda found: permuter.shaped(found, "email"))

    def _emails(self, text: str) -> Iterator[tuple[int, int, str, str]]:
        at = text.find("@")
        while at >= 0:
            # Both sides are bounded, so the scan is linear in the text.
            left = _LOCAL.search(text[max(0, at - 64) : at])
            right = _DOMAIN.match(text, at + 1)
            if left and right:
                found = left[0]
                yield at - len(found), at, "email", self.local(found)
            at = text.find("@", at + 1)

    def _numbers(self, text: str) -> Iterator[tuple[int, int, str, str]]:
        for span in _NUMERIC.finditer(text):
            if span.end() - span.start() < 6:
                continue
            at = span.start()
            while at and text[at - 1] in "+(" and at > span.start() - 2:
                at -= 1
            while found := _NUMBER.search(text, at, span.end()):
                kind = next(k for k in ("date", "ip", "card", "ssn", "phone") if found[k])
                new = self.make(kind, found[0])
                if new is None:
                    at = found.start() + 1
                else:
                    yield found.start(), found.end(), kind, new
                    at = found.end()
        for found in _IBAN.finditer(text):
            if new := self.make("iban", found[0]):
                yield found.start(), found.end(), "iban", new

    def mask(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms, and the number of replaced values by kind."""
        found = sorted([*self._emails(text), *self._numbers(text)])
        out, counts, end = [], dict.fromkeys(KINDS, 0), 0
        for start, stop, kind, new in found:
            if start >= end:
                out += [text[end:start], new]
                counts[kind] += 1
                end = stop
        return ("".join([*out, text[end:]]) if out else text), counts


def mask_texts(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """`docs` with pseudonyms in `text`; `n_chars`, where there is one, follows.

    All other columns stay, whatever their names. A null text stays null; equal
    rows stay equal. `back` replaces pseudonyms by the values they stand for.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masker = Masker(key, back)
        for rows, texts in chunks(batches):
            column = rows.column("text")
            null = column.is_null().to_pylist()
            new = [None if n else masker.mask(t)[0] for n, t in zip(null, texts)]
            columns = {name: rows.column(name) for name in names}
            columns["text"] = pa.array(new, column.type)
            if "n_chars" in columns and pa.types.is_integer(columns["n_chars"].type):
                sizes = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array(
                    [s if t is None else len(t) for s, t in zip(sizes, new)],
                    columns["n_chars"].type,
                )
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return docs.mapInArrow(run, docs.schema)


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, text, n_<kind> for each of KINDS, n_replaced), a row per row of `docs`.

    A null text stays null and has counts of 0. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masker = Masker(key)
        for rows, texts in chunks(batches):
            null = rows.column("text").is_null().to_pylist()
            made = [masker.mask(text) for text in texts]
            counts = [pa.array([c[kind] for _, c in made], pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(
                        [None if n else t for n, (t, _) in zip(null, made)],
                        rows.column("text").type,
                    ),
                    *counts,
                    pa.array([sum(c.values()) for _, c in made], pa.int64()),
                ],
                names=["doc_id", "text", *[f"n_{k}" for k in KINDS], "n_replaced"],
            )

    source = docs.select("doc_id", "text")
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return source.mapInArrow(run, f"{ddl([source.schema['doc_id']])}, text string, {counts}, n_replaced long")
