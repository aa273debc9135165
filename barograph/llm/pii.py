"""Pseudonyms for personal data that keep its format.

Card numbers (Luhn), IBANs (mod 97), social security numbers, phone numbers,
IPv4 addresses, dates, e-mail addresses and assigned secrets are found and
validated; each is permuted under a key within its own format. A card stays a
valid card with the same grouping, a date a date. Equal values get equal
pseudonyms in all documents, also where they are grouped differently, and
different values of a kind different ones. What fails validation is left alone.
"""

from __future__ import annotations

import datetime as dt
import re
from bisect import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barograph.llm.chunks import in_portions
from barograph.llm.feistel import Permutation

EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+\-])([A-Za-z0-9._%+\-]+)@"
    r"([A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*)\.([A-Za-z]{2,})(?![A-Za-z0-9\-])"
)
SECRET = re.compile(
    r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_\-]?key|access[_\-]?key|private[_\-]?key)"
    r"[\"']?\s*[:=]\s*[\"']?([A-Za-z0-9_/+\-]{16,}(?:\.[A-Za-z0-9_/+\-]{8,})*)"
)
IBAN = re.compile(
    r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
)
NUMBER = re.compile(
    r"(?<![\w.])(?:"
    r"(?P<date>\d{4}(?P<a>[\-/.])\d{1,2}(?P=a)\d{1,2}|\d{1,2}(?P<b>[\-/.])\d{1,2}(?P=b)\d{4})"
    r"|(?P<ip>\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})"
    r"|(?P<card>\d{13,19}|\d{4}(?P<c>[ \-])\d{4}(?P=c)\d{4}(?P=c)\d{4}(?:(?P=c)\d{1,3})?"
    r"|\d{4}(?P<d>[ \-])\d{6}(?P=d)\d{5})"
    r"|(?P<phone>\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){2,4}"
    r"|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}(?P<e>[ .\-])\d{3}(?P=e)\d{4})"
    # A time may follow a date, by a T or a blank.
    r")(?!(?!T\d\d:)\w|[.\-]\d)"
)
FIRST_DAY, DAYS = dt.date(1900, 1, 1), 73_049  # to the end of 2099
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def luhn_digit(payload: str) -> str:
    total = 0
    for k, c in enumerate(reversed(payload)):
        n = int(c) * (2 if k % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def iban_digits(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in f"{account}{country}00")
    return f"{98 - int(number) % 97:02d}"


def regrouped(value: str, like: str) -> str:
    """The letters and digits of ``value`` in the places those of ``like`` have."""
    rest = iter(value)
    return "".join(next(rest) if c.isalnum() else c for c in like)


class Pseudonyms:
    """The pseudonym of each kind of value; None for what is not valid."""

    def __init__(self, key: bytes):
        self.permutation = Permutation(key)

    def card(self, found: str) -> str | None:
        number = "".join(filter(str.isdigit, found))
        if luhn_digit(number[:-1]) != number[-1] or len(set(number)) == 1:
            return None
        n = len(number) - 1
        # Numbers of one digit are no cards; none may come out either.
        value = self.permutation.within(
            f"card{n}", int(number[:-1]), 10**n, lambda x: len(set(f"{x:0{n}d}")) > 1
        )
        payload = f"{value:0{n}d}"
        return regrouped(payload + luhn_digit(payload), found)

    def iban(self, found: str) -> str | None:
        number = found.replace(" ", "")
        country, check, account = number[:2], number[2:4], number[4:]
        if not 11 <= len(account) <= 30 or iban_digits(country, account) != check:
            return None
        account = self.by_class(account, "iban" + country, same_case=False)
        return regrouped(country + iban_digits(country, account) + account, found)

    def ssn(self, found: str) -> str | None:
        def valid(n: int) -> bool:
            area, group, serial = n // 10**6, n // 10**4 % 100, n % 10**4
            return 0 < area < 900 and area != 666 and group > 0 and serial > 0

        number = int(found.replace("-", ""))
        if not valid(number):
            return None
        return regrouped(f"{self.permutation.within('ssn', number, 10**9, valid):09d}", found)

    def ip(self, found: str) -> str | None:
        parts = found.split(".")
        if any(int(x) > 255 or x != str(int(x)) for x in parts):
            return None
        value = self.permutation.of("ip", int.from_bytes(bytes(map(int, parts))), 2**32)
        return ".".join(map(str, value.to_bytes(4)))

    def date(self, found: str) -> str | None:
        mark = next(c for c in found if not c.isdigit())
        parts = found.split(mark)
        first = len(parts[0]) == 4
        year, x, y = (map(int, parts) if first else (int(parts[2]), int(parts[1]), int(parts[0])))
        # Year first is year, month, day; else day and month, or month and day if only that is one.
        swapped = not first and x > 12
        month, day = (y, x) if swapped else (x, y)
        try:
            number = (dt.date(year, month, day) - FIRST_DAY).days
        except ValueError:
            return None
        if not 0 <= number < DAYS:
            return None
        # Days over 12 among themselves, and the others: month and day, where written in that
        # order, stay so, and a date has one pseudonym in all its forms.
        over = day > 12
        number = self.permutation.within(
            "date", number, DAYS, lambda n: ((FIRST_DAY + dt.timedelta(n)).day > 12) == over
        )
        when = FIRST_DAY + dt.timedelta(number)
        width = 2 if all(len(p) == 2 for p in parts if len(p) != 4) else 1
        month_text, day_text = f"{when.month:0{width}d}", f"{when.day:0{width}d}"
        if first:
            return mark.join([f"{when.year}", month_text, day_text])
        pair = [month_text, day_text] if swapped else [day_text, month_text]
        return mark.join([*pair, f"{when.year}"])

    def phone(self, found: str) -> str | None:
        number = "".join(filter(str.isdigit, found))
        plus = found.startswith("+")

        def american(n: int) -> bool:
            return n // 10**9 >= 2 and n // 10**6 % 10 >= 2

        if plus and not 8 <= len(number) <= 15 or not plus and len(number) != 10:
            return None
        if not plus or number[0] == "1" and len(number) == 11:
            head, tail = number[:-10], int(number[-10:])
            kind = american(tail)
            if not kind and not plus:
                return None
            tag = "phone-american" if kind else "phone-1"
            value = self.permutation.within(tag, tail, 10**10, lambda x: american(x) == kind)
            return regrouped(f"{head}{value:010d}", found)
        # The country code's first digit stays.
        n = len(number) - 1
        value = self.permutation.of(f"phone{number[0]}-{n}", int(number[1:]), 10**n)
        return regrouped(f"{number[0]}{value:0{n}d}", found)

    def by_class(self, found: str, tag: str, same_case: bool) -> str:
        """Permute letters among letters and digits among digits; other signs stay.

        ``same_case``: case is not part of the value, it is taken over.
        """
        sets = [
            DIGITS if c in DIGITS else LOWER if same_case or c in LOWER else UPPER
            for c in found
            if c.isalnum()
        ]
        letters = [c for c in (found.lower() if same_case else found) if c.isalnum()]
        shape = "".join(s[0] if c.isalnum() else c for s, c in _with_signs(sets, found))
        values = [s.index(c) for s, c in zip(sets, letters, strict=True)]
        image = self.permutation.digits(f"{tag}|{shape}", values, [len(s) for s in sets])
        out = regrouped("".join(s[n] for s, n in zip(sets, image, strict=True)), found)
        if same_case:
            out = "".join(b.upper() if a.isupper() else b for a, b in zip(found, out, strict=True))
        return out

    def email(self, found: re.Match) -> str:
        own = self.by_class(f"{found[1]}@{found[2]}", "email", same_case=True)
        return f"{own}.{found[3]}"

    def secret(self, value: str) -> str | None:
        if not (set(value) & set(DIGITS)) or value.isdigit():
            return None
        if set(value) <= set("0123456789abcdef"):
            image = self.permutation.digits(
                f"hex{len(value)}", [int(c, 16) for c in value], [16] * len(value)
            )
            return "".join(f"{n:x}" for n in image)
        return self.by_class(value, "secret", same_case=False)

    def text(self, text: str) -> tuple[str, int]:
        """The text with pseudonyms, and how many values were replaced.

        Kinds are looked for one after another on what the kinds before have
        left, so no value is replaced twice.
        """
        spans: list[tuple[int, int, str]] = []  # in order, none meets another

        def take(begin: int, end: int, new: str | None) -> None:
            at = bisect(spans, (begin,))
            free = not at or spans[at - 1][1] <= begin
            if new is not None and free and (at == len(spans) or end <= spans[at][0]):
                spans.insert(at, (begin, end, new))

        if "@" in text:
            for m in EMAIL.finditer(text):
                take(*m.span(), self.email(m))
        if "=" in text or ":" in text:
            for m in SECRET.finditer(text):
                take(*m.span(1), self.secret(m[1]))
        for m in IBAN.finditer(text):
            take(*m.span(), self.iban(m[0]))
        for m in NUMBER.finditer(text):
            take(*m.span(), self._number(m))
        if not spans:
            return text, 0
        out, at = [], 0
        for begin, end, new in spans:
            out += [text[at:begin], new]
            at = end
        return "".join([*out, text[at:]]), len(spans)

    def _number(self, found: re.Match) -> str | None:
        for kind in ("date", "ip", "ssn", "card", "phone"):
            if found[kind] is not None:
                return getattr(self, kind)(found[0])
        return None


def _with_signs(sets: list[str], found: str) -> Iterator[tuple[str, str]]:
    rest = iter(sets)
    for c in found:
        yield (next(rest) if c.isalnum() else c), c


def pseudonymised(
    docs: DataFrame, secret: bytes, text: str = "text", count: str | None = None
) -> DataFrame:
    """The rows with pseudonyms in ``text``, all other columns as they are.

    ``count`` names a column to add: the number of values replaced. Null texts
    stay null (count 0), empty ones empty. Repeated rows are treated alike. An
    empty table gives no rows. ``secret`` is the key: without it no pseudonym
    can be turned back, with it each can.
    """
    if count in docs.columns:
        raise ValueError(f"the rows have a column {count} already")
    place = docs.columns.index(text)
    schema = T.StructType(
        [*docs.schema.fields, *([T.StructField(count, T.LongType())] if count else [])]
    )

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(secret)
        for batch in batches:
            for begin, run in in_portions(batch.column(place)):
                rows = batch.slice(begin, len(run))
                found = [names.text(x) for x in run]
                null = rows.column(place).is_null().to_numpy(zero_copy_only=False)
                new = pa.array([x for x, _ in found], rows.schema.field(place).type, mask=null)
                columns = [*rows.columns[:place], new, *rows.columns[place + 1 :]]
                if count:
                    columns.append(pa.array([n for _, n in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(replace, schema)
