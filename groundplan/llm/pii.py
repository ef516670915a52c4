"""Format-preserving pseudonyms for personal numbers, dates and identifiers.

A value that is found by its form and validated (Luhn, IBAN check digits, octets, calendar, number plans) is mapped to an
integer of its format's domain, permuted there by a keyed Feistel network with cycle walking, and written back in the form
in which it stood. The permutation depends only on key, kind and domain, so equal values get equal pseudonyms in every
document, and different values different ones; with the key it can be undone. A value never stays as it is: the network E
is used as E^-1(E(x) + 1), which has no fixed points.

Kept: a card's first digit, length and valid check digit; a phone's country code and punctuation; an IBAN's country,
letters and digits at their places, check digits valid; an e-mail's domain; the case and kind of each character of an
identifier or secret, punctuation included (letters beyond Latin, Greek and Cyrillic stay, too); a date's notation. A secret reaches
to the next white space or quote. Numbers and dates that fail validation are left alone, and so are ten bare digits, which are as
often no phone. A phone number is one value
however it is written: country code and national digits count, +1 where none is written. Secrets have no greatest length;
their characters are permuted in stretches of STRETCH, each by its number.

Defined results: null stays null; texts without values, empty ones included, are returned byte for byte; repeated rows get
equal results; other columns pass through.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import warnings
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from groundplan.llm import textscan
from groundplan.llm.frames import fresh, map_arrow

KINDS = ("email", "card", "phone", "ssn", "iban", "ip", "date", "access_key", "secret")
#: For tests and demonstrations: whoever has this source can undo it. A real key is a secret in the setting KEY_SETTING.
DEMO_KEY = b"groundplan demonstration key"
KEY_SETTING = "spark.groundplan.pii.key"
STRETCH = 256
#: Country calling codes of one and two digits; all others have three (fixed values).
CODES_1 = frozenset("1 7".split())
CODES_2 = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
_LOW, _UP, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Other letters that are permuted among their like: Latin-1 and Latin Extended-A, Greek, Cyrillic, small and capital.
_LETTERS = [
    "".join(c for c in map(chr, range(lo, hi)) if c.isalpha() and c.islower() == small and c.isupper() != small and len(c.lower()) == len(c.upper()) == 1 and c.lower().upper().lower() == c.lower())
    for lo, hi in ((0xC0, 0x180), (0x370, 0x400), (0x400, 0x460))
    for small in (True, False)
]


class Feistel:
    """A keyed permutation of range(n)."""

    def __init__(self, key: bytes, label: str, n: int, rounds: int = 8):
        self.n, self.rounds = n, rounds
        self.half = max(1, ((n - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.bytes = (self.half + 7) // 8
        self.seeds = [hashlib.shake_128(len(key).to_bytes(4, "big") + key + f"|{label}|{n}|{r}".encode()) for r in range(rounds)]

    def _f(self, r: int, x: int) -> int:
        h = self.seeds[r].copy()
        h.update(x.to_bytes(self.bytes, "big"))
        return int.from_bytes(h.digest(self.bytes), "big") & self.mask

    def up(self, x: int) -> int:
        while True:
            a, b = x >> self.half, x & self.mask
            for r in range(self.rounds):
                a, b = b, a ^ self._f(r, b)
            x = a << self.half | b
            if x < self.n:
                return x

    def down(self, x: int) -> int:
        while True:
            a, b = x >> self.half, x & self.mask
            for r in reversed(range(self.rounds)):
                a, b = b ^ self._f(r, a), a
            x = a << self.half | b
            if x < self.n:
                return x

    def shift(self, x: int, by: int = 1) -> int:
        """E^-1(E(x) + by): without fixed points for n of 2 or more; by = -1 undoes by = 1."""
        return self.down((self.up(x) + by) % self.n)


class Pseudonyms:
    """Replaces the values of one text; step -1 undoes step 1."""

    def __init__(self, key: bytes, step: int = 1):
        self.key, self.step = key, step
        self.networks: dict[tuple[str, int], Feistel] = {}

    def number(self, label: str, x: int, n: int) -> int:
        if n < 2:
            return x
        if (label, n) not in self.networks:
            if len(self.networks) > 5000:
                self.networks.clear()
            self.networks[label, n] = Feistel(self.key, label, n)
        return self.networks[label, n].shift(x, self.step)

    def mixed(self, label: str, places: list[int], radices: list[int]) -> list[int]:
        """Permute a number written in mixed radices."""
        x, n = 0, 1
        for p, r in zip(places, radices, strict=True):
            x, n = x * r + p, n * r
        x = self.number(f"{label}|{radices}", x, n)
        out = []
        for r in reversed(radices):
            x, p = divmod(x, r)
            out.append(p)
        return out[::-1]

    def characters(self, label: str, text: str, alphabets: list[str]) -> str:
        """Permute the characters that are in an alphabet, each staying in its own; others stay."""
        out = list(text)
        for lo in range(0, len(text), STRETCH):
            at = [(i, a) for i in range(lo, min(lo + STRETCH, len(text))) for a in alphabets if text[i] in a]
            new = self.mixed(f"{label}|{lo}" if lo else label, [a.index(text[i]) for i, a in at], [len(a) for _, a in at])
            for (i, a), p in zip(at, new, strict=True):
                out[i] = a[p]
        return "".join(out)

    # One method for each kind; None: not valid, leave it.

    def card(self, m: re.Match) -> str | None:
        s = m["card"]
        digits = [int(c) for c in s if c.isdigit()]
        if luhn(digits) or len(set(digits)) == 1:
            return None
        body = [digits[0], *self.mixed("card", digits[1:-1], [10] * (len(digits) - 2))]
        return refill(s, [*body, -luhn([*body, 0]) % 10])

    def phone(self, m: re.Match) -> str | None:
        s = m["phone"]
        every = "".join(c for c in s if c.isdigit())
        code = calling_code(every) if s[0] == "+" else ""
        digits = [int(c) for c in every[len(code) :]]
        if not 7 <= len(digits) <= 12:
            return None
        if s[0] == "0":  # a national prefix stays
            return refill(s, [0, *self.mixed("phone0", digits[1:], [10] * (len(digits) - 1))])
        first, lowest = (8, 2) if digits[0] >= 2 else (2, 0)
        new = self.mixed(f"phone+{code or '1'}", [digits[0] - lowest, *digits[1:]], [first, *[10] * (len(digits) - 1)])
        return refill(s, [*map(int, code), new[0] + lowest, *new[1:]])

    def ssn(self, m: re.Match) -> str | None:
        area, group, serial = (int(x) for x in m["ssn"].split("-"))
        if area in (0, 666) or area > 899 or not group or not serial:
            return None
        a, g, n = self.mixed("ssn", [area - 1 - (area > 666), group - 1, serial - 1], [898, 99, 9999])
        return f"{a + 1 + (a >= 665):03}-{g + 1:02}-{n + 1:04}"

    def iban(self, m: re.Match) -> str | None:
        s = m["iban"]
        if s.islower():
            new = self._iban(s.upper())
            return new and new.lower()
        return self._iban(s)

    def _iban(self, s: str) -> str | None:
        flat = s.replace(" ", "")
        if not 15 <= len(flat) <= 34 or mod97(flat[4:] + flat[:4]) != 1:
            return None
        body = self.characters(f"iban{flat[:2]}", flat[4:], [_UP, _DIGIT])
        new = iter(flat[:2] + f"{98 - mod97(body + flat[:2] + '00'):02}" + body)
        return "".join(c if c == " " else next(new) for c in s)

    def ip(self, m: re.Match) -> str | None:
        parts = [int(x) for x in m["ip"].split(".")]
        if max(parts) > 255:
            return None
        if 1 <= parts[0] <= 223:
            a, *rest = self.mixed("ip", [parts[0] - 1, *parts[1:]], [223, 256, 256, 256])
            return ".".join(map(str, [a + 1, *rest]))
        a, *rest = self.mixed("ip-other", [max(0, parts[0] - 223), *parts[1:]], [33, 256, 256, 256])  # 0 and 224 to 255
        return ".".join(map(str, [a + 223 if a else 0, *rest]))

    def date(self, m: re.Match) -> str | None:
        s = m["date"]
        a, b, c = re.split(r"[-/.]", s)
        sep = s[len(a)]
        order = "ymd" if len(a) == 4 else "mdy" if sep == "/" and int(a) <= 12 else "dmy"
        parts = dict(zip(order, (int(a), int(b), int(c)), strict=True))
        try:
            day = dt.date(parts["y"], parts["m"], parts["d"])
        except ValueError:
            return None
        if not 1900 <= day.year <= 2099:
            return None
        first, n = dt.date(1900, 1, 1).toordinal(), 73_049
        new = dt.date.fromordinal(first + self.number("date", day.toordinal() - first, n))
        text = {"y": f"{new.year:04}", "m": f"{new.month:02}", "d": f"{new.day:02}"}
        return sep.join(text[k] for k in order)

    def email(self, m: re.Match) -> str | None:
        local, _, domain = m["email"].partition("@")
        small = "".join(c.lower() if len(c.lower()) == 1 else c for c in local)
        new = self.characters(f"email@{domain.lower()}", small, [_LOW, _DIGIT, *_LETTERS])
        return f"{new}@{domain}" if new != local else None

    def access_key(self, m: re.Match) -> str | None:
        s = m["access_key"]
        return s[:4] + self.characters("access_key", s[4:], [_UP + _DIGIT])

    def secret(self, m: re.Match) -> str | None:
        s = m["secret"]
        if re.fullmatch("[0-9a-f]+", s):
            return self.characters("secret", s, ["0123456789abcdef"])
        new = self.characters("secret", s, [_LOW, _UP, _DIGIT, *_LETTERS])
        return new if new != s else None

    def replace(self, text: str, found: Counter | None = None) -> str:
        def one(m: re.Match) -> str:
            kind = m.lastgroup
            new = getattr(self, kind)(m)
            if new is None:
                return m[0]
            if found is not None:
                found[kind] += 1
            at = m.start(kind) - m.start()
            return m[0][:at] + new + m[0][at + len(m[kind]) :]

        return PATTERN.sub(one, text)


PATTERN = re.compile(
    r"""
      (?<![\w.%+À-ɏͰ-ӿ-])(?P<email>[A-Za-z0-9À-ɏͰ-ӿ][A-Za-z0-9._%+À-ɏͰ-ӿ-]*+@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24})(?![\w-])
    | (?<![\w])(?P<access_key>(?:AKIA|ASIA)[A-Z0-9]{16})(?![\w])
    | (?i:\b(?:pass(?:word|wd)|token|secret|api[_-]?key)["']?[ ]{0,3}[=:][ ]{0,3}["']?)(?P<secret>[^\s"'<>]{6,}[^\s"'<>.,;:!?)\]}])
    | (?<![\w])(?P<iban>[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?|[a-z]{2}[0-9]{2}[a-z0-9]{11,30})(?![\w])
    | (?<![\w.-])(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![\w-])
    | (?<![\w./-])(?P<date>[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{4}/[0-9]{2}/[0-9]{2})(?![\w/-]|\.[0-9])
    | (?<![\w.])(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![\w]|\.[0-9])
    | (?<![\w+])(?P<card>[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![\w]|-[0-9])
    | (?<![\w])(?P<phone>\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}|\([0-9]{3}\)[ ]?[0-9]{3}[ .-][0-9]{4}|0[0-9]{1,4}[ .-][0-9]{3,4}[ .-][0-9]{3,4}|[2-9][0-9]{2}[.-][0-9]{3}[.-][0-9]{4})(?![\w]|-[0-9])
    """,
    re.VERBOSE | re.ASCII,
)
_TRIGGER = np.zeros(256, bool)
_TRIGGER[[*b"0123456789@=:"]] = True


def luhn(digits: list[int]) -> int:
    """The Luhn sum by 10; 0 for a valid number."""
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))) % 10


def mod97(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s)) % 97


def calling_code(digits: str) -> str:
    """The country calling code that an international number starts with; no code starts with another."""
    return digits[:1] if digits[:1] in CODES_1 else digits[:2] if digits[:2] in CODES_2 else digits[:3]


def refill(form: str, digits: list[int]) -> str:
    """The form with its digits replaced in order."""
    new = iter(digits)
    return "".join(str(next(new)) if c.isdigit() else c for c in form)


def session_key(spark: SparkSession) -> bytes:
    """The key that the session's KEY_SETTING holds; the demonstration key where it is unset, with a warning."""
    key = spark.conf.get(KEY_SETTING, "").encode()
    if not key:
        warnings.warn(f"{KEY_SETTING} is unset: pseudonyms are made with a key that everybody has, and can be undone", stacklevel=2)
    return key or DEMO_KEY


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", counts: str | None = None, step: int = 1) -> DataFrame:
    """docs with the values in `text` replaced by `key`; `counts` names a further map<string, long> column of how many of each kind."""
    fields = [T.StructField(f.name, T.StringType() if f.name == text else f.dataType, f.nullable) for f in docs.schema.fields]
    out = T.StructType([*fields, *([T.StructField(counts, T.MapType(T.StringType(), T.LongType()))] if counts else [])])
    source = docs if dict(docs.dtypes)[text] == "string" else docs.withColumn(text, F.col(f"`{text}`").cast("string"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key, step)
        for batch in it:
            col = batch.column(text)
            rows: list[int] = []
            for s in textscan.slices(col):
                at = np.flatnonzero(_TRIGGER[s.data])
                rows += (np.flatnonzero(textscan.count_at(at, s.offs)) + s.lo).tolist()
            new, found = [], {}
            for i, old in zip(rows, col.take(pa.array(rows, pa.int64())).to_pylist(), strict=True):
                new.append(names.replace(old, tally := Counter()))
                if tally:
                    found[i] = sorted(tally.items())
            if found:
                mask = np.zeros(len(col), bool)
                mask[rows] = True
                col = pc.replace_with_mask(col, pa.array(mask), pa.array(new, col.type))
            columns = [col if n == text else c for n, c in zip(batch.schema.names, batch.columns, strict=True)]
            if counts:
                columns.append(pa.array([found.get(i, []) for i in range(len(col))], pa.map_(pa.string(), pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return map_arrow(source, run, out)


def op1_pii_pseudonyms(spark, sf_dir: str) -> DataFrame:
    """Every document with its personal values replaced, and how many of each kind were."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    c = fresh(docs, "counts")
    done = pseudonymise(docs, session_key(spark), counts=c)
    return done.select("doc_id", "text", *[F.coalesce(F.element_at(c, k), F.lit(0)).alias(f"n_{k}") for k in KINDS])
