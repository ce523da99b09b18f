"""Personal data: format-preserving Feistel pseudonyms.

Validated values are replaced by values of the same format: card numbers pass the Luhn check again,
IBANs their remainder, dates are days of the calendar, addresses have parts up to 255, social
security numbers keep to the issued ranges. A value is numbered within all values of its format;
the number is permuted under a key and written back with the signs it had. Equal values (the
digits count, not the signs between them) get equal pseudonyms, so documents stay linked.

The permutation is P^-1(P(x) + s mod n): P is a Feistel network on two parts of the range of n
values, repeated until it lands in the range; s is a keyed step between 1 and n - 1. It is a
permutation under which no value stays as it is. Letters and digits of mail addresses and secrets
are permuted in the same way, letter for letter and digit for digit; a value of more than
AT_ONCE signs in parts, each under a permutation that depends on all before it.

Everything else in a text is left as it is, byte for byte.

Defined results. A null text stays null, with no spans; an empty text is empty. Values that fail
validation are left alone. Mail addresses and secrets reach to their end, however long. Overlapping
finds: the first, then the longest. Texts are read whole;
finds are local, so a long text takes memory in proportion to its own length only."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import fresh, map_column

#: The key of the test tables. A job passes its own, or names it in the setting KEY.
DEMO_KEY = b"a key for the test tables only"
KEY = "quire.pii.key"
ROUNDS = 10
#: Signs that are permuted together: half of their range stays well below the 512 bits of a round's word.
AT_ONCE = 128
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
MONTHS = "January February March April May June July August September October November December".split()

SPAN = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()), T.StructField("kind", T.StringType())])
RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("spans", T.ArrayType(SPAN))])
_ARROW_RESULT = pa.struct([("text", pa.string()), ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("kind", pa.string())])))])


class Permutation:
    """Keyed permutation of 0 .. n - 1 without fixed values (n > 1), one for each ``format``."""

    def __init__(self, key: bytes, format: str, n: int):
        self.key, self.format, self.n = hashlib.blake2b(key, digest_size=32).digest(), format.encode(), n
        self.a = math.isqrt(max(n - 1, 0)) + 1
        self.b = -(-n // self.a)
        self.step = 1 + self._word(255, n) % (n - 1) if n > 1 else 0

    def _word(self, i: int, x: int) -> int:
        h = hashlib.blake2b(b"%d|%s|%d|%d" % (i, self.format, self.n, x), key=self.key, digest_size=64)
        return int.from_bytes(h.digest(), "big")

    def _forward(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in range(ROUNDS):
            if i % 2:
                right = (right + self._word(i, left)) % self.b
            else:
                left = (left + self._word(i, right)) % self.a
        return left * self.b + right

    def _back(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in reversed(range(ROUNDS)):
            if i % 2:
                right = (right - self._word(i, left)) % self.b
            else:
                left = (left - self._word(i, right)) % self.a
        return left * self.b + right

    def _walk(self, once, x: int) -> int:
        x = once(x)
        while x >= self.n:  # the two parts reach a little beyond the range
            x = once(x)
        return x

    def __call__(self, x: int, inverse: bool = False) -> int:
        if self.n < 2:
            return x
        return self._walk(self._back, (self._walk(self._forward, x) + (-self.step if inverse else self.step)) % self.n)


def luhn_digit(digits: str) -> str:
    """The check digit that follows ``digits``."""
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


def refill(shape: str, chars: str) -> str:
    """``shape`` with its letters and digits replaced in order by ``chars``."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def by_class(p, format: str, value: str, classes) -> str:
    """Permute a string within the strings whose characters are of the same classes."""
    if len(value) <= AT_ONCE:
        return _by_class(p, format, value, classes)
    seen, out = hashlib.blake2b(b"%d|" % len(value), digest_size=16), []
    for a in range(0, len(value), AT_ONCE):
        part = value[a:a + AT_ONCE]
        out.append(_by_class(p, f"{format} {seen.hexdigest()}", part, classes))
        seen.update(part.encode())
    return "".join(out)


def _by_class(p, format: str, value: str, classes) -> str:
    sets = [next((s for s in classes if c in s), None) for c in value]
    n, x = 1, 0
    for c, s in zip(value, sets):
        if s:
            n, x = n * len(s), x * len(s) + s.index(c)
    x = p(format, n)(x)
    out = []
    for c, s in zip(reversed(value), reversed(sets)):
        if s:
            x, k = divmod(x, len(s))
            c = s[k]
        out.append(c)
    return "".join(reversed(out))


DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALNUM = (DIGITS, LOWER, UPPER)
HEX = ("0123456789abcdef",)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def card(p, s: str) -> str | None:
    d = _digits(s)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    body = by_class(p, f"card {d[0]}", d[1:-1], (DIGITS,))
    return refill(s, d[0] + body + luhn_digit(d[0] + body))


def ssn(p, s: str) -> str | None:
    area, group, serial = (int(x) for x in re.split("[- ]", s))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = [a for a in range(1, 900) if a != 666]
    n = len(areas) * 99 * 9999
    x = p("ssn", n)((areas.index(area) * 99 + group - 1) * 9999 + serial - 1)
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    return refill(s, f"{areas[area]:03d}{group + 1:02d}{serial + 1:04d}")


def ip(p, s: str) -> str | None:
    parts = [int(x) for x in s.split(".")]
    if max(parts) > 255:
        return None
    x = p("ip", 1 << 32)(int.from_bytes(bytes(parts), "big"))
    return ".".join(map(str, x.to_bytes(4, "big")))


def phone(p, s: str) -> str | None:
    d = _digits(s)
    if not 9 <= len(d) <= 15:
        return None
    keep = 1 if s[0] == "+" and d[0] in "17" else 2 if s[0] == "+" else 0
    body = by_class(p, "phone", d[keep:], (DIGITS,))
    return refill(s, d[:keep] + body)


def iban(p, s: str) -> str | None:
    v = s.replace(" ", "")
    if not 15 <= len(v) <= 34 or iban_check(v[:2], v[4:]) != v[2:4]:
        return None
    rest = by_class(p, f"iban {v[:2]}", v[4:], (DIGITS, UPPER))
    return refill(s, v[:2] + iban_check(v[:2], rest) + rest)


def _day(p, year: int, month: int, day: int) -> dt.date | None:
    try:
        x = dt.date(year, month, day).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= x <= LAST_DAY:
        return None
    return dt.date.fromordinal(FIRST_DAY + p("date", LAST_DAY - FIRST_DAY + 1)(x - FIRST_DAY))


def numeric_date(p, s: str) -> str | None:
    """Year first, or last: then day first, unless only month first gives a day. Parts keep at
    least the digits they had."""
    parts = re.split(r"([-/.])", s)
    a, b, c = parts[0], parts[2], parts[4]
    if len(a) == 4:
        order = ("ymd",)
    elif parts[1] == "/":
        order = ("mdy", "dmy")
    else:
        order = ("dmy", "mdy")
    for o in order:
        v = dict(zip(o, (a, b, c)))
        new = _day(p, int(v["y"]), int(v["m"]), int(v["d"]))
        if new:
            out = {"y": f"{new.year:04d}", "m": str(new.month).zfill(len(v["m"])), "d": str(new.day).zfill(len(v["d"]))}
            return parts[1].join(out[x] for x in o)
    return None


def written_date(p, s: str) -> str | None:
    m = re.fullmatch(r"([A-Za-z]+)(\.?)( +)(\d{1,2})((?:st|nd|rd|th)?,? +)(\d{4})", s)
    first = bool(m)
    m = m or re.fullmatch(r"(\d{1,2})((?:st|nd|rd|th|\.)? +)([A-Za-z]+)(\.?,? +)(\d{4})", s)
    if not m:
        return None
    name, day, year = (m[1], m[4], m[6]) if first else (m[3], m[1], m[5])
    month = next((i for i, x in enumerate(MONTHS, 1) if x.lower().startswith(name.lower()[:3])), 0)
    new = _day(p, int(year), month, int(day)) if month else None
    if not new:
        return None
    said = MONTHS[new.month - 1] if len(name) > 3 or name.lower() == "may" else MONTHS[new.month - 1][:3]
    said = said.upper() if name.isupper() else said.lower() if name.islower() else said
    d = str(new.day).zfill(2) if day[0] == "0" else str(new.day)
    gap = lambda g: re.sub("st|nd|rd|th", "th" if 10 <= new.day % 100 <= 20 else {1: "st", 2: "nd", 3: "rd"}.get(new.day % 10, "th"), g)
    if first:
        return f"{said}{m[2]}{m[3]}{d}{gap(m[5])}{new.year:04d}"
    return f"{d}{gap(m[2])}{said}{m[4]}{new.year:04d}"


def email(p, s: str) -> str:
    local, _, host = s.rpartition("@")
    labels = host.split(".")
    new = by_class(p, "mail host", ".".join(labels[:-1]).lower(), ALNUM)
    return f"{by_class(p, 'mail', local.lower(), ALNUM)}@{new}.{labels[-1]}"


def secret(p, s: str) -> str:
    if re.fullmatch("[0-9a-f]+", s):
        return by_class(p, "hex", s, HEX)
    return by_class(p, "secret", s, ALNUM)


_MONTH = "(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:t(?:ember)?)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
#: A run of digits with the signs that may stand between them; values are looked for within runs.
RUN = re.compile(r"[0-9](?:[ ().\-/]{0,3}[0-9])+")
NUMBERS = [
    ("date", r"(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})", numeric_date),
    ("ip", r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}", ip),
    ("ssn", r"(?:\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4})", ssn),
    ("card", r"(?:\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5}|\d{13,19})", card),
    ("phone", r"(?:\+\d{1,3}[ .-]?(?:\(\d{1,5}\)|\d{1,5})(?:[ .-]?\d{2,5}){1,4}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})", phone),
]
NUMBERS = [(kind, re.compile(r"(?<![0-9A-Za-z])" + x + r"(?![0-9A-Za-z])"), f) for kind, x, f in NUMBERS]
WRITTEN = re.compile(rf"\b(?:{_MONTH}\.? +\d{{1,2}}(?:st|nd|rd|th)?,? +\d{{4}}|\d{{1,2}}(?:st|nd|rd|th|\.)? +{_MONTH}\.?,? +\d{{4}})\b", re.I | re.A)
IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")
SECRET = re.compile(r"(?i)\b(?:token|secret|passwd|password|api[_-]?key|access[_-]?key)\b[\"']?\s{0,3}[=:]\s{0,3}[\"']?([0-9a-z_\-./+]{8,})", re.A)
#: A time of day right after a date, as in 2024-05-06T07:08.
CLOCK = re.compile(r"T[0-2][0-9]:[0-5][0-9]")
KEYS = re.compile(r"(?<![0-9A-Za-z])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|[0-9a-f]{40}|[0-9a-f]{64})(?![0-9A-Za-z])")
MAIL_LOCAL = frozenset(DIGITS + LOWER + UPPER + "._%+-")
MAIL_HOST = re.compile(r"[0-9A-Za-z][0-9A-Za-z\-]*(?:\.[0-9A-Za-z\-]+)*\.[A-Za-z]{2,}(?![0-9A-Za-z])")


def finds(text: str, p) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of all values, in order, without overlaps."""
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        at = text.find("@")
        while at >= 0:
            a, host = at, MAIL_HOST.match(text, at + 1)
            if host:
                while a and text[a - 1] in MAIL_LOCAL:
                    a -= 1
                while text[a] == ".":
                    a += 1
            if a < at and text[at - 1] != ".":
                found.append((a, host.end(), "email", email(p, text[a:host.end()])))
            at = text.find("@", at + 1)
    for m in SECRET.finditer(text):
        found.append((m.start(1), m.end(1), "secret", secret(p, m[1])))
    runs = list(RUN.finditer(text))
    if runs or "AKIA" in text:
        for m in KEYS.finditer(text):
            found.append((m.start(), m.end(), "secret", secret(p, m[0])))
        for m in WRITTEN.finditer(text):
            if new := written_date(p, m[0]):
                found.append((m.start(), m.end(), "date", new))
        for m in IBAN.finditer(text):
            if new := iban(p, m[0]):
                found.append((m.start(), m.end(), "iban", new))
    for run in runs:
        if run.end() - run.start() < 7:
            continue
        a, b = run.span()
        while a and text[a - 1] in "+(" and run.start() - a < 2:
            a -= 1
        # places taken by earlier kinds, in order; they do not overlap
        starts: list[int] = []
        ends: list[int] = []
        for kind, pattern, f in NUMBERS:
            for m in pattern.finditer(text, a, b):
                x, y = m.span()
                if y == b and text[y:y + 1].isalnum() and not (kind == "date" and CLOCK.match(text, y)):
                    continue
                k = bisect_left(starts, y)
                if k and ends[k - 1] > x:
                    continue
                if new := f(p, m[0]):
                    found.append((x, y, kind, new))
                    starts.insert(k, x)
                    ends.insert(k, y)
    out, last = [], 0
    for f in sorted(found, key=lambda f: (f[0], -f[1])):
        if f[0] >= last:
            out.append(f)
            last = f[1]
    return out


def permutations(key: bytes):
    """p(format, n): the permutation for a format, kept between calls."""
    return lru_cache(maxsize=512)(lambda format, n: Permutation(key, format, n))


def pseudonymise(text: str, p) -> tuple[str, list[dict]]:
    parts, spans, last = [], [], 0
    for a, b, kind, new in finds(text, p):
        parts += [text[last:a], new]
        last = b
        spans.append({"first": a, "last": b, "kind": kind})
    return "".join([*parts, text[last:]]) if spans else text, spans


def replaced(docs: DataFrame, out: str, text: str = "text", key: bytes = DEMO_KEY) -> DataFrame:
    """``docs`` with ``out``: struct(text with pseudonyms, spans in the old text). No shuffle."""
    def make():
        p = permutations(key)

        def f(column):
            rows = []
            for t in column.to_pylist():
                new, spans = (t, []) if t is None else pseudonymise(t, p)
                rows.append({"text": new, "spans": spans})
            return pa.array(rows, type=_ARROW_RESULT)
        return f

    return map_column(docs, text, out, RESULT, make)


def job_key(spark) -> bytes:
    """The key of the setting KEY; without it, that of the test tables."""
    said = spark.conf.get(KEY, None)
    return said.encode() if said else DEMO_KEY


def query(docs: DataFrame) -> DataFrame:
    """doc_id, text with pseudonyms, number of values replaced, their kinds and places."""
    return replaced(docs.select("doc_id", "text"), "r", key=job_key(docs.sparkSession)).select(
        "doc_id", "r.text", F.size("r.spans").cast("long").alias("n_found"), "r.spans")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; ``text`` has pseudonyms, ``n_chars`` (if there) is its new length where the
    text changed."""
    out = fresh(docs, "__new")
    changed = F.size(F.col(out)["spans"]) > 0
    rows = replaced(docs, out, key=job_key(spark)).withColumn("text", F.col(out)["text"])
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.drop(out)
