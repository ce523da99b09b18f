"""Date columns: strict parsing of date strings to UTC, never inventing a date.

Spark's pattern-less parsing accepts "2026", "2026-01" or "12:00" (the last one as today), so
a date's whole shape is matched first. The first characters say which family of shapes a string can belong
to; the family's one regex then gives all fields in one pass (they are written out with bars between,
and split), and a strict constructor rejects impossible days. Field shapes follow ``strptime`` (one- or
two-digit month/day/hour, space-padded day, case-insensitive letters). The expressions are made as
text, which is parsed at once, because Columns are put together call by call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import let_text, py_strip

_Y = r"([0-9]{4})"
_MO = r"(1[0-2]|0[1-9]|[1-9])"
_D = r"(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
_H = r"(2[0-3]|[01][0-9]|[0-9])"
_MI = r"([0-5][0-9]|[0-9])"
_S = r"(6[01]|[0-5][0-9]|[0-9])"
_Z = r"([Zz]|[+-][0-9]{2}:?[0-5][0-9](?::?[0-5][0-9](?:\.[0-9]{1,6})?)?)"
_FRAC = r"(?:\.[0-9]{1,6})"

# FIXED VALUES: English month names as strptime reads them (%B full, %b abbreviated).
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december"]
MONTHS_ABBR = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


#: Begins the fields of a string that matched; a string that begins with it is no date.
_MARK = "\x01"


def _fields(s: str, rx: str, groups: int, then) -> str:
    """``then`` of the array of the regex's groups; NULL if ``s`` does not match it whole."""
    out = _MARK + "|".join(f"${i}" for i in range(1, groups + 1))
    found = f"split(regexp_replace({s}, r'^{rx}$', '{out}'), '[|]')"
    return (f"element_at(transform(array({found}), f -> CASE WHEN size(f) = {groups} AND startswith(f[0], '{_MARK}') AND NOT startswith({s}, '{_MARK}')"
            f" THEN {then(['substring(f[0], 2)', *[f'f[{i}]' for i in range(1, groups)]])} END), 1)")


def _offset(zone: str) -> str:
    """Signed offset of ±HH[[:]MM[[:]SS[.f]]] in seconds; 0 for Z or no zone."""
    digits = f"rpad(translate(split_part({zone}, '.', 1), '+-:', ''), 6, '0')"
    seconds = f"int(substring({digits}, 1, 2)) * 3600 + int(substring({digits}, 3, 2)) * 60 + int(substring({digits}, 5, 2))"
    return f"CASE WHEN {zone} = '' OR upper({zone}) = 'Z' THEN 0 WHEN startswith({zone}, '-') THEN -({seconds}) ELSE {seconds} END"


def _ts(y: str, mo: str, d: str, h: str = "'0'", mi: str = "'0'", s: str = "'0'", zone: str = "''") -> str:
    """UTC timestamp from string fields (an empty one is 0); NULL for an impossible date or a leap second."""
    n = lambda x: x if x.startswith("(") else f"int(trim({x}))"
    or_zero = lambda x: f"(CASE WHEN {x} = '' THEN 0 ELSE int({x}) END)"
    made = f"try_make_timestamp({n(y)}, {n(mo)}, {n(d)}, {or_zero(h)}, {or_zero(mi)}, {or_zero(s)}, 'UTC')"
    ok = f"int({y}) > 0 AND {or_zero(s)} < 60"
    return f"CASE WHEN {ok} THEN timestamp_seconds(unix_seconds({made}) - ({_offset(zone)})) END"


def _iso(s: str, fraction: bool) -> str:
    """YYYY-MM-DD, or with T or white space and a time, and a zone. After white space, and with ``fraction``
    everywhere, the other shapes of ``strptime`` hold: a small z only after T, fractions only where they are read,
    white space only where fractions are not."""
    rx = f"{_Y}-{_MO}-{_D}(?:([Tt]|\\s+){_H}:{_MI}:{_S}({_FRAC})?{_Z}?)?"
    spaced = "(f[3] <> '' AND lower(f[3]) <> 't')"
    refused = f"{spaced}" if fraction else f"f[7] <> '' OR ({spaced} AND f[8] = 'z')"
    return _fields(s, rx, 9, lambda g: f"CASE WHEN NOT ({refused}) THEN {_ts(*g[:3], *g[4:7], g[8])} END")


def _named(s: str, month_first: bool) -> str:
    names = "|".join([*MONTHS, *MONTHS_ABBR])
    table = "map(" + ", ".join(f"'{m}', {i % 12 + 1}" for i, m in enumerate([*MONTHS, *MONTHS_ABBR]) if m != "may" or i < 12) + ")"
    rx = f"(?i)({names})\\s+{_D},\\s+{_Y}" if month_first else f"(?i){_D}\\s+({names})\\s+{_Y}"

    def then(g):
        month, day, year = g if month_first else (g[1], g[0], g[2])
        return _ts(year, f"({table}[lower({month})])", day)

    return _fields(s, rx, 3, then)


def _from_iso(s: str) -> str:
    """The ISO fallback: YYYY-MM-DD or YYYYMMDD, then optionally one separator and
    HH[:MM[:SS[.f]]] and a zone; "Z" is read as +00:00. Week dates stay NULL."""
    rx = (r"([0-9]{4})-?([0-9]{2})-?([0-9]{2})(?:.([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,][0-9]+)?)?)?"
          r"([+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2}(?:\.[0-9]{1,6})?)?)?)?)?")
    return _fields(f"replace({s}, 'Z', '+00:00')", rx, 7, lambda g: _ts(*g))


def _digits_first(s: str) -> str:
    return f"(substring({s}, 1, 1) BETWEEN '0' AND '9')"


def meta_datetime_text(s: str) -> str:
    """X7 of a stripped string, as text."""
    return f"CASE WHEN {_digits_first(s)} THEN coalesce({_iso(s, True)}, {_from_iso(s)}) END"


def iso_date_text(s: str) -> str:
    """X5 of a stripped string, as text."""
    iso = f"coalesce({_iso(s, False)}, {_from_iso(s)})"
    return (f"CASE WHEN NOT {_digits_first(s)} THEN {_named(s, True)} WHEN substring({s}, 5, 1) BETWEEN '-' AND '9' THEN {iso}"
            f" ELSE {_named(s, False)} END")


def meta_datetime(c: Column) -> Column:
    """A metadata date string → UTC timestamp (naive read as UTC), NULL on failure."""
    return let_text(py_strip(c), "s", meta_datetime_text("s"))


def iso_date(c: Column) -> Column:
    """A date string in one of the accepted formats → UTC timestamp, NULL otherwise."""
    return let_text(py_strip(c), "s", iso_date_text("s"))


def utc_string(ts: Column) -> Column:
    """Timestamp → ISO-8601 UTC string like 2026-01-29T12:00:00Z (session time zone UTC)."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def add_iso_utc(df: DataFrame, src: str, out: str) -> DataFrame:
    """X5 as a step: adds the UTC string for the date text in ``src``."""
    tmp = f"__iso_{out}"
    return df.withColumn(tmp, py_strip(F.col(src))).withColumn(out, utc_string(iso_date(F.col(tmp)))).drop(tmp)
