"""Text columns: whitespace, paragraphs, summary, fingerprint, content gate, promo filters.

All Catalyst expressions. Whitespace means Unicode whitespace as Python's ``str.isspace``
defines it (Java's ``\\s`` misses U+001C-U+001F and RE2's ``\\s`` is ASCII only), spelled out
as one class that both Java regex and RE2 read the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire import constants as C

# FIXED VALUES: the characters Python treats as whitespace.
WS_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
WS_RUN = WS_CLASS + "+"
SENTENCE_SPLIT = r"(?<=[.!?])" + WS_RUN
# The same set as literal characters: the rare non-ASCII ones are mapped to a space first
# (``translate`` is a per-character lookup), so the hot regex only sees an ASCII class.
UNICODE_WS = "\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f " + UNICODE_WS
ASCII_WS_RUN = r"[\t\n\x0B\f\r\x1C-\x20]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body`` (``nullif``/``when`` on a
    costly expression would otherwise evaluate it twice)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def let_text(value: Column, name: str, body: str) -> Column:
    """As ``bind``, with the body as text, in which the value has a name."""
    return F.call_function("element_at", F.call_function("transform", F.array(value), F.expr(f"{name} -> {body}")), F.lit(1))


def py_strip(c) -> Column:
    """Strip leading and trailing Unicode whitespace (``btrim`` over the whitespace set)."""
    return F.btrim(_col(c), F.lit(WS_CHARS))


def normalize_ws(c) -> Column:
    """Collapse whitespace runs to one space, trim; NULL when nothing is left."""
    spaced = F.translate(_col(c), UNICODE_WS, " " * len(UNICODE_WS))
    return bind(F.trim(F.regexp_replace(spaced, ASCII_WS_RUN, " ")), lambda x: F.nullif(x, F.lit("")))


def normalize_ws_text(s: str) -> str:
    """``normalize_ws`` of an expression given as text."""
    spaced = f"translate({s}, '{UNICODE_WS}', '{' ' * len(UNICODE_WS)}')"
    return f"element_at(transform(array(trim(regexp_replace({spaced}, r'{ASCII_WS_RUN}', ' '))), w -> nullif(w, '')), 1)"


def normalize_paragraphs(paragraphs) -> Column:
    """Strip each paragraph, drop blanks, join with a blank line."""
    kept = F.filter(F.transform(_col(paragraphs), py_strip), lambda p: p != "")
    return F.array_join(kept, "\n\n")


def content_length(text) -> Column:
    """Length in code points, 0 when missing."""
    return F.coalesce(F.length(_col(text)), F.lit(0))


def fingerprint(title, text, published_at, source) -> Column:
    """SHA-256 of title|text[:2000] when there is text, else title|published_at|source."""
    title, text = _col(title), _col(text)
    with_text = F.concat(F.coalesce(title, F.lit("")), F.lit("|"), F.substring(text, 1, C.FINGERPRINT_TEXT_CHARS))
    without = F.concat(F.coalesce(title, F.lit("")), F.lit("|"), F.coalesce(_col(published_at), F.lit("")),
                       F.lit("|"), F.coalesce(_col(source), F.lit("")))
    return F.sha2(F.when(F.length(text) > 0, with_text).otherwise(without), 256)


def truncated_summary(n: Column, max_chars: Column | int = C.SUMMARY_MAX_CHARS) -> Column:
    """A normalized summary, cut at the last space inside the limit if it is longer, trailing
    ``.,!?;:`` removed and "..." added."""
    cut = F.regexp_replace(F.substring(n, 1, F.lit(max_chars)), " [^ ]*$", "")
    cut = F.concat(F.regexp_replace(cut, "[.,!?;:]+$", ""), F.lit("..."))
    return F.when(F.length(n) > max_chars, cut).otherwise(n)


def add_summary(df: DataFrame, src: str, out: str = "summary", flag: str = "summary_truncated",
                max_chars: Column | int = C.SUMMARY_MAX_CHARS) -> DataFrame:
    """First five sentences, whitespace-normalized; above ``max_chars`` cut at the
    last space inside the limit, trailing ``.,!?;:`` removed and "..." added (flag set)."""
    norm = f"__sum_norm_{out}"
    first = F.array_join(F.slice(F.split(F.col(src), SENTENCE_SPLIT), 1, C.SUMMARY_SENTENCES), " ")
    df = df.withColumn(norm, F.when(F.length(F.col(src)) > 0, normalize_ws(first)))
    n = F.col(norm)
    df = df.withColumn(out, truncated_summary(n, max_chars)) \
           .withColumn(flag, F.coalesce(F.length(n) > max_chars, F.lit(False)))
    return df.drop(norm)


def nav_junk(text) -> Column:
    """More than 10 lines and more than 70 % of them shorter than 30 chars once stripped."""
    lines = F.split(_col(text), "\n")
    short = F.size(F.filter(lines, lambda ln: F.length(py_strip(ln)) < C.NAV_JUNK_SHORT_LINE))
    return (F.size(lines) > C.NAV_JUNK_MIN_LINES) & (short / F.size(lines) > C.NAV_JUNK_SHARE)


def content_gate(title, text) -> Column:
    """non-blank title, stripped text of at least 250 chars, and not navigation junk."""
    title, text = _col(title), _col(text)
    stripped = py_strip(F.coalesce(text, F.lit("")))
    return (F.coalesce(F.length(py_strip(title)) > 0, F.lit(False))
            & (F.length(stripped) >= C.MIN_ARTICLE_TEXT_LENGTH)
            & ~F.coalesce(nav_junk(stripped), F.lit(False)))


def low_quality_to_null(text) -> Column:
    """normalized text shorter than 200 chars becomes NULL."""
    return bind(_col(text), lambda t: F.when(F.length(t) >= C.LOW_QUALITY_TEXT_LENGTH, t))


def _is_upper(p: Column) -> Column:
    # Python isupper: no lower-case letter and at least one cased letter
    return (F.upper(p) == p) & (F.lower(p) != p)


def fox_promo_keep(paragraphs) -> Column:
    """stripped paragraphs without blanks, WATCH: lines, short lines or short all-caps."""
    ps = F.transform(_col(paragraphs), py_strip)
    return F.filter(ps, lambda p: (p != "")
                    & ~F.upper(p).startswith(C.FOX_PROMO_PREFIX)
                    & (F.length(p) >= C.FOX_MIN_PARAGRAPH)
                    & ~(_is_upper(p) & (F.length(p) < C.FOX_CAPS_MAX)))


def nbc_promo_keep(paragraphs) -> Column:
    """stripped paragraphs without blanks, short lines or promo phrases."""
    ps = F.transform(_col(paragraphs), py_strip)
    phrase = "|".join(C.NBC_PROMO_PHRASES)
    return F.filter(ps, lambda p: (p != "") & (F.length(p) >= C.NBC_MIN_PARAGRAPH)
                    & ~F.lower(p).rlike(phrase))


def split_keywords(kw: Column) -> Column:
    """P7 (string form): split on ",", trim, drop blanks."""
    return F.filter(F.transform(F.split(kw, ","), py_strip), lambda k: k != "")
