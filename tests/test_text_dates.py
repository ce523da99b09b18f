"""Text and date columns against Python semantics (brute force on fixtures)."""
import hashlib
import re
from datetime import datetime, timezone

from pyspark.sql import functions as F

from quire.functions import dates as D
from quire.functions import text as T


def py_norm(t):
    if not t:
        return None
    n = re.sub(r"\s+", " ", t).strip()
    return n or None


def py_summary(text):
    if not text:
        return None, False
    n = py_norm(" ".join(re.split(r"(?<=[.!?])\s+", text)[:5]))
    if not n:
        return None, False
    if len(n) > 512:
        return n[:512].rsplit(" ", 1)[0].rstrip(".,!?;:") + "...", True
    return n, False


WS = ["a b", "a\x1cb\x1fc", "a\u0085b", "x　y z", "  lead and trail \n\t", "", " \n ", "plain"]
SUMMARY = ["A. B! C? D. E. F. G.", "x" * 513, ("word " * 120).strip(), ("w" * 600) + " tail.", "One sentence only",
           "Ends with dots... and more.", ("a" * 511) + " b", ("a" * 510) + ". bcd"]


def test_normalize_ws(spark):
    df = spark.createDataFrame([(s,) for s in WS], "t string")
    out = {r.t: r.n for r in df.select("t", T.normalize_ws(F.col("t")).alias("n")).collect()}
    for s in WS:
        assert out[s] == py_norm(s), repr(s)


def test_summary(spark):
    df = T.add_summary(spark.createDataFrame([(s,) for s in SUMMARY], "t string"), "t", "s", "f")
    for r in df.collect():
        assert (r.s, r.f) == py_summary(r.t), r.t[:40]


def test_fingerprint(spark):
    df = spark.createDataFrame([("T", "body " * 500, None, "cnn.com"), ("T", None, "2026-01-01T00:00:00Z", "cnn.com"),
                                (None, "", None, "x")], "title string, text string, pub string, src string")
    got = [r.f for r in df.select(T.fingerprint("title", "text", "pub", "src").alias("f")).collect()]
    exp = [hashlib.sha256(f"T|{('body ' * 500)[:2000]}".encode()).hexdigest(),
           hashlib.sha256(b"T|2026-01-01T00:00:00Z|cnn.com").hexdigest(),
           hashlib.sha256(b"||x").hexdigest()]
    assert got == exp


def test_content_gate_and_nav_junk(spark):
    long_text = "A real paragraph of article text that is long enough. " * 6
    junk = "\n".join(["Home", "World", "Sport"] * 5) + "\n" + "x" * 300
    df = spark.createDataFrame([("Title", long_text), ("", long_text), ("Title", "short"), ("Title", junk)], "a string, b string")
    assert [r.g for r in df.select(T.content_gate("a", "b").alias("g")).collect()] == [True, False, False, False]


def test_promo_filters(spark):
    paras = ["WATCH: the clip", "short", "ALL CAPS PROMO LINE HERE", "A normal paragraph that is long enough.",
             "   ", "Sign up for our newsletter today please", "Another normal paragraph of decent length."]
    df = spark.createDataFrame([(paras,)], "p array<string>")
    r = df.select(T.fox_promo_keep(F.col("p")).alias("f"), T.nbc_promo_keep(F.col("p")).alias("n")).first()
    assert r.f == ["A normal paragraph that is long enough.", "Sign up for our newsletter today please",
                   "Another normal paragraph of decent length."]
    assert r.n == ["A normal paragraph that is long enough.", "Another normal paragraph of decent length."]


def test_normalize_paragraphs(spark):
    df = spark.createDataFrame([([" a ", "", "  ", "b"],), ([" ", ""],), ([],)], "p array<string>")
    assert [r.b for r in df.select(T.normalize_paragraphs(F.col("p")).alias("b")).collect()] == ["a\n\nb", "", ""]


X5F = ["%Y-%m-%dT%H:%M:%S%z", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S%z", "%Y-%m-%d %H:%M:%S",
       "%Y-%m-%d", "%B %d, %Y", "%b %d, %Y", "%d %B %Y", "%d %b %Y"]
X7F = ["%Y-%m-%dT%H:%M:%S%z", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S.%f%z", "%Y-%m-%dT%H:%M:%S.%fZ",
       "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d"]


def _fmt(dt):
    dt = dt.replace(tzinfo=timezone.utc) if dt.tzinfo is None else dt.astimezone(timezone.utc)
    return dt.strftime("%Y-%m-%dT%H:%M:%SZ")


def py_date(s, fmts):
    s = s.strip()
    if not s:
        return None
    for f in fmts:
        try:
            return _fmt(datetime.strptime(s, f))
        except ValueError:
            pass
    try:
        return _fmt(datetime.fromisoformat(s.replace("Z", "+00:00")))
    except ValueError:
        return None


DATES = ["2026-01-29T12:00:00+00:00", "2026-01-29T12:00:00Z", "2026-01-29T12:00:00", "2026-01-29 12:00:00+05:30",
         "2026-01-29", "January 29, 2026", "Jan 29, 2026", "29 January 2026", "29 Jan 2026", "2026-01-29T12:00:00.123Z",
         "2026-01-29T12:00:00.123456+0200", "2026-01-29T12:00", "2026", "2026-01", "12:00", "2026-02-30", "free text",
         "2026-1-9", "20260129", "2026-01-29T23:30:00-0800", "2026-01-29t12:00:00z", "2026-01-29T12:00:60", "2024-02-29"]


def test_dates(spark):
    df = spark.createDataFrame([(s,) for s in DATES], "s string")
    out = df.select("s", D.utc_string(D.iso_date(F.col("s"))).alias("x5"),
                    D.utc_string(D.meta_datetime(F.col("s"))).alias("x7")).collect()
    for r in out:
        assert r.x5 == py_date(r.s, X5F), r.s
        assert r.x7 == py_date(r.s, X7F), r.s
