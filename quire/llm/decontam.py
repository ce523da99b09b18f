"""Benchmark decontamination by Wu-Manber multi-pattern search.

Text is lower-cased (A-Z); words are runs of digits, letters a-z and characters beyond ASCII. Joined
by single spaces, with a space at either end, a run of words is a string, and a window (13
consecutive words of a benchmark item, or the whole item if it has fewer) occurs in a document
exactly where its string does.

Windows are put into classes by length. For each class a shift table over blocks of characters
says how far the search may jump, a table by the hash of a window's suffix block lists the
windows to test, and a direct comparison confirms. Block tables are hashed: two blocks that
share a slot only shorten a jump.

Documents are never shuffled: the windows go to them. The benchmark's size is counted first,
and a benchmark of more than WINDOWS_AT_ONCE windows is searched for in parts, one pass for each.

Defined results. A null or empty text, or one without words, has no words and no hits. An item
without words or with a null text has no window; an item with a null id marks words but is not
listed. Repeated items and windows count once; repeated documents are judged one by one. With an
empty benchmark nothing is contaminated. A long text is searched whole."""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import as_bytes, fresh, map_column, stored, table

WINDOW_WORDS = 13
#: Windows searched for in one pass; they take about 300 bytes each in a task.
WINDOWS_AT_ONCE = 250_000
#: Windows are searched for in classes by least length in characters.
CLASS_LENGTHS = (0, 8, 32)
#: Slots of a class's shift table: a power of two, at most.
MOST_SLOTS = 1 << 22
#: A contaminated document has at least one word in this many in an occurring window.
SHARE = 20

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])

_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Item:
    """A benchmark text as a spaced string and the ends of its windows in it."""

    def __init__(self, item_id: str | None, text: bytes):
        w = words(text)
        self.item_id, self.string, self.windows = item_id, b" " + b" ".join(w) + b" ", []
        if w:
            ends = [0]
            for x in w:
                ends.append(ends[-1] + len(x) + 1)
            k = min(WINDOW_WORDS, len(w))
            self.windows = [(ends[i], ends[i + k] + 1) for i in range(len(w) - k + 1)]


class Searcher:
    """Wu-Manber tables for the windows of one class of lengths."""

    def __init__(self, windows: list[tuple[Item, int, int]]):
        self.m = min(b - a for _, a, b in windows)
        # blocks long enough that a chance block rarely occurs in any window
        size = sum(self.m for _ in windows)
        self.block = min(self.m, max(2, math.ceil(math.log(2 * size, 16)) + 2))
        self.far = self.m - self.block + 1
        slots = 1 << max(10, min(MOST_SLOTS.bit_length() - 1, (4 * len({w[0].string for w in windows}) * 256).bit_length()))
        self.mask = slots - 1
        self.shift = np.full(slots, min(self.far, 0xFFFF), np.uint16)
        self.buckets: dict[bytes, dict[bytes, set]] = {}
        starts: dict[bytes, list[int]] = {}
        for item, a, b in windows:
            starts.setdefault(item.string, []).append(a)
            suffix = item.string[a + self.m - self.block:a + self.m]
            self.buckets.setdefault(suffix, {}).setdefault(item.string[a:b], set()).add(item.item_id)
        for string, at in starts.items():
            at = sorted(set(at))
            for p in range(at[0], at[-1] + self.far):
                # the window for which this block lies nearest to the end of the first m characters
                k = bisect_left(at, p + self.block - self.m)
                if k < len(at) and at[k] <= p:
                    slot = hash(string[p:p + self.block]) & self.mask
                    self.shift[slot] = min(self.shift[slot], at[k] + self.m - p - self.block)
        self.shift = self.shift.tolist()

    def search(self, text: bytes, found) -> None:
        """Call ``found(start, end, item ids)`` for every window at every place where it occurs."""
        block, shift, mask, buckets, m = self.block, self.shift, self.mask, self.buckets, self.m
        at, end = m, len(text)
        while at <= end:
            here = text[at - block:at]
            jump = shift[hash(here) & mask]
            if jump:
                at += jump
                continue
            for window, ids in buckets.get(here, {}).items():
                if text.startswith(window, at - m):
                    found(at - m, at - m + len(window), ids)
            at += 1


class Matcher:
    """All classes of lengths together."""

    def __init__(self, items: list[tuple[str | None, bytes]]):
        windows = [(i, a, b) for i in (Item(*x) for x in items) for a, b in i.windows]
        self.searchers = []
        for low, high in zip(CLASS_LENGTHS, [*CLASS_LENGTHS[1:], math.inf]):
            if part := [w for w in windows if low <= w[2] - w[1] < high]:
                self.searchers.append(Searcher(part))

    def judge(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, ranges of hit words (first, last; merged), ids of occurring items."""
        w = words(text)
        if not w:
            return 0, [], set()
        string = b" " + b" ".join(w) + b" "
        hits, ids = set(), set()

        def found(a, b, whose):
            hits.add((a, b))
            ids.update(whose)

        for s in self.searchers:
            s.search(string, found)
        spans: list[tuple[int, int]] = []
        if hits:
            gaps = np.flatnonzero(np.frombuffer(string, np.uint8) == 32)
            a, b = np.array(sorted(hits)).T
            for first, last in zip(np.searchsorted(gaps, a).tolist(), (np.searchsorted(gaps, b - 1) - 1).tolist()):
                if spans and first <= spans[-1][1] + 1:
                    spans[-1] = (spans[-1][0], max(spans[-1][1], last))
                else:
                    spans.append((first, last))
        return len(w), spans, {i for i in ids if i is not None}


def parts(items: DataFrame, item_id: str = "item_id", text: str = "text", at_once: int = WINDOWS_AT_ONCE):
    """The benchmark as lists of (id, text), each of about ``at_once`` windows at most. Only one
    list at a time is on the driver; windows are counted by spaces, so a list is seldom larger."""
    rows = items.where(F.col(text).isNotNull()).select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("binary").alias("t"))
    chars = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, math.ceil(chars / (2 * at_once)))  # a word and the gap after it take two bytes at least
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("t"), F.lit(n)) == k) if n > 1 else rows
        yield [(r["i"], bytes(r["t"])) for r in part.distinct().collect()]


def search(docs: DataFrame, items: DataFrame, out: str, text: str = "text", at_once: int = WINDOWS_AT_ONCE) -> DataFrame:
    """``docs`` with ``out``: struct(n_words, spans of hit words, items). No shuffle. Where the benchmark has
    several parts, the rows are stored between them, so a task holds one part's matcher at a time."""
    found = []
    for part in parts(items, at_once=at_once):
        if found:
            docs = stored(docs)
        sent = docs.sparkSession.sparkContext.broadcast(part)

        def make(sent=sent):
            matcher = Matcher(sent.value)

            def judge(column):
                rows = [matcher.judge(t) for t in as_bytes(column)]
                return pa.array([{"n_words": n, "spans": [{"first": a, "last": b} for a, b in spans], "items": sorted(ids)}
                                 for n, spans, ids in rows], type=_ARROW_RESULT)
            return judge

        found.append(fresh(docs, f"{out}_{len(found)}"))
        docs = map_column(docs, text, found[-1], RESULT, make)
    whole = F.struct(
        F.col(found[0])["n_words"].alias("n_words"),
        F.flatten(F.array(*[F.col(x)["spans"] for x in found])).alias("spans"),
        F.array_distinct(F.flatten(F.array(*[F.col(x)["items"] for x in found]))).alias("items"))
    return docs.withColumn(out, whole).drop(*found)


_ARROW_RESULT = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), ("items", pa.list_(pa.string()))])


def n_hit(out: str) -> Column:
    """Words in any span; spans of several passes may overlap, so they are merged in order."""
    merged = F.aggregate(
        F.array_sort(F.col(out)["spans"]), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("last")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["last"] - F.greatest(x["first"], s["last"] + 1) + 1)).cast("long").alias("n"),
            F.greatest(s["last"], x["last"]).alias("last")))
    return merged["n"]


def contaminated(out: str) -> Column:
    return (n_hit(out) > 0) & (SHARE * n_hit(out) >= F.col(out)["n_words"])


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = search(docs.select("doc_id", "text"), items, "f").drop("text")
    ids = F.concat_ws(",", F.array_sort("f.items"))
    return found.select("doc_id", "f.n_words", n_hit("f").alias("n_hit"), F.size("f.items").cast("long").alias("n_items"),
                        F.sha2(ids, 256).alias("items_sha256"), contaminated("f").alias("contaminated"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not contaminated by the table ``benchmark``."""
    out = fresh(docs, "__found")
    return search(docs, table(spark, sf_dir, "benchmark"), out).where(~contaminated(out)).drop(out)


#: The same judgement in SQL: windows by their words, joined by equality.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(w, s, s + k - 1), ' ') AS win
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM (SELECT item_id, w, least(13, len(w)) AS k FROM i WHERE len(w) > 0))),
dw AS (
  SELECT r, s, k, array_to_string(list_slice(w, s, s + k - 1), ' ') AS win
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
hit AS (SELECT dw.r, dw.s, dw.k, iw.item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.k = iw.k),
hw AS (SELECT r, count(DISTINCT p) AS n_hit
       FROM (SELECT r, unnest(range(s, s + k)) AS p FROM hit) GROUP BY r),
hi AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""
