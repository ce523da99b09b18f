"""Fill-in-the-middle transformation with a piecewise-linear learned rank index.

A text is a sequence of units (a run of letters A-Z a-z, or any other single character). The index
learns where the boundary of each rank 0 .. n lies: segments, each a line through its first
boundary whose predictions are off by at most ERROR characters, are fitted to all boundary offsets by
narrowing the cone of slopes until it is empty; what a prediction is off by is stored as a
residual of one byte. A cut at a rank is the segment's prediction plus the residual, exact for every
rank. The cuts of a document are pseudorandom ranks, drawn from a hash of its id.

The document is then written in one of three forms: ``plain`` (as it is), ``psm`` (prefix,
suffix, middle) or ``spm`` (suffix, prefix, middle), the parts after a marker each. ``restored``
rebuilds the text from output and form. There is no shuffle; a task holds one Arrow batch,
and beside it 5 bytes a character of one text (longer texts are scanned in pieces) and its offsets.

Defined results. A null or empty text is plain, with n = 0 and an empty output. A text that holds a
marker is plain, so that the parts can be told apart again. A null id is hashed as an empty string. Repeated rows
get the same cuts. Ranks may coincide: parts can be empty. Extra columns pass through; an output
column's name is lengthened where the input has it. An empty table gives an empty table."""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import map_columns

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents, so many are transformed; of 100 transformed ones, so many are spm.
RATE, SPM_RATE, SEED = 90, 20, 1
#: Characters that a segment's line may be off by. With rounding a residual fits in a byte.
ERROR = 100
#: Boundaries that the cone is narrowed over at a time; characters scanned at a time.
WINDOW, PIECE = 4096, 1 << 20


def boundaries(text: str) -> np.ndarray:
    """Offsets of the unit boundaries in characters, 0 and the length included; [0] if empty."""
    found, before = [np.zeros(1, np.int64)], False
    for at in range(0, len(text), PIECE):
        points = np.frombuffer(text[at:at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = ((points | 32) - np.uint32(97)) < 26
        joins = letter.copy()
        joins[1:] &= letter[:-1]
        joins[0] &= before
        found.append(np.flatnonzero(~joins) + at)
        before = bool(letter[-1])
    if not text:
        return found[0]
    # a unit begins at each; the first begins at 0, which is listed already
    return np.concatenate([*found[:1], np.concatenate(found[1:])[1:], [len(text)]])


class RankIndex:
    """``index[rank]`` is the offset of the rank, from segments and residuals alone."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR):
        self.first: list[int] = []
        self.base: list[int] = []
        self.slope: list[float] = []
        self.residuals = np.empty(len(offsets), np.int8)
        start, n = 0, len(offsets)
        while start < n:
            base, end, low, high = int(offsets[start]), n, -np.inf, np.inf
            for at in range(start + 1, n, WINDOW):
                rise = offsets[at:at + WINDOW] - base
                run = np.arange(at - start, at - start + len(rise))
                lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
                highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
                empty = lows > highs
                if empty.any():
                    k = int(empty.argmax())
                    end = at + k
                    if k:
                        low, high = lows[k - 1], highs[k - 1]
                    break
                low, high = lows[-1], highs[-1]
            slope = float((low + high) / 2) if end > start + 1 else 0.0
            line = np.rint(np.arange(end - start) * slope).astype(np.int64) + base
            self.residuals[start:end] = offsets[start:end] - line
            self.first.append(start)
            self.base.append(base)
            self.slope.append(slope)
            start = end

    def __len__(self) -> int:
        return len(self.residuals)

    def predicted(self, rank: int) -> int:
        k = bisect_right(self.first, rank) - 1
        return int(np.rint((rank - self.first[k]) * self.slope[k])) + self.base[k]

    def __getitem__(self, rank: int) -> int:
        return self.predicted(rank) + int(self.residuals[rank])


def transformed(key: str, text: str, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple:
    """(n, form, prefix characters, middle characters, output) of one text."""
    index = RankIndex(boundaries(text))
    n = len(index) - 1
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    one, two, change, order = (int(digest[k:k + 8], 16) for k in range(0, 32, 8))
    if not text or change % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    a, b = sorted((one % (n + 1), two % (n + 1)))
    a, b = index[a], index[b]
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < spm_rate:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


FIELDS = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
          T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]


def out_names(docs: DataFrame) -> dict[str, str]:
    """The names that the columns of FIELDS get beside the columns of ``docs``."""
    names, taken = {}, {c.lower() for c in docs.columns}
    for f in FIELDS:
        name = f.name
        while name in taken:
            name += "_"
        names[f.name] = name
        taken.add(name)
    return names


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
                   rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``docs`` with the columns of FIELDS (see ``out_names``). ``doc_id`` is a whole number or a string."""
    names = out_names(docs)

    def make():
        def f(ids, texts):
            rows = [transformed("" if i is None else str(i), t or "", seed, rate, spm_rate)
                    for i, t in zip(ids.to_pylist(), texts.to_pylist())]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            return [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)]
        return f

    return map_columns(docs, [doc_id, text], [T.StructField(names[f.name], f.dataType) for f in FIELDS], make)


def restored(output: Column, form: Column) -> Column:
    """The text, from its output and form. No part holds a marker, and none can arise where a part
    and a marker meet, so splitting at the markers gives the parts."""
    parts = F.split(output, "<[PSM]>", -1)
    psm, spm = [F.concat(*[parts[k] for k in order]) for order in ((1, 3, 2), (2, 3, 1))]
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def query(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and the SHA-256 of output and of the restored text."""
    rows = fill_in_middle(docs.select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                       digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, CAST('0x' || h[1:8] AS UBIGINT) AS h1, CAST('0x' || h[9:16] AS UBIGINT) AS h2,
        CAST('0x' || h[17:24] AS UBIGINT) AS h3, CAST('0x' || h[25:32] AS UBIGINT) AS h4 FROM d),
c AS (SELECT *, CAST(len(w) AS BIGINT) AS n, CAST(least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS BIGINT) AS a,
        CAST(greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS BIGINT) AS b FROM u),
p AS (SELECT doc_id, t, n, array_to_string(list_slice(w, 1, a), '') AS prefix, array_to_string(list_slice(w, a + 1, b), '') AS middle,
        array_to_string(list_slice(w, b + 1, n), '') AS suffix,
        CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {RATE} THEN 'plain'
             WHEN h4 % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
              ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
