"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, derived from its code point. A trigram's vector
binds (multiplies) its letters' vectors, each permuted (rotated) by its place. A document
bundles (sums) the vectors of its trigrams; a language's prototype bundles its documents,
each weighing the same. A document is compared with every prototype by cosine.

Text is lower-cased; whatever is not a letter is a word boundary, which counts as a letter of its
own at the start and end of words. Whole texts are read, in pieces of bounded memory.

Defined results. A text that is null, empty or has no letter is ``und`` with score 0, as is
every text when nothing was learned. Ties go to the language that sorts first. Rows with a null
language, and rows not chosen for learning, teach nothing. Repeated rows are scored and learned
once each. The score is the cosine, at least 0."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import crc_mod, fresh, map_column

#: Components of a vector.
DIM = 1024
#: Characters taken together, trigram vectors held at once, largest number of learned languages
#: (a prototype takes 8 KB; the prototypes go to every task).
PIECE_CHARS, PIECE_GRAMS, MOST_LANGS = 1 << 20, 4096, 4096
#: A trigram's share of a document in this unit, so that sums are whole numbers in any order.
UNIT = 1 << 24
#: A document whose best cosine is lower is not in any learned language (a filtering stage's bound).
MIN_SCORE = 0.1

UND = "und"
RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


class Letters:
    """Numbers and vectors of the letters met so far; number 0 is the word boundary."""

    def __init__(self, dim: int = DIM):
        self.dim = dim
        self.number = np.full(0x110000, -1, dtype=np.int32)
        self.vectors = [self._vector(0x20)]

    def _vector(self, code: int) -> np.ndarray:
        bits = hashlib.shake_256(b"letter %d" % code).digest(self.dim // 8)
        return (np.unpackbits(np.frombuffer(bits, np.uint8)).astype(np.int8) * 2 - 1)

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        found = self.number[codes]
        if (found < 0).any():
            for code in np.unique(codes[found < 0]).tolist():
                if chr(code).isalpha():
                    self.number[code] = len(self.vectors)
                    self.vectors.append(self._vector(code))
                else:
                    self.number[code] = 0
            found = self.number[codes]
        return found

    def bound(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of trigrams, given as rows of three letter numbers."""
        v = np.stack(self.vectors)
        return np.roll(v, 2, axis=1)[grams[:, 0]] * np.roll(v, 1, axis=1)[grams[:, 1]] * v[grams[:, 2]]


def pieces(texts: list[str]):
    """Ranges of texts of about PIECE_CHARS characters in all; a longer text is alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > PIECE_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def trigrams(letters: Letters, texts: list[str]):
    """(document, trigram number) of every trigram, and the trigrams as rows of letter numbers."""
    texts = [t.lower() for t in texts]
    codes = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "replace"), np.uint32)
    n = letters.numbers(codes).astype(np.int64)
    keep = np.ones(len(n), bool)
    keep[1:] = (n[1:] != 0) | (n[:-1] != 0)
    n = n[keep]
    if len(n) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 3), np.int64)
    middle = n[1:-1] != 0
    k = len(letters.vectors)
    grams = ((n[:-2] * k + n[1:-1]) * k + n[2:])[middle]
    # text j ends before the j-th of these places
    doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), np.flatnonzero(keep)[1:-1][middle], side="left")
    if k ** 3 <= 1 << 23:
        seen = np.flatnonzero(np.bincount(grams, minlength=1))
        place = np.zeros(k ** 3, np.int32)
        place[seen] = np.arange(len(seen))
        at = place[grams].astype(np.int64)
    else:
        seen, at = np.unique(grams, return_inverse=True)
    return doc, at, np.stack([seen // (k * k), seen // k % k, seen % k], axis=1)


def bundles(letters: Letters, texts: list[str]) -> np.ndarray:
    """One bundled vector a text; whole numbers."""
    out = np.zeros((len(texts), letters.dim))
    for a, b in pieces(texts):
        doc, at, grams = trigrams(letters, texts[a:b])
        for g in range(0, len(grams), PIECE_GRAMS):
            part = grams[g:g + PIECE_GRAMS]
            here = (at >= g) & (at < g + len(part))
            counts = np.bincount(doc[here] * len(part) + at[here] - g, minlength=(b - a) * len(part))
            out[a:b] += counts.reshape(b - a, len(part)).astype(np.float32) @ letters.bound(part).astype(np.float32)
    return out


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", dim: int = DIM) -> dict[str, np.ndarray]:
    """Prototypes of the languages of the rows where ``learn`` holds. Every task sends one vector
    a language; they are added in Spark. More than MOST_LANGS different labels are refused."""
    rows = (docs.where(F.coalesce(learn, F.lit(False)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
            .select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l")))

    def sums(batches):
        letters, total = Letters(dim), {}
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for x, y in pieces(texts):
                doc, at, grams = trigrams(letters, texts[x:y])
                if not len(grams):
                    continue
                share = np.maximum(UNIT // np.maximum(np.bincount(doc, minlength=y - x), 1), 1)
                names = sorted(set(langs[x:y]))
                row = np.array([names.index(v) for v in langs[x:y]])
                w = np.bincount(row[doc] * len(grams) + at, weights=share[doc], minlength=len(names) * len(grams))
                w = w.reshape(len(names), len(grams))
                for g in range(0, len(grams), PIECE_GRAMS):
                    part = w[:, g:g + PIECE_GRAMS] @ letters.bound(grams[g:g + PIECE_GRAMS]).astype(np.float64)
                    for name, v in zip(names, part.astype(np.int64)):
                        total[name] = total.get(name, 0) + v
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))], names=["lang", "v"])

    added = (rows.mapInArrow(sums, "lang string, v array<long>")
             .select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
             .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")))
    found = added.select("lang", F.col("v.x").alias("v")).orderBy("lang").limit(MOST_LANGS + 1).collect()
    if len(found) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} different language labels")
    return {r["lang"]: np.array(r["v"], dtype=np.float64) for r in found}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], out: str, text: str = "text") -> DataFrame:
    """``docs`` with ``out``: struct(lang_pred, score). No shuffle."""
    names = sorted(prototypes)
    dim = len(prototypes[names[0]]) if names else DIM
    unit = [prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-300) for n in names]

    def make():
        letters = Letters(dim)
        p = np.stack(unit).T if unit else np.zeros((dim, 0))

        def score(column):
            texts = [t or "" for t in column.to_pylist()]
            v = bundles(letters, texts)
            size = np.sqrt((v * v).sum(axis=1))
            langs, scores = [UND] * len(texts), np.zeros(len(texts))
            if names:
                # rounded, so that the order of additions cannot decide between languages
                cos = np.round((v @ p) / np.where(size > 0, size, 1)[:, None], 9)
                best = cos.argmax(axis=1)
                scores = np.where(size > 0, np.clip(cos[np.arange(len(texts)), best], 0, 1), 0.0)
                langs = [names[k] if s > 0 else UND for k, s in zip(best, size)]
            return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

        return score

    return map_column(docs, text, out, RESULT, make)


def not_held_out(doc_id: str = "doc_id", m: int = 5) -> Column:
    """Rows to learn from: crc32(doc_id as text) mod ``m`` is not 0 (a null id: no)."""
    return F.coalesce(crc_mod(doc_id, m) != 0, F.lit(False))


def query(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    prototypes = fit(docs, not_held_out())
    rows = docs.select("doc_id", "text", (~not_held_out()).alias("held_out"))
    return predict(rows, prototypes, "p").select("doc_id", "held_out", "p.lang_pred", "p.score")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are in a learned language: not ``und`` and a cosine of MIN_SCORE or more."""
    out = fresh(docs, "__lang")
    kept = predict(docs, fit(docs, not_held_out()), out).where(
        (F.col(out)["lang_pred"] != UND) & (F.col(out)["score"] >= MIN_SCORE))
    return kept.drop(out)
