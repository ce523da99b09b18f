"""Toxicity by a counterfactual-regularised classifier.

A logistic classifier over a text's words and word beginnings, learned from labelled texts. Texts
that name a group of people get a counterfactual: every identity term is swapped for another
one of its kind. The fit penalises the squared change of the classifier's logit between a text
and its counterfactual, so naming a group does not raise the score by itself, even where the
toxic texts of the training data name some group more often.

What is learned from is bounded: TRAIN_ROWS labelled rows, those with the smallest hash of doc_id.
Features are chosen by a test on their counts in these rows (a word that is rarely toxic is none)
and number MOST_FEATURES at most. All texts are scored whole, each distinct word once.

Defined results. A null or empty text, or one without letters, has the score of a text without
features. Without labelled rows, or without toxic ones, every score is the smoothed share of
toxic labels. A row with a null id or label teaches nothing; of repeated or contradicting labels
of an id, toxic holds. Repeated documents are scored one by one; extra columns are not read."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import crc_mod, map_column, stored

#: Bounds of the fit: labelled rows, features.
TRAIN_ROWS, MOST_FEATURES = 20_000, 4096
#: Label tables of up to so many rows are sent to all tasks, larger ones are joined.
LABELS_TO_SEND = 2_000_000
#: Lengths of word beginnings that are features.
STARTS = (4, 5, 6, 7)
#: A feature's share among toxic texts exceeds that among the others by so many standard errors.
LEAST_Z = 4.0
#: Features counted in a task before they are passed on.
FLUSH = 400_000
#: Strength of the penalties on weights and on counterfactual changes; steps of the fit.
RIDGE, COUNTERFACTUAL, STEPS = 0.3, 10.0, 400

# Terms that name groups of people, by kind.
IDENTITY_TERMS = {
    "religion": "muslim christian jewish hindu buddhist sikh atheist catholic protestant".split(),
    "religions": "muslims christians jews hindus buddhists sikhs atheists catholics protestants".split(),
    "origin": "black white asian african american european latino arab hispanic mexican chinese indian".split(),
    "gender": "woman man girl boy".split(),
    "genders": "women men girls boys".split(),
    "orientation": "gay lesbian straight bisexual heterosexual homosexual transgender queer".split(),
    "ability": "deaf blind disabled paralyzed".split(),
    "age": "old young elderly teenage".split(),
}
_SWAP = {t: terms for terms in IDENTITY_TERMS.values() for t in terms}
WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features(found: set[str]) -> set[str]:
    """Words and the beginnings of longer words (with a star). Identity terms have no beginnings."""
    return found | {w[:k] + "*" for w in found if w not in _SWAP for k in STARTS if len(w) > k}


def counterfactual(found: set[str], turn: int) -> set[str] | None:
    """The words with every identity term swapped for another of its kind; None if there is none."""
    if not any(w in _SWAP for w in found):
        return None
    out = set()
    for w in found:
        kind = _SWAP.get(w)
        out.add(kind[(kind.index(w) + 1 + turn % (len(kind) - 1)) % len(kind)] if kind else w)
    return out


def labelled(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS, m: int = 5) -> DataFrame:
    """(doc_id, text, toxic) of the rows to learn from."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc_mod("doc_id", m) != 0))
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    # only labels of documents count towards the bound
    ids = docs.select("doc_id").distinct()
    chosen = stored(known.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    if chosen.count() <= LABELS_TO_SEND:
        chosen = F.broadcast(chosen)
    # of rows with the same id one text counts: there are no more rows than ids
    order = F.struct(F.col("text").isNull(), F.xxhash64("text"), F.col("text"))
    return (docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id")
            .agg(F.min_by("text", order).alias("text"), F.first("toxic").alias("toxic")))


def counts(rows: DataFrame) -> DataFrame:
    """(feature, pos, neg): in how many toxic and other texts a feature occurs. Counted in the task
    first; identity terms are counted for counterfactuals too, by fit."""
    def run(batches):
        seen: dict[str, list[int]] = {}

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64())],
                names=["feature", "pos", "neg"])

        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for f in features(words(t or "")):
                    seen.setdefault(f, [0, 0])[1 if y else 0] += 1
            if len(seen) > FLUSH:
                yield out()
                seen.clear()
        yield out()

    return (rows.select("text", "toxic").mapInArrow(run, "feature string, pos long, neg long")
            .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def chosen_features(rows: DataFrame, n_pos: int, n_neg: int, most: int = MOST_FEATURES) -> list[str]:
    """Features that mark toxic texts beyond chance, the surest first, and all identity terms."""
    if not n_pos or not n_neg:
        return []
    pooled = (F.col("pos") + F.col("neg")) / F.lit(n_pos + n_neg)
    error = F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(1e-12)) * F.lit(1 / n_pos + 1 / n_neg))
    z = (F.col("pos") / n_pos - F.col("neg") / n_neg) / error
    # a rare feature may be toxic each time by chance
    least = max(2, math.ceil(math.log2(n_pos)))
    found = counts(rows).where(F.col("pos") >= least).select("feature", z.alias("z")).where(F.col("z") >= LEAST_Z)
    best = [r["feature"] for r in found.orderBy(F.desc("z"), "feature").limit(most).collect()]
    return best + sorted(set(_SWAP) - set(best))


class Model:
    """Weights of features and the logit of a text without any."""

    def __init__(self, weights: dict[str, float], base: float):
        self.weights, self.base = weights, base

    def score(self, text: str) -> float:
        get, total = self.weights.get, self.base
        if self.weights:
            total += math.fsum(get(f, 0.0) for f in features(words(text)))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))


def minimise(x: list[list[int]], y: np.ndarray, pairs: list[tuple[list[int], list[int]]], n: int,
             ridge: float = RIDGE, counterfactual_weight: float = COUNTERFACTUAL, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and base of the logistic loss + ridge * w^2 / 2 + weight * (logit change)^2 / 2, by
    gradient steps with momentum. ``x``: feature numbers of each text; ``pairs``: those of a text
    and of its counterfactual."""
    rows = np.repeat(np.arange(len(x)), [len(r) for r in x])
    cols = np.fromiter((c for r in x for c in r), np.int64, len(rows))
    # a pair's change is a row of +1 and -1
    drows = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs])
    dcols = np.fromiter((c for a, b in pairs for c in (*a, *b)), np.int64, len(drows))
    dsign = np.fromiter((s for a, b in pairs for s in (*[1.0] * len(a), *[-1.0] * len(b))), np.float64, len(drows))
    w, base = np.zeros(n), math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    # steps as long as the curvature of each weight allows
    curve = ridge + np.bincount(cols, minlength=n) * 0.25 * max(1.0, np.mean([len(r) for r in x]) if x else 1.0)
    curve = curve + counterfactual_weight * np.bincount(dcols, minlength=n) * 4
    bcurve = 0.25 * max(len(y), 1)
    vw, vb = w.copy(), base
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(vb + np.bincount(rows, weights=vw[cols], minlength=len(x)), -500, 500)))
        off = p - y
        change = np.bincount(drows, weights=dsign * vw[dcols], minlength=len(pairs))
        grad = np.bincount(cols, weights=off[rows], minlength=n) + ridge * vw
        grad += counterfactual_weight * np.bincount(dcols, weights=dsign * change[drows], minlength=n)
        new, newb = vw - grad / curve, vb - off.sum() / bcurve / 2
        step = k / (k + 3)
        vw, vb, w, base = new + step * (new - w), newb + step * (newb - base), new, newb
    return w, float(base)


def fit(docs: DataFrame, labels: DataFrame, **bounds) -> Model:
    rows = labelled(docs, labels, bounds.get("most", TRAIN_ROWS), bounds.get("m", 5))
    n = {r["toxic"]: r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = n.get(True, 0), n.get(False, 0)
    prior = math.log((n_pos + 1) / (n_neg + 1))
    names = chosen_features(rows, n_pos, n_neg)
    if not names:
        return Model({}, prior if n else 0.0)
    number = {f: i for i, f in enumerate(names)}

    def run(batches):
        for b in batches:
            ids, own, other = b.column(0).to_pylist(), [], []
            for i, t in zip(ids, b.column(1).to_pylist()):
                found = words(t or "")
                swapped = counterfactual(found, i)
                own.append(sorted(number[f] for f in features(found) if f in number))
                other.append(None if swapped is None else sorted(number[f] for f in features(swapped) if f in number))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(own, pa.list_(pa.int32())), pa.array(other, pa.list_(pa.int32()))],
                                             names=["doc_id", "toxic", "own", "other"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.IntegerType()),
                           T.StructField("own", T.ArrayType(T.IntegerType())), T.StructField("other", T.ArrayType(T.IntegerType()))])
    found = rows.select(F.col("doc_id").cast("long"), "text", "toxic").mapInArrow(run, schema).toPandas()
    found = found.sort_values(["doc_id", "toxic"], kind="stable")  # so that sums do not depend on the order of tasks
    x, y = [list(r) for r in found["own"]], (found["toxic"].to_numpy() > 0).astype(float)
    pairs = [(a, list(b)) for a, b in zip(x, found["other"]) if b is not None]
    w, base = minimise(x, y, pairs, len(names))
    return Model({f: float(v) for f, v in zip(names, w) if v}, base)


def scored(docs: DataFrame, model: Model, out: str, text: str = "text") -> DataFrame:
    """``docs`` with ``out``, the score 0 to 1. No shuffle."""
    def make():
        return lambda column: pa.array([model.score(t or "") for t in column.to_pylist()], pa.float64())

    return map_column(docs, text, out, T.DoubleType(), make)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    rows = docs.select("doc_id", "text", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(True)).alias("held_out"))
    return scored(rows, fit(docs, labels), "score").select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
