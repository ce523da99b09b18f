"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits, cut into SEGMENTS segments; there is a table for each segment, keyed by its
value. Two fingerprints within ``bits`` differing bits are within bits / SEGMENTS (rounded down) in
some segment. So a fingerprint is stored under its own segment values, and asks each table for all values in
the small Hamming ball around its own; what it meets there is a table match, and a link if the
complete distance is within ``bits``. Only links leave the join.

Near copies share segments, so a slot can be large. A slot that stores more than HOT fingerprints is split by
the same idea once more: its other bits are cut into two halves, and with the bits that the ball
has not used up, one half is within half of them (rounded down). Such a slot holds fingerprints that differ in
a quarter of their bits at most, 65,536 of them. Hot slots are counted, and the list of them goes to
all tasks up to HOT_TO_SEND, else by joins.

Equal fingerprints are one node from the start, so exact copies cost nothing.

Defined results. A null or empty text, or one of white space, has fingerprint zero and links
like any other. Fewer words than a shingle: the whole sequence is one shingle. Repeated rows are
in one group. A null doc_id is never the smallest of its group; a group of null ids has a null
component_id. An empty table gives an empty table."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import as_bytes, beside_least, components, dealt, fresh, map_column, only, stored

SHINGLE_WORDS, MOST_BITS, SEED = 3, 2, 42
#: Segments of the index; a ball is enumerated within each.
SEGMENTS = 2
#: Fingerprints that a slot may store before it is split; hot slots that are sent to all tasks.
HOT, HOT_TO_SEND = 256, 100_000
#: Shingles hashed before their bits are counted: bounds the memory a long text takes.
PIECE = 1 << 16
#: Fingerprints whose index entries one task makes.
PRINTS_A_TASK = 20_000


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Bit k is set if it is set in over half of the shingles' hashes. Unsigned.

    bytes.lower and bytes.split work on A-Z and on space and \\x09-\\x0D only."""
    w = text.lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(w))
    starts, ends = starts[:len(w) - k + 1].tolist(), ends[k - 1:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), PIECE):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[i:i + PIECE], ends[i:i + PIECE])], dtype=np.uint64)
        counts += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, out: str, text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with ``out``, the fingerprint as a signed long. No shuffle."""
    def make():
        def f(column):
            prints = np.array([fingerprint(t, words) for t in as_bytes(column)], dtype=np.uint64)
            return pa.array(prints.view(np.int64), pa.int64())
        return f

    return map_column(docs, text, out, T.LongType(), make)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def ball(bits: range, radius: int) -> list[tuple[int, int]]:
    """(mask, number of its bits) of all masks that change at most ``radius`` of the given bits."""
    return [(signed(sum(1 << b for b in m)), r) for r in range(radius + 1) for m in combinations(bits, r)]


def cut(bits: range, parts: int) -> list[range]:
    """``bits`` in so many runs."""
    size = len(bits) // parts
    return [bits[k * size:(k + 1) * size if k < parts - 1 else len(bits)] for k in range(parts)]


def _value(fp, bits: range):
    """The fingerprint with only these bits left."""
    return fp.bitwiseAND(F.lit(signed(sum(1 << b for b in bits))).cast("long"))


def _struct(**columns):
    return F.struct(*[c.alias(k) for k, c in columns.items()])


def entries(prints: DataFrame, bits: int, segments: int = SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """(stored, asked): (seg, value, fp) of each segment's own value, and (seg, value, fp, used) of each member
    of the ball around it, ``used`` bits away."""
    cuts, radius = cut(range(64), segments), bits // segments
    own, ask = [], []
    for k, run in enumerate(cuts):
        own.append(_struct(seg=F.lit(k), value=_value(F.col("fp"), run)))
        ask += [_struct(seg=F.lit(k), value=_value(F.col("fp"), run).bitwiseXOR(F.lit(mask).cast("long")), used=F.lit(n)) for mask, n in ball(run, radius)]
    exploded = lambda x: prints.select("fp", F.explode(F.array(*x)).alias("e")).select("e.*", "fp")
    return exploded(own), exploded(ask)


def split_slots(stored: DataFrame, asked: DataFrame, bits: int, segments: int = SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """Both sides of hot slots, keyed by half of the other bits too (``half``, ``rest``)."""
    def halves(k: int) -> list[range]:
        run = set(cut(range(64), segments)[k])
        return [[b for b in range(64) if b not in run][s] for s in (slice(0, (64 - len(run)) // 2), slice((64 - len(run)) // 2, None))]

    def keyed(rows: DataFrame, left_over) -> DataFrame:
        """``left_over(k)``: masks and the condition for them, for the halves of segment k's slots."""
        out = []
        for k in range(segments):
            for h, run in enumerate(halves(k)):
                for mask, cond in left_over(run):
                    rest = _value(F.col("fp"), run).bitwiseXOR(F.lit(mask).cast("long"))
                    out.append(F.when((F.col("seg") == k) & cond, _struct(half=F.lit(h), rest=rest)))
        rows = rows.withColumn("e", F.explode(F.array(*out))).where(F.col("e").isNotNull())
        return rows.select("seg", "value", "e.half", "e.rest", "fp")

    # what the ball has used is not left for the halves
    ask = lambda run: [(mask, (bits - F.col("used")) >= 2 * n) for mask, n in ball(run, bits // 2)]
    return keyed(stored, lambda run: [(0, F.lit(True))]), keyed(asked, ask)


def links(prints: DataFrame, bits: int = MOST_BITS, segments: int = SEGMENTS, hot: int = HOT) -> DataFrame:
    """(u, v), u > v: all pairs of different fingerprints ``fp`` within ``bits`` differing bits."""
    stored_in, asked = entries(prints, bits, segments)
    crowded = stored(stored_in.groupBy("seg", "value").count().where(F.col("count") > hot).select("seg", "value"))
    n = crowded.count()
    known = F.broadcast(crowded) if n <= HOT_TO_SEND else crowded

    def matches(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
        a, b = a.withColumnRenamed("fp", "u"), b.withColumnRenamed("fp", "v").hint("merge")
        on = [a[c] == b[c] for c in key] + [a["u"] > b["v"], F.bit_count(a["u"].bitwiseXOR(b["v"])) <= bits]
        return a.join(b, on).select("u", "v")

    found = matches(asked.join(known, ["seg", "value"], "left_anti"), stored_in.join(known, ["seg", "value"], "left_anti"), ["seg", "value"])
    if n:
        own, ask = split_slots(*[x.join(known, ["seg", "value"], "left_semi") for x in (stored_in, asked)], bits, segments)
        found = found.unionByName(matches(ask, own, ["seg", "value", "half", "rest"]))
    return found.distinct()


def groups(rows: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """From rows (doc_id, fp): (fp, root, component_id) of every different fingerprint."""
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    spread = dealt(nodes.select("fp"), nodes.count(), PRINTS_A_TASK)
    found = components(links(spread, bits)).withColumnRenamed("node", "fp")
    rooted = stored(nodes.join(found.hint("merge"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    return beside_least(rooted, "root", "first", "component_id").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    words: int = SHINGLE_WORDS, bits: int = MOST_BITS) -> DataFrame:
    """(doc_id, same, fp, root, component_id) of every row; root names the group, same is a hash of
    the text."""
    rows = with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "fp", words=words)
    rows = stored(rows.select("doc_id", F.xxhash64("text").alias("same"), "fp"))
    return rows.join(groups(rows, bits).hint("merge"), "fp")


def query(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id. Where several rows have it, or
    the whole group has null ids, the one whose text has the smallest hash. Texts move once, in
    the join with the rows to keep."""
    found = near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = found.groupBy("root").agg(F.min("same").alias("same"), F.min("doc_id").alias("id"))
    same = fresh(docs, "__same")
    rows = docs.withColumn(same, F.xxhash64("text"))
    kept = rows.join(keep.hint("merge"), rows["doc_id"].eqNullSafe(keep["id"]) & (rows[same] == keep["same"]), "left_semi")
    return only(kept.dropDuplicates(["doc_id", same]), docs.columns)
