"""Near-duplicate embeddings: random-hyperplane sign hashing, exact cosine verification, components.

The sign of a vector against BITS random hyperplanes is its slot in a table; there are TABLES
tables. Vectors of the same label that share a slot are compared by cosine in double precision.
Vectors at cosine 0.98 share a slot of one of the tables with probability above 0.9999.

Equal vectors of a label are one node from the start, with a count. A slot with more than
BLOCK vectors is cut into blocks, and every two blocks are compared by a task of their own, as
one matrix product; neither vectors nor pairs are left out, however many share a slot. No
pairs leave a task: a comparison returns, for each vector with a link, the number of vectors it
links with and the smallest node it is connected with there. A pair that shares several tables
is counted in the first one only, which both vectors' slots tell.

Defined results. A vector that is null, empty, zero or holds null or non-finite components, or
whose label is null, links with nothing and is its own component. Vectors of different length
never link. Repeated rows are vectors of their own (they link with each other). A null vec_id
is never the smallest of its component. An empty table gives an empty table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import beside_least, components, stored

LEAST_COSINE = 0.98
TABLES, BITS, SEED = 20, 14, 7
#: Vectors of a slot that are compared at once.
BLOCK = 1024
#: A list of up to so many crowded slots is sent to all tasks; a longer one is joined.
SLOTS_TO_SEND = 100_000


def planes(dim: int, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, dim])).standard_normal((dim, tables * bits))


def slots_of(x: np.ndarray, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    """One slot number for every vector and table."""
    signs = (x @ planes(x.shape[1], tables, bits) >= 0).reshape(len(x), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def comparable(vector: str = "embedding", label: str = "label"):
    """Rows that can link: a label, and a vector of finite components that are not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(F.col(label).isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def nodes(rows: DataFrame) -> DataFrame:
    """(node, label, embedding, copies): the different vectors of each label, numbered."""
    same = rows.where(comparable()).groupBy("label", "embedding").agg(F.count("*").alias("copies"))
    return same.select(F.xxhash64("label", "embedding").alias("node"), "label", "embedding", "copies")


def with_slots(n: DataFrame) -> DataFrame:
    """Nodes with ``slots``, one slot number a table."""
    def run(batches):
        for b in batches:
            vectors = b.column(b.schema.get_field_index("embedding")).to_pylist()
            found: list = [None] * len(vectors)
            for dim in {len(v) for v in vectors}:
                at = [i for i, v in enumerate(vectors) if len(v) == dim]
                for i, s in zip(at, slots_of(np.array([vectors[i] for i in at], dtype=np.float64)).tolist()):
                    found[i] = s
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.list_(pa.int64()))], names=[*b.schema.names, "slots"])

    return n.mapInArrow(run, "node long, label " + n.schema["label"].dataType.simpleString()
                        + ", embedding " + n.schema["embedding"].dataType.simpleString() + ", copies long, slots array<long>")


def compare(keys, ids, vectors, copies, slots, sides):
    """Links among the vectors of one task: one block, or two. ``sides`` is 0 or 1 for two blocks, of
    which only vectors on different sides are compared. Yields (node, links, root)."""
    table = keys
    x = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    linked = x @ x.T >= LEAST_COSINE
    np.fill_diagonal(linked, False)
    if sides.any():
        linked &= sides[:, None] != sides[None, :]
    counted = linked
    a, b = np.nonzero(linked)
    if table and len(a):
        earlier = (slots[a, :table] == slots[b, :table]).any(axis=1)
        counted = linked.copy()
        counted[a[earlier], b[earlier]] = False
    links = counted @ copies
    root = np.arange(len(ids))
    while True:  # the smallest place each vector reaches
        new = np.minimum(root, np.where(linked, root[None, :], len(ids)).min(axis=1))
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    for i in np.flatnonzero(linked.any(axis=1)).tolist():
        yield ids[i], int(links[i]), ids[root[i]]


def verified(n: DataFrame) -> DataFrame:
    """(node, links, root): per comparison, how many vectors a node links with and a node it is
    connected with."""
    kind = n.schema["embedding"].dataType.simpleString()
    rows = n.select("*", F.posexplode("slots").alias("t", "slot"), F.size("embedding").alias("dim"))
    key = ["label", "dim", "t", "slot"]
    count = rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    crowded = stored(count.where(F.col("n") > BLOCK).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).drop("n"))
    if crowded.count() <= SLOTS_TO_SEND:
        crowded = F.broadcast(crowded)
    rows = rows.join(crowded, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("node", "t"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "node", "embedding", "copies", "slots", "t",
        F.xxhash64(*key).alias("slot_key"), F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"))
    group = ["slot_key", "a", "b"]

    def run(batches):
        """Rows come sorted by comparison; one comparison is held at a time."""
        held: list = []
        key = None
        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in
                    ("slot_key", "a", "b", "node", "embedding", "copies", "slots", "t", "side")]
            found: list = []
            for row in zip(*cols):
                if row[:3] != key:
                    if len(held) > 1:
                        found += one(held)
                    held, key = [], row[:3]
                held.append(row[3:])
            yield out(found)
        yield out(one(held) if len(held) > 1 else [])

    def one(held):
        ids, vectors, copies, slots, t, side = zip(*held)
        return compare(t[0], ids, np.array(vectors, dtype=np.float64), np.array(copies, dtype=np.int64), np.array(slots), np.array(side))

    def out(found):
        found = list(found)
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], names=["node", "links", "root"])

    assert kind.startswith("array")
    dealt = rows.repartition(*[F.col(c) for c in group]).sortWithinPartitions(*group, "node")
    return dealt.mapInArrow(run, "node long, links long, root long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows = vectors.select("vec_id", "embedding", "label")
    n = stored(with_slots(nodes(rows)))
    found = stored(verified(n))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    graph = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    able = F.when(comparable(), F.xxhash64("label", "embedding"))
    ids = stored(rows.select("vec_id", able.alias("node")))
    known = (n.select("node", "copies").join(counts.hint("merge"), "node", "left").join(graph.hint("merge"), "node", "left")
             .select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")))
    first = (ids.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("first")))
    known = stored(known.join(first.hint("merge"), "node"))
    known = beside_least(known, "root", "first", "component_id").select("node", "n_links", "component_id")
    out = ids.where("node is not null").join(known.hint("merge"), "node").select("vec_id", "n_links", "component_id")
    alone = ids.where("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id",
                                         F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


#: Brute force in SQL: every two vectors of a label.
ORACLE_SQL = f"""
WITH RECURSIVE e AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
    label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings),
l AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM e a JOIN e b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE a.ok AND b.ok AND list_cosine_similarity(a.v, b.v) >= {LEAST_COSINE}),
reach(r, root) AS (SELECT a, a FROM l UNION SELECT l.b, reach.root FROM reach JOIN l ON l.a = reach.r),
c AS (SELECT r, min(vec_id) AS component_id FROM (SELECT reach.r, e.vec_id FROM reach JOIN e ON e.r = reach.root) GROUP BY r),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
       coalesce(e.vec_id = coalesce(c.component_id, e.vec_id), false) AS kept
FROM e LEFT JOIN n ON n.a = e.r LEFT JOIN c ON c.r = e.r
"""
