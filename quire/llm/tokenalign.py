"""Cross-tokenizer alignment by products of token-byte incidence matrices.

A text is encoded by two tokenizers, A (byte-level BPE) and B (SentencePiece with a space in front).
A matrix has a row for each token and a column for each byte, 1 where the token covers the byte, in
compressed rows (CSR). The product A B^T, computed row by row as Gustavson does (the rows of B^T at a row's
columns are gathered, equal columns added up), has an entry for each pair of tokens whose byte
ranges overlap: the overlap links, with the number of common bytes. Byte offsets at which tokens of both
end cut them into groups; the product of the two token-group matrices links the tokens that share a
group. All texts of a slice are one block-diagonal matrix.

Corpus-wide counts. The links of a stretch of documents (a chunk, about CHUNK_LINKS links) are
stored; each of its different id pairs is one row of a table, so a pair has at most one row a chunk,
however frequent it is. Counts are added up by pair, the highest of each B id is a window
over its pairs (at most as many as A has ids), and the counts go back to the chunks that asked,
where a document's links look them up. Documents do not move but with their chunk. A task holds one
chunk, and a document is never split between chunks.

Tokenizer files are read on the driver and go to the tasks as broadcasts. A's ids are those of the
JSON file; tiktoken merges over the same vocabulary with the same results, faster, but its pattern
matcher overflows on long runs of white space, so texts with one go to the tokenizers library.

Defined results. A text that is null, empty, or whose tokens' joined bytes differ from space + text
(U+2581 in it, for example) has no tokens: zeros and an empty ``groups_sha256``. Special tokens' strings
are plain text. A null doc_id is a document like any other; repeated rows count as often
as they stand there. Ties for the highest count are all best. Extra columns pass through ``aligned``; an
empty table gives an empty table."""

from __future__ import annotations

import hashlib
import json
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.llm.common import as_bytes
from quire.session import scratch_path

#: Bytes of texts that are encoded and multiplied at a time (a longer text by itself).
SLICE_BYTES = 1 << 20
#: Links of a chunk, about; products of a block of rows, about.
CHUNK_LINKS, BLOCK_PRODUCTS = 1 << 20, 1 << 22


#: White space of so many characters is too long for tiktoken.
LONG_RUN = re.compile(r"\s{500}")


class CSR:
    """A sparse matrix in compressed rows: row i has ``data`` at the columns ``indices``, from
    ``indptr[i]`` to ``indptr[i + 1]``."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, data: np.ndarray, n_columns: int):
        self.indptr, self.indices, self.data, self.n_columns = indptr, indices, data, n_columns

    @classmethod
    def of_ranges(cls, sizes: np.ndarray) -> CSR:
        """Row i has ones at the next ``sizes[i]`` columns."""
        indptr = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        n = int(indptr[-1])
        return cls(indptr, np.arange(n), np.ones(n, np.int64), n)

    @classmethod
    def of_labels(cls, labels: np.ndarray, n_columns: int) -> CSR:
        """Row i has a one at the column ``labels[i]``."""
        return cls(np.arange(len(labels) + 1), labels, np.ones(len(labels), np.int64), n_columns)

    @property
    def n_rows(self) -> int:
        return len(self.indptr) - 1

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(self.n_rows), np.diff(self.indptr))

    def transposed(self) -> CSR:
        order = np.argsort(self.indices, kind="stable")
        indptr = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.n_columns)))).astype(np.int64)
        return CSR(indptr, self.rows()[order], self.data[order], self.n_rows)

    def row_blocks(self, other: CSR):
        """Bounds of blocks of rows whose product with ``other`` takes about BLOCK_PRODUCTS products, or one row."""
        widths = np.concatenate(([0], np.cumsum(np.diff(other.indptr)[self.indices])))[self.indptr]
        at = 0
        while at < self.n_rows:
            end = max(at + 1, int(np.searchsorted(widths, widths[at] + BLOCK_PRODUCTS, "right")) - 1)
            yield at, end
            at = end

    def products(self, other: CSR):
        """The rows of ``self`` times ``other``, block by block: (row, column, value) of the entries, in
        order. The rows of ``other`` at a row's columns are gathered and scaled; equal columns are added up."""
        for low, high in self.row_blocks(other):
            a, b = self.indptr[low], self.indptr[high]
            columns, scale = self.indices[a:b], self.data[a:b]
            start, size = other.indptr[columns], other.indptr[columns + 1] - other.indptr[columns]
            rows = np.repeat(np.repeat(np.arange(low, high), np.diff(self.indptr[low:high + 1])), size)
            ends = np.cumsum(size)
            at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)
            found, values = other.indices[at], other.data[at] * np.repeat(scale, size)
            if not len(at):
                continue
            key = rows * other.n_columns + found
            if (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")
                key, values = key[order], values[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            yield key[first] // other.n_columns, key[first] % other.n_columns, np.add.reduceat(values, first)

    def product(self, other: CSR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All entries of the product: rows, columns, values."""
        blocks = list(self.products(other))
        return tuple(np.concatenate(x) for x in zip(*blocks)) if blocks else (np.zeros(0, np.int64),) * 3


class Alignment:
    """Texts encoded by A and B, aligned. ``a`` and ``b`` are the ids of all texts, one after another;
    ``n_a`` and ``n_b`` the numbers of tokens of each text."""

    def __init__(self, a: np.ndarray, a_sizes: np.ndarray, n_a: np.ndarray, b: np.ndarray, b_sizes: np.ndarray, n_b: np.ndarray):
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        self.a_bytes, self.b_bytes = CSR.of_ranges(a_sizes), CSR.of_ranges(b_sizes)
        a_ends, b_ends = self.a_bytes.indptr[1:], self.b_bytes.indptr[1:]
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        self.a_groups = CSR.of_labels(np.searchsorted(cuts, a_ends), len(cuts))
        self.b_groups = CSR.of_labels(np.searchsorted(cuts, b_ends), len(cuts))
        #: Of every text: the places of its tokens and the groups it begins and ends with.
        self.a_from, self.b_from = (np.concatenate(([0], np.cumsum(n))) for n in (n_a, n_b))
        self.g_from = np.concatenate(([0], np.searchsorted(cuts, self.a_bytes.indptr[self.a_from[1:]], "right")))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Overlap links: places of the A tokens, of the B tokens, common bytes."""
        return self.a_bytes.product(self.b_bytes.transposed())

    def shared(self):
        """Shared-group links, in blocks of (places of the A tokens, of the B tokens, ones)."""
        return self.a_groups.products(self.b_groups.transposed())

    def group_texts(self, a_names: tuple, b_names: tuple) -> list[str]:
        """Of every text its groups, as a1,a2|b1;a3|b2. Names: of an id followed by a comma, by what
        follows a group's last token (a bar for A, a semicolon for B), by nothing."""
        by_a, by_b = self.a_groups.transposed(), self.b_groups.transposed()
        # a group's A tokens come after the B tokens of earlier groups, its B tokens after its A tokens
        at_a = np.arange(len(self.a)) + by_b.indptr[self.a_groups.indices]
        at_b = np.arange(len(self.b)) + by_a.indptr[self.b_groups.indices + 1]
        out = np.empty(len(self.a) + len(self.b), object)
        out[at_a], out[at_b] = a_names[0][self.a], b_names[0][self.b]
        last_a, last_b = by_a.indptr[1:] - 1, by_b.indptr[1:] - 1
        out[at_a[last_a]], out[at_b[last_b]] = a_names[1][self.a[last_a]], b_names[1][self.b[last_b]]
        final = self.b_from[1:][self.n_b > 0] - 1
        out[at_b[final]] = b_names[2][self.b[final]]
        ends = self.a_from + self.b_from
        return ["".join(out[s:e].tolist()) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]


def byte_level() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones stand for
    themselves, the others are numbered from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """A from a tokenizers JSON file (byte-level BPE), B from a SentencePiece model."""

    def __init__(self, a_file: bytes, pattern: str, b_file: bytes):
        import sentencepiece
        import tiktoken
        import tokenizers

        spec, table = json.loads(a_file), byte_level()
        special = {x["content"] for x in spec["added_tokens"]}
        ranks = {bytes(table[c] for c in k): i for k, i in spec["model"]["vocab"].items() if k not in special}
        self._a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._a_slow = tokenizers.Tokenizer.from_buffer(a_file)
        self._a_slow.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for x, i in ranks.items():
            self.a_bytes[i] = x
        b = self._b
        self.b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.names = [tuple(np.array([f"{i}{mark}" for i in range(len(t))], object) for mark in (",", last, ""))
                      for t, last in ((self.a_bytes, "|"), (self.b_bytes, ";"))]

    def a_ids(self, text: str) -> list[int]:
        if LONG_RUN.search(text):
            return self._a_slow.encode(text, add_special_tokens=False).ids
        return self._a.encode_ordinary(text)

    def align(self, texts: list[bytes]) -> Alignment:
        """The alignment of texts in UTF-8; a text whose tokens do not join to space + text has none."""
        strings = [t.decode("utf-8", "replace") for t in texts]
        bs = self._b.encode(strings, num_threads=1)
        a, b = [], []
        for text, string, y in zip(texts, strings, bs):
            x, want = (self.a_ids(" " + string) if text else []), b" " + text
            if not text or b"".join([self.a_bytes[i] for i in x]) != want or b"".join([self.b_bytes[i] for i in y]) != want:
                x, y = [], []
            a.append(x)
            b.append(y)
        flat = lambda lists: np.array([i for x in lists for i in x], np.int64)
        n_a, n_b = (np.array([len(x) for x in lists], np.int64) for lists in (a, b))
        a, b = flat(a), flat(b)
        return Alignment(a, self.a_sizes[a], n_a, b, self.b_sizes[b], n_b)


_READY: dict[tuple, Tokenizers] = {}


def shared_files(spark, a_file: str | None, b_file: str | None):
    """What makes the Tokenizers in a task; the files are read once on the driver."""
    import public_tokenizers as public

    with open(a_file or public.path("byte_bpe_50k.json"), "rb") as f, open(b_file or public.path("piece_bpe_32k.model"), "rb") as g:
        both = spark.sparkContext.broadcast((f.read(), public.PATTERN, g.read()))

    def ready() -> Tokenizers:
        key = tuple(map(hash, both.value))
        if key not in _READY:
            _READY.clear()
            _READY[key] = Tokenizers(*both.value)
        return _READY[key]

    return ready


def slices(texts: list[bytes]):
    """Bounds of runs of texts of about SLICE_BYTES."""
    at = size = 0
    for k, t in enumerate(texts):
        if k > at and size + len(t) > SLICE_BYTES:
            yield at, k
            at, size = k, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


ADDED = [T.StructField(n, t()) for n, t in (
    ("n_a", T.LongType), ("n_b", T.LongType), ("n_groups", T.LongType), ("n_links", T.LongType),
    ("groups_sha256", T.StringType), ("links", T.BinaryType), ("chunk", T.LongType))]


def aligned(docs: DataFrame, text: str = "text", a_file: str | None = None, b_file: str | None = None) -> DataFrame:
    """``docs`` without ``text``, with the columns of ADDED: ``links`` holds (A id, B id) of every overlap
    link as pairs of little-endian unsigned 32-bit integers, ``chunk`` numbers stretches of documents."""
    ready = shared_files(docs.sparkSession, a_file, b_file)
    at = docs.columns.index(text)
    kept = [k for k in range(len(docs.columns)) if k != at]
    schema = T.StructType([docs.schema.fields[k] for k in kept] + ADDED)
    names = [f.name for f in schema.fields]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.int64()]

    def run(batches):
        tokenizers = ready()
        chunk, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts = as_bytes(batch.column(at))
            for low, high in slices(texts):
                x = tokenizers.align(texts[low:high])
                i, j, _ = x.links()
                pairs = np.empty((len(i), 2), "<u4")
                pairs[:, 0], pairs[:, 1] = x.a[i], x.b[j]
                ends = np.searchsorted(i, x.a_from).tolist()
                rows = list(zip(x.n_a.tolist(), x.n_b.tolist(), np.diff(x.g_from).tolist(), x.group_texts(*tokenizers.names), ends, ends[1:]))
                marks = []
                for *_, a, b in rows:
                    if size and size + b - a > CHUNK_LINKS:
                        chunk, size = chunk + 1, 0
                    size += b - a
                    marks.append(chunk)
                columns = zip(*[(n_a, n_b, n_g, b - a, hashlib.sha256(g.encode()).hexdigest() if n_a else "", pairs[a:b].tobytes())
                                for n_a, n_b, n_g, g, a, b in rows])
                cut = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([cut.column(k) for k in kept] + [pa.array(c, k) for c, k in zip([*columns, marks], kinds)], names=names)

    return docs.mapInArrow(run, schema)


def pair_codes(links: list[bytes]) -> np.ndarray:
    """Of every link (A id, B id) one number: B id * 2^32 + A id."""
    return np.frombuffer(b"".join(links), "<u8").astype(np.int64)


def pair_rows(rows: DataFrame) -> DataFrame:
    """(pair, chunk, n): how often each id pair is linked in a chunk (or in the part of it that one Arrow batch holds)."""
    def run(batches):
        for batch in batches:
            links, chunks = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for low, high in slices(links):
                codes = np.concatenate([pair_codes([x]) for x in links[low:high]])
                marks = np.repeat(chunks[low:high], [len(x) // 8 for x in links[low:high]])
                for c in np.unique(marks):
                    pair, n = np.unique(codes[marks == c], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(np.full(len(pair), c), pa.int64()), pa.array(n, pa.int64())],
                                                     names=["pair", "chunk", "n"])

    return rows.select("links", "chunk").mapInArrow(run, "pair long, chunk long, n long").groupBy("pair", "chunk").agg(F.sum("n").alias("n"))


def pair_counts(asked: DataFrame) -> DataFrame:
    """(pair, count, best): how many links of the corpus hold the pair, and whether that is its B id's highest."""
    counts = asked.groupBy("pair").agg(F.sum("n").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.withColumn("best", F.col("count") == most)


def counted(rows: DataFrame) -> DataFrame:
    """Stored rows of ``aligned``, with n_best and count_sum, without links and chunk."""
    asked = pair_rows(rows)
    answers = asked.join(pair_counts(asked).hint("merge"), "pair").select("chunk", "pair", "count", "best")
    names = [c for c in rows.columns if c not in ("links", "chunk")]
    schema = T.StructType([*[rows.schema[c] for c in names], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def look_up(docs: pa.Table, found: pa.Table) -> pa.Table:
        pairs, count, best = (found.column(c).to_numpy() for c in ("pair", "count", "best"))
        order = np.argsort(pairs)
        pairs, count, best = pairs[order], count[order], best[order].astype(np.int64)
        sums = []
        for x in docs.column("links").to_pylist():
            at = np.searchsorted(pairs, pair_codes([x]))
            sums.append((int(best[at].sum()), int(count[at].sum())))
        out = docs.select(names)
        for k, c in enumerate(("n_best", "count_sum")):
            out = out.append_column(c, pa.array([s[k] for s in sums], pa.int64()))
        return out

    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(look_up, schema)


def alignments(docs: DataFrame, text: str = "text", a_file: str | None = None, b_file: str | None = None) -> DataFrame:
    """``docs`` without ``text``, with n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum. The links are
    written once, to the shared folder."""
    spark = docs.sparkSession
    rows = aligned(docs, text, a_file, b_file)
    path = scratch_path(spark, f"links-{uuid.uuid4().hex}")
    rows.write.option("compression", "zstd").parquet(path)
    return counted(spark.read.schema(rows.schema).parquet(path))


def query(docs: DataFrame) -> DataFrame:
    return alignments(docs.select("doc_id", "text")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
