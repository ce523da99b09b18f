"""Language-model scoring with an Elias-Fano n-gram trie.

The model is a backoff one, of three words in the query (of two on demand). Level 1 of the trie holds the
words, level 2 the followers of each word, level 3 the words seen after each pair. Pointers from a level
to the next are a monotone sequence. On level 3 a word is not named by its number among all words but
by its place among the followers of the word before it, which are on level 2: few words follow a
given one, so these names are small. The names of a level are made one monotone sequence by adding up
from range to range, and every sequence is Elias-Fano coded. Backoff weights (levels 1 and 2) and
probabilities, quantised to 16 bits (levels 2 and 3), lie beside them. The levels are written to a file and
mapped into memory; a query goes from the word to its follower, and from the pair to the third
word, each time by a successor search between the pointers of where it stands.

Probability of word w after u v, with counts c from the training documents:
  c(u v w) > 0:  (c(u v w) - D) / c(u v)
  else:          D * T(u v) / c(u v) / (1 - S(u v)) * p(w | v)    (T(u v): different words after u v)
  c(u v) = 0:    p(w | v)
S(u v) is the sum of p(w | v) over the words seen after u v; all of them have been seen after v, so it is
exact, and the probabilities after u v sum to 1 where those after v do, never to more. A text's first word has no
pair before it; the second has the start and the first. After one word:
  c(v w) > 0:  (c(v w) - D) / c(v)
  else:        D * T(v) / c(v) / (1 - S(v)) * p(w), never more than p(w)
  c(v) = 0:    p(w)
  p(w) = (c(w) + 1) / (N + V + 1), the base model.
S(v) is the base probability of the followers seen after v that are frequent words: a share of
FREQUENT of all tokens or more. There are at most 1 / FREQUENT such words, so their table has a
proven bound and goes to all tasks. Rarer followers are left out of S(v), so all probabilities
after v sum to less than 1, never to more.

How it runs. Every task cuts its documents into chunks of a bounded number of tokens. A chunk's
words, each with the two before it and its document, are packed by shard, the shard being a hash of
the word before (v): so a shard has all followers of v, which name the third words, and all pairs u v with
what comes after. A shard's task builds its part of the trie from the training rows and answers all rows.
Words v that hold more than a shard's share of tokens are frequent words, known beforehand, and
are split over several shards by the word before them (u), so that c(u v) is whole in one shard. Their
pairs v w are counted beforehand, and every part gets the whole counts of the pairs that it asks for.
(The start, and all words in a model of two words, are split by w.) Pairs not found
(there are none from training documents) go on to the shard of the follower, where p(w) is.
Sums by document come back, a few numbers each. What is gathered grows with the corpus; nothing is
sampled, capped or pruned. Words are told apart by 64-bit hashes, for which frequent words have a
number in their table where they are packed. All that follows one pair of words is in one shard.

Defined results. A null or empty text has the end as its only token. Rows with a null doc_id are
held out. Repeated rows are documents of their own, in training too. Without training documents
N and V are 0. Very long texts fill chunks of their own."""

from __future__ import annotations

import itertools
import math
import os
import tempfile
from array import array
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import as_bytes, crc_mod, stored

#: Tokens of a chunk, tokens of training and scoring that a shard takes; words of the query's model.
CHUNK_TOKENS, SHARD_TOKENS = 2_000_000, 1_500_000
ORDER = 3
#: Discount; a frequent word's least share of all tokens; levels of a quantised log10 probability.
DISCOUNT, FREQUENT = 0.75, 1e-6
STEP = 1 / 4096
#: A range of so many values is searched as it is.
NARROW = 8
#: Hashes that stand for a text's start and end (words have others: theirs are never 0 or 1).
START, END = 0, 1


class EliasFano:
    """A monotone sequence of whole numbers: low bits as they are, high bits in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        # eight bytes from any byte on
        self.words = np.lib.stride_tricks.as_strided(low.view(np.uint64), (max(len(low) - 7, 0),), (1,)) if len(low) >= 8 else None
        self.mask = np.uint64((1 << low_bits) - 1)
        # one running count of ones for every byte of the unary part
        self.ones = np.concatenate(([0], np.cumsum(_POPCOUNT[self.high], dtype=np.int64)))

    @staticmethod
    def pack(values: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        bits = np.zeros((int(high[-1]) + n + 8) // 8 * 8 + 8 if n else 8, np.uint8)
        bits[high + np.arange(n)] = 1
        if not low_bits:
            return n, 0, np.zeros(0, np.uint8), np.packbits(bits, bitorder="little")
        low = []
        for i in range(0, n, 1 << 16):  # whole bytes each
            part = values[i:i + (1 << 16), None] >> np.arange(low_bits, dtype=np.uint64)
            low.append(np.packbits((part & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"))
        low = np.concatenate([*low, np.zeros(16, np.uint8)])
        low = low[:len(low) // 8 * 8]  # whole words; what is cut off is padding
        return n, low_bits, low, np.packbits(bits, bitorder="little")

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th (from 0) one or zero of the unary part."""
        if len(k) > len(self.high) // 2:  # as many as there are: all places at once
            bits = np.unpackbits(self.high, bitorder="little")
            return np.flatnonzero(bits if one else bits == 0)[k]
        before = self.ones if one else 8 * np.arange(len(self.ones)) - self.ones
        byte = np.searchsorted(before, k, side="right") - 1
        within = (k - before[byte]).astype(np.int64)
        value = self.high[np.minimum(byte, len(self.high) - 1)]
        return byte * 8 + _SELECT[value if one else 255 - value, within]

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Values at the places ``i``."""
        i = np.asarray(i, dtype=np.int64)
        value = (self._select(i, True) - i).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bit = i * self.low_bits
            shift = (bit & 7).astype(np.uint64)
            low = self.words[bit >> 3] >> shift
            if self.low_bits > 57:  # may reach into a ninth byte
                low |= self.low[(bit >> 3) + 8].astype(np.uint64) << np.uint64(1) << (np.uint64(63) - shift)
            value |= low & self.mask
        return value

    def successor(self, x: np.ndarray, start=0, end=None) -> np.ndarray:
        """Place of the first value that is not below x, from ``start`` to before ``end`` (``end`` if none; all
        values if not given)."""
        x = np.asarray(x, dtype=np.uint64)
        first, last = (np.broadcast_to(y, len(x)).astype(np.int64) for y in (start, self.n if end is None else end))
        # a range that is not small is cut to the group of the high part: between the zeros before and behind it
        wide = np.flatnonzero(last - first > NARROW)
        high = (x[wide] >> np.uint64(self.low_bits)).astype(np.int64)
        zeros = 8 * len(self.high) - int(self.ones[-1])
        h = np.minimum(high, zeros - 1)
        before = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - h + 1, 0)
        behind = np.minimum(self._select(h, False) - h, self.n)
        before, behind = (np.where(high >= zeros, self.n, np.minimum(y, self.n)) for y in (before, behind))
        first[wide], last[wide] = np.clip(before, first[wide], last[wide]), np.clip(behind, first[wide], last[wide])
        open_ = np.flatnonzero(first < last)
        while len(open_):
            mid = (first[open_] + last[open_]) >> 1
            below = self[mid] < x[open_]
            first[open_[below]] = mid[below] + 1
            last[open_[~below]] = mid[~below]
            open_ = open_[first[open_] < last[open_]]
        return first

    def find(self, x: np.ndarray, start=0, end=None) -> np.ndarray:
        """Place of x, from ``start`` to before ``end``, -1 where it is not."""
        if not self.n:
            return np.full(len(x), -1, np.int64)
        end = self.n if end is None else end
        at = self.successor(x, start, end)
        ok = (at < end) & (self[np.minimum(at, self.n - 1)] == np.asarray(x, dtype=np.uint64))
        return np.where(ok, at, -1)


_POPCOUNT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1)
_SELECT = np.zeros((256, 9), np.int64)
for _b in range(256):
    _at = [i for i in range(8) if _b >> i & 1]
    _SELECT[_b, :len(_at)] = _at


class Level:
    """Children of the entries above: where each one's start, and their names, added up from range to
    range so that they are one monotone sequence."""

    def __init__(self, starts: EliasFano, names: EliasFano):
        self.starts, self.names = starts, names

    @staticmethod
    def sequences(starts: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``starts`` (with the end), and ``names``, sorted in every range, as they are stored."""
        sizes = np.diff(starts)
        sizes = sizes[sizes > 0]
        last = names[np.cumsum(sizes) - 1]
        return starts, names + np.repeat(np.cumsum(last) - last, sizes)

    def range(self, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.starts[parent].astype(np.int64), self.starts[parent + 1].astype(np.int64)

    def find(self, parent: np.ndarray, name: np.ndarray) -> np.ndarray:
        """Place of the child with this name between its parent's pointers, -1 where it is not, or where parent or
        name is -1."""
        out = np.full(len(parent), -1, np.int64)
        asked = np.flatnonzero((parent >= 0) & (name >= 0)) if self.names.n else out[:0]
        start, end = self.range(parent[asked])
        some = start < end
        asked, start, end = asked[some], start[some], end[some]
        before = np.where(start > 0, self.names[np.maximum(start - 1, 0)] if len(asked) else np.uint64(0), np.uint64(0))
        out[asked] = self.names.find(before + name[asked].astype(np.uint64), start, end)
        return out


class Trie:
    """One shard's part of the model, in a file that is mapped into memory."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, pairs: np.ndarray, pair_scores: np.ndarray, pair_weights: np.ndarray,
                 triples: np.ndarray, triple_scores: np.ndarray):
        """Sorted word hashes and their log10 backoff weights; sorted pairs as first * number of words +
        second, with their log10 probabilities (0: not of this shard) and weights; triples as (place of the first
        and second word, place of the second and third word) among the pairs, and their log10 probabilities."""
        width = max(1, len(words))
        first, second = pairs // width, pairs % width
        starts = np.searchsorted(first, np.arange(len(words) + 1))
        # the third word by its place among the followers of the second
        parent, name = triples[0], triples[1] - starts[first[triples[1]]]
        order = np.lexsort((name, parent))
        level2 = Level.sequences(starts, second)
        level3 = Level.sequences(np.searchsorted(parent[order], np.arange(len(pairs) + 1)), name[order])
        levels = [EliasFano.pack(x) for x in (words, *level2, *level3)]
        quantised = [np.clip(np.rint(-x / STEP), 0, 65535).astype(np.uint16) for x in (pair_scores, triple_scores[order])]
        arrays = [x for level in levels for x in level[2:]]
        arrays += [x.view(np.uint8) for x in (weights.astype(np.float32), pair_weights.astype(np.float32), *quantised)]
        handle, self.path = tempfile.mkstemp(prefix="trie-")
        with os.fdopen(handle, "wb") as f:
            for x in arrays:
                f.write(x.tobytes())
        size = sum(len(x) for x in arrays)
        self.bytes = np.memmap(self.path, np.uint8, "r", shape=(size,)) if size else np.zeros(0, np.uint8)
        at, mapped = 0, []
        for x in arrays:
            mapped.append(self.bytes[at:at + len(x)])
            at += len(x)
        parts = [EliasFano(n, b, mapped[2 * i], mapped[2 * i + 1]) for i, (n, b, _, _) in enumerate(levels)]
        self.words, self.pairs, self.triples = parts[0], Level(*parts[1:3]), Level(*parts[3:])
        self.weights, self.pair_weights = (x.view(np.float32) for x in mapped[-4:-2])
        self.scores = [x.view(np.uint16) for x in mapped[-2:]]

    def find_pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Places of pairs of word numbers on level 2, -1 where they are not."""
        return self.pairs.find(first, second)

    def find_triples(self, pair: np.ndarray, follower: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Places on level 3, from the places of (first, second) and (second, third) on level 2, and the number
        of the second word."""
        some = (pair >= 0) & (follower >= 0)
        start = np.zeros(len(pair), np.int64)
        start[some] = self.pairs.range(second[some])[0]
        return self.triples.find(np.where(some, pair, -1), follower - start)

    def score(self, level: int, at: np.ndarray) -> np.ndarray:
        return -STEP * self.scores[level - 2][at]

    def close(self) -> None:
        self.bytes = self.scores = self.words = self.pairs = self.triples = self.weights = self.pair_weights = None
        os.unlink(self.path)


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one block: each one's bytes, byte planes apart, compressed together."""
    planes = [np.ascontiguousarray(np.ascontiguousarray(a)[:, None].view(np.uint8).T).tobytes() if len(a) else b"" for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted different values."""
    x = np.sort(x)
    return x[np.concatenate((x[:1] == x[:1], x[1:] != x[:-1]))]


def told_apart(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different values, and the place of each value among them."""
    order = np.argsort(x)
    x = x[order]
    new = np.concatenate((x[:1] == x[:1], x[1:] != x[:-1]))
    place = np.empty(len(x), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return x[new], place


def unsqueeze(block: bytes, *shapes: tuple[type, int]) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(block), 0, []
    for kind, n in shapes:
        size = np.dtype(kind).itemsize
        part = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n) if n else np.zeros((size, 0), np.uint8)
        out.append(np.ascontiguousarray(part.T).view(kind).ravel())
        at += n * size
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """Another hash of hashes."""
    h = h.astype(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Chunk:
    """Tokens of some documents: hashes of the different words, sorted unless numbered otherwise, and each token's number."""

    def __init__(self, texts: list[bytes]):
        number: dict[bytes, int] = defaultdict(itertools.count().__next__)
        ids, sizes = array("i"), []
        for t in texts:
            w = t.lower().split()
            ids.extend(map(number.__getitem__, w))
            sizes.append(len(w))
        hashes = np.array([xxhash.xxh64_intdigest(x) for x in number] + [START, END], dtype=np.uint64)
        words = hashes[:-2]
        words[words < 2] += np.uint64(2)
        self.sizes = np.array(sizes, np.int64) + 1  # with the end
        self.ends = np.cumsum(self.sizes)
        follower = np.full(int(self.ends[-1]) if len(self.ends) else 0, len(hashes) - 1, np.int32)
        inner = np.ones(len(follower), bool)
        inner[self.ends - 1] = False
        follower[inner] = ids
        self.hashes, self.follower, self.start = hashes, follower, len(hashes) - 2
        self.number(np.argsort(hashes))

    def number(self, order: np.ndarray) -> None:
        """Numbers the words in another order."""
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        self.hashes, self.follower, self.start = self.hashes[order], rank[self.follower], rank[self.start]

    def previous(self, words: np.ndarray) -> np.ndarray:
        """For each token the value that the one before it has in ``words``, or the start."""
        out = np.empty_like(words)
        out[1:] = words[:-1]
        out[np.concatenate(([0], self.ends[:-1]))[:len(self.ends)]] = self.start
        return out

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)

    def shards(self, n: int, split: tuple[np.ndarray, np.ndarray], context: np.ndarray, before: np.ndarray | None) -> np.ndarray:
        """Shard of every token; ``before`` is not given in a model of two words."""
        by = self.follower if before is None else np.where(context == self.start, self.follower, before)
        # by word first, as there are fewer
        base, more = mixed(self.hashes) % np.uint64(n), mixed(self.hashes)
        place, has = _at(split[0], self.hashes)
        shard = base[context]
        some = np.flatnonzero(has[context])
        parts = split[1][place[context[some]]].astype(np.uint64)
        shard[some] = (shard[some] + more[by[some]] % parts) % np.uint64(n)
        return shard.astype(np.int64)


def chunks(batches, tokens: int = CHUNK_TOKENS):
    """(number, columns of documents) of about ``tokens`` tokens each; one longer text is alone."""
    task = TaskContext.get().partitionId()
    held: list = [[], [], []]
    size = k = 0
    for b in batches:
        for doc_id, train, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), as_bytes(b.column(2))):
            n = len(text) // 5 + 1
            if held[0] and size + n > tokens:
                yield task << 32 | k, held
                held, size, k = [[], [], []], 0, k + 1
            for column, x in zip(held, (doc_id, train, text)):
                column.append(x)
            size += n
    if held[0]:
        yield task << 32 | k, held


PACKED = "shard long, chunk long, kind int, n long, m long, block binary"
COUNTS = "shard long, n long, block binary, words long, tokens long"


def unigram_blocks(rows: DataFrame, n_shards: int) -> DataFrame:
    """(shard, n, block): hashes and training counts of each chunk's words."""
    def run(batches):
        for _, (_, train, texts) in chunks(batches):
            texts = [t for t, y in zip(texts, train) if y]
            if not texts:
                continue
            c = Chunk(texts)
            count = np.bincount(c.follower, minlength=len(c.hashes)).astype(np.uint32)
            h, count = c.hashes[count > 0], count[count > 0]
            shard = (mixed(h) % np.uint64(n_shards)).astype(np.int64)
            for s in np.unique(shard):
                mine = shard == s
                # sorted, so the differences are small numbers
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(s)]), pa.array([int(mine.sum())]), pa.array([squeeze(np.diff(h[mine], prepend=np.uint64(0)), count[mine])], pa.binary())],
                    names=["shard", "n", "block"])

    return rows.mapInArrow(run, "shard long, n long, block binary")


def unigrams(rows: DataFrame, n_shards: int) -> DataFrame:
    """(shard, n, block, words, tokens): every shard's different words with their counts, as one block."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        parts = [unsqueeze(b, (np.uint64, n), (np.uint32, n)) for n, b in zip(group["n"], group["block"])]
        h = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        count = np.concatenate([p[1] for p in parts]).astype(np.int64)
        h, at = np.unique(h, return_inverse=True)
        total = np.zeros(len(h), np.int64)
        np.add.at(total, at, count)
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "n": [len(h)], "block": [squeeze(np.diff(h, prepend=np.uint64(0)), total)],
                             "words": [int((h != START).sum())], "tokens": [int(total.sum())]})

    return unigram_blocks(rows, n_shards).groupBy("shard").applyInPandas(run, COUNTS)


def frequent_words(counts: DataFrame, n_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the words with at least a share FREQUENT of the tokens: at most
    1 / FREQUENT of them."""
    least = max(1, math.ceil(FREQUENT * n_tokens))

    def run(batches):
        for b in batches:
            for n, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h, c = unsqueeze(block, (np.uint64, n), (np.int64, n))
                keep = c >= least
                yield pa.RecordBatch.from_arrays([pa.array([squeeze(np.cumsum(h, dtype=np.uint64)[keep], c[keep])], pa.binary()), pa.array([int(keep.sum())])], names=["block", "n"])

    found = [unsqueeze(r["block"], (np.uint64, r["n"]), (np.int64, r["n"])) for r in
             counts.select("n", "block").mapInArrow(run, "block binary, n long").toLocalIterator()]
    h = np.concatenate([f[0] for f in found] or [np.zeros(0, np.uint64)])
    c = np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])
    order = np.argsort(h)
    return h[order], c[order]


def split_pairs(rows: DataFrame, n_shards: int, split, order: int) -> DataFrame:
    """(shard, n, block): the different pairs of each chunk whose context is split, with the part that
    asks for them and their training count; the shard is a hash of the pair."""
    def run(batches):
        for _, (_, train, texts) in chunks(batches):
            c = Chunk(texts)
            context = c.previous(c.follower)
            place, has = _at(split[0], c.hashes)
            mine = np.flatnonzero(has[context])
            if not len(mine):
                continue
            part = c.shards(n_shards, split, context, c.previous(context) if order > 2 else None)[mine]
            context, follower = place[context[mine]], c.follower[mine]
            shard = (mixed(mixed(split[0][context]) ^ c.hashes[follower]) % np.uint64(n_shards)).astype(np.int64)
            at = np.lexsort((part, context, follower, shard))
            columns = [x[at] for x in (shard, follower, context, part)]
            first = np.flatnonzero(np.logical_or.reduce([np.diff(x, prepend=-1) != 0 for x in columns]))
            count = np.add.reduceat(np.array(train, bool)[c.doc[mine][at]].astype(np.uint32), first)
            shard, follower, context, part = (x[first] for x in columns)
            cuts = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
            for x, y in zip(cuts, [*cuts[1:], len(shard)]):
                block = squeeze(np.diff(c.hashes[follower[x:y]], prepend=np.uint64(0)), context[x:y].astype(np.uint32),
                                part[x:y].astype(np.uint32), count[x:y].astype(np.uint32))
                yield pa.RecordBatch.from_arrays([pa.array([int(shard[x])]), pa.array([y - x]), pa.array([block], pa.binary())], names=["shard", "n", "block"])

    return rows.mapInArrow(run, "shard long, n long, block binary")


def whole_pairs(rows: DataFrame, n_shards: int, sent, order: int) -> DataFrame:
    """Whole training counts of the pairs whose context is split. Rows by kind: 2 for a part, the counts of the
    pairs that it asks for; 4 followers and coverage of a context (``chunk``: its number among those split)."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        model = sent.value
        parts = [unsqueeze(b, (np.uint64, n), (np.uint32, n), (np.uint32, n), (np.uint32, n)) for n, b in zip(group["n"], group["block"])]
        follower = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        context, part, count = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (1, 2, 3))
        del parts
        h, number = np.unique(follower, return_inverse=True)
        _, first, pair = np.unique(context * len(h) + number, return_index=True, return_inverse=True)
        total = np.zeros(len(first), np.int64)
        np.add.at(total, pair, count)
        at, common = _at(model["frequent"], follower[first])
        share = np.where(common & (total > 0), (model["counts"][at] + 1) / model["base_total"], 0.0) if len(model["frequent"]) else np.zeros(len(first))
        of, n = context[first], len(model["split"][0])
        followers, covered = np.bincount(of[total > 0], minlength=n), np.bincount(of, weights=share, minlength=n)
        some = np.flatnonzero(followers)
        out = [pd.DataFrame({"shard": 0, "chunk": some, "kind": 4, "n": followers[some], "m": 0, "block": None, "covered": covered[some]})]
        asked = np.lexsort((context, number, part))
        asked = asked[np.logical_or.reduce([np.diff(x[asked], prepend=-1) != 0 for x in (part, number, context)])]
        cuts = np.flatnonzero(np.diff(part[asked], prepend=-1)).tolist()
        rows = []
        for x, y in zip(cuts, [*cuts[1:], len(asked)]):
            o = asked[x:y]
            rows.append((int(part[o[0]]), len(o), squeeze(np.diff(follower[o], prepend=np.uint64(0)), context[o].astype(np.uint32), total[pair[o]])))
        shard, size, block = zip(*rows)
        out.append(pd.DataFrame({"shard": shard, "chunk": 0, "kind": 2, "n": size, "m": 0, "block": block, "covered": 0.0}))
        return pd.concat(out)

    split = sent.value["split"]
    return split_pairs(rows, n_shards, split, order).groupBy("shard").applyInPandas(run, f"{PACKED}, covered double")


def pair_blocks(rows: DataFrame, n_shards: int, sent, order: int, chunk_tokens: int) -> DataFrame:
    """One block for each chunk and shard: kind 0 has the documents of the chunk (in the shard of the
    chunk's number), kind 1 its words with the one or two words before them, sorted by these words; ``m`` holds the
    numbers of different frequent and other words."""
    def run(batches):
        model = sent.value
        for number, (ids, train, texts) in chunks(batches, chunk_tokens):
            c = Chunk(texts)
            train = np.array(train, bool)
            known = np.array([i is not None for i in ids], bool)
            plain = np.array([i or 0 for i in ids], np.int64)
            out = [(number % n_shards, 0, len(ids), 0, squeeze(plain, known.astype(np.uint8), train.astype(np.uint8), c.sizes))]
            # frequent words have a number that is known everywhere, the others are named by their hashes
            place, common = _at(model["frequent"], c.hashes)
            c.number(np.argsort(~common, kind="stable"))
            place, n_common = place[common], int(common.sum())
            context = c.previous(c.follower)
            words = [context, c.follower, c.previous(context)][:order]
            shard = c.shards(n_shards, model["split"], context, words[2] if order > 2 else None)
            # sorted by shard and words; documents stay in their order
            bits = len(c.hashes).bit_length()
            if n_shards.bit_length() + order * bits < 64:
                key = shard
                for w in words:
                    key = key << bits | w
                at = np.argsort(key, kind="stable")
            else:
                at = np.lexsort((*words[::-1], shard))
            words = [w[at] for w in words]
            doc = (c.doc.astype(np.uint32) << np.uint32(1) | train[c.doc])[at]
            cuts = np.flatnonzero(np.diff(shard[at], prepend=-1)).tolist()
            ranks = np.empty(len(c.hashes), np.uint32)
            for x, y in zip(cuts, [*cuts[1:], len(at)]):
                used = distinct(np.concatenate([w[x:y] for w in words]))
                ranks[used] = np.arange(len(used))
                rank = np.stack([ranks[w[x:y]] for w in words])
                f = int(np.searchsorted(used, n_common))
                # context and follower hardly change from row to row; their differences wrap around
                block = squeeze(np.diff(place[used[:f]], prepend=0).astype(np.uint32), np.diff(c.hashes[used[f:]], prepend=np.uint64(0)),
                                *np.diff(rank[:2], prepend=np.uint32(0), axis=1), *rank[2:], doc[x:y])
                out.append((int(shard[at[x]]), 1, y - x, f << 32 | len(used) - f, block))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([number] * len(out), pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                 pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.int64()), pa.array([o[4] for o in out], pa.binary())],
                names=["shard", "chunk", "kind", "n", "m", "block"])

    return rows.mapInArrow(run, PACKED)


RESULTS = "kind int, chunk long, shard long, n long, block binary"


def _frame(kind: int, size: int, **columns) -> pd.DataFrame:
    empty = {"chunk": 0, "shard": 0, "n": 0, "block": None}
    return pd.DataFrame({"kind": kind, **empty, **columns}, index=range(size))


def _at(sorted_: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where x stands in a sorted array, and whether it does."""
    if not len(sorted_):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return at, sorted_[at] == x


def built(words: np.ndarray, seen: np.ndarray, weights: np.ndarray, pairs: np.ndarray, count: np.ndarray, triples: np.ndarray,
          triple_count: np.ndarray) -> Trie:
    """The trie of a shard. Words are numbered by their places in ``words``: (sorted hashes), ``seen`` and
    ``weights`` are their counts and log10 weights as contexts; ``pairs`` are the sorted pairs as first * number of
    words + second; ``triples`` are the sorted triples as place of (second, third) among the pairs * number
    of words + first. A count of 0 is no entry."""
    width = np.int64(max(1, len(words)))
    learned = count > 0
    p = np.zeros(len(pairs))
    p[learned] = (count[learned] - DISCOUNT) / seen[pairs[learned] // width]
    triples, triple_count = triples[triple_count > 0], triple_count[triple_count > 0]
    follower = (triples // width).astype(np.int32)
    # the first and the second word
    inner, own = told_apart(triples % width * width + pairs[follower] // width)
    total = np.bincount(own, weights=triple_count, minlength=len(inner))
    different = np.bincount(own, minlength=len(inner))
    covered = np.bincount(own, weights=p[follower], minlength=len(inner))
    entries = distinct(np.concatenate((pairs[learned], inner)))
    scores, pair_weights = np.zeros(len(entries)), np.zeros(len(entries))
    scores[np.searchsorted(entries, pairs[learned])] = np.log10(p[learned])
    inner = np.searchsorted(entries, inner)
    pair_weights[inner] = np.log10(DISCOUNT * different / total / np.maximum(1 - covered, 1e-12))
    places = inner[own], np.searchsorted(entries, pairs[follower])
    scored = np.log10((triple_count - DISCOUNT) / total[own])
    # words without entry and weight need no number
    first, second = entries // width, entries % width
    used = np.zeros(len(words), bool)
    used[first] = used[second] = used[weights != 0] = True
    place = np.cumsum(used) - 1
    entries = place[first] * max(1, int(used.sum())) + place[second]
    return Trie(words[used], weights[used], entries, scores, pair_weights, places, scored)


def answered(packed: DataFrame, n_shards: int, sent, order: int) -> DataFrame:
    """Builds every shard's trie and answers its rows. Rows by kind: 0 documents of a chunk; 1 sums by
    document of a chunk (known words, base, score); 3 pairs not found, by the follower's shard."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        model = sent.value
        frequent, counts, split, base_total = (model[k] for k in ("frequent", "counts", "split", "base_total"))
        documents = group[group["kind"] == 0]
        out = [_frame(0, len(documents), **{c: documents[c].to_numpy() for c in ("chunk", "n", "block")})]
        blocks = group[group["kind"] == 1].sort_values("chunk", kind="stable")
        if not len(blocks):
            return out[0]
        parts = []
        for n, m, block in zip(blocks["n"], blocks["m"], blocks["block"]):
            f, h, *words, doc = unsqueeze(block, (np.uint32, m >> 32), (np.uint64, m & 0xFFFFFFFF), *[(np.uint32, n)] * (order + 1))
            words[:2] = (np.cumsum(w, dtype=np.uint32) for w in words[:2])
            parts.append((np.concatenate((frequent[np.cumsum(f, dtype=np.int64)], np.cumsum(h, dtype=np.uint64))), words, doc))
        # the pairs and triples of all blocks, told apart
        hashes = distinct(np.concatenate([p[0] for p in parts]))
        width = np.int64(len(hashes))
        keys, before = [], []
        for h, words, _ in parts:
            own = np.searchsorted(hashes, h)
            keys.append(own[words[0]] * width + own[words[1]])
            before.extend(own[w].astype(np.int32) for w in words[2:])
        train = np.concatenate([p[2] & 1 for p in parts]).astype(bool)
        doc = np.concatenate([(p[2] >> 1).astype(np.int32) for p in parts])
        sizes = [len(p[2]) for p in parts]
        del parts
        keys, pair = told_apart(np.concatenate(keys))
        count = np.bincount(pair[train], minlength=len(keys))
        context, follower = (keys // width).astype(np.int32), (keys % width).astype(np.int32)
        triples, triple = np.zeros(0, np.int64), pair
        if order > 2:
            triples, triple = told_apart(pair * width + np.concatenate(before))
        del before
        inner = (triples // width).astype(np.int32)
        # after the start there is no pair
        triple_count = np.where(hashes[context[inner]] == START, 0, np.bincount(triple[train], minlength=len(triples)) if len(triples) else 0)
        del train
        # counts of the contexts; split ones are counted in full beforehand, and so are their pairs; the start
        # is no token, its count is that of the ends
        at, parted = _at(split[0], hashes)
        for n, block in group.loc[group["kind"] == 2, ["n", "block"]].itertuples(index=False):
            w, v, total = unsqueeze(block, (np.uint64, n), (np.uint32, n), (np.int64, n))
            own = np.searchsorted(hashes, split[0])[v] * width + np.searchsorted(hashes, np.cumsum(w, dtype=np.uint64))
            count[np.searchsorted(keys, own)] = total
        seen = np.bincount(context, weights=count, minlength=width)
        followers = np.bincount(context[count > 0], minlength=width)
        place, common = _at(frequent, hashes)
        share = np.where(common, (counts[place] + 1) / base_total, 0.0) if len(frequent) else np.zeros(width)
        covered = np.bincount(context, weights=np.where(count > 0, share[follower], 0.0), minlength=width)
        if parted.any():
            seen = np.where(parted, np.where(hashes == START, model["ends"], counts[place]), seen)
            followers = np.where(parted, model["followers"][at], followers)
            covered = np.where(parted, model["covered"][at], covered)
        with np.errstate(divide="ignore"):
            away = np.log10(DISCOUNT * followers / np.maximum(seen, 1) / np.maximum(1 - covered, 1e-9))
        # a context never gives unseen words more than the base does
        away = np.where(followers > 0, np.minimum(away, 0.0), 0.0)
        trie = built(hashes, seen, away, keys, count, triples, triple_count)
        del keys, count, triple_count
        try:
            number = trie.words.find(hashes)
            at = trie.find_pairs(number[context], number[follower])
            hit = at >= 0
            score = np.where(number >= 0, trie.weights[np.maximum(number, 0)] if len(away) and trie.words.n else 0.0, 0.0)[context]
            score[hit] = trie.score(2, at[hit])
            if order > 2:
                # not found: the weight of the pair before, if it has one, and the answer of the shorter context
                second = number[context[inner]]
                above = trie.find_pairs(number[triples % width], np.where(hashes[context[inner]] == START, -1, second))
                longer = trie.find_triples(above, at[inner], second)
                score = score[inner]
                some = above >= 0
                score[some] += trie.pair_weights[above[some]]
                some = longer >= 0
                score[some] = trie.score(3, longer[some])
        finally:
            trie.close()
        # base: every token but the end is a context once, and the start is none
        word = hashes != START
        base = np.where(word, np.log10(seen + 1) - math.log10(base_total), 0.0)
        known = word & (seen > 0)
        missing = []
        a = 0
        for chunk, n in zip(blocks["chunk"], sizes):
            p, t, d = pair[a:a + n], triple[a:a + n], doc[a:a + n]
            a += n
            c = context[p]
            present, slot = np.unique(d, return_inverse=True)
            block = squeeze(present.astype(np.uint32), np.bincount(slot, weights=known[c]).astype(np.uint32),
                            np.bincount(slot, weights=base[c]), np.bincount(slot, weights=score[t]))
            out.append(_frame(1, 1, chunk=chunk, n=len(present), block=[block]))
            lost = np.flatnonzero(~hit[p])
            if len(lost):
                missing.append((np.full(len(lost), chunk), d[lost], hashes[follower[p[lost]]]))
        if missing:
            chunk, d, lost = (np.concatenate(x) for x in zip(*missing))
            shard = (mixed(lost) % np.uint64(n_shards)).astype(np.int64)
            order_ = np.lexsort((d, chunk, lost, shard))
            cuts = np.flatnonzero(np.diff(shard[order_], prepend=-1))
            for x, y in zip(cuts, [*cuts[1:], len(order_)]):
                o = order_[x:y]
                block = squeeze(np.diff(lost[o], prepend=np.uint64(0)), chunk[o].astype(np.int64), d[o].astype(np.uint32))
                out.append(_frame(3, 1, shard=int(shard[o[0]]), n=len(o), block=[block]))
        return pd.concat(out)

    return packed.groupBy("shard").applyInPandas(run, RESULTS)


def looked_up(missing: DataFrame, counts: DataFrame, sent) -> DataFrame:
    """(kind 3, chunk, n, block): by document, the base probability of the pairs not found."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        model = sent.value
        h, c = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for n, block in zip(right["n"], right["block"]):
            h, c = unsqueeze(block, (np.uint64, n), (np.int64, n))
            h = np.cumsum(h, dtype=np.uint64)
        found = []
        for n, block in zip(left["n"], left["block"]):
            lost, chunk, doc = unsqueeze(block, (np.uint64, n), (np.int64, n), (np.uint32, n))
            at, has = _at(h, np.cumsum(lost, dtype=np.uint64))
            score = np.log10(np.where(has, c[at] if len(c) else 0, 0) + 1) - math.log10(model["base_total"])
            found.append((chunk, doc, score))
        out = []
        if found:
            chunk, doc, score = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((doc, chunk))
            cuts = np.flatnonzero(np.diff(chunk[order], prepend=-1))
            for x, y in zip(cuts, [*cuts[1:], len(order)]):
                o = order[x:y]
                present, slot = np.unique(doc[o], return_inverse=True)
                out.append((3, int(chunk[o[0]]), len(present), squeeze(present.astype(np.uint32), np.bincount(slot, weights=score[o]))))
        return pd.DataFrame(out, columns=["kind", "chunk", "n", "block"])

    return (missing.groupBy("shard").cogroup(counts.groupBy("shard"))
            .applyInPandas(run, "kind int, chunk long, n long, block binary"))


def summed(parts: DataFrame, end_known: int, end_base: float) -> DataFrame:
    """Documents with their sums, from the blocks of their chunk."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        (n, block), = group.loc[group["kind"] == 0, ["n", "block"]].itertuples(index=False)
        ids, has_id, train, sizes = unsqueeze(block, (np.int64, n), (np.uint8, n), (np.uint8, n), (np.int64, n))
        known, base, score = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        rest = group[group["kind"] != 0]
        # in a fixed order of the blocks, so that reruns agree
        for kind, m, block in sorted(zip(rest["kind"], rest["n"], rest["block"])):
            if kind == 1:
                doc, k, b, s = unsqueeze(block, (np.uint32, m), (np.uint32, m), (np.float64, m), (np.float64, m))
                known[doc] += k
                base[doc] += b
            else:
                doc, s = unsqueeze(block, (np.uint32, m), (np.float64, m))
            score[doc] += s
        return pd.DataFrame({"doc_id": [i if y else None for i, y in zip(ids.tolist(), has_id)], "train": train.astype(bool), "n_tokens": sizes,
                             "n_known": known + end_known, "base_score": base + end_base, "score": score})

    return parts.groupBy("chunk").applyInPandas(run, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")


def scores(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text",
           chunk_tokens: int = CHUNK_TOKENS, shard_tokens: int = SHARD_TOKENS, order: int = 2) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) of every row; the model, of
    ``order`` words (2 or 3), learns from the rows where ``learn`` holds."""
    if order not in (2, 3):
        raise ValueError(f"order {order}: models have 2 or 3 words")
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(learn, F.lit(False)).alias("train"), F.col(text).alias("text"))
    # shards by the size of the corpus; a token takes six bytes or so
    chars = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    n_shards = max(1, -(-((chars[0] or 0) // 6 + chars[1]) // shard_tokens))
    counts = stored(unigrams(rows, n_shards))
    facts = counts.agg(F.sum("tokens"), F.sum("words")).first()
    n_tokens, n_words = facts[0] or 0, facts[1] or 0
    ends = rows.where("train").count() if n_tokens else 0
    frequent, count = frequent_words(counts, n_tokens)
    # the start stands before every document's first word
    heavy = [(int(h), int(c)) for h, c in zip(frequent, count) if c * n_shards > n_tokens and h != END]
    if ends * n_shards > n_tokens:
        heavy.append((START, ends))
    heavy.sort()
    split = (np.array([h for h, _ in heavy], np.uint64), np.array([min(n_shards, -(-2 * c * n_shards // n_tokens)) for _, c in heavy], np.int64))
    model = {"frequent": frequent, "counts": count, "split": split, "tokens": n_tokens, "ends": ends, "base_total": n_tokens + n_words + 1}
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    packed = pair_blocks(rows, n_shards, sent, order, chunk_tokens)
    if heavy:
        # the pairs of split contexts in full; as many numbers to the driver as there are such contexts
        whole = stored(whole_pairs(rows, n_shards, sent, order))
        sums = whole.where("kind = 4").groupBy("chunk").agg(F.sum("n").alias("n"), F.sum("covered").alias("covered")).collect()
        model = model | {"followers": np.zeros(len(heavy), np.int64), "covered": np.zeros(len(heavy))}
        for r in sums:
            model["followers"][r["chunk"]], model["covered"][r["chunk"]] = r["n"], r["covered"]
        packed = packed.unionByName(whole.where("kind = 2").drop("covered"))
        sent = spark.sparkContext.broadcast(model)
    found = stored(answered(packed, n_shards, sent, order))
    rest = looked_up(found.where("kind = 3").select("shard", "n", "block"), counts.select("shard", "n", "block"), sent)
    end_base = math.log10((ends + 1) / model["base_total"])
    parts = found.where("kind < 2").select("kind", "chunk", "n", "block").unionByName(rest)
    return summed(parts, 1 if ends else 0, end_base).withColumn("train_tokens", F.lit(n_tokens).cast("long"))


def query(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    rows = scores(docs, F.coalesce(crc_mod("doc_id", 7) != 2, F.lit(False)), order=ORDER)
    return rows.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

