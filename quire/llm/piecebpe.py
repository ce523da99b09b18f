"""SentencePiece encoding and decoding by a merge-type prefix table.

Byte-pair merging is greedy: of all neighbouring symbols whose concatenation is a piece, the pair of
the best score is merged, the leftmost first. Two facts make it linear. A run of tokens of an
encoding is the encoding of its own text; and a sequence of tokens is an encoding if and only if every
neighbouring pair is one (until the first merge across a border between tokens, each token and each
pair of neighbours goes through the same merges as it would alone). So every prefix of a text has one
last token: the one piece that ends there (found by an automaton over all pieces) and is compatible
with the last token of the prefix before it. The table of these is filled from left to
right, and the ids are read from it backwards.

Compatibility of a pair is tested by its border alone. While a piece is merged, the symbol at its
right (left) end changes a few times; of each symbol we keep the worst rank among the
merges up to the next change, beyond which the piece waits. The pair is compatible if no merge across
the border is better than what both sides still have to do, at any time. Outcomes are kept by piece.

Where no piece of the vocabulary holds a space after another character (checked), a text is cut
before its spaces into independent words, and the ids of short words are kept, up to a bound. A
character that is no piece becomes its UTF-8 bytes.

The model file is read on the driver and goes to the tasks as a broadcast; it is as large as the
vocabulary. Models that this module would not encode exactly are refused: other types than BPE, other
normalizers than identity, user-defined or unused pieces, pieces with a character that is no
piece. There is no shuffle.

Defined results. A null or empty text has no tokens but begin and end, and decodes to an empty
text. Invalid UTF-8 is U+FFFD, byte by byte. A U+2581 in a text decodes as a space, as in the
library. Extra columns pass through; an empty table gives an empty table."""

from __future__ import annotations

import codecs
import re
import struct

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import as_bytes, fresh, map_columns

SPACE = "▁"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Words of up to so many characters are kept with their ids, so many of them at most.
KEPT_CHARS, KEPT_WORDS = 32, 200_000
#: Tested pairs kept at most, over all pieces.
KEPT_PAIRS = 1_000_000
NEVER = 1 << 60

codecs.register_error("quire_each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def fields(data: bytes):
    """(number, value) of a protocol buffer message's fields; a value is an int or bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = {1: 8, 2: 0, 5: 4}[kind] or varint()
            value = data[at:at + size]
            at += size
        yield key >> 3, value


class Model:
    """Pieces, scores and kinds of a model file, and how it treats white space."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        trainer, normalizer = {}, {}
        for number, value in fields(data):
            if number == 1:
                x = dict(fields(value))
                self.pieces.append(x[1].decode())
                self.scores.append(struct.unpack("<f", x[2])[0] if 2 in x else 0.0)
                self.kinds.append(x.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.prefix = bool(normalizer.get(3, 1))
        normal = [p for p, k in zip(self.pieces, self.kinds) if k == NORMAL]
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0):
            raise ValueError("not a BPE model with byte fallback")
        if normalizer.get(1, b"") != b"identity" or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or trainer.get(24, 0):
            raise ValueError("the model normalizes texts; only the identity is implemented")
        if set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not implemented")
        if {c for p in normal for c in p} - set(normal):
            raise ValueError("a piece holds a character that is no piece")


class Entry:
    """A piece with its length and packed id."""
    __slots__ = ("piece", "size", "packed")

    def __init__(self, piece: str, packed: bytes):
        self.piece, self.size, self.packed = piece, len(piece), packed


class Encoder:
    def __init__(self, model: Model):
        self.model = model
        order = {s: r for r, s in enumerate(sorted({s for s, k in zip(model.scores, model.kinds) if k == NORMAL}, reverse=True))}
        self.rank: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score, kind) in enumerate(zip(model.pieces, model.scores, model.kinds)):
            if kind == NORMAL:
                self.rank[piece] = order[score]
                # with the outcomes of the tested left neighbours
                self.automaton.add_word(piece, (len(piece), {}, Entry(piece, struct.pack("<I", i))))
        self.automaton.make_automaton()
        self.bytes = {int(p[3:5], 16): struct.pack("<I", i) for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == BYTE}
        self.spines: dict[str, tuple | None] = {}
        # kept words of late and those before: a word in use stays when the younger ones are full
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.n_tested = 0
        self.characters = {p for p in self.rank if len(p) == 1}
        self.known = re.compile("[" + "".join(map(re.escape, sorted(self.characters))) + "]+|.", re.S)
        apart = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.rank)
        self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if apart else ".+", re.S)

    def merges(self, piece: str) -> list[tuple[int, int, str, int]]:
        """The merges of a piece's characters, in the order they happen: (rank, symbols after the new
        one, the new one, symbols before it)."""
        symbols, done = list(piece), []
        while True:
            pairs = [(self.rank.get(a + b, NEVER), k) for k, (a, b) in enumerate(zip(symbols, symbols[1:]))]
            rank, k = min(pairs, default=(NEVER, 0))
            if rank == NEVER:
                return done
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
            done.append((rank, len(symbols) - 1 - k, symbols[k], k))

    def spine(self, piece: str) -> tuple | None:
        """(left, right): the symbols at a piece's end, from its first to itself, each with the worst
        rank of the merges up to the next one. None if the piece is not its own encoding."""
        if piece in self.spines:
            return self.spines[piece]
        done = self.merges(piece)
        found = None
        if not done and len(piece) == 1 or done and done[-1][2] == piece:
            ends = []
            for left in (True, False):
                steps, symbol, worst = [], piece[0 if left else -1], -1
                for rank, after, merged, before in done:
                    worst = max(worst, rank)
                    if (before if left else after) == 0:
                        steps.append((symbol, worst))
                        symbol, worst = merged, -1
                ends.append([*steps, (symbol, NEVER)])
            found = tuple(ends)
        self.spines[piece] = found
        return found

    def compatible(self, a: str | None, b: str) -> bool:
        """Whether (a, b) is the encoding of a + b; without a, whether b is that of itself."""
        two = self.spine(b)
        if a is None or two is None:
            return two is not None
        right, left = self.spine(a)[1], two[0]
        i = k = 0
        while True:
            (r, wait_r), (l, wait_l) = right[i], left[k]
            across = self.rank.get(r + l, NEVER)
            if wait_r <= across and wait_r <= wait_l:
                if wait_r == NEVER:
                    return True
                i += 1
            elif across <= wait_l:
                return False
            else:
                k += 1

    def table(self, word: str) -> list[Entry | None]:
        """The last token of every prefix of a word of known characters; None for the empty one."""
        last: list[Entry | None] = [None] * (len(word) + 1)
        for end, (size, tested, entry) in self.automaton.iter(word):
            end += 1
            if last[end] is None:
                before = last[end - size]
                fits = tested.get(before)
                if fits is None:
                    fits = tested[before] = self.test(before, entry)
                if fits:
                    last[end] = entry
        return last

    def test(self, before: Entry | None, entry: Entry) -> bool:
        if self.n_tested >= KEPT_PAIRS:
            for _, tested, _ in self.automaton.values():
                tested.clear()
            self.n_tested = 0
        self.n_tested += 1
        return self.compatible(before.piece if before else None, entry.piece)

    def of_word(self, word: str) -> bytes:
        """The packed ids of a word, read from the table backwards."""
        if not self.characters.issuperset(word):
            return b"".join(self.of_word(x) if x[0] in self.characters else b"".join(self.bytes[b] for b in x.encode())
                            for x in self.known.findall(word))
        last, at, out = self.table(word), len(word), []
        while at:
            out.append(last[at].packed)
            at -= last[at].size
        return b"".join(reversed(out))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, without begin and end."""
        if not text:
            return b""
        if self.model.prefix:
            text = " " + text
        words, out = self.words, []
        for w in self.cut.findall(text.replace(" ", SPACE)):
            ids = words.get(w)
            if ids is None:
                ids = self.older.get(w) or self.of_word(w)
                if len(w) <= KEPT_CHARS:
                    if len(words) >= KEPT_WORDS // 2:
                        self.older, self.words = words, (words := {})
                    words[w] = ids
            out.append(ids)
        return b"".join(out)


class Decoder:
    def __init__(self, model: Model):
        self.model = model
        self.pieces = [p.replace(SPACE, " ").encode() if k == NORMAL else b"" if k == CONTROL else
                       bytes([int(p[3:5], 16)]) if k == BYTE else model.unknown_text.encode() for p, k in zip(model.pieces, model.kinds)]
        self.controls = {i for i, k in enumerate(model.kinds) if k == CONTROL}
        self.spaced = [k == NORMAL and p.startswith(SPACE) for p, k in zip(model.pieces, model.kinds)]

    def decode(self, ids: list[int]) -> str:
        """The space that encoding put before the text goes: that of the first piece with any text.
        Bytes that are no UTF-8 become U+FFFD, one each; a control piece ends a run of bytes."""
        while ids and ids[0] in self.controls:
            ids = ids[1:]
        if not ids:
            return ""
        drop = 1 if self.model.prefix and self.spaced[ids[0]] else 0
        if self.controls.isdisjoint(ids[:-1]):
            return b"".join([self.pieces[i] for i in ids])[drop:].decode("utf-8", "quire_each_byte")
        runs, run = [], []
        for i in [*ids, *list(self.controls)[:1]]:
            if i in self.controls:
                runs.append(b"".join(run))
                run = []
            else:
                run.append(self.pieces[i])
        runs[0] = runs[0][drop:]
        return "".join(x.decode("utf-8", "quire_each_byte") for x in runs)


def shared_model(spark, model: str | None):
    """The model file's content, read once on the driver, as a broadcast."""
    with open(model or default_model(), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


_READY: dict[int, tuple] = {}


def codec(data: bytes) -> tuple[Encoder, Decoder, Model]:
    """Encoder and decoder of a model, one for all tasks of a Python worker."""
    key = hash(data)
    if key not in _READY:
        _READY.clear()
        model = Model(data)
        _READY[key] = Encoder(model), Decoder(model), model
    return _READY[key]


def encoded(docs: DataFrame, text: str = "text", out: str = "ids", model: str | None = None, begin: bool = True, end: bool = True) -> DataFrame:
    """``docs`` with ``out``, the text's ids as little-endian unsigned 32-bit integers (binary)."""
    return coded(docs, text, out, None, model, begin, end)


def coded(docs: DataFrame, text: str = "text", out: str = "ids", decoded: str | None = "decoded", model: str | None = None,
          begin: bool = True, end: bool = True) -> DataFrame:
    """As ``encoded``, and with ``decoded``, the text decoded from these ids."""
    data = shared_model(docs.sparkSession, model)
    added = [T.StructField(out, T.BinaryType())] + ([T.StructField(decoded, T.StringType())] if decoded else [])

    def make():
        encoder, decoder, m = codec(data.value)
        head, tail = struct.pack("<I", m.begin) if begin else b"", struct.pack("<I", m.end) if end else b""

        def f(texts):
            ids = [head + encoder.encode(t.decode("utf-8", "quire_each_byte")) + tail for t in as_bytes(texts)]
            found = [pa.array(ids, pa.binary())]
            if decoded:
                found.append(pa.array([decoder.decode(np.frombuffer(x, "<u4").tolist()) for x in ids], pa.string()))
            return found
        return f

    return map_columns(docs, [text], added, make)


def decoded(rows: DataFrame, ids: str = "ids", out: str = "decoded", model: str | None = None) -> DataFrame:
    """``rows`` with ``out``, the text of the packed ids; null ids are an empty text."""
    data = shared_model(rows.sparkSession, model)

    def make():
        decoder = codec(data.value)[1]
        return lambda packed: [pa.array([decoder.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in packed.to_pylist()], pa.string())]

    return map_columns(rows, [ids], [T.StructField(out, T.StringType())], make)


def query(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of packed ids and of the decoded text."""
    rows = coded(docs.select("doc_id", "text"))
    return rows.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
