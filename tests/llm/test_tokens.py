"""Fill-in-middle, SentencePiece and cross-tokenizer operators: brute force, the libraries, round trips, edge cases."""

import hashlib
import random
import re
import struct
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import fim, piecebpe, tokenalign

LONG = "Word of, mouth\n" * 40_000
EDGES = [(1, None, "en", "a"), (2, "", "en", None), (3, "   \n\t ", None, "a"), (4, LONG, "en", "b"), (5, "a<P>b", "en", "b"),
         (6, "one", "en", None), (6, "one", "en", None), (None, "one two", None, "a"), (-7, "naïve Ünï œuvre 中文 \U0001f600", "fr", "b"),
         (8, "▁ is a piece", "en", "a"), (9, " " * 3000 + "x", "en", "a"), (10, "<|endoftext|><s></s> <0x0A>", "en", "a"), (11, "a" * 5000, "en", "a")]
ALPHABET = ["a", "b", "e", "t", "h", " ", "  ", "▁", "\n", "é", "中", "国", "\U0001f600", "ing", "the", "1", "\0", "﻿", "ﬁ", "<s>", "<0x0A>", "<P>", "<", "S>"]


def strings(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 60))) for _ in range(n)]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def rows_by_id(df):
    found = defaultdict(list)
    for r in df.collect():
        found[r["doc_id"]].append(r.asDict())
    return found


@pytest.fixture(scope="module")
def edges(documents):
    return documents(EDGES)


# fill in the middle --------------------------------------------------------------------------------


def plain_fim(key, text):
    """The contract, unit by unit."""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, h = len(units), hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fim_matches_the_contract_unit_by_unit(llm, edges, sf):
    rows = [(r["doc_id"], r["text"] or "") for r in edges.union(sf("documents").select(edges.columns)).select("doc_id", "text").collect()]
    rows += [(1000 + k, t) for k, t in enumerate(strings(400))]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    want = Counter()
    for i, t in rows:
        n, form, p, m, out = plain_fim("" if i is None else i, t)
        want[(i, n, form, p, m, sha(out), sha(t))] += 1
    assert Counter(tuple(r) for r in fim.query(docs).collect()) == want
    assert {k[2] for k in want} == {"plain", "psm", "spm"}


def test_rank_index_is_exact_and_its_segments_hold_their_error():
    rng = np.random.default_rng(3)
    for steps in (np.ones(1, int), rng.integers(1, 9, 30_000), np.r_[np.ones(5000, int), np.full(5000, 40), rng.integers(1, 3000, 3000)], rng.integers(1, 10**6, 300)):
        offsets = np.r_[0, np.cumsum(steps)]
        index = fim.RankIndex(offsets)
        assert [index[k] for k in range(len(offsets))] == offsets.tolist()
        assert all(abs(index.predicted(k) - o) <= fim.ERROR + 1 for k, o in enumerate(offsets.tolist()))
    assert len(fim.RankIndex(np.arange(0, 300_000, 3)).first) == 1


def test_boundaries_across_pieces(monkeypatch):
    monkeypatch.setattr(fim, "PIECE", 7)
    for t in strings(300) + ["abc def, ghi" * 9, ""]:
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
        assert fim.boundaries(t).tolist() == np.cumsum([0, *map(len, units)]).tolist()


def test_fim_extra_columns_and_an_empty_table(llm, edges):
    docs = edges.withColumn("form", F.lit("mine")).withColumn("Output", F.lit(1))
    out = fim.fill_in_middle(docs)
    assert out.columns == [*docs.columns, "n", "form_", "prefix_chars", "middle_chars", "output_"]
    assert out.where("form <> 'mine' or Output <> 1").count() == 0 and out.count() == len(EDGES)
    assert fim.query(edges.where("doc_id = 99")).count() == 0


# SentencePiece -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def own():
    with open(piecebpe.default_model(), "rb") as f:
        return piecebpe.codec(f.read())


def test_ids_equal_the_library(own, library, sf):
    texts = [t for _, t, _, _ in EDGES if t] + strings(3000) + [r["text"] or "" for r in sf("documents").select("text").collect()]
    for t in texts:
        ids = np.frombuffer(own[0].encode(t), "<u4").tolist()
        assert ids == library.encode(t), t[:80]
        assert own[1].decode(ids) == library.decode(ids), t[:80]


def test_decoding_any_ids_equals_the_library(own, library):
    rng = random.Random(1)
    for _ in range(5000):
        ids = [rng.choice([0, 1, 2, 259, 28705, rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randrange(0, 12))]
        assert own[1].decode(ids) == library.decode(ids), ids


def test_pair_compatibility_against_merging(own):
    encoder, rng = own[0], random.Random(2)
    pieces, seen = list(encoder.rank), Counter()
    for _ in range(20_000):
        a = rng.choice(pieces)
        b = rng.choice(pieces) if rng.random() < 0.5 else rng.choice(pieces)[-3:]
        if b not in encoder.rank or encoder.spine(a) is None:
            continue
        symbols = list(a + b)
        for _, _, merged, k in encoder.merges(a + b):
            symbols[k:k + 2] = [merged]
        assert encoder.compatible(a, b) == (symbols == [a, b]), (a, b)
        seen[symbols == [a, b]] += 1
    assert min(seen.values()) > 500


def test_prefix_table_gives_every_prefix_its_last_token(own, library):
    encoder = own[0]
    for word in ("▁international", "▁aaaaaaaaaaab", "▁▁▁▁▁▁▁", "ationing"):
        table = encoder.table(word)
        for end in range(1, len(word) + 1):
            symbols = list(word[:end])
            for _, _, merged, k in encoder.merges(word[:end]):
                symbols[k:k + 2] = [merged]
            assert table[end].piece == symbols[-1]


def test_words_and_pairs_that_no_longer_fit_are_computed_again(own, monkeypatch):
    with open(piecebpe.default_model(), "rb") as f:
        encoder = piecebpe.Encoder(piecebpe.Model(f.read()))
    monkeypatch.setattr(piecebpe, "KEPT_WORDS", 6)
    monkeypatch.setattr(piecebpe, "KEPT_PAIRS", 50)
    text = LONG[:3000] + " ".join(strings(50))
    assert encoder.encode(text) == own[0].encode(text)


def test_piece_query_and_round_trip(documents, edges, library, llm):
    found = rows_by_id(piecebpe.query(edges))
    for i, t, _, _ in EDGES:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want = {"doc_id": i, "n_tokens": len(ids), "ids_sha256": sha(struct.pack(f"<{len(ids)}I", *ids)), "decoded_sha256": sha(library.decode(ids))}
        assert all(r == want for r in found[i])
    assert sum(map(len, found.values())) == len(EDGES)
    both = piecebpe.decoded(piecebpe.encoded(edges))
    assert both.where("not (decoded <=> replace(coalesce(text, ''), '▁', ' '))").count() == 0
    assert piecebpe.query(edges.where("doc_id = 99")).count() == 0


# alignment -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def a_tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def tokens(text, a_tokenizer, library):
    """[(id, bytes)] of both; none if they do not join to space + text."""
    table = tokenalign.byte_level()
    one = [(i, bytes(table[c] for c in a_tokenizer.id_to_token(i))) for i in a_tokenizer.encode(" " + text, add_special_tokens=False).ids]
    two = [(i, bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i) else library.id_to_piece(i).replace("▁", " ").encode()) for i in library.encode(text)]
    want = (" " + text).encode()
    if not text or any(b"".join(x for _, x in side) != want for side in (one, two)):
        return [], []
    return one, two


def ranges(side):
    at, out = 0, []
    for i, x in side:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def plain_alignment(text, a_tokenizer, library):
    """(links, groups) by comparing byte ranges one by one."""
    one, two = map(ranges, tokens(text, a_tokenizer, library))
    links, k = [], 0
    for p, (_, s, e) in enumerate(one):
        while two[k][2] <= s:
            k += 1
        q = k
        while q < len(two) and two[q][1] < e:
            links.append((p, q, min(e, two[q][2]) - max(s, two[q][1])))
            q += 1
    cuts = sorted({e for _, _, e in one} & {e for _, _, e in two})
    groups = [([], []) for _ in cuts]
    for side, tokens_of in enumerate((one, two)):
        for p, (_, _, e) in enumerate(tokens_of):
            groups[bisect_left(cuts, e)][side].append(p)
    return one, two, links, groups


@pytest.fixture(scope="module")
def both():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as g:
        return tokenalign.Tokenizers(f.read(), public_tokenizers.PATTERN, g.read())


def test_products_equal_dense_matrices(monkeypatch):
    rng = np.random.default_rng(4)
    for block in (5, 1 << 20):
        monkeypatch.setattr(tokenalign, "BLOCK_PRODUCTS", block)
        for _ in range(30):
            one, two = rng.integers(0, 3, (rng.integers(1, 9), 6)), rng.integers(0, 3, (6, rng.integers(1, 9)))
            made = []
            for m in (one, two):
                r, c = np.nonzero(m)
                made.append(tokenalign.CSR(np.r_[0, np.cumsum((m > 0).sum(1))], c, m[r, c], m.shape[1]))
            out = np.zeros((one.shape[0], two.shape[1]), int)
            r, c, v = made[0].product(made[1])
            out[r, c] = v
            assert (out == one @ two).all()
            t = made[0].transposed()
            assert [t.indptr[-1], t.n_rows] == [made[0].indptr[-1], 6]


def test_links_and_groups_against_byte_ranges(both, a_tokenizer, library):
    texts = [t for _, t, _, _ in EDGES if t and len(t) < 4000] + strings(200, 7)
    x = both.align([t.encode() for t in texts])
    i, j, v = x.links()
    links, shared, names = list(zip(i.tolist(), j.tolist(), v.tolist())), Counter(), x.group_texts(*both.names)
    for p, q, ones in x.shared():
        assert (ones == 1).all()
        shared.update(zip(p.tolist(), q.tolist()))
    want_links, want_shared, a0, b0 = [], Counter(), 0, 0
    for k, t in enumerate(texts):
        one, two, l, groups = plain_alignment(t, a_tokenizer, library)
        want_links += [(a0 + p, b0 + q, n) for p, q, n in l]
        want_shared.update((a0 + p, b0 + q) for ps, qs in groups for p in ps for q in qs)
        assert names[k] == ";".join(",".join(str(one[p][0]) for p in ps) + "|" + ",".join(str(two[q][0]) for q in qs) for ps, qs in groups)
        assert (x.n_a[k], x.n_b[k], x.g_from[k + 1] - x.g_from[k]) == (len(one), len(two), len(groups))
        a0, b0 = a0 + len(one), b0 + len(two)
    assert links == want_links and shared == want_shared


def test_merges_equal_the_tokenizers_library(both, a_tokenizer):
    rng = random.Random(9)
    more = ["".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0x3000, 0xD800), rng.randrange(0xE000, 0x20000), 32, 10])) for _ in range(20)) for _ in range(2000)]
    for t in strings(2000) + more + [" " * 499 + "x", " " * 501, "\n" * 600 + "x"]:
        assert both.a_ids(t) == a_tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_alignment_counts_over_the_corpus(documents, a_tokenizer, library, monkeypatch, llm):
    texts = [(i, t) for i, t, _, _ in EDGES if t is None or len(t) < 6000] + [(100 + k, t) for k, t in enumerate(strings(150, 8) * 2)]
    texts += [(500 + k, "the same old story the same") for k in range(60)]
    docs = llm.createDataFrame(texts, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(tokenalign, "CHUNK_LINKS", 300)
    plain = [plain_alignment(t or "", a_tokenizer, library) for _, t in texts]
    counts = Counter((one[p][0], two[q][0]) for one, two, links, _ in plain for p, q, _ in links)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    want = Counter()
    for (i, _), (one, two, links, groups) in zip(texts, plain):
        pairs = [(one[p][0], two[q][0]) for p, q, _ in links]
        said = ";".join(",".join(str(one[p][0]) for p in ps) + "|" + ",".join(str(two[q][0]) for q in qs) for ps, qs in groups)
        want[(i, len(one), len(two), len(groups), len(links), sum(counts[x] == best[x[1]] for x in pairs), sum(counts[x] for x in pairs), sha(said) if one else "")] += 1
    assert Counter(tuple(r) for r in tokenalign.query(docs).collect()) == want


def test_alignment_extra_columns_long_texts_and_an_empty_table(edges):
    found = tokenalign.alignments(edges.withColumn("pair", F.lit(1)))
    rows = found.collect()
    assert len(rows) == len(EDGES) and all(r["pair"] == 1 for r in rows)
    assert {r["doc_id"] for r in rows if r["n_a"] == 0} == {1, 2, 8}
    assert next(r["n_links"] for r in rows if r["doc_id"] == 4) > 100_000
    assert tokenalign.query(edges.where("doc_id = 99")).count() == 0
