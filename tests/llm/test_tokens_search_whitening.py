"""Byte-level BPE against the tokenizer library and a plain merge, ranked
search against a full ranking, whitening against a dense eigensolver; with
nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing column names."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from pathwise.llm import byte_bpe, lexical_search, whitening

DOCS = "doc_id long, text string, tokens string, item long, score long, rank int, term string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, "y") for i, t in rows], DOCS).repartition(parts)


# ---- byte-level BPE ---------------------------------------------------------------
RANKS = byte_bpe.read_ranks(byte_bpe.VOCABULARY)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
MIXED = "aaabcdest  \n\t\x1c\x85é́中ß\U0001f600\U00016ff4՘\U0003fc3d0123٠'ll've.,;=="


def mixed(rng, n):
    return "".join(rng.choice(MIXED) for _ in range(n))


def test_encoder_equals_the_library():
    rng = random.Random(5)
    encoder, decoder = byte_bpe.Encoder(byte_bpe.VOCABULARY, public_tokenizers.PATTERN), byte_bpe.Decoder(byte_bpe.VOCABULARY)
    texts = [mixed(rng, rng.randint(0, 80)) for _ in range(1500)]
    texts += ["a" * 20_000, " " * 3000 + "x", "ab" * 9000, "".join(rng.choice("etaoinsh") for _ in range(9000)), "",
              "<|endoftext|> a", "\x00\x01\x7f", "don't I'LL we'll"]
    for t in texts:
        ids = encoder.encode(t)
        assert ids.tolist() == LIBRARY.encode_ordinary(t)
        assert decoder.decode(ids) == t


def test_transducer_forgets_without_a_change(monkeypatch):
    rng = random.Random(6)
    words = ["".join(rng.choice("thearionsd") for _ in range(rng.randint(1, 30))).encode() for _ in range(300)]
    small, large = byte_bpe.Transducer(RANKS, max_states=20), byte_bpe.Transducer(RANKS)
    want = [tuple(byte_bpe.merge_by_rank(w, RANKS)) if w not in RANKS else (RANKS[w],) for w in words]
    assert [large.encode(w) for w in words] == want
    assert [small.encode(w) for w in words] == want
    assert len(small.states) <= 21
    monkeypatch.setattr(byte_bpe, "STRETCH", 200)  # settled tokens leave early
    long = b"".join(words)
    assert byte_bpe.Transducer(RANKS).encode(long) == tuple(byte_bpe.merge_by_rank(long, RANKS))


def test_transducer_of_other_vocabularies():
    """Ranks out of order and tokens that no merge reaches."""
    rng = random.Random(7)
    for _ in range(40):
        tokens = [bytes([b]) for b in b"abc"]
        for _ in range(12):
            t = b"".join(rng.choice(tokens) for _ in range(2))
            if t not in tokens:
                tokens.append(t)
        tokens += [t for t in {bytes(rng.choice(b"abc") for _ in range(3)) for _ in range(2)} if t not in tokens]
        ranks = {t: i for i, t in enumerate(tokens)}
        machine = byte_bpe.Transducer(ranks)
        for _ in range(60):
            w = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
            assert list(machine.encode(w)) == ([ranks[w]] if w in ranks else byte_bpe.merge_by_rank(w, ranks))


def test_decoding_in_small_runs(monkeypatch):
    monkeypatch.setattr(byte_bpe, "RUN", 1)
    decoder = byte_bpe.Decoder(byte_bpe.VOCABULARY)
    rng = np.random.default_rng(3)
    for _ in range(300):
        ids = rng.integers(0, 256, rng.integers(0, 12))
        assert decoder.decode(ids) == LIBRARY.decode_bytes(ids.tolist()).decode("utf-8", "replace")


def test_utf8_stream_equals_python():
    rng = random.Random(8)
    for _ in range(5000):
        b = bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE4, 0xB8, 0xED, 0xA0, 0xF0, 0x9F, 0x98, 0xF4, 0x90, 0xFF, 0xC0])
                  for _ in range(rng.randint(0, 12)))
        stream, cut = byte_bpe.Utf8Stream(), rng.randint(0, len(b))
        assert stream.feed(b[:cut]) + stream.feed(b[cut:]) + stream.end() == b.decode("utf-8", "replace")


def test_token_digests(spark):
    rng = random.Random(9)
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "three"), (4, "word " * 30_000)]
    rows += [(10 + i, mixed(rng, rng.randint(1, 300))) for i in range(40)]
    got = sorted(byte_bpe.token_digests(frame(spark, rows)).collect(), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = LIBRARY.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(t or "")))
    assert [tuple(r) for r in got] == sorted((tuple(w) for w in want), key=lambda w: str(
        f"Row(doc_id={w[0]}, n_tokens={w[1]}, ids_sha256='{w[2]}', decoded_sha256='{w[3]}')"))
    assert byte_bpe.token_digests(frame(spark, [])).collect() == []
    loose = spark.createDataFrame([(1, None), (2, [260, None, 999_999]), (None, [])], "doc_id long, tokens array<int>")
    texts = {r["doc_id"]: r["text"] for r in byte_bpe.decode_tokens(loose).collect()}
    assert texts == {1: "", 2: LIBRARY.decode([260]), None: ""}


# ---- ranked search ------------------------------------------------------------------
def ranked(docs, items, k=10):
    """The definition, written out: every document scored for every item."""
    def split(t):
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t)

    sets = [(i, Counter(split(t))) for i, t in docs]
    n_docs = sum(1 for _, c in sets if c)
    n_terms = sum(sum(c.values()) for _, c in sets)
    df = Counter(w for _, c in sets for w in c)
    out = []
    for item, text in items:
        scores = []
        for at, (i, c) in enumerate(sets):
            if not c:
                continue
            m = 25 + (75 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m)) for w in split(text) if c[w])
            if s > 0:
                scores.append((-s, i is None, i or 0, at))
        out += [(item, r + 1, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def library():
    rng = random.Random(11)
    common, rare = [f"w{i}" for i in range(12)], [f"Rare{i}" for i in range(60)] + ["é", "中文", "x_y", "a-b", "٣"]
    docs = [(i, " ".join(rng.choice(common) if rng.random() < 0.8 else rng.choice(rare)
                         for _ in range(rng.randint(1, 60)))) for i in range(400)]
    docs += [(500 + i, docs[7][1]) for i in range(25)]  # ties beyond the tenth place
    docs += [(7, docs[7][1]), (None, docs[7][1]), (None, "rare1"), (600, None), (601, ""), (602, " .,;\x00"),
             (603, "w1 " * 40_000 + "rare3")]
    items = [(i, " ".join(rng.choice(common + rare) for _ in range(rng.randint(1, 14)))) for i in range(30)]
    items += [(100, docs[7][1]), (101, None), (102, ""), (103, "nothing of this"), (0, "rare1 RARE1 rare1"),
              (None, "rare2"), (104, " ".join(common))]
    return docs, items


def test_search_equals_full_ranking(spark, library, monkeypatch):
    docs, items = library
    want = ranked(docs, items)
    asked = spark.createDataFrame([(i, t, 1, 2, "z") for i, t in items],
                                  "item_id long, text string, item long, doc_id long, rank string").repartition(2)
    for parts, slice_chars, item_bytes in ((1, 4_000_000, 1 << 24), (5, 900, 1 << 24), (3, 4000, 1500)):
        monkeypatch.setattr(lexical_search, "ITEM_BYTES", item_bytes)
        monkeypatch.setattr("pathwise.llm.common.SLICE_CHARS", slice_chars)
        got = lexical_search.search(frame(spark, docs, parts), asked).collect()
        assert sorted(map(tuple, got), key=str) == want


def test_accumulators_are_limited(library):
    """The bounded walk returns the k best of a block, and fewer than all."""
    docs, items = library
    texts = [t or "" for _, t in docs]
    index = {w: i for i, w in enumerate(sorted({w for _, t in items for w in lexical_search.terms(t or "")}))}
    counts = Counter(w for t in texts for w in set(lexical_search.terms(t)))
    n_docs, n_terms = sum(bool(lexical_search.terms(t)) for t in texts), sum(len(lexical_search.terms(t)) for t in texts)
    block = lexical_search.Block(texts, index, n_docs, n_terms)
    fewer = 0
    for _, text in items:
        repeats = Counter(w for w in lexical_search.terms(text or "") if w in counts)
        query = [(index[w], lexical_search.weight(n_docs, counts[w]) * repeats[w])
                 for w in sorted(repeats, key=lambda w: (counts[w], w))]
        found, score = block.rank(query, 10, 1)
        full = np.zeros(len(texts), np.int64)
        for t, w in query:
            lo, hi, _ = block.lists[t]
            full[block.doc[lo:hi]] += w * block.impact[lo:hi]
        assert (full[found] == score).all()
        assert sorted(score)[-10:] == sorted(full[full > 0])[-10:]
        fewer += len(found) < np.count_nonzero(full)
    assert fewer > 10


def test_search_of_empty_tables(spark, library):
    docs, items = library
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert lexical_search.search(frame(spark, []), asked).collect() == []
    assert lexical_search.search(frame(spark, docs), asked.limit(0)).collect() == []


# ---- whitening ------------------------------------------------------------------------
ROWS = "vec_id long, embedding array<float>, n long, component int, x string, v long"


def vectors(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, 1, 2, "x", 3) for i, v in rows], ROWS).repartition(parts)


def dense(x):
    n = len(x)
    centred = (n * x - x.sum(0)) / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    return centred, e[::-1], u[:, ::-1], v


@pytest.mark.parametrize("d,n,kind", [(64, 700, "noise"), (12, 200, "steep"), (5, 60, "steep"), (100, 400, "clusters")])
def test_whitening_equals_dense(spark, d, n, kind):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((n, d)).astype(np.float32)
    if kind == "steep":
        a *= 2.0 ** -np.arange(d, dtype=np.float32)
    if kind == "clusters":
        a = a / 10 + 3 * rng.standard_normal((9, d)).astype(np.float32)[rng.integers(0, 9, n)]
    bad = [(900, None), (901, []), (902, [None] * d), (903, [float("nan")] * d), (904, [float("inf")] * d), (905, [1.0] * (d + 1))]
    rows = [(i, a[i].tolist()) for i in range(n)] + [(None, a[0].tolist()), (5, a[5].tolist())]
    x = np.floor(1024 * np.array([v for _, v in rows], float)).astype(np.int64) + 100_000
    centred, e, u, v = dense(x)
    got = whitening.whiten(vectors(spark, rows + bad)).collect()
    k = min(8, d)
    assert len(got) == k * len(rows) and {r.n for r in got} == {len(rows)}
    assert max(r.identity_error for r in got) < 1e-9
    want = centred @ u[:, :k] / np.sqrt(e[:k])
    exact = ((len(rows) * x.astype(object) - x.sum(0)) ** 2).sum(1)
    by = {(r.vec_id, r.component): r for r in got}
    for c in range(k):
        assert abs(by[7, c + 1].explained / (e[c] / np.trace(v)) - 1) < 1e-10
        mine = np.array([by[i, c + 1].whitened for i in range(n)])
        sign = np.sign(mine @ want[:n, c])
        assert np.abs(mine - sign * want[:n, c]).max() < 1e-8
    assert [by[i, 1].deviation for i in range(n)] == exact[:n].tolist()
    assert by[None, 1].whitened == by[0, 1].whitened


def test_whitening_without_variance(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None)])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(vectors(spark, [(i, [1.0, 2.0]) for i in range(9)])).collect() == []
    line = whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)])).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12


def test_whitening_of_huge_entries(spark):
    rows = [(i, [float(2 ** 40 + i * 2 ** 30), float(i % 3)]) for i in range(20)]
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64).astype(object) + 100_000
    exact = ((20 * x - x.sum(0)) ** 2).sum(1)
    got = {r.vec_id: r.deviation for r in whitening.whiten(vectors(spark, rows)).collect()}
    assert got == {i: (int(v) if v < 2 ** 63 else None) for i, v in enumerate(exact)}


class Counted(dict):
    """A table of words that counts how often it is asked."""
    asked = 0

    def get(self, k, *default):
        self.asked += 1
        return super().get(k, *default)

    def __getitem__(self, k):
        self.asked += 1
        return super().__getitem__(k)

    def __contains__(self, k):
        self.asked += 1
        return super().__contains__(k)


def test_words_are_looked_up_once_beside_new_words(monkeypatch):
    """A text with a new word costs one look a word, also when the table is full."""
    from pathwise.llm import packing

    monkeypatch.setattr(packing, "CACHED_WORDS", 0)
    enc = packing.WordEncoder(packing.default_tokenizer_path())
    old = [f"word{i}" for i in range(300)]
    enc.words = Counted(enc.encode(set(old)))
    text = " ".join([*old, "unheardof", *old])
    got = enc(text)
    assert enc.words.asked <= 601 + 10
    assert np.frombuffer(got, "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_cut_together_have_the_tokenizers_ids():
    """Marks at a word's start, sigma, dotted i, separators, quotes, digits, other scripts."""
    from pathwise.llm import packing

    enc = packing.WordEncoder(packing.default_tokenizer_path())
    texts = ["́accent été ́", "ΟΔΟΣ ΣΣ İstanbul İ", "a\x1cb \x1d \x1e\x1f c",
             "It's we'll 'RE don’t “quoted” 12.5€ x2 ªº µm Ⱥẞ Straße",
             "日本語 русский \U0001f600\U0001f600! K ΅", "one\ntwo\r\n\nthree\t\x85four\xa0five",
             "", " ", "\n"]
    for text in [*texts, " ".join(texts)]:
        want = enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc(text), "<u4").tolist() == want, text
        assert np.frombuffer(enc(text), "<u4").tolist() == want, text
