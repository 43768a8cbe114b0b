"""Benchmark decontamination by SimHash windows and exact verification.

Every window of a document that is as long as a benchmark item gets a 64-bit
SimHash of its weighted word shingles.  A multi-index over four 16-bit blocks
finds every item within the radius (16 differing bits leave at most 4 in one
block), and each candidate is verified by its exact similarity: the larger of
the weighted and the plain one.  Items that share shingles with others have a
second, unweighted fingerprint, as near copies of them have foreign words of
more weight than theirs.

Before hashing, windows that cannot reach the similarity are skipped: with
more than a fifth of their shingles foreign to the benchmark they stay below
0.8, and a word pair that no item has makes its shingles foreign.  That needs
a bit table and running sums only.

A map over whole texts; the benchmark goes to the tasks in blocks of bounded
size, so neither side's growth makes a broadcast grow.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwise.llm.common import (bounded_batches, kept_in_worker, mix, shingle_hashes, slices, to_batch, unused,
                                 word_hashes, words)

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 16
#: Bound of what one block sends to the tasks.
ITEMS_PER_BLOCK, CHARS_PER_BLOCK = 1_000, 8_000_000
_PAIR_BITS = 22
#: Shingles whose windows are compared together: bounds a task's memory.
SHINGLES_AT_ONCE, QUERIES_AT_ONCE = 40_000, 8_192
_POPCOUNT = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def _unknown_allowed(w: int) -> float:
    """Foreign word pairs a window of w words may have: a fifth of its
    shingles may be foreign, and b foreign pairs make b - (SHINGLE - 2)."""
    return (1 - SIMILARITY) * (w - SHINGLE + 1) + SHINGLE - 2


def pair_hashes(h: np.ndarray) -> np.ndarray:
    return mix(mix(h[:-1]) + h[1:])


def bit_sums(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Running sums, one row more than hashes, of each hash bit's weighted sign."""
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(hashes) + 1, 64))
    np.cumsum((bits * 2.0 - 1.0) * weights[:, None], axis=0, out=out[1:])
    return out


def prints_of(sums: np.ndarray) -> np.ndarray:
    """64-bit fingerprints: the sign of each bit's sum."""
    return np.packbits(sums > 1e-9, axis=-1, bitorder="little").view(np.uint64)[..., 0]


class BlockIndex:
    """Fingerprints of a block of items; ``near`` gives the items within the radius."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        parts = prints.view(np.uint16).reshape(-1, 4)
        values = np.arange(1 << 16, dtype=np.uint16)
        self.tables = []
        for block in range(4):
            held, counts = [], []
            for lo in range(0, len(values), 4096):  # bounded memory
                close = _POPCOUNT[values[lo:lo + 4096, None] ^ parts[None, :, block]] <= RADIUS // 4
                counts.append(close.sum(axis=1))
                held.append(np.nonzero(close)[1].astype(np.int32))
            self.tables.append((np.concatenate(([0], np.cumsum(np.concatenate(counts)))), np.concatenate(held)))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, item) index pairs with at most RADIUS differing bits."""
        parts = prints.view(np.uint16).reshape(-1, 4)
        found = []
        for block, (starts, held) in enumerate(self.tables):
            lo, hi = starts[parts[:, block]], starts[parts[:, block].astype(np.int64) + 1]
            n = hi - lo
            q = np.repeat(np.arange(len(prints)), n)
            items = held[np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
            apart = (prints[q] ^ self.prints[items]).view(np.uint16).reshape(-1, 4)
            close = _POPCOUNT[apart].sum(axis=1) <= RADIUS
            found.append(q[close] * len(self.prints) + items[close])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.prints), pairs % len(self.prints)


class Benchmark:
    """One block of items.  ``frequency``: distinct items that hold a shingle, if over one."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[int, int]):
        self.key = uuid.uuid4().hex
        self.ids, self.shingles, self.weights = [], [], []
        pairs, sizes = [np.empty(0, np.uint64)], []
        for item_id, text in items:
            h = word_hashes(words(text, lower=True))
            if len(h) < SHINGLE:
                continue
            s = shingle_hashes(h, SHINGLE)
            self.ids.append(item_id)
            self.shingles.append(Counter(s.tolist()))
            self.weights.append({x: 1.0 / frequency.get(x, 1) for x in self.shingles[-1]})
            pairs.append(pair_hashes(h))
            sizes.append((len(h), s))
        known = {x: w for ws in self.weights for x, w in ws.items()}
        self.known = np.array(sorted(known), np.uint64)
        self.known_weights = np.array([known[int(x)] for x in self.known], np.float32)
        self.pairs = np.zeros(1 << _PAIR_BITS, bool)
        self.pairs[(np.concatenate(pairs) >> np.uint64(64 - _PAIR_BITS)).astype(np.int64)] = True
        self.by_size: dict[int, list[int]] = {}
        prints = []
        for i, (size, s) in enumerate(sizes):
            self.by_size.setdefault(size, []).append(i)
            prints.append(prints_of(bit_sums(s, self.weight(s))[-1:])[0])
        self.prints = np.array(prints, np.uint64)
        self.least = min(self.by_size, default=0)
        # a window of any size holds a least-sized one with at most so many foreign pairs
        self.least_allowed = max((math.floor(_unknown_allowed(w) / (w // self.least)) for w in self.by_size),
                                 default=0)
        self.sizes = np.array([size for size, _ in sizes], np.int64)
        # items with shared shingles, and their unweighted fingerprints
        self.plain = np.array([i for i, ws in enumerate(self.weights) if min(ws.values()) < 1], np.int64)
        self.plain_prints = np.array([prints_of(bit_sums(sizes[i][1], np.ones(len(sizes[i][1])))[-1:])[0]
                                      for i in self.plain], np.uint64)
        self.plain_sizes = np.unique(self.sizes[self.plain])
        self.index: tuple[BlockIndex, BlockIndex | None] | None = None

    def weight(self, s: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, s), len(self.known) - 1)
        return np.where(self.known[at] == s, self.known_weights[at], np.float32(1))

    def similarity(self, window: list[int], item: int) -> float:
        """Jaccard of shingle multisets, the larger of two: plain, and with the
        weight 1 / (distinct items that hold it) for the item's shingles, 1 for others."""
        mine, own, weigh = Counter(window), self.shingles[item], self.weights[item]
        common = {x: min(c, mine[x]) for x, c in own.items() if x in mine}
        n = sum(common.values())
        both = sum(weigh[x] * c for x, c in common.items())
        every = sum(weigh[x] * max(c, mine.get(x, 0)) for x, c in own.items())
        every += sum(c for x, c in mine.items() if x not in own)
        return max(both / every, n / (len(window) + sum(own.values()) - n))

    def windows(self, h: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(window words, starts) of the windows that can reach the similarity."""
        n = len(h)
        if not self.by_size or n < SHINGLE:
            return []
        foreign = ~self.pairs[(pair_hashes(h) >> np.uint64(64 - _PAIR_BITS)).astype(np.int64)]
        total = np.concatenate(([0], np.cumsum(foreign)))
        if n >= self.least and (total[self.least - 1:] - total[:n - self.least + 1]).min() > self.least_allowed:
            return []
        out = []
        for size in self.by_size:
            w = min(size, n)  # a shorter text is one window
            starts = np.flatnonzero(total[w - 1:] - total[:n - w + 1] <= _unknown_allowed(size))
            if len(starts):
                out.append((size, starts))
        return out

    def matches(self, texts: list[str]) -> dict[tuple[int, int], tuple[float, int, int]]:
        """(text, item) indexes -> best (similarity, first word, words)."""
        found: dict[tuple[int, int], tuple[float, int, int]] = {}
        parts, held = [], 0
        for t, text in enumerate(texts):
            h = word_hashes(words(text, lower=True))
            spots = self.windows(h)
            if not spots:
                continue
            s = shingle_hashes(h, SHINGLE)
            for lo in range(0, len(s), SHINGLES_AT_ONCE):  # a long text in parts
                near = [(size, min(size, len(h)), starts[(starts >= lo) & (starts < lo + SHINGLES_AT_ONCE)] - lo)
                        for size, starts in spots]
                parts.append((t, lo, s[lo:lo + SHINGLES_AT_ONCE + max(self.by_size)], near))
                held += len(parts[-1][2])
                if held >= SHINGLES_AT_ONCE:
                    self._compare(parts, found)
                    parts, held = [], 0
        if parts:
            self._compare(parts, found)
        return found

    def _compare(self, parts: list[tuple], found: dict[tuple[int, int], tuple[float, int, int]]) -> None:
        s = np.concatenate([p[2] for p in parts])
        sums = bit_sums(s, self.weight(s))
        plain_sums = bit_sums(s, np.ones(len(s))) if len(self.plain) else None
        if self.index is None:
            self.index = BlockIndex(self.prints), BlockIndex(self.plain_prints) if len(self.plain) else None
        base, spots = 0, []
        for t, lo, own, near in parts:
            spots += [(t, lo - base, size, w, base + starts) for size, w, starts in near if len(starts)]
            base += len(own)
        if not spots:
            return
        lengths = [len(at) for *_, at in spots]
        text, shift, sizes, w = (np.repeat([spot[i] for spot in spots], lengths) for i in range(4))
        at = np.concatenate([at for *_, at in spots])
        n = w - SHINGLE + 1
        for lo in range(0, len(at), QUERIES_AT_ONCE):
            part = slice(lo, lo + QUERIES_AT_ONCE)
            queries, items = self.index[0].near(prints_of(sums[at[part] + n[part]] - sums[at[part]]))
            if plain_sums is not None:
                spot = np.flatnonzero(np.isin(sizes[part], self.plain_sizes))
                first = at[part][spot]
                more, found_items = self.index[1].near(prints_of(plain_sums[first + n[part][spot]] - plain_sums[first]))
                pairs = np.unique(np.concatenate((queries * len(self.ids) + items,
                                                  spot[more] * len(self.ids) + self.plain[found_items])))
                queries, items = pairs // len(self.ids), pairs % len(self.ids)
            same = self.sizes[items] == sizes[part][queries]
            for q, item in zip((queries[same] + lo).tolist(), items[same].tolist()):
                value = self.similarity(s[at[q]:at[q] + n[q]].tolist(), item)
                key = (int(text[q]), item)
                if value >= SIMILARITY and (key not in found or value > found[key][0]):
                    found[key] = (value, int(at[q] + shift[q]), int(w[q]))


def _blocks(benchmark: DataFrame) -> list[Benchmark]:
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"),
                             F.col("text").cast("string").alias("text")).filter("text IS NOT NULL").distinct()
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).alias("chars")).first()
    n = max(1, -(-size["n"] // ITEMS_PER_BLOCK), -(-(size["chars"] or 0) // CHARS_PER_BLOCK))
    shingles = items.mapInArrow(_item_shingles, "said bigint, shingle bigint").distinct()
    shared = (shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    out = []
    for block in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        frequency = (own.mapInArrow(_item_shingles, "said bigint, shingle bigint").select("shingle").distinct()
                     .join(shared, "shingle").collect())
        out.append(Benchmark(sorted(((r["item_id"], r["text"]) for r in own.collect()),
                                    key=lambda x: (x[0] is None, x)),
                             {r["shingle"] & (1 << 64) - 1: r["n"] for r in frequency}))
    return out


def _item_shingles(batches):
    """said, a hash of the item's words (equal texts under several ids are one), and its shingles."""
    schema = pa.schema([("said", pa.int64()), ("shingle", pa.int64())])
    for _, texts in slices(batches):
        for text in texts:
            h = word_hashes(words(text, lower=True))
            s = np.unique(shingle_hashes(h, SHINGLE)) if len(h) >= SHINGLE else h[:0]
            said = np.full(len(s), xxhash.xxh3_64_intdigest(h.tobytes()), np.uint64)
            yield to_batch({"said": said.view(np.int64), "shingle": s.view(np.int64)}, schema)


def find_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: the best window of
    each document and benchmark item with a similarity (weighted or plain, the
    larger) of SIMILARITY or more.

    Words are runs between white space, A-Z lower-cased; windows are as long
    as the item, a shorter text is one window.  Null and
    empty texts match nothing; items under SHINGLE words are ignored, repeated
    items count once; rows that repeat an id are searched each.  Other columns
    are ignored.
    """
    return _leaks(df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")),
                  benchmark, "bigint", pa.int64())


def _leaks(docs: DataFrame, benchmark: DataFrame, ddl: str, id_type: pa.DataType) -> DataFrame:
    bounded_batches(docs.sparkSession)
    out = None
    for block in _blocks(benchmark):
        part = docs.mapInArrow(_search(block, id_type), f"doc_id {ddl}, item_id bigint, similarity double, "
                                                        "first_word bigint, n_words bigint")
        out = part if out is None else out.unionByName(part)
    return out


def _search(block: Benchmark, id_type: pa.DataType = pa.int64()):
    schema = pa.schema([("doc_id", id_type), ("item_id", pa.int64()), ("similarity", pa.float64()),
                        ("first_word", pa.int64()), ("n_words", pa.int64())])

    def run(batches):
        index = kept_in_worker(f"benchmark-{block.key}", lambda: block)  # with the tables it has built
        for ids, texts in slices(batches):
            out = {f.name: [] for f in schema}
            for (t, item), (value, start, w) in index.matches(texts).items():
                for values, v in zip(out.values(), (ids[t], index.ids[item], value, start, w)):
                    values.append(v)
            yield to_batch(out, schema)

    return run


def drop_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text matches no benchmark item.

    Whether a row leaks is a matter of its text alone: rows go by the text's
    SHA-256, so null and repeated ids take no clean row with them.  Null texts
    and an empty benchmark match nothing.
    """
    own = unused(df, "_text_sha256")
    rows = df.withColumn(own, F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))
    docs = rows.select(F.col(own).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    leaks = _leaks(docs, benchmark, "string", pa.string()).select(F.col("doc_id").alias(own)).distinct()
    return rows.join(leaks, own, "left_anti").select(*df.columns)
