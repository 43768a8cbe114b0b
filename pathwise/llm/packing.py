"""Harmonic packing of tokenised documents into fixed-length sequences.

A document's tokens are cut into full sequences and a rest; the rest is cut
at 1/2, 1/4, ... of the capacity down to a small tail.  A piece of length L
belongs to the reciprocal class k = capacity // L, and every sequence of that
class takes exactly k pieces.  Each task fills its own sequences in one pass
over its documents: no shuffle, no state beyond one open sequence per class.
What is open at the end of a task is filled up in order of falling length; the
last one is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwise.llm.common import bounded_batches, kept_in_worker, slices, to_batch

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Words kept with their ids per Python worker, and further pieces of words; those
#: beyond are encoded each time.
CACHED_WORDS, CACHED_PIECES = 600_000, 150_000
#: A long text is encoded in parts of about so many characters, cut at white space.
PART_CHARS = 500_000

#: White space of the tokenizer's own pattern; ``str.split`` also splits at these four.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = regex.compile(f"[{WHITE}]+")
NOT_SPACE = regex.compile("[\x1c-\x1f]")
# Fixed value, from the tokenizer file: what it encodes by itself, after NFC and lower case.
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+"
LINES = regex.compile(rf"{PIECES}|\n")
#: Other than Latin letters, punctuation and currency signs: what stands for itself once it was
#: normalised and lower-cased, in any Unicode version.
OTHER = regex.compile("[^\0-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")


def default_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


class WordEncoder:
    """Ids of a text as little-endian 32-bit integers.

    The tokenizer drops white space and encodes each piece of a word by
    itself; its added tokens are cut out first.  So the ids of words seen before are kept, and the new pieces of a
    text are encoded together, one space apart: a piece ends with the id whose
    token has the end-of-word mark.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # the same model for pieces that are normalised and cut already
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # tokens of the file that stand for themselves in any text, found before all else
        self.added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        if any(t.normalized or t.single_word for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("the tokenizer does not take its added tokens from the plain text")
        longest = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile(f"({'|'.join(map(regex.escape, longest))})") if longest else None
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def parts(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > PART_CHARS:
            m = SPACE.search(text, at + PART_CHARS)
            if not m:
                break
            yield text[at:m.start()]
            at = m.start()
        yield text[at:] if at else text

    def __call__(self, text: str) -> bytes:
        return b"".join([self.cut(p) for p in self.parts(text)])

    def cut(self, text: str) -> bytes:
        """Ids of a part: those of its added tokens and of what lies between them."""
        if not self.special or not self.special.search(text):
            return self.part(text)
        return b"".join([self.added[t].to_bytes(4, "little") if i % 2 else self.part(t)
                         for i, t in enumerate(self.special.split(text))])

    def part(self, text: str) -> bytes:
        found = SPACE.split(text) if NOT_SPACE.search(text) else text.split()
        # every word is looked up once, whether or not the table has all of them
        known = self.words
        out = list(map(known.get, found))
        if None in out:
            gaps = [i for i, ids in enumerate(out) if ids is None]
            own = self.encode({found[i] for i in gaps})
            if len(known) < CACHED_WORDS:
                known.update(own)
            for i in gaps:
                out[i] = own[found[i]]
        return b"".join(out)

    def encode(self, new: set[str]) -> dict[str, bytes]:
        # cut together, one line each; no word holds a line feed, and nothing composes with one
        lines = "\n".join(new)
        if not lines.isascii():
            # char by char, as the tokenizer does: no final-sigma rule
            lines = unicodedata.normalize("NFC", lines).replace("\u03a3", "\u03c3")
        cut: dict[str, list[str]] = {}
        each, own_pieces = iter(new), []
        for p in [*LINES.findall(lines.lower()), "\n"]:
            if p == "\n":
                cut[next(each)] = own_pieces
                own_pieces = []
            else:
                own_pieces.append(p)
        # a piece that was met as a word has that word's ids: it is cut no further
        known, words = self.pieces, self.words
        missing = list({p for ps in cut.values() for p in ps if p not in words and p not in known})
        own: dict[str, bytes] = {}
        if missing:
            spaced = " ".join(missing)
            by = self.tokenizer if OTHER.search(spaced) else self.plain
            ids = np.asarray(by.encode_batch_fast([spaced], add_special_tokens=False)[0].ids, "<u4")
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) != len(missing) or last[-1] != len(ids):
                raise ValueError("the tokenizer does not mark the ends of words")
            raw = ids.tobytes()
            cuts = [0, *(4 * last).tolist()]
            own = {p: raw[a:b] for p, a, b in zip(missing, cuts, cuts[1:])}
            if len(known) < CACHED_PIECES:
                known.update((p, i) for p, i in own.items() if p not in cut)
        return {w: b"".join([own[p] if p in own else words[p] if p in words else known[p] for p in ps])
                for w, ps in cut.items()}


def encoder(path: str | None) -> WordEncoder:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
    path = path or default_tokenizer_path()
    return kept_in_worker(f"encoder-{path}", lambda: WordEncoder(path))


class HarmonicPacker:
    """Fills one task's sequences.  ``add`` and ``finish`` return finished
    sequences as lists of (doc_id, start, doc_tokens, ids)."""

    def __init__(self, capacity: int = 2048, least_cut: int = 64):
        self.capacity = capacity
        cuts, size = [], capacity // 2
        while size >= least_cut:
            cuts.append(size)
            size //= 2
        self.cuts = cuts
        self.open: dict[int, list[tuple]] = {}

    def pieces(self, n: int) -> Iterator[tuple[int, int]]:
        """(start, length) of a document of ``n`` tokens."""
        at = 0
        while n - at >= self.capacity:
            yield at, self.capacity
            at += self.capacity
        for size in self.cuts:
            if n - at >= size:
                yield at, size
                at += size
        if n > at:
            yield at, n - at

    def add(self, doc_id, ids: bytes) -> Iterator[list[tuple]]:
        n = len(ids) // 4
        for start, length in self.pieces(n):
            k = self.capacity // length
            filling = self.open.setdefault(k, [])
            filling.append((doc_id, start, n, ids[4 * start:4 * (start + length)]))
            if len(filling) == k:
                yield self.open.pop(k)

    def finish(self) -> Iterator[list[tuple]]:
        rest = sorted((p for f in self.open.values() for p in f), key=lambda p: -len(p[3]))
        self.open = {}
        left = sum(len(p[3]) for p in rest) // 4
        sizes = [self.capacity] * (left // self.capacity)
        left %= self.capacity
        sizes += [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
        it, piece = iter(rest), None
        for size in sizes:
            out, room = [], size
            while room:
                if piece is None:
                    piece = next(it)
                doc_id, start, n, ids = piece
                take = min(room, len(ids) // 4)
                out.append((doc_id, start, n, ids[:4 * take]))
                room -= take
                piece = (doc_id, start + take, n, ids[4 * take:]) if 4 * take < len(ids) else None
            yield out


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   tokenizer_path: str | None = None, end_id: int = END_ID,
                   capacity: int = 2048, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, unless ``with_ids`` is false, ids.

    A document's tokens are its text's ids and then ``end_id``.  Null and
    empty texts give one token; rows that repeat an id are packed each; a null
    id stays null.  ``tokenizer_path`` must be readable on every executor
    (default: the installed file).  Other columns of ``df`` are ignored.
    """
    bounded_batches(df.sparkSession)
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
              ("offset", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    def run(batches):
        encode, packer = encoder(tokenizer_path), HarmonicPacker(capacity)
        end = end_id.to_bytes(4, "little")
        sequence = TaskContext.get().partitionId() << 40
        out: dict[str, list] = {f.name: [] for f in schema}

        def put(filled):
            nonlocal sequence
            for seq in filled:
                at = 0
                for doc_id, start, n, ids in seq:
                    length = len(ids) // 4
                    row = [doc_id, start, length, zlib.crc32(ids), n, sequence, at]
                    if with_ids:
                        row.append(np.frombuffer(ids, "<u4").astype(np.int32))
                    for values, v in zip(out.values(), row):
                        values.append(v)
                    at += length
                sequence += 1

        for ids, texts in slices(batches):
            for doc_id, text in zip(ids, texts):
                put(packer.add(doc_id, encode(text) + end))
                if len(out["doc_id"]) >= (2_000 if with_ids else 50_000):
                    yield to_batch(out, schema)
                    for v in out.values():
                        v.clear()
        put(packer.finish())
        yield to_batch(out, schema)

    kinds = {pa.int64(): "bigint", pa.list_(pa.int32()): "array<int>"}
    ddl = ", ".join(f"`{f.name}` {kinds[f.type]}" for f in schema)
    return (df.select(F.col(id_col).cast("bigint").alias("doc_id"),
                      F.col(text_col).cast("string").alias("text")).mapInArrow(run, ddl))
