"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

Encoding.  A sequence of tokens is what the merges make of its bytes just if
every two neighbours are what the merges make of those two alone.  So every
prefix of a piece has one last token, which depends on the last token where
that one begins.  The nondeterministic transducer guesses where tokens begin;
its threads are a token begun (a node of the vocabulary's trie) and the token
before it.  A deterministic state is the set of threads that can go on; a move
puts out the last token of the bytes read.  Tokens that end before all open
threads begin are settled: lookahead is bounded by the longest token.  States
and moves are made when first met and kept in the worker, up to a fixed
number; then the table is begun anew, which changes no result.

Decoding.  An incremental state machine over UTF-8: its state is the character
left unfinished, each run of ids gives the characters that became whole.

Both are maps over rows: no shuffle, nothing grows with the corpus but rows.
"""

from __future__ import annotations

import base64
import gc
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwise.llm.common import bounded_batches, kept_in_worker, slices

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Kept in a worker at most: states of the transducer, pieces with their ids
#: (in each generation), pairs of neighbours.  Beyond, a table is begun anew.
MAX_STATES, MAX_PIECES, MAX_PAIRS = 200_000, 300_000, 1_000_000
#: Bytes of one piece after which its settled tokens are put out.
STRETCH = 8192
#: Ids decoded at a time.
RUN = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """Bytes of each token and its rank, from lines of base64 and number."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


def merge_by_rank(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The definition: join the neighbours of lowest rank, the first of equal
    ones, until no two neighbours make a token."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == len(ranks):
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Bytes of one piece to token ids."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {r: t for t, r in ranks.items()}
        # trie of the tokens: moves of each node, the token that ends there
        self.child: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                after = self.child[node].get(b)
                if after is None:
                    after = self.child[node][b] = len(self.ends)
                    self.child.append({})
                    self.ends.append(-1)
                node = after
            self.ends[node] = rank
        self.longest = max(map(len, ranks))
        self.fit: dict[int, bool] = {}
        self.edges: dict[int, tuple | None] = {}
        self._clear()

    def _clear(self) -> None:
        """A state: the threads that can go on, each the trie node of a token
        begun and the token before it.  A move: the next state, and the last
        token of the bytes read so far."""
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: dict[int, tuple[int, int]] = {}  # by state and byte
        self.start = self._state(((0, -1),))

    def _state(self, state: tuple) -> int:
        n = self.number.get(state)
        if n is None:
            n = self.number[state] = len(self.states)
            self.states.append(state)
        return n

    def _edges(self, token: int) -> tuple | None:
        """What stands at the token's left and right edge while its bytes are
        merged, each with the rank that ends it; None if the merges don't make
        the token of its bytes, or not in the order of ranks."""
        if token in self.edges:
            return self.edges[token]
        data, ranks = self.bytes_of[token], self.ranks
        parts = [data[i:i + 1] for i in range(len(data))]
        left, right, done = [parts[0]], [parts[-1]], -1
        left_ends, right_ends = [], []
        while len(parts) > 1:
            rank, i = min((ranks.get(a + b, len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == len(ranks) or rank < done:
                self.edges[token] = None
                return None
            done = rank
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            if i == 0:
                left.append(parts[0])
                left_ends.append(rank)
            if i == len(parts) - 1:
                right.append(parts[-1])
                right_ends.append(rank)
        never = len(ranks)
        out = self.edges[token] = (list(zip(left, [*left_ends, never])), list(zip(right, [*right_ends, never])))
        return out

    def _fits(self, a: int, b: int) -> bool:
        """Do the merges leave the neighbours ``a`` and ``b`` as they are?  With
        a = -1: do they make ``b`` of its own bytes?  Two edges are neighbours
        until the first of them is merged into more; they join if their own
        rank comes before that (of equal ranks the left pair goes first)."""
        key = a << 32 | b
        ok = self.fit.get(key)
        if ok is not None:
            return ok
        if len(self.fit) >= MAX_PAIRS:
            self.fit.clear()
        right = self._edges(b)
        left = self._edges(a) if a >= 0 else None
        if a < 0 or left is None or right is None:
            data = (self.bytes_of[a] if a >= 0 else b"") + self.bytes_of[b]
            ok = right is not None if a < 0 and right else merge_by_rank(data, self.ranks) == ([a, b] if a >= 0 else [b])
            ok = ok and (a < 0 or self._fits(-1, b))
        else:
            xs, ys, never, find = iter(left[1]), iter(right[0]), len(self.ranks), self.ranks.get
            (x, x_ends), (y, y_ends) = next(xs), next(ys)
            while True:
                rank = find(x + y, never)
                if rank < x_ends and rank <= y_ends:
                    ok = False
                    break
                if x_ends <= y_ends:
                    if x_ends == never:
                        ok = True
                        break
                    x, x_ends = next(xs)
                else:
                    y, y_ends = next(ys)
        self.fit[key] = ok
        return ok

    def _move(self, n: int, byte: int) -> tuple[int, int]:
        child, ends, fit = self.child, self.ends, self.fit
        going, here = [], -1
        for node, last in self.states[n]:
            after = child[node].get(byte)
            if after is None:
                continue
            if child[after]:
                going.append((after, last))
            token = ends[after]
            if here < 0 and token >= 0:
                ok = fit.get(last << 32 | token)
                if self._fits(last, token) if ok is None else ok:
                    here = token
        going.append((0, here))
        return self._state(tuple(going)), here

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of a piece.  A piece that is a token is that token.

        A token is settled as soon as no thread that goes on began before its
        end; the settled ones are read off backwards, from the end of the
        piece (or of ``STRETCH`` bytes of a longer one).
        """
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        lasts: list[int] = []  # of each byte since the last settled token: the last token there
        out: list[int] = []
        n, moves = self.start, self.moves
        for byte in piece:
            key = n << 8 | byte
            move = moves.get(key)
            if move is None:
                if len(self.states) >= self.max_states:
                    state = self.states[n]
                    self._clear()
                    n, moves = self._state(state), self.moves
                    key = n << 8 | byte
                move = moves[key] = self._move(n, byte)
            n, last = move
            lasts.append(last)
            if len(lasts) >= STRETCH:
                out += self._settled(lasts, self.longest)
        return (*out, *self._settled(lasts, 0))

    def _settled(self, lasts: list[int], open_bytes: int) -> list[int]:
        """Takes from ``lasts`` the tokens that all tokenizations of a prefix
        that ends in its ``open_bytes`` last bytes begin with."""
        ends = set(range(len(lasts) - open_bytes, len(lasts) + 1))
        while len(ends) > 1:  # the furthest end goes back by its last token, until all have met
            end = max(ends)
            ends.remove(end)
            ends.add(end - len(self.bytes_of[lasts[end - 1]]))
        met = end = ends.pop()
        path: list[int] = []
        while end:
            path.append(lasts[end - 1])
            end -= len(self.bytes_of[path[-1]])
        del lasts[:met]
        return path[::-1]


# ---- pieces -------------------------------------------------------------------
_CLASSES = (r"\p{L}", r"\p{N}")


class Splitter:
    """Matches of the pattern, with the letters and numbers of the tokenizer
    library's Unicode version.  Texts that hold a character on which the two
    regular expression libraries differ (few) take ranges written out."""

    def __init__(self, pattern: str):
        self.usual = regex.compile(pattern)
        single = {bytes([i]): i for i in range(256)}
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
        exact, self.differ = pattern, set()
        for name in _CLASSES:
            library = tiktoken.Encoding("class", pat_str=f"{name}+", mergeable_ranks=single, special_tokens={})
            theirs = bytes(library.encode_ordinary(every)).decode("utf-8")
            self.differ |= set(theirs) ^ set("".join(regex.findall(f"{name}+", every)))
            runs: list[list[int]] = []
            for c in sorted(map(ord, theirs)):
                if runs and runs[-1][1] == c - 1:
                    runs[-1][1] = c
                else:
                    runs.append([c, c])
            exact = exact.replace(name, "[" + "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in runs) + "]")
        self.exact = regex.compile(exact, regex.V1)

    def pieces(self, text: str) -> list[str]:
        if text.isascii() or self.differ.isdisjoint(text):
            return self.usual.findall(text)
        return self.exact.findall(text)


class Encoder(dict):
    """Piece to ids (as the bytes of 32-bit integers), by the transducer;
    pieces met of late are kept, in two generations: when the young one is
    full, it takes the old one's place."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.transducer = Transducer(read_ranks(path))
        self.splitter = Splitter(pattern)
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("i", self.transducer.encode(piece.encode("utf-8"))).tobytes()
        if len(piece) <= 64:
            if len(self) >= MAX_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, self.splitter.pieces(text))), np.int32)


# ---- decoding -----------------------------------------------------------------
def _utf8_moves() -> list[list[int]]:
    """State and byte to state.  0: between characters; 1 to 3: so many
    continuation bytes to come; 4 to 7: the first of them is restricted (after
    E0, ED, F0, F4); -1: the byte cannot stand here."""
    rules = {0: [(0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2),
                 (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7)],
             1: [(0x80, 0xBF, 0)], 2: [(0x80, 0xBF, 1)], 3: [(0x80, 0xBF, 2)], 4: [(0xA0, 0xBF, 1)],
             5: [(0x80, 0x9F, 1)], 6: [(0x90, 0xBF, 2)], 7: [(0x80, 0x8F, 2)]}
    table = [[-1] * 256 for _ in rules]
    for state, spans in rules.items():
        for lo, hi, to in spans:
            table[state][lo:hi + 1] = [to] * (hi - lo + 1)
    return table


class Utf8Stream:
    """Incremental decoder: bytes in any cut, whole characters out.  A broken
    sequence gives U+FFFD once for as much of it as was well-formed.

    Bytes that begin between two characters and end between two (or within
    one that can still go on) are handed over at once; only a stretch with a
    broken sequence is walked through byte by byte.
    """

    TABLE = _utf8_moves()

    def __init__(self):
        self.state, self.held = 0, b""

    def _tail(self, data: bytes) -> tuple[int, int]:
        """Where the unfinished character at the end begins, and its state."""
        for begin in range(len(data) - 1, max(-1, len(data) - 4), -1):
            if data[begin] & 0xC0 != 0x80:
                state = 0
                for byte in data[begin:]:
                    state = self.TABLE[state][byte]
                    if state <= 0:
                        return len(data), 0
                return begin, state
        return len(data), 0

    def feed(self, data: bytes) -> str:
        whole = self.held + data
        begin, state = self._tail(whole)
        try:
            text = whole[:begin].decode("utf-8")
        except UnicodeDecodeError:
            return self._walk(data)
        self.state, self.held = state, whole[begin:]
        return text

    def _walk(self, data: bytes) -> str:
        out: list[str] = []
        state, held = self.state, bytearray(self.held)
        for byte in data:
            to = self.TABLE[state][byte]
            if to < 0:
                if state:
                    out.append("\ufffd")
                    held.clear()
                    to = self.TABLE[0][byte]
                if to < 0:
                    out.append("\ufffd")
                    state = 0
                    continue
            held.append(byte)
            state = to
            if not state:
                out.append(held.decode("utf-8"))
                held.clear()
        self.state, self.held = state, bytes(held)
        return "".join(out)

    def end(self) -> str:
        """What is left at the end of the input."""
        rest, self.state, self.held = ("\ufffd" if self.state else ""), 0, b""
        return rest


class Decoder:
    """Ids to text, ``RUN`` ids at a time through the incremental decoder."""

    def __init__(self, path: str):
        tokens = {r: t for t, r in read_ranks(path).items()}
        self.lengths = np.zeros(max(tokens) + 2, np.int64)  # the last: no such id
        for i, data in tokens.items():
            self.lengths[i] = len(data)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)

    def _bytes(self, ids: np.ndarray) -> bytes:
        last = len(self.lengths) - 1
        ids = np.where((ids < 0) | (ids > last), last, ids)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ids) else 0) + np.repeat(self.starts[ids] - ends + lengths, lengths)
        return self.bytes[at].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        stream = Utf8Stream()
        out = [stream.feed(self._bytes(ids[i:i + RUN])) for i in range(0, len(ids), RUN)]
        return "".join([*out, stream.end()])


# ---- on DataFrames --------------------------------------------------------------
def encode_documents(df: DataFrame, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, tokens (array of int) for every row of ``df``: the whole text,
    each match of ``pattern`` by itself, by the ranks in ``path`` (a file every
    machine has), without special tokens.

    Null and empty texts have no tokens.  Null and repeated ids are kept, row
    for row; other columns are ignored, whatever their names.
    """
    bounded_batches(df.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("tokens", pa.list_(pa.int32()))])

    def run(batches):
        gc.disable()  # tables of many small tuples, no cycles
        encoder = kept_in_worker(f"byte-bpe-{path}-{pattern}", lambda: Encoder(path, pattern))
        for ids, texts in slices(batches):
            tokens = [encoder.encode(text) for text in texts]
            ends = np.cumsum([0, *map(len, tokens)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(tokens)))],
                schema=schema)
        gc.enable()

    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id bigint, tokens array<int>")


def decode_tokens(df: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, tokens, text for every row of ``df`` (doc_id, tokens).

    Bytes that are no UTF-8 become U+FFFD; ids without bytes and null ids
    inside add nothing; a null list counts as empty.
    """
    def run(batches):
        decoder = kept_in_worker(f"byte-bpe-text-{path}", lambda: Decoder(path))
        for b in batches:
            lists = b.column(1).fill_null([])
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            ends = np.cumsum([0, *lists.value_lengths().to_pylist()])
            texts = [decoder.decode(flat[lo:hi]) for lo, hi in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             schema=pa.schema([*b.schema, ("text", pa.string())]))

    return (df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("tokens").cast("array<int>").alias("tokens"))
            .mapInArrow(run, "doc_id bigint, tokens array<int>, text string"))


def token_digests(df: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every row of ``df`` encoded,
    and the ids decoded again."""
    rows = decode_tokens(encode_documents(df, path), path)
    return rows.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("tokens").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))
