"""Secret scan: keyword automaton, anchored patterns near hits, checksums.

One Aho-Corasick pass over the lower-cased bytes finds where a keyword of any
kind starts; only there is that kind's pattern tried, anchored.  Hexadecimal
runs have no keyword: their start is found by one vectorised pass over the
bytes.  Kinds that embed a checksum are reported only if it holds.  A map over
whole texts: no shuffle.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwise.llm.common import bounded_batches, slices, to_batch

ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    rb"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
HUB_TOKEN = re.compile(rb"(?:gh[opsur]|npm)_[A-Za-z0-9]+")
CARD = re.compile(rb"[0-9](?:[ -]?[0-9]){12,18}(?![0-9])")

#: Order in which kinds are listed at equal starts; the first three are the base kinds.
KINDS = ["assign", "access", "hex", "hub_token", "card"]
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign",
            "apikey": "assign", "api_key": "assign", "akia": "access", "gho_": "hub_token",
            "ghp_": "hub_token", "ghs_": "hub_token", "ghu_": "hub_token", "ghr_": "hub_token",
            "npm_": "hub_token"}
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32
DIGITS62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


@lru_cache
def _automaton():
    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def hub_token_holds(token: bytes) -> bool:
    """Prefix, 30 random base-62 digits, then their CRC-32 as six."""
    body = token.split(b"_", 1)[1]
    if len(body) != 36:
        return False
    n = 0
    for c in body[30:]:
        n = n * 62 + DIGITS62.index(c)
    return n == zlib.crc32(body[:30])


def luhn_holds(number: bytes) -> bool:
    digits = [c - 48 for c in number if 48 <= c <= 57]
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0 and digits[0] in (3, 4, 5, 6)


_IS_HEX = np.zeros(256, bool)
_IS_HEX[list(b"0123456789abcdef")] = True
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[list(b"0123456789")] = True
_IN_CARD = _IS_DIGIT.copy()
_IN_CARD[list(b" -")] = True


def _runs(member: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of true values of at least ``least``."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], member.view(np.int8), [0]))))
    starts, ends = edge[::2], edge[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist()))


def find_secrets(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind; offsets in code points, end exclusive."""
    b = text.encode("utf-8", "surrogatepass")
    spans: list[tuple[int, int, str]] = []
    past = {"assign": 0, "access": 0, "hub_token": 0}
    # latin-1 gives one character per byte, so offsets stay byte offsets
    for last, (size, kind) in _automaton().iter(b.lower().decode("latin-1")):
        at = last - size + 1
        if at < past[kind]:
            continue
        if kind == "assign":
            m = ASSIGN.match(b, at)
            ok = bool(m) and m.end(2) - m.start(2) >= MIN_VALUE
        elif kind == "access":
            m = ACCESS.match(b, at)
            ok = bool(m) and m.end() - at >= MIN_ACCESS
        else:
            m = HUB_TOKEN.match(b, at)
            ok = bool(m) and hub_token_holds(m[0])
        if m:
            past[kind] = m.end()  # a failing match is passed over too
            if ok:
                spans.append((at, m.end(), kind))
    raw = np.frombuffer(b, np.uint8)
    spans += [(s, e, "hex") for s, e in _runs(_IS_HEX[raw], MIN_HEX)]
    if np.count_nonzero(_IS_DIGIT[raw]) >= 13:
        for s, e in _runs(_IN_CARD[raw], 13):
            while s < e:
                m = CARD.search(b, s, e)
                if not m:
                    break
                if luhn_holds(m[0]) and (m.start() == 0 or not _IS_DIGIT[raw[m.start() - 1]]):
                    spans.append((m.start(), m.end(), "card"))
                s = m.end()
    order = {k: i for i, k in enumerate(KINDS)}
    spans.sort(key=lambda x: (x[0], order[x[2]], x[1]))
    if len(b) == len(text):
        return spans
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return [(int(points[s]), int(points[e]), k) for s, e, k in spans]


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id and spans, an array of
    (start, end, kind) in code points, ordered by start and kind.

    Kinds: assign, access and hex (the base patterns), hub_token (CRC-32 in
    the last six digits) and card (Luhn digit).  Null text counts as empty and
    has no spans; rows that repeat an id are scanned each; other columns are
    ignored.
    """
    bounded_batches(df.sparkSession)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])

    def run(batches):
        for ids, texts in slices(batches):
            yield to_batch({"doc_id": ids, "spans": [
                [{"start": s, "end": e, "kind": k} for s, e, k in find_secrets(t)] for t in texts]},
                schema)

    return df.select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, spans array<struct<start:bigint,end:bigint,kind:string>>")


def secret_digest(spans: DataFrame) -> DataFrame:
    """The contract's columns from ``scan_secrets``."""
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def joined(c):
        return F.array_join(F.transform(c, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return spans.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
