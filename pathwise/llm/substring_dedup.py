"""Substring dedup by level-wise doubling.

Windows of the first length (half the wanted one) that occur in one document
only are dropped; those that repeat are extended to twice that length and
judged again.  At the first level only the smallest of any W - L + 1
neighbouring windows is looked at: a window of W words that two documents
share holds the same L-word windows in both, so the smallest of them is looked
at in both and survives.  That cuts the first level's rows by about 13 at
W = 50 and loses nothing.  Doubling ends at the wanted length: longer repeats
consist of repeated windows of that length, so they change no covered word.

Documents with the same words are one class, whose smallest id stands for it:
the others are covered whole.  So a passage or a document that fills a third
of the table costs map-side sums and narrow rows, no group in one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwise.llm.common import bounded_batches, mix, slices, stage, to_batch, window_hashes, word_hashes, words

WINDOW = 50
_SECOND_BASE = 0xA0761D6478BD642F
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _anchors(h: np.ndarray, first: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the first-level windows that are looked at."""
    g = window_hashes(h, first)
    view = np.lib.stride_tricks.sliding_window_view(g, window - first + 1)
    at = np.unique(np.concatenate([  # in parts: bounded memory for long texts
        view[i:i + 65536].argmin(axis=1) + np.arange(i, min(i + 65536, len(view)))
        for i in range(0, len(view), 65536)]))
    return at, g[at]


def _scan(docs: DataFrame, first: int, window: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("key1", pa.int64()),
                        ("key2", pa.int64()), ("kept_sha256", pa.string()),
                        ("anchors", pa.list_(pa.int64()))])

    def run(batches):
        for ids, texts in slices(batches):
            out = {f.name: [] for f in schema}
            for doc_id, text in zip(ids, texts):
                ws = words(text)
                joined = b" ".join(ws)
                key = xxhash.xxh3_128_digest(joined)
                anchors = np.empty(0, np.uint64)
                if len(ws) >= window and doc_id is not None:
                    anchors = np.unique(_anchors(word_hashes(ws), first, window)[1])
                row = (doc_id, len(ws), int.from_bytes(key[:8], "little", signed=True),
                       int.from_bytes(key[8:], "little", signed=True),
                       hashlib.sha256(joined).hexdigest(), anchors.view(np.int64))
                for values, v in zip(out.values(), row):
                    values.append(v)
            yield to_batch(out, schema)

    return docs.mapInArrow(run, "doc_id bigint, n_words bigint, key1 bigint, key2 bigint, "
                                "kept_sha256 string, anchors array<bigint>")


def _extend(rows: DataFrame, first: int, window: int) -> DataFrame:
    """Windows of twice the length around the surviving ones, and the text."""
    schema = pa.schema([("doc_id", pa.int64()), ("key1", pa.int64()), ("starts", pa.list_(pa.int32())),
                        ("h1", pa.list_(pa.int64())), ("h2", pa.list_(pa.int32())), ("z", pa.binary())])

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for ids, texts, keys, survivors in slices(batches):
            out = {f.name: [] for f in schema}
            for doc_id, text, key1, alive in zip(ids, texts, keys, survivors):
                ws = words(text)
                joined = b" ".join(ws)
                if int.from_bytes(xxhash.xxh3_128_digest(joined)[:8], "little", signed=True) != key1:
                    continue  # another row with the same id
                h = word_hashes(ws)
                at, g = _anchors(h, first, window)
                at = at[np.isin(g, np.asarray(alive, np.int64).view(np.uint64))]
                near = np.zeros(len(h) + 2, np.int32)  # starts p - (W - L) .. p of each survivor p
                np.add.at(near, np.maximum(at - (window - first), 0), 1)
                np.add.at(near, at + 1, -1)
                starts = np.flatnonzero(np.cumsum(near)[:len(h) - window + 1] > 0)
                row = (doc_id, key1, starts.astype(np.int32),
                       window_hashes(h, window)[starts].view(np.int64),
                       (window_hashes(mix(h), window, _SECOND_BASE)[starts] >> np.uint64(32))
                       .astype(np.uint32).view(np.int32), pack.compress(joined))
                for values, v in zip(out.values(), row):
                    values.append(v)
            yield to_batch(out, schema)

    return rows.mapInArrow(run, "doc_id bigint, key1 bigint, starts array<int>, h1 array<bigint>, "
                                "h2 array<int>, z binary")


def _remove(rows: DataFrame, window: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("key1", pa.int64()), ("n_removed", pa.int64()),
                        ("sha", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))])

    def run(batches):
        for ids, zs, keys, starts in slices(batches):
            out = {f.name: [] for f in schema}
            for doc_id, z, key1, at in zip(ids, zs, keys, starts):
                ws = zstandard.decompress(z).split(b" ")
                edge = np.zeros(len(ws) + 1, np.int32)
                np.add.at(edge, np.asarray(at), 1)
                np.add.at(edge, np.asarray(at) + window, -1)
                gone = np.cumsum(edge)[:-1] > 0
                cut = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                left = b" ".join([w for w, g in zip(ws, gone.tolist()) if not g])
                row = (doc_id, key1, int(gone.sum()), hashlib.sha256(left).hexdigest(),
                       cut.reshape(-1, 2).tolist())
                for values, v in zip(out.values(), row):
                    values.append(v)
            yield to_batch(out, schema)

    return rows.mapInArrow(run, "doc_id bigint, key1 bigint, n_removed bigint, sha string, "
                                "spans array<array<bigint>>")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (word ranges removed,
    end exclusive) for each row of ``df``.

    A word goes when it lies in a window of ``window`` words whose words also
    start somewhere in a document with a smaller id, judged on the input.
    Null text has no words.  A row with a null id is left alone and removes
    nothing.  Rows that repeat an id are one document for that comparison.
    Texts shorter than a window stay whole.  Other columns are ignored.
    """
    bounded_batches(df.sparkSession)
    first = max(1, window // 2)
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    scan = stage(_scan(docs, first, window), "substring-scan")
    classes = (scan.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
               .groupBy("key1", "key2").agg(F.min("doc_id").alias("first_id")))
    rows = scan.drop("anchors").join(classes, ["key1", "key2"], "left")

    heads = (scan.filter(F.size("anchors") > 0).join(classes, ["key1", "key2"])
             .filter(F.col("doc_id") == F.col("first_id")).select("doc_id", "key1", "anchors"))
    anchors = stage(heads.select("doc_id", "key1", F.explode("anchors").alias("anchor")), "substring-anchors")
    # written, so that the joins below read plain exchanges, which AQE can split at a hot key
    repeated = stage(anchors.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                     .filter("lo < hi").select("anchor"), "substring-repeated")
    alive = (anchors.join(repeated, "anchor", "left_semi").groupBy("doc_id", "key1")
             .agg(F.collect_set("anchor").alias("alive")))  # bounded by the document's length
    longer = stage(_extend(docs.join(alive, "doc_id").select("doc_id", "text", "key1", "alive"),
                           first, window), "substring-windows")

    windows = longer.select("doc_id", "key1", F.inline(F.arrays_zip("starts", "h1", "h2")))
    shared = stage(windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                   .filter("lo < hi").select("h1", "h2", "lo"), "substring-shared")
    covered = (windows.join(shared, ["h1", "h2"]).filter(F.col("doc_id") > F.col("lo"))
               .groupBy("doc_id", "key1").agg(F.collect_list("starts").alias("at")))
    removed = _remove(covered.join(longer.select("doc_id", "key1", "z"), ["doc_id", "key1"])
                      .select("doc_id", "z", "key1", "at"), window)

    copy = F.col("doc_id") > F.col("first_id")
    return (rows.join(removed, ["doc_id", "key1"], "left")
            .select("doc_id", "n_words",
                    F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                    F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.coalesce("sha", "kept_sha256")).alias("kept_sha256"),
                    F.when(copy, F.array(F.array(F.lit(0).cast("bigint"), F.col("n_words"))))
                    .otherwise(F.coalesce("spans", F.array().cast("array<array<bigint>>"))).alias("spans")))
