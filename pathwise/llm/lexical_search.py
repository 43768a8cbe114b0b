"""Ranked lexical search, term at a time with a limited set of accumulators.

Two passes over the documents, both maps.  The first counts, per task, the
documents, their terms and the documents that hold each query term; Spark adds
the counts up.  The second ranks: a task cuts its documents into blocks of
bounded size, inverts each block for the query terms, and works through an
item's terms from the rarest on.  A document gets an accumulator while those
without one can still reach the k-th score so far (of the block's partial
scores or of the task's finished ones); after that only the survivors are
updated, exactly, and of them those that can still reach it.  Each task keeps
its k best per item; Spark ranks these.  Documents are never shuffled, and
nothing grows with them but the counts.

Query items are taken in blocks of bounded bytes, two passes for each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathwise.llm.common import bounded_batches, slices, stage

#: Bytes of item terms sent to the tasks at once; more items take further passes.
ITEM_BYTES = 16 << 20
#: Share of the term frequency's normalisation that depends on the length, in per cent.
LENGTH_SHARE = 75

_TO_SPACE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                  for c in range(256))


def terms(text: str) -> list[bytes]:
    """Maximal runs of characters other than ASCII ones that are no letter or
    digit, A-Z lower-cased, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


def weight(n_docs: int, df: int) -> int:
    """Rarer terms weigh more: a scaled logarithm, rounded down."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one unit of a term's weight adds: saturating in the term frequency,
    lower in long documents; integers throughout."""
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Block:
    """The postings of some documents for the query terms."""

    def __init__(self, texts: list[str], index: dict[bytes, int], n_docs: int, n_terms: int):
        docs: list[int] = []
        ids: list[int] = []
        tfs: list[int] = []
        lengths = np.zeros(len(texts), np.int64)
        for d, text in enumerate(texts):
            ws = terms(text)
            lengths[d] = len(ws)
            found = Counter(map(index.get, ws))
            found.pop(None, None)
            ids.extend(found)
            tfs.extend(found.values())
            docs.extend([d] * len(found))
        self.n = len(texts)
        term, doc = np.array(ids, np.int64), np.array(docs, np.int64)
        order = np.argsort(term, kind="stable")  # documents stay ascending in a list
        self.doc = doc[order]
        self.impact = impacts(np.array(tfs, np.int64), lengths[doc], n_docs, n_terms)[order] if len(doc) else doc
        here, starts = np.unique(term[order], return_index=True)
        most = np.maximum.reduceat(self.impact, starts) if len(starts) else self.impact
        self.lists = {t: (lo, hi, best) for t, lo, hi, best in
                      zip(here.tolist(), starts.tolist(), [*starts[1:].tolist(), len(doc)], most.tolist())}

    def rank(self, query: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of those that can be among the ``k`` best, given
        that ``floor`` is to be reached at least; ``query`` is (term, weight
        times repeats), rarest first."""
        steps = [(self.lists[t], w) for t, w in query if t in self.lists and w]
        rest = sum(w * best for (_, _, best), w in steps)
        floor = max(floor, 1)
        if rest < floor:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        acc = np.zeros(self.n, np.int64)
        at = 0
        while at < len(steps) and rest >= floor:  # new accumulators may come
            (lo, hi, best), w = steps[at]
            acc[self.doc[lo:hi]] += w * self.impact[lo:hi]
            rest -= w * best
            at += 1
            if at < len(steps) and rest < 4 * floor + w * best:  # near the end: look at the k-th partial score
                held = acc[acc > 0]
                if len(held) >= k:
                    floor = max(floor, int(np.partition(held, len(held) - k)[len(held) - k]))
        left = np.flatnonzero(acc > 0)
        score = acc[left]
        for (lo, hi, best), w in steps[at:]:
            ok = score + rest >= floor
            if not ok.all():
                left, score = left[ok], score[ok]
            where = np.searchsorted(self.doc[lo:hi], left)
            hit = np.minimum(where, hi - lo - 1) + lo
            score += np.where(self.doc[hit] == left, w * self.impact[hit], 0)
            rest -= w * best
            if len(score) >= k:
                floor = max(floor, int(np.partition(score, len(score) - k)[len(score) - k]))
        ok = score >= floor
        return left[ok], score[ok]


def _count(docs: DataFrame, index: dict[bytes, int]) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, their terms, and documents per query term."""
    send = docs.sparkSession.sparkContext.broadcast(index)
    schema = pa.schema([("term", pa.int64()), ("docs", pa.int64()), ("terms", pa.int64())])

    def run(batches):
        index = send.value
        df: Counter = Counter()
        n_docs = n_terms = 0
        for _, texts in slices(batches):
            for text in texts:
                ws = terms(text)
                n_docs += bool(ws)
                n_terms += len(ws)
                df.update(set(map(index.get, ws)))
        df.pop(None, None)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *df], pa.int64()), pa.array([n_docs, *df.values()], pa.int64()),
                                          pa.array([n_terms] + [0] * len(df), pa.int64())], schema=schema)

    rows = (docs.mapInArrow(run, "term bigint, docs bigint, terms bigint").groupBy("term")
            .agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).collect())  # a row per query term
    found = {r["term"]: (r["docs"], r["terms"]) for r in rows}
    n_docs, n_terms = found.pop(-1, (0, 0))
    return n_docs, n_terms, {t: d for t, (d, _) in found.items()}


def _best(docs: DataFrame, items: list[tuple[int, list[bytes]]], k: int) -> DataFrame:
    """item, doc_id, score: the best of each task, among them the best of all."""
    index: dict[bytes, int] = {}
    for _, ws in items:
        for w in ws:
            index.setdefault(w, len(index))
    n_docs, n_terms, df = _count(docs, index)
    queries = []
    for item, ws in items:
        repeats = Counter(index[w] for w in ws if index[w] in df)
        by_rarity = sorted(repeats, key=lambda t: (df[t], t))
        queries.append((item, [(t, weight(n_docs, df[t]) * repeats[t]) for t in by_rarity]))
    send = docs.sparkSession.sparkContext.broadcast((index, queries, n_docs, n_terms))
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        index, queries, n_docs, n_terms = send.value
        # per item: scores descending, then ids ascending with null ids last
        none = (np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for ids, texts in slices(batches):
            block = Block(texts, index, n_docs, n_terms)
            no_id = np.array([i is None for i in ids], bool)
            ids = np.array([i or 0 for i in ids], np.int64)
            for q, (_, query) in enumerate(queries):
                score, null, doc = best.get(q, none)
                found, points = block.rank(query, k, int(score[-1]) if len(score) == k else 1)
                if len(found):
                    score = np.concatenate((score, points))
                    null = np.concatenate((null, no_id[found]))
                    doc = np.concatenate((doc, ids[found]))
                    order = np.lexsort((doc, null, -score))[:k]
                    best[q] = score[order], null[order], doc[order]
        for q, (score, null, doc) in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(doc), queries[q][0])), pa.array(doc, mask=null), pa.array(score)], schema=schema)

    return docs.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items' numbers and terms, some megabytes at a time."""
    block: list[tuple[int, list[bytes]]] = []
    size = 0
    for row in items.select("item", "text").toLocalIterator():
        ws = terms(row["text"] or "")
        block.append((row["item"], ws))
        size += 64 + sum(64 + len(w) for w in ws)
        if size >= ITEM_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: for each row of ``items`` its ``k`` best
    rows of ``docs`` with a score above 0, equal scores by ascending id.

    Null texts have no terms; a document without terms counts for nothing, an
    item without terms (or with none that occurs) has no rows.  Each row is a
    document, and each item row an item, also where ids repeat; null document
    ids come after others of equal score.  Other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # numbered once and written, so that every pass sees the same numbers
    numbered = stage(items.select(F.monotonically_increasing_id().alias("item"),
                                  F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")),
                     "search-items")
    found = None
    for block in _item_blocks(numbered):
        part = _best(docs, block, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "item bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .join(numbered.select("item", "item_id"), "item")
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
scored AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id), corpus
  GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
