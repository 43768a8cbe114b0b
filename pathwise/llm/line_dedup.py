"""Line dedup by a segment-partition edit join (native).

A line is dropped where an equal line, or one within the edits that both allow,
occurs earlier (smaller document id, then line number).  A line allows an edit
for every CHARS_PER_EDIT characters, EDITS at most: in a line of a few letters
one edit makes another word.

Equal lines are grouped first.  For each number of edits, of each distinct line
that allows so many, that many segments and one are indexed under (segment, length, text); a line at most
so much longer probes, for each indexed length, the few substrings that a common
segment can be (the start is bounded by the edits left on either side).  Two
lines within so many edits agree in one segment at least, so none is missed.
Candidates are verified by the edit distance within that band (Spark's
own; a bit-parallel one cannot be written in DataFrame functions).  All is
DataFrame functions; hashes only choose candidates, texts decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwise.llm.common import stage, unused

EDITS = 2
#: Characters of a line for each edit it allows.
CHARS_PER_EDIT = 10
#: Letters whose counts are compared before the distance is.
BAG = "etaoinsr"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.posexplode(F.split(text, "\n", -1))
                        .alias("line_no", "line"))
            .select("doc_id", "line_no", F.btrim("line", F.lit(" \t\r")).alias("line")))


def _segment(length: Column, i: int, edits: int) -> tuple[Column, Column]:
    """1-based start and size of segment i (from 0): sizes differ by one at
    most, the longer ones last."""
    parts = edits + 1
    small = F.floor(length / parts).cast("int")
    longer = length % parts
    before = F.greatest(F.lit(0), F.lit(i) - (F.lit(parts) - longer))  # longer segments before this one
    size = small + F.when(F.lit(i) >= F.lit(parts) - longer, 1).otherwise(0)
    return (F.lit(i) * small + before + 1).cast("int"), size.cast("int")


def _key(i: int, length: Column, start: Column, size: Column) -> Column:
    # four bytes a character: the place of a substring is known without a scan
    return F.xxhash64(F.lit(i), length, F.substring(F.col("wide"), start * 4 - 3, size * 4))


def index_keys(edits: int) -> Column:
    length = F.col("length")
    return F.array(*[_key(i, length, *_segment(length, i, edits)) for i in range(edits + 1)])


def probe_keys(edits: int) -> Column:
    """Substrings that may equal segment i of an indexed line ``gap`` shorter."""
    keys = []
    for gap in range(edits + 1):
        length = F.col("length") - gap
        for i in range(edits + 1):
            start, size = _segment(length, i, edits)
            low = max(-i, gap - (edits - i))
            high = min(i, gap + (edits - i))
            keys += [_key(i, length, start + shift, size) for shift in range(low, high + 1)]
    return F.array(*keys)


def near_lines(lines: DataFrame, edits: int, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """Lines (of distinct ``lines``: line, id, first) that an earlier line is near to.

    Two lines may differ by as many edits as the shorter one allows.  Lines
    that allow ``edits`` are joined with one another; for each smaller number,
    those that allow just so many with what is long enough to be near to them.
    """
    length = F.char_length("line")
    near = None
    for e in range(1, edits + 1):
        own = lines.filter(length >= e * chars_per_edit)
        if e < edits:
            own = own.filter(length < (e + 1) * chars_per_edit + e)
        part = _near(own, e)
        near = part if near is None else near.unionByName(part)
    return lines.select("id", "first").limit(0) if near is None else near.distinct()


def _near(lines: DataFrame, edits: int) -> DataFrame:
    """Lines within ``edits`` edits of an earlier one.

    The lines that meet another under a key are found first, by semi-joins of
    narrow rows; only those are compared, inside the join, so that no pair is
    written that is not near.
    """
    long = lines.select("id", F.char_length("line").alias("length"), F.encode("line", "UTF-32").alias("wide"))
    held = long.select("id", F.explode(index_keys(edits)).alias("key"))
    probes = long.select("id", F.explode(probe_keys(edits)).alias("key"))

    def meeting(own: DataFrame, other: DataFrame) -> DataFrame:
        # both semi-joins read the same two exchanges
        own, other = own.alias("own"), other.alias("other")
        return own.join(other, (F.col("own.key") == F.col("other.key")) & (F.col("own.id") != F.col("other.id")),
                        "left_semi")

    met = stage(meeting(held, probes).withColumn("held", F.lit(True))
                .unionByName(meeting(probes, held).withColumn("held", F.lit(False))), "line-keys")
    counts = [(F.octet_length("line") - F.octet_length(F.replace("line", F.lit(c)))).alias(f"n_{c}") for c in BAG]
    texts = met.select("id").distinct().join(lines, "id").select("id", "line", "first", *counts)
    rows = stage(met.join(texts, "id"), "line-texts")
    a = rows.filter("held").select("key", *[F.col(c).alias(f"a_{c}") for c in texts.columns])
    b = rows.filter("NOT held").select("key", *[F.col(c).alias(f"b_{c}") for c in texts.columns])
    # an edit changes two letter counts at most: a cheap test before the distance
    bag = " + ".join(f"abs(a_n_{c} - b_n_{c})" for c in BAG)
    near = (a.join(b, (a["key"] == b["key"]) & (F.col("a_id") != F.col("b_id")) & F.expr(f"{bag} <= {2 * edits}")
                   & (F.levenshtein("a_line", "b_line", edits) >= 0)))
    later = F.col("a_first") > F.col("b_first")
    return (near.select(F.when(later, F.col("a_id")).otherwise(F.col("b_id")).alias("id"),
                        F.greatest("a_first", "b_first").alias("first")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS) -> DataFrame:
    """One row per document: doc_id, n_lines (that are not blank), n_copies
    (dropped as equal), n_near (dropped as near), dropped (their line numbers
    from 0, ascending).

    Lines are cut at \\n and compared without blanks, tabs and \\r at their
    ends; blank lines stay.  Null text is one blank line.  A null id sorts
    before all others.  Rows that repeat an id make one row, with the counts of
    all; other columns are ignored.
    """
    spoken = _lines(docs, id_col, text_col)
    distinct = stage(spoken.filter("line <> ''").groupBy("line")
                     .agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
                     .withColumn("id", F.xxhash64("line")), "lines")
    near = near_lines(distinct, edits).withColumn("near", F.lit(True))
    firsts = distinct.select("id", F.xxhash64("line", F.lit(1)).alias("id2"), "first")
    known = firsts.join(near, ["id", "first"], "left")
    rows = spoken.select("doc_id", "line_no", F.when(F.col("line") != "", F.xxhash64("line")).alias("id"),
                         F.when(F.col("line") != "", F.xxhash64("line", F.lit(1))).alias("id2"))
    flagged = rows.join(known, ["id", "id2"], "left").select(
        "doc_id", "line_no", F.col("id").isNotNull().alias("spoken"),
        (F.struct("doc_id", "line_no") > F.col("first")).alias("copy"),
        F.coalesce("near", F.lit(False)).alias("near"))
    copy, gone = F.coalesce("copy", F.lit(False)), F.coalesce(F.col("copy") | F.col("near"), F.lit(False))
    return flagged.groupBy("doc_id").agg(
        F.sum(F.col("spoken").cast("bigint")).alias("n_lines"),
        F.sum(copy.cast("bigint")).alias("n_copies"),
        F.sum((gone & ~copy).cast("bigint")).alias("n_near"),
        F.sort_array(F.array_distinct(F.collect_list(F.when(gone, F.col("line_no"))))).alias("dropped"))


def drop_lines(docs: DataFrame, result: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines that ``dedup_lines`` drops taken out of the text."""
    ident, out = unused(docs, "_id"), unused(docs, "_gone")
    gone = result.filter(F.size("dropped") > 0).select(F.col("doc_id").alias(ident), F.col("dropped").alias(out))
    lines = F.split(F.col(text_col), "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.coalesce(out, F.array().cast("array<int>")), i)), "\n")
    return (docs.join(gone, docs[id_col].eqNullSafe(gone[ident]), "left")
            .withColumn(text_col, kept).select(*docs.columns))
