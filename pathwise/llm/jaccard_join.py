"""Exact set-similarity join on word shingles, using relations between sets.

Index lists: a shingle's list holds the sets that have it in their prefix (the
n - ceil(t n) + SHARED first shingles in one fixed order, rarer ones first).
Sets that reach the threshold share SHARED lists at least, so a set that meets
others in fewer lists is dropped at once.  Lists are cut into blocks by set size; a set is entered in the next larger block only
from positions that can still reach the overlap needed there, so blocks are
skipped by position.

Answers: equal sets are one class, whose node is one of its rows.  Then each
set is compared with one leader of the lists it is in; sets linked to the same
leader form a family, whose members' answers need no comparison with each
other.  Where a list still holds more than FEW sets beside its main family,
then, in a few rounds, each of its sets is compared with one member of the
largest family of the lists it is in, another one each time, and families that
are linked so become one: a group that lost the text it was copied from, where
no member is near all others, grows together as well.  Only pairs of different
families that meet in a block are compared in the end, each exactly.  Every
pair that can reach the threshold meets in a block, so no link between
components is lost; a group of n near copies costs about n comparisons a round,
not n * n.

The order is by approximate document frequency (a sketch of fixed size over
all shingles); it decides only which lists are long, never the result.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathwise.llm.common import bounded_batches, free_worker, shingle_hashes, slices, stage, to_batch, unused, word_hashes, words
from pathwise.llm.components import components

#: The sketch: 2^20 counters, sent to the tasks as one byte each.
SKETCH_BITS, SKETCH_PARTS = 20, 128
#: Lists that two linked sets share at least (all their shingles if they have fewer).
SHARED = 3
#: Rounds at most in which families are joined; none follows one without a link.
ROUNDS = 6
#: So many sets beside a list's main family are left to the last step at once.
FEW = 8
#: A filter's 64-bit words at most, whatever the input (2^24 bits).
FILTER_WORDS = 1 << 18
#: Texts whose words are hashed together.
TEXTS = 64
#: 64-bit words of a set's parity bits.
PARITY_WORDS = 8
#: In how many parity bits the sets a and b differ.
_DIFFER = " + ".join(f"bit_count(a_bits[{i}] ^ b_bits[{i}])" for i in range(PARITY_WORDS))
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text (words in lower-case A-Z)."""
    return _distinct(shingle_hashes(word_hashes(words(text, lower=True)), k))


def _distinct(h: np.ndarray) -> np.ndarray:
    """Sorted and distinct; several times faster than ``np.unique`` on a text's hashes."""
    h = np.sort(h)
    new = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=new[1:])
    return h[new]


def shingle_sets(texts: list[str], k: int) -> Iterator[np.ndarray]:
    """``shingle_set`` of each text; the words of TEXTS texts are hashed as one run."""
    for lo in range(0, len(texts), TEXTS):
        found = [words(t, lower=True) for t in texts[lo:lo + TEXTS]]
        h = word_hashes(list(chain.from_iterable(found)))
        runs, start = shingle_hashes(h, k), 0
        for ws in found:
            end = start + len(ws)
            yield _distinct(runs[start:end - k + 1] if len(ws) >= k else shingle_hashes(h[start:end], k))
            start = end


def parity_bits(s: np.ndarray) -> np.ndarray:
    """512 bits, each the parity of the number of shingles it stands for: two
    sets differ in as many shingles at least as their bits differ."""
    slot = ((s * _SPREAD) >> np.uint64(55)).astype(np.int64)
    return np.packbits((np.bincount(slot, minlength=64 * PARITY_WORDS) & 1).astype(np.uint8)).view(np.int64)


def _sketch(docs: DataFrame, k: int) -> np.ndarray:
    """One byte per counter: twice the binary logarithm of its count."""
    schema = pa.schema([("part", pa.int32()), ("counts", pa.binary())])
    width = (1 << SKETCH_BITS) // SKETCH_PARTS
    shift = np.uint64(64 - SKETCH_BITS)

    def count(batches):
        free_worker()
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        pack = zstandard.ZstdCompressor(level=1)
        for _, texts in slices(batches):
            found = [(s >> shift).astype(np.int64) for s in shingle_sets(texts, k)]
            total += np.bincount(np.concatenate(found or [np.empty(0, np.int64)]),
                                 minlength=1 << SKETCH_BITS).astype(np.uint32)
        yield to_batch({"part": list(range(SKETCH_PARTS)),
                        "counts": [pack.compress(c.tobytes()) for c in total.reshape(SKETCH_PARTS, width)]}, schema)

    def add(batches):  # streams: one part's rows are never held together
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for part, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = totals.setdefault(part, np.zeros(width, np.uint64))
                own += np.frombuffer(zstandard.decompress(counts), np.uint32)
        yield to_batch({"part": list(totals), "counts": [
            np.floor(2 * np.log2(c + 1.0)).astype(np.uint8).tobytes() for c in totals.values()]}, schema)

    ddl = "part int, counts binary"
    rows = (docs.mapInArrow(count, ddl).repartition(SKETCH_PARTS, "part").mapInArrow(add, ddl)
            .collect())  # 2^20 bytes, whatever the input
    out = np.zeros((SKETCH_PARTS, width), np.uint8)
    for r in rows:
        out[r["part"]] = np.frombuffer(r["counts"], np.uint8)
    return out.reshape(-1)


def _signatures(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, mark, size, set key, prefix in the common order, parity bits."""
    rarity = _sketch(docs.select("doc_id", "text"), k)
    shift = np.uint64(64 - SKETCH_BITS)
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.string()), ("n", pa.int32()), ("key1", pa.int64()),
                        ("key2", pa.int64()), ("prefix", pa.list_(pa.int64())),
                        ("bits", pa.list_(pa.int64()))])

    def run(batches):
        for ids, texts, marks in slices(batches):
            out = {f.name: [] for f in schema}
            for doc_id, mark, s in zip(ids, marks, shingle_sets(texts, k)):
                n = len(s)
                key = xxhash.xxh3_128_digest(s.tobytes())
                least = n - -(-num * n // den) + SHARED if n else 0
                prefix = s[np.lexsort((s, rarity[s >> shift]))[:least]]
                row = (doc_id, mark, n, int.from_bytes(key[:8], "little", signed=True),
                       int.from_bytes(key[8:], "little", signed=True), prefix.view(np.int64), parity_bits(s))
                for values, v in zip(out.values(), row):
                    values.append(v)
            yield to_batch(out, schema)

    return docs.mapInArrow(run, "doc_id bigint, mark string, n int, key1 bigint, key2 bigint, prefix array<bigint>, "
                               "bits array<bigint>")


def _lists(heads: DataFrame, num: int, den: int) -> DataFrame:
    """token, block, node, n, own, length: the list's number of sets, and
    strict: the largest partner that the position allows for a first common
    shingle, null where it can't be one.  Only lists of two sets or more: most
    are of one, so rows go to their list once and are counted there."""
    step = math.log(den / num * 1.0001) if den > num else 1.0
    size = F.floor(F.log(F.col("n")) / step + 1e-12).cast("int")
    # the first SHARED common shingles of two sets leave that many positions at least
    reach = F.floor((F.col("n") - F.col("pos") + SHARED - 1) * F.lit((num + den) / num) + 1e-6).cast("int") - F.col("n")
    strict = F.floor((F.col("n") - F.col("pos")) * F.lit((num + den) / num) + 1e-6).cast("int") - F.col("n")
    least = F.ceil(F.exp((F.col("size") + 1) * step) - 1e-6)  # smallest size of the next block
    entries = (heads.withColumn("size", size)
               .select("node", "n", "size", F.posexplode("prefix").alias("pos", "token"))
               .withColumn("reach", reach)
               .withColumn("block", F.explode(F.when(F.col("reach") >= least, F.array("size", F.col("size") + 1))
                                              .otherwise(F.array("size")))))
    return (entries.select("token", "block", "node", "n", "pos")
            .withColumn("length", F.count(F.lit(1)).over(Window.partitionBy("token", "block"))).filter("length > 1")
            .withColumn("strict", F.when(F.col("pos") <= F.col("n") - F.ceil(F.lit(num) * F.col("n") / den), strict))
            .select("token", "block", "node", "n", "strict", (F.col("block") == size).alias("own"), "length"))


def _only(rows: DataFrame, name: str, wanted: DataFrame) -> DataFrame:
    """``rows`` less most of those whose ``name`` is not in the one column of
    ``wanted``, by a filter of bounded size: a join after it shuffles the rest."""
    def slot(column):
        return F.xxhash64(column)

    word, bit = F.pmod(slot(name), F.lit(FILTER_WORDS)), F.shiftrightunsigned(slot(name), 58)
    own = wanted.columns[0]
    marks = (wanted.select(F.pmod(slot(own), F.lit(FILTER_WORDS)).alias("_word"),
                           F.expr("shiftleft(1L, cast(shiftrightunsigned(xxhash64(%s), 58) as int))" % own).alias("_mask"))
             .groupBy("_word").agg(F.bit_or("_mask").alias("_mask")))
    return rows.join(F.broadcast(marks), (word == F.col("_word")) & (F.getbit("_mask", bit) == 1), "left_semi")


def _texts(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """node, z: compressed text of the sets that meet others in a list.
    ``wanted``: doc_id, node, key1."""
    schema = pa.schema([("node", pa.int64()), ("z", pa.binary())])

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for nodes, texts, keys in slices(batches):
            out = {"node": [], "z": []}
            for node, text, key1, s in zip(nodes, texts, keys, shingle_sets(texts, k)):
                key = xxhash.xxh3_128_digest(s.tobytes())
                if int.from_bytes(key[:8], "little", signed=True) == key1:  # not another row with this id
                    out["node"].append(node)
                    out["z"].append(pack.compress(text.encode("utf-8", "surrogatepass")))
            yield to_batch(out, schema)

    return (_only(docs, "doc_id", wanted.select("doc_id")).join(wanted, "doc_id").select("node", "text", "key1")
            .mapInArrow(run, "node bigint, z binary"))


def _linked(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold, compared exactly."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        known: OrderedDict[int, np.ndarray] = OrderedDict()

        def tokens(doc_id, z):
            if doc_id not in known:
                text = zstandard.decompress(z).decode("utf-8", "surrogatepass")
                known[doc_id] = shingle_set(text, k)
                if len(known) > 256:
                    known.popitem(last=False)
            return known[doc_id]

        for a, za, b, zb in slices(batches):
            out = {"a": [], "b": []}
            for i, zi, j, zj in zip(a, za, b, zb):
                x, y = tokens(i, zi), tokens(j, zj)
                if num * max(len(x), len(y)) > den * min(len(x), len(y)):
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                if den * common >= num * (len(x) + len(y) - common):
                    out["a"].append(i)
                    out["b"].append(j)
            yield to_batch(out, schema)

    pairs = stage(pairs.select("a", "b"), "jaccard-compared")
    ta, tb = (_only(texts.select(F.col("node").alias(c), F.col("z").alias(f"z{c}")), c, pairs.select(c))
              for c in ("a", "b"))
    return (pairs.join(ta, "a").join(tb, "b").select("a", "za", "b", "zb")
            .mapInArrow(run, "a bigint, b bigint"))


def _labels(links: DataFrame) -> DataFrame:
    """node, family: for each ``a`` its one leader ``b``, unless ``a`` leads
    others itself.  Nodes without a row are their own family, so nodes of one
    family are all linked to it."""
    return (links.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
            .select(F.col("a").alias("node"), F.col("b").alias("family")))


def _with_family(rows: DataFrame, labels: DataFrame, name: str = "node") -> DataFrame:
    """``rows`` with the family of their ``name``, itself where it has none."""
    own = labels.select(F.col("node").alias(name), F.col("family").alias("_family"))
    return (rows.join(own, name, "left")
            .withColumn("family", F.coalesce("_family", name)).drop("_family"))


def _rank(family: str, members: str, turn: int) -> Column:
    """The order of families in a round: larger ones last."""
    return F.struct(members, F.xxhash64(family, F.lit(turn)), family)


def _moved(more: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """node, family: the families that go over to another one that a member is
    linked to, and on to where that goes, up to four steps.  Each step leads to
    a later one in the round's order, so none leads back; a family that is not
    followed to the end keeps a name of its own."""
    of_a = labels.select(F.col("node").alias("a"), F.col("family").alias("fa"))
    of_b = labels.select(F.col("node").alias("b"), F.col("family").alias("fb"), "members")
    hops = (more.join(of_a, "a").join(of_b, "b").groupBy(F.col("fa").alias("a"))
            .agg(F.max_by("fb", _rank("fb", "members", turn)).alias("b")))
    for _ in range(2):
        on = hops.select(F.col("a").alias("b"), F.col("b").alias("c"))
        hops = stage(hops.join(on, "b", "left").select("a", F.coalesce("c", "b").alias("b")), "jaccard-hops")
    return hops.select(F.col("a").alias("node"), F.col("b").alias("family"))


def _sized(labels: DataFrame) -> DataFrame:
    """``labels`` with the number of the family's members."""
    sizes = labels.groupBy("family").agg(F.count(F.lit(1)).alias("members"))
    return labels.join(sizes, "family").select("node", "family", "members")


def _largest(rows: DataFrame, turn: int) -> DataFrame:
    """token, block, leader, of: of the lists that hold more than FEW sets
    beside their main family, a member of the largest family, another one in
    each list and round, and that family."""
    held = (rows.groupBy("token", "block", "family", "members")
            .agg(F.count(F.lit(1)).alias("held"),
                 F.max_by("node", F.xxhash64("node", "token", F.lit(turn))).alias("leader")))
    return (held.groupBy("token", "block")
            .agg((F.sum("held") - F.max("held")).alias("others"),
                 F.max_by(F.struct("leader", F.col("family").alias("of")), _rank("family", "members", turn)).alias("first"))
            .filter(F.col("others") > FEW).select("token", "block", "first.*"))


def _with_bits(met: DataFrame, bits: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (node, leader) that can reach the threshold, with size and
    parity bits of either: a_node and so on, b_node and so on."""
    a, b = (bits.select(*[F.col(c).alias(f"{side}_{c}") for c in ("node", "n", "bits")]) for side in ("a", "b"))
    return (met.withColumnsRenamed({"node": "a_node", "leader": "b_node"}).join(a, "a_node").join(b, "b_node")
            .filter(_may_reach(num, den)))


def _leader_pairs(rows: DataFrame, leaders: DataFrame, bits: DataFrame, num: int, den: int) -> DataFrame:
    """a, b: each node with the leader of another family it shares most lists
    with, where their parity bits let the two reach the threshold."""
    met = (rows.join(leaders, ["token", "block"]).filter("family <> of")
           .groupBy("node", "leader").agg(F.count(F.lit(1)).alias("shared"), F.max("n").alias("n"))
           .filter(f"shared >= least({SHARED}, n)"))  # others wait for the last step
    met = met.groupBy("node").agg(F.max_by("leader", "shared").alias("leader"))
    return _with_bits(met, bits, num, den).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def _nearest_pairs(rows: DataFrame, leaders: DataFrame, bits: DataFrame, num: int, den: int) -> DataFrame:
    """a, b: each node with the leader of another family whose parity bits are
    nearest, where they let the two reach the threshold."""
    met = rows.join(leaders, ["token", "block"]).filter("family <> of").select("node", "leader").distinct()
    return (_with_bits(met, bits, num, den).groupBy(F.col("a_node").alias("a"))
            .agg(F.min_by("b_node", F.expr(_DIFFER)).alias("b")))


def _grouped(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text, mark): doc_id, mark, n, row,
    component_id, and rep: the row that stands for its group."""
    signed = stage(_signatures(docs, k, num, den).withColumn("row", F.monotonically_increasing_id()),
                   "jaccard-signatures")
    docs = docs.select("doc_id", "text")
    keys = ["key1", "key2"]
    classes = (signed.filter("n > 0 AND doc_id IS NOT NULL").groupBy(*keys)
               .agg(F.min(F.struct("doc_id", "row")).alias("first"))
               .select(*keys, F.col("first.doc_id").alias("class_id"), F.col("first.row").alias("node")))
    heads = signed.join(classes.select("node"), F.col("row") == F.col("node"), "left_semi").withColumn("node", F.col("row"))
    shared = stage(_lists(heads, num, den), "jaccard-lists")
    enough = (shared.groupBy("node").agg(F.count_distinct("token").alias("lists"), F.max("n").alias("n"))
              .filter(f"lists >= least({SHARED}, ceil({num} * n / {den}))").select("node", "lists"))
    enough = stage(enough, "jaccard-enough")
    shared = stage(shared.join(enough, "node"), "jaccard-shared")
    heads = stage(signed.withColumn("node", F.col("row")).join(enough.select("node"), "node", "left_semi")
                  .select("node", "doc_id", "key1", "n", "prefix", "bits"), "jaccard-heads")
    bits = heads.select("node", "n", "bits")
    texts = stage(_texts(docs, heads.select("doc_id", "node", "key1"), k), "jaccard-texts")

    # an original is in more lists than its copies, whose changed shingles are their own
    # (of equal ones the same in every list, so that they do not share the copies among them)
    leaders = stage(shared.groupBy("token", "block")
                    .agg(F.max_by("node", F.struct("lists", F.xxhash64("node"))).alias("leader"))
                    .withColumn("of", F.col("leader")), "jaccard-leaders")
    own = shared.withColumn("family", F.col("node"))
    links = stage(_linked(_leader_pairs(own, leaders, bits, num, den), texts, k, num, den), "jaccard-links")

    labels = stage(_sized(_with_family(enough.select("node"), _labels(links))), "jaccard-labels")
    crowd = stage(shared.filter(F.col("length") > FEW + 1).join(labels, "node"), "jaccard-crowd")
    for turn in range(ROUNDS):
        leaders = stage(_largest(crowd, turn), "jaccard-leaders")
        if leaders.isEmpty():
            break
        crowd = crowd.join(leaders.select("token", "block"), ["token", "block"], "left_semi")
        more = stage(_linked(_nearest_pairs(crowd, leaders, bits, num, den), texts, k, num, den), "jaccard-more")
        links = links.unionByName(more)
        if more.isEmpty():
            break
        # a whole family goes over to one that a member is linked to
        moved = _moved(more, labels, turn)
        labels = labels.select("node", F.col("family").alias("before"))
        labels = stage(_sized(_with_family(labels, moved, "before").select("node", "family")), "jaccard-labels")
        crowd = stage(crowd.drop("family", "members").join(labels, "node"), "jaccard-crowd")
    rows = stage(shared.join(labels.select("node", "family"), "node"), "jaccard-families")
    pairs = stage(_family_pairs(rows, heads, num, den), "jaccard-pairs")
    links = links.unionByName(_linked(pairs, texts, k, num, den))
    found = components(links)
    # the component's smallest id, and the row that has it
    found = classes.join(found, "node")
    least = found.groupBy("component").agg(F.min(F.struct("class_id", "node")).alias("rep"))
    found = found.join(least, "component").select(*keys, F.col("rep.class_id").alias("_id"), F.col("rep.node").alias("_rep"))
    return (signed.drop("prefix", "bits").join(classes, keys, "left").join(found, keys, "left")
            .select("doc_id", "mark", "n", "row",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("_id", "class_id", "doc_id")).alias("component_id"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("_rep", "node")).alias("rep")))


def jaccard_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                   num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``df``.

    A set: the distinct k-word shingles of the whole text (A-Z lower-cased,
    words between white space); with fewer words, the whole sequence as one.
    Two documents link when den * intersection >= num * union;
    component_id is the smallest id reachable.

    Null and empty texts have no shingles and link with nothing.  Every row is
    a document of its own, also where ids repeat.  A row with a null id links
    with nothing and has a null component.  Other columns are ignored.
    """
    bounded_batches(df.sparkSession)
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                     F.lit(None).cast("string").alias("mark"))
    return _grouped(docs, k, num, den).select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id")


def _may_reach(num: int, den: int) -> Column:
    """Whether sizes and parity bits let the sets a and b reach the threshold."""
    return F.expr(f"{num} * greatest(a_n, b_n) <= {den} * least(a_n, b_n) "
                  f"AND {num + den} * ({_DIFFER}) <= {den - num} * (a_n + b_n)")


def _family_pairs(rows: DataFrame, heads: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of different families that can reach the threshold.

    They are found by their first common shingle, which lies before the last
    SHARED - 1 (the most frequent) of either prefix, and kept if their prefixes
    share SHARED.  A block's largest family is only ever the other side, so a
    family's members are not set against each other.  Sets whose parity bits
    differ in more places than the threshold lets the sets differ are left out
    in the join itself, without loss.
    """
    rows = rows.filter("strict IS NOT NULL")
    sizes = rows.groupBy("token", "block", "family").agg(F.count(F.lit(1)).alias("members"))
    blocks = stage(sizes.groupBy("token", "block")
                   .agg(F.max_by("family", "members").alias("main"), F.count(F.lit(1)).alias("families"))
                   .filter("families > 1").drop("families"), "jaccard-blocks")
    held = stage(rows.join(blocks, ["token", "block"]).join(heads.select("node", "bits"), "node"),
                 "jaccard-held")
    sides = ("node", "n", "strict", "own", "family", "bits")
    a = held.filter("family <> main").select("token", "block", *[F.col(c).alias(f"a_{c}") for c in sides])
    b = held.select("token", "block", "main", *[F.col(c).alias(f"b_{c}") for c in sides])
    a, b = a.alias("a"), b.alias("b")
    met = (a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.block") == F.col("b.block")) & F.expr(
        "a_family <> b_family AND (b_family = main OR a_node < b_node) AND (a_own OR b_own) "
        "AND a_n <= b_strict AND b_n <= a_strict") & _may_reach(num, den))
           .select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))
           .distinct())
    prefixes = heads.select("node", "n", "prefix")
    pa_, pb = (prefixes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"),
                               F.col("prefix").alias(f"prefix_{c}")) for c in ("a", "b"))
    return (stage(met, "jaccard-candidates").join(pa_, "a").join(pb, "b")
            .filter(F.size(F.array_intersect("prefix_a", "prefix_b"))
                    >= F.expr(f"least({SHARED}, ceil({num} * least(n_a, n_b) / {den}))"))
            .select("a", "b").distinct())


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                     num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``df`` with one document, the smallest id, of each group of
    linked documents.

    Rows go by id and text, so a near copy takes no other text that bears its
    id with it.  Rows without an id and rows without words stay; rows that
    repeat the id and text of the one that stays, too.
    """
    bounded_batches(df.sparkSession)
    mark, own = unused(df, "_mark"), unused(df, "_own")
    rows = df.withColumn(mark, F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    docs = rows.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(mark).alias("mark"))
    grouped = stage(_grouped(docs, k, num, den).filter("n > 0 AND doc_id IS NOT NULL")
                    .select("doc_id", "mark", "row", "rep"), "jaccard-groups")
    stay = grouped.filter("row = rep").select("doc_id", "mark")
    gone = (grouped.filter("row <> rep").select("doc_id", "mark").distinct()
            .join(stay, ["doc_id", "mark"], "left_anti")
            .select(F.col("doc_id").alias(own), F.col("mark").alias(f"{own}_mark")))
    return (rows.join(gone, (rows[id_col] == gone[own]) & (rows[mark] == gone[f"{own}_mark"]), "left_anti")
            .select(*df.columns))
