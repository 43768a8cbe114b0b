"""Language identification by Bayesian evidence fusion.

log P(l | everything) = text likelihood + log P(declared | l)
                      + log P(address suffix | l) + log prior of the host.

* Text: naive Bayes over hashed character trigrams, fitted on a bounded sample
  of labelled rows; scored over every whole text (one map, no shuffle).
* Declared language and address suffix: emission tables estimated by grouped
  aggregation over all rows, from text-only posteriors.
* Host prior: the host's sums of text-only posteriors, smoothed towards its
  domain's, those towards the global one; a row's own share is taken out.

Texts are read once.  What is joined afterwards is narrow, hosts that hold a
large part of the rows are summed map-side first and split by AQE's skew join.
"""

from __future__ import annotations

import html as html_lib
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathwise.llm.common import bounded_batches, free_worker, slices, stage, to_batch, unused

UNDETERMINED = "und"
BUCKETS = 1 << 16
#: Bound of the labelled sample: rows per language and characters per row.
SAMPLE_ROWS, SAMPLE_CHARS = 400, 4000
#: Neighbouring trigrams overlap, so each counts for part of its evidence.
TEXT_WEIGHT = 0.25
MIN_PROBABILITY = 0.5
#: Pseudo-counts: host towards domain, domain towards all, emission tables.
HOST_WEIGHT, DOMAIN_WEIGHT, EMISSION_WEIGHT = 20.0, 50.0, 5.0

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-case letters; other ASCII counts as one space."""
    b = _LETTERS[np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)]
    b = b[np.concatenate(([True], (b[1:] != 32) | (b[:-1] != 32)))].astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.uint32)
    h = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D)
    return (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16)


def page_text(html: str) -> str:
    """Text between the tags of a page, good enough to tell its language."""
    t = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ", html)
    return html_lib.unescape(t)


class TextModel:
    """Trigram log-probabilities, one column per language and one for none of them."""

    def __init__(self, samples: dict[str, np.ndarray]):
        """``samples``: numbers of trigrams by bucket, of each language."""
        self.languages = sorted(samples)
        self.logp = np.empty((BUCKETS, len(self.languages) + 1), np.float32)
        for i, lang in enumerate(self.languages):
            counts = samples[lang] + 0.1
            self.logp[:, i] = np.log(counts / counts.sum())
        self.logp[:, -1] = np.log(1.0 / BUCKETS)

    def score(self, text: str) -> tuple[int, np.ndarray]:
        n, total = 0, np.zeros(self.logp.shape[1])
        for at in range(0, max(1, len(text)), 200_000):  # bounded memory for long texts
            idx = trigrams(text[at:at + 200_000])
            n += len(idx)
            total += self.logp.take(idx, axis=0).sum(axis=0, dtype=np.float64)
        return n, total * TEXT_WEIGHT


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_text_model(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang") -> TextModel:
    """Fit on at most SAMPLE_ROWS rows of each label, those with the smallest
    hashed ids; SAMPLE_CHARS of each.  Every label is a class.  The trigrams are
    counted in the tasks: one table of BUCKETS counters a label reaches the driver."""
    label = _primary(F.col(lang_col))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key", "id"))
    ids = (labelled.select(label.alias("lang"), F.col(id_col).alias("id"))
           .filter("lang IS NOT NULL").withColumn("key", F.xxhash64("id"))
           .withColumn("rank", rank).filter(F.col("rank") <= SAMPLE_ROWS).select("lang", "id"))
    rows = (labelled.select(F.col(id_col).alias("id"), label.alias("lang"),
                            F.substring(text_col, 1, SAMPLE_CHARS).alias("text"))
            .join(F.broadcast(ids), ["id", "lang"], "left_semi")  # bounded by the sample
            .filter("text IS NOT NULL").select("lang", "text"))
    tables = rows.repartition("lang").mapInArrow(_count_trigrams, "lang string, counts binary").collect()
    samples: dict[str, np.ndarray] = {}
    for r in tables:
        samples[r["lang"]] = np.frombuffer(zstandard.decompress(r["counts"]), np.int64)
    return TextModel(samples or {UNDETERMINED + "-none": np.zeros(BUCKETS, np.int64)})


def _count_trigrams(batches):
    """One row per label of the task: its zstd-packed trigram counts."""
    schema = pa.schema([("lang", pa.string()), ("counts", pa.binary())])
    counts: dict[str, np.ndarray] = {}
    for langs, texts in slices(batches):
        for lang, text in zip(langs, texts):
            if lang not in counts:
                counts[lang] = np.zeros(BUCKETS, np.int64)
            counts[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
    for lang, own in counts.items():
        yield to_batch({"lang": [lang], "counts": [zstandard.compress(own.tobytes())]}, schema)


def _primary(c: Column) -> Column:
    """Primary language subtag in lower case; null when there is none."""
    p = F.lower(F.regexp_extract(F.trim(c), "^[A-Za-z]+", 0))
    return F.when(p == "", F.lit(None)).otherwise(p)


def document_evidence(docs: DataFrame) -> DataFrame:
    """documents as evidence rows: the source stands for the host, no address."""
    return docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"),
                       F.lit(False).alias("is_html"), _primary(F.col("lang")).alias("declared"),
                       F.col("source").cast("string").alias("host"),
                       F.col("source").cast("string").alias("domain"),
                       F.lit(None).cast("string").alias("suffix"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """pages as evidence rows: language of the markup, host and suffix of the url."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    markup = F.regexp_extract("html", r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z]+)", 1)
    return (pages.select(F.col("page_id").alias("id"), F.col("html").cast("string").alias("text"),
                         F.lit(True).alias("is_html"), _primary(markup).alias("declared"),
                         F.when(host != "", host).alias("host"))
            .withColumn("domain", F.regexp_extract("host", r"([^.]+\.)?[^.]+$", 0))
            .withColumn("suffix", F.regexp_extract("host", r"[^.]+$", 0)))


def identify(evidence: DataFrame, model: TextModel) -> DataFrame:
    """id, is_html, row_key, language, probability, text_language, n_trigrams,
    accepted for each evidence row (id, text, is_html, declared, host, domain,
    suffix).

    Null or empty text has no trigrams: its language follows from the other
    evidence, and it is not accepted.  Nulls in declared, host or suffix are no
    evidence.  Rows that repeat are judged each.  ``row_key`` tells rows apart
    that share an id.  Accepted: a language other than none, with at least
    MIN_PROBABILITY, seen in the text.
    """
    bounded_batches(evidence.sparkSession)
    spark, langs = evidence.sparkSession, model.languages
    k = len(langs)
    scored = stage(_score(evidence, model), "language-scores")
    shares = [F.sum(F.col("post")[i]).alias(f"s{i}") for i in range(k)]
    names = [f"s{i}" for i in range(k)]
    sums = [F.sum(n).alias(n) for n in names]
    hosts = stage(scored.groupBy("host", "domain", "suffix").agg(*shares), "language-hosts")

    def counts(df, prefix):
        return df.select(*df.columns[:1], F.array(*[F.coalesce(n, F.lit(0.0)) for n in names]).alias(prefix))

    total = hosts.agg(*sums).first()
    overall = np.array([total[n] or 0.0 for n in names])
    domains = counts(hosts.groupBy("domain").agg(*sums), "domain_counts")
    suffixes = counts(hosts.groupBy("suffix").agg(*sums), "suffix_counts")
    by_host = (hosts.select("host", "domain", "suffix", F.array(*names).alias("host_counts"))
               .join(domains, "domain").join(suffixes, "suffix"))
    # declared codes are known languages or one of "other": at most k + 1 rows
    emission = np.full((k + 1, k), EMISSION_WEIGHT / (k + 1))
    for r in scored.filter("declared IS NOT NULL").groupBy(
            F.when(F.col("declared").isin(langs), F.col("declared")).otherwise("").alias("declared")
    ).agg(*shares).collect():
        emission[langs.index(r["declared"]) if r["declared"] else k] += [r[n] or 0.0 for n in names]
    emission = np.log(emission / emission.sum(axis=0))
    n_suffixes = hosts.select("suffix").distinct().count()
    return _fuse(scored.join(by_host, ["host", "domain", "suffix"]), langs, overall, emission, n_suffixes)


def _score(evidence: DataFrame, model: TextModel) -> DataFrame:
    schema = pa.schema([
        ("id", pa.int64()), ("is_html", pa.bool_()), ("row_key", pa.int64()), ("declared", pa.string()),
        ("host", pa.string()), ("domain", pa.string()), ("suffix", pa.string()), ("n_trigrams", pa.int64()),
        ("loglik", pa.list_(pa.float64())), ("post", pa.list_(pa.float64()))])

    def run(batches):
        free_worker()
        for ids, texts, is_html, declared, host, domain, suffix, key in slices(batches):
            ns, lls, posts = [], [], []
            for t, markup in zip(texts, is_html):
                n, ll = model.score(page_text(t) if markup else t)
                p = softmax(ll)[:-1]
                ns.append(n)
                lls.append(ll)
                posts.append(p if n else np.zeros(len(p)))
            yield to_batch({"id": ids, "is_html": is_html, "row_key": key, "declared": declared,
                            "host": host, "domain": domain, "suffix": suffix, "n_trigrams": ns,
                            "loglik": lls, "post": posts}, schema)

    def known(c):  # unknown hosts, domains and suffixes are empty
        return F.coalesce(F.col(c), F.lit("")).alias(c)

    src = evidence.select(F.col("id").cast("bigint").alias("id"), "text", "is_html", "declared", known("host"),
                          known("domain"), known("suffix"),
                          F.xxhash64("text", "declared", "host").alias("row_key"))
    return src.mapInArrow(run, "id bigint, is_html boolean, row_key bigint, declared string, host string, "
                               "domain string, suffix string, n_trigrams bigint, loglik array<double>, "
                               "post array<double>")


def _fuse(joined: DataFrame, langs: list[str], overall: np.ndarray, emission: np.ndarray,
          n_suffixes: int) -> DataFrame:
    k = len(langs)
    everywhere = (overall + 1.0) / (overall.sum() + k)
    schema = pa.schema([
        ("id", pa.int64()), ("is_html", pa.bool_()), ("row_key", pa.int64()), ("language", pa.string()),
        ("probability", pa.float64()), ("text_language", pa.string()), ("n_trigrams", pa.int64()),
        ("accepted", pa.bool_())])

    def fused(r) -> tuple[np.ndarray, np.ndarray]:
        own = np.asarray(r["post"])
        domain = np.maximum(np.asarray(r["domain_counts"]) - own, 0)
        wide = (domain + DOMAIN_WEIGHT * everywhere) / (domain.sum() + DOMAIN_WEIGHT)
        host = np.maximum(np.asarray(r["host_counts"]) - own, 0)
        prior = (host + HOST_WEIGHT * wide) / (host.sum() + HOST_WEIGHT) if r["host"] else everywhere
        rest = np.log(prior)
        if r["declared"] is not None:
            rest = rest + emission[langs.index(r["declared"]) if r["declared"] in langs else k]
        if r["suffix"]:
            seen = np.maximum(np.asarray(r["suffix_counts"]) - own, 0)
            rest = rest + np.log((seen + EMISSION_WEIGHT / n_suffixes) / (overall + EMISSION_WEIGHT))
        ll = np.asarray(r["loglik"])
        # no language at all: every other evidence is the same under it as on average
        none = np.log(np.mean(np.exp(rest)))
        return ll, ll + np.append(rest, none)

    def run(batches):
        names = [*langs, UNDETERMINED]
        for b in batches:
            out = {f.name: [] for f in schema}
            for r in b.to_pylist():
                ll, both = fused(r)
                p = softmax(both)
                best = int(p.argmax())
                row = (r["id"], r["is_html"], r["row_key"], names[best], float(p[best]),
                       names[int(ll.argmax())] if r["n_trigrams"] else UNDETERMINED, r["n_trigrams"],
                       bool(best < k and p[best] >= MIN_PROBABILITY and r["n_trigrams"] > 0))
                for values, v in zip(out.values(), row):
                    values.append(v)
            yield to_batch(out, schema)

    return joined.mapInArrow(run, "id bigint, is_html boolean, row_key bigint, language string, "
                                  "probability double, text_language string, n_trigrams bigint, accepted boolean")


def identify_corpus(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Languages of documents and pages, fused over both; fitted on the
    documents' labels.  doc_id or page_id is null, by the kind of row."""
    evidence = document_evidence(docs).unionByName(page_evidence(pages))
    out = identify(evidence, fit_text_model(docs))
    return out.select(F.when(~F.col("is_html"), F.col("id")).alias("doc_id"),
                      F.when(F.col("is_html"), F.col("id")).alias("page_id"),
                      "language", F.round("probability", 6).alias("probability"), "text_language",
                      "n_trigrams", "accepted")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with their columns,
    whatever the names of further ones."""
    evidence = document_evidence(docs)
    ident, key, own = unused(docs, "_id"), unused(docs, "_key"), unused(docs, "_own")
    rejected = (identify(evidence, fit_text_model(docs)).filter(~F.col("accepted"))
                .select(F.col("id").alias(ident), F.col("row_key").alias(key)).distinct())
    keyed = docs.withColumn(own, F.xxhash64(F.col("text").cast("string"), _primary(F.col("lang")),
                                            F.col("source").cast("string")))
    return keyed.join(rejected, F.col("doc_id").eqNullSafe(F.col(ident)) & (F.col(own) == F.col(key)),
                      "left_anti").select(*docs.columns)
