"""Deterministic sharded WARC writer and reader.

Records are dealt to shards by ranges of the page id.  The cuts come from a
histogram of bytes that is refined where the data lie: a bin that is too full
is cut again between its least and its largest id, until it holds half a shard
at most or one id; the rows of one id too large for that (or of no id) are
dealt by payload digest.  Each shard's records are sorted and written as one gzip member each, to files rolled by compressed
size.  Which task writes a shard does not matter: names and bytes are the same
in every run.  Headers and digests are made anew from the rows.

A file is written under a temporary name of the attempt and renamed when it is
complete; readers take only the files of the manifest, which Spark commits as
a table.  A lost executor's shard is written again to the same names.

Equal payloads: the smallest page id is the response, others revisit it.  They
are found by digests, summed map-side first; only narrow rows are joined.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwise.llm.common import bounded_batches, new_dir, slices, stage, to_batch

SHARD_BYTES, ROLL_BYTES = 16 << 20, 4 << 20
#: Bytes that a record's headers count for; bins a too full bin is cut into at least.
HEAD_BYTES, LEAST_BINS = 400, 16
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_of(record: str) -> int | None:
    tail = record.strip("<>").rsplit(":", 1)[1]
    return None if tail == "none" else int(tail)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, not compressed.  A revisit keeps the response's HTTP header."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http + payload if refers_to is None else http
    target = quote(url or f"urn:page:{page_id}", safe=":/?#[]@!$&'()*+,;=%-._~")
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE), ("WARC-Target-URI", target),
            ("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    if refers_to is not None:
        head += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block; raises if the record is damaged."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    if not version.startswith("WARC/") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} differs")
    return fields, block


class _Roller:
    """Writes one shard's records to files rolled by compressed size."""

    def __init__(self, folder: str, shard: int, roll: int):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.shard, self.roll, self.seq, self.out = shard, roll, 0, None

    def add(self, raw: bytes) -> dict | None:
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.seq:05d}.warc.gz"
            self.temporary = f"{self.folder}/tmp-{self.name}-{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.temporary)
            self.records = self.bytes = 0
            self.sha = hashlib.sha256()
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = pack.compress(raw) + pack.flush()
        self.out.write(member)
        self.sha.update(member)
        self.records += 1
        self.bytes += len(member)
        return self.close() if self.bytes >= self.roll else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        self.seq += 1
        final = f"{self.folder}/{self.name}"
        try:
            self.fs.move(self.temporary, final)
        except OSError:  # some stores do not replace: an earlier attempt wrote the same bytes
            if self.fs.get_file_info(final).size != self.bytes:
                raise
            self.fs.delete_file(self.temporary)
        return {"file": self.name, "shard": self.shard, "records": self.records, "bytes": self.bytes,
                "sha256": self.sha.hexdigest()}


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, sha1, refers_to of the pages that revisit another."""
    rows = (pages.filter("page_id IS NOT NULL")
            .select("page_id", F.sha1("payload").alias("sha1"), F.sha2("payload", 256).alias("sha256"),
                    F.octet_length("payload").alias("n")).filter(F.col("n") >= least_bytes))
    firsts = (rows.groupBy("sha1", "sha256").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("hi"))
              .filter("refers_to < hi").drop("hi"))
    return (rows.join(stage(firsts, "warc-firsts"), ["sha1", "sha256"]).filter("page_id > refers_to")
            .select("page_id", "sha1", "refers_to").distinct())


class Shards:
    """Which shard a record belongs to.  ``starts``: the least id of each range,
    ascending (the first is open below); ``parts``: how many shards the range's
    records are dealt to by digest (over 1 for a single id); range 0 holds the
    records without an id."""

    def __init__(self, starts: list[int], parts: list[int]):
        self.starts, self.parts = np.array(starts, np.int64), np.array(parts, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.parts)[:-1]])
        self.n = int(self.parts.sum())

    def column(self, page_id: Column, sha1: Column) -> Column:
        starts, parts, first = self.starts, self.parts, self.first

        @F.pandas_udf("int")
        def shard(ids: pd.Series, none: pd.Series, head: pd.Series) -> pd.Series:
            at = np.searchsorted(starts, ids.to_numpy(np.int64), side="right")
            at = np.where(none.to_numpy(bool), 0, np.maximum(at, 1))
            return pd.Series(first[at] + head.to_numpy(np.int64) % parts[at]).astype("int32")

        digits = F.conv(F.substring(sha1, 1, 8), 16, 10).cast("bigint")
        return shard(F.coalesce(page_id, F.lit(0).cast("bigint")), page_id.isNull(), digits)


def plan_shards(sizes: DataFrame, shard_bytes: int) -> Shards:
    """Ranges of about ``shard_bytes`` from a table of (page_id, bytes).

    A pass per refinement; what a pass collects is some rows per shard.
    """
    none, total = 0, 0
    for r in sizes.groupBy(F.col("page_id").isNull().alias("none")).agg(F.sum("bytes").alias("n")).collect():
        none, total = (r["n"], total) if r["none"] else (none, r["n"])
    ids = sizes.filter("page_id IS NOT NULL")
    done: list[tuple[int, int, int]] = []        # least id, largest id, bytes
    edges: list[int] = [-2 ** 63]
    while True:
        cuts = np.array(edges, np.int64)

        @F.pandas_udf("int")
        def bin_of(values: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(cuts, values.to_numpy(np.int64), side="right")).astype("int32")

        bins = (ids.groupBy(bin_of("page_id").alias("bin"))
                .agg(F.sum("bytes").alias("n"), F.min("page_id").alias("lo"), F.max("page_id").alias("hi")).collect())
        done = sorted((r["lo"], r["hi"], r["n"]) for r in bins)
        heavy = [(lo, hi, n) for lo, hi, n in done if 2 * n > shard_bytes and lo < hi]
        if not heavy:
            break
        more = set()
        for lo, hi, n in heavy:
            cut_into = min(max(LEAST_BINS, -(-4 * n // shard_bytes)), hi - lo + 1)
            more.update(lo + (hi - lo + 1) * i // cut_into for i in range(cut_into))
            if hi < 2 ** 63 - 1:
                more.add(hi + 1)
        edges = sorted({*edges, *more})
    starts, parts, held = [], [max(1, -(-none // shard_bytes))], 0
    for lo, hi, n in done:
        alone = n > shard_bytes                  # one id, then
        if not starts or alone or parts[-1] > 1 or held + n > shard_bytes:
            starts.append(lo)
            parts.append(-(-n // shard_bytes) if alone else 1)
            held = 0
        held += n
    return Shards(starts or [0], parts if len(parts) > 1 else [*parts, 1])


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0,
                   shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> tuple[str, DataFrame]:
    """Write a record per row (page_id, url, html) and return the folder and
    the manifest: file, shard, records, bytes, sha256.

    Null html is an empty payload.  Rows with a null id are responses, written
    to the first shards; rows that repeat an id and a payload are
    responses or revisits alike.  A null url is replaced by the record's id;
    characters not allowed in a URI are percent-encoded.  Other columns are
    ignored.
    """
    bounded_batches(pages.sparkSession)
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    folder = folder or new_dir(spark, "warc")
    sizes = stage(rows.select("page_id", (F.octet_length("payload") + HEAD_BYTES).cast("bigint").alias("bytes")),
                  "warc-sizes")
    shards = plan_shards(sizes, shard_bytes)
    marks = revisits(rows, least_bytes)
    union = (rows.select("page_id", F.lit(1).alias("kind"), "url", "payload",
                         F.lit(None).cast("string").alias("sha1"), F.lit(None).cast("bigint").alias("refers_to"))
             .unionByName(marks.select("page_id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
                                       F.lit(None).cast("string").alias("payload"), "sha1", "refers_to"))
             .withColumn("shard", shards.column(F.col("page_id"), F.coalesce("sha1", F.sha1("payload")))))
    # ties in the order are broken by the record's content: the files are the same in every run
    dealt = (union.repartitionById(shards.n, F.col("shard"))
             .sortWithinPartitions("shard", "page_id", "kind", "url", F.sha1("payload")))
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    schema = pa.schema([("file", pa.string()), ("shard", pa.int32()), ("records", pa.int64()),
                        ("bytes", pa.int64()), ("sha256", pa.string())])

    def run(batches):
        roller, marks_of, page = None, {}, object()
        done: list[dict | None] = []
        for shards, payloads, ids, kinds, urls, sha1s, refers in slices(batches):
            for shard, payload, page_id, kind, url, sha1, first in zip(
                    shards, payloads, ids, kinds, urls, sha1s, refers):
                if roller is None or roller.shard != shard:
                    done.append(roller and roller.close())
                    roller = _Roller(folder, shard, roll_bytes)
                if page_id != page:
                    marks_of, page = {}, page_id
                if kind == 0:
                    marks_of[sha1] = first
                    continue
                body = payload.encode("utf-8", "surrogatepass")
                refers_to = marks_of.get(hashlib.sha1(body).hexdigest()) if marks_of else None
                done.append(roller.add(record(page_id, url, body, refers_to)))
        done.append(roller and roller.close())
        done = [d for d in done if d]
        yield to_batch({f.name: [d[f.name] for d in done] for f in schema}, schema)

    manifest = dealt.select("shard", "payload", "page_id", "kind", "url", "sha1", "refers_to").mapInArrow(
        run, "file string, shard int, records bigint, bytes bigint, sha256 string")
    return folder, stage(manifest, "warc-manifest")


def _records(stream) -> Iterator[bytes]:
    """The records of one file, one gzip member each, read as a stream."""
    rest, unpack, held = b"", zlib.decompressobj(31), []
    while True:
        rest = rest or stream.read(1 << 20)
        if not rest:
            if held:
                raise ValueError("the file ends inside a record")
            return
        held.append(unpack.decompress(rest))
        rest = b""
        if unpack.eof:
            yield b"".join(held)
            rest, unpack, held = unpack.unused_data, zlib.decompressobj(31), []


def read_archives(folder: str, manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the manifest's files: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to and, if wanted, payload (null for
    revisits).  Digests are checked; a damaged or missing file is an error."""
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
              ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    schema = pa.schema(fields + [("payload", pa.binary())] * with_payload)

    def run(batches):
        files, path = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for name, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out, size, seen = {f.name: [] for f in schema}, 0, 0
                with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for raw in _records(stream):
                        head, block = parse(raw)
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(http.rsplit(b"Content-Length: ", 1)[1])
                        response = head["WARC-Type"] == "response"
                        want = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if response and (len(payload) != length or digest(payload) != want):
                            raise ValueError(f"payload digest of {head['WARC-Record-ID']} differs")
                        row = [_page_of(head["WARC-Record-ID"]), head["WARC-Target-URI"], length, want,
                               head["WARC-Type"], None if response else _page_of(head["WARC-Refers-To"])]
                        for values, v in zip(out.values(), row + [payload if response else None]):
                            values.append(v)
                        seen += 1
                        size += len(payload)
                        if size >= 8 << 20 and with_payload:
                            yield to_batch(out, schema)
                            out, size = {f.name: [] for f in schema}, 0
                if seen != records:
                    raise ValueError(f"{name} holds {seen} records, the manifest says {records}")
                yield to_batch(out, schema)

    ddl = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
           "refers_to bigint" + (", payload binary" if with_payload else ""))
    n = max(1, manifest.count())
    return manifest.select("file", "records").repartition(n).mapInArrow(run, ddl)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages and read the archives back."""
    folder, manifest = write_archives(pages)
    return read_archives(folder, manifest)
