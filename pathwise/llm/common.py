"""Helpers shared by the operators: tables, working files, words and hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Rows handed to Python at a time are cut further so that one slice holds
#: about this many characters (a slice always holds at least one row).
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    A folder of our own is made only where the session names none and runs on
    a local master; on a cluster without one this raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: when an executor is lost, later steps read the files
    again instead of repeating the work above them.
    """
    path = new_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called
    so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else.  For pure ASCII text ``lower`` does
    just that, several times faster than ``translate``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, LOWER))


def slices(batches: Iterable[pa.RecordBatch], text: int = 1) -> Iterator[list[list]]:
    """Python column lists of bounded size; null texts become empty."""
    for b in batches:
        cols = [b.column(i) for i in range(b.num_columns)]
        lengths = np.asarray(pc.fill_null(pc.binary_length(cols[text]), 0))
        cuts, size = [0], 0
        for i, n in enumerate(lengths):
            size += int(n)
            if size >= SLICE_CHARS:
                cuts.append(i + 1)
                size = 0
        if cuts[-1] < b.num_rows:
            cuts.append(b.num_rows)
        for lo, hi in zip(cuts, cuts[1:]):
            out = [c.slice(lo, hi - lo).to_pylist() for c in cols]
            out[text] = [t or ("" if not isinstance(t, bytes) else b"") for t in out[text]]
            yield out


def bounded_batches(spark: SparkSession) -> None:
    """Hand rows to Python some megabytes at a time, whatever the length of
    texts, unless the session itself sets a bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(8 << 20))


def to_batch(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type, from_pandas=False) for f in schema], schema=schema)


_KEPT: dict[str, object] = {}


def kept_in_worker(name: str, make: Callable[[], object]):
    """A table that a Python worker keeps between tasks; one at a time, so
    that the stages of a job do not add up in a worker's memory."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def free_worker() -> None:
    """Drop what earlier stages kept in this Python worker."""
    _KEPT.clear()


# ---- words and hashes -----------------------------------------------------------
def words(text: str, lower: bool = False) -> list[bytes]:
    """Runs of characters other than space and U+0009-000D, in UTF-8.  On
    bytes, ``lower`` and ``split`` know ASCII only, which is what is meant."""
    b = text.encode("utf-8", "surrogatepass")
    return (b.lower() if lower else b).split()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), dtype=np.uint64, count=len(ws))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, in order; with fewer words, of the
    whole sequence as one; of no words, empty."""
    n = len(h)
    if n == 0:
        return h
    k = min(k, n)
    out = np.full(n - k + 1, np.uint64(k))
    for i in range(k):
        out = mix(out * _STEP + h[i:n - k + 1 + i])
    return out


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n (base is odd)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        with np.errstate(over="ignore"):
            up = np.concatenate([[np.uint64(1)], np.full(size - 1, np.uint64(base))]).astype(np.uint64)
            down = np.concatenate([[np.uint64(1)], np.full(size - 1, np.uint64(inverse))]).astype(np.uint64)
            have = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if size <= 1 << 20:
            _POWERS[base] = have
    return have


def window_hashes(h: np.ndarray, length: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of every window of ``length`` words by one running sum: the cost
    does not depend on the length."""
    n = len(h)
    if n < length:
        return np.empty(0, np.uint64)
    up, down = _powers(base, n)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[:n], dtype=np.uint64)])
    return mix((total[length:] - total[:n - length + 1]) * down[:n - length + 1] + np.uint64(length))
