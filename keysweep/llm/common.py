"""Helpers the operators of this subpackage share: the shared folder, written
intermediate tables, and vectorised words and word shingles.

A *word* is a maximal run of bytes outside ``20 09-0D`` (hex); UTF-8 never puts
those bytes inside a character. Words and shingles are carried as 64-bit hashes
computed with numpy over whole buffers.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.session import session_conf

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WHITE = b" \t\n\x0b\x0c\r"
PIECE = 1 << 18  # bytes hashed at once
# What a task holds at once of the rows it reads and hands to Python: an executor's memory shall not grow with texts.
AT_MOST = {"spark.sql.execution.arrow.maxRecordsPerBatch": 4096, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20, "spark.sql.parquet.columnarReaderBatchSize": 512}

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(WHITE)] = False
_U = np.uint64


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one of its own only where that is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = folder.get() if folder.isDefined() else None
    if not folder:
        folder = tempfile.mkdtemp(prefix="keysweep-llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a new Parquet table in the shared folder and read it back: cuts the
    lineage, so a lost executor costs a re-read and not a re-computation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/keysweep-llm/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with session_conf(spark, **_lower(spark)):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _lower(spark: SparkSession) -> dict[str, str]:
    """The settings of ``AT_MOST`` that are higher (or without bound) in the session."""
    parsed = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    now = {k: parsed(spark.conf.get(k, None) or "0") for k in AT_MOST}
    return {k: str(most) for k, most in AT_MOST.items() if not 0 < now[k] <= most}


def release() -> None:
    """Give memory that is no longer used back to the system: a Python worker lives on after its task, beside an
    executor that then runs other stages, and allocators keep what large arrays and texts took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run):
    """``run`` (a function of batches for ``mapInArrow``) that releases its memory when the task ends."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def lowest_hashes(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The rows with the lowest values of the 64-bit hash ``key``: at least ``n`` (or all there are), about 1.25 n,
    so that an ordered limit on them does not send ``n`` rows of every task to the driver."""
    share = 1.25 * n / max(1, rows.count())
    while share < 1:
        cut = rows.filter(F.col(key) < F.lit(int(share * 2**64) - 2**63).cast("long"))
        if cut.count() >= n:
            return cut
        share *= 2
    return rows


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U))
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_WINDOW = mix(np.arange(1001, 1065, dtype=_U)) | _U(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, _U)
    out[1:] = _U(base)
    return np.multiply.accumulate(out)


_CACHED: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > 2 * PIECE:
        return _powers(_BASE, n), _powers(_BASE_INV, n)
    if not _CACHED:
        _CACHED.update(up=_powers(_BASE, 2 * PIECE), down=_powers(_BASE_INV, 2 * PIECE))
    return _CACHED["up"], _CACHED["down"]


def _hash_buffer(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets and hashes of the words of ``buffer``."""
    a = np.frombuffer(buffer, np.uint8)
    edge = np.diff(np.concatenate(([False], _IS_WORD[a], [False])).view(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.empty(0, _U)
    up, down = _tables(len(a))
    total = np.concatenate((np.zeros(1, _U), np.cumsum(_BYTE[a] * up[: len(a)], dtype=_U)))
    return starts, mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))


def _pieces(doc: bytes) -> list[bytes]:
    """``doc`` cut at white space into pieces of about PIECE bytes."""
    out, at = [], 0
    while len(doc) - at > PIECE:
        cut = max(doc.rfind(c, at, at + PIECE) for c in (WHITE[i : i + 1] for i in range(6)))
        if cut <= at:
            cut = min((x for x in (doc.find(WHITE[i : i + 1], at + 1) for i in range(6)) if x > 0), default=len(doc))
        out.append(doc[at:cut])
        at = cut
    return [*out, doc[at:]]


def word_hashes(docs: list[bytes]) -> list[np.ndarray]:
    """For each document the hashes of its words, in order (equal words, equal hashes, everywhere)."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal group, size
        if group:
            starts, hashes = _hash_buffer(b" ".join(group))
            ends = np.cumsum([len(d) + 1 for d in group])
            out.extend(np.split(hashes, np.searchsorted(starts, ends[:-1])))
        group, size = [], 0

    for doc in docs:
        if len(doc) > PIECE:
            flush()
            out.append(np.concatenate([_hash_buffer(p)[1] for p in _pieces(doc)]))
            continue
        if size + len(doc) + 1 > PIECE:
            flush()
        group.append(doc)
        size += len(doc) + 1
    flush()
    return out


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of the ``k``-word shingles in text order; with fewer words the whole sequence
    is the only one, and without words there is none."""
    n = len(words)
    if n == 0:
        return words
    width = min(n, k)
    total = np.zeros(n - width + 1, _U)
    for j in range(width):
        total += words[j : n - width + 1 + j] * _WINDOW[j]
    return mix(total + _U(width))


def lowered(texts: list) -> list[bytes]:
    """UTF-8 bytes with A-Z lower-cased; null becomes empty."""
    return [(t or "").encode("utf-8", "surrogatepass").translate(LOWER) for t in texts]


U_WINDOW3 = _WINDOW[8:11]


def slices(batch, column: str, rows: int = 4096, size: int = 1 << 24):
    """The Arrow batch cut into pieces of at most ``rows`` rows and about ``size`` bytes of ``column``."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, n = 0, len(lengths)
    ends = np.cumsum(lengths, dtype=np.int64)
    while at < n:
        base = ends[at] - lengths[at]
        stop = min(n, at + rows, max(at + 1, int(np.searchsorted(ends, base + size, "right"))))
        yield batch.slice(at, stop - at)
        at = stop
