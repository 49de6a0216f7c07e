"""Operator 13: vector codes (product quantisation) in whole numbers, by equal-average search.

Each component x becomes floor(256 x); a vector is cut into ``parts`` equal parts. The codebook of
a part position starts as that part of the ``entries`` smallest kept ids. In each round every part
goes to its nearest entry (squared Euclidean distance, ties to the lower index) and each entry becomes
the componentwise floor of its parts' mean; unused entries stay. At the end parts are assigned again.

*Equal-average search*: entries are sorted by component sum. From the place of a part's own sum the
search expands outward, always to the entry whose sum is nearer. For parts of m components the squared
distance is at least (gap of the sums)^2 / m, so a part is done as soon as the next gap^2 exceeds m times
its best distance (strictly, so that ties are seen). All parts of a batch step side by side and leave
when they are done.

Spark job: each round is a pass over the vectors with the codebooks (entries x dimension numbers,
whatever the number of rows); tasks emit one sum for each entry and component, which Spark adds up. Only
sums by entry and the ``entries`` first vectors reach the driver. Sums of labels are joined back by
broadcast up to BROADCAST_LABELS labels, else over SALTS salted copies, so a frequent label is split.

Everything is exact: numpy 64-bit integers while gap^2 and distances fit, else Python integers; sums
travel in limbs of 31 bits where they could pass 2^62. An error (or sum of errors) beyond 2^63 - 1 is null.

Defined cases: rows whose vector is null or has null or non-finite components are dropped; so are rows
whose length is no positive multiple of ``parts``, or differs from that of the smallest kept id (of
equal ids the smallest vector); fewer than ``entries`` rows make as many entries; equal ids are ordered by
their vectors and keep a row each; null ids come last; null labels are one group; extra columns are
ignored; a table without kept rows gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import written

PARTS, ENTRIES, ROUNDS = 16, 64, 2
ROWS = 4096
BROADCAST_LABELS, SALTS = 100_000, 16
LIMB = 31


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(256 x) of finite doubles: 64-bit integers, or Python integers where one has 53 bits or more."""
    scaled = np.abs(values) < 2.0**45
    if scaled.all():
        return np.floor(values * 256).astype(np.int64)
    exact = [math.floor(x * 256) if abs(x) < 2.0**1000 else int(x) * 256 for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def narrow(x: np.ndarray, books: np.ndarray) -> bool:
    """Whether gaps and distances of these vectors and codebooks fit 64 bits."""
    if x.dtype == object or books.dtype == object:
        return False
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(books).max(initial=0)))
    return 2 * largest * books.shape[2] < 2**31


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of ``book`` for each row of ``x`` (ties: the lower index), and the squared distance."""
    n, m = x.shape
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums = sums[order]
    own = x.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    best, code = np.zeros(n, x.dtype), np.full(n, -1, np.int64)
    active = np.arange(n)
    while len(active):
        lo, hi, s = left[active], right[active], own[active]
        has_lo, has_hi = lo >= 0, hi < len(sums)
        gap_lo, gap_hi = s - sums[np.maximum(lo, 0)], sums[np.minimum(hi, len(sums) - 1)] - s
        down = has_lo & (~has_hi | (gap_lo <= gap_hi))
        gap = np.where(down, gap_lo, gap_hi)
        go = (has_lo | has_hi) & ((code[active] < 0) | (gap * gap <= best[active] * m))
        active, down, lo, hi = active[go], down[go], lo[go], hi[go]
        if not len(active):
            break
        entry = order[np.where(down, lo, hi)]
        apart = x[active] - book[entry]
        distance = (apart * apart).sum(axis=1)
        better = (code[active] < 0) | (distance < best[active]) | ((distance == best[active]) & (entry < code[active]))
        best[active[better]], code[active[better]] = distance[better], entry[better]
        left[active[down]] -= 1
        right[active[~down]] += 1
    return code, best


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (row, part) and squared distances of whole-number vectors."""
    parts, _, m = books.shape
    if not narrow(x, books):
        x, books = x.astype(object), books.astype(object)
    codes, errors = np.empty((len(x), parts), np.int64), np.empty((len(x), parts), x.dtype)
    for p in range(parts):
        codes[:, p], errors[:, p] = nearest(x[:, p * m : (p + 1) * m], books[p])
    return codes, errors


def kept_rows(batch: pa.RecordBatch, dimension: int):
    """Places of the kept rows of ``batch`` and their vectors (of ``dimension`` components)."""
    lists = batch.column("vector")
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == dimension)
    values = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dimension)
    fine = np.isfinite(values).all(axis=1)
    return at[fine], values[fine]


def _chunks(batches, dimension: int):
    for batch in batches:
        for i in range(0, len(batch), ROWS):
            rows = batch.slice(i, ROWS)
            at, values = kept_rows(rows, dimension)
            if len(at):
                yield rows, at, whole_numbers(values)


def _sums(books: np.ndarray):
    """Counts and sums of the parts that go to each entry: ``part, entry, place`` (-1: the count), ``limb, value``."""
    parts, entries, m = books.shape

    def run(batches):
        counts, totals = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, m), object)
        for _, at, x in _chunks(batches, parts * m):
            codes, _ = assign(x, books)
            for p in range(parts):
                counts[p] += np.bincount(codes[:, p], minlength=entries)
                own = x[:, p * m : (p + 1) * m]
                if own.dtype != object and int(np.abs(own).max()) < 2**40:
                    block = np.zeros((entries, m), np.int64)
                    np.add.at(block, codes[:, p], own)
                    totals[p] += block
                else:
                    for c, row in zip(codes[:, p], own.astype(object)):
                        totals[p, c] += row
        rows = []
        for p, e in zip(*np.nonzero(counts)):
            rows.append((p, e, -1, 0, counts[p, e]))
            for k in range(m):
                value, limb = int(totals[p, e, k]), 0
                while abs(value) >= 2**LIMB:
                    rows.append((p, e, k, limb, value & (2**LIMB - 1)))
                    value, limb = value >> LIMB, limb + 1
                rows.append((p, e, k, limb, value))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([int(r[i]) for r in rows], k) for i, k in enumerate(kinds)], names=["part", "entry", "place", "limb", "value"])

    return run


def _exact_array(values: list) -> np.ndarray:
    out = np.array(values, object)
    return out.astype(np.int64) if all(abs(int(v)) < 2**53 for v in out.ravel()) else out


def _vectors(df: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    return df.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))


def first_vectors(rows: DataFrame, parts: int, entries: int) -> list[list[float]]:
    """The vectors of the ``entries`` smallest kept ids. The ordered limit is written by a job of its own: the heads
    of all tasks meet in a task, and only the result comes to the driver."""
    number = "x is not null and not isnan(x) and abs(x) < double('infinity')"
    kept = rows.filter(f"size(vector) > 0 and size(vector) % {parts} = 0 and forall(vector, x -> {number})")

    def smallest(df: DataFrame) -> list[list[float]]:
        least = written(df.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries), "first-vectors")
        return [r.vector for r in least.orderBy(F.asc_nulls_last("vec_id"), "vector").collect()]

    found = smallest(kept)
    if found and any(len(v) != len(found[0]) for v in found):
        found = smallest(kept.filter(F.size("vector") == len(found[0])))
    return found


def train_codebooks(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) in whole numbers; no part if no row is kept."""
    rows = _vectors(vectors, vec_id, vector, label)
    first = first_vectors(rows, parts, entries)
    if not first:
        return np.zeros((0, 0, 0), np.int64)
    start = whole_numbers(np.array(first, np.float64))
    books = start.reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums = rows.select("vector").mapInArrow(_sums(books), "part int, entry int, place int, limb int, value long").groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value"))
        totals: dict[tuple[int, int, int], int] = {}
        for r in sums.collect():  # bounded: parts x entries x components
            key = r.part, r.entry, r.place
            totals[key] = totals.get(key, 0) + (r.value << (LIMB * r.limb))
        new = books.astype(object)
        for (p, e, k), value in totals.items():
            if k >= 0:
                new[p, e, k] = value // totals[p, e, -1]
        books = _exact_array(new.tolist())
    return books


def _codes(books: np.ndarray):
    parts, _, m = books.shape

    def run(batches):
        for rows, at, x in _chunks(batches, parts * m):
            codes, errors = assign(x, books)
            text = codes.astype(np.uint8).tobytes().hex()
            error = [int(e) if e < 2**63 else None for e in errors.sum(axis=1)]
            take = pa.array(at)
            columns = [rows.column("vec_id").take(take), rows.column("label").take(take), pa.array([text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return run


def encode_vectors(vectors: DataFrame, books: np.ndarray, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, label, code, error`` of the kept rows."""
    rows = _vectors(vectors, vec_id, vector, label)
    schema = StructType([rows.schema["vec_id"], rows.schema["label"], StructField("code", StringType()), StructField("error", LongType())])
    if not books.size:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
    return rows.mapInArrow(_codes(books), schema)


def decode_vectors(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, approximation`` (components in their own scale) of ``codes(vec_id, code)``; null codes give null."""
    parts, _, m = books.shape

    def run(batches):
        for rows in batches:
            out = []
            for code in rows.column("code").to_pylist():
                at = None if code is None else np.frombuffer(bytes.fromhex(code), np.uint8)
                out.append(None if at is None else (books[np.arange(parts), at].reshape(-1) / 256).tolist())
            yield pa.RecordBatch.from_arrays([rows.column("vec_id"), pa.array(out, pa.list_(pa.float64()))], names=["vec_id", "approximation"])

    kind = codes.schema["vec_id"].dataType.simpleString()
    return codes.select("vec_id", "code").mapInArrow(run, f"vec_id {kind}, approximation array<double>")


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of the kept rows."""
    books = train_codebooks(vectors, vec_id, vector, label, parts, entries, rounds)
    coded = written(encode_vectors(vectors, books, vec_id, vector, label), "vector-codes")
    sums = written(coded.groupBy("label").agg(F.when(F.count("error") == F.count("*"), F.try_sum("error")).alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "of_label")
    if sums.count() <= BROADCAST_LABELS:
        out = coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of_label")))
    else:
        salted = sums.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
        out = rows.join(salted, F.col("label").eqNullSafe(F.col("of_label")) & (F.col("salt") == F.col("of_salt")))
    return out.select("vec_id", "label", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))
