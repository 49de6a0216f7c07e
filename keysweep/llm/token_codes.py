"""Operator 1: token ids as directly addressable codes (DACs).

Ids are cut into byte-wide chunks from the low end. Level 0 holds the low byte of every id
and a bitmap that says which ids go on; level 1 holds the next byte of those, and so on.
A rank directory (one count for every 512 bits) gives the place of an id's next chunk, so
any id is read with one lookup per level, without decoding its neighbours.

Files: a Parquet folder, one row for each *segment* (consecutive whole documents of one
range of ``doc_id``, about SEGMENT ids): ``part`` (range), ``seg``, ``before`` (ids of the
part before it), ``n_ids``, the document directory (``docs``, ``nulls``, ``ends``) and for each
level its bytes, bitmap and rank directory. Ranges follow ``doc_id``, so the ids of the whole
folder, in (part, seg) order, are the ids in ascending ``doc_id`` order.

Encoding goes through the tokenizers library, each distinct piece between lone spaces once
per worker (a bounded cache): the pre-tokenizer of byte-level BPE never joins characters
across such a space, so the ids are those of the whole text.

Defined cases: null text is empty (its only id is the end id); a null ``doc_id`` sorts
first; equal ``doc_id`` values stay separate documents, ordered by text; extra columns are
ignored; an empty table gives an empty folder.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions

SEGMENT = 1 << 19
RANK_BITS = 512
TEXT_BYTES = 1 << 21  # text encoded at once


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where it is a
    printable Latin-1 character, else the next code point from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class _Slots(dict):
    """Number of each piece; a piece not met before gets the next one and is noted in ``new``."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.new.append(piece)
        return n


class PieceCache:
    """Ids of text pieces, each encoded once while it stays in a cache of bounded size."""

    def __init__(self, encode, entries: int = 1_200_000, longest: int = 4096):
        self.encode, self.entries, self.longest = encode, entries, longest
        self.reset()

    def reset(self) -> None:
        self.slots = _Slots()
        self.flat = np.empty(1 << 16, np.uint32)
        self.starts, self.sizes = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.n_ids = 0

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.empty(max(n, 2 * len(a)) - len(a), a.dtype)])

    def ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``pieces`` in order, and the number of ids of each."""
        if len(self.slots) > self.entries:
            self.reset()
        known = len(self.slots)
        at = np.fromiter(map(self.slots.__getitem__, pieces), np.int64, len(pieces))
        new, self.slots.new = self.slots.new, []
        if new:
            coded = self.encode(new)
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            total = int(sizes.sum())
            self.flat = self._room(self.flat, self.n_ids + total)
            self.flat[self.n_ids : self.n_ids + total] = np.fromiter(chain.from_iterable(coded), np.uint32, total)
            self.starts, self.sizes = self._room(self.starts, known + len(new)), self._room(self.sizes, known + len(new))
            self.starts[known : known + len(new)] = self.n_ids + np.cumsum(sizes) - sizes
            self.sizes[known : known + len(new)] = sizes
            self.n_ids += total
        sizes = self.sizes[at]
        shift = self.starts[at] - (np.cumsum(sizes) - sizes)
        out = self.flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]
        if new and max(map(len, new)) > self.longest:  # very long pieces are not kept
            self.reset()
        return out, sizes


class WordCache(dict):
    """Ids of single words, in a dict of bounded size."""

    def __init__(self, encode, entries: int = 600_000):
        self.encode, self.entries = encode, entries

    def learn(self, words) -> None:
        if len(self) > self.entries:
            self.clear()
        new = [w for w in dict.fromkeys(words) if w not in self]
        self.update(zip(new, self.encode(new)))


MARKS = frozenset(".,;:!?")


def simple(piece: str) -> bool:
    """Letters, perhaps with one mark after them: every pre-tokenizer used here cuts it between the two."""
    return piece.isalpha() or (piece[-1:] in MARKS and piece[:-1].isalpha())


_SPACES = re.compile(r"\s ")
_LONE = re.compile(r"(?<=\S) (?=\S)")
_ENCODERS: dict[str, tuple] = {}


def _byte_bpe(path: str) -> tuple[PieceCache, PieceCache]:
    """Caches of the pieces that start a text, and of those that follow a lone space."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        tokenize = tok.model.tokenize
        stand_in = {b: c for b, c in enumerate(byte_letters())}

        def library(pieces: list[str]) -> list[list[int]]:
            return [e.ids for e in tok.encode_batch_fast(pieces, add_special_tokens=False)]

        def model(words: list[str]) -> list[list[int]]:
            """One pre-token each (a space and letters, or a mark): straight to the library's model."""
            return [[t.id for t in tokenize(w.encode().decode("latin-1").translate(stand_in))] for w in words]

        words = WordCache(model)

        def encode(pieces: list[str]) -> list[list[int]]:
            plain = [p if p.isalpha() else p[:-1] for p in pieces if simple(p)]
            words.learn([*(" " + p for p in plain), *MARKS])
            other = iter(library([" " + p for p in pieces if not simple(p)]))
            return [(words[" " + p] if p.isalpha() else words[" " + p[:-1]] + words[p[-1]]) if simple(p) else next(other) for p in pieces]

        _ENCODERS[path] = PieceCache(library, 100_000), PieceCache(encode)
    return _ENCODERS[path]


def encode_texts(texts: list, path: str) -> list[np.ndarray]:
    """Ids of every text (null: empty), as the tokenizers library encodes it without special tokens added.

    A text is cut before every lone space, where the pre-tokenizer always cuts too."""
    first, rest = _byte_bpe(path)
    out, group, size = [], [], 0

    def flush() -> None:
        nonlocal group, size
        if group:
            head, n_head = first.ids([p[0] for p in group])
            ids, sizes = rest.ids([x for p in group for x in p[1:]])
            ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum([len(p) - 1 for p in group])]
            heads = np.split(head, np.cumsum(n_head)[:-1])
            out.extend(np.concatenate(x) for x in zip(heads, np.split(ids, ends[:-1])))
        group, size = [], 0

    for t in texts:
        t = t or ""
        group.append(_LONE.split(t) if _SPACES.search(t) else t.split(" "))
        size += len(t)
        if size > TEXT_BYTES:
            flush()
    flush()
    return out


def dac_encode(ids: np.ndarray) -> list[dict]:
    """The levels of the codes of ``ids``: bytes, continuation bitmap, rank directory."""
    levels, rest = [], np.asarray(ids, np.uint32)
    while len(rest):
        on = rest > 255
        bits = np.packbits(on, bitorder="little")
        counts = np.add.reduceat(on, np.arange(0, len(on), RANK_BITS), dtype=np.int64)
        levels.append({"chunks": (rest & 255).astype(np.uint8).tobytes(), "bits": bits.tobytes(), "ranks": (np.cumsum(counts) - counts).astype(np.uint32).tobytes()})
        rest = rest[on] >> 8
    return levels


def dac_decode(levels: list[dict]) -> np.ndarray:
    """All ids of one segment."""
    out, at = np.empty(0, np.uint32), None
    for k, level in enumerate(levels):
        chunks = np.frombuffer(level["chunks"], np.uint8).astype(np.uint32)
        if k == 0:
            out, at = chunks, np.arange(len(chunks))
        else:
            out[at] |= chunks << np.uint32(8 * k)
        on = np.unpackbits(np.frombuffer(level["bits"], np.uint8), count=len(chunks), bitorder="little").astype(bool)
        at = at[on]
    return out


def dac_access(levels: list[dict], i: int) -> int:
    """Id ``i`` of a segment: one chunk, one bit and one rank for each level it has."""
    value = 0
    for k, level in enumerate(levels):
        value |= level["chunks"][i] << (8 * k)
        if not level["bits"][i >> 3] >> (i & 7) & 1:
            break
        block = i // RANK_BITS
        bits = np.frombuffer(level["bits"], np.uint8, (i >> 3) - block * (RANK_BITS // 8) + 1, block * (RANK_BITS // 8))
        inside = int(np.unpackbits(bits, bitorder="little")[: i - block * RANK_BITS].sum())
        i = int(np.frombuffer(level["ranks"], np.uint32, 1, 4 * block)[0]) + inside
    return value


SCHEMA = "part int, seg int, before long, n_ids long, docs binary, nulls binary, ends binary, levels array<struct<chunks:binary,bits:binary,ranks:binary>>"
_LEVEL = pa.struct([("chunks", pa.binary()), ("bits", pa.binary()), ("ranks", pa.binary())])
_ARROW = pa.schema([("part", pa.int32()), ("seg", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("docs", pa.binary()), ("nulls", pa.binary()), ("ends", pa.binary()), ("levels", pa.list_(_LEVEL))])


def _write_segments(path: str, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        part, seg, before = TaskContext.get().partitionId(), 0, 0
        docs, lists, size = [], [], 0

        def segment():
            nonlocal seg, before, docs, lists, size
            ids = np.concatenate(lists)
            row = {"part": part, "seg": seg, "before": before, "n_ids": size, "docs": np.array([d or 0 for d in docs], np.int64).tobytes(), "nulls": bytes(d is None for d in docs), "ends": np.cumsum([len(x) for x in lists]).astype(np.int64).tobytes(), "levels": dac_encode(ids)}
            seg, before, docs, lists, size = seg + 1, before + size, [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for b in batches:
            for i in range(0, len(b), 256):
                rows = b.slice(i, 256)
                for d, ids in zip(rows.column("doc_id").to_pylist(), encode_texts(rows.column("text").to_pylist(), path)):
                    docs.append(d)
                    lists.append(np.append(ids, np.uint32(end_id)))
                    size += len(ids) + 1
                    if size >= SEGMENT:
                        yield segment()
        if docs:
            yield segment()

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> None:
    """Encode every row of ``docs(doc_id, text, ...)`` and write the codes to ``folder``."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # the hash splits one doc_id that holds many rows
    ranged = text.withColumn("h", F.xxhash64("text")).repartitionByRange(partitions(docs.sparkSession), "doc_id", "h")
    ranged = ranged.sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    ranged.mapInArrow(_write_segments(tokenizer, end_id), SCHEMA).write.mode("errorifexists").parquet(folder)


def _bases(segments: DataFrame) -> dict[int, int]:
    """Ids before each part; one row for each write task reaches the driver."""
    out, total = {}, 0
    for r in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        out[r.part] = total
        total += r.n
    return out


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(folder)


def _documents(bases: dict[int, int]):
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids, ends = dac_decode(r["levels"]), np.frombuffer(r["ends"], np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                first = bases[r["part"]] + r["before"]
                docs = [None if null else int(d) for d, null in zip(np.frombuffer(r["docs"], np.int64), r["nulls"])]
                crcs = [zlib.crc32(ids[s:e].astype("<u4").tobytes()) for s, e in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(first + starts), pa.array(ends - starts), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of ``folder``, decoded from its codes."""
    segments = read_segments(spark, folder)
    return segments.mapInArrow(_documents(_bases(segments)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _access(batches):
    for b in batches:
        for r in b.to_pylist():
            ids = [dac_access(r["levels"], p - r["first"]) for p in r["positions"]]
            yield pa.RecordBatch.from_arrays([pa.array(r["positions"], pa.int64()), pa.array(ids, pa.int64())], names=["position", "token_id"])


def tokens_at(spark: SparkSession, folder: str, positions: DataFrame) -> DataFrame:
    """``position, token_id`` for each distinct ``position`` (place among the ids of the whole folder);
    places outside are left out. Joins on grid cells of SEGMENT ids, then reads single ids."""
    segments = read_segments(spark, folder)
    bases = _bases(segments)
    base = spark.createDataFrame(list(bases.items()), "part int, base long")
    placed = segments.join(F.broadcast(base), "part").withColumn("first", F.col("base") + F.col("before"))
    heads = placed.select("part", "seg", "first", "n_ids").withColumn("cell", F.explode(F.sequence(F.expr(f"first div {SEGMENT}"), F.expr(f"(first + n_ids - 1) div {SEGMENT}"))))
    wanted = positions.select(F.col("position").cast("long").alias("position")).filter("position is not null").distinct().withColumn("cell", F.expr(f"position div {SEGMENT}"))
    found = wanted.join(heads, "cell").filter("position >= first and position < first + n_ids")
    found = found.groupBy("part", "seg", "first").agg(F.collect_list("position").alias("positions"))  # at most a segment's ids
    return found.join(segments.select("part", "seg", "levels"), ["part", "seg"]).select("positions", "first", "levels").mapInArrow(_access, "position long, token_id long")
