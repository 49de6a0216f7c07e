"""Operator 2: n-gram Jaccard join by multiple-global-order filtering.

Documents are sets of distinct 5-word shingles. Two documents link when
``100 * |A & B| >= 75 * |A | B|`` (threshold as a ratio of integers). Steps:

1. one pass computes each document's set size and a 64-bit signature of the set. Documents
   with one signature have the same set: they form one *class*, and everything below runs
   on classes;
2. a second pass deals the shingle hashes out by hash range, packed (not one row per
   shingle: 6 bytes, 2 for the class's place in its batch and a few compressed bits); one task
   per range counts in how many classes a shingle occurs and drops those of a single class,
   which can neither generate a candidate nor overlap. (Copies are joined inside a batch;
   copies in other batches are known in step 3 by their number.)
   The rest goes back to the batch it came from. Shingles that some batch shows to be in a large part of all classes (proved to be at
   most ``hot_share`` times the mean set size) skip this exchange: their order is known,
   so no range gets a hot shingle's classes;
3. per class the remaining shingles are put into several global orders (all start with
   the class's own unshared shingles; A: exact frequency, B and C: frequency octave and a
   hash). A class's prefix under an order is its first ``n - ceil(0.75 n) + 1`` shingles;
4. classes sharing a prefix token of order A meet. A pair goes on only if its prefixes
   under orders B and C can meet too (64-bit fingerprints of the prefixes, which never
   lose a shared token), and if sizes and shared-shingle counts allow the overlap;
5. groups are cut into blocks and block pairs are verified exactly; a task returns a
   spanning forest of the links it finds, never all pairs. A third of all classes under
   one token therefore spreads over many tasks.

Defined cases: null, empty and blank texts have an empty set, link with nothing and are
their own component; repeated rows and equal ``doc_id`` values are separate rows of one
class; a null ``doc_id`` keeps its row (its component is the smallest non-null id of its
group, or null); extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, lowered, mix, partitions, shingles, slices, word_hashes, written
from .components import components

U = np.uint64
BLOCK = 512  # classes of one block in step 5
AT_ONCE = 1 << 21  # bytes of text held as words at once
RANGE_ITEMS = 2_000_000  # shingles a range task holds on average
PARTS = 4  # of the hashes, in which a slice's shingles are sorted
HOT_FREQUENCY = 2**31 - 1


def _sets(rows: pa.RecordBatch, k: int) -> list[np.ndarray]:
    """The sets of a slice; texts and words of a few megabytes at a time."""
    return [np.unique(shingles(w, k)) for part in slices(rows, "text", size=AT_ONCE) for w in word_hashes(lowered(part.column("text").to_pylist()))]


def _signature(s: np.ndarray) -> int:
    """Hash of a set; order plays no part."""
    total = np.add.reduce(mix(s ^ U(0xA5A5A5A5)), dtype=U, keepdims=True)
    return int(mix(total ^ mix(np.array([len(s)], U))).view(np.int64)[0])


def _distinct(sets: list[np.ndarray]) -> dict[int, np.ndarray]:
    return {_signature(s): s for s in sets if len(s)}


def _by_range(sets: list[np.ndarray], ranges: int):
    """The shingles of sorted sets and the places of their sets, a few ranges of hashes at a time (of ``ranges``, dealt
    by the top 32 bits), so that the forms they take next are never there for all of them."""
    firsts = np.unique(np.arange(PARTS) * ranges // PARTS)[1:]
    cuts = np.array([-(-(int(r) << 32) // ranges) << 32 for r in firsts], U)
    at = np.array([[0, *np.searchsorted(s, cuts), len(s)] for s in sets], np.int64).reshape(len(sets), len(cuts) + 2)
    for lo, hi in zip(at.T[:-1], at.T[1:]):
        if (hi > lo).any():
            yield np.concatenate([s[i:j] for s, i, j in zip(sets, lo, hi)]), np.repeat(np.arange(len(sets), dtype=np.uint16), hi - lo)


def _scan(k: int, hot_share: int):
    def run(batches):
        for b in (x for whole in batches for x in slices(whole, "text")):
            sets = _sets(b, k)
            sigs = [_signature(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array([0] * len(sets), pa.int8()), b.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.int64())], names=["kind", "doc_id", "n", "sig"])
            own = {s: x for s, x in zip(sigs, sets) if s is not None}
            del sets
            for part, _ in _by_range(list(own.values()), PARTS):
                tokens, counts = np.unique(part, return_counts=True)
                keep = counts >= max(3, len(own) / hot_share)
                tokens, counts = tokens[keep].view(np.int64), counts[keep]
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(tokens), np.int8)), pa.nulls(len(tokens), pa.int64()), pa.array(counts.astype(np.int64)), pa.array(tokens)], names=["kind", "doc_id", "n", "sig"])

    return run


#: One packed row: ``kind`` 0 shingles on the way to their range, 1 hot or shared shingles on the
#: way back to their batch, 2 the classes of a batch. ``to`` is the range or the batch. A shingle is
#: cut into its top 16 bits (sorted, so they compress) and the rest.
PACKED = "kind byte, to long, batch long, high binary, low binary, own binary, freqs binary"
_ARROW = pa.schema([("kind", pa.int8()), ("to", pa.int64()), ("batch", pa.int64()), *((c, pa.binary()) for c in ("high", "low", "own", "freqs"))])


def _packed(kind: int, to: int, batch: int, tokens: np.ndarray, own: np.ndarray, freqs: np.ndarray) -> dict:
    """``tokens`` in rising order; ``own`` is the place of the class in its batch."""
    six = tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return {"kind": kind, "to": to, "batch": batch, "high": (tokens >> U(48)).astype(np.uint16).tobytes(), "low": np.ascontiguousarray(six).tobytes(), "own": own.astype(np.uint16).tobytes(), "freqs": freqs.astype(np.int32).tobytes()}


def _unpack(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Batch, place in the batch, token and frequency of all entries."""
    whole = lambda c, kind: np.frombuffer(b"".join(t.column(c).to_pylist()), kind)
    own, high = whole("own", np.uint16), whole("high", np.uint16)
    eight = np.empty((len(own), 4), np.uint16)  # three parts of the low 48 bits, then the high 16
    eight[:, :3] = whole("low", np.uint16).reshape(-1, 3)
    eight[:, 3] = high
    sizes = [len(x) // 2 for x in t.column("own").to_pylist()]
    return np.repeat(t.column("batch").to_numpy(), sizes), own, eight.reshape(-1).view("<u8"), whole("freqs", np.int32)


_NONE = np.empty(0, np.int32)


def _emit(k: int, hot: bytes, ranges: int):
    def run(batches):
        from pyspark import TaskContext

        hots, number = np.frombuffer(hot, U), TaskContext.get().partitionId() << 32
        for b in (x for whole in batches for x in slices(whole, "text")):
            own = _distinct(_sets(b, k))
            if not own:
                continue
            number += 1
            sizes, sigs = np.array([len(s) for s in own.values()]), np.fromiter(own, np.int64, len(own))
            yield pa.RecordBatch.from_pylist([{"kind": 2, "to": number, "batch": number, "high": b"", "low": sigs.tobytes(), "own": b"", "freqs": sizes.astype(np.int32).tobytes()}], schema=_ARROW)
            for tokens, place in _by_range(list(own.values()), ranges):
                by = np.argsort(tokens, kind="stable")
                tokens, place = tokens[by], place[by]
                if len(hots):
                    is_hot = np.isin(tokens, hots)
                    if is_hot.any():
                        yield pa.RecordBatch.from_pylist([_packed(1, number, number, tokens[is_hot], place[is_hot], np.full(int(is_hot.sum()), HOT_FREQUENCY))], schema=_ARROW)
                        tokens, place = tokens[~is_hot], place[~is_hot]
                # the top 32 bits deal the ranges, in rising order
                at = ((tokens >> U(32)) * U(ranges) >> U(32)).astype(np.int32)
                heads = np.flatnonzero(np.diff(at, prepend=-1)) if len(at) else np.empty(0, np.int64)
                to, edges = at[heads], np.append(heads, len(tokens))
                for i in range(0, len(heads), 16):
                    part = range(i, min(i + 16, len(heads)))
                    yield pa.RecordBatch.from_pylist([_packed(0, int(to[e]), number, tokens[edges[e] : edges[e + 1]], place[edges[e] : edges[e + 1]], _NONE) for e in part], schema=_ARROW)

    return run


def _shared_only(t: pa.Table) -> pa.Table:
    """The shingles of one range that more than one class has, back to the batches."""
    if t.column("kind")[0].as_py():  # hot shingles and classes go on to their batch
        return t
    batch, place, tokens, _ = _unpack(t)
    names, batch = np.unique(batch, return_inverse=True)
    batch = batch.astype(np.int32)
    by = np.argsort(tokens, kind="stable")
    batch, place, tokens = batch[by], place[by], tokens[by]
    del by
    head = np.flatnonzero(np.diff(tokens, prepend=tokens[:1] ^ U(1)))
    times = np.diff(head, append=len(tokens))
    several = np.repeat(times > 1, times)
    freqs = np.repeat(np.minimum(times, HOT_FREQUENCY - 1).astype(np.int32)[times > 1], times[times > 1])
    batch, place, tokens = batch[several], place[several], tokens[several]
    del several
    by = np.argsort(batch, kind="stable")  # tokens stay in rising order inside a batch
    batch, place, tokens, freqs = names[batch[by]], place[by], tokens[by], freqs[by]
    edges = np.flatnonzero(np.diff(batch, prepend=-1, append=-1)) if len(batch) else []
    rows = [_packed(1, int(batch[lo]), int(batch[lo]), tokens[lo:hi], place[lo:hi], freqs[lo:hi]) for lo, hi in zip(edges[:-1], edges[1:])]
    return pa.Table.from_pylist(rows, schema=_ARROW)


def _fingerprint(tokens: np.ndarray) -> int:
    bits = U(1) << (mix(tokens) & U(63)) if len(tokens) else np.zeros(1, U)
    return int(np.bitwise_or.reduce(bits).view(np.int64))


CLASS = "sig long, n long, shared long, tokens binary, prefix array<long>, fb long, fc long"


def _of_batch(t: pa.Table) -> pa.Table:
    """The classes of one batch that can have a shared shingle in their prefix, shingles in order A."""
    kinds = t.column("kind").to_numpy()
    table = t.slice(int(np.flatnonzero(kinds == 2)[0]), 1)
    sigs, sizes = np.frombuffer(table.column("low")[0].as_py(), np.int64), np.frombuffer(table.column("freqs")[0].as_py(), np.int32)
    _, place, tokens, freqs = _unpack(t.filter(pa.array(kinds == 1)))
    order = np.lexsort((tokens, freqs, place))
    place, tokens, freqs = place[order], tokens[order], freqs[order]
    heads = np.flatnonzero(np.diff(place.astype(int), prepend=-1))
    out = []
    for lo, hi in zip(heads, [*heads[1:], len(place)]):
        n = int(sizes[place[lo]])
        if _take(n, hi - lo) > 0:
            out.append({"sig": int(sigs[place[lo]]), "n": n, "tokens": tokens[lo:hi].tobytes(), "freqs": freqs[lo:hi].tobytes()})
    return pa.Table.from_pylist(out, schema=pa.schema([("sig", pa.int64()), ("n", pa.int64()), ("tokens", pa.binary()), ("freqs", pa.binary())]))


def _take(n: int, shared: int) -> int:
    """What the unshared shingles leave of a prefix."""
    return n - (3 * n + 3) // 4 + 1 - (n - shared)


def _prefixes(batches):
    """Shared shingles and prefixes of the classes; a shingle no more frequent than the class's own
    copies (``copies`` batches have one) is its own."""
    for b in batches:
        out = []
        for sig, copies, n, tokens, freqs in zip(*(b.column(c).to_pylist() for c in ("sig", "copies", "n", "tokens", "freqs"))):
            tokens, freqs = np.frombuffer(tokens, U), np.frombuffer(freqs, np.int32)
            tokens, freqs = tokens[freqs > copies], freqs[freqs > copies]
            take = _take(n, len(tokens))
            if take <= 0:
                continue
            octave = np.log2(freqs).astype(int)
            two, three = (tokens[np.lexsort((mix(tokens ^ U(salt)), octave))][:take] for salt in (11, 23))
            out.append({"sig": sig, "n": n, "shared": len(tokens), "tokens": tokens.tobytes(), "prefix": tokens[:take].view(np.int64).tolist(), "fb": _fingerprint(two), "fc": _fingerprint(three)})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("sig", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("tokens", pa.binary()), ("prefix", pa.list_(pa.int64())), ("fb", pa.int64()), ("fc", pa.int64())]))


def _verify(t: pa.Table) -> pa.Table:
    """Links of one block pair, as a spanning forest."""
    lo, hi = t.column("i")[0].as_py(), t.column("j")[0].as_py()
    sigs, n, shared, fb, fc, block = (t.column(c).to_numpy() for c in ("sig", "n", "shared", "fb", "fc", "block"))
    arrays = [np.frombuffer(x, U) for x in t.column("tokens").to_pylist()]
    order = np.argsort(sigs, kind="stable")
    sigs, n, shared, fb, fc, block, arrays = sigs[order], n[order], shared[order], fb[order], fc[order], block[order], [arrays[i] for i in order]
    lengths = np.array([len(a) for a in arrays])
    codes = np.unique(np.concatenate(arrays), return_inverse=True)[1]
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    mark = np.zeros(codes.max() + 1, np.int64)
    known = t.column("root").to_numpy()[order]
    root = np.unique(known, return_index=True, return_inverse=True)  # classes already connected count as one
    root = root[1][root[2]].tolist()

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x in np.flatnonzero(block == lo):
        other = block == hi
        other[: x + 1 if lo == hi else 0] = False
        need = (3 * (n[x] + n) + 6) // 7
        other &= (np.minimum(shared[x], shared) >= need) & ((fb & fb[x]) != 0) & ((fc & fc[x]) != 0)
        ys = [y for y in np.flatnonzero(other) if find(y) != find(x)]
        if not ys:
            continue
        mine = codes[offsets[x] : offsets[x + 1]]
        mark[mine] = 1
        for y in ys:
            if find(y) == find(x):
                continue
            both = int(mark[codes[offsets[y] : offsets[y + 1]]].sum())
            if 7 * both >= 3 * (n[x] + n[y]):  # both / union >= 3/4
                root[find(y)] = find(x)
                out.append((int(sigs[x]), int(sigs[y])))
        mark[mine] = 0
    return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})


def _star(pairs):
    """Exact check of (x, pivot) rows that carry both token lists."""
    for b in pairs:
        keep = []
        for i, (x, y, nx, ny) in enumerate(zip(*(b.column(c).to_pylist() for c in ("tokens", "ptokens", "n", "pn")))):
            if 7 * len(np.intersect1d(np.frombuffer(x, U), np.frombuffer(y, U), assume_unique=True)) >= 3 * (nx + ny):
                keep.append(i)
        yield pa.RecordBatch.from_arrays([b.column("sig").take(pa.array(keep, pa.int64())), b.column("psig").take(pa.array(keep, pa.int64()))], names=["a", "b"])


def near_duplicates(docs: DataFrame, k: int = 5, hot_share: int = 32) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs(doc_id, text, ...)``."""
    spark = docs.sparkSession
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scan = written(text.mapInArrow(lean(_scan(k, hot_share)), "kind byte, doc_id long, n long, sig long"), "sets", ["kind"])
    members = scan.filter("kind = 0").select("doc_id", "n", "sig")
    stats = members.agg(F.approx_count_distinct("sig").alias("classes"), F.sum("n").alias("items")).first()
    classes, items = int(stats.classes or 0), int(stats.items or 0)
    # at most 2 * hot_share * (mean set size) shingles reach this share of the classes
    hot = scan.filter("kind = 1").groupBy("sig").agg(F.sum("n").alias("m")).filter(F.col("m") >= max(64, classes / (2 * hot_share))).select("sig")
    hot_bytes = np.sort(np.array([r.sig for r in hot.collect()], np.int64).view(U)).tobytes()
    ranges = max(partitions(spark), -(-items // RANGE_ITEMS))

    dealt = text.mapInArrow(lean(_emit(k, hot_bytes, ranges)), PACKED)
    shared = dealt.groupBy("kind", "to").applyInArrow(_shared_only, PACKED)
    of_batch = shared.groupBy("to").applyInArrow(_of_batch, "sig long, n long, tokens binary, freqs binary")
    # copies of a set in several batches give equal rows
    of_class = of_batch.groupBy("sig").agg(F.count("*").alias("copies"), F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.first("freqs").alias("freqs"))
    table = written(of_class.mapInArrow(lean(_prefixes), CLASS), "classes")

    slim = table.select("sig", "n", "shared", "fb", "fc", F.explode("prefix").alias("token"))
    # round 1: each class against one pivot for each of its tokens, the class with the fewest unshared shingles
    pivot = slim.groupBy("token").agg(F.count("*").alias("m"), F.min(F.struct((F.col("n") - F.col("shared")).alias("u"), "sig", "n", "shared")).alias("p")).filter("m > 1")
    slim = slim.join(pivot, "token")
    fits = lambda na, sa, nb, sb: 7 * F.least(sa, sb) >= 3 * (na + nb)
    pairs = slim.filter((F.col("sig") != F.col("p.sig")) & fits(F.col("n"), F.col("shared"), F.col("p.n"), F.col("p.shared"))).select("sig", F.col("p.sig").alias("psig")).distinct()
    left, right = table.select("sig", "n", "tokens"), table.select(F.col("sig").alias("psig"), F.col("n").alias("pn"), F.col("tokens").alias("ptokens"))
    first = written(pairs.join(left, "sig").join(right, "psig").select("sig", "psig", "n", "pn", "tokens", "ptokens").mapInArrow(lean(_star), "a long, b long"), "links")
    roots = components(first)

    # round 2: token groups that still hold several components, in blocks
    slim = written(slim.join(roots, slim.sig == roots.v, "left").select("sig", "n", "shared", "fb", "fc", "token", F.coalesce("root", "sig").alias("root")), "left")
    # a class goes on where a class of another component can fit its size and its shared shingles: the least
    # size and the least deficit in the group, each over the other components
    deficit = 3 * F.col("n") - 7 * F.col("shared")
    each = written(slim.groupBy("token", "root").agg(F.min("n").alias("least"), F.min(deficit).alias("deficit")), "group-stats")
    first_of = each.groupBy("token").agg(F.min(F.struct("least", "root")).alias("l"), F.min(F.struct("deficit", "root")).alias("d"), F.count("*").alias("roots")).filter("roots > 1")
    stat = each.join(first_of, "token").groupBy("token", "l", "d").agg(F.min(F.when(F.col("root") != F.col("l.root"), F.col("least"))).alias("l2"), F.min(F.when(F.col("root") != F.col("d.root"), F.col("deficit"))).alias("d2"))
    other_least = F.when(F.col("root") == F.col("l.root"), F.col("l2")).otherwise(F.col("l.least"))
    other_deficit = F.when(F.col("root") == F.col("d.root"), F.col("d2")).otherwise(F.col("d.deficit"))
    slim = slim.join(stat, "token").filter((3 * (F.col("n") + other_least) <= 7 * F.col("shared")) & (3 * F.col("n") + other_deficit <= 0))
    slim = written(slim.select("sig", "n", "shared", "fb", "fc", "token", "root"), "crossing")
    again = slim.groupBy("token").agg(F.count("*").alias("kept"), F.min("root").alias("k0"), F.max("root").alias("k1"), F.bit_xor(F.xxhash64("sig")).alias("m0"), F.bit_xor(F.xxhash64("sig", F.lit(3))).alias("m1")).filter("k0 <> k1")
    # the tokens of one passage mostly have the same classes: equal groups (by size and a 128-bit hash of the members) are checked once
    again = again.groupBy("kept", "m0", "m1").agg(F.min("token").alias("token")).select("token", "kept")
    slim = slim.join(again, "token")
    blocks = F.ceil(F.col("kept") / BLOCK).cast("long")
    slim = slim.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks")))
    # each class goes to every block pair that its block is part of; a class of block b meets (i, j) with i = b or j = b
    slim = slim.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    slim = slim.select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "sig", "root", "shared", "fb", "fc")
    work = slim.join(table.select("sig", "n", "tokens"), "sig")
    second = written(work.groupBy("token", "i", "j").applyInArrow(_verify, "a long, b long"), "links")
    links = first.unionByName(second)
    roots = components(links)

    keyed = members.join(roots, members.sig == roots.v, "left").select("doc_id", "n", F.coalesce("root", "sig").alias("group"))
    smallest = keyed.filter(F.col("group").isNotNull()).groupBy("group").agg(F.min("doc_id").alias("component_id"))
    named = keyed.join(smallest, "group", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
