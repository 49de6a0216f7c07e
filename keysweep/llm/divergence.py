"""Operator 12: source divergence audit by a sparse merge for every pair of groups.

A *term* is a run of ASCII letters and non-ASCII characters, A-Z lower-cased. Each ``lang``
keeps the terms that ``least_docs`` of its documents have. With c the count of a term in a group
(the documents of one ``lang`` and ``source``) or in a whole ``lang``, N the sum of c over the kept
terms and V their number, its price is p = 1 + floor(10^9 (c + 5) / (N + 5 V)).

1. Terms are counted in the tasks that read the documents and added up by (lang, source, term).
2. Kept terms are sorted by (lang, UTF-8 term) over ranges and dealt into *blocks* of at most
   BLOCK_TERMS terms of one lang (and about BLOCK_ENTRIES counts). A block has for each group a sorted
   array of term numbers and one of counts, and a row with the terms and counts of the lang.
3. Pair tasks: for every unordered pair of groups of a lang, and for every group and its lang, the two
   array rows of a block are co-grouped. A galloping intersection finds the common terms; common and
   one-sided terms are priced both ways there, terms that both lack once at the end.

A task holds two arrays of one block, however large a group is. All numbers are exact: prices by
long division, sums far below 2^63 for corpora of up to 9 * 10^15 terms.

Results, best first within a group: ``pair``, for each other source of the lang the sum of abs(p - q)
over all kept terms; ``term``, for kept terms that the group has and prices above its lang, p - q, down
to rank ``top``. Ties go to the smaller item in UTF-8.

Defined cases: null text, lang and source are empty strings; a group without terms has N = 0; a lang
without kept terms has value 0 for all pairs and no ``term`` rows; a lang with one source has no ``pair``
rows; repeated rows count each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, slices, written

LEAST_DOCS, TOP = 30, 50
BLOCK_TERMS, BLOCK_ENTRIES = 1 << 15, 1 << 18
HELD = 150_000  # terms of all groups that a counting task holds before it passes them on
SCALE, PRIOR = 10**9, 5

#: Letters stay (lower-cased) and so do the bytes of non-ASCII characters; all else becomes a space.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_PIECE = 1 << 22


def terms_of(text: str):
    """The terms of ``text`` as UTF-8, some at a time."""
    data = text.encode("utf-8").translate(_TERM_BYTES)
    at = 0
    while at < len(data):
        stop = data.find(b" ", at + _PIECE)
        stop = len(data) if stop < 0 else stop
        yield data[at:stop].split()
        at = stop


def _count(batches):
    """Partial counts ``n`` and document frequencies ``df``; every group also has a row with an empty term."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flush():
        for (lang, source), (n, df) in held.items():
            terms = list(n)
            for i in range(0, len(terms), 1 << 16):
                part = terms[i : i + (1 << 16)]
                columns = [pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] for t in part], pa.int64()), pa.array([df[t] for t in part], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "df"])
        held.clear()

    for batch in batches:
        for rows in slices(batch, "text", rows=1024, size=1 << 22):
            for lang, source, text in zip(*(rows.column(c).to_pylist() for c in ("lang", "source", "text"))):
                if (lang, source) not in held:
                    held[lang, source] = Counter({b"": 0}), Counter({b"": 0})
                    size += 1
                n, df = held[lang, source]
                size -= len(n)
                seen: set[bytes] = set()
                for terms in terms_of(text):
                    n.update(terms)
                    seen.update(terms)
                df.update(seen)
                size += len(n)
                if size > HELD:
                    yield from flush()
                    size = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, df``: occurrences and documents; one more row with an empty term for each group."""
    text = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    partial = text.mapInArrow(_count, "lang string, source string, term string, n long, df long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


BLOCK = "lang string, block long, source string, whole boolean, ids array<int>, counts array<long>, terms array<string>"


def _pack(batches):
    """Blocks from rows sorted by (lang, term, source)."""
    base, made = TaskContext.get().partitionId() << 32, 0
    lang, terms, totals, entries, groups = None, [], [], 0, {}

    def block():
        nonlocal made, terms, totals, entries, groups
        if terms:
            rows = [(lang, base + made, s, False, ids, counts, None) for s, (ids, counts) in groups.items()]
            rows.append((lang, base + made, None, True, list(range(len(terms))), totals, terms))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string()))
            names = ["lang", "block", "source", "whole", "ids", "counts", "terms"]
            for i in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[i : i + 64]], kind) for k, kind in enumerate(kinds)], names=names)
            made += 1
        terms, totals, entries, groups = [], [], 0, {}

    for batch in batches:
        for row_lang, term, source, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "term", "source", "n"))):
            if row_lang != lang or not terms or term != terms[-1]:
                if row_lang != lang or len(terms) >= BLOCK_TERMS or entries >= BLOCK_ENTRIES:
                    yield from block()
                    lang = row_lang
                terms.append(term)
                totals.append(0)
            ids, counts = groups.setdefault(source, ([], []))
            ids.append(len(terms) - 1)
            counts.append(n)
            totals[-1] += n
            entries += 1
    yield from block()


def pack_blocks(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The blocks of the terms that ``least_docs`` documents of their lang have."""
    found = counts.filter("term != ''").withColumn("all_df", F.sum("df").over(Window.partitionBy("lang", "term")))
    kept = found.filter(F.col("all_df") >= least_docs).select("lang", "term", "source", "n")
    kept = written(kept, "kept-terms")
    ranges = kept.repartitionByRange(partitions(kept.sparkSession), "lang", "term").sortWithinPartitions("lang", "term", "source")
    return ranges.mapInArrow(_pack, BLOCK)


def price(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """1 + floor(10^9 (c + 5) / (n + 5 v)), by long division in base 1,000."""
    of = n + PRIOR * v
    rest, out = np.asarray(counts, np.int64) + PRIOR, np.zeros(len(counts), np.int64)
    whole, rest = rest // of, rest % of
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // of
        rest = rest % of
    return 1 + whole * SCALE + out


def gallop(short: np.ndarray, long: np.ndarray, run: int = 32) -> np.ndarray:
    """Places of the sorted ``short`` in the sorted ``long``. Every 32nd is found by bisection; each next one from
    the place of the one before it, in doubling steps and then halving ones, all runs side by side."""
    n, size = len(short), len(long)
    if not n or not size:
        return np.zeros(n, np.int64)
    keys = np.resize(short, (-(-n // run), run)) if n % run == 0 else np.concatenate([short, np.full(-n % run, short[-1])]).reshape(-1, run)
    places = np.empty(keys.shape, np.int64)
    places[:, 0] = np.searchsorted(long, keys[:, 0])
    for k in range(1, run):
        low, key, stride = places[:, k - 1].copy(), keys[:, k], 1
        while True:  # long[low] < key, as far as low goes on
            ahead = low + stride
            goes = (ahead <= size) & (long[np.minimum(ahead, size) - 1] < key)
            if not goes.any():
                break
            low = np.where(goes, ahead, low)
            stride *= 2
        while stride > 1:
            stride //= 2
            ahead = low + stride
            low = np.where((ahead <= size) & (long[np.minimum(ahead, size) - 1] < key), ahead, low)
        places[:, k] = low
    return places.reshape(-1)[:n]


def common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the values that both have (sorted, without repeats)."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    at = gallop(short, long)
    hit = at < len(long)
    hit[hit] = long[at[hit]] == short[hit]
    in_short, in_long = np.flatnonzero(hit), at[hit]
    return (in_short, in_long) if short is a else (in_long, in_short)


TASK = "lang string, source string, other string, whole boolean, priced long, seen long, item string, value long"


def _pair_task(key, left: pa.Table, right: pa.Table) -> pa.Table:
    lang, _, source, whole, other = (k.as_py() for k in key)

    def side(t: pa.Table):
        if not t.num_rows:
            return np.empty(0, np.int64), np.empty(0, np.int64), 0, 0
        ids, counts = (t.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("ids", "counts"))
        return ids, counts, t.column("size")[0].as_py(), t.column("n_kept")[0].as_py()

    (a, ca, na, v), (b, cb, nb, vb) = side(left), side(right)
    other_n = (left if left.num_rows else right).column("other_size")[0].as_py()
    v = v or vb
    if not left.num_rows:
        na = other_n
    if not right.num_rows:
        nb = other_n
    pa_, pb = price(ca, na, v), price(cb, nb, v)
    in_a, in_b = common(a, b)
    if whole:  # the lang has every term of the group
        more = pa_[in_a] - pb[in_b]
        terms = right.column("terms").combine_chunks().flatten().take(pa.array(in_b))
        best = np.lexsort((in_b, -more))
        best = best[more[best] > 0][:TOP]
        rows = [(lang, source, other, True, 0, 0, t, int(x)) for t, x in zip(terms.take(pa.array(best)).to_pylist(), more[best])]
    else:
        no_a, no_b = price(np.zeros(1, np.int64), na, v)[0], price(np.zeros(1, np.int64), nb, v)[0]
        only_a, only_b = np.ones(len(a), bool), np.ones(len(b), bool)
        only_a[in_a] = only_b[in_b] = False
        total = np.abs(pa_[in_a] - pb[in_b]).sum() + np.abs(pa_[only_a] - no_b).sum() + np.abs(pb[only_b] - no_a).sum()
        rows = [(lang, source, other, False, int(total), len(a) + len(b) - len(in_a), None, None)]
    kinds = (pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.int64())
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[f.split()[0] for f in TASK.split(", ")])


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` for ``docs(lang, source, text, ...)``; ``top`` is at most TOP."""
    if top > TOP:
        raise ValueError(f"a task keeps {TOP} terms")
    counts = written(term_counts(docs), "term-counts")
    blocks = written(pack_blocks(counts, least_docs), "term-blocks")
    sums = blocks.select("lang", "source", "whole", F.expr("aggregate(counts, 0L, (x, y) -> x + y)").alias("size"), F.size("ids").alias("terms"))
    sums = sums.groupBy("lang", "source", "whole").agg(F.sum("size").alias("size"), F.sum("terms").alias("terms"))
    langs = sums.filter("whole").select("lang", F.col("size").alias("lang_size"), F.col("terms").alias("n_kept"))
    groups = counts.filter("term = ''").select("lang", "source").join(sums.filter("not whole").select("lang", "source", "size"), ["lang", "source"], "left").join(langs, "lang", "left")
    groups = written(groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("size", "lang_size", "n_kept"))), "term-groups")

    a, b = groups.select("lang", "source", "size", "n_kept"), groups.select("lang", F.col("source").alias("other"), F.col("size").alias("other_size"))
    pairs = a.join(b, "lang").filter("source < other").withColumn("whole", F.lit(False))
    lang_pairs = groups.select("lang", "source", "size", "n_kept", F.lit("").alias("other"), F.col("lang_size").alias("other_size"), F.lit(True).alias("whole"))
    tasks = pairs.unionByName(lang_pairs)

    own = blocks.filter("not whole").select("lang", "block", "source", "ids", "counts", "terms")
    left = own.join(tasks, ["lang", "source"])
    swapped = pairs.select("lang", "source", "other", "whole", "n_kept", F.col("other_size").alias("size"), F.col("size").alias("other_size"))
    right = own.withColumnRenamed("source", "other").join(swapped, ["lang", "other"])
    all_lang = blocks.filter("whole").select("lang", "block", "ids", "counts", "terms")
    in_block = own.select("lang", "block", "source").join(groups, ["lang", "source"]).select("lang", "block", "source", F.col("lang_size").alias("size"), "n_kept", F.col("size").alias("other_size"))
    right = right.unionByName(all_lang.join(in_block, ["lang", "block"]).withColumns({"other": F.lit(""), "whole": F.lit(True)}))
    keys = ["lang", "block", "source", "whole", "other"]
    left, right = (df.select(*(F.col(c).alias(c) for c in df.columns)) for df in (left, right))  # columns of their own: both come from the blocks
    done = written(left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(_pair_task, TASK), "pair-tasks")

    priced = done.filter("not whole").groupBy("lang", "source", "other").agg(F.sum("priced").alias("priced"), F.sum("seen").alias("seen"))

    def absent(size: str) -> str:
        """The price of a term that the group lacks, in whole numbers."""
        return f"({SCALE * PRIOR}L div ({size} + {PRIOR} * n_kept))"

    value = F.expr(f"if(n_kept = 0, 0L, coalesce(priced, 0L) + (n_kept - coalesce(seen, 0L)) * abs({absent('size')} - {absent('other_size')}))")
    values = pairs.join(priced, ["lang", "source", "other"], "left").select("lang", "source", "other", value.alias("value"))
    both = values.select("lang", "source", F.col("other").alias("item"), "value").union(values.select("lang", "other", "source", "value"))
    terms = done.filter("whole").select("lang", "source", "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.withColumn("rank", F.row_number().over(order)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return ranked(both, "pair").unionByName(ranked(terms, "term").filter(F.col("rank") <= top))
