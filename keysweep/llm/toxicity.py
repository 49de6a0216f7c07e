"""Operator 5: toxicity by nearest labelled examples.

Terms are lower-cased words and their 4- and 5-letter beginnings. Of the labelled training
rows (at most ``fit_rows``, chosen by a hash of the id: the documented bound of the fit) those
terms are kept that occur much more often, relative to their class, under one label than
under the other. Every document becomes a sparse TF-IDF vector over the kept terms, from its
whole text; document frequencies are counted over all documents.

The labelled vectors form an inverted index in blocks of BLOCK examples. For each term and
block the index holds the largest weight, so a query has an upper bound for its cosine with
any example of a block; blocks are read in falling order of that bound until none can
beat the ``k``-th best cosine: the neighbours are exact. Their votes, weighted by the
inverse of their cosine distance, and a prior of weight one give a score in [0, 1]; the
neighbours are the evidence. A text without kept terms scores the smoothed share of label 1
among training texts without kept terms.

Labels, language, source and id are inputs of no score (the id only says which labels may
be learned from). Defined cases: null, empty and term-free texts get that last score; a
null ``doc_id`` is never learned from and counts as not held out; null labels are left out;
repeated rows each get a row; conflicting labels of one id both vote; extra columns are
ignored; with no labels at all every score is 0; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, lowest_hashes, slices, written

FIT_ROWS = 12_000
TERMS = 4096
AT_ONCE = 1 << 22  # bytes of text read at once
BLOCK = 32
K = 15
LEAST_ROWS = 4  # rows of a label a kept term occurs in
THRESHOLD = 0.7
LEAST_LIFT = 6.0  # how much more often than under the other label
WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def term_counts(text: str | None, keep: dict[str, int] | None = None) -> Counter:
    """Counts of the terms of a text (only those in ``keep``, if given)."""
    out: Counter = Counter()
    for w, n in Counter(WORD.findall((text or "").lower())).items():
        for t in (w, w[:4] + "+", w[:5] + "+") if len(w) > 5 else (w,) if len(w) < 5 else (w, w[:4] + "+"):
            if keep is None or t in keep:
                out[t] += n
    return out


def _label_terms(batches):
    for b in batches:
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
            for t in term_counts(text):
                counts.setdefault(t, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())], names=["term", "n0", "n1"])


def _vectors(terms: dict[str, int]):
    def run(batches):
        for b in (x for whole in batches for x in slices(whole, "text", size=AT_ONCE)):
            rows = [sorted((terms[t], n) for t, n in term_counts(x, terms).items()) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in b.schema.names if c != "text"), pa.array([[t for t, _ in r] for r in rows], pa.list_(pa.int32())), pa.array([[n for _, n in r] for r in rows], pa.list_(pa.int32()))], names=[*(c for c in b.schema.names if c != "text"), "terms", "counts"])

    return run


def choose_terms(train: DataFrame, most: int = TERMS) -> list[str]:
    """Kept terms of ``train(text, toxic)``: the strongest by log-likelihood ratio."""
    total = {r.toxic: r.n for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = total.get(0, 0), total.get(1, 0)
    if not n0 or not n1:
        return []
    counts = train.select("text", "toxic").mapInArrow(_label_terms, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("a"), F.sum("n1").alias("b"))
    share0, share1 = (F.col("a") + 0.5) / (n0 + 1.0), (F.col("b") + 0.5) / (n1 + 1.0)
    lift = F.greatest(share1 / share0, share0 / share1)
    p = (F.col("a") + F.col("b") + 1.0) / (n0 + n1 + 2.0)
    strength = (F.col("a") + 0.5) * F.log(share0 / p) + (F.col("b") + 0.5) * F.log(share1 / p)
    rows = counts.filter((F.greatest("a", "b") >= LEAST_ROWS) & (lift >= LEAST_LIFT)).orderBy(strength.desc(), "term").limit(most)
    return sorted(r.term for r in rows.select("term").collect())


class BlockMaxIndex:
    """Exact top-k cosines over unit vectors, by blocks with per-term maxima."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: np.ndarray):
        # like vectors side by side make tight bounds: order by the heaviest term, then the next
        order = sorted(range(len(vectors)), key=lambda i: vectors[i][0][np.argsort(-vectors[i][1], kind="stable")][:3].tolist())
        self.labels, self.ids = labels[order], ids[order]
        lengths = np.array([len(vectors[i][0]) for i in order], np.int64)
        row = np.repeat(np.arange(len(order)), lengths)
        term = np.concatenate([vectors[i][0] for i in order]) if order else np.empty(0, np.int64)
        weight = np.concatenate([vectors[i][1] for i in order]) if order else np.empty(0)
        self.blocks = -(-len(order) // BLOCK)
        by = np.lexsort((row, term))
        self.row, term, self.weight = row[by], term[by], weight[by]
        size = int(term.max()) + 1 if len(term) else 0
        self.start = np.searchsorted(term, np.arange(size + 1))
        block_of = self.row // BLOCK
        head = np.flatnonzero(np.diff(term * (self.blocks + 1) + block_of, prepend=-1)) if len(term) else np.empty(0, np.int64)
        self.max_block = block_of[head]
        self.max_weight = np.maximum.reduceat(self.weight, head) if len(head) else np.empty(0)
        self.max_at, self.max_end = head, np.append(head[1:], len(term))
        self.max_start = np.searchsorted(term[head], np.arange(size + 1))

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the ``k`` nearest examples with a cosine above 0 (ties: lower id)."""
        bound = np.zeros(self.blocks)
        spans = [(t, q) for t, q in zip(terms.tolist(), weights.tolist()) if t + 1 < len(self.start)]
        for t, q in spans:
            lo, hi = self.max_start[t], self.max_start[t + 1]
            bound[self.max_block[lo:hi]] += q * self.max_weight[lo:hi]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        got_rows, got_cos = np.empty(0, np.int64), np.empty(0)
        step, at = max(2, k // BLOCK + 2), 0
        while at < len(order):
            if len(got_cos) >= k and bound[order[at]] < got_cos[k - 1] - 1e-12:
                break
            wanted = np.zeros(self.blocks, bool)
            wanted[order[at : at + step]] = True
            cos = {}
            rows, parts = [], []
            for t, q in spans:
                lo, hi = self.max_start[t], self.max_start[t + 1]
                for s, e in ((self.max_at[j], self.max_end[j]) for j in range(lo, hi) if wanted[self.max_block[j]]) if hi - lo < 64 else self._slices(lo, hi, wanted):
                    rows.append(self.row[s:e])
                    parts.append(q * self.weight[s:e])
            if rows:
                found, inverse = np.unique(np.concatenate(rows), return_inverse=True)
                cos = np.bincount(inverse, np.concatenate(parts))
                got_rows, got_cos = np.concatenate([got_rows, found]), np.concatenate([got_cos, cos])
                best = np.lexsort((self.ids[got_rows], -got_cos))[:k]
                got_rows, got_cos = got_rows[best], got_cos[best]
            at += step
            step *= 2
        return got_rows, np.minimum(got_cos, 1.0)

    def _slices(self, lo, hi, wanted):
        keep = np.flatnonzero(wanted[self.max_block[lo:hi]]) + lo
        return zip(self.max_at[keep], self.max_end[keep])


def unit(terms, counts, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    terms = np.asarray(terms, np.int64)
    w = (1 + np.log(np.asarray(counts, float))) * idf[terms] if len(terms) else np.empty(0)
    norm = np.sqrt((w * w).sum())
    return terms, w / norm if norm else w


def vote(cosines: np.ndarray, labels: np.ndarray, prior: float) -> float:
    """Votes by inverse cosine distance; the prior votes with weight one."""
    w = 1 / np.maximum(1 - cosines, 0.05) * cosines
    return float(((w * labels).sum() + prior) / (w.sum() + 1))


class Scorer:
    """Scores and evidence of term vectors; equal vectors are searched once (bounded cache)."""

    def __init__(self, data: dict, k: int):
        self.data, self.k, self.seen = data, k, {}
        ends, terms, counts = data["examples"]
        vectors = [unit(t, c, data["idf"]) for t, c in zip(np.split(terms, ends[:-1]), np.split(counts, ends[:-1]))] if len(ends) else []
        self.index = BlockMaxIndex(vectors, data["labels"], data["ids"])

    def __call__(self, t: list[int], c: list[int]) -> tuple[float, list[int]]:
        if not t:
            return self.data["none"], []
        key = (tuple(t), tuple(c))
        if key not in self.seen:
            if len(self.seen) > 50_000:
                self.seen.clear()
            rows, cos = self.index.search(*unit(t, c, self.data["idf"]), self.k)
            score = vote(cos, self.index.labels[rows], self.data["prior"]) if len(rows) else self.data["none"]
            self.seen[key] = score, self.index.ids[rows].tolist()
        return self.seen[key]


def _score(data: dict, k: int):
    def run(batches):
        scorer = Scorer(data, k)
        for b in batches:
            found = [scorer(t, c) for t, c in zip(b.column("terms").to_pylist(), b.column("counts").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([s for s, _ in found], pa.float64()), pa.array([e for _, e in found], pa.list_(pa.int64()))], names=["doc_id", "score", "evidence"])

    return run


def _below(data: dict, terms: dict[str, int], k: int, threshold: float):
    def run(batches):
        scorer = Scorer(data, k)
        for b in (x for whole in batches for x in slices(whole, "text", size=AT_ONCE)):
            keep = []
            for x in b.column("text").to_pylist():
                row = sorted((terms[t], n) for t, n in term_counts(x, terms).items())
                keep.append(scorer([t for t, _ in row], [n for _, n in row])[0] < threshold)
            yield b.filter(pa.array(keep, pa.bool_()))

    return run


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int) -> tuple[dict[str, int], dict, DataFrame]:
    """Kept terms, what a Scorer needs, and the term vectors of all documents."""
    spark = docs.sparkSession
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fit = labels.filter("toxic in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    fit = fit.filter(~held_out(F.col("doc_id"))).withColumn("h", F.xxhash64("doc_id"))
    fit = lowest_hashes(fit, "h", fit_rows).orderBy("h", "doc_id", "toxic").limit(fit_rows)
    rows = [(r.doc_id, r.toxic) for r in fit.collect()]
    sample = F.broadcast(spark.createDataFrame(rows, "doc_id long, toxic int"))  # fit_rows rows at most
    train = written(text.join(sample, "doc_id").select("doc_id", "text", "toxic"), "train")
    terms = {t: i for i, t in enumerate(choose_terms(train))}
    vectors = written(text.mapInArrow(lean(_vectors(terms)), "doc_id long, terms array<int>, counts array<int>"), "vectors")
    df = np.zeros(len(terms))
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r.t] = r["count"]
    # the same labelled rows whatever copies of an id there are: fit_rows vectors at most
    own = train.dropDuplicates(["doc_id", "toxic"]).select("doc_id", "text", "toxic")
    examples = own.mapInArrow(_vectors(terms), "doc_id long, toxic int, terms array<int>, counts array<int>").orderBy("doc_id", "toxic").collect()
    with_terms = [r for r in examples if r.terms]
    without = [r.toxic for r in examples if not r.terms]
    data = {
        "idf": np.log((vectors.count() + 1) / (df + 1)) + 1,
        "examples": (np.cumsum([len(r.terms) for r in with_terms], dtype=np.int64), np.array([t for r in with_terms for t in r.terms], np.int32), np.array([n for r in with_terms for n in r.counts], np.int32)),
        "labels": np.array([r.toxic for r in with_terms], float),
        "ids": np.array([r.doc_id for r in with_terms], np.int64),
        "prior": (sum(r.toxic for r in examples) + 0.5) / (len(examples) + 1) if examples else 0.0,
        "none": (sum(without) + 0.5) / (len(without) + 1) if without else 0.0,
    }
    return terms, data, vectors


def score_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, k: int = K) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` (ids of the neighbours) for every row of
    ``docs(doc_id, text, ...)``; learns from ``labels(doc_id, toxic, ...)`` outside the held-out third."""
    _, data, vectors = learn(docs, labels, fit_rows)
    scored = vectors.mapInArrow(lean(_score(data, k)), "doc_id long, score double, evidence array<long>")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "evidence")


def filter_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, k: int = K) -> DataFrame:
    """The rows of ``docs``, all its columns, that score below the threshold; no text is moved."""
    terms, data, _ = learn(docs, labels, fit_rows)
    return docs.mapInArrow(lean(_below(data, terms, k, THRESHOLD)), docs.schema)
