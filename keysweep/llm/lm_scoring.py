"""Operator 6: language-model scores by masked pseudo-likelihood.

A window network predicts a masked word from the words on both sides: each of the 2 * SIDE
places has its own embedding table; their sum goes through tanh, and a two-level softmax (class
of the word, word within the class) gives the conditional probability. The score of a
document is the sum of the log-probabilities of all its words, each given its neighbours.

* Vocabulary: every word of the corpus, with its count, in a Spark table. The most frequent get softmax ids of
  their own; each other word belongs to one of the hashed groups, and its probability is that of the group times
  its share of the group: its count over the group's count plus one (the one is the share of unseen words). The
  shares are joined to the words of the texts, so the vocabulary is never in one place.
* Training, in numpy inside the tasks, over all positions of every document: a hash of (document, position)
  deals them to MASK_ONE_IN masks, each used once; a round takes its part of the masks. Each task
  descends from the common start over its rows; the parameters are averaged, weighted by
  the positions seen, over two levels of groups, so that no task gets all of them. ROUNDS rounds.
* Only the model (a few hundred kB, a size fixed by the constants below) reaches the driver.

Defined cases: null, empty and blank texts have no words, log-likelihood 0 and null
per-word values; a null ``doc_id`` keeps its row; repeated rows each get a row; extra
columns are ignored; on an empty table the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lowered, mix, word_hashes, written

CLASSES, IN_CLASS = 32, 32
WORDS = 896  # softmax ids of single words; the other 128 of 1024 are groups, with a share for each word in them
HIDDEN, SIDE = 16, 2
MASK_ONE_IN = 8
ROUNDS = 2
RATE = 0.1
STEP = 512  # positions of one descent step
V, PAD = CLASSES * IN_CLASS, CLASSES * IN_CLASS
BLOCKS = 16  # pieces the parameters travel in
SLOT = np.uint64(48)  # words are looked up by the bits of their hash above this one


def _counts(batches):
    for b in batches:
        words = word_hashes(lowered(b.column("text").to_pylist()))
        found, n = np.unique(np.concatenate(words), return_counts=True) if words else (np.empty(0, np.uint64), np.empty(0, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])


class Vocabulary:
    def __init__(self, words: np.ndarray):
        order = np.argsort(words)
        self.words, self.ids = words[order], order.astype(np.int64)
        # for the first bits of a hash, the first word that has them or greater ones
        slots = np.arange(1 << (64 - int(SLOT)), dtype=np.uint64)
        self.first = np.minimum(np.searchsorted(self.words >> SLOT, slots), max(0, len(words) - 1)).astype(np.int32)

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        out = WORDS + (mix(hashes) % np.uint64(V - WORDS)).astype(np.int64)
        if not len(self.words):
            return out
        at, left = self.first[hashes >> SLOT], np.arange(len(hashes))
        while len(left):
            word = self.words[at]
            own = word == hashes[left]
            out[left[own]] = self.ids[at[own]]
            on = np.flatnonzero((word < hashes[left]) & (at < len(self.words) - 1))
            at, left = at[on] + 1, left[on]
        return out

    def encode_texts(self, texts: list) -> list:
        """The ids of each text (as word hashes)."""
        return np.split(self.encode(np.concatenate(texts)), np.cumsum([len(t) for t in texts])[:-1]) if texts else []


def outside(texts: list, ids: list) -> tuple[list, list]:
    """For each text (as word hashes, with their ids) its distinct words without an id of their own, and how often each occurs."""
    found = [np.unique(w[d >= WORDS], return_counts=True) for w, d in zip(texts, ids)]
    return [w.view(np.int64) for w, _ in found], [n for _, n in found]


def _group_counts(vocabulary: Vocabulary):
    def run(batches):
        total = np.zeros(V, np.int64)
        for b in batches:
            words = b.column("word").to_numpy().view(np.uint64)
            np.add.at(total, vocabulary.encode(words), b.column("n").to_numpy())
        ids = np.flatnonzero(total[WORDS:]) + WORDS
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(total[ids])], names=["id", "n"])

    return run


SHAPES = {"embed": (2 * SIDE, V + 1, HIDDEN), "bias": (HIDDEN,), "classes": (HIDDEN + 1, CLASSES), "words": (CLASSES, HIDDEN + 1, IN_CLASS)}


def start() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(7)
    return {k: (rng.normal(0, 0.1, s) if k == "embed" else np.zeros(s) if k != "classes" and k != "words" else rng.normal(0, 0.05, s)).astype(np.float32) for k, s in SHAPES.items()}


def flat(p: dict) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def shaped(x: np.ndarray) -> dict:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = x[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


def contexts(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(positions, 2 * SIDE) ids around each word, and the words; PAD beyond a document's ends."""
    pad = np.full(SIDE, PAD, np.int64)
    line = np.concatenate([x for d in ids for x in (pad, d)] + [pad]).astype(np.int16)
    own = np.flatnonzero(line != PAD)
    around = np.stack([line[own + o] for o in (*range(-SIDE, 0), *range(1, SIDE + 1))], 1)
    return around, line[own]


def _places(around):
    """Rows of the embedding tables, one below the other, of the words around each position."""
    return (around + np.arange(2 * SIDE) * (V + 1)).astype(np.int16)


def _hidden(p, places):
    embed = p["embed"].reshape(-1, HIDDEN)
    h = np.ones((len(places), HIDDEN + 1), np.float32)
    total = p["bias"] + embed.take(places[:, 0], 0)
    for j in range(1, 2 * SIDE):
        total += embed.take(places[:, j], 0)
    np.tanh(total, out=h[:, :HIDDEN])
    return h


def _by_class(target) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """The order of targets by class (positions of a class as before), and the slice of each class met."""
    kind = (target // IN_CLASS).astype(np.int16)  # numpy sorts short integers by radix
    order = np.argsort(kind, kind="stable")
    edges = np.concatenate(([0], np.cumsum(np.bincount(kind, minlength=CLASSES)))).tolist()
    return order, [(c, slice(edges[c], edges[c + 1])) for c in range(CLASSES) if edges[c] < edges[c + 1]]


def _logits(weights, h, spans):
    """A row for each position: the scores of the words of its class."""
    z = np.empty((len(h), IN_CLASS), np.float32)
    for c, own in spans:
        np.dot(h[own], weights[c], out=z[own])
    return z.T.copy()


def _softmax(z):
    """Of each column; in place."""
    z -= z.max(0)
    np.exp(z, out=z)
    z /= z.sum(0)
    return z


def _log_share(z, target):
    """Log of the softmax of each column, at ``target``."""
    z -= z.max(0)
    own = z[target, np.arange(z.shape[1])]
    return own - np.log(np.exp(z, out=z).sum(0))


def log_probability(p: dict, around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-probability of each target given the words around it."""
    out = np.empty(len(target))
    for i in range(0, len(target), 1 << 13):
        t = target[i : i + (1 << 13)]
        order, spans = _by_class(t)
        t = t[order]
        h = _hidden(p, _places(around[i : i + (1 << 13)][order]))
        lp = _log_share(p["classes"].T @ h.T, t // IN_CLASS)
        lp += _log_share(_logits(p["words"], h, spans), t % IN_CLASS)
        out[i + order] = lp
    return out


def descend(p: dict, square: dict, around: np.ndarray, target: np.ndarray, rate: float = RATE) -> None:
    """One Adagrad step on a batch of masked positions."""
    order, spans = _by_class(target)
    around, target = _places(around[order]), target[order]
    at = np.arange(len(target))
    h = _hidden(p, around)
    g = _softmax(p["classes"].T @ h.T)
    g[target // IN_CLASS, at] -= 1
    grads = {"classes": h.T @ g.T}
    gw = _softmax(_logits(p["words"], h, spans))
    gw[target % IN_CLASS, at] -= 1
    gw = gw.T.copy()
    turned = p["words"].transpose(0, 2, 1).copy()
    words = np.zeros(SHAPES["words"], np.float32)
    back = np.empty_like(h)
    for c, own in spans:
        mine = gw[own]
        np.dot(h[own].T, mine, out=words[c])
        np.dot(mine, turned[c], out=back[own])
    grads["words"] = words
    back += g.T @ p["classes"].T
    back = (back * (1 - h * h))[:, :HIDDEN]
    grads["bias"] = back.sum(0)
    for k, x in grads.items():
        square[k] += x * x
        p[k] -= rate * x / (np.sqrt(square[k]) + 1e-6)
    # only the embeddings met have a gradient
    places = around.ravel()
    by = np.argsort(places, kind="stable")
    places = places[by]
    last = np.append(np.flatnonzero(places[1:] != places[:-1]), len(places) - 1)
    # sums of the rows of each place, as differences of running sums; two columns as one complex number are added at once
    total = np.cumsum(back.take(by // (2 * SIDE), 0).astype(np.float64).view(np.complex128), 0).take(last, 0)
    total[1:] -= total[:-1].copy()
    x, ids = total.view(np.float64).astype(np.float32), places[last]
    embed, met = p["embed"].reshape(-1, HIDDEN), square["embed"].reshape(-1, HIDDEN)
    squares = met.take(ids, 0) + x * x
    met[ids] = squares
    embed[ids] -= rate * x / (np.sqrt(squares) + 1e-6)


def _train(vocabulary: Vocabulary, model: np.ndarray, turn: int):
    def run(batches):
        from pyspark import TaskContext

        p = shaped(model)
        square = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
        seen = 0
        for b in batches:
            texts = b.column("text").to_pylist()
            for i in range(0, len(texts), 256):
                ids = vocabulary.encode_texts(word_hashes(lowered(texts[i : i + 256])))
                if not sum(map(len, ids)):
                    continue
                around, target = contexts(ids)
                key = np.repeat(np.array([len(d) + int(d[:8].sum()) for d in ids], np.uint64), [len(d) for d in ids])
                mask = mix(key * np.uint64(2654435761) + np.arange(len(target), dtype=np.uint64)) % np.uint64(MASK_ONE_IN)
                for m in range(turn, MASK_ONE_IN, ROUNDS):
                    pick = np.flatnonzero(mask == m)
                    for j in range(0, len(pick), STEP):
                        descend(p, square, around[pick[j : j + STEP]], target[pick[j : j + STEP]])
                    seen += len(pick)
        if seen:
            pieces = np.array_split(flat(p), BLOCKS)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()] * BLOCKS, pa.int32()), pa.array(range(BLOCKS), pa.int32()), pa.array([seen] * BLOCKS, pa.int64()), pa.array([(x * np.float32(seen)).astype(np.float32).tobytes() for x in pieces], pa.binary())], names=["task", "block", "n", "data"])

    return run


def _add(t: pa.Table) -> pa.Table:
    total = np.add.reduce([np.frombuffer(x, np.float32).astype(np.float64) for x in t.column("data").to_pylist()])
    return pa.table({"task": pa.array([0], pa.int32()), "block": t.column("block").slice(0, 1), "n": pa.array([sum(t.column("n").to_pylist())], pa.int64()), "data": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def train_model(docs: DataFrame) -> tuple[Vocabulary, np.ndarray, DataFrame]:
    """Words with softmax ids, the parameters, and the table of all words with their counts."""
    text = docs.select("text")
    counts = written(text.mapInArrow(_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    top = [r.word for r in counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()]
    vocabulary, model = Vocabulary(np.array(top, np.int64).view(np.uint64)), flat(start())
    schema = "task int, block int, n long, data binary"
    for turn in range(ROUNDS):
        parts = text.mapInArrow(_train(vocabulary, model, turn), schema)
        some = parts.withColumn("some", F.col("task") % 64).groupBy("block", "some").applyInArrow(lambda t: _add(t), schema)
        rows = sorted(some.groupBy("block").applyInArrow(lambda t: _add(t), schema).collect(), key=lambda r: r.block)
        if rows:
            model = np.concatenate([np.frombuffer(bytes(r.data), np.float32) / np.float32(r.n) for r in rows])
    return vocabulary, model, counts


_SCORED = "row long, doc_id long, n_words long, log_likelihood double, words array<long>, often array<long>"


def _score(vocabulary: Vocabulary, model: np.ndarray, groups: np.ndarray):
    """Scores with each word outside the softmax counted once in its group; the join adds the log of its count."""
    share = -np.log(groups + 1.0) * (np.arange(V) >= WORDS)

    def run(batches):
        p = shaped(model)
        for b in batches:
            for i in range(0, len(b), 256):
                rows = b.slice(i, 256)
                hashes = word_hashes(lowered(rows.column("text").to_pylist()))
                ids = vocabulary.encode_texts(hashes)
                n = np.array([len(d) for d in ids], np.int64)
                lp = log_probability(p, *contexts(ids)) + share[np.concatenate(ids)] if n.sum() else np.empty(0)
                words, often = outside(hashes, ids)
                total = np.add.reduceat(np.append(lp, 0.0), np.minimum(np.cumsum(n) - n, len(lp))) * (n > 0) if len(n) else np.empty(0)
                yield pa.RecordBatch.from_arrays([rows.column("row"), rows.column("doc_id"), pa.array(n), pa.array(total.astype(float)), pa.array(words, pa.list_(pa.int64())), pa.array(often, pa.list_(pa.int64()))], names=[c.split()[0] for c in _SCORED.split(", ")])

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, log_likelihood, per_word, perplexity`` for every row of ``docs(doc_id, text, ...)``,
    under a model trained on all of ``docs``."""
    vocabulary, model, counts = train_model(docs)
    groups = np.zeros(V)
    for r in counts.mapInArrow(_group_counts(vocabulary), "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        groups[r.id] = r.n
    text = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = written(text.mapInArrow(_score(vocabulary, model, groups), _SCORED), "scored")
    pairs = scored.select("row", F.explode(F.arrays_zip("words", "often")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.often").alias("often"))
    # a count of one adds nothing, nor does an unseen word
    shares = counts.filter("n > 1").select("word", F.log("n").alias("log_n"))
    added = pairs.join(shares, "word").groupBy("row").agg(F.sum(F.col("often") * F.col("log_n")).alias("added"))
    scored = scored.drop("words", "often").join(added, "row", "left")
    scored = scored.select("doc_id", "n_words", (F.col("log_likelihood") + F.coalesce("added", F.lit(0.0))).alias("log_likelihood"))
    per_word = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return scored.withColumn("per_word", per_word).withColumn("perplexity", F.exp(-per_word))
