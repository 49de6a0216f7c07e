"""Operator 9: quality rules as a learned decision list.

One pass computes whole-text statistics of every document. From labelled statistics,
sequential covering learns an ordered list of conjunctions of thresholds that name bad
documents: a rule grows on two thirds of the uncovered rows (FOIL gain, one threshold at a
time) and is pruned on the other third (trailing conditions go while precision does not
fall); rules below ``min_precision`` end the list. The list becomes a chain of Spark
``when`` expressions over the statistics.

The fit uses at most ``fit_rows`` labelled rows (documented bound, chosen by a hash of the
id); statistics and verdicts cover every row.

Defined cases: null text has no words, and fails the base rule; empty and blank texts too;
repeated rows each get a row; a null ``doc_id`` keeps its row and takes no part in fitting;
null labels are left out; if several labels name one id, rows fit under each; without
labels of both classes the list is empty and keeps whatever passes the base rule; extra
columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import U_WINDOW3, WHITE, lean, lowest_hashes, mix, slices, word_hashes, written

FIT_ROWS = 20_000
AT_ONCE = 1 << 22  # bytes of text held as words at once
SYMBOLS = "#*$%&|<>"
BLANK = WHITE.decode()

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_marks", "top_word", "longest_word", "long_words")


def _text_counts(text: str, raw: bytes, words: np.ndarray) -> tuple[int, ...]:
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANK))
    repeat = 0
    if n >= 4:
        triples = mix(words[:-2] * U_WINDOW3[0] + words[1:-1] * U_WINDOW3[1] + words[2:] * U_WINDOW3[2])
        _, inverse, counts = np.unique(triples, return_inverse=True, return_counts=True)
        twice = counts[inverse] > 1
        covered = np.zeros(n, bool)
        for j in range(3):
            covered[j : n - 2 + j] |= twice
        repeat = int(covered.sum())
    lines = [x for x in text.split("\n") if x.strip(BLANK)]
    a = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(a, minlength=256) if len(a) else np.zeros(256, np.int64)
    upper = sum(map(str.isupper, text)) if len(raw) != len(text) else int(kinds[65:91].sum())
    distinct, each = np.unique(words, return_counts=True)
    split = raw.split()
    sizes = np.fromiter(map(len, split), np.int64, len(split)) if split else np.zeros(1, np.int64)
    return n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat, len(lines), len(distinct), upper, int(kinds[48:58].sum()), int(kinds[33] + kinds[63]), int(each.max()) if n else 0, int(sizes.max()), int((sizes > 15).sum())


def _counted(batches):
    """Pieces of the batches, each with the columns of its counts."""
    for b in (x for whole in batches for x in slices(whole, "text", size=AT_ONCE)):
        texts = [t or "" for t in b.column("text").to_pylist()]
        raws = [t.encode("utf-8", "surrogatepass") for t in texts]
        rows = [_text_counts(t, r, w) for t, r, w in zip(texts, raws, word_hashes(raws))]
        yield b, [pa.array(c, pa.int64()) for c in list(zip(*rows)) or [[]] * len(COUNTS)]


def _scan(batches):
    for b, counts in _counted(batches):
        yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), *counts], names=["doc_id", *COUNTS])


def _beside(name: str):
    """The rows as they are, with a struct of their counts in the column ``name``."""

    def run(batches):
        for b, counts in _counted(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.StructArray.from_arrays(counts, names=COUNTS)], names=[*b.schema.names, name])

    return run


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the whole-text counts of every row of ``docs``."""
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(_scan), schema)


_PER = {"symbols_per_word": ("n_symbols", "n_words"), "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"), "distinct_share": ("n_distinct_words", "n_words"), "upper_share": ("n_upper", "word_chars"), "digit_share": ("n_digits", "word_chars"), "mark_share": ("n_marks", "n_words"), "top_word_share": ("top_word", "n_words"), "word_length": ("word_chars", "n_words"), "words_per_line": ("n_words", "n_lines"), "longest_word": ("longest_word", None), "long_word_share": ("long_words", "n_words")}
FEATURES = tuple(_PER)


def features(of: str = "") -> dict[str, Column]:
    """``of``: what the names of the counts begin with."""
    return {k: (F.col(of + a) / F.greatest(F.col(of + b), F.lit(1)) if b else F.col(of + a).cast("double")) for k, (a, b) in _PER.items()}


Rule = list[tuple[str, str, float]]


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for name, op, t in rule:
        v = x[:, FEATURES.index(name)]
        hit &= v >= t if op == ">=" else v < t
    return hit


def _grow(x: np.ndarray, bad: np.ndarray, most: int) -> Rule:
    rule: Rule = []
    hit = np.ones(len(x), bool)
    while len(rule) < most and hit.sum() and not bad[hit].all():
        p0, n0 = bad[hit].sum(), hit.sum()
        best = (0.0, None)
        for k, name in enumerate(FEATURES):
            v = x[hit, k]
            cuts = np.unique(v[np.argsort(v, kind="stable")[:: max(1, len(v) // 512)]])
            order = np.argsort(v, kind="stable")
            at = np.searchsorted(v[order], cuts)  # rows below each cut
            p_below = np.concatenate(([0], np.cumsum(bad[hit][order])))[at]
            for op, p, n in ((">=", p0 - p_below, n0 - at), ("<", p_below, at)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / n) - np.log2(p0 / n0)), 0)
                i = int(np.argmax(gain))
                if gain[i] > best[0] + 1e-9:
                    best = (float(gain[i]), (name, op, float(cuts[i])))
        if best[1] is None:
            break
        rule.append(best[1])
        hit = _covers(rule, x)
    return rule


def _precision(rule: Rule, x: np.ndarray, bad: np.ndarray) -> float:
    hit = _covers(rule, x)
    return (bad[hit].sum() + 1) / (hit.sum() + 2)


def learn_list(x: np.ndarray, bad: np.ndarray, min_precision: float = 0.95, most_rules: int = 16, most_conditions: int = 4) -> list[Rule]:
    """Ordered rules for the rows with ``bad``; rows of ``x`` are FEATURES."""
    rules: list[Rule] = []
    prune = np.arange(len(x)) % 3 == 2
    left = np.ones(len(x), bool)
    while len(rules) < most_rules and bad[left & ~prune].any() and bad[left & prune].any():
        g, p = left & ~prune, left & prune
        rule = _grow(x[g], bad[g], most_conditions)
        while len(rule) > 1 and _precision(rule[:-1], x[p], bad[p]) >= _precision(rule, x[p], bad[p]):
            rule = rule[:-1]
        hit = _covers(rule, x) & left
        if not rule or _precision(rule, x[p], bad[p]) < min(min_precision, 1 - 1 / (hit[p].sum() + 3)) or bad[hit].sum() < max(3, min_precision * hit.sum()):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def list_expression(rules: list[Rule], of: str = "") -> Column:
    """True where the list keeps a document: the first rule that fits rejects it."""
    own, out = features(of), F.lit(True)
    for rule in reversed(rules):
        fits = F.lit(True)
        for name, op, t in rule:
            fits = fits & ((own[name] >= t) if op == ">=" else (own[name] < t))
        out = F.when(fits, F.lit(False)).otherwise(out)
    return out


def base_failed(of: str = "") -> Column:
    return (F.col(of + "n_words") < 50) | (100 * F.col(of + "n_repeat_words") > 50 * F.col(of + "n_words"))


def fit_rules(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[Rule]:
    lab = labels.filter("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    rows = stats.join(lab, "doc_id").filter(~base_failed()).select("quality", *[c.alias(k) for k, c in features().items()], F.xxhash64("doc_id").alias("h"), "doc_id")
    rows = lowest_hashes(written(rows, "fit"), "h", fit_rows)
    rows = rows.orderBy("h", "doc_id", "quality", *FEATURES).limit(fit_rows).select("quality", *FEATURES).toPandas()
    bad = rows["quality"].to_numpy() == 0
    if not len(rows) or bad.all() or not bad.any():
        return []
    return learn_list(rows[list(FEATURES)].to_numpy(float), bad)


def judge_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, rules: list[Rule] | None = None) -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` for every row of ``docs(doc_id, text, ...)``."""
    stats = written(statistics(docs), "statistics")
    rules = fit_rules(stats, labels, fit_rows) if rules is None else rules
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & list_expression(rules))


def filter_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs``, all its columns, that ``judge_quality`` keeps. Each text is read once, and written with its
    statistics; only statistics are joined to the labels, so no text is shuffled or sorted."""
    name = "counts"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    schema = StructType([*docs.schema.fields, StructField(name, StructType([StructField(c, LongType()) for c in COUNTS]))])
    rows = written(docs.mapInArrow(lean(_beside(name)), schema), "with-statistics")
    rules = fit_rules(rows.select(F.col("doc_id").cast("long").alias("doc_id"), f"{name}.*"), labels, fit_rows)
    return rows.filter(~base_failed(f"{name}.") & list_expression(rules, f"{name}.")).select(*docs.columns)
