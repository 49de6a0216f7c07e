"""Operator 3: BPE as a bounded-lookahead streaming transducer, and an incremental decoder.

``Merges.lookahead`` is a bound, computed from the merge list alone, on how many symbols to
the right can still change a token: a merge (u, v) of rank r can only be prevented or
replaced by a merge of a lower rank that takes a right end of what stands there, that one by
a merge of a still lower rank further right, and so on; the longest such chain, in symbols,
is found by one pass over the merges in rank order. A token that ends at least that many
symbols before the end of what has been read is final. So a word of any length is read in
windows of fixed size: merge the window, emit the final tokens, keep the rest (no merge
crosses a token boundary, so the rest can be merged anew together with what comes).

Windows of many words are merged at once, as numpy matrices: in each round every word does
its merge of lowest rank (the leftmost of equals), as the library does. Distinct pieces
between white space are encoded once per worker (bounded cache).

The decoder is a state machine over tokens: it holds the bytes of an unfinished UTF-8
character and nothing else, and emits text as tokens come.

Text is normalised as the tokenizer file states for word-end BPE (NFC, white space, lower
case character by character); special tokens of the file are cut out of the raw text first.

Defined cases: null text is empty and has no tokens; texts and words of any length; equal
and repeated rows each get a row; a null ``doc_id`` keeps its row; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release
from .token_codes import TEXT_BYTES, PieceCache, WordCache, byte_letters, simple

END = "</w>"
#: The pre-tokenizer's pattern, with white space spelled as the Unicode property.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
NO_RANK = 1 << 30
CACHE_PIECES, CACHE_EXACT = 600_000, 50_000


class Merges:
    """Vocabulary and merge list of a word-end BPE file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.size = len(self.names)
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters])
        self.last = np.array([vocab[c + END] for c in letters])
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.length = np.array([len(s.removesuffix(END)) for s in self.names])
        self.lookahead = self._chain(left, right, made)
        self.spaced_bytes = [s.encode() for s in self.names]
        byte = {c: b for b, c in enumerate(letters)}
        self.text_bytes = [s.encode() if s in self.special else bytes(byte[c] for c in s.removesuffix(END)) + b" " * s.endswith(END) for s in self.names]

    def _chain(self, left, right, made) -> int:
        parts: dict[int, list[int]] = {}  # the right ends a token can show while it is merged
        reach = np.zeros(self.size, np.int64)  # for a token as left part: symbols its merges so far depend on
        longest = 0
        for u, v, w in zip(left.tolist(), right.tolist(), made.tolist()):
            ends = [v, *parts.get(v, [])]
            reach[u] = max(reach[u], int(self.length[v]) + max(int(reach[x]) for x in ends))
            parts[w] = list(dict.fromkeys([*parts.get(w, []), *ends]))
            longest = max(longest, int(reach[u]))
        return longest

    def rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each pair (NO_RANK: no merge)."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = (self.keys[at] == keys) & (a >= 0) & (b >= 0)
        return np.where(hit, self.ranks[at], NO_RANK), self.made[at]

    def merge(self, symbols: np.ndarray) -> np.ndarray:
        """Merge every row (ids, then -1) to the end; rows keep their width."""
        out = symbols.copy()
        live, sym = np.arange(len(out)), symbols.copy()
        ranks, made = self.rank(sym[:, :-1], sym[:, 1:])
        while len(live):
            j = np.argmin(ranks, axis=1)
            row = np.arange(len(live))
            go = ranks[row, j] < NO_RANK
            if not go.all():
                out[live[~go]] = -1
                out[live[~go], : sym.shape[1]] = sym[~go]
                live, sym, ranks, made, j = live[go], sym[go], ranks[go], made[go], j[go]
                row = np.arange(len(live))
                if not len(live):
                    break
            sym[row, j] = made[row, j]
            width = sym.shape[1] - 1
            at = np.arange(width) + (np.arange(width) > j[:, None])
            sym = np.take_along_axis(sym, at, 1)
            if width == 1:
                out[live] = -1
                out[live, :1] = sym
                break
            pick = at[:, :-1]  # the pair that starts at the kept symbol; the pairs beside the merge follow
            pick = np.minimum(pick, ranks.shape[1] - 1)
            ranks, made = np.take_along_axis(ranks, pick, 1), np.take_along_axis(made, pick, 1)
            for side in (j - 1, j):
                ok = (side >= 0) & (side < width - 1)
                r, s = row[ok], side[ok]
                ranks[r, s], made[r, s] = self.rank(sym[r, s], sym[r, s + 1])
        return out


class Transducer:
    """Streams words (UTF-8) through the merges, many at once."""

    def __init__(self, merges: Merges, rows: int = 4096):
        self.m, self.rows = merges, rows
        self.window = max(32, 2 * (merges.lookahead + 1))

    def encode(self, words: list[bytes]) -> list[list[int]]:
        out: list = [None] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        edges = [0, *[w for w in (4, 8, 12, 16, 24, 32, 64, 128, 256) if w < self.window], self.window]
        for lo, hi in zip(edges, edges[1:]):
            group = np.flatnonzero((lengths > lo) & (lengths <= hi))
            for i in range(0, len(group), self.rows):
                at = group[i : i + self.rows]
                for k, ids in zip(at.tolist(), self._whole([words[x] for x in at], lengths[at])):
                    out[k] = ids
        for k in np.flatnonzero(lengths > self.window).tolist():
            out[k] = [t for part in self.stream(words[k]) for t in part]
        return [x if x is not None else [] for x in out]

    def _whole(self, words: list[bytes], n: np.ndarray) -> list[list[int]]:
        width = max(2, int(n.max()))
        flat = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(len(words)), n)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
        symbols = np.full((len(words), width), -1, np.int64)
        symbols[row, col] = self.m.inner[flat]
        symbols[np.arange(len(words)), n - 1] = self.m.last[flat[np.cumsum(n) - 1]]
        merged = self.m.merge(symbols)
        count = (merged >= 0).sum(1)
        return [r[:c] for r, c in zip(merged.tolist(), count.tolist())]

    def stream(self, word: bytes):
        """Token lists of one word of any length, as soon as they are final; holds one window."""
        at = 0
        while len(word) - at > self.window:
            part = np.frombuffer(word, np.uint8, self.window, at)
            merged = self.m.merge(self.m.inner[part][None, :])[0]
            merged = merged[merged >= 0]
            ends = np.cumsum(self.m.length[merged])
            final = int(np.searchsorted(ends, self.window - 1 - self.m.lookahead, "right"))
            if not final:  # cannot be while the window is more than twice the lookahead and the longest token fits
                raise ValueError("window too small for the merge list")
            yield merged[:final].tolist()
            at += int(ends[final - 1])
        yield self._whole([word[at:]], np.array([len(word) - at]))[0]


class Decoder:
    """Incremental decoder. ``feed`` takes ids and returns the text that is complete;
    ``spaced`` writes the vocabulary strings, one space between two (what a tokenizer file
    without a decoder states), else bytes become characters and word ends spaces."""

    def __init__(self, merges: Merges, spaced: bool):
        self.spaced, self.first = spaced, True
        self.table = merges.spaced_bytes if spaced else merges.text_bytes
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int], last: bool = False) -> str:
        data = (b" " if self.spaced else b"").join(map(self.table.__getitem__, ids))
        if self.spaced and ids:
            data = data if self.first else b" " + data
            self.first = False
        return self.state.decode(data, last)


_CODERS: dict[str, tuple] = {}


def _coder(path: str):
    if path not in _CODERS:
        import regex

        merges = Merges(path)
        transducer, find = Transducer(merges), regex.compile(PATTERN).findall

        def words(found: list[str]) -> list[list[int]]:
            return transducer.encode([w.encode("utf-8", "surrogatepass") for w in found])

        known = WordCache(words)

        def encode(pieces: list[str]) -> list[list[int]]:
            found = [([p] if p.isalpha() else [p[:-1], p[-1]]) if simple(p) else find(p) for p in pieces]
            known.learn(chain.from_iterable(found))
            return [known[x[0]] if len(x) == 1 else [t for w in x for t in known[w]] for x in found]

        exact = PieceCache(words, CACHE_EXACT), _library_cut(path)
        special = re.compile("(" + "|".join(map(re.escape, sorted(merges.special, key=len, reverse=True))) + ")") if merges.special else None
        _CODERS[path] = merges, PieceCache(encode, CACHE_PIECES), special, exact
    return _CODERS[path]


_CONTROL = re.compile("[\x1c-\x1f]")
#: Characters of which the modules used here are known to agree with the library (a test tries them all). Other scripts and
#: signs, and all that newer tables name, are normalised and cut by the library itself.
_ODD = re.compile("[^\x00-\u052f\u2010-\u2027\u2030-\u205e\u20ac\u2122\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3\U0001f300-\U0001f64f]")


def _library_cut(path: str):
    """The words of a text as the tokenizer's own normaliser and pre-tokenizer have them."""
    from tokenizers import Regex, Tokenizer
    from tokenizers.pre_tokenizers import Split

    with open(path, encoding="utf-8") as f:
        steps = json.load(f)["pre_tokenizer"]
    pattern = next(x["pattern"]["Regex"] for x in steps.get("pretokenizers", [steps]) if x["type"] == "Split")
    normalise, split = Tokenizer.from_file(path).normalizer.normalize_str, Split(Regex(pattern), "removed", invert=True).pre_tokenize_str

    def cut(text: str) -> list[str]:
        return [word for word, _ in split(normalise(text))]

    return cut


def _pieces(text: str) -> list[str]:
    """The normalised text cut at white space (which the pre-tokenizer drops)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a final sigma has no form of its own here
    text = text.lower()
    if _CONTROL.search(text):  # str.split() takes these for white space, the pattern does not
        import regex

        return regex.findall(r"\P{White_Space}+", text)
    return text.split()


def encode_texts(texts: list, path: str) -> list[np.ndarray]:
    """Ids of every text (null: empty)."""
    merges, cache, special, (exact, cut) = _coder(path)
    out, group, size = [], [], 0

    def alone(text: str) -> np.ndarray:
        return (exact.ids(cut(text)) if _ODD.search(text) else cache.ids(_pieces(text)))[0]

    def flush() -> None:
        nonlocal group, size
        if group:
            ids, sizes = cache.ids([p for x in group for p in x])
            ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum([len(x) for x in group])]
            out.extend(np.split(ids, ends[:-1]))
        group, size = [], 0

    for t in texts:
        t = t or ""
        if special and special.search(t):
            flush()
            parts = [np.array([merges.special[x]], np.uint32) if x in merges.special else alone(x) for x in special.split(t)]
            out.append(np.concatenate(parts).astype(np.uint32))
            continue
        if not t.isascii() and _ODD.search(t):
            flush()
            out.append(alone(t).astype(np.uint32))
            continue
        group.append(_pieces(t))
        size += len(t)
        if size > TEXT_BYTES:
            flush()
    flush()
    return out


def decoded_sha256(ids: np.ndarray, merges: Merges, step: int = 1 << 16) -> str:
    machine, digest = Decoder(merges, spaced=True), hashlib.sha256()
    for i in range(0, len(ids), step):
        digest.update(machine.feed(ids[i : i + step].tolist()).encode("utf-8"))
    digest.update(machine.feed([], last=True).encode("utf-8"))
    return digest.hexdigest()


def _digests(path: str):
    def run(batches):
        merges, cache, _, (exact, _) = _coder(path)
        try:
            yield from digests(batches, merges)
        finally:  # the worker goes on to other stages; the pieces of this task are of no use there
            cache.reset()
            exact.reset()
            release()

    def digests(batches, merges):
        for b in batches:
            for i in range(0, len(b), 512):
                rows = b.slice(i, 512)
                coded = encode_texts(rows.column("text").to_pylist(), path)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array([len(x) for x in coded], pa.int64()), pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in coded]), pa.array([decoded_sha256(x, merges) for x in coded])], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def token_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs(doc_id, text, ...)``."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(_digests(tokenizer), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _round_trip(path: str):
    def run(batches):
        merges = _coder(path)[0]
        for b in batches:
            for i in range(0, len(b), 256):
                rows = b.slice(i, 256)
                coded = encode_texts(rows.column("text").to_pylist(), path)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array([x.tolist() for x in coded], pa.list_(pa.int32())), pa.array([Decoder(merges, spaced=False).feed(x.tolist(), last=True) for x in coded])], names=["doc_id", "ids", "decoded"])

    return run


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids, decoded`` (readable text: bytes to characters, word ends to spaces)."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(_round_trip(tokenizer), "doc_id long, ids array<int>, decoded string")
