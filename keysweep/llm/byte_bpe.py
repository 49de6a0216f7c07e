"""Operator 11: byte-level BPE by prefix dynamic programming.

A text is cut by the vocabulary's pattern into pieces, each encoded on its own. For every byte
prefix of a piece exactly one token can end its encoding: token ``t`` over bytes [j, i) ends the
prefix of length i if ``t`` may follow the last token of the prefix of length j, that is, if
merging the two tokens' bytes gives just these two tokens back. So one number per byte, the
*last token*, holds the encodings of all prefixes; walking back from the end gives the ids.

* *Append*: the values of the old bytes stay, only those of the new bytes are added.
* *Edit*: values before the edit stay; behind it they are recomputed only until as many in a row
  as the longest token has bytes agree with the old ones, as all later ones then agree too.

Whether two tokens may stand side by side is read off their merge trees. While merges run in
rank order, only the right edge of the first and the left edge of the second change; the pair is
refused if a merge across the border is due before either edge grows (equal ranks: the left one
goes first). This needs a vocabulary where every token is the merge of two tokens of lower rank;
``Vocabulary.check`` raises where one is not.

Letters, digits and white space are those of the library whose ids are wanted: the installed
``regex`` module knows newer characters, so each character's kind is asked of that library
once (``Splitter.kind``), and a stand-in of that kind is put in its place before cutting.

Memory: tables of pieces and of words between lone spaces, of bounded size, for each worker; texts are encoded in blocks
that end at a lone space, where the pattern always cuts.

Defined cases: null text is empty and has no ids; equal or null ``doc_id`` values stay separate
rows; extra columns are ignored; an empty table gives an empty one; a piece of any length is
encoded whole. Edits (``apply_edits``) act in order of ``seq``, then start, stop, replacement
(equal ones each act); offsets count code points and are clamped to the text; null replacement
is empty; null offsets mean the end of the text; edits of unknown or null ``doc_id`` are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .token_codes import PieceCache

NEVER = 1 << 62
BLOCK = 1 << 19  # code points encoded at once
SHORT = 64  # bytes of a piece that is worked out together with others
CACHE_HEADS, CACHE_WORDS, CACHE_PAIRS, PAIR_BITS = 50_000, 500_000, 300_000, 18


class Vocabulary:
    """Tokens by rank (their id), their merge trees, and a trie of the reversed tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, self.ranks))
        self.step: dict[int, int] = {}  # node * 256 + byte -> node
        self.ends = [-1]  # node -> token
        for token, rank in self.ranks.items():
            node = 0
            for byte in reversed(token):
                key = node << 8 | byte
                node = self.step.get(key, 0)
                if not node:
                    node = self.step[key] = len(self.ends)
                    self.ends.append(-1)
            self.ends[node] = rank
        keys = np.fromiter(self.step, np.int64, len(self.step))
        order = np.argsort(keys)
        self._keys, self._next = keys[order], np.fromiter(self.step.values(), np.int64, len(keys))[order]
        self._ends, self._sizes = np.array(self.ends), np.array([len(t) for t in self.tokens])
        self._seen = np.full(1 << PAIR_BITS, -1), np.zeros(1 << PAIR_BITS, bool)
        self._right: dict[int, tuple[int, ...]] = {}
        self._left: dict[int, tuple[int, ...]] = {}
        self._pairs: dict[int, bool] = {}

    def check(self) -> None:
        for byte in range(256):
            if bytes([byte]) not in self.ranks:
                raise ValueError(f"byte {byte} is no token")
        for token, rank in self.ranks.items():
            if len(token) > 1 and max(self.halves(rank), default=rank) >= rank:
                raise ValueError(f"token {rank} is not the merge of two tokens of lower rank")

    def halves(self, token: int) -> tuple[int, ...]:
        """The two tokens whose merge makes ``token``; nothing if merges of lower rank don't lead to two."""
        data = self.tokens[token]
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank >= token:
                return ()
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return tuple(self.ranks[p] for p in parts)

    def _edge(self, token: int, side: int, known: dict[int, tuple[int, ...]]) -> tuple[int, ...]:
        """The tokens at that edge (0 left, 1 right) while ``token`` is built, from its byte to itself."""
        chain_, at = [], token
        while at not in known and len(self.tokens[at]) > 1:
            chain_.append(at)
            at = self.halves(at)[side]
        edge = known.get(at, (at,))
        for t in reversed(chain_):
            edge = known[t] = (*edge, t)
        return edge

    def may_follow(self, first: int, second: int) -> bool:
        """Whether merging the bytes of both gives [first, second]."""
        key = first << 32 | second
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._stay_apart(first, second)
        return known

    def _stay_apart(self, first: int, second: int) -> bool:
        tokens, x, y = self.tokens, self._edge(first, 1, self._right), self._edge(second, 0, self._left)
        i = j = 0
        while True:
            across = self.ranks.get(tokens[x[i]] + tokens[y[j]], NEVER)
            grow_x = x[i + 1] if i + 1 < len(x) else NEVER
            grow_y = y[j + 1] if j + 1 < len(y) else NEVER
            if across < grow_x and across <= grow_y and across != NEVER:
                return False
            if grow_x == grow_y == NEVER:
                return True
            if grow_x <= grow_y:
                i += 1
            else:
                j += 1

    def extend(self, data: bytes, last: list[int], stop: int | None = None) -> None:
        """Add the last tokens of the prefixes of ``data`` that end behind ``last``, up to length ``stop``."""
        step, ends = self.step, self.ends
        for i in range(len(last), len(data) if stop is None else stop):
            node, fits = 0, []
            for j in range(i, -1, -1):
                node = step.get(node << 8 | data[j], 0)
                if not node:
                    break
                if ends[node] >= 0:
                    fits.append((j, ends[node]))
            for j, token in reversed(fits):
                if j == 0 or self.may_follow(last[j - 1], token):
                    last.append(token)
                    break

    def ids(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of many pieces. The last tokens of all short ones are worked out together, one prefix length at a time."""
        out: list[list[int]] = [[]] * len(pieces)
        short = [i for i, p in enumerate(pieces) if 0 < len(p) <= SHORT]
        for i, p in enumerate(pieces):
            if len(p) > SHORT:
                last: list[int] = []
                self.extend(p, last)
                out[i] = self.walk(last)
        if short:
            sizes = np.array([len(pieces[i]) for i in short])
            last = self._last_tokens(np.frombuffer(b"".join(pieces[i] for i in short), np.uint8).astype(np.int64), sizes)
            ends = np.cumsum(sizes)
            starts, at, piece, found = ends - sizes, ends - 1, np.arange(len(short)), []
            while len(piece):  # all pieces walk back side by side
                token = last[at]
                found.append((piece, token))
                at = at - self._sizes[token]
                piece, at = piece[at >= starts[piece]], at[at >= starts[piece]]
            piece, token = np.concatenate([f[0] for f in found[::-1]]), np.concatenate([f[1] for f in found[::-1]])
            ids = token[np.argsort(piece, kind="stable")].tolist()
            edges = np.concatenate(([0], np.cumsum(np.bincount(piece, minlength=len(short))))).tolist()
            for k, i in enumerate(short):
                out[i] = ids[edges[k] : edges[k + 1]]
        return out

    def _last_tokens(self, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The last token of every prefix of pieces that lie one after another in ``data``."""
        n = len(data)
        length = np.arange(1, n + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # of the prefix that ends here
        ends_at, node, fits = np.arange(n), np.zeros(n, np.int64), []
        for back in range(self.longest):  # down the trie of reversed tokens from every end
            key = node << 8 | data[ends_at - back]
            place = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            there = self._keys[place] == key
            ends_at, node = ends_at[there], self._next[place[there]]
            token = self._ends[node]
            is_token = token >= 0
            fits.append((ends_at[is_token], np.full(int(is_token.sum()), back + 1), token[is_token]))
            more = length[ends_at] > back + 1
            ends_at, node = ends_at[more], node[more]
            if not len(ends_at):
                break
        at, size, token = (np.concatenate([f[k] for f in fits[::-1]]) for k in range(3))  # longest first
        order = np.argsort(at, kind="stable")
        size, token = size[order], token[order]
        first = np.searchsorted(at[order], np.arange(n))
        last = np.full(n, -1)
        by_length = np.argsort(length, kind="stable")
        edges = np.searchsorted(length[by_length], np.arange(1, int(length.max()) + 2))
        for lo, hi in zip(edges[:-1], edges[1:]):
            rest, choice = by_length[lo:hi], 0
            while len(rest):  # a prefix has exactly one fitting token
                c = first[rest] + choice
                t, whole = token[c], size[c] == length[rest]
                fit = whole.copy()
                fit[~whole] = self._may_follow(last[rest[~whole] - size[c[~whole]]], t[~whole])
                last[rest[fit]] = t[fit]
                rest, choice = rest[~fit], choice + 1
        return last

    def _may_follow(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """``may_follow`` of many pairs, through a table that keeps the pair it met last in each slot."""
        keys, known = self._seen
        key = first << 32 | second
        slot = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)
        new = np.flatnonzero(keys[slot] != key)
        out = known[slot]
        if len(new):
            pairs, inverse = np.unique(key[new], return_inverse=True)
            fresh = np.fromiter((self.may_follow(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in pairs), bool, len(pairs))
            out[new] = fresh[inverse]
            keys[slot[new]], known[slot[new]] = key[new], fresh[inverse]
        return out

    def walk(self, last, at: int | None = None) -> list[int]:
        """Ids of the prefix of length ``at`` (all) from its last tokens."""
        out, at = [], len(last) if at is None else at
        while at > 0:
            token = int(last[at - 1])
            out.append(token)
            at -= len(self.tokens[token])
        return out[::-1]

    def edited(self, old: bytes, old_last: list[int], new: bytes) -> tuple[list[int], int]:
        """Last tokens of ``new`` given those of ``old``, and how many of them were computed anew."""
        short = min(len(old), len(new))
        a, b = np.frombuffer(old, np.uint8), np.frombuffer(new, np.uint8)
        same = a[:short] == b[:short]
        head = short if same.all() else int(np.argmin(same))
        same = a[len(a) - short + head :] == b[len(b) - short + head :]
        tail = short - head if same.all() else int(np.argmin(same[::-1]))
        last, shift, agree = list(old_last[:head]), len(new) - len(old), 0
        while len(last) < len(new):
            self.extend(new, last, len(last) + 1)
            at = len(last) - 1
            agree = agree + 1 if at >= len(new) - tail and last[at] == old_last[at - shift] else 0
            if agree >= self.longest:
                computed = len(last) - head
                return last + list(old_last[len(last) - shift :]), computed
        return last, len(new) - head


class Splitter:
    """Cuts texts by the pattern, with the kinds of characters that the library of the ids has."""

    KNOWN = 0x530  # kinds of the characters below are looked up at once

    def __init__(self, pattern: str):
        import tiktoken

        self.pattern = regex.compile(pattern)
        ranks = {bytes([b]): b for b in range(256)}
        for lead in (b"a", b"1", b"!"):  # the lead and a character are one piece, and merge, if of one kind
            ranks |= {lead + bytes([b]): len(ranks) + i for i, b in enumerate(range(256))}
        self.asked = tiktoken.Encoding("kinds", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.stand_in: dict[int, str] = {}
        self.seen: set[str] = set()
        self.learn({chr(c) for c in range(128, self.KNOWN)})
        self.beyond = regex.compile(f"[^\\x00-{chr(self.KNOWN - 1)}]")

    def kind(self, character: str) -> str:
        """A letter, digit, mark or space that stands for ``character``."""
        return next((lead for lead in "a1!" if self.asked.encode_ordinary(lead + character)[0] > 255), " ")

    def learn(self, characters: set[str]) -> None:
        for c in characters - self.seen:
            self.seen.add(c)
            kind = self.kind(c)
            if kind != next((lead for lead, k in (("a", r"\p{L}"), ("1", r"\p{N}"), (" ", r"\s")) if regex.match(k, c)), "!"):
                self.stand_in[ord(c)] = kind

    def stood_in(self, text: str) -> str:
        """``text``, or a text of the same length that is cut at the same places as the library cuts it."""
        if not text.isascii():
            if self.beyond.search(text):
                self.learn(set(self.beyond.findall(text)))
            if self.stand_in:
                return text.translate(self.stand_in)
        return text

    def cuts(self, text: str, start: int = 0) -> Iterator[tuple[int, int]]:
        """Places of the pieces from ``start`` (the start of a piece) on."""
        return (m.span() for m in self.pattern.finditer(self.stood_in(text), start))

    def pieces(self, text: str) -> list[str]:
        shown = self.stood_in(text)
        return self.pattern.findall(text) if shown is text else [text[a:b] for a, b in self.cuts(text)]


#: A space between two other characters that are not white space: a piece always starts there.
LONE = re.compile(r" (?<=\S )(?=\S)")


def blocks(text: str) -> Iterator[str]:
    """``text`` cut before lone spaces, into parts of about BLOCK code points."""
    at = 0
    while at < len(text):
        cut = LONE.search(text, at + BLOCK) if len(text) - at > BLOCK else None
        stop = cut.start() if cut else len(text)
        yield text[at:stop]
        at = stop


class Coder:
    def __init__(self, path: str, pattern: str):
        self.vocabulary, self.splitter = Vocabulary(path), Splitter(pattern)
        self.heads, self.words = PieceCache(self.encode, CACHE_HEADS), PieceCache(lambda words: self.encode([" " + w for w in words]), CACHE_WORDS)
        self.names = [str(i) for i in range(len(self.vocabulary.tokens))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, all their distinct pieces together."""
        cut = [self.splitter.pieces(t) for t in texts]
        pieces = list(dict.fromkeys(chain.from_iterable(cut)))
        ids = dict(zip(pieces, self.vocabulary.ids([p.encode("utf-8") for p in pieces])))
        return [ids[c[0]] if len(c) == 1 else list(chain.from_iterable(map(ids.__getitem__, c))) for c in cut]

    def parts(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """(place of the text, ids) in order; a long text in several parts. Words between lone spaces come from a table."""
        group, size = [], 0

        def flush():
            heads, n_heads = self.heads.ids([words[0] for _, words in group])
            ids, sizes = self.words.ids([w for _, words in group for w in words[1:]])
            edges = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum([0, *(len(words) - 1 for _, words in group)])]
            at = np.concatenate(([0], np.cumsum(n_heads)))
            for k, (i, _) in enumerate(group):
                yield i, np.concatenate((heads[at[k] : at[k + 1]], ids[edges[k] : edges[k + 1]]))

        for i, text in enumerate(texts):
            for block in blocks(text or ""):
                group.append((i, LONE.split(block)))
                size += len(block)
                if size >= BLOCK:
                    yield from flush()
                    group, size = [], 0
        if group:
            yield from flush()

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        found: list[list[np.ndarray]] = [[] for _ in texts]
        for i, ids in self.parts(texts):
            found[i].append(ids)
        return [np.concatenate(f) if f else np.empty(0, np.uint32) for f in found]

    def decoded(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))

    def table(self, text: str | None) -> tuple[list[int], list[int]]:
        """Starts of the pieces (code points) and the last token of every byte prefix of every piece."""
        starts, last = [], []
        for a, b in self.splitter.cuts(text or ""):
            own: list[int] = []
            self.vocabulary.extend(text[a:b].encode("utf-8"), own)
            starts.append(a)
            last += own
        return starts, last

    def edit(self, text: str, starts: list[int], last: list[int], start: int, stop: int, put: str) -> tuple[str, list[int], list[int], int]:
        """Text, piece starts and last tokens after ``text[start:stop]`` became ``put``, and how many last tokens were computed.

        A piece depends on its characters and the two behind it, so pieces that end two before the edit stay;
        cutting goes on from there until it meets a start of an old piece behind the edit."""
        new, shift = text[:start] + put + text[stop:], len(put) - (stop - start)
        ends = [*starts[1:], len(text)]
        keep = bisect_left(ends, start - 1)  # pieces with end + 2 <= start
        at = starts[keep] if keep < len(starts) else len(text)
        at = min(at, len(new))
        head_bytes = len(text[:at].encode("utf-8"))
        out_starts, out_last, computed = starts[:keep], last[:head_bytes], 0
        old_place, old = head_bytes, keep  # the old piece whose values may serve again
        for a, b in self.splitter.cuts(new, at):
            if a >= start + len(put):
                same = bisect_left(starts, a - shift)
                if same < len(starts) and starts[same] == a - shift:
                    rest = len(text[at : starts[same]].encode("utf-8"))
                    return new, out_starts + [s + shift for s in starts[same:]], out_last + last[head_bytes + rest :], computed
            data = new[a:b].encode("utf-8")
            while old < len(starts) and ends[old] <= a and starts[old] < a:
                old_place += len(text[starts[old] : ends[old]].encode("utf-8"))
                old += 1
            before = text[starts[old] : ends[old]].encode("utf-8") if old < len(starts) else b""
            own, n = self.vocabulary.edited(before, last[old_place : old_place + len(before)], data)
            computed += n
            out_starts.append(a)
            out_last += own
        return new, out_starts, out_last, computed


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Coder(path, pattern)
    return _CODERS[path, pattern]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _digests(path: str, pattern: str):
    def run(batches):
        c = coder(path, pattern)
        for batch in batches:
            for rows in slices(batch, "text", rows=512, size=1 << 22):
                made = [[0, hashlib.sha256(), hashlib.sha256()] for _ in range(len(rows))]
                for i, part in c.parts(rows.column("text").to_pylist()):
                    ids, row = part.tolist(), made[i]
                    row[1].update(("," if row[0] and ids else "").encode() + ",".join(map(c.names.__getitem__, ids)).encode())
                    row[2].update(c.decoded(ids))
                    row[0] += len(ids)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array([m[0] for m in made], pa.int64()), *(pa.array([m[k].hexdigest() for m in made], pa.string()) for k in (1, 2))], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def byte_token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs(doc_id, text, ...)``."""
    Vocabulary(path).check()
    return _texts(docs).mapInArrow(_digests(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _encode(path: str, pattern: str):
    def run(batches):
        c = coder(path, pattern)
        for batch in batches:
            for rows in slices(batch, "text", rows=512, size=1 << 22):
                ids = [x.astype(np.int32) for x in c.ids(rows.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def encode_bytes(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` for every row of ``docs(doc_id, text, ...)``."""
    Vocabulary(path).check()
    return _texts(docs).mapInArrow(_encode(path, pattern), "doc_id long, ids array<int>")


def _decode(path: str, pattern: str):
    def run(batches):
        c = coder(path, pattern)
        for rows in batches:
            data = [c.decoded(ids or []) for ids in rows.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return run


def decode_bytes(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, data``: the bytes of ``coded(doc_id, ids)`` (null ids: none)."""
    return coded.select("doc_id", "ids").mapInArrow(_decode(path, pattern), "doc_id long, data binary")


def _tables(path: str, pattern: str):
    def run(batches):
        c = coder(path, pattern)
        for batch in batches:
            for rows in slices(batch, "text", rows=64, size=1 << 20):
                made = [c.table(t) for t in rows.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("text"), pa.array([s for s, _ in made], pa.list_(pa.int32())), pa.array([np.array(x, "<u4").tobytes() for _, x in made], pa.binary())], names=["doc_id", "text", "starts", "last"])

    return run


TABLE = "doc_id long, text string, starts array<int>, last binary"


def prefix_tables(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, text, starts, last``: piece starts and last tokens (little-endian 32-bit), to be stored and edited later."""
    Vocabulary(path).check()
    return _texts(docs).mapInArrow(_tables(path, pattern), TABLE)


def _edits(path: str, pattern: str):
    def run(batches):
        c = coder(path, pattern)
        for batch in batches:
            for rows in slices(batch, "text", rows=64, size=1 << 20):
                out = []
                for row in rows.to_pylist():
                    text, starts, computed = row["text"] or "", row["starts"] or [], 0
                    last = np.frombuffer(row["last"] or b"", "<u4").tolist()
                    for e in row["edits"] or []:
                        a = len(text) if e["start"] is None else min(max(e["start"], 0), len(text))
                        b = len(text) if e["stop"] is None else min(max(e["stop"], a), len(text))
                        text, starts, last, n = c.edit(text, starts, last, a, b, e["replacement"] or "")
                        computed += n
                    out.append((row["doc_id"], text, starts, np.array(last, "<u4").tobytes(), c.vocabulary.walk(last), computed))
                kinds = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int32()), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["doc_id", "text", "starts", "last", "ids", "computed"])

    return run


def apply_edits(tables: DataFrame, edits: DataFrame, path: str, pattern: str) -> DataFrame:
    """``tables`` (of ``prefix_tables``) after ``edits(doc_id, seq, start, stop, replacement)``, with the new ``ids`` and the
    number of last tokens that were ``computed`` for them. An append has null offsets."""
    one = F.struct(F.col("seq"), F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), F.col("replacement"))
    own = edits.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("edited_id")).agg(F.sort_array(F.collect_list(one)).alias("edits"))
    kept = tables.select("doc_id", "text", "starts", "last")
    return kept.join(own, F.col("doc_id") == F.col("edited_id"), "left").drop("edited_id").mapInArrow(_edits(path, pattern), TABLE + ", ids array<int>, computed long")
