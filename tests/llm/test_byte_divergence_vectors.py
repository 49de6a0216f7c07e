"""Operators 11 to 13 on small tables with nulls, empty and long texts, ties, repeated rows,
clashing extra columns and no rows, against the tiktoken library and brute-force versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from keysweep.llm import byte_bpe, divergence, vector_codes
from keysweep.llm.byte_bpe import Coder, Vocabulary, apply_edits, byte_token_digests, decode_bytes, encode_bytes, prefix_tables
from keysweep.llm.divergence import audit, common, gallop, price
from keysweep.llm.vector_codes import compress, decode_vectors, nearest, train_codebooks

MULTI = P.path("byte_bpe_multi_50k.tiktoken")


# ---------------------------------------------------------------- operator 11
@pytest.fixture(scope="module")
def coder():
    return byte_bpe.coder(MULTI, P.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder.vocabulary.ranks, special_tokens={})


ALPHABETS = ["aaab ", "ab\n \t'ste", "éüa 日本語 1٣", "the ing tion ", "   \x1c\x85 x", " .,!-_/", "֌ࢗᲉ a1"]


def samples(seed, n, longest=40):
    rnd = random.Random(seed)
    for k in range(n):
        alphabet = rnd.choice(ALPHABETS)
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, longest)))
        if k % 3 == 0:
            text += "".join(chr(rnd.choice([rnd.randint(1, 0xD7FF), rnd.randint(0xE000, 0x10FFFF), rnd.randint(32, 127)])) for _ in range(8))
        yield text


def ids_of(coder, text):
    return coder.ids([text])[0].tolist()


def test_ids_are_the_librarys(coder, library):
    for text in samples(1, 3000):
        assert ids_of(coder, text) == library.encode_ordinary(text), repr(text)


def test_kinds_of_characters_are_the_librarys(coder, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    newer = [c for c in points if byte_bpe.regex.match(r"[\p{L}\p{N}]", chr(c)) and not chr(c).isalnum()]
    chosen = newer[::40] + points[:: 997] + list(range(0, 0x600))
    text = "".join(f"a{chr(c)}1{chr(c)}! {chr(c)}" for c in chosen)
    assert ids_of(coder, text) == library.encode_ordinary(text)


def test_blocks_cut_where_the_pattern_cuts(coder, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK", 7)
    for text in samples(2, 300, 200):
        assert ids_of(coder, text) == library.encode_ordinary(text)


def test_long_pieces(coder, library):
    for text in ("ab" * 30000, "a" * 5000 + "\n" * 4000 + " " * 3000, "x" * 65, "日本" * 400):
        assert ids_of(coder, text) == library.encode_ordinary(text)


def test_every_prefix(coder, library):
    text = "unbelievablereconsiderationss"
    last = []
    coder.vocabulary.extend(text.encode(), last)
    for i in range(len(text) + 1):
        assert coder.vocabulary.walk(last, i) == library.encode_ordinary(text[:i])


def test_edits_give_the_librarys_ids(coder, library):
    rnd = random.Random(3)
    for text in samples(4, 800, 160):
        starts, last = coder.table(text)
        for _ in range(3):
            a = rnd.randint(0, len(text))
            b = min(len(text), a + rnd.choice([0, 0, 1, 5, 60]))
            put = "".join(rnd.choice(rnd.choice(ALPHABETS)) for _ in range(rnd.choice([0, 1, 3, 10])))
            want = text[:a] + put + text[b:]
            text, starts, last, _ = coder.edit(text, starts, last, a, b, put)
            assert text == want and coder.vocabulary.walk(last) == library.encode_ordinary(text)
            assert (starts, last) == coder.table(text)


def test_edits_are_local(coder):
    text = "ab" * 5000 + "xyz" + "aaab" * 5000
    starts, last = coder.table(text)
    assert coder.edit(text, starts, last, 10000, 10003, "q")[3] < 200
    words = "some words here " * 5000
    starts, last = coder.table(words)
    assert coder.edit(words, starts, last, 40000, 40004, "other")[3] < 100
    assert coder.edit(words, starts, last, len(words), len(words), "tail")[3] < 100


def test_vocabulary_needs_merges(tmp_path):
    import base64

    tokens = [bytes([b]) for b in range(256)] + [b"abc"]
    path = tmp_path / "broken.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    with pytest.raises(ValueError):
        Vocabulary(str(path)).check()


@pytest.mark.parametrize("more", [[b"aa", b"aaa"], [b"aa", b"aaaa", b"aaa"], [b"ab", b"ba", b"aba", b"abab"], [b"bc", b"ab", b"abc"]])
def test_ties_of_small_vocabularies(tmp_path, more):
    import base64

    tokens = [bytes([b]) for b in range(256)] + more
    path = tmp_path / "small.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    own = Coder(str(path), P.PATTERN)
    own.vocabulary.check()
    library = tiktoken.Encoding("small", pat_str=P.PATTERN, mergeable_ranks=own.vocabulary.ranks, special_tokens={})
    rnd = random.Random(5)
    for _ in range(800):
        text = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 90)))
        assert ids_of(own, text) == library.encode_ordinary(text)


TEXTS = [(1, "It's  a  test\n\n of 123 words "), (2, None), (3, ""), (4, " \t\n "), (5, "日本 🙂 é́"), (5, "second five"), (6, "x" * 5000), (None, "no id"), (None, "no id"), (7, "long " * 60000)]
EXTRA = "ids string, starts string, last long, n_tokens string"


def test_digests_encode_decode(spark, library):
    docs = spark.createDataFrame([(d, t, "i", "s", 1, "n") for d, t in TEXTS], "doc_id long, text string, " + EXTRA).repartition(3)
    want = Counter()
    for d, t in TEXTS:
        ids = library.encode_ordinary(t or "")
        want[d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    got = byte_token_digests(docs, MULTI, P.PATTERN)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(map(tuple, got.collect())) == want
    back = decode_bytes(encode_bytes(docs, MULTI, P.PATTERN), MULTI, P.PATTERN)
    assert Counter((r.doc_id, bytes(r.data).decode()) for r in back.collect()) == Counter((d, t or "") for d, t in TEXTS)
    assert byte_token_digests(docs.limit(0), MULTI, P.PATTERN).count() == 0


def test_apply_edits(spark, library):
    docs = spark.createDataFrame([(1, "one two three"), (2, None), (3, "untouched text"), (None, "no id"), (4, "abc")], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 1, 4, 7, "2"), (1, 2, None, None, " four"), (2, 1, 0, 0, "born"), (4, 1, -5, 99, None), (9, 1, 0, 0, "x"), (None, 1, 0, 0, "x")], "doc_id long, seq int, start long, stop long, replacement string")
    tables = prefix_tables(docs, MULTI, P.PATTERN)
    got = {r.doc_id: r for r in apply_edits(tables, edits, MULTI, P.PATTERN).collect()}
    want = {1: "one 2 three four", 2: "born", 3: "untouched text", None: "no id", 4: ""}
    assert {d: r.text for d, r in got.items()} == want
    for d, text in want.items():
        assert got[d].ids == library.encode_ordinary(text)
        starts, last = byte_bpe.coder(MULTI, P.PATTERN).table(text)
        assert got[d].starts == starts and np.frombuffer(got[d].last, "<u4").tolist() == last
    assert got[3].computed == 0


# ---------------------------------------------------------------- operator 12
def brute_audit(rows, least, top=50):
    docs = [(lang or "", source or "", [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]) for lang, source, text in rows]
    df, count, langs = Counter(), Counter(), defaultdict(set)
    for lang, source, words in docs:
        langs[lang].add(source)
        for w in set(words):
            df[lang, w] += 1
        for w in words:
            count[lang, source, w] += 1
            count[lang, None, w] += 1
    out = []
    for lang, sources in langs.items():
        kept = sorted((w for (l, w), n in df.items() if l == lang and n >= least), key=str.encode)
        v = len(kept)

        def prices(source):
            c = [count[lang, source, w] for w in kept]
            return [1 + 10**9 * (x + 5) // (sum(c) + 5 * v) for x in c]

        p = {s: prices(s) for s in [*sources, None]}
        for s in sources:
            pairs = [(-sum(abs(a - b) for a, b in zip(p[s], p[o])), o.encode(), o) for o in sources if o != s]
            terms = [(b - a, w.encode(), w) for a, b, w in zip(p[s], p[None], kept) if count[lang, s, w] and a > b]
            out += [(lang, s, "pair", o, -f, i + 1) for i, (f, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", w, -f, i + 1) for i, (f, _, w) in enumerate(sorted((b - a, e, w) for (d, e, w) in terms for a, b in [(-d, 0)])[:top])]
    return Counter(out)


def audit_rows():
    rnd = random.Random(7)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvxyz'[i // 100 % 5]}" for i in range(400)] + ["été", "ÉTÉ", "日本", "straße", "Ünï"]
    rows = []
    for i in range(260):
        lang = rnd.choice(["en", "en", "fr", None])
        source = rnd.choice(["s0"] * 4 + ["s1", "s2", "é", None])
        rows.append((lang, source, " ".join(rnd.choice(words[: rnd.choice([30, 400])]) + rnd.choice(["", ".", "1x", "-Q"]) for _ in range(rnd.randint(0, 60)))))
    rows += [("en", "none", None), ("en", "blank", " 12 \n"), ("de", "alone", "ein Wort ein Wort"), ("it", "a", "x"), ("it", "b", "y"), ("en", "s1", "Wak " * 20000)]
    return rows + rows[:20]


@pytest.mark.parametrize("terms, entries, held", [(1 << 15, 1 << 18, 150_000), (7, 50, 40)])
def test_audit(spark, monkeypatch, terms, entries, held):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", terms)
    monkeypatch.setattr(divergence, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(divergence, "HELD", held)
    rows = audit_rows()
    docs = spark.createDataFrame([(*r, "t", 1, 2, "x") for r in rows], "lang string, source string, text string, term string, n long, df long, other string").repartition(4)
    got = audit(docs, least_docs=6)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, got.collect())) == brute_audit(rows, 6)


def test_audit_without_rows_or_terms(spark):
    docs = spark.createDataFrame([("en", "a", "x"), ("en", "b", None)], "lang string, source string, text string")
    assert Counter(map(tuple, audit(docs).collect())) == Counter({("en", "a", "pair", "b", 0, 1): 1, ("en", "b", "pair", "a", 0, 1): 1})
    assert audit(docs.limit(0)).count() == 0


def test_gallop_and_common():
    rng = np.random.default_rng(3)
    for n, m in ((0, 5), (5, 0), (1, 1), (40, 3000), (3000, 40), (64, 64), (500, 501)):
        a, b = (np.unique(rng.integers(0, 4000, k)) for k in (n, m))
        assert (gallop(a, b) == np.searchsorted(b, a)).all()
        i, j = common(a, b)
        assert a[i].tolist() == b[j].tolist() == np.intersect1d(a, b).tolist()


def test_price_is_exact():
    for n, v in ((0, 1), (7, 3), (10**15, 12345), (9 * 10**15 - 1, 1)):
        counts = [0, 1, n // 3, n]
        assert price(np.array(counts), n, v).tolist() == [1 + 10**9 * (c + 5) // (n + 5 * v) for c in counts]


# ---------------------------------------------------------------- operator 13
def brute_codes(rows, parts=16, entries=64, rounds=2):
    def fine(v):
        return v is not None and len(v) > 0 and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)

    kept = sorted((r for r in rows if fine(r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    whole = [[math.floor(int(x * 256) if abs(x) > 2**60 else x * 256) for x in r[1]] for r in kept]
    m = len(whole[0]) // parts
    cut = [[tuple(w[p * m : (p + 1) * m]) for p in range(parts)] for w in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), i) for i, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        best = assign()
        for p in range(parts):
            for i in range(len(books[p])):
                own = [c[p] for c, b in zip(cut, best) if b[p][1] == i]
                if own:
                    books[p][i] = tuple(sum(x) // len(own) for x in zip(*own))
    best = assign()
    errors = [sum(d for d, _ in b) for b in best]
    sums = defaultdict(int)
    for r, e in zip(kept, errors):
        sums[r[2]] += e
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    long = lambda x: x if x < 2**63 else None
    return Counter((r[0], "".join(f"{i:02x}" for _, i in b), long(e), long(sums[r[2]]), sha) for r, b, e in zip(kept, best, errors))


def vector_rows(n=220, d=32, scale=1.0, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(int(i), (scale * np.round(rng.normal(size=d), 2)).tolist(), int(i) % 4 if i % 5 else None) for i in rng.permutation(n)]
    rows += [(1000, None, 1), (-1, [None, *[0.5] * (d - 1)], 1), (-2, [float("nan")] + [0.5] * (d - 1), 1), (-3, [float("inf")] + [0.5] * (d - 1), 2), (-4, [], 1), (-5, [0.5] * (d - 1), 1), (500, [0.25] * 16, 1)]
    return rows + [rows[0], rows[0], (rows[1][0], rows[2][1], 3), (None, rows[3][1], 3), (None, rows[4][1], None)] + [(600 + i, [0.5] * d, 9) for i in range(40)]


KINDS = "vec_id long, embedding array<double>, label int, code string, error long, vector string, part int"


@pytest.mark.parametrize("case", ["plain", "few", "huge", "coarse"])
def test_codes(spark, case):
    rows = {"plain": vector_rows(), "few": vector_rows(9)[:9], "huge": vector_rows(90, 32, 1e9) + [(-9, [1e300] * 32, 1)], "coarse": vector_rows(150, 16, 0.01, 2)}[case]
    if case == "coarse":
        rows = [r for r in rows if r[0] != 500]
    df = spark.createDataFrame([(*r, "c", 1, "v", 2) for r in rows], KINDS).repartition(4)
    got = compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert Counter(map(tuple, got.collect())) == brute_codes(rows)


def test_codes_salted_labels(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 1)
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "c", 1, "v", 2) for r in rows], KINDS).repartition(4)
    got = compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert Counter(map(tuple, got.collect())) == brute_codes(rows)


def test_codes_without_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (2, [], 1)], "vec_id long, embedding array<float>, label int")
    assert compress(df).count() == 0 and compress(df.limit(0)).count() == 0


def test_decode_is_within_the_error(spark):
    rows = [r for r in vector_rows() if r[0] is not None and 0 <= r[0] < 1000 and r[1] and len(r[1]) == 32]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    books = train_codebooks(df)
    codes = vector_codes.encode_vectors(df, books)
    back = {(r.vec_id, r.code): r.approximation for r in codes.join(decode_vectors(codes, books).withColumnRenamed("vec_id", "i"), codes.vec_id == vector_codes.F.col("i")).collect()}
    assert back and all(len(v) == 32 for v in back.values())


def test_nearest_is_brute_force_with_ties():
    rng = np.random.default_rng(2)
    for m, high in ((1, 4), (2, 3), (4, 9), (8, 200)):
        x, book = rng.integers(-high, high, (400, m)), rng.integers(-high, high, (64, m))
        every = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
        code, best = nearest(x, book)
        assert (code == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
