"""Operators of keysweep.llm on small tables with nulls, empty and long texts, ties, repeated
rows, clashing extra columns and no rows, against brute-force versions."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from keysweep.llm.bpe_transducer import Merges, Transducer, encode_decode, token_digests
from keysweep.llm import licenses, lm_scoring
from keysweep.llm.common import lowest_hashes, shared_dir, word_hashes, written
from keysweep.llm.components import components
from keysweep.llm.decontamination import contaminated
from keysweep.llm.html_text import DEPTH, MAIN, RUN, blocks, main_text, suffix_intervals
from keysweep.llm.licenses import scan_licenses
from keysweep.llm.lm_scoring import score_documents
from keysweep.llm.ngram_join import near_duplicates
from keysweep.llm.quality_rules import filter_quality, judge_quality, learn_list
from keysweep.llm.token_codes import dac_access, dac_decode, dac_encode, read_documents, tokens_at, write_tokens
from keysweep.llm.toxicity import BlockMaxIndex, filter_toxicity, score_toxicity, unit
from keysweep.llm.url_filter import judge_urls

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
EXTRA = "sig long, n long, token string, key string, n_words string"


def text_of(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 3000, n))


@pytest.fixture(scope="module")
def texts():
    base = text_of(1, 200)
    words = base.split()
    near = " ".join([*words[:100], "changed", *words[101:]])
    far = " ".join([*words[:100], *text_of(2, 100).split()])
    rows = [(1, base), (2, base.upper()), (3, near), (4, far), (5, None), (6, ""), (7, " \n\t "), (8, "one two"), (9, "one  two"), (10, "<|endoftext|> It's  a b\n\nc  "), (11, "é́ ΑΣ Ünï 日本 🙂 123"), (12, "x" * 3000 + " " + "ab" * 2000), (13, text_of(3, 30000)), (14, base), (14, "twin"), (None, near), (3, near)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(d, t, 7, 8, "t", "k", "w") for d, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, " + EXTRA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_token_codes(spark, docs, texts, none):
    folder = f"{shared_dir(spark)}/codes-test-{np.random.default_rng().integers(1 << 60)}"
    write_tokens(docs, folder, BYTE, 2)
    got = sorted(read_documents(spark, folder).collect(), key=lambda r: r.start)
    tok = Tokenizer.from_file(BYTE)
    assert [r.doc_id for r in got][:2] == [None, 1] and [r.doc_id for r in got[1:]] == sorted(d for d, _ in texts if d is not None)
    want = Counter((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, t in texts for i in [[*tok.encode(t or "", add_special_tokens=False).ids, 2]])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    asked = [0, got[1].start, at - 1, at, -1]
    found = {r.position: r.token_id for r in tokens_at(spark, folder, spark.createDataFrame([(p,) for p in asked] + [(None,), (0,)], "position long")).collect()}
    assert set(found) == {0, got[1].start, at - 1} and found[at - 1] == 2
    empty = folder + "-none"
    write_tokens(none, empty, BYTE, 2)
    assert read_documents(spark, empty).count() == 0


def test_dac_random_access():
    ids = np.random.default_rng(5).choice([0, 255, 256, 65535, 65536, 2**24, 2**32 - 1], 5000).astype(np.uint32)
    levels = dac_encode(ids)
    assert (dac_decode(levels) == ids).all() and all(dac_access(levels, i) == ids[i] for i in range(0, 5000, 7))
    assert len(dac_decode(dac_encode(ids[:0]))) == 0


def test_bpe(spark, docs, texts, none):
    tok = Tokenizer.from_file(WORD)
    want = Counter()
    for d, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want[d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(map(tuple, token_digests(docs, WORD).collect())) == want
    assert token_digests(none, WORD).count() == 0
    plain = {r.doc_id: r.decoded for r in encode_decode(docs, WORD).collect()}
    assert plain[8] == "one two " and plain[6] == ""


def test_transducer_windows():
    rng = np.random.default_rng(3)
    tok, machine = Tokenizer.from_file(WORD), Transducer(Merges(WORD))
    words = ["".join(rng.choice(list("abehtrnos"), n)) for n in (1, 2, 31, machine.window, machine.window + 1, 5000)] + ["lll" * 900, "theing" * 700]
    assert machine.encode([w.encode() for w in words]) == [tok.encode(w, add_special_tokens=False).ids for w in words]


def brute_components(rows, k=5):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(rows)))
    find = lambda x: x if root[x] == x else find(root[x])
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].append(d)
    return Counter((d, len(sets[i]), min((x for x in groups[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows))


def test_near_duplicates(docs, texts, none):
    assert Counter(map(tuple, near_duplicates(docs).collect())) == brute_components(texts)
    assert near_duplicates(none).count() == 0


def test_near_duplicates_of_a_group_around_the_threshold(spark):
    """Many near copies with different edits, some pairs above and some below the threshold, over one common passage."""
    rng, base = np.random.default_rng(9), text_of(21, 90).split()
    rows = []
    for i in range(140):
        w = list(base)
        for p in rng.choice(90, int(rng.integers(0, 5)), replace=False):
            w[p] = f"e{rng.integers(6)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join([*base[:40], *text_of(100 + i, int(rng.integers(5, 60))).split()])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert Counter(map(tuple, near_duplicates(df).collect())) == brute_components(rows)


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 100), (None, 5), (200, 201), (201, 200)], "a long, b long")
    got = {r.v: r.root for r in components(links).collect()}
    assert len({got[i] for i in range(21)}) == 1 and got[200] == got[201] and 100 not in got


def test_html(spark):
    page = "<html><head><title>T</title><script>var a='</p>';</script></head><body><nav>Menu</nav><div class=ad>Buy</div><article><h1>Head &amp; tail</h1><p>One\n two<br>three<p>four <b>five</b><div class='comments'>Nice</div></article><footer>F</footer>"
    menu = "home about contact products services support careers news events press"
    plain = [f"<div>{menu}</div><div>unique words of page number {i} {text_of(i, 30)}</div>" for i in range(3)]
    rows = [(1, "http://a.b/x", page), (2, None, None), (3, "http://a.b/y", ""), *[(10 + i, f"http://p.q/{i}", h) for i, h in enumerate(plain)], (20, "http://p.q/art", "<main><p>" + menu + "</p></main>"), (1, "http://a.b/x", page), (30, "http://z", "<p>a < b <div class='x"), (31, "http://z", "</p></div>text<nav>open")]
    df = spark.createDataFrame([(*r, "h", "s") for r in rows], "page_id long, url string, html string, host string, stream string")
    got = defaultdict(list)
    for r in main_text(df).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert got[1] == ["Head & tail\nOne two\nthree\nfour five"] * 2
    assert got[2] == [""] and got[3] == [""] and got[20] == [menu] and got[30] == ["a < b"] and got[31] == ["text"]
    assert got[11] == [f"unique words of page number 1 {text_of(1, 30)}"] or got[11][0].endswith(text_of(1, 30)) and menu not in got[11][0]
    assert main_text(df.limit(0)).count() == 0
    assert blocks("") == []


@pytest.mark.parametrize("before", ["<svg-icon name=x></svg-icon>", "<svg class=i/>", "<svg class=i>", "<iframe src=x />", "<datalist><option value=a><option value=b>x</datalist>", "<option>x", "<button>", "<button>x</button>", "<button><div>x</div></button>", "<button-bar></button-bar>", "<title-card></title-card>", "<textarea>", "<select><option>x<option>x</select>", "<template>x</template>", "<script>x < y</script >", "<svg><title>x</title></svg>"])
def test_html_reads_on_after(before):
    assert [t for z, t in blocks(f"<article>{before}<p>real text</p></article>") if z == MAIN] == ["real text"]


def test_html_keeps_what_page_copies_share(spark):
    menu = "home about contact products services support careers news events press"
    other = [(i, f"http://p.q/{i}", f"<div>{menu}</div><div>{text_of(i, 30)}</div>") for i in range(12)]
    article = f"<div>{menu}</div><div>{text_of(90, 60)}</div>"
    copies = [(20, "http://p.q/a", article), (21, "http://p.q/a?print", article), (22, "http://p.q/a", article), (23, "http://p.q/a/amp", f"<div>{text_of(90, 60)}</div>"), (23, "http://p.q/a/amp", f"<div>{text_of(91, 20)}</div>")]
    alone = [(30, "http://r.s/1", article), (31, "http://r.s/2", article)]
    got = defaultdict(list)
    for r in main_text(spark.createDataFrame([*other, *copies, *alone], "page_id long, url string, html string")).collect():
        got[r.page_id].append(r.text)
    assert [got[i] for i in range(12)] == [[text_of(i, 30)] for i in range(12)]
    assert got[20] == got[21] == got[22] == [text_of(90, 60)] and sorted(got[23]) == sorted([text_of(90, 60), text_of(91, 20)])
    assert got[30] == got[31] == [f"{menu}\n{text_of(90, 60)}"]


@pytest.fixture()
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_html_suffix_array_against_brute_force(spark, many_ranges):
    rng = np.random.default_rng(11)
    menu, foot = "home about contact products services support careers news events press".split(), [f"f{i}" for i in range(40)]
    pages = [(h, c, [*menu, *(f"{x}" for x in rng.integers(0, 2, int(rng.integers(0, 60)))), *foot]) for h in ("a", "b") for c in range(20)]
    pages += [("c", 1, menu), ("c", 2, menu[:RUN]), ("c", 3, menu[1:]), ("c", 4, []), ("", 1, foot + foot)]
    df = spark.createDataFrame([(h, c, " ".join(w)) for h, c, w in pages], "host string, content long, stream string")
    got, shared = defaultdict(set), defaultdict(list)
    ranges = set()
    for r in suffix_intervals(df).collect():
        got[r.host, r.part, r.interval].add((r.content, r.pos))
        shared[r.host, r.part, r.interval] += [r.common] * (r.common is not None)
        ranges.add(r.part)
    want = defaultdict(list)
    for h, c, w in pages:
        for i in range(len(w) - RUN + 1):
            want[h, tuple(w[i : i + RUN])].append((c, i, w[i : i + DEPTH]))
    assert len(ranges) > 3
    assert sorted(sorted(x) for x in got.values()) == sorted(sorted((c, i) for c, i, _ in x) for x in want.values())
    length = {(h, c, i): next((k for k in range(DEPTH) if len({tuple(y[k : k + 1]) for *_, y in x}) > 1 or any(len(y) <= k for *_, y in x)), DEPTH) for (h, _), x in want.items() if len(x) > 1 for c, i, _ in x}
    for key, x in got.items():
        assert len(x) == 1 or {length[key[0], c, i] for c, i in x} == {min(shared[key])}


def test_html_drops_what_repeats_cover(spark, many_ranges):
    rng = np.random.default_rng(12)
    notice = [f"n{i}" for i in range(50)]
    texts = [[*notice[: 9 + 5 * (i % 9)], *(f"{x}" for x in rng.integers(0, 3, 40)), *notice[20 * (i % 2) :]] for i in range(16)]
    seen = Counter(x for w in texts for x in {tuple(w[i : i + RUN]) for i in range(len(w) - RUN + 1)})
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame([(i, "http://h/", f"<p>{' '.join(w)}</p>") for i, w in enumerate(texts)], "page_id long, url string, html string")).collect()}
    for i, w in enumerate(texts):
        gone = {j for k in range(len(w) - RUN + 1) if seen[tuple(w[k : k + RUN])] >= 4 for j in range(k, k + RUN)}
        assert got[i] == " ".join(x for j, x in enumerate(w) if j not in gone)


def test_lowest_hashes_bound_what_an_ordered_limit_reads(spark):
    rows = spark.range(0, 60_000, 1, 40).select("id", F.xxhash64("id").alias("h"))
    cut = lowest_hashes(rows, "h", 1000)
    assert 1000 <= cut.count() <= 1600
    assert [r.id for r in cut.orderBy("h").limit(1000).collect()] == [r.id for r in rows.orderBy("h").limit(1000).collect()]
    assert lowest_hashes(rows.limit(30), "h", 1000).count() == 30 and lowest_hashes(rows.limit(0), "h", 5).count() == 0
    crowded = rows.select("id", F.greatest(F.col("h"), F.lit(0)).alias("h"))
    assert lowest_hashes(crowded, "h", 1000).count() >= 1000


def test_urls(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/es/", "allow"), (None, "/", "block"), ("a.net", None, "block")]
    urls = ["http://www.example.com/en/1", "http://x.EXAMPLE.com/en/1?q", "https://example.com/fr", "http://notexample.com/en/", "http://q.net/es/1", "http://a.net", "http://b.a.net/es/", "nothing", None, "http://example.com", "http://", "x://com/://", "http://example.com/en/"] * 3
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, path string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    want = [("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("x.example.com", "/en/1", "example.com/en/", "block"), ("example.com", "/fr", "com/", "allow"), ("notexample.com", "/en/", "com/", "allow"), ("q.net", "/es/1", "net/es/", "block"), ("a.net", "", "a.net", "block"), ("b.a.net", "/es/", "net/es/", "block"), ("", "", None, "allow"), ("", "", None, "allow"), ("example.com", "", None, "allow"), ("", "", None, "allow"), ("com", "/://", "com/", "allow"), ("example.com", "/en/", "example.com/en/", "block")] * 3
    assert [got[i] for i in range(len(urls))] == want
    empty = spark.createDataFrame([], "host string, path string, verdict string")
    assert judge_urls(df.limit(0), empty).count() == 0 and {r.verdict for r in judge_urls(df, empty, "block").collect()} == {"block"}


def test_decontamination(spark):
    items = [(1, text_of(50, 40)), (2, text_of(51, 70)), (3, "only three words"), (4, None), (5, ""), (1, text_of(50, 40))]
    edited = items[0][1].split()
    edited[20] = "other"
    rows = [(1, f"{text_of(60, 80)} {items[0][1].upper()} {text_of(61, 20)}"), (2, " ".join(edited)), (3, text_of(62, 300)), (4, "Only\nthree  words"), (5, None), (6, ""), (7, items[1][1] + " " + items[0][1]), (7, items[1][1] + " " + items[0][1]), (8, " ".join(items[1][1].split()[:30])), (None, items[0][1])]
    docs = spark.createDataFrame([(*r, "h", 1) for r in rows], "doc_id long, text string, hash string, n int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in contaminated(docs, bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (4, 3), (7, 1), (7, 2), (None, 1)}
    assert got[1, 1].start_word == 80 and got[1, 1].similarity == 1 and 0.75 <= got[2, 1].similarity < 1
    assert contaminated(docs.limit(0), bench).count() == 0 and contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_of_documents_shorter_than_the_item(spark):
    item = text_of(70, 40).split()
    rows = [(1, item[:36]), (2, item[4:]), (3, item[:39]), (4, [*item[:38], *item[39:]]), (5, item[:31]), (6, item[:30]), (7, item[2:37])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in contaminated(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()}

    def shingles(w):
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    alike = {i: len(shingles(w) & shingles(item)) / len(shingles(w) | shingles(item)) for i, w in rows}
    assert {i: r.similarity for i, r in got.items()} == pytest.approx({i: x for i, x in alike.items() if x >= 0.75}) and set(got) == {1, 2, 3, 4, 5, 7}
    assert all((got[i].start_word, got[i].n_words) == (0, len(w)) for i, w in rows if i in got)


def test_decontamination_finds_borderline_windows(spark):
    item = text_of(71, 40).split()
    rows = [(i, " ".join([*item[: 6 + i % 28], f"changed{i}", *item[7 + i % 28 :]])) for i in range(1500)]
    got = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == list(range(1500)) and max(r.hamming for r in got) > 31


def test_decontamination_looks_at_every_window(spark):
    import random

    pick = random.Random(8)
    items = [(i, text_of(80 + i, 40).split()) for i in range(4)]
    texts = []
    for k in range(160):
        words = list(items[k % 4][1])
        for _ in range(k % 3):  # words left out, put in and changed
            at = pick.randrange(len(words))
            words[at : at + pick.randrange(2)] = [f"w{k}"] * pick.randrange(2)
        if k % 2:  # its halves the other way round: no shingle stands where the best window has it
            cut = pick.randrange(8, 32)
            words = words[cut:] + words[:cut]
        texts.append([f"a{k}x{j}" for j in range(pick.randrange(60))] + words + [f"b{k}x{j}" for j in range(pick.randrange(60))])
    texts[7] = items[3][1][20:] + items[3][1][:20] + texts[8]

    def shingles(w):
        return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))

    def best(words, item):
        own = shingles(item)
        found = []
        for start in range(max(1, len(words) - len(item) + 1)):
            there = shingles(words[start : start + len(item)])
            low, high = sum((there & own).values()), sum((there | own).values())
            if low >= 0.75 * high:
                found.append((-low / high, start))
        return min(found, default=None)

    want = {(i, j): found for i, words in enumerate(texts) for j, item in items if (found := best(words, item))}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (-r.similarity, r.start_word) for r in contaminated(docs, spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()}
    assert set(got) == set(want) and (7, 3) in want
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
    assert all(got[k][0] == pytest.approx(want[k][0]) for k in want)


def brute_counts(text):
    import re

    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_filter_quality_reads_each_text_once_and_moves_none(spark, monkeypatch):
    from keysweep.llm import quality_rules

    plans = []
    monkeypatch.setattr(quality_rules, "written", lambda df, name: (plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())), written(df, name))[1])
    rows = [(i, " ".join(f"x{i}y{j}" for j in range(60)) if i % 3 else "buy now! " * 20 + " ".join(f"z{j}" for j in range(60)), "c") for i in range(300)]
    docs = spark.createDataFrame([*rows, (None, rows[1][1], None), (1, None, "d")], "doc_id int, text string, counts string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)], "doc_id long, quality int")
    got = filter_quality(docs, labels)
    assert got.schema == docs.schema and Counter(map(tuple, got.collect())) == Counter([r for r in rows if r[0] % 3] + [(None, rows[1][1], None)])
    assert len([p for _, p in plans if "MapInArrow" in p]) == 1 and not any("Join" in p and "MapInArrow" in p for _, p in plans)


def test_quality(spark, docs, texts, none):
    rows = texts + [(100, "a b a b a b a\n" * 20), (101, "x\n \nx\nx y\n#*$%&|<>"), (102, "p q r p q r")]
    df = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, n_words int, kept boolean")
    labels = spark.createDataFrame([(1, 1, None), (3, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = judge_quality(df, labels)
    mine = Counter(tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in got.collect())
    assert mine == Counter((d, *brute_counts(t)) for d, t in rows)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed) for r in got.collect())
    assert judge_quality(none, labels).count() == 0
    assert Counter(r.doc_id for r in filter_quality(df, labels).collect()) == Counter(r.doc_id for r in got.collect() if r.kept)


def test_decision_list_finds_planted_rule():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 12))
    bad = (x[:, 0] >= 0.8) | ((x[:, 4] < 0.1) & (x[:, 8] >= 0.5))
    rules = learn_list(x, bad)
    from keysweep.llm.quality_rules import _covers

    hit = np.any([_covers(r, x) for r in rules], axis=0)
    assert (hit == bad).mean() > 0.98


def test_toxicity(spark, none):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(300):
        toxic = i % 4 == 0
        words = text_of(i, 40).split()
        if toxic:
            words[5:5] = list(rng.choice(["vilest", "rotten", "awfulish"], 2))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (None, "rotten vilest"), (902, "rotten vilest")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    lab = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in score_toxicity(docs, lab).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    held = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out for i, _ in held) and not got[None].held_out
    assert np.mean([got[i].predicted == t for i, t in held]) > 0.95 and got[902].predicted == 1 and got[900].score == got[901].score
    kept = Counter(r.doc_id for r in filter_toxicity(docs, lab).collect())
    assert kept == Counter(d for d, r in got.items() if r.predicted == 0)
    assert score_toxicity(none, lab).count() == 0
    assert {r.score for r in score_toxicity(docs, lab.limit(0)).collect()} == {0.0}


def test_block_max_search_is_exact():
    rng = np.random.default_rng(8)
    idf = rng.random(60) + 0.5
    vectors = []
    for _ in range(700):
        t = np.sort(rng.choice(60, rng.integers(1, 8), replace=False))
        vectors.append(unit(t, rng.integers(1, 4, len(t)), idf))
    index = BlockMaxIndex(vectors, np.zeros(700), np.arange(700))
    dense = np.zeros((700, 60))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for _ in range(40):
        t = np.sort(rng.choice(60, 5, replace=False))
        t, w = unit(t, np.ones(5), idf)
        q = np.zeros(60)
        q[t] = w
        best = np.sort(dense @ q)[::-1][:15]
        assert np.allclose(index.search(t, w, 15)[1], best[best > 0])


def test_lm(spark, docs, texts, none):
    got = score_documents(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in texts)
    by = {r.doc_id: r for r in got}
    assert by[5].n_words == 0 and by[5].log_likelihood == 0 and by[5].per_word is None
    assert all(r.log_likelihood < 0 for r in got if r.n_words) and score_documents(none).count() == 0


def test_lm_learns(spark):
    rows = [(i, " ".join(["red", "green", "blue", "grey"] * 60)) for i in range(600)] + [(999, " ".join(["blue", "red", "grey", "grey", "green"] * 12))]
    by = {r.doc_id: r for r in score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert by[0].per_word > by[999].per_word + 0.5


def test_lm_scores_words_outside_the_softmax(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(x)}" for x in np.minimum(rng.zipf(1.3, 60), 4000)) for _ in range(600)]
    rows = [*enumerate(texts), (1000, " ".join(f"rare{i}" for i in range(60))), (1001, " ".join(f"w{i}" for i in range(150, 210)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    by = {r.doc_id: r for r in score_documents(docs).collect()}
    assert by[1000].per_word < by[1001].per_word  # words met once, against words met often

    vocabulary, model, counts = lm_scoring.train_model(docs)
    n = Counter(w for _, t in rows for w in t.split())
    assert counts.count() == len(n) > lm_scoring.WORDS
    hashes = {w: word_hashes([w.encode()])[0] for w in n}
    ids = {w: int(vocabulary.encode(h)[0]) for w, h in hashes.items()}
    group = Counter()
    for w, k in n.items():
        group[ids[w]] += k
    for doc_id, text in rows[-3:]:
        words = text.split()
        lp = lm_scoring.log_probability(lm_scoring.shaped(model), *lm_scoring.contexts([np.array([ids[w] for w in words])])).sum()
        lp += sum(np.log(n[w] / (group[ids[w]] + 1)) for w in words if ids[w] >= lm_scoring.WORDS)
        assert abs(by[doc_id].log_likelihood - lp) < 1e-2


def test_lm_step_matches_plain_gradients_and_looks_words_up_together():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 64, 3000, np.uint64, False)
    hashes[:50] >>= np.uint64(20)  # words whose first bits are equal
    vocabulary = lm_scoring.Vocabulary(hashes[:800])
    ids = vocabulary.encode(hashes)
    assert ids[:800].tolist() == list(range(800)) and (ids[800:] >= lm_scoring.WORDS).all()
    assert [x.tolist() for x in vocabulary.encode_texts([hashes[:3], hashes[:0], hashes[3:]])] == [ids[:3].tolist(), [], ids[3:].tolist()]
    assert (lm_scoring.Vocabulary(hashes[:0]).encode(hashes) >= lm_scoring.WORDS).all()

    p = lm_scoring.start()
    around, target = lm_scoring.contexts([rng.integers(0, lm_scoring.V, 60), rng.integers(0, 40, 40)])
    h = np.tanh(p["bias"] + sum(p["embed"][j][around[:, j]] for j in range(4)))
    h = np.concatenate([h, np.ones((len(h), 1))], 1)

    def softmax(z):
        e = np.exp(z - z.max())
        return e / e.sum()

    grads = {k: np.zeros(s) for k, s in lm_scoring.SHAPES.items()}
    want = []
    for i, t in enumerate(target):
        c, w = divmod(int(t), lm_scoring.IN_CLASS)
        g, gw = softmax(h[i] @ p["classes"]), softmax(h[i] @ p["words"][c])
        want.append(np.log(g[c]) + np.log(gw[w]))
        g[c] -= 1
        gw[w] -= 1
        grads["classes"] += np.outer(h[i], g)
        grads["words"][c] += np.outer(h[i], gw)
        back = ((p["classes"] @ g + p["words"][c] @ gw) * (1 - h[i] ** 2))[:-1]
        grads["bias"] += back
        for j in range(4):
            grads["embed"][j, around[i, j]] += back
    assert np.allclose(lm_scoring.log_probability(p, around, target), want, atol=1e-4)
    q, square = {k: x.copy() for k, x in p.items()}, {k: np.ones_like(x) for k, x in p.items()}
    lm_scoring.descend(q, square, around, target)
    for k, x in grads.items():
        assert np.allclose(square[k], 1 + x * x, rtol=1e-3, atol=1e-5) and np.allclose(q[k], p[k] - lm_scoring.RATE * x / np.sqrt(1 + x * x), atol=1e-4)


def test_lm_trains_on_every_position_once(monkeypatch):
    import pyarrow as pa

    seen = Counter()
    monkeypatch.setattr(lm_scoring, "descend", lambda p, square, around, target: seen.update(target.tolist()))
    text = " ".join(f"w{i}" for i in range(500))
    vocabulary = lm_scoring.Vocabulary(word_hashes([text.encode()])[0])
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    for turn in range(lm_scoring.ROUNDS):
        list(lm_scoring._train(vocabulary, lm_scoring.flat(lm_scoring.start()), turn)([pa.RecordBatch.from_pydict({"text": [text]})]))
    assert seen == Counter(range(500))


def test_licenses(spark, docs, none):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, "p/LICENSE", mit), (2, "p/a/b/x.txt", "nothing"), (3, "p/a/COPYING", f"title\n{gpl}\nmore"), (4, "p/a/y.txt", f"intro\n{mit}\n" + "z " * 5000), (5, "q/x", None), (6, None, mit), (7, "pp/x", "the license of this work is under discussion"), (8, "p/a/b/c/d", ""), (8, "p/a/b/c/d", ""), (9, "LICENSE", mit), (10, "/abs/x", "")]
    df = spark.createDataFrame([(*r, "d") for r in rows], "file_id long, path string, text string, dir string")
    got = {r.file_id: (r.license, r.origin, r.from_dir) for r in scan_licenses(df).collect()}
    assert scan_licenses(df).count() == len(rows)
    assert got[1] == ("MIT", "licence file", None) and got[3][:2] == ("GPL-3.0", "licence file") and got[4] == ("MIT", "header", None)
    assert got[2] == ("GPL-3.0", "inherited", "p/a") and got[8] == ("GPL-3.0", "inherited", "p/a") and got[6][:2] == ("MIT", "header")
    assert got[7] == ("MIT", "inherited", "") and got[5] == ("MIT", "inherited", "")
    assert scan_licenses(df.limit(0)).count() == 0


def test_licence_texts_headers_and_tags(spark):
    texts = {k: v[0] for k, v in licenses.full_texts().items()}
    comment = "\n".join(f"# {x}" for x in licenses.HEADERS["GPL-3.0"][1].replace(". ", ".\n").split("\n"))
    rows = [(f"{k}/LICENSE", f"Copyright (c) 2020 Some Body\n\n{x}", k) for k, x in texts.items()]
    rows += [("s1/a.py", f"#!/usr/bin/python\n{comment}\nimport os\n" + "x = compute(y)\n" * 300, "GPL-3.0"), ("s2/a.c", "/* SPDX-License-Identifier: GPL-2.0-or-later */\nint x;", "GPL-2.0"), ("s3/a.rs", "// SPDX-License-Identifier: MIT OR Apache-2.0\n", "MIT OR Apache-2.0")]
    rows += [("s4/a.md", "A tool. Released under the MIT\nLicense. It prints words.", "MIT"), ("s5/LICENSE", "MIT License", "MIT"), ("s6/a.md", "This project has never been released under the well known MIT License by its owners.", None), ("s7/b.txt", text_of(3, 500), None)]
    rows += [("s8/a.js", "/*\n * " + licenses.HEADERS["Apache-2.0"][0].replace("; ", ";\n * ") + "\n */\nvar a;", "Apache-2.0")]
    df = spark.createDataFrame([(i, p, t) for i, (p, t, _) in enumerate(rows)], "file_id long, path string, text string")
    got = {r.path: r.license for r in scan_licenses(df).collect()}
    assert {p: got[p] for p, *_ in rows} == {p: want for p, _, want in rows}


def test_pipeline_against_its_stages(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("labels", "benchmark"))
    left = {r.doc_id for r in judge_quality(docs, labels).filter("kept").collect()}
    a = docs.filter(F.col("doc_id").isin(list(left)))
    left = {r.doc_id for r in score_toxicity(a, labels).filter("predicted = 0").collect()}
    a = a.filter(F.col("doc_id").isin(list(left)))
    rows = [(r.doc_id, r.text) for r in a.collect()]
    left = {c for _, _, c in brute_components(rows)}
    a = a.filter(F.col("doc_id").isin(list(left)))
    left -= {r.doc_id for r in contaminated(a, bench).collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == left and left


def test_pipeline_stages_judge_rows(spark, tmp_path):
    """Repeated and null ids, identical rows, clashing names of further columns, no rows."""
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    t, third, passage = text_of(21, 120), text_of(22, 120), text_of(23, 60)
    near, other = t + " tail", text_of(24, 120)
    kinds = "doc_id long, text string, row_of string, copies_of int, kept_id long, found_id long, id_of string"
    extra = ("r", 1, 2, 3, "i")
    rows = [(5, t), (7, near), (7, other), (None, t), (None, third), (9, third), (9, third), (8, "alone " + text_of(25, 90)), (8, "alone " + text_of(25, 90))]
    docs = spark.createDataFrame([(*r, *extra) for r in rows], kinds).repartition(3)
    got = stages["n-gram Jaccard join"](spark, docs, "")
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(5, t), (7, other), (9, third), (8, "alone " + text_of(25, 90))])
    assert stages["n-gram Jaccard join"](spark, docs.limit(0), "").count() == 0

    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    leak = text_of(26, 100) + " " + passage + " " + text_of(27, 100)
    rows = [(1, leak), (1, t), (None, leak), (None, other), (2, None), (2, ""), (3, third)]
    docs = spark.createDataFrame([(*r, *extra) for r in rows], kinds).repartition(3)
    got = stages["benchmark decontamination"](spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(1, t), (None, other), (2, None), (2, ""), (3, third)])
    assert stages["benchmark decontamination"](spark, docs.limit(0), str(tmp_path)).count() == 0


def test_bpe_of_every_character():
    """All code points, with marks after them and beside letters, digits and signs."""
    from keysweep.llm.bpe_transducer import _ODD, encode_texts

    tok = Tokenizer.from_file(WORD)
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    agreed = [c for c in points if not _ODD.match(chr(c))]
    rng = np.random.default_rng(11)
    marks = [chr(c) for c in range(0x300, 0x370)]
    texts = ["".join(f"a{chr(c)}1{chr(c)}!{chr(c)}{marks[int(i)]}{marks[int(j)]} {chr(c)}" for c, (i, j) in zip(part, rng.integers(0, len(marks), (len(part), 2)))) for part in (agreed[k : k + 200] for k in range(0, len(agreed), 200))]
    others = [c for c in points if _ODD.match(chr(c))]
    texts += ["".join(f"{chr(c)}a 1{chr(c)}" for c in others[k : k + 500]) for k in range(0, len(others), 500 * 7)]
    texts += ["\u058ca", "a\u0897\u0301", "\u1acf\u0323e", "x\u2028y\u2003z\x85w", "ΑΣ ΣΑΣ. σς"]
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    got = encode_texts(texts, WORD)
    assert [i for i, (g, w) in enumerate(zip(got, want)) if g.tolist() != w] == []


def test_ngram_join_holds_little_beside_the_sets_of_a_slice():
    """The forms that shingles take on their way are there for some ranges of hashes at a time, not for the whole slice."""
    import tracemalloc

    from keysweep.llm import common, ngram_join

    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 10**8, 1500))) for _ in range(600)]  # 8 MB, 900,000 shingles
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    sets = 8 * sum(len(t.split()) - 4 for t in texts)
    common._CACHED.clear()
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in ngram_join._scan(5, 32)(iter([batch]))) == len(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < sets + (40 << 20)


def test_ngram_join_ranges_cut_at_the_ranges_borders():
    from keysweep.llm.ngram_join import _by_range

    rng = np.random.default_rng(6)
    for ranges in (1, 3, 12, 51, 1000):
        sets = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (0, 1, 7, 500, 3000)]
        parts = list(_by_range(sets, ranges))
        tokens, place = (np.concatenate(x) for x in zip(*parts))
        for i, s in enumerate(sets):
            assert np.array_equal(tokens[place == i], s)
        dealt = [set(((t >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).tolist()) for t, _ in parts]
        assert sum(map(len, dealt)) == len(set().union(*dealt))  # no range in two parts
    assert list(_by_range([], 5)) == []


def test_written_bounds_what_a_task_hands_to_python(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    long = spark.range(0, 9000, 1, 1)
    assert max(r.n for r in written(long.mapInArrow(sizes, "n long"), "sizes").collect()) <= 4096
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert max(r.n for r in long.mapInArrow(sizes, "n long").collect()) > 4096 or int(kept) <= 4096
