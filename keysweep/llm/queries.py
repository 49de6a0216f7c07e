"""The queries of this subpackage: one ``opN_<name>`` for each operator, and the pipeline."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_transducer import token_digests
from .byte_bpe import byte_token_digests
from .common import shared_dir
from .decontamination import contaminated
from .divergence import audit
from .html_text import main_text
from .licenses import scan_licenses
from .lm_scoring import score_documents
from .ngram_join import near_duplicates
from .quality_rules import judge_quality
from .token_codes import read_documents, write_tokens
from .toxicity import score_toxicity
from .url_filter import judge_urls
from .vector_codes import compress

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/keysweep-llm/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return read_documents(spark, folder)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(*columns)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as the files of a tree: a source is a project, its documents lie in
    folders of 1,000 and below them 50 ids, and the first id of each lower folder is its LICENSE."""
    name = F.when(F.col("doc_id") % 50 == 0, F.concat(F.lit("LICENSE-"), F.col("doc_id"))).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    path = F.concat_ws("/", "source", F.expr("doc_id div 1000"), F.expr("doc_id div 50"), name)
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")
    return scan_licenses(files).withColumnRenamed("file_id", "doc_id")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings")).drop("label")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_token_codes, op2_ngram_join, op3_bpe, op4_html_text, op5_toxicity, op6_lm_scoring, op7_url_filter, op8_decontamination, op9_quality_rules, op10_licenses, op11_byte_bpe, op12_source_divergence, op13_vector_codes, pipeline)}

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)



def _vector_codes_sql(rounds: int = 2) -> str:
    """The rounds one after another: ``b0`` are the first codebooks, ``a`` assignments (distance * 64 + entry), ``b`` codebooks."""

    def assigned(i: int) -> str:
        near = f"SELECT x.rid, x.p, min(list_sum(list_transform(list_zip(x.c, b.c), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) * 64 + b.e) AS best FROM parts x JOIN b{i} b ON x.p = b.p GROUP BY x.rid, x.p"
        return f"a{i} AS MATERIALIZED ({near})"

    steps = [assigned(0)]
    for i in range(rounds):
        steps.append(f"""
        s{i} AS (SELECT p, e, k, sum(v) AS s, count(*) AS n FROM (
                SELECT x.p, a.best % 64 AS e, unnest(x.c) AS v, generate_subscripts(x.c, 1) AS k FROM parts x JOIN a{i} a ON x.rid = a.rid AND x.p = a.p) GROUP BY p, e, k),
        b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.c, b.c) AS c FROM b{i} b LEFT JOIN (
                SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS c FROM s{i} GROUP BY p, e) n ON b.p = n.p AND b.e = n.e)""")
        steps.append(assigned(i + 1))
    return f"""
        WITH kept AS (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (SELECT rid, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS c FROM kept, range(16) r(p)),
        b0 AS MATERIALIZED (SELECT p, rid - 1 AS e, c FROM parts WHERE rid <= 64),
        {", ".join(steps)},
        books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS sha FROM b{rounds}),
        coded AS (
            SELECT rid, string_agg(lower(printf('%02x', best % 64)), '' ORDER BY p) AS code, CAST(sum(best // 64) AS BIGINT) AS error FROM a{rounds} GROUP BY rid)
        SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, sha AS codebooks_sha256
        FROM kept k JOIN coded c ON k.rid = c.rid CROSS JOIN books"""


ORACLE_SQL: dict[str, str] = {
    "op7_url_filter": f"""
        WITH rules(rhost, rpath, rverdict) AS (VALUES {_RULE_ROWS}),
        cut AS (
            SELECT row_number() OVER () AS rid, page_id,
                   CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
            FROM pages),
        parts AS (
            SELECT rid, page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut),
        fits AS (
            SELECT rid, rhost || rpath AS rule, rverdict,
                   row_number() OVER (PARTITION BY rid ORDER BY length(rhost) + length(rpath) DESC, length(rhost) DESC) AS k
            FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
        SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict
        FROM parts LEFT JOIN fits ON parts.rid = fits.rid AND fits.k = 1""",
    "op2_ngram_join": r"""
        WITH RECURSIVE raw AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
            FROM raw),
        inv AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
        links AS (
            SELECT a.doc_id AS x, b.doc_id AS y
            FROM inv a JOIN inv b ON a.t = b.t AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(r.least_id, s.doc_id)) AS component_id
        FROM sets s LEFT JOIN (SELECT x, min(y) AS least_id FROM reach GROUP BY x) r ON s.doc_id = r.x""",
    "op12_source_divergence": r"""
        WITH docs AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents),
        kept AS (
            SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM docs) GROUP BY lang, term HAVING count(*) >= 30),
        found AS (
            SELECT lang, source, term, count(*) AS c FROM (SELECT lang, source, unnest(w) AS term FROM docs) SEMI JOIN kept USING (lang, term)
            GROUP BY lang, source, term),
        sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        grps AS (SELECT DISTINCT lang, source FROM docs),
        totals AS (
            SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM grps g LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source GROUP BY g.lang, g.source),
        priced AS (
            SELECT t.lang, t.source, k.term, coalesce(f.c, 0) AS c, CAST(1 + (1000000000 * CAST(coalesce(f.c, 0) + 5 AS HUGEINT)) // (t.n + 5 * s.v) AS BIGINT) AS p
            FROM totals t JOIN sizes s USING (lang) JOIN kept k USING (lang) LEFT JOIN found f ON f.lang = t.lang AND f.source = t.source AND f.term = k.term),
        whole AS (
            SELECT lang, term, sum(c) AS c FROM found GROUP BY lang, term),
        whole_priced AS (
            SELECT w.lang, w.term, CAST(1 + (1000000000 * CAST(w.c + 5 AS HUGEINT)) // ((SELECT sum(x.c) FROM whole x WHERE x.lang = w.lang) + 5 * s.v) AS BIGINT) AS q
            FROM whole w JOIN sizes s USING (lang)),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, 0 AS value
            FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source WHERE a.lang NOT IN (SELECT lang FROM sizes)
            UNION ALL
            SELECT a.lang, a.source, 'pair', b.source, sum(abs(a.p - b.p))
            FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
        terms AS (
            SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - w.q AS value
            FROM priced p JOIN whole_priced w USING (lang, term) WHERE p.c > 0 AND p.p > w.q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
    "op13_vector_codes": _vector_codes_sql(),
}
