"""Operator 7: URL filters by a sort-merge range join.

A host is written label by label from the top (``www.example.com`` -> ``com.example.www.``),
so a host and all its subdomains are the keys with one prefix, that is one interval of the
sorted keys. Rules and URLs are dealt out by key range (a rule to every range its interval
touches), sorted together, and swept once: a stack holds the rules whose interval contains
the current key (intervals of prefixes nest, so what ends first is on top). Among the rules
on the stack whose path is a prefix of the URL's path, the longest wins (characters of host
and path together; equal: the longer host, then ``block``).

Range bounds come from a bounded sample of the keys and only deal out the work; equal keys
are split by a hash of the row, so one host may hold any part of the rows.

Defined cases: a null URL or one without ``://`` has an empty host and path and gets the
default verdict unless a rule names the empty host; hosts are lower-cased (A-Z); rules with
a null host or verdict are ignored, a null path counts as empty; repeated rules do no harm;
repeated URL rows are all returned; extra columns are ignored; empty tables give empty
results, or every URL the default.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lowest_hashes, partitions

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PER_RANGE = 50  # sampled keys for each range
END = chr(0x10FFFF)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL column."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, url.substr(F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWERED), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _ranges(bounds: list[tuple[str, int]]):
    def run(batches):
        for b in batches:
            keys, salts = b.column("key").to_pylist(), b.column("salt").to_pylist()
            yield b.append_column("part", pa.array([bisect_right(bounds, (k, s)) for k, s in zip(keys, salts)], pa.int32()))

    return run


def _spread(bounds: list[tuple[str, int]]):
    """Each rule to all ranges between its key and the end of its interval."""
    low = -(2**63)

    def run(batches):
        for b in batches:
            take, parts = [], []
            for i, k in enumerate(b.column("key").to_pylist()):
                span = range(bisect_right(bounds, (k, low)), bisect_right(bounds, (k + END, low)) + 1)
                take += [i] * len(span)
                parts += span
            yield b.take(pa.array(take, pa.int64())).append_column("part", pa.array(parts, pa.int32()))

    return run


def _fit(level: dict[str, tuple[str, str]], path: str):
    if len(level) <= len(path) + 1:
        return max((p for p in level if path.startswith(p)), key=len, default=None)
    return next((path[:n] for n in range(len(path), -1, -1) if path[:n] in level), None)


def _sweep(default: str):
    def run(batches):
        part, stack = None, []  # stack: (key, host length, {path: (rule, verdict)})
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("part", "key", "kind", "page_id", "host", "path", "verdict")))
            out = []
            for at, key, kind, page, host, path, verdict in rows:
                if at != part:
                    part, stack = at, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, len(host), {}))
                    old = stack[-1][2].get(path)
                    if old is None or verdict == "block":
                        stack[-1][2][path] = (host + path, verdict)
                    continue
                best = None
                for _, n, level in stack:
                    p = _fit(level, path)
                    if p is not None and (best is None or (n + len(p), n) > best[0]):
                        best = ((n + len(p), n), level[p])
                out.append((page, host, path, *(best[1] if best else (None, default))))
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.string()) for c in columns[1:])], names=["page_id", "host", "path", "rule", "verdict"])

    return run


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages(page_id, url, ...)`` under
    ``rules(host, path, verdict)``."""
    n = 4 * partitions(pages.sparkSession)
    host, path = url_parts(F.col("url"))
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), F.xxhash64("page_id", "url").alias("salt"))
    urls = urls.select(F.lit(1).alias("kind"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict"), "salt", host_key(F.col("host")).alias("key"))
    sample = sorted((r.key, r.salt) for r in lowest_hashes(urls.select("key", "salt"), "salt", PER_RANGE * n).orderBy("salt").limit(PER_RANGE * n).collect())
    bounds = sample[PER_RANGE::PER_RANGE]
    rules = rules.filter("host is not null and verdict is not null").select(F.lit(0).alias("kind"), F.lit(None).cast("long").alias("page_id"), F.translate("host", UPPER, LOWERED).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    rules = rules.select("*", F.lit(-(2**63)).cast("long").alias("salt"), host_key(F.col("host")).alias("key"))
    schema = "kind int, page_id long, host string, path string, verdict string, salt long, key string, part int"
    events = urls.mapInArrow(_ranges(bounds), schema).unionByName(rules.mapInArrow(_spread(bounds), schema))
    # a key's bytes and its code points sort alike, and a prefix sorts before what it begins
    events = events.repartition(n, "part").sortWithinPartitions("part", "key", "kind", "path")
    return events.mapInArrow(_sweep(default), "page_id long, host string, path string, rule string, verdict string")
