"""Matching rows to keys (P1-P4) and the joins built on it.

Every match is an equi-join on the key columns -- never a literal ``IN`` list,
so a key list of any size works -- and every operator is DataFrame in,
DataFrame out. Rules:

* ``match="tuple"`` (default): a row matches when its whole key tuple is in
  the list (a composite primary key).
* ``match="per_column"``: a row matches when *each* key column's value is
  somewhere in that column of the list (the cross product of the columns).
  Kept as an opt-in because it deletes tuples nobody asked for.
* ``scope``: an optional predicate a row must also satisfy to be deleted,
  e.g. ``active = 0`` to erase only closed history versions.

Join strategy: ``broadcast_keys=True`` is for a key list whose size the
caller has checked (it is then copied to every executor and the table is
never shuffled); ``False`` forces a shuffle join (sort-merge), whose skewed
partitions AQE splits; ``None`` leaves the choice to Spark's statistics.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DateType, DecimalType, IntegralType, StringType, TimestampNTZType,
                               TimestampType)

MATCH_MODES = ("tuple", "per_column")
# The bitmaps of key hashes that a shuffle join broadcasts to keep rows without a match out of it take at most this
# much, whatever the limit for key lists is; a key gets BITS_A_KEY bits, or fewer (LEAST_BITS at least) so that all fit.
BITMAP_BYTES = 16 << 20
BITS_A_KEY, LEAST_BITS = 16, 4
# Values of these types are equal exactly where their bytes are, so equal keys have equal hashes.
PLAIN = (IntegralType, BooleanType, DateType, TimestampType, TimestampNTZType, DecimalType, BinaryType)


@dataclass
class KeySpec:
    """One set of keys against one target: the key DataFrame must carry
    columns named (and typed) like the table's key columns."""
    keys: DataFrame
    key_cols: list[str]
    match: str = "tuple"
    broadcast: bool | None = None
    distinct: bool = True        # False when the keys are already distinct
    hot: DataFrame | None = None  # tuple mode, shuffle join: keys holding very many rows
    salt_buckets: int = 64

    def __post_init__(self):
        if self.match not in MATCH_MODES:
            raise ValueError(f"match must be one of {MATCH_MODES}, got {self.match!r}")
        if not self.key_cols:
            raise ValueError("at least one key column is required")


def estimate_bytes(keys: DataFrame, key_cols: list[str] | None = None) -> int:
    """In-memory size estimate of a key relation, measured (one aggregation
    job): rows x (row header + 8 bytes per fixed-width column) + string bytes."""
    kc = key_cols or keys.columns
    strings = [c for c in kc if keys.schema[c].dataType.typeName() in ("string", "binary")]
    fixed = len(kc) - len(strings)
    agg = [F.count(F.lit(1)).alias("n")]
    agg.append(F.sum(sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in strings)).alias("b") if strings
               else F.lit(0).alias("b"))
    row = keys.select(*kc).agg(*agg).first()
    n, b = int(row["n"] or 0), int(row["b"] or 0)
    return n * (16 + 8 * fixed + 8 * len(strings)) + b


def keys_fit_broadcast(keys: DataFrame, key_cols: list[str] | None = None, limit_bytes: int | None = None) -> bool:
    """True when the measured key relation is within the broadcast limit
    (default: the session's ``spark.sql.autoBroadcastJoinThreshold``)."""
    if limit_bytes is None:
        limit_bytes = int(keys.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return 0 <= estimate_bytes(keys, key_cols) <= limit_bytes


def _hinted(df: DataFrame, broadcast: bool | None) -> DataFrame:
    if broadcast is True:
        return F.broadcast(df)
    if broadcast is False:
        return df.hint("merge")
    return df


def _columns(spec: KeySpec) -> list[DataFrame]:
    """The key relations to join: one tuple relation, or one per column."""
    if spec.match == "tuple":
        k = spec.keys.select(*spec.key_cols)
        return [k.distinct() if spec.distinct else k]
    return [spec.keys.select(c).distinct() for c in spec.key_cols]


def _join_cols(spec: KeySpec) -> list[list[str]]:
    return [spec.key_cols] if spec.match == "tuple" else [[c] for c in spec.key_cols]


def flag_matches(df: DataFrame, specs: list[KeySpec], scope: Column | None = None,
                 hit_col: str = "_hit") -> DataFrame:
    """Adds ``_hit_<i>`` per key set and ``_hit`` = (any set matches) AND scope.

    Left outer joins against de-duplicated keys, so the row count never
    changes; the table's columns keep their order, flags are appended.
    """
    cols = df.columns
    out = df
    flags = []
    for i, spec in enumerate(specs):
        parts = []
        if spec.hot is not None and spec.match == "tuple" and not spec.broadcast:
            out, hot_flag, salt = _salt_hot(out, spec, i, cols)
            parts_hot = [F.coalesce(F.col(hot_flag), F.lit(False))]
        else:
            salt, parts_hot = None, []
        for j, (rel, on) in enumerate(zip(_columns(spec), _join_cols(spec))):
            name = f"_hit_{i}_{j}"
            rel = rel.withColumn(name, F.lit(True))
            if salt is not None:
                rel, on = rel.withColumn(salt, F.lit(0)), on + [salt]
            out = out.join(_hinted(rel, spec.broadcast), on=on, how="left")
            parts.append(F.coalesce(F.col(name), F.lit(False)))
        if parts_hot:
            parts = [reduce(lambda a, b: a & b, parts) | parts_hot[0]]
        flag = f"_hit_{i}"
        out = out.withColumn(flag, reduce(lambda a, b: a & b, parts))
        flags.append(flag)
    in_scope = F.lit(True) if scope is None else F.coalesce(scope, F.lit(False))
    hit = reduce(lambda a, b: a | b, [F.col(f) for f in flags]) & in_scope
    return out.select(*cols, *[(F.col(f) & in_scope).alias(f) for f in flags], hit.alias(hit_col))


def _plain(dtype) -> bool:
    return isinstance(dtype, PLAIN) or dtype == StringType()       # a string without a collation of its own


def may_match(df: DataFrame, specs: list[KeySpec], counts: list[int], may: str = "_may") -> DataFrame | None:
    """Adds ``_may``: false only for rows that match no key set (``counts``: how many keys each has).

    The keys' hashes are the bits of a bitmap, which is broadcast in pieces of 4 KB and looked up for each row: with
    ``BITS_A_KEY`` bits for each key, one in so many rows without a match is taken for a candidate. None where the
    bitmaps would not fit ``BITMAP_BYTES`` or a key's equality is not that of its bytes (floats, collated strings)."""
    wanted = [(spec, n, on) for spec, n in zip(specs, counts) for on in _join_cols(spec)]
    if not all(_plain(df.schema[c].dataType) and df.schema[c].dataType == spec.keys.schema[c].dataType for spec, _, on in wanted for c in on):
        return None
    keys = max(1, sum(n for _, n, _ in wanted))
    each = min(BITS_A_KEY, BITMAP_BYTES * 8 // keys)
    if each < LEAST_BITS:
        return None
    out, found = df, []
    for i, (spec, n, on) in enumerate(wanted):
        place = F.pmod(F.xxhash64(*on), F.lit(max(1, each * n)).cast("long")) + 1
        bucket, bits = f"_bucket_{i}", f"_bits_{i}"
        table = (spec.keys.select(place.alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias(bucket))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias(bits)))
        out = out.join(F.broadcast(table), F.bitmap_bucket_number(place) == F.col(bucket), "left")
        at = F.bitmap_bit_position(place)
        byte = F.conv(F.hex(F.substr(F.col(bits), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        found.append((spec, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))))
    sets = [reduce(lambda a, b: a & b, [f for s, f in found if s is spec]) for spec in specs]
    return out.select(*df.columns, reduce(lambda a, b: a | b, sets).alias(may))


def flag_candidates(df: DataFrame, specs: list[KeySpec], counts: list[int], scope: Column | None = None,
                    rebalance: list[str] | None = None) -> DataFrame | None:
    """``flag_matches`` where only rows that may match go through its shuffle join (and a REBALANCE by the
    ``rebalance`` columns); all others are flagged where they are read. ``df`` is read twice. None as ``may_match``."""
    judged = may_match(df, specs, counts)
    if judged is None:
        return None
    joined = flag_matches(judged.where("_may").drop("_may"), specs, scope)
    if rebalance:
        joined = joined.hint("rebalance", *rebalance)
    flags = [c for c in joined.columns if c not in df.columns]
    return judged.where("not _may").select(*df.columns, *[F.lit(False).alias(c) for c in flags]).unionAll(joined)


def _salt_hot(out: DataFrame, spec: KeySpec, i: int, cols: list[str]) -> tuple[DataFrame, str, str]:
    """Split hot keys off a shuffle join.

    The few keys that hold very many rows (a bounded list, so it is
    broadcast) are flagged without a shuffle; their rows then get a salt
    1..N from a hash of the row (deterministic, so task retries agree) while
    every other row and every key on the other side gets salt 0. Joining on
    (key, salt) spreads a hot key's rows over N reducers, where they match
    nothing, and leaves the other rows' matches unchanged.
    """
    hot_flag, salt = f"_hot_{i}", f"_salt_{i}"
    # how many reducers a key gets: its own number where the hot list carries one
    size, buckets = (F.col("_buckets") if "_buckets" in spec.hot.columns else F.lit(spec.salt_buckets)), f"_buckets_{i}"
    hot = spec.hot.groupBy(*spec.key_cols).agg(F.max(size).cast("bigint").alias(buckets)).withColumn(hot_flag, F.lit(True))
    out = out.join(F.broadcast(hot), on=spec.key_cols, how="left")
    atomic = [c for c in cols if out.schema[c].dataType.typeName() not in ("map", "array", "struct", "variant")]
    seed = F.xxhash64(*[F.col(c) for c in atomic]) if atomic else F.monotonically_increasing_id()
    out = out.withColumn(salt, F.when(F.col(hot_flag).isNotNull(),
                                      F.pmod(seed, F.col(buckets)) + 1).otherwise(F.lit(0)))
    return out, hot_flag, salt


def _semi_or_anti(df: DataFrame, spec: KeySpec, how: str) -> DataFrame:
    rels, ons = _columns(spec), _join_cols(spec)
    if how == "left_semi":
        out = df
        for rel, on in zip(rels, ons):
            out = out.join(_hinted(rel, spec.broadcast), on=on, how="left_semi")
        return out.select(*df.columns)
    if len(rels) == 1:
        return df.join(_hinted(rels[0], spec.broadcast), on=ons[0], how="left_anti").select(*df.columns)
    return flag_matches(df, [spec]).where(~F.col("_hit")).select(*df.columns)


def match_rows(df: DataFrame, keys: DataFrame, key_cols: list[str] | None = None, match: str = "tuple",
               scope: Column | None = None, broadcast_keys: bool | None = None) -> DataFrame:
    """All columns of the rows to delete (each row once,
    however often its key is listed)."""
    spec = KeySpec(keys, key_cols or keys.columns, match, broadcast_keys)
    base = df if scope is None else df.where(F.coalesce(scope, F.lit(False)))
    return _semi_or_anti(base, spec, "left_semi")


def match_keys(df: DataFrame, keys: DataFrame, key_cols: list[str] | None = None,
               partition_cols: list[str] | None = None, match: str = "tuple",
               scope: Column | None = None, broadcast_keys: bool | None = None) -> DataFrame:
    """Only the key and partition columns of the rows to delete (column-pruned scan)."""
    kc = key_cols or keys.columns
    pc = partition_cols or []
    return match_rows(df, keys, kc, match, scope, broadcast_keys).select(*kc, *[c for c in pc if c not in kc])


def survivors(df: DataFrame, keys: DataFrame, key_cols: list[str] | None = None, match: str = "tuple",
              scope: Column | None = None, broadcast_keys: bool | None = None) -> DataFrame:
    """The rows that stay, in the table's column order."""
    spec = KeySpec(keys, key_cols or keys.columns, match, broadcast_keys)
    if scope is None:
        return _semi_or_anti(df, spec, "left_anti")
    return flag_matches(df, [spec], scope).where(~F.col("_hit")).select(*df.columns)


def rows_in_partitions(df: DataFrame, partitions: DataFrame, partition_cols: list[str],
                       broadcast_partitions: bool | None = None) -> DataFrame:
    """Rows of the listed partitions (a NULL value lists the NULL partition).

    Two branches, so that both prune. Partitions without a NULL are an equi-semi-join: with a broadcast list
    (the caller's word, or Spark's estimate) Spark hands the listed values to the scan, which opens only
    those partitions. Partitions with a NULL are joined null-safely to the rows that have one, a static
    filter on the partition columns; where no NULL is listed, adaptive execution drops that branch unread. That list
    is broadcast unless the caller says no: it is as short as the table has such partitions (one row with one
    column), and a shuffle would send all rows of the NULL partition to one task.
    """
    p = partitions.select(*partition_cols).distinct()
    # "is not null" written as a comparison: run-time pruning is planned only behind a filter that may leave rows out
    whole = reduce(lambda a, b: a & b, [F.length(F.col(c).cast("string")) >= 0 for c in partition_cols])
    out = df.join(_hinted(p.where(whole), broadcast_partitions), on=partition_cols, how="left_semi").select(*df.columns)
    if not any(df.schema[c].nullable for c in partition_cols):
        return out
    some_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in partition_cols])
    other = p.where(some_null).select(*[F.col(c).alias(f"_of_{i}") for i, c in enumerate(partition_cols)])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate(partition_cols)])
    return out.unionAll(df.where(some_null).join(_hinted(other, broadcast_partitions is not False), same, "left_semi").select(*df.columns))


def survivors_in_partitions(df: DataFrame, keys: DataFrame, partitions: DataFrame, partition_cols: list[str],
                            key_cols: list[str] | None = None, match: str = "tuple",
                            scope: Column | None = None, broadcast_keys: bool | None = None,
                            broadcast_partitions: bool | None = None) -> DataFrame:
    """J6 (reordered as J5 then J2): survivors of the impacted partitions only."""
    return survivors(rows_in_partitions(df, partitions, partition_cols, broadcast_partitions), keys, key_cols, match, scope, broadcast_keys)


def keys_found(df: DataFrame, keys: DataFrame, key_cols: list[str] | None = None, match: str = "tuple",
               scope: Column | None = None, broadcast_keys: bool | None = None) -> DataFrame:
    """A4: distinct key tuples present in the table (within scope).

    The table is the probe side and the keys the build side, so with a
    broadcast key list the table is scanned once and never shuffled. In
    ``per_column`` mode these are the tuples actually deleted, which may be
    combinations nobody listed.
    """
    kc = key_cols or keys.columns
    return match_rows(df, keys, kc, match, scope, broadcast_keys).select(*kc).distinct()


def keys_not_found(df: DataFrame, keys: DataFrame, key_cols: list[str] | None = None,
                   scope: Column | None = None, broadcast_keys: bool | None = None) -> DataFrame:
    """Requested key tuples with no row in the table (within scope)."""
    kc = key_cols or keys.columns
    found = keys_found(df, keys, kc, "tuple", scope, broadcast_keys)
    req = keys.select(*kc).distinct()
    return req.join(_hinted(found, broadcast_keys), on=kc, how="left_anti")
