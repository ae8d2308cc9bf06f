"""Scalar column expressions (F1..F14, P3, P5, hashing helpers).

All functions map Column -> Column and stay inside whole-stage codegen:
no Python UDFs. Every formula is written so that DuckDB can evaluate the
same arithmetic in the same order (see the oracle SQL in ``plans``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for identical results.
TICKS_PER_UNIT = 10_000          # 4-decimal truncation
LOC_DECAY_BASE = 0.9             # position decay base
LOC_DECAY_FLOOR = 0.5
TIME_DECAY_FLOOR = 0.5
POPULARITY_FLOOR = 0.2
ORDER_PENALTY = 0.8              # related item came earlier
EDGE_WEIGHT_FLOOR = 3.0          # graph edge popularity-ratio floor
EDGE_REVERSE_FACTOR = 0.8
EDGE_TIME_UNIT_SECONDS = 43_200  # 12 hours
HOUR_SECONDS = 3_600
MISSING_AFFINITY = 0.5           # similarity when a vector is missing


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ, independent of the
    session time zone (DuckDB: ``epoch_us``)."""
    if isinstance(ts, str):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    raise TypeError("epoch_micros expects a column name")


def trunc_ticks(x: str | Column, ticks: int = TICKS_PER_UNIT) -> Column:
    """F1 as integer ticks: ``int(x * 10^4)`` (toward zero) as BIGINT.

    Summing ticks reproduces a running ``trunc4(prev + x)`` exactly for
    non-negative terms and is order independent."""
    scaled = col_(x) * F.lit(float(ticks))
    return F.when(scaled >= 0, F.floor(scaled)).otherwise(F.ceil(scaled)).cast("bigint")


def trunc4(x: str | Column) -> Column:
    """``int(x*10^4)/10^4``."""
    return trunc_ticks(x) / F.lit(float(TICKS_PER_UNIT))


def loc_decay(distance: str | Column) -> Column:
    """F2: ``max(0.5, 0.9^distance)``."""
    return F.greatest(F.lit(LOC_DECAY_FLOOR), F.pow(F.lit(LOC_DECAY_BASE), col_(distance).cast("double")))


def time_decay(dt: str | Column) -> Column:
    """``max(0.5, 1/(1+dt))``."""
    return F.greatest(F.lit(TIME_DECAY_FLOOR), F.lit(1.0) / (F.lit(1.0) + col_(dt)))


def popularity_damp(clicks: str | Column) -> Column:
    """F4 (recall form): ``max(0.2, 1/(1+clicks))``."""
    return F.greatest(F.lit(POPULARITY_FLOOR), F.lit(1.0) / (F.lit(1.0) + col_(clicks)))


def activity_damp(item_users: str | Column, seq_len: str | Column) -> Column:
    """F5 denominator: ``ln(1+users(item)) * ln(1+len(seq))``."""
    return F.log(F.lit(1.0) + col_(item_users)) * F.log(F.lit(1.0) + col_(seq_len))


def order_penalty(loc1: str | Column, loc2: str | Column) -> Column:
    """0.8 when the related item came earlier."""
    return F.when(col_(loc1) > col_(loc2), F.lit(ORDER_PENALTY)).otherwise(F.lit(1.0))


def edge_weight(count_src: str | Column, count_dst: str | Column, dt_units: str | Column,
                reverse: bool = False) -> Column:
    """``max(3, ln(1+a/b)) [* 0.8] / (1+dt)``."""
    base = F.greatest(F.lit(EDGE_WEIGHT_FLOOR),
                      F.log(F.lit(1.0) + col_(count_src).cast("double") / col_(count_dst).cast("double")))
    if reverse:
        base = base * F.lit(EDGE_REVERSE_FACTOR)
    return base / (F.lit(1.0) + col_(dt_units))


def dot_unrolled(a: str | Column, b: str | Column, start: int, stop: int) -> Column:
    """Inner product of slices ``[start, stop)`` (0-based) written as an
    explicit left-to-right sum so it compiles to straight-line codegen."""
    a, b = col_(a), col_(b)
    acc = None
    for k in range(start, stop):
        term = a[k].cast("double") * b[k].cast("double")
        acc = term if acc is None else acc + term
    return acc


def dot(a: str | Column, b: str | Column) -> Column:
    """inner product of two equal-length arrays (any length)."""
    return F.aggregate(F.zip_with(col_(a), col_(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(a: str | Column) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalize(a: str | Column) -> Column:
    """vector / Euclidean norm."""
    norm = l2_norm(a)
    return F.transform(col_(a), lambda x: x.cast("double") / norm)


def cosine(a: str | Column, b: str | Column) -> Column:
    return dot(a, b) / (l2_norm(a) * l2_norm(b))


def affinity(a: str | Column, b: str | Column) -> Column:
    """F8 for whole vectors."""
    return F.coalesce(trunc4(F.lit(0.5) * cosine(a, b) + F.lit(0.5)), F.lit(MISSING_AFFINITY))


def hash32(*parts: str | Column) -> Column:
    """Unsigned 32-bit integer from the first 8 hex digits of
    ``md5(concat_ws('|', parts))``. Deterministic across runs, executors and
    engines (DuckDB: ``('0x' || substr(md5(s),1,8))::BIGINT``)."""
    s = F.concat_ws("|", *[col_(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def uniform01(*parts: str | Column) -> Column:
    """Deterministic uniform in [0, 1) from ``hash32``."""
    return hash32(*parts) / F.lit(4294967296.0)


def hash_bucket(value: str | Column, num_buckets: int, mask_zero: bool = False) -> Column:
    """string hash mod n; with ``mask_zero`` the value 0/'0' stays 0 and
    everything else lands in 1..n-1. (md5-based, not the reference's hash
    function: bucket ids differ, the distribution contract is the same.)"""
    v = col_(value).cast("string")
    h = hash32(v)
    if not mask_zero:
        return F.pmod(h, F.lit(num_buckets))
    return F.when(v == F.lit("0"), F.lit(0).cast("bigint")).otherwise(
        F.pmod(h, F.lit(num_buckets - 1)) + F.lit(1))


def threshold_binarize(x: str | Column, threshold: float) -> Column:
    """``x > t ? 1 : 0`` (threshold 0 allowed)."""
    return (col_(x) > F.lit(threshold)).cast("int")


def sigmoid(x: str | Column) -> Column:
    """F13."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col_(x)))


def ndcg_gain(rank0: str | Column) -> Column:
    """``1/log2(rank+2)`` for a 0-based rank."""
    return F.lit(1.0) / F.log2(col_(rank0).cast("double") + F.lit(2.0))


def presence_flag(c: str | Column) -> Column:
    """Not null -> 'Yes', null -> 'No'."""
    return F.when(col_(c).isNotNull(), F.lit("Yes")).otherwise(F.lit("No"))


def rescale(c: str | Column, a: float, b: float) -> Column:
    """P5: affine map ``x*a+b``."""
    return col_(c) * F.lit(float(a)) + F.lit(float(b))
