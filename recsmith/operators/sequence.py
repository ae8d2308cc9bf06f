"""Per-key ordered sequences that stay distributed when one key is huge.

A window ``PARTITION BY user ORDER BY time`` runs each user in one task;
if one user holds a third of the log, that task holds a third of the job.
Here keys with more than ``threshold`` rows are *hot*:

* normal keys keep the plain window (each group is bounded by the threshold);
* hot keys are range partitioned on (key, order) so one key spans many
  tasks; each row's position is its index inside its partition plus the
  row count of the same key in earlier partitions (a table with one row per
  (partition, hot key): bounded, broadcast);
* previous-n values and the next value of hot rows come from equi-joins on
  (key, position) — groups of at most n rows, spread over all tasks.

The hot set itself is found with a grouped count (map-side combined) and is
at most ``rows / threshold`` keys, so it is a proven-small broadcast.
"""

from __future__ import annotations

import os
import sys
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.operators.encode import bounded_broadcast, range_numbered

HOT_KEY_ROWS = 1_000_000


def _order_cols(order: list[str], desc: bool = False) -> list[Column]:
    return [F.col(c).desc() if desc else F.col(c).asc() for c in order]


@dataclass(frozen=True)
class HotSet:
    """Keys detected as hot in some base table and how many there are.
    A hot set found on a table is valid for any subset of it (a key that is
    not hot in the whole cannot be hot in a part), and it only routes work:
    results are identical whichever path a key takes."""
    keys: DataFrame
    n: int


def attach_hot(df: DataFrame, hot: HotSet | None) -> DataFrame:
    """Remember the base table's hot set on a frame derived from it."""
    if hot is not None:
        df._recsmith_hot = hot
    return df


def hot_of(df: DataFrame) -> HotSet | None:
    return getattr(df, "_recsmith_hot", None)


def hot_keys(df: DataFrame, key: str, threshold: int = HOT_KEY_ROWS) -> tuple[DataFrame, int]:
    """Keys with more than ``threshold`` rows and how many there are."""
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("_kn")).where(F.col("_kn") > threshold).select(key)
    if os.environ.get("RECSMITH_TRACE"):
        import time
        import traceback
        t0 = time.time()
        n = hot.count()
        print(f"[hot_keys] {[f.name for f in traceback.extract_stack(limit=4)[:-1]]} {time.time() - t0:.2f}s", file=sys.stderr)
        return hot, n
    n = hot.count()
    return hot, n


def split_hot(df: DataFrame, key: str, threshold: int = HOT_KEY_ROWS,
              known: HotSet | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(normal rows, hot rows or None when no key is hot). ``known`` reuses
    a hot set detected on a table ``df`` is part of (no extra pass)."""
    if known is not None:
        hot, n = known.keys, known.n
    else:
        hot, n = hot_keys(df, key, threshold)
    if n == 0:
        return df, None
    # null is a key like any other (anonymous users are often the largest one)
    hb = bounded_broadcast(hot.select(F.col(key).alias("_hot_key")), n)
    same = df[key].eqNullSafe(F.col("_hot_key"))
    return df.join(hb, same, "left_anti"), df.join(hb, same, "left_semi")


def hot_positions(rows: DataFrame, key: str, order: list[str], desc: bool = False,
                  loc: str = "loc", size: str = "n") -> DataFrame:
    """0-based position within the key (``order`` ascending, or descending)
    and the key's row count, without a per-key window."""
    ranged = range_numbered(rows, [F.col(key).asc()] + _order_cols(order, desc))
    stats = ranged.groupBy("_pid", key).agg(F.min("_idx").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(F.col("_pid").alias("_spid"), F.col(key).alias("_skey"), "_first",
                         F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                         F.sum("_cnt").over(Window.partitionBy(key)).alias("_tot"))
    # one row per (partition, hot key): bounded by partitions x hot keys
    out = ranged.join(F.broadcast(stats), (F.col("_pid") == F.col("_spid")) & ranged[key].eqNullSafe(F.col("_skey")))
    return out.withColumn(loc, (F.col("_off") + F.col("_idx") - F.col("_first")).cast("int")) \
        .withColumn(size, F.col("_tot").cast("bigint")) \
        .drop("_pid", "_idx", "_spid", "_skey", "_first", "_off", "_tot")


def positions(df: DataFrame, key: str, order: list[str], desc: bool = False, loc: str = "loc",
              size: str | None = "n", threshold: int = HOT_KEY_ROWS, known: HotSet | None = None) -> DataFrame:
    """``row_number() - 1`` over (key, order) and optionally the group size,
    with hot keys handled by :func:`hot_positions`."""
    normal, hot = split_hot(df, key, threshold, known)
    w = Window.partitionBy(key).orderBy(*_order_cols(order, desc))
    out = normal.withColumn(loc, (F.row_number().over(w) - 1).cast("int"))
    if size:
        out = out.withColumn(size, F.count(F.lit(1)).over(Window.partitionBy(key)).cast("bigint"))
    if hot is None:
        return out
    h = hot_positions(hot, key, order, desc, loc, size or "_n")
    if not size:
        h = h.drop("_n")
    return out.unionByName(h)


def previous_values(pos: DataFrame, key: str, cols: dict[str, str], n: int, loc: str = "loc") -> DataFrame:
    """For positioned rows: per row, arrays of the previous ``n`` values of
    each source column (oldest first, current row excluded) — the bounded
    ``rowsBetween(-n, -1)`` frame as an equi-join on (key, position)."""
    src = pos.select(key, F.col(loc).alias("_sl"), *[F.col(c).alias(f"_v_{c}") for c in cols])
    contrib = src.withColumn("_d", F.explode(F.sequence(F.lit(1), F.lit(n)))).withColumn(
        "_tl", F.col("_sl") + F.col("_d"))
    packed = F.array_sort(F.collect_list(F.struct(F.col("_sl"), *[F.col(f"_v_{c}") for c in cols])))
    hist = contrib.groupBy(key, "_tl").agg(packed.alias("_h"))
    def field(name):
        return lambda x: x[name]
    # a null value is left out of the list, as collect_list leaves it out
    hist = hist.select(key, "_tl", *[F.filter(F.transform("_h", field(f"_v_{c}")), F.isnotnull).alias(dst)
                                     for c, dst in cols.items()])
    h = hist.withColumnRenamed(key, "_hk")
    out = pos.join(h, pos[key].eqNullSafe(h["_hk"]) & (pos[loc] == h["_tl"]), "left").drop("_hk", "_tl")
    types = dict(pos.dtypes)
    for c, dst in cols.items():
        out = out.withColumn(dst, F.coalesce(F.col(dst), F.array().cast(f"array<{types[c]}>")))
    return out


def next_values(pos: DataFrame, key: str, cols: dict[str, str], loc: str = "loc") -> DataFrame:
    """For positioned rows: the value of each column on the next row of the
    same key (``lead(col, 1)``), null on the last row."""
    nxt = pos.select(F.col(key).alias("_nk"), (F.col(loc) - 1).alias("_nl"),
                     *[F.col(c).alias(dst) for c, dst in cols.items()])
    return pos.join(nxt, pos[key].eqNullSafe(nxt["_nk"]) & (pos[loc] == nxt["_nl"]), "left").drop("_nk", "_nl")


def with_history(df: DataFrame, key: str, order: list[str], cols: dict[str, str], n: int,
                 threshold: int = HOT_KEY_ROWS, last_flag: str | None = None,
                 known: HotSet | None = None) -> DataFrame:
    """Previous-``n`` value arrays per row (``collect_list`` over
    ``rowsBetween(-n, -1)``) and optionally a flag for the key's last row,
    for normal keys with one window sort and for hot keys via positions."""
    normal, hot = split_hot(df, key, threshold, known)
    w = Window.partitionBy(key).orderBy(*_order_cols(order))
    out = normal
    for c, dst in cols.items():
        out = out.withColumn(dst, F.collect_list(F.col(c)).over(w.rowsBetween(-n, -1)))
    if last_flag:
        # a literal, so that a null value on the next row does not look like the end
        out = out.withColumn(last_flag, F.lead(F.lit(1), 1).over(w).isNull())
    if hot is None:
        return out
    pos = hot_positions(hot, key, order, loc="_hloc", size="_hn")
    h = previous_values(pos, key, cols, n, loc="_hloc")
    if last_flag:
        h = h.withColumn(last_flag, F.col("_hloc") == F.col("_hn") - 1)
    return out.unionByName(h.drop("_hloc", "_hn"))


def with_next(df: DataFrame, key: str, order: list[str], cols: dict[str, str],
              threshold: int = HOT_KEY_ROWS, loc: str | None = None, known: HotSet | None = None,
              last_flag: str | None = None) -> DataFrame:
    """``lead(col, 1)`` per key for normal keys; an equi-join on
    (key, position + 1) for hot keys. ``loc`` also returns the position,
    ``last_flag`` whether the row is its key's last one."""
    normal, hot = split_hot(df, key, threshold, known)
    w = Window.partitionBy(key).orderBy(*_order_cols(order))
    out = normal
    if loc:
        out = out.withColumn(loc, (F.row_number().over(w) - 1).cast("int"))
    for c, dst in cols.items():
        out = out.withColumn(dst, F.lead(F.col(c), 1).over(w))
    if last_flag:
        out = out.withColumn(last_flag, F.lead(F.lit(1), 1).over(w).isNull())
    if hot is None:
        return out
    pos = hot_positions(hot, key, order, loc=loc or "_loc", size="_n")
    h = next_values(pos, key, cols, loc=loc or "_loc") if cols else pos
    if last_flag:
        h = h.withColumn(last_flag, F.col(loc or "_loc") == F.col("_n") - 1)
    h = h.drop("_n")
    if not loc:
        h = h.drop("_loc")
    return out.unionByName(h)


def running(df: DataFrame, key: str, order: list[str], sums: dict[str, str] | None = None, lasts: dict[str, str] | None = None,
            threshold: int = HOT_KEY_ROWS, known: HotSet | None = None) -> DataFrame:
    """Running totals (``sums``: column -> new column) and last values that are
    not null (``lasts``) per key, the current row included. Normal keys take one
    window; a hot key is range partitioned, runs inside its partitions, and
    what earlier partitions hold comes from a table with one row for each
    (partition, hot key)."""
    sums, lasts = sums or {}, lasts or {}
    normal, hot = split_hot(df, key, threshold, known)
    upto = Window.partitionBy(key).orderBy(*_order_cols(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def add(rows: DataFrame, window) -> DataFrame:
        return rows.select("*", *[F.sum(c).over(window).alias(dst) for c, dst in sums.items()],
                           *[F.last(c, ignorenulls=True).over(window).alias(dst) for c, dst in lasts.items()])

    out = add(normal, upto)
    if hot is None:
        return out
    ranged = range_numbered(hot, [F.col(key).asc()] + _order_cols(order))
    own = add(ranged, Window.partitionBy("_pid", key).orderBy("_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = ranged.groupBy("_pid", key).agg(*[F.sum(c).alias(f"_s_{c}") for c in sums],
                                            *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_idx"))).alias(f"_l_{c}") for c in lasts],
                                            F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(F.col("_pid").alias("_bpid"), F.col(key).alias("_bkey"),
                          *[F.sum(f"_s_{c}").over(earlier).alias(f"_bs_{c}") for c in sums],
                          *[F.last(f"_l_{c}", ignorenulls=True).over(earlier).alias(f"_bl_{c}") for c in lasts])
    # one row per (partition, hot key): bounded by partitions x hot keys
    joined = own.join(F.broadcast(before), (F.col("_pid") == F.col("_bpid")) & own[key].eqNullSafe(F.col("_bkey")))
    types = dict(out.dtypes)
    full = {dst: (F.col(dst) + F.coalesce(F.col(f"_bs_{c}"), F.lit(0))).cast(types[dst]) for c, dst in sums.items()}
    full |= {dst: F.coalesce(dst, f"_bl_{c}") for c, dst in lasts.items()}
    return out.unionByName(joined.select(*[full.get(c, F.col(c)).alias(c) for c in out.columns]))


def join_per_key(df: DataFrame, per_key: DataFrame, key: str, how: str = "left", threshold: int = HOT_KEY_ROWS,
                 known: HotSet | None = None) -> DataFrame:
    """``df`` with the other columns of ``per_key`` (one row a key, null a key
    like any other). Rows of hot keys meet a broadcast of those keys' rows
    only (bounded like the hot set), so that no key is joined in one task."""
    side = per_key.withColumnRenamed(key, "_pk")
    normal, hot = split_hot(df, key, threshold, known)

    def joined(rows: DataFrame, small: DataFrame) -> DataFrame:
        return rows.join(small, rows[key].eqNullSafe(F.col("_pk")), how).drop("_pk")

    out = joined(normal, side)
    if hot is None:
        return out
    keys = hot.select(F.col(key).alias("_hk")).distinct()
    few = side.join(F.broadcast(keys), F.col("_pk").eqNullSafe(F.col("_hk")), "left_semi")
    return out.unionByName(joined(hot, F.broadcast(few)))
