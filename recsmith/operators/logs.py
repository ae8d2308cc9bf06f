"""Interaction-log operators: cleaning, per-user windows, splits, counts.

Conventions: a log has ``user_id``, ``item_id`` and a numeric time column
(``time_us`` BIGINT micros or ``time`` DOUBLE seconds). Every ordering
ends with the item id so ties in time have one defined order (Q18).

Skew: counts and "latest" selections are aggregations (map-side partial
aggregation, no single hot task); per-user positions, histories and next
values go through ``operators.sequence``, which keeps the plain window for
normal users and spreads users above a row threshold over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.functions.arrays import pad_zero
from recsmith.operators.encode import attach_scalars, range_numbered
from recsmith.operators.sequence import HOT_KEY_ROWS, HotSet, hot_of, positions, with_history, with_next


# ---------------------------------------------------------------- cleaning

def dedup_exact(log: DataFrame, cols=("user_id", "item_id", "time_us")) -> DataFrame:
    """Drop exact duplicate (user, item, time) rows."""
    return log.dropDuplicates(list(cols))


def latest_click(log: DataFrame, keys=("user_id", "item_id"), time_col: str = "time_us") -> DataFrame:
    """Keep the last row per key by time.

    Written as ``max(struct(time, rest...))`` per key instead of a
    row_number window: the partial aggregate combines map-side, so a hot
    key never lands whole in one task."""
    keys = list(keys)
    rest = [c for c in log.columns if c not in keys and c != time_col]
    best = F.max(F.struct(F.col(time_col), *[F.col(c) for c in rest])).alias("_best")
    out = log.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in [time_col] + rest]).select(*log.columns)


def union_logs(*parts: DataFrame) -> DataFrame:
    """Concatenate log parts by column name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union then distinct."""
    return a.unionByName(b).distinct()


def keep_positive(df: DataFrame, label: str = "label", keys=("user_id", "item_id")) -> DataFrame:
    """``label == 1`` then distinct keys."""
    return df.where(F.col(label) == 1).select(*keys).distinct()


# ------------------------------------------------------------ per-user order

def _order(time_col: str, item_col: str, desc: bool = False) -> list[Column]:
    if desc:
        return [F.col(time_col).desc(), F.col(item_col).desc()]
    return [F.col(time_col).asc(), F.col(item_col).asc()]


def sequence_position(log: DataFrame, user: str = "user_id", item: str = "item_id",
                      time_col: str = "time_us", desc: bool = False, name: str = "loc",
                      hot_threshold: int = HOT_KEY_ROWS) -> DataFrame:
    """0-based position in the user's time order (``desc`` = recency)."""
    return positions(log, user, [time_col, item], desc=desc, loc=name, size=None, threshold=hot_threshold)


def leave_one_out_split(log: DataFrame, user: str = "user_id", item: str = "item_id",
                        time_col: str = "time_us", hot_threshold: int = HOT_KEY_ROWS) -> DataFrame:
    """Latest row per user is ``test``, the rest ``train``."""
    out = with_next(log, user, [time_col, item], {}, threshold=hot_threshold, last_flag="_last")
    return out.withColumn("split", F.when(F.col("_last"), F.lit("test")).otherwise(F.lit("train"))) \
        .drop("_last")


def leave_two_out_split(log: DataFrame, user: str = "user_id", item: str = "item_id",
                        time_col: str = "time_us", holdout: str = "latest",
                        hot_threshold: int = HOT_KEY_ROWS, known: HotSet | None = None) -> DataFrame:
    """Per-user rank 1 = test, 2 = validate, >2 = train (Q1).

    ``holdout='latest'`` ranks newest first (documented intent);
    ``'earliest'`` ranks oldest first (what the reference code does)."""
    pos = positions(log, user, [time_col, item], desc=(holdout == "latest"), loc="_rk", size=None,
                    threshold=hot_threshold, known=known or hot_of(log))
    return pos.withColumn("split", F.when(F.col("_rk") == 0, "test").when(F.col("_rk") == 1, "validate")
                          .otherwise("train")).drop("_rk")


def time_gap(log: DataFrame, user: str = "user_id", item: str = "item_id", time_col: str = "time",
             scale: float = 1.0, name: str = "gap", drop_null: bool = True,
             hot_threshold: int = HOT_KEY_ROWS) -> DataFrame:
    """W6 (+P9): next event time minus this one, per user, divided by
    ``scale`` (3600 for hours). The last event of a user has no gap and is
    dropped when ``drop_null``."""
    out = with_next(log, user, [time_col, item], {time_col: "_nt"}, threshold=hot_threshold, known=hot_of(log))
    out = out.withColumn(name, (F.col("_nt") - F.col(time_col)) / F.lit(float(scale))).drop("_nt")
    return out.where(F.col(name).isNotNull()) if drop_null else out


def click_history(log: DataFrame, cols: dict[str, str], n: int = 20, user: str = "user_id",
                  item: str = "item_id", time_col: str = "time_us", pad: bool = True,
                  with_split: bool = False, hot_threshold: int = HOT_KEY_ROWS) -> DataFrame:
    """W2/W3 (+H1, +W4): previous ``n`` values of each source column,
    current row excluded, optionally zero padded to ``n``.

    ``cols`` maps source column -> output column. All histories and the
    split flag share one window specification, hence one sort; users above
    ``hot_threshold`` rows are handled without a per-user task."""
    out = with_history(log, user, [time_col, item], cols, n, threshold=hot_threshold,
                       last_flag="_last" if with_split else None)
    if pad:
        for dst in cols.values():
            out = out.withColumn(dst, pad_zero(dst, n))
    if with_split:
        out = out.withColumn("split", F.when(F.col("_last"), F.lit("test")).otherwise(F.lit("train"))).drop("_last")
    return out


def causal_prefix(log: DataFrame, value: str, user: str = "user_id", item: str = "item_id",
                  time_col: str = "time_us", name: str = "prefix") -> DataFrame:
    """H5: position i sees positions <= i (running frame)."""
    w = (Window.partitionBy(user).orderBy(*_order(time_col, item))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return log.withColumn(name, F.collect_list(F.col(value)).over(w))


def rank_in_group(df: DataFrame, group: str, score: str, tiebreak: list[str], k: int | None = None,
                  name: str = "rank") -> DataFrame:
    """1-based rank by score desc with a total tie-break;
    keep ``rank <= k`` (Spark plans a WindowGroupLimit below the window)."""
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), *[F.col(c).asc() for c in tiebreak])
    out = df.withColumn(name, F.row_number().over(w))
    return out.where(F.col(name) <= k) if k is not None else out


# ------------------------------------------------------------ aggregations

def item_popularity(log: DataFrame, item: str = "item_id") -> DataFrame:
    """A1: clicks per item."""
    return log.groupBy(item).agg(F.count(F.lit(1)).alias("clicks"))


def item_user_count(log: DataFrame, item: str = "item_id", user: str = "user_id") -> DataFrame:
    """A2: distinct users per item."""
    return log.groupBy(item).agg(F.countDistinct(user).alias("users"))


def item_first_seen(log: DataFrame, item: str = "item_id", time_col: str = "time") -> DataFrame:
    """A3: earliest time per item."""
    return log.groupBy(item).agg(F.min(time_col).alias("first_seen"))


def item_stats(log: DataFrame, item: str = "item_id", user: str = "user_id",
               time_col: str = "time") -> DataFrame:
    """A1+A2+A3 in one aggregation pass."""
    return log.groupBy(item).agg(F.count(F.lit(1)).alias("clicks"),
                                 F.countDistinct(user).alias("users"),
                                 F.min(time_col).alias("first_seen"))


def user_sequences(log: DataFrame, user: str = "user_id", item: str = "item_id",
                   time_col: str = "time_us") -> DataFrame:
    """A4/A5: per-user time-ordered item and time arrays plus length.

    ``array_sort`` of (time, item) structs makes the order independent of
    how rows arrive at the aggregate."""
    seq = F.array_sort(F.collect_list(F.struct(F.col(time_col).alias("t"), F.col(item).alias("i"))))
    return (log.groupBy(user).agg(seq.alias("_seq"))
            .select(user, F.col("_seq.i").alias("items"), F.col("_seq.t").alias("times"),
                    F.size("_seq").alias("n")))


def user_activity(log: DataFrame, user: str = "user_id") -> DataFrame:
    """A5: sequence length per user."""
    return log.groupBy(user).agg(F.count(F.lit(1)).alias("n"))


def user_click_set(log: DataFrame, user: str = "user_id", item: str = "item_id",
                   distinct: bool = False) -> DataFrame:
    """All items a user clicked, sorted (``distinct`` for the export)."""
    agg = F.collect_set(item) if distinct else F.collect_list(item)
    return log.groupBy(user).agg(F.array_sort(agg).alias("items"))


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct (item, category)."""
    return df.select(a, b).distinct()


def n_unique(df: DataFrame, c: str) -> DataFrame:
    """Number of distinct values."""
    return df.agg(F.countDistinct(c).alias("n_unique"))


def upper_median(df: DataFrame, c: str) -> DataFrame:
    """``sorted(values)[n // 2]`` over all rows.

    An order statistic over the value histogram: values are range
    partitioned and no task holds all of them."""
    hist = range_numbered(df.groupBy(c).agg(F.count(F.lit(1)).alias("_k")), [F.col(c).asc()])
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    # running counts inside each range, shifted by the counts of the ranges
    # before it (one row per partition: a bounded broadcast)
    inside = Window.partitionBy("_pid").orderBy("_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = hist.groupBy("_pid").agg(F.sum("_k").alias("_sum"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_pid", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off"))
    cum = hist.join(F.broadcast(offsets), "_pid").withColumn("_cum", F.col("_off") + F.sum("_k").over(inside))
    return (attach_scalars(cum, total)
            .where((F.col("_cum") > F.floor(F.col("_n") / 2)) & (F.col("_cum") - F.col("_k") <= F.floor(F.col("_n") / 2)))
            .select(F.col(c).alias("median")))
