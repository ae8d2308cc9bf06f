"""Sampling operators (N1 negatives, N2 stratified, N3 bootstrap, N4 weighted
choice, H6 per-position negatives).

All randomness is md5-derived from row keys (``hash32``), so a rerun —
including a task retried after an executor loss — draws the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.functions.columns import hash32, uniform01
from recsmith.operators.encode import attach_scalars, bounded_broadcast, dense_ids
from recsmith.operators.sequence import positions
from recsmith.session import cut_lineage


#: Ranks of a user's complement that one row of the rank directory covers.
RANK_BUCKET = 1024
#: Taken items of a user that stand beside each of its rows.
MOST_TAKEN = 1024


def _occurrences(rows: DataFrame, key: list[str]) -> DataFrame:
    """``_dup``: 0 for the first row of a key, 1, 2, ... for repeated ones (null
    is a key value like any other). Only keys that do repeat are numbered, a
    hot one over many tasks."""
    often = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(F.struct(*key).alias("_often"))
    if often.isEmpty():
        return rows.withColumn("_dup", F.lit(0).cast("bigint"))
    keyed = rows.withColumn("_key", F.struct(*key))
    once = keyed.join(often, F.col("_key") == F.col("_often"), "left_anti").withColumn("_dup", F.lit(0).cast("bigint"))
    many = cut_lineage(positions(keyed.join(often, F.col("_key") == F.col("_often"), "left_semi"), "_key", ["_key"], loc="_dup", size=None))
    return once.unionByName(many.withColumn("_dup", F.col("_dup").cast("bigint"))).drop("_key")


def rank_directory(users: DataFrame, taken: DataFrame, n_items: int, bucket: int = RANK_BUCKET) -> tuple[DataFrame, DataFrame]:
    """The items 0..n_items-1 that a user has not taken, by rank, without
    listing them. ``users``: (_u); ``taken``: distinct (_h_user, _pidx).

    The item of rank r is r plus the number of taken items below it. With the
    taken items in order h_0 < h_1 < ..., s_j = h_j - j items that are not taken
    lie below h_j, so that number is #{j : s_j <= r}. Ranks are cut into
    buckets; a row (user, bucket) has the number of taken items before the
    bucket (``_base``) and, for each of its at most ``bucket`` different s, the
    number up to it (``_list``). A rank finds its item by an equi-join on
    (user, r div bucket), see :func:`item_of_rank`.

    Returns ``sizes`` (_u, _C: how many are not taken, none left out) and the
    directory (_du, _b, _base, _list)."""
    placed = positions(taken, "_h_user", ["_pidx"], loc="_j", size=None)
    steps = (placed.groupBy("_h_user", (F.col("_pidx") - F.col("_j")).alias("_s")).agg((F.max("_j") + 1).cast("bigint").alias("_upto"))
             .withColumn("_b", F.floor(F.col("_s") / bucket)))
    lists = steps.groupBy("_h_user", "_b").agg(F.array_sort(F.collect_list(F.struct("_s", "_upto"))).alias("_list"), F.max("_upto").alias("_last"))
    counts = taken.groupBy("_h_user").agg(F.count(F.lit(1)).alias("_taken"))
    sizes = (users.join(counts, F.col("_u").eqNullSafe(F.col("_h_user")), "left")
             .select("_u", (F.lit(n_items) - F.coalesce("_taken", F.lit(0))).alias("_C")).where(F.col("_C") > 0))
    grid = sizes.select(F.col("_u").alias("_du"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_C") - 1) / bucket))).alias("_b"))
    grid = grid.join(lists.withColumnRenamed("_b", "_lb"), F.col("_du").eqNullSafe(F.col("_h_user")) & (F.col("_b") == F.col("_lb")), "left")
    before = Window.partitionBy("_du").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    directory = grid.select("_du", "_b", F.coalesce(F.last("_last", ignorenulls=True).over(before), F.lit(0)).alias("_base"), "_list")
    return sizes, directory


def item_of_rank(draws: DataFrame, directory: DataFrame, bucket: int = RANK_BUCKET) -> DataFrame:
    """``_pidx`` for draws (_u, _r, ...) by the directory."""
    j = draws.withColumn("_rb", F.floor(F.col("_r") / bucket)).join(
        directory, F.col("_u").eqNullSafe(F.col("_du")) & (F.col("_rb") == F.col("_b")))
    below = F.array_max(F.transform(F.filter("_list", lambda x: x["_s"] <= F.col("_r")), lambda x: x["_upto"]))
    return j.withColumn("_pidx", F.col("_r") + F.coalesce(below, F.col("_base"))).drop("_du", "_b", "_rb", "_base", "_list")


def _negatives_by_joins(base: DataFrame, hist: DataFrame, pool_side: DataFrame, n_items: int, user: str, k: int, attempts: int,
                        first_round: int, row_hash) -> DataFrame:
    """(_k, _j, _neg_item, _neg_cat): the negatives of rows whose users have
    taken many items, or of a pool that repeats items, by joins."""
    # 2. rejection draws, in two rounds: every row tries attempts
    #    [0, first_round); only rows still short of k try [first_round,
    #    attempts). The first k accepted by attempt number are exactly those
    #    of a single pass over all attempts, with far fewer rows drawn.
    def draws(keys: DataFrame, lo: int, hi: int) -> DataFrame:
        att = keys.withColumn("_a", F.explode(F.sequence(F.lit(lo), F.lit(hi - 1))))
        att = att.withColumn("_pidx", F.pmod(row_hash(F.col("_a"), attempts), F.lit(max(n_items, 1))).cast("bigint"))
        cand = att.join(pool_side, "_pidx")
        return cand.join(hist, cand["_u"].eqNullSafe(hist["_h_user"]) & (cand["_neg_item"] == hist["_h_item"]),
                         "left_anti").select("_k", "_u", "_a", "_neg_item", "_neg_cat")

    row_keys = base.select("_k", F.col(user).alias("_u"))
    split_at = min(first_round, attempts)
    accepted = cut_lineage(draws(row_keys, 0, split_at))
    if attempts > split_at:
        done = accepted.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k).select("_k")
        accepted = accepted.unionByName(draws(row_keys.join(done, "_k", "left_anti"), split_at, attempts))
    w = Window.partitionBy("_k").orderBy("_a")
    first = accepted.withColumn("_j", F.row_number().over(w) - 1).where(F.col("_j") < k)
    first = cut_lineage(first.select("_k", "_j", "_neg_item", "_neg_cat"))

    # 3. exact remainder for short rows
    got = first.groupBy("_k").agg(F.count(F.lit(1)).alias("_got"))
    short = (row_keys.join(got, "_k", "left").withColumn("_got", F.coalesce(F.col("_got"), F.lit(0)))
             .where(F.col("_got") < k))
    short = cut_lineage(short)
    negs = first
    if n_items and not short.isEmpty():
        users = cut_lineage(short.select("_u").distinct())
        taken = cut_lineage(hist.join(users, F.col("_h_user").eqNullSafe(F.col("_u")), "left_semi")
                            .join(pool_side.select(F.col("_neg_item").alias("_h_item"), "_pidx"), "_h_item")
                            .select("_h_user", "_pidx").distinct())
        sizes, directory = rank_directory(users, taken, n_items)
        sizes = cut_lineage(sizes)
        sizes = bounded_broadcast(sizes.withColumnRenamed("_u", "_su"), sizes.count())
        need = (short.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).where(F.col("_j") >= F.col("_got"))
                .join(sizes, F.col("_u").eqNullSafe(F.col("_su")))
                .withColumn("_r", F.pmod(row_hash(F.col("_j"), k, F.lit("x")), F.col("_C")).cast("bigint")).select("_k", "_u", "_j", "_r"))
        rest = item_of_rank(need, directory).join(pool_side, "_pidx").select("_k", "_j", "_neg_item", "_neg_cat")
        negs = first.unionByName(rest)
    return negs


def _draws_in_row(n_items: int, k: int, attempts: int, first_round: int, row_hash) -> list[tuple[str, Column]]:
    """The columns that lead to ``_negs``, the ranks drawn for a row, from
    ``_taken``, the sorted ranks its user has taken: the draws and the order of
    :func:`_negatives_by_joins`, without a row for each draw."""
    free = F.lit(n_items) - F.size("_taken")

    def tries(lo: int, hi: int) -> Column:
        drawn = F.transform(F.sequence(F.lit(lo), F.lit(hi - 1)), lambda a: F.pmod(row_hash(a, attempts), F.lit(max(n_items, 1))).cast("bigint"))
        return F.filter(drawn, lambda p: ~F.array_contains("_taken", p))

    def of_rank(r: Column) -> Column:
        return r + F.size(F.filter("_below", lambda s: s <= r))

    split_at = min(first_round, attempts)
    short = F.size("_first") < k
    second = F.when(short, F.slice(F.concat("_first", tries(split_at, attempts)), 1, k)) if attempts > split_at else F.when(short, F.col("_first"))
    rest = F.transform(F.sequence(F.size("_first"), F.lit(k - 1)),
                       lambda j: of_rank(F.pmod(row_hash(j, k, F.lit("x")), free).cast("bigint")))
    return [("_first", tries(0, split_at)), ("_first", second.otherwise(F.slice("_first", 1, k))),
            ("_below", F.when(short & (free > 0), F.transform("_taken", lambda h, i: h - i))),
            ("_negs", F.when(short & (free > 0), F.concat("_first", rest)).otherwise(F.col("_first")))]


def negative_sample(rows: DataFrame, pool: DataFrame, history: DataFrame, k: int = 4,
                    attempts: int = 32, user: str = "user_id", item: str = "item_id",
                    category: str = "category", row_key: tuple[str, ...] = ("user_id", "item_id", "time_us"),
                    label: str = "label", first_round: int = 12, distinct_rows: bool = False, most_taken: int = MOST_TAKEN) -> DataFrame:
    """Every row yields itself (label 1) plus ``k`` items the user never
    clicked, drawn uniformly **with replacement**; a negative takes that
    item's category and keeps the rest of the row (context, history).

    Exact, distributed, no per-user pool materialisation:

    1. the pool ``(item, category)`` is numbered 0..N-1 (null is no item);
    2. each row makes ``attempts`` uniform draws ``hash(row, a) mod N``;
       draws landing in the user's history are rejected (anti join) and
       the first ``k`` accepted by attempt number are kept — rejection
       sampling, i.e. uniform over the pool minus the history;
    3. rows still short draw ranks of the complement directly, which the
       :func:`rank_directory` turns into items by equi-joins on (user, bucket);
    4. a user who clicked the whole pool gets fewer negatives (Q16).

    Null users and items are values like others: their rows get negatives, and
    the history of the null user is what its rows have clicked. Rows with equal
    keys are rows of their own with draws of their own; ``distinct_rows`` says
    that there are none, which saves a pass over the keys.

    A user's taken items, up to ``most_taken``, are joined to its rows as an
    array, and steps 2 and 3 are expressions on the row; nothing is moved for a
    draw. Users with more, and pools that repeat items, take the joins.
    """
    key = list(row_key)
    pool = pool.where(F.col(item).isNotNull())
    ids = dense_ids(pool.select(item), item, start=0, name="_pidx")
    # the numbered pool (one row per item) is read by four joins; its size
    # is measured once and decides whether it may be broadcast
    pool_ix = cut_lineage(pool.select(item, category).join(ids, item))
    n_items = pool_ix.count()
    pool_side = bounded_broadcast(
        pool_ix.select("_pidx", F.col(item).alias("_neg_item"), F.col(category).alias("_neg_cat")), n_items)

    # a row is known by its key and occurrence; two structs with nulls in the
    # same places are equal, so joins on it are null-safe
    base = rows.withColumn("_dup", F.lit(0).cast("bigint")) if distinct_rows else _occurrences(rows, key)
    base = base.withColumn("_k", F.struct(*key, "_dup"))

    def row_hash(a: Column, per_row: int, *more):
        """Draw ``a`` of a row; its repetitions go on where it ends."""
        return hash32(*[F.col("_k")[c] for c in key], *more, a + F.col("_k")["_dup"] * F.lit(per_row))

    hist = history.where(F.col(item).isNotNull()).select(F.col(user).alias("_h_user"), F.col(item).alias("_h_item")).distinct()
    taken = (hist.join(pool_side.select(F.col("_neg_item").alias("_h_item"), "_pidx"), "_h_item")
             .select("_h_user", "_pidx"))
    parts = [rows.select(*rows.columns, F.lit(1).alias(label))]
    named = [F.col("_neg_item").alias(item) if c == item else F.col("_neg_cat").alias(category) if c == category else F.col(c) for c in rows.columns]
    by_joins = base
    if ids.count() == n_items:
        # the draws of a row are made where the row is, beside the ranks its
        # user has taken; only users who took very many are left to the joins
        sizes = taken.groupBy("_h_user").agg(F.count(F.lit(1)).alias("_n"))
        large = cut_lineage(sizes.where(F.col("_n") > most_taken).select(F.col("_h_user").alias("_large")))
        n_large = large.count()
        # generated, so that users of one value known beforehand stay a join key
        few, by_joins = base.withColumn("_u", F.explode(F.array(F.col(user)))), None
        if n_large:
            side = bounded_broadcast(large, n_large)
            taken = taken.select(F.explode(F.array("_h_user")).alias("_h_user"), "_pidx").join(
                side, F.col("_h_user").eqNullSafe(F.col("_large")), "left_anti")
            few, by_joins = (few.join(side, F.col("_u").eqNullSafe(F.col("_large")), how) for how in ("left_anti", "left_semi"))
        lists = taken.groupBy("_h_user").agg(F.sort_array(F.collect_list("_pidx")).alias("_taken"))
        drawn = (few.join(lists, F.col("_u").eqNullSafe(F.col("_h_user")), "left")
                 .withColumn("_taken", F.coalesce("_taken", F.array().cast("array<bigint>"))))
        for name, value in _draws_in_row(n_items, k, attempts, first_round, row_hash):
            drawn = drawn.withColumn(name, value)
        drawn = drawn.select(*few.columns, F.explode("_negs").alias("_pidx"))
        parts.append(drawn.join(pool_side, "_pidx").select(*named, F.lit(0).alias(label)))
    if by_joins is not None:
        negs = _negatives_by_joins(by_joins, hist, pool_side, n_items, user, k, attempts, first_round, row_hash)
        parts.append(by_joins.join(negs, "_k").select(*named, F.lit(0).alias(label)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def stratified_sample(df: DataFrame, label: str, key: list[str], rate: float | None = None,
                      default_num: int = 10_000, seed: int = 39, bucket_bits: int = 16) -> DataFrame:
    """Keep each label's share: per label, the ``round(rate*n_label)``
    rows with the smallest ``(hash(key, seed), key)``. Default rate is
    ``min(1, 10000/n)``; a rate >= 1 returns everything (Q11).

    No label is ranked in one task: a histogram of the hash's top
    ``bucket_bits`` bits per label (at most labels x 2^bits rows) locates the
    bucket holding each label's cut; rows in lower buckets are kept outright
    and only the boundary bucket (~n_label / 2^bits rows) is ranked."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nl"))
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    if rate is None:
        rate_col = F.least(F.lit(1.0), F.lit(float(default_num)) / F.col("_n"))
    else:
        rate_col = F.least(F.lit(1.0), F.lit(float(rate)))
    quota = attach_scalars(counts, total).select(label, F.round(rate_col * F.col("_nl")).cast("bigint").alias("_q"))
    h = df.withColumn("_h", hash32(*[F.col(c) for c in key], F.lit(seed))).withColumn(
        "_b", F.shiftright("_h", 32 - bucket_bits))
    hist = h.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    run = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumn("_cum", F.sum("_bn").over(run)).join(quota, label)
    # per label: the first bucket whose running count reaches the quota
    cut = (hist.where((F.col("_cum") >= F.col("_q")) & (F.col("_q") > 0))
           .groupBy(label).agg(F.min_by(F.struct("_b", (F.col("_cum") - F.col("_bn")).alias("_before"), "_q"),
                                        "_b").alias("_c"))
           .select(label, F.col("_c._b").alias("_cb"), (F.col("_c._q") - F.col("_c._before")).alias("_need")))
    # one row per label: the planner broadcasts it if its size allows
    j = h.join(cut, label)
    below = j.where(F.col("_b") < F.col("_cb"))
    edge = j.where(F.col("_b") == F.col("_cb"))
    w = Window.partitionBy(label, "_b").orderBy("_h", *key)
    edge = edge.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= F.col("_need")).drop("_rk")
    return below.unionByName(edge).drop("_h", "_b", "_cb", "_need")


def poisson_cuts(fraction: float) -> list[float]:
    """Values of the Poisson distribution function, up to 1 - 1e-12."""
    term = total = math.exp(-fraction)
    below = [total]
    while total < 1.0 - 1e-12 and len(below) < 200:
        term *= fraction / len(below)
        total += term
        below.append(total)
    return below


def poisson_times(key: list[Column], fraction: float, seed: int) -> Column:
    """How often a bootstrap draws the row of ``key``: Poisson with mean
    ``fraction`` from the key's hash, by the inverse distribution function."""
    u = uniform01(*[c.cast("string") for c in key], F.lit(seed))
    return sum((F.when(u >= F.lit(b), 1).otherwise(0) for b in poisson_cuts(fraction)), F.lit(0))


def bootstrap(df: DataFrame, fraction: float = 0.8, seed: int = 39, key: list[str] | None = None) -> DataFrame:
    """Bootstrap with replacement. How often a row is drawn follows from
    the hash of its ``key`` (all columns by default), so the draw does not
    depend on the partitioning and a retried task draws the same rows."""
    times = poisson_times([F.col(c) for c in key or df.columns], fraction, seed)
    copies = df.withColumn("_times", times).where(F.col("_times") > 0)
    return copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*df.columns)


def weighted_choice(adj: DataFrame, group: str, choice: str, weight: str, draw: DataFrame,
                    draw_key: list[str], u: str = "_u") -> DataFrame:
    """For each draw row (group, u in [0,1)) pick the ``choice`` whose
    cumulative normalised weight interval contains ``u`` (inverse CDF; the
    same distribution as an alias table)."""
    wc = Window.partitionBy(group).orderBy(choice).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tot = Window.partitionBy(group)
    cdf = adj.select(group, choice, (F.sum(weight).over(wc) / F.sum(weight).over(tot)).alias("_hi"),
                     ((F.sum(weight).over(wc) - F.col(weight)) / F.sum(weight).over(tot)).alias("_lo"))
    c = cdf.withColumnRenamed(group, "_g")
    j = draw.join(c, (draw[group] == c["_g"]) & (draw[u] >= c["_lo"]) & (draw[u] < c["_hi"]))
    return j.select(*draw_key, group, choice)
