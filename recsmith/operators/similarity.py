"""Item-to-item CF and recall.

Exactness: the reference truncates to 4 decimals after every addition;
with non-negative terms that equals summing each term truncated, so each
term is carried as BIGINT ticks ``floor(x*1e4)`` and summed — order
independent, no float drift, identical in any engine.

Scale:
* a user's rows meet in cells: rows are moved to their user once and every
  pair is made there; users longer than ``block`` rows are split into blocks
  with one cell for each two blocks, so a hot user's n^2 pairs are spread over
  (n/block)^2 / 2 cells of at most 4 block^2 pairs each;
* where few item pairs take many occurrences (``COMBINE``), and where there are
  few of them (``TASK_PAIRS``), the aggregation is a plain ``groupBy(item, relate)`` with partial (map-side) sums; elsewhere
  (``cell_sums``) cells are packed and an occurrence's partners are moved as one row, to its item's task, where pairs,
  sums and top-k are made, in rounds of items of ``ROUND_PAIRS`` occurrences (``ROUND_MET`` times the rows, if that
  is more: the number of rounds does not grow with the table) whose shuffle files go
  with the round, so that the disk grows with the baskets and the result, not
  with the pairs; an item of more than ``ITEM_PAIRS`` spans several tasks;
* per-pair vector similarities are computed from the item vectors
  attached to each row of a cell;
* top-k cuts (T1/T2/hot fill) are row_number windows Spark turns into
  WindowGroupLimit, so only k rows per group survive the sort.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from recsmith.functions.columns import (
    HOUR_SECONDS, MISSING_AFFINITY, TICKS_PER_UNIT, activity_damp, dot_unrolled, hash32, loc_decay, ndcg_gain,
    order_penalty, popularity_damp, time_decay, trunc4, trunc_ticks)
from recsmith.operators import cell_sums
from recsmith.operators.encode import attach_scalars, bounded_broadcast
from recsmith.operators.logs import item_stats, rank_in_group, upper_median
from recsmith.operators.sequence import hot_of, positions
from recsmith.session import as_table, cut_lineage, shuffle_partitions

# Vector slices standing in for the three embedding models
# (node2vec, deepwalk, text) and the default cut sizes.
NODE_SLICE = (0, 21)
DEEP_SLICE = (21, 42)
TEXT_SLICE = (42, 64)
_SLICES = {"node": NODE_SLICE, "deep": DEEP_SLICE, "txt": TEXT_SLICE}
RELATE_ITEM_NUM = 100
ITEM_NUM = 200
HOT_K = 50
BLOCK = 4096
#: Rows of a block of R1, whose cells hold vectors.
CELL = 512
#: Occurrences of ordered pairs in one round, in one task, and of one item in
#: one task.
ROUND_PAIRS = 128_000_000
TASK_PAIRS = 1_000_000
ITEM_PAIRS = 1_000_000
#: Occurrences in one round for each row, where that is more.
ROUND_MET = 3
#: Rows of one task that packs cells.
TASK_ROWS = 250_000
#: Occurrences for each possible item pair and task from which they are summed
#: up before they move.
COMBINE = 16
#: Largest table of related items (rows) that is broadcast.
MOST_RELATED = 200_000

_T = float(TICKS_PER_UNIT)


def _blocked_sides(seq: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Replicate each row over the partner blocks of its user; users with
    at most ``block`` rows keep a single (0, 0) key."""
    nb = (F.floor((F.col("n") - 1) / F.lit(block)) + 1).cast("int")
    own = F.floor(F.col("loc") / F.lit(block)).cast("int")
    left = seq.withColumn("_ba", own).withColumn("_bb", F.explode(F.sequence(F.lit(0), nb - 1)))
    right = seq.withColumn("_bb", own).withColumn("_ba", F.explode(F.sequence(F.lit(0), nb - 1)))
    return left, right


def user_item_pairs(log: DataFrame, user: str = "user_id", item: str = "item_id",
                    block: int = BLOCK) -> DataFrame:
    """Distinct unordered item pairs (a < b) clicked by a common user, with
    the same (user, block, block) blocking as J3 so a hot user's pairs are
    spread over many tasks; duplicates collapse map-side in ``distinct``."""
    items = log.select(user, item).distinct()
    seq = positions(items, user, [item], loc="loc", size="n", known=hot_of(log))
    left, right = _blocked_sides(seq, block)
    a = left.select(F.col(user).alias("_u"), F.col(item).alias("item"), "_ba", "_bb")
    b = right.select(F.col(user).alias("_u"), F.col(item).alias("relate_item"), "_ba", "_bb")
    return (a.join(b, ["_u", "_ba", "_bb"]).where(F.col("item") < F.col("relate_item"))
            .select("item", "relate_item").distinct())


def _sides(train: DataFrame, user: str, item: str) -> DataFrame:
    """Rows with their place in the user's time-ordered sequence and its length."""
    return positions(train.select(user, item, "time", "time_us"), user, ["time_us", item], loc="loc", size="n",
                     known=hot_of(train))


def _met(seq: DataFrame, stats: DataFrame, vectors: DataFrame | None, block: int, user: str, item: str) -> DataFrame:
    """The rows of each cell (user, _x, _y), with all that a pair takes from
    them: blocks _x <= _y of a user; ``_x = _y = 0`` up to ``block`` rows.
    ``stats`` has clicks and users of each item; its ``parts`` go along."""
    # per-row factors of the pair formula, computed once per row instead of
    # once per pair (same operations, same doubles)
    seq = (seq.where(F.col(user).isNotNull()).join(stats, item)
           .withColumn("damp", activity_damp("users", "n"))
           .withColumn("lnlen", F.log(F.lit(1.0) + F.col("n"))))
    if vectors is not None:
        # per row (not per pair): the norm of each slice, so a pair only
        # needs three short dot products
        v = vectors.select(F.col("item_id").alias(item), "vec",
                           *[F.sqrt(dot_unrolled("vec", "vec", lo, hi)).alias(f"norm_{name}")
                             for name, (lo, hi) in _SLICES.items()])
        seq = seq.join(v, item, "left")
    nb = (F.floor((F.col("n") - 1) / F.lit(block)) + 1).cast("int")
    own = F.floor(F.col("loc") / F.lit(block)).cast("int")
    met = seq.drop("time_us").withColumn("own", own).withColumn("_o", F.explode(F.sequence(F.lit(0), nb - 1)))
    return met.select(*[c for c in met.columns if c != "_o"], F.least("own", "_o").alias("_x"), F.greatest("own", "_o").alias("_y"))


def _cells(met: DataFrame, user: str) -> DataFrame:
    """(user, _x, _y, rows)."""
    row = F.struct(*[c for c in met.columns if c not in (user, "_x", "_y")]).alias("_row")
    return (met.select(user, "_x", "_y", row)
            .repartition(user, "_x", "_y").groupBy(user, "_x", "_y").agg(F.collect_list("_row").alias("rows")))


def _cell_pairs(cells: DataFrame, user: str, item: str) -> DataFrame:
    """Every ordered pair of rows ``a``, ``b`` of a cell with different items."""
    a = cells.select(user, "_x", "_y", "rows", F.explode("rows").alias("a"))
    # two blocks meet in one cell, a block meets itself in its own
    return (a.select(user, "_x", "_y", "a", F.explode("rows").alias("b"))
            .where((F.col(f"a.{item}") != F.col(f"b.{item}"))
                   & ((F.col("_x") == F.col("_y")) | (F.col("a.own") != F.col("b.own")))))


def _described(pairs: DataFrame, with_vectors: bool, user: str, item: str) -> DataFrame:
    """The per-occurrence terms of R1 of pairs of rows ``a`` and ``b``."""
    dt = trunc4(F.abs(F.col("a.time") - F.col("b.time")) / F.lit(float(HOUR_SECONDS)))
    dloc = F.abs(F.col("b.loc") - F.col("a.loc"))
    if with_vectors:
        sims = []
        for name, (lo, hi) in _SLICES.items():
            cos = dot_unrolled("a.vec", "b.vec", lo, hi) / (F.col(f"a.norm_{name}") * F.col(f"b.norm_{name}"))
            t = trunc4(F.lit(0.5) * cos + F.lit(0.5))
            sims.append(F.coalesce(t, F.lit(MISSING_AFFINITY)).alias(name))
    else:
        sims = [F.lit(MISSING_AFFINITY).alias(c) for c in ("node", "deep", "txt")]
    return pairs.select(
        user, F.col(f"a.{item}").alias("item"), F.col(f"b.{item}").alias("relate_item"),
        F.col("a.loc").alias("loc1"), F.col("b.loc").alias("loc2"), dloc.alias("dloc"), dt.alias("dt"),
        F.col("a.users").alias("users_i"), F.col("a.n").alias("n"), F.col("a.clicks").alias("ci"),
        F.col("b.clicks").alias("cj"), F.col("a.damp").alias("damp"), F.col("a.lnlen").alias("lnlen"), *sims)


def cooccurrence_pairs(train: DataFrame, vectors: DataFrame | None = None, block: int = BLOCK,
                       user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Every ordered pair (i at loc1, j at loc2, i != j) of one user's
    time-ordered sequence, with the per-occurrence terms of R1."""
    stats = item_stats(train, item, user, "time").select(item, "users", "clicks")
    cells = _cells(_met(_sides(train, user, item), stats, vectors, block, user, item), user)
    return _described(_cell_pairs(cells, user, item), vectors is not None, user, item)


def _terms(pairs: DataFrame) -> DataFrame:
    """What one occurrence adds to the 9 slots of its pair."""
    ld, td = loc_decay(F.col("dloc") - 1), time_decay(F.col("dt"))
    sim = (F.col("node") * F.col("node") * F.col("deep") * F.col("txt") * ld * td
           / F.col("damp") * order_penalty("loc1", "loc2"))
    weighted = ld * td / F.col("lnlen")
    return pairs.select("item", "relate_item", trunc_ticks(sim).alias("sim_ticks"),
                        trunc_ticks(weighted).alias("weighted_ticks"), "dt", "dloc", "node", "deep", "ci", "cj")


def pair_accumulate(pairs: DataFrame) -> DataFrame:
    """The 9 slots per ordered pair (slot 0 still undamped)."""
    return _terms(pairs).groupBy("item", "relate_item").agg(
        F.sum("sim_ticks").alias("sim_ticks"),
        F.count(F.lit(1)).alias("cnt"),
        F.sum("weighted_ticks").alias("weighted_ticks"),
        F.min("dt").alias("min_dt"),
        F.min("dloc").cast("bigint").alias("min_dloc"),
        F.max("node").alias("node"),
        F.sum(trunc_ticks("node")).alias("node_ticks"),
        F.max("deep").alias("deep"),
        F.sum(trunc_ticks("deep")).alias("deep_ticks"),
        # constant per pair: carried so the damping needs no join afterwards
        F.max("ci").alias("_ci"), F.max("cj").alias("_cj"))


def _top_pairs(met: DataFrame, with_vectors: bool, rows: int, total: int, most: int, wide: bool, decay: list[float], top_k: int,
               round_pairs: int, item_pairs: int) -> DataFrame:
    """The ``top_k`` accumulated pairs of each item, from ``total`` occurrences
    of which one item has ``most`` or less. An occurrence goes to the task of
    (item, _s): _s is 0, or for an item of several ``parts`` its related item's
    part from 1 on, whose own ``top_k`` are ranked once more."""
    spark = met.sparkSession
    ansi = spark.conf.get("spark.sql.ansi.enabled", "true").lower() == "true"
    rounds = max(1, math.ceil(total / round_pairs))
    tasks = max(1, math.ceil(total / rounds / TASK_PAIRS))
    slices = _SLICES if with_vectors else None
    cells = cell_sums.packed_cells(met, slices, max(shuffle_partitions(spark), math.ceil(rows / TASK_ROWS)))
    if rounds > 1:
        cells = as_table(cells, tidy=True)

    def top(r: int, packed: bool) -> DataFrame:
        own = cell_sums.dealt(cells, slices, wide, rounds, r, ansi).repartition(tasks, "item", "_s")
        return cell_sums.top_sums(own, wide, decay, top_k, packed)

    if rounds == 1 and most <= item_pairs:
        return top(0, False)
    found = None
    for r in range(rounds):
        one = as_table(top(r, True), tidy=True)
        found = one if found is None else found.unionByName(one)
    found = cell_sums.unpacked(found)
    if most <= item_pairs:
        return found
    again = rank_in_group(found.where("_s > 0"), "item", "sim_ticks", ["relate_item"], k=top_k, name="_r").drop("_r")
    return found.where("_s = 0").unionByName(again)


def item_similarity(train: DataFrame, vectors: DataFrame | None = None, top_k: int = RELATE_ITEM_NUM,
                    block: int = CELL, round_pairs: int | None = None, item_pairs: int = ITEM_PAIRS) -> DataFrame:
    """R1 (+T1): per item its ``top_k`` related items by undamped slot 0
    (ties by related item id), then slot 0 damped by popularity
    ``trunc4(s / (ci*cj)^0.2)``. ``train`` has user_id, item_id, time, time_us."""
    seq = as_table(_sides(train, "user_id", "item_id"))
    stats = seq.groupBy("item_id").agg(F.countDistinct("user_id").alias("users"), F.count(F.lit(1)).alias("clicks"),
                                       F.sum(F.when(F.col("user_id").isNotNull(), F.col("n") - 1)).alias("_p"))
    stats = as_table(stats.select("item_id", "users", "clicks", F.coalesce("_p", F.lit(0)).alias("_p"),
                                  F.greatest(F.lit(1), F.ceil(F.col("_p") / F.lit(item_pairs))).alias("parts")))
    kind = stats.schema["item_id"].dataType
    numbers = isinstance(kind, IntegralType)
    id_ = F.col("item_id") if numbers else F.lit(0)
    s = stats.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum("_p"), F.lit(0)).alias("total"),
                  F.coalesce(F.max("_p"), F.lit(0)).alias("most"), F.coalesce(F.sum("clicks"), F.lit(0)).alias("rows"),
                  F.max("clicks").alias("clicks"), F.min(id_).alias("low"), F.max(id_).alias("high"),
                  F.array(*[loc_decay(F.lit(k)) for k in range(cell_sums.NEAR)]).alias("decay")).first()
    met = _met(seq, stats.drop("_p"), vectors, block, "user_id", "item_id")
    round_pairs = round_pairs or max(ROUND_PAIRS, ROUND_MET * s.rows)
    few = s.total <= min(TASK_PAIRS, round_pairs) and s.most <= item_pairs  # one task's work
    # only numbers are packed
    if few or not numbers or s.total > COMBINE * s["items"] * s["items"] * shuffle_partitions(train.sparkSession):
        acc = pair_accumulate(_described(_cell_pairs(_cells(met, "user_id"), "user_id", "item_id"), vectors is not None, "user_id", "item_id"))
        top = rank_in_group(acc, "item", "sim_ticks", ["relate_item"], k=top_k, name="_r").drop("_r")
    else:
        wide = s.low is not None and (s.low < -(1 << 31) or max(s.high, s.clicks) >= 1 << 31)
        top = _top_pairs(met, vectors is not None, s.rows, s.total, s.most, wide, s.decay, top_k, round_pairs, item_pairs)
        top = top.withColumns({c: F.col(c).cast(kind) for c in ("item", "relate_item")})
    damped = trunc4((F.col("sim_ticks") / F.lit(_T)) / F.pow(F.col("_ci") * F.col("_cj"), F.lit(0.2)))
    return top.select(
        "item", "relate_item", damped.alias("sim"), "cnt",
        (F.col("weighted_ticks") / F.lit(_T)).alias("weighted"), "min_dt", "min_dloc",
        "node", (F.col("node_ticks") / F.lit(_T)).alias("node_sum"),
        "deep", (F.col("deep_ticks") / F.lit(_T)).alias("deep_sum"))


def recommend(train: DataFrame, sim: DataFrame, users: DataFrame | None = None,
              top_k: int = RELATE_ITEM_NUM, item_num: int = ITEM_NUM) -> DataFrame:
    """R2 (J5, J6, A8, T2): candidates from each history item's ``top_k``
    related items, minus the user's history, scored and cut to
    ``item_num`` per user. History is newest first (loc 0 = newest). The
    candidates of a history row are summed up where the row is; what is moved
    is at most one row for each user and related item, without those related
    to several history items more than once a task."""
    hist = train.select("user_id", "item_id", "time", "time_us")
    if users is not None:
        hist = hist.join(users.select("user_id").distinct(), "user_id", "left_semi")
    newest = hist.groupBy("user_id").agg(F.max("time").alias("t0"))
    hist = positions(hist, "user_id", ["time_us", "item_id"], desc=True, loc="loc", size=None,
                     known=hot_of(train)).join(newest, "user_id")
    st = item_stats(train).select(F.col("item_id").alias("relate_item"), "clicks", "first_seen")
    s = rank_in_group(sim, "item", "sim", ["relate_item"], k=top_k, name="_r").drop("_r").join(st, "relate_item")
    # an item is its own row with `_seen`: a user's history marks its items in
    # the sums below (J6), and no candidate is moved before it is summed up
    own = st.select(F.col("relate_item").alias("item"), "relate_item").where(F.col("item").isNotNull())
    s = s.withColumn("_seen", F.lit(0)).unionByName(own.withColumn("_seen", F.lit(1)), allowMissingColumns=True)
    s = cut_lineage(s.withColumnRenamed("item", "item_id"))
    hist = hist.select("user_id", "item_id", "time", "t0", "loc")
    cand = hist.join(bounded_broadcast(s, s.count(), MOST_RELATED), "item_id")                 # J5
    dt1 = F.abs(F.col("t0") - F.col("time")) / F.lit(float(HOUR_SECONDS))
    dt2 = F.abs(F.col("t0") - F.col("first_seen")) / F.lit(float(HOUR_SECONDS))
    alpha, beta = popularity_damp("clicks"), loc_decay("loc")
    theta, gamma = time_decay(dt1), time_decay(dt2)
    term = F.col("sim") * (alpha * alpha) * beta * (theta * theta) * gamma
    agg = cand.groupBy("user_id", F.col("relate_item").alias("item_id")).agg(                  # A8
        F.max("_seen").alias("_seen"),
        F.sum(trunc_ticks(term)).alias("_score_ticks"),
        F.sum("cnt").alias("f_cnt"),
        F.sum(F.round(F.col("weighted") * F.lit(_T)).cast("bigint")).alias("_w_ticks"),
        F.min("min_dt").alias("f_min_dt"),
        F.min("min_dloc").alias("f_min_dloc"),
        F.min(dt1).alias("_dt1"),
        F.min(dt2).alias("_dt2"),
        F.min("loc").alias("f_min_loc"),
        F.max("node").alias("f_node_max"),
        F.sum(F.col("node_sum") / F.col("cnt")).alias("f_node_avg_sum"),
        F.max("deep").alias("f_deep_max"),
        F.sum(F.col("deep_sum") / F.col("cnt")).alias("f_deep_avg_sum")).where(F.col("_seen") == 0)
    out = agg.select(
        "user_id", "item_id", (F.col("_score_ticks") / F.lit(_T)).alias("score"), "f_cnt",
        (F.col("_w_ticks") / F.lit(_T)).alias("f_weighted"), "f_min_dt", "f_min_dloc",
        trunc4("_dt1").alias("f_recall_dt"), trunc4("_dt2").alias("f_age"), "f_min_loc", "f_node_max",
        F.round("f_node_avg_sum", 6).alias("f_node_avg_sum"), "f_deep_max",
        F.round("f_deep_avg_sum", 6).alias("f_deep_avg_sum"))
    ranked = rank_in_group(out, "user_id", "score", ["item_id"], k=item_num)              # T2
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def hot_items(train: DataFrame, k: int = HOT_K) -> DataFrame:
    """The ``k`` most clicked items (ties by item id) with rank 1..k."""
    pop = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("clicks"))
    # global top-k (TakeOrderedAndProject: per-partition top-k, then k rows);
    # the numbering window then sees only those k rows
    w = Window.orderBy(F.col("clicks").desc(), F.col("item_id").asc())
    return pop.orderBy(F.col("clicks").desc(), F.col("item_id").asc()).limit(k).withColumn(
        "hot_rank", F.row_number().over(w))


def hot_fill(recs: DataFrame, hot: DataFrame, k: int = HOT_K, keep: str = "highest") -> DataFrame:
    """Append the hot items with scores -1..-k to every user that has at
    least one candidate, de-duplicate (user, item), re-rank, keep ``k``.

    ``keep='highest'`` keeps the recalled score when an item is both
    recalled and hot; ``'lowest'`` reproduces the reference code (Q2).
    The hot list (k rows) is folded into one array row and attached to the
    users with a bounded broadcast, then exploded — no cross join."""
    hot_arr = hot.agg(F.collect_list(F.struct(F.col("hot_rank"), F.col("item_id"))).alias("_hot"))
    users = recs.select("user_id").distinct()
    filled = (attach_scalars(users, hot_arr)
              .select("user_id", F.explode("_hot").alias("_h"))
              .select("user_id", F.col("_h.item_id").alias("item_id"),
                      (-F.col("_h.hot_rank")).cast("double").alias("score")))
    both = recs.select("user_id", "item_id", "score").unionByName(filled)
    pick = F.max("score") if keep == "highest" else F.min("score")
    dedup = both.groupBy("user_id", "item_id").agg(pick.alias("score"))
    ranked = rank_in_group(dedup, "user_id", "score", ["item_id"], k=k)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def ranking_metrics(preds: DataFrame, answers: DataFrame, train: DataFrame, k: int = HOT_K) -> DataFrame:
    """X2 (J7, A13, F14): mean NDCG@k and hit rate@k over answered users
    that have predictions, and over the "half" whose held-out item
    popularity is <= the upper median of all answers (Q8: short list =
    miss, unseen popularity = 0)."""
    pop = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("deg"))
    ans = (answers.select("user_id", "item_id").join(pop, "item_id", "left")
           .withColumn("deg", F.coalesce(F.col("deg"), F.lit(0))))
    med = upper_median(ans, "deg").withColumnRenamed("median", "_median")  # A13
    served = preds.select("user_id").distinct()
    hits = preds.where(F.col("rank") <= k).select("user_id", "item_id", (F.col("rank") - 1).alias("_r0"))
    cases = (ans.join(served, "user_id", "left_semi")
             .join(hits, ["user_id", "item_id"], "left"))
    cases = attach_scalars(cases, med).withColumn("_half", F.col("deg") <= F.col("_median"))
    gain = F.when(F.col("_r0").isNotNull(), ndcg_gain("_r0")).otherwise(F.lit(0.0))
    hit = F.when(F.col("_r0").isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0))
    return cases.agg(
        F.round(F.avg(gain), 6).alias("ndcg_full"),
        F.round(F.sum(F.when(F.col("_half"), gain)) / F.sum(F.when(F.col("_half"), F.lit(1.0))), 6).alias("ndcg_half"),
        F.round(F.avg(hit), 6).alias("hr_full"),
        F.round(F.sum(F.when(F.col("_half"), hit)) / F.sum(F.when(F.col("_half"), F.lit(1.0))), 6).alias("hr_half"))


def recall_labelling(candidates: DataFrame, answers: DataFrame, negatives: int = 5,
                     rounds: int = 6) -> DataFrame:
    """Label a candidate 1 if it is the user's held-out item, and for
    each of ``rounds`` rounds keep ``negatives`` negatives per positive
    (md5 order per round)."""
    lab = (candidates.select("user_id", "item_id")
           .join(answers.select("user_id", F.col("item_id").alias("_ans")), "user_id")
           .withColumn("label", (F.col("item_id") == F.col("_ans")).cast("int")).drop("_ans"))
    pos_users = lab.where(F.col("label") == 1).groupBy("user_id").agg(F.count(F.lit(1)).alias("_p"))
    rounds_df = lab.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    rounds_df = rounds_df.join(pos_users, "user_id")
    w = Window.partitionBy("user_id", "round", "label").orderBy(hash32("user_id", "item_id", "round"), "item_id")
    ranked = rounds_df.withColumn("_k", F.row_number().over(w))
    keep = (F.col("label") == 1) | (F.col("_k") <= F.col("_p") * F.lit(negatives))
    return ranked.where(keep).select("round", "user_id", "item_id", "label")
