"""Item graph and random walks (G1..G6, J9); embeddings of the walks (G7) are in
``operators/skipgram.py``.

Graphs are edge tables ``(src, dst, weight)``; a node's neighbours are
numbered edges (never a per-node array). Walks are iterative equi-joins of
the walker state with those tables, one step per iteration; randomness comes from md5 of
(start, walk, step), so a recomputed task draws the same neighbour. The
state is checkpointed to the reliable checkpoint directory every few
steps to keep lineage short and survive executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.functions.columns import EDGE_TIME_UNIT_SECONDS, edge_weight, hash32, uniform01
from recsmith.operators.alias import alias_table, weight_ticks
from recsmith.operators.sequence import HOT_KEY_ROWS, hot_of, join_per_key, positions, with_next
from recsmith.session import cut_lineage

# Walk and embedding defaults of the reference pipeline.
WALK_LENGTH = 20
NUM_WALKS = 80
RETURN_P = 2.0
INOUT_Q = 0.5
EMBED_SIZE = 128
WINDOW_SIZE = 10
EPOCHS = 3
CHECKPOINT_EVERY = 5
#: Out-edges of a node in one slice.
SLICE_EDGES = 4096


def build_edges(log: DataFrame, direction: bool = True, user: str = "user_id", item: str = "item_id",
                time_col: str = "time") -> DataFrame:
    """G1: consecutive clicks per user -> weighted forward + reverse edges
    (directed) or one unit edge (undirected). The time gap uses the two
    click times (Q3), in 12-hour units."""
    counts = log.groupBy(item).agg(F.count(F.lit(1)).alias("_cnt"))
    seq = with_next(log.select(user, item, time_col), user, [time_col, item], {item: "_nxt", time_col: "_nt"},
                    loc="pos", known=hot_of(log)).where(F.col("_nxt").isNotNull())
    ci = counts.select(F.col(item).alias("_i"), F.col("_cnt").alias("_ai"))
    cj = counts.select(F.col(item).alias("_j"), F.col("_cnt").alias("_aj"))
    seq = seq.join(ci, seq[item] == ci["_i"]).join(cj, seq["_nxt"] == cj["_j"])
    dt = F.abs(F.col("_nt") - F.col(time_col)) / F.lit(float(EDGE_TIME_UNIT_SECONDS))
    if not direction:
        return seq.select(user, "pos", F.lit(0).alias("dir"), F.col(item).alias("src"), F.col("_nxt").alias("dst"),
                          F.lit(1.0).alias("weight"))
    fwd = F.struct(F.lit(0).alias("dir"), F.col(item).alias("src"), F.col("_nxt").alias("dst"),
                   edge_weight("_ai", "_aj", dt).alias("weight"))
    rev = F.struct(F.lit(1).alias("dir"), F.col("_nxt").alias("src"), F.col(item).alias("dst"),
                   edge_weight("_aj", "_ai", dt, reverse=True).alias("weight"))
    return seq.select(user, "pos", F.explode(F.array(fwd, rev)).alias("_e")).select(user, "pos", "_e.*")


def build_graph(edges: DataFrame, direction: bool = True, user: str = "user_id") -> DataFrame:
    """One edge per key; a repeated edge keeps the weight written last
    in (user, position, forward-then-reverse) order. Undirected keys are
    unordered pairs (stored as src <= dst). Self loops are kept."""
    order = F.struct(F.col(user), F.col("pos"), F.col("dir"))
    if direction:
        keyed = edges.select("src", "dst", "weight", order.alias("_o"))
    else:
        keyed = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"),
                             "weight", order.alias("_o"))
    return keyed.groupBy("src", "dst").agg(F.max_by("weight", "_o").alias("weight"))


def adjacency_edges(graph: DataFrame, direction: bool = True) -> DataFrame:
    """Directed view of a graph: undirected edges in both directions (a
    self loop once)."""
    if direction:
        return graph.select("src", "dst", "weight")
    back = graph.where(F.col("src") != F.col("dst")).select(F.col("dst").alias("src"), F.col("src").alias("dst"),
                                                            "weight")
    return graph.select("src", "dst", "weight").unionByName(back)


def degrees(graph: DataFrame, direction: bool = True) -> DataFrame:
    """Node degree: in + out for directed graphs; for undirected graphs
    the number of incident edge ends (a self loop counts twice)."""
    ends = graph.select(F.col("src").alias("node")).unionAll(graph.select(F.col("dst").alias("node")))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def degree_reweight(graph: DataFrame, direction: bool = True) -> DataFrame:
    """Weight x clamp(deg(u)/deg(v)): ratio < 1 -> max(0.1, r), else min(3, r)."""
    d = degrees(graph, direction)
    du = d.select(F.col("node").alias("src"), F.col("degree").alias("_du"))
    dv = d.select(F.col("node").alias("dst"), F.col("degree").alias("_dv"))
    j = graph.join(du, "src").join(dv, "dst")
    r = F.col("_du").cast("double") / F.col("_dv").cast("double")
    clamp = F.when(r < 1, F.greatest(F.lit(0.1), r)).otherwise(F.least(F.lit(3.0), r))
    return j.select("src", "dst", (F.col("weight") * clamp).alias("weight"))


def transition_probs(graph: DataFrame, p: float = RETURN_P, q: float = INOUT_Q, direction: bool = True,
                     slice_edges: int = SLICE_EDGES, threshold: int = HOT_KEY_ROWS) -> tuple[DataFrame, DataFrame]:
    """First-order ``w / sum(w)`` per source, and second-order
    probabilities for every (t -> v -> x): ``w/p`` if x = t, ``w`` if the
    edge x -> t exists, else ``w/q``, normalised per (t, v).

    The out-edges of a hub are cut into slices of at most ``slice_edges``; an
    edge into the hub meets each slice in a join of its own, (v, slice), and the
    sums per (t, v) come back the same way, so no task holds a whole hub."""
    e = cut_lineage(numbered_edges(graph, direction, threshold))
    total = e.groupBy("src").agg(F.sum("weight").alias("_total"))
    first = join_per_key(e, total, "src", "inner", threshold).withColumn("prob", F.col("weight") / F.col("_total"))
    outs = e.groupBy("src").agg(F.max("deg").alias("_vdeg")).withColumnRenamed("src", "v")
    last = F.floor((F.col("_vdeg") - 1) / slice_edges)
    tv = (join_per_key(e.select(F.col("src").alias("t"), F.col("dst").alias("v")), outs, "v", "inner", threshold)
          .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), last))))
    vx = e.select(F.col("src").alias("v"), F.floor(F.col("_k") / slice_edges).alias("slice"), F.col("dst").alias("x"), F.col("weight").alias("w"))
    back = e.select(F.col("src").alias("x"), F.col("dst").alias("t"), F.lit(True).alias("_xt"))
    j = tv.join(vx, ["v", "slice"]).join(back, ["x", "t"], "left")
    alpha = (F.when(F.col("x") == F.col("t"), F.lit(1.0 / p))
             .when(F.col("_xt"), F.lit(1.0)).otherwise(F.lit(1.0 / q)))
    un = j.select("t", "v", "slice", "_vdeg", "x", (F.col("w") * alpha).alias("_u"))
    sums = (un.groupBy("t", "v").agg(F.sum("_u").alias("_su"), F.max("_vdeg").alias("_vdeg"))
            .select("t", "v", "_su", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("slice")))
    second = un.drop("_vdeg").join(sums, ["t", "v", "slice"]).select("t", "v", "x", (F.col("_u") / F.col("_su")).alias("prob"))
    return first.select("src", "dst", "prob"), second


def _nodes(graph: DataFrame) -> DataFrame:
    return graph.select(F.col("src").alias("node")).union(graph.select(F.col("dst").alias("node"))).distinct()


def numbered_edges(graph: DataFrame, direction: bool = True, threshold: int = HOT_KEY_ROWS) -> DataFrame:
    """Out-edges numbered 0..deg-1 per source in neighbour order, with the
    degree on every row: a neighbour is then found by an equi-join on
    (node, index) — no per-node neighbour array is ever built. A hub's edges
    are numbered over many tasks."""
    e = adjacency_edges(graph, direction).select("src", "dst", "weight")
    out = positions(e, "src", ["dst"], loc="_k", size="deg", threshold=threshold)
    return out.withColumn("_k", F.col("_k").cast("bigint"))


def uniform_walks(graph: DataFrame, walk_length: int = WALK_LENGTH, num_walks: int = NUM_WALKS,
                  direction: bool = False, checkpoint_every: int = CHECKPOINT_EVERY,
                  threshold: int = HOT_KEY_ROWS) -> DataFrame:
    """G5 (J9): ``num_walks`` walks from every node; each step picks a
    neighbour uniformly (index = md5(start, walk, step) mod degree, in
    ascending neighbour order); a walk stops at a dead end.
    Returns (start, walk, step, node).

    An edge row also knows the degree of the node it leads to, so a walker
    carries the degree of where it stands and a step is one join on (node,
    index): walkers that meet at a hub spread over its edges."""
    # the adjacency is read by every step: materialise it once
    num = cut_lineage(numbered_edges(graph, direction, threshold))
    deg = num.groupBy("src").agg(F.max("deg").alias("_nd"))
    hop = cut_lineage(join_per_key(num.select(F.col("src").alias("_hs"), F.col("_k").alias("_hk"), F.col("dst").alias("_nx")),
                                   deg.withColumnRenamed("src", "_nx"), "_nx", "left", threshold))
    state = (_nodes(num).join(deg.withColumnRenamed("src", "node"), "node", "left")
             .withColumn("walk", F.explode(F.sequence(F.lit(0), F.lit(num_walks - 1))))
             .select(F.col("node").alias("start"), "walk", F.col("node").alias("cur"), F.col("_nd").alias("deg"),
                     F.array(F.col("node")).alias("path")))
    for step in range(1, walk_length):
        # no index without a degree: the walk stops, and stays stopped
        j = state.withColumn("_k", F.pmod(hash32("start", "walk", F.lit(step)), F.col("deg")))
        j = j.join(hop, (j["cur"] == hop["_hs"]) & (j["_k"] == hop["_hk"]), "left")
        nxt = F.col("_nx")
        state = j.select("start", "walk", F.coalesce(nxt, F.col("cur")).alias("cur"), F.when(nxt.isNotNull(), F.col("_nd")).alias("deg"),
                         F.when(nxt.isNotNull(), F.concat("path", F.array(nxt))).otherwise(F.col("path")).alias("path"))
        if step % checkpoint_every == 0:
            state = cut_lineage(state)
    return state.select("start", "walk", F.posexplode("path").alias("step", "node"))


def walk_table(graph: DataFrame, direction: bool = True, threshold: int = HOT_KEY_ROWS) -> tuple[DataFrame, DataFrame]:
    """Alias table of every node's out-edges by weight, each row with the slots
    and the size of a slot of the nodes it leads to, and (node, n, size)."""
    ticks = weight_ticks(adjacency_edges(graph, direction), "src", "weight", threshold=threshold)
    table = cut_lineage(alias_table(ticks, "src", "dst", "ticks", threshold))
    nodes = cut_lineage(table.groupBy("src").agg(F.max("n").alias("n"), F.max("size").alias("size")).withColumnRenamed("src", "node"))
    out = table.select(F.col("src").alias("_ts"), F.col("slot").alias("_tk"), "dst", "cut", "alias")
    for end, pre in (("dst", "_d"), ("alias", "_a")):
        side = nodes.select(F.col("node").alias(end), F.col("n").alias(f"{pre}n"), F.col("size").alias(f"{pre}size"))
        out = join_per_key(out, side, end, "left", threshold)
    return cut_lineage(out), nodes


def biased_walks(graph: DataFrame, walk_length: int = WALK_LENGTH, num_walks: int = NUM_WALKS,
                 p: float = RETURN_P, q: float = INOUT_Q, direction: bool = True,
                 checkpoint_every: int = 1, attempts: int = 12, threshold: int = HOT_KEY_ROWS) -> DataFrame:
    """node2vec walks. The first step draws a neighbour by edge weight;
    later steps weight neighbour x of the current node by ``1/p`` (x is the
    previous node), ``1`` (x links back to it) or ``1/q``.

    Each step is exact rejection sampling: proposals come from the alias table
    of the first-order weights (an equi-join on (node, slot), with the walker's
    own slot count, so walkers at a hub spread over its edges) and are accepted
    with probability alpha / max(alpha); the first accepted one wins. Walkers
    try ``attempts`` proposals; those without an accepted one go on with twice
    as many, until none is left. The proposals of a walker are numbered on, so
    the result does not depend on ``attempts``. Expected work per step is
    walkers x max(alpha) / min(alpha), whatever the degrees. The walker state
    feeds several branches of a step, so it is checkpointed after every step.
    With p = q = 1 the reference falls back to unweighted walks, and so does this."""
    if p == 1 and q == 1:
        return uniform_walks(graph, walk_length, num_walks, direction, checkpoint_every, threshold)
    e = cut_lineage(adjacency_edges(graph, direction))
    table, nodes = walk_table(e, True, threshold)
    back = e.select(F.col("src").alias("_kx"), F.col("dst").alias("_kp"), F.lit(True).alias("_xt")).distinct()
    amax = max(1.0 / p, 1.0, 1.0 / q)
    key = ["start", "walk"]
    state = (_nodes(e).join(nodes, "node", "left").withColumn("walk", F.explode(F.sequence(F.lit(0), F.lit(num_walks - 1))))
             .select(F.col("node").alias("start"), "walk", F.col("node").alias("cur"),
                     F.lit(None).cast(e.schema["src"].dataType).alias("prev"), "n", "size",
                     F.array(F.col("node")).alias("path")))
    state = cut_lineage(state)

    def proposals(walkers: DataFrame, step: int, lo: int, hi: int) -> DataFrame:
        """The first accepted one of proposals [lo, hi) of each walker."""
        def u(what: str) -> Column:
            return uniform01("start", "walk", F.lit(step), "_a", F.lit(what))

        tried = (walkers.select(*key, "cur", "prev", "n", "size", F.explode(F.sequence(F.lit(lo), F.lit(hi - 1))).alias("_a"))
                 .withColumn("_slot", F.least(F.floor(u("s") * F.col("n")), F.col("n") - 1).cast("bigint")))
        tried = tried.join(table, (tried["cur"] == table["_ts"]) & (tried["_slot"] == table["_tk"]))
        own = u("c") * F.col("size") < F.col("cut")
        tried = tried.select(*key, "prev", "_a", *[F.when(own, F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in (
            ("dst", "alias", "x"), ("_dn", "_an", "xn"), ("_dsize", "_asize", "xsize"))])
        tried = tried.join(back, (tried["x"] == back["_kx"]) & (tried["prev"] == back["_kp"]), "left")
        alpha = (F.when(F.col("prev").isNull(), F.lit(1.0 * amax))
                 .when(F.col("x") == F.col("prev"), F.lit(1.0 / p))
                 .when(F.col("_xt"), F.lit(1.0)).otherwise(F.lit(1.0 / q)))
        return tried.where(u("a") < alpha / F.lit(amax)).groupBy(*key).agg(F.min_by(F.struct("x", "xn", "xsize"), "_a").alias("_to"))

    for step in range(1, walk_length):
        chosen, lo, hi = None, 0, attempts
        pending = state.where(F.col("n").isNotNull())
        while True:
            found = cut_lineage(proposals(pending, step, lo, hi))
            chosen = found if chosen is None else chosen.unionByName(found)
            pending = cut_lineage(pending.join(found.select(*key), key, "left_anti"))
            if pending.isEmpty():
                break
            lo, hi = hi, hi + 2 * (hi - lo)
        went = F.col("_to").isNotNull()
        state = cut_lineage(state.join(chosen, key, "left").select(
            *key, F.coalesce("_to.x", "cur").alias("cur"), F.when(went, F.col("cur")).otherwise(F.col("prev")).alias("prev"),
            F.when(went, F.col("_to.xn")).alias("n"), F.when(went, F.col("_to.xsize")).alias("size"),
            F.when(went, F.concat("path", F.array("_to.x"))).otherwise(F.col("path")).alias("path")))
    return state.select("start", "walk", F.posexplode("path").alias("step", "node"))
