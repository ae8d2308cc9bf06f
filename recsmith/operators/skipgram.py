"""Skip-gram with negative sampling over parameter blocks.

Nodes are dealt into blocks by hash. Every node has a centre and a context
vector; both are rows of a table, never a model on the driver. Training pairs
belong to the cell (block of the centre, block of the context). A round takes
one diagonal of the cells: every centre block meets one context block, no two
tasks share a block, and after as many rounds as there are blocks all pairs
have been seen once. A task holds two blocks and the pairs of one cell (a cell of
many pairs is taken in slices, a round for each), so its memory is bounded
whatever the number of nodes.

Negatives come from the context block at hand, by frequency to the power 0.75;
the rounds take every block. Steps are row-wise AdaGrad on mini-batches; a pair
that the walks hold n times counts n times. All draws are seeded by epoch,
round and block, and rows are sorted first, so a retried task gives the same
vectors.

Defined results: every node of the walks has a vector, a walk of one node has
no pairs; null nodes are left out; no walks give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.functions.columns import hash32
from recsmith.session import cut_lineage, scratch_folder, shuffle_partitions

#: Nodes of a block and pairs of a cell that a task holds, at most.
BLOCK_NODES, CELL_PAIRS = 50_000, 2_000_000
#: Negatives of a pair and the exponent of their frequency, as is usual for skip-gram.
NEGATIVES, POWER = 5, 0.75
BATCH, RATE = 1024, 0.1

_STATE = "kind int, block int, node long, freq double, vec array<float>, acc float"
_NAMES = ["kind", "block", "node", "freq", "vec", "acc"]


def walk_pairs(walks: DataFrame, window: int) -> DataFrame:
    """(centre, context, n): how often the walks hold two nodes at most
    1..window steps apart; the reach of each place is drawn from its hash, so
    that near nodes count more. A walk's steps meet in one join on the walk."""
    w = walks.where(F.col("node").isNotNull())
    left = w.select("start", "walk", F.col("step").alias("_s"), F.col("node").alias("centre"),
                    (F.pmod(hash32("start", "walk", "step", F.lit("reach")), F.lit(window)) + 1).alias("_reach"))
    right = w.select("start", "walk", F.col("step").alias("_t"), F.col("node").alias("context"))
    apart = F.abs(F.col("_s") - F.col("_t"))
    return (left.join(right, ["start", "walk"]).where((apart > 0) & (apart <= F.col("_reach")))
            .groupBy("centre", "context").agg(F.count(F.lit(1)).alias("n")))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train_cell(centre: np.ndarray, context: np.ndarray, acc: tuple[np.ndarray, np.ndarray], pairs: tuple[np.ndarray, np.ndarray, np.ndarray],
               freq: np.ndarray, rng: np.random.Generator, negatives: int = NEGATIVES, rate: float = RATE, batch: int = BATCH) -> float:
    """Trains both blocks in place on (centre row, context row, times) and
    gives the loss before each step, added up over the pairs."""
    heap = np.cumsum(np.maximum(freq, 0) ** POWER)
    loss = 0.0
    order = rng.permutation(len(pairs[0]))
    for lo in range(0, len(order), batch):
        take = order[lo:lo + batch]
        c, x, times = pairs[0][take], pairs[1][take], pairs[2][take].astype(np.float64)
        drawn = np.minimum(np.searchsorted(heap, rng.random((len(take), negatives)) * heap[-1], side="right"), len(heap) - 1)
        targets = np.concatenate([x[:, None], drawn], axis=1)
        wanted = np.zeros(targets.shape)
        wanted[:, 0] = 1
        # a draw that is the pair's own context says nothing
        counts = np.where((targets == x[:, None]) & (wanted == 0), 0.0, times[:, None])
        v, w = centre[c], context[targets]
        p = _sigmoid(np.einsum("bd,bkd->bk", v, w))
        loss -= float((counts * np.log(np.where(wanted > 0, p, 1 - p) + 1e-12)).sum())
        error = (p - wanted) * counts
        steps = ((centre, acc[0], c, np.einsum("bk,bkd->bd", error, w)),
                 (context, acc[1], targets.ravel(), (error[:, :, None] * v[:, None, :]).reshape(-1, v.shape[1])))
        for table, held, rows, gradient in steps:
            touched, back = np.unique(rows, return_inverse=True)
            total = np.zeros((len(touched), table.shape[1]))
            np.add.at(total, back, gradient)
            held[touched] += (total * total).mean(axis=1)
            table[touched] -= rate * total / np.sqrt(held[touched] + 1e-10)[:, None]
    return loss


def _table(kind: int, block: np.ndarray, node: np.ndarray, freq: np.ndarray, vec: np.ndarray, acc: np.ndarray) -> pa.Table:
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(node) + 1) * vec.shape[1], pa.int32()), pa.array(vec.ravel(), pa.float32()))
    return pa.table([pa.array(np.full(len(node), kind), pa.int32()), pa.array(block, pa.int32()), pa.array(node, pa.int64()),
                     pa.array(freq, pa.float64()), lists, pa.array(acc, pa.float32())], names=_NAMES)


def start_vectors(nodes: DataFrame, dim: int, seed: int) -> DataFrame:
    """Both tables of (block, node, freq): small centre vectors that follow
    from node and seed, context vectors of zeros."""

    def begin(batches):
        for batch in batches:
            block, node, freq = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            first = np.stack([np.random.default_rng([seed, int(n) & (2**63 - 1), int(n < 0)]).random(dim) for n in node.tolist()] or [np.zeros(dim)])[:len(node)]
            for kind, vec in ((0, (first - 0.5) / dim), (1, np.zeros((len(node), dim)))):
                yield from _table(kind, block, node, freq, vec, np.zeros(len(node))).to_batches()

    return nodes.select("block", "node", "freq").mapInArrow(begin, _STATE)


def _train_group(dim: int, negatives: int, rate: float, seed: tuple[int, ...]):
    def run(group: pa.Table) -> pa.Table:
        kind = group.column("kind").to_numpy()
        sides = []
        for k in (0, 1):
            part = group.filter(pa.array(kind == k)).sort_by("node")
            sides.append((part, part.column("node").to_numpy(),
                          part.column("vec").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(part.num_rows, dim),
                          part.column("acc").to_numpy().astype(np.float64)))
        (left, nodes, centre, held), (right, others, context, kept) = sides
        pairs = group.filter(pa.array(kind == 2)).sort_by([("node", "ascending"), ("other", "ascending")])
        loss = weight = 0.0
        if pairs.num_rows:
            times = pairs.column("freq").to_numpy()
            at = (np.searchsorted(nodes, pairs.column("node").to_numpy()), np.searchsorted(others, pairs.column("other").to_numpy()), times)
            rng = np.random.default_rng([*seed, int(group.column("task")[0].as_py())])
            loss = train_cell(centre, context, (held, kept), at, right.column("freq").to_numpy(), rng, negatives, rate)
            weight = float(times.sum())
        out = [_table(k, part.column("block").to_numpy(), ids, part.column("freq").to_numpy(), vec, acc)
               for k, (part, ids, vec, acc) in enumerate(((left, nodes, centre, held), (right, others, context, kept)))]
        out.append(_table(3, np.array([-1]), np.array([0]), np.array([weight]), np.array([[loss]]), np.zeros(1)))
        return pa.concat_tables(out)

    return run


def skipgram_embeddings(walks: DataFrame, dim: int = 128, window: int = 10, epochs: int = 3, seed: int = 39,
                        negatives: int = NEGATIVES, rate: float = RATE, blocks: int | None = None,
                        block_nodes: int = BLOCK_NODES, cell_pairs: int = CELL_PAIRS, losses: list | None = None) -> DataFrame:
    """(node, vec) of every node of the walks. ``blocks`` defaults to what
    ``block_nodes`` asks for, and to one for each shuffle partition at least (so
    that a round has work for every core). The mean loss of a pair in each
    epoch is appended to ``losses``."""
    spark = walks.sparkSession
    pairs = cut_lineage(walk_pairs(walks, window))
    seen = walks.where(F.col("node").isNotNull()).select("node").distinct()
    often = pairs.groupBy(F.col("context").alias("node")).agg(F.sum("n").cast("double").alias("freq"))
    nodes = seen.join(often, "node", "left").fillna(0.0, ["freq"])
    n = nodes.count()
    if n == 0:
        return spark.createDataFrame([], "node long, vec array<float>")
    count = blocks or min(max(math.ceil(n / block_nodes), shuffle_partitions(spark)), n)

    def block(c: str):
        return F.pmod(F.xxhash64(c), F.lit(count)).cast("int")

    state = cut_lineage(start_vectors(nodes.withColumn("block", block("node")), dim, seed))
    dealt = (pairs.withColumn("task", block("centre")).withColumn("round", F.pmod(block("context") - F.col("task"), F.lit(count)).cast("int")))
    fullest = dealt.groupBy("task", "round").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first().n or 0
    slices = max(1, math.ceil(fullest / cell_pairs))
    dealt = dealt.withColumn("slice", F.pmod(F.xxhash64("context", "centre"), F.lit(slices)).cast("int"))
    path = f"{scratch_folder(spark)}/pairs"  # a round reads its own folder only
    dealt.repartition("round", "slice", "task").write.partitionBy("round", "slice").parquet(path)
    stored = spark.read.schema("centre long, context long, n long, task int, round int, slice int").parquet(path)
    null = F.lit(None)
    for epoch in range(epochs):
        total = weight = 0.0
        for turn in range(count * slices):
            k, part = divmod(turn, slices)
            rows = state.where("kind < 2").select(
                F.when(F.col("kind") == 0, F.col("block")).otherwise(F.pmod(F.col("block") - k, F.lit(count))).alias("task"), *_NAMES,
                null.cast("bigint").alias("other"))
            own = stored.where((F.col("round") == k) & (F.col("slice") == part)).select(
                "task", F.lit(2).alias("kind"), null.cast("int").alias("block"), F.col("centre").alias("node"), F.col("n").cast("double").alias("freq"),
                null.cast("array<float>").alias("vec"), null.cast("float").alias("acc"), F.col("context").alias("other"))
            trained = rows.unionByName(own).groupBy("task").applyInArrow(_train_group(dim, negatives, rate, (seed, epoch, k, part)), _STATE)
            state = cut_lineage(trained)
            if losses is not None:
                r = state.where("kind = 3").agg(F.sum(F.col("vec")[0].cast("double")).alias("loss"), F.sum("freq").alias("n")).first()
                total, weight = total + r.loss, weight + r.n
        if losses is not None:
            losses.append(total / max(weight, 1.0))
    return state.where("kind = 0").select("node", "vec")
