"""Vector scoring and pooling (V1..V3, H3, M6, M8); retrieval (V4, V5, G8) is in
``operators/retrieval.py`` and offered here under its old name.

Dot products are accumulated dimension by dimension (left to right), the
same order as the SQL twin, so scores agree to the last bit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.functions.columns import affinity, uniform01
from recsmith.operators.encode import bounded_broadcast
from recsmith.operators.retrieval import topk_similar  # noqa: F401

#: Largest table of vectors (rows) that is broadcast.
MOST_VECTORS = 50_000


def history_mean_pool(log: DataFrame, vecs: DataFrame, user: str = "user_id", item: str = "item_id",
                      dim: int | None = None) -> DataFrame:
    """H3: per user the mean of the vectors of the items in the history;
    users none of whose items has a vector get the vector of id 0 (what a
    fully padded history pools to). One grouped aggregate with an average for
    each of the ``dim`` places (read off the first vector if not given):
    map-side combined, no row per place and no array per user. The vectors of
    the items in the log are broadcast if they are few, so that the log keeps
    its order by user: dealt by item, each task would hold sums of all users."""
    if dim is None:
        first = vecs.select(F.size("vec").alias("n")).first()
        dim = first.n if first else 0
    v = vecs.select(F.col("item_id").alias(item), "vec").join(log.select(item).distinct(), item, "left_semi")
    v = bounded_broadcast(v, v.count(), MOST_VECTORS)
    means = [F.avg(F.col("vec")[k].cast("double")).alias(f"_m{k}") for k in range(dim)]
    pooled = (log.select(user, item).join(v, item).groupBy(user).agg(F.count(F.lit(1)).alias("_n"), *means)
              .select(user, F.array(*[F.col(f"_m{k}") for k in range(dim)]).alias("vec")))
    users = log.select(user).distinct()
    zero = vecs.where(F.col("item_id") == 0).select(F.transform("vec", lambda x: x.cast("double")).alias("_z")).limit(1)
    out = users.join(pooled, user, "left")
    out = (out.withColumn("_one", F.lit(1))
           .join(F.broadcast(zero.withColumn("_one", F.lit(1))), "_one", "left").drop("_one"))
    return out.select(user, F.coalesce("vec", "_z").alias("vec"))


def pair_similarity(pairs: DataFrame, vecs: DataFrame, a: str = "item", b: str = "relate_item") -> DataFrame:
    """V2: F8 (0.5 cosine + 0.5, truncated; 0.5 if a vector is missing)
    for a table of pairs. Only the pairs given are scored."""
    va = vecs.select(F.col("item_id").alias("_a"), F.col("vec").alias("_va"))
    vb = vecs.select(F.col("item_id").alias("_b"), F.col("vec").alias("_vb"))
    j = pairs.join(va, pairs[a] == va["_a"], "left").join(vb, pairs[b] == vb["_b"], "left")
    return j.select(*pairs.columns, affinity("_va", "_vb").alias("affinity"))


def exclude_seen(recs: DataFrame, history: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Drop recommendations already in the user's history."""
    h = history.select(user, item).distinct()
    return recs.join(h, [user, item], "left_anti")


def derived_dense_weights(spark, d_in: int, d_out: int, name: str = "tower") -> DataFrame:
    """Deterministic stand-in for a trained dense layer (md5 of name and
    position, scaled to [-0.1, 0.1)) as a weight table (i, j, w)."""
    return spark.range(d_in * d_out).select(
        F.floor(F.col("id") / F.lit(d_out)).cast("int").alias("i"), (F.col("id") % d_out).cast("int").alias("j"),
        ((uniform01(F.lit(name), F.col("id")) * 2 - 1) * 0.1).alias("w"))


def tower_vectors(df: DataFrame, key: str, vec: str, weights: DataFrame, max_cells: int = 1 << 24) -> DataFrame:
    """V1 / V3: batch inference of a one-layer tower (affine + ReLU + L2)
    with ``mapInPandas`` — Arrow batches, numpy matmul per batch. ``weights``
    is a table (i, j, w), e.g. read from Parquet; a layer has a fixed size,
    which is checked before its matrix goes to the tasks."""
    shape = weights.agg(F.max("i").alias("i"), F.max("j").alias("j")).first()
    if shape.i is None or (shape.i + 1) * (shape.j + 1) > max_cells:
        raise ValueError(f"a layer needs 1 to {max_cells} cells, not {shape}")
    w = np.zeros((shape.i + 1, shape.j + 1))
    for r in weights.select("i", "j", "w").collect():
        w[r.i, r.j] = r.w

    def infer(batches):
        for b in batches:
            if b.empty:
                continue
            x = np.stack([np.asarray(v, dtype=np.float64) for v in b[vec]])
            h = np.maximum(x @ w, 0.0)
            n = np.linalg.norm(h, axis=1, keepdims=True)
            h = np.where(n > 0, h / np.where(n > 0, n, 1.0), h)
            yield pd.DataFrame({key: b[key].to_numpy(), "vec": list(h)})

    return df.select(key, vec).mapInPandas(infer, f"{key} long, vec array<double>")


def derived_factors(states: dict[str, DataFrame], dim: int = 8) -> DataFrame:
    """Deterministic stand-in for trained FM factors as a table (field, code,
    vec), derived from the fitted codes (md5 of field, code and place)."""
    out = None
    for field, st in states.items():
        vec = F.array(*[uniform01(F.lit(field), F.col("id"), F.lit(d)) * 2 - 1 for d in range(dim)])
        part = st.select(F.lit(field).alias("field"), F.col("id").alias("code"), vec.alias("vec"))
        out = part if out is None else out.unionByName(part)
    return out


def fm_interaction(df: DataFrame, fields: list[str], factors: DataFrame, dim: int = 8, out: str = "fm") -> DataFrame:
    """M6: second-order FM term ``0.5 * sum_d((sum_f v)^2 - sum_f v^2)`` from a
    factor table (field, code, vec); codes without factors take zeros. One
    join per field, then plain arithmetic (codegen, no UDF)."""
    joined = df
    for i, f in enumerate(fields):
        part = factors.where(F.col("field") == f).select(F.col("code").alias(f"_code{i}"), F.col("vec").alias(f"_v{i}"))
        joined = joined.join(part, joined[f] == part[f"_code{i}"], "left")
    total = None
    for d in range(dim):
        s = None
        sq = None
        for i in range(len(fields)):
            v = F.coalesce(F.col(f"_v{i}")[d], F.lit(0.0))
            s = v if s is None else s + v
            sq = v * v if sq is None else sq + v * v
        term = s * s - sq
        total = term if total is None else total + term
    return joined.select(*[F.col(c) for c in df.columns], (F.lit(0.5) * total).alias(out))
