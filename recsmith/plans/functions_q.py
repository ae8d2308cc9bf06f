"""Scalar-function query (F1..F14) on per-item statistics and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.functions import columns as C
from recsmith.operators.logs import item_stats
from recsmith.plans.recall import _split_sql, recall_split
from recsmith.plans.registry import register
from recsmith.sources.fixtures import CLICKS_SQL, clicks, vectors

_DIM = 64


def _dot(a: str, b: str) -> str:
    return " + ".join(f"CAST({a}[{k + 1}] AS DOUBLE) * CAST({b}[{k + 1}] AS DOUBLE)" for k in range(_DIM))


_NORM_A = f"sqrt({_dot('va.embedding', 'va.embedding')})"
_NORM_B = f"sqrt({_dot('vb.embedding', 'vb.embedding')})"
_H = "CAST(('0x' || substr(md5(CAST(s.item_id AS VARCHAR)), 1, 8)) AS BIGINT)"

_SQL = f"""WITH {_split_sql(CLICKS_SQL)},
s AS (SELECT item_id, count(*) AS clicks, count(DISTINCT user_id) AS users FROM train GROUP BY item_id)
SELECT s.item_id,
  trunc(CAST(s.users AS DOUBLE) / CAST(s.clicks AS DOUBLE) * 10000.0::DOUBLE) / 10000.0::DOUBLE AS f1_trunc,
  round(greatest(0.5::DOUBLE, pow(0.9::DOUBLE, CAST(s.users AS DOUBLE))), 6) AS f2_loc,
  greatest(0.5::DOUBLE, 1.0::DOUBLE / (1.0::DOUBLE + CAST(s.clicks AS DOUBLE) / 10.0::DOUBLE)) AS f3_time,
  greatest(0.2::DOUBLE, 1.0::DOUBLE / (1.0::DOUBLE + s.clicks)) AS f4_pop,
  round(ln(1.0::DOUBLE + s.users) * ln(1.0::DOUBLE + s.clicks), 6) AS f5_act,
  CASE WHEN s.users > s.clicks / 2 THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS f6_order,
  round(greatest(3.0::DOUBLE, ln(1.0::DOUBLE + CAST(s.clicks AS DOUBLE) / CAST(s.users AS DOUBLE))) / (1.0::DOUBLE + 0.5::DOUBLE), 6) AS f7_edge,
  coalesce(trunc((0.5::DOUBLE * (({_dot('va.embedding', 'vb.embedding')}) / ({_NORM_A} * {_NORM_B})) + 0.5::DOUBLE)
                 * 10000.0::DOUBLE) / 10000.0::DOUBLE, 0.5::DOUBLE) AS f8_aff,
  round(sqrt(list_reduce(list_transform(va.embedding, lambda x: (CAST(x AS DOUBLE) / {_NORM_A}) * (CAST(x AS DOUBLE) / {_NORM_A})),
                         lambda acc, y: acc + y)), 6) AS f9_norm,
  round({_dot('va.embedding', 'vb.embedding')}, 6) AS f10_dot,
  CASE WHEN CAST(s.item_id AS VARCHAR) = '0' THEN 0 ELSE {_H} % 999 + 1 END AS f11_bucket,
  CAST(s.clicks > 100 AS INT) AS f12_bin,
  round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(CAST(s.users AS DOUBLE) / 100.0::DOUBLE))), 6) AS f13_sig,
  round(1.0::DOUBLE / log2(CAST(s.users AS DOUBLE) + 2.0::DOUBLE), 6) AS f14_gain
FROM s LEFT JOIN embeddings va ON va.vec_id = s.item_id LEFT JOIN embeddings vb ON vb.vec_id = s.item_id + 1"""


@register("scalar_functions", _SQL)
def q_scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1..F14 applied to per-item click statistics and item vectors (the
    item's vector against the next item's)."""
    train, _, _ = recall_split(clicks(spark, sf_dir))
    s = item_stats(train).select("item_id", "clicks", "users")
    v = vectors(spark, sf_dir)
    va = v.select(F.col("item_id").alias("_a"), F.col("vec").alias("va"))
    vb = v.select((F.col("item_id") - 1).alias("_b"), F.col("vec").alias("vb"))
    j = s.join(va, s.item_id == va._a, "left").join(vb, s.item_id == vb._b, "left")
    clicks_d, users_d = F.col("clicks").cast("double"), F.col("users").cast("double")
    return j.select(
        "item_id",
        C.trunc4(users_d / clicks_d).alias("f1_trunc"),
        F.round(C.loc_decay("users"), 6).alias("f2_loc"),
        C.time_decay(clicks_d / F.lit(10.0)).alias("f3_time"),
        C.popularity_damp("clicks").alias("f4_pop"),
        F.round(C.activity_damp("users", "clicks"), 6).alias("f5_act"),
        C.order_penalty("users", F.col("clicks") / 2).alias("f6_order"),
        F.round(C.edge_weight("clicks", "users", F.lit(0.5)), 6).alias("f7_edge"),
        C.affinity("va", "vb").alias("f8_aff"),
        F.round(F.sqrt(C.dot(C.l2_normalize("va"), C.l2_normalize("va"))), 6).alias("f9_norm"),
        F.round(C.dot("va", "vb"), 6).alias("f10_dot"),
        C.hash_bucket("item_id", 1000, mask_zero=True).alias("f11_bucket"),
        C.threshold_binarize("clicks", 100).alias("f12_bin"),
        F.round(C.sigmoid(users_d / F.lit(100.0)), 6).alias("f13_sig"),
        F.round(C.ndcg_gain("users"), 6).alias("f14_gain"))
