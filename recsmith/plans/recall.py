"""Debiased item recall: A12 -> W5 -> R1 -> R2 -> U3 -> X2 (+R6), on
``clicks`` (and R1 on ``baskets`` for scale), with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.operators.logs import dedup_exact, leave_two_out_split
from recsmith.operators.similarity import (
    DEEP_SLICE, NODE_SLICE, TEXT_SLICE, hot_fill, hot_items, item_similarity, ranking_metrics,
    recall_labelling, recommend)
from recsmith.operators.sequence import HOT_KEY_ROWS, HotSet, attach_hot, hot_keys
from recsmith.plans.registry import register
from recsmith.session import cut_lineage
from recsmith.sources.fixtures import BASKETS_SQL, CLICKS_SQL, baskets, clicks, vectors


def recall_split(log: DataFrame, hot_threshold: int = HOT_KEY_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A12 then W5 (holdout = latest): (train, validate, test).

    The split log is the base of every recall stage (the reference writes
    it to files), so it is materialised once in the checkpoint directory;
    later per-user passes scan it instead of recomputing the windows."""
    base = dedup_exact(log.select("user_id", "item_id", "time", "time_us"))
    # hot users are detected once on the whole log and reused by every
    # per-user stage downstream (valid for subsets; it only routes work)
    keys, n = hot_keys(base, "user_id", hot_threshold)
    hot = HotSet(keys, n)
    s = cut_lineage(leave_two_out_split(base, time_col="time_us", known=hot, hot_threshold=hot_threshold))
    if n:
        hot = HotSet(cut_lineage(keys), n)
    pick = lambda name: attach_hot(s.where(F.col("split") == name).drop("split"), hot)
    return pick("train"), pick("validate"), pick("test")


def _inputs(spark: SparkSession, sf_dir: str):
    train, validate, _ = recall_split(clicks(spark, sf_dir))
    return train, validate, vectors(spark, sf_dir)


# ------------------------------------------------------------------ SQL twin

def _t4(x: str) -> str:
    return f"(trunc(({x}) * 10000.0::DOUBLE) / 10000.0::DOUBLE)"


def _ticks(x: str) -> str:
    return f"CAST(trunc(({x}) * 10000.0::DOUBLE) AS BIGINT)"


def _dot(a: str, b: str, lo: int, hi: int) -> str:
    return " + ".join(f"CAST({a}[{k + 1}] AS DOUBLE) * CAST({b}[{k + 1}] AS DOUBLE)" for k in range(lo, hi))


def _aff(a: str, b: str, sl: tuple[int, int]) -> str:
    lo, hi = sl
    cos = f"(({_dot(a, b, lo, hi)}) / (sqrt({_dot(a, a, lo, hi)}) * sqrt({_dot(b, b, lo, hi)})))"
    return f"coalesce({_t4(f'0.5::DOUBLE * {cos} + 0.5::DOUBLE')}, 0.5::DOUBLE)"


def _split_sql(log_sql: str) -> str:
    return f"""log0 AS {log_sql},
dedup AS (SELECT DISTINCT user_id, item_id, time, time_us FROM log0),
split AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time_us DESC, item_id DESC) AS rn FROM dedup),
train AS (SELECT user_id, item_id, time, time_us FROM split WHERE rn > 2),
validate AS (SELECT user_id, item_id, time, time_us FROM split WHERE rn = 2)"""


_LD = "greatest(0.5::DOUBLE, pow(0.9::DOUBLE, CAST(dloc - 1 AS DOUBLE)))"
_TD = "greatest(0.5::DOUBLE, 1.0::DOUBLE / (1.0::DOUBLE + dt))"


def _sim_sql(top_k: int = 100, with_vectors: bool = True) -> str:
    vec = "v.embedding" if with_vectors else "CAST(NULL AS FLOAT[])"
    vjoin = "LEFT JOIN embeddings v ON v.vec_id = s.item_id" if with_vectors else ""
    return f"""seq AS (SELECT user_id, item_id, time, time_us,
               row_number() OVER (PARTITION BY user_id ORDER BY time_us, item_id) - 1 AS loc,
               count(*) OVER (PARTITION BY user_id) AS n FROM train),
iusers AS (SELECT item_id, count(DISTINCT user_id) AS users FROM train GROUP BY item_id),
seqv AS (SELECT s.*, u.users, {vec} AS vec FROM seq s JOIN iusers u ON s.item_id = u.item_id {vjoin}),
pairs AS (SELECT a.item_id AS item, b.item_id AS relate_item, a.loc AS loc1, b.loc AS loc2,
                 abs(b.loc - a.loc) AS dloc, {_t4('abs(a.time - b.time) / 3600.0::DOUBLE')} AS dt,
                 a.users AS users_i, a.n AS n,
                 {_aff('a.vec', 'b.vec', NODE_SLICE)} AS node,
                 {_aff('a.vec', 'b.vec', DEEP_SLICE)} AS deep,
                 {_aff('a.vec', 'b.vec', TEXT_SLICE)} AS txt
          FROM seqv a JOIN seqv b ON a.user_id = b.user_id AND a.item_id <> b.item_id),
acc AS (SELECT item, relate_item,
               sum({_ticks(f"node * node * deep * txt * {_LD} * {_TD} / (ln(1.0::DOUBLE + users_i) * ln(1.0::DOUBLE + n)) * (CASE WHEN loc1 > loc2 THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END)")}) AS sim_ticks,
               count(*) AS cnt,
               sum({_ticks(f"{_LD} * {_TD} / ln(1.0::DOUBLE + n)")}) AS weighted_ticks,
               min(dt) AS min_dt, CAST(min(dloc) AS BIGINT) AS min_dloc,
               max(node) AS node, sum({_ticks('node')}) AS node_ticks,
               max(deep) AS deep, sum({_ticks('deep')}) AS deep_ticks
        FROM pairs GROUP BY item, relate_item),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY sim_ticks DESC, relate_item) AS r
                       FROM acc) WHERE r <= {top_k}),
clk AS (SELECT item_id, count(*) AS c FROM train GROUP BY item_id),
sim AS (SELECT t.item, t.relate_item,
               {_t4('(t.sim_ticks / 10000.0::DOUBLE) / pow(CAST(ci.c * cj.c AS DOUBLE), 0.2::DOUBLE)')} AS sim,
               t.cnt, t.weighted_ticks / 10000.0::DOUBLE AS weighted, t.min_dt, t.min_dloc,
               t.node, t.node_ticks / 10000.0::DOUBLE AS node_sum, t.deep, t.deep_ticks / 10000.0::DOUBLE AS deep_sum
        FROM top t JOIN clk ci ON ci.item_id = t.item JOIN clk cj ON cj.item_id = t.relate_item)"""


_ALPHA = "greatest(0.2::DOUBLE, 1.0::DOUBLE / (1.0::DOUBLE + clicks))"
_BETA = "greatest(0.5::DOUBLE, pow(0.9::DOUBLE, CAST(loc AS DOUBLE)))"
_THETA = "greatest(0.5::DOUBLE, 1.0::DOUBLE / (1.0::DOUBLE + dt1))"
_GAMMA = "greatest(0.5::DOUBLE, 1.0::DOUBLE / (1.0::DOUBLE + dt2))"

_REC_SQL = f"""vusers AS (SELECT DISTINCT user_id FROM validate),
hist AS (SELECT user_id, item_id, time, time_us,
                row_number() OVER (PARTITION BY user_id ORDER BY time_us DESC, item_id DESC) - 1 AS loc,
                max(time) OVER (PARTITION BY user_id) AS t0
         FROM train WHERE user_id IN (SELECT user_id FROM vusers)),
s100 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY sim DESC, relate_item) AS r2 FROM sim)
         WHERE r2 <= 100),
cand AS (SELECT h.user_id, h.loc, h.time, h.t0, s.relate_item, s.sim, s.cnt, s.weighted, s.min_dt, s.min_dloc,
                s.node, s.node_sum, s.deep, s.deep_sum
         FROM hist h JOIN s100 s ON h.item_id = s.item
         WHERE NOT EXISTS (SELECT 1 FROM train x WHERE x.user_id = h.user_id AND x.item_id = s.relate_item)),
ist AS (SELECT item_id, count(*) AS clicks, min(time) AS first_seen FROM train GROUP BY item_id),
c2 AS (SELECT c.*, ist.clicks, abs(c.t0 - c.time) / 3600.0::DOUBLE AS dt1,
              abs(c.t0 - ist.first_seen) / 3600.0::DOUBLE AS dt2
       FROM cand c JOIN ist ON ist.item_id = c.relate_item),
agg AS (SELECT user_id, relate_item AS item_id,
               sum({_ticks(f"sim * ({_ALPHA} * {_ALPHA}) * {_BETA} * ({_THETA} * {_THETA}) * {_GAMMA}")}) AS score_ticks,
               sum(cnt) AS f_cnt, sum(CAST(round(weighted * 10000.0::DOUBLE) AS BIGINT)) AS w_ticks,
               min(min_dt) AS f_min_dt, min(min_dloc) AS f_min_dloc, min(dt1) AS m_dt1, min(dt2) AS m_dt2,
               min(loc) AS f_min_loc, max(node) AS f_node_max, sum(node_sum / cnt) AS f_node_avg_sum,
               max(deep) AS f_deep_max, sum(deep_sum / cnt) AS f_deep_avg_sum
        FROM c2 GROUP BY user_id, relate_item),
recs0 AS (SELECT user_id, item_id, score_ticks / 10000.0::DOUBLE AS score, CAST(f_cnt AS BIGINT) AS f_cnt,
                 w_ticks / 10000.0::DOUBLE AS f_weighted, f_min_dt, f_min_dloc,
                 {_t4('m_dt1')} AS f_recall_dt, {_t4('m_dt2')} AS f_age, CAST(f_min_loc AS BIGINT) AS f_min_loc,
                 f_node_max, round(f_node_avg_sum, 6) AS f_node_avg_sum, f_deep_max,
                 round(f_deep_avg_sum, 6) AS f_deep_avg_sum
          FROM agg),
recs AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS BIGINT) AS rank
                        FROM recs0) WHERE rank <= 200)"""

_HOT_SQL = """hot AS (SELECT item_id, hot_rank FROM (
          SELECT item_id, row_number() OVER (ORDER BY clicks DESC, item_id) AS hot_rank
          FROM (SELECT item_id, count(*) AS clicks FROM train GROUP BY item_id)) WHERE hot_rank <= 50),
ru AS (SELECT DISTINCT user_id FROM recs),
filled AS (SELECT ru.user_id, hot.item_id, CAST(-hot.hot_rank AS DOUBLE) AS score FROM ru CROSS JOIN hot),
both_ AS (SELECT user_id, item_id, score FROM recs UNION ALL SELECT user_id, item_id, score FROM filled),
dd AS (SELECT user_id, item_id, max(score) AS score FROM both_ GROUP BY user_id, item_id),
final AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS BIGINT) AS rank
                         FROM dd) WHERE rank <= 50)"""

_EVAL_SQL = """pop AS (SELECT item_id, count(*) AS deg FROM train GROUP BY item_id),
ans AS (SELECT v.user_id, v.item_id, coalesce(p.deg, 0) AS deg FROM validate v LEFT JOIN pop p ON p.item_id = v.item_id),
med AS (SELECT deg AS median FROM (SELECT deg, row_number() OVER (ORDER BY deg) AS rn, count(*) OVER () AS n FROM ans)
        WHERE rn = n // 2 + 1),
cases AS (SELECT a.*, f.rank - 1 AS r0, a.deg <= (SELECT median FROM med) AS half
          FROM ans a LEFT JOIN final f ON f.user_id = a.user_id AND f.item_id = a.item_id AND f.rank <= 50
          WHERE a.user_id IN (SELECT DISTINCT user_id FROM final)),
g AS (SELECT half, CASE WHEN r0 IS NOT NULL THEN 1.0::DOUBLE / log2(r0 + 2.0::DOUBLE) ELSE 0.0::DOUBLE END AS gain,
             CASE WHEN r0 IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS hit FROM cases)
SELECT round(avg(gain), 6) AS ndcg_full,
       round(sum(CASE WHEN half THEN gain END) / sum(CASE WHEN half THEN 1.0::DOUBLE END), 6) AS ndcg_half,
       round(avg(hit), 6) AS hr_full,
       round(sum(CASE WHEN half THEN hit END) / sum(CASE WHEN half THEN 1.0::DOUBLE END), 6) AS hr_half
FROM g"""

SIM_COLS = "item, relate_item, sim, cnt, weighted, min_dt, min_dloc, node, node_sum, deep, deep_sum"


@register("item_similarity_top", f"WITH {_split_sql(CLICKS_SQL)},\n{_sim_sql()}\nSELECT {SIM_COLS} FROM sim")
def q_item_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, vec = _inputs(spark, sf_dir)
    return item_similarity(train, vec)


@register("recommend_top", f"WITH {_split_sql(CLICKS_SQL)},\n{_sim_sql()},\n{_REC_SQL}\nSELECT * FROM recs")
def q_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, validate, vec = _inputs(spark, sf_dir)
    return recommend(train, item_similarity(train, vec), users=validate)


@register("recall_hot_fill",
          f"WITH {_split_sql(CLICKS_SQL)},\n{_sim_sql()},\n{_REC_SQL},\n{_HOT_SQL}\nSELECT user_id, item_id, score, rank FROM final")
def q_hot_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, validate, vec = _inputs(spark, sf_dir)
    recs = recommend(train, item_similarity(train, vec), users=validate)
    return hot_fill(recs, hot_items(train))


@register("recall_eval", f"WITH {_split_sql(CLICKS_SQL)},\n{_sim_sql()},\n{_REC_SQL},\n{_HOT_SQL},\n{_EVAL_SQL}")
def q_recall_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, validate, vec = _inputs(spark, sf_dir)
    # both are read twice below, and small beside the pairs behind them
    recs = cut_lineage(recommend(train, item_similarity(train, vec), users=validate))
    return ranking_metrics(cut_lineage(hot_fill(recs, hot_items(train))), validate, train)


@register("hot_items", f"""WITH {_split_sql(CLICKS_SQL)},
{_HOT_SQL.split(',' + chr(10) + 'ru AS')[0]}
SELECT item_id, CAST(hot_rank AS INT) AS hot_rank FROM hot""")
def q_hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, _ = _inputs(spark, sf_dir)
    return hot_items(train).select("item_id", "hot_rank")


@register("item_similarity_scale", f"""WITH {_split_sql(BASKETS_SQL)},
{_sim_sql()}
SELECT {SIM_COLS} FROM sim""")
def q_item_similarity_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, _ = recall_split(baskets(spark, sf_dir))
    return item_similarity(train, vectors(spark, sf_dir))


_LABEL_SQL = """lab AS (SELECT r.user_id, r.item_id, CAST(r.item_id = v.item_id AS INT) AS label
        FROM recs r JOIN validate v ON r.user_id = v.user_id),
pu AS (SELECT user_id, count(*) AS p FROM lab WHERE label = 1 GROUP BY user_id),
rr AS (SELECT l.*, g.round, pu.p FROM lab l CROSS JOIN range(6) AS g(round) JOIN pu ON pu.user_id = l.user_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY user_id, round, label ORDER BY
         CAST(('0x' || substr(md5(concat_ws('|', user_id, item_id, round)), 1, 8)) AS BIGINT), item_id) AS k FROM rr)
SELECT CAST(round AS INT) AS round, user_id, item_id, label FROM rk WHERE label = 1 OR k <= p * 5"""


@register("recall_labelling", f"WITH {_split_sql(CLICKS_SQL)},\n{_sim_sql()},\n{_REC_SQL},\n{_LABEL_SQL}")
def q_recall_labelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds of 1 positive : 5 negatives from the recall list."""
    train, validate, vec = _inputs(spark, sf_dir)
    recs = recommend(train, item_similarity(train, vec), users=validate)
    return recall_labelling(recs, validate)


