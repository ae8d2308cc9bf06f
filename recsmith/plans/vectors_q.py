"""Vector, model and UDF-surface queries (V1..V5, H3, M1..M8, D1, D2)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.functions.columns import sigmoid, uniform01
from recsmith.operators import apply as A
from recsmith.operators import features as fe
from recsmith.operators import models as M
from recsmith.operators import vectors as V
from recsmith.operators.retrieval import probe_report
from recsmith.operators.sampling import bootstrap, poisson_cuts, weighted_choice
from recsmith.operators.similarity import user_item_pairs

from recsmith.operators.alias import alias_draw, alias_table
from recsmith.plans.ctr import CTR_SQL, ctr_training_set
from recsmith.plans.graph_q import _u_sql, alias_sql
from recsmith.plans.recall import _split_sql, recall_split
from recsmith.plans.registry import register
from recsmith.sources.fixtures import CLICKS_SQL, DOCS_SQL, clicks, docs, vectors

DIM = 64


def _dot_sql(a: str, b: str, dim: int = DIM) -> str:
    return " + ".join(f"CAST({a}[{k + 1}] AS DOUBLE) * CAST({b}[{k + 1}] AS DOUBLE)" for k in range(dim))


_USERVEC_SQL = f"""{_split_sql(CLICKS_SQL)},
ex AS (SELECT t.user_id, g.d, CAST(e.embedding[g.d + 1] AS DOUBLE) AS x
       FROM train t JOIN embeddings e ON e.vec_id = t.item_id CROSS JOIN range({DIM}) AS g(d)),
pooled AS (SELECT user_id, list(m ORDER BY d) AS vec FROM (SELECT user_id, d, avg(x) AS m FROM ex GROUP BY user_id, d)
           GROUP BY user_id),
zero AS (SELECT list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS z FROM embeddings WHERE vec_id = 0 LIMIT 1),
uvec AS (SELECT u.user_id, coalesce(p.vec, (SELECT z FROM zero)) AS vec
         FROM (SELECT DISTINCT user_id FROM train) u LEFT JOIN pooled p ON p.user_id = u.user_id),
scored AS (SELECT u.user_id AS qid, e.vec_id AS item_id, {_dot_sql('u.vec', 'e.embedding')} AS score
           FROM uvec u CROSS JOIN embeddings e),
ranked AS (SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, item_id) AS INT) AS rank,
                  item_id, score FROM scored)"""


def _user_vectors(spark, sf_dir):
    train, _, _ = recall_split(clicks(spark, sf_dir))
    return train, V.history_mean_pool(train, vectors(spark, sf_dir))


@register("history_mean_pool", f"""WITH {_USERVEC_SQL}
SELECT user_id, g.k AS place, round(vec[g.k + 1], 6) AS value FROM uvec CROSS JOIN range({DIM}) g(k)""")
def q_history_mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: mean of the clicked items' vectors per user (id-0 vector if none)."""
    _, uv = _user_vectors(spark, sf_dir)
    return _places(uv, "user_id")


@register("topk_inner_product", f"""WITH {_USERVEC_SQL}
SELECT qid, rank, item_id, round(score, 6) AS score FROM ranked WHERE rank <= 100""")
def q_topk_inner_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 (+J8): exact top-100 items per user vector by inner product."""
    _, uv = _user_vectors(spark, sf_dir)
    items = vectors(spark, sf_dir).select("item_id", "vec")
    return V.topk_similar(uv.select(F.col("user_id").alias("qid"), "vec"), items, k=100)


@register("user_recommendations", f"""WITH {_USERVEC_SQL},
unseen AS (SELECT r.* FROM ranked r WHERE r.rank <= 100
           AND NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = r.qid AND t.item_id = r.item_id)),
cut AS (SELECT qid, item_id, score, row_number() OVER (PARTITION BY qid ORDER BY rank) AS n FROM unseen)
SELECT qid AS user_id, item_id, CAST(n AS INT) AS rank, round(score, 6) AS score FROM cut WHERE n <= 10""")
def q_user_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: V4 -> drop clicked items (J6) -> first 10, real item ids (Q10)."""
    train, uv = _user_vectors(spark, sf_dir)
    items = vectors(spark, sf_dir).select("item_id", "vec")
    top = V.topk_similar(uv.select(F.col("user_id").alias("qid"), "vec"), items, k=100)
    top = top.withColumnRenamed("qid", "user_id")
    fresh = V.exclude_seen(top, train)
    from recsmith.operators.logs import rank_in_group
    r = rank_in_group(fresh.withColumn("_neg", -F.col("rank")), "user_id", "_neg", ["item_id"], k=10, name="n")
    return r.select("user_id", "item_id", F.col("n").cast("int").alias("rank"), "score")


@register("most_similar_vectors", f"""WITH s AS (SELECT a.vec_id AS qid, b.vec_id AS item_id,
    ({_dot_sql('a.embedding', 'b.embedding')}) / (sqrt({_dot_sql('a.embedding', 'a.embedding')})
       * sqrt({_dot_sql('b.embedding', 'b.embedding')})) AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
r AS (SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, item_id) AS INT) AS rank, item_id, score FROM s)
SELECT qid, rank, item_id, round(score, 6) AS score FROM r WHERE rank <= 50""")
def q_most_similar_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G8 on given vectors: 50 nearest by cosine, self excluded."""
    v = vectors(spark, sf_dir)
    return V.topk_similar(v.select(F.col("item_id").alias("qid"), "vec"), v.select("item_id", "vec"),
                          k=50, cosine=True, exclude_self=True)


@register("retrieval_probes")
def q_retrieval_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 (rows-only): how many cells and items each user vector was scored
    with; the cells depend on floating-point centres, the results do not."""
    _, uv = _user_vectors(spark, sf_dir)
    return probe_report(uv.select(F.col("user_id").alias("qid"), "vec"), vectors(spark, sf_dir).select("item_id", "vec"), k=100)


def _aff_sql(a: str, b: str) -> str:
    cos = f"(({_dot_sql(a, b)}) / (sqrt({_dot_sql(a, a)}) * sqrt({_dot_sql(b, b)})))"
    return f"coalesce(trunc((0.5::DOUBLE * {cos} + 0.5::DOUBLE) * 10000.0::DOUBLE) / 10000.0::DOUBLE, 0.5::DOUBLE)"


@register("pair_similarity", f"""WITH {_split_sql(CLICKS_SQL)},
p AS (SELECT DISTINCT least(a.item_id, b.item_id) AS item, greatest(a.item_id, b.item_id) AS relate_item
      FROM train a JOIN train b ON a.user_id = b.user_id AND a.item_id < b.item_id)
SELECT p.item, p.relate_item, {_aff_sql('va.embedding', 'vb.embedding')} AS affinity
FROM p LEFT JOIN embeddings va ON va.vec_id = p.item LEFT JOIN embeddings vb ON vb.vec_id = p.relate_item""")
def q_pair_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: F8 on the distinct unordered item pairs that co-occur for a
    user (never on all item pairs)."""
    train, _, _ = recall_split(clicks(spark, sf_dir))
    return V.pair_similarity(user_item_pairs(train), vectors(spark, sf_dir))


def _tower_sql(source: str, key: str, name: str, d_out: int = 16) -> str:
    """Affine + ReLU + L2 of (key, vec) rows of `source`, one row per value."""
    return f"""w AS (SELECT id // {d_out} AS i, id % {d_out} AS j,
          ((CAST(('0x' || substr(md5(concat_ws('|', '{name}', id)), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE) * 2 - 1) * 0.1::DOUBLE AS w
   FROM range({DIM * d_out}) r(id)),
x AS (SELECT {key}, g.i, CAST(vec[g.i + 1] AS DOUBLE) AS x FROM {source} CROSS JOIN range({DIM}) g(i)),
h AS (SELECT {key}, j, greatest(sum(x * w), 0.0::DOUBLE) AS h FROM x JOIN w USING (i) GROUP BY {key}, j),
n AS (SELECT {key}, sqrt(sum(h * h)) AS n FROM h GROUP BY {key})
SELECT {key}, j AS place, round(CASE WHEN n > 0 THEN h / n ELSE h END, 6) AS value FROM h JOIN n USING ({key})"""


def _places(tower: DataFrame, key: str) -> DataFrame:
    return tower.select(key, F.posexplode("vec").alias("p", "x")).select(
        key, F.col("p").cast("bigint").alias("place"), F.round("x", 6).alias("value"))


@register("item_vector_export", f"WITH src AS (SELECT vec_id AS item_id, embedding AS vec FROM embeddings),\n"
                                f"{_tower_sql('src', 'item_id', 'item_tower')}")
def q_item_vector_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: tower inference per item (affine + ReLU + L2) from a weight table."""
    w = V.derived_dense_weights(spark, DIM, 16, "item_tower")
    return _places(V.tower_vectors(vectors(spark, sf_dir), "item_id", "vec", w), "item_id")


@register("user_vectors", f"WITH {_USERVEC_SQL.rstrip().rstrip(',')},\n{_tower_sql('uvec', 'user_id', 'user_tower')}")
def q_user_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: user-side tower over the pooled history vectors."""
    _, uv = _user_vectors(spark, sf_dir)
    w = V.derived_dense_weights(spark, DIM, 16, "user_tower")
    return _places(V.tower_vectors(uv, "user_id", "vec", w), "user_id")


@register("weighted_choice", f"""WITH e AS (SELECT user_id, item_id, count(*) AS w FROM {CLICKS_SQL} GROUP BY user_id, item_id),
cdf AS (SELECT user_id, item_id, sum(w) OVER (PARTITION BY user_id ORDER BY item_id) / sum(w) OVER (PARTITION BY user_id)::DOUBLE AS hi,
               (sum(w) OVER (PARTITION BY user_id ORDER BY item_id) - w) / sum(w) OVER (PARTITION BY user_id)::DOUBLE AS lo FROM e),
d AS (SELECT user_id, g.draw, CAST(('0x' || substr(md5(concat_ws('|', user_id, g.draw)), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u
      FROM (SELECT DISTINCT user_id FROM e) CROSS JOIN range(5) g(draw))
SELECT d.user_id, d.draw, c.item_id FROM d JOIN cdf c ON d.user_id = c.user_id AND d.u >= c.lo AND d.u < c.hi""")
def q_weighted_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five draws per user from the items, weighted by clicks."""
    adj = clicks(spark, sf_dir).groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("w"))
    draws = (adj.select("user_id").distinct().withColumn("draw", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(4).cast("bigint"))))
             .withColumn("_u", uniform01(F.col("user_id"), F.col("draw"))))
    return weighted_choice(adj, "user_id", "item_id", "w", draws, ["draw"]).select("user_id", "draw", "item_id")


_USER_ITEMS = f"e AS (SELECT user_id, item_id, count(*) AS w FROM {CLICKS_SQL} GROUP BY user_id, item_id)"


def _user_items(spark, sf_dir):
    return clicks(spark, sf_dir).groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("w"))


@register("alias_table", f"""WITH {_USER_ITEMS}, {alias_sql('e', 'user_id', 'item_id', 'w')}
SELECT g AS user_id, CAST(slot AS BIGINT) AS slot, c AS item_id, CAST(cut AS BIGINT) AS cut, alias, CAST(size AS BIGINT) AS size, CAST(n AS BIGINT) AS n FROM slots""")
def q_alias_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias tables of every user's items, weighted by clicks."""
    return alias_table(_user_items(spark, sf_dir), "user_id", "item_id", "w")


@register("alias_choice", f"""WITH {_USER_ITEMS}, {alias_sql('e', 'user_id', 'item_id', 'w')},
d AS (SELECT user_id, draw, {_u_sql('user_id', 'draw', "'s'")} AS u, {_u_sql('user_id', 'draw', "'c'")} AS v
      FROM (SELECT DISTINCT user_id FROM e) CROSS JOIN range(5) r(draw)),
z AS (SELECT DISTINCT g, n FROM slots)
SELECT d.user_id, d.draw, CASE WHEN d.v * CAST(s.size AS DOUBLE) < CAST(s.cut AS DOUBLE) THEN s.c ELSE s.alias END AS item_id
FROM d JOIN z ON z.g = d.user_id JOIN slots s ON s.g = d.user_id AND s.slot = least(CAST(floor(d.u * z.n) AS BIGINT), z.n - 1)""")
def q_alias_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five draws per user from its alias table, one equi-join."""
    adj = _user_items(spark, sf_dir)
    draws = (adj.select("user_id").distinct().withColumn("draw", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(4).cast("bigint"))))
             .withColumn("_u", uniform01(F.col("user_id"), F.col("draw"), F.lit("s")))
             .withColumn("_v", uniform01(F.col("user_id"), F.col("draw"), F.lit("c"))))
    return alias_draw(alias_table(adj, "user_id", "item_id", "w"), draws, "user_id", "item_id").select("user_id", "draw", "item_id")


# ------------------------------------------------------------ FM scoring (M6, M8)

_CTR_BODY = CTR_SQL.strip()
_CTR_WITH = _CTR_BODY[len("WITH "):_CTR_BODY.index("\nSELECT t.user_id, n.neg_item")]
_FIELDS = ["user_id", "item_id", "category"]


def _fm_sql(dim: int = 8) -> str:
    terms = []
    for d in range(dim):
        vs = [f"({_u_sql(repr(f), f, str(d))} * 2 - 1)" for f in _FIELDS]
        s = " + ".join(vs)
        sq = " + ".join(f"{v} * {v}" for v in vs)
        terms.append(f"(({s}) * ({s}) - ({sq}))")
    return "0.5 * (" + " + ".join(terms) + ")"


def _lin_sql() -> str:
    return " + ".join(f"({_u_sql(repr(f), f, repr('w'))} * 2 - 1)" for f in _FIELDS)


@register("fm_score", f"""WITH {_CTR_WITH},
s AS (SELECT user_id, {_fm_sql()} AS fm, {_lin_sql()} AS logit FROM feats WHERE is_test)
SELECT user_id, round(fm, 6) AS fm, round(1.0 / (1.0 + exp(-(logit + fm))), 6) AS prob FROM s""")
def q_fm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + M8 (+E12, F13): sigmoid(linear + FM pairwise term) for the CTR
    test rows from stored (derived) weights and factors."""
    out, states = ctr_training_set(clicks(spark, sf_dir))
    test = out.where(F.col("split") == "test")
    fm = V.fm_interaction(test, _FIELDS, V.derived_factors(states))
    lin = fe.linear_logit(test, ["user_id"], _FIELDS, fe.derived_weights(states))
    j = fm.select("user_id", "fm").join(lin, "user_id")
    return j.select("user_id", F.round("fm", 6).alias("fm"),
                    F.round(sigmoid(F.col("logit") + F.col("fm")), 6).alias("prob"))


@register("train_fm")
def q_train_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 (rows-only): a factorization machine fitted on the CTR training rows;
    scores the test rows."""
    out, _ = ctr_training_set(clicks(spark, sf_dir))
    params, bias = M.train_fm(out.where(F.col("split") == "train"), _FIELDS, "label")
    test = out.where(F.col("split") == "test").select("user_id", "item_id", "category")
    return M.score_fm(test, _FIELDS, params, bias).select("user_id", "item_id", F.round("prob", 6).alias("prob"))


# ------------------------------------------------------------ classic ML (M1..M5)

def _labelled_docs(spark, sf_dir):
    """(rows, features): length, toxicity and the fitted languages; one of
    them is left out, since they add up to one."""
    d = docs(spark, sf_dir).where(F.col("quality").isNotNull())
    d = fe.fill_zero(d, ["toxic"])
    d = d.withColumn("n_chars_k", F.col("n_chars") / F.lit(1000.0))
    langs = fe.fit_one_hot(d, "lang")
    rows = fe.apply_one_hot(d, "lang", langs, keep_source=True)
    return rows, ["n_chars_k", "toxic", *[f"lang_{v}" for v in langs[1:]]]


_TIMES_SQL = " + ".join(f"CASE WHEN u >= {b!r}::DOUBLE THEN 1 ELSE 0 END" for b in poisson_cuts(0.8))


@register("bootstrap_sample", f"""WITH d AS (SELECT doc_id, n_chars, {_u_sql('doc_id', '39')} AS u FROM documents),
t AS (SELECT doc_id, n_chars, {_TIMES_SQL} AS times FROM d)
SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, unnest(range(times)) FROM t)""")
def q_bootstrap_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn with replacement, 0.8 draws a row in the mean."""
    return bootstrap(docs(spark, sf_dir).select("doc_id", "n_chars"), 0.8, 39, key=["doc_id"])


@register("logistic_l1")
def q_logistic_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 (rows-only): L1 logistic regression coefficients, C = 1."""
    _, coefs = M.train_logistic_l1(*_labelled_docs(spark, sf_dir), "quality")
    return coefs


@register("cross_validate")
def q_cross_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 (rows-only): 5-fold accuracies."""
    return M.cross_validate(*_labelled_docs(spark, sf_dir), "quality", "doc_id")


@register("bagged_classifier")
def q_bagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + N3 (rows-only): 20 bootstrap models, floor of the mean vote."""
    return M.bagged_predictions(*_labelled_docs(spark, sf_dir), "quality", "doc_id", n=20)


@register("learning_curve")
def q_learning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 (rows-only)."""
    return M.learning_curve(*_labelled_docs(spark, sf_dir), "quality", "doc_id")


@register("validation_curve")
def q_validation_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 (rows-only): mean / population std per C."""
    return M.validation_curve(*_labelled_docs(spark, sf_dir), "quality", "doc_id")


# ------------------------------------------------------------ D1 / D2

@register("group_apply_gaps", f"""WITH {_split_sql(CLICKS_SQL)}
SELECT * FROM (SELECT user_id, item_id, time_us,
  (lead(time) OVER (PARTITION BY user_id ORDER BY time, item_id) - time) / 3600.0::DOUBLE AS gap FROM train)
WHERE gap IS NOT NULL""")
def q_group_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 written as a pandas function applied per user."""
    train, _, _ = recall_split(clicks(spark, sf_dir))
    out = A.group_apply(train.select("user_id", "item_id", "time", "time_us"), ["user_id"], A.next_gap_pandas(),
                        "user_id long, item_id long, time double, time_us long, gap double")
    return out.select("user_id", "item_id", "time_us", "gap")


@register("run_apply_gaps", f"""WITH {_split_sql(CLICKS_SQL)}
SELECT * FROM (SELECT user_id, item_id, time_us,
  (lead(time) OVER (PARTITION BY user_id ORDER BY time, item_id) - time) / 3600.0::DOUBLE AS gap FROM train)
WHERE gap IS NOT NULL""")
def q_run_apply_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 in runs: W6 with one row behind each run, groups of any size."""
    train, _, _ = recall_split(clicks(spark, sf_dir))
    out = A.run_apply(train.select("user_id", "item_id", "time", "time_us"), "user_id", ["time", "item_id"], A.next_gap_run(),
                      "user_id long, item_id long, time double, time_us long, gap double", after=1)
    return out.select("user_id", "item_id", "time_us", "gap")


@register("run_apply_positions", f"""WITH {_split_sql(CLICKS_SQL)}
SELECT user_id, item_id, time_us, row_number() OVER (PARTITION BY user_id ORDER BY time_us, item_id) - 1 AS loc FROM train""")
def q_run_apply_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 in runs with a fold: W8 from the rows counted ahead of each run."""
    train, _, _ = recall_split(clicks(spark, sf_dir))
    return A.run_apply(train.select("user_id", "item_id", "time_us"), "user_id", ["time_us", "item_id"], A.position_run(),
                       "user_id long, item_id long, time_us long, loc long", fold=A.count_fold())


@register("partition_apply", f"""SELECT d.doc_id, CASE WHEN d.lang = 'en' THEN 1 ELSE 0 END AS is_en,
  CAST(d.n_chars > 1000 AS INT) AS long_doc FROM {DOCS_SQL} d""")
def q_partition_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A per-partition row generator with a small captured value."""
    langs = {"en"}

    def gen(batches):
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "is_en": b["lang"].isin(langs).astype("int32"),
                                "long_doc": (b["n_chars"] > 1000).astype("int32")})

    return A.partition_apply(docs(spark, sf_dir).select("doc_id", "lang", "n_chars"), gen,
                             "doc_id long, is_en int, long_doc int")


