"""Feature-engineering queries (E1..E13, N2, P2..P6, P8) with DuckDB twins."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.functions.columns import presence_flag, threshold_binarize
from recsmith.operators import encode as enc
from recsmith.operators import features as fe
from recsmith.operators.logs import keep_positive
from recsmith.operators.sampling import stratified_sample
from recsmith.plans.ctr import CTR_SQL, ctr_training_set
from recsmith.plans.recall import recall_split
from recsmith.plans.registry import register
from recsmith.sources.io import scratch_dir
from recsmith.sources.fixtures import (
    CLICKS_SQL, DOCS_SQL, PRODUCTS_SQL, clicks, docs, products, table, vectors)

# The p_type domain of the test tables (one-hot columns).
P_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


# ---------------------------------------------------------------- E4 one-hot

@register("one_hot", "SELECT item_id, p_size, " + ", ".join(
    f"CAST(p_type IS NOT DISTINCT FROM '{v}' AS INT) AS \"p_type_{v}\"" for v in P_TYPES)
    + f" FROM {PRODUCTS_SQL}")
def q_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = products(spark, sf_dir).select("item_id", "p_size", "p_type")
    values = fe.fit_one_hot(p, "p_type")
    return fe.apply_one_hot(p, "p_type", values)


# ---------------------------------------------------------------- E5 scale

@register("standard_scale", f"""SELECT item_id,
  round((p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER (), 6) AS p_size,
  round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 6) AS p_retailprice
FROM {PRODUCTS_SQL}""")
def q_standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = products(spark, sf_dir).select("item_id", F.col("p_size").cast("double"), "p_retailprice")
    fields = ["p_size", "p_retailprice"]
    out = fe.apply_standard_scale(p, fields, fe.fit_standard_scale(p, fields))
    return out.select("item_id", *[F.round(f, 6).alias(f) for f in fields])


# ---------------------------------------------------------------- E6 / F12

@register("count_binarize", f"""WITH p AS {PRODUCTS_SQL},
c AS (SELECT p_brand, count(*) AS n FROM p GROUP BY p_brand)
SELECT p.item_id, CAST(coalesce(c.n, 0) >= 80 AS INT) AS p_brand_frequent,
       CAST(p.p_retailprice > 1500 AS INT) AS price_high
FROM p LEFT JOIN c ON p.p_brand IS NOT DISTINCT FROM c.p_brand""")
def q_count_binarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = products(spark, sf_dir).select("item_id", "p_brand", "p_retailprice")
    state = fe.fit_count_binarize(p, "p_brand")
    out = fe.apply_count_binarize(p, "p_brand", state, min_count=80, out="p_brand_frequent")
    return out.select("item_id", "p_brand_frequent", threshold_binarize("p_retailprice", 1500).alias("price_high"))


# ---------------------------------------------------------------- E8

@register("label_encode", """SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment NULLS FIRST) - 1 AS BIGINT)
  AS c_mktsegment FROM customer""")
def q_label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return enc.label_encode(c, "c_mktsegment")


# ---------------------------------------------------------------- E1 append

_SPLIT = f"""log0 AS {CLICKS_SQL},
dedup AS (SELECT DISTINCT user_id, item_id, time, time_us FROM log0),
split AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time_us DESC, item_id DESC) AS rn FROM dedup),
train AS (SELECT * FROM split WHERE rn > 2)"""


@register("encode_append", f"""WITH {_SPLIT},
iknown AS (SELECT item_id AS value, CAST(dense_rank() OVER (ORDER BY item_id) + 1 AS BIGINT) AS id
           FROM (SELECT DISTINCT item_id FROM train)),
ifresh AS (SELECT DISTINCT item_id AS value FROM log0 WHERE item_id NOT IN (SELECT value FROM iknown)),
uknown AS (SELECT user_id AS value, CAST(dense_rank() OVER (ORDER BY user_id) + 1 AS BIGINT) AS id
           FROM (SELECT DISTINCT user_id FROM train)),
ufresh AS (SELECT DISTINCT user_id AS value FROM log0 WHERE user_id NOT IN (SELECT value FROM uknown))
SELECT 'item_id' AS field, value, id FROM iknown
UNION ALL
SELECT 'item_id', value, CAST(dense_rank() OVER (ORDER BY value) + (SELECT count(*) FROM iknown) + 1 AS BIGINT)
FROM ifresh
UNION ALL
SELECT 'user_id', value, id FROM uknown
UNION ALL
SELECT 'user_id', value, CAST(dense_rank() OVER (ORDER BY value) + (SELECT count(*) FROM uknown) + 1 AS BIGINT)
FROM ufresh""")
def q_encode_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 with ``is_unk``: fit on the train split, then append-fit on the
    whole log; codes of known values never change, new values follow."""
    log = clicks(spark, sf_dir)
    train, _, _ = recall_split(log)
    out = None
    for field in ("item_id", "user_id"):
        first = enc.fit_encoding(train, field, None, is_unk=True)
        second = enc.fit_encoding(log, field, first, is_unk=True)
        part = second.select(F.lit(field).alias("field"), "value", "id")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- E3 / P6 / P8 on R5

_CTR_BODY = CTR_SQL.strip()
_CTR_WITH = _CTR_BODY[len("WITH "):_CTR_BODY.index("\nSELECT t.user_id, n.neg_item")]


@register("decode_test_rows", f"""WITH log AS {CLICKS_SQL},
latest AS (SELECT user_id, item_id, max(time_us) AS time_us FROM log GROUP BY user_id, item_id),
last AS (SELECT user_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time_us DESC, item_id DESC) AS rn
         FROM latest) WHERE rn = 1)
SELECT user_id, item_id FROM last""")
def q_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode the R5 test rows (codes) back to raw user and item ids."""
    out, states = ctr_training_set(clicks(spark, sf_dir))
    test = out.where(F.col("split") == "test").select("user_id", "item_id")
    test = enc.decode(test, "user_id", states["user_id"])
    return enc.decode(test, "item_id", states["item_id"])


@register("holdout_user_filter", f"""WITH log AS {CLICKS_SQL},
latest AS (SELECT user_id, item_id, max(time_us) AS time_us FROM log GROUP BY user_id, item_id),
last AS (SELECT user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time_us DESC, item_id DESC) AS rn
         FROM latest) WHERE rn = 1)
SELECT user_id AS raw_user_id FROM last WHERE user_id >= 100""")
def q_holdout_user_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode the encoded user through a join on the encoding table
    (no UDF) and keep raw ids >= 100; item columns dropped."""
    out, states = ctr_training_set(clicks(spark, sf_dir))
    test = out.where(F.col("split") == "test").select("user_id")
    dec = enc.decode(test, "user_id", states["user_id"], out="raw_user_id")
    return dec.where(F.col("raw_user_id") >= 100).select("raw_user_id")


@register("keep_positive", f"""WITH {_CTR_WITH},
rows_ AS (SELECT user_id, item_id FROM train UNION ALL SELECT user_id, item_id FROM feats WHERE is_test)
SELECT DISTINCT user_id, item_id FROM rows_""")
def q_keep_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 (+U2): label == 1 rows of the CTR set, distinct (user, item)."""
    out, _ = ctr_training_set(clicks(spark, sf_dir))
    return keep_positive(out)


# ---------------------------------------------------------------- E13 / E12

@register("feature_spec", f"""WITH log AS {CLICKS_SQL},
latest AS (SELECT user_id, item_id, max(time_us) AS t FROM log GROUP BY user_id, item_id),
cat AS (SELECT item_id, min(category) AS category FROM log GROUP BY item_id),
l2 AS (SELECT l.*, c.category FROM latest l JOIN cat c USING (item_id)),
sizes AS (SELECT 'user_id' AS field, count(DISTINCT user_id) + 1 AS vocab_size FROM l2
          UNION ALL SELECT 'item_id', count(DISTINCT item_id) + 1 FROM l2
          UNION ALL SELECT 'category', count(DISTINCT category) + 1 FROM l2),
spec AS (SELECT * FROM (VALUES ('user_id', 'sparse', 'user_id', 1, 16), ('item_id', 'sparse', 'item_id', 1, 16),
                               ('category', 'sparse', 'category', 1, 8), ('hist_items', 'sequence', 'item_id', 20, 16),
                               ('hist_cats', 'sequence', 'category', 20, 8)) AS t(field, kind, embedding_name, max_len, dim)),
j AS (SELECT s.*, z.vocab_size FROM spec s LEFT JOIN sizes z ON s.field = z.field)
SELECT j.field, j.kind, j.embedding_name, j.max_len, j.dim, j.vocab_size, t.table_size
FROM j JOIN (SELECT embedding_name, max(vocab_size) AS table_size FROM j GROUP BY embedding_name) t
  ON j.embedding_name = t.embedding_name""")
def q_feature_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field specs of the CTR set with vocabulary and shared table sizes."""
    _, states = ctr_training_set(clicks(spark, sf_dir))
    spec = spark.createDataFrame(
        [("user_id", "sparse", "user_id", 1, 16), ("item_id", "sparse", "item_id", 1, 16),
         ("category", "sparse", "category", 1, 8), ("hist_items", "sequence", "item_id", 20, 16),
         ("hist_cats", "sequence", "category", 20, 8)],
        "field string, kind string, embedding_name string, max_len int, dim int")
    return fe.feature_spec(states, spec).select("field", "kind", "embedding_name", "max_len", "dim",
                                                "vocab_size", "table_size")


def _w_sql(field: str, code: str) -> str:
    h = f"CAST(('0x' || substr(md5(concat_ws('|', '{field}', {code}, 'w')), 1, 8)) AS BIGINT)"
    return f"({h} / 4294967296.0::DOUBLE * 2 - 1)"


@register("linear_logit", f"""WITH {_CTR_WITH}
SELECT user_id, round({_w_sql('user_id', 'user_id')} + {_w_sql('item_id', 'item_id')}
                      + {_w_sql('category', 'category')}, 6) AS logit
FROM feats WHERE is_test""")
def q_linear_logit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E12 on the CTR test rows with weights derived per (field, code)."""
    out, states = ctr_training_set(clicks(spark, sf_dir))
    test = out.where(F.col("split") == "test")
    w = fe.derived_weights(states)
    res = fe.linear_logit(test, ["user_id"], ["user_id", "item_id", "category"], w)
    return res.select("user_id", F.round("logit", 6).alias("logit"))


# ---------------------------------------------------------------- E10 / E11

@register("embedding_lookup", """WITH items AS (SELECT DISTINCT l_partkey AS item_id FROM lineitem),
z AS (SELECT embedding AS vec FROM embeddings WHERE vec_id = 0 LIMIT 1),
j AS (SELECT i.item_id, coalesce(e.embedding, (SELECT vec FROM z)) AS emb
      FROM items i LEFT JOIN embeddings e ON e.vec_id = i.item_id)
SELECT item_id, CAST(g.k AS INT) AS place, CAST(emb[g.k + 1] AS DOUBLE) AS value,
       e2.vec_id IS NOT NULL AS known FROM j LEFT JOIN embeddings e2 ON e2.vec_id = j.item_id CROSS JOIN range(64) g(k)""")
def q_embedding_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket items -> vectors; items without one get the id-0 vector."""
    items = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("item_id")).distinct()
    v = vectors(spark, sf_dir)
    looked = fe.embedding_lookup(items, "item_id", v, id_col="item_id", vec_col="vec")
    known = v.select(F.col("item_id").alias("_k"), F.lit(True).alias("known"))
    looked = looked.join(known, looked.item_id == known._k, "left")
    return looked.select("item_id", F.posexplode("emb").alias("place", "v"), F.coalesce(F.col("known"), F.lit(False)).alias("known")).select(
        "item_id", "place", F.col("v").cast("double").alias("value"), "known")


@register("assemble_features", """SELECT p.p_partkey AS item_id, CAST(g.k AS INT) AS place,
  CASE g.k WHEN 0 THEN CAST(p.p_size AS DOUBLE) WHEN 1 THEN p.p_retailprice
           ELSE coalesce(CAST(e.embedding[g.k - 1] AS DOUBLE), 0) END AS value
FROM part p LEFT JOIN embeddings e ON e.vec_id = p.p_partkey CROSS JOIN range(66) g(k)""")
def q_assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense columns followed by the item vector as one array; items
    without a vector take zeros."""
    p = products(spark, sf_dir).select("item_id", "p_size", "p_retailprice")
    j = p.join(vectors(spark, sf_dir).select("item_id", "vec"), "item_id", "left").withColumn(
        "vec", F.coalesce("vec", F.array_repeat(F.lit(0.0).cast("float"), 64)))
    a = fe.assemble_features(j, ["p_size", "p_retailprice"], ["vec"])
    return a.select("item_id", F.posexplode("features").alias("place", "value"))


@register("one_hot_sparse", f"""WITH log AS {CLICKS_SQL},
codes AS (SELECT item_id, CAST(row_number() OVER (ORDER BY item_id NULLS FIRST) - 1 AS BIGINT) AS code FROM (SELECT DISTINCT item_id FROM log)),
w AS (SELECT count(*) AS width FROM codes)
SELECT l.user_id, l.item_id, l.time_us, c.code, width FROM log l JOIN codes c ON c.item_id IS NOT DISTINCT FROM l.item_id CROSS JOIN w""")
def q_one_hot_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 for a wide field: every click's item as the place of its one, of as
    many columns as there are items; nothing is collected."""
    log = clicks(spark, sf_dir).select("user_id", "item_id", "time_us")
    codes = fe.fit_one_hot_sparse(log, "item_id")
    width = codes.agg(F.count(F.lit(1)).alias("width"))
    coded = enc.attach_scalars(fe.apply_one_hot_sparse(log, "item_id", codes, "code"), width)
    return coded.select("user_id", "item_id", "time_us", F.col("code")[0].alias("code"), "width")


# ---------------------------------------------------------------- N2 / P2..P4 / E7

@register("stratified_sample", f"""WITH d AS (SELECT doc_id, quality FROM {DOCS_SQL} WHERE quality IS NOT NULL),
q AS (SELECT quality, CAST(round(0.5 * count(*)) AS BIGINT) AS quota FROM d GROUP BY quality),
r AS (SELECT d.*, row_number() OVER (PARTITION BY quality ORDER BY
        CAST(('0x' || substr(md5(concat_ws('|', doc_id, 39)), 1, 8)) AS BIGINT), doc_id) AS rk FROM d)
SELECT r.doc_id, r.quality FROM r JOIN q ON r.quality = q.quality WHERE r.rk <= q.quota""")
def q_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir).select("doc_id", "quality").where(F.col("quality").isNotNull())
    return stratified_sample(d, "quality", ["doc_id"], rate=0.5).select("doc_id", "quality")


@register("docs_cleaning", f"""SELECT doc_id, lang, n_chars,
  CASE WHEN quality IS NOT NULL THEN 'Yes' ELSE 'No' END AS has_label,
  coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
FROM {DOCS_SQL}""")
def q_docs_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 (drop/rename), P3 (presence flag) and P4 (fill zero) on docs."""
    d = docs(spark, sf_dir)
    d = d.withColumn("has_label", presence_flag("quality"))
    d = fe.drop_and_rename(d, ["source"], {})
    return fe.fill_zero(d, ["quality", "toxic"]).select("doc_id", "lang", "n_chars", "has_label", "quality", "toxic")


@register("model_fill")
def q_model_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7 (rows-only): fill missing ``quality`` with a random forest of 500
    trees on length, language and source of the documents (seed 39)."""
    d = docs(spark, sf_dir).select("doc_id", "n_chars", "quality", "lang", "source")
    d = enc.label_encode(enc.label_encode(d, "lang", "lang_code"), "source", "source_code")
    feats = ["n_chars", "lang_code", "source_code"]
    model = fe.fit_model_fill(d, "quality", feats, mode="classification")
    return fe.apply_model_fill(d, "quality", feats, model).select("doc_id", "quality")


# ---------------------------------------------------------------- E9 / S9

@register("encoding_state_roundtrip", f"""WITH log AS {CLICKS_SQL},
latest AS (SELECT user_id, item_id, max(time_us) AS t FROM log GROUP BY user_id, item_id),
cat AS (SELECT item_id, min(category) AS category FROM log GROUP BY item_id),
l2 AS (SELECT l.*, c.category FROM latest l JOIN cat c USING (item_id))
SELECT 'item_id' AS field, CAST(item_id AS VARCHAR) AS value, CAST(dense_rank() OVER (ORDER BY item_id) AS BIGINT) AS id
FROM (SELECT DISTINCT item_id FROM l2)
UNION ALL
SELECT 'category', category, CAST(dense_rank() OVER (ORDER BY category) AS BIGINT) FROM (SELECT DISTINCT category FROM l2)""")
def q_encoding_state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 + S9: save the fitted encodings, reload two of the fields (and a
    field that was never saved, which yields no rows)."""
    _, states = ctr_training_set(clicks(spark, sf_dir))
    path = scratch_dir(spark, "encodings")
    fe.save_state(fe.encoding_table(states), path)
    return fe.load_encodings(spark, path, ["item_id", "category", "never_saved"])

