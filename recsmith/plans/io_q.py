"""Source/sink round trips (S1..S8): each query writes data Spark derives
from the given tables and reads it back; the oracle computes the same
rows directly from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.operators.encode import attach_scalars
from recsmith.operators.logs import item_stats
from recsmith.operators.similarity import hot_fill, hot_items, item_similarity, recommend
from recsmith.plans.ctr import CTR_SQL, ctr_training_set, select_ctr_fields
from recsmith.plans.recall import SIM_COLS, _HOT_SQL, _REC_SQL, _sim_sql, _split_sql, recall_split
from recsmith.plans.registry import register
from recsmith.sources import io
from recsmith.sources.fixtures import CLICKS_SQL, clicks, table, vectors

WEEK_US = 7 * 86_400 * 1_000_000
MAX_STAGE = 9


@register("read_table", "SELECT * FROM part")
def q_read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: full scan of one table, all columns."""
    return table(spark, sf_dir, "part")


@register("read_click_logs", f"""WITH {_split_sql(CLICKS_SQL)},
t0 AS (SELECT min(time_us) AS t0 FROM log0),
parts AS (SELECT d.user_id, d.item_id, d.time_us, CASE WHEN s.rn = 1 THEN 'test' ELSE 'train' END AS phase,
                 CAST((d.time_us - (SELECT t0 FROM t0)) // {WEEK_US} AS INT) AS stage
          FROM dedup d JOIN split s USING (user_id, item_id, time_us))
SELECT * FROM parts WHERE stage <= {MAX_STAGE}""")
def q_read_click_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S7 + U1: the split log written as header-less CSV per
    (phase, stage), read back for stages 0..9 with an explicit schema."""
    train, validate, test = recall_split(clicks(spark, sf_dir))
    t0 = clicks(spark, sf_dir).agg(F.min("time_us").alias("_t0"))
    log = (train.unionByName(validate).withColumn("phase", F.lit("train"))
           .unionByName(test.withColumn("phase", F.lit("test"))))
    log = attach_scalars(log, t0).withColumn(
        "stage", F.floor((F.col("time_us") - F.col("_t0")) / F.lit(WEEK_US)).cast("int"))
    base = io.scratch_dir(spark, "click_logs")
    io.write_click_logs(log, base)
    back = io.read_click_logs(spark, base, MAX_STAGE)
    return back.select("user_id", "item_id", "time_us", "phase", F.col("stage").cast("int").alias("stage"))


@register("read_item_vectors", """SELECT vec_id AS item_id, k AS place,
  CAST(embedding[k] AS DOUBLE) AS text_value, CAST(embedding[32 + k] AS DOUBLE) AS image_value
FROM embeddings, range(1, 33) r(k)""")
def q_read_item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors written as ``id,[text...],[image...]`` lines and parsed back."""
    path = io.scratch_dir(spark, "item_vectors")
    io.write_item_vectors_csv(vectors(spark, sf_dir), path, split=32)
    v = io.read_item_vectors(spark, path)
    pairs = v.select("item_id", F.posexplode(F.arrays_zip("text_vec", "image_vec")).alias("p", "x"))
    return pairs.select("item_id", (F.col("p") + 1).cast("bigint").alias("place"),
                        F.col("x.text_vec").cast("double").alias("text_value"),
                        F.col("x.image_vec").cast("double").alias("image_value"))


_CTR_BODY = CTR_SQL.strip()


@register("training_set_roundtrip", f"""WITH rows_ AS ({_CTR_BODY})
SELECT * FROM rows_""")
def q_training_set_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the CTR set with its length contract and read it back."""
    out, _ = ctr_training_set(clicks(spark, sf_dir))
    path = io.scratch_dir(spark, "ctr_set")
    io.write_training_set(out, path, {"hist_items": 20, "hist_cats": 20})
    back = io.read_training_set(spark, path)
    return select_ctr_fields(back)


@register("vectors_text_roundtrip", """SELECT vec_id AS item_id, k AS place, CAST(embedding[k] AS DOUBLE) AS value,
  (SELECT count(*) FROM embeddings) AS declared_count, 64 AS declared_dim FROM embeddings, range(1, 65) r(k)""")
def q_vectors_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word2vec text layout written and read back."""
    path = io.scratch_dir(spark, "w2v_text")
    io.write_vectors_text(vectors(spark, sf_dir), path, dim=64)
    v = io.read_vectors(spark, path)
    return v.select("item_id", F.posexplode("vec").alias("p", "x"), "declared_count", "declared_dim").select(
        "item_id", (F.col("p") + 1).cast("bigint").alias("place"), F.col("x").cast("double").alias("value"),
        "declared_count", "declared_dim")


@register("similarity_parts_roundtrip", f"WITH {_split_sql(CLICKS_SQL)},\n{_sim_sql()}\nSELECT {SIM_COLS} FROM sim")
def q_similarity_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The similarity table written as 10 hash-partitioned parts by
    item and read back in parallel."""
    train, _, _ = recall_split(clicks(spark, sf_dir))
    path = io.scratch_dir(spark, "sim_parts")
    io.write_parts(item_similarity(train, vectors(spark, sf_dir)), path, 10, "item")
    return spark.read.parquet(path).drop("part")


@register("recommendations_csv_roundtrip",
          f"WITH {_split_sql(CLICKS_SQL)},\n{_sim_sql()},\n{_REC_SQL},\n{_HOT_SQL}\nSELECT user_id, item_id, score, rank FROM final")
def q_recs_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final recommendations written as CSV with a header and read back."""
    train, validate, _ = recall_split(clicks(spark, sf_dir))
    vec = vectors(spark, sf_dir)
    final = hot_fill(recommend(train, item_similarity(train, vec), users=validate), hot_items(train))
    path = io.scratch_dir(spark, "recs_csv")
    io.write_csv(final, path)
    return io.read_csv(spark, path, "user_id long, item_id long, score double, rank long")


@register("materialize_if_absent", f"""WITH {_split_sql(CLICKS_SQL)}
SELECT item_id, count(*) AS clicks, count(DISTINCT user_id) AS users, min(time) AS first_seen
FROM train GROUP BY item_id""")
def q_materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first call builds and saves, the second reuses the saved table."""
    train, _, _ = recall_split(clicks(spark, sf_dir))
    path = io.scratch_dir(spark, "item_stats")
    io.materialize_if_absent(spark, path, lambda: item_stats(train))
    return io.materialize_if_absent(spark, path, lambda: (_ for _ in ()).throw(RuntimeError("rebuilt")))
