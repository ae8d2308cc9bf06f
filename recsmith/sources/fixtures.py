"""Views over the shared test tables, in the shapes the pipelines read.

``clicks``   events: user, item (JSON ``k``), category (event type), time
``baskets``  lineitem x orders: customer, part, order date
``products`` part attributes; ``profiles`` customer x nation
``vectors``  embeddings; ``docs`` documents left join labels

Each loader only selects the columns it needs so Parquet scans are pruned.
The matching DuckDB snippets live next to them (``*_SQL``) so every oracle
query starts from the very same definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.functions.columns import epoch_micros

MICROS = 1_000_000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S3: full scan of one table (Parquet; a catalog table works the same)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    t = epoch_micros("ts")
    return ev.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.col("event_type").alias("category"),
        t.alias("time_us"),
        (t / F.lit(MICROS)).alias("time"),
    )


CLICKS_SQL = """(SELECT CAST(user_id AS BIGINT) AS user_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
        event_type AS category,
        epoch_us(ts) AS time_us,
        epoch_us(ts) / 1e6 AS time
   FROM events)"""


# Context of a click, in the place of environment, device, system, country,
# region and referrer of the news log.
CONTEXT = ("value_bucket", "segment", "nation", "region", "hour", "weekday")


def clicks_with_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``clicks`` and the ``CONTEXT`` columns: the event's value bucket, its
    user's market segment, nation and region (null for users that are no
    customers), hour and weekday."""
    ev = table(spark, sf_dir, "events")
    t = epoch_micros("ts")
    log = ev.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.col("event_type").alias("category"), t.alias("time_us"), (t / F.lit(MICROS)).alias("time"),
        F.floor(F.col("value") / F.lit(10.0)).cast("bigint").alias("value_bucket"),
        F.hour("ts").cast("bigint").alias("hour"), F.dayofweek("ts").cast("bigint").alias("weekday"))
    users = (table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("segment"))
             .join(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey",
                                                         F.col("n_name").alias("nation")), "c_nationkey")
             .join(table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"),
                                                         F.col("r_name").alias("region")), "n_regionkey"))
    return (log.join(users, log.user_id == users.c_custkey, "left")
            .select("user_id", "item_id", "category", "time_us", "time", *CONTEXT))


CLICKS_CONTEXT_SQL = """(SELECT CAST(e.user_id AS BIGINT) AS user_id,
        CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS item_id,
        e.event_type AS category, epoch_us(e.ts) AS time_us, epoch_us(e.ts) / 1e6 AS time,
        CAST(floor(e.value / 10.0) AS BIGINT) AS value_bucket, c.c_mktsegment AS segment, n.n_name AS nation,
        r.r_name AS region, CAST(hour(e.ts) AS BIGINT) AS hour, CAST(dayofweek(e.ts) + 1 AS BIGINT) AS weekday
   FROM events e LEFT JOIN (customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                                       JOIN region r ON n.n_regionkey = r.r_regionkey) ON c.c_custkey = e.user_id)"""


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    t = epoch_micros("o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        t.alias("time_us"),
        (t / F.lit(MICROS)).alias("time"),
    )


BASKETS_SQL = """(SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
        epoch_us(o.o_orderdate) AS time_us, epoch_us(o.o_orderdate) / 1e6 AS time
   FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), "p_brand", "p_type", "p_size", "p_retailprice")


PRODUCTS_SQL = """(SELECT p_partkey AS item_id, p_brand, p_type, p_size, p_retailprice FROM part)"""


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        "c_custkey", "c_nationkey", "n_regionkey", "c_acctbal", "c_mktsegment")


PROFILES_SQL = """(SELECT c.c_custkey, c.c_nationkey, n.n_regionkey, c.c_acctbal, c.c_mktsegment
   FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("item_id"), F.col("embedding").alias("vec"), "label")


VECTORS_SQL = """(SELECT vec_id AS item_id, embedding AS vec, label FROM embeddings)"""


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left")


DOCS_SQL = """(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
   FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def binary_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth/score pairs for classification metrics: the label ``quality``
    against a score derived from document length."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return lab.join(d, "doc_id").select(
        "doc_id", F.col("quality").alias("y_true"),
        (F.col("n_chars") % 1000 / F.lit(1000.0)).alias("score"))


BINARY_SCORES_SQL = """(SELECT l.doc_id, l.quality AS y_true, (d.n_chars % 1000) / 1000.0 AS score
   FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
