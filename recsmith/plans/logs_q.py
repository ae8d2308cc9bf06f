"""Log, window, set and array queries (A1..A14, W1..W8, U1..U4, J1..J4,
H2..H6, P5, R4) with DuckDB twins. Array outputs are rendered as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.functions.arrays import join_ints, shifted_targets, split_last
from recsmith.functions.columns import rescale
from recsmith.operators import encode as enc
from recsmith.operators import logs as L
from recsmith.operators.similarity import cooccurrence_pairs, pair_accumulate
from recsmith.operators import chunked
from recsmith.operators.sampling import negative_sample
from recsmith.plans.ctr import negatives_sql
from recsmith.plans.recall import _sim_sql, _split_sql, recall_split
from recsmith.plans.registry import register
from recsmith.sources.fixtures import BASKETS_SQL, CLICKS_SQL, baskets, clicks, vectors

# The affine map of the click-log time column.
TIME_SCALE = 1570909091.0
TIME_SHIFT = 41152582.0

_SPLIT = _split_sql(CLICKS_SQL)
_DEDUP = f"""log0 AS {CLICKS_SQL},
dedup AS (SELECT DISTINCT user_id, item_id, time, time_us FROM log0)"""


def _train(spark, sf_dir):
    return recall_split(clicks(spark, sf_dir))[0]


def _dedup(spark, sf_dir):
    return L.dedup_exact(clicks(spark, sf_dir).select("user_id", "item_id", "time", "time_us"))


# ------------------------------------------------------------ aggregations

@register("item_stats", f"""WITH {_SPLIT}
SELECT item_id, count(*) AS clicks, count(DISTINCT user_id) AS users, min(time) AS first_seen
FROM train GROUP BY item_id""")
def q_item_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A2 + A3 in one pass on the train split."""
    return L.item_stats(_train(spark, sf_dir))


@register("item_popularity", f"WITH {_SPLIT}\nSELECT item_id, count(*) AS clicks FROM train GROUP BY item_id")
def q_item_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1."""
    return L.item_popularity(_train(spark, sf_dir))


@register("item_user_count", f"WITH {_SPLIT}\nSELECT item_id, count(DISTINCT user_id) AS users FROM train GROUP BY item_id")
def q_item_user_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2."""
    return L.item_user_count(_train(spark, sf_dir))


@register("item_first_seen", f"WITH {_SPLIT}\nSELECT item_id, min(time) AS first_seen FROM train GROUP BY item_id")
def q_item_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3."""
    return L.item_first_seen(_train(spark, sf_dir))


@register("user_sequences", f"""WITH {_SPLIT}
SELECT user_id, array_to_string(list(item_id ORDER BY time_us, item_id), ',') AS items,
       array_to_string(list(time_us ORDER BY time_us, item_id), ',') AS times, CAST(count(*) AS INT) AS n
FROM train GROUP BY user_id""")
def q_user_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + A5: time-ordered item / time lists per user."""
    s = L.user_sequences(_train(spark, sf_dir))
    return s.select("user_id", join_ints("items").alias("items"), join_ints("times").alias("times"), "n")


@register("user_activity", f"WITH {_SPLIT}\nSELECT user_id, count(*) AS n FROM train GROUP BY user_id")
def q_user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5."""
    return L.user_activity(_train(spark, sf_dir))


@register("user_click_set", f"""WITH {_DEDUP}
SELECT user_id, array_to_string(list_sort(list_distinct(list(item_id))), ',') AS items FROM dedup GROUP BY user_id""")
def q_user_click_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 (distinct variant for export)."""
    s = L.user_click_set(_dedup(spark, sf_dir), distinct=True)
    return s.select("user_id", join_ints("items").alias("items"))


@register("distinct_pairs", f"SELECT DISTINCT item_id, category FROM {CLICKS_SQL}")
def q_distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (item, category)."""
    return L.distinct_pairs(clicks(spark, sf_dir), "item_id", "category")


@register("dedup_exact", f"""WITH {_DEDUP.replace('log0 AS', 'log0 AS', 1).replace(CLICKS_SQL, BASKETS_SQL)}
SELECT user_id, item_id, time_us FROM dedup""")
def q_dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 on baskets (which do contain exact duplicates): the rows that stay."""
    return L.dedup_exact(baskets(spark, sf_dir)).select("user_id", "item_id", "time_us")


@register("median_degree", f"""WITH {_SPLIT},
pop AS (SELECT item_id, count(*) AS deg FROM train GROUP BY item_id),
ans AS (SELECT coalesce(p.deg, 0) AS deg FROM validate v LEFT JOIN pop p ON p.item_id = v.item_id)
SELECT deg AS median FROM (SELECT deg, row_number() OVER (ORDER BY deg) AS rn, count(*) OVER () AS n FROM ans)
WHERE rn = n // 2 + 1""")
def q_median_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper median of held-out item popularity over all answers."""
    train, validate, _ = recall_split(clicks(spark, sf_dir))
    pop = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("deg"))
    ans = validate.join(pop, "item_id", "left").select(F.coalesce("deg", F.lit(0)).alias("deg"))
    return L.upper_median(ans, "deg")


@register("n_unique", f"SELECT count(DISTINCT item_id) AS n_unique FROM {CLICKS_SQL}")
def q_n_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14."""
    return L.n_unique(clicks(spark, sf_dir), "item_id")


@register("pair_accumulate", f"""WITH {_SPLIT},
{_sim_sql().split(chr(10) + 'top AS')[0]}
SELECT item, relate_item, sim_ticks, cnt, weighted_ticks, min_dt, min_dloc, node, node_ticks, deep, deep_ticks FROM acc""")
def q_pair_accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 (+J3): all 9 slots for every co-occurring ordered pair, before the top-k cut."""
    train, _, _ = recall_split(clicks(spark, sf_dir))
    return pair_accumulate(cooccurrence_pairs(train, vectors(spark, sf_dir))).drop("_ci", "_cj")


# ------------------------------------------------------------ windows

@register("latest_click", f"""WITH log AS {CLICKS_SQL}
SELECT user_id, item_id, max(time_us) AS time_us, arg_max(category, time_us) AS category
FROM log GROUP BY user_id, item_id""")
def q_latest_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last click per (user, item)."""
    return L.latest_click(clicks(spark, sf_dir).select("user_id", "item_id", "time_us", "category"))


@register("click_history", f"""WITH log AS {CLICKS_SQL},
h AS (SELECT user_id, item_id, time_us,
             coalesce(list(item_id) OVER (PARTITION BY user_id ORDER BY time_us, item_id
                                          ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), []) AS hi FROM log)
SELECT user_id, item_id, time_us, array_to_string(list_resize(hi, greatest(20, len(hi)), 0), ',') AS hist
FROM h""")
def q_click_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 + H1 with n = 20 on the raw log."""
    h = L.click_history(clicks(spark, sf_dir).select("user_id", "item_id", "time_us",
                                                     F.col("item_id").cast("int").alias("item_code")),
                        {"item_code": "hist"}, n=20)
    return h.select("user_id", "item_id", "time_us", join_ints("hist").alias("hist"))


@register("leave_one_out", f"""WITH {_DEDUP}
SELECT user_id, item_id, time_us,
       CASE WHEN lead(item_id) OVER (PARTITION BY user_id ORDER BY time_us, item_id) IS NULL THEN 'test' ELSE 'train' END AS split
FROM dedup""")
def q_leave_one_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4."""
    return L.leave_one_out_split(_dedup(spark, sf_dir)).select("user_id", "item_id", "time_us", "split")


def _l2o_sql(order: str) -> str:
    return f"""WITH {_DEDUP}
SELECT user_id, item_id, time_us, CASE rn WHEN 1 THEN 'test' WHEN 2 THEN 'validate' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time_us {order}, item_id {order}) AS rn FROM dedup)"""


@register("leave_two_out_latest", _l2o_sql("DESC"))
def q_l2o_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5, documented intent: the newest click is test (Q1)."""
    return L.leave_two_out_split(_dedup(spark, sf_dir)).select("user_id", "item_id", "time_us", "split")


@register("leave_two_out_earliest", _l2o_sql("ASC"))
def q_l2o_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 as the reference codes it: the oldest click is test (Q1)."""
    return L.leave_two_out_split(_dedup(spark, sf_dir), holdout="earliest").select(
        "user_id", "item_id", "time_us", "split")


@register("time_gap", f"""WITH {_DEDUP}
SELECT * FROM (SELECT user_id, item_id, time_us,
   (lead(time) OVER (PARTITION BY user_id ORDER BY time, item_id) - time) / 3600.0::DOUBLE AS gap FROM dedup)
WHERE gap IS NOT NULL""")
def q_time_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 + P9: gap to the next click in hours; last click dropped."""
    return L.time_gap(_dedup(spark, sf_dir), scale=3600.0).select("user_id", "item_id", "time_us", "gap")


@register("rank_in_user", f"""WITH {_DEDUP},
c AS (SELECT user_id, item_id, count(*) AS clicks FROM dedup GROUP BY user_id, item_id)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY clicks DESC, item_id) AS INT) AS rank FROM c)
WHERE rank <= 3""")
def q_rank_in_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's 3 most clicked items (ties by item id)."""
    c = _dedup(spark, sf_dir).groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("clicks"))
    return L.rank_in_group(c, "user_id", "clicks", ["item_id"], k=3)


@register("sequence_position", f"""WITH {_DEDUP}
SELECT user_id, item_id, time_us,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY time_us, item_id) - 1 AS INT) AS loc,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY time_us DESC, item_id DESC) - 1 AS INT) AS recency
FROM dedup""")
def q_sequence_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0-based position ascending and descending."""
    d = L.sequence_position(_dedup(spark, sf_dir), time_col="time_us")
    d = L.sequence_position(d, time_col="time_us", desc=True, name="recency")
    return d.select("user_id", "item_id", "time_us", "loc", "recency")


@register("causal_prefix", f"""WITH {_SPLIT}
SELECT user_id, item_id, time_us, array_to_string(list(item_id) OVER (PARTITION BY user_id ORDER BY time_us, item_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), ',') AS prefix
FROM train""")
def q_causal_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: every position sees itself and the positions before it."""
    p = L.causal_prefix(_train(spark, sf_dir), "item_id")
    return p.select("user_id", "item_id", "time_us", join_ints("prefix").alias("prefix"))


# ------------------------------------------------------------ sets / joins

@register("union_logs", f"""WITH {_SPLIT}
SELECT user_id, item_id, time_us FROM train UNION ALL SELECT user_id, item_id, time_us FROM validate
  UNION ALL SELECT user_id, item_id, time_us FROM split WHERE rn = 1""")
def q_union_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train + validate + test back into one log."""
    tr, va, te = recall_split(clicks(spark, sf_dir))
    return L.union_logs(tr, va, te).select("user_id", "item_id", "time_us")


@register("union_distinct", f"""WITH {_SPLIT}
SELECT DISTINCT user_id, item_id FROM (SELECT user_id, item_id FROM train UNION ALL SELECT user_id, item_id FROM validate)""")
def q_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2."""
    tr, va, _ = recall_split(clicks(spark, sf_dir))
    return L.union_distinct(tr.select("user_id", "item_id"), va.select("user_id", "item_id"))


@register("new_values", f"""WITH b AS {BASKETS_SQL},
m AS (SELECT (min(time_us) + max(time_us)) / 2 AS mid FROM b)
SELECT DISTINCT user_id AS value FROM b
WHERE user_id NOT IN (SELECT user_id FROM b WHERE time_us < (SELECT mid FROM m))""")
def q_new_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: customers the encoding fitted on the first half of the order
    period does not know (the values an append fit would number)."""
    b = baskets(spark, sf_dir)
    mid = b.agg(((F.min("time_us") + F.max("time_us")) / 2).alias("_mid"))
    early = enc.attach_scalars(b, mid).where(F.col("time_us") < F.col("_mid"))
    state = enc.fit_encoding(early, "user_id")
    return enc.new_values(b, "user_id", state)


@register("enrich_left", f"""WITH log AS {CLICKS_SQL},
art AS (SELECT item_id, min(category) AS category FROM log GROUP BY item_id)
SELECT l.user_id, l.item_id, l.time_us, a.category FROM log l LEFT JOIN art a ON l.item_id = a.item_id""")
def q_enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join of the log with the item attribute table (Q9 min)."""
    log = clicks(spark, sf_dir)
    art = log.groupBy("item_id").agg(F.min("category").alias("category"))
    return log.select("user_id", "item_id", "time_us").join(art, "item_id", "left").select(
        "user_id", "item_id", "time_us", "category")


@register("attach_user_history", f"""WITH {_SPLIT},
h AS (SELECT user_id, array_to_string(list_sort(list(item_id)), ',') AS clicked FROM train GROUP BY user_id)
SELECT v.user_id, v.item_id, h.clicked FROM validate v LEFT JOIN h ON v.user_id = h.user_id""")
def q_attach_user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each held-out row with the user's whole clicked-item array."""
    tr, va, _ = recall_split(clicks(spark, sf_dir))
    h = L.user_click_set(tr)
    return va.join(h, "user_id", "left").select("user_id", "item_id", join_ints("items").alias("clicked"))


@register("lookup_default", f"""WITH {_SPLIT},
codes AS (SELECT item_id AS v, CAST(dense_rank() OVER (ORDER BY item_id) + 1 AS BIGINT) AS code
          FROM (SELECT DISTINCT item_id FROM train))
SELECT v.user_id, v.item_id, coalesce(c.code, 1) AS item_code FROM validate v LEFT JOIN codes c ON v.item_id = c.v""")
def q_lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value -> code with a default (1 = unknown) for unseen values."""
    tr, va, _ = recall_split(clicks(spark, sf_dir))
    st = enc.fit_encoding(tr, "item_id", is_unk=True)
    return enc.apply_encoding(va.select("user_id", "item_id"), "item_id", st, is_unk=True, out="item_code")


# ------------------------------------------------------------ sequences

@register("next_item_dataset", f"""WITH {_DEDUP},
uc AS (SELECT user_id AS v, CAST(dense_rank() OVER (ORDER BY user_id) + 1 AS BIGINT) AS code FROM (SELECT DISTINCT user_id FROM dedup)),
ic AS (SELECT item_id AS v, CAST(dense_rank() OVER (ORDER BY item_id) + 1 AS BIGINT) AS code FROM (SELECT DISTINCT item_id FROM dedup)),
e AS (SELECT uc.code AS user_id, ic.code AS item_id, d.time_us FROM dedup d JOIN uc ON d.user_id = uc.v JOIN ic ON d.item_id = ic.v),
s AS (SELECT user_id, list(item_id ORDER BY time_us, item_id) AS items FROM e GROUP BY user_id)
SELECT user_id, array_to_string(items[1:len(items) - 1], ',') AS history, items[len(items)] AS label FROM s""")
def q_next_item_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 (E1 with unk + A4 + H2): encoded, time-ordered history and the
    last item as the label."""
    d = _dedup(spark, sf_dir)
    out, _ = enc.encode_fields(d, ["user_id", "item_id"], is_unk=True)
    seq = L.user_sequences(out)
    hist, last = split_last("items")
    return seq.select("user_id", join_ints(hist).alias("history"), last.cast("int").alias("label"))


@register("shifted_targets", f"""WITH {_SPLIT},
s AS (SELECT user_id, list(item_id ORDER BY time_us, item_id) AS items FROM train GROUP BY user_id)
SELECT user_id, array_to_string(items[1:len(items) - 1], ',') AS inputs, array_to_string(items[2:len(items)], ',') AS targets
FROM s""")
def q_shifted_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: next-item training pairs (inputs 1..n-1, targets 2..n)."""
    seq = L.user_sequences(_train(spark, sf_dir))
    x, y = shifted_targets("items")
    return seq.select("user_id", join_ints(x).alias("inputs"), join_ints(y).alias("targets"))


@register("sequence_negatives", f"""WITH {_SPLIT},
rows_ AS (SELECT user_id, item_id, time_us,
                 CAST(row_number() OVER (PARTITION BY user_id ORDER BY time_us, item_id) - 1 AS INT) AS loc FROM train),
pool AS (SELECT DISTINCT item_id, 'x' AS category FROM train),
{negatives_sql('rows_', 'pool', 'train', 10, 64)}
SELECT r.user_id, r.loc, n.neg_item AS negative_item
FROM rows_ r JOIN negs n ON r.user_id = n.user_id AND r.item_id = n.item_id AND r.time_us = n.time_us""")
def q_sequence_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6: 10 non-clicked items per sequence position (N1 applied per
    position, exact remainder included)."""
    tr = _train(spark, sf_dir)
    rows = L.sequence_position(tr, time_col="time_us").select("user_id", "item_id", "time_us", "loc")
    pool = tr.select("item_id").distinct().withColumn("category", F.lit("x"))
    negs = negative_sample(rows.withColumn("category", F.lit("x")), pool, tr.select("user_id", "item_id"),
                           k=10, attempts=64)
    return negs.where(F.col("label") == 0).select("user_id", "loc", F.col("item_id").alias("negative_item"))


@register("rescale_time", f"SELECT user_id, item_id, time * {TIME_SCALE}::DOUBLE + {TIME_SHIFT}::DOUBLE AS time FROM {CLICKS_SQL}")
def q_rescale_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: affine map of the time column."""
    c = clicks(spark, sf_dir)
    return c.select("user_id", "item_id", rescale("time", TIME_SCALE, TIME_SHIFT).alias("time"))


# ------------------------------------------------------------ sequences in chunks

_CHUNK = 16
_PLACED = f"""{_SPLIT},
placed AS (SELECT user_id, item_id, time_us, row_number() OVER w - 1 AS p, count(*) OVER (PARTITION BY user_id) AS n,
                  lead(item_id) OVER w AS nxt FROM train WINDOW w AS (PARTITION BY user_id ORDER BY time_us, item_id))"""


@register("user_sequence_chunks", f"""WITH {_PLACED}
SELECT user_id, p // {_CHUNK} AS chunk, min(p) AS "offset", array_to_string(list(item_id ORDER BY p), ',') AS items,
       array_to_string(list(time_us ORDER BY p), ',') AS times, max(n) AS n FROM placed GROUP BY user_id, p // {_CHUNK}""")
def q_user_sequence_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + A5 in chunks of 16."""
    c = chunked.sequence_chunks(_train(spark, sf_dir), size=_CHUNK)
    return c.select("user_id", "chunk", "offset", join_ints("items").alias("items"), join_ints("times").alias("times"), "n")


@register("click_set_chunks", f"""WITH {_SPLIT},
placed AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY item_id) - 1 AS p
           FROM (SELECT DISTINCT user_id, item_id FROM train))
SELECT user_id, p // {_CHUNK} AS chunk, array_to_string(list(item_id ORDER BY p), ',') AS items FROM placed GROUP BY user_id, p // {_CHUNK}""")
def q_click_set_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 (distinct) in chunks of 16."""
    c = chunked.click_set_chunks(_train(spark, sf_dir), distinct=True, size=_CHUNK)
    return c.select("user_id", "chunk", join_ints("items").alias("items"))


@register("shifted_target_chunks", f"""WITH {_PLACED}
SELECT user_id, p // {_CHUNK} AS chunk, coalesce(array_to_string(list(item_id ORDER BY p) FILTER (nxt IS NOT NULL), ','), '') AS inputs,
       coalesce(array_to_string(list(nxt ORDER BY p) FILTER (nxt IS NOT NULL), ','), '') AS targets
FROM placed GROUP BY user_id, p // {_CHUNK} HAVING count(nxt) > 0 OR max(n) = 1""")
def q_shifted_target_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4 in chunks of 16, the last target from the next chunk."""
    c = chunked.shifted_target_chunks(_train(spark, sf_dir), size=_CHUNK)
    return c.select("user_id", "chunk", join_ints("inputs").alias("inputs"), join_ints("targets").alias("targets"))


@register("next_item_chunks", f"""WITH {_PLACED}
SELECT user_id, p // {_CHUNK} AS chunk, coalesce(array_to_string(list(item_id ORDER BY p) FILTER (nxt IS NOT NULL), ','), '') AS history,
       max(item_id) FILTER (p = n - 1) AS label FROM placed GROUP BY user_id, p // {_CHUNK}""")
def q_next_item_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 in chunks of 16: history, and the label in the last chunk."""
    c = chunked.next_item_chunks(_train(spark, sf_dir), size=_CHUNK)
    return c.select("user_id", "chunk", join_ints("history").alias("history"), "label")


@register("causal_prefix_parts", f"""WITH {_PLACED}
SELECT a.user_id, a.p AS loc, b.p // {_CHUNK} AS part, array_to_string(list(b.item_id ORDER BY b.p), ',') AS prefix
FROM placed a JOIN placed b ON a.user_id = b.user_id AND b.p <= a.p GROUP BY a.user_id, a.p, b.p // {_CHUNK}""")
def q_causal_prefix_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5 in parts of 16 values."""
    c = chunked.causal_prefix_parts(_train(spark, sf_dir), "item_id", size=_CHUNK)
    return c.select("user_id", "loc", "part", join_ints("prefix").alias("prefix"))


@register("history_parts", f"""WITH {_PLACED}
SELECT v.user_id, v.item_id, b.p // {_CHUNK} AS part, coalesce(array_to_string(list(b.item_id ORDER BY b.p), ','), '') AS history
FROM validate v LEFT JOIN placed b ON v.user_id = b.user_id GROUP BY v.user_id, v.item_id, v.time_us, b.p // {_CHUNK}""")
def q_history_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 in parts of 16 items: the validation clicks with their users' histories."""
    train, validate, _ = recall_split(clicks(spark, sf_dir))
    c = chunked.history_parts(validate.select("user_id", "item_id"), train, size=_CHUNK)
    return c.select("user_id", "item_id", "part", F.coalesce(join_ints("items"), F.lit("")).alias("history"))
