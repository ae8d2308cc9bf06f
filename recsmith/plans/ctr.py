"""R5 — CTR training rows (the flagship pipeline) and its pieces.

clicks -> J1 item attributes -> W1 latest click per (user, item)
       -> E2 stable codes -> W2/W3 previous-20 histories, H1 padding,
          W4 last click = test -> N1 four negatives per train row -> P1.

No collect of rows and no Python UDF. The per-user windows share a single
sort; the negatives are drawn by hashing. Building the plan runs jobs of its
own: the number ranges of the three code tables, the encoded log, the feature
rows and the accepted draws are written once (reliable checkpoints), so each
is computed once and survives the loss of an executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.functions.arrays import join_ints
from recsmith.operators.encode import apply_encoding, fit_encodings
from recsmith.operators.logs import click_history, latest_click
from recsmith.operators.sampling import negative_sample
from recsmith.plans.registry import register
from recsmith.session import cut_lineage
from recsmith.sources.fixtures import CLICKS_CONTEXT_SQL, CLICKS_SQL, CONTEXT, clicks_with_context

def ctr_training_set(log: DataFrame, k: int = 4, hist_len: int = 20, attempts: int = 32,
                     states: dict | None = None, context: tuple[str, ...] = ()) -> tuple[DataFrame, dict]:
    """R5. ``log`` has (user_id, item_id, category, time_us) and the
    ``context`` columns of a click, which are carried through W1, encoded
    like the other fields (E2) and kept by a row's negatives (N1). Returns
    the labelled rows (train with negatives + test positives) and the fitted
    encoding states."""
    articles = log.groupBy("item_id").agg(F.min("category").alias("category"))        # Q9
    enriched = (log.select("user_id", "item_id", "time_us", *context)
                .join(articles, "item_id", "left"))                                    # J1
    latest = latest_click(enriched, ("user_id", "item_id"), "time_us")                 # W1
    states = fit_encodings(latest, ["user_id", "item_id", "category", *context], states)   # E2 fit
    # item and category codes (small states) before the history window; the
    # window runs per *raw* user so the user-code join afterwards reuses its
    # partitioning instead of shuffling the log again (codes ascend with the
    # raw id, so every order is unchanged)
    pre = latest
    for f in ("item_id", "category", *context):
        pre = apply_encoding(pre, f, states[f])
    pre = cut_lineage(pre)
    feats = click_history(pre, {"item_id": "hist_items", "category": "hist_cats"}, n=hist_len,
                          with_split=True)                                             # W2 W3 H1 W4
    feats = apply_encoding(feats, "user_id", states["user_id"])                        # E2 apply
    # train rows feed four branches of the sampler: one sort, one write
    feats = cut_lineage(feats)
    enc = feats.select("user_id", "item_id", "category", "time_us")
    train = feats.where(F.col("split") == "train").drop("split")
    test = feats.where(F.col("split") == "test").drop("split").withColumn("label", F.lit(1))  # P7
    pool = enc.select("item_id", "category").distinct()                                # A11
    labelled = negative_sample(train, pool, enc.select("user_id", "item_id"), k=k, attempts=attempts,
                               distinct_rows=True)  # W1 leaves one row a user and item
    out = (labelled.withColumn("split", F.lit("train"))
           .unionByName(test.withColumn("split", F.lit("test"))))
    return out, states


def select_ctr_fields(df: DataFrame, context: tuple[str, ...] = ()) -> DataFrame:
    """Keep the CTR fields in order (arrays rendered as text)."""
    return df.select("user_id", "item_id", "category", *context,
                     join_ints("hist_items").alias("hist_items"),
                     join_ints("hist_cats").alias("hist_cats"), "label", "split")


def _dense_sql(src: str, col: str, start: int = 1) -> str:
    return (f"(SELECT {col} AS v, CAST(dense_rank() OVER (ORDER BY {col} NULLS FIRST) + {start - 1} AS BIGINT) AS code "
            f"FROM (SELECT DISTINCT {col} FROM {src}))")


def _hash_sql(*parts: str) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8)) AS BIGINT)"


def ctr_sql(log: str = CLICKS_SQL, context: tuple[str, ...] = ()) -> str:
    """DuckDB twin of R5 with the given context columns."""
    def each(form: str) -> str:
        return "".join(form.format(c=c) for c in context)

    codes = "".join(f"\nx_{c} AS {_dense_sql('latest', c)}," for c in context)
    return f"""
WITH log AS {log},
articles AS (SELECT item_id, min(category) AS category FROM log GROUP BY item_id),
enriched AS (SELECT l.user_id, l.item_id, l.time_us, a.category{each(', l.{c}')} FROM log l LEFT JOIN articles a ON l.item_id = a.item_id),
latest AS (SELECT user_id, item_id, max(time_us) AS time_us, arg_max(category, time_us) AS category{each(', arg_max_null({c}, time_us) AS {c}')}
           FROM enriched GROUP BY user_id, item_id),
uc AS {_dense_sql('latest', 'user_id')},
ic AS {_dense_sql('latest', 'item_id')},
cc AS {_dense_sql('latest', 'category')},{codes}
enc AS (SELECT uc.code AS user_id, ic.code AS item_id, cc.code AS category, l.time_us{each(', x_{c}.code AS {c}')}
        FROM latest l JOIN uc ON l.user_id IS NOT DISTINCT FROM uc.v
                      JOIN ic ON l.item_id IS NOT DISTINCT FROM ic.v
                      JOIN cc ON l.category IS NOT DISTINCT FROM cc.v{each(' JOIN x_{c} ON l.{c} IS NOT DISTINCT FROM x_{c}.v')}),
feats0 AS (SELECT *, coalesce(list(item_id) OVER w20, []) AS hi, coalesce(list(category) OVER w20, []) AS hc,
                  (lead(item_id) OVER w) IS NULL AS is_test
           FROM enc
           WINDOW w AS (PARTITION BY user_id ORDER BY time_us, item_id),
                  w20 AS (PARTITION BY user_id ORDER BY time_us, item_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
feats AS (SELECT user_id, item_id, category, time_us, is_test{each(', {c}')},
                 array_to_string(list_resize(hi, greatest(20, len(hi)), 0), ',') AS hist_items,
                 array_to_string(list_resize(hc, greatest(20, len(hc)), 0), ',') AS hist_cats
          FROM feats0),
train AS (SELECT * FROM feats WHERE NOT is_test),
pool_ix AS (SELECT item_id, category, CAST(row_number() OVER (ORDER BY item_id) - 1 AS BIGINT) AS pidx
            FROM (SELECT DISTINCT item_id, category FROM enc)),
npool AS (SELECT count(*) AS n FROM pool_ix),
att AS (SELECT t.user_id, t.item_id, t.time_us, a.a,
               {_hash_sql('t.user_id', 't.item_id', 't.time_us', 'a.a')} % (SELECT n FROM npool) AS pidx
        FROM train t CROSS JOIN range(32) AS a(a)),
cand AS (SELECT att.user_id, att.item_id, att.time_us, att.a, p.item_id AS neg_item, p.category AS neg_cat
         FROM att JOIN pool_ix p ON att.pidx = p.pidx
         WHERE NOT EXISTS (SELECT 1 FROM enc h WHERE h.user_id = att.user_id AND h.item_id = p.item_id)),
firstk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id, time_us ORDER BY a) - 1 AS j
                          FROM cand) WHERE j < 4),
got AS (SELECT user_id, item_id, time_us, count(*) AS got FROM firstk GROUP BY user_id, item_id, time_us),
short AS (SELECT t.user_id, t.item_id, t.time_us, coalesce(g.got, 0) AS got
          FROM train t LEFT JOIN got g ON t.user_id = g.user_id AND t.item_id = g.item_id AND t.time_us = g.time_us
          WHERE coalesce(g.got, 0) < 4),
h_ix AS (SELECT DISTINCT h.user_id, p.pidx FROM enc h JOIN pool_ix p ON h.item_id = p.item_id
         WHERE h.user_id IN (SELECT user_id FROM short)),
gaps0 AS (SELECT user_id, coalesce(lag(pidx) OVER (PARTITION BY user_id ORDER BY pidx), -1) + 1 AS gs,
                 pidx - coalesce(lag(pidx) OVER (PARTITION BY user_id ORDER BY pidx), -1) - 1 AS gl FROM h_ix
          UNION ALL
          SELECT user_id, max(pidx) + 1 AS gs, (SELECT n FROM npool) - max(pidx) - 1 AS gl FROM h_ix GROUP BY user_id),
gaps AS (SELECT user_id, gs, gl, sum(gl) OVER (PARTITION BY user_id ORDER BY gs ROWS UNBOUNDED PRECEDING) AS ce
         FROM gaps0 WHERE gl > 0),
sizes AS (SELECT user_id, max(ce) AS c FROM gaps GROUP BY user_id),
need AS (SELECT s.user_id, s.item_id, s.time_us, j.j FROM short s CROSS JOIN range(4) AS j(j) WHERE j.j >= s.got),
draw AS (SELECT n.*, {_hash_sql('n.user_id', 'n.item_id', 'n.time_us', "'x'", 'n.j')} % z.c AS r
         FROM need n JOIN sizes z ON n.user_id = z.user_id),
rest AS (SELECT d.user_id, d.item_id, d.time_us, d.j, p.item_id AS neg_item, p.category AS neg_cat
         FROM draw d JOIN gaps g ON d.user_id = g.user_id AND d.r >= g.ce - g.gl AND d.r < g.ce
         JOIN pool_ix p ON p.pidx = g.gs + d.r - (g.ce - g.gl)),
negs AS (SELECT user_id, item_id, time_us, neg_item, neg_cat FROM firstk
         UNION ALL SELECT user_id, item_id, time_us, neg_item, neg_cat FROM rest)
SELECT t.user_id, n.neg_item AS item_id, n.neg_cat AS category{each(', t.{c}')}, t.hist_items, t.hist_cats, 0 AS label, 'train' AS split
  FROM train t JOIN negs n ON t.user_id = n.user_id AND t.item_id = n.item_id AND t.time_us = n.time_us
UNION ALL
SELECT user_id, item_id, category{each(', {c}')}, hist_items, hist_cats, 1 AS label, 'train' AS split FROM train
UNION ALL
SELECT user_id, item_id, category{each(', {c}')}, hist_items, hist_cats, 1 AS label, 'test' AS split FROM feats WHERE is_test
"""


CTR_SQL = ctr_sql()


def negatives_sql(rows: str, pool: str, hist: str, k: int, attempts: int) -> str:
    """DuckDB CTE chain of N1 (same draws as ``negative_sample``): ends
    with ``negs(user_id, item_id, time_us, neg_item, neg_cat)``."""
    return f"""pool_ix AS (SELECT item_id, category, CAST(row_number() OVER (ORDER BY item_id) - 1 AS BIGINT) AS pidx
            FROM (SELECT DISTINCT item_id, category FROM {pool})),
npool AS (SELECT count(*) AS n FROM pool_ix),
att AS (SELECT t.user_id, t.item_id, t.time_us, a.a,
               {_hash_sql('t.user_id', 't.item_id', 't.time_us', 'a.a')} % (SELECT n FROM npool) AS pidx
        FROM {rows} t CROSS JOIN range({attempts}) AS a(a)),
cand AS (SELECT att.user_id, att.item_id, att.time_us, att.a, p.item_id AS neg_item, p.category AS neg_cat
         FROM att JOIN pool_ix p ON att.pidx = p.pidx
         WHERE NOT EXISTS (SELECT 1 FROM {hist} h WHERE h.user_id = att.user_id AND h.item_id = p.item_id)),
firstk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id, time_us ORDER BY a) - 1 AS j
                          FROM cand) WHERE j < {k}),
got AS (SELECT user_id, item_id, time_us, count(*) AS got FROM firstk GROUP BY user_id, item_id, time_us),
short AS (SELECT t.user_id, t.item_id, t.time_us, coalesce(g.got, 0) AS got
          FROM {rows} t LEFT JOIN got g ON t.user_id = g.user_id AND t.item_id = g.item_id AND t.time_us = g.time_us
          WHERE coalesce(g.got, 0) < {k}),
h_ix AS (SELECT DISTINCT h.user_id, p.pidx FROM {hist} h JOIN pool_ix p ON h.item_id = p.item_id
         WHERE h.user_id IN (SELECT user_id FROM short)),
gaps0 AS (SELECT user_id, coalesce(lag(pidx) OVER (PARTITION BY user_id ORDER BY pidx), -1) + 1 AS gs,
                 pidx - coalesce(lag(pidx) OVER (PARTITION BY user_id ORDER BY pidx), -1) - 1 AS gl FROM h_ix
          UNION ALL
          SELECT user_id, max(pidx) + 1 AS gs, (SELECT n FROM npool) - max(pidx) - 1 AS gl FROM h_ix GROUP BY user_id),
gaps AS (SELECT user_id, gs, gl, sum(gl) OVER (PARTITION BY user_id ORDER BY gs ROWS UNBOUNDED PRECEDING) AS ce
         FROM gaps0 WHERE gl > 0),
sizes AS (SELECT user_id, max(ce) AS c FROM gaps GROUP BY user_id),
need AS (SELECT s.user_id, s.item_id, s.time_us, j.j FROM short s CROSS JOIN range({k}) AS j(j) WHERE j.j >= s.got),
draw AS (SELECT n.*, {_hash_sql('n.user_id', 'n.item_id', 'n.time_us', "'x'", 'n.j')} % z.c AS r
         FROM need n JOIN sizes z ON n.user_id = z.user_id),
rest AS (SELECT d.user_id, d.item_id, d.time_us, d.j, p.item_id AS neg_item, p.category AS neg_cat
         FROM draw d JOIN gaps g ON d.user_id = g.user_id AND d.r >= g.ce - g.gl AND d.r < g.ce
         JOIN pool_ix p ON p.pidx = g.gs + d.r - (g.ce - g.gl)),
negs AS (SELECT user_id, item_id, time_us, neg_item, neg_cat FROM firstk
         UNION ALL SELECT user_id, item_id, time_us, neg_item, neg_cat FROM rest)"""


@register("ctr_training_set", ctr_sql(CLICKS_CONTEXT_SQL, CONTEXT))
def q_ctr_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 with six context fields: nine encoded fields in all."""
    out, _ = ctr_training_set(clicks_with_context(spark, sf_dir), context=CONTEXT)
    return select_ctr_fields(out, CONTEXT)
