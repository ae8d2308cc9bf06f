"""EDA and classification-metric queries (X1, X3..X6, A9, A10) with DuckDB twins."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.operators import eda
from recsmith.plans.recall import recall_split
from recsmith.plans.registry import register
from recsmith.sources.fixtures import (
    BINARY_SCORES_SQL, CLICKS_SQL, DOCS_SQL, PRODUCTS_SQL, binary_scores, clicks, docs, products)

_PCT = eda.PERCENTILES
_PCT_LIST = "[" + ", ".join(str(p) for p in _PCT) + "]"


def _describe_sql(src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        stats = {"count": f"CAST(count({x}) AS DOUBLE)", "mean": f"avg({x})", "std": f"stddev_samp({x})",
                 "min": f"min({x})", "max": f"max({x})"}
        for name, expr in stats.items():
            parts.append(f"SELECT '{c}' AS column, '{name}' AS stat, round({expr}, 6) AS value FROM {src}")
        for i, p in enumerate(_PCT):
            parts.append(f"SELECT '{c}', 'p{round(p * 100):02d}', round(quantile_cont({x}, {_PCT_LIST})[{i + 1}], 6) "
                         f"FROM {src}")
    return "\nUNION ALL\n".join(parts)


@register("describe", _describe_sql(PRODUCTS_SQL, ["p_size", "p_retailprice"]))
def q_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, mean, std, min, max and percentiles, long form."""
    return eda.describe(products(spark, sf_dir), ["p_size", "p_retailprice"])


_DOC_TYPES = [("doc_id", "bigint"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"),
              ("quality", "int"), ("toxic", "int")]


@register("column_info", f"WITH d AS {DOCS_SQL}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, '{t}' AS type, count({c}) AS non_null FROM d" for c, t in _DOC_TYPES))
def q_column_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 header: column names, (Spark) types and non-null counts."""
    return eda.column_info(docs(spark, sf_dir))


_GAPS = f"""WITH log0 AS {CLICKS_SQL},
dedup AS (SELECT DISTINCT user_id, item_id, time, time_us FROM log0),
split AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time_us DESC, item_id DESC) AS rn FROM dedup),
train AS (SELECT * FROM split WHERE rn > 2),
g AS (SELECT (lead(time) OVER (PARTITION BY user_id ORDER BY time, item_id) - time) / 3600.0::DOUBLE AS gap FROM train),
gaps AS (SELECT gap FROM g WHERE gap IS NOT NULL)
"""


@register("gap_distribution", _GAPS + _describe_sql("gaps", ["gap"]))
def q_gap_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next-click gap in hours on the train split, described."""
    train, _, _ = recall_split(clicks(spark, sf_dir))
    return eda.gap_distribution(train)


@register("percentiles_by_group", f"""SELECT lang, source, unnest({_PCT_LIST})::DOUBLE AS prob,
       round(unnest(quantile_cont(CAST(n_chars AS DOUBLE), {_PCT_LIST})), 6) AS value FROM {DOCS_SQL} GROUP BY lang, source""")
def q_percentiles_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 per group: percentiles of the text length by language and source."""
    d = docs(spark, sf_dir).select("lang", "source", "n_chars")
    p = eda.grouped_percentiles(d, ["n_chars"], _PCT, by=["lang", "source"])
    return p.select("lang", "source", "prob", F.round("value", 6).alias("value"))


@register("value_counts", f"""WITH d AS {DOCS_SQL},
vc AS (SELECT quality, count(*) AS count FROM d GROUP BY quality)
SELECT quality, count, (SELECT count(*) FROM vc) AS n_values FROM vc""")
def q_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per value, null as its own group."""
    return eda.value_counts(docs(spark, sf_dir).select("quality"), "quality")


@register("label_contingency", f"""SELECT lang, quality, count(*) AS count FROM {DOCS_SQL} GROUP BY lang, quality""")
def q_label_contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: language x quality label, unlabelled documents included."""
    return eda.counts_by_label(docs(spark, sf_dir), "lang", "quality")


@register("binary_metrics", f"""WITH s AS {BINARY_SCORES_SQL},
c AS (SELECT sum(CASE WHEN score > 0.5 AND y_true = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN score > 0.5 AND y_true = 0 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN score <= 0.5 AND y_true = 1 THEN 1 ELSE 0 END) AS fn,
             count(*) AS n,
             sum(CASE WHEN CAST(score > 0.5 AS INT) = y_true THEN 1 ELSE 0 END) AS correct FROM s),
m AS (SELECT *, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS prec, CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS rec FROM c)
SELECT round(CAST(correct AS DOUBLE) / n, 6) AS accuracy, round(prec, 6) AS precision, round(rec, 6) AS recall,
       round(2 * prec * rec / nullif(prec + rec, 0), 6) AS f1 FROM m""")
def q_binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy / precision / recall / F1 at 0.5."""
    return eda.binary_metrics(binary_scores(spark, sf_dir), "y_true", "score")


_SQRT2PI = repr(math.sqrt(2.0 * math.pi))


@register("kde_by_category", f"""WITH p AS (SELECT p_type, CAST(p_retailprice AS DOUBLE) AS x FROM {PRODUCTS_SQL}
                                           WHERE p_retailprice IS NOT NULL),
st AS (SELECT p_type, count(x) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx FROM p GROUP BY p_type),
st2 AS (SELECT *, pow(CAST(n AS DOUBLE), -0.2) * sd AS h, mn - (mx - mn) * 0.5 AS lo,
               (mx - mn) * 2.0 / {float(eda.KDE_GRID - 1)} AS step FROM st),
grid AS (SELECT st2.*, g.g FROM st2 CROSS JOIN range({eda.KDE_GRID}) AS g(g)),
dens AS (SELECT grid.p_type, grid.g, grid.lo, grid.step, grid.n, grid.h,
                sum(exp(-0.5 * ((grid.lo + grid.g * grid.step - p.x) / grid.h) * ((grid.lo + grid.g * grid.step - p.x) / grid.h))) AS s
         FROM grid JOIN p ON p.p_type IS NOT DISTINCT FROM grid.p_type
         GROUP BY ALL)
SELECT p_type, CAST(g AS INT) AS grid_idx, round(lo + g * step, 6) AS x, CASE WHEN h > 0 THEN round(s / (n * h * {_SQRT2PI}), 6) END AS density
FROM dens""")
def q_kde(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density of retail price per part type on a 1000-point grid."""
    return eda.kde_by_category(products(spark, sf_dir), "p_retailprice", "p_type")


def _corr_sql() -> str:
    fields = ["p_size", "p_retailprice", "p_brand", "p_type"]
    base = f"""WITH p AS (SELECT CAST(p_size AS DOUBLE) AS p_size, p_retailprice,
   CAST(dense_rank() OVER (ORDER BY p_brand NULLS FIRST) - 1 AS DOUBLE) AS p_brand,
   CAST(dense_rank() OVER (ORDER BY p_type NULLS FIRST) - 1 AS DOUBLE) AS p_type FROM {PRODUCTS_SQL})
"""
    parts = []
    for i, a in enumerate(fields):
        for b in fields[i:]:
            parts.append(f"SELECT '{a}' AS field_a, '{b}' AS field_b, round(abs(corr({a}, {b})), 6) AS abs_corr FROM p")
            if a != b:
                parts.append(f"SELECT '{b}', '{a}', round(abs(corr({a}, {b})), 6) FROM p")
    return base + "\nUNION ALL\n".join(parts)


@register("corr_matrix", _corr_sql())
def q_corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 (+E8): absolute Pearson correlations, categorical fields label-encoded."""
    p = products(spark, sf_dir)
    return eda.abs_correlation_matrix(p, ["p_size", "p_retailprice", "p_brand", "p_type"],
                                      categorical=["p_brand", "p_type"])


