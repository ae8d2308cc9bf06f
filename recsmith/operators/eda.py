"""Exploratory statistics and classification metrics (X1, X3..X6, A9, A10).

Charts in the reference become long result tables. Everything is one or
two aggregation passes; percentiles are exact (linear interpolation), by
radix selection over all columns and groups together.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.operators.encode import attach_scalars, dense_ids
from recsmith.operators.radix import grouped_percentiles

# The percentiles the reference's describe prints.
PERCENTILES = [0.01, 0.05, 0.10, 0.25, 0.5, 0.75, 0.90, 0.95, 0.99]
KDE_GRID = 1000
KDE_CUTOFF = 40.0   # |z| beyond this: exp(-z^2/2) is exactly 0.0 in doubles


def exact_percentiles(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """Exact percentiles with linear interpolation (position p*(n-1)) by radix
    selection. Returns (prob, value), null values if there are none."""
    spec = df.sparkSession.createDataFrame([(float(p),) for p in probs], "prob double")
    return spec.join(grouped_percentiles(df, [col], probs).select("prob", "value"), "prob", "left")


def describe(df: DataFrame, cols: list[str], percentiles: list[float] = PERCENTILES) -> DataFrame:
    """Long table (column, stat, value): non-null count, mean, sample
    std, min, max (one aggregation pass) and exact percentiles of all columns
    together (radix selection, see ``operators/radix.py``)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"{c}|count"), F.avg(x).alias(f"{c}|mean"),
                 F.stddev_samp(x).alias(f"{c}|std"), F.min(x).alias(f"{c}|min"), F.max(x).alias(f"{c}|max")]
    wide = df.agg(*aggs)
    rows = []
    for c in cols:
        for s in ("count", "mean", "std", "min", "max"):
            rows.append(F.struct(F.lit(c).alias("column"), F.lit(s).alias("stat"), F.col(f"`{c}|{s}`").alias("value")))
    out = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    names = {float(p): f"p{round(p * 100):02d}" for p in percentiles}
    label = F.create_map(*[x for p, nm in names.items() for x in (F.lit(p), F.lit(nm))])
    asked = df.sparkSession.createDataFrame([(c, float(p)) for c in cols for p in percentiles], "column string, prob double")
    pct = asked.join(grouped_percentiles(df, cols, percentiles), ["column", "prob"], "left")
    out = out.unionByName(pct.select("column", label[F.col("prob")].alias("stat"), "value"))
    return out.withColumn("value", F.round("value", 6))


def column_info(df: DataFrame) -> DataFrame:
    """X3 header: column names, types and non-null counts."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"`{c}`").alias("non_null"))
            for c, t in df.dtypes]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def value_counts(df: DataFrame, field: str) -> DataFrame:
    """Count per value (null is a group) and the number of distinct
    values (nulls included) on every row."""
    vc = df.groupBy(field).agg(F.count(F.lit(1)).alias("count"))
    nd = vc.agg(F.count(F.lit(1)).alias("n_values"))
    return attach_scalars(vc, nd)


def counts_by_label(df: DataFrame, field: str, label: str) -> DataFrame:
    """A10: value x label contingency, one row per (value, label value) that
    occurs; nulls on either side are values of their own."""
    return df.groupBy(field, label).agg(F.count(F.lit(1)).alias("count"))


def binary_metrics(df: DataFrame, y_true: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall and F1 with prediction ``score > t``."""
    pred = (F.col(score) > F.lit(threshold)).cast("int")
    t = F.col(y_true)
    agg = df.agg(F.sum(((pred == 1) & (t == 1)).cast("int")).alias("tp"),
                 F.sum(((pred == 1) & (t == 0)).cast("int")).alias("fp"),
                 F.sum(((pred == 0) & (t == 1)).cast("int")).alias("fn"),
                 F.count(F.lit(1)).alias("n"),
                 F.sum((pred == t).cast("int")).alias("correct"))
    prec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    rec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    f1 = F.try_divide(2 * prec * rec, prec + rec)
    return agg.select(F.round(F.col("correct") / F.col("n"), 6).alias("accuracy"),
                      F.round(prec, 6).alias("precision"), F.round(rec, 6).alias("recall"),
                      F.round(f1, 6).alias("f1"))


def kde_by_category(df: DataFrame, field: str, category: str, grid: int = KDE_GRID) -> DataFrame:
    """Gaussian kernel density of ``field`` per ``category`` (null is a
    category) on ``grid`` points spanning [min - range/2, max + range/2] (the
    pandas default), Scott bandwidth ``h = n^(-1/5) * stddev_samp``.

    Every category gets all its grid points. Equal values are counted first
    and enter once with their weight; where the kernel is exactly 0.0 in double
    precision (more than ``KDE_CUTOFF`` bandwidths away) nothing is added, and
    a grid point that nothing reaches has density 0. A category of one value
    has no bandwidth: its density is null."""
    x = F.col(field).cast("double")
    values = (df.select(F.col(category).alias("_cat"), x.alias("_x")).where(F.col("_x").isNotNull())
              .groupBy("_cat", "_x").agg(F.count(F.lit(1)).alias("_w")))
    st = df.where(x.isNotNull()).groupBy(F.col(category).alias("_c")).agg(
        F.count(x).alias("_n"), F.stddev_samp(x).alias("_sd"), F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    st = (st.withColumn("_h", F.pow(F.col("_n").cast("double"), F.lit(-0.2)) * F.col("_sd"))
          .withColumn("_lo", F.col("_mn") - (F.col("_mx") - F.col("_mn")) * F.lit(0.5))
          .withColumn("_step", (F.col("_mx") - F.col("_mn")) * F.lit(2.0) / F.lit(float(grid - 1))))
    pts = values.join(st.where((F.col("_h") > 0) & (F.col("_step") > 0)), F.col("_cat").eqNullSafe(F.col("_c")))
    first = F.greatest(F.lit(0), F.ceil((F.col("_x") - F.lit(KDE_CUTOFF) * F.col("_h") - F.col("_lo")) / F.col("_step")))
    last = F.least(F.lit(grid - 1), F.floor((F.col("_x") + F.lit(KDE_CUTOFF) * F.col("_h") - F.col("_lo")) / F.col("_step")))
    pts = pts.withColumn("_g", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    z = (F.col("_lo") + F.col("_g") * F.col("_step") - F.col("_x")) / F.col("_h")
    sums = pts.groupBy(F.col("_cat").alias("_sc"), F.col("_g").alias("_sg")).agg(
        F.sum(F.col("_w") * F.exp(F.lit(-0.5) * z * z)).alias("_s"))
    points = st.withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    dens = points.join(sums, F.col("_c").eqNullSafe(F.col("_sc")) & (F.col("_g") == F.col("_sg")), "left")
    norm = F.col("_n") * F.col("_h") * F.lit(math.sqrt(2.0 * math.pi))
    density = F.when(F.col("_h") > 0, F.coalesce("_s", F.lit(0.0)) / norm)
    return dens.select(F.col("_c").alias(category), F.col("_g").cast("int").alias("grid_idx"),
                       F.round(F.col("_lo") + F.col("_g") * F.col("_step"), 6).alias("x"),
                       F.round(density, 6).alias("density"))


def abs_correlation_matrix(df: DataFrame, fields: list[str], categorical: list[str] = ()) -> DataFrame:
    """Label-encode the categorical fields (E8), then the absolute
    Pearson correlation of every pair, long form (one aggregation pass)."""
    enc = df
    for c in categorical:
        codes = dense_ids(df, c, start=0, name=f"_le_{c}")
        enc = enc.join(codes, enc[c].eqNullSafe(codes[c]), "left").drop(codes[c]).drop(c) \
            .withColumnRenamed(f"_le_{c}", c)
    aggs, names = [], []
    for i, a in enumerate(fields):
        for b in fields[i:]:
            aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}"))
            names.append((a, b))
    wide = enc.agg(*aggs)
    rows = []
    for a, b in names:
        v = F.round(F.abs(F.col(f"`{a}|{b}`")), 6)
        rows.append(F.struct(F.lit(a).alias("field_a"), F.lit(b).alias("field_b"), v.alias("abs_corr")))
        if a != b:
            rows.append(F.struct(F.lit(b).alias("field_a"), F.lit(a).alias("field_b"), v.alias("abs_corr")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def gap_distribution(log: DataFrame, user: str = "user_id", item: str = "item_id", time_col: str = "time",
                     scale: float = 3600.0) -> DataFrame:
    """W6 (next-click gap, in hours) then X3."""
    from recsmith.operators.logs import time_gap
    gaps = time_gap(log, user, item, time_col, scale=scale, name="gap")
    return describe(gaps, ["gap"])

