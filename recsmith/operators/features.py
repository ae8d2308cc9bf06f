"""Feature engineering with explicit fit/apply state (E4..E7, E9..E13, P2, P4).

``fit_*`` returns a small state DataFrame (or a value list that defines
output columns); ``apply_*`` is a pure DataFrame transformation that joins
or attaches that state. Fitting on train and applying to test is the
reference's ``is_train`` contract; states persist as Parquet (E9).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.functions.columns import uniform01
from recsmith.operators.encode import attach_scalars, dense_ids

#: Values that become columns of their own; wider fields are encoded as
#: sparse vectors (``one_hot_sparse``).
MAX_ONE_HOT_COLUMNS = 1_000
#: Bytes of rows that one task of a forest holds and reads in every pass; a
#: row there has one 4-byte draw for each tree.
FOREST_TASK_BYTES = 32_000_000


# ------------------------------------------------------------------ E4

def fit_one_hot(df: DataFrame, field: str, max_columns: int = MAX_ONE_HOT_COLUMNS) -> list:
    """E4 fit: the sorted distinct train values of ``field``. The list
    becomes output columns, so it is checked against ``max_columns``; wider
    fields take ``fit_one_hot_sparse``, which has no limit."""
    values = df.select(field).distinct().orderBy(F.col(field).asc_nulls_first()).limit(max_columns + 1)
    vals = [r[0] for r in values.collect()]
    if len(vals) > max_columns:
        raise ValueError(f"{field} has more than {max_columns} values; use fit_one_hot_sparse")
    return vals


def apply_one_hot(df: DataFrame, field: str, values: list, keep_source: bool = False) -> DataFrame:
    """E4 apply: one 0/1 column ``field_value`` per fitted value; values the
    fit did not see get all zeros, fitted values absent from ``df`` still get
    their column (always aligned to the fit, Q5)."""
    cols = [F.col(field).eqNullSafe(F.lit(v)).cast("int").alias(f"{field}_{v}") for v in values]
    out = df.select("*", *cols)
    return out if keep_source else out.drop(field)


def fit_one_hot_sparse(df: DataFrame, field: str) -> DataFrame:
    """E4 fit for any number of values: a table (value, id) with ids from 0 in
    ascending order of the values, nulls first. Nothing is collected."""
    return dense_ids(df.select(F.col(field).alias("value")), "value", start=0)


def apply_one_hot_sparse(df: DataFrame, field: str, state: DataFrame, out: str | None = None) -> DataFrame:
    """E4 apply for any number of values: ``out`` is the place of the 1 as a
    sparse row (array of indices, empty for values the fit did not see)."""
    out = out or f"{field}_ones"
    st = state.select(F.col("value").alias("_oh_v"), F.col("id").alias("_oh_id"))
    ones = F.when(F.col("_oh_id").isNull(), F.array().cast("array<bigint>")).otherwise(F.array("_oh_id"))
    return (df.join(st, df[field].eqNullSafe(st["_oh_v"]), "left")
            .select(*[F.col(c) for c in df.columns], ones.alias(out)))


# ------------------------------------------------------------------ E5

def fit_standard_scale(df: DataFrame, fields: list[str]) -> DataFrame:
    """E5 fit: per-field mean and population std (one row; Q7 per field)."""
    aggs = []
    for f in fields:
        aggs += [F.avg(f).alias(f"{f}__mean"), F.stddev_pop(f).alias(f"{f}__std")]
    return df.agg(*aggs)


def apply_standard_scale(df: DataFrame, fields: list[str], state: DataFrame) -> DataFrame:
    """E5 apply: ``(x - mean) / std`` (std 0 -> 0, like a constant column)."""
    j = attach_scalars(df, state)
    out = j
    for f in fields:
        std = F.col(f"{f}__std")
        out = out.withColumn(f, F.when(std == 0, F.lit(0.0)).otherwise((F.col(f) - F.col(f"{f}__mean")) / std))
    return out.select(*df.columns)


# ------------------------------------------------------------------ E6 / F12

def fit_count_binarize(df: DataFrame, field: str) -> DataFrame:
    """E6 fit: train count per value."""
    return df.groupBy(F.col(field).alias("_cb_v")).agg(F.count(F.lit(1)).alias("_cb_n"))


def apply_count_binarize(df: DataFrame, field: str, state: DataFrame, min_count: int,
                         out: str | None = None) -> DataFrame:
    """E6 apply: 1 if the value's train count >= ``min_count``; unseen -> 0 (Q6)."""
    out = out or field
    j = df.join(state, df[field].eqNullSafe(state["_cb_v"]), "left")
    flag = (F.coalesce(F.col("_cb_n"), F.lit(0)) >= F.lit(min_count)).cast("int")
    cols = [flag.alias(out) if c == out else F.col(c) for c in df.columns]
    if out not in df.columns:
        cols.append(flag.alias(out))
    return j.select(*cols)


# ------------------------------------------------------------------ P2 / P4

def drop_and_rename(df: DataFrame, drop: list[str], rename: dict[str, str]) -> DataFrame:
    """P2."""
    out = df.drop(*drop)
    for a, b in rename.items():
        out = out.withColumnRenamed(a, b)
    return out


def fill_zero(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Remaining nulls -> 0 (numeric columns)."""
    return df.na.fill(0, subset=cols) if cols else df.na.fill(0)


# ------------------------------------------------------------------ E7

def fit_model_fill(df: DataFrame, field: str, features: list[str], mode: str = "regression",
                   num_trees: int = 500, seed: int = 39, max_depth: int = 5):
    """E7 fit: random forest on rows where ``field`` is present; feature
    nulls -> 0. Returns a fitted ``PipelineModel``. The forest keeps its rows in
    the tasks they come in, each with its draws for all trees: the narrow rows
    that adaptive execution put in one task are dealt over more, by that size."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    train = fill_zero(df.where(F.col(field).isNotNull()), features)
    asm = VectorAssembler(inputCols=features, outputCol="_mf_x", handleInvalid="keep")
    label = F.col(field).cast("double")
    train = train.withColumn("_mf_y", label)
    row_bytes = 4 * num_trees + 8 * len(features) + 64
    tasks = math.ceil(train.count() * row_bytes / FOREST_TASK_BYTES)
    if tasks > 1:
        train = train.repartition(tasks)
    est_cls = RandomForestRegressor if mode == "regression" else RandomForestClassifier
    est = est_cls(featuresCol="_mf_x", labelCol="_mf_y", predictionCol="_mf_pred", numTrees=num_trees,
                  seed=seed, maxDepth=max_depth)
    return Pipeline(stages=[asm, est]).fit(train)


def apply_model_fill(df: DataFrame, field: str, features: list[str], model) -> DataFrame:
    """E7 apply: replace nulls of ``field`` by the model's prediction;
    present values are unchanged."""
    x = fill_zero(df.select("*", *[F.col(f).alias(f"_mf_{f}") for f in features]), [f"_mf_{f}" for f in features])
    renamed = x
    for f in features:
        renamed = renamed.drop(f).withColumnRenamed(f"_mf_{f}", f)
    scored = model.transform(renamed)
    cast_to = dict(df.dtypes)[field]
    filled = F.coalesce(F.col(field), F.col("_mf_pred").cast(cast_to))
    return scored.withColumn(field, filled).select(*df.columns)


# ------------------------------------------------------------------ E9 / S9

def save_state(df: DataFrame, path: str) -> None:
    """Persist one fitted state table."""
    df.write.mode("overwrite").parquet(path)


def load_state(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def encoding_table(states: dict[str, DataFrame]) -> DataFrame:
    """All encoding states as one ``(field, value string, id)`` table."""
    out = None
    for field, st in states.items():
        part = st.select(F.lit(field).alias("field"), F.col("value").cast("string").alias("value"),
                         F.col("id").alias("id"))
        out = part if out is None else out.unionByName(part)
    return out


def load_encodings(spark, path: str, fields: list[str] | str | None = None) -> DataFrame:
    """One field, a list, or all; a missing field simply has no rows."""
    enc = spark.read.parquet(path)
    if fields is None:
        return enc
    if isinstance(fields, str):
        fields = [fields]
    return enc.where(F.col("field").isin(fields))


# ------------------------------------------------------------------ E10..E13

def embedding_lookup(df: DataFrame, code: str, table: DataFrame, id_col: str = "id", vec_col: str = "vec",
                     out: str = "emb") -> DataFrame:
    """Code -> vector; unseen codes take the vector of id 0 (padding)."""
    t = table.select(F.col(id_col).alias("_el_id"), F.col(vec_col).alias("_el_vec"))
    zero = t.where(F.col("_el_id") == 0).select(F.col("_el_vec").alias("_el_zero"))
    j = df.join(t, df[code] == t["_el_id"], "left")
    j = attach_scalars_left(j, zero.limit(1))
    return j.withColumn(out, F.coalesce(F.col("_el_vec"), F.col("_el_zero"))).drop("_el_id", "_el_vec", "_el_zero")


def attach_scalars_left(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Like ``attach_scalars`` but keeps rows when the one-row frame is empty."""
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one", "left")
            .drop("_one"))


def assemble_features(df: DataFrame, dense: list[str], vectors: list[str], out: str = "features") -> DataFrame:
    """Dense values followed by field vectors, as one double array."""
    parts = [F.array(*[F.col(d).cast("double") for d in dense])] if dense else []
    parts += [F.transform(F.col(v), lambda x: x.cast("double")) for v in vectors]
    return df.withColumn(out, F.concat(*parts) if len(parts) > 1 else parts[0])


def derived_weights(states: dict[str, DataFrame], name: str = "w") -> DataFrame:
    """Deterministic per-(field, code) weights in [-1, 1) — a stand-in for
    trained weights, derived from the fitted codes (md5 of field and code)."""
    out = None
    for field, st in states.items():
        part = st.select(F.lit(field).alias("field"), F.col("id").alias("code"),
                         (uniform01(F.lit(field), F.col("id"), F.lit(name)) * 2 - 1).alias("weight"))
        out = part if out is None else out.unionByName(part)
    return out


def linear_logit(df: DataFrame, key: list[str], fields: list[str], weights: DataFrame,
                 out: str = "logit") -> DataFrame:
    """Sum of one weight per active field code (unknown codes add 0), one
    result for each row: one join per field, so repeated keys stay apart."""
    joined, total = df, F.lit(0.0)
    for i, f in enumerate(fields):
        w = weights.where(F.col("field") == f).select(F.col("code").alias(f"_code{i}"), F.col("weight").alias(f"_w{i}"))
        joined = joined.join(w, joined[f] == w[f"_code{i}"], "left")
        total = total + F.coalesce(F.col(f"_w{i}"), F.lit(0.0))
    return joined.select(*key, total.alias(out))


def feature_spec(states: dict[str, DataFrame], spec: DataFrame, is_unk: bool = False) -> DataFrame:
    """Per field its vocabulary size (codes + padding [+ unk]) joined
    with a spec frame (field, kind, embedding_name, max_len, dim). Fields
    sharing an ``embedding_name`` share one table, so its size is the max."""
    sizes = None
    for field, st in states.items():
        part = st.agg((F.count(F.lit(1)) + F.lit(1 + int(is_unk))).alias("vocab_size")).withColumn("field", F.lit(field))
        sizes = part if sizes is None else sizes.unionByName(part)
    j = spec.join(sizes, "field", "left")
    shared = j.groupBy("embedding_name").agg(F.max("vocab_size").alias("table_size"))
    return j.join(shared, "embedding_name", "left")
