"""Categorical encoding with stable, append-only codes.

State is a DataFrame ``(value, id)`` per field; fitting only numbers the
values the state does not know yet, so existing codes never change.
New values are numbered in ascending order, nulls first (Q4), which makes
codes reproducible run to run.

Dense numbering never uses a global single-partition window: values are
range partitioned, numbered inside each partition, and shifted by the
running count of the partitions before them (a table with one row per
partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsmith.session import cut_lineage

VALUE = "value"
ID = "id"
_LOW_BITS = (1 << 33) - 1


def range_numbered(df: DataFrame, by: list) -> DataFrame:
    """``df`` range partitioned and sorted by ``by``, with ``_pid`` (partition)
    and ``_idx`` (place in it) as stored values.

    The bounds of a range partitioning come from a sample, so two evaluations
    of the same plan may cut at different places. Counts per partition and the
    rows they are joined back to must therefore come from one evaluation: the
    numbered rows are written once (reliable checkpoint) and everything else
    reads them."""
    ranged = (df.repartitionByRange(*by).sortWithinPartitions(*by)
              .withColumn("_mid", F.monotonically_increasing_id()))
    return cut_lineage(ranged.select(*df.columns, F.shiftright("_mid", 33).alias("_pid"),
                                     F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)).alias("_idx")))


def partition_offsets(ranged: DataFrame) -> DataFrame:
    """(_pid, _off): rows in earlier partitions; one row per partition."""
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))


def attach_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (a global aggregate, so its
    size is bounded) to every row. The join on a constant key is planned as
    a broadcast nested-loop join against that single row: each row meets
    exactly one partner, the stream side is never shuffled."""
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(scalars.withColumn("_one", F.lit(1))), "_one")
            .drop("_one"))


# Largest table (rows) broadcast when its row count has been measured.
BROADCAST_MAX_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, n_rows: int, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only for a table whose measured row count is within
    ``max_rows``; larger tables are left to a shuffle join."""
    return F.broadcast(df) if n_rows <= max_rows else df


def dense_ids(values: DataFrame, col: str, start: int = 1, name: str = ID) -> DataFrame:
    """Number the distinct values of ``col`` as ``start, start+1, ...`` in
    ascending order (nulls first). Returns ``(col, name)``; codes are bigint."""
    ranked = range_numbered(values.select(col).distinct(), [F.col(col).asc_nulls_first()])
    # one row per partition: a bounded broadcast
    return ranked.join(F.broadcast(partition_offsets(ranked)), "_pid").select(
        col, (F.lit(start) + F.col("_off") + F.col("_idx")).alias(name))


def fit_encoding(df: DataFrame, field: str, state: DataFrame | None = None,
                 is_padding: bool = True, is_unk: bool = False) -> DataFrame:
    """E1 fit: extend ``state`` with codes for values it has not seen.

    First new code = ``len(state) + is_padding + is_unk``; with padding,
    code 0 is reserved (and 1 for unknown when ``is_unk``)."""
    if not is_padding:
        raise ValueError("is_padding=False makes the unseen code collide with a real code (Q4)")
    values = df.select(F.col(field).alias(VALUE)).distinct()
    reserved = int(is_padding) + int(is_unk)
    if state is None:
        new = dense_ids(values, VALUE, start=reserved, name=ID)
        return new
    known = state.select(VALUE, ID)
    fresh = values.join(known, values[VALUE].eqNullSafe(known[VALUE]), "left_anti")
    numbered = dense_ids(fresh, VALUE, start=0, name="_rel")
    base = known.agg(F.count(F.lit(1)).alias("_known"))
    appended = attach_scalars(numbered, base).select(
        VALUE, (F.col("_rel") + F.col("_known") + F.lit(reserved)).alias(ID))
    return known.unionByName(appended)


def fit_encodings(df: DataFrame, fields: list[str], states: dict[str, DataFrame] | None = None,
                  is_unk: bool = False) -> dict[str, DataFrame]:
    """E1/E2 fit of several fields in one job, with the codes of
    :func:`fit_encoding`: one scan gives the distinct (field, value) pairs, one
    range numbering over (field, value) numbers them all, and a field's codes
    start where its first pair stands (one row a field). ``states`` are extended:
    pairs they know are taken out before the numbering. The new states are
    parts of one written table."""
    states = dict(states or {})
    types = dict(df.dtypes)
    kinds = sorted({types[f] for f in fields})
    place = {k: f"_v{i}" for i, k in enumerate(kinds)}  # a column for each type, so that values keep their order

    def pair(f: str, value) -> list:
        return [F.lit(f).alias("_field")] + [(value if types[f] == k else F.lit(None).cast(k)).alias(place[k]) for k in kinds]

    values = list(place.values())
    pairs = df.select(F.explode(F.array(*[F.struct(*pair(f, F.col(f))) for f in fields])).alias("_p")).select("_p.*").distinct()
    known = None
    for f in fields:
        if f in states:
            part = states[f].select(*pair(f, F.col(VALUE).cast(types[f])))
            known = part if known is None else known.unionByName(part)
    if known is not None:
        old = known.select(F.struct("_field", *values).alias("_known"))
        pairs = pairs.withColumn("_key", F.struct("_field", *values)).join(old, F.col("_key") == F.col("_known"), "left_anti").drop("_key")
    ranked = range_numbered(pairs, [F.col("_field"), *[F.col(c).asc_nulls_first() for c in values]])
    placed = ranked.join(F.broadcast(partition_offsets(ranked)), "_pid").withColumn("_at", F.col("_off") + F.col("_idx"))
    first = placed.groupBy("_field").agg(F.min("_at").alias("_first"))
    placed = placed.join(F.broadcast(first.withColumnRenamed("_field", "_ff")), F.col("_field") == F.col("_ff"))  # one row a field
    numbered = cut_lineage(placed.select("_field", *values, (F.col("_at") - F.col("_first")).alias("_rel")))
    reserved = 1 + int(is_unk)
    for f in fields:
        new = numbered.where(F.col("_field") == f).select(F.col(place[types[f]]).alias(VALUE), "_rel")
        if f not in states:
            states[f] = new.select(VALUE, (F.col("_rel") + F.lit(reserved)).alias(ID))
            continue
        have = states[f].select(VALUE, ID)
        base = have.agg(F.count(F.lit(1)).alias("_known"))
        states[f] = have.unionByName(attach_scalars(new, base).select(VALUE, (F.col("_rel") + F.col("_known") + F.lit(reserved)).alias(ID)))
    return states


def apply_encoding(df: DataFrame, field: str, state: DataFrame, is_unk: bool = False,
                   out: str | None = None) -> DataFrame:
    """E1/E2 apply: value -> code through a null-safe left join; unseen
    values get 1 with ``is_unk`` else 0. Small states broadcast (the
    optimizer decides from the state's size)."""
    out = out or field
    st = state.select(F.col(VALUE).alias("_enc_v"), F.col(ID).alias("_enc_id"))
    default = F.lit(1 if is_unk else 0)
    # non-null values through a plain equi-join on the column itself (so an
    # existing hash partitioning on it is reused); a null value takes the
    # state's code for null, attached as a (0- or 1-row) bounded broadcast
    joined = df.join(st.where(F.col("_enc_v").isNotNull()), df[field] == st["_enc_v"], "left")
    null_code = st.where(F.col("_enc_v").isNull()).select(F.col("_enc_id").alias("_enc_null")).limit(1)
    joined = (joined.withColumn("_one", F.lit(1))
              .join(F.broadcast(null_code.withColumn("_one", F.lit(1))), "_one", "left").drop("_one"))
    code = F.when(F.col(field).isNull(), F.coalesce(F.col("_enc_null"), default)).otherwise(
        F.coalesce(F.col("_enc_id"), default)).cast("bigint")
    if out == field:
        return joined.select(*[code.alias(out) if c == field else F.col(c) for c in df.columns])
    return joined.select(*[F.col(c) for c in df.columns], code.alias(out))


def encode_fields(df: DataFrame, fields: list[str], states: dict[str, DataFrame] | None = None,
                  is_unk: bool = False) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fit (append) and apply several fields; returns the new states."""
    states = fit_encodings(df, fields, states, is_unk)
    out = df
    for f in fields:
        out = apply_encoding(out, f, states[f], is_unk=is_unk)
    return out, states


def decode(df: DataFrame, field: str, state: DataFrame, out: str | None = None) -> DataFrame:
    """Code -> raw value (reverse join)."""
    out = out or field
    st = state.select(F.col(ID).alias("_dec_id"), F.col(VALUE).alias("_dec_v"))
    joined = df.join(st, df[field] == st["_dec_id"], "left")
    if out == field:
        return joined.select(*[F.col("_dec_v").alias(out) if c == field else F.col(c) for c in df.columns])
    return joined.select(*[F.col(c) for c in df.columns], F.col("_dec_v").alias(out))


def new_values(df: DataFrame, field: str, state: DataFrame) -> DataFrame:
    """U4: distinct values of ``field`` the state does not know."""
    values = df.select(F.col(field).alias(VALUE)).distinct()
    return values.join(state.select(VALUE), values[VALUE].eqNullSafe(state[VALUE]), "left_anti")


def label_encode(df: DataFrame, field: str, out: str | None = None) -> DataFrame:
    """Codes 0.. by sorted distinct value."""
    codes = dense_ids(df, field, start=0, name="_lab")
    out = out or field
    joined = df.join(codes, df[field].eqNullSafe(codes[field]), "left").drop(codes[field])
    return joined.withColumn(out, F.col("_lab")).drop("_lab") if out != field else \
        joined.drop(field).withColumnRenamed("_lab", field).select(*df.columns)
