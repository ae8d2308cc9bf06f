"""Long sequences chunk by chunk.

A user's ordered sequence is a table of chunks (user, chunk, offset, values):
positions come from ``operators/sequence.py`` (a hot user over many tasks), and a
chunk has at most ``size`` values, so that no task and no row ever holds a whole
sequence. What an operation needs from beyond a chunk comes as a halo: the last
``before`` values ahead of the chunk and the first ``after`` values behind it,
copied from the neighbouring chunks when the table is made. The arrays of one
user's chunks, one after the other, are the arrays of the whole-sequence
operators in ``operators/logs.py``.

Defined results: null users are a user like others; null values stay in their
places; equal order values come in any order among themselves; users without
rows have no chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.operators.sequence import HOT_KEY_ROWS, HotSet, positions

#: Values of a chunk.
CHUNK = 1024


def chunked_sequences(log: DataFrame, cols: list[str], user: str = "user_id", order: tuple[str, ...] = ("time_us", "item_id"),
                      size: int = CHUNK, before: int = 0, after: int = 0, threshold: int = HOT_KEY_ROWS,
                      known: HotSet | None = None) -> DataFrame:
    """(user, chunk, offset, n, values, before, after): ``n`` is the length of
    the whole sequence, the others are arrays of structs of ``cols``. A row is
    copied to the chunks whose halo it is in, at most
    ``before / size + after / size + 2`` of them."""
    extra = [c for c in order if c not in cols]
    placed = positions(log.select(user, *cols, *extra), user, list(order), loc="_p", size="_n", threshold=threshold, known=known)
    p = F.col("_p").cast("bigint")
    least = F.greatest(F.lit(0), F.floor((p - after) / size)) if after else F.floor(p / size)
    most = F.least(F.floor((p + before) / size), F.floor((F.col("_n") - 1) / size))
    copies = placed.withColumn("chunk", F.explode(F.sequence(least, most)))
    entry = F.struct(p.alias("p"), F.struct(*cols).alias("v"))
    rows = copies.groupBy(user, "chunk").agg(F.array_sort(F.collect_list(entry), lambda a, b: (a["p"] - b["p"]).cast("int")).alias("_all"),
                                             F.max("_n").alias("n"))
    first = F.col("chunk") * size

    def part(test) -> Column:
        return F.transform(F.filter("_all", lambda x: test(x["p"])), lambda x: x["v"])

    return rows.select(user, "chunk", first.alias("offset"), "n",
                       part(lambda q: (q >= first) & (q < first + size)).alias("values"),
                       part(lambda q: (q < first) & (q >= first - before)).alias("before"),
                       part(lambda q: (q >= first + size) & (q < first + size + after)).alias("after"))


def sequence_chunks(log: DataFrame, user: str = "user_id", item: str = "item_id", time_col: str = "time_us", size: int = CHUNK,
                    **kw) -> DataFrame:
    """A4 / A5: the item and time arrays of ``user_sequences``, in chunks."""
    rows = chunked_sequences(log, [item, time_col], user, (time_col, item), size, **kw)
    return rows.select(user, "chunk", "offset", F.col(f"values.{item}").alias("items"), F.col(f"values.{time_col}").alias("times"), "n")


def click_set_chunks(log: DataFrame, user: str = "user_id", item: str = "item_id", distinct: bool = False, size: int = CHUNK, **kw) -> DataFrame:
    """The sorted items of ``user_click_set``, in chunks; null is no item."""
    rows = log.select(user, item).where(F.col(item).isNotNull())
    rows = chunked_sequences(rows.distinct() if distinct else rows, [item], user, (item,), size, **kw)
    return rows.select(user, "chunk", "offset", F.col(f"values.{item}").alias("items"), "n")


def shifted_target_chunks(log: DataFrame, value: str = "item_id", user: str = "user_id", order: tuple[str, ...] = ("time_us", "item_id"),
                          size: int = CHUNK, **kw) -> DataFrame:
    """H4: inputs are positions 1..n-1, targets 2..n; a chunk's last target is
    the first value behind it."""
    rows = chunked_sequences(log, [value], user, order, size, after=1, **kw)
    ahead = F.concat(F.col(f"values.{value}"), F.col(f"after.{value}"))
    inputs = F.least(F.size("values"), F.size(ahead) - 1)
    return (rows.select(user, "chunk", "offset", F.slice(ahead, F.lit(1), inputs).alias("inputs"), F.slice(ahead, F.lit(2), inputs).alias("targets"), "n")
            .where((F.size("inputs") > 0) | (F.col("n") == 1)))


def next_item_chunks(log: DataFrame, value: str = "item_id", user: str = "user_id", order: tuple[str, ...] = ("time_us", "item_id"),
                     size: int = CHUNK, **kw) -> DataFrame:
    """The history (all but the last value) in chunks, and the last value
    as ``label`` in the user's last chunk."""
    rows = chunked_sequences(log, [value], user, order, size, **kw)
    last = F.col("offset") + F.size("values") == F.col("n")
    values = F.col(f"values.{value}")
    return rows.select(user, "chunk", "offset", F.when(last, F.slice(values, F.lit(1), F.size(values) - 1)).otherwise(values).alias("history"),
                       F.when(last, F.element_at(values, -1)).alias("label"), last.alias("last"))


def window_histories(log: DataFrame, value: str, n: int, user: str = "user_id", order: tuple[str, ...] = ("time_us", "item_id"),
                     size: int = CHUNK, name: str = "hist", **kw) -> DataFrame:
    """W2 by chunks: (user, loc, value, the previous ``n`` values), read off the
    chunk and its halo."""
    rows = chunked_sequences(log, [value], user, order, size, before=n, **kw)
    known = F.concat(F.col(f"before.{value}"), F.col(f"values.{value}"))
    rows = rows.select(user, "offset", known.alias("_k"), F.size("before").alias("_b"), F.posexplode("values").alias("_i", "_v"))
    start = F.greatest(F.lit(1), F.col("_b") + F.col("_i") - n + 1)
    return rows.select(user, (F.col("offset") + F.col("_i")).alias("loc"), F.col(f"_v.{value}").alias(value),
                       F.slice("_k", start, F.col("_b") + F.col("_i") - start + 1).alias(name))


def _parts(rows: DataFrame, chunks: DataFrame, user: str, upto: Column) -> DataFrame:
    """Rows (user, ...) joined with chunks 0..upto of their user, one by one."""
    side = chunks.withColumnRenamed(user, "_cu").withColumnRenamed("chunk", "part")
    spread = rows.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), upto)))
    return spread.join(side, F.col(user).eqNullSafe(F.col("_cu")) & (F.col("_part") == F.col("part"))).drop("_cu", "_part")


def causal_prefix_parts(log: DataFrame, value: str, user: str = "user_id", order: tuple[str, ...] = ("time_us", "item_id"),
                        size: int = CHUNK, **kw) -> DataFrame:
    """H5: position ``loc`` sees positions 0..loc, as parts (user, loc, part,
    prefix) of at most ``size`` values; the parts in order are the prefix of
    ``causal_prefix``. Every part is a row of its own, spread by (user, part)."""
    chunks = chunked_sequences(log, [value], user, order, size, **kw).select(user, "chunk", "n", F.col(f"values.{value}").alias("values"))
    at = chunks.select(user, F.explode(F.sequence(F.col("chunk") * size, F.col("chunk") * size + F.size("values") - 1)).alias("loc"))
    met = _parts(at, chunks, user, F.floor(F.col("loc") / size))
    seen = F.least(F.size("values"), (F.col("loc") - F.col("part") * size + 1).cast("int"))
    return met.select(user, "loc", "part", F.slice("values", F.lit(1), seen).alias("prefix"))


def history_parts(rows: DataFrame, log: DataFrame, user: str = "user_id", item: str = "item_id", time_col: str = "time_us",
                  size: int = CHUNK, **kw) -> DataFrame:
    """Every row with its user's whole history, as parts (row's columns,
    part, items); rows of users without history have one part of nulls."""
    chunks = chunked_sequences(log, [item], user, (time_col, item), size, **kw).select(user, "chunk", "n", F.col(f"values.{item}").alias("items"))
    last = chunks.where("chunk = 0").select(F.col(user).alias("_lu"), F.floor((F.col("n") - 1) / size).alias("_last"))
    known = rows.join(last, rows[user].eqNullSafe(F.col("_lu")), "left").drop("_lu")
    met = _parts(known.where("_last is not null"), chunks.drop("n"), user, F.col("_last"))
    alone = known.where("_last is null").withColumn("part", F.lit(None).cast("bigint")).withColumn("items", F.lit(None).cast(chunks.schema["items"].dataType))
    return met.unionByName(alone).select(*rows.columns, "part", "items")
