"""Helpers shared by the text operators."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.session import ensure_checkpoint_dir

SALTS = 16
#: Rows up to which a lookup table is broadcast; larger ones are joined salted.
LOOKUP_ROWS = 50_000

_written: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """New folder under the shared checkpoint folder, removed when the
    driver ends."""
    app = spark.sparkContext.applicationId
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/recsmith-llm-{uuid.uuid4().hex}"
    if app not in _written:
        _written[app] = []
        atexit.register(_remove, spark, app)
    _written[app].append(path)
    return path


def _remove(spark: SparkSession, app: str) -> None:
    """Best effort: the session may already be stopped."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _written.pop(app, []):
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
    except Exception:  # noqa: BLE001  the context is gone
        return


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, codec: str | None = None, tidy: bool = False) -> DataFrame:
    """The DataFrame written as a Parquet table in the shared folder and read
    back: lineage ends there, every later use sees the same rows, lost
    executors cost nothing, and joins see a plain scan whose exchanges
    adaptive execution may split. `codec`: another compression than the session's;
    `tidy`: the job's shuffle files go when it ends, not when the driver next
    collects garbage."""
    spark = df.sparkSession
    path = scratch(spark)
    before = spark.conf.get(_TIDY, None)
    if tidy:
        spark.conf.set(_TIDY, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        if tidy:
            spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def by_place(df: DataFrame) -> DataFrame:
    """The same columns under names that clash with nothing."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def place_of(df: DataFrame, name: str) -> int:
    """Place of a column: of this very name, else of one that differs in case."""
    for names in (df.columns, [c.lower() for c in df.columns]):
        if name in names:
            return names.index(name)
    raise ValueError(f"no column {name} among {df.columns}")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The columns `names` alone, whatever others are called."""
    return by_place(df).select(*[F.col(f"_c{place_of(df, n)}").alias(n) for n in names])


def salted(key: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(salts)).cast("int")


def lookup_join(df: DataFrame, small: DataFrame, keys: list[str], spread: Column,
                max_rows: int = LOOKUP_ROWS, salts: int = SALTS) -> DataFrame:
    """Left join of `df` with `small` (unique on `keys`, written beforehand)
    on null-safe keys. `small` is broadcast only after counting its rows; a
    larger one is replicated `salts` times and joined on (keys, salt), so one
    key that holds a third of `df` still spreads over that many tasks."""
    big = small.count() > max_rows
    right = small.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                         *[c for c in small.columns if c not in keys])
    on = None
    for i, k in enumerate(keys):
        one = df[k].eqNullSafe(F.col(f"_k{i}"))
        on = one if on is None else on & one
    drop = [f"_k{i}" for i in range(len(keys))]
    if not big:
        return df.join(F.broadcast(right), on, "left").drop(*drop)
    left = df.withColumn("_salt", salted(spread, salts))
    right = right.withColumn("_rsalt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = F.col("_salt") == F.col("_rsalt")
    for i, k in enumerate(keys):
        on = on & left[k].eqNullSafe(F.col(f"_k{i}"))
    return left.join(right, on, "left").drop("_salt", "_rsalt", *drop)
