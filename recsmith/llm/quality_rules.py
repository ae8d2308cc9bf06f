"""Quality rules with adaptive thresholds (operator 4).

Word, symbol and repetition counts of each text come from one vectorised scan.
Rates of the texts that pass the base rules go into mergeable quantile
sketches: log-linear bucket counts (64 exact buckets, then 32 a power of two,
so a quantile is off by at most 1/32 of its value) for each (lang, source).
Sketches merge by adding counts, so a sparse (lang, source) falls back on the
merged sketch of its language, and a sparse language on that of the corpus.
The thresholds of a group are fences around its own quartiles; texts are then
joined with the thresholds of their group and filtered.

Defined results: a null or empty text has no words and fails the base rules;
null lang or source form groups of their own; repeated rows are judged one by
one; a rate on a fence is kept; a very long text is scanned on its own, so memory
follows the longest text; an empty table gives no rows; output columns replace
input columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.llm import textscan as ts
from recsmith.llm.common import by_place, lookup_join, pick, place_of, written

# Fixed values of the contract: base rules and the symbol set.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

#: Texts a group needs for thresholds of its own.
MIN_GROUP = 200
#: Fence: quartile plus FENCE times the distance of the quartiles.
FENCE = 4
#: Metrics: name -> (numerator, denominator, scale, least margin above the
#: third quartile, whether a lower fence holds too).
METRICS = {
    "mean_word_length": ("word_chars", "n_words", 1000, 500, True),
    "symbol_rate": ("n_symbols", "word_chars", 10000, 200, False),
    "dup_line_rate": ("n_dup_lines", "n_lines", 10000, 4000, False),
    "repeat_rate": ("n_repeat_words", "n_words", 10000, 2000, False),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the scan counts: those of the contract, and lines with a word.
COUNTED = (*COUNTS, "n_lines")


def _repeats(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each entry: whether its key occurs twice or more in its document."""
    if len(key) == 0:
        return np.zeros(0, dtype=bool)
    both = ts.mix(key ^ ts.mix(doc.astype(np.uint64)))
    _, inverse, counts = np.unique(both, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def chunk_counts(chunk: ts.Chunk) -> dict[str, np.ndarray]:
    codes, bounds, n = chunk.codes, chunk.bounds, chunk.n
    values = ts.char_values(codes)
    found = ts.words(chunk, ~ts.is_blank(codes))
    n_words = np.diff(found.first)
    char_total = np.concatenate([[0], np.cumsum(found.ends - found.starts)])
    symbol = np.zeros(128, dtype=bool)
    symbol[[ord(c) for c in SYMBOLS]] = True

    # lines with a word; a line keeps all its characters
    starts, ends = _lines(codes, bounds)
    has_word = np.searchsorted(found.starts, ends) > np.searchsorted(found.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    doc = chunk.doc_of(starts)
    keys = ts.mix(ts.strong_hash(values, starts, ends) ^ ts.mix(doc.astype(np.uint64)))
    _, first = np.unique(keys, return_index=True)
    dup = np.bincount(doc, minlength=n) - np.bincount(doc[first], minlength=n)

    hashes = ts.strong_hash(values, found.starts, found.ends)
    at, wdoc = ts.windows(found.first, 3)
    repeated = _repeats(ts.strong_hash(hashes, at, at + 3), wdoc)
    hit = np.zeros(len(hashes), dtype=bool)
    for k in range(3):
        hit[at[repeated] + k] = True
    hits = np.concatenate([[0], np.cumsum(hit)])
    return {
        "n_words": n_words,
        "word_chars": char_total[found.first[1:]] - char_total[found.first[:-1]],
        "n_symbols": chunk.per_doc((codes < 128) & symbol[np.minimum(codes, 127)]),
        "n_dup_lines": dup,
        "n_lines": np.bincount(doc, minlength=n),
        "n_repeat_words": hits[found.first[1:]] - hits[found.first[:-1]],
    }


def _lines(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    r"""Spans of the \n-split lines that have a character."""
    return ts.spans(codes != 10, bounds)


def text_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with the counts of each text."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in COUNTED]
    source = by_place(docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`")))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema
    for c in COUNTED:
        schema = schema.add(c, "long")

    def scan(batches):
        for batch in batches:
            for chunk in ts.chunks(batch.column(len(keep))):
                found = chunk_counts(chunk)
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(chunk.row, chunk.n) for i in range(len(keep))],
                                                  *[pa.array(found[c], pa.int64()) for c in COUNTED]], names=keep + list(COUNTED))

    return source.mapInArrow(scan, schema)


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _rate(name: str) -> Column:
    num, den, scale, _, _ = METRICS[name]
    return F.expr(f"({scale} * {num}) div {den}")


def bucket(v: Column) -> Column:
    """Log-linear bucket of a non-negative long: exact below 64, then 32
    buckets a power of two."""
    shift = F.greatest(F.lit(0), F.length(F.bin(v)) - 6)
    return (shift * 32 + F.call_function("shiftright", v, shift)).cast("int")


def bucket_low(b: Column) -> Column:
    """Least value of a bucket."""
    shift = F.greatest(F.lit(0), F.floor(b / 32).cast("int") - 1)
    return F.call_function("shiftleft", (b - shift * 32).cast("long"), shift)


def sketches(counts: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n): mergeable by adding n."""
    entry = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), bucket(_rate(m)).alias("bucket")) for m in METRICS]))
    return (counts.filter(~base_failed()).select("lang", "source", entry.alias("e"))
            .groupBy("lang", "source", "e.metric", "e.bucket").agg(F.count("*").alias("n")))


def thresholds(sketch: DataFrame, min_group: int = MIN_GROUP, fence: int = FENCE) -> DataFrame:
    """One row for each (lang, source) with the least and largest allowed rate
    of each metric. Groups under `min_group` texts use the merged sketch of
    their language, or of the corpus where that is too small as well."""
    levels = []
    for level, keys in enumerate((["lang", "source"], ["lang"], [])):
        merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
        group = Window.partitionBy(*keys, "metric")
        ranked = (merged.withColumn("total", F.sum("n").over(group))
                  .withColumn("upto", F.sum("n").over(group.orderBy("bucket"))))
        q = [F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("bucket"))) for k in (1, 3)]
        levels.append(ranked.groupBy(*keys, "metric").agg(
            bucket_low(q[0]).alias(f"low{level}"), (bucket_low(q[1] + 1) - 1).alias(f"high{level}"),
            F.max("total").alias(f"total{level}")))
    own, lang, corpus = levels
    joined = (own.withColumnRenamed("metric", "m").join(
        lang.select(F.col("lang").alias("l1"), F.col("metric").alias("m1"), "low1", "high1", "total1"),
        F.col("lang").eqNullSafe(F.col("l1")) & (F.col("m") == F.col("m1")))
        .join(corpus.select(F.col("metric").alias("m2"), "low2", "high2"), F.col("m") == F.col("m2")))

    def chosen(what: str) -> Column:
        return (F.when(F.col("total0") >= min_group, F.col(f"{what}0"))
                .when(F.col("total1") >= min_group, F.col(f"{what}1")).otherwise(F.col(f"{what}2")))

    margin = F.create_map(*[x for m, v in METRICS.items() for x in (F.lit(m), F.lit(v[3]))])[F.col("m")]
    two_sided = F.create_map(*[x for m, v in METRICS.items() for x in (F.lit(m), F.lit(v[4]))])[F.col("m")]
    reach = F.greatest(fence * (F.col("high") - F.col("low")), margin)
    limits = (joined.select("lang", "source", "m", chosen("low").alias("low"), chosen("high").alias("high"))
              .select("lang", "source", "m", (F.col("high") + reach).alias("most"),
                      F.when(two_sided, F.col("low") - reach).otherwise(F.lit(0)).alias("least")))
    return limits.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("m") == m, F.col(w))).alias(f"_{w}_{m}") for m in METRICS for w in ("least", "most")])


def judge(counts: DataFrame, limits: DataFrame, spread: str) -> DataFrame:
    """`counts` with base_failed and kept, after the join with the limits."""
    counts = counts.drop("base_failed", "kept")
    joined = lookup_join(counts, limits, ["lang", "source"], F.col(spread))
    fits = F.lit(True)
    for m in METRICS:
        rate = _rate(m)
        fits = fits & (rate >= F.col(f"_least_{m}")) & (rate <= F.col(f"_most_{m}"))
    return (joined.withColumn("base_failed", base_failed())
            .withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(fits, F.lit(True))))
            .select(*counts.columns, "base_failed", "kept"))


def quality_counts(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """doc_id, lang, source, counts, base_failed, kept of every document; the
    texts are scanned once, the counts are written and used twice."""
    counts = written(text_counts(pick(docs, "doc_id", "lang", "source", "text"), keep=["doc_id", "lang", "source"]))
    limits = written(thresholds(sketches(counts), min_group))
    return judge(counts, limits, "doc_id")


def quality_filter(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """The documents that are kept, with their own columns. The texts are
    scanned twice (sketches, then filter) so that no text is shuffled."""
    side = by_place(docs)
    text = f"_c{place_of(docs, 'text')}"
    inner = side.select("*", *[F.col(f"_c{place_of(docs, c)}").alias(c) for c in ("doc_id", "lang", "source")])
    limits = written(thresholds(sketches(text_counts(inner, text, ["lang", "source"])), min_group))
    return judge(text_counts(inner, text), limits, "doc_id").filter("kept").select(*side.columns).toDF(*docs.columns)
