"""Benchmark decontamination (operator 7).

The test items' normalised word windows (10 words; the whole item where it has
fewer) form a hash set that is broadcast; every document's windows are looked
up in it in one scan, hits are verified word by word, and the hit words' spans
or whole documents are removed.

Bound of the broadcast: the windows are counted first and split by hash into
blocks of at most BLOCK windows. Each block is a pass of its own over the
documents with what was found so far, so a larger benchmark costs further
passes, never a larger broadcast or more memory in a task.

Normalisation: A-Z to lower case; words are runs of digits, a-z and all
characters from U+0080 on.

Defined results: null and empty texts (documents or items) have no words and
hit nothing; a null item_id counts as the empty string; items that repeat an
item_id count as one item; rows that repeat a document are judged one by one;
an empty benchmark leaves all documents clean; a very long text is scanned on its
own; an empty table gives no rows; columns of any other name come back as they were.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.llm import textscan as ts
from recsmith.llm.common import by_place, pick, place_of, written

WINDOW = 10
#: Windows in one broadcast set (about 100 bytes each).
BLOCK = 200_000

_SPLIT = np.ones(128, dtype=bool)
_SPLIT[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = False

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("hit_words", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def _normal(chunk: ts.Chunk) -> tuple[np.ndarray, ts.Words, np.ndarray]:
    codes = ts.lower_ascii(chunk.codes)
    found = ts.words(chunk, ~((codes < 128) & _SPLIT[np.minimum(codes, 127)]))
    return codes, found, ts.span_hash(ts.char_values(codes), found.starts, found.ends)


def _phrase(codes: np.ndarray, found: ts.Words, at: int, size: int) -> bytes:
    parts = [codes[found.starts[k]:found.ends[k]].astype("<u4").tobytes().decode("utf-32-le") for k in range(at, at + size)]
    return " ".join(parts).encode()


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(hash, size, phrase, item): distinct windows of the items."""

    def scan(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for chunk in ts.chunks(batch.column(1)):
                codes, found, hashes = _normal(chunk)
                for d in range(chunk.n):
                    lo, hi = int(found.first[d]), int(found.first[d + 1])
                    size = min(window, hi - lo)
                    at = np.arange(lo, hi - size + 1) if size else np.zeros(0, np.int64)
                    for k, h in zip(at, ts.span_hash(hashes, at, at + size).view(np.int64), strict=True):
                        rows.append((int(h), size, _phrase(codes, found, int(k), size), ids[chunk.row + d] or ""))
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                                              pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.string())],
                                             names=["hash", "size", "phrase", "item"])

    return (pick(benchmark, "item_id", "text").select(F.col("item_id").cast("string").alias("item_id"), "text")
            .mapInArrow(scan, "hash long, size int, phrase binary, item string").distinct())


class WindowSet:
    """One block of windows: sorted hashes of each size, and the phrases and
    items behind them."""

    def __init__(self, rows):
        self.behind: dict[int, dict[bytes, list[str]]] = {}
        sizes: dict[int, set[int]] = {}
        for r in rows:
            self.behind.setdefault(r.hash, {}).setdefault(bytes(r.phrase), []).append(r.item)
            sizes.setdefault(r.size, set()).add(r.hash)
        self.sizes = {}
        for size, hashes in sizes.items():
            known = np.sort(np.array(list(hashes), dtype=np.int64).view(np.uint64))
            filled = np.zeros(1 << 20, dtype=bool)
            filled[known & np.uint64((1 << 20) - 1)] = True
            self.sizes[size] = (known, filled)

    def hits(self, codes: np.ndarray, found: ts.Words, hashes: np.ndarray):
        """(first word, size, document, items) of each verified window."""
        for size, (known, filled) in self.sizes.items():
            at, doc = ts.windows(found.first, size)
            h = ts.span_hash(hashes, at, at + size)
            may = np.flatnonzero(filled[h & np.uint64((1 << 20) - 1)])
            where = np.minimum(np.searchsorted(known, h[may]), len(known) - 1)
            for k in may[known[where] == h[may]]:
                items = self.behind[int(h[k].view(np.int64))].get(_phrase(codes, found, int(at[k]), size))
                if items:
                    yield int(at[k]), size, int(doc[k]), items


def _runs(words: list[int], found: ts.Words, first: int, base: int) -> list[list[int]]:
    """Character spans of runs of consecutive hit words."""
    out: list[list[int]] = []
    last = None
    for w in words:
        start, end = int(found.starts[first + w]) - base, int(found.ends[first + w]) - base
        if last is not None and w == last + 1:
            out[-1][1] = end
        else:
            out.append([start, end])
        last = w
    return out


def _scan(known, before: bool):
    """Function for mapInArrow over (text, other columns[, found so far])."""

    def scan(batches):
        block = known.value
        for batch in batches:
            earlier = batch.column(batch.num_columns - 1).to_pylist() if before else [None] * batch.num_rows
            for chunk in ts.chunks(batch.column(0)):
                out = []
                codes, found, hashes = _normal(chunk)
                words: list[set] = [set((e or {}).get("hit_words") or ()) for e in earlier[chunk.row:chunk.row + chunk.n]]
                items: list[set] = [set((e or {}).get("items") or ()) for e in earlier[chunk.row:chunk.row + chunk.n]]
                for at, size, d, names in block.hits(codes, found, hashes):
                    lo = at - int(found.first[d])
                    words[d].update(range(lo, lo + size))
                    items[d].update(names)
                for d in range(chunk.n):
                    hit = sorted(words[d])
                    out.append({"n_words": int(found.first[d + 1] - found.first[d]), "hit_words": hit, "items": sorted(items[d]),
                                "hit_spans": _runs(hit, found, int(found.first[d]), int(chunk.bounds[d]))})
                columns = [batch.column(i).slice(chunk.row, chunk.n) for i in range(batch.num_columns - before)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(out, _ARROW)],
                                                 names=[*batch.schema.names[:len(columns)], "_found"])

    return scan


_ARROW = pa.struct([("n_words", pa.int64()), ("hit_spans", pa.list_(pa.list_(pa.int64()))),
                    ("hit_words", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Column _found (n_words, hit_spans, hit_words, items) beside the columns of
    `docs`; the text comes first, as _text. hit_spans are character offsets. With
    several blocks, what a block found is written before the next block's set
    is made, so that there is one set at a time, in the tasks as on the driver."""
    spark = docs.sparkSession
    # blocks are cut by phrase, so that equal windows of several items stay together
    windows = written(item_windows(benchmark, window))
    blocks = max(1, -(-windows.count() // block))
    current = docs.select(F.col("text").alias("_text"), *[c for c in docs.columns if c != "text"])
    schema = T.StructType([*current.schema, T.StructField("_found", RESULT)])
    for b in range(blocks):
        rows = windows.filter(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == b).collect()
        known = spark.sparkContext.broadcast(WindowSet(rows))
        current = current.mapInArrow(_scan(known, b > 0), schema)
        if b + 1 < blocks:
            current = written(current)
            known.destroy()
    return current


def leak_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, hit_spans of every document."""
    f = F.col("_found")
    return find_leaks(pick(docs, "doc_id", "text"), benchmark, window, block).select(
        "doc_id", f["n_words"].alias("n_words"), F.size(f["hit_words"]).cast("long").alias("n_hit"),
        F.size(f["items"]).cast("long").alias("n_items"), f["items"].alias("items"), f["hit_spans"].alias("hit_spans"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """`docs` without its leaks. remove="documents": documents with a hit go;
    "spans": the hit words go, n_chars (if there) follows the new text."""
    names, text = docs.columns, f"_c{place_of(docs, 'text')}"
    side = by_place(docs)
    found = find_leaks(side.withColumnRenamed(text, "text"), benchmark, window, block)
    clean = F.size("_found.hit_words") == 0
    if remove == "documents":
        return found.filter(clean).select(*[F.col("_text" if c == text else c).alias(n) for c, n in zip(side.columns, names, strict=True)])

    def cut(batches):
        for batch in batches:
            texts, spans = batch.column(0), pc.struct_field(batch.column(batch.num_columns - 1), "hit_spans")
            kept = [cut_spans(t, s) for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(kept, texts.type), *batch.columns[1:]], names=batch.schema.names)

    touched = found.filter(~clean).mapInArrow(cut, found.schema).withColumn("_cut", F.lit(True))
    out = found.filter(clean).withColumn("_cut", F.lit(False)).unionByName(touched)
    columns = []
    for c, n in zip(side.columns, names, strict=True):
        column = F.col("_text" if c == text else c)
        if n == "n_chars":
            column = F.when(F.col("_cut"), F.length("_text")).otherwise(column).cast(docs.schema[n].dataType)
        columns.append(column.alias(n))
    return out.select(*columns)


def cut_spans(text: str | None, spans: list[list[int]] | None) -> str | None:
    if text is None or not spans:
        return text
    out, at = [], 0
    for lo, hi in spans:
        out.append(text[at:lo])
        at = hi
    return "".join([*out, text[at:]])


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
