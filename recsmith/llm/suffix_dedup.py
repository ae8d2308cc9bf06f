"""Exact substring dedup on suffix arrays (operator 8).

Removes every byte covered by a string of `length` bytes (400) that also
starts anywhere else in the corpus, matches within documents only.

Partitioning. Each window of `length` bytes picks its anchor: the piece of
`anchor_bytes(length)` bytes (128) with the least hash, the leftmost of equals. The choice depends on the
window's bytes alone, so equal windows pick equal pieces at equal offsets, and
the corpus falls into groups by anchor that hold every match. Successive
windows with one anchor form a segment; equal segments of a group collapse to
one, and where there are two or more of them all their windows repeat. Only
groups with different segments need a comparison of texts, one copy of each.

Comparison. Such groups, many to a block of bounded size, are concatenated; the
suffixes are sorted by prefix doubling, which gives the Burrows-Wheeler
transform. Interval expansion starts from the empty string and extends all
intervals of one string length backwards by one byte at a time; the interval of
a string fixes the common prefix of the suffixes on both sides of its end, so
common prefixes come out by increasing value, and the expansion stops at
`length`: neighbours whose common prefix is not known by then share a window.

A group with more than SPLIT segments (a passage in a large share of the
corpus) is dealt over several blocks; one hash for each distinct window of a
block is then grouped over the blocks, so that no match is lost.

Defined results: null and empty texts have no bytes; texts shorter than
`length` keep all; rows without doc_id and rows that repeat one are documents
of their own; rows that repeat doc_id and text match each other; other columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.llm import textscan as ts
from recsmith.llm.common import pick, written

LENGTH = 400
#: Segments of one anchor in one block (at most 672 bytes each, so a block has
#: 2.8 MB at most and takes some 150 MB to sort), and bytes at which a block
#: of several anchors is closed.
SPLIT = 4096
BLOCK_BYTES = 1 << 19
#: Bytes of segments that one task compares, in the mean.
TASK_BYTES = 1 << 20

_POS = np.uint64((1 << 30) - 1)


# -- windows and anchors -----------------------------------------------------

def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of x[i:i + w] for each i, by minima from block borders."""
    n = len(x)
    pad = -n % w
    blocks = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n - w + 1], up[w - 1:n])


def anchor_bytes(length: int) -> int:
    """About a third of a window: long enough that a common line is no anchor,
    short enough that a window has many to pick from."""
    return max(1, length * 8 // 25)


def segments(data: np.ndarray, bounds: np.ndarray, length: int, k: int):
    """(document, start in the document, size, anchor, digest) of the segments
    of texts of bytes, `bounds` in `data`."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    values = ts.char_values(data)
    at = np.arange(len(data) - k + 1)
    pieces = ts.span_hash(values, at, at + k)
    first = _sliding_min((pieces & ~_POS) | at.astype(np.uint64), length - k + 1)
    anchor_at = (first & _POS).astype(np.int64)
    starts = np.arange(len(first))
    size = np.diff(bounds)
    inside = np.repeat(bounds[1:], size)[:len(first)] - starts >= length
    starts, anchor_at = starts[inside], anchor_at[inside]
    if len(starts) == 0:
        return none, none, none, none, none
    head = np.concatenate([[True], (anchor_at[1:] != anchor_at[:-1]) | (starts[1:] != starts[:-1] + 1)])
    # windows of two documents never share an anchor's run: a window's anchor lies inside it
    lo = starts[head]
    last = np.append(starts[np.flatnonzero(head)[1:] - 1], starts[-1])
    hi = last + length
    doc = np.searchsorted(bounds, lo, side="right") - 1
    return (doc, lo - bounds[doc], hi - lo, pieces[anchor_at[head]].view(np.int64),
            ts.span_hash(values, lo, hi).view(np.int64))


def _byte_chunks(column):
    """(first row, bytes, bounds) of runs of rows."""
    for lo, raw in ts.row_runs(column):
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        yield lo, np.frombuffer(b"".join(raw), dtype=np.uint8), bounds


def _text_hashes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return ts.span_hash(ts.char_values(data), bounds[:-1], bounds[1:]).view(np.int64)


def find_segments(docs: DataFrame, length: int) -> DataFrame:
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("dh", "anchor", "seg")],
                           *[T.StructField(c, T.IntegerType()) for c in ("start", "size")]])

    def scan(batches):
        for batch in batches:
            for row, data, bounds in _byte_chunks(batch.column(1)):
                doc, start, size, anchor, seg = segments(data, bounds, length, anchor_bytes(length))
                ids = batch.column(0).slice(row, len(bounds) - 1).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(_text_hashes(data, bounds)[doc]), pa.array(anchor), pa.array(seg),
                    pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32))], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(scan, schema)


# -- comparison of a block ---------------------------------------------------

def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling from 7 symbols on."""
    n = len(symbols)
    key = np.zeros(n, dtype=np.uint64)
    padded = np.concatenate([symbols, np.zeros(7, symbols.dtype)]).astype(np.uint64)
    for j in range(7):
        key = key << np.uint64(9) | padded[j:j + n]
    h = 7
    while True:
        order = np.argsort(key)
        sorted_key = key[order]
        new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = np.cumsum(new)
        if new.all():
            return order
        shifted = np.zeros(n, dtype=np.uint64)
        shifted[:max(n - h, 0)] = rank[h:]
        key = rank << np.uint64(32) | shifted
        h *= 2


def shares_window(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place i of the suffix array: whether the common prefix of the
    suffixes at i - 1 and i was not found to be shorter than `length`.
    `symbols` are positive, 0 parts the texts and is never stepped over."""
    n = len(symbols)
    bwt = symbols[order - 1]  # the text is taken as a circle; its last symbol is a 0
    by_symbol = np.argsort(bwt, kind="stable").astype(np.int32)
    lf = np.empty(n, dtype=np.int32)
    lf[by_symbol] = np.arange(n, dtype=np.int32)
    same = bwt[by_symbol[1:]] == bwt[by_symbol[:-1]]
    before = np.full(n, -1, dtype=np.int32)
    after = np.full(n, n, dtype=np.int32)
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    solid = bwt != 0
    unknown = np.ones(n + 1, dtype=bool)
    unknown[0] = unknown[n] = False
    lo, hi = np.array([0], dtype=np.int32), np.array([n], dtype=np.int32)
    for _ in range(length):  # the common prefixes found in a round have one length
        if len(lo) == 0:
            break
        size = hi - lo
        ends = np.cumsum(size)
        place = np.arange(ends[-1], dtype=np.int32) - np.repeat((ends - size - lo).astype(np.int32), size)
        place_lo, place_hi = np.repeat(lo, size), np.repeat(hi, size)
        here = solid[place]
        # the first and the last place of a symbol in an interval bound its extension
        first = np.sort(lf[place[here & (before[place] < place_lo)]])
        last = np.sort(lf[place[here & (after[place] >= place_hi)]]) + 1
        new = unknown[last]
        lo, hi = first[new], last[new]
        unknown[hi] = False
    return unknown[:n]


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text: the starts of its windows that also start elsewhere in
    the texts."""
    size = np.array([len(t) for t in texts])
    base = np.cumsum(size + 1) - size - 1
    symbols = np.zeros(int((size + 1).sum()), dtype=np.int16)
    for t, b in zip(texts, base, strict=True):
        symbols[b:b + len(t)] = np.frombuffer(t, dtype=np.uint8).astype(np.int16) + 1
    order = suffix_order(symbols).astype(np.int32)
    whole = np.zeros(len(symbols), dtype=bool)  # a window fits
    for b, s in zip(base, size, strict=True):
        whole[b:b + max(0, s - length + 1)] = True
    shared = shares_window(symbols, order, length)
    pair = np.flatnonzero(shared[1:] & whole[order[1:]] & whole[order[:-1]])
    hit = np.zeros(len(symbols), dtype=bool)
    hit[order[pair]] = hit[order[pair + 1]] = True
    return [np.flatnonzero(hit[b:b + s]) for b, s in zip(base, size, strict=True)]


def _ranges(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    if len(starts) == 0:
        return []
    gap = np.flatnonzero(np.diff(starts) > length)
    lo = starts[np.concatenate([[0], gap + 1])]
    hi = starts[np.concatenate([gap, [len(starts) - 1]])] + length
    return list(zip(lo.tolist(), hi.tolist(), strict=True))


_FOUND = "anchor long, seg long, lo int, hi int, window long"


def _compare(length: int):
    """Function for mapInArrow over (group, anchor, seg, split, bytes), sorted
    by group: rows with the covered ranges (window is null) and, for groups
    dealt over blocks, one row for each distinct window of the block."""

    def block(rows):
        texts = [r[4] for r in rows]
        found = {c: [] for c in ("anchor", "seg", "lo", "hi", "window")}

        def add(*values):
            for c, v in zip(found.values(), values, strict=True):
                c.append(v)

        windows: dict[tuple[int, int], None] = {}
        for r, starts in zip(rows, repeated_starts(texts, length), strict=True):
            for lo, hi in _ranges(starts, length):
                add(r[1], r[2], lo, hi, None)
            if r[3]:
                at = np.arange(len(r[4]) - length + 1)
                values = ts.char_values(np.frombuffer(r[4], dtype=np.uint8))
                for lo, h in enumerate(ts.span_hash(values, at, at + length).view(np.int64).tolist()):
                    if (r[0], h) not in windows:
                        windows[(r[0], h)] = None
                        add(r[1], r[2], lo, lo + length, h)
        return pa.RecordBatch.from_arrays([pa.array(found["anchor"], pa.int64()), pa.array(found["seg"], pa.int64()),
                                           pa.array(found["lo"], pa.int32()), pa.array(found["hi"], pa.int32()),
                                           pa.array(found["window"], pa.int64())], names=list(found))

    def scan(batches):
        rows: list[tuple] = []
        held, group = 0, None
        for batch in batches:
            for r in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                if r[0] != group and held >= BLOCK_BYTES:
                    yield block(rows)
                    rows, held = [], 0
                group = r[0]
                rows.append(r)
                held += len(r[4])
        if rows:
            yield block(rows)

    return scan


# -- the operator ------------------------------------------------------------

def _same_doc(a: DataFrame, b: DataFrame):
    return a.doc_id.eqNullSafe(b.doc_id) & (a.dh == b.dh)


def _with_hash(docs: DataFrame) -> DataFrame:
    """doc_id, dh, text: the text's hash tells rows that repeat a doc_id apart."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("dh", T.LongType()), T.StructField("text", T.StringType())])

    def scan(batches):
        for batch in batches:
            hashes = [_text_hashes(data, bounds) for _, data, bounds in _byte_chunks(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(hashes) if hashes else np.zeros(0, np.int64)),
                                              batch.column(1)], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(scan, schema)


def repeated_spans(docs: DataFrame, length: int = LENGTH, split: int = SPLIT) -> DataFrame:
    """(doc_id, dh, lo, hi): byte ranges that cover exactly the windows that
    start twice or more; ranges may overlap."""
    places = written(find_segments(docs, length))
    distinct = written(places.groupBy("anchor", "seg").agg(
        F.count("*").alias("n"), F.min(F.struct("dh", "doc_id", "start", "size")).alias("rep")))
    # equal segments: all of them is repeated
    copies = written(distinct.filter("n > 1").select("anchor", "seg"))
    equal = places.join(copies, ["anchor", "seg"]).select("doc_id", "dh", F.col("start").alias("lo"), F.expr("start + size").alias("hi"))

    # different segments around equal anchors
    groups = written(distinct.groupBy("anchor").agg(F.count("*").alias("segs")).filter("segs > 1"))
    parts = F.ceil(F.col("segs") / split)
    mixed = written(distinct.join(groups, "anchor").select(
        "anchor", "seg", "n", "rep.*", (F.col("segs") > split).alias("split"),
        F.when(F.col("segs") > split, F.xxhash64("anchor", F.pmod(F.xxhash64("seg"), parts))).otherwise(F.col("anchor")).alias("grp")))
    wanted = mixed.groupBy("doc_id", "dh").agg(F.collect_list(F.struct("grp", "anchor", "seg", "split", "start", "size")).alias("w"))
    texts = _with_hash(docs)
    wanted = written(wanted)
    cut = (texts.join(wanted.withColumnsRenamed({"doc_id": "_id", "dh": "_dh"}), texts.doc_id.eqNullSafe(F.col("_id")) & (texts.dh == F.col("_dh")))
           .select(F.encode("text", "utf-8").alias("b"), F.explode("w").alias("w"))
           .select("w.grp", "w.anchor", "w.seg", "w.split", F.expr("substring(b, w.start + 1, w.size)").alias("bytes")))
    # rows that repeat doc_id and text give a segment twice; the work goes with
    # the bytes to sort, so they set the number of tasks
    work = mixed.agg(F.sum("size").alias("n")).first().n or 0
    found = written(cut.repartition(max(1, math.ceil(work / TASK_BYTES)), "grp").sortWithinPartitions("grp", "anchor", "seg").mapInArrow(_once(_compare(length)), _FOUND))
    ranges = found.filter("window is null").select("anchor", "seg", "lo", "hi")
    windows = found.filter("window is not null")
    met = written(windows.groupBy("anchor", "window").agg(F.count("*").alias("blocks")).filter("blocks > 1").select("anchor", "window"))
    ranges = ranges.union(windows.join(met, ["anchor", "window"]).select("anchor", "seg", "lo", "hi"))
    single = mixed.filter("n = 1").select("anchor", "seg", "doc_id", "dh", "start")
    differing = ranges.join(single, ["anchor", "seg"]).select("doc_id", "dh", F.expr("start + lo").alias("lo"), F.expr("start + hi").alias("hi"))
    return equal.union(differing)


def _once(scan):
    """Drops a row that repeats the row before it."""

    def without_repeats(batches):
        last = None
        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True))
            keep = [k for k in range(len(keys)) if keys[k] != (keys[k - 1] if k else last)]
            last = keys[-1] if keys else last
            yield batch if len(keep) == len(keys) else batch.take(pa.array(keep, pa.int64()))

    return lambda batches: scan(without_repeats(batches))


def remove_repeats(docs: DataFrame, length: int = LENGTH, split: int = SPLIT) -> DataFrame:
    """doc_id, n_bytes, removed (merged [lo, hi) byte ranges), kept (the
    remaining bytes) of every document."""
    docs = pick(docs, "doc_id", "text")
    spans = written(repeated_spans(docs, length, split).groupBy("doc_id", "dh").agg(F.collect_set(F.array("lo", "hi")).alias("spans"))
                    .withColumnsRenamed({"doc_id": "_id", "dh": "_dh"}))
    texts = _with_hash(docs)
    joined = texts.join(spans, texts.doc_id.eqNullSafe(F.col("_id")) & (texts.dh == F.col("_dh")), "left").select("doc_id", "text", "spans")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_bytes", T.LongType()),
                           T.StructField("removed", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("kept", T.BinaryType())])

    def cut(batches):
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, spans in zip(ts.texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                merged: list[list[int]] = []
                for lo, hi in sorted(spans or ()):
                    if merged and lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], hi)
                    else:
                        merged.append([lo, hi])
                out, at = [], 0
                for lo, hi in merged:
                    out.append(text[at:lo])
                    at = hi
                sizes.append(len(text))
                removed.append(merged)
                kept.append(b"".join([*out, text[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()),
                                              pa.array(removed, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())], names=schema.names)

    return joined.mapInArrow(cut, schema)
