r"""Substring dedup by line or paragraph hashing (operator 9).

Texts are cut into units, each unit is normalised (A-Z to lower case, white
space collapsed) and hashed to 128 bits, digests are grouped over the whole
corpus, the earliest occurrence by (doc_id, place in the text) stays and every
later one is removed. Offsets refer to the original text.

Units: "paragraph" (blank lines part them), "line", or "piece": lines cut where
the hash of a word and the one before it is the least among its neighbours, so
that the borders follow from the passage's own words and realign inside every
copy of it, whatever stands around it. A piece has half of `min_words` words at
least and MAX_WORDS and a few at most; two neighbouring pieces of a line, or the
only one, make a unit, so units overlap and a piece goes if one of its units
stands earlier. The earliest place of a piece always stays: an earlier place of
a unit would be an earlier place of the piece too. What is lost of a repeated
passage are the words before its first and after its last common border.
Units of fewer than `min_words` words are never removed. Letters of scripts
without spaces between words (UNSPACED) count as words.

Only digests that occur twice or more are joined back, the earliest place of
each against all of its places; both sides are plain scans, so a unit that
stands in a third of the documents is split by adaptive execution.

Defined results: null and empty texts have no units; rows without doc_id rank
last and, like rows that repeat a doc_id and a place, keep what they share at
the earliest rank; output columns replace input columns of the same name.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.llm import textscan as ts
from recsmith.llm.common import by_place, written

MIN_WORDS = 8
UNIT = "piece"
#: Words after which a piece without a border is cut (a text that repeats a few words).
MAX_WORDS = 24
#: Thai to Myanmar, Khmer, kana and Han, and the selectors that follow them.
UNSPACED = ((0x0E00, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
            (0xF900, 0xFAFF), (0xFE00, 0xFE0F), (0xFF66, 0xFF9F), (0x20000, 0x323AF), (0xE0100, 0xE01EF))


@cache
def _classes() -> np.ndarray:
    """For each code point: 0 other, 1 in UNSPACED, 2 a letter or digit there."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for lo, hi in UNSPACED:
        out[lo:hi + 1] = [2 if unicodedata.category(chr(c))[0] in "LN" else 1 for c in range(lo, hi + 1)]
    return out


def _words(chunk: ts.Chunk, codes: np.ndarray) -> ts.Words:
    """Words between blanks, and each letter of an unspaced script with the
    marks and stops after it."""
    found = ts.words(chunk, ~ts.is_blank(codes))
    if len(codes) == 0 or codes.max() < UNSPACED[0][0]:
        return found
    kind = _classes()[codes]
    inner = kind == 2
    inner[1:] |= (kind[1:] == 0) & (kind[:-1] > 0) & ~ts.is_blank(codes[1:])
    starts = np.union1d(found.starts, np.flatnonzero(inner))
    ends = np.append(starts[1:], len(codes))
    return ts.Words(starts, np.minimum(ends, found.ends[np.searchsorted(found.starts, starts, side="right") - 1]),
                    np.searchsorted(starts, chunk.bounds, side="left"))


def _borders(hashes: np.ndarray, hard: np.ndarray, half: int) -> np.ndarray:
    """Flags of the words that begin a piece; `hard` flags those that begin a
    line. Borders are `half` words apart and away from line ends."""
    k = len(hashes)
    line = np.cumsum(hard)
    at = np.arange(k)
    edge = np.append(np.flatnonzero(hard), k)
    value = np.full(k, np.iinfo(np.uint64).max, dtype=np.uint64)
    value[1:] = ts.span_hash(hashes, at[:-1], at[1:] + 1)
    value[hard] = np.iinfo(np.uint64).max  # no word before it in its line
    head = (at - edge[line - 1] >= half) & (edge[line] - at >= half)
    for j in range(1, half):
        apart = line[j:] != line[:-j]
        less = value[j:] < value[:-j]
        head[j:] &= less | apart
        head[:k - j] &= ~less | apart
    head |= hard
    first = np.flatnonzero(head)
    size = np.diff(np.append(first, k))
    more = np.maximum(size - half, 0) // MAX_WORDS  # leaves `half` words to the last one
    step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    head[np.repeat(first, more) + step * MAX_WORDS] = True
    return head


def chunk_units(chunk: ts.Chunk, unit: str, min_words: int) -> tuple[np.ndarray, ...]:
    """(document, start, end, words, digest as two uint64 columns, pieces) of
    the unit that begins at each piece of a chunk; a unit's end is the end of its
    last word. The last of several pieces of a line begins none: 0 pieces."""
    codes = ts.lower_ascii(chunk.codes)
    found = _words(chunk, codes)
    hashes = ts.strong_hash(ts.char_values(codes), found.starts, found.ends)
    doc = found.doc
    k = len(hashes)
    if k == 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros((0, 2), np.uint64), none
    newlines = np.concatenate([[0], np.cumsum(codes == 10)])
    gap = newlines[found.starts[1:]] - newlines[found.ends[:-1]]  # line ends before each word but the first
    hard = np.concatenate([[True], (doc[1:] != doc[:-1]) | (gap >= (2 if unit == "paragraph" else 1))])
    first = np.flatnonzero(_borders(hashes, hard, max(1, (min_words + 1) // 2)) if unit == "piece" else hard)
    n = len(first)
    ends_line = np.append(hard[first[1:]], True)
    pieces = np.where(~ends_line, 2, np.where(hard[first], 1, 0))
    last = np.append(first, k)[np.arange(n) + pieces]
    digest = np.stack([ts.strong_hash(hashes, first, last), ts.strong_hash(ts.mix(hashes + np.uint64(0x632BE59BD9B4E019)), first, last)], axis=1)
    start, end = found.starts[first], found.ends[np.maximum(last - 1, first)]
    base = chunk.bounds[doc[first]]
    return doc[first], start - base, end - base, last - first, digest, pieces


def _binary(digest: np.ndarray) -> pa.Array:
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(digest), [None, pa.py_buffer(np.ascontiguousarray(digest).tobytes())])
    return fixed.cast(pa.binary())


def units(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    """(digest, doc_id, place) of the units that count."""
    schema = T.StructType([T.StructField("digest", T.BinaryType()), docs.schema["doc_id"], T.StructField("place", T.IntegerType())])

    def scan(batches):
        for batch in batches:
            for chunk in ts.chunks(batch.column(1)):
                doc, start, _, size, digest, pieces = chunk_units(chunk, unit, min_words)
                long = (pieces > 0) & (size >= min_words)
                ids = batch.column(0).slice(chunk.row, chunk.n).take(pa.array(doc[long]))
                yield pa.RecordBatch.from_arrays([_binary(digest[long]), ids, pa.array(start[long].astype(np.int32))],
                                                 names=["digest", "doc_id", "place"])

    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def repeats(docs: DataFrame, unit: str = UNIT, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, drop): for each document with something to remove, the
    (place, digest) of its units that stand earlier elsewhere. Null ids come
    as null."""
    found = units(docs, unit, min_words)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")
    earliest = written(found.groupBy("digest").agg(F.min(rank).alias("e"), F.count("*").alias("n"))
                       .filter("n > 1").select("digest", "e"))
    later = found.join(earliest, "digest").filter(
        ~(F.col("doc_id").eqNullSafe(F.col("e.doc_id")) & (F.col("place") == F.col("e.place"))))
    return later.groupBy("doc_id").agg(F.collect_set(F.struct("place", "digest")).alias("_drop"))


def dedup_units(docs: DataFrame, unit: str = UNIT, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with text reduced to what stays, and the columns n_units,
    n_removed (of pieces, lines or paragraphs) and removed: [start, end) offsets in
    the original text of the removed ones (each up to the next one)."""
    names = [c for c in docs.columns if c not in ("n_units", "n_removed", "removed")]
    drop = written(repeats(docs, unit, min_words)).withColumnRenamed("doc_id", "_id")
    kept = docs.select(*[F.col(f"`{c}`") for c in names])
    side = by_place(kept)
    joined = side.join(drop, F.col(f"_c{names.index('doc_id')}").eqNullSafe(F.col("_id")), "left").drop("_id")
    schema = T.StructType(list(kept.schema))
    for name, kind in (("n_units", T.LongType()), ("n_removed", T.LongType()), ("removed", T.ArrayType(T.ArrayType(T.LongType())))):
        schema = schema.add(name, kind)
    at = names.index("text")

    def scan(batches):
        for batch in batches:
            for chunk in ts.chunks(batch.column(at)):
                columns = [batch.column(i).slice(chunk.row, chunk.n) for i in range(len(names) + 1)]
                texts, wanted = columns[at].to_pylist(), columns.pop().to_pylist()
                n_units, n_removed, removed = [], [], []
                doc, start, _, _, digest, pieces = chunk_units(chunk, unit, min_words)
                first = np.searchsorted(doc, np.arange(chunk.n + 1))
                for d in range(chunk.n):
                    lo, hi = int(first[d]), int(first[d + 1])
                    n_units.append(hi - lo)
                    cut: list[list[int]] = []
                    count = 0
                    if wanted[d]:
                        bad = {(w["place"], bytes(w["digest"])) for w in wanted[d]}
                        length = int(chunk.bounds[d + 1] - chunk.bounds[d])
                        upto = lo  # pieces before it belong to a unit that goes
                        for k in range(lo, hi):
                            if pieces[k] and (int(start[k]), digest[k].tobytes()) in bad:
                                upto = k + int(pieces[k])
                            if k < upto:
                                count += 1
                                end = int(start[k + 1]) if k + 1 < hi else length
                                if cut and cut[-1][1] == start[k]:
                                    cut[-1][1] = end
                                else:
                                    cut.append([int(start[k]), end])
                        texts[d] = _without(texts[d], cut)
                    n_removed.append(count)
                    removed.append(cut)
                columns[at] = pa.array(texts, pa.string()).cast(columns[at].type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n_units, pa.int64()), pa.array(n_removed, pa.int64()),
                                                  pa.array(removed, pa.list_(pa.list_(pa.int64())))],
                                                 names=[*names, "n_units", "n_removed", "removed"])

    return joined.select(*side.columns, "_drop").mapInArrow(scan, schema)


def _without(text: str, cut: list[list[int]]) -> str:
    out, at = [], 0
    for lo, hi in cut:
        out.append(text[at:lo])
        at = hi
    return "".join([*out, text[at:]])


def dedup_filter(docs: DataFrame, unit: str = UNIT, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with the remaining texts and n_chars (if there) of them; documents
    of which nothing but white space stays go."""
    found = dedup_units(docs, unit, min_words)
    touched: Column = F.col("n_removed") > 0
    out = []
    for c in docs.columns:
        column = F.col(f"`{c}`")
        if c == "n_chars":
            column = F.when(touched, F.length("text")).otherwise(column).cast(docs.schema[c].dataType)
        out.append(column.alias(c))
    return found.filter(~(touched & (F.regexp_replace("text", r"\s", "") == ""))).select(*out)
