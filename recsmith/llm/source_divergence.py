"""Source divergence audit by chunk factorization (operator 11).

How far apart are the vocabularies of the sources of a language? Texts are cut
at white space into chunks, and the chunks of each document are counted. Each
globally distinct chunk is cut into its terms once, and the terms are joined
back to the documents' counts, where distinct documents and occurrences are
aggregated. A chunk may hold several terms, and several chunks of a document
the same term, so documents are counted on terms, not added up over chunks.

The documents of a block (a bounded number of words) share a numbered list of
their chunks. The lists go in packed rows to buckets of chunks, where equal chunks
of all blocks meet; the (number, term) pairs come back to their block, which
counts documents and occurrences per source. These counts go in packed rows to
buckets of terms, and parts of many blocks are added up FAN_IN at a time, so
that a chunk or term of every document is a few numbers a block. The number
of buckets grows with the bytes of text.

Terms in at least MIN_DOCS documents of a language are kept. A source gives a
kept term the smoothed share 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V)),
in exact integers. Pairs of sources are compared by the sum of the absolute
differences over all kept terms, computed in blocks of terms and sources; terms
that neither source has are added in closed form.

Defined results: null text, lang and source are empty strings; a source without
terms is a group with counts of zero; without kept terms all pairs are 0; equal
values rank by item in UTF-8 order; repeated rows and ids are documents of
their own; a very long text is a block of its own, so memory follows the longest
text; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.llm import textscan as ts
from recsmith.llm.common import pick, written

# Fixed values of the contract.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_DOCS, PRIOR, SCALE, TOP = 30, 5, 1_000_000_000, 50

#: Words of the texts of a block, and bytes of text looked at together.
BLOCK_WORDS, RUN_BYTES = 1 << 20, 1 << 22
#: Bytes of text for each bucket of chunks and of terms; parts of a bucket that are added up at once.
BUCKET_BYTES, FAN_IN = 1 << 23, 64
#: Terms (expected) and sources of a block of the pairwise comparison.
TERM_BLOCK, SOURCE_BLOCK = 4096, 128


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as their low bytes, then the next ones, and so on:
    the high bytes of small numbers compress to nothing."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _buckets(strings: pa.Array, count: int) -> np.ndarray:
    """A bucket for each string, from its bytes (equal strings, equal buckets)."""
    _, offsets, data = strings.cast(pa.large_string()).buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[strings.offset:strings.offset + len(strings) + 1]
    if len(strings) == 0:
        return np.zeros(0, dtype=np.int64)
    values = np.frombuffer(data, dtype=np.uint8)[bounds[0]:bounds[-1]].astype(np.uint64) + np.uint64(1)
    return (ts.span_hash(values, bounds[:-1] - bounds[0], bounds[1:] - bounds[0]) % np.uint64(count)).astype(np.int64)


def _sorted_strings(coded: pa.DictionaryArray) -> tuple[np.ndarray, pa.Array]:
    """(codes, strings) of a dictionary array with the strings in order:
    neighbours that share a beginning compress."""
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(coded.dictionary), dtype=np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return rank[coded.indices.to_numpy()], coded.dictionary.take(order)


def _chunk_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(document, chunk number, times) of each distinct pair, and the chunks."""
    cut = pc.ascii_split_whitespace(texts)
    words = cut.flatten()
    doc = np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy()))
    full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    coded = words.dictionary_encode()
    code = coded.indices.to_numpy()
    if not full.all():  # blanks at the ends of a text
        doc, code = doc[full], code[full]
    keys, times = np.unique(doc * len(coded.dictionary) + code, return_counts=True)
    return keys // max(len(coded.dictionary), 1), keys % max(len(coded.dictionary), 1), times, coded.dictionary


_COUNTED = "block long, bucket int, langs array<string>, sources array<string>, sizes binary, entries binary, times binary, chunks array<string>"


class _Block:
    """Documents with counted chunks, the chunks numbered."""

    def __init__(self):
        self.at: int | None = None
        self.words = self.docs = 0
        self.runs: list[tuple] = []

    def add(self, row: int, texts: pa.Array, lang: pa.Array, source: pa.Array) -> None:
        doc, code, times, chunks = _chunk_counts(texts)
        if self.at is None:
            self.at = row
        self.runs.append((doc + self.docs, code, times, chunks, lang, source))
        self.docs += len(texts)
        self.words += int(times.sum())

    def rows(self, buckets: int):
        """One batch with a row for the documents and one for each bucket of chunks."""
        renumber, chunks = _sorted_strings(pa.chunked_array([r[3] for r in self.runs]).dictionary_encode().combine_chunks())
        at, code = 0, []
        for r in self.runs:
            code.append(renumber[at:at + len(r[3])][r[1]])
            at += len(r[3])
        doc, times = np.concatenate([r[0] for r in self.runs]), np.concatenate([r[2] for r in self.runs])
        entries = np.concatenate(code)
        langs, sources = (pa.chunked_array([r[k] for r in self.runs]).combine_chunks() for k in (4, 5))
        # frequent chunks get the small numbers: they take the fewest bytes
        times_seen = np.bincount(entries, minlength=len(chunks))
        number = np.empty(len(chunks), dtype=np.int64)
        number[np.argsort(-times_seen, kind="stable")] = np.arange(len(chunks))
        entries = number[entries]
        out = [(self.at, None, langs, sources, _planes(np.bincount(doc, minlength=self.docs)), _planes(entries), _planes(times), None)]
        where = _buckets(chunks, buckets)
        order = np.argsort(where, kind="stable")
        ends = np.searchsorted(where[order], np.arange(buckets + 1))
        for k in range(buckets):
            part = order[ends[k]:ends[k + 1]]
            if len(part):
                out.append((self.at, k, None, None, None, _planes(number[part]), None, chunks.take(pa.array(part))))
        return _batches(out, _COUNTED)


def _batches(rows: list[tuple], schema: str):
    """Record batches of one row each (rows are large); lists are Arrow arrays."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    fields = [f.split(" ") for f in schema.split(", ")]
    for row in rows:
        columns = []
        for value, (_, kind) in zip(row, fields, strict=True):
            if isinstance(value, pa.Array):
                columns.append(pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value.cast(pa.string())))
            else:
                columns.append(pa.array([value], kinds[kind]))
        yield pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    empty = pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in schema.split(", "))])
    return pa.Table.from_batches(list(_batches(rows, schema)), empty)


def counted_chunks(docs: DataFrame, buckets: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Two kinds of rows of a block: its documents with the numbers and times of
    their chunks (`bucket` null), and the chunks of a bucket with their numbers."""
    source = docs.select(F.monotonically_increasing_id().alias("row"),
                         *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])

    def scan(batches):
        block = _Block()
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy().astype(np.int64))
            lo = 0
            while lo < batch.num_rows:  # bounded bytes at a time, whole texts
                start = int(size[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(size, start + RUN_BYTES, side="right")))
                part = batch.slice(lo, hi - lo)
                block.add(part.column(0)[0].as_py(), part.column(1), part.column(2), part.column(3))
                lo = hi
                if block.words >= block_words:
                    yield from block.rows(buckets)
                    block = _Block()
        if block.docs:
            yield from block.rows(buckets)

    return source.mapInArrow(scan, _COUNTED)


_PATTERN = re.compile(TERM)
_TO_LOWER = str.maketrans(UPPER, LOWER)


def terms_of(chunk: str) -> list[str]:
    """The terms of a chunk in their order, repeated ones included."""
    return _PATTERN.findall(chunk.translate(_TO_LOWER) if not chunk.islower() else chunk)


_TERMS = "place long, entries binary, many binary, terms array<string>"


def _tokenize(group: pa.Table) -> pa.Table:
    """The chunks of one bucket, of all blocks: each distinct one is cut into
    its terms once, and every block gets (entry, term) for its own."""
    lists = group.column("chunks").combine_chunks()
    coded = lists.flatten().dictionary_encode()
    found = [terms_of(c) for c in coded.dictionary.to_pylist()]
    many = np.array([len(f) for f in found], dtype=np.int64)
    term, terms = _sorted_strings(pa.array([t for f in found for t in f], pa.string()).dictionary_encode())
    del found
    first = np.cumsum(many) - many
    bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    code, out = coded.indices.to_numpy(), []
    for k, (block, entries) in enumerate(zip(group.column("block").to_pylist(), group.column("entries").to_pylist(), strict=True)):
        own = code[bounds[k]:bounds[k + 1]]
        n = many[own]
        spot = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        own = term[spot]
        order = np.argsort(own, kind="stable")
        used, times = np.unique(own, return_counts=True)
        if len(used):
            out.append((block, _planes(np.repeat(_numbers(entries), n)[order]), _planes(times), terms.take(pa.array(used))))
    return _table(out, _TERMS)


_PARTS = "bucket int, part long, langs array<string>, sources array<string>, terms array<string>, term binary, grp binary, docs binary, count binary"


def _packed(langs: pa.Array, sources: pa.Array, terms: pa.Array, term: np.ndarray, group: np.ndarray, docs: np.ndarray, count: np.ndarray,
            part: int, buckets: int) -> pa.Table:
    """Counts per (term, group), in the order of the terms, dealt into buckets
    of terms, a row for each. Numbers beyond 32 bits go as two."""
    where = _buckets(terms, buckets)
    order = np.argsort(where[term], kind="stable")
    ends = np.searchsorted(where[term][order], np.arange(buckets + 1))
    out = []
    for k in range(buckets):
        rows = order[ends[k]:ends[k + 1]]
        if len(rows):
            used, times = np.unique(term[rows], return_counts=True)  # rows come in the order of the terms
            high, low = np.divmod(np.concatenate([docs[rows], count[rows]]), 1 << 32)
            half = len(rows)
            out.append((k, part, langs, sources, terms.take(pa.array(used)), _planes(times), _planes(group[rows]),
                        _planes(np.concatenate([low[:half], high[:half]])), _planes(np.concatenate([low[half:], high[half:]]))))
    return _table(out, _PARTS)


def _wide(data: bytes) -> np.ndarray:
    low, high = np.split(_numbers(data), 2)
    return low + (high << 32)


def _add_up(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys, in order, and the sums of the values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    return key[new], [np.add.reduceat(v[order], new) if len(new) else v[:0] for v in values]


def _count_block(buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Distinct documents and occurrences per (term, source) of a block."""
        if left.num_rows == 0 or right.num_rows == 0:
            return _table([], _PARTS)
        row = left.to_pylist()[0]
        lists = right.column("terms").combine_chunks()
        code, terms = _sorted_strings(lists.flatten().dictionary_encode())
        size = lists.value_lengths().to_numpy()
        shift, entry, term = np.cumsum(size) - size, [], []
        for k, (entries, many) in enumerate(zip(right.column("entries").to_pylist(), right.column("many").to_pylist(), strict=True)):
            entry.append(_numbers(entries))
            term.append(np.repeat(code[shift[k]:shift[k] + size[k]], _numbers(many)))
        entry, term = np.concatenate(entry), np.concatenate(term)
        order = np.argsort(entry, kind="stable")
        entry, term = entry[order], term[order]
        sizes, have, times = (_numbers(row[c]) for c in ("sizes", "entries", "times"))
        first = np.searchsorted(entry, np.arange(int(have.max(initial=-1)) + 2))
        n = (first[1:] - first[:-1])[have]
        spot = np.repeat(first[have] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        width = len(terms)
        doc = np.repeat(np.repeat(np.arange(len(sizes)), sizes), n)
        key, (amount,) = _add_up(doc * width + term[spot], np.repeat(times, n))
        tongue, origin = (pa.array(row[c], pa.string()).dictionary_encode() for c in ("langs", "sources"))
        both = tongue.indices.to_numpy().astype(np.int64) * len(origin.dictionary) + origin.indices.to_numpy()
        groups, group = np.unique(both, return_inverse=True)
        key, (docs, count) = _add_up((key % width) * len(groups) + group[key // width], np.ones(len(key), dtype=np.int64), amount)
        return _packed(tongue.dictionary.take(pa.array(groups // len(origin.dictionary))), origin.dictionary.take(pa.array(groups % len(origin.dictionary))),
                       terms, key // len(groups), key % len(groups), docs, count, row["block"], buckets)

    return run


def _merged(group: pa.Table) -> tuple[pa.Array, pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The parts of one bucket added up: (langs, sources, terms, term, group, docs, count)."""
    coded = {c: group.column(c).combine_chunks() for c in ("langs", "sources", "terms")}
    index = {c: v.flatten().dictionary_encode() for c, v in coded.items()}
    at = {c: np.cumsum(v.value_lengths().to_numpy()) - v.value_lengths().to_numpy() for c, v in coded.items()}
    width = len(index["sources"].dictionary)
    term, both, docs, count = [], [], [], []
    for k, row in enumerate(group.select(["term", "grp", "docs", "count"]).to_pylist()):
        own = _numbers(row["grp"])
        times = _numbers(row["term"])
        term.append(np.repeat(index["terms"].indices.to_numpy()[at["terms"][k]:at["terms"][k] + len(times)].astype(np.int64), times))
        both.append(index["langs"].indices.to_numpy()[at["langs"][k] + own].astype(np.int64) * width + index["sources"].indices.to_numpy()[at["sources"][k] + own])
        docs.append(_wide(row["docs"]))
        count.append(_wide(row["count"]))
    groups, which = np.unique(np.concatenate(both), return_inverse=True)
    key, (d, c) = _add_up(np.concatenate(term) * len(groups) + which, np.concatenate(docs), np.concatenate(count))
    return (index["langs"].dictionary.take(pa.array(groups // width)), index["sources"].dictionary.take(pa.array(groups % width)),
            index["terms"].dictionary, key // len(groups), key % len(groups), d, c)


def _kept_terms(min_docs: int):
    def run(group: pa.Table) -> pa.Table:
        """(lang, source, term, count) of the terms in enough documents of a language."""
        langs, sources, terms, term, which, docs, count = _merged(group)
        tongue = langs.dictionary_encode()
        own = tongue.indices.to_numpy().astype(np.int64)[which]
        key, (total,) = _add_up(term * len(tongue.dictionary) + own, docs)
        good = total[np.searchsorted(key, term * len(tongue.dictionary) + own)] >= min_docs
        return pa.table([langs.take(pa.array(which[good])), sources.take(pa.array(which[good])), terms.take(pa.array(term[good])), pa.array(count[good])],
                        names=["lang", "source", "term", "count"])

    return run


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS, block_words: int = BLOCK_WORDS, bucket_bytes: int = BUCKET_BYTES,
                fan_in: int = FAN_IN) -> DataFrame:
    """(lang, source, term, count): occurrences of the kept terms."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string"))).alias("n")).first().n or 0
    buckets = max(1, math.ceil(size / bucket_bytes))
    counted = written(counted_chunks(docs, buckets, block_words), "zstd")
    texts = counted.filter("bucket is null").select("block", "langs", "sources", "sizes", "entries", "times")
    terms = (counted.filter("bucket is not null").select("bucket", "block", "entries", "chunks")
             .groupBy("bucket").applyInArrow(_tokenize, _TERMS))
    parts = written(texts.groupBy("block").cogroup(terms.groupBy("place")).applyInArrow(_count_block(buckets), _PARTS), "zstd", tidy=True)

    def merge(group: pa.Table) -> pa.Table:
        return _packed(*_merged(group), int(group.column("to")[0].as_py()), 1).drop_columns("bucket").add_column(
            0, "bucket", group.column("bucket").slice(0, 1))

    left = texts.count()
    while left > fan_in:  # a term of every block is added up step by step
        left = math.ceil(left / fan_in)
        parts = written(parts.withColumn("to", F.pmod(F.xxhash64("part"), F.lit(left))).groupBy("bucket", "to").applyInArrow(merge, _PARTS), "zstd", tidy=True)
    return parts.groupBy("bucket").applyInArrow(_kept_terms(min_docs), "lang string, source string, term string, count long")


def _share(count: Column, n: Column, v: Column) -> Column:
    """The smoothed share in exact integers (the product may pass 64 bits)."""
    top = (count + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", top, (n + PRIOR * v).cast("decimal(20,0)")) + 1


def source_shares(docs: DataFrame, min_docs: int = MIN_DOCS, **sizes: int) -> tuple[DataFrame, DataFrame]:
    """Groups (lang, source, place, n, v, none: the share of a term that the
    source does not have) and entries (lang, source, term, p, q: the language's
    share) of the kept terms that a source has. Both are written tables."""
    counts = written(term_counts(docs, min_docs, **sizes), tidy=True)
    kept = counts.select("lang", "term").distinct()
    occurring = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    by_lang = Window.partitionBy("lang").orderBy("source")
    groups = (occurring.join(counts.groupBy("lang", "source").agg(F.sum("count").alias("n")), ["lang", "source"], "left")
              .join(kept.groupBy("lang").agg(F.count("*").alias("v")), "lang", "left").fillna(0, ["n", "v"])
              .withColumn("place", F.row_number().over(by_lang) - 1))
    groups = written(groups.withColumn("none", F.when(F.col("v") > 0, _share(F.lit(0), F.col("n"), F.col("v"))).otherwise(F.lit(0))))
    langs = groups.groupBy("lang").agg(F.sum("n").alias("ln"), F.first("v").alias("lv"))
    whole = (counts.groupBy("lang", "term").agg(F.sum("count").alias("lc")).join(langs, "lang")
             .select("lang", "term", _share(F.col("lc"), F.col("ln"), F.col("lv")).alias("q")))
    entries = (counts.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("count"), F.col("n"), F.col("v")))
               .join(whole, ["lang", "term"]).select("lang", "source", "place", "term", "p", "q"))
    return groups, written(entries)


def source_distances(groups: DataFrame, entries: DataFrame, term_block: int = TERM_BLOCK, source_block: int = SOURCE_BLOCK) -> DataFrame:
    """(lang, source, item, value): the summed difference of each two sources of
    a language, over all its kept terms."""
    blocks = F.when(F.col("v") > 0, F.ceil(F.col("v") / term_block)).otherwise(0).cast("int")
    langs = groups.groupBy("lang").agg(F.max(blocks).alias("cuts"), F.max(F.floor(F.col("place") / source_block)).cast("int").alias("last"))
    # every block of terms knows what its sources give a term they do not have
    anchors = (groups.join(langs, "lang").filter("cuts > 0")
               .select("lang", "place", F.lit(None).cast("string").alias("term"), F.col("none").alias("p"), "last",
                       F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut")))
    have = entries.join(langs, "lang").select("lang", "place", "term", "p", "last",
                                              F.pmod(F.xxhash64("term"), F.col("cuts")).cast("int").alias("cut"))
    own = F.floor(F.col("place") / source_block).cast("int")
    met = (have.union(anchors).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
           .select("lang", "cut", F.least(own, "other").alias("a"), F.greatest(own, "other").alias("b"), "place", "term", "p"))
    names = ["lang", "place", "to", "value"]

    def compare(table: pa.Table) -> pa.Table:
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        place, p = table.column("place").to_numpy(), table.column("p").to_numpy()
        coded = table.column("term").combine_chunks().dictionary_encode()
        anchor = coded.is_null().to_numpy(zero_copy_only=False)
        order = np.argsort(place[anchor])
        spots, none = place[anchor][order], p[anchor][order]
        width = len(coded.dictionary)
        share = np.repeat(none[:, None], width, axis=1)
        term = coded.indices.filter(pa.array(~anchor)).to_numpy()
        share[np.searchsorted(spots, place[~anchor]), term] = p[~anchor]
        rows = [[], [], []]
        for g in np.flatnonzero(spots // source_block == a):
            to = np.flatnonzero((spots // source_block == b) & (spots > spots[g]))
            value = np.abs(share[to] - share[g]).sum(axis=1) - width * np.abs(none[to] - none[g])
            for column, x in zip(rows, (np.full(len(to), spots[g]), spots[to], value), strict=True):
                column.append(x)
        n = sum(len(x) for x in rows[0])
        columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in rows]
        return pa.table([pa.array([table.column("lang")[0].as_py()] * n, pa.string()), pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                         pa.array(columns[2], pa.int64())], names=names)

    half = (met.groupBy("lang", "cut", "a", "b").applyInArrow(compare, "lang string, place int, to int, value long")
            .groupBy("lang", "place", "to").agg(F.sum("value").alias("value")))
    both = half.union(half.select("lang", F.col("to").alias("place"), F.col("place").alias("to"), "value"))
    left = groups.select("lang", "source", "place", "v", F.col("none").alias("mine"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("to"), F.col("none").alias("theirs"))
    return (left.join(right, "lang").filter("place != to").join(both, ["lang", "place", "to"], "left")
            .select("lang", "source", "item", (F.coalesce("value", F.lit(0)) + F.col("v") * F.abs(F.col("mine") - F.col("theirs"))).alias("value")))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, term_block: int = TERM_BLOCK, source_block: int = SOURCE_BLOCK,
          **sizes: int) -> DataFrame:
    """lang, source, part, item, value, rank: the other sources of the language
    by distance (`pair`), and the `top` terms whose share is farthest above the
    language's (`term`). `sizes`: those of term_counts."""
    groups, entries = source_shares(pick(docs, "text", "lang", "source"), min_docs, **sizes)
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_distances(groups, entries, term_block, source_block).withColumn("rank", F.row_number().over(ranked))
    terms = (entries.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top))
    out = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*out).union(terms.withColumn("part", F.lit("term")).select(*out))
