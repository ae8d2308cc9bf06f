"""Alignment of two tokenizers by divide and conquer at shared cuts (operator 13).

A is a byte-level BPE vocabulary file, B a sentencepiece model; special tokens
are plain text for both. A text is encoded as space + text by A and as text by
B, which adds the space. Offsets at which a token of A and a token of B both
end are shared cuts. They are found by divide and conquer: the shared cut next
to the middle of an interval is located by bisecting the ends of the other
side, both halves follow, and an interval without a cut inside is one group.
All intervals of one depth, over many texts, take the step together.

The two tokens that end at a cut are a link. How often a pair of ids is linked
in the whole corpus is counted by Spark: texts are dealt into blocks of a
bounded number of links; a block adds up its own pairs, the sums of all blocks
are added per pair, and each block gets back the counts of its own pairs only.
So no table of pairs is broadcast or collected, a frequent pair has one row a
block, and memory is bounded by a block.

Defined results: null and empty texts, and texts whose decoded tokens differ
from space + text on either side, have no tokens (zeros, empty groups);
repeated rows and repeated or null doc_ids are rows of their own, and each
counts; among ids linked equally often to one id of B all are best (ties); a
very long text is a block of its own, so memory follows the longest text; an
empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.llm import textscan as ts
from recsmith.llm.bpe import TrieEncoder
from recsmith.llm.common import pick, written
from recsmith.llm.pretokens import Encoder, Vocabulary, WordCache

#: (text, pair) entries of a block.
BLOCK_LINKS = 1 << 21
#: The character that stands for a space in the pieces of a sentencepiece model.
MARK = "▁"


class ByteSide:
    """Token ids of texts by a byte-level BPE file, without special tokens."""

    def __init__(self, path: str):
        vocab = Vocabulary(path)
        vocab.special = {}
        trie = TrieEncoder(vocab)
        self.encoder = Encoder(vocab, lambda words: trie.encode([w.encode("utf-8") for w in words]))
        self.size = np.array([len(b) for b in vocab.bytes], dtype=np.int64)

    def encode(self, chunk: ts.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, bounds of the texts in them, bytes, bounds of the texts in those)."""
        return self.encoder.encode(chunk)


class PieceSide:
    """Token ids of texts by a sentencepiece model. Pieces hold the space mark
    only in front, so that a run of blanks and the word after it can be encoded
    apart from the rest, once for each distinct one; for a model with other
    pieces each text is encoded as a whole."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        parts = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode("utf-8")
                 for i, p in enumerate(pieces)]
        self.by_word = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.size = np.array([len(b) for b in parts], dtype=np.int64)
        self._at = np.cumsum(self.size) - self.size
        self._flat = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.cache = WordCache(self._words)

    def _words(self, words: list[str]) -> list[list[int]]:
        """Ids of words that start with the space which the model adds."""
        return self.model.encode([w[1:] for w in words], num_threads=1)

    def decode(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        shift = self._at[ids] - (np.cumsum(size) - size)
        return self._flat[np.repeat(shift, size) + np.arange(int(size.sum()))].tobytes()

    def encode(self, chunk: ts.Chunk, raw: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, bounds of the texts in them, whether each text's tokens join
        to its bytes); `raw` are the bytes of the chunk, `bounds` its texts in them."""
        codes, n = chunk.codes, chunk.n
        text = codes.tobytes().decode("utf-32-le")
        full = np.flatnonzero(np.diff(chunk.bounds) > 0)
        start = chunk.bounds[full]
        if self.by_word and len(codes):
            blank = codes == 0x20
            front = blank.copy()
            front[1:] &= ~blank[:-1]
            front[start] = True
            start = np.flatnonzero(front)
        end = np.append(start[1:], len(codes))
        if len(start) == 0:
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64), np.ones(n, dtype=bool)
        ids, size = self.cache.lookup(ts.span_hash(ts.char_values(codes), start, end), lambda k: text[start[k]:end[k]])
        ends = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(start, chunk.bounds)]
        ids, same = ids.copy(), np.ones(n, dtype=bool)
        if self.decode(ids) == raw:
            return ids, ends, same
        parts = []  # a text that the model does not give back, or two words of one hash
        for k in range(n):
            own = ids[ends[k]:ends[k + 1]]
            if self.decode(own) != raw[bounds[k]:bounds[k + 1]]:
                own = np.array(self._words([text[chunk.bounds[k]:chunk.bounds[k + 1]]])[0], dtype=np.int32)
                same[k] = self.decode(own) == raw[bounds[k]:bounds[k + 1]]
            parts.append(own)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]), same


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> tuple[ByteSide, PieceSide]:
    """One pair for each Python worker and pair of files."""
    return ByteSide(path_a), PieceSide(path_b)


def shared_cuts(end_a: np.ndarray, end_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Indices into `end_a`, in order, of the tokens whose end is an end in
    `end_b` too. Text k holds the tokens [first[k], last[k]] of A; the end of
    its last token is shared. Both arrays rise strictly."""
    found = [last]
    lo, hi = first.copy(), last.copy()  # cuts inside are sought among [lo, hi)
    while len(lo := lo[(some := lo < hi)]):
        hi = hi[some]
        mid = (lo + hi) // 2
        after = _next_cut(end_a, end_b, mid, hi)
        before = np.full(len(lo), -1, dtype=np.int64)
        none = np.flatnonzero(after < 0)  # no cut from the middle on
        before[none] = _previous_cut(end_a, end_b, mid[none] - 1, lo[none])
        found += [after[after >= 0], before[before >= 0]]
        left = np.where(after >= 0, mid, np.where(before >= 0, before, lo))
        right = np.where(after >= 0, after + 1, hi)
        lo, hi = np.concatenate([lo, right]), np.concatenate([left, hi])
    return np.sort(np.concatenate(found))


def _next_cut(end_a: np.ndarray, end_b: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The first shared cut in [at, stop) of each row, or -1: by turns, each
    side bisects for the first end that is not before the other's."""
    out, at, rows = np.full(len(at), -1, dtype=np.int64), at.copy(), np.arange(len(at))
    while len(rows):
        mine = end_a[at[rows]]
        other = end_b[np.searchsorted(end_b, mine)]
        hit = mine == other
        out[rows[hit]] = at[rows[hit]]
        rows = rows[~hit]
        at[rows] = np.searchsorted(end_a, other[~hit])
        rows = rows[at[rows] < stop[rows]]
    return out


def _previous_cut(end_a: np.ndarray, end_b: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The last shared cut in [stop, at] of each row, or -1."""
    out, at, rows = np.full(len(at), -1, dtype=np.int64), at.copy(), np.flatnonzero(at >= stop)
    while len(rows):
        mine = end_a[at[rows]]
        place = np.searchsorted(end_b, mine, side="right") - 1
        other = np.where(place >= 0, end_b[place], -1)
        hit = mine == other
        out[rows[hit]] = at[rows[hit]]
        rows = rows[~hit]
        at[rows] = np.searchsorted(end_a, other[~hit], side="right") - 1
        rows = rows[at[rows] >= stop[rows]]
    return out


@lru_cache(maxsize=4)
def _digits(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal numbers below `size`: (bytes, place of each, length of each)."""
    names = [b"%d" % i for i in range(size)]
    length = np.array([len(x) for x in names], dtype=np.int64)
    return np.frombuffer(b"".join(names), dtype=np.uint8), np.cumsum(length) - length, length


def group_texts(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray,
                closing: np.ndarray, vocab: int) -> tuple[bytes, np.ndarray]:
    """The groups as text, `a1,a2|b1;a3|b2,b3`, and its end after each group
    that closes a text (`closing`, indices of groups). Group g ends with the
    tokens cut_a[g] and cut_b[g]; ids are below `vocab`."""
    flat, place, length = _digits(vocab)
    in_a = np.diff(cut_a, prepend=-1)
    in_b = np.diff(cut_b, prepend=-1)
    ids = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    spot_a = np.arange(len(ids_a)) + np.repeat(np.cumsum(in_b) - in_b, in_a)
    spot_b = np.arange(len(ids_b)) + np.repeat(np.cumsum(in_a), in_b)
    ids[spot_a], ids[spot_b] = ids_a, ids_b
    sign = np.full(len(ids), ord(","), dtype=np.uint8)
    sign[spot_a[cut_a]] = ord("|")
    sign[spot_b[cut_b]] = ord(";")
    size = length[ids] + 1
    ends = np.cumsum(size)
    shift = place[ids] - (ends - size)
    spot = np.repeat(shift, size) + np.arange(int(ends[-1]) if len(ends) else 0)
    spot[ends - 1] = 0
    out = flat[spot]
    out[ends - 1] = sign
    return out.tobytes(), ends[spot_b[cut_b[closing]]]


def align_chunk(chunk: ts.Chunk, a: ByteSide, b: PieceSide) -> dict:
    """Counts, groups as text and linked pairs of the texts of a chunk; each
    text starts with the space that both sides add."""
    n = chunk.n
    ids_a, ends_a, data, byte_bounds = a.encode(chunk)
    ids_b, ends_b, same = b.encode(chunk, data.tobytes(), byte_bounds)
    good = same & (np.diff(chunk.bounds) > 1)
    doc_a, doc_b = np.repeat(np.arange(n), np.diff(ends_a)), np.repeat(np.arange(n), np.diff(ends_b))
    ids_a, ids_b, doc_a, doc_b = ids_a[good[doc_a]], ids_b[good[doc_b]], doc_a[good[doc_a]], doc_b[good[doc_b]]
    end_a, end_b = np.cumsum(a.size[ids_a]), np.cumsum(b.size[ids_b])
    which = np.flatnonzero(good)
    first, last = np.searchsorted(doc_a, which), np.searchsorted(doc_a, which, side="right") - 1
    cut_a = shared_cuts(end_a, end_b, first, last)
    cut_b = np.searchsorted(end_b, end_a[cut_a])
    doc = doc_a[cut_a]
    closing = np.searchsorted(doc, which, side="right") - 1
    text, ends = group_texts(ids_a, ids_b, cut_a, cut_b, closing, max(len(a.size), len(b.size)))
    groups, at = [b""] * n, 0
    for k, end in zip(which.tolist(), ends.tolist(), strict=True):
        groups[k], at = text[at:end - 1], end  # without the last ;
    pairs = len(a.size) * len(b.size)
    link = doc * pairs + ids_a[cut_a].astype(np.int64) * len(b.size) + ids_b[cut_b]
    keys, times = np.unique(link, return_counts=True)
    return {"n_a": np.bincount(doc_a, minlength=n), "n_b": np.bincount(doc_b, minlength=n), "n_groups": np.bincount(doc, minlength=n),
            "groups": groups, "pair": keys % pairs, "times": times, "bounds": np.searchsorted(keys // pairs, np.arange(n + 1))}


def _aligned(docs: DataFrame, path_a: str, path_b: str, with_groups: bool, block_links: int) -> DataFrame:
    """One row for each document with its distinct linked pairs, and one for
    each block (`total`) with the sums of its pairs."""
    schema = (T.StructType().add("block", T.LongType()).add("total", T.BooleanType()).add("doc_id", docs.schema["doc_id"].dataType)
              .add("n_a", T.LongType()).add("n_b", T.LongType()).add("n_groups", T.LongType())
              .add("groups", T.StringType()).add("groups_sha256", T.StringType())
              .add("pair", T.ArrayType(T.LongType())).add("times", T.ArrayType(T.LongType())))
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id"),
                         F.concat(F.lit(" "), F.col("text")).alias("text"))

    def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int64()))

    def scan(batches):
        a, b = sides(path_a, path_b)
        block, pairs, times, held = None, np.zeros(0, np.int64), [], 0
        fresh: list[np.ndarray] = []
        doc_type = None

        def close():
            keys, back = np.unique(np.concatenate(fresh) if fresh else pairs, return_inverse=True)
            sums = np.zeros(len(keys), dtype=np.int64)
            np.add.at(sums, back, np.concatenate(times) if times else pairs)
            ends = np.array([0, len(keys)])
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([True]), pa.nulls(1, doc_type), *[pa.nulls(1, pa.int64())] * 3,
                 *[pa.nulls(1, pa.string())] * 2, lists(keys, ends), lists(sums, ends)], names=schema.names)

        for batch in batches:
            doc_type = batch.schema.field(1).type
            for chunk in ts.chunks(batch.column(2)):
                got = align_chunk(chunk, a, b)
                if block is None:
                    block = batch.column(0)[chunk.row].as_py()
                rows = chunk.n
                sha = [hashlib.sha256(g).hexdigest() if g else "" for g in got["groups"]]
                text = pa.array([g.decode() for g in got["groups"]], pa.string()) if with_groups else pa.nulls(rows, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows, block), pa.int64()), pa.array(np.zeros(rows, dtype=bool)), batch.column(1).slice(chunk.row, rows),
                     *[pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups")], text, pa.array(sha, pa.string()),
                     lists(got["pair"], got["bounds"]), lists(got["times"], got["bounds"])], names=schema.names)
                fresh.append(got["pair"])
                times.append(got["times"])
                held += len(got["pair"])
                if held >= block_links:
                    yield close()
                    block, held = None, 0
                    fresh.clear()
                    times.clear()
        if block is not None:
            yield close()

    return source.mapInArrow(scan, schema)


def pair_counts(totals: DataFrame, size_b: int) -> DataFrame:
    """(pair, count, best): how often ids are linked in the corpus, and whether
    no other id of A is linked to the id of B more often. `totals` has (pair, n)."""
    counts = totals.groupBy("pair").agg(F.sum("n").alias("count"))
    by_b = Window.partitionBy(F.col("pair") % size_b)  # at most one row for each id of A
    return counts.withColumn("best", F.col("count") == F.max("count").over(by_b))


def align(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = True, block_links: int = BLOCK_LINKS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (text, if
    `with_groups`) and groups_sha256 of every document."""
    size_b = len(sides(path_a, path_b)[1].size)
    rows = written(_aligned(pick(docs, "doc_id", "text"), path_a, path_b, with_groups, block_links))
    own = rows.filter("total").select("block", F.explode(F.arrays_zip("pair", "times")).alias("x")).select(
        "block", F.col("x.pair").alias("pair"), F.col("x.times").alias("n"))
    known = own.select(F.col("block").alias("place"), "pair").join(pair_counts(own, size_b), "pair")
    keep = ["doc_id", "n_a", "n_b", "n_groups"] + ["groups"] * with_groups + ["groups_sha256"]
    texts = rows.filter(~F.col("total")).select("block", *keep, "pair", "times")
    schema = T.StructType([texts.schema[c] for c in keep])
    for c in ("n_links", "n_best", "count_sum"):
        schema = schema.add(c, T.LongType())

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        """The counts of the pairs of one block, added up for its documents."""
        order = np.argsort(right.column("pair").to_numpy())
        pair = right.column("pair").to_numpy()[order]
        count = right.column("count").to_numpy()[order]
        best = right.column("best").to_numpy()[order]
        pairs, times = left.column("pair").combine_chunks(), left.column("times").combine_chunks().flatten().to_numpy()
        doc = np.repeat(np.arange(left.num_rows), pairs.value_lengths().to_numpy())
        at = np.searchsorted(pair, pairs.flatten().to_numpy())
        sums = [np.zeros(left.num_rows, dtype=np.int64) for _ in range(3)]
        for total, values in zip(sums, (times, times * best[at], times * count[at]), strict=True):
            np.add.at(total, doc, values)
        return pa.table([*[left.column(c) for c in keep], *[pa.array(s) for s in sums]], names=schema.names)

    found = texts.groupBy("block").cogroup(known.groupBy("place")).applyInArrow(look_up, schema)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", *keep[4:])
