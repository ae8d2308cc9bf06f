"""Exact top-k retrieval over bounded cells.

Items are dealt to the cells of a coarse quantiser. A cell knows how far its
items reach: along the direction of its centre, away from that line, from the
centre, and from the origin. Each of these bounds the score of a query with any
item of the cell. Neighbouring cells make a chunk of about ``block`` items (a
cell of more items is cut into several chunks), and the queries that meet a
chunk are cut into blocks; a task scores one block with one chunk. There are two
rounds:

1. floor: a query meets the chunk of its cell of largest bound; the k-th best
   score there, less the rounding, is its floor;
2. probes: a query meets the chunks that hold a cell whose bound reaches its
   floor, and keeps at most k items of each.

What is skipped cannot hold an item of the result, so the result is exact. By
default a chunk holds a 16th of the items, from 4,096 to 65,536 of them, so that
up to a million items a query's vector is sent to at most 16 chunks and an
item's to one block of queries after the other: what is moved grows with the
rows, not with their product. The tables of cells on the driver and in the
tasks have at most MAX_CELLS rows.

A task compares in single precision by matrix products first and keeps what is
within the rounding of the k-th best. What is kept is scored in double
precision, place by place, left to right, the order of the SQL twin, so scores
agree to the last bit. Queries and chunks whose lengths leave the range where
the rounding is known are scored in double precision throughout.

Defined results: null ids are ids like others (last among ties); rows with the
same qid are queries of their own; items come in the order of score, then item
id, scores that are no numbers (NaN in a vector, cosine with a zero vector)
after all others; vectors that are null or of another length than the first
item's take no part; fewer than k items give fewer rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsmith.session import cut_lineage

#: Items of a chunk and queries of a block that one task scores: a SHARE-th of
#: the items within these limits.
SHARE, LEAST_BLOCK, MOST_BLOCK = 16, 4096, 65_536
#: Queries compared at a time, pairs scored at a time.
TILE, PAIRS = 256, 1 << 17
#: Vectors of other lengths are not compared in single precision.
SHORTEST, LONGEST = 1e-140, 1e140
#: Cells at most, and items that their centres are fitted on at most.
MAX_CELLS, SAMPLE = 1024, 20_000
ROUNDS = 6
#: Relative room for rounding in the bounds.
SLACK = 1e-9
#: The cell of items without a bound: each query scores them.
APART = -1


@dataclass
class Layout:
    """The chunks of each cell (`pieces` of them from `first` on), their number,
    and how many more hold the items without a bound."""

    first: np.ndarray
    pieces: np.ndarray
    chunks: int
    apart: int

    def of_cells(self, cells: np.ndarray) -> np.ndarray:
        """Which chunks hold one of the cells, for each row."""
        out = np.zeros((len(cells), self.chunks + self.apart), dtype=bool)
        for c in np.flatnonzero(cells.any(axis=0)):
            out[:, self.first[c]:self.first[c] + self.pieces[c]] |= cells[:, [c]]
        return out


@dataclass
class Cells:
    """Centres and, for each cell, its number of items and their reach."""

    centres: np.ndarray
    count: np.ndarray
    low: np.ndarray
    high: np.ndarray
    side: np.ndarray
    radius: np.ndarray
    norm: np.ndarray
    apart: int  # items without a bound

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Largest possible score of each query (row) with an item of each
        cell; infinite for queries that are no numbers."""
        directions = _directions(self.centres)
        size = np.linalg.norm(q, axis=1)[:, None]
        along = q @ directions.T
        tube = np.maximum(along * self.low, along * self.high) + np.sqrt(np.maximum(size * size - along * along, 0)) * self.side
        best = np.minimum(np.minimum(tube, q @ self.centres.T + size * self.radius), size * self.norm)
        best += SLACK * size * (self.norm + np.linalg.norm(self.centres, axis=1))
        return np.where(np.isfinite(best), best, np.inf)

    def layout(self, block: int) -> Layout:
        """Chunks of about `block` items: a large cell has chunks of its own,
        small cells next to each other share one."""
        first, pieces, chunk, held = [], [], 0, 0
        for n in self.count.tolist():
            many = max(1, math.ceil(n / block))
            if held and (many > 1 or held + n > block):
                chunk, held = chunk + 1, 0
            first.append(chunk)
            pieces.append(many)
            if many > 1:
                chunk += many
            else:
                held += n
        chunk += held > 0
        return Layout(np.array(first, np.int64), np.array(pieces, np.int64), chunk, math.ceil(self.apart / block))


def _directions(centres: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(centres, axis=1)[:, None]
    return np.where(size > 0, centres / np.where(size > 0, size, 1.0), 0.0)


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list column; null places are NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors; NaN for the zero vector."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return x / np.linalg.norm(x, axis=1)[:, None]


def _scores(q: np.ndarray, i: np.ndarray, cosine: bool) -> np.ndarray:
    acc = q[:, 0][:, None] * i[:, 0][None, :]
    for d in range(1, q.shape[1]):
        acc += q[:, d][:, None] * i[:, d][None, :]
    if cosine:
        qn = q[:, 0] * q[:, 0]
        inn = i[:, 0] * i[:, 0]
        for d in range(1, q.shape[1]):
            qn = qn + q[:, d] * q[:, d]
            inn = inn + i[:, d] * i[:, d]
        acc = acc / (np.sqrt(qn)[:, None] * np.sqrt(inn)[None, :])
    return acc


def fit_centres(sample: np.ndarray, n: int) -> np.ndarray:
    """Lloyd's algorithm from the first n rows of the sample."""
    centres = np.unique(sample, axis=0)
    centres = sample[:n].copy() if len(centres) > n else centres
    for _ in range(ROUNDS):
        near = _nearest(sample, centres)
        total = np.zeros_like(centres)
        np.add.at(total, near, sample)
        size = np.bincount(near, minlength=len(centres))[:, None]
        centres = np.where(size > 0, total / np.maximum(size, 1), centres)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.int64)
    for lo in range(0, len(x), 4096):
        part = x[lo:lo + 4096]
        out[lo:lo + 4096] = ((centres * centres).sum(axis=1)[None, :] - 2 * part @ centres.T).argmin(axis=1)
    return out


def _taking_part(df: DataFrame, name: str, dim: int) -> DataFrame:
    return (df.select(F.col(name).cast("bigint").alias(name), F.col("vec").cast("array<double>").alias("vec"))
            .where(F.col("vec").isNotNull() & (F.size("vec") == dim)))


def build_cells(items: DataFrame, dim: int, cosine: bool = False, n_cells: int | None = None) -> tuple[DataFrame, Cells]:
    """(item_id, vec, cell, row) of every item as a written table, and its
    cells. Centres are fitted on at most SAMPLE items, those of the least
    hashes; every item is dealt to its nearest centre."""
    n = items.count()
    wanted = min(MAX_CELLS, n_cells or max(1, round(math.sqrt(n))))
    known = items.orderBy(F.xxhash64("item_id", "vec")).limit(SAMPLE).select("vec").toArrow().column("vec")
    sample = _matrix(known, dim)
    sample = _unit(sample) if cosine else sample
    sample = sample[np.isfinite(sample).all(axis=1)]
    centres = fit_centres(sample, wanted) if len(sample) else np.zeros((1, dim))

    def deal(batches):
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            if len(x) == 0:
                continue
            x = _unit(x) if cosine else x
            good = np.isfinite(x).all(axis=1)
            y = np.where(good[:, None], x, 0.0)
            cell = _nearest(y, centres)
            along = (y * _directions(centres)[cell]).sum(axis=1)
            size = (y * y).sum(axis=1)
            side = np.sqrt(np.maximum(size - along * along, 0))
            radius = np.sqrt(((y - centres[cell]) ** 2).sum(axis=1))
            cell = np.where(good & np.isfinite(size), cell, APART)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell, pa.int32()),
                                              *[pa.array(v) for v in (along, side, radius, np.sqrt(size))]], names=names)

    names = ["item_id", "vec", "cell", "along", "side", "radius", "norm"]
    dealt = items.mapInArrow(deal, "item_id long, vec array<double>, cell int, along double, side double, radius double, norm double")
    dealt = cut_lineage(dealt.withColumn("row", F.monotonically_increasing_id()))
    stats = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("along").alias("low"), F.max("along").alias("high"),
                                      *[F.max(c).alias(c) for c in ("side", "radius", "norm")]).collect()
    size = len(centres)
    found = Cells(centres, np.zeros(size, np.int64), *[np.zeros(size) for _ in range(5)], apart=0)
    for r in stats:
        if r.cell == APART:
            found.apart = r.n
            continue
        found.count[r.cell] = r.n
        room = SLACK * r.norm
        found.low[r.cell], found.high[r.cell] = r.low - room, r.high + room
        # the distance from a line loses digits where two squares cancel out
        found.side[r.cell], found.radius[r.cell] = math.sqrt(r.side * r.side + SLACK * r.norm * r.norm), r.radius + room
        found.norm[r.cell] = r.norm + room
    return dealt.select("item_id", "vec", "cell", "row"), found


def _meets(x: np.ndarray, floor: np.ndarray | None, cells: Cells, layout: Layout, cosine: bool) -> tuple[np.ndarray, np.ndarray]:
    """(chunks that each query meets, cells it is scored with there): the chunk
    of its cell of largest bound without a floor, else the cells whose bound
    reaches the floor and the items without a bound."""
    with np.errstate(invalid="ignore", over="ignore"):
        bounds = cells.bounds(_unit(x) if cosine else x)
    some = cells.count > 0
    if floor is None:
        best = np.where(some[None, :], bounds, -np.inf).argmax(axis=1)
        chunks = np.zeros((len(x), layout.chunks + layout.apart), dtype=bool)
        if some.any():
            chunks[np.arange(len(x)), layout.first[best]] = True
        return chunks, some[None, :] & (layout.first[None, :] == layout.first[best][:, None])
    used = some[None, :] & (bounds >= floor[:, None])
    chunks = layout.of_cells(used)
    chunks[:, layout.chunks:] = True
    return chunks, used


def _probes(queries: DataFrame, cells: Cells, dim: int, cosine: bool, second: bool, layout: Layout,
            parts: dict[int, int] | None) -> DataFrame:
    """Without `parts`: (chunk, n), how many queries meet a chunk. With them
    (blocks of queries of each chunk): one row for each query and chunk."""
    schema = "chunk int, n long" if parts is None else "chunk int, block int, q long, qid long, vec array<double>, floor double"

    def scan(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                x = _matrix(part.column(2), dim)
                floor = part.column(3).to_numpy(zero_copy_only=False) if second else None
                row, chunk = np.nonzero(_meets(x, floor, cells, layout, cosine)[0])
                if parts is None:
                    found, n = np.unique(chunk, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(n, pa.int64())], names=["chunk", "n"])
                    continue
                q = part.column(0).to_numpy()
                block = q[row] % np.array([parts[c] for c in chunk.tolist()], dtype=np.int64) if len(row) else np.zeros(0, np.int64)
                for at in range(0, len(row), 4096):
                    cut = slice(at, at + 4096)
                    take = pa.array(row[cut])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(chunk[cut], pa.int32()), pa.array(block[cut], pa.int32()),
                         part.column(0).take(take), part.column(1).take(take), part.column(2).take(take),
                         part.column(3).take(take) if second else pa.nulls(len(take), pa.float64())],
                        names=["chunk", "block", "q", "qid", "vec", "floor"])

    return queries.mapInArrow(scan, schema)


def _first_k(score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best allowed scores of each row: larger first,
    NaN last, columns in their order where scores are equal."""
    order = np.where(allowed, np.where(np.isnan(score), -np.inf, score), -np.inf)
    keep = allowed.copy()
    if score.shape[1] > k:
        kth = -np.partition(-order, k - 1, axis=1)[:, k - 1]
        keep &= order >= kth[:, None]
        for r in np.flatnonzero(keep.sum(axis=1) > k):  # ties at the cut
            some = np.flatnonzero(keep[r])
            best = some[np.lexsort((some, np.isnan(score[r, some]), -order[r, some]))[:k]]
            keep[r] = False
            keep[r, best] = True
    return np.nonzero(keep)


def _pair_scores(x: np.ndarray, y: np.ndarray, rows: np.ndarray, cols: np.ndarray, cosine: bool) -> np.ndarray:
    """The scores of `_scores` for some pairs."""
    out = np.empty(len(rows))
    for lo in range(0, len(rows), PAIRS):
        a, b = x[rows[lo:lo + PAIRS]], y[cols[lo:lo + PAIRS]]
        acc = np.cumsum(a * b, axis=1)[:, -1]  # adds left to right
        if cosine:
            acc = acc / (np.sqrt(np.cumsum(a * a, axis=1)[:, -1]) * np.sqrt(np.cumsum(b * b, axis=1)[:, -1]))
        out[lo:lo + PAIRS] = acc
    return out


def _own_pairs(qid: pa.ChunkedArray, item: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the pairs of equal ids."""
    q, i = qid.combine_chunks(), item.combine_chunks()
    rows, cols = np.flatnonzero(q.is_valid().to_numpy(zero_copy_only=False)), np.flatnonzero(i.is_valid().to_numpy(zero_copy_only=False))
    known, ids = q.fill_null(0).to_numpy()[rows], i.fill_null(0).to_numpy()[cols]
    order = np.argsort(ids, kind="stable")
    cols, ids = cols[order], ids[order]
    lo, hi = np.searchsorted(ids, known, "left"), np.searchsorted(ids, known, "right")
    many = hi - lo
    at = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(rows, many), cols[at]


def _near_best(near: np.ndarray, least: np.ndarray, k: int, room: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column) of the values that reach `least` and may be among the k
    best of their row if each is off by at most `room`; the k-th best of each
    row (-inf if it has fewer)."""
    rows, cols = np.nonzero(near >= least[:, None])
    count = np.bincount(rows, minlength=len(near))
    ends = np.cumsum(count)
    keep, kth = np.ones(len(rows), dtype=bool), np.full(len(near), -np.inf)
    for r in np.flatnonzero(count >= k):
        span = slice(ends[r] - count[r], ends[r])
        values = near[r, cols[span]]
        kth[r] = np.partition(values, len(values) - k)[len(values) - k]
        keep[span] = values >= kth[r] - 2 * room
    return rows[keep], cols[keep], kth


def score_block(left: pa.Table, right: pa.Table, cells: Cells, layout: Layout, dim: int, k: int, cosine: bool, exclude_self: bool,
                second: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One block of queries with one chunk of items (sorted by item id):
    (row, column, score) of the k best of each query that reach its floor, in
    order, or (without `second`) nothing but the floors, a lower bound of the
    k-th best score."""
    x, y = _matrix(left.column("vec"), dim), _matrix(right.column("vec"), dim)
    floor = left.column("floor").combine_chunks().fill_null(-np.inf).to_numpy()
    floors = np.full(len(x), -np.inf)
    own = _own_pairs(left.column("qid"), right.column("item_id")) if exclude_self else (np.zeros(0, np.int64),) * 2
    turn = np.argsort(own[0], kind="stable")
    own = own[0][turn], own[1][turn]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    cell = right.column("cell").to_numpy()
    with np.errstate(invalid="ignore", over="ignore", divide="ignore"):
        size, length = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
        most = length.max()
        usual = (cell != APART).all() and SHORTEST < most < LONGEST and (not cosine or length.min() > SHORTEST)
        plain = (size > SHORTEST) & (size < LONGEST) & usual
        room = (dim + 8) * 2.0 ** -22  # twice the rounding of a product of unit vectors
        if usual:
            xs = (x / size[:, None]).astype(np.float32)
            ys = (y / (length[:, None] if cosine else most)).astype(np.float32)
            scale = np.ones(len(x)) if cosine else size * most
        todo = np.flatnonzero(plain)
        if len(todo):  # queries of one neighbourhood at a time share their cells
            todo = todo[np.argsort(_nearest(xs[todo].astype(np.float64), cells.centres), kind="stable")]
        for lo in range(0, len(todo), TILE):
            tile = todo[lo:lo + TILE]
            cols = np.arange(len(y))
            if second:
                used = _meets(x[tile], floor[tile], cells, layout, cosine)[1].any(axis=0)
                cols = np.flatnonzero(used[cell])
            if len(cols) == 0:
                continue
            near = xs[tile] @ (ys if len(cols) == len(ys) else ys[cols]).T
            for r, q in enumerate(tile.tolist()) if len(own[0]) else ():
                mine = own[1][np.searchsorted(own[0], q, "left"):np.searchsorted(own[0], q, "right")]
                near[r, np.flatnonzero(np.isin(cols, mine))] = -np.inf
            least = np.maximum(floor[tile] / scale[tile] - room, -4.0)  # scores are above, own items below
            r, c, kth = _near_best(near, least, k, room)
            if not second:
                floors[tile] = np.where(kth > -np.inf, (kth - 2 * room) * scale[tile], -np.inf)
                continue
            r, c = tile[r], cols[c]
            score = _pair_scores(x, y, r, c, cosine)
            reach = ~(score < floor[r])
            r, c, score = r[reach], c[reach], score[reach]
            order = np.lexsort((c, -score, r))
            r, c, score = r[order], c[order], score[order]
            first = np.searchsorted(r, r, "left")
            top = np.arange(len(r)) - first < k
            found.append((r[top], c[top], score[top]))
        rest = np.flatnonzero(~plain) if second else np.zeros(0, np.int64)
        step = max(1, (1 << 21) // max(1, len(y)))
        for lo in range(0, len(rest), step):
            tile = rest[lo:lo + step]
            s = _scores(x[tile], y, cosine)
            allowed = ~(s < floor[tile][:, None]) & ~(np.isnan(s) & (floor[tile] > -np.inf)[:, None])
            for r, q in enumerate(tile.tolist()):
                allowed[r, own[1][np.searchsorted(own[0], q, "left"):np.searchsorted(own[0], q, "right")]] = False
            r, c = _first_k(s, allowed, k)
            found.append((tile[r], c, s[r, c]))
    none = np.zeros(0, np.int64)
    r, c, score = (np.concatenate(v) for v in zip(*found, strict=True)) if found else (none, none, np.zeros(0))
    return r, c, score, floors


def _scored(items: DataFrame, probes: DataFrame, cells: Cells, layout: Layout, parts: dict[int, int], dim: int, k: int,
            cosine: bool, exclude_self: bool, second: bool) -> DataFrame:
    """The floors (q, floor), or (`second`) the k best of each query and chunk in
    a row: (q, qid, item_ids, scores)."""
    spark = items.sparkSession
    places = [(c, int(layout.first[c]), int(layout.pieces[c])) for c in np.flatnonzero(cells.count).tolist()]
    places = spark.createDataFrame(places + [(APART, layout.chunks, max(1, layout.apart))], "cell int, first int, pieces int")
    blocks = spark.createDataFrame(sorted(parts.items()) or [(-1, 1)], "chunk int, parts int")
    right = (items.join(F.broadcast(places), "cell")  # one row a cell: bounded
             .withColumn("chunk", (F.col("first") + F.pmod("row", "pieces")).cast("int"))
             .join(F.broadcast(blocks), "chunk")  # one row a chunk: bounded
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("chunk", "block", "cell", "item_id", "vec"))
    schema = "q long, qid long, item_ids array<long>, scores array<double>" if second else "q long, floor double"
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())] if second else [pa.int64(), pa.float64()]

    def score_chunk(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        right = right.sort_by("item_id")  # nulls last
        r, c, score, floors = score_block(left, right, cells, layout, dim, k, cosine, exclude_self, second)
        if not second:
            return pa.table([left.column("q"), pa.array(floors)], names=names)
        # a query's items stand together: they come from one tile
        starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(r) else np.zeros(0, np.int64)
        ends = pa.array(np.r_[starts, len(r)], pa.int32())
        at = pa.array(r[starts])
        ids = right.column("item_id").take(pa.array(c)).combine_chunks()
        return pa.table([left.column("q").take(at), left.column("qid").take(at), pa.ListArray.from_arrays(ends, ids),
                         pa.ListArray.from_arrays(ends, pa.array(score))], names=names)

    return probes.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInArrow(score_chunk, schema)


def _round(queries: DataFrame, items: DataFrame, cells: Cells, dim: int, k: int, cosine: bool, exclude_self: bool,
           second: bool, layout: Layout, block: int) -> DataFrame:
    """One round of scoring: the floors, or (`second`) the probes."""
    counts = _probes(queries, cells, dim, cosine, second, layout, None).groupBy("chunk").agg(F.sum("n").alias("n")).collect()
    parts = {r.chunk: max(1, math.ceil(r.n / block)) for r in counts}  # one row a chunk: bounded
    return _scored(items, _probes(queries, cells, dim, cosine, second, layout, parts), cells, layout, parts, dim, k, cosine, exclude_self, second)


def _by_rank(partition: str) -> Window:
    """NaN after all numbers, ties by item id."""
    return Window.partitionBy(partition).orderBy(F.isnan("score"), F.desc("score"), F.asc_nulls_last("item_id"))


def _search(queries: DataFrame, items: DataFrame, k: int, cosine: bool, exclude_self: bool, n_cells: int | None, block: int | None):
    """(ranked rows, queries with their floor, cells, chunks, places); None without items."""
    first = items.where(F.col("vec").isNotNull()).select(F.size("vec").alias("n")).first()
    if first is None or first.n == 0:
        return None
    dim = first.n
    dealt, cells = build_cells(_taking_part(items, "item_id", dim), dim, cosine, n_cells)
    block = block or min(MOST_BLOCK, max(LEAST_BLOCK, math.ceil((int(cells.count.sum()) + cells.apart) / SHARE)))
    layout = cells.layout(block)
    asked = cut_lineage(_taking_part(queries, "qid", dim).select(F.monotonically_increasing_id().alias("q"), "qid", "vec"))
    floor = _round(asked, dealt, cells, dim, k, cosine, exclude_self, False, layout, block)
    known = cut_lineage(asked.join(floor, "q", "left").select("q", "qid", "vec", F.coalesce("floor", F.lit(-math.inf)).alias("floor")))
    packed = _round(known, dealt, cells, dim, k, cosine, exclude_self, True, layout, block)
    # packed rows are moved to their query, unpacked there and ranked
    found = (packed.repartition("q").select("q", "qid", F.explode(F.arrays_zip("item_ids", "scores")).alias("x"))
             .select("q", "qid", F.col("x.item_ids").alias("item_id"), F.col("x.scores").alias("score")))
    ranked = found.withColumn("rank", F.row_number().over(_by_rank("q"))).where(F.col("rank") <= k)
    return ranked, known, cells, layout, dim


def topk_similar(queries: DataFrame, items: DataFrame, k: int = 100, cosine: bool = False,
                 exclude_self: bool = False, block: int | None = None, n_cells: int | None = None) -> DataFrame:
    """Exact top-``k`` items per query by inner product (or cosine).
    ``queries``: (qid, vec); ``items``: (item_id, vec). Returns (qid, rank,
    item_id, score), ties broken by item id."""
    found = _search(queries, items, k, cosine, exclude_self, n_cells, block)
    if found is None:
        return queries.sparkSession.createDataFrame([], "qid long, rank int, item_id long, score double")
    return found[0].select("qid", F.col("rank").cast("int").alias("rank"), "item_id", F.round("score", 6).alias("score"))


def probe_report(queries: DataFrame, items: DataFrame, k: int = 100, cosine: bool = False,
                 exclude_self: bool = False, block: int | None = None, n_cells: int | None = None) -> DataFrame:
    """How much of the items each query had to be scored with: (qid, cells,
    probed, items, scored)."""
    schema = "qid long, cells long, probed long, items long, scored long"
    found = _search(queries, items, k, cosine, exclude_self, n_cells, block)
    if found is None:
        return queries.sparkSession.createDataFrame([], schema)
    _, known, cells, layout, dim = found

    def report(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                x = _matrix(part.column(2), dim)
                hit = _meets(x, None, cells, layout, cosine)[1] | _meets(x, part.column(3).to_numpy(zero_copy_only=False), cells, layout, cosine)[1]
                n = len(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(np.full(n, int((cells.count > 0).sum()) + (cells.apart > 0)), pa.int64()),
                     pa.array(hit.sum(axis=1) + (cells.apart > 0), pa.int64()), pa.array(np.full(n, int(cells.count.sum()) + cells.apart), pa.int64()),
                     pa.array(hit @ cells.count + cells.apart, pa.int64())], names=["qid", "cells", "probed", "items", "scored"])

    return known.mapInArrow(report, schema)
