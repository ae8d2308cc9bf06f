"""Sums and top-k of R1 over packed cells (NumPy over Arrow, no row for a pair).

Cells (the rows of a user, or of two of its blocks) are packed into bundles of
``BUNDLE`` rows: one row of a bundle table holds the columns of some whole cells
as plain arrays. An occurrence (row ``a`` of a cell) goes to its item's task as
one row with the records of all rows ``b`` it meets, 20 bytes each; pairs are
described, summed and cut there, a few items at a time. What only the result has
(all slots but the first) is made for the ``top_k`` pairs of an item alone.

Exactness: the arithmetic is the one of ``similarity._described`` and ``_terms``,
operation by operation on doubles; logarithms and powers come from Spark as
columns and as a table of ``loc_decay``. Null times have no time distance
(``greatest`` skips nulls, so their decay is the floor).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.functions.columns import HOUR_SECONDS, MISSING_AFFINITY, ORDER_PENALTY, TICKS_PER_UNIT, TIME_DECAY_FLOOR

#: Rows of a bundle; occurrences that are made, or summed up, at once.
BUNDLE = 8192
CHUNK = 250_000
#: Distances with their own ``loc_decay``; from there on it is the floor.
NEAR = 8

_T = float(TICKS_PER_UNIT)
_ROW = {"item": "<i8", "clicks": "<i8", "parts": "<i8", "own": "<i4", "loc": "<i4", "time": "<f8", "damp": "<f8", "lnlen": "<f8"}
_BUNDLE = ", ".join(f"{c} binary" for c in ("starts", "two", *_ROW, "vat", "norms", "vec"))
_DEALT = "item long, _s int, clicks long, loc int, time double, damp double, lnlen double, b binary, v binary"
_SUMS = {"sim_ticks": "long", "cnt": "long", "weighted_ticks": "long", "min_dt": "double", "min_dloc": "long", "node": "double",
         "node_ticks": "long", "deep": "double", "deep_ticks": "long", "_ci": "long", "_cj": "long"}
SCHEMA = "item long, relate_item long, _s int, " + ", ".join(f"{c} {t}" for c, t in _SUMS.items())
_AFFINITY = np.dtype([("at", "<i4"), ("node", "<u2"), ("deep", "<u2"), ("txt", "<u2")])


def _met_record(wide: bool) -> np.dtype:
    i = "<i8" if wide else "<i4"
    return np.dtype([("item", i), ("clicks", i), ("time", "<f8"), ("loc", "<i4")])


def _mix(x: np.ndarray) -> np.ndarray:
    """64 well mixed bits of each number (splitmix64)."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] of them), start[1], ..."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - count), count)


def _take(records: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``records[at]``, copied as plain bytes."""
    return np.take(records.view(f"V{records.dtype.itemsize}"), at).view(records.dtype)


def _chunks(size: np.ndarray, most: int):
    """(from, to) of neighbours of ``most`` in all, or of a single larger one."""
    ends, lo = np.cumsum(size), 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


def _sorted(keys: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Stable order by keys of values from 0 below their span, first key first."""
    n = len(keys[0][0])
    bits = n.bit_length()
    space = 1 << bits
    for _, span in keys:
        space *= int(span)
    if space >= 1 << 63:
        return np.lexsort([k for k, _ in reversed(keys)])
    whole = keys[0][0].astype(np.int64)
    for k, span in keys[1:]:
        whole = whole * span + k
    # the place in the low bits: sorting values is faster than their places
    return np.sort((whole << bits) | np.arange(n)) & ((1 << bits) - 1)


def _blobs(data: np.ndarray, count: np.ndarray) -> pa.Array:
    """Binary values of ``count`` records each."""
    ends = np.concatenate(([0], np.cumsum(count) * data.dtype.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))])


def _starts(column: pa.Array, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All records of a binary column and how many each value has."""
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    data = column.buffers()[2]
    if data is None or ends[-1] == ends[0]:
        return np.empty(0, dtype), np.zeros(len(column), np.int64)
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(dtype), np.diff(ends).astype(np.int64) // dtype.itemsize


def packed_cells(met: DataFrame, slices: dict[str, tuple[int, int]] | None, tasks: int) -> DataFrame:
    """Bundles of the rows ``met`` of cells (user_id, _x, _y)."""
    cast = {"<i8": "bigint", "<i4": "int", "<f8": "double"}
    cols = [F.col("item_id" if c == "item" else c).cast(cast[t]).alias(c) for c, t in _ROW.items()]
    width, real = 0, "<f4"
    if slices:
        width = max(hi for _, hi in slices.values())
        if not isinstance(met.schema["vec"].dataType.elementType, T.FloatType):
            real = "<f8"
        cols += [F.col("vec").cast("array<float>" if real == "<f4" else "array<double>").alias("vec"),
                 *[F.coalesce(f"norm_{name}", F.lit(-1.0)).alias(f"norm_{name}") for name in slices]]
    flat = (met.select(F.col("user_id").alias("_u"), "_x", "_y", *cols).repartition(tasks, "_u", "_x", "_y")
            .sortWithinPartitions("_u", "_x", "_y", "loc"))

    def bundle(rows: pa.Table, new: np.ndarray) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        first = np.flatnonzero(new)
        get = lambda c: rows[c].to_numpy()
        out = [np.append(first, len(new)).astype("<i8"), (get("_x") != get("_y"))[first].astype("u1")]
        out += [get(c).astype(t) for c, t in _ROW.items()]
        if slices:
            vec = rows["vec"].chunk(0)
            at = np.flatnonzero(vec.is_valid().to_numpy(zero_copy_only=False))
            values, ends = vec.values.to_numpy(zero_copy_only=False), vec.offsets.to_numpy()
            grid = np.minimum(ends[at][:, None] + np.arange(width), max(len(values) - 1, 0))
            out += [at.astype("<i4"), np.stack([get(f"norm_{name}")[at] for name in slices], 1).astype("<f8"),
                    values[grid].astype(real) if len(at) else np.empty(0, real)]
        else:
            out += [np.empty(0, "<i4"), np.empty(0, "<f8"), np.empty(0, real)]
        return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in out], names=_BUNDLE.replace(" binary", "").split(", "))

    def pack(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows < BUNDLE:
                continue
            held = held.combine_chunks()
            new = _new_cells(held)
            first = np.flatnonzero(new)
            lo = 0
            # whole cells only: the last one may go on in the next batch
            for f, t in _chunks(np.diff(first), BUNDLE):
                yield bundle(held.slice(first[f], first[t] - first[f]), new[first[f]:first[t]])
                lo = first[t]
            held = held.slice(lo)
        if held is not None and held.num_rows:
            held = held.combine_chunks()
            new = _new_cells(held)
            first = np.append(np.flatnonzero(new), len(new))
            for f, t in _chunks(np.diff(first), BUNDLE):
                yield bundle(held.slice(first[f], first[t] - first[f]), new[first[f]:first[t]])

    return flat.mapInArrow(pack, _BUNDLE)


def _new_cells(rows: pa.Table) -> np.ndarray:
    """Whether a row is the first of its cell."""
    new = np.ones(rows.num_rows, bool)
    if rows.num_rows > 1:
        new[1:] = False
        for c in ("_u", "_x", "_y"):
            new[1:] |= pc.not_equal(rows[c].slice(1), rows[c].slice(0, rows.num_rows - 1)).to_numpy()
    return new


def _affinities(vec: np.ndarray, norms: np.ndarray, a: np.ndarray, b: np.ndarray, slices: dict, ansi: bool) -> np.ndarray:
    """``trunc4(0.5 * cos + 0.5)`` in ticks of each slice of vectors a and b;
    ``vec`` has a dimension in a row."""
    out = np.empty(len(a), _AFFINITY)
    for lo in range(0, len(a), 1 << 15):
        x, y = a[lo:lo + (1 << 15)], b[lo:lo + (1 << 15)]
        for i, (name, (f, t)) in enumerate(slices.items()):
            acc = vec[f][x] * vec[f][y]
            for k in range(f + 1, t):
                acc += vec[k][x] * vec[k][y]
            nx, ny = norms[x, i], norms[y, i]
            missing, both = (nx == -1.0) | (ny == -1.0), nx * ny
            if (zero := ~missing & (both == 0)).any():
                if ansi:
                    raise ZeroDivisionError("[DIVIDE_BY_ZERO] a vector of R1 has length 0")
                missing |= zero
            with np.errstate(all="ignore"):
                ticks = np.trunc((0.5 * (acc / both) + 0.5) * _T)
            out[name][lo:lo + (1 << 15)] = np.where(missing, MISSING_AFFINITY * _T, np.nan_to_num(ticks, nan=0.0))
    return out


def dealt(bundles: DataFrame, slices: dict[str, tuple[int, int]] | None, wide: bool, rounds: int, mine: int, ansi: bool) -> DataFrame:
    """The occurrences of round ``mine``: one row for each row ``a`` with its
    partners ``b`` of other items. An item of several ``parts`` has one for each
    part of its partners, from 1 on; rounds are dealt by (item, part)."""
    record, width = _met_record(wide), max((hi for _, hi in slices.values()), default=0) if slices else 0

    def in_round(item: np.ndarray, s: np.ndarray | int) -> np.ndarray:
        if rounds == 1:
            return np.ones(len(item), bool)
        return _mix(_mix(item) + np.asarray(s).astype(np.uint64)) % np.uint64(rounds) == np.uint64(mine)

    def of_bundle(r: dict):
        c = {k: np.frombuffer(r[k], t) for k, t in _ROW.items()}
        starts, two = np.frombuffer(r["starts"], "<i8"), np.frombuffer(r["two"], "u1").astype(bool)
        size = np.diff(starts)
        start, end, cross = np.repeat(starts[:-1], size), np.repeat(starts[1:], size), np.repeat(two, size)
        # two blocks meet in one cell, a block meets itself in its own
        front = c["own"] == c["own"][start]
        mid = np.repeat(starts[:-1] + np.add.reduceat(front.astype(np.int64), starts[:-1]), size)
        lo, hi = np.where(cross & front, mid, start), np.where(cross & ~front, mid, end)
        met = np.empty(len(start), record)
        for f in record.names:
            met[f] = c[f]
        heavy = c["parts"] > 1
        chosen = np.flatnonzero((heavy | in_round(c["item"], 0)) & (hi > lo))
        vat = np.frombuffer(r["vat"], "<i4")
        if len(vat):
            vrow = np.full(len(start), -1)
            vrow[vat] = np.arange(len(vat))
            norms = np.frombuffer(r["norms"], "<f8").reshape(len(vat), -1)
            vec = np.frombuffer(r["vec"], "<f4" if r["vec"].size == 4 * width * len(vat) else "<f8")
            vec = np.ascontiguousarray(vec.reshape(len(vat), width).T.astype(np.float64))
        for f, t in _chunks((hi - lo)[chosen], CHUNK):
            sel = chosen[f:t]
            a, b = np.repeat(sel, (hi - lo)[sel]), _ranges(lo[sel], (hi - lo)[sel])
            keep, s = c["item"][a] != c["item"][b], None
            if heavy[sel].any():
                s = np.where(heavy[a], _mix(c["item"][b]) % c["parts"][a].astype(np.uint64) + np.uint64(1), 0).astype(np.int64)
                keep &= (s == 0) | in_round(c["item"][a], s)
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            new = np.ones(len(a), bool)
            if s is not None:
                s = s[keep]
                order = np.lexsort((s, a))
                a, b, s = a[order], b[order], s[order]
                new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
            else:
                new[1:] = a[1:] != a[:-1]
            first = np.flatnonzero(new)
            count, own = np.diff(np.append(first, len(a))), a[first]
            near, per = np.empty(0, _AFFINITY), np.zeros(len(own), np.int64)
            if len(vat) and len(p := np.flatnonzero((vrow[a] >= 0) & (vrow[b] >= 0))):
                near, group = _affinities(vec, norms, vrow[a[p]], vrow[b[p]], slices, ansi), np.repeat(np.arange(len(own)), count)[p]
                near["at"], per = p - first[group], np.bincount(group, minlength=len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c["item"][own]), pa.array(np.zeros(len(own), np.int32) if s is None else s[first].astype(np.int32)),
                 pa.array(c["clicks"][own]), pa.array(c["loc"][own]), pa.array(c["time"][own]), pa.array(c["damp"][own]),
                 pa.array(c["lnlen"][own]), _blobs(_take(met, b), count), _blobs(near, per)],
                names=["item", "_s", "clicks", "loc", "time", "damp", "lnlen", "b", "v"])

    def deal(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield from of_bundle({c: batch.column(c)[i].as_buffer() for c in batch.schema.names})

    return bundles.mapInArrow(deal, _DEALT)


def top_sums(rows: DataFrame, wide: bool, decay: list[float], top_k: int, packed: bool = False) -> DataFrame:
    """The ``top_k`` accumulated pairs by slot 0 (ties by related item) of each
    (item, _s); all rows of one are in one partition. ``packed``: for a table,
    many pairs in one row, with the number of their occurrences."""
    record, decays = _met_record(wide), np.array(decay)

    def few(own: dict, group: np.ndarray, met: np.ndarray, count: np.ndarray, near: np.ndarray, per: np.ndarray) -> pa.RecordBatch:
        a = np.repeat(np.arange(len(count)), count)
        dloc = np.abs(met["loc"] - own["loc"][a])
        dt = np.floor(np.abs(own["time"][a] - met["time"]) / float(HOUR_SECONDS) * _T) / _T
        weight = decays[np.minimum(dloc - 1, NEAR - 1)]
        td = np.fmax(TIME_DECAY_FLOOR, 1.0 / (1.0 + dt))
        node = deep = None
        alike: np.ndarray | float = MISSING_AFFINITY * MISSING_AFFINITY * MISSING_AFFINITY * MISSING_AFFINITY
        if len(near):
            at = near["at"] + np.repeat(np.cumsum(count) - count, per)
            node, deep, alike = np.full(len(a), MISSING_AFFINITY), np.full(len(a), MISSING_AFFINITY), np.full(len(a), alike)
            node[at], deep[at] = near["node"] / _T, near["deep"] / _T
            alike[at] = node[at] * node[at] * deep[at] * (near["txt"] / _T)
        sim = alike * weight * td / own["damp"][a] * np.where(own["loc"][a] > met["loc"], ORDER_PENALTY, 1.0)
        ticks = np.trunc(sim * _T).astype(np.int64)
        g, low = group[a], int(met["item"].min())
        relate, span = met["item"].astype(np.int64) - low, int(met["item"].max()) - low + 1
        if span >= 1 << 62:
            ids, relate = np.unique(met["item"], return_inverse=True)
            span = len(ids)
        order = _sorted([(g, int(g[-1]) + 1), (relate, span)])
        gs, rs = g[order], relate[order]
        new = np.ones(len(a), bool)
        new[1:] = (gs[1:] != gs[:-1]) | (rs[1:] != rs[:-1])
        first = np.flatnonzero(new)
        total, pg = np.add.reduceat(ticks[order], first), gs[first]
        ranked = _sorted([(pg, int(pg[-1]) + 1), (total.max() - total, int(total.max()) - int(total.min()) + 1)])
        size = np.bincount(pg)
        rank = np.arange(len(pg)) - np.repeat(np.cumsum(size) - size, size)
        won = np.zeros(len(pg), bool)
        won[ranked[rank < top_k]] = True
        # the other slots, for the pairs that stay
        o = order[won[np.cumsum(new) - 1]]
        at = np.append(first, len(a))
        many = np.diff(at)[won]
        begin = np.cumsum(many) - many
        add, o_a = np.add.reduceat, a[o]
        weighted = np.trunc(weight[o] * td[o] / own["lnlen"][o_a] * _T).astype(np.int64)
        nearest = np.fmin.reduceat(dt[o], begin)
        if node is None:
            top, half = np.full(len(many), MISSING_AFFINITY), many * int(MISSING_AFFINITY * _T)
            slots = [top, half, top, half]
        else:
            slots = [x for n in (node[o], deep[o]) for x in (np.maximum.reduceat(n, begin), add(np.trunc(n * _T).astype(np.int64), begin))]
        lead, met_first = a[o[begin]], _take(met, o[begin])
        return pa.RecordBatch.from_arrays(
            [pa.array(own["item"][lead]), pa.array(met_first["item"].astype(np.int64)), pa.array(own["_s"][lead]), pa.array(total[won]),
             pa.array(many), pa.array(add(weighted, begin)), pa.array(nearest, mask=np.isnan(nearest)),
             pa.array(np.minimum.reduceat(dloc[o], begin).astype(np.int64)), *map(pa.array, slots),
             pa.array(own["clicks"][lead]), pa.array(met_first["clicks"].astype(np.int64))],
            names=["item", "relate_item", "_s", *_SUMS])

    def top(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        names = ("item", "_s", "clicks", "loc", "time", "damp", "lnlen")
        own = {c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in parts]) for c in names}
        (met, count), (near, per) = ((np.concatenate(x) for x in zip(*[_starts(b.column(c), t) for b in parts], strict=True))
                                     for c, t in (("b", record), ("v", _AFFINITY)))
        del parts
        order = np.lexsort((own["_s"], own["item"]))
        at, near_at = (np.cumsum(n) - n for n in (count, per))
        new = np.ones(len(order), bool)
        new[1:] = (own["item"][order][1:] != own["item"][order][:-1]) | (own["_s"][order][1:] != own["_s"][order][:-1])
        first = np.append(np.flatnonzero(new), len(order))
        size = np.add.reduceat(count[order], first[:-1])
        for f, t in _chunks(size, CHUNK):
            o = order[first[f]:first[t]]
            out = few({c: x[o] for c, x in own.items()}, np.cumsum(new[first[f]:first[t]]) - 1, _take(met, _ranges(at[o], count[o])), count[o],
                      _take(near, _ranges(near_at[o], per[o])), per[o])
            if packed:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, out.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                    stream.write_batch(out)
                out = pa.RecordBatch.from_arrays([pa.array([pc.sum(out["cnt"]).as_py()]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["cnt", "sums"])
            yield out

    return rows.mapInArrow(top, "cnt long, sums binary" if packed else SCHEMA)


def unpacked(tables: DataFrame) -> DataFrame:
    """The pairs of packed sums."""
    def unpack(batches):
        for batch in batches:
            for value in batch.column("sums"):
                yield from pa.ipc.open_stream(value.as_buffer())

    return tables.select("sums").mapInArrow(unpack, SCHEMA)
