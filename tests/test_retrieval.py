"""Exact retrieval over cells: against numpy, in clusters, on odd vectors."""

import math

import numpy as np
import pytest

from recsmith.operators import retrieval as R


def _frame(spark, vecs, name, ids=None):
    ids = range(len(vecs)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids, vecs, strict=True)],
                                 f"{name} long, vec array<double>")


def _plain(q, items, k, cosine=False):
    """[(rank, item, score)] of one query, NaN last, ties by item id."""
    rows = []
    for i, v in items:
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            s = float(np.dot(q, v))
            if cosine:
                s = float(s / np.float64(np.linalg.norm(q) * np.linalg.norm(v)))
        rows.append((math.isnan(s), -s if not math.isnan(s) else 0.0, i, s))
    return [(r + 1, i, s) for r, (_, _, i, s) in enumerate(sorted(rows)[:k])]


def _clusters(rng, n, dim, centres):
    middle = rng.normal(size=(centres, dim)) * 10
    return middle[rng.integers(0, centres, n)] + rng.normal(size=(n, dim)) * 0.3


@pytest.mark.parametrize("cosine", [False, True])
def test_clustered_items_are_probed_in_part(spark, cosine):
    rng = np.random.default_rng(4)
    items, queries = _clusters(rng, 1500, 8, 12), _clusters(rng, 60, 8, 12)
    q, i = _frame(spark, queries, "qid"), _frame(spark, items, "item_id")
    got = {}
    for r in R.topk_similar(q, i, k=7, cosine=cosine, block=64).collect():
        got.setdefault(r.qid, []).append((r.rank, r.item_id, r.score))
    for k in range(60):
        want = _plain(queries[k], list(enumerate(items)), 7, cosine)
        assert [(a, b) for a, b, _ in sorted(got[k])] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for _, _, s in sorted(got[k])], [s for _, _, s in want], atol=1e-6)
    report = R.probe_report(q, i, k=7, cosine=cosine, block=64).collect()
    assert len(report) == 60 and all(0 < r.probed <= r.cells and 7 <= r.scored <= r.items == 1500 for r in report)
    assert sum(r.scored for r in report) < 0.5 * 60 * 1500  # most items are never scored


def test_a_third_of_all_items_alike(spark):
    """One hot cell: cut into chunks, ties by item id."""
    rng = np.random.default_rng(9)
    items = np.concatenate([np.tile([3.0, 4.0, 0.0], (400, 1)), rng.normal(size=(800, 3))])
    queries = np.array([[3.0, 4.0, 0.0], [-1.0, 0.5, 2.0]])
    rows = R.topk_similar(_frame(spark, queries, "qid"), _frame(spark, items, "item_id"), k=10, block=50).collect()
    assert [r.item_id for r in sorted(rows, key=lambda r: r.rank) if r.qid == 0] == list(range(10))
    assert [(r.rank, r.item_id) for r in sorted(rows, key=lambda r: r.rank) if r.qid == 1] == [
        (a, b) for a, b, _ in _plain(queries[1], list(enumerate(items)), 10)]


def test_no_block_is_copied_to_every_block(spark, monkeypatch):
    """A query's vector reaches the chunks of the cells it probes only."""
    rng = np.random.default_rng(2)
    middle = np.eye(6) * 100
    items = np.concatenate([m + rng.normal(size=(200, 6)) for m in middle])
    sent = []
    plain = R._scored
    monkeypatch.setattr(R, "_scored", lambda items, probes, *a: (sent.append(probes.count()), plain(items, probes, *a))[1])
    rows = R.topk_similar(_frame(spark, middle, "qid"), _frame(spark, items, "item_id"), k=5, block=100, n_cells=6).count()
    assert rows == 30
    assert sum(sent) <= 6 * 4  # of 12 chunks or more for each of 6 queries


def test_odd_vectors_and_ids(spark):
    nan, inf = float("nan"), float("inf")
    vecs = [[1, 0], [0, 1], [nan, 1], [0, 0], None, [1, 2, 3], [2, 2], [None, 1], [2, 2]]
    ids = [0, 1, 2, 3, 4, 5, None, 7, 8]
    items = _frame(spark, vecs, "item_id", ids)
    queries = _frame(spark, [[1, 1], [nan, 1], [0, 0], None, [1, 1]], "qid", [10, 11, 12, 13, None])
    got = {}
    for r in R.topk_similar(queries, items, k=20, n_cells=3).collect():
        got.setdefault(r.qid, []).append((r.rank, r.item_id, r.score))
    order = {q: [i for _, i, _ in sorted(rows)] for q, rows in got.items()}
    assert order[10] == [8, None, 0, 1, 3, 2, 7] == order[None]  # scores 4 4 1 1 0, then no numbers
    assert order[11] == [0, 1, 2, 3, 7, 8, None] and all(math.isnan(s) for _, _, s in got[11])
    assert order[12] == [0, 1, 3, 8, None, 2, 7] and 13 not in got
    cosine = sorted((r.rank, r.item_id) for r in R.topk_similar(queries.where("qid = 10"), items, k=20, cosine=True, n_cells=3).collect())
    assert [i for _, i in cosine] == [8, None, 0, 1, 2, 3, 7]  # the zero vector has no cosine
    big = _frame(spark, [[inf, 0], [-inf, 0], [1, 0]], "item_id")
    rows = sorted((r.rank, r.item_id) for r in R.topk_similar(_frame(spark, [[1, 0]], "qid"), big, k=3).collect())
    assert [i for _, i in rows] == [0, 2, 1]
    rows = sorted((r.rank, r.item_id) for r in R.topk_similar(_frame(spark, [[0, 1]], "qid"), big, k=3).collect())
    assert [i for _, i in rows] == [2, 0, 1]  # inf * 0 is no number


def test_repeated_rows_self_and_empty(spark):
    items = _frame(spark, [[1, 0], [1, 0], [0, 1], [5, 5]], "item_id", [1, 1, 2, 3])
    queries = _frame(spark, [[1, 0], [1, 0], [0, 1]], "qid", [1, 1, 2])
    rows = sorted((r.qid, r.rank, r.item_id) for r in R.topk_similar(queries, items, k=2, exclude_self=True).collect())
    assert rows == [(1, 1, 3), (1, 1, 3), (1, 2, 2), (1, 2, 2), (2, 1, 3), (2, 2, 1)]
    assert R.topk_similar(queries.limit(0), items, k=2).collect() == []
    assert R.topk_similar(queries, items.limit(0), k=2).collect() == []
    assert R.probe_report(queries, items.limit(0)).collect() == []
    assert sorted(r.item_id for r in R.topk_similar(queries.limit(1), items, k=100).collect()) == [1, 1, 2, 3]


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for _ in range(50):
        dim, n = rng.integers(1, 9), rng.integers(1, 60)
        x = rng.normal(size=(n, dim)) * 10 ** rng.uniform(-3, 3) + rng.normal(size=dim) * 10
        centre = x.mean(axis=0, keepdims=True) * rng.choice([0.0, 1.0, 0.5])
        u = R._directions(centre)[0]
        along = x @ u
        side = np.sqrt(np.maximum((x * x).sum(axis=1) - along ** 2, 0)).max()
        norm = np.linalg.norm(x, axis=1).max()
        cells = R.Cells(centre, np.array([n]), *[np.array([v]) for v in (along.min(), along.max(), math.sqrt(side ** 2 + R.SLACK * norm ** 2),
                                                                          np.linalg.norm(x - centre, axis=1).max(), norm)], apart=0)
        q = rng.normal(size=(20, dim)) * 10 ** rng.uniform(-3, 3)
        assert (cells.bounds(q)[:, 0] >= (q @ x.T).max(axis=1)).all()


@pytest.mark.parametrize("cosine", [False, True])
def test_vectors_without_clusters_move_by_the_row(spark, monkeypatch, cosine):
    """Where no cell can be left out, a query still meets few chunks, and at
    most k items of each are kept."""
    rng = np.random.default_rng(6)
    items, queries = rng.normal(size=(3000, 16)), rng.normal(size=(40, 16))
    items[1000:1040] = items[7]  # ties
    sent = []
    plain = R._scored
    monkeypatch.setattr(R, "_scored", lambda items, probes, *a: (sent.append(probes.count()), plain(items, probes, *a))[1])
    got = {}
    for r in R.topk_similar(_frame(spark, queries, "qid"), _frame(spark, items, "item_id"), k=20, cosine=cosine).collect():
        got.setdefault(r.qid, []).append((r.rank, r.item_id))
    for q in range(40):
        assert sorted(got[q]) == [(a, b) for a, b, _ in _plain(queries[q], list(enumerate(items)), 20, cosine)]
    assert sum(sent) <= 40 * (1 + R.SHARE)


@pytest.mark.parametrize("scale", [1e-170, 1e-30, 1e30, 1e150])
def test_lengths_beyond_single_precision(spark, scale):
    rng = np.random.default_rng(7)
    items, queries = rng.normal(size=(300, 4)) * scale, rng.normal(size=(5, 4))
    got = {}
    for r in R.topk_similar(_frame(spark, queries, "qid"), _frame(spark, items, "item_id"), k=6, block=64).collect():
        got.setdefault(r.qid, []).append((r.rank, r.item_id))
    for q in range(5):
        assert sorted(got[q]) == [(a, b) for a, b, _ in _plain(queries[q], list(enumerate(items)), 6)]
