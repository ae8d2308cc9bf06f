"""Skip-gram over parameter blocks: gradients, communities, slices, rounds."""

import numpy as np

from recsmith.operators import skipgram as S


def test_pairs_stay_inside_the_window(spark):
    walks = spark.createDataFrame([(1, 0, s, n) for s, n in enumerate([10, 20, 30, 10, 40])] + [(2, 0, 0, 99), (3, 0, 0, None)],
                                  "start long, walk int, step int, node long")
    got = {(r.centre, r.context): r.n for r in S.walk_pairs(walks, 1).collect()}
    assert got == {(10, 20): 1, (20, 10): 1, (20, 30): 1, (30, 20): 1, (30, 10): 1, (10, 30): 1, (10, 40): 1, (40, 10): 1}
    wide = {(r.centre, r.context): r.n for r in S.walk_pairs(walks, 3).collect()}
    assert all(wide.get(k, 0) >= n for k, n in got.items()) and (10, 99) not in wide


def test_one_step_follows_the_gradient():
    """A single batch of one pair against the derivative of its loss."""
    rng = np.random.default_rng(0)
    centre, context = rng.normal(size=(3, 4)), rng.normal(size=(5, 4))
    freq = np.array([0.0, 1.0, 0.0, 0.0, 0.0])  # the only negative is node 1

    def loss(c, x):
        s = S._sigmoid
        return -np.log(s(c[2] @ x[3])) - 2 * np.log(1 - s(c[2] @ x[1]))

    a, b = centre.copy(), context.copy()
    got = S.train_cell(a, b, (np.zeros(3), np.zeros(5)), (np.array([2]), np.array([3]), np.array([1.0])), freq, np.random.default_rng(1), negatives=2, rate=1e-3)
    assert abs(got - loss(centre, context)) < 1e-9
    for table, moved, row in ((centre, a, 2), (context, b, 3), (context, b, 1)):
        slope = np.zeros(4)
        for d in range(4):
            up = table.copy()
            up[row, d] += 1e-6
            slope[d] = ((loss(up, context) if table is centre else loss(centre, up)) - loss(centre, context)) / 1e-6
        step = moved[row] - table[row]
        assert np.allclose(step / np.linalg.norm(step), -slope / np.linalg.norm(slope), atol=1e-3)
    assert np.array_equal(a[:2], centre[:2]) and np.array_equal(b[[0, 2, 4]], context[[0, 2, 4]])


def _communities(spark, groups=4, size=12, walks=30, length=10):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(groups):
        for n in range(size):
            for w in range(walks):
                path = [g * size + n] + [g * size + int(k) for k in rng.integers(0, size, length - 1)]
                if rng.random() < 0.1:  # some walks leave their community
                    path[-1] = int(rng.integers(0, groups * size))
                rows += [(path[0], w, s, node) for s, node in enumerate(path)]
    return spark.createDataFrame(rows, "start long, walk int, step int, node long")


def test_communities_are_nearer_than_chance_and_the_loss_falls(spark):
    walks = _communities(spark)
    losses = []
    emb = S.skipgram_embeddings(walks, dim=16, window=4, epochs=4, blocks=3, cell_pairs=300, losses=losses).collect()
    assert sorted(r.node for r in emb) == list(range(48)) and len(losses) == 4
    assert losses[-1] < losses[0] < 6 * np.log(2) + 0.01
    x = np.stack([np.array(r.vec) for r in sorted(emb, key=lambda r: r.node)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T
    same = np.arange(48)[:, None] // 12 == np.arange(48)[None, :] // 12
    np.fill_diagonal(near, np.nan)
    assert np.nanmean(near[same]) > np.nanmean(near[~same]) + 0.1  # the vectors share a direction
    np.fill_diagonal(near, -1)
    assert (near.argmax(axis=1) // 12 == np.arange(48) // 12).mean() > 0.9


def test_same_vectors_on_every_run_and_odd_walks(spark):
    walks = _communities(spark, groups=2, size=5, walks=4, length=5)
    runs = [sorted((r.node, tuple(r.vec)) for r in S.skipgram_embeddings(w, dim=4, window=2, epochs=1, blocks=2).collect())
            for w in (walks, walks.repartition(5))]
    assert runs[0] == runs[1]
    lonely = spark.createDataFrame([(1, 0, 0, 7), (2, 0, 0, None)], "start long, walk int, step int, node long")
    assert [(r.node, len(r.vec)) for r in S.skipgram_embeddings(lonely, dim=4, epochs=1).collect()] == [(7, 4)]
    assert S.skipgram_embeddings(lonely.limit(0), dim=4).collect() == []


def test_no_model_on_the_driver(spark):
    import inspect
    text = inspect.getsource(S)
    assert "collect(" not in text and "toPandas" not in text and "pyspark.ml" not in text
