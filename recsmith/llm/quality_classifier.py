"""Quality classifier on random-indexing word vectors (operator 2).

Words are hashed to a fixed number of rows (feature hashing: words that share a
row share its vector and its weight). Every row has a sparse index vector
of -1, 0 and 1; a word's vector is the sum of the index vectors of its
neighbours (two on each side) over the whole corpus. These sums are integers,
so they come out alike however the corpus is partitioned, and their table has a
fixed size. A document is pooled to the mean and the spread of its words'
vectors, frequent words weighted down. A two-layer network is trained in numpy
on a bounded sample of labelled documents (SAMPLE rows, those of the least
hashed doc_ids), its temperature is fitted on a part kept out of training, and
all documents are scored in one pass.

Labels, lang, source and doc_id are no inputs of a score. Rows with
crc32(doc_id as text) mod 3 = 1 are held out: their labels are never read.

Defined results: null, empty and blank texts pool to zeros and are scored;
null doc_ids are not held out and never trained on; without labels of both
kinds every score is the share of good labels, or 0.5; repeated rows are scored
one by one; output columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.llm import textscan as ts
from recsmith.llm.blocks import as_blocks, summed
from recsmith.llm.common import written

#: Rows and columns of the word table, entries of an index vector, neighbours on a side.
ROWS, DIM, ENTRIES, REACH = 1 << 14, 48, 4, 2
#: Labelled documents that the network is fitted on, at most.
SAMPLE = 20_000
#: Share of the sample (one in so many) that fits the temperature.
CALIBRATE = 5
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 32, 30, 128, 3e-3, 1e-4, 11


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def index_vectors() -> np.ndarray:
    rng = np.random.default_rng(SEED)
    out = np.zeros((ROWS, DIM), dtype=np.int32)
    for k in range(ENTRIES):
        out[np.arange(ROWS), rng.integers(0, DIM, ROWS)] = 1 if k % 2 else -1
    return out


def _rows(chunk: ts.Chunk) -> tuple[np.ndarray, ts.Words]:
    """Row of each word of a chunk."""
    found = ts.words(chunk, ~ts.is_blank(chunk.codes))
    return (ts.span_hash(ts.char_values(chunk.codes), found.starts, found.ends) % np.uint64(ROWS)).astype(np.int64), found


def word_table(docs: DataFrame) -> np.ndarray:
    """(ROWS, DIM + 1): context sums of each row, and its number of words."""

    def count(batches):
        index = index_vectors()
        total = np.zeros((ROWS, DIM + 1), dtype=np.int64)
        for batch in batches:
            for chunk in ts.chunks(batch.column(0)):
                rows, found = _rows(chunk)
                if len(rows) == 0:
                    continue
                doc = found.doc
                context = np.zeros((len(rows), DIM + 1), dtype=np.int32)
                for step in range(1, REACH + 1):
                    near = np.flatnonzero(doc[step:] == doc[:-step])
                    context[near, :DIM] += index[rows[near + step]]
                    context[near + step, :DIM] += index[rows[near]]
                context[:, DIM] = 1
                order = np.argsort(rows, kind="stable")
                first = np.flatnonzero(np.concatenate([[True], np.diff(rows[order]) > 0]))
                total[rows[order[first]]] += np.add.reduceat(context[order], first, axis=0)
        yield as_blocks(total)

    return summed(docs.select("text").mapInArrow(count, "block int, data binary"), ROWS, DIM + 1)


def _vectors(total: np.ndarray) -> np.ndarray:
    """Unit vectors of the rows, weighted down by frequency."""
    context, n = total[:, :DIM].astype(np.float64), total[:, DIM]
    context -= context.sum(axis=0) * (n / max(n.sum(), 1))[:, None]  # what any word's neighbours have in common
    context /= np.maximum(np.linalg.norm(context, axis=1), 1e-9)[:, None]
    return (context * (1e-3 / (1e-3 + n / max(n.sum(), 1)))[:, None]).astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, vec): mean and spread of the words' vectors."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vectors)  # a table of fixed size
    schema = T.StructType([docs.schema["doc_id"], T.StructField("vec", T.ArrayType(T.FloatType()))])

    def pool(batches):
        table = shared.value
        for batch in batches:
            for chunk in ts.chunks(batch.column(1)):
                rows, found = _rows(chunk)
                n = np.diff(found.first)
                out = np.zeros((chunk.n, 2 * DIM), dtype=np.float32)
                full = np.flatnonzero(n > 0)
                if len(full):
                    words = table[rows]
                    size = n[full][:, None].astype(np.float32)
                    mean = np.add.reduceat(words, found.first[full], axis=0) / size
                    square = np.add.reduceat(words * words, found.first[full], axis=0) / size
                    out[full, :DIM], out[full, DIM:] = mean, np.sqrt(np.maximum(square - mean * mean, 0))
                offsets = pa.array(np.arange(chunk.n + 1, dtype=np.int32) * (2 * DIM))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.row, chunk.n),
                                                  pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))], names=["doc_id", "vec"])

    return docs.select("doc_id", "text").mapInArrow(pool, schema)


@dataclass
class Network:
    """Standardised input, one hidden layer, one logit, a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x.astype(np.float64)) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(_sigmoid(z), 1e-12, 1 - 1e-12)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the cross entropy, then the temperature of least cross entropy
    on every CALIBRATE-th row, which training does not see."""
    x, y = x.astype(np.float64), y.astype(np.float64)
    if len(y) == 0 or y.min() == y.max():
        width = x.shape[1] if x.ndim == 2 else 2 * DIM
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    apart = np.arange(len(y)) % CALIBRATE == 0
    if len(y) < 50 or y[apart].min() == y[apart].max() or y[~apart].min() == y[~apart].max():
        apart = np.zeros(len(y), dtype=bool)
    xt, yt = x[~apart], y[~apart]
    rng = np.random.default_rng(SEED)
    net = Network(xt.mean(axis=0), xt.std(axis=0) + 1e-6, rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)),
                  np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), 0.0)
    data = (xt - net.mean) / net.scale
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(yt))
        for at in range(0, len(yt), BATCH):
            rows = order[at:at + BATCH]
            a, hidden = data[rows], None
            hidden = np.maximum(a @ params[0] + params[1], 0)
            delta = (_sigmoid(hidden @ params[2] + params[3]) - yt[rows]) / len(rows)
            back = np.outer(delta, params[2]) * (hidden > 0)
            grads = [a.T @ back + DECAY * params[0], back.sum(axis=0), hidden.T @ delta + DECAY * params[2], np.array([delta.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                params[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    net.b2 = float(params[3][0])
    if apart.any():
        z, tries = net.logits(x[apart]), np.exp(np.linspace(np.log(0.2), np.log(20), 200))
        net.temperature = float(tries[np.argmin([_loss(z / t, y[apart]) for t in tries])])
    return net


def training_rows(vectors: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and labels of at most `sample` labelled documents that are not
    held out; a document with several labels counts by their majority."""
    known = (labels.filter("doc_id is not null and quality is not null").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg((2 * F.sum(F.col("quality").cast("int")) >= F.count("*")).cast("int").alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (vectors.join(F.broadcast(written(known)), "doc_id").select(F.xxhash64("doc_id").alias("h"), "doc_id", "vec", "y")
            .orderBy("h", "doc_id", "vec").limit(sample).toArrow())
    n = rows.num_rows
    x = rows.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 2 * DIM))
    return x, rows.column("y").to_numpy()


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    spark = docs.sparkSession
    vectors = written(pooled(docs, _vectors(word_table(docs))))
    net = spark.sparkContext.broadcast(fit(*training_rows(vectors, labels, sample)))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def score(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(net.value.score(x))], names=schema.names)

    return vectors.mapInArrow(score, schema).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
