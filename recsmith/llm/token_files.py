"""Token ids as Arrow files of equal-length sequences (operator 10).

Texts are put in ascending doc_id order by a range partitioning, encoded with
the tokenizers library (each distinct word once for a worker), closed with an
end id and packed without gaps into sequences of one length. Every partition
streams its sequences into one Arrow file: record batches of `tokens`
(fixed-size list of uint16, or uint32 for large vocabularies) and `mask`
(fixed-size list of bool, false where the last sequence is padded). Neither is
compressed, so a memory map gives any sequence without a copy.

An index table (Parquet) says where each document stands: shard, file, place
in the shard's ids, number of ids. It is the commit of the files: a task that
is run again writes a file of another name, and only the file named by the
attempt whose index rows Spark committed is ever read.

Defined results: null counts as an empty text (the end id only); rows without
doc_id come first; rows that repeat a doc_id follow the hash of their texts, then the texts;
an empty table gives an empty index; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recsmith.llm import textscan as ts
from recsmith.llm.pretokens import Encoder, byte_letters, vocabulary

SEQUENCE = 1024
#: Sequences in one record batch.
BATCH = 256
END_ID = 0


@lru_cache(maxsize=2)
def library_encoder(path: str) -> Encoder:
    """Words go through the model of the tokenizers library."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    model, letters = tokenizer.model, byte_letters()
    return Encoder(vocabulary(path), lambda words: [
        [t.id for t in model.tokenize("".join(map(letters.__getitem__, w.encode("utf-8"))))] for w in words])


def _location(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^(file:)?/+", "file:///", uri))


class SequenceWriter:
    """Packs ids into sequences and streams them into one Arrow file."""

    def __init__(self, uri: str, length: int, kind: np.dtype):
        self.length, self.kind = length, np.dtype(kind)
        value = pa.from_numpy_dtype(self.kind)
        self.schema = pa.schema([("tokens", pa.list_(value, length)), ("mask", pa.list_(pa.bool_(), length))])
        system, path = _location(uri)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(path)
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.waiting: list[np.ndarray] = []
        self.n = 0  # ids waiting

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.kind))
        self.n += len(ids)
        full = self.length * BATCH
        if self.n >= full:
            data = np.concatenate(self.waiting)
            whole = len(data) // full * full
            for at in range(0, whole, full):
                self._batch(data[at:at + full], full)
            self.waiting, self.n = [data[whole:]], len(data) - whole

    def _batch(self, data: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(data)) < real)
        self.writer.write_batch(pa.record_batch([
            pa.FixedSizeListArray.from_arrays(pa.array(data), self.length),
            pa.FixedSizeListArray.from_arrays(mask, self.length)], schema=self.schema))

    def close(self) -> None:
        if self.n:
            data = np.concatenate(self.waiting)
            padded = np.zeros(-(-len(data) // self.length) * self.length, dtype=self.kind)
            padded[:len(data)] = data
            self._batch(padded, len(data))
        self.writer.close()
        self.out.close()


class SequenceReader:
    """Random access to the sequences of one file; on a local or mounted path
    they are views of the memory map."""

    def __init__(self, uri: str):
        system, path = _location(uri)
        source = pa.memory_map(path) if isinstance(system, pafs.LocalFileSystem) else system.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("tokens").type.list_size
        self._last: tuple[int, np.ndarray, pa.Array] | None = None

    def _load(self, b: int) -> tuple[int, np.ndarray, pa.Array]:
        if self._last is None or self._last[0] != b:
            batch = self.file.get_batch(b)
            self._last = (b, batch.column(0).values.to_numpy(zero_copy_only=True), batch.column(1).values)
        return self._last

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """(tokens, mask) of the k-th sequence."""
        _, tokens, mask = self._load(k // BATCH)
        lo = k % BATCH * self.length
        return tokens[lo:lo + self.length], mask.slice(lo, self.length)

    def ids(self, start: int, count: int) -> np.ndarray:
        """`count` ids of the shard from `start` on; they must not be padding."""
        full, parts = self.length * BATCH, []
        while count:
            _, tokens, mask = self._load(start // full)
            lo = start % full
            n = min(count, len(tokens) - lo)
            if n <= 0 or not mask[lo + n - 1].as_py():
                raise ValueError("the index reaches beyond the file's ids")
            parts.append(tokens[lo:lo + n])
            start, count = start + n, count - n
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, length: int = SEQUENCE,
                      end_id: int = END_ID) -> DataFrame:
    """Writes the files under `folder`/data and the index under
    `folder`/index; returns the index: shard, file, doc_id, place, n_tokens."""
    spark = docs.sparkSession
    schema = docs.select("doc_id").schema
    for name, kind in (("shard", "integer"), ("file", "string"), ("place", "long"), ("n_tokens", "long")):
        schema = schema.add(name, kind)

    def write(batches):
        enc = library_encoder(tokenizer)
        kind = np.uint16 if max(len(enc.vocab.bytes), end_id + 1) <= 1 << 16 else np.uint32
        shard = TaskContext.get().partitionId()
        uri, writer, place = f"{folder}/data/shard-{shard:06d}-{uuid.uuid4().hex}.arrow", None, 0
        for batch in batches:
            for chunk in ts.chunks(batch.column(1)):
                writer = writer or SequenceWriter(uri, length, kind)
                ids, ends, _, _ = enc.encode(chunk)
                writer.add(np.insert(ids, ends[1:], end_id))
                size = np.diff(ends) + 1
                at = place + np.cumsum(size) - size
                place += int(size.sum())
                n = chunk.n
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(chunk.row, n), pa.array(np.full(n, shard, np.int32)),
                    pa.array([uri] * n, pa.string()), pa.array(at, pa.int64()), pa.array(size, pa.int64())], names=schema.names)
        if writer:
            writer.close()

    # the text's hash parts rows that repeat a doc_id; the driver samples these
    # keys for the ranges, so the text itself must not be one of them
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = (docs.select("doc_id", "text").repartitionByRange(*keys)
               .sortWithinPartitions(*keys, F.col("text").asc_nulls_first()))
    ordered.mapInArrow(write, schema).write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def read_documents(index: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32
    (of the ids as little-endian 32-bit integers) of every document, from the
    files."""
    schema = index.select("doc_id", "shard", "place", "n_tokens").schema.add("ids_crc32", "long")

    def read(batches):
        reader, current = None, None
        for batch in batches:
            files, places, counts = (batch.column(i).to_pylist() for i in (4, 2, 3))
            out = []
            for file, place, count in zip(files, places, counts, strict=True):
                if file != current:
                    reader, current = SequenceReader(file), file
                out.append(zlib.crc32(reader.ids(place, count).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(4)], pa.array(out, pa.int64())], names=schema.names)

    found = index.select("doc_id", "shard", "place", "n_tokens", "file").mapInArrow(read, schema)
    # one row for each shard, so this window is as small as the list of files
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    before = totals.select(F.col("shard").alias("_shard"), (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("before"))
    return (found.join(F.broadcast(before), F.col("shard") == F.col("_shard"))
            .select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"))
