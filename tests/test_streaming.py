"""E1 append mode inside a Structured Streaming foreachBatch."""

import os
import uuid


from recsmith.session import ensure_checkpoint_dir
from recsmith.streaming.encoding_stream import append_encodings, read_state, start_encoding_stream


def test_stream_appends_codes_without_changing_old_ones(spark):
    base = os.path.join(ensure_checkpoint_dir(spark), "stream-test-" + uuid.uuid4().hex)
    src, state, ckpt = (os.path.join(base, x) for x in ("src", "state", "ckpt"))
    schema = "user_id long, item_id long"
    spark.createDataFrame([(1, 10), (2, 20)], schema).write.parquet(os.path.join(src, "a"))
    q = start_encoding_stream(spark, src, spark.createDataFrame([], schema).schema, state, ckpt, ["item_id"])
    q.awaitTermination(120)
    first = {r.value: r.id for r in read_state(spark, state, "item_id").collect()}
    assert first == {10: 1, 20: 2}
    spark.createDataFrame([(3, 5), (4, 20)], schema).write.parquet(os.path.join(src, "b"))
    q = start_encoding_stream(spark, src, spark.createDataFrame([], schema).schema, state, ckpt, ["item_id"])
    q.awaitTermination(120)
    second = {r.value: r.id for r in read_state(spark, state, "item_id").collect()}
    assert second == {10: 1, 20: 2, 5: 3}


def test_replayed_batch_changes_nothing(spark):
    state = os.path.join(ensure_checkpoint_dir(spark), "stream-test-" + uuid.uuid4().hex)
    first = spark.createDataFrame([(10,), (20,)], "item_id long")
    later = spark.createDataFrame([(5,), (20,)], "item_id long")
    for batch, df in ((0, first), (0, first), (1, later), (1, later)):
        append_encodings(df, batch, state, ["item_id"])
    rows = [(r.value, r.id) for r in read_state(spark, state, "item_id").collect()]
    assert sorted(rows) == [(5, 3), (10, 1), (20, 2)]
