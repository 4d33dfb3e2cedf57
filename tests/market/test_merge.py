"""Merges of touched buckets, the lossless dedupe and the high-water mark, with failures, replays and restarts."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeweave.operators.staging import upsert
from tapeweave.streaming import ingest, merge

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("at", T.IntegerType())])
EVENTS = "/root/testdata/sf0.001/events.parquet"


def rows(df):
    return sorted(map(tuple, df.collect()))


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = merge.BucketedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets=32)
    assert rows(table.read()) == [] and table.read().columns == ["k", "v", "at"]
    first = spark.range(20_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(1).alias("at"))
    assert table.merge(first)
    whole, before = size(tmp_path / "t/data"), table._state()["folders"]
    batch = spark.createDataFrame([(5, "new", 2), (5, "newer", 3), (99_999, "added", 2)], SCHEMA)
    expected = upsert(first, batch.filter("at = 3 or k = 99999"), ["k"])
    assert table.merge(batch, newest=("at",))
    after = table._state()["folders"]
    changed = [b for b in after if after[b] != before.get(b)]
    assert 1 <= len(changed) <= 2 and size(tmp_path / "t/data") - whole < whole / 8
    assert rows(table.read()) == rows(expected.select("k", "v", "at"))
    assert rows(table.read(1)) == rows(first)
    with pytest.raises(ValueError, match="buckets"):
        merge.BucketedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets=8).read()


def test_replays_failures_and_vacuum(spark, tmp_path, monkeypatch):
    table = merge.BucketedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets=4)
    batches = [spark.createDataFrame([(i, f"{n}", n) for i in range(n, n + 6)], SCHEMA) for n in range(3)]
    assert table.merge(batches[0], number=0) and table.merge(batches[1], number=1, resets={"at": F.lit(None).cast("int")})
    done = rows(table.read())
    assert [r for r in done if r[0] == 3] == [(3, "1", None)]
    assert not table.merge(batches[0], number=0) and not table.merge(batches[1], number=1) and rows(table.read()) == done
    put = table._files.put
    monkeypatch.setattr(table._files, "put", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.merge(batches[2], number=2)
    assert rows(table.read()) == done and table.versions() == [1, 2]
    monkeypatch.setattr(table._files, "put", put)
    orphans = size(tmp_path / "t/data")
    assert table.merge(batches[2], number=2)
    table.vacuum(keep=1)
    assert table.versions() == [3] and size(tmp_path / "t/data") < orphans
    assert [r[0] for r in rows(table.read())] == list(range(8)) and rows(table.read())[-1] == (7, "2", 2)
    assert not table.merge(spark.createDataFrame([], SCHEMA))


def test_stream_of_late_and_corrected_rows(spark, tmp_path):
    events = spark.read.parquet(EVENTS).select(F.col("event_id").alias("k"), F.col("event_type").alias("v"), F.lit(1).alias("at")).collect()
    draw = random.Random(1)
    inbox, want = str(tmp_path / "in"), {}
    table = merge.BucketedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets=8)
    run = lambda: merge.merge_batches(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(inbox), table, str(tmp_path / "ck"), newest=("at",)).awaitTermination(300)
    for n in range(3):
        part = [(r["k"], r["v"] if n == 0 else f"fixed {n}", n) for r in draw.sample(events, 200)]
        want.update({k: (k, v, at) for k, v, at in part})
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        if n != 1:
            run()  # after a restart the stream goes on with two files' batches
    run()
    assert rows(table.read()) == sorted(want.values()) and table._state()["batch"] == 2


def test_each_event_once_however_late(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    events = spark.read.parquet(EVENTS).limit(60)
    inbox = str(tmp_path / "in")

    def run():
        stream = merge.once_each(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(inbox))
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(300)

    try:
        ordered = events.orderBy(F.col("ts").desc())  # the newest first, so most rows are later than any watermark
        ordered.limit(40).unionByName(ordered.limit(5)).coalesce(1).write.parquet(inbox)
        run()
        ordered.coalesce(1).write.mode("append").parquet(inbox)
        run()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(events)


def test_high_water_mark(spark, tmp_path):
    mark, seen = merge.HighWaterMark(spark, str(tmp_path / "mark")), []
    t = lambda h: dt.datetime(2024, 1, 1, h)
    table = lambda hours: spark.createDataFrame([(h, t(h)) for h in hours], "id int, at timestamp")
    work = lambda df: seen.append(sorted(r["id"] for r in df.collect()))
    assert mark.run(table([1, 2]), "at", work) and mark.run(table([1, 2, 3, 5]), "at", work)
    with pytest.raises(ZeroDivisionError):
        mark.run(table([5, 6]), "at", lambda df: 1 / 0)
    assert mark.run(table([4, 5, 6]), "at", work) and seen == [[1, 2], [2, 3, 5], [5, 6]]
    assert not mark.run(table([1]), "at", work) and len(seen) == 3


def test_sliding_forgets_what_the_watermark_has_passed(spark, tmp_path):
    spark.read.parquet(EVENTS).write.parquet(str(tmp_path / "in"))
    stream = ingest.sliding(ingest.event_stream(spark, str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("slid").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert 0 < spark.table("slid").count() <= ingest.sliding(spark.read.parquet(EVENTS)).count()
