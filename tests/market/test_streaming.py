"""Streams give what the batch forms give."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeweave.streaming import ingest

EVENTS = "/root/testdata/sf0.001/events.parquet"


def test_tumbling_stream_equals_batch(spark, tmp_path):
    spark.read.parquet(EVENTS).repartition(3).write.parquet(str(tmp_path / "in"))
    stream = ingest.tumbling(ingest.event_stream(spark, str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("tumbled").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((str(r["window_start"]), r["event_type"], r["events"]) for r in spark.table("tumbled").collect())
    batch = ingest.tumbling(spark.read.parquet(EVENTS))
    assert got == sorted((str(r["window_start"]), r["event_type"], r["events"]) for r in batch.collect())


def test_upsert_stream_replays(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    inbox = str(tmp_path / "in")
    run = lambda: ingest.upsert_batches(spark.readStream.schema(schema).parquet(inbox), str(tmp_path / "t"), str(tmp_path / "ck"), ["k"], schema).awaitTermination(120)
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(inbox)
    run()
    spark.createDataFrame([(2, "c"), (3, "d")], schema).write.mode("append").parquet(inbox)
    run()
    run()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t/v=1")).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_sessions_and_sliding(spark):
    e = spark.read.parquet(EVENTS)
    assert ingest.sessions(e).agg(F.sum("events")).first()[0] == e.count()
    assert ingest.sliding(e).agg(F.sum("events")).first()[0] == 2 * e.count()
