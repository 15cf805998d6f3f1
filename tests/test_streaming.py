from caseloom.session import scratch_path
from caseloom.sources.tables import RAW_POSTS
from caseloom.streaming.routing import route_incoming


def test_stream_gives_what_the_batch_gives(spark):
    rows = [(1, "u1", True, "@acme my phone caught fire", None), (2, "Acme", False, "hello", 1),
            (3, "u2", True, "@ACME battery", None), (4, "u3", True, "other", None)]
    path = scratch_path(spark, "posts")
    spark.createDataFrame(rows, RAW_POSTS).write.parquet(path)
    batch = route_incoming(spark.read.schema(RAW_POSTS).parquet(path), "Acme")
    stream = route_incoming(spark.readStream.schema(RAW_POSTS).parquet(path), "Acme")
    query = stream.writeStream.format("memory").queryName("routed").outputMode("append").start()
    try:
        query.processAllAvailable()
        got = sorted(spark.table("routed").collect())
    finally:
        query.stop()
    assert got == sorted(batch.collect())
    assert [(r.tweet_id, r.intent, r.reason) for r in got] == [
        (1, "out_of_scope_or_other", "safety_hazard"), (3, "battery_power_drain", "")]
