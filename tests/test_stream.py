import pytest
from pyspark.sql import functions as F, types as T

from starloom.streaming.incremental import read_landing, stream_upsert

EVENTS = "/root/testdata/sf0.001/events.parquet"


def test_landing_files_are_upserted_once(spark, store, tmp_path):
    events = spark.read.parquet(EVENTS).select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    landing = str(tmp_path / "landing")
    store.ensure_table("events", T.StructType.fromDDL("event_id bigint, user_id bigint, event_type string, ts timestamp"))

    def go():
        stream = read_landing(spark, landing, events.schema)
        stream_upsert(stream, store, "events", ["event_id"], ["ts"], str(tmp_path / "cp")).awaitTermination(120)

    events.write.parquet(landing)
    go()
    assert store.read("events").count() == events.count()
    changed = events.filter("event_type = 'error'").withColumns({"event_type": F.lit("fixed"), "ts": F.col("ts") + F.expr("INTERVAL 1 DAY")})
    changed.write.mode("append").parquet(landing)
    go()
    go()
    got = store.read("events")
    assert got.count() == events.count()
    assert got.filter("event_type = 'fixed'").count() == changed.count() and got.filter("event_type = 'error'").isEmpty()


def test_a_key_is_required(spark, store):
    with pytest.raises(ValueError):
        stream_upsert(spark.readStream.format("rate").load(), store, "t", [], ["ts"], "/tmp/none")
