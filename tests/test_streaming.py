"""The stateless cleaning operators on a Structured Streaming file source."""

import tempfile

from fleetspark.sources.fixtures import load_inputs
from fleetspark.streaming.clean_stream import cleaned_ping_stream

from .conftest import SF_SMALL


def test_cleaned_ping_stream_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="fs-stream-")
    tel = load_inputs(spark, SF_SMALL).telemetry.drop("ts_us")
    tel.write.parquet(f"{d}/in")
    schema = spark.read.parquet(f"{d}/in").schema
    s = cleaned_ping_stream(spark, f"{d}/in", schema)
    q = (s.select("vehicle", "ping_id", "gps_ok", "speed").writeStream.format("memory").queryName("clean_pings")
         .option("checkpointLocation", f"{d}/ckpt").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.sql("SELECT * FROM clean_pings")
    from fleetspark.operators.clean import clean_haulers
    from fleetspark.plans.queries import FIXTURE_PARAMS
    want = clean_haulers(load_inputs(spark, SF_SMALL).telemetry, FIXTURE_PARAMS).select("vehicle", "ping_id", "gps_ok",
                                                                                       "speed")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
