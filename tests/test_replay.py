"""Replayed slices: work for all cores, one slice a micro-batch."""

from pyspark.sql import functions as F

from sensorstream import queries as Q
from sensorstream.schemas import ENVELOPE
from sensorstream.sources.replay import replay_files, replay_slices
from sensorstream.streaming import runner as R


def test_slices_of_one_file_are_dealt_to_all_cores(spark, tmp_path):
    ids = spark.range(0, 9000, 1, 1)
    ids.selectExpr("id AS event_id", "timestamp_ntz '2024-01-01 00:00:00' AS ts", "id AS user_id", "'view' AS event_type",
                   "id / 7 AS value", "'{\"k\": 1}' AS props").write.parquet(str(tmp_path / "events.parquet"))
    cores, bus = R.cluster_cores(spark), tmp_path / "bus"
    seen = []
    replay_slices(Q._bus_records(spark, str(tmp_path)), str(bus), 3, after_each=lambda i: seen.append(len(list(bus.glob("*.parquet")))))
    assert cores > 1 and seen == [cores, 2 * cores, 3 * cores]
    files = spark.read.parquet(str(bus)).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == 9000 and max(r["count"] for r in files) < 3 * 9000 / len(files)


def test_a_micro_batch_is_a_slice_of_several_files(spark, tmp_path):
    slice_of = F.when(F.col("id") < 1, 0).when(F.col("id") < 3, 1).otherwise(5)
    env = spark.range(53).select(F.lit(None).cast("binary").alias("key"), F.lit("x").cast("binary").alias("value"),
                                 F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
                                 F.current_timestamp().alias("timestamp"), slice_of.alias("slice"))
    bus, got = str(tmp_path / "bus"), []
    for first, last in ((0, 1), (2, None)):
        assert replay_files(env, bus, str(tmp_path / "staged"), "slice", first, last, files=4) == (8 if first == 0 else 4)
        stream = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 4).parquet(bus)
        q = R.start_query(stream, lambda batch, n: got.append(sorted(r.offset for r in batch.collect())), "slices", str(tmp_path / "ck"))
        q.awaitTermination()
        assert q.exception() is None
    assert got == [[0], [1, 2], list(range(3, 53))] and len(list((tmp_path / "bus").glob("*.parquet"))) == 12
