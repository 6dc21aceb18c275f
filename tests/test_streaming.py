"""Streaming semantics: the late-data golden case (FIXTURES.md section 4),
replay safety of the keyed-table sink, and stream = batch."""

import datetime as dt
import json
import os
import time
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sensorstream.operators import aggregates as A
from sensorstream.plans import jobs as J
from sensorstream.sources import tables as TB
from sensorstream.sources.bus import kept_start, read_bus
from sensorstream.streaming import runner as R
from sensorstream.streaming import sinks as S
from sensorstream.streaming.windows import watermark

SCHEMA = "device_id string, ts timestamp, temperature double"


def _t(h, m, s, ms=0):
    return dt.datetime(2024, 1, 1, h, m, s, ms * 1000)


def _drop_files(path, batches):
    """One Parquet file per micro-batch, modification times strictly rising."""
    os.makedirs(path, exist_ok=True)
    base = 1_700_000_000
    for i, rows in enumerate(batches):
        tbl = pa.table({"device_id": [r[0] for r in rows],
                        "ts": pa.array([r[1] for r in rows], pa.timestamp("us", tz="UTC")),
                        "temperature": [float(r[2]) for r in rows]})
        f = os.path.join(path, f"part-{i:03d}.parquet")
        pq.write_table(tbl, f)
        os.utime(f, (base + 10 * i, base + 10 * i))


def _run(spark, tmp_path, batches, name):
    src = str(tmp_path / "in")
    _drop_files(src, batches)
    emitted = []

    def collect(df, batch_id):
        for r in df.collect():   # test-only: a handful of rows
            emitted.append((batch_id, r["device_id"], r["window_start"], r["avg_temp"], r["n"]))

    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    agg = A.tumbling_agg(watermark(stream, "ts", "5 seconds"), "device_id", "ts", "1 minute",
                         {"avg_temp": F.avg("temperature"), "n": F.count(F.lit(1))})
    q = R.run_available_now(agg, collect, name, str(tmp_path / "ck"), "append")
    return emitted, R.dropped_late_rows(R.progress_dicts(q))


GOLDEN = [
    [("a", _t(0, 0, 10), 10), ("a", _t(0, 0, 59, 999), 20), ("n", None, 1)],
    [("a", _t(0, 1, 5), 30)],
    [("z", _t(0, 2, 10), 1)],
    [("a", _t(0, 0, 30), 99)],
    [("a", _t(0, 0, 31), 99)],
]


def test_late_data_golden(spark, tmp_path):
    emitted, dropped = _run(spark, tmp_path, GOLDEN, "golden")
    windows = {(d, ws): (avg, n) for _, d, ws, avg, n in emitted}
    assert windows == {("a", _t(0, 0, 0)): (15.0, 2), ("a", _t(0, 1, 0)): (30.0, 1)}
    assert dropped == 2                       # both late rows counted, none aggregated
    assert ("z", _t(0, 2, 0)) not in windows  # still open at the end of the run


def test_late_row_before_close_is_counted(spark, tmp_path):
    variant = [GOLDEN[0], GOLDEN[1], [("a", _t(0, 0, 30), 99)]]
    emitted, dropped = _run(spark, tmp_path, variant, "variant")
    windows = {(d, ws): (avg, n) for _, d, ws, avg, n in emitted}
    assert windows.get(("a", _t(0, 0, 0))) == (43.0, 3)
    assert dropped == 0


def test_upsert_replay_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "tbl")
    df = spark.createDataFrame([("d1", _t(0, 0, 0), 1.0, 1), ("d1", _t(0, 0, 0), 2.0, 2),
                                ("d2", _t(0, 0, 0), 5.0, 3)], "device_id string, ts timestamp, v double, o long")
    TB.upsert_table(df, path, 0, ["device_id", "ts"], ["o"])
    first = sorted(tuple(r) for r in TB.read_table(spark, path).collect())
    TB.upsert_table(df, path, 0)              # same batch again (replay after a crash)
    again = sorted(tuple(r) for r in TB.read_table(spark, path).collect())
    assert first == again == [("d1", _t(0, 0, 0), 2.0, 2), ("d2", _t(0, 0, 0), 5.0, 3)]
    assert TB.table_versions(spark, path).count() == 3
    newer = spark.createDataFrame([("d1", _t(0, 0, 0), 9.0, 0)], df.schema)
    TB.upsert_table(newer, path, 1)           # a later batch wins whatever its order value
    assert TB.read_table(spark, path).filter("device_id = 'd1'").first()["v"] == 9.0


def test_compaction_keeps_view_and_later_batches(spark, tmp_path):
    path = str(tmp_path / "tbl")
    mk = lambda rows: spark.createDataFrame(rows, "k string, v long")
    TB.upsert_table(mk([("a", 1), ("b", 1)]), path, 0, ["k"])
    TB.upsert_table(mk([("a", 2)]), path, 1)
    before = sorted(tuple(r) for r in TB.read_table(spark, path).collect())
    m = TB.compact(spark, path)
    assert m.generation == 1 and list(m.upto.values()) == [0]     # the newest batch stays in the log
    assert TB.compact(spark, path).generation == 1   # nothing new settled: no new generation
    TB.upsert_table(mk([("a", 3)]), path, 1)     # the newest batch may still be rewritten (replay)
    assert sorted(tuple(r) for r in TB.read_table(spark, path).collect()) == [("a", 3), ("b", 1)]
    TB.upsert_table(mk([("a", 2)]), path, 1)
    assert sorted(tuple(r) for r in TB.read_table(spark, path).collect()) == before
    TB.upsert_table(mk([("b", 7)]), path, 2)
    assert sorted(tuple(r) for r in TB.read_table(spark, path).collect()) == [("a", 2), ("b", 7)]
    d = {r["column_name"]: r["role"] for r in TB.describe_table(spark, path).collect()}
    assert d == {"k": "key", "v": "regular"}


def test_create_table_if_absent_is_noop_when_present(spark, tmp_path):
    path = str(tmp_path / "t")
    m1 = TB.create_table_if_absent(spark, path, spark.range(1).schema, ["id"])
    m2 = TB.create_table_if_absent(spark, path, spark.createDataFrame([], "x int").schema, ["x"])
    assert m1.keys == m2.keys == ["id"]
    assert TB.read_table(spark, path).count() == 0


def test_stream_restart_does_not_duplicate(spark, tmp_path):
    src, ck, out = str(tmp_path / "in"), str(tmp_path / "ck"), str(tmp_path / "out")
    _drop_files(src, [[("a", _t(0, 0, 1), 1.0), ("b", _t(0, 0, 2), 2.0)]])
    def run():
        s = spark.readStream.schema(SCHEMA).parquet(src)
        R.run_available_now(s, S.upsert_sink(out, ["device_id", "ts"]), "restart", ck)
    run()
    run()                                      # nothing new: no new batch, no duplicates
    _drop_files(src + "2", [])
    assert TB.read_table(spark, out).count() == 2
    assert TB.table_versions(spark, out).count() == 2


def test_progress_metrics_table(spark, tmp_path):
    src = str(tmp_path / "in")
    _drop_files(src, [[("a", _t(0, 0, 1), 1.0)], [("a", _t(0, 0, 2), 2.0)]])
    s = R.observe_counts(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src))
    q = R.run_available_now(s, lambda df, i: df.count(), "metrics", str(tmp_path / "ck"))
    m = R.progress_metrics(spark, "metrics", R.progress_dicts(q))
    rows = m.filter("metric = 'observed_decode_counts_rows'").collect()
    assert sum(r["value"] for r in rows) == 2.0


def test_tee_writes_every_sink_once(spark, tmp_path):
    src = str(tmp_path / "in")
    _drop_files(src, [[("a", _t(0, 0, 1), 1.0), ("b", _t(0, 0, 2), 2.0)]])
    p1, p2 = str(tmp_path / "t1"), str(tmp_path / "t2")
    s = spark.readStream.schema(SCHEMA).parquet(src)
    R.run_available_now(s, S.tee(S.upsert_sink(p1, ["device_id", "ts"]), S.quarantine_sink(p2)), "tee",
                        str(tmp_path / "ck"))
    assert TB.read_table(spark, p1).count() == 2
    assert spark.read.parquet(p2).count() == 2


def test_bounded_disorder_loses_nothing(spark, tmp_path):
    """Rows displaced by at most the watermark delay are never dropped: the
    stream's windows equal the batch windows (SURVEY 5.3)."""
    import random
    rng = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = [("d", base + dt.timedelta(seconds=i), float(i % 17)) for i in range(600)]
    # Each row may move up to 5 positions later (1 s apart: <= 5 s of disorder).
    keyed = sorted(((i + rng.uniform(0, 5), r) for i, r in enumerate(rows)), key=lambda x: x[0])
    arrived = [r for _, r in keyed]
    # Sentinel far ahead closes every window of the data.
    arrived.append(("d", base + dt.timedelta(hours=1), 0.0))
    batches = [arrived[i:i + 50] for i in range(0, len(arrived), 50)]
    src = str(tmp_path / "in")
    _drop_files(src, batches)
    got = []

    def collect(df, batch_id):
        got.extend((r["window_start"], r["n"], r["s"]) for r in df.collect())

    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    agg = A.tumbling_agg(watermark(stream, "ts", "5 seconds"), "device_id", "ts", "1 minute",
                         {"n": F.count(F.lit(1)), "s": F.sum("temperature")})
    q = R.run_available_now(agg, collect, "disorder", str(tmp_path / "ck"), "append")
    assert R.dropped_late_rows(R.progress_dicts(q)) == 0
    want = {}
    for _, t, v in rows:
        k = t.replace(second=0)
        n, s = want.get(k, (0, 0.0))
        want[k] = (n + 1, s + v)
    assert {w: (n, s) for w, n, s in got} == want


def test_crash_after_write_then_restart_is_exactly_once(spark, tmp_path):
    """K4: the sink writes batch 1, then the job dies before the batch is
    committed.  The restart replays batch 1 with the same id; the keyed table
    ends up exactly as if nothing had failed."""
    src, ck, out = str(tmp_path / "in"), str(tmp_path / "ck"), str(tmp_path / "out")
    batches = [[("a", _t(0, 0, i), float(i)), ("b", _t(0, 0, i), float(10 + i))] for i in range(3)]
    _drop_files(src, batches)
    upsert = S.upsert_sink(out, ["device_id", "ts"])
    state = {"crashed": False}

    def flaky(df, batch_id):
        upsert(df, batch_id)
        if batch_id == 1 and not state["crashed"]:
            state["crashed"] = True
            raise RuntimeError("injected failure after the write")

    def stream():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)

    try:
        R.run_available_now(stream(), flaky, "crash", ck)
        raise AssertionError("the injected failure should stop the query")
    except Exception as e:  # noqa: BLE001
        assert "injected failure" in str(e)
    R.run_available_now(stream(), flaky, "crash", ck)     # restart from the checkpoint
    rows = sorted(tuple(r) for r in TB.read_table(spark, out).collect())
    assert rows == sorted((d, t, v) for b in batches for d, t, v in b)
    assert TB.table_versions(spark, out).count() == 6      # batch 1 overwritten, not appended


def test_route_sink_dispatches_each_topic(spark, tmp_path):
    df = spark.createDataFrame([("t1", 1), ("t2", 2), ("zz", 3)], "topic string, v int")
    seen = {}

    def keep(name):
        return lambda d, i: seen.setdefault(name, sorted(r["v"] for r in d.collect()))

    sink = S.route_sink({"t1": "one", "t2": "two"},
                        {"one": (lambda d: d, keep("one")), "two": (lambda d: d, keep("two")),
                         "rejected": (lambda d: d, keep("rejected"))})
    sink(df, 0)
    assert seen == {"one": [1], "two": [2], "rejected": [3]}


def test_continuous_trigger_runs_the_same_job(spark, tmp_path):
    """The windowed job under a processing-time trigger (a long-running
    stream) gives the same table as the incremental availableNow runs."""
    from sensorstream.plans import jobs as J
    from sensorstream.sources import bus as B
    from sensorstream.sources import fixtures as X
    env = X.messages(X.events(spark, "/root/testdata/sf0.001"))
    src = str(tmp_path / "bus")
    env.write.parquet(src)
    stream = B.read_bus(spark, None, "parquet", src, streaming=True)
    q = J.windowed_averages(stream, str(tmp_path / "avg"), str(tmp_path / "ck"), trigger="1 second",
                            exact_scale=2, state_partitions=4)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = TB.read_table(spark, str(tmp_path / "avg")).count()
    want = A.tumbling_avg(X.cadence_readings(X.events(spark, "/root/testdata/sf0.001")),
                          "device_id", "ts", "1 minute").count()
    assert got == want > 0


def test_stored_progress_outlives_runs_and_recent_progress(spark, tmp_path):
    """Every report is stored once, over two restarts, though Spark keeps the newest two only."""
    path, spark_keeps = str(tmp_path / "metrics"), "spark.sql.streaming.numRecentProgressUpdates"
    saved = spark.conf.get(spark_keeps)
    spark.conf.set(spark_keeps, "2")
    try:
        for run in range(3):
            for k in range(4):
                spark.range(k + 1).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
            q = R.start_query(stream, lambda batch, n: batch.count(), "stored", str(tmp_path / "ck"), progress_path=path)
            q.awaitTermination()
            R.store_progress(spark, path, "stored").wait(q)
            assert len(q.recentProgress) <= 2
    finally:
        spark.conf.set(spark_keeps, saved)
    m = R.stored_metrics(spark, path)
    rows = m.filter("metric = 'stream_numInputRows' AND value > 0").collect()
    assert sorted(int(r.labels["batch"]) for r in rows) == list(range(12)) and sum(r.value for r in rows) == 30
    assert len({r.labels["query_id"] for r in rows}) == 1 and len({r.labels["run"] for r in rows}) == 3
    assert {r.metric for r in m.collect()} >= {"stream_inputRowsPerSecond", "stream_processedRowsPerSecond"}
    assert [tuple(r) for r in R.late_rows(m).collect()] == [("stored", 0)]


def test_replayed_batch_replaces_its_report(spark, tmp_path):
    path = str(tmp_path / "metrics")
    listener = R.store_progress(spark, path, "again")
    for run, late in (("r1", 3), ("r2", 5)):
        listener._runs.add(run)
        report = {"id": "q", "runId": run, "name": "again", "batchId": 7, "timestamp": "2031-01-01T00:00:00.000Z", "numInputRows": 9,
                  "stateOperators": [{"numRowsDroppedByWatermark": late}]}
        listener.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(json=json.dumps(report))))
    assert [tuple(r) for r in R.late_rows(R.stored_metrics(spark, path)).collect()] == [("again", 5)]


def test_windows_raw_and_rejects_from_one_reading_of_the_bus(spark, tmp_path):
    """The bus is read once a job, over restarts; all three outputs are whole, and the log's readers see no more than was sent."""
    rows = [(json.dumps({"device_id": f"d{i % 3}", "timestamp": f"2031-05-06 07:{i % 20:02d}:00.000", "temperature": i, "humidity": 1, "status": "OK"})
             if i % 7 else "broken", "t", i % 2, i, f"2031-05-06 07:{i % 20:02d}:01") for i in range(60)]
    env = (spark.createDataFrame(rows, "value string, topic string, partition int, offset long, timestamp string")
           .withColumn("value", F.encode("value", "UTF-8")).withColumn("timestamp", F.to_timestamp("timestamp")))
    out, good = {k: str(tmp_path / k) for k in ("avg", "raw", "bad", "ck", "in")}, [i for i in range(60) if i % 7]
    with R.ProgressTotals(spark) as totals:
        for lo, hi in ((0, 25), (25, 60), (60, 60)):
            env.filter((F.col("offset") >= lo) & (F.col("offset") < hi)).write.mode("append").parquet(out["in"])
            stream = spark.readStream.schema(env.schema).parquet(out["in"])
            q = J.windowed_averages(stream, out["avg"], out["ck"], delay="1 hour", raw_path=out["raw"], rejects_path=out["bad"])
            q.awaitTermination()
        end = time.time() + 20
        while totals.of("windowed_averages").get("numInputRows", 0) < 60 and time.time() < end:
            time.sleep(0.1)
        read = {n: totals.of(n).get("numInputRows") for n in ("windowed_averages_log", "windowed_averages_kept", "windowed_averages")}
    assert read == {"windowed_averages_log": 60, "windowed_averages_kept": 60, "windowed_averages": 60}
    assert sorted(r.offset for r in spark.read.parquet(out["bad"]).collect()) == [i for i in range(60) if i % 7 == 0]
    want = {}
    for i in good:
        want.setdefault((f"d{i % 3}", i % 20), []).append(i)
    raw = TB.read_table(spark, out["raw"]).collect()
    assert {(r.device_id, r.ts.minute): r.bus_offset for r in raw} == {k: max(v, key=lambda i: (i % 2, i)) for k, v in want.items()}
    avg = TB.read_table(spark, out["avg"]).collect()
    assert {(r.device_id, r.window_start.minute): r.avg_temp for r in avg} == {k: sum(v) / len(v) for k, v in want.items()}


def test_latest_keeps_its_start_over_restarts(spark, tmp_path):
    """What came while the query was down is read, once; what lay there before its first start is not."""
    src, ck, out = (str(tmp_path / n) for n in ("in", "ck", "out"))
    stamp = lambda s: dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=s)

    def send(k, at):
        (spark.createDataFrame([(bytearray([k]), "t", 0, k, at)], "value binary, topic string, partition int, offset long, timestamp timestamp")
         .withColumn("key", F.lit(None).cast("binary")).coalesce(1).write.mode("append").parquet(src))

    def run():
        stream = read_bus(spark, "t", "parquet", src, start="latest", checkpoint=ck)
        q = R.start_query(stream, lambda b, n: b.write.mode("overwrite").parquet(f"{out}/n={n}"), "latest", ck)
        q.awaitTermination()
        return sorted(r.offset for r in spark.read.parquet(out).collect()) if os.path.exists(out) else []

    send(1, stamp(-60))
    run()
    send(2, stamp(0))
    time.sleep(0.1)
    assert run() == [2]
    send(3, stamp(0))
    time.sleep(0.1)                          # a start built now would skip it
    assert run() == [2, 3] and run() == [2, 3]
    first = kept_start(spark, "latest", ck)
    assert first == kept_start(spark, "latest", ck) and kept_start(spark, "earliest", ck) == "earliest"
