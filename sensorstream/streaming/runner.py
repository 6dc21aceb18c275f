"""Starting queries, incremental runs, and progress as metric rows."""

from __future__ import annotations

import datetime as _dt
import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..schemas import METRIC
from ..session import scratch_path
from ..sources.tables import batch_folder


_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
_SHUFFLE = "spark.sql.shuffle.partitions"


def start_query(df: DataFrame, sink, name: str, checkpoint: str | None = None,
                output_mode: str = "append", trigger: str | dict = "availableNow",
                writer=None, no_data_batches: bool | None = None,
                state_partitions: int | None = None, progress_path: str | None = None) -> StreamingQuery:
    """Start a streaming query.  ``sink`` is a ``foreachBatch`` function, or
    None when ``writer`` (a prepared ``DataStreamWriter``) is given.  The
    checkpoint holds source offsets and window state: restarting with the same
    checkpoint resumes exactly where the last committed batch ended (S4).

    Both options below are session settings captured when the query starts:

    ``no_data_batches=False`` skips the extra micro-batch Spark runs only to
    advance the watermark.  Right for ``update`` mode into a keyed table (that
    batch emits nothing; state is evicted on the next data batch), wrong for
    ``append`` mode, where it is what emits windows closed without new data.

    ``state_partitions`` sizes the stateful operators (window state) at the
    query's first start; the number is then fixed in the checkpoint.  Size it
    to the cluster (about the number of cores), not to the batch default.

    ``progress_path`` keeps every progress report as METRIC rows there (see
    :class:`StoredProgress`).
    """
    spark = df.sparkSession
    if progress_path:
        store_progress(spark, progress_path, name)
    overrides = {}
    if no_data_batches is not None:
        overrides[_NO_DATA] = str(bool(no_data_batches)).lower()
    if state_partitions is not None:
        overrides[_SHUFFLE] = str(int(state_partitions))
    saved = {k: spark.conf.get(k, None) for k in overrides}
    for k, v in overrides.items():
        spark.conf.set(k, v)
    try:
        ck = checkpoint or scratch_path(spark, "checkpoint", name)
        w = writer if writer is not None else df.writeStream
        w = w.queryName(name).option("checkpointLocation", ck).outputMode(output_mode)
        if sink is not None:
            w = w.foreachBatch(sink)
        if trigger == "availableNow":
            w = w.trigger(availableNow=True)
        elif isinstance(trigger, dict):
            w = w.trigger(**trigger)
        else:
            w = w.trigger(processingTime=trigger)
        return w.start()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def cluster_cores(spark: SparkSession) -> int:
    """Total task slots of the cluster (a sizing default for state)."""
    try:
        return max(1, int(spark.sparkContext.defaultParallelism))
    except Exception:  # noqa: BLE001
        return int(spark.conf.get(_SHUFFLE, "200"))


def run_available_now(df: DataFrame, sink, name: str, checkpoint: str,
                      output_mode: str = "append", writer=None, timeout_s: int = 600) -> StreamingQuery:
    """Process everything available now, then stop (an incremental batch run)."""
    q = start_query(df, sink, name, checkpoint, output_mode, "availableNow", writer)
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"query {name} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    return q


def observe_counts(df: DataFrame, name: str = "decode_counts", reason_col: str = "reject_reason") -> DataFrame:
    """K8: per-batch success/error counts computed inside the query."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if reason_col in df.columns:
        aggs.append(F.sum(F.when(F.col(reason_col).isNotNull(), 1).otherwise(0)).alias("rejected"))
    return df.observe(name, *aggs)


def progress_dicts(q: StreamingQuery) -> list[dict]:
    """``recentProgress`` as plain dicts."""
    out = []
    for p in q.recentProgress:
        j = getattr(p, "json", None)
        if callable(j):
            j = j()
        out.append(json.loads(j) if isinstance(j, str) else dict(p))
    return out


def dropped_late_rows(progress: list[dict]) -> int:
    """Rows dropped by the watermark over the given progress reports."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0))
               for p in progress for op in p.get("stateOperators", []))


class ProgressTotals(StreamingQueryListener):
    """Running totals over *every* progress report of a session's
    queries (``recentProgress`` keeps only the newest 100), by query name.

    Use ``with ProgressTotals(spark) as totals``; memory does not grow with the
    number of reports."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._sums: dict[str, dict[str, float]] = {}

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_):
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        p = json.loads(event.progress.json)
        mine = self._sums.setdefault(p.get("name") or p["id"], {"reports": 0, "numInputRows": 0,
                                                                "numRowsDroppedByWatermark": 0})
        mine["reports"] += 1
        mine["numInputRows"] += p.get("numInputRows", 0)
        mine["numRowsDroppedByWatermark"] += dropped_late_rows([p])
        for name, values in (p.get("observedMetrics") or {}).items():
            for k, v in values.items():
                if isinstance(v, (int, float)):
                    mine[f"{name}_{k}"] = mine.get(f"{name}_{k}", 0) + v

    def of(self, name: str) -> dict[str, float]:
        return dict(self._sums.get(name, {}))


_RATE_FIELDS = ("numInputRows", "inputRowsPerSecond", "processedRowsPerSecond")


class StoredProgress(StreamingQueryListener):
    """Every progress report of the watched queries as METRIC rows in a
    table: input rows, rates, rows dropped as late, observed counts.

    A report's folder is named by the query's id (which lives in its checkpoint)
    and the batch: a replayed batch replaces its own report, a restarted query
    goes on after the last one, and nothing is kept in the driver.  Reports
    arrive after their batch; ``wait`` returns when a stopped query's last one is
    stored.  Get one from :func:`store_progress`.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._names: set[str] = set()
        self._runs: set[str] = set()
        self._ended: dict[str, threading.Event] = {}
        self._errors: list[Exception] = []

    def watch(self, name: str) -> None:
        self._names.add(name)

    def onQueryStarted(self, event):
        if event.name in self._names:
            self._runs.add(str(event.runId))

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        report = json.loads(event.progress.json)
        if report["runId"] not in self._runs:
            return
        try:
            rows = progress_metrics(self.spark, report.get("name"), [report])
            folder = batch_folder(self.path, f"{report['id']}-progress", report["batchId"])
            rows.coalesce(1).write.mode("overwrite").parquet(folder)
        except Exception as e:  # noqa: BLE001  (a listener's error would be swallowed: wait() raises it)
            self._errors.append(e)

    def onQueryTerminated(self, event):
        self._runs.discard(str(event.runId))
        self._end(str(event.runId)).set()

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def wait(self, query: StreamingQuery, timeout_s: float = 120) -> None:
        """Until all reports of an ended query are stored; raises if one was not."""
        run = str(query.runId)
        if not self._end(run).wait(timeout_s):
            raise TimeoutError(f"progress of {query.name} was not stored in {timeout_s}s")
        self._ended.pop(run, None)
        if self._errors:
            raise self._errors.pop(0)


_STORED: dict[tuple[int, str], StoredProgress] = {}


def store_progress(spark: SparkSession, path: str, name: str) -> StoredProgress:
    """The listener that stores the reports of queries called ``name`` under
    ``path``; one a session and path.  ``start_query(progress_path=)`` asks for it."""
    key = (id(spark), path)
    if key not in _STORED:
        _STORED[key] = StoredProgress(spark, path)
        spark.streams.addListener(_STORED[key])
    _STORED[key].watch(name)
    return _STORED[key]


def stored_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Stored METRIC rows; labels name query, run and batch."""
    return spark.read.schema(METRIC).parquet(path)


def late_rows(metrics: DataFrame) -> DataFrame:
    """``query, late_rows`` of stored metrics."""
    return (metrics.filter(F.col("metric") == "stream_numRowsDroppedByWatermark")
            .groupBy(F.col("labels")["query"].alias("query")).agg(F.sum("value").cast("long").alias("late_rows")))


def progress_metrics(spark: SparkSession, query_name: str, progress: list[dict]) -> DataFrame:
    """K8: progress reports -> METRIC rows (``metric, labels, ts, value``) that
    the series operators (counter rate, sums by label) query like any other.
    The input is the driver's own progress list: a few rows per micro-batch."""
    rows = []
    for p in progress:
        ts = _dt.datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")).replace(tzinfo=None)
        labels = {"query": query_name, "query_id": str(p.get("id")), "run": str(p.get("runId")), "batch": str(p.get("batchId"))}
        for f in _RATE_FIELDS:
            v = p.get(f)
            if v is not None:
                rows.append((f"stream_{f}", labels, ts, float(v)))
        rows.append(("stream_numRowsDroppedByWatermark", labels, ts,
                     float(sum(int(op.get("numRowsDroppedByWatermark", 0))
                               for op in p.get("stateOperators", [])))))
        for obs, vals in (p.get("observedMetrics") or {}).items():
            vals = vals.asDict() if hasattr(vals, "asDict") else dict(vals)
            for k, v in vals.items():
                if isinstance(v, (int, float)):
                    rows.append((f"observed_{obs}_{k}", labels, ts, float(v)))
    return spark.createDataFrame(rows, METRIC)
