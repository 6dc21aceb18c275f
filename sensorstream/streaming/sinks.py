"""Stream sinks (K1, K2, K4-K6, R1) as ``foreachBatch`` functions.

Each micro-batch is written with plain batch writers into a folder of its
query id and batch id (two queries on one path never meet), so a batch replayed after a failure overwrites its own output instead of
duplicating it.  A batch that feeds several outputs is persisted once and
released after the last write.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.decode import REASON
from ..sources.tables import DIRECT, batch_folder, upsert_table

BatchFn = Callable[[DataFrame, int], None]


def writer_of(batch: DataFrame) -> str:
    """Id of the streaming query that a micro-batch comes from."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or DIRECT


def upsert_sink(path: str, keys=None, order=None) -> BatchFn:
    """K2/K4: each micro-batch becomes a folder of a keyed table's log."""
    state = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        # The schema and keys do not change while a query runs: read the
        # manifest once per sink, not once per micro-batch.
        state["m"] = upsert_table(batch, path, batch_id, keys, order, manifest=state.get("m"),
                                  writer=writer_of(batch))
    return write


def quarantine_sink(path: str) -> BatchFn:
    """K6: rejected messages, one folder per batch (replay-safe)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, writer_of(batch), batch_id))
    return write


def metrics_sink(path: str, name: str) -> BatchFn:
    """K8: row and reject counts of each micro-batch as METRIC rows, one folder
    per batch: nothing is lost when a query ends or reports too much to keep."""
    def write(batch: DataFrame, batch_id: int) -> None:
        bad = F.count(REASON) if REASON in batch.columns else F.lit(0).cast("long")
        labels = F.create_map(F.lit("query"), F.lit(name), F.lit("batch"), F.lit(str(batch_id)))
        rows = batch.agg(F.count(F.lit(1)).alias("rows"), bad.alias("rejected")).select(F.inline(F.array(
            *(F.struct(F.lit(f"decoded_{n}").alias("metric"), labels.alias("labels"),
                       F.current_timestamp().alias("ts"), F.col(n).cast("double").alias("value"))
              for n in ("rows", "rejected")))))
        rows.write.mode("overwrite").parquet(batch_folder(path, writer_of(batch), batch_id))
    return write


def envelope_sink(path: str, format: str = "parquet") -> BatchFn:
    """K1 for file replays: envelope rows of a topic, one folder per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(format).save(batch_folder(path, writer_of(batch), batch_id))
    return write


def tee(*sinks: BatchFn) -> BatchFn:
    """K5: write one micro-batch to several sinks, computing it once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for s in sinks:
                s(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def split_sink(split: Callable[[DataFrame], dict[str, DataFrame]],
               targets: dict[str, BatchFn]) -> BatchFn:
    """Persist the batch, split it into named frames, write each to its sink
    (valid/rejected, or one branch per route)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            parts = split(batch)
            for name, sink in targets.items():
                if name in parts:
                    sink(parts[name], batch_id)
        finally:
            batch.unpersist()
    return write


def route_sink(routes: dict[str, str], handlers: dict[str, tuple[Callable[[DataFrame], DataFrame], BatchFn]],
               topic_col: str = "topic") -> BatchFn:
    """Dispatch each record by topic to ``handlers[name] = (transform, sink)``.
    Unknown topics go to the handler named ``rejected`` (if given)."""
    from ..operators.filters import route, split_routes

    def split(batch: DataFrame) -> dict[str, DataFrame]:
        tagged = route(batch, routes, topic_col)
        parts = split_routes(tagged, handlers.keys())
        return {n: handlers[n][0](parts[n]) for n in parts}

    return split_sink(split, {n: h[1] for n, h in handlers.items()})


def bus_sink(df: DataFrame, path: str | None = None, topic: str | None = None,
             format: str = "parquet", bootstrap: str | None = None):
    """K1 as a streaming writer (append-only topic; windows emitted when final)."""
    if format == "kafka":
        return (df.select("key", "value").writeStream.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap).option("topic", topic))
    return df.writeStream.format(format).option("path", path)
