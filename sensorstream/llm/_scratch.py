"""Tables cut from their lineage, in the cluster's shared folder."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table under ``spark.checkpoint.dir`` and read it again."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def share(spark: SparkSession, value: object):
    """Broadcast a value of bounded size; call the result in a task to get it.

    It travels as bytes, by value like the functions of this package.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)


#: Most ids of a table that is broadcast whole: some 30 MB.
BROADCAST_IDS = 1_000_000


def bounded(ids: DataFrame) -> DataFrame:
    """A stored table of ids as a join side: marked for broadcast if it is
    counted to be small, else left to a shuffled join."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
