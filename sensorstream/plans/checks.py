"""Plan inspection helpers used by tests and the bench (section 5.7).

They read the executed physical plan as text: no Python UDF nodes on the hot
path, filters pushed into the Parquet scan, partial aggregation before each
shuffle, and no window without a partition key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def has_python_udf(df: DataFrame) -> bool:
    p = plan_text(df)
    return any(k in p for k in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"))


def pushed_filters(df: DataFrame) -> list[str]:
    out = []
    for line in plan_text(df).splitlines():
        if "PushedFilters:" in line:
            seg = line.split("PushedFilters:", 1)[1]
            out.append(seg.split("]", 1)[0] + "]")
    return out


def read_schemas(df: DataFrame) -> list[str]:
    out = []
    for line in plan_text(df).splitlines():
        if "ReadSchema:" in line:
            out.append(line.split("ReadSchema:", 1)[1].strip())
    return out


def count_exchanges(df: DataFrame) -> int:
    return plan_text(df).count("Exchange ")


def has_partial_aggregate(df: DataFrame) -> bool:
    p = plan_text(df)
    return "partial_" in p


def has_unpartitioned_window(df: DataFrame) -> bool:
    """A ``Window`` without partition keys: the plan shows the window and
    ``Exchange SinglePartition`` (all rows gathered into one task)."""
    p = plan_text(df)
    return "Window [" in p and "Exchange SinglePartition" in p
