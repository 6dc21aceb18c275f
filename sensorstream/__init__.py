"""sensorstream: sensor-reading analytics as PySpark DataFrame operators.

Batch and Structured Streaming share one code path: readers in ``sources``,
column functions in ``functions``, DataFrame -> DataFrame operators in
``operators``, stream/sink plumbing in ``streaming``, composed jobs and SQL
text in ``plans``.
"""

__version__ = "0.1.0"
