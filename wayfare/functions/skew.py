"""Joins whose hot keys adaptive execution can split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def splittable(rows_key: Column, summary_key: Column) -> Column:
    """Join condition between rows and a table aggregated by the same key.

    On the bare key the engine would reuse the aggregation's partitions, and a
    join directly on those is one it never splits: a hub's rows would meet in
    one task. The hash adds nothing to the condition, but it makes the engine
    shuffle the summary, one row per key, for the join, and then a hot partition
    of rows is divided among tasks.
    """
    return (rows_key == summary_key) & (F.hash(rows_key) == F.hash(summary_key))
