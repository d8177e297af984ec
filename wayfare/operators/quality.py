"""Data-quality checks.

All row-level checks of a table compile into one aggregation over it. Checks
that need grouping (uniqueness) or another table (relationships) pre-aggregate
by the checked key, so a hot value is one row before anything is shuffled.
Every check yields (table_name, check_name, column_name, observed, passed).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.timeutil import ntz, seconds_between
from wayfare.params import FUNNEL_COUNTS


@dataclass(frozen=True)
class Check:
    kind: str
    column: str = "*"
    values: tuple = ()
    low: float | None = None
    high: float | None = None


def _outside(c: Column, low, high) -> Column:
    """Violation of [low, high], either bound optional; NULL is no violation."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return F.coalesce(bad, F.lit(False))


def _observe(check: Check, as_of: datetime | None) -> Column:
    c = F.col(check.column) if check.column != "*" else None
    if check.kind == "not_null":
        seen = F.count_if(c.isNull())
    elif check.kind == "accepted_values":
        seen = F.count_if(c.isNotNull() & ~c.isin(*check.values))
    elif check.kind == "between":
        seen = F.count_if(_outside(c, check.low, check.high))
    elif check.kind == "row_count":
        seen = F.count(F.lit(1))
    elif check.kind == "min":
        seen = F.min(c)
    elif check.kind == "freshness":
        seen = seconds_between(F.max(c), ntz(as_of)) / F.lit(86400.0)
    else:
        raise ValueError(f"not a row-level check: {check.kind}")
    return seen.cast("double")


def _passed(check: Check, seen: Column) -> Column:
    if check.kind in ("not_null", "accepted_values", "between"):
        return seen == 0
    if check.kind == "freshness":
        return F.coalesce(seen < check.high, F.lit(False))
    return seen.isNotNull() & ~_outside(seen, check.low, check.high)


def run_checks(
    df: DataFrame, table: str, checks: list[Check], as_of: datetime | None = None
) -> DataFrame:
    """All row-level `checks` of one table in a single pass."""
    seen = df.agg(*[_observe(c, as_of).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(c.kind).alias("check_name"),
                F.lit(c.column).alias("column_name"),
                F.col(f"c{i}").alias("observed"),
                _passed(c, F.col(f"c{i}")).alias("passed"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return seen.select(F.explode(rows).alias("r")).select(
        F.lit(table).alias("table_name"), "r.*"
    )


def _result(count: DataFrame, table: str, check: str, column: str) -> DataFrame:
    n = F.coalesce(F.col("n"), F.lit(0)).cast("double")
    return count.select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        n.alias("observed"),
        (n == 0).alias("passed"),
    )


def check_unique(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Values, or combinations, that occur more than once; NULLs in a single key are exempt."""
    name = "unique" if len(columns) == 1 else "unique_combination"
    rows = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    repeated = rows.groupBy(*columns).count().where(F.col("count") > 1)
    return _result(repeated.agg(F.count(F.lit(1)).alias("n")), table, name, ",".join(columns))


def check_relationship(
    child: DataFrame, table: str, column: str, parent: DataFrame, key: str
) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(key).alias("_k")).distinct()
    orphans = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_k"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(keys, "_k", "left_anti")
    )
    return _result(orphans.agg(F.sum("rows").alias("n")), table, "relationships", column)


def funnel_violations(funnel: DataFrame) -> DataFrame:
    """Channels where some step was reached by more people than the step before."""
    grew = F.lit(False)
    for earlier, later in zip(FUNNEL_COUNTS, FUNNEL_COUNTS[1:]):
        grew = grew | (F.col(later) > F.col(earlier))
    return funnel.where(grew)


def graph_orphans(graph: DataFrame) -> DataFrame:
    return graph.where(F.col("raw_id").isNull() | F.col("unified_user_id").isNull()).select(
        "raw_id", "unified_user_id"
    )
