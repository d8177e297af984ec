"""Ordered computations over keys that may be very hot.

A plain window over a key sorts all rows of that key in one task, and one key
may hold a third of the table. The functions here go through a grid in time:
rows are first pre-aggregated to (key, day), or to (key, minute) in the days of
a key that are too full, which calendar time bounds (about half a million
minutes a year, whatever the row count); the only window over a whole key runs
on that grid. The result goes back to the rows by an equi-join on the cell,
which spreads a hot key over its minutes and which adaptive execution can split.
A minute that is itself too full is cut into blocks of rows, a further level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.timeutil import minute_number


# Rows of a key in one day above which the day is cut into minutes, and a minute into blocks of about so many.
FULL_MINUTE = 100_000
# Counters of the first look for full cells.
_COUNTERS = 4096
_DAY = 1440
# Rows drawn, by their hash, for each block.
_DRAWN = 8


def _full_cells(rows: DataFrame, cell: list[str], full: int) -> DataFrame | None:
    """The cells with more than `full` rows, None where there is none.

    Cells share a few thousand counters, so that this look shuffles next to
    nothing; only those of a counter above `full` are counted one by one.
    """
    counter = F.pmod(F.xxhash64(*cell), F.lit(_COUNTERS))
    counted = rows.groupBy(counter.alias("_counter")).agg(F.count(F.lit(1)).alias("_rows"))
    above = [r._counter for r in counted.where(F.col("_rows") > full).collect()]
    if not above:
        return None
    near = rows.where(counter.isin(above)).groupBy(*cell).agg(F.count(F.lit(1)).alias("_rows"))
    cells = near.where(F.col("_rows") > full).select(*cell)
    return None if cells.isEmpty() else cells


def in_blocks(rows: DataFrame, key: str, order_by: list[str], full: int = FULL_MINUTE) -> DataFrame:
    """`rows` of (key, _slot) with `_block`: 0, or in a full minute the number of the block in order.

    A few rows of every full minute, chosen by their hash, are its splitters; a
    row's block is the number of splitters at or before it. Blocks hold about
    `full` rows, also where all rows of the minute have the same time.
    """
    sizes = _full_cells(rows, [key, "_slot"], full)
    if sizes is None:
        return rows.withColumn("_block", F.lit(0))
    order = F.struct(*order_by)
    drawn = rows.where(F.pmod(F.xxhash64(*order_by), F.lit(max(1, full // _DRAWN))) == 0)
    splits = (
        drawn.join(sizes, [key, "_slot"], "left_semi")
        .groupBy(key, "_slot")
        .agg(F.array_sort(F.collect_list(order)).alias("_drawn"))
        .select(key, "_slot", F.filter("_drawn", lambda x, i: i % _DRAWN == _DRAWN - 1).alias("_splits"))
    )
    block = F.size(F.filter("_splits", lambda x: x <= order))
    return (
        rows.join(splits, [key, "_slot"], "left")
        .withColumn("_block", F.when(F.col("_splits").isNull(), 0).otherwise(block))
        .drop("_splits")
        # On (key, minute) alone all blocks of a minute would stay in one task.
        .repartition(key, "_slot", "_block")
    )


def _in_cells(rows: DataFrame, key: str, order_by: list[str], full: int) -> DataFrame:
    """`rows` of (key, _slot) in minutes, with `_slot` moved to the start of its day unless the key's day is full."""
    day = F.col("_slot") - F.pmod(F.col("_slot"), F.lit(_DAY))
    dated = rows.withColumn("_day", day)
    days = _full_cells(dated, [key, "_day"], full)
    if days is None:
        return dated.withColumn("_slot", F.col("_day")).drop("_day").withColumn("_block", F.lit(0))
    slot = F.when(F.col("_is_full"), F.col("_slot")).otherwise(F.col("_day"))
    mixed = dated.join(days.withColumn("_is_full", F.lit(True)), [key, "_day"], "left").withColumn("_slot", slot)
    return in_blocks(mixed.select(*rows.columns), key, order_by, full)


def running_sums(
    df: DataFrame,
    key: str,
    ts: str,
    order_by: list[str],
    measures: dict[str, Column],
    kind: str = "long",
    full: int = FULL_MINUTE,
) -> DataFrame:
    """`sum(measure) over (partition by key order by order_by rows to current)` per measure, as `kind`.

    `order_by` starts with `ts` and must be a total order. Rows with a NULL
    key or time have no place on the grid and are left out. A day with more than
    `full` rows of a key is cut into minutes, and such a minute into blocks,
    which are scanned one by one and take their place on the grid behind the minute.
    """
    known = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    rows = _in_cells(
        known.select(
            "*",
            minute_number(F.col(ts)).alias("_slot"),
            *[m.cast(kind).alias(f"_one_{name}") for name, m in measures.items()],
        ),
        key,
        order_by,
        full,
    )

    cell = [key, "_slot", "_block"]
    inside = (
        Window.partitionBy(*cell).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.select(
        *df.columns,
        "_slot",
        "_block",
        *[F.sum(f"_one_{n}").over(inside).alias(f"_in_{n}") for n in measures],
    )

    before = (
        Window.partitionBy(key)
        .orderBy("_slot", "_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        rows.groupBy(*cell)
        .agg(*[F.sum(f"_one_{n}").alias(f"_sum_{n}") for n in measures])
        .select(
            *cell,
            *[
                F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0).cast(kind)).alias(f"_off_{n}")
                for n in measures
            ],
        )
    )
    return local.join(offsets, cell).select(
        *df.columns,
        *[(F.col(f"_in_{n}") + F.col(f"_off_{n}")).alias(n) for n in measures],
    )


def neighbour(df: DataFrame, key: str, ts: str, value: Column, name: str, ahead: bool = False) -> DataFrame:
    """`df` with the `value` of the row before it (or `ahead` of it) in time, as a struct column; NULL at the end.

    (key, ts) must be unique and not NULL. Rows of a day are ordered among
    themselves; the row beyond comes from the nearest other day of the key, so
    the window over a whole key sees one row a day.
    """
    held = df.select("*", F.struct(value.alias("value")).alias("_held"), F.col(ts).cast("date").alias("_day"))

    def ordered(by: str) -> list[Column]:
        return [F.col(by).desc() if ahead else F.col(by).asc()]

    near = F.lag("_held").over(Window.partitionBy(key, "_day").orderBy(*ordered(ts)))
    edge = (F.min_by if ahead else F.max_by)("_held", ts)
    days = (
        df.select(key, ts, F.struct(value.alias("value")).alias("_held"), F.col(ts).cast("date").alias("_day"))
        .groupBy(key, "_day")
        .agg(edge.alias("_edge"))
        .select(key, "_day", F.lag("_edge").over(Window.partitionBy(key).orderBy(*ordered("_day"))).alias("_far"))
    )
    return (
        held.withColumn("_near", near)
        .join(days, [key, "_day"])
        .withColumn(name, F.coalesce("_near", "_far"))
        .drop("_held", "_day", "_near", "_far")
    )


def as_of(asked: DataFrame, known: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """Distinct `asked(key, ts)` with the `value` of the last `known(key, ts, value)` at or before them, else NULL.

    Both lie on one axis. The last value is carried forward inside a day, and
    from day to day on a grid of (key, day); no row meets more than one other.
    """
    points = (
        known.select(key, ts, F.struct(value).alias("_held"), F.lit(0).alias("_kind"))
        .unionByName(asked.select(key, ts).distinct().withColumn("_kind", F.lit(1)), allowMissingColumns=True)
        .withColumn("_day", F.col(ts).cast("date"))
    )
    so_far = Window.partitionBy(key, "_day").orderBy(ts, "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        points.groupBy(key, "_day")
        .agg(F.max_by("_held", F.when(F.col("_kind") == 0, F.col(ts))).alias("_edge"))
        .select(key, "_day", F.last("_edge", ignorenulls=True).over(before).alias("_far"))
    )
    return (
        points.withColumn("_near", F.last("_held", ignorenulls=True).over(so_far))
        .where("_kind = 1")
        .join(days, [key, "_day"])
        .select(key, ts, F.coalesce("_near", "_far").getField(value).alias(value))
    )
