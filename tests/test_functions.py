import hashlib
import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from wayfare.functions import grid, keys, timeutil


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_minutes_count_boundaries_not_elapsed_time(spark):
    a, b = timeutil.ntz(datetime(2024, 1, 1, 0, 0, 59)), timeutil.ntz(datetime(2024, 1, 1, 0, 31))
    row = one(spark, minutes=timeutil.minutes_between(a, b), seconds=timeutil.seconds_between(a, b))
    assert (row.minutes, row.seconds) == (31, 1801)


def test_time_does_not_depend_on_session_zone(spark):
    stamp = timeutil.ntz(datetime(2024, 3, 31, 2, 30))
    before = one(spark, m=timeutil.minute_number(stamp), e=timeutil.from_epoch_seconds(F.lit(1704067200)))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Brussels")
    try:
        after = one(spark, m=timeutil.minute_number(stamp), e=timeutil.from_epoch_seconds(F.lit(1704067200)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert before == after
    assert before.e == datetime(2024, 1, 1)


def test_window_includes_the_last_day(spark):
    days = [datetime(2024, 1, 1), datetime(2024, 1, 30, 23, 59, 59), datetime(2024, 1, 31)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    kept = df.where(timeutil.within_days(F.col("t"), date(2024, 1, 1), date(2024, 1, 30)))
    assert [r.t for r in kept.orderBy("t").collect()] == days[:2]


def test_email_hash_trims_and_lowers(spark):
    row = one(spark, h=keys.email_hash(F.lit("  Ann@Example.COM ")))
    assert row.h == hashlib.sha256(b"ann@example.com").hexdigest()


def test_phone_and_address_are_minimised(spark):
    spellings = ["+32 (0)47-11", "+32 47 11", "0032 4711", "no number", None]
    rows = spark.createDataFrame([(x,) for x in spellings], "x string").select("x", keys.phone_hash(F.col("x")).alias("p"))
    got = {r.x: r.p for r in rows.collect()}
    want = hashlib.sha256(b"+324711").hexdigest()
    assert [got[x] for x in spellings] == [want, want, want, None, None]
    addresses = ["10.2.3.250", "10.2.3.4 ", "2001:db8::1a", "10.2.3", "10.2.3.256", "10.2.3.4\n", None]
    rows = spark.createDataFrame([(x,) for x in addresses], "x string").select("x", keys.ip_prefix(F.col("x")).alias("p"))
    got = {r.x: r.p for r in rows.collect()}
    assert [got[x] for x in addresses] == ["10.2.3.0"] + [None] * 6


def test_elapsed_minutes_are_whole(spark):
    a, b = datetime(2024, 1, 1, 9, 59, 59, 900000), datetime(2024, 1, 1, 10, 0, 59, 100000)
    row = one(
        spark,
        short=timeutil.minutes_elapsed(timeutil.ntz(a), timeutil.ntz(b)),
        whole=timeutil.minutes_elapsed(timeutil.ntz(a), timeutil.ntz(b.replace(microsecond=900000))),
        ahead=timeutil.minutes_elapsed(timeutil.ntz(b), timeutil.ntz(a)),
    )
    assert (row.short, row.whole, row.ahead) == (0, 1, -1)


def test_node_of_nothing_is_nothing(spark):
    assert one(spark, n=keys.node_id("ga_client", F.lit(None).cast("string"))).n is None


def test_running_sums_equal_a_plain_window_under_a_hot_key(spark):
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        # One key holds a third of the rows, and one of its minutes a third of those.
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        at = start if key == "hot" and rng.random() < 0.33 else start + timedelta(seconds=rng.randrange(500_000))
        rows.append((key, at, i, rng.randrange(3)))
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id int, v int")
    got = grid.running_sums(df, "k", "t", ["t", "id"], {"s": F.col("v"), "n": F.lit(1)})

    want, totals = {}, {}
    for key, at, i, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        s, n = totals.get(key, (0, 0))
        totals[key] = (s + v, n + 1)
        want[i] = totals[key]
    assert {r.id: (r.s, r.n) for r in got.collect()} == want


def test_the_grid_of_running_sums_has_days_and_minutes_of_full_days(spark):
    """A key's rows of a day are one cell; only in a day with too many rows each minute is."""
    start = datetime(2024, 1, 1, 0, 30)
    rows = [("k", start + timedelta(minutes=i % 50, days=i // 50), i) for i in range(150)] + [
        ("full", start + timedelta(minutes=i // 4), i) for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id int")
    slots = df.withColumn("_slot", timeutil.minute_number(F.col("t")))
    cells = grid._in_cells(slots, "k", ["t", "id"], 100).groupBy("k").agg(F.count_distinct("_slot", "_block").alias("n"))
    assert {r.k: r.n for r in cells.collect()} == {"k": 3, "full": 100}
    got = grid.running_sums(df, "k", "t", ["t", "id"], {"n": F.lit(1)}, full=100)
    assert sorted((r.k, r.id, r.n) for r in got.collect()) == sorted((k, i, i + 1) for k, _, i in rows)
