"""Multi-touch attribution without regrouping touch x conversion pairs.

Per person, touches lie on an axis in total order (time, source, id). A
conversion covers a contiguous stretch of that axis: it opens at midnight of
the first day of its window and closes just before its own instant. Putting
both ends on the axis as markers and counting touches so far - in total and per
channel - gives for each conversion the number of touches, their split by
channel and the ranks of the first and the last one. All of a person's
conversions of a day open at the same midnight and share one marker. All four models follow
from these by arithmetic, so the channel-grain facts cost work linear in
touches plus conversions, and the pair-grain output needs no window over a
conversion's pairs: a touch knows its rank before it meets the conversion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.grid import running_sums
from wayfare.functions.timeutil import day_number, day_start, second_number, seconds_between
from wayfare.operators.touchpoints import in_window_pairs, of_both
from wayfare.params import CHANNEL_KEYS, MODELS

_COUNTS = [f"n_{c}" for c in CHANNEL_KEYS]


def touch_axis(touches: DataFrame, convs: DataFrame, window_days: int) -> DataFrame:
    """Touches and conversion markers with running touch counts per channel.

    Only people with touches and conversions are on the axis.
    """
    touches, convs = of_both(touches, convs)
    opens = day_start(F.date_sub(F.col("conversion_ts").cast("date"), window_days))
    closing = convs.select(
        "unified_user_id",
        F.lit("hi").alias("mark"),
        F.col("conversion_ts").alias("axis_ts"),
        opens.alias("opens_ts"),
        F.col("conversion_id").alias("id"),
        "conversion_ts",
        "conversion_value_eur",
    )
    opening = (
        convs.select("unified_user_id", opens.alias("opens_ts"))
        .distinct()
        .select("*", F.lit("lo").alias("mark"), F.col("opens_ts").alias("axis_ts"))
    )
    markers = closing.unionByName(opening, allowMissingColumns=True)

    points = touches.select(
        "unified_user_id",
        F.lit("touch").alias("mark"),
        F.col("touchpoint_ts").alias("axis_ts"),
        "source",
        F.col("touchpoint_id").alias("id"),
        "channel_key",
    )
    axis = points.unionByName(markers, allowMissingColumns=True)
    # 'hi' and 'lo' sort before 'touch': a touch at the very instant of a
    # conversion is not before it, one at the opening midnight is inside.
    counted = running_sums(
        axis,
        key="unified_user_id",
        ts="axis_ts",
        order_by=["axis_ts", "mark", "source", "id"],
        measures={"touch_rank": (F.col("mark") == "touch").cast("int")}
        | {
            name: F.coalesce((F.col("channel_key") == key).cast("int"), F.lit(0))
            for name, key in zip(_COUNTS, CHANNEL_KEYS)
        },
    )
    # A touch needs its rank alone; the split by channel is kept for the markers.
    is_marker = F.col("mark") != "touch"
    return counted.select(
        *axis.columns,
        "touch_rank",
        *[F.when(is_marker, F.col(c)).alias(c) for c in _COUNTS],
    )


def ranked_touches(axis: DataFrame) -> DataFrame:
    """Touches with their rank among the person's touches."""
    return axis.where(F.col("mark") == "touch").select(
        "unified_user_id",
        F.col("id").alias("touchpoint_id"),
        F.col("axis_ts").alias("touchpoint_ts"),
        "source",
        "channel_key",
        "touch_rank",
    )


def conversion_spans(axis: DataFrame) -> DataFrame:
    """Per conversion: touches per channel, and the rank range (rank_before, rank_last]."""
    return (
        _spans(axis, ["touch_rank", *_COUNTS])
        .select(
            "conversion_id",
            "unified_user_id",
            "conversion_ts",
            "conversion_value_eur",
            F.col("lo_touch_rank").alias("rank_before"),
            F.col("hi_touch_rank").alias("rank_last"),
            *[(F.col(f"hi_{c}") - F.col(f"lo_{c}")).alias(c) for c in _COUNTS],
            (F.col("hi_touch_rank") - F.col("lo_touch_rank")).alias("n_touches"),
        )
        .where(F.col("n_touches") > 0)
    )


def _spans(axis: DataFrame, counts: list[str], lanes: list[str] = []) -> DataFrame:
    """Each closing marker with the counts at its opening one; `lanes` are further equal columns."""
    keys = list(dict.fromkeys(["unified_user_id", "opens_ts", *lanes]))
    closing = axis.where(F.col("mark") == "hi").select(
        *keys,
        F.col("id").alias("conversion_id"),
        "conversion_ts",
        "conversion_value_eur",
        *[F.col(c).alias(f"hi_{c}") for c in counts],
    )
    opening = axis.where(F.col("mark") == "lo").select(
        *keys, *[F.col(c).alias(f"lo_{c}") for c in counts]
    )
    return closing.join(opening, keys)


def _lanes(axis: DataFrame) -> DataFrame:
    """The touches of channels outside the list, each channel of a person an axis with all the person's markers.

    The channel's name travels as JSON in `lane_channel`, so that NULL joins as well.
    """
    listed = F.coalesce(F.col("channel_key").isin(CHANNEL_KEYS), F.lit(False))
    name = F.to_json(F.struct("channel_key")).alias("lane_channel")
    columns = ["unified_user_id", "mark", "axis_ts", "opens_ts", "source", "id", "conversion_ts", "conversion_value_eur"]
    touches = axis.where((F.col("mark") == "touch") & ~listed).select(*columns, name)
    lanes = touches.select("unified_user_id", "lane_channel").distinct()
    markers = axis.where(F.col("mark") != "touch").select(*columns).join(lanes, "unified_user_id")
    return touches.unionByName(markers)


def unlisted_counts(axis: DataFrame) -> DataFrame:
    """Touches per (conversion, channel) for channels outside the list, NULL among them."""
    counted = running_sums(
        _lanes(axis).withColumn("lane", F.struct("unified_user_id", "lane_channel")),
        key="lane",
        ts="axis_ts",
        order_by=["axis_ts", "mark", "source", "id"],
        measures={"n": (F.col("mark") == "touch").cast("int")},
    )
    channel = F.get_json_object("lane_channel", "$.channel_key").alias("channel_key")
    return (
        _spans(counted, ["n"], ["lane_channel"])
        .select("conversion_id", channel, (F.col("hi_n") - F.col("lo_n")).alias("touches"))
        .where(F.col("touches") > 0)
    )


def attribution_ranked(axis: DataFrame, window_days: int) -> DataFrame:
    """Touch x conversion with the touch's position from either end."""
    inside = (F.col("touch_rank") > F.col("rank_before")) & (
        F.col("touch_rank") <= F.col("rank_last")
    )
    spans = conversion_spans(axis).select(
        "conversion_id",
        "unified_user_id",
        "conversion_ts",
        "conversion_value_eur",
        "rank_before",
        "rank_last",
        "n_touches",
    )
    return in_window_pairs(ranked_touches(axis), spans, window_days, inside).select(
        "conversion_id",
        "conversion_value_eur",
        "touchpoint_id",
        "touchpoint_ts",
        "source",
        "channel_key",
        "unified_user_id",
        (F.col("touch_rank") - F.col("rank_before")).alias("pos_asc"),
        (F.col("rank_last") - F.col("touch_rank") + 1).alias("pos_desc"),
        "n_touches",
    )


def position_weight(n: Column, is_first: Column, is_last: Column) -> Column:
    """Position-based credit: all, halves, or 40 / 20 shared / 40."""
    n = n.cast("double")
    return (
        F.when(n == 1, F.lit(1.0))
        .when(n == 2, F.lit(0.5))
        .when(is_first | is_last, F.lit(0.4))
        .otherwise(F.lit(0.2) / (n - 2))
    )


def touchpoints_attribution(ranked: DataFrame) -> DataFrame:
    """Credit per (conversion, touch, model), all models in one pass over the pairs."""
    n = F.col("n_touches").cast("double")
    value = F.col("conversion_value_eur")
    first, last = F.col("pos_asc") == 1, F.col("pos_desc") == 1
    by_position = position_weight(n, first, last)
    credit = {
        "first_touch": (F.when(first, F.lit(1.0)), value),
        "last_touch": (F.when(last, F.lit(1.0)), value),
        "linear": (F.lit(1.0) / n, value / n),
        "position_based": (by_position, value * by_position),
    }
    entries = F.array(
        *[
            F.struct(
                F.lit(model).alias("attribution_model"),
                credit[model][0].alias("weight"),
                credit[model][1].alias("revenue_share_eur"),
            )
            for model in MODELS
        ]
    )
    return (
        ranked.select(
            "conversion_id",
            "conversion_value_eur",
            "touchpoint_id",
            "channel_key",
            F.explode(entries).alias("c"),
        )
        .where(F.col("c.weight").isNotNull())
        .select("conversion_id", "conversion_value_eur", "touchpoint_id", "channel_key", "c.*")
    )


def _touches_at(axis: DataFrame, rank: str, **names: str) -> DataFrame:
    """Touches by their rank, to be looked up from a conversion's rank range."""
    columns = [F.col(column).alias(name) for name, column in names.items()]
    return ranked_touches(axis).select("unified_user_id", F.col("touch_rank").alias(rank), *columns)


def end_touch(axis: DataFrame, model: str) -> DataFrame:
    """All credit to the first or the last touch of each conversion.

    The ranks at both ends of a conversion's stretch are on the axis, so its end
    touch is one row found by an equi-join on (person, rank); no touch meets a
    conversion that it does not get the credit of.
    """
    ends = {"first_touch": F.col("rank_before") + 1, "last_touch": F.col("rank_last")}
    asked = conversion_spans(axis).withColumn("rank", ends[model])
    found = _touches_at(axis, "rank", touchpoint_id="touchpoint_id", channel_key="channel_key")
    return asked.join(found, ["unified_user_id", "rank"]).select(
        "conversion_id",
        "conversion_value_eur",
        "touchpoint_id",
        "channel_key",
        F.lit(model).alias("attribution_model"),
        F.lit(1.0).alias("weight"),
        F.col("conversion_value_eur").alias("revenue_share_eur"),
    )


def conversion_channels(axis: DataFrame) -> DataFrame:
    """Per (conversion, channel): how many touches of it, of all, and whether it holds the first or last."""
    spans = conversion_spans(axis).withColumn("rank_first", F.col("rank_before") + 1)
    ends = spans.join(
        _touches_at(axis, "rank_first", first_channel="channel_key"), ["unified_user_id", "rank_first"]
    ).join(_touches_at(axis, "rank_last", last_channel="channel_key"), ["unified_user_id", "rank_last"])

    per_channel = F.explode(
        F.array(
            *[
                F.struct(F.lit(key).alias("channel_key"), F.col(c).alias("touches"))
                for key, c in zip(CHANNEL_KEYS, _COUNTS)
            ]
        )
    )
    about = ["conversion_id", "unified_user_id", "conversion_value_eur", "n_touches", "first_channel", "last_channel"]
    listed = ends.select(*about, per_channel.alias("c")).where(F.col("c.touches") > 0)
    unlisted = ends.join(unlisted_counts(axis), "conversion_id").select(
        *about, F.struct("channel_key", "touches").alias("c")
    )
    return listed.unionByName(unlisted).select(
        "conversion_id",
        "unified_user_id",
        "conversion_value_eur",
        "n_touches",
        "c.channel_key",
        "c.touches",
        F.col("c.channel_key").eqNullSafe(F.col("first_channel")).alias("has_first"),
        F.col("c.channel_key").eqNullSafe(F.col("last_channel")).alias("has_last"),
    )


def pivot_channels(channels: DataFrame) -> DataFrame:
    """Revenue per (conversion, channel) under each model, by arithmetic on `conversion_channels`."""
    value, n = F.col("conversion_value_eur"), F.col("n_touches").cast("double")
    k = F.col("touches").cast("double")
    has_first, has_last = F.col("has_first").cast("double"), F.col("has_last").cast("double")
    at_ends = has_first + has_last
    share = (
        F.when(n == 1, F.lit(1.0))
        .when(n == 2, k * 0.5)
        .otherwise(at_ends * 0.4 + (k - at_ends) * 0.2 / (n - 2))
    )
    return channels.select(
        "conversion_id",
        "channel_key",
        (value * has_first).alias("revenue_first_touch"),
        (value * has_last).alias("revenue_last_touch"),
        (value * k / n).alias("revenue_linear"),
        (value * share).alias("revenue_position_based"),
    )


def attribution_pivot(axis: DataFrame) -> DataFrame:
    """Revenue per (conversion, channel) under each model, straight from the spans."""
    return pivot_channels(conversion_channels(axis))


def conversion_facts(orders_with_buyer: DataFrame, pivot: DataFrame) -> DataFrame:
    """Every order x channel it credits; orders without touches keep a NULL channel."""
    return (
        orders_with_buyer.select(
            F.col("order_id").alias("conversion_id"),
            F.col("order_ts").alias("conversion_ts"),
            F.col("order_ts").cast("date").alias("conversion_date"),
            "unified_user_id",
            "country",
            F.col("total_price_eur").alias("conversion_value_eur"),
        )
        .join(pivot, "conversion_id", "left")
    )


def weight_violations(attribution: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """(conversion, model) groups whose weights do not add up to one."""
    return (
        attribution.groupBy("conversion_id", "attribution_model")
        .agg(F.sum("weight").alias("total_weight"))
        .where(F.abs(F.col("total_weight") - 1.0) > tolerance)
    )


def reconcile(facts: DataFrame) -> DataFrame:
    """Per model: revenue handed out against the value of attributed conversions."""
    sums = {m: F.sum(f"revenue_{m}").alias(m) for m in MODELS}
    per_conversion = (
        facts.where(F.col("channel_key").isNotNull())
        .groupBy("conversion_id")
        .agg(F.max("conversion_value_eur").alias("value"), *sums.values())
    )
    totals = per_conversion.agg(
        F.sum("value").alias("attributed_value"), *[F.sum(m).alias(m) for m in MODELS]
    )
    gap = F.abs(F.col("m.revenue") - F.col("attributed_value"))
    return totals.select(
        "attributed_value",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(m).alias("attribution_model"), F.col(m).alias("revenue"))
                    for m in MODELS
                ]
            )
        ).alias("m"),
    ).select(
        "m.attribution_model",
        "m.revenue",
        "attributed_value",
        (gap < F.greatest(F.lit(1.0), F.col("attributed_value") * 0.001)).alias("reconciles"),
    )


def _decay_sums(
    axis: DataFrame, window_days: int, half_life_days: float, lane: list[str], sums: dict[str, Column], counts: list[str] = []
) -> DataFrame:
    """Per closing marker: the decayed count of touches in its window, under each condition of `sums`.

    `n_all` is their plain count, and `counts` names running counts of the axis
    whose growth over the window is given as well; all of these are exact.

    2^(-(c - t) / h) is a factor of the touch times one of the conversion, so the
    sum over a window is a difference of two prefix sums of the touches' factor.
    The axis is cut into blocks of a window's width. Factors count from the
    start of their block, so they never exceed 2^(width / h) however long the
    history, and each prefix sum stays inside a block; a window touches two
    blocks at most.
    """
    width = window_days + 1
    seconds = F.lit(width * 86400).cast("long")
    block = F.floor(day_number(F.col("axis_ts")) / width)
    unused = [c for c in ("touch_rank", *_COUNTS) if c not in counts]
    point = axis.drop(*unused).withColumn("block", block).withColumn("lane", F.struct(*lane, "block"))
    rate = F.lit(half_life_days * 86400.0)
    factor = F.pow(F.lit(2.0), (second_number(F.col("axis_ts")) - F.col("block") * seconds).cast("double") / rate)
    mass = {name: F.when((F.col("mark") == "touch") & holds, factor).otherwise(F.lit(0.0)) for name, holds in sums.items()}
    mass["n_all"] = (F.col("mark") == "touch").cast("double")
    counted = running_sums(
        point, key="lane", ts="axis_ts", order_by=["axis_ts", "mark", "source", "id"], measures=mass, kind="double"
    )
    wholes = point.groupBy(*lane, F.col("block").alias("lo_block")).agg(*[F.sum(m).alias(f"all_{n}") for n, m in mass.items()])
    spans = _spans(counted, ["block", *mass, *counts], lane).join(wholes, [*lane, "lo_block"])

    def since(start: Column) -> Column:
        return F.pow(F.lit(2.0), -(second_number(F.col("conversion_ts")) - start * seconds).cast("double") / rate)

    def decayed(name: str) -> Column:
        low, high = F.col(f"lo_{name}"), F.col(f"hi_{name}")
        across = high * since(F.col("hi_block")) + (F.col(f"all_{name}") - low) * since(F.col("lo_block"))
        return F.when(F.col("lo_block") == F.col("hi_block"), (high - low) * since(F.col("hi_block"))).otherwise(across)

    all_between = F.when(F.col("lo_block") == F.col("hi_block"), F.lit(0.0)).otherwise(F.col("all_n_all"))
    return spans.select(
        "conversion_id",
        "conversion_value_eur",
        *lane,
        *[decayed(name).alias(name) for name in sums],
        (F.col("hi_n_all") + all_between - F.col("lo_n_all")).alias("n_all"),
        *[(F.col(f"hi_{c}") - F.col(f"lo_{c}")).alias(c) for c in counts],
    )


def decay_totals(axis: DataFrame, window_days: int, half_life_days: float) -> DataFrame:
    """`(conversion_id, total)`: what the credits of a conversion's touches are divided by."""
    totals = _decay_sums(axis, window_days, half_life_days, ["unified_user_id"], {"total": F.lit(True)})
    return totals.select("conversion_id", "total")


def time_decay(
    touches: DataFrame, convs: DataFrame, axis: DataFrame, window_days: int, half_life_days: float
) -> DataFrame:
    """Credit halving with every `half_life_days` between touch and conversion.

    The normalising sum comes from the axis, so touches meet conversions once.
    """
    before = (F.col("touchpoint_ts") < F.col("conversion_ts")) & (
        F.col("_conv_day") - F.col("_day") <= window_days
    )
    age = seconds_between(F.col("touchpoint_ts"), F.col("conversion_ts")) / F.lit(86400.0)
    totals = decay_totals(axis, window_days, half_life_days)
    weighed = in_window_pairs(touches, convs.join(totals, "conversion_id"), window_days, before)
    weight = F.pow(F.lit(2.0), -age / F.lit(half_life_days)) / F.col("total")
    return weighed.select(
        "conversion_id",
        "conversion_value_eur",
        "touchpoint_id",
        "channel_key",
        F.lit("time_decay").alias("attribution_model"),
        weight.alias("weight"),
        (F.col("conversion_value_eur") * weight).alias("revenue_share_eur"),
    )


def time_decay_channels(axis: DataFrame, window_days: int, half_life_days: float) -> DataFrame:
    """Decayed credit per (conversion, channel): touches and conversions never meet in pairs."""
    listed = {"total": F.lit(True)} | {
        f"mass_{key}": F.coalesce(F.col("channel_key") == key, F.lit(False)) for key in CHANNEL_KEYS
    }
    sums = _decay_sums(axis, window_days, half_life_days, ["unified_user_id"], listed, _COUNTS).where("conversion_id is not null")
    per_channel = F.explode(
        F.array(
            *[
                F.struct(F.lit(key).alias("channel_key"), F.col(f"mass_{key}").alias("mass"), F.col(c).alias("touches"))
                for key, c in zip(CHANNEL_KEYS, _COUNTS)
            ]
        )
    )
    # A difference of prefix sums leaves a trace where a channel has no touch; the exact counts say where.
    rows = (
        sums.select("conversion_id", "conversion_value_eur", "total", per_channel.alias("c"))
        .where(F.col("c.touches") > 0)
        .select("conversion_id", "conversion_value_eur", "total", "c.channel_key", "c.mass")
    )
    lanes = _lanes(axis)
    other = _decay_sums(lanes, window_days, half_life_days, ["unified_user_id", "lane_channel"], {"mass": F.lit(True)})
    totals = decay_totals(axis, window_days, half_life_days)
    unlisted = (
        other.where("n_all > 0")
        .withColumn("channel_key", F.get_json_object("lane_channel", "$.channel_key"))
        .join(totals, "conversion_id")
        .select("conversion_id", "conversion_value_eur", "total", "channel_key", "mass")
    )
    weight = F.col("mass") / F.col("total")
    return rows.unionByName(unlisted).select(
        "conversion_id",
        "channel_key",
        weight.alias("weight"),
        (F.col("conversion_value_eur") * weight).alias("revenue_time_decay"),
    )
