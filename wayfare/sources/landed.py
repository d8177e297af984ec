"""Landed API responses (JSON files) -> bronze rows.

Fetching is left to whatever lands the files; from there on it is a Spark read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the two report APIs.
AD_INSIGHTS = (
    "ad_id string, ad_name string, campaign_id string, campaign_name string, "
    "adset_id string, adset_name string, impressions string, reach string, clicks string, "
    "spend string, ctr string, cpc string, actions array<struct<action_type:string,value:string>>"
)
WEB_REPORT_DIMENSIONS = [
    "event_name", "device_category", "country", "source",
    "medium", "campaign", "page_location", "event_date",
]
WEB_REPORT_METRICS = ["event_count", "sessions", "total_users"]


def read_pages(
    spark: SparkSession, path: str, envelope: str, record: str, multiline: bool = True
) -> DataFrame:
    """Pages of the form `{"orders": [{...}, ...]}` -> one row per record.

    One file per page (`multiline`), or one page per line.
    """
    pages = (
        spark.read.schema(f"{envelope} array<struct<{_struct(record)}>>")
        .option("multiLine", multiline)
        .json(path)
    )
    return pages.select(F.explode(envelope).alias("r")).select("r.*")


def read_ad_insights(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Ad-level report: numbers arrive as text; the nested action list is kept."""
    rows = read_pages(spark, path, "data", AD_INSIGHTS, multiline)
    whole = {c: F.col(c).cast("bigint") for c in ("impressions", "reach", "clicks")}
    ratios = {c: F.col(c).cast("double") for c in ("spend", "ctr", "cpc")}
    return rows.withColumns({**whole, **ratios})


def read_web_report(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Report rows of positional values -> named, typed columns."""
    cell = "array<struct<value:string>>"
    rows = read_pages(
        spark, path, "rows", f"dimension_values {cell}, metric_values {cell}", multiline
    )
    return rows.select(
        *[F.col("dimension_values")[i]["value"].alias(n) for i, n in enumerate(WEB_REPORT_DIMENSIONS)],
        *[
            F.col("metric_values")[i]["value"].cast("bigint").alias(n)
            for i, n in enumerate(WEB_REPORT_METRICS)
        ],
    )


def read_raw_records(spark: SparkSession, path: str, envelope: str, multiline: bool = True) -> DataFrame:
    """Pages -> `(page, record)`: every record as JSON text; a page that is not such JSON has one NULL record.

    Nothing is dropped: whoever types the records sees what did not fit.
    """
    pages = spark.read.text(path, wholetext=multiline).select(
        F.col("_metadata.file_path").alias("page"), "value"
    )
    parsed = F.from_json("value", f"{envelope} array<string>")[envelope]
    return pages.select("page", F.explode_outer(F.coalesce(parsed, F.array(F.lit(None).cast("string")))).alias("record"))


def bad_pages(records: DataFrame) -> DataFrame:
    """`read_raw_records` -> `(page, bad)`: pages or lines of a file that could not be read."""
    return records.where(F.col("record").isNull()).groupBy("page").agg(F.count(F.lit(1)).alias("bad"))


def _rescued(fields: Column, typed: dict[str, Column], known: list[str]) -> Column:
    """What the schema has no column for, or no value of its type; NULL if there is nothing."""
    unread = [F.when(value.isNull(), F.lit(name)) for name, value in typed.items()]
    kept = F.map_filter(
        fields, lambda k, v: v.isNotNull() & (~k.isin(known) | F.coalesce(F.array_contains(F.array_compact(F.array(*unread)), k), F.lit(False)))
    )
    return F.when(F.size(kept) > 0, kept)


def ad_insights_rescued(records: DataFrame) -> DataFrame:
    """Raw records of the ad report -> the columns of bronze `meta_ad_insights`.

    A number that does not parse is NULL in its column and kept as text in
    `rescued`, as are fields that the schema does not know.
    """
    names = [c.strip().split(" ")[0] for c in AD_INSIGHTS.split(", ")]
    fields = F.from_json("record", "map<string,string>")
    whole, ratios = ("impressions", "reach", "clicks"), ("spend", "ctr", "cpc")
    read = records.where(F.col("record").isNotNull()).select(
        fields.alias("fields"), F.from_json("record", AD_INSIGHTS).alias("r")
    )
    typed = {c: F.expr(f"try_cast(r.{c} as bigint)") for c in whole} | {c: F.expr(f"try_cast(r.{c} as double)") for c in ratios}
    columns = [typed.get(c, F.col(f"r.{c}")).alias(c) for c in names]
    return read.select(*columns, _rescued(F.col("fields"), typed, names).alias("rescued"))


def web_report_rescued(records: DataFrame) -> DataFrame:
    """Raw rows of positional values -> the columns of bronze `ga4_report`.

    Values beyond the known positions, and counts that do not parse, are kept in
    `rescued` under `dimension_<n>` and `metric_<n>`.
    """
    cell = "array<struct<value:string>>"
    read = records.where(F.col("record").isNotNull()).select(
        F.from_json("record", f"dimension_values {cell}, metric_values {cell}").alias("r")
    )

    def at(kind: str, i: int) -> Column:
        return F.get(F.col(f"r.{kind}_values"), F.lit(i))["value"]

    counts = {n: F.try_to_number(at("metric", i), F.lit("999999999999999999")).cast("bigint") for i, n in enumerate(WEB_REPORT_METRICS)}

    def numbered(kind: str, known: Column) -> Column:
        places = F.transform(F.col(f"r.{kind}_values"), lambda x, i: F.struct(F.concat(F.lit(f"{kind}_"), i.cast("string")).alias("k"), x["value"].alias("v"), i.alias("i")))
        left = F.filter(places, lambda x: x["v"].isNotNull() & ~F.array_contains(known, x["i"]))
        return F.coalesce(F.transform(left, lambda x: F.struct(x["k"], x["v"])), F.array().cast("array<struct<k:string,v:string>>"))

    read_counts = F.array_compact(F.array(*[F.when(c.isNotNull(), F.lit(i)) for i, c in enumerate(counts.values())]))
    known_places = F.array(*[F.lit(i) for i in range(len(WEB_REPORT_DIMENSIONS))])
    rest = F.map_from_entries(F.concat(numbered("dimension", known_places), numbered("metric", read_counts)))
    return read.select(
        *[at("dimension", i).alias(n) for i, n in enumerate(WEB_REPORT_DIMENSIONS)],
        *[c.alias(n) for n, c in counts.items()],
        F.when(F.size(rest) > 0, rest).alias("rescued"),
    )


def _struct(columns: str) -> str:
    """`a string, b array<...>` -> `a:string, b:array<...>`, nested commas untouched."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(columns + ","):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            name, kind = columns[start:i].strip().split(" ", 1)
            out.append(f"{name}:{kind}")
            start = i + 1
    return ", ".join(out)
