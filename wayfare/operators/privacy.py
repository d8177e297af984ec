"""Right to be forgotten, for a batch of requests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.keys import email_hash
from wayfare.functions.timeutil import ntz


def resolve(requests: DataFrame, dim_users: DataFrame) -> DataFrame:
    """`requests(email)` -> the people behind them; an unknown e-mail yields nothing."""
    hashes = requests.select(email_hash(F.col("email")).alias("email_hash")).distinct()
    return hashes.join(
        dim_users.where(F.col("email_hash").isNotNull()).select("email_hash", "unified_user_id"),
        "email_hash",
    ).select("unified_user_id", "email_hash")


def erase(df: DataFrame, forgotten: DataFrame) -> DataFrame:
    """Rows of everyone else; rows without a person stay.

    A plain anti-join: the engine broadcasts the list when it measures it to be
    small and shuffles otherwise.
    """
    people = forgotten.select("unified_user_id")
    return df.join(people, "unified_user_id", "left_anti").select(*df.columns)


def tombstones(forgotten: DataFrame, as_of: datetime) -> DataFrame:
    return forgotten.select(
        "unified_user_id",
        "email_hash",
        ntz(as_of).alias("forgotten_at"),
        F.concat(F.lit("req_"), F.substring("unified_user_id", 1, 8)).alias("request_id"),
    )
