"""Silences of a stream: spells without rows, told while they last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import whole_minutes


def spells(rows: DataFrame, key: str | Column, at: str, minutes: int = 5, delay: str = "0 seconds") -> DataFrame:
    """(key, first_at, silent_since): spells of rows less than ``minutes`` apart, each told once it has ended.

    A spell is the state of a session window, merged in the map tasks before it is shuffled, so a hot
    key sends a line per spell and task. It is told as soon as event time, moved on by rows of
    any key, has passed its last row by ``minutes`` (and ``delay``, for rows out of order): while
    the key is still silent. In append mode a spell is told once; rows later than that are dropped.
    """
    session = F.session_window(at, f"{int(minutes)} minutes")
    told = rows.withWatermark(at, delay).groupBy(session, key).agg(F.min(at).alias("first_at"), F.max(at).alias("silent_since"))
    return told.drop("session_window")


def silences(told: DataFrame, key: str, minutes: int = 5) -> DataFrame:
    """Spells with the next one's start, if it has been told, and the whole minutes between.

    ``lasts`` marks silences without a known end; shorter ones than ``minutes`` whole minutes that
    have ended are left out.
    """
    onward = Window.partitionBy(key).orderBy("first_at")
    ended = told.withColumn("next_at", F.lead("first_at").over(onward))
    ended = ended.withColumn("minutes_diff", whole_minutes(F.col("silent_since"), F.col("next_at")))
    lasts = F.col("next_at").isNull()
    return ended.where(lasts | (F.col("minutes_diff") > minutes)).withColumn("lasts", lasts)
