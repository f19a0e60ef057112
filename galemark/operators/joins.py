"""Joins of readings with their weekly means, posts with scores and comments with posts.

The looked-up side is brought down to one row per key first, so no join pairs copies with copies.  No
join carries a broadcast hint: Spark broadcasts a side it measures as small, and splits the hot keys
of the other side otherwise (adaptive skew join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from galemark.functions.stats import slice_of
from galemark.operators.windows import latest_per_key, one_per_key

_METRICS = ("location", "window_ts", "temperature", "humidity", "precipitation")


def _readings(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "location", F.col("event_time").alias("window_ts"),
        "temperature", "humidity", "precipitation",
    )


def last_known(moments: DataFrame, facts: DataFrame, key: str, at: str) -> DataFrame:
    """Each distinct (key, at) of `moments` with the columns of the newest of `facts` at or before it.

    Moments and facts of a key are put in one order of time, along which the last fact is carried: no
    pair of a moment and an earlier fact is ever made.  Of facts of one time the largest by their other
    columns counts; moments without an earlier fact are left out, as are null keys and times.
    """
    rest = [c for c in facts.columns if c not in (key, at)]
    known = facts.groupBy(key, at).agg(F.max(F.struct(*rest)).alias("_fact"))
    asked = moments.select(key, at).distinct().withColumn("_asked", F.lit(True))
    both = known.withColumn("_asked", F.lit(False)).unionByName(asked, allowMissingColumns=True)
    # Facts come before moments of the same time; with the slice, a later join can split a hot key.
    so_far = Window.partitionBy(key, "_slice").orderBy(at, "_asked").rowsBetween(Window.unboundedPreceding, 0)
    both = both.dropna(subset=[key, at]).withColumn("_slice", slice_of(key))
    carried = both.withColumn("_fact", F.last("_fact", ignorenulls=True).over(so_far))
    return carried.filter(F.col("_asked") & F.col("_fact").isNotNull()).select(key, at, "_fact.*")


def _day_end(time: str) -> Column:
    return F.date_trunc("day", time) + F.expr("INTERVAL 1 DAY")


def with_latest_means(readings: DataFrame, means: DataFrame) -> DataFrame:
    """Each reading with the newest weekly mean of its location that its day completes (null where none).

    Joining on the location alone would pair a reading with every window of its location, of which
    the keyed table keeps one; this goes straight to one row per reading.  A window counts if it has
    ended by the end of the reading's day, so one that has hardly begun never does.  Readings ask by
    day: a location has as many moments as days, however many readings there are.
    """
    left = _readings(readings).withColumn("_until", _day_end("window_ts"))
    ended = means.select(
        F.col("loc").alias("location"), F.col("window.end").alias("_until"), "temp_7d_avg", "humidity_7d_avg"
    )
    newest = last_known(left, ended, "location", "_until")
    return left.join(newest, ["location", "_until"], "left").select(
        *_METRICS, "temp_7d_avg", "humidity_7d_avg", F.current_timestamp().alias("ts_ingested"),
    )


def climate_metrics(readings: DataFrame, means: DataFrame) -> DataFrame:
    """One row per (location, time) with the mean of the seven days that end with its day."""
    left = latest_per_key(
        _readings(readings), ["location", "window_ts"],
        ["temperature", "humidity", "precipitation"],
    )
    weekly = means.select(
        "loc", F.col("window.end").alias("day_end"), "temp_7d_avg", "humidity_7d_avg"
    )
    matched = (F.col("location") == F.col("loc")) & (_day_end("window_ts") == F.col("day_end"))
    return left.join(weekly, matched, "left").select(
        *_METRICS, "temp_7d_avg", "humidity_7d_avg",
        F.current_timestamp().alias("ts_ingested"),
    )


def posts_with_sentiment(
    posts: DataFrame, sentiment: DataFrame, newest: Sequence[str] = ("event_time_utc",)
) -> DataFrame:
    """Every post with its newest score by `newest`, if any."""
    scores = sentiment.select("post_id", *newest, "sentiment_label", "sentiment_score")
    return posts.join(one_per_key(scores, "post_id", newest).drop(*newest), "post_id", "left")


def comment_thread(
    comments: DataFrame, posts: DataFrame, newest: Sequence[str] = ("timestamp",)
) -> DataFrame:
    """Comments with the title and author of their post, in its newest version by `newest`."""
    parents = posts.select(
        F.col("id").alias("post_id"),
        *(F.col(c).alias(f"_{c}") for c in newest),
        F.col("title").alias("post_title"),
        F.col("author").alias("post_author"),
    )
    order = [f"_{c}" for c in newest]
    return comments.join(one_per_key(parents, "post_id", order).drop(*order), "post_id")


def orphan_comments(comments: DataFrame, posts: DataFrame) -> DataFrame:
    """Comments whose post is unknown."""
    return comments.join(posts.select(F.col("id").alias("post_id")), "post_id", "left_anti")
