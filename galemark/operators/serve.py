"""Read operators: newest rows, anomalies, searches.

"Newest n" is `orderBy(...).limit(n)`, which Spark runs as a distributed top-n.  Equal times are
ordered by an id, or by the row's other columns where there is none, so results are repeatable.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from galemark import fixed_values as fv
from galemark.functions.text import city_literal, city_name, lower_each
from galemark.operators.enrich import tag_posts

# Result columns.
WEATHER_COLUMNS = (
    "city", "event_time_utc", "temperature_celsius", "feels_like_temp", "humidity",
    "precipitation", "wind_speed", "wind_category", "weather_anomaly",
)
AIR_COLUMNS = (
    "city", "event_time_utc", "parameter_normalized", "value", "unit", "aqi_category",
    "aqi_score", "health_risk_level", "pollution_spike",
)


def check_limit(limit: int, most: int = 100) -> int:
    """Reject a limit outside 1..most before any job starts."""
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be in 1..{most}, not {limit}")
    return limit


def check_days(days: int) -> int:
    """Reject a number of days outside 1..90 before any job starts."""
    if not 1 <= days <= 90:
        raise ValueError(f"days must be in 1..90, not {days}")
    return days


def in_city(table: DataFrame, city: str | None) -> DataFrame:
    """Rows of a city compared by name only, so 'Boston', 'boston' and 'Boston, USA' are equal."""
    return table if city is None else table.filter(city_name(F.col("city")) == city_literal(city))


def newest(table: DataFrame, limit: int, *ties: str | Column, time: str = "event_time_utc") -> DataFrame:
    """The `limit` newest rows."""
    return table.orderBy(F.col(time).desc(), *ties).limit(limit)


def newest_whole(table: DataFrame, limit: int, *ties: str, time: str = "event_time_utc") -> DataFrame:
    """The `limit` newest rows of a wide table.

    They are found by time and ties alone; only then the rows themselves are read, so long texts are
    neither read nor worked on for the ranking.  At most `limit` keys are sent to every task.
    """
    keys = [time, *ties]
    top = newest(table.select(*keys), limit, *ties, time=time).distinct()
    top = F.broadcast(top.toDF(*(f"_{k}" for k in keys)))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return newest(table.join(top, reduce(lambda a, b: a & b, same), "left_semi"), limit, *ties, time=time)


def iso_times(rows: DataFrame, time: str = "event_time_utc") -> DataFrame:
    """Rows with the time as ISO-8601 text, the form results leave the system in."""
    text = F.date_format(F.col(time), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return rows.withColumn(time, F.regexp_replace(text, r"\.000000$", ""))


def weather_latest(
    weather: DataFrame, limit: int = 10, anomaly_only: bool = False, city: str | None = fv.CITY
) -> DataFrame:
    """Newest readings; `anomaly_only` drops the normal ones among those, so fewer may remain."""
    served = in_city(weather, city).select(*WEATHER_COLUMNS)
    rows = newest(served, check_limit(limit), *WEATHER_COLUMNS)
    return rows.filter(F.col("weather_anomaly") != fv.NORMAL) if anomaly_only else rows


def weather_anomalies(weather: DataFrame, limit: int = 50, city: str | None = fv.CITY) -> DataFrame:
    """Newest anomalous readings."""
    odd = in_city(weather, city).filter(F.col("weather_anomaly") != fv.NORMAL)
    return newest(odd.select(*WEATHER_COLUMNS), check_limit(limit, 500), *WEATHER_COLUMNS)


def air_latest(
    air: DataFrame,
    limit: int = 10,
    parameter: str | None = None,
    spike_only: bool = False,
    city: str | None = fv.CITY,
) -> DataFrame:
    """Newest measurements, of one pollutant if named; `spike_only` filters after the limit."""
    check_limit(limit)
    rows = in_city(air, city).select(*AIR_COLUMNS)
    if parameter:
        rows = rows.filter(F.col("parameter_normalized") == parameter)
    rows = newest(rows, limit, *AIR_COLUMNS)
    return rows.filter("pollution_spike") if spike_only else rows


def pollution_spikes(air: DataFrame, limit: int = 50, city: str | None = fv.CITY) -> DataFrame:
    """Newest measurements above the spike limit."""
    rows = in_city(air, city).filter("pollution_spike").select(*AIR_COLUMNS)
    return newest(rows, check_limit(limit, 500), *AIR_COLUMNS)


def _tagged(posts: DataFrame, tags: dict) -> DataFrame:
    """Posts with their terms and places; found here, by the vocabularies `tags`, if the table has none."""
    return posts if {"keywords", "regions_detected"} <= set(posts.columns) else tag_posts(posts, **tags)


def _served_posts(posts: DataFrame) -> DataFrame:
    """Post rows with their defaults."""
    none = F.array().cast("array<string>")
    empty = F.lit("")
    return posts.select(
        "post_id", "event_time_utc",
        F.coalesce("title_normalized", empty).alias("title_normalized"),
        F.coalesce("body_normalized", empty).alias("body_normalized"),
        F.coalesce("author_normalized", empty).alias("author_normalized"),
        "source",
        F.coalesce("upvotes", F.lit(0).cast("bigint")).alias("upvotes"),
        F.coalesce("keywords", none).alias("keywords"),
        F.coalesce("regions_detected", none).alias("regions_detected"),
    )


def posts_latest(posts: DataFrame, limit: int = 20, source: str | None = None, **tags) -> DataFrame:
    """Newest posts, of one source if named; posts without tags are tagged after the limit."""
    check_limit(limit)
    rows = posts.filter(F.col("source") == source) if source else posts
    return _served_posts(_tagged(newest_whole(rows, limit, "post_id"), tags))


def sentiment_latest(sentiment: DataFrame, limit: int = 20, label: str | None = None) -> DataFrame:
    """Newest served sentiment rows; an unknown label means no filter."""
    check_limit(limit)
    wanted = (label or "").lower()
    known = wanted in fv.SENTIMENTS
    rows = sentiment.filter(F.col("sentiment_label") == wanted) if known else sentiment
    return newest(rows, limit, "post_id")


def daily_latest(
    daily: DataFrame, days: int = 30, city: str | None = fv.CITY, date: str | None = None
) -> DataFrame:
    """Newest `days` daily rows of the city, or that of one date."""
    check_days(days)
    rows = in_city(daily, city)
    if date is not None:
        rows = rows.filter(F.col("date") == date)
    return newest(rows, days, "city", time="date")


def _found(posts: DataFrame, hits: DataFrame, limit: int, tags: dict) -> DataFrame:
    """The newest posts among hits (event_time_utc, post_id), of which `limit` go to every task.

    Where the posts lie in folders by day, only the days of these hits are read.
    """
    top = newest(hits.select("event_time_utc", "post_id").distinct(), limit, "post_id")
    if "event_date" in posts.columns:
        top = top.withColumn("event_date", F.to_date("event_time_utc"))
    rows = posts.join(F.broadcast(top), top.columns, "left_semi")
    return _served_posts(_tagged(newest(rows, limit, "post_id"), tags))


def search_keywords(
    posts: DataFrame, keywords: str, limit: int = 20, postings: DataFrame | None = None, **tags
) -> DataFrame:
    """Newest posts having any of the comma-separated keywords as a whole keyword.

    With `postings` (see `enrich.term_postings`) only the lists of these keywords and the posts that are
    served are read; else every post is looked at, and tagged if it is not.
    """
    check_limit(limit)
    asked = [k.strip().lower() for k in keywords.split(",")]
    if postings is not None:
        return _found(posts, postings.filter((F.col("kind") == "keyword") & F.col("term").isin(asked)), limit, tags)
    tagged = _tagged(posts, tags)
    wanted = F.array(*map(F.lit, asked))
    hit = F.coalesce(F.arrays_overlap(lower_each(F.col("keywords")), wanted), F.lit(False))
    return _served_posts(newest(tagged.filter(hit), limit, "post_id"))


def search_region(
    posts: DataFrame, region: str, limit: int = 20, postings: DataFrame | None = None, **tags
) -> DataFrame:
    """Newest posts that mention the region, ignoring case; `postings` as in `search_keywords`."""
    check_limit(limit)
    if postings is not None:
        return _found(posts, postings.filter((F.col("kind") == "place") & (F.col("term") == region.lower())), limit, tags)
    tagged = _tagged(posts, tags)
    places = lower_each(F.col("regions_detected"))
    hit = F.coalesce(F.array_contains(places, region.lower()), F.lit(False))
    return _served_posts(newest(tagged.filter(hit), limit, "post_id"))


def recent_posts_with_sentiment(scored: DataFrame, limit: int = 50) -> DataFrame:
    """Newest scored posts, the five columns of the panel."""
    check_limit(limit, 500)
    columns = ("event_time_utc", "body_normalized", "source", "sentiment_label", "sentiment_confidence_pct")
    return newest_whole(scored.select("post_id", *columns), limit, "post_id").select(*columns)


def temperature_series(
    weather: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Temperature by time in [start, end), per city."""
    rows = weather.select(
        F.col("event_time_utc").alias("time"),
        F.col("temperature_celsius").alias("value"),
        "city",
    )
    if start is not None:
        rows = rows.filter(F.col("time") >= F.lit(start).cast("timestamp"))
    if end is not None:
        rows = rows.filter(F.col("time") < F.lit(end).cast("timestamp"))
    return rows.orderBy("time", "city")


def current_temperature(weather: DataFrame) -> DataFrame:
    """The newest temperature."""
    return newest(
        weather.select("event_time_utc", "temperature_celsius"), 1, "temperature_celsius"
    ).select("temperature_celsius")
