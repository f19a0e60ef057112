"""Daily figures per city and what is derived from them.

The quantities here are our definitions: a day is the UTC date of the event time, a figure without
any row that day is null, a counter is 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from galemark import fixed_values as fv
from galemark.functions.stats import newest_rows, ratio, rolling_pearson
from galemark.operators.aggregate import label_counters
from galemark.operators.serve import daily_latest

# Figures of a daily row.
_MEASURES = (
    "avg_temperature", "avg_feels_like", "max_temperature", "min_temperature", "avg_humidity",
    "total_precipitation", "avg_wind_speed", "avg_aqi_score", "avg_health_risk",
    "num_social_posts", "avg_sentiment_confidence", "positive_posts", "negative_posts",
    "neutral_posts", "anomaly_count", "pollution_spike_count",
)
_COUNTERS = (
    "num_social_posts", "positive_posts", "negative_posts", "neutral_posts", "anomaly_count",
    "pollution_spike_count",
)


def _per_day(df: DataFrame, *figures: Column) -> DataFrame:
    day = F.date_format("event_time_utc", "yyyy-MM-dd").alias("date")
    return df.filter(F.col("event_time_utc").isNotNull()).groupBy(day, "city").agg(*figures)


def daily_aggregates(
    weather: DataFrame, air: DataFrame, posts: DataFrame, sentiment: DataFrame
) -> DataFrame:
    """One row per (date, city) that any input knows.

    The four inputs are summed up by day first.  Their small results are lined up by a union and one
    more grouping, which has the result of a chain of full outer joins on (date, city).
    """
    of_weather = _per_day(
        weather,
        F.avg("temperature_celsius").alias("avg_temperature"),
        F.avg("feels_like_temp").alias("avg_feels_like"),
        F.max("temperature_celsius").alias("max_temperature"),
        F.min("temperature_celsius").alias("min_temperature"),
        F.avg("humidity").alias("avg_humidity"),
        F.sum("precipitation").alias("total_precipitation"),
        F.avg("wind_speed").alias("avg_wind_speed"),
        F.count_if(F.col("weather_anomaly") != fv.NORMAL).alias("anomaly_count"),
    )
    risk = F.col("health_risk_level")
    of_air = _per_day(
        air,
        F.avg("aqi_score").alias("avg_aqi_score"),
        F.avg(F.when(risk >= 0, risk)).alias("avg_health_risk"),
        F.count_if(F.col("pollution_spike")).alias("pollution_spike_count"),
    )
    of_posts = _per_day(posts, F.count_distinct("post_id").alias("num_social_posts"))
    labels = label_counters(F.col("sentiment_label"))
    of_sentiment = _per_day(
        sentiment,
        F.avg("sentiment_confidence_pct").alias("avg_sentiment_confidence"),
        *(counter.alias(f"{name}_posts") for name, counter in labels.items()),
    )
    parts = (of_weather, of_air, of_posts, of_sentiment)
    lined_up = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    zero = F.lit(0).cast("bigint")
    return lined_up.groupBy("date", "city").agg(*(
        (F.coalesce(F.max(m), zero) if m in _COUNTERS else F.max(m)).alias(m) for m in _MEASURES
    ))


# What a batch adds to a day, and how two such rows become one: averages as sums and counts.
_WEATHER_MEANS = {
    "avg_temperature": "temperature_celsius", "avg_feels_like": "feels_like_temp", "avg_humidity": "humidity",
    "avg_wind_speed": "wind_speed",
}


def _sum_and_count(name: str, value: Column) -> list[Column]:
    return [F.sum(value).cast("double").alias(f"sum_{name}"), F.count(value).alias(f"cnt_{name}")]


def weather_partials(weather: DataFrame) -> DataFrame:
    """What weather rows add to their days; `merged_partials` joins the parts of several batches."""
    return _per_day(
        weather,
        *(c for name, column in _WEATHER_MEANS.items() for c in _sum_and_count(name, F.col(column))),
        F.max("temperature_celsius").alias("max_temperature"),
        F.min("temperature_celsius").alias("min_temperature"),
        F.sum("precipitation").cast("double").alias("total_precipitation"),
        F.count_if(F.col("weather_anomaly") != fv.NORMAL).alias("anomaly_count"),
    )


def air_partials(air: DataFrame) -> DataFrame:
    """What air-quality rows add to their days."""
    risk = F.col("health_risk_level")
    return _per_day(
        air, *_sum_and_count("avg_aqi_score", F.col("aqi_score")),
        *_sum_and_count("avg_health_risk", F.when(risk >= 0, risk)),
        F.count_if(F.col("pollution_spike")).alias("pollution_spike_count"),
    )


def sentiment_partials(sentiment: DataFrame) -> DataFrame:
    """What sentiment rows add to their days."""
    labels = label_counters(F.col("sentiment_label"))
    return _per_day(
        sentiment, *_sum_and_count("avg_sentiment_confidence", F.col("sentiment_confidence_pct")),
        *(counter.alias(f"{name}_posts") for name, counter in labels.items()),
    )


def post_partials(posts: DataFrame) -> DataFrame:
    """The posts of each day: distinct ones cannot be added up, so they are kept by id."""
    days = posts.filter(F.col("event_time_utc").isNotNull())
    return days.select(F.date_format("event_time_utc", "yyyy-MM-dd").alias("date"), "city", "post_id").distinct()


def merged_partials(parts: DataFrame) -> DataFrame:
    """One row per (date, city) of partial rows of one kind, in any order and grouping."""
    if "post_id" in parts.columns:
        return parts.distinct()
    how = {"max_temperature": F.max, "min_temperature": F.min}
    return parts.groupBy("date", "city").agg(
        *(how.get(c, F.sum)(c).alias(c) for c in parts.columns if c not in ("date", "city"))
    )


def daily_from_partials(weather: DataFrame, air: DataFrame, posts: DataFrame, sentiment: DataFrame) -> DataFrame:
    """`daily_aggregates` of all rows whose partials these are, however they were split."""
    counted = posts.distinct().groupBy("date", "city").agg(F.count("post_id").alias("num_social_posts"))
    parts = [*map(merged_partials, (weather, air, sentiment)), counted]
    lined_up = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    zero = F.lit(0).cast("bigint")

    def figure(name: str) -> Column:
        if name in _COUNTERS:
            return F.coalesce(F.max(name), zero)
        return ratio(F.max(f"sum_{name}"), F.max(f"cnt_{name}")) if name.startswith("avg_") else F.max(name)

    return lined_up.groupBy("date", "city").agg(*(figure(m).alias(m) for m in _MEASURES))


def rolling_correlation(daily: DataFrame, rows: int = 7) -> DataFrame:
    """Correlation of sentiment confidence with temperature and with the air index, per city.

    Over the newest `rows` days up to each date.  A city has one row per day, so its window is
    bounded by the number of days.  Adds the band of each correlation.
    """
    return _with_correlations(daily, rows).select(
        "date", "city", "weather_corr", "pollution_corr", "weather_band", "pollution_band"
    )


def _with_correlations(daily: DataFrame, rows: int) -> DataFrame:
    over = newest_rows("city", "date", rows)
    mood = F.col("avg_sentiment_confidence")
    return daily.withColumns({
        "weather_corr": rolling_pearson(mood, F.col("avg_temperature"), over),
        "pollution_corr": rolling_pearson(mood, F.col("avg_aqi_score"), over),
    }).withColumns({
        "weather_band": _strength(F.col("weather_corr")),
        "pollution_band": _strength(F.col("pollution_corr")),
    })


def _strength(r: Column) -> Column:
    size = F.abs(r)
    return F.when(r.isNotNull(), (
        F.when(size >= fv.STRONG_CORRELATION, "strong")
        .when(size >= fv.MODERATE_CORRELATION, "moderate")
        .otherwise("weak")
    ))


def correlation_counters(daily: DataFrame, rows: int = 7) -> DataFrame:
    """Daily rows with their counters of strong correlations (1 or 0)."""
    zero = F.lit(0).cast("bigint")

    def strong(of: str) -> Column:
        return F.coalesce((F.col(f"{of}_band") == "strong").cast("bigint"), zero)

    return _with_correlations(daily, rows).select(
        *daily.columns,
        *(strong(of).alias(f"strong_sentiment_{of}_correlation") for of in ("weather", "pollution")),
    )


def correlation_metrics(counted: DataFrame, days: int = 30, city: str | None = fv.CITY) -> DataFrame:
    """Strong correlations in the newest `days` daily rows; the other bands are reported as 0."""
    recent = daily_latest(counted, days, city)
    none = F.lit(0).cast("bigint")

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), none)

    return recent.agg(
        total("strong_sentiment_weather_correlation").alias("sentiment_weather_strong"),
        total("strong_sentiment_pollution_correlation").alias("sentiment_pollution_strong"),
    ).withColumns({
        f"sentiment_{of}_{band}": none
        for of in ("weather", "pollution") for band in ("moderate", "weak")
    })
