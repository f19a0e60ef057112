"""Summary of raw readings per sensor and day, with exact quantiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from galemark.functions.stats import ratio

# Quantiles of the daily summary.
QUANTILES = {"q02": 0.02, "q25": 0.25, "median": 0.5, "q75": 0.75, "q98": 0.98}


def sensor_daily_summary(
    readings: DataFrame,
    sensor: str = "sensor_id",
    value: str = "value",
    time: str = "event_time",
    expected: int = 24,
) -> DataFrame:
    """Minimum, quantiles, maximum, mean, deviation and coverage per sensor and UTC day.

    Quantiles interpolate between neighbours, the deviation is the sample one (null for a single
    reading), `expected` is the number of readings a full day has.
    """
    days = readings.select(
        sensor, F.to_date(time).alias("date"), F.col(value).alias("value")
    ).filter(F.col("value").isNotNull() & F.col("date").isNotNull())
    keys = [sensor, "date"]
    observed = F.col("observed_count")
    return quantiles_per_group(
        days, keys, "value", QUANTILES,
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("avg"),
        F.when(F.count("*") > 1, F.stddev_samp("value")).alias("sd"),
        F.count("*").alias("observed_count"),
    ).select(
        *keys, "min", *QUANTILES, "max", "avg", "sd",
        F.lit(expected).cast("bigint").alias("expected_count"), "observed_count",
        (ratio(observed, F.lit(expected)) * 100).alias("percent_complete"),
    )


def quantiles_per_group(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float], *figures: Column
) -> DataFrame:
    """Interpolated quantiles per group, exact, and further `figures`, in one grouping.

    The built-in aggregate counts equal values before the shuffle, so what a task holds of a group
    is its distinct values, however many rows it has; the daily readings of one sensor have few.
    """
    # All quantiles in one aggregate share one buffer.
    shares = F.array(*(F.lit(q) for q in quantiles.values()))
    found = df.groupBy(*keys).agg(*figures, F.percentile(value, shares).alias("_found"))
    named = (F.col("_found")[i].alias(name) for i, name in enumerate(quantiles))
    return found.select("*", *named).drop("_found")
