"""Summaries and panels.  All are plain grouped aggregations with map-side partial results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from galemark import fixed_values as fv
from galemark.functions import bands, social
from galemark.functions.stats import ratio
from galemark.operators.serve import check_days


def _label_tests(label: Column) -> dict[str, Column]:
    """Tests for positive, negative and everything else, on the lower-cased label."""
    tidy = F.lower(label)
    positive = F.coalesce(tidy == "positive", F.lit(False))
    negative = F.coalesce(tidy == "negative", F.lit(False))
    return {"positive": positive, "negative": negative, "neutral": ~(positive | negative)}


def label_counters(label: Column) -> dict[str, Column]:
    """Count aggregates for positive, negative and neutral; any other label is neutral."""
    return {name: F.count_if(test) for name, test in _label_tests(label).items()}


def sentiment_summary(sentiment: DataFrame, as_of: str | Column, days: int = 1) -> DataFrame:
    """Counts, percentages and mean confidence of the last `days` days before `as_of`.

    A missing confidence counts as 0; an empty range gives zeros.  Rounded to two decimals.
    """
    check_days(days)
    now = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    recent = sentiment.filter(
        F.col("event_time_utc") >= now - F.expr(f"INTERVAL {int(days)} DAYS")
    )
    confidence = F.coalesce("sentiment_confidence_pct", F.lit(0.0))
    counts = label_counters(F.col("sentiment_label"))
    totals = recent.agg(
        F.count("*").alias("total_posts"),
        *(counter.alias(name) for name, counter in counts.items()),
        F.sum(confidence).alias("confidence"),
    )
    total = F.col("total_posts")
    return totals.select(
        "total_posts", *counts,
        *(F.round(ratio(F.col(n) * 100, total, 0.0), 2).alias(f"{n}_pct") for n in counts),
        F.round(F.coalesce(ratio(F.col("confidence"), total), F.lit(0.0)), 2).alias("avg_confidence"),
    )


def total_count(table: DataFrame) -> DataFrame:
    """Number of rows."""
    return table.agg(F.count("*").alias("value"))


def confidence_band(sentiment: DataFrame) -> DataFrame:
    """Mean known confidence in percent and its colour band."""
    percent = sentiment.agg((F.avg("sentiment_confidence_pct") * 100).alias("value"))
    colour = bands.at_least(F.col("value"), fv.CONFIDENCE_BANDS, fv.CONFIDENCE_BELOW)
    return percent.withColumn("band", colour)


def label_counts(sentiment: DataFrame) -> DataFrame:
    """Rows per sentiment label."""
    return sentiment.groupBy("sentiment_label").agg(F.count("*").alias("count"))


def label_display(sentiment: DataFrame) -> DataFrame:
    """Rows with the label's display text."""
    return sentiment.withColumn("label_text", social.display_label(F.col("sentiment_label")))


def temperature_summary(weather: DataFrame) -> DataFrame:
    """Mean, maximum and minimum temperature per city."""
    t = "temperature_celsius"
    return weather.groupBy("city").agg(
        F.avg(t).alias("mean"), F.max(t).alias("max"), F.min(t).alias("min")
    )


def last_non_null(df: DataFrame, key: str, value: str, time: str, tie: str | None = None) -> DataFrame:
    """The newest known value per key; all-null keys give null."""
    order = F.struct(time, tie) if tie else F.col(time)
    known = F.when(F.col(value).isNotNull(), order)
    return df.groupBy(key).agg(F.max_by(value, known).alias(value))


def cycle_throughput(cycles: DataFrame) -> DataFrame:
    """Add throughput_rps = records per second to three decimals, 0 when no time has passed."""
    sent, elapsed = F.col("records_sent"), F.col("elapsed_sec")
    rate = F.when(elapsed > 0, F.round(ratio(sent, elapsed), 3)).otherwise(F.lit(0.0))
    return cycles.withColumn("throughput_rps", rate)
