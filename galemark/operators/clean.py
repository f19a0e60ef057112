"""Cleaning: valid rows, place filter, normalized text, fixed projections.

Times stay as they are: the session runs in UTC, so the event time already is the UTC time.  The result
columns are fixed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from galemark import fixed_values as fv
from galemark.functions.text import mentions, normalize_text, tidy


def valid_rows(parsed: DataFrame) -> DataFrame:
    """Rows marked valid by the parser."""
    return parsed.filter("is_valid")


def _place(city: str, region: str, country: str) -> dict:
    return {"city": F.lit(city), "region": F.lit(region), "country": F.lit(country)}


def clean_weather(
    parsed: DataFrame, city: str = fv.CITY, region: str = fv.REGION, country: str = fv.COUNTRY
) -> DataFrame:
    """Readings whose location mentions `city`, tagged with the place."""
    place = _place(city, region, country)
    return valid_rows(parsed).filter(mentions(F.col("location"), city)).select(
        tidy(F.col("location")).alias("location_normalized"),
        *(value.alias(name) for name, value in place.items()),
        F.col("event_time").alias("event_time_utc"),
        F.col("temperature").alias("temperature_celsius"),
        "humidity", "precipitation", "weather_code", "wind_speed",
        "source_topic", "ingestion_time",
    )


def clean_air(
    parsed: DataFrame, city: str = fv.CITY, region: str = fv.REGION, country: str = fv.COUNTRY
) -> DataFrame:
    """Measurements whose city or location mentions `city`; one of the two may be missing."""
    place = _place(city, region, country)
    here = mentions(F.col("city"), city) | mentions(F.col("location"), city)
    return valid_rows(parsed).filter(here).select(
        *(value.alias(name) for name, value in place.items()),
        tidy(F.col("parameter")).alias("parameter_normalized"),
        F.col("value").alias("value_standard_unit"),
        "unit", "latitude", "longitude",
        F.col("event_time").alias("event_time_utc"),
        "source_topic", "ingestion_time",
    )


def clean_social(
    parsed: DataFrame, city: str = fv.CITY, region: str = fv.REGION, country: str = fv.COUNTRY
) -> DataFrame:
    """Posts with normalized title, body and author, tagged with the place (no place filter)."""
    place = _place(city, region, country)
    return valid_rows(parsed).select(
        "id",
        normalize_text(F.col("title")).alias("title_normalized"),
        normalize_text(F.col("body")).alias("body_normalized"),
        tidy(F.col("author")).alias("author_normalized"),
        "source_topic", "upvotes",
        *(value.alias(name) for name, value in place.items()),
        F.col("event_time").alias("event_time_utc"),
        "url", "ingestion_time",
    )


def clean_sentiment(parsed: DataFrame) -> DataFrame:
    """Scores with a tidy label."""
    return valid_rows(parsed).select(
        "post_id",
        tidy(F.col("sentiment_label")).alias("sentiment_label"),
        "sentiment_score",
        F.col("event_time").alias("event_time_utc"),
        "ingestion_time",
    )
