"""Flat records from the nested payloads of the data providers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from galemark import fixed_values as fv
from galemark.functions import geo, text
from galemark.functions.jsons import expand
from galemark.operators.windows import one_per_key


def decode(messages: DataFrame, schema: str) -> DataFrame:
    """Messages with JSON in `value` as columns of `schema`."""
    return expand(messages, "value", schema)


def flatten_sensors(locations: DataFrame) -> DataFrame:
    """One row per sensor of each location; a location without sensors gives none."""
    pollutant = F.col("sensor.parameter")
    name = F.coalesce(pollutant["name"], F.lit("unknown"))
    return locations.withColumn("sensor", F.explode("sensors")).select(
        F.col("sensor.id").alias("sensor_id"),
        F.col("id").alias("location_id"),
        F.coalesce("name", F.lit("Unknown")).alias("location_name"),
        name.alias("parameter_name"),
        F.coalesce(pollutant["units"], F.lit("")).alias("parameter_units"),
        F.coalesce(pollutant["displayName"], name).alias("parameter_display"),
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
    )


# Flat column -> field of a daily measurement.
_DAILY_FIELDS = {
    "parameter_id": "parameter.id",
    "parameter_name": "parameter.name",
    "parameter_units": "parameter.units",
    "parameter_display": "parameter.displayName",
    "value": "value",
    "period_label": "period.label",
    "period_interval": "period.interval",
    "datetime_from_utc": "period.datetimeFrom.utc",
    "datetime_from_local": "period.datetimeFrom.local",
    "datetime_to_utc": "period.datetimeTo.utc",
    "datetime_to_local": "period.datetimeTo.local",
    "summary_min": "summary.min",
    "summary_q02": "summary.q02",
    "summary_q25": "summary.q25",
    "summary_median": "summary.median",
    "summary_q75": "summary.q75",
    "summary_q98": "summary.q98",
    "summary_max": "summary.max",
    "summary_avg": "summary.avg",
    "summary_sd": "summary.sd",
    "coverage_expected_count": "coverage.expectedCount",
    "coverage_expected_interval": "coverage.expectedInterval",
    "coverage_observed_count": "coverage.observedCount",
    "coverage_observed_interval": "coverage.observedInterval",
    "coverage_percent_complete": "coverage.percentComplete",
    "coverage_percent_coverage": "coverage.percentCoverage",
    "coverage_datetime_from_utc": "coverage.datetimeFrom.utc",
    "coverage_datetime_to_utc": "coverage.datetimeTo.utc",
}


def flatten_daily(responses: DataFrame, sensors: DataFrame, newest: Sequence[str] = ()) -> DataFrame:
    """One flat row per daily measurement of a known sensor.

    `responses` has (sensor_id, results); place and coordinates come from `sensors`, since the
    measurements carry none.  Of a sensor's copies the newest by the columns `newest` counts; copies
    equal in these are settled by the largest values.
    """
    flat = responses.select("sensor_id", F.explode("results").alias("m")).select(
        "sensor_id",
        *(F.col(f"m.{field}").alias(name) for name, field in _DAILY_FIELDS.items()),
        F.coalesce("m.flagInfo.hasFlags", F.lit(False)).alias("has_flags"),
    )
    places = sensors.select(
        "sensor_id", "location_id", "location_name", "latitude", "longitude", *newest
    )
    known = one_per_key(places, "sensor_id", newest).drop(*newest)
    return flat.join(known, "sensor_id").withColumn("ingested_at_utc", F.current_timestamp())


def enrich_sensor(measurements: DataFrame, sensors: DataFrame, newest: Sequence[str] = ()) -> DataFrame:
    """Attach the sensor's attributes to its measurements; unknown sensors drop out.

    A sensor announced several times counts once, as announced last by the columns `newest` (these
    stay behind).
    No join hint: the sensor list is broadcast where Spark measures it as small enough, and a hot
    sensor is split by the adaptive skew join otherwise.
    """
    return measurements.join(one_per_key(sensors, "sensor_id", newest).drop(*newest), "sensor_id")


def explode_measurements(messages: DataFrame) -> DataFrame:
    """One row per entry of a message's measurement list."""
    return messages.select(
        "city", "timestamp_utc", F.explode("measurements").alias("m")
    ).select("city", "timestamp_utc", "m.*")


# Record column -> hourly array.
_HOURLY = {
    "temperature": "temperature_2m",
    "humidity": "relativehumidity_2m",
    "precipitation": "precipitation",
    "weather_code": "weathercode",
    "wind_speed": "windspeed_10m",
}


def hourly_first(forecasts: DataFrame) -> DataFrame:
    """The first hour of each forecast; a forecast with an empty or missing array gives no row."""
    arrays = {name: F.col(f"hourly.{array}") for name, array in _HOURLY.items()}
    complete = F.least(*(F.coalesce(F.size(a), F.lit(0)) for a in arrays.values())) > 0
    return forecasts.filter(complete).select(
        "location", "timestamp_utc",
        *(F.try_element_at(a, F.lit(1)).alias(name) for name, a in arrays.items()),
    )


def hourly_explode(forecasts: DataFrame) -> DataFrame:
    """One row per hour of each forecast; shorter arrays are filled with null."""
    hours = F.arrays_zip(*(F.col(f"hourly.{a}").alias(a) for a in _HOURLY.values()))
    return forecasts.select(
        "location", "timestamp_utc", F.posexplode(hours).alias("hour", "h")
    ).select(
        "location", "timestamp_utc", "hour",
        *(F.col(f"h.{array}").alias(name) for name, array in _HOURLY.items()),
    )


def flatten_comments(pages: DataFrame) -> DataFrame:
    """One row per top-level comment of a page; missing fields are null."""
    return pages.select(
        "video_id", "cycle",
        F.explode("items.snippet.topLevelComment.snippet").alias("c"),
    ).select(
        "video_id",
        F.col("c.authorDisplayName").alias("author"),
        F.col("c.textDisplay").alias("text"),
        F.col("c.publishedAt").alias("published_at"),
        "cycle",
    )


def keyword_prefilter(posts: DataFrame, keywords, columns=("title", "selftext")) -> DataFrame:
    """Posts in which any keyword occurs in any of `columns`, ignoring case."""
    return posts.filter(text.mentions_any([F.col(c) for c in columns], list(keywords)))


def within_radius(
    sensors: DataFrame,
    latitude: float = fv.LATITUDE,
    longitude: float = fv.LONGITUDE,
    radius_km: float = fv.RADIUS_KM,
    limit: int = fv.NEAREST_SENSORS,
    key: str = "sensor_id",
) -> DataFrame:
    """The `limit` nearest sensors inside the radius, nearest first (order is ours)."""
    distance = geo.distance_km(F.col("latitude"), F.col("longitude"), latitude, longitude)
    near = sensors.withColumn("distance_km", distance).filter(F.col("distance_km") <= radius_km)
    return near.orderBy("distance_km", key).limit(limit)


def union_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Posts of several sources in one frame; columns a source lacks are null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
