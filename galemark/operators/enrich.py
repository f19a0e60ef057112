"""Enrichment columns and the output projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from galemark import fixed_values as fv
from galemark.functions import air, social, text, weather
from galemark.operators.windows import one_per_key


def enrich_weather(clean: DataFrame) -> DataFrame:
    """Add feels_like_temp, wind_category and weather_anomaly."""
    temperature, wind = F.col("temperature_celsius"), F.col("wind_speed")
    return clean.withColumns({
        "feels_like_temp": weather.feels_like(temperature, wind),
        "wind_category": weather.wind_category(wind),
        "weather_anomaly": weather.weather_anomaly(temperature, F.col("precipitation"), wind),
    })


def enrich_air(clean: DataFrame) -> DataFrame:
    """Add aqi_category, pollution_spike, health_risk_level and aqi_score."""
    pollutant, value = F.col("parameter_normalized"), F.col("value_standard_unit")
    return clean.withColumns({
        "aqi_category": air.aqi_category(pollutant, value),
        "pollution_spike": air.pollution_spike(value),
        "aqi_score": air.aqi_score(pollutant, value),
    }).withColumn("health_risk_level", air.health_risk_level(F.col("aqi_category")))


def enrich_social(clean: DataFrame) -> DataFrame:
    """Add engagement_score, text_length and the text handed to the scorer."""
    body = F.col("body_normalized")
    return clean.withColumns({
        "engagement_score": social.engagement_score(F.col("upvotes")),
        "text_length": F.length(body),
        "text_for_bert": body,
    })


def classify_by_table(
    readings: DataFrame, breakpoints: DataFrame, otherwise: str = fv.NOT_CLASSIFIED
) -> DataFrame:
    """Add aqi_category from a breakpoint table (parameter, upper, category).

    Bounds are inclusive; a null `upper` is the open last class, which a missing value gets too.
    The table is folded to one row per pollutant first, so a reading joins one row and looks its
    class up, whatever the number of bounds.
    """
    step = F.struct("upper", "category")
    folded = breakpoints.groupBy("parameter").agg(
        F.array_sort(F.collect_list(F.when(F.col("upper").isNotNull(), step))).alias("steps"),
        F.max(F.when(F.col("upper").isNull(), F.col("category"))).alias("open_class"),
    )
    value = F.col("value_standard_unit")
    reached = F.filter("steps", lambda s: value <= s["upper"])
    found = F.coalesce(F.try_element_at(reached, F.lit(1))["category"], F.col("open_class"))
    joined = readings.join(
        folded, F.col("parameter_normalized") == F.col("parameter"), "left"
    )
    return joined.withColumn("aqi_category", F.coalesce(found, F.lit(otherwise))).drop(
        "parameter", "steps", "open_class"
    )


def tag_posts(
    posts: DataFrame,
    terms: Sequence[str] = fv.SEARCH_TERMS,
    places: Sequence[str] = fv.PLACES,
    columns: Sequence[str] = ("title_normalized", "body_normalized"),
) -> DataFrame:
    """Add `keywords` and `regions_detected`: the terms and places named in the text (ours).

    A generator computes them, so they are found once per post and not again in every filter on them.
    """
    lowered = posts.withColumn("_said", F.lower(F.concat_ws(" ", *columns)))
    said = F.col("_said")
    tags = F.transform(
        F.array(text.words_in(said)),
        lambda words: F.struct(
            text.terms_in(said, terms, words).alias("keywords"),
            text.terms_in(said, places, words).alias("regions_detected"),
        ),
    )
    return lowered.select(*posts.columns, F.inline(tags))


def term_postings(tagged: DataFrame) -> DataFrame:
    """One row per post and term it names: kind ('keyword' or 'place'), term in lower case, time, id.

    Stored in folders by kind and term, of which vocabularies bound the number, a search reads the
    lists of its terms only.
    """
    def named(kind: str, column: str) -> Column:
        terms = F.array_distinct(text.lower_each(F.coalesce(column, F.array().cast("array<string>"))))
        return F.transform(terms, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term")))

    each = F.concat(named("keyword", "keywords"), named("place", "regions_detected"))
    return tagged.select(F.inline(each), "event_time_utc", "post_id")


def weather_output(enriched: DataFrame) -> DataFrame:
    """Columns of the stored weather table."""
    # The columns.
    return enriched.select(
        "city", "event_time_utc", "temperature_celsius", "feels_like_temp", "humidity",
        "precipitation", "wind_speed", "wind_category", "weather_anomaly", "weather_code",
        "ingestion_time", F.current_timestamp().alias("batch_timestamp"),
    )


def air_output(enriched: DataFrame) -> DataFrame:
    """Columns of the stored air-quality table."""
    # The columns.
    return enriched.select(
        "city", "event_time_utc", "parameter_normalized",
        F.col("value_standard_unit").alias("value"),
        "aqi_category", "health_risk_level", "pollution_spike",
        "ingestion_time", F.current_timestamp().alias("batch_timestamp"),
    )


def air_stored(enriched: DataFrame) -> DataFrame:
    """Columns of the stored air-quality table with those that are served beside them."""
    # The columns.
    served = enriched.select(
        "city", "event_time_utc", "parameter_normalized",
        F.col("value_standard_unit").alias("value"), "unit",
        "aqi_category", "aqi_score", "health_risk_level", "pollution_spike", "ingestion_time",
    )
    return served.withColumn("batch_timestamp", F.current_timestamp())


def social_output(enriched: DataFrame) -> DataFrame:
    """Columns of the stored posts table."""
    # The columns.
    return enriched.select(
        F.col("id").alias("post_id"),
        "title_normalized", "body_normalized", "author_normalized",
        F.col("source_topic").alias("source"),
        "event_time_utc", "upvotes", "url",
        "ingestion_time", F.current_timestamp().alias("batch_timestamp"),
    )


def sentiment_output(
    sentiment: DataFrame, posts: DataFrame | None = None, newest: Sequence[str] = (),
) -> DataFrame:
    """Served sentiment rows: category, confidence and engagement with their defaults.

    The category is the label (ours).  Engagement comes from `posts` (post_id, upvotes), 0 without;
    of a post's copies the newest by the columns `newest` counts, of those equal in them the highest.
    """
    if posts is None:
        rows = sentiment.withColumn("engagement_score", F.lit(0.0))
    else:
        engagement = social.engagement_score(F.col("upvotes")).alias("engagement_score")
        votes = one_per_key(posts.select("post_id", engagement, *newest), "post_id", newest).drop(*newest)
        rows = sentiment.join(votes, "post_id", "left")
    return rows.select(
        "post_id", "event_time_utc", "sentiment_label",
        F.coalesce("sentiment_label", F.lit("neutral")).alias("sentiment_category"),
        F.coalesce("sentiment_score", F.lit(0.0)).alias("sentiment_confidence_pct"),
        F.coalesce("engagement_score", F.lit(0.0)).alias("engagement_score"),
    )
