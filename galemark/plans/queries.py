"""One registered query per operator, over the whole given tables.

A query takes the derived inputs and returns a frame; `register` turns it into the (session, folder)
form.  Clock columns are left out, times become zone-free, arrays become joined text, so that results
can be compared value by value.  Means of inexact numbers are rounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, TimestampType

from galemark import fixed_values as fv, schemas
from galemark.functions import text
from galemark.operators import (
    aggregate, classify, clean, daily, enrich, joins, logs, quantiles, serve, shape, windows,
)
from galemark.plans.inputs import POST_KEYWORDS, REGIONS, TERMS, Inputs
from galemark.session import use_utc
from galemark.sources import envelope as env, tables
from galemark.sources.logs import scan_logs
from galemark.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CLOCK = {"ingestion_time", "batch_timestamp", "ts_ingested", "ingested_at_utc"}

# Parameters of the registered queries.
VOCABULARY = {"terms": TERMS, "places": REGIONS}
AS_OF = "2024-01-31 00:00:00"
SUMMARY_DAYS = 14
CLASS_LABELS = [f"class_{i:02d}" for i in range(64)]
BREAKPOINTS = [
    (name, float(bound), label)
    for name, bounds in fv.AIR_BOUNDS.items()
    for bound, label in zip(bounds, fv.AIR_CLASSES)
] + [(name, None, fv.AIR_CLASSES[-1]) for name in fv.AIR_BOUNDS]


def comparable(df: DataFrame) -> DataFrame:
    """Without clock columns, times without zone, arrays as text."""

    def plain(field) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, ArrayType):
            column = F.array_join(column, ",")
        return column.alias(field.name)

    return df.select(*(plain(f) for f in df.schema.fields if f.name not in CLOCK))


def register(make: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(make(Inputs(use_utc(spark), sf_dir)))

    run.__name__ = make.__name__
    run.__doc__ = make.__doc__
    QUERIES[make.__name__] = run
    return make


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def flat_window(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


# Sources.


@register
def demux_count(t: Inputs) -> DataFrame:
    """Messages of each topic that has any."""
    return t.envelope.groupBy("topic").agg(F.count("*").alias("messages"))


@register
def parse_weather(t: Inputs) -> DataFrame:
    return env.parse_weather(t.messages(fv.WEATHER_TOPIC))


@register
def parse_air(t: Inputs) -> DataFrame:
    return env.parse_air(t.messages(fv.AIR_TOPIC))


@register
def parse_social(t: Inputs) -> DataFrame:
    return env.parse_social(t.messages(fv.VIDEO_TOPIC))


@register
def parse_sentiment(t: Inputs) -> DataFrame:
    return env.parse_sentiment(t.messages(fv.SENTIMENT_TOPIC))


@register
def parse_posts(t: Inputs) -> DataFrame:
    return env.parse_posts(t.messages(fv.POSTS_TOPIC))


@register
def parse_comments(t: Inputs) -> DataFrame:
    return env.parse_comments(t.messages(fv.COMMENTS_TOPIC))


def _doubtful(t: Inputs) -> DataFrame:
    """Weather messages of which some are cut off and some have an unreadable time."""
    text_value, place = F.col("value").cast("string"), F.col("key").cast("string")
    damaged = (
        F.when(place.contains("North"), F.regexp_replace(text_value, r"\}$", ""))
        .when(place == "Cambridge", F.regexp_replace(
            text_value, r'"timestamp_utc":"[^"]*"', '"timestamp_utc":"yesterday"'))
        .otherwise(text_value)
    )
    return t.messages(fv.WEATHER_TOPIC).withColumn("value", damaged.cast("binary"))


@register
def valid_rows(t: Inputs) -> DataFrame:
    parsed = clean.valid_rows(env.parse_weather(_doubtful(t), strict=True))
    return parsed.select("location", "event_time", "temperature", "humidity", "source_topic")


@register
def rejected_rows(t: Inputs) -> DataFrame:
    parsed = env.rejects(env.parse_weather(_doubtful(t), strict=True))
    return parsed.select("kafka_timestamp", "reject_reason")


@register
def scan_city(t: Inputs) -> DataFrame:
    rows = t.weather_parsed.select(
        text.city_name(F.col("location")).alias("city"),
        F.col("event_time").alias("event_time_utc"), "temperature", "humidity", "wind_speed",
    )
    return tables.scan_city(rows, "Boston, USA")


@register
def log_scan(t: Inputs) -> DataFrame:
    return scan_logs(t.log_lines)


# Payloads.


@register
def flatten_sensors(t: Inputs) -> DataFrame:
    return t.sensors


@register
def flatten_daily(t: Inputs) -> DataFrame:
    responses = shape.decode(t.daily_responses, schemas.DAILY_RESPONSE)
    return shape.flatten_daily(responses, t.sensors)


@register
def enrich_sensor(t: Inputs) -> DataFrame:
    return shape.enrich_sensor(t.measurements, t.sensors)


@register
def explode_measurements(t: Inputs) -> DataFrame:
    return shape.explode_measurements(shape.decode(t.measurement_lists, schemas.MEASUREMENT_LIST))


@register
def hourly_first(t: Inputs) -> DataFrame:
    return shape.hourly_first(shape.decode(t.forecasts, schemas.HOURLY_WEATHER))


@register
def hourly_explode(t: Inputs) -> DataFrame:
    return shape.hourly_explode(shape.decode(t.forecasts, schemas.HOURLY_WEATHER))


@register
def flatten_comments(t: Inputs) -> DataFrame:
    return shape.flatten_comments(shape.decode(t.comment_pages, schemas.COMMENT_PAGE))


@register
def keyword_prefilter(t: Inputs) -> DataFrame:
    posts = shape.keyword_prefilter(t.forum_posts_raw, POST_KEYWORDS)
    return posts.select("id", "title", "author", "selftext", "subreddit")


@register
def hashtags(t: Inputs) -> DataFrame:
    return t.short_posts_raw.select("id", text.hashtags(F.col("text")).alias("hashtags"))


@register
def parent_id(t: Inputs) -> DataFrame:
    return t.forum_comments_raw.select(
        "id", "name",
        "post_id",
        text.parent_id(F.col("name")).alias("own_id"),
        text.parent_id(F.col("author")).alias("no_id"),
    )


@register
def within_radius(t: Inputs) -> DataFrame:
    return rounded(shape.within_radius(t.sensors), 6, "distance_km")


@register
def to_envelope(t: Inputs) -> DataFrame:
    """Sentiment messages by key, read back to columns."""
    messages = env.to_envelope(t.sentiment_raw, fv.SENTIMENT_TOPIC, "post_id", "at")
    body = F.from_json(F.col("value").cast("string"), schemas.SENTIMENT)
    return messages.select(
        "topic", F.col("key").cast("string").alias("key"), "timestamp", body.alias("v")
    ).select("topic", "key", "timestamp", "v.sentiment_label", "v.sentiment_score")


@register
def union_sources(t: Inputs) -> DataFrame:
    videos = t.social_raw.select("id", "title", "body", "source", "upvotes")
    forum = t.forum_posts_raw.select(
        F.concat(F.lit("f"), "id").alias("id"), "title", F.col("selftext").alias("body"),
        F.lit("forum").alias("source"), "upvotes",
    )
    short = t.short_posts_raw.select("id", F.col("text").alias("body"), F.col("platform").alias("source"))
    return shape.union_sources(videos, forum, short)


# Cleaning.


@register
def normalize_text(t: Inputs) -> DataFrame:
    documents = t.documents.select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    pages = t.pages.select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    return documents.unionByName(pages).select(
        "kind", "id", text.normalize_text(F.col("text")).alias("normalized")
    )


@register
def clean_weather(t: Inputs) -> DataFrame:
    return clean.clean_weather(env.parse_weather(t.messages(fv.WEATHER_TOPIC)))


@register
def clean_air(t: Inputs) -> DataFrame:
    return clean.clean_air(env.parse_air(t.messages(fv.AIR_TOPIC)))


@register
def clean_social(t: Inputs) -> DataFrame:
    return clean.clean_social(env.parse_social(t.messages(fv.VIDEO_TOPIC)))


@register
def clean_sentiment(t: Inputs) -> DataFrame:
    return clean.clean_sentiment(env.parse_sentiment(t.messages(fv.SENTIMENT_TOPIC)))


# Enrichment.


@register
def weather_enriched(t: Inputs) -> DataFrame:
    return t.weather


@register
def aqi_category(t: Inputs) -> DataFrame:
    """Readings per pollutant and class."""
    return t.air.groupBy("parameter_normalized", "aqi_category").agg(
        F.count("*").alias("readings"), F.min("value").alias("lowest"), F.max("value").alias("highest")
    )


@register
def aqi_range_join(t: Inputs) -> DataFrame:
    bounds = t.spark.createDataFrame(BREAKPOINTS, "parameter string, upper double, category string")
    readings = clean.clean_air(t.air_parsed)
    return enrich.classify_by_table(readings, bounds).select(
        "event_time_utc", "parameter_normalized", "value_standard_unit", "aqi_category"
    )


@register
def air_enriched(t: Inputs) -> DataFrame:
    return t.air.drop("aqi_score")


@register
def aqi_score(t: Inputs) -> DataFrame:
    scored = t.air.select("event_time_utc", "parameter_normalized", "value", "aqi_score")
    return rounded(scored, 6, "aqi_score")


@register
def social_enriched(t: Inputs) -> DataFrame:
    return enrich.enrich_social(clean.clean_social(t.social_parsed))


@register
def prepare_weather(t: Inputs) -> DataFrame:
    return enrich.weather_output(t.weather)


@register
def prepare_air(t: Inputs) -> DataFrame:
    return enrich.air_output(t.air.withColumnRenamed("value", "value_standard_unit"))


@register
def prepare_social(t: Inputs) -> DataFrame:
    return enrich.social_output(enrich.enrich_social(clean.clean_social(t.social_parsed)))


@register
def keywords_detect(t: Inputs) -> DataFrame:
    return t.posts.select("post_id", "keywords")


@register
def regions_detect(t: Inputs) -> DataFrame:
    return t.posts.select("post_id", "regions_detected")


@register
def softmax_label(t: Inputs) -> DataFrame:
    """Every vector as the logits of as many classes as it is long."""
    vectors = t.table("embeddings").withColumnRenamed("embedding", "logits")
    decided = classify.decide(vectors, CLASS_LABELS).drop("logits")
    return rounded(decided, 9, "sentiment_score")


@register
def sentiment_serving(t: Inputs) -> DataFrame:
    return enrich.sentiment_output(clean.clean_sentiment(t.sentiment_parsed), t.votes)


@register
def training_set(t: Inputs) -> DataFrame:
    posts = t.documents.select(F.col("doc_id").alias("post_id"), "text")
    labels = t.table("labels").withColumnRenamed("doc_id", "post_id")
    return classify.training_set(posts, labels)


# Aggregations.


def _weekly(t: Inputs) -> DataFrame:
    return windows.sliding_means(t.weather_parsed)


@register
def avg_7d_sliding(t: Inputs) -> DataFrame:
    return flat_window(_weekly(t))


@register
def sentiment_summary(t: Inputs) -> DataFrame:
    return aggregate.sentiment_summary(t.sentiment, AS_OF, SUMMARY_DAYS)


@register
def table_counts(t: Inputs) -> DataFrame:
    return tables.table_counts(t.spark, {
        "weather_data": t.weather,
        "air_quality_data": t.air,
        "social_posts": t.untagged_posts,
        "social_sentiment": t.sentiment,
        "daily_aggregates": tables.path_or_none(t.spark, f"{t.sf_dir}/daily_aggregates.parquet"),
    })


@register
def count_total(t: Inputs) -> DataFrame:
    return aggregate.total_count(t.weather)


@register
def avg_confidence_band(t: Inputs) -> DataFrame:
    return rounded(aggregate.confidence_band(t.sentiment), 6, "value")


@register
def label_counts(t: Inputs) -> DataFrame:
    return aggregate.label_counts(t.sentiment)


@register
def label_display(t: Inputs) -> DataFrame:
    return aggregate.label_display(t.sentiment).select("post_id", "sentiment_label", "label_text")


@register
def temp_summary(t: Inputs) -> DataFrame:
    by_place = t.weather.withColumn("city", F.col("location_normalized"))
    return aggregate.temperature_summary(by_place)


@register
def last_non_null(t: Inputs) -> DataFrame:
    return aggregate.last_non_null(t.weather_parsed, "location", "wind_speed", "event_time")


@register
def daily_aggregates(t: Inputs) -> DataFrame:
    return rounded(t.daily, 6, "avg_feels_like", "avg_aqi_score", "avg_sentiment_confidence")


@register
def rolling_corr(t: Inputs) -> DataFrame:
    return rounded(daily.rolling_correlation(t.daily), 6, "weather_corr", "pollution_corr")


@register
def correlation_metrics(t: Inputs) -> DataFrame:
    return daily.correlation_metrics(daily.correlation_counters(t.daily), 30)


@register
def sensor_daily_summary(t: Inputs) -> DataFrame:
    summary = quantiles.sensor_daily_summary(t.measurements)
    return rounded(summary, 6, *quantiles.QUANTILES, "avg", "sd", "percent_complete")


# Logs.


@register
def cycle_throughput(t: Inputs) -> DataFrame:
    return t.log_records.select("cycle", "records_sent", "elapsed_sec", "throughput_rps")


@register
def log_rate(t: Inputs) -> DataFrame:
    return logs.event_rate(t.log_records)


@register
def log_avg_throughput(t: Inputs) -> DataFrame:
    return rounded(logs.mean_throughput(t.log_records), 6, "throughput_rps")


@register
def log_cycle_duration(t: Inputs) -> DataFrame:
    return rounded(logs.mean_cycle_duration(t.log_records), 6, "elapsed_sec")


@register
def log_last_value(t: Inputs) -> DataFrame:
    return logs.last_values(t.log_records)


@register
def log_trailing(t: Inputs) -> DataFrame:
    return rounded(logs.trailing_activity(t.log_records), 6, "mean_throughput")


# Joins and windows.


@register
def join_avg_7d(t: Inputs) -> DataFrame:
    return joins.with_latest_means(t.weather_parsed, _weekly(t))


@register
def climate_metrics(t: Inputs) -> DataFrame:
    return joins.climate_metrics(t.weather_parsed, _weekly(t))


@register
def posts_with_sentiment(t: Inputs) -> DataFrame:
    posts = t.social_raw.select(F.col("id").alias("post_id"), "title", "source", "upvotes")
    return joins.posts_with_sentiment(posts, clean.clean_sentiment(t.sentiment_parsed))


@register
def comment_thread(t: Inputs) -> DataFrame:
    thread = joins.comment_thread(t.forum_comments_raw, t.forum_posts_raw)
    return thread.select("id", "post_id", "author", "body", "post_title", "post_author")


@register
def orphan_comments(t: Inputs) -> DataFrame:
    orphans = joins.orphan_comments(t.forum_comments_raw, t.forum_posts_raw)
    return orphans.select("id", "post_id", "author", "body")


@register
def trailing_7d(t: Inputs) -> DataFrame:
    return windows.trailing_means(
        t.weather_parsed, "location", "event_time",
        {"temp_7d_avg": "temperature", "humidity_7d_avg": "humidity"},
    )


def _hourly_readings(t: Inputs) -> DataFrame:
    return t.weather.select(
        F.col("location_normalized").alias("location"),
        F.date_trunc("hour", "event_time_utc").alias("window_ts"),
        "temperature_celsius", "humidity",
        F.col("event_time_utc").alias("written_at"),
    )


@register
def latest_per_key(t: Inputs) -> DataFrame:
    return windows.latest_per_key(_hourly_readings(t), ["location", "window_ts"], ["written_at"])


@register
def upsert_latest(t: Inputs) -> DataFrame:
    """Hourly table with anomalous readings corrected by a later write."""
    current = _hourly_readings(t)
    odd = t.weather.filter(F.col("weather_anomaly") != fv.NORMAL).select(
        F.col("location_normalized").alias("location"),
        F.date_trunc("hour", "event_time_utc").alias("window_ts"),
        (F.col("temperature_celsius") + 0.5).alias("temperature_celsius"), "humidity",
        (F.col("event_time_utc") + F.expr("INTERVAL 30 MINUTES")).alias("written_at"),
    )
    return windows.upsert(current, odd, ["location", "window_ts"], ["written_at"])


@register
def clustered_order(t: Inputs) -> DataFrame:
    rows = t.weather_parsed.select(
        "location", F.col("event_time").alias("window_ts"), "temperature", "humidity", "precipitation"
    )
    return windows.clustered(rows)


# Read operators.


@register
def weather_latest(t: Inputs) -> DataFrame:
    return serve.weather_latest(t.weather, 50)


@register
def weather_latest_anomaly(t: Inputs) -> DataFrame:
    return serve.weather_latest(t.weather, 50, anomaly_only=True)


@register
def weather_anomalies(t: Inputs) -> DataFrame:
    return serve.weather_anomalies(t.weather, 50)


@register
def air_latest(t: Inputs) -> DataFrame:
    return rounded(serve.air_latest(t.air, 100, spike_only=True), 6, "aqi_score")


@register
def air_latest_param(t: Inputs) -> DataFrame:
    return rounded(serve.air_latest(t.air, 50, "pm25"), 6, "aqi_score")


@register
def pollution_spikes(t: Inputs) -> DataFrame:
    return rounded(serve.pollution_spikes(t.air), 6, "aqi_score")


@register
def posts_latest(t: Inputs) -> DataFrame:
    return serve.posts_latest(t.untagged_posts, **VOCABULARY)


@register
def posts_latest_source(t: Inputs) -> DataFrame:
    return serve.posts_latest(t.untagged_posts, source="src3", **VOCABULARY)


@register
def sentiment_latest(t: Inputs) -> DataFrame:
    served = enrich.sentiment_output(clean.clean_sentiment(t.sentiment_parsed), t.votes)
    return serve.sentiment_latest(served, 50, "Positive")


@register
def daily_merged(t: Inputs) -> DataFrame:
    """Daily aggregates from the partial sums of three batches."""
    here = F.lit(fv.CITY)
    posts = t.social_parsed.select(
        F.col("id").alias("post_id"), F.col("event_time").alias("event_time_utc"), here.alias("city")
    )
    sentiment = t.sentiment.withColumn("city", here)

    def split(rows: DataFrame, partials: Callable[[DataFrame], DataFrame], key: str) -> DataFrame:
        batch = F.pmod(F.xxhash64(key), F.lit(3))
        parts = [partials(rows.filter(batch == i)) for i in range(3)]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    merged = daily.daily_from_partials(
        split(t.weather, daily.weather_partials, "event_time_utc"), split(t.air, daily.air_partials, "event_time_utc"),
        split(posts, daily.post_partials, "post_id"), split(sentiment, daily.sentiment_partials, "post_id"),
    )
    return rounded(merged, 6, "avg_feels_like", "avg_aqi_score", "avg_sentiment_confidence")


@register
def daily_latest(t: Inputs) -> DataFrame:
    rows = serve.daily_latest(t.daily, 14, "Boston, USA")
    return rounded(rows, 6, "avg_feels_like", "avg_aqi_score", "avg_sentiment_confidence")


@register
def search_keywords(t: Inputs) -> DataFrame:
    return serve.search_keywords(t.posts, "climate change, THAT ,lean", 50)


@register
def search_region(t: Inputs) -> DataFrame:
    return serve.search_region(t.posts, "eDIN", 50)


@register
def term_postings(t: Inputs) -> DataFrame:
    return enrich.term_postings(t.posts)


@register
def search_keywords_postings(t: Inputs) -> DataFrame:
    postings = enrich.term_postings(t.posts)
    return serve.search_keywords(t.untagged_posts, "climate change, THAT ,lean", 50, postings, **VOCABULARY)


@register
def search_region_postings(t: Inputs) -> DataFrame:
    return serve.search_region(t.untagged_posts, "eDIN", 50, enrich.term_postings(t.posts), **VOCABULARY)


@register
def posts_stored_latest(t: Inputs) -> DataFrame:
    """The newest rows of the table that the posts job stores."""
    return serve.posts_latest(jobs.social_table(t.messages(fv.VIDEO_TOPIC)), 30)


@register
def air_stored_latest(t: Inputs) -> DataFrame:
    """The newest rows of the table that the air-quality job stores."""
    return rounded(serve.air_latest(jobs.air_table(t.messages(fv.AIR_TOPIC)), 50), 6, "aqi_score")


@register
def weather_latest_text(t: Inputs) -> DataFrame:
    return serve.iso_times(serve.weather_latest(t.weather, 50))


@register
def recent_posts_sentiment(t: Inputs) -> DataFrame:
    scores = windows.one_per_key(t.sentiment, "post_id", ["event_time_utc"])
    posts = t.untagged_posts.select("post_id", "event_time_utc", "body_normalized", "source")
    scored = posts.join(scores.select("post_id", "sentiment_label", "sentiment_confidence_pct"), "post_id")
    return serve.recent_posts_with_sentiment(scored)


@register
def temp_series(t: Inputs) -> DataFrame:
    return serve.temperature_series(t.weather)


@register
def current_temperature(t: Inputs) -> DataFrame:
    return serve.current_temperature(t.weather)
