"""The streaming jobs: enriched tables from messages, weekly means, readings with their means."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from galemark import fixed_values as fv, schemas
from galemark.functions.stats import ratio
from galemark.operators import clean, daily, enrich
from galemark.operators.joins import climate_metrics, with_latest_means
from galemark.operators.windows import sliding_means
from galemark.sources import envelope as env, shapes
from galemark.streaming import batches, sinks
from galemark.streaming.corrections import corrected_metrics

MEANS_COLUMNS = "loc string, start timestamp, end timestamp, temp_7d_avg double, humidity_7d_avg double"
MEANS_KEY = ("loc", "start")
METRICS_KEY = ("location", "window_ts")


def weather_table(envelope: DataFrame) -> DataFrame:
    """Stored weather rows from messages."""
    return enrich.weather_output(enrich.enrich_weather(clean.clean_weather(env.parse_weather(envelope))))


def air_table(envelope: DataFrame) -> DataFrame:
    """Stored air-quality rows from messages, with all columns that are served."""
    return enrich.air_stored(enrich.enrich_air(clean.clean_air(env.parse_air(envelope))))


def social_table(envelope: DataFrame) -> DataFrame:
    """Stored posts from messages."""
    return enrich.social_output(enrich.enrich_social(clean.clean_social(env.parse_social(envelope))))


def sentiment_table(envelope: DataFrame) -> DataFrame:
    """Clean sentiment rows from messages."""
    return clean.clean_sentiment(env.parse_sentiment(envelope))


def post_terms_table(envelope: DataFrame) -> DataFrame:
    """Which terms and places the posts name, by term: what the searches read."""
    return enrich.term_postings(enrich.tag_posts(social_table(envelope)))


def _comment_id() -> Column:
    """An id of a video comment, which has none: the video and a hash of author, time and text."""
    said = F.to_json(F.struct("author", "published_at", "body"))
    return F.concat_ws(":", "video_id", F.substring(F.sha2(said, 256), 1, 16))


def video_comments_table(envelope: DataFrame) -> DataFrame:
    """Video comments as stored posts."""
    rows = env.parse_video_comments(shapes.of_shape(envelope, fv.VIDEO_TOPIC, shapes.VIDEO_COMMENT))
    return _as_posts(rows.withColumn("id", _comment_id()))


def short_posts_table(envelope: DataFrame) -> DataFrame:
    """Short posts as stored posts."""
    return _as_posts(env.parse_short_posts(shapes.of_shape(envelope, fv.SHORT_POST_TOPIC, shapes.SHORT_POST)))


def _as_posts(rows: DataFrame) -> DataFrame:
    lacking = {"title": "string", "upvotes": "bigint", "url": "string"}
    rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in lacking.items()})
    return enrich.social_output(enrich.enrich_social(clean.clean_social(rows)))


def air_days_table(envelope: DataFrame) -> DataFrame:
    """Daily measurements of sensors, flat."""
    rows = env.parse_air_days(shapes.of_shape(envelope, fv.AIR_DAILY_TOPIC, shapes.AIR_DAY))
    return rows.withColumnRenamed("event_time", "event_time_utc").drop("source_topic", "is_valid", "kafka_timestamp")


# Keyed table of messages that their producers send again -> (topic, how its rows are made, key, what is newest).
KEYED: dict[str, tuple[str, Callable[[DataFrame], DataFrame], tuple[str, ...], tuple[str, ...]]] = {
    "video_comments": (fv.VIDEO_TOPIC, video_comments_table, ("post_id",), ("event_time_utc",)),
    "short_posts": (fv.SHORT_POST_TOPIC, short_posts_table, ("post_id",), ("event_time_utc",)),
    "air_days": (
        fv.AIR_DAILY_TOPIC, air_days_table, ("sensor_id", "parameter_id", "datetime_from_utc"), ("ingested_at_utc",),
    ),
}


# Result table -> (topic, how its rows are made).  A stream per topic reads that topic only.
TABLES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "weather": (fv.WEATHER_TOPIC, weather_table),
    "air_quality": (fv.AIR_TOPIC, air_table),
    "social_posts": (fv.VIDEO_TOPIC, social_table),
    "post_terms": (fv.VIDEO_TOPIC, post_terms_table),
    "sentiment": (fv.SENTIMENT_TOPIC, sentiment_table),
}


def start_console(
    source: Callable[[str], DataFrame], **options
) -> list[StreamingQuery]:
    """One console query per result table; `source(topic)` gives that topic's messages."""
    return [
        sinks.to_console(make(source(topic)), name, **options)
        for name, (topic, make) in TABLES.items()
    ]


def start_tables(
    source: Callable[[str], DataFrame], path: str, **options
) -> list[StreamingQuery]:
    """One query per result table, appending to folders under `path`: by city (if any) and day, terms by term."""
    started = []
    for name, (topic, make) in TABLES.items():
        rows = make(source(topic))
        if "term" in rows.columns:
            folders = ["kind", "term"]
        else:
            rows = rows.withColumn("event_date", F.to_date("event_time_utc"))
            folders = [c for c in ("city", "event_date") if c in rows.columns]
        started.append(sinks.to_files(
            rows, name, f"{path}/{name}", partition_by=folders, **options
        ))
    return started


def start_payloads(
    source: Callable[[str], DataFrame], path: str, every: int = batches.EVERY, **options
) -> list[StreamingQuery]:
    """One query per keyed table of `KEYED`, and one per topic that stores its rejects with their reason."""
    started = []
    for name, (topic, make, key, newest) in KEYED.items():
        write = sinks.keyed_writer(f"{path}/{name}", key, newest, every)
        started.append(sinks.to_batches(make(source(topic)), name, write, **options))
    for topic in shapes.SHAPES:
        started.append(sinks.to_files(
            shapes.shapeless(source(topic)), f"rejects_{topic}", f"{path}/rejects/{topic}", ["reject_reason"], **options
        ))
    return started


def read_payloads(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The current rows of a table of `KEYED`; empty before any message."""
    _, make, key, newest = KEYED[name]
    schema = make(spark.createDataFrame([], schemas.ENVELOPE)).schema.toDDL()
    return sinks.read_keyed(spark, f"{path}/{name}", schema, key, newest)


def await_any(spark: SparkSession) -> None:
    """Wait until a query ends; its failure is raised here."""
    spark.streams.awaitAnyTermination()


def weekly_means(weather: DataFrame) -> DataFrame:
    """Running weekly means of a weather stream (parsed, with its watermark)."""
    means = sliding_means(weather)
    return means.select("loc", "window.start", "window.end", "temp_7d_avg", "humidity_7d_avg")


def start_weekly_means(
    weather: DataFrame, path: str, name: str = "avg_7d", **options
) -> StreamingQuery:
    """Keep the weekly means in a keyed table.

    In update mode a batch writes only the windows it changed, and the watermark lets Spark drop the
    state of windows that can no longer change.
    """
    write = sinks.keyed_writer(path, MEANS_KEY, ("end",))
    return sinks.to_batches(weekly_means(weather), name, write, mode="update", **options)


def read_weekly_means(spark: SparkSession, path: str) -> DataFrame:
    """The current weekly means, one row per location and window."""
    rows = sinks.read_keyed(spark, path, MEANS_COLUMNS, MEANS_KEY, ("end",))
    return rows.select(
        F.struct("start", "end").alias("window"), "loc", "temp_7d_avg", "humidity_7d_avg"
    )


def running_weekly_means(spark: SparkSession, root: str, name: str = "avg_7d") -> DataFrame:
    """The weekly means as the query holds them in its state, read from its checkpoint under `root`.

    The state is read by Spark in parallel, partition by partition, as of the last finished batch; the
    query may be running or not.  Windows that the watermark has dropped are in the stored table only.
    """
    state = spark.read.format("statestore").load(f"{root}/{name}")
    sums = F.col("value").cast("struct<t:double,nt:bigint,h:double,nh:bigint>")
    return state.select("key.window", F.col("key.location").alias("loc"), sums.alias("s")).select(
        "window", "loc",
        ratio(F.col("s.t"), F.col("s.nt")).alias("temp_7d_avg"), ratio(F.col("s.h"), F.col("s.nh")).alias("humidity_7d_avg"),
    )


def start_climate_metrics(
    weather: DataFrame,
    means_path: str,
    path: str,
    name: str = "write",
    trailing: bool = True,
    **options,
) -> StreamingQuery:
    """Join each batch of readings with the means known at that time and upsert the result.

    The means are read anew for every batch.  `trailing` attaches the seven days that end with the
    reading's day; otherwise the newest window of its location.
    """
    attach = climate_metrics if trailing else with_latest_means
    write = sinks.keyed_writer(path, METRICS_KEY, ("ts_ingested",))

    def write_batch(batch: DataFrame, epoch: int) -> None:
        write(attach(batch, read_weekly_means(batch.sparkSession, means_path)), epoch)

    return sinks.to_batches(weather, name, write_batch, **options)


def start_corrected_metrics(weather: DataFrame, path: str, name: str = "corrected", **options) -> StreamingQuery:
    """Keep readings with their weekly means right also where later readings change these.

    The means come from the state of this query, so no other table is read.
    """
    write = sinks.keyed_writer(path, METRICS_KEY, ("ts_ingested", "temperature", "humidity", "precipitation"))

    def write_batch(batch: DataFrame, epoch: int) -> None:
        write(batch.withColumn("ts_ingested", F.current_timestamp()), epoch)

    return sinks.to_batches(corrected_metrics(weather), name, write_batch, mode="update", **options)


def read_climate_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The current readings, one row per location and time."""
    return sinks.read_keyed(spark, path, schemas.CLIMATE_METRICS, METRICS_KEY, ("ts_ingested",))


def _in_city(rows: DataFrame) -> DataFrame:
    """Rows of a table that has no city, which are those of the one we watch."""
    return rows if "city" in rows.columns else rows.withColumn("city", F.lit(fv.CITY))


# Kind of partial rows -> (result table, how its rows become partial rows).
_DAILY: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "weather": ("weather", daily.weather_partials),
    "air": ("air_quality", daily.air_partials),
    "posts": ("social_posts", daily.post_partials),
    "sentiment": ("sentiment", lambda rows: daily.sentiment_partials(
        rows.withColumnRenamed("sentiment_score", "sentiment_confidence_pct")
    )),
}


def start_daily(
    source: Callable[[str], DataFrame], path: str, every: int = batches.EVERY, **options
) -> list[StreamingQuery]:
    """Keep partial sums per day and city, one query and folder per kind; late rows add to their day."""
    started = []
    for kind, (table, partials) in _DAILY.items():
        topic, make = TABLES[table]
        write = sinks.sums_writer(f"{path}/{kind}", partials, daily.merged_partials, every)
        started.append(sinks.to_batches(_in_city(make(source(topic))), f"daily_{kind}", write, **options))
    return started


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """The daily aggregates of all batches so far."""
    parts = {}
    for kind, (table, partials) in _DAILY.items():
        # The schema follows from the operators, so a table without a batch reads as empty.
        empty = partials(_in_city(TABLES[table][1](spark.createDataFrame([], schemas.ENVELOPE))))
        parts[kind] = batches.read_batches(spark, f"{path}/{kind}", empty.schema.toDDL())
    return daily.daily_from_partials(parts["weather"], parts["air"], parts["posts"], parts["sentiment"])
