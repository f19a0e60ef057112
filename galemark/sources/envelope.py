"""Message envelopes (topic, key, value, broker time) and the typed streams inside them.

An envelope frame may be a batch or a stream; every function here works on both.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from galemark import fixed_values as fv, schemas
from galemark.functions.jsons import expand

CORRUPT = "_corrupt_record"

#: First and last second of the years 1 to 9999.
EPOCH_SECONDS = (-62135596800, 253402300799)


def kafka_envelope(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str] = fv.CORE_TOPICS,
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    **options: str,
) -> DataFrame:
    """Stream of `topics` from Kafka (needs the Kafka connector on the classpath).

    Spark does not push a topic filter into the source, so a query that wants one topic should
    subscribe to that one only.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .options(**options)
    )
    return reader.load().select("topic", "key", "value", "timestamp")


def file_envelope(
    spark: SparkSession,
    path: str,
    topics: Sequence[str] | None = None,
    streaming: bool = True,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The same columns from landed parquet files.

    Folders named `topic=...` are pruned by the topic filter before any file is opened.
    """
    reader = (spark.readStream if streaming else spark.read).schema(schemas.ENVELOPE)
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    frame = reader.parquet(path).select("topic", "key", "value", "timestamp")
    return frame.filter(F.col("topic").isin(*topics)) if topics else frame


def to_envelope(df: DataFrame, topic: str, key: str | None, time: str) -> DataFrame:
    """Rows as JSON messages keyed by column `key`, without the broker time column `time`."""
    body = [c for c in df.columns if c != time]
    return df.select(
        F.lit(topic).alias("topic"),
        (F.col(key).cast("string") if key else F.lit(None).cast("string"))
        .cast("binary").alias("key"),
        F.to_json(F.struct(*body)).cast("binary").alias("value"),
        F.col(time).cast("timestamp").alias("timestamp"),
    )


def demux(envelope: DataFrame, topic: str) -> DataFrame:
    """Messages of one topic."""
    return envelope.filter(F.col("topic") == topic)


def iso_time(name: str = "timestamp_utc") -> Callable[[], Column]:
    """Event time written as ISO-8601 text; unreadable text gives null."""
    return lambda: F.try_to_timestamp(F.col(name))


def epoch_millis(name: str = "timestamp") -> Callable[[], Column]:
    """Event time written as epoch milliseconds; null outside the years 1 to 9999."""
    low, high = EPOCH_SECONDS
    return lambda: F.timestamp_millis(F.when(F.col(name).between(low * 1000, high * 1000 + 999), F.col(name)))


def epoch_seconds(name: str = "timestamp") -> Callable[[], Column]:
    """Event time written as (fractional) epoch seconds; null outside the years 1 to 9999."""
    return lambda: F.timestamp_seconds(F.when(F.col(name).between(*EPOCH_SECONDS), F.col(name)))


def parse(
    envelope: DataFrame,
    topic: str,
    schema: str,
    event_time: Callable[[], Column],
    strict: bool = False,
    watermark: str | None = fv.LATENESS,
) -> DataFrame:
    """Typed rows of one topic.

    Adds `kafka_timestamp`, `event_time`, `source_topic`, `ingestion_time` and `is_valid`, and sets
    the watermark on a stream.  `is_valid` is always true; with `strict` it is true only where the
    value is JSON and has an event time, and `reject_reason` says what is missing.
    """
    wanted = f"{schema}, {CORRUPT} string" if strict else schema
    broker_time = F.col("timestamp").alias("kafka_timestamp")
    typed = expand(demux(envelope, topic), "value", wanted, broker_time).withColumns({
        "event_time": event_time(),
        "source_topic": F.lit(topic),
        "ingestion_time": F.current_timestamp(),
    })
    if strict:
        reason = (
            F.when(F.col(CORRUPT).isNotNull(), "not json")
            .when(F.col("event_time").isNull(), "no event time")
        )
        typed = typed.withColumn("reject_reason", reason)
        typed = typed.withColumn("is_valid", F.col("reject_reason").isNull())
    else:
        typed = typed.withColumn("is_valid", F.lit(True))
    return typed.withWatermark("event_time", watermark) if watermark else typed


def parse_weather(envelope: DataFrame, **options) -> DataFrame:
    return parse(envelope, fv.WEATHER_TOPIC, schemas.WEATHER, iso_time(), **options)


def parse_air(envelope: DataFrame, **options) -> DataFrame:
    return parse(envelope, fv.AIR_TOPIC, schemas.AIR, iso_time(), **options)


def parse_social(envelope: DataFrame, **options) -> DataFrame:
    return parse(envelope, fv.VIDEO_TOPIC, schemas.SOCIAL, epoch_millis(), **options)


def parse_sentiment(envelope: DataFrame, **options) -> DataFrame:
    return parse(envelope, fv.SENTIMENT_TOPIC, schemas.SENTIMENT, iso_time(), **options)


def parse_posts(envelope: DataFrame, **options) -> DataFrame:
    return parse(envelope, fv.POSTS_TOPIC, schemas.POSTS, epoch_seconds(), **options)


def parse_comments(envelope: DataFrame, **options) -> DataFrame:
    return parse(envelope, fv.COMMENTS_TOPIC, schemas.COMMENTS, epoch_seconds(), **options)


def parse_video_comments(envelope: DataFrame, **options) -> DataFrame:
    """Video comments in the layout their producer writes, as social rows.

    Their fields differ from the social message's: the text becomes the body and the publication
    time the event time.
    """
    rows = parse(
        envelope, fv.VIDEO_TOPIC, schemas.VIDEO_COMMENT, iso_time("published_at"), **options
    )
    return rows.withColumnRenamed("text", "body")


def parse_short_posts(envelope: DataFrame, **options) -> DataFrame:
    """Short posts as social rows: the text becomes the body, the user the author, the platform the source."""
    rows = parse(envelope, fv.SHORT_POST_TOPIC, schemas.SHORT_POST, iso_time(), **options)
    return rows.withColumnsRenamed({"text": "body", "user": "author", "platform": "source"})


def parse_air_days(envelope: DataFrame, **options) -> DataFrame:
    """Daily measurements of sensors; their event time is the day's begin."""
    return parse(envelope, fv.AIR_DAILY_TOPIC, schemas.AIR_DAY, iso_time("datetime_from_utc"), **options)


def rejects(parsed: DataFrame) -> DataFrame:
    """Side output of a strict parse: the rows that are not valid."""
    return parsed.filter(~F.col("is_valid"))
