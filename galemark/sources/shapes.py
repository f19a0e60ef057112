"""Several payloads on one topic, told apart by the fields that they have.

A message is parsed once as a VARIANT; its shape is the first of its topic's shapes whose fields it
has all (also with null in them).  What has no shape is a reject and says why.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from galemark import fixed_values as fv

NOT_JSON, UNKNOWN = "not json", "unknown shape"

POST, VIDEO_COMMENT, SHORT_POST = "post", "video_comment", "short_post"
AIR_DAY, AIR_READING, AIR_LIST = "air_day", "air_reading", "air_list"

#: Topic -> its shapes, as (name, fields that tell it), in the order in which they are tried.
SHAPES: dict[str, Sequence[tuple[str, Sequence[str]]]] = {
    fv.VIDEO_TOPIC: ((VIDEO_COMMENT, ("video_id", "published_at")), (POST, ("id", "timestamp"))),
    fv.SHORT_POST_TOPIC: ((SHORT_POST, ("platform", "id", "text")),),
    fv.AIR_TOPIC: ((AIR_LIST, ("measurements",)), (AIR_READING, ("parameter", "value"))),
    fv.AIR_DAILY_TOPIC: ((AIR_DAY, ("sensor_id", "datetime_from_utc")),),
    fv.WEATHER_TOPIC: (("weather", ("location", "timestamp_utc")),),
    fv.SENTIMENT_TOPIC: (("sentiment", ("post_id", "sentiment_label")),),
    fv.POSTS_TOPIC: (("forum_post", ("id", "title")),),
    fv.COMMENTS_TOPIC: (("forum_comment", ("id", "post_id")),),
}


def _shape(body: Column, shapes: Sequence[tuple[str, Sequence[str]]]) -> Column:
    found = F.lit(None).cast("string")
    for name, fields in reversed(shapes):
        # A field with a JSON null is there: its variant is not an SQL null.
        has = [F.try_variant_get(body, f"$.{field}", "variant").isNotNull() for field in fields]
        every = has[0]
        for one in has[1:]:
            every &= one
        found = F.when(every, F.lit(name)).otherwise(found)
    return found


def with_shape(envelope: DataFrame) -> DataFrame:
    """Messages with their `shape` and, where that is null, a `reject_reason`.

    Works on batches and streams.  Topics without listed shapes have UNKNOWN ones only.  A null value
    is not JSON.  The variant lives inside a generator, so it is made once per message.
    """
    body = F.try_parse_json(F.col("value").cast("string"))
    seen = envelope.select("*", F.inline(F.array(F.struct(body.alias("_body")))))
    shape = F.lit(None).cast("string")
    for topic, shapes in SHAPES.items():
        shape = F.when(F.col("topic") == topic, _shape(F.col("_body"), shapes)).otherwise(shape)
    reason = F.when(F.col("_body").isNull(), NOT_JSON).when(F.col("shape").isNull(), UNKNOWN)
    return seen.withColumn("shape", shape).withColumn("reject_reason", reason).drop("_body")


def of_shape(envelope: DataFrame, topic: str, shape: str) -> DataFrame:
    """The messages of `topic` with that shape, as an envelope."""
    return with_shape(envelope.filter(F.col("topic") == topic)).filter(F.col("shape") == shape).select(envelope.columns)


def shapeless(envelope: DataFrame) -> DataFrame:
    """The rejects: messages that no parser takes, as text, with the reason."""
    rows = with_shape(envelope).filter(F.col("shape").isNull())
    return rows.select(
        "topic", "reject_reason", F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"), F.col("timestamp").alias("kafka_timestamp"),
    )
