"""The pipeline's messages and tables, derived from the given tables.

Each method is a whole-table view: every row of the source table gives its row(s).  Weather readings
use steps of 1/16 degree and 1/8 m/s, so that sums are exact whatever the order of addition.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from galemark import fixed_values as fv
from galemark.functions.text import parent_id
from galemark.operators import clean, enrich, shape
from galemark.operators.aggregate import cycle_throughput
from galemark.operators.daily import daily_aggregates
from galemark.sources import envelope as env

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Terms and places looked for in the given texts; both lists also hold the default entries.
TERMS = (*fv.SEARCH_TERMS, "Then", "that", "lean", "Keit")
REGIONS = (*fv.PLACES, "Anes", "Edin", "Lean", "Teen")
POST_KEYWORDS = ("thou", "Nicht", "para")


def _iso(column: str = "ts"):
    return F.date_format(column, ISO)


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")

    @cached_property
    def pages(self) -> DataFrame:
        return self.table("pages")

    @cached_property
    def events(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").withColumn("k", k)

    # Messages as their producers write them.

    @cached_property
    def weather_raw(self) -> DataFrame:
        return self._weather_rows(self.events)

    @staticmethod
    def _weather_rows(events: DataFrame) -> DataFrame:
        return events.select(
            F.expr(
                "CASE event_type WHEN 'click' THEN ' Boston, USA' WHEN 'view' THEN 'North BOSTON ' "
                "WHEN 'purchase' THEN 'Cambridge' WHEN 'error' THEN 'boston' END"
            ).alias("location"),
            _iso().alias("timestamp_utc"),
            (F.floor(F.col("value") * 4) / F.lit(16.0) - 25).alias("temperature"),
            F.expr("CAST(event_id % 101 AS DOUBLE)").alias("humidity"),
            (F.col("k") * F.lit(0.75)).alias("precipitation"),
            F.expr("event_id % 100").alias("weather_code"),
            F.expr("CASE WHEN event_id % 50 <> 0 THEN (event_id % 180) / 8D END").alias("wind_speed"),
            F.col("ts").alias("at"),
        )

    @cached_property
    def air_raw(self) -> DataFrame:
        return self._air_rows(self.events)

    @staticmethod
    def _air_rows(events: DataFrame) -> DataFrame:
        return events.select(
            F.expr("CASE WHEN event_id % 3 <> 0 THEN 'North Boston' END").alias("location"),
            F.expr(
                "CASE event_id % 5 WHEN 0 THEN ' PM25' WHEN 1 THEN 'pm10 ' WHEN 2 THEN 'O3' "
                "WHEN 3 THEN 'no2' END"
            ).alias("parameter"),
            "value",
            F.lit("ug/m3").alias("unit"),
            _iso().alias("timestamp_utc"),
            F.expr("42.25D + (event_id % 64) / 256D").alias("latitude"),
            F.expr("-71.25D + (event_id % 32) / 128D").alias("longitude"),
            F.expr("CASE WHEN event_id % 7 <> 0 THEN 'Boston' END").alias("city"),
            F.lit("US").alias("country"),
            F.col("ts").alias("at"),
        )

    @cached_property
    def social_raw(self) -> DataFrame:
        return self.documents.select(
            F.col("doc_id").cast("string").alias("id"),
            F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
            F.concat(F.lit(" "), F.upper("source"), F.lit(" ")).alias("author"),
            F.col("text").alias("body"),
            "source",
            F.expr("CASE WHEN doc_id % 17 <> 0 THEN n_chars END").alias("upvotes"),
            F.expr("1704067200000 + (doc_id % 30) * 86400000 + doc_id * 60000").alias("timestamp"),
            F.concat(F.lit("https://example.org/"), F.col("doc_id")).alias("url"),
        ).withColumn("at", F.timestamp_millis("timestamp"))

    @cached_property
    def sentiment_raw(self) -> DataFrame:
        at = F.expr("timestamp_millis(1704067200000 + (doc_id % 30) * 86400000 + doc_id * 60000)")
        return self.table("labels").withColumn("at", at).select(
            F.col("doc_id").cast("string").alias("post_id"),
            F.expr("CASE WHEN doc_id % 11 <> 0 THEN (doc_id % 100) / 100D END").alias("sentiment_score"),
            F.expr(
                "CASE WHEN toxic = 1 THEN ' Negative' WHEN quality = 1 THEN 'Positive ' "
                "WHEN doc_id % 2 = 0 THEN 'NEUTRAL' END"
            ).alias("sentiment_label"),
            _iso("at").alias("timestamp_utc"),
            "at",
        )

    @cached_property
    def forum_posts_raw(self) -> DataFrame:
        """Every opening turn."""
        opening = self.table("conversations").filter("turn = 0")
        return opening.select(
            F.col("conv_id").cast("string").alias("id"),
            F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
            F.expr("CASE WHEN conv_id % 5 <> 0 THEN concat('user_', conv_id) END").alias("author"),
            F.col("text").alias("selftext"),
            F.expr("concat('r', conv_id % 4)").alias("subreddit"),
            F.length("text").cast("bigint").alias("upvotes"),
            F.expr("conv_id % 3").alias("downvotes"),
            F.expr("conv_id % 10 = 0").alias("over_18"),
            F.expr("1704067200D + conv_id * 3600 + 0.5D").alias("timestamp"),
            F.expr("concat('/r/', conv_id)").alias("permalink"),
        ).withColumn("at", F.timestamp_seconds("timestamp"))

    @cached_property
    def forum_comments_raw(self) -> DataFrame:
        """Every later turn; those of each 13th thread name a post that does not exist."""
        replies = self.table("conversations").filter("turn > 0")
        link = F.expr("CASE WHEN conv_id % 13 = 0 THEN concat('t3_x', conv_id) ELSE concat('t3_', conv_id) END")
        return replies.select(
            F.expr("concat(conv_id, '-', turn)").alias("id"),
            F.expr("concat('t1_', conv_id, '-', turn)").alias("name"),
            F.col("role").alias("author"),
            F.col("text").alias("body"),
            F.expr("concat('r', conv_id % 4)").alias("subreddit"),
            F.length("text").cast("bigint").alias("upvotes"),
            F.expr("turn % 3").alias("downvotes"),
            F.lit(False).alias("over_18"),
            F.expr("1704067200D + conv_id * 3600 + turn * 60 + 0.25D").alias("timestamp"),
            F.expr("concat('/r/', conv_id, '/', turn)").alias("permalink"),
            parent_id(link).alias("post_id"),
        ).withColumn("at", F.timestamp_seconds("timestamp"))

    @cached_property
    def short_posts_raw(self) -> DataFrame:
        """Short posts; the word after each full stop is a hashtag."""
        text = F.replace(F.col("text"), F.lit(". "), F.lit(". #"))
        return self.documents.select(
            F.lit("x").alias("platform"),
            F.concat(F.lit("x"), F.col("doc_id")).alias("id"),
            text.alias("text"),
            F.date_format(F.expr("timestamp_seconds(1704067200 + doc_id * 60)"), ISO).alias("timestamp_utc"),
            F.concat(F.lit("user_"), F.col("source")).alias("user"),
            F.lit("Boston").alias("location"),
        )

    @cached_property
    def log_records(self) -> DataFrame:
        return self._log_rows(self.events)

    @staticmethod
    def _log_rows(events: DataFrame) -> DataFrame:
        rows = events.select(
            _iso().alias("ts_utc"),
            F.expr(
                "CASE event_id % 4 WHEN 0 THEN 'weather_ingest' WHEN 1 THEN 'air_ingest' "
                "WHEN 2 THEN 'youtube_ingest' ELSE 'spark_processor' END"
            ).alias("component"),
            F.expr(
                "CASE event_id % 3 WHEN 0 THEN 'send_success' WHEN 1 THEN 'cycle_complete' "
                "ELSE 'cycle_begin' END"
            ).alias("event"),
            F.col("event_type").alias("stream"),
            F.col("event_id").alias("cycle"),
            F.expr("CASE WHEN event_id % 25 = 0 THEN 0D ELSE value / 10 END").alias("elapsed_sec"),
            F.col("k").cast("bigint").alias("records_sent"),
            F.lit(300).cast("bigint").alias("sleep_sec"),
            F.col("ts").cast("timestamp").alias("ts"),
        )
        return cycle_throughput(rows)

    @cached_property
    def log_lines(self) -> DataFrame:
        """One JSON object per record, plus records of a component that no panel shows."""
        shown = self._log_rows(self.events)
        rows = shown.unionByName(shown.withColumn("component", F.lit("x_ingest")))
        return rows.select(F.to_json(F.struct(*(c for c in rows.columns if c != "ts"))).alias("value"))

    # Envelopes and what the parsers make of them.

    def messages(self, topic: str) -> DataFrame:
        """The messages of one topic."""
        rows, key = {
            fv.WEATHER_TOPIC: lambda: (self._weather_rows(self.events), "location"),
            fv.AIR_TOPIC: lambda: (self._air_rows(self.events), "location"),
            fv.VIDEO_TOPIC: lambda: (self.social_raw, "id"),
            fv.SENTIMENT_TOPIC: lambda: (self.sentiment_raw, "post_id"),
            fv.POSTS_TOPIC: lambda: (self.forum_posts_raw, "id"),
            fv.COMMENTS_TOPIC: lambda: (self.forum_comments_raw, "id"),
        }[topic]()
        return env.to_envelope(rows, topic, key, "at")

    @cached_property
    def envelope(self) -> DataFrame:
        """The messages of all topics in one frame."""
        return shape.union_sources(*map(self.messages, fv.ALL_TOPICS))

    @staticmethod
    def _typed(raw: DataFrame, topic: str) -> DataFrame:
        """The parser's result without the detour over JSON text."""
        at = F.col("at").cast("timestamp")
        return raw.withColumns({
            "kafka_timestamp": at,
            "event_time": at,
            "source_topic": F.lit(topic),
            "ingestion_time": F.current_timestamp(),
            "is_valid": F.lit(True),
        }).drop("at")

    @cached_property
    def weather_parsed(self) -> DataFrame:
        return self._typed(self.weather_raw, fv.WEATHER_TOPIC)

    @cached_property
    def air_parsed(self) -> DataFrame:
        return self._typed(self.air_raw, fv.AIR_TOPIC)

    @cached_property
    def social_parsed(self) -> DataFrame:
        return self._typed(self.social_raw, fv.VIDEO_TOPIC)

    @cached_property
    def sentiment_parsed(self) -> DataFrame:
        return self._typed(self.sentiment_raw, fv.SENTIMENT_TOPIC)

    # Stored tables.

    @cached_property
    def weather(self) -> DataFrame:
        return enrich.enrich_weather(clean.clean_weather(self.weather_parsed))

    @cached_property
    def air(self) -> DataFrame:
        rows = enrich.enrich_air(clean.clean_air(self.air_parsed))
        return rows.withColumnRenamed("value_standard_unit", "value")

    @cached_property
    def untagged_posts(self) -> DataFrame:
        """Stored posts; the source is the one the post names."""
        social = self.social_parsed.withColumn("source_topic", F.col("source"))
        clean_posts = clean.clean_social(social)
        return clean_posts.withColumnsRenamed({"id": "post_id", "source_topic": "source"})

    @cached_property
    def posts(self) -> DataFrame:
        """Stored posts with their keywords and places."""
        return enrich.tag_posts(self.untagged_posts, TERMS, REGIONS)

    @cached_property
    def votes(self) -> DataFrame:
        return self.social_raw.select(F.col("id").alias("post_id"), "upvotes")

    @cached_property
    def sentiment(self) -> DataFrame:
        """Stored sentiment with the confidence as it is known (null where unknown)."""
        rows = clean.clean_sentiment(self.sentiment_parsed)
        return rows.withColumnRenamed("sentiment_score", "sentiment_confidence_pct")

    @cached_property
    def daily(self) -> DataFrame:
        here = F.lit(fv.CITY)
        return daily_aggregates(
            self.weather,
            self.air,
            self.social_parsed.select(
                F.col("id").alias("post_id"), F.col("event_time").alias("event_time_utc"),
                here.alias("city"),
            ),
            self.sentiment.withColumn("city", here),
        )

    # Nested payloads, one message per row of the source table.

    @cached_property
    def sensor_locations(self) -> DataFrame:
        """A location per customer with 0 to 3 sensors; some names and coordinates are missing."""
        rows = self.table("customer")
        sensor = F.expr(
            "transform(slice(array(0, 1, 2), 1, CAST(c_custkey % 4 AS INT)), i -> named_struct("
            "'id', c_custkey * 3 + i, 'parameter', CASE WHEN (c_custkey + i) % 11 <> 0 THEN "
            "named_struct('name', CASE i WHEN 0 THEN 'pm25' WHEN 1 THEN 'o3' END, "
            "'units', CASE WHEN i < 2 THEN 'ug/m3' END, "
            "'displayName', CASE WHEN i = 0 THEN 'PM2.5' END) END))"
        )
        return rows.select(
            F.col("c_custkey").alias("id"),
            F.expr("CASE WHEN c_custkey % 6 <> 0 THEN c_name END").alias("name"),
            F.expr(
                "CASE WHEN c_custkey % 10 <> 0 THEN named_struct("
                "'latitude', 42.3601D + ((c_custkey % 200) - 100) / 256D, "
                "'longitude', -71.0589D + ((c_custkey % 320) - 160) / 256D) END"
            ).alias("coordinates"),
            sensor.alias("sensors"),
        )

    @cached_property
    def sensors(self) -> DataFrame:
        return shape.flatten_sensors(self.sensor_locations)

    @cached_property
    def measurements(self) -> DataFrame:
        return self.events.select(
            F.col("user_id").alias("sensor_id"),
            F.col("ts").cast("timestamp").alias("event_time"),
            "value",
        )

    @cached_property
    def daily_responses(self) -> DataFrame:
        """A response per event with a full and a bare measurement."""
        full = F.expr(
            "named_struct('value', value, "
            "'parameter', named_struct('id', event_id % 6, 'name', event_type, 'units', 'ppm', "
            "'displayName', upper(event_type)), "
            "'flagInfo', CASE WHEN event_id % 4 = 0 THEN named_struct('hasFlags', true) END, "
            "'period', named_struct('label', 'raw', 'interval', '24:00:00', "
            f"'datetimeFrom', named_struct('utc', date_format(ts, \"{ISO}\"), 'local', "
            f"date_format(ts - INTERVAL 5 HOURS, \"{ISO}\")), "
            "'datetimeTo', CAST(NULL AS STRUCT<utc: STRING, local: STRING>)), "
            "'summary', CASE WHEN event_id % 9 <> 0 THEN named_struct('min', value - 1, 'q02', "
            "value - 0.75D, 'q25', value - 0.5D, 'median', value, 'q75', value + 0.5D, 'q98', "
            "value + 0.75D, 'max', value + 1, 'avg', value, 'sd', 0.5D) END, "
            "'coverage', named_struct('expectedCount', 24, 'expectedInterval', '24:00:00', "
            "'observedCount', event_id % 25, 'observedInterval', '20:00:00', 'percentComplete', "
            "CAST(event_id % 101 AS DOUBLE), 'percentCoverage', CAST(event_id % 99 AS DOUBLE), "
            f"'datetimeFrom', named_struct('utc', date_format(ts, \"{ISO}\"))))"
        )
        bare = F.struct((F.col("value") / 2).alias("value"))
        return self.events.select(F.format_string(
            '{"sensor_id":%d,"results":[%s,%s]}', "user_id", F.to_json(full), F.to_json(bare)
        ).alias("value"))

    @cached_property
    def measurement_lists(self) -> DataFrame:
        """A list message per event with two entries."""
        entry = (
            "named_struct('sensor_id', concat('s', user_id), 'location_id', event_id % 8, "
            "'location_name', 'Downtown', 'parameter_name', event_type, 'parameter_units', 'ug/m3', "
            f"'value', {{value}}, 'datetime_utc', date_format(ts, \"{ISO}\"), 'latitude', 42.25D, "
            "'longitude', -71.25D, 'source', 'station')"
        )
        entries = f"array({entry.format(value='value')}, {entry.format(value='value + 1')})"
        return self.events.select(F.to_json(F.struct(
            F.lit("Boston").alias("city"),
            F.lit("42.3601,-71.0589").alias("coordinates"),
            _iso().alias("timestamp_utc"),
            F.lit(2).alias("measure_count"),
            F.expr(entries).alias("measurements"),
        )).alias("value"))

    @cached_property
    def forecasts(self) -> DataFrame:
        """An hourly forecast per event; one kind lacks the last hour of one array, one has none."""
        hourly = F.expr(
            "named_struct('temperature_2m', array(value, value + 1, value + 2), "
            "'relativehumidity_2m', array(CAST(k AS DOUBLE), k + 1D, k + 2D), "
            "'precipitation', CASE event_type WHEN 'error' THEN array() "
            "WHEN 'view' THEN array(0D, k * 0.5D) ELSE array(0D, k * 0.5D, k * 1D) END, "
            "'weathercode', array(event_id % 100, event_id % 50, event_id % 25), "
            "'windspeed_10m', array(value / 8, value / 4, value / 2))"
        )
        return self.events.select(F.to_json(F.struct(
            F.concat(F.lit("station "), F.col("user_id")).alias("location"),
            _iso().alias("timestamp_utc"),
            hourly.alias("hourly"),
        )).alias("value"))

    @cached_property
    def comment_pages(self) -> DataFrame:
        """A page per turn with a full and an anonymous comment."""
        item = (
            "named_struct('snippet', named_struct('topLevelComment', named_struct('snippet', "
            "named_struct('authorDisplayName', {author}, 'textDisplay', text, 'publishedAt', "
            "'2024-01-01T00:00:00'))))"
        )
        items = ", ".join(item.format(author=a) for a in ("role", "CAST(NULL AS STRING)"))
        return self.table("conversations").select(F.to_json(F.struct(
            F.concat(F.lit("v"), F.col("conv_id")).alias("video_id"),
            F.col("turn").alias("cycle"),
            F.expr(f"array({items})").alias("items"),
        )).alias("value"))
