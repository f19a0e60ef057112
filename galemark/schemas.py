"""Schemas as DDL text.  Field names and types of the messages and tables are fixed values."""

ENVELOPE = "topic string, key binary, value binary, timestamp timestamp"

# Message schemas.
WEATHER = (
    "location string, timestamp_utc string, temperature double, humidity double, "
    "precipitation double, weather_code bigint, wind_speed double"
)
AIR = (
    "location string, parameter string, value double, unit string, timestamp_utc string, "
    "latitude double, longitude double, city string, country string"
)
SOCIAL = (
    "id string, title string, author string, body string, source string, upvotes bigint, "
    "timestamp bigint, url string"
)
SENTIMENT = (
    "post_id string, sentiment_score double, sentiment_label string, timestamp_utc string"
)
# Post times arrive as fractional epoch seconds, so they are read as double.
POSTS = (
    "id string, title string, author string, selftext string, subreddit string, "
    "upvotes bigint, downvotes bigint, over_18 boolean, timestamp double, permalink string"
)
COMMENTS = (
    "id string, name string, author string, body string, subreddit string, upvotes bigint, "
    "downvotes bigint, over_18 boolean, timestamp double, permalink string, post_id string"
)
VIDEO_COMMENT = (
    "video_id string, author string, text string, published_at string, cycle bigint"
)
SHORT_POST = (
    "platform string, id string, text string, timestamp_utc string, user string, "
    "location string, hashtags array<string>"
)

AIR_DAY = (
    "sensor_id bigint, location_id bigint, location_name string, parameter_id bigint, "
    "parameter_name string, parameter_units string, parameter_display string, value double, "
    "has_flags boolean, period_label string, period_interval string, datetime_from_utc string, "
    "datetime_from_local string, datetime_to_utc string, datetime_to_local string, "
    "latitude double, longitude double, summary_min double, summary_q02 double, "
    "summary_q25 double, summary_median double, summary_q75 double, summary_q98 double, "
    "summary_max double, summary_avg double, summary_sd double, coverage_expected_count bigint, "
    "coverage_expected_interval string, coverage_observed_count bigint, "
    "coverage_observed_interval string, coverage_percent_complete double, "
    "coverage_percent_coverage double, coverage_datetime_from_utc string, "
    "coverage_datetime_to_utc string, ingested_at_utc string"
)

# Nested payloads.
SENSOR_LOCATION = (
    "id bigint, name string, coordinates struct<latitude: double, longitude: double>, "
    "sensors array<struct<id: bigint, "
    "parameter: struct<name: string, units: string, displayName: string>>>"
)
DAILY_RESPONSE = (
    "sensor_id bigint, results array<struct<"
    "value: double, "
    "parameter: struct<id: bigint, name: string, units: string, displayName: string>, "
    "flagInfo: struct<hasFlags: boolean>, "
    "period: struct<label: string, `interval`: string, "
    "datetimeFrom: struct<utc: string, local: string>, "
    "datetimeTo: struct<utc: string, local: string>>, "
    "summary: struct<min: double, q02: double, q25: double, median: double, q75: double, "
    "q98: double, max: double, avg: double, sd: double>, "
    "coverage: struct<expectedCount: bigint, expectedInterval: string, observedCount: bigint, "
    "observedInterval: string, percentComplete: double, percentCoverage: double, "
    "datetimeFrom: struct<utc: string>, datetimeTo: struct<utc: string>>>>"
)
MEASUREMENT_LIST = (
    "city string, coordinates string, timestamp_utc string, measure_count bigint, "
    "measurements array<struct<sensor_id: string, location_id: bigint, location_name: string, "
    "parameter_name: string, parameter_units: string, value: double, datetime_utc: string, "
    "latitude: double, longitude: double, source: string>>"
)
HOURLY_WEATHER = (
    "location string, timestamp_utc string, hourly struct<temperature_2m: array<double>, "
    "relativehumidity_2m: array<double>, precipitation: array<double>, "
    "weathercode: array<bigint>, windspeed_10m: array<double>>"
)
COMMENT_PAGE = (
    "video_id string, cycle bigint, items array<struct<snippet: struct<topLevelComment: "
    "struct<snippet: struct<authorDisplayName: string, textDisplay: string, "
    "publishedAt: string>>>>>"
)

# Structured log records.
LOG = (
    "ts_utc string, component string, event string, stream string, cycle bigint, "
    "elapsed_sec double, records_sent bigint, throughput_rps double, sleep_sec bigint"
)
# Log records of streams (ours): rows that were rejected, and how far the newest event lies back.
HEALTH = f"{LOG}, rejects bigint, not_json bigint, unknown_shape bigint, lag_sec double"

# Keyed table of readings with their weekly means, key (location, window_ts).
CLIMATE_METRICS = (
    "location string, window_ts timestamp, temperature double, humidity double, "
    "precipitation double, temp_7d_avg double, humidity_7d_avg double, ts_ingested timestamp"
)
WEEKLY_MEANS = (
    "window struct<start: timestamp, end: timestamp>, loc string, temp_7d_avg double, "
    "humidity_7d_avg double"
)
