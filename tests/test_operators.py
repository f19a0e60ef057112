"""Operators against hand-made rows and brute force."""

import json
import random
import re
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from galemark import schemas
from galemark.operators import (
    aggregate, classify, clean, daily, enrich, joins, logs, quantiles, serve, shape, windows,
)
from galemark.sources import envelope as env, tables
from galemark.sources.logs import read_logs, scan_logs

T0 = datetime(2024, 3, 1, tzinfo=timezone.utc)


def naive(t):
    return t.replace(tzinfo=None)


def messages(spark, topic, bodies):
    rows = [(topic, None, bytearray(b if isinstance(b, bytes) else json.dumps(b).encode()), T0) for b in bodies]
    return spark.createDataFrame(rows, schemas.ENVELOPE)


# Parsing.


def test_lenient_parse_keeps_every_row(spark):
    sent = messages(spark, "weather_raw", [
        {"location": "Boston", "timestamp_utc": "2024-03-01T05:06:07.5", "temperature": 1, "extra": 2},
        {"location": 7, "timestamp_utc": "garbage", "temperature": "warm"},
        b"not json", b"",
    ])
    rows = env.parse_weather(sent).collect()
    assert len(rows) == 4 and all(r["is_valid"] for r in rows)
    assert rows[0]["event_time"] == datetime(2024, 3, 1, 5, 6, 7, 500000) and rows[0]["temperature"] == 1.0
    assert (rows[1]["location"], rows[1]["temperature"], rows[1]["event_time"]) == ("7", None, None)
    assert rows[2]["location"] is None and rows[2]["source_topic"] == "weather_raw"


def test_strict_parse_names_the_reason(spark):
    sent = messages(spark, "weather_raw", [
        {"location": "Boston", "timestamp_utc": "2024-03-01T05:06:07+00:00"},
        {"location": "Boston", "timestamp_utc": "garbage"}, b"{\"location\": \"x\"",
    ])
    parsed = env.parse_weather(sent, strict=True)
    assert clean.valid_rows(parsed).count() == 1
    assert sorted(r["reject_reason"] for r in env.rejects(parsed).collect()) == ["no event time", "not json"]


def test_other_time_formats(spark):
    social = env.parse_social(messages(spark, "youtube_raw", [{"id": "a", "timestamp": 1709251200123}]))
    assert social.first()["event_time"] == datetime(2024, 3, 1, 0, 0, 0, 123000)
    post = env.parse_posts(messages(spark, "reddit_posts", [{"id": "a", "timestamp": 1709251200.5}]))
    assert post.first()["event_time"] == datetime(2024, 3, 1, 0, 0, 0, 500000)
    video = env.parse_video_comments(messages(spark, "youtube_raw", [
        {"video_id": "v", "author": "a", "text": "hi", "published_at": "2024-03-01T00:00:00Z", "cycle": 1}]))
    row = video.first()
    assert row["body"] == "hi" and row["event_time"] == naive(T0)


def test_air_needs_city_or_location(spark):
    sent = messages(spark, "air_raw", [
        {"city": None, "location": "North Boston", "value": 1}, {"city": "BOSTON", "value": 2},
        {"city": "Lynn", "location": "Lynn", "value": 3}, {"value": 4},
    ])
    rows = clean.clean_air(env.parse_air(sent)).collect()
    assert sorted(r["value_standard_unit"] for r in rows) == [1.0, 2.0]
    assert {(r["city"], r["region"], r["country"]) for r in rows} == {("boston", "massachusetts", "usa")}


# Payloads.


def test_sensor_defaults(spark):
    body = [
        {"id": 1, "name": "A", "coordinates": {"latitude": 1.5, "longitude": 2.5},
         "sensors": [{"id": 10, "parameter": {"name": "pm25", "units": "u", "displayName": "PM"}},
                     {"id": 11, "parameter": {"name": "o3"}}, {"id": 12}]},
        {"id": 2, "sensors": [{"id": 20}]}, {"id": 3, "name": "C", "sensors": []}, {"id": 4},
    ]
    rows = shape.flatten_sensors(shape.decode(messages(spark, "s", body), schemas.SENSOR_LOCATION))
    assert sorted(map(tuple, rows.collect())) == [
        (10, 1, "A", "pm25", "u", "PM", 1.5, 2.5), (11, 1, "A", "o3", "", "o3", 1.5, 2.5),
        (12, 1, "A", "unknown", "", "unknown", 1.5, 2.5),
        (20, 2, "Unknown", "unknown", "", "unknown", None, None)]


def test_daily_measurements_have_35_fields(spark):
    sensors = spark.createDataFrame(
        [(1, 5, "A", "p", "u", "d", 1.0, 2.0)],
        "sensor_id long, location_id long, location_name string, parameter_name string, "
        "parameter_units string, parameter_display string, latitude double, longitude double")
    body = [{"sensor_id": 1, "results": [{"value": 1.0, "flagInfo": {"hasFlags": True}}, {}]},
            {"sensor_id": 2, "results": [{"value": 9.0}]}, {"sensor_id": 1, "results": []}]
    rows = shape.flatten_daily(shape.decode(messages(spark, "d", body), schemas.DAILY_RESPONSE), sensors)
    assert len(rows.columns) == 35
    found = {(r["value"], r["has_flags"], r["latitude"], r["summary_min"]) for r in rows.collect()}
    assert found == {(1.0, True, 1.0, None), (None, False, 1.0, None)}


def test_moved_sensors_take_their_newest_place(spark):
    columns = ("sensor_id long, location_id long, location_name string, parameter_name string, parameter_units string, "
               "parameter_display string, latitude double, longitude double, seen_at string")
    sensors = spark.createDataFrame([
        (1, 9, "old", "p", "u", "d", 9.0, 9.0, "2024-01-01"), (1, 5, "new", "p", "u", "d", 1.0, 2.0, "2024-02-01"),
    ], columns)
    body = [{"sensor_id": 1, "results": [{"value": 1.0}]}]
    daily_rows_of = shape.decode(messages(spark, "d", body), schemas.DAILY_RESPONSE)
    row, = shape.flatten_daily(daily_rows_of, sensors, ["seen_at"]).collect()
    assert (row["location_id"], row["latitude"]) == (5, 1.0) and "seen_at" not in row.asDict()
    measured = spark.createDataFrame([(1, 3.5)], "sensor_id long, value double")
    row, = shape.enrich_sensor(measured, sensors, ["seen_at"]).collect()
    assert row["location_name"] == "new" and "seen_at" not in row.asDict()
    scores = spark.createDataFrame(
        [("p", 0.5, "positive", T0)], "post_id string, sentiment_score double, sentiment_label string, event_time_utc timestamp")
    posts = spark.createDataFrame([("p", 100, 1), ("p", 10, 2)], "post_id string, upvotes long, version int")
    newest, = enrich.sentiment_output(scores, posts, ["version"]).collect()
    alone, = enrich.sentiment_output(scores, posts.filter("version = 2")).collect()
    assert newest == alone


def test_hourly_arrays(spark):
    def forecast(**arrays):
        full = {"temperature_2m": [1.0, 2.0], "relativehumidity_2m": [3.0, 4.0], "precipitation": [5.0, 6.0],
                "weathercode": [7, 8], "windspeed_10m": [9.0]}
        return {"location": "B", "timestamp_utc": "t", "hourly": {**full, **arrays}}

    sent = messages(spark, "h", [forecast(), forecast(precipitation=[]), {"location": "x"}])
    decoded = shape.decode(sent, schemas.HOURLY_WEATHER)
    assert [tuple(r) for r in shape.hourly_first(decoded).collect()] == [("B", "t", 1.0, 3.0, 5.0, 7, 9.0)]
    rows = [tuple(r) for r in shape.hourly_explode(decoded).collect()]
    assert rows[1] == ("B", "t", 1, 2.0, 4.0, 6.0, 8, None) and len(rows) == 4


def test_keyword_prefilter_ignores_case_and_nulls(spark):
    posts = spark.createDataFrame([("Climate now", None), (None, "hot CLIMATE"), ("a", "b"), (None, None)],
                                  "title string, selftext string")
    assert shape.keyword_prefilter(posts, ["CLIMate"]).count() == 2


def test_radius_limit_and_order(spark):
    sensors = spark.createDataFrame([(i, 42.3601 + i / 100, -71.0589) for i in range(40)],
                                    "sensor_id long, latitude double, longitude double")
    assert [r["sensor_id"] for r in shape.within_radius(sensors).collect()] == [0, 1, 2, 3, 4]
    assert shape.within_radius(sensors, limit=40).count() == 23
    assert shape.within_radius(sensors, radius_km=2).count() == 2


# Windows.


def readings(spark, n=400, hot=0.6, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        place = "hot" if rng.random() < hot else rng.choice(["a", "b", None])
        at = T0 + timedelta(minutes=rng.choice([10, 60, 1440]) * rng.randrange(40))
        value = rng.choice([None, float(rng.randrange(-40, 40)) / 4])
        rows.append((place, at, value, float(i % 7)))
    return spark.createDataFrame(rows, "location string, event_time timestamp, temperature double, humidity double")


@pytest.mark.parametrize("width,bucket", [("7 days", "1 hour"), ("1 day", "1 day"), ("2 hours", "5 minutes")])
def test_trailing_means_equal_brute_force(spark, width, bucket):
    frame = readings(spark)
    rows = frame.collect()
    count, unit = width.split()
    reach = timedelta(**{unit.rstrip("s") + "s": int(count)})
    expected = {}
    for r in rows:
        inside = [x for x in rows if x["location"] == r["location"]
                  and r["event_time"] - reach <= x["event_time"] <= r["event_time"]]
        known = [x["temperature"] for x in inside if x["temperature"] is not None]
        expected[r["location"], r["event_time"]] = (sum(known) / len(known) if known else None, len(inside))
    found = windows.trailing_means(frame, "location", "event_time", {"mean": "temperature"}, width, bucket, "n")
    assert {(r["location"], r["event_time"]): (r["mean"], r["n"]) for r in found.collect()} == expected


def test_trailing_mean_forgets_nan(spark):
    rows = [("a", T0, float("nan")), ("a", T0 + timedelta(minutes=1), 2.0), ("a", T0 + timedelta(minutes=9), 4.0)]
    frame = spark.createDataFrame(rows, "k string, t timestamp, v double")
    found = windows.trailing_means(frame, "k", "t", {"m": "v"}, "5 minutes", "5 minutes").orderBy("t").collect()
    assert [str(r["m"]) for r in found] == ["nan", "nan", "4.0"]
    with pytest.raises(ValueError):
        windows.trailing_means(frame, "k", "t", {"m": "v"}, "5 minutes", "2 minutes")


def test_trailing_means_with_extreme_values_and_a_hot_hour(spark):
    rng = random.Random(5)
    extremes = [float("inf"), float("-inf"), 1e17, -1e17, float("nan"), 0.1, 1e-9, None]
    rows = [("hot", T0 + timedelta(hours=30, seconds=rng.randrange(3600), microseconds=i), rng.choice([1.0, 0.5, *extremes[4:]])) for i in range(500)]
    rows += [(rng.choice(["hot", "b"]), T0 + timedelta(minutes=20 * rng.randrange(400)), rng.choice([2.5, *extremes])) for _ in range(300)]
    frame = spark.createDataFrame(rows, "k string, t timestamp, v double")
    found = windows.trailing_means(frame, "k", "t", {"m": "v"}, "12 hours", "1 hour", "n").collect()
    assert len(found) == len({r[:2] for r in rows})
    for r in found:
        inside = [v for k, t, v in rows if k == r["k"] and timedelta(0) <= r["t"].replace(tzinfo=timezone.utc) - t <= timedelta(hours=12)]
        known = [v for v in inside if v is not None]
        assert r["n"] == len(inside)
        if not known:
            assert r["m"] is None
            continue
        mean, size = np.sum(known) / len(known), np.sum(np.abs(known)) / len(known)
        if np.isfinite(size):
            assert abs(r["m"] - mean) <= 1e-12 * size
        else:
            assert str(r["m"]) == str(mean)


def test_trailing_means_after_an_infinite_reading(spark):
    rows = [("a", T0, float("inf")), ("a", T0 + timedelta(days=7), 1.0), ("a", T0 + timedelta(days=7, minutes=1), 2.0), ("a", T0 + timedelta(days=7, minutes=2), 1.5)]
    frame = spark.createDataFrame(rows, "k string, t timestamp, v double")
    found = windows.trailing_means(frame, "k", "t", {"m": "v"}).orderBy("t").collect()
    assert [r["m"] for r in found] == [float("inf"), float("inf"), 1.5, 1.5]


def test_sliding_means_equal_plain_windows(spark):
    frame = readings(spark, seed=2)
    plain = frame.groupBy(F.window("event_time", "7 days", "1 day").alias("window"), F.col("location").alias("loc")).agg(
        F.avg("temperature").alias("temp_7d_avg"), F.avg("humidity").alias("humidity_7d_avg"))
    found = windows.sliding_means(frame).select(plain.columns)

    def plainly(df):
        return sorted(((r["window"]["start"], r["window"]["end"], str(r["loc"]), r["temp_7d_avg"],
                        round(r["humidity_7d_avg"], 9)) for r in df.collect()), key=str)

    assert plainly(found) == plainly(plain)


def test_latest_per_key_and_upsert(spark):
    schema = "k string, at long, v string"
    current = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", None, "n")], schema)
    updates = spark.createDataFrame([("a", 2, "late"), ("b", 1, "z"), ("c", 1, "c")], schema)
    found = windows.upsert(current, updates, ["k"], ["at"])
    assert sorted(map(tuple, found.collect())) == [("a", 3, "y"), ("b", 1, "z"), ("c", 1, "c")]


def test_clustered_splits_a_hot_key(spark):
    frame = spark.range(1000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("location"), F.col("id").alias("window_ts"))
    # Small partitions would be merged at run time.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = windows.clustered(frame).withColumn("part", F.spark_partition_id()).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r["part"] for r in parts if r["location"] == "hot"}) > 1
    for part in {r["part"] for r in parts}:
        for place in ("hot", "cold"):
            times = [r["window_ts"] for r in parts if r["part"] == part and r["location"] == place]
            assert times == sorted(times, reverse=True)


def test_stored_table_prunes_folders(spark, tmp_path):
    rows = [("Boston, USA", T0 + timedelta(hours=h), float(h)) for h in range(50)] + [("Lynn", T0, 0.0)]
    frame = spark.createDataFrame(rows, "city string, event_time_utc timestamp, v double")
    tables.write_by_city(frame, str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    boston = tables.scan_city(stored, "Boston, USA").filter("event_date = '2024-03-02'")
    assert boston.count() == 24
    plan = boston._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city" in plan and "event_date" in plan.split("PartitionFilters")[1]


# Quantiles.


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [(1, T0, float(v)) for v in rng.normal(size=700)]
    rows += [(2, T0, float(v)) for v in rng.integers(0, 5, size=900)]
    rows += [(3, T0, float(v)) for v in (1.0, 2.0)] + [(4, T0, 7.0), (5, T0, None)]
    frame = spark.createDataFrame(rows, "sensor_id long, event_time timestamp, value double")
    found = quantiles.sensor_daily_summary(frame).collect()
    assert sorted(r["sensor_id"] for r in found) == [1, 2, 3, 4]
    for r in found:
        values = np.array([v for s, _, v in rows if s == r["sensor_id"]])
        for name, q in quantiles.QUANTILES.items():
            assert r[name] == pytest.approx(np.quantile(values, q), abs=1e-12)
        assert (r["min"], r["max"], r["observed_count"]) == (values.min(), values.max(), len(values))
        if len(values) == 1:
            assert r["sd"] is None
        else:
            assert r["sd"] == pytest.approx(values.std(ddof=1))


# Summaries.


def test_demo_sentiment_summary(spark):
    rows = [("tweet1", "Negative", 0.95), ("tweet2", "Positive", 0.75), ("yt1", "Positive", 0.90)]
    frame = spark.createDataFrame([(p, T0, l, c) for p, l, c in rows],
                                  "post_id string, event_time_utc timestamp, sentiment_label string, sentiment_confidence_pct double")
    found = aggregate.sentiment_summary(frame, "2024-03-01 12:00:00").first()
    assert tuple(found) == (3, 2, 1, 0, 66.67, 33.33, 0.0, 0.87)
    # The lower bound is inclusive; an empty range gives zeros.
    assert aggregate.sentiment_summary(frame, "2024-03-02 00:00:00").first()["total_posts"] == 3
    assert tuple(aggregate.sentiment_summary(frame, "2024-03-02 00:00:01").first()) == (0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0)
    with pytest.raises(ValueError):
        aggregate.sentiment_summary(frame, "2024-03-02", 91)


def test_missing_confidence_counts_as_zero_in_the_summary_only(spark):
    frame = spark.createDataFrame([("a", T0, None, None), ("b", T0, "POSITIVE", 0.8)],
                                  "post_id string, event_time_utc timestamp, sentiment_label string, sentiment_confidence_pct double")
    found = aggregate.sentiment_summary(frame, "2024-03-01 12:00:00").first()
    assert (found["positive"], found["neutral"], found["avg_confidence"]) == (1, 1, 0.4)
    assert tuple(aggregate.confidence_band(frame).first()) == (80.0, "green")


def test_confidence_bands(spark):
    for confidence, band in ((0.499, "red"), (0.5, "yellow"), (0.75, "green"), (None, None)):
        frame = spark.createDataFrame([(confidence,)], "sentiment_confidence_pct double")
        assert aggregate.confidence_band(frame).first()["band"] == band


def test_throughput_without_time_is_zero(spark):
    frame = spark.createDataFrame([(3, 0.0), (3, -1.0), (3, 7.0), (1, None)], "records_sent long, elapsed_sec double")
    assert [r["throughput_rps"] for r in aggregate.cycle_throughput(frame).collect()] == [0.0, 0.0, 0.429, 0.0]


def test_last_non_null(spark):
    frame = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, None), ("b", 1, None)], "k string, t long, v double")
    assert {r["k"]: r["v"] for r in aggregate.last_non_null(frame, "k", "v", "t").collect()} == {"a": 2.0, "b": None}


def test_table_counts(spark):
    found = tables.table_counts(spark, {"a": spark.range(3), "b": tables.path_or_none(spark, "/none")})
    assert {r["table_name"]: r["row_count"] for r in found.collect()} == {"a": 3, "b": 0}


def daily_rows(spark, n=12):
    rng = random.Random(5)
    rows = [(f"2024-03-{i + 1:02d}", "boston", rng.random() if i != 4 else None, float(i % 3),
             rng.random() if i > 2 else 1.0) for i in range(n)]
    return spark.createDataFrame(rows, "date string, city string, avg_sentiment_confidence double, avg_temperature double, avg_aqi_score double")


def test_rolling_correlation_equals_numpy(spark):
    rows = daily_rows(spark).orderBy("date").collect()
    found = daily.rolling_correlation(daily_rows(spark)).orderBy("date").collect()
    for i, r in enumerate(found):
        for column, name in (("avg_temperature", "weather_corr"), ("avg_aqi_score", "pollution_corr")):
            pairs = [(x["avg_sentiment_confidence"], x[column]) for x in rows[max(0, i - 6):i + 1]
                     if x["avg_sentiment_confidence"] is not None]
            x, y = map(np.array, zip(*pairs))
            if len(pairs) < 2 or x.std() == 0 or y.std() == 0:
                assert r[name] is None
            else:
                assert r[name] == pytest.approx(np.corrcoef(x, y)[0, 1])


def test_correlation_counts(spark):
    frame = daily_rows(spark)
    strong = sum(r["weather_band"] == "strong" for r in daily.rolling_correlation(frame).collect())
    found = daily.correlation_metrics(daily.correlation_counters(frame)).first()
    assert found["sentiment_weather_strong"] == strong > 0
    assert found["sentiment_weather_moderate"] == found["sentiment_pollution_weak"] == 0


def test_daily_keeps_days_of_any_input(spark):
    when = "event_time_utc timestamp, city string"
    weather = spark.createDataFrame([(T0, "b", 1.0, 2.0, 3.0, 4.0, 5.0, "Normal")], f"{when}, temperature_celsius double, feels_like_temp double, humidity double, precipitation double, wind_speed double, weather_anomaly string")
    air = spark.createDataFrame([(T0, "b", 10.0, -1, True)], f"{when}, aqi_score double, health_risk_level int, pollution_spike boolean")
    posts = spark.createDataFrame([(T0 + timedelta(days=1), "b", "p"), (T0 + timedelta(days=1), "b", "p")], f"{when}, post_id string")
    sentiment = spark.createDataFrame([(T0 + timedelta(days=2), "b", None, 0.5)], f"{when}, sentiment_label string, sentiment_confidence_pct double")
    found = {r["date"]: r for r in daily.daily_aggregates(weather, air, posts, sentiment).collect()}
    assert sorted(found) == ["2024-03-01", "2024-03-02", "2024-03-03"]
    assert found["2024-03-01"]["avg_temperature"] == 1.0 and found["2024-03-01"]["avg_health_risk"] is None
    assert found["2024-03-01"]["pollution_spike_count"] == 1 and found["2024-03-01"]["num_social_posts"] == 0
    assert found["2024-03-02"]["num_social_posts"] == 1 and found["2024-03-02"]["avg_temperature"] is None
    assert found["2024-03-03"]["neutral_posts"] == 1
    assert len(found["2024-03-01"]) == 18


# Logs.


def log_frame(spark, rows):
    return spark.createDataFrame(
        [(T0 + timedelta(seconds=s), c, e, x, r, t) for s, c, e, x, r, t in rows],
        "ts timestamp, component string, event string, stream string, records_sent long, throughput_rps double")


def test_grid_values_cover_left_open_ranges(spark):
    frame = log_frame(spark, [(0, "c", "send_success", "s", 1, 1.0), (60, "c", "send_success", "s", 1, 1.0), (61, "c", "send_success", "s", 1, 1.0)])
    found = {r["grid_time"]: r["events_per_second"] * 300 for r in logs.event_rate(frame).collect()}
    at = {m: naive(T0 + timedelta(minutes=m)) for m in range(8)}
    # The event at 0 s counts at minutes 0..4, the one at 60 s at 1..5, the one at 61 s at 2..6.
    assert {m: round(found[at[m]]) for m in range(7)} == {0: 1, 1: 2, 2: 3, 3: 3, 4: 3, 5: 2, 6: 1}
    assert at[7] not in found


def test_last_values_skip_unknown(spark):
    frame = log_frame(spark, [(1, "c", "cycle_complete", "s", 4, 1.0), (2, "c", "cycle_complete", "s", None, 2.0)])
    found = logs.last_values(frame).orderBy("grid_time").first()
    assert (found["records_sent"], found["throughput_rps"]) == (4, 2.0)


def test_log_lines(spark, tmp_path):
    lines = [json.dumps({"ts_utc": "2024-03-01T00:00:00Z", "component": c, "event": "start", "broker": "x"})
             for c in ("air_ingest", "x_ingest")] + ["plain text"]
    (tmp_path / "log").write_text("\n".join(lines))
    found = scan_logs(read_logs(spark, str(tmp_path / "log")))
    assert [(r["component"], r["ts"]) for r in found.collect()] == [("air_ingest", naive(T0))]
    assert scan_logs(read_logs(spark, str(tmp_path / "log")), None).count() == 3


# Read operators.


def weather_rows(spark):
    rows = [("Boston, USA", T0 + timedelta(hours=h), 1.0, "Normal" if h % 2 else "High wind anomaly") for h in range(20)]
    rows.append(("Lynn", T0 + timedelta(days=9), 1.0, "High wind anomaly"))
    frame = spark.createDataFrame(rows, "city string, event_time_utc timestamp, temperature_celsius double, weather_anomaly string")
    zero = F.lit(0.0)
    return frame.withColumns({"feels_like_temp": zero, "humidity": zero, "precipitation": zero, "wind_speed": zero, "wind_category": F.lit("Calm")})


def test_limit_comes_before_or_after_the_anomaly_filter(spark):
    frame = weather_rows(spark)
    assert serve.weather_latest(frame).count() == 10
    assert serve.weather_latest(frame, 10, anomaly_only=True).count() == 5
    assert serve.weather_anomalies(frame, 10).count() == 10
    assert serve.weather_latest(frame, 1, city="lynn").first()["city"] == "Lynn"
    assert serve.weather_latest(frame, 1, city=None).first()["city"] == "Lynn"
    assert serve.current_temperature(frame).count() == 1
    series = serve.temperature_series(frame, "2024-03-01 02:00:00", "2024-03-01 05:00:00").collect()
    assert [r["time"].hour for r in series] == [2, 3, 4]
    text = serve.iso_times(serve.weather_latest(frame, 1)).first()["event_time_utc"]
    assert text == "2024-03-01T19:00:00"


@pytest.mark.parametrize("call", [
    lambda f: serve.weather_latest(f, 0), lambda f: serve.weather_latest(f, 101),
    lambda f: serve.weather_anomalies(f, 501), lambda f: serve.daily_latest(f, 0),
    lambda f: serve.search_keywords(f, "a", 101),
])
def test_parameters_out_of_range(spark, call):
    with pytest.raises(ValueError):
        call(weather_rows(spark))


def post_rows(spark):
    rows = [("tweet1", 30, ["climate"], ["Downtown"], 3), ("tweet2", 20, ["Weather"], None, None), ("yt1", 10, None, ["back bay"], 1)]
    return spark.createDataFrame(
        [(p, T0 + timedelta(minutes=m), None, "b", None, "x" if "t" == p[0] else "youtube", u, k, r) for p, m, k, r, u in rows],
        "post_id string, event_time_utc timestamp, title_normalized string, body_normalized string, "
        "author_normalized string, source string, upvotes long, keywords array<string>, regions_detected array<string>")


def test_posts_have_defaults(spark):
    rows = serve.posts_latest(post_rows(spark)).collect()
    assert [r["post_id"] for r in rows] == ["tweet1", "tweet2", "yt1"]
    assert (rows[1]["upvotes"], rows[1]["title_normalized"], rows[1]["regions_detected"], rows[2]["keywords"]) == (0, "", [], [])
    assert [r["post_id"] for r in serve.posts_latest(post_rows(spark), source="youtube").collect()] == ["yt1"]


def test_searches_match_whole_entries(spark):
    frame = post_rows(spark)
    ids = lambda df: [r["post_id"] for r in df.collect()]
    assert ids(serve.search_keywords(frame, "climate,heat")) == ["tweet1"]
    assert ids(serve.search_keywords(frame, " CLIMATE , weather")) == ["tweet1", "tweet2"]
    assert ids(serve.search_keywords(frame, "clim")) == []
    assert ids(serve.search_region(frame, "DOWNTOWN")) == ["tweet1"]
    assert ids(serve.search_region(frame, "Back Bay")) == ["yt1"]


def stored_posts(spark):
    said = ["Air pollution in Back Bay", "the environment", "climate change, West Roxbury", "nothing", "heat wave heat Roxbury", None]
    return spark.createDataFrame(
        [(f"p{i}", T0 + timedelta(days=i % 9, minutes=i), None, said[i % 6], "a", "s", 1) for i in range(60)],
        "post_id string, event_time_utc timestamp, title_normalized string, body_normalized string, "
        "author_normalized string, source string, upvotes long").withColumn("event_date", F.to_date("event_time_utc"))


def test_searches_read_only_the_lists_of_their_terms(spark, tmp_path):
    posts = stored_posts(spark)
    tables.write_postings(enrich.term_postings(enrich.tag_posts(posts)), str(tmp_path / "terms"))
    posts.write.partitionBy("event_date").parquet(str(tmp_path / "posts"))
    lists, stored = spark.read.parquet(str(tmp_path / "terms")), spark.read.parquet(str(tmp_path / "posts"))
    for search, asked, limit in ((serve.search_keywords, "climate change, ENVIRONMENT", 7), (serve.search_keywords, "heat wave", 100),
                                 (serve.search_region, "roxbury", 4), (serve.search_region, "West Roxbury", 100), (serve.search_region, "none", 5)):
        whole, listed = search(posts, asked, limit).collect(), search(stored, asked, limit, lists)
        assert listed.collect() == whole and (len(whole) > 0) == (asked != "none")
        plan = listed._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*kind[^\]]*term", plan)
        # Of the posts, only the days of the hits are read.
        assert "dynamicpruning" in plan
    assert serve.posts_latest(stored, 3).collect() == serve.posts_latest(enrich.tag_posts(posts), 3).collect()


def test_newest_rows_are_found_before_they_are_worked_on(spark):
    posts = stored_posts(spark).withColumn("body_normalized", F.concat("body_normalized", F.lit("!")))
    rows = serve.newest_whole(posts.union(posts), 5, "post_id").collect()
    assert [r["post_id"] for r in rows] == ["p53", "p53", "p44", "p44", "p35"]
    none = posts.withColumn("event_time_utc", F.lit(None).cast("timestamp"))
    assert serve.newest_whole(none, 5, "post_id").count() == 5


def test_sentiment_label_filter(spark):
    frame = enrich.sentiment_output(spark.createDataFrame(
        [("a", T0, "positive", 0.5), ("b", T0, None, None)],
        "post_id string, event_time_utc timestamp, sentiment_label string, sentiment_score double"))
    assert serve.sentiment_latest(frame, label="POSITIVE").count() == 1
    assert serve.sentiment_latest(frame, label="other").count() == 2
    row = frame.filter("post_id = 'b'").first()
    assert (row["sentiment_category"], row["sentiment_confidence_pct"], row["engagement_score"]) == ("neutral", 0.0, 0.0)


# Classification.


def test_user_model_runs_once_per_task(spark):
    def load():
        return lambda texts: [[float(len(t)), 3.0, 0.0] for t in texts]

    frame = spark.createDataFrame([("a", "x"), ("b", "xxxxx"), ("c", None)], "post_id string, text string")
    rows = classify.score_text(frame, "text", load, ["long", "short", "never"]).collect()
    assert {r["post_id"]: r["sentiment_label"] for r in rows} == {"a": "short", "b": "long", "c": "short"}


def test_training_set_keeps_one_of_many_copies(spark):
    posts = spark.range(300).select("id", F.when(F.col("id") < 200, "Same text!").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    posts = posts.withColumnRenamed("id", "post_id")
    labels = spark.range(100, 250).select(F.col("id").alias("post_id"), (F.col("id") % 2).alias("label"))
    found = classify.training_set(posts, labels)
    assert found.count() == 51
    assert tuple(found.filter("text = 'same text'").first()) == (100, "same text", 0)


# Joins.


def test_reading_takes_one_window(spark):
    parsed = spark.createDataFrame(
        [("a", T0 + timedelta(hours=5), 1.0, 2.0, 0.0), ("a", T0 + timedelta(days=3), 3.0, 4.0, 0.0), (None, T0, 5.0, 6.0, 0.0)],
        "location string, event_time timestamp, temperature double, humidity double, precipitation double")
    means = windows.sliding_means(parsed)
    found = {r["temperature"]: r["temp_7d_avg"] for r in joins.climate_metrics(parsed, means).collect()}
    assert found == {1.0: 1.0, 3.0: 2.0, 5.0: None}
    newest = joins.with_latest_means(parsed, means).collect()
    assert {r["temperature"]: r["temp_7d_avg"] for r in newest} == {1.0: 1.0, 3.0: 2.0, 5.0: None}
    # A replayed reading stays one row.
    assert joins.climate_metrics(parsed.union(parsed), means).count() == 3


def test_readings_take_the_newest_mean_that_has_ended(spark):
    rng = random.Random(11)
    day = lambda n: T0 + timedelta(days=n)
    readings = [(rng.choice(["hot", "hot", "a", "b", None]), day(rng.randrange(20)) + timedelta(hours=rng.randrange(24)), float(i)) for i in range(120)]
    # Gaps, several windows of one end, a location without readings, one without windows.
    ends = [(rng.choice(["hot", "a", "c"]), rng.randrange(-3, 22), float(i)) for i in range(25)] + [("hot", 4, -1.0), ("hot", 4, 99.0)]
    parsed = spark.createDataFrame(
        [(p, t, v, 0.0, 0.0) for p, t, v in readings],
        "location string, event_time timestamp, temperature double, humidity double, precipitation double")
    means = spark.createDataFrame(
        [((day(e - 7), day(e)), p, v, 1.0) for p, e, v in ends],
        "window struct<start: timestamp, end: timestamp>, loc string, temp_7d_avg double, humidity_7d_avg double")
    found = {r["temperature"]: r["temp_7d_avg"] for r in joins.with_latest_means(parsed, means).collect()}
    for place, at, value in readings:
        until = at.replace(hour=0) + timedelta(days=1)
        known = [(day(e), m) for p, e, m in ends if p == place and day(e) <= until]
        assert found[value] == (max(known)[1] if known else None)
    assert joins.with_latest_means(parsed.union(parsed), means).count() == 240
    assert joins.with_latest_means(parsed.limit(0), means).count() == 0
    assert joins.with_latest_means(parsed, means.limit(0)).filter("temp_7d_avg is null").count() == 120


def test_copies_on_both_sides_do_not_multiply(spark):
    comments = spark.createDataFrame([("c1", "p"), ("c1", "p"), ("c2", "q")], "id string, post_id string")
    posts = spark.createDataFrame([("p", "t", "a"), ("p", "t", "a"), ("r", "x", None)], "id string, title string, author string")
    assert sorted(map(tuple, joins.comment_thread(comments, posts, []).collect())) == [("p", "c1", "t", "a")] * 2
    assert joins.orphan_comments(comments, posts).count() == 1
    scores = spark.createDataFrame([("p", "positive", 0.5)] * 3, "post_id string, sentiment_label string, sentiment_score double")
    assert joins.posts_with_sentiment(comments.select("post_id"), scores, []).count() == 3


def test_newest_copy_counts(spark):
    posts = spark.createDataFrame([("p",), ("q",)], "post_id string")
    scores = spark.createDataFrame(
        [("p", T0, "positive", 0.1), ("p", T0 + timedelta(hours=1), "negative", 0.9)],
        "post_id string, event_time_utc timestamp, sentiment_label string, sentiment_score double")
    found = {r["post_id"]: r["sentiment_label"] for r in joins.posts_with_sentiment(posts, scores).collect()}
    assert found == {"p": "negative", "q": None}
    labels = spark.createDataFrame([("p", 0), ("p", 1), ("q", 1), ("q", 1)], "post_id string, label int")
    kept = classify.training_set(posts.withColumn("text", F.col("post_id")), labels).collect()
    assert [(r["post_id"], r["label"]) for r in kept] == [("q", 1)]


def test_infinite_readings_have_quantiles(spark):
    rows = [(1, T0, float("inf"))] * 600 + [(1, T0, float(v)) for v in range(401)]
    frame = spark.createDataFrame(rows, "sensor_id long, event_time timestamp, value double")
    found = quantiles.sensor_daily_summary(frame).first()
    assert (found["median"], found["q75"], found["q98"]) == (float("inf"),) * 3


def test_times_out_of_range_are_rejects(spark):
    values = [9223372036854775807, 1704067200000]
    frame = spark.createDataFrame([(v,) for v in values], "timestamp long")
    assert [r[0] is None for r in frame.select(env.epoch_millis()()).collect()] == [True, False]
    seconds = spark.createDataFrame([(1e300,), (float("nan"),), (1704067200.5,)], "timestamp double")
    assert [r[0] is None for r in seconds.select(env.epoch_seconds()()).collect()] == [True, True, False]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_split_at_run_time(spark):
    """With a third and more of all rows under one key, the shuffled join runs in several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(0, 40000, 1, 8).select(
            F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("post_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("body"))
        posts = ids.select(F.col("post_id").alias("id"), F.lit("t").alias("title"), F.lit("a").alias("author"))
        threads = joins.comment_thread(ids, posts, [])
        assert "skew=true" in final_plan(threads) and threads.count() == 40000
        sensors = ids.select(F.col("post_id").alias("sensor_id"), F.lit(1).alias("location_id"))
        assert "skew=true" in final_plan(shape.enrich_sensor(ids.withColumnRenamed("post_id", "sensor_id"), sensors))
        parsed = ids.select(
            F.col("post_id").alias("location"), F.lit(T0).alias("event_time"), F.col("body").alias("temperature"),
            F.lit(0.0).alias("humidity"), F.lit(0.0).alias("precipitation"))
        means = ids.select(
            F.struct(F.lit(T0).alias("start"), F.lit(T0).alias("end")).alias("window"), F.col("post_id").alias("loc"),
            F.lit(1.0).alias("temp_7d_avg"), F.lit(1.0).alias("humidity_7d_avg"))
        plan = final_plan(joins.with_latest_means(parsed, means))
        assert "skew=true" in plan, plan
    finally:
        for key in settings:
            spark.conf.unset(key)
