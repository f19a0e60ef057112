"""Streams over landed files: equal to batches, restartable, idempotent."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from galemark import fixed_values as fv, schemas
from galemark.operators import daily, enrich, joins, logs, serve, windows
from galemark.sources import envelope as env, shapes, tables
from galemark.streaming import health, jobs, main, sinks

START = datetime(2024, 1, 10, tzinfo=timezone.utc)


def weather_message(hours, location="Boston", temperature=5.0, **more):
    body = {
        "location": location, "timestamp_utc": (START + timedelta(hours=hours)).isoformat(),
        "temperature": temperature, "humidity": 50.0, "precipitation": 0.0, "weather_code": 1,
        "wind_speed": 3.0, **more,
    }
    return fv.WEATHER_TOPIC, json.dumps(body)


def land(spark, path, messages, name):
    """Add one file of messages."""
    rows = [(t, None, bytearray(v.encode()), START) for t, v in messages]
    frame = spark.createDataFrame(rows, schemas.ENVELOPE).coalesce(1)
    frame.write.mode("append").parquet(path)


def stream(spark, path, files=1):
    return env.file_envelope(spark, path, files_per_trigger=files)


def finish(*queries):
    for query in queries:
        query.awaitTermination(120)
        assert query.exception() is None
        assert not query.isActive


def rows(df, *drop):
    return sorted(df.drop(*drop).collect(), key=str)


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


CLOCK = ("ingestion_time", "batch_timestamp", "ts_ingested")


def test_stored_tables_equal_batch(spark, folder):
    landed = folder("landed")
    messages = [weather_message(h, temperature=40.0 - h) for h in range(6)]
    messages.append((fv.AIR_TOPIC, json.dumps(
        {"parameter": "PM25 ", "value": 120.5, "city": "Boston", "timestamp_utc": "2024-01-10T01:00:00"})))
    messages.append((fv.VIDEO_TOPIC, json.dumps(
        {"id": "p", "title": "T!", "body": "see http://a.b now, climate change in Back Bay", "upvotes": 5, "timestamp": 1704850000000})))
    messages.append((fv.SENTIMENT_TOPIC, json.dumps(
        {"post_id": "p", "sentiment_score": 0.5, "sentiment_label": " Positive", "timestamp": 1704850000000})))
    land(spark, landed, messages[:4], "a")
    land(spark, landed, messages[4:], "b")

    def source(topic):
        return env.file_envelope(spark, landed, [topic], files_per_trigger=1)

    out = folder("out")
    finish(*jobs.start_tables(source, out, root=folder("ck"), once=True))
    batch = env.file_envelope(spark, landed, streaming=False)
    for name, (_, make) in jobs.TABLES.items():
        expected = make(batch)
        stored = spark.read.parquet(f"{out}/{name}").drop("event_date").select(expected.columns)
        assert rows(stored, *CLOCK) == rows(expected, *CLOCK) and stored.count() > 0
    served(spark, out)


def served(spark, out):
    """Every read operator works on the tables as the jobs store them."""
    weather, air, posts, terms, sentiment = (
        spark.read.parquet(f"{out}/{name}") for name in ("weather", "air_quality", "social_posts", "post_terms", "sentiment")
    )
    assert serve.weather_latest(weather, 3).count() == 3
    assert serve.weather_anomalies(weather).count() <= 6
    assert serve.air_latest(air).first()["value"] == 120.5 and serve.pollution_spikes(air).count() == 1
    assert serve.posts_latest(posts).first()["keywords"] == ["climate change"]
    for lists in (None, terms):
        assert serve.search_keywords(posts, "Climate change", 5, lists).first()["post_id"] == "p"
        assert serve.search_region(posts, "back bay", 5, lists).first()["post_id"] == "p"
        assert serve.search_region(posts, "fenway", 5, lists).count() == 0
    assert serve.sentiment_latest(enrich.sentiment_output(sentiment, posts), 5, "positive").first()["engagement_score"] > 0
    assert serve.current_temperature(weather).count() == 1 and serve.temperature_series(weather).count() == 6
    assert serve.iso_times(serve.weather_latest(weather, 1)).first()["event_time_utc"] == "2024-01-10T05:00:00"


def test_console_queries_start(spark, folder):
    landed = folder("landed")
    land(spark, landed, [weather_message(0)], "a")
    finish(*jobs.start_console(lambda t: stream(spark, landed), root=folder("ck"), once=True))


def test_weekly_means_update_equals_batch(spark, folder):
    landed, path, ck = folder("landed"), folder("means"), folder("ck")
    for i in range(3):
        land(spark, landed, [weather_message(24 * i + h, temperature=float(i + h)) for h in (0, 5)], i)
    weather = env.parse_weather(stream(spark, landed))
    finish(jobs.start_weekly_means(weather, path, root=ck, once=True))
    batch = windows.sliding_means(env.parse_weather(env.file_envelope(spark, landed, streaming=False)))
    stored = jobs.read_weekly_means(spark, path).select(batch.columns)
    assert rows(stored) == rows(batch)

    # A restart without news adds nothing, one with news continues.
    finish(jobs.start_weekly_means(weather, path, root=ck, once=True))
    assert rows(jobs.read_weekly_means(spark, path).select(batch.columns)) == rows(batch)
    land(spark, landed, [weather_message(80, temperature=9.0)], "x")
    finish(jobs.start_weekly_means(weather, path, root=ck, once=True))
    batch = windows.sliding_means(env.parse_weather(env.file_envelope(spark, landed, streaming=False)))
    assert rows(jobs.read_weekly_means(spark, path).select(batch.columns)) == rows(batch)


def late_run(spark, folder, mode):
    landed = folder("landed")
    for i, (hours, temperature) in enumerate(((0, 1.0), (24 * 40, 1.0), (24 * 41, 1.0), (0, 99.0))):
        land(spark, landed, [weather_message(hours, temperature=temperature)], i)
        if mode == "update":
            weather = env.parse_weather(stream(spark, landed))
            finish(jobs.start_weekly_means(weather, folder("means"), root=folder("ck"), once=True))
    if mode == "update":
        return jobs.read_weekly_means(spark, folder("means"))
    means = jobs.weekly_means(env.parse_weather(stream(spark, landed)))
    finish(sinks.to_memory(means, "late_means", root=folder("ck"), once=True))
    return spark.table("late_means")


def test_late_rows_are_dropped_in_update_mode(spark, folder):
    # The second reading of hour 0 arrives after the watermark has passed all its windows.
    dropped = late_run(spark, folder, "update")
    assert dropped.count() == 15 and dropped.agg(F.max("temp_7d_avg")).first()[0] == 1.0


def test_complete_mode_keeps_late_rows(spark, folder):
    kept = late_run(spark, folder, "complete")
    assert kept.count() == 15 and kept.agg(F.max("temp_7d_avg")).first()[0] == 50.0


def test_no_row_is_late_without_state(spark, folder):
    landed = folder("landed")
    for i, hours in enumerate((0, 24 * 40, 24 * 41, 0)):
        land(spark, landed, [weather_message(hours)], i)
    parsed = env.parse_weather(stream(spark, landed))
    finish(sinks.to_memory(parsed, "all_rows", mode="append", once=True))
    assert spark.table("all_rows").count() == 4


def test_readings_join_the_means_of_their_batch(spark, folder):
    landed, means, path, ck = folder("landed"), folder("means"), folder("table"), folder("ck")
    weather = lambda: env.parse_weather(stream(spark, landed))

    land(spark, landed, [weather_message(1, temperature=2.0)], "a")
    finish(jobs.start_climate_metrics(weather(), means, path, root=ck, once=True))
    assert jobs.read_climate_metrics(spark, path).first()["temp_7d_avg"] is None

    finish(jobs.start_weekly_means(weather(), means, root=ck, once=True))
    land(spark, landed, [weather_message(2, temperature=4.0)], "b")
    finish(jobs.start_climate_metrics(weather(), means, path, root=ck, once=True))
    found = {r["temperature"]: r["temp_7d_avg"] for r in jobs.read_climate_metrics(spark, path).collect()}
    assert found == {2.0: None, 4.0: 2.0}

    finish(jobs.start_weekly_means(weather(), means, root=ck, once=True))
    finish(jobs.start_climate_metrics(weather(), means, path, root=ck, once=True, name="again"))
    table = jobs.read_climate_metrics(spark, path)
    assert table.count() == 2
    newest = jobs.start_climate_metrics(
        weather(), means, folder("newest"), root=ck, once=True, name="newest", trailing=False)
    finish(newest)
    assert {r["temp_7d_avg"] for r in jobs.read_climate_metrics(spark, folder("newest")).collect()} == {3.0}


def test_replayed_batch_changes_nothing(spark, folder):
    path, schema = folder("keyed"), "k string, at bigint, v string"
    write = sinks.keyed_writer(path, ["k"], ["at"])
    first = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], schema)
    second = spark.createDataFrame([("a", 3, "new"), ("b", 0, "old")], schema)
    for batch, epoch in ((first, 0), (second, 1), (second, 1)):
        write(batch, epoch)
    state = sinks.read_keyed(spark, path, schema, ["k"], ["at"])
    assert rows(state) == [("a", 3, "new"), ("b", 1, "z")]
    assert spark.read.parquet(path).count() == 4
    sinks.compact_keyed(spark, path, folder("compact"), schema, ["k"], ["at"])
    assert rows(sinks.read_keyed(spark, folder("compact"), schema, ["k"], ["at"])) == rows(state)
    assert sinks.read_keyed(spark, folder("none"), schema, ["k"], ["at"]).count() == 0


def test_new_checkpoint_keeps_earlier_batches(spark, folder):
    path, schema = folder("runs"), "k string, at bigint"
    for turn, keys in enumerate((["a", "b"], ["c"])):
        spark.createDataFrame([(k, turn) for k in keys], schema).write.parquet(folder(f"in{turn}"))
        stream = spark.readStream.schema(schema).parquet(folder(f"in{turn}"))
        write = sinks.keyed_writer(path, ["k"], ["at"])
        query = sinks.to_batches(stream, f"run{turn}", write, root=folder(f"check{turn}"), once=True)
        assert query.awaitTermination(120)
    assert rows(sinks.read_keyed(spark, path, schema, ["k"], ["at"])) == [("a", 0), ("b", 0), ("c", 1)]


def test_fan_out_reads_a_batch_once(spark, folder):
    landed = folder("landed")
    land(spark, landed, [weather_message(0), (fv.SENTIMENT_TOPIC, json.dumps({"post_id": "p"}))], "a")
    seen = {}
    writers = {t: (lambda b, e, t=t: seen.__setitem__(t, b.count())) for t in fv.CORE_TOPICS}
    finish(sinks.to_batches(stream(spark, landed), "fan", sinks.fan_out(writers, env.demux), root=folder("ck"), once=True))
    assert seen == {fv.WEATHER_TOPIC: 1, fv.AIR_TOPIC: 0, fv.VIDEO_TOPIC: 0, fv.SENTIMENT_TOPIC: 1}


def test_messages_to_files_and_back(spark, folder):
    landed, out = folder("landed"), folder("out")
    land(spark, landed, [weather_message(0)], "a")
    parsed = env.parse_weather(stream(spark, landed)).select("location", "temperature", "event_time")
    sent = env.to_envelope(parsed, "copy", "location", "event_time")
    finish(sinks.to_files(sent, "copy", out, root=folder("ck"), once=True))
    message = spark.read.parquet(out).first()
    assert message["topic"] == "copy" and bytes(message["key"]) == b"Boston"
    assert json.loads(bytes(message["value"])) == {"location": "Boston", "temperature": 5.0}


def test_default_checkpoint_is_the_shared_folder(spark, folder):
    landed = folder("landed")
    land(spark, landed, [weather_message(0)], "a")
    name = f"shared{abs(hash(landed))}"
    finish(sinks.to_batches(stream(spark, landed), name, lambda b, e: None, once=True))
    root = spark.conf.get("spark.checkpoint.dir")
    assert os.path.isdir(f"{root}/{name}/offsets")


def test_health_of_streams(spark, folder):
    landed, lines = folder("landed"), []
    land(spark, landed, [weather_message(h) for h in range(3)], "a")
    listener = health.HealthListener(lines.append)
    spark.streams.addListener(listener)
    query = sinks.to_batches(stream(spark, landed), "watched", lambda b, e: b.count(), root=folder("ck"), once=True)
    finish(query)
    spark.streams.removeListener(listener)
    records = health.recent_health(spark, [query])
    row = records.first()
    assert (row["component"], row["stream"], row["records_sent"]) == ("spark_processor", "watched", 3)
    assert row["ts"] is not None and row["throughput_rps"] > 0
    rates = logs.event_rate(records)
    assert rates.count() == 5 and abs(rates.first()["events_per_second"] - 1 / 300) < 1e-12


def test_table_or_empty(spark):
    means = tables.table_or_empty(spark, "no_such_means", schemas.WEEKLY_MEANS)
    assert means.count() == 0 and means.columns == ["window", "loc", "temp_7d_avg", "humidity_7d_avg"]
    means.createOrReplaceTempView("such_means")
    assert tables.table_or_empty(spark, "such_means", schemas.WEEKLY_MEANS).count() == 0


def test_kafka_source_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        env.kafka_envelope(spark, "nowhere:9092", fv.ALL_TOPICS)


@pytest.mark.parametrize("job", ["tables", "weekly"])
def test_command_line_job(spark, folder, job):
    landed, out = folder("landed"), folder("out")
    land(spark, landed, [weather_message(h) for h in range(3)], "a")
    main.run(spark, main.arguments([job, "--landed", landed, "--out", out, "--checkpoints", folder("ck"), "--once"]))
    if job == "tables":
        assert spark.read.parquet(f"{out}/weather").count() == 3
    else:
        rows = jobs.read_climate_metrics(spark, f"{out}/climate_metrics").collect()
        mean = sum(r["temperature"] for r in rows) / 3
        assert len(rows) == 3 and all(abs(r["temp_7d_avg"] - mean) < 1e-9 for r in rows)
        assert jobs.read_weekly_means(spark, f"{out}/weekly_means").count() == 7


def test_keyed_table_reads_a_bounded_number_of_folders(spark, folder):
    path, schema = folder("many"), "k string, at bigint, v bigint"
    write = sinks.keyed_writer(path, ["k"], ["at"], every=5)
    expected = {}
    for epoch in range(23):
        batch = [(f"k{epoch % 7}", epoch, epoch), (f"k{epoch % 3}", epoch - 4, -epoch)]
        for k, at, v in batch:
            expected[k] = max(expected.get(k, (-99, 0, 0)), (at, epoch, v))
        write(spark.createDataFrame(batch, schema), epoch)
        if epoch in (4, 11):
            # A replay, of a batch that a snapshot has and of one that it has not.
            write(spark.createDataFrame(batch, schema), epoch)
        found = sinks.read_keyed(spark, path, schema, ["k"], ["at"])
        opened = {f.rsplit("/", 1)[0] for f in found.inputFiles()}
        assert len(opened) <= 6 and {r["k"]: (r["at"], r["v"]) for r in found.collect()} == {
            k: (at, v) for k, (at, _, v) in expected.items()}
    kept = [name for name in os.listdir(path) if name.startswith("snapshot=")]
    assert len(kept) == 2 and len(os.listdir(path + "/run=batch")) <= 11
    # A snapshot that was not finished does not count.
    os.makedirs(path + "/snapshot=99")
    assert sinks.read_keyed(spark, path, schema, ["k"], ["at"]).count() == 7


def test_daily_job_equals_daily_aggregates(spark, folder):
    landed, out = folder("landed"), folder("daily")
    air = lambda hours, value: (fv.AIR_TOPIC, json.dumps({
        "parameter": "pm25", "value": value, "city": "Boston", "timestamp_utc": (START + timedelta(hours=hours)).isoformat()}))
    post = lambda name, hours: (fv.VIDEO_TOPIC, json.dumps(
        {"id": name, "title": "t", "body": "b", "upvotes": 1, "timestamp": 1704850000000 + hours * 3600000}))
    mood = lambda name, hours, label: (fv.SENTIMENT_TOPIC, json.dumps(
        {"post_id": name, "sentiment_score": hours / 64, "sentiment_label": label, "timestamp": 1704850000000 + hours * 3600000}))
    source = lambda topic: env.file_envelope(spark, landed, [topic], files_per_trigger=1)
    assert jobs.read_daily(spark, out).count() == 0
    # The third batch is late: it belongs to the first day.
    for turn, hours in enumerate((0, 30, 3, 31)):
        land(spark, landed, [
            weather_message(hours, temperature=40.0 * (turn % 2)), weather_message(hours + 1, temperature=7.0),
            air(hours, 50.0 * turn), post("p1", hours), post(f"q{turn}", hours), mood("p1", hours, ["positive", "negative"][turn % 2])], turn)
        finish(*jobs.start_daily(source, out, every=2, root=folder("ck"), once=True))
    batch = env.file_envelope(spark, landed, streaming=False)
    posts, scores = jobs.social_table(batch), jobs.sentiment_table(batch).withColumn("city", F.lit(fv.CITY))
    whole = daily.daily_aggregates(
        jobs.weather_table(batch), jobs.air_table(batch), posts.withColumn("city", F.lit(fv.CITY)),
        scores.withColumnRenamed("sentiment_score", "sentiment_confidence_pct"))
    assert rows(jobs.read_daily(spark, out)) == rows(whole) and whole.count() == 2
    assert serve.daily_latest(jobs.read_daily(spark, out)).count() == 2


def test_late_readings_correct_earlier_rows(spark, folder):
    landed, path = folder("landed"), folder("table")
    turns = [
        [weather_message(1, temperature=2.0), weather_message(30, temperature=4.0), weather_message(1, "Salem", 8.0)],
        [weather_message(36, temperature=6.0)],
        # Late, but not past the watermark: it changes the means of its own day and of the next.
        [weather_message(2, temperature=10.0), weather_message(37, temperature=None)],
    ]
    land(spark, landed, turns[0], 0)
    query = jobs.start_corrected_metrics(env.parse_weather(stream(spark, landed)), path, root=folder("ck"))
    try:
        for turn in range(3):
            if turn:
                land(spark, landed, turns[turn], turn)
            query.processAllAvailable()
            batch = env.parse_weather(env.file_envelope(spark, landed, streaming=False))
            whole = joins.climate_metrics(batch, windows.sliding_means(batch))
            assert rows(jobs.read_climate_metrics(spark, path), *CLOCK) == rows(whole, *CLOCK)
        found = {r["temperature"]: r["temp_7d_avg"] for r in jobs.read_climate_metrics(spark, path).collect()}
        assert found == {2.0: 6.0, 10.0: 6.0, 4.0: 5.5, 6.0: 5.5, None: 5.5, 8.0: 8.0}
    finally:
        query.stop()
    # A restart goes on from the state.
    land(spark, landed, [weather_message(38, temperature=0.0)], 3)
    finish(jobs.start_corrected_metrics(env.parse_weather(stream(spark, landed)), path, root=folder("ck"), once=True))
    found = {r["temperature"]: r["temp_7d_avg"] for r in jobs.read_climate_metrics(spark, path).collect()}
    assert found[0.0] == found[6.0] == 4.4 and found[2.0] == 6.0


def test_running_state_serves_the_weekly_means(spark, folder):
    landed = folder("landed")
    for i in range(2):
        land(spark, landed, [weather_message(20 * i + h, place, float(i + h)) for h in (0, 5) for place in ("Boston", "Salem")], i)
        weather = env.parse_weather(stream(spark, landed))
        finish(jobs.start_weekly_means(weather, folder("means"), root=folder("ck"), once=True))
        batch = windows.sliding_means(env.parse_weather(env.file_envelope(spark, landed, streaming=False)))
        assert rows(jobs.running_weekly_means(spark, folder("ck"))) == rows(batch.select("window", "loc", "temp_7d_avg", "humidity_7d_avg"))


def mixed_messages():
    comment = {"video_id": "v", "author": "A", "text": "Back Bay!", "published_at": "2024-01-10T01:00:00Z", "cycle": 1}
    short = {"platform": "x", "id": "7", "text": "hot", "timestamp_utc": "2024-01-10T02:00:00+00:00", "user": "u", "hashtags": []}
    day = {"sensor_id": 3, "parameter_id": 2, "value": 1.5, "datetime_from_utc": "2024-01-09T00:00:00Z",
           "has_flags": False, "ingested_at_utc": "2024-01-10T00:00:00"}
    post = {"id": "p", "title": "T", "body": "b", "timestamp": 1704850000000}
    return [
        (fv.VIDEO_TOPIC, json.dumps(comment)), (fv.VIDEO_TOPIC, json.dumps(post)),
        (fv.VIDEO_TOPIC, json.dumps({**comment, "cycle": 2})), (fv.VIDEO_TOPIC, json.dumps({**comment, "author": None})),
        (fv.VIDEO_TOPIC, "no json"), (fv.VIDEO_TOPIC, '{"id": "q"}'), (fv.VIDEO_TOPIC, "[1]"),
        (fv.SHORT_POST_TOPIC, json.dumps(short)), (fv.SHORT_POST_TOPIC, json.dumps(short)),
        (fv.AIR_DAILY_TOPIC, json.dumps(day)),
        (fv.AIR_DAILY_TOPIC, json.dumps({**day, "value": 2.5, "ingested_at_utc": "2024-01-11T00:00:00"})),
    ]


def test_payloads_of_one_topic_are_told_apart(spark, folder):
    rows = [(t, None, bytearray(v.encode()), START) for t, v in mixed_messages()]
    rows.append((fv.VIDEO_TOPIC, None, None, START))
    rows.append(("some_topic", None, bytearray(b"{}"), START))
    frame = spark.createDataFrame(rows, schemas.ENVELOPE)
    found = [(r["shape"], r["reject_reason"]) for r in shapes.with_shape(frame).collect()]
    comment, none, unknown = (shapes.VIDEO_COMMENT, None), (None, shapes.NOT_JSON), (None, shapes.UNKNOWN)
    assert found == [
        comment, (shapes.POST, None), comment, comment, none, unknown, unknown,
        (shapes.SHORT_POST, None), (shapes.SHORT_POST, None), (shapes.AIR_DAY, None), (shapes.AIR_DAY, None), none, unknown,
    ]
    plan = shapes.with_shape(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 1


def test_payload_jobs_keep_one_row_per_key_and_all_rejects(spark, folder):
    landed, out = folder("landed"), folder("out")
    messages = mixed_messages()
    land(spark, landed, messages[:5], "a")
    land(spark, landed, messages[5:], "b")
    args = ["payloads", "--landed", landed, "--out", out, "--checkpoints", folder("ck"), "--once"]
    main.run(spark, main.arguments([*args, "--health-out", folder("health")]))
    comments = jobs.read_payloads(spark, out, "video_comments").collect()
    assert sorted((r["author_normalized"] or "", r["body_normalized"]) for r in comments) == [("", "back bay"), ("a", "back bay")]
    assert all(r["post_id"].startswith("v:") and r["event_time_utc"].hour == 1 for r in comments)
    short, = jobs.read_payloads(spark, out, "short_posts").collect()
    assert (short["post_id"], short["author_normalized"], short["body_normalized"]) == ("7", "u", "hot")
    day, = jobs.read_payloads(spark, out, "air_days").collect()
    assert (day["sensor_id"], day["value"], day["event_time_utc"].day) == (3, 2.5, 9)
    rejects = spark.read.parquet(f"{out}/rejects/{fv.VIDEO_TOPIC}").collect()
    assert sorted((r["reject_reason"], r["value"]) for r in rejects) == [
        (shapes.NOT_JSON, "no json"), (shapes.UNKNOWN, "[1]"), (shapes.UNKNOWN, '{"id": "q"}')]

    records = health.read_health(spark, folder("health"))
    seen = records.filter("event = 'cycle_complete'").groupBy("stream").agg(
        F.sum("records_sent").alias("n"), F.sum("rejects").alias("bad"), F.sum("not_json").alias("text"),
        F.min("lag_sec").alias("lag"))
    by_stream = {r["stream"]: r for r in seen.collect()}
    videos = by_stream["video_comments"]
    assert (videos["n"], videos["bad"], videos["text"]) == (7, 3, 1) and videos["lag"] > 0
    assert by_stream["air_days"]["bad"] == 0
    assert logs.event_rate(records).count() > 0
    last = logs.last_values(records).filter("stream = 'short_posts'")
    assert last.count() > 0
