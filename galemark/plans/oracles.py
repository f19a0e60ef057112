"""SQL counterpart of every registered query, over the same tables.

Written from the definitions alone: the derived inputs below restate the views of `inputs` in SQL.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Derived inputs, by name; `sql` prepends those that a query mentions.
VIEWS = {
    "ev": "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "weather_raw": """
        SELECT event_id, ts AS event_time,
               CASE event_type WHEN 'click' THEN ' Boston, USA' WHEN 'view' THEN 'North BOSTON '
                    WHEN 'purchase' THEN 'Cambridge' WHEN 'error' THEN 'boston' END AS location,
               floor(value * 4) / 16.0::DOUBLE - 25 AS temperature,
               (event_id % 101)::DOUBLE AS humidity,
               k * 0.75::DOUBLE AS precipitation,
               event_id % 100 AS weather_code,
               CASE WHEN event_id % 50 <> 0 THEN (event_id % 180) / 8.0::DOUBLE END AS wind_speed
        FROM ev""",
    "weather_clean": """
        SELECT lower(trim(location)) AS location_normalized, 'boston' AS city,
               'massachusetts' AS region, 'usa' AS country, event_time AS event_time_utc,
               temperature AS temperature_celsius, humidity, precipitation, weather_code,
               wind_speed, 'weather_raw' AS source_topic
        FROM weather_raw WHERE contains(lower(location), 'boston')""",
    "weather": """
        SELECT *,
               temperature_celsius - (0.55::DOUBLE * (1 - 0.16::DOUBLE * wind_speed))
                   * (temperature_celsius - 14.1::DOUBLE) AS feels_like_temp,
               CASE WHEN wind_speed < 1 THEN 'Calm' WHEN wind_speed < 2 THEN 'Light'
                    WHEN wind_speed < 5 THEN 'Gentle' WHEN wind_speed < 8 THEN 'Moderate'
                    WHEN wind_speed < 11 THEN 'Fresh' WHEN wind_speed < 14 THEN 'Strong'
                    WHEN wind_speed < 17 THEN 'Gale' ELSE 'Storm' END AS wind_category,
               CASE WHEN wind_speed >= 14 THEN 'High wind anomaly'
                    WHEN precipitation > 50 THEN 'Heavy precipitation anomaly'
                    WHEN temperature_celsius > 35 OR temperature_celsius < -15
                    THEN 'Extreme temperature anomaly' ELSE 'Normal' END AS weather_anomaly
        FROM weather_clean""",
    "air_raw": """
        SELECT CASE WHEN event_id % 3 <> 0 THEN 'North Boston' END AS location,
               CASE event_id % 5 WHEN 0 THEN ' PM25' WHEN 1 THEN 'pm10 ' WHEN 2 THEN 'O3'
                    WHEN 3 THEN 'no2' END AS parameter,
               value, 'ug/m3' AS unit,
               42.25::DOUBLE + (event_id % 64) / 256.0::DOUBLE AS latitude,
               -71.25::DOUBLE + (event_id % 32) / 128.0::DOUBLE AS longitude,
               CASE WHEN event_id % 7 <> 0 THEN 'Boston' END AS city, 'US' AS country,
               ts AS event_time
        FROM ev""",
    "air_clean": """
        SELECT 'boston' AS city, 'massachusetts' AS region, 'usa' AS country,
               lower(trim(parameter)) AS parameter_normalized, value, unit, latitude, longitude,
               event_time AS event_time_utc, 'air_raw' AS source_topic
        FROM air_raw
        WHERE lower(city) LIKE '%boston%' OR lower(location) LIKE '%boston%'""",
    "air_classed": """
        SELECT *,
               CASE parameter_normalized
                   WHEN 'pm25' THEN CASE WHEN value <= 12 THEN 'Good' WHEN value <= 35.4::DOUBLE
                       THEN 'Moderate' WHEN value <= 55.4::DOUBLE THEN
                       'Unhealthy for Sensitive Groups' WHEN value <= 150.4::DOUBLE THEN 'Unhealthy'
                       ELSE 'Very Unhealthy' END
                   WHEN 'pm10' THEN CASE WHEN value <= 50 THEN 'Good' WHEN value <= 150
                       THEN 'Moderate' WHEN value <= 250 THEN 'Unhealthy for Sensitive Groups'
                       WHEN value <= 350 THEN 'Unhealthy' ELSE 'Very Unhealthy' END
                   WHEN 'o3' THEN CASE WHEN value <= 54 THEN 'Good' WHEN value <= 70
                       THEN 'Moderate' WHEN value <= 85 THEN 'Unhealthy for Sensitive Groups'
                       WHEN value <= 105 THEN 'Unhealthy' ELSE 'Very Unhealthy' END
                   ELSE 'Not Classified' END AS aqi_category
        FROM air_clean""",
    "bands": """
        SELECT * FROM (VALUES
            ('pm25', 0, 12, 0, 50), ('pm25', 12, 35.4, 50, 100), ('pm25', 35.4, 55.4, 100, 150),
            ('pm25', 55.4, 150.4, 150, 200), ('pm25', 150.4, 250.4, 200, 300),
            ('pm10', 0, 50, 0, 50), ('pm10', 50, 150, 50, 100), ('pm10', 150, 250, 100, 150),
            ('pm10', 250, 350, 150, 200), ('pm10', 350, 424, 200, 300),
            ('o3', 0, 54, 0, 50), ('o3', 54, 70, 50, 100), ('o3', 70, 85, 100, 150),
            ('o3', 85, 105, 150, 200), ('o3', 105, 200, 200, 300)
        ) AS b(pollutant, lo, hi, ilo, ihi)""",
    "air": """
        SELECT a.*,
               coalesce(a.value > 100, false) AS pollution_spike,
               (CASE aqi_category WHEN 'Good' THEN 0 WHEN 'Moderate' THEN 1
                    WHEN 'Unhealthy for Sensitive Groups' THEN 2 WHEN 'Unhealthy' THEN 3
                    WHEN 'Very Unhealthy' THEN 4 ELSE -1 END)::INTEGER AS health_risk_level,
               CASE WHEN a.value IS NULL THEN NULL ELSE (
                   SELECT max(ilo + (CASE WHEN ihi = 300 THEN greatest(a.value, 0)
                              ELSE least(greatest(a.value, 0), hi) END - lo) * (ihi - ilo)
                              / (hi - lo)::DOUBLE)
                   FROM bands
                   WHERE pollutant = a.parameter_normalized
                     AND (greatest(a.value, 0) > lo OR lo = 0)) END AS aqi_score
        FROM air_classed a""",
    "social": """
        SELECT doc_id, doc_id::VARCHAR AS id, split_part(text, chr(10), 1) AS title,
               ' ' || upper(source) || ' ' AS author, text AS body, source,
               CASE WHEN doc_id % 17 <> 0 THEN n_chars END AS upvotes,
               1704067200000 + (doc_id % 30) * 86400000 + doc_id * 60000 AS "timestamp",
               make_timestamp((1704067200000 + (doc_id % 30) * 86400000 + doc_id * 60000) * 1000)
                   AS event_time,
               'https://example.org/' || doc_id AS url
        FROM documents""",
    "social_clean": """
        SELECT id, {normal:title} AS title_normalized, {normal:body} AS body_normalized,
               lower(trim(author)) AS author_normalized, 'youtube_raw' AS source_topic, upvotes,
               'boston' AS city, 'massachusetts' AS region, 'usa' AS country,
               event_time AS event_time_utc, url
        FROM social""",
    "posts": """
        SELECT c.id AS post_id, c.title_normalized, c.body_normalized, c.author_normalized,
               s.source, c.event_time_utc, c.upvotes,
               concat_ws(' ', c.title_normalized, c.body_normalized) AS said
        FROM social_clean c JOIN social s ON c.id = s.id""",
    "posts_tagged": """
        SELECT *,
               list_filter(['climate change', 'global warming', 'air pollution', 'heat wave',
                   'environment', 'Then', 'that', 'lean', 'Keit'],
                   lambda w: list_contains(regexp_extract_all(said,
                       '\\b(climate change|global warming|air pollution|heat wave|environment|then|that|lean|keit)\\b'),
                       lower(w))) AS keywords,
               list_filter(['Allston', 'Back Bay', 'Beacon Hill', 'Brighton', 'Charlestown',
                   'Chinatown', 'Dorchester', 'Downtown', 'East Boston', 'Fenway', 'Hyde Park',
                   'Jamaica Plain', 'Mattapan', 'Mission Hill', 'North End', 'Roslindale',
                   'Roxbury', 'South Boston', 'South End', 'West End', 'West Roxbury', 'Anes',
                   'Edin', 'Lean', 'Teen'],
                   lambda w: list_contains(regexp_extract_all(said,
                       '\\b(west roxbury|allston|back bay|beacon hill|brighton|charlestown|chinatown|dorchester|downtown|east boston|fenway|hyde park|jamaica plain|mattapan|mission hill|north end|roslindale|roxbury|south boston|south end|west end|anes|edin|lean|teen)\\b'),
                       lower(w))) AS regions_detected
        FROM posts""",
    "sentiment_raw": """
        SELECT doc_id::VARCHAR AS post_id,
               CASE WHEN doc_id % 11 <> 0 THEN (doc_id % 100) / 100.0::DOUBLE END
                   AS sentiment_score,
               CASE WHEN toxic = 1 THEN ' Negative' WHEN quality = 1 THEN 'Positive '
                    WHEN doc_id % 2 = 0 THEN 'NEUTRAL' END AS sentiment_label,
               make_timestamp((1704067200000 + (doc_id % 30) * 86400000 + doc_id * 60000) * 1000)
                   AS event_time
        FROM labels""",
    "sentiment": """
        SELECT post_id, lower(trim(sentiment_label)) AS sentiment_label, sentiment_score,
               event_time AS event_time_utc
        FROM sentiment_raw""",
    "served_sentiment": """
        SELECT s.post_id, s.event_time_utc, s.sentiment_label,
               coalesce(s.sentiment_label, 'neutral') AS sentiment_category,
               coalesce(s.sentiment_score, 0) AS sentiment_confidence_pct,
               coalesce(p.upvotes * 0.8::DOUBLE, 0) AS engagement_score
        FROM sentiment s LEFT JOIN social p ON s.post_id = p.id""",
    "forum_posts": """
        SELECT conv_id::VARCHAR AS id, split_part(text, chr(10), 1) AS title,
               CASE WHEN conv_id % 5 <> 0 THEN 'user_' || conv_id END AS author,
               text AS selftext, 'r' || (conv_id % 4) AS subreddit, length(text) AS upvotes,
               conv_id % 3 AS downvotes, conv_id % 10 = 0 AS over_18,
               1704067200::DOUBLE + conv_id * 3600 + 0.5::DOUBLE AS "timestamp",
               make_timestamp(1704067200000000 + conv_id * 3600000000 + 500000) AS event_time,
               '/r/' || conv_id AS permalink
        FROM conversations WHERE turn = 0""",
    "forum_comments": """
        SELECT conv_id || '-' || turn AS id, 't1_' || conv_id || '-' || turn AS name,
               role AS author, text AS body, 'r' || (conv_id % 4) AS subreddit,
               length(text) AS upvotes, turn % 3 AS downvotes, false AS over_18,
               1704067200::DOUBLE + conv_id * 3600 + turn * 60 + 0.25::DOUBLE AS "timestamp",
               make_timestamp(1704067200000000 + conv_id * 3600000000 + turn * 60000000 + 250000)
                   AS event_time,
               '/r/' || conv_id || '/' || turn AS permalink,
               CASE WHEN conv_id % 13 = 0 THEN 'x' || conv_id ELSE conv_id::VARCHAR END AS post_id
        FROM conversations WHERE turn > 0""",
    "short_posts": """
        SELECT 'x' || doc_id AS id, replace(text, '. ', '. #') AS text, 'x' AS platform
        FROM documents""",
    "log_raw": """
        SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_utc,
               CASE event_id % 4 WHEN 0 THEN 'weather_ingest' WHEN 1 THEN 'air_ingest'
                    WHEN 2 THEN 'youtube_ingest' ELSE 'spark_processor' END AS component,
               CASE event_id % 3 WHEN 0 THEN 'send_success' WHEN 1 THEN 'cycle_complete'
                    ELSE 'cycle_begin' END AS event,
               event_type AS stream, event_id AS cycle,
               CASE WHEN event_id % 25 = 0 THEN 0 ELSE value / 10 END AS elapsed_sec,
               k::BIGINT AS records_sent, 300::BIGINT AS sleep_sec, ts
        FROM ev""",
    "log": """
        SELECT *, CASE WHEN elapsed_sec > 0 THEN round(records_sent / elapsed_sec, 3) ELSE 0 END
               AS throughput_rps
        FROM log_raw""",
    "sensor_locations": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 6 <> 0 THEN c_name END AS name,
               CASE WHEN c_custkey % 10 <> 0
                    THEN 42.3601::DOUBLE + ((c_custkey % 200) - 100) / 256.0::DOUBLE END AS latitude,
               CASE WHEN c_custkey % 10 <> 0
                    THEN -71.0589::DOUBLE + ((c_custkey % 320) - 160) / 256.0::DOUBLE END
                    AS longitude
        FROM customer""",
    "sensors": """
        SELECT l.id * 3 + s.i AS sensor_id, l.id AS location_id,
               coalesce(l.name, 'Unknown') AS location_name,
               CASE WHEN (l.id + s.i) % 11 <> 0 AND s.i = 0 THEN 'pm25'
                    WHEN (l.id + s.i) % 11 <> 0 AND s.i = 1 THEN 'o3' ELSE 'unknown' END
                    AS parameter_name,
               CASE WHEN (l.id + s.i) % 11 <> 0 AND s.i < 2 THEN 'ug/m3' ELSE '' END
                    AS parameter_units,
               CASE WHEN (l.id + s.i) % 11 <> 0 AND s.i = 0 THEN 'PM2.5'
                    WHEN (l.id + s.i) % 11 <> 0 AND s.i = 1 THEN 'o3' ELSE 'unknown' END
                    AS parameter_display,
               l.latitude, l.longitude
        FROM sensor_locations l JOIN (VALUES (0), (1), (2)) AS s(i) ON s.i < l.id % 4""",
    "weekly": """
        SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, location AS loc,
               avg(temperature) AS temp_7d_avg, avg(humidity) AS humidity_7d_avg
        FROM (SELECT *, date_trunc('day', event_time) - to_days(d::INTEGER) AS window_start
              FROM weather_raw, range(7) AS r(d))
        GROUP BY window_start, location""",
    "daily": """
        SELECT strftime(dt, '%Y-%m-%d') AS date, 'boston' AS city,
               avg_temperature, avg_feels_like, max_temperature, min_temperature, avg_humidity,
               total_precipitation, avg_wind_speed, avg_aqi_score, avg_health_risk,
               coalesce(num_social_posts, 0) AS num_social_posts, avg_sentiment_confidence,
               coalesce(positive_posts, 0) AS positive_posts,
               coalesce(negative_posts, 0) AS negative_posts,
               coalesce(neutral_posts, 0) AS neutral_posts,
               coalesce(anomaly_count, 0) AS anomaly_count,
               coalesce(pollution_spike_count, 0) AS pollution_spike_count
        FROM (SELECT event_time_utc::DATE AS dt, avg(temperature_celsius) AS avg_temperature,
                     avg(feels_like_temp) AS avg_feels_like,
                     max(temperature_celsius) AS max_temperature,
                     min(temperature_celsius) AS min_temperature, avg(humidity) AS avg_humidity,
                     sum(precipitation) AS total_precipitation, avg(wind_speed) AS avg_wind_speed,
                     count(*) FILTER (weather_anomaly <> 'Normal') AS anomaly_count
              FROM weather GROUP BY dt)
        FULL JOIN (SELECT event_time_utc::DATE AS dt, avg(aqi_score) AS avg_aqi_score,
                     avg(health_risk_level) FILTER (health_risk_level >= 0) AS avg_health_risk,
                     count(*) FILTER (pollution_spike) AS pollution_spike_count
              FROM air GROUP BY dt) USING (dt)
        FULL JOIN (SELECT event_time::DATE AS dt, count(DISTINCT id) AS num_social_posts
              FROM social GROUP BY dt) USING (dt)
        FULL JOIN (SELECT event_time_utc::DATE AS dt,
                     avg(sentiment_score) AS avg_sentiment_confidence,
                     count(*) FILTER (sentiment_label = 'positive') AS positive_posts,
                     count(*) FILTER (sentiment_label = 'negative') AS negative_posts,
                     count(*) FILTER (sentiment_label IS NULL
                         OR sentiment_label NOT IN ('positive', 'negative')) AS neutral_posts
              FROM sentiment GROUP BY dt) USING (dt)""",
    "paired": """
        SELECT *,
               CASE WHEN avg_temperature IS NOT NULL THEN avg_sentiment_confidence END AS mood_w,
               CASE WHEN avg_sentiment_confidence IS NOT NULL THEN avg_temperature END AS temp_w,
               CASE WHEN avg_aqi_score IS NOT NULL THEN avg_sentiment_confidence END AS mood_p,
               CASE WHEN avg_sentiment_confidence IS NOT NULL THEN avg_aqi_score END AS aqi_p
        FROM daily""",
    "corr": """
        SELECT date, city,
               covar_pop(mood_w, temp_w) OVER w
                   / nullif(stddev_pop(mood_w) OVER w * stddev_pop(temp_w) OVER w, 0)
                   AS weather_corr,
               covar_pop(mood_p, aqi_p) OVER w
                   / nullif(stddev_pop(mood_p) OVER w * stddev_pop(aqi_p) OVER w, 0)
                   AS pollution_corr
        FROM paired
        WINDOW w AS (PARTITION BY city ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "hourly": """
        SELECT location_normalized AS location, date_trunc('hour', event_time_utc) AS window_ts,
               temperature_celsius, humidity, event_time_utc AS written_at
        FROM weather""",
    "grid": """
        SELECT l.*, to_timestamp_grid(l.ts, g.s) AS grid_time
        FROM log l, range(5) AS g(s)""",
}

# Grid time of step s at or after a record: the next full minute plus s minutes.
VIEWS["grid"] = VIEWS["grid"].replace(
    "to_timestamp_grid(l.ts, g.s)",
    "make_timestamp((CAST(ceil(epoch_us(l.ts) / 60000000.0::DOUBLE) AS BIGINT) + g.s) * 60000000)",
)


def _normal(column: str) -> str:
    """Normalized text of a column: no links, ASCII letters, digits and blanks, trimmed, lower."""
    unlinked = f"regexp_replace({column}, 'http\\S+|www\\S+', '', 'g')"
    plain = f"lower(regexp_replace({unlinked}, '[^a-zA-Z0-9\\s]', '', 'g'))"
    return f"coalesce(regexp_replace({plain}, '^\\s+|\\s+$', '', 'g'), '')"


VIEWS["social_clean"] = VIEWS["social_clean"].replace("{normal:title}", _normal("title")).replace(
    "{normal:body}", _normal("body")
)


def sql(query: str) -> str:
    """The query with the derived inputs it needs, in dependency order."""
    import re

    wanted: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in wanted and re.search(rf"(FROM|JOIN)\s+{name}\b", text):
                visit(body)
                if name not in wanted:
                    wanted.append(name)

    visit(query)
    if not wanted:
        return query.strip()
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in wanted) + query


def oracle(name: str, query: str) -> None:
    ORACLES[name] = sql(query)


# Sources.

oracle("demux_count", """
    SELECT * FROM (
    SELECT 'weather_raw' AS topic, count(*) AS messages FROM weather_raw
    UNION ALL SELECT 'air_raw', count(*) FROM air_raw
    UNION ALL SELECT 'youtube_raw', count(*) FROM social
    UNION ALL SELECT 'sentiment_scored', count(*) FROM sentiment_raw
    UNION ALL SELECT 'reddit_posts', count(*) FROM forum_posts
    UNION ALL SELECT 'reddit_comments', count(*) FROM forum_comments) WHERE messages > 0""")
oracle("parse_weather", """
    SELECT location, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp_utc, temperature,
           humidity, precipitation, weather_code, wind_speed, event_time AS kafka_timestamp,
           event_time, 'weather_raw' AS source_topic, true AS is_valid
    FROM weather_raw""")
oracle("parse_air", """
    SELECT location, parameter, value, unit,
           strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp_utc, latitude, longitude,
           city, country, event_time AS kafka_timestamp, event_time, 'air_raw' AS source_topic,
           true AS is_valid
    FROM air_raw""")
oracle("parse_social", """
    SELECT id, title, author, body, source, upvotes, "timestamp", url,
           event_time AS kafka_timestamp, event_time, 'youtube_raw' AS source_topic,
           true AS is_valid
    FROM social""")
oracle("parse_sentiment", """
    SELECT post_id, sentiment_score, sentiment_label,
           strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp_utc,
           event_time AS kafka_timestamp, event_time, 'sentiment_scored' AS source_topic,
           true AS is_valid
    FROM sentiment_raw""")
oracle("parse_posts", """
    SELECT id, title, author, selftext, subreddit, upvotes, downvotes, over_18, "timestamp",
           permalink, event_time AS kafka_timestamp, event_time, 'reddit_posts' AS source_topic,
           true AS is_valid
    FROM forum_posts""")
oracle("parse_comments", """
    SELECT id, name, author, body, subreddit, upvotes, downvotes, over_18, "timestamp", permalink,
           post_id, event_time AS kafka_timestamp, event_time,
           'reddit_comments' AS source_topic, true AS is_valid
    FROM forum_comments""")
oracle("valid_rows", """
    SELECT location, event_time, temperature, humidity, 'weather_raw' AS source_topic
    FROM weather_raw
    WHERE location IS NULL OR (location <> 'Cambridge' AND NOT contains(location, 'North'))""")
oracle("rejected_rows", """
    SELECT event_time AS kafka_timestamp,
           CASE WHEN location = 'Cambridge' THEN 'no event time' ELSE 'not json' END
               AS reject_reason
    FROM weather_raw WHERE location = 'Cambridge' OR contains(location, 'North')""")
oracle("scan_city", """
    SELECT 'boston' AS city, event_time AS event_time_utc, temperature, humidity, wind_speed
    FROM weather_raw WHERE lower(trim(split_part(location, ',', 1))) = 'boston'""")
oracle("log_scan", """
    SELECT ts_utc, component, event, stream, cycle, elapsed_sec, records_sent, throughput_rps,
           sleep_sec, ts
    FROM log""")

# Payloads.

oracle("flatten_sensors", "\n    SELECT * FROM sensors")
oracle("flatten_daily", """
    SELECT e.user_id AS sensor_id, s.location_id, s.location_name, s.latitude, s.longitude,
           CASE WHEN full_row THEN event_id % 6 END AS parameter_id,
           CASE WHEN full_row THEN event_type END AS parameter_name,
           CASE WHEN full_row THEN 'ppm' END AS parameter_units,
           CASE WHEN full_row THEN upper(event_type) END AS parameter_display,
           CASE WHEN full_row THEN value ELSE value / 2 END AS value,
           full_row AND event_id % 4 = 0 AS has_flags,
           CASE WHEN full_row THEN 'raw' END AS period_label,
           CASE WHEN full_row THEN '24:00:00' END AS period_interval,
           CASE WHEN full_row THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS datetime_from_utc,
           CASE WHEN full_row THEN strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S.%f') END
               AS datetime_from_local,
           NULL::VARCHAR AS datetime_to_utc, NULL::VARCHAR AS datetime_to_local,
           CASE WHEN summed THEN value - 1 END AS summary_min,
           CASE WHEN summed THEN value - 0.75::DOUBLE END AS summary_q02,
           CASE WHEN summed THEN value - 0.5::DOUBLE END AS summary_q25,
           CASE WHEN summed THEN value END AS summary_median,
           CASE WHEN summed THEN value + 0.5::DOUBLE END AS summary_q75,
           CASE WHEN summed THEN value + 0.75::DOUBLE END AS summary_q98,
           CASE WHEN summed THEN value + 1 END AS summary_max,
           CASE WHEN summed THEN value END AS summary_avg,
           CASE WHEN summed THEN 0.5::DOUBLE END AS summary_sd,
           CASE WHEN full_row THEN 24::BIGINT END AS coverage_expected_count,
           CASE WHEN full_row THEN '24:00:00' END AS coverage_expected_interval,
           CASE WHEN full_row THEN event_id % 25 END AS coverage_observed_count,
           CASE WHEN full_row THEN '20:00:00' END AS coverage_observed_interval,
           CASE WHEN full_row THEN (event_id % 101)::DOUBLE END AS coverage_percent_complete,
           CASE WHEN full_row THEN (event_id % 99)::DOUBLE END AS coverage_percent_coverage,
           CASE WHEN full_row THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END
               AS coverage_datetime_from_utc,
           NULL::VARCHAR AS coverage_datetime_to_utc
    FROM (SELECT *, full_row AND event_id % 9 <> 0 AS summed
          FROM events, (VALUES (true), (false)) AS v(full_row)) e
    JOIN sensors s ON s.sensor_id = e.user_id""")
oracle("enrich_sensor", """
    SELECT s.*, e.ts AS event_time, e.value
    FROM events e JOIN sensors s ON s.sensor_id = e.user_id""")
oracle("explode_measurements", """
    SELECT 'Boston' AS city, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp_utc,
           's' || user_id AS sensor_id, event_id % 8 AS location_id, 'Downtown' AS location_name,
           event_type AS parameter_name, 'ug/m3' AS parameter_units, value + i AS value,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS datetime_utc, 42.25::DOUBLE AS latitude,
           -71.25::DOUBLE AS longitude, 'station' AS source
    FROM events, range(2) AS r(i)""")
oracle("hourly_first", """
    SELECT 'station ' || user_id AS location,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp_utc, value AS temperature,
           k::DOUBLE AS humidity, 0::DOUBLE AS precipitation, event_id % 100 AS weather_code,
           value / 8 AS wind_speed
    FROM ev WHERE event_type <> 'error'""")
oracle("hourly_explode", """
    SELECT 'station ' || user_id AS location,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp_utc, h::INTEGER AS hour,
           value + h AS temperature, (k + h)::DOUBLE AS humidity,
           CASE WHEN event_type = 'error' OR (event_type = 'view' AND h = 2) THEN NULL
                ELSE k * 0.5::DOUBLE * h END AS precipitation,
           event_id % (100 // (1 << h)) AS weather_code,
           value / (8 // (1 << h)) AS wind_speed
    FROM ev, (VALUES (0), (1), (2)) AS r(h)""")
oracle("flatten_comments", """
    SELECT 'v' || conv_id AS video_id, CASE WHEN i = 0 THEN role END AS author, text,
           '2024-01-01T00:00:00' AS published_at, turn AS cycle
    FROM conversations, range(2) AS r(i)""")
oracle("keyword_prefilter", """
    SELECT id, title, author, selftext, subreddit FROM forum_posts
    WHERE regexp_matches(lower(title) || chr(10) || lower(selftext), 'thou|nicht|para')""")
oracle("hashtags", """
    SELECT id, coalesce(array_to_string(list_filter(regexp_split_to_array(text, '\\s+'),
           lambda w: starts_with(w, '#')), ','), '') AS hashtags
    FROM short_posts""")
oracle("parent_id", """
    SELECT id, name, post_id, id AS own_id, NULL::VARCHAR AS no_id FROM forum_comments""")
oracle("within_radius", """
    SELECT * REPLACE (round(distance_km, 6) AS distance_km)
    FROM (SELECT *, 2 * 6371.0::DOUBLE * asin(sqrt(least(
              pow(sin(radians(latitude - 42.3601::DOUBLE) / 2), 2)
              + cos(radians(42.3601::DOUBLE)) * cos(radians(latitude))
              * pow(sin(radians(longitude + 71.0589::DOUBLE) / 2), 2), 1))) AS distance_km
          FROM sensors)
    WHERE distance_km <= 25 ORDER BY distance_km, sensor_id LIMIT 5""")
oracle("to_envelope", """
    SELECT 'sentiment_scored' AS topic, post_id AS key, event_time AS "timestamp",
           sentiment_label, sentiment_score
    FROM sentiment_raw""")
oracle("union_sources", """
    SELECT id, title, body, source, upvotes FROM social
    UNION ALL SELECT 'f' || id, title, selftext, 'forum', upvotes FROM forum_posts
    UNION ALL SELECT id, NULL, text, 'x', NULL FROM short_posts""")

# Cleaning.

oracle("normalize_text", f"""
    SELECT 'document' AS kind, doc_id AS id, {_normal('text')} AS normalized FROM documents
    UNION ALL SELECT 'page', page_id, {_normal('html')} FROM pages""")
oracle("clean_weather", "\n    SELECT * FROM weather_clean")
oracle("clean_air", "\n    SELECT * RENAME (value AS value_standard_unit) FROM air_clean")
oracle("clean_social", "\n    SELECT * FROM social_clean")
oracle("clean_sentiment", "\n    SELECT * FROM sentiment")

# Enrichment.

oracle("weather_enriched", "\n    SELECT * FROM weather")
oracle("aqi_category", """
    SELECT parameter_normalized, aqi_category, count(*) AS readings, min(value) AS lowest,
           max(value) AS highest
    FROM air_classed GROUP BY ALL""")
oracle("aqi_range_join", """
    SELECT event_time_utc, parameter_normalized, value AS value_standard_unit, aqi_category
    FROM air_classed""")
oracle("air_enriched", "\n    SELECT * EXCLUDE (aqi_score) FROM air")
oracle("aqi_score", """
    SELECT event_time_utc, parameter_normalized, value, round(aqi_score, 6) AS aqi_score FROM air""")
oracle("social_enriched", """
    SELECT *, upvotes * 0.8::DOUBLE AS engagement_score,
           length(body_normalized)::INTEGER AS text_length, body_normalized AS text_for_bert
    FROM social_clean""")
oracle("prepare_weather", """
    SELECT city, event_time_utc, temperature_celsius, feels_like_temp, humidity, precipitation,
           wind_speed, wind_category, weather_anomaly, weather_code
    FROM weather""")
oracle("prepare_air", """
    SELECT city, event_time_utc, parameter_normalized, value, aqi_category, health_risk_level,
           pollution_spike
    FROM air""")
oracle("prepare_social", """
    SELECT id AS post_id, title_normalized, body_normalized, author_normalized,
           source_topic AS source, event_time_utc, upvotes, url
    FROM social_clean""")
oracle("keywords_detect", """
    SELECT post_id, coalesce(array_to_string(keywords, ','), '') AS keywords FROM posts_tagged""")
oracle("regions_detect", """
    SELECT post_id, coalesce(array_to_string(regions_detected, ','), '') AS regions_detected
    FROM posts_tagged""")
oracle("softmax_label", """
    SELECT vec_id, label,
           'class_' || lpad((list_position(embedding, list_max(embedding)) - 1)::VARCHAR, 2, '0')
               AS sentiment_label,
           round(1 / list_sum(list_transform(embedding,
               lambda z: exp(z::DOUBLE - list_max(embedding)::DOUBLE))), 9) AS sentiment_score
    FROM embeddings""")
oracle("sentiment_serving", "\n    SELECT * FROM served_sentiment")
oracle("training_set", f"""
    SELECT post_id, text, quality, toxic
    FROM (SELECT l.doc_id AS post_id, {_normal('d.text')} AS text, l.quality, l.toxic
          FROM documents d JOIN labels l USING (doc_id))
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY post_id) = 1""")

# Aggregations.

oracle("avg_7d_sliding", "\n    SELECT * FROM weekly")
oracle("sentiment_summary", """
    SELECT count(*) AS total_posts,
           count(*) FILTER (label = 'positive') AS positive,
           count(*) FILTER (label = 'negative') AS negative,
           count(*) FILTER (label NOT IN ('positive', 'negative')) AS neutral,
           round(100.0 * count(*) FILTER (label = 'positive') / count(*), 2)::DOUBLE AS positive_pct,
           round(100.0 * count(*) FILTER (label = 'negative') / count(*), 2)::DOUBLE AS negative_pct,
           round(100.0 * count(*) FILTER (label NOT IN ('positive', 'negative')) / count(*), 2)::DOUBLE
               AS neutral_pct,
           round(avg(coalesce(sentiment_score, 0)), 2) AS avg_confidence
    FROM (SELECT *, coalesce(sentiment_label, 'neutral') AS label FROM sentiment)
    WHERE event_time_utc >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 DAY""")
oracle("table_counts", """
    SELECT 'weather_data' AS table_name, count(*) AS row_count FROM weather
    UNION ALL SELECT 'air_quality_data', count(*) FROM air_clean
    UNION ALL SELECT 'social_posts', count(*) FROM social
    UNION ALL SELECT 'social_sentiment', count(*) FROM sentiment
    UNION ALL SELECT 'daily_aggregates', 0""")
oracle("count_total", "\n    SELECT count(*) AS value FROM weather")
oracle("avg_confidence_band", """
    SELECT round(value, 6) AS value,
           CASE WHEN value >= 75 THEN 'green' WHEN value >= 50 THEN 'yellow' ELSE 'red' END AS band
    FROM (SELECT avg(sentiment_score) * 100 AS value FROM sentiment)""")
oracle("label_counts", """
    SELECT sentiment_label, count(*) AS count FROM sentiment GROUP BY sentiment_label""")
oracle("label_display", """
    SELECT post_id, sentiment_label,
           CASE sentiment_label WHEN 'positive' THEN '✅ Positive' WHEN 'negative' THEN '❌ Negative'
                WHEN 'neutral' THEN '➖ Neutral' ELSE sentiment_label END AS label_text
    FROM sentiment""")
oracle("temp_summary", """
    SELECT location_normalized AS city, avg(temperature_celsius) AS mean,
           max(temperature_celsius) AS max, min(temperature_celsius) AS min
    FROM weather GROUP BY location_normalized""")
oracle("last_non_null", """
    SELECT location, arg_max(wind_speed, event_time) FILTER (wind_speed IS NOT NULL) AS wind_speed
    FROM weather_raw GROUP BY location""")
_DAILY = """* REPLACE (round(avg_feels_like, 6) AS avg_feels_like,
           round(avg_aqi_score, 6) AS avg_aqi_score,
           round(avg_sentiment_confidence, 6) AS avg_sentiment_confidence)"""
oracle("daily_aggregates", f"""
    SELECT {_DAILY} FROM daily""")
_STRENGTH = """CASE WHEN abs({0}) >= 0.7 THEN 'strong' WHEN abs({0}) >= 0.4 THEN 'moderate'
                WHEN {0} IS NOT NULL THEN 'weak' END"""
oracle("rolling_corr", f"""
    SELECT date, city, round(weather_corr, 6) AS weather_corr,
           round(pollution_corr, 6) AS pollution_corr,
           {_STRENGTH.format('weather_corr')} AS weather_band,
           {_STRENGTH.format('pollution_corr')} AS pollution_band
    FROM corr""")
oracle("correlation_metrics", """
    SELECT count(*) FILTER (abs(weather_corr) >= 0.7) AS sentiment_weather_strong,
           0::BIGINT AS sentiment_weather_moderate, 0::BIGINT AS sentiment_weather_weak,
           count(*) FILTER (abs(pollution_corr) >= 0.7) AS sentiment_pollution_strong,
           0::BIGINT AS sentiment_pollution_moderate, 0::BIGINT AS sentiment_pollution_weak
    FROM (SELECT * FROM corr ORDER BY date DESC LIMIT 30)""")
oracle("sensor_daily_summary", """
    SELECT user_id AS sensor_id, ts::DATE AS date, min(value) AS min,
           round(quantile_cont(value, 0.02), 6) AS q02, round(quantile_cont(value, 0.25), 6) AS q25,
           round(quantile_cont(value, 0.5), 6) AS median,
           round(quantile_cont(value, 0.75), 6) AS q75, round(quantile_cont(value, 0.98), 6) AS q98,
           max(value) AS max, round(avg(value), 6) AS avg, round(stddev_samp(value), 6) AS sd,
           24::BIGINT AS expected_count, count(*) AS observed_count,
           round(count(*) / 24.0::DOUBLE * 100, 6) AS percent_complete
    FROM events GROUP BY user_id, ts::DATE""")

# Logs.

oracle("cycle_throughput", """
    SELECT cycle, records_sent, elapsed_sec, throughput_rps FROM log""")
oracle("log_rate", """
    SELECT grid_time, component, count(*) / 300.0::DOUBLE AS events_per_second
    FROM grid WHERE event = 'send_success' GROUP BY ALL""")
oracle("log_avg_throughput", """
    SELECT grid_time, stream, round(avg(throughput_rps), 6) AS throughput_rps
    FROM grid WHERE event = 'send_success' AND component = 'spark_processor' GROUP BY ALL""")
oracle("log_cycle_duration", """
    SELECT grid_time, component, round(avg(mean), 6) AS elapsed_sec
    FROM (SELECT grid_time, component, stream, avg(elapsed_sec) AS mean FROM grid
          WHERE event = 'cycle_complete' GROUP BY ALL)
    GROUP BY ALL""")
oracle("log_last_value", """
    SELECT grid_time, component, event, stream, arg_max(records_sent, ts) AS records_sent,
           arg_max(throughput_rps, ts) AS throughput_rps
    FROM grid WHERE event = 'cycle_complete' GROUP BY ALL""")
oracle("log_trailing", """
    SELECT component, ts, round(avg(throughput_rps) OVER w, 6) AS mean_throughput,
           count(*) OVER w AS n_records
    FROM log
    WINDOW w AS (PARTITION BY component ORDER BY ts
                 RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW)""")

# Joins and windows.

_READING = "r.location, r.event_time AS window_ts, r.temperature, r.humidity, r.precipitation"
oracle("join_avg_7d", f"""
    SELECT {_READING}, w.temp_7d_avg, w.humidity_7d_avg
    FROM weather_raw r
    LEFT JOIN weekly w ON r.location = w.loc AND w.window_start + INTERVAL 7 DAY = (
        SELECT max(e.window_start + INTERVAL 7 DAY) FROM weekly e
        WHERE e.loc = r.location AND e.window_start + INTERVAL 7 DAY <= date_trunc('day', r.event_time) + INTERVAL 1 DAY)
    """)
oracle("climate_metrics", f"""
    SELECT {_READING}, w.temp_7d_avg, w.humidity_7d_avg
    FROM weather_raw r
    LEFT JOIN weekly w ON r.location = w.loc
        AND w.window_start = date_trunc('day', r.event_time) - INTERVAL 6 DAY""")
oracle("posts_with_sentiment", """
    SELECT p.id AS post_id, p.title, p.source, p.upvotes, s.sentiment_label, s.sentiment_score
    FROM social p LEFT JOIN sentiment s ON p.id = s.post_id""")
oracle("comment_thread", """
    SELECT c.id, c.post_id, c.author, c.body, p.title AS post_title, p.author AS post_author
    FROM forum_comments c JOIN forum_posts p ON c.post_id = p.id""")
oracle("orphan_comments", """
    SELECT c.id, c.post_id, c.author, c.body FROM forum_comments c
    WHERE c.post_id NOT IN (SELECT id FROM forum_posts)""")
oracle("trailing_7d", """
    SELECT location, event_time, avg(temperature) OVER w AS temp_7d_avg,
           avg(humidity) OVER w AS humidity_7d_avg
    FROM weather_raw
    WINDOW w AS (PARTITION BY location ORDER BY event_time
                 RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)""")
_NEWEST = "QUALIFY row_number() OVER (PARTITION BY location, window_ts ORDER BY written_at DESC) = 1"
oracle("latest_per_key", f"""
    SELECT * FROM hourly {_NEWEST}""")
oracle("upsert_latest", f"""
    SELECT * FROM (
        SELECT * FROM hourly
        UNION ALL
        SELECT location_normalized, date_trunc('hour', event_time_utc), temperature_celsius + 0.5::DOUBLE,
               humidity, event_time_utc + INTERVAL 30 MINUTE
        FROM weather WHERE weather_anomaly <> 'Normal') {_NEWEST}""")
oracle("clustered_order", f"""
    SELECT {_READING} FROM weather_raw r""")

# Read operators.

_WEATHER = """city, event_time_utc, temperature_celsius, feels_like_temp, humidity, precipitation,
           wind_speed, wind_category, weather_anomaly"""
_AIR = """city, event_time_utc, parameter_normalized, value, unit, aqi_category,
           round(aqi_score, 6) AS aqi_score, health_risk_level, pollution_spike"""
_POST = """post_id, event_time_utc, title_normalized, body_normalized, author_normalized, source,
           coalesce(upvotes, 0) AS upvotes, coalesce(array_to_string(keywords, ','), '') AS keywords,
           coalesce(array_to_string(regions_detected, ','), '') AS regions_detected"""
oracle("weather_latest", f"""
    SELECT {_WEATHER} FROM weather ORDER BY event_time_utc DESC LIMIT 50""")
oracle("weather_latest_anomaly", f"""
    SELECT * FROM (SELECT {_WEATHER} FROM weather ORDER BY event_time_utc DESC LIMIT 50)
    WHERE weather_anomaly <> 'Normal'""")
oracle("weather_anomalies", f"""
    SELECT {_WEATHER} FROM weather WHERE weather_anomaly <> 'Normal'
    ORDER BY event_time_utc DESC LIMIT 50""")
oracle("air_latest", f"""
    SELECT * FROM (SELECT {_AIR} FROM air ORDER BY event_time_utc DESC LIMIT 100)
    WHERE pollution_spike""")
oracle("air_latest_param", f"""
    SELECT {_AIR} FROM air WHERE parameter_normalized = 'pm25'
    ORDER BY event_time_utc DESC LIMIT 50""")
oracle("pollution_spikes", f"""
    SELECT {_AIR} FROM air WHERE pollution_spike ORDER BY event_time_utc DESC LIMIT 50""")
oracle("posts_latest", f"""
    SELECT {_POST} FROM posts_tagged ORDER BY event_time_utc DESC, post_id LIMIT 20""")
oracle("posts_latest_source", f"""
    SELECT {_POST} FROM posts_tagged WHERE source = 'src3'
    ORDER BY event_time_utc DESC, post_id LIMIT 20""")
oracle("sentiment_latest", """
    SELECT * FROM served_sentiment WHERE sentiment_label = 'positive'
    ORDER BY event_time_utc DESC, post_id LIMIT 50""")
oracle("daily_merged", f"""
    SELECT {_DAILY} FROM daily""")
oracle("daily_latest", f"""
    SELECT {_DAILY} FROM daily ORDER BY date DESC LIMIT 14""")
oracle("search_keywords", f"""
    SELECT {_POST} FROM posts_tagged
    WHERE list_has_any(list_transform(keywords, lambda w: lower(w)), ['climate change', 'that', 'lean'])
    ORDER BY event_time_utc DESC, post_id LIMIT 50""")
oracle("search_region", f"""
    SELECT {_POST} FROM posts_tagged
    WHERE list_contains(list_transform(regions_detected, lambda w: lower(w)), 'edin')
    ORDER BY event_time_utc DESC, post_id LIMIT 50""")
oracle("term_postings", """
    SELECT DISTINCT kind, term, event_time_utc, post_id FROM (
        SELECT 'keyword' AS kind, lower(unnest(keywords)) AS term, event_time_utc, post_id FROM posts_tagged
        UNION ALL SELECT 'place', lower(unnest(regions_detected)), event_time_utc, post_id FROM posts_tagged)""")
oracle("search_keywords_postings", f"""
    SELECT {_POST} FROM posts_tagged
    WHERE list_has_any(list_transform(keywords, lambda w: lower(w)), ['climate change', 'that', 'lean'])
    ORDER BY event_time_utc DESC, post_id LIMIT 50""")
oracle("search_region_postings", f"""
    SELECT {_POST} FROM posts_tagged
    WHERE list_contains(list_transform(regions_detected, lambda w: lower(w)), 'edin')
    ORDER BY event_time_utc DESC, post_id LIMIT 50""")
oracle("posts_stored_latest", f"""
    SELECT {_POST} FROM (
        SELECT * REPLACE ('youtube_raw' AS source,
            list_filter(keywords, lambda w: w NOT IN ('Then', 'that', 'lean', 'Keit')) AS keywords,
            list_filter(regions_detected, lambda w: w NOT IN ('Anes', 'Edin', 'Lean', 'Teen')) AS regions_detected)
        FROM posts_tagged)
    ORDER BY event_time_utc DESC, post_id LIMIT 30""")
oracle("air_stored_latest", f"""
    SELECT {_AIR} FROM air ORDER BY event_time_utc DESC LIMIT 50""")
oracle("weather_latest_text", f"""
    SELECT * REPLACE (regexp_replace(strftime(event_time_utc, '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', '') AS event_time_utc)
    FROM (SELECT {_WEATHER} FROM weather ORDER BY event_time_utc DESC LIMIT 50)""")
oracle("recent_posts_sentiment", """
    SELECT p.event_time_utc, p.body_normalized, p.source, s.sentiment_label,
           s.sentiment_score AS sentiment_confidence_pct
    FROM posts p JOIN sentiment s ON p.post_id = s.post_id
    ORDER BY p.event_time_utc DESC, p.post_id LIMIT 50""")
oracle("temp_series", """
    SELECT event_time_utc AS time, temperature_celsius AS value, city FROM weather""")
oracle("current_temperature", """
    SELECT temperature_celsius FROM weather ORDER BY event_time_utc DESC LIMIT 1""")
