"""Hand-checked expressions: boundaries, missing values, texts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from galemark import fixed_values as fv
from galemark.functions import air, geo, social, text, weather
from galemark.operators import enrich


def one(spark, schema, values, *columns):
    """Results of columns over single-column rows."""
    frame = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] if len(columns) == 1 else tuple(r) for r in frame.select(*columns).collect()]


def test_wind_bounds_fall_in_the_upper_class(spark):
    wind = [0.9, 1.0, 2.0, 5.0, 8.0, 11.0, 14.0, 16.9, 17.0, None]
    assert one(spark, "w double", wind, weather.wind_category(F.col("w"))) == [
        "Calm", "Light", "Gentle", "Moderate", "Fresh", "Strong", "Gale", "Gale", "Storm", "Storm"]


def test_anomaly_takes_the_first_match(spark):
    rows = [
        (0.0, 0.0, 14.0, "High wind anomaly"), (40.0, 60.0, 14.0, "High wind anomaly"),
        (40.0, 50.1, 13.9, "Heavy precipitation anomaly"), (0.0, 50.0, 0.0, "Normal"),
        (35.0, 0.0, 0.0, "Normal"), (35.1, 0.0, 0.0, "Extreme temperature anomaly"),
        (-15.0, 0.0, 0.0, "Normal"), (-15.1, None, None, "Extreme temperature anomaly"),
        (None, None, None, "Normal"), (None, 51.0, None, "Heavy precipitation anomaly"),
    ]
    frame = spark.createDataFrame(rows, "t double, p double, w double, expected string")
    found = weather.weather_anomaly(F.col("t"), F.col("p"), F.col("w"))
    assert [r for r in frame.select(found, "expected").collect() if r[0] != r[1]] == []


def test_feels_like(spark):
    frame = spark.createDataFrame([(20.0, 5.0), (20.0, None), (None, 5.0)], "t double, w double")
    found = [r[0] for r in frame.select(weather.feels_like(F.col("t"), F.col("w"))).collect()]
    assert found[0] == 20.0 - (0.55 * (1 - 0.16 * 5.0)) * (20.0 - 14.1) and found[1:] == [None, None]


def test_demo_readings(spark):
    frame = spark.createDataFrame([(6.8, 0.0, 12.5), (5.2, 2.5, 15.0), (4.5, 1.0, 10.0)],
                                  "temperature_celsius double, precipitation double, wind_speed double")
    rows = enrich.enrich_weather(frame).select("wind_category", "weather_anomaly").collect()
    assert [tuple(r) for r in rows] == [
        ("Strong", "Normal"), ("Gale", "High wind anomaly"), ("Fresh", "Normal")]


@pytest.mark.parametrize("pollutant", list(fv.AIR_BOUNDS))
def test_air_bounds_fall_in_the_lower_class(spark, pollutant):
    bounds = fv.AIR_BOUNDS[pollutant]
    values = [float(v) for b in bounds for v in (b, b + 0.01)] + [None]
    category = air.aqi_category(F.lit(pollutant), F.col("v"))
    risk = air.health_risk_level(category)
    found = one(spark, "v double", values, category, risk)
    expected = [c for i in range(4) for c in ((fv.AIR_CLASSES[i], i), (fv.AIR_CLASSES[i + 1], i + 1))]
    assert found == expected + [("Very Unhealthy", 4)]


def test_other_pollutants_are_not_classified(spark):
    for pollutant in (F.lit("no2"), F.lit(None).cast("string")):
        category = air.aqi_category(pollutant, F.col("v"))
        assert one(spark, "v double", [5.0, None], category, air.health_risk_level(category)) == [
            ("Not Classified", -1)] * 2


def test_breakpoint_table_gives_the_same_classes(spark):
    table = [(p, float(b), c) for p, bs in fv.AIR_BOUNDS.items() for b, c in zip(bs, fv.AIR_CLASSES)]
    table += [(p, None, "Very Unhealthy") for p in fv.AIR_BOUNDS]
    breakpoints = spark.createDataFrame(table, "parameter string, upper double, category string")
    values = [None, -1.0, 12.0, 12.1, 35.4, 50.0, 54.0, 70.5, 85.0, 105.0, 150.4, 250.0, 351.0]
    rows = [(p, v) for p in [*fv.AIR_BOUNDS, "no2", None] for v in values]
    readings = spark.createDataFrame(rows, "parameter_normalized string, value_standard_unit double")
    direct = readings.withColumn(
        "aqi_category", air.aqi_category(F.col("parameter_normalized"), F.col("value_standard_unit")))
    looked_up = enrich.classify_by_table(readings, breakpoints)
    assert sorted(looked_up.collect(), key=str) == sorted(direct.collect(), key=str)


def test_spike(spark):
    assert one(spark, "v double", [100.0, 100.1, None], air.pollution_spike(F.col("v"))) == [
        False, True, False]


def test_index_meets_the_steps(spark):
    values = [0.0, 6.0, 12.0, 35.4, 55.4, 150.4, 200.4, 250.4, 999.0, -3.0, None]
    found = one(spark, "v double", values, air.aqi_score(F.lit("pm25"), F.col("v")))
    assert found[:-1] == pytest.approx([0, 25, 50, 100, 150, 200, 250, 300, 1048.6, 0])
    assert found[-1] is None
    assert one(spark, "v double", [1.0], air.aqi_score(F.lit("no2"), F.col("v"))) == [None]


def test_normalized_text(spark):
    cases = {
        "Hello  http://a.b/c?d=1 World!": "hello   world",
        "www.x.com tail": "tail",
        "HTTP://UP.com x": "httpupcom x",
        "awww nice": "awww nice",
        "awwwx nice": "a nice",
        "": "", "  ": "", "!?": "", "wwwhttp://a b": "b",
        "Café Ünï 9": "caf n 9",
        "　a b\x1f": "a b",
        "a\tb\nC": "a\tb\nc", "x http": "x http",
    }
    assert one(spark, "t string", list(cases), text.normalize_text(F.col("t"))) == list(cases.values())
    assert one(spark, "t string", [None], text.normalize_text(F.col("t"))) == [""]


def by_characters(t):
    """The normalized text, one character at a time."""
    kept, i = [], 0
    while i < len(t):
        prefix = next((p for p in ("http", "www") if t.startswith(p, i)), None)
        after = i + len(prefix or "")
        if prefix and after < len(t) and not t[after].isspace():
            i = next((j for j in range(after, len(t)) if t[j].isspace()), len(t))
            continue
        if t[i].isspace() or (t[i].isascii() and t[i].isalnum()):
            kept.append(t[i])
        i += 1
    return "".join(kept).lower().strip()


def test_normalized_text_equals_brute_force(spark):
    rng = random.Random(11)
    parts = ["http", "www", "h", "w", "t", " ", "\t", "\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u2003",
             "\u2029", "\u3000", "\u200b", "é", "ß", "İ", "😀", ".", "/", "A", "z", "9", "_", "٣"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(3000)]
    found = one(spark, "t string", texts, text.normalize_text(F.col("t")))
    assert [(t, f) for t, f in zip(texts, found) if f != by_characters(t)] == []
    tags = one(spark, "t string", [t.replace("z", "#") for t in texts], text.hashtags(F.col("t")))
    assert tags == [[w for w in t.replace("z", "#").split() if w.startswith("#")] for t in texts]


def test_hashtags_keep_order_and_repeats(spark):
    texts = ["#b a\t#a #b x#y #z", "", None]
    assert one(spark, "t string", texts, text.hashtags(F.col("t"))) == [["#b", "#a", "#b", "#z"], [], []]


def test_parent_id(spark):
    links = ["t3_ab", "t3_a_b", "none", None]
    assert one(spark, "t string", links, text.parent_id(F.col("t"))) == ["ab", "a", None, None]


def test_terms(spark):
    found = text.terms_in(F.lower("t"), ["Heat Wave", "environment", "smog"])
    texts = ["smog and a HEAT wave", "Environmental", "", None]
    assert one(spark, "t string", texts, found) == [["Heat Wave", "smog"], [], [], []]
    places = text.terms_in(F.lower("t"), ["Roxbury", "West Roxbury", "Hand"])
    texts = ["West Roxbury", "roxbury, not West Roxbury", "a thousand"]
    assert one(spark, "t string", texts, places) == [["West Roxbury"], ["Roxbury", "West Roxbury"], []]


def test_city_names(spark):
    names = [" Boston, USA", "BOSTON", "North Boston", None]
    assert one(spark, "t string", names, text.city_name(F.col("t"))) == [
        "boston", "boston", "north boston", None]
    assert text.city_literal("Boston, USA ") == "boston"


def test_softmax_and_decision(spark):
    logits = [[1.0, 2.0, 3.0], [1000.0, 1000.0, 0.0]]
    labels = ["neutral", "positive", "negative"]
    z = F.col("z")
    rows = one(spark, "z array<double>", logits, social.softmax(z), social.winning_class(z, labels),
               social.winning_probability(z))
    e = [math.exp(v) for v in logits[0]]
    assert rows[0][0] == pytest.approx([v / sum(e) for v in e])
    assert rows[0][1:] == ("negative", pytest.approx(e[2] / sum(e)))
    # The first of two equal logits wins.
    assert rows[1][1:] == ("neutral", pytest.approx(0.5))


def test_display_labels(spark):
    labels = ["positive", "Negative", "neutral", "other", None]
    assert one(spark, "t string", labels, social.display_label(F.col("t"))) == [
        "✅ Positive", "❌ Negative", "➖ Neutral", "other", None]


def test_distance(spark):
    # One degree of latitude.
    found = one(spark, "lat double", [43.0], geo.distance_km(F.col("lat"), F.lit(-71.0), 42.0, -71.0))
    assert found[0] == pytest.approx(6371 * math.pi / 180)


def test_terms_equal_an_alternation(spark):
    """Looking words up gives what one pattern of all terms gives, overlaps included."""
    import random
    import re

    rng = random.Random(3)
    terms = ["West Roxbury", "Roxbury", "South End", "End", "east end west", "heat", "Heat Wave", "pm2.5", "caf\u00e9"]
    said = ["west", "roxbury", "south", "end", "east", "heat", "wave", "pm2.5", "pm2", "5", "caf\u00e9", "roxbury_x", "x"]
    texts = ["".join(rng.choice(said) + rng.choice([" ", "  ", ", ", "\n", "-", "."]) for _ in range(rng.randrange(9))) for _ in range(300)]
    texts += ["", None, "  "]
    longest = sorted((t.lower() for t in terms), key=lambda t: (-len(t), t))
    pattern = re.compile(r"\b(" + "|".join(map(re.escape, longest)) + r")\b")
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in frame.select("t", text.terms_in(F.col("t"), terms).alias("found")).collect():
        named = set(pattern.findall(row["t"] or ""))
        assert row["found"] == [t for t in terms if t.lower() in named]
