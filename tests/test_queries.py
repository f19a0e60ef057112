"""Every registered query equals its SQL counterpart, and has the plan it should have."""

import re

import pytest

import __spark_entry__ as entry
from galemark.plans.oracles import ORACLES
from galemark.plans.queries import QUERIES
from tests.compare import check, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_counterpart():
    assert QUERIES and set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    good, note = check(spark, db, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert good, note


def test_entry_returns_rows(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 50 and all(r["weather_anomaly"] != "Normal" for r in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_plans_stay_in_the_jvm_and_without_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|PythonUDF", text)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)


def test_newest_rows_are_a_distributed_top_n(spark):
    for name in ("weather_anomalies", "pollution_spikes", "posts_latest", "within_radius"):
        assert "TakeOrderedAndProject" in plan(entry.queries()[name](spark, FOLDER))


def test_latest_rows_are_limited_before_the_shuffle(spark):
    text = plan(entry.queries()["latest_per_key"](spark, FOLDER))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_scans_read_only_what_is_needed(spark):
    text = plan(entry.queries()["label_counts"](spark, FOLDER))
    assert "ReadSchema: struct<doc_id:bigint,quality:int,toxic:int>" in text
    text = plan(entry.queries()["current_temperature"](spark, FOLDER))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text
    text = plan(entry.queries()["comment_thread"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(turn), GreaterThan(turn,0)" in text
