"""Pipeline health from structured log records.

Figures are evaluated on a time grid: the value at grid time T covers (T - width, T].  Records are
added up once per (series, step) and only those partials reach the grid points they count for, so a
busy component is spread by time and combined on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from galemark.functions.stats import MICROS, from_micros, micros, ratio, seconds
from galemark.operators.windows import trailing_means


def _grid(records: DataFrame, series: Sequence[str], width: str, step: str, *partials: Column) -> DataFrame:
    """Partials per (grid time, series), one row for every step inside the width."""
    if seconds(width) % seconds(step):
        raise ValueError(f"{width} is not a multiple of {step}")
    size = seconds(step) * MICROS
    at = micros(F.col("ts"))
    slot = F.ceil(at / F.lit(size)).cast("bigint")
    parts = (
        records.filter(F.col("ts").isNotNull()).groupBy(slot.alias("slot"), *series).agg(*partials)
    )
    last = F.col("slot") + (seconds(width) // seconds(step) - 1)
    return parts.withColumn("slot", F.explode(F.sequence("slot", last))).withColumn(
        "grid_time", from_micros(F.col("slot") * size)
    )


def event_rate(
    records: DataFrame,
    event: str = "send_success",
    by: str = "component",
    width: str = "5 minutes",
    step: str = "1 minute",
) -> DataFrame:
    """Events per second by component at each grid time."""
    parts = _grid(
        records.filter(F.col("event") == event), [by], width, step, F.count("*").alias("n")
    )
    rate = F.sum("n") / F.lit(float(seconds(width)))
    return parts.groupBy("grid_time", by).agg(rate.alias("events_per_second"))


def _series_means(records: DataFrame, value: str, series: Sequence[str], width: str, step: str) -> DataFrame:
    parts = _grid(
        records, series, width, step,
        F.sum(value).alias("total"), F.count(value).alias("n"),
    )
    return parts.groupBy("grid_time", *series).agg(
        ratio(F.sum("total"), F.sum("n")).alias("mean")
    ).filter(F.col("mean").isNotNull())


def mean_throughput(
    records: DataFrame,
    component: str = "spark_processor",
    event: str = "send_success",
    series: Sequence[str] = ("component", "event", "stream"),
    width: str = "5 minutes",
    step: str = "1 minute",
) -> DataFrame:
    """Sum by stream of each series' mean throughput."""
    rows = records.filter((F.col("component") == component) & (F.col("event") == event))
    means = _series_means(rows, "throughput_rps", series, width, step)
    return means.groupBy("grid_time", "stream").agg(F.sum("mean").alias("throughput_rps"))


def mean_cycle_duration(
    records: DataFrame,
    event: str = "cycle_complete",
    series: Sequence[str] = ("component", "event", "stream"),
    width: str = "5 minutes",
    step: str = "1 minute",
) -> DataFrame:
    """Mean by component of each series' mean cycle duration."""
    means = _series_means(
        records.filter(F.col("event") == event), "elapsed_sec", series, width, step
    )
    return means.groupBy("grid_time", "component").agg(F.avg("mean").alias("elapsed_sec"))


def last_values(
    records: DataFrame,
    values: Sequence[str] = ("records_sent", "throughput_rps"),
    event: str = "cycle_complete",
    series: Sequence[str] = ("component", "event", "stream"),
    width: str = "5 minutes",
    step: str = "1 minute",
) -> DataFrame:
    """The last known value of each series at each grid time.

    Of records with equal times the one with the larger value counts.
    """
    newest = {
        v: F.max(F.when(F.col(v).isNotNull(), F.struct("ts", v))).alias(v) for v in values
    }
    parts = _grid(records.filter(F.col("event") == event), series, width, step, *newest.values())
    found = parts.groupBy("grid_time", *series).agg(*(F.max(v).alias(v) for v in values))
    return found.select("grid_time", *series, *(F.col(v)[v].alias(v) for v in values))


def trailing_activity(records: DataFrame, width: str = "5 minutes") -> DataFrame:
    """At each record's time: records and mean throughput of its component in the width before."""
    return trailing_means(
        records, "component", "ts", {"mean_throughput": "throughput_rps"},
        width=width, bucket=width, counts="n_records",
    )
