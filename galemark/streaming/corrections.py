"""Readings with their weekly means, emitted again whenever a later reading changes the mean.

A reading counts towards the means of seven days: its own and the six after it.  State is kept per
location and day: the sums of all readings that count towards the day's mean, and the day's own
readings.  A batch that changes the sums emits the day's readings with the new mean, so a late or
repeated delivery corrects rows that were written before.  When the watermark has passed the end of a
day, nothing can change its mean any more, and a timer drops the state.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_READING = "window_ts timestamp, temperature double, humidity double, precipitation double"
_SUMS = "temperature double, temperatures bigint, humidity double, humidities bigint"
_OUT = f"location string, {_READING}, temp_7d_avg double, humidity_7d_avg double"
_DAY_MS = 86_400_000


class DayOfReadings(StatefulProcessor):
    """State of one (location, day)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", _SUMS)
        self.readings = handle.getListState("readings", _READING)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        location, day = key
        if not self.sums.exists():
            # The end of the day, from which on the watermark lets none of its rows in.
            self.handle.registerTimer((day + 1) * _DAY_MS)
        t, nt, h, nh = self.sums.get() if self.sums.exists() else (0.0, 0, 0.0, 0)
        own = []
        for row in rows:
            if row.temperature is not None:
                t, nt = t + row.temperature, nt + 1
            if row.humidity is not None:
                h, nh = h + row.humidity, nh + 1
            if row.ahead == 0:
                own.append((row.window_ts, row.temperature, row.humidity, row.precipitation))
        self.sums.update((t, nt, h, nh))
        if own:
            self.readings.appendList(own)
        means = (t / nt if nt else None, h / nh if nh else None)
        for reading in self.readings.get():
            yield Row(**dict(zip(_NAMES, (location, *reading, *means))))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.sums.clear()
        self.readings.clear()
        return iter(())

    def close(self) -> None:
        pass


_NAMES = ("location", "window_ts", "temperature", "humidity", "precipitation", "temp_7d_avg", "humidity_7d_avg")


def corrected_metrics(weather: DataFrame) -> DataFrame:
    """A stream (parsed weather with its watermark) of readings with the mean of the seven days that
    end with theirs; a reading comes again when this changes.

    The newest row per (location, window_ts) is the right one.  Rows without location or time are left
    out, as no mean is theirs.  Means add up all deliveries of a reading, and readings that come after
    the watermark has passed them are left out, as from the weekly means.
    """
    day = F.unix_date(F.to_date("window_ts"))
    readings = weather.select("location", F.col("event_time").alias("window_ts"), "temperature", "humidity", "precipitation")
    spread = readings.dropna(subset=["location", "window_ts"]).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("ahead")
    ).withColumn("day", day.cast("bigint") + F.col("ahead"))
    return spread.groupBy("location", "day").transformWithState(
        statefulProcessor=DayOfReadings(), outputStructType=_OUT, outputMode="Update", timeMode="EventTime",
    )
