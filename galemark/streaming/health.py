"""Health of running streams, as records of the structured log."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from galemark import schemas
from galemark.functions.jsons import expand
from galemark.sources import logs, shapes

COMPONENT = "spark_processor"
#: Name of the metrics that `observed` collects.
METRICS = "messages"


def observed(messages: DataFrame) -> DataFrame:
    """Messages as they are; every batch counts them, its rejects by reason, and notes the newest.

    The counts are made while the batch runs and reach listeners with its progress.  A query may hold
    one observed source.
    """
    reason = F.col("reject_reason")
    counted = shapes.with_shape(messages).observe(
        METRICS, F.count(F.lit(1)).alias("messages"),
        F.count_if(reason == shapes.NOT_JSON).alias("not_json"), F.count_if(reason == shapes.UNKNOWN).alias("unknown_shape"),
        F.unix_micros(F.max("timestamp")).alias("newest"),
    )
    return counted.select(messages.columns)


def progress_record(progress: dict) -> dict:
    """Log record of one micro-batch."""
    elapsed = progress.get("durationMs", {}).get("triggerExecution", 0) / 1000
    rows = progress.get("numInputRows", 0)
    found = progress.get("observedMetrics", {}).get(METRICS)
    more = {}
    if found:
        # The source may have read other topics' messages beside.
        rows = found["messages"]
        more = {"not_json": found["not_json"], "unknown_shape": found["unknown_shape"]}
        more["rejects"] = sum(more.values())
        if found.get("newest") is not None:
            ended = datetime.fromisoformat(progress["timestamp"]).timestamp() + elapsed
            more["lag_sec"] = round(ended - found["newest"] / 1e6, 3)
    return {
        "ts_utc": progress.get("timestamp"),
        "component": COMPONENT,
        "event": "send_success",
        "stream": progress.get("name"),
        "cycle": progress.get("batchId"),
        "elapsed_sec": elapsed,
        "records_sent": rows,
        "throughput_rps": round(rows / elapsed, 3) if elapsed > 0 else 0.0,
        **more,
    }


class HealthListener(StreamingQueryListener):
    """Writes a log line for every micro-batch; add it with `spark.streams.addListener`."""

    def __init__(self, write_line: Callable[[str], None] = print):
        self.write_line = write_line

    def onQueryStarted(self, event) -> None:
        self.write_line(json.dumps({"component": COMPONENT, "event": "start", "stream": event.name}))

    def onQueryProgress(self, event) -> None:
        self.write_line(json.dumps(progress_record(json.loads(event.progress.json))))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        record = {"component": COMPONENT, "event": "stop", "error": event.exception}
        self.write_line(json.dumps(record))


class HealthTable(HealthListener):
    """Appends the log records of batches to text files in `path`, every so many and when a query ends.

    A batch gives a record for what it sent and one for its finished cycle, so the log operators take
    the table as they take any log.  Records that are not yet written are lost with the driver; the
    streams' own progress is not.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        super().__init__(self._add)
        self.spark, self.path, self.every, self.lines = spark, path, every, []

    def _add(self, line: str) -> None:
        self.lines.append((line,))
        if len(self.lines) >= self.every:
            self.flush()

    def flush(self) -> None:
        if self.lines:
            written, self.lines = self.lines, []
            self.spark.createDataFrame(written, "value string").coalesce(1).write.mode("append").text(self.path)

    def onQueryProgress(self, event) -> None:
        record = progress_record(json.loads(event.progress.json))
        for name in ("send_success", "cycle_complete"):
            self._add(json.dumps({**record, "event": name}))

    def onQueryTerminated(self, event) -> None:
        super().onQueryTerminated(event)
        self.flush()


def read_health(spark: SparkSession, path: str) -> DataFrame:
    """The records that `HealthTable` has written, with their time in `ts`."""
    rows = expand(logs.read_logs(spark, path), "value", schemas.HEALTH)
    return rows.withColumn("ts", F.try_to_timestamp(F.col("ts_utc")))


def recent_health(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """Log records of the queries' recent batches, of which Spark keeps a fixed number."""
    records = [
        progress_record(json.loads(p.json) if hasattr(p, "json") else p)
        for query in queries for p in query.recentProgress
    ]
    rows = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    parsed = rows.select(F.from_json("value", schemas.LOG).alias("r")).select("r.*")
    return parsed.withColumn("ts", F.try_to_timestamp(F.col("ts_utc")))
