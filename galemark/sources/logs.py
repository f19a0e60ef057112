"""Structured log records, one JSON object per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from galemark import fixed_values as fv, schemas
from galemark.functions.jsons import expand


def read_logs(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Log lines as a frame with the text column `value`."""
    return (spark.readStream if streaming else spark.read).text(path)


def scan_logs(
    lines: DataFrame,
    components: Sequence[str] | None = fv.LOG_COMPONENTS,
    text: str = "value",
) -> DataFrame:
    """Records of `components` (all of them for None) with their time in `ts`."""
    rows = expand(lines, text, schemas.LOG)
    if components is not None:
        rows = rows.filter(F.col("component").isin(*components))
    return rows.withColumn("ts", F.try_to_timestamp(F.col("ts_utc")))
