"""Stored tables: partitioned writes, scans by city, counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from galemark.functions.text import city_literal, city_name


def write_by_city(df: DataFrame, path: str, city: str = "city", time: str = "event_time_utc") -> None:
    """Store rows under city=.../event_date=... folders, newest first inside each file.

    Ranges of (city, date, time) make the files, so a city that holds most rows is spread over
    many of them.
    """
    day = F.to_date(time)
    rows = df.withColumn(city, city_name(F.col(city))).withColumn("event_date", day)
    (
        rows.repartitionByRange(city, "event_date", time)
        .sortWithinPartitions(city, "event_date", F.col(time).desc())
        .write.mode("overwrite")
        .partitionBy(city, "event_date")
        .parquet(path)
    )


def write_postings(postings: DataFrame, path: str) -> None:
    """Store term postings under kind=.../term=... folders, newest first inside each file.

    Ranges of (kind, term, time) make the files, so a frequent term is spread over many of them.
    """
    place = ("kind", "term", F.col("event_time_utc").desc())
    rows = postings.repartitionByRange(*place).sortWithinPartitions(*place, "post_id")
    rows.write.mode("overwrite").partitionBy("kind", "term").parquet(path)


def scan_city(table: DataFrame, name: str, city: str = "city") -> DataFrame:
    """All columns of one city's rows.

    The stored city is already comparable (`write_by_city`), so the plain equality prunes folders.
    """
    return table.filter(F.col(city) == city_literal(name))


def table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A catalog table, or an empty frame of `schema` where it does not exist."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def cassandra_table(spark: SparkSession, keyspace: str, table: str) -> DataFrame:
    """A Cassandra table (needs the connector, which takes an equality on the partition key)."""
    reader = spark.read.format("org.apache.spark.sql.cassandra")
    return reader.options(keyspace=keyspace, table=table).load()


def path_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A parquet table, or None where the path does not exist; any other failure is raised."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def table_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """One row per table with its row count; 0 where the table cannot be read (None)."""
    counted = [
        _named_count(df, name) if df is not None
        else spark.range(1).select(
            F.lit(name).alias("table_name"), F.lit(0).cast("bigint").alias("row_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def _named_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count"
    )
