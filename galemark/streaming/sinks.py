"""Sinks for streams and the keyed table they write.

A keyed table is a table of batches (`batches.py`): a batch only adds its own rows, a replayed batch
overwrites its own folder, and every so many batches the writer folds them into one snapshot.
`read_keyed` keeps the newest row per key; `compact_keyed` writes that state to a new table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from galemark.operators.windows import latest_per_key
from galemark.session import checkpoint_root
from galemark.streaming import batches

BatchWriter = Callable[[DataFrame, int], None]


def named(df: DataFrame, name: str, root: str | None = None, once: bool = False) -> DataStreamWriter:
    """A writer with the query's own checkpoint folder under `root` (default: the shared one).

    `once` processes what is there and stops.
    """
    root = root or checkpoint_root(df.sparkSession)
    writer = df.writeStream.queryName(name).option("checkpointLocation", f"{root}/{name}")
    return writer.trigger(availableNow=True) if once else writer


def to_console(df: DataFrame, name: str, rows: int = 10, **options) -> StreamingQuery:
    """Print the first rows of every batch in full, for debugging."""
    writer = named(df, name, **options).format("console")
    return writer.option("truncate", False).option("numRows", rows).start()


def to_memory(df: DataFrame, name: str, mode: str = "complete", **options) -> StreamingQuery:
    """Keep the result as a driver-side table `name`; for small aggregates and tests only."""
    # A memory table cannot be recovered in update or append mode, so it takes no checkpoint there.
    if mode == "complete":
        writer = named(df, name, **options)
    else:
        writer = df.writeStream.queryName(name)
        writer = writer.trigger(availableNow=True) if options.get("once") else writer
    return writer.format("memory").outputMode(mode).start()


def to_kafka(df: DataFrame, name: str, servers: str, **options) -> StreamingQuery:
    """Send envelope rows (topic, key, value) to Kafka (needs the Kafka connector)."""
    writer = named(df.select("topic", "key", "value"), name, **options).format("kafka")
    return writer.option("kafka.bootstrap.servers", servers).start()


def to_files(df: DataFrame, name: str, path: str, partition_by: Sequence[str] = ("topic",), **options) -> StreamingQuery:
    """Append rows to parquet folders, by default one per topic."""
    writer = named(df, name, **options).format("parquet").partitionBy(*partition_by)
    return writer.option("path", path).start()


def to_batches(df: DataFrame, name: str, write: BatchWriter, mode: str = "append", **options) -> StreamingQuery:
    """Hand every micro-batch to `write(batch, epoch)`."""
    return named(df, name, **options).outputMode(mode).foreachBatch(write).start()


_WRITTEN = "written_at timestamp, run string, epoch bigint"
_ORDER = ("written_at", "epoch", "run")


def keyed_writer(
    path: str, key: Sequence[str], newest: Sequence[str], every: int = batches.EVERY
) -> BatchWriter:
    """Writer of a keyed table; of one batch the newest row per key is kept.

    Every `every` batches the table is folded to its newest rows.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        run = batches.run_of(batch)
        rows = latest_per_key(batch, key, newest).withColumns({
            "written_at": F.current_timestamp(), "run": F.lit(run), "epoch": F.lit(epoch).cast("bigint"),
        })
        batches.add_batch(rows, path, run, epoch)
        batches.fold_batches(
            batch.sparkSession, path, rows.schema.toDDL(), lambda all_rows: latest_per_key(all_rows, key, [*newest, *_ORDER]), every
        )

    return write


def sums_writer(
    path: str, make: Callable[[DataFrame], DataFrame], combine: Callable[[DataFrame], DataFrame],
    every: int = batches.EVERY,
) -> BatchWriter:
    """Writer of partial results: `make` brings a batch down to them, `combine` brings many down to one."""

    def write(batch: DataFrame, epoch: int) -> None:
        rows = make(batch)
        batches.add_batch(rows, path, batches.run_of(batch), epoch)
        batches.fold_batches(batch.sparkSession, path, rows.schema.toDDL(), combine, every)

    return write


def cassandra_writer(keyspace: str, table: str) -> BatchWriter:
    """Writer that appends batches to a Cassandra table, whose primary key makes it an upsert.

    Needs the Cassandra connector on the classpath.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        target = batch.write.format("org.apache.spark.sql.cassandra").mode("append")
        target.options(keyspace=keyspace, table=table).save()

    return write


def fan_out(writers: dict[str, BatchWriter], split: Callable[[DataFrame, str], DataFrame]) -> BatchWriter:
    """Writer that reads a batch once and gives each writer its part."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for name, target in writers.items():
                target(split(batch, name), epoch)
        finally:
            batch.unpersist()

    return write


def read_keyed(
    spark: SparkSession, path: str, schema: str, key: Sequence[str], newest: Sequence[str]
) -> DataFrame:
    """The newest row per key of a keyed table; later batches win ties.  Empty before any write."""
    rows = batches.read_batches(spark, path, f"{schema}, {_WRITTEN}")
    return latest_per_key(rows, key, [*newest, *_ORDER]).drop(*_ORDER)


def compact_keyed(
    spark: SparkSession, path: str, to: str, schema: str, key: Sequence[str], newest: Sequence[str]
) -> None:
    """Write the current state of a keyed table as the first batch of the new table `to`."""
    state = read_keyed(spark, path, schema, key, newest)
    marked = {"written_at": F.current_timestamp(), "run": F.lit("compact"), "epoch": F.lit(-1).cast("bigint")}
    batches.add_batch(state.withColumns(marked), to, "compact", -1)
