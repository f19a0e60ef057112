"""What the operators share: reading tables, saved intermediate tables, row keys, fixed-size bitmaps."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Words are maximal runs of characters other than these: \x20 and \x09-\x0D.
GAPS = r"[\x20\x09-\x0D]+"
#: Bits of a bitmap that is sent to every task: 8 MB, whatever the input.
BITMAP_BITS = 1 << 26

_own_folders: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this library's code to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(path, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only where that is unset and Spark local, one of our own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        app = spark.sparkContext.applicationId
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if app not in _own_folders:
            _own_folders[app] = tempfile.mkdtemp(prefix="galemark-")
        root = _own_folders[app]
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Within, Spark sends at most about `most` bytes of rows to a Python worker at once (at least a row).

    A batch stands in Spark's Arrow vectors, in the stream to the worker and in the worker, twice where
    a buffer has just grown, all beside the heap.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def column(df: DataFrame, name: str, kind: str) -> Column:
    """A column of df as `kind`, or null where df has none of that name."""
    return (df[name] if name in df.columns else F.lit(None)).cast(kind)


def free_name(df: DataFrame, name: str) -> str:
    """A name like `name` that no column of df has (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """The words of a text in order; of a null, none."""
    parts = F.split(F.coalesce(text, F.lit("")), GAPS)
    return F.filter(parts, lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words, without keeping them."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, GAPS))).cast("long")


def text_key(text: Column) -> Column:
    """Tells apart rows that share an id; a null text has a key of its own."""
    return F.coalesce(F.xxhash64(F.lit(1), text), F.lit(0))


def bitmap(df: DataFrame, hashes: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Which of `bits` buckets a long column's values fall into, as an array of bytes.

    The array has a fixed size.  A set bit only lets a row through to an exact join, so the more
    values there are, the less it saves, but nothing is ever lost.
    """
    place = F.pmod(F.col(hashes), F.lit(bits)) + 1  # bucket n, from 1, holds places 32768 * (n - 1) + 1 ..
    found = (
        df.select(place.alias("b"))
        .groupBy(F.expr("bitmap_bucket_number(b)").alias("n"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(b))").alias("m"))
    )
    out = np.zeros(bits >> 3, np.uint8)
    for n, m in found.toLocalIterator():
        out[(n - 1) * 4096 : n * 4096] |= np.frombuffer(bytes(m), np.uint8)
    return out


def in_bitmap(bits_set: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hash (int64), whether its bucket is set."""
    place = hashes & np.int64(len(bits_set) * 8 - 1)
    return (bits_set[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
