"""Small numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec, functions as F

MICROS = 1_000_000


def seconds(interval: str) -> int:
    """Length of a fixed interval such as '7 days' or '5 minutes'."""
    count, unit = interval.split()
    size = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    return int(count) * size[unit.rstrip("s")]


def micros(time: Column) -> Column:
    """Epoch microseconds of a time."""
    return F.unix_micros(time.cast("timestamp"))


def from_micros(value: Column) -> Column:
    """Time of epoch microseconds."""
    return F.timestamp_micros(value)


def ratio(part: Column, whole: Column, empty: float | None = None) -> Column:
    """part / whole in doubles; `empty` where whole is 0."""
    value = F.try_divide(part.cast("double"), whole.cast("double"))
    return value if empty is None else F.coalesce(value, F.lit(empty))


def rolling_pearson(x: Column, y: Column, over: WindowSpec) -> Column:
    """Pearson correlation of the pairs in a frame; null on fewer than two or constant values."""
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    spread = F.stddev_pop(px).over(over) * F.stddev_pop(py).over(over)
    return F.try_divide(F.covar_pop(px, py).over(over), spread)


def newest_rows(key: str, time: str, rows: int) -> WindowSpec:
    """Frame of the current and the preceding `rows` - 1 rows of a key by time."""
    return Window.partitionBy(key).orderBy(time).rowsBetween(1 - rows, 0)


def slice_of(*key: str) -> Column:
    """A small number derived from a key, as one more grouping column.

    A side grouped by its key alone is already partitioned for a join on that key, and Spark then
    cannot split a hot key of the other side.  Grouped by the key and its slice, which gives the same
    groups, both sides of the join are exchanged and the adaptive skew join applies.
    """
    return F.pmod(F.xxhash64(*key), F.lit(64)).alias("_slice")
