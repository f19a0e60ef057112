"""JSON text to columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def expand(df: DataFrame, column: str, schema: str, *keep) -> DataFrame:
    """JSON text or bytes in `column` as columns of `schema`, after the columns `keep`.

    Text that is not JSON gives a row of nulls.  Parsing inside a generator makes it happen once per
    row: a plain projection would be copied into every filter and join key that uses a field.
    """
    body = F.from_json(F.col(column).cast("string"), schema)
    return df.select(*keep, F.inline(F.array(body)))
