"""Columns made ready for charts: dates as plain days, amounts in thousands of millions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The unit of large amounts.
UNIT = 1e9


def by_day(df: DataFrame, column: str) -> DataFrame:
    """The rows in the order of a date or timestamp column, which becomes text like 2024-10-15."""
    return df.withColumn(column, F.date_format(F.col(column), "yyyy-MM-dd")).orderBy(column)


def in_units(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, or else all decimals and doubles, in thousands of millions."""
    wide = [f.name for f in df.schema if f.dataType.typeName() in ("decimal", "double", "float")]
    return df.withColumns({n: F.col(n).cast("double") / F.lit(UNIT) for n in columns or wide})
