"""Window frames of ordered daily series, and the aggregates that Spark lacks by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by(levels: Sequence[str], date: str = "date") -> WindowSpec:
    return Window.partitionBy(*levels).orderBy(date)


def before(levels: Sequence[str], days: int | None = None, date: str = "date") -> WindowSpec:
    """All rows of the key before this one, or the last ``days`` of them (rows of a dense panel are days)."""
    return by(levels, date).rowsBetween(Window.unboundedPreceding if days is None else -days, -1)


def by_key(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Rows dealt out by key over all shuffle partitions. Few small rows that become many aren't drawn together into a few tasks, as they would be by their size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *levels)


def largest_mode(col: Column) -> Column:
    """The most frequent value, the largest of several."""
    return -F.mode(-col, True)


def cv(col: Column) -> Column:
    """Population deviation over mean, null if the mean is 0 or there is no value."""
    return F.try_divide(F.stddev_pop(col), F.avg(col))
