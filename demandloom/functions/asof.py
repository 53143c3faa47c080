"""The latest earlier value of a key, with a key's history spread over tasks by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of one stretch of a key's history.
STRETCH = 64


def last_before(df: DataFrame, keys: Sequence[str], day: Column, value: Column, name: str, stretch: int = STRETCH) -> DataFrame:
    """``df`` with ``name``: the key's non-null ``value`` of the latest earlier day, the largest of that day's; null without one.

    A key's rows are dealt out by (key, stretch of days). Each stretch is summed up by its last value, a running
    pass over the stretches, which are as many as the calendar has, carries that on, and within a stretch one ordered pass does the
    rest. So a key that has all rows is still many tasks. Null keys are a key of their own.
    """
    at = {"_day": day.cast("int"), "_value": value}
    rows = df.withColumns(at).withColumn("_part", F.struct(*(F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)), F.floor(F.col("_day") / stretch).alias("stretch")))
    seen = F.when(F.col("_value").isNotNull(), F.struct(F.col("_day").alias("day"), F.col("_value").alias("value")))
    key = [F.col("_part")[f"k{i}"] for i in range(len(keys))]
    last = rows.groupBy("_part").agg(F.max(seen).alias("_last"))
    carried = last.select("_part", F.max("_last").over(Window.partitionBy(*key).orderBy(F.col("_part.stretch")).rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    own = F.max(seen).over(Window.partitionBy("_part").orderBy("_day").rangeBetween(Window.unboundedPreceding, -1))
    met = rows.withColumn("_own", own).join(carried, "_part", "left")
    return met.withColumn(name, F.coalesce("_own", "_carried")["value"]).drop("_day", "_value", "_part", "_own", "_carried")
