"""Exact quantiles and ranks of columns and groups of any size: no task holds more than a narrow range of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.sources.io import scratch_path

#: Ranges of values for each doubling; a range is 0.07 % wide.
RESOLUTION = 1024
_LEAST_POWER, _MOST_POWER = -1075, 1025


def value_range(v: Column) -> Column:
    """A number that never falls as the value rises: the sign and the rounded logarithm of a double. NaN comes last."""
    power = F.when(F.abs(v) == float("inf"), F.lit(float(_MOST_POWER))).otherwise(F.log2(F.abs(v)))
    size = F.floor(power * RESOLUTION) - _LEAST_POWER * RESOLUTION
    return F.when(F.isnan(v), F.lit((_MOST_POWER - _LEAST_POWER + 1) * RESOLUTION).cast("long")).when(v == 0, F.lit(0).cast("long")).otherwise(F.signum(v).cast("long") * size)


def exact_quantiles(df: DataFrame, columns: Sequence[str], quantiles: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Rows (key, field, n, q): for each group and column the interpolated quantiles of its non-null values, as an array.

    ``key`` is a struct of the columns ``by``, in which nulls equal each other. Equal values are counted first; then the
    counts of value ranges tell which range holds each rank that is asked for, and only values of those ranges are
    sorted. A group's ranges are bounded by what a double can be, however many rows it has.
    Groups without a value give no row.
    """
    key = F.struct(*(F.col(f"`{c}`").alias(c) for c in by)) if by else F.struct(F.lit(0).alias("all"))
    long = df.select(key.alias("key"), F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("double").alias("v")) for c in columns))).alias("x")).select("key", "x.*").filter("v is not null")
    counted = long.groupBy("key", "field", "v").agg(F.count("*").alias("m")).withColumn("range", value_range(F.col("v")))
    ranges = counted.groupBy("key", "field", "range").agg(F.sum("m").alias("in_range"))
    whole = Window.partitionBy("key", "field")
    placed = ranges.select("*", F.coalesce(F.sum("in_range").over(whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"), F.sum("in_range").over(whole).alias("n"))
    at = [(F.col("n") - 1) * q for q in quantiles]
    wanted = F.array(*(rank for x in at for rank in (F.floor(x), F.ceil(x))))
    holds = placed.filter(F.exists(wanted, lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("in_range")))).drop("in_range")
    inside = Window.partitionBy("key", "field", "range").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    values = counted.join(holds, ["key", "field", "range"]).withColumn("rank", F.col("start") + F.coalesce(F.sum("m").over(inside), F.lit(0)))
    value_at = lambda rank: F.max(F.when((F.col("rank") <= rank) & (rank < F.col("rank") + F.col("m")), F.col("v")))
    found = values.groupBy("key", "field", "n").agg(*(value_at(f(x)).alias(f"{name}{k}") for k, x in enumerate(at) for name, f in (("low", F.floor), ("high", F.ceil))))
    between = [F.when(F.col(f"low{k}") == F.col(f"high{k}"), F.col(f"low{k}")).otherwise((F.ceil(x) - x) * F.col(f"low{k}") + (x - F.floor(x)) * F.col(f"high{k}")) for k, x in enumerate(at)]
    return found.select("key", "field", "n", F.array(*between).alias("q"))


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with each row's 0-based place in ``order``, which should have no ties.

    Rows are range-partitioned and written; the counts of ranges, one for each partition, give where each begins, and
    a window sorts one range.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranked")
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = stored.groupBy("_range").agg(F.count("*").alias("n")).agg(F.collect_list(F.struct("_range", "n")).alias("_sizes"))
    earlier = F.aggregate(F.filter("_sizes", lambda x: x["_range"] < F.col("_range")), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return stored.join(F.broadcast(sizes)).withColumn(name, (place + earlier).cast("int")).drop("_range", "_sizes")
