"""Profiles of tables: nulls, zeros, frequencies, histograms and box statistics, each in one or two aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.selection import exact_quantiles, ranked
from demandloom.sources.io import write_counted

QUARTILES = (0.25, 0.5, 0.75)


def _counted(df: DataFrame, counts: dict[str, Column], name: str, path: str | None) -> DataFrame:
    """Rows (field, name, n_rows); with a path the table is written there and the counts come from the writing pass."""
    own = {f"_{k}": c for k, c in enumerate(counts.values())} | {"_rows": F.count(F.lit(1))}
    pairs = lambda value: [(c, value(f"_{k}"), value("_rows")) for k, c in enumerate(counts)]
    if path:
        seen = write_counted(df, path, own)
        return df.sparkSession.createDataFrame(pairs(lambda k: int(seen[k])), f"field string, {name} long, n_rows long")
    one = df.agg(*(c.alias(k) for k, c in own.items()))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(n).cast("long").alias(name), F.col(r).cast("long").alias("n_rows")) for c, n, r in pairs(lambda k: k)))).alias("p")).select("p.*")


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None, path: str | None = None) -> DataFrame:
    """column, n_missing, pct of rows; observed while the table is written to ``path``, if one is given."""
    out = _counted(df, {c: F.count_if(F.col(f"`{c}`").isNull()) for c in columns or df.columns}, "n_missing", path)
    return out.select("field", "n_missing", F.try_divide(100.0 * F.col("n_missing"), F.col("n_rows")).alias("pct"))


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns that contain nulls, with their counts."""
    return missing_profile(df, columns).filter("n_missing > 0").select("field", "n_missing")


def zero_profile(df: DataFrame, columns: Sequence[str] | None = None, path: str | None = None) -> DataFrame:
    """column, n_zero, pct of rows; a null isn't a zero. Observed while the table is written to ``path``, if one is given."""
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    out = _counted(df, {c: F.count_if(F.col(f"`{c}`") == 0) for c in columns}, "n_zero", path)
    return out.select("field", "n_zero", F.try_divide(100.0 * F.col("n_zero"), F.col("n_rows")).alias("pct"))


def column_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*(F.count(c).alias(f"n_{c}") for c in columns), F.count("*").alias("n_rows"))


def frame_summary(df: DataFrame) -> DataFrame:
    """A row for each column: place, name, type, and the table's row and column counts."""
    kinds = F.array(*(F.struct(F.lit(k).alias("place"), F.lit(n).alias("field"), F.lit(t).alias("type")) for k, (n, t) in enumerate(df.dtypes)))
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_columns"), F.explode(kinds).alias("k")).select("k.*", "n_rows", "n_columns")


def check_unique_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts: empty if the key is unique."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def date_gap_check(df: DataFrame, col: str = "date") -> DataFrame:
    """Distinct dates against calendar days from the first to the last."""
    days = F.datediff(F.max(col), F.min(col)) + 1
    return df.agg(F.count_distinct(col).alias("n_dates"), days.alias("n_days"), (days - F.count_distinct(col)).alias("n_missing"))


def describe_columns(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max of each column, a row for each column (and group)."""
    key = F.struct(*(F.col(f"`{c}`").alias(c) for c in by)) if by else F.struct(F.lit(0).alias("all"))
    stats = [F.struct(F.lit(c).alias("field"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")) for c in columns]
    plain = df.groupBy(*((key.alias("key"),) if by else ())).agg(F.array(*stats).alias("_s")).select("key" if by else key.alias("key"), F.explode("_s").alias("s")).select("key", "s.*")
    met = plain.join(exact_quantiles(df, columns, QUARTILES, by).select("key", "field", "q"), ["key", "field"], "left")
    return met.select(*(F.col("key")[c].alias(c) for c in by), "field", "n", "mean", "std", "min", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max")


def value_counts(df: DataFrame, col: str, keep_nulls: bool = False) -> DataFrame:
    rows = df if keep_nulls else df.filter(F.col(col).isNotNull())
    return rows.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(col))


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """bin (from 1), low, high, n of equal-width bins between the smallest and the largest value.

    Null values are left out; the largest value falls into the last bin; one distinct value gives one bin.
    """
    rows = df.select(value.cast("double").alias("v")).filter("v is not null")
    ends = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    met = rows.join(F.broadcast(ends))  # one row
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.when(width == 0, 1).otherwise(F.least(F.floor((F.col("v") - F.col("lo")) / F.when(width != 0, width)) + 1, F.lit(bins))).cast("int")
    grouped = met.withColumn("bin", at).groupBy("bin").agg(F.count("*").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    return grouped.select("bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("low"), (F.col("lo") + F.col("bin") * width).alias("high"), "n")


def boxplot_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (the most extreme values within 1.5 times their distance) and outlier count by group.

    Values are first counted by (group, value), so that a large group is summed up before it meets its quartiles.
    """
    key = F.struct(*(F.col(f"`{c}`").alias(c) for c in by))
    counted = df.filter(F.col(value).isNotNull()).groupBy(key.alias("key"), F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    box = exact_quantiles(df, [value], QUARTILES, by).select("key", *(F.col("q")[k].alias(c) for k, c in enumerate(("q1", "median", "q3"))))
    met = counted.join(box, "key")
    room = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("_v") >= F.col("q1") - room) & (F.col("_v") <= F.col("q3") + room)
    out = met.groupBy("key").agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"), F.min(F.when(inside, F.col("_v"))).alias("whisker_low"), F.max(F.when(inside, F.col("_v"))).alias("whisker_high"), F.sum(F.when(inside, 0).otherwise(F.col("_n"))).alias("n_outliers"), F.sum("_n").alias("n")
    )
    return out.select(*(F.col("key")[c].alias(c) for c in by), *out.columns[1:])


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Wide columns as rows (ids, variable, value)."""
    return df.select(*ids, *(F.col(c).cast("string").alias(c) for c in values)).unpivot(list(ids), list(values), "variable", "value")


def ordinal_rating(col: str | Column) -> Column:
    """5 to 1 for a code that contains Ex, Gd, TA, Fa or Po (the first found), else 0, also for null."""
    c = F.col(col) if isinstance(col, str) else col
    out = F.when(F.contains(c, F.lit("Ex")), 5)
    for rating, code in ((4, "Gd"), (3, "TA"), (2, "Fa"), (1, "Po")):
        out = out.when(F.contains(c, F.lit(code)), rating)
    return out.otherwise(0)


def rank_density(df: DataFrame, label: str) -> DataFrame:
    """label, n, share, 0-based rank by descending share (ties by label) and log(rank + 1)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("_total"))
    out = ranked(counts, [F.desc("n"), F.asc(label)])
    return out.join(F.broadcast(total)).select(label, "n", (F.col("n") / F.col("_total")).alias("share"), "rank", F.log1p("rank").alias("log_rank"))
