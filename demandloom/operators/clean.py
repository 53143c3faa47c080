"""Cleaning and typing of tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = ("shop_id", "item_id", "date")


def parse_sale_date(col: str | Column) -> Column:
    """A dd.MM.yyyy text as a date; null where it isn't one."""
    return F.try_to_date(F.col(col) if isinstance(col, str) else col, "dd.MM.yyyy")


def flag_key_duplicates(df: DataFrame, key: Sequence[str] = KEY, name: str = "is_duplicate") -> DataFrame:
    """Mark every row whose key occurs more than once."""
    return df.withColumn(name, F.count("*").over(Window.partitionBy(*key)) > 1)


def _per_key(df: DataFrame, key: Sequence[str], qty: str, price: str, keep: Sequence[str]) -> DataFrame:
    """One pass over the key: counts, signs, sums and, for single rows, their own price."""
    total = F.sum(qty)
    return df.groupBy(*key).agg(
        *(F.min(c).alias(c) for c in keep),
        F.count("*").alias("_n"),
        (F.max(F.col(qty) > 0) & F.max(F.col(qty) < 0)).alias("_mixed"),
        F.when(F.count("*") == 1, F.min(price)).otherwise(F.try_divide(F.sum(F.col(price) * F.col(qty)), total)).alias(price),
        total.alias(qty),
    )


def drop_mixed_sign_keys(df: DataFrame, key: Sequence[str] = KEY, qty: str = "item_cnt_day") -> DataFrame:
    """Rows without those of duplicated keys that have both a positive and a negative quantity."""
    w = Window.partitionBy(*key)
    return df.withColumn("_mixed", F.max(F.col(qty) > 0).over(w) & F.max(F.col(qty) < 0).over(w)).filter(~F.col("_mixed")).drop("_mixed")


def consolidate_duplicates(df: DataFrame, key: Sequence[str] = (*KEY, "date_block_num"), qty: str = "item_cnt_day", price: str = "item_price") -> DataFrame:
    """One row a key: summed quantity and the price weighted by quantity (null if the quantities sum to 0)."""
    return df.groupBy(*key).agg(F.try_divide(F.sum(F.col(price) * F.col(qty)), F.sum(qty)).alias(price), F.sum(qty).alias(qty))


def clean_sales(df: DataFrame, train_start: date, key: Sequence[str] = KEY, qty: str = "item_cnt_day", price: str = "item_price") -> DataFrame:
    """The whole chain in two exchanges: distinct rows, then one aggregate by key.

    Single rows stay; duplicated keys are consolidated, or removed if their signs differ;
    then prices above 0 and dates from ``train_start`` on are kept.
    """
    rest = [c for c in df.columns if c not in (*key, qty, price)]
    grouped = _per_key(df.filter(F.col("date") >= F.lit(train_start)).dropDuplicates(), key, qty, price, rest)
    kept = grouped.filter((F.col("_n") == 1) | ~F.col("_mixed")).filter(F.col(price) > 0)
    return kept.select(*df.columns)


_WHOLE = ((127, T.ByteType()), (32_767, T.ShortType()), (2_147_483_647, T.IntegerType()), (9_223_372_036_854_775_807, T.LongType()))


def narrow_types(df: DataFrame) -> dict[str, T.DataType]:
    """The smallest type that holds each numeric column, from one aggregate over the table.

    Whole-valued doubles become integers, others floats. Columns without values stay.
    """
    numeric = [f for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if not numeric:
        return {}
    aggs = []
    for f in numeric:
        c = F.col(f"`{f.name}`")
        aggs += [F.min(c).alias(f"lo_{f.name}"), F.max(c).alias(f"hi_{f.name}"), F.bool_and(c == F.floor(c)).alias(f"whole_{f.name}")]
    found = df.agg(*aggs).first()
    out = {}
    for f in numeric:
        lo, hi = found[f"lo_{f.name}"], found[f"hi_{f.name}"]
        if lo is None:
            continue
        if found[f"whole_{f.name}"] and max(abs(lo), abs(hi)) <= _WHOLE[-1][0]:
            out[f.name] = next(t for most, t in _WHOLE if -most - 1 <= lo and hi <= most)
        else:
            out[f.name] = T.FloatType() if max(abs(lo), abs(hi)) < 3.4e38 else T.DoubleType()
    return out


def downcast(df: DataFrame) -> DataFrame:
    found = narrow_types(df)
    return df.select(*(F.col(f"`{c}`").cast(found[c]).alias(c) if c in found else F.col(f"`{c}`") for c in df.columns))


def sql_type_map(df: DataFrame) -> dict[str, str]:
    """A column's SQL type by its family."""
    out = {}
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType)):
            out[f.name] = "SMALLINT"
        elif isinstance(t, T.IntegerType):
            out[f.name] = "INT"
        elif isinstance(t, T.LongType):
            out[f.name] = "BIGINT"
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            out[f.name] = "FLOAT"
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out[f.name] = "DATETIME"
        else:
            out[f.name] = "VARCHAR(255)"
    return out


def add_col_prefix(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    """Prefix every column but the keys and those that have the prefix."""
    return df.select(*(F.col(f"`{c}`").alias(c if c in keys or c.startswith(prefix) else f"{prefix}{c}") for c in df.columns))


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))
