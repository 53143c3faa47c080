"""The wide training table: one row a shop, item and day with the features of every grain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CATEGORY = ("category_qty", "category_qty_7d", "category_sold")


@dataclass(frozen=True)
class Parts:
    """Feature tables by grain. Columns other than keys have a prefix of their grain; additional has the pairs that only the test period has. Grains that nobody asked for may be None."""

    pairs: DataFrame
    pair_totals: DataFrame
    shops: DataFrame
    items: DataFrame
    dates: DataFrame
    item_dates: DataFrame
    shop_dates: DataFrame
    category_dates: DataFrame
    additional: DataFrame


def join_once(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join that has every column name once: of columns that both sides have, the left one's stay."""
    taken = {c.lower() for c in left.columns if c not in on}
    return left.join(right.select(*(c for c in right.columns if c in on or c.lower() not in taken)), on, how)


#: Grains that every wide table has, in the order of their columns; they are joined with the widest last, as every later join deals the columns before it out again.
SHARED = {"shops": ("shop_id",), "items": ("item_id",), "dates": ("date",), "item_dates": ("item_id", "date"), "shop_dates": ("shop_id", "date")}
JOINED = ("dates", "shops", "items", "shop_dates", "item_dates")


def merge_all_features(parts: Parts, pairs: DataFrame | None = None) -> DataFrame:
    """Inner joins of all grains but the category's; given pairs, which training may not have, get no totals. The planner broadcasts what its statistics show to be small."""
    df = join_once(parts.pairs, parts.pair_totals, ["shop_id", "item_id"]) if pairs is None else pairs
    columns = list(df.columns)
    for grain, on in SHARED.items():
        columns += [c for c in getattr(parts, grain).columns if c not in on and c.lower() not in {x.lower() for x in columns}]
    for grain in JOINED:
        df = join_once(df, getattr(parts, grain), list(SHARED[grain]))
    return df.select(*columns)


def zero_fill(df: DataFrame, columns=CATEGORY) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


def _with_category(parts: Parts, days: DataFrame, how: str) -> DataFrame:
    category = parts.category_dates.withColumnRenamed("item_category_id", "sid_item_category_id")
    return join_once(days, category, ["shop_id", "sid_item_category_id", "date"], how)


def _category_last(df: DataFrame) -> DataFrame:
    return df.select(*(c for c in df.columns if c not in CATEGORY), *CATEGORY)


def feature_table(parts: Parts, additional: bool = False) -> DataFrame:
    """The pair days (or those of additional pairs) joined to all grains.

    For additional pairs the category's days may be missing and count as 0.
    """
    if additional:
        return _category_last(merge_all_features(parts, zero_fill(_with_category(parts, parts.additional, "left"))))
    pairs = join_once(parts.pairs, parts.pair_totals, ["shop_id", "item_id"])
    return _category_last(merge_all_features(parts, _with_category(parts, pairs, "inner")))


def feature_table_of_both(parts: Parts) -> DataFrame:
    """The rows of both feature tables without the totals that only training's pairs have; the grains that both share are joined once."""
    known = _with_category(parts, parts.pairs, "inner")
    added = zero_fill(_with_category(parts, parts.additional, "left"))
    return _category_last(merge_all_features(parts, known.unionByName(added)))
