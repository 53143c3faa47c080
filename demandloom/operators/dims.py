"""Shop and item features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions import text
from demandloom.functions.windows import cv
from demandloom.operators.clean import add_col_prefix


def shop_filter_fix(shops: DataFrame, drop: Sequence[int], names: Mapping[int, str], online: Sequence[int], online_city: str) -> DataFrame:
    """Without the listed shops, with corrected names, and city: the name's first token, or ``online_city``."""
    name = F.col("shop_name")
    for shop, fixed in names.items():
        name = F.when(F.col("shop_id") == shop, fixed).otherwise(name)
    kept = shops.filter(~F.col("shop_id").isin(*drop)).withColumn("shop_name", name)
    return kept.withColumn("city", F.when(F.col("shop_id").isin(*online), online_city).otherwise(text.first_token("shop_name")))


def shop_city_join(shops: DataFrame, cities: DataFrame) -> DataFrame:
    """Population, coordinates and zone of the shop's city; the list of cities is small by nature."""
    lat, lon = text.dms_to_decimal("geo_coords")
    lookup = cities.select("city", "population", lat.alias("lat"), lon.alias("lon"), text.utc_offset("time_zone").alias("utc_offset"))
    return shops.join(lookup, "city", "left")


def other_shops_in_city(shops: DataFrame, online_city: str) -> DataFrame:
    n = F.count("*").over(Window.partitionBy("city")) - 1
    return shops.withColumns({"online": (F.col("city") == online_city).cast("int"), "other_shops": F.when(F.col("city") != online_city, n)})


def fill_from_reference_row(df: DataFrame, columns: Sequence[str], city: str) -> DataFrame:
    """Nulls of ``columns`` filled from the first shop (by id) of ``city``."""
    one = df.filter(F.col("city") == city).orderBy("shop_id").limit(1).select(*(F.col(c).alias(f"_{c}") for c in columns))
    filled = df.join(F.broadcast(one), F.lit(True), "left")  # one row at most
    return filled.select(*(F.coalesce(c, f"_{c}").alias(c) if c in columns else F.col(c) for c in df.columns))


def build_shop_features(shops: DataFrame, cities: DataFrame, drop=(9, 20), names=None, online=(55,), online_city="online", reference_city="CHINA") -> DataFrame:
    fixed = shop_filter_fix(shops, drop, names or {}, online, online_city)
    joined = other_shops_in_city(shop_city_join(fixed, cities), online_city)
    filled = fill_from_reference_row(joined, ["population", "lat", "lon", "utc_offset"], reference_city)
    return add_col_prefix(filled.select("shop_id", "city", "population", "lat", "lon", "utc_offset", "online", "other_shops"), "s_", ["shop_id"])


def shop_activity_counts(sales: DataFrame, items: DataFrame) -> DataFrame:
    """Transactions, distinct items and distinct categories of each shop."""
    return sales.join(items.select("item_id", "item_category_id"), "item_id", "left").groupBy("shop_id").agg(
        F.count("*").alias("n_sales"), F.count_distinct("item_id").alias("n_items"), F.count_distinct("item_category_id").alias("n_categories")
    )


def item_first_sale_month(sales: DataFrame, test_items: DataFrame, train_start: date, test_month: int) -> DataFrame:
    """Month (from 0, counted in the year) of each item's first sale: 0 for the first train month, ``test_month`` for items only in test."""
    first = sales.groupBy("item_id").agg(F.min("date").alias("first_date"))
    both = first.join(test_items.select("item_id").distinct(), "item_id", "full")
    censored = F.trunc("first_date", "month") == F.lit(train_start.replace(day=1))
    return both.withColumn("month_of_first_sale", F.when(F.col("first_date").isNull(), test_month).when(censored, 0).otherwise(F.month("first_date") - 1).cast("int"))


def item_category_join(items: DataFrame, names: DataFrame, categories: DataFrame) -> DataFrame:
    return items.join(names, "item_id", "left").join(categories, "item_category_id", "left")


def build_item_features(sales: DataFrame, test_items: DataFrame, names: DataFrame, categories: DataFrame, train_start: date, test_month: int, groups: Sequence[tuple[str, str]], digital: Sequence[str]) -> DataFrame:
    first = item_first_sale_month(sales, test_items, train_start, test_month)
    joined = item_category_join(first, names, categories)
    named = joined.withColumns(
        {"broad_category": text.first_token("item_category_name"), "group": text.first_match("item_category_name", groups), "digital": text.contains_any("item_category_name", digital)}
    )
    return add_col_prefix(named.select("item_id", "item_category_id", "month_of_first_sale", "broad_category", "group", "digital"), "i_", ["item_id"])


def item_price_cv(sales: DataFrame) -> DataFrame:
    return sales.groupBy("item_id").agg(cv(F.col("item_price")).alias("price_cv"))


def item_qty_mad(sales: DataFrame) -> DataFrame:
    """Mean absolute deviation of quantity from its mean: quantities are counted first, so no item's rows meet unsummed."""
    counted = sales.groupBy("item_id", "item_cnt_day").agg(F.count("*").alias("n"))
    mean = counted.groupBy("item_id").agg((F.sum(F.col("item_cnt_day") * F.col("n")) / F.sum("n")).alias("mean"))
    return counted.join(mean, "item_id").groupBy("item_id").agg((F.sum(F.abs(F.col("item_cnt_day") - F.col("mean")) * F.col("n")) / F.sum("n")).alias("qty_mad"))


def item_unique_counts(sales: DataFrame) -> DataFrame:
    return sales.groupBy("item_id").agg(F.count_distinct("shop_id").alias("n_shops"), F.count_distinct("date").alias("n_dates"))


def item_gap_stats(sales: DataFrame) -> DataFrame:
    """Day gaps between an item's distinct sale dates: mean, population std, median, min, max."""
    days = sales.select("item_id", "date").distinct()
    gap = days.withColumn("gap", F.datediff("date", F.lag("date").over(Window.partitionBy("item_id").orderBy("date"))))
    return gap.groupBy("item_id").agg(
        F.avg("gap").alias("gap_mean"), F.stddev_pop("gap").alias("gap_std"), F.percentile("gap", F.lit(0.5)).alias("gap_median"), F.min("gap").alias("gap_min"), F.max("gap").alias("gap_max")
    )


def items_in_category(items: DataFrame) -> DataFrame:
    sizes = items.groupBy("item_category_id").agg(F.count("*").alias("n_in_category"))
    return items.select("item_id", "item_category_id").join(sizes, "item_category_id", "left")


def item_qty_spikes(sales: DataFrame) -> DataFrame:
    """Rows above mean + 2 population deviations of the item: count, flag, and whether one lies within 7 days of its first sale."""
    stats = sales.groupBy("item_id").agg(F.avg("item_cnt_day").alias("m"), F.stddev_pop("item_cnt_day").alias("s"), F.min("date").alias("first"))
    spike = F.col("item_cnt_day") > F.col("m") + 2 * F.col("s")
    return sales.join(stats, "item_id").groupBy("item_id").agg(
        F.count_if(spike).alias("n_spikes"), F.max(spike.cast("int")).alias("had_spike"), F.max((spike & (F.datediff("date", "first") <= 7)).cast("int")).alias("had_early_spike")
    )
