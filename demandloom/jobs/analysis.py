"""Analyses of sales: each function is one job over DataFrames with the sales columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.asof import last_before
from demandloom.functions.selection import exact_quantiles

from demandloom.functions.windows import by, cv

PAIR = ("shop_id", "item_id")


def first_dates(sales: DataFrame, keys: Sequence[str], name: str = "first_date") -> DataFrame:
    return sales.groupBy(*keys).agg(F.min("date").alias(name))


def distinct_values_union(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of several columns as rows (column, value): values are made distinct before they are stacked."""
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns))
    return df.select(F.explode(pairs).alias("p")).select("p.*").distinct()


def orphan_shops(sales: DataFrame, shops: DataFrame, first: date, last: date) -> DataFrame:
    inside = sales.filter(F.col("date").between(F.lit(first), F.lit(last)))
    return inside.select("shop_id").distinct().join(shops, "shop_id", "left_anti")


def active_item_days(sales: DataFrame) -> DataFrame:
    """Days of each item that ever sold more than one piece in a row."""
    return sales.groupBy("item_id").agg(F.count_distinct("date").alias("n_days"), F.max("item_cnt_day").alias("_m")).filter("_m > 1").drop("_m")


def new_pairs_not_in_train(test: DataFrame, train: DataFrame) -> DataFrame:
    return test.select(*PAIR).distinct().join(train.select("item_id").distinct(), "item_id", "left_semi").join(train.select(*PAIR).distinct(), list(PAIR), "left_anti").select(*PAIR)


def items_not_in_train(test: DataFrame, train: DataFrame) -> DataFrame:
    return test.select("item_id").distinct().join(train.select("item_id"), "item_id", "left_anti")


def first_rows_after(sales: DataFrame, start: date) -> DataFrame:
    """Rows of each pair's first date, for pairs first sold on or after ``start``."""
    first = first_dates(sales, PAIR).filter(F.col("first_date") >= F.lit(start))
    return sales.join(first, [*PAIR], "inner").filter(F.col("date") == F.col("first_date")).drop("first_date")


def lag_to_first_shop_sale(sales: DataFrame) -> DataFrame:
    pairs, items = first_dates(sales, PAIR), first_dates(sales, ("item_id",), "item_first")
    return pairs.join(items, "item_id").agg(F.sum(F.datediff("first_date", "item_first")).alias("n_days"))


def days_to_add_train(sales: DataFrame) -> DataFrame:
    pairs = first_dates(sales, PAIR).join(first_dates(sales, ("shop_id",), "shop_first"), "shop_id").join(first_dates(sales, ("item_id",), "item_first"), "item_id")
    return pairs.agg(F.sum(F.datediff("first_date", F.greatest("shop_first", "item_first"))).alias("n_days"))


def days_to_add_test(test: DataFrame, train: DataFrame, test_start: date) -> DataFrame:
    new = new_pairs_not_in_train(test, train).join(first_dates(train, ("shop_id",), "shop_first"), "shop_id").join(first_dates(train, ("item_id",), "item_first"), "item_id")
    return new.agg(F.sum(F.datediff(F.lit(test_start), F.greatest("shop_first", "item_first"))).alias("n_days"))


def unmatched_after_join(df: DataFrame, shops: DataFrame, items: DataFrame) -> DataFrame:
    """Rows without a match among shops, among items, and in either."""
    s = shops.select("shop_id", F.lit(1).alias("_s")).distinct()
    i = items.select("item_id", F.lit(1).alias("_i")).distinct()
    no_shop, no_item = F.col("_s").isNull(), F.col("_i").isNull()
    return df.join(s, "shop_id", "left").join(i, "item_id", "left").agg(F.count_if(no_shop).alias("no_shop"), F.count_if(no_item).alias("no_item"), F.count_if(no_shop | no_item).alias("either"))


def item_history_slice(sales: DataFrame, items: Sequence[int]) -> DataFrame:
    return sales.filter(F.col("item_id").isin(*items)).select("item_id", "shop_id", "date", "item_cnt_day").orderBy("item_id", "shop_id", "date", "item_cnt_day")


def fill_from_later(df: DataFrame, keys: Sequence[str], column: str, order: str = "date") -> DataFrame:
    """Nulls of ``column`` filled with the key's nearest later value."""
    w = by(keys, order).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(column, F.first(column, True).over(w))


def price_changed(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys had one price only (false) and how many more than one (true)."""
    return sales.groupBy(*keys).agg((F.min("item_price") != F.max("item_price")).alias("changed")).groupBy("changed").agg(F.count("*").alias("n"))


def top_price_cv(sales: DataFrame, n: int) -> DataFrame:
    found = sales.groupBy(*PAIR).agg(cv(F.col("item_price")).alias("price_cv")).filter("price_cv is not null")
    return found.orderBy(F.desc(F.round("price_cv", 9)), *PAIR).limit(n)


def zero_share(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg((F.col(column) == 0).cast("int")).alias("zero_share"))


def sale_day_share(sales: DataFrame, key: str) -> DataFrame:
    """Distinct sale days of each key, and their share of all calendar days of the table."""
    span = sales.agg((F.datediff(F.max("date"), F.min("date")) + 1).alias("_days"))
    days = sales.groupBy(key).agg(F.count_distinct("date").alias("n_days"))
    return days.join(F.broadcast(span)).select(key, "n_days", (F.col("n_days") / F.col("_days")).alias("share"))


def count_of_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n_keys")).orderBy(F.desc("n_keys"), column)


def avg_gap_between_sales(sales: DataFrame, key: str) -> DataFrame:
    """Mean distance of a key's distinct sale dates: their span over one less than their number; 0 for one date."""
    n = F.count_distinct("date")
    return sales.groupBy(key).agg(F.when(n > 1, F.datediff(F.max("date"), F.min("date")) / (n - 1)).otherwise(0.0).alias("avg_gap"))


def first_last_dates(sales: DataFrame, key: str) -> DataFrame:
    return sales.groupBy(key).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), (F.datediff(F.max("date"), F.min("date")) + 1).alias("duration"))


def closed_shops(sales: DataFrame, cutoff: date) -> DataFrame:
    return sales.groupBy("shop_id").agg(F.max("date").alias("last_date")).filter(F.col("last_date") < F.lit(cutoff))


def closure_trend(sales: DataFrame, cutoff: date) -> DataFrame:
    """Monthly quantity of closed shops, with months before closure."""
    months = (F.year("last_date") - F.year("date")) * 12 + F.month("last_date") - F.month("date")
    return sales.join(closed_shops(sales, cutoff), "shop_id").groupBy("shop_id", months.alias("months_before")).agg(F.sum("item_cnt_day").alias("qty"))


def extreme_rows(sales: DataFrame) -> DataFrame:
    """Rows with the largest or smallest quantity, or a price that isn't above 0."""
    ends = sales.agg(F.max("item_cnt_day").alias("_hi"), F.min("item_cnt_day").alias("_lo"))
    met = sales.join(F.broadcast(ends))  # one row
    return met.filter((F.col("item_cnt_day") == F.col("_hi")) | (F.col("item_cnt_day") == F.col("_lo")) | (F.col("item_price") <= 0)).drop("_hi", "_lo")


def match_returns(sales: DataFrame) -> DataFrame:
    """Each negative row with the latest earlier date of a sale of equal shop, item, price and quantity, or null.

    An as-of join over stretches of each key's history instead of a many-to-many join; dates strictly before count.
    """
    sized = sales.withColumn("_size", F.abs("item_cnt_day"))
    sold = F.when(F.col("item_cnt_day") > 0, F.col("date"))
    found = last_before(sized, ["shop_id", "item_id", "item_price", "_size"], F.datediff("date", F.lit(date(1970, 1, 1))), sold, "sold_on")
    return found.filter("item_cnt_day < 0").drop("_size")


def unmatched_returns_by_month(sales: DataFrame) -> DataFrame:
    return match_returns(sales).filter("sold_on is null").groupBy("date_block_num").agg(F.count("*").alias("n"))


def negative_by_key(sales: DataFrame, keys: Sequence[str], n: int | None = None, ascending: bool = False) -> DataFrame:
    counts = sales.filter("item_cnt_day < 0").groupBy(*keys).agg(F.count("*").alias("n_negative"))
    return counts if n is None else counts.orderBy(F.asc("n_negative") if ascending else F.desc("n_negative"), *keys).limit(n)


def seen_counts(sales: DataFrame, last: bool = False) -> DataFrame:
    """Items per date of first (last) sale, without the table's own first (last) date, which censors."""
    pick = F.max if last else F.min
    edge = sales.agg(pick("date").alias("_edge"))
    per = sales.groupBy("item_id").agg(pick("date").alias("date")).groupBy("date").agg(F.count("*").alias("n_items"))
    return per.join(F.broadcast(edge)).filter(F.col("date") != F.col("_edge")).drop("_edge")


def resample_sum(df: DataFrame, column: str, period: str) -> DataFrame:
    """Sums by month start, or by week as its Sunday."""
    when = F.trunc("date", "month") if period == "month" else F.date_add(F.trunc("date", "week"), 6)
    return df.groupBy(when.alias("period")).agg(F.sum(column).alias(column))


def dow_counts(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.date_format("date", "EEEE").alias("dow")).agg(F.count("*").alias("n_rows"), F.sum("item_cnt_day").alias("qty"))


def shops_not_every_dow(sales: DataFrame) -> DataFrame:
    return sales.groupBy("shop_id").agg(F.count_distinct(F.weekday("date")).alias("n_dow")).filter("n_dow < 7")


def dow_share_by_shop(sales: DataFrame) -> DataFrame:
    """Percentage of a shop's quantity on each weekday (Monday 0)."""
    daily = sales.groupBy("shop_id", F.weekday("date").alias("dow")).agg(F.sum("item_cnt_day").alias("_q"))
    return daily.select("shop_id", "dow", (100 * F.try_divide("_q", F.sum("_q").over(Window.partitionBy("shop_id")))).alias("pct"))


def largest_dow_share(sales: DataFrame) -> DataFrame:
    """The weekday of a shop with the largest percentage of all, the first by shop and weekday of several."""
    return dow_share_by_shop(sales).withColumn("pct", F.round("pct", 9)).filter("pct is not null").orderBy(F.desc("pct"), "shop_id", "dow").limit(1)


def items_by_shop_count(sales: DataFrame) -> DataFrame:
    return count_of_counts(sales.groupBy("item_id").agg(F.count_distinct("shop_id").alias("n_shops")), "n_shops")


def running_share(sales: DataFrame) -> DataFrame:
    """Per item and date: running quantity, whether within 7 days of the first date, and its share of the largest running quantity."""
    daily = sales.groupBy("item_id", "date").agg(F.sum("item_cnt_day").alias("qty"))
    w = by(("item_id",))
    run = daily.withColumns({"running": F.sum("qty").over(w.rowsBetween(Window.unboundedPreceding, 0)), "_first": F.min("date").over(w.rowsBetween(Window.unboundedPreceding, 0))})
    most = F.max("running").over(Window.partitionBy("item_id"))
    return run.select("item_id", "date", "running", (F.datediff("date", "_first") <= 7).cast("int").alias("first_week"), F.try_divide("running", most).alias("share"))


def first_week_share(sales: DataFrame) -> DataFrame:
    return running_share(sales).groupBy("item_id").agg(F.try_divide(F.max(F.when(F.col("first_week") == 1, F.col("running"))), F.max("running")).alias("first_week_share"))


def days_to_half(sales: DataFrame) -> DataFrame:
    """Days, counting the first, until an item's running share reaches one half."""
    found = running_share(sales).groupBy("item_id").agg((F.datediff(F.min(F.when(F.col("share") >= 0.5, F.col("date"))), F.min("date")) + 1).alias("n_days"))
    return found.filter("n_days is not null")


def share_at_most(df: DataFrame, column: str, most: int) -> DataFrame:
    return df.agg(F.avg((F.col(column) <= most).cast("int")).alias("share"))


def id_set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The ids that only one of two tables has: key and side, only_a or only_b."""
    only = lambda x, y, side: x.select(key).distinct().join(y.select(key).distinct(), key, "left_anti").withColumn("side", F.lit(side))
    return only(a, b, "only_a").unionByName(only(b, a, "only_b"))


def id_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """How many ids are only in a, only in b, and in both, from one full join of distinct ids."""
    x = a.select(key).distinct().withColumn("_a", F.lit(1))
    y = b.select(key).distinct().withColumn("_b", F.lit(1))
    return x.join(y, key, "full").agg(F.count_if(F.col("_b").isNull()).alias("only_a"), F.count_if(F.col("_a").isNull()).alias("only_b"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("both"))


def subset_first_seen(sales: DataFrame, test: DataFrame) -> DataFrame:
    """One-day items that are also in test, counted by month of first sale."""
    one = sales.groupBy("item_id").agg(F.min("date").alias("first"), F.count_distinct("date").alias("n")).filter("n = 1")
    return one.join(test.select("item_id").distinct(), "item_id", "left_semi").groupBy(F.trunc("first", "month").alias("month")).agg(F.count("*").alias("n_items"))


def duplicate_check(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and surplus rows, overall or on some columns."""
    counts = df.groupBy(*(columns or df.columns)).agg(F.count("*").alias("_n"))
    return counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_distinct"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_surplus"))


def categories_only_in_test(test: DataFrame, train: DataFrame, items: DataFrame) -> DataFrame:
    named = items.select("item_id", "item_category_id")
    fresh = items_not_in_train(test, train).join(named, "item_id").select("item_category_id").distinct()
    known = train.select("item_id").distinct().join(named, "item_id").select("item_category_id").distinct()
    return fresh.subtract(known)


def sales_with_category(sales: DataFrame, items: DataFrame, categories: DataFrame) -> DataFrame:
    return sales.join(items, "item_id", "left").join(categories, "item_category_id", "left")


def revenue_by_category(named: DataFrame, n: int | None = None) -> DataFrame:
    total = named.groupBy("item_category_name").agg(F.sum(F.col("item_price") * F.col("item_cnt_day")).alias("revenue"))
    return total if n is None else total.orderBy(F.desc(F.round("revenue", 2)), "item_category_name").limit(n)


def revenue_over_time(named: DataFrame, broad: str | None = None) -> DataFrame:
    rows = named if broad is None else named.filter(F.startswith(F.col("item_category_name"), F.lit(broad)))
    return rows.groupBy("date", "item_category_name").agg(F.sum(F.col("item_price") * F.col("item_cnt_day")).alias("revenue"))


def daily_mean_to_calendar(df: DataFrame, value: str, day: str, calendar: DataFrame) -> DataFrame:
    means = df.groupBy(F.col(day).alias("date")).agg(F.avg(value).alias("mean_value"))
    return calendar.join(means, "date", "left")


def monthly_median(df: DataFrame, day: str, columns: Sequence[str]) -> DataFrame:
    """Monthly median of every column, by exact selection; null where a month has no value."""
    rows = df.withColumn("month", F.trunc(day, "month"))
    found = exact_quantiles(rows, columns, [0.5], ["month"]).groupBy("key").agg(*(F.max(F.when(F.col("field") == c, F.col("q")[0])).alias(c) for c in columns))
    every = rows.select(F.struct("month").alias("key")).distinct()
    return every.join(found, "key", "left").select("key.month", *(F.col(c) for c in columns))
