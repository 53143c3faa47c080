"""Dense daily panels and their per-key features.

A panel has a row for every day of a key's life. Every feature looks at days before its own
only. All of them share one partitioning and ordering, so a builder costs one exchange and one
sort for its windows however many columns it computes. A key's rows are bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.functions.windows import before, by, by_key
from demandloom.operators.running import add_order_statistics

PAIR, ITEM, SHOP = ("shop_id", "item_id"), ("item_id",), ("shop_id",)
PAIR_DAY = (*PAIR, "date")
EPOCH = date(1970, 1, 1)


def daily_qty(sales: DataFrame, levels: Sequence[str], qty: str = "item_cnt_day") -> DataFrame:
    return sales.groupBy(*levels, "date").agg(F.sum(qty).alias("qty"))


def densify(daily: DataFrame, levels: Sequence[str], tail_keys: DataFrame | None = None, tail_end: date | None = None) -> DataFrame:
    """Every day from a key's first to its last date, and on to ``tail_end`` for keys in ``tail_keys``.

    Each observed day makes the empty days up to the next one itself, so no spine is joined.
    Columns beside the levels and date are null on added days, but qty, which is 0; sold tells observed days.
    """
    if tail_keys is not None:
        daily = daily.join(tail_keys.select(*levels).distinct().withColumn("_tail", F.lit(tail_end)), list(levels), "left")
    else:
        daily = daily.withColumn("_tail", F.lit(None).cast("date"))
    daily = by_key(daily, levels)
    until = F.coalesce(F.date_sub(F.lead("date").over(by(levels)), 1), F.greatest("date", "_tail"))
    filled = daily.withColumn("_gap", F.datediff(until, "date")).withColumn("_day", F.explode(F.sequence(F.lit(0), F.col("_gap"))))
    own = F.col("_day") == 0
    rest = [c for c in daily.columns if c not in (*levels, "date", "qty", "_tail", "_gap")]
    return filled.select(*levels, F.date_add("date", F.col("_day")).alias("date"), F.when(own, F.col("qty")).otherwise(0.0).alias("qty"), own.alias("sold"), *(F.when(own, F.col(c)).alias(c) for c in rest))



def _positive() -> Column:
    return F.when(F.col("qty") > 0, F.col("qty"))


def _or0(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def prev_nonzero_qty(levels):
    return {"prev_nonzero_qty": F.coalesce(F.last(F.when(F.col("qty") != 0, F.col("qty")), True).over(before(levels)), F.lit(0.0))}


def days_since_prev_sale(levels):
    return {"days_since_prev_sale": _or0(F.datediff("date", F.last(F.when(F.col("qty") > 0, F.col("date")), True).over(before(levels))))}


def _age(levels) -> Column:
    return F.datediff("date", F.min("date").over(by(levels).rowsBetween(Window.unboundedPreceding, 0)))


def days_since_first_sale(levels):
    return {"days_since_first_sale": _age(levels)}


def first_week_month(levels):
    return {"first_week": (_age(levels) <= 6).cast("int"), "first_month": (_age(levels) <= 30).cast("int")}


def sale_day_counts(levels):
    flag = (F.col("qty") > 0).cast("int")
    return {f"sale_days_{n}": _or0(F.sum(flag).over(before(levels, d))) for n, d in (("7d", 7), ("30d", 30), ("all", None))}


def rolling_7d_stats(levels):
    """Of the previous 7 days; the first row has its own quantity."""
    q, w = F.col("qty"), before(levels, 7)
    stats = {"max": F.max(q), "min": F.min(q), "mean": F.avg(q), "mode": F.mode(-q, True), "median": F.percentile(q, F.lit(0.5))}
    return {f"qty_7d_{k}": F.coalesce(-c.over(w) if k == "mode" else c.over(w), q) for k, c in stats.items()}


def expanding_qty_moments(levels):
    q, w = F.col("qty"), before(levels)
    return {f"qty_all_{k}": F.coalesce(c.over(w), q) for k, c in (("max", F.max(q)), ("min", F.min(q)), ("mean", F.avg(q)))}


def expanding_qty_stats(panel: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Largest, smallest, mean, mode and median of all quantities before the day."""
    return add_order_statistics(panel.withColumns(expanding_qty_moments(levels)), levels, ("qty_all_mode", "qty_all_median"), placed=True)


def expanding_cv2(levels):
    w = before(levels)
    ratio = F.try_divide(F.stddev_pop(_positive()).over(w), F.avg(_positive()).over(w))
    return {"qty_cv2": F.coalesce(ratio * ratio, F.lit(0.0))}


def expanding_adi(levels):
    """Age over earlier sale days: 0 for 0/0, null for an age without a sale."""
    n = _or0(F.sum((F.col("qty") > 0).cast("int")).over(before(levels)))
    return {"adi": F.when((n == 0) & (_age(levels) == 0), F.lit(0.0)).otherwise(F.try_divide(_age(levels).cast("double"), n))}


def qty_lags(levels):
    return {f"qty_lag{k}": F.coalesce(F.lag("qty", k).over(by(levels)), F.lit(0.0)) for k in (1, 2, 3, 7)}


def expanding_gap_moments(levels):
    """Of the gap column days_since_prev_sale on sale days before the day; the first sale's gap is 0."""
    w, gap = before(levels), F.when(F.col("qty") > 0, F.col("days_since_prev_sale"))
    return {f"gap_{k}": F.coalesce(c.over(w), F.lit(0)) for k, c in (("max", F.max(gap)), ("min", F.min(gap)), ("mean", F.avg(gap)), ("std", F.stddev_pop(gap)))}


def last_two_step(levels):
    q = F.col("qty")
    return {"_step": F.when(q != 0, q - F.last(F.when(q != 0, q), True).over(before(levels)))}


def last_two_qty_diff(levels):
    """Needs last_two_step: the difference between the last two non-zero quantities before the day."""
    return {"last_two_qty_diff": F.coalesce(F.last("_step", True).over(before(levels)), F.lit(0.0))}


def days_since_max_qty(levels):
    day = F.datediff("date", F.lit(EPOCH))
    top = F.max(F.struct(F.col("qty"), (-day).alias("day"))).over(before(levels))
    return {"days_since_max_qty": _or0(day + top["day"])}


def expanding_price_cv(levels):
    w = before(levels)
    return {"price_cv": F.coalesce(F.try_divide(F.stddev_pop("price").over(w), F.avg("price").over(w)), F.lit(0.0))}


SIMPLE = (
    prev_nonzero_qty, days_since_prev_sale, days_since_first_sale, first_week_month, sale_day_counts, rolling_7d_stats, expanding_cv2, expanding_adi, qty_lags, days_since_max_qty,
)


def add_gap_stats(panel: DataFrame, levels: Sequence[str]) -> DataFrame:
    df = panel if "days_since_prev_sale" in panel.columns else panel.withColumns(days_since_prev_sale(levels))
    return add_order_statistics(df.withColumns(expanding_gap_moments(levels)), levels, ("gap_median", "gap_mode"), placed=True)


def add_last_two_qty_diff(panel: DataFrame, levels: Sequence[str]) -> DataFrame:
    return panel.withColumns(last_two_step(levels)).withColumns(last_two_qty_diff(levels)).drop("_step")


def _spike_flag(panel: DataFrame) -> DataFrame:
    return panel.withColumn("had_spike", (F.col("n_spikes") > 0).cast("int"))


def add_spikes(panel: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Earlier positive quantities above median + 2 population deviations of the earlier positive ones."""
    return _spike_flag(add_order_statistics(panel, levels, ("n_spikes",)))


def add_deviations(panel: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Mean and median (times 1.4826) absolute deviation of the quantities of observed days before the day."""
    return add_order_statistics(panel, levels, ("qty_mean_ad", "qty_median_ad"))


def unique_partners_before(panel: DataFrame, sales: DataFrame, levels: Sequence[str], partner: str, name: str) -> DataFrame:
    """Distinct partners with a sales row of the key before the day: first dates are counted and summed up, no set is kept."""
    first = sales.groupBy(*levels, partner).agg(F.min("date").alias("date"))
    fresh = first.groupBy(*levels, "date").agg(F.count("*").alias("_new"))
    return panel.join(fresh, [*levels, "date"], "left").withColumn(name, _or0(F.sum("_new").over(before(levels)))).drop("_new")


def panel_features(panel: DataFrame, levels: Sequence[str], extras: Sequence[str] = ()) -> DataFrame:
    """A dense panel with all features that its levels share: windows by key first, then one pass for order statistics.

    Columns that come from joins are best added before, while rows are short; columns beside the levels, date, qty, sold and price stand last.
    """
    own = [c for c in panel.columns if c in (*levels, "date", "qty", "sold", "price")]
    more = [c for c in panel.columns if c not in own]
    columns: dict[str, Column] = {}
    for f in (*SIMPLE, expanding_qty_moments):
        columns |= f(levels)
    df = add_last_two_qty_diff(panel.withColumns(columns).withColumns(expanding_gap_moments(levels)), levels)
    wanted = ["qty_all_mode", "qty_all_median", "gap_median", "gap_mode", "n_spikes"]
    if "price" in extras:
        df = df.withColumns(expanding_price_cv(levels)).drop("price")
        wanted += ["qty_mean_ad", "qty_median_ad"]
    out = _spike_flag(add_order_statistics(df, levels, wanted, placed=True))
    return out.select(*(c for c in out.columns if c not in more), *more)


def empty_features(spark: SparkSession, days: int, levels: Sequence[str], extras: Sequence[str] = ()) -> DataFrame:
    """Features of a key that never sold by its age: they depend on nothing else, so one key of so many days stands for all."""
    key = spark.range(days).select(*(F.lit(0).alias(k) for k in levels), F.date_add(F.lit(EPOCH), F.col("id").cast("int")).alias("date"), F.lit(0.0).alias("qty"), F.lit(False).alias("sold"), F.lit(None).cast("double").alias("price"))
    return panel_features(key, levels, extras).withColumn("age", F.datediff("date", F.lit(EPOCH))).drop(*levels, "date", "qty", "sold")


def build_panel(sales: DataFrame, test: DataFrame, levels: Sequence[str], train_end: date, extras: Sequence[str] = ()) -> DataFrame:
    """The dense panel of a grain with all features that its levels share."""
    daily = sales.groupBy(*levels, "date").agg(F.sum("item_cnt_day").alias("qty"), *((F.avg("item_price").alias("price"),) if "price" in extras else ()))
    return panel_features(densify(daily, levels, test, train_end), levels, extras)


def additional_days(pairs: DataFrame, sales: DataFrame, train_end: date) -> DataFrame:
    """Empty days of pairs that never sold, and how many such days were before: from the first day on which both their shop and their item had sold, to ``train_end``."""
    first = lambda key: sales.groupBy(key).agg(F.min("date").alias(f"_{key}"))
    begun = pairs.select(*PAIR).distinct().join(first("shop_id"), "shop_id").join(first("item_id"), "item_id")
    days = by_key(begun, PAIR).select(*PAIR, F.posexplode(F.sequence(F.greatest("_shop_id", "_item_id"), F.lit(train_end))).alias("age", "date"))
    return days.select(*PAIR, "date", "age", F.lit(0.0).alias("qty"), F.lit(False).alias("sold"), F.lit(None).cast("double").alias("price"))


# Older variants on the sparse series.


def monthly_qty_stats(daily: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Per key and calendar month, joined back to days: mean, population std, median, min and max of daily quantity."""
    month = F.trunc("date", "month").alias("month")
    stats = daily.groupBy(*levels, month).agg(F.avg("qty").alias("m_mean"), F.stddev_pop("qty").alias("m_std"), F.percentile("qty", F.lit(0.5)).alias("m_median"), F.min("qty").alias("m_min"), F.max("qty").alias("m_max"))
    return daily.withColumn("month", month).join(stats, [*levels, "month"]).drop("month")


def _days(levels, first: int, last: int):
    return Window.partitionBy(*levels).orderBy("_no").rangeBetween(first, last)


def range_stats(daily: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Largest and smallest of the 7 calendar days ending today, rows in the 30 days ending today, running values including today."""
    df = daily.withColumn("_no", F.datediff("date", F.lit(EPOCH)))
    run = by(levels).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns(
        {
            "max_7d": F.max("qty").over(_days(levels, -6, 0)), "min_7d": F.min("qty").over(_days(levels, -6, 0)), "rows_30d": F.count("*").over(_days(levels, -29, 0)),
            "run_max": F.max("qty").over(run), "run_min": F.min("qty").over(run), "run_mean": F.avg("qty").over(run),
        }
    ).drop("_no")


def calendar_lags(daily: DataFrame, levels: Sequence[str], lags: Sequence[int]) -> DataFrame:
    """Quantity exactly so many calendar days ago, 0 if that day has no row: frames one day wide instead of self-joins."""
    df = daily.withColumn("_no", F.datediff("date", F.lit(EPOCH)))
    return df.withColumns({f"qty_{k}d_ago": F.coalesce(F.sum("qty").over(_days(levels, -k, -k)), F.lit(0.0)) for k in lags}).drop("_no")


def row_neighbours(daily: DataFrame, levels: Sequence[str]) -> DataFrame:
    """The previous observed row's quantity and distance, and days until the key's last one."""
    w = by(levels)
    return daily.withColumns(
        {"prev_row_qty": F.lag("qty").over(w), "gap_to_prev_row": F.datediff("date", F.lag("date").over(w)), "days_until_last": F.datediff(F.max("date").over(w.rowsBetween(0, Window.unboundedFollowing)), "date")}
    )


def shop_closure_flags(sales: DataFrame, cutoff: date) -> DataFrame:
    """Shop-days with closed (last date before the cut-off) and whether they lie in its last or second to last month."""
    days = sales.select("shop_id", "date").distinct()
    last = sales.groupBy("shop_id").agg(F.max("date").alias("_last"))
    months = (F.year("_last") - F.year("date")) * 12 + F.month("_last") - F.month("date")
    closed = F.col("_last") < F.lit(cutoff)
    return days.join(last, "shop_id").select("shop_id", "date", closed.cast("int").alias("closed"), (closed & (months == 0)).cast("int").alias("last_month"), (closed & (months == 1)).cast("int").alias("second_last_month"))


def shop_item_totals(sales: DataFrame) -> DataFrame:
    """Quantity, distinct dates and the shop's rank for the item by quantity (ties share the smallest rank)."""
    totals = sales.groupBy("shop_id", "item_id").agg(F.sum("item_cnt_day").alias("qty"), F.count_distinct("date").alias("n_dates"))
    return totals.withColumn("shop_rank", F.rank().over(Window.partitionBy("item_id").orderBy(F.desc("qty"))))


# Category demand.


def sliding_distinct(events: DataFrame, days: DataFrame, group: Sequence[str], member: str, width: int, name: str) -> DataFrame:
    """``days`` with ``name``: distinct members with an event in the ``width`` days before the day.

    ``days`` has every day of a group (rows group, date). A member's events cover stretches of days; a stretch counts +1 where it begins and
    -1 after its end, and these are summed in order. The work doesn't depend on the width.
    """
    w = by([*group, member])
    known = events.select(*group, member, "date").distinct()
    near = known.select(*group, "date", F.lag("date").over(w).alias("_before"), F.lead("date").over(w).alias("_after"))
    begins = F.when(F.col("_before").isNull() | (F.datediff("date", "_before") > width), F.struct(F.date_add("date", 1).alias("date"), F.lit(1).alias("step")))
    ends = F.when(F.col("_after").isNull() | (F.datediff("_after", "date") > width), F.struct(F.date_add("date", width + 1).alias("date"), F.lit(-1).alias("step")))
    steps = near.select(*group, F.explode(F.filter(F.array(begins, ends), lambda x: x.isNotNull())).alias("_x")).groupBy(*group, F.col("_x.date").alias("date")).agg(F.sum("_x.step").alias("_step"))
    run = by(group).rowsBetween(Window.unboundedPreceding, 0)
    return days.join(steps, [*group, "date"], "left").withColumn(name, _or0(F.sum("_step").over(run))).drop("_step")


def category_demand(panel: DataFrame, categories: DataFrame, width: int = 7) -> DataFrame:
    """Of the item's category over the previous 7 days: quantity, distinct items sold, and their ratio."""
    named = panel.join(categories, "item_id")
    key = ("item_category_id",)
    daily = densify(named.groupBy(*key, "date").agg(F.sum("qty").alias("qty")), key)
    whole = daily.withColumn("category_qty_7d", F.coalesce(F.sum("qty").over(before(key, width)), F.lit(0.0))).drop("qty", "sold")
    whole = sliding_distinct(named.filter("qty > 0"), whole, key, "item_id", width, "category_items_7d")
    whole = whole.withColumn("category_qty_per_item_7d", F.coalesce(F.try_divide("category_qty_7d", "category_items_7d"), F.lit(0.0)))
    return named.join(whole, [*key, "date"], "left")


def shop_category_panel(sales: DataFrame, categories: DataFrame) -> DataFrame:
    """Dense shop-category days: quantity, that of the previous 7 days, and whether anything net was sold before."""
    key = ("shop_id", "item_category_id")
    daily = densify(sales.join(categories, "item_id").groupBy(*key, "date").agg(F.sum("item_cnt_day").alias("qty")), key)
    return daily.withColumns(
        {"category_qty_7d": F.coalesce(F.sum("qty").over(before(key, 7)), F.lit(0.0)), "category_sold": (F.coalesce(F.sum("qty").over(before(key)), F.lit(0.0)) != 0).cast("int")}
    ).drop("sold")
