"""Date features: one row a day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from math import pi

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.operators.clean import add_col_prefix
from demandloom.params import Calendar


def date_spine(df: DataFrame, until: date | None = None, col: str = "date") -> DataFrame:
    """Every day from the first date of ``df`` to its last one, or to ``until`` if that is later; none without dates."""
    ends = df.agg(F.min(col).alias("a"), F.max(col).alias("z"))
    last = F.greatest("z", F.lit(until)) if until else F.col("z")
    return ends.filter("a is not null").select(F.explode(F.sequence("a", last)).alias("date"))


def calendar_parts(df: DataFrame, start: date, short_february: bool = False) -> DataFrame:
    """Counters from ``start`` and parts of each date; weeks are ISO weeks, Monday is weekday 0.

    With ``short_february`` every February counts as 28 days long, also in leap years.
    """
    d = F.col("date")
    months = (F.year(d) - start.year) * 12 + F.month(d) - start.month
    length = F.day(F.last_day(d))
    if short_february:
        length = F.when(F.month(d) == 2, 28).otherwise(length)
    return df.withColumns(
        {
            "month_counter": months, "day_counter": F.datediff(d, F.lit(start)) + 1, "year": F.year(d), "month": F.pmod(months, F.lit(12)), "days_in_month": length,
            "weekday": F.weekday(d), "weekend": (F.weekday(d) >= 5).cast("int"), "quarter": F.quarter(d), "quarter_counter": F.floor(months / 3).cast("int") + 1, "week": F.weekofyear(d),
        }
    )


def cyclic_encoding(df: DataFrame) -> DataFrame:
    out = {}
    for name, period in (("month", 12), ("weekday", 7), ("quarter", 4), ("week", 52)):
        angle = F.col(name) * (2 * pi / period)
        out |= {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}
    return df.withColumns(out)


def holiday_features(df: DataFrame, holidays: Sequence[date]) -> DataFrame:
    """Is holiday, days to the next holiday and since the last one (0 on one, null if there is none)."""
    days = F.array(*map(F.lit, sorted(holidays))).cast("array<date>")
    d = F.col("date")
    return df.withColumns(
        {
            "holiday": F.array_contains(days, d).cast("int"),
            "days_to_holiday": F.datediff(F.array_min(F.filter(days, lambda h: h >= d)), d),
            "days_since_holiday": F.datediff(d, F.array_max(F.filter(days, lambda h: h <= d))),
        }
    )


def event_flag(df: DataFrame, ranges: Sequence[tuple[date, date]]) -> DataFrame:
    hit = F.lit(False)
    for a, b in ranges:
        hit = hit | F.col("date").between(F.lit(a), F.lit(b))
    return df.withColumn("event", hit.cast("int"))


def macro_join(df: DataFrame, macro: DataFrame, start: date, end: date) -> DataFrame:
    """Left join of the macro columns that have no null in the period."""
    inside = macro.filter(F.col("date").between(F.lit(start), F.lit(end)))
    columns = [c for c in macro.columns if c != "date"]
    nulls = inside.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns)).first()
    return df.join(inside.select("date", *(c for c in columns if nulls[c] == 0)), "date", "left")


def release_features(df: DataFrame, releases: DataFrame, end: date, days: int = 3) -> DataFrame:
    """Releases per day, a flag for any, and a flag for the ``days`` days from a release on."""
    known = releases.filter(F.col("release_date") <= F.lit(end))
    counts = known.groupBy(F.col("release_date").alias("date")).agg(F.count("*").alias("n_releases"))
    window = counts.select(F.explode(F.sequence("date", F.date_add("date", days - 1))).alias("date")).distinct().withColumn("release_window", F.lit(1))
    joined = df.join(counts, "date", "left").join(window, "date", "left")
    return joined.withColumns({"n_releases": F.coalesce("n_releases", F.lit(0)), "any_release": F.coalesce((F.col("n_releases") > 0).cast("int"), F.lit(0)), "release_window": F.coalesce("release_window", F.lit(0))})


def daily_total_qty(df: DataFrame, sales: DataFrame, qty: str = "item_cnt_day") -> DataFrame:
    """Sum of quantity per day of the spine, 0 without sales."""
    return df.join(sales.groupBy("date").agg(F.sum(qty).alias("total_qty")), "date", "left").withColumn("total_qty", F.coalesce("total_qty", F.lit(0.0)))


def daily_lags(df: DataFrame, macro_column: str | None = None) -> DataFrame:
    """Total quantity 1, 6 and 7 days ago, and one macro column of yesterday; 0 where there is none. One row a day enters the window."""
    w = Window.orderBy("date")
    out = {f"total_qty_lag{k}": F.coalesce(F.lag("total_qty", k).over(w), F.lit(0.0)) for k in (1, 6, 7)}
    if macro_column:
        out[f"{macro_column}_lag1"] = F.coalesce(F.lag(macro_column, 1).over(w), F.lit(0.0))
    return df.withColumns(out)


def calendar_features(days: DataFrame, calendar: Calendar) -> DataFrame:
    """Parts, their cycles, holidays and events of each day."""
    return event_flag(holiday_features(cyclic_encoding(calendar_parts(days, calendar.train_start)), calendar.holidays), calendar.events)


def build_date_features(calendar: Calendar, sales: DataFrame, macro: DataFrame | None = None, releases: DataFrame | None = None, macro_column: str = "brent") -> DataFrame:
    """All date features from the first sale to the end of the test period; sales are those of the train period."""
    df = calendar_features(date_spine(sales, calendar.test_end), calendar)
    if macro is not None:
        df = macro_join(df, macro, calendar.train_start, calendar.train_end)
    if releases is not None:
        df = release_features(df, releases, calendar.test_end)
    return add_col_prefix(daily_lags(daily_total_qty(df, sales), macro_column if macro is not None else None), "d_", ["date"])


def daily_series(sales: DataFrame, start: date, end: date, qty: str = "item_cnt_day") -> DataFrame:
    """day (number from 0), y: total quantity of every day of the period."""
    spine = sales.sparkSession.range((end - start).days + 1).withColumnRenamed("id", "day")
    inside = sales.filter(F.col("date").between(F.lit(start), F.lit(end)))
    daily = inside.groupBy(F.datediff("date", F.lit(start)).cast("long").alias("day")).agg(F.sum(qty).alias("y"))
    return spine.join(daily, "day", "left").withColumn("y", F.coalesce("y", F.lit(0.0)))


def autocorrelation(series: DataFrame, lags: int = 30) -> DataFrame:
    """lag, acf of rows (day, y): lagged products of the centred series over its squares.

    Each row goes to the days that it is a lag of, so the work is rows times lags.
    """
    mean = series.agg(F.avg("y").alias("m"))
    centred = series.join(F.broadcast(mean)).select("day", (F.col("y") - F.col("m")).alias("y"))
    ahead = centred.select("day", F.col("y").alias("past"), F.explode(F.sequence(F.lit(0), F.lit(lags))).alias("lag")).select((F.col("day") + F.col("lag")).alias("day"), "lag", "past")
    products = ahead.join(centred, "day").groupBy("lag").agg(F.sum(F.col("past") * F.col("y")).alias("c"))
    whole = centred.agg(F.sum(F.col("y") * F.col("y")).alias("c0"))
    return products.join(F.broadcast(whole)).select("lag", F.try_divide("c", "c0").alias("acf"))


def partial_autocorrelation(acf: Sequence[float]) -> list[float]:
    """Partial autocorrelations of ACF values from lag 0 on, by the Durbin-Levinson recursion."""
    out, phi = [1.0], np.zeros(0)
    for k in range(1, len(acf)):
        past = np.array(acf[1:k])
        value = (acf[k] - phi @ past[::-1]) / (1 - phi @ past) if k > 1 else acf[1]
        phi = np.append(phi - value * phi[::-1], value)
        out.append(float(value))
    return out


def acf_pacf(series: DataFrame, lags: int = 30) -> DataFrame:
    rows = sorted(autocorrelation(series, lags).collect(), key=lambda r: r["lag"])  # lags + 1 rows
    acf = [r["acf"] for r in rows]
    spark = series.sparkSession
    return spark.createDataFrame([(r["lag"], a, p) for r, a, p in zip(rows, acf, partial_autocorrelation(acf), strict=True)], "lag int, acf double, pacf double")


def cross_correlation(series: DataFrame, indicators: DataFrame, columns: Sequence[str], lags: int = 50) -> DataFrame:
    """column, lag, ccf: the indicator ``lag`` days later against y, without centring, over the root of both sums of squares."""
    x = indicators.select("day", F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("x")) for c in columns))).alias("p")).select("day", "p.*").filter("x is not null")
    sent = x.select("field", "x", F.col("day").alias("_x_day"), F.explode(F.sequence(F.lit(-lags), F.lit(lags))).alias("lag")).withColumn("day", F.col("_x_day") - F.col("lag"))
    sums = sent.join(series, "day").groupBy("field", "lag").agg(F.sum(F.col("x") * F.col("y")).alias("xy"))
    norm_x = x.groupBy("field").agg(F.sum(F.col("x") * F.col("x")).alias("xx"))
    norm_y = series.agg(F.sum(F.col("y") * F.col("y")).alias("yy"))
    return sums.join(F.broadcast(norm_x), "field").join(F.broadcast(norm_y)).select("field", "lag", F.try_divide("xy", F.sqrt(F.col("xx") * F.col("yy"))).alias("ccf"))


def best_lag(ccf: DataFrame) -> DataFrame:
    """column, best lag among those up to 0 (the indicator earlier or on the day), its value; ties to the smaller lag."""
    return ccf.filter("lag <= 0").groupBy("field").agg(F.max_by("lag", F.struct("ccf", -F.col("lag"))).alias("best_lag"), F.max("ccf").alias("ccf"))


def series_correlation(series: DataFrame, indicators: DataFrame, column: str, lag: int) -> DataFrame:
    """Pearson correlation of y with an indicator, and with the indicator ``lag`` days before."""
    now = indicators.select("day", F.col(column).cast("double").alias("x"))
    past = indicators.select((F.col("day") + lag).alias("day"), F.col(column).cast("double").alias("x_past"))
    return series.join(now, "day", "left").join(past, "day", "left").agg(F.corr("y", "x").alias("corr"), F.corr("y", "x_past").alias("corr_lagged"))
