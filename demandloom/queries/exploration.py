"""Analyses over the sales table, and the wide-table assembly."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import functions as F

from demandloom.jobs import analysis as J
from demandloom.jobs import assembly as W
from demandloom.jobs.grain_store import KEYS, SIDES, GrainStore, names_of
from demandloom.operators import dates as T
from demandloom.operators import dims as D
from demandloom.operators import panel as P
from demandloom.operators.clean import add_col_prefix
from demandloom.params import PANEL, SALES
from demandloom.queries import dims as QD
from demandloom.queries import panel as QP
from demandloom.queries.base import query, with_ctes
from demandloom.sources import adapters as A
from demandloom.sources import io

S, PS = A.sales, A.panel_sales
TT = QD.train_test
_TRAIN, _TEST = "sales WHERE date <= DATE '2001-08-31'", "sales WHERE date >= DATE '2001-09-01'"
#: The same periods of items that are launched over the years.
_OLD, _NEW_TEST = _TRAIN.replace("sales", "launched_sales"), _TEST.replace("sales", "launched_sales")
CUT = date(2001, 8, 1)


def launched(s, d):
    df = A.launched_sales(s, d)
    return df.filter(F.col("date") <= F.lit(SALES.train_end)), df.filter(F.col("date") >= F.lit(SALES.test_start))




query("distinct_values_union", "SELECT DISTINCT 'product_type' AS field, product_type AS value FROM housing UNION ALL SELECT DISTINCT 'sub_area', sub_area FROM housing UNION ALL SELECT DISTINCT 'floor', CAST(floor AS VARCHAR) FROM housing", "housing")(
    lambda s, d: J.distinct_values_union(A.housing(s, d), ["product_type", "sub_area", "floor"])
)
query("orphan_shops", "SELECT DISTINCT shop_id FROM sales WHERE date BETWEEN DATE '2000-01-01' AND DATE '2000-01-31' AND shop_id NOT IN (SELECT shop_id FROM known_shops)", "sales", "known_shops")(
    lambda s, d: J.orphan_shops(S(s, d), A.known_shops(s, d), date(2000, 1, 1), date(2000, 1, 31))
)
query("active_item_days", "SELECT item_id, count(DISTINCT date) AS n_days FROM sales WHERE item_id IN (SELECT item_id FROM sales WHERE item_cnt_day > 1) GROUP BY 1", "sales")(lambda s, d: J.active_item_days(S(s, d)))
_NEW = f"SELECT DISTINCT shop_id, item_id FROM {_TEST} AND item_id IN (SELECT item_id FROM {_TRAIN}) AND (shop_id, item_id) NOT IN (SELECT (shop_id, item_id) FROM {_TRAIN})"
query("new_pairs_not_in_train", _NEW, "sales")(lambda s, d: J.new_pairs_not_in_train(TT(s, d)[1], TT(s, d)[0]))
query("items_not_in_train", f"SELECT DISTINCT item_id FROM {_NEW_TEST} AND item_id NOT IN (SELECT item_id FROM {_OLD})", "launched_sales")(lambda s, d: J.items_not_in_train(launched(s, d)[1], launched(s, d)[0]))
query("first_rows_after", "SELECT * FROM sales s WHERE (shop_id, item_id, date) IN (SELECT (shop_id, item_id, min(date)) FROM sales GROUP BY shop_id, item_id HAVING min(date) >= DATE '2001-01-01')", "sales")(lambda s, d: J.first_rows_after(S(s, d), date(2001, 1, 1)))
_P, _I, _S = ("(SELECT {0}, min(date) AS f FROM {1} GROUP BY {0})".format(k, "{t}") for k in ("shop_id, item_id", "item_id", "shop_id"))
query("lag_to_first_shop_sale", f"SELECT CAST(sum(p.f - i.f) AS BIGINT) AS n_days FROM {_P} p JOIN {_I} i ON p.item_id = i.item_id".replace("{t}", "sales"), "sales")(lambda s, d: J.lag_to_first_shop_sale(S(s, d)))
query("days_to_add_train", f"SELECT CAST(sum(p.f - greatest(i.f, s.f)) AS BIGINT) AS n_days FROM {_P} p JOIN {_I} i ON p.item_id = i.item_id JOIN {_S} s ON p.shop_id = s.shop_id".replace("{t}", "sales"), "sales")(lambda s, d: J.days_to_add_train(S(s, d)))
query("days_to_add_test", f"SELECT CAST(sum(DATE '2001-09-01' - greatest(i.f, s.f)) AS BIGINT) AS n_days FROM ({_NEW}) p JOIN {_I} i ON p.item_id = i.item_id JOIN {_S} s ON p.shop_id = s.shop_id".replace("{t}", f"(SELECT * FROM {_TRAIN})"), "sales")(
    lambda s, d: J.days_to_add_test(TT(s, d)[1], TT(s, d)[0], date(2001, 9, 1))
)
query("unmatched_after_join", "SELECT count(*) FILTER (sh.shop_id IS NULL) AS no_shop, count(*) FILTER (i.item_id IS NULL) AS no_item, count(*) FILTER (sh.shop_id IS NULL OR i.item_id IS NULL) AS either FROM sales s LEFT JOIN known_shops sh ON s.shop_id = sh.shop_id LEFT JOIN known_items i ON s.item_id = i.item_id", "sales", "known_shops", "known_items")(
    lambda s, d: J.unmatched_after_join(S(s, d), A.known_shops(s, d), A.known_items(s, d))
)
query("item_history_slice", "SELECT item_id, shop_id, date, item_cnt_day FROM sales WHERE item_id IN (1, 5, 77)", "sales")(lambda s, d: J.item_history_slice(S(s, d), [1, 5, 77]))
query("ffill_by_group_counter", "SELECT shop_id, date, first_value(CASE WHEN qty > 3 THEN qty END IGNORE NULLS) OVER (PARTITION BY shop_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS qty FROM (SELECT shop_id, date, sum(item_cnt_day) AS qty FROM train GROUP BY 1, 2)", "train")(
    lambda s, d: J.fill_from_later(QP.shop_daily(s, d).withColumn("qty", F.when(F.col("qty") > 3, F.col("qty"))), ["shop_id"], "qty")
)
query("monthly_totals", "SELECT date_block_num, count(*) AS n_rows, sum(item_cnt_day) AS qty FROM sales GROUP BY 1", "sales")(lambda s, d: S(s, d).groupBy("date_block_num").agg(F.count("*").alias("n_rows"), F.sum("item_cnt_day").alias("qty")))
query("monthly_shop_item", "SELECT date_block_num, shop_id, item_id, min(date) AS first_date, max(date) AS last_date, round(avg(item_price), 9) AS avg_price, sum(item_cnt_day) AS qty FROM sales GROUP BY 1, 2, 3", "sales")(
    lambda s, d: S(s, d).groupBy("date_block_num", "shop_id", "item_id").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.round(F.avg("item_price"), 9).alias("avg_price"), F.sum("item_cnt_day").alias("qty"))
)
query("shop_counts", "SELECT shop_id, count(*) AS n_rows, count(DISTINCT item_id) AS n_items FROM sales GROUP BY 1", "sales")(lambda s, d: S(s, d).groupBy("shop_id").agg(F.count("*").alias("n_rows"), F.count_distinct("item_id").alias("n_items")))
for _n, _k in (("price_changed", ["item_id"]), ("price_changed_by_day", ["date", "item_id"]), ("price_changed_by_day_shop", ["date", "item_id", "shop_id"])):
    query(_n, f"SELECT changed, count(*) AS n FROM (SELECT min(item_price) <> max(item_price) AS changed FROM panel_sales GROUP BY {', '.join(_k)}) GROUP BY 1", "panel_sales")(lambda s, d, k=_k: J.price_changed(PS(s, d), k))
query("top_price_cv", "SELECT shop_id, item_id, round(cv, 8) AS price_cv FROM (SELECT shop_id, item_id, stddev_pop(item_price) / nullif(avg(item_price), 0) AS cv FROM sales GROUP BY 1, 2) WHERE cv IS NOT NULL ORDER BY round(cv, 9) DESC, shop_id, item_id LIMIT 10", "sales")(
    lambda s, d: J.top_price_cv(S(s, d), 10).withColumn("price_cv", F.round("price_cv", 8))
)
query("zero_share", "SELECT round(avg(CASE WHEN cv = 0 THEN 1 ELSE 0 END), 8) AS zero_share FROM (SELECT stddev_pop(item_price) / avg(item_price) AS cv FROM panel_sales GROUP BY shop_id, item_id, date)", "panel_sales")(
    lambda s, d: J.zero_share(PS(s, d).groupBy("shop_id", "item_id", "date").agg(J.cv(F.col("item_price")).alias("v")), "v").withColumn("zero_share", F.round("zero_share", 8))
)
query("daily_item_avg_price", "SELECT date, item_id, round(avg(item_price), 6) AS avg_price FROM panel_sales GROUP BY 1, 2", "panel_sales")(lambda s, d: PS(s, d).groupBy("date", "item_id").agg(F.round(F.avg("item_price"), 6).alias("avg_price")))
query("daily_item_qty", "SELECT date, item_id, sum(item_cnt_day) AS qty FROM sales GROUP BY 1, 2", "sales")(lambda s, d: S(s, d).groupBy("date", "item_id").agg(F.sum("item_cnt_day").alias("qty")))
for _n, _k in (("sale_day_share", "item_id"), ("sale_day_share_by_shop", "shop_id")):
    query(_n, f"SELECT {_k}, count(DISTINCT date) AS n_days, round(count(DISTINCT date) / (SELECT max(date) - min(date) + 1 FROM sales), 9) AS share FROM sales GROUP BY 1", "sales")(lambda s, d, k=_k: J.sale_day_share(S(s, d), k).withColumn("share", F.round("share", 9)))
query("count_of_counts", "SELECT n_days, count(*) AS n_keys FROM (SELECT count(DISTINCT date) AS n_days FROM sales GROUP BY item_id) GROUP BY 1", "sales")(lambda s, d: J.count_of_counts(J.sale_day_share(S(s, d), "item_id"), "n_days"))
for _n, _k in (("avg_gap_between_sales", "item_id"), ("avg_gap_between_sales_by_shop", "shop_id")):
    query(_n, f"SELECT {_k}, round(coalesce(CAST(max(date) - min(date) AS DOUBLE) / nullif(count(DISTINCT date) - 1, 0), 0.0), 8) AS avg_gap FROM sales GROUP BY 1", "sales")(lambda s, d, k=_k: J.avg_gap_between_sales(S(s, d), k).withColumn("avg_gap", F.round("avg_gap", 8)))
for _n, _k in (("first_last_dates", "shop_id"), ("first_last_dates_by_item", "item_id")):
    query(_n, f"SELECT {_k}, min(date) AS first_date, max(date) AS last_date, CAST(max(date) - min(date) + 1 AS INT) AS duration FROM sales GROUP BY 1", "sales")(lambda s, d, k=_k: J.first_last_dates(S(s, d), k))
_CLOSED = "SELECT shop_id, max(date) AS last_date FROM closing_sales GROUP BY 1 HAVING max(date) < DATE '2001-08-01'"
query("closed_shops", _CLOSED, "closing_sales")(lambda s, d: J.closed_shops(A.closing_sales(s, d), CUT))
query("closure_trend", f"SELECT s.shop_id, CAST((year(last_date) - year(date)) * 12 + month(last_date) - month(date) AS INT) AS months_before, sum(item_cnt_day) AS qty FROM closing_sales s JOIN ({_CLOSED}) c ON s.shop_id = c.shop_id GROUP BY 1, 2", "closing_sales")(lambda s, d: J.closure_trend(A.closing_sales(s, d), CUT))
query("extreme_rows", "SELECT * FROM sales WHERE item_cnt_day = (SELECT max(item_cnt_day) FROM sales) OR item_cnt_day = (SELECT min(item_cnt_day) FROM sales) OR item_price <= 0", "sales")(lambda s, d: J.extreme_rows(S(s, d)))
_RETURNS = "SELECT n.*, (SELECT max(p.date) FROM panel_sales p WHERE p.item_cnt_day > 0 AND p.shop_id = n.shop_id AND p.item_id = n.item_id AND p.item_price = n.item_price AND p.item_cnt_day = -n.item_cnt_day AND p.date < n.date) AS sold_on FROM panel_sales n WHERE n.item_cnt_day < 0"
query("match_returns", _RETURNS, "panel_sales")(lambda s, d: J.match_returns(PS(s, d)))
query("unmatched_returns_by_month", f"SELECT date_block_num, count(*) AS n FROM ({_RETURNS}) WHERE sold_on IS NULL GROUP BY 1", "panel_sales")(lambda s, d: J.unmatched_returns_by_month(PS(s, d)))
for _n, _k, _m, _asc in (("negative_by_key", ["shop_id"], None, False), ("negative_by_key_top_items", ["item_id"], 10, False), ("negative_by_key_bottom_items", ["item_id"], 10, True), ("negative_by_key_top_pairs", ["shop_id", "item_id"], 15, False)):
    _c = ", ".join(_k)
    query(_n, f"SELECT {_c}, count(*) AS n_negative FROM sales WHERE item_cnt_day < 0 GROUP BY {_c}" + (f" ORDER BY n_negative{'' if _asc else ' DESC'}, {_c} LIMIT {_m}" if _m else ""), "sales")(lambda s, d, k=_k, m=_m, a=_asc: J.negative_by_key(S(s, d), k, m, a))
for _n, _f in (("first_seen_counts", "min"), ("last_seen_counts", "max")):
    query(_n, f"SELECT date, count(*) AS n_items FROM (SELECT {_f}(date) AS date FROM sales GROUP BY item_id) WHERE date <> (SELECT {_f}(date) FROM sales) GROUP BY 1", "sales")(lambda s, d, last=_f == "max": J.seen_counts(S(s, d), last))
_SEEN = "SELECT date, count(*) AS n_items FROM (SELECT min(date) AS date FROM sales GROUP BY item_id) WHERE date <> (SELECT min(date) FROM sales) GROUP BY 1"
query("resample_sum", f"SELECT CAST(date_trunc('month', date) AS DATE) AS period, CAST(sum(n_items) AS BIGINT) AS n_items FROM ({_SEEN}) GROUP BY 1", "sales")(lambda s, d: J.resample_sum(J.seen_counts(S(s, d)), "n_items", "month"))
query("resample_sum_by_week", f"SELECT CAST(CAST(date_trunc('week', date) AS DATE) + 6 AS DATE) AS period, CAST(sum(n_items) AS BIGINT) AS n_items FROM ({_SEEN}) GROUP BY 1", "sales")(lambda s, d: J.resample_sum(J.seen_counts(S(s, d)), "n_items", "week"))
query("dow_counts", "SELECT dayname(date) AS dow, count(*) AS n_rows, sum(item_cnt_day) AS qty FROM sales GROUP BY 1", "sales")(lambda s, d: J.dow_counts(S(s, d)))
query("shops_not_every_dow", "SELECT shop_id, count(DISTINCT isodow(date)) AS n_dow FROM train GROUP BY 1 HAVING count(DISTINCT isodow(date)) < 7", "train")(lambda s, d: J.shops_not_every_dow(QP.split(s, d)[0]))
_DOW = "SELECT shop_id, CAST(isodow(date) - 1 AS INT) AS dow, round(100 * sum(item_cnt_day) / nullif(sum(sum(item_cnt_day)) OVER (PARTITION BY shop_id), 0), 9) AS pct FROM sales GROUP BY shop_id, isodow(date)"
query("dow_share_by_shop", _DOW, "sales")(lambda s, d: J.dow_share_by_shop(S(s, d)).withColumn("pct", F.round("pct", 9)))
query("dow_share_top", f"SELECT * FROM ({_DOW}) WHERE dow = 1 AND pct IS NOT NULL ORDER BY pct DESC, shop_id LIMIT 1", "sales")(lambda s, d: J.dow_share_by_shop(S(s, d)).withColumn("pct", F.round("pct", 9)).filter("dow = 1 and pct is not null").orderBy(F.desc("pct"), "shop_id").limit(1))
query("dow_share_largest", f"SELECT * FROM ({_DOW}) WHERE pct IS NOT NULL ORDER BY pct DESC, shop_id, dow LIMIT 1", "sales")(lambda s, d: J.largest_dow_share(S(s, d)))
query("items_by_shop_count", "SELECT n_shops, count(*) AS n_keys FROM (SELECT count(DISTINCT shop_id) AS n_shops FROM sales GROUP BY item_id) GROUP BY 1", "sales")(lambda s, d: J.items_by_shop_count(S(s, d)))
_RUN = "SELECT item_id, date, running, CAST(date - min(date) OVER (PARTITION BY item_id) <= 7 AS INT) AS first_week, running / nullif(max(running) OVER (PARTITION BY item_id), 0) AS share FROM (SELECT item_id, date, sum(sum(item_cnt_day)) OVER (PARTITION BY item_id ORDER BY date) AS running FROM sales GROUP BY item_id, date)"
query("running_share", f"SELECT * REPLACE (round(share, 8) AS share) FROM ({_RUN})", "sales")(lambda s, d: J.running_share(S(s, d)).withColumn("share", F.round("share", 8)))
query("first_week_share", f"SELECT item_id, round(max(CASE WHEN first_week = 1 THEN running END) / nullif(max(running), 0), 8) AS first_week_share FROM ({_RUN}) GROUP BY 1", "sales")(lambda s, d: J.first_week_share(S(s, d)).withColumn("first_week_share", F.round("first_week_share", 8)))
_HALF = f"SELECT item_id, CAST(min(CASE WHEN share >= 0.5 THEN date END) - min(date) + 1 AS INT) AS n_days FROM ({_RUN}) GROUP BY 1 HAVING min(CASE WHEN share >= 0.5 THEN date END) IS NOT NULL"
query("days_to_half", _HALF, "sales")(lambda s, d: J.days_to_half(S(s, d)))
query("days_to_half_share", f"SELECT round(avg(CASE WHEN n_days <= 200 THEN 1 ELSE 0 END), 8) AS share FROM ({_HALF})", "sales")(lambda s, d: J.share_at_most(J.days_to_half(S(s, d)), "n_days", 200).withColumn("share", F.round("share", 8)))
query("item_qty_moments", "SELECT item_id, round(avg(item_cnt_day), 8) AS qty_mean, round(stddev_pop(item_cnt_day), 7) AS qty_std FROM sales GROUP BY 1", "sales")(lambda s, d: S(s, d).groupBy("item_id").agg(F.round(F.avg("item_cnt_day"), 8).alias("qty_mean"), F.round(F.stddev_pop("item_cnt_day"), 7).alias("qty_std")))
for _k in ("item_id", "shop_id"):
    _a, _b = f"SELECT {_k} FROM {_TRAIN}", f"SELECT {_k} FROM {_TEST}"
    query("id_set_counts" if _k == "item_id" else "id_set_counts_shops", f"SELECT count(*) FILTER (b IS NULL) AS only_a, count(*) FILTER (a IS NULL) AS only_b, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS \"both\" FROM (SELECT DISTINCT {_k}, 1 AS a FROM ({_a})) x FULL JOIN (SELECT DISTINCT {_k}, 1 AS b FROM ({_b})) y USING ({_k})", "sales")(
        lambda s, d, k=_k: J.id_sets(TT(s, d)[0], TT(s, d)[1], k)
    )
query("id_set_difference", f"SELECT item_id, 'only_a' AS side FROM (SELECT item_id FROM {_OLD} EXCEPT SELECT item_id FROM {_NEW_TEST}) UNION ALL SELECT item_id, 'only_b' FROM (SELECT item_id FROM {_NEW_TEST} EXCEPT SELECT item_id FROM {_OLD})", "launched_sales")(lambda s, d: J.id_set_difference(*launched(s, d), "item_id"))
_CLOSED = [x.replace("sales", "closing_sales") for x in (_TRAIN, _TEST)]
query("id_set_difference_shops", f"SELECT shop_id, 'only_a' AS side FROM (SELECT shop_id FROM {_CLOSED[0]} EXCEPT SELECT shop_id FROM {_CLOSED[1]}) UNION ALL SELECT shop_id, 'only_b' FROM (SELECT shop_id FROM {_CLOSED[1]} EXCEPT SELECT shop_id FROM {_CLOSED[0]})", "closing_sales")(
    lambda s, d: J.id_set_difference(A.closing_sales(s, d).filter(F.col("date") <= F.lit(SALES.train_end)), A.closing_sales(s, d).filter(F.col("date") >= F.lit(SALES.test_start)), "shop_id")
)
query("id_set_intersection", f"SELECT item_id FROM {_TRAIN} INTERSECT SELECT item_id FROM {_TEST}", "sales")(lambda s, d: TT(s, d)[0].select("item_id").intersect(TT(s, d)[1].select("item_id")))
query("subset_first_seen", f"SELECT CAST(date_trunc('month', f) AS DATE) AS month, count(*) AS n_items FROM (SELECT item_id, min(date) AS f FROM {_OLD} GROUP BY 1 HAVING count(DISTINCT date) = 1) WHERE item_id IN (SELECT item_id FROM {_NEW_TEST}) GROUP BY 1", "launched_sales")(
    lambda s, d: J.subset_first_seen(*launched(s, d))
)
query("categories_only_in_test", f"SELECT DISTINCT item_category_id FROM items WHERE item_id IN (SELECT item_id FROM {_NEW_TEST} AND item_id NOT IN (SELECT item_id FROM {_OLD})) AND item_category_id NOT IN (SELECT item_category_id FROM items WHERE item_id IN (SELECT item_id FROM {_OLD}))", "launched_sales", "items")(
    lambda s, d: J.categories_only_in_test(launched(s, d)[1], launched(s, d)[0], A.items(s, d))
)
query("name_prefix_filter", "SELECT * FROM item_categories WHERE item_category_name LIKE 'PROMO%'", "item_categories")(lambda s, d: A.item_categories(s, d).filter(F.startswith(F.col("item_category_name"), F.lit("PROMO"))))
_NAMED = "(SELECT s.*, item_name, i.item_category_id, item_category_name FROM sales s LEFT JOIN items i ON s.item_id = i.item_id LEFT JOIN item_categories c ON i.item_category_id = c.item_category_id)"


def named(s, d):
    return J.sales_with_category(S(s, d), A.items(s, d), A.item_categories(s, d))


_C3 = ("sales", "items", "item_categories")
query("sales_with_category", f"SELECT item_category_name, count(*) AS n FROM {_NAMED} GROUP BY 1", *_C3)(lambda s, d: named(s, d).groupBy("item_category_name").agg(F.count("*").alias("n")))
query("revenue_by_category", f"SELECT item_category_name, round(sum(item_price * item_cnt_day), 2) AS revenue FROM {_NAMED} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", *_C3)(lambda s, d: J.revenue_by_category(named(s, d), 10).withColumn("revenue", F.round("revenue", 2)))
query("revenue_over_time", f"SELECT date, item_category_name, round(sum(item_price * item_cnt_day), 2) AS revenue FROM {_NAMED} GROUP BY 1, 2", *_C3)(lambda s, d: J.revenue_over_time(named(s, d)).withColumn("revenue", F.round("revenue", 2)))
query("revenue_over_time_in_group", f"SELECT date, item_category_name, round(sum(item_price * item_cnt_day), 2) AS revenue FROM {_NAMED} WHERE item_category_name LIKE 'SMALL%' GROUP BY 1, 2", *_C3)(lambda s, d: J.revenue_over_time(named(s, d), "SMALL").withColumn("revenue", F.round("revenue", 2)))
query("test_only_items_by_category", f"SELECT item_category_name, count(*) AS n FROM (SELECT DISTINCT item_id FROM {_NEW_TEST} AND item_id NOT IN (SELECT item_id FROM {_OLD})) t LEFT JOIN items i ON t.item_id = i.item_id LEFT JOIN item_categories c ON i.item_category_id = c.item_category_id GROUP BY 1", "launched_sales", "items", "item_categories")(
    lambda s, d: D.item_category_join(J.items_not_in_train(launched(s, d)[1], launched(s, d)[0]), A.items(s, d), A.item_categories(s, d)).groupBy("item_category_name").agg(F.count("*").alias("n"))
)
query("dedupe_join_columns", "SELECT s.shop_id, s.item_id, s.date, s.date_block_num, s.item_price, s.item_cnt_day, i.item_name, i.item_category_id, c.item_category_name FROM sales s JOIN items i ON s.item_id = i.item_id JOIN item_categories c ON i.item_category_id = c.item_category_id", *_C3)(
    lambda s, d: W.join_once(W.join_once(S(s, d), A.items(s, d).withColumn("date", F.current_date()), ["item_id"]), A.item_categories(s, d).withColumn("item_name", F.lit("another")), ["item_category_id"])
)

# wide tables over the panel grains


def panel_shops(train, categories):
    """What training tells of each shop; the panel's shops have no names, so no cities."""
    return add_col_prefix(D.shop_activity_counts(train, categories), "s_", ["shop_id"])


def panel_items(train, test, categories, calendar):
    """What training tells of each item, and its category; the panel's categories have no names."""
    df = D.item_first_sale_month(train, test, calendar.train_start, calendar.test_start.month - 1).drop("first_date").join(D.items_in_category(categories), "item_id")
    for f in (D.item_price_cv, D.item_qty_mad, D.item_unique_counts, D.item_gap_stats):
        df = df.join(f(train), "item_id", "left")
    return add_col_prefix(df.withColumns({c: F.round(c, 6) for c in ("price_cv", "qty_mad", "gap_mean", "gap_std")}), "i_", ["item_id"])


def panel_dates(train, calendar):
    """Calendar, cycles, holidays, events, totals and lags of the panel's days."""
    df = T.build_date_features(calendar, train)
    return df.withColumns({c: F.round(c, 9) for c in df.columns if c.endswith(("_sin", "_cos"))})


def parts(s, d, source=QP.ORDERS):
    """The feature tables of a source by grain."""
    train, test = QP.split(s, d, source)
    categories = source.categories(s, d)
    return W.Parts(
        pairs=QP.rounded(QP.shop_item_dates(s, d, source)),
        pair_totals=add_col_prefix(P.shop_item_totals(train), "si_", ["shop_id", "item_id"]),
        shops=panel_shops(train, categories),
        items=panel_items(train, test, categories, source.calendar),
        dates=panel_dates(train, source.calendar),
        item_dates=QP.rounded(QP.item_dates(s, d, source)),
        shop_dates=QP.rounded(QP.shop_dates(s, d, source)),
        category_dates=QP.shop_category_dates(s, d, source).withColumnRenamed("qty", "category_qty"),
        additional=QP.rounded(QP.additional_pair_dates(s, d, source)),
    )


_stores = {}


#: Grains that every wide table joins, and those of training's pairs and of additional ones; days of pairs come first.
SHARED = ("shops", "items", "dates", "item_dates", "shop_dates")
PAIRS, ADDITIONAL, CATEGORY = ("pairs", "pair_totals", *SHARED), ("additional", *SHARED), ("category_dates",)
EVERY = tuple(KEYS)


def months_of(calendar):
    """The months of a calendar as the store counts them."""
    a, z = calendar.train_start, calendar.test_end
    return [100 * (m // 12) + m % 12 + 1 for m in range(12 * a.year + a.month - 1, 12 * z.year + z.month)]


def store(s, d, source=QP.ORDERS, renew=False, grains=EVERY, sides=tuple(SIDES), added_sides=None, month=None):
    """The session's grain store of a source with the given grains, of dated ones with the month (year * 100 + month) or all.

    What is missing is built, or all of it anew on demand; what is there stays as it is. Additional pairs have the side tables
    ``added_sides``, by default the same ones.
    """
    key = (s.sparkContext.applicationId, d, source.calendar)
    old = _stores.pop(key, None)  # a store whose building fails isn't used again
    made = old if old and not renew else GrainStore(s, io.scratch_path(s, "grains"))
    wanted = months_of(source.calendar) if month is None else [month]
    missing: dict[frozenset[int], set[str]] = {}
    for g in grains:
        for t in names_of(g, sides if added_sides is None or g != "additional" else added_sides):
            if lack := made.lacking(t, wanted):
                missing.setdefault(lack, set()).add(t)
    if missing:
        path = io.scratch_path(s, "cleaned")
        cleaned = QP.clean(s, d, source)
        cleaned.write.parquet(path)
        stored = replace(source, cleaned=s.read.schema(cleaned.schema).parquet(path))
        for lack, tables in missing.items():
            whole, last = len(lack) == len(months_of(source.calendar)), max(lack)
            until = None if whole else date(last // 100 + last % 100 // 12, last % 100 % 12 + 1, 1) - timedelta(1)
            made.put(parts(s, d, replace(stored, until=until)), months=None if whole else sorted(lack), tables=tables)
        io.remove_path(s, path)
    if old and old is not made:
        old.delete()
    _stores[key] = made
    return made


_CATEGORY = "category_qty, category_qty_7d, category_sold"
_ZERO = "coalesce(category_qty, 0) AS category_qty, coalesce(category_qty_7d, 0) AS category_qty_7d, coalesce(category_sold, 0) AS category_sold"
_PANEL_SHOPS = "SELECT shop_id, count(*) AS s_n_sales, count(DISTINCT item_id) AS s_n_items, count(DISTINCT cat) AS s_n_categories FROM named_train GROUP BY 1"
_PAIR_TOTALS = "SELECT *, CAST(rank() OVER (PARTITION BY item_id ORDER BY si_qty DESC) AS INT) AS si_shop_rank FROM (SELECT shop_id, item_id, sum(item_cnt_day) AS si_qty, count(DISTINCT date) AS si_n_dates FROM train GROUP BY 1, 2)"
_PANEL_ITEMS = """WITH known AS (SELECT item_id, item_category_id AS i_item_category_id, count(*) OVER (PARTITION BY item_category_id) AS i_n_in_category FROM cats),
sums AS (SELECT item_id, min(date) AS f, round(stddev_pop(item_price) / nullif(avg(item_price), 0), 6) AS i_price_cv, avg(item_cnt_day) AS m, count(DISTINCT shop_id) AS i_n_shops, count(DISTINCT date) AS i_n_dates FROM train GROUP BY 1),
mad AS (SELECT item_id, round(avg(abs(item_cnt_day - m)), 6) AS i_qty_mad FROM train JOIN sums USING (item_id) GROUP BY 1),
item_gap AS (SELECT item_id, date - lag(date) OVER (PARTITION BY item_id ORDER BY date) AS gap FROM (SELECT DISTINCT item_id, date FROM train)),
item_gaps AS (SELECT item_id, round(avg(gap), 6) AS i_gap_mean, round(stddev_pop(gap), 6) AS i_gap_std, quantile_cont(CAST(gap AS DOUBLE), 0.5) AS i_gap_median, CAST(min(gap) AS INT) AS i_gap_min, CAST(max(gap) AS INT) AS i_gap_max FROM item_gap GROUP BY 1)
SELECT item_id, CAST(CASE WHEN f IS NULL THEN {month} WHEN date_trunc('month', f) = DATE '2024-01-01' THEN 0 ELSE month(f) - 1 END AS INT) AS i_month_of_first_sale, i_item_category_id, i_n_in_category, i_price_cv, i_qty_mad, i_n_shops, i_n_dates, i_gap_mean, i_gap_std, i_gap_median, i_gap_min, i_gap_max
FROM known LEFT JOIN sums USING (item_id) LEFT JOIN mad USING (item_id) LEFT JOIN item_gaps USING (item_id) WHERE item_id IN (SELECT item_id FROM train) OR item_id IN (SELECT item_id FROM test)"""


def panel_dates_sql(calendar) -> str:
    named, cycle, holiday, event = QD.calendar_sql(calendar)
    return f"""WITH a AS (SELECT date, {named}, {holiday}, {event} FROM ({QD.spine_sql('train', calendar)})),
b AS (SELECT a.*, {cycle}, coalesce(q, 0.0) AS total_qty FROM a LEFT JOIN (SELECT date, sum(item_cnt_day) AS q FROM train GROUP BY 1) t USING (date)), c AS (SELECT *, {QD._LAGS} FROM b)
SELECT date, COLUMNS(lambda c: c <> 'date') AS 'd_\\0' FROM c"""


def wide_sql(source, kind: str | None, columns: str = "*", where: str = "true", additional: bool = False) -> str:
    """The join of the grains' own statements; kind is that of the category's join (None: no such join)."""
    of = lambda body, *names: with_ctes(body, *names, season=source is QP.ORDERS)
    cat = QP.CATEGORY_SQL.format(cols="shop_id, item_category_id, date, qty AS category_qty, category_qty_7d, category_sold")
    category = f"{kind} JOIN (SELECT shop_id, item_category_id AS sid_item_category_id, date, {_CATEGORY} FROM ({of(cat, 'named_train')})) c USING (shop_id, sid_item_category_id, date)" if kind is not None else ""
    return f"""SELECT {columns} FROM ({of(QP.ADDITIONAL_SQL if additional else QP.PAIR_SQL, 'train', 'test', 'cats')}) p
JOIN ({of(_PANEL_SHOPS, 'named_train')}) s USING (shop_id) JOIN ({of(_PANEL_ITEMS.format(month=source.calendar.test_start.month - 1), 'train', 'test', 'cats')}) i USING (item_id) JOIN ({of(panel_dates_sql(source.calendar), 'train')}) d USING (date)
JOIN ({of(QP.ITEM_SQL, 'train', 'test', 'cats')}) id USING (item_id, date) JOIN ({of(QP.SHOP_SQL, 'named_train', 'test')}) sd USING (shop_id, date)
{"" if additional else f"JOIN ({of(_PAIR_TOTALS, 'train')}) si USING (shop_id, item_id)"}
{category} WHERE {where}"""


_FILLED = f"* REPLACE ({_ZERO})"


def months(source, first, last):
    """Register the wide tables of a source; ``first`` and ``last`` are the days of one month."""
    name = (lambda x: x) if source is QP.ORDERS else (lambda x: f"{x}_of_events")
    between = f"date BETWEEN DATE '{first}' AND DATE '{last}'"

    month = first.year * 100 + first.month

    def grains_of(s, d, grains, sides=tuple(SIDES), features=True):
        """Those of the month; additional pairs get the features that their age tells as they are read."""
        found = store(s, d, source, grains=(*grains, *CATEGORY), sides=sides, added_sides=(), month=month).parts(first, last, sides, ())
        return replace(found, additional=QP.with_features_of_age(s, found.additional, source)) if "additional" in grains and features else found

    def zero_filled(s, d):
        wide = W.feature_table(grains_of(s, d, ADDITIONAL, sides=(), features=False), True)
        return wide.select("shop_id", "item_id", "date", *W.CATEGORY)

    query(name("write_all_features"), wide_sql(source, None))(lambda s, d: W.merge_all_features(store(s, d, source, renew=True).parts()))
    query(name("merge_all_features"), wide_sql(source, None))(lambda s, d: W.merge_all_features(store(s, d, source, grains=PAIRS).parts()))
    query(name("monthly_feature_table"), wide_sql(source, "", "*", between))(lambda s, d: W.feature_table(grains_of(s, d, PAIRS)))
    query(name("monthly_feature_table_addl"), wide_sql(source, "LEFT", _FILLED, between, True))(lambda s, d: W.feature_table(grains_of(s, d, ADDITIONAL), True))
    query(name("zero_fill_category_cols"), wide_sql(source, "LEFT", f"shop_id, item_id, date, {_ZERO}", between, True))(zero_filled)
    query(name("union_train_addl"), f"{wide_sql(source, '', '* EXCLUDE (si_qty, si_n_dates, si_shop_rank)', between)} UNION ALL BY NAME {wide_sql(source, 'LEFT', _FILLED, between, True)}")(
        lambda s, d: W.feature_table_of_both(grains_of(s, d, ("pairs", *ADDITIONAL)))
    )


months(QP.ORDERS, date(1998, 3, 1), date(1998, 3, 31))
months(QP.EVENTS, PANEL.train_start, PANEL.train_end)
