"""Shop, item and date features."""

from __future__ import annotations

from datetime import date
from math import pi

from pyspark.sql import functions as F

from demandloom.functions import text
from demandloom.operators import dates as T
from demandloom.operators import dims as D
from demandloom.params import SALES
from demandloom.queries.base import query
from demandloom.sources import adapters as A

DROP, NAMES, ONLINE = (9, 20), {1: "FRANCE fixed shop", 2: "CHINA fixed shop"}, (55,)
_FIX = "SELECT shop_id, n AS shop_name, CASE WHEN shop_id IN (55) THEN 'online' ELSE split_part(n, ' ', 1) END AS city FROM (SELECT shop_id, CASE shop_id WHEN 1 THEN 'FRANCE fixed shop' WHEN 2 THEN 'CHINA fixed shop' ELSE shop_name END AS n FROM shops WHERE shop_id NOT IN (9, 20))"
_DMS = "SELECT city, population, r[1][1] + r[1][2] / 60 + r[1][3] / 3600 AS lat, r[2][1] + r[2][2] / 60 + r[2][3] / 3600 AS lon, CAST(right(time_zone, 1) AS INT) AS utc_offset FROM (SELECT *, list_transform(regexp_extract_all(geo_coords, '[0-9]+°[0-9]+′([0-9]+″)?'), lambda t: [CAST(regexp_extract(t, '([0-9]+)°', 1) AS DOUBLE), CAST(regexp_extract(t, '([0-9]+)′', 1) AS DOUBLE), coalesce(try_cast(regexp_extract(t, '([0-9]+)″', 1) AS DOUBLE), 0.0)]) AS r FROM cities)"


def fixed(spark, sf):
    return D.shop_filter_fix(A.shops(spark, sf), DROP, NAMES, ONLINE, "online")


@query("shop_filter_fix", _FIX, "shops")
def q_fix(spark, sf):
    return fixed(spark, sf)


@query("shop_city", "SELECT shop_id, split_part(shop_name, ' ', 1) AS city FROM shops", "shops")
def q_city(spark, sf):
    return A.shops(spark, sf).select("shop_id", text.first_token("shop_name").alias("city"))


@query("dms_to_decimal", f"SELECT city, round(lat, 9) AS lat, round(lon, 9) AS lon FROM ({_DMS})", "cities")
def q_dms(spark, sf):
    lat, lon = text.dms_to_decimal("geo_coords")
    return A.cities(spark, sf).select("city", F.round(lat, 9).alias("lat"), F.round(lon, 9).alias("lon"))


@query("utc_offset", "SELECT city, CAST(right(time_zone, 1) AS INT) AS utc_offset FROM cities", "cities")
def q_utc(spark, sf):
    return A.cities(spark, sf).select("city", text.utc_offset("time_zone").alias("utc_offset"))


@query("shop_city_join", f"SELECT shop_id, shop_name, f.city, population, round(lat, 9) AS lat, round(lon, 9) AS lon, utc_offset FROM ({_FIX}) f LEFT JOIN ({_DMS}) c ON f.city = c.city", "shops", "cities")
def q_city_join(spark, sf):
    return D.shop_city_join(fixed(spark, sf), A.cities(spark, sf)).withColumns({c: F.round(c, 9) for c in ("lat", "lon")})


_OTHER = "CAST(city = 'online' AS INT) AS online, CASE WHEN city <> 'online' THEN count(*) OVER (PARTITION BY city) - 1 END AS other_shops"


@query("other_shops_in_city", f"SELECT shop_id, {_OTHER} FROM ({_FIX})", "shops")
def q_other(spark, sf):
    return D.other_shops_in_city(fixed(spark, sf), "online").select("shop_id", "online", "other_shops")


@query("online_flag", f"SELECT shop_id, CAST(city = 'online' AS INT) AS online FROM ({_FIX})", "shops")
def q_online(spark, sf):
    return D.other_shops_in_city(fixed(spark, sf), "online").select("shop_id", "online")


_BUILT = f"""WITH j AS (SELECT shop_id, f.city, population, lat, lon, utc_offset, {_OTHER.replace('city', 'f.city')} FROM ({_FIX}) f LEFT JOIN ({_DMS}) c ON f.city = c.city),
r AS (SELECT population AS p, lat AS a, lon AS o, utc_offset AS u FROM j WHERE city = 'CHINA' ORDER BY shop_id LIMIT 1), b AS (SELECT j.* REPLACE (coalesce(population, p) AS population, round(coalesce(lat, a), 9) AS lat, round(coalesce(lon, o), 9) AS lon, coalesce(utc_offset, u) AS utc_offset) FROM j LEFT JOIN r ON true)"""


def shop_features(spark, sf):
    return D.build_shop_features(A.shops(spark, sf), A.cities(spark, sf), DROP, NAMES, ONLINE, "online", "CHINA").withColumns({c: F.round(c, 9) for c in ("s_lat", "s_lon")})


@query("fill_from_reference_row", _BUILT + " SELECT shop_id, population, lat, lon, utc_offset FROM b", "shops", "cities")
def q_fill(spark, sf):
    return shop_features(spark, sf).select("shop_id", *(F.col(f"s_{c}").alias(c) for c in ("population", "lat", "lon", "utc_offset")))


@query("build_shop_features", _BUILT + " SELECT shop_id, COLUMNS(lambda c: c <> 'shop_id') AS 's_\\0' FROM b", "shops", "cities")
def q_shops(spark, sf):
    return shop_features(spark, sf)


@query("shop_activity_counts", "SELECT shop_id, count(*) AS n_sales, count(DISTINCT s.item_id) AS n_items, count(DISTINCT item_category_id) AS n_categories FROM sales s LEFT JOIN items i ON s.item_id = i.item_id GROUP BY 1", "sales", "items")
def q_activity(spark, sf):
    return D.shop_activity_counts(A.sales(spark, sf), A.items(spark, sf))


def train_test(spark, sf):
    df = A.sales(spark, sf)
    return df.filter(F.col("date") <= F.lit(SALES.train_end)), df.filter(F.col("date") >= F.lit(SALES.test_start))


_FIRST = "SELECT coalesce(f.item_id, t.item_id) AS item_id, first_date, CAST(CASE WHEN first_date IS NULL THEN 10 WHEN date_trunc('month', first_date) = DATE '1995-01-01' THEN 0 ELSE month(first_date) - 1 END AS INT) AS month_of_first_sale FROM (SELECT item_id, min(date) AS first_date FROM sales WHERE date <= DATE '2001-08-31' GROUP BY 1) f FULL JOIN (SELECT DISTINCT item_id FROM sales WHERE date >= DATE '2001-09-01') t ON f.item_id = t.item_id"


@query("item_first_sale_month", _FIRST, "sales")
def q_first_month(spark, sf):
    train, test = train_test(spark, sf)
    return D.item_first_sale_month(train, test, SALES.train_start, 10)


_JOINED = f"SELECT x.*, i.item_name, i.item_category_id, c.item_category_name FROM ({_FIRST}) x LEFT JOIN items i ON x.item_id = i.item_id LEFT JOIN item_categories c ON i.item_category_id = c.item_category_id"


@query("item_category_join", _JOINED, "sales", "items", "item_categories")
def q_category_join(spark, sf):
    train, test = train_test(spark, sf)
    return D.item_category_join(D.item_first_sale_month(train, test, SALES.train_start, 10), A.items(spark, sf), A.item_categories(spark, sf))


GROUPS = (("Brand#1", "first brands"), ("PROMO", "promo"), ("Brand#2", "second brands"))
_GROUP = "CASE WHEN contains(item_category_name, 'Brand#1') THEN 'first brands' WHEN contains(item_category_name, 'PROMO') THEN 'promo' WHEN contains(item_category_name, 'Brand#2') THEN 'second brands' ELSE item_category_name END"


@query("broad_category", "SELECT item_category_id, split_part(item_category_name, ' ', 1) AS broad_category FROM item_categories", "item_categories")
def q_broad(spark, sf):
    return A.item_categories(spark, sf).select("item_category_id", text.first_token("item_category_name").alias("broad_category"))


@query("console_group", f"SELECT item_category_id, {_GROUP} AS \"group\" FROM item_categories", "item_categories")
def q_group(spark, sf):
    return A.item_categories(spark, sf).select("item_category_id", text.first_match("item_category_name", GROUPS).alias("group"))


@query("digital_flag", "SELECT item_category_id, CAST(contains(item_category_name, 'SMALL') OR contains(item_category_name, 'LARGE') AS INT) AS digital FROM item_categories", "item_categories")
def q_digital(spark, sf):
    return A.item_categories(spark, sf).select("item_category_id", text.contains_any("item_category_name", ("SMALL", "LARGE")).alias("digital"))


def item_features(spark, sf):
    train, test = train_test(spark, sf)
    return D.build_item_features(train, test, A.items(spark, sf), A.item_categories(spark, sf), SALES.train_start, 10, GROUPS, ("SMALL", "LARGE"))


@query(
    "build_item_features",
    f"SELECT item_id, item_category_id AS i_item_category_id, month_of_first_sale AS i_month_of_first_sale, split_part(item_category_name, ' ', 1) AS i_broad_category, {_GROUP} AS i_group, CAST(coalesce(contains(item_category_name, 'SMALL') OR contains(item_category_name, 'LARGE'), false) AS INT) AS i_digital FROM ({_JOINED})",
    "sales", "items", "item_categories",
)
def q_items(spark, sf):
    return item_features(spark, sf)


@query("item_price_cv", "SELECT item_id, round(stddev_pop(item_price) / nullif(avg(item_price), 0), 6) AS price_cv FROM sales GROUP BY 1", "sales")
def q_item_cv(spark, sf):
    return D.item_price_cv(A.sales(spark, sf)).withColumn("price_cv", F.round("price_cv", 6))


@query("item_qty_mad", "WITH m AS (SELECT item_id, avg(item_cnt_day) AS m FROM sales GROUP BY 1) SELECT s.item_id, round(avg(abs(item_cnt_day - m)), 7) AS qty_mad FROM sales s JOIN m ON s.item_id = m.item_id GROUP BY 1", "sales")
def q_item_mad(spark, sf):
    return D.item_qty_mad(A.sales(spark, sf)).withColumn("qty_mad", F.round("qty_mad", 7))


@query("item_unique_counts", "SELECT item_id, count(DISTINCT shop_id) AS n_shops, count(DISTINCT date) AS n_dates FROM sales GROUP BY 1", "sales")
def q_item_unique(spark, sf):
    return D.item_unique_counts(A.sales(spark, sf))


@query("item_gap_stats", "WITH g AS (SELECT item_id, date - lag(date) OVER (PARTITION BY item_id ORDER BY date) AS gap FROM (SELECT DISTINCT item_id, date FROM sales)) SELECT item_id, round(avg(gap), 8) AS gap_mean, round(stddev_pop(gap), 8) AS gap_std, quantile_cont(CAST(gap AS DOUBLE), 0.5) AS gap_median, CAST(min(gap) AS INT) AS gap_min, CAST(max(gap) AS INT) AS gap_max FROM g GROUP BY 1", "sales")
def q_item_gaps(spark, sf):
    return D.item_gap_stats(A.sales(spark, sf)).withColumns({c: F.round(c, 8) for c in ("gap_mean", "gap_std")})


@query("items_in_category", "SELECT item_id, item_category_id, count(*) OVER (PARTITION BY item_category_id) AS n_in_category FROM items", "items")
def q_in_category(spark, sf):
    return D.items_in_category(A.items(spark, sf))


_SPIKE = "SELECT s.item_id, count(*) FILTER (item_cnt_day > m + 2 * sd) AS n_spikes, CAST(max(CASE WHEN item_cnt_day > m + 2 * sd THEN 1 ELSE 0 END) AS INT) AS had_spike, CAST(max(CASE WHEN item_cnt_day > m + 2 * sd AND date - f <= 7 THEN 1 ELSE 0 END) AS INT) AS had_early_spike FROM sales s JOIN (SELECT item_id, avg(item_cnt_day) AS m, stddev_pop(item_cnt_day) AS sd, min(date) AS f FROM sales GROUP BY 1) a ON s.item_id = a.item_id GROUP BY 1"


@query("item_qty_spikes", _SPIKE, "sales")
def q_item_spikes(spark, sf):
    return D.item_qty_spikes(A.sales(spark, sf))


@query("spike_crosstab", f"SELECT had_early_spike, had_spike, count(*) AS n FROM ({_SPIKE}) GROUP BY 1, 2", "sales")
def q_crosstab(spark, sf):
    return D.item_qty_spikes(A.sales(spark, sf)).groupBy("had_early_spike", "had_spike").agg(F.count("*").alias("n"))


# dates

_TRAIN_SALES = "(SELECT * FROM sales WHERE date <= DATE '2001-08-31')"


def spine_sql(sales: str, calendar) -> str:
    return f"SELECT CAST(unnest(generate_series(min(date), greatest(max(date), DATE '{calendar.test_end}'), INTERVAL 1 DAY)) AS DATE) AS date FROM {sales}"


def calendar_sql(calendar) -> tuple[str, str, str, str]:
    """Parts, cycles, holidays and events of a table's date."""
    first = calendar.train_start
    mc = f"((year(date) - {first.year}) * 12 + month(date) - {first.month})"
    parts = f"CAST({mc} AS INT) AS month_counter, CAST(date - DATE '{first}' + 1 AS INT) AS day_counter, CAST(year(date) AS INT) AS year, CAST({mc} % 12 AS INT) AS month, CAST(day(last_day(date)) AS INT) AS days_in_month, CAST(isodow(date) - 1 AS INT) AS weekday, CAST(isodow(date) >= 6 AS INT) AS weekend, CAST(quarter(date) AS INT) AS quarter, CAST({mc} // 3 AS INT) + 1 AS quarter_counter, CAST(weekofyear(date) AS INT) AS week"
    cycle = ", ".join(f"round({f}({n} * {2 * pi / p!r}), 9) AS {n}_{f}" for n, p in (("month", 12), ("weekday", 7), ("quarter", 4), ("week", 52)) for f in ("sin", "cos"))
    days = "(VALUES " + ", ".join(f"(DATE '{h}')" for h in calendar.holidays) + ") h(h)"
    holiday = f"CAST(date IN (SELECT h FROM {days}) AS INT) AS holiday, CAST((SELECT min(h) FROM {days} WHERE h >= date) - date AS INT) AS days_to_holiday, CAST(date - (SELECT max(h) FROM {days} WHERE h <= date) AS INT) AS days_since_holiday"
    event = "CAST(" + " OR ".join(f"date BETWEEN DATE '{a}' AND DATE '{b}'" for a, b in calendar.events) + " AS INT) AS event"
    return parts, cycle, holiday, event


_SPINE = spine_sql(_TRAIN_SALES, SALES)
_PARTS, _CYCLE, _HOLIDAY, _EVENT = calendar_sql(SALES)
#: Rows of sales with their own date's features: what a model reads.
_FACTS = "SELECT DISTINCT date, shop_id FROM sales"


def spine(spark, sf):
    return T.date_spine(train_test(spark, sf)[0], SALES.test_end)


def facts(spark, sf):
    return A.sales(spark, sf).select("date", "shop_id").distinct()


@query("date_spine", _SPINE, "sales")
def q_spine(spark, sf):
    return spine(spark, sf)


@query("calendar_parts", f"SELECT date, shop_id, {_PARTS} FROM ({_FACTS})", "sales")
def q_parts(spark, sf):
    return T.calendar_parts(facts(spark, sf), SALES.train_start)


@query("calendar_parts_short_february", f"SELECT date, shop_id, {_PARTS} FROM ({_FACTS})".replace("CAST(day(last_day(date)) AS INT)", "CAST(CASE WHEN month(date) = 2 THEN 28 ELSE day(last_day(date)) END AS INT)"), "sales")
def q_short(spark, sf):
    return T.calendar_parts(facts(spark, sf), SALES.train_start, short_february=True)


def _nine(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


_TRIG = [f"{n}_{f}" for n in ("month", "weekday", "quarter", "week") for f in ("sin", "cos")]


@query("cyclic_encoding", f"SELECT date, shop_id, {_CYCLE} FROM (SELECT date, shop_id, {_PARTS} FROM ({_FACTS}))", "sales")
def q_cyclic(spark, sf):
    return _nine(T.cyclic_encoding(T.calendar_parts(facts(spark, sf), SALES.train_start)).select("date", "shop_id", *_TRIG), *_TRIG)


@query("holiday_features", f"SELECT date, shop_id, {_HOLIDAY} FROM ({_FACTS})", "sales")
def q_holiday(spark, sf):
    return T.holiday_features(facts(spark, sf), SALES.holidays)


@query("event_flag", f"SELECT date, shop_id, {_EVENT} FROM ({_FACTS})", "sales")
def q_event(spark, sf):
    return T.event_flag(facts(spark, sf), SALES.events)


_INSIDE = "SELECT date, brent, usdrub, orders_cnt FROM macro WHERE date BETWEEN DATE '1995-01-01' AND DATE '2001-08-31'"


@query("macro_join", f"SELECT s.date, brent, usdrub, orders_cnt FROM ({_SPINE}) s LEFT JOIN ({_INSIDE}) m ON s.date = m.date", "macro", "sales")
def q_macro(spark, sf):
    return T.macro_join(spine(spark, sf), A.macro(spark, sf), SALES.train_start, SALES.train_end)


_REL = "(SELECT release_date, count(*) AS n FROM releases WHERE release_date <= DATE '2001-11-30' GROUP BY 1)"
_RELEASES = f"coalesce((SELECT n FROM {_REL} WHERE release_date = date), 0) AS n_releases, CAST(EXISTS (SELECT 1 FROM {_REL} WHERE release_date = date) AS INT) AS any_release, CAST(EXISTS (SELECT 1 FROM {_REL} WHERE date BETWEEN release_date AND release_date + 2) AS INT) AS release_window"


@query("release_counts", f"SELECT date, n_releases, any_release FROM (SELECT date, {_RELEASES} FROM ({_SPINE}))", "releases", "sales")
def q_releases(spark, sf):
    return T.release_features(spine(spark, sf), A.releases(spark, sf), SALES.test_end).drop("release_window")


@query("release_window_flag", f"SELECT date, release_window FROM (SELECT date, {_RELEASES} FROM ({_SPINE}))", "releases", "sales")
def q_window(spark, sf):
    return T.release_features(spine(spark, sf), A.releases(spark, sf), SALES.test_end).select("date", "release_window")


_TOTAL = f"SELECT s.date, coalesce(q, 0.0) AS total_qty FROM ({_SPINE}) s LEFT JOIN (SELECT date, sum(item_cnt_day) AS q FROM sales WHERE date <= DATE '2001-08-31' GROUP BY 1) t ON s.date = t.date"


@query("daily_total_qty", _TOTAL, "sales")
def q_total(spark, sf):
    return T.daily_total_qty(spine(spark, sf), train_test(spark, sf)[0])


_LAGS = ", ".join(f"coalesce(lag(total_qty, {k}) OVER (ORDER BY date), 0.0) AS total_qty_lag{k}" for k in (1, 6, 7))


@query("daily_lags", f"SELECT date, total_qty, {_LAGS} FROM ({_TOTAL})", "sales")
def q_lags(spark, sf):
    return T.daily_lags(T.daily_total_qty(spine(spark, sf), train_test(spark, sf)[0]))


def date_features(spark, sf):
    df = T.build_date_features(SALES, train_test(spark, sf)[0], A.macro(spark, sf), A.releases(spark, sf))
    return _nine(df, *(f"d_{c}" for c in _TRIG))


_BUILD = f"WITH a AS (SELECT date, {_PARTS}, {_HOLIDAY}, {_EVENT}, {_RELEASES} FROM ({_SPINE})), b AS (SELECT a.*, {_CYCLE}, brent, usdrub, orders_cnt, total_qty FROM a LEFT JOIN ({_INSIDE}) m ON a.date = m.date JOIN ({_TOTAL}) t ON a.date = t.date), c AS (SELECT *, {_LAGS}, coalesce(lag(brent) OVER (ORDER BY date), 0.0) AS brent_lag1 FROM b)"


@query("build_date_features", _BUILD + " SELECT date, COLUMNS(lambda c: c <> 'date') AS 'd_\\0' FROM c", "macro", "releases", "sales")
def q_dates(spark, sf):
    return date_features(spark, sf)


_SERIES = "WITH y AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-31', INTERVAL 1 DAY)) AS DATE) AS date), s AS (SELECT y.date - DATE '1995-01-01' AS day, coalesce(q, 0.0) AS y FROM y LEFT JOIN (SELECT date, sum(item_cnt_day) AS q FROM sales GROUP BY 1) t ON y.date = t.date)"


def series(spark, sf):
    return T.daily_series(A.sales(spark, sf), date(1995, 1, 1), date(2001, 8, 31))


@query("autocorrelation", _SERIES + ", c AS (SELECT day, y - (SELECT avg(y) FROM s) AS y FROM s), k AS (SELECT CAST(unnest(range(0, 31)) AS INT) AS lag) SELECT lag, round(sum(a.y * b.y) / (SELECT sum(y * y) FROM c), 8) AS acf FROM k JOIN c a ON true JOIN c b ON b.day = a.day + lag GROUP BY lag", "sales")
def q_acf(spark, sf):
    return T.acf_pacf(series(spark, sf)).select("lag", F.round("acf", 8).alias("acf"))


#: Coefficients of order k + 1 from those of order k (the recursion of Durbin and Levinson); r[1] is the autocorrelation at lag 0.
_PACF = (
    _SERIES.replace("WITH y AS", "WITH RECURSIVE y AS")
    + """, c AS (SELECT day, y - (SELECT avg(y) FROM s) AS y FROM s), k AS (SELECT CAST(unnest(range(0, 31)) AS INT) AS lag),
a AS (SELECT list(acf ORDER BY lag) AS r FROM (SELECT lag, sum(a.y * b.y) / (SELECT sum(y * y) FROM c) AS acf FROM k JOIN c a ON true JOIN c b ON b.day = a.day + lag GROUP BY lag)),
p(k, phi, v) AS (SELECT 1, [r[2]], r[2] FROM a UNION ALL
  SELECT k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - nv * phi[k + 1 - j]), nv), nv FROM
    (SELECT k, phi, (r[k + 2] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j]))) / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j + 1]))) AS nv FROM p, a WHERE k < 30))
SELECT CAST(0 AS INT) AS lag, CAST(1.0 AS DOUBLE) AS pacf UNION ALL SELECT CAST(k AS INT), round(v, 8) FROM p"""
)


@query("partial_autocorrelation", _PACF, "sales")
def q_pacf(spark, sf):
    return T.acf_pacf(series(spark, sf)).select("lag", F.round("pacf", 8).alias("pacf"))


def indicators(spark, sf):
    return A.macro(spark, sf).select(F.datediff("date", F.lit(date(1995, 1, 1))).cast("long").alias("day"), "brent", "usdrub", "orders_cnt")


_CCF = _SERIES + ", m AS (SELECT date - DATE '1995-01-01' AS day, brent, usdrub FROM macro), x AS (SELECT day, 'brent' AS field, brent AS x FROM m UNION ALL SELECT day, 'usdrub', usdrub FROM m), k AS (SELECT CAST(unnest(range(-50, 51)) AS INT) AS lag), ccf AS (SELECT x.field, lag, sum(x * y) / sqrt((SELECT sum(z.x * z.x) FROM x z WHERE z.field = x.field) * (SELECT sum(y * y) FROM s)) AS ccf FROM x JOIN k ON true JOIN s ON s.day = x.day - lag GROUP BY x.field, lag)"


@query("cross_correlation", _CCF + " SELECT field, lag, round(ccf, 8) AS ccf FROM ccf", "sales", "macro")
def q_ccf(spark, sf):
    return T.cross_correlation(series(spark, sf), indicators(spark, sf), ["brent", "usdrub"]).withColumn("ccf", F.round("ccf", 8))


@query("cross_correlation_best_lag", _CCF + " SELECT field, arg_max(lag, ccf) AS best_lag, round(max(ccf), 8) AS ccf FROM ccf WHERE lag <= 0 GROUP BY 1", "sales", "macro")
def q_best_lag(spark, sf):
    return T.best_lag(T.cross_correlation(series(spark, sf), indicators(spark, sf), ["brent", "usdrub"])).withColumn("ccf", F.round("ccf", 8))


@query("series_correlation", _SERIES + ", m AS (SELECT date - DATE '1995-01-01' AS day, brent FROM macro) SELECT round(corr(y, a.brent), 8) AS corr, round(corr(y, b.brent), 8) AS corr_lagged FROM s LEFT JOIN m a ON a.day = s.day LEFT JOIN m b ON b.day = s.day - 3", "sales", "macro")
def q_corr(spark, sf):
    out = T.series_correlation(series(spark, sf), indicators(spark, sf), "brent", 3)
    return out.select(F.round("corr", 8).alias("corr"), F.round("corr_lagged", 8).alias("corr_lagged"))
