"""Cleaning, typing and profiles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from demandloom.jobs import analysis as J
from demandloom.operators import clean as C
from demandloom.operators import profile as R
from demandloom.params import PANEL
from demandloom.queries.base import query
from demandloom.sources import adapters as A
from demandloom.sources import io

S, PS = A.sales, A.panel_sales


@query("parse_sale_date", "SELECT shop_id, item_id, date FROM panel_sales", "panel_sales")
def q_parse(spark, sf):
    text = PS(spark, sf).withColumn("date", F.date_format("date", "dd.MM.yyyy"))
    return text.select("shop_id", "item_id", C.parse_sale_date("date").alias("date"))


@query("parse_dates_coerce", "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS day FROM events")
def q_coerce(spark, sf):
    text = F.when(F.col("event_id") % 7 == 0, "not a date").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return io.parse_dates_coerce(A.table(spark, sf, "events").select("event_id", text.alias("day")), ["day"])


@query("drop_exact_duplicates", "SELECT * FROM d", "d")
def q_distinct(spark, sf):
    return PS(spark, sf).dropDuplicates()


@query("flag_key_duplicates", "SELECT *, count(*) OVER (PARTITION BY shop_id, item_id, date) > 1 AS is_duplicate FROM d", "d")
def q_flag(spark, sf):
    return C.flag_key_duplicates(PS(spark, sf).dropDuplicates())


@query("drop_mixed_sign_keys", "SELECT d.* FROM d JOIN g ON d.shop_id = g.shop_id AND d.item_id = g.item_id AND d.date = g.date WHERE NOT mixed", "g")
def q_mixed(spark, sf):
    return C.drop_mixed_sign_keys(PS(spark, sf).dropDuplicates())


@query("consolidate_duplicates", "SELECT shop_id, item_id, date, date_block_num, round(sum(item_price * item_cnt_day) / nullif(sum(item_cnt_day), 0), 8) AS item_price, sum(item_cnt_day) AS item_cnt_day FROM d GROUP BY 1, 2, 3, 4", "d")
def q_consolidate(spark, sf):
    return C.consolidate_duplicates(PS(spark, sf).dropDuplicates()).withColumn("item_price", F.round("item_price", 8))


@query("clean_sales", "SELECT shop_id, item_id, date, date_block_num, round(item_price, 8) AS item_price, item_cnt_day FROM clean", "clean")
def q_clean(spark, sf):
    return C.clean_sales(PS(spark, sf), PANEL.train_start).withColumn("item_price", F.round("item_price", 8))


@query(
    "downcast",
    "SELECT CAST(user_id AS SMALLINT) AS shop_id, CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS TINYINT) AS item_id, CAST(CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN -(event_id % 5 + 1) ELSE event_id % 5 + 1 END AS TINYINT) AS item_cnt_day FROM events",
)
def q_downcast(spark, sf):
    return C.downcast(PS(spark, sf).select("shop_id", "item_id", "item_cnt_day"))


_TYPES = {"shop_id": "BIGINT", "item_id": "INT", "date": "DATETIME", "date_block_num": "INT", "item_price": "FLOAT", "item_cnt_day": "FLOAT"}


@query("sql_type_map", " UNION ALL ".join(f"SELECT '{c}' AS field, '{t}' AS sql_type, count({c}) AS n_values FROM panel_sales" for c, t in _TYPES.items()), "panel_sales")
def q_types(spark, sf):
    df = PS(spark, sf)
    kinds = C.sql_type_map(df)
    counts = df.agg(F.array(*(F.struct(F.lit(c).alias("field"), F.lit(t).alias("sql_type"), F.count(c).alias("n_values")) for c, t in kinds.items())).alias("rows"))
    return counts.select(F.explode("rows").alias("r")).select("r.*")


@query("add_col_prefix", "SELECT shop_id, item_id, date, item_price AS x_item_price, item_cnt_day AS x_item_cnt_day FROM d", "d")
def q_prefix(spark, sf):
    return C.add_col_prefix(PS(spark, sf).dropDuplicates().drop("date_block_num"), "x_", ["shop_id", "item_id", "date"])


_NULLS = "SELECT 'life_sq' AS field, count(*) FILTER (life_sq IS NULL) AS n, count(*) AS t FROM housing UNION ALL SELECT 'kitch_sq', count(*) FILTER (kitch_sq IS NULL), count(*) FROM housing UNION ALL SELECT 'build_year', count(*) FILTER (build_year IS NULL), count(*) FROM housing UNION ALL SELECT 'full_sq', count(*) FILTER (full_sq IS NULL), count(*) FROM housing"
_COLS = ["life_sq", "kitch_sq", "build_year", "full_sq"]


@query("null_report", f"SELECT field, n AS n_missing FROM ({_NULLS}) WHERE n > 0", "housing")
def q_nulls(spark, sf):
    return R.null_report(A.housing(spark, sf), _COLS)


@query("missing_profile", f"SELECT field, n AS n_missing, round(100.0 * n / t, 8) AS pct FROM ({_NULLS})", "housing")
def q_missing(spark, sf):
    return R.missing_profile(A.housing(spark, sf), _COLS, io.scratch_path(spark, "housing")).withColumn("pct", F.round("pct", 8)).orderBy(F.desc("n_missing"), "field")


@query(
    "zero_profile",
    "SELECT 'num_room' AS field, count(*) FILTER (num_room = 0) AS n_zero, round(100.0 * count(*) FILTER (num_room = 0) / count(*), 8) AS pct FROM housing UNION ALL SELECT 'life_sq', count(*) FILTER (life_sq = 0), round(100.0 * count(*) FILTER (life_sq = 0) / count(*), 8) FROM housing",
    "housing",
)
def q_zeros(spark, sf):
    return R.zero_profile(A.housing(spark, sf), ["num_room", "life_sq"], io.scratch_path(spark, "housing")).withColumn("pct", F.round("pct", 8))


@query("frame_summary", "SELECT CAST(place AS INT) AS place, field, type, (SELECT count(*) FROM panel_sales) AS n_rows, CAST(6 AS INT) AS n_columns FROM (VALUES (0, 'shop_id', 'bigint'), (1, 'item_id', 'int'), (2, 'date', 'date'), (3, 'date_block_num', 'int'), (4, 'item_price', 'double'), (5, 'item_cnt_day', 'double')) t(place, field, type)", "panel_sales")
def q_summary(spark, sf):
    return R.frame_summary(PS(spark, sf))


@query("check_unique_key", "SELECT shop_id, item_id, date, count(*) AS n FROM d GROUP BY 1, 2, 3 HAVING count(*) > 1", "d")
def q_unique(spark, sf):
    return R.check_unique_key(PS(spark, sf).dropDuplicates(), ["shop_id", "item_id", "date"])


@query("rows_with_any_null", "SELECT count(*) AS n FROM housing WHERE life_sq IS NULL OR kitch_sq IS NULL OR build_year IS NULL", "housing")
def q_any_null(spark, sf):
    return A.housing(spark, sf).filter(C.any_null(["life_sq", "kitch_sq", "build_year"])).agg(F.count("*").alias("n"))


@query("date_gap_check", "SELECT count(DISTINCT date) AS n_dates, CAST(max(date) - min(date) + 1 AS INT) AS n_days, CAST(max(date) - min(date) + 1 - count(DISTINCT date) AS BIGINT) AS n_missing FROM sales", "sales")
def q_gaps(spark, sf):
    return R.date_gap_check(S(spark, sf))


@query("check_month_index", "SELECT count(*) AS n_wrong FROM miscounted_sales WHERE (year(date) - 1995) * 12 + month(date) - 1 <> date_block_num", "miscounted_sales")
def q_month_index(spark, sf):
    return A.miscounted_sales(spark, sf).filter((F.year("date") - 1995) * 12 + F.month("date") - 1 != F.col("date_block_num")).agg(F.count("*").alias("n_wrong"))


def _describe_sql(c: str, by: str = "") -> str:
    return f"SELECT {by}{', ' if by else ''}'{c}' AS field, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max"


def _round(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("describe_columns", f"{_describe_sql('price_doc')} FROM housing UNION ALL {_describe_sql('full_sq')} FROM housing", "housing")
def q_describe(spark, sf):
    return _round(R.describe_columns(A.housing(spark, sf), ["price_doc", "full_sq"]), "mean", "std", "q25", "q50", "q75")


@query("describe_by_group", f"{_describe_sql('item_cnt_day', 'shop_id')} FROM sales GROUP BY shop_id", "sales")
def q_describe_by(spark, sf):
    return _round(R.describe_columns(S(spark, sf), ["item_cnt_day"], ["shop_id"]), "mean", "std", "q25", "q50", "q75")


@query("value_counts", "SELECT build_year, count(*) AS n FROM housing WHERE build_year IS NOT NULL GROUP BY 1", "housing")
def q_values(spark, sf):
    return R.value_counts(A.housing(spark, sf), "build_year")


@query("value_freq_with_nulls", "SELECT build_year, count(*) AS n FROM housing GROUP BY 1", "housing")
def q_values_nulls(spark, sf):
    return R.value_counts(A.housing(spark, sf), "build_year", keep_nulls=True)


@query("unique_values", "SELECT DISTINCT product_type FROM housing", "housing")
def q_unique_values(spark, sf):
    return A.housing(spark, sf).select("product_type").distinct()


@query("conditional_unique", "SELECT sub_area, count(*) AS n_known FROM housing WHERE build_year IS NOT NULL AND sub_area IN (SELECT sub_area FROM housing WHERE build_year IS NULL) GROUP BY 1", "housing")
def q_conditional(spark, sf):
    df = A.housing(spark, sf)
    areas = df.filter("build_year is null").select("sub_area").distinct()
    return df.filter("build_year is not null").join(areas, "sub_area", "left_semi").groupBy("sub_area").agg(F.count("*").alias("n_known"))


@query("consistency_rate", "SELECT count(*) FILTER (floor > max_floor) AS n_wrong, round(avg(CASE WHEN floor > max_floor THEN 1 ELSE 0 END), 8) AS share FROM housing", "housing")
def q_consistency(spark, sf):
    wrong = F.coalesce(F.col("floor") > F.col("max_floor"), F.lit(False))
    return A.housing(spark, sf).agg(F.count_if(wrong).alias("n_wrong"), F.round(F.avg(wrong.cast("int")), 8).alias("share"))


@query("column_counts", "SELECT count(life_sq) AS n_life_sq, count(build_year) AS n_build_year, count(*) AS n_rows FROM housing", "housing")
def q_column_counts(spark, sf):
    return R.column_counts(A.housing(spark, sf), ["life_sq", "build_year"])


@query("duplicate_check", "SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n - 1) AS BIGINT) AS n_surplus FROM (SELECT count(*) AS n FROM panel_sales GROUP BY shop_id, item_id, date, date_block_num, item_price, item_cnt_day)", "panel_sales")
def q_duplicates(spark, sf):
    return J.duplicate_check(PS(spark, sf))


@query("read_table_cast", "SELECT event_id, CAST(user_id AS INT) AS user_id, event_type FROM events")
def q_cast(spark, sf):
    rows = A.table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("user_id"), "event_type")
    return io.read_table_cast(rows, {"user_id": "int", "event_type": "int", "absent": "int"}, io.scratch_path(spark, "cast"))[0]


# other data sets


@query("concat_columns_of_tables", "SELECT date, 'train' AS part FROM sales WHERE date < DATE '2001-09-01' UNION ALL SELECT date, 'test' FROM sales WHERE date >= DATE '2001-09-01'", "sales")
def q_concat(spark, sf):
    df, cut = S(spark, sf), F.lit(date(2001, 9, 1))
    a = df.filter(F.col("date") < cut).select("date", F.lit("train").alias("part"))
    return a.unionByName(df.filter(F.col("date") >= cut).select("date", F.lit("test").alias("part")))


@query("daily_mean_to_calendar", "SELECT m.date, brent, usdrub, round(mean_value, 6) AS mean_value FROM macro m LEFT JOIN (SELECT timestamp AS date, avg(price_doc) AS mean_value FROM housing GROUP BY 1) h ON m.date = h.date", "macro", "housing")
def q_daily_mean(spark, sf):
    out = J.daily_mean_to_calendar(A.housing(spark, sf), "price_doc", "timestamp", A.macro(spark, sf).select("date", "brent", "usdrub"))
    return _round(out, "mean_value")


_MED = ["price_doc", "full_sq", "life_sq", "kitch_sq", "floor", "max_floor", "build_year", "num_room"]


@query("monthly_median", "SELECT CAST(date_trunc('month', timestamp) AS DATE) AS month, " + ", ".join(f"round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS {c}" for c in _MED) + " FROM housing GROUP BY 1", "housing")
def q_monthly_median(spark, sf):
    return _round(J.monthly_median(A.housing(spark, sf), "timestamp", _MED), *_MED)


@query("yearly_counts", "SELECT build_year, count(*) AS n FROM housing GROUP BY 1", "housing")
def q_yearly(spark, sf):
    return A.housing(spark, sf).groupBy("build_year").agg(F.count("*").alias("n"))


def _histogram_sql(value: str, bins: int, table: str, where: str = "true") -> str:
    return f"WITH v AS (SELECT CAST({value} AS DOUBLE) AS v FROM {table} WHERE {where}), e AS (SELECT min(v) AS lo, max(v) AS hi FROM v), b AS (SELECT CAST(least(floor((v - lo) / ((hi - lo) / {bins})) + 1, {bins}) AS INT) AS bin, lo, hi FROM v, e WHERE v IS NOT NULL) SELECT bin, round(lo + (bin - 1) * (hi - lo) / {bins}, 6) AS low, round(lo + bin * (hi - lo) / {bins}, 6) AS high, count(*) AS n FROM b GROUP BY bin, lo, hi"


@query("histogram", _histogram_sql("price_doc", 50, "housing"), "housing")
def q_histogram(spark, sf):
    return _round(R.histogram(A.housing(spark, sf), F.col("price_doc"), 50), "low", "high")


@query("histogram_log", _histogram_sql("ln(1 + full_sq)", 20, "housing", "life_sq IS NOT NULL"), "housing")
def q_histogram_log(spark, sf):
    return _round(R.histogram(A.housing(spark, sf).filter("life_sq is not null"), F.log1p("full_sq"), 20), "low", "high")


def _box_sql(value: str, by: str, table: str) -> str:
    return f"WITH q AS (SELECT {by}, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3 FROM {table} GROUP BY {by}), j AS (SELECT t.{value} AS v, q.*, t.{value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM {table} t JOIN q USING ({by})) SELECT {by}, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, min(CASE WHEN inside THEN v END) AS whisker_low, max(CASE WHEN inside THEN v END) AS whisker_high, CAST(count(*) FILTER (NOT inside) AS BIGINT) AS n_outliers, count(*) AS n FROM j GROUP BY {by}, q1, median, q3"


@query("boxplot_stats", _box_sql("price_doc", "sub_area", "housing"), "housing")
def q_boxplot(spark, sf):
    return _round(R.boxplot_stats(A.housing(spark, sf), "price_doc", ["sub_area"]), "q1", "median", "q3")


@query("zero_area_rows", "SELECT id, life_sq, kitch_sq, floor FROM housing WHERE num_room = 0", "housing")
def q_zero_area(spark, sf):
    return A.housing(spark, sf).filter("num_room = 0").select("id", "life_sq", "kitch_sq", "floor")


_MELT = "SELECT id, SalePrice, 'brand' AS variable, brand AS value FROM houses UNION ALL SELECT id, SalePrice, 'kind', kind FROM houses UNION ALL SELECT id, SalePrice, 'size', size FROM houses"


@query("melt", _MELT, "houses")
def q_melt(spark, sf):
    return R.melt(A.houses(spark, sf), ["id", "SalePrice"], ["brand", "kind", "size"])


@query("melted_boxplot", f"WITH long AS ({_MELT}), keyed AS (SELECT concat(variable, '=', value) AS k, SalePrice FROM long) SELECT split_part(k, '=', 1) AS variable, split_part(k, '=', 2) AS value, * EXCLUDE (k) FROM ({_box_sql('SalePrice', 'k', 'keyed')})", "houses")
def q_melted_box(spark, sf):
    out = R.boxplot_stats(R.melt(A.houses(spark, sf), ["id", "SalePrice"], ["brand", "kind", "size"]), "SalePrice", ["variable", "value"])
    return _round(out, "q1", "median", "q3")


@query("ordinal_rating", "SELECT id, CAST(CASE quality WHEN 'Ex' THEN 5 WHEN 'Gd' THEN 4 WHEN 'TA' THEN 3 WHEN 'Fa' THEN 2 WHEN 'Po' THEN 1 ELSE 0 END AS INT) AS rating FROM houses", "houses")
def q_rating(spark, sf):
    return A.houses(spark, sf).select("id", R.ordinal_rating("quality").alias("rating"))


@query("rank_density", "SELECT Id, count(*) AS n, round(count(*) / (SELECT count(*) FROM image_labels), 9) AS share, CAST(row_number() OVER (ORDER BY count(*) DESC, Id) - 1 AS INT) AS rank, round(ln(row_number() OVER (ORDER BY count(*) DESC, Id)), 9) AS log_rank FROM image_labels GROUP BY Id", "image_labels")
def q_rank_density(spark, sf):
    return R.rank_density(A.image_labels(spark, sf), "Id").withColumns({"share": F.round("share", 9), "log_rank": F.round("log_rank", 9)})


@query("distinct_label_count", "SELECT count(DISTINCT Id) AS n_labels FROM image_labels", "image_labels")
def q_labels(spark, sf):
    return A.image_labels(spark, sf).agg(F.count_distinct("Id").alias("n_labels"))


_XY = "SELECT l_orderkey, l_linenumber, l_quantity AS x, l_extendedprice AS y, l_discount AS z FROM lineitem"


def _points(spark, sf):
    return A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"), F.col("l_discount").alias("z"))


@query("standard_scale", f"WITH p AS ({_XY}), m AS (SELECT avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, stddev_pop(y) AS sy FROM p) SELECT l_orderkey, l_linenumber, round((x - mx) / sx, 6) AS x, round((y - my) / sy, 6) AS y FROM p, m")
def q_scale(spark, sf):
    from demandloom.operators import numeric as N

    return _round(N.standard_scale(_points(spark, sf).drop("z"), ["x", "y"]), "x", "y")


_FEATURES = ("quantity", "price", "paid", "discount", "added")
_FIVE = "SELECT l_orderkey, l_linenumber, l_quantity AS quantity, l_extendedprice AS price, l_extendedprice * (1 - l_discount) AS paid, l_discount AS discount, l_discount + l_tax AS added FROM lineitem"


def _five(spark, sf):
    price, off = F.col("l_extendedprice"), F.col("l_discount")
    return A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), price.alias("price"), (price * (1 - off)).alias("paid"), off.alias("discount"), (off + F.col("l_tax")).alias("added"))


def _pca_sql(k: int, body: str) -> str:
    """The correlation matrix, and its first components by power iteration; each is taken out of the matrix before the next."""
    n = len(_FEATURES)
    moments = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _FEATURES)
    z = ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in _FEATURES)
    matrix = "[" + ", ".join("[" + ", ".join(f"covar_samp({a}, {b})" for b in _FEATURES) + "]" for a in _FEATURES) + "]"
    steps = [f"WITH RECURSIVE f AS ({_FIVE}), m AS (SELECT {moments} FROM f), z AS (SELECT l_orderkey, l_linenumber, {z} FROM f, m), c0 AS (SELECT {matrix} AS c FROM z)"]
    start = "[" + ", ".join(str(1.0 / (j + 1)) for j in range(n)) + "]"
    for j in range(k):
        times = f"list_transform(c, lambda r: list_dot_product(r, v))"
        steps.append(
            f"it{j}(i, v) AS (SELECT 0, CAST({start} AS DOUBLE[]) UNION ALL SELECT i + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w))) FROM (SELECT i, {times} AS w FROM it{j}, c{j} WHERE i < 2000)), "
            f"u{j} AS (SELECT v, list_dot_product({times}, v) AS variance FROM it{j}, c{j} WHERE i = 2000), "
            f"p{j} AS (SELECT list_transform(v, lambda x: x * sign(list_sort(list_transform(v, lambda y: {{'a': abs(y), 'y': y}}))[{n}].y)) AS v, variance FROM u{j}), "
            f"c{j + 1} AS (SELECT list_transform(range(1, {n + 1}), lambda a: list_transform(range(1, {n + 1}), lambda b: c[a][b] - variance * v[a] * v[b])) AS c FROM c{j}, p{j})"
        )
    return ", ".join(steps) + " " + body


@query("pca_fit_transform", _pca_sql(3, f"SELECT l_orderkey, l_linenumber, {', '.join('round(' + ' + '.join(f'{c} * p{j}.v[{i + 1}]' for i, c in enumerate(_FEATURES)) + f', 6) AS pc{j + 1}' for j in range(3))} FROM z, p0, p1, p2"))
def q_pca(spark, sf):
    from demandloom.operators import numeric as N

    df = _five(spark, sf)
    model = N.pca_fit(df, _FEATURES, 3)
    return _round(N.pca_transform(df, model).select("l_orderkey", "l_linenumber", "pc1", "pc2", "pc3"), "pc1", "pc2", "pc3")


@query("pca_components", _pca_sql(3, " UNION ALL ".join(f"SELECT {j + 1} AS component, '{c}' AS field, round(v[{i + 1}], 6) AS loading, round(variance, 6) AS variance, round(variance / {len(_FEATURES)} * (SELECT 1 - 1.0 / count(*) FROM z), 6) AS ratio FROM p{j}" for j in range(3) for i, c in enumerate(_FEATURES))))
def q_components(spark, sf):
    from demandloom.operators import numeric as N

    return _round(N.pca_fit(_five(spark, sf), _FEATURES, 3).table(spark), "loading", "variance", "ratio")


@query("sample_rows", "SELECT o_orderkey FROM orders WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 50")
def q_sample(spark, sf):
    from demandloom.operators import numeric as N

    return N.sample_rows(A.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 50)
