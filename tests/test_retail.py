"""Hand-computed cases of the panel rules, and queries against their SQL."""

from datetime import date, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from demandloom import catalog
from demandloom.functions import text
from demandloom.jobs import analysis as J
from demandloom.operators import clean as C
from demandloom.operators import dates as T
from demandloom.operators import numeric as N
from demandloom.operators import panel as P
from demandloom.operators import profile as R
from demandloom.sources import io

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
D0 = date(2024, 1, 1)


def series(spark, quantities, shop=1, item=1):
    return spark.createDataFrame([(shop, item, D0 + timedelta(k), float(q)) for k, q in enumerate(quantities) if q is not None], "shop_id long, item_id int, date date, qty double")


def column(df, name):
    return [r[0] for r in df.orderBy("date").select(name).collect()]


def test_clean_sales(spark):
    rows = [
        (1, 1, D0, 10.0, 1.0), (1, 1, D0, 10.0, 1.0), (1, 1, D0 + timedelta(1), 10.0, 1.0), (1, 1, D0 + timedelta(1), 20.0, 3.0), (1, 2, D0, 5.0, 2.0), (1, 2, D0, 5.0, -2.0),
        (1, 3, D0, -1.0, 1.0), (1, 4, D0 - timedelta(1), 3.0, 1.0), (1, 5, D0, 3.0, -1.0),
    ]
    sales = spark.createDataFrame([(*r[:3], 0, *r[3:]) for r in rows], "shop_id long, item_id int, date date, date_block_num int, item_price double, item_cnt_day double")
    got = sorted((r.item_id, r.date, r.item_price, r.item_cnt_day) for r in C.clean_sales(sales, D0).collect())
    assert got == [(1, D0, 10.0, 1.0), (1, D0 + timedelta(1), 17.5, 4.0), (5, D0, 3.0, -1.0)]


def test_dense_panel_and_tail(spark):
    daily = series(spark, [2, None, None, 1])
    assert column(P.densify(daily, P.PAIR), "qty") == [2, 0, 0, 1]
    tail = P.densify(daily, P.PAIR, daily.select("shop_id", "item_id"), D0 + timedelta(5))
    assert column(tail, "qty") == [2, 0, 0, 1, 0, 0]
    other = P.densify(daily, P.PAIR, daily.filter("shop_id = 9").select("shop_id", "item_id"), D0 + timedelta(5))
    assert column(other, "qty") == [2, 0, 0, 1]


def test_mode_takes_the_largest_of_ties(spark):
    df = P.expanding_qty_stats(P.densify(series(spark, [5, 0, 5, 3, 3, 9]), P.PAIR), P.PAIR)
    assert column(df, "qty_all_mode") == [5, 5, 5, 5, 5, 5]
    assert column(df, "qty_all_median") == [5, 5, 2.5, 5, 4, 3]


def test_signs_matter(spark):
    df = P.densify(series(spark, [4, -2, 0, 3]), P.PAIR)
    df = P.add_last_two_qty_diff(df.withColumns({**P.prev_nonzero_qty(P.PAIR), **P.days_since_prev_sale(P.PAIR)}), P.PAIR)
    assert column(df, "prev_nonzero_qty") == [0, 4, -2, -2]
    assert column(df, "days_since_prev_sale") == [0, 1, 2, 3]
    assert column(df, "last_two_qty_diff") == [0, 0, -6, -6]


def test_single_sale_has_every_default(spark):
    sales = spark.createDataFrame([(1, 1, D0, 0, 7.0, 3.0)], "shop_id long, item_id int, date date, date_block_num int, item_price double, item_cnt_day double")
    row = P.build_panel(sales, sales.limit(0), P.PAIR, D0, extras=("price",)).first().asDict()
    assert row["qty_7d_max"] == row["qty_all_mode"] == 3 and row["adi"] == 0
    rest = {k: v for k, v in row.items() if not k.startswith(("qty_7d", "qty_all")) and k not in ("shop_id", "item_id", "date", "qty", "sold", "first_week", "first_month")}
    assert not any(rest.values()), rest


def test_adi_is_null_for_age_without_sales(spark):
    df = P.densify(series(spark, [-1, None, 2]), P.PAIR).withColumns(P.expanding_adi(P.PAIR))
    assert column(df, "adi") == [0, None, None]


def test_spikes_and_deviations(spark):
    df = P.add_deviations(P.add_spikes(P.densify(series(spark, [1, 1, 1, 1, 1, 1, 1, 9, 1, 1]), P.PAIR), P.PAIR), P.PAIR)
    assert column(df, "n_spikes") == [0, 0, 0, 0, 0, 0, 0, 0, 1, 1]
    two = P.add_deviations(P.densify(series(spark, [1, None, 3, 8]), P.PAIR), P.PAIR)
    assert column(two, "qty_mean_ad") == [0, 0, 0, 1] and [round(x, 4) for x in column(two, "qty_median_ad")] == [0, 0, 0, 1.4826]


def test_keys_do_not_leak(spark):
    df = P.densify(series(spark, [3, 0, 0]).unionByName(series(spark, [0, 5], item=2)), P.PAIR)
    got = df.withColumns({**P.prev_nonzero_qty(P.PAIR), **P.qty_lags(P.PAIR)}).filter("item_id = 2")
    assert column(got, "prev_nonzero_qty") == [0, 0] and column(got, "qty_lag1") == [0, 0]


def test_features_ignore_today(spark):
    a, b = (P.build_panel(series(spark, q).withColumnRenamed("qty", "item_cnt_day"), series(spark, [1]), P.PAIR, D0).drop("qty", "sold") for q in ([2, 5, 1, 4], [2, 5, 1, 40]))
    last = D0 + timedelta(3)
    assert a.filter(F.col("date") == last).collect() == b.filter(F.col("date") == last).collect()


def test_coordinates_and_dates(spark):
    rows = spark.createDataFrame([("12°34′30″ с. ш. 98°15′45″ в. д.",), ("41°20′ с. ш. 7°05′ в. д.",), ("none",)], "g string")
    lat, lon = text.dms_to_decimal("g")
    got = [(r.a and round(r.a, 6), r.b and round(r.b, 6)) for r in rows.select(lat.alias("a"), lon.alias("b")).collect()]
    assert got == [(12.575, 98.2625), (41.333333, 7.083333), (None, None)]
    days = spark.createDataFrame([(date(2024, 1, k),) for k in (1, 3, 5, 9)], "date date")
    h = T.holiday_features(days, [date(2024, 1, 3), date(2024, 1, 5)]).orderBy("date").collect()
    assert [(r.holiday, r.days_to_holiday, r.days_since_holiday) for r in h] == [(0, 2, None), (1, 0, 0), (1, 0, 0), (0, None, 4)]


def test_box_and_downcast(spark):
    box = R.boxplot_stats(spark.createDataFrame([("a", x) for x in (1, 2, 3, 4, 100)], "k string, v int"), "v", ["k"]).first()
    assert (box.q1, box.median, box.q3, box.whisker_low, box.whisker_high, box.n_outliers) == (2, 3, 4, 1, 4, 1)
    df = spark.createDataFrame([(1.0, 2.5, 300, None), (2.0, 1.0, 5, None)], "a double, b double, c long, d int")
    assert [t for _, t in C.downcast(df).dtypes] == ["tinyint", "float", "smallint", "int"]
    assert C.sql_type_map(df) == {"a": "FLOAT", "b": "FLOAT", "c": "BIGINT", "d": "INT"}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "shop_id long, item_id int, date date, date_block_num int, item_price double, item_cnt_day double")
    assert C.clean_sales(empty, D0).count() == 0 and P.build_panel(empty, empty, P.PAIR, D0, ("price",)).count() == 0
    assert J.match_returns(empty).count() == 0 and R.histogram(empty, F.col("item_price"), 5).count() == 0


def test_partial_autocorrelation_of_an_autoregression():
    acf = [0.6**k for k in range(6)]
    got = T.partial_autocorrelation(acf)
    assert got[0] == 1 and abs(got[1] - 0.6) < 1e-12 and all(abs(x) < 1e-12 for x in got[2:])


def test_principal_components(spark):
    df = spark.createDataFrame([(float(k), 2.0 * k + (k % 3), float(k * 7 % 5)) for k in range(60)], "x double, y double, z double")
    model = N.pca_fit(df, ["x", "y", "z"], 3)
    projected = N.pca_transform(df, model)
    for k in range(3):
        assert abs(projected.agg(F.var_samp(f"pc{k + 1}")).first()[0] - model.variances[k]) < 1e-9
    assert abs(model.ratios.sum() - 1) < 1e-12 and abs(projected.agg(F.corr("pc1", "pc2")).first()[0]) < 1e-9


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, date(2024, 1, 30), "x"), (2, date(2024, 2, 1), "y, z")], "id int, date date, s string")
    io.write_csv(df, f"{tmp_path}/csv/a")
    io.write_csv(df, f"{tmp_path}/csv/b")
    assert io.read_csv_prefix(spark, f"{tmp_path}/csv", "id int, date date, s string").count() == 4
    assert io.read_csv_table(spark, f"{tmp_path}/csv/a", "id int, date date, s string", ["s"]).orderBy("s").first().s == "x"
    months = io.export_months(df, f"file://{tmp_path}/months")
    february = months.filter("yr_mon = 202402")
    assert february.count() == 1 and "PartitionFilters: [isnotnull(yr_mon" in february._jdf.queryExecution().executedPlan().toString()
    assert io.export_months(df.limit(1), f"file://{tmp_path}/months").count() == 1
    assert io.export_month(df, 2024, 1, f"{tmp_path}/one") == 1
    assert spark.read.parquet(f"{tmp_path}/one/202401").first().id == 1
    df.createOrReplaceTempView("small")
    io.query_to_csv(spark, "SELECT id FROM small", f"{tmp_path}/q")
    assert io.read_csv_table(spark, f"{tmp_path}/q", "id int").count() == 2
    cast, failed = io.read_table_cast(df.select(F.lit("7").alias("a"), "s"), {"a": "int", "s": "int", "none": "int"}, f"{tmp_path}/cast")
    assert cast.dtypes == [("a", "int"), ("s", "string")] and failed == {"a": 0, "s": 2} and cast.count() == 2


def test_one_exchange_for_all_windows(spark):
    sales = spark.createDataFrame([], "shop_id long, item_id int, date date, date_block_num int, item_price double, item_cnt_day double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plan = P.build_panel(sales, sales, P.ITEM, D0)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # day sums, then one exchange on the key for the tail join and every window; the rest is the test keys' side
    assert plan.count("Exchange hashpartitioning(item_id") <= 4 and plan.count("SinglePartition") == 0


@pytest.mark.parametrize("name", ["clean_sales", "rolling_7d_stats", "match_returns", "monthly_median", "build_item_date_features", "days_to_add_test", "dms_to_decimal", "rank_density", "histogram"])
def test_query_states_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    norm = lambda rows: sorted(str([None if v is None else f"{v:.6f}" if isinstance(v, float) else str(v)[:10] for v in r]) for r in rows)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({catalog.oracle_sql()[name]})").fetchall()
    assert norm(df.select(*columns).collect()) == norm(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
