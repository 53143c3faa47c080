"""Panels are computed once, by as many tasks as there are partitions, and the store builds what a query reads."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from demandloom import catalog
from demandloom.jobs import assembly as W
from demandloom.operators import panel as P
from demandloom.queries import exploration as X
from demandloom.queries import panel as QP
from demandloom.sources import io

SF = "/root/testdata/sf0.001"
D0 = date(2024, 1, 1)
MARCH = date(1998, 3, 1), date(1998, 3, 31)


def test_the_features_of_a_grain_are_computed_once(spark):
    for df in (QP.item_dates(spark, SF, QP.ORDERS), QP.shop_dates(spark, SF), QP.shop_item_dates(spark, SF)):
        assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_few_rows_that_become_many_stay_in_many_tasks(spark):
    daily = spark.range(400).select(F.col("id").alias("item_id"), F.lit(D0).alias("date"), F.lit(1.0).alias("qty"))
    filled = P.densify(daily, P.ITEM, daily.select("item_id"), D0 + timedelta(20))
    assert filled.count() == 400 * 21 and filled.select(F.spark_partition_id()).distinct().count() == 4


def test_days_without_sales_have_the_features_of_their_age(spark):
    days = [(s, 7, D0 + timedelta(s + k), 0.0, False, None) for s in (1, 5) for k in range(40)]
    panel = spark.createDataFrame(days, "shop_id long, item_id long, date date, qty double, sold boolean, price double")
    want = P.panel_features(panel, P.PAIR, ("price",))
    short = panel.withColumn("age", F.datediff("date", F.date_add(F.lit(D0), F.col("shop_id").cast("int"))))
    got = short.drop("price").join(P.empty_features(spark, 40, P.PAIR, ("price",)), "age").select(*want.columns)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_query_builds_the_grains_that_it_reads(spark):
    X._stores.clear()
    with io.scratch(spark):
        few = X.store(spark, SF, grains=(*X.ADDITIONAL, *X.CATEGORY), sides=())
        assert set(few.open) == {"additional_days", *X.SHARED, "category_dates"}
        assert few.parts(sides=()).pairs is None and few.parts(sides=()).additional.count() > 0
        more = X.store(spark, SF, grains=(*X.ADDITIONAL, *X.CATEGORY))
        assert more is few and {t for t in more.open if t.startswith("additional")} == {"additional_days", "additional_gaps", "additional_quantities", "additional_changes", "additional_deviations"}
        assert more.parts().additional.count() == few.parts(sides=()).additional.count()
        assert not [r for r in spark.read.json(f"{few.root}/manifest").collect() if r["grain"] == "pairs"]
        X._stores.clear()
        few.close()


def test_a_month_is_built_alone_and_its_shared_grains_are_joined_once(spark):
    X._stores.clear()
    with io.scratch(spark):
        wide = catalog.queries()["union_train_addl"](spark, SF)
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert [sum("FileScan" in line and f"_{grain}[" in line for line in plan.splitlines()) for grain in ("item_dates", "shop_dates")] == [1, 1]
        made = X.store(spark, SF, grains=(), month=199803)
        made.parts()
        assert made.months("pairs") == made.months("item_dates") == [199803]
        assert not {"pair_totals", "additional_gaps"} & set(made.open)
        got = sorted(map(repr, wide.collect()))
        whole = X.store(spark, SF)
        parts = whole.parts(*MARCH)
        assert whole is made and whole.months("pairs") == [199801, 199802, 199803, 199804]
        both = W.feature_table(parts).drop("si_qty", "si_n_dates", "si_shop_rank").unionByName(W.feature_table(parts, True))
        assert set(both.columns) == set(wide.columns) and got == sorted(map(repr, both.select(*wide.columns).collect()))
        X._stores.clear()
        whole.close()
