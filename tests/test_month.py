"""Wide tables of a month, from a store in which grains are written once by month."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from demandloom import catalog
from demandloom.jobs import assembly as W
from demandloom.jobs.grain_store import PAIR_DAY, SIDES, GrainStore
from demandloom.params import PANEL, SEASON
from demandloom.queries import exploration as X
from demandloom.queries import panel as QP

SF = "/root/testdata/sf0.001"
MARCH = date(1998, 3, 1), date(1998, 3, 31)


@pytest.fixture(scope="module")
def store(spark):
    return X.store(spark, SF)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_the_month_is_read(store):
    wide = W.feature_table(store.parts(*MARCH))
    plan = plan_of(wide)
    assert store.months() == [199801, 199802, 199803, 199804]
    assert plan.count("PartitionFilters: [isnotnull(month") + plan.count("PartitionFilters: [(month") + plan.count("month#") >= 5
    scans = [line for line in plan.splitlines() if "FileScan" in line and "month#" in line]
    assert len(scans) >= 8 and all("(month#" in line and "199803" in line for line in scans)
    assert wide.agg(F.min("date"), F.max("date")).first()[0] >= MARCH[0] and wide.count() > 0
    assert W.feature_table(store.parts(date(1997, 12, 1), date(1997, 12, 31))).count() == 0


def test_pair_tables_join_without_an_exchange(spark, store):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store.parts()
        plan = plan_of(store.pair_days(*MARCH))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == len(SIDES) and "Exchange" not in plan


def test_a_month_is_replaced_alone_and_the_store_opens_again(spark, store, tmp_path):
    parts, root = store.parts(), f"file://{tmp_path}/grains"
    made = GrainStore(spark, root, buckets=3)
    made.put(parts)
    days = made.parts().pairs
    before = {r.month: (r.n, r.q) for r in days.groupBy(F.month("date").alias("month")).agg(F.count("*").alias("n"), F.sum("sid_qty").alias("q")).collect()}
    files = lambda month: sorted(p.name for p in (tmp_path / "grains" / "pairs_days" / f"month={month}").iterdir() if p.suffix == ".parquet")
    old = {m: files(m) for m in made.months()}
    doubled = X.W.Parts(**{**vars(parts), "pairs": parts.pairs.withColumn("sid_qty", 2 * F.col("sid_qty"))})
    made.put(doubled, months=[199803])
    made.close()
    again = GrainStore(spark, root, buckets=3)
    after = {r.month: (r.n, r.q) for r in again.parts().pairs.groupBy(F.month("date").alias("month")).agg(F.count("*").alias("n"), F.sum("sid_qty").alias("q")).collect()}
    assert after == {m: (n, 2 * q if m == 3 else q) for m, (n, q) in before.items()}
    assert files(199803) != old[199803] and all(files(m) == old[m] for m in old if m != 199803)
    versions = {(r.grain, r.month): (r.rows, r.version) for r in again.manifest().collect()}
    assert versions["pairs", 199803] == (before[3][0], 2) and versions["pairs", 199802] == (before[2][0], 1)
    again.delete()
    assert not (tmp_path / "grains").exists()


def test_a_month_that_no_manifest_names_is_not_read(spark, store, tmp_path):
    parts, root = store.parts(), f"file://{tmp_path}/grains"
    made = GrainStore(spark, root, buckets=2)
    made.put(parts, months=[199801])
    stray = made.spark.table(made.open["dates"]).limit(1).withColumn("month", F.lit(199802))
    stray.write.insertInto(made.open["dates"])  # as a write leaves it that failed before its manifest
    assert made.parts().dates.filter(F.month("date") != 1).count() == 0 and made.months("dates") == [199801]
    made.delete()


def test_additional_pairs_are_new_and_their_categories_filled(spark, store):
    grains = store.parts()
    pairs = grains.additional.select("shop_id", "item_id").distinct()
    assert pairs.count() > 0 and pairs.join(grains.pairs, ["shop_id", "item_id"]).count() == 0
    wide = W.feature_table(grains, additional=True)
    assert wide.count() == grains.additional.count() and wide.filter("category_qty is null").count() == 0
    key = [F.col("shop_id"), F.col("sid_item_category_id").alias("item_category_id"), F.col("date")]
    unmet = grains.additional.select(*key).join(grains.category_dates, ["shop_id", "item_category_id", "date"], "left_anti")
    assert unmet.count() > 0 and wide.filter("category_qty = 0 and category_qty_7d = 0").count() >= unmet.count()


def test_only_the_chosen_side_tables_are_read(store):
    store.parts()
    few = store.pair_days(*MARCH, sides=["deviations"])
    assert set(few.columns) == {*PAIR_DAY, "sid_qty", "sid_item_category_id", "sid_price_cv", "sid_qty_mean_ad", "sid_qty_median_ad"}
    assert plan_of(few).count("FileScan") == 2


def test_names_stand_once(spark):
    left = spark.createDataFrame([(1, 2, 3)], "k int, a int, b int")
    right = spark.createDataFrame([(1, 9, 8)], "k int, A int, c int")
    assert W.join_once(left, right, ["k"]).collect() == [(1, 2, 3, 8)]


def test_all_features_and_days(spark):
    df = catalog.queries()["monthly_feature_table_of_events"](spark, SF).cache()
    assert df.select(F.count_distinct("date")).first()[0] == (PANEL.train_end - PANEL.train_start).days + 1
    assert len(set(df.columns)) == len(df.columns) > 130
    assert {"s_n_items", "i_price_cv", "d_holiday", "d_month_sin", "id_n_shops_before", "sd_n_items_before", "sid_qty_median_ad", "si_shop_rank"} <= set(df.columns)
    df.unpersist()


def test_the_panel_of_order_lines_has_many_items_and_categories(spark):
    train, _ = QP.split(spark, "/root/testdata/sf0.01", QP.ORDERS)
    named = train.join(QP.ORDERS.categories(spark, "/root/testdata/sf0.01"), "item_id")
    n_items, n_categories, first, last = named.agg(F.count_distinct("item_id"), F.count_distinct("item_category_id"), F.min("date"), F.max("date")).first()
    assert n_items > 1000 and n_categories > 84 and first.month == SEASON.train_start.month and last.month == SEASON.train_end.month
