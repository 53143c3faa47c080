"""Operators whose work or state must not grow with one key, group or window: against brute force, plans and timings by ratio."""

import random
import time
from collections import Counter
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.functions.asof import last_before
from demandloom.functions.selection import exact_quantiles, ranked, value_range
from demandloom.jobs import analysis as J
from demandloom.operators import numeric as N
from demandloom.operators import panel as P
from demandloom.operators import profile as R
from demandloom.operators.running import BLOCK, Mode, Ordered, Spread, spikes
from demandloom.sources import io

D0 = date(2020, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_quantiles_of_a_group_with_a_million_values(spark):
    df = spark.range(1_000_000).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % 1_000_000 - 250_000).cast("double").alias("v"))
    got = exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 0.999, 1.0], ["g"]).first()
    assert got.key.g == "g" and got.n == 1_000_000
    assert got.q == pytest.approx([-250_000, -0.25, 249_999.5, 748_999.001 + 0, 749_999], abs=0.01)


def test_quantiles_are_numpys(spark):
    rng = np.random.default_rng(4)
    rows = [(("a", "b", None)[k % 3], float(x), float(y)) for k, (x, y) in enumerate(zip(rng.normal(0, 1e6, 900), rng.integers(-3, 4, 900), strict=True))]
    rows += [("c", None, 2.0), ("d", 1e-300, -1e300), ("d", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {(r.key.g, r.field): r for r in exact_quantiles(df, ["x", "y"], [0.1, 0.5, 0.9], ["g"]).collect()}
    assert ("c", "x") not in got
    for (g, field), r in got.items():
        values = [v[1 if field == "x" else 2] for v in rows if v[0] == g and v[1 if field == "x" else 2] is not None]
        assert r.n == len(values) and np.allclose(r.q, np.quantile(values, [0.1, 0.5, 0.9]), rtol=1e-12)


def test_ranges_of_values_rise_with_them(spark):
    values = sorted([0.0, float("inf"), float("-inf"), *(s * m * 10.0**e for s in (1, -1) for e in range(-300, 300, 7) for m in (1.0, 1.1, 5.0))])
    got = [r.b for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double").select("k", value_range(F.col("v")).alias("b")).orderBy("k").collect()]
    assert got == sorted(got)
    nan = spark.createDataFrame([(float("nan"),)], "v double").select(value_range(F.col("v"))).first()[0]
    assert nan > got[-1]


def test_profiles_have_no_percentile_state_and_no_window_over_everything(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    for out in (R.describe_columns(df, ["v"]), R.describe_columns(df, ["v"], ["k"]), R.boxplot_stats(df, "v", ["k"]), R.rank_density(df, "k")):
        plan = plan_of(out)
        assert "percentile" not in plan
        assert all("partitionBy" not in line and ("[key" in line or "_range" in line or "range" in line) for line in plan.splitlines() if line.strip().startswith(("+- Window", "Window")))


def test_ranks_are_those_of_a_sort(spark):
    rows = [(f"l{k * 37 % 500:03d}", k * k % 11) for k in range(500)]
    with io.scratch(spark) as paths:
        got = {r.label: r.rank for r in ranked(spark.createDataFrame(rows, "label string, n long").repartition(7), [F.desc("n"), F.asc("label")]).collect()}
        assert len(paths) == 1 and io.path_exists(spark, paths[0])
    assert not io.path_exists(spark, paths[0])
    want = {label: k for k, (label, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert got == want
    assert ranked(spark.createDataFrame([], "label string, n long"), [F.desc("n")]).count() == 0


def test_order_statistics_of_numbers():
    rng, seen, o, m = random.Random(5), [], Ordered(), Mode()
    for k in range(3 * BLOCK + 200):
        x = float(rng.choice([rng.randint(-5, 40), rng.randint(0, 3), 1000 * rng.random()]))
        seen.append(x)
        o.add(x)
        m.add(x)
        if k % 61 == 0 or k < 20:
            a, counts = np.array(seen), Counter(seen)
            assert o.median() == np.median(a) and o.above(3.0) == (a > 3).sum() and o.below(x)[0] == (a < x).sum()
            assert np.isclose(o.mean_deviation(), np.abs(a - a.mean()).mean()) and np.isclose(o.median_deviation(), np.median(np.abs(a - np.median(a))))
            assert m.value == max(counts, key=lambda v: (counts[v], v))
    assert len(o.blocks) > 1


def test_a_quantity_exactly_at_the_limit_is_no_spike():
    def count(values):
        o, s = Ordered(), Spread()
        for x in values:
            o.add(float(x))
            s.add(float(x))
        return spikes(o, s)

    at = [1, 1, 2, 2, 2, 3, 4, 5, 5, 5, 6, 7, 10, 11, 12, 13, 14, 14]  # median 5, deviation 4.5: the limit is 14
    rng = random.Random(8)
    for _ in range(300):
        rng.shuffle(at)
        assert count(at) == 0 and count([x / 8 for x in at]) == 0
    assert count([x * 2.0**40 for x in at]) == count([0.1] * 30) == 0
    assert count([1] * 20 + [14]) == 1 and count([1.0, 1.0, float("inf")]) == 0 and count([1e-300, 1e300]) == 0


def test_a_key_of_many_days_takes_nearly_linear_time(spark):
    def took(days):
        df = spark.range(days).select(F.lit(1).alias("shop_id"), F.lit(1).alias("item_id"), F.date_add(F.lit(D0), F.col("id").cast("int")).alias("date"), ((F.col("id") * 7919) % 997).cast("double").alias("qty"), F.lit(True).alias("sold"))
        begun = time.time()
        P.add_deviations(P.add_spikes(df, P.PAIR), P.PAIR).write.format("noop").mode("overwrite").save()
        return time.time() - begun

    took(500)
    assert took(20_000) < 10 * took(5_000) + 1  # four times the days


@pytest.mark.parametrize("width", [1, 7, 30])
def test_sliding_distinct_counts(spark, width):
    rng = random.Random(width)
    events = [(g, m, D0 + timedelta(rng.randint(0, 60))) for g in (1, 2) for m in range(6) for _ in range(5)] * 2
    days = [(g, D0 + timedelta(k)) for g in (1, 2) for k in range(61)]
    out = P.sliding_distinct(spark.createDataFrame(events, "g int, m int, date date"), spark.createDataFrame(days, "g int, date date"), ["g"], "m", width, "n")
    got = {(r.g, r.date): r.n for r in out.collect()}
    assert got == {(g, d): len({m for h, m, e in events if h == g and timedelta(1) <= d - e <= timedelta(width)}) for g, d in days}


def test_work_of_sliding_counts_does_not_depend_on_the_width(spark):
    events = spark.createDataFrame([(1, 1, D0)], "g int, m int, date date")
    plan = plan_of(P.sliding_distinct(events, events.select("g", "date"), ["g"], "m", 365, "n"))
    assert "sequence" not in plan


@pytest.mark.parametrize("stretch", [1, 5, 64])
def test_last_before_is_the_brute_force_one(spark, stretch):
    rng = random.Random(stretch)
    rows = [(k, rng.choice(["hot", "hot", "hot", None, "b"]), D0 + timedelta(rng.randint(0, 90)), rng.choice([None, rng.randint(0, 9)])) for k in range(400)]
    df = spark.createDataFrame(rows, "id int, k string, date date, v int")
    out = last_before(df, ["k"], F.datediff("date", F.lit(D0)), F.col("v"), "last", stretch)
    want = {}
    for i, k, d, _ in rows:
        earlier = [(e, v) for _, h, e, v in rows if h == k and e < d and v is not None]
        want[i] = max(earlier)[1] if earlier else None
    assert {r.id: r.last for r in out.collect()} == want and set(out.columns) == {*df.columns, "last"}


def test_returns_of_one_key_run_in_many_tasks(spark):
    sales = spark.range(4000).select(F.lit(1).alias("shop_id"), F.lit(1).alias("item_id"), F.date_add(F.lit(D0), F.pmod("id", F.lit(2000)).cast("int")).alias("date"), F.lit(0).alias("date_block_num"), F.lit(5.0).alias("item_price"), F.when(F.col("id") < 2000, 1.0).otherwise(-1.0).alias("item_cnt_day"))
    out = J.match_returns(sales).withColumn("task", F.spark_partition_id())
    n, tasks, unmatched = out.agg(F.count("*"), F.count_distinct("task"), F.count_if(F.col("sold_on").isNull())).first()
    assert (n, unmatched) == (2000, 1) and out.filter(F.datediff("date", "sold_on") != 1).count() == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert J.match_returns(sales).select(F.spark_partition_id().alias("t")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_components_of_many_columns(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 3)) @ rng.normal(size=(3, 40)) + 0.1 * rng.normal(size=(600, 40))
    names = [f"x{k}" for k in range(40)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in names)).repartition(5)
    with_null = df.unionByName(df.limit(1).withColumn("x0", F.lit(None).cast("double")))
    model = N.pca_fit(with_null, names, 5)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    cov = np.cov(z.T)
    for w, v in zip(model.components, model.variances, strict=True):
        assert np.allclose(cov @ w, v * w, atol=1e-9) and w[np.abs(w).argmax()] > 0
    assert np.allclose(model.components @ model.components.T, np.eye(5), atol=1e-12)
    assert np.allclose(model.ratios, model.variances / np.trace(cov)) and model.ratios[:3].sum() > 0.9
    assert model.table(spark).count() == 200
    got = np.array([[r.pc1, r.pc2] for r in N.pca_transform(df, model).select("pc1", "pc2").collect()])
    assert np.allclose(np.sort(got[:, 0]), np.sort(z @ model.components[0]))


def test_a_failing_writer_leaves_the_old_table(spark, tmp_path):
    root = f"file://{tmp_path}/tables"
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    io.write_table(old, "kept_table", root)
    bad = old.withColumn("k", F.when(F.col("k") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("k")).cast("int"))
    with pytest.raises(Exception, match="no"):
        io.write_table(bad, "kept_table", root)
    assert sorted(map(tuple, spark.table("kept_table").collect())) == [(1, "a"), (2, "b")]
    assert len([p for p in (tmp_path / "tables" / "kept_table").iterdir() if p.name.startswith("version-")]) == 1
    io.write_table(old.limit(0), "kept_table", root)
    assert spark.table("kept_table").count() == 0
    io.write_table(old.withColumn("more", F.lit(1.5)), "kept_table", root)  # other columns
    assert spark.table("kept_table").columns == ["k", "s", "more"] and spark.table("kept_table").count() == 2
    assert len([p for p in (tmp_path / "tables" / "kept_table").iterdir() if p.name.startswith("version-")]) == 1
    io.drop_table(spark, "kept_table", root)
    assert not spark.catalog.tableExists("kept_table") and not (tmp_path / "tables" / "kept_table").exists()


def test_counts_come_from_the_writing_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 0.0), (None, None, 2.0), (3, 4, 0.0)], "a int, b int, c double")
    tracker, group = spark.sparkContext.statusTracker(), "one-pass"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = R.missing_profile(df, path=f"file://{tmp_path}/a")
        assert len(tracker.getJobIdsForGroup(group)) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.field: r.n_missing for r in out.collect()} == {"a": 1, "b": 2, "c": 0}
    assert {r.field: r.n_zero for r in R.zero_profile(df, path=f"file://{tmp_path}/b").collect()} == {"a": 0, "b": 0, "c": 2}
    assert out.orderBy("field").collect() == R.missing_profile(df).orderBy("field").collect()
    assert spark.read.parquet(f"file://{tmp_path}/a").count() == 3
