"""The library's input tables, read from the star-schema tables of a directory."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.params import PANEL, SEASON


RELEASE_PRICE = 490_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily shop-item sales of order lines: many pairs, few sales each."""
    d = F.col("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("shop_id"),
        F.col("l_partkey").alias("item_id"),
        d.cast("date").alias("date"),
        ((F.year(d) - 1995) * 12 + F.month(d) - 1).cast("int").alias("date_block_num"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("item_price"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("item_cnt_day"),
    )


def panel_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of events: five items, many shops, one month; prices repeat and errors may be returns.

    One pair in eleven has all its sales in the last week: a pair that the test period is the first to have.
    """
    item = F.when(F.col("event_type") == "click", 0).when(F.col("event_type") == "error", 1).when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "signup", 3).otherwise(4)
    qty = (F.pmod(F.col("event_id"), F.lit(5)) + 1).cast("double")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("shop_id"),
        item.alias("item_id"),
        F.when(F.pmod(5 * F.col("user_id") + item, F.lit(11)) == 0, F.date_add(F.lit(PANEL.test_start), F.pmod(F.day("ts"), F.lit(7)))).otherwise(F.col("ts").cast("date")).alias("date"),
        (F.month("ts") - 1).cast("int").alias("date_block_num"),
        (10 * (item + 1) + F.pmod(F.col("event_id"), F.lit(3))).cast("double").alias("item_price"),
        F.when((F.col("event_type") == "error") & (F.pmod(F.col("event_id"), F.lit(2)) == 0), -qty).otherwise(qty).alias("item_cnt_day"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    no = F.when(kind == "ECONOMY", 0).when(kind == "LARGE", 1).when(kind == "MEDIUM", 2).when(kind == "PROMO", 3).when(kind == "SMALL", 4).otherwise(5)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("item_id"), F.col("p_name").alias("item_name"), (100 * no + F.regexp_replace("p_brand", "Brand#", "").cast("int")).cast("int").alias("item_category_id"))


def item_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_type", F.lit(" - "), "p_brand").alias("item_category_name"))
    named = part.join(items(spark, sf_dir), F.col("p_partkey").cast("int") == F.col("item_id"))
    return named.select("item_category_id", "item_category_name").distinct()


def panel_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five items of the panel and the parities that stand for their categories: item_id, item_category_id."""
    return spark.range(5).select(F.col("id").cast("int").alias("item_id"), F.pmod("id", F.lit(2)).cast("int").alias("item_category_id"))


def season_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of all shops and items in five months."""
    return sales(spark, sf_dir).filter(F.col("date").between(F.lit(SEASON.train_start), F.lit(SEASON.test_end)))


def season_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items with their categories: item_id, item_category_id."""
    return items(spark, sf_dir).select(F.col("item_id").cast("long").alias("item_id"), "item_category_id")


def shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("s_suppkey").cast("int").alias("shop_id"), F.concat("n_name", F.lit(" "), "s_name").alias("shop_name"))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A city for each nation, with coordinates in degrees and minutes, and seconds for two thirds."""
    n = F.col("n_nationkey")
    text = lambda x: x.cast("string")
    short = F.concat(text(40 + n), F.lit("°0"), text(n % 10), F.lit("′ с. ш. "), text(30 + n), F.lit("°30′ в. д."))
    full = F.concat(text(40 + n), F.lit("°0"), text(n % 10), F.lit("′15″ с. ш. "), text(30 + n), F.lit("°30′45″ в. д."))
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("city"), (100_000 + 50_000 * n).cast("double").alias("population"), F.when(n % 3 == 0, short).otherwise(full).alias("geo_coords"), F.concat(F.lit("UTC+"), text(3 + n % 6)).alias("time_zone"))


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily indicators; with_nulls has gaps."""
    daily = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date"))
    n = F.count("*")
    return daily.agg(F.min("o_totalprice").alias("brent"), F.max("o_totalprice").alias("usdrub"), n.alias("orders_cnt"), F.when(n % 4 != 0, n).alias("with_nulls"))


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the largest urgent orders."""
    urgent = table(spark, sf_dir, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > RELEASE_PRICE))
    return urgent.select(F.col("o_orderdate").cast("date").alias("release_date"))


def housing(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return line.join(part, line.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("id"),
        F.col("l_shipdate").cast("date").alias("timestamp"),
        F.col("l_extendedprice").alias("price_doc"),
        F.col("l_quantity").alias("full_sq"),
        F.nullif("l_tax", F.lit(0.0)).alias("life_sq"),
        F.nullif("l_discount", F.lit(0.0)).alias("kitch_sq"),
        F.col("l_linenumber").cast("int").alias("floor"),
        F.col("p_size").cast("int").alias("max_floor"),
        F.when(F.col("p_size") % 7 != 0, F.col("l_linenumber") + 1990).cast("int").alias("build_year"),
        F.col("l_tax").alias("num_room"),
        F.col("l_returnflag").alias("product_type"),
        F.col("p_brand").alias("sub_area"),
    )


def houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = F.when(F.col("p_size") % 6 == 0, "Ex").when(F.col("p_size") % 6 == 1, "Gd").when(F.col("p_size") % 6 == 2, "TA").when(F.col("p_size") % 6 == 3, "Fa").when(F.col("p_size") % 6 == 4, "Po")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("SalePrice"), F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.col("p_size").cast("string").alias("size"), quality.alias("quality"))


def image_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("Image"), F.concat_ws("-", "lang", "source").alias("Id"))


def closing_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of shops of which every fifth closes: in 1999 or the two years after."""
    close = F.date_add(F.lit(date(1999, 1, 1)), (F.pmod(F.col("shop_id"), F.lit(24)) * 30).cast("int"))
    return sales(spark, sf_dir).filter((F.col("shop_id") % 5 != 0) | (F.col("date") < close))


def launched_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of items from the launch of their category on, which for some lies in the test period."""
    df = sales(spark, sf_dir).join(items(spark, sf_dir).select("item_id", "item_category_id"), "item_id")
    launch = F.date_add(F.lit(date(1995, 1, 1)), F.pmod(F.col("item_category_id") * 37, F.lit(2500)).cast("int"))
    return df.filter(F.col("date") >= launch).select(*sales(spark, sf_dir).columns)


def known_shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shop table that lacks one shop in ten."""
    return shops(spark, sf_dir).filter("shop_id % 10 <> 0")


def known_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item table that lacks one item in seven."""
    return items(spark, sf_dir).filter("item_id % 7 <> 0")


def miscounted_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales in which some shops count the first day of a month to the month before."""
    wrong = (F.pmod("shop_id", F.lit(13)) == 0) & (F.day("date") == 1)
    return sales(spark, sf_dir).withColumn("date_block_num", F.when(wrong, F.col("date_block_num") - 1).otherwise(F.col("date_block_num")))
