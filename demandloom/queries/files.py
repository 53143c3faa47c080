"""Round trips through files and tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from demandloom.queries.base import query
from demandloom.sources import adapters as A
from demandloom.sources import io

_SCHEMA = "shop_id long, item_id int, date date, date_block_num int, item_price double, item_cnt_day double"


def _written(spark, sf) -> str:
    path = io.scratch_path(spark, "csv")
    io.write_csv(A.panel_sales(spark, sf), path)
    return path


@query("write_csv", "SELECT * FROM panel_sales", "panel_sales")
def q_write(spark, sf):
    return io.read_csv_table(spark, _written(spark, sf), _SCHEMA)


@query("read_csv_table", "SELECT shop_id, item_cnt_day FROM panel_sales", "panel_sales")
def q_read(spark, sf):
    return io.read_csv_table(spark, _written(spark, sf), _SCHEMA, ["shop_id", "item_cnt_day"])


@query("read_csv_prefix", "SELECT * FROM panel_sales", "panel_sales")
def q_prefix(spark, sf):
    folder, df = io.scratch_path(spark, "prefix"), A.panel_sales(spark, sf)
    io.write_csv(df.filter("item_id < 2"), f"{folder}/first")
    io.write_csv(df.filter("item_id >= 2"), f"{folder}/rest/of/it")
    return io.read_csv_prefix(spark, folder, _SCHEMA)


def _unnamed(spark, name: str, df):
    """The rows of a table whose name is dropped; its files stay until their scratch scope ends."""
    rows = spark.read.schema(df.schema).parquet(*df.inputFiles())
    spark.sql(f"DROP TABLE {name}")
    return rows


@query("write_table", "SELECT * FROM panel_sales", "panel_sales")
def q_table(spark, sf):
    root, name = io.scratch_path(spark, "tables"), f"sales_{uuid.uuid4().hex}"
    io.write_table(A.panel_sales(spark, sf).limit(0), name, root)
    return _unnamed(spark, name, io.write_table(A.panel_sales(spark, sf), name, root))


@query("create_table_as", "SELECT item_id, sum(item_cnt_day) AS qty FROM panel_sales GROUP BY 1", "panel_sales")
def q_ctas(spark, sf):
    view = f"v_{uuid.uuid4().hex}"
    A.panel_sales(spark, sf).createOrReplaceTempView(view)
    made = io.create_table_as(spark, f"t_{view}", f"SELECT item_id, sum(item_cnt_day) AS qty FROM {view} GROUP BY item_id", io.scratch_path(spark, "tables"))
    spark.catalog.dropTempView(view)
    return _unnamed(spark, f"t_{view}", made)


@query("query_to_csv", "SELECT shop_id, count(*) AS n FROM panel_sales GROUP BY 1", "panel_sales")
def q_query(spark, sf):
    view, path = f"v_{uuid.uuid4().hex}", io.scratch_path(spark, "query")
    A.panel_sales(spark, sf).createOrReplaceTempView(view)
    io.query_to_csv(spark, f"SELECT shop_id, count(*) AS n FROM {view} GROUP BY shop_id", path)
    spark.catalog.dropTempView(view)
    return io.read_csv_table(spark, path, "shop_id long, n long")


_MONTH = "SELECT shop_id, item_id, date, item_price, item_cnt_day FROM sales WHERE year(date) = 1998 AND month(date) = 3"


@query("export_month", _MONTH, "sales")
def q_month(spark, sf):
    path = io.scratch_path(spark, "month")
    io.export_month(A.sales(spark, sf).drop("date_block_num"), 1998, 3, path)
    return spark.read.parquet(f"{path}/199803")


@query("export_months", _MONTH, "sales")
def q_months(spark, sf):
    path = io.scratch_path(spark, "months")
    return io.export_months(A.sales(spark, sf).drop("date_block_num"), path).filter(F.col("yr_mon") == 199803).drop("yr_mon")
