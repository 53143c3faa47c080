"""Registration of queries, and the common table expressions of their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

CTE = {
    "sales": """SELECT l_suppkey AS shop_id, l_partkey AS item_id, CAST(l_shipdate AS DATE) AS date,
       CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS INT) AS date_block_num, l_extendedprice / l_quantity AS item_price,
       CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS item_cnt_day FROM lineitem""",
    "panel_sales": """SELECT user_id AS shop_id, CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS item_id,
       CASE WHEN (5 * user_id + CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END) % 11 = 0 THEN DATE '2024-01-24' + CAST(day(ts) % 7 AS INT) ELSE CAST(ts AS DATE) END AS date, CAST(month(ts) - 1 AS INT) AS date_block_num,
       CAST(10 * (CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END + 1) + event_id % 3 AS DOUBLE) AS item_price,
       CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN CAST(-(event_id % 5 + 1) AS DOUBLE) ELSE CAST(event_id % 5 + 1 AS DOUBLE) END AS item_cnt_day FROM events""",
    "items": """SELECT CAST(p_partkey AS INT) AS item_id, p_name AS item_name, CAST(100 * (CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2
       WHEN 'PROMO' THEN 3 WHEN 'SMALL' THEN 4 ELSE 5 END) + CAST(replace(p_brand, 'Brand#', '') AS INT) AS INT) AS item_category_id FROM part""",
    "item_categories": """SELECT DISTINCT CAST(100 * (CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'PROMO' THEN 3 WHEN 'SMALL' THEN 4 ELSE 5 END)
       + CAST(replace(p_brand, 'Brand#', '') AS INT) AS INT) AS item_category_id, concat(p_type, ' - ', p_brand) AS item_category_name FROM part""",
    "shops": "SELECT CAST(s_suppkey AS INT) AS shop_id, concat(n_name, ' ', s_name) AS shop_name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "cities": """SELECT n_name AS city, CAST(100000 + 50000 * n_nationkey AS DOUBLE) AS population,
       CASE WHEN n_nationkey % 3 = 0 THEN concat(CAST(40 + n_nationkey AS VARCHAR), '°0', CAST(n_nationkey % 10 AS VARCHAR), '′ с. ш. ', CAST(30 + n_nationkey AS VARCHAR), '°30′ в. д.')
            ELSE concat(CAST(40 + n_nationkey AS VARCHAR), '°0', CAST(n_nationkey % 10 AS VARCHAR), '′15″ с. ш. ', CAST(30 + n_nationkey AS VARCHAR), '°30′45″ в. д.') END AS geo_coords,
       concat('UTC+', CAST(3 + n_nationkey % 6 AS VARCHAR)) AS time_zone FROM nation""",
    "macro": """SELECT CAST(o_orderdate AS DATE) AS date, min(o_totalprice) AS brent, max(o_totalprice) AS usdrub, count(*) AS orders_cnt,
       CASE WHEN count(*) % 4 = 0 THEN NULL ELSE count(*) END AS with_nulls FROM orders GROUP BY 1""",
    "releases": "SELECT CAST(o_orderdate AS DATE) AS release_date FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 490000",
    "housing": """SELECT l_orderkey AS id, CAST(l_shipdate AS DATE) AS timestamp, l_extendedprice AS price_doc, l_quantity AS full_sq, nullif(l_tax, 0) AS life_sq, nullif(l_discount, 0) AS kitch_sq,
       CAST(l_linenumber AS INT) AS floor, CAST(p_size AS INT) AS max_floor, CASE WHEN p_size % 7 <> 0 THEN CAST(l_linenumber + 1990 AS INT) END AS build_year, l_tax AS num_room,
       l_returnflag AS product_type, p_brand AS sub_area FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "houses": """SELECT p_partkey AS id, p_retailprice AS SalePrice, p_brand AS brand, p_type AS kind, CAST(p_size AS VARCHAR) AS size,
       CASE p_size % 6 WHEN 0 THEN 'Ex' WHEN 1 THEN 'Gd' WHEN 2 THEN 'TA' WHEN 3 THEN 'Fa' WHEN 4 THEN 'Po' END AS quality FROM part""",
    "image_labels": "SELECT doc_id AS Image, concat(lang, '-', source) AS Id FROM documents",
    "closing_sales": "SELECT * FROM sales WHERE shop_id % 5 <> 0 OR date < DATE '1999-01-01' + CAST(shop_id % 24 * 30 AS INT)",
    "miscounted_sales": "SELECT * REPLACE (CASE WHEN shop_id % 13 = 0 AND day(date) = 1 THEN date_block_num - 1 ELSE date_block_num END AS date_block_num) FROM sales",
    "launched_sales": "SELECT s.* FROM sales s JOIN items i ON s.item_id = i.item_id WHERE date >= DATE '1995-01-01' + CAST(item_category_id * 37 % 2500 AS INT)",
    "known_shops": "SELECT * FROM shops WHERE shop_id % 10 <> 0",
    "known_items": "SELECT * FROM items WHERE item_id % 7 <> 0",
    # cleaning, as one statement of its rules
    "d": "SELECT DISTINCT * FROM panel_sales",
    "g": """SELECT shop_id, item_id, date, min(date_block_num) AS date_block_num, count(*) AS n, bool_or(item_cnt_day > 0) AND bool_or(item_cnt_day < 0) AS mixed,
       sum(item_cnt_day) AS qty, sum(item_price * item_cnt_day) / nullif(sum(item_cnt_day), 0) AS weighted, min(item_price) AS only_price FROM d GROUP BY 1, 2, 3""",
    "clean_all": "SELECT shop_id, item_id, date, date_block_num, CASE WHEN n = 1 THEN only_price ELSE weighted END AS item_price, qty AS item_cnt_day FROM g WHERE n = 1 OR NOT mixed",
    "clean": "SELECT * FROM clean_all WHERE item_price > 0 AND date >= DATE '2024-01-01'",
    "train": "SELECT * FROM clean WHERE date <= DATE '2024-01-23'",
    "test": "SELECT DISTINCT shop_id, item_id FROM clean WHERE date >= DATE '2024-01-24'",
    "cats": "SELECT CAST(range AS INT) AS item_id, CAST(range % 2 AS INT) AS item_category_id FROM range(5)",
    "named_train": "SELECT t.*, c.item_category_id AS cat FROM train t JOIN cats c ON t.item_id = c.item_id",
}
#: The same names over five months of order lines, and the dates that statements name.
SEASON_CTE = CTE | {
    "panel_sales": "SELECT * FROM sales WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-05-31'",
    "clean": "SELECT * FROM clean_all WHERE item_price > 0 AND date >= DATE '1998-01-01'",
    "train": "SELECT * FROM clean WHERE date <= DATE '1998-04-30'",
    "test": "SELECT DISTINCT shop_id, item_id FROM clean WHERE date >= DATE '1998-05-01'",
    "cats": "SELECT CAST(item_id AS BIGINT) AS item_id, item_category_id FROM items",
}
SEASON_DATES = {"DATE '2024-01-23'": "DATE '1998-04-30'", "DATE '2024-01-01'": "DATE '1998-01-01'"}
NEEDS = {"closing_sales": ["sales"], "miscounted_sales": ["sales"], "launched_sales": ["sales", "items"], "known_shops": ["shops"], "known_items": ["items"], "d": ["panel_sales"], "g": ["d"], "clean_all": ["g"], "clean": ["clean_all"], "train": ["clean"], "test": ["clean"], "named_train": ["train", "cats"]}
SEASON_NEEDS = NEEDS | {"panel_sales": ["sales"], "cats": ["items"]}


def with_ctes(body: str, *names: str, season: bool = False) -> str:
    """``body`` after the named table expressions and all that they need; it may begin with its own ("WITH x AS ...")."""
    order: list[str] = []
    ctes, needs = (SEASON_CTE, SEASON_NEEDS) if season else (CTE, NEEDS)
    for ours, theirs in SEASON_DATES.items() if season else ():
        body = body.replace(ours, theirs)

    def add(name: str) -> None:
        for x in needs.get(name, ()):
            add(x)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    head = ",\n".join(f"{n} AS ({ctes[n]})" for n in order)
    body = body.strip()
    if not head:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head}, {body[15:]}"
    return f"WITH {head}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {head}\n{body}"


def query(name: str, sql: str | None = None, *ctes: str, season: bool = False):
    """Register a function (spark, sf_dir) -> DataFrame with its SQL over the named table expressions."""

    def add(f):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = with_ctes(sql, *ctes, season=season)
        return f

    return add
