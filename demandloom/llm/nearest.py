"""Approximate nearest neighbours by largest inner product: one graph a shard, every query to every shard.

Equal vectors are one node of a graph with the smallest member ids that a result can need, so
that a vector which a third of all rows share costs no more than one. Indexes are rows of a
Parquet dataset; blocks of queries meet them in an equi-join on the shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm.common import materialise, table
from demandloom.llm.graph_index import pack_index, search_index, unpack_index

TOP, QUERY_EVERY = 20, 20
#: Distinct vectors of one shard, about. Larger shards make searches cheaper, builds dearer and recall lower.
SHARD_ROWS = 9_000
QUERY_BLOCK = 512


def usable(vector: Column) -> Column:
    """True for vectors that aren't null, empty, zero or holding null, NaN or an infinity."""
    inf = float("inf")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def build_shards(rows: DataFrame, top: int = TOP, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(dim, shard, shards, index) of rows (vec_id, vector): the written graph index, one row a shard.

    Vectors of different lengths never share a shard.
    """
    w = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= top + 1)  # limited before the shuffle, too
    distinct = materialise(few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("members")).withColumn("dim", F.size("vector")), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    sizes = distinct.groupBy("dim").agg(F.count("*").alias("_rows"), F.max(square).alias("longest")).withColumn("shards", F.ceil(F.col("_rows") / shard_rows).cast("int"))
    every = sizes.agg(F.sum("shards")).first()[0] or 1
    placed = distinct.join(F.broadcast(sizes), "dim").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int"))  # a row for each vector length

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.iloc[np.lexsort([[m[0] for m in group["members"]]])]
        data = pack_index(np.stack(group["vector"].to_numpy()).astype(np.float64), [list(m) for m in group["members"]], float(group["longest"].iloc[0]))
        return pd.DataFrame({"dim": group["dim"].iloc[:1], "shard": group["shard"].iloc[:1], "shards": group["shards"].iloc[:1], "index": [data]})

    # a given number of parts isn't coalesced by their small sizes, so that few tasks build two shards
    return materialise(placed.repartition(2 * every, "dim", "shard").groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, shards int, index binary"), "graph-index")


def search_shards(index: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found of rows (vec_id, vector), over all shards."""
    asked = queries.select(F.col("vec_id").alias("query_id"), "vector", F.size("vector").alias("dim"))
    blocks = max(1, ceil(asked.count() / QUERY_BLOCK))
    packed = asked.groupBy("dim", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block")).agg(F.collect_list("query_id").alias("ids"), F.flatten(F.collect_list("vector")).alias("flat"))
    shards = index.select("dim", "shard").groupBy("dim").agg(F.collect_list("shard").alias("_each"))
    sent = packed.join(shards, "dim").withColumn("shard", F.explode("_each")).drop("_each")
    pairs = sent.join(index.select("dim", "shard", "index"), ["dim", "shard"]).select("dim", "shard", "ids", "flat", "index")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in ("dim", "shard", "ids", "flat", "index")}
                dim, shard = row["dim"].as_py(), row["shard"].as_py()
                if (dim, shard) != last:
                    last, held = (dim, shard), unpack_index(row["index"].as_py())
                ids = np.array(row["ids"].as_py(), np.int64)
                found = search_index(held, ids, np.asarray(row["flat"].values, np.float64).reshape(len(ids), dim), top)
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(ids), "vec_ids": pa.array([f[0] for f in found], pa.list_(pa.int64())), "scores": pa.array([f[1] for f in found], pa.list_(pa.float64()))})

    found = pairs.mapInArrow(search, "query_id long, vec_ids array<long>, scores array<double>")
    # each shard gives at most ``top`` to a query
    merged = found.groupBy("query_id").agg(F.flatten(F.collect_list(F.arrays_zip(F.transform("scores", lambda s: -s).alias("minus"), F.col("vec_ids").alias("vec_id")))).alias("all"))
    best = merged.select("query_id", F.posexplode(F.slice(F.array_sort("all"), 1, top)).alias("rank", "hit"))
    return best.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).alias("score"))


def nearest(rows: DataFrame, is_query: Column, top: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``top`` nearest rows found for each row that ``is_query`` holds for, itself left out.

    Rows with a null id, or whose vector is null, empty, zero or holds a null or non-finite
    component, take no part. Only vectors of one length compare. Repeated rows count once; of different
    vectors under one id the smallest (as an array) counts. Fewer candidates give fewer rows,
    ties go to the smaller id, other columns, whatever their names, play no part, an empty table gives none.
    """
    kept = rows.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    kept = kept.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    kept = materialise(kept.groupBy("vec_id").agg(F.min("vector").alias("vector"), F.max("asks").alias("asks")), "usable-vectors")
    return search_shards(build_shards(kept.select("vec_id", "vector"), top, shard_rows), kept.filter("asks").select("vec_id", "vector"), top)


def op3_graph_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(QUERY_EVERY)) == 0)
