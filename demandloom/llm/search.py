"""Ranked lexical search of a stated set of items over all documents, on term-bucketed postings.

Postings of the items' terms are rows (term, document, length of the document, occurrences), written in folders by
bucket of the term and sorted by term in each; a term's postings are spread over slices, so a frequent
term is no task of its own. The postings of the empty term stand for the documents themselves. Item terms join the
postings, each match gets an integer score, scores are summed by item and document and a window ranks them. Before that
the postings are dealt out by document, so all matches of a document are summed where they arise: the matches, which are
many times the postings, are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm.common import materialise, maybe_broadcast, shuffle_partitions, slices, table
from demandloom.llm.terms import byte_table, term_counts

TOP = 10
#: Scores: weights in thousandths, saturation in billionths; of its length a document keeps LENGTH_PART per cent.
WEIGHT, SATURATION, LENGTH_PART, SLOPE = 1_000, 1_000_000_000, 90, 8
BUCKETS = 16
#: Terms and item terms that may be broadcast; of more item terms, blocks of whole items take turns.
BROADCAST_ROWS = 200_000
#: The term that every document with a term has, and its number.
ITSELF, ITSELF_ID = "", -1


def term_rows(docs: DataFrame, id_col: str, text_col: str, itself: bool) -> DataFrame:
    """Rows (row, id, n, term, tf) of each text: n terms in all, tf times this one; ``row`` numbers the rows of ``docs``.

    With ``itself`` each text that has a term also has the empty one, with tf 0. Null and empty texts give no row.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, at = byte_table(digits=True), TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text"):
            terms, tf, sizes, lengths = [], [], [], []
            for text in batch.column("text"):
                found = term_counts(text.as_py() or b"", letters)
                if found:
                    terms.extend(found)
                    tf.extend(found.values())
                    lengths.append(sum(found.values()))
                    if itself:
                        terms.append(ITSELF.encode())
                        tf.append(0)
                    sizes.append(len(found) + itself)
                else:
                    sizes.append(0)
                    lengths.append(0)
            repeated = np.repeat(np.arange(batch.num_rows), sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at + repeated), batch.column("id").take(pa.array(repeated)), pa.array(np.array(lengths, np.int64)[repeated]), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(tf, pa.int64())],
                names=["row", "id", "n", "term", "tf"],
            )
            at += batch.num_rows

    chosen = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    return chosen.mapInArrow(rows, "row long, id long, n long, term string, tf long")


def bucket(term_id: Column) -> Column:
    return F.pmod(F.xxhash64(term_id), F.lit(BUCKETS)).cast("int")


def write_postings(docs: DataFrame, vocabulary: DataFrame, n_terms: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (term_id, row, id, n, tf, bucket) of the terms (term, term_id) of ``vocabulary`` in all documents."""
    parts = shuffle_partitions(docs.sparkSession)
    found = term_rows(docs, id_col, text_col, itself=True).join(maybe_broadcast(vocabulary, n_terms, BROADCAST_ROWS), "term")
    spread = F.pmod(F.xxhash64("row"), F.lit(2 * -(-parts // BUCKETS))).alias("slice")
    keyed = found.select("term_id", "row", "id", "n", "tf", bucket(F.col("term_id")).alias("bucket"), spread)
    return materialise(keyed.repartition("bucket", "slice").sortWithinPartitions("bucket", "term_id").drop("slice"), "postings", by=["bucket"])


def rank_documents(items: DataFrame, docs: DataFrame, top: int = TOP, item_col: str = "item_id", item_text: str = "text", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``top`` highest-scoring documents of each item: item_id, rank, doc_id, score, by score and then by id.

    A term of an item counts once, however often the item has it; rows with one item id are one item. Only scores
    above 0 are returned, so terms that nearly all documents have, whose weight is 0, find nothing. Null texts
    have no terms; very long ones are counted whole, in parts; each row of ``docs`` is a document of its own, also a
    repeated one, and equal scores and ids are then ranked by row; null ids come first among equal scores; other columns,
    whatever their names, play no part; without items or documents the result is empty.
    """
    spark = docs.sparkSession
    wanted = materialise(term_rows(items, item_col, item_text, itself=False).select(F.col("id").alias("item_id"), "term").distinct(), "item-terms")
    kinds = wanted.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id())
    itself = spark.createDataFrame([(ITSELF, ITSELF_ID)], "term string, term_id long")
    vocabulary = materialise(kinds.unionByName(itself), "item-vocabulary")
    postings = write_postings(docs, vocabulary, vocabulary.count(), id_col, text_col)

    n_docs, length = postings.filter((F.col("bucket") == bucket(F.lit(ITSELF_ID).cast("long"))) & (F.col("term_id") == ITSELF_ID)).agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    rarity = F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(WEIGHT * F.log(rarity)).cast("long")
    rates = postings.filter(F.col("term_id") != ITSELF_ID).groupBy("term_id").agg(F.count("*").alias("df")).select("term_id", weight.alias("w")).filter("w > 0")
    weighted = materialise(wanted.join(vocabulary, "term").join(rates, "term_id").select("item_id", "term_id", "w"), "item-weights")
    blocks = max(1, -(-weighted.count() // BROADCAST_ROWS))

    div = lambda a, b: F.call_function("div", a, b)
    room = F.lit(100 - LENGTH_PART) + div(LENGTH_PART * F.col("n") * F.lit(n_docs), F.lit(max(length, 1)))
    by_doc = postings.filter(F.col("term_id") != ITSELF_ID).select("term_id", "row", "id", div(SATURATION * F.col("tf"), 1000 * F.col("tf") + SLOPE * room).alias("part")).repartition("row")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id", "row")
    ranked = []
    for block in range(blocks):
        mine = weighted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        matches = by_doc.join(maybe_broadcast(mine, 0 if blocks == 1 else mine.count(), 2 * BROADCAST_ROWS), "term_id")
        summed = matches.groupBy("item_id", "row").agg(F.sum(F.col("w") * F.col("part")).alias("score"), F.min("id").alias("doc_id")).filter("score > 0")
        ranked.append(summed.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score"))
    out = ranked[0]
    for more in ranked[1:]:
        out = out.unionByName(more)
    return out


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH lower_case AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
d AS (SELECT doc_id, r, t, len(t) AS n FROM lower_case WHERE len(t) > 0),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
postings AS (SELECT doc_id, r, n, term, count(*) AS tf FROM (SELECT doc_id, r, n, unnest(t) AS term FROM d) SEMI JOIN wanted USING (term) GROUP BY ALL),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM d),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * (SELECT docs FROM whole) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM postings GROUP BY term),
scored AS (SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // length)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN postings USING (term), whole GROUP BY item_id, doc_id, r),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST, r) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
