"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only.

Each source has a weight that changes over training time. Its integral is the source's
cumulative word demand; a document stands at a place in its source's word stream, and
inverting the demand there gives the training position at which the document is due.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm.common import materialise, packed, running, shuffle_partitions, table

#: Words are runs of anything but the six ASCII white-space characters.
WORD = "[^\\x20\\x09-\\x0D]+"
SHARE, CAP, WEIGHTS = 1.5, 2.0, (5, 2, 1)
#: Knots (training time, relative weight) of each weight class: early, even and late sources.
SCHEDULES = (((0.0, 1.4), (1.0, 0.6)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.4), (0.5, 1.2), (1.0, 1.2)))


def inverse_demand(part: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Training time in [0, 1] at which the share ``part`` of a source's demand is reached.

    The weight is linear between knots and above 0; its integral over [0, 1] is scaled to 1, so each
    stretch is inverted by solving a quadratic.
    """
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)]
    want, below, out = part * sum(areas), 0.0, None
    for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
        slope = (w1 - w0) / (t1 - t0)
        x = want - F.lit(below)
        at = F.lit(t0) + 2 * x / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * x, F.lit(0.0))))
        below += area
        out = F.when(want <= F.lit(below), at) if out is None else out.when(want <= F.lit(below), at)
    return F.least(F.greatest(out.otherwise(F.lit(knots[-1][0])), F.lit(0.0)), F.lit(1.0))


def _ranged(df: DataFrame, label: str, *order: Column) -> DataFrame:
    """``df`` with bucket: its number among ranges of rows in ``order``, written so that it stays the same."""
    return materialise(df.repartitionByRange(shuffle_partitions(df.sparkSession), *order).withColumn("bucket", F.spark_partition_id()), label)


def source_targets(sources: DataFrame, share: float = SHARE, cap: float = CAP, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Add class and target to rows (source, source_size): one row per source.

    Sources by code point, null last, take the weights in turn. Targets share ``share`` of all
    sizes by weight; none passes ``cap`` times its source's size, and what one leaves goes to
    the others by weight. In ascending order of capped size per weight the capped sources
    come first, so running sums find the level without iterating. Ranks and running sums go over
    ranges of sources, so that sources may be as many as hosts are.
    """
    none, most = F.col("source").isNull(), cap * F.col("source_size")
    by_name = _ranged(sources, "sources", none, F.col("source"))
    ranked = running(by_name.withColumn("none", none), [], "bucket", ["none", "source"], F.lit(1).cast("long"), "nth").drop("bucket")
    named = ranked.withColumn("class", F.pmod("nth", F.lit(len(weights)))).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("class") + 1).cast("int")).cast("double")).withColumn("room", most / F.col("weight"))
    by_room = _ranged(named, "sources-by-room", F.col("room"), F.col("none"), F.col("source"))
    order = ["room", "none", "source"]
    filled = running(running(by_room, [], "bucket", order, most, "full_before"), [], "bucket", order, F.col("weight"), "weight_before", before="weight_all")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = (share * total - F.col("full_before")) / (F.col("weight_all") - F.col("weight_before"))
    capped = materialise(filled.withColumn("full", most <= level * F.col("weight")), "sources-capped")
    full, free = capped.agg(F.coalesce(F.sum(F.when(F.col("full"), most)), F.lit(0.0)), F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0.0))).first()
    return capped.select("source", "source_size", "class", F.when(F.col("full"), most).otherwise(F.lit(share * total - full) * F.col("weight") / F.lit(free or 1.0)).alias("target"))


def document_key(id_: Column, text: Column) -> Column:
    """MD5 of a row's id and text: the order of documents within a source."""
    return F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = SHARE, cap: float = CAP, weights: Sequence[int] = WEIGHTS, schedules: Sequence = SCHEDULES) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, position, source and key.

    Within a source documents stand in the order of key, an MD5 of id and text. The source's
    target runs over that order, again from its start for a second pass. taken counts the
    words below the target's end, so that a source's sum is its rounded target; copies
    counts the passes in which over half of the document lies below it. position is the
    training time at which its first words are due (null if it isn't taken).

    A null text has size 0 and a null source is a source of its own, sorted last; repeated
    rows each count; very long texts count whole; other columns of ``docs``, whatever their names, play no part; an empty
    table gives an empty one. No document passes ``cap`` times its size.
    """
    passes = ceil(cap)
    key = document_key(F.col(id_col), F.col(text_col))
    sized = materialise(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key")), "mix-sizes"
    )
    digits = next(d for d in range(1, 9) if sized.count() <= 1_000 * 16**d)
    named = sized.withColumns({"_none": F.col("source").isNull(), "_name": F.coalesce("source", F.lit("")), "_b": F.substring("key", 1, digits)})
    at = running(named, ["_none", "_name"], "_b", ["key", "doc_id", "size"], F.col("size"), "_start")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share, cap, weights)
    targets = targets.select(F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_name"), "source_size", "class", "target")
    joined = at.join(targets, ["_none", "_name"])
    end = F.round("target").cast("long")
    begins = [F.col("_start") + p * F.col("source_size") for p in range(passes)]
    taken = sum((F.least(F.greatest(end - b, F.lit(0)), F.col("size")) for b in begins), F.lit(0))
    copies = sum(((2 * b + F.col("size")) < 2 * end).cast("int") for b in begins)
    part = F.when(F.col("target") > 0, F.col("_start") / F.col("target"))
    due = [inverse_demand(part, s) for s in schedules]
    position = due[-1]
    for k, x in enumerate(due[:-1]):
        position = F.when(F.pmod(F.col("class"), F.lit(len(due))) == k, x).otherwise(position)
    return joined.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), copies.alias("copies"), F.when(F.col("_start") < end, position).alias("position"), "source", "key")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as often as its copies, range-sorted by training position.

    Columns are those of ``docs``, whatever their names. Repeats of a document stand next to each
    other. Null texts and null sources take part as ``mix`` says; repeated rows share the copies of
    all of them, which differ by one at most; very long texts stay whole; an empty table gives an empty one.
    """
    id_col, text_col, source_col = (options.get(k, v) for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source")))
    named = lambda key, source: F.md5(F.concat(key, F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source.cast("string")))).cast("binary"))
    # a repeated row has its copies summed up on its id, text and source, so that the join meets each kind of row once
    plan = mix(docs, **options).groupBy(named(F.col("key"), F.col("source")).alias("key")).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"), F.min("position").alias("position"))
    row = packed(docs).select("row", named(document_key(F.col("row").getField(id_col), F.col("row").getField(text_col)), F.col("row").getField(source_col)).alias("key"))
    joined = row.join(plan.filter("copies > 0"), "key")
    w = Window.partitionBy("key").orderBy(F.xxhash64("row"))  # as the join is: no other exchange
    nth = F.row_number().over(w) - 1
    each = (F.floor(F.col("copies") / F.col("rows")) + (nth < F.pmod("copies", "rows")).cast("long")).cast("int")
    counted = joined.withColumn("each", each).filter("each > 0")
    placed = counted.select("row", "position", "key", F.explode(F.sequence(F.lit(1), F.col("each"))).alias("copy")).orderBy("position", "key")
    return placed.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def op6_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents")).orderBy("position", "key")
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies", F.round("position", 9).alias("position"))


OP6_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat(coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', md5(coalesce(text, '')))) AS key
  FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight FROM src),
total AS (SELECT CAST(sum(source_size) AS DOUBLE) * 1.5 AS t FROM src),
step(round, source, source_size, weight, is_full) AS (
  SELECT 0, source, source_size, weight, false FROM w
  UNION ALL
  SELECT round + 1, source, source_size, weight,
         is_full OR 2.0 * source_size <= weight * ((SELECT t FROM total) - coalesce(sum(CASE WHEN is_full THEN 2.0 * source_size END) OVER (), 0.0))
                                     / coalesce(sum(CASE WHEN NOT is_full THEN weight END) OVER (), 1.0)
  FROM step WHERE round < 64),
fin AS (SELECT source, source_size, weight, is_full FROM step WHERE round = 64),
tgt AS (SELECT source, source_size, weight, CASE WHEN is_full THEN CAST(2.0 * source_size AS DOUBLE) ELSE CAST(((SELECT t FROM total)
          - coalesce((SELECT sum(2.0 * source_size) FROM fin WHERE is_full), 0.0)) * weight / (SELECT sum(weight) FROM fin WHERE NOT is_full) AS DOUBLE) END AS target FROM fin),
placed AS (SELECT s.doc_id, s.size, t.source_size, t.target, t.weight, CAST(round(t.target) AS BIGINT) AS e,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM sized s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source),
-- demand from 0 to t is 1.4 t - 0.4 t^2 for early sources (weight 5), t for even ones (2), and for late ones (1)
-- 0.4 t + 0.8 t^2 up to t = 0.5, then 0.4 + 1.2 (t - 0.5), of 1.0 in all
due AS (SELECT *, CASE WHEN target > 0 THEN b / target END AS part FROM placed)
SELECT doc_id, size, source_size, target,
       CAST(least(greatest(e - b, 0), size) + least(greatest(e - b - source_size, 0), size) AS BIGINT) AS taken,
       CAST(CAST(2 * b + size < 2 * e AS INT) + CAST(2 * (b + source_size) + size < 2 * e AS INT) AS INT) AS copies,
       CASE WHEN b < e THEN round(least(greatest(CASE weight WHEN 5 THEN (1.4 - sqrt(greatest(1.96 - 1.6 * part, 0.0))) / 0.8 WHEN 2 THEN part
            ELSE CASE WHEN part <= 0.4 THEN (sqrt(0.16 + 3.2 * part) - 0.4) / 1.6 ELSE 0.5 + (part - 0.4) / 1.2 END END, 0.0), 1.0), 9) END AS position
FROM due
"""
