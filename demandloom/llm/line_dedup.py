"""Cross-site line removal by distinct-site spread, in DataFrame functions only.

HyperLogLog sketches of the sites that show a line merge by aggregation. Lines whose
estimate lies clearly above the threshold are spread, those clearly below are not, and those
near it get an exact distinct count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm.common import discard, materialise, maybe_broadcast, once, packed, table

MIN_SITES = 8
#: Lines of fewer words than MIN_WORDS are left alone, and so are documents of which spread lines make up over MAX_PART; neither is on by default.
MIN_WORDS, MAX_PART = 1, 1.0
LG_K = 12
#: Estimates within this share of the threshold are counted exactly (a sketch of 2^12 entries errs by 1.6 %).
MARGIN = 0.25
BROADCAST_ROWS = 500_000
SALTS = 16


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _trimmed(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\r", "  "))


def _bare_length(text: Column) -> Column:
    """Characters without the spaces and line breaks that lines are compared without."""
    return F.char_length(F.translate(text, "\n\t\r ", ""))


def _without(lines: Column, gone: Column) -> Column:
    """``lines`` without those at the sorted places ``gone``: the stretches between them, so the work is linear in the lines."""

    def stretch(all_lines: Column, k: Column) -> Column:
        start = F.when(k == 0, 1).otherwise(F.get(gone, k - 1) + 2)
        end = F.when(k == F.size(gone), F.size(all_lines)).otherwise(F.get(gone, k))
        return F.slice(all_lines, start, end - start + 1)

    return once(lines, lambda all_lines: F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), lambda k: stretch(all_lines, k))))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN, lg_k: int = LG_K) -> DataFrame:
    """Keys (h1, h2) of lines shown by at least ``min_sites`` distinct sites, of rows (h1, h2, site).

    A null site doesn't count as a site. An empty table gives no line.
    """
    low, high = min_sites * (1 - margin), min_sites * (1 + margin)
    by_site = lines.filter(F.col("site").isNotNull())
    sketches = by_site.groupBy("h1", "h2").agg(F.min("site").alias("_a"), F.max("site").alias("_z"), F.hll_sketch_agg("site", F.lit(lg_k)).alias("_sketch"))
    several = sketches.filter("_a < _z") if min_sites > 1 else sketches
    estimated = materialise(several.select("h1", "h2", F.hll_sketch_estimate("_sketch").alias("sites")).filter(F.col("sites") >= low), "line-spread")
    near = estimated.filter(F.col("sites") <= high).select("h1", "h2")
    exact = by_site.join(maybe_broadcast(near, near.count(), BROADCAST_ROWS), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.count_distinct("site").alias("n")).filter(F.col("n") >= min_sites)
    return estimated.filter(F.col("sites") > high).select("h1", "h2").unionByName(exact.select("h1", "h2"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, max_part: float = MAX_PART) -> DataFrame:
    """``docs`` without lines that at least ``min_sites`` sites show, and n_lines, n_removed.

    A line is compared without tabs, carriage returns and spaces around it; empty ones are never
    removed. A spread line goes from every document, also from one that then has nothing left (its
    text is ""). On demand lines of fewer than ``min_words`` words stay, and so do documents in which
    spread lines make up over ``max_part`` of the characters that are no spaces.

    A null text stays null with n_lines 0; empty texts have one empty line; a text without line
    breaks is one line; very long texts are taken whole; repeated rows are treated alike, as rows are told
    apart by id and text; columns called n_lines or n_removed are replaced, all others, whatever their
    names, are kept; an empty table gives an empty one.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    docs = docs.select(*(F.col(f"`{c}`") for c in kept))
    place = [F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.xxhash64(text_col).alias("text_hash")]
    exploded = (
        docs.select(*place, F.col(site_col).cast("string").alias("site"), _bare_length(F.col(text_col)).alias("chars"), _lines(F.col(text_col)).alias("split"))
        .select("id", "text_hash", "site", "chars", F.posexplode("split").alias("line", "raw"))
        .withColumn("compared", _trimmed(F.col("raw")))
        .filter(F.col("compared") != "")
    )
    if min_words > 1:
        exploded = exploded.filter(F.col("compared").rlike(f"(?:[^ ]+ +){{{min_words - 1}}}[^ ]"))
    lines = materialise(exploded.select("id", "text_hash", "site", "line", "chars", _bare_length(F.col("raw")).alias("length"), F.xxhash64("compared").alias("h1"), F.xxhash64(F.lit(1), "compared").alias("h2")), "lines")
    spread = materialise(spread_lines(lines.select("h1", "h2", "site"), min_sites), "spread-lines")
    found = spread.count()
    if found <= BROADCAST_ROWS:
        hit = lines.join(F.broadcast(spread), ["h1", "h2"], "left_semi")
    else:
        salted = spread.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hit = lines.withColumn("salt", F.pmod(F.xxhash64("id", "line"), F.lit(SALTS)).cast("int")).join(salted, ["h1", "h2", "salt"], "left_semi")
    # a repeated row gives the same (line, length) pairs, which the set holds once
    gone = hit.groupBy("id", "text_hash", "chars").agg(F.collect_set(F.struct("line", "length")).alias("gone"))
    if max_part < 1:
        gone = gone.filter(F.aggregate("gone", F.lit(0).cast("long"), lambda a, x: a + x["length"]) <= max_part * F.col("chars"))
    gone = materialise(gone.select("id", "text_hash", F.array_sort("gone.line").alias("gone")), "lines-removed")
    discard(lines, spread)
    keyed = packed(docs).select("row", F.coalesce(F.col("row").getField(id_col).cast("string"), F.lit("null")).alias("id"), F.xxhash64(F.col("row").getField(text_col)).alias("text_hash"))
    joined = keyed.join(gone.hint("merge"), ["id", "text_hash"], "left")  # both sides grow with the corpus
    text = F.col("row").getField(text_col)
    left = F.array_join(_without(_lines(text), F.col("gone")), "\n")
    new = F.when(F.col("gone").isNull(), text).otherwise(left)
    return joined.select(
        *((new if c == text_col else F.col("row").getField(c)).alias(c) for c in kept),
        F.when(text.isNull(), 0).otherwise(F.size(_lines(text))).alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n_lines").cast("long"), F.col("n_removed").cast("long"), "text")


OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, source, i - 1 AS line, l[i] AS raw, trim(translate(l[i], chr(9) || chr(13), '  '), ' ') AS t
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
spread AS (SELECT t FROM lines WHERE t <> '' GROUP BY t HAVING count(DISTINCT source) >= 8),
hit AS (SELECT l.doc_id, l.line FROM lines l SEMI JOIN spread s ON l.t = s.t),
gone AS (SELECT doc_id, count(*) AS n_removed FROM hit GROUP BY doc_id),
kept AS (SELECT l.doc_id, string_agg(l.raw, chr(10) ORDER BY l.line) AS text
  FROM lines l SEMI JOIN gone g ON l.doc_id = g.doc_id ANTI JOIN hit h ON l.doc_id = h.doc_id AND l.line = h.line GROUP BY l.doc_id)
SELECT d.doc_id, CAST(CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS BIGINT) AS n_lines,
       CAST(coalesce(g.n_removed, 0) AS BIGINT) AS n_removed, CASE WHEN g.doc_id IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN gone g ON d.doc_id = g.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
