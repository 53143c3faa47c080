"""Divergence of sources by sorted runs: which sources of a language use its terms differently, and where.

A map task sums its documents' terms by (language, term, source) and sends each sum once. After an exchange by
(language, term) and a sort by (language, term, source, document), a scan turns runs into document frequency and
counts. A second sort and scan over the terms that are kept adds up, run by run, what each pair of sources
owes to the terms that both use. What pairs owe to terms that one or none of them uses follows from how many
terms of a source have which share, so no run is widened to the sources that lack its term.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm.common import materialise, maybe_broadcast, slices, table
from demandloom.llm.terms import byte_table, term_counts

MIN_DOCS, TOP_TERMS, SCALE = 3, 200, 1_000_000_000
#: Sums that a map task holds before it sends them.
BLOCK_SUMS = 300_000
#: Pairs of sources that a scan works on at once, and sums of pairs that it holds before it sends them.
BLOCK_PAIRS, HELD_PAIRS = 1 << 20, 1 << 20
BROADCAST_ROWS = 200_000
#: A sum is documents << DOCS_BIT | occurrences, in one integer.
DOCS_BIT = 40


def term_sums(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Rows (lang, term, source, document, docs, n): of a block of documents, those with the term and its occurrences.

    ``document`` numbers the block's first document. A block ends when it has ``BLOCK_SUMS`` sums, so a
    frequent term leaves a task a few times and not once a document, and what a task holds is bounded.
    Nulls count as empty texts.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, task = byte_table(digits=False), TaskContext.get().partitionId() << 33
        held, size, first, seen, one = defaultdict(dict), 0, 0, 0, 1 << DOCS_BIT

        def sent() -> Iterator[pa.RecordBatch]:
            for (lang, source), found in held.items():
                both = np.fromiter(found.values(), np.int64, len(found))
                same = lambda value, kind: pa.repeat(pa.scalar(value, kind), len(found))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [same(lang, pa.string()), pa.array(list(found), pa.binary()).cast(pa.string()), same(source, pa.string()), same(task + first, pa.int64()), pa.array(both >> DOCS_BIT), pa.array(both & ((1 << DOCS_BIT) - 1))],
                    names=["lang", "term", "source", "document", "docs", "n"],
                )

        for batch in slices(batches, "text"):
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text"), strict=True):
                found = held[lang, source]
                before = len(found)
                for term, n in term_counts(text.as_py(), letters).items():
                    found[term] = found.get(term, 0) + one + n
                size += len(found) - before
                seen += 1
                if size >= BLOCK_SUMS:
                    yield from sent()
                    held.clear()
                    size, first = 0, seen
        yield from sent()

    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(sums, "lang string, term string, source string, document long, docs long, n long")


def _changes(*columns: pa.Array) -> np.ndarray:
    """Where sorted rows differ from the row before, the first row included."""
    n = len(columns[0])
    out = np.ones(n, bool)
    if n > 1:
        out[1:] = np.logical_or.reduce([pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False) for c in columns])
    return np.flatnonzero(out)


def _whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str], shorten=lambda rows: rows) -> Iterator[pa.RecordBatch]:
    """Sorted rows in batches that never part a run of equal ``keys``; ``shorten`` makes the rows so far shorter."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.concat_batches([rest, batch.cast(rest.schema)])
        batch = shorten(batch)
        last = int(_changes(*(batch.column(k) for k in keys))[-1])
        if last:
            yield batch.slice(0, last)
        rest = batch.slice(last)
    if rest is not None:
        yield rest


def term_runs(sums: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows (lang, term, source, n, lang_n, head) of the terms in at least ``min_docs`` documents of their language.

    ``head`` is 1 in the first row of a term and 0 in its others. Rows are dealt out by (lang, term), sorted by (lang, term, source, document) and scanned once. The scan holds one
    row for each source of one term and no more.
    """
    names = ["lang", "term", "source", "docs", "n"]

    def by_source(rows: pa.RecordBatch) -> pa.RecordBatch:
        at = _changes(rows.column("lang"), rows.column("term"), rows.column("source"))
        added = [pa.array(np.add.reduceat(rows.column(c).to_numpy(), at)) for c in ("docs", "n")]
        return pa.RecordBatch.from_arrays([*(rows.column(c).take(pa.array(at)) for c in names[:3]), *added], names=names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in _whole_runs((b.select(names) for b in batches), ["lang", "term"], by_source):
            at = _changes(runs.column("lang"), runs.column("term"))
            sizes = np.diff([*at, runs.num_rows])
            docs, n = (np.add.reduceat(runs.column(c).to_numpy(), at) for c in ("docs", "n"))
            keep = pa.array(np.repeat(docs >= min_docs, sizes))
            head = np.zeros(runs.num_rows, np.int32)
            head[at] = 1
            every = [*(runs.column(c) for c in ("lang", "term", "source", "n")), pa.array(np.repeat(n, sizes)), pa.array(head)]
            yield pa.RecordBatch.from_arrays(every, names=["lang", "term", "source", "n", "lang_n", "head"]).filter(keep)

    ordered = sums.repartition("lang", "term").sortWithinPartitions("lang", "term", "source", "document")
    return ordered.mapInArrow(scan, "lang string, term string, source string, n long, lang_n long, head int")


def share(n: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kinds)), exact also where the product exceeds 64 bits."""
    product = (n + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return (F.call_function("div", product, (total + kinds).cast("decimal(20,0)")) + 1).cast("long")


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def pair_runs(shares: DataFrame) -> DataFrame:
    """Partial sums (lang, source, item, value) over the terms that both sources have, of rows (lang, term, source, p, p0).

    A term adds gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0) to an ordered pair, p0 and q0 being the shares of
    a term that the source lacks. The scan holds one term's sources; there are no more of them than the square root
    of the rows that the result has.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[tuple[str, str], int] = {}
        keys, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        f = lambda p, q: (p - q) * (p - q) // q

        def added(more_keys: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            both, values = np.concatenate([keys, more_keys]), np.concatenate([sums, more])
            order = np.argsort(both, kind="stable")
            both, values = both[order], values[order]
            at = np.flatnonzero(np.diff(both, prepend=-1))
            return both[at], (np.add.reduceat(values, at) if len(at) else values)

        def sent() -> pa.RecordBatch:
            by_number = list(numbers)
            langs, sources = pa.array([k[0] for k in by_number], pa.string()), pa.array([k[1] for k in by_number], pa.string())
            a, b = pa.array(keys >> 31), pa.array(keys & ((1 << 31) - 1))
            return pa.RecordBatch.from_arrays([langs.take(a), sources.take(a), sources.take(b), pa.array(sums)], names=["lang", "source", "item", "value"])

        for runs in _whole_runs(batches, ["lang", "term"]):
            at = _changes(runs.column("lang"), runs.column("term"))
            sizes = np.diff([*at, runs.num_rows])
            number = np.array([numbers.setdefault(k, len(numbers)) for k in zip(runs.column("lang").to_pylist(), runs.column("source").to_pylist(), strict=True)], np.int64)
            p, p0 = runs.column("p").to_numpy(), runs.column("p0").to_numpy()
            first, many = np.repeat(at, sizes), np.repeat(sizes, sizes)
            ends = np.cumsum(many)
            low = 0
            while low < len(ends):  # so many rows that their pairs fill a block, one row at least
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + BLOCK_PAIRS, "right")))
                a = np.repeat(np.arange(low, high), many[low:high])
                b = np.repeat(first[low:high] - (ends[low:high] - many[low:high]), many[low:high]) + np.arange(ends[low] - many[low], ends[high - 1])
                other = a != b
                a, b = a[other], b[other]
                if len(a):
                    keys, sums = added(number[a] << 31 | number[b], f(p[a], p[b]) - f(p[a], p0[b]) - f(p0[a], p[b]) + f(p0[a], p0[b]))
                low = high
            if len(keys) > HELD_PAIRS:
                yield sent()
                keys, sums = keys[:0], sums[:0]
                numbers.clear()
        yield sent()

    ordered = shares.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return ordered.select("lang", "term", "source", "p", "p0").mapInArrow(scan, "lang string, source string, item string, value long")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Divergence of each (lang, source) from the other sources of its language, and its most divergent terms.

    Rows (lang, source, part, item, value, rank). Part "pair" has every other source of the language; part "term"
    has up to ``top_terms`` terms that the source uses more than its language does. Terms are counted over whole texts
    of all rows; each row is a document of its own, also a repeated one. Null texts, languages and sources
    count as empty; an empty text makes its source occur without terms; very long texts are counted in
    parts; ties go by the item's UTF-8 bytes; other columns, whatever their names, play no part; an empty table gives
    an empty result. Values of a language without kept terms are 0.
    """
    runs = materialise(term_runs(term_sums(docs, text_col, lang_col, source_col), min_docs), "term-runs")
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    occurring = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source")).distinct()
    totals = runs.groupBy("lang", "source").agg(F.sum("n").alias("n_source"))
    langs = runs.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.sum("head").alias("kinds"))
    zero = F.lit(0).cast("long")
    known = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("n_source", "n_lang", "kinds")))
    groups = materialise(known.withColumn("p0", F.when(F.col("kinds") > 0, share(zero, F.col("n_source"), F.col("kinds"))).otherwise(zero)), "term-sources")
    n_groups = groups.count()

    met = runs.join(maybe_broadcast(groups, n_groups, BROADCAST_ROWS), ["lang", "source"])
    shares = met.select("lang", "term", "source", "p0", share(F.col("n"), F.col("n_source"), F.col("kinds")).alias("p"), share(F.col("lang_n"), F.col("n_lang"), F.col("kinds")).alias("q"))
    terms = shares.filter(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))

    # terms that only one of a pair has: by how many terms of a source have a share
    some = shares.groupBy("lang", "source", "p0", "p").agg(F.count("*").alias("many"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), "kinds")
    crossed = some.join(maybe_broadcast(others, n_groups, BROADCAST_ROWS), "lang").filter(F.col("source") != F.col("item"))
    p, p0, q0 = F.col("p"), F.col("p0"), F.col("q0")
    one_sided = crossed.groupBy("lang", "source", "item").agg(F.sum(F.col("many") * (gap(p, q0) - gap(p0, q0))).alias("value"), F.sum(F.col("many") * (gap(q0, p) - gap(q0, p0))).alias("back"))
    one_sided = one_sided.select("lang", F.explode(F.array(F.struct("source", "item", "value"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")))).alias("x")).select("lang", "x.*")
    # all kept terms as if neither had any
    neither = groups.select("lang", "source", "p0").join(maybe_broadcast(others, n_groups, BROADCAST_ROWS), "lang").filter(F.col("source") != F.col("item"))
    neither = neither.select("lang", "source", "item", F.when(F.col("kinds") > 0, F.col("kinds") * gap(p0, F.greatest(q0, F.lit(1).cast("long")))).otherwise(zero).alias("value"))
    pairs = neither.unionByName(one_sided).unionByName(pair_runs(shares)).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))).alias("rank")
    return pairs.select("*", rank).unionByName(terms.select("*", rank).filter(F.col("rank") <= top_terms))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
occurring AS (SELECT DISTINCT lang, source FROM d),
words AS (SELECT lang, source, r, unnest(t) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
langs AS (SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang),
sources AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
shares AS (SELECT o.lang, o.source, k.term, coalesce(c.n, 0) AS n,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // CAST(coalesce(s.total, 0) + l.v AS HUGEINT) AS BIGINT) AS p,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * (k.n + 1)) // CAST(l.total + l.v AS HUGEINT) AS BIGINT) AS q
  FROM occurring o JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = o.lang AND c.source = o.source AND c.term = k.term LEFT JOIN sources s ON s.lang = o.lang AND s.source = o.source),
summed AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM occurring a JOIN occurring b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 200
"""
