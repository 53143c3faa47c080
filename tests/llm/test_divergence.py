import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from demandloom.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string"


def brute_force(rows, min_docs=3, top=200):
    """The audit of rows (text, lang, source) in plain loops, every source against every kept term."""
    docs = [(lang or "", source or "", [t.translate({k: k + 32 for k in range(65, 91)}) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for text, lang, source in rows]
    df, n, groups = defaultdict(Counter), defaultdict(Counter), {}
    for lang, source, terms in docs:
        df[lang].update(set(terms))
        n[lang, source].update(terms)
        groups[lang, source] = True
    out = []
    for lang, source in groups:
        kept = sorted(t for t, d in df[lang].items() if d >= min_docs)
        mine = [g for g in groups if g[0] == lang]
        whole = Counter({t: sum(n[g][t] for g in mine) for t in kept})

        def share(count, total, kinds=len(kept)):
            return 1 + 1_000_000_000 * (count + 1) // (total + kinds)

        totals = {g: sum(n[g][t] for t in kept) for g in mine}
        p = {g: [share(n[g][t], totals[g]) for t in kept] for g in mine}
        q = [share(whole[t], sum(whole.values())) for t in kept]
        pairs = [(g[1], sum((a - b) ** 2 // b for a, b in zip(p[lang, source], p[g], strict=True))) for g in mine if g[1] != source]
        terms = [(t, (a - b) ** 2 // b) for t, a, b in zip(kept, p[lang, source], q, strict=True) if n[lang, source][t] and a > b]
        for part, found in (("pair", pairs), ("term", terms)):
            ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked) if part == "pair" or k < top]
    return sorted(out)


def audited(docs, **how):
    return sorted(tuple(r) for r in D.audit(docs, **how).select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture(scope="module")
def rows():
    words = "the The THE über naïve co-op x1y a.b und ab abc".split()
    made = [(" ".join(words[(k * j) % len(words)] for j in range(1, 3 + k % 9)), ("en", "de", None, "")[k % 4], (f"s{k % 5}", None)[k % 7 == 0]) for k in range(120)]
    return [*made, *made[:3], (None, "en", "s9"), ("", "fr", "only"), ("one two", "es", "a"), ("two three", "es", "b"), ("word " * 3000 + "ab", "en", "s1"), ("ß ß ß", "de", "s1")]


def test_audit_is_the_brute_force_one(spark, rows):
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], SCHEMA).withColumns({c: F.lit(1) for c in ("term", "n", "Item", "value", "p0", "rank")})
    assert audited(docs.repartition(5)) == brute_force(rows)
    assert audited(docs, min_docs=1, top_terms=2) == brute_force(rows, 1, 2)


def test_small_blocks_give_the_same(spark, rows, monkeypatch):
    for name, value in (("BLOCK_SUMS", 5), ("BLOCK_PAIRS", 3), ("HELD_PAIRS", 2)):
        monkeypatch.setattr(D, name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert audited(spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], SCHEMA)) == brute_force(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_query_over_a_table(spark, tmp_path, rows):
    spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in D.op11_source_divergence(spark, str(tmp_path)).collect())
    assert got == brute_force(rows)


def test_shares_beyond_64_bits(spark):
    big = 20_000_000_000
    got = spark.range(1).select(D.share(F.lit(big), F.lit(2 * big), F.lit(5)).alias("p")).first().p
    assert got == 1 + 1_000_000_000 * (big + 1) // (2 * big + 5)


def test_empty_table(spark):
    assert D.audit(spark.createDataFrame([], SCHEMA)).count() == 0
