"""Near-duplicate classes against brute force over all pairs of real documents."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.llm import bagminhash as bag
from demandloom.llm.components import connected_components
from demandloom.llm.near_dedup import keep_one, near_duplicates

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = text.lower().split()
    if not words:
        return Counter()
    return Counter([tuple(words[k : k + 5]) for k in range(len(words) - 4)] or [tuple(words)])


def brute_force(rows):
    bags = {i: shingles(t) for i, t in rows if t is not None}
    text, root = dict(rows), {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(root)
    for a in ids:
        for b in ids:
            if a < b and text[a] is not None and text[b] is not None:
                both, either = sum((bags[a] & bags[b]).values()), sum((bags[a] | bags[b]).values())
                if text[a] == text[b] or either and both / either >= 0.8:
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def edited(words, rng, n):
    out = list(words)
    for k in rng.choice(len(out), n, replace=False):
        out[k] = f"new{rng.integers(1e6)}"
    return " ".join(out)


def test_classes_match_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rng = np.random.default_rng(1)
    base = [f"w{x}" for x in rng.integers(0, 10_000, 300)]
    # copies within 0.8 of their base, many of them not of each other, and a repetitive bag
    rows += [(10_000 + k, edited(base, rng, n)) for k, n in enumerate([0, 0, 3, 5, 5, 6, 6, 7, 9, 12, 30])]
    rows += [(20_000, "a b c d e f " * 40), (20_001, "a b c d e f " * 44), (20_002, "a b c d e f " * 90)]
    rows += [(30_000, ""), (30_001, ""), (30_002, None), (30_003, None), (30_004, "one two"), (30_005, "One  two"), (30_006, "   ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    assert got == brute_force(rows)
    kept = [r.doc_id for r in keep_one(docs).collect()]
    assert sorted(kept) == sorted(set(got.values()))


def test_star_of_copies_that_are_not_alike_among_themselves(spark):
    rng = np.random.default_rng(2)
    base = [f"w{x}" for x in rng.integers(0, 10_000, 400)]
    rows = [(k, edited(base, rng, 9)) for k in range(60)] + [(99, " ".join(base))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.class_id for r in near_duplicates(docs).collect()} == set(brute_force(rows).values())


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "x y z a b c"), (1, "x y z a b c"), (1, "x y z a b c"), (None, None), (2, None)], "doc_id long, text string").withColumns({"class_id_": F.lit(1), "KEY": F.lit("k")})
    got = near_duplicates(docs)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.class_id) for r in got.filter("text is not null").collect()) == [(False, 1, 1), (False, 1, 1), (True, 0, 1)]
    assert keep_one(docs).filter("text is not null").count() == 1
    assert keep_one(docs).columns == docs.columns
    assert near_duplicates(docs.limit(0)).count() == 0
    # classes without any id stay apart, and a column named class_id is left as it is
    unnamed = spark.createDataFrame([(None, "p q r s t u", 5), (None, "p q r s t u", 5), (None, "v w x y z a", 6), (None, "v w x y z a", 6)], "doc_id long, text string, class_id int")
    assert sorted(r.class_id for r in keep_one(unnamed).collect()) == [5, 6]


@pytest.mark.parametrize("weights", [((1, 1), (1, 2)), ((3, 5), (7, 4)), ((9, 1), (2, 8))])
def test_signatures_estimate_weighted_jaccard(weights):
    rng = np.random.default_rng(3)
    a, b = (np.sort(np.concatenate([np.repeat(np.arange(k * 1000, k * 1000 + 40, dtype=np.uint64), w) for k, w in enumerate(ws)])) for ws in zip(*weights, strict=True))
    a, b = np.sort(bag.mix(a)), np.sort(bag.mix(b))
    true = bag.similarity(a, b)
    s = bag.signatures([a, b], 20_000)
    assert abs((s[0] == s[1]).mean() - true) < 4 * (true * (1 - true) / 20_000) ** 0.5 + 1e-9
    assert rng is not None


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}
