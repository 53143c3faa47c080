import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from demandloom.llm import search as S


def terms(text):
    return [t.translate({k: k + 32 for k in range(65, 91)}) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute_force(items, docs, top=10):
    """(item, rank, doc_id, score) in plain loops over all pairs."""
    found = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    found = [(d, c) for d, c in found if c]
    n_docs, length = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    wanted, out = defaultdict(set), []
    for item, text in items:
        wanted[item] |= set(terms(text))
    for item, mine in wanted.items():
        scores = []
        for doc_id, c in found:
            m = 10 + 90 * sum(c.values()) * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in mine if t in c)
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0))
        out += [(item, k + 1, d if known else None, -s) for k, (s, known, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def ranked(out):
    return sorted((tuple(r) for r in out.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    words = [f"w{k}" for k in range(60)] + ["Über", "naïve", "THE", "the", "x-y", "3.5"]
    docs = [(k, " ".join(words[(k * j * j + j) % len(words)] for j in range(1 + k % 40)) + " common") for k in range(150)]
    docs += [(7, docs[7][1]), (None, docs[8][1]), (500, None), (501, ""), (502, "w1 " * 5000), (503, "?!")]
    items = [(k, " ".join(words[(k + j * 7) % len(words)] for j in range(9)) + " common COMMON") for k in range(12)] + [(3, "w59 extra"), (None, "w1 w2"), (90, None), (91, "unheard"), (92, "common")]
    return items, docs


def frames(spark, rows):
    items, docs = rows
    clash = {c: F.lit("own") for c in ("term", "row", "ID", "n", "tf", "bucket", "rank", "score", "w")}
    return spark.createDataFrame(items, "item_id long, text string").withColumns(clash), spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash)


def test_ranks_are_the_brute_force_ones(spark, rows):
    items, docs = frames(spark, rows)
    assert ranked(S.rank_documents(items, docs.repartition(6))) == brute_force(*rows)
    assert ranked(S.rank_documents(items, docs, top=3)) == brute_force(*rows, top=3)


def test_items_in_blocks_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_ROWS", 40)
    assert ranked(S.rank_documents(*frames(spark, rows))) == brute_force(*rows)


def test_query_over_tables(spark, rows, tmp_path):
    for name, frame in zip(("benchmark", "documents"), frames(spark, rows), strict=True):
        frame.select(*frame.columns[:2]).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert ranked(S.op13_ranked_search(spark, str(tmp_path))) == brute_force(*rows)


def test_empty_tables(spark, rows):
    items, docs = frames(spark, rows)
    assert S.rank_documents(items.limit(0), docs).count() == 0
    assert S.rank_documents(items, docs.limit(0)).count() == 0


def test_matches_are_summed_without_a_shuffle_of_their_own(spark, rows):
    plan = S.rank_documents(*frames(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(row") == 1 and "hashpartitioning(item_id" in plan and "hashpartitioning(item_id#0L, row" not in plan
