import numpy as np
from pyspark.sql import functions as F

from demandloom.llm.nearest import nearest, op3_graph_nearest


def brute_force(rows, every, top):
    out = {}
    for q, v in rows:
        if q % every == 0:
            scored = sorted((-float(np.dot(np.array(v, float), np.array(w, float))), i) for i, w in rows if i != q)
            out[q] = [i for _, i in scored[:top]]
    return out


def test_recall_on_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    want = brute_force(rows, 20, 20)
    got = {}
    for r in op3_graph_nearest(spark, "/root/testdata/sf0.01").orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score, r.rank))
    assert got.keys() == want.keys()
    vectors = dict(rows)
    for q, hits in got.items():
        assert [h[2] for h in hits] == list(range(1, 21))
        assert all(abs(s - np.dot(np.array(vectors[q], float), np.array(vectors[v], float))) < 1e-12 for v, s, _ in hits)
    assert np.mean([len({h[0] for h in got[q]} & set(want[q])) / 20 for q in want]) >= 0.95


def test_recall_over_several_shards(spark):
    """2,000 vectors in shards of 500: every shard is searched by a beam that holds a quarter of it; and in one shard, where it holds 6 %."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    asked = ids % 20 == 0
    scores = vectors[asked] @ vectors.T
    scores[np.arange(asked.sum()), np.nonzero(asked)[0]] = -np.inf
    want = {q: set(ids[np.lexsort([ids, -s])[:20]].tolist()) for q, s in zip(ids[asked].tolist(), scores, strict=True)}
    for size in (500, 9_000):
        got = {}
        for r in nearest(table, F.col("vec_id") % 20 == 0, shard_rows=size).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        assert got.keys() == want.keys() and np.mean([len(got[q] & want[q]) / 20 for q in want]) >= 0.95


def test_shards_ties_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(k, [float(x) for x in rng.normal(size=8) * (1 + k % 3)]) for k in range(300)]
    rows += [(k, [1.0] * 8) for k in range(300, 400)]  # one vector many times
    bad = [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (1060, [1.0, None] * 4), (1080, []), (None, [1.0] * 8), (1100, [float("inf")] * 8)]
    table = spark.createDataFrame(rows + rows[:5] + bad, "vec_id long, embedding array<double>").withColumn("Score", F.lit(1))
    got = {}
    for r in nearest(table, F.col("vec_id") % 20 == 0, top=5, shard_rows=100).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = brute_force(rows, 20, 5)
    assert got.keys() == want.keys()
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) > 0.97
    assert got[320][:5] == want[320][:5]


def test_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert nearest(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    two = nearest(spark.createDataFrame([(0, [1.0, 2.0]), (7, [3.0, 1.0]), (9, [1.0])], schema), F.col("vec_id") == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in two] == [(0, 1, 7, 5.0)]


def test_columns_with_clashing_names_play_no_part(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(size=8)]) for k in range(60)]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    clash = plain.withColumns({c: F.lit("own") for c in ("Vector", "asks", "shard", "node", "key", "query_id", "rank", "score", "row", "id", "hits", "block")})
    of = lambda df: sorted(map(tuple, nearest(df, F.col("vec_id") % 7 == 0, top=5).collect()))
    assert of(clash) == of(plain) and len(of(plain)) == 9 * 5
