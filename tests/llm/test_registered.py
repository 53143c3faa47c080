"""Registered queries over small tables, against the tokenizers library and brute force."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from demandloom.llm import near_dedup, packing, registry, token_output, toxicity
from demandloom.llm.tokens import default_tokenizer
from tests.llm.test_near_dedup import brute_force

TEXTS = [(k, f"The {k}th document isn't long, it's about {k * 7} words; naïve as that is. " * (1 + k % 9)) for k in range(60)]
TEXTS += [(100, None), (101, ""), (102, "long words, " * 9_000), (103, "☃ “wide” quotes   and <|endoftext|>"), (7, TEXTS[7][1]), (104, TEXTS[9][1])]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "Part": F.lit("own"), "segment": F.lit(1)}).repartition(4).write.parquet(str(at / "documents.parquet"))
    return str(at)


def ids_of(text, end):
    return np.array([*Tokenizer.from_file(default_tokenizer()).encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_token_output_query(spark, folder):
    got = registry.queries()["op2_token_output"](spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(i for i, _ in TEXTS)
    at, by_id = 0, defaultdict(list)
    for i, text in TEXTS:
        by_id[i].append((len(x := ids_of(text, 1)), zlib.crc32(x.tobytes())))
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in by_id[r.doc_id]
        at += r.n_tokens


def test_documents_are_read_from_their_blocks(spark, folder):
    segments = token_output.write_token_segments(spark.read.parquet(folder + "/documents.parquet"), default_tokenizer())
    asked = spark.createDataFrame([(3,), (102,), (7,), (100,), (9_999,), (None,), (3,)], "doc_id long").withColumns({c: F.lit("own") for c in ("data", "places", "part", "segment", "ids")})
    got = defaultdict(list)
    for r in token_output.read_documents(segments, asked).collect():
        got[r.doc_id].append(r.ids)
    want = defaultdict(list)
    for i, text in TEXTS:
        if i in (3, 102, 7, 100):
            want[i].append(ids_of(text, 1).tolist())
    assert got == want
    assert token_output.read_documents(segments, asked.limit(0)).count() == 0


def test_best_fit_packing_query(spark, folder):
    got = registry.queries()["op10_best_fit_packing"](spark, folder).collect()
    pieces = defaultdict(list)
    for i, text in TEXTS:
        ids = ids_of(text, 0)
        for piece, at in enumerate(range(0, len(ids), packing.SEQUENCE)):
            part = ids[at : at + packing.SEQUENCE]
            pieces[i].append((piece, at, len(part), zlib.crc32(part.tobytes())))
    mine = defaultdict(list)
    for r in got:
        mine[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in mine.items()} == {k: sorted(v) for k, v in pieces.items()}
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    assert len(held) <= -(-sum(r.length for r in got) // packing.SEQUENCE) + 1


def test_near_duplicate_query(spark, tmp_path):
    rng = np.random.default_rng(8)
    base = [[f"w{x}" for x in rng.integers(0, 5_000, 200)] for _ in range(4)]
    rows = []
    for k in range(80):
        words = list(base[k % 4])
        for at in rng.choice(200, k % 13, replace=False):
            words[at] = f"n{rng.integers(1e6)}"
        rows.append((k, " ".join(words)))
    rows += [(200, None), (201, ""), (202, ""), (203, "one"), (204, "One"), (205, rows[0][1])]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("class_id", F.lit("own")).write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.queries()["op9_bagminhash_near_dedup"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.class_id for r in got} == brute_force(rows)


@pytest.mark.parametrize("block", [2, 3])
def test_open_buckets_in_small_blocks_lose_no_link(spark, monkeypatch, block):
    """Texts of many sizes that share passages: buckets stay open after their stars, and blocks hold the rest."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = np.random.default_rng(block)
    base = [f"w{x}" for x in rng.integers(0, 5_000, 240)]
    rows = [(k, " ".join(base[(k * 5) % 40 : (k * 5) % 40 + 140 + (k * 11) % 60])) for k in range(50)]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_force(rows)


def test_toxicity_query_learns_from_labels_that_are_not_held_out(spark, tmp_path):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    run = lambda name, rows: registry.queries()["op1_toxicity"](spark, _tables(tmp_path / name, docs, rows))
    first = {r.doc_id: r for r in run("a", labels).collect()}
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: r.score for r in run("b", flipped).collect()} == {i: r.score for i, r in first.items()}
    assert len(first) == docs.count()
    for i, r in first.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    told = [(first[r.doc_id].predicted, r.toxic) for r in labels.collect() if first[r.doc_id].held_out]
    assert np.mean([p == t for p, t in told]) > 0.9


def _tables(path, docs, labels):
    docs.write.parquet(str(path / "documents.parquet"))
    labels.write.parquet(str(path / "labels.parquet"))
    return str(path)
