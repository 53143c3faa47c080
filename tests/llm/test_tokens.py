"""Tokens, segments and packing against the library itself and brute force."""

import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandloom.llm import packing as P
from demandloom.llm import token_output as O
from demandloom.llm.tokens import TextIds, default_tokenizer, text_ids

TEXTS = ["", "Hello, World's best?! it's 42x  ÄÖß naïve", "áb é ｆｕｌｌ 中文 emoji \U0001f600!", "x<|endoftext|>y <|startoftext|>", "a\x1cb c\xa0d\x85e", "ΑΣ ΑΣΑ İI", "_-_ ''s 'll''", "word " * 3000, "y" * 5000]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_the_librarys(text):
    cache = text_ids(default_tokenizer())
    assert cache.ids(text, 1).tolist() == [*cache.tokenizer.encode(text, add_special_tokens=False).ids, 1]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_ids_of_any_text(text):
    cache = text_ids(default_tokenizer())
    assert cache.ids(text, 1).tolist()[:-1] == cache.tokenizer.encode(text, add_special_tokens=False).ids


def _same_as_library(texts, cache):
    ids, lengths = cache.ids_of(pa.array(texts, pa.string()), 1)
    want = [[*cache.tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert ids.dtype == np.uint32 and ids.tolist() == [x for w in want for x in w] and lengths.tolist() == list(map(len, want))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), st.text(" \t\nabcÄß'st!<|1_", max_size=40)), max_size=8))
def test_ids_of_many_texts(texts):
    _same_as_library(texts, text_ids(default_tokenizer()))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_odd_and_long_texts_beside_others(name):
    cache = TextIds(default_tokenizer(name))
    cache.chunks.most = cache.words.most = 5  # so that hardly any is remembered
    for texts in ([*TEXTS, None, "plain words", *TEXTS], [None], [""], [], ["  "], ["Don't stop, " * 400_000], ["y" * 300, "y" * 300]):
        _same_as_library(texts, cache)
        _same_as_library(texts, cache)
    assert len(cache.chunks.keys) < 100 and len(cache.words.keys) < 100


def test_words_are_encoded_one_by_one_where_the_model_does_not_mark_their_end():
    cache = TextIds(default_tokenizer())
    cache.closing = None
    _same_as_library([*TEXTS, None], cache)


def test_many_texts_take_less_time_together():
    rng = np.random.default_rng(0)
    parts = np.array(["the", "in", "an", "er", "tion", "ing", "ou", "re", "nd", "es", "wh", "at"])
    words = ["".join(x) for x in parts[rng.integers(0, 12, (40_000, 4))]]
    texts = [" ".join(words[k] for k in (40_000 * rng.random(500) ** 4).astype(int)) for _ in range(2000)]
    column, took = pa.array(texts), {}
    for name, work in (("one by one", lambda c: [c.ids(t, 1) for t in texts]), ("together", lambda c: c.ids_of(column, 1))):
        took[name] = min(_seconds(work) for _ in range(3))
    assert took["together"] < 0.8 * took["one by one"]


def _seconds(work):
    cache = TextIds(default_tokenizer())
    began = time.process_time()
    work(cache)
    return time.process_time() - began


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=300), min_size=1, max_size=5))
def test_segments_round_trip(docs):
    ids = np.array([i for d in docs for i in d], np.uint32)
    names = [None if k == 2 else k - 10 for k in range(len(docs))]
    got, doc_ids, lengths = O.decode_segment(O.encode_segment(ids, names, [len(d) for d in docs]))
    assert got.tolist() == ids.tolist() and doc_ids == names and lengths.tolist() == [len(d) for d in docs]


def test_segments_pack_small_ids_tightly():
    ids = np.random.default_rng(0).integers(1000, 1016, 12_800).astype(np.uint32)
    ids[::200] = 4_000_000_000
    assert len(O.encode_segment(ids, [1], [len(ids)])) < len(ids) * 4 / 4


def test_written_segments_read_back_in_id_order(spark):
    rows = [(k * 7 % 50, f"doc {k} " * (k % 9)) for k in range(50)] + [(7, None), (60, "x " * 200_000), (None, "last"), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("DATA", F.lit(1))
    got = O.read_token_segments(O.write_token_segments(docs, default_tokenizer())).orderBy("start").collect()
    cache, at = TextIds(default_tokenizer()), 0
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows if r[0] is not None)) + [None, None]
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(zlib.crc32(cache.ids(t, 1).tobytes()))
    for r in got:
        assert r.start == at and r.ids_crc32 in texts[r.doc_id]
        at += r.n_tokens
    empty = O.read_token_segments(O.write_token_segments(docs.limit(0), default_tokenizer()))
    assert empty.count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plan_places_every_piece_once(counts):
    plan = P.plan_best_fit(counts, 64)
    bins = {}
    for length, first, last, sequence, each, offset in plan:
        for r in range(last - first):
            bins.setdefault(sequence + r // each, []).append((offset + r % each * length, length))
    for length, n in counts.items():
        ranks = sorted(x for p in plan if p[0] == length for x in range(p[1], p[2]))
        assert ranks == list(range(n))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    rooms = []  # best-fit decreasing, one piece at a time
    for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= length
        else:
            rooms.append(64 - length)
    assert len(bins) == len(rooms)


def test_packed_documents(spark):
    rows = [(k, "token " * (k * 37 % 700)) for k in range(200)] + [(500, "long " * 5000), (501, None), (502, ""), (None, "none"), (3, "token " * 111), (3, "token " * 111)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = P.pack_documents(docs).collect()
    cache = text_ids(default_tokenizer())
    want = sum(-(-len(cache.ids(t, 0)) // 2048) for _, t in rows)
    assert len(got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(bins) <= -(-total // 2048) + 1
    long = sorted((r.piece, r.start, r.length) for r in got if r.doc_id == 500)
    assert [p[:2] for p in long] == [(0, 0), (1, 2048), (2, 4096)] and sum(p[2] for p in long) == 5001
    assert P.pack_documents(docs.limit(0)).count() == 0
