import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from demandloom.llm import curve as C
from demandloom.llm.tokens import TextIds, default_tokenizer, word_parts

PATH = default_tokenizer(C.TOKENIZER)


def library_ids(text):
    return np.array([*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def check_packed(rows, docs, size):
    """Pieces of all ids in order, in gapless sequences that are full or as long as a power of two."""
    want, total = [], 0
    for doc_id, text in docs:
        want.append((doc_id, library_ids(text)))
        total += len(want[-1][1])
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at == size or (at < size and at & (at - 1) == 0)
    assert sum(r.length for r in rows) == total and len({s for s in sequences}) <= total // size + size.bit_length()
    for doc_id in {d for d, _ in want}:
        expected, got = [ids for d, ids in want if d == doc_id], sorted(by_doc[doc_id], key=lambda r: r.start)
        if len(expected) == 1:
            at = 0
            for r in got:
                assert r.start == at and r.doc_tokens == len(expected[0])
                assert r.ids_crc32 == zlib.crc32(expected[0][at : at + r.length].tobytes())
                at += r.length
            assert at == len(expected[0])
        else:
            assert sum(r.length for r in got) == sum(map(len, expected))


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_neighbours(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
    places = C.hilbert(cells, bits)
    assert sorted(places) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("size", [64, 1024])
def test_packing_of_odd_rows(spark, size):
    docs = [(k, f"document {k} says that it's number {k * 7}.\nAnd   more\t\n  of {'it ' * (k % 50)}") for k in range(120)]
    docs += [(200, None), (201, ""), (202, "long words " * 30_000), (203, "naïve ☃ “quotes”   wide"), (None, "no id"), (5, docs[5][1]), (204, docs[9][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("row", "Place", "tie", "n", "ids", "at", "range")})
    check_packed(C.pack_along_curve(frame.repartition(5), size=size).collect(), docs, size)
    assert C.pack_along_curve(frame.limit(0), size=size).count() == 0


def test_query_over_a_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check_packed(C.op12_curve_packing(spark, "/root/testdata/sf0.001").collect(), docs, C.SEQUENCE)


def test_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    runs = [sorted(tuple(r) for r in C.pack_along_curve(docs).collect()) for _ in range(2)]
    assert runs[0] == runs[1]


def test_neighbours_on_the_curve_resemble_each_other(spark):
    places = C.curve_places(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), PATH).toPandas().sort_values(["place", "tie", "row"])
    seen = [set(np.frombuffer(x[:-2], "<u2")[:2000].tolist()) for x in places.ids]
    alike = lambda a, b: len(a & b) / max(1, min(len(a), len(b)))
    near = np.mean([alike(a, b) for a, b in zip(seen, seen[1:], strict=False)])
    rng = np.random.default_rng(1)
    apart = np.mean([alike(seen[i], seen[j]) for i, j in rng.integers(0, len(seen), (2000, 2))])
    assert near > apart + 0.1


def test_equal_documents_stand_together(spark):
    docs = [(k, f"text number {k % 7} of seven " * 9) for k in range(210)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    order = C.curve_places(rows, PATH).orderBy("place", "tie", "row").select("doc_id").collect()
    kinds = [r.doc_id % 7 for r in order]
    assert sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) == 6


def test_words_of_the_byte_vocabulary_are_encoded_as_the_library_does():
    mine, rng = TextIds(PATH), np.random.default_rng(3)
    letters = list(" \n\t\r'sdtmlvre0123abéñÀß .,-!?_#\x0b\x0c")
    for _ in range(3000):
        text = "".join(rng.choice(letters, rng.integers(0, 40)))
        assert mine.raw(text) == mine._library(text), repr(text)
        assert "".join(word_parts(text, 5)) == text and b"".join(mine._library(p) for p in word_parts(text, 5)) == mine._library(text)


@pytest.mark.parametrize("total,want", [(2048, []), (2049, [(2048, 1)]), (2048 + 700, [(2048, 512), (2560, 128), (2688, 32), (2720, 16), (2736, 8), (2744, 4)]), (0, [])])
def test_what_is_left_over_is_cut_at_powers_of_two(total, want):
    assert C.tail_cuts(total, 1024) == want
