"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns through operators and stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from demandloom.llm import audio, language, line_dedup, mixing, near_dedup, packing, pii, token_output, toxicity
from demandloom.llm.tokens import default_tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside, in one case or another, and some that they return.
CLASHES = [
    "row", "key", "label", "class", "class_rows", "id", "text_hash", "gone", "site", "line", "host", "suffix", "declared", "letters", "evidence", "post", "counts", "suffix_prior",
    "copies", "position", "rows", "Copy", "each", "bucket", "_id", "_text_hash", "_gone", "_host", "_declared", "_text", "_p", "_counts", "_nd_key", "_nd_class", "_mix_key", "_mix_copy", "_v", "_offset", "_toxic", "t", "h1", "media", "band", "a.b",
]
ROWS = [(k, f"plain words number {k} of the text and more of them", "en" if k % 2 else "de", f"s{k % 9}.example", 40) for k in range(40)]
ODD = [(100, None, "en", "s1", None), (101, "", None, None, 0), (None, "a text without an id here", "en", None, 24), (102, "long " * 300_000, "en", "s2", 1_500_000), (5, ROWS[5][1], "en", "s5.example", 40), (5, ROWS[5][1], "en", "s5.example", 40), (103, "\n\n \t", "de", "s3", 4), (104, "1234 !!", "xx", "s4", 7)]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ROWS + ODD, SCHEMA)
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


def kept_as_they_were(docs, columns):
    names = [f"`{c}`" for c in CLASHES if c in columns]
    return docs.select(*names).distinct().collect() == [tuple(f"own {c}" for c in CLASHES if c in columns)]


@pytest.mark.parametrize("name,make", [
    ("language", lambda d: language.identify(d, host=F.col("source"))),
    ("lines", line_dedup.dedup_lines),
    ("near", near_dedup.near_duplicates),
    ("one", near_dedup.keep_one),
    ("mix", mixing.mix_documents),
    ("pii", pii.find_personal_data),
])
def test_other_columns_stay_as_they_are(spark, odd, name, make):
    out = make(odd)
    assert set(odd.columns) <= set(out.columns)
    assert kept_as_they_were(out, CLASHES)
    if name not in ("one", "mix"):
        assert out.count() == len(ROWS + ODD)
    assert make(odd.limit(0)).count() == 0


@pytest.mark.parametrize("make", [
    lambda d: audio.write_features(audio.write_audio(d)),
    lambda d: token_output.read_token_segments(token_output.write_token_segments(d, default_tokenizer())),
    lambda d: packing.pack_documents(d).filter("piece = 0"),
])
def test_rows_that_need_only_id_and_text(spark, odd, make):
    assert make(odd).count() == len(ROWS + ODD) and make(odd.limit(0)).count() == 0


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(40)] + [(5, 1), (None, 1), (7, None)], "doc_id long, toxic int").withColumn("_toxic", F.lit(3))
    got = toxicity.score(odd, *toxicity.fit(odd, labels)).collect()
    assert len(got) == len(ROWS + ODD) and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert len(by[5]) == 1 and by[100] == by[101]


def test_stages_take_odd_rows(spark, odd):
    docs, texts = odd, {r.doc_id: r.text for r in odd.filter("doc_id is not null").collect()}
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, odd.limit(0), "")
        assert empty.count() == 0, name
        out = stage(spark, docs, "")
        if name != "packing":
            assert out.columns == odd.columns, name
            docs = corpus_pipeline.materialise(out, f"odd-{name}")
            assert kept_as_they_were(docs, CLASHES), name
            assert {r.doc_id for r in docs.collect()} <= {None, *texts}, name
    assert out.filter("doc_id = 102").agg(F.count("*")).first()[0] > 100  # the long text, whole
