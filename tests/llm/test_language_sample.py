"""Which labelled documents the text model is fitted on."""

from pyspark.sql import functions as F

from demandloom.llm import language as L


def test_rare_languages_repeated_rows_and_shared_ids(spark):
    rows = [(k, f"the of and thing {k}", "en") for k in range(20_000)]
    rows += [(30_000 + k, f"der und die ding {k}", "de") for k in range(3)]  # rarer than one in the sample's rate
    rows += [(40_000, "le la les chose", "fr")] * 500 + [(None, f"el los una cosa {k}", "es") for k in range(5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["l"]: r["count"] for r in L.training_rows(docs, "doc_id", "text", "lang", 400).groupBy("l").count().collect()}
    assert got["de"] == 3 and got["fr"] == 1
    assert 200 < got["en"] < 440 and 40 < got["es"] < 130
    found = L.identify(docs.filter("doc_id > 19000 or doc_id is null"), train_docs=200).filter("lang = 'de'")
    assert found.filter("language = 'de' and accepted").count() == 3


def test_accuracy_without_their_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hidden = docs.withColumn("told", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    right, n = L.identify(hidden, label_col="told", host=F.col("source"), train_docs=300).filter("told is null").agg(F.avg((F.col("language") == F.col("lang")).cast("int")), F.count("*")).first()
    assert n > 400 and right > 0.98
