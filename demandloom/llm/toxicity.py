"""Toxic spans and document scores by a linear-chain conditional random field."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm import crf
from demandloom.llm.common import LONG_WORD, packed, slices, table

#: Labelled documents that the model is fitted on, about: a bounded sample by hash of the id.
TRAIN_DOCS = 8_000
#: Longer texts aren't drawn for the fit, which bounds what the driver holds; they are scored like all others.
TRAIN_LONGEST = 100_000
#: Characters of all texts that the fit reads.
TRAIN_CHARS = 100_000_000
#: Texts whose marginals the fit takes at a time.
AT_ONCE = 256
THRESHOLD, SPAN_THRESHOLD = 0.3, 0.5
#: Words whose emissions a task remembers: about 80 MB.
WORDS_HELD = 400_000
_TOKEN = re.compile(r"\S+")


class Emissions(dict):
    """word -> place of its three emissions; at most WORDS_HELD words and those of one slice of texts."""

    def __init__(self, model: crf.Crf):
        self.model, self.rows, self.used, self.fresh = model, np.zeros((1 << 16, 3)), 1, []
        self.rows[0] = model.emission("")  # stands beyond both ends of a text

    def __missing__(self, word: str) -> int:
        at = self.used
        self.used += 1
        self.fresh.append(word)
        if len(word) <= LONG_WORD:
            self[word] = at
        return at

    def fill(self) -> None:
        """Emissions of the words met since the last call, by one gather."""
        while self.used > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        for k in range(0, len(self.fresh), 1 << 16):
            part = self.fresh[k : k + (1 << 16)]
            first = self.used - len(self.fresh) + k
            self.rows[first : first + len(part)] = self.model.emissions(part)
        self.fresh.clear()

    def of(self, words: list[list[str]]) -> np.ndarray:
        """Log-odds of all tokens, each of its own word and of the words beside it in its text."""
        if self.used > WORDS_HELD:
            self.clear()
            self.used = 1
        at = np.fromiter((k for ws in words for k in (0, *map(self.__getitem__, ws), 0)), np.int64)
        self.fill()
        own, after, before = self.rows[at].T
        return (own + np.concatenate([[0.0], after[:-1]]) + np.concatenate([before[1:], [0.0]]))[_inside(words)] if len(at) else np.zeros(0)


def _inside(words: list[list[str]]) -> np.ndarray:
    """True for the tokens of texts that each have one more place on either side."""
    sizes = np.array([len(ws) for ws in words]) + 2
    out = np.ones(int(sizes.sum()), bool)
    ends = np.cumsum(sizes)
    out[ends - 1] = out[ends - sizes] = False
    return out


def token_marginals(texts: list[str], words: Emissions) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of all tokens of the texts, and where each text's tokens end."""
    found = [t.split() for t in texts]
    ends = np.cumsum([len(x) for x in found])
    emissions = words.of(found)
    starts = np.zeros(len(emissions), bool)
    starts[[a for a, ws in zip(np.concatenate([[0], ends[:-1]]).astype(int), found, strict=True) if ws]] = True
    return crf.marginals(emissions, starts, words.model), ends


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id as text is 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_docs: int = TRAIN_DOCS) -> tuple[crf.Crf, np.ndarray]:
    """The field and the weights that turn its marginals into a score, both fitted on the sample.

    Only labels of ids that aren't held out are read. Of several labels of an id the largest
    counts. At most twice ``train_docs`` texts of at most TRAIN_LONGEST characters, and of at most
    TRAIN_CHARS in all, reach the driver; longer ones are scored like all others. Without both kinds of label all scores are the smoothed share of toxic ones.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic"))
    share = max(1, round(1_000_000 * train_docs / max(known.count(), 1)))
    sample = known.filter(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1_000_000)) < share).limit(2 * train_docs)
    row = packed(docs)
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    # equal rows count once; ids that many rows share are drawn from by hash of the text
    drawn = row.select(F.col("row").getField(id_col).alias("id"), text.alias("t")).filter(F.char_length("t") <= TRAIN_LONGEST).join(F.broadcast(sample), "id").distinct()
    few = drawn.withColumn("_h", F.xxhash64("id", "t")).orderBy("_h").limit(2 * train_docs)
    used = F.sum(F.char_length("t")).over(Window.orderBy("_h", "id", "t"))  # over the drawn rows alone
    rows = few.withColumn("_used", used).filter(F.col("_used") <= TRAIN_CHARS).drop("_h", "_used").toArrow().sort_by([("id", "ascending"), ("t", "ascending")])
    texts, toxic = rows["t"].to_pylist(), np.array(rows["toxic"].to_pylist(), np.float64) > 0
    if not toxic.any() or toxic.all():
        share = (toxic.sum() + 0.1) / (len(toxic) + 1.0)
        return crf.Crf(), np.array([0.0, 0.0, 0.0, 0.0, np.log(share / (1 - share))])
    model = crf.train(texts, toxic)
    words = Emissions(model)
    x = np.concatenate([crf.summary(*token_marginals(texts[k : k + AT_ONCE], words)) for k in range(0, len(texts), AT_ONCE)])
    return model, crf.fit_scores(x, toxic.astype(np.float64))


def score(docs: DataFrame, model: crf.Crf, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, spans) of every whole text: spans are array<struct<start, end, p>> in code points.

    A span joins neighbouring tokens whose marginal is at least SPAN_THRESHOLD; p is their largest.
    Null texts count as empty: no token, the score of a text without toxic ones. Very long texts are scored whole; other
    columns, whatever their names, play no part. Equal texts get
    equal scores; null ids and repeated rows keep their own row; an empty table gives an empty one.
    """
    held = docs.sparkSession.sparkContext.broadcast((model, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, weights = held.value
        words = Emissions(model)
        span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            p, ends = token_marginals(texts, words)
            x = crf.summary(p, ends)
            spans: list[list[dict]] = [[] for _ in texts]
            for k in np.unique(np.searchsorted(ends, np.nonzero(p >= SPAN_THRESHOLD)[0], "right")):
                own = p[(ends[k - 1] if k else 0) : ends[k]]
                last = -2
                for i, m in enumerate(_TOKEN.finditer(texts[k])) if len(own) else ():
                    if i < len(own) and own[i] >= SPAN_THRESHOLD:
                        if last == i - 1 and spans[k]:
                            spans[k][-1]["end"], spans[k][-1]["p"] = m.end(), max(spans[k][-1]["p"], float(own[i]))
                        else:
                            spans[k].append({"start": m.start(), "end": m.end(), "p": float(own[i])})
                        last = i
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.round(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))), 9)), pa.array(spans, span_type)], names=["doc_id", "score", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, spans array<struct<start: int, end: int, p: double>>")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, *fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_spans"))
