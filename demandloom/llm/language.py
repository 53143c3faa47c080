"""Language identification by Bayesian fusion of text, declared language, address suffix and host priors.

The text model is naive Bayes over letter trigrams of words. Host priors are grouped sums of
text posteriors over all documents, smoothed towards the address suffix and that towards the whole
corpus; a document's own share is taken out of the prior that it meets.
"""

from __future__ import annotations

import re
from collections import Counter
from hashlib import md5
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from demandloom.llm.common import LONG_WORD, SLICE_BYTES, WORDS_KEPT, cuts, discard, materialise, maybe_broadcast, once, table, text_parts, worker_kept

#: Documents with a known language that the text model is fitted on, about: a bounded sample by hash.
TRAIN_DOCS = 4_000
#: Longer texts are not drawn for the fit, which bounds what the driver holds; they are scored like all others.
TRAIN_LONGEST = 100_000
#: Characters of all texts that the fit reads.
TRAIN_CHARS = 100_000_000
#: Each language has about TRAIN_DOCS / LEAST_PART of them at least, or all that it has.
LEAST_PART = 20
SMOOTH, HOST_WEIGHT, SUFFIX_WEIGHT = 0.5, 20.0, 50.0
#: Trigrams of a word depend on one another, so their evidence is tempered; more than MOST of it adds nothing.
TEMPER, MOST = 0.25, 200.0
DECLARED_TRUST, OTHER_PRIOR = 0.9, 1e-3
MIN_POSTERIOR = 0.34
BROADCAST_ROWS = 100_000
OTHER = "und"

_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def trigrams(word: str) -> list[str]:
    """Letter trigrams of a word in lower case with a space on either side; none without a letter."""
    bare = _EDGES.sub("", word.lower())
    padded = f" {bare} "
    return [padded[k : k + 3] for k in range(len(padded) - 2)] if bare else []


def fit(texts: list[str], langs: list[str]) -> tuple[list[str], dict[str, list[float]], list[float]]:
    """Languages, log-probabilities of seen trigrams by language (the last for any other), and of unseen ones."""
    names = sorted(set(langs))
    counts = {n: Counter() for n in names}
    words = {n: Counter() for n in names}
    for text, lang in zip(texts, langs, strict=True):
        words[lang].update(text.split())
    for lang, found in words.items():
        for word, n in found.items():
            for g in trigrams(word):
                counts[lang][g] += n
    kinds = sorted(set().union(*counts.values())) if names else []
    room = SMOOTH * (len(kinds) + 1)
    totals = [sum(counts[n].values()) + room for n in names]
    other = -log(30**3)
    table_ = {g: [*(log((counts[n][g] + SMOOTH) / t) for n, t in zip(names, totals, strict=True)), other] for g in kinds}
    return names, table_, [*(log(SMOOTH / t) for t in totals), other]


def text_evidence(names: list[str], known: dict[str, list[float]], unseen: list[float]):
    """An Arrow UDF: tempered log-likelihoods of a text for each language and any other; zeros without letters."""
    table_ = np.array([unseen, *known.values()])
    model = (md5(table_.tobytes() + "".join(known).encode("utf-8", "surrogatepass")).hexdigest(), list(known), table_)

    @F.arrow_udf(ArrayType(DoubleType()))
    def evidence(texts: pa.Array) -> pa.Array:
        words = worker_kept(("language", model[0]), lambda: WordScores(model[1], model[2]))
        out = np.zeros((len(texts), len(names) + 1))
        for at, to in cuts(texts):
            out[at:to] = words.sums(texts[at:to].to_pylist())
        total = TEMPER * out
        total -= total.max(axis=1, keepdims=True)
        least = total.min(axis=1, keepdims=True)
        total = np.where(least < -MOST, total * (MOST / np.maximum(-least, MOST)), total)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(total) + 1) * total.shape[1], pa.int32()), pa.array(total.ravel()))

    return evidence


class WordScores(dict):
    """word -> place of the row of its summed trigram log-probabilities; at most WORDS_KEPT words and those of one text part."""

    def __init__(self, grams: list[str], table_: np.ndarray):
        self.grams = {g: k + 1 for k, g in enumerate(grams)}
        self.table = table_
        self.rows, self.used, self.fresh = np.zeros((1 << 16, table_.shape[1])), 0, []

    def __missing__(self, word: str) -> int:
        bare = word.lower()
        if not bare.isalpha():
            bare = _EDGES.sub("", bare)
        if bare != word and len(word) <= LONG_WORD:
            self[word] = at = self[bare]
            return at
        at = self.used
        if len(word) <= LONG_WORD:
            self[word] = at
        self.used += 1
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.fresh.append(bare)
        return at

    def fill(self) -> None:
        """Rows of the words met since the last call, by one gather."""
        grams, get, starts, full = [], self.grams.get, [], []
        for k, word in enumerate(self.fresh):
            if word:
                starts.append(len(grams))
                full.append(k)
                padded = f" {word} "
                grams += [get(padded[i : i + 3], 0) for i in range(len(word))]
        rows = np.zeros((len(self.fresh), self.table.shape[1]))
        if grams:
            rows[full] = np.add.reduceat(self.table[grams], starts, axis=0)
        self.rows[self.used - len(rows) : self.used] = rows
        self.fresh.clear()

    def sums(self, texts: list[str | None]) -> np.ndarray:
        """Summed rows of the words of each text; zeros for a text without words."""
        out = np.zeros((len(texts), self.table.shape[1]))
        if sum(len(t) for t in texts if t) > 2 * SLICE_BYTES:  # one very long text
            for k, text in enumerate(texts):
                for part in text_parts(text or ""):
                    out[k] += self.sums([part])[0]
            return out
        if self.used > WORDS_KEPT:
            self.clear()
            self.used = 0
        found = [t.split() if t else [] for t in texts]
        sizes = np.array([len(x) for x in found], np.int64)
        if sizes.sum():
            at = np.fromiter((self[w] for ws in found for w in ws), np.int64, int(sizes.sum()))
            self.fill()
            full = sizes > 0
            out[full] = np.add.reduceat(self.rows[at], (np.cumsum(sizes) - sizes)[full], axis=0)
        return out


def declared_in_markup(text: Column) -> Column:
    """The primary language tag that the first element of a text declares by lang or xml:lang, or null.

    White space, a declaration, a document type and comments may stand before the element, and nothing else;
    elements further on, which may quote other languages, declare nothing for the text.
    """
    found = F.lower(F.regexp_extract(text, r"(?is)\A\s*+(?:(?:<!--.*?-->|<[?!][^<>]*+>)\s*+)*+<[a-z][^<>]*?\s(?:xml:)?lang\s*+=\s*+[\"']?([a-z]{2,3})(?![a-z])", 1))
    return F.when(found != "", found)


def text_of_markup(html: Column) -> Column:
    """A page's text: scripts, styles, comments and tags become spaces; a null page has a null text."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b[^<>]*+>.*?</\1\s*+>|<!--.*?-->|<[a-z/!?][^<>]*+>", " ")


def host_of(address: Column) -> Column:
    """The host of an address in lower case, or null where there is none."""
    return F.lower(F.try_parse_url(address, F.lit("HOST")))


def documents_and_pages(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows (doc_id, page_id, text, lang, host, declared) of documents and of web pages.

    A document's host is its source. A page brings its markup's text, the language that its markup declares, and the host of
    its address; its doc_id is -1 - page_id, so ids of documents and pages never meet.
    """
    none = F.lit(None).cast("string")
    ours = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("host"), declared_in_markup(F.col("text")).alias("declared"))
    page = F.col("page_id").cast("long")
    theirs = pages.select((-1 - page).alias("doc_id"), page.alias("page_id"), text_of_markup(F.col("html")).alias("text"), none.alias("lang"), host_of(F.col("url")).alias("host"), declared_in_markup(F.col("html")).alias("declared"))
    return ours.unionByName(theirs)


def address_suffix(host: Column) -> Column:
    """What follows the last dot of a host name, in lower case; null without a dot."""
    return F.when(F.contains(host, F.lit(".")), F.lower(F.regexp_extract(host, r"\.([^.]+)$", 1)))


def _softmax(logs: Column) -> Column:
    shares = lambda up: once(F.aggregate(up, F.lit(0.0), lambda a, y: a + y), lambda total: F.transform(up, lambda x: x / total))
    return once(logs, lambda xs: once(F.array_max(xs), lambda top: once(F.transform(xs, lambda x: F.exp(x - top)), shares)))


def training_rows(docs: DataFrame, id_col: str, text_col: str, label_col: str, train_docs: int, longest: int = TRAIN_LONGEST) -> DataFrame:
    """(t, l) of about ``train_docs`` labelled documents, and of more where a language would have too few.

    The languages and their rates come from counts over all rows, so a language stays however rare
    it is. Rows are told apart by id and text: repeated ones count once, and those that only share
    an id are drawn one by one. Texts of over ``longest`` characters are not drawn, no more
    than four times ``train_docs`` rows are, and no more than TRAIN_CHARS characters in all: languages then
    get their rows in turns, so that a rare one keeps its own.
    """
    keyed = docs.filter(F.col(label_col).isNotNull() & (F.char_length(text_col) <= longest)).select(F.col(text_col).alias("t"), F.col(label_col).alias("l"), F.xxhash64(F.col(id_col), F.col(text_col), F.lit(5)).alias("_h"))
    counts = keyed.select("l", "_h").distinct().groupBy("l").agg(F.count("*").alias("n")).collect()  # one row a language
    total = sum(x["n"] for x in counts)
    shares = [(x["l"], max(1, round(1_000_000_000 * min(1.0, max(train_docs / total, train_docs / LEAST_PART / x["n"]))))) for x in counts]
    rates = docs.sparkSession.createDataFrame(shares, keyed.select("l", F.lit(0).alias("_share")).schema)
    drawn = keyed.join(F.broadcast(rates), "l").filter(F.pmod("_h", F.lit(1_000_000_000)) < F.col("_share"))
    few = drawn.dropDuplicates(["l", "_h"]).orderBy("_h").limit(4 * train_docs)
    turn = few.withColumn("_turn", F.row_number().over(Window.partitionBy("l").orderBy("_h")))
    used = F.sum(F.char_length("t")).over(Window.orderBy("_turn", "_h"))  # over the drawn rows alone
    return turn.withColumn("_used", used).filter(F.col("_used") <= TRAIN_CHARS).select("t", "l")


def _prior_sums(scored: DataFrame, classes: int) -> tuple[DataFrame, list[float]]:
    """Posterior sums (host, suffix, c0, c1, ...) of all rows by host, and smoothed shares of the whole corpus."""
    sums = [F.sum(F.col("p")[k]).alias(f"c{k}") for k in range(classes)]
    by_host = materialise(scored.select("host", "suffix", _softmax(F.col("evidence")).alias("p")).groupBy("host", "suffix").agg(*sums), "host-languages")
    whole = by_host.agg(*(F.sum(f"c{k}") for k in range(classes))).first()
    total = sum(x or 0.0 for x in whole)
    return by_host, [((x or 0.0) + 1) / (total + classes) for x in whole]


def host_priors(by_host: DataFrame, every: list[float]) -> DataFrame:
    """(host, counts, suffix_prior): a host's sums, and what they are smoothed towards."""
    classes = len(every)
    suffixes = by_host.groupBy("suffix").agg(*(F.sum(f"c{k}").alias(f"s{k}") for k in range(classes)))
    total = sum((F.col(f"s{k}") for k in range(classes)), F.lit(0.0))
    prior = F.array(*((F.col(f"s{k}") + SUFFIX_WEIGHT * every[k]) / (total + SUFFIX_WEIGHT) for k in range(classes)))
    return by_host.join(suffixes.select("suffix", prior.alias("suffix_prior")), "suffix").select("host", F.array(*(f"c{k}" for k in range(classes))).alias("counts"), "suffix_prior")


def fused(names: list[str], evidence: Column, counts: Column, suffix_prior: Column, declared: Column) -> Column:
    """Posteriors of the languages and any other, of all evidence for one document."""
    classes = [*names, OTHER]
    own_part = _softmax(evidence)
    prior = F.transform(F.arrays_zip(counts.alias("c"), suffix_prior.alias("s"), own_part.alias("p")), lambda x: F.greatest(x["c"] - x["p"], F.lit(0.0)) + HOST_WEIGHT * x["s"])
    told = F.when(declared.isin(names), F.transform(F.array(*map(F.lit, classes)), lambda c: F.when(c == declared, log(DECLARED_TRUST)).otherwise(log((1 - DECLARED_TRUST) / max(len(names), 1)))))
    told = F.coalesce(told, F.array(*[F.lit(0.0)] * len(classes)))
    floor = F.array(*[F.lit(0.0)] * len(names), F.lit(log(OTHER_PRIOR)))
    return _softmax(F.transform(F.arrays_zip(evidence.alias("t"), prior.alias("p"), told.alias("d"), floor.alias("f")), lambda x: x["t"] + F.log(x["p"] + 1e-9) + x["d"] + x["f"]))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", host: Column | None = None, declared: Column | None = None, train_docs: int = TRAIN_DOCS, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all of them if None) with language, posterior and accepted.

    Every text is scored once; scores and kept columns are written, and host sums and results are
    made from what was written. ``label_col`` only fits the text model, on about ``train_docs``
    documents; it is no evidence for a document. accepted is false if another language than the
    fitted ones is likeliest, if no language reaches MIN_POSTERIOR, or if the text has no letters at
    all (language is then "und").

    Null and empty texts are rejected; a null host is a host of its own; without any labelled row
    every document is rejected; repeated rows get equal results; of equally likely languages the first
    by name is given. Columns called language, posterior or accepted are replaced, all others stay,
    whatever their names.
    """
    host = F.coalesce(host.cast("string") if host is not None else F.lit(None).cast("string"), F.lit(""))
    declared = declared if declared is not None else declared_in_markup(F.col(text_col))
    rows = training_rows(docs, id_col, text_col, label_col, train_docs).toArrow().sort_by([("l", "ascending"), ("t", "ascending")])
    names, known, unseen = fit(rows["t"].to_pylist(), rows["l"].to_pylist())
    evidence = text_evidence(names, known, unseen)

    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("language", "posterior", "accepted")]
    row = F.struct(*(F.col(f"`{c}`") for c in kept)) if kept else F.struct(F.lit(0).alias("_"))
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    parts = docs.select(row.alias("row"), host.alias("host"), declared.alias("declared"), letters.alias("letters"), evidence(F.col(text_col).cast("string")).alias("evidence"))
    scored = materialise(parts.withColumn("suffix", F.coalesce(address_suffix(F.col("host")), F.lit(""))), "language-scores")
    by_host, every = _prior_sums(scored, len(names) + 1)
    priors = materialise(host_priors(by_host, every), "host-priors")
    discard(by_host)

    met = scored.join(maybe_broadcast(priors, priors.count(), BROADCAST_ROWS), "host")
    post = fused(names, F.col("evidence"), F.col("counts"), F.col("suffix_prior"), F.col("declared"))
    every_name = F.array(*map(F.lit, [*names, OTHER]))
    best = once(post, lambda xs: once(F.array_max(xs), lambda top: F.struct(F.element_at(every_name, F.array_position(xs, top).cast("int")).alias("language"), top.alias("posterior"))))
    guess = met.select("row", "letters", F.when(F.col("letters"), best).alias("best"))
    named = guess.select("row", "letters", F.coalesce("best.language", F.lit(OTHER)).alias("language"), F.coalesce("best.posterior", F.lit(0.0)).alias("posterior"))
    accepted = F.col("letters") & (F.col("language") != OTHER) & (F.col("posterior") >= MIN_POSTERIOR)
    return named.select(*(F.col("row").getField(c).alias(c) for c in kept), "language", "posterior", accepted.alias("accepted"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and all pages: documents fit the text model, pages bring declared languages, suffixes and hosts."""
    rows = documents_and_pages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))
    found = identify(rows, host=F.col("host"), declared=F.col("declared"), keep=["doc_id", "page_id"])
    return found.select("doc_id", "page_id", "language", F.round("posterior", 6).alias("posterior"), "accepted")
