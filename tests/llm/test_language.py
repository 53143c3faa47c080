import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.llm import language as L


def test_held_out_accuracy_and_kept_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = L.identify(docs, host=F.col("source"), train_docs=300)
    fresh = found.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) >= 300_000)
    right, n, kept = fresh.agg(F.avg((F.col("language") == F.col("lang")).cast("int")), F.count("*"), F.avg(F.col("accepted").cast("int"))).first()
    assert n > 500 and right > 0.98 and kept > 0.99


def test_scores_of_words_are_sums_of_trigrams():
    names, known, unseen = L.fit(["aaa bab", "zzz yzy", "aab"], ["x", "y", "x"])
    scores = L.WordScores(list(known), np.array([unseen, *known.values()]))
    got = scores.sums(["aaa, ZZZ qqq", None, "", "123 ...", "aaa, ZZZ qqq"])
    want = np.sum([known.get(g, unseen) for w in ("aaa", "zzz", "qqq") for g in L.trigrams(w)], axis=0)
    assert names == ["x", "y"] and np.allclose(got[0], want) and not got[1:4].any() and (got[0] == got[4]).all()


def test_evidence_is_fused(spark):
    rows = [(k, "the of and thing", "en", "a.example.uk") for k in range(30)] + [(100 + k, "der und die ding", "de", "b.example.de") for k in range(30)]
    rows += [(500, "xqxq", None, "b.example.de"), (501, "xqxq", None, "a.example.uk"), (502, '<html lang="de"> xqxq', None, "new.example.com"), (503, "", None, "a.example.uk"), (504, None, None, None), (505, "1234 !!", None, "a.example.uk")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, host string").withColumn("Posterior", F.lit(7))
    got = {r.doc_id: r for r in L.identify(docs, host=F.col("host"), train_docs=1000).collect()}
    assert got[500].language == "de" and got[501].language == "en"  # the host decides
    assert got[502].language == "de"  # the declared language decides
    assert not any(got[k].accepted for k in (503, 504, 505)) and got[503].language == "und"
    assert got[0].accepted and got[0].language == "en"


@pytest.mark.parametrize("text,tag", [
    ('<html lang="fr-CA">', "fr"), ("<p xml:lang=en>", "en"), ("no markup lang=de", None), ("words first <p lang=fr>", None), ("<html><body lang=fr>", None), ("<a lang=english>", None), (None, None), ("", None),
    (' <?xml version="1.0"?>\n<!-- lang=fr > --><!DOCTYPE html><HTML class="' + "x" * 500 + '" LANG = de>', "de"),
])
def test_declared_language(spark, text, tag):
    assert spark.createDataFrame([(text,)], "t string").select(L.declared_in_markup(F.col("t")).alias("d")).first().d == tag


def test_empty_table_and_no_labels(spark):
    schema = "doc_id long, text string, lang string, source string"
    assert L.identify(spark.createDataFrame([], schema), host=F.col("source")).count() == 0
    assert not L.identify(spark.createDataFrame([(1, "words here", None, "s")], schema), host=F.col("source")).first().accepted


def brute_force(rows, names, known, unseen):
    """doc_id -> (language, posterior) of rows (doc_id, text, lang, host), in plain loops."""
    classes = [*names, L.OTHER]

    def softmax(v):
        e = np.exp(np.array(v) - max(v))
        return e / e.sum()

    def evidence(text):
        total = np.zeros(len(classes))
        for w in (text or "").split():
            for g in L.trigrams(w):
                total += known.get(g, unseen)
        total = L.TEMPER * total
        total -= total.max()
        return total * min(1.0, L.MOST / -total.min()) if total.min() else total

    suffix = lambda h: h.rsplit(".", 1)[1].lower() if h and "." in h else ""
    logs = {r: evidence(r[1]) for r in rows}
    shares = {r: softmax(logs[r]) for r in rows}
    host, by_suffix, every = {}, {}, np.zeros(len(classes))
    for r in rows:
        h = r[3] or ""
        host[h] = host.get(h, 0) + shares[r]
        by_suffix[suffix(h)] = by_suffix.get(suffix(h), 0) + shares[r]
        every = every + shares[r]
    every = (every + 1) / (every.sum() + len(classes))
    out = {}
    for r in rows:
        h = r[3] or ""
        s = by_suffix[suffix(h)]
        towards = (s + L.SUFFIX_WEIGHT * every) / (s.sum() + L.SUFFIX_WEIGHT)
        prior = np.maximum(host[h] - shares[r], 0) + L.HOST_WEIGHT * towards
        total = logs[r] + np.log(prior + 1e-9)
        if len(r) > 4 and r[4] in names:
            total += [np.log(L.DECLARED_TRUST if c == r[4] else (1 - L.DECLARED_TRUST) / len(names)) for c in classes]
        total[-1] += np.log(L.OTHER_PRIOR)
        post = softmax(total)
        letters = any(c.isalpha() for c in r[1] or "")
        out[r[0]] = (classes[int(post.argmax())], float(post.max())) if letters else (L.OTHER, 0.0)
    return out


def test_fusion_against_brute_force(spark):
    rng = np.random.default_rng(4)
    vocabulary = {"en": ["the", "thing", "with", "shall"], "de": ["der", "und", "nicht", "schon"], "fr": ["le", "quel", "vous", "eaux"]}
    rows = []
    for k in range(240):
        lang = ("en", "de", "fr")[k % 3]
        other = ("de", "fr", "en")[k % 3]
        words = [str(rng.choice(vocabulary[lang if rng.random() < 0.7 else other])) for _ in range(int(rng.integers(1, 6)))]
        rows.append((k, " ".join(words), lang, None if k % 40 == 0 else f"h{k % 11}.{lang if k % 5 else 'com'}"))
    rows += [(900, "zqzq", None, "h1.de"), (901, "", None, "h1.de"), (902, "123", None, None), (903, None, None, "x"), (904, "the und", None, "H.DE")]
    names, known, unseen = L.fit([r[1] for r in rows if r[2]], [r[2] for r in rows if r[2]])
    want = brute_force(rows, names, {g: np.array(v) for g, v in known.items()}, np.array(unseen))
    got = L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, host string"), host=F.col("host"), train_docs=100_000).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.language == want[r.doc_id][0] and abs(r.posterior - want[r.doc_id][1]) < 1e-9, r


def test_query_over_documents_and_pages(spark, tmp_path):
    """All four kinds of evidence, in the registered query: pages declare languages and have hosts and suffixes."""
    rng = np.random.default_rng(6)
    vocabulary = {"en": ["the", "thing", "with", "shall"], "de": ["der", "und", "nicht", "schon"], "fr": ["le", "quel", "vous", "eaux"]}
    said = lambda lang, n: " ".join(str(rng.choice(vocabulary[lang])) for _ in range(n))
    docs = [(k, said(("en", "de", "fr")[k % 3], 1 + k % 5), ("en", "de", "fr")[k % 3], f"src{k % 4}") for k in range(120)] + [(200, None, "en", "src0"), (201, "zq zq", None, None)]
    pages = []
    for k in range(90):
        lang = ("en", "de", "fr")[k % 3]
        text = said(lang, k % 3) if k % 2 else "zq xw"
        head = f"<!DOCTYPE html><html lang='{lang}-XX'>" if k % 4 else "<html>"
        pages.append((k, f"https://H{k % 5}.{'de' if lang == 'de' else 'com'}/a?b={k}", f"{head}<script>var the=1</script><p title=und>{text}</p><!-- le -->"))
    pages += [(900, None, None), (901, "no address", "<html lang=en>"), (None, "http://h1.com", "<p>the thing</p>")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    rows = [(("d", i), t, None, s) for i, t, _, s in docs]
    for i, url, html in pages:
        text = None if html is None else re.sub(r"<!DOCTYPE html>|<html[^>]*>|<script>.*?</script>|<p[^>]*>|</p>|<!-- le -->", " ", html)
        declared = re.search(r"<html lang='?([a-z]+)", html or "")
        rows.append((("p", i), text, None, re.sub(r"https?://([^/]*).*", r"\1", url).lower() if url and "//" in url else None, declared and declared.group(1)))
    names, known, unseen = L.fit([d[1] for d in docs if d[1] and d[2]], [d[2] for d in docs if d[1] and d[2]])
    want = brute_force(rows, names, {g: np.array(v) for g, v in known.items()}, np.array(unseen))
    got = L.op5_language_id(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        page = r.page_id is not None or r.doc_id is None
        language, posterior = want["p" if page else "d", r.page_id if page else r.doc_id]
        assert r.language == language and abs(r.posterior - posterior) < 2e-6, r
        assert not page or r.page_id is None or r.doc_id == -1 - r.page_id
    told = [r for r in got if r.page_id is not None and r.page_id < 90 and r.page_id % 2 == 0 and r.page_id % 4]
    assert told and all(r.language == ("en", "de", "fr")[r.page_id % 3] for r in told)  # by what their markup declares


def test_of_equally_likely_languages_the_first_is_given(spark):
    rows = [(k, text, lang, "h") for k, (text, lang) in enumerate([("aaa", "x"), ("aaa", "y"), ("bbb", "x"), ("bbb", "y"), ("aaa", None)])]
    got = {r.doc_id: r.language for r in L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), host=F.col("source")).collect()}
    assert got[4] == "x"


def test_the_sample_is_bounded_in_characters_and_keeps_every_language(spark, monkeypatch):
    monkeypatch.setattr(L, "TRAIN_CHARS", 3_000)
    rows = [(k, "word " * 100 + str(k), "rare" if k % 100 == 0 else "often") for k in range(300)]
    got = L.training_rows(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang", 1_000).collect()
    assert sum(len(r.t) for r in got) <= 3_000 and {r.l for r in got} == {"rare", "often"}
