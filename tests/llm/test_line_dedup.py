"""Which documents and lines take part in the removal of spread lines."""

import time

import duckdb

from demandloom.llm import line_dedup

SCHEMA = "doc_id long, text string, source string"
FOOT = "this is the common footer line of many sites"


def removed(spark, rows, **options):
    return {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA), **options).collect()}


def test_boilerplate_goes_whatever_its_share_and_length(spark):
    own = "own text number"
    rows = [(k, f"{own} {k}\n{FOOT}\nYes.", f"s{k}") for k in range(8)]
    rows += [(20 + k, FOOT, f"s{k}") for k in range(3)]  # nothing of their own
    rows += [(40 + k, f"{own} x{k}\nNo.", f"s{k}") for k in range(7)]  # on seven sites
    got = removed(spark, rows)
    assert all(got[k] == (f"{own} {k}", 2) for k in range(8))
    assert all(got[20 + k] == ("", 1) for k in range(3))
    assert all(got[40 + k] == (f"{own} x{k}\nNo.", 0) for k in range(7))


def test_limits_are_on_demand(spark):
    rows = [(k, f"own text number {k}\n{FOOT}\nYes.", f"s{k}") for k in range(8)] + [(20, FOOT, "s1")]
    got = removed(spark, rows, min_words=5, max_part=0.9)
    assert all(got[k] == (f"own text number {k}\nYes.", 1) for k in range(8)) and got[20] == (FOOT, 0)


def test_exact_counts_decide_near_the_threshold(spark):
    rows = [(100 * n + k, f"line on {n} sites\nown line {n} {k}", f"s{k}") for n in range(4, 14) for k in range(n)]
    got = removed(spark, rows)
    assert all(got[100 * n + k][1] == int(n >= 8) for n in range(4, 14) for k in range(n))


def test_long_texts_and_repeated_rows(spark):
    long = "\n".join([FOOT, *(f"line {k} of a long text" for k in range(60_000)), FOOT])
    rows = [(k, f"own text {k}\n{FOOT}", f"s{k}") for k in range(8)] + [(50, long, "s1"), (50, long, "s1"), (None, FOOT, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = line_dedup.dedup_lines(docs).filter("doc_id = 50 or doc_id is null").collect()
    assert sorted((r.n_removed, r.n_lines, len(r.text)) for r in got) == [(1, 1, 0), *[(2, 60_002, len(long) - 2 * len(FOOT) - 2)] * 2]


def test_removals_are_those_of_the_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.sql(line_dedup.OP7_SQL).fetchall()}
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.op7_line_dedup(spark, sf).collect()}
    assert got == want and sum(r[1] for r in want.values()) > 500


def test_many_removed_lines_in_a_text_take_nearly_linear_time(spark):
    def took(n):
        rows = [(k, "\n".join(f"own {i} of {k}" if i % 3 == 0 else f"line {i} of all" for i in range(n)), f"s{k}") for k in range(8)]
        begun = time.time()
        got = removed(spark, rows)
        spent = time.time() - begun
        for k, (text, gone) in got.items():
            assert gone == n - len(range(0, n, 3)) and text == "\n".join(f"own {i} of {k}" for i in range(0, n, 3))
        return spent

    took(100)
    small = took(4_000)
    assert took(40_000) < 8 * small + 6  # ten times the lines


def test_first_last_and_neighbouring_lines_go(spark):
    rows = [(k, f"{FOOT}\n{FOOT}\nown {k}\n\n{FOOT}\nmore {k}\n{FOOT}", f"s{k}") for k in range(8)]
    assert all(x == (f"own {k}\n\nmore {k}", 4) for k, x in removed(spark, rows).items())
