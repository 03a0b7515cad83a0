import zlib

import numpy as np
from llm_fixtures import clashing, docs_of  # noqa: F401
from pyspark.sql import functions as F

from mortar.llm import quality
from mortar.llm.queries import QUERIES

SF_MID = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    got = QUERIES["op9_quality"](spark, SF_MID).collect()
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    right = [r.predicted == labels[r.doc_id] for r in got if r.held_out and labels.get(r.doc_id) is not None]
    assert len(right) > 50 and np.mean(right) >= 0.95


def test_scores_are_the_compiled_rules(docs_of):
    """The column expression gives what the rules give by hand."""
    rules = [(1.5, (("upper", True, 0.3),)), (-2.0, (("symbols", False, 0.1), ("distinct_words", True, 0.5)))]
    model = quality.RuleEnsemble(0.25, rules)
    df = docs_of([(1, "ABC DEF"), (2, "abc *** ###"), (3, ""), (4, None), (5, "a a a a a a")])
    got = {r.doc_id: r.score for r in quality.score_quality(df, model).collect()}
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    expect = {1: 0.25 + 1.5 - 2, 2: 0.25, 3: 0.25, 4: 0.25, 5: 0.25}
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(float(sigmoid(v)), 9) for k, v in expect.items()}


def test_statistics(docs_of):
    text = "The cat cat sat.\nON ON *** 12\nON ON *** 12"
    df = docs_of([(1, text), (2, ""), (3, " \n ")])
    rows = {r.doc_id: r for r in df.select("doc_id", *[c.cast("double").alias(s) for s, c in quality.statistics(F.col("text")).items()]).collect()}
    r = rows[1]
    assert r.upper == 9 / len(text) and r.digits == 4 / len(text) and r.symbols == 6 / len(text)
    assert r.again == 3 / 12 and r.distinct_words == 6 / 12 and r.distinct_lines == 2 / 3
    assert all(v is not None and np.isfinite(v) for r in rows.values() for k, v in r.asDict().items())


def test_edge_cases(spark, docs_of, clashing):
    rows = [(i, "GOOD!! BAD!! " * (3 + i % 4) if i % 3 == 0 else f"some plain words number {i} in a line " * 3) for i in range(300)]
    rows += [(400, None), (401, ""), (402, "x " * 200_000), (None, "null id"), (5, rows[5][1]), (5, rows[5][1])]
    labels = [(i, 0 if i % 3 == 0 else 1, 0) for i in range(300)] + [(400, None, 0), (None, 1, 0), (5, 1, 1), (9999, 1, 0), (1, 7, 0)]
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = clashing(docs_of(rows), "_row", "_text", "_s_upper", "quality")
    model = quality.fit(df, marked)
    scored = quality.score_quality(df, model)
    assert scored.columns == [*df.columns, "score"]
    got = scored.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[400] == by[401]
    assert np.mean([(by[i] >= 0.5) == (i % 3 != 0) for i in range(300)]) == 1
    assert quality.score_quality(docs_of([]), model).count() == 0


def test_too_little_to_learn(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(docs_of([(1, "a")]), none)
    assert model.rules == [] and [r.score for r in quality.score_quality(docs_of([(1, "a")]), model).collect()] == [0.5]
    one = spark.createDataFrame([(i, 1) for i in range(90)], "doc_id long, quality int")
    model = quality.fit(docs_of([(i, "a") for i in range(90)]), one)
    assert model.rules == [] and quality.score_quality(docs_of([(1, "a")]), model).first().score > 0.9


def test_lasso_drops_useless_rules():
    random = np.random.default_rng(1)
    x = random.random((800, 5))
    y = (x[:, 2] > 0.6).astype(float)
    model = quality.fit_rules(x, y, list("abcde"))
    p = 1 / (1 + np.exp(-(model.bias + sum(w * quality.holds(r, x, list("abcde")) for w, r in model.rules))))
    assert ((p >= 0.5) == y).mean() > 0.97
    assert len(model.rules) < 60
