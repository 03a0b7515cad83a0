import hashlib

import pytest
from llm_fixtures import clashing, docs_of  # noqa: F401
from pyspark.sql import functions as F

from mortar.llm.exact_dedup import drop_copies, exact_dedup

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOW), []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        top, seen = max(known, default=None), False
        for i in ids:
            out.append((i, top, len(ids), i == top and not seen, hashlib.sha256(t.encode()).hexdigest()))
            seen = seen or i == top
    return sorted(out, key=str)


ROWS = [
    (1, "Same Text"), (2, "same text"), (3, "SAME TEXT"), (9, "same  text"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, "İ K"),
    (10, "É a"), (11, "É A"), (None, "nobody"), (None, "Nobody"), (12, "twice"), (12, "twice"), (12, "Twice"), (13, "x" * 300_000), (14, "X" * 300_000),
    *[(100 + i, "hot copy") for i in range(200)],
]


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_digest").collect()), key=str)


def test_against_brute_force(docs_of):
    assert result(exact_dedup(docs_of(ROWS))) == brute(ROWS)


def test_one_salt_and_many_give_the_same(docs_of):
    df = docs_of(ROWS)
    assert result(exact_dedup(df, salts=1)) == result(exact_dedup(df, salts=60))


def test_empty_table(docs_of):
    assert exact_dedup(docs_of([])).count() == 0


def test_clashing_columns_stay_out_of_the_way(docs_of, clashing):
    names = ["_digest", "_salt", "_text", "_id", "_c0", "keep_id", "kept"]
    df = clashing(docs_of(ROWS), *names)
    assert result(exact_dedup(df)) == brute(ROWS)
    kept = drop_copies(df)
    assert kept.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(i) for i, _, _, k, _ in brute(ROWS) if k)
    assert {r.kept for r in kept.collect()} == {"x"}


def test_a_shared_digest_stops_the_job(docs_of):
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 0)
    with pytest.raises(Exception, match="two texts share the digest"):
        exact_dedup(docs_of([(1, "a"), (2, "b")]), digest=weak).collect()


def test_a_shared_digest_stops_the_job_whatever_columns_are_read(docs_of):
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 0)
    df = docs_of([(1, "a"), (2, "b")])
    marked = exact_dedup(df, digest=weak)
    for found in (drop_copies(df, digest=weak), marked.select("kept"), marked.select("keep_id"), marked.select("text_digest"), marked.select("text")):
        with pytest.raises(Exception, match="two texts share the digest"):
            found.collect()


def test_no_python_in_the_plan(docs_of):
    plan = exact_dedup(docs_of(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
