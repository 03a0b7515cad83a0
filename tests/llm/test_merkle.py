"""Merkle manifest against a plain tree built in memory."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from llm_fixtures import clashing  # noqa: F401
from mortar.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    names = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    built = {}
    for name in names:
        own = sorted(trees[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built[name] = (own, levels_of([leaf(r) for r in own]))
    upper = levels_of([built[n][1][-1][0] for n in names])
    out = []
    for t, name in enumerate(names):
        own, tree = built[name]
        for i, r in enumerate(own):
            text = r[4].translate(str.maketrans(UP, LOW)) if r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else r[4]
            folded, proof = leaf((*r[:4], text)), []
            for nodes, at in ((tree, i), (upper, t)):
                for level in nodes[:-1]:
                    run = level[at // 8 * 8 : at // 8 * 8 + 8]
                    proof += run[: at % 8] + run[at % 8 + 1 :]
                    folded, at = h(*run[: at % 8], folded, *run[at % 8 + 1 :]), at // 8
            root = upper[-1][0]
            out.append((r[0], leaf(r), tree[-1][0], root, h(*proof), folded, folded == root))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, merkle.verify_rows(df, {"text": merkle.tampered(df)}).collect()), key=repr)


def rows_of(n, langs=("en", "de", None, "é", "zz")):
    return [(i, ["a", None, "b:c"][i % 3], langs[(i * i) % 7 % len(langs)], None if i % 11 == 5 else i, None if i % 13 == 4 else f"Text Ä {i}" * (i % 4)) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 70, 600])
def test_matches_brute_force(spark, n):
    rows = rows_of(n)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


def test_one_language_and_many(spark):
    one = rows_of(65, ("en",))
    assert got(spark.createDataFrame(one, SCHEMA)) == brute(one)
    many = rows_of(150, tuple(f"l{i}" for i in range(7)))
    many += [(1000 + i, "s", f"x{i}", i, "T") for i in range(70)]  # an upper tree of three levels, of lone leaves mostly
    assert got(spark.createDataFrame(many, SCHEMA)) == brute(many)


def test_high_runs_are_stored_by_block(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = rows_of(300) + [(900 + i, "s", f"x{i}", i, "T") for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == brute(rows)
    manifest = merkle.build(merkle.leaf_rows(df, merkle.LEAF_COLUMNS, "doc_id", "lang", {}))
    assert manifest.leaves.groupBy("tree", "block").count().agg(F.max("count")).first()[0] <= 16
    assert manifest.runs.groupBy("tree", "block", "node").count().agg(F.max("count")).first()[0] == 1


def test_null_and_repeated_ids(spark):
    rows = [(None, "s", "en", 1, "A"), (None, "s", "en", 1, "B"), (None, None, None, None, None), (3, "s", "en", 1, "A"), (3, "s", "en", 1, "A"), (3, "s", "en", 2, "Z")]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_untampered_rows_verify_and_empty_table(spark):
    df = spark.createDataFrame(rows_of(90), SCHEMA)
    assert {r["verified"] for r in merkle.verify_rows(df, {}).collect()} == {True}
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_further_columns_and_the_recursion_limit(spark, clashing):
    rows = rows_of(40)
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    names = ("tree", "idx", "n", "t", "level", "leaf", "id", "block", "node", "candidate")
    assert got(clashing(spark.createDataFrame(rows, SCHEMA), *names)) == brute(rows)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
