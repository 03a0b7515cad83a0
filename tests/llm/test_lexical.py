"""Ranked lexical search against a plain count of every document."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from llm_fixtures import clashing, docs_of  # noqa: F401
from mortar.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    asked = {}
    for item, text in items:
        asked.setdefault(item, []).extend(terms(text))
    out = []
    for item, words in asked.items():
        found = []
        for i, c, n in held:
            m = 100 - 75 + 75 * n * n_docs // total
            score = 0
            for w in words:
                tf = c[w]
                df = sum(1 for _, other, _ in held if w in other)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (1000000000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def got(docs, items, **more):
    return sorted(map(tuple, lexical.rank_documents(docs, items, **more).collect()), key=repr)


def corpus(seed=1, n=120):
    rnd = random.Random(seed)
    words = ["the", "The", "an", "and", "ant", "éa", "É", "zu", "x1", "1", "日本", "naïve", "a" * 40] + [f"w{i}" for i in range(30)]
    seps = [" ", "  ", ", ", "\n", "-", "", "\x00", "."]
    text = lambda n: "".join(rnd.choice(words) + rnd.choice(seps) for _ in range(n))
    docs = [(i, text(rnd.randint(0, 60))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(15)]  # copies: equal scores
    docs += [(n + 50, None), (n + 51, ""), (n + 52, " ,.\n"), (5, docs[3][1]), (None, docs[3][1]), (None, docs[4][1])]
    items = [(i, text(rnd.randint(1, 25))) for i in range(12)] + [(50, None), (51, ""), (52, "..."), (3, "the the ant"), (None, "naïve zu"), (None, "éa")]
    return docs, items


def test_matches_brute_force(spark, docs_of):
    docs, items = corpus()
    assert got(docs_of(docs, 7), items_of(spark, items)) == brute(docs, items)


def test_long_texts_are_scanned_in_pieces(spark, docs_of, monkeypatch):
    docs, items = corpus(2, 30)
    docs.append((1000, " ".join(t or "" for _, t in docs) * 3))
    docs.append((1001, "q" * 5000 + " the"))
    monkeypatch.setattr(lexical, "PIECE_BYTES", 64)
    assert got(docs_of(docs), items_of(spark, items)) == brute(docs, items)


def test_blocks_of_items(spark, docs_of, monkeypatch):
    docs, items = corpus(3, 25)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 250)
    parts = lexical.item_terms(items_of(spark, items), "item_id", "text").select("block").distinct().count()
    assert parts > 2
    assert got(docs_of(docs), items_of(spark, items)) == brute(docs, items)


def test_only_whole_terms_count():
    terms_, text = [b"an", b"and", b"nd", b"and1"], b"AND band an-and  nd,an1 and"
    n, found = lexical.scan(text, lexical.automaton_of(terms_))
    assert n == 7 and found == {0: 1, 1: 3, 2: 1}


def test_fewer_documents_than_k_and_k_of_one(spark, docs_of):
    docs, items = [(1, "the ant"), (2, "ant"), (3, "bee")], [(1, "ant bee"), (2, "none")]
    assert got(docs_of(docs), items_of(spark, items)) == brute(docs, items)
    assert got(docs_of(docs), items_of(spark, items), k=1) == brute(docs, items, 1)


def test_empty_tables_and_further_columns(spark, docs_of, clashing):
    docs, items = corpus(4, 20)
    assert got(docs_of([]), items_of(spark, items)) == []
    assert got(docs_of(docs), items_of(spark, [])) == []
    assert got(docs_of([(1, None), (2, "")]), items_of(spark, items)) == []
    wide = clashing(docs_of(docs), "at", "score", "item", "rank", "item_id", "term")
    more = clashing(items_of(spark, items), "item", "term", "reps", "block", "doc_id", "score")
    assert got(wide, more) == brute(docs, items)


def test_item_ids_of_another_type(spark, docs_of):
    docs, items = corpus(5, 20)
    named = items_of(spark, items).select(F.col("item_id").cast("string").alias("name"), F.col("text").alias("body"))
    out = lexical.rank_documents(docs_of(docs), named, item_col="name", item_text_col="body")
    assert out.columns == ["name", "rank", "doc_id", "score"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(((None if i is None else str(i), *r) for i, *r in brute(docs, items)), key=repr)
