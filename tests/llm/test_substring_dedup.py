import hashlib
import random
import re
from collections import Counter

import pytest
from llm_fixtures import clashing, docs_of  # noqa: F401

from mortar.llm import substring_dedup as sd

WORDS = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window):
    texts = [WORDS.findall(t or "") for _, t in rows]
    often = Counter(tuple(w[s : s + window]) for w in texts for s in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, texts):
        gone = {s + j for s in range(len(w) - window + 1) if often[tuple(w[s : s + window])] > 1 for j in range(window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def result(df, window):
    got = sd.substring_dedup(df, window=window)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"]
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got.collect())


def cases(seed, window):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefgh") + str(rnd.randint(0, 60))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, short = text(window + 7), text(window - 1)
    rows = [(i, text(rnd.randint(0, 120))) for i in range(40)]
    rows += [(100 + i, f"{text(rnd.randint(0, 30))}\n{shared}\t {text(rnd.randint(0, 30))}") for i in range(12)]
    rows += [(200 + i, f"{text(9)} {short} {text(9)}") for i in range(5)]
    rows += [(300, "same " * (3 * window)), (301, "ab cd " * window), (302, text(window)), (303, None), (304, ""), (305, " \n "), (306, None)]
    rows += [(400, rows[2][1]), (401, rows[2][1]), (402, "Ünïcödé " + shared + "　x")]
    rows += [(500, text(60))] * 2 + [(None, shared), (None, text(70)), (500, text(60))]
    return rows


@pytest.mark.parametrize("seed,window", [(1, 35), (2, 35), (3, 5), (4, 2), (5, 1)])
def test_against_brute_force(docs_of, seed, window):
    rows = cases(seed, window)
    assert result(docs_of(rows), window) == brute(rows, window)


def test_long_texts_in_small_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(sd, "UNIT_BYTES", 400)
    monkeypatch.setattr(sd, "UNIT_WORDS", 50)
    rnd = random.Random(9)
    text = lambda n: " ".join(str(rnd.randint(0, 10**6)) for _ in range(n))
    shared = text(80)
    rows = [(1, text(900) + " " + shared + " " + text(500)), (2, shared + " " + text(700)), (3, text(40) + " " + shared)]
    assert result(docs_of(rows), 35) == brute(rows, 35)


def test_empty_table_and_clashing_columns(docs_of, clashing):
    assert sd.substring_dedup(docs_of([])).count() == 0
    rows = cases(7, 35)
    df = clashing(docs_of(rows), "_id", "_text", "_k", "hashes", "_row", "kept", "n_words", "starts")
    assert result(df, 35) == brute(rows, 35)


def test_windows_are_hashed_by_their_words():
    import numpy as np

    words = np.arange(1, 200, dtype=np.uint64)
    twice = np.concatenate([words, words])
    for n in (1, 2, 3, 9, 18, 35):
        h = sd.window_hashes(twice, n)
        assert len(h) == len(twice) - n + 1
        assert (h[: 199 - n + 1] == h[199 : 199 + 199 - n + 1]).all()
        assert len(set(h.tolist())) == 199 if n > 1 else True
