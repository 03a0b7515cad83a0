import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import SF_SMALL, clashing, docs_of  # noqa: F401

from mortar.llm import bpe
from mortar.llm.queries import QUERIES

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = ["", " ", "  a  b ", "don't 'stuff'  \n<|endoftext|>", "ÀÉ İ ß ﬁ", "a b 　 c\x1cd \x85e", "'s" * 50, "\n" * 40 + "z", "word " * 900, "x" * 3000, "naïve 12 345!!  ok\t\t"]


@pytest.fixture(scope="module")
def enc():
    return bpe.encoder(PATH, PATTERN)


def flat(piece):
    return [i for run in piece.ids for i in run.tolist()]


@pytest.mark.parametrize("leaf", [1, 2, 7, 500])
def test_tree_equals_library(enc, leaf):
    for t in TEXTS:
        assert flat(bpe.reduce_tree(t[:600], enc.encode_ordinary, leaf)) == enc.encode_ordinary(t[:600])


def test_tree_on_random_texts(enc):
    rnd = random.Random(5)
    for _ in range(800):
        t = "".join(rnd.choice(["a", "B", " ", "  ", "\n", "1", "!", "'s", "'", "é", "\x1c", " ", "'ll", "xy "]) for _ in range(rnd.randint(0, 40)))
        for leaf in (1, 3):
            assert flat(bpe.reduce_tree(t, enc.encode_ordinary, leaf)) == enc.encode_ordinary(t)


def test_join_is_associative(enc):
    parts = ["foo ba", "r ba", "", "z  ", " qux's", "' end"]
    leaves = lambda: [bpe.leaf(p, enc.encode_ordinary) for p in parts]
    left = leaves()
    while len(left) > 1:
        left[:2] = [bpe.join(left[0], left[1], enc.encode_ordinary)]
    right = leaves()
    while len(right) > 1:
        right[-2:] = [bpe.join(right[-2], right[-1], enc.encode_ordinary)]
    assert flat(left[0]) == flat(right[0]) == flat(bpe.fold(leaves(), enc.encode_ordinary)) == enc.encode_ordinary("".join(parts))


@pytest.mark.parametrize("segment", [1 << 20, 50])
def test_round_trip_over_the_cluster(docs_of, clashing, enc, segment):
    """Segments of 50 characters send most texts through the distributed tree."""
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (None, "no id " * 30), (7, TEXTS[7]), (8, "another text under id 8 " * 9)]
    df = clashing(docs_of(rows), "ids", "_text", "_k0", "_same", "_at")
    got = bpe.decode(bpe.encode(df, PATH, PATTERN, ["doc_id"], segment_chars=segment), PATH).collect()
    seen = sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded).decode()) for r in got)
    assert seen == sorted((str(i), enc.encode_ordinary(t or ""), t or "") for i, t in rows)


def test_empty_table(docs_of):
    assert bpe.encode(docs_of([]), PATH, PATTERN, ["doc_id"]).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    enc = bpe.encoder(PATH, PATTERN)
    got = QUERIES["op4_byte_bpe"](spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = enc.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
