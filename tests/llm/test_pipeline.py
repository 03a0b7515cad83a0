import zlib

import corpus_pipeline
import numpy as np
import pytest
from llm_fixtures import SF_SMALL, clashing, docs_of  # noqa: F401
from pyspark.sql import functions as F

from mortar.llm.common import write_scratch

SF_MID = "/root/testdata/sf0.01"


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact dedup", "near dedup", "personal data", "packing"]


@pytest.fixture(scope="module")
def steps(spark):
    """The documents that each stage leaves, and the packed pieces."""
    docs, out = spark.read.parquet(f"{SF_MID}/documents.parquet"), []
    out.append(docs)
    for _, f in corpus_pipeline.STAGES:
        docs = write_scratch(f(spark, docs, SF_MID), "test-stage")
        out.append(docs)
    return out


def test_all_but_the_last_return_documents(steps):
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_quality_drops_what_labels_mark(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[1].select("doc_id").collect()}
    bad, good = [i for i, q in labels.items() if q == 0], [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) / len(good) >= 0.98
    assert sum(i in kept for i in bad) / len(bad) <= 0.1


def test_one_document_of_each_text_stays(steps):
    before = {}
    for r in steps[1].collect():
        before.setdefault(r.text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), []).append(r.doc_id)
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(max(ids) for ids in before.values())


def test_one_document_of_each_component_stays(steps):
    from test_simhash import brute_components, brute_fingerprint

    found = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in steps[2].collect()])
    assert sorted(r.doc_id for r in steps[3].collect()) == sorted({c for _, _, c in found})


def test_personal_data_is_masked_and_the_rest_stays(steps):
    from test_pii import brute

    before = {r.doc_id: r for r in steps[3].collect()}
    after = {r.doc_id: r for r in steps[4].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert brute(r.text) == "" and r.n_chars == len(r.text)
        if not brute(before[i].text) and "token" not in before[i].text.lower():
            assert r == before[i]


def test_packing_holds_every_document(steps):
    got = steps[5].groupBy("doc_id").agg(F.count(F.lit(1))).count()
    assert got == steps[4].count()


def test_packed_sequences_hold_the_tokens_of_the_masked_texts(steps):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    pieces, sequences = {}, {}
    for r in steps[5].collect():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces.setdefault(r.doc_id, []).append((r.piece, np.frombuffer(r.ids, "<u4").tolist()))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, text in texts.items():
        ids = [x for _, part in sorted(pieces[i]) for x in part]
        assert ids == [*library.encode(text, add_special_tokens=False).ids, 2]
        assert library.decode(ids[:-1], skip_special_tokens=False) == text
    for parts in sequences.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 1024


def test_run(spark):
    packed = corpus_pipeline.run(spark, SF_SMALL)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset"] and packed.count() > 0


def test_stages_on_edge_cases(spark, docs_of, clashing):
    """Nulls, repeated rows, further columns and an empty table go through every stage."""
    rows = [(1, None), (2, ""), (3, "some plain words here"), (3, "some plain words here"), (None, "no id but words"), (4, "mail me@you.org now"), (5, "x " * 60_000)]
    for df in (docs_of(rows), docs_of([])):
        docs = clashing(df.withColumn("n_chars", F.lit(None).cast("bigint")), "kept", "_score", "fp", "_row", "spans", "_kept")
        names = docs.columns
        for _, f in corpus_pipeline.STAGES[:-1]:
            docs = write_scratch(f(spark, docs, SF_SMALL), "test-stage")
            assert docs.columns == names
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() >= docs.count()
