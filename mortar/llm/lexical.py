"""Ranked lexical search by an Aho-Corasick scan of the documents.

No index of the documents is built. The terms of a block of items form one automaton whose
patterns carry a guard on both sides, so that only whole terms match; it is broadcast as a
bounded list of terms and built in each worker. A first scan counts documents, lengths and
document frequencies; a second counts the term frequencies again, straight from the text, maps
the automaton's outputs to the items that hold them, and keeps each task's best ``k`` documents of
every item. What is shuffled is a number a term and ``k`` rows an item from each task.
"""

from __future__ import annotations

import functools
import heapq
import math
import uuid
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rank import prefix_scan
from .common import text_or_empty, worker_cache, write_scratch

#: What a term is made of, byte by byte: ASCII letters (lower-cased) and digits, and all beyond ASCII.
GUARD = b" "
FOLD = bytes(i + 32 if 65 <= i <= 90 else i if i >= 128 or 48 <= i <= 57 or 97 <= i <= 122 else 32 for i in range(256))
#: A long text is scanned in pieces of about so many bytes, cut at guards.
PIECE_BYTES = 1 << 20
#: Terms of items of so many bytes share an automaton; a larger item has one of its own.
BLOCK_BYTES = 8 << 20
#: Fixed values of the score: scale of a term's weight, of its saturation, and the length share in percent.
WEIGHT, GAIN, FLAT, SLOPE = 1000, 1_000_000_000, 25, 75
#: Groups that each item's candidates are thinned in before they meet.
SALTS = 1024

_OUTPUT = itemgetter(1)


def pieces(text: bytes) -> Iterator[bytes]:
    """The folded text between guards, in pieces that end where a term ends."""
    folded = text.translate(FOLD)
    begin = 0
    while len(folded) - begin > PIECE_BYTES:
        end = folded.find(GUARD, begin + PIECE_BYTES)
        if end < 0:
            break
        yield folded[begin:end]
        begin = end
    yield folded[begin:]


def terms_of(text: bytes) -> Counter:
    found: Counter = Counter()
    for piece in pieces(text):
        found.update(piece.split())
    return found


def automaton_of(terms: list[bytes]):
    """Each term with a guard before and after it; its output is its place in ``terms``."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        automaton.add_word((GUARD + term + GUARD).decode("latin-1"), i)
    automaton.make_automaton()
    return automaton


def worker_automaton(key: str, terms: list[bytes]):
    """The automaton of this worker for one block of items; the one before it is let go."""
    cache = worker_cache()
    if cache.get("lexical", ("",))[0] != key:
        cache["lexical"] = (key, automaton_of(terms))
    return cache["lexical"][1]


def scan(text: bytes, automaton) -> tuple[int, Counter]:
    """(number of terms, places of the automaton's terms with how often each occurs)."""
    n, found = 0, Counter()
    for piece in pieces(text):
        n += len(piece.split())
        found.update(map(_OUTPUT, automaton.iter((GUARD + piece + GUARD).decode("latin-1"))))
    return n, found


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, term, reps, block): an item's terms with their repeats, and the block of items it is in."""
    source = items.select(F.col(f"`{item_col}`").alias("item"), text_or_empty(F.col(f"`{text_col}`")).cast("binary").alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = terms_of(text)
                if found:
                    item = batch.column("item").slice(i, 1).take(pa.array([0] * len(found)))
                    yield pa.RecordBatch.from_arrays([item, pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["item", "term", "reps"])

    schema = T.StructType([T.StructField("item", source.schema["item"].dataType), T.StructField("term", T.BinaryType()), T.StructField("reps", T.LongType())])
    found = write_scratch(source.mapInArrow(split, schema).groupBy("item", "term").agg(F.sum("reps").alias("reps")), "item-terms")
    sizes = found.groupBy("item").agg(F.sum(F.octet_length("term") + 8).alias("size"))
    ends = prefix_scan(sizes, [], ["item"], sums={"up_to": "size"})
    # an item goes to the block that its first byte falls into
    blocks = ends.select(F.col("item").alias("_item"), F.floor((F.col("up_to") - F.col("size")) / BLOCK_BYTES).cast("long").alias("block"))
    return found.join(blocks, found["item"].eqNullSafe(blocks["_item"])).drop("_item")


def corpus_counts(docs: DataFrame, key: str, terms) -> tuple[int, int, np.ndarray]:
    """(documents with a term, terms in all, document frequencies): one scan, a sum a task and term."""
    n_terms = len(terms.value)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = worker_automaton(key, terms.value)
        df = np.zeros(n_terms + 2, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text"):
                n, found = scan(text.as_py(), automaton)
                if n:
                    df[-2] += 1
                    df[-1] += n
                    df[np.fromiter(found, dtype=np.int64, count=len(found))] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["at", "n"])

    sums = docs.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    df = np.zeros(n_terms + 2, dtype=np.int64)
    for at, n in sums.collect():  # a row for each term of this block and two more
        df[at] = n
    return int(df[-2]), int(df[-1]), df[:-2]


class Best:
    """The ``k`` best documents of each item that a task has seen; ties go to the smaller id, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n_items)]
        self.floor = np.ones(n_items, dtype=np.int64)

    def add(self, doc_id: int | None, scores: np.ndarray) -> None:
        for item in np.flatnonzero(scores >= self.floor).tolist():
            heap = self.heaps[item]
            entry = (int(scores[item]), -math.inf if doc_id is None else -doc_id)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.floor[item] = heap[0][0]

    def batch(self) -> pa.RecordBatch:
        rows = [(i, score, None if neg == -math.inf else -neg) for i, heap in enumerate(self.heaps) for score, neg in heap]
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["at", "score", "doc_id"])


def rank_block(docs: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """(item, doc_id, score): candidates for the items of one block, thinned to ``k`` an item, task and salt."""
    spark = docs.sparkSession
    rows = block.select("item", "term", "reps").toArrow()  # bounded by BLOCK_BYTES and one item
    terms, term_at = np.unique(np.array(rows.column("term").to_pylist(), dtype=object), return_inverse=True)
    names = rows.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
    item_at = np.asarray(names.indices)
    order = np.argsort(item_at, kind="stable")
    post_term, post_reps = term_at[order], np.asarray(rows.column("reps"))[order]
    first = np.searchsorted(item_at[order], np.arange(len(names.dictionary)))

    key = uuid.uuid4().hex
    sent = spark.sparkContext.broadcast(terms.tolist())
    n_docs, total, df = corpus_counts(docs, key, sent)
    weight = np.array([math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64)
    model = spark.sparkContext.broadcast((weight, post_term, post_reps, first))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = worker_automaton(key, sent.value)
        weight, post_term, post_reps, first = model.value
        best, gains = Best(len(first), k), np.zeros(len(weight), dtype=np.int64)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                n, found = scan(text.as_py(), automaton)
                if not found:
                    continue
                at = np.fromiter(found, dtype=np.int64, count=len(found))
                tf = np.fromiter(found.values(), dtype=np.int64, count=len(found))
                m = FLAT + SLOPE * n * n_docs // total
                gains[at] = weight[at] * (GAIN * tf // (1000 * tf + 8 * m))
                best.add(doc_id, np.add.reduceat(gains[post_term] * post_reps, first))
                gains[at] = 0
        yield best.batch()

    found = docs.mapInArrow(search, "at int, score long, doc_id long")
    by_salt = Window.partitionBy("at", "_salt").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    thinned = (
        found.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        .withColumn("_place", F.row_number().over(by_salt))
        .where(F.col("_place") <= k)
    )
    item_type = block.schema["item"].dataType
    known = spark.createDataFrame(
        list(enumerate(names.dictionary.to_pylist())), T.StructType([T.StructField("at", T.IntegerType()), T.StructField("item", item_type)])
    )
    return thinned.join(F.broadcast(known), "at").select("item", "doc_id", "score")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 10,
) -> DataFrame:
    """The ``k`` best documents of each item: (item, rank, doc_id, score), the item under its own name.

    Integer BM25 as the registered query defines it. Defined results: null and empty texts
    have no term, so such documents are never found and such items have no rows; rows that
    share an item id, null ids among them, are one item with all their terms; rows that share
    a document id are documents of their own, each with a rank; among equal scores the
    smaller id comes first and null ids last; empty tables give an empty result; other
    columns are left alone. Document ids are whole numbers. Texts of any length are scanned
    in pieces of 1 MB.

    Items are taken in blocks of at most 8 MB of terms (or one larger item), each a broadcast
    of that size and two scans of the documents.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(F.col(f"`{text_col}`")).cast("binary").alias("text"))
    terms = write_scratch(item_terms(items, item_col, item_text_col), "item-blocks")
    last = terms.agg(F.max("block")).first()[0]
    blocks = [] if last is None else [b for b in range(last + 1)]
    found = [rank_block(narrow, part, k) for b in blocks if not (part := terms.where(F.col("block") == b)).isEmpty()]
    if not found:
        empty = T.StructType([T.StructField("item", terms.schema["item"].dataType), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
        found = [spark.createDataFrame([], empty)]
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    candidates = functools.reduce(DataFrame.unionByName, found)
    return candidates.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("item").alias(item_col), "rank", "doc_id", "score")
