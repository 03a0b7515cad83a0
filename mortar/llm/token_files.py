"""Token ids in files: fixed-width bit packing in blocks with offsets.

A token table is a folder of Parquet files whose rows are blocks. A block holds whole
documents in order, every id in ``width`` bits (the fewest that hold the vocabulary), least
bit first, without gaps. Beside the packed ids it has the ids of its documents and where each
starts, so a block is unpacked in one vectorised step and one document by its own bits alone:

    part, block           place in the order: part by part, block by block
    first                 ids in the part before this block
    n_ids, width          ids in the block, bits of an id
    doc_min, doc_max      smallest and largest document id, for pruning
    doc_ids, doc_starts   the documents and where in the block each starts
    payload               the packed ids
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import text_or_empty
from .tokens import encode_text, pieces_of

BLOCK_IDS = 1 << 18


def width_of(vocabulary: int) -> int:
    """The fewest bits that hold the ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    ids = ids.astype("<u4")
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, start: int, n: int) -> np.ndarray:
    """``n`` ids from place ``start`` on; only their own bytes are touched."""
    if width in (8, 16, 32):
        return np.frombuffer(payload, dtype=f"<u{width // 8}", count=n, offset=start * width // 8).astype("<u4")
    first, last = start * width, (start + n) * width
    near = np.frombuffer(payload, dtype=np.uint8)[first // 8 : (last + 7) // 8]
    bits = np.unpackbits(near, bitorder="little")[first % 8 : first % 8 + n * width].reshape(n, width)
    whole = np.zeros((n, 32), dtype=np.uint8)
    whole[:, :width] = bits
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").reshape(-1)


def block_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("first", T.LongType()),
            T.StructField("n_ids", T.LongType()),
            T.StructField("width", T.IntegerType()),
            T.StructField("doc_min", id_type),
            T.StructField("doc_max", id_type),
            T.StructField("doc_ids", T.ArrayType(id_type)),
            T.StructField("doc_starts", T.ArrayType(T.LongType())),
            T.StructField("payload", T.BinaryType()),
        ]
    )


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    vocabulary: int,
    end_id: int | None,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = BLOCK_IDS,
    words: bool | None = None,
) -> str:
    """Encode whole texts and write them in ascending order of ``id_col``; returns the folder.

    The folder lies in the shared checkpoint folder unless ``path`` names one. ``words``
    tells the kind of vocabulary (see ``tokens.pieces_of``). Documents are
    range-partitioned by (id, text hash), so repeated ids spread as well; each task encodes
    its range in order and cuts blocks of about ``block_ids`` ids, whole documents each.
    Defined results: a null text is empty and has the end id alone (nothing without one);
    null ids come first; rows that repeat an id lie side by side, ordered by a hash of their
    text; an empty table gives a folder without blocks.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "llm-tokens")
    width = width_of(vocabulary)
    schema = block_schema(docs.schema[id_col].dataType)
    end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, arrow = pieces_of(tokenizer_path, words), None
        part, block, first = TaskContext.get().partitionId(), 0, 0
        ids: list[bytes] = []
        names: list = []
        starts: list[int] = []
        n = 0

        def close() -> pa.RecordBatch:
            known = [x for x in names if x is not None]
            row = [part, block, first, n, width, min(known, default=None), max(known, default=None), names, starts, pack(np.frombuffer(b"".join(ids), dtype="<u4"), width)]
            return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(row, arrow)], names=schema.names)

        for batch in batches:
            kind = batch.schema.field(0).type
            arrow = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), kind, kind, pa.list_(kind), pa.list_(pa.int64()), pa.binary()]
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = encode_text(text, pieces) + end
                ids.append(got)
                names.append(name)
                starts.append(n)
                n += len(got) // 4
                if n >= block_ids:
                    yield close()
                    block, first = block + 1, first + n
                    ids, names, starts, n = [], [], [], 0
        if names:
            yield close()

    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text_or_empty(F.col(f"`{text_col}`")).alias("_text"))
    order = [F.col("_id").asc_nulls_first(), F.xxhash64("_text")]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(blocks, schema).write.parquet(path)
    return path


def read_token_index(spark: SparkSession, path: str, digest=zlib.crc32) -> DataFrame:
    """Unpack every block: a row for each document with ``doc_id``, ``start``, ``n_tokens`` and ``ids_digest``.

    ``start`` counts all ids before the document in the whole table. Only the length of each
    part, as many rows as partitions wrote, is summed on the driver.
    """
    blocks = spark.read.parquet(path)
    lengths = sorted(tuple(r) for r in blocks.groupBy("part").agg(F.sum("n_ids")).collect())
    before, total = [], 0
    for part, n in lengths:
        before.append((part, total))
        total += n
    offsets = spark.createDataFrame(before, "part int, before long")
    id_type = blocks.schema["doc_min"].dataType
    schema = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("doc_id", id_type), T.StructField("_at", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_digest", T.LongType())]
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("doc_ids").type.value_type
            for r in batch.to_pylist():
                starts = np.array([*r["doc_starts"], r["n_ids"]], dtype=np.int64)
                lengths = np.diff(starts)
                ids = unpack(r["payload"], r["width"], 0, r["n_ids"])
                digests = [digest(ids[a:b].tobytes()) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                n = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["part"]] * n, pa.int32()), pa.array(r["doc_ids"], kind), pa.array(starts[:-1] + r["first"]), pa.array(lengths), pa.array(digests, pa.int64())],
                    names=schema.names,
                )

    needed = blocks.select("part", "first", "n_ids", "width", "doc_ids", "doc_starts", "payload")
    found = needed.mapInArrow(documents, schema)
    # one row for each partition that wrote: far below any broadcast limit
    return found.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("_at")).alias("start"), "n_tokens", "ids_digest"
    )


def read_document(spark: SparkSession, path: str, doc_id) -> list[np.ndarray]:
    """Random access: the ids of the documents of this id, from their blocks alone."""
    blocks = spark.read.parquet(path).where((F.col("doc_min") <= F.lit(doc_id)) & (F.col("doc_max") >= F.lit(doc_id)))
    found = []
    for r in blocks.where(F.array_contains("doc_ids", F.lit(doc_id))).orderBy("part", "block").toLocalIterator():
        starts = [*r["doc_starts"], r["n_ids"]]
        found += [unpack(r["payload"], r["width"], a, b - a) for name, a, b in zip(r["doc_ids"], starts, starts[1:]) if name == doc_id]
    return found
