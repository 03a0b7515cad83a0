"""Best-fit packing of documents into sequences: best-two-fit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, text_or_empty, write_scratch
from .tokens import encode_text, pieces_of

CAPACITY = 1024
#: Pieces packed together in one task. Larger shards don't pack better: with 1,024 lengths,
#: what a shard loses is its last few sequences.
SHARD_PIECES = 100_000


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: full ones, but the first may be shorter."""
    first = n - (max(1, -(-n // capacity)) - 1) * capacity
    starts = [0, *range(first, n, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: bool | None = None,
) -> DataFrame:
    """Encode whole texts, end each with ``end_id`` and cut longer ones: a row for each piece.

    Returns doc_id, piece, start, length and ids (little-endian unsigned 32-bit). A null text
    is empty and has the end id alone; rows that repeat an id each give their pieces; no other
    column is looked at.
    """
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]
    )
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = pieces_of(tokenizer_path, words)
        for batch in batches:
            kind = batch.schema.field(0).type
            rows: list[tuple] = []
            size = 0
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode_text(text, memory) + end
                rows += [(name, i, a, n, ids[4 * a : 4 * (a + n)]) for i, (a, n) in enumerate(cut(len(ids) // 4, capacity))]
                size += len(ids)
                if size > 1 << 23:
                    yield batch_of(rows, kind)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows, kind)

    def batch_of(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        kinds = [kind, pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=schema.names)

    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text_or_empty(F.col(f"`{text_col}`")).alias("_text"))
    return rows.mapInArrow(pieces, schema)


def best_pair(target: int, stock: list[int], bits: int) -> tuple[int, int]:
    """Two lengths in stock whose sum is the largest up to ``target``; (0, 0) without such."""
    best = (0, 0)
    # the larger of the two runs down from the target; the smaller one fills up what is left
    low = bits & ((2 << target) - 1)
    while low:
        a = low.bit_length() - 1
        if 2 * a <= sum(best):
            break
        low ^= 1 << a
        rest = min(target - a, a)
        under = bits & ((2 << rest) - 1)
        b = under.bit_length() - 1
        if b == a and stock[a] < 2:
            b = (under ^ (1 << b)).bit_length() - 1
        if b > 0 and a + b > sum(best):
            best = (a, b)
            if a + b == target:
                break
    return best


def best_two_fit(counts: dict[int, int], capacity: int) -> list[list[int]]:
    """Pack lengths 1 .. ``capacity``, given as length -> count, into bins.

    A bin is filled greedily, always with the largest document that fits. If a gap is left,
    its smallest document goes back if two that are still unpacked fill the widened gap
    better. ``bits`` marks the lengths in stock.
    """
    stock = [0] * (capacity + 1)
    bits = 0
    for n, k in counts.items():
        stock[n] += k
        bits |= 1 << n

    def take(n: int) -> None:
        nonlocal bits
        stock[n] -= 1
        if not stock[n]:
            bits ^= 1 << n

    def give(n: int) -> None:
        nonlocal bits
        stock[n] += 1
        bits |= 1 << n

    bins = []
    while bits:
        gap, held = capacity, []
        while fits := bits & ((2 << gap) - 1):
            n = fits.bit_length() - 1
            take(n)
            held.append(n)
            gap -= n
        if gap and bits and len(held) > 1:
            smallest = held[-1]
            a, b = best_pair(gap + smallest, stock, bits)
            if a + b > smallest:
                take(a)
                take(b)
                give(smallest)
                held[-1:] = [a, b]
        bins.append(held)
    return bins


def pack(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length", shard_pieces: int = SHARD_PIECES, carried: Sequence[str] = ()) -> DataFrame:
    """Pack rows into as few sequences of ``capacity`` as best-two-fit finds.

    Adds ``sequence_id`` (long) and ``offset`` (long, gapless from 0 in each sequence). Rows of
    full length have a sequence of their own and need no packing. The others are dealt evenly
    into shards of about ``shard_pieces`` rows, whatever their values, each packed in one task;
    a shard has enough rows of every kind to lose only its last sequences against one packing
    of all. ``pieces`` is written once to the shared checkpoint folder, as its rows are counted
    and then packed. Lengths must be 1 .. ``capacity``; columns named like a result are replaced.
    ``carried`` columns, like the ids themselves, don't go through the packing tasks; they are
    joined to its answer by row, and full sequences keep them where they are.
    """
    out = ["sequence_id", "offset"]
    number, shard = free_name(pieces, "_row"), free_name(pieces, "_shard")
    numbered = write_scratch(pieces.drop(*out).withColumn(number, F.monotonically_increasing_id()), "pieces")
    rows = numbered.drop(number)
    names = [f"`{c}`" for c in rows.columns]
    full = F.col(f"`{length_col}`") == capacity
    n = rows.where(~full).count()
    shards = max(1, -(-n // shard_pieces))
    # full sequences get negative numbers, packed ones shard * 2^32 + place in the shard
    whole = numbered.where(full).select("*", (-1 - F.col(number)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    narrow = numbered.drop(*carried)
    schema = T.StructType([*narrow.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def pack_shard(group: pd.DataFrame) -> pd.DataFrame:
        lengths = group[length_col].to_numpy()
        order = np.argsort(lengths, kind="stable")
        sizes, first, counts = np.unique(lengths[order], return_index=True, return_counts=True)
        free = dict(zip(sizes.tolist(), first.tolist()))
        sequence = np.zeros(len(group), dtype=np.int64)
        offset = np.zeros(len(group), dtype=np.int64)
        for i, held in enumerate(best_two_fit(dict(zip(sizes.tolist(), counts.tolist())), capacity)):
            at = 0
            for size in held:
                row = order[free[size]]
                free[size] += 1
                sequence[row], offset[row] = i, at
                at += size
        base = int(group[shard].iloc[0]) << 32
        return group.drop(columns=[shard]).assign(sequence_id=sequence + base, offset=offset)

    dealt = narrow.where(~full).withColumn(shard, F.pmod(F.xxhash64(number), F.lit(shards)).cast("int"))
    packed = dealt.groupBy(shard).applyInPandas(pack_shard, schema)
    if carried:
        packed = packed.join(numbered.where(~full).select(number, *[f"`{c}`" for c in carried]), number)
    return whole.unionByName(packed).select(*names, *out)


