"""Byte-level BPE encoding and decoding as a monoid tree reduction.

The ids of a text form a monoid under concatenation of texts: two neighbouring pieces are
joined by encoding anew only a window around their boundary. A cut between a character that
is not white space and one that is lies between two matches of the split pattern in every
context, because no alternative of the pattern holds such a pair and nothing in it looks
back. Tokens on the far side of such a *stable cut* can't change, whatever is joined on.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_or_empty, worker_cache

LEAF_CHARS = 16_384
SEGMENT_CHARS = 1 << 20
FAN_IN = 64
#: White space of the split pattern. The regular expression library behind it counts the
#: characters of Unicode's White_Space; U+001C..U+001F, which Python adds, are not among them.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
STABLE = re.compile(f"[^{SPACE}](?=[{SPACE}])")


def last_stable(text: str, end: int | None = None) -> int:
    """The largest stable cut in ``text[:end]``, or -1; looks back in growing windows."""
    end = len(text) if end is None else end
    width = 64
    while True:
        begin = max(0, end - width)
        found = -1
        for m in STABLE.finditer(text, begin, end):
            found = m.end()
        if found >= 0 or begin == 0:
            return found
        width *= 4


@dataclass
class Piece:
    """An encoded piece of text: its ids and what a join needs of its two edges.

    ``head`` is the text before the first stable cut and ``n_head`` the ids it has, ``tail``
    and ``n_tail`` likewise after the last one. Without a stable cut ``head`` is the whole
    text and ``tail`` is None: the window of a join then grows over the whole piece.
    """

    ids: list[np.ndarray]
    head: str
    n_head: int
    tail: str | None
    n_tail: int


def leaf(text: str, encode: Callable[[str], list[int]]) -> Piece:
    ids = lambda t: np.array(encode(t), dtype="<u4")
    first = STABLE.search(text)
    if not first:
        return Piece([got := ids(text)], text, len(got), None, 0)
    a, b = first.end(), last_stable(text)
    head, tail = ids(text[:a]), ids(text[b:])
    return Piece([head, ids(text[a:b]), tail], text[:a], len(head), text[b:], len(tail))


def drop_ids(runs: list[np.ndarray], front: int = 0, back: int = 0) -> list[np.ndarray]:
    """``runs`` without so many ids at either end; only the outer runs are touched."""
    runs = list(runs)
    while front:
        got = min(front, len(runs[0]))
        runs[0], front = runs[0][got:], front - got
        if not len(runs[0]):
            runs.pop(0)
    while back:
        got = min(back, len(runs[-1]))
        runs[-1], back = runs[-1][: len(runs[-1]) - got], back - got
        if not len(runs[-1]):
            runs.pop()
    return runs


def join(x: Piece, y: Piece, encode: Callable[[str], list[int]]) -> Piece:
    """Join neighbours: the window from the last stable cut of ``x`` to the first of ``y`` is encoded anew.

    A cut that appears only through the join, at the boundary itself, needs no look: the
    window holds the boundary, and its outer ends are stable cuts or ends of what is known.
    """
    x_open, y_open = x.tail is None, y.tail is None
    edge, n_edge = (x.head, x.n_head) if x_open else (x.tail, x.n_tail)
    middle = leaf(edge + y.head, encode)
    ids = drop_ids(x.ids, back=n_edge) + middle.ids + drop_ids(y.ids, front=y.n_head)
    if not x_open and not y_open:
        return Piece(ids, x.head, x.n_head, y.tail, y.n_tail)
    if x_open and y_open:
        return Piece(ids, middle.head, middle.n_head, middle.tail, middle.n_tail)
    n_middle = sum(map(len, middle.ids))
    if x_open:  # up to the first cut of y, unless the window has an earlier one
        head, n_head = (edge + y.head, n_middle) if middle.tail is None else (middle.head, middle.n_head)
        return Piece(ids, head, n_head, y.tail, y.n_tail)
    tail, n_tail = (edge + y.head, n_middle) if middle.tail is None else (middle.tail, middle.n_tail)
    return Piece(ids, x.head, x.n_head, tail, n_tail)


def reduce_tree(text: str, encode: Callable[[str], list[int]], leaf_chars: int = LEAF_CHARS) -> Piece:
    """Encode halves recursively and join them."""
    if len(text) <= leaf_chars:
        return leaf(text, encode)
    half = len(text) // 2
    return join(reduce_tree(text[:half], encode, leaf_chars), reduce_tree(text[half:], encode, leaf_chars), encode)


def fold(pieces: list[Piece], encode: Callable[[str], list[int]]) -> Piece:
    """Join a row of neighbours, pair by pair, level by level."""
    while len(pieces) > 1:
        pairs = [join(a, b, encode) for a, b in zip(pieces[::2], pieces[1::2])]
        pieces = pairs + pieces[len(pairs) * 2 :]
    return pieces[0]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encoder(path: str, pattern: str):
    """The vocabulary in this worker, loaded once."""
    import tiktoken

    cache, key = worker_cache(), ("tiktoken", path, pattern)
    if key not in cache:
        cache[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})
    return cache[key]


PIECE = T.StructType(
    [
        T.StructField("ids", T.BinaryType()),
        T.StructField("head", T.StringType()),
        T.StructField("n_head", T.LongType()),
        T.StructField("tail", T.StringType()),
        T.StructField("n_tail", T.LongType()),
    ]
)


def to_row(p: Piece) -> tuple:
    return np.concatenate(p.ids).tobytes() if p.ids else b"", p.head, p.n_head, p.tail, p.n_tail


def from_row(r) -> Piece:
    ids = np.frombuffer(r["ids"], dtype="<u4")
    return Piece([ids] if len(ids) else [], r["head"], int(r["n_head"]), r["tail"], int(r["n_tail"]))


def encode(docs: DataFrame, path: str, pattern: str, id_cols: list[str], text_col: str = "text", segment_chars: int = SEGMENT_CHARS, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Encode whole texts to ids: ``id_cols`` plus ``ids`` (binary, little-endian unsigned 32-bit).

    A text of up to ``segment_chars`` characters is reduced where it lies. A longer one is
    dealt out in segments over the cluster, which are reduced in parallel and joined
    ``FAN_IN`` neighbours at a time, in as many levels as two billion characters need, so a
    task never holds more than one text's ids. ``id_cols`` must name a text of that length
    uniquely; rows that repeat ids and text each come out.
    Defined results: null is the empty text, which has no ids; an empty table gives an empty
    result; all other columns of ``docs`` are left alone.
    """
    text = text_or_empty(F.col(f"`{text_col}`"))
    keys = [f"_k{i}" for i in range(len(id_cols))]
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(id_cols, keys)], text.alias("_text"))

    def encode_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern).encode_ordinary
        for batch in batches:
            for part in slices(batch, "_text"):
                ids = [to_row(reduce_tree(t.as_py(), enc, leaf_chars))[0] for t in part.column("_text")]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(ids, pa.binary())], names=[*keys, "ids"])

    @F.pandas_udf(PIECE)
    def encode_segment(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoder(path, pattern).encode_ordinary
        for texts in batches:
            yield pd.DataFrame([to_row(reduce_tree(t, enc, leaf_chars)) for t in texts], columns=PIECE.names)

    def join_group(group: pd.DataFrame) -> pd.DataFrame:
        enc = encoder(path, pattern).encode_ordinary
        group = group.sort_values("_at")
        got = fold([from_row(r) for r in group.to_dict("records")], enc)
        out = group.iloc[:1][[*keys, "_same", "_at"]].copy()
        for name, value in zip(PIECE.names, to_row(got)):
            out[name] = [value]
        return out

    short = rows.where(F.length("_text") <= segment_chars)
    short = short.mapInArrow(encode_short, T.StructType([*short.schema.fields[:-1], T.StructField("ids", T.BinaryType())]))
    # rows that repeat ids and text are told apart, so that their segments don't mix
    long = rows.where(F.length("_text") > segment_chars).withColumn("_same", F.monotonically_increasing_id())
    parts = F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{segment_chars}}}"), F.lit(0))
    pieces = (
        long.select(*keys, "_same", F.posexplode(parts).alias("_at", "_part"))
        .repartition(*keys, "_same", "_at")
        .select(*keys, "_same", F.col("_at").cast("long").alias("_at"), encode_segment("_part").alias("_piece"))
        .select(*keys, "_same", "_at", "_piece.*")
    )
    reach = segment_chars
    while reach < 1 << 31:
        pieces = (
            pieces.withColumn("_group", F.floor(F.col("_at") / FAN_IN))
            .groupBy(*keys, "_same", "_group")
            .applyInPandas(join_group, pieces.schema)
            .withColumn("_at", F.floor(F.col("_at") / FAN_IN))
        )
        reach *= FAN_IN
    both = short.unionByName(pieces.select(*keys, "ids"))
    return both.select(*[F.col(k).alias(c) for k, c in zip(keys, id_cols)], "ids")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded`` (binary): the bytes of the tokens, concatenated up the tree; no ids give no bytes."""

    def tokens_of_rank() -> np.ndarray:
        cache, key = worker_cache(), ("tokens", path)
        if key not in cache:
            ranks = load_ranks(path)
            cache[key] = np.empty(max(ranks.values()) + 1, dtype=object)
            for token, rank in ranks.items():
                cache[key][rank] = token
        return cache[key]

    def to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of_rank()

        def up(ids: np.ndarray) -> bytes:
            if len(ids) <= LEAF_CHARS:
                return b"".join(tokens[ids])
            half = len(ids) // 2
            return up(ids[:half]) + up(ids[half:])

        for batch in batches:
            for part in slices(batch, ids_col):
                decoded = [up(np.frombuffer(x.as_py(), dtype="<u4")) for x in part.column(ids_col)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], names=[*part.schema.names, "decoded"])

    rest = encoded.drop("decoded")
    return rest.mapInArrow(to_bytes, T.StructType([*rest.schema.fields, T.StructField("decoded", T.BinaryType())]))
