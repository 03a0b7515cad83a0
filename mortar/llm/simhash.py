"""SimHash near-dedup with covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path
from .common import explode_salts, free_name, salt_of, salts_seen, stored, text_or_empty, write_scratch
from .words import word_blocks

BITS = 64
SALTS = 32
#: Shingle hashes whose bits are counted at a time.
CHUNK = 1 << 16


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """SimHash of whole lower-cased bytes: a bit is 1 if over half of the shingle hashes have it."""
    import xxhash

    xxh = xxhash.xxh64_intdigest
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    for _, words in word_blocks(text, shingle - 1):
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        begins = np.concatenate([[0], ends[:-shingle]]).tolist()
        ends = (ends[shingle - 1 :] - 1).tolist()
        hashes = np.fromiter((xxh(joined[a:b], seed) for a, b in zip(begins, ends)), dtype="<u8", count=len(ends))
        for i in range(0, len(hashes), CHUNK):
            part = hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
        n += len(hashes)
    if n == 0:  # the whole text has fewer words, which the last block holds all
        return xxh(b" ".join(words), seed) if words else 0
    return int(np.dot((2 * ones > n).astype(object), [1 << i for i in range(BITS)]))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """A row (id, fp) for each row of ``docs``; ``fp`` is the 64-bit SimHash of the whole text as a signed long.

    A-Z is lower-cased; shingles of ``shingle`` words count as often as they occur; a text
    with fewer words has one shingle, all of it; a text without words (null, empty, white
    space) has fingerprint zero. Every row is hashed, repeated ids included.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("fp", T.LongType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = [signed(fingerprint(t.as_py().lower(), shingle, seed)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=schema.names)

    return docs.select(F.col(f"`{id_col}`"), text_or_empty(F.col(f"`{text_col}`"))).mapInArrow(hashed, schema)


def covering_masks(radius: int) -> list[int]:
    """Structured bit masks such that any ``radius`` positions lie outside one of them.

    Position i gets a non-zero vector m(i) of radius + 1 bits; the mask of v keeps the
    positions whose product with v is odd. For any ``radius`` positions some v other than
    zero is orthogonal to all their vectors (fewer equations than unknowns), so two
    fingerprints that differ only there agree under the mask of v. There are
    2^(radius + 1) - 1 masks, each keeps about half of the positions.
    """
    vectors = [1 + i % ((2 << radius) - 1) for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vectors) if bin(m & v).count("1") % 2) for v in range(1, 2 << radius)]


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b), a > b, that connect all distinct values of ``fp`` within ``radius`` differing bits.

    Every pair within the radius meets in a bucket of one of the covering tables. Only
    members of buckets with two or more are looked at further, and no pairs are formed in a
    bucket: each member is moved by up to radius / 2 bits outside the mask, and members that
    arrive at one value are within the radius of each other, as are all that are (they meet
    half-way). Those of one value, at most as many as it has neighbours at radius / 2 however
    large the bucket, are linked to the smallest. Nothing is capped, and no pair is lost.
    """
    if radius < 0 or radius % 2:
        raise ValueError("radius must be even")
    masks = [signed(m) for m in covering_masks(radius)]
    moves = []
    for m in masks:
        free = [i for i in range(BITS) if not (m >> i) & 1]
        moves.append([signed(sum(1 << i for i in c)) for k in range(radius // 2 + 1) for c in combinations(free, k)])
    distinct = fps.select("fp").distinct()
    tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)]))
    buckets = distinct.select("fp", tables.alias("_b")).select("fp", "_b.t", "_b.key")
    full = buckets.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = buckets.join(full, ["t", "key"], "left_semi")
    steps = F.element_at(F.array(*[F.array(*[F.lit(x) for x in m]) for m in moves]), F.col("t") + 1)
    met = members.select("fp", F.explode(F.transform(steps, lambda x: F.col("fp").bitwiseXOR(x))).alias("mid")).repartition("mid").distinct()
    least = F.min("fp").over(Window.partitionBy("mid"))
    return met.select(F.col("fp").alias("a"), least.alias("b")).where("a > b").distinct()


def with_least(edges: DataFrame, salts: int = SALTS) -> DataFrame:
    """Rows (a, b) with ``m``, the smallest b of each a.

    The least is found by partial aggregation and goes back over (a, salt), the salt being a
    hash of b: the centre of a large star, that a third of all links may share, meets its
    neighbours in ``salts`` places. Links are distinct, so their salts spread evenly.
    """
    salted = edges.withColumn("_salt", salt_of([F.col("b")], salts))
    least = salted.groupBy("a").agg(F.min("b").alias("m"), salts_seen(F.col("_salt"), salts).alias("_salts"))
    return salted.join(least.select("a", "m", explode_salts(F.col("_salts"), salts).alias("_salt")), ["a", "_salt"]).select("a", "b", "m")


def connect(edges: DataFrame, salts: int = SALTS) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node it is connected to.

    Alternates two steps until nothing changes: every larger neighbour of a node is linked to
    the smallest neighbour, then every smaller one is. The links never grow in number and chains
    halve. Each round is written to the shared checkpoint folder, and the round before it is
    deleted there. No step gathers the neighbours of a node in one task (see ``with_least``).
    """
    spark = edges.sparkSession
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    before = path = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = with_least(both, salts).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        ends = F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b"))))
        small = with_least(large, salts).select(ends.alias("_e")).select("_e.a", "_e.b")
        edges, written = stored(small.where("a > b").distinct(), "links")
        if path:
            remove_path(spark, path)
        path = written
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now


def near_groups(fps: DataFrame, id_col: str = "doc_id", radius: int = 2, salts: int = SALTS) -> DataFrame:
    """Add ``component_id`` to rows (id, fp): the smallest id reachable over links, its own included.

    Fingerprints link if at most ``radius`` bits differ. All linking is done on distinct
    fingerprints, so copies cost one row; the answer goes back to the rows over (fingerprint,
    salt), so a fingerprint that a third of all rows share is spread over ``salts`` tasks. The
    salt comes from a row's place when the rows are written, not from its id, so rows
    whose ids are null or repeated spread as well. Null ids are never smallest; a component of
    null ids only has a null component_id.
    """
    placed = fps.select(F.col(f"`{id_col}`"), "fp").withColumn("_salt", salt_of([F.monotonically_increasing_id()], salts))
    salted = write_scratch(placed, "fingerprints")
    roots = connect(links(salted, radius), salts)
    each = salted.groupBy("fp").agg(F.min(f"`{id_col}`").alias("_least"), salts_seen(F.col("_salt"), salts).alias("_salts"))
    rooted = each.join(roots, each.fp == roots.node, "left").select("fp", "_least", "_salts", F.coalesce("root", "fp").alias("_root"))
    components = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    by_fp = rooted.join(components, "_root").select("fp", explode_salts(F.col("_salts"), salts).alias("_salt"), "component_id")
    return salted.join(by_fp, ["fp", "_salt"]).select(F.col(f"`{id_col}`"), "fp", "component_id")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """Fingerprints and near-duplicate components of whole texts: (id, fp, component_id) for every row.

    See ``fingerprints`` and ``near_groups`` for nulls, empty texts and repeated rows. An empty
    table gives an empty result; other columns are left alone.
    """
    return near_groups(fingerprints(docs, id_col, text_col, shingle, seed), id_col, radius)


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """One row of each near-duplicate component, the one with the smallest id.

    A null id is larger than any other. Of rows that share the smallest id, or have none, the
    one with the least hash of all its columns stays (columns that hold maps aside), and any
    one of rows that are equal throughout.
    """
    a, b = (free_name(docs, n) for n in ("_hash_a", "_hash_b"))
    hashable = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    # two hashes of the row tell rows apart that share an id or have none
    keyed = docs.select("*", F.xxhash64(F.lit(0), *hashable).alias(a), F.xxhash64(F.lit(1), *hashable).alias(b))
    row = F.struct(F.col(f"`{id_col}`").isNull().alias("no_id"), F.col(f"`{id_col}`").alias("id"), F.col(a).alias("a"), F.col(b).alias("b"))
    found = simhash_groups(keyed.select(row.alias("_row"), F.col(f"`{text_col}`").alias("_text")), "_row", "_text", shingle, radius, seed)
    kept = found.select(F.col("component_id.a").alias(a), F.col("component_id.b").alias(b)).distinct()
    return keyed.join(kept, [a, b], "left_semi").dropDuplicates([a, b]).select(*[F.col(f"`{c}`") for c in docs.columns])
