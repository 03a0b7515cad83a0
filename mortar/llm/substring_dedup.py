"""Substring dedup by level-wise doubling of repeated windows of words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import explode_salts, salt_of, salts_seen, text_or_empty, worker_cache, write_scratch
from .words import word_blocks

WINDOW = 35
#: Halvings between the shortest windows that are counted and the full ones.
HALVINGS = 2
#: Words that are hashed together; a longer text is hashed in overlapping blocks.
UNIT_WORDS = 1 << 19
UNIT_BYTES = 1 << 22
SALTS = 32
MOST_WORDS = 300_000
#: An order key holds a hash above and a place below; a unit has fewer words than places.
PLACE_BITS = 24
PLACE = np.uint64((1 << PLACE_BITS) - 1)


class WordHashes(dict):
    """Word -> 64-bit hash, for the words met last."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MOST_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def level_lengths(window: int, halvings: int) -> list[int]:
    """The full length and its repeated halves (rounded up), shortest first."""
    lengths = [window]
    for _ in range(halvings):
        if lengths[-1] == 1:
            break
        lengths.append((lengths[-1] + 1) // 2)
    return lengths[::-1]


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0x94D049BB133111EB)


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of ``length`` words, by joining two windows of half the length."""
    if length == 1:
        return words
    half = (length + 1) // 2
    h = window_hashes(words, half)
    n = len(words) - length + 1
    if n <= 0:
        return h[:0]
    return mix(h[:n], h[length - half : length - half + n])


def least_in_span(keys: np.ndarray, span: int) -> np.ndarray:
    """The least of every ``span`` neighbours, by doubling."""
    width = 1
    while 2 * width <= span:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    if width < span:
        keys = np.minimum(keys[: len(keys) - (span - width)], keys[span - width :])
    return keys


class Unit:
    """Consecutive segments of texts hashed together: place -> (row in the batch, place in the text)."""

    def __init__(self, parts: list[tuple[int, int, list[bytes]]], hashes: WordHashes, window: int):
        sizes = [len(words) for _, _, words in parts]
        self.rows = np.array([row for row, _, _ in parts], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.offsets = np.array([at for _, at, _ in parts], dtype=np.int64) - self.begins
        self.words = np.fromiter((hashes[w] for _, _, words in parts for w in words), dtype=np.uint64, count=int(self.ends[-1]) if parts else 0)
        n = max(0, len(self.words) - window + 1)
        self.starts = np.zeros(n, dtype=bool)  # where a full window begins
        for a, b in zip(self.begins.tolist(), self.ends.tolist()):
            if b - a >= window:
                self.starts[a : b - window + 1] = True

    def anchors(self, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
        """For every full window the place of its anchor: the least of its windows of ``length``; and their hashes."""
        h = window_hashes(self.words, length)
        if not len(self.starts):
            return np.zeros(0, dtype=np.int64), h
        keys = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
        return (least_in_span(keys, window - length + 1) & PLACE).astype(np.int64), h

    def origin(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        part = np.searchsorted(self.ends, places, side="right")
        return self.rows[part], places + self.offsets[part]


def units(texts: list[bytes], window: int, cache: WordHashes) -> Iterator[Unit]:
    parts: list[tuple[int, int, list[bytes]]] = []
    held = 0
    for row, text in enumerate(texts):
        for at, words in word_blocks(text, window - 1, UNIT_BYTES // 2):
            parts.append((row, at, words))
            held += len(words)
            if held >= UNIT_WORDS:
                yield Unit(parts, cache, window)
                parts, held = [], 0
    if parts:
        yield Unit(parts, cache, window)


def word_hashes() -> WordHashes:
    return worker_cache().setdefault("word hashes", WordHashes())


def by_row(n: int, rows: list[np.ndarray], values: list[np.ndarray]) -> list[np.ndarray]:
    """For each of ``n`` rows its values, from runs of (row, value)."""
    row = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    value = np.concatenate(values) if values else np.zeros(0, dtype=np.int64)
    order = np.argsort(row, kind="stable")
    return np.split(value[order], np.searchsorted(row[order], np.arange(1, n)))


def lists(found: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
    flat = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int64, copy=False)))


def where_group(rows: DataFrame, keys: list[str], owner: str, aggregates: dict[str, Column], condition: str, salts: int = SALTS) -> DataFrame:
    """The rows whose group by ``keys`` meets a condition on its aggregates.

    Groups are aggregated partly before the shuffle, so a frequent window is one row a task.
    The answer goes back over (keys, salt), the salt being a hash of ``owner``: a window that
    a third of all texts have meets its rows in ``salts`` places instead of one.
    """
    salted = rows.withColumn("_salt", F.coalesce(salt_of([F.col(owner)], salts), F.lit(0)))
    found = salted.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()], salts_seen(F.col("_salt"), salts).alias("_salts"))
    found = found.where(condition).select(*keys, explode_salts(F.col("_salts"), salts).alias("_salt"))
    return salted.join(found, [*keys, "_salt"], "left_semi").drop("_salt")


def repeated(rows: DataFrame, keys: list[str], owner: str) -> DataFrame:
    """The rows whose ``keys`` occur more than once."""
    return where_group(rows, keys, owner, {"_n": F.count(F.lit(1))}, "_n > 1")


def at_most_twice(hashes: np.ndarray) -> np.ndarray:
    """Each value once, or twice if it occurs more often: enough to know that it is repeated."""
    values, n = np.unique(hashes, return_counts=True)
    return np.repeat(values, np.minimum(n, 2))


def first_level(keyed: DataFrame, length: int, window: int) -> DataFrame:
    """One row a text: its words counted and hashed as they are, and the hashes of its anchors."""
    schema = T.StructType([keyed.schema["_id"], keyed.schema["_k"], keyed.schema["_l"]]).add("n_words", "long").add("sha256", "string").add("hashes", T.ArrayType(T.LongType()))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_hashes()
        for batch in batches:
            texts = batch.column("_text").cast(pa.large_binary()).to_pylist()
            counts, shas = [], []
            for text in texts:
                n, sha = 0, hashlib.sha256()
                for at, words in word_blocks(text, 0):
                    sha.update((b" " if n and words else b"") + b" ".join(words))
                    n += len(words)
                counts.append(n)
                shas.append(sha.hexdigest())
            rows, hashes = [], []
            for unit in units(texts, window, cache):
                at, h = unit.anchors(length, window)
                places = np.unique(at[unit.starts])
                rows.append(unit.origin(places)[0])
                hashes.append(h[places].view(np.int64))
            got = [at_most_twice(x) for x in by_row(len(texts), rows, hashes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_k"), batch.column("_l"), pa.array(counts, pa.int64()), pa.array(shas), lists(got)], names=schema.names
            )

    return keyed.mapInArrow(anchors, schema)


class Survivors:
    """Full windows of a batch of working texts whose anchor is repeated."""

    def __init__(self, batch: pa.RecordBatch):
        self.numbers = batch.column("_row").to_numpy()
        self.texts = batch.column("_text").cast(pa.large_binary()).to_pylist()
        self.often = [np.asarray(x, dtype=np.int64) for x in batch.column("hashes").to_numpy(zero_copy_only=False)]

    def starts(self, unit: Unit, length: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Their places, the places of their anchors, and the hashes of these."""
        at, h = unit.anchors(length, window)
        starts = np.flatnonzero(unit.starts)
        row = unit.origin(starts)[0]
        anchor = h[at[starts]].view(np.int64)
        cuts = np.searchsorted(row, np.arange(len(self.texts) + 1))
        alive = [np.isin(anchor[a:b], self.often[i]) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        keep = np.concatenate(alive) if alive else np.zeros(0, dtype=bool)
        return starts[keep], at[starts[keep]], anchor[keep]


def full_hashes(unit: Unit, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every full window, joined from differently mixed word hashes; the second is cut to 32 bits."""
    other = window_hashes(unit.words * np.uint64(0xD6E8FEB86659FD93) ^ (unit.words >> np.uint64(31)), window)
    return window_hashes(unit.words, window), other >> np.uint64(32)


def next_level(working: DataFrame, shorter: int, length: int, window: int) -> DataFrame:
    """(row, hash) of the anchors of the doubled length, for full windows whose shorter anchor is repeated."""

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_hashes()
        for batch in batches:
            known = Survivors(batch)
            for unit in units(known.texts, window, cache):
                starts, _, _ = known.starts(unit, shorter, window)
                if len(starts):
                    at, h = unit.anchors(length, window)
                    places = np.unique(at[starts])
                    row, _ = unit.origin(places)
                    found = np.stack([row, h[places].view(np.int64)], axis=1)
                    pairs, n = np.unique(found, axis=0, return_counts=True)
                    pairs = np.repeat(pairs, np.minimum(n, 2), axis=0)  # twice is enough to be repeated
                    yield pa.RecordBatch.from_arrays([pa.array(known.numbers[pairs[:, 0]]), pa.array(pairs[:, 1])], names=["_row", "hash"])

    return working.select("_row", "_text", "hashes").mapInArrow(extended, "_row long, hash long")


def contexts_of(working: DataFrame, length: int, window: int) -> DataFrame:
    """A row for each repeated anchor: the ``n`` full windows from ``start`` on that it stands for, as one hash.

    ``context`` and ``check`` are 96 bits of all these windows and of where the anchor lies in them.
    """

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_hashes()
        for batch in batches:
            known = Survivors(batch)
            for unit in units(known.texts, window, cache):
                starts, at, anchor = known.starts(unit, length, window)
                if not len(starts):
                    continue
                first = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 0) | (np.diff(starts) != 1)]))
                h, other = full_hashes(unit, window)
                shift = (at - starts).astype(np.uint64) + np.uint64(1)
                context = np.add.reduceat(mix(h[starts], shift * np.uint64(0x9FB21C651E98DF25)), first)
                check = np.add.reduceat(mix(other[starts], shift), first) >> np.uint64(32)
                row, place = unit.origin(starts[first])
                n = np.diff(np.append(first, len(starts)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(known.numbers[row]), pa.array(place), pa.array(n), pa.array(anchor[first]), pa.array(context.view(np.int64)), pa.array(check.astype(np.uint32).view(np.int32))],
                    names=["_row", "start", "n", "hash", "context", "check"],
                )

    return working.select("_row", "_text", "hashes").mapInArrow(gathered, "_row long, start long, n long, hash long, context long, check int")


def windows_of(working: DataFrame, window: int) -> DataFrame:
    """Single full windows of the contexts listed in ``todo``: (row, place, occurs, hash, check)."""

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_hashes()
        for batch in batches:
            numbers = batch.column("_row").to_numpy()
            texts = batch.column("_text").cast(pa.large_binary()).to_pylist()
            todo = [sorted((c["start"], c["n"], c["occurs"]) for c in r) for r in batch.column("todo").to_pylist()]
            for unit in units(texts, window, cache):
                starts = np.flatnonzero(unit.starts)
                row, place = unit.origin(starts)
                cuts = np.searchsorted(row, np.arange(len(texts) + 1))
                occurs = np.zeros(len(starts), dtype=np.int64)
                for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                    if b > a:
                        begin, n, times = np.array(todo[i], dtype=np.int64).T
                        last = np.searchsorted(begin, place[a:b], side="right") - 1
                        inside = (last >= 0) & (place[a:b] < (begin + n)[np.maximum(last, 0)])
                        occurs[a:b] = np.where(inside, times[np.maximum(last, 0)], 0)
                pick = np.flatnonzero(occurs)
                if len(pick):
                    h, other = full_hashes(unit, window)
                    at = starts[pick]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(numbers[row[pick]]), pa.array(place[pick]), pa.array(occurs[pick]), pa.array(h[at].view(np.int64)), pa.array(other[at].astype(np.uint32).view(np.int32))],
                        names=["_row", "start", "occurs", "hash", "check"],
                    )

    return working.select("_row", "_text", "todo").mapInArrow(single, "_row long, start long, occurs long, hash long, check int")


def repeated_windows(working: DataFrame, level: DataFrame, length: int, window: int) -> DataFrame:
    """Runs (row, start, n) of full windows that start anywhere else too.

    The windows of an anchor are compared as a whole first: most repeats, those inside copied
    passages, are settled by one row. Only contexts that occur once, at the rims of passages,
    are taken apart, against one representative of each distinct context with the same anchor.
    """
    found = write_scratch(contexts_of(level, length, window), "contexts")
    keys = ["hash", "context", "check"]
    each = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurs"), F.min(F.struct("_row", "start", "n")).alias("_first"))
    each = write_scratch(each, "distinct-contexts")
    settled = found.join(each.where("occurs > 1").select(*keys), keys, "left_semi").select("_row", "start", "n")

    each = each.withColumn("_owner", F.col("_first._row"))
    todo = where_group(each, ["hash"], "_owner", {"_m": F.count(F.lit(1)), "_least": F.min("occurs")}, "_m > 1 and _least = 1")
    todo = todo.select("_first.*", "occurs")
    todo = todo.groupBy("_row").agg(F.collect_list(F.struct("start", "n", "occurs")).alias("todo"))
    windows = write_scratch(windows_of(working.drop("hashes").join(todo, "_row"), window), "rims")
    rims = where_group(windows, ["hash", "check"], "_row", {"_n": F.sum("occurs")}, "_n > 1")
    rims = rims.where("occurs = 1").select("_row", "start", F.lit(1).cast("long").alias("n"))
    return settled.unionByName(rims)


def remove_windows(working: DataFrame, window: int) -> DataFrame:
    """Remove the words that the windows of the runs in ``runs`` cover."""

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").cast(pa.large_binary()).to_pylist()
            runs = batch.column("runs").to_pylist()
            gone, kept_texts, shas = [], [], []
            for text, listed in zip(texts, runs):
                begin, n_windows = np.array(sorted((r["start"], r["n"]) for r in listed), dtype=np.int64).T
                end = np.maximum.accumulate(begin + n_windows - 1 + window)  # the words before it are covered
                kept, n = [], 0
                for at, words in word_blocks(text, 0):
                    place = np.arange(at, at + len(words))
                    last = np.searchsorted(begin, place, side="right") - 1
                    free = (last < 0) | (place >= end[np.maximum(last, 0)])
                    kept += [words[i] for i in np.flatnonzero(free).tolist()]
                    n += len(words)
                out = b" ".join(kept)
                gone.append(n - len(kept))
                kept_texts.append(out.decode())
                shas.append(hashlib.sha256(out).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_k"), batch.column("_l"), pa.array(gone, pa.int64()), pa.array(kept_texts, pa.string()), pa.array(shas)], names=["_k", "_l", "n_removed", "kept", "sha_kept"]
            )

    return working.select("_k", "_l", "_text", "runs").mapInArrow(removed, "_k long, _l long, n_removed long, kept string, sha_kept string")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, halvings: int = HALVINGS) -> DataFrame:
    """Remove each word that lies in a window of ``window`` words which also starts anywhere else.

    Levels double the length: windows of a quarter of the full length, then of half of it,
    then full ones. At a short level each full window is represented by its *anchor*, the
    shorter window in it with the least hash: equal windows have equal anchors, so a window
    whose anchor occurs at one place only is unique and goes no further. Only full windows
    whose anchor is repeated are looked at with the doubled length, until the full length
    decides, by 96 bits of two hashes (see ``repeated_windows``). Neighbouring windows share anchors, so the first level
    moves about one row for fourteen words. Texts move once, those with a
    repeated anchor are kept as a written table for the further levels.

    Windows are judged on the input. Words are runs other than space and U+0009..U+000D.
    Returns a row for each row of ``docs``: id, n_words, n_removed, kept (the remaining words
    joined by a space; null if nothing was removed) and kept_sha256.
    Defined results: a null or empty text has no words; rows that repeat id and text see each
    other as repeats, and each comes out; a text shorter than the window stays; an empty
    table gives an empty result; other columns are left alone.
    """
    lengths = level_lengths(window, halvings)
    named = docs.select(F.col(f"`{id_col}`").alias("_id"), text_or_empty(F.col(f"`{text_col}`")).alias("_text"))
    # what names a text from here on, also where ids are null or repeated
    name = F.coalesce(F.col("_id").cast("string"), F.lit("")), F.col("_id").isNull()
    keyed = named.select("_id", F.xxhash64("_text", *name).alias("_k"), F.xxhash64(F.lit(1), *name, "_text").alias("_l"), "_text")

    first = write_scratch(first_level(keyed, lengths[0], window), "windows")
    anchors = first.select("_k", F.explode("hashes").alias("hash"))
    # texts of one key share their hashes: at worst a window too many is looked at again
    alive = repeated(anchors, ["hash"], "_k").groupBy("_k").agg(F.collect_set("hash").alias("hashes"))
    working = keyed.drop("_id").join(alive, "_k").withColumn("_row", F.monotonically_increasing_id())
    working = write_scratch(working, "working")

    level = working
    for shorter, length in zip(lengths, lengths[1:-1]):
        found = repeated(write_scratch(next_level(level, shorter, length, window), "windows"), ["hash"], "_row")
        level = working.drop("hashes").join(found.groupBy("_row").agg(F.collect_set("hash").alias("hashes")), "_row")
    runs = repeated_windows(working, level, lengths[-2] if len(lengths) > 1 else window, window)
    runs = runs.groupBy("_row").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    removed = remove_windows(working.join(runs, "_row"), window).dropDuplicates(["_k", "_l"])
    return first.join(removed, ["_k", "_l"], "left").select(
        F.col("_id").alias(id_col),
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        "kept",
        F.coalesce("sha_kept", "sha256").alias("kept_sha256"),
    )
