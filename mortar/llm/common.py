"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once to the shared checkpoint folder and read back, and the path it is at."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage with a table that every executor can read again.
    """
    found, _ = stored(df, name)
    # the step is over: lets Spark's cleaner drop its shuffle files now, not at some later time
    df.sparkSession.sparkContext._jvm.System.gc()
    return found


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.

    ``lower`` is the quick way; it is right unless it also changes a character
    outside ASCII, which the residue of the text without ASCII shows. Only those
    texts take the slower character table.
    """
    residue = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    return F.when(F.lower(residue) == residue, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def salt_of(cols: list[Column], salts: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


#: The largest value of ``hash63``.
MOST_HASH = (1 << 63) - 1


def hash63(col: Column) -> Column:
    return F.xxhash64(col).bitwiseAND(F.lit(MOST_HASH))


def sample_cut(wanted: int, total: int) -> int:
    """Rows whose ``hash63`` is at most this are about ``wanted`` of ``total``, however many these are."""
    return min(MOST_HASH, MOST_HASH * wanted // max(1, total))


def salts_seen(salt: Column, salts: int) -> Column:
    """Aggregate: the salts of a group as the bits of a long (``salts`` <= 63)."""
    if not 1 <= salts <= 63:
        raise ValueError("salts must be between 1 and 63")
    return F.bit_or(F.expr("shiftleft(1L, 0)") if salts == 1 else F.call_function("shiftleft", F.lit(1).cast("long"), salt))


def explode_salts(bits: Column, salts: int) -> Column:
    """One row for each salt whose bit is set."""
    each = F.sequence(F.lit(0), F.lit(salts - 1))
    return F.explode(F.filter(each, lambda i: F.call_function("shiftright", bits, i).bitwiseAND(F.lit(1)) == 1))


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, for loaded vocabularies and the like."""
    name = "_mortar_llm_worker_cache"
    if name not in sys.modules:
        module = types.ModuleType(name)
        module.store = {}
        sys.modules[name] = module
    return sys.modules[name].store


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of about ``limit`` bytes in one column; a longer value is a run of its own."""
    size = begin = 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if size and size + (n or 0) > limit:
            yield batch.slice(begin, i - begin)
            begin, size = i, 0
        size += n or 0
    if begin < len(batch):
        yield batch.slice(begin)
