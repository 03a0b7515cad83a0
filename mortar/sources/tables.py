"""Declared sources: driver tables read with explicit schemas.

Reading with a declared schema skips inference, and every downstream
``select`` prunes columns down to the Parquet ``ReadSchema``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _I, _D, _S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
_TS = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(
        ("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D), ("c_mktsegment", _S)
    ),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _schema(
        ("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S), ("p_size", _I), ("p_retailprice", _D)
    ),
    "orders": _schema(
        ("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
        ("o_orderdate", _TS), ("o_orderpriority", _S),
    ),
    "lineitem": _schema(
        ("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I), ("l_quantity", _D),
        ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
        ("l_linestatus", _S), ("l_shipdate", _TS),
    ),
    "events": _schema(
        ("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S), ("value", _D), ("props", _S)
    ),
    "pages": _schema(("page_id", _L), ("url", _S), ("html", _S)),
}


class Sources:
    """Name -> DataFrame mapping over a folder of ``<name>.parquet`` tables.

    A table can also be registered explicitly (``register``), e.g. a catalog
    table on a cluster or a small DataFrame in a unit test.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self._tables: dict[str, DataFrame] = {}

    def register(self, name: str, df: DataFrame) -> "Sources":
        self._tables[name] = df
        return self

    def table(self, name: str) -> DataFrame:
        if name in self._tables:
            return self._tables[name]
        if self.root is None:
            return self.spark.table(name)
        reader = self.spark.read
        if name in SCHEMAS:
            reader = reader.schema(SCHEMAS[name])
        return reader.parquet(f"{self.root}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)
