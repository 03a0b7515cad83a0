"""Fixtures for the tests of this folder, imported by name."""

import pytest
from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), in several partitions."""

    def make(rows, partitions=3):
        return spark.createDataFrame([(*r, None)[:3] for r in rows], SCHEMA).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def clashing():
    """The same documents with further columns that are named like an operator's own."""

    def make(df, *names):
        from pyspark.sql import functions as F

        for n in names:
            df = df.withColumn(n, F.lit("x"))
        return df

    return make
