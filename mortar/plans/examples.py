"""The starter models: inline literal rows and a filter on them.

They run on fixed inline input only, so they are library functions with
unit tests, not registered queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.generate import literal_rows


def first_model(spark: SparkSession) -> DataFrame:
    """``select 1 as id union all select null as id``."""
    return literal_rows(spark, [(1,), (None,)], "id int")


def second_model(first: DataFrame) -> DataFrame:
    """``select * from first where id = 1`` (NULL ids drop out)."""
    return first.where(F.col("id") == 1)
