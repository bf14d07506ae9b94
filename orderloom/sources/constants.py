"""Small fixed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def literal_rows(spark: SparkSession, rows: Sequence[Sequence[object]], schema: StructType) -> DataFrame:
    """The rows as a plan of literals.

    Spark sees how small it is and broadcasts it; of rows handed over from
    Python it does not know the size.
    """
    structs = [
        F.struct(*[F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, schema, strict=True)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
