"""Small frames of metadata, made without starting Python workers or jobs."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def small_frame(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType
) -> DataFrame:
    """Rows known on the driver, such as column names, as a local relation."""
    if not rows:
        return empty_frame(spark, schema)
    arrow = to_arrow_schema(schema)
    values = zip(*rows, strict=True)
    arrays = [pa.array(v, f.type) for v, f in zip(values, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow))


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0, 1, 1, 1).select(*nothing).filter(F.lit(False))
