"""Differences between row multisets, exact and safe with many equal copies.

Both sides are stacked and counted per distinct row: one shuffle, and copies
collapse before it, so a row that makes up a large share of a table costs one
record per task. Unlike ``exceptAll`` no task replays all copies of a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.errors import SchemaDrift
from tidemark.functions.cursors import column
from tidemark.functions.schemas import differences
from tidemark.session import scratch_dir, shuffle_tasks

LEFT, RIGHT = "__left", "__right"
COPIES_PER_STEP = 100_000


def same_columns(left: DataFrame, right: DataFrame) -> None:
    unlike = differences(left.schema, right.schema)
    if unlike:
        raise SchemaDrift("the sides differ in " + "; ".join(unlike))


def copy_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row with its number of copies on either side."""
    same_columns(left, right)
    columns = [column(c) for c in left.columns]
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    stacked = left.select(*columns, one.alias(LEFT), none.alias(RIGHT)).unionByName(
        right.select(*columns, none.alias(LEFT), one.alias(RIGHT))
    )
    return stacked.groupBy(*columns).agg(
        F.sum(LEFT).alias(LEFT), F.sum(RIGHT).alias(RIGHT)
    )


def subtract_all(
    left: DataFrame, right: DataFrame, step: int = COPIES_PER_STEP
) -> DataFrame:
    """Rows of ``left`` less those of ``right``, copy by copy.

    The surplus per distinct row is written to the shared folder first: a database
    read twice could answer differently, and the largest surplus decides how to go
    on. Rows with more copies than ``step`` are cut into runs of that length and
    the runs spread over tasks; the others expand where they are.
    """
    spark = left.sparkSession
    columns = [column(c) for c in left.columns]
    n, run = F.col("__n"), F.col("__run")
    folder = scratch_dir(spark, "surplus")
    surplus = copy_counts(left, right).select(
        *columns, (F.col(LEFT) - F.col(RIGHT)).alias("__n")
    )
    surplus.filter(n > 0).write.parquet(folder)
    surplus = spark.read.schema(surplus.schema).parquet(folder)
    most = surplus.agg(F.max("__n")).first()[0] or 0
    if most <= 1:
        return surplus.select(*columns)

    first = F.lit(1).cast("bigint")
    few = surplus.filter(n <= step).select(
        *columns, F.explode(F.sequence(first, n)).alias("__copy")
    )
    if most <= step:
        return few.select(*columns)
    # A given partition count: by size the runs would be merged into one task again.
    runs = F.explode(F.expr(f"sequence(0L, (__n - 1) div {step}L)"))
    many = (
        surplus.filter(n > step)
        .select(*columns, n, runs.alias("__run"))
        .repartition(shuffle_tasks(spark), "__run")
        .select(
            *columns,
            F.explode(F.sequence(first, F.least(F.lit(step), n - run * step))).alias(
                "__copy"
            ),
        )
    )
    return few.unionByName(many).select(*columns)
