"""Latest row per group, most frequent value per group."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_group(df: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """First row of each group in the given order (PostgreSQL's ``DISTINCT ON``).

    The filter on ``row_number`` lets Spark keep one row per group and task before the shuffle, so
    a group of any size reaches the final task as one row per task.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def first_mode(kind: Column, wanted: str, value: Column, n: Column) -> Column:
    """Aggregate over (kind, value, count) rows: the most frequent non-null value, ties to the smallest."""
    candidate = F.when((kind == wanted) & value.isNotNull(), F.struct((-n).alias("n"), value.alias("v")))
    return F.min(candidate)["v"]
