"""Quantiles of values of any width, from counts in cells that merge by addition.

A cell is an interval of values: 2**SUB_BITS of equal width in every power of two, on either side of
zero. The cells are the same for all groups and times, so summaries of parts add up to that of the
whole in any order. A summary has few rows however many distinct values there are. It gives a
quantile as the least and greatest value counted in one cell, and how many ranks those two may be
off; a second pass over that cell's rows alone gives the exact value.
"""

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUB_BITS = 6


def cell_of(value: Column, sub_bits: int = SUB_BITS) -> Column:
    """The number of a value's cell; larger values have no smaller numbers. NULL and NaN have none."""
    x = value.cast("double")
    size = F.abs(x)
    # Nothing below 2**-60 is told apart from zero.
    power = F.greatest(F.floor(F.log2(size)), F.lit(-60).cast("bigint"))
    inside = F.floor((size / F.pow(F.lit(2.0), power) - 1) * (1 << sub_bits))
    inside = F.least(F.greatest(inside, F.lit(0).cast("bigint")), F.lit((1 << sub_bits) - 1).cast("bigint"))
    number = (power + 61) * (1 << sub_bits) + inside
    cell = F.when(size < 2.0**-60, F.lit(0).cast("bigint")).when(x > 0, number).otherwise(-number)
    return F.when(~F.isnan(x) & (size != float("inf")), cell)


def summarize(df: DataFrame, keys: Sequence[str], value: str, sub_bits: int = SUB_BITS) -> DataFrame:
    """(keys, cell, n, low, high): how many values each cell holds, and its least and greatest. One pass."""
    cells = df.withColumn("cell", cell_of(F.col(value), sub_bits)).filter("cell IS NOT NULL")
    return cells.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))


def merge(summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The summary of the groups' union by fewer keys, or of several summaries set one below the other."""
    return summary.groupBy(*keys, "cell").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def _needed(total: Column, share: Column) -> Column:
    """The rank of ``PERCENTILE_DISC``: the first whose share of all ranks reaches ``share``."""
    return F.greatest(F.ceil(total * share), F.lit(1)).cast("bigint")


def bounds(summary: DataFrame, keys: Sequence[str], shares: Sequence[Decimal]) -> DataFrame:
    """(keys, share, total, low, high, rank_error): the value at each share of the ranks lies from ``low`` to ``high``.

    ``rank_error`` is the largest share of ranks by which either may be off; 0 if they are equal.
    """
    return _hit(summary, keys, shares).select(
        *keys,
        "share",
        "total",
        "low",
        "high",
        F.when(F.col("low").eqNullSafe(F.col("high")), F.lit(0.0)).otherwise((F.col("n") - 1) / F.col("total")).alias("rank_error"),
    )


def _hit(summary: DataFrame, keys: Sequence[str], shares: Sequence[Decimal]) -> DataFrame:
    """The cell of each share, with the ranks before it and the rank wanted."""
    whole = Window.partitionBy(*keys)
    running = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = summary.withColumn("upto", F.sum("n").over(running)).withColumn("total", F.sum("n").over(whole))
    asked = F.explode(F.array(*[F.lit(s).cast("decimal(9,8)") for s in shares])).alias("share")
    placed = placed.select("*", asked).withColumn("rank", _needed(F.col("total"), F.col("share")))
    return placed.filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))


def exact(df: DataFrame, summary: DataFrame, keys: Sequence[str], value: str, shares: Sequence[Decimal], sub_bits: int = SUB_BITS) -> DataFrame:
    """(keys, share, value): the exact quantiles (``PERCENTILE_DISC``) of ``df``, of which ``summary`` is the summary.

    Only rows in the cells that hold a quantile are read again, and counted by value. Values equal
    in all but their cell's width are few; a value that very many rows share is one count.
    """
    hit = _hit(summary, keys, shares).select(*keys, "cell", "share", "rank", (F.col("upto") - F.col("n")).alias("before"))
    cells = hit.select(*keys, "cell").distinct()
    renamed = {c: f"_c_{c}" for c in [*keys, "cell"]}
    same = [F.col(c).eqNullSafe(F.col(r)) for c, r in renamed.items()]
    inside = df.withColumn("cell", cell_of(F.col(value), sub_bits)).filter("cell IS NOT NULL")
    inside = inside.join(cells.withColumnsRenamed(renamed), same, "left_semi")
    counted = inside.groupBy(*keys, "cell", value).agg(F.count(F.lit(1)).alias("m"))
    running = Window.partitionBy(*keys, "cell").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counted.withColumn("reached", F.sum("m").over(running))
    joined = counted.join(hit.withColumnsRenamed(renamed), same)
    wanted = F.col("rank") - F.col("before")
    found = joined.filter((F.col("reached") >= wanted) & (F.col("reached") - F.col("m") < wanted))
    return found.select(*keys, "share", F.col(value).alias("value"))
