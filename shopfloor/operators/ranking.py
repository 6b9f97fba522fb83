"""``RANK()`` from counts.

A window over all rows, or over the rows of one plant, sorts the whole group in one task. The rank
of a row only depends on how many rows have a better value, so the rows are first counted per
distinct value (a small table, combined on the map side) and the running sums are taken there.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.functions.ordering import pg_desc
from shopfloor.storage import materialize

# decimal(6,2) has two million values; a running sum over that many rows is one short task.
NARROW_PRECISION = 6


def count_cells(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per (keys, value)."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def rank_cells(cells: DataFrame, value: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Add the PostgreSQL ``RANK() OVER (PARTITION BY by ORDER BY value DESC)`` of each cell."""
    kind = cells.schema[value].dataType
    if not isinstance(kind, T.DecimalType) or kind.precision > NARROW_PRECISION:
        return _rank_in_ranges(cells, value, name, by)
    window = Window.partitionBy(*by).orderBy(pg_desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn(name, F.coalesce(F.sum("n").over(window), F.lit(0)) + 1)


def _rank_in_ranges(cells: DataFrame, value: str, name: str, by: Sequence[str]) -> DataFrame:
    """The same for a type with any number of values: no task holds more than a range of them.

    Cells are sorted into ranges and written with the number of their range; ranks are counted
    within a range, and the ranges before it, one row each and key, are added up.
    """
    order = [*[F.col(c) for c in by], pg_desc(value)]
    ranged = cells.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    inside = Window.partitionBy("_range", *by).orderBy(pg_desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range", *by).agg(F.sum("n").alias("_total"))
    totals = totals.withColumn("_base", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    ranked = ranged.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    renamed = totals.withColumnsRenamed({c: f"_r_{c}" for c in ["_range", *by]})
    match = F.col("_range") == F.col("_r__range")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    joined = ranked.join(renamed, match)
    return joined.withColumn(name, F.col("_base") + F.col("_inside") + 1).select(*cells.columns, name)
