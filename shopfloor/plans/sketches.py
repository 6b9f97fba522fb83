"""Distinct counts of any span of months, from one HyperLogLog sketch a month.

A sketch has a fixed size whatever it has seen, and the sketches of several months merge into one of
all their rows, in any order: estimates of different orders differ by no more than their error. So the
runs are read once, and every later question reads a few sketches.
"""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.sources.tables import Tables

#: Logarithm of a sketch's registers. Its relative standard error is about 0.83 / sqrt(registers).
LOG_REGISTERS = 12
COUNTED = {"runs": "run_id", "plants": "plant_id", "products": "product_id", "operators": "operator"}


def relative_error(log_registers: int = LOG_REGISTERS) -> float:
    return 0.83 / (1 << log_registers) ** 0.5


def monthly_sketches(tables: Tables, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """(month, a sketch of each of ``COUNTED``); runs without a date are under the month NULL."""
    month = F.trunc("run_date", "month").alias("month")
    made = [F.hll_sketch_agg(column, log_registers).alias(name) for name, column in COUNTED.items()]
    return tables.production_runs.groupBy(month).agg(*made)


def merged(sketches: DataFrame, *keys: str | Column) -> DataFrame:
    """The sketches of all months of a group as one, in the same columns."""
    return sketches.groupBy(*keys).agg(*[F.hll_union_agg(name).alias(name) for name in COUNTED])


def estimates(sketches: DataFrame) -> DataFrame:
    """The sketches' columns as estimated distinct counts."""
    others = [c for c in sketches.columns if c not in COUNTED]
    return sketches.select(*others, *[F.hll_sketch_estimate(name).alias(name) for name in COUNTED])


def distinct_between(sketches: DataFrame, first: datetime.date, last: datetime.date) -> DataFrame:
    """One row: estimated distinct counts of the months from that of ``first`` to that of ``last``."""
    month = F.col("month")
    return estimates(merged(sketches.filter((month >= F.trunc(F.lit(first), "month")) & (month <= F.lit(last)))))


def distinct_by_year(tables: Tables, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """Exact distinct counts of each year beside their estimates from the merged months.

    (year, counted, exact, estimate, within): whether the estimate is within four standard errors.
    The exact counts are taken from the distinct values of each year, one column after the other.
    """
    year = F.year("month").alias("year")
    found = estimates(merged(monthly_sketches(tables, log_registers), year))
    found = found.unpivot("year", list(COUNTED), "counted", "estimate")
    values = tables.production_runs.select(
        F.year("run_date").alias("year"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("counted"), F.col(c).cast("string").alias("value")) for n, c in COUNTED.items()])).alias("v"),
    ).select("year", "v.counted", "v.value")
    exact = values.groupBy("year", "counted", "value").agg(F.lit(1).alias("one")).groupBy("year", "counted").agg(F.count("value").alias("exact"))
    renamed = exact.withColumnsRenamed({"year": "_year", "counted": "_counted"})
    same = F.col("year").eqNullSafe(F.col("_year")) & (F.col("counted") == F.col("_counted"))
    off = F.abs(F.col("estimate") - F.col("exact"))
    return found.join(renamed, same).select(
        "year", "counted", "exact", "estimate", (off <= F.col("exact") * F.lit(4 * relative_error(log_registers)) + 1).alias("within")
    )
