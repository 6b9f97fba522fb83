"""Business aggregations by plant, shift and product category.

Every report adds up the runs (or checks) per id before it touches a dimension. What is joined and
grouped again afterwards has one row per id, whatever the share of the hottest id.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.numeric import mean_of_hundredths, percent, ratio, sum_of_hundredths
from shopfloor.functions.ordering import pg_asc, pg_desc
from shopfloor.sources.tables import Tables

# Sums and counts of runs that can be added up again at a coarser grain.
PARTS = {
    "total_runs": lambda: F.count("run_id"),
    "units": lambda: F.sum("actual_units"),
    "defects": lambda: F.sum("defective_units"),
    "efficiency": lambda: sum_of_hundredths(F.col("efficiency_pct")),
    "efficiency_n": lambda: F.count("efficiency_pct"),
    "downtime": lambda: F.sum("downtime_mins"),
    "downtime_n": lambda: F.count("downtime_mins"),
}


def run_parts(runs: DataFrame, *keys: str | Column) -> DataFrame:
    return runs.groupBy(*keys).agg(*[make().alias(name) for name, make in PARTS.items()])


def add_parts(parts: DataFrame, *keys: str) -> DataFrame:
    return parts.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in PARTS])


def defect_rate() -> Column:
    return percent(F.col("defects"), F.col("units")).alias("defect_rate_pct")


def average_efficiency() -> Column:
    return mean_of_hundredths(F.col("efficiency"), F.col("efficiency_n")).alias("avg_efficiency_pct")


def _by_plant(tables: Tables, *attributes: str) -> DataFrame:
    """Parts per plant; plants of equal name stay apart because the id is part of the group."""
    keys = ["plant_id", *attributes]
    return add_parts(run_parts(tables.production_runs, "plant_id").join(tables.plants.select(*keys), "plant_id"), *keys)


def defect_rate_by_plant(tables: Tables) -> DataFrame:
    return (
        _by_plant(tables, "plant_name", "city")
        .select(
            "plant_id",
            "plant_name",
            "city",
            "total_runs",
            F.col("units").alias("total_units_produced"),
            F.col("defects").alias("total_defects"),
            defect_rate(),
            average_efficiency(),
            F.col("downtime").alias("total_downtime_mins"),
        )
        .orderBy(pg_desc("defect_rate_pct"), pg_asc("plant_id"))
        .drop("plant_id")
    )


def defect_rate_top10(tables: Tables) -> DataFrame:
    return (
        _by_plant(tables, "plant_name", "city")
        .select(
            "plant_id",
            "plant_name",
            "city",
            "total_runs",
            F.col("defects").alias("total_defects"),
            defect_rate(),
            average_efficiency(),
        )
        .orderBy(pg_desc("defect_rate_pct"), pg_asc("plant_id"), pg_asc("plant_name"), pg_asc("city"))
        .limit(10)
        .drop("plant_id")
    )


def efficiency_by_shift(tables: Tables) -> DataFrame:
    return (
        run_parts(tables.production_runs, "shift")
        .select(
            "shift",
            "total_runs",
            average_efficiency(),
            F.col("defects").alias("total_defects"),
            ratio(F.col("downtime"), F.col("downtime_n"), 1).alias("avg_downtime_mins"),
        )
        .orderBy(pg_desc("avg_efficiency_pct"), pg_asc("shift"))
    )


def pass_rate_by_category(tables: Tables) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("total_checks", "total_passed", "total_failed")]
    per_run = tables.quality_checks.groupBy("run_id").agg(
        F.count("check_id").alias("total_checks"),
        F.sum("passed").alias("total_passed"),
        F.sum("failed").alias("total_failed"),
    )
    per_product = (
        per_run.join(tables.production_runs.select("run_id", "product_id"), "run_id").groupBy("product_id").agg(*sums)
    )
    return (
        per_product.join(tables.products.select("product_id", "category"), "product_id")
        .groupBy(F.col("category").alias("product_category"))
        .agg(*sums)
        .withColumn(
            "pass_rate_pct", percent(F.col("total_passed"), F.col("total_passed") + F.col("total_failed"))
        )
        .orderBy(pg_desc("pass_rate_pct"), pg_asc("product_category"))
    )


def pass_rate_by_category_short(tables: Tables) -> DataFrame:
    return pass_rate_by_category(tables).drop("total_failed")


def plant_efficiency_summary(tables: Tables) -> DataFrame:
    return (
        _by_plant(tables, "plant_name", "city")
        .select(
            "plant_id",
            "plant_name",
            "city",
            "total_runs",
            average_efficiency(),
            F.col("units").alias("total_units"),
            F.col("defects").alias("total_defects"),
            defect_rate(),
            ratio(F.col("units"), F.col("total_runs"), 0).alias("avg_units_per_run"),
        )
        .orderBy(pg_desc("avg_efficiency_pct"), pg_asc("plant_id"))
        .drop("plant_id")
    )


def plant_efficiency_short(tables: Tables) -> DataFrame:
    """Summary grouped by id and name only, with the rate taken outside the aggregate."""
    return (
        _by_plant(tables, "plant_name")
        .select(
            "plant_id",
            "plant_name",
            "total_runs",
            average_efficiency(),
            F.col("units").alias("total_units"),
            F.col("defects").alias("total_defects"),
            defect_rate(),
        )
        .orderBy(pg_desc("avg_efficiency_pct"), pg_asc("plant_id"))
        .drop("plant_id")
    )
