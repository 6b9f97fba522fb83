"""Runs and checks joined and rolled up where they lie, over bucketed tables.

Neither the roll-up of the checks nor its join with the runs moves a row: both tables are partitioned
by run as read. Only hot runs are rolled up by shuffle, of one partial row a task and run.
"""

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.numeric import percent
from shopfloor.functions.ordering import pg_asc, pg_desc
from shopfloor.operators.joins import DEFAULT_LIMITS, JoinLimits
from shopfloor.plans.extract import extended, quality_rollup, with_yield
from shopfloor.sources.bucketed import BucketedTables


def colocated_rollup(tables: BucketedTables) -> DataFrame:
    """``quality_rollup`` of all checks; a run is in one of the two parts only."""
    return quality_rollup(tables.bucketed("quality_checks")).unionByName(quality_rollup(tables.rest("quality_checks")))


def runs_with_rollup(tables: BucketedTables) -> DataFrame:
    """Every run with its checks added up; runs without any have NULL.

    Runs kept aside (without an id, or of an id that many rows share) match in the second join only,
    as do the checks of hot runs: there are few such runs, so their roll-up is small.
    """
    rollup = quality_rollup(tables.bucketed("quality_checks"))
    hot = quality_rollup(tables.rest("quality_checks").filter(F.col("run_id").isNotNull()))
    columns = [c for c in rollup.columns if c != "run_id"]
    renamed = {c: f"_h_{c}" for c in hot.columns}
    runs = with_yield(tables.bucketed("production_runs")).join(rollup, "run_id", "left")
    both = runs.join(hot.withColumnsRenamed(renamed), F.col("run_id") == F.col("_h_run_id"), "left")
    # A hot run has no check in the bucketed part, so one side is NULL throughout.
    found = [F.when(F.col("_h_run_id").isNotNull(), F.col(f"_h_{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    own = [c for c in runs.columns if c not in columns]
    main = both.select(*own, *found)
    aside = with_yield(tables.rest("production_runs")).join(colocated_rollup(tables), "run_id", "left")
    return main.unionByName(aside.select(*main.columns))


def colocated_extract(
    tables: BucketedTables, as_of: datetime.date | None = None, limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """The extract's columns and ``plant_id`` in no order, as ``keyed_extract``, from bucketed tables."""
    return extended(runs_with_rollup(tables), tables, as_of, limits)


def colocated_pass_rate(tables: BucketedTables) -> DataFrame:
    """``pass_rate_by_category`` with runs and checks joined where they lie."""
    names = ("total_checks", "total_passed", "total_failed")
    per_run = lambda checks: checks.groupBy("run_id").agg(
        F.count("check_id").alias(names[0]), F.sum("passed").alias(names[1]), F.sum("failed").alias(names[2])
    )
    key = ["run_id", "product_id"]
    runs, aside = (part("production_runs").select(*key) for part in (tables.bucketed, tables.rest))
    checks, hot = per_run(tables.bucketed("quality_checks")), per_run(tables.rest("quality_checks"))
    sums = [F.sum(c).alias(c) for c in names]
    joined = runs.join(checks, "run_id").unionByName(runs.join(hot, "run_id")).unionByName(aside.join(checks.unionByName(hot), "run_id"))
    per_product = joined.groupBy("product_id").agg(*sums)
    return (
        per_product.join(tables.products.select("product_id", "category"), "product_id")
        .groupBy(F.col("category").alias("product_category"))
        .agg(*sums)
        .withColumn("pass_rate_pct", percent(F.col(names[1]), F.col(names[1]) + F.col(names[2])))
        .orderBy(pg_desc("pass_rate_pct"), pg_asc("product_category"))
    )
