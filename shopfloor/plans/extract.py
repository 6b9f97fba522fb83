"""The run-level extract: one row per run of an active plant and product, 34 columns."""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.functions.numeric import percent, row_ratio
from shopfloor.functions.ordering import newest_first, pg_asc, pg_desc
from shopfloor.operators.grouping import first_mode, latest_per_group
from shopfloor.operators.joins import DEFAULT_LIMITS, JoinLimits, attach, materialize_measured
from shopfloor.schemas import EXTRACT
from shopfloor.sources.tables import Tables
from shopfloor.storage import materialize


# What tells the runs of a hot plant or product apart, few columns so that the others can be pruned.
ROW = ["run_id", "run_date", "shift"]


def quality_rollup(checks: DataFrame) -> DataFrame:
    """Checks added up per run, with the most frequent defect type and severity.

    Each check counts once under its defect type and once under its severity.
    The counts are combined on the map side, so that no task holds the labels of a whole run.
    """
    numbers = ["check_id", "sample_size", "passed", "failed"]
    labelled = checks.select(
        "run_id",
        F.stack(
            F.lit(2),
            *[F.lit("defect"), "defect_type", *numbers],
            *[F.lit("severity"), "severity", *[F.lit(None).cast(checks.schema[c].dataType) for c in numbers]],
        ).alias("kind", "label", *numbers),
    )
    per_label = labelled.groupBy("run_id", "kind", "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("check_id").alias("checks"),
        F.sum("sample_size").alias("sampled"),
        F.sum("passed").alias("passed"),
        F.sum("failed").alias("failed"),
    )
    kind, label, n = F.col("kind"), F.col("label"), F.col("n")
    sums = per_label.groupBy("run_id").agg(
        F.sum("checks").alias("total_checks"),
        F.sum("sampled").alias("total_sampled"),
        F.sum("passed").alias("total_passed"),
        F.sum("failed").alias("total_failed"),
        first_mode(kind, "defect", label, n).alias("primary_defect_type"),
        first_mode(kind, "severity", label, n).alias("primary_severity"),
    )
    return sums.select(
        "run_id",
        "total_checks",
        "total_sampled",
        "total_passed",
        "total_failed",
        percent(F.col("total_failed"), F.col("total_sampled")).alias("defect_rate_pct"),
        "primary_defect_type",
        "primary_severity",
    )


def as_of_date(as_of: datetime.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def latest_equipment(equipment: DataFrame, as_of: datetime.date | None = None) -> DataFrame:
    """Most recently maintained machine of each plant; a machine without a date comes first.

    The id and then the remaining columns settle equal dates.
    """
    others = ["equipment_id", "equipment_name", "equipment_type", "status", "efficiency_pct"]
    order = [pg_desc("last_maintenance"), *[pg_asc(c) for c in others]]
    return latest_per_group(equipment, "plant_id", order).select(
        "plant_id",
        "equipment_name",
        "equipment_type",
        F.col("status").alias("equipment_status"),
        F.col("efficiency_pct").alias("equipment_efficiency_pct"),
        F.datediff(as_of_date(as_of), "last_maintenance").alias("days_since_maintenance"),
    )


def _plant_context(tables: Tables, as_of: datetime.date | None) -> DataFrame:
    """Active plants with their latest machine: still one row per row of ``plants``."""
    plants = tables.plants.filter(F.col("is_active") == F.lit(True)).select(
        "plant_id",
        "plant_name",
        F.col("city").alias("plant_city"),
        F.col("country").alias("plant_country"),
        "plant_type",
        F.col("capacity_units").alias("plant_capacity"),
        "employees_count",
    )
    return plants.join(latest_equipment(tables.equipment, as_of), "plant_id", "left")


def _active_products(tables: Tables) -> DataFrame:
    return tables.products.filter(F.col("is_active") == F.lit(True)).select(
        "product_id",
        "product_code",
        "product_name",
        F.col("category").alias("product_category"),
        "unit_cost",
        "target_price",
        "lead_time_days",
    )


def _with_rollup(runs: DataFrame, checks: DataFrame) -> DataFrame:
    """Every run with its checks added up; runs without an id, of which there may be many, are spread over all tasks.

    They match nothing, so any value may stand for their key as long as it is told apart by the condition.
    """
    spread = F.pmod(F.xxhash64(*[c for c in runs.columns if c != "run_id"]), F.lit(2**31 - 1))
    if not isinstance(runs.schema["run_id"].dataType, T.LongType):
        spread = spread.cast(runs.schema["run_id"].dataType)
    keyed = runs.withColumn("_key", F.coalesce("run_id", spread))
    rollup = quality_rollup(checks).withColumnRenamed("run_id", "_run")
    return keyed.join(rollup, (F.col("_key") == F.col("_run")) & F.col("run_id").isNotNull(), "left").drop("_key", "_run")


def with_yield(runs: DataFrame) -> DataFrame:
    return runs.withColumn("yield_pct", row_ratio(F.col("actual_units"), F.col("planned_units"), percent=True))


def keyed_extract(
    tables: Tables, as_of: datetime.date | None = None, limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """The extract's columns and ``plant_id``, in no order.

    The checks are joined first, while the run rows are narrow; plant and product attributes are
    added last, without a further shuffle where they fit a broadcast.
    """
    return extended(_with_rollup(with_yield(tables.production_runs), tables.quality_checks), tables, as_of, limits)


def extended(
    with_checks: DataFrame, tables: Tables, as_of: datetime.date | None = None, limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Runs that carry their rolled-up checks, with plant, product and machine: the extract's columns and ``plant_id``.

    The plant context comes from a window over the equipment, so it is written once before its size is measured.
    """
    runs = tables.production_runs
    context = materialize_measured(_plant_context(tables, as_of), "plant-context")
    with_plants = attach(with_checks, context, ["plant_id"], limits=limits, keys_from=runs, slice_by=ROW)
    joined = attach(with_plants, _active_products(tables), ["product_id"], limits=limits, keys_from=runs, slice_by=ROW)
    return joined.select(*EXTRACT.fieldNames(), "plant_id")


def run_extract(
    tables: Tables,
    as_of: datetime.date | None = None,
    ordered: bool = True,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """The extract, newest runs first, then by plant id (not shown), shift and run id."""
    keyed = keyed_extract(tables, as_of, limits)
    if ordered:
        keyed = keyed.orderBy(*newest_first("plant_id"))
    return keyed.drop("plant_id")


def join_preview(tables: Tables, rows: int = 10, limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """The newest runs with plant, product and latest machine, inactive plants and products included.

    The machine is looked up after the limit: it neither adds nor removes rows.
    """
    newest = [pg_desc("run_date"), pg_asc("run_id")]
    runs = tables.production_runs.select("run_id", "plant_id", "product_id", "run_date", "shift", "efficiency_pct")
    plants = tables.plants.select("plant_id", "plant_name", F.col("city").alias("plant_city"))
    products = tables.products.select("product_id", "product_name", F.col("category").alias("product_category"))
    joined = attach(attach(runs, plants, ["plant_id"], limits=limits), products, ["product_id"], limits=limits)
    # Used twice below; written once so that the runs are read once.
    top = materialize(joined.orderBy(*newest).limit(rows), "newest-runs")
    equipment = tables.equipment.join(F.broadcast(top.select("plant_id").distinct()), "plant_id", "left_semi")
    latest = latest_equipment(equipment).select("plant_id", "equipment_name", "equipment_status")
    return (
        top.join(latest, "plant_id", "left")
        .orderBy(*newest)
        .select(
            "run_id",
            "run_date",
            "shift",
            "efficiency_pct",
            "plant_name",
            "plant_city",
            "product_name",
            "product_category",
            "equipment_name",
            "equipment_status",
        )
    )
