"""Questions around the extract: shifts, maintenance, downtime, best runs, months."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.functions.numeric import hundredths, mean_of_hundredths, ratio, row_ratio, sum_of_hundredths
from shopfloor.functions.ordering import pg_asc
from shopfloor.operators import quantiles
from shopfloor.operators.joins import DEFAULT_LIMITS, JoinLimits, attach, materialize_measured
from shopfloor.operators.ranking import count_cells, rank_cells
from shopfloor.plans.extract import latest_equipment
from shopfloor.plans.reports import PARTS, add_parts, average_efficiency, defect_rate, pass_rate_by_category, run_parts
from shopfloor.sources.tables import Tables

TOP_RANK = 10
MAINTENANCE_STEP = 30


def defect_by_plant_shift(tables: Tables) -> DataFrame:
    keys = ["plant_id", "plant_name", "city", "shift"]
    parts = run_parts(tables.production_runs, "plant_id", "shift")
    named = parts.join(tables.plants.select("plant_id", "plant_name", "city"), "plant_id")
    return add_parts(named, *keys).select(
        *keys,
        "total_runs",
        F.col("units").alias("total_units_produced"),
        F.col("defects").alias("total_defects"),
        defect_rate(),
    )


def monthly_trend(tables: Tables) -> DataFrame:
    month = F.trunc("run_date", "month").alias("month")
    return run_parts(tables.production_runs, month).select(
        "month",
        "total_runs",
        F.col("units").alias("total_units_produced"),
        F.col("defects").alias("total_defects"),
        defect_rate(),
        average_efficiency(),
        F.col("downtime").alias("total_downtime_mins"),
    )


def time_rollup(tables: Tables) -> DataFrame:
    """Runs by month, quarter, year and in all: (grain, year, quarter, month, figures), ``grain`` 0 for a month to 3 for all.

    The runs are added up by month once; the coarser rows add up those, few as they are. Runs
    without a date have NULL for all three at grain 0, 1 and 2.
    """
    month = F.trunc("run_date", "month").alias("month")
    parts = run_parts(tables.production_runs, month).withColumns({"year": F.year("month"), "quarter": F.quarter("month")})
    grain = F.grouping("year") + F.grouping("quarter") + F.grouping("month")
    rolled = parts.rollup("year", "quarter", "month").agg(grain.cast("int").alias("grain"), *[F.sum(name).alias(name) for name in PARTS])
    return rolled.select(
        "grain",
        "year",
        "quarter",
        "month",
        F.coalesce("total_runs", F.lit(0)).alias("total_runs"),
        F.col("units").alias("total_units_produced"),
        F.col("defects").alias("total_defects"),
        defect_rate(),
        average_efficiency(),
        F.col("downtime").alias("total_downtime_mins"),
    )


#: Shares of the ranks that the distribution reports show.
SHARES = {"p10": Decimal("0.1"), "median": Decimal("0.5"), "p90": Decimal("0.9"), "p99": Decimal("0.99")}


def _measured(tables: Tables) -> DataFrame:
    """Units a minute of downtime, a ratio with as many distinct values as runs."""
    speed = F.col("actual_units").cast("double") / (F.col("downtime_mins") + 1).cast("double")
    return tables.production_runs.select("plant_id", "shift", F.trunc("run_date", "month").alias("month"), speed.alias("speed"))


def output_quantiles(tables: Tables) -> DataFrame:
    """(plant_id, shift, p10, median, p90, p99): exact quantiles of the units made per minute of downtime and one.

    From a summary in cells and a second look at the few cells that hold the quantiles; no task sorts
    the runs of a plant.
    """
    keys, runs = ["plant_id", "shift"], _measured(tables)
    found = quantiles.exact(runs, quantiles.summarize(runs, keys, "speed"), keys, "speed", list(SHARES.values()))
    columns = [F.max(F.when(F.col("share") == F.lit(share), F.col("value"))).alias(name) for name, share in SHARES.items()]
    return found.groupBy(*keys).agg(*columns)


def output_quantiles_by_year(tables: Tables) -> DataFrame:
    """(year, share, total, exact, bounded, rank_error_ok): quantiles of whole years from merged monthly summaries.

    ``bounded`` says whether the exact value lies within the merged summary's bounds, ``rank_error_ok``
    whether these are no further than a fiftieth of the ranks off.
    """
    runs = _measured(tables).withColumn("year", F.year("month"))
    monthly = quantiles.summarize(runs, ["month"], "speed")
    yearly = quantiles.merge(monthly.withColumn("year", F.year("month")), ["year"])
    shares = list(SHARES.values())
    bounds = quantiles.bounds(yearly, ["year"], shares)
    exact = quantiles.exact(runs, yearly, ["year"], "speed", shares).withColumnsRenamed({"year": "_year", "share": "_share"})
    same = F.col("year").eqNullSafe(F.col("_year")) & (F.col("share") == F.col("_share"))
    return bounds.join(exact, same).select(
        "year",
        F.col("share").cast("double").alias("share"),
        "total",
        F.col("value").alias("exact"),
        F.col("value").between(F.col("low"), F.col("high")).alias("bounded"),
        (F.col("rank_error") <= 0.02).alias("rank_error_ok"),
    )


def _pearson(n: Column, x: Column, y: Column, xx: Column, yy: Column, xy: Column) -> Column:
    """Correlation from sums held as whole decimals, so that the differences lose nothing."""
    root = F.sqrt((n * xx - x * x).cast("double")) * F.sqrt((n * yy - y * y).cast("double"))
    return F.round((n * xy - x * y).cast("double") / F.nullif(root, F.lit(0.0)), 6)


def _moments(x: Column, y: Column, name: str) -> list[Column]:
    """Sums over the rows where both whole numbers are present, wide enough for any row count."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("decimal(18,0)")), F.when(both, y.cast("decimal(18,0)"))
    terms = {"n": both.cast("bigint"), "x": x, "y": y, "xx": x * x, "yy": y * y, "xy": x * y}
    return [F.sum(term.cast("decimal(38,0)")).alias(f"{name}_{k}") for k, term in terms.items()]


def _correlation(name: str) -> Column:
    return _pearson(*[F.col(f"{name}_{k}") for k in ("n", "x", "y", "xx", "yy", "xy")])


def maintenance_vs_quality(extract: DataFrame) -> DataFrame:
    """Efficiency, defects and downtime by age of the last maintenance, in steps of 30 days."""
    first_day = (F.floor(F.col("days_since_maintenance") / MAINTENANCE_STEP) * MAINTENANCE_STEP).cast("bigint")
    return (
        extract.groupBy(first_day.alias("from_day"))
        .agg(
            F.count(F.lit(1)).alias("runs"),
            sum_of_hundredths(F.col("efficiency_pct")).alias("e"),
            F.count("efficiency_pct").alias("en"),
            F.sum(hundredths(F.col("defect_rate_pct"))).alias("d"),
            F.count("defect_rate_pct").alias("dn"),
            F.sum("downtime_mins").alias("t"),
            F.count("downtime_mins").alias("tn"),
        )
        .select(
            "from_day",
            "runs",
            mean_of_hundredths(F.col("e"), F.col("en")).alias("avg_efficiency_pct"),
            mean_of_hundredths(F.col("d"), F.col("dn")).alias("avg_defect_rate_pct"),
            ratio(F.col("t"), F.col("tn"), 1).alias("avg_downtime_mins"),
        )
    )


def quality_correlations(extract: DataFrame) -> DataFrame:
    """Pearson correlation of maintenance age and downtime with efficiency, defect rate and yield."""
    days, downtime = F.col("days_since_maintenance"), F.col("downtime_mins")
    efficiency, defects, produced = (
        hundredths(F.col(c)) for c in ("efficiency_pct", "defect_rate_pct", "yield_pct")
    )
    pairs = {
        "maintenance_efficiency": (days, efficiency),
        "maintenance_defect_rate": (days, defects),
        "downtime_defect_rate": (downtime, defects),
        "downtime_yield": (downtime, produced),
    }
    sums = extract.agg(*[c for name, (x, y) in pairs.items() for c in _moments(x, y, name)])
    named = [F.struct(F.col(f"{p}_n").cast("bigint").alias("runs"), _correlation(p).alias("correlation")).alias(p) for p in pairs]
    return sums.select(*named).unpivot([], list(pairs), "pair", "found").select("pair", "found.*")


def category_vs_target(tables: Tables, targets: DataFrame) -> DataFrame:
    """Pass rate of each category beside its target (``product_category``, ``target_pct``), if it has one.

    Whether the target is met is decided on the counts, not on the rounded rate.
    """
    passed, checked = F.col("total_passed"), F.col("total_passed") + F.col("total_failed")
    return (
        pass_rate_by_category(tables)
        .join(targets.select("product_category", "target_pct"), "product_category", "left")
        .select(
            "product_category",
            "total_checks",
            "pass_rate_pct",
            "target_pct",
            (passed * 100 < checked * F.col("target_pct")).alias("under_target"),
        )
    )


def _share_reached(share: Decimal) -> Column:
    """Smallest value up to which at least ``share`` of the counted rows lie (``PERCENTILE_DISC``)."""
    return F.min(F.when(F.col("upto") >= F.col("all") * F.lit(share), F.col("downtime_mins")))


def downtime_vs_yield(tables: Tables) -> DataFrame:
    """Distribution of downtime by plant and shift and its correlation with yield.

    One pass counts the runs per plant, shift and minute; percentiles and correlation follow from
    those counts, exactly.
    """
    keys = ["plant_id", "shift"]
    minutes = F.col("downtime_mins").cast("bigint")
    runs = tables.production_runs.withColumn(
        "y", hundredths(row_ratio(F.col("actual_units"), F.col("planned_units"), percent=True))
    )
    cells = (
        runs.groupBy(*keys, "downtime_mins")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.count("y").alias("yn"),
            F.sum("y").alias("y"),
            F.sum(F.col("y").cast("decimal(18,0)") * F.col("y").cast("decimal(18,0)")).alias("yy"),
        )
        .withColumn("counted", F.when(minutes.isNotNull(), F.col("runs")).otherwise(0))
    )
    whole = Window.partitionBy(*keys)
    running = whole.orderBy(pg_asc("downtime_mins")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("upto", F.sum("counted").over(running)).withColumn("all", F.sum("counted").over(whole))

    known = minutes.isNotNull()
    x, yn = minutes.cast("decimal(10,0)"), F.when(known, F.col("yn")).cast("decimal(14,0)")
    y, yy = F.when(known, F.col("y")).cast("decimal(18,0)"), F.when(known, F.col("yy"))
    terms = {"n": yn, "x": x * yn, "y": y, "xx": x * x * yn, "yy": yy, "xy": x * y}
    parts = cells.groupBy(*keys).agg(
        F.sum("runs").alias("runs"),
        _share_reached(Decimal("0.5")).alias("median_downtime_mins"),
        _share_reached(Decimal("0.9")).alias("p90_downtime_mins"),
        F.sum("y").alias("y"),
        F.sum("yn").alias("yn"),
        *[F.sum(term).alias(f"c_{k}") for k, term in terms.items()],
    )
    return parts.join(tables.plants.select("plant_id", "plant_name"), "plant_id").select(
        "plant_id",
        "plant_name",
        "shift",
        "runs",
        "median_downtime_mins",
        "p90_downtime_mins",
        mean_of_hundredths(F.col("y"), F.col("yn")).alias("avg_yield_pct"),
        _correlation("c").alias("downtime_yield_correlation"),
    )


def top_run_conditions(tables: Tables, rank: int = TOP_RANK, limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """Under which shift, product category and equipment status the best runs of each plant were made.

    Best are the runs with a known efficiency of at most the given rank within their plant, that is,
    at or above a cutoff per plant. They are counted per plant, shift and product before the joins.
    """
    runs = tables.production_runs.filter(F.col("efficiency_pct").isNotNull()).select(
        "run_id", "plant_id", "product_id", "shift", "efficiency_pct"
    )
    cells = count_cells(runs, ["plant_id"], "efficiency_pct")
    cutoffs = (
        rank_cells(cells, "efficiency_pct", "place", by=["plant_id"])
        .filter(F.col("place") <= rank)
        .groupBy("plant_id")
        .agg(F.min("efficiency_pct").alias("cutoff"))
        .join(tables.plants.select("plant_id"), "plant_id")
    )
    best = (
        attach(runs, materialize_measured(cutoffs, "cutoffs"), ["plant_id"], limits=limits)
        .filter(F.col("efficiency_pct") >= F.col("cutoff"))
        .groupBy("plant_id", "shift", "product_id")
        .agg(F.count(F.lit(1)).alias("n"), sum_of_hundredths(F.col("efficiency_pct")).alias("e"))
    )
    status = latest_equipment(tables.equipment).select("plant_id", "equipment_status")
    return (
        best.join(tables.products.select("product_id", F.col("category").alias("product_category")), "product_id")
        .join(status, "plant_id", "left")
        .groupBy("shift", "product_category", "equipment_status")
        .agg(F.sum("n").alias("runs"), mean_of_hundredths(F.sum("e"), F.sum("n")).alias("avg_efficiency_pct"))
    )
