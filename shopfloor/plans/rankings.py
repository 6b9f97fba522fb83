"""Runs ranked by efficiency, over all runs and within their plant."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.ordering import pg_asc
from shopfloor.operators.joins import DEFAULT_LIMITS, JoinLimits, attach, materialize_measured
from shopfloor.operators.ranking import count_cells, rank_cells
from shopfloor.sources.tables import Tables
from shopfloor.storage import materialize

KEYS = ["plant_id", "efficiency_pct"]
GLOBAL, WITHIN = "global_efficiency_rank", "efficiency_rank_within_plant"


def ranked_cells(tables: Tables) -> DataFrame:
    """One row per row of ``plants`` and efficiency value met there, with both ranks.

    A plant id that occurs k times in ``plants`` yields each of its runs k times, and ranks count
    joined rows; hence the factor.
    """
    plants = tables.plants.select("plant_id", "plant_name")
    copies = plants.groupBy("plant_id").agg(F.count(F.lit(1)).alias("copies"))
    cells = (
        count_cells(tables.production_runs, ["plant_id"], "efficiency_pct")
        .join(copies, "plant_id")
        .select(*KEYS, (F.col("n") * F.col("copies")).alias("n"))
    )
    overall = rank_cells(
        cells.groupBy(F.col("efficiency_pct").alias("value")).agg(F.sum("n").alias("n")), "value", GLOBAL
    ).drop("n")
    within = rank_cells(cells, "efficiency_pct", WITHIN, by=["plant_id"]).drop("n")
    return (
        within.join(overall, F.col("efficiency_pct").eqNullSafe(F.col("value")))
        .drop("value")
        .join(plants, "plant_id")
    )


def _columns(df: DataFrame) -> DataFrame:
    return df.select(
        "run_id",
        "plant_name",
        "run_date",
        "shift",
        "efficiency_pct",
        "actual_units",
        "defective_units",
        GLOBAL,
        WITHIN,
    )


def _runs(tables: Tables) -> DataFrame:
    return tables.production_runs.select(
        "run_id", "plant_id", "run_date", "shift", "efficiency_pct", "actual_units", "defective_units"
    )


def efficiency_rank(tables: Tables, limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """Every run with both ranks; two passes over the runs and no sort of them."""
    cells = materialize_measured(ranked_cells(tables), "efficiency-ranks")
    return _columns(attach(_runs(tables), cells, KEYS, null_safe=["efficiency_pct"], limits=limits))


def _best(tables: Tables, rows: int) -> DataFrame:
    """The first rows by plant name and rank.

    Each cell stands for at least one run, so the first ``rows`` cells in the same order hold all
    the runs wanted, and only those runs are joined and sorted.
    """
    order = [pg_asc("plant_name"), pg_asc(WITHIN), pg_asc("plant_id")]
    first = materialize(ranked_cells(tables).orderBy(*order, pg_asc("efficiency_pct")).limit(rows), "first-ranks")
    # Equal (id, name) pairs in ``plants`` may be cut by the limit; the runs are matched with whole cells.
    cells = first.select(*KEYS, GLOBAL, WITHIN).distinct().withColumnsRenamed({k: f"_{k}" for k in KEYS})
    same = (F.col("plant_id") == F.col("_plant_id")) & F.col("efficiency_pct").eqNullSafe(F.col("_efficiency_pct"))
    runs = _runs(tables).join(F.broadcast(cells), same).drop("_plant_id", "_efficiency_pct")
    names = tables.plants.select("plant_id", "plant_name").join(
        F.broadcast(first.select("plant_id").distinct()), "plant_id", "left_semi"
    )
    return runs.join(names, "plant_id").orderBy(*order, pg_asc("run_id")).limit(rows)


def efficiency_rank_top50(tables: Tables) -> DataFrame:
    return _columns(_best(tables, 50))


def efficiency_rank_top20(tables: Tables) -> DataFrame:
    columns: Sequence = ["plant_name", "run_date", "shift", "efficiency_pct"]
    return _best(tables, 20).select(
        *columns, F.col(GLOBAL).alias("global_rank"), F.col(WITHIN).alias("rank_within_plant")
    )
