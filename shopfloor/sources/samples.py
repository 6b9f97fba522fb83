"""The five tables derived from the order/supplier/event sample files used for tests and benchmarks.

Each derived table is a plain DataFrame over the parquet files, so its size follows theirs.
"""

from dataclasses import dataclass
from decimal import Decimal
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopfloor.sources.tables import Tables

# Orders and lines that one task joins.
SLICE_ROWS = 1_000_000


def _plants(read) -> DataFrame:
    return (
        read("supplier")
        .join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("plant_id"),
            F.col("s_name").alias("plant_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            F.concat(F.lit("T"), (F.col("s_suppkey") % 3).cast("string")).alias("plant_type"),
            (F.col("s_suppkey") * 100 + 5000).cast("int").alias("capacity_units"),
            (F.col("s_suppkey") % 450 + 50).cast("int").alias("employees_count"),
            (F.col("s_acctbal") > 0).alias("is_active"),
        )
    )


def _products(read) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(12,2)")
    return read("part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("product_code"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        price.alias("unit_cost"),
        (price * F.lit(Decimal(2))).cast("decimal(14,2)").alias("target_price"),
        F.col("p_size").alias("lead_time_days"),
        (F.col("p_size") <= 45).alias("is_active"),
    )


def _in_slices(df: DataFrame, rows: int, key: str) -> DataFrame:
    """Dealt out by ``key`` so that a task gets about ``SLICE_ROWS`` of ``rows``, however well they compress.

    Spark merges partitions by their compressed bytes, of which a task's memory is a large and
    uncertain multiple; it leaves a given number alone. Where every core gets fewer rows than that
    anyway, the number is left to Spark.
    """
    slices = -(-rows // SLICE_ROWS)
    return df.repartition(slices, key) if slices > df.sparkSession.sparkContext.defaultParallelism else df


def _production_runs(read) -> DataFrame:
    quantity = F.col("l_quantity").cast("int")
    items = read("lineitem").select(
        "l_orderkey",
        "l_suppkey",
        "l_partkey",
        quantity.alias("units"),
        F.when(F.col("l_returnflag") == "R", quantity).otherwise(0).alias("returned"),
    )
    # Both sides in as many slices, so that the join needs no further shuffle.
    rows = read.rows("orders") + read.rows("lineitem")
    lines = (
        _in_slices(items, rows, "l_orderkey")
        .groupBy("l_orderkey")
        .agg(
            F.min("l_suppkey").alias("plant_id"),
            F.min("l_partkey").alias("product_id"),
            F.sum("units").alias("actual_units"),
            F.sum("returned").alias("defective_units"),
        )
    )
    key = F.col("o_orderkey")
    efficiency = (
        F.when(key % 50 == 0, F.lit(Decimal("0.00")).cast("decimal(5,2)"))
        .when(key % 97 == 0, F.lit(None).cast("decimal(5,2)"))
        .otherwise((F.col("o_totalprice").cast("decimal(12,2)") % F.lit(Decimal(100))).cast("decimal(5,2)"))
    )
    return (
        _in_slices(read("orders"), rows, "o_orderkey")
        .join(lines, key == F.col("l_orderkey"), "left")
        .select(
            key.alias("run_id"),
            "plant_id",
            "product_id",
            F.col("o_orderdate").cast("date").alias("run_date"),
            F.col("o_orderpriority").alias("shift"),
            F.concat(F.lit("Operator-"), (F.col("o_custkey") % 80 + 1).cast("string")).alias("operator"),
            (F.col("actual_units") + (key % 5) * 10).alias("planned_units"),
            "actual_units",
            "defective_units",
            efficiency.alias("efficiency_pct"),
            (key % 181).cast("int").alias("downtime_mins"),
        )
    )


def _quality_checks(read) -> DataFrame:
    sample = F.col("l_quantity").cast("int")
    failed = F.floor(F.col("l_quantity") * F.col("l_discount")).cast("int")

    def label(letter: str, number):
        return F.concat(F.lit(letter), number.cast("string"))

    defect, severity = F.col("l_partkey") % 6, F.col("l_suppkey") % 4
    return (
        read("lineitem")
        .filter(F.col("l_returnflag") == "R")
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("check_id"),
            F.col("l_orderkey").alias("run_id"),
            sample.alias("sample_size"),
            (sample - failed).alias("passed"),
            failed.alias("failed"),
            F.when(defect != 5, label("D", defect)).alias("defect_type"),
            F.when(severity != 3, label("S", severity)).alias("severity"),
        )
    )


def _equipment(read) -> DataFrame:
    return (
        read("events")
        .filter(F.col("user_id") % 10 != 0)
        .select(
            F.col("event_id").alias("equipment_id"),
            F.col("user_id").alias("plant_id"),
            F.concat(F.lit("EQ-"), F.col("event_id").cast("string")).alias("equipment_name"),
            F.col("event_type").alias("equipment_type"),
            F.col("event_type").alias("status"),
            F.col("value").cast("decimal(7,2)").alias("efficiency_pct"),
            F.when(F.col("event_id") % 500 != 0, F.col("ts").cast("date")).alias("last_maintenance"),
        )
    )


_DERIVED = {
    "production_runs": _production_runs,
    "quality_checks": _quality_checks,
    "equipment": _equipment,
    "plants": _plants,
    "products": _products,
}


@lru_cache(maxsize=256)
def _schema(spark: SparkSession, path: str) -> StructType:
    """Looked up in a file once per session; every further read of it then starts without a job."""
    return spark.read.parquet(path).schema


@lru_cache(maxsize=256)
def _rows(spark: SparkSession, path: str) -> int:
    """Counted in the files' footers once per session; it settles only into how many tasks work is cut."""
    return spark.read.schema(_schema(spark, path)).parquet(path).count()


@dataclass(frozen=True)
class _Reader:
    """The sample files of a folder, by name."""

    spark: SparkSession
    folder: str

    def __call__(self, name: str) -> DataFrame:
        path = self._path(name)
        return self.spark.read.schema(_schema(self.spark, path)).parquet(path)

    def rows(self, name: str) -> int:
        return _rows(self.spark, self._path(name))

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"


def from_samples(spark: SparkSession, folder: str) -> Tables:
    read = _Reader(spark, folder)
    return Tables(spark, lambda name: _DERIVED[name](read))
