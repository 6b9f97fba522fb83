"""Seeded run-level test data with the extract's 34 columns and its typical faults."""

import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.functions.numeric import row_ratio
from shopfloor.schemas import EXTRACT

# Fixed values of the generated data.
PLANTS = [
    ("Detroit Auto Plant", "Detroit", "USA", "Assembly"),
    ("Chicago Steel Works", "Chicago", "USA", "Fabrication"),
    ("Munich Precision Parts", "Munich", "Germany", "CNC Machining"),
    ("Osaka Electronics Hub", "Osaka", "Japan", "Electronics"),
    ("São Paulo Composites", "São Paulo", "Brazil", "Composites"),
]
PRODUCTS = [
    ("AUTO-001", "Engine Block", "Automotive", "420.00", "680.00"),
    ("ELEC-002", "Control Board", "Electronics", "85.00", "150.00"),
    ("STEEL-003", "Steel Beam 6m", "Structural", "210.00", "340.00"),
    ("COMP-004", "Carbon Fibre Panel", "Composites", "310.00", "520.00"),
    ("PREC-005", "Gear Assembly", "Precision", "175.00", "290.00"),
]
EQUIPMENT = [
    ("CNC Machine", "Operational"),
    ("Conveyor Belt", "Maintenance"),
    ("Welding Robot", "Operational"),
    ("Press Machine", "Operational"),
    ("Laser Cutter", "Standby"),
]
SHIFTS = ["Morning", "Afternoon", "Night"]
DEFECT_TYPES = ["Surface Scratch", "Dimensional Error", "Material Flaw", "Assembly Fault", "Contamination", None]
SEVERITIES = ["Low", "Medium", "High", None]


def numbered(spark: SparkSession, n: int = 300) -> DataFrame:
    """Run ids 1 to n."""
    return spark.range(1, n + 1).withColumnRenamed("id", "run_id")


class _Draws:
    """Values that depend on seed, name and run id only, so neither partitioning nor retries change them."""

    def __init__(self, seed: int):
        self.seed = seed

    def _hash(self, name: str) -> Column:
        return F.xxhash64(F.lit(self.seed), F.lit(name), F.col("run_id"))

    def integer(self, name: str, low: int, high: int) -> Column:
        """Uniform over low..high, both included."""
        return (F.lit(low) + F.pmod(self._hash(name), F.lit(high - low + 1))).cast("int")

    def real(self, name: str, low: float, high: float) -> Column:
        """Uniform over [low, high), from the upper 53 bits of the hash."""
        unit = F.shiftrightunsigned(self._hash(name), 11) / F.lit(float(2**53))
        return F.lit(low) + F.lit(high - low) * unit

    def choice(self, name: str, values: list) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), self.integer(name, 1, len(values)))

    def record(self, name: str, records: list[tuple], fields: list[str]) -> Column:
        rows = [F.struct(*[F.lit(v).alias(f) for v, f in zip(r, fields)]) for r in records]
        return F.element_at(F.array(*rows), self.integer(name, 1, len(records)))


def synthetic_runs(ids: DataFrame, as_of: datetime.date, seed: int = 42) -> DataFrame:
    """One generated extract row per ``run_id`` of ``ids``.

    About 20% of the runs have no checks, 10% no equipment and 2% an efficiency of zero.
    """
    draw = _Draws(seed)
    runs = ids.select("run_id").select(
        "run_id",
        draw.record("plant", PLANTS, ["name", "city", "country", "type"]).alias("plant"),
        draw.record("product", PRODUCTS, ["code", "name", "category", "cost", "price"]).alias("product"),
        draw.record("equipment", EQUIPMENT, ["name", "status"]).alias("machine"),
        draw.integer("planned", 200, 800).alias("planned_units"),
        (draw.real("has check", 0.0, 1.0) > 0.20).alias("checked"),
        (draw.real("has equipment", 0.0, 1.0) > 0.10).alias("equipped"),
        draw.integer("sampled", 20, 100).alias("sampled"),
    )
    runs = runs.withColumn("actual_units", F.floor(F.col("planned_units") * draw.real("actual", 0.70, 1.0)).cast("int"))
    runs = runs.withColumn("failed", F.floor(F.col("sampled") * draw.real("failed", 0.0, 0.25)).cast("int"))

    def if_checked(value: Column) -> Column:
        return F.when(F.col("checked"), value)

    def if_equipped(value: Column) -> Column:
        return F.when(F.col("equipped"), value)

    def two_places(value: Column) -> Column:
        return F.round(value, 2).cast("decimal(5,2)")

    columns = {
        "run_id": F.col("run_id"),
        "run_date": F.date_sub(F.lit(as_of), draw.integer("days back", 0, 365)),
        "shift": draw.choice("shift", SHIFTS),
        "operator": F.concat(F.lit("Operator-"), draw.integer("operator", 1, 80).cast("string")),
        "planned_units": F.col("planned_units"),
        "actual_units": F.col("actual_units"),
        "defective_units": F.floor(F.col("actual_units") * draw.real("defective", 0.0, 0.15)).cast("int"),
        "efficiency_pct": F.when(draw.real("sensor fault", 0.0, 1.0) < 0.02, F.lit(Decimal("0.00"))).otherwise(
            two_places(draw.real("efficiency", 60.0, 98.0))
        ),
        "downtime_mins": draw.integer("downtime", 0, 180),
        "yield_pct": row_ratio(F.col("actual_units"), F.col("planned_units"), percent=True),
        "plant_name": F.col("plant.name"),
        "plant_city": F.col("plant.city"),
        "plant_country": F.col("plant.country"),
        "plant_type": F.col("plant.type"),
        "plant_capacity": draw.integer("capacity", 5000, 20000),
        "employees_count": draw.integer("employees", 50, 500),
        "product_code": F.col("product.code"),
        "product_name": F.col("product.name"),
        "product_category": F.col("product.category"),
        "unit_cost": F.col("product.cost"),
        "target_price": F.col("product.price"),
        "lead_time_days": draw.integer("lead time", 3, 30),
        "total_checks": if_checked(draw.integer("checks", 1, 5)),
        "total_sampled": if_checked(F.col("sampled")),
        "total_passed": if_checked(F.col("sampled") - F.col("failed")),
        "total_failed": if_checked(F.col("failed")),
        "defect_rate_pct": if_checked(row_ratio(F.col("failed"), F.col("sampled"), percent=True)),
        "primary_defect_type": if_checked(draw.choice("defect type", DEFECT_TYPES)),
        "primary_severity": if_checked(draw.choice("severity", SEVERITIES)),
        "equipment_name": if_equipped(F.col("machine.name")),
        "equipment_type": if_equipped(F.col("machine.name")),
        "equipment_status": if_equipped(F.col("machine.status")),
        "equipment_efficiency_pct": if_equipped(two_places(draw.real("equipment efficiency", 55.0, 95.0))),
        "days_since_maintenance": if_equipped(draw.integer("maintenance", 1, 120)),
    }
    return runs.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in EXTRACT.fields])


def synthetic_rules(generated: DataFrame) -> DataFrame:
    """How many generated rows there are and how many break a rule of the data: (rule, broken)."""
    checked = F.col("total_checks").isNotNull()
    equipped = F.col("equipment_name").isNotNull()

    def among(name: str, values: list) -> Column:
        return F.col(name).isin([v for v in values if v is not None])

    rules = {
        "shift": among("shift", SHIFTS),
        "plant": among("plant_name", [p[0] for p in PLANTS]),
        "product": among("product_code", [p[0] for p in PRODUCTS]),
        "planned_units": F.col("planned_units").between(200, 800),
        "actual_units": (F.col("actual_units") > 0) & (F.col("actual_units") <= F.col("planned_units")),
        "defective_units": F.col("defective_units").between(0, F.col("actual_units") * 0.15),
        "efficiency": (F.col("efficiency_pct") == 0) | F.col("efficiency_pct").between(60, 98),
        "checks_add_up": ~checked | (F.col("total_passed") + F.col("total_failed") == F.col("total_sampled")),
        "checks_all_or_none": (checked == F.col("total_sampled").isNotNull())
        & (checked == F.col("defect_rate_pct").isNotNull()),
        "equipment_all_or_none": (equipped == F.col("equipment_status").isNotNull())
        & (equipped == F.col("days_since_maintenance").isNotNull()),
    }
    counts = generated.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in rules.items()]
    )
    return counts.unpivot([], ["rows", *rules], "rule", "found")
