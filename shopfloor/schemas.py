"""Declared schemas of the five source tables and of the run-level extract."""

from pyspark.sql import types as T

PCT = T.DecimalType(5, 2)
MONEY = T.DecimalType(12, 2)
RATE = T.DecimalType(18, 2)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


TABLES = {
    "production_runs": _schema(
        run_id=T.LongType(),
        plant_id=T.LongType(),
        product_id=T.LongType(),
        run_date=T.DateType(),
        shift=T.StringType(),
        operator=T.StringType(),
        planned_units=T.LongType(),
        actual_units=T.LongType(),
        defective_units=T.LongType(),
        efficiency_pct=PCT,
        downtime_mins=T.IntegerType(),
    ),
    "quality_checks": _schema(
        check_id=T.LongType(),
        run_id=T.LongType(),
        sample_size=T.IntegerType(),
        passed=T.IntegerType(),
        failed=T.IntegerType(),
        defect_type=T.StringType(),
        severity=T.StringType(),
    ),
    "equipment": _schema(
        equipment_id=T.LongType(),
        plant_id=T.LongType(),
        equipment_name=T.StringType(),
        equipment_type=T.StringType(),
        status=T.StringType(),
        efficiency_pct=T.DecimalType(7, 2),
        last_maintenance=T.DateType(),
    ),
    "plants": _schema(
        plant_id=T.LongType(),
        plant_name=T.StringType(),
        city=T.StringType(),
        country=T.StringType(),
        plant_type=T.StringType(),
        capacity_units=T.IntegerType(),
        employees_count=T.IntegerType(),
        is_active=T.BooleanType(),
    ),
    "products": _schema(
        product_id=T.LongType(),
        product_code=T.StringType(),
        product_name=T.StringType(),
        category=T.StringType(),
        unit_cost=MONEY,
        target_price=T.DecimalType(14, 2),
        lead_time_days=T.IntegerType(),
        is_active=T.BooleanType(),
    ),
}

EXTRACT = _schema(
    run_id=T.LongType(),
    run_date=T.DateType(),
    shift=T.StringType(),
    operator=T.StringType(),
    planned_units=T.LongType(),
    actual_units=T.LongType(),
    defective_units=T.LongType(),
    efficiency_pct=PCT,
    downtime_mins=T.IntegerType(),
    yield_pct=RATE,
    plant_name=T.StringType(),
    plant_city=T.StringType(),
    plant_country=T.StringType(),
    plant_type=T.StringType(),
    plant_capacity=T.IntegerType(),
    employees_count=T.IntegerType(),
    product_code=T.StringType(),
    product_name=T.StringType(),
    product_category=T.StringType(),
    unit_cost=MONEY,
    target_price=T.DecimalType(14, 2),
    lead_time_days=T.IntegerType(),
    total_checks=T.LongType(),
    total_sampled=T.LongType(),
    total_passed=T.LongType(),
    total_failed=T.LongType(),
    defect_rate_pct=RATE,
    primary_defect_type=T.StringType(),
    primary_severity=T.StringType(),
    equipment_name=T.StringType(),
    equipment_type=T.StringType(),
    equipment_status=T.StringType(),
    equipment_efficiency_pct=T.DecimalType(7, 2),
    days_since_maintenance=T.IntegerType(),
)
