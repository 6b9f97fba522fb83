"""Small hand-made tables for the cases the sample files do not contain."""

import datetime
from decimal import Decimal

from shopfloor import schemas
from shopfloor.sources.tables import Tables

DAY = datetime.date(2024, 1, 15)
AS_OF = datetime.date(2024, 2, 1)


def d(text):
    return None if text is None else Decimal(text)


def day(n):
    return datetime.date(2024, 1, n)


# run_id, plant_id, product_id, run_date, shift, operator, planned, actual, defective, efficiency, downtime
RUNS = [
    (1, 10, 100, day(1), "Morning", "A", 0, 50, 5, d("90.00"), 10),  # planned 0
    (2, 10, 100, day(2), "Night", "B", 100, None, None, None, 20),  # no output, no efficiency
    (3, 10, 101, day(3), "Morning", "C", 100, 80, 8, d("90.00"), None),  # tied efficiency
    (4, 11, 100, day(3), None, "D", 300, 100, 1, d("0.00"), 7),  # no shift, efficiency 0
    (5, 11, 100, day(4), "Night", "E", 3, 2, 0, d("77.77"), 7),
    (6, 99, 100, day(5), "Night", "F", 10, 10, 0, d("99.00"), 1),  # unknown plant
    (7, 10, 999, day(5), "Night", "G", 10, 10, 0, d("99.00"), 1),  # unknown product
    (8, 12, 100, day(6), "Night", "H", 10, 10, 0, d("50.00"), 1),  # inactive plant
    (9, 13, 100, day(6), "Night", "I", 10, 10, 0, d("50.00"), 1),  # plant of unknown activity
    (10, 10, 102, day(7), "Night", "J", 10, 10, 0, d("50.00"), 1),  # inactive product
    (11, 14, 100, None, "Morning", "K", 8, 1, 1, d("12.34"), 1),  # no date, plant without equipment
    (12, None, None, day(8), "Morning", "L", 8, 1, 1, None, 1),
]
# check_id, run_id, sample_size, passed, failed, defect_type, severity
CHECKS = [
    (1, 1, 10, 9, 1, "Scratch", "Low"),
    (2, 1, 10, 8, 2, "Fault", "Low"),
    (3, 1, 10, 10, 0, None, "High"),
    (4, 3, 0, None, 0, None, None),
    (5, 3, 0, None, 0, None, None),
    (6, 5, 3, 2, 1, "Fault", None),
    (None, 5, 3, 2, 1, "Fault", "High"),
    (8, 7, 8, 7, 1, "Crack", "High"),
    (9, 555, 8, 7, 1, "Crack", "High"),  # no such run
    (10, None, 8, 7, 1, "Crack", "High"),
]
# equipment_id, plant_id, name, type, status, efficiency, last_maintenance
EQUIPMENT = [
    (1, 10, "Press", "P", "Operational", d("70.00"), day(10)),
    (2, 10, "Robot", "R", "Standby", d("71.00"), None),  # never maintained: comes first
    (3, 11, "Cutter", "C", "Operational", d("72.00"), day(20)),
    (4, 11, "Belt", "B", "Standby", d("73.00"), day(20)),  # same date: the lower id wins
    (5, 11, "Old", "O", "Standby", d("74.00"), day(1)),
    (6, 12, "Only", "X", "Standby", d("75.00"), day(2)),
]
# plant_id, name, city, country, type, capacity, employees, is_active
PLANTS = [
    (10, "North", "Detroit", "USA", "Assembly", 100, 10, True),
    (11, "South", "São Paulo", "Brazil", "Composites", 200, 20, True),
    (12, "Closed", "Osaka", "Japan", "Electronics", 300, 30, False),
    (13, "Unclear", "Munich", "Germany", "CNC", 400, 40, None),
    (14, "South", "São Paulo", "Brazil", "Composites", 500, 50, True),  # same name and city as 11
]
# product_id, code, name, category, cost, price, lead time, is_active
PRODUCTS = [
    (100, "P-100", 'Bolt, 5" long', "Metal", d("1.10"), d("2.20"), 3, True),
    (101, "P-101", "Board", "Electronics", d("3.10"), d("4.20"), 4, True),
    (102, "P-102", "Gone", "Metal", d("5.10"), d("6.20"), 5, False),
]
ROWS = {
    "production_runs": RUNS,
    "quality_checks": CHECKS,
    "equipment": EQUIPMENT,
    "plants": PLANTS,
    "products": PRODUCTS,
}


def tables(spark, **rows):
    """The tables above, with the rows of some replaced."""
    chosen = ROWS | rows
    return Tables(spark, lambda name: spark.createDataFrame(chosen[name], schemas.TABLES[name]))


def keyed(df, *keys):
    """Collected rows as dicts, by the values of ``keys``."""
    rows = [r.asDict() for r in df.collect()]
    result = {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
    assert len(result) == len(rows), "keys are not unique"
    return result
