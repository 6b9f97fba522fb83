from decimal import Decimal

from frames import PLANTS, d, keyed, tables
from shopfloor.plans import analyses, explore, reports


def test_defect_rate_by_plant(spark):
    rows = reports.defect_rate_by_plant(tables(spark)).collect()
    # Plants 11 and 14 share name and city and stay apart.
    assert len([r for r in rows if r.plant_name == "South"]) == 2
    north = next(r for r in rows if r.plant_name == "North")
    assert (north.total_runs, north.total_units_produced, north.total_defects) == (5, 150, 13)
    assert north.defect_rate_pct == d("8.67")
    assert north.avg_efficiency_pct == d("82.25")  # over the four known values
    assert north.total_downtime_mins == 32
    rates = [r.defect_rate_pct for r in rows]
    assert rates == sorted(rates, reverse=True)


def test_rate_without_units_is_null_and_first(spark):
    runs = [(1, 10, 100, None, "N", "o", 5, None, None, d("1.00"), 1), (2, 11, 100, None, "N", "o", 5, 10, 1, None, 1)]
    rows = reports.defect_rate_by_plant(tables(spark, production_runs=runs)).collect()
    assert [(r.plant_name, r.defect_rate_pct) for r in rows] == [("North", None), ("South", d("10.00"))]
    assert rows[1].avg_efficiency_pct is None


def test_duplicate_plant_keys_multiply_runs(spark):
    doubled = tables(spark, plants=PLANTS + [PLANTS[0]])
    north = next(r for r in reports.defect_rate_by_plant(doubled).collect() if r.plant_name == "North")
    assert (north.total_runs, north.total_defects, north.defect_rate_pct) == (10, 26, d("8.67"))


def test_efficiency_by_shift(spark):
    rows = keyed(reports.efficiency_by_shift(tables(spark)), "shift")
    assert rows["Morning"]["avg_efficiency_pct"] == d("64.11")
    assert rows["Morning"]["avg_downtime_mins"] == d("4.0")  # 12 / 3, the unknown one left out
    assert rows[None]["total_runs"] == 1


def test_pass_rate_by_category(spark):
    rows = keyed(reports.pass_rate_by_category(tables(spark)), "product_category")
    # Run 3 (Electronics) has no known passed count; the check of an unknown run is left out.
    assert rows["Electronics"]["pass_rate_pct"] is None
    assert rows["Electronics"]["total_failed"] == 0
    metal = rows["Metal"]
    assert (metal["total_checks"], metal["total_passed"], metal["total_failed"]) == (4, 31, 5)
    assert metal["pass_rate_pct"] == d("86.11")
    assert reports.pass_rate_by_category(tables(spark)).first()["pass_rate_pct"] is None  # NULL first


def test_plant_summary(spark):
    rows = [r for r in reports.plant_efficiency_summary(tables(spark)).collect() if r.plant_name == "North"]
    assert rows[0].avg_units_per_run == Decimal("30")  # 150 units over 5 runs
    assert reports.plant_efficiency_short(tables(spark)).columns == [
        "plant_name", "total_runs", "avg_efficiency_pct", "total_units", "total_defects", "defect_rate_pct",
    ]


def test_row_counts_and_preview(spark):
    counts = {r["table"]: r["total"] for r in explore.table_row_counts(tables(spark)).collect()}
    assert counts == {"production_runs": 12, "quality_checks": 10, "equipment": 6, "plants": 5, "products": 3}
    assert explore.preview(tables(spark).production_runs).count() == 10
    assert explore.preview(tables(spark).products).count() == 3


def test_category_targets(spark):
    targets = spark.createDataFrame([("Metal", d("86.11")), ("Plastic", d("1.00"))], "product_category string, target_pct decimal(5,2)")
    rows = keyed(analyses.category_vs_target(tables(spark), targets), "product_category")
    assert set(rows) == {"Electronics", "Metal"}
    # A category without a target stays, without a verdict.
    assert rows["Electronics"]["target_pct"] is None and rows["Electronics"]["under_target"] is None
    assert rows["Metal"]["under_target"] is False  # 86.111... is not under 86.11


def test_downtime_percentiles_and_correlation(spark):
    runs = [(i, 10, 100, None, "N", "o", 100, 100 - m, 0, d("1.00"), m) for i, m in enumerate([0, 10, 20, 30, 40])]
    runs += [(9, 10, 100, None, "N", "o", 100, 100, 0, d("1.00"), None)]
    row = analyses.downtime_vs_yield(tables(spark, production_runs=runs)).first()
    assert (row.runs, row.median_downtime_mins, row.p90_downtime_mins) == (6, 20, 40)
    assert row.downtime_yield_correlation == -1.0
    constant = [(i, 10, 100, None, "N", "o", 100, 50, 0, d("1.00"), i) for i in range(3)]
    assert analyses.downtime_vs_yield(tables(spark, production_runs=constant)).first().downtime_yield_correlation is None


def test_top_runs_counts_ties_and_leaves_unknown_out(spark):
    rows = keyed(analyses.top_run_conditions(tables(spark), rank=1), "shift", "product_category", "equipment_status")
    # North: run 7 (99.00) is best but of an unknown product. South: run 5 and, in the other plant, run 11.
    assert rows[("Night", "Metal", "Operational")]["runs"] == 1
    assert rows[("Morning", "Metal", None)]["runs"] == 1
