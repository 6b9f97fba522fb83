import pytest

from frames import AS_OF, PLANTS, d, day, keyed, tables
from shopfloor.operators.joins import JoinLimits
from shopfloor.plans import extract
from shopfloor.schemas import EXTRACT

SMALL = JoinLimits(broadcast_bytes=0, broadcast_rows=0, slice_rows=1)


def test_rollup(spark):
    rows = keyed(extract.quality_rollup(tables(spark).quality_checks), "run_id")
    assert set(rows) == {1, 3, 5, 7, 555, None}
    assert rows[1] == {
        "run_id": 1, "total_checks": 3, "total_sampled": 30, "total_passed": 27, "total_failed": 3,
        "defect_rate_pct": d("10.00"), "primary_defect_type": "Fault", "primary_severity": "Low",
    }
    # No label at all, nothing sampled, nothing known to have passed.
    assert rows[3]["primary_defect_type"] is None and rows[3]["primary_severity"] is None
    assert rows[3]["defect_rate_pct"] is None and rows[3]["total_passed"] is None and rows[3]["total_failed"] == 0
    assert rows[5]["total_checks"] == 1  # a check without an id is not counted
    assert rows[5]["defect_rate_pct"] == d("33.33")


def test_rollup_of_no_checks(spark):
    assert extract.quality_rollup(tables(spark).quality_checks.limit(0)).count() == 0


def test_latest_equipment(spark):
    rows = keyed(extract.latest_equipment(tables(spark).equipment, AS_OF), "plant_id")
    assert rows[10]["equipment_name"] == "Robot" and rows[10]["days_since_maintenance"] is None
    assert rows[11]["equipment_name"] == "Cutter" and rows[11]["days_since_maintenance"] == 12
    assert rows[12]["days_since_maintenance"] == 30
    today = extract.latest_equipment(tables(spark).equipment).filter("plant_id = 11").first()
    assert today.days_since_maintenance > 12


@pytest.mark.parametrize("limits", [JoinLimits(), SMALL])
def test_extract(spark, limits):
    df = extract.run_extract(tables(spark), AS_OF, limits=limits)
    assert df.columns == EXTRACT.fieldNames() and len(df.columns) == 34
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in EXTRACT.fields]
    # No date first (descending), then newest first; 6 to 10 and 12 are dropped.
    assert [r.run_id for r in df.collect()] == [11, 5, 3, 4, 2, 1]
    rows = keyed(df, "run_id")
    assert rows[1]["yield_pct"] is None and rows[2]["yield_pct"] is None
    assert rows[5]["yield_pct"] == d("66.67") and rows[4]["yield_pct"] == d("33.33")
    # No checks means NULL, not zero.
    assert rows[4]["total_checks"] is None and rows[4]["total_failed"] is None
    assert rows[11]["equipment_name"] is None and rows[2]["equipment_name"] == "Robot"
    assert rows[3]["product_code"] == "P-101" and rows[3]["primary_defect_type"] is None


@pytest.mark.parametrize("limits", [JoinLimits(), SMALL])
def test_duplicate_dimension_rows_fan_out(spark, limits):
    doubled = tables(spark, plants=PLANTS + [PLANTS[1]])
    ids = [r.run_id for r in extract.run_extract(doubled, AS_OF, limits=limits).collect()]
    assert sorted(ids) == [1, 2, 3, 4, 4, 5, 5, 11]


@pytest.mark.parametrize("limits", [JoinLimits(), SMALL])
def test_join_preview(spark, limits):
    rows = extract.join_preview(tables(spark), 4, limits).collect()
    # Inactive plants and products stay, unknown ones go.
    assert [r.run_id for r in rows] == [11, 10, 8, 9]
    assert [r.equipment_name for r in rows] == [None, "Robot", "Only", None]


def test_runs_without_an_id_are_spread_and_match_nothing(spark):
    runs = [(None, 10, 100, day(1), "N", f"O{i}", 10, i, 0, d("1.00"), 1) for i in range(3000)]
    data = tables(spark, production_runs=runs + [(1, 10, 100, day(2), "N", "A", 10, 10, 0, d("1.00"), 1)])
    rows = extract.run_extract(data, AS_OF, ordered=False).select("run_id", "total_checks").collect()
    assert sorted(((r.run_id is None, r.total_checks) for r in rows), key=str) == [(False, 3)] + [(True, None)] * 3000
    joined = extract._with_rollup(data.production_runs, data.quality_checks)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce(run_id" in plan


def test_one_hot_run_and_plant(spark):
    """A third of the checks on one run and of the machines in one plant, against plain loops."""
    checks = [(i, 1 if i % 3 == 0 else i, 10, 9, 1, f"T{i % 7}", f"S{i % 2}") for i in range(900)]
    machines = [(i, 10 if i % 3 == 0 else i, f"M{i}", "t", "s", d("1.00"), day(1 + i % 28)) for i in range(900)]
    data = tables(spark, quality_checks=checks, equipment=machines)
    hot = extract.quality_rollup(data.quality_checks).filter("run_id = 1").first()
    mine = [c for c in checks if c[1] == 1]
    labels = [c[5] for c in mine]
    best = min(set(labels), key=lambda v: (-labels.count(v), v))
    assert (hot.total_checks, hot.primary_defect_type) == (len(mine), best)
    latest = extract.latest_equipment(data.equipment, AS_OF).filter("plant_id = 10").first()
    first = max((m for m in machines if m[1] == 10), key=lambda m: (m[6], -m[0]))
    assert latest.equipment_name == first[2]


def test_plan_of_extract(spark):
    df = extract.run_extract(tables(spark), AS_OF, ordered=False)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan


def test_plan_of_latest_equipment(spark):
    plan = extract.latest_equipment(tables(spark).equipment, AS_OF)._jdf.queryExecution().executedPlan().toString()
    # One row per plant and task is left before the shuffle.
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_large_lookup_is_sliced(spark):
    df = extract.run_extract(tables(spark), AS_OF, ordered=False, limits=SMALL)
    assert "_slice" in df._jdf.queryExecution().optimizedPlan().toString()


def test_rollup_with_thousands_of_labels_runs_no_job_when_defined(spark):
    checks = [(i, i % 3, 10, 9, 1, f"T{i % 5000}", f"S{i}") for i in range(15000)] + [(99999, 1, 1, 1, 0, "T7", "S1")]
    data = tables(spark, quality_checks=checks)
    tracker, group = spark.sparkContext.statusTracker(), "defining"
    data.quality_checks
    spark.sparkContext.setJobGroup(group, group)
    made = extract.quality_rollup(data.quality_checks)
    assert len(tracker.getJobIdsForGroup(group)) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    rows = keyed(made, "run_id")
    assert rows[1]["total_checks"] == 5001 and rows[1]["primary_defect_type"] == "T7" and rows[1]["primary_severity"] == "S1"
