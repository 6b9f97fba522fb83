import datetime

import pytest
from pyspark.sql import functions as F

import generate
from shopfloor.plans import profile, validate

AS_OF = datetime.date(2024, 2, 1)


@pytest.fixture(scope="module")
def made(spark):
    return generate.synthetic_runs(generate.numbered(spark, 20000), AS_OF).cache()


def test_schema_and_size(spark, made):
    assert validate.schema_differences(made) == []
    assert made.count() == 20000
    assert generate.synthetic_runs(generate.numbered(spark), AS_OF).count() == 300


def test_rules_hold(made):
    found = {r.rule: r.found for r in generate.synthetic_rules(made).collect()}
    assert found.pop("rows") == 20000
    assert set(found.values()) == {0}


def test_rules_can_fail(made):
    broken = made.withColumn("shift", F.lit("Dawn")).withColumn("total_passed", F.col("total_passed") + 1)
    found = {r.rule: r.found for r in generate.synthetic_rules(broken).collect()}
    assert found["shift"] == 20000 and 15000 < found["checks_add_up"] < 17000


def test_same_rows_for_any_partitioning(spark, made):
    ids = generate.numbered(spark, 20000).repartition(13)
    again = generate.synthetic_runs(ids, AS_OF)
    assert again.exceptAll(made).isEmpty() and made.exceptAll(again).isEmpty()
    other = generate.synthetic_runs(ids, AS_OF, seed=7)
    assert not other.exceptAll(made).isEmpty()


def test_shares_of_faults(made):
    n = made.count()

    def share(condition):
        return made.filter(condition).count() / n

    assert 0.19 < share("total_checks IS NULL") < 0.21
    assert 0.09 < share("equipment_name IS NULL") < 0.11
    assert 0.016 < share("efficiency_pct = 0") < 0.024
    # One type in six and one severity in four is missing among the checked runs.
    assert 0.12 < share("total_checks IS NOT NULL AND primary_defect_type IS NULL") < 0.147
    assert 0.18 < share("total_checks IS NOT NULL AND primary_severity IS NULL") < 0.22
    assert profile.quality_flags(made).first().high_defect_rate_rows > 0


def test_ranges(made):
    row = made.agg(
        F.min("planned_units"), F.max("planned_units"), F.min("downtime_mins"), F.max("downtime_mins"),
        F.min("run_date"), F.max("run_date"), F.min("total_sampled"), F.max("total_sampled"),
        F.min("days_since_maintenance"), F.max("days_since_maintenance"), F.countDistinct("operator"),
    ).first()
    year_ago = AS_OF - datetime.timedelta(days=365)
    assert tuple(row) == (200, 800, 0, 180, year_ago, AS_OF, 20, 100, 1, 120, 80)


def test_draws_are_independent(made):
    pairs = [("planned_units", "downtime_mins"), ("plant_capacity", "employees_count"), ("run_id", "planned_units")]
    for a, b in pairs:
        assert abs(made.select(F.corr(a, b)).first()[0]) < 0.03
