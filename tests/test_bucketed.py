"""Facts bucketed by run: no exchange by run in join and roll-up, hot and missing ids beside the buckets."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from frames import tables as frames_tables
from shopfloor.plans import colocated, extract, reports
from shopfloor.sources.bucketed import buckets_for, drop_bucketed, write_bucketed
from shopfloor.sources.samples import from_samples


@pytest.fixture(scope="module")
def samples(spark):
    return from_samples(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def bucketed(spark, samples):
    made = write_bucketed(samples, f"b_{uuid.uuid4().hex[:8]}", buckets=5, hot_rows=3)
    yield made
    drop_bucketed(made)


def same(a, b):
    b = b.select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def exchanges_by_run(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((?:[^)]*\b)?(?:_h_)?run_id", plan)


def test_all_rows_are_there_and_hot_runs_aside(samples, bucketed):
    assert bucketed.buckets == 5
    for name in ("production_runs", "quality_checks", "plants", "products", "equipment"):
        same(getattr(samples, name), getattr(bucketed, name))
    hot = {r["run_id"] for r in samples.quality_checks.groupBy("run_id").count().filter("count > 3").collect()}
    assert {r["run_id"] for r in bucketed.rest("quality_checks").select("run_id").distinct().collect()} == hot and hot


def test_join_and_rollup_need_no_exchange_by_run(spark, bucketed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        checks, runs = bucketed.bucketed("quality_checks"), bucketed.bucketed("production_runs")
        rollup = extract.quality_rollup(checks)
        assert exchanges_by_run(rollup) == []
        assert exchanges_by_run(runs.join(rollup, "run_id", "left")) == []
        plain = extract.quality_rollup(bucketed.quality_checks.repartition(3))
        assert exchanges_by_run(plain) != []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_results_equal_those_of_plain_tables(samples, bucketed):
    same(extract.quality_rollup(samples.quality_checks), colocated.colocated_rollup(bucketed))
    same(extract.keyed_extract(samples), colocated.colocated_extract(bucketed))
    same(reports.pass_rate_by_category(samples), colocated.colocated_pass_rate(bucketed))


def test_missing_and_repeated_ids(spark):
    small = frames_tables(spark)
    runs = small.production_runs.unionByName(small.production_runs.limit(2)).unionByName(
        small.production_runs.limit(3).withColumn("run_id", F.lit(None).cast("bigint"))
    )
    small.__dict__["production_runs"] = runs
    checks = small.quality_checks.unionByName(small.quality_checks.limit(2).withColumn("run_id", F.lit(None).cast("bigint")))
    small.__dict__["quality_checks"] = checks
    for hot_rows in (1, 1000):
        made = write_bucketed(small, f"b_{uuid.uuid4().hex[:8]}", hot_rows=hot_rows)
        assert made.buckets == 1
        same(extract.keyed_extract(small), colocated.colocated_extract(made))
        same(reports.pass_rate_by_category(small), colocated.colocated_pass_rate(made))
        drop_bucketed(made)


def test_number_of_buckets():
    assert [buckets_for(n, 100) for n in (0, 1, 100, 101, 1000)] == [1, 1, 1, 2, 10]
