import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from frames import PLANTS, d, tables
from shopfloor.functions.ordering import pg_desc
from shopfloor.operators.joins import JoinLimits, attach, materialize_measured, measure, measured_size
from shopfloor.operators.ranking import count_cells, rank_cells
from shopfloor.plans import rankings

SLICED = JoinLimits(broadcast_bytes=0, broadcast_rows=0, slice_rows=50)


def facts(spark, n=1200):
    """A third of the rows on key 7, a sixth on NULL."""
    def key(i):
        return 7 if i % 3 == 0 else None if i % 6 == 1 else i % 40

    rows = [(i, key(i), Decimal(i % 5) if i % 4 else None) for i in range(n)]
    return spark.createDataFrame(rows, "run_id bigint, k bigint, e decimal(5,2)")


def lookup(spark):
    rows = [(k, f"name {k}") for k in [*range(0, 60, 2), 7, 7, None]]
    return spark.createDataFrame(rows, "k bigint, name string")


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limits", [JoinLimits(), SLICED])
def test_attach_equals_plain_join(spark, how, limits):
    expected = facts(spark).join(lookup(spark), "k", how).select("run_id", "k", "e", "name")
    same(attach(facts(spark), lookup(spark), ["k"], how, limits=limits), expected)


@pytest.mark.parametrize("how", ["left_anti", "left_semi"])
@pytest.mark.parametrize("null_safe", [(), ("k",)])
@pytest.mark.parametrize("limits", [JoinLimits(), SLICED])
def test_anti_and_semi_join_equal_plain_ones(spark, how, null_safe, limits):
    """A NULL key matches nothing, or the lookup's NULL where keys are compared null-safe."""
    other = lookup(spark).withColumnRenamed("k", "k2")
    same_key = F.col("k").eqNullSafe(F.col("k2")) if null_safe else F.col("k") == F.col("k2")
    got = attach(facts(spark), lookup(spark), ["k"], how, null_safe=null_safe, limits=limits)
    same(got, facts(spark).join(other, same_key, how))
    assert 0 < got.count() < facts(spark).count()


@pytest.mark.parametrize("limits", [JoinLimits(), SLICED])
def test_attach_on_two_keys_with_null(spark, limits):
    cells = facts(spark).groupBy("k", "e").agg(F.count(F.lit(1)).alias("n"))
    got = attach(facts(spark), cells, ["k", "e"], null_safe=["e"], limits=limits)
    other = cells.withColumnsRenamed({"k": "k2", "e": "e2"})
    expected = facts(spark).join(other, (F.col("k") == F.col("k2")) & F.col("e").eqNullSafe(F.col("e2")))
    same(got, expected.drop("k2", "e2"))


def test_sliced_join_spreads_the_hot_key(spark):
    hot = facts(spark).filter("k = 7")
    got = attach(hot, lookup(spark), ["k"], limits=SLICED)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan and got.count() == 2 * hot.count()


def test_measured_size(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "a bigint, b string")
    assert measured_size(df) == (2, 2 * 16 + 2 * 8 + 2)
    assert measured_size(df.limit(0)) == (0, 0)
    assert measure(df).fits(JoinLimits()) and not measure(df).fits(JoinLimits(broadcast_rows=1))
    for frame in (df, df.limit(0), df.filter("a > 5")):
        written = materialize_measured(frame, "test")
        assert (written.rows, written.bytes) == measured_size(frame)


def plain_ranks(t):
    joined = t.production_runs.join(t.plants, "plant_id")
    return joined.select(
        "run_id", "plant_name", "run_date", "shift", "efficiency_pct", "actual_units", "defective_units",
        F.rank().over(Window.orderBy(pg_desc("efficiency_pct"))).cast("bigint").alias(rankings.GLOBAL),
        F.rank().over(Window.partitionBy("plant_id").orderBy(pg_desc("efficiency_pct"))).cast("bigint").alias(rankings.WITHIN),
        "plant_id",
    )


def many_runs(n=600):
    draw = random.Random(5)

    def run(i):
        plant = 10 if i % 3 == 0 else draw.choice([10, 11, 12, 14, 77, None])
        value = draw.choice([None, d("0.00"), d("50.00"), Decimal(draw.randrange(10000)).scaleb(-2)])
        return (i, plant, 100, None, "N", "o", 5, 5, 0, value, 1)

    return [run(i) for i in range(n)]


@pytest.mark.parametrize("limits", [JoinLimits(), SLICED])
@pytest.mark.parametrize("plants", [PLANTS, [*PLANTS, PLANTS[0], (11, "Other", "x", "y", "z", 1, 1, True)]])
def test_ranks_from_counts_equal_window_ranks(spark, plants, limits):
    t = tables(spark, production_runs=many_runs(), plants=plants)
    same(rankings.efficiency_rank(t, limits), plain_ranks(t).drop("plant_id"))


@pytest.mark.parametrize("plants", [PLANTS, [*PLANTS, PLANTS[0], (11, "Other", "x", "y", "z", 1, 1, True)]])
def test_best_rows_equal_sorted_window_ranks(spark, plants):
    t = tables(spark, production_runs=many_runs(), plants=plants)
    order = [F.col("plant_name").asc_nulls_last(), F.col(rankings.WITHIN), "plant_id", "run_id"]
    expected = plain_ranks(t).orderBy(*order).limit(50).drop("plant_id")
    got = rankings.efficiency_rank_top50(t)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in expected.collect()]


def test_ranks_sort_no_runs(spark):
    t = tables(spark, production_runs=many_runs())
    plan = rankings.efficiency_rank(t)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("by", [[], ["k"]])
def test_ranks_of_any_type(spark, by):
    rows = [(i % 3, None if i % 50 == 0 else Decimal(i * i % 997) / 7) for i in range(2000)]
    df = spark.createDataFrame(rows, "k bigint, v decimal(20,10)").repartition(6)
    found = rank_cells(count_cells(df, by, "v"), "v", "place", by)
    plain = df.withColumn("place", F.rank().over(Window.partitionBy(*by).orderBy(F.col("v").desc_nulls_first())))
    columns = [*by, "v", "place"]
    key = lambda r: [str(x) for x in r]
    got = sorted((tuple(r) for r in found.select(*columns).collect()), key=key)
    assert got == sorted((tuple(r) for r in plain.select(*columns).distinct().collect()), key=key)
    assert dict(count_cells(df, by, "v").dtypes)["v"] == "decimal(20,10)"
