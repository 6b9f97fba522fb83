import datetime

import pytest

from shopfloor.plans import validate
from shopfloor.sources import samples

DATE = datetime.datetime(2024, 1, 5)


@pytest.fixture
def folder(spark, tmp_path):
    """Orders of 0 to 3 lines, order 7 twice, ids missing on both sides, lines of no order."""
    orders = [(i, i * 3, "F", i * 1.25, DATE, "1-URGENT") for i in range(200)] + [(7, 1, "F", 1.0, DATE, "5-LOW"), (None, 1, "F", 1.0, DATE, "5-LOW")]
    keys = [i for i in range(200) for _ in range(i % 4)] + [None] * 5 + [900] * 3
    items = [(k, n % 11, n % 13, n, float(n % 50), 1.0, 0.1, 0.0, "R" if n % 3 else "N", "O", DATE) for n, k in enumerate(keys)]
    made = {
        "orders": (orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (items, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                            "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "supplier": ([(i, f"S{i}", i % 2, i - 4.0) for i in range(9)], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
        "nation": ([(0, "N0", 0), (1, "N1", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R0")], "r_regionkey int, r_name string"),
        "part": ([(i, "P", "B", "T", 40 + i, 2.0) for i in range(10)], "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path), orders, items


def test_runs_in_slices_are_those_of_plain_sums(spark, folder, monkeypatch):
    path, orders, items = folder
    monkeypatch.setattr(samples, "SLICE_ROWS", 20)
    runs = samples.from_samples(spark, path).production_runs
    wanted = []
    for order in orders:
        own = [x for x in items if x[0] is not None and x[0] == order[0]]
        units, returned = sum(int(x[4]) for x in own), sum(int(x[4]) for x in own if x[8] == "R")
        wanted.append((order[0], min(x[2] for x in own), min(x[1] for x in own), units, returned) if own else (order[0], None, None, None, None))
    found = [tuple(r) for r in runs.select("run_id", "plant_id", "product_id", "actual_units", "defective_units").collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_more_rows_make_more_tasks_not_larger_ones(spark, folder, monkeypatch):
    path, orders, items = folder
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for slice_rows in (20, 5):
            monkeypatch.setattr(samples, "SLICE_ROWS", slice_rows)
            runs = samples.from_samples(spark, path).production_runs
            # Orders and lines are dealt out once each.
            plan = runs._jdf.queryExecution().executedPlan().toString()
            assert plan.count("REPARTITION_BY_NUM") == 2 and "ENSURE_REQUIREMENTS" not in plan
            assert runs.rdd.getNumPartitions() == -(-(len(orders) + len(items)) // slice_rows)
        monkeypatch.setattr(samples, "SLICE_ROWS", 1000)
        assert "REPARTITION" not in samples.from_samples(spark, path).production_runs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("slice_rows", [20, 1_000_000])
def test_rejected_runs_read_orders_and_lines_once(spark, folder, monkeypatch, slice_rows):
    path, orders, items = folder
    monkeypatch.setattr(samples, "SLICE_ROWS", slice_rows)
    found = validate.rejected_runs(samples.from_samples(spark, path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.count("struct<o_orderkey") == plan.count("struct<l_orderkey") == 1
    wanted = []
    for key in [x[0] for x in orders]:
        own = [x for x in items if x[0] is not None and x[0] == key]
        plant, product = (min(x[2] for x in own), min(x[1] for x in own)) if own else (None, None)
        reason = (
            "unknown_plant" if plant is None or plant > 8
            else "unknown_product" if product > 9
            else "inactive_plant" if plant <= 4
            else "inactive_product" if product > 5
            else None
        )
        if reason:
            wanted.append((key, plant, product, reason))
    got = [tuple(r) for r in found.select("run_id", "plant_id", "product_id", "reason").collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str) and {r[3] for r in got} == {"unknown_plant", "unknown_product", "inactive_plant", "inactive_product"}
