"""Every registered query against its DuckDB counterpart."""

import pytest

import __spark_entry__ as driver
from compare import differences

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = driver.queries(), driver.oracle_sql()
ORDERED = {
    "defect_rate_by_plant", "defect_rate_top10", "efficiency_by_shift", "pass_rate_by_category", "pass_rate_by_category_short",
    "plant_efficiency_summary", "plant_efficiency_short", "run_extract", "join_preview_10", "efficiency_rank_top50", "efficiency_rank_top20",
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_oracle(spark, name):
    found = differences(QUERIES[name](spark, FOLDER), ORACLE[name], FOLDER, name in ORDERED)
    assert not found, "\n".join(found[:5])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_oracle(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_oracle_has_a_query():
    from oracle.queries import QUERIES as written

    assert set(written) <= set(QUERIES)
