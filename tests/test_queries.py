import pytest

import __spark_entry__
from landpulse.plans import queries as plans
from oracle import same

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_as_duckdb(spark, name):
    same(plans.QUERIES[name](spark, DATA), plans.SQL[name], DATA)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_runs(spark, name):
    assert plans.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 25
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_scan_is_pruned(spark):
    plan = plans.savi_season_median(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "l_shipdate" in schema and "l_comment" not in schema and "l_orderkey" not in schema
