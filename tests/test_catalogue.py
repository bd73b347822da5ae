"""Every registered query against its SQL run by DuckDB, on the smallest driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_queries

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def db():
    return check_queries.connect(FOLDER)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    verdict = check_queries.compare(spark, db, FOLDER, name, contract.queries()[name], contract.oracle_sql().get(name))
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0 and "final" in result.columns


@pytest.mark.parametrize("name", ["design_weight", "weight_check", "attach_weight", "population_factor", "redistribute_blank", "attach_factor_once"])
def test_weighting_reads_every_row(spark, name, monkeypatch):
    """No query of the weights thins its table by price or balance."""
    from tallyweave.catalogue import weighting

    seen, real = [], weighting.stage
    monkeypatch.setattr(weighting, "stage", lambda df, name: seen.append(df) or real(df, name))
    plans = [contract.queries()[name](spark, FOLDER), *seen]
    text = "\n".join(df._jdf.queryExecution().optimizedPlan().toString() for df in plans)
    filters = [line for line in text.splitlines() if line.strip(" :+-").startswith("Filter")]
    assert not [f for f in filters if "o_totalprice" in f or "s_acctbal" in f]
