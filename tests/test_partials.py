import household_fixture as fx
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweave.plans import build_state, merge_states, roll_up, save_state, weigh_state
from tallyweave.plans.partials import merge_combinations, merge_responses

COLUMNS = ["ID", "PF_OUTPUT", "PEMBERAT_1", "WEIGHT_POP", "PEMBERAT_FINAL"]


@pytest.fixture(scope="module")
def finals(spark):
    people = fx.raw(spark).withColumnRenamed("_ord", "pos").withColumns({"YEARS": F.lit(2021), "MONTHS": F.col("pos") % 3 + 1})
    people = people.withColumns({c: F.col(c).cast("string") for c in people.columns if c not in ("pos", "YEARS", "MONTHS")})
    return {m: people.filter(f"MONTHS = {m}") for m in (1, 2, 3)}


@pytest.fixture(scope="module")
def states(spark, finals, tmp_path_factory):
    spark.sql(f"CREATE DATABASE partials LOCATION '{tmp_path_factory.mktemp('partials')}'")
    yield {m: build_state(df, f"m{m}", "partials", order="pos", record_id="ID", buckets=4) for m, df in finals.items()}
    spark.sql("DROP DATABASE partials CASCADE")


def test_merged_states_equal_the_stacked_roll_up(spark, finals, states):
    stacked = roll_up({f"m{m}": df for m, df in finals.items()}, *fx.templates(spark), kind="quarterly", order="pos", record_id="ID")
    want = rows(stacked.microdata, *COLUMNS)
    for order in ((1, 2, 3), (3, 1, 2)):
        merged = merge_states([states[m] for m in order])
        done = weigh_state(merged, *fx.templates(spark), record_id="ID")
        assert rows(done.microdata, *COLUMNS) == want
        assert rows(done.quality["ratios"]) == rows(stacked.quality["ratios"])
    saved = save_state(merge_states([states[3], states[1]]), "early", "partials", buckets=4)
    assert saved.parts == ["m1", "m3"]
    done = weigh_state(merge_states([saved, states[2]]), *fx.templates(spark), record_id="ID")
    assert rows(done.microdata, *COLUMNS) == want


def test_merge_is_associative_and_commutative(states):
    a, b, c = (states[m].responses for m in (1, 2, 3))
    left, right = merge_responses(merge_responses(a, b), c), merge_responses(a, merge_responses(c, b))
    assert rows(left.select("key", "_rows", "_first")) == rows(right.select("key", "_rows", "_first"))
    a, b, c = (states[m].combinations for m in (1, 2, 3))
    left, right = merge_combinations(merge_combinations(a, b), c), merge_combinations(a, merge_combinations(c, b))
    assert rows(left) == rows(right)


def test_merging_does_not_shuffle(spark, states):
    """Buckets meet buckets, however many periods are merged already."""
    year = states[1]
    for m in (2, 3):
        merged = merge_responses(year.responses, states[m].responses)
        assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
        year = save_state(merge_states([year, states[m]]), f"year_to_{m}", "partials", buckets=4)
    assert year.parts == ["m1", "m2", "m3"]


def test_periods_are_merged_once(states):
    with pytest.raises(ValueError, match="m1"):
        merge_states([states[1], states[1]])
    with pytest.raises(ValueError, match="one of the periods"):
        save_state(states[1], "m1", "partials")
