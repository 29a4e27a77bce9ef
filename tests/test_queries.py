import pytest
from oracle import assert_matches

import __spark_entry__ as contract
from lexloom.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, small, name):
    assert_matches(registry.QUERIES[name](spark, small), registry.ORACLES[name], small)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_has_rows(spark, small, name):
    found = registry.QUERIES[name](spark, small)
    found.write.format("noop").mode("overwrite").save()  # a count need not evaluate the columns
    assert found.count() > 0


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["doc_id", "clean_text", "n_words"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["remove_special", "filter_invalid_tokens", "remove_russian_words", "protect_boundaries", "false_hyphens"])
def test_plan_is_narrow_and_native(spark, small, name):
    plan = plan_of(registry.QUERIES[name](spark, small))
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_plan_reads_only_the_columns_it_needs(spark, small):
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan_of(registry.QUERIES["remove_special"](spark, small))


def test_healing_is_one_batch_operator_without_a_shuffle(spark, small):
    plan = plan_of(registry.QUERIES["clean_pipeline"](spark, small))
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
