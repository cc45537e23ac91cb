"""The entry points and the plans of the headline queries."""

import re

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_keys_and_flagship(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    own = {n for n in queries if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert set(sql) <= set(queries) and own - set(sql) == {"token_sort_scores", "token_sort_match"}
    assert entry.entry(spark).count() == 25


def test_scans_are_pruned(spark):
    plan = entry.queries()["source_stats"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_no_nested_loops(spark):
    for name in ("new_links", "source_stats", "nested_export", "name_as_of", "first_seen_links", "rename_history"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
