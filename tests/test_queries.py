"""Every query with SQL gives the SQL's rows; the others give rows."""

import pytest
from oracle import compare, connect

from disclosa.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) == ""
    else:
        assert df.count() >= 0


def test_scan_reads_what_is_asked_for(spark, sf_dir):
    plan = QUERIES["pit_filter"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ts), LessThanOrEqual(ts" in plan and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


@pytest.mark.parametrize("name", ["hierarchy_path", "section_keyword_select"])
def test_titles_are_dealt_and_numbered_once(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution()
    assert plan.executedPlan().toString().count("Exchange hashpartitioning") == 1
    # The three patterns of title_level, outside the fold, where each mention is matched for every title.
    shown = plan.optimizedPlan().toString()
    assert shown.count("RLIKE") == 3 and shown.count("Window [") == 1


def test_hierarchy_rows_hold_paths_only(spark, sf_dir):
    shown = QUERIES["hierarchy_path"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    made = next(x for x in shown.splitlines() if "Generate " in x)
    assert "Generate inline(" in made and [c.strip().partition("#")[0] for c in made.rpartition("[")[2].rstrip("]").split(",")] == ["at", "path"]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
