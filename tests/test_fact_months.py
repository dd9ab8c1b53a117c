"""The months of a table of batches are read in one hash aggregate."""

import __spark_entry__ as E
from conftest import SMALL
from test_plans import plan_of


def test_months_of_the_table_need_no_sort_and_no_expand(spark):
    df = E.queries()["fact_table_months"](spark, SMALL)
    plan = plan_of(df)
    assert "SortAggregate" not in plan and "Expand" not in plan
    rows = df.collect()
    assert len({r.event_year_month for r in rows}) == len(rows) > 0 and all(r.states > 0 and r.first_state for r in rows)
