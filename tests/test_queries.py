"""Every registered query against its SQL on the smallest data set."""

import pytest

from candlewick.plans.registry import ENTRIES
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
#: Queries that hold no row of the smallest data set, on either side.
EMPTY = {
    "strong_signals_30", "strong_signals_30_stream", "bb_upper_touch_day", "watchlist_query", "dashboard_rows", "first_candidates",
}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query_matches_sql(spark, duck, name):
    item = ENTRIES[name]
    assert item.sql is not None
    problem = difference(item.build(spark, FOLDER), duck, item.sql)
    assert problem == ("no rows" if name in EMPTY else None)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert {name for name in entry.queries() if name in ENTRIES} == set(ENTRIES) <= set(entry.oracle_sql())
