import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

"""Every registered query against its SQL on the smallest tables."""

import oracle
import pytest
from conftest import DATA

from pulsegrid.operators import coverage
from pulsegrid.plans import model
from pulsegrid.plans.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle.connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    if name in ORACLE:
        oracle.same(df, con, ORACLE[name])
    else:
        assert df.count() > 0


def test_exact_twin_of_approximate(spark):
    views = model.table(spark, DATA, "page_views")
    exact = {r.url: r for r in coverage.url_breakout(views, "/P1", exact=True).collect()}
    for r in coverage.url_breakout(views, "/P1").collect():
        assert r.views == exact[r.url].views
        assert abs(r.users - exact[r.url].users) <= max(2, 0.1 * exact[r.url].users)
