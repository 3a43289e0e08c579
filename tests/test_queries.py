"""Every registered query against its SQL on the smallest data set, all rows, exactly."""

import pytest

import __spark_entry__ as entry
import oracle
from helpers import SMALL


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_its_sql(spark, db, name):
    frame = entry.queries()[name](spark, SMALL)
    if name in entry.oracle_sql():
        assert oracle.compare(frame, db, entry.oracle_sql()[name]) is None
    else:
        assert frame.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["diagnostico", "total_pacientes"]
