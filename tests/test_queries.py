"""Every registered query: against its SQL where there is one, else it must give rows."""

import pytest

from tabloom.queries import ORACLES, QUERIES
from tools.check_queries import compare


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert not [n for n in QUERIES if "pipeline" in n]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, small, name):
    result = compare(spark, duck, small, name)
    assert result.startswith(("ok", "rows")), result


def test_entry(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    assert out.columns == ["endpoint", "n"]
    assert 0 < out.count() <= 10
    assert set(entry.oracle_sql()) <= set(entry.queries())
