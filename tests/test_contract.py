"""The registered queries against their SQL; ``python tests/compare.py`` runs all of them."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"
# one of each family; the rest take minutes
SOME = ["ids_all", "staging", "validate_errors", "frame_roundtrip", "check_all", "fact", "first_city", "renumber"]


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # the numbered text operators and their pipeline are optional and have tests of their own
    engine = {n for n in entry.queries() if n != "pipeline" and not (n.startswith("op") and n[2].isdigit())}
    assert engine <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", SOME)
def test_query_equals_its_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == []
