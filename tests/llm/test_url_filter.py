"""Rules and vocabulary on chosen urls, and the query against SQL."""

import pytest

from tests.compare import connect, differences
from txnflow.llm.queries import QUERIES
from txnflow.llm.sql import SQL
from txnflow.llm.url_filter import judge_urls

CASES = [
    ("http://a.net/x", "a.net", "/x", "net/", "block"),
    ("http://net/", "net", "/", "net/", "block"),
    ("http://a.net", "a.net", "", None, "allow"),  # its path does not begin with the rule's
    ("http://www.Example.NET/en/1?q#f", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://myexample.net/en/1", "myexample.net", "/en/1", "net/", "block"),
    ("http://a.org/fr/casino", "a.org", "/fr/casino", "org/fr/", "allow"),
    ("http://a.org/FR/casino", "a.org", "/FR/casino", None, "block"),
    ("http://casinos.org/", "casinos.org", "/", None, "allow"),  # no boundary after the term
    ("http://a.org/free-free", "a.org", "/free-free", None, "allow"),  # one distinct soft term
    ("http://a.org/free?win", "a.org", "/free", None, "block"),
    ("ftp://h?x://y/z", "h", "", None, "allow"),
    ("CASINO", "", "", None, "block"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://é.org/écasino", "é.org", "/écasino", None, "block"),  # boundaries are those of ASCII
    ("http://example.com/de/\nnew", "example.com", "/de/\nnew", "example.com/de/", "block"),
]


def test_cases_repeated_rows_and_clashing_columns(spark):
    rows = [(i, c[0], "own", i) for i, c in enumerate(CASES)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, low string")
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages).collect())
    assert got == sorted([(i, *c[1:]) for i, c in enumerate(CASES)] * 2)
    assert judge_urls(pages.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query_equals_sql(spark, sf):
    assert differences(QUERIES["op4_url_filter"](spark, sf), connect(sf), SQL["op4_url_filter"]) == []
