"""Parts of urls, rules and shrunk shares."""

import pytest

from refinery.llm import reputation
from refinery.llm.queries import RULES

URLS = [
    (1, "http://COM/a"), (2, "https://www.Example.com/en/x?q#f"), (3, "http://a.www.example.com/en/"), (4, "http://x.example.com/en/1"),
    (5, "http://notexample.com/en/"), (6, "ftp://a.net/es/1"), (7, "http://a.net/fr/"), (8, "http://a.net/de/"), (9, None), (10, ""),
    (11, "no scheme"), (12, "http://com?x=/"), (13, "a://b://c/d"), (None, "http://com#x"), (14, "http://a.net/de/"), (14, "http://a.net/de/"),
    (15, "x\n://h.org/p\nq"),
]
EXPECTED = {
    1: ("com", "/a", "com/"), 2: ("www.example.com", "/en/x", "www.example.com/en/"), 3: ("a.www.example.com", "/en/", "www.example.com/en/"),
    4: ("x.example.com", "/en/1", "example.com/en/"), 5: ("notexample.com", "/en/", "com/"), 6: ("a.net", "/es/1", "net/es/"),
    7: ("a.net", "/fr/", "net/fr/"), 8: ("a.net", "/de/", None), 9: ("", "", None), 10: ("", "", None), 11: ("", "", None),
    12: ("com", "", None), 13: ("b:", "//c/d", None), None: ("com", "", None), 14: ("a.net", "/de/", None), 15: ("h.org", "/p\nq", None),
}


def pages(spark, rows):
    return spark.createDataFrame([(i, url, "x", "y") for i, url in rows], "page_id bigint, url string, host string, n string")


def test_parts_and_rules(spark):
    found = reputation.judged(pages(spark, URLS), RULES)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    rows = found.collect()
    assert len(rows) == len(URLS)
    verdicts = {rule.text: rule.verdict for rule in RULES}
    for row in rows:
        assert (row.host, row.path, row.rule) == EXPECTED[row.page_id]
        assert row.verdict == verdicts.get(row.rule, row.verdict) and row.verdict in ("allow", "block")


def shares(spark, rows):
    labelled = spark.createDataFrame(rows, "host string, label string")
    return {row.host: row for row in reputation.reputations(labelled).collect()}


def test_a_host_is_drawn_to_its_domain(spark):
    rows = [("bad.d.org", "block")] * 40 + [("new.d.org", None)] + [("fine.e.com", "allow")] * 40 + [("new.e.com", None)] + [("one.e.com", "block")]
    found = shares(spark, rows)
    assert found["bad.d.org"].share > found["new.d.org"].share > found["new.e.com"].share > found["fine.e.com"].share
    assert found["one.e.com"].share > found["new.e.com"].share
    assert found["bad.d.org"].bound > 0.5 > found["one.e.com"].bound
    assert all(row.bound <= row.share and 0 <= row.share <= 1 for row in found.values())


def test_no_labels_and_no_rows(spark):
    assert shares(spark, [("a.b", None)])["a.b"].share == pytest.approx(0.5)
    assert reputation.judged(pages(spark, []), RULES).collect() == []
    assert [row.verdict for row in reputation.judged(pages(spark, [(1, "http://a.b/")]), []).collect()] == ["allow"]


def test_suffixes_of_two_labels(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("a.b.co.uk",), ("b.org",), ("localhost",), ("",)], "h string")
    found = rows.select(reputation.domain_of(F.col("h")), reputation.suffix_of(F.col("h"))).collect()
    assert [tuple(row) for row in found] == [("b.co.uk", "co.uk"), ("b.org", "org"), ("localhost", "localhost"), ("", "")]


def test_other_suffixes(spark):
    """Sites below a suffix that is passed are domains of their own, so one does not speak for the other."""
    rows = [("bad.co.za", "block")] * 40 + [("www.bad.co.za", None), ("fine.co.za", "allow"), ("www.fine.co.za", None)]
    labelled = spark.createDataFrame(rows, "host string, label string")
    known = {row.host: row.share for row in reputation.reputations(labelled, ["co.za"]).collect()}
    plain = {row.host: row.share for row in reputation.reputations(labelled).collect()}
    assert known["www.bad.co.za"] > known["www.fine.co.za"] and plain["www.bad.co.za"] == plain["www.fine.co.za"]
    assert len(reputation.reputations(labelled, []).collect()) == 4
