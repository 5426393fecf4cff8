"""URL filter: splitting, rules and shrinkage."""

import pytest
from pyspark.sql import functions as F

from stratalake.llm import urls

PAGES = "page_id long, url string, html string, host string, verdict string"
LABELS = "doc_id long, quality int, toxic int"


def judged(spark, found, labels=()):
    pages = spark.createDataFrame([(i, u, "", "clash", "clash") for i, u in enumerate(found)], PAGES)
    rows = urls.judge(pages, spark.createDataFrame(list(labels), LABELS)).collect()
    assert len(rows) == len(found)
    return [tuple(r)[1:] for r in sorted(rows)]


def test_split_and_rules(spark):
    cases = {
        "http://A.Example.COM/EN/x?q#f": ("a.example.com", "/EN/x", "com/", "allow"),
        "https://example.com/en/1": ("example.com", "/en/1", "example.com/en/", "block"),
        "https://m.example.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://x.www.example.com/en/a://b/c": ("x.www.example.com", "/en/a://b/c", "www.example.com/en/", "allow"),
        "ftp://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://a.net/es/?x": ("a.net", "/es/", "net/es/", "block"),
        "http://a.net/es": ("a.net", "/es", None, "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://com/": ("com", "/", "com/", "allow"),
        "http://?x": ("", "", None, "block"),
        "://ÀB.org#a/b": ("Àb.org", "", None, "allow"),
        "no scheme": ("", "", None, "block"),
        "": ("", "", None, "block"),
        None: ("", "", None, "block"),
    }
    assert dict(zip(cases, judged(spark, list(cases)))) == cases


def test_reputation_goes_up_to_the_domain(spark):
    """A host without labels stands on its domain, one with few on both."""
    found, labels = [], []
    for d in range(12):
        for h in range(3):
            for _ in range(10):
                found.append(f"http://h{h}.d{d}.org/")
                if h:
                    labels.append((len(found) - 1, int(d % 2), 0))
    found += ["http://h0.d99.org/"]
    rows = judged(spark, found, labels)
    verdicts = {r[0]: r[3] for r in rows}
    assert all(verdicts[f"h{h}.d{d}.org"] == ("allow" if d % 2 else "block") for d in range(12) for h in range(3))
    assert verdicts["h0.d99.org"] == "allow"


def test_bounds_shrink(spark):
    split = spark.createDataFrame([(i, f"h{i % 4}.a.org") for i in range(40)], "page_id long, host string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 0) for i in range(40)], LABELS)
    rates = {r.host: r for r in urls.reputation(split, labels).collect()}
    assert 0.25 < rates["h0.a.org"].rate < 1 and 0 < rates["h1.a.org"].rate < 0.25
    assert all(r.upper > r.rate for r in rates.values())


def test_long_suffix_and_empty(spark):
    hosts = spark.createDataFrame([("a.b.co.uk",), ("b.co.uk",), ("x.org",), ("org",), ("",)], "host string")
    got = hosts.select(*urls.domain_and_suffix(F.col("host"), urls.LONG_SUFFIXES)).collect()
    assert [tuple(r) for r in got] == [("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("x.org", "org"), ("org", "org"), ("", "")]
    assert judged(spark, []) == []


def test_native_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.b/", "", "", "")], PAGES)
    plan = urls.judge(pages, spark.createDataFrame([], LABELS))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("label, good", [((1, 1), 0), ((1, None), 1), ((None, 0), 0), ((0, 0), 0)])
def test_what_counts_as_good(spark, label, good):
    split = spark.createDataFrame([(1, "a.b")], "page_id long, host string")
    row = urls.reputation(split, spark.createDataFrame([(1, *label)], LABELS)).first()
    assert (row.n, row.good) == (1, good)
