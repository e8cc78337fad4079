from pyspark.sql import functions as F

from millrace.llm import urls

RULES = "host string, path string, action string"


def test_hosts_rules_and_edges(spark):
    pages = [
        (1, "http://A.Example.COM/en/x?y#z"), (2, None), (3, "no scheme"), (4, "ftp://example.com"), (5, "x://y.net/es/a://b.com/en/"),
        (5, "x://y.net/es/a://b.com/en/"), (None, "http://www.example.com/en/"), (6, "http://notexample.com/en/"), (7, "://"), (8, "http://net?/es/"),
        (9, "http://" + "a." * 3000 + "net/fr/" + "b" * 5000), (10, "http://ÄÖ.com/"),
    ]
    frame = spark.createDataFrame([(*p, "html", "h", "r") for p in pages], "page_id long, url string, html string, host string, rule string")
    outcomes = spark.createDataFrame([(1, True), (None, True), (2, None), (77, True)], "page_id long, bad boolean")
    rules = spark.createDataFrame([("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
                                   ("net", "/es/", "block"), ("net", "/fr/", "block"), ("b", "x", "block")], RULES)
    got = [(r["page_id"], r["host"][:20], r["path"][:8], r["rule"], r["verdict"]) for r in urls.judge(frame, outcomes, rules).collect()]
    long = ("a." * 10, "/fr/bbbb")
    assert sorted(got, key=str) == sorted([
        (1, "a.example.com", "/en/x", "example.com/en/", "block"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "example.com", "", None, "allow"), (5, "y.net", "/es/a://", "net/es/", "block"), (5, "y.net", "/es/a://", "net/es/", "block"),
        (None, "www.example.com", "/en/", "www.example.com/en/", "allow"), (6, "notexample.com", "/en/", "com/", "allow"),
        (7, "", "", None, "allow"), (8, "net", "", None, "allow"), (9, *long, "net/fr/", "block"), (10, "ÄÖ.com", "/", "com/", "allow"),
    ], key=str)
    assert urls.judge(frame.limit(0), outcomes, rules).count() == 0
    assert urls.judge(frame, outcomes.limit(0), rules.limit(0)).filter("verdict = 'allow' AND rule IS NULL").count() == len(pages)


def test_reputation_shrinks_towards_the_domain(spark):
    # Two domains with many outcomes; hosts with few follow their domain, hosts with many their own outcomes.
    counts = [(f"h{k}.bad.org", 50, 48) for k in range(10)] + [(f"h{k}.good.org", 50, 1) for k in range(10)]
    counts += [("new.bad.org", 0, 0), ("new.good.org", 0, 0), ("one.good.org", 1, 1), ("fine.bad.org", 60, 0)]
    got = {r["host"]: r for r in urls.reputation(spark.createDataFrame(counts, "host string, n long, y long")).collect()}
    assert got["new.bad.org"]["mean"] > 0.7 and got["new.good.org"]["mean"] < 0.2
    assert got["one.good.org"]["bound"] < 0.5 < got["h1.bad.org"]["bound"]
    assert got["fine.bad.org"]["mean"] < 0.1
    assert all(r["bound"] <= r["mean"] <= 1 for r in got.values())


def test_bad_hosts_are_blocked(spark):
    pages = [(k, f"http://{'spam' if k % 2 else 'good'}.x.org/{k}") for k in range(400)]
    outcomes = [(k, bool(k % 2)) for k in range(0, 300)] + [(1, False)]
    got = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad boolean"),
                     spark.createDataFrame([], RULES))
    assert {tuple(r) for r in got.select("host", "verdict").distinct().collect()} == {("spam.x.org", "block"), ("good.x.org", "allow")}


def test_suffixes(spark):
    frame = spark.createDataFrame([("a.b.co.uk",), ("b.co.uk",), ("co.uk",), ("x",), ("",), ("a.b.c",)], "h string")
    domain, suffix = urls.domain_and_suffix(F.col("h"), ["co.uk"])
    assert [tuple(r) for r in frame.select(domain, suffix).collect()] == [
        ("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("x", "x"), ("", ""), ("b.c", "c")]
