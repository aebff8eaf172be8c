from lakeloom.llm import urls
from lakeloom.llm.common import rows_of
from lakeloom.llm.queries import RULES

SCHEMA = "page_id bigint, url string, host string, rule string"


def judged(spark, rows, rules=RULES):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in rows], SCHEMA)
    found = urls.judge(pages, rows_of(spark, rules, ["action", "host", "path"]), "page_id", "url")
    return [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in found.collect()]


def test_rules(spark):
    rows = [
        (1, "https://a.Example.ORG/en/12?q=/es/"),
        (2, "http://example.org/es/x#y"),
        (3, "http://notexample.org/es/"),
        (4, "http://example.org"),
        (5, "http://x.com/de/1"),
        (6, "http://x.com/en/1"),
        (7, "no scheme/org/"),
        (8, None),
        (9, "http://x.com/fr/?a"),
        (10, "x://a..org/"),
        (11, "http://example.org/en/2"),
    ]
    assert sorted(judged(spark, rows)) == [
        (1, "a.example.org", "/en/12", "example.org/en/1", "block"),
        (2, "example.org", "/es/x", "example.org/es/", "block"),
        (3, "notexample.org", "/es/", "org/", "allow"),
        (4, "example.org", "", None, "allow"),
        (5, "x.com", "/de/1", "com/de/", "block"),
        (6, "x.com", "/en/1", None, "allow"),
        (7, "", "", None, "allow"),
        (8, "", "", None, "allow"),
        (9, "x.com", "/fr/", "com/fr/", "allow"),
        (10, "a..org", "/", "org/", "allow"),
        (11, "example.org", "/en/2", "org/", "allow"),
    ]


def test_repeated_rows_and_very_common_url(spark):
    rows = [(i, "http://example.org/es/1") for i in range(500)] + [(1, "http://example.org/es/1"), (None, "http://q.net/")]
    found = judged(spark, rows)
    assert len(found) == 502 and sum(v == "block" for *_, v in found) == 501


def test_large_rule_set_is_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(urls, "RULE_BYTES", 0)
    assert judged(spark, [(1, "http://example.org/es/")]) == [(1, "example.org", "/es/", "example.org/es/", "block")]


def test_ties_go_to_the_longer_host_then_to_block(spark):
    rules = [("allow", "a.org", "/"), ("block", "org", "/ab"), ("allow", "org", "/ab")]
    assert judged(spark, [(1, "http://a.org/ab")], rules)[0][3:] == ("a.org/", "allow")
    assert judged(spark, [(1, "http://b.org/ab")], rules)[0][3:] == ("org/ab", "block")


def test_empty_table_and_long_url(spark):
    assert judged(spark, []) == []
    assert judged(spark, [(1, "http://x.org/" + "a" * 100_000)])[0][4] == "allow"


def test_native(spark):
    pages = spark.createDataFrame([(1, "http://x.org/", "", "")], SCHEMA)
    plan = urls.judge(pages, rows_of(spark, RULES, ["action", "host", "path"]), "page_id", "url")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
