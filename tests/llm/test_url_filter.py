import math
import random

import pytest

from tagloom.llm.queries import URL_RULES
from tagloom.llm.scratch import Scratch
from tagloom.llm.url_filter import Rule, judged_urls, with_suffix_statistics

URLS = {
    "https://A.example.ORG/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"),
    "http://example.org/en/12?x=://y": ("example.org", "/en/12", "example.org/en/1", "block"),
    "http://example.org/en/2#a/b": ("example.org", "/en/2", "org/", "allow"),
    "x://notexample.org/es/1": ("notexample.org", "/es/1", "org/", "allow"),
    "x://b.com/fr/": ("b.com", "/fr/", "com/fr/", "allow"),
    "x://b.com/de/é": ("b.com", "/de/é", "com/de/", "block"),
    "x://com/de/": ("com", "/de/", "com/de/", "block"),
    "x://org": ("org", "", None, None),
    "x://org?q": ("org", "", None, None),
    "no scheme/org/": ("", "", None, None),
    "": ("", "", None, None),
    None: ("", "", None, None),
    "://": ("", "", None, None),
    "x://c.net/de/" + "9" * 50_000: ("c.net", "/de/" + "9" * 50_000, None, None),
}


def test_rules_and_parts(spark):
    rows = [(i, u, "extra") for i, u in enumerate([*URLS, *URLS])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = sorted(judged_urls(pages, URL_RULES).collect(), key=lambda r: r["page_id"])
    assert len(found) == 2 * len(URLS)
    for row, expected in zip(found, [*URLS.values()] * 2, strict=True):
        assert (row["host"], row["path"], row["rule"]) == expected[:3]
        assert row["verdict"] in ("allow", "block") and expected[3] in (None, row["verdict"])
        assert 0 <= row["block_score"] <= 1


def test_trees_learn_what_the_rules_label(spark):
    rows = [(i, f"http://{'x' * (i % 7 + 1)}.{tld}/p/{i}{q}") for i in range(400)
            for tld, q in (("good", ""), ("bad", "?a=1&b=2&c=3"), ("new", "?a=1&b=2&c=3" if i % 2 else ""))]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = judged_urls(pages, [Rule("allow", "good", "/"), Rule("block", "bad", "/")])
    right = [(r["verdict"] == "block") == (r["page_id"] % 2 == 1) for r in found.where("rule is null").collect()]
    assert sum(right) > 0.95 * len(right)


def test_one_label_or_none(spark):
    pages = spark.createDataFrame([(1, "x://a.net/"), (2, "x://b.org/")], "page_id long, url string")
    only = judged_urls(pages, [Rule("block", "org", "/")])
    assert {r["verdict"] for r in only.collect()} == {"block"}
    assert {r["verdict"] for r in judged_urls(pages, []).collect()} == {"allow"}
    assert judged_urls(pages.limit(0), URL_RULES).count() == 0


@pytest.mark.parametrize("threshold", ["10m", "-1"], ids=["broadcast", "shuffled"])
def test_suffix_statistics_as_counted_by_hand(spark, threshold):
    rng = random.Random(5)
    # One suffix on a third of all rows, and more suffixes than any fixed table of 2,048 would tell apart.
    suffixes = ["hot"] * 1500 + [f"s{rng.randrange(4000)}" for _ in range(3000)]
    data = [(i, s, rng.choice([None, "allow", "block"]), rng.randrange(5)) for i, s in enumerate(suffixes)]
    rows = spark.createDataFrame(data, "id long, last_1 string, ruled string, fold int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = with_suffix_statistics(rows, "last_1", Scratch(spark)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == len(data)
    groups = {}
    for row in data:
        groups.setdefault(row[1], []).append(row)
    for row in found:
        group = groups[suffixes[row["id"]]]
        assert row["f_last_1_size"] == pytest.approx(math.log1p(len(group)))
        known = [r for r in group if r[2] and (row["ruled"] is None or r[3] != row["fold"])]
        blocked = sum(r[2] == "block" for r in known)
        assert row["f_last_1_blocked"] == pytest.approx((blocked + 1) / (len(known) + 2))
