import datetime
import random

import pytest

from gridspark.llm import url_filter
from gridspark.llm.common import Run
from tests import oracle

CAPTURES, ENTRIES = "url string, fetched_on date, action string, _x int", "key string, action string, since date, extra string"
DAY = datetime.date(2024, 1, 1)


def day(n):
    return DAY + datetime.timedelta(n)


def test_keys(spark):
    urls = ["http://user@A.b.Example.ORG.:80/x/y/page?q=/z/#/w/", "https://h", "https://h/", "https://h/p", "https://h//a//b", "mailto:x@y", "", None, "http:///p/", "x y"]
    got = [r.k for r in spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string").repartition(1).sortWithinPartitions("i")
           .select(url_filter.keys_of(url_filter.F.col("url")).alias("k")).collect()]
    assert got[0] == ["d:org", "d:example.org", "d:b.example.org", "d:a.b.example.org",
                      "p:a.b.example.org/", "p:a.b.example.org/x/", "p:a.b.example.org/x/y/"]
    assert got[1] == got[2] == got[3] == ["d:h", "p:h/"] and got[4] == ["d:h", "p:h/", "p:h/a/"]
    assert [k or [] for k in got[5:]] == [[]] * 5


def brute(captures, entries):
    rank = {"remove": 1, "allow": 2, "block": 3}
    daily = {}
    for key, action, since, *_ in entries:
        if key is not None and since is not None and action in rank:
            daily[key, since] = max(daily.get((key, since), 0), rank[action])
    out = []
    for url, on, *_ in captures:
        best = None
        if url and on and "://" in url:
            host, _, path = url.split("://", 1)[1].partition("/")
            host = host.lower()
            labels, dirs = host.split("."), [s for s in path.split("/")[:-1] if s]
            keys = ["d:" + ".".join(labels[i:]) for i in range(len(labels))] + ["p:" + host + "/" + "".join(s + "/" for s in dirs[:i]) for i in range(len(dirs) + 1)]
            for key in keys:
                before = [(s, r) for (k, s), r in daily.items() if k == key and s <= on]
                if before and max(before)[1] > 1:
                    best = max(best or ("",), (key[0], len(key), key, {2: "allow", 3: "block"}[max(before)[1]], max(before)[0]))
        out.append((url, on, best[3], best[2], best[4]) if best else (url, on, "allow", None, None))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(8)
    hosts = ["a.x.org", "b.x.org", "x.org", "y.com", "Hot.Net"]
    captures = [(f"http://{'Hot.Net' if rng.random() < 0.4 else rng.choice(hosts)}/{rng.choice(['', 'p/', 'p/q/', 'r/'])}{rng.randrange(3)}", day(rng.randrange(400)), "x", 1)
                for _ in range(1500)]
    captures += [(None, day(1), "x", 1), ("", day(1), None, None), ("http://x.org/p/1", None, "x", 1), ("nonsense", day(5), "x", 1),
                 ("http://x.org/" + "deep/" * 300, day(300), "x", 1), captures[0], captures[0]]
    keys = ["d:org", "d:x.org", "d:a.x.org", "p:x.org/", "p:x.org/p/", "p:hot.net/p/q/", "d:hot.net", "d:com"]
    entries = [(rng.choice(keys), rng.choice(["block", "allow", "remove"]), day(rng.randrange(-50, 420)), "e") for _ in range(120)]
    entries += [(None, "block", day(1), "e"), ("d:org", None, day(1), "e"), ("d:org", "block", None, "e"), ("d:org", "odd", day(1), None), entries[0], entries[0]]
    out = url_filter.decide(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES), Run(spark, "test"))
    assert out.columns == ["url", "fetched_on", "_x", "action", "rule", "rule_since"]
    assert sorted(((r.url, r.fetched_on, r.action, r.rule, r.rule_since) for r in out.collect()), key=repr) == brute(captures, entries)


@pytest.mark.parametrize("entries", [[], [("d:x.org", "block", DAY, None)]])
def test_empty(spark, entries):
    listed = spark.createDataFrame(entries, ENTRIES)
    assert url_filter.decide(spark.createDataFrame([], CAPTURES), listed, Run(spark, "test")).count() == 0
    got = url_filter.decide(spark.createDataFrame([("http://x.org/", DAY, None, None)], CAPTURES), listed, Run(spark, "test")).collect()
    assert [r.action for r in got] == ["block" if entries else "allow"]


def test_query_equals_sql(spark):
    tables = "/root/testdata/sf0.01"
    assert oracle.compare(url_filter.op4_url_filter(spark, tables), tables, url_filter.OP4_SQL) is None


def test_days_of_any_year(spark):
    """Captures of year 1 and of today, and an entry that lasts between them."""
    days = [datetime.date(1, 1, 1), datetime.date(999, 12, 31), DAY]
    captures = spark.createDataFrame([(f"http://a.org/{i}", d, None, i) for i, d in enumerate(days)], CAPTURES)
    entries = spark.createDataFrame([("d:a.org", "block", datetime.date(500, 1, 1), None)], ENTRIES)
    got = {r._x: (r.action, str(r.rule_since)) for r in url_filter.decide(captures, entries, Run(spark, "t")).select(
        "_x", "action", url_filter.F.col("rule_since").cast("string").alias("rule_since")).collect()}
    assert got == {0: ("allow", "None"), 1: ("block", "0500-01-01"), 2: ("block", "0500-01-01")}
