import random

import duckdb
from pyspark.sql import functions as F

from opinia.llm import catalogue, urlfilter
from opinia.llm.common import Scratch

CAPTURES = "page_id long, url string, fetched_at long, host string, lists string, key string"
CHANGES = "list string, key string, changed_at long, listed boolean"


def test_entries_count_while_they_are_active(spark):
    changes = [
        ("spam", "d:example.com", 100, True), ("spam", "d:example.com", 200, False), ("spam", "d:example.com", 300, True),
        ("spam", "d:example.com", 300, False), ("bad", "u:h.org/a/b", 10, True), ("bad", "d:org", 5_000_000, True),
        (None, "d:org", 1, True), ("bad", None, 1, True), ("bad", "d:h.org", None, True),
    ]
    captures = [
        (1, "http://www.Example.com./x", 99), (2, "https://u:p@www.example.com:80/x", 100), (3, "http://example.com", 199),
        (4, "http://example.com", 200), (5, "http://notexample.com/", 150), (6, "http://example.com/", 301),
        (7, "http://h.org/a/b/c?q=/d", 10), (8, "http://h.org/a/bc", 10), (9, "http://h.org//a//b", 9_000_000),
        (10, None, 150), (11, "not a url", 150), (12, "http://example.com", None), (2, "https://u:p@www.example.com:80/x", 100),
    ]
    df = spark.createDataFrame([(*c, "x", "x", "x") for c in captures], CAPTURES)
    found = urlfilter.filter_urls(df, spark.createDataFrame(changes, CHANGES)).collect()
    assert len(found) == len(captures)
    got = {r["page_id"]: (r["n_active"], r["entry"], r["lists"]) for r in found if r["blocked"]}
    assert got == {
        2: (1, "d:example.com", "spam"), 3: (1, "d:example.com", "spam"),
        7: (1, "u:h.org/a/b", "bad"), 9: (2, "u:h.org/a/b", "bad"),
    }
    none = spark.createDataFrame([], CHANGES)
    assert not any(r["blocked"] for r in urlfilter.filter_urls(df, none).collect())
    assert urlfilter.filter_urls(df.limit(0), spark.createDataFrame(changes, CHANGES)).count() == 0
    assert urlfilter.kept(df, none).count() == len(captures)


def test_against_brute_force(spark):
    rng = random.Random(8)
    keys = ["d:a.com", "d:b.a.com", "u:a.com/x", "u:b.a.com/x/y", "d:com"]
    changes = [(rng.choice("pq"), rng.choice(keys), rng.randrange(0, 9_000_000), rng.random() < 0.6) for _ in range(60)]
    captures = [(i, rng.choice(["http://a.com/x", "http://b.a.com/x/y", "http://c.com/"]), rng.randrange(0, 10_000_000)) for i in range(150)]
    covers = {"http://a.com/x": {"d:a.com", "d:com", "u:a.com/x"}, "http://c.com/": {"d:com"}, "http://b.a.com/x/y": {"d:a.com", "d:b.a.com", "u:b.a.com/x/y", "d:com"}}
    expected = {}
    for i, url, at in captures:
        n = 0
        for name in "pq":
            for key in covers[url]:
                past = [(t, not on) for lst, k, t, on in changes if lst == name and k == key and t <= at]
                n += bool(past) and not max(past)[1]
        expected[i] = n
    df = spark.createDataFrame(captures, "page_id long, url string, fetched_at long")
    found = urlfilter.filter_urls(df, spark.createDataFrame(changes, CHANGES))
    assert {r["page_id"]: r["n_active"] for r in found.collect()} == expected
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_times_far_apart(spark):
    """Of a capture in microseconds, or at the end of time, an open interval costs no more than others."""
    times = [0, 100, 1_704_067_200, 1_704_067_200_000_000, 1 << 62, -(1 << 62)]
    captures = spark.createDataFrame([(i, "http://a.b.com/x", t) for i, t in enumerate(times)], "page_id long, url string, fetched_at long")
    changes = spark.createDataFrame([("l", "d:b.com", 50, True), ("m", "d:com", -(1 << 61), True), ("m", "d:com", 60, False)], CHANGES)
    found = {r["page_id"]: (r["n_active"], r["lists"]) for r in urlfilter.filter_urls(captures, changes).collect()}
    assert found == {0: (1, "m"), 1: (1, "l"), 2: (1, "l"), 3: (1, "l"), 4: (1, "l"), 5: (0, None)}


def test_a_key_with_many_changes(spark):
    """Its changes are spread over tasks, and each still finds the next one."""
    changes = [("l", "d:com", t, t % 20 == 0) for t in range(0, 20_000, 10)] + [("l", "d:org", 5, True)]
    captures = [(t, "http://a.com/", t) for t in range(0, 20_000, 7)]
    df = spark.createDataFrame(captures, "page_id long, url string, fetched_at long")
    found = urlfilter.filter_urls(df, spark.createDataFrame(changes, CHANGES)).collect()
    assert len(found) == len(captures) and all(r["blocked"] == (r["page_id"] // 10 % 2 == 0) for r in found)


def test_a_host_of_most_captures_and_changes(spark):
    """Its rows are spread over tasks by their times, with the key lookup broadcast or cut into slices."""
    changes = [("l0", "d:a.com", t, t // 20 % 2 == 0) for t in range(0, 20_000, 10)]
    changes += [("l0", f"d:{i}.org", 5, True) for i in range(20)]
    captures = [(t, f"http://w{t % 3}.a.com/{t % 7}", t // 2) for t in range(20_000)] + [(-i, f"http://{i}.org/", i) for i in range(1, 20)]
    df = spark.createDataFrame(captures, "page_id long, url string, fetched_at long")
    listed = spark.createDataFrame(changes, CHANGES)
    found = {r["page_id"]: r["n_active"] for r in urlfilter.filter_urls(df, listed).collect()}
    expected = {}
    for i, _, at in captures:
        if i < 0:
            expected[i] = int(at >= 5)
            continue
        # On for 20 seconds, then off for 20.
        expected[i] = int(at // 20 % 2 == 0)
    assert found == expected
    valid = urlfilter.intervals(listed, Scratch(spark, "test")).cache()
    asked = df.select(F.lit("l0").alias("list"), F.lit("d:a.com").alias("key"), F.col("fetched_at").alias("_time"), F.col("url").alias("_url"))
    scratch = Scratch(spark, "test")
    assert urlfilter.active_entries(asked, valid, scratch).count() == sum(at // 20 % 2 == 0 for _, _, at in captures)
    stored = spark.read.parquet(next(iter(scratch.paths.values())))
    sizes = [r["count"] for r in stored.groupBy("_range").count().collect()]
    assert len(sizes) > 1 and max(sizes) < sum(sizes) / 2


def test_columns_are_carried_or_replaced(spark):
    df = spark.createDataFrame([("http://a.com", 5, "h", 1, "u", "t")], "url string, fetched_at long, host string, n_active int, _u string, _t string")
    found = urlfilter.filter_urls(df, spark.createDataFrame([("l", "d:a.com", 1, True)], CHANGES))
    assert found.columns == ["url", "fetched_at", "_u", "_t", "host", "blocked", "n_active", "entry", "lists"]
    assert tuple(found.first()) == ("http://a.com", 5, "u", "t", "a.com", True, 1, "d:a.com", "l")


def test_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    own = {tuple(r) for r in catalogue.op3_url_filter(spark, folder).collect()}
    assert own == set(con.execute(catalogue.SQL["op3_url_filter"]).fetchall())
