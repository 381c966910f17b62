import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq

from panelwright.llm import urls


def test_rules_and_odd_urls(spark):
    rows = [(1, "https://a.Example.ORG/es/x?y"), (2, None), (3, "nonsense"), (4, "http://example.org"), (5, "http://example.org/en/12#z"), (6, "HTTP://x.com/de/fr/"), (7, "http://x.com/fr/?q"), (8, "://"), (9, "http://com/de/"), (10, "http://notorg/"), (11, "http://a.org:80/es/"), (1, "https://a.Example.ORG/es/x?y"), (12, "http://É.org/à" + "b" * 50_000), (None, "a://b://c.org/?x"), (13, "http://example.org?/es/"), (14, "http://.org/x"), (15, "http://org/es/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as rule", "2 as verdict", "3 as extra")
    got = urls.judge(pages, urls.RULES).select("page_id", "host", "path", "rule", "verdict").toPandas()
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url"]).astype({"page_id": "Int64"}))
    want = con.sql(urls.OP4_SQL.replace("FROM pages", "FROM (SELECT DISTINCT * FROM pages) AS p")).df()
    key = lambda d: sorted(map(repr, d.astype(object).where(d.notna(), None)[["host", "path", "rule", "verdict"]].drop_duplicates().values.tolist()))
    assert len(got) == len(rows)
    assert key(got) == key(want)


def test_collisions_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(urls, "_digest", lambda k: len(k) % 2)
    keys = ["a.b/x", "a.c/x", "d/"]
    order = urls.DigestArray.build(str(tmp_path / "k"), np.array([urls._digest(k) for k in keys], np.uint64), pa.array(keys))
    index = urls.DigestArray(str(tmp_path / "k"))
    found = index.find(["a.c/x", "a.b/x", "d/", "e/", "a.d/x"])
    assert [keys[order[i]] for i in found[:3]] == ["a.c/x", "a.b/x", "d/"]
    assert np.array_equal(found[3:], [-1, -1])


def test_rules_as_a_table_with_ties_repeats_and_long_urls(spark):
    """Against every rule tried on every url; equally long rules, repeated ones, urls of 50,000 characters."""
    import random

    rng = random.Random(8)
    hosts = ["a.org", "b.a.org", "org", "x.y", "y"]
    rules = [(rng.choice(hosts), "/" + "ab"[rng.randrange(2)] * rng.randrange(4), rng.choice(["allow", "block"])) for _ in range(40)] + [("g.org", "/a", "block"), ("org", "/a.gg", "allow"), ("LONG.y", "/" + "q" * 40_000, "block")]
    table = spark.createDataFrame(rules, "host string, path string, verdict string").repartition(3)
    links = [f"http://{rng.choice(['', 'b.', 'c.'])}{rng.choice(hosts)}/{'ab'[rng.randrange(2)] * rng.randrange(5)}" for _ in range(200)] + ["http://z.long.y/" + "q" * 50_000, "http://g.org/a.gg", None, "http://g.org/a.gg"]
    pages = spark.createDataFrame([(i, u, "mine", "mine") for i, u in enumerate(links)], "page_id long, url string, host string, Path string")
    got = {r.page_id: r for r in urls.judge(pages, table).collect()}
    verdict = {}
    for host, path, v in rules:
        key = (host.lower(), path)
        verdict[key] = "block" if "block" in (v, verdict.get(key)) else v
    assert len(got) == len(links)
    for i, u in enumerate(links):
        host, _, path = (u or "").partition("://")[2].partition("/")
        path = "/" + path if u else ""
        fits = [(len(h) + len(p), len(h), h + p, v) for (h, p), v in verdict.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, urls.DEFAULT))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, best[2], best[3])


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [r.verdict for r in urls.judge(pages, []).collect()] == ["allow"]
    assert urls.judge(pages.limit(0), urls.RULES).count() == 0


def test_arrays_that_cannot_be_shared_are_the_workers_own(tmp_path, monkeypatch):
    """A rename that fails though nobody else has made the arrays, and a folder that isn't whole."""
    pq.write_table(pa.table({"digest": pa.array(np.array([urls._digest("org/")], np.uint64).view(np.int64)), "key": ["org/"], "allow": [True]}), tmp_path / "k")
    pq.write_table(pa.table({"digest": pa.array(np.array([urls._digest("org")], np.uint64).view(np.int64)), "host": ["org"], "lengths": pa.array([[1]], pa.list_(pa.int32()))}), tmp_path / "h")
    monkeypatch.setattr(urls.SparkFiles, "getRootDirectory", lambda: str(tmp_path))
    monkeypatch.setattr(urls.SparkFiles, "get", lambda f: str(tmp_path / f))

    def refused(a, b):
        raise OSError("not here")

    (tmp_path / "half" / "keys").mkdir(parents=True)
    assert urls.Index.of("half", (["k"], ["h"])).best(["a.org"], ["/x"]) == [("org/", True)]
    assert urls.Index.of("whole", (["k"], ["h"])).best(["a.org"], ["/x"]) == [("org/", True)]
    with monkeypatch.context() as m:
        m.setattr(urls.os, "rename", refused)
        assert urls.Index.of("alone", (["k"], ["h"])).best(["a.org"], ["/x"]) == [("org/", True)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["h", "half", "k", "whole"]
