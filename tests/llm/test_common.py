import random

import pytest
from pyspark.sql import functions as F

from panelwright.llm.common import components, grouped, text_map


def brute(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {x: find(x) for x in up}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "loops", "none"])
def test_components(spark, kind):
    rng = random.Random(4)
    edges = {
        "chain": [(i, i + 1) for i in rng.sample(range(70), 70)],
        "star": [(500, i) for i in range(300)],
        "random": [(rng.randrange(120), rng.randrange(120)) for _ in range(90)],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3), (5, 5)],
        "none": [],
    }[kind]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = brute(edges)
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == want


def test_groups_come_whole_and_one_at_a_time(spark):
    import pyarrow as pa

    df = spark.range(5000).select((F.col("id") % 37).alias("k"), "id")

    def run(key, batches):
        ids = [x for b in batches for x in b.column("id").to_pylist()]
        assert {x % 37 for x in ids} == {key[0]}
        yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([len(ids)])], names=["k", "n"])

    got = {r.k: r.n for r in grouped(df, ["k"], run, "k long, n long").collect()}
    assert got == {k: len(range(k, 5000, 37)) for k in range(37)}
    assert grouped(df.limit(0), ["k"], run, "k long, n long").count() == 0


def test_other_columns_travel_along(spark):
    import pyarrow as pa

    df = spark.createDataFrame([("x", 1, [1, 2], None), (None, 2, [], "y")], "text string, DOC int, `odd.name` array<int>, Size string")
    out = text_map(df, "size long", lambda: lambda texts: [pa.array([len(t.as_py()) for t in texts], pa.int64())])
    assert out.columns == ["text", "DOC", "odd.name", "size"]
    assert sorted((r.DOC, r["odd.name"], r.size) for r in out.collect()) == [(1, [1, 2], 1), (2, [], 0)]
    assert text_map(df.select("text"), "size long", lambda: lambda texts: [pa.array([0] * len(texts), pa.int64())]).columns == ["text", "size"]
