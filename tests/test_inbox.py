"""The upserting inbox when a batch fails between its writes, set equality, and trees with shared children."""

import pytest
from pyspark.sql import functions as F

from panelwright.operators import checks, equality
from panelwright.sources import files
from panelwright.streaming import inbox as stream

SCHEMA = "k long, v string, rev int, part string"


def parse(f):
    return f.select(F.explode(F.split(F.trim(F.col("content").cast("string")), "\n")).alias("j")).select(F.from_json("j", SCHEMA).alias("r")).select("r.*")


@pytest.mark.parametrize("step", ["replace_newer", "_take_over", "take_in"])
def test_a_batch_that_fails_and_comes_again_leaves_one_copy(spark, tmp_path, monkeypatch, step):
    folder = {n: str(tmp_path / n) for n in ("inbox", "table", "manifest", "checkpoint")}
    (tmp_path / "inbox").mkdir()
    put = lambda name, *rows: (tmp_path / "inbox" / name).write_text("\n".join('{"k":%d,"v":"%s","rev":%d,"part":"%s"}' % r for r in rows))
    run = lambda: stream.upsert_inbox(spark, folder["inbox"], parse, folder["table"], folder["manifest"], folder["checkpoint"], "k", ["rev", "v"], "part")
    put("a.json", (1, "first", 1, "x"), (2, "first", 1, "x"))
    put("copy of a.json", (1, "first", 1, "x"), (2, "first", 1, "x"))
    assert run().count() == 2
    put("b.json", (1, "second", 2, "y"), (3, "new", 1, "x"))
    place = files if step == "_take_over" else stream
    real, calls = getattr(place, step), []

    def fails(*args, **kwargs):
        calls.append(1)
        if step == "_take_over":
            if len(calls) == 2:  # the stage is whole, the table isn't yet
                raise OSError("lost")
            return real(*args, **kwargs)
        out = real(*args, **kwargs) if step == "take_in" else None
        raise OSError("lost") if out is None or step == "take_in" else None

    with monkeypatch.context() as m:
        m.setattr(place, step, fails)
        with pytest.raises(Exception, match="lost"):
            run()
    assert calls
    put("late.json", (1, "late", 1, "z"), (2, "late", 0, "x"))
    for _ in range(2):
        assert sorted(map(tuple, run().select("k", "v", "rev", "part").collect())) == [(1, "second", 2, "y"), (2, "first", 1, "x"), (3, "new", 1, "x")]
    assert spark.read.parquet(folder["manifest"]).count() == 3  # a, b, late: the copy isn't taken in


def test_files_of_lines_may_be_longer_than_a_task_can_hold(spark, tmp_path):
    """Spark refuses whole files of over 1,000 bytes here, and reads lines in short splits."""
    from panelwright.plans import catalogue

    short = {"spark.sql.sources.binaryFile.maxLength": "1000", "spark.sql.files.maxPartitionBytes": "100000"}
    before = {name: spark.conf.get(name) for name in short}
    for name, value in short.items():
        spark.conf.set(name, value)
    try:
        assert catalogue.queries()["a24_inbox_upsert"](spark, "/root/testdata/sf0.001").count() == 1500
        folder = {n: str(tmp_path / n) for n in ("inbox", "table", "manifest", "checkpoint")}
        (tmp_path / "inbox").mkdir()
        rows = ['{"k":%d,"v":"a","rev":1,"part":"x"}' % k for k in range(5000)]
        put = lambda name, lines: (tmp_path / "inbox" / name).write_text("\n".join(lines) + "\n")
        run = lambda: stream.upsert_inbox(spark, folder["inbox"], lambda f: f.select(F.from_json("line", SCHEMA).alias("r")).select("r.*"), folder["table"], folder["manifest"], folder["checkpoint"], "k", ["rev", "v"], "part", lines=True)
        put("a b.json", rows), put("copy.json", rows)
        assert run().count() == 5000 and spark.read.parquet(folder["manifest"]).count() == 1
        put("again.json", rows[::-1]), put("one more.json", [*rows, '{"k":7,"v":"b","rev":2,"part":"y"}'])
        assert run().count() == 5000 and spark.read.parquet(folder["manifest"]).count() == 2
        assert [(r.k, r.v) for r in run().where("part = 'y'").collect()] == [(7, "b")]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_differences_tell_repeated_rows_and_nulls_apart(spark):
    a = [(1, "x"), (1, "x"), (2, None), (None, "2"), *((i, "same") for i in range(500))]
    b = [(1, "x"), (2, None), (2, None), ("2", None), *((i, "same") for i in range(500))]
    left = spark.createDataFrame([(None if k is None else int(k), v) for k, v in a], "k int, v string").repartition(4)
    right = spark.createDataFrame([(None if k is None else int(k), v) for k, v in b], "k int, v string").repartition(3)
    assert sorted(map(tuple, equality.difference(left, right).collect()), key=str) == [("left", 1, "x", 1), ("left", None, "2", 1), ("right", 2, None, 2)]
    assert equality.differing_buckets(left, right, ["k", "v"]).count() == 3
    assert equality.difference(left, left.repartition(7)).isEmpty() and equality.difference(left.limit(0), left.limit(0)).isEmpty()


def test_equal_sets_shuffle_sums_alone(spark, monkeypatch):
    seen, kept = [], equality.kept
    monkeypatch.setattr(equality, "kept", lambda df: seen.append(kept(df)) or seen[-1])
    df = spark.range(20_000).select((F.col("id") % 50).alias("k"), F.lit("v").alias("v"))
    assert equality.difference(df, df.repartition(5)).isEmpty()
    assert len(seen) == 1 and seen[0].count() == 100  # a row for each bucket and side
    # and what is compared afterwards is nothing
    assert equality.in_buckets(df, ["k", "v"], equality.differing_buckets(df, df, ["k", "v"])).isEmpty()


def test_samples_are_the_same_whatever_the_partitioning(spark):
    a, b = spark.range(300).select("id", (F.col("id") % 3).alias("m")), spark.range(100, 400).select("id", (F.col("id") % 3).alias("m"))
    one = equality.sample(equality.difference(a, b), ["id", "m"]).collect()
    assert len(one) == 20 and one == equality.sample(equality.difference(a.repartition(6), b.repartition(2)), ["id", "m"]).collect()


def test_reconcile_takes_nulls_and_tolerance(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v double")
    got = checks.reconcile(rows((1, 1.0), (2, 2.0), (3, None), (4, 4.0), (5, None)), rows((1, 1.0 + 1e-12), (2, 2.5), (3, None), (5, 5.0), (6, 6.0)), ["k"], "v")
    assert sorted((r.k, r.problem) for r in got.collect()) == [(2, "differs"), (4, "left only"), (5, "differs"), (6, "right only")]


def test_tree_rows_with_shared_children(spark, tmp_path):
    edges = [("top", "b", 2), ("top", "a", 1), ("a", "x", 5), ("a", "s", 1), ("b", "s", 1), ("s", "t", 1), ("x", "t", 0), ("a", "t", 9), ("top", "no answer", 0), ("no answer", "q", 1), ("top", "empty", 3), ("empty", "hidden", 1), ("other", "a", 1)]
    df = spark.createDataFrame(edges, "parent string, child string, ord int")
    reportable = spark.createDataFrame([(x,) for x in ("a", "s", "t", "x", "q")], "node string")
    got = sorted(map(tuple, files.tree_rows(spark, df, "top", reportable, "^no").collect()))
    # by hand: from top to bottom, the first place of each under its indicator
    assert got == [("a", 1, "a", 1), ("a", 1, "s", 2), ("a", 1, "t", 3), ("a", 1, "x", 4), ("b", 2, "s", 1), ("b", 2, "t", 2)]
    with pytest.raises(ValueError, match="circle"):
        files.tree_rows(spark, df.unionByName(spark.createDataFrame([("t", "a", 1)], df.schema)), "top", reportable)
    assert files.tree_rows(spark, df, "nothing", reportable).isEmpty()
