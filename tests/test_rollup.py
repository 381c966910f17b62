"""Roll-ups with distinct counts, and alias automata, against counting by hand."""

import random
import time

import pytest
from pyspark.sql import functions as F

from panelwright.operators import aggregate, domain, metrics


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(8)
    ids = [0, 1, -1, 32_767, 32_768, -32_768, 2**40, -(2**40), *range(100, 160), None]
    made = [(rng.choice(ids), rng.choice("ab"), rng.choice(["x", "y", None]), rng.random() < 0.4, rng.choice([None, 1.0, 2.5])) for _ in range(900)]
    return made, spark.createDataFrame(made, "e long, g string, h string, f boolean, v double").repartition(5)


def test_distinct_counts_at_several_levels(facts):
    made, df = facts
    levels = [({"level": F.lit("all"), "key": F.lit("all")}, None), ({"level": F.lit("g"), "key": F.col("g")}, None), ({"level": F.lit("h"), "key": F.col("h")}, None), ({"level": F.lit("g of f"), "key": F.col("g")}, F.col("f"))]
    got = aggregate.roll_up(df, ["g", "h", "f"], levels, {"n": F.count("*"), "total": F.sum("v")}, "e", {"entities": None, "with_f": F.col("f")}).collect()
    want = {}
    for e, g, h, f, v in made:
        for k in (("all", "all"), ("g", g), ("h", h), *([("g of f", g)] if f else [])):
            w = want.setdefault(k, [0, 0.0, set(), set()])
            w[0] += 1
            w[1] += v or 0
            if e is not None:
                w[2].add(e)
                if f:
                    w[3].add(e)
    assert {(r.level, r.key): (r.n, r.total, r.entities, r.with_f) for r in got} == {k: (n, pytest.approx(t), len(a), len(b)) for k, (n, t, a, b) in want.items()}


def test_rows_are_read_once_and_not_multiplied(facts):
    plan = aggregate.roll_up(facts[1], ["g", "h", "f"], [({"k": F.col("g")}, None), ({"k": F.col("h")}, None)], {"n": F.count("*")}, "e", {"entities": None})._jdf.queryExecution().optimizedPlan().toString()
    # the explode stands above the first aggregate, whose input is the table itself
    assert plan.count("Generate explode") == 1 and plan.index("Generate explode") < plan.rindex("Aggregate [g") and plan.count("RDDScan") + plan.count("LogicalRDD") <= 1


def test_groups_of_metrics_equal_one_query_for_each(facts):
    df = facts[1].withColumn("w", F.col("v") + 1)
    specs = [metrics.MetricSpec("r", "ratio_of_sums", numerator="v", denominator="w", percent=True, gate="n"), metrics.MetricSpec("m", "median", column="v"), metrics.MetricSpec("s", "share", column="f", condition="h = 'x'"), metrics.MetricSpec("c", "count", condition="f"), metrics.MetricSpec("n", "count_distinct", column="e", condition="v IS NOT NULL"), metrics.MetricSpec("a", "average", column="v", is_score=True)]
    got = {(r.group_type, r.group_value, r.f): r for r in metrics.query_metrics_by_groups(df, specs, {"g": F.col("g"), "h": F.col("h")}, ["f"], "e").collect()}
    n = 0
    for c in "gh":
        for r in metrics.query_metrics(df, specs, [c, "f"]).collect():
            n += 1
            assert list(got[c, r[c], r.f])[3:] == pytest.approx(list(r)[2:])
    assert n == len(got)
    with pytest.raises(ValueError):
        metrics.query_metrics_by_groups(df, [metrics.MetricSpec("x", "count_distinct", column="v")], {"g": F.col("g")}, [], "e")


def best(name, aliases):
    held = [(p is not None, p, -len(t), t, label) for t, label, p in aliases if t is not None and name is not None and t in name.lower()]
    return min(held)[-1] if held else None


def test_best_alias_by_priority_length_and_pattern(spark):
    rng = random.Random(4)
    aliases = [("".join(rng.choice("abé") for _ in range(rng.randint(1, 4))), f"l{i}", rng.randint(1, 3)) for i in range(40)] + [("zz", "same a", 1), ("zy", "same b", 1), (None, "no", 0), ("q", "high", 9)]
    aliases = list({a[0]: a for a in aliases}.values())
    names = [(i, "".join(rng.choice("abcéZY ") for _ in range(rng.randint(0, 12)))) for i in range(300)] + [(300, None), (301, ""), (302, "ZZzy"), (303, "q")]
    rows, table = spark.createDataFrame(names, "i int, n string").repartition(4), spark.createDataFrame(aliases, "pattern string, name string, priority int")
    want = {i: best(n, aliases) for i, n in names}
    for most in (200_000, 7):  # one automaton, and several after each other
        assert {r.i: r.name for r in domain.resolve_aliases(rows, "n", table, most).collect()} == want
    everything = table.unionByName(spark.createDataFrame([("", "any", 20)], "pattern string, name string, priority int"))
    got = {r.i: r.name for r in domain.resolve_aliases(rows, "n", everything).collect()}
    assert got == {i: None if n is None else want[i] or "any" for i, n in names}
    assert {r.name for r in domain.resolve_aliases(rows, "n", table.limit(0)).collect()} == {None}


def test_fifty_thousand_patterns(spark):
    table = spark.range(50_000).select(F.concat(F.lit("firm "), F.lpad("id", 6, "0")).alias("pattern"), F.concat(F.lit("F"), "id").alias("name"), F.lit(1).alias("priority"))
    rows = spark.range(20_000).select("id", F.concat(F.lit("The FIRM "), F.lpad(F.col("id") * 3, 6, "0"), F.lit(" Ltd")).alias("n"))
    began = time.time()
    got = domain.resolve_aliases(rows, "n", table)
    assert got.where(F.col("name") == F.concat(F.lit("F"), F.col("id") * 3)).count() == -(-50_000 // 3)
    assert got.where(F.col("name").isNull()).count() == 20_000 - (-(-50_000 // 3))
    assert time.time() - began < 60
