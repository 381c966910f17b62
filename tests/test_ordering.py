"""Ranks and quantiles of large groups, with the bound on what a task holds set low."""

import glob
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_oracle import SF, rows

from panelwright.operators import ordering
from panelwright.plans import catalogue

QUERIES = ["c13_peer_medians", "d06_median_and_quantiles", "d14_grouping_sets", "e02_rank_with_nulls_apart", "e04_percent_rank", "e05_ntile", "e14_median_over", "e17_average_rank", "h09_unit_plausibility", "j08_peer_benchmark", "j09_group_percentile", "j21_group_metrics", "k02_median", "k08_query_metrics", "l15_grouping_sets_median", "s03_spearman", "s07_wilcoxon_signed_rank", "s13_cliffs_delta", "s15_mann_whitney"]


@pytest.mark.parametrize("name", QUERIES)
def test_queries_hold_when_all_groups_are_large(spark, monkeypatch, name):
    monkeypatch.setattr(ordering, "LARGE", 3)
    monkeypatch.setattr(ordering, "RANGES", 4)
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    df, want = catalogue.queries()[name](spark, SF), con.sql(catalogue.oracle_sql()[name])
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(5)
    made = []
    for g, n in (("a", 1), ("b", 2), ("c", 501), ("d", 500), (None, 40), ("same", 300), ("none", 3)):
        for i in range(n):
            v = None if g == "none" or rng.random() < 0.05 and n > 2 else 7.0 if g == "same" else rng.choice([-1e300, 1e-300, 0.0, -2.5, 1e300, float(rng.randint(-3, 3)), rng.gauss(0, 1), 10.0 ** rng.randint(-20, 20)])
            made.append((g, i, v))
    return made, spark.createDataFrame(made, "g string, i int, v double").repartition(6)


@pytest.mark.parametrize("large", [None, 5])
def test_quantiles_are_numpys(monkeypatch, values, large):
    made, df = values
    points = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r for r in ordering.quantiles(df, ["g"], "v", points, large).collect()}
    for g in {r[0] for r in made}:
        own = sorted(v for h, _, v in made if h == g and v is not None)
        assert got[g].n == len(own)
        assert (got[g].q is None) if not own else got[g].q == pytest.approx([float(np.quantile(own, p)) if abs(own[-1]) < 1e200 and abs(own[0]) < 1e200 else quantile(own, p) for p in points], rel=1e-12)


def quantile(own, p):
    at = p * (len(own) - 1)
    k = int(at)
    return own[k] * (1 - (at - k)) + own[min(k + 1, len(own) - 1)] * (at - k)


@pytest.mark.parametrize("large", [False, True])
def test_places_are_counted(values, large):
    made, df = values
    got = ordering.with_places(df, ["g"], "v", large=large).collect()
    assert len(got) == len(made)
    for r in got:
        own = [v for h, _, v in made if h == r.g and v is not None]
        want = (None, None, None) if r.v is None else (sum(x < r.v for x in own), sum(x == r.v for x in own), len(own))
        assert (r.n_below, r.n_ties, r.n_group) == want


def test_one_group_of_all_rows_is_dealt_out_evenly(spark):
    """Half of the rows share one value: ranges of one group hold like numbers of different values, and ties are one row."""
    df = spark.range(60_000).select(F.lit(1).alias("g"), F.when(F.col("id") % 2 == 0, F.lit(3.0)).otherwise(F.log1p(F.xxhash64("id").cast("double") ** 2)).alias("v"))
    kept, seen = ordering.kept, []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one range
    with pytest.MonkeyPatch.context() as m:
        m.setattr(ordering, "kept", lambda x: seen.append(kept(x)) or seen[-1])
        placed = ordering.with_places(df, ["g"], "v", large=True)
        total = placed.agg(F.max(F.col("n_below") + F.col("n_ties")), F.max("n_ties"), F.count("*")).first()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tuple(total) == (60_000, 30_000, 60_000)
    sizes = sorted(r["count"] for r in seen[0].groupBy("_part").count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 11])
def test_bands(spark, n):
    want = [r.b for r in spark.range(n).selectExpr("ntile(3) over (order by id) as b").collect()]
    assert sorted(want) == [r.b for r in spark.range(n).select(ordering.ntile(3, F.col("id"), F.lit(n).cast("long")).alias("b")).orderBy("b").collect()]
