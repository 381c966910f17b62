"""Resampling against brute force with the same draws, and the law of the draws against all outcomes."""

import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import resampling as again
from panelwright.operators import stats


def k_of(seed, *keys):
    x = again.fifth(seed + 1)
    for k in keys:
        x = again.fifth((x + k % again.P + 1) % again.P)
    return x


def weight(seed, replicate, *keys):
    h = int(again.draw(k_of(seed, *keys), replicate))
    return sum(h >= c for c in again.REACHES)


def rho(x, y):
    rank = lambda v: [sum(b < a for b in v) + (sum(b == a for b in v) + 1) / 2 for a in v]
    a, b = np.array(rank(x)), np.array(rank(y))
    return None if a.std() == 0 or b.std() == 0 else float(np.corrcoef(a, b)[0, 1])


def chi_square(counts, outcomes, n):
    return sum((counts.get(o, 0) - n / len(outcomes)) ** 2 / (n / len(outcomes)) for o in outcomes)


def test_draws_are_even_and_of_each_other():
    d = again.draws(np.array([k_of(1, k) for k in range(2000)], np.int64), 1, 51)
    assert d.min() >= 0 and d.max() < again.P
    assert chi_square(Counter((d.ravel() * 64 // again.P).tolist()), range(64), d.size) < 64 + 5 * math.sqrt(128)
    assert abs(np.corrcoef(d[:-1].ravel(), d[1:].ravel())[0, 1]) < 0.02 and abs(np.corrcoef(d[:, :-1].ravel(), d[:, 1:].ravel())[0, 1]) < 0.02
    w = again.poisson(d)
    assert w.mean() == pytest.approx(1, abs=0.02) and w.var() == pytest.approx(1, abs=0.04)


@pytest.mark.parametrize("leaf", [4096, 2])
def test_every_dealing_of_labels_is_as_likely(spark, monkeypatch, leaf):
    """Two labels among six units, in one leaf and down a tree of several: all 15 sets come as often."""
    monkeypatch.setattr(again, "LEAF", leaf)
    n = 6000
    df = spark.createDataFrame([(k, float(k < 2), [float(j == k) for j in range(6)]) for k in range(6)], "e long, l double, w array<double>")
    got = again.permuted_sums(df, [], "e", F.array("l"), F.col("w"), n, 3).collect()
    assert len(got) == n
    outcomes = [tuple(float(j in s) for j in range(6)) for s in itertools.combinations(range(6), 2)]
    counts = Counter(tuple(r.sums) for r in got)
    assert set(counts) == set(outcomes) and chi_square(counts, outcomes, n) < 36.1  # one in a thousand at 14 degrees


def test_every_order_of_different_labels_is_as_likely(spark, monkeypatch):
    monkeypatch.setattr(again, "LEAF", 2)
    n = 4800
    df = spark.createDataFrame([(k, [float(k)], [float(j == k) for j in range(4)]) for k in range(4)], "e long, l array<double>, w array<double>")
    got = Counter(tuple(r.sums) for r in again.permuted_sums(df, [], "e", F.col("l"), F.col("w"), n, 5).collect())
    outcomes = [tuple(map(float, p)) for p in itertools.permutations(range(4))]
    assert set(got) == set(outcomes) and chi_square(got, outcomes, n) < 49.7  # one in a thousand at 23 degrees


def test_a_large_group_is_dealt_out_whole(spark, monkeypatch):
    """One group of 3,000 units in leaves of 64 at most: every replicate deals out all labels, and means and variances are those
    of a shuffle."""
    monkeypatch.setattr(again, "LEAF", 64)
    df = spark.range(3000).select(F.col("id").alias("e"), (F.col("id") % 3 == 0).cast("double").alias("l"), (F.col("id") % 7).cast("double").alias("x"))
    runs = [again.permuted_sums(df.repartition(p), [], "e", F.array("l"), F.array(F.lit(1.0), "x"), 400, 9).collect() for p in (1, 7)]
    sums = np.array([r.sums for r in sorted(runs[0], key=lambda r: r.replicate)])
    assert np.array_equal(sums, np.array([r.sums for r in sorted(runs[1], key=lambda r: r.replicate)]))
    x = np.arange(3000) % 7
    assert (sums[:, 0] == 1000).all() and sums[:, 1].mean() == pytest.approx(1000 * x.mean(), rel=0.01)
    assert sums[:, 1].var() == pytest.approx(1000 * x.var(ddof=1) * (1 - 1 / 3), rel=0.3)


def test_large_groups_of_different_values_get_the_same_draws(spark, monkeypatch):
    rows = [(g, i, float(i * 7 % 11), float(i * i % 13)) for g in range(3) for i in range(30)] + [(3, i, 1.0, float(i)) for i in range(9)] + [(4, 1, 1.0, 2.0), (5, 1, None, 2.0)]
    df = spark.createDataFrame(rows, "g int, i int, x double, y double")
    one = again.stratified_permutation(df, "x", "y", ["g"], "i", 300, 7).first()
    monkeypatch.setattr(again, "LEAF", 8)
    two = again.stratified_permutation(df.repartition(5), "x", "y", ["g"], "i", 300, 7).first()
    assert one.p == two.p and one.n_groups == 3
    # brute force: the x of rank i goes to the row with the i-th draw
    groups = {g: [r for r in rows if r[0] == g] for g in range(3)}
    pooled = lambda dealt: sum((len(own) - 1) * rho(dealt[g], [r[3] for r in own]) for g, own in groups.items()) / sum(len(own) - 1 for own in groups.values())
    seen, far = pooled({g: [r[2] for r in own] for g, own in groups.items()}), 0
    for r in range(1, 301):
        dealt = {}
        for g, own in groups.items():
            order = sorted(range(len(own)), key=lambda k: (int(again.draw(k_of(7, own[k][1]), r)), own[k][1]))
            dealt[g] = [v for _, v in sorted(zip(order, sorted(x[2] for x in own)))]
        far += abs(pooled(dealt)) >= abs(seen) - 1e-12
    assert one.pooled_rho == pytest.approx(seen) and one.p == pytest.approx((far + 1) / 301)


def test_draws_without_division_are_the_same():
    k = np.r_[0, 1, again.P - 2, again.P - 1, [k_of(3, i) for i in range(500)]].astype(np.int64)
    want = [[again.fifth((again.fifth((int(x) + again.fifth(r)) % again.P) + again.STEP) % again.P) for x in k] for r in (0, 1, 2, 9_999, 10_000)]
    got = [again.draws(k, r, r + 1)[0].tolist() for r in (0, 1, 2, 9_999, 10_000)]
    assert got == want
    ends = np.array([(x - again.fifth(1)) % again.P for x in range(-3, 3)], np.int64)  # sums next to P
    assert again.draws(ends, 1, 2)[0].tolist() == [int(again.draw(int(x), 1)) for x in ends]


def test_no_rows_are_made_for_replicates_of_a_group_that_a_task_holds(spark, monkeypatch):
    """Groups of 5,000 and 40 rows and one that is flat: the same as with rows for each replicate, which only larger groups need."""
    df = spark.range(5047).select(F.when(F.col("id") < 5000, 0).when(F.col("id") < 5040, 1).otherwise(2).alias("g"), "id", F.when(F.col("id") < 5040, F.col("id") * 7919 % 4999).otherwise(1).cast("double").alias("x"), (F.col("id") * F.col("id") % 97).cast("double").alias("y"))
    with monkeypatch.context() as m:
        m.setattr(again, "HELD", 3, raising=False)
        m.setattr(again, "LEAF", 3)
        rows = again.stratified_permutation(df, "x", "y", ["g"], "id", 45, 7).first()
    monkeypatch.setattr(again, "hash_ranks", lambda *a: pytest.fail("rows for each replicate"))
    held = [again.stratified_permutation(df.repartition(k), "x", "y", ["g"], "id", 45, 7, block=b).first() for k, b in ((1, 1000), (6, 7))]
    assert {(r.p, r.n_groups) for r in held} == {(rows.p, 2)} and [r.pooled_rho for r in held] == pytest.approx([rows.pooled_rho] * 2)


def test_effects_are_found_and_their_absence_is_not(spark):
    rows = [(g, i, float(i), float(i % 4 + i)) for g in range(4) for i in range(8)]
    df = spark.createDataFrame(rows, "g int, i int, x double, y double")
    assert again.stratified_permutation(df, "x", "y", ["g"], "i", 99, 7).first().p == pytest.approx(0.01)
    null = df.withColumn("y", F.pmod(F.xxhash64("g", "i"), F.lit(1000)).cast("double"))
    assert again.stratified_permutation(null, "x", "y", ["g"], "i", 99, 7).first().p > 0.05
    rows = [(e, t, e % 2 == 0, float(e % 2 == 0) * 5 + (e * 7 + t) % 10, (e * 31 + t * 17) % 101 / 10) for e in range(80) for t in range(3)]
    df = spark.createDataFrame(rows, "e int, t int, l boolean, x double, y double")
    assert again.label_permutation(df, "e", "x", "l", ["t"], 199).first().p == pytest.approx(1 / 200)
    assert again.label_permutation(df, "e", "y", "l", ["t"], 199).first().p > 0.05
    within = df.withColumn("w", F.col("e") % 4)  # no group has both labels, so no label can move
    assert again.label_permutation(within, "e", "x", "l", ["t"], 99, within=["w"]).first().p == 1.0
    far, near = (again.bootstrap_delta(df, "e", v, "l", ["t"], 300).first() for v in ("x", "y"))
    seen = stats.cliffs_delta(df, "x", "l", [], ["t"]).first().delta
    assert far.delta == pytest.approx(seen) and 0.2 < far.low < seen < far.high and near.low < 0 < near.high


def test_whole_history_permutation(spark):
    rows = [(c, t, (c + t) % 2 == 0, (c + t) % 2 == 0) for c in range(30) for t in range(4)] + [(c, t, c % 2 == 0, (c * 13 + t * 5) % 7 < 3) for c in range(100, 130) for t in range(4 - c % 2)]
    df = spark.createDataFrame(rows, "c int, t int, l boolean, f boolean")
    assert again.cluster_permutation(df.where("c < 100"), "c", "t", "l", "f", 99).first().p < 0.05
    assert again.cluster_permutation(df.where("c >= 100"), "c", "t", "l", "f", 99).first().p > 0.05


def test_cluster_bootstrap_is_brute_force(spark):
    rows = [(c, (c * 7 + i) % 3 == 0 or c % 5 == 0) for c in range(40) for i in range(c % 6 + 1)]
    runs = [again.cluster_bootstrap_share(spark.createDataFrame(rows, "c int, f boolean").repartition(k), "c", "f", 250, 4).first() for k in (1, 8)]
    assert list(runs[0]) == pytest.approx(list(runs[1]))
    shares = []
    for r in range(1, 251):
        w = {c: weight(4, r, c) for c in range(40)}
        shares.append(sum(w[c] * f for c, f in rows) / sum(w[c] for c, _ in rows))
    n, share = len(rows), sum(f for _, f in rows) / len(rows)
    low, high = np.percentile(shares, [2.5, 97.5])
    effect = np.var(shares) / (share * (1 - share) / n)
    p = min(1.0, 2 * min(np.mean(np.array(shares) <= 0.5), np.mean(np.array(shares) >= 0.5)))
    got = runs[0]
    assert (got.share, got.low, got.high, got.p, got.design_effect) == pytest.approx((share, low, high, p, effect)) and got.n_effective == max(1, round(n / max(effect, 1)))
    same = again.cluster_bootstrap_share(spark.createDataFrame([(c, True) for c in range(9)], "c int, f boolean"), "c", "f", 50).first()
    assert same.share == 1.0 and same.design_effect == 1.0 and same.p == 0.0


def test_bootstrap_median_is_brute_force(spark):
    rows = [(g, i, float(i * i % 17) if i % 9 else None) for g in range(3) for i in range(25 + g)] + [(3, 1, 4.0)]
    df = spark.createDataFrame(rows, "g int, i int, v double").repartition(4)
    got = {r.g: r for r in again.bootstrap_median(df, "v", ["g"], ["i"], 200, 2).collect()}
    for g in range(4):
        own = [(i, v) for h, i, v in rows if h == g and v is not None]
        medians = [np.median(x) for x in ([v for i, v in own for _ in range(weight(2, r, i))] for r in range(1, 201)) if x]
        assert (got[g].median, got[g].low, got[g].high) == pytest.approx((np.median([v for _, v in own]), *np.percentile(medians, [2.5, 97.5])))


def test_bootstrap_delta_is_brute_force(spark):
    rows = [(e, t, float(e * (t + 3) % 8), e % 3 == 0) for e in range(24) for t in range(2)]
    df = spark.createDataFrame(rows, "e int, t int, v double, l boolean").repartition(5)
    got = again.bootstrap_delta(df, "e", "v", "l", ["t"], 120, 6).first()
    deltas = []
    for r in range(1, 121):
        w = {e: weight(6, r, e) for e in range(24)}
        pairs = [(w[a] * w[b], (x > y) - (x < y)) for a, t, x, p in rows for b, u, y, q in rows if t == u and p and not q]
        deltas.append(sum(n * s for n, s in pairs) / sum(n for n, _ in pairs))
    assert (got.low, got.high) == pytest.approx(tuple(np.percentile(deltas, [2.5, 97.5])))


def test_bootstrap_of_pooled_rho_draws_flat_groups_again(spark):
    rows = [(g, i, float(i // (4 - g)), float((i * 5 + g) % 6)) for g in range(3) for i in range(6)] + [(3, i, 1.0, float(i)) for i in range(7)]
    df = spark.createDataFrame(rows, "g int, i int, x double, y double").repartition(3)
    n = 150
    got = again.bootstrap_pooled_rho(df, "x", "y", ["g"], "i", n, 8, block=40).first()
    pooled, redraws = [], 0
    for r in range(1, n + 1):
        total = 0.0
        for g in range(3):
            own = [x for x in rows if x[0] == g]
            for attempt in range(200):
                drawn = [x for x in own for _ in range(weight(8, r + attempt * n, x[1]))]
                if len(drawn) > 1 and (found := rho([x[2] for x in drawn], [x[3] for x in drawn])) is not None:
                    break
                redraws += 1
            total += 5 * found
        pooled.append(total / 15)
    assert redraws > 0 and got.redraws == redraws
    assert (got.low, got.high) == pytest.approx(tuple(np.percentile(pooled, [2.5, 97.5])))
