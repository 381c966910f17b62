"""Statistics as distributed jobs. Groups that a test needs whole travel as sums, ranks or counts wherever the test allows."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .ordering import any_large, average_rank, with_places


def with_ranks(df: DataFrame, by: Sequence[str], ranks: dict[str, str]) -> DataFrame:
    """df with the average rank of each value in its group, for groups of any size."""
    large = any_large(df, by)
    for out, value in ranks.items():
        df = with_places(df, by, value, "_below", "_ties", "_size", large).withColumn(out, average_rank("_below", "_ties")).drop("_below", "_ties", "_size")
    return df


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str]) -> DataFrame:
    """Correlation of average ranks over the rows that have both."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = with_ranks(both, by, {"_rx": x, "_ry": y})
    return ranked.groupBy(*by).agg(F.count("*").alias("n"), (F.covar_pop("_rx", "_ry") / F.nullif(F.stddev_pop("_rx") * F.stddev_pop("_ry"), F.lit(0.0))).alias("rho"))


def pooled_rho(df: DataFrame, x: str, y: str, by: Sequence[str], keep: Sequence[str] = (), least: int = 5) -> DataFrame:
    """Mean of the groups' rank correlations, weighted by n - 1, over groups of `least` rows with variation."""
    groups = spearman(df, x, y, [*keep, *by]).where((F.col("n") >= least) & F.col("rho").isNotNull())
    mean = F.sum(F.col("rho") * (F.col("n") - 1)) / F.nullif(F.sum(F.col("n") - 1), F.lit(0))
    return groups.groupBy(*keep).agg(F.count("*").alias("n_groups"), mean.alias("pooled_rho"))


def _p_of_ranks(n: int, plus: float, ties: float, ranks: Sequence[float]) -> float | None:
    """Two-sided p of the signed-rank test from a group's numbers: exact by counting sign patterns up to 25 values (whose
    ranks are given), else normal with ties."""
    if not n:
        return None
    if n <= 25:
        twice = [round(2 * r) for r in ranks]
        total, low = sum(twice), round(2 * plus)
        ways = [1] + [0] * total
        for r in twice:
            for s in range(total, r - 1, -1):
                ways[s] += ways[s - r]
        return min(1.0, 2 * sum(ways[: min(low, total - low) + 1]) / 2**n)
    spread = math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - ties / 48)
    return math.erfc(max(0.0, abs(plus - n * (n + 1) / 4) - 0.5) / spread / math.sqrt(2)) if spread else 1.0


def wilcoxon_signed_rank(df: DataFrame, x: str, by: Sequence[str]) -> DataFrame:
    """n, the sum of positive ranks, the tie term, p and z (normal, with ties and continuity) of each group. Ranks, their sum and the tie term are columns; a group comes to Python as one row, with its
    ranks only where 25 at most are counted exactly."""
    some = df.where(F.col(x).isNotNull()).select(*by, F.col(x).alias("_x"), F.abs(x).alias("_a"), (F.col(x) == 0).alias("_zero"))
    group = [*by, "_zero"]
    placed = with_places(some, group, "_a", "_below", "_ties", "_n")
    ranked = placed.withColumns({"_r": average_rank("_below", "_ties"), "_t": F.col("_ties") * F.col("_ties") - 1})
    use = ~F.col("_zero")
    sums = ranked.groupBy(*by).agg(
        F.count_if(use).alias("n"), F.coalesce(F.sum(F.when(use & (F.col("_x") > 0), F.col("_r"))), F.lit(0.0)).alias("plus"),
        F.coalesce(F.sum(F.when(use, F.col("_t").cast("double"))), F.lit(0.0)).alias("ties"), F.collect_list(F.when(use & (F.col("_n") <= 25), F.col("_r"))).alias("ranks"),
    )

    def run(frames):
        for f in frames:
            f["p"] = [_p_of_ranks(*row) for row in zip(f["n"], f["plus"], f["ties"], f["ranks"])]
            yield f[[*by, "n", "plus", "ties", "p"]]

    told = sums.mapInPandas(run, "".join(f"{f.name} {f.dataType.simpleString()}, " for f in sums.select(*by).schema) + "n long, plus double, ties double, p double")
    m = F.col("n").cast("double")  # its third power may be beyond whole numbers
    off, spread = F.abs(F.col("plus") - m * (m + 1) / 4) - 0.5, F.sqrt(m * (m + 1) * (2 * m + 1) / 24 - F.col("ties") / 48)
    return told.withColumn("z", F.greatest(off, F.lit(0.0)) / F.nullif(spread, F.lit(0.0)))


@F.pandas_udf(DoubleType())
def natural_log(x: pd.Series) -> pd.Series:
    """The C library's logarithm, which SQL engines use. Java's differs from it in the last digit here and there, and so in whether
    the changes of two entities, one the other's inverse, are a tie."""
    return x.where(x > 0).map(math.log, na_action="ignore").astype("float64")


def pair_changes(df: DataFrame, entity: Sequence[str], period: str, value: str, first, last) -> DataFrame:
    """Log change between two periods of the entities that have a positive value in both."""
    at = lambda y: F.max(F.when(F.col(period) == y, F.col(value)))
    ends = df.where(F.col(period).isin(first, last)).groupBy(*entity).agg(at(first).alias("_a"), at(last).alias("_b"))
    return ends.where("_a > 0 AND _b > 0").withColumn("log_change", natural_log(F.col("_b") / F.col("_a"))).drop("_a", "_b")


def binomial_exact(k: int, n: int, p0: float = 0.5) -> float:
    """Two-sided exact p: all outcomes that are no likelier than the one seen."""
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p0) + (n - i) * math.log(1 - p0)
    seen = log(k)
    return min(1.0, sum(math.exp(log(i)) for i in range(n + 1) if log(i) <= seen + 1e-7))


def binomial_test(df: DataFrame, k: str, n: str, p0: float = 0.5, out: str = "p") -> DataFrame:
    """binomial_exact() of every row."""
    names = df.columns

    def run(frames):
        for f in frames:
            f[out] = [binomial_exact(int(a), int(b), p0) for a, b in zip(f[k], f[n])]
            yield f[[*names, out]]

    return df.mapInPandas(run, df.schema.simpleString()[7:-1] + f", {out} double")


def wilson_interval(k: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    share = k / F.nullif(n, F.lit(0))
    middle, half = share + z * z / (2 * n), z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return (middle - half) / (1 + z * z / n), (middle + half) / (1 + z * z / n)


def two_by_two(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return both.groupBy(*by).agg(*(F.count_if((F.col(a) if i else ~F.col(a)) & (F.col(b) if j else ~F.col(b))).alias(f"n{i}{j}") for i in (1, 0) for j in (1, 0)))


def odds_ratio(n11: str = "n11", n10: str = "n10", n01: str = "n01", n00: str = "n00") -> Column:
    """Half a case is added to each cell if one is empty."""
    extra = F.when(F.least(n11, n10, n01, n00) == 0, 0.5).otherwise(0.0)
    return (F.col(n11) + extra) * (F.col(n00) + extra) / ((F.col(n10) + extra) * (F.col(n01) + extra))


def fisher_exact(n11: int, n10: int, n01: int, n00: int) -> float:
    r, c, n = n11 + n10, n11 + n01, n11 + n10 + n01 + n00
    choose = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    log = lambda k: choose(r, k) + choose(n - r, c - k) - choose(n, c)
    seen = log(n11)
    return min(1.0, sum(math.exp(log(k)) for k in range(max(0, r + c - n), min(r, c) + 1) if log(k) <= seen + 1e-7))


def fisher_test(tables: DataFrame, by: Sequence[str]) -> DataFrame:
    """p of each row's table; one small table a row."""

    def run(frames):
        for f in frames:
            f["p"] = [fisher_exact(*map(int, t)) for t in zip(f["n11"], f["n10"], f["n01"], f["n00"])]
            yield f

    return tables.select(*by, "n11", "n10", "n01", "n00").mapInPandas(run, tables.select(*by, "n11", "n10", "n01", "n00").schema.simpleString()[7:-1] + ", p double")


def cliffs_delta(df: DataFrame, value: str, label: str, strata: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Wins less losses over pairs of each stratum, from rank sums; pairs are counted inside each group of `within`."""
    u = mann_whitney_u(df, value, label, [*strata, *within])
    pairs = F.col("n1") * F.col("n0")
    return u.groupBy(*strata).agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"), (F.sum(2 * F.col("u") - pairs) / F.sum(pairs)).alias("delta"))


def mann_whitney_u(df: DataFrame, value: str, label: str, by: Sequence[str]) -> DataFrame:
    ranked = with_ranks(df.where(F.col(value).isNotNull() & F.col(label).isNotNull()), by, {"_r": value})
    sums = ranked.groupBy(*by).agg(F.count_if(label).alias("n1"), F.count_if(~F.col(label)).alias("n0"), F.sum(F.when(F.col(label), F.col("_r"))).alias("_s"))
    return sums.where("n1 > 0 AND n0 > 0").withColumn("u", F.col("_s") - F.col("n1") * (F.col("n1") + 1) / 2).drop("_s")


def mann_whitney(df: DataFrame, value: str, label: str, by: Sequence[str]) -> DataFrame:
    """U, z with tie correction and continuity, and Cliff's delta."""
    there = df.where(F.col(value).isNotNull() & F.col(label).isNotNull())
    ties = there.groupBy(*by, value).agg(F.count("*").alias("_t")).groupBy(*by).agg(F.sum(F.col("_t") * F.col("_t") * F.col("_t") - F.col("_t")).alias("_ties"))
    u = mann_whitney_u(df, value, label, by).join(ties, list(by))
    n1, n0 = F.col("n1"), F.col("n0")
    n = n1 + n0
    spread = F.sqrt(n1 * n0 / 12.0 * ((n + 1) - F.col("_ties") / (n * F.nullif(n - 1, F.lit(0)))))
    off = F.col("u") - n1 * n0 / 2.0
    z = F.signum(off) * F.greatest(F.abs(off) - 0.5, F.lit(0.0)) / F.nullif(spread, F.lit(0.0))
    return u.select(*by, "n1", "n0", "u", z.alias("z"), (2 * F.col("u") / (n1 * n0) - 1).alias("delta"))


def benjamini_hochberg(df: DataFrame, p: str, out: str = "adjusted_p") -> DataFrame:
    """Adjusted p of a family of tests of any size. Ranks and running minima are taken inside ranges of p, each in a task of
    its own, and then over the ranges, which are few: sixteen for each halving of p."""
    counts = df.where(F.col(p).isNotNull()).groupBy(F.col(p).alias("_p")).agg(F.count("*").alias("_n")).withColumn("_part", F.when(F.col("_p") > 0, F.floor(F.log2("_p") * 16)).otherwise(-100_000))
    ranges = counts.groupBy("_part").agg(F.sum("_n").alias("_m"))
    up = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_part", F.coalesce(F.sum("_m").over(up), F.lit(0)).alias("_before"), F.sum("_m").over(Window.partitionBy()).alias("_all"))
    within = Window.partitionBy("_part").orderBy("_p")
    ranked = counts.withColumn("_upto", F.sum("_n").over(within)).join(F.broadcast(ranges), "_part")
    raw = ranked.withColumn("_a", F.col("_p") * F.col("_all") / (F.col("_before") + F.col("_upto") - F.col("_n") + 1))
    least = F.min("_a").over(Window.partitionBy("_part").orderBy(F.col("_p").desc()))
    after = raw.groupBy("_part").agg(F.min("_a").alias("_low")).select("_part", F.min("_low").over(Window.orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, -1)).alias("_later"))
    adjusted = raw.withColumn("_least", least).join(F.broadcast(after), "_part").select("_p", F.least(F.lit(1.0), "_least", F.coalesce("_later", F.lit(1.0))).alias(out))
    return df.join(adjusted, F.col(p) == F.col("_p"), "left").select(*df.columns, out)


def outcomes(df: DataFrame, p: str, n: str, alpha: float = 0.05, least: int = 10) -> DataFrame:
    """The decision of each test; tests on too few rows decide nothing."""
    decision = F.when(F.col(n) < least, "not enough data").when(F.col(p) <= alpha, "rejects").otherwise("does not reject")
    return df.withColumns({"decision": decision, "likely_underpowered": (F.col(n) < 3 * least) & (F.col(p) > alpha)})
