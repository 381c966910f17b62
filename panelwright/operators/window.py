"""Window operators on panels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import with_places


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1, rank: str = "_nth") -> DataFrame:
    """The first k rows of each key."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def group_percentile(df: DataFrame, group: Sequence[str], value: str, higher_is_better: bool = True, least: int = 5, large: bool | None = None) -> DataFrame:
    """0 to 100, 100 the best, among the rows of a group that have a value; null with a reason in small groups."""
    placed = with_places(df, group, value, "_below", "_ties", "_size", large)
    keys = [F.col(c) for c in group]
    n = F.coalesce("_size", F.lit(0).cast("long"))
    if group:  # rows without a value have their group's number too
        sizes = df.groupBy(*group).agg(F.count(value).alias("group_n")).select(*(F.col(c).alias(f"_g{i}") for i, c in enumerate(group)), "group_n")
        placed = placed.join(sizes, reduce(lambda a, b: a & b, (k.eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys))))
        n = F.col("group_n")
    has = F.col(value).isNotNull()
    worse = F.col("_below") if higher_is_better else F.col("_size") - F.col("_below") - F.col("_ties")
    share = F.coalesce(100.0 * worse / F.nullif(F.col("_size") - 1, F.lit(0)), F.lit(0.0))
    return placed.select(*df.columns, n.alias("group_n"), F.when(has & (n >= least), share).alias("percentile"), F.when(~has, "no value").when(n < least, f"group under {least}").alias("percentile_null_reason"))


def value_range(value: str) -> Column:
    """A whole number that never falls as the value grows: eight ranges for each doubling, so a few hundred at most."""
    steps = F.floor(F.log2(F.abs(F.col(value)).cast("double") + 1) * 8)
    return F.when(F.col(value) < 0, -steps - 1).otherwise(steps)


def concentration(df: DataFrame, entity: str, value: str, period: str, least: int = 5) -> DataFrame:
    """Rank, share and running share of each entity in its period, largest first; shares of small periods are hidden.

    A period isn't sorted as a whole: rows and sums are counted by ranges of values, and each range is sorted in a task of
    its own.
    """
    there = df.where(F.col(value).isNotNull()).withColumn("_part", value_range(value))
    ranges = there.groupBy(period, "_part").agg(F.count("*").alias("_rows"), F.sum(value).alias("_sum"))
    w = Window.partitionBy(period)
    before = w.orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    ranges = ranges.select(period, "_part", F.sum("_rows").over(w).alias("n_entities"), F.sum("_sum").over(w).alias("_total"), F.coalesce(F.sum("_rows").over(before), zero).alias("_rows_before"), F.coalesce(F.sum("_sum").over(before), zero).alias("_sum_before"))
    within = Window.partitionBy(period, "_part").orderBy(F.col(value).desc(), F.col(entity))
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = there.withColumns({"_nth": F.row_number().over(within), "_running": F.sum(value).over(running)}).join(ranges, [period, "_part"])
    n, total = F.col("n_entities"), F.nullif("_total", zero)
    return placed.select(*df.columns, n, (F.col("_nth") + F.col("_rows_before")).cast("int").alias("position"), F.when(n >= least, F.col(value) / total).alias("share"), F.when(n >= least, (F.col("_running") + F.col("_sum_before")) / total).alias("cumulative_share"), F.when(n < least, f"fewer than {least}").alias("null_reason"))


def change_vs_first(value: str, keys: Sequence[str], period: str) -> Column:
    """Relative change from the first period of the key; null if that one has no value."""
    first = F.first(value).over(Window.partitionBy(*keys).orderBy(period))
    return F.col(value) / F.nullif(first, F.lit(0)) - 1


def change_vs_previous(value: str, keys: Sequence[str], period: str) -> Column:
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(period))
    return F.col(value) / F.nullif(before, F.lit(0)) - 1


def scd2_from_runs(df: DataFrame, key: Sequence[str], order: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Type-2 history: each run of equal attributes is one version, from its first order value to the next one's."""
    w = Window.partitionBy(*key).orderBy(*order)
    changed = F.lit(False)
    for a in attributes:
        changed = changed | ~F.lag(a).over(w).eqNullSafe(F.col(a))
    start = F.when((F.row_number().over(w) == 1) | changed, 1).otherwise(0)
    marked = df.withColumn("_start", start).withColumn("version", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = marked.groupBy(*key, "version", *attributes).agg(F.min(order[0]).alias("valid_from"), F.count("*").alias("n_rows"))
    after = Window.partitionBy(*key).orderBy("version")
    return runs.withColumn("valid_to", F.lead("valid_from").over(after)).withColumn("is_current", F.col("version") == F.max("version").over(Window.partitionBy(*key)))


def balanced_panel(df: DataFrame, entity: str, period: str, condition: Column | None = None) -> DataFrame:
    """Rows of the entities that have a (fitting) row in every period that occurs."""
    fits = df.where(condition) if condition is not None else df
    periods = fits.select(F.countDistinct(period).alias("_periods"))
    whole = fits.groupBy(entity).agg(F.countDistinct(period).alias("_n")).join(F.broadcast(periods), F.col("_n") == F.col("_periods"))
    return df.join(whole.select(entity), entity, "left_semi")


def one_period_spikes(df: DataFrame, entity: str, period: str, value: str, factor: float = 2.0) -> DataFrame:
    """Values over `factor` times both neighbours, or under both divided by it, in adjacent periods."""
    w = Window.partitionBy(entity).orderBy(period)
    near = (F.lag(period).over(w) == F.col(period) - 1) & (F.lead(period).over(w) == F.col(period) + 1)
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    up, down = F.col(value) > factor * F.greatest(before, after), F.col(value) * factor < F.least(before, after)
    marked = df.withColumns({"before": before, "after": after, "_near": near, "_spike": F.when(up, "up").when(down, "down")})
    return marked.where("_near and _spike is not null").withColumnRenamed("_spike", "direction").drop("_near")
