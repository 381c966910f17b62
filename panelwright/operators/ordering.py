"""Ranks and exact quantiles inside groups of any size: no task sorts or holds a large group.

Where all groups are small (LARGE rows at most), Spark's own windows and percentiles do the same in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import workspace

#: Rows of a group that one task may sort or hold; ranges that a group's values are counted in at a time.
LARGE, RANGES = 100_000, 1024


def kept(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: later passes see the same rows in the same ranges."""
    path = workspace(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    """Equal keys, nulls among them."""
    return reduce(lambda x, y: x & y, (a[c].eqNullSafe(b[c]) for c in columns), F.lit(True))


def any_large(df: DataFrame, by: Sequence[str], large: int | None = None) -> bool:
    return not df.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") > (large or LARGE)).isEmpty()


def with_places(df: DataFrame, by: Sequence[str], value: str, below: str = "n_below", ties: str = "n_ties", size: str = "n_group", large: bool | None = None) -> DataFrame:
    """df with, for each row that has a value: how many rows of its group have a smaller one, as large a one (itself included)
    and any. Null values get nulls; a null group key is a group.

    In large groups the different values are counted first, so that ties are one row; Spark's range partitioning, whose
    splitters come from a sample of them, deals (group, value) out in even ranges; each range adds up its counts, and the
    counts of the ranges before it are joined to it. `large` says whether there are large groups, if that is known.
    """
    has = F.col(value).isNotNull()
    if not (any_large(df.where(has), by) if large is None else large):
        w = Window.partitionBy(*by, has)
        return df.withColumns({
            below: F.when(has, F.rank().over(w.orderBy(value)) - 1).cast("long"),
            ties: F.when(has, F.count("*").over(Window.partitionBy(*by, value))), size: F.when(has, F.count("*").over(w)),
        })
    counts = df.where(has).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    ranged = kept(counts.repartitionByRange(*by, "_v").withColumn("_part", F.spark_partition_id()))
    parts = ranged.groupBy(*by, "_part").agg(F.sum("_c").alias("_m"))
    w = Window.partitionBy(*by)
    parts = parts.select(*by, "_part", F.coalesce(F.sum("_m").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_m").over(w).alias(size))
    within = F.coalesce(F.sum("_c").over(Window.partitionBy(*by, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = ranged.withColumn("_within", within)
    keyed = numbered.join(parts, same(numbered, parts, [*by, "_part"])).select(*(numbered[c].alias(f"_k{i}") for i, c in enumerate(by)), "_v", (F.col("_before") + F.col("_within")).alias(below), F.col("_c").alias(ties), size)
    on = reduce(lambda x, y: x & y, (df[c].eqNullSafe(keyed[f"_k{i}"]) for i, c in enumerate(by)), df[value] == keyed["_v"])
    return df.join(keyed, on, "left").select(*(df[c] for c in df.columns), below, ties, size)


def average_rank(below: str = "n_below", ties: str = "n_ties") -> Column:
    """Ties share the mean of their ranks."""
    return F.col(below) + (F.col(ties) + 1) / 2.0


def descending_rank(below: str = "n_below", ties: str = "n_ties", size: str = "n_group") -> Column:
    """The largest is first; ties share the smallest rank."""
    return F.col(size) - F.col(below) - F.col(ties) + 1


def ntile(n: int, place: Column, size: Column) -> Column:
    """The band, from 1, of a row at a place (from 0) among `size` rows; the first bands take what is over."""
    each, over = F.floor(size / n), size % n
    wide = over * (each + 1)
    return (F.when(place < wide, F.floor(place / (each + 1))).otherwise(over + F.floor((place - wide) / F.nullif(each, F.lit(0)))) + 1).cast("int")


def _histogram(rows: DataFrame, targets: DataFrame, by: Sequence[str]) -> DataFrame:
    """One more round: each target's range is cut into RANGES parts, rows are counted in them, and the part that holds the
    target's rank is its new range, from its smallest to its largest value."""
    spans = targets.groupBy(*by, "lo", "hi").agg(F.max("below").alias("below"))
    joined = rows.join(spans, same(rows, spans, by) & (rows["_v"] >= F.col("lo")) & (rows["_v"] <= F.col("hi"))).select(*(rows[c] for c in by), "_v", "lo", "hi", "below")
    part = F.least(F.lit(RANGES - 1), F.floor((F.col("_v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * RANGES)).cast("int")
    counts = joined.groupBy(*by, "lo", "hi", "below", part.alias("part")).agg(F.count("*").alias("c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    upto = F.col("below") + F.sum("c").over(Window.partitionBy(*by, "lo", "hi").orderBy("part"))
    counts = counts.withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("c"))
    t = targets.drop("below", "n")
    found = t.join(counts, same(t, counts, [*by, "lo", "hi"]) & (t["rank"] >= counts["from"]) & (t["rank"] < counts["upto"]))
    return found.select(*(t[c] for c in by), t["rank"], F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), F.col("from").alias("below"), F.col("c").alias("n"))


def quantiles(df: DataFrame, by: Sequence[str], value: str, points: Sequence[float], large: int | None = None) -> DataFrame:
    """One row for each group: by, n (rows with a value) and q, the exact quantiles at the points (interpolated, as in SQL); null
    where a group has no value.

    The ranks of a large group's quantiles are found by repeated histograms: ranges between the smallest and the largest value
    are counted, the range that holds the rank is kept, and so on until it holds LARGE rows at most or one value. Each round
    shuffles counts alone, at most RANGES for a range and task.
    """
    large = large or LARGE
    rows = df.select(*by, F.col(value).cast("double").alias("_v"))
    ends = F.array(*map(F.lit, map(float, points)))
    if not any_large(rows.where("_v is not null"), by, large):
        return rows.groupBy(*by).agg(F.count("_v").alias("n"), F.percentile("_v", ends).alias("q"))
    sizes = kept(rows.groupBy(*by).agg(F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")))
    places = F.transform(ends, lambda p: p * (F.col("n") - 1))
    ranks = F.explode(F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(F.floor(p), F.ceil(p)))))).alias("rank")
    targets = kept(sizes.where("n > 0").select(*by, ranks, "lo", "hi", F.lit(0).cast("long").alias("below"), "n"))
    some, done = rows.where("_v is not null"), []
    while True:
        open_ = (F.col("n") > large) & (F.col("lo") < F.col("hi"))
        done.append(targets.where(~open_))
        wide = targets.where(open_)
        if wide.isEmpty():
            break
        targets = kept(_histogram(some, wide, by))
    ready = reduce(DataFrame.unionByName, done)
    one = ready.where("lo = hi").select(*by, "rank", F.col("lo").alias("x"))
    spans = ready.where("lo < hi").groupBy(*by, "lo", "hi").agg(F.max("below").alias("below"))
    values = some.join(spans, same(some, spans, by) & (some["_v"] >= F.col("lo")) & (some["_v"] <= F.col("hi"))).select(*(some[c] for c in by), "_v", "lo", "hi", "below")
    counts = values.groupBy(*by, "lo", "hi", "below", "_v").agg(F.count("*").alias("c"))
    counts = counts.withColumn("upto", F.col("below") + F.sum("c").over(Window.partitionBy(*by, "lo", "hi").orderBy("_v")))
    t = ready.where("lo < hi").drop("below", "n")
    rest = t.join(counts, same(t, counts, [*by, "lo", "hi"]) & (t["rank"] >= counts["upto"] - counts["c"]) & (t["rank"] < counts["upto"])).select(*(t[c] for c in by), t["rank"], F.col("_v").alias("x"))
    found = one.unionByName(rest).groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("at"))
    mixed = F.transform(places, lambda p: F.col("at")[F.floor(p)] * (1 - (p - F.floor(p))) + F.col("at")[F.ceil(p)] * (p - F.floor(p)))
    return sizes.join(found, same(sizes, found, by), "left").select(*(sizes[c] for c in by), "n", F.when(F.col("n") > 0, mixed).alias("q"))


def joined_medians(groups: DataFrame, rows: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """groups (a row for each by) with the exact median of the rows of each."""
    m = quantiles(rows, by, value, [0.5])
    return groups.join(m, same(groups, m, by), "left").select(*(groups[c] for c in groups.columns), F.get(m["q"], F.lit(0)).alias(out))


def with_medians(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """df with the median of each row's group: one row for each group, joined back."""
    m = quantiles(df, by, value, [0.5]).select(*(F.col(c).alias(f"_m{i}") for i, c in enumerate(by)), F.get("q", F.lit(0)).alias(out))
    on = reduce(lambda x, y: x & y, (df[c].eqNullSafe(m[f"_m{i}"]) for i, c in enumerate(by)), F.lit(True))
    return df.join(m, on, "left").select(*(df[c] for c in df.columns), out)
