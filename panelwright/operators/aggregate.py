"""Aggregations that Spark has no single call for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio_of_sums(numerator: str, denominator: str) -> Column:
    """Sum over sum, over the rows that have both."""
    both = F.col(numerator).isNotNull() & F.col(denominator).isNotNull()
    return F.sum(F.when(both, F.col(numerator))) / F.nullif(F.sum(F.when(both, F.col(denominator))), F.lit(0))


def arg_max(value: str, by: str) -> Column:
    """The value at the largest `by`, rows without a value left out; equal `by`: the largest value."""
    return F.max(F.when(F.col(value).isNotNull(), F.struct(F.col(by), F.col(value)))).getField(value)


def joined_set(c: Column, separator: str = ", ") -> Column:
    """Different values in order, joined; null if there is none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(c)), separator), F.lit(""))


def with_total(df: DataFrame, key: str, aggregates: Sequence[Column], total: str = "All") -> DataFrame:
    """One row for each key and one for all, from a single scan."""
    return df.withColumn(key, F.explode(F.array(F.col(key), F.lit(total)))).groupBy(key).agg(*aggregates)


#: Entities in a bitmap.
BITS = 32_768


def roll_up(df: DataFrame, fine: Sequence[str], levels: Sequence[tuple[Mapping[str, Column], Column | None]], sums: Mapping[str, Column], entity: str | None = None, distinct: Mapping[str, Column | None] = {}) -> DataFrame:  # noqa: B006
    """Summaries at several levels, with exact numbers of distinct entities, from one aggregate.

    levels: the columns of a level's rows (over the fine columns), and which fine rows belong to it (None: all). sums: aggregates
    that may be summed again (counts and sums). distinct: which rows' entities count (None: all); entities are whole numbers.

    Rows are read once and aggregated by the fine columns and blocks of BITS entities, where an entity is a bit of a bitmap;
    only these aggregates are dealt out to levels, and bitmaps of a block are joined by OR. What is shuffled are bitmaps of
    BITS / 8 bytes for each fine group and block that has a row, so entity numbers should lie densely, and fine groups
    should have many rows a block.
    """
    block = F.shiftright(F.col(entity).cast("long"), 15) if entity else F.lit(0)
    place = F.pmod(F.col(entity).cast("long"), F.lit(BITS)) if entity else None
    marks = {n: F.bitmap_construct_agg(place if c is None else F.when(c, place)) for n, c in distinct.items()}
    one = df.groupBy(*fine, block.alias("_block")).agg(*(c.alias(f"_s_{n}") for n, c in sums.items()), *(c.alias(f"_d_{n}") for n, c in marks.items()))
    rows = [F.when(cond if cond is not None else F.lit(True), F.struct(*(c.alias(n) for n, c in keys.items()))) for keys, cond in levels]
    names = list(levels[0][0])
    fanned = one.select(F.explode(F.filter(F.array(*rows), lambda b: b.isNotNull())).alias("_l"), "_block", *(f"_s_{n}" for n in sums), *(f"_d_{n}" for n in distinct)).select("_l.*", "_block", *(f"_s_{n}" for n in sums), *(f"_d_{n}" for n in distinct))
    blocks = fanned.groupBy(*names, "_block").agg(*(F.sum(f"_s_{n}").alias(f"_s_{n}") for n in sums), *(F.bitmap_or_agg(f"_d_{n}").alias(f"_d_{n}") for n in distinct))
    return blocks.groupBy(*names).agg(*(F.sum(f"_s_{n}").alias(n) for n in sums), *(F.sum(F.bitmap_count(f"_d_{n}")).alias(n) for n in distinct))


def fanned_sets(df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], level: str = "level") -> DataFrame:
    """Each row once for each grouping set: keys outside the set become null, and level says which (a bit for each key, as
    grouping_id does), from one scan."""
    rows = []
    for own in sets:
        bits = sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in own)
        rows.append(F.struct(*(F.col(c).alias(c) if c in own else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in keys), F.lit(bits).cast("long").alias(level)))
    return df.withColumn("_set", F.explode(F.array(*rows))).select(*(c for c in df.columns if c not in keys), "_set.*")


def suppress_small_groups(df: DataFrame, statistics: Sequence[str], count: str, least: int = 5, reason: str = "null_reason") -> DataFrame:
    """Statistics of groups with fewer than `least` entities become null, with a reason; counts stay."""
    small = F.col(count) < least
    return df.withColumns({c: F.when(~small, F.col(c)) for c in statistics} | {reason: F.when(small, F.lit(f"fewer than {least}"))})


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "metric", value: str = "value") -> DataFrame:
    """Long rows; values that are null go."""
    return df.unpivot(list(ids), list(values), name, value).where(F.col(value).isNotNull())
