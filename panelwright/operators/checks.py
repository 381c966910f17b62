"""Data-quality checks: each returns the rows that break a rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import equality


def unique(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull()
    return df.where(bad)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))


def accepted_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    c = F.col(column)
    bad = (c < low if low is not None else F.lit(False)) | (c > high if high is not None else F.lit(False))
    return df.where(F.coalesce(bad, F.lit(False)))


def relationships(df: DataFrame, columns: Sequence[str], to: DataFrame, to_columns: Sequence[str]) -> DataFrame:
    """Rows whose (composite) key isn't there; keys with a null refer to nothing and pass."""
    keys = to.select(*(F.col(b).alias(a) for a, b in zip(columns, to_columns, strict=True)))
    whole = df
    for c in columns:
        whole = whole.where(F.col(c).isNotNull())
    return whole.join(keys, list(columns), "left_anti")


def equal_rowcount(a: DataFrame, b: DataFrame) -> DataFrame:
    counts = a.agg(F.count("*").alias("n_left")).crossJoin(F.broadcast(b.agg(F.count("*").alias("n_right"))))
    return counts.where("n_left <> n_right")


def contract(df: DataFrame, schema: StructType) -> list[str]:
    """What the columns of df break of a contract."""
    have = dict(df.dtypes)
    want = {f.name: f.dataType.simpleString() for f in schema}
    return sorted([f"{c} is missing" for c in want if c not in have] + [f"{c} isn't in the contract" for c in have if c not in want] + [f"{c} is {have[c]}, not {want[c]}" for c in want if c in have and have[c] != want[c]])


def counts_reconcile(staged: DataFrame, declared: DataFrame, key: str, count: str) -> DataFrame:
    n = staged.groupBy(key).agg(F.count("*").alias("n_staged"))
    return declared.join(n, key, "left").select(key, F.col(count).alias("n_declared"), F.coalesce("n_staged", F.lit(0)).alias("n_staged")).where("n_declared <> n_staged")


def one_main_row(df: DataFrame, key: str, is_main: Column) -> DataFrame:
    """Keys with none or several main rows."""
    return df.groupBy(key).agg(F.count_if(is_main).alias("n_main")).where("n_main <> 1")


def scd2_no_overlap(df: DataFrame, key: Sequence[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    after = F.lead(start).over(Window.partitionBy(*key).orderBy(start))
    return df.withColumn("_next", after).where(F.col("_next").isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col("_next")))).drop("_next")


def scd2_one_current(df: DataFrame, key: Sequence[str], flag: str = "is_current") -> DataFrame:
    return df.groupBy(*key).agg(F.count_if(flag).alias("n_current")).where("n_current <> 1")


def grain_complete(df: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the source without a row, and keys with several."""
    n = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return source.select(*keys).distinct().join(n, list(keys), "left").withColumn("n", F.coalesce("n", F.lit(0))).where("n <> 1")


def sanity(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column], accepted: DataFrame | None = None) -> DataFrame:
    """One row for each broken rule; those in `accepted` (keys and rule) are known and left out."""
    broken = F.filter(F.array(*(F.when(cond, F.lit(name)) for name, cond in rules.items())), lambda r: r.isNotNull())
    rows = df.select(*keys, F.explode(broken).alias("rule"))
    return rows.join(accepted, [*keys, "rule"], "left_anti") if accepted is not None else rows


def pareto_consistent(df: DataFrame, period: str, share: str, cumulative: str, position: str, tolerance: float = 1e-9) -> DataFrame:
    """Periods whose shares don't add up to 1, or whose running share falls."""
    w = Window.partitionBy(period).orderBy(position)
    falls = df.withColumn("_fall", F.col(cumulative) < F.lag(cumulative).over(w) - tolerance)
    return falls.groupBy(period).agg(F.sum(share).alias("total"), F.count_if("_fall").alias("n_falls")).where((F.abs(F.col("total") - 1) > tolerance) | (F.col("n_falls") > 0))


def weights_sum_to_one(weights: DataFrame, column: str, n: int) -> DataFrame:
    return weights.agg(F.sum(column).alias("total"), F.count("*").alias("n")).where((F.abs(F.col("total") - 1) > 1e-9) | (F.col("n") != n))


def publication_guard(df: DataFrame, allowed: Sequence[str], statistics: Sequence[str], count: str, least: int = 5) -> tuple[list[str], DataFrame]:
    """Columns that may not be published, and rows that show a statistic of too small a group."""
    shown = F.lit(False)
    for c in statistics:
        shown = shown | F.col(c).isNotNull()
    return sorted(set(df.columns) - set(allowed)), df.where((F.col(count) < least) & shown)


def groups_min_size(df: DataFrame, group: str, entity: str, least: int = 5) -> DataFrame:
    return df.groupBy(group).agg(F.countDistinct(entity).alias("n")).where(F.col("n") < least)


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, tolerance: float = 1e-9) -> DataFrame:
    """Keys that only one side has, and values that differ by more than the tolerance. Keys are joined only in buckets whose hash
    sums differ, so what is equal to the last bit isn't shuffled."""
    a, b = (d.select(*keys, F.col(value).alias("_v")) for d in (a, b))
    buckets = equality.differing_buckets(a, b, [*keys, "_v"], list(keys))
    a, b = (equality.in_buckets(d, list(keys), buckets).withColumnRenamed("_v", value) for d in (a, b))
    left, right = a.select(*keys, F.col(value).alias("left_value"), F.lit(True).alias("_l")), b.select(*keys, F.col(value).alias("right_value"), F.lit(True).alias("_r"))
    both = left.join(right, list(keys), "full_outer")
    kind = F.when(F.col("_r").isNull(), "left only").when(F.col("_l").isNull(), "right only").when(~F.col("left_value").eqNullSafe(F.col("right_value")) & F.coalesce(F.abs(F.col("left_value") - F.col("right_value")) > tolerance, F.lit(True)), "differs")
    return both.withColumn("problem", kind).where("problem is not null").drop("_l", "_r")


def expected_values(df: DataFrame, expected: DataFrame, keys: Sequence[str], value: str, tolerance: float = 1e-9) -> DataFrame:
    """Points that don't have the value they are known to have."""
    got = df.select(*keys, F.col(value).alias("_got"))
    return expected.join(got, list(keys), "left").where(F.col("_got").isNull() | (F.abs(F.col("_got") - F.col(value)) > tolerance)).drop("_got")


def small_group_statistics(df: DataFrame, statistic: str, count: str, least: int = 5) -> DataFrame:
    """Rows that show a statistic of a group that is too small."""
    return df.where(F.col(statistic).isNotNull() & (F.col(count) < least))


def catalogue_is_columns(catalogue: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Names of the catalogue (name) without a column, and columns that it doesn't name."""
    have = catalogue.sparkSession.createDataFrame([(c, True) for c in columns], "name string, _column boolean")
    both = catalogue.select("name").distinct().withColumn("_listed", F.lit(True)).join(F.broadcast(have), "name", "full_outer")
    return both.where("_listed IS NULL OR _column IS NULL").select("name", F.when(F.col("_column").isNull(), "no column").otherwise("not in the catalogue").alias("problem"))


def matches_one(overrides: DataFrame, filed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overrides that don't match exactly one filed value."""
    n = filed.groupBy(*keys).agg(F.count("*").alias("n_matches"))
    return overrides.join(n, list(keys), "left").withColumn("n_matches", F.coalesce("n_matches", F.lit(0))).where("n_matches <> 1")


#: Names that belong to working tables.
RAW_NAME = r"^_|_raw$|^raw_|_cents$|_id_hash$"


def far_from_neighbours(overrides: DataFrame, panel: DataFrame, entity: str, period: str, override: str, value: str, factor: float = 3.0) -> DataFrame:
    """Overrides more than `factor` times off a value of the entity's period before or after. One join by two equal keys."""
    near = panel.select(entity, F.explode(F.array(F.col(period) - 1, F.col(period) + 1)).alias(period), F.col(value).alias("_near"))
    off = ~F.col(override).between(F.col("_near") / factor, F.col("_near") * factor)
    return overrides.join(near, [entity, period]).where(off).select(*overrides.columns).distinct()


def publication_problems(tables: Mapping[str, DataFrame], classes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Columns that may not be published, with the number of values that they would show: any column of a table that
    `classes` doesn't have, columns that aren't allowed in their table, and allowed ones with names of working tables."""
    import re

    out = None
    for name, df in tables.items():
        for c in df.columns:
            problem = "table is not classified" if name not in classes else "not allowed" if c not in classes[name] else "looks raw" if re.search(RAW_NAME, c) else None
            if problem:
                row = df.agg(F.count(c).alias("n_values")).select(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.lit(problem).alias("problem"), "n_values")
                out = row if out is None else out.unionByName(row)
    if out is None:
        return next(iter(tables.values())).sparkSession.createDataFrame([], "table_name string, column_name string, problem string, n_values long")
    return out


def peer_groups_cover(entities: DataFrame, group: str, groups: DataFrame) -> DataFrame:
    """Entities whose group isn't among the peer groups."""
    return entities.join(groups.select(group).distinct(), group, "left_anti")
