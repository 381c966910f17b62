"""Look-ups over public tables: arguments are literals, and a cell that is hidden says why."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .metrics import lookup
from .window import concentration as _concentration
from .window import group_percentile


def withheld_label(value: Column, n: Column, least: int = 5) -> Column:
    return F.when(value.isNull(), "withheld: no value").when(n < least, f"withheld: group under {least}").otherwise("shown")


def peer_lookup(df: DataFrame, group: Sequence[str], period: str, value: str, least: int = 5) -> DataFrame:
    """Each row with its group's median (hidden in small groups), whether its period is final, and the rule that shows or
    hides the median."""
    groups = df.groupBy(*group).agg(F.median(value).alias("_m"), F.count("*").alias("_n"))
    latest = F.broadcast(df.agg(F.max(period).alias("_latest")))
    enough = F.col("_n") >= least
    return df.join(groups, list(group)).crossJoin(latest).withColumns({
        "peer_median": F.when(enough, F.col("_m")), "year_status": F.when(F.col(period) == F.col("_latest"), "provisional").otherwise("final"),
        "rule_label": F.when(enough, "shown").otherwise(f"withheld: fewer than {least}"),
    }).drop("_m", "_n", "_latest")


def percentiles(df: DataFrame, group: Sequence[str], value: str, filters: Mapping[str, object]) -> DataFrame:
    ranked = group_percentile(df, group, value).withColumn("status", withheld_label(F.col(value), F.col("group_n")))
    return lookup(ranked, filters, ranked.columns)


def concentration(df: DataFrame, entity: str, value: str, period: str, at) -> DataFrame:
    """How many entities hold 80 % of a period's total, and what the first five hold."""
    c = _concentration(lookup(df, {period: at}, df.columns), entity, value, period, least=1)
    return c.groupBy(period).agg(F.max("n_entities").alias("n_entities"), F.min(F.when(F.col("cumulative_share") >= 0.8, F.col("position"))).alias("entities_for_80"), F.max(F.when(F.col("position") <= 5, F.col("cumulative_share"))).alias("top5_share"))


def top_movers(changes: DataFrame, period: int, k: int, rising: bool = True) -> DataFrame:
    """The k largest confirmed changes of a period."""
    order = F.col("change").desc() if rising else F.col("change")
    return lookup(changes, {"status": "confirmed", "period": period}, ["entity", "period", "change"], [order, F.col("entity")], k)


def restatement_summary(pairs: DataFrame, by: Sequence[str], least: int = 5) -> DataFrame:
    n = pairs.groupBy(*by).agg(F.count_if("is_compared").alias("n_compared"), F.count_if(F.col("classification").isin("material", "large")).alias("n_material"), F.countDistinct("entity").alias("_n"))
    return n.withColumn("status", F.when(F.col("_n") < least, f"withheld: fewer than {least}").otherwise("shown")).drop("_n")


def resolve_groups(df: DataFrame, types: Sequence[str], values: Sequence[str], entity: str) -> DataFrame:
    """The group type that each value names, with the number of its entities: one scan, a row for each type that has it."""
    pairs = F.array(*(F.struct(F.lit(t).alias("group_type"), F.col(t).alias("group_value")) for t in types))
    return df.select(entity, F.explode(pairs).alias("_g")).select(entity, "_g.*").where(F.col("group_value").isin(*values)).groupBy("group_type", "group_value").agg(F.countDistinct(entity).alias("n"))
