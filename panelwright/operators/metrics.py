"""The metric layer: a catalogue of specs that compile to aggregate columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregate import roll_up
from .ordering import any_large, joined_medians, quantiles

KINDS = {"ratio_of_sums", "median", "average", "share", "count", "count_distinct"}


@dataclass(frozen=True)
class MetricSpec:
    """One metric. numerator, denominator and condition name columns; a gate is a metric whose count must reach the least
    group size; percent metrics are times 100."""

    name: str
    kind: str
    column: str | None = None
    numerator: str | None = None
    denominator: str | None = None
    condition: str | None = None
    percent: bool = False
    gate: str | None = None
    public: bool = True
    is_ratio: bool = False
    is_score: bool = False

    def compile(self) -> Column:
        if self.kind == "ratio_of_sums":
            both = F.col(self.numerator).isNotNull() & F.col(self.denominator).isNotNull()
            out = F.sum(F.when(both, F.col(self.numerator))) / F.nullif(F.sum(F.when(both, F.col(self.denominator))), F.lit(0))
        elif self.kind == "median":
            out = F.median(self.column)
        elif self.kind == "average":
            out = F.avg(self.column)
        elif self.kind == "share":
            within = F.expr(self.condition) if self.condition else F.lit(True)
            out = F.count_if(F.expr(self.column) & within) / F.nullif(F.count_if(within), F.lit(0))
        elif self.kind == "count":
            out = F.count_if(F.expr(self.condition)) if self.condition else F.count("*")
        else:
            out = F.countDistinct(F.when(F.expr(self.condition) if self.condition else F.lit(True), F.col(self.column)))
        return (out * 100.0 if self.percent else out).alias(self.name)


def problems_of(specs: Sequence[MetricSpec]) -> list[tuple[str, str]]:
    """(metric, problem): what a group figure must not be, above all an average of ratios."""
    names = [s.name for s in specs]
    out = [(n, f"{n} is there twice") for n in {n for n in names if names.count(n) > 1}]
    for s in specs:
        if not re.fullmatch(r"[a-z][a-z0-9_]*", s.name):
            out.append((s.name, f"{s.name}: not a plain name"))
        if s.kind not in KINDS:
            out.append((s.name, f"{s.name}: no kind {s.kind}"))
        if s.kind == "ratio_of_sums" and not (s.numerator and s.denominator):
            out.append((s.name, f"{s.name}: a ratio needs a numerator and a denominator"))
        if s.kind in ("median", "average", "share", "count_distinct") and not s.column:
            out.append((s.name, f"{s.name}: no column"))
        if s.kind == "average" and (s.is_ratio or not s.is_score):
            out.append((s.name, f"{s.name}: only scores may be averaged"))
        if s.gate and s.gate not in names:
            out.append((s.name, f"{s.name}: its gate {s.gate} isn't in the catalogue"))
    return sorted(out, key=lambda x: x[1])


def validate_specs(specs: Sequence[MetricSpec]) -> None:
    """Refuse a catalogue with problems."""
    if problems := problems_of(specs):
        raise ValueError("; ".join(p for _, p in problems))


def check_catalogue(df: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """Each metric against the table it is meant for: its problem (null: none; a column that isn't there is one) and how many
    rows have all that it needs, from one scan."""
    found: dict[str, str] = {}
    for name, problem in problems_of(specs):
        found.setdefault(name, problem)
    rows = []
    for s in specs:
        needs = [c for c in (s.column, s.numerator, s.denominator) if c]
        missing = [c for c in needs if c not in df.columns]
        problem = found.get(s.name) or (f"{s.name}: no columns {missing}" if missing else None)
        there = F.lit(True)
        for c in needs:
            there = there & (F.col(c).isNotNull() if c in df.columns else F.lit(False))
        rows.append(F.struct(F.lit(s.name).alias("name"), F.lit(s.kind).alias("kind"), F.lit(problem).cast("string").alias("problem"), F.count_if(there).alias("n_rows")))
    return df.agg(F.array(*rows).alias("_r")).select(F.explode("_r").alias("_r")).select("_r.*")


def query_metrics(df: DataFrame, specs: Sequence[MetricSpec], by: Sequence[str], least: int | None = None) -> DataFrame:
    """All metrics by dimensions in one aggregation; gated ones are null where the gate's count is under `least`."""
    validate_specs(specs)
    medians = [s for s in specs if s.kind == "median"]
    large = bool(medians) and any_large(df, by)
    out = df.groupBy(*by).agg(F.count("*").alias("_rows"), *(s.compile() for s in specs if not (large and s.kind == "median")))
    for s in medians if large else ():  # a large group's values don't fit into one aggregate
        m = quantiles(df, by, s.column, [0.5]).select(*(F.col(c).alias(f"_m{i}") for i, c in enumerate(by)), (F.get("q", F.lit(0)) * (100.0 if s.percent else 1.0)).alias(s.name))
        out = out.join(m, reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_m{i}")) for i, c in enumerate(by)), F.lit(True)), "left").drop(*(f"_m{i}" for i in range(len(by))))
    out = out.select(*by, *(s.name for s in specs))
    if least is None:
        return out
    return out.withColumns({s.name: F.when(F.col(s.gate) >= least, F.col(s.name)) for s in specs if s.gate})


def query_metrics_by_groups(df: DataFrame, specs: Sequence[MetricSpec], groups: Mapping[str, Column], by: Sequence[str], entity: str, least: int | None = None) -> DataFrame:
    """query_metrics() for several group types at once: group_type, group_value, by and the metrics.

    Rows are read once into sums, counts and bitmaps of entities by all groups' values together; each group type is rolled
    up from these. Medians can't be summed again, so they alone are asked of fanned-out rows.
    """
    validate_specs(specs)
    if any(s.kind == "count_distinct" and s.column != entity for s in specs):
        raise ValueError(f"only {entity} may be counted distinct here")
    named = df.withColumns({f"_g{i}": v.cast("string") for i, v in enumerate(groups.values())})
    fine = [*(f"_g{i}" for i in range(len(groups))), *by]
    levels = [({"group_type": F.lit(t), "group_value": F.col(f"_g{i}"), **{c: F.col(c) for c in by}}, None) for i, t in enumerate(groups)]
    where = lambda s: F.expr(s.condition) if s.condition else F.lit(True)
    sums, final = {}, {}
    for s in specs:
        a, b = f"{s.name}_a", f"{s.name}_b"
        if s.kind == "ratio_of_sums":
            both = F.col(s.numerator).isNotNull() & F.col(s.denominator).isNotNull()
            sums |= {a: F.sum(F.when(both, F.col(s.numerator))), b: F.sum(F.when(both, F.col(s.denominator)))}
        elif s.kind == "average":
            sums |= {a: F.sum(s.column), b: F.count(s.column)}
        elif s.kind == "share":
            sums |= {a: F.count_if(F.expr(s.column) & where(s)), b: F.count_if(where(s))}
        elif s.kind == "count":
            sums |= {s.name: F.count_if(where(s))}
        if s.kind in ("ratio_of_sums", "average", "share"):
            final[s.name] = F.col(a) / F.nullif(b, F.lit(0)) * (100.0 if s.percent else 1)
    out = roll_up(named, fine, levels, sums, entity, {s.name: where(s) if s.condition else None for s in specs if s.kind == "count_distinct"}).withColumns(final)
    keys = ["group_type", "group_value", *by]
    for s in specs:
        if s.kind == "median":
            pairs = F.explode(F.array(*(F.struct(F.lit(t).alias("group_type"), F.col(f"_g{i}").alias("group_value")) for i, t in enumerate(groups))))
            rows = named.select(pairs.alias("_g"), *by, s.column).select("_g.*", *by, s.column)
            out = joined_medians(out, rows, keys, s.column, s.name)
            out = out.withColumn(s.name, F.col(s.name) * 100.0) if s.percent else out
    if least is not None:
        out = out.withColumns({s.name: F.when(F.col(s.gate) >= least, F.col(s.name)) for s in specs if s.gate})
    return out.select(*keys, *(s.name for s in specs))


def later_filing_rule(df: DataFrame, period: str, columns: Sequence[str]) -> DataFrame:
    """What only a later filing can tell: null in the latest period, zero where absent before."""
    latest = F.broadcast(df.agg(F.max(period).alias("_latest")))
    joined = df.crossJoin(latest)
    return joined.withColumns({c: F.when(F.col(period) < F.col("_latest"), F.coalesce(c, F.lit(0))) for c in columns}).drop("_latest")


def share_of_selection(df: DataFrame, value: str, selection: Sequence[str]) -> DataFrame:
    """Share, dense rank, and share of all values that are as large or larger, in each selection."""
    w = Window.partitionBy(*selection)
    down = w.orderBy(F.col(value).desc())
    total = F.nullif(F.sum(value).over(w), F.lit(0))
    return df.withColumns({
        "share_of_selection": F.col(value) / total, "dense_rank_in_selection": F.dense_rank().over(down),
        "cumulative_share_by_value": F.sum(value).over(down.rangeBetween(Window.unboundedPreceding, Window.currentRow)) / total,
    })


def lookup(df: DataFrame, filters: Mapping[str, object], columns: Sequence[str], order: Sequence[Column] = (), limit: int | None = None) -> DataFrame:
    """A parameterised look-up: arguments are checked against the table's columns and compared as literals."""
    unknown = [c for c in (*filters, *columns) if c not in df.columns]
    if unknown:
        raise ValueError(f"no columns {unknown}")
    for c, v in filters.items():
        df = df.where(F.col(c) == F.lit(v))
    out = df.orderBy(*order) if order else df
    return (out.limit(limit) if limit else out).select(*columns)


def metric_grid(df: DataFrame, row: str, column: str, values: Sequence, cell: str) -> DataFrame:
    """Groups by periods, one figure in each cell."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.first(cell, ignorenulls=True))
