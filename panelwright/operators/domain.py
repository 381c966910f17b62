"""Operators of the panel domain: joins of records to references, groups, normalisation, scores and restatements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean
from .ordering import kept, quantiles, same, with_places
from .window import pick_one


#: Patterns in one automaton at most, some 100 MB in a worker at 30 letters each.
PATTERNS = 200_000


def _best_alias(rules: list[tuple[str, str]]):
    """Of each name, the place of the first of the rules (pattern, label) whose pattern it holds."""
    first: dict[str, int] = {}
    for i, (pattern, _) in enumerate(rules):
        first.setdefault(pattern, i)

    @F.pandas_udf("long")
    def best(names: pd.Series) -> pd.Series:
        import ahocorasick

        always = first.get("", len(rules))
        automaton = ahocorasick.Automaton()
        for pattern, i in first.items():
            if pattern:
                automaton.add_word(pattern, i)
        automaton.make_automaton()
        seek = automaton.iter if len(automaton) else lambda _: ()
        out = [None if x is None or x != x else min((i for _, i in seek(x)), default=len(rules)) for x in names]
        return pd.Series([None if i is None or min(i, always) == len(rules) else min(i, always) for i in out], dtype="Int64")

    return best


def resolve_aliases(rows: DataFrame, name: str, aliases: DataFrame, most: int = PATTERNS) -> DataFrame:
    """rows with the canonical name (null: none) of the best alias whose pattern the lower-cased name holds: by priority, then the
    longest pattern, then the pattern itself.

    aliases (pattern, name, priority; null patterns match nothing) become an Aho-Corasick automaton, which finds all patterns of
    a name in one pass over it. They are counted before they are shipped: of more than `most`, the first so many in that order
    make the first automaton, and names that it doesn't know pass on to the next, so what a task holds is bounded.
    """
    ranked = aliases.where("pattern is not null").groupBy("pattern").agg(F.min(F.struct("priority", "name")).alias("_b")).select("pattern", "_b.name", "_b.priority")
    order = F.struct("priority", (-F.length("pattern")).alias("_l"), "pattern")
    n = ranked.count()
    parts: list[DataFrame] = [ranked.withColumn("_o", order)]
    if n > most:
        placed = kept(with_places(ranked.withColumn("_o", order), [], "_o", large=True))
        parts = [placed.where((F.col("n_below") >= i) & (F.col("n_below") < i + most)) for i in range(0, n, most)]
    out = rows.withColumn("_name", F.lit(None).cast("string"))
    for k, part in enumerate(parts):
        rules = [(r.pattern, r.name) for r in sorted(part.select("pattern", "name", "priority").collect(), key=lambda r: (r.priority is not None, r.priority or 0, -len(r.pattern), r.pattern))]
        if not rules:
            continue
        labels = rows.sparkSession.createDataFrame([(i, label) for i, (_, label) in enumerate(rules)], "_i long, _label string")
        asked = out.withColumn("_i", _best_alias(rules)(F.when(F.col("_name").isNull(), F.lower(F.col(name)))))
        out = asked.join(labels, "_i", "left").withColumn("_name", F.coalesce("_name", "_label")).drop("_i", "_label")
        out = kept(out) if k + 1 < len(parts) else out
    return out.withColumn("name", F.col("_name")).drop("_name")


def median_of_others(df: DataFrame, keys: Sequence[str], own: str, value: str, out: str) -> DataFrame:
    """The median of the key's other rows. A key's rows are few (its periods), so they travel as one array instead of a
    self join; each row then leaves itself out."""
    held = F.collect_list(F.struct(F.col(own).alias("k"), F.col(value).alias("v"))).over(Window.partitionBy(*keys))
    others = F.array_sort(F.transform(F.filter(held, lambda s: (s["k"] != F.col(own)) & s["v"].isNotNull()), lambda s: s["v"]))
    with_it = df.withColumn("_o", others).withColumn("_n", F.size("_o"))
    low, high = F.get("_o", F.floor((F.col("_n") - 1) / 2).cast("int")), F.get("_o", F.floor(F.col("_n") / 2).cast("int"))
    return with_it.withColumn(out, F.when(F.col("_n") > 0, (low + high) / 2)).drop("_o", "_n")


def fan_out(df: DataFrame, groups: Mapping[str, Column]) -> DataFrame:
    """Each row once for each group type, from one scan."""
    pairs = F.array(*(F.struct(F.lit(t).alias("group_type"), v.cast("string").alias("group_value")) for t, v in groups.items()))
    return df.withColumn("_g", F.explode(pairs)).select("_g.*", *df.columns)


def global_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Rank over all rows, largest first, without sorting them in one task: a rank is one more than the number of rows
    with larger values, and those are counted over the different values alone."""
    counts = df.groupBy(value).agg(F.count("*").alias("_n"))
    parts = counts.withColumn("_part", F.floor(F.log2(F.greatest(F.col(value), F.lit(1))) * 8))
    # numbers before each range of values: few rows, whatever the input
    ranges = parts.groupBy("_part").agg(F.sum("_n").alias("_m"))
    ranges = ranges.select("_part", (F.sum("_m").over(Window.orderBy(F.col("_part").desc())) - F.col("_m")).alias("_before"))
    within = F.sum("_n").over(Window.partitionBy("_part").orderBy(F.col(value).desc())) - F.col("_n")
    places = parts.withColumn("_within", within).join(F.broadcast(ranges), "_part").select(value, (F.col("_before") + F.col("_within") + 1).cast("int").alias(out))
    return df.join(places, value).select(*df.columns, out)


def rank_revisions(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Place of each filing among those of its key, from the latest; how many there are; whether it is the latest."""
    w = Window.partitionBy(*keys)
    return df.withColumns({"revision_rank": F.row_number().over(w.orderBy(*order)), "n_revisions": F.count("*").over(w)}).withColumn("is_latest", F.col("revision_rank") == 1)


def assign_period_role(df: DataFrame, start: str, end: str, instant: str, main_start: str, main_end: str) -> DataFrame:
    """The role of a context against the filing's own period: this year, one or two years before, or a point in time."""
    year = lambda c: F.add_months(F.col(c), -12)
    role = (
        F.when((F.col(start) == F.col(main_start)) & (F.col(end) == F.col(main_end)), "CY")
        .when(F.col(end) == F.date_sub(F.col(main_start), 1), "PY")
        .when(F.col(end) == F.date_sub(year(main_start), 1), "PY2")
        .when(F.col(instant) == F.col(main_end), "INSTANT_CY")
        .when(F.col(instant) == F.date_sub(F.col(main_start), 1), "INSTANT_PY")
        .otherwise("OTHER")
    )
    return df.withColumn("period_role", role)


def infer_scale(df: DataFrame, entity: str, period: str, value: str, candidates: Sequence[float] = (1e7, 1e6, 1e5), below: float = 1e9, limit: float = 4.0) -> DataFrame:
    """For values under `below`: the scale that brings the value closest, in log distance, to the median of the entity's
    other values at or over it. Adds reference, scale, corrected and confidence; other rows keep their value.

    Only a scale that lands within a factor `limit` of the reference counts, so a value that is right stays.
    """
    marked = df.withColumn("_big", F.when(F.col(value) >= below, F.col(value)))
    marked = median_of_others(marked, [entity], period, "_big", "reference")
    ratio = lambda s: F.abs(F.log10(F.col(value) * s / F.col("reference")))
    fits = F.array_min(F.array(*(F.struct(ratio(s).alias("fit"), F.lit(float(s)).alias("scale")) for s in candidates)))
    needs = (F.col(value) < below) & (F.col(value) > 0) & F.col("reference").isNotNull()
    fit = marked.withColumn("_fit", F.when(needs, fits))
    near = F.log10(F.lit(limit))
    fit = fit.withColumn("scale", F.when(F.col("_fit.fit") <= near, F.col("_fit.scale")))
    confidence = F.when(F.col("scale").isNull(), None).when(F.col("_fit.fit") <= F.log10(F.lit(1.5)), "high").when(F.col("_fit.fit") <= F.log10(F.lit(2.5)), "medium").otherwise("low")
    return fit.withColumns({"corrected": F.col(value) * F.coalesce("scale", F.lit(1.0)), "confidence": confidence}).drop("_big", "_fit")


def normalise_values(df: DataFrame, units: DataFrame, value: str = "raw_value", unit: str = "unit_label") -> DataFrame:
    """Numbers brought to standard units by a rule table (unit_label_raw, unit_std, multiplier), percents to 0-100 and
    durations to days; every change leaves a flag, and the raw value stays."""
    number = F.coalesce(clean.iso_duration_days(F.col(value)), clean.number_from_text(F.col(value)))
    joined = df.join(units, F.col(unit) == F.col("unit_label_raw"), "left")
    percent = (F.col("unit_std") == "percent") & (F.abs(number) <= 1)
    out = F.when(percent, number * 100).otherwise(number * F.coalesce("multiplier", F.lit(1.0)))
    flags = clean.pack_flags([
        (F.col("unit_label_raw").isNull(), "unknown_unit"), (percent, "fraction_to_percent"),
        (F.coalesce(F.col("multiplier") != 1, F.lit(False)) & ~F.coalesce(percent, F.lit(False)), "unit_converted"),
        (clean.iso_duration_days(F.col(value)).isNotNull(), "iso_duration_parsed"), (clean.is_na_text(F.col(value)), "not_applicable"),
        (number.isNull() & F.col(value).isNotNull() & ~clean.is_na_text(F.col(value)), "not_a_number"),
    ])
    return joined.withColumns({"value": clean.round_sig(out), "flags": flags}).drop("unit_label_raw", "multiplier")


def allowed_breakdowns(df: DataFrame, key: str, allowed: Column) -> DataFrame:
    """Rows all of whose axes are allowed."""
    return df.where(F.size(F.array_except(clean.dimension_axes(F.col(key)), allowed)) == 0)


def unit_plausibility(df: DataFrame, entity: str, period: str, group: Sequence[str], value: str, least_peers: int = 3, factor: float = 100.0, tiny: float = 1e-4) -> DataFrame:
    """A value against the median of the entity's other periods, or of its peers if they are enough: more than `factor`
    times is implausible, `tiny` of it or less points to larger units."""
    own = median_of_others(df, [entity], period, value, "own_reference")
    # one row for each group, joined back: no row carries its peers
    middle = quantiles(df, group, value, [0.5]).select(*group, F.get("q", F.lit(0)).alias("peer_reference"))
    groups = df.groupBy(*group).agg(F.countDistinct(F.when(F.col(value).isNotNull(), F.col(entity))).alias("n_peers"))
    groups = middle.join(groups, same(middle, groups, group)).select(*(middle[c] for c in group), "peer_reference", "n_peers")
    keys = [own[c].eqNullSafe(groups[c]) for c in group]
    peers = own.join(groups, keys[0] if len(keys) == 1 else reduce(lambda a, b: a & b, keys), "left").select(*(own[c] for c in own.columns), "peer_reference", "n_peers")
    reference = F.coalesce("own_reference", F.when(F.col("n_peers") >= least_peers, F.col("peer_reference")))
    ratio = F.col(value) / F.nullif(reference, F.lit(0.0))
    verdict = F.when(ratio.isNull(), "unknown").when(ratio > factor, "implausible").when(ratio <= tiny, "likely larger unit").otherwise("plausible")
    return peers.withColumns({"plausibility_ratio": ratio, "plausibility": verdict})


def yoy_anomalies(df: DataFrame, entity: str, period: str, measures: Sequence[str], threshold: float = 0.4) -> DataFrame:
    """Moves from the period before of more than a share, one row for each measure."""
    long = df.unpivot([entity, period], list(measures), "metric", "value")
    w = Window.partitionBy(entity, "metric").orderBy(period)
    steps = long.withColumns({"before": F.lag("value").over(w), "_p": F.lag(period).over(w)})
    change = F.col("value") / F.nullif("before", F.lit(0.0)) - 1
    return steps.where(F.col("_p") == F.col(period) - 1).withColumn("change", change).where(F.abs("change") > threshold).drop("_p")


def flag_rows(df: DataFrame, flags: str, details: Mapping[str, str]) -> DataFrame:
    """One row for each packed flag, with its explanation."""
    return clean.unpack_flags(df, flags).withColumn("detail", clean.mapped(F.col("flag"), details, F.lit("no explanation")))


def unmapped(facts: DataFrame, known: DataFrame, key: str, unit: str) -> DataFrame:
    """Keys outside the catalogue, with how often they occur and in which units."""
    return facts.join(known, key, "left_anti").groupBy(key).agg(F.count("*").alias("n_facts"), F.array_join(F.sort_array(F.collect_set(unit)), ",").alias("units"))


def shares_by_code(df: DataFrame, entity: str, code: str, value: str) -> DataFrame:
    """Share of each code in its entity, its division (first two characters), and which one is the largest."""
    sums = df.groupBy(entity, code).agg(F.sum(value).alias("total"))
    w = Window.partitionBy(entity)
    return sums.withColumns({
        "division": F.substring(code, 1, 2), "share": F.col("total") / F.nullif(F.sum("total").over(w), F.lit(0)),
        "is_primary": F.dense_rank().over(w.orderBy(F.col("total").desc(), F.col(code))) == 1,
    })


def peer_benchmark(df: DataFrame, group: Sequence[str], kpis: Sequence[str]) -> DataFrame:
    """Number, quartiles and range of each measure in each group."""
    long = df.unpivot(list(group), list(kpis), "kpi", "value").where("value is not null")
    q = quantiles(long, [*group, "kpi"], "value", [0.25, 0.5, 0.75])
    ends = long.groupBy(*group, "kpi").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    keys = [*group, "kpi"]
    out = q.join(ends, same(q, ends, keys)).select(*(q[c] for c in keys), "n", F.col("q").alias("_q"), "low", "high")
    return out.select(*group, "kpi", "n", *(F.get("_q", F.lit(i)).alias(c) for i, c in enumerate(("p25", "median", "p75"))), "low", "high")


def best_values(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key, with the number of rows that competed."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return pick_one(df.withColumn("n_competing", n), keys, order).drop("_nth")


def classify_restatement(original: Column, restated: Column, lower_is_better: Column) -> dict[str, Column]:
    """Class of a change between first and later value, and whether it flatters. The order of the cases is the rule."""
    ratio = restated / F.nullif(original, F.lit(0.0))
    change = F.abs(ratio - 1)
    label = (
        F.when(original.isNull() & restated.isNull(), "no value").when(original.isNull(), "added later").when(restated.isNull(), "withdrawn")
        .when(original == restated, "no change").when(original == 0, "from zero")
        .when(clean.is_scale_error(ratio, F.lit(False)), "scale error").when(change <= 0.01, "rounding").when(change <= 0.05, "small").when(change <= 0.5, "material")
        .otherwise("large")
    )
    compared = original.isNotNull() & restated.isNotNull()
    return {"change": ratio - 1, "classification": label, "is_compared": compared, "flatters": F.when(compared, F.when(lower_is_better, restated < original).otherwise(restated > original))}


def quality_score(df: DataFrame, keys: Sequence[str], group: Sequence[str], parts: Mapping[str, float], cuts: Sequence[tuple[float, str]] = ((85.0, "A"), (70.0, "B"), (55.0, "C")), least_parts: int = 3, top: int = 3, least: int = 5) -> DataFrame:
    """Weighted mean of the parts that are there (weights made up to 1) times 100, a grade, the rank in its group where
    that is large enough, and the parts that cost most."""
    total = clean.reweighted_mean([F.col(c) for c in parts], list(parts.values()), least_parts) * 100
    scored = df.withColumn("score", total)
    grade = F.lit("D")
    for cut, label in reversed(cuts):
        grade = F.when(F.col("score") >= cut, label).otherwise(grade)
    lost = F.array(*(F.struct((-(1 - F.col(c)) * w).alias("lost"), F.lit(c).alias("part")) for c, w in parts.items()))
    reasons = F.slice(F.array_sort(F.filter(lost, lambda s: s["lost"] < -1e-12)), 1, top)
    has = F.col("score").isNotNull()
    n = F.count("score").over(Window.partitionBy(*group))
    place = F.rank().over(Window.partitionBy(*group, has).orderBy(F.col("score").desc()))
    return scored.withColumns({
        "grade": F.when(has, grade).otherwise("insufficient_data"), "group_n": n, "place": F.when(has & (n >= least), place),
        "reasons": F.nullif(F.array_join(F.transform(reasons, lambda s: s["part"]), "|"), F.lit("")),
    }).select(*keys, *parts, "score", "grade", "group_n", "place", "reasons")
