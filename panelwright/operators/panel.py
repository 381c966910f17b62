"""Operators that build the panel's dimensions, columns and scores from rows and rule tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean
from .window import pick_one


def dim_entity(rows: DataFrame, entity: str, period: str, current: Sequence[str], codes: DataFrame, peer: str, sector: str, least: int = 5, top: int = 3, low: float = 0.6, part: float = 0.15) -> DataFrame:
    """One row for each entity: its latest identity, its coverage, its largest codes as text, whether it is a conglomerate
    (no code holds `low` of it, or three hold `part` each), and the group it is ranked in: its peers if they are enough,
    else its sector. codes: entity, code, total, share."""
    base = rows.groupBy(entity).agg(F.max_by(F.struct(*current, peer, sector), period).alias("_now"), F.min(period).alias("first_period"), F.max(period).alias("last_period"), F.count("*").alias("n_periods"))
    nth = codes.withColumn("_n", F.row_number().over(Window.partitionBy(entity).orderBy(F.col("total").desc(), "code")))
    largest = F.array_sort(F.collect_list(F.when(F.col("_n") <= top, F.struct("_n", "code"))))  # `top` at most
    mixed = nth.groupBy(entity).agg(F.array_join(F.transform(largest, lambda s: s["code"]), ", ").alias("top_codes"), ((F.max("share") < low) | (F.count_if(F.col("share") >= part) >= 3)).alias("is_conglomerate"))
    out = base.select(entity, "_now.*", "first_period", "last_period", "n_periods").join(mixed, entity, "left")
    sizes = out.groupBy(peer).agg(F.count("*").alias("_peers"))
    return out.join(sizes, peer).withColumn("ranking_group", F.when(F.col("_peers") >= least, F.col(peer)).otherwise(F.col(sector))).drop("_peers")


def entity_year(panel: DataFrame, months: DataFrame, entity: str, period: str, group: Sequence[str], size: str, boundary: str, event: str, bands: int = 3) -> DataFrame:
    """Of each entity and period: months covered, the factor that makes a year of them, the size band in its group, and
    breaks: of the boundary, of an event that is new, and of periods left out. months: entity, period, months."""
    w = Window.partitionBy(entity).orderBy(period)
    band = F.ntile(bands).over(Window.partitionBy(*group).orderBy(size, entity))
    no = F.lit(False)
    return panel.join(months, [entity, period], "left").withColumns({
        "annual_factor": 12 / F.nullif("months", F.lit(0)), "size_band": band,
        "boundary_break": F.coalesce(F.lag(boundary).over(w) != F.col(boundary), no), "event_break": F.coalesce(F.col(event) & ~F.lag(event).over(w), no),
        "gap_before": F.coalesce(F.col(period) - F.lag(period).over(w) > 1, no),
    })


def dim_provider(named: DataFrame, name: str, provider_id: str, entity: str) -> tuple[DataFrame, DataFrame]:
    """Providers whose names have one key are one, under the id that they have most often (the smallest of equal ones);
    and the bridge of providers and entities."""
    keyed = named.select(clean.name_key(F.col(name)).alias("provider"), F.col(provider_id).alias("provider_id"), F.col(entity).alias(entity))
    often = keyed.groupBy("provider", "provider_id").agg(F.count("*").alias("n_rows"))
    best = pick_one(often, ["provider"], [F.col("n_rows").desc(), F.col("provider_id")]).select("provider", "provider_id")
    bridge = keyed.select("provider", entity).distinct()
    return best.join(bridge.groupBy("provider").agg(F.count("*").alias("n_entities")), "provider"), bridge


def panel_kpis(values: DataFrame, keys: Sequence[str], metrics: Sequence[str], ratios: Mapping[str, tuple[str, str, float]], annual: Sequence[str] = (), months: str | None = None, zeros: Mapping[str, Column] | None = None) -> DataFrame:
    """From long values (keys, metric, value) to a wide row: zeros that can't be become null (zeros_dropped names them), a
    ratio is numerator / denominator * factor, and `annual` metrics also stand as 12 months' worth."""
    wide = values.groupBy(*keys).agg(*(F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics))
    wide = clean.null_implausible_zeros(wide, zeros) if zeros else wide
    derived = {name: factor * clean.safe_ratio(F.col(n), F.col(d)) for name, (n, d, factor) in ratios.items()}
    return wide.withColumns(derived | ({f"{m}_annual": F.col(m) * 12 / F.nullif(months, F.lit(0)) for m in annual} if months else {}))


def infer_unit(df: DataFrame, value: str, next_value: str, next_unit: str, text_unit: str, companion: str, default: str, tolerance: float = 0.05) -> DataFrame:
    """unit, unit_source and unit_conflict. By priority: the next report's unit where it restates the value within the
    tolerance, unless this report's text names another one (the text wins); the text's; the companion's; the default."""
    matched = F.coalesce(F.abs(F.col(next_value) / F.nullif(value, F.lit(0.0)) - 1) <= tolerance, F.lit(False)) & F.col(next_unit).isNotNull()
    conflict = matched & F.col(text_unit).isNotNull() & (F.col(text_unit) != F.col(next_unit))
    source = F.when(conflict, "text over next report").when(matched, "matched in next report").when(F.col(text_unit).isNotNull(), "text").when(F.col(companion).isNotNull(), "companion").otherwise("default")
    unit = F.when(conflict, F.col(text_unit)).when(matched, F.col(next_unit)).otherwise(F.coalesce(text_unit, companion, F.lit(default)))
    return df.withColumns({"unit": unit, "unit_source": source, "unit_conflict": F.coalesce(conflict, F.lit(False))})


#: Why a value isn't the one that was filed.
REASONS = {"scale_corrected": "brought to the scale of the entity's other values", "override": "replaced by an approved value", "unit_converted": "converted to the standard unit", "fraction_to_percent": "a fraction where percent is expected", "iso_duration_parsed": "days of a duration", "unknown_unit": "the unit is in no rule", "not_applicable": "marked as not applicable", "not_a_number": "no number in the text"}


def corrected_values(df: DataFrame, key: Sequence[str], scales: DataFrame, overrides: DataFrame) -> DataFrame:
    """Normalised values (value, flags) with corrections: scales (key, scale) for values of a wrong scale, then approved
    overrides (key, override), which stand whatever was filed. flags tell both, reasons says each flag in words."""
    keys = list(key)
    joined = df.join(scales, keys, "left").join(overrides, keys, "left")
    scaled, over = F.col("scale").isNotNull() & F.col("value").isNotNull(), F.col("override").isNotNull()
    flags = F.nullif(F.concat_ws("|", "flags", F.when(scaled, "scale_corrected"), F.when(over, "override")), F.lit(""))
    known = F.create_map(*(F.lit(x) for kv in REASONS.items() for x in kv))
    out = joined.withColumns({"value": F.coalesce("override", F.when(scaled, F.col("value") * F.col("scale")).otherwise(F.col("value"))), "flags": flags}).drop("scale", "override")
    return out.withColumn("reasons", F.array_join(F.transform(F.split("flags", r"\|"), lambda f: F.coalesce(F.try_element_at(known, f), f)), "; "))


def exceptions_log(flagged: Sequence[tuple[str, DataFrame, str]], details: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """One typed list (source, key, kind, detail) of all that was flagged, inferred or overridden. flagged: (source, rows
    with flags, key), a row for each flag; details: (source, kind, rows, detail column), rows with a column `key`."""
    out = None
    parts = [clean.unpack_flags(df.select(F.col(key).cast("string").alias("key"), "flags"), "flags", "kind").select(F.lit(source).alias("source"), "key", "kind", clean.mapped(F.col("kind"), REASONS).alias("detail")) for source, df, key in flagged]
    parts += [df.where(F.col(detail).isNotNull()).select(F.lit(source).alias("source"), F.col("key").cast("string").alias("key"), F.lit(kind).alias("kind"), F.col(detail).cast("string").alias("detail")) for source, kind, df, detail in details]
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def scale_error_suspects(values: DataFrame, entity: Sequence[str], period: str, value: str, order: Sequence[Column], last: Sequence[Column], comparative: str) -> DataFrame:
    """The first value filed for a period against what the last report of the next period gives for it, where the two are
    whole powers apart. `order` and `last` pick the first and the last report; `comparative` holds the later figure."""
    keys = [*entity, period]
    first = pick_one(values, keys, order).select(*keys, F.col(value).alias("first_value"))
    later = pick_one(values, keys, last).select(*entity, (F.col(period) - 1).alias(period), F.col(comparative).alias("later_value"))
    pairs = first.join(later, keys).withColumn("ratio", clean.safe_ratio(F.col("later_value"), F.col("first_value")))
    return pairs.where(clean.is_scale_error(F.col("ratio"), F.lit(False)))


def resolve_names(filings: DataFrame, entity: str, period: str, name: str, order: str, listing: DataFrame, code: str, pattern: str) -> DataFrame:
    """The name of each entity and period: the latest filing's, cleaned; else the listing's (entity, listed_name); with all
    symbols, and the code where it is valid."""
    cleaned = filings.withColumn("_clean", F.nullif(clean.title_case_if_upper(clean.clean_name(F.col(name))), F.lit("")))
    own = cleaned.groupBy(entity, period).agg(F.max_by("_clean", F.when(F.col("_clean").isNotNull(), F.col(order))).alias("_own"), F.array_join(F.array_sort(F.collect_set("symbol")), ",").alias("symbols"), F.max(clean.valid_code(F.col(code), pattern)).alias("code"))
    return own.join(listing, entity, "left").select(entity, period, F.coalesce("_own", "listed_name").alias("name"), F.when(F.col("_own").isNotNull(), "filing").when(F.col("listed_name").isNotNull(), "listing").alias("name_source"), "symbols", "code")


def indicator_disclosure(answers: DataFrame, entity: Sequence[str], element: str, text: str, indicators: DataFrame) -> DataFrame:
    """An indicator (indicators: element, indicator) is disclosed if any of its elements has an answer that says something:
    "not applicable" doesn't, a zero does."""
    says = (F.length(clean.strip_html(F.col(text))) > 0) & ~clean.is_na_text(F.col(text))
    return answers.join(indicators, F.col(element) == indicators["element"]).groupBy(*entity, "indicator").agg(F.coalesce(F.bool_or(says), F.lit(False)).alias("disclosed"), F.count("*").alias("n_elements"))


def assurance_score(marks: DataFrame, reasonable: str, limited: str, wide: str, total: str, points: Mapping[str, float], share: float = 0.1) -> DataFrame:
    """Level and scope from counts of marks; points for the level and a bonus for a full scope, 1 at most."""
    part = lambda c: clean.safe_ratio(F.col(c), F.col(total))
    level = F.when(part(reasonable) > share, "reasonable").when(part(limited) > share, "limited").otherwise("none")
    scope = F.when(part(wide) >= 0.5, "full").when(F.col(wide) > 0, "part").otherwise("none")
    earned = F.coalesce(clean.mapped(level, {k: str(v) for k, v in points.items()}).cast("double"), F.lit(0.0)) + F.when((scope == "full") & (level != "none"), points["bonus"]).otherwise(0.0)
    return marks.withColumns({"level": level, "scope": scope, "score": F.least(F.lit(1.0), F.round(earned, 6))})


def quality_components(df: DataFrame, halves: Sequence[tuple[str, str]], checks: Mapping[str, tuple[Column, Column]], reasons: Sequence[tuple[Column, str, float]], assurance: Column) -> DataFrame:
    """completeness: the mean of the halves (disclosed, required) that apply; consistency: one less the share of failed
    among applicable checks (name: applies, fails); stability: the value of the first reason that holds, else 1, and that
    reason; assurance."""
    parts = [clean.safe_ratio(F.col(d), F.col(r)) for d, r in halves]
    applies = sum((F.when(a, 1).otherwise(0) for a, _ in checks.values()), F.lit(0))
    fails = sum((F.when(a & F.coalesce(f, F.lit(False)), 1).otherwise(0) for a, f in checks.values()), F.lit(0))
    stability, reason = F.lit(1.0), F.lit(None).cast("string")
    for cond, label, value in reversed(reasons):
        hit = F.coalesce(cond, F.lit(False))
        stability, reason = F.when(hit, value).otherwise(stability), F.when(hit, label).otherwise(reason)
    failed = F.array_join(F.array_compact(F.array(*(F.when(a & F.coalesce(f, F.lit(False)), name) for name, (a, f) in checks.items()))), "|")
    return df.withColumns({
        "completeness": clean.reweighted_mean(parts, [1.0] * len(parts), 1), "consistency": 1 - fails / F.nullif(applies, F.lit(0)), "failed": F.nullif(failed, F.lit("")),
        "stability": stability, "stability_reason": reason, "assurance": assurance,
    })


def explained(pairs: DataFrame, notes: DataFrame, keys: Sequence[str], text: str, words: str, changed: Column) -> DataFrame:
    """Whether a note on a change tells of it: explained, unexplained, or no change to explain. notes: keys and text."""
    hits = notes.groupBy(*keys).agg(F.bool_or(F.coalesce(F.col(text).rlike(rf"(?i)\b(?:{words})\b"), F.lit(False))).alias("_told"), F.count("*").alias("n_notes"))
    told = F.coalesce("_told", F.lit(False))
    return pairs.join(hits, list(keys), "left").withColumns({"explanation": F.when(~F.coalesce(changed, F.lit(False)), "nothing to explain").when(told, "explained").otherwise("unexplained"), "n_notes": F.coalesce("n_notes", F.lit(0))}).drop("_told")


def grid_with_counts(df: DataFrame, row: str, column: str, values: Sequence, value: str, least: int = 5) -> DataFrame:
    """Groups by periods: the median and the number behind it in each cell, small cells empty, a row `All` over everything."""
    both = df.withColumn(row, F.explode(F.array(F.col(row), F.lit("All"))))
    cells = both.groupBy(row).pivot(column, list(values)).agg(F.median(value).alias("value"), F.count(value).alias("n"))
    return cells.withColumns({f"{v}_value": F.when(F.col(f"{v}_n") >= least, F.round(F.col(f"{v}_value"), 6)) for v in values} | {f"{v}_n": F.coalesce(F.col(f"{v}_n"), F.lit(0)) for v in values})
