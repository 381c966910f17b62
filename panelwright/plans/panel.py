"""Queries of dimensions, panel columns, score parts and their look-ups, with rule tables that come from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import domain as dom
from ..operators import panel as pan
from ..operators import window as win
from .bindings import CUSTOMER_YEAR, SUPPLIER_YEAR, customer_year, r6, supplier_year, table
from .domain import _RAWV, _SLIPPED, _UNITS
from .questions import _PAIRS, _YOY, restatement_pairs, yoy_confidence
from .registry import SQL, query

_CODES = ", c AS (SELECT *, total::DOUBLE / sum(total) OVER (PARTITION BY entity) AS share FROM (SELECT l_suppkey AS entity, p_brand AS code, CAST(sum(l_quantity) AS BIGINT) AS total FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL))"


def _codes(spark, sf):
    x = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("entity"), "l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("code"))
    return dom.shares_by_code(x.join(p, "l_partkey"), "entity", "code", "q")


@query("j01_dim_entity_identity", SUPPLIER_YEAR + _CODES + """, e AS (SELECT entity, arg_max(disclosed, period) AS disclosed, arg_max(peer, period) AS peer, arg_max(sector, period) AS sector, min(period) AS first_period, max(period) AS last_period, count(*) AS n_periods FROM p GROUP BY 1),
k AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY total DESC, code) AS n FROM c), t AS (SELECT entity, string_agg(code, ', ' ORDER BY n) FILTER (WHERE n <= 3) AS top_codes, max(share) < 0.6 OR count(*) FILTER (WHERE share >= 0.15) >= 3 AS is_conglomerate FROM k GROUP BY 1)
SELECT e.*, top_codes, is_conglomerate, CASE WHEN count(*) OVER (PARTITION BY peer) >= 5 THEN peer ELSE sector END AS ranking_group FROM e LEFT JOIN t USING (entity)""")
def j01(spark, sf):
    return pan.dim_entity(supplier_year(spark, sf), "entity", "period", ["disclosed"], _codes(spark, sf), "peer", "sector")


_MONTHS = ", m AS (SELECT o_custkey AS entity, CAST(year(o_orderdate) AS INTEGER) AS period, CAST(max(month(o_orderdate)) - min(month(o_orderdate)) + 1 AS INTEGER) AS months FROM orders GROUP BY ALL)"


def _months(spark, sf):
    month = F.month("o_orderdate")
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("period")).agg((F.max(month) - F.min(month) + 1).alias("months"))


@query("j03_entity_year_annualised", CUSTOMER_YEAR + _MONTHS + """SELECT entity, period, months, round(turnover * 12 / months, 4) AS turnover_annual, CAST(ntile(3) OVER (PARTITION BY sector, period ORDER BY turnover_cents, entity) AS INTEGER) AS size_band, coalesce(lag(disclosed) OVER w <> disclosed, false) AS boundary_break,
coalesce(has_event AND NOT lag(has_event) OVER w, false) AS event_break, coalesce(period - lag(period) OVER w > 1, false) AS gap_before FROM p LEFT JOIN m USING (entity, period) WINDOW w AS (PARTITION BY entity ORDER BY period)""")
def j03(spark, sf):
    y = pan.entity_year(customer_year(spark, sf), _months(spark, sf), "entity", "period", ["sector", "period"], "turnover_cents", "disclosed", "has_event")
    return y.select("entity", "period", "months", F.round(F.col("turnover") * 12 / F.col("months"), 4).alias("turnover_annual"), "size_band", "boundary_break", "event_break", "gap_before")


@query("j04_dim_metric_requirement", "SELECT p_type AS metric, min(p_name) AS label, CASE WHEN p_type LIKE '%O%' THEN 'amount' ELSE 'ratio' END AS unit_type, CAST(row_number() OVER (PARTITION BY CASE WHEN p_type LIKE '%O%' THEN 'amount' ELSE 'ratio' END ORDER BY p_type) AS INTEGER) AS sort_order, count(*) FILTER (WHERE p_size > 49) AS n_required, CASE WHEN count(*) FILTER (WHERE p_size > 49) > 0 THEN 'essential' ELSE 'leadership' END AS requirement FROM part GROUP BY p_type")
def j04(spark, sf):
    p = table(spark, sf, "part")
    m = p.groupBy(F.col("p_type").alias("metric")).agg(F.min("p_name").alias("label")).withColumn("unit_type", F.when(F.col("metric").like("%O%"), "amount").otherwise("ratio"))
    required = p.where("p_size > 49").groupBy(F.col("p_type").alias("metric")).agg(F.count("*").alias("n_required"))
    m = m.join(required, "metric", "left").withColumn("n_required", F.coalesce("n_required", F.lit(0)))
    return m.withColumns({"sort_order": F.row_number().over(win.Window.partitionBy("unit_type").orderBy("metric")), "requirement": F.when(F.col("n_required") > 0, "essential").otherwise("leadership")})


@query("j05_provider_dimension", """WITH k AS (SELECT replace(p_name, ' ', '_') AS provider, p_brand AS provider_id, l_suppkey FROM lineitem JOIN part ON p_partkey = l_partkey), n AS (SELECT provider, provider_id, count(*) AS n FROM k GROUP BY ALL)
SELECT provider, provider_id, (SELECT count(DISTINCT l_suppkey) FROM k WHERE k.provider = b.provider) AS n_entities FROM (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY n DESC, provider_id) AS i FROM n) b WHERE i = 1""")
def j05(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.upper("p_name").alias("name"), "p_brand")
    return pan.dim_provider(table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").join(p, "l_partkey"), "name", "p_brand", "l_suppkey")[0]


_METRICS = ["turnover_cents", "emissions_t", "green_t", "staff", "women", "events", "untaxed", "first_cents", "later_cents", "n_lines"]
#: Name: numerator, denominator, factor.
_KPIS = {
    "intensity": ("emissions_t", "turnover_cents", 1e8), "green_percent": ("green_t", "emissions_t", 100.0), "women_percent": ("women", "staff", 100.0), "women_per_line": ("women", "n_lines", 1.0),
    "events_per_line": ("events", "n_lines", 1.0), "events_per_staff": ("events", "staff", 1000.0), "untaxed_percent": ("untaxed", "n_lines", 100.0), "untaxed_per_event": ("untaxed", "events", 1.0),
    "turnover_per_staff": ("turnover_cents", "staff", 0.01), "turnover_per_line": ("turnover_cents", "n_lines", 0.01), "turnover_per_event": ("turnover_cents", "events", 0.01), "emissions_per_staff": ("emissions_t", "staff", 1.0),
    "emissions_per_line": ("emissions_t", "n_lines", 1.0), "green_per_turnover": ("green_t", "turnover_cents", 1e8), "green_per_staff": ("green_t", "staff", 1.0), "staff_per_line": ("staff", "n_lines", 1.0),
    "staff_per_turnover": ("staff", "turnover_cents", 1e8), "first_percent": ("first_cents", "turnover_cents", 100.0), "later_percent": ("later_cents", "turnover_cents", 100.0), "restated_ratio": ("later_cents", "first_cents", 1.0),
}
_ANNUAL = ["turnover_cents", "emissions_t", "events"]


@query("j07_panel_kpis_wide", CUSTOMER_YEAR + _MONTHS + ", z AS (SELECT p.* EXCLUDE (events, intensity), CASE WHEN NOT (events = 0 AND n_lines > 6) THEN events END AS events, CASE WHEN events = 0 AND n_lines > 6 THEN 'events' END AS zeros_dropped, months FROM p LEFT JOIN m USING (entity, period)) SELECT entity, period, zeros_dropped, " + ", ".join(f"round({f}::DOUBLE * {n} / nullif({d}, 0), 6) AS {k}" for k, (n, d, f) in _KPIS.items()) + ", " + ", ".join(f"round({m}::DOUBLE * 12 / months, 6) AS {m}_annual" for m in _ANNUAL) + " FROM z")
def j07(spark, sf):
    panel = customer_year(spark, sf).join(_months(spark, sf), ["entity", "period"], "left")
    long = panel.select("entity", "period", *(F.col(m).cast("double").alias(m) for m in (*_METRICS, "months"))).unpivot(["entity", "period"], [*_METRICS, "months"], "metric", "value")
    wide = pan.panel_kpis(long, ["entity", "period"], [*_METRICS, "months"], _KPIS, _ANNUAL, "months", {"events": F.col("n_lines") > 6})
    return wide.select("entity", "period", "zeros_dropped", *(r6(c).alias(c) for c in (*_KPIS, *(f"{m}_annual" for m in _ANNUAL))))


_NAMED = ", t AS (SELECT l_suppkey AS entity, CAST(year(l_shipdate) AS INTEGER) AS period, max(p_type) FILTER (WHERE l_tax = 0 AND l_discount < 0.02) AS text_unit, max(p_type) FILTER (WHERE l_discount = 0) AS companion FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)"


def _named(spark, sf):
    x = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("entity"), F.year("l_shipdate").alias("period"), "l_partkey", "l_tax", "l_discount").join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    return x.groupBy("entity", "period").agg(F.max(F.when((F.col("l_tax") == 0) & (F.col("l_discount") < 0.02), F.col("p_type"))).alias("text_unit"), F.max(F.when(F.col("l_discount") == 0, F.col("p_type"))).alias("companion"))


_UNIT_SQL = SUPPLIER_YEAR + _NAMED + """, a AS (SELECT p.entity, p.period, p.restated, t.text_unit, t.companion, n.original AS next_value, nt.text_unit AS next_unit FROM p LEFT JOIN t USING (entity, period) LEFT JOIN p n ON n.entity = p.entity AND n.period = p.period + 1 LEFT JOIN t nt ON nt.entity = p.entity AND nt.period = p.period + 1),
b AS (SELECT *, coalesce(abs(next_value / nullif(restated, 0) - 1) <= 0.3, false) AND next_unit IS NOT NULL AS matched FROM a), u AS (SELECT entity, period, CASE WHEN matched AND text_unit <> next_unit THEN text_unit WHEN matched THEN next_unit ELSE coalesce(text_unit, companion, 'ECONOMY') END AS unit,
CASE WHEN matched AND text_unit <> next_unit THEN 'text over next report' WHEN matched THEN 'matched in next report' WHEN text_unit IS NOT NULL THEN 'text' WHEN companion IS NOT NULL THEN 'companion' ELSE 'default' END AS unit_source, coalesce(matched AND text_unit <> next_unit, false) AS unit_conflict FROM b)
"""


def _unit_sources(spark, sf):
    p, t = supplier_year(spark, sf).select("entity", "period", "original", "restated"), _named(spark, sf)
    before = (F.col("period") - 1).alias("period")
    rows = p.join(t, ["entity", "period"], "left").join(p.select("entity", before, F.col("original").alias("next_value")), ["entity", "period"], "left").join(t.select("entity", before, F.col("text_unit").alias("next_unit")), ["entity", "period"], "left")
    return pan.infer_unit(rows, "restated", "next_value", "next_unit", "text_unit", "companion", "ECONOMY", 0.3).select("entity", "period", "unit", "unit_source", "unit_conflict")


@query("h04_infer_unit_by_priority", _UNIT_SQL + "SELECT * FROM u")
def h04(spark, sf):
    return _unit_sources(spark, sf)


_H06 = f"(SELECT n.p_partkey, coalesce(o.v, CASE WHEN s.k IS NOT NULL AND n.value IS NOT NULL THEN n.value * 1000 ELSE n.value END) AS value, nullif(concat_ws('|', n.flags, CASE WHEN s.k IS NOT NULL AND n.value IS NOT NULL THEN 'scale_corrected' END, CASE WHEN o.v IS NOT NULL THEN 'override' END), '') AS flags FROM ({SQL['h06_normalise_values']}) n LEFT JOIN (SELECT p_partkey AS k FROM part WHERE p_size = 7) s ON s.k = n.p_partkey LEFT JOIN (SELECT p_partkey AS k, p_retailprice AS v FROM part WHERE p_brand = 'Brand#13' AND p_size < 9) o ON o.k = n.p_partkey)"


def _corrected(spark, sf):
    part = table(spark, sf, "part")
    facts = part.select("p_partkey", "p_type", F.expr(_RAWV).alias("raw_value"))
    units = spark.createDataFrame(_UNITS, "unit_label_raw string, unit_std string, multiplier double")
    values = dom.normalise_values(facts, units, unit="p_type").select("p_partkey", r6("value").alias("value"), "flags")
    scales = part.where("p_size = 7").select("p_partkey", F.lit(1000.0).alias("scale"))
    return pan.corrected_values(values, ["p_partkey"], scales, part.where("p_brand = 'Brand#13' AND p_size < 9").select("p_partkey", F.col("p_retailprice").alias("override")))


_SAY = " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in pan.REASONS.items())


@query("h06_corrected_values", f"SELECT p_partkey, round(value, 4) AS value, flags, array_to_string(list_transform(string_split(flags, '|'), lambda f: CASE f {_SAY} ELSE f END), '; ') AS reasons FROM {_H06}")
def h06(spark, sf):
    return _corrected(spark, sf).select("p_partkey", F.round("value", 4).alias("value"), "flags", "reasons")


@query("h10_exceptions_list", f"SELECT 'fact' AS source, key, kind, CASE kind {_SAY} END AS detail FROM (SELECT CAST(p_partkey AS VARCHAR) AS key, unnest(string_split(flags, '|')) AS kind FROM {_H06}) UNION ALL SELECT 'panel', entity || '/' || period, 'inferred scale', confidence FROM ({SQL['h05_infer_scale']}) WHERE confidence IS NOT NULL UNION ALL SELECT 'panel', entity || '/' || period, 'inferred unit', unit FROM ({_UNIT_SQL} SELECT * FROM u) WHERE unit_source <> 'text'")
def h10(spark, sf):
    key = F.concat("entity", F.lit("/"), "period").alias("key")
    scales = dom.infer_scale(supplier_year(spark, sf).select("entity", "period", F.expr(_SLIPPED).alias("value")), "entity", "period", "value", below=1e5).select(key, "confidence")
    units = _unit_sources(spark, sf).where("unit_source <> 'text'").select(key, "unit")
    return pan.exceptions_log([("fact", _corrected(spark, sf), "p_partkey")], [("panel", "inferred scale", scales, "confidence"), ("panel", "inferred unit", units, "unit")])


@query("h11_suspects_by_revision", """WITH o AS (SELECT *, year(o_orderdate) AS y, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS f, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) AS l FROM orders),
r AS (SELECT a.o_custkey, CAST(a.y AS INTEGER) AS period, b.o_totalprice * CASE WHEN b.o_orderstatus = 'P' THEN 1000 ELSE 1 END / nullif(a.o_totalprice, 0) AS ratio FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND b.y = a.y + 1 AND a.f = 1 AND b.l = 1) SELECT o_custkey, period, round(ratio, 6) AS ratio FROM r WHERE ratio > 100 OR ratio < 0.01""")
def h11(spark, sf):
    o = table(spark, sf, "orders").withColumns({"period": F.year("o_orderdate"), "later": F.col("o_totalprice") * F.when(F.col("o_orderstatus") == "P", 1000).otherwise(1)})
    s = pan.scale_error_suspects(o, ["o_custkey"], "period", "o_totalprice", [F.col("o_orderdate"), F.col("o_orderkey")], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], "later")
    return s.select("o_custkey", "period", r6("ratio").alias("ratio"))


@query("h15_resolve_names_by_source", """WITH f AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS period, o_orderkey, o_orderstatus AS symbol, CASE o_orderkey % 4 WHEN 0 THEN c_name WHEN 1 THEN c_name || ' Limited' WHEN 2 THEN NULL ELSE c_name END AS name, CASE WHEN o_custkey < 100 THEN 'C' || o_custkey END AS code FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
g AS (SELECT o_custkey, period, arg_max(name, o_orderkey) FILTER (WHERE name IS NOT NULL) AS own, string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols, max(code) AS code FROM f GROUP BY ALL)
SELECT o_custkey, period, coalesce(own, c_mktsegment) AS name, CASE WHEN own IS NOT NULL THEN 'filing' WHEN c_mktsegment IS NOT NULL THEN 'listing' END AS name_source, symbols, code FROM g LEFT JOIN customer ON c_custkey = o_custkey""")
def h15(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    k = F.col("o_orderkey") % 4
    name = F.when(k == 0, F.upper("c_name")).when(k == 1, F.concat("c_name", F.lit(" (formerly x)  LTD."))).when(k == 3, F.concat(F.lit("  "), "c_name"))
    f = table(spark, sf, "orders").join(c, "o_custkey", "left").select("o_custkey", F.year("o_orderdate").alias("period"), "o_orderkey", F.col("o_orderstatus").alias("symbol"), name.alias("name"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("code"))
    return pan.resolve_names(f, "o_custkey", "period", "name", "o_orderkey", c.select("o_custkey", F.col("c_mktsegment").alias("listed_name")), "code", "^C[0-9]{1,2}$")


@query("j10_indicators_by_element", """WITH e AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS part, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents), x AS (SELECT *, CASE i % 3 WHEN 2 THEN 'social' ELSE 'climate' END AS indicator FROM e)
SELECT doc_id, indicator, bool_or(length(trim(regexp_replace(part, '<[^>]*>|&nbsp;', ' ', 'g'))) > 0 AND NOT regexp_full_match(lower(trim(part)), '(na|n\\.a\\.?|n/a|not applicable|-+)')) AS disclosed, count(*) AS n_elements FROM x GROUP BY ALL""")
def j10(spark, sf):
    parts = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "part")).withColumn("e", F.col("i") % 3)
    indicators = spark.createDataFrame([(0, "climate"), (1, "climate"), (2, "social")], "element int, indicator string")
    return pan.indicator_disclosure(parts, ["doc_id"], "e", "part", indicators)


@query("j11_assurance_with_scope", """WITH m AS (SELECT l_suppkey, count(*) FILTER (WHERE l_tax = 0) AS r, count(*) FILTER (WHERE l_tax = 0.01) AS l, count(*) FILTER (WHERE l_linestatus = 'F') AS w, count(*) AS n FROM lineitem GROUP BY 1),
v AS (SELECT *, CASE WHEN r::DOUBLE / n > 0.1 THEN 'reasonable' WHEN l::DOUBLE / n > 0.1 THEN 'limited' ELSE 'none' END AS level, CASE WHEN w::DOUBLE / n >= 0.5 THEN 'full' WHEN w > 0 THEN 'part' ELSE 'none' END AS scope FROM m)
SELECT l_suppkey, level, scope, round(least(1.0::DOUBLE, CASE level WHEN 'reasonable' THEN 0.9 WHEN 'limited' THEN 0.5 ELSE 0 END::DOUBLE + CASE WHEN scope = 'full' AND level <> 'none' THEN 0.2 ELSE 0 END::DOUBLE), 6) AS score FROM v""")
def j11(spark, sf):
    m = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_tax") == 0).alias("r"), F.count_if(F.col("l_tax") == 0.01).alias("l"), F.count_if(F.col("l_linestatus") == "F").alias("w"), F.count("*").alias("n"))
    return pan.assurance_score(m, "r", "l", "w", "n", {"reasonable": 0.9, "limited": 0.5, "bonus": 0.2}).select("l_suppkey", "level", "scope", "score")


@query("j12_components_with_reasons", SUPPLIER_YEAR + """, y AS (SELECT *, lag(turnover) OVER w AS before, lag(period) OVER w AS bp FROM p WINDOW w AS (PARTITION BY entity ORDER BY period)),
s AS (SELECT entity, period, (coalesce(green_t::DOUBLE / nullif(emissions_t, 0), 0) + coalesce(women::DOUBLE / nullif(staff, 0), 0)) / nullif(CASE WHEN green_t::DOUBLE / nullif(emissions_t, 0) IS NULL THEN 0 ELSE 1 END + CASE WHEN women::DOUBLE / nullif(staff, 0) IS NULL THEN 0 ELSE 1 END, 0) AS completeness,
CASE WHEN original IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN emissions IS NOT NULL THEN 1 ELSE 0 END + 1 AS applies, CASE WHEN original IS NOT NULL AND coalesce(restated < original / 2, false) THEN 1 ELSE 0 END AS f1, CASE WHEN emissions IS NOT NULL AND coalesce(green_t * 2 < emissions, false) THEN 1 ELSE 0 END AS f2, CASE WHEN events = 0 THEN 1 ELSE 0 END AS f3,
CASE WHEN bp <> period - 1 THEN 'gap' WHEN abs(turnover / nullif(before, 0) - 1) > 0.4 THEN 'anomaly' WHEN original IS NULL OR restated IS NULL THEN 'one-sided' END AS stability_reason, disclosed FROM y)
SELECT entity, period, round(completeness, 6) AS completeness, round(1 - (f1 + f2 + f3)::DOUBLE / applies, 6) AS consistency, nullif(concat_ws('|', CASE WHEN f1 = 1 THEN 'halved' END, CASE WHEN f2 = 1 THEN 'little green' END, CASE WHEN f3 = 1 THEN 'no events' END), '') AS failed, CASE stability_reason WHEN 'gap' THEN 0.0 WHEN 'anomaly' THEN 0.5 WHEN 'one-sided' THEN 0.25 ELSE 1.0 END::DOUBLE AS stability, stability_reason, CASE WHEN disclosed THEN 0.5 ELSE 0.0 END::DOUBLE AS assurance FROM s""")
def j12(spark, sf):
    w = win.Window.partitionBy("entity").orderBy("period")
    p = supplier_year(spark, sf).withColumns({"before": F.lag("turnover").over(w), "bp": F.lag("period").over(w)})
    there = lambda c: F.col(c).isNotNull()
    checks = {"halved": (there("original"), F.col("restated") < F.col("original") / 2), "little green": (there("emissions"), F.col("green_t") * 2 < F.col("emissions")), "no events": (F.lit(True), F.col("events") == 0)}
    moved = F.abs(F.col("turnover") / F.nullif("before", F.lit(0.0)) - 1) > 0.4
    reasons = [(F.col("bp") != F.col("period") - 1, "gap", 0.0), (moved, "anomaly", 0.5), (~there("original") | ~there("restated"), "one-sided", 0.25)]
    c = pan.quality_components(p, [("green_t", "emissions_t"), ("women", "staff")], checks, reasons, F.when(F.col("disclosed"), 0.5).otherwise(0.0))
    return c.select("entity", "period", r6("completeness").alias("completeness"), r6("consistency").alias("consistency"), "failed", "stability", "stability_reason", "assurance")


@query("j14_restatements_explained", _PAIRS + """, d AS (SELECT o_custkey AS entity, CAST(year(o_orderdate) AS INTEGER) AS period, count(*) AS n_notes, bool_or(regexp_matches(o_orderpriority, '(?i)\\b(?:urgent|high)\\b')) AS told FROM orders GROUP BY ALL)
SELECT entity, period, classification, coalesce(n_notes, 0) AS n_notes, CASE WHEN classification NOT IN ('material', 'large') THEN 'nothing to explain' WHEN coalesce(told, false) THEN 'explained' ELSE 'unexplained' END AS explanation FROM r LEFT JOIN d USING (entity, period)""")
def j14(spark, sf):
    notes = table(spark, sf, "orders").select(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("period"), "o_orderpriority")
    pairs = restatement_pairs(supplier_year(spark, sf)).select("entity", "period", "classification")
    return pan.explained(pairs, notes, ["entity", "period"], "o_orderpriority", "urgent|high", F.col("classification").isin("material", "large"))


_J19 = _YOY.replace("CASE WHEN reversal THEN 'one_period_reversal' WHEN", "CASE WHEN reversal THEN 'one_period_reversal' WHEN n_lines < 3 THEN 'inferred_unit' WHEN")


@query("j19_yoy_confidence", _J19 + """, k AS (SELECT * FROM c WHERE entity IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.entity AND year(o_orderdate) = c.period AND o_orderstatus = 'P')), n AS (SELECT *, count(*) FILTER (WHERE status = 'confirmed') OVER (PARTITION BY peer, period) AS n_confirmed FROM k)
SELECT entity, period, round(change, 6) AS change, status, n_confirmed, CASE WHEN status = 'confirmed' AND n_confirmed >= 5 THEN CAST(row_number() OVER (PARTITION BY peer, period, status = 'confirmed' ORDER BY change, entity) AS INTEGER) END AS place FROM n""")
def j19(spark, sf):
    p = customer_year(spark, sf)
    inferred = p.where("n_lines < 3").select("entity", "period")
    eligible = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("entity"))
    excluded = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("period"))
    return yoy_confidence(p, inferred, eligible, excluded).select("entity", "period", r6("change").alias("change"), "status", "n_confirmed", "place")


_YEARS = list(range(1995, 2002))


@query("k13_grid_with_counts", CUSTOMER_YEAR + ", b AS (SELECT sector, period, women_share FROM p UNION ALL SELECT 'All', period, women_share FROM p) SELECT sector, " + ", ".join(f'CASE WHEN count(women_share) FILTER (WHERE period = {y}) >= 5 THEN round(median(women_share) FILTER (WHERE period = {y}), 6) END AS "{y}_value", count(women_share) FILTER (WHERE period = {y}) AS "{y}_n"' for y in _YEARS) + " FROM b GROUP BY 1")
def k13(spark, sf):
    return pan.grid_with_counts(customer_year(spark, sf).select("sector", "period", "women_share"), "sector", "period", _YEARS, "women_share")


@query("k13_best_and_worst_mover", _YOY + "SELECT period, arg_min(entity, (change, entity)) AS best, arg_max(entity, (change, entity)) AS worst, count(*) AS n FROM c WHERE status = 'confirmed' GROUP BY 1")
def k13b(spark, sf):
    c = yoy_confidence(customer_year(spark, sf)).where("status = 'confirmed'")
    place = F.struct("change", "entity")
    return c.groupBy("period").agg(F.min_by("entity", place).alias("best"), F.max_by("entity", place).alias("worst"), F.count("*").alias("n"))
