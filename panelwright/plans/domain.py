"""Queries of normalisation, the star schema, scores and public tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import aggregate as agg
from ..operators import domain as dom
from ..operators import stats
from ..operators import window as win
from .bindings import CUSTOMER_YEAR, SUPPLIER_YEAR, customer_year, r6, supplier_year, table
from .questions import _PAIRS, _RESTATED_SQL, _SHARES, _restated, restatement_pairs
from .registry import query

# ---------------------------------------------------------------- normalisation


@query("h01_facts_with_context", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, o_custkey, o_orderdate, p_type, s_nationkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey")
def h01(spark, sf):
    x, o, p, s = (table(spark, sf, t) for t in ("lineitem", "orders", "part", "supplier"))
    x = x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    j = x.join(o.select("o_orderkey", "o_custkey", "o_orderdate"), x["l_orderkey"] == o["o_orderkey"]).drop("o_orderkey")
    j = j.join(p.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey", "left")
    return j.join(s.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey", "left")


_ROLES = """SELECT o_orderkey, make_date(year(o_orderdate), 4, 1) AS ms, make_date(year(o_orderdate) + 1, 3, 31) AS me,
CASE WHEN o_orderkey % 6 < 3 THEN make_date(year(o_orderdate) - CAST(o_orderkey % 6 AS INT), 4, 1) END AS s, CASE WHEN o_orderkey % 6 < 3 THEN make_date(year(o_orderdate) + 1 - CAST(o_orderkey % 6 AS INT), 3, 31) END AS e,
CASE o_orderkey % 6 WHEN 3 THEN make_date(year(o_orderdate) + 1, 3, 31) WHEN 4 THEN make_date(year(o_orderdate), 3, 31) WHEN 5 THEN make_date(year(o_orderdate), 1, 1) END AS i FROM orders"""


@query("h02_assign_period_role", f"""SELECT o_orderkey, CASE WHEN s = ms AND e = me THEN 'CY' WHEN e = ms - INTERVAL 1 DAY THEN 'PY' WHEN e = ms - INTERVAL 1 YEAR - INTERVAL 1 DAY THEN 'PY2' WHEN i = me THEN 'INSTANT_CY' WHEN i = ms - INTERVAL 1 DAY THEN 'INSTANT_PY' ELSE 'OTHER' END AS period_role FROM ({_ROLES.replace(" AS INT)", " AS INTEGER)")})""")
def h02(spark, sf):
    rows = spark.sql(_ROLES.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf, "orders"))
    return dom.assign_period_role(rows, "s", "e", "i", "ms", "me").select("o_orderkey", "period_role")


@query("h03_rank_revisions", "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS revision_rank, count(*) OVER (PARTITION BY o_custkey, year(o_orderdate)) AS n_revisions, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS is_latest FROM orders")
def h03(spark, sf):
    o = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    return dom.rank_revisions(o, ["o_custkey", "y"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select("o_orderkey", "revision_rank", "n_revisions", "is_latest")


@query("h04_infer_unit", SUPPLIER_YEAR + """SELECT a.entity, a.period, CASE WHEN a.entity % 4 = 0 THEN 'text' WHEN b.entity IS NOT NULL THEN 'matched in next report' WHEN a.entity % 3 = 0 THEN 'companion' ELSE 'default' END AS unit_source
FROM p a LEFT JOIN p b ON b.entity = a.entity AND b.period = a.period + 1 AND abs(b.original / nullif(a.restated, 0) - 1) <= 0.05""")
def h04(spark, sf):
    p = supplier_year(spark, sf).select("entity", "period", "original", "restated")
    later = p.select("entity", (F.col("period") - 1).alias("period"), F.col("original").alias("_next"))
    near = F.abs(F.col("_next") / F.nullif("restated", F.lit(0.0)) - 1) <= 0.05
    source = F.when(F.col("entity") % 4 == 0, "text").when(near, "matched in next report").when(F.col("entity") % 3 == 0, "companion").otherwise("default")
    return p.join(later, ["entity", "period"], "left").select("entity", "period", source.alias("unit_source"))


_SLIPPED = "turnover / CASE WHEN (entity + period) % 23 = 0 THEN 1e5 WHEN (entity + period) % 29 = 0 THEN 1e6 ELSE 1.0 END"


@query("h05_infer_scale", SUPPLIER_YEAR + f""", v AS (SELECT entity, period, {_SLIPPED} AS value FROM p), m AS (SELECT a.entity, a.period, a.value, median(CASE WHEN b.value >= 1e5 THEN b.value END) AS reference FROM v a LEFT JOIN v b ON a.entity = b.entity AND a.period <> b.period GROUP BY ALL),
f AS (SELECT *, CASE WHEN value < 1e5 AND value > 0 AND reference IS NOT NULL THEN (SELECT min({{'fit': abs(log10(value * s / reference)), 'scale': s}}) FROM (VALUES (1e7::DOUBLE), (1e6), (1e5)) c(s)) END AS best FROM m)
SELECT entity, period, round(reference, 6) AS reference, CASE WHEN best.fit <= log10(4) THEN best.scale END AS scale, round(value * coalesce(CASE WHEN best.fit <= log10(4) THEN best.scale END, 1), 2) AS corrected,
CASE WHEN best IS NULL OR best.fit > log10(4) THEN NULL WHEN best.fit <= log10(1.5) THEN 'high' WHEN best.fit <= log10(2.5) THEN 'medium' ELSE 'low' END AS confidence FROM f""")
def h05(spark, sf):
    v = supplier_year(spark, sf).select("entity", "period", F.expr(_SLIPPED).alias("value"))
    return dom.infer_scale(v, "entity", "period", "value", below=1e5).select("entity", "period", r6("reference").alias("reference"), "scale", F.round("corrected", 2).alias("corrected"), "confidence")


_UNITS = [("ECONOMY", "INR", 1.0), ("SMALL", "INR", 1e5), ("LARGE", "percent", 1.0), ("PROMO", "tCO2e", 1e-3)]
_RAWV = "CASE p_partkey % 6 WHEN 0 THEN concat(CAST(p_size AS STRING), ',500') WHEN 1 THEN '0.25' WHEN 2 THEN 'N/A' WHEN 3 THEN concat('P', CAST(p_size AS STRING), 'D') WHEN 4 THEN 'about ten' ELSE CAST(p_size AS STRING) END"


@query("h06_normalise_values", f"""WITH u(unit_label_raw, unit_std, multiplier) AS (VALUES {", ".join(map(str, _UNITS))}), f AS (SELECT p_partkey, p_type, {_RAWV.replace("STRING", "VARCHAR")} AS t FROM part),
n AS (SELECT *, TRY_CAST(nullif(regexp_extract(t, '^P([0-9]+(?:\\.[0-9]+)?)D$', 1), '') AS DOUBLE) AS d, TRY_CAST(regexp_replace(t, '[,\\s]', '', 'g') AS DOUBLE) AS x, t = 'N/A' AS na FROM f LEFT JOIN u ON p_type = unit_label_raw),
m AS (SELECT *, coalesce(d, x) AS number, unit_std = 'percent' AND abs(coalesce(d, x)) <= 1 AS pct FROM n)
SELECT p_partkey, round(CASE WHEN pct THEN number * 100 ELSE number * coalesce(multiplier, 1) END, 6) AS value, nullif(concat_ws('|', CASE WHEN unit_label_raw IS NULL THEN 'unknown_unit' END, CASE WHEN pct THEN 'fraction_to_percent' END, CASE WHEN coalesce(multiplier <> 1, false) AND NOT coalesce(pct, false) THEN 'unit_converted' END, CASE WHEN d IS NOT NULL THEN 'iso_duration_parsed' END, CASE WHEN na THEN 'not_applicable' END, CASE WHEN number IS NULL AND NOT na THEN 'not_a_number' END), '') AS flags FROM m""")
def h06(spark, sf):
    facts = table(spark, sf, "part").select("p_partkey", "p_type", F.expr(_RAWV).alias("raw_value"))
    units = spark.createDataFrame(_UNITS, "unit_label_raw string, unit_std string, multiplier double")
    return dom.normalise_values(facts, units, unit="p_type").select("p_partkey", r6("value").alias("value"), "flags")


@query("h07_allowed_breakdowns", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N' OR l_linestatus = 'F'")
def h07(spark, sf):
    key = F.when(F.col("l_returnflag") == "N", "").otherwise(F.concat(F.lit("Flag="), "l_returnflag", F.when(F.col("l_linestatus") == "O", "|Status=O").otherwise("")))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", key.alias("k"))
    return dom.allowed_breakdowns(rows, "k", F.array(F.lit("Flag"))).drop("k")


@query("h08_enrich_materiality", SUPPLIER_YEAR + "SELECT entity, period, name, peer, CASE WHEN sector IN ('ASIA', 'EUROPE') THEN true WHEN sector = 'AFRICA' THEN false END AS is_material FROM p")
def h08(spark, sf):
    rules = spark.createDataFrame([("ASIA", True), ("EUROPE", True), ("AFRICA", False)], "sector string, is_material boolean")
    return supplier_year(spark, sf).join(F.broadcast(rules), "sector", "left").select("entity", "period", "name", "peer", "is_material")


_ODD = "intensity * CASE WHEN entity % 19 = 0 AND period = 1997 THEN 1e4 WHEN entity % 11 = 0 AND period = 1998 THEN 1e-6 ELSE 1.0 END"


@query("h09_unit_plausibility", SUPPLIER_YEAR + f""", v AS (SELECT entity, period, sector, {_ODD} AS value FROM p), g AS (SELECT sector, period, median(value) AS peer, count(DISTINCT entity) FILTER (WHERE value IS NOT NULL) AS n FROM v GROUP BY ALL),
m AS (SELECT a.entity, a.period, a.sector, a.value, median(b.value) AS own FROM v a LEFT JOIN v b ON a.entity = b.entity AND a.period <> b.period GROUP BY ALL), r AS (SELECT m.*, value / nullif(coalesce(own, CASE WHEN n >= 3 THEN peer END), 0) AS ratio FROM m JOIN g USING (sector, period))
SELECT entity, period, round(ratio, 6) AS ratio, CASE WHEN ratio IS NULL THEN 'unknown' WHEN ratio > 100 THEN 'implausible' WHEN ratio <= 1e-4 THEN 'likely larger unit' ELSE 'plausible' END AS plausibility FROM r""")
def h09(spark, sf):
    v = supplier_year(spark, sf).select("entity", "period", "sector", F.expr(_ODD).alias("value"))
    return dom.unit_plausibility(v, "entity", "period", ["sector", "period"], "value").select("entity", "period", r6("plausibility_ratio").alias("ratio"), "plausibility")


@query("h10_exceptions_log", SUPPLIER_YEAR + "SELECT entity, period, 'zero events' AS kind FROM p WHERE events = 0 UNION ALL SELECT entity, period, 'no emissions' FROM p WHERE emissions IS NULL UNION ALL SELECT entity, period, 'one-sided' FROM p WHERE original IS NULL OR restated IS NULL")
def h10(spark, sf):
    flags = clean.pack_flags([(F.col("events") == 0, "zero events"), (F.col("emissions").isNull(), "no emissions"), (F.col("original").isNull() | F.col("restated").isNull(), "one-sided")])
    return clean.unpack_flags(supplier_year(spark, sf).select("entity", "period", flags.alias("f")), "f", "kind").select("entity", "period", "kind")


@query("h11_scale_error_suspects", SUPPLIER_YEAR + "SELECT a.entity, a.period, round(b.restated * CASE WHEN a.entity % 9 = 0 THEN 1000 ELSE 1 END / nullif(a.original, 0), 6) AS ratio FROM p a JOIN p b ON a.entity = b.entity AND b.period = a.period + 1 WHERE coalesce(b.restated * CASE WHEN a.entity % 9 = 0 THEN 1000 ELSE 1 END / nullif(a.original, 0) NOT BETWEEN 0.01 AND 100, false)")
def h11(spark, sf):
    p = supplier_year(spark, sf).select("entity", "period", "original", "restated")
    later = p.select("entity", (F.col("period") - 1).alias("period"), (F.col("restated") * F.when(F.col("entity") % 9 == 0, 1000).otherwise(1)).alias("_later"))
    ratio = clean.safe_ratio(F.col("_later"), F.col("original"))
    return p.join(later, ["entity", "period"]).where(clean.is_scale_error(ratio, F.lit(False))).select("entity", "period", r6(ratio).alias("ratio"))


@query("h12_yoy_anomalies", SUPPLIER_YEAR + """, l AS (SELECT entity, period, metric, value FROM p UNPIVOT INCLUDE NULLS (value FOR metric IN (turnover, emissions, women_share))), y AS (SELECT *, lag(value) OVER w AS before, lag(period) OVER w AS bp FROM l WINDOW w AS (PARTITION BY entity, metric ORDER BY period))
SELECT entity, period, metric, round(value / nullif(before, 0) - 1, 6) AS change FROM y WHERE bp = period - 1 AND abs(value / nullif(before, 0) - 1) > 0.4""")
def h12(spark, sf):
    return dom.yoy_anomalies(supplier_year(spark, sf).select("entity", "period", "turnover", "emissions", "women_share"), "entity", "period", ["turnover", "emissions", "women_share"]).select("entity", "period", "metric", r6("change").alias("change"))


@query("h13_flag_rows", SUPPLIER_YEAR + "SELECT entity, period, flag, CASE flag WHEN 'event' THEN 'two events or more' WHEN 'undisclosed' THEN 'fewer than two disclosures' END AS detail FROM (SELECT entity, period, unnest(string_split(concat_ws('|', CASE WHEN has_event THEN 'event' END, CASE WHEN NOT disclosed THEN 'undisclosed' END), '|')) AS flag FROM p) WHERE flag <> ''")
def h13(spark, sf):
    p = supplier_year(spark, sf).withColumn("flags", clean.pack_flags([(F.col("has_event"), "event"), (~F.col("disclosed"), "undisclosed")]))
    return dom.flag_rows(p, "flags", {"event": "two events or more", "undisclosed": "fewer than two disclosures"}).select("entity", "period", "flag", "detail")


@query("h14_unmapped_concepts", "SELECT l_partkey AS partkey, count(*) AS n_facts, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS units FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45) GROUP BY 1")
def h14(spark, sf):
    facts = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("partkey"), "l_returnflag")
    return dom.unmapped(facts, table(spark, sf, "part").where("p_size <= 45").select(F.col("p_partkey").alias("partkey")), "partkey", "l_returnflag")


@query("h15_resolve_names", "SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS period, arg_max(trim(regexp_replace(lower(o_orderpriority), '\\s+', ' ', 'g')), o_orderkey) AS best_name, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS symbols FROM orders GROUP BY ALL")
def h15(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("period")).agg(F.max_by(clean.normalise_text_key(F.col("o_orderpriority")), "o_orderkey").alias("best_name"), agg.joined_set(F.col("o_orderstatus"), ",").alias("symbols"))


@query("h16_shares_by_code", """SELECT l_suppkey, p_brand, total, left(p_brand, 2) AS division, round(total::DOUBLE / nullif(sum(total) OVER (PARTITION BY l_suppkey), 0), 6) AS share, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY total DESC, p_brand) = 1 AS is_primary
FROM (SELECT l_suppkey, p_brand, CAST(sum(l_quantity) AS BIGINT) AS total FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)""")
def h16(spark, sf):
    x = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return dom.shares_by_code(x.join(p, "l_partkey"), "l_suppkey", "p_brand", "q").withColumn("share", r6("share"))


# ---------------------------------------------------------------- star schema and scores


@query("j01_dim_entity", SUPPLIER_YEAR + """, e AS (SELECT entity, any_value(name) AS name, any_value(peer) AS peer, any_value(sector) AS sector, min(period) AS first_period, max(period) AS last_period, count(*) AS n_periods FROM p GROUP BY 1)
SELECT *, CASE WHEN count(*) OVER (PARTITION BY peer) >= 5 THEN peer ELSE sector END AS ranking_group FROM e""")
def j01(spark, sf):
    e = supplier_year(spark, sf).groupBy("entity").agg(*(F.min(c).alias(c) for c in ("name", "peer", "sector")), F.min("period").alias("first_period"), F.max("period").alias("last_period"), F.count("*").alias("n_periods"))
    return e.withColumn("ranking_group", F.when(F.count("*").over(Window.partitionBy("peer")) >= 5, F.col("peer")).otherwise(F.col("sector")))


@query("j02_scd2_from_runs", """WITH c AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR lag(event_type) OVER w IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, CAST(sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS version FROM c), v AS (SELECT user_id, version, event_type, min(ts) AS valid_from, count(*) AS n_rows FROM r GROUP BY ALL)
SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY version) AS valid_to, version = max(version) OVER (PARTITION BY user_id) AS is_current FROM v""")
def j02(spark, sf):
    return win.scd2_from_runs(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], ["event_type"])


@query("j03_entity_year", CUSTOMER_YEAR + """SELECT entity, period, CAST(ntile(3) OVER (PARTITION BY sector, period ORDER BY turnover_cents, entity) AS INTEGER) AS size_band, coalesce(lag(disclosed) OVER w <> disclosed, false) AS boundary_break, coalesce(period - lag(period) OVER w > 1, false) AS gap_before FROM p WINDOW w AS (PARTITION BY entity ORDER BY period)""")
def j03(spark, sf):
    w = Window.partitionBy("entity").orderBy("period")
    return customer_year(spark, sf).select("entity", "period", F.ntile(3).over(Window.partitionBy("sector", "period").orderBy("turnover_cents", "entity")).alias("size_band"), F.coalesce(F.lag("disclosed").over(w) != F.col("disclosed"), F.lit(False)).alias("boundary_break"), F.coalesce(F.col("period") - F.lag("period").over(w) > 1, F.lit(False)).alias("gap_before"))


@query("j04_dim_metric", "SELECT p_type AS metric, min(p_name) AS label, CASE WHEN p_type LIKE '%O%' THEN 'amount' ELSE 'ratio' END AS unit_type, CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS sort_order FROM part GROUP BY p_type")
def j04(spark, sf):
    m = table(spark, sf, "part").groupBy(F.col("p_type").alias("metric")).agg(F.min("p_name").alias("label"))
    return m.withColumns({"unit_type": F.when(F.col("metric").like("%O%"), "amount").otherwise("ratio"), "sort_order": F.row_number().over(Window.orderBy("metric"))})


@query("j05_provider_dimension_and_bridge", "WITH b AS (SELECT DISTINCT p_name AS provider, l_suppkey FROM lineitem JOIN part ON p_partkey = l_partkey) SELECT provider, l_suppkey, count(*) OVER (PARTITION BY provider) AS n_entities FROM b")
def j05(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("provider"))
    bridge = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct().join(p, "l_partkey").select("provider", "l_suppkey").distinct()
    return bridge.join(bridge.groupBy("provider").agg(F.count("*").alias("n_entities")), "provider")


@query("j06_best_values", "SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS period, o_orderkey, o_totalprice, n AS n_competing FROM (SELECT *, count(*) OVER w AS n, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderstatus = 'F' DESC, o_orderdate DESC, o_orderkey DESC) AS k FROM orders WINDOW w AS (PARTITION BY o_custkey, year(o_orderdate))) WHERE k = 1")
def j06(spark, sf):
    o = table(spark, sf, "orders").withColumn("period", F.year("o_orderdate"))
    return dom.best_values(o, ["o_custkey", "period"], [(F.col("o_orderstatus") == "F").desc(), F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select("o_custkey", "period", "o_orderkey", "o_totalprice", "n_competing")


@query("j07_panel_kpis", CUSTOMER_YEAR + "SELECT entity, period, turnover, round(emissions, 6) AS emissions, round(intensity, 6) AS intensity, round(renewable_share, 6) AS renewable_share, round(women_share, 6) AS women_share, round(pay_gap, 6) AS pay_gap, disclosed, has_event, CASE WHEN NOT (events = 0 AND n_lines > 6) THEN events END AS events, nullif(concat_ws('|', CASE WHEN events = 0 AND n_lines > 6 THEN 'events' END), '') AS zeros_dropped FROM p")
def j07(spark, sf):
    p = clean.null_implausible_zeros(customer_year(spark, sf), {"events": F.col("n_lines") > 6})
    return p.select("entity", "period", "turnover", *(r6(c).alias(c) for c in ("emissions", "intensity", "renewable_share", "women_share", "pay_gap")), "disclosed", "has_event", "events", "zeros_dropped")


_BENCH = ["turnover", "emissions", "renewable_share"]


@query("j08_peer_benchmark", SUPPLIER_YEAR + "SELECT sector, period, kpi, count(*) AS n, round(quantile_cont(value, 0.25), 6) AS p25, round(median(value), 6) AS median, round(quantile_cont(value, 0.75), 6) AS p75, round(min(value), 6) AS low, round(max(value), 6) AS high FROM (SELECT * FROM p UNPIVOT (value FOR kpi IN (turnover, emissions, renewable_share))) GROUP BY ALL")
def j08(spark, sf):
    b = dom.peer_benchmark(supplier_year(spark, sf).select("sector", "period", *_BENCH), ["sector", "period"], _BENCH)
    return b.select("sector", "period", "kpi", "n", *(r6(c).alias(c) for c in ("p25", "median", "p75", "low", "high")))


@query("j09_group_percentile", SUPPLIER_YEAR + """, l AS (SELECT * FROM p UNPIVOT INCLUDE NULLS (value FOR kpi IN (turnover, emissions, renewable_share))), c AS (SELECT *, count(value) OVER (PARTITION BY peer, period, kpi) AS n, percent_rank() OVER (PARTITION BY peer, period, kpi, value IS NULL ORDER BY value) AS k FROM l)
SELECT entity, period, kpi, n AS group_n, CASE WHEN value IS NOT NULL AND n >= 5 THEN round(100 * k, 6) END AS percentile, CASE WHEN value IS NULL THEN 'no value' WHEN n < 5 THEN 'group under 5' END AS percentile_null_reason FROM c""")
def j09(spark, sf):
    long = supplier_year(spark, sf).unpivot(["entity", "period", "peer"], _BENCH, "kpi", "value")
    return win.group_percentile(long, ["peer", "period", "kpi"], "value").select("entity", "period", "kpi", "group_n", r6("percentile").alias("percentile"), "percentile_null_reason")


@query("j10_indicator_disclosure", """SELECT doc_id, bool_or(length(trim(regexp_replace(part, '<[^>]*>|&nbsp;', ' ', 'g'))) > 0 AND NOT regexp_full_match(lower(trim(part)), '(na|n\\.a\\.?|n/a|not applicable|-+)')) AS disclosed, count(*) AS n_elements FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS part FROM documents) GROUP BY 1""")
def j10(spark, sf):
    parts = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("part"))
    answer = (F.length(clean.strip_html(F.col("part"))) > 0) & ~clean.is_na_text(F.col("part"))
    return parts.groupBy("doc_id").agg(F.bool_or(answer).alias("disclosed"), F.count("*").alias("n_elements"))


@query("j11_assurance_score", """WITH m AS (SELECT l_suppkey, count(*) FILTER (WHERE l_tax = 0) AS reasonable, count(*) FILTER (WHERE l_tax = 0.01) AS limited, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_suppkey, CASE WHEN reasonable > n * 0.12 THEN 'reasonable' WHEN limited > n * 0.1 THEN 'limited' ELSE 'none' END AS level, least(1.0, CASE WHEN reasonable > n * 0.12 THEN 0.9 WHEN limited > n * 0.1 THEN 0.5 ELSE 0.0 END + CASE WHEN n > 600 THEN 0.2 ELSE 0.0 END)::DOUBLE AS score FROM m""")
def j11(spark, sf):
    m = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_tax") == 0).alias("r"), F.count_if(F.col("l_tax") == 0.01).alias("l"), F.count("*").alias("n"))
    reasonable, limited = F.col("r") > F.col("n") * 0.12, F.col("l") > F.col("n") * 0.1
    points = F.when(reasonable, 0.9).when(limited, 0.5).otherwise(0.0) + F.when(F.col("n") > 600, 0.2).otherwise(0.0)
    return m.select("l_suppkey", F.when(reasonable, "reasonable").when(limited, "limited").otherwise("none").alias("level"), F.least(F.lit(1.0), F.round(points, 6)).alias("score"))


_PARTS_SQL = """, q AS (SELECT *, renewable_share / 100 AS completeness, CASE WHEN entity % 13 <> 0 THEN 1 - events::DOUBLE / n_lines END AS consistency, CASE WHEN period > 1995 THEN untaxed::DOUBLE / n_lines END AS stability, CASE WHEN disclosed THEN 0.5::DOUBLE ELSE 0 END AS assurance FROM p)
"""
_PARTS = {"completeness": 0.3, "consistency": 0.3, "stability": 0.2, "assurance": 0.2}


def _components(spark, sf):
    n = F.col("n_lines").cast("double")
    return supplier_year(spark, sf).withColumns({
        "completeness": F.col("renewable_share") / 100, "consistency": F.when(F.col("entity") % 13 != 0, 1 - F.col("events") / n),
        "stability": F.when(F.col("period") > 1995, F.col("untaxed") / n), "assurance": F.when(F.col("disclosed"), 0.5).otherwise(0.0),
    })


@query("j12_quality_components", SUPPLIER_YEAR + _PARTS_SQL + "SELECT entity, period, round(completeness, 6) AS completeness, round(consistency, 6) AS consistency, round(stability, 6) AS stability, assurance FROM q")
def j12(spark, sf):
    return _components(spark, sf).select("entity", "period", *(r6(c).alias(c) for c in ("completeness", "consistency", "stability")), "assurance")


def _weighted(weights) -> str:
    return "(" + " + ".join(f"coalesce({c} * {w}::DOUBLE, 0)" for c, w in weights.items()) + ") / nullif(" + " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE {w}::DOUBLE END" for c, w in weights.items()) + ", 0)"


@query("j13_quality_score", SUPPLIER_YEAR + _PARTS_SQL + f""", s AS (SELECT *, CASE WHEN (completeness IS NOT NULL)::INT + (consistency IS NOT NULL)::INT + (stability IS NOT NULL)::INT + (assurance IS NOT NULL)::INT >= 3 THEN {_weighted(_PARTS)} * 100 END AS score FROM q)
SELECT entity, period, round(score, 6) AS score, CASE WHEN score IS NULL THEN 'insufficient_data' WHEN score >= 85 THEN 'A' WHEN score >= 70 THEN 'B' WHEN score >= 55 THEN 'C' ELSE 'D' END AS grade, count(score) OVER (PARTITION BY sector, period) AS group_n FROM s""")
def j13(spark, sf):
    return dom.quality_score(_components(spark, sf), ["entity", "period"], ["sector", "period"], _PARTS).select("entity", "period", r6("score").alias("score"), "grade", "group_n")


@query("j14_restatements", _PAIRS + "SELECT entity, period, round(change, 6) AS change, classification, is_compared, flatters, coalesce(flatters AND classification IN ('material', 'large'), false) AS red_flag FROM r")
def j14(spark, sf):
    return restatement_pairs(supplier_year(spark, sf)).select("entity", "period", r6("change").alias("change"), "classification", "is_compared", "flatters", F.coalesce(F.col("flatters") & F.col("classification").isin("material", "large"), F.lit(False)).alias("red_flag"))


@query("j15_restatement_summary", _PAIRS + f"SELECT level, level_key, {_RESTATED_SQL} FROM (SELECT 'overall' AS level, 'all' AS level_key, * FROM r UNION ALL SELECT 'peer', peer, * FROM r UNION ALL SELECT 'period', CAST(period AS VARCHAR), * FROM r UNION ALL SELECT 'flattering', peer, * FROM r WHERE flatters) GROUP BY ALL")
def j15(spark, sf):
    level = lambda name, key: {"level": F.lit(name), "level_key": key}
    pairs = restatement_pairs(supplier_year(spark, sf)).withColumn("flatters", F.coalesce("flatters", F.lit(False)))
    blocks = [(level("overall", F.lit("all")), None), (level("peer", F.col("peer")), None), (level("period", F.col("period").cast("string")), None), (level("flattering", F.col("peer")), F.col("flatters"))]
    large = F.col("classification").isin("material", "large")
    sums = {"n_compared": F.count_if("is_compared"), "n_material": F.count_if(large), "n_flattering": F.count_if("flatters")}
    return agg.roll_up(pairs, ["peer", "period", "flatters"], blocks, sums, "entity", {"n_entities": large})


@query("j16_suppress_small_groups", SUPPLIER_YEAR + "SELECT peer, n, CASE WHEN n >= 5 THEN share END AS share, CASE WHEN n < 5 THEN 'fewer than 5' END AS null_reason FROM (SELECT peer, count(DISTINCT entity) AS n, round(count(*) FILTER (WHERE disclosed)::DOUBLE / count(*), 6) AS share FROM p GROUP BY 1)")
def j16(spark, sf):
    g = supplier_year(spark, sf).groupBy("peer").agg(F.countDistinct("entity").alias("n"), r6(F.count_if("disclosed") / F.count("*")).alias("share"))
    return agg.suppress_small_groups(g, ["share"], "n")


@query("j17_concentration", _SHARES + "SELECT entity, period, CAST(position AS INTEGER) AS position, count(*) OVER (PARTITION BY period) AS n_entities, round(share, 6) AS share, round(running, 6) AS cumulative_share, position <= 5 AS in_top5 FROM s")
def j17(spark, sf):
    c = win.concentration(supplier_year(spark, sf), "entity", "turnover_cents", "period")
    return c.select("entity", "period", "position", "n_entities", r6("share").alias("share"), r6("cumulative_share").alias("cumulative_share"), (F.col("position") <= 5).alias("in_top5"))


@query("j18_public_percentile", SUPPLIER_YEAR + """, c AS (SELECT *, count(renewable_share) OVER (PARTITION BY sector, period) AS n FROM p) SELECT name, period, CASE WHEN renewable_share IS NOT NULL AND n >= 5 THEN CAST(rank() OVER (PARTITION BY sector, period, renewable_share IS NULL ORDER BY renewable_share DESC) AS INTEGER) END AS place, n AS of_n FROM c""")
def j18(spark, sf):
    has = F.col("renewable_share").isNotNull()
    p = supplier_year(spark, sf).withColumn("of_n", F.count("renewable_share").over(Window.partitionBy("sector", "period")))
    place = F.rank().over(Window.partitionBy("sector", "period", has).orderBy(F.col("renewable_share").desc()))
    return p.select("name", "period", F.when(has & (F.col("of_n") >= 5), place).alias("place"), "of_n")


@query("j20_project_public", SUPPLIER_YEAR + "SELECT name, period, turnover, disclosed FROM p")
def j20(spark, sf):
    public = {"name", "period", "turnover", "disclosed"}
    p = supplier_year(spark, sf)
    return p.select(*(c for c in p.columns if c in public))


@query("j22_indicator_rates", "SELECT event_type, round(count(*) FILTER (WHERE value > 50)::DOUBLE / count(*), 6) AS rate, count(DISTINCT user_id) AS n_users, count(*) FILTER (WHERE value > 50) > 0 AND count(*) FILTER (WHERE value <= 50) > 0 AS informative FROM events GROUP BY 1")
def j22(spark, sf):
    over = F.col("value") > 50
    return table(spark, sf, "events").groupBy("event_type").agg(r6(F.count_if(over) / F.count("*")).alias("rate"), F.countDistinct("user_id").alias("n_users"), ((F.count_if(over) > 0) & (F.count_if(~over) > 0)).alias("informative"))


_OTHER = {"completeness": 0.25, "consistency": 0.25, "stability": 0.25, "assurance": 0.25}


@query("j23_weight_sensitivity", SUPPLIER_YEAR + _PARTS_SQL + f""", s AS (SELECT entity, period, round({_weighted(_PARTS)}, 9) AS a, round({_weighted(_OTHER)}, 9) AS b FROM q), k AS (SELECT *, rank() OVER (PARTITION BY period ORDER BY a) + (count(*) OVER (PARTITION BY period, a) - 1) / 2.0::DOUBLE AS ra, rank() OVER (PARTITION BY period ORDER BY b) + (count(*) OVER (PARTITION BY period, b) - 1) / 2.0::DOUBLE AS rb FROM s)
SELECT period, round(corr(ra, rb), 6) AS spearman, count(*) FILTER (WHERE abs(ra - rb) >= 5) AS movers, max(abs(ra - rb)) AS largest_move FROM k GROUP BY 1""")
def j23(spark, sf):
    c = _components(spark, sf)
    s = c.select("entity", "period", *(F.round(clean.reweighted_mean([F.col(x) for x in w], list(w.values()), 1), 9).alias(n) for n, w in (("a", _PARTS), ("b", _OTHER))))
    k = stats.with_ranks(s, ["period"], {"ra": "a", "rb": "b"})
    move = F.abs(F.col("ra") - F.col("rb"))
    return k.groupBy("period").agg(r6(F.corr("ra", "rb")).alias("spearman"), F.count_if(move >= 5).alias("movers"), F.max(move).alias("largest_move"))


@query("j24_staging_quality_summary", "SELECT flag, n FROM (SELECT count(*) FILTER (WHERE l_tax = 0) AS zero_tax, count(*) FILTER (WHERE l_discount = 0) AS no_discount, count(*) FILTER (WHERE l_quantity > 49) AS full_lots, count(*) AS all_rows FROM lineitem) UNPIVOT (n FOR flag IN (zero_tax, no_discount, full_lots, all_rows))")
def j24(spark, sf):
    one = table(spark, sf, "lineitem").agg(F.count_if(F.col("l_tax") == 0).alias("zero_tax"), F.count_if(F.col("l_discount") == 0).alias("no_discount"), F.count_if(F.col("l_quantity") > 49).alias("full_lots"), F.count("*").alias("all_rows"))
    return agg.unpivot(one, [], ["zero_tax", "no_discount", "full_lots", "all_rows"], "flag", "n")
