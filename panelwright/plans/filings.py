"""Queries of whole XML instances, the intake's manifest, star exports, explorations, look-ups and publication checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import checks
from ..operators import lookups as look
from ..operators import window as win
from ..sources import files
from ..sources.instances import parse_instances
from .bindings import CUSTOMER_YEAR, SUPPLIER_YEAR, customer_year, r6, supplier_year, table
from .questions import _PAIRS, _YOY, restatement_pairs, yoy_confidence
from .registry import query

_HEAD = '<x:xbrl xmlns:x="http://www.xbrl.org/2003/instance" xmlns:d="http://xbrl.org/2006/xbrldi" xmlns:link="http://www.xbrl.org/2003/linkbase" xmlns:xlink="http://www.w3.org/1999/xlink" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xmlns:in="urn:in">'


def _filings(spark, sf):
    """An instance for each part. Every third one is UTF-16; every fiftieth is broken off, every 49th has no schema."""
    k = F.col("p_partkey")
    xml = F.concat(
        F.lit(_HEAD), F.when(k % 49 == 0, "").otherwise('<link:schemaRef xlink:href="http://a/2021/in.xsd"/>'),
        F.lit('<x:context id="D"><x:entity><x:identifier scheme="urn:id"> '), "p_brand", F.lit('</x:identifier><x:segment><d:explicitMember dimension="in:ZoneAxis">in:'), "p_type", F.lit('</d:explicitMember><d:typedMember dimension="in:SizeAxis"><in:s>'), F.col("p_size").cast("string"),
        F.lit('</in:s></d:typedMember></x:segment></x:entity><x:period><x:startDate>2020-04-01</x:startDate><x:endDate>2021-03-31</x:endDate></x:period></x:context>'),
        F.lit('<x:context id="I"><x:entity><x:identifier scheme="urn:id">'), "p_brand", F.lit('</x:identifier></x:entity><x:period><x:instant>2021-03-31T00:00:00</x:instant></x:period></x:context>'),
        F.lit('<x:unit id="u1"><x:measure>in:mm</x:measure></x:unit><x:unit id="u2"><x:divide><x:unitNumerator><x:measure>in:t</x:measure><x:measure>in:km</x:measure></x:unitNumerator><x:unitDenominator><x:measure>iso:INR</x:measure></x:unitDenominator></x:divide></x:unit>'),
        F.lit('<in:Size contextRef="D" unitRef="u1" decimals="0">'), F.col("p_size").cast("string"), F.lit('</in:Size><!-- c --><in:Rate contextRef="I" unitRef="u2" id="own">'), F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.lit('</in:Rate><in:Name contextRef="D">'), "p_name",
        F.lit('</in:Name><in:Nil contextRef="D" xsi:nil="1"/><in:PolicyTextBlock contextRef="D">é '), "p_name", F.lit('</in:PolicyTextBlock><in:Long contextRef="D">'), F.when(k % 2 == 0, F.repeat(F.lit("long "), 300)).otherwise("short"),
        F.lit("</in:Long>"), F.when(k % 50 == 0, "<open>").otherwise(""), F.lit("</x:xbrl>"),
    )
    content = F.when(k % 3 == 1, F.encode(xml, "UTF-16")).otherwise(F.encode(xml, "UTF-8"))
    return parse_instances(table(spark, sf, "part").select(k.cast("string").alias("filing_id"), content.alias("content")))


_GOOD = "FROM part WHERE p_partkey % 50 <> 0 AND p_partkey % 49 <> 0"


@query("a05_contexts", f"SELECT CAST(p_partkey AS VARCHAR) AS filing_id, unnest(['D', 'I']) AS context_id, p_brand AS identifier_value, unnest(['duration', 'instant']) AS period_type, unnest([DATE '2020-04-01', NULL]) AS start_date, unnest([DATE '2021-03-31', NULL]) AS end_date, unnest([NULL, DATE '2021-03-31']) AS instant_date, unnest(['SizeAxis=' || p_size || '|ZoneAxis=' || p_type, '']) AS dimension_key, unnest(['typed,explicit', '']) AS member_types {_GOOD}")
def a05_contexts(spark, sf):
    c = _filings(spark, sf)["contexts"]
    return c.select("filing_id", "context_id", "identifier_value", "period_type", "start_date", "end_date", "instant_date", "dimension_key", F.array_join(F.transform("dimensions", lambda d: d["member_type"]), ",").alias("member_types"))


@query("a05_units", f"SELECT CAST(p_partkey AS VARCHAR) AS filing_id, unnest(['u1', 'u2']) AS unit_id, unnest(['mm', 't*km/INR']) AS unit_label, unnest([0, 1])::INTEGER AS n_below {_GOOD}")
def a05_units(spark, sf):
    return _filings(spark, sf)["units"].select("filing_id", "unit_id", "unit_label", F.size("denominator_measures").alias("n_below"))


_FACT_ROWS = f"""(SELECT CAST(p_partkey AS VARCHAR) AS filing_id, p_partkey AS k, unnest(['Size', 'Rate', 'Name', 'Nil', 'PolicyTextBlock', 'Long']) AS concept, unnest(['D', 'I', 'D', 'D', 'D', 'D']) AS context_ref, unnest(['u1', 'u2', NULL, NULL, NULL, NULL]) AS unit_ref,
unnest([CAST(p_size AS VARCHAR), CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR), p_name, NULL, 'é ' || p_name, CASE WHEN p_partkey % 2 = 0 THEN repeat('long ', 300) ELSE 'short' END]) AS raw_value, unnest([1, 2, 3, 4, 5, 6])::INTEGER AS sequence {_GOOD})"""
_ID = "CASE WHEN concept = 'Rate' THEN 'own' ELSE left(sha256(filing_id || '|' || sequence || '|{urn:in}' || concept || '|' || context_ref || '|' || coalesce(unit_ref, '')), 32) END"


@query("a05_facts", f"SELECT filing_id, concept, context_ref, unit_ref, raw_value, concept = 'Nil' AS is_nil, unit_ref IS NOT NULL AS is_numeric, sequence, {_ID} AS fact_id FROM {_FACT_ROWS} WHERE concept <> 'PolicyTextBlock' AND (concept <> 'Long' OR k % 2 <> 0)")
def a05_facts(spark, sf):
    return _filings(spark, sf)["facts"].select("filing_id", "concept", "context_ref", "unit_ref", "raw_value", "is_nil", "is_numeric", "sequence", "fact_id")


@query("a05_text_facts", f"SELECT filing_id, concept, raw_value, {_ID} AS fact_id FROM {_FACT_ROWS} WHERE concept = 'PolicyTextBlock' OR (concept = 'Long' AND k % 2 = 0)")
def a05_text_facts(spark, sf):
    return _filings(spark, sf)["text_facts"].select("filing_id", "concept", "raw_value", "fact_id")


@query("a11_instances_in_quarantine", "SELECT CAST(p_partkey AS VARCHAR) AS filing_id, CASE WHEN p_partkey % 50 = 0 THEN 'ParseError' ELSE 'ValueError' END AS error FROM part WHERE p_partkey % 50 = 0 OR p_partkey % 49 = 0")
def a11(spark, sf):
    return _filings(spark, sf)["errors"]


@query("a13_intake_with_manifest", """WITH f AS (SELECT c_custkey, c_mktsegment || (c_custkey % 400) AS t FROM customer), seen AS (SELECT DISTINCT t FROM f WHERE c_custkey < 40)
SELECT 'F' || c_custkey || '.xml' AS file_name, CASE WHEN t IN (SELECT t FROM seen) THEN 'taken in before' WHEN c_custkey <> min(c_custkey) OVER (PARTITION BY t) THEN 'duplicate' ELSE 'new' END AS status, (row_number() OVER (PARTITION BY t ORDER BY c_custkey))::INTEGER AS nth FROM f""")
def a13(spark, sf):
    c = table(spark, sf, "customer")
    f = c.select(F.concat(F.lit("F"), "c_custkey", F.lit(".xml")).alias("file_name"), "c_custkey", F.concat("c_mktsegment", (F.col("c_custkey") % 400).cast("string")).cast("binary").alias("content"))
    path = files.workspace(spark)
    files.take_in(spark, path, f.where("c_custkey < 40"), ["c_custkey"])  # an earlier run's manifest
    return files.take_in(spark, path, f, ["c_custkey"]).select("file_name", "status", "nth")


@query("a21_star_facts", SUPPLIER_YEAR + "SELECT entity, period, turnover, row_number() OVER (PARTITION BY entity ORDER BY period)::INTEGER AS nth FROM p WHERE period IN (SELECT period FROM p WHERE disclosed GROUP BY 1 HAVING count(*) >= 5)")
def a21(spark, sf):
    p = supplier_year(spark, sf)
    path = files.workspace(spark)
    files.star_export(spark, path, {"facts": p.select("entity", "period", "turnover", "disclosed"), "entities": p.select("entity", "name").distinct()}, "facts", "period", p.where("disclosed").groupBy("period").count().where("count >= 5"))
    facts = spark.read.parquet(f"{path}/facts")
    return facts.select("entity", "period", "turnover", F.row_number().over(Window.partitionBy("entity").orderBy("period")).alias("nth"))


@query("a23_explore_facts_by_year", "SELECT o_orderpriority, " + ", ".join(f'count(*) FILTER (WHERE year(o_orderdate) = {y}) AS "{y}"' for y in range(1995, 2002)) + " FROM orders GROUP BY 1")
def a23a(spark, sf):
    return table(spark, sf, "orders").withColumn("y", F.year("o_orderdate")).groupBy("o_orderpriority").pivot("y", list(range(1995, 2002))).count().na.fill(0)


@query("a23_explore_one_concept", SUPPLIER_YEAR + "SELECT entity, max(turnover) FILTER (WHERE period = 1997) AS y1997, max(turnover) FILTER (WHERE period = 1998) AS y1998 FROM p GROUP BY 1")
def a23b(spark, sf):
    at = lambda y: F.max(F.when(F.col("period") == y, F.col("turnover"))).alias(f"y{y}")
    return supplier_year(spark, sf).groupBy("entity").agg(at(1997), at(1998))


@query("a23_explore_unit_usage", "SELECT p_type, count(*) AS n_facts, count(DISTINCT l_suppkey) AS n_entities FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1")
def a23c(spark, sf):
    x = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    return x.groupBy("p_type").agg(F.count("*").alias("n_facts"), F.countDistinct("l_suppkey").alias("n_entities"))


@query("a23_explore_odd_periods", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'P' WHERE year(l_shipdate) IS DISTINCT FROM year(o_orderdate)")
def a23d(spark, sf):
    o = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("y"))
    x = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.year("l_shipdate").alias("s")).join(o, "l_orderkey", "left")
    return x.where(~F.col("s").eqNullSafe(F.col("y"))).select("l_orderkey", "l_linenumber", "l_partkey")


@query("b19_type_manifest", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS received_on, o_orderstatus = 'F' AS is_final, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS declared FROM orders")
def b19m(spark, sf):
    text = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" ")).alias("received_on"), F.when(F.col("o_orderstatus") == "F", "true").otherwise("false").alias("is_final"), F.format_string("%.2f", "o_totalprice").alias("declared"))
    return clean.typed(text, {"received_on": "date", "is_final": "boolean", "declared": "double"})


@query("b19_type_universe", "SELECT c_custkey, c_mktsegment AS sector, CASE WHEN c_acctbal > 0 THEN CAST(c_nationkey AS INTEGER) END AS place FROM customer")
def b19u(spark, sf):
    text = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("sector"), F.when(F.col("c_acctbal") > 0, F.concat(F.lit(" "), F.col("c_nationkey").cast("string"))).otherwise("n/k").alias("place"))
    return clean.typed(text, {"sector": "string", "place": "int"})


# ---------------------------------------------------------------- look-ups


@query("k10_peer_lookup", SUPPLIER_YEAR + ", g AS (SELECT peer, period, median(turnover) AS m, count(*) AS n FROM p GROUP BY ALL) SELECT entity, period, CASE WHEN n >= 5 THEN round(m, 6) END AS peer_median, CASE WHEN period = (SELECT max(period) FROM p) THEN 'provisional' ELSE 'final' END AS year_status, CASE WHEN n >= 5 THEN 'shown' ELSE 'withheld: fewer than 5' END AS rule_label FROM p JOIN g USING (peer, period)")
def k10(spark, sf):
    return look.peer_lookup(supplier_year(spark, sf), ["peer", "period"], "period", "turnover").select("entity", "period", r6("peer_median").alias("peer_median"), "year_status", "rule_label")


@query("k11_lookup_percentiles", SUPPLIER_YEAR + ", c AS (SELECT entity, period, renewable_share AS v, count(renewable_share) OVER (PARTITION BY peer, period) AS n, percent_rank() OVER (PARTITION BY peer, period, renewable_share IS NULL ORDER BY renewable_share) AS k FROM p) SELECT entity, period, CASE WHEN v IS NOT NULL AND n >= 5 THEN round(100 * k, 6) END AS percentile, CASE WHEN v IS NULL THEN 'withheld: no value' WHEN n < 5 THEN 'withheld: group under 5' ELSE 'shown' END AS status FROM c WHERE entity = 7")
def k11c(spark, sf):
    return look.percentiles(supplier_year(spark, sf), ["peer", "period"], "renewable_share", {"entity": 7}).select("entity", "period", r6("percentile").alias("percentile"), "status")


@query("k11_lookup_concentration", SUPPLIER_YEAR + ", s AS (SELECT period, row_number() OVER w AS k, count(*) OVER (PARTITION BY period) AS n, sum(turnover_cents) OVER w::DOUBLE / sum(turnover_cents) OVER (PARTITION BY period) AS c FROM p WINDOW w AS (PARTITION BY period ORDER BY turnover_cents DESC, entity ROWS UNBOUNDED PRECEDING)) SELECT period, n AS n_entities, min(k) FILTER (WHERE c >= 0.8)::INTEGER AS entities_for_80, round(max(c) FILTER (WHERE k <= 5), 6) AS top5_share FROM s WHERE period = 1998 GROUP BY ALL")
def k11d(spark, sf):
    return look.concentration(supplier_year(spark, sf), "entity", "turnover_cents", "period", 1998).select("period", "n_entities", "entities_for_80", r6("top5_share").alias("top5_share"))


@query("k11_lookup_confirmed_movers", _YOY + "SELECT entity, period, round(change, 6) AS change FROM c WHERE status = 'confirmed' AND period = 1998 ORDER BY c.change DESC, entity LIMIT 5")
def k11e(spark, sf):
    return look.top_movers(yoy_confidence(customer_year(spark, sf)), 1998, 5).select("entity", "period", r6("change").alias("change"))


@query("k11_lookup_restatements", _PAIRS + "SELECT peer, count(*) FILTER (WHERE is_compared) AS n_compared, count(*) FILTER (WHERE classification IN ('material', 'large')) AS n_material, CASE WHEN count(DISTINCT entity) < 5 THEN 'withheld: fewer than 5' ELSE 'shown' END AS status FROM r WHERE peer LIKE '%A%' GROUP BY 1")
def k11f(spark, sf):
    return look.restatement_summary(restatement_pairs(supplier_year(spark, sf)).where("peer LIKE '%A%'"), ["peer"])


@query("k11_resolve_group_type", SUPPLIER_YEAR + "SELECT 'sector' AS group_type, sector AS group_value, count(DISTINCT entity) AS n FROM p WHERE sector IN ('ASIA', 'CHINA') GROUP BY ALL UNION ALL SELECT 'peer', peer, count(DISTINCT entity) FROM p WHERE peer IN ('ASIA', 'CHINA') GROUP BY ALL")
def k11g(spark, sf):
    return look.resolve_groups(supplier_year(spark, sf), ["sector", "peer", "ownership"], ["ASIA", "CHINA"], "entity")


@query("k12_companies", SUPPLIER_YEAR + "SELECT entity, name, period AS last_period, CASE WHEN emissions IS NULL THEN 'withheld: no value' WHEN n < 5 THEN 'withheld: group under 5' ELSE 'shown' END AS label FROM (SELECT *, count(emissions) OVER (PARTITION BY peer, period) AS n, row_number() OVER (PARTITION BY entity ORDER BY period DESC) AS k FROM p) WHERE k = 1")
def k12(spark, sf):
    p = supplier_year(spark, sf)
    n = p.groupBy("peer", "period").agg(F.count("emissions").alias("n"))
    last = win.pick_one(p.join(n, ["peer", "period"]), ["entity"], [F.col("period").desc()])
    return last.select("entity", "name", F.col("period").alias("last_period"), look.withheld_label(F.col("emissions"), F.col("n")).alias("label"))


# ---------------------------------------------------------------- checks


@query("v09_percentile_of_small_group", SUPPLIER_YEAR + ", c AS (SELECT entity, period, women_share AS v, count(women_share) OVER (PARTITION BY peer, period) AS n FROM p) SELECT entity, period, n AS group_n FROM c WHERE v IS NOT NULL AND n >= 3 AND n < 5")
def v09b(spark, sf):
    shown = win.group_percentile(supplier_year(spark, sf), ["peer", "period"], "women_share", least=3)
    return checks.small_group_statistics(shown, "percentile", "group_n").select("entity", "period", "group_n")


@query("v09_catalogue_is_columns", "SELECT event_type AS name, 'no column' AS problem FROM (SELECT DISTINCT event_type FROM events) WHERE event_type NOT IN ('click', 'view', 'refund') UNION ALL SELECT x, 'not in the catalogue' FROM (SELECT unnest(['click', 'view', 'refund']) AS x) WHERE x NOT IN (SELECT event_type FROM events)")
def v09c(spark, sf):
    return checks.catalogue_is_columns(table(spark, sf, "events").select(F.col("event_type").alias("name")), ["click", "view", "refund"])


@query("v14_override_matches_one", "SELECT c_custkey, count(o_orderkey) AS n_matches FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND year(o_orderdate) = 1997 WHERE c_acctbal > 5000 GROUP BY 1 HAVING count(o_orderkey) <> 1")
def v14(spark, sf):
    overrides = table(spark, sf, "customer").where("c_acctbal > 5000").select("c_custkey", F.lit(1997).alias("period"))
    filed = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("period"))
    return checks.matches_one(overrides, filed, ["c_custkey", "period"]).select("c_custkey", "n_matches")


@query("v16_names_and_classes", SUPPLIER_YEAR + "SELECT 'card' AS table_name, 'turnover_cents' AS column_name, 'looks raw' AS problem, count(turnover_cents) AS n_values FROM p UNION ALL SELECT 'card', 'pay_gap', 'not allowed', count(pay_gap) FROM p UNION ALL SELECT 'extra', 'entity', 'table is not classified', count(entity) FROM p UNION ALL SELECT 'extra', 'name', 'table is not classified', count(name) FROM p")
def v16(spark, sf):
    p = supplier_year(spark, sf)
    return checks.publication_problems({"card": p.select("name", "period", "turnover_cents", "pay_gap"), "extra": p.select("entity", "name")}, {"card": ["name", "period", "turnover_cents"]})


@query("v17_peer_groups_cover", "SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)")
def v17(spark, sf):
    groups = table(spark, sf, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("c_nationkey"))
    return checks.peer_groups_cover(table(spark, sf, "customer"), "c_nationkey", groups).select("c_custkey")
