"""Queries of the data-quality checks: the rows that break a rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks
from ..operators import window as win
from .bindings import CUSTOMER_YEAR, SUPPLIER_YEAR, customer_year, r6, supplier_year, table
from .questions import _SHARES
from .registry import query


@query("v01_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def v01a(spark, sf):
    return checks.unique(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query("v01_not_null", SUPPLIER_YEAR + "SELECT entity, period FROM p WHERE emissions IS NULL OR women_share IS NULL")
def v01b(spark, sf):
    return checks.not_null(supplier_year(spark, sf), "emissions", "women_share").select("entity", "period")


@query("v01_accepted_values", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 1")
def v01c(spark, sf):
    return checks.accepted_values(table(spark, sf, "orders"), "o_orderstatus", ["O", "F"])


@query("v01_relationships", "SELECT l_partkey, l_suppkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 2)")
def v01d(spark, sf):
    return checks.relationships(table(spark, sf, "lineitem").select("l_partkey", "l_suppkey"), ["l_partkey"], table(spark, sf, "part").where("p_size > 2"), ["p_partkey"])


@query("v02_accepted_range", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9900")
def v02a(spark, sf):
    return checks.accepted_range(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 0, 9900)


@query("v02_equal_rowcount", "SELECT n_left, n_right FROM (SELECT count(*) AS n_left FROM customer), (SELECT count(*) AS n_right FROM orders) WHERE n_left <> n_right")
def v02b(spark, sf):
    return checks.equal_rowcount(table(spark, sf, "customer"), table(spark, sf, "orders"))


@query("v03_relationships_composite", "SELECT l_orderkey, l_linenumber FROM lineitem l WHERE l_returnflag = 'R' AND NOT EXISTS (SELECT 1 FROM lineitem m WHERE m.l_returnflag = 'A' AND m.l_orderkey = l.l_orderkey AND m.l_linenumber = l.l_linenumber)")
def v03(spark, sf):
    x = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    keys = ["l_orderkey", "l_linenumber"]
    return checks.relationships(x.where("l_returnflag = 'R'"), keys, x.where("l_returnflag = 'A'"), keys).select(*keys)


@query("v05_counts_reconcile", "SELECT o_orderkey, o_custkey % 7 AS n_declared, coalesce(n, 0) AS n_staged FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_custkey % 7 <> coalesce(n, 0)")
def v05(spark, sf):
    declared = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 7).alias("n"))
    return checks.counts_reconcile(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), declared, "o_orderkey", "n")


@query("v06_one_main_row", "SELECT o_custkey, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_main FROM orders GROUP BY 1 HAVING count(*) FILTER (WHERE o_orderpriority = '1-URGENT') <> 1")
def v06(spark, sf):
    return checks.one_main_row(table(spark, sf, "orders"), "o_custkey", F.col("o_orderpriority") == "1-URGENT")


def _history(spark, sf):
    """Versions of users' event types; every fifth one is planted to end too late, and every third user has no current one."""
    h = win.scd2_from_runs(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], ["event_type"])
    late = (F.col("version") % 5 == 0) & F.col("valid_to").isNotNull()
    return h.withColumns({"valid_to": F.when(late, F.col("valid_to") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("valid_to")), "is_current": F.col("is_current") & (F.col("user_id") % 3 != 0)})


_HISTORY = """WITH c AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR lag(event_type) OVER w IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, CAST(sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS version FROM c), h AS (SELECT user_id, version, version < max(version) OVER (PARTITION BY user_id) AS has_next FROM (SELECT DISTINCT user_id, version FROM r))
"""


@query("v07_scd2_no_overlap", _HISTORY + "SELECT user_id, version FROM h WHERE has_next AND version % 5 = 0")
def v07a(spark, sf):
    rows = checks.scd2_no_overlap(_history(spark, sf), ["user_id"])
    return rows.where("valid_to is not null").select("user_id", "version")


@query("v07_scd2_one_current", _HISTORY + "SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS n_current FROM h WHERE user_id % 3 = 0")
def v07b(spark, sf):
    return checks.scd2_one_current(_history(spark, sf), ["user_id"])


@query("v08_grain_complete", "SELECT c_custkey, y AS period, CAST(0 AS BIGINT) AS n FROM customer, (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders) WHERE (c_custkey, y) NOT IN (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) FROM orders)")
def v08(spark, sf):
    have = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("period")).distinct()
    # years of the calendar that orders cover: a handful at any scale
    source = table(spark, sf, "customer").select("c_custkey").crossJoin(F.broadcast(have.select("period").distinct()))
    return checks.grain_complete(have, source, ["c_custkey", "period"])


@query("v04_contract", "SELECT * FROM (VALUES ('n_comment is missing'), ('n_name is string, not int'), ('n_regionkey isn''t in the contract')) v(problem) WHERE (SELECT count(*) FROM nation) > 0")
def v04(spark, sf):
    from pyspark.sql.types import StructType

    n = table(spark, sf, "nation")
    problems = checks.contract(n, StructType.fromDDL("n_nationkey int, n_name int, n_comment string"))
    return n.limit(1).select(F.explode(F.array(*map(F.lit, problems))).alias("problem"))


@query("v09_gold_integrity", "SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS period, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_latest FROM orders GROUP BY ALL HAVING count(*) FILTER (WHERE o_orderstatus = 'F') <> 1")
def v09(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("period")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("n_latest"))
    return o.where("n_latest <> 1")


@query("v15_views_match_facts", "SELECT l_returnflag, count(*) AS n_left, count(*) FILTER (WHERE l_tax > 0) AS n_right FROM lineitem GROUP BY 1 HAVING count(*) <> count(*) FILTER (WHERE l_tax > 0)")
def v15(spark, sf):
    x = table(spark, sf, "lineitem")
    left = x.groupBy("l_returnflag").agg(F.count("*").alias("n_left"))
    right = x.where("l_tax > 0").groupBy("l_returnflag").agg(F.count("*").alias("n_right"))
    return left.join(right, "l_returnflag", "full_outer").where("NOT n_left <=> n_right")


@query("v10_all_units_mapped", "SELECT DISTINCT p_type FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL')")
def v10(spark, sf):
    known = spark.createDataFrame([("ECONOMY",), ("SMALL",)], "p_type string")
    return checks.relationships(table(spark, sf, "part").select("p_type").distinct(), ["p_type"], known, ["p_type"])


@query("v11_sanity_with_accepted_exceptions", CUSTOMER_YEAR + "SELECT entity, period, rule FROM (SELECT entity, period, 'women over 90' AS rule FROM p WHERE women_share > 90 UNION ALL SELECT entity, period, 'no events' FROM p WHERE events = 0 UNION ALL SELECT entity, period, 'tiny turnover' FROM p WHERE turnover < 5000) WHERE NOT (entity < 50 AND rule = 'no events')")
def v11(spark, sf):
    p = customer_year(spark, sf)
    rules = {"women over 90": F.col("women_share") > 90, "no events": F.col("events") == 0, "tiny turnover": F.col("turnover") < 5000}
    known = p.where("entity < 50").select("entity", "period", F.lit("no events").alias("rule"))
    return checks.sanity(p, ["entity", "period"], rules, known)


@query("v12_pareto_consistent", _SHARES + "SELECT period, round(sum(share), 6) AS total, CAST(0 AS BIGINT) AS n_falls FROM s WHERE position > 1 GROUP BY 1")
def v12(spark, sf):
    c = win.concentration(supplier_year(spark, sf), "entity", "turnover_cents", "period", least=1).where("position > 1")
    return checks.pareto_consistent(c, "period", "share", "cumulative_share", "position").withColumn("total", r6("total"))


@query("v13_weights_sum_to_one", "SELECT round(sum(p_size), 6)::DOUBLE AS total, count(*) AS n FROM part HAVING abs(sum(p_size) - 1) > 1e-9 OR count(*) <> 4")
def v13(spark, sf):
    return checks.weights_sum_to_one(table(spark, sf, "part").select(F.col("p_size").cast("double").alias("w")), "w", 4)


_OVERRIDES = "SELECT o_custkey AS entity, year(o_orderdate)::INTEGER AS period, max(o_totalprice) AS value FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL"


@query("v14_override_within_3x", CUSTOMER_YEAR + f", o AS ({_OVERRIDES}) SELECT DISTINCT o.entity, o.period, round(o.value, 2) AS value FROM o JOIN p b ON o.entity = b.entity AND abs(o.period - b.period) = 1 WHERE NOT o.value BETWEEN b.turnover / 3 AND b.turnover * 3")
def v14(spark, sf):
    """A table of overrides: pending orders state a year's turnover anew."""
    orders = table(spark, sf, "orders").where("o_orderstatus = 'P'")
    overrides = orders.groupBy(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("period")).agg(F.max("o_totalprice").alias("value"))
    return checks.far_from_neighbours(overrides, customer_year(spark, sf), "entity", "period", "value", "turnover").withColumn("value", F.round("value", 2))


@query("v16_publication_guard", SUPPLIER_YEAR + "SELECT peer, period, count(DISTINCT entity) AS n_entities FROM p GROUP BY ALL HAVING count(DISTINCT entity) < 5")
def v16(spark, sf):
    g = supplier_year(spark, sf).groupBy("peer", "period").agg(F.countDistinct("entity").alias("n_entities"), F.median("turnover").alias("mid"))
    return checks.publication_guard(g, ["peer", "period", "n_entities", "mid"], ["mid"], "n_entities")[1].drop("mid")


@query("v17_groups_min_size", "SELECT s_nationkey, count(DISTINCT s_suppkey) AS n FROM supplier GROUP BY 1 HAVING count(DISTINCT s_suppkey) < 5")
def v17(spark, sf):
    return checks.groups_min_size(table(spark, sf, "supplier"), "s_nationkey", "s_suppkey")


@query("v18_reconcile", """WITH a AS (SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem WHERE l_returnflag = 'A' AND l_suppkey % 10 <> 3 GROUP BY 1), b AS (SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem WHERE l_returnflag = 'A' AND l_suppkey % 10 <> 4 AND (l_suppkey % 10 <> 5 OR l_tax > 0) GROUP BY 1)
SELECT coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey, a.q AS left_value, b.q AS right_value, CASE WHEN b.l_suppkey IS NULL THEN 'left only' WHEN a.l_suppkey IS NULL THEN 'right only' ELSE 'differs' END AS problem FROM a FULL JOIN b ON a.l_suppkey = b.l_suppkey WHERE a.q IS DISTINCT FROM b.q""")
def v18(spark, sf):
    x = table(spark, sf, "lineitem").where("l_returnflag = 'A'")
    total = lambda d: d.groupBy("l_suppkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))
    return checks.reconcile(total(x.where("l_suppkey % 10 <> 3")), total(x.where("l_suppkey % 10 <> 4 AND (l_suppkey % 10 <> 5 OR l_tax > 0)")), ["l_suppkey"], "q")


@query("v19_expected_values", "SELECT n_nationkey, n_regionkey FROM (SELECT n_nationkey, CAST(n_nationkey % 4 AS INTEGER) AS n_regionkey, n_regionkey AS got FROM nation) WHERE n_regionkey <> got")
def v19(spark, sf):
    n = table(spark, sf, "nation")
    return checks.expected_values(n, n.select("n_nationkey", (F.col("n_nationkey") % 4).alias("n_regionkey")), ["n_nationkey"], "n_regionkey")
