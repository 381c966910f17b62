"""Queries of joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import aggregate as agg
from ..operators import equality
from ..operators import ordering as order
from ..operators import window as win
from .bindings import CUSTOMER_YEAR, SUPPLIER_YEAR, cents, customer_year, r6, supplier_year, table
from .registry import query

# ---------------------------------------------------------------- joins


@query("c01_inner_join", "SELECT o_custkey, count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL")
def c01(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("q"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return o.join(lines, o["o_orderkey"] == lines["l_orderkey"]).groupBy("o_custkey").agg(F.sum("n").alias("n_lines"), F.sum("q").alias("quantity"))


@query("c02_left_enrichment", "SELECT c_custkey, c_name, n_name, r_name, o.n_orders FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA' LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) o ON o_custkey = c_custkey")
def c02(spark, sf):
    n, r = F.broadcast(table(spark, sf, "nation")), F.broadcast(table(spark, sf, "region").where("r_name <> 'ASIA'"))
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    c = table(spark, sf, "customer")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").join(r, F.col("n_regionkey") == r["r_regionkey"], "left").join(o, c["c_custkey"] == o["o_custkey"], "left").select("c_custkey", "c_name", "n_name", "r_name", "n_orders")


@query("c03_left_semi", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def c03(spark, sf):
    o = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(o, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("c04_left_anti", CUSTOMER_YEAR + "SELECT entity, period FROM p WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.entity = p.entity AND q.period = p.period AND q.has_event)")
def c04(spark, sf):
    p = customer_year(spark, sf).select("entity", "period", "has_event")
    return p.join(p.where("has_event"), ["entity", "period"], "left_anti").select("entity", "period")


@query("c05_anti_by_composite_key", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A' AND (l_partkey, l_suppkey) NOT IN (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R')")
def c05(spark, sf):
    x = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    return x.where("l_returnflag = 'A'").join(x.where("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"], "left_anti").select("l_partkey", "l_suppkey").distinct()


@query("c06_full_outer", """SELECT coalesce(a.k, b.k) AS nationkey, a.n AS n_customers, b.n AS n_suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) b ON a.k = b.k""")
def c06(spark, sf):
    a = table(spark, sf, "customer").where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("n_customers"))
    b = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("n_suppliers"))
    return a.join(b, "nationkey", "full_outer")


@query("c07_inequality_join", """WITH r(kind, from_year) AS (VALUES ('R', 1996), ('A', 1998), ('N', 2000)) SELECT l_returnflag AS kind, CAST(year(l_shipdate) AS INTEGER) AS period, count(*) AS n FROM lineitem JOIN r ON l_returnflag = kind AND from_year <= year(l_shipdate) GROUP BY ALL""")
def c07(spark, sf):
    rules = spark.createDataFrame([("R", 1996), ("A", 1998), ("N", 2000)], "kind string, from_year int")
    years = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("kind"), F.year("l_shipdate").alias("period")).agg(F.count("*").alias("n"))
    return years.join(F.broadcast(rules), (years["kind"] == rules["kind"]) & (rules["from_year"] <= years["period"])).select(years["kind"], "period", "n")


_ALIASES = [("gizmo", "Gizmo works", 1), ("new gizmo", "New gizmo works", 1), ("bolt", "Bolt makers", 2), ("ring", "Ring makers", 2), ("red", "Red goods", 3)]


@query("c08_contains_join_best_match", f"""WITH a(pattern, name, priority) AS (VALUES {", ".join(map(str, _ALIASES))}) SELECT p_partkey, name FROM (SELECT p_partkey, name, row_number() OVER (PARTITION BY p_partkey ORDER BY priority, length(pattern) DESC, pattern) AS nth FROM part LEFT JOIN a ON contains(lower(p_name), pattern)) WHERE nth = 1""")
def c08(spark, sf):
    from ..operators.domain import resolve_aliases

    return resolve_aliases(table(spark, sf, "part"), "p_name", spark.createDataFrame(_ALIASES, "pattern string, name string, priority int")).select("p_partkey", "name")


@query("c09_self_join_with_band", SUPPLIER_YEAR + "SELECT a.entity, a.period FROM p a JOIN p b ON a.entity = b.entity AND b.period = a.period + 1 WHERE a.restated BETWEEN 0.95 * b.original AND 1.05 * b.original")
def c09(spark, sf):
    p = supplier_year(spark, sf).select("entity", "period", "original", "restated")
    later = p.select("entity", (F.col("period") - 1).alias("period"), F.col("original").alias("next_original"))
    return p.join(later, ["entity", "period"]).where("restated BETWEEN 0.95 * next_original AND 1.05 * next_original").select("entity", "period")


@query("c10_median_of_the_others", SUPPLIER_YEAR + "SELECT a.entity, a.period, round(median(b.turnover), 6) AS others FROM p a LEFT JOIN p b ON a.entity = b.entity AND a.period <> b.period GROUP BY ALL")
def c10(spark, sf):
    from ..operators.domain import median_of_others

    return median_of_others(supplier_year(spark, sf), ["entity"], "period", "turnover", "others").select("entity", "period", r6("others").alias("others"))


@query("c11_adjacent_period_join", CUSTOMER_YEAR + "SELECT a.entity, a.period, b.period AS near_period FROM p a JOIN p b ON a.entity = b.entity AND abs(a.period - b.period) = 1 WHERE a.turnover > 3 * b.turnover")
def c11(spark, sf):
    p = customer_year(spark, sf).select("entity", "period", "turnover")
    # two equal keys instead of a band: each row goes to both periods beside its own
    near = p.select("entity", F.explode(F.array(F.col("period") - 1, F.col("period") + 1)).alias("period"), F.col("period").alias("near_period"), F.col("turnover").alias("near"))
    return p.join(near, ["entity", "period"]).where("turnover > 3 * near").select("entity", "period", "near_period")


@query("c12_candidates_and_scalars", SUPPLIER_YEAR + "SELECT entity, period, s.scale, round(turnover * s.scale, 2) AS scaled, (SELECT max(period) FROM p) AS latest FROM p, (VALUES (1e5), (1e6), (1e7)) s(scale)")
def c12(spark, sf):
    p = supplier_year(spark, sf).select("entity", "period", "turnover")
    latest = F.broadcast(p.agg(F.max("period").alias("latest")))
    each = p.withColumn("scale", F.explode(F.array(*(F.lit(s) for s in (1e5, 1e6, 1e7)))))
    return each.crossJoin(latest).select("entity", "period", "scale", F.round(F.col("turnover") * F.col("scale"), 2).alias("scaled"), "latest")


@query("c13_peer_medians", SUPPLIER_YEAR + """SELECT a.entity, a.period, round((SELECT median(b.turnover) FROM p b WHERE b.sector = a.sector AND b.period = a.period), 6) AS peer_median, CASE WHEN (SELECT count(DISTINCT b.entity) FROM p b WHERE b.sector = a.sector AND b.period = a.period) >= 3 THEN true ELSE false END AS enough_peers FROM p a""")
def c13(spark, sf):
    p = supplier_year(spark, sf).select("entity", "period", "sector", "turnover")
    # one row for each group, joined back: no row carries its peers
    peers = p.groupBy("sector", "period").agg(F.countDistinct("entity").alias("_n"))
    return order.with_medians(p, ["sector", "period"], "turnover", "_m").join(peers, ["sector", "period"]).select("entity", "period", r6("_m").alias("peer_median"), (F.col("_n") >= 3).alias("enough_peers"))


@query("c14_scalar_subquery", "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def c14(spark, sf):
    o = table(spark, sf, "orders").withColumn("_y", F.year("o_orderdate"))
    latest = F.broadcast(o.agg(F.max("_y").alias("_y")))
    return o.join(latest, "_y", "left_semi").select("o_orderkey", "o_totalprice")


@query("c16_period_pairs", CUSTOMER_YEAR + "SELECT a.entity, a.period AS from_period, b.period AS to_period, round(b.turnover - a.turnover, 2) AS step FROM p a JOIN p b ON a.entity = b.entity AND b.period = a.period + 2")
def c16(spark, sf):
    p = customer_year(spark, sf).select("entity", "period", "turnover")
    later = p.select("entity", (F.col("period") - 2).alias("period"), F.col("period").alias("to_period"), F.col("turnover").alias("_t"))
    return p.join(later, ["entity", "period"]).select("entity", F.col("period").alias("from_period"), "to_period", F.round(F.col("_t") - F.col("turnover"), 2).alias("step"))


@query("c15_latest_then_join", "SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC) AS k FROM orders) WHERE k = 1 AND o_orderpriority <> '5-LOW'")
def c15(spark, sf):
    o = table(spark, sf, "orders").withColumn("_k", F.rank().over(Window.partitionBy("o_custkey").orderBy(F.year("o_orderdate").desc())))
    return o.where("_k = 1 AND o_orderpriority <> '5-LOW'").select("o_custkey", "o_orderkey", "o_orderpriority")


@query("c17_fan_out_to_groups", CUSTOMER_YEAR + """SELECT group_type, group_value, period, count(*) AS n, count(DISTINCT entity) AS n_entities FROM (
SELECT 'all' AS group_type, 'all' AS group_value, * FROM p UNION ALL SELECT 'sector', sector, * FROM p UNION ALL SELECT 'peer', peer, * FROM p UNION ALL SELECT 'ownership', ownership, * FROM p) GROUP BY ALL""")
def c17(spark, sf):
    groups = {"all": F.lit("all"), **{c: F.col(c) for c in ("sector", "peer", "ownership")}}
    levels = [({"group_type": F.lit(t), "group_value": v, "period": F.col("period")}, None) for t, v in groups.items()]
    return agg.roll_up(customer_year(spark, sf), ["sector", "peer", "ownership", "period"], levels, {"n": F.count("*")}, "entity", {"n_entities": None})


# ---------------------------------------------------------------- aggregations


@query("d01_group_aggregates", "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity, min(l_extendedprice) AS low, max(l_extendedprice) AS high, round(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / 100.0::DOUBLE / count(*), 6) AS mean FROM lineitem GROUP BY ALL")
def d01(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"), r6(F.sum(cents("l_extendedprice")) / 100.0 / F.count("*")).alias("mean"))


@query("d02_filtered_aggregates", "SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, CAST(sum(l_quantity) FILTER (WHERE l_tax = 0) AS BIGINT) AS untaxed_quantity, max(l_shipdate) FILTER (WHERE l_linestatus = 'O') AS last_open FROM lineitem GROUP BY 1")
def d02(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.sum(F.when(F.col("l_tax") == 0, F.col("l_quantity").cast("long"))).alias("untaxed_quantity"), F.max(F.when(F.col("l_linestatus") == "O", F.col("l_shipdate"))).alias("last_open"))


@query("d03_count_distinct", "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_partkey) FILTER (WHERE l_returnflag = 'R') AS returned_parts, count(DISTINCT l_returnflag || '|' || l_linestatus) AS kinds FROM lineitem GROUP BY 1")
def d03(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("returned_parts"), F.countDistinct(F.concat_ws("|", "l_returnflag", "l_linestatus")).alias("kinds"))


@query("d04_bool_or_and", "SELECT o_custkey, bool_or(o_orderstatus = 'P') AS any_partial, bool_and(o_totalprice > 20000) AS all_large FROM orders GROUP BY 1")
def d04(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "P").alias("any_partial"), F.bool_and(F.col("o_totalprice") > 20000).alias("all_large"))


@query("d05_conditional_pivot", "SELECT l_suppkey, " + ", ".join(f"max(CASE WHEN l_returnflag = '{f}' THEN l_extendedprice END) AS top_{f.lower()}" for f in "ANR") + " FROM lineitem GROUP BY 1")
def d05(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(*(F.max(F.when(F.col("l_returnflag") == f, F.col("l_extendedprice"))).alias(f"top_{f.lower()}") for f in "ANR"))


@query("d06_median_and_quantiles", "SELECT l_suppkey, round(median(l_extendedprice), 6) AS p50, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25, round(quantile_cont(l_extendedprice, 0.75), 6) AS p75 FROM lineitem GROUP BY 1")
def d06(spark, sf):
    x = table(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice")
    return order.quantiles(x, ["l_suppkey"], "l_extendedprice", [0.5, 0.25, 0.75]).select("l_suppkey", *(r6(F.get("q", F.lit(i))).alias(n) for i, n in enumerate(("p50", "p25", "p75"))))


@query("d07_mode", "SELECT c_nationkey, seg AS usual_segment FROM (SELECT c_nationkey, c_mktsegment AS seg, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment) AS k FROM customer GROUP BY c_nationkey, c_mktsegment) WHERE k = 1")
def d07(spark, sf):
    counts = table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    return counts.groupBy("c_nationkey").agg(F.min_by("c_mktsegment", F.struct(-F.col("n"), F.col("c_mktsegment"))).alias("usual_segment"))


@query("d08_arg_max_skips_nulls", "SELECT user_id, (max({'v': value, 'x': x}) FILTER (WHERE x IS NOT NULL)).x AS kind_of_largest FROM (SELECT user_id, value, CASE WHEN event_type <> 'error' THEN event_type END AS x FROM events) GROUP BY 1")
def d08(spark, sf):
    e = table(spark, sf, "events").select("user_id", "value", F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"))
    return e.groupBy("user_id").agg(agg.arg_max("kind", "value").alias("kind_of_largest"))


@query("d09_any_value_made_definite", "SELECT o_custkey, min(o_orderpriority) AS any_priority FROM orders GROUP BY 1")
def d09(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderpriority").alias("any_priority"))


@query("d10_joined_distinct", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) FILTER (WHERE o_orderstatus = 'F') AS priorities FROM orders GROUP BY 1")
def d10(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(agg.joined_set(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))).alias("priorities"))


@query("d11_sorted_distinct_list", "SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT l_linenumber)), ',') AS numbers FROM lineitem GROUP BY 1")
def d11(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.array_join(F.sort_array(F.collect_set("l_linenumber")), ",").alias("numbers"))


@query("d12_correlation", "SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem GROUP BY 1")
def d12(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(r6(F.corr("l_quantity", "l_extendedprice")).alias("r"))


@query("d13_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12 AND bool_or(o_orderstatus = 'P')")
def d13(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.bool_or(F.col("o_orderstatus") == "P").alias("_p")).where("n > 12 AND _p").drop("_p")


@query("d14_grouping_sets", "SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag) * 2 + grouping(l_linestatus) AS BIGINT) AS level, count(*) AS n, round(median(l_extendedprice), 6) AS mid FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), (l_linestatus), ())")
def d14(spark, sf):
    x = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    fanned = agg.fanned_sets(x, ["l_returnflag", "l_linestatus"], [("l_returnflag", "l_linestatus"), ("l_returnflag",), ("l_linestatus",), ()])
    counts = fanned.groupBy("l_returnflag", "l_linestatus", "level").agg(F.count("*").alias("n"))
    return order.joined_medians(counts, fanned, ["l_returnflag", "l_linestatus", "level"], "l_extendedprice", "mid").withColumn("mid", r6("mid"))


@query("d15_total_row", "SELECT coalesce(l_returnflag, 'All') AS l_returnflag, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY ROLLUP (l_returnflag)")
def d15(spark, sf):
    return agg.with_total(table(spark, sf, "lineitem").select("l_returnflag", "l_suppkey"), "l_returnflag", [F.count("*").alias("n"), F.countDistinct("l_suppkey").alias("suppliers")])


@query("d16_summary_levels", CUSTOMER_YEAR + """SELECT level, level_key, count(*) AS n, count(*) FILTER (WHERE has_event) AS with_event, count(DISTINCT entity) AS n_entities FROM (
SELECT 'overall' AS level, 'all' AS level_key, * FROM p UNION ALL SELECT 'peer', peer, * FROM p UNION ALL SELECT 'period', CAST(period AS VARCHAR), * FROM p UNION ALL SELECT 'disclosed only', sector, * FROM p WHERE disclosed) GROUP BY ALL""")
def d16(spark, sf):
    level = lambda name, key: {"level": F.lit(name), "level_key": key}
    blocks = [(level("overall", F.lit("all")), None), (level("peer", F.col("peer")), None), (level("period", F.col("period").cast("string")), None), (level("disclosed only", F.col("sector")), F.col("disclosed"))]
    sums = {"n": F.count("*"), "with_event": F.count_if("has_event")}
    return agg.roll_up(customer_year(spark, sf), ["peer", "sector", "period", "disclosed"], blocks, sums, "entity", {"n_entities": None})


@query("d17_pivot_two_aggregates", "SELECT l_suppkey, " + ", ".join(f"count(*) FILTER (WHERE l_returnflag = '{f}') AS {f}_n, CAST(sum(l_quantity) FILTER (WHERE l_returnflag = '{f}') AS BIGINT) AS {f}_q" for f in "ANR") + " FROM lineitem GROUP BY 1")
def d17(spark, sf):
    x = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", F.col("l_quantity").cast("long").alias("q"))
    return x.groupBy("l_suppkey").pivot("l_returnflag", ["A", "N", "R"]).agg(F.count("q").alias("n"), F.sum("q").alias("q")).na.fill(0, ["A_n", "N_n", "R_n"])


@query("d18_unpivot", SUPPLIER_YEAR + "SELECT entity, period, metric, round(value, 6) AS value FROM p UNPIVOT (value FOR metric IN (emissions, women_share, renewable_share))")
def d18(spark, sf):
    return agg.unpivot(supplier_year(spark, sf), ["entity", "period"], ["emissions", "women_share", "renewable_share"]).withColumn("value", r6("value"))


@query("d19_aggregate_of_aggregate", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag), 6) AS share FROM lineitem GROUP BY l_returnflag, l_linestatus")
def d19(spark, sf):
    n = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    return n.withColumn("share", r6(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("l_returnflag"))))


@query("d20_ratio_of_sums", CUSTOMER_YEAR + "SELECT sector, period, round(sum(CASE WHEN emissions IS NOT NULL THEN emissions END) / nullif(sum(CASE WHEN emissions IS NOT NULL THEN turnover_cents END), 0) * 1e8, 6) AS intensity FROM p GROUP BY ALL")
def d20(spark, sf):
    return customer_year(spark, sf).groupBy("sector", "period").agg(r6(agg.ratio_of_sums("emissions", "turnover_cents") * 1e8).alias("intensity"))


@query("d21_share_of_filtered_count", "SELECT l_suppkey, round(count(*) FILTER (WHERE l_returnflag = 'R' AND l_tax = 0)::DOUBLE / nullif(count(*) FILTER (WHERE l_returnflag = 'R'), 0), 6) AS share FROM lineitem GROUP BY 1")
def d21(spark, sf):
    r = F.col("l_returnflag") == "R"
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(r6(F.count_if(r & (F.col("l_tax") == 0)) / F.nullif(F.count_if(r), F.lit(0))).alias("share"))


@query("d22_group_by_all", "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL")
def d22(spark, sf):
    return spark.sql("SELECT event_type, to_date(ts) AS day, count(*) AS n FROM {events} GROUP BY ALL", events=table(spark, sf, "events"))


# ---------------------------------------------------------------- windows


@query("e01_pick_one", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'F' DESC, o_orderdate DESC NULLS LAST, o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def e01(spark, sf):
    return win.pick_one(table(spark, sf, "orders"), ["o_custkey"], [(F.col("o_orderstatus") == "F").desc(), F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()]).select("o_custkey", "o_orderkey")


@query("e02_rank_with_nulls_apart", SUPPLIER_YEAR + "SELECT entity, period, CASE WHEN emissions IS NOT NULL THEN CAST(rank() OVER (PARTITION BY period, emissions IS NULL ORDER BY emissions DESC) AS INTEGER) END AS place FROM p")
def e02(spark, sf):
    p = supplier_year(spark, sf).select("entity", "period", "emissions")
    return order.with_places(p, ["period"], "emissions").select("entity", "period", order.descending_rank().cast("int").alias("place"))


@query("e03_dense_rank_flag", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) = 1 AS is_largest FROM lineitem")
def e03(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.dense_rank().over(Window.partitionBy("l_orderkey").orderBy(F.col("l_quantity").desc())) == 1).alias("is_largest"))


@query("e04_percent_rank", SUPPLIER_YEAR + """SELECT entity, period, n AS group_n, CASE WHEN emissions IS NOT NULL AND n >= 5 THEN round(100 * k, 6) END AS percentile, CASE WHEN emissions IS NULL THEN 'no value' WHEN n < 5 THEN 'group under 5' END AS percentile_null_reason
FROM (SELECT entity, period, emissions, count(emissions) OVER (PARTITION BY sector, period) AS n, percent_rank() OVER (PARTITION BY sector, period, emissions IS NULL ORDER BY emissions DESC) AS k FROM p)""")
def e04(spark, sf):
    return win.group_percentile(supplier_year(spark, sf), ["sector", "period"], "emissions", higher_is_better=False).select("entity", "period", "group_n", r6("percentile").alias("percentile"), "percentile_null_reason")


@query("e05_ntile", CUSTOMER_YEAR + "SELECT entity, period, CASE WHEN emissions IS NOT NULL THEN CAST(ntile(3) OVER (PARTITION BY sector, period, emissions IS NULL ORDER BY turnover_cents, entity) AS INTEGER) END AS band FROM p")
def e05(spark, sf):
    p = customer_year(spark, sf).select("entity", "period", "sector", F.when(F.col("emissions").isNotNull(), F.struct("turnover_cents", "entity")).alias("_o"))
    placed = order.with_places(p, ["sector", "period"], "_o")
    return placed.select("entity", "period", order.ntile(3, F.col("n_below"), F.col("n_group")).alias("band"))


@query("e06_lag_lead", CUSTOMER_YEAR + "SELECT entity, period, lag(turnover) OVER w AS before, lead(turnover) OVER w AS after FROM p WINDOW w AS (PARTITION BY entity ORDER BY period)")
def e06(spark, sf):
    w = Window.partitionBy("entity").orderBy("period")
    return customer_year(spark, sf).select("entity", "period", F.lag("turnover").over(w).alias("before"), F.lead("turnover").over(w).alias("after"))


@query("e07_change_since_first", CUSTOMER_YEAR + "SELECT entity, period, round(emissions / nullif(first_value(emissions) OVER (PARTITION BY entity ORDER BY period), 0) - 1, 6) AS change FROM p")
def e07(spark, sf):
    return customer_year(spark, sf).select("entity", "period", r6(win.change_vs_first("emissions", ["entity"], "period")).alias("change"))


@query("e08_running_share", SUPPLIER_YEAR + "SELECT entity, period, round(sum(turnover_cents) OVER (PARTITION BY period ORDER BY turnover_cents DESC, entity ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE / sum(turnover_cents) OVER (PARTITION BY period), 6) AS running FROM p")
def e08(spark, sf):
    return win.concentration(supplier_year(spark, sf), "entity", "turnover_cents", "period", least=1).select("entity", "period", r6("cumulative_share").alias("running"))


@query("e09_partition_totals", "SELECT p_partkey, count(*) OVER (PARTITION BY p_brand) AS in_brand, round(p_size::DOUBLE / sum(p_size) OVER (PARTITION BY p_brand), 6) AS share FROM part")
def e09(spark, sf):
    w = Window.partitionBy("p_brand")
    return table(spark, sf, "part").select("p_partkey", F.count("*").over(w).alias("in_brand"), r6(F.col("p_size") / F.sum("p_size").over(w)).alias("share"))


@query("e10_gaps_and_islands", "SELECT user_id, event_id, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM (SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS c FROM events)")
def e10(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf, "events").withColumn("_c", F.when(F.lag("event_type").over(w).eqNullSafe(F.col("event_type")), 0).otherwise(1))
    return e.select("user_id", "event_id", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("run"))


@query("e11_min_case_over", "SELECT event_id, min(CASE WHEN event_type = 'signup' THEN ts END) OVER (PARTITION BY user_id) AS first_signup FROM events")
def e11(spark, sf):
    return table(spark, sf, "events").select("event_id", F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).over(Window.partitionBy("user_id")).alias("first_signup"))


@query("e12_last_run_flag", CUSTOMER_YEAR + "SELECT entity, period, period = max(period) OVER (PARTITION BY entity) AS is_last FROM p")
def e12(spark, sf):
    return customer_year(spark, sf).select("entity", "period", (F.col("period") == F.max("period").over(Window.partitionBy("entity"))).alias("is_last"))


@query("e13_bool_and_over", CUSTOMER_YEAR + "SELECT entity, period, bool_and(disclosed) OVER (PARTITION BY entity) AS always FROM p")
def e13(spark, sf):
    return customer_year(spark, sf).select("entity", "period", F.bool_and("disclosed").over(Window.partitionBy("entity")).alias("always"))


@query("e14_median_over", SUPPLIER_YEAR + "SELECT entity, period, turnover >= median(turnover) OVER (PARTITION BY sector, period) AS upper_half FROM p")
def e14(spark, sf):
    p = supplier_year(spark, sf).select("entity", "period", "sector", "turnover")
    return order.with_medians(p, ["sector", "period"], "turnover", "_m").select("entity", "period", (F.col("turnover") >= F.col("_m")).alias("upper_half"))


@query("e15_filter_on_window", SUPPLIER_YEAR + "SELECT entity, period FROM p QUALIFY row_number() OVER (PARTITION BY period ORDER BY turnover_cents DESC, entity) <= 10")
def e15(spark, sf):
    return win.pick_one(supplier_year(spark, sf), ["period"], [F.col("turnover_cents").desc(), F.col("entity")], 10).select("entity", "period")


@query("e16_conditional_rank", SUPPLIER_YEAR + "SELECT entity, period, CASE WHEN disclosed THEN CAST(row_number() OVER (PARTITION BY peer, period, disclosed ORDER BY turnover_cents DESC, entity) AS INTEGER) END AS place FROM p")
def e16(spark, sf):
    w = Window.partitionBy("peer", "period", "disclosed").orderBy(F.col("turnover_cents").desc(), "entity")
    return supplier_year(spark, sf).select("entity", "period", F.when(F.col("disclosed"), F.row_number().over(w)).alias("place"))


@query("e17_average_rank", "SELECT p_partkey, rank() OVER (PARTITION BY p_brand ORDER BY p_size) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2.0::DOUBLE AS mean_rank FROM part")
def e17(spark, sf):
    return order.with_places(table(spark, sf, "part").select("p_partkey", "p_brand", "p_size"), ["p_brand"], "p_size").select("p_partkey", order.average_rank().alias("mean_rank"))


@query("e18_rank_over_aggregate", "SELECT o_custkey, n, CAST(rank() OVER (ORDER BY n DESC) AS INTEGER) AS place FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)")
def e18(spark, sf):
    from ..operators.domain import global_rank

    n = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return global_rank(n, "n", "place")


# ---------------------------------------------------------------- sorts, limits, sets


@query("f01_sort_with_nulls", SUPPLIER_YEAR + "SELECT entity, period, round(emissions, 6) AS emissions FROM p ORDER BY emissions DESC NULLS LAST, entity, period")
def f01(spark, sf):
    return supplier_year(spark, sf).select("entity", "period", r6("emissions").alias("emissions")).orderBy(F.col("emissions").desc_nulls_last(), "entity", "period")


@query("f02_order_by_all", "SELECT * FROM nation ORDER BY ALL")
def f02(spark, sf):
    return spark.sql("SELECT * FROM {nation} ORDER BY ALL", nation=table(spark, sf, "nation"))


@query("f03_global_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def f03(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


@query("f04_top_k_per_group", "SELECT c_nationkey, string_agg(c_custkey, ',' ORDER BY c_acctbal DESC, c_custkey) AS top3 FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer) WHERE k <= 3 GROUP BY 1")
def f04(spark, sf):
    top = win.pick_one(table(spark, sf, "customer"), ["c_nationkey"], [F.col("c_acctbal").desc(), F.col("c_custkey")], 3)
    return top.groupBy("c_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_nth", "c_custkey"))), lambda s: s["c_custkey"]), ",").alias("top3"))


@query("f05_first_event_per_entity", "SELECT user_id, min(ts) AS first_purchase FROM events WHERE event_type = 'purchase' GROUP BY 1")
def f05(spark, sf):
    return table(spark, sf, "events").where("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("first_purchase"))


@query("g01_union_all", "SELECT c_nationkey AS nationkey, 'customer' AS kind FROM customer UNION ALL SELECT s_nationkey, 'supplier' FROM supplier")
def g01(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"), F.lit("customer").alias("kind"))
    return a.unionByName(table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nationkey")))


@query("g02_distinct", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def g02(spark, sf):
    return table(spark, sf, "lineitem").select("l_partkey", "l_returnflag").distinct()


_SETS = """(SELECT side, l_partkey, l_quantity, count(*) AS n FROM (
SELECT 'left' AS side, * FROM (SELECT l_partkey, l_quantity FROM lineitem WHERE l_linestatus = 'O' EXCEPT ALL SELECT l_partkey, l_quantity FROM lineitem WHERE l_linestatus = 'F')
UNION ALL SELECT 'right', * FROM (SELECT l_partkey, l_quantity FROM lineitem WHERE l_linestatus = 'F' EXCEPT ALL SELECT l_partkey, l_quantity FROM lineitem WHERE l_linestatus = 'O')) GROUP BY ALL)"""


def _sets(spark, sf):
    x = table(spark, sf, "lineitem")
    return (x.where(F.col("l_linestatus") == s).select("l_partkey", "l_quantity") for s in "OF")


@query("g03_multiset_difference", f"SELECT * FROM {_SETS}")
def g03(spark, sf):
    return equality.difference(*_sets(spark, sf))


@query("g03_sampled_differences", f"SELECT * FROM {_SETS} ORDER BY md5(side || '|' || l_partkey || '|' || CAST(l_quantity AS INTEGER)), side, l_partkey, l_quantity LIMIT 20")
def g03b(spark, sf):
    rows = equality.difference(*_sets(spark, sf)).withColumn("q", F.col("l_quantity").cast("int"))
    return equality.sample(rows, ["l_partkey", "q"]).drop("q")
