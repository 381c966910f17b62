"""Queries of sources and sinks. What isn't among the driver's tables as a file is written from them first."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import files
from ..streaming.inbox import process_inbox, upsert_inbox
from .bindings import SUPPLIER_YEAR, supplier_year, table
from .registry import query


@query("a01_read_partitioned", "SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS period FROM orders WHERE year(o_orderdate) = 1997")
def a01(spark, sf):
    path = files.workspace(spark)
    table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("period")).write.partitionBy("period").parquet(path)
    return files.read_partitioned(spark, path, "o_orderkey long, o_custkey long, period int").where("period = 1997")


@query("a02_read_text_csv", "SELECT CAST(p_partkey AS VARCHAR) AS part_key, trim(p_name) AS part_name, CAST(p_size AS VARCHAR) AS size_mm FROM part")
def a02(spark, sf):
    path = files.workspace(spark)
    table(spark, sf, "part").select(F.col("p_partkey").alias("Part Key"), F.concat(F.lit("  "), "p_name", F.lit(" ")).alias(" Part  Name "), F.col("p_size").alias("Size (mm)")).write.option("header", True).csv(path)
    return files.read_text_csv(spark, path)


@query("a03_read_listing", "SELECT CAST(o_orderkey AS VARCHAR) AS filing, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS submission_date FROM orders")
def a03(spark, sf):
    path = files.workspace(spark)
    date = F.when(F.col("o_orderkey") % 5 == 0, "-").otherwise(F.date_format("o_orderdate", "dd-MMM-yyyy"))
    table(spark, sf, "orders").select(F.col("o_orderkey").alias("**FILING"), date.alias("SUBMISSION\nDATE")).write.options(header=True, multiLine=True).csv(path)
    return files.read_listing(spark, path, ["filing", "submission_date"], ["submission_date"]).drop("symbol")


@query("a04_union_dedupe", "SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL")
def a04(spark, sf):
    x = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return files.union_dedupe([x.where("l_partkey % 2 = 0"), x.where("l_partkey % 2 = 1")], ["l_orderkey", "l_linenumber"], [F.col("l_partkey")])


def _instances(spark, sf):
    """One small XML instance for each part; every fiftieth one is broken."""
    p = table(spark, sf, "part")
    xml = F.concat(
        F.lit('<xbrl xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xmlns:in="urn:x"><context id="D"/><in:Size contextRef="D" unitRef="mm" decimals="0">'), "p_size",
        F.lit('</in:Size><in:Name contextRef="D">'), "p_name", F.lit('</in:Name><in:Note contextRef="D" xsi:nil="true"/>'), F.when(F.col("p_partkey") % 50 == 0, "<open>").otherwise(""), F.lit("</xbrl>"),
    )
    return p.select(F.col("p_partkey").cast("string").alias("filing_id"), xml.alias("content"))


@query("a05_parse_filings", """SELECT CAST(p_partkey AS VARCHAR) AS filing_id, concept, unit_ref, raw_value, concept = 'Note' AS is_nil, concept = 'Size' AS is_numeric FROM (
SELECT p_partkey, 'Size' AS concept, 'mm' AS unit_ref, CAST(p_size AS VARCHAR) AS raw_value FROM part UNION ALL SELECT p_partkey, 'Name', NULL, p_name FROM part UNION ALL SELECT p_partkey, 'Note', NULL, NULL FROM part) WHERE p_partkey % 50 <> 0""")
def a05(spark, sf):
    good, _ = files.quarantine(files.parse_filings(_instances(spark, sf)))
    return good.select("filing_id", "concept", "unit_ref", "raw_value", "is_nil", "is_numeric")


@query("a06_dimension_key", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'FlagAxis=' || l_returnflag || '|StatusAxis=' || l_linestatus AS dimension_key FROM lineitem")
def a06(spark, sf):
    members = F.array(F.struct(F.lit("in:StatusAxis").alias("axis"), F.concat(F.lit("in:"), "l_linestatus").alias("member")), F.struct(F.lit("in:FlagAxis").alias("axis"), F.concat(F.lit("in:"), "l_returnflag").alias("member")))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", files.dimension_key(members).alias("dimension_key"))


@query("a07_split_long_text", "SELECT doc_id, CASE WHEN lang = 'de' OR length(text) > 1000 THEN 'text_facts' ELSE 'facts' END AS kind FROM documents WHERE text IS NOT NULL")
def a07(spark, sf):
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", "text", F.when(F.col("lang") == "de", "NoteTextBlock").otherwise("Note").alias("concept"))
    short, long = files.split_long_text(d, "text", "concept")
    return short.select("doc_id", F.lit("facts").alias("kind")).unionByName(long.select("doc_id", F.lit("text_facts").alias("kind")))


@query("a09_filing_summary", "SELECT l_suppkey, count(*) AS n_facts, count(*) FILTER (WHERE l_tax > 0) AS n_numeric, count(*) FILTER (WHERE l_tax <= 0) AS n_text, count(*) FILTER (WHERE l_discount = 0) AS n_nil, count(DISTINCT l_partkey) AS n_concepts, count(DISTINCT l_returnflag) AS n_units FROM lineitem GROUP BY 1")
def a09(spark, sf):
    return files.filing_summary(table(spark, sf, "lineitem"), "l_suppkey", "l_partkey", "l_returnflag", F.col("l_tax") > 0, F.col("l_discount") == 0)


@query("a10_main_period", """SELECT l_orderkey, l_partkey, CAST(round((date_diff('day', CAST(s AS DATE), CAST(e AS DATE)) + 1) / 30.4375::DOUBLE) AS INTEGER) AS period_months FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY e DESC, q DESC, s, l_partkey) AS k FROM (
SELECT l_orderkey, l_partkey, min(l_shipdate) AS s, max(l_shipdate) AS e, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY ALL)) WHERE k = 1""")
def a10(spark, sf):
    c = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.min("l_shipdate").alias("s"), F.max("l_shipdate").alias("e"), F.sum(F.col("l_quantity").cast("long")).alias("q"))
    return files.main_period(c, "l_orderkey", "s", "e", "q", "l_partkey").select("l_orderkey", "l_partkey", "period_months")


@query("a11_with_quarantine", "SELECT CAST(p_partkey AS VARCHAR) AS filing_id, 'ParseError' AS error FROM part WHERE p_partkey % 50 = 0")
def a11(spark, sf):
    return files.quarantine(files.parse_filings(_instances(spark, sf)))[1].select("filing_id", "error")


@query("a12_replace_keys", "SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 3 = 0 THEN 2 ELSE 1 END AS run, CAST(year(o_orderdate) + CASE WHEN o_custkey % 3 = 0 AND year(o_orderdate) < 1998 THEN 4 ELSE 0 END AS INTEGER) AS period FROM orders WHERE o_custkey % 3 = 0 OR year(o_orderdate) <> 1995 UNION ALL SELECT o_orderkey, o_custkey, 1, 2001 FROM orders WHERE o_custkey % 3 <> 0 AND year(o_orderdate) = 1995")
def a12(spark, sf):
    path = files.workspace(spark)
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.lit(1).alias("run"), F.year("o_orderdate").alias("period"))
    files.replace_keys(spark, path, o, "o_orderkey", "period")
    # rows that stay in their partition and rows that move to another one; then one partition that loses all its rows
    moved = o.where("o_custkey % 3 = 0").withColumns({"run": F.lit(2), "period": F.when(F.col("period") < 1998, F.col("period") + 4).otherwise(F.col("period"))})
    files.replace_keys(spark, path, moved, "o_orderkey", "period")
    return files.replace_keys(spark, path, o.where("o_custkey % 3 <> 0 AND period = 1995").withColumn("period", F.lit(2001)), "o_orderkey", "period")


@query("a13_intake", """WITH f AS (SELECT c_custkey, 'F' || c_custkey || '.xml' AS file_name, sha256(c_mktsegment || (c_custkey % 400)) AS sha256, CASE WHEN c_custkey % 4 = 0 THEN 'OWN' || c_custkey END AS own FROM customer),
l AS (SELECT 'F' || c_custkey || '.xml' AS file_name, 1 + (c_custkey % 11 = 0)::INT AS m, 'S' || c_nationkey AS symbol, CASE WHEN c_custkey % 4 = 1 THEN 'LST' || c_custkey END AS listed FROM customer WHERE c_custkey % 7 <> 0)
SELECT f.file_name, sha256, l.symbol, CASE WHEN f.file_name <> min(f.file_name) OVER (PARTITION BY sha256) THEN 'duplicate' WHEN m IS NULL THEN 'unmatched' WHEN m > 1 THEN 'ambiguous' ELSE 'received' END AS status, coalesce(own, listed, 'U' || n_name) AS isin,
CASE WHEN own IS NOT NULL THEN 'own' WHEN listed IS NOT NULL THEN 'listing' WHEN n_name IS NOT NULL THEN 'universe' END AS isin_source, coalesce(own <> 'U' || n_name, false) AS isin_conflict FROM f LEFT JOIN l USING (file_name) LEFT JOIN nation ON l.symbol = 'S' || n_nationkey""")
def a13(spark, sf):
    c = table(spark, sf, "customer")
    name = F.concat(F.lit("F"), "c_custkey", F.lit(".xml")).alias("file_name")
    got = c.select(name, F.concat("c_mktsegment", (F.col("c_custkey") % 400).cast("string")).cast("binary").alias("content"), F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("OWN"), "c_custkey")).alias("own_isin"))
    listed = c.where("c_custkey % 7 <> 0").select(name, F.concat(F.lit("S"), "c_nationkey").alias("symbol"), F.when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("LST"), "c_custkey")).alias("listed_isin"), F.explode(F.when(F.col("c_custkey") % 11 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")).drop("_copy")
    universe = table(spark, sf, "nation").select(F.concat(F.lit("S"), "n_nationkey").alias("symbol"), F.concat(F.lit("U"), "n_name").alias("isin"))
    return files.intake(got, listed, universe)


@query("a14_filing_status", "SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'received' WHEN c_acctbal > 0 THEN 'missing' ELSE 'listed_unavailable' END AS status FROM customer")
def a14(spark, sf):
    got = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return files.filing_status(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), got, ["c_custkey"], F.col("c_acctbal") > 0).drop("c_acctbal")


@query("a15_versions", "SELECT coalesce(a.version, b.version) AS version, coalesce(n, 0) AS n_used, b.version IS NOT NULL AS on_disk FROM (SELECT nullif(regexp_extract(p_brand, '#([0-9]+)$', 1), '') AS version, count(*) AS n FROM part GROUP BY 1) a FULL JOIN (SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS version FROM nation WHERE n_nationkey % 2 = 0) b USING (version)")
def a15(spark, sf):
    on_disk = table(spark, sf, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("string").alias("version"))
    return files.versions(table(spark, sf, "part"), "p_brand", on_disk, r"#([0-9]+)$")


@query("a16_build_concept_map", """WITH d AS (SELECT DISTINCT p_type AS version, p_name AS concept FROM part WHERE p_size > 10), u AS (SELECT DISTINCT p_type AS version, p_name AS concept FROM part WHERE p_retailprice > 950), b AS (SELECT * FROM d INTERSECT SELECT * FROM u),
w AS (SELECT p_name AS metric, p_name AS concept, 0 AS k FROM (SELECT DISTINCT p_name FROM part) UNION ALL SELECT p_name, replace(p_name, 'new', 'old'), 1 FROM (SELECT DISTINCT p_name FROM part WHERE p_name LIKE 'new%'))
SELECT metric, version, concept FROM (SELECT *, row_number() OVER (PARTITION BY metric, version ORDER BY k, concept) AS n FROM w JOIN b USING (concept)) WHERE n = 1""")
def a16(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_type").alias("version"), F.col("p_name").alias("concept"), "p_size", "p_retailprice")
    names = p.select("concept").distinct()
    renames = names.where("concept LIKE 'new%'").select("concept", F.replace(F.col("concept"), F.lit("new"), F.lit("old")).alias("predecessor"))
    return files.build_concept_map(names.select(F.col("concept").alias("metric"), "concept"), p.where("p_size > 10").distinct(), p.where("p_retailprice > 950"), renames).select("metric", "version", "concept")


@query("a17_tree_leaves", "SELECT 'c' || c_custkey AS node, CAST(3 AS INTEGER) AS depth FROM customer UNION ALL SELECT 'n' || n_nationkey, 2 FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)")
def a17(spark, sf):
    edge = lambda d, parent, child: d.select(parent.alias("parent"), child.alias("child"))
    r = edge(table(spark, sf, "region"), F.lit("world"), F.concat(F.lit("r"), "r_regionkey"))
    n = edge(table(spark, sf, "nation"), F.concat(F.lit("r"), "n_regionkey"), F.concat(F.lit("n"), "n_nationkey"))
    c = edge(table(spark, sf, "customer"), F.concat(F.lit("n"), "c_nationkey"), F.concat(F.lit("c"), "c_custkey"))
    return files.tree_leaves(spark, r.unionByName(n).unionByName(c), "world")


@query("a18_typed_seed", "SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS code, n_name AS label, n_nationkey * 1.5::DOUBLE AS weight FROM nation")
def a18(spark, sf):
    path = files.workspace(spark)
    table(spark, sf, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("code"), F.col("n_name").alias("label"), (F.col("n_nationkey") * 1.5).alias("weight")).write.option("header", True).csv(path)
    return files.typed_seed(spark, path, "code string, label string, weight double")


@query("a19_write_export", SUPPLIER_YEAR + "SELECT entity, period, round(renewable_share, 6) AS renewable_share, CAST(turnover_cents AS DOUBLE) AS turnover FROM p")
def a19(spark, sf):
    out = supplier_year(spark, sf).select("entity", "period", "renewable_share", F.col("turnover_cents").cast("decimal(20,2)").alias("turnover"))
    return files.write_export(out, files.workspace(spark))


@query("a20_write_results", "SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY 1")
def a20(spark, sf):
    path = files.workspace(spark)
    files.write_results({"segments": table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))}, path, "json")
    return spark.read.schema("c_mktsegment string, n long").json(f"{path}/segments")


@query("a21_star_export", SUPPLIER_YEAR + "SELECT s_suppkey AS entity, s_name AS name, s_suppkey IN (SELECT entity FROM p GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT period) FROM p)) AS in_balanced_panel FROM supplier")
def a21(spark, sf):
    from ..operators.window import balanced_panel

    p = supplier_year(spark, sf)
    whole = balanced_panel(p, "entity", "period").select("entity").distinct().withColumn("_in", F.lit(True))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("name"))
    return s.join(whole, "entity", "left").select("entity", "name", F.coalesce("_in", F.lit(False)).alias("in_balanced_panel"))


@query("a22_days_without_orders", "SELECT CAST(day AS DATE) AS day FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS day) WHERE CAST(day AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)")
def a22(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    return files.day_spine(spark, "1995-01-01", "2001-12-31").join(days, "day", "left_anti")


@query("a23_explore_json_axes", "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1 ORDER BY n DESC, k LIMIT 10")
def a23(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.from_json("props", "k long")["k"].alias("k"))
    return e.groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("n_users")).orderBy(F.col("n").desc(), "k").limit(10)


@query("a24_inbox_stream", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def a24(spark, sf):
    inbox, out = files.workspace(spark), files.workspace(spark)
    schema = "event_id long, event_type string"
    table(spark, sf, "events").select("event_id", "event_type").repartition(4).write.parquet(inbox)
    process_inbox(spark, inbox, schema, lambda batch, i: batch.write.mode("overwrite").parquet(f"{out}/batch={i}"), files.workspace(spark))
    return spark.read.schema(schema).parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query("a24_inbox_upsert", """WITH r AS (SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate)::INTEGER AS period, unnest(range(0, 1 + (o_orderkey % 3)::BIGINT))::INTEGER AS revision FROM orders)
SELECT o_orderkey, o_custkey, period, max(revision)::INTEGER AS revision, round(arg_max(o_totalprice + revision, revision), 2) AS price FROM r GROUP BY ALL""")
def a24b(spark, sf):
    """Orders arrive as JSON files, in several revisions, some of them late and some files twice."""
    inbox, table_, manifest, checkpoint = (files.workspace(spark) for _ in range(4))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("period"), "o_totalprice")
    rows = o.withColumn("revision", F.explode(F.sequence(F.lit(0), (F.col("o_orderkey") % 3).cast("int")))).withColumn("price", F.round(F.col("o_totalprice") + F.col("revision"), 2)).drop("o_totalprice")
    schema = rows.schema
    out = None
    for send in ([2], [0, 2], [1]):  # the last revisions first; the second call sends the first one's rows again
        rows.where(F.col("revision").isin(send)).repartition(3, "revision", "o_orderkey").sortWithinPartitions("revision", "o_orderkey").write.mode("append").json(inbox)
        parse = lambda f: f.select(F.from_json("line", schema).alias("r")).select("r.*")
        out = upsert_inbox(spark, inbox, parse, table_, manifest, checkpoint, "o_orderkey", ["revision", "price"], "period", 4, lines=True)
    return out.select("o_orderkey", "o_custkey", "period", "revision", "price")


_EDGES = """e AS (SELECT 'world' AS parent, 'r' || r_regionkey AS child, -r_regionkey::INTEGER AS ord FROM region UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey, n_nationkey::INTEGER FROM nation
UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey, (c_custkey % 7)::INTEGER FROM customer UNION ALL SELECT 'r' || n_regionkey, 'c' || c_custkey, 1000 FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal < 0)"""


@query("a17_tree_rows", f"""WITH RECURSIVE {_EDGES}, d AS (SELECT child AS indicator, child AS node, [{{'ord': ord, 'name': child}}] AS path FROM e WHERE parent = 'world' AND NOT regexp_matches(child, '^r3$')
UNION ALL SELECT indicator, child, list_append(path, {{'ord': ord, 'name': child}}) FROM d JOIN e ON e.parent = d.node),
m AS (SELECT indicator, node, min(path) AS path FROM d WHERE node NOT LIKE '%9' AND node IN (SELECT 'c' || c_custkey FROM customer UNION ALL SELECT 'n' || n_nationkey FROM nation) GROUP BY ALL),
f AS (SELECT indicator, row_number() OVER (ORDER BY min(path[1]))::INTEGER AS indicator_seq FROM m GROUP BY 1)
SELECT indicator, indicator_seq, node AS concept, row_number() OVER (PARTITION BY indicator ORDER BY path)::INTEGER AS position FROM m JOIN f USING (indicator)""")
def a17b(spark, sf):
    edge = lambda d, parent, child, ord: d.select(parent.alias("parent"), child.alias("child"), ord.cast("int").alias("ord"))
    region, nation, customer = (table(spark, sf, t) for t in ("region", "nation", "customer"))
    c = F.concat(F.lit("c"), "c_custkey")
    edges = edge(region, F.lit("world"), F.concat(F.lit("r"), "r_regionkey"), -F.col("r_regionkey")).unionByName(edge(nation, F.concat(F.lit("r"), "n_regionkey"), F.concat(F.lit("n"), "n_nationkey"), F.col("n_nationkey")))
    edges = edges.unionByName(edge(customer, F.concat(F.lit("n"), "c_nationkey"), c, F.col("c_custkey") % 7))
    # customers in debt hang under their region too
    edges = edges.unionByName(edge(customer.where("c_acctbal < 0").join(nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), "c_nationkey"), F.concat(F.lit("r"), "n_regionkey"), c, F.lit(1000)))
    reportable = customer.select(c.alias("node")).unionByName(nation.select(F.concat(F.lit("n"), "n_nationkey").alias("node")))
    return files.tree_rows(spark, edges, "world", reportable, "^r3$|9$")
