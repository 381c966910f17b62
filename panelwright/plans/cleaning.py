"""Queries of the cleaning functions, over columns of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from .bindings import SUPPLIER_YEAR, r6, supplier_year, table
from .registry import query


def _texts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


@query("b01_strip_ns_prefix", "SELECT doc_id, regexp_replace(source || ':' || lang, '^[^:]+:', '') AS unit FROM documents")
def b01(spark, sf):
    return table(spark, sf, "documents").select("doc_id", clean.strip_ns_prefix(F.concat("source", F.lit(":"), "lang")).alias("unit"))


_ANSWER = "CASE event_id % 7 WHEN 0 THEN ' NA ' WHEN 1 THEN 'n.a.' WHEN 2 THEN '--' WHEN 3 THEN 'Nil' WHEN 4 THEN 'Not Applicable' WHEN 5 THEN NULL ELSE event_type END"


@query("b02_is_na_text", f"""SELECT event_id, coalesce(regexp_full_match(lower(trim(a)), '(na|n\\.a\\.?|n/a|not applicable|-+)'), false) AS is_na FROM (SELECT event_id, {_ANSWER} AS a FROM events)""")
def b02(spark, sf):
    return table(spark, sf, "events").select("event_id", clean.is_na_text(F.expr(_ANSWER)).alias("is_na"))


@query("b03_fiscal_year_label", """SELECT o_orderkey, CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END AS INTEGER) AS fy_start,
  'FY' || (year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END) || '-' || lpad(CAST((year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END + 1) % 100 AS VARCHAR), 2, '0') AS fy_label FROM orders""")
def b03(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", clean.fiscal_year_start(d).alias("fy_start"), clean.fiscal_year_label(d).alias("fy_label"))


@query("b04_iso_duration_days", """SELECT event_id, TRY_CAST(nullif(regexp_extract(CASE WHEN event_id % 3 = 0 THEN 'P' || user_id || 'D' WHEN event_id % 3 = 1 THEN 'PT' || user_id || 'H' END, '^P([0-9]+(?:\\.[0-9]+)?)D$', 1), '') AS DOUBLE) AS days FROM events""")
def b04(spark, sf):
    text = F.expr("CASE WHEN event_id % 3 = 0 THEN concat('P', user_id, 'D') WHEN event_id % 3 = 1 THEN concat('PT', user_id, 'H') END")
    return table(spark, sf, "events").select("event_id", clean.iso_duration_days(text).alias("days"))


_NUMBER = "CASE p_partkey % 4 WHEN 0 THEN concat('1,', lpad(CAST(p_size AS STRING), 3, '0'), ' ') WHEN 1 THEN concat(CAST(p_size AS STRING), '.5') WHEN 2 THEN p_name END"


@query("b05_number_from_text", f"""SELECT p_partkey, TRY_CAST(regexp_replace(t, '[,\\s ]', '', 'g') AS DOUBLE) AS number FROM (SELECT p_partkey, {_NUMBER.replace("STRING", "VARCHAR")} AS t FROM part)""")
def b05(spark, sf):
    return table(spark, sf, "part").select("p_partkey", clean.number_from_text(F.expr(_NUMBER)).alias("number"))


@query("b06_normalise_text_key", "SELECT c_custkey, trim(regexp_replace(lower('  ' || c_name || '   ' || c_mktsegment || ' '), '\\s+', ' ', 'g')) AS key FROM customer")
def b06(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", clean.normalise_text_key(F.concat(F.lit("  "), "c_name", F.lit("   "), "c_mktsegment", F.lit(" "))).alias("key"))


_KEY = "CASE WHEN l_returnflag = 'N' THEN '' ELSE concat('Flag=', l_returnflag, '|Status=', l_linestatus) END"


@query("b07_dimension_axes", f"""SELECT k AS dimension_key, array_to_string(CASE WHEN k = '' THEN [] ELSE list_transform(string_split(k, '|'), lambda d: split_part(d, '=', 1)) END, ';') AS axes, count(*) AS n
FROM (SELECT {_KEY} AS k FROM lineitem) GROUP BY ALL""")
def b07(spark, sf):
    keys = table(spark, sf, "lineitem").groupBy(F.expr(_KEY).alias("dimension_key")).agg(F.count("*").alias("n"))
    return keys.select("dimension_key", F.array_join(clean.dimension_axes(F.col("dimension_key")), ";").alias("axes"), "n")


@query("b08_default_unit_for", """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'INR' WHEN 'SMALL' THEN 'tCO2e' WHEN 'LARGE' THEN 'GJ' WHEN 'PROMO' THEN 'kL' ELSE 'pure' END AS unit FROM part""")
def b08(spark, sf):
    return table(spark, sf, "part").select("p_partkey", clean.mapped(F.col("p_type"), {"ECONOMY": "INR", "SMALL": "tCO2e", "LARGE": "GJ", "PROMO": "kL"}, F.lit("pure")).alias("unit"))


@query("b09_round_sig", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN v = 0 THEN v ELSE CAST(printf('%.12e', v) AS DOUBLE) END AS v13 FROM (SELECT *, l_extendedprice * l_discount AS v FROM lineitem)""")
def b09(spark, sf):
    v = F.col("l_extendedprice") * F.col("l_discount")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", clean.round_sig(v, 13).alias("v13"))


@query("b10_unit_resolution_method", """SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 'matched' WHEN contains(p_name, 'bolt') THEN 'companion' WHEN contains(p_name, 'gizmo') THEN 'default' ELSE 'as filed' END AS method FROM part""")
def b10(spark, sf):
    return table(spark, sf, "part").select("p_partkey", clean.first_containing(F.col("p_name"), [("ring", "matched"), ("bolt", "companion"), ("gizmo", "default")], "as filed").alias("method"))


_RATIO = "CASE WHEN entity % 5 = 0 THEN 1e5 WHEN entity % 7 = 0 THEN 1e-3 ELSE 1.0 END * original / nullif(restated, 0)"


@query("b11_is_scale_error", SUPPLIER_YEAR + f"""SELECT entity, period, coalesce(CASE WHEN entity % 2 = 0 THEN r >= 10 OR r <= 0.1 ELSE r > 100 OR r < 0.01 END, false) AS scale_error FROM (SELECT *, {_RATIO} AS r FROM p)""")
def b11(spark, sf):
    return supplier_year(spark, sf).select("entity", "period", clean.is_scale_error(F.expr(_RATIO), F.expr("entity % 2 = 0")).alias("scale_error"))


@query("b12_nearest_power_basis", SUPPLIER_YEAR + f"""SELECT entity, period, CASE WHEN r BETWEEN 0.75 AND 1.25 THEN 1.0::DOUBLE WHEN r BETWEEN 75000 AND 125000 THEN 1e5 WHEN r BETWEEN 750000 AND 1250000 THEN 1e6 WHEN r BETWEEN 7500000 AND 12500000 THEN 1e7 END AS basis FROM (SELECT *, {_RATIO} AS r FROM p)""")
def b12(spark, sf):
    return supplier_year(spark, sf).select("entity", "period", clean.nearest_power_basis(F.expr(_RATIO)).alias("basis"))


@query("b13_reweighted_mean", SUPPLIER_YEAR + """SELECT entity, period, round(CASE WHEN n >= 2 THEN (coalesce(0.3 * women_share, 0) + coalesce(0.3 * renewable_share, 0) + coalesce(0.4 * emissions, 0)) / nullif(w, 0) END, 6) AS score
FROM (SELECT *, (women_share IS NOT NULL)::INT + (renewable_share IS NOT NULL)::INT + (emissions IS NOT NULL)::INT AS n,
  (CASE WHEN women_share IS NOT NULL THEN 0.3 ELSE 0 END)::DOUBLE + (CASE WHEN renewable_share IS NOT NULL THEN 0.3 ELSE 0 END)::DOUBLE + (CASE WHEN emissions IS NOT NULL THEN 0.4 ELSE 0 END)::DOUBLE AS w FROM p)""")
def b13(spark, sf):
    return supplier_year(spark, sf).select("entity", "period", r6(clean.reweighted_mean([F.col("women_share"), F.col("renewable_share"), F.col("emissions")], [0.3, 0.3, 0.4])).alias("score"))


_RAW = "CASE event_id % 6 WHEN 0 THEN CAST(user_id AS STRING) WHEN 1 THEN 'NA' WHEN 2 THEN '0' WHEN 3 THEN concat(CAST(user_id AS STRING), ' tonnes') WHEN 4 THEN NULL ELSE concat(' ', CAST(user_id AS STRING), '.25 ') END"


@query("b14_type_facts", f"""SELECT event_id, n AS numeric_value, raw IS NOT NULL AND n IS NULL AND NOT na AS cast_failed, coalesce(n = 0, false) AS is_zero, na AS is_na, CASE WHEN d = 'INF' THEN NULL ELSE TRY_CAST(d AS INTEGER) END AS decimals
FROM (SELECT event_id, raw, TRY_CAST(trim(raw) AS DOUBLE) AS n, coalesce(regexp_full_match(lower(trim(raw)), '(na|n\\.a\\.?|n/a|not applicable|-+)'), false) AS na, CASE WHEN event_id % 2 = 0 THEN 'INF' ELSE CAST(event_id % 3 AS VARCHAR) END AS d
FROM (SELECT event_id, {_RAW.replace("STRING", "VARCHAR")} AS raw FROM events))""")
def b14(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.expr(_RAW).alias("raw"), F.expr("CASE WHEN event_id % 2 = 0 THEN 'INF' ELSE CAST(event_id % 3 AS STRING) END").alias("d"))
    e = e.withColumns({"numeric_value": F.trim("raw").try_cast("double"), "is_na": clean.is_na_text(F.col("raw"))})
    return e.select("event_id", "numeric_value", (F.col("raw").isNotNull() & F.col("numeric_value").isNull() & ~F.col("is_na")).alias("cast_failed"), F.coalesce(F.col("numeric_value") == 0, F.lit(False)).alias("is_zero"), "is_na", F.when(F.col("d") != "INF", F.col("d").try_cast("int")).alias("decimals"))


@query("b15_type_contexts", """SELECT event_id, CAST(ts AS DATE) AS start_date, CAST(CASE WHEN event_id % 3 = 0 THEN 0 ELSE json_array_length('[' || props || ',' || props || ']') END AS INTEGER) AS n_dimensions, event_id % 3 <> 0 AS has_dimensions, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def b15(spark, sf):
    dims = F.when(F.col("event_id") % 3 == 0, F.lit("[]")).otherwise(F.concat(F.lit("["), "props", F.lit(","), "props", F.lit("]")))
    n = F.json_array_length(dims)
    return table(spark, sf, "events").select("event_id", F.to_date("ts").alias("start_date"), n.alias("n_dimensions"), (n > 0).alias("has_dimensions"), F.from_json("props", "k long")["k"].alias("k"))


@query("b16_type_units", """SELECT p_partkey, n || CASE WHEN d = '' THEN '' ELSE '/' || d END AS unit_label, d <> '' AS is_ratio, n = 'pure' AND d = '' AS is_pure FROM (
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'INR*' || lower(p_type) WHEN p_size % 3 = 1 THEN 'pure' ELSE 'INR' END AS n, CASE WHEN p_size % 2 = 0 AND p_size % 3 <> 1 THEN 'kWh' ELSE '' END AS d FROM part)""")
def b16(spark, sf):
    num = F.expr("CASE WHEN p_size % 3 = 0 THEN array('iso4217:INR', concat('utr:', lower(p_type))) WHEN p_size % 3 = 1 THEN array('xbrli:pure') ELSE array('iso4217:INR') END")
    den = F.expr("CASE WHEN p_size % 2 = 0 AND p_size % 3 <> 1 THEN array('utr:kWh') ELSE cast(array() as array<string>) END")
    strip = lambda a: F.transform(a, clean.strip_ns_prefix)
    part = table(spark, sf, "part").select("p_partkey", strip(num).alias("n"), strip(den).alias("d"))
    label = F.concat(F.array_join("n", "*"), F.when(F.size("d") > 0, F.concat(F.lit("/"), F.array_join("d", "*"))).otherwise(""))
    return part.select("p_partkey", label.alias("unit_label"), (F.size("d") > 0).alias("is_ratio"), ((F.size("d") == 0) & (F.col("n") == F.array(F.lit("pure")))).alias("is_pure"))


_NAME = "concat('‘', c_name, '’ (', c_mktsegment, ')  and Sons ', CASE WHEN c_custkey % 2 = 0 THEN 'Ltd.' ELSE 'LTD' END)"


@query("b20_clean_name", f"""SELECT c_custkey, trim(regexp_replace(regexp_replace(regexp_replace(translate(replace(n, '�', ''), '‘’“”', '''''""'), '\\([^)]*\\)', ' ', 'g'), '\\b[Ll][Tt][Dd]\\b\\.?', 'Limited', 'g'), '\\s+', ' ', 'g')) AS name FROM (SELECT c_custkey, {_NAME} AS n FROM customer)""")
def b20(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", clean.clean_name(F.expr(_NAME)).alias("name"))


@query("b21_title_case_if_upper", """SELECT c_custkey, CASE WHEN n = upper(n) AND n <> lower(n) THEN array_to_string(list_transform(string_split(n, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') ELSE n END AS name
FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || ' OF ' || upper(c_name) ELSE c_name END AS n FROM customer)""")
def b21(spark, sf):
    n = F.expr("CASE WHEN c_custkey % 2 = 0 THEN concat(c_mktsegment, ' OF ', upper(c_name)) ELSE c_name END")
    return table(spark, sf, "customer").select("c_custkey", clean.title_case_if_upper(n).alias("name"))


@query("b22_valid_code", "SELECT p_partkey, CASE WHEN regexp_matches(p_brand, '^Brand#[0-9]{2}$') THEN p_brand END AS code FROM part")
def b22(spark, sf):
    return table(spark, sf, "part").select("p_partkey", clean.valid_code(F.col("p_brand"), r"^Brand#[0-9]{2}$").alias("code"))


@query("b23_name_key", """SELECT doc_id, regexp_replace(regexp_replace(replace(strip_accents(lower(t)), '&', ' and '), '[^a-z0-9]+', '_', 'g'), '^_|_$', '', 'g') AS key FROM (SELECT doc_id, translate(text, 'ßœæ', 'sss') || ' & Co.' AS t FROM documents)""")
def b23(spark, sf):
    return _texts(spark, sf).select("doc_id", clean.name_key(F.concat(F.translate("text", "ßœæ", "sss"), F.lit(" & Co."))).alias("key"))


@query("b24_strip_html", "SELECT page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]*>|&nbsp;', ' ', 'g'), '\\s+', ' ', 'g'))) AS text_md5 FROM pages")
def b24(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(clean.strip_html(F.col("html"))).alias("text_md5"))


@query("b25_keyword_snippet", """SELECT doc_id, left(regexp_replace(s, 'https?://\\S+', '[link]', 'g'), 300) AS snippet FROM (SELECT doc_id, nullif(regexp_extract(text, '(?si).{0,120}\\b(?:license|licensed|token)\\b.{0,170}'), '') AS s FROM documents) WHERE s IS NOT NULL""")
def b25(spark, sf):
    return _texts(spark, sf).select("doc_id", clean.keyword_snippet(F.col("text"), "license|licensed|token").alias("snippet")).where("snippet is not null")


_FLAGS = [("l_discount > 0.05", "big_discount"), ("l_tax = 0", "untaxed"), ("l_returnflag = 'R'", "returned")]
_PACKED = "nullif(concat_ws('|', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n in _FLAGS) + "), '')"


@query("b26_pack_and_unpack_flags", f"SELECT flag, packed, count(*) AS n FROM (SELECT packed, unnest(string_split(packed, '|')) AS flag FROM (SELECT {_PACKED} AS packed FROM lineitem)) GROUP BY ALL")
def b26(spark, sf):
    packed = table(spark, sf, "lineitem").groupBy(clean.pack_flags([(F.expr(c), n) for c, n in _FLAGS]).alias("packed")).agg(F.count("*").alias("n"))
    return clean.unpack_flags(packed, "packed").select("flag", "packed", "n")


@query("b27_citation", "SELECT o_orderkey, 'Order ' || o_orderkey || ' of customer ' || o_custkey || ', ' || strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderstatus = 'P' THEN ' (revised)' ELSE '' END AS citation FROM orders")
def b27(spark, sf):
    text = F.concat(F.lit("Order "), "o_orderkey", F.lit(" of customer "), "o_custkey", F.lit(", "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderstatus") == "P", " (revised)").otherwise(""))
    return table(spark, sf, "orders").select("o_orderkey", text.alias("citation"))


@query("b28_select_except_and_replace", "SELECT * EXCLUDE (o_totalprice, o_orderdate) REPLACE (lower(o_orderpriority) AS o_orderpriority) FROM orders")
def b28(spark, sf):
    return clean.select_replace(clean.select_except(table(spark, sf, "orders"), "o_totalprice", "o_orderdate"), o_orderpriority=F.lower("o_orderpriority"))


@query("b29_safe_ratio", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_tax / nullif(l_discount, 0), 6) AS ratio FROM lineitem")
def b29(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r6(clean.safe_ratio(F.col("l_tax"), F.col("l_discount"))).alias("ratio"))


@query("b30_null_implausible_zeros", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN NOT (l_tax = 0 AND l_quantity > 25) THEN l_tax END AS l_tax, CASE WHEN NOT (l_discount = 0 AND l_returnflag = 'R') THEN l_discount END AS l_discount,
  nullif(concat_ws('|', CASE WHEN l_tax = 0 AND l_quantity > 25 THEN 'l_tax' END, CASE WHEN l_discount = 0 AND l_returnflag = 'R' THEN 'l_discount' END), '') AS zeros_dropped FROM lineitem""")
def b30(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_tax", "l_discount", "l_quantity", "l_returnflag")
    return clean.null_implausible_zeros(rows, {"l_tax": F.col("l_quantity") > 25, "l_discount": F.col("l_returnflag") == "R"}).drop("l_quantity", "l_returnflag")


@query("b31_predicates", """SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_orderpriority LIKE '%H%' AND o_totalprice BETWEEN 1000 AND 300000 AND o_custkey NOT BETWEEN 10 AND 20 AND 'O' IN (o_orderstatus, o_orderpriority) AND (o_orderdate > DATE '1996-01-01') IS DISTINCT FROM false""")
def b31(spark, sf):
    o = table(spark, sf, "orders")
    keep = F.col("o_orderstatus").isin("O", "P") & F.col("o_orderpriority").like("%H%") & F.col("o_totalprice").between(1000, 300000) & ~F.col("o_custkey").between(10, 20)
    return o.where(keep & F.lit("O").isin(F.col("o_orderstatus"), F.col("o_orderpriority")) & ~(F.col("o_orderdate") > F.lit("1996-01-01").cast("date")).eqNullSafe(F.lit(False))).select("o_orderkey")


@query("a08_stable_row_id", "SELECT p_partkey, left(sha256(CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END || '|' || CASE WHEN p_size % 3 = 1 THEN '' ELSE p_brand END || '|' || p_size), 32) AS row_id FROM part")
def a08(spark, sf):
    kept = lambda c, k: F.when(F.col("p_size") % 3 != k, F.col(c)).alias(c)  # noqa: E731  (nulls in one column or another)
    return table(spark, sf, "part").select("p_partkey", kept("p_name", 0), kept("p_brand", 1), "p_size").select("p_partkey", clean.stable_row_id("p_name", "p_brand", "p_size").alias("row_id"))


@query("b17_type_filings", """SELECT o_orderkey, coalesce(c_name, 'unknown') AS label, 'FY' || fy || '-' || lpad(CAST((fy + 1) % 100 AS VARCHAR), 2, '0') AS fy_label, coalesce(fy % 5 = n_nationkey % 5, false) AS label_matches
FROM (SELECT *, year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END AS fy FROM orders) LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0 LEFT JOIN nation ON n_nationkey = c_nationkey""")
def b17(spark, sf):
    c = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    n = F.broadcast(table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_nationkey").alias("_n")))
    o = table(spark, sf, "orders").join(c, "o_custkey", "left").join(n, "c_nationkey", "left")
    matches = F.coalesce(clean.fiscal_year_start(F.col("o_orderdate")) % 5 == F.col("_n") % 5, F.lit(False))
    return o.select("o_orderkey", F.coalesce("c_name", F.lit("unknown")).alias("label"), clean.fiscal_year_label(F.col("o_orderdate")).alias("fy_label"), matches.alias("label_matches"))


@query("b18_type_listing", "SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS has_order, c_nationkey IN (SELECT s_nationkey FROM supplier) AS has_near_supplier FROM customer")
def b18(spark, sf):
    ordered = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("_o", F.lit(True))
    near = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("c_nationkey")).distinct().withColumn("_s", F.lit(True))
    c = table(spark, sf, "customer").join(ordered, "c_custkey", "left").join(near, "c_nationkey", "left")
    return c.select("c_custkey", F.col("_o").isNotNull().alias("has_order"), F.col("_s").isNotNull().alias("has_near_supplier"))


@query("b19_type_text_facts", "SELECT doc_id, trim(source) AS source, CAST(length(text) AS BIGINT) AS text_length, CAST(n_chars AS DOUBLE) AS declared FROM documents")
def b19(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.trim("source").alias("source"), F.length("text").cast("long").alias("text_length"), F.col("n_chars").cast("double").alias("declared"))
