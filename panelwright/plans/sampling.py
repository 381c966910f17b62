"""Queries of the statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import resampling as again
from ..operators import stats
from ..operators import window as win
from .bindings import CUSTOMER_YEAR, SUPPLIER_YEAR, customer_year, r6, supplier_year, table
from .questions import _PAIRS, _YOY, restatement_pairs, yoy_confidence
from .registry import query

#: Replicates of the registered resampling queries, and their seed.
N, SEED = 10_000, 1
_P = again.P


def _numbered(source: str, *keys: str) -> str:
    """Rows of a source with k, what each brings to its draws."""
    sql = f"SELECT *, {again.fifth(SEED + 1)}::BIGINT AS k0 FROM {source}"
    for i, key in enumerate(keys):
        last = f"k{i + 1}" if i + 1 < len(keys) else "k"
        sql = f"SELECT *, (k{i} + (({key})::BIGINT % {_P} + {_P}) % {_P} + 1) % {_P} AS a{i}, a{i} * a{i} % {_P} AS b{i}, b{i} * b{i} % {_P} AS c{i}, c{i} * a{i} % {_P} AS {last} FROM ({sql})"
    return f"({sql})"


def _drawn(source: str, *keys: str) -> str:
    """Rows of a source for each replicate r, with its draw h."""
    replicates = f"(SELECT r, r * r % {_P} AS r2, r2 * r2 % {_P} AS r4, r4 * r % {_P} AS y FROM (SELECT unnest(range(1, {N + 1}))::BIGINT AS r))"
    powers = f"(k + y) % {_P} AS d0, d0 * d0 % {_P} AS d1, d1 * d1 % {_P} AS d2, (d2 * d0 + {again.STEP}) % {_P} AS e0, e0 * e0 % {_P} AS e1, e1 * e1 % {_P} AS e2, e2 * e0 % {_P} AS h"
    return f"(SELECT * EXCLUDE (d0, d1, d2, e0, e1, e2) FROM (SELECT *, {powers} FROM {_numbered(source, *keys)}, {replicates}))"


#: How often a replicate takes a row, from its draw.
_WEIGHT = " + ".join(f"(h >= {c})::INT" for c in again.REACHES)
_FAR = "(count(*) FILTER (WHERE abs(x) >= abs(seen) - 1e-12) + 1)::DOUBLE / (count(x) + 1)"
_ENDS = "quantile_cont(x, 0.025) AS low, quantile_cont(x, 0.975) AS high"
_RANKED = SUPPLIER_YEAR + ", b AS (SELECT * FROM p WHERE emissions IS NOT NULL AND renewable_share IS NOT NULL), k AS (SELECT sector, period, rank() OVER (PARTITION BY sector, period ORDER BY emissions) + (count(*) OVER (PARTITION BY sector, period, emissions) - 1) / 2.0::DOUBLE AS rx, rank() OVER (PARTITION BY sector, period ORDER BY renewable_share) + (count(*) OVER (PARTITION BY sector, period, renewable_share) - 1) / 2.0::DOUBLE AS ry FROM b), s AS (SELECT sector, period, count(*) AS n, CASE WHEN stddev_pop(rx) > 0 AND stddev_pop(ry) > 0 THEN corr(rx, ry) END AS rho FROM k GROUP BY ALL)\n"


@query("s01_confirmed_changes", _YOY + "SELECT sector, period, status, count(*) AS n, round(median(change), 6) AS median_change FROM c GROUP BY ALL")
def s01(spark, sf):
    return yoy_confidence(customer_year(spark, sf)).groupBy("sector", "period", "status").agg(F.count("*").alias("n"), r6(F.median("change")).alias("median_change"))


@query("s02_restatement_directions", _PAIRS + "SELECT entity, period, flatters FROM r WHERE is_compared AND classification IN ('material', 'large')")
def s02(spark, sf):
    return restatement_pairs(supplier_year(spark, sf)).where("is_compared AND classification IN ('material', 'large')").select("entity", "period", "flatters")


@query("s03_spearman", _RANKED + "SELECT sector, period, n, round(rho, 6) AS rho FROM s")
def s03(spark, sf):
    return stats.spearman(supplier_year(spark, sf), "emissions", "renewable_share", ["sector", "period"]).withColumn("rho", r6("rho"))


@query("s04_pooled_rho", _RANKED + "SELECT count(*) AS n_groups, round(sum(rho * (n - 1)) / nullif(sum(n - 1), 0), 6) AS pooled_rho FROM s WHERE n >= 5 AND rho IS NOT NULL")
def s04(spark, sf):
    return stats.pooled_rho(supplier_year(spark, sf), "emissions", "renewable_share", ["sector", "period"]).withColumn("pooled_rho", r6("pooled_rho"))


@query("s05_stratified_permutation", _RANKED + f""", w AS (SELECT *, stddev_pop(rx) OVER g AS sx, stddev_pop(ry) OVER g AS sy, avg(rx) OVER g AS mx, avg(ry) OVER g AS my, count(*) OVER g AS n FROM
    (SELECT *, rank() OVER (PARTITION BY sector, period ORDER BY emissions) + (count(*) OVER (PARTITION BY sector, period, emissions) - 1) / 2.0::DOUBLE AS rx, rank() OVER (PARTITION BY sector, period ORDER BY renewable_share) + (count(*) OVER (PARTITION BY sector, period, renewable_share) - 1) / 2.0::DOUBLE AS ry FROM b) WINDOW g AS (PARTITION BY sector, period)),
  e AS (SELECT sector, period, entity, rx, ry, sx, sy, mx, my, n FROM w WHERE n >= 5 AND sx > 0 AND sy > 0),
  i AS (SELECT sector, period, rx AS got, row_number() OVER (PARTITION BY sector, period ORDER BY rx, entity) AS place FROM e),
  d AS (SELECT *, row_number() OVER (PARTITION BY r, sector, period ORDER BY h, entity) AS place FROM {_drawn("e", "entity")}),
  v AS (SELECT r, sector, period, any_value(n) AS n, (sum(got * ry) / any_value(n) - any_value(mx) * any_value(my)) / (any_value(sx) * any_value(sy)) AS rho FROM d JOIN i USING (sector, period, place) GROUP BY ALL),
  t AS (SELECT r, sum(rho * (n - 1)) / sum(n - 1) AS x FROM v GROUP BY 1), o AS (SELECT count(*) AS n_groups, sum(rho * (n - 1)) / nullif(sum(n - 1), 0) AS seen FROM s WHERE n >= 5 AND rho IS NOT NULL)
  SELECT n_groups, round(any_value(seen), 6) AS pooled_rho, round({_FAR}, 9) AS p FROM o LEFT JOIN t ON true GROUP BY n_groups""")
def s05(spark, sf):
    return again.stratified_permutation(supplier_year(spark, sf), "emissions", "renewable_share", ["sector", "period"], "entity", N, SEED).withColumns({"pooled_rho": r6("pooled_rho"), "p": F.round("p", 9)})


@query("s06_bootstrap_median", SUPPLIER_YEAR + f""", e AS (SELECT sector, entity, period, renewable_share AS v FROM p WHERE renewable_share IS NOT NULL),
  d AS (SELECT sector, r, v, {_WEIGHT} AS w FROM {_drawn("e", "entity", "period")}), c AS (SELECT sector, r, v, sum(w) OVER (PARTITION BY sector, r ORDER BY v) AS upto, sum(w) OVER (PARTITION BY sector, r) AS total FROM d),
  m AS (SELECT sector, r, (min(v) FILTER (WHERE upto >= floor((total + 1) / 2.0::DOUBLE)) + min(v) FILTER (WHERE upto >= ceil((total + 1) / 2.0::DOUBLE))) / 2 AS x FROM c WHERE total > 0 GROUP BY ALL),
  o AS (SELECT sector, count(*) AS n, median(v) AS median FROM e GROUP BY 1), q AS (SELECT sector, {_ENDS} FROM m GROUP BY 1)
  SELECT sector, n, round(median, 6) AS median, round(low, 6) AS low, round(high, 6) AS high FROM o LEFT JOIN q USING (sector)""")
def s06(spark, sf):
    out = again.bootstrap_median(supplier_year(spark, sf), "renewable_share", ["sector"], ["entity", "period"], N, SEED)
    return out.withColumns({c: r6(c) for c in ("median", "low", "high")})


@query("s06_bootstrap_interval", SUPPLIER_YEAR + f""", e AS (SELECT entity, period, renewable_share AS v FROM p WHERE renewable_share IS NOT NULL),
  d AS (SELECT r, v, {_WEIGHT} AS w FROM {_drawn("e", "entity", "period")}), c AS (SELECT r, v, sum(w) OVER (PARTITION BY r ORDER BY v) AS upto, sum(w) OVER (PARTITION BY r) AS total FROM d),
  m AS (SELECT r, (min(v) FILTER (WHERE upto >= floor((total + 1) / 2.0::DOUBLE)) + min(v) FILTER (WHERE upto >= ceil((total + 1) / 2.0::DOUBLE))) / 2 AS x FROM c WHERE total > 0 GROUP BY ALL)
  SELECT round(quantile_cont(x, 0.025), 6) AS low, round(quantile_cont(x, 0.975), 6) AS high FROM m""")
def s06c(spark, sf):
    """The median over all rows: one group."""
    out = again.bootstrap_median(supplier_year(spark, sf), "renewable_share", [], ["entity", "period"], N, SEED)
    return out.select(r6("low").alias("low"), r6("high").alias("high"))


@query("s06_bootstrap_pooled_rho")
def s06b(spark, sf):
    out = again.bootstrap_pooled_rho(supplier_year(spark, sf), "emissions", "renewable_share", ["sector", "period"], "entity", N, SEED)
    return out.withColumns({c: r6(c) for c in ("pooled_rho", "low", "high")})


@query("s07_wilcoxon_signed_rank", SUPPLIER_YEAR + """, c AS (SELECT entity, any_value(sector) AS sector, max(emissions) FILTER (WHERE period = 1996) AS a, max(emissions) FILTER (WHERE period = 2000) AS b FROM p GROUP BY 1),
  x AS (SELECT sector, ln(b / a) AS x FROM c WHERE a > 0 AND b > 0), k AS (SELECT *, rank() OVER (PARTITION BY sector ORDER BY abs(x)) + (count(*) OVER (PARTITION BY sector, abs(x)) - 1) / 2.0::DOUBLE AS r, count(*) OVER (PARTITION BY sector, abs(x)) AS t FROM x WHERE x <> 0),
  g AS (SELECT sector, count(*)::DOUBLE AS n, coalesce(sum(r) FILTER (WHERE x > 0), 0)::DOUBLE AS plus, sum(t * t - 1)::DOUBLE AS ties FROM k GROUP BY 1)
  SELECT sector, n::BIGINT AS n, round(plus, 6) AS plus, round(ties, 6) AS ties, CASE WHEN n > 0 THEN round(greatest(abs(plus - n * (n + 1) / 4) - 0.5, 0) / nullif(sqrt(n * (n + 1) * (2 * n + 1) / 24 - ties / 48), 0), 6) END AS z FROM g""")
def s07z(spark, sf):
    changes = stats.pair_changes(supplier_year(spark, sf), ["entity", "sector"], "period", "emissions", 1996, 2000)
    return stats.wilcoxon_signed_rank(changes, "log_change", ["sector"]).where("n > 0").select("sector", "n", r6("plus").alias("plus"), r6("ties").alias("ties"), r6("z").alias("z"))


@query("s07_wilcoxon_p")
def s07(spark, sf):
    """p is exact by counting sign patterns in small groups, so SQL has none; tests count them one by one."""
    changes = stats.pair_changes(supplier_year(spark, sf), ["entity", "sector"], "period", "emissions", 1996, 2000)
    return stats.wilcoxon_signed_rank(changes, "log_change", ["sector"]).select("sector", "n", r6("p").alias("p"))


@query("s08_pair_changes", CUSTOMER_YEAR + ", c AS (SELECT entity, any_value(sector) AS sector, max(emissions) FILTER (WHERE period = 1996) AS a, max(emissions) FILTER (WHERE period = 2000) AS b FROM p GROUP BY 1) SELECT sector, count(*) AS n, round(100 * (exp(median(ln(b / a))) - 1), 6) AS percent_effect FROM c WHERE a > 0 AND b > 0 GROUP BY 1")
def s08(spark, sf):
    changes = stats.pair_changes(customer_year(spark, sf), ["entity", "sector"], "period", "emissions", 1996, 2000)
    return changes.groupBy("sector").agg(F.count("*").alias("n"), r6(100 * (F.exp(F.median("log_change")) - 1)).alias("percent_effect"))


@query("s09_wilson_interval", "SELECT l_suppkey, k, n, round((s + z * z / (2 * n) - z * sqrt(s * (1 - s) / n + z * z / (4 * n * n))) / (1 + z * z / n), 6) AS low, round((s + z * z / (2 * n) + z * sqrt(s * (1 - s) / n + z * z / (4 * n * n))) / (1 + z * z / n), 6) AS high FROM (SELECT *, k::DOUBLE / n AS s, 1.959963984540054::DOUBLE AS z FROM (SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS k, count(*) AS n FROM lineitem GROUP BY 1))")
def s09(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("k"), F.count("*").alias("n"))
    low, high = stats.wilson_interval(F.col("k"), F.col("n"))
    return g.select("l_suppkey", "k", "n", r6(low).alias("low"), r6(high).alias("high"))


@query("s10_cluster_bootstrap_share", CUSTOMER_YEAR + f""", e AS (SELECT entity, count(*) FILTER (WHERE disclosed) AS a, count(*) AS m FROM p GROUP BY 1), d AS (SELECT r, a, m, {_WEIGHT} AS w FROM {_drawn("e", "entity")}),
  t AS (SELECT r, sum(w * a)::DOUBLE / nullif(sum(w * m), 0) AS x FROM d GROUP BY 1), o AS (SELECT sum(a)::DOUBLE / sum(m) AS share, sum(m)::BIGINT AS n_rows, count(*) AS n_clusters FROM e),
  q AS (SELECT {_ENDS}, var_pop(x) AS v, least(1.0, 2 * least(avg((x <= 0.5)::INT), avg((x >= 0.5)::INT))) AS p FROM t), f AS (SELECT *, CASE WHEN share > 0 AND share < 1 THEN v / (share * (1 - share) / n_rows) ELSE 1.0 END AS effect FROM o, q)
  SELECT round(share, 6) AS share, n_rows, n_clusters, round(low, 6) AS low, round(high, 6) AS high, round(p, 6)::DOUBLE AS p, round(effect, 6)::DOUBLE AS design_effect, greatest(1, round(n_rows / greatest(effect, 1.0)))::BIGINT AS n_effective FROM f""")
def s10(spark, sf):
    out = again.cluster_bootstrap_share(customer_year(spark, sf), "entity", "disclosed", N, SEED)
    return out.withColumns({c: r6(c) for c in ("share", "low", "high", "p", "design_effect")})


@query("s10_cluster_share", CUSTOMER_YEAR + "SELECT round(count(*) FILTER (WHERE disclosed)::DOUBLE / count(*), 6) AS share, count(*) AS n_rows, count(DISTINCT entity) AS n_clusters FROM p")
def s10b(spark, sf):
    return customer_year(spark, sf).agg(r6(F.count_if("disclosed") / F.count("*")).alias("share"), F.count("*").alias("n_rows"), F.countDistinct("entity").alias("n_clusters"))


_CELLS = "count(*) FILTER (WHERE disclosed AND has_event) AS n11, count(*) FILTER (WHERE disclosed AND NOT has_event) AS n10, count(*) FILTER (WHERE NOT disclosed AND has_event) AS n01, count(*) FILTER (WHERE NOT disclosed AND NOT has_event) AS n00"


@query("s11_two_by_two", CUSTOMER_YEAR + f", t AS (SELECT sector, {_CELLS} FROM p GROUP BY 1), e AS (SELECT *, CASE WHEN least(n11, n10, n01, n00) = 0 THEN 0.5 ELSE 0 END::DOUBLE AS x FROM t) SELECT sector, n11, n10, n01, n00, round((n11 + x) * (n00 + x) / ((n10 + x) * (n01 + x)), 6) AS odds_ratio FROM e")
def s11(spark, sf):
    return stats.two_by_two(customer_year(spark, sf), "disclosed", "has_event", ["sector"]).withColumn("odds_ratio", r6(stats.odds_ratio()))


_LOGS = "lgamma(r + 1) - lgamma(k + 1) - lgamma(r - k + 1) + lgamma(n - r + 1) - lgamma(c - k + 1) - lgamma(n - r - c + k + 1) - lgamma(n + 1) + lgamma(c + 1) + lgamma(n - c + 1)"


@query("s11_fisher_exact", CUSTOMER_YEAR + f""", t AS (SELECT sector, {_CELLS} FROM p GROUP BY 1), m AS (SELECT *, (n11 + n10)::DOUBLE AS r, (n11 + n01)::DOUBLE AS c, (n11 + n10 + n01 + n00)::DOUBLE AS n FROM t),
k AS (SELECT *, unnest(range(CAST(greatest(0, r + c - n) AS BIGINT), CAST(least(r, c) AS BIGINT) + 1))::DOUBLE AS k FROM m), l AS (SELECT *, {_LOGS} AS x FROM k), o AS (SELECT sector, x AS seen FROM l WHERE k = n11)
SELECT sector, n11, n10, n01, n00, round(least(1.0, sum(exp(x)) FILTER (WHERE x <= seen + 1e-7)), 6) AS p FROM l JOIN o USING (sector) GROUP BY ALL""")
def s11b(spark, sf):
    return stats.fisher_test(stats.two_by_two(customer_year(spark, sf), "disclosed", "has_event", ["sector"]), ["sector"]).withColumn("p", r6("p"))


@query("s09_binomial_exact", """WITH t AS (SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R')::DOUBLE AS k, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1), i AS (SELECT *, unnest(range(0, CAST(n AS BIGINT) + 1))::DOUBLE AS i FROM t),
l AS (SELECT *, lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + n * ln(0.5::DOUBLE) AS x FROM i), o AS (SELECT l_suppkey, x AS seen FROM l WHERE i = k) SELECT l_suppkey, round(least(1.0, sum(exp(x)) FILTER (WHERE x <= seen + 1e-7)), 6) AS p FROM l JOIN o USING (l_suppkey) GROUP BY 1""")
def s09b(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("k"), F.count("*").alias("n"))
    return stats.binomial_test(g, "k", "n").select("l_suppkey", r6("p").alias("p"))


_OWNERS = SUPPLIER_YEAR + """, e AS (SELECT entity, period, renewable_share AS v, ownership = 'public' AS l FROM p WHERE renewable_share IS NOT NULL),
  pairs AS (SELECT sum(sign(a.v - b.v))::DOUBLE / count(*) AS seen FROM e a JOIN e b ON a.period = b.period AND a.l AND NOT b.l)"""


@query("s14_bootstrap_delta", _OWNERS + f""", d AS (SELECT r, period, v, l, {_WEIGHT} AS w FROM {_drawn("e", "entity")}), g AS (SELECT r, period, v, sum(w) FILTER (WHERE l) AS w1, sum(w) FILTER (WHERE NOT l) AS w0 FROM d GROUP BY ALL),
  b AS (SELECT r, period, coalesce(w1, 0) AS w1, coalesce(w0, 0) AS w0, coalesce(sum(w0) OVER (PARTITION BY r, period ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
  u AS (SELECT r, period, sum(w1 * (below + w0 / 2.0::DOUBLE)) AS u, (sum(w1) * sum(w0))::DOUBLE AS n FROM b GROUP BY ALL), t AS (SELECT r, sum(2 * u - n) / nullif(sum(n), 0) AS x FROM u GROUP BY 1)
  SELECT round(any_value(seen), 6) AS delta, round(quantile_cont(x, 0.025), 6) AS low, round(quantile_cont(x, 0.975), 6) AS high FROM t, pairs""")
def s14b(spark, sf):
    p = supplier_year(spark, sf).select("entity", "period", "renewable_share", (F.col("ownership") == "public").alias("is_public"))
    out = again.bootstrap_delta(p, "entity", "renewable_share", "is_public", ["period"], N, SEED)
    return out.select(*(r6(c).alias(c) for c in ("delta", "low", "high")))


@query("s01_needs_review", CUSTOMER_YEAR + """, w AS (SELECT entity FROM p WHERE emissions IS NOT NULL GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT period) FROM p WHERE emissions IS NOT NULL)),
y AS (SELECT entity, period, emissions, lag(emissions) OVER k AS b, lead(emissions) OVER k AS a, lag(period) OVER k AS bp, lead(period) OVER k AS ap FROM p WINDOW k AS (PARTITION BY entity ORDER BY period)), s AS (SELECT entity, count(*) FILTER (WHERE bp = period - 1 AND ap = period + 1 AND (emissions > 2 * greatest(b, a) OR emissions * 2 < least(b, a))) AS n_spikes FROM y GROUP BY 1)
SELECT entity, n_spikes, n_spikes > 0 AS needs_review FROM s WHERE entity IN (SELECT entity FROM w)""")
def s01b(spark, sf):
    p = customer_year(spark, sf)
    whole = win.balanced_panel(p, "entity", "period", F.col("emissions").isNotNull())
    spikes = win.one_period_spikes(whole.select("entity", "period", "emissions"), "entity", "period", "emissions").groupBy("entity").agg(F.count("*").alias("n_spikes"))
    out = whole.select("entity").distinct().join(spikes, "entity", "left").withColumn("n_spikes", F.coalesce("n_spikes", F.lit(0)))
    return out.withColumn("needs_review", F.col("n_spikes") > 0)


@query("s02_restatements_by_entity_year", _PAIRS + "SELECT entity, period, count(*) FILTER (WHERE is_compared) AS n_compared, count(*) FILTER (WHERE flatters) AS n_flattering, max(abs(change)) IS NOT NULL AS has_change FROM r GROUP BY ALL")
def s02b(spark, sf):
    return restatement_pairs(supplier_year(spark, sf)).groupBy("entity", "period").agg(F.count_if("is_compared").alias("n_compared"), F.count_if("flatters").alias("n_flattering"), F.max(F.abs("change")).isNotNull().alias("has_change"))


@query("s02_disclosure_quality", SUPPLIER_YEAR + "SELECT entity, period, round((coalesce(renewable_share, 0) + coalesce(women_share, 0)) / 2, 6) AS quality, (renewable_share IS NULL)::INT + (women_share IS NULL)::INT AS n_missing FROM p WHERE disclosed")
def s02c(spark, sf):
    gone = lambda c: F.when(F.col(c).isNull(), 1).otherwise(0)
    return supplier_year(spark, sf).where("disclosed").select("entity", "period", r6((F.coalesce("renewable_share", F.lit(0.0)) + F.coalesce("women_share", F.lit(0.0))) / 2).alias("quality"), (gone("renewable_share") + gone("women_share")).alias("n_missing"))


@query("s02_years", CUSTOMER_YEAR + "SELECT period, count(*) AS n, count(*) >= 5 AS usable, row_number() OVER (ORDER BY period) = 1 AS is_first FROM p GROUP BY 1")
def s02d(spark, sf):
    y = customer_year(spark, sf).groupBy("period").agg(F.count("*").alias("n"))
    return y.crossJoin(F.broadcast(y.agg(F.min("period").alias("_first")))).select("period", "n", (F.col("n") >= 5).alias("usable"), (F.col("period") == F.col("_first")).alias("is_first"))


@query("s12_cluster_permutation", SUPPLIER_YEAR + f""", y AS (SELECT entity, period, untaxed * 9 > n_lines AS l, (events * 3 > n_lines)::INT AS f FROM p),
  e AS (SELECT entity, string_agg(period::VARCHAR, ',' ORDER BY period) AS pattern, list(l ORDER BY period) AS ls, list(f ORDER BY period) AS fs FROM y GROUP BY 1),
  i AS (SELECT pattern, ls AS got, row_number() OVER (PARTITION BY pattern ORDER BY ls, entity) AS place FROM e), d AS (SELECT r, pattern, fs, row_number() OVER (PARTITION BY r, pattern ORDER BY h, entity) AS place FROM {_drawn("e", "entity")}),
  o AS (SELECT sum(l::INT)::DOUBLE AS n1, sum((NOT l)::INT)::DOUBLE AS n0, sum(f)::DOUBLE AS a, sum(f) FILTER (WHERE l)::DOUBLE AS s FROM y),
  t AS (SELECT r, sum(list_sum(list_transform(list_zip(got, fs), lambda z: z[1]::INT * z[2])))::DOUBLE AS dot FROM d JOIN i USING (pattern, place) GROUP BY 1),
  x AS (SELECT dot / nullif(n1, 0) - (a - dot) / nullif(n0, 0) AS x, s / nullif(n1, 0) - (a - s) / nullif(n0, 0) AS seen FROM t, o)
  SELECT round(any_value(seen), 6) AS difference, round({_FAR}, 9) AS p FROM x""")
def s12(spark, sf):
    p = supplier_year(spark, sf).select("entity", "period", (F.col("untaxed") * 9 > F.col("n_lines")).alias("open"), (F.col("events") * 3 > F.col("n_lines")).alias("eventful"))
    return again.cluster_permutation(p, "entity", "period", "open", "eventful", N, SEED).select(r6("difference").alias("difference"), F.round("p", 9).alias("p"))


@query("s13_cliffs_delta", CUSTOMER_YEAR + """, a AS (SELECT * FROM p WHERE women_share IS NOT NULL), k AS (SELECT sector, period, women_share AS v, count(*) FILTER (WHERE disclosed) AS n1, count(*) FILTER (WHERE NOT disclosed) AS n0 FROM a GROUP BY ALL),
  b AS (SELECT *, coalesce(sum(n0) OVER (PARTITION BY sector, period ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM k), u AS (SELECT sector, period, sum(n1)::BIGINT AS n1, sum(n0)::BIGINT AS n0, sum(n1 * (below + n0 / 2.0::DOUBLE)) AS u FROM b GROUP BY ALL)
  SELECT sector, sum(n1)::BIGINT AS n1, sum(n0)::BIGINT AS n0, round(sum(2 * u - n1 * n0) / sum(n1 * n0), 6) AS delta FROM u WHERE n1 > 0 AND n0 > 0 GROUP BY 1""")
def s13(spark, sf):
    return stats.cliffs_delta(customer_year(spark, sf), "women_share", "disclosed", ["sector"], ["period"]).withColumn("delta", r6("delta"))


@query("s14_label_permutation", _OWNERS + f""", w AS (SELECT entity, period, rank() OVER (PARTITION BY period ORDER BY v) + (count(*) OVER (PARTITION BY period, v) - 1) / 2.0::DOUBLE AS rk, count(*) OVER (PARTITION BY period) AS size FROM e), own AS (SELECT entity, any_value(l) AS l FROM e GROUP BY 1),
  i AS (SELECT l AS got, row_number() OVER (ORDER BY l, entity) AS place FROM own), d AS (SELECT r, entity, row_number() OVER (PARTITION BY r ORDER BY h, entity) AS place FROM {_drawn("own", "entity")}),
  g AS (SELECT r, period, any_value(size)::DOUBLE AS size, count(*)::DOUBLE AS n1, sum(rk) AS s FROM d JOIN i USING (place) JOIN w USING (entity) WHERE got GROUP BY ALL),
  t AS (SELECT r, sum(2 * s - n1 * (n1 + 1) - n1 * (size - n1)) / nullif(sum(n1 * (size - n1)), 0) AS x FROM g GROUP BY 1)
  SELECT round(any_value(seen), 6) AS delta, round({_FAR}, 9) AS p FROM t, pairs""")
def s14(spark, sf):
    p = supplier_year(spark, sf).select("entity", "period", "renewable_share", (F.col("ownership") == "public").alias("is_public"))
    return again.label_permutation(p, "entity", "renewable_share", "is_public", ["period"], N, SEED).select(r6("delta").alias("delta"), F.round("p", 9).alias("p"))


@query("s15_mann_whitney", CUSTOMER_YEAR + """, b AS (SELECT * FROM p WHERE women_share IS NOT NULL), k AS (SELECT *, rank() OVER (PARTITION BY period ORDER BY women_share) + (count(*) OVER (PARTITION BY period, women_share) - 1) / 2.0::DOUBLE AS r, count(*) OVER (PARTITION BY period, women_share) AS t FROM b),
s AS (SELECT period, count(*) FILTER (WHERE disclosed) AS n1, count(*) FILTER (WHERE NOT disclosed) AS n0, sum(r) FILTER (WHERE disclosed) AS sr, sum(t * t - 1)::DOUBLE AS ties FROM k GROUP BY 1), u AS (SELECT *, sr - n1 * (n1 + 1) / 2.0::DOUBLE AS u, (n1 + n0)::DOUBLE AS n FROM s WHERE n1 > 0 AND n0 > 0)
SELECT period, n1, n0, u, round(sign(u - n1 * n0 / 2.0::DOUBLE) * greatest(abs(u - n1 * n0 / 2.0::DOUBLE) - 0.5, 0) / nullif(sqrt(n1 * n0 / 12.0::DOUBLE * ((n + 1) - ties / (n * nullif(n - 1, 0)))), 0), 6) AS z, round(2 * u / (n1 * n0) - 1, 6) AS delta FROM u""")
def s15(spark, sf):
    return stats.mann_whitney(customer_year(spark, sf), "women_share", "disclosed", ["period"]).withColumns({"z": r6("z"), "delta": r6("delta")})


_TESTS = "SELECT l_suppkey, round((abs(count(*) FILTER (WHERE l_returnflag = 'R') * 3 - count(*)) + 1.0::DOUBLE) / (count(*) + 1), 9) AS p, count(*) AS n FROM lineitem GROUP BY 1"


@query("s16_benjamini_hochberg", f"WITH t AS ({_TESTS}), a AS (SELECT *, p * count(*) OVER () / rank() OVER (ORDER BY p) AS x FROM t) SELECT l_suppkey, p, round(least(1.0, min(x) OVER (ORDER BY p DESC)), 6)::DOUBLE AS adjusted_p FROM a")
def s16(spark, sf):
    return stats.benjamini_hochberg(_tests(spark, sf), "p").select("l_suppkey", "p", r6("adjusted_p").alias("adjusted_p"))


def _tests(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("k"), F.count("*").alias("n"))
    return g.select("l_suppkey", F.round((F.abs(F.col("k") * 3 - F.col("n")) + 1.0) / (F.col("n") + 1), 9).alias("p"), "n")


@query("s17_outcomes", f"SELECT l_suppkey, CASE WHEN n < 10 THEN 'not enough data' WHEN p <= 0.05 THEN 'rejects' ELSE 'does not reject' END AS decision, n < 30 AND p > 0.05 AS likely_underpowered FROM ({_TESTS})")
def s17(spark, sf):
    return stats.outcomes(_tests(spark, sf), "p", "n").select("l_suppkey", "decision", "likely_underpowered")
