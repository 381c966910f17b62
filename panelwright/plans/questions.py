"""The business questions, each one result over a panel of entities and years."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import aggregate as agg
from ..operators import ordering as order
from ..operators import window as win
from ..operators.domain import classify_restatement
from .bindings import CUSTOMER_YEAR, SUPPLIER_YEAR, customer_year, r6, supplier_year
from .registry import query

RATIO = "sum(CASE WHEN emissions IS NOT NULL THEN emissions END) / nullif(sum(CASE WHEN emissions IS NOT NULL THEN turnover_cents END) / 1e8, 0)"
BALANCED = """, whole AS (SELECT entity FROM p WHERE emissions IS NOT NULL GROUP BY entity HAVING count(DISTINCT period) = (SELECT count(DISTINCT period) FROM p WHERE emissions IS NOT NULL)),
panels AS (SELECT 'all' AS panel, * FROM p UNION ALL SELECT 'balanced', * FROM p WHERE entity IN (SELECT entity FROM whole))
"""


def intensity() -> list:
    both = F.col("emissions").isNotNull()
    ratio = F.sum("emissions") / F.nullif(F.sum(F.when(both, F.col("turnover_cents"))) / 1e8, F.lit(0.0))
    return [r6(ratio).alias("intensity"), r6(F.median("intensity")).alias("median_intensity"), F.count(F.when(both, 1)).alias("n")]


def two_panels(p: DataFrame) -> DataFrame:
    """Each row once for the whole panel, and once more if its entity has a value in every period that occurs."""
    there = F.when(F.col("emissions").isNotNull(), F.col("period"))
    periods = F.broadcast(p.agg(F.countDistinct(there).alias("_periods")))  # one row
    marked = p.withColumn("_n", F.count(there).over(Window.partitionBy("entity"))).crossJoin(periods)
    panels = F.when(F.col("_n") == F.col("_periods"), F.array(F.lit("all"), F.lit("balanced"))).otherwise(F.array(F.lit("all")))
    return marked.withColumn("panel", F.explode(panels)).drop("_n", "_periods")


def _l1(spark, sf) -> DataFrame:
    return two_panels(customer_year(spark, sf)).groupBy("panel", "sector", "period").agg(*intensity())


_L1 = CUSTOMER_YEAR + BALANCED + f", l1 AS (SELECT panel, sector, period, round({RATIO}, 6) AS intensity, round(median(intensity), 6) AS median_intensity, count(emissions) AS n FROM panels GROUP BY ALL)"


@query("l01_intensity_by_sector", _L1 + " SELECT *, round(intensity / nullif(first_value(intensity) OVER (PARTITION BY panel, sector ORDER BY period), 0) - 1, 6) AS change FROM l1")
def l01(spark, sf):
    return _l1(spark, sf).withColumn("change", r6(win.change_vs_first("intensity", ["panel", "sector"], "period")))


@query("l02_composition_effect", _L1 + """, c AS (SELECT panel, sector, (arg_max(intensity, period) FILTER (WHERE intensity IS NOT NULL) / nullif(arg_min(intensity, period) FILTER (WHERE intensity IS NOT NULL), 0) - 1) AS change FROM l1 GROUP BY ALL)
SELECT sector, round(max(CASE WHEN panel = 'all' THEN change END), 6) AS change_all, round(max(CASE WHEN panel = 'balanced' THEN change END), 6) AS change_balanced, round(max(CASE WHEN panel = 'all' THEN change END) - max(CASE WHEN panel = 'balanced' THEN change END), 6) AS difference FROM c GROUP BY 1""")
def l02(spark, sf):
    ends = _l1(spark, sf).where("intensity is not null").groupBy("panel", "sector").agg((F.max_by("intensity", "period") / F.nullif(F.min_by("intensity", "period"), F.lit(0.0)) - 1).alias("change"))
    a, b = (F.max(F.when(F.col("panel") == x, F.col("change"))) for x in ("all", "balanced"))
    return ends.groupBy("sector").agg(r6(a).alias("change_all"), r6(b).alias("change_balanced"), r6(a - b).alias("difference"))


@query("l03_outside_the_balanced_panel", CUSTOMER_YEAR + BALANCED + """SELECT entity, count(*) AS n_periods, min(period) AS first_period, max(period) AS last_period,
CASE WHEN bool_and(emissions IS NULL) THEN 'never reported' WHEN bool_or(emissions IS NULL) THEN 'gaps' ELSE 'missing periods' END AS reason, string_agg(CAST(period AS VARCHAR), ',' ORDER BY period) AS periods FROM p WHERE entity NOT IN (SELECT entity FROM whole) GROUP BY 1""")
def l03(spark, sf):
    p = customer_year(spark, sf)
    balanced = win.balanced_panel(p, "entity", "period", F.col("emissions").isNotNull()).select("entity").distinct()
    missing = F.col("emissions").isNull()
    reason = F.when(F.bool_and(missing), "never reported").when(F.bool_or(missing), "gaps").otherwise("missing periods")
    return p.join(balanced, "entity", "left_anti").groupBy("entity").agg(F.count("*").alias("n_periods"), F.min("period").alias("first_period"), F.max("period").alias("last_period"), reason.alias("reason"), F.array_join(F.transform(F.array_sort(F.collect_list("period")), lambda x: x.cast("string")), ",").alias("periods"))


_SHARES = SUPPLIER_YEAR + """, s AS (SELECT *, row_number() OVER w AS position, turnover_cents::DOUBLE / sum(turnover_cents) OVER (PARTITION BY period) AS share,
sum(turnover_cents) OVER (PARTITION BY period ORDER BY turnover_cents DESC, entity ROWS UNBOUNDED PRECEDING)::DOUBLE / sum(turnover_cents) OVER (PARTITION BY period) AS running FROM p WINDOW w AS (PARTITION BY period ORDER BY turnover_cents DESC, entity))
"""


@query("l04_pareto_top10_by_year", _SHARES + "SELECT period, CAST(position AS INTEGER) AS position, entity, round(share, 6) AS share, round(running, 6) AS cumulative_share FROM s WHERE position <= 10")
def l04(spark, sf):
    c = win.concentration(supplier_year(spark, sf), "entity", "turnover_cents", "period", least=1)
    return c.where("position <= 10").select("period", "position", "entity", r6("share").alias("share"), r6("cumulative_share").alias("cumulative_share"))


@query("l05_concentration_by_year", _SHARES + """SELECT period, count(*) AS n_entities, round(max(CASE WHEN position = 1 THEN running END), 6) AS top1, round(max(CASE WHEN position = 5 THEN running END), 6) AS top5, round(max(CASE WHEN position = 10 THEN running END), 6) AS top10,
CAST(min(CASE WHEN running >= 0.8 THEN position END) AS INTEGER) AS entities_for_80, CAST(min(CASE WHEN running >= 0.9 THEN position END) AS INTEGER) AS entities_for_90 FROM s GROUP BY 1""")
def l05(spark, sf):
    c = win.concentration(supplier_year(spark, sf), "entity", "turnover_cents", "period", least=1)
    at = lambda k: r6(F.max(F.when(F.col("position") == k, F.col("cumulative_share")))).alias(f"top{k}")
    need = lambda x: F.min(F.when(F.col("cumulative_share") >= x / 100, F.col("position"))).alias(f"entities_for_{x}")
    return c.groupBy("period").agg(F.count("*").alias("n_entities"), at(1), at(5), at(10), need(80), need(90))


_YOY = CUSTOMER_YEAR + """, y AS (SELECT *, lag(emissions) OVER w AS before, lag(period) OVER w AS before_period, lead(emissions) OVER w AS after, lead(period) OVER w AS after_period FROM p WINDOW w AS (PARTITION BY entity ORDER BY period)),
z AS (SELECT *, emissions / nullif(before, 0) - 1 AS change, coalesce(after_period = period + 1 AND (emissions > 2 * before AND emissions > 2 * after OR emissions * 2 < before AND emissions * 2 < after), false) AS reversal FROM y WHERE before_period = period - 1 AND emissions IS NOT NULL AND before IS NOT NULL),
c AS (SELECT *, CASE WHEN reversal THEN 'one_period_reversal' WHEN coalesce(original / nullif(restated, 0) NOT BETWEEN 0.2 AND 5, true) THEN 'restated_later' WHEN period = (SELECT max(period) FROM p) THEN 'provisional' WHEN disclosed THEN 'confirmed' ELSE 'not_confirmed' END AS status FROM z)
"""


def yoy_confidence(p: DataFrame, inferred: DataFrame | None = None, eligible: DataFrame | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """Changes between adjacent years, labelled by the weakest thing known about them; only confirmed ones are ranked.

    inferred: (entity, period) whose unit was inferred. Only eligible (entity) ones and none of the excluded (entity, period)
    are listed and counted."""
    w = Window.partitionBy("entity").orderBy("period")
    y = p.withColumns({"before": F.lag("emissions").over(w), "_bp": F.lag("period").over(w), "after": F.lead("emissions").over(w), "_ap": F.lead("period").over(w)})
    y = y.where((F.col("_bp") == F.col("period") - 1) & F.col("emissions").isNotNull() & F.col("before").isNotNull())
    e, b, a = F.col("emissions"), F.col("before"), F.col("after")
    reversal = F.coalesce((F.col("_ap") == F.col("period") + 1) & (((e > 2 * b) & (e > 2 * a)) | ((e * 2 < b) & (e * 2 < a))), F.lit(False))
    unclear = F.coalesce(~(F.col("original") / F.nullif("restated", F.lit(0.0))).between(0.2, 5), F.lit(True))
    latest = F.broadcast(p.agg(F.max("period").alias("_latest")))
    status = F.when(reversal, "one_period_reversal").when(unclear, "restated_later").when(F.col("period") == F.col("_latest"), "provisional").when(F.col("disclosed"), "confirmed").otherwise("not_confirmed")
    if inferred is not None:
        y = y.join(inferred.select("entity", "period").distinct().withColumn("_inferred", F.lit(True)), ["entity", "period"], "left")
        status = F.when(reversal, "one_period_reversal").when(F.coalesce("_inferred", F.lit(False)), "inferred_unit").otherwise(status)
    if eligible is not None:
        y = y.join(eligible.select("entity"), "entity", "left_semi")
    if excluded is not None:
        y = y.join(excluded.select("entity", "period"), ["entity", "period"], "left_anti")
    out = y.crossJoin(latest).withColumns({"change": clean.safe_ratio(e, b) - 1, "status": status})
    n = F.count(F.when(F.col("status") == "confirmed", 1)).over(Window.partitionBy("peer", "period"))
    place = F.row_number().over(Window.partitionBy("peer", "period", F.col("status") == "confirmed").orderBy("change", "entity"))
    return out.withColumns({"n_confirmed": n, "place": F.when((F.col("status") == "confirmed") & (n >= 5), place)})


_YOY_OUT = "SELECT entity, period, peer, round(change, 6) AS change, status, count(*) FILTER (WHERE status = 'confirmed') OVER (PARTITION BY peer, period) AS n_confirmed, CASE WHEN status = 'confirmed' AND count(*) FILTER (WHERE status = 'confirmed') OVER (PARTITION BY peer, period) >= 5 THEN CAST(row_number() OVER (PARTITION BY peer, period, status = 'confirmed' ORDER BY change, entity) AS INTEGER) END AS place FROM c"


@query("l06_yoy_changes_with_confidence", _YOY + _YOY_OUT)
def l06(spark, sf):
    return yoy_confidence(customer_year(spark, sf)).select("entity", "period", "peer", r6("change").alias("change"), "status", "n_confirmed", "place")


@query("l07_one_year_reversals", CUSTOMER_YEAR + """, y AS (SELECT *, lag(turnover) OVER w AS before, lag(period) OVER w AS bp, lead(turnover) OVER w AS after, lead(period) OVER w AS ap FROM p WINDOW w AS (PARTITION BY entity ORDER BY period))
SELECT entity, period, CASE WHEN turnover > 2 * greatest(before, after) THEN 'up' ELSE 'down' END AS direction, before, turnover, after FROM y WHERE bp = period - 1 AND ap = period + 1 AND (turnover > 2 * greatest(before, after) OR turnover * 2 < least(before, after))""")
def l07(spark, sf):
    return win.one_period_spikes(customer_year(spark, sf), "entity", "period", "turnover").select("entity", "period", "direction", "before", "turnover", "after")


@query("l08_renewable_share_by_peer_group", SUPPLIER_YEAR + """, g AS (SELECT peer, period, count(DISTINCT entity) AS n_entities, 100.0::DOUBLE * sum(green_t) / nullif(sum(emissions_t), 0) AS share FROM p GROUP BY ALL)
SELECT peer, period, n_entities, CASE WHEN n_entities >= 5 THEN round(share, 6) END AS share, CASE WHEN n_entities >= 5 THEN round(share - lag(share) OVER (PARTITION BY peer ORDER BY period), 6) END AS change, CASE WHEN n_entities < 5 THEN 'fewer than 5' END AS null_reason FROM g""")
def l08(spark, sf):
    g = supplier_year(spark, sf).groupBy("peer", "period").agg(F.countDistinct("entity").alias("n_entities"), (100.0 * agg.ratio_of_sums("green_t", "emissions_t")).alias("share"))
    g = g.withColumn("change", r6(F.col("share") - F.lag("share").over(Window.partitionBy("peer").orderBy("period")))).withColumn("share", r6("share"))
    return agg.suppress_small_groups(g, ["share", "change"], "n_entities")


@query("l09_first_crossing", CUSTOMER_YEAR + """, y AS (SELECT *, lag(renewable_share) OVER (PARTITION BY entity ORDER BY period) AS before FROM p)
SELECT entity, min(period) AS first_crossing FROM y WHERE before < 50 AND renewable_share >= 50 GROUP BY 1""")
def l09(spark, sf):
    before = F.lag("renewable_share").over(Window.partitionBy("entity").orderBy("period"))
    return customer_year(spark, sf).withColumn("_b", before).where("_b < 50 AND renewable_share >= 50").groupBy("entity").agg(F.min("period").alias("first_crossing"))


_DECOUPLE = CUSTOMER_YEAR + """, d AS (SELECT entity, any_value(sector) AS sector, max(emissions) FILTER (WHERE period = first) AS e0, max(emissions) FILTER (WHERE period = last) AS e1, max(turnover) FILTER (WHERE period = first) AS t0, max(turnover) FILTER (WHERE period = last) AS t1, bool_or(coalesce(has_event, false)) AS any_event FROM p, (SELECT min(period) AS first, max(period) AS last FROM p) GROUP BY 1),
k AS (SELECT *, e1 / nullif(e0, 0) - 1 AS de, t1 / nullif(t0, 0) - 1 AS dt FROM d),
j AS (SELECT *, CASE WHEN de IS NULL OR dt IS NULL THEN 'no pair' WHEN de < 0 AND dt > 0 THEN 'absolute' WHEN de < dt AND dt > 0 THEN 'relative' WHEN dt <= 0 THEN 'shrinking' ELSE 'none' END AS class, nullif(concat_ws('|', CASE WHEN abs(de) > 5 THEN 'emissions jump' END, CASE WHEN abs(dt) > 5 THEN 'turnover jump' END), '') AS review FROM k),
f AS (SELECT *, CASE WHEN review IS NULL THEN class ELSE 'needs review' END AS screened FROM j)
"""


def with_ends(p: DataFrame) -> DataFrame:
    """p with the panel's first and last period, first and last."""
    return p.crossJoin(F.broadcast(p.agg(F.min("period").alias("first"), F.max("period").alias("last"))))  # one row


def decoupling(p: DataFrame) -> DataFrame:
    """Changes of emissions and turnover between the panel's first and last year, and what they amount to before and after a
    plausibility screen."""
    at = lambda c, end: F.max(F.when(F.col("period") == F.col(end), F.col(c)))
    d = with_ends(p).groupBy("entity").agg(F.min("sector").alias("sector"), at("emissions", "first").alias("e0"), at("emissions", "last").alias("e1"), at("turnover", "first").alias("t0"), at("turnover", "last").alias("t1"))
    d = d.withColumns({"de": clean.safe_ratio(F.col("e1"), F.col("e0")) - 1, "dt": clean.safe_ratio(F.col("t1"), F.col("t0")) - 1})
    de, dt = F.col("de"), F.col("dt")
    label = F.when(de.isNull() | dt.isNull(), "no pair").when((de < 0) & (dt > 0), "absolute").when((de < dt) & (dt > 0), "relative").when(dt <= 0, "shrinking").otherwise("none")
    d = d.withColumns({"class": label, "review": clean.pack_flags([(F.abs("de") > 5, "emissions jump"), (F.abs("dt") > 5, "turnover jump")])})
    return d.withColumn("screened", F.when(F.col("review").isNull(), F.col("class")).otherwise("needs review"))


@query("l10_decoupling_by_entity", _DECOUPLE + "SELECT entity, sector, round(de, 6) AS de, round(dt, 6) AS dt, class, review, screened FROM f")
def l10(spark, sf):
    return decoupling(customer_year(spark, sf)).select("entity", "sector", r6("de").alias("de"), r6("dt").alias("dt"), "class", "review", "screened")


@query("l11_decoupling_by_sector", _DECOUPLE + """, n AS (SELECT coalesce(sector, 'All') AS sector, class, count(*) AS n_before, count(*) FILTER (WHERE review IS NULL) AS n_after FROM f GROUP BY GROUPING SETS ((sector, class), (class)))
SELECT *, round(n_before::DOUBLE / sum(n_before) OVER (PARTITION BY sector), 6) AS share FROM n""")
def l11(spark, sf):
    d = decoupling(customer_year(spark, sf)).withColumn("sector", F.explode(F.array("sector", F.lit("All"))))
    n = d.groupBy("sector", "class").agg(F.count("*").alias("n_before"), F.count_if(F.col("review").isNull()).alias("n_after"))
    return n.withColumn("share", r6(F.col("n_before") / F.sum("n_before").over(Window.partitionBy("sector"))))


@query("l12_gender_by_sector", CUSTOMER_YEAR + BALANCED + """, g AS (SELECT panel, sector, period, round(100.0::DOUBLE * sum(women) / nullif(sum(staff), 0), 6) AS women_share, round(median(pay_gap), 6) AS median_gap FROM panels GROUP BY ALL)
SELECT *, round(women_share - first_value(women_share) OVER w, 6) AS since_first, round(women_share - lag(women_share) OVER w, 6) AS since_before FROM g WINDOW w AS (PARTITION BY panel, sector ORDER BY period)""")
def l12(spark, sf):
    g = two_panels(customer_year(spark, sf)).groupBy("panel", "sector", "period").agg(r6(100.0 * agg.ratio_of_sums("women", "staff")).alias("women_share"), r6(F.median("pay_gap")).alias("median_gap"))
    w = Window.partitionBy("panel", "sector").orderBy("period")
    return g.withColumns({"since_first": r6(F.col("women_share") - F.first("women_share").over(w)), "since_before": r6(F.col("women_share") - F.lag("women_share").over(w))})


@query("l13_pay_gap_narrowing", CUSTOMER_YEAR + """, g AS (SELECT entity, any_value(ownership) AS ownership, abs(max(pay_gap) FILTER (WHERE period = first)) AS g0, abs(max(pay_gap) FILTER (WHERE period = last)) AS g1 FROM p, (SELECT min(period) AS first, max(period) AS last FROM p) GROUP BY 1)
SELECT ownership, count(*) FILTER (WHERE g1 - g0 < -0.5) AS closer, count(*) FILTER (WHERE g1 - g0 > 0.5) AS away, count(*) FILTER (WHERE abs(g1 - g0) <= 0.5) AS unchanged, count(*) FILTER (WHERE g1 - g0 IS NULL) AS no_pair FROM g GROUP BY 1""")
def l13(spark, sf):
    at = lambda end: F.abs(F.max(F.when(F.col("period") == F.col(end), F.col("pay_gap"))))
    g = with_ends(customer_year(spark, sf)).groupBy("entity").agg(F.min("ownership").alias("ownership"), (at("last") - at("first")).alias("d"))
    d = F.col("d")
    return g.groupBy("ownership").agg(F.count_if(d < -0.5).alias("closer"), F.count_if(d > 0.5).alias("away"), F.count_if(F.abs(d) <= 0.5).alias("unchanged"), F.count_if(d.isNull()).alias("no_pair"))


_YEARS = list(range(1995, 2002))


@query("l14_disclosure_adoption_by_year", CUSTOMER_YEAR + ", a AS (SELECT CASE WHEN grouping(sector) = 1 THEN 'All' ELSE sector END AS sector, period, 100.0::DOUBLE * count(*) FILTER (WHERE disclosed) / count(*) AS share FROM p GROUP BY GROUPING SETS ((sector, period), (period))) SELECT sector, " + ", ".join(f'round(max(share) FILTER (WHERE period = {y}), 6) AS "{y}"' for y in _YEARS) + " FROM a GROUP BY 1")
def l14(spark, sf):
    p = customer_year(spark, sf).withColumn("sector", F.explode(F.array("sector", F.lit("All"))))
    return p.groupBy("sector").pivot("period", _YEARS).agg(r6(100.0 * F.count_if("disclosed") / F.count("period")))


@query("l15_grouping_sets_median", SUPPLIER_YEAR + """, m AS (SELECT sector, ownership, period, CAST(grouping(sector) * 2 + grouping(ownership) AS BIGINT) AS level, count(DISTINCT entity) AS n_entities, median(renewable_share) AS mid FROM p GROUP BY GROUPING SETS ((period, sector, ownership), (period, sector), (period, ownership), (period)))
SELECT sector, ownership, period, level, n_entities, CASE WHEN n_entities >= 5 THEN round(mid, 6) END AS median_share, CASE WHEN n_entities < 5 THEN 'fewer than 5' END AS null_reason FROM m""")
def l15(spark, sf):
    p = supplier_year(spark, sf).select("entity", "period", "sector", "ownership", "renewable_share")
    keys = ["period", "sector", "ownership"]
    fanned = agg.fanned_sets(p, keys, [keys, keys[:2], keys[::2], keys[:1]])
    m = fanned.groupBy(*keys, "level").agg(F.countDistinct("entity").alias("n_entities"))
    m = order.joined_medians(m, fanned, [*keys, "level"], "renewable_share", "median_share").withColumn("median_share", r6("median_share"))
    return agg.suppress_small_groups(m, ["median_share"], "n_entities")


@query("l16_biggest_improvers", SUPPLIER_YEAR + """, y AS (SELECT *, lag(renewable_share) OVER w AS before, lag(disclosed) OVER w AS db, lag(period) OVER w AS bp FROM p WINDOW w AS (PARTITION BY entity ORDER BY period))
SELECT entity, period, round(renewable_share - before, 6) AS gain FROM y WHERE bp = period - 1 AND db = disclosed AND renewable_share > before ORDER BY round(renewable_share - before, 6) DESC, entity, period LIMIT 10""")
def l16(spark, sf):
    w = Window.partitionBy("entity").orderBy("period")
    y = supplier_year(spark, sf).withColumns({"_b": F.lag("renewable_share").over(w), "_d": F.lag("disclosed").over(w), "_p": F.lag("period").over(w)})
    y = y.where("_p = period - 1 AND _d = disclosed AND renewable_share > _b")
    return y.select("entity", "period", r6(F.col("renewable_share") - F.col("_b")).alias("gain")).orderBy(F.col("gain").desc(), "entity", "period").limit(10)


_PAIRS = SUPPLIER_YEAR + """, r0 AS (SELECT entity, period, peer, original, restated, restated / nullif(original, 0) AS ratio, entity % 2 = 0 AS lower_better FROM p),
r AS (SELECT *, ratio - 1 AS change, CASE WHEN original IS NULL AND restated IS NULL THEN 'no value' WHEN original IS NULL THEN 'added later' WHEN restated IS NULL THEN 'withdrawn' WHEN original = restated THEN 'no change' WHEN original = 0 THEN 'from zero'
WHEN coalesce(ratio > 100 OR ratio < 0.01, false) THEN 'scale error' WHEN abs(ratio - 1) <= 0.01 THEN 'rounding' WHEN abs(ratio - 1) <= 0.05 THEN 'small' WHEN abs(ratio - 1) <= 0.5 THEN 'material' ELSE 'large' END AS classification,
original IS NOT NULL AND restated IS NOT NULL AS is_compared, CASE WHEN original IS NOT NULL AND restated IS NOT NULL THEN CASE WHEN lower_better THEN restated < original ELSE restated > original END END AS flatters FROM r0)
"""


def restatement_pairs(p: DataFrame) -> DataFrame:
    return p.withColumns(classify_restatement(F.col("original"), F.col("restated"), F.col("entity") % 2 == 0))


def _restated() -> list:
    return [F.count_if("is_compared").alias("n_compared"), F.count_if(F.col("classification").isin("material", "large")).alias("n_material"), F.count_if("flatters").alias("n_flattering"), F.countDistinct(F.when(F.col("classification").isin("material", "large"), F.col("entity"))).alias("n_entities")]
_RESTATED_SQL = "count(*) FILTER (WHERE is_compared) AS n_compared, count(*) FILTER (WHERE classification IN ('material', 'large')) AS n_material, count(*) FILTER (WHERE flatters) AS n_flattering, count(DISTINCT entity) FILTER (WHERE classification IN ('material', 'large')) AS n_entities"


@query("l17_restatements_by_year", _PAIRS + f", n AS (SELECT coalesce(CAST(period AS VARCHAR), 'All') AS period, {_RESTATED_SQL} FROM r GROUP BY ROLLUP (period)) SELECT *, round(n_material::DOUBLE / nullif(n_compared, 0), 6) AS material_share, round(n_flattering::DOUBLE / nullif(n_compared, 0), 6) AS flattering_share FROM n")
def l17(spark, sf):
    n = agg.with_total(restatement_pairs(supplier_year(spark, sf)).withColumn("period", F.col("period").cast("string")), "period", _restated())
    return n.withColumns({"material_share": r6(F.col("n_material") / F.nullif("n_compared", F.lit(0))), "flattering_share": r6(F.col("n_flattering") / F.nullif("n_compared", F.lit(0)))})


@query("l18_restatements_by_peer_top10", _PAIRS + f"SELECT peer, {_RESTATED_SQL} FROM r GROUP BY 1 ORDER BY n_material DESC, peer LIMIT 10")
def l18(spark, sf):
    return restatement_pairs(supplier_year(spark, sf)).groupBy("peer").agg(*_restated()).orderBy(F.col("n_material").desc(), "peer").limit(10)


_QUADRANTS = SUPPLIER_YEAR + """, q AS (SELECT entity, period, sector, renewable_share >= median(renewable_share) OVER (PARTITION BY sector, period) AS good_share, turnover >= median(turnover) OVER (PARTITION BY sector, period) AS large FROM p)
"""


def quadrants(p: DataFrame) -> DataFrame:
    middle = p.groupBy("sector", "period").agg(F.median("renewable_share").alias("_s"), F.median("turnover").alias("_t"))
    return p.join(middle, ["sector", "period"]).select("entity", "period", "sector", (F.col("renewable_share") >= F.col("_s")).alias("good_share"), (F.col("turnover") >= F.col("_t")).alias("large"))


@query("l19_quadrants_overall", _QUADRANTS + "SELECT good_share, large, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS share FROM q GROUP BY good_share, large")
def l19(spark, sf):
    n = quadrants(supplier_year(spark, sf)).groupBy("good_share", "large").agg(F.count("*").alias("n"))
    total = F.broadcast(n.agg(F.sum("n").alias("_t")))
    return n.crossJoin(total).select("good_share", "large", "n", r6(100.0 * F.col("n") / F.col("_t")).alias("share"))


@query("l20_quadrants_by_group", _QUADRANTS + "SELECT coalesce(sector, 'All') AS sector, count(*) FILTER (WHERE good_share AND large) AS both, count(*) FILTER (WHERE good_share AND NOT large) AS only_share, count(*) FILTER (WHERE NOT good_share AND large) AS only_large, count(*) FILTER (WHERE NOT good_share AND NOT large) AS neither, round(count(*) FILTER (WHERE good_share = large)::DOUBLE / nullif(count(*), 0), 6) AS same_side FROM q GROUP BY ROLLUP (sector)")
def l20(spark, sf):
    g, b = F.col("good_share"), F.col("large")
    return agg.with_total(quadrants(supplier_year(spark, sf)), "sector", [F.count_if(g & b).alias("both"), F.count_if(g & ~b).alias("only_share"), F.count_if(~g & b).alias("only_large"), F.count_if(~g & ~b).alias("neither"), r6(F.count_if(g == b) / F.nullif(F.count("*"), F.lit(0))).alias("same_side")])


_KPIS = ["turnover", "emissions", "renewable_share", "women_share"]
_LEADERS = SUPPLIER_YEAR + """, k AS (SELECT entity, period, sector, kpi, CASE WHEN count(*) OVER (PARTITION BY sector, period, kpi) >= 5 THEN 100 * percent_rank() OVER (PARTITION BY sector, period, kpi ORDER BY value) END AS pct FROM (SELECT * FROM p UNPIVOT (value FOR kpi IN (turnover, emissions, renewable_share, women_share)))),
t AS (SELECT entity, period, sector, count(*) AS n_top, string_agg(kpi, ', ' ORDER BY kpi) AS kpis FROM k WHERE pct >= 75 GROUP BY ALL HAVING count(*) >= 3)
"""


def leaders(p: DataFrame) -> DataFrame:
    long = agg.unpivot(p, ["entity", "period", "sector"], _KPIS, "kpi", "value")
    ranked = win.group_percentile(long, ["sector", "period", "kpi"], "value").where("percentile >= 75")
    return ranked.groupBy("entity", "period", "sector").agg(F.count("*").alias("n_top"), agg.joined_set(F.col("kpi")).alias("kpis")).where("n_top >= 3")


@query("l21_top_quartile_on_three", _LEADERS + "SELECT * FROM t")
def l21(spark, sf):
    return leaders(supplier_year(spark, sf))


@query("l22_leaders_by_group", _LEADERS + "SELECT sector, count(*) AS n_leader_years, count(DISTINCT entity) AS n_leaders, max(n_top) AS most FROM t GROUP BY 1")
def l22(spark, sf):
    return leaders(supplier_year(spark, sf)).groupBy("sector").agg(F.count("*").alias("n_leader_years"), F.countDistinct("entity").alias("n_leaders"), F.max("n_top").alias("most"))


@query("l23_event_rate_by_group", CUSTOMER_YEAR + "SELECT coalesce(sector, 'All') AS sector, CAST(sum(events) AS BIGINT) AS n_events, round(10000.0::DOUBLE * sum(events) / nullif(sum(staff), 0), 6) AS rate, round(count(DISTINCT entity) FILTER (WHERE has_event)::DOUBLE / count(DISTINCT entity), 6) AS share_with_event FROM p GROUP BY ROLLUP (sector)")
def l23(spark, sf):
    return agg.with_total(customer_year(spark, sf), "sector", [F.sum("events").alias("n_events"), r6(10000.0 * agg.ratio_of_sums("events", "staff")).alias("rate"), r6(F.countDistinct(F.when(F.col("has_event"), F.col("entity"))) / F.countDistinct("entity")).alias("share_with_event")])


@query("l24_repeated_events", CUSTOMER_YEAR + "SELECT entity, count(*) AS n_periods, string_agg(CAST(period AS VARCHAR), ', ' ORDER BY period) AS periods FROM p WHERE has_event GROUP BY 1 HAVING count(*) >= 2")
def l24(spark, sf):
    return customer_year(spark, sf).where("has_event").groupBy("entity").agg(F.count("*").alias("n_periods"), agg.joined_set(F.col("period").cast("string")).alias("periods")).where("n_periods >= 2")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
