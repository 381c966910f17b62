"""Queries of the metric layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import domain as dom
from ..operators import metrics as met
from ..operators.metrics import MetricSpec
from .bindings import CUSTOMER_YEAR, SUPPLIER_YEAR, customer_year, r6, supplier_year
from .registry import query

SPECS = [
    MetricSpec("intensity", "ratio_of_sums", numerator="emissions", denominator="turnover", gate="n_reporting"),
    MetricSpec("women_pct", "ratio_of_sums", numerator="women", denominator="staff", percent=True, gate="n_entities"),
    MetricSpec("median_renewable", "median", column="renewable_share", gate="n_entities"),
    MetricSpec("disclosed_pct", "share", column="disclosed", percent=True, gate="n_entities"),
    MetricSpec("n_events", "count", condition="has_event"),
    MetricSpec("n_entities", "count_distinct", column="entity"),
    MetricSpec("n_reporting", "count_distinct", column="entity", condition="emissions IS NOT NULL"),
]
_SQL = """round(sum(CASE WHEN emissions IS NOT NULL THEN emissions END) / nullif(sum(CASE WHEN emissions IS NOT NULL THEN turnover_cents END) / 100.0::DOUBLE, 0), 9) AS intensity,
round(100.0::DOUBLE * sum(women) / nullif(sum(staff), 0), 6) AS women_pct, round(median(renewable_share), 6) AS median_renewable, round(100.0::DOUBLE * count(*) FILTER (WHERE disclosed) / count(*), 6) AS disclosed_pct,
count(*) FILTER (WHERE has_event) AS n_events, count(DISTINCT entity) AS n_entities, count(DISTINCT entity) FILTER (WHERE emissions IS NOT NULL) AS n_reporting"""


def _rounded(df):
    # turnover sums in doubles depend on the order of rows in their last digits
    return df.withColumns({"intensity": F.round("intensity", 9)} | {c: r6(c) for c in ("women_pct", "median_renewable", "disclosed_pct")})


def _one(name: str, spec: MetricSpec, sql: str, digits: int = 6):
    @query(name, CUSTOMER_YEAR + f"SELECT sector, period, {sql} AS {spec.name} FROM p GROUP BY ALL")
    def run(spark, sf):
        out = met.query_metrics(customer_year(spark, sf), [spec], ["sector", "period"])
        return out.withColumn(spec.name, F.round(spec.name, digits)) if spec.kind not in ("count", "count_distinct") else out


_one("k01_ratio_of_sums", MetricSpec("intensity", "ratio_of_sums", numerator="emissions", denominator="turnover_cents"), "round(sum(CASE WHEN emissions IS NOT NULL THEN emissions END) / nullif(sum(CASE WHEN emissions IS NOT NULL THEN turnover_cents END), 0), 12)", 12)
_one("k02_median", MetricSpec("mid", "median", column="women_share"), "round(median(women_share), 6)")
_one("k03_average_of_scores", MetricSpec("mean_lines", "average", column="n_lines", is_score=True), "round(avg(n_lines), 6)")
_one("k04_share", MetricSpec("share", "share", column="disclosed", condition="has_event", percent=True), "round(100.0::DOUBLE * count(*) FILTER (WHERE disclosed AND has_event) / nullif(count(*) FILTER (WHERE has_event), 0), 6)")
_one("k05_count", MetricSpec("n", "count", condition="disclosed"), "count(*) FILTER (WHERE disclosed)")
_one("k06_count_distinct", MetricSpec("n", "count_distinct", column="entity", condition="disclosed"), "count(DISTINCT entity) FILTER (WHERE disclosed)")


#: A catalogue with faults: an average of ratios, a gate and a column that don't exist.
_FAULTY = [*SPECS, MetricSpec("mean_intensity", "average", column="intensity", is_ratio=True), MetricSpec("gated", "count", condition="has_event", gate="nobody"), MetricSpec("lost", "median", column="no_such_column")]
_NEEDS = {"intensity": "emissions IS NOT NULL AND turnover IS NOT NULL", "women_pct": "women IS NOT NULL AND staff IS NOT NULL", "median_renewable": "renewable_share IS NOT NULL", "disclosed_pct": "disclosed IS NOT NULL", "mean_intensity": "intensity IS NOT NULL", "lost": "false"}
_FAULTS = {"mean_intensity": "mean_intensity: only scores may be averaged", "gated": "gated: its gate nobody isn''t in the catalogue", "lost": "lost: no columns [''no_such_column'']"}


@query("k07_validate_specs", CUSTOMER_YEAR + " UNION ALL ".join(f"SELECT '{s.name}' AS name, '{s.kind}' AS kind, {chr(39) + _FAULTS[s.name] + chr(39) if s.name in _FAULTS else 'NULL'}::VARCHAR AS problem, count(*) FILTER (WHERE {_NEEDS.get(s.name, 'entity IS NOT NULL')}) AS n_rows FROM p" for s in _FAULTY))
def k07(spark, sf):
    return met.check_catalogue(customer_year(spark, sf), _FAULTY)


@query("k08_query_metrics", CUSTOMER_YEAR + f"SELECT sector, ownership, {_SQL} FROM p GROUP BY ALL")
def k08(spark, sf):
    return _rounded(met.query_metrics(customer_year(spark, sf), SPECS, ["sector", "ownership"]))


@query("k08_query_metrics_by_year", CUSTOMER_YEAR + f"SELECT make_date(period, 1, 1) AS metric_time, {_SQL} FROM p GROUP BY ALL")
def k08b(spark, sf):
    return _rounded(met.query_metrics(customer_year(spark, sf).withColumn("metric_time", F.make_date("period", F.lit(1), F.lit(1))), SPECS, ["metric_time"]))


_GATED = "n_events, n_entities, n_reporting, CASE WHEN n_reporting >= 5 THEN intensity END AS intensity, " + ", ".join(f"CASE WHEN n_entities >= 5 THEN {c} END AS {c}" for c in ("women_pct", "median_renewable", "disclosed_pct"))
_GROUPS = """, f AS (SELECT 'all' AS group_type, 'all' AS group_value, * FROM p UNION ALL SELECT 'sector', sector, * FROM p UNION ALL SELECT 'peer', peer, * FROM p UNION ALL SELECT 'ownership', ownership, * FROM p),
m AS (SELECT group_type, group_value, period, """ + _SQL + """ FROM f GROUP BY ALL)
"""


def group_metrics(p, types=("all", "sector", "peer", "ownership")):
    groups = {t: F.lit("all") if t == "all" else F.col(t) for t in types}
    return _rounded(met.query_metrics_by_groups(p, SPECS, groups, ["period"], "entity", least=5))


@query("j21_group_metrics", SUPPLIER_YEAR + _GROUPS + f"SELECT group_type, group_value, period, {_GATED} FROM m")
def j21(spark, sf):
    return group_metrics(supplier_year(spark, sf))


@query("k09_later_filing_rule", SUPPLIER_YEAR + ", g AS (SELECT peer, period, CAST(sum(CASE WHEN disclosed THEN events END) AS BIGINT) AS e FROM p GROUP BY ALL) SELECT peer, period, CASE WHEN period < (SELECT max(period) FROM g) THEN coalesce(e, 0) END AS later_events FROM g")
def k09(spark, sf):
    g = supplier_year(spark, sf).groupBy("peer", "period").agg(F.sum(F.when(F.col("disclosed"), F.col("events"))).alias("later_events"))
    return met.later_filing_rule(g, "period", ["later_events"])


@query("k10_share_of_selection", SUPPLIER_YEAR + """SELECT entity, period, round(turnover_cents::DOUBLE / sum(turnover_cents) OVER (PARTITION BY sector, period), 6) AS share_of_selection, CAST(dense_rank() OVER (PARTITION BY sector, period ORDER BY turnover_cents DESC) AS INTEGER) AS dense_rank_in_selection,
round(sum(turnover_cents) OVER (PARTITION BY sector, period ORDER BY turnover_cents DESC)::DOUBLE / sum(turnover_cents) OVER (PARTITION BY sector, period), 6) AS cumulative_share_by_value FROM p""")
def k10(spark, sf):
    s = met.share_of_selection(supplier_year(spark, sf), "turnover_cents", ["sector", "period"])
    return s.select("entity", "period", r6("share_of_selection").alias("share_of_selection"), "dense_rank_in_selection", r6("cumulative_share_by_value").alias("cumulative_share_by_value"))


@query("k11_lookup_group_metric", SUPPLIER_YEAR + _GROUPS + "SELECT group_value, period, CASE WHEN n_entities >= 5 THEN women_pct END AS women_pct FROM m WHERE group_type = 'sector' AND group_value = 'ASIA'")
def k11a(spark, sf):
    return met.lookup(group_metrics(supplier_year(spark, sf).where("sector = 'ASIA'"), ["sector"]), {"group_value": "ASIA"}, ["group_value", "period", "women_pct"])


@query("k11_lookup_entity_card", SUPPLIER_YEAR + "SELECT entity, period, name, turnover FROM p WHERE entity = 7 ORDER BY period DESC LIMIT 3")
def k11b(spark, sf):
    return met.lookup(supplier_year(spark, sf), {"entity": 7}, ["entity", "period", "name", "turnover"], [F.col("period").desc()], 3)


@query("k12_latest_final_period", CUSTOMER_YEAR + "SELECT entity, max(period) AS latest_final, count(*) AS n_final FROM p WHERE period < (SELECT max(period) FROM p) GROUP BY 1")
def k12(spark, sf):
    p = customer_year(spark, sf).select("entity", "period")
    latest = F.broadcast(p.agg(F.max("period").alias("_latest")))
    return p.crossJoin(latest).where("period < _latest").groupBy("entity").agg(F.max("period").alias("latest_final"), F.count("*").alias("n_final"))


_YEARS = list(range(1995, 2002))


@query("k13_metric_grid", CUSTOMER_YEAR + ", m AS (SELECT sector, period, round(median(women_share), 6) AS v FROM p GROUP BY ALL) SELECT sector, " + ", ".join(f'max(v) FILTER (WHERE period = {y}) AS "{y}"' for y in _YEARS) + " FROM m GROUP BY 1")
def k13(spark, sf):
    m = customer_year(spark, sf).groupBy("sector", "period").agg(r6(F.median("women_share")).alias("v"))
    return met.metric_grid(m, "sector", "period", _YEARS, "v")
