"""The driver's tables in the roles of a panel: entities, periods, groups and measures.

Sums are taken over whole cents and whole units, so they don't depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import exists, states, workspace


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str):
    return F.round(F.col(c) * 100).cast("long")


def _measures() -> list:
    """What a line adds to its entity and period. All are whole numbers, so partial sums may be summed again."""
    q = F.col("l_quantity").cast("long")
    flag = F.col("l_returnflag")
    return [
        F.sum(cents("l_extendedprice")).alias("turnover_cents"),
        F.sum(q).alias("emissions_t"),
        F.sum(F.when(F.col("l_linestatus") == "F", q).otherwise(0)).alias("green_t"),
        F.sum(F.when(flag != "R", q).otherwise(0)).alias("staff"),
        F.sum(F.when(flag == "A", q).otherwise(0)).alias("women"),
        F.sum(F.when(flag == "R", 1).otherwise(0)).alias("events"),
        F.sum(F.when(F.col("l_tax") == 0, 1).otherwise(0)).alias("untaxed"),
        F.sum(F.when(F.col("l_linestatus") == "O", cents("l_extendedprice"))).alias("first_cents"),
        F.sum(F.when(F.col("l_linestatus") == "F", cents("l_extendedprice"))).alias("later_cents"),
        F.count("*").alias("n_lines"),
    ]


MEASURES = ["turnover_cents", "emissions_t", "green_t", "staff", "women", "events", "untaxed", "first_cents", "later_cents", "n_lines"]


def _derive(df: DataFrame) -> DataFrame:
    """Figures of an entity-year. Nulls, zeros and slips of scale are planted by arithmetic on the entity's number."""
    e, t = F.col("emissions_t").cast("double"), F.col("turnover_cents") / 100.0
    return df.withColumns({
        "turnover": t,
        "emissions": F.when(F.pmod("entity", F.lit(17)) != 0, e),
        "renewable_share": F.when(F.col("emissions_t") > 0, 100.0 * F.col("green_t") / F.col("emissions_t")),
        "women_share": F.when((F.col("staff") > 0) & (F.pmod("entity", F.lit(13)) != 0), 100.0 * F.col("women") / F.col("staff")),
        "pay_gap": F.when(F.col("staff") > 0, 100.0 * F.col("women") / F.col("staff") - 50),
        "disclosed": F.col("untaxed") >= 2,
        "has_event": F.col("events") >= 2,
        "original": F.col("first_cents") / 100.0,
        "restated": F.col("later_cents") / 100.0,
    }).withColumn("intensity", F.col("emissions") / F.nullif(F.col("turnover") / 1e6, F.lit(0.0)))


#: Panels of this session, by what they are made of: (name, session, files).
_stored: dict[tuple, str] = {}


def stored(make):
    """A panel is made once in a session and kept as Parquet in the shared folder: the questions read it, not the lines.
    It is made anew when the files that it comes from are others, also under the same names: their lengths and times count."""

    def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = make(spark, sf_dir)
        key = (make.__name__, spark.sparkContext.applicationId, states(spark, built.inputFiles()))
        if key not in _stored or not exists(spark, _stored[key]):
            path = workspace(spark)
            built.write.parquet(path)
            _stored[key] = path
        return spark.read.schema(built.schema).parquet(_stored[key])

    panel.__name__ = make.__name__
    return panel


@stored
def customer_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each customer and order year: a panel with gaps. Lines are summed by order before they meet orders."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*_measures())
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("period"))
    panel = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"]).groupBy("entity", "period").agg(*(F.sum(c).alias(c) for c in MEASURES))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("ownership"), F.col("c_nationkey").alias("nationkey"))
    return _derive(panel.join(customers, "entity").join(_places(spark, sf_dir), "nationkey").drop("nationkey"))


@stored
def supplier_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each supplier and ship year: a full panel, with a few suppliers in each nation."""
    panel = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("entity"), F.year("l_shipdate").alias("period")).agg(*_measures())
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("name"), F.when(F.col("s_acctbal") < 3000, "public").otherwise("private").alias("ownership"), F.col("s_nationkey").alias("nationkey"))
    return _derive(panel.join(suppliers, "entity").join(_places(spark, sf_dir), "nationkey").drop("nationkey"))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations and regions: a fixed list of places, a few dozen rows at any scale."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return F.broadcast(nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"]).select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("peer"), F.col("r_name").alias("sector")))


_SUMS = """
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS turnover_cents,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS emissions_t,
  CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS green_t,
  CAST(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS staff,
  CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS women,
  CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS events,
  CAST(count(*) FILTER (WHERE l_tax = 0) AS BIGINT) AS untaxed,
  CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(round(l_extendedprice * 100) AS BIGINT) END) AS BIGINT) AS first_cents,
  CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(round(l_extendedprice * 100) AS BIGINT) END) AS BIGINT) AS later_cents,
  count(*) AS n_lines"""
_DERIVED = """
  SELECT *, emissions / nullif(turnover / 1e6, 0) AS intensity FROM (
  SELECT *, turnover_cents / 100.0::DOUBLE AS turnover,
    CASE WHEN entity % 17 <> 0 THEN emissions_t::DOUBLE END AS emissions,
    CASE WHEN emissions_t > 0 THEN 100.0::DOUBLE * green_t / emissions_t END AS renewable_share,
    CASE WHEN staff > 0 AND entity % 13 <> 0 THEN 100.0::DOUBLE * women / staff END AS women_share,
    CASE WHEN staff > 0 THEN 100.0::DOUBLE * women / staff - 50 END AS pay_gap,
    untaxed >= 2 AS disclosed, events >= 2 AS has_event,
    first_cents / 100.0::DOUBLE AS original, later_cents / 100.0::DOUBLE AS restated
  FROM {0})"""
#: CTEs of the same names as the functions above; a query's SQL is CUSTOMER_YEAR + "SELECT ...".
CUSTOMER_YEAR = f"""WITH cy0 AS (SELECT o_custkey AS entity, CAST(year(o_orderdate) AS INTEGER) AS period, {_SUMS}
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
cy1 AS (SELECT cy0.*, c_name AS name, c_mktsegment AS ownership, n_name AS peer, r_name AS sector FROM cy0
  JOIN customer ON c_custkey = entity JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
p AS ({_DERIVED.format("cy1")})
"""
SUPPLIER_YEAR = f"""WITH sy0 AS (SELECT l_suppkey AS entity, CAST(year(l_shipdate) AS INTEGER) AS period, {_SUMS}
  FROM lineitem GROUP BY ALL),
sy1 AS (SELECT sy0.*, s_name AS name, CASE WHEN s_acctbal < 3000 THEN 'public' ELSE 'private' END AS ownership, n_name AS peer, r_name AS sector FROM sy0
  JOIN supplier ON s_suppkey = entity JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
p AS ({_DERIVED.format("sy1")})
"""


def r6(c):
    """Rounded to six digits: medians and ratios agree across engines to fewer digits than a double holds."""
    return F.round(c if not isinstance(c, str) else F.col(c), 6)
