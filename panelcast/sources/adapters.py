"""Adapters: the supplied TPC-H-like tables as long panels.

* ``panel_m``  (entity, indicator, date, value)   monthly indicators from orders
* ``market_m`` (entity, indicator, date, value)   second monthly source from lineitem
* ``panel_q``  (entity, target, date, level)      quarterly levels from lineitem
* ``index_m``  (entity, indicator, date, value)   month-on-month index (base 100)

An entity is ``<region key>|<market segment>``.  All rows of all dates are read.
Fact rows cross one exchange, to learn their entity by a foreign key (a key that
holds a third of all rows is a skewed join, which AQE splits); the sums per
entity and month combine map-side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import cents, from_cents, month_start, quarter_start, round_fixed
from panelcast.operators.calendar import densify
from panelcast.operators.series import SERIES_KEYS
from panelcast.sources.tables import read_table

# Fixed labels of the monthly and quarterly measures built here.
ORDER_INDICATORS = ("revenue", "orders", "avg_ticket", "net_flow")
MARKET_INDICATORS = ("shipped_lines", "return_share")
QUARTERLY_TARGETS = ("gmv", "net_sales", "qty")


def entity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """custkey -> entity (customer joined with the 25 nations)."""
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("custkey"),
        F.concat(F.col("n_regionkey").cast("string"), F.lit("|"), F.col("c_mktsegment")).alias("entity"),
    )


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide monthly order measures per entity: (entity, date, rev_c, n_orders, flow_c, last_day).

    Orders cross one exchange (custkey); the sums per entity and month combine before theirs.
    """
    o = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = cents("o_totalprice")
    signed = F.when(F.col("o_orderstatus") == "F", c).when(F.col("o_orderstatus") == "O", -c).otherwise(F.lit(0).cast("long"))
    return (o.join(entity_map(spark, sf_dir), F.col("o_custkey") == F.col("custkey"))
            .groupBy("entity", month_start("o_orderdate").alias("date")).agg(
                F.sum(c).alias("rev_c"), F.count(F.lit(1)).alias("n_orders"), F.sum(signed).alias("flow_c"),
                F.max(F.col("o_orderdate").cast("date")).alias("last_day")))


def panel_m(om: DataFrame) -> DataFrame:
    """Long monthly panel (entity, indicator, date, value) from :func:`order_months`."""
    w = om.select(
        "entity", "date",
        from_cents("rev_c").alias("revenue"),
        F.col("n_orders").cast("double").alias("orders"),
        round_fixed(from_cents("rev_c") / F.col("n_orders"), 6).alias("avg_ticket"),
        from_cents("flow_c").alias("net_flow"),
    )
    return w.unpivot(["entity", "date"], list(ORDER_INDICATORS), "indicator", "value").select(
        "entity", "indicator", "date", "value")


LINE_MEASURES = ("gmv_c", "net_c", "qty", "ret_qty", "n_lines")


def line_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide monthly line measures per entity: (entity, date, gmv_c, net_c, qty, ret_qty, n_lines, last_day).

    Orders learn their entity first; line items then cross one exchange (orderkey) and are summed per entity and
    month, which combines before its exchange.  Every measure is an exact integer sum, so quarters roll up from months.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_extendedprice",
                    "l_discount", "l_returnflag", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    owner = (orders.join(entity_map(spark, sf_dir), F.col("o_custkey") == F.col("custkey"))
             .select("o_orderkey", "entity"))
    qty = F.col("l_quantity").cast("long")
    return (li.join(owner, li.l_orderkey == owner.o_orderkey)
            .groupBy("entity", month_start("l_shipdate").alias("date")).agg(
                F.sum(cents("l_extendedprice")).alias("gmv_c"),
                F.sum(cents(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("net_c"),
                F.sum(qty).alias("qty"),
                F.sum(F.when(F.col("l_returnflag") == "R", qty).otherwise(0)).alias("ret_qty"),
                F.count(F.lit(1)).alias("n_lines"),
                F.max(F.col("l_shipdate").cast("date")).alias("last_day")))


def line_quarters(lm: DataFrame) -> DataFrame:
    """Monthly line measures rolled up to calendar quarters (exact sums)."""
    return lm.groupBy("entity", quarter_start("date").alias("date")).agg(
        *(F.sum(x).alias(x) for x in LINE_MEASURES))


def market_m(lm: DataFrame) -> DataFrame:
    """Second monthly source (entity, indicator, date, value) from :func:`line_months`.

    Its measures are counts and shares of lines, none of which adds up to a quarterly target.
    """
    w = lm.select(
        "entity", "date",
        F.col("n_lines").cast("double").alias("shipped_lines"),
        round_fixed(F.col("ret_qty").cast("double") / F.col("qty"), 6).alias("return_share"),
    )
    return w.unpivot(["entity", "date"], list(MARKET_INDICATORS), "indicator", "value").select(
        "entity", "indicator", "date", "value")


def panel_q(lm: DataFrame) -> DataFrame:
    """Long quarterly levels (entity, target, date, level) from :func:`line_months`."""
    w = line_quarters(lm).select(
        "entity", "date",
        from_cents("gmv_c").alias("gmv"),
        from_cents("net_c").alias("net_sales"),
        F.col("qty").cast("double").alias("qty"),
    )
    return w.unpivot(["entity", "date"], list(QUARTERLY_TARGETS), "target", "level").select(
        "entity", "target", "date", "level")


def index_m(spine_m: DataFrame) -> DataFrame:
    """Month-on-month revenue index 100*x_t/x_{t-1} on a dense monthly spine."""
    rev = spine_m.filter(F.col("indicator") == "revenue")
    w = Window.partitionBy("entity", "indicator").orderBy("date")
    return rev.select(
        "entity", F.lit("revenue_idx").alias("indicator"), "date",
        round_fixed(100 * F.col("value") / F.lag("value", 1).over(w), 6).alias("value"),
    )


def month_spine(panel: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """A monthly panel on the dense spine between two months."""
    return densify(panel, SERIES_KEYS, ["value"], lo, hi, 1)


def bounds_of(monthly: DataFrame) -> tuple[dt.date, dt.date, dt.date]:
    """First month, last month and last day of an (entity, date, ..., last_day) aggregate: three scalars back."""
    r = monthly.agg(F.min("date").alias("lo"), F.max("date").alias("hi"), F.max("last_day").alias("last_day")).first()
    return r["lo"], r["hi"], r["last_day"]
