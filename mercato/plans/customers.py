"""Customer lifetime value (RFM scores, LTV, tier) and its reports.

Scale notes
* Orders are aggregated per ``customer_id`` *before* the join with
  customers, so at most one row per customer crosses the join (the
  source model joins all order lines, then groups by seven customer
  attributes).  The status filter is applied to the order side before that
  aggregate, which keeps customers without qualifying orders (the filter
  sits in the outer-join condition in the source model).
* The per-customer aggregate uses partial aggregation; its one
  ``countDistinct`` is keyed on (customer_id, order_id) first, so a
  customer with a third of all lines is still split across tasks.
* Global quintiles (``rfm_ntile``) are told by their boundaries (``ntiles``) instead
  of a single-partition window.

Fixed values (score bands, tier limits and weights) of the source model:
  recency days: NULL -> 1, <= 7 -> 5, <= 30 -> 4, <= 60 -> 3, <= 90 -> 2, else 1
  distinct orders: >= 10 -> 5, >= 5 -> 4, >= 3 -> 3, >= 1 -> 2, else 1
  revenue: >= 5000 -> 5, >= 2000 -> 4, >= 500 -> 3, > 0 -> 2, else 1
  tier on r+f+m: >= 12 Platinum, >= 9 Gold, >= 6 Silver, else Bronze
  ltv_score = (r*0.3 + f*0.3 + m*0.4) * revenue / days_as_customer * 365
  quintile tiers on r+f+m: >= 12 Champions, >= 9 Loyal, >= 6 Potential, else At Risk
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.money import ratio, round_to, sum_gross, sum_net
from mercato.functions.timefn import as_of_col, calendar_days
from mercato.operators.buckets import ntiles
from mercato.operators.ntile import ntile_window

TIERS = ("Platinum", "Gold", "Silver", "Bronze")
QUINTILE_TIERS = ("Champions", "Loyal", "Potential", "At Risk")
QUALIFYING_STATUSES = ("COMPLETED", "SHIPPED")

CLV_COLUMNS = (
    "customer_id", "customer_name", "email", "segment", "region", "customer_since",
    "days_as_customer", "total_orders", "total_revenue", "total_units",
    "first_order_date", "last_order_date", "days_since_last_order", "avg_order_value",
    "avg_days_between_orders", "recency_score", "frequency_score", "monetary_score",
    "rfm_score", "ltv_score", "customer_tier",
)


def recency_score(days):
    return (F.when(days.isNull(), 1).when(days <= 7, 5).when(days <= 30, 4)
            .when(days <= 60, 3).when(days <= 90, 2).otherwise(1))


def frequency_score(orders):
    return (F.when(orders >= 10, 5).when(orders >= 5, 4).when(orders >= 3, 3)
            .when(orders >= 1, 2).otherwise(1))


def monetary_score(revenue):
    return (F.when(revenue >= 5000, 5).when(revenue >= 2000, 4).when(revenue >= 500, 3)
            .when(revenue > 0, 2).otherwise(1))


def tier_of(score):
    return (F.when(score >= 12, "Platinum").when(score >= 9, "Gold")
            .when(score >= 6, "Silver").otherwise("Bronze"))


def _weighted(r, f, m):
    w = lambda x: F.lit(Decimal(x))  # noqa: E731  exact decimal weights
    return (r * w("0.3") + f * w("0.3") + m * w("0.4")).cast("double")


def customer_order_totals(orders: DataFrame) -> DataFrame:
    """Qualifying (COMPLETED/SHIPPED) order lines aggregated per customer."""
    return (
        orders.filter(F.col("status").isin(*QUALIFYING_STATUSES))
        .groupBy("customer_id")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            sum_net().alias("total_revenue"),
            F.sum("quantity").cast("long").alias("total_units"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )


def clv(customers: DataFrame, orders: DataFrame, as_of=None) -> DataFrame:
    """The customer lifetime value table, one row per customer row."""
    now = as_of_col(as_of)
    totals = customer_order_totals(orders)
    base = (
        customers.select("customer_id", "first_name", "last_name", "email", "segment",
                         "region", "created_at")
        .join(totals, "customer_id", "left")
        .select(
            "customer_id",
            F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer_name"),
            "email", "segment", "region",
            F.col("created_at").alias("customer_since"),
            calendar_days("created_at", now).alias("days_as_customer"),
            F.coalesce("total_orders", F.lit(0).cast("long")).alias("total_orders"),
            F.coalesce("total_revenue", F.lit(0)).alias("total_revenue"),
            F.coalesce("total_units", F.lit(0).cast("long")).alias("total_units"),
            "first_order_date", "last_order_date",
        )
    )
    scored = (
        base
        .withColumn("days_since_last_order", calendar_days("last_order_date", now))
        .withColumn("recency_score", recency_score(F.col("days_since_last_order")))
        .withColumn("frequency_score", frequency_score(F.col("total_orders")))
        .withColumn("monetary_score", monetary_score(F.col("total_revenue")))
    )
    return scored.select(
        "customer_id", "customer_name", "email", "segment", "region", "customer_since",
        "days_as_customer", "total_orders",
        round_to("total_revenue", 2).alias("total_revenue"),
        "total_units", "first_order_date", "last_order_date", "days_since_last_order",
        round_to(F.when(F.col("total_orders") > 0, ratio("total_revenue", "total_orders"))
                 .otherwise(F.lit(0.0)), 2).alias("avg_order_value"),
        round_to(F.when(F.col("total_orders") > 1,
                        ratio(calendar_days("first_order_date", "last_order_date"),
                              F.col("total_orders") - 1)), 1)
        .alias("avg_days_between_orders"),
        "recency_score", "frequency_score", "monetary_score",
        (F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"))
        .alias("rfm_score"),
        round_to(_weighted(F.col("recency_score"), F.col("frequency_score"),
                           F.col("monetary_score"))
                 * (ratio("total_revenue", "days_as_customer") * F.lit(365.0)), 2)
        .alias("ltv_score"),
        tier_of(F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"))
        .alias("customer_tier"),
    )


def tier_distribution(clv_table: DataFrame) -> DataFrame:
    return (
        clv_table.groupBy("customer_tier")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            round_to(ratio(F.sum("total_revenue"), F.count("total_revenue")), 2)
            .alias("avg_revenue"),
            round_to(ratio(F.sum("ltv_score"), F.count("ltv_score")), 2).alias("avg_ltv_score"),
        )
        .orderBy(F.col("avg_ltv_score").desc_nulls_last(), "customer_tier")
    )


def top_customers_ltv(clv_table: DataFrame, n: int = 10) -> DataFrame:
    return (
        clv_table.filter(F.col("ltv_score").isNotNull())
        .orderBy(F.col("ltv_score").desc_nulls_last(), "customer_id")
        .limit(n)
        .select("customer_name", "segment", "region", "total_orders", "total_revenue",
                "ltv_score", "customer_tier")
    )


def top_customers_in_tier(clv_table: DataFrame, tier: str = "Platinum", n: int = 2) -> DataFrame:
    """'Top 2 Platinum customers by total revenue.'"""
    return (
        clv_table.filter(F.col("customer_tier") == tier)
        .orderBy(F.col("total_revenue").desc_nulls_last(), "customer_id")
        .limit(n)
        .select("customer_id", "customer_name", "total_revenue", "customer_tier")
    )


def rfm_metrics(orders: DataFrame, as_of=None) -> DataFrame:
    """Per customer with orders: recency days, distinct orders, gross revenue
    (all statuses, as in the quintile walkthrough)."""
    now = as_of_col(as_of)
    return (
        orders.groupBy("customer_id")
        .agg(
            F.max("order_date").alias("_last"),
            F.countDistinct("order_id").alias("frequency"),
            sum_gross().alias("monetary"),
        )
        .select("customer_id", calendar_days("_last", now).alias("recency_days"),
                "frequency", "monetary")
    )


def rfm_ntile(orders: DataFrame, as_of=None, buckets: int = 5,
              scalable: bool = True) -> DataFrame:
    """Quintile RFM: old recency -> 1, few orders / low revenue -> 1.

    Ties are broken by ``customer_id`` so the scores are deterministic.
    """
    metrics = rfm_metrics(orders, as_of)
    if scalable:
        first = F.lit(-(1 << 63))  # an order line without a customer sorts before all
        scored = ntiles(metrics, buckets, {"r_score": -F.col("recency_days"), "f_score": F.col("frequency"),
                                           "m_score": F.col("monetary")}, F.coalesce("customer_id", first))
    else:
        scored = metrics
        for key, score in ((F.col("recency_days").desc_nulls_last(), "r_score"),
                           (F.col("frequency").asc_nulls_last(), "f_score"),
                           (F.col("monetary").asc_nulls_last(), "m_score")):
            scored = ntile_window(scored, buckets, [key, F.col("customer_id").asc()], score)
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return scored.select(
        "customer_id", "recency_days", "frequency", "monetary", "r_score", "f_score",
        "m_score", total.alias("ltv_score"),
        F.when(total >= 12, "Champions").when(total >= 9, "Loyal")
        .when(total >= 6, "Potential").otherwise("At Risk").alias("customer_tier"),
    )
