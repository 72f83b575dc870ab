"""Marts: customer RFM / lifetime value, product ABC-Pareto, seller quota attainment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.functions.columns import days_between, ratio
from ledgerstar.operators.selection import ntiles
from ledgerstar.operators.windows import global_rank
from ledgerstar.session import written

# RFM segment labels (first matching rule wins, in this order) and the
# quota attainment statuses (no quota, reached, not reached).
SEGMENTS = ["Champions", "Loyaux", "Nouveaux", "A risque", "A reconquerir", "Dormants"]
ATTAINMENT = ["Sans quota", "Atteint", "Non atteint"]


def rfm_base(orders: DataFrame, as_of: str | None = None) -> DataFrame:
    """Recency (days from the customer's last order to the global last order, or to
    ``as_of``), frequency (distinct orders), money (sum of total due), first / last date."""
    if as_of is None:
        ref = orders.agg(F.max("order_date")).scalar()   # scalar subquery, no Cartesian product
    else:
        ref = F.lit(as_of).cast("date")
    return orders.groupBy("sk_customer").agg(
        days_between(F.max("order_date"), ref).alias("recency_days"),
        F.countDistinct("sales_order_id").alias("frequency_orders"),
        F.sum("total_due").alias("monetary_total"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"))


def rfm_scores(base: DataFrame, k: int = 5, tie: str = "sk_customer") -> DataFrame:
    """Quintile scores; recency inverted (``k + 1 - ntile``). Each score orders by its
    measure then by ``tie``, so that equal measures are split deterministically. The bounds of all three
    are selected together; ``base`` is written first, since the selection scans it several times."""
    s = ntiles(written(base, "rfm-base"), {"__r": (["recency_days", tie], k), "f_score": (["frequency_orders", tie], k), "m_score": (["monetary_total", tie], k)})
    return s.withColumn("r_score", (F.lit(k + 1) - F.col("__r")).cast("bigint")).drop("__r")


def rfm_segment(r: Column, f: Column) -> Column:
    """First matching rule wins."""
    return (F.when((r >= 4) & (f >= 4), SEGMENTS[0])
             .when((r >= 4) & (f >= 2), SEGMENTS[1])
             .when(r >= 4, SEGMENTS[2])
             .when((r >= 3) & (f >= 3), SEGMENTS[3])
             .when((r <= 2) & (f >= 4), SEGMENTS[4])
             .otherwise(SEGMENTS[5]))


def lifetime_value(fct_line: DataFrame) -> DataFrame:
    return fct_line.groupBy("sk_customer").agg(F.sum("net_amount").alias("total_revenue"),
                                                F.sum("gross_margin").alias("total_margin"))


def mart_customer_clv_rfm(fct_order: DataFrame, fct_line: DataFrame, dim_customer: DataFrame,
                          dim_date: DataFrame) -> DataFrame:
    """One row per customer version key (the grain of ``sk_customer``); the unknown member
    takes part in the scoring and is removed afterwards."""
    orders = fct_order.join(F.broadcast(dim_date.select("sk_date", "date_actual")),
                            fct_order.sk_order_date == F.col("sk_date"), "inner") \
        .select("sk_customer", "sales_order_id", F.col("date_actual").alias("order_date"), "subtotal", "total_due")
    s = rfm_scores(rfm_base(orders))
    c = dim_customer.select("sk_customer", "customer_id", "customer_type", "customer_display_name", "territory_id")
    m = lifetime_value(fct_line)
    j = s.join(c, "sk_customer", "left").join(m, "sk_customer", "left")
    return j.where(F.col("sk_customer") != "-1").select(
        "sk_customer", "customer_id", "customer_type", "customer_display_name", "territory_id",
        "recency_days", "frequency_orders", "monetary_total", "first_order_date", "last_order_date",
        "r_score", "f_score", "m_score",
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_score"),
        F.concat(F.col("r_score").cast("string"), F.col("f_score").cast("string"),
                 F.col("m_score").cast("string")).alias("rfm_cell"),
        rfm_segment(F.col("r_score"), F.col("f_score")).alias("rfm_segment"),
        F.coalesce("total_revenue", F.lit(0)).alias("lifetime_revenue"),
        F.coalesce("total_margin", F.lit(0)).alias("lifetime_margin"))


def abc_class(share: Column, a: float = 0.80, b: float = 0.95) -> Column:
    """A up to ``a`` of revenue (running share including the product), B up to ``b``, else C."""
    return F.when(share <= a, "A").when(share <= b, "B").otherwise("C")


def mart_product_abc_pareto(fct_line: DataFrame, dim_product: DataFrame) -> DataFrame:
    ps = fct_line.where(F.col("sk_product") != "-1").groupBy("sk_product").agg(
        F.sum("net_amount").alias("revenue"), F.sum("gross_margin").alias("margin"),
        F.sum("order_qty").alias("units_sold"), F.count(F.lit(1)).alias("line_count"))
    r = global_rank(ps, [("revenue", "desc"), "sk_product"], value="revenue", rank_col="revenue_rank",
                    running_col="running_revenue", total_col="total_revenue")
    r = r.withColumn("cumulative_revenue_pct", ratio("running_revenue", "total_revenue"))
    p = dim_product.select("sk_product", "product_id", "product_name", "subcategory_name", "category_name")
    j = r.join(p, "sk_product", "left")
    return j.select("sk_product", "product_id", "product_name", "subcategory_name", "category_name",
                    "revenue", "margin", ratio("margin", "revenue").alias("margin_pct"), "units_sold", "line_count",
                    "revenue_rank", "cumulative_revenue_pct",
                    abc_class(F.col("cumulative_revenue_pct")).alias("abc_class"))


def mart_seller_quota_attainment(fct_line: DataFrame, fct_quota: DataFrame, dim_salesperson: DataFrame,
                                 dim_date: DataFrame) -> DataFrame:
    d = F.broadcast(dim_date.select("sk_date", "year_quarter", "year", "quarter"))
    actuals = (fct_line.where(F.col("sk_salesperson") != -1)
               .join(d, fct_line.sk_order_date == d.sk_date, "inner")
               .groupBy("sk_salesperson", "year_quarter", "year", "quarter")
               .agg(F.sum("net_amount").alias("actual_revenue"), F.sum("gross_margin").alias("actual_margin"),
                    F.countDistinct("sales_order_id").alias("orders")))
    quotas = (fct_quota.where(F.col("sk_salesperson") != -1)
              .join(d.select("sk_date", "year_quarter"), fct_quota.sk_quota_date == F.col("sk_date"), "inner")
              .groupBy("sk_salesperson", "year_quarter").agg(F.sum("quota_amount").alias("quota_amount")))
    a = actuals.alias("a")
    q = quotas.alias("q")
    c = a.join(q, (F.col("a.sk_salesperson") == F.col("q.sk_salesperson"))
               & (F.col("a.year_quarter") == F.col("q.year_quarter")), "full_outer").select(
        F.coalesce("a.sk_salesperson", "q.sk_salesperson").alias("sk_salesperson"),
        F.coalesce("a.year_quarter", "q.year_quarter").alias("year_quarter"),
        F.col("a.year").alias("year"), F.col("a.quarter").alias("quarter"),
        F.coalesce("a.actual_revenue", F.lit(0)).alias("actual_revenue"),
        F.coalesce("a.actual_margin", F.lit(0)).alias("actual_margin"),
        F.coalesce("a.orders", F.lit(0)).alias("orders"),
        F.col("q.quota_amount").alias("quota_amount"))
    sp = dim_salesperson.select("sk_salesperson", "salesperson_id", "salesperson_name")
    j = c.join(sp, "sk_salesperson", "left")
    return j.select(
        "sk_salesperson", "salesperson_id", "salesperson_name", "year_quarter", "year", "quarter",
        "quota_amount", "actual_revenue", "actual_margin", "orders",
        (F.col("actual_revenue") - F.coalesce("quota_amount", F.lit(0))).alias("variance_to_quota"),
        ratio("actual_revenue", "quota_amount").alias("attainment_pct"),
        F.when(F.col("quota_amount").isNull(), ATTAINMENT[0])
         .when(F.col("actual_revenue") >= F.col("quota_amount"), ATTAINMENT[1])
         .otherwise(ATTAINMENT[2]).alias("attainment_status"))
