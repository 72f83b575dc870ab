"""Business questions on top of the star: dashboard pages (BQ) and documented measures (MS)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerstar.functions.columns import ratio
from ledgerstar.operators.rollup import bitmap_rows, merge_bitmaps
from ledgerstar.operators.star import weighted_rollup

LINE_SUMS = ["net_amount", "gross_margin", "total_cost", "order_qty"]


def line_months(fct_line: DataFrame) -> DataFrame:
    """The line fact by order month: sums, and bitmaps of the order numbers from which coarser counts are made."""
    month = F.floor(F.col("sk_order_date") / F.lit(100)).cast("int")
    return bitmap_rows(fct_line, {"order_month": month}, "sales_order_id", LINE_SUMS)


def kpis(fct_line: DataFrame) -> DataFrame:
    """Revenue, margin (both rounded to units) and distinct orders: one global aggregate."""
    return fct_line.agg(F.round(F.sum("net_amount"), 0).alias("revenue"),
                        F.round(F.sum("gross_margin"), 0).alias("margin"),
                        F.countDistinct("sales_order_id").alias("orders"))


def kpis_of_months(months: DataFrame) -> DataFrame:
    """``kpis`` from the monthly rows."""
    total = merge_bitmaps(months, [], "orders", ["net_amount", "gross_margin"])
    return total.select(F.round("net_amount", 0).alias("revenue"), F.round("gross_margin", 0).alias("margin"), "orders")


def _with_dates(fct_line: DataFrame, dim_date: DataFrame, cols: list[str]) -> DataFrame:
    d = F.broadcast(dim_date.select("sk_date", *cols))       # date spine: bounded by its parameter
    return fct_line.join(d, fct_line.sk_order_date == d.sk_date, "inner")


def revenue_by_month(fct_line: DataFrame, dim_date: DataFrame) -> DataFrame:
    j = _with_dates(fct_line, dim_date, ["year_month"])
    return j.groupBy("year_month").agg(F.round(F.sum("net_amount"), 0).alias("revenue")).orderBy("year_month")


def revenue_by_category(fct_line: DataFrame, dim_product: DataFrame) -> DataFrame:
    j = fct_line.join(dim_product.select("sk_product", "category_name"), "sk_product", "inner")
    return (j.groupBy(F.coalesce("category_name", F.lit("(n/a)")).alias("category"))
             .agg(F.round(F.sum("net_amount"), 0).alias("revenue")).orderBy(F.desc("revenue")))


def segments(mart_rfm: DataFrame) -> DataFrame:
    return (mart_rfm.groupBy("rfm_segment")
            .agg(F.count(F.lit(1)).alias("customers"), F.round(F.sum("lifetime_margin"), 0).alias("margin"))
            .orderBy(F.desc("margin")))


def top_customers(mart_rfm: DataFrame, k: int = 20) -> DataFrame:
    """Top ``k`` by lifetime margin (the limit is the feature); ties by customer key."""
    return (mart_rfm.orderBy(F.desc("lifetime_margin"), F.asc("sk_customer")).limit(k)
            .select(F.col("customer_display_name").alias("customer"), F.col("customer_type").alias("type"),
                    F.col("frequency_orders").alias("orders"), F.round("monetary_total", 0).alias("amount"),
                    F.round("lifetime_margin", 0).alias("clv_margin"), F.col("rfm_segment").alias("segment")))


def abc_summary(mart_pareto: DataFrame) -> DataFrame:
    return (mart_pareto.groupBy("abc_class")
            .agg(F.count(F.lit(1)).alias("products"), F.round(F.sum("revenue"), 0).alias("revenue"),
                 F.round(F.sum("margin"), 0).alias("margin")).orderBy("abc_class"))


def pareto_curve(mart_pareto: DataFrame) -> DataFrame:
    return mart_pareto.select(F.col("revenue_rank").alias("rank"),
                              F.round(F.col("cumulative_revenue_pct") * 100, 2).alias("cumulative_pct")) \
        .orderBy("rank")


def top_products(mart_pareto: DataFrame, k: int = 20) -> DataFrame:
    return (mart_pareto.orderBy(F.desc("revenue"), F.asc("sk_product")).limit(k)
            .select(F.col("product_name").alias("product"), F.col("category_name").alias("category"),
                    F.round("revenue", 0).alias("revenue"), F.round(F.col("margin_pct") * 100, 1).alias("margin_pct"),
                    F.col("abc_class").alias("class")))


def attainment(mart_quota: DataFrame) -> DataFrame:
    return (mart_quota.where(F.col("quota_amount").isNotNull())
            .select(F.col("salesperson_name").alias("seller"), F.col("year_quarter").alias("quarter"),
                    F.round("quota_amount", 0).alias("quota"), F.round("actual_revenue", 0).alias("actual"),
                    F.round(F.col("attainment_pct") * 100, 1).alias("attainment_pct"),
                    F.col("attainment_status").alias("status"))
            .orderBy("quarter", F.desc("attainment_pct")))


def attainment_by_quarter(mart_quota: DataFrame) -> DataFrame:
    return (mart_quota.where(F.col("quota_amount").isNotNull()).groupBy("year_quarter")
            .agg(F.round(F.avg("attainment_pct") * 100, 1).alias("mean_attainment_pct")).orderBy("year_quarter"))


# ------------------------------------------------------------------ measures
def base_measures(months: DataFrame, dim_date: DataFrame, by: str = "year") -> DataFrame:
    """Revenue, margin, cost, quantity and distinct orders by an attribute of months, from the monthly rows."""
    spine = dim_date.select(F.floor(F.col("sk_date") / F.lit(100)).cast("int").alias("order_month"), by).distinct()
    j = months.join(F.broadcast(spine), "order_month")       # at most a row per month of the spine
    return merge_bitmaps(j, [by], "orders", LINE_SUMS).select(
        by, F.col("net_amount").alias("revenue"), F.col("gross_margin").alias("margin"), F.col("total_cost").alias("cost"),
        F.col("order_qty").alias("quantity"), "orders")


def margin_rate_and_basket(base: DataFrame, by: str = "year") -> DataFrame:
    return base.select(by, ratio("margin", "revenue").alias("margin_rate"),
                       ratio("revenue", "orders").alias("mean_basket"))


def monthly_revenue(fct_line: DataFrame, dim_date: DataFrame) -> DataFrame:
    j = _with_dates(fct_line, dim_date, ["year", "month"])
    return j.groupBy("year", "month").agg(F.sum("net_amount").alias("revenue"))


def year_to_date(monthly: DataFrame) -> DataFrame:
    """Running revenue within each year, month by month (window per year: 12 rows)."""
    w = W.partitionBy("year").orderBy("month").rowsBetween(W.unboundedPreceding, W.currentRow)
    return monthly.withColumn("revenue_ytd", F.sum("revenue").over(w))


def vs_last_year(monthly: DataFrame) -> DataFrame:
    """Same month of the previous year and growth; an equi-join on (year - 1, month)."""
    prev = monthly.select((F.col("year") + 1).alias("year"), "month", F.col("revenue").alias("revenue_last_year"))
    j = monthly.join(prev, ["year", "month"], "left")
    return j.withColumn("growth_pct", ratio(F.col("revenue") - F.col("revenue_last_year"), "revenue_last_year"))


def revenue_by_reason(fct_line: DataFrame, bridge_df: DataFrame, dim_reason: DataFrame) -> DataFrame:
    """Revenue spread over sales reasons through the bridge (weights sum to 1 per order)."""
    w = weighted_rollup(fct_line, bridge_df, "sales_order_id", "sk_sales_reason", "net_amount", out="revenue")
    j = w.join(dim_reason.select("sk_sales_reason", "sales_reason_name"), "sk_sales_reason", "left")
    return j.select("sk_sales_reason", "sales_reason_name", F.round("revenue", 2).alias("revenue"))


def quota_measures(mart_quota: DataFrame, by: str = "year_quarter") -> DataFrame:
    return (mart_quota.groupBy(by).agg(F.sum("quota_amount").alias("quota"), F.sum("actual_revenue").alias("actual"))
            .withColumn("attainment_rate", ratio("actual", "quota")))
