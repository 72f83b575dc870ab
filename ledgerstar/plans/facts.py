"""Gold facts and the bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerstar.functions.columns import (days_between, discount_amount, gross_amount, net_amount, ratio,
                                          surrogate_key)
from ledgerstar.operators.intervals import asof_join
from ledgerstar.operators.star import bridge, literal_key_join, resolve_dates, resolve_fk

REPORTING_CURRENCY = "USD"


def header_keys(header: DataFrame, dims: dict) -> DataFrame:
    """Resolve every header-level foreign key once, at header grain.

    Both facts use it, and the line fact joins it to the lines afterwards, so the
    customer / geography joins run over orders, not over the (larger) lines. The
    SCD2 customer is joined as of the order date; bill-to and ship-to use the same
    geography dimension; the three date roles reuse one broadcast date spine.
    """
    h = header
    h = asof_join(h, dims["customer"], "customer_id", "order_date", select={"sk_customer": "sk_customer"})
    h = h.withColumn("sk_customer", F.coalesce("sk_customer", F.lit("-1")))
    h = resolve_fk(h, dims["salesperson"], {"sales_person_id": "salesperson_id"}, "sk_salesperson")
    h = literal_key_join(h, dims["currency"], "currency_code", REPORTING_CURRENCY, "sk_currency", "sk_currency")
    h = resolve_fk(h, dims["territory"], {"territory_id": "territory_id"}, "sk_territory")
    h = resolve_fk(h, dims["ship_method"], {"ship_method_id": "ship_method_id"}, "sk_ship_method")
    h = h.withColumn("__status_key", surrogate_key("order_status", "online_order_flag"))
    h = resolve_fk(h, dims["order_status"], {"__status_key": "sk_order_status"}, "sk_order_status",
                   unknown="-1").drop("__status_key")
    h = resolve_fk(h, dims["geography"], {"bill_to_address_id": "address_id"}, "sk_geography",
                   out="sk_bill_to_geography")
    h = resolve_fk(h, dims["geography"], {"ship_to_address_id": "address_id"}, "sk_geography",
                   out="sk_ship_to_geography")
    h = resolve_dates(h, dims["date"], {"sk_order_date": "order_date", "sk_due_date": "due_date",
                                        "sk_ship_date": "ship_date"})
    return h


LINE_FACT_COLUMNS = [
    "sk_sales_order_line", "sales_order_id", "sales_order_detail_id", "sales_order_number",
    "sk_product", "sk_customer", "sk_salesperson", "sk_territory", "sk_special_offer", "sk_ship_method",
    "sk_order_status", "sk_currency", "sk_bill_to_geography", "sk_ship_to_geography",
    "currency_rate_id", "is_multicurrency_order", "sk_order_date", "sk_due_date", "sk_ship_date",
    "order_qty", "unit_price", "discount_pct", "gross_amount", "discount_amount", "net_amount",
    "unit_standard_cost", "total_cost", "is_fallback_cost", "gross_margin",
    "list_price_at_order_date", "effective_discount_pct",
    "allocated_freight", "allocated_tax", "line_share_of_order", "source_modified_date",
]


def _as_date(c: str):
    """First day that begins at or after a date or timestamp."""
    d = F.to_date(F.col(c))
    return F.date_add(d, (F.col(c).cast("timestamp_ntz") > d.cast("timestamp_ntz")).cast("int"))


def product_timeline(dim_product: DataFrame, cost_iv: DataFrame, price_iv: DataFrame) -> DataFrame:
    """Product versions, cost intervals and price intervals as one interval table.

    The bounds of all three cut a product's time into segments within which nothing changes;
    each segment takes the version, cost and price that hold on its first day. A fact then
    needs one join on the product instead of three, and that one join can be split by AQE
    when a product is hot.
    """
    versions = dim_product.select("product_id", "sk_product", F.col("standard_cost").alias("version_cost"),
                                  _as_date("valid_from").alias("valid_from"), _as_date("valid_to").alias("valid_to"))
    bounds = None
    for iv in (versions, cost_iv, price_iv):
        for end in ("valid_from", "valid_to"):
            b = iv.select("product_id", F.col(end).cast("date").alias("valid_from"))
            bounds = b if bounds is None else bounds.unionByName(b)
    following = W.partitionBy("product_id").orderBy("valid_from")   # a product has few bounds
    seg = bounds.distinct().withColumn("valid_to", F.lead("valid_from").over(following)).where("valid_to is not null")
    seg = asof_join(seg.withColumnsRenamed({"valid_from": "seg_from", "valid_to": "seg_to"}), versions, "product_id", "seg_from",
                    select=["sk_product", "version_cost"])
    seg = asof_join(seg, cost_iv, "product_id", "seg_from", select={"standard_cost": "interval_cost", "is_fallback_cost": "is_fallback_cost"})
    seg = asof_join(seg, price_iv, "product_id", "seg_from", select=["list_price"])
    return seg.withColumnsRenamed({"seg_from": "valid_from", "seg_to": "valid_to"})


def fct_sales_order_line(detail: DataFrame, header_resolved: DataFrame, dims: dict, timeline: DataFrame,
                         rollup: DataFrame | None = None) -> DataFrame:
    """Line-grain fact: every source line exactly once (inner join to its header, left
    joins to everything else, unknown member on a miss).

    * product version, cost and list price come from one join to the product timeline as of
      the order date (equi-join on the product key with a half-open range residual), which
      is the last join, so AQE can split a hot product;
    * freight and tax are allocated by the line's share of the order's net total;
      the total comes from *all* lines of the order: the shared ``rollup`` when given (it must
      be when ``detail`` is an incremental slice), else a grouped sum over ``detail``.
    """
    net = net_amount("order_quantity", "unit_price", "unit_price_discount")
    hcols = ["sales_order_id", "sales_order_number", "order_date", "customer_id", "currency_rate_id",
             "freight_amount", "tax_amount", "sk_customer", "sk_salesperson", "sk_territory", "sk_ship_method",
             "sk_order_status", "sk_currency", "sk_bill_to_geography", "sk_ship_to_geography",
             "sk_order_date", "sk_due_date", "sk_ship_date"]
    lines = detail.withColumn("__net", net).join(header_resolved.select(*hcols), "sales_order_id", "inner")
    # Order totals from all lines of the order: a grouped sum (partial aggregation, so an
    # order with very many lines is pre-reduced map-side), joined back on the order key
    # on which the lines are already partitioned for the header join.
    if rollup is not None:
        totals = rollup.select("sales_order_id", F.col("computed_subtotal").alias("__order_net"))
    else:
        totals = detail.groupBy("sales_order_id").agg(F.sum(net).alias("__order_net"))
    lines = lines.join(totals, "sales_order_id", "left")

    lines = resolve_fk(lines, dims["special_offer"], {"special_offer_id": "special_offer_id"}, "sk_special_offer")
    lines = asof_join(lines, timeline, "product_id", "order_date",
                      select={"sk_product": "sk_product", "version_cost": "__p_cost", "interval_cost": "__pc_cost",
                              "is_fallback_cost": "__pc_fallback", "list_price": "list_price_at_order_date"})

    cost = F.coalesce(F.col("__pc_cost"), F.col("__p_cost"), F.lit(0))
    return lines.select(
        surrogate_key("sales_order_id", "sales_order_detail_id").alias("sk_sales_order_line"),
        "sales_order_id", "sales_order_detail_id", "sales_order_number",
        F.coalesce("sk_product", F.lit("-1")).alias("sk_product"),
        "sk_customer", "sk_salesperson", "sk_territory", "sk_special_offer", "sk_ship_method",
        "sk_order_status", "sk_currency", "sk_bill_to_geography", "sk_ship_to_geography",
        "currency_rate_id", F.col("currency_rate_id").isNotNull().alias("is_multicurrency_order"),
        "sk_order_date", "sk_due_date", "sk_ship_date",
        F.col("order_quantity").alias("order_qty"), "unit_price",
        F.col("unit_price_discount").alias("discount_pct"),
        gross_amount("order_quantity", "unit_price").alias("gross_amount"),
        discount_amount("order_quantity", "unit_price", "unit_price_discount").alias("discount_amount"),
        F.col("__net").alias("net_amount"),
        cost.alias("unit_standard_cost"),
        (cost * F.col("order_quantity")).alias("total_cost"),
        F.coalesce(F.col("__pc_fallback"), F.lit(True)).alias("is_fallback_cost"),
        (F.col("__net") - cost * F.col("order_quantity")).alias("gross_margin"),
        "list_price_at_order_date",
        F.when(F.col("list_price_at_order_date") > 0,
               F.lit(1.0) - F.col("unit_price").cast("double") / F.col("list_price_at_order_date").cast("double"))
         .otherwise(F.lit(0.0)).alias("effective_discount_pct"),
        (F.col("freight_amount").cast("double") * ratio("__net", "__order_net")).alias("allocated_freight"),
        (F.col("tax_amount").cast("double") * ratio("__net", "__order_net")).alias("allocated_tax"),
        ratio("__net", "__order_net").alias("line_share_of_order"),
        F.col("modified_date").alias("source_modified_date"),
    )


ROLLUP = ["line_count", "total_qty", "distinct_products", "computed_subtotal"]


def order_rollup(detail: DataFrame) -> DataFrame:
    """Per order: lines, quantity, distinct products, computed subtotal."""
    return detail.groupBy("sales_order_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("order_quantity").alias("total_qty"),
        F.countDistinct("product_id").alias("distinct_products"),
        F.sum(net_amount("order_quantity", "unit_price", "unit_price_discount")).alias("computed_subtotal"))


def fct_sales_order(header_resolved: DataFrame, detail: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """Header-grain fact: unallocated money, line roll-up and variance, fulfilment lags. Headers that carry
    the roll-up's columns are not joined to it again."""
    h = header_resolved
    if not set(ROLLUP) <= set(h.columns):
        h = h.join(rollup if rollup is not None else order_rollup(detail), "sales_order_id", "left")
    return h.select(
        surrogate_key("sales_order_id").alias("sk_sales_order"),
        "sales_order_id", "sales_order_number", "purchase_order_number", "account_number",
        "sk_customer", "sk_salesperson", "sk_territory", "sk_ship_method", "sk_order_status", "sk_currency",
        "sk_bill_to_geography", "sk_ship_to_geography", "currency_rate_id",
        F.col("currency_rate_id").isNotNull().alias("is_multicurrency_order"),
        "sk_order_date", "sk_due_date", "sk_ship_date",
        F.col("sub_total").alias("subtotal"), "tax_amount", F.col("freight_amount").alias("freight"), "total_due",
        "line_count", "total_qty", "distinct_products", "computed_subtotal",
        F.round(F.col("sub_total") - F.col("computed_subtotal"), 2).alias("subtotal_variance"),
        days_between("order_date", "ship_date").alias("days_to_ship"),
        days_between("order_date", "due_date").alias("days_promised"),
        F.when(F.col("ship_date").isNull(), F.lit(None).cast("boolean"))
         .when(F.col("ship_date") <= F.col("due_date"), True).otherwise(False).alias("is_shipped_on_time"),
        "online_order_flag", "revision_number",
        F.col("modified_date").alias("source_modified_date"),
    )


def fct_sales_quota(quota: DataFrame, dim_salesperson: DataFrame, dim_date: DataFrame) -> DataFrame:
    q = resolve_fk(quota, dim_salesperson, {"business_entity_id": "salesperson_id"}, "sk_salesperson")
    q = resolve_fk(q, dim_date, {"quota_date": "date_actual"}, "sk_date", out="sk_quota_date", broadcast=True)
    return q.select(
        surrogate_key("business_entity_id", F.date_format("quota_date", "yyyy-MM-dd")).alias("sk_sales_quota"),
        "sk_salesperson", "sk_quota_date",
        F.col("business_entity_id").alias("salesperson_id"), "quota_date",
        F.col("sales_quota").alias("quota_amount"))


def bridge_order_sales_reason(pairs: DataFrame, dim_reason: DataFrame) -> DataFrame:
    return bridge(pairs, "sales_order_id", "sales_reason_id", dim_reason, "sales_reason_id", "sk_sales_reason",
                  "sk_order_sales_reason", "sk_sales_reason")
