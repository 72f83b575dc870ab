"""Registered queries: name -> (Spark plan over the input folder, DuckDB oracle SQL).

Every Spark plan reads the whole input tables (or data Spark derives from them) and
returns its result in comparison form (``canonical``). The SQL side spells out the
same output columns through ``oracle.canonical_select``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerstar.functions.columns import canonical
from ledgerstar.plans import business as BQ
from ledgerstar.plans import oracle as O
from ledgerstar.plans.warehouse import LINE_CLUSTER, Warehouse, clustered, shared
from ledgerstar.session import shuffles_dropped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return canonical(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return shared(spark, sf_dir)


# ------------------------------------------------------------------ column kinds of the big tables
K_HEADER = dict(sales_order_id="i", revision_number="i", order_date="d", due_date="d", ship_date="d",
                order_status="i", online_order_flag="i", sales_order_number="s", purchase_order_number="s",
                account_number="s", customer_id="i", sales_person_id="i", territory_id="i",
                bill_to_address_id="i", ship_to_address_id="i", ship_method_id="i", credit_card_id="i",
                currency_rate_id="i", sub_total="m", tax_amount="m", freight_amount="m", total_due="m",
                modified_date="d")
K_DETAIL = dict(sales_order_id="i", sales_order_detail_id="s", product_id="i", special_offer_id="i",
                order_quantity="i", unit_price="m", unit_price_discount="m", modified_date="d")
K_LINE = dict(
    sk_sales_order_line="s", sales_order_id="i", sales_order_detail_id="s", sales_order_number="s",
    sk_product="s", sk_customer="s", sk_salesperson="i", sk_territory="i", sk_special_offer="i",
    sk_ship_method="i", sk_order_status="s", sk_currency="s", sk_bill_to_geography="i",
    sk_ship_to_geography="i", currency_rate_id="i", is_multicurrency_order="b", sk_order_date="i",
    sk_due_date="i", sk_ship_date="i", order_qty="i", unit_price="m", discount_pct="m", gross_amount="m",
    discount_amount="m", net_amount="m", unit_standard_cost="i", total_cost="i", is_fallback_cost="b",
    gross_margin="m", list_price_at_order_date="i", effective_discount_pct="f", allocated_freight="f",
    allocated_tax="f", line_share_of_order="f", source_modified_date="d")
K_ORDER = dict(
    sk_sales_order="s", sales_order_id="i", sales_order_number="s", purchase_order_number="s",
    account_number="s", sk_customer="s", sk_salesperson="i", sk_territory="i", sk_ship_method="i",
    sk_order_status="s", sk_currency="s", sk_bill_to_geography="i", sk_ship_to_geography="i",
    currency_rate_id="i", is_multicurrency_order="b", sk_order_date="i", sk_due_date="i", sk_ship_date="i",
    subtotal="m", tax_amount="m", freight="m", total_due="m", line_count="i", total_qty="i",
    distinct_products="i", computed_subtotal="m", subtotal_variance="m", days_to_ship="i", days_promised="i",
    is_shipped_on_time="b", online_order_flag="i", revision_number="i", source_modified_date="d")
K_DIM = {
    "dim_date": dict(sk_date="i", date_actual="d", year="i", quarter="i", year_quarter="s", month="i",
                     month_name="s", month_name_short="s", year_month="s", week_of_year="i", day_of_month="i",
                     day_of_week="i", day_name="s", day_name_short="s", is_weekend="b"),
    "dim_product": dict(sk_product="s", product_id="i", product_name="s", product_number="s", standard_cost="i",
                        list_price="i", subcategory_name="s", category_name="s", valid_from="t", valid_to="t",
                        is_current="b", modified_date="d"),
    "dim_customer": dict(sk_customer="s", customer_id="i", person_id="i", store_id="i", territory_id="i",
                         customer_type="s", customer_name="s", store_name="s", customer_display_name="s",
                         valid_from="t", valid_to="t", is_current="b", modified_date="d"),
    "dim_geography": dict(sk_geography="i", address_id="i", address_line1="s", address_line2="s", city="s",
                          postal_code="s", state_province_code="s", state_name="s", country_region_code="s",
                          country_name="s", modified_date="d"),
    "dim_order_status": dict(sk_order_status="s", status_id="i", status_name="s", sales_channel="s"),
    "dim_currency": dict(sk_currency="s", currency_code="s", currency_name="s", modified_date="d"),
    "dim_sales_reason": dict(sk_sales_reason="i", sales_reason_id="i", sales_reason_name="s", reason_type="s",
                             modified_date="d"),
    "dim_salesperson": dict(sk_salesperson="i", salesperson_id="i", salesperson_name="s", job_title="s",
                            gender="s", marital_status="s", hire_date="d", sales_quota="m", bonus="m",
                            commission_percent="m", modified_date="d"),
    "dim_ship_method": dict(sk_ship_method="i", ship_method_id="i", ship_method_name="s", ship_base="i",
                            ship_rate="i", modified_date="d"),
    "dim_special_offer": dict(sk_special_offer="i", special_offer_id="i", discount_percent="m", offer_type="s",
                              offer_category="s", start_date="d", end_date="d", min_qty="i"),
    "dim_territory": dict(sk_territory="i", territory_id="i", territory_name="s", country_region_code="s",
                          territory_group="s", modified_date="d"),
}
K_RFM = dict(sk_customer="s", customer_id="i", customer_type="s", customer_display_name="s", territory_id="i",
             recency_days="i", frequency_orders="i", monetary_total="m", first_order_date="d",
             last_order_date="d", r_score="i", f_score="i", m_score="i", rfm_score="i", rfm_cell="s",
             rfm_segment="s", lifetime_revenue="m", lifetime_margin="m")
K_PARETO = dict(sk_product="s", product_id="i", product_name="s", subcategory_name="s", category_name="s",
                revenue="m", margin="m", margin_pct="f", units_sold="i", line_count="i", revenue_rank="i",
                cumulative_revenue_pct="f", abc_class="s")
K_QUOTA_MART = dict(sk_salesperson="i", salesperson_id="i", salesperson_name="s", year_quarter="s", year="i",
                    quarter="i", quota_amount="m", actual_revenue="m", actual_margin="m", orders="i",
                    variance_to_quota="m", attainment_pct="f", attainment_status="s")

# ------------------------------------------------------------------ silver
register("stg_orderdetail", O.canonical_select(K_DETAIL, "detail"))(lambda s, d: wh(s, d).detail)
register("stg_orderheader", O.canonical_select(K_HEADER, "header"))(lambda s, d: wh(s, d).header)
register("stg_address_dedup", O.canonical_select(
    dict(address_id="i", address_line1="s", address_line2="s", city="s", state_province_id="i", postal_code="s",
         modified_date="d"), "stg_address"))(lambda s, d: wh(s, d).address)

# ------------------------------------------------------------------ snapshots and intervals
_SNAP_P = dict(product_id="i", product_name="s", product_number="s", standard_cost="i", list_price="i",
               subcategory_id="i", modified_date="d", version_from="t", version_to="t")
register("scd_snapshot_product", O.canonical_select(_SNAP_P, "snap_product"))(lambda s, d: wh(s, d).snap_product)
_SNAP_C = dict(customer_id="i", person_id="i", store_id="i", territory_id="i", modified_date="d",
               version_from="t", version_to="t")
register("scd_snapshot_customer", O.canonical_select(_SNAP_C, "snap_customer"))(lambda s, d: wh(s, d).snap_customer)
register("scd_cost_intervals", O.canonical_select(
    dict(product_id="i", standard_cost="i", valid_from="d", valid_to="d", is_fallback_cost="b"), "cost_iv"))(
    lambda s, d: wh(s, d).cost_intervals)
register("scd_price_intervals", O.canonical_select(
    dict(product_id="i", list_price="i", valid_from="d", valid_to="d", is_fallback_price="b"), "price_iv"))(
    lambda s, d: wh(s, d).price_intervals)

# ------------------------------------------------------------------ dimensions
for _name, _kinds in K_DIM.items():
    def _mk(key):
        return lambda s, d: wh(s, d).dims[key]

    register(_name, O.canonical_select(_kinds, _name))(_mk(_name[4:]))

# ------------------------------------------------------------------ facts
register("fct_order_line", O.canonical_select(K_LINE, "fct_line"))(lambda s, d: wh(s, d).fct_line)
register("fct_order", O.canonical_select(K_ORDER, "fct_order"))(lambda s, d: wh(s, d).fct_order)
register("fct_quota", O.canonical_select(
    dict(sk_sales_quota="s", sk_salesperson="i", sk_quota_date="i", salesperson_id="i", quota_date="d",
         quota_amount="m"), "fct_quota"))(lambda s, d: wh(s, d).fct_quota)
register("fct_bridge", O.canonical_select(
    dict(sk_order_sales_reason="s", sales_order_id="i", sk_sales_reason="i", reason_count="i",
         allocation_factor="f"), "bridge"))(lambda s, d: wh(s, d).bridge)

# ------------------------------------------------------------------ marts
register("mart_rfm", O.canonical_select(K_RFM, "mart_rfm"))(lambda s, d: wh(s, d).mart_rfm)
register("mart_pareto", O.canonical_select(K_PARETO, "mart_pareto"))(lambda s, d: wh(s, d).mart_pareto)
register("mart_attainment", O.canonical_select(K_QUOTA_MART, "mart_quota"))(lambda s, d: wh(s, d).mart_quota)

# ------------------------------------------------------------------ dashboard pages
register("bq_kpis", O.canonical_select(
    {"revenue": "expr:m:round(sum(net_amount), 0)", "margin": "expr:m:round(sum(gross_margin), 0)",
     "orders": "expr:i:count(DISTINCT sales_order_id)"}, "fct_line"))(lambda s, d: BQ.kpis_of_months(wh(s, d).line_months))


def _bq_month(s, d):
    w = wh(s, d)
    return BQ.revenue_by_month(w.lines, w.dims["date"])


register("bq_revenue_by_month", O.canonical_select(
    {"year_month": "s", "revenue": "expr:m:round(sum(f.net_amount), 0)"},
    "fct_line f JOIN dim_date dd ON f.sk_order_date = dd.sk_date", extra="GROUP BY year_month"))(_bq_month)


def _bq_cat(s, d):
    w = wh(s, d)
    return BQ.revenue_by_category(w.lines, w.dims["product"])


register("bq_revenue_by_category", O.canonical_select(
    {"category": "expr:s:coalesce(p.category_name, '(n/a)')", "revenue": "expr:m:round(sum(f.net_amount), 0)"},
    "fct_line f JOIN dim_product p ON f.sk_product = p.sk_product",
    extra="GROUP BY coalesce(p.category_name, '(n/a)')"))(_bq_cat)

register("bq_segments", O.canonical_select(
    {"rfm_segment": "s", "customers": "expr:i:count(*)", "margin": "expr:m:round(sum(lifetime_margin), 0)"},
    "mart_rfm", extra="GROUP BY rfm_segment"))(lambda s, d: BQ.segments(wh(s, d).mart_rfm))

register("bq_top_customers", O.canonical_select(
    {"customer": "expr:s:customer_display_name", "type": "expr:s:customer_type", "orders": "expr:i:frequency_orders",
     "amount": "expr:m:round(monetary_total, 0)", "clv_margin": "expr:m:round(lifetime_margin, 0)",
     "segment": "expr:s:rfm_segment"},
    "mart_rfm", extra="ORDER BY lifetime_margin DESC, sk_customer LIMIT 20"))(
    lambda s, d: BQ.top_customers(wh(s, d).mart_rfm))

register("bq_abc_summary", O.canonical_select(
    {"abc_class": "s", "products": "expr:i:count(*)", "revenue": "expr:m:round(sum(revenue), 0)",
     "margin": "expr:m:round(sum(margin), 0)"}, "mart_pareto", extra="GROUP BY abc_class"))(
    lambda s, d: BQ.abc_summary(wh(s, d).mart_pareto))

register("bq_pareto_curve", O.canonical_select(
    {"rank": "expr:i:revenue_rank", "cumulative_pct": "expr:f:round(cumulative_revenue_pct * 100, 2)"},
    "mart_pareto"))(lambda s, d: BQ.pareto_curve(wh(s, d).mart_pareto))

register("bq_top_products", O.canonical_select(
    {"product": "expr:s:product_name", "category": "expr:s:category_name", "revenue": "expr:m:round(revenue, 0)",
     "margin_pct": "expr:f:round(margin_pct * 100, 1)", "class": "expr:s:abc_class"},
    "mart_pareto", extra="ORDER BY mart_pareto.revenue DESC, sk_product LIMIT 20"))(
    lambda s, d: BQ.top_products(wh(s, d).mart_pareto))

register("bq_attainment", O.canonical_select(
    {"seller": "expr:s:salesperson_name", "quarter": "expr:s:year_quarter", "quota": "expr:m:round(quota_amount, 0)",
     "actual": "expr:m:round(actual_revenue, 0)", "attainment_pct": "expr:f:round(attainment_pct * 100, 1)",
     "status": "expr:s:attainment_status"}, "mart_quota", where="quota_amount IS NOT NULL"))(
    lambda s, d: BQ.attainment(wh(s, d).mart_quota))

register("bq_attainment_by_quarter", O.canonical_select(
    {"year_quarter": "s", "mean_attainment_pct": "expr:f:round(avg(attainment_pct) * 100, 1)"},
    "mart_quota", where="quota_amount IS NOT NULL", extra="GROUP BY year_quarter"))(
    lambda s, d: BQ.attainment_by_quarter(wh(s, d).mart_quota))


# ------------------------------------------------------------------ measures
def _ms_base(s, d):
    w = wh(s, d)
    return BQ.base_measures(w.line_months, w.dims["date"])


_MS_FROM = "fct_line f JOIN dim_date dd ON f.sk_order_date = dd.sk_date"
register("ms_base", O.canonical_select(
    {"year": "i", "revenue": "expr:m:sum(f.net_amount)", "margin": "expr:m:sum(f.gross_margin)",
     "cost": "expr:i:sum(f.total_cost)", "quantity": "expr:i:sum(f.order_qty)",
     "orders": "expr:i:count(DISTINCT f.sales_order_id)"}, _MS_FROM, extra="GROUP BY year"))(_ms_base)


def _ms_rate(s, d):
    return BQ.margin_rate_and_basket(_ms_base(s, d))


register("ms_margin_rate", O.canonical_select(
    {"year": "i", "margin_rate": f"expr:f:{O.ratio('sum(f.gross_margin)', 'sum(f.net_amount)')}",
     "mean_basket": f"expr:f:{O.ratio('sum(f.net_amount)', 'count(DISTINCT f.sales_order_id)')}"},
    _MS_FROM, extra="GROUP BY year"))(_ms_rate)

B_MONTHLY = ("(SELECT dd.year, dd.month, sum(f.net_amount) AS revenue FROM fct_line f "
             "JOIN dim_date dd ON f.sk_order_date = dd.sk_date GROUP BY dd.year, dd.month) mth")


def _monthly(s, d):
    w = wh(s, d)
    return BQ.monthly_revenue(w.lines, w.dims["date"])


register("ms_year_to_date", O.canonical_select(
    {"year": "i", "month": "i", "revenue": "m",
     "revenue_ytd": "expr:m:sum(revenue) OVER (PARTITION BY year ORDER BY month "
                    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"}, B_MONTHLY))(
    lambda s, d: BQ.year_to_date(_monthly(s, d)))

register("ms_vs_last_year", O.canonical_select(
    {"year": "expr:i:a.year", "month": "expr:i:a.month", "revenue": "expr:m:a.revenue",
     "revenue_last_year": "expr:m:b.revenue",
     "growth_pct": f"expr:f:{O.ratio('a.revenue - b.revenue', 'b.revenue')}"},
    B_MONTHLY.replace(" mth", " a") + " LEFT JOIN " + B_MONTHLY.replace(" mth", " b")
    + " ON a.year = b.year + 1 AND a.month = b.month"))(lambda s, d: BQ.vs_last_year(_monthly(s, d)))


def _ms_reason(s, d):
    w = wh(s, d)
    return BQ.revenue_by_reason(w.lines, w.bridge, w.dims["sales_reason"])


register("ms_reason_revenue", O.canonical_select(
    {"sk_sales_reason": "expr:i:b.sk_sales_reason", "sales_reason_name": "expr:s:r.sales_reason_name",
     "revenue": f"expr:f:round(sum({O.dbl('o.revenue')} * b.allocation_factor), 2)"},
    "bridge b JOIN (SELECT sales_order_id, sum(net_amount) AS revenue FROM fct_line GROUP BY sales_order_id) o "
    "ON b.sales_order_id = o.sales_order_id LEFT JOIN dim_sales_reason r ON b.sk_sales_reason = r.sk_sales_reason",
    extra="GROUP BY b.sk_sales_reason, r.sales_reason_name"))(_ms_reason)

register("ms_quota", O.canonical_select(
    {"year_quarter": "s", "quota": "expr:m:sum(quota_amount)", "actual": "expr:m:sum(actual_revenue)",
     "attainment_rate": f"expr:f:{O.ratio('sum(actual_revenue)', 'sum(quota_amount)')}"},
    "mart_quota", extra="GROUP BY year_quarter"))(lambda s, d: BQ.quota_measures(wh(s, d).mart_quota))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-in-time margin by month: lines joined to headers, costed as of the order date,
    rolled up by calendar month."""
    w = wh(spark, sf_dir)
    j = w.lines.join(F.broadcast(w.dims["date"].select("sk_date", "year_month")),
                        F.col("sk_order_date") == F.col("sk_date"), "inner")
    return j.groupBy("year_month").agg(
        F.sum("net_amount").alias("revenue"), F.sum("total_cost").alias("cost"),
        F.sum("gross_margin").alias("margin"), F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("is_fallback_cost")).alias("fallback_lines"))


register("pit_margin_by_month", O.canonical_select(
    {"year_month": "s", "revenue": "expr:m:sum(f.net_amount)", "cost": "expr:i:sum(f.total_cost)",
     "margin": "expr:m:sum(f.gross_margin)", "lines": "expr:i:count(*)",
     "fallback_lines": "expr:i:count_if(f.is_fallback_cost)"},
    "fct_line f JOIN dim_date dd ON f.sk_order_date = dd.sk_date", extra="GROUP BY dd.year_month"))(flagship)


# ================================================================== sources and landing
from ledgerstar.sources import bronze as SB  # noqa: E402
from ledgerstar.sources import landing as SL  # noqa: E402
from ledgerstar.sources import registry as SR  # noqa: E402
from ledgerstar.operators.staging import apply_spec  # noqa: E402
from ledgerstar.session import scratch_path  # noqa: E402

CUTOFF = "1999-12-31"
BATCH_ID = "init_20000101_000000"


def header_landing_text(w: Warehouse) -> DataFrame:
    """The order-header role as landing text in the source's positional layout; NULL is
    written as the empty field, and every fifth order carries the text 'NULL' as comment."""
    sp = {c.raw: c.name for c in SR.spec("stg_orderheader")}
    h = w.header.withColumn("order_comment", F.when(F.col("sales_order_id") % 5 == 0, F.lit("NULL")))
    h = h.withColumn("row_guid", F.md5(F.col("sales_order_id").cast("string")))
    h = h.withColumn("credit_card_approval_code", F.lit(None).cast("string"))
    return h.select(*[F.col(sp[raw]).cast("string").alias(raw) for raw in SR.ORDER_HEADER_LANDING])


def _landing_roundtrip(spark: SparkSession, sf_dir: str, encoding: str) -> DataFrame:
    w = wh(spark, sf_dir)
    path = SL.write_landing(header_landing_text(w), scratch_path(spark, f"landing-{encoding}"), encoding)
    raw = SL.read_landing(spark, path, SR.ORDER_HEADER_LANDING, encoding=encoding)
    return apply_spec(raw, SR.spec("stg_orderheader"))


_K_STG_HEADER = {c.name: ("m" if c.kind.startswith("dec") else "i" if c.kind == "i" else
                          "d" if c.kind == "d" else "s") for c in SR.spec("stg_orderheader")}
_STG_HEADER_SQL = O.canonical_select(
    {**{k: v for k, v in _K_STG_HEADER.items()},
     "order_comment": "expr:s:CAST(NULL AS VARCHAR)",
     "row_guid": "expr:s:md5(CAST(sales_order_id AS VARCHAR))",
     "credit_card_approval_code": "expr:s:CAST(NULL AS VARCHAR)"}, "header")
register("src_tsv_utf8", _STG_HEADER_SQL)(lambda s, d: _landing_roundtrip(s, d, "UTF-8"))
register("src_tsv_utf16", _STG_HEADER_SQL)(lambda s, d: _landing_roundtrip(s, d, "UTF-16"))

_LINE_LANDING = SR.landing_columns("stg_orderdetail")


def _bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing lines with planted faults (orders with key mod 1000 = 7 get one field too
    many, = 8 one field too few); the dry-run validation returns exactly those rows."""
    w = wh(spark, sf_dir)
    d = w.detail
    text = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in [
        "sales_order_id", "sales_order_detail_id"]], F.lit(""), *[F.col(c).cast("string") for c in [
        "order_quantity", "product_id", "special_offer_id", "unit_price", "unit_price", "unit_price_discount",
        "modified_date"]], F.md5(F.concat_ws("-", "sales_order_id", "sales_order_detail_id")))
    k = F.col("sales_order_id") % 1000
    line = (F.when(k == 7, F.concat(text, F.lit("\textra")))
             .when(k == 8, F.regexp_replace(text, "\t[^\t]*$", "")).otherwise(text))
    path = scratch_path(spark, "landing-bad")
    d.select(line.alias("value")).write.mode("overwrite").text(path)
    bad = SL.validate_landing(spark, path, _LINE_LANDING)
    return bad.select(F.col("salesorderid").cast("bigint").alias("sales_order_id"),
                      F.col("salesorderdetailid").alias("sales_order_detail_id"),
                      F.size(F.split(F.col(SL.CORRUPT), "\t")).alias("n_fields"))


register("src_bad_rows", O.canonical_select(
    {"sales_order_id": "i", "sales_order_detail_id": "s",
     "n_fields": "expr:i:CASE WHEN sales_order_id % 1000 = 7 THEN 12 ELSE 10 END"},
    "detail", where="sales_order_id % 1000 IN (7, 8)"))(_bad_rows)


def orders_text(t: dict, **more) -> DataFrame:
    """Order headers as landed text; every 500th order date is unparsable."""
    o = t["orders"]
    return o.select(*[c.alias(n) for n, c in more.items()],
                    F.col("o_orderkey").cast("string").alias("salesorderid"),
                    F.col("o_custkey").cast("string").alias("customerid"),
                    F.when(F.col("o_orderkey") % 500 == 0, F.lit("n/a"))
                     .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("orderdate"))


def lines_text(t: dict) -> DataFrame:
    li = t["lineitem"]
    return li.select(F.col("l_orderkey").cast("string").alias("salesorderid"),
                     F.col("l_linenumber").cast("string").alias("linenumber"),
                     F.col("l_partkey").cast("string").alias("productid"))


_ORDERS_TEXT = ("(SELECT CAST(o_orderkey AS VARCHAR) AS salesorderid, CAST(o_custkey AS VARCHAR) AS customerid, "
                "CASE WHEN o_orderkey % 500 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS orderdate "
                "FROM orders)")
_BRONZE_ORDERS = (f"(SELECT * FROM {_ORDERS_TEXT} ot WHERE TRY_CAST(orderdate AS DATE) <= DATE '{CUTOFF}')")


def _bronze_orders(s, d):
    return SB.bronze_extract(orders_text(R_load(s, d)), "orderdate", CUTOFF, BATCH_ID, "SalesOrderHeader.csv")


def R_load(s, d):
    from ledgerstar.plans import roles

    return roles.load(s, d)


register("src_cutoff", O.canonical_select(
    {"salesorderid": "s", "customerid": "s", "orderdate": "s", "_source_file": "expr:s:'SalesOrderHeader.csv'",
     "_batch_id": f"expr:s:'{BATCH_ID}'"}, _BRONZE_ORDERS + " b"))(
    lambda s, d: _bronze_orders(s, d).drop("_loaded_at"))


def _bronze_lines(s, d):
    return SB.with_load_metadata(SB.bronze_children(lines_text(R_load(s, d)), _bronze_orders(s, d), "salesorderid"),
                                 BATCH_ID, "SalesOrderDetail.csv")


register("src_children", O.canonical_select(
    {"salesorderid": "s", "linenumber": "s", "productid": "s", "_source_file": "expr:s:'SalesOrderDetail.csv'",
     "_batch_id": f"expr:s:'{BATCH_ID}'"},
    "(SELECT CAST(l_orderkey AS VARCHAR) AS salesorderid, CAST(l_linenumber AS VARCHAR) AS linenumber, "
    "CAST(l_partkey AS VARCHAR) AS productid FROM lineitem) li",
    where=f"li.salesorderid IN (SELECT salesorderid FROM {_BRONZE_ORDERS} b)"))(
    lambda s, d: _bronze_lines(s, d).drop("_loaded_at"))


def _reconcile(s, d):
    t = R_load(s, d)
    return SB.reconcile_counts({"orders": t["orders"], "lineitem": t["lineitem"],
                                "bronze_orders": _bronze_orders(s, d), "bronze_lines": _bronze_lines(s, d)})


register("src_reconcile", (
    "SELECT 'orders' AS tbl, CAST(count(*) AS BIGINT) AS n FROM orders UNION ALL "
    "SELECT 'lineitem', CAST(count(*) AS BIGINT) FROM lineitem UNION ALL "
    f"SELECT 'bronze_orders', CAST(count(*) AS BIGINT) FROM {_BRONZE_ORDERS} b UNION ALL "
    f"SELECT 'bronze_lines', CAST(count(*) AS BIGINT) FROM lineitem WHERE CAST(l_orderkey AS VARCHAR) IN "
    f"(SELECT salesorderid FROM {_BRONZE_ORDERS} b2)"))(_reconcile)

register("src_cutoff_split", O.canonical_select(
    {"bronze_initial": f"expr:i:count_if(TRY_CAST(orderdate AS DATE) <= DATE '{CUTOFF}')",
     "held_back": f"expr:i:count_if(TRY_CAST(orderdate AS DATE) > DATE '{CUTOFF}')",
     "total_source": "expr:i:count(*)"}, _ORDERS_TEXT + " ot"))(
    lambda s, d: SB.cutoff_split(orders_text(R_load(s, d)), "orderdate", CUTOFF))

register("src_date_range", O.canonical_select(
    {"min_date": "expr:d:min(TRY_CAST(orderdate AS DATE))", "max_date": "expr:d:max(TRY_CAST(orderdate AS DATE))"},
    _BRONZE_ORDERS + " b"))(lambda s, d: SB.date_range(_bronze_orders(s, d), "orderdate"))


def _load_batches(s, d):
    o = _bronze_orders(s, d).select("_batch_id", "_source_file", "_loaded_at")
    li = _bronze_lines(s, d).select("_batch_id", "_source_file", "_loaded_at")
    return SB.load_batches(o.unionByName(li)).drop("first_loaded")


register("src_load_batches",
         f"SELECT '{BATCH_ID}' AS _batch_id, 'SalesOrderHeader.csv' AS _source_file, CAST(count(*) AS BIGINT) AS n_rows "
         f"FROM {_BRONZE_ORDERS} b UNION ALL "
         f"SELECT '{BATCH_ID}', 'SalesOrderDetail.csv', CAST(count(*) AS BIGINT) FROM lineitem "
         f"WHERE CAST(l_orderkey AS VARCHAR) IN (SELECT salesorderid FROM {_BRONZE_ORDERS} b2)")(_load_batches)

FRESH_NOW = "2024-02-15 00:00:00"
register("src_freshness", O.canonical_select(
    {"event_type": "s", "max_loaded": "expr:t:max(ts)",
     "age_days": f"expr:i:date_diff('day', CAST(max(ts) AS DATE), DATE '{FRESH_NOW[:10]}')",
     "status": f"expr:s:CASE WHEN date_diff('day', CAST(max(ts) AS DATE), DATE '{FRESH_NOW[:10]}') > 90 THEN 'error' "
               f"WHEN date_diff('day', CAST(max(ts) AS DATE), DATE '{FRESH_NOW[:10]}') > 30 THEN 'warn' "
               "ELSE 'pass' END"}, "events", extra="GROUP BY event_type"))(
    lambda s, d: SB.freshness(R_load(s, d)["events"], "ts", now=FRESH_NOW, by=["event_type"]))


# ================================================================== data-quality gates
from ledgerstar.functions.columns import net_amount  # noqa: E402
from ledgerstar.operators import quality as Q  # noqa: E402


def _dq_not_null(s, d):
    w = wh(s, d)
    w.header  # noqa: B018  the allocated amounts are read, too
    return Q.not_null(w.lines, list(K_LINE))


register("dq_not_null", with_blocks := O.with_blocks(
    "SELECT column_name, CAST(null_rows AS BIGINT) AS null_rows FROM (UNPIVOT (SELECT "
    + ", ".join(f"count_if({c} IS NULL) AS {c}" for c in K_LINE)
    + " FROM fct_line) ON COLUMNS(*) INTO NAME column_name VALUE null_rows) WHERE null_rows > 0"))(_dq_not_null)

register("dq_unique", O.canonical_select(
    {"l_orderkey": "i", "l_linenumber": "i", "n_rows": "expr:i:count(*)"}, "lineitem",
    extra="GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"))(
    lambda s, d: Q.unique(R_load(s, d)["lineitem"], ["l_orderkey", "l_linenumber"]))


def _dq_rel(s, d):
    w = wh(s, d)
    return Q.relationships(w.header, "sales_person_id", w.dims["salesperson"], "salesperson_id")


register("dq_relationships", O.canonical_select(
    {"sales_person_id": "i", "n_rows": "expr:i:count(*)"}, "header h",
    where="sales_person_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_salesperson s "
          "WHERE s.salesperson_id = h.sales_person_id)", extra="GROUP BY sales_person_id"))(_dq_rel)

register("dq_accepted_values", O.canonical_select(
    {"o_orderstatus": "s", "n_rows": "expr:i:count(*)"}, "orders",
    where="o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')", extra="GROUP BY o_orderstatus"))(
    lambda s, d: Q.accepted_values(R_load(s, d)["orders"], "o_orderstatus", ["F", "O"]))


def _dq_alloc(s, d):
    w = wh(s, d)
    header = w.header  # before the lines, whose allocated amounts are read
    return Q.allocation_gap(w.lines, header, "sales_order_id", "allocated_freight", "freight_amount",
                            "net_amount")


register("dq_allocation_gap", O.canonical_select(
    {"sales_order_id": "expr:i:h.sales_order_id", "freight_amount": "expr:m:h.freight_amount",
     "allocated_total": "expr:f:a.allocated_total",
     "variance": f"expr:f:round({O.dbl('h.freight_amount')} - a.allocated_total, 2)"},
    "header h JOIN (SELECT sales_order_id, sum(allocated_freight) AS allocated_total, sum(net_amount) AS order_net "
    "FROM fct_line GROUP BY sales_order_id) a ON h.sales_order_id = a.sales_order_id",
    where=f"a.order_net > 0 AND abs({O.dbl('h.freight_amount')} - a.allocated_total) > 0.01"))(_dq_alloc)


def _dq_net(s, d):
    w = wh(s, d)
    return Q.net_gap(w.lines, w.header, "sales_order_id", "net_amount", "sub_total")


_NET_GAP = ("header h JOIN (SELECT sales_order_id, sum({net}) AS lines_net FROM {src} GROUP BY sales_order_id) l "
            "ON h.sales_order_id = l.sales_order_id")
_NET_GAP_COLS = {"sales_order_id": "expr:i:h.sales_order_id", "sub_total": "expr:m:h.sub_total",
                 "lines_net": "expr:m:l.lines_net", "variance": "expr:m:round(h.sub_total - l.lines_net, 2)"}
register("dq_net_gap", O.canonical_select(
    _NET_GAP_COLS, _NET_GAP.format(net="net_amount", src="fct_line"),
    where="abs(h.sub_total - l.lines_net) > 0.01"))(_dq_net)


def _dq_net_mutation(s, d):
    """Mutation check: a line net computed with the discount sign flipped must be caught."""
    w = wh(s, d)
    broken = w.detail.withColumn(
        "net_amount", net_amount("order_quantity", "unit_price", F.lit(0).cast("decimal(5,4)"))
        + net_amount("order_quantity", "unit_price", F.lit(0).cast("decimal(5,4)"))
        - net_amount("order_quantity", "unit_price", "unit_price_discount"))
    return Q.net_gap(broken, w.header, "sales_order_id", "net_amount", "sub_total")


_BROKEN = ("(CAST(order_quantity AS DECIMAL(10,0)) * unit_price * (1 + unit_price_discount))")
register("dq_net_gap_mutation", O.canonical_select(
    _NET_GAP_COLS, _NET_GAP.format(net=_BROKEN, src="detail"), where="abs(h.sub_total - l.lines_net) > 0.01"))(
    _dq_net_mutation)


def _dq_pit(s, d):
    w = wh(s, d)
    return Q.pit_has_effect(w.lines, w.dims["product"])


register("dq_pit_effect", O.canonical_select(
    {"differing_rows": "i"},
    "(SELECT count_if(abs(f.unit_standard_cost - p.standard_cost) > 0.001) AS differing_rows FROM fct_line f "
    "JOIN dim_product p ON f.sk_product = p.sk_product WHERE NOT f.is_fallback_cost) x",
    where="differing_rows = 0"))(_dq_pit)


def _dq_count(s, d):
    w = wh(s, d)
    return Q.same_count(w.lines, w.detail)


register("dq_same_count", O.canonical_select(
    {"fact_rows": "i", "source_rows": "i"},
    "(SELECT (SELECT count(*) FROM fct_line) AS fact_rows, (SELECT count(*) FROM detail) AS source_rows) x",
    where="fact_rows <> source_rows"))(_dq_count)


def _dq_total(s, d):
    w = wh(s, d)
    return Q.same_total(w.lines, F.col("net_amount"), w.detail,
                        net_amount("order_quantity", "unit_price", "unit_price_discount"))


register("dq_same_total", O.canonical_select(
    {"fact_revenue": "m", "source_revenue": "m", "variance": "expr:m:round(fact_revenue - source_revenue, 2)"},
    f"(SELECT (SELECT sum(net_amount) FROM fct_line) AS fact_revenue, (SELECT sum({O.NET}) FROM detail) "
    "AS source_revenue) x", where="abs(fact_revenue - source_revenue) > 0.01"))(_dq_total)


def _dq_overlap(s, d):
    w = wh(s, d)
    return Q.union_labelled({
        "dim_product": Q.no_overlap(w.dims["product"], "product_id", "sk_product")
                        .toDF("nk", "version_id", "covered_until"),
        "dim_customer": Q.no_overlap(w.dims["customer"], "customer_id", "sk_customer")
                         .toDF("nk", "version_id", "covered_until")})


def _overlap_sql(label: str, src: str, key: str, sk: str) -> str:
    """Self join of all pairs of a key: a version with some earlier one (by start, then id) that ends after its start."""
    return (f"SELECT '{label}' AS label, b.{key} AS nk, b.{sk} AS version_id, max(a.valid_to) AS covered_until "
            f"FROM {src} a JOIN {src} b ON a.{key} = b.{key} AND a.{sk} <> b.{sk} "
            f"AND (a.valid_from < b.valid_from OR (a.valid_from = b.valid_from AND a.{sk} < b.{sk})) "
            f"AND b.valid_from < a.valid_to WHERE b.{key} <> -1 GROUP BY b.{key}, b.{sk}")


_OVERLAP_COLS = {"label": "s", "nk": "i", "version_id": "s", "covered_until": "t"}
register("dq_no_overlap", O.canonical_select(
    _OVERLAP_COLS, "(" + _overlap_sql("dim_product", "dim_product", "product_id", "sk_product") + " UNION ALL "
    + _overlap_sql("dim_customer", "dim_customer", "customer_id", "sk_customer") + ") u"))(_dq_overlap)


def _planted_intervals(s, d):
    """Cost intervals plus, for products with key mod 100 = 1, one interval over all of time from
    1995 on and a short one inside 1998: the real later intervals and the short one are nested in the long one."""
    iv = wh(s, d).cost_intervals
    first = iv.where((F.col("product_id") % 100 == 1) & (F.col("valid_from") == F.lit("1995-01-01").cast("date")))
    long = first.withColumn("valid_from", F.lit("1994-06-01").cast("date")).withColumn("valid_to", F.lit("9999-12-31").cast("date"))
    short = first.withColumn("valid_from", F.lit("1998-03-01").cast("date")).withColumn("valid_to", F.lit("1998-04-01").cast("date"))
    return iv.unionByName(long).unionByName(short).withColumn(
        "version_id", F.concat_ws("/", F.date_format("valid_from", "yyyy-MM-dd"), F.date_format("valid_to", "yyyy-MM-dd")))


def _dq_overlap_planted(s, d):
    return Q.no_overlap(_planted_intervals(s, d), "product_id", "version_id").select(
        F.col("product_id").alias("nk"), "version_id", "covered_until")


_PLANTED_IV = ("(SELECT product_id, valid_from, valid_to, strftime(valid_from, '%Y-%m-%d') || '/' || strftime(valid_to, '%Y-%m-%d') AS v FROM ("
               "SELECT product_id, valid_from, valid_to FROM cost_iv UNION ALL "
               "SELECT product_id, DATE '1994-06-01', DATE '9999-12-31' FROM cost_iv WHERE product_id % 100 = 1 AND valid_from = DATE '1995-01-01' UNION ALL "
               "SELECT product_id, DATE '1998-03-01', DATE '1998-04-01' FROM cost_iv WHERE product_id % 100 = 1 AND valid_from = DATE '1995-01-01') p)")
register("dq_no_overlap_planted", O.canonical_select(
    {"nk": "i", "version_id": "s", "covered_until": "d"},
    "(" + _overlap_sql("x", _PLANTED_IV, "product_id", "v") + ") u"))(_dq_overlap_planted)


def _overlap_pairs(s, d):
    """Every pair of overlapping versions of the planted intervals, by a sweep over their starts."""
    from ledgerstar.operators.sweep import overlaps

    return overlaps(_planted_intervals(s, d), "product_id", "version_id")


register("rel_interval_overlaps", O.canonical_select(
    {"product_id": "expr:i:a.product_id", "version_a": "expr:s:a.v", "version_b": "expr:s:b.v"},
    f"{_PLANTED_IV} a JOIN {_PLANTED_IV} b ON a.product_id = b.product_id AND a.v <> b.v "
    "AND a.valid_from < b.valid_to AND b.valid_from < a.valid_to"))(_overlap_pairs)


def _asof_merge(s, d):
    """The cost of every order line on its order date, by a merge of lines and cost versions."""
    from ledgerstar.operators.sweep import asof_merge

    w = wh(s, d)
    dates = w.header.select("sales_order_id", F.to_date("order_date").alias("order_date"))
    lines = w.detail.select("sales_order_id", "sales_order_detail_id", "product_id").join(dates, "sales_order_id")
    return asof_merge(lines, w.cost_intervals, "product_id", "order_date", select=["standard_cost", "is_fallback_cost"])


register("rel_asof_merge", O.canonical_select(
    {"sales_order_id": "expr:i:l.sales_order_id", "sales_order_detail_id": "expr:s:l.sales_order_detail_id",
     "product_id": "expr:i:l.product_id", "order_date": "expr:d:CAST(h.order_date AS DATE)", "standard_cost": "expr:i:c.standard_cost",
     "is_fallback_cost": "expr:b:c.is_fallback_cost"},
    "detail l JOIN header h ON l.sales_order_id = h.sales_order_id LEFT JOIN cost_iv c ON c.product_id = l.product_id "
    "AND CAST(h.order_date AS DATE) >= c.valid_from AND CAST(h.order_date AS DATE) < c.valid_to"))(_asof_merge)


def _dq_one_current(s, d):
    w = wh(s, d)
    return Q.union_labelled({
        "dim_product": Q.one_current(w.dims["product"], "product_id").withColumnRenamed("product_id", "nk"),
        "dim_customer": Q.one_current(w.dims["customer"], "customer_id").withColumnRenamed("customer_id", "nk")})


register("dq_one_current", O.with_blocks(
    "SELECT label, CAST(nk AS BIGINT) AS nk, CAST(n_current AS BIGINT) AS n_current FROM ("
    "SELECT 'dim_product' AS label, product_id AS nk, count_if(is_current) AS n_current FROM dim_product "
    "WHERE product_id <> -1 GROUP BY product_id UNION ALL "
    "SELECT 'dim_customer', customer_id, count_if(is_current) FROM dim_customer WHERE customer_id <> -1 "
    "GROUP BY customer_id) x WHERE n_current <> 1"))(_dq_one_current)

register("dq_grain", O.canonical_select(
    {"sk_sales_order_line": "s", "n_rows": "expr:i:count(*)"}, "fct_line",
    extra="GROUP BY sk_sales_order_line HAVING count(*) > 1"))(
    lambda s, d: Q.grain(wh(s, d).lines, ["sk_sales_order_line"]))


# ================================================================== scalable windows
from ledgerstar.operators.windows import global_rank, keyed_lag  # noqa: E402


def _win_rank(s, d):
    o = R_load(s, d)["orders"].select("o_orderkey", F.col("o_totalprice").cast("decimal(19,2)").alias("price"))
    return global_rank(o, [("price", "desc"), "o_orderkey"], value="price", ntiles={"decile": 10},
                       rank_col="price_rank", running_col="running_price", total_col="total_price")


_WIN_SQL = O.canonical_select(
    {"o_orderkey": "i", "price": "m", "price_rank": "i", "running_price": "m", "total_price": "m", "decile": "i"},
    "(SELECT o_orderkey, price, row_number() OVER w AS price_rank, "
    "sum(price) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_price, "
    "sum(price) OVER () AS total_price, ntile(10) OVER w AS decile "
    "FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(19,2)) AS price FROM orders) "
    "WINDOW w AS (ORDER BY price DESC, o_orderkey)) x")
register("win_two_phase_rank", _WIN_SQL)(_win_rank)


def _win_lag(s, d):
    """The previous order of the same customer; every ninth order has no customer, which is a key like any other."""
    o = R_load(s, d)["orders"].select(F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderkey", "o_orderdate")
    return keyed_lag(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderdate", "o_orderkey"])


_LAG_SQL = O.canonical_select(
    {"o_custkey": "i", "o_orderkey": "i", "o_orderdate": "t", "prev_o_orderdate": "t", "prev_o_orderkey": "i"},
    "(SELECT o_custkey, o_orderkey, o_orderdate, lag(o_orderdate) OVER w AS prev_o_orderdate, "
    "lag(o_orderkey) OVER w AS prev_o_orderkey "
    "FROM (SELECT CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey END AS o_custkey, o_orderkey, o_orderdate FROM orders) "
    "WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) x")
register("win_two_phase_lag", _LAG_SQL)(_win_lag)


# ================================================================== incremental load
from ledgerstar.operators import history as HIST  # noqa: E402
from ledgerstar.operators import incremental as INC  # noqa: E402
from ledgerstar.plans import facts as FCT  # noqa: E402

INC_BOUNDARY = "2000-01-01"      # first load: lines modified before this day
INC_LOOKBACK = 3
LINE_RANGES = ["sales_order_id"]  # part of the line key: a stored key can only be where its order can be


def _month(df):
    return df.withColumn("order_month", (F.col("sk_order_date") / 100).cast("int"))


def _first_load(w, columns: list[str] | None = None):
    """The stored line fact of the first load, a table partitioned by order month. ``columns``: for a query that
    reads no others; a whole one that is stored serves it, too."""
    for name in ("line_first_load", "line_first_load_part") if columns else ("line_first_load",):
        if name in w.__dict__:
            return w.__dict__[name]
    base = scratch_path(w.spark, "fct_line_inc")
    fact = _month(w.line_fact(w.detail.where(F.col("modified_date") < F.lit(INC_BOUNDARY).cast("date"))))
    INC.write_table(fact.select(*columns, "order_month") if columns else fact, base, "order_month", ranges=LINE_RANGES)
    w.written.append(base)
    w.__dict__["line_first_load_part" if columns else "line_first_load"] = base
    return base


_SLICE_COLUMNS = [*LINE_RANGES, "source_modified_date"]


def _line_slice(w, full_refresh: bool = False, columns: list[str] | None = None):
    """Lines to load next; the watermark comes from the stored fact."""
    stored = INC.read_current(w.spark, _first_load(w, columns), 1)
    return INC.incremental_slice(w.detail, stored, "modified_date", "source_modified_date", days=INC_LOOKBACK, full_refresh=full_refresh)


def _line_delta(w, full_refresh: bool = False):
    return _month(w.line_fact(_line_slice(w, full_refresh)))


_SLICE_BOUND = (f"(SELECT max(modified_date) - {INC_LOOKBACK} FROM detail "
                f"WHERE modified_date < DATE '{INC_BOUNDARY}')")
register("inc_slice", O.canonical_select(
    {"sales_order_id": "i", "sales_order_detail_id": "s", "modified_date": "d"}, "detail",
    where=f"modified_date >= {_SLICE_BOUND}"))(
    lambda s, d: _line_slice(wh(s, d), columns=_SLICE_COLUMNS).select("sales_order_id", "sales_order_detail_id", "modified_date"))


def _inc_merge(s, d):
    """Stored first load and increment, merged as rows."""
    w = wh(s, d)
    delta = w.keep("fct_line_delta", _line_delta(w))  # written: the key check and the merge both read it
    return INC.merge_upsert(INC.read_current(s, _first_load(w), 1), delta, ["sk_sales_order_line"]).drop("order_month")


register("inc_merge", O.canonical_select(K_LINE, "fct_line"))(_inc_merge)


def _own_table(s, w, name):
    """The first load as a table of its own: its version lists the first load's folders, which never change."""
    base = scratch_path(s, name)
    w.written.append(base)
    INC.clone_table(s, _first_load(w), 1, base)
    return base


def _inc_partitions(s, d):
    """The physical merge: the increment writes only the months it touches, as a new version."""
    w = wh(s, d)
    base = _own_table(s, w, "fct_line_merge")
    INC.merge_table(s, base, w.keep("fct_line_delta", _line_delta(w)), "sk_sales_order_line", "order_month", ranges=LINE_RANGES)
    return INC.read_current(s, base).drop("order_month")


register("inc_merge_partitions", O.canonical_select(K_LINE, "fct_line"))(_inc_partitions)


def _inc_replay(s, d):
    """The increment merged twice into the stored table: rows per version, and rows that the second
    merge changed (both directions), which must be 0."""
    w = wh(s, d)
    base = _own_table(s, w, "fct_line_replay")
    delta = w.keep("fct_line_delta", _line_delta(w))
    once = INC.merge_table(s, base, delta, "sk_sales_order_line", "order_month", ranges=LINE_RANGES)
    twice = INC.merge_table(s, base, delta, "sk_sales_order_line", "order_month", ranges=LINE_RANGES)
    a, b = INC.read_current(s, base, once), INC.read_current(s, base, twice)
    n = b.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("net_amount").alias("revenue")).withColumn("k", F.lit(1))
    c = INC.changed_rows(a, b).agg(F.count(F.lit(1)).alias("changed")).withColumn("k", F.lit(1))
    return n.join(c, "k").drop("k")


register("inc_replay", O.canonical_select(
    {"n_rows": "expr:i:count(*)", "revenue": "expr:m:sum(net_amount)", "changed": "expr:i:0"}, "fct_line"))(_inc_replay)


def _inc_moved_keys(s, d):
    """A correction that moves orders to another month, one month without a date, and new rows: each key
    stands once, in its new place, and rows that nothing touches stay."""
    ev = R_load(s, d)["orders"].select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"))
    month = F.when(F.col("o_orderkey") % 13 != 0, F.date_format("day", "yyyy-MM"))
    src = ev.withColumn("month", month)
    base = scratch_path(s, "orders_moved")
    wh(s, d).written.append(base)
    INC.write_table(src.where(F.col("o_orderkey") % 10 != 1), base, "month")
    moved = src.where(F.col("o_orderkey") % 100 == 3).withColumn("day", F.add_months("day", 1)).withColumn("month", month)
    new = src.where(F.col("o_orderkey") % 10 == 1)
    INC.merge_table(s, base, moved.unionByName(new), "o_orderkey", "month")
    return INC.read_current(s, base)


_MOVED_DAY = ("CASE WHEN o_orderkey % 100 = 3 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) "
              "ELSE CAST(o_orderdate AS DATE) END")
register("inc_merge_moved_keys", O.canonical_select(
    {"o_orderkey": "i", "o_totalprice": "f", "day": f"expr:d:{_MOVED_DAY}",
     "month": f"expr:s:CASE WHEN o_orderkey % 13 <> 0 THEN strftime({_MOVED_DAY}, '%Y-%m') END"}, "orders"))(_inc_moved_keys)


def _inc_interleaved(s, d):
    """Two merges that begin from the same version, each with changes to half of the same orders' months: the one that
    publishes second finds the first one's version and merges again. A refresh that fails on the way changes nothing."""
    o = R_load(s, d)["orders"].select("o_orderkey", "o_totalprice", F.lit(0).alias("source"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    base = scratch_path(s, "orders_two_writers")
    wh(s, d).written.append(base)
    INC.write_table(o.where("o_orderkey % 5 <> 0"), base, "month", ranges=["o_orderkey"])
    one, two = (o.where(f"o_orderkey % 4 = {k} or o_orderkey % 5 = 0 and o_orderkey % 2 = {k - 1}").withColumn("source", F.lit(k)) for k in (1, 2))

    def other(attempt: int) -> None:
        if attempt == 1:
            INC.merge_table(s, base, two, "o_orderkey", "month", ranges=["o_orderkey"])

    INC.merge_table(s, base, one, "o_orderkey", "month", ranges=["o_orderkey"], on_written=other)
    try:
        broken = F.when(F.col("o_orderkey") % 7 == 0, F.raise_error(F.lit("refresh fails")).cast("int"))
        INC.write_table(o.withColumn("extra", broken), base, "month")
        raise AssertionError("the refresh was to fail")
    except PySparkException:
        pass
    return INC.read_current(s, base)


register("inc_interleaved_merges", O.canonical_select(
    {"o_orderkey": "i", "o_totalprice": "f", "month": "expr:s:strftime(o_orderdate, '%Y-%m')",
     "source": "expr:i:CASE WHEN o_orderkey % 4 = 1 OR o_orderkey % 5 = 0 AND o_orderkey % 2 = 0 THEN 1 "
               "WHEN o_orderkey % 4 = 2 OR o_orderkey % 5 = 0 AND o_orderkey % 2 = 1 THEN 2 ELSE 0 END"}, "orders"))(_inc_interleaved)


def _order_first(w):
    return w.header_rolled.where(F.col("modified_date") < F.lit(INC_BOUNDARY).cast("date"))


def _inc_order(s, d, full_refresh: bool = False):
    """The order fact: first load, slice by its own watermark, merge by order."""
    w = wh(s, d)
    base = scratch_path(s, "fct_order_inc")
    w.written.append(base)
    fact = lambda headers: _month(FCT.fct_sales_order(headers, w.detail))
    INC.write_table(_month(_order_first(w)), base, "order_month", finish=fact)
    sl = INC.incremental_slice(w.header_rolled, INC.read_current(s, base), "modified_date", "source_modified_date",
                               days=INC_LOOKBACK, full_refresh=full_refresh)
    if full_refresh:
        INC.write_table(_month(sl), base, "order_month", finish=fact)
    else:
        INC.merge_table(s, base, fact(sl), "sk_sales_order", "order_month")
    return INC.read_current(s, base).drop("order_month")


register("inc_order_merge", O.canonical_select(K_ORDER, "fct_order"))(_inc_order)
register("inc_order_full_refresh", O.canonical_select(K_ORDER, "fct_order"))(lambda s, d: _inc_order(s, d, full_refresh=True))


def _overlapping_files(back):
    """order_month, n_files_overlapping: files of the month whose dates begin before an earlier file's end.

    The dates of a file are one grouped aggregate over the date column; a month's files, a few, are compared in order.
    """
    files = back.groupBy("order_month", F.col("_metadata.file_path").alias("f")).agg(F.min(LINE_CLUSTER).alias("lo"), F.max(LINE_CLUSTER).alias("hi"))
    before = W.partitionBy("order_month").orderBy("lo", "hi", "f").rowsBetween(W.unboundedPreceding, -1)
    return (files.withColumn("until", F.max("hi").over(before)).groupBy(F.col("order_month").alias("m"))
            .agg(F.count_if(F.col("lo") < F.col("until")).alias("overlapping")))


def _clustered_write(s, d, shuffled: bool = False):
    """The line fact written clustered and partitioned, with its audit column, and read back: rows per month, rows without a
    load time, and files whose dates overlap an earlier file's of the month. ``shuffled``: the planted fault, dealt at random."""
    w = wh(s, d)
    path = scratch_path(s, "fct_line_clustered")
    w.written.append(path)
    fact = clustered(w.fct_line.withColumn("dwh_loaded_at", F.current_timestamp()))
    with shuffles_dropped(s):
        (fact.repartition(4) if shuffled else fact).write.option("compression", "zstd").partitionBy("order_month").parquet(path)
    back = s.read.parquet(path)
    rows = back.groupBy("order_month").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("net_amount").alias("revenue"),
                                           F.count_if(F.col("dwh_loaded_at").isNull()).alias("unloaded"))
    return rows.join(_overlapping_files(back), F.col("order_month") == F.col("m")).drop("m")


register("snk_clustered_fact", O.canonical_select(
    {"order_month": "expr:i:CAST(floor(sk_order_date / 100) AS INTEGER)", "n_rows": "expr:i:count(*)",
     "revenue": "expr:m:sum(net_amount)", "unloaded": "expr:i:0", "overlapping": "expr:i:0"}, "fct_line",
    extra="GROUP BY CAST(floor(sk_order_date / 100) AS INTEGER)"))(_clustered_write)
register("snk_clustered_planted", O.canonical_select(
    {"order_month": "expr:i:CAST(floor(sk_order_date / 100) AS INTEGER)", "found": "expr:b:true"}, "fct_line",
    extra="GROUP BY CAST(floor(sk_order_date / 100) AS INTEGER) HAVING count(DISTINCT sk_order_date) > 20"))(
    lambda s, d: _clustered_write(s, d, shuffled=True).join(wh(s, d).fct_line.groupBy((F.col("sk_order_date") / 100).cast("int").alias("m"))
        .agg(F.countDistinct("sk_order_date").alias("days")).filter("days > 20"), F.col("order_month") == F.col("m"))
    .select("order_month", (F.col("overlapping") > 0).alias("found")))


# ================================================================== streaming micro-batches
from ledgerstar.operators.incremental import read_current  # noqa: E402
from ledgerstar.streaming.chain import Chain  # noqa: E402
from ledgerstar.streaming.merge_stream import stream_merge  # noqa: E402

STREAM_SPLIT = "2024-01-20"      # first landing file: events before this time
STREAM_REPLAY_FROM = "2024-01-17"  # second file re-delivers from here, with corrections


def _stream(s, d, files: int = 1, per_trigger: int = 1000):
    """Two landings of events go through the micro-batch merge: the second re-delivers
    three days of the first (late data) with corrected values on every 50th event. With
    several files and a small trigger, one landing is many micro-batches in mixed time order."""
    ev = R_load(s, d)["events"].select("event_id", "ts", "user_id", "event_type", "value")
    landing, table, ckpt = (scratch_path(s, "events-landing"), scratch_path(s, "events-table"),
                            scratch_path(s, "events-stream"))
    wh(s, d).written += [landing, table, ckpt]
    ev.where(F.col("ts") < F.lit(STREAM_SPLIT).cast("timestamp_ntz")).repartition(files).write.parquet(f"{landing}/f1")
    stream_merge(s, landing, ev.schema, table, ckpt, ["event_id"], "ts", files_per_trigger=per_trigger)
    late = ev.where(F.col("ts") >= F.lit(STREAM_REPLAY_FROM).cast("timestamp_ntz")).withColumn(
        "value", F.when(F.col("event_id") % 50 == 0, F.col("value") + 1).otherwise(F.col("value")))
    late.repartition(files).write.parquet(f"{landing}/f2")
    stream_merge(s, landing, ev.schema, table, ckpt, ["event_id"], "ts", files_per_trigger=per_trigger)
    return read_current(s, table).select("event_id", "ts", "user_id", "event_type", "value")


_STREAM_SQL = O.canonical_select(
    {"event_id": "i", "ts": "t", "user_id": "i", "event_type": "s",
     "value": f"expr:f:CASE WHEN ts >= TIMESTAMP '{STREAM_REPLAY_FROM}' AND event_id % 50 = 0 THEN value + 1 "
              "ELSE value END"}, "events")
register("inc_stream", _STREAM_SQL)(_stream)
register("inc_stream_many_batches", _STREAM_SQL)(lambda s, d: _stream(s, d, files=6, per_trigger=2))


# ================================================================== pricing snapshot, bronze delta
register("scd_snapshot_pricing", O.canonical_select(
    {"product_id": "i", "standard_cost": "i", "list_price": "i", "modified_date": "d", "version_from": "t",
     "version_to": "t"},
    "(SELECT product_id, standard_cost, list_price, modified_date, CAST(modified_date AS TIMESTAMP) AS version_from, "
    "CASE WHEN run = 1 AND product_id % 7 = 0 THEN TIMESTAMP '1997-01-01' END AS version_to FROM prod_runs "
    "WHERE run = 1 OR (run = 2 AND product_id % 7 = 0)) x"))(lambda s, d: wh(s, d).snap_pricing)


def _scd_null_key(s, d):
    """A history over three runs in which one customer has no key, one value becomes NULL, and the set is compacted in between."""
    c = R_load(s, d)["customer"].select(F.when(F.col("c_custkey") != 7, F.col("c_custkey")).alias("k"), F.col("c_acctbal").cast("decimal(19,2)").alias("balance"), "c_mktsegment")
    base = scratch_path(s, "customer_history")
    wh(s, d).written.append(base)
    key = F.coalesce("k", F.lit(7))
    for run, state in (("2020-01-01", c.where(key % 11 != 3)), ("2020-02-01", c.withColumn("balance", F.when(key % 7 == 0, F.col("balance") + 1).otherwise(F.col("balance")))),
                       ("2020-03-01", c.withColumn("balance", F.when(key % 14 != 0, F.when(key % 7 == 0, F.col("balance") + 1).otherwise(F.col("balance")))))):
        HIST.snapshot(s, base, state, "k", ["balance"], run)
        if run == "2020-02-01":
            HIST.compact(s, base, "k")
    return HIST.read_history(s, base, "k")


_NULL_KEY_RUNS = ("(SELECT c_custkey AS id, CAST(c_acctbal AS DECIMAL(19,2)) AS b, c_mktsegment, r, CASE WHEN r = 1 THEN CAST(c_acctbal AS DECIMAL(19,2)) "
                  "WHEN r = 3 AND c_custkey % 14 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN CAST(c_acctbal AS DECIMAL(19,2)) + 1 ELSE CAST(c_acctbal AS DECIMAL(19,2)) END AS balance "
                  "FROM customer, range(1, 4) AS x(r) WHERE r > 1 OR c_custkey % 11 <> 3)")
register("scd_null_key", O.canonical_select(
    {"k": "expr:i:nullif(id, 7)", "balance": "m", "c_mktsegment": "s", "version_from": "t", "version_to": "t"},
    "(SELECT id, balance, c_mktsegment, make_timestamp(2020, r, 1, 0, 0, 0) AS version_from, "
    "CASE WHEN nxt IS NOT NULL THEN make_timestamp(2020, nxt, 1, 0, 0, 0) END AS version_to FROM ("
    "SELECT *, lead(r) OVER (PARTITION BY id ORDER BY r) AS nxt FROM ("
    "SELECT *, row_number() OVER w AS i, lag(balance) OVER w AS was "
    f"FROM {_NULL_KEY_RUNS} a WINDOW w AS (PARTITION BY id ORDER BY r)) b WHERE i = 1 OR balance IS DISTINCT FROM was) c) y"))(_scd_null_key)

DELTA_CUTOFF = "2001-12-31"


def orders_text_modified(t: dict) -> DataFrame:
    """The order text with its modification date, which the order date and key give."""
    day = F.date_format(F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 7).cast("int")), "yyyy-MM-dd")
    return orders_text(t, modifieddate=day)


def _bronze_delta(s, d):
    t = R_load(s, d)
    src = orders_text_modified(t)
    tgt = src.where(SB.before("orderdate", CUTOFF))
    return SB.bronze_delta(src, tgt, "salesorderid", "modifieddate", "orderdate", DELTA_CUTOFF)


_OTM = ("(SELECT CAST(o_orderkey AS VARCHAR) AS salesorderid, CAST(o_custkey AS VARCHAR) AS customerid, "
        "CASE WHEN o_orderkey % 500 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS orderdate, "
        "strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 7 AS INTEGER), '%Y-%m-%d') AS modifieddate "
        "FROM orders)")
register("src_bronze_delta", O.canonical_select(
    {"salesorderid": "s", "customerid": "s", "orderdate": "s", "modifieddate": "s"},
    f"(SELECT * FROM {_OTM} a WHERE TRY_CAST(orderdate AS DATE) <= DATE '{CUTOFF}' UNION ALL "
    f"SELECT * FROM {_OTM} b WHERE TRY_CAST(modifieddate AS TIMESTAMP) > (SELECT max(TRY_CAST(modifieddate AS "
    f"TIMESTAMP)) FROM {_OTM} c WHERE TRY_CAST(orderdate AS DATE) <= DATE '{CUTOFF}') "
    f"AND TRY_CAST(orderdate AS DATE) <= DATE '{DELTA_CUTOFF}' "
    f"AND NOT (TRY_CAST(orderdate AS DATE) <= DATE '{CUTOFF}')) u"))(_bronze_delta)


def _held_back_chain(s, d):
    """Order text in two landings of several files through the chain, with a later cutoff each time; both runs are
    interrupted after a published step, so that a micro-batch is executed twice. The fact holds the orders due by the last cutoff."""
    w = wh(s, d)
    w.header_rolled  # noqa: B018  before the micro-batches read it
    text = orders_text_modified(R_load(s, d)).withColumn("modifieddate", F.col("modifieddate").cast("timestamp_ntz"))
    base = scratch_path(s, "held_back_chain")
    w.written.append(base)
    landing, interrupts = f"{base}/landing", {(0, "bronze"), (2, "fact")}

    def on_step(batch: int, step: str) -> None:
        if (batch, step) in interrupts:
            interrupts.remove((batch, step))
            raise RuntimeError("interrupted")

    def build(due: DataFrame) -> DataFrame:
        own = due.select(F.col("salesorderid").cast("bigint").alias("sales_order_id"))
        return _month(FCT.fct_sales_order(w.header_rolled.join(own, "sales_order_id", "left_semi"), w.detail))

    chain = Chain(s, landing, text.schema, base, ["salesorderid"], "modifieddate", "orderdate", build, ["sk_sales_order"], "order_month", on_step)
    for k, cutoff in enumerate((CUTOFF, DELTA_CUTOFF)):
        text.where(F.col("salesorderid").cast("bigint") % 3 == 0 if k else F.lit(True)).repartition(4).write.parquet(f"{landing}/f{k}")
        while True:  # start again until a run ends by itself
            try:
                chain.run(cutoff, files_per_trigger=2)
                break
            except StreamingQueryException:
                continue
    assert not interrupts
    return read_current(s, chain.fact).drop("order_month")


register("inc_held_back_chain", O.canonical_select(K_ORDER, "fct_order", where=(
    f"sales_order_id IN (SELECT CAST(salesorderid AS BIGINT) FROM {_OTM} o WHERE TRY_CAST(orderdate AS DATE) <= DATE '{DELTA_CUTOFF}')")))(_held_back_chain)


def _bronze_full(s, d):
    """Full reload of a reference table, run twice into the same table path: the second
    run replaces the first (deterministic plan + overwrite), so the table is identical."""
    part = R_load(s, d)["part"]
    path = scratch_path(s, "bronze-product")
    for _ in range(2):
        SB.bronze_full(part, BATCH_ID, "Product.csv").drop("_loaded_at").write.mode("overwrite").parquet(path)
    return s.read.parquet(path)


register("src_bronze_full", O.canonical_select(
    {"p_partkey": "i", "p_name": "s", "p_brand": "s", "p_type": "s", "p_size": "i", "p_retailprice": "f",
     "_source_file": "expr:s:'Product.csv'", "_batch_id": f"expr:s:'{BATCH_ID}'"}, "part"))(_bronze_full)


# ================================================================== staging specs over landed text
def _territory_text(t: dict) -> DataFrame:
    """Territory source as text: padded names (trimmed by the spec), money with half cents
    (rounded by the int cast), the reserved word GROUP as a column name."""
    r = t["region"]
    k = F.col("r_regionkey")
    return r.select(k.cast("string").alias("territoryid"), F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")).alias("name"),
                    k.cast("string").alias("countryregioncode"),
                    F.when(k < 2, " West").otherwise("East ").alias("GROUP"),
                    F.concat((k * 1000).cast("string"), F.lit(".5")).alias("salesytd"),
                    F.concat((k * 900).cast("string"), F.lit(".49")).alias("saleslastyear"),
                    F.lit("0").alias("costytd"), F.lit(None).cast("string").alias("costlastyear"),
                    F.md5(k.cast("string")).alias("rowguid"), F.lit("1995-01-01").alias("modifieddate"))


register("stg_territory", O.canonical_select(
    {"territory_id": "expr:i:r_regionkey", "territory_name": "expr:s:r_name",
     "country_region_code": "expr:s:CAST(r_regionkey AS VARCHAR)",
     "territory_group": "expr:s:CASE WHEN r_regionkey < 2 THEN 'West' ELSE 'East' END",
     "sales_ytd": "expr:i:CAST(round(CAST(CAST(r_regionkey * 1000 AS VARCHAR) || '.5' AS DECIMAL(19,4))) AS INTEGER)",
     "sales_last_year": "expr:i:CAST(round(CAST(CAST(r_regionkey * 900 AS VARCHAR) || '.49' AS DECIMAL(19,4))) "
                        "AS INTEGER)",
     "cost_ytd": "expr:i:0", "cost_last_year": "expr:i:CAST(NULL AS INTEGER)",
     "row_guid": "expr:s:md5(CAST(r_regionkey AS VARCHAR))", "modified_date": "expr:d:DATE '1995-01-01'"},
    "region"))(lambda s, d: apply_spec(_territory_text(R_load(s, d)), SR.spec("stg_territory")))


def _customer_text(s, d) -> DataFrame:
    """Customer source as landed text (second snapshot state), NULL ids as empty fields."""
    from ledgerstar.plans import roles

    c = roles.customer_state(R_load(s, d), 2)
    path = SL.write_landing(c.select(
        F.col("customer_id").alias("customerid"), F.col("person_id").alias("personid"),
        F.col("store_id").alias("storeid"), F.col("territory_id").alias("territoryid"),
        F.md5(F.col("customer_id").cast("string")).alias("rowguid"),
        F.col("modified_date").alias("modifieddate")), scratch_path(s, "landing-customer"))
    raw = SL.read_landing(s, path, SR.landing_columns("stg_customer"))
    return apply_spec(raw, SR.spec("stg_customer"))


register("stg_customer", O.canonical_select(
    {"customer_id": "i", "person_id": "i", "store_id": "i", "territory_id": "i",
     "row_guid": "expr:s:md5(CAST(customer_id AS VARCHAR))", "modified_date": "d"},
    "cust_runs", where="run = 2"))(_customer_text)


# ================================================================== planted faults: one per gate
def _changed(df: DataFrame, when: str, **values) -> DataFrame:
    """``df`` with columns replaced by SQL expressions in the rows that ``when`` names."""
    return df.withColumns({c: F.when(F.expr(when), F.expr(e).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, e in values.items()})


def _planted_not_null(s, d):
    line = _changed(wh(s, d).lines, "sales_order_id % 500 = 3", net_amount="NULL")
    return Q.not_null(_changed(line, "sales_order_id % 700 = 5", sk_product="NULL"), ["sk_product", "net_amount", "sk_customer"])


register("dq_not_null_planted", O.with_blocks(
    "SELECT 'net_amount' AS column_name, CAST(count(*) AS BIGINT) AS null_rows FROM fct_line WHERE sales_order_id % 500 = 3 HAVING count(*) > 0 "
    "UNION ALL SELECT 'sk_product', CAST(count(*) AS BIGINT) FROM fct_line WHERE sales_order_id % 700 = 5 HAVING count(*) > 0"))(_planted_not_null)


def _planted_alloc(s, d):
    w = wh(s, d)
    header = w.header  # before the lines, whose allocated amounts are read
    line = _changed(w.lines, "sales_order_id % 500 = 3", allocated_freight="allocated_freight * 2")
    return Q.allocation_gap(line, header, "sales_order_id", "allocated_freight", "freight_amount", "net_amount").select("sales_order_id")


register("dq_allocation_gap_planted", O.canonical_select(
    {"sales_order_id": "expr:i:h.sales_order_id"}, "header h", where="h.sales_order_id % 500 = 3 AND h.freight_amount > 0.01 "
    "AND h.sales_order_id IN (SELECT sales_order_id FROM fct_line GROUP BY sales_order_id HAVING sum(net_amount) > 0)"))(_planted_alloc)


def _planted_pit(s, d):
    """Every line costed with its product version's current cost: the point-in-time join did nothing."""
    w = wh(s, d)
    now = w.dims["product"].select("sk_product", F.col("standard_cost").alias("now_cost"))
    line = w.lines.join(now, "sk_product").withColumn("unit_standard_cost", F.col("now_cost")).drop("now_cost")
    return Q.pit_has_effect(line, w.dims["product"])


register("dq_pit_effect_planted", O.canonical_select(
    {"differing_rows": "i"},
    "(SELECT count_if(abs(x.cost - p.standard_cost) > 0.001) AS differing_rows FROM ("
    "SELECT f.sk_product, f.is_fallback_cost, n.standard_cost AS cost FROM fct_line f JOIN dim_product n ON n.sk_product = f.sk_product) x "
    "JOIN dim_product p ON p.sk_product = x.sk_product WHERE NOT x.is_fallback_cost) y",
    where="differing_rows = 0"))(_planted_pit)


def _planted_count(s, d):
    w = wh(s, d)
    return Q.same_count(w.lines.where("sales_order_id % 100 <> 7"), w.detail)


register("dq_same_count_planted", O.with_blocks(
    "SELECT CAST((SELECT count(*) FROM fct_line WHERE sales_order_id % 100 <> 7) AS BIGINT) AS fact_rows, "
    "CAST((SELECT count(*) FROM detail) AS BIGINT) AS source_rows"))(_planted_count)


def _planted_total(s, d):
    w = wh(s, d)
    line = _changed(w.lines, "sales_order_id % 500 = 3", net_amount="net_amount + 1")
    return Q.same_total(line, F.col("net_amount"), w.detail, net_amount("order_quantity", "unit_price", "unit_price_discount")).select("variance")


register("dq_same_total_planted", O.canonical_select(
    {"variance": "expr:m:CAST(count(*) AS DECIMAL(19,2))"}, "fct_line", where="sales_order_id % 500 = 3", extra="HAVING count(*) > 0"))(_planted_total)


def _planted_current(s, d):
    dim = wh(s, d).dims["product"]
    none = _changed(dim, "product_id % 50 = 4", is_current="false")
    return Q.one_current(none.unionByName(dim.where("product_id % 50 = 9 and is_current")), "product_id")


register("dq_one_current_planted", O.canonical_select(
    {"product_id": "i", "n_current": "expr:i:CASE WHEN product_id % 50 = 4 THEN 0 ELSE 2 END"}, "dim_product",
    where="product_id <> -1 AND product_id % 50 IN (4, 9)", extra="GROUP BY product_id"))(_planted_current)


def _planted_grain(s, d):
    line = wh(s, d).fct_line.select("sk_sales_order_line", "sales_order_id")
    return Q.grain(line.unionByName(line.where("sales_order_id % 200 = 5")), ["sk_sales_order_line"])


register("dq_grain_planted", O.canonical_select(
    {"sk_sales_order_line": "s", "n_rows": "expr:i:2"}, "fct_line", where="sales_order_id % 200 = 5"))(_planted_grain)


def _grains(s, d):
    """Grain policy of every fact, the bridge and the marts: keys that occur more than once.

    The order fact first: the line fact then reads its headers and roll-up. Of the line fact the columns that the four
    tables made from it need are written; of every other table, its key."""
    w = wh(s, d)
    w.fct_order  # noqa: B018
    if "fct_line" not in w.__dict__:
        w = w.with_lines(["sk_sales_order_line", "sales_order_id", "sk_order_date", "sk_product", "sk_customer", "sk_salesperson",
                          "net_amount", "gross_margin", "order_qty"])
    tables = {"fct_sales_order_line": (w.lines, ["sk_sales_order_line"]), "fct_sales_order": (w.fct_order, ["sk_sales_order"]),
              "fct_sales_quota": (w.fct_quota, ["sk_sales_quota"]), "bridge_order_sales_reason": (w.bridge, ["sk_order_sales_reason"]),
              "mart_product_abc_pareto": (w.mart_pareto, ["sk_product"]), "mart_customer_clv_rfm": (w.mart_rfm, ["sk_customer"]),
              "mart_seller_quota_attainment": (w.mart_quota, ["sk_salesperson", "year_quarter"])}
    tables = {k: (w.keep(f"grain_{k}", df.select(*keys)) if k.startswith("mart_") else df, keys) for k, (df, keys) in tables.items()}
    return Q.union_labelled({k: df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("k", F.lit(1)).join(
        Q.grain(df, keys).agg(F.count(F.lit(1)).alias("repeated_keys")).withColumn("k", F.lit(1)), "k").drop("k")
        for k, (df, keys) in tables.items()})


_GRAIN_TABLES = {"fct_sales_order_line": ("fct_line", "sk_sales_order_line"), "fct_sales_order": ("fct_order", "sk_sales_order"),
                 "fct_sales_quota": ("fct_quota", "sk_sales_quota"), "bridge_order_sales_reason": ("bridge", "sk_order_sales_reason"),
                 "mart_product_abc_pareto": ("mart_pareto", "sk_product"), "mart_customer_clv_rfm": ("mart_rfm", "sk_customer"),
                 "mart_seller_quota_attainment": ("mart_quota", "sk_salesperson, year_quarter")}
register("dq_grain_all", O.with_blocks(" UNION ALL ".join(
    f"SELECT '{k}' AS label, CAST((SELECT count(*) FROM {t}) AS BIGINT) AS n_rows, "
    f"CAST((SELECT count(*) FROM (SELECT {c} FROM {t} GROUP BY {c} HAVING count(*) > 1)) AS BIGINT) AS repeated_keys"
    for k, (t, c) in _GRAIN_TABLES.items())))(_grains)


# ================================================================== every declared column check
# Fixed values: (table, columns never NULL, columns without repeats, foreign keys, accepted values).
_DIM_KEY = {f"dim_{k}": f"sk_{k}" for k in ("product", "customer", "salesperson", "territory", "geography", "ship_method",
                                            "special_offer", "currency", "order_status", "sales_reason", "date")}
_LINE_KEYS = {"sk_product": "product", "sk_customer": "customer", "sk_salesperson": "salesperson", "sk_territory": "territory",
              "sk_special_offer": "special_offer", "sk_ship_method": "ship_method", "sk_order_status": "order_status",
              "sk_currency": "currency", "sk_bill_to_geography": "geography", "sk_ship_to_geography": "geography"}
DECLARED = [
    ("fct_line", ["sk_sales_order_line", "sales_order_detail_id", *_LINE_KEYS, "net_amount"], ["sk_sales_order_line", "sales_order_detail_id"], _LINE_KEYS, {}),
    ("fct_order", ["sk_sales_order", "sales_order_id"], ["sk_sales_order", "sales_order_id"], {"sk_customer": "customer"}, {}),
    ("fct_quota", ["sk_sales_quota"], ["sk_sales_quota"], {"sk_salesperson": "salesperson"}, {}),
    ("bridge", ["sk_order_sales_reason"], ["sk_order_sales_reason"], {"sk_sales_reason": "sales_reason"}, {}),
    *[(t, [k], [k], {}, {}) for t, k in _DIM_KEY.items()],
    ("mart_rfm", ["sk_customer", "frequency_orders"], ["sk_customer"], {}, {"rfm_segment": O.SEGMENTS}),
    ("mart_pareto", ["sk_product", "revenue"], ["sk_product"], {}, {"abc_class": ["A", "B", "C"]}),
    ("mart_quota", [], [], {}, {"attainment_status": O.ATTAINMENT}),
    ("header", ["sales_order_id"], ["sales_order_id"], {}, {}),
    ("detail", ["sales_order_id", "sales_order_detail_id"], ["sales_order_detail_id"], {}, {}),
]


def _declared(s, d):
    """Every declared check with the number of its failures, one row per check.

    The order fact first: the line fact then reads its headers and roll-up. Of the line fact the columns that
    are checked and those that the marts need are written."""
    w, out = wh(s, d), {}
    w.fct_order  # noqa: B018
    if "fct_line" not in w.__dict__:
        w = w.with_lines(["sk_sales_order_line", "sales_order_id", "sales_order_detail_id", *_LINE_KEYS, "sk_order_date",
                          "net_amount", "gross_margin", "order_qty"])
    for t, nn, un, fks, accepted in DECLARED:
        df = w.dims[t[4:]] if t.startswith("dim_") else getattr(w, t)
        if t.startswith("mart_"):
            df = w.keep(f"declared_{t}", df)
        checks = Q.declared_checks(df, nn, un, accepted)
        if fks:
            checks = checks.unionByName(Q.declared_relationships(df, {fk: (w.dims[x], f"sk_{x}") for fk, x in fks.items()}))
        out[t] = checks
    return Q.union_labelled(out)


def _declared_sql() -> str:
    parts = []
    for t, nn, un, fks, accepted in DECLARED:
        parts += [(t, "not_null", c, f"SELECT count(*) FROM {t} WHERE {c} IS NULL") for c in nn]
        parts += [(t, "accepted_values", c, f"SELECT count(*) FROM {t} WHERE {c} NOT IN ({', '.join(repr(x) for x in v)})") for c, v in accepted.items()]
        parts += [(t, "unique", c, f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)") for c in un]
        parts += [(t, "relationships", c, f"SELECT count(DISTINCT {c}) FROM {t} WHERE {c} NOT IN (SELECT sk_{x} FROM dim_{x})") for c, x in fks.items()]
    return " UNION ALL ".join(f"SELECT '{t}' AS label, '{n}' AS check_name, '{c}' AS column_name, CAST(({q}) AS BIGINT) AS failures" for t, n, c, q in parts)


register("dq_declared", O.with_blocks(_declared_sql()))(_declared)


# ================================================================== every derivable silver model, over landed text
from ledgerstar.plans import roles as ROLES  # noqa: E402

# model: (role frame of the warehouse, oracle source of the same rows, the columns that the role fills)
STAGED = {
    "stg_address": (lambda w: ROLES.addresses(w.t), "addr_raw", "address_id address_line1 address_line2 city state_province_id postal_code modified_date"),
    "stg_countryregion": (lambda w: ROLES.country_regions(w.t), "countries", "country_region_code country_region_name"),
    "stg_currency": (lambda w: ROLES.currencies(w.t), "(SELECT * FROM dim_currency WHERE sk_currency <> '-1') x", "currency_code currency_name modified_date"),
    "stg_employee": (lambda w: ROLES.employees(w.t), "employees", "business_entity_id job_title gender marital_status hire_date"),
    "stg_listpricehistory": (lambda w: ROLES.list_price_history(w.t), "price_hist", "product_id start_date end_date list_price modified_date"),
    "stg_orderdetail": (lambda w: w.detail, "detail", "sales_order_id order_quantity product_id special_offer_id unit_price unit_price_discount modified_date"),
    "stg_orderheadersalesreason": (lambda w: w.reason_pairs, "reason_pairs", "sales_order_id sales_reason_id modified_date"),
    "stg_person": (lambda w: ROLES.seller_info(w.t), "(SELECT s_suppkey AS business_entity_id, CAST(100000 + 1000 * (s_suppkey % 50) AS DECIMAL(19,2)) AS sales_quota, "
                   "CAST(0 AS DECIMAL(19,2)) AS bonus, CAST(0.01 AS DECIMAL(19,2)) AS commission_percent FROM supplier) x",
                   "business_entity_id sales_quota bonus commission_percent"),
    "stg_specialoffer": (lambda w: ROLES.special_offers(w.detail), "(SELECT special_offer_id, discount_percent, offer_type AS discount_type, "
                         "offer_category AS discount_category, start_date, end_date, min_qty AS min_quantity FROM dim_special_offer WHERE special_offer_id <> -1) x",
                         "special_offer_id discount_percent discount_type discount_category start_date end_date min_quantity"),
    "stg_personne": (lambda w: ROLES.persons(w.t), "persons", "business_entity_id first_name last_name"),
    "stg_personquotahistory": (lambda w: ROLES.quota_history(w.t), "quota_hist", "business_entity_id quota_date sales_quota"),
    "stg_product": (lambda w: w.product_current, "prod_current", "product_id product_name product_number standard_cost list_price modified_date"),
    "stg_productcategory": (lambda w: ROLES.product_categories(w.t), "cat", "product_category_id product_category_name"),
    "stg_productcosthistory": (lambda w: ROLES.cost_history(w.t), "cost_hist", "product_id start_date end_date standard_cost modified_date"),
    "stg_productsubcat": (lambda w: ROLES.product_subcategories(w.t), "subcat", "product_subcategory_id product_category_id product_subcategory_name"),
    "stg_reason": (lambda w: ROLES.sales_reasons(w.reason_pairs), "reasons", "sales_reason_id sales_reason_name reason_type modified_date"),
    "stg_shipmethod": (lambda w: ROLES.ship_methods(w.t), "(SELECT * FROM dim_ship_method WHERE sk_ship_method <> -1) x",
                       "ship_method_id ship_method_name ship_base ship_rate modified_date"),
    "stg_stateprovince": (lambda w: ROLES.state_provinces(w.t), "provinces", "state_province_id state_province_code state_province_name country_region_code"),
    "stg_store": (lambda w: ROLES.stores(w.t), "stores", "business_entity_id store_name"),
}


def _staged(model: str):
    role, _, listed = STAGED[model]

    def run(s, d):
        """The role written as a headerless text file in the model's layout (unfilled columns empty, the row
        id a digest of the first key), read strictly, and staged by the model's spec."""
        w, spec = wh(s, d), SR.spec(model)
        df = role(w)
        filled = set(listed.split()) & {c.name for c in spec}
        key = next(c.name for c in spec if c.name in filled)
        cols = [F.col(c.name).cast("string") if c.name in filled else F.md5(F.col(key).cast("string")) if c.name == "row_guid"
                else F.lit(None).cast("string") for c in spec]
        path = scratch_path(s, f"landing-{model}")
        w.written.append(path)
        SL.write_landing(df.select(*[e.alias(c.raw) for e, c in zip(cols, spec)]), path)
        return apply_spec(SL.read_landing(s, path, SR.landing_columns(model)), spec).select(*[c.name for c in spec])

    return run


def _staged_sql(model: str) -> str:
    _, source, listed = STAGED[model]
    spec = SR.spec(model)
    filled = [c for c in spec if c.name in set(listed.split())]
    kinds = {"i": "i", "bi": "i", "d": "d", "ts": "t", "b": "b"}
    empty = {"i": "BIGINT", "b": "BOOLEAN"}
    out = {}
    for c in spec:
        k = "m" if c.kind.startswith("dec") else kinds.get(c.kind, "s")
        if c in filled:
            out[c.name] = f"expr:s:nullif(trim(CAST({c.name} AS VARCHAR)), '')" if k == "s" else k
        elif c.name == "row_guid":
            out[c.name] = f"expr:s:md5(CAST({filled[0].name} AS VARCHAR))"
        else:
            out[c.name] = f"expr:s:CAST(NULL AS {empty.get(k, 'VARCHAR')})"
    return O.canonical_select(out, source)


for _m in STAGED:
    register("silver_" + _m[4:], _staged_sql(_m))(_staged(_m))


def _load_metadata(s, d):
    """Orders landed as files with a column that is dropped on load, loaded strictly into bronze with the scanned
    file's name, the load time and a generated batch id, and read back through the source registry."""
    w = wh(s, d)
    base = scratch_path(s, "bronze-load")
    w.written.append(base)
    text = orders_text(w.t).withColumn("xmldata", F.lit("<a/>"))
    path = SL.write_landing(text, f"{base}/landing")
    SL.load_landing(s, path, text.columns, f"{base}/loaded", drop_cols=["xmldata"])
    bronze = SB.with_load_metadata(s.read.parquet(f"{base}/loaded"), SB.new_batch_id())
    target = SR.source_path(base, "sales.salesorderheader")
    bronze.write.mode("overwrite").parquet(target)
    back = s.read.parquet(target)
    named = back.groupBy("_batch_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_source_file").rlike(r"^part-.*\.parquet$")).alias("n_named"),
                                          F.count_if(F.col("_loaded_at").isNotNull()).alias("n_timed"))
    return named.select("n_rows", "n_named", "n_timed", F.col("_batch_id").rlike(r"^init_[0-9]{8}_[0-9]{6}$").alias("batch_ok"),
                        F.lit(",".join(sorted(c for c in back.columns if not c.startswith("_")))).alias("columns"))


register("src_load_metadata", O.canonical_select(
    {"n_rows": "expr:i:count(*)", "n_named": "expr:i:count(*)", "n_timed": "expr:i:count(*)", "batch_ok": "expr:b:true",
     "columns": "expr:s:'customerid,orderdate,salesorderid'"}, "orders"))(_load_metadata)


# ================================================================== relational operators on their own
from ledgerstar.functions.columns import surrogate_key  # noqa: E402
from ledgerstar.operators import star as STAR  # noqa: E402


def _rel_semi(s, d):
    """Orders with a line of at least 49 pieces."""
    t = R_load(s, d)
    big = t["lineitem"].where(F.col("l_quantity") >= 49).select(F.col("l_orderkey").alias("o_orderkey"))
    return t["orders"].select("o_orderkey", "o_custkey").join(big, "o_orderkey", "left_semi")


register("rel_semi", O.canonical_select({"o_orderkey": "i", "o_custkey": "i"}, "orders",
                                        where="o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)"))(_rel_semi)


def _rel_anti(s, d):
    """Customers without an urgent order."""
    t = R_load(s, d)
    urgent = t["orders"].where(F.col("o_orderpriority").startswith("1")).select(F.col("o_custkey").alias("c_custkey"))
    return t["customer"].select("c_custkey", "c_name").join(urgent, "c_custkey", "left_anti")


register("rel_anti", O.canonical_select({"c_custkey": "i", "c_name": "s"}, "customer c",
                                        where="NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority LIKE '1%')"))(_rel_anti)


def _rel_full_outer(s, d):
    """Orders placed and lines shipped per customer group and month; either side may be missing."""
    t = R_load(s, d)
    placed = t["orders"].groupBy((F.col("o_custkey") % 50).alias("grp"), F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("placed"))
    shipped = t["lineitem"].groupBy((F.col("l_suppkey") % 50).alias("grp"), F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("shipped"))
    return placed.join(shipped, ["grp", "month"], "full_outer").select("grp", "month", F.coalesce("placed", F.lit(0)).alias("placed"), F.coalesce("shipped", F.lit(0)).alias("shipped"))


register("rel_full_outer", O.canonical_select(
    {"grp": "i", "month": "s", "placed": "expr:i:sum(p)", "shipped": "expr:i:sum(q)"},
    "(SELECT o_custkey % 50 AS grp, strftime(o_orderdate, '%Y-%m') AS month, 1 AS p, 0 AS q FROM orders UNION ALL "
    "SELECT l_suppkey % 50, strftime(l_shipdate, '%Y-%m'), 0, 1 FROM lineitem) u", extra="GROUP BY grp, month"))(_rel_full_outer)


def _rel_literal(s, d):
    w = wh(s, d)
    o = w.t["orders"].select("o_orderkey")
    known = STAR.literal_key_join(o, w.dims["currency"], "currency_code", "USD", "sk_currency", "sk_reporting")
    return STAR.literal_key_join(known, w.dims["currency"], "currency_code", "XXX", "sk_currency", "sk_missing")


register("rel_literal_key", O.canonical_select({"o_orderkey": "i", "sk_reporting": "expr:s:'USD'", "sk_missing": "expr:s:'-1'"}, "orders"))(_rel_literal)


def _rel_roles(s, d):
    """One dimension in two roles: the nation of the supplier and of the customer of every line."""
    t = R_load(s, d)
    n = t["nation"].select("n_nationkey", "n_name")
    line = (t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
            .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")))
    line = line.join(n.toDF("ck", "customer_nation"), F.col("c_nationkey") == F.col("ck"), "left").join(n.toDF("sk", "supplier_nation"), F.col("s_nationkey") == F.col("sk"), "left")
    return line.groupBy("supplier_nation", "customer_nation").agg(F.count(F.lit(1)).alias("n_lines"))


register("rel_role_playing", O.canonical_select(
    {"supplier_nation": "expr:s:a.n_name", "customer_nation": "expr:s:b.n_name", "n_lines": "expr:i:count(*)"},
    "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey "
    "LEFT JOIN nation a ON s_nationkey = a.n_nationkey LEFT JOIN nation b ON c_nationkey = b.n_nationkey", extra="GROUP BY a.n_name, b.n_name"))(_rel_roles)


def _rel_hash(s, d):
    """Orders joined to the distinct (status, priority) pairs on a computed hash key."""
    o = R_load(s, d)["orders"]
    pairs = o.select("o_orderstatus", "o_orderpriority").distinct().select(surrogate_key("o_orderstatus", "o_orderpriority").alias("pair_key"), F.col("o_orderstatus").alias("pair_status"))
    return (o.withColumn("pair_key", surrogate_key("o_orderstatus", "o_orderpriority")).join(pairs, "pair_key")
            .groupBy("pair_key", "pair_status").agg(F.count(F.lit(1)).alias("n_orders")))


register("rel_hash_key", O.canonical_select(
    {"pair_key": f"expr:s:{O.skey('o_orderstatus', 'o_orderpriority')}", "pair_status": "expr:s:o_orderstatus", "n_orders": "expr:i:count(*)"},
    "orders", extra="GROUP BY o_orderstatus, o_orderpriority"))(_rel_hash)


def _rel_scalar(s, d):
    """Orders later than the median day between the first and the last, by a scalar subquery."""
    o = R_load(s, d)["orders"].select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    half = o.agg(F.date_add(F.min("day"), (F.datediff(F.max("day"), F.min("day")) / 2).cast("int"))).scalar()
    return o.where(F.col("day") > half)


register("rel_cross_scalar", O.canonical_select(
    {"o_orderkey": "i", "day": "expr:d:CAST(o_orderdate AS DATE)"}, "orders",
    where="CAST(o_orderdate AS DATE) > (SELECT CAST(min(o_orderdate) AS DATE) + CAST(date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) // 2 AS INTEGER) FROM orders)"))(_rel_scalar)

register("rel_distinct", O.canonical_select({"l_suppkey": "i", "l_returnflag": "s"}, "(SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem) x"))(
    lambda s, d: R_load(s, d)["lineitem"].select("l_suppkey", "l_returnflag").distinct())

register("rel_topk", O.canonical_select(
    {"o_orderkey": "i", "price": "expr:m:CAST(o_totalprice AS DECIMAL(19,2))"}, "orders", extra="ORDER BY CAST(o_totalprice AS DECIMAL(19,2)) DESC, o_orderkey LIMIT 20"))(
    lambda s, d: R_load(s, d)["orders"].select("o_orderkey", F.col("o_totalprice").cast("decimal(19,2)").alias("price")).orderBy(F.desc("price"), "o_orderkey").limit(20))

register("rel_union_label", O.canonical_select(
    {"label": "s", "id": "i", "name": "s"},
    "(SELECT 'customer' AS label, c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier) u"))(
    lambda s, d: Q.union_labelled({"customer": R_load(s, d)["customer"].select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
                                   "supplier": R_load(s, d)["supplier"].select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))}))


def _dates_used(s, d):
    """The generated date spine with what happens on each of its days: orders placed, lines shipped."""
    w = wh(s, d)
    day = w.dims["date"].where("sk_date <> -1").select("sk_date", "date_actual", "year_quarter", "is_weekend")
    placed = w.t["orders"].groupBy(F.col("o_orderdate").cast("date").alias("date_actual")).agg(F.count(F.lit(1)).alias("placed"))
    shipped = w.t["lineitem"].groupBy(F.col("l_shipdate").cast("date").alias("date_actual")).agg(F.count(F.lit(1)).alias("shipped"))
    both = day.join(placed, "date_actual", "left").join(shipped, "date_actual", "left")
    return both.select("sk_date", "year_quarter", "is_weekend", F.coalesce("placed", F.lit(0)).alias("placed"), F.coalesce("shipped", F.lit(0)).alias("shipped"))


register("dim_date_used", O.canonical_select(
    {"sk_date": "i", "year_quarter": "s", "is_weekend": "b",
     "placed": "expr:i:(SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = date_actual)",
     "shipped": "expr:i:(SELECT count(*) FROM lineitem WHERE CAST(l_shipdate AS DATE) = date_actual)"}, "dim_date", where="sk_date <> -1"))(_dates_used)


# ================================================================== declared checks of the silver models
# Per model the columns declared never NULL, and those declared unique.
STAGED_CHECKS = """
stg_address: address_id address_line1 city state_province_id postal_code row_guid modified_date; address_id row_guid
stg_countryregion: country_region_code country_region_name modified_date; country_region_code
stg_currency: currency_code currency_name modified_date; currency_code
stg_employee: business_entity_id national_id_number login_id job_title birth_date marital_status gender hire_date salaried_flag vacation_hours sick_leave_hours current_flag row_guid modified_date; business_entity_id national_id_number login_id row_guid
stg_listpricehistory: product_id start_date list_price modified_date;
stg_orderdetail: sales_order_id sales_order_detail_id order_quantity product_id special_offer_id unit_price unit_price_discount row_guid modified_date; sales_order_detail_id row_guid
stg_orderheadersalesreason: sales_order_id sales_reason_id modified_date;
stg_personne: business_entity_id first_name last_name; business_entity_id
stg_product: product_id product_name product_number safety_stock_level reorder_point standard_cost list_price days_to_manufacture row_guid modified_date; product_id product_number row_guid
stg_productcategory: product_category_id product_category_name row_guid modified_date; product_category_id product_category_name row_guid
stg_productcosthistory: product_id start_date standard_cost modified_date;
stg_productsubcat: product_subcategory_id product_category_id product_subcategory_name row_guid modified_date; product_subcategory_id product_subcategory_name row_guid
stg_reason: sales_reason_id sales_reason_name reason_type modified_date; sales_reason_id
stg_shipmethod: ship_method_id ship_method_name ship_base ship_rate row_guid modified_date; ship_method_id ship_method_name row_guid
stg_stateprovince: state_province_id state_province_code country_region_code is_only_state_province_flag state_province_name territory_id row_guid modified_date; state_province_id state_province_name row_guid
stg_store: business_entity_id store_name row_guid modified_date; business_entity_id row_guid
"""


def _staged_checks() -> dict[str, tuple[list[str], list[str]]]:
    """The declared checks on columns that the model's role fills (its row id is a digest of the key)."""
    out = {}
    for line in STAGED_CHECKS.strip().splitlines():
        model, rest = line.split(":")
        filled = {c.name for c in SR.spec(model)} & (set(STAGED[model][2].split()) | {"row_guid"})
        out[model] = tuple([c for c in part.split() if c in filled] for part in rest.split(";"))
    return out


def _declared_staging(s, d):
    return Q.union_labelled({m: Q.declared_checks_once(_staged(m)(s, d), nn, un) for m, (nn, un) in _staged_checks().items()})


def _declared_staging_sql() -> str:
    parts = []
    for m, (nn, un) in _staged_checks().items():
        spec = {c.name: c.kind for c in SR.spec(m)}
        key = next(c for c in spec if c in STAGED[m][2].split())

        def value(c):
            c, text = (key, False) if c == "row_guid" else (c, spec[c] in ("t", "v"))
            return f"nullif(trim({c}), '')" if text else c

        parts += [(m, "not_null", c, f"SELECT count(*) FROM {STAGED[m][1]} WHERE {value(c)} IS NULL") for c in nn]
        parts += [(m, "unique", c, f"SELECT count(*) FROM (SELECT {value(c)} AS v FROM {STAGED[m][1]} WHERE {value(c)} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)") for c in un]
    return " UNION ALL ".join(f"SELECT '{m}' AS label, '{n}' AS check_name, '{c}' AS column_name, CAST(({q}) AS BIGINT) AS failures" for m, n, c, q in parts)


register("dq_declared_staging", O.with_blocks(_declared_staging_sql()))(_declared_staging)
