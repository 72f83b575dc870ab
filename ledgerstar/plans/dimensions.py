"""Gold dimensions. Each takes silver DataFrames and returns the dimension with its
unknown member appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.functions.columns import (clean_text, date_key, day_of_week_sunday0, surrogate_key,
                                          year_quarter)
from ledgerstar.operators.scd2 import VERSION_FROM, expose_versions
from ledgerstar.operators.staging import latest_per_key
from ledgerstar.operators.star import with_unknown_member

# Order status codes and their names.
STATUS_NAMES = {1: "In Process", 2: "Approved", 3: "Backordered", 4: "Rejected", 5: "Shipped", 6: "Cancelled"}


def _ts_text(c):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


def dim_date(spark: SparkSession, start: str = "2000-01-01", n_days: int = 11000,
             end: str = "2030-12-31") -> DataFrame:
    """Date spine of ``n_days`` days from ``start`` (cut at ``end``) with calendar
    attributes; week day 0 = Sunday; ISO week. Its size is the ``n_days`` parameter,
    a proven bound, which is why facts broadcast it."""
    d = spark.range(n_days).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_actual"))
    d = d.where(F.col("date_actual") <= F.lit(end).cast("date"))
    dd = d.select(
        date_key("date_actual").alias("sk_date"),
        "date_actual",
        F.year("date_actual").alias("year"),
        F.quarter("date_actual").alias("quarter"),
        year_quarter("date_actual").alias("year_quarter"),
        F.month("date_actual").alias("month"),
        F.date_format("date_actual", "MMMM").alias("month_name"),
        F.date_format("date_actual", "MMM").alias("month_name_short"),
        F.date_format("date_actual", "yyyy-MM").alias("year_month"),
        F.weekofyear("date_actual").alias("week_of_year"),
        F.dayofmonth("date_actual").alias("day_of_month"),
        day_of_week_sunday0("date_actual").alias("day_of_week"),
        F.date_format("date_actual", "EEEE").alias("day_name"),
        F.date_format("date_actual", "EEE").alias("day_name_short"),
        day_of_week_sunday0("date_actual").isin(0, 6).alias("is_weekend"),
    )
    return with_unknown_member(dd, {"sk_date": -1})


def stg_address(raw_addresses: DataFrame) -> DataFrame:
    """stg_address: text cleaned, then the latest row per address (defensive de-dup)."""
    a = raw_addresses.select(
        "address_id",
        clean_text("address_line1").alias("address_line1"),
        clean_text("address_line2").alias("address_line2"),
        clean_text("city").alias("city"),
        "state_province_id",
        clean_text("postal_code").alias("postal_code"),
        "modified_date")
    return latest_per_key(a, "address_id", "modified_date")


def dim_geography(address: DataFrame, province: DataFrame, country: DataFrame) -> DataFrame:
    g = (address.join(province, "state_province_id", "left")
                .join(country, "country_region_code", "left"))
    g = g.select(
        F.col("address_id").alias("sk_geography"), "address_id", "address_line1", "address_line2", "city",
        "postal_code", "state_province_code", F.col("state_province_name").alias("state_name"),
        "country_region_code", F.col("country_region_name").alias("country_name"), "modified_date")
    unknown = {c: "Unknown" for c in ["address_line1", "address_line2", "city", "postal_code",
                                       "state_province_code", "state_name", "country_region_code", "country_name"]}
    unknown.update({"sk_geography": -1, "address_id": -1})
    return with_unknown_member(g, unknown)


def dim_product(snap_product: DataFrame, subcategory: DataFrame, category: DataFrame) -> DataFrame:
    """SCD2 product versions with the subcategory and category flattened in."""
    v = expose_versions(snap_product, "product_id")
    v = (v.join(subcategory, v.subcategory_id == subcategory.product_subcategory_id, "left")
          .join(category, "product_category_id", "left"))
    d = v.select(
        surrogate_key("product_id", _ts_text(VERSION_FROM)).alias("sk_product"),
        "product_id", "product_name", "product_number", "standard_cost", "list_price",
        F.col("product_subcategory_name").alias("subcategory_name"),
        F.col("product_category_name").alias("category_name"),
        "valid_from", "valid_to", "is_current", "modified_date")
    return with_unknown_member(d, {
        "sk_product": "-1", "product_id": -1, "product_name": "Unknown", "product_number": "Unknown",
        "standard_cost": 0, "list_price": 0, "subcategory_name": "Unknown", "category_name": "Unknown",
        "valid_from": "1900-01-01 00:00:00", "valid_to": "9999-12-31 00:00:00", "is_current": True})


def dim_customer(snap_customer: DataFrame, person: DataFrame, store: DataFrame) -> DataFrame:
    """SCD2 customer versions; Reseller when a store is attached, else Individual."""
    v = expose_versions(snap_customer, "customer_id")
    pn = person.select(F.col("business_entity_id").alias("person_id"), "first_name", "last_name")
    st = store.select(F.col("business_entity_id").alias("store_id"), "store_name")
    v = v.join(pn, "person_id", "left").join(st, "store_id", "left")
    full_name = F.trim(F.concat(F.coalesce("first_name", F.lit("")), F.lit(" "), F.coalesce("last_name", F.lit(""))))
    d = v.select(
        surrogate_key("customer_id", _ts_text(VERSION_FROM)).alias("sk_customer"),
        "customer_id", "person_id", "store_id", "territory_id",
        F.when(F.col("store_id").isNotNull(), "Reseller").when(F.col("person_id").isNotNull(), "Individual")
         .otherwise("Unknown").alias("customer_type"),
        full_name.alias("customer_name"),
        "store_name",
        F.coalesce(F.nullif(F.col("store_name"), F.lit("")), F.nullif(full_name, F.lit("")),
                   F.lit("Unknown")).alias("customer_display_name"),
        "valid_from", "valid_to", "is_current", "modified_date")
    return with_unknown_member(d, {
        "sk_customer": "-1", "customer_id": -1, "customer_type": "Unknown", "customer_name": "Unknown",
        "store_name": "Unknown", "customer_display_name": "Unknown",
        "valid_from": "1900-01-01 00:00:00", "valid_to": "9999-12-31 00:00:00", "is_current": True})


def dim_order_status(header: DataFrame) -> DataFrame:
    """Junk dimension over the distinct (status, online flag) pairs of the headers."""
    pairs = header.select("order_status", "online_order_flag").distinct()
    status = F.lit("Unknown")
    for code in sorted(STATUS_NAMES, reverse=True):
        status = F.when(F.col("order_status") == code, STATUS_NAMES[code]).otherwise(status)
    d = pairs.select(
        surrogate_key("order_status", "online_order_flag").alias("sk_order_status"),
        F.col("order_status").alias("status_id"),
        status.alias("status_name"),
        F.when(F.col("online_order_flag") == 1, "Online").when(F.col("online_order_flag") == 0, "Reseller")
         .otherwise("Unknown").alias("sales_channel"))
    return with_unknown_member(d, {"sk_order_status": "-1", "status_id": -1, "status_name": "Unknown",
                                   "sales_channel": "Unknown"})


def dim_currency(currency: DataFrame) -> DataFrame:
    d = currency.select(F.col("currency_code").alias("sk_currency"), "currency_code", "currency_name", "modified_date")
    return with_unknown_member(d, {"sk_currency": "-1", "currency_code": "-1", "currency_name": "Unknown"})


def dim_sales_reason(reason: DataFrame) -> DataFrame:
    d = reason.select(F.col("sales_reason_id").alias("sk_sales_reason"), "sales_reason_id", "sales_reason_name",
                      "reason_type", "modified_date")
    return with_unknown_member(d, {"sk_sales_reason": -1, "sales_reason_id": -1, "sales_reason_name": "Unknown",
                                   "reason_type": "Unknown"})


def dim_salesperson(employee: DataFrame, person: DataFrame, sales_info: DataFrame) -> DataFrame:
    """Employees whose job title contains 'Sales', with name and quota info."""
    e = employee.where(F.col("job_title").like("%Sales%"))
    j = e.join(person.select("business_entity_id", "first_name", "last_name"), "business_entity_id", "left") \
         .join(sales_info.select("business_entity_id", "sales_quota", "bonus", "commission_percent"),
               "business_entity_id", "left")
    d = j.select(
        F.col("business_entity_id").alias("sk_salesperson"),
        F.col("business_entity_id").alias("salesperson_id"),
        F.trim(F.concat(F.coalesce("first_name", F.lit("")), F.lit(" "), F.coalesce("last_name", F.lit(""))))
         .alias("salesperson_name"),
        "job_title", "gender", "marital_status", "hire_date", "sales_quota", "bonus", "commission_percent",
        "modified_date")
    return with_unknown_member(d, {"sk_salesperson": -1, "salesperson_id": -1,
                                   "salesperson_name": "Unknown / Online", "job_title": "Unknown"})


def dim_ship_method(ship_method: DataFrame) -> DataFrame:
    d = ship_method.select(F.col("ship_method_id").alias("sk_ship_method"), "ship_method_id", "ship_method_name",
                           "ship_base", "ship_rate", "modified_date")
    return with_unknown_member(d, {"sk_ship_method": -1, "ship_method_id": -1, "ship_method_name": "Unknown",
                                   "ship_base": 0, "ship_rate": 0})


def dim_special_offer(offer: DataFrame) -> DataFrame:
    d = offer.select(F.col("special_offer_id").alias("sk_special_offer"), "special_offer_id", "discount_percent",
                     F.col("discount_type").alias("offer_type"), F.col("discount_category").alias("offer_category"),
                     "start_date", "end_date", F.col("min_quantity").alias("min_qty"))
    return with_unknown_member(d, {"sk_special_offer": -1, "special_offer_id": -1, "discount_percent": 0,
                                   "offer_type": "Unknown", "offer_category": "Unknown"})


def dim_territory(territory: DataFrame) -> DataFrame:
    d = territory.select(F.col("territory_id").alias("sk_territory"), "territory_id", "territory_name",
                         "country_region_code", "territory_group", "modified_date")
    return with_unknown_member(d, {"sk_territory": -1, "territory_id": -1, "territory_name": "Unknown",
                                   "country_region_code": "Unknown", "territory_group": "Unknown"})
