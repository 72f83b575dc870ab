"""Source registry and silver column specs of the 26 staged entities.

Fixed values: source table names, their columns and silver types, as the warehouse
defines them. Each spec line is ``raw_column silver_column kind`` (kinds as in
``operators.staging.Col``). The order-header landing order is the only positional
layout the source defines; the other landing layouts are parameters of the load.
"""

from __future__ import annotations

from ledgerstar.operators.staging import Col

# The 27 declared source tables (schema.table).
SOURCES = [
    "humanresources.employee",
    "person.address",
    "person.businessentityaddress",
    "person.countryregion",
    "person.person",
    "person.stateprovince",
    "production.product",
    "production.productcategory",
    "production.productcosthistory",
    "production.productlistpricehistory",
    "production.productmodel",
    "production.productsubcategory",
    "purchasing.shipmethod",
    "sales.creditcard",
    "sales.currency",
    "sales.currencyrate",
    "sales.customer",
    "sales.salesorderdetail",
    "sales.salesorderheader",
    "sales.salesorderheadersalesreason",
    "sales.salesperson",
    "sales.salespersonquotahistory",
    "sales.salesreason",
    "sales.salesterritory",
    "sales.specialoffer",
    "sales.specialofferproduct",
    "sales.store",
]

# Landing column order of sales.salesorderheader.
ORDER_HEADER_LANDING = [
    "salesorderid", "revisionnumber", "orderdate", "duedate", "shipdate", "status",
    "onlineorderflag", "salesordernumber", "purchaseordernumber", "accountnumber", "customerid", "salespersonid",
    "territoryid", "billtoaddressid", "shiptoaddressid", "shipmethodid", "creditcardid", "creditcardapprovalcode",
    "currencyrateid", "subtotal", "taxamt", "freight", "totaldue", "comment",
    "rowguid", "modifieddate",
]

# Silver specs, one line per column.
_SPECS = {
    "stg_address": ("person.address", """
        addressid address_id i
        addressline1 address_line1 t
        addressline2 address_line2 t
        city city t
        stateprovinceid state_province_id i
        postalcode postal_code t
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_businessentityaddress": ("person.businessentityaddress", """
        businessentityid business_entity_id i
        addressid address_id i
        addresstypeid address_type_id i
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_countryregion": ("person.countryregion", """
        countryregioncode country_region_code t
        name country_region_name t
        modifieddate modified_date d
    """),
    "stg_creditcard": ("sales.creditcard", """
        creditcardid credit_card_id i
        cardtype card_type t
        cardnumber card_number t
        expmonth exp_month i
        expyear exp_year i
        modifieddate modified_date d
    """),
    "stg_currency": ("sales.currency", """
        currencycode currency_code t
        name currency_name t
        modifieddate modified_date d
    """),
    "stg_customer": ("sales.customer", """
        customerid customer_id i
        personid person_id i
        storeid store_id i
        territoryid territory_id i
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_employee": ("humanresources.employee", """
        businessentityid business_entity_id i
        nationalidnumber national_id_number t
        loginid login_id t
        jobtitle job_title t
        birthdate birth_date d
        maritalstatus marital_status t
        gender gender t
        hiredate hire_date d
        salariedflag salaried_flag i
        vacationhours vacation_hours i
        sickleavehours sick_leave_hours i
        currentflag current_flag i
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_listpricehistory": ("production.productlistpricehistory", """
        productid product_id i
        startdate start_date d
        enddate end_date d
        listprice list_price i
        modifieddate modified_date d
    """),
    "stg_orderdetail": ("sales.salesorderdetail", """
        salesorderid sales_order_id i
        salesorderdetailid sales_order_detail_id i
        carriertrackingnumber carrier_tracking_number t
        orderqty order_quantity i
        productid product_id i
        specialofferid special_offer_id i
        linetotal line_total dec(19,4)
        unitprice unit_price dec(19,4)
        unitpricediscount unit_price_discount dec(19,4)
        modifieddate modified_date d
        rowguid row_guid v
    """),
    "stg_orderheader": ("sales.salesorderheader", """
        salesorderid sales_order_id i
        revisionnumber revision_number i
        orderdate order_date d
        duedate due_date d
        shipdate ship_date d
        status order_status i
        onlineorderflag online_order_flag i
        salesordernumber sales_order_number t
        purchaseordernumber purchase_order_number t
        accountnumber account_number t
        customerid customer_id i
        salespersonid sales_person_id i
        territoryid territory_id i
        billtoaddressid bill_to_address_id i
        shiptoaddressid ship_to_address_id i
        shipmethodid ship_method_id i
        creditcardid credit_card_id i
        creditcardapprovalcode credit_card_approval_code t
        currencyrateid currency_rate_id i
        subtotal sub_total dec(19,2)
        taxamt tax_amount dec(19,2)
        freight freight_amount dec(19,2)
        totaldue total_due dec(19,2)
        comment order_comment t
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_orderheadersalesreason": ("sales.salesorderheadersalesreason", """
        salesorderid sales_order_id i
        salesreasonid sales_reason_id i
        modifieddate modified_date d
    """),
    "stg_person": ("sales.salesperson", """
        businessentityid business_entity_id i
        territoryid territory_id i
        salesquota sales_quota dec(19,2)
        bonus bonus dec(19,2)
        commissionpct commission_percent dec(19,2)
        salesytd sales_ytd dec(19,2)
        saleslastyear sales_last_year dec(19,2)
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_personne": ("person.person", """
        businessentityid business_entity_id i
        persontype person_type t
        namestyle name_style i
        title title t
        firstname first_name t
        middlename middle_name t
        lastname last_name t
        suffix suffix t
        emailpromotion email_promotion i
        rowguid row_guid v
        modifieddate modified_date ts
    """),
    "stg_personquotahistory": ("sales.salespersonquotahistory", """
        businessentityid business_entity_id i
        quotadate quota_date d
        salesquota sales_quota dec(19,2)
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_product": ("production.product", """
        productid product_id i
        name product_name t
        productnumber product_number t
        makeflag make_flag i
        finishedgoodsflag finished_goods_flag i
        color color t
        safetystocklevel safety_stock_level i
        reorderpoint reorder_point i
        standardcost standard_cost i
        listprice list_price i
        size size t
        sizeunitmeasurecode size_unit_measure_code t
        weightunitmeasurecode weight_unit_measure_code t
        weight weight dec(15,2)
        daystomanufacture days_to_manufacture i
        productline product_line t
        class class t
        style style t
        productsubcategoryid product_subcategory_id i
        productmodelid product_model_id i
        sellstartdate sell_start_date d
        sellenddate sell_end_date d
        discontinueddate discontinued_date d
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_productcategory": ("production.productcategory", """
        productcategoryid product_category_id i
        name product_category_name t
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_productcosthistory": ("production.productcosthistory", """
        productid product_id i
        startdate start_date d
        enddate end_date d
        standardcost standard_cost i
        modifieddate modified_date d
    """),
    "stg_productmodel": ("production.productmodel", """
        productmodelid product_model_id i
        name product_model_name t
        catalogdescription catalog_description t
        instructions instructions t
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_productsubcat": ("production.productsubcategory", """
        productsubcategoryid product_subcategory_id i
        productcategoryid product_category_id i
        name product_subcategory_name t
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_reason": ("sales.salesreason", """
        salesreasonid sales_reason_id i
        name sales_reason_name t
        reasontype reason_type t
        modifieddate modified_date d
    """),
    "stg_shipmethod": ("purchasing.shipmethod", """
        shipmethodid ship_method_id i
        name ship_method_name t
        shipbase ship_base i
        shiprate ship_rate i
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_specialoffer": ("sales.specialoffer", """
        specialofferid special_offer_id i
        description description t
        discountpct discount_percent dec(19,2)
        type discount_type t
        category discount_category t
        startdate start_date d
        enddate end_date d
        minqty min_quantity i
        maxqty max_quantity i
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_specialofferproduct": ("sales.specialofferproduct", """
        specialofferid special_offer_id i
        productid product_id i
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_stateprovince": ("person.stateprovince", """
        stateprovinceid state_province_id i
        stateprovincecode state_province_code t
        countryregioncode country_region_code t
        isonlystateprovinceflag is_only_state_province_flag i
        name state_province_name t
        territoryid territory_id i
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_store": ("sales.store", """
        businessentityid business_entity_id i
        name store_name t
        salespersonid sales_person_id i
        demographics demographics t
        rowguid row_guid v
        modifieddate modified_date d
    """),
    "stg_territory": ("sales.salesterritory", """
        territoryid territory_id i
        name territory_name t
        countryregioncode country_region_code t
        GROUP territory_group t
        salesytd sales_ytd i
        saleslastyear sales_last_year i
        costytd cost_ytd i
        costlastyear cost_last_year i
        rowguid row_guid v
        modifieddate modified_date d
    """),
}


def spec(model: str) -> list[Col]:
    """The column spec of a silver model."""
    return [Col(*ln.split()) for ln in _SPECS[model][1].strip().splitlines()]


def source_of(model: str) -> str:
    return _SPECS[model][0]


def landing_columns(model: str) -> list[str]:
    """Raw column names of a model's source in spec order (the default landing layout)."""
    return [c.raw for c in spec(model)]


MODELS = list(_SPECS)


def source_path(base: str, table: str, layer: str = "bronze") -> str:
    """``<base>/<layer>/<schema>/<table>`` of a declared source table; an undeclared name fails."""
    if table not in SOURCES:
        raise KeyError(f"{table!r} is not a declared source table")
    return f"{base.rstrip('/')}/{layer}/{table.replace('.', '/')}"


def source_columns(table: str) -> list[str]:
    """Raw columns that the silver models take from a source table, in landing order."""
    if table == "sales.salesorderheader":
        return list(ORDER_HEADER_LANDING)
    return next((landing_columns(m) for m in MODELS if source_of(m) == table), [])


def read_source(spark, base: str, table: str, layer: str = "bronze"):
    """A declared source table as all-text rows with its declared columns (missing ones fail)."""
    df = spark.read.parquet(source_path(base, table, layer))
    return df.select(*source_columns(table)) if source_columns(table) else df
