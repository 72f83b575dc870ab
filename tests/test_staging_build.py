import os

from pyspark.sql import functions as F

from ledgerstar.operators.staging import Col, apply_spec
from ledgerstar.sources import registry as SR

from conftest import SF_SMALL


def test_apply_spec_reserved_word_and_types(spark):
    raw = spark.createDataFrame([("1", " West ", "12.5", "2020-01-02")], "territoryid string, `GROUP` string, "
                                "salesytd string, modifieddate string")
    spec = [Col("territoryid", "territory_id", "i"), Col("GROUP", "territory_group", "t"),
            Col("salesytd", "sales_ytd", "i"), Col("modifieddate", "modified_date", "d")]
    out = apply_spec(raw, spec)
    assert out.columns == ["territory_id", "territory_group", "sales_ytd", "modified_date"]
    r = out.first()
    assert (r.territory_id, r.territory_group, r.sales_ytd, str(r.modified_date)) == (1, "West", 13, "2020-01-02")


def test_registry_specs():
    assert len(SR.SOURCES) == 27 and len(SR.MODELS) == 26
    assert [c.name for c in SR.spec("stg_territory")][3] == "territory_group"
    assert len(SR.ORDER_HEADER_LANDING) == 26


def test_build_all_writes_every_layer(spark, tmp_path):
    from ledgerstar.plans.warehouse import build_all

    written = build_all(spark, SF_SMALL, str(tmp_path))
    for name in ["stg_orderdetail", "dim_date", "fct_sales_order_line", "mart_product_abc_pareto"]:
        assert os.path.isdir(written[name]), name
    for name, path in written.items():
        assert ("dwh_loaded_at" in spark.read.parquet(path).columns) == name.startswith(("fct_", "mart_", "bridge_")), name
    fct = spark.read.parquet(written["fct_sales_order_line"])
    assert "order_month" in fct.columns
    assert fct.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    # partition pruning on the clustering column
    plan = fct.where(F.col("order_month") == 199801)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan


SAMPLES = {"i": ("12.5", 13), "bi": ("9000000000", 9000000000), "v": (" x ", " x "), "t": ("  y  ", "y"), "d": ("2020-01-02", "2020-01-02"),
           "ts": ("2020-01-02 03:04:05", "2020-01-02 03:04:05"), "b": ("true", "True")}


def test_every_model_stages_text(spark):
    """All 26 specs over a hand-made row of text and a row of NULLs."""
    for m in SR.MODELS:
        spec = SR.spec(m)
        sample = [SAMPLES.get(c.kind, ("1.25", None)) for c in spec]
        raw = spark.createDataFrame([tuple(x for x, _ in sample), (None,) * len(spec)], ", ".join(f"`{c.raw}` string" for c in spec))
        full, empty = apply_spec(raw, spec).collect()
        for c, (_, want) in zip(spec, sample):
            assert empty[c.name] is None
            assert float(full[c.name]) == 1.25 if want is None else str(full[c.name]) == str(want), (m, c)


def test_source_registry_paths_and_columns():
    import pytest

    assert SR.source_path("/b/", "sales.customer") == "/b/bronze/sales/customer"
    assert SR.source_columns("sales.salesorderheader") == SR.ORDER_HEADER_LANDING
    assert all(SR.source_columns(SR.source_of(m)) for m in SR.MODELS)
    with pytest.raises(KeyError):
        SR.source_path("/b", "sales.unknown")
