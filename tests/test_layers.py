"""Gated layer run (JOB1-JOB4), lineage counts (SET1) and the driver contract."""

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata import fixed
from strata.operators import quality as Q
from strata.plans.layers import check_materialized, conform_layer, land_raw, layer_counts, mart_layer, read_raw, run_layers
from shop import raw_shop, write_shop
from strata.plans import queries as core
from strata.sources.store import LayerStore, MissingTableError


def test_csv_through_all_layers(spark, tmp_uri):
    write_shop(raw_shop(spark, customers=40, orders=80, reviews=50), tmp_uri + "/csv")
    store = LayerStore(spark, tmp_uri + "/lake")
    result = run_layers(spark, read_raw(spark, tmp_uri + "/csv"), store, at="2025-01-01 12:00:00")
    assert result.rows[fixed.RAW]["orders"] == 85
    assert result.rows[fixed.CONFORMED]["orders"] == 80          # 5 duplicates removed
    assert set(result.rows[fixed.MART]) == set(fixed.MART_TABLES)
    assert all(r.ok for r in result.reports.values())
    warned = {r.check for r in result.reports[fixed.CONFORMED].failed("WARN")}
    assert warned == {"non_negative(total_amount)", "non_negative(payment_value)", "non_negative(quantity)"}
    assert store.read(fixed.CONFORMED, "orders").columns[-1] == fixed.AUDIT_COLUMN


def test_a_missing_table_is_named(spark):
    with pytest.raises(MissingTableError, match="bronze.orders"):
        conform_layer({"orders": None})
    with pytest.raises(MissingTableError, match="silver.reviews"):
        mart_layer({"reviews": None})


def test_gate_blocks_next_layer(spark, tmp_uri):
    tables = raw_shop(spark, dirty=False)
    bad = dict(tables)
    bad["reviews"] = tables["reviews"].withColumn("rating", F.lit("9"))
    store = LayerStore(spark, tmp_uri + "/lake")
    with pytest.raises(Q.QualityGateError) as err:
        run_layers(spark, bad, store)
    assert "range(rating, 1..5)" in str(err.value)
    assert store.exists(fixed.CONFORMED, "reviews") and not store.exists(fixed.MART, "resumo_clientes")


def test_the_report_of_a_run_runs_no_check_again(spark, tmp_uri):
    result = run_layers(spark, raw_shop(spark), LayerStore(spark, tmp_uri + "/lake"), at="2025-01-01 12:00:00", gate=False)
    assert "Scan parquet" not in result.report()._jdf.queryExecution().executedPlan().toString()
    want = [r for layer in result.reports.values() for r in layer.frame.collect()]
    assert sorted(result.report().collect()) == sorted(want)


def test_layer_counts_reports_absent_tables_as_null(spark):
    df = spark.range(3)
    out = {(r.layer, r.table_name): r.rows for r in layer_counts(
        spark, {fixed.RAW: {"orders": df}}, {fixed.RAW: ("orders", "payments")}).collect()}
    assert out == {(fixed.RAW, "orders"): 3, (fixed.RAW, "payments"): None}


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "receita_total" in df.columns
    assert set(core.QUERIES) <= set(E.queries()) and set(core.QUERIES) <= set(E.oracle_sql())


FAST = ["mart_sales_by_category", "mart_customer_summary", "mart_product_rating", "conform_order_items",
        "dq_conformed_suite", "money_cast", "orphan_keys", "date_try_cast", "dq_referential", "csv_roundtrip_products",
        "status_revenue", "top_customers", "stream_landing_orders", "layer_row_counts", "gated_quality_report",
        "gated_counts", "csv_keep_empty", "rewritten_preview", "dq_missing_table", "dq_failures"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_at_small_scale(spark, name):
    import __spark_entry__ as E
    con = duckdb.connect()
    for v in ("nation", "customer", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SF_SMALL}/{v}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = sorted((tuple(row[names.index(c)] for c in cols) for row in cur.fetchall()), key=repr)
    assert sorted(names) == cols
    assert got == want


def test_gated_run_in_catalog_mode(spark):
    tables = raw_shop(spark, orders=30, dirty=False)
    store = LayerStore(spark)                      # session catalog: bronze / silver / gold databases
    result = run_layers(spark, tables, store, at="2025-01-01 12:00:00")
    assert result.ok and result.rows[fixed.CONFORMED]["orders"] == 30
    assert spark.catalog.tableExists("gold.resumo_clientes")
    assert spark.table("silver.order_items").count() == result.rows[fixed.CONFORMED]["order_items"]
    again = run_layers(spark, tables, store, at="2025-01-01 12:00:00")   # full refresh, same schema
    assert again.rows == result.rows


def test_check_materialized_equals_lazy_check(spark, tmp_uri):
    tables = raw_shop(spark)
    conformed = conform_layer(land_raw(tables, "2025-01-01 12:00:00"))
    lazy = Q.check_layer(spark, fixed.CONFORMED, conformed)
    written = check_materialized(spark, fixed.CONFORMED, conformed, LayerStore(spark, tmp_uri + "/checked"))
    assert sorted(map(tuple, written.frame.collect())) == sorted(map(tuple, lazy.frame.collect()))
    assert [r.check for r in written.failed("WARN")] == [r.check for r in lazy.failed("WARN")]


def test_ungated_run_builds_every_layer(spark, tmp_uri):
    tables = raw_shop(spark, dirty=False)
    bad = dict(tables)
    bad["reviews"] = tables["reviews"].withColumn("rating", F.lit("9"))
    store = LayerStore(spark, tmp_uri + "/lake")
    result = run_layers(spark, bad, store, gate=False)
    assert result.blocked_at == fixed.CONFORMED and set(result.reports) == set(fixed.LAYERS)
    assert store.exists(fixed.MART, "resumo_clientes")


def test_run_counts_equal_layer_counts(spark, tmp_uri):
    tables = raw_shop(spark)
    result = run_layers(spark, tables, LayerStore(spark, tmp_uri + "/lake"), at="2025-01-01 12:00:00")
    raw = land_raw(tables, "2025-01-01 12:00:00")
    conformed = conform_layer(raw)
    recount = layer_counts(spark, {fixed.RAW: raw, fixed.CONFORMED: conformed, fixed.MART: mart_layer(conformed)})
    assert sorted(map(tuple, result.counts(spark).collect())) == sorted(map(tuple, recount.collect()))
