"""Registered queries over the star-schema test tables.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
work grows with the input tables. Layer queries run the raw rendering of
the given tables (``strata.sources.star``) through the conformed and mart
layers; operator queries apply one operator to given columns.

``present`` is the last step of every query: money to double, integers to
bigint, dates and timestamps to ISO text, so another engine's result can be
compared value for value.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fixed
from strata.functions import columns as C
from strata.operators import marts as M
from strata.operators import quality as Q
from strata.operators.tables import dedup_by_key, distinct_projection, move_to_end, with_audit
from strata.plans.layers import (
    COUNTS_SCHEMA,
    Demand,
    check_materialized,
    conform_layer,
    materialize,
    land_raw,
    layer_counts,
    mart_layer,
    run_layers,
)
from strata.session import scratch_path
from strata.sources.files import read_checked_csv, read_driver_table, read_raw_csv, write_csv
from strata.sources.star import LANDED_AT, raw_orders, raw_products, raw_tables, source_tables
from strata.sources.store import LayerStore, SchemaMismatchError
from strata.streaming.landing import land_folder_now

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def present(df: DataFrame) -> DataFrame:
    """Engine-neutral value types for comparison (see the module docstring)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TS_FORMAT)
        out.append(c.alias(f.name))
    return df.select(*out)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_driver_table(spark, sf_dir, name)


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return raw_tables(spark, sf_dir, LANDED_AT)


def conformed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return conform_layer(raw(spark, sf_dir))


def marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return mart_layer(conformed(spark, sf_dir))


# -- layer queries ---------------------------------------------------------------

def _conform(table: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(conformed(spark, sf_dir)[table])
    q.__name__ = f"conform_{table}"
    return q


def mart_sales_by_category(spark, sf_dir):
    return present(M.sales_by_category(conformed(spark, sf_dir)))


def mart_orders_by_status(spark, sf_dir):
    return present(M.orders_by_status(conformed(spark, sf_dir)))


def mart_product_rating(spark, sf_dir):
    return present(M.product_rating(conformed(spark, sf_dir)))


def mart_customer_summary(spark, sf_dir):
    return present(M.customer_summary(conformed(spark, sf_dir)))


def top_customers(spark, sf_dir):
    return present(M.top_customers(M.customer_summary(conformed(spark, sf_dir), sort=False), 10))


def status_revenue(spark, sf_dir):
    return present(M.status_revenue(M.orders_by_status(conformed(spark, sf_dir), sort=False)))


def layer_row_counts(spark, sf_dir):
    """Conformed tables that marts read too are written once, with the columns read; their counts are observed."""
    r = raw(spark, sf_dir)
    demand = Demand().marts()
    for t in fixed.TABLES:
        demand.add(t, fixed.NATURAL_KEYS[t])
    c, written = materialize(spark, fixed.CONFORMED, conform_layer(r), demand=demand)
    rows = [(fixed.CONFORMED, t, written[t]["rows"]) for t in written]
    lazy = {fixed.RAW: r, fixed.CONFORMED: c, fixed.MART: mart_layer(c)}
    expected = {fixed.RAW: fixed.TABLES, fixed.CONFORMED: [t for t in c if t not in written], fixed.MART: fixed.MART_TABLES}
    return present(layer_counts(spark, lazy, expected).unionByName(spark.createDataFrame(rows, COUNTS_SCHEMA)))


def ranked_marts(spark, sf_dir):
    """Every row of every mart with its place in the mart's published order.

    The marts do not need each other: their jobs run at the same time, and one takes the cores another leaves idle.
    """
    c, _ = materialize(spark, fixed.CONFORMED, conformed(spark, sf_dir), demand=Demand().marts())
    marts_of_run = mart_layer(c)

    def ranked(mart: str) -> DataFrame:
        metric, keys = M.ORDER[mart]
        shown = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys])
        return M.ranked_mart(marts_of_run[mart], mart).select(F.lit(mart).alias("mart"), "rank", shown.alias("row_key"), F.col(metric).cast("double").alias("metric"))

    with ThreadPoolExecutor(max_workers=len(marts_of_run)) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(ranked), mart) for mart in marts_of_run]
        return present(reduce(lambda a, b: a.unionByName(b), [job.result() for job in jobs]))


# -- operator queries --------------------------------------------------------------

def strip_prefix(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return present(c.select("c_custkey", C.strip_prefix("c_name", "Customer#").alias("customer_ref")))


def text_normalise(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    padded = F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))
    return present(c.select("c_custkey", C.trim_lower(padded).alias("segment")))


def utc_to_zone(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return present(e.select("event_id", C.utc_to_zone("ts", fixed.LOCAL_ZONE).alias("ts_local")))


def money_cast(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    three_dp = F.concat(price, F.col("l_linenumber").cast("string"))       # HALF_UP rounding
    too_big = F.concat(price, F.lit("000"))                                 # over decimal(10,2) -> NULL
    return present(li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        C.to_money(three_dp).alias("amount_rounded"),
        C.to_money(too_big).alias("amount_overflow"),
    ))


def int_try_cast(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    text = F.substr(F.col("o_orderpriority"), F.lit(1), (F.col("o_orderkey") % 2 + 1).cast("int"))
    # the parsed int holds NULLs; shown as double so both engines hand pandas the same dtype
    return present(o.select("o_orderkey", text.alias("rating_text"), C.to_int(text).cast("double").alias("rating")))


def date_try_cast(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    month = F.month("o_orderdate") + F.substring("o_orderpriority", 1, 1).cast("int")
    text = F.concat_ws(
        "-",
        F.year("o_orderdate").cast("string"),
        F.lpad(month.cast("string"), 2, "0"),
        F.lpad(F.dayofmonth("o_orderdate").cast("string"), 2, "0"),
    )
    return present(o.select("o_orderkey", text.alias("date_text"), C.to_date(text).alias("parsed")))


def _segment_with_gaps():
    return (
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
        .when(F.col("c_acctbal") < 1000, F.lit("   "))
        .when(F.col("c_acctbal") < 2000, F.lit(""))
        .otherwise(F.col("c_mktsegment"))
    )


def now_in_zone(spark, sf_dir):
    """How far the local clock is from UTC at the moment of the query, on every event."""
    e = _t(spark, sf_dir, "events")
    local, utc = C.now_in_zone(fixed.LOCAL_ZONE), C.now_in_zone("UTC")
    return present(e.select("event_id", F.timestamp_diff("MINUTE", utc, local).alias("minutes_ahead")))


def null_default(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return present(c.select("c_custkey", C.default_if_null(_segment_with_gaps(), fixed.UNKNOWN).alias("segment")))


def blank_default(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return present(c.select("c_custkey", C.default_if_blank(_segment_with_gaps(), fixed.UNKNOWN).alias("segment")))


def sentinel_or_strip(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    ref = F.when(F.col("o_orderstatus") != "P", F.format_string("C%05d", F.col("o_custkey")))
    return present(o.select("o_orderkey", C.strip_or_sentinel(ref, "C", fixed.UNKNOWN).alias("customer_id")))


def dedup_lineitem(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return present(dedup_by_key(li, ["l_orderkey", "l_linenumber"]))


def distinct_pairs(spark, sf_dir):
    return present(distinct_projection(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"]))


def column_to_end(spark, sf_dir):
    return present(move_to_end(_t(spark, sf_dir, "lineitem"), "l_orderkey"))


def audit_column(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return present(move_to_end(with_audit(o, LANDED_AT), "o_orderkey"))


def orphan_orders(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    li = _t(spark, sf_dir, "lineitem")
    return present(Q.orphan_keys(o, "o_orderkey", li, "l_orderkey", exclude=[0, 1]))


# -- sources and sinks ---------------------------------------------------------------

def _csv_roundtrip(table: str, source: str, render):
    """Render ``source`` as the raw ``table``, write it as CSV, read it back, land it."""
    def q(spark, sf_dir):
        folder = scratch_path(spark, f"csv-{table}")
        write_csv(render(_t(spark, sf_dir, source)), folder)
        back = read_raw_csv(spark, folder, fixed.RAW_COLUMNS[table])
        return present(land_raw({table: back}, LANDED_AT)[table])
    q.__name__ = f"csv_roundtrip_{table}"
    return q


def stream_landing_orders(spark, sf_dir):
    """Raw orders files landed in two steps, more files arriving in between, and read back."""
    folder, target = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-raw")
    orders = _t(spark, sf_dir, "orders")
    for rest in (0, 1):
        write_csv(raw_orders(orders.filter(F.col("o_orderkey") % 2 == rest)), folder, mode="append")
        landed = land_folder_now(spark, folder, "orders", target)
    return present(landed.select(*fixed.RAW_COLUMNS["orders"],
                                 F.col(fixed.AUDIT_COLUMN).isNotNull().alias("stamped")))


def csv_keep_empty(spark, sf_dir):
    """Raw customers through CSV, empty fields kept as empty text (they are written without quotes)."""
    folder = scratch_path(spark, "csv-empty")
    write_csv(raw_tables(spark, sf_dir, None)["customers"].select(*fixed.RAW_COLUMNS["customers"]), folder)
    return present(read_raw_csv(spark, folder, fixed.RAW_COLUMNS["customers"], keep_empty=True))


def csv_line_breaks(spark, sf_dir):
    """Whole texts with line breaks and quotes through CSV; records are found across lines and splits."""
    folder = scratch_path(spark, "csv-texts")
    texts = _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "source")
    write_csv(texts, folder)
    return present(read_raw_csv(spark, folder, ["doc_id", "text", "source"]))


def csv_rejected(spark, sf_dir):
    """Orders as lines of text, some with a field too many or too few: the rows, and the records rejected."""
    folder = scratch_path(spark, "csv-rejected")
    o = _t(spark, sf_dir, "orders")
    key, note = F.col("o_orderkey").cast("string"), F.concat(F.lit('"'), "o_orderpriority", F.lit('\nsays ""'), "o_orderstatus", F.lit('"""'))
    line = (F.when(F.col("o_orderkey") % 11 == 3, F.concat_ws(",", key, note, F.lit("one more")))
            .when(F.col("o_orderkey") % 13 == 5, key).otherwise(F.concat_ws(",", key, note)))
    o.select(line.alias("value")).write.option("lineSep", "\n").text(folder)
    rows, rejected = read_checked_csv(spark, folder, ["order", "note"], header=False)
    both = rows.select(F.lit("row").alias("kind"), "order", "note")
    return present(both.unionByName(rejected.select(F.lit("rejected").alias("kind"), F.substring_index("record", ",", 1).alias("order"), F.col("record").alias("note"))))


def csv_missing_file(spark, sf_dir):
    """Raw tables as CSV, two of them never written: found or not, and the rows read."""
    folder = scratch_path(spark, "csv-some")
    sources = source_tables(spark, sf_dir)
    for t in fixed.TABLES[:4]:
        write_csv(sources[t], f"{folder}/{t}.csv")
    rows = []
    for t in fixed.TABLES:
        try:
            rows.append(read_raw_csv(spark, f"{folder}/{t}.csv", fixed.RAW_COLUMNS[t]).agg(F.lit(t).alias("table_name"), F.lit(True).alias("found"), F.count("*").alias("rows")))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows.append(spark.createDataFrame([(t, False, -1)], "table_name string, found boolean, rows long"))
    return present(reduce(lambda a, b: a.unionByName(b), rows))


def strict_overwrite(spark, sf_dir):
    """Raw products, then an overwrite of another schema that has to be refused, then one of the same schema."""
    store = LayerStore(spark, scratch_path(spark, "strict"))
    products = raw_products(_t(spark, sf_dir, "part"))
    store.write(products, fixed.RAW, "products", schema_may_change=False)
    refused = False
    try:
        store.write(products.withColumn("price", C.to_money("price")), fixed.RAW, "products", schema_may_change=False)
    except SchemaMismatchError:
        refused = True
    store.write(store.read(fixed.RAW, "products").filter(F.col("product_name").isNotNull()), fixed.RAW, "products", schema_may_change=False)
    return present(store.read(fixed.RAW, "products").withColumn("refused", F.lit(refused)))


def relocated_store(spark, sf_dir):
    """One table in two locations: rows of the first are read from there and written to the second."""
    first, second = (LayerStore(spark, scratch_path(spark, name)) for name in ("store-a", "store-b"))
    first.write(raw_orders(_t(spark, sf_dir, "orders")), fixed.RAW, "orders")
    second.write(first.read(fixed.RAW, "orders").filter(F.lower(F.trim("status")) == "delivered"), fixed.RAW, "orders")
    first.write(first.read(fixed.RAW, "orders").filter(F.lower(F.trim("status")) != "delivered"), fixed.RAW, "orders")
    tables = [s.read(fixed.RAW, "orders").withColumn("location", F.lit(n)) for n, s in (("first", first), ("second", second))]
    return present(tables[0].unionByName(tables[1]))


def rewritten_preview(spark, sf_dir):
    """A table written, rewritten from itself with another schema, and its first rows by key."""
    store = LayerStore(spark, scratch_path(spark, "rewritten"))
    store.write(raw_products(_t(spark, sf_dir, "part")), fixed.RAW, "products", schema_may_change=False)
    typed = store.read(fixed.RAW, "products").select("product_id", "product_name", C.to_money("price").alias("price"))
    store.write(typed, fixed.RAW, "products")
    return present(store.preview(fixed.RAW, "products", 25, ["product_id", "product_name"]))


def resumed_sales_by_category(spark, sf_dir):
    """A run that stops after its conformed layer, another run over the same store, and the first one taken up again.

    The second run lands other rows (no order items); the first goes on from
    its own versions.
    """
    store = LayerStore(spark, scratch_path(spark, "lake"))
    tables = source_tables(spark, sf_dir)
    run_layers(spark, tables, store, at=LANDED_AT, gate=False, run_id="first", until=fixed.CONFORMED)
    other = tables | {"order_items": tables["order_items"].limit(0)}
    run_layers(spark, other, store, at=LANDED_AT, gate=False, run_id="second", until=fixed.CONFORMED)
    run_layers(spark, tables, store, at=LANDED_AT, gate=False, run_id="first")
    return present(store.read(fixed.MART, "vendas_por_categoria"))


def catalog_customer_summary(spark, sf_dir):
    """Landed, conformed and read as ``layer.table`` of the session's catalog, in databases of this call."""
    name = scratch_path(spark, "catalog")
    store = LayerStore(spark, prefix=f"c{name.rsplit('-', 1)[1]}_", databases=name)
    run_layers(spark, source_tables(spark, sf_dir), store, at=LANDED_AT, gate=False)
    return present(spark.table(store.location(fixed.MART, "resumo_clientes")))


def _run(spark, sf_dir, gate: bool):
    """Land, conform and build marts with a quality check after each layer.

    Every layer is written below the shared folder and read back, which cuts
    the lineage between layers. The dirt of these tables fails ERROR checks
    of the conformed layer: a gated run stops there and builds no marts.
    """
    store = LayerStore(spark, scratch_path(spark, "lake"))
    return store, run_layers(spark, source_tables(spark, sf_dir), store, at=LANDED_AT, stop_on_error=True, gate=gate)


def gated_sales_by_category(spark, sf_dir):
    store, _ = _run(spark, sf_dir, gate=False)
    return present(store.read(fixed.MART, "vendas_por_categoria"))


def gated_quality_report(spark, sf_dir):
    _, result = _run(spark, sf_dir, gate=True)
    return present(result.report())


def gated_counts(spark, sf_dir):
    """Rows per layer and table of the gated run; NULL for the marts it did not build (shown as -1)."""
    _, result = _run(spark, sf_dir, gate=True)
    return present(result.counts(spark).fillna(-1))


# -- quality queries --------------------------------------------------------------

SOURCE = "source"


def _report(spark, frames, suite, layer=SOURCE, qualify=False):
    return present(Q.check_tables(spark, frames, suite, layer, qualify=qualify))


def dq_not_empty(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    frames = {"lineitem": li, "negative_lines": li.filter(F.col("l_quantity") < 0)}
    suite = [("lineitem", Q.not_empty()), ("lineitem", Q.columns_exist("l_orderkey", "l_shipdate")),
             ("negative_lines", Q.not_empty()), ("negative_lines", Q.columns_exist("l_receiptdate"))]
    return _report(spark, frames, suite)


def dq_unique(spark, sf_dir):
    frames = {"lineitem": _t(spark, sf_dir, "lineitem"), "orders": _t(spark, sf_dir, "orders")}
    suite = [("lineitem", Q.unique("l_orderkey", "l_linenumber")), ("orders", Q.unique("o_orderkey"))]
    return _report(spark, frames, suite)


def dq_not_null(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").withColumn(
        "c_segment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))
    suite = [("customer", r) for r in Q.not_null("c_name", "c_segment")]
    suite += [("customer", r) for r in Q.not_null("c_segment", severity=fixed.WARN)]
    return _report(spark, {"customer": c}, suite)


def dq_range(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("rating", F.substring("o_orderpriority", 1, 1).cast("int"))
    suite = [("orders", Q.in_range("rating", 1, 5)), ("orders", Q.in_range("rating", 1, 4)),
             ("orders", Q.in_range("o_totalprice", 1000, 400000, fixed.WARN))]
    return _report(spark, {"orders": o}, suite)


def dq_non_negative(spark, sf_dir):
    frames = {"customer": _t(spark, sf_dir, "customer"), "orders": _t(spark, sf_dir, "orders")}
    suite = [("customer", Q.non_negative("c_acctbal")), ("orders", Q.non_negative("o_totalprice")),
             ("customer", Q.non_negative("c_acctbal", fixed.ERROR))]
    return _report(spark, frames, suite)


def dq_in_set(spark, sf_dir):
    frames = {"orders": _t(spark, sf_dir, "orders")}
    suite = [("orders", Q.in_set("o_orderstatus", ["F", "O", "P"])),
             ("orders", Q.in_set("o_orderstatus", ["F", "O"])),
             ("orders", Q.in_set("o_orderstatus", [], fixed.WARN))]
    return _report(spark, frames, suite)


def dq_referential(spark, sf_dir):
    frames = {"lineitem": _t(spark, sf_dir, "lineitem"), "orders": _t(spark, sf_dir, "orders"),
              "part": _t(spark, sf_dir, "part")}
    suite = [("lineitem", Q.referential("l_orderkey", "orders", "o_orderkey")),
             ("lineitem", Q.referential("l_partkey", "part", "p_partkey")),
             ("orders", Q.referential("o_orderkey", "lineitem", "l_orderkey")),
             ("orders", Q.referential("o_orderkey", "lineitem", "l_orderkey", exclude=[0, 1],
                                      severity=fixed.WARN))]
    return _report(spark, frames, suite)


def dq_missing_table(spark, sf_dir):
    """The conformed suite without its reviews and products tables."""
    frames = {t: df for t, df in conformed(spark, sf_dir).items() if t not in ("reviews", "products")}
    return present(check_materialized(spark, fixed.CONFORMED, frames).frame)


# A table that several check passes read (the conformed tables: counters,
# uniqueness, references) is written once below the shared folder first, its
# counters observed during the write; single-pass tables are checked lazily.

def dq_raw_suite(spark, sf_dir):
    return present(check_materialized(spark, fixed.RAW, raw(spark, sf_dir)).frame)


def dq_conformed_suite(spark, sf_dir):
    return present(check_materialized(spark, fixed.CONFORMED, conformed(spark, sf_dir)).frame)


def dq_mart_suite(spark, sf_dir):
    """The marts share conformed tables, which are written once first, with the columns that marts read."""
    c, _ = materialize(spark, fixed.CONFORMED, conformed(spark, sf_dir), demand=Demand().marts())
    return present(check_materialized(spark, fixed.MART, mart_layer(c)).frame)


def _all_reports(spark, sf_dir) -> DataFrame:
    """All three suites; marts are built from the written conformed tables."""
    r = raw(spark, sf_dir)
    demand = Demand().suite(Q.SUITES[fixed.CONFORMED]()).marts()
    c, observed = materialize(spark, fixed.CONFORMED, conform_layer(r), demand=demand)
    reports = [check_materialized(spark, fixed.RAW, r).frame,
               Q.check_layer(spark, fixed.CONFORMED, c, measured=observed).frame,
               check_materialized(spark, fixed.MART, mart_layer(c)).frame]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


def dq_summary(spark, sf_dir):
    return present(Q.summarize(_all_reports(spark, sf_dir)))


def dq_failures(spark, sf_dir):
    return present(Q.failures(_all_reports(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "mart_sales_by_category": mart_sales_by_category,
    "mart_orders_by_status": mart_orders_by_status,
    "mart_product_rating": mart_product_rating,
    "mart_customer_summary": mart_customer_summary,
    "top_customers": top_customers,
    "status_revenue": status_revenue,
    "ranked_marts": ranked_marts,
    **{f"conform_{t}": _conform(t) for t in fixed.TABLES},
    "layer_row_counts": layer_row_counts,
    "strip_prefix": strip_prefix,
    "text_normalise": text_normalise,
    "utc_to_zone": utc_to_zone,
    "now_in_zone": now_in_zone,
    "money_cast": money_cast,
    "int_try_cast": int_try_cast,
    "date_try_cast": date_try_cast,
    "null_default": null_default,
    "blank_default": blank_default,
    "sentinel_or_strip": sentinel_or_strip,
    "dedup_by_key": dedup_lineitem,
    "distinct_projection": distinct_pairs,
    "column_to_end": column_to_end,
    "audit_column": audit_column,
    "orphan_keys": orphan_orders,
    "csv_roundtrip_orders": _csv_roundtrip("orders", "orders", raw_orders),
    "csv_roundtrip_products": _csv_roundtrip("products", "part", raw_products),
    "stream_landing_orders": stream_landing_orders,
    "gated_sales_by_category": gated_sales_by_category,
    "gated_quality_report": gated_quality_report,
    "gated_counts": gated_counts,
    "csv_keep_empty": csv_keep_empty,
    "csv_line_breaks": csv_line_breaks,
    "csv_missing_file": csv_missing_file,
    "strict_overwrite": strict_overwrite,
    "relocated_store": relocated_store,
    "csv_rejected": csv_rejected,
    "rewritten_preview": rewritten_preview,
    "resumed_sales_by_category": resumed_sales_by_category,
    "catalog_customer_summary": catalog_customer_summary,
    "dq_missing_table": dq_missing_table,
    "dq_not_empty": dq_not_empty,
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_range": dq_range,
    "dq_non_negative": dq_non_negative,
    "dq_in_set": dq_in_set,
    "dq_referential": dq_referential,
    "dq_raw_suite": dq_raw_suite,
    "dq_conformed_suite": dq_conformed_suite,
    "dq_mart_suite": dq_mart_suite,
    "dq_summary": dq_summary,
    "dq_failures": dq_failures,
}
