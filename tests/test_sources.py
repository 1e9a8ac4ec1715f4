"""CSV source/sink (SRC1, SRC2, GEN6), layer store (SRC3-6, SNK1-6), streaming landing."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata import fixed
from strata.sources.files import read_driver_table, read_raw_csv, write_csv
from strata.sources.store import LayerStore, SchemaMismatchError, path_exists
from strata.streaming.landing import land_folder_now


def _write_text(path, text):
    path.write_text(text, encoding="utf-8")


def test_csv_reads_all_strings_and_blank_as_null(spark, tmp_path):
    f = tmp_path / "payments.csv"
    _write_text(f, 'payment_id,order_id,payment_type,payment_installments,payment_value\n'
                   'PAY000001,O000001," PIX ",3,1981.3\nPAY000002,,"",  ,10\n')
    df = read_raw_csv(spark, str(f), fixed.RAW_COLUMNS["payments"])
    assert all(t == "string" for _, t in df.dtypes)
    rows = df.orderBy("payment_id").collect()
    assert rows[0].payment_type == " PIX " and rows[0].payment_value == "1981.3"
    # T6: empty (quoted or not) -> NULL, whitespace-only stays
    assert rows[1].order_id is None and rows[1].payment_type is None and rows[1].payment_installments == "  "


def test_csv_keep_empty_option(spark, tmp_path):
    f = tmp_path / "t.csv"
    _write_text(f, 'a,b\n"",x\n')
    df = read_raw_csv(spark, str(f), ["a", "b"], keep_empty=True)
    assert df.first().a == ""
    _write_text(f, 'a,b\n,x\n" ",\n')                     # empty without quotes, the usual case
    assert [tuple(r) for r in read_raw_csv(spark, str(f), ["a", "b"], keep_empty=True).collect()] == [("", "x"), (" ", "")]
    assert [tuple(r) for r in read_raw_csv(spark, str(f), ["a", "b"]).collect()] == [(None, "x"), (" ", None)]


def test_csv_wrong_header_fails(spark, tmp_path):
    f = tmp_path / "t.csv"
    _write_text(f, "a,WRONG\n1,2\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, str(f), ["a", "b"]).collect()


def test_csv_missing_path_raises_before_any_job(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_raw_csv(spark, str(tmp_path / "nope.csv"), ["a"])


def test_csv_write_keeps_padding(spark, tmp_path):
    df = spark.createDataFrame([(" PIX ", None, "")], "a string, b string, c string")
    out = str(tmp_path / "out.csv")
    write_csv(df, out)
    back = read_raw_csv(spark, out, ["a", "b", "c"]).first()
    assert (back.a, back.b, back.c) == (" PIX ", None, None)


def test_store_path_mode_roundtrip_and_observed_count(spark, tmp_uri):
    store = LayerStore(spark, tmp_uri + "/lake")
    df = spark.range(37).select(F.col("id").cast("string").alias("k"))
    assert not store.exists("silver", "t")
    assert store.write(df, "silver", "t") == 37
    assert store.exists("silver", "t") and store.read("silver", "t").count() == 37
    assert store.preview("silver", "t", 5).count() == 5
    frames = store.read_layer("silver", ["t", "absent"])
    assert frames["absent"] is None and frames["t"] is not None


def test_store_strict_overwrite_guards_schema(spark, tmp_uri):
    store = LayerStore(spark, tmp_uri + "/lake")
    store.write(spark.range(3).select(F.col("id").cast("string").alias("k")), "bronze", "t", schema_may_change=False)
    with pytest.raises(SchemaMismatchError):
        store.write(spark.range(3).select(F.col("id").alias("k")), "bronze", "t", schema_may_change=False)
    # a schema change is allowed when declared
    assert store.write(spark.range(2).select(F.col("id").alias("k")), "bronze", "t") == 2
    assert dict(store.read("bronze", "t").dtypes)["k"] == "bigint"


def test_store_catalog_mode(spark):
    store = LayerStore(spark)
    df = spark.range(4).select(F.col("id").alias("k"))
    assert store.write(df, "gold_test", "t") == 4
    assert store.exists("gold_test", "t") and not store.exists("gold_test", "zz")
    assert spark.table("gold_test.t").count() == 4


def test_streaming_landing_lands_each_file_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    header = ",".join(fixed.RAW_COLUMNS["orders"]) + "\n"
    _write_text(src / "a.csv", header + "O000001,C00001,2025-01-01,shipped,10.0\n")
    target = str(tmp_path / "raw")
    first = land_folder_now(spark, str(src), "orders", target)
    assert first.count() == 1 and first.filter(F.col(fixed.AUDIT_COLUMN).isNull()).count() == 0
    _write_text(src / "b.csv", header + "O000002,C00002,2025-01-02,delivered,20.0\n")
    second = land_folder_now(spark, str(src), "orders", target)
    assert sorted(r.order_id for r in second.collect()) == ["O000001", "O000002"]
    assert land_folder_now(spark, str(src), "orders", target).count() == 2


def test_streaming_landing_refuses_a_swapped_header(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _write_text(src / "a.csv", "order_id,total_amount,order_date,status,customer_id\nO1,9,2025-01-01,shipped,C1\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
        land_folder_now(spark, str(src), "orders", str(tmp_path / "raw"))


def test_driver_table_keeps_every_column_and_misses_none(spark, tmp_path):
    at = str(tmp_path)
    spark.range(3).selectExpr("id AS o_orderkey", "'x' AS added").write.parquet(f"{at}/orders.parquet")
    df = read_driver_table(spark, at, "orders")
    assert df.columns == ["o_orderkey", "added"] and df.count() == 3
    with pytest.raises(AnalysisException):
        df.select("o_custkey")
    spark.range(5).write.mode("overwrite").parquet(f"{at}/orders.parquet")
    assert read_driver_table(spark, at, "orders").columns == ["id"]


def test_scratch_folders_are_removed(spark):
    from strata import session

    path = session.scratch_path(spark, "probe")
    spark.range(1).write.parquet(path)
    assert path_exists(spark, path)
    kept, session._scratch = session._scratch, {path: spark}
    session.clear_scratch()
    session._scratch = kept
    assert not path_exists(spark, path)


def test_catalog_overwrite_is_staged(spark):
    # T14: the original refuses (or loses data) when a table is overwritten
    # from itself; a staged write reads the old table before replacing it
    store = LayerStore(spark)
    store.write(spark.range(5).select(F.col("id").alias("k")), "t14_layer", "t")
    assert store.write(store.read("t14_layer", "t").filter("k > 1"), "t14_layer", "t") == 3
    assert sorted(r.k for r in store.read("t14_layer", "t").collect()) == [2, 3, 4]
    bad = spark.range(3).select((F.lit(1) / (F.col("id") - 1)).cast("int").alias("k"))
    with pytest.raises(Exception):
        store.write(bad, "t14_layer", "t")
    assert sorted(r.k for r in store.read("t14_layer", "t").collect()) == [2, 3, 4]
    assert [t.name for t in spark.catalog.listTables("t14_layer")] == ["t"]      # a view over the version
    import os

    versions = [n for n in os.listdir(store.root("t14_layer", "t").removeprefix("file:")) if n.startswith("data-")]
    assert len(versions) == 2                                # the current one and the one before


def test_path_overwrite_is_staged(spark, tmp_uri, tmp_path):
    store = LayerStore(spark, tmp_uri + "/lake")
    store.write(spark.range(5).select(F.col("id").alias("k")), "silver", "t")
    # rewriting a table from itself works: old files are read before the swap
    assert store.write(store.read("silver", "t").filter("k > 1"), "silver", "t") == 3
    assert sorted(r.k for r in store.read("silver", "t").collect()) == [2, 3, 4]
    # a failing job leaves the previous table intact and no version behind
    bad = spark.range(3).select((F.lit(1) / (F.col("id") - 1)).cast("int").alias("k"))   # ANSI: divide by zero
    with pytest.raises(Exception):
        store.write(bad, "silver", "t")
    assert sorted(r.k for r in store.read("silver", "t").collect()) == [2, 3, 4]
    folders = [p.name for p in (tmp_path / "lake" / "silver" / "t").iterdir()]
    assert sum(n.startswith("data-") for n in folders) == 2  # the current version and the one before


def test_a_crash_before_the_commit_leaves_the_old_table(spark, tmp_uri, monkeypatch):
    store = LayerStore(spark, tmp_uri + "/lake")
    store.write(spark.range(5), "silver", "t")
    before = store.read("silver", "t")

    import strata.sources.store as S

    monkeypatch.setattr(S, "put_if_absent", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store._commit_folder(spark.range(9).write.format("parquet"), "silver", "t")   # written, not yet named
    monkeypatch.undo()
    assert store.read("silver", "t").count() == 5
    store.write(spark.range(7), "silver", "t")
    assert store.read("silver", "t").count() == 7 and before.count() == 5             # a reader of the old version goes on


def test_a_folder_of_another_writer_is_read_as_it_is(spark, tmp_uri):
    spark.range(4).write.parquet(tmp_uri + "/lake/silver/t")
    assert LayerStore(spark, tmp_uri + "/lake").read("silver", "t").count() == 4


def test_csv_header_driven_read_is_all_string(spark, tmp_path):
    f = tmp_path / "t.csv"
    _write_text(f, "order_id,total_amount,order_date\nO000001,10.5,2025-01-01\n")
    df = read_raw_csv(spark, str(f))
    assert df.dtypes == [("order_id", "string"), ("total_amount", "string"), ("order_date", "string")]
    assert tuple(df.first()) == ("O000001", "10.5", "2025-01-01")
