"""Command line: one job per layer, exit code 1 when a check fails an ERROR, 2 when a step cannot run."""

from shop import raw_shop, write_shop
from strata import fixed
from strata.__main__ import main
from strata.sources.store import LayerStore


def test_layer_commands_and_exit_codes(spark, tmp_uri, capsys):
    csv, lake = tmp_uri + "/csv", tmp_uri + "/lake"
    write_shop(raw_shop(spark), csv)
    assert main(["land", "--source", csv, "--lake", lake]) == 0
    assert main(["check", "bronze", "--lake", lake]) == 0
    assert main(["conform", "--lake", lake]) == 0
    assert main(["check", "silver", "--lake", lake]) == 0          # only WARNs
    assert main(["marts", "--lake", lake, "--preview", "2"]) == 0
    assert main(["check", "gold", "--lake", lake]) == 0
    out = capsys.readouterr().out
    assert "bronze.orders: 45 rows, 6 columns" in out and "DQ layer=silver checks=45" in out
    assert "gold.resumo_clientes\n" in out and "total_gasto" in out          # preview of the written mart
    assert LayerStore(spark, lake).read(fixed.MART, "resumo_clientes").count() > 0
    assert main(["land", "--source", csv, "--lake", lake]) == 0               # a second full refresh
    assert LayerStore(spark, lake).read(fixed.RAW, "orders").count() == 45


def test_steps_out_of_order_name_what_is_missing(spark, tmp_uri, capsys):
    assert main(["check", "silver", "--lake", tmp_uri + "/empty"]) == 1
    assert main(["conform", "--lake", tmp_uri + "/empty"]) == 2
    assert "bronze.orders" in capsys.readouterr().err
    assert main(["marts", "--lake", tmp_uri + "/empty"]) == 2
    assert "silver.customers" in capsys.readouterr().err


def test_steps_refuse_a_catalog_that_ends_with_the_process(spark, tmp_uri, capsys):
    assert main(["land", "--source", tmp_uri + "/csv"]) == 2
    assert "--lake" in capsys.readouterr().err


def test_run_command(spark, tmp_uri):
    write_shop(raw_shop(spark, dirty=False), tmp_uri + "/csv")
    assert main(["run", "--source", tmp_uri + "/csv", "--lake", tmp_uri + "/lake"]) == 0


def test_conform_options_from_the_command_line(spark, tmp_uri):
    csv, lake = tmp_uri + "/csv", tmp_uri + "/lake"
    write_shop(raw_shop(spark), csv)
    assert main(["land", "--source", csv, "--lake", lake]) == 0
    assert main(["conform", "--lake", lake]) == 0
    assert LayerStore(spark, lake).read(fixed.CONFORMED, "reviews").filter("comment = ''").count() == 0
    assert main(["conform", "--lake", lake, "--blank-as-missing", "--all-whitespace", "--normalize-first"]) == 0
    orders = LayerStore(spark, lake).read(fixed.CONFORMED, "orders")
    assert orders.count() == orders.select("order_id").distinct().count()


def test_a_finished_run_is_not_run_again(spark, tmp_uri, capsys):
    write_shop(raw_shop(spark, dirty=False), tmp_uri + "/csv")
    run = ["run", "--source", tmp_uri + "/csv", "--lake", tmp_uri + "/lake", "--run-id", "monday"]
    assert main(run) == 0
    assert main(run) == 2 and "run monday is finished" in capsys.readouterr().err
