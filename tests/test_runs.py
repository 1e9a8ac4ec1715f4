"""Two writers of one table, and runs that go on after a failure."""

import threading

import pytest
from pyspark.sql import functions as F

from shop import raw_shop
from strata import fixed
from strata.operators import marts as M
from strata.operators import quality as Q
from strata.plans.layers import run_layers
from strata.sources import manifest
from strata.sources.paths import names, put_if_absent, read_text
from strata.sources.store import LayerStore, MissingTableError, WriteConflictError

AT = "2025-01-01 12:00:00"


def commits(store, layer, table):
    return [n for n in names(store.spark, f"{store.root(layer, table)}/_commits") if n.isdigit()]


@pytest.mark.parametrize("catalog", [False, True])
def test_the_second_of_two_writers_raises(spark, tmp_uri, monkeypatch, catalog):
    store = LayerStore(spark, prefix="two_", databases=tmp_uri + "/db") if catalog else LayerStore(spark, tmp_uri + "/lake")
    store.write(spark.range(3), "silver", "t")

    import strata.sources.store as S

    plain = S.put_if_absent

    def overtaken(s, path, text):
        monkeypatch.setattr(S, "put_if_absent", plain)
        store.write(spark.range(5), "silver", "t")          # another writer, between this one's data and its commit
        return plain(s, path, text)

    monkeypatch.setattr(S, "put_if_absent", overtaken)
    with pytest.raises(WriteConflictError, match="silver.t|silver/t"):
        store.write(spark.range(7), "silver", "t")
    assert store.read("silver", "t").count() == 5
    folders = [n for n in names(spark, store.root("silver", "t")) if n.startswith("data-")]
    assert len(folders) == len(commits(store, "silver", "t")) == 2      # nothing of the loser stays
    assert store.write(spark.range(9), "silver", "t") == 9 and store.read("silver", "t").count() == 9


def test_writers_at_once_leave_one_whole_version_each(spark, tmp_uri):
    store = LayerStore(spark, tmp_uri + "/lake")
    store.write(spark.range(1), "silver", "t")
    done, start = [], threading.Barrier(4)

    def write(n):
        start.wait()
        try:
            done.append(store.write(spark.range(n), "silver", "t"))
        except WriteConflictError:
            done.append(None)

    threads = [threading.Thread(target=write, args=(n,)) for n in (10, 20, 30, 40)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    won = [n for n in done if n]
    assert len(done) == 4 and won and store.read("silver", "t").count() in won
    assert len(commits(store, "silver", "t")) <= 1 + len(won)


def test_put_if_absent(spark, tmp_uri):
    results = []
    threads = [threading.Thread(target=lambda i=i: results.append((put_if_absent(spark, tmp_uri + "/a/b", str(i)), str(i)))) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    won = [text for ok, text in results if ok]
    assert len(won) == 1 and read_text(spark, tmp_uri + "/a/b") == won[0] and names(spark, tmp_uri + "/a") == ["b"]
    assert read_text(spark, tmp_uri + "/none") == ""


def test_a_commit_without_content_is_none(spark, tmp_uri):
    store = LayerStore(spark, tmp_uri + "/lake")
    store.write(spark.range(4), "silver", "t")
    put_if_absent(spark, tmp_uri + "/lake/silver/t/_commits/000000000001", "")     # a writer died there
    assert store.read("silver", "t").count() == 4
    assert store.write(spark.range(6), "silver", "t") == 6 and store.read("silver", "t").count() == 6


def test_a_failed_run_goes_on_while_another_writes(spark, tmp_uri, monkeypatch):
    tables = raw_shop(spark, orders=30, dirty=False)
    store = LayerStore(spark, tmp_uri + "/lake")
    plain = M.build_marts
    monkeypatch.setattr(M, "build_marts", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        run_layers(spark, tables, store, at=AT, run_id="one")
    monkeypatch.setattr(M, "build_marts", plain)

    # other runs land and conform other data, twice: versions of the first would be removed
    other = dict(tables, orders=tables["orders"].limit(0), reviews=tables["reviews"].limit(0), payments=tables["payments"].limit(0), order_items=tables["order_items"].limit(0))
    for _ in range(2):
        run_layers(spark, other, store, at=AT, gate=False)
    before = {(layer, t): commits(store, layer, t) for layer in (fixed.RAW, fixed.CONFORMED) for t in fixed.TABLES}
    checks = []
    monkeypatch.setattr(Q, "check_layer", lambda s, layer, *a, real=Q.check_layer, **k: checks.append(layer) or real(s, layer, *a, **k))

    result = run_layers(spark, tables, store, at=AT, run_id="one")
    assert result.ok and checks == [fixed.MART]
    assert {k: commits(store, *k) for k in before} == before                # neither raw nor conformed written again
    want = run_layers(spark, tables, LayerStore(spark, tmp_uri + "/plain"), at=AT)
    assert result.rows == want.rows
    for t in fixed.MART_TABLES:
        mine, theirs = (sorted(map(str, s.read(fixed.MART, t).collect())) for s in (store, LayerStore(spark, tmp_uri + "/plain")))
        assert mine == theirs
    assert [tuple(r) for r in result.report().orderBy("layer", "seq").collect()] == [tuple(r) for r in want.report().orderBy("layer", "seq").collect()]

    # finished: nothing is pinned, and the id is used up until it is forgotten
    assert manifest.pinned(spark, store.runs_uri()) == set() and manifest.unfinished(spark, store.runs_uri()) == []
    with pytest.raises(manifest.RunFinishedError):
        run_layers(spark, tables, store, at=AT, run_id="one")


def test_a_run_goes_on_within_a_layer(spark, tmp_uri, monkeypatch):
    tables = raw_shop(spark, orders=10, dirty=False)
    store = LayerStore(spark, tmp_uri + "/lake")
    plain = LayerStore.write_version

    def failing(self, df, layer, table, *a, **k):
        if table == "reviews":
            raise OSError("lost")
        return plain(self, df, layer, table, *a, **k)

    monkeypatch.setattr(LayerStore, "write_version", failing)
    with pytest.raises(OSError):
        run_layers(spark, tables, store, at=AT, run_id="r", until=fixed.RAW)
    monkeypatch.setattr(LayerStore, "write_version", plain)
    run_layers(spark, tables, store, at=AT, run_id="r", until=fixed.RAW)
    assert {t: len(commits(store, fixed.RAW, t)) for t in fixed.TABLES} == dict.fromkeys(fixed.TABLES, 1)
    assert manifest.unfinished(spark, store.runs_uri()) == ["r"]


def test_a_failed_check_is_looked_at_again(spark, tmp_uri):
    tables = raw_shop(spark, orders=10, dirty=False)
    bad = dict(tables, reviews=tables["reviews"].withColumn("rating", F.lit("9")))
    store = LayerStore(spark, tmp_uri + "/lake")
    for _ in range(2):
        with pytest.raises(Q.QualityGateError):
            run_layers(spark, bad, store, at=AT, run_id="r")
    assert len(commits(store, fixed.CONFORMED, "reviews")) == 1


def test_pinned_versions_and_run_ids(spark, tmp_uri):
    store = LayerStore(spark, tmp_uri + "/lake")
    version, _ = store.write_version(spark.range(2), "silver", "t")
    run = manifest.RunManifest(spark, store.runs_uri(), "keeps")
    assert run.put("silver.t", {"version": version, "observed": {}})["version"] == version
    assert run.put("silver.t", {"version": "other"})["version"] == version          # the first record stands
    for n in (3, 4, 5):
        store.write(spark.range(n), "silver", "t")
    assert store.read("silver", "t", version=version).count() == 2
    run.finish()
    store.write(spark.range(6), "silver", "t")
    with pytest.raises(MissingTableError, match=version):
        store.read("silver", "t", version=version)
    run.forget()
    assert manifest.RunManifest(spark, store.runs_uri(), "keeps").get("silver.t") is None
    for wrong in ("", "a/b", ".x", "_x"):
        with pytest.raises(ValueError):
            manifest.RunManifest(spark, store.runs_uri(), wrong)
    with pytest.raises(ValueError, match="format"):
        run_layers(spark, {}, LayerStore(spark, tmp_uri, "delta"), run_id="x")


def test_a_run_in_the_catalog(spark, tmp_uri):
    tables = raw_shop(spark, orders=10, dirty=False)
    store = LayerStore(spark, prefix="runs_", databases=tmp_uri + "/db")
    run_layers(spark, tables, store, at=AT, run_id="c", until=fixed.CONFORMED)
    run_layers(spark, dict(tables, order_items=tables["order_items"].limit(0)), store, at=AT, gate=False, until=fixed.CONFORMED)
    result = run_layers(spark, tables, store, at=AT, run_id="c")
    assert result.ok and spark.table("runs_gold.vendas_por_categoria").count() > 0
