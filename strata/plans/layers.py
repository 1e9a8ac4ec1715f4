"""Layer jobs: land raw, conform, build marts, check, and the gated run.

Each job takes a dict of DataFrames (or a ``LayerStore``) and returns a
dict; writing a layer and reading it back is what cuts lineage between
layers, so a lost executor recomputes at most one layer.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fixed
from strata.operators import marts as M
from strata.operators import quality as Q
from strata.operators.conform import DEFAULT, ConformOptions, conform_table
from strata.operators.tables import dedup_by_key, dedup_repeated, with_audit
from strata.sources.files import read_raw_csv
from strata.session import scratch_path
from strata.sources.manifest import RunManifest
from strata.sources.store import TRANSACTIONAL_FORMATS, LayerStore, MissingTableError

Frames = dict[str, DataFrame]


# -- raw ---------------------------------------------------------------------

def read_raw(spark: SparkSession, base_uri: str, tables=fixed.TABLES, keep_empty: bool = False) -> Frames:
    """``{base_uri}/{table}.csv`` for every table, all columns string."""
    return {t: read_raw_csv(spark, f"{base_uri.rstrip('/')}/{t}.csv", fixed.RAW_COLUMNS[t],
                            keep_empty=keep_empty) for t in tables}


def land_raw(sources: Mapping[str, DataFrame], at: datetime | str | None = None) -> Frames:
    """Raw layer: the source rows unchanged plus the audit stamp."""
    return {t: with_audit(df, at) for t, df in sources.items()}


# -- conformed ---------------------------------------------------------------

def require(layer: str, frames: Mapping[str, DataFrame | None]) -> Frames:
    """``frames`` if all are there; else an error that names the missing tables."""
    missing = [f"{layer}.{t}" for t, df in frames.items() if df is None]
    if missing:
        raise MissingTableError(f"missing: {', '.join(missing)} (build layer {layer} first)")
    return dict(frames)


def conform_layer(raw: Mapping[str, DataFrame], options: ConformOptions = DEFAULT,
                  zone: str | None = fixed.LOCAL_ZONE, normalize_first: bool = False) -> Frames:
    """Conformed layer: ``conform_table`` for every raw table."""
    return {t: conform_table(df, t, options=options, zone=zone, normalize_first=normalize_first)
            for t, df in require(fixed.RAW, raw).items()}


def conform_written(raw: Mapping[str, DataFrame], options: ConformOptions = DEFAULT, zone: str | None = fixed.LOCAL_ZONE,
                    normalize_first: bool = False, lazy: Collection[str] = ()) -> Frames:
    """``conform_layer`` over a written raw layer: repeated keys are looked up at once.

    The look-ups are concurrent jobs, one per table (see
    ``dedup_repeated``); tables named in ``lazy`` are left to
    ``dedup_by_key``.
    """
    tables = require(fixed.RAW, raw)
    spark = next(iter(tables.values())).sparkSession

    def one(table: str) -> DataFrame:
        dedup = dedup_by_key if table in lazy else dedup_repeated
        return conform_table(tables[table], table, options=options, zone=zone, normalize_first=normalize_first, dedup=dedup)

    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        done = {t: pool.submit(inheritable_thread_target(spark)(one), t) for t in tables}
        return {t: d.result() for t, d in done.items()}


# -- marts -------------------------------------------------------------------

def mart_layer(conformed: Mapping[str, DataFrame]) -> Frames:
    """Mart layer: the four marts, unsorted (a written table promises no order)."""
    return M.build_marts(require(fixed.CONFORMED, conformed), sort=False)


# -- lineage counts ------------------------------------------------------------

COUNTS_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("rows", T.LongType()),
])


def layer_counts(spark: SparkSession, layers: Mapping[str, Mapping[str, DataFrame | None]],
                 expected: Mapping[str, tuple] | None = None) -> DataFrame:
    """Rows per (layer, table) as one DataFrame; an absent table gives NULL.

    One aggregate per table, unioned: a single action, no driver loop.
    """
    expected = expected or {fixed.RAW: fixed.TABLES, fixed.CONFORMED: fixed.TABLES, fixed.MART: fixed.MART_TABLES}
    parts: list[DataFrame] = []
    missing: list[tuple] = []
    for layer, tables in expected.items():
        frames = layers.get(layer, {})
        for t in tables:
            df = frames.get(t)
            if df is None:
                missing.append((layer, t, None))
            else:
                parts.append(df.agg(F.count(F.lit(1)).cast("long").alias("rows"))
                             .select(F.lit(layer).alias("layer"), F.lit(t).alias("table_name"), "rows"))
    if missing:
        parts.append(spark.createDataFrame(missing, COUNTS_SCHEMA))
    return reduce(lambda a, b: a.unionByName(b), parts)


# -- checks over written tables ---------------------------------------------------

@dataclass
class Demand:
    """What is read of a layer's tables: the columns, and how often each table is gone through."""

    columns: dict[str, set[str]] = field(default_factory=dict)
    passes: dict[str, int] = field(default_factory=dict)
    rules: list = field(default_factory=list)

    def add(self, table: str, columns, passes: int = 1) -> None:
        self.columns.setdefault(table, set()).update(columns)
        self.passes[table] = self.passes.get(table, 0) + passes

    def suite(self, suite) -> Demand:
        """The columns of the rules; a pass for a table's counters, and one for each column that is a key."""
        counted, keys = set(), set()
        self.rules += suite
        for table, rule in suite:
            self.add(table, rule.columns, 0)
            if rule.kind in Q.COUNTER_KINDS and table not in counted:
                counted.add(table)
                self.add(table, (), 1)
            if rule.kind in Q.KEY_KINDS:
                keys.add((table, rule.columns))
            if rule.kind == "referential":
                keys.add((rule.parent, (rule.parent_column,)))
        for table, columns in keys:
            self.add(table, columns)
        return self

    def marts(self, marts=fixed.MART_TABLES) -> Demand:
        """What the builders of ``marts`` read."""
        for mart in marts:
            for table, columns in M.READS[mart].items():
                self.add(table, columns)
        return self


def materialize(spark: SparkSession, layer: str, frames: Mapping[str, DataFrame | None],
                store: LayerStore | None = None, demand: Demand | None = None) -> tuple[dict, dict]:
    """Write the frames that would otherwise be recomputed, with the columns that are read of them.

    ``demand`` says what is read (default: by the layer's suite). A derived
    frame gone through several times is written once below the shared
    folder, which cuts that lineage; only demanded columns are written, and
    the row count and the counters of the demanded rules are observed during
    the write. A frame read by a single pass is left lazy. Returns (frames
    to read, observed values of the written ones).
    """
    demand = demand or Demand().suite(Q.SUITES[layer]())
    heavy = {t: df.select(*[F.col(f"`{c}`") for c in df.columns if c in demand.columns[t]])
             for t, df in frames.items() if df is not None and demand.passes.get(t, 0) > 1}
    if not heavy:
        return dict(frames), {}
    store = store or LayerStore(spark, scratch_path(spark, f"checked-{layer}"))
    store.ensure_layer(layer)
    metrics = {t: Q.counter_metrics(demand.rules, t, df.columns) for t, df in heavy.items()}
    observed = write_tables(store, layer, heavy, False, metrics)
    written = store.read_layer(layer, list(heavy), {t: df.schema for t, df in heavy.items()})
    return {t: written.get(t, df) if t in heavy else df for t, df in frames.items()}, observed


def check_materialized(spark: SparkSession, layer: str, frames: Mapping[str, DataFrame | None],
                       store: LayerStore | None = None) -> Q.QualityReport:
    """The layer's suite over ``frames``, writing first the ones it would recompute."""
    checked, observed = materialize(spark, layer, frames, store)
    return Q.check_layer(spark, layer, checked, measured=observed)


# -- gated run -----------------------------------------------------------------

def write_tables(store: LayerStore, layer: str, frames: Mapping[str, DataFrame], strict: bool = False,
                 metrics: Mapping[str, list] | None = None, parallel: int | None = None,
                 run: RunManifest | None = None) -> dict[str, dict]:
    """Write a layer's tables as concurrent Spark jobs; observed values per table.

    The tables of one layer are independent. Their jobs are submitted from
    threads that inherit the caller's job group and local properties; with
    ``spark.scheduler.mode=FAIR`` they share the cluster, with the default
    FIFO a later job gets the executors an earlier one leaves idle. Each
    table's ``metrics`` are observed during its write; the result always
    holds ``rows``. With ``run`` each written table is recorded with its
    version, and tables recorded already are not written again.
    """
    metrics = metrics or {}
    items = list(frames.items())
    workers = max(1, min(parallel or len(items), len(items)))

    def one(kv):
        table, df = kv
        done = run.get(f"{layer}.{table}") if run else None
        if done is None:
            version, observed = store.write_version(df, layer, table, metrics.get(table, ()), schema_may_change=not strict)
            done = {"version": version, "observed": observed}
            if run:
                done = run.put(f"{layer}.{table}", done)
        return done["observed"]

    with ThreadPoolExecutor(max_workers=workers) as pool:
        done = [pool.submit(inheritable_thread_target(store.spark)(one), item) for item in items]
        return {t: d.result() for (t, _), d in zip(items, done)}


@dataclass
class RunResult:
    reports: dict[str, Q.QualityReport] = field(default_factory=dict)
    rows: dict[str, dict[str, int]] = field(default_factory=dict)
    measured: dict[str, dict[str, dict]] = field(default_factory=dict)   # counter checks observed at write
    blocked_at: str | None = None      # layer whose check failed an ERROR (stop_on_error)

    @property
    def ok(self) -> bool:
        return self.blocked_at is None

    def report(self) -> DataFrame:
        """The reports of every checked layer as one DataFrame (the run has fetched them: no check runs again)."""
        return reduce(lambda a, b: a.unionByName(b), [r.result() for r in self.reports.values()])

    def counts(self, spark: SparkSession) -> DataFrame:
        """Rows per (layer, table) as observed during the writes: no pass over data.

        Same shape as ``layer_counts``; a layer that was never built (gate)
        gives NULL for its tables.
        """
        expected = {fixed.RAW: fixed.TABLES, fixed.CONFORMED: fixed.TABLES, fixed.MART: fixed.MART_TABLES}
        rows = [(layer, t, self.rows.get(layer, {}).get(t)) for layer, tables in expected.items() for t in tables]
        return spark.createDataFrame(rows, COUNTS_SCHEMA)


def run_layers(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    store: LayerStore,
    at: datetime | str | None = None,
    options: ConformOptions = DEFAULT,
    zone: str | None = fixed.LOCAL_ZONE,
    strict_raw_schema: bool = True,
    stop_on_error: bool = False,
    normalize_first: bool = False,
    gate: bool = True,
    run_id: str | None = None,
    until: str = fixed.MART,
) -> RunResult:
    """raw -> check -> conformed -> check -> marts -> check.

    Each layer is written, read back, and checked; a failed ERROR raises
    ``QualityGateError`` and the next layer is not built (with
    ``stop_on_error`` the run returns instead, ``blocked_at`` naming the
    layer). A failed WARN is only reported. With ``gate=False`` every layer
    is built and checked whatever the reports say (``blocked_at`` still
    names the first layer with a failed ERROR).

    Row counts and every counter check (not empty, not NULL, range,
    non-negative, in set) are observed while a table is written, so only
    uniqueness and referential checks read the written data again.

    With a ``run_id`` the run keeps a manifest in the store: the version of
    each table it wrote, and each layer whose checks passed. A run that
    failed goes on when it is started again with the same id: recorded
    tables are not written and passed checks not run again, and every layer
    is built from the run's own versions, whatever other runs have written
    since. Once its last layer has passed, the run is finished and its
    versions are released. ``until`` ends the run after that layer, to be
    taken up later.
    """
    if run_id and store.fmt in TRANSACTIONAL_FORMATS:
        raise ValueError(f"a run's manifest pins versions of this store; format {store.fmt} keeps its own")
    result = RunResult()
    run = RunManifest(spark, store.runs_uri(), run_id) if run_id else None

    def write_all(layer: str, frames: Mapping[str, DataFrame], strict: bool) -> Frames:
        store.ensure_layer(layer)
        suite = Q.SUITES[layer]()
        metrics = {t: Q.counter_metrics(suite, t, df.columns) for t, df in frames.items()}
        observed = write_tables(store, layer, frames, strict, metrics, run=run)
        result.rows[layer] = {t: v["rows"] for t, v in observed.items()}
        result.measured[layer] = observed
        versions = {t: run.get(f"{layer}.{t}")["version"] if run else None for t in frames}
        if run or store.base_uri is not None:
            return {t: store.read(layer, t, df.schema, versions[t]) for t, df in frames.items()}
        return store.read_layer(layer, list(frames))

    def passes(layer: str, frames: Mapping[str, DataFrame | None]) -> bool:
        step = f"{layer}.checked"
        earlier = run.get(step) if run else None
        if earlier is not None:
            report = Q.QualityReport(layer, spark.createDataFrame([tuple(r) for r in earlier["checks"]], Q.REPORT_SCHEMA))
        else:
            report = Q.check_layer(spark, layer, dict(frames), measured=result.measured.get(layer))
        result.reports[layer] = report
        if report.ok or not gate:
            if run and earlier is None:
                run.put(step, {"checks": [list(r) for r in report.rows()]})
            if not report.ok:
                result.blocked_at = result.blocked_at or layer
            if run and layer == fixed.MART:
                run.finish()
            return layer != until
        if not stop_on_error:
            raise Q.QualityGateError(report)
        result.blocked_at = result.blocked_at or layer
        return False

    raw = write_all(fixed.RAW, land_raw(sources, at), strict_raw_schema)
    if not passes(fixed.RAW, raw):
        return result
    recorded = [t for t in raw if run and run.get(f"{fixed.CONFORMED}.{t}")]
    conformed = write_all(fixed.CONFORMED, conform_written(raw, options, zone, normalize_first, recorded), False)
    if not passes(fixed.CONFORMED, conformed):
        return result
    marts = write_all(fixed.MART, mart_layer(conformed), False)
    passes(fixed.MART, marts)
    return result
