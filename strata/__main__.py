"""Command line: one Spark job per layer, for a scheduler to chain.

    python -m strata land     --source URI --lake URI [--preview N]
    python -m strata conform  --lake URI [--preview N] [--blank-as-missing --all-whitespace --normalize-first]
    python -m strata marts    --lake URI [--preview N]
    python -m strata check    {bronze,silver,gold} --lake URI     # exit 1 on a failed ERROR
    python -m strata run      --source URI --lake URI [--run-id ID] [conform options]   # all layers, gated

A ``run`` with a ``--run-id`` that failed goes on from its last written table
when it is started again with the same id.

``--lake`` is the layer store root (any Hadoop URI); without it the session
catalog's ``bronze``/``silver``/``gold`` databases are used, which needs a
catalog that outlives the process (``--persistent-catalog``, or one set in
Spark's configuration); the steps refuse to run on Spark's in-memory catalog.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from strata import fixed
from strata.operators import quality as Q
from strata.operators.conform import ConformOptions
from strata.plans import layers as L
from strata.session import build_session
from strata.sources.manifest import RunFinishedError
from strata.sources.store import LayerStore, MissingTableError, WriteConflictError


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("land", "run"):
        s = sub.add_parser(name)
        s.add_argument("--source", required=True)
        s.add_argument("--lake")
    for name in ("conform", "marts"):
        sub.add_parser(name).add_argument("--lake")
    for name in ("land", "conform", "marts"):
        sub.choices[name].add_argument("--preview", type=int, default=0,
                                       help="show N rows of each written table (read back, not recomputed)")
    for name in ("conform", "run"):
        c = sub.choices[name]
        c.add_argument("--blank-as-missing", action="store_true", help="blank text also gets the defaults")
        c.add_argument("--all-whitespace", action="store_true", help="trim tabs/newlines too when normalising")
        c.add_argument("--normalize-first", action="store_true", help="deduplicate on normalised keys")
    sub.choices["run"].add_argument("--run-id", help="keep a manifest, and go on with the run of this id if it failed")
    c = sub.add_parser("check")
    c.add_argument("layer", choices=fixed.LAYERS)
    c.add_argument("--lake")
    for s in sub.choices.values():
        s.add_argument("--persistent-catalog", action="store_true", help="use a metastore that outlives the process")
    return p


def _options(args) -> ConformOptions:
    return ConformOptions(blank_as_missing=args.blank_as_missing, all_whitespace=args.all_whitespace)


def _tables(layer: str):
    return fixed.MART_TABLES if layer == fixed.MART else fixed.TABLES


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(f"strata-{args.cmd}", persistent_catalog=args.persistent_catalog)
    if args.lake is None and spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "in-memory":
        print("error: without --lake the steps need a catalog that outlives the process: "
              "pass --lake URI or --persistent-catalog", file=sys.stderr)
        return 2
    try:
        return _run(args, spark)
    except (MissingTableError, RunFinishedError, WriteConflictError) as error:
        print(f"error: {error}", file=sys.stderr)
        return 2


def _run(args: argparse.Namespace, spark: SparkSession) -> int:
    store = LayerStore(spark, args.lake)
    if args.cmd in ("land", "conform", "marts"):
        if args.cmd == "land":
            layer, frames, strict = fixed.RAW, L.land_raw(L.read_raw(spark, args.source)), True
        elif args.cmd == "conform":
            frames = L.conform_layer(store.read_layer(fixed.RAW, fixed.TABLES), _options(args),
                                     normalize_first=args.normalize_first)
            layer, strict = fixed.CONFORMED, False
        else:
            layer, frames, strict = fixed.MART, L.mart_layer(store.read_layer(fixed.CONFORMED, fixed.TABLES)), False
        store.ensure_layer(layer)
        for t, observed in L.write_tables(store, layer, frames, strict).items():
            print(f"{layer}.{t}: {observed['rows']} rows, {len(frames[t].columns)} columns")
        for t in frames if args.preview else ():
            print(f"{layer}.{t}")
            store.preview(layer, t, args.preview).show(truncate=False)
    elif args.cmd == "check":
        report = Q.check_layer(spark, args.layer, store.read_layer(args.layer, _tables(args.layer)))
        for r in report.failed():
            print(f"DQ FAIL [{r.severity}] {r.table} :: {r.check} - {r.detail}")
        print(report.summary())
        return 0 if report.ok else 1
    elif args.cmd == "run":
        result = L.run_layers(spark, L.read_raw(spark, args.source), store, options=_options(args),
                              stop_on_error=True, normalize_first=args.normalize_first, run_id=args.run_id)
        for report in result.reports.values():
            print(report.summary())
        return 0 if result.ok else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
