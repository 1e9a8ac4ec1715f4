"""Layer storage: one table per (layer, table), in a catalog or under a base URI.

Catalog mode (``base_uri=None``) uses ``layer.table`` identifiers in the
session catalog. Path mode stores ``{base_uri}/{layer}/{table}`` in any
Hadoop file system (``s3a://``, ``hdfs://``, ``file:``). Writes are full
refreshes.

Formats without transactions are written as versions, and a version is
named only after the job has committed: the data goes to a new ``data-...``
folder below the table, then the file ``_commits/<number>`` is put there if
absent, with the folder's name in it. Readers take the last number. In
catalog mode the table's folder is in its database's location, and the view
``layer.table`` is moved to the new version. Nothing is renamed or copied,
which object stores could not do at once.

A writer takes the number that follows the version it found when it began.
If another writer has taken that number meanwhile, the file is there, the
later writer raises ``WriteConflictError`` and leaves nothing behind. Until
the commit readers see the old version whole; a crash before it leaves the
old version, one after it the new. The version before stays for queries
that still read it, and so do versions that an unfinished run has pinned
(``strata.sources.manifest``); older ones are removed by the next write.
Writing each layer and reading it back cuts the lineage, so a lost executor
only recomputes from the last written layer.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import manifest
from strata.sources.paths import names as _names
from strata.sources.paths import path_exists, put_if_absent, read_text, remove_path

COMMITS = "_commits"


# formats that replace a table atomically on their own
TRANSACTIONAL_FORMATS = ("delta", "iceberg", "hudi")


class SchemaMismatchError(ValueError):
    """A strict overwrite would change an existing table's schema."""


class MissingTableError(LookupError):
    """A job needs a table that its layer does not have."""


class WriteConflictError(RuntimeError):
    """Another writer has committed a version of the table since this write began."""


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


@dataclass
class LayerStore:
    spark: SparkSession
    base_uri: str | None = None
    fmt: str = "parquet"
    prefix: str = ""                   # catalog mode: before the names of the databases
    databases: str | None = None       # catalog mode: folder of the databases (default: the warehouse)

    # -- naming ---------------------------------------------------------------
    def location(self, layer: str, table: str) -> str:
        """The table's identifier or root folder."""
        if self.base_uri is None:
            return f"{self.prefix}{layer}.{table}"
        return f"{self.base_uri.rstrip('/')}/{layer}/{table}"

    def ensure_layer(self, layer: str) -> None:
        """Create the layer's database (catalog mode); paths need nothing."""
        if self.base_uri is None:
            at = f" LOCATION '{self.databases.rstrip('/')}/{layer}'" if self.databases else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.prefix}{layer}`{at}")

    def root(self, layer: str, table: str) -> str:
        """The folder of the table's versions."""
        if self.base_uri is None:
            return f"{self.spark.catalog.getDatabase(self.prefix + layer).locationUri.rstrip('/')}/{table}"
        return self.location(layer, table)

    def runs_uri(self) -> str:
        """Where the manifests of this store's runs are."""
        return (self.base_uri or self.databases or self.spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")

    def _versions(self, root: str) -> list[tuple[int, str]]:
        """Committed (number, data folder), oldest first; a commit without its content is not one yet."""
        numbers = [n for n in _names(self.spark, f"{root}/{COMMITS}") if n.isdigit()]
        found = [(int(n), read_text(self.spark, f"{root}/{COMMITS}/{n}")) for n in numbers[-3:]]
        return [(n, data) for n, data in found if data]

    def _data(self, layer: str, table: str) -> str | None:
        """The folder of the current version, or None.

        A folder without commits that some other writer filled is read as it is.
        """
        root = self.root(layer, table)
        if self.fmt in TRANSACTIONAL_FORMATS:
            return root if path_exists(self.spark, root) else None
        versions = self._versions(root)
        if versions:
            return f"{root}/{versions[-1][1]}"
        foreign = [n for n in _names(self.spark, root) if not n.startswith(("_", ".", "data-"))]
        return root if foreign else None

    # -- sources --------------------------------------------------------------
    def exists(self, layer: str, table: str) -> bool:
        if self.base_uri is None:
            return self.spark.catalog.tableExists(self.location(layer, table))
        return self._data(layer, table) is not None

    def read(self, layer: str, table: str, schema: T.StructType | None = None, version: str | None = None) -> DataFrame:
        """The table, or one ``version`` of it; a known ``schema`` (path mode) spares the footer-reading job."""
        if self.base_uri is None and version is None:
            return self.spark.table(self.location(layer, table))
        path = self._data(layer, table) if version is None else f"{self.root(layer, table)}/{version}"
        if path is None or version is not None and not path_exists(self.spark, path):
            raise MissingTableError(f"{self.location(layer, table)} does not exist" + (f" in version {version}" if version else ""))
        reader = self.spark.read.format(self.fmt)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(path)

    def read_layer(self, layer: str, tables, schemas: dict | None = None) -> dict[str, DataFrame | None]:
        """All tables of a layer; an absent table maps to None (no counting)."""
        schemas = schemas or {}
        return {t: (self.read(layer, t, schemas.get(t)) if self.exists(layer, t) else None) for t in tables}

    # -- sinks ----------------------------------------------------------------
    def write(self, df: DataFrame, layer: str, table: str, schema_may_change: bool = True) -> int:
        """Overwrite ``layer.table`` with ``df`` and return its row count.

        The count is gathered by an ``Observation`` during the write itself,
        so the plan runs once. With ``schema_may_change=False`` the existing
        table's column names and types must match or nothing is written.
        """
        return self.write_observed(df, layer, table, (), schema_may_change)["rows"]

    def write_observed(self, df: DataFrame, layer: str, table: str, metrics: Sequence[Column] = (),
                       schema_may_change: bool = True) -> dict[str, int]:
        """``write`` that also observes the aggregate ``metrics`` in the same pass.

        Returns ``{"rows": n, <metric alias>: value, ...}``.
        """
        return self.write_version(df, layer, table, metrics, schema_may_change)[1]

    def write_version(self, df: DataFrame, layer: str, table: str, metrics: Sequence[Column] = (),
                      schema_may_change: bool = True) -> tuple[str | None, dict[str, int]]:
        """``write_observed`` that also returns the version written (None where the format keeps its own)."""
        if not schema_may_change and self.exists(layer, table):
            old = self.read(layer, table).schema
            if _shape(old) != _shape(df.schema):
                raise SchemaMismatchError(
                    f"{self.location(layer, table)}: schema {_shape(old)} != {_shape(df.schema)}")
        self.ensure_layer(layer)
        obs = Observation(f"rows:{layer}.{table}")
        observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics)
        writer = observed.write.format(self.fmt).mode("overwrite")
        if self.fmt == "delta" and schema_may_change:
            writer = writer.option("overwriteSchema", "true")
        version = None
        if self.fmt not in TRANSACTIONAL_FORMATS:
            version = self._commit_folder(writer, layer, table)
        elif self.base_uri is None:
            writer.saveAsTable(self.location(layer, table))
        else:
            writer.save(self.location(layer, table))
        return version, {k: int(v) for k, v in obs.get.items()}

    def _commit_folder(self, writer, layer: str, table: str) -> str:
        """Write a new version, then put its commit where the next number is still free."""
        root = self.root(layer, table)
        taken = [n for n in _names(self.spark, f"{root}/{COMMITS}") if n.isdigit()]
        number = int(taken[-1]) + 1 if taken else 0
        data = f"data-{uuid.uuid4().hex[:12]}"
        try:
            writer.save(f"{root}/{data}")
        except Exception:
            remove_path(self.spark, f"{root}/{data}")
            raise
        if not put_if_absent(self.spark, f"{root}/{COMMITS}/{number:012d}", data):
            remove_path(self.spark, f"{root}/{data}")
            raise WriteConflictError(f"{self.location(layer, table)}: another writer has committed version {number}")
        if self.base_uri is None:
            self._point_view(layer, table)
        kept = manifest.pinned(self.spark, self.runs_uri()) if len(taken) > 1 else ()
        for old in taken[:-1]:
            gone = read_text(self.spark, f"{root}/{COMMITS}/{old}")
            if gone not in kept:
                remove_path(self.spark, f"{root}/{COMMITS}/{old}")
                if gone:
                    remove_path(self.spark, f"{root}/{gone}")
        return data

    def _point_view(self, layer: str, table: str) -> None:
        """``layer.table`` reads the last version, also if another writer commits one meanwhile."""
        at = None
        while at != (now := self._data(layer, table)):
            at = now
            self.spark.sql(f"CREATE OR REPLACE VIEW `{self.prefix}{layer}`.`{table}` AS SELECT * FROM {self.fmt}.`{at}`")

    def preview(self, layer: str, table: str, n: int = 10, keys: Sequence[str] = ()) -> DataFrame:
        """``n`` rows of the written table (reads back, no recompute), the first by ``keys`` if given."""
        df = self.read(layer, table)
        return (df.orderBy(*keys) if keys else df).limit(n)
