"""File sources and sinks: raw delimited text, columnar files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import records


def all_string_schema(columns: Sequence[str]) -> T.StructType:
    """Every column a nullable string."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


#: RFC 4180: a quote in a quoted field is doubled, a backslash is a plain character.
QUOTING = {"quote": '"', "escape": '"', "encoding": "UTF-8"}
CORRUPT = "__corrupt"


def read_raw_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    encoding: str = "UTF-8",
    keep_empty: bool = False,
    line_breaks: bool | None = None,
) -> DataFrame:
    """Read a headered CSV with every column as string.

    With ``columns`` the schema is given, and the file header is checked
    against ``columns`` (a renamed column fails the read). Without
    ``columns`` the names come from the header (one small job reads it);
    types are never inferred, every column stays a string. Empty fields read
    as NULL; ``keep_empty`` keeps them as ``''``, quoted or not. Missing
    fields are NULL, surplus ones are dropped (``read_checked_csv`` returns
    such records apart). A missing path raises ``AnalysisException``
    (PATH_NOT_FOUND) before any job, on any file system.

    Quoted fields may hold line breaks. Whether any does is looked up in one
    pass over the lines (``strata.sources.records``) unless ``line_breaks``
    says so. Files split into ~maxPartitionBytes tasks either way, so a big
    file is read in parallel; only other encodings than UTF-8 take one task
    per file.
    """
    plain = spark.read.options(**QUOTING | {"encoding": encoding}, header="true", mode="PERMISSIVE", inferSchema="false")
    if columns is not None:
        plain = plain.schema(all_string_schema(columns)).option("enforceSchema", "false")
    if encoding.upper().replace("-", "") != "UTF8":
        df = plain.option("multiLine", str(line_breaks is not False).lower()).csv(path)
        return df.fillna("") if keep_empty else df
    found = None
    if line_breaks is not False:
        lines = records.text_lines(spark, path)
        found = records.layout(lines)
    if found and (line_breaks or found.crossing_lines):
        names = columns or spark.read.options(**QUOTING, header="true", multiLine="true").csv(path).columns
        df = _parsed(records.records(lines, found), names).select(*[_column(c) for c in names])
    else:
        df = plain.csv(path)
    # all-string columns: NULL can only come from an empty field
    return df.fillna("") if keep_empty else df


def read_checked_csv(spark: SparkSession, path: str, columns: Sequence[str], keep_empty: bool = False, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): the records with one field for each of ``columns``, and the text of the others (``record``).

    Without ``header`` the files begin with their first row. Otherwise as
    ``read_raw_csv``.
    """
    lines = records.text_lines(spark, path)
    found = records.records(lines, records.layout(lines))
    parsed = _parsed(found if header else found.withColumn("first", F.lit(False)), columns)
    rows = parsed.filter(F.col(CORRUPT).isNull()).select(*[_column(c) for c in columns])
    rejected = parsed.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record"))
    return rows.fillna("") if keep_empty else rows, rejected


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


def _parsed(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The fields of records, and the whole text of one whose number of fields is not that of ``columns``.

    The first record of each file has to be the header.
    """
    schema = all_string_schema([*columns, CORRUPT])
    options = QUOTING | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "multiLine": "true"}
    row = F.from_csv("text", ", ".join(f"`{c}` STRING" for c in schema.names), options)
    parsed = found.select("first", row.alias("row"))
    same = F.col(f"row.{CORRUPT}").isNull()
    for i, c in enumerate(columns):
        same = same & F.col("row").getField(schema[i].name).eqNullSafe(F.lit(c))
    wrong = F.raise_error(F.concat(F.lit(f"the header is not {list(columns)}: "), F.to_csv("row"))).cast("boolean")
    return parsed.filter(F.when(~F.col("first"), True).when(same, False).otherwise(wrong)).select("row.*")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write headered CSV part files (one per task, no funnel through one writer).

    Values are written as they are: Spark trims surrounding whitespace on
    write by default, which would silently clean padded raw text. Values
    with separators, quotes or line breaks are quoted, quotes in them
    doubled. NULL is written as an empty field and ``''`` as ``""``; both
    read back as NULL.
    """
    (df.write.mode(mode)
     .options(**QUOTING, header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
     .csv(path))


_schemas: dict[tuple, T.StructType] = {}


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the star-schema test tables (``{sf_dir}/{name}.parquet``).

    The schema comes from the file itself. It is kept for a session by path
    and modification time, so a table read by many queries has its footer
    read once, and a changed file is looked at again.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    status = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hpath)
    key = (spark.sparkContext.applicationId, path, status.getModificationTime(), status.getLen())
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)
