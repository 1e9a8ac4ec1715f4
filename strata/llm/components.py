"""Connected components of an edge table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path, shared_dir
from strata.sources.paths import remove_path


#: Setting by which an execution that ends takes its shuffle files with it.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, its lineage cut.

    The files stay until the folder's retention policy takes them, or until
    the frame is collected where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()


class Stages:
    """Named intermediate tables in the shared folder, for loops: lineage is cut, and a table replaces the one of its name.

    Frames that read the table before must not be used after ``put`` has
    returned. What is not dropped goes when the process ends. The shuffle
    files of a table go as soon as it is written, not when the driver happens
    to collect its garbage: nothing reads them again.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written as table ``name`` and read back."""
        path = scratch_path(self.spark, f"stage-{name}")
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        for name in names:
            if path := self.paths.pop(name, None):
                remove_path(self.spark, path)


def typed(df: DataFrame, **types: str) -> DataFrame:
    """Some columns of ``df`` cast to the given types; a column of the right type stays itself.

    A cast that changes nothing would leave an alias behind, and two uses of
    the frame in one query would no longer share their shuffle.
    """
    have = dict(df.dtypes)
    return df.select(*[F.col(c) if have[c] == t else F.col(c).cast(t).alias(c) for c, t in types.items()])


def components(edges: DataFrame, stages: Stages | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component: the least node reachable.

    Alternates large-star and small-star steps: each is an aggregate per node
    (combined before its shuffle) and a join that AQE can split, so a hub
    with millions of edges is never gathered. The number of rounds is
    logarithmic in the longest path. No edges: no rows. Edges with a null
    end and loops are ignored; repeated edges count once. The result reads
    the table ``stars`` of ``stages``.
    """
    stages = stages or Stages(edges.sparkSession)
    stars = edges.select("a", "b").filter("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct()
    before = None
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.selectExpr("u", "m AS v"))
        stars = stages.put("stars", small.selectExpr("greatest(u, v) AS u", "least(u, v) AS v").filter("u <> v").distinct())
        after = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    return stars.selectExpr("u AS node", "v AS component").union(stars.selectExpr("v AS node", "v AS component").distinct())
