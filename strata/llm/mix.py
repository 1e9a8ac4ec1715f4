"""Mixing sources to target weights with nested hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.components import checkpointed

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
#: Bits of the document hash resolved by one histogram, and number of histograms.
LEVEL_BITS, LEVELS = 12, 4


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target): words to take of each source, from (source, size) rows.

    Sources in code point order, null last, get ``weights`` in turn and share
    the total size by weight; a target above ``most`` times its source's size
    stops there and the excess goes to the others by weight, until none is
    above. Sources sorted by size per weight are stopped first, so a running
    sum finds them in one pass over the sources (not over their rows).
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int")).cast("long")
    every = by_source.withColumn("weight", weight).withColumn("ratio", F.col("source_size") / F.col("weight"))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    exact = lambda c: c.cast("decimal(38,0)")  # noqa: E731  products of sizes and weights stay exact
    rest = F.sum("source_size").over(whole) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    above = exact(rest) * F.col("weight") > exact(F.col("source_size") * most) * left
    split = every.withColumn("stopped", above).withColumns({
        "rest": F.sum(F.when(F.col("stopped"), (1 - most) * F.col("source_size")).otherwise(F.col("source_size"))).over(whole),
        "share": F.sum(F.when(~F.col("stopped"), F.col("weight"))).over(whole),
    })
    shared = F.col("rest").cast("double") * F.col("weight") / F.col("share")
    target = F.when(F.col("stopped"), (most * F.col("source_size")).cast("double")).otherwise(shared)
    return split.select("source", "source_size", target.alias("target"))


def _bits(hash_: Column, level: int) -> Column:
    """The ``level + 1`` leading groups of the hash."""
    return F.shiftright(hash_, LEVEL_BITS * (LEVELS - 1 - level))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words the mix takes), one row per input row.

    A document is taken ``floor(target / source_size)`` times, and once more
    if its hash is below its source's threshold; ``taken`` is size times that
    number, at most ``most``. Null texts have size 0 and null sources form a
    source of their own; rows with the same doc_id (or none) have the same
    hash and are taken alike. The hash depends on doc_id alone, so reruns,
    retries and any order of rows agree. An empty table gives no rows.

    Method: the sizes are summed by source and leading 12 bits of the hash;
    the running sum of these at most 4096 numbers per source finds the bucket
    in which the budget ends, and only that bucket's rows are summed by their
    next 12 bits, four times. The cell where the budget ends at last is taken
    if that is nearer to the budget. No rows are sorted: the histograms are
    combined before their shuffle, so a hot source costs no more than others.
    """
    digest = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, LEVEL_BITS * LEVELS // 4)
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    # a source's key tells null from every string, so that plain joins match it
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), key.alias("key"), size.alias("size"), F.conv(digest, 16, 10).cast("long").alias("hash"))
    sized = checkpointed(sized)

    targets = source_targets(sized, weights, most).withColumn("key", key)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = checkpointed(targets.withColumn("times", times).select("key", "source_size", "target", "times", (F.col("target") - F.col("times") * F.col("source_size")).alias("budget")))

    edge = plan.select("key", "budget", F.lit(0).cast("long").alias("prefix"))
    for level in range(LEVELS):
        inside = sized.join(edge, "key")
        if level:
            inside = inside.filter(_bits(F.col("hash"), level - 1) == F.col("prefix"))
        bucket = inside.groupBy("key", _bits(F.col("hash"), level).alias("bucket")).agg(F.sum("size").alias("words"), F.max("budget").alias("budget"))
        running = F.sum("words").over(Window.partitionBy("key").orderBy("bucket"))
        over = bucket.withColumn("up_to", running).filter("up_to > budget")
        first = over.groupBy("key").agg(F.min(F.struct("bucket", "up_to", "words", "budget")).alias("e"))
        edge = first.select("key", F.col("e.bucket").alias("prefix"), (F.col("e.budget") - (F.col("e.up_to") - F.col("e.words"))).alias("budget"), F.col("e.words").alias("words"))
    # no edge: the budget is never passed, so it covers what is left of the source
    edge = edge.select("key", F.when(F.col("words") <= 2 * F.col("budget"), F.col("prefix")).otherwise(F.col("prefix") - 1).alias("last"))
    joined = sized.join(plan, "key").join(edge, "key", "left")
    once_more = (F.col("times") < most) & (F.col("budget") > 0) & (F.col("last").isNull() | (F.col("hash") <= F.col("last")))
    taken = F.col("size") * (F.col("times") + F.when(once_more, 1).otherwise(0))
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


#: DuckDB: the same thresholds from a plain running sum over each source's hashes.
ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS hash
  FROM documents),
by_source AS (
  SELECT source, sum(size)::BIGINT AS s, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, sum(s) OVER () - 3 * coalesce(sum(s) OVER b, 0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS share
  FROM by_source WINDOW b AS (ORDER BY s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stopped AS (SELECT source, s, w, rest * w > 3 * s * share AS capped FROM ranked),
targets AS (
  SELECT source, s, CASE WHEN capped THEN (3 * s)::DOUBLE
    ELSE (sum(CASE WHEN capped THEN -2 * s ELSE s END) OVER ())::DOUBLE * w / (sum(w) FILTER (NOT capped) OVER ())::DOUBLE END AS target
  FROM stopped),
plan AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s)::BIGINT ELSE 0 END AS times FROM targets),
cells AS (
  SELECT source, hash, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY hash) AS up_to
  FROM sized GROUP BY source, hash),
edges AS (
  SELECT c.source, min(hash) AS hash, arg_min(words, hash) AS words, arg_min(target - times * s - (up_to - words), hash) AS budget
  FROM cells c JOIN plan p ON c.source IS NOT DISTINCT FROM p.source WHERE up_to > target - times * s GROUP BY c.source)
SELECT d.doc_id, d.source, d.size, p.s AS source_size, p.target,
  (d.size * (p.times + CASE WHEN p.times < 3 AND p.target - p.times * p.s > 0 AND (e.hash IS NULL OR d.hash < e.hash OR (d.hash = e.hash AND e.words <= 2 * e.budget)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN edges e ON d.source IS NOT DISTINCT FROM e.source
"""
