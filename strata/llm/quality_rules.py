"""Quality rules: fixed base rules, then thresholds from quantile sketches per language and source.

DataFrame functions only: every count is an expression over the row, the
sketches are counts by bucket, so they merge by addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.components import checkpointed

BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WINDOW_WORDS = 5
LEAST_WORDS, MOST_REPEATED = 10, 20  # words; percent of the words

#: Ratios that get thresholds, and the slack within which no threshold is set, per 10,000.
RATIOS = {"symbols": 300, "word_length": 40_000, "dup_lines": 500, "repeats": 1500}
#: A threshold is the median plus FENCE times the distance to this quantile (in percent).
FENCE, QUANTILE = 4, 75
#: A group's median is drawn towards its language's as if by so many documents, and that towards the corpus'.
PRIOR_DOCS = 50


def _pairwise(values: Column, size: Column) -> Column:
    """[(x0, x1), (x1, x2), ...] of an array."""
    return F.arrays_zip(F.slice(values, 1, F.greatest(size - 1, F.lit(0))).alias("a"), F.slice(values, 2, F.greatest(size - 1, F.lit(0))).alias("b"))


def measured(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, lang, source and the base counts of each row.

    n_words; word_chars (code points in words); n_symbols (characters of
    ``#*$%&|<>``); n_dup_lines (lines with a word that equal an earlier line
    of the text); n_repeat_words (words in ``window``-word windows found
    twice or more, the first included); base_failed. Null text: no words.
    Windows are equal when their 64-bit hashes agree.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANKS))
    df = docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "").alias("lines"),
        F.when(trimmed != "", F.split(trimmed, BLANK_RUN)).otherwise(F.array().cast("array<string>")).alias("words"),
    )
    df = df.select(
        "doc_id", "lang", "source", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("words").alias("n"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    several = F.greatest(F.col("n") - (window - 1), F.lit(0))
    runs = F.arrays_zip(*[F.slice("hashes", j + 1, several).alias(f"w{j}") for j in range(window)])
    df = df.select("*", F.transform(runs, lambda r: F.xxhash64(*[r[f"w{j}"] for j in range(window)])).alias("windows"), several.alias("m")).drop("hashes")
    # windows sorted by hash, only where one occurs again
    twice = F.size(F.array_distinct("windows")) < F.col("m")
    df = df.withColumn("sorted", F.when(twice, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("windows")
    df = df.withColumn("same", F.filter(_pairwise(F.col("sorted"), F.col("m")), lambda p: p["a"]["h"] == p["b"]["h"])).drop("sorted")
    df = df.withColumn("at", F.array_sort(F.array_union(F.transform("same", lambda p: p["a"]["i"]), F.transform("same", lambda p: p["b"]["i"])))).drop("same")
    gaps = F.transform(_pairwise(F.col("at"), F.size("at")), lambda p: F.least(p["b"] - p["a"], F.lit(window)))
    covered = F.aggregate(gaps, F.lit(window), lambda total, g: total + g)
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    n = F.col("n").cast("long")
    failed = (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n)
    return df.select("doc_id", "lang", "source", n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"))


def ratios() -> dict[str, Column]:
    """Whole numbers per 10,000, so that every engine gets the same."""
    return {
        "symbols": F.expr("10000 * n_symbols div greatest(word_chars, 1)"),
        "word_length": F.expr("10000 * word_chars div greatest(n_words, 1)"),
        "dup_lines": F.expr("10000 * n_dup_lines div greatest(n_words, 1)"),
        "repeats": F.expr("10000 * n_repeat_words div greatest(n_words, 1)"),
    }


def bucket(x: str) -> Column:
    """Log-linear bucket of a whole number: exact below 64, then 32 buckets per power of two."""
    return F.expr(f"CASE WHEN {x} < 32 THEN {x} ELSE (length(bin({x})) - 6) * 32 + shiftright({x}, length(bin({x})) - 6) END")


def least_of(b: str) -> Column:
    """Least number in a bucket."""
    return F.expr(f"CASE WHEN {b} < 64 THEN {b} ELSE shiftleft({b} % 32 + 32, CAST({b} div 32 - 1 AS INT)) END")


def quantiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by..., metric, docs, mid, spread): median, and its distance to the upper quantile, from bucket counts merged over ``by``."""
    merged = sketches.groupBy(*by, "metric", "bucket").agg(F.sum("docs").alias("docs"))
    order = Window.partitionBy(*by, "metric").orderBy("bucket")
    running = merged.withColumns({"up_to": F.sum("docs").over(order), "every": F.sum("docs").over(Window.partitionBy(*by, "metric"))})
    at = lambda q: F.min(F.when(100 * F.col("up_to") >= q * F.col("every"), F.col("bucket")))
    found = running.groupBy(*by, "metric").agg(F.sum("docs").alias("docs"), at(50).alias("mid"), at(QUANTILE).alias("high"))
    found = found.withColumns({"mid": least_of("mid").cast("long"), "high": least_of("high").cast("long")})
    return found.select(*by, "metric", "docs", "mid", (F.col("high") - F.col("mid")).alias("spread"))


def judge(docs: DataFrame) -> DataFrame:
    """The columns of ``measured`` without lang and source, and ``kept``, one row per row of ``docs``.

    Documents that fail the base rules are rejected. The others are sketched:
    counts by language, source, ratio and log-linear bucket (relative error
    1/32). Per group, a ratio may be at most its median plus ``FENCE`` times
    its spread, or plus the ratio's slack if that is more. The spread is the
    distance from the median to the upper quartile, the least one of the
    group, its language and the corpus: junk that is a minority of a source
    neither moves the median far nor widens the spread. Medians are weighted
    means with those of the next wider group (``PRIOR_DOCS``), so that few
    documents say little. The thresholds are joined to the documents. Null lang and source
    are groups of their own; repeated rows count each; null doc_ids are
    judged like others; null and empty texts fail the base rules; an empty
    table gives no rows. Other columns are ignored.
    """
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))  # noqa: E731  plain joins match null to null
    rows = checkpointed(measured(docs).withColumns({"l": key("lang"), "s": key("source")}))
    rated = rows.filter("NOT base_failed").select("l", "s", F.explode(F.create_map(*[x for name, r in ratios().items() for x in (F.lit(name), r)])).alias("metric", "x"))
    sketches = rated.groupBy("l", "s", "metric", bucket("x").cast("long").alias("bucket")).agg(F.count("*").alias("docs"))
    wide = lambda t, by, name: t.groupBy(*by).agg(F.max("docs").alias(f"{name}_docs"), *[F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{name}_{c}_{m}") for m in RATIOS for c in ("mid", "spread")])
    own = wide(quantiles(sketches, ["l", "s"]), ["l", "s"], "own")
    language = wide(quantiles(sketches, ["l"]), ["l"], "lang")
    corpus = wide(quantiles(sketches.withColumn("c", F.lit(1)), ["c"]), ["c"], "all")  # one row
    groups = own.join(language, "l").withColumn("c", F.lit(1)).join(corpus, "c")
    drawn = lambda docs, mid, wider: f"({docs} * {mid} + {PRIOR_DOCS} * {wider}) div ({docs} + {PRIOR_DOCS})"

    def most(m: str) -> Column:
        mid = drawn("own_docs", f"own_mid_{m}", drawn("lang_docs", f"lang_mid_{m}", f"all_mid_{m}"))
        return F.expr(f"{mid} + greatest({FENCE} * least(own_spread_{m}, lang_spread_{m}, all_spread_{m}), {RATIOS[m]})").alias(f"most_{m}")

    groups = groups.select("l", "s", *[most(m) for m in RATIOS])
    joined = rows.join(groups, ["l", "s"], "left")
    within = F.lit(True)
    for name, ratio in ratios().items():
        within = within & (ratio <= F.col(f"most_{name}"))
    kept = ~F.col("base_failed") & F.coalesce(within, F.lit(False))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


def _quantile_sql(by: str, name: str) -> str:
    """SQL of one level of quantiles, from the table ``sketches``."""
    keys = f"{by}, " if by else ""
    over = f"PARTITION BY {keys}metric"
    low = lambda b: f"(CASE WHEN {b} < 64 THEN {b} ELSE ({b} % 32 + 32) << ({b} // 32 - 1)::INT END)"
    columns = ", ".join(f"max({c}) FILTER (metric = '{m}') AS {name}_{c}_{m}" for m in RATIOS for c in ("mid", "spread"))
    return f"""
{name}_merged AS (SELECT {keys}metric, bucket, sum(docs)::BIGINT AS docs FROM sketches GROUP BY {keys}metric, bucket),
{name}_running AS (SELECT *, sum(docs) OVER ({over} ORDER BY bucket) AS up_to, sum(docs) OVER ({over}) AS every FROM {name}_merged),
{name}_found AS (
  SELECT {keys}metric, sum(docs)::BIGINT AS docs, min(bucket) FILTER (100 * up_to >= 50 * every) AS mid, min(bucket) FILTER (100 * up_to >= {QUANTILE} * every) AS high
  FROM {name}_running GROUP BY {keys}metric),
{name}_limits AS (SELECT {keys}metric, docs, {low("mid")} AS mid, {low("high")} - {low("mid")} AS spread FROM {name}_found),
{name}_wide AS (SELECT {keys}max(docs) AS {name}_docs, {columns} FROM {name}_limits {f"GROUP BY {by}" if by else ""})"""


def _most_sql(m: str) -> str:
    language = f"(lang_docs * lang_mid_{m} + {PRIOR_DOCS} * corpus_mid_{m}) // (lang_docs + {PRIOR_DOCS})"
    middle = f"(own_docs * own_mid_{m} + {PRIOR_DOCS} * ({language})) // (own_docs + {PRIOR_DOCS})"
    return f"{middle} + greatest({FENCE} * least(own_spread_{m}, lang_spread_{m}, corpus_spread_{m}), {RATIOS[m]}) AS most_{m}"


_RATIO_SQL = {
    "symbols": "10000 * n_symbols // greatest(word_chars, 1)",
    "word_length": "10000 * word_chars // greatest(n_words, 1)",
    "dup_lines": "10000 * n_dup_lines // greatest(n_words, 1)",
    "repeats": "10000 * n_repeat_words // greatest(n_words, 1)",
}

#: DuckDB: base counts from unnested words and lines, the same sketches and thresholds.
ORACLE_SQL = rf"""
WITH texts AS (SELECT row_number() OVER () AS id, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
runs AS (
  SELECT id, i, words[i : i + {WINDOW_WORDS - 1}] AS run
  FROM (SELECT id, words, unnest(range(1, len(words) - {WINDOW_WORDS - 2})) AS i FROM split WHERE len(words) >= {WINDOW_WORDS})),
again AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, run) AS times FROM runs) WHERE times > 1),
gaps AS (SELECT id, least(coalesce(lead(i) OVER (PARTITION BY id ORDER BY i) - i, {WINDOW_WORDS}), {WINDOW_WORDS}) AS gap FROM again),
repeats AS (SELECT id, sum(gap)::BIGINT AS n FROM gaps GROUP BY id),
lines AS (SELECT id, line FROM (SELECT id, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (SELECT id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY id),
counted AS (
  SELECT id, doc_id, lang, source, len(words)::BIGINT AS n_words, coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN dups d USING (id) LEFT JOIN repeats r USING (id)),
judged AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM counted),
rated AS ({" UNION ALL ".join(f"SELECT lang, source, '{m}' AS metric, {r} AS x FROM judged WHERE NOT base_failed" for m, r in _RATIO_SQL.items())}),
sketches AS (
  SELECT lang, source, metric, CASE WHEN x < 32 THEN x ELSE (length(bin(x)) - 6) * 32 + (x >> (length(bin(x)) - 6)::INT) END AS bucket, count(*) AS docs
  FROM rated GROUP BY ALL),
{_quantile_sql("lang, source", "own")},
{_quantile_sql("lang", "lang")},
{_quantile_sql("", "corpus")},
groups AS (
  SELECT o.lang, o.source, {", ".join(map(_most_sql, RATIOS))}
  FROM own_wide o JOIN lang_wide l ON o.lang IS NOT DISTINCT FROM l.lang, corpus_wide)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({" AND ".join(f"({r}) <= most_{m}" for m, r in _RATIO_SQL.items())}, false) AS kept
FROM judged j LEFT JOIN groups g ON j.lang IS NOT DISTINCT FROM g.lang AND j.source IS NOT DISTINCT FROM g.source
"""
