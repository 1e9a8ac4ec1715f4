"""Spelling variant grouping: variable-length gram index over the corpus vocabulary."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import crc_sql
from strata.llm.components import checkpointed, typed
from strata.llm.words import chunks, mix
from strata.session import scratch_path

#: Code points a word has and occurrences it needs; a form is this many times as frequent as its variant.
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: Each run whose hash this divides loses a letter (the noise that the contract of the query asks for).
NOISE = 199
#: A gram in more words than this is frequent, at least; frequent grams of one length, at most; longest gram of the index.
FREQUENT, MOST_GRAMS, LONGEST = 32, 100_000, 16
#: Words that one task looks up in the gram dictionary, about.
TASK_WORDS = 16384
_RUNS = re.compile("[A-Za-z\\u00C0-\\u00FF]+")
_STEP, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def word_counts(docs: DataFrame, noise: int = NOISE) -> DataFrame:
    """(word, n): the runs of letters of all texts, A-Z lower-cased, with their occurrences.

    Letters are A-Z, a-z and U+00C0 to U+00FF. A run loses the code point
    h % length if ``noise`` divides h, the crc32 of ``doc_id:run`` (a null
    doc_id is empty); a run of which nothing is left is no word. A null text
    has none, repeated rows count each. No length or count is asked for here.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                found: Counter[str] = Counter()
                texts = pc.ascii_lower(part.column("text")).to_pylist()
                for doc, text in zip(part.column("doc_id").to_pylist(), texts):
                    prefix = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for run, n in Counter(_RUNS.findall(text or "")).items():
                        h = zlib.crc32(run.encode(), prefix)
                        if h % noise == 0:
                            run = run[: h % len(run)] + run[h % len(run) + 1 :]
                        if run:
                            found[run] += n
                yield pa.RecordBatch.from_pydict({"word": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())})

    docs = typed(docs, doc_id="bigint", text="string")
    return docs.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_grams(words: DataFrame, longest: int = LONGEST) -> tuple[frozenset[str], int]:
    """The frequent grams of ``words`` (marked ``^word$``) below ``longest`` characters, and the bound.

    Length by length: a gram is counted if both grams one shorter that it
    holds are frequent, once for each word it occurs in. A gram is frequent
    in more than the bound's words; the bound rises with the vocabulary so
    that no length has more than ``MOST_GRAMS`` frequent ones, and what goes
    to the tasks stays small.
    """
    positions = words.agg(F.sum(F.length("word") + 2)).first()[0] or 0
    bound = max(FREQUENT, -(-positions // MOST_GRAMS))
    known: set[str] = set()
    shorter: frozenset[str] = frozenset()
    for length in range(1, longest):
        before = shorter

        def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found: Counter[str] = Counter()
                for word in batch.column("word").to_pylist():
                    word = f"^{word}$"
                    found.update({
                        word[i : i + length] for i in range(len(word) - length + 1)
                        if length == 1 or word[i : i + length - 1] in before and word[i + 1 : i + length] in before
                    })
                yield pa.RecordBatch.from_pydict({"gram": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())})

        often = words.select("word").mapInArrow(grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") > bound)
        shorter = frozenset(r["gram"] for r in often.select("gram").collect())
        if not shorter:
            break
        known |= shorter
    return frozenset(known), bound


def decompose(word: str, frequent: frozenset[str], longest: int = LONGEST) -> list[tuple[int, int]]:
    """Bounds in ``^word$`` of its variable-length grams: the least infrequent ones, none within another.

    A gram of the index is infrequent while all grams within it are frequent.
    That depends on its own characters alone, so an edit outside it leaves it
    in the other word's list too. Runs of frequent grams of ``longest``
    characters hold none.
    """
    word, found, start = f"^{word}$", [], 0
    for end in range(1, len(word) + 1):
        # the longest frequent stretch that ends here gets shorter only by moving its start
        if end - start >= longest:
            start = end - longest + 1
        while start < end and word[start:end] not in frequent:
            if word[start + 1 : end] in frequent or start + 1 == end:
                if start == end - 1 or word[start : end - 1] in frequent:
                    found.append((start, end))
            start += 1
    return found


def unaffected(length: int, grams: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Grams that an edit leaves alone: by position of a replaced or deleted letter, and by place of an inserted one.

    Letters of ``^word$`` are at 1 to ``length``; place i is before letter i,
    ``length`` + 1 the one before the end mark.
    """
    ends = np.bincount([e for _, e in grams], minlength=length + 3)
    starts = np.bincount([s for s, _ in grams], minlength=length + 3)
    ended = np.cumsum(ends)  # grams that end at or before
    started = len(grams) - np.cumsum(starts) + starts  # grams that start at or after
    change = [int(ended[i] + started[i + 1]) for i in range(1, length + 1)]
    insert = [int(ended[i] + started[i]) for i in range(1, length + 2)]
    return change, insert


def _around(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first i letters and of the letters from i on, for each i."""
    codes = mix(np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(_STEP)).tolist()
    left, right, power = [0], [0], 1
    for c in codes:
        left.append((left[-1] * _STEP + c) & _MASK)
    for c in reversed(codes):
        right.append((right[-1] + c * power) & _MASK)
        power = power * _STEP & _MASK
    return np.array(left, np.uint64), np.array(right[::-1], np.uint64)


def index_keys(word: str, frequent: frozenset[str], longest: int = LONGEST) -> list[int]:
    """The lists of the index that ``word`` is in, as 64-bit hashes.

    * Grams. Words one edit apart share every gram the edit leaves alone. If
      the word keeps at least c grams at each edit that leaves any, all but
      c - 1 of its grams are enough: of two lists that have c in common, cut
      so in one order, the cut ones still meet. Longer grams come first.
    * Gaps. An edit that leaves no gram alone is looked up by what is around
      it: the letters before and after. Words that one edit makes equal there
      have the same ones.
    """
    spans = decompose(word, frequent, longest)
    marked, at = f"^{word}$", {}
    for s, e in spans:
        at.setdefault(marked[s:e], []).append((s, e))
    change, insert = unaffected(len(word), spans)
    # different grams, not places, are what two lists have in common
    repeats = len(spans) - len(at)
    least = max(1, min((n for n in (*change, *insert) if n), default=1) - repeats)
    grams = sorted(at, key=lambda g: (-len(g), g))[: len(at) - least + 1]
    keys = [zlib.crc32(g.encode()) << 32 | zlib.crc32(g[::-1].encode(), len(g)) for g in grams]
    gone, between = [i for i, n in enumerate(change) if not n], [i for i, n in enumerate(insert) if not n]
    if gone or between:
        left, right = _around(word)
        before, after = np.r_[left[gone], left[between]], np.r_[right[[i + 1 for i in gone]], right[between]]
        keys += mix(mix(before) ^ after).tolist()
    return [int(k) - (1 << 63) for k in dict.fromkeys(keys)]


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every two words one inserted, deleted or replaced code point apart, both ways.

    ``words`` has distinct words. No list of a gram is longer than the bound
    of ``frequent_grams``, whatever words share; a list of a gap holds only
    words that are near each other.
    """
    frequent, _ = frequent_grams(words)
    shared = words.sparkSession.sparkContext.broadcast(frequent)  # at most MOST_GRAMS * LONGEST grams

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                keys = [index_keys(w, shared.value) for w in part.column("word").to_pylist()]
                rows = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
                key = pa.array(np.fromiter((k for some in keys for k in some), np.int64, len(rows)))
                yield pa.RecordBatch.from_arrays([key, *(part.column(c).take(pa.array(rows)) for c in ("word", "n"))], ["key", "word", "n"])

    # both sides are the same frame, so its lists are made and shuffled once
    lists = words.mapInArrow(listed, "key long, word string, n long")
    a, b = (F.col("a.word"), F.col("b.word"))
    one_edit = (F.abs(F.length(a) - F.length(b)) <= 1) & (F.levenshtein(a, b, 1) == 1)
    met = lists.alias("a").join(lists.alias("b"), (F.col("a.key") == F.col("b.key")) & (a < b) & one_edit)
    pairs = met.select(a.alias("word"), F.col("a.n").alias("n"), b.alias("other"), F.col("b.n").alias("other_n")).distinct()
    both = F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the last word that forms lead to, by doubling steps.

    A form is ``RATIO`` times as frequent as its word, so chains are short
    and end.
    """
    links = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = checkpointed(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = stepped.drop("moved")
        if stepped.filter("moved").isEmpty():
            return links


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, noise: int = NOISE) -> DataFrame:
    """(word, n, n_near, form, form_n, root), one row per word of ``docs``.

    Words: see ``word_counts``; those of at least ``least_length`` code
    points and ``least_count`` occurrences. ``n_near``: words one edit away
    (inserted, deleted or replaced code point). ``form``: of these the most
    frequent (ties: the least in code-point order), if it is at least
    ``ratio`` times as frequent as the word; else null, as ``form_n``.
    ``root``: the end of the chain of forms, the word itself without one.
    No documents, or null and empty texts alone, give no rows; other columns
    are ignored.

    Method: the index has a list for each variable-length gram (``decompose``,
    a dictionary pruned by frequency) and for what surrounds an edit that
    would leave no gram (``index_keys``); words that meet in a list are
    verified.
    """
    spark = docs.sparkSession
    at = scratch_path(spark, "spelling-words")
    counts = word_counts(docs, noise).filter((F.length("word") >= least_length) & (F.col("n") >= least_count))
    counts.write.parquet(at)
    words = spark.read.parquet(at)
    # a word costs far more than its bytes: tasks by the number of words, not by the size of the files
    words = words.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words.count() // TASK_WORDS)), "word")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best")
    near = checkpointed(near_pairs(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best))
    is_form = -F.col("best.n") >= ratio * F.col("n")
    near = near.select("word", "n_near", F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n"))
    last = roots(near.filter("form IS NOT NULL").select("word", "form"))
    whole = words.join(near, "word", "left").join(last, "word", "left")
    return whole.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))


#: DuckDB: words around each missing letter, joined; forms followed by recursion.
ORACLE_SQL = rf"""
WITH RECURSIVE {crc_sql.TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents),
hashed AS (
  SELECT run, n, {crc_sql.crc32("doc || ':' || run")} AS h
  FROM (SELECT doc, run, count(*) AS n FROM runs GROUP BY doc, run), crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN h % {NOISE} = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
gaps AS (SELECT DISTINCT word, left(word, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT x.word, y.word AS other FROM gaps x JOIN gaps y ON x.a = y.a AND x.b = y.b AND x.word <> y.word AND length(x.word) = length(y.word)
  UNION SELECT g.word, w.word FROM gaps g JOIN words w ON w.word = g.a || g.b
  UNION SELECT w.word, g.word FROM gaps g JOIN words w ON w.word = g.a || g.b),
ranked AS (
  SELECT p.word, p.n, q.word AS other, q.n AS other_n, count(*) OVER (PARTITION BY p.word) AS n_near,
    row_number() OVER (PARTITION BY p.word ORDER BY q.n DESC, q.word) AS place
  FROM near JOIN words p ON p.word = near.word JOIN words q ON q.word = near.other),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {RATIO} * w.n THEN other END AS form, CASE WHEN other_n >= {RATIO} * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
chains AS (
  SELECT word, word AS last, 0 AS steps FROM formed
  UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chains c JOIN formed f ON f.word = c.last WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near::BIGINT AS n_near, f.form, f.form_n, c.root
FROM formed f JOIN (SELECT word, arg_max(last, steps) AS root FROM chains GROUP BY word) c ON c.word = f.word
"""
