"""Quality classifier: interpolated modified Kneser-Ney character model of trusted text, perplexity per document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.blocks import BLOCK_ROWS, block_count, block_of, packed, unpacked
from strata.llm.components import checkpointed, typed
from strata.llm.words import mix, split_words, windows

ORDER = 4
#: Marks of the start and the end of a word.
START, END = "\x01", "\x02"
#: Probability below the unigrams: uniform over all code points.
FLOOR = 1 / 0x110000
#: Log perplexity above median + FENCE * (upper quantile - median) of trusted text is rejected.
UPPER_QUANTILE, FENCE = 0.99, 2.0
BIN = 0.001
WIDE_BIN = 0.05
#: Classes of length per doubling, to tell long trusted documents from short ones.
LENGTH_CLASSES = 4
#: Characters of whole texts that are taken apart at once (bounds a task's arrays).
CHUNK_CHARS = 1 << 18

#: Answers that a task packs by block at once.
ANSWERS = 1 << 16

_GRAMS = pa.schema([("block", pa.int64()), ("language", pa.string()), ("gram", pa.string()), ("count", pa.int64())])
_SCORES = pa.schema([("doc_id", pa.int64()), ("language", pa.string()), ("trusted", pa.bool_()), ("n_grams", pa.int64()), ("logp", pa.float64())])


def _word_grams(words: list[str], order: int) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """All n-grams of marked words: (the marked words in a row, key, place and word index of each n-gram)."""
    row = "".join(START * (order - 1) + w + END for w in words)
    codes = np.frombuffer(row.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    owner = np.repeat(np.arange(len(words)), sizes)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.repeat(np.cumsum(sizes + order - 1) - (sizes + order - 1), sizes) + within
    return row, windows(codes + np.uint64(1), order)[place], place, owner


def _text_grams(codes: np.ndarray, words: list[str], offsets: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, pa.DictionaryArray, np.ndarray]]:
    """All n-grams of some texts at a time, across the ends of words: (their characters, key of each n-gram, index of its text).

    The characters are a row for each distinct key, in the order of the dictionary.
    """
    letters = np.frombuffer("".join(w + END for w in words).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(sizes) - sizes
    length = np.diff(np.r_[0, np.cumsum(sizes[codes])][offsets])
    piece = np.cumsum(length) // CHUNK_CHARS
    cuts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    for a, b in zip(cuts, np.r_[cuts[1:], len(length)]):
        some = codes[offsets[a] : offsets[b]]
        n = sizes[some]
        at = np.repeat(starts[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        owner = np.repeat(np.arange(a, b), length[a:b])
        place = np.arange(len(at)) + (owner - a) * (order - 1)
        row = np.full(len(at) + (b - a) * (order - 1), ord(START), np.uint32)
        row[place + order - 1] = letters[at]
        keys = pa.array(windows(row.astype(np.uint64) + np.uint64(1), order)[place]).dictionary_encode()
        first = np.empty(len(keys.dictionary), np.int64)
        first[keys.indices.to_numpy()[::-1]] = place[::-1]
        yield row[first[:, None] + np.arange(order)], keys, owner


def _gram_keys(grams: list[str], order: int) -> np.ndarray:
    codes = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    return windows(codes, order)[::order]


def _by_language(table: pa.Table) -> Iterator[tuple[str, pa.Table]]:
    languages = table.column("language").to_pylist()
    where = np.array(languages, object)
    for language in sorted(set(languages)):
        yield language, table.take(pa.array(np.flatnonzero(where == language)))


def _text(table: pa.Table) -> pa.Array:
    column = table.column("text").combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _gram_rows(block: int, docs: pa.Table, trusted: pa.Table, order: int, across: bool) -> pa.Table:
    """A block's distinct n-grams by language, with their counts in trusted documents."""
    ids = trusted.column("doc_id").to_numpy()
    found: list[tuple[str, list[str], np.ndarray]] = []
    for language, rows in _by_language(docs):
        codes, vocabulary, offsets = split_words(_text(rows))
        if not len(codes):
            continue
        good = np.isin(rows.column("doc_id").fill_null(0).to_numpy(), ids) & rows.column("doc_id").is_valid().to_numpy()
        if across:
            names, keys, counts = [], [], []
            for chars, some, owner in _text_grams(codes, vocabulary.to_pylist(), offsets, order):
                names.append(chars)
                keys.append(some.dictionary.to_numpy())
                counts.append(np.bincount(some.indices.to_numpy(), weights=good[owner], minlength=len(chars)))
            _, first, index = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            row = np.concatenate(names)[first].tobytes().decode("utf-32-le")
            found.append((language, [row[p : p + order] for p in range(0, len(row), order)], np.bincount(index, weights=np.concatenate(counts)).astype(np.int64)))
            continue
        times = np.bincount(codes[np.repeat(good, np.diff(offsets))], minlength=len(vocabulary))
        row, keys, place, owner = _word_grams(vocabulary.to_pylist(), order)
        _, first, index = np.unique(keys, return_index=True, return_inverse=True)
        count = np.bincount(index, weights=times[owner], minlength=len(first)).astype(np.int64)
        found.append((language, [row[p : p + order] for p in place[first].tolist()], count))
    size = sum(len(g) for _, g, _ in found)
    return pa.table({
        "block": pa.array(np.full(size, block), pa.int64()),
        "language": pa.array([x for x, grams, _ in found for _ in grams], pa.string()),
        "gram": pa.array([g for _, grams, _ in found for g in grams], pa.string()),
        "count": pa.array(np.concatenate([c for *_, c in found]) if found else [], pa.int64()),
    })


def _packed_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, language, grams, logs): what a task has for a block, its n-grams in a row and their log probabilities."""

    def packed_rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).sort_by([("block", "ascending"), ("language", "ascending"), ("gram", "ascending")])
        block, language = rows.column("block").to_numpy(), rows.column("language").combine_chunks().dictionary_encode()
        named = language.combine_chunks() if isinstance(language, pa.ChunkedArray) else language
        code = named.indices.to_numpy()
        cuts = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (code[1:] != code[:-1])])
        ends = np.r_[cuts[1:], len(block)]
        grams, logs = rows.column("gram").to_pylist(), rows.column("logp").to_numpy()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(block[cuts]), named.dictionary.take(pa.array(code[cuts])),
                pa.array(["".join(grams[a:b]) for a, b in zip(cuts, ends)], pa.string()), pa.array([logs[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            ],
            ["block", "language", "grams", "logs"],
        )

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= ANSWERS:
            yield packed_rows(held)
            held, size = [], 0
    if held:
        yield packed_rows(held)


def _scores(docs: pa.Table, answers: pa.Table, trusted: pa.Table, order: int, across: bool) -> pa.Table:
    """Log probability and n-gram count of each document of a block."""
    known = dict(_by_language(answers))
    parts = []
    for language, rows in _by_language(docs):
        codes, vocabulary, offsets = split_words(_text(rows))
        total, size = np.zeros(rows.num_rows), np.zeros(rows.num_rows, np.int64)
        if len(codes):
            model = known[language]
            keys = _gram_keys(model.column("grams").to_pylist(), order)
            logs = np.frombuffer(b"".join(model.column("logs").to_pylist()), np.float64)
            by = np.argsort(keys)
            keys, logs = keys[by], logs[by]
            if across:
                for _, wanted, owner in _text_grams(codes, vocabulary.to_pylist(), offsets, order):
                    at = np.minimum(np.searchsorted(keys, wanted.dictionary.to_numpy()), len(keys) - 1)
                    total += np.bincount(owner, weights=logs[at][wanted.indices.to_numpy()], minlength=rows.num_rows)
                    size += np.bincount(owner, minlength=rows.num_rows)
            else:
                _, wanted, _, owner = _word_grams(vocabulary.to_pylist(), order)
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                word = np.bincount(owner, weights=logs[at], minlength=len(vocabulary))
                text = np.repeat(np.arange(rows.num_rows), np.diff(offsets))
                total = np.bincount(text, weights=word[codes], minlength=rows.num_rows)
                size = np.bincount(text, weights=np.bincount(owner, minlength=len(vocabulary))[codes], minlength=rows.num_rows).astype(np.int64)
        good = rows.column("doc_id").is_valid().to_numpy() & np.isin(rows.column("doc_id").fill_null(0).to_numpy(), trusted)
        parts.append(pa.table({"doc_id": rows.column("doc_id"), "language": rows.column("language"), "trusted": pa.array(good), "n_grams": pa.array(size), "logp": pa.array(total)}))
    return pa.concat_tables(parts)


def _discounts(counts: DataFrame) -> DataFrame:
    """Modified Kneser-Ney discounts by language, from the numbers of n-grams counted 1, 2, 3 and 4 times."""
    n = [F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def discount(i: int) -> Column:
        good = (F.col(f"n{i}") > 0) & (F.col("n1") > 0) & (F.col("n2") > 0)
        exact = i - (i + 1) * y * F.col(f"n{i + 1}") / F.nullif(F.col(f"n{i}"), F.lit(0))
        # too few n-grams for an estimate: half a count per step
        return F.when(good & (exact > 0), exact).otherwise(0.5 * i).alias(f"d{i}")

    return counts.groupBy("language").agg(*n).select("language", *(discount(i) for i in (1, 2, 3)))


def _probabilities(counts: DataFrame, order: int) -> DataFrame:
    """(language, gram, p): interpolated probability of each n-gram's last character after the others.

    ``counts`` has every n-gram that is asked for, with its count in trusted
    text (0: unseen). The count of a shorter n-gram is the number of distinct
    longer ones that end with it. All are joins and aggregates sharded by the
    n-gram; the groups of one context are bounded by the alphabet.
    """
    if order == 0:
        return None
    shorter = counts.groupBy("language", F.expr("substring(gram, 2)").alias("gram")).agg(F.sum((F.col("c") > 0).cast("long")).alias("c"))
    context = Window.partitionBy("language", F.expr(f"substring(gram, 1, {order - 1})"))
    c = F.col("c")
    with_context = counts.withColumns({"total": F.sum("c").over(context)} | {f"k{i}": F.sum((c == i if i < 3 else c >= 3).cast("long")).over(context) for i in (1, 2, 3)})
    known = with_context.join(_discounts(counts), "language")
    cut = F.when(c == 0, 0.0).when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))
    rest = sum((F.col(f"d{i}") * F.col(f"k{i}") for i in (1, 2, 3)), F.lit(0.0))
    if order == 1:
        lower = F.lit(FLOOR)
    else:
        below = _probabilities(shorter, order - 1).withColumnsRenamed({"gram": "suffix", "p": "below"})
        known = known.withColumn("suffix", F.expr("substring(gram, 2)")).join(below, ["language", "suffix"])
        lower = F.col("below")
    p = F.when(F.col("total") > 0, ((c - cut) + rest * lower) / F.col("total")).otherwise(lower)
    return known.select("language", "gram", p.alias("p"))


def perplexities(docs: DataFrame, labels: DataFrame, order: int = ORDER, block_docs: int = BLOCK_ROWS, across: bool = False) -> DataFrame:
    """(doc_id, language, trusted, n_grams, logp): log probability of every document, one row per input row.

    Trusted are documents labelled quality 1 and not toxic. A language's
    model is trained on all its trusted text: words with marks around them,
    n-grams of characters. ``across``: n-grams run on from word to word (one
    mark between them, start marks only before the text), so that the order
    of words counts. Documents go to blocks by a hash of their id and text,
    so that rows without an id, or with the same one, are dealt out too (one
    shuffle of the text, used twice); a block asks for its distinct n-grams
    once, counts come from the same rows, and each n-gram's probability goes
    back to the blocks that asked.
    """
    block = block_of("doc_id", block_count(docs.count(), block_docs), "text")
    docs = typed(docs, doc_id="bigint", lang="string", text="string")
    where = docs.filter("doc_id IS NOT NULL").select("doc_id", block).distinct()
    docs = packed(docs.select(block, "doc_id", F.coalesce("lang", F.lit("")).alias("language"), "text"))
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    good = where.join(good, "doc_id", "left_semi").select("block", "doc_id")  # every block that has rows of a trusted id

    def counted(key: tuple, d: pa.Table, t: pa.Table) -> pa.Table:
        rows = unpacked(d)
        return _gram_rows(key[0].as_py(), rows, t, order, across) if rows else pa.Table.from_pylist([], _GRAMS)

    grams = docs.groupBy("block").cogroup(good.groupBy("block")).applyInArrow(counted, "block long, language string, gram string, count long")
    # dealt by n-gram once, for the counts and for the answers: both uses read all columns, so that they share the
    # shuffle. An n-gram comes once from each block that holds it, so a frequent one is no hot key.
    grams = grams.filter("language IS NOT NULL AND gram IS NOT NULL").repartition("language", "gram")  # none is null; a join would ask
    counts = grams.groupBy("language", "gram").agg(F.sum(F.when(F.col("block") >= 0, F.col("count"))).alias("c"))
    model = _probabilities(counts, order).select("language", "gram", F.log("p").alias("logp"))
    asked = grams.join(model, ["language", "gram"])
    answers = asked.select("block", "language", "gram", "logp", "count").mapInArrow(_packed_answers, "block long, language string, grams string, logs binary")
    # the trusted ids travel with the answers: one right side for each block
    answers = answers.withColumn("trusted", F.lit(None).cast("long")).union(
        good.select("block", F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("binary"), "doc_id")
    )

    def scores(d: pa.Table, a: pa.Table) -> pa.Table:
        rows = unpacked(d)
        ids = a.column("trusted").drop_null().to_numpy()
        return _scores(rows, a.filter(a.column("grams").is_valid()), ids, order, across) if rows else pa.Table.from_pylist([], _SCORES)

    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scores, "doc_id long, language string, trusted boolean, n_grams long, logp double")


def _quantiles(rows: DataFrame, value: Column, q: float, name: str, width: float = BIN) -> DataFrame:
    """(language, ``name``): a quantile of a value, read off a histogram."""
    bins = rows.groupBy("language", F.round(value / width).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    whole = Window.partitionBy("language")
    running = bins.withColumns({"up_to": F.sum("n").over(whole.orderBy("bin")), "all": F.sum("n").over(whole)})
    return running.groupBy("language").agg((F.min(F.when(F.col("up_to") >= q * F.col("all"), F.col("bin"))) * width).alias(name))


def classify(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = UPPER_QUANTILE, fence: float = FENCE, block_docs: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, language, n_grams, perplexity, threshold, kept): the verdict on every row of ``docs``.

    Perplexity is per character (ends of words included), each after the
    characters before it, those of the words before too. A language's
    threshold comes from the quantiles of its trusted documents' log
    perplexity: median + ``fence`` * (upper quantile - median), so that text
    like the trusted is kept whatever its spread. The upper quantile is that
    of the longer half of them; as the mean of few n-grams varies more, the
    shorter half gives a quantile of (log perplexity - median) * sqrt(n-grams),
    and a document's limit is the wider of the two at its own length.
    Quantiles are read off histograms. Documents above it are rejected. A language
    without trusted text has no threshold and keeps all its documents. Null
    and empty texts have no perplexity and are rejected. A null lang is a
    language of its own (``""``). Rows that repeat a doc_id or have none are
    judged each by its own text (without an id never trusted). Empty tables
    give no rows; other columns are ignored.
    """
    scored = checkpointed(perplexities(docs, labels, order, block_docs, across=True))
    scored = scored.withColumn("surprise", F.when(F.col("n_grams") > 0, -F.col("logp") / F.col("n_grams")))
    good = scored.filter("trusted AND surprise IS NOT NULL").withColumn("length", F.floor(LENGTH_CLASSES * F.log2("n_grams")))
    middle = _quantiles(good, F.col("surprise"), 0.5, "median").join(_quantiles(good, F.col("length"), 0.5, "middle", 1), "language")
    good = good.join(middle, "language").withColumns({"long": F.col("length") >= F.col("middle"), "far": F.col("surprise") - F.col("median")})
    far = _quantiles(good.filter("long"), F.col("far"), quantile, "far")
    wide = _quantiles(good.filter("NOT long"), F.col("far") * F.sqrt("n_grams"), quantile, "wide", WIDE_BIN)
    limits = middle.join(far, "language").join(wide, "language", "left")
    scored = scored.join(limits, "language", "left")
    by_length = F.coalesce(F.col("wide"), F.lit(0.0)) / F.sqrt(F.greatest("n_grams", F.lit(1)))
    scored = scored.withColumn("limit", F.col("median") + F.when(F.col("far").isNotNull(), fence * F.greatest(F.col("far"), by_length, F.lit(0.0))))
    kept = F.col("surprise").isNotNull() & (F.col("limit").isNull() | (F.col("surprise") <= F.col("limit")))
    return scored.select("doc_id", "language", "n_grams", F.exp("surprise").alias("perplexity"), F.exp("limit").alias("threshold"), kept.alias("kept"))
