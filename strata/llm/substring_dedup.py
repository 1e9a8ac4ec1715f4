"""Substring dedup: seed on winnowed anchors, extend, remove later copies of long repeats."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import typed
from strata.llm.exchange import by_document, shared_keys
from strata.llm.words import chunks, hash_strings, sliding_min, split_words, windows, word_hashes

WINDOW_WORDS = 13
ANCHOR_WORDS = 7
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string()), ("removed", pa.list_(pa.list_(pa.int64())))])


def _window_keys(hashes: np.ndarray, offsets: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """For each window inside one text: its start, its text's index, its hash, its anchor.

    The anchor is the least hash among the ``anchor``-word runs of the window
    (winnowing): two equal windows have the same anchor wherever they stand.
    """
    n = max(0, len(hashes) - window + 1)
    start = np.arange(n)
    owner = np.searchsorted(offsets, start, side="right") - 1
    inside = start + window <= offsets[owner + 1] if n else np.empty(0, bool)
    seeds = sliding_min(windows(hashes, anchor), window - anchor + 1)
    return start[inside], owner[inside], windows(hashes, window)[inside], seeds[inside]


def _distinct(docs: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Drop runs of the same (document, key): windows that share an anchor follow each other."""
    return np.r_[True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])] if len(keys) else np.empty(0, bool)


def remove_repeats(docs: DataFrame, window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS, partitions: int | None = None) -> DataFrame:
    """Remove every word covered by a ``window``-word run that a document of smaller id holds too.

    Returns doc_id, n_words, n_removed, kept_sha256, kept_text (kept words
    joined by one space) and removed ([start, end) word ranges), one row per
    input row. Null and empty texts have no words and lose none. Texts
    shorter than a window lose none. Rows of a null doc_id lose none and
    take nothing from others (the order among them is undefined). Rows that
    repeat a doc_id count as one document: they lose only what smaller ids
    hold. Other columns of ``docs`` are ignored.

    Method: (1) each window's anchor is the least hash of its ``anchor``-word
    runs; anchors that several documents share are the seeds (one shuffle of
    anchors). (2) Around the seeds of a document the match is extended both
    ways to all windows with that anchor, and one shuffle finds those that a
    smaller document holds. (3) Their union gives the maximal repeats of at
    least ``window`` words, which are cut out. Windows are equal when their
    64-bit hashes and 64-bit anchors agree. Work is linear in the text: no
    pair of documents is ever formed.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = typed(docs, doc_id="bigint", text="string")

    def anchors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        keys, ids = [], []
        for part in chunks(batch):
            hashes, offsets = word_hashes(part.column("text"))
            _, owner, _, seeds = _window_keys(hashes, offsets, window, anchor)
            new = _distinct(owner, seeds)
            keys.append(seeds[new])
            ids.append(part.column("doc_id").to_numpy(zero_copy_only=False)[owner[new]])
        if keys:
            yield np.concatenate(keys), np.concatenate(ids)

    def extended(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        keys, ids = [], []
        for part in chunks(batch):
            hashes, offsets = word_hashes(part.column("text"))
            _, owner, full, seeds = _window_keys(hashes, offsets, window, anchor)
            bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
            doc_ids, shared = part.column("doc_id").to_numpy(zero_copy_only=False), part.column("shared")
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                found = np.frombuffer(shared[i].as_py(), np.uint64)
                hit = np.unique(full[a:b][np.isin(seeds[a:b], found)])
                keys.append(hit)
                ids.append(np.full(len(hit), doc_ids[i]))
        if keys:
            yield np.concatenate(keys), np.concatenate(ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                codes, vocabulary, offsets = split_words(part.column("text"))
                hashes = hash_strings(vocabulary)[codes] if len(codes) else np.empty(0, np.uint64)
                start, owner, full, _ = _window_keys(hashes, offsets, window, anchor)
                bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
                words, repeated = np.array(vocabulary.to_pylist(), object), part.column("repeated")
                rows = []
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    first, last = offsets[i], offsets[i + 1]
                    n, gone, ranges = int(last - first), None, []
                    if block := repeated[i].as_py():
                        hit = start[a:b][np.isin(full[a:b], np.frombuffer(block, np.uint64))] - first
                        edge = np.bincount(hit, minlength=n + 1) - np.bincount(hit + window, minlength=n + 1)[: n + 1]
                        gone = np.cumsum(edge[:n]) > 0
                        flip = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                        ranges = flip.reshape(-1, 2).tolist()
                    kept = codes[first:last] if gone is None else codes[first:last][~gone]
                    text = " ".join(words[kept].tolist())
                    rows.append((n, n - len(kept), hashlib.sha256(text.encode()).hexdigest(), text, ranges))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(x, f.type) for x, f in zip(zip(*rows), list(_KEPT)[1:]))], schema=_KEPT)

    def shared_by(rows: DataFrame, extract: Callable, name: str, later: bool = False) -> DataFrame:
        return by_document(shared_keys(rows, extract, partitions, later), partitions).withColumnRenamed("keys", name)

    # Both joins read the same rows with an id, so the text is shuffled once.
    known = docs.filter("doc_id IS NOT NULL")
    seeded = known.join(shared_by(known, anchors, "shared"), "doc_id")
    repeats = shared_by(seeded, extended, "repeated", later=True)
    nameless = docs.filter("doc_id IS NULL").withColumn("repeated", F.lit(None).cast("binary"))
    columns = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, removed array<array<long>>"
    return known.join(repeats, "doc_id", "left").union(nameless).mapInArrow(cut, columns)


#: DuckDB: every window with the least document that holds it, words outside the repeated ones joined again.
ORACLE_SQL = rf"""
WITH texts AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
runs AS (
  SELECT id, doc_id, i, words[i : i + {WINDOW_WORDS - 1}] AS run
  FROM (SELECT id, doc_id, words, unnest(range(1, len(words) - {WINDOW_WORDS - 2})) AS i FROM texts WHERE len(words) >= {WINDOW_WORDS})),
repeated AS (SELECT id, i FROM (SELECT id, doc_id, i, min(doc_id) OVER (PARTITION BY run) AS least FROM runs) WHERE least < doc_id),
gone AS (SELECT DISTINCT id, unnest(range(i, i + {WINDOW_WORDS})) AS i FROM repeated),
word AS (SELECT id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM texts WHERE len(words) > 0),
kept AS (SELECT id, string_agg(w, ' ' ORDER BY i) AS text, count(*) AS n FROM word ANTI JOIN gone USING (id, i) GROUP BY id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (id)
"""
