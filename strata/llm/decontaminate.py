"""Benchmark decontamination: pigeonhole pieces, exact hits, Myers bit-parallel verification."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits allowed per character of an item, and the least length of an item that is searched.
ERROR_RATE = 0.05
LEAST_CHARS = 32
#: Characters of items searched in one pass over the documents (bounds what is sent to the tasks).
BLOCK_CHARS = 2_000_000
_MATCH = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])


def normalized(text: str | None) -> str:
    """Lower case, runs of white space as one space, none at the ends; null: empty."""
    return " ".join((text or "").lower().split())


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """(edit distance, end) of the substring of ``text`` nearest to ``pattern``; the first end if tied.

    Myers' bit-parallel search: a column of the distance matrix is two bit
    vectors (where it rises and where it falls), updated once per character.
    """
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    rise, fall, score = full, 0, len(pattern)
    best, end = score, 0
    for at, c in enumerate(text, 1):
        same = where.get(c, 0)
        diagonal = ((same & rise) + rise ^ rise) | same | fall
        up, down = fall | ~(diagonal | rise) & full, rise & diagonal
        score += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        same |= fall
        rise, fall = down | ~(same | up) & full, up & same
        if score < best:
            best, end = score, at
    return best, end


class Finder:
    """Finds items within their error budget in normalized texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(i, text, int(len(text) * rate)) for i, text in items]
        self.pieces = ahocorasick.Automaton()
        for k, (_, text, errors) in enumerate(self.items):
            cuts = [len(text) * j // (errors + 1) for j in range(errors + 2)]
            for a, b in zip(cuts, cuts[1:]):
                known = self.pieces.get(text[a:b], None)
                if known is None:
                    self.pieces.add_word(text[a:b], [(k, b)])
                else:
                    known.append((k, b))
        if self.items:
            self.pieces.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best match of each item within its budget."""
        places: dict[int, set[int]] = {}
        if self.items:
            for last, owners in self.pieces.iter(text):
                for k, b in owners:
                    places.setdefault(k, set()).add(last + 1 - b)  # where the item would start
        found = []
        for k, starts in places.items():
            item_id, item, errors = self.items[k]
            best, low, high = None, None, None
            windows = []
            for s in sorted(starts):
                a, b = max(0, s - errors), s + len(item) + errors
                if windows and a <= windows[-1][1] and b - windows[-1][0] < 4 * len(item):
                    windows[-1][1] = b
                else:
                    windows.append([a, b])
            for low, high in windows:
                exact = text.find(item, low, high)
                if exact >= 0:
                    best = (0, exact, exact + len(item))
                    break
                distance, end = best_match(item, text[low:high])
                if distance <= errors and (best is None or distance < best[0]):
                    # the same search backwards from the end gives the start
                    back = text[max(low, low + end - len(item) - errors) : low + end][::-1]
                    best = (distance, low + end - best_match(item[::-1], back)[1], low + end)
            if best:
                found.append((item_id, *best))
        return sorted(found)


def item_blocks(benchmark: DataFrame, least: int = LEAST_CHARS, block: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Normalized items of at least ``least`` characters, in blocks of about ``block`` characters.

    The number of blocks follows from the measured size of the table, so what
    is held by the driver and sent to tasks is bounded whatever its size.
    """
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // block)
    for k in range(count):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect()
        yield sorted((r.item_id, t) for r in rows if len(t := normalized(r.text)) >= least)


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, least: int = LEAST_CHARS, block: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, start, end): documents that hold a benchmark item, nearly or exactly.

    An item is found where some substring of the document is within
    ``floor(rate * length)`` edits (both normalized: lower case, single
    spaces); start and end are code points of the normalized text. One row
    per document row and item, its best match. Null and empty texts hold
    nothing; null items, items without an id and items shorter than
    ``least`` characters are not searched; rows that repeat an item id are
    searched each. Empty tables give no rows. Other columns are ignored.

    Method: an item with at most e edits keeps at least one of e + 1 pieces
    intact. All pieces are found in one pass over a text (Aho-Corasick);
    around each hit Myers' algorithm measures the distance of the whole item.
    No shuffle: blocks of items go to the documents.
    """
    out = None
    for items in item_blocks(benchmark, least, block):

        def scan(batches: Iterator[pa.RecordBatch], items: list = items) -> Iterator[pa.RecordBatch]:
            finder = Finder(items, rate)
            for batch in batches:
                rows = [(d, *m) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text")) for m in finder.find(normalized(t.as_py()))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _MATCH)], schema=_MATCH)

        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, "doc_id long, item_id long, distance int, start long, end long")
        out = found if out is None else out.union(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance int, start long, end long")
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, least: int = LEAST_CHARS, block: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, without those that hold a benchmark item (see ``matches``)."""
    for items in item_blocks(benchmark, least, block):

        def keep(batches: Iterator[pa.RecordBatch], items: list = items) -> Iterator[pa.RecordBatch]:
            finder = Finder(items, rate)
            for batch in batches:
                yield batch.filter(pa.array([not finder.find(normalized(t.as_py())) for t in batch.column("text")], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
