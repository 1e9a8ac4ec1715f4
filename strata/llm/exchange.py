"""Which documents hold a key that other documents hold too.

One shuffle of packed (key, document) blocks. A task first combines its own
batch: of the documents of a batch that share a key only the least one goes
on, the others are settled on the spot. So a key held by a third of all
documents reaches its reducer as one entry per batch, and no group is ever
built in one place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_BLOCK = pa.schema([("part", pa.int32()), ("settled", pa.bool_()), ("keys", pa.binary()), ("docs", pa.binary())])
BLOCK_COLUMNS = "part int, settled boolean, keys binary, docs binary"
_FOUND = pa.schema([("doc_id", pa.int64()), ("keys", pa.binary())])
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Rows of a batch that goes back to Spark.
ROWS = 1 << 16


def pack(values: np.ndarray) -> bytes:
    """int64 values as offsets from the least, in the fewest bytes that hold them."""
    low = int(values.min()) if len(values) else 0
    span = (int(values.max()) - low) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if w == 8 or span < 1 << (8 * w))
    body = values.view(np.uint64) - np.array([low], np.int64).view(np.uint64)
    return bytes([width]) + np.int64(low).tobytes() + body.astype(f"<u{width}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    low = np.frombuffer(data, np.uint64, 1, 1)
    return (np.frombuffer(data, f"<u{data[0]}", offset=9).astype(np.uint64) + low).view(np.int64)


def _groups(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Entries sorted by key: (keys, docs, group of each entry, least and largest document by group)."""
    order = np.argsort(keys, kind="stable")
    keys, docs = keys[order], docs[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(keys)]))
    return keys, docs, keys[starts], group, np.minimum.reduceat(docs, starts), np.maximum.reduceat(docs, starts)


def _wanted(docs: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray, later: bool) -> np.ndarray:
    return docs > low[group] if later else (low != high)[group]


def _parts(spread: np.ndarray, parts: int) -> np.ndarray:
    """Equal shares of the 64-bit range, in its order."""
    return ((spread >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _blocks(part: np.ndarray, settled: bool, keys: np.ndarray, docs: np.ndarray) -> list[tuple[int, bool, bytes, bytes]]:
    """One row for each run of equal ``part``."""
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
    return [(int(part[a]), settled, keys[a:b].tobytes(), pack(docs[a:b])) for a, b in zip(cuts, np.r_[cuts[1:], len(part)].astype(int))]


def _batch(rows: list[tuple[int, bool, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pydict(dict(zip(_BLOCK.names, zip(*rows))), schema=_BLOCK)


def pairs(batch: pa.RecordBatch) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
    """(settled, keys, documents) of each block."""
    for settled, keys, docs in zip(*(batch.column(c).to_pylist() for c in ("settled", "keys", "docs"))):
        yield settled, np.frombuffer(keys, np.uint64), unpack(docs)


def _distinct(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, by document and then key."""
    order = np.lexsort((keys, docs))
    keys, docs = keys[order], docs[order]
    new = np.r_[True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])] if len(keys) else np.empty(0, bool)
    return keys[new], docs[new]


def shared_keys(
    rows: DataFrame,
    extract: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]],
    partitions: int,
    later: bool = False,
    as_rows: bool = False,
) -> DataFrame:
    """Blocks of (key, document) pairs: the keys of documents that another document holds too.

    ``extract`` turns a batch of ``rows`` into arrays (uint64 keys, int64
    documents). With ``later`` a document gets only the keys that a document
    of smaller id holds. Blocks are read with ``by_document``; ``as_rows``
    gives rows (key, doc_id) instead. A pair may come twice. A block is what one batch sends to one of the
    ``partitions`` reducers, which hold that share of the distinct
    (batch, key) pairs.
    """

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, docs in extract(batch):
                if not len(keys):
                    continue
                keys, docs, distinct, group, low, high = _groups(keys, docs)
                take = _wanted(docs, group, low, high, later)
                keys, docs = keys[take], docs[take]
                part = _parts(docs.view(np.uint64) * SPREAD, partitions)
                order = np.argsort(part, kind="stable")
                yield from _batch([*_blocks(_parts(distinct, partitions), False, distinct, low), *_blocks(part[order], True, keys[order], docs[order])])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bool, list] = {False: [], True: []}
        for batch in batches:
            for settled, keys, docs in pairs(batch):
                found[settled].append((keys, docs))
        if found[False]:
            keys, docs, _, group, low, high = _groups(*map(np.concatenate, zip(*found[False])))
            take = _wanted(docs, group, low, high, later)
            found[True].append((keys[take], docs[take]))
        if found[True]:
            keys, docs = _distinct(*map(np.concatenate, zip(*found[True])))
            if as_rows:
                for a in range(0, len(keys), ROWS):
                    some = slice(a, a + ROWS)
                    yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(docs[some])], ["key", "doc_id"])
                return
            part = _parts(docs.view(np.uint64) * SPREAD, partitions)
            order = np.argsort(part, kind="stable")
            yield from _batch(_blocks(part[order], True, keys[order], docs[order]))

    return rows.mapInArrow(combine, BLOCK_COLUMNS).repartitionById(partitions, "part").mapInArrow(reduce, "key long, doc_id long" if as_rows else BLOCK_COLUMNS)


def by_document(blocks: DataFrame, partitions: int) -> DataFrame:
    """(doc_id, keys), one row for each document of ``shared_keys``: its distinct keys, 8 bytes each."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(keys, docs) for batch in batches for _, keys, docs in pairs(batch)]
        if not found:
            return
        keys, docs = _distinct(*map(np.concatenate, zip(*found)))
        starts = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
        ends = np.r_[starts[1:], len(docs)]
        for a in range(0, len(starts), 4096):
            some = [keys[i:j].tobytes() for i, j in zip(starts[a : a + 4096], ends[a : a + 4096])]
            yield pa.RecordBatch.from_arrays([pa.array(docs[starts[a : a + 4096]]), pa.array(some, pa.binary())], schema=_FOUND)

    return blocks.repartitionById(partitions, "part").mapInArrow(gather, "doc_id long, keys binary")
