"""Delimited records that hold line breaks, read in parallel.

A quoted field may hold line breaks, so a line is not yet a record, and
where a split of a file begins inside such a field only the text before it
tells. ``multiLine`` reading solves that with one task per file. Here files
stay split: a first pass notes for every split how its lines leave the
quotes if it begins outside a quoted field, and how if inside. The notes of
a file's splits, one small row each, are chained on the driver; then each
split knows how it begins and joins its own lines to records, and only the
few records that cross a split's end are put together by a shuffle.

Quotes follow RFC 4180: a field is quoted if its first character is a
quote, a quote in it is doubled; other quotes are plain characters.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this module travel to the executors by value: they need Spark's Python, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NOTE = "file long, split long, lines long, out_ends boolean, in_ends boolean, out_opens boolean, in_closes boolean"
_PART = "file long, split long, seq long, first boolean, text string"
_PART_TYPE = pa.schema([("file", pa.int64()), ("split", pa.int64()), ("seq", pa.int64()), ("first", pa.bool_()), ("text", pa.string())])


def ends_inside(line: str, inside: bool, separator: str = ",") -> bool:
    """Whether a quoted field is open after ``line``, given whether one was before it."""
    at = 0
    while True:
        if not inside:  # at the start of a field
            if line.startswith('"', at):
                inside, at = True, at + 1
            else:
                at = line.find(separator, at) + 1
                if not at:
                    return False
                continue
        quote = line.find('"', at)
        if quote < 0:
            return True
        if line.startswith('"', quote + 1):
            at = quote + 2
            continue
        inside, at = False, line.find(separator, quote + 1) + 1
        if not at:
            return False


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, text): the lines of the files below ``path``, in order within a split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("text"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """The lines of a batch by (file, split)."""
    files, splits = (batch.column(c).to_numpy() for c in ("file", "split"))
    start = 0
    for end in [*((files[1:] != files[:-1]) | (splits[1:] != splits[:-1])).nonzero()[0] + 1, len(files)]:
        if end > start:
            yield (int(files[start]), int(splits[start])), batch.column("text").slice(start, end - start)
        start = end


def _notes(separator: str):
    def noted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}
        for batch in batches:
            for key, lines in _runs(batch):
                note = found.setdefault(key, [0, False, True, False, False])  # lines, ends from outside, from inside, opens, closes
                note[0] += len(lines)
                # a line without a quote changes nothing
                quoted = lines.filter(pc.match_substring(lines, '"'))
                for line in quoted.to_pylist():
                    note[1], note[2] = ends_inside(line, note[1], separator), ends_inside(line, note[2], separator)
                    note[3] |= note[1]
                    note[4] |= not note[2]
                # a carriage return within a line ends lines for Spark's own reader
                note[3] |= bool(pc.any(pc.match_substring_regex(quoted, "(?s)\r.")).as_py())
        rows = [{"file": f, "split": s} | dict(zip(("lines", "out_ends", "in_ends", "out_opens", "in_closes"), n)) for (f, s), n in found.items()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows)

    return noted


@dataclass
class Layout:
    """Where records cross lines and splits."""

    crossing_lines: bool = False
    #: (file, split) that begin inside a record -> the split where that record begins
    owners: dict[tuple[int, int], int] = field(default_factory=dict)
    #: (file, split) that hold a part of a record only
    partial: set[tuple[int, int]] = field(default_factory=set)


def layout(lines: DataFrame, separator: str = ",") -> Layout:
    """How the records of ``lines`` lie in their splits: one pass, one small row per split on the driver."""
    notes = sorted(lines.mapInArrow(_notes(separator), _NOTE).collect(), key=lambda n: (n["file"], n["split"]))
    found, inside, owner, before = Layout(), False, 0, None
    for n in notes:
        if n["file"] != before:
            inside, before = False, n["file"]
        here = (n["file"], n["split"])
        if inside:
            found.owners[here] = owner
            found.partial.add(here)
        if not inside or n["in_closes"]:
            owner = n["split"]
        found.crossing_lines |= inside or n["out_opens"]
        inside = n["in_ends"] if inside else n["out_ends"]
        if inside:
            found.partial.add((n["file"], owner))
    return found


def _parts(separator: str, found: Layout, whole: bool):
    """Lines to records, or to the parts of those that cross the ends of their split."""

    def of_split(key: tuple[int, int], batches: Iterator[list[tuple[str, bool]]]) -> Iterator[dict]:
        file, split = key
        inside, owner, held, seq = key in found.owners, found.owners.get(key), [], 0
        part = lambda: {"file": file, "split": split if owner is None else owner, "seq": split, "first": owner is None and not split and not seq, "text": "\n".join(held)}
        for lines in batches:
            for text, quoted in lines:
                held.append(text)
                inside = ends_inside(text, inside, separator) if quoted else inside
                if inside:
                    continue
                if owner is not None:  # the end of a record that began in another split
                    if not whole:
                        yield part()
                    owner = None
                elif whole:
                    record = "\n".join(held)
                    if record.strip():
                        yield {"file": file, "split": split, "seq": seq, "first": not split and not seq, "text": record}
                        seq += 1
                else:
                    seq += any(t.strip() for t in held)
                held = []
        if held and not whole:
            yield part()

    def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list]]:
        for batch in batches:
            for key, lines in _runs(batch):
                if whole or key in found.partial:
                    yield key, list(zip(lines.to_pylist(), pc.match_substring(lines, '"').to_pylist()))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for key, runs in groupby(lines_of(batches), key=lambda run: run[0]):
            for row in of_split(key, (lines for _, lines in runs)):
                held.append(row)
                if len(held) == 4096:
                    yield pa.RecordBatch.from_pylist(held, _PART_TYPE)
                    held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, _PART_TYPE)

    return parts


def records(lines: DataFrame, found: Layout, separator: str = ",") -> DataFrame:
    """(text, first): the records of ``lines``; ``first`` marks the first of each file.

    A field that is still open when its file ends closes there. Blank lines
    between records are none.
    """
    whole = lines.mapInArrow(_parts(separator, found, True), _PART).select("text", "first")
    if found.partial:
        tails = lines.mapInArrow(_parts(separator, found, False), _PART)
        pieces = F.array_sort(F.collect_list(F.struct("seq", "text")))  # the splits of one record
        joined = tails.groupBy("file", "split").agg(pieces.alias("p"), F.max("first").alias("first"))
        whole = whole.union(joined.select(F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"), "first"))
    return whole.select(F.regexp_replace("text", "\r$", "").alias("text"), "first")
