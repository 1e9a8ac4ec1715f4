"""Conversation structure repair: weighted CYK parsing of turns, the cheapest edits to a legal dialogue."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import crc_sql
from strata.session import scratch_path

#: Costs of the edits; a truncated turn that stays adds one.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows that one task parses as one span before it passes them on.
SEGMENT_ROWS = 4096
#: Spans up to this length are parsed once for each pattern of turns.
SHARED = 8
BLANKS = " \t\n\x0b\x0c\r"
#: One row of each dialogue, ordered: rows without a turn first, ties by role and the text's digest.
_KEYS = ("conv", "dated", "turn", "role", "digest")

Cell = dict[tuple[int, int], tuple[int, str]]

# The grammar, over phases of a legal dialogue (s?(ua)+)?: 0 before its first
# turn, 1 after the system turn, 2 after a user turn, 3 after an assistant
# turn. [p q] derives the turns that lead from p to q:
#   S -> [0 0] | [0 3]     [p q] -> [p r] [r q]     [p q] -> one row, edited
# The insertion closure holds what derives no row at all.
_CLOSURE: Cell = {(p, p): (0, "") for p in range(4)} | {
    (0, 2): (INSERT, "I"), (0, 3): (2 * INSERT, "II"), (1, 2): (INSERT, "I"), (1, 3): (2 * INSERT, "II"), (2, 3): (INSERT, "I"), (3, 2): (INSERT, "I"),
}
_READ = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),), "o": ()}


def joined(a: Cell, b: Cell) -> Cell:
    """The cell of two spans one after the other: least (cost, audit) of each symbol.

    Audits of equal cost over the same rows never begin with one another (the
    longer one would hold more insertions), so the least of the parts gives
    the least of the whole.
    """
    found: Cell = {}
    for (p, r), (x, left) in a.items():
        for (s, q), (y, right) in b.items():
            if r == s:
                new = (x + y, left + right)
                if (p, q) not in found or new < found[p, q]:
                    found[p, q] = new
    return found


def row_cell(kind: str) -> Cell:
    """The cell of one row: ``x`` must go; else its role's initial (``o`` for others), upper case if truncated."""
    cell: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if kind != "x":
        stays = TRUNCATED if kind.isupper() else 0
        edits = [(pq, (stays, "K")) for pq in _READ[kind.lower()]]
        edits += [(pq, (REROLE + stays, "R")) for role in "ua" for pq in _READ[role]]
        for pq, new in edits:
            cell[pq] = min(cell.get(pq, new), new)
    return joined(joined(_CLOSURE, cell), _CLOSURE)


_ROWS = {kind: row_cell(kind) for kind in "xsuaoSUAO"}


def parse(kinds: str, known: dict[str, Cell]) -> Cell:
    """The cell of a span of rows, combined bottom-up from spans of doubling length.

    Every derivation of this grammar can be bracketed at any row (the phase
    there names both symbols), so a span needs one split only and the chart
    only its aligned spans. ``known`` keeps those of up to ``SHARED`` rows.
    """
    cells = []
    for i in range(0, len(kinds), SHARED):
        part = kinds[i : i + SHARED]
        if part not in known:
            known[part] = _combined([_ROWS[k] for k in part])
        cells.append(known[part])
    return _combined(cells)


def _combined(cells: list[Cell]) -> Cell:
    while len(cells) > 1:
        cells = [joined(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def stepped(phase: int, edit: str, kind: str) -> int:
    """The phase after an edit (I, K, R or D) of a row of ``kind``."""
    if edit == "D":
        return phase
    if edit == "K" and kind in "sS":
        return 1
    return 3 if phase == 2 else 2


def digest_of(text: Column) -> Column:
    return F.md5(F.encode(text, "UTF-8"))


def conv_key(conv_id: Column) -> Column:
    """A name for each dialogue; rows without a conv_id are one."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of ``turns``, each row hurt as the hash of its conv_id and turn says.

    Of 20 values 0 drops a row, 1 empties its text, 2 takes its full stops,
    exclamation and question marks, 3 repeats it, 4 makes it the user's.
    Null roles and texts become one space, as do nulls in what is hashed.
    """
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.encode(F.concat(one("conv_id"), F.lit(":"), one("turn")), "UTF-8")) % 20
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), one("role").alias("role"), one("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.filter("fate <> 0").withColumns({"text": text, "role": F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))})
    times = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("time", F.explode(times)).select("conv_id", "turn", "role", "text")


class Repair(NamedTuple):
    """``dialogues``: one row per dialogue; ``turns``: the repaired turns in order."""

    dialogues: DataFrame
    turns: DataFrame


def repair(turns: DataFrame) -> Repair:
    """The cheapest edits that make each dialogue an optional system turn, then user and assistant in turn.

    Rows are taken by turn (nulls first; ties by role, then by the md5 of the
    text); rows without a conv_id are one dialogue; null roles and texts
    count as one space; other columns are ignored. A row's first fault
    counts: blank (nothing but spaces and U+0009 to U+000D), duplicate (role
    and text seen earlier in the dialogue), truncated (its last other
    character is no full stop, exclamation or question mark). Edits: keep 0,
    rerole to user or assistant 2, delete 3 (a must for blank and duplicate
    rows), insert an empty user or assistant turn 2; a truncated row that
    stays adds 1. Of equal costs the least audit (initials of the edits).

    ``dialogues``: conv_id, gaps (turn numbers missing between the least and
    the greatest), blank, duplicate, truncated, illegal (neighbours whose
    roles' initials are none of su, ua, au), cost, audit. ``turns``: conv_id,
    position, edit, role, text. No rows, no rows in either.

    Method: equal rows become one with a count; rows are dealt in ranges of
    (dialogue, turn, role, digest), so a long dialogue is spread over many
    tasks. Each parses its segments (``parse``) without their texts; the
    cells of a dialogue's segments are combined in order, its audit is cut up
    again by segment, and each edit finds its text by the row's key.
    """
    spark = turns.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = scratch_path(spark, "repair")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    rows = turns.select(conv_key(F.col("conv_id")).alias("conv"), F.col("turn").isNotNull().alias("dated"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), role, text)
    rows = rows.withColumn("digest", digest_of(F.col("text")))
    rows.groupBy(*_KEYS).agg(F.count("*").alias("times"), F.first("text").alias("text")).write.parquet(f"{at}/rows")
    rows = spark.read.parquet(f"{at}/rows")

    tail = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    facts = rows.select(
        *_KEYS, "times", (tail == "").alias("blank"), (~F.right(tail, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
    )
    seen = rows.groupBy("conv", "role", "digest").agg(F.min(F.struct("dated", "turn")).alias("first"), F.count("*").alias("n"))
    seen = seen.filter("n > 1").drop("n")  # rows seen at one turn only need no look
    facts = facts.join(seen, ["conv", "role", "digest"], "left").withColumn("first", F.coalesce(F.col("first") == F.struct("dated", "turn"), F.lit(True)))
    facts = facts.select(*_KEYS, "times", "blank", "truncated", "initial", "first").repartitionByRange(partitions, *_KEYS).sortWithinPartitions(*_KEYS)
    facts.mapInArrow(_segments, _SEGMENT).write.parquet(f"{at}/segments")

    segments = spark.read.parquet(f"{at}/segments").withColumn("segment", F.xxhash64("conv", "start", "part"))
    parts = segments.drop("keys").repartition(partitions, "conv").sortWithinPartitions("conv", "start", "part")
    parts.mapInArrow(_folded, _FOLDED).write.parquet(f"{at}/folded")
    folded = spark.read.parquet(f"{at}/folded")
    conv_id = F.expr("CAST(substring(conv, 2) AS LONG)").alias("conv_id")
    conv_id = F.when(F.col("conv") != "", conv_id).alias("conv_id")
    dialogues = folded.filter("summary IS NOT NULL").select(conv_id, "summary.*")

    edits = folded.filter("summary IS NULL").select("conv", "segment", "phase", "position", "piece")
    edits = segments.select("conv", "segment", "kinds", "keys").join(edits, ["conv", "segment"]).mapInArrow(_edits, _EDIT)
    texts = rows.select(*_KEYS, "text")
    kept = edits.join(texts, list(_KEYS), "left")
    text = F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text")
    return Repair(dialogues, kept.select(conv_id, "position", "edit", F.coalesce("new_role", "role").alias("role"), text))


def repaired_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of each dialogue's ``role:text`` lines, joined by newlines, from the turns of ``repair``.

    The hash runs through a dialogue from its first turn to its last: the
    turns of one dialogue pass through one task, one batch at a time.
    """
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = turns.select(conv_key(F.col("conv_id")).alias("conv"), "conv_id", "position", "role", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_lines() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv", "conv_id", "role", "text")))

        for _, of in groupby(all_lines(), key=lambda line: line[0]):
            total = None
            for _, conv_id, role, text in of:
                if total is None:
                    total = hashlib.sha256()
                else:
                    total.update(b"\n")
                total.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_pydict({"conv_id": pa.array([conv_id], pa.int64()), "sha256": [total.hexdigest()]})

    return lines.repartition(partitions, "conv").sortWithinPartitions("conv", "position").mapInArrow(hashed, "conv_id long, sha256 string")


_KEY = "struct<dated: boolean, turn: long, role: string, digest: string>"
_COUNTS = "blank long, duplicate long, truncated long, illegal long"
_SEGMENT = (
    f"conv string, start {_KEY}, part int, kinds string, initials string, {_COUNTS}, low long, high long, turns long, last long,"
    f" cells array<struct<p: int, q: int, cost: long, audit: string>>, keys array<struct<dated: boolean, turn: long, role: string, digest: string, times: long>>"
)
_FOLDED = f"conv string, segment long, phase int, position long, piece string, summary struct<gaps: long, {_COUNTS.replace(' long', ': long')}, cost: long, audit: string>"
_EDIT = "conv string, dated boolean, turn long, role string, digest string, position long, edit string, new_role string"
_KEY_TYPE = pa.struct([("dated", pa.bool_()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.string())])
_SEGMENT_TYPE = pa.schema([
    ("conv", pa.string()), ("start", _KEY_TYPE), ("part", pa.int32()), ("kinds", pa.string()), ("initials", pa.string()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("last", pa.int64()),
    ("cells", pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
    ("keys", pa.list_(pa.struct([*_KEY_TYPE, pa.field("times", pa.int64())]))),
])
_SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
_SUMMARY_TYPE = pa.struct([(c, pa.string() if c == "audit" else pa.int64()) for c in _SUMMARY])
_FOLDED_TYPE = pa.schema([("conv", pa.string()), ("segment", pa.int64()), ("phase", pa.int32()), ("position", pa.int64()), ("piece", pa.string()), ("summary", _SUMMARY_TYPE)])
_EDIT_TYPE = pa.schema([("conv", pa.string()), *_KEY_TYPE, ("position", pa.int64()), ("edit", pa.string()), ("new_role", pa.string())])
LEGAL = ("su", "ua", "au")


def _rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterable[dict], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to parsed segments: the rows of one dialogue in this task, ``SEGMENT_ROWS`` at a time."""
    known: dict[str, Cell] = {}

    def portions(rows: Iterable[dict]) -> Iterator[tuple[dict, int, int]]:
        """(row, copies before, copies) of at most ``SEGMENT_ROWS`` copies."""
        for row in rows:
            for done in range(0, row["times"], SEGMENT_ROWS):
                yield row, done, min(SEGMENT_ROWS, row["times"] - done)

    def closed(held: list[tuple[dict, int, int]]) -> dict:
        kinds, initials, counts = [], [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for row, done, n in held:
            initials.append(row["initial"] * n)
            fresh = int(row["first"] and not done and not row["blank"])
            kinds.append((row["initial"].upper() if row["truncated"] else row["initial"]) * fresh + "x" * (n - fresh))
            counts["blank" if row["blank"] else "duplicate"] += n - fresh
            counts["truncated"] += fresh * row["truncated"]
        kinds, initials = "".join(kinds), "".join(initials)
        turns = [row["turn"] for row, _, _ in held if row["dated"]]
        first, done, _ = held[0]
        key = {c: first[c] for c in _KEYS[1:]}
        return counts | {
            "conv": first["conv"], "start": key, "part": done // SEGMENT_ROWS, "kinds": kinds, "initials": initials[0] + initials[-1], "illegal": _illegal(initials),
            "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns)), "last": turns[-1] if turns else None,
            "cells": [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in parse(kinds, known).items()],
            "keys": [{c: row[c] for c in _KEYS[1:]} | {"times": n} for row, _, n in held],
        }

    def segments() -> Iterator[dict]:
        for _, rows in groupby(_rows_of(batches), key=lambda row: row["conv"]):
            held, size = [], 0
            for portion in portions(rows):
                if held and size + portion[2] > SEGMENT_ROWS:
                    yield closed(held)
                    held, size = [], 0
                held.append(portion)
                size += portion[2]
            yield closed(held)

    return _batches(segments(), _SEGMENT_TYPE)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments of a dialogue in order to its summary, and each segment's part of the audit."""

    def dialogue(conv: str, of: Iterable[dict]) -> Iterator[dict]:
        ways = {0: (0, "")}  # by phase after the segments so far
        total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        low = high = last = None
        turns, before, names = 0, "", []
        for s in of:
            new: dict[int, tuple[int, str]] = {}
            for c in s["cells"]:
                if c["p"] in ways:
                    cost, audit = ways[c["p"]]
                    way = (cost + c["cost"], audit + c["audit"])
                    new[c["q"]] = min(new.get(c["q"], way), way)
            ways = new
            for c in total:
                total[c] += s[c]
            total["illegal"] += bool(before) and before + s["initials"][0] not in LEGAL
            before = s["initials"][-1]
            if s["low"] is not None:
                turns += s["turns"] - (s["low"] == last)
                low, high, last = s["low"] if low is None else low, s["high"], s["last"]
            names.append((s["segment"], s["kinds"]))
        cost, audit = min(ways[q] for q in (0, 3) if q in ways)
        gaps = 0 if low is None else high - low + 1 - turns
        yield {"conv": conv, "summary": total | {"gaps": gaps, "cost": cost, "audit": audit}}
        at = phase = position = 0
        for i, (segment, kinds) in enumerate(names):
            start, then, made, row = at, phase, position, 0
            while at < len(audit) and (row < len(kinds) or i + 1 == len(names)):
                edit = audit[at]
                phase = stepped(phase, edit, kinds[row] if edit != "I" else "")
                row += edit != "I"
                position += edit != "D"
                at += 1
            yield {"conv": conv, "segment": segment, "phase": then, "position": made, "piece": audit[start:at]}

    rows = groupby(_rows_of(batches), key=lambda s: s["conv"])
    return _batches((out for conv, of in rows for out in dialogue(conv, of)), _FOLDED_TYPE)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that stay or are inserted, in their order; deleted ones give none."""

    def made() -> Iterator[dict]:
        for s in _rows_of(batches):
            keys = (key for key in s["keys"] for _ in range(key["times"]))
            phase, position, kinds = s["phase"], s["position"], iter(s["kinds"])
            for edit in s["piece"]:
                key, kind = (next(keys), next(kinds)) if edit != "I" else ({}, "")
                turn = "assistant" if phase == 2 else "user"
                phase = stepped(phase, edit, kind)
                if edit != "D":
                    new = {"conv": s["conv"], "position": position, "edit": edit, "new_role": None if edit == "K" else turn}
                    yield new | {c: key.get(c) for c in _KEYS[1:]}
                    position += 1

    return _batches(made(), _EDIT_TYPE, 4096)


def _add(way: str, cost: int | str, edit: str, line: str = "''") -> str:
    """SQL: a way (cost, audit, text) with one more edit."""
    return f"CASE WHEN {way} IS NOT NULL THEN {{'c': {way}.c + {cost}, 'a': {way}.a || '{edit}', 't': {way}.t || {line}}} END"


def _inserted(way: str, role: str) -> str:
    return _add(way, INSERT, "I", f"chr(10) || '{role}:'")


def _read(way: str, initial: str, role: str) -> str:
    """SQL: the row kept or reroled after a way."""
    stays = f"f.truncated * {TRUNCATED}"
    keep = f"CASE WHEN f.initial = '{initial}' THEN {_add(way, stays, 'K', 'chr(10) || f.role || chr(58) || f.text')} END"
    if initial == "s":
        return f"CASE WHEN NOT f.gone THEN {keep} END"
    new = _add(way, f"{REROLE} + {stays}", "R", f"chr(10) || '{role}:' || f.text")
    return f"CASE WHEN NOT f.gone THEN least({keep}, {new}) END"


#: DuckDB: row by row from left to right, the least way to each phase.
ORACLE_SQL = f"""
WITH RECURSIVE {crc_sql.TABLE},
fates AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc_sql.crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fate
  FROM conversations, crc_table),
hurt AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM fates, range(2) AS t(time) WHERE fate <> 0 AND (time = 0 OR fate = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM hurt),
faults AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier
  FROM placed),
facts AS (SELECT *, blank OR again AS gone, (cut AND NOT blank AND NOT again)::INT AS truncated FROM faults),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': ''}} AS w0, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS w1,
    {{'c': {INSERT}, 'a': 'I', 't': chr(10) || 'user:'}} AS w2, {{'c': {2 * INSERT}, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS w3
  FROM (SELECT DISTINCT conv_id FROM hurt)
  UNION ALL
  SELECT conv_id, i, w0, w1, least(w2, u0, u1, u3) AS w2, least(w3, a2, {_inserted("u0", "assistant")}, {_inserted("u1", "assistant")}) AS w3
  FROM (
    SELECT *, {_inserted("w0", "user")} AS u0, {_inserted("w1", "user")} AS u1, {_inserted("w3", "user")} AS u3, {_inserted("w2", "assistant")} AS a2
    FROM (
      SELECT w.conv_id, f.i, {_add("w.w0", DELETE, "D")} AS w0,
        least({_add("w.w1", DELETE, "D")}, {_read("w.w0", "s", "system")}) AS w1,
        least({_add("w.w2", DELETE, "D")}, {_read("w.w0", "u", "user")}, {_read("w.w1", "u", "user")}, {_read("w.w3", "u", "user")}) AS w2,
        least({_add("w.w3", DELETE, "D")}, {_read("w.w2", "a", "assistant")}) AS w3
      FROM walk w JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1))),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
    count_if(again AND NOT blank) AS duplicate, sum(truncated) AS truncated, count_if(earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM facts GROUP BY conv_id),
ends AS (SELECT w.conv_id, c.* EXCLUDE (conv_id), least(w.w0, w.w3) AS best FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
