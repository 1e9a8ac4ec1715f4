"""Conversation repair: cells against every edit script, tables against DuckDB."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import duckdb
import pytest

from strata.llm import dialogue_repair, queries

SCHEMA = "conv_id long, turn long, role string, text string, conv string, segment long, part int, kinds string"


def legal(initials):
    turns = initials[1:] if initials.startswith("s") else initials
    return initials == "" or (len(turns) > 0 and turns == "ua" * (len(turns) // 2))


def brute(kinds):
    """Least (cost, audit) over every choice of edits, with up to two insertions before each row and at the end."""
    ways = {(0, "", "")}  # cost, audit, initials so far
    for kind in kinds:
        edits = [("D", 3, "")]
        if kind != "x":
            extra = int(kind.isupper())
            edits += [("K", extra, kind.lower())] + [("R", 2 + extra, r) for r in "ua"]
        ways = {(c + 2 * len(new) + cost, a + "I" * len(new) + edit, o + new + out) for c, a, o in ways for new in ("", "u", "a", "ua", "au") for edit, cost, out in edits}
    return min((c + 2 * len(new), a + "I" * len(new)) for c, a, o in ways for new in ("", "u", "a", "ua") if legal(o + new))


@pytest.mark.parametrize("length", [1, 2, 3])
def test_cells_equal_every_edit_script(length):
    every = ["".join(k) for k in itertools.product("xsuaoSUA", repeat=length)]
    for kinds in every if length < 3 else random.Random(1).sample(every, 25):
        cell = dialogue_repair.parse(kinds, {})
        assert min(cell[p] for p in ((0, 0), (0, 3)) if p in cell) == brute(kinds), kinds


def test_any_bracketing_gives_one_cell():
    rng = random.Random(3)
    for _ in range(30):
        kinds = "".join(rng.choice("xsuaoSUAO") for _ in range(rng.randrange(2, 40)))
        cut = rng.randrange(1, len(kinds))
        whole = dialogue_repair.parse(kinds, {})
        assert whole == dialogue_repair.joined(dialogue_repair.parse(kinds[:cut], {}), dialogue_repair.parse(kinds[cut:], {}))


def rows():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "cut off", " \t\n", "", "Ünïcode?", "a.b?c!", "end. \n", "x" * 200_000 + ".", None]
    out = []
    for conv in [*range(60), None]:
        for turn in rng.sample(range(-3, 30), rng.randrange(1, 12)) + [None] * rng.randrange(2):
            out.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", "", "User", None, "u"]), rng.choice(texts)))
    out += [(100, t, ["user", "assistant"][t % 2], "Same words.") for t in range(700)]  # all but two are duplicates
    out += [(101, t, ["system", "user", "assistant"][t % 3], f"Turn {t}.") for t in range(900)]
    out += [(102, 5, "user", "Ties."), (102, 5, "assistant", "Ties."), (102, 5, "user", "Ties."), (102, 5, "user", "Other.")]
    out += [(103, 7, "user", "Again and again.")] * 40
    # a dialogue of which every row is dropped
    gone = next(c for c in itertools.count(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0,)))
    out += [(gone, 0, "user", "Lost.")]
    rng.shuffle(out)
    return out


def query(spark, table, tmp_path, name):
    table.write.parquet(f"{tmp_path}/{name}/conversations.parquet")
    return queries.op11_dialogue_repair(spark, f"file:{tmp_path}/{name}")


def test_query_equals_duckdb(spark, tmp_path, monkeypatch):
    # short segments, so that dialogues run over several
    monkeypatch.setattr(dialogue_repair, "SEGMENT_ROWS", 16)
    table = spark.createDataFrame([(*r, "clash", 1, 2, "k") for r in rows()], SCHEMA).repartition(7)
    out = query(spark, table, tmp_path, "t")
    con = duckdb.connect()
    con.register("conversations", table.select("conv_id", "turn", "role", "text").toArrow())
    cols = sorted(out.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({dialogue_repair.ORACLE_SQL})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in out.select(cols).collect())
    lost = [r for r in out.collect() if r.conv_id is not None and r.conv_id >= 1000]
    assert [(r.cost, r.audit, r.repaired_sha256) for r in lost] == [(0, "", hashlib.sha256(b"").hexdigest())]


def test_hash_of_the_contract_in_sql():
    from strata.llm import crc_sql

    con = duckdb.connect()
    for s in ("", "12:3", " : ", "7:éàÿ÷×z"):
        got = con.execute(f"WITH {crc_sql.TABLE} SELECT {crc_sql.crc32('?::VARCHAR')} FROM crc_table", [s]).fetchone()[0]
        assert got == zlib.crc32(s.encode())


def test_repaired_turns_are_legal_and_whole(spark):
    table = spark.createDataFrame(rows(), "conv_id long, turn long, role string, text string")
    done = dialogue_repair.repair(table)
    audits = {r.conv_id: r.audit for r in done.dialogues.collect()}
    found = {}
    for r in done.turns.orderBy("position").collect():
        found.setdefault(r.conv_id, []).append(r)
    assert audits.keys() == {r[0] for r in rows()}
    for conv, of in found.items():
        assert [r.position for r in of] == list(range(len(of)))
        assert legal("".join(r.role[:1] for r in of))
        assert Counter(r.edit for r in of) == Counter(audits[conv].replace("D", ""))
        assert all(r.text == "" and r.role in ("user", "assistant") for r in of if r.edit == "I")


def test_empty_table(spark, tmp_path):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert query(spark, table, tmp_path, "e").count() == 0
    done = dialogue_repair.repair(table)
    assert done.dialogues.count() == done.turns.count() == 0


def test_a_long_dialogue_is_spread(spark):
    """One dialogue of most rows: its segments come from several tasks."""
    from pyspark.sql import functions as F

    table = spark.range(20_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("Turn "), "id", F.lit(".")).alias("text"))
    done = dialogue_repair.repair(table.repartition(4))
    row = done.dialogues.first()
    assert (row.cost, row.audit, row.gaps, row.illegal) == (0, "K" * 20_000, 0, 0)
    want = hashlib.sha256("\n".join(f"{['user', 'assistant'][i % 2]}:Turn {i}." for i in range(20_000)).encode()).hexdigest()
    assert dialogue_repair.repaired_digests(done.turns).first().sha256 == want
