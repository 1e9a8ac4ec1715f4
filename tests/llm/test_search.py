"""Spelling variants and nearest vectors against brute force."""

import heapq
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from strata.llm import multi_index, queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


# --- spelling variants

def edits_of(word, letters):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return (out | {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}) - {word}


def brute_variants(rows, least=5, noise=199):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}
    letters = sorted({c for w in words for c in w})
    form, out = {}, {}
    for w, n in words.items():
        near = [o for o in edits_of(w, letters) if o in words]
        best = min(near, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
        out[w] = (n, len(near), form[w], words[best] if form[w] else None)
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] += (root,)
    return out


def texts():
    rng = random.Random(9)
    parts = ["ab", "ra", "ca", "dé", "bra", "ÿx", "on", "tion", "al", "é", "ng", "i"]
    base = ["".join(rng.choice(parts) for _ in range(rng.randrange(3, 7))) for _ in range(150)]
    letters = "abcdeéÿ×÷"
    vocabulary = list(base)
    for w in base:
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(w))
            vocabulary.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]]))
    vocabulary += ["z" * n for n in range(4, 60)] + ["z" * n + "q" for n in range(6, 30)]
    rows = []
    for i in range(250):
        words = [vocabulary[int(len(vocabulary) * rng.random() ** 3)] for _ in range(60)]
        rows.append((i, " ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words)))
    rows += [(500 + i, " ".join("z" * n for n in range(4, 60))) for i in range(6)]
    rows += [(600 + i, "long" * 3000 + " internationalisation") for i in range(6)] + [(700 + i, "long" * 3000 + "e") for i in range(5)]
    rows += [(800, " ".join(["chainword"] * 200 + ["chainwird"] * 30 + ["chaunwird"] * 5))]  # a form of a form
    rows += [(None, "nothing nothing nothing nothing nothing nothin"), (1, None), (2, ""), (3, "1234 ; —"), (4, "same same"), (4, "same same"), rows[0], rows[0]]
    return rows


def test_variants_equal_brute_force(spark, monkeypatch):
    rows = texts()
    docs = spark.createDataFrame([(*r, "x", 1, "k") for r in rows], "doc_id long, text string, word string, n int, key string").repartition(5)
    want = brute_variants(rows)
    for bound in (32, 2):  # few lists end early, or nearly all do
        monkeypatch.setattr(spelling, "FREQUENT", bound)
        got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(docs).collect()}
        assert got == want
    assert any(v[1] > 1 for v in want.values()) and any(v[2] and v[2] != v[4] for v in want.values())


def test_variants_equal_sql(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    out = spelling.variants(docs)
    cols = sorted(out.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({spelling.ORACLE_SQL})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in out.select(cols).collect())


def test_lists_hold_every_pair_and_no_long_gram_list():
    """Any two words one edit apart meet in a list, whatever is frequent."""
    rng = random.Random(2)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(6, 12))) for _ in range(600)} | {"common" + "".join(rng.choice("abcdef") for _ in range(5)) for _ in range(300)}
    for bound in (1, 4, 40, 10**6):
        grams = Counter(g for w in words for g in {f"^{w}$"[i:j] for i in range(len(w) + 2) for j in range(i + 1, min(i + 8, len(w) + 2) + 1) if j - i < 8})
        frequent = frozenset(g for g, n in grams.items() if n > bound)
        lists = {w: set(spelling.index_keys(w, frequent, 8)) for w in words}
        for w in words:
            for s, e in spelling.decompose(w, frequent, 8):
                gram = f"^{w}$"[s:e]
                assert grams[gram] <= bound and all(gram[i:j] in frequent for i in range(len(gram)) for j in range(i + 1, len(gram) + 1) if j - i < len(gram))
            for o in edits_of(w, "abcdef") & words:
                assert lists[w] & lists[o], (bound, w, o)


def test_variants_of_nothing(spark):
    schema = "doc_id long, text string"
    assert spelling.variants(spark.createDataFrame([], schema)).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (None, ""), (2, "short words")], schema)).count() == 0


# --- nearest vectors

def brute_nearest(rows, nearest, every, dims):
    """[(query_id, rank, vec_id, score)], every query row against every other row."""
    ok = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (q, v) in enumerate(ok):
        if q is not None and q % every == 0:
            x = np.array(v)
            found = []
            for b, (i, w) in enumerate(ok):
                if a != b:
                    y = np.array(w)
                    found.append((-float(x @ y / np.sqrt((x @ x) * (y @ y))), i is None, i or 0, b))
            out += [(q, r + 1, None if none else i, -s) for r, (s, none, i, _) in enumerate(heapq.nsmallest(nearest, found))]
    return out


def clustered(n, dims, seed=4, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    return [(i, (centres[rng.integers(12)] + spread * rng.normal(size=dims)).tolist()) for i in range(n)]


def odd_vectors(dims=6):
    rows = clustered(400, dims)
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(2000, [2 * x for x in rows[3][1]])]  # copies, and the same direction
    rows += [(50, rows[50][1]), (50, rows[60][1]), (100, rows[100][1]), (100, rows[100][1])]  # repeated ids, same and other vectors
    rows += [(None, rows[7][1]), (None, None), (3000, None), (3050, []), (3100, [0.0] * dims), (3150, [1.0] * (dims - 1)), (3200, [1.0] * (dims + 1))]
    rows += [(3250, [1.0] * (dims - 1) + [float("nan")]), (3300, [1.0] * (dims - 1) + [float("inf")]), (3350, [1.0] * (dims - 1) + [None]), (3400, [1e-300] * dims), (3450, [1e300] * dims)]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", b"y") for i, v in rows], "vec_id long, embedding array<double>, cell int, key string, vector binary").repartition(4)


def test_whole_depth_equals_brute_force(spark, monkeypatch):
    rows = odd_vectors()
    monkeypatch.setattr(multi_index, "BLOCK_ENTRIES", 16)  # many blocks, hot cells over several
    monkeypatch.setattr(multi_index, "PACK_QUERIES", 3)
    scaled = [(i, v if v is None or not v or v[0] not in (1e-300, 1e300) else [1.0] * len(v)) for i, v in rows]
    want = brute_nearest(scaled, 5, 50, 6)
    got = [tuple(r) for r in multi_index.nearest_rows(table(spark, rows), 5, 50, recall=1.0).collect()]
    assert len(got) == len(want)
    rounded = lambda some: Counter((q, r, round(s, 9)) for q, r, _, s in some)
    assert rounded(got) == rounded(want)
    # ties of equal vectors go to the smaller ids
    ties = sorted((r, i) for q, r, i, s in got if q == 1000)
    assert [i for _, i in ties][:1] == [3] and all(i in {3, *range(1001, 1006), 2000} for _, i in ties)
    assert any(q == 3450 and i == 3400 and abs(s - 1) < 1e-12 for q, _, i, s in got)


@pytest.mark.parametrize("tile_blocks,tile_queries", [(1, 4), (5, 3), (1000, 10**6)])
def test_tiles_equal_brute_force(spark, monkeypatch, tile_blocks, tile_queries):
    """Blocks meet queries in tiles; neither the tiles' size nor slices of the queries change a row."""
    rows = clustered(400, 8, spread=0.5) + [(10**6 + 50 * i, [1.0] * 8) for i in range(12)]
    monkeypatch.setattr(multi_index, "BLOCK_ENTRIES", 16)
    monkeypatch.setattr(multi_index, "PACK_QUERIES", 3)
    monkeypatch.setattr(multi_index, "TILE_BLOCKS", tile_blocks)
    monkeypatch.setattr(multi_index, "TILE_QUERIES", tile_queries)
    found = multi_index.nearest_rows(table(spark, rows), 5, 50, recall=1.0)
    rounded = lambda some: Counter((q, r, round(s, 9)) for q, r, _, s in some)
    assert rounded(tuple(r) for r in found.collect()) == rounded(brute_nearest(rows, 5, 50, 8))
    # a join would write the entries of a block once for each pack of queries that meets it
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "FlatMapCoGroupsInArrow" in plan


def test_traversal_stops_at_the_depth():
    rng = np.random.default_rng(3)
    left, right = rng.random(60), rng.random(50)
    held = rng.integers(0, 3, 3000)
    order = sorted(np.flatnonzero(held).tolist(), key=lambda c: left[c // 50] + right[c % 50])
    for depth in (0, 1, 2, 150, 1999, 10**9):
        cells, covered = [], 0
        while covered < depth and len(cells) < len(order):
            cells.append(order[len(cells)])
            covered += held[cells[-1]]
        assert multi_index.traverse(left, right, held, depth) == cells


def test_recall_of_the_measured_depth(spark):
    rows = clustered(3000, 16, spread=0.15)
    got = {}
    for q, _, i, s in multi_index.nearest_rows(table(spark, rows), 5, 50).collect():
        got.setdefault(q, set()).add(i)
    want = {}
    for q, _, i, s in brute_nearest(rows, 5, 50, 16):
        want.setdefault(q, set()).add(i)
    assert got.keys() == want.keys()
    assert sum(len(got[q] & want[q]) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_traversal_is_in_order_of_distance():
    rng = np.random.default_rng(1)
    left, right = rng.random(7), rng.random(5)
    held = rng.integers(0, 3, 35)
    cells = multi_index.traverse(left, right, held, 10**9)
    sums = [left[c // 5] + right[c % 5] for c in cells]
    assert sums == sorted(sums) and set(cells) == set(np.flatnonzero(held).tolist())
    some = multi_index.traverse(left, right, held, 9)
    assert some == cells[: len(some)] and held[some].sum() >= 9 > held[some[:-1]].sum()


def test_blocks_hold_bounded_shares():
    held = np.array([5, 0, 3, 4, 100, 2, 9, 30, 1])
    start, parts = multi_index.blocks_of(held, 10)
    filled = Counter()
    for size, first, n in zip(held, start, parts):
        for k in range(n):
            filled[int(first) + k] += size / n
    assert max(filled.values()) <= 10 and parts.tolist() == [1, 1, 1, 1, 10, 1, 1, 3, 1]


@pytest.mark.parametrize("rows", [[], [(None, None)], [(50, [1.0, 0.0])], [(1, [1.0])], [(50, [0.0, 0.0]), (0, None)]])
def test_no_neighbours(spark, rows):
    assert multi_index.nearest_rows(table(spark, rows), 5, 50).count() == 0


def test_query_on_the_table(spark):
    out = queries.op13_nearest_vectors(spark, "/root/testdata/sf0.001").collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    want = {(q, r): s for q, r, _, s in brute_nearest(rows, 5, 50, len(rows[0][1]))}
    assert {(r.query_id, r["rank"]) for r in out} == set(want)
    assert sum(abs(want[r.query_id, r["rank"]] - r.score) < 1e-9 for r in out) >= 0.9 * len(want)
