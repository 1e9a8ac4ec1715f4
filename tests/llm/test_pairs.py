"""Jaccard join, substring dedup and components against brute force."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import components, exchange, jaccard_join, substring_dedup, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def text(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus():
    """Clean texts, exact and near copies at many distances, a shared passage, and odd rows."""
    rng = random.Random(5)
    rows = [(i, text(rng, rng.choice([3, 12, 40, 90, 300]))) for i in range(40)]
    for i in (3, 7, 11, 15, 19):
        base = text(rng, 200, 5000).split()
        for k in range(8):
            copy = list(base)
            for _ in range(k):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
            rows.append((1000 + 100 * i + k, " ".join(copy)))
    passage = text(rng, 30, 9000)
    rows += [(5000 + i, f"{text(rng, 20)} {passage} {text(rng, 25)}") for i in range(12)]
    rows += [(6000, None), (6001, ""), (6002, " \t\n "), (6003, "one"), (6004, "One"), (6005, "one two three"), (6006, "é à ü ß é x"), (6007, "again " * 3000)]
    rows += [(6100, rows[0][1]), (6100, rows[0][1]), (6101, "long " + text(rng, 20000, 10**6)), (None, rows[1][1]), (None, "no id here at all, alone in the world")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns whose names the operators use themselves
    rows = [(i, t, "x", 1, "y", 2, b"z") for i, t in corpus()]
    return spark.createDataFrame(rows, "doc_id long, text string, class string, key int, shared string, component int, repeated binary").repartition(5)


def sets(rows, k):
    out = []
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        out.append((i, frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])))
    return out


def brute_components(rows, k=5, threshold=85):
    known = sets(rows, k)
    parent = list(range(len(known)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(known)):
        for b in range(a):
            x, y = known[a][1], known[b][1]
            if x and y and 100 * len(x & y) >= threshold * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(known):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted((d, len(s), least.get(root(i))) for i, (d, s) in enumerate(known) if d is not None), sorted(
        (len(s), least.get(root(i), -1)) for i, (d, s) in enumerate(known) if d is None
    )


@pytest.mark.parametrize("k, threshold", [(5, 85), (4, 85), (3, 80)])
def test_jaccard_components_equal_brute_force(docs, k, threshold):
    found = jaccard_join.jaccard_components(docs, k, threshold).collect()
    named, nameless = brute_components(corpus(), k, threshold)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found if r.doc_id is not None) == named
    assert sorted((r.n_shingles, -1 if r.component_id is None else r.component_id) for r in found if r.doc_id is None) == nameless
    assert len({c for _, _, c in named}) < len(named)


def test_jaccard_at_the_threshold(spark):
    base = [f"a{i}" for i in range(103)]  # 100 shingles
    over = base[:-1] + ["other"]  # one shingle differs on each side
    rows = [(1, " ".join(base)), (2, " ".join(over))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold, linked in ((98, True), (99, False)):
        out = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(df, k=4, threshold=threshold).collect()}
        assert (out[2] == 1) == linked


def test_chains_of_near_copies_link_through(spark):
    rng = random.Random(1)
    now, rows = text(rng, 120, 10**6).split(), []
    for i in range(30):
        now = list(now)
        now[rng.randrange(120)] = f"n{i}"
        rows.append((i, " ".join(now)))
    out = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)[0]


def test_families_around_the_threshold(spark):
    """Many variants of one text that link with some and not with others: pivots must not hide a link."""
    rng = random.Random(9)
    base, rows = text(rng, 150, 10**6).split(), []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randrange(1, 9)):
            copy[rng.randrange(150)] = f"v{rng.randrange(40)}"
        rows.append((i, " ".join(copy)))
    out = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)[0]


def test_rows_without_an_id_link_like_any_other(spark):
    """1 and 2 are linked by a row without a doc_id only; so are two nameless rows with each other."""
    rng = random.Random(12)
    middle = text(rng, 200, 10**6).split()
    left, right = list(middle), list(middle)
    left[20] = "left"
    right[150] = "right"
    rows = [(1, " ".join(left)), (None, " ".join(middle)), (2, " ".join(right)), (3, text(rng, 50, 10**6))]
    lonely = text(rng, 100, 10**6).split()
    rows += [(None, " ".join(lonely)), (None, " ".join([*lonely, "more"]))]
    for threshold, want in ((96, {1: 1, 2: 1, 3: 3}), (99, {1: 1, 2: 2, 3: 3})):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        found = jaccard_join.jaccard_components(df, 4, threshold).collect()
        named, nameless = brute_components(rows, 4, threshold)
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found if r.doc_id is not None) == named
        assert sorted((r.n_shingles, -1 if r.component_id is None else r.component_id) for r in found if r.doc_id is None) == nameless
        assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == want


def test_rows_of_one_id_and_none_are_dealt_out(spark):
    rng = random.Random(13)
    base = text(rng, 80, 10**6).split()
    rows = []
    for i in range(1200):
        copy = list(base) if i % 3 == 0 else text(rng, 40, 10**6).split()
        copy[rng.randrange(len(copy))] = f"n{rng.randrange(30)}"
        rows.append((7 if i % 2 else None, " ".join(copy)))
    rows.append((3, " ".join(base)))
    found = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 4, 85).collect()
    linked = [r for r in found if r.component_id == 3]
    assert len(found) == 1201 and len(linked) == 401 and max(r.n_links for r in linked) >= 2
    assert {r.component_id for r in found if r.doc_id == 7} == {3, 7}


def test_sketches_bound_the_symmetric_difference():
    import pyarrow as pa

    rng = random.Random(3)
    base = text(rng, 300, 10**6).split()
    texts = [" ".join(w if rng.random() > p else f"x{rng.random()}" for w in base) for p in (0, 0, 0.01, 0.05, 0.3, 1)] + ["", None, "one"]
    sets, offsets = jaccard_join.shingle_sets(pa.array(texts), 4)
    sketches = jaccard_join.dense_sketches(sets, offsets)
    of = [set(sets[offsets[i] : offsets[i + 1]].tolist()) for i in range(len(texts))]
    for i in range(len(texts)):
        for j in range(len(texts)):
            differ = sum(bin(int(a ^ b) & (2**64 - 1)).count("1") for a, b in zip(sketches[i], sketches[j]))
            assert differ <= len(of[i] ^ of[j]) and (differ - len(of[i] ^ of[j])) % 2 == 0


def test_wide_sketches_bound_the_symmetric_difference():
    rng = np.random.default_rng(8)
    whole = np.unique(rng.integers(0, 2**63, 9000, dtype=np.uint64))
    picked = [whole[:n] for n in (1, 300, 511, 512, 513, 1000, 1025, 4000, 4096, 8999)] + [np.delete(whole[:4200], slice(0, 900, 9)), whole[4000:8200]]
    offsets = np.r_[0, np.cumsum([len(x) for x in picked])]
    sketches = jaccard_join.wide_sketches(np.concatenate(picked), offsets, np.arange(len(picked)))
    for x, a in zip(picked, sketches):
        assert max(512, len(x)) <= 8 * len(a) < max(513, 2 * len(x))
        for y, b in zip(picked, sketches):
            assert jaccard_join.sketch_distance(a, b) == jaccard_join.sketch_distance(b, a) <= len(np.setxor1d(x, y))
    assert jaccard_join.sketch_distance(sketches[-1], sketches[-2]) > 2000  # long sets apart are seen to be


def test_filter_holds_all_its_classes(spark):
    rng = np.random.default_rng(9)
    own = np.r_[rng.integers(-(2**63), 2**63 - 1, 3000), -1, 0, 63, 64, -(2**63), 2**63 - 1]
    held = jaccard_join.class_filter(spark.createDataFrame([(int(c),) for c in own], "class long"))
    assert jaccard_join._in_filter(held, own).all()
    assert jaccard_join._in_filter(held, rng.integers(-(2**63), 2**63 - 1, 10000)).mean() < 0.01
    assert not jaccard_join._in_filter(jaccard_join.class_filter(spark.createDataFrame([], "class long")), own).any()


def test_long_texts_that_share_a_passage_are_not_compared_whole(spark, monkeypatch):
    """Their sketches of 512 bits say nothing; as many pairs as the square of their number would move their texts."""
    rng = random.Random(10)
    passage = text(rng, 400, 10**6)
    rows = [(i, f"{text(rng, 2600, 10**6)} {passage}") for i in range(30)]
    near = rows[0][1].split()
    near[5::100] = ["other"] * len(near[5::100])
    rows.append((100, " ".join(near)))
    compared, put = [], components.Stages.put

    def counted(self, name, df):
        out = put(self, name, df)
        if name == "told":
            compared.append(out.count())
        return out

    monkeypatch.setattr(components.Stages, "put", counted)
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()}
    assert found == {i: 0 if i == 100 else i for i, _ in rows}
    assert sum(compared) == 1


def test_tables_leave_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    blocks = lambda: {x.name() for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllBlocks()) if x.isShuffle()}
    setting, before = spark.conf.get(components.CLEANUP), blocks()
    stages = components.Stages(spark)
    rows = stages.put("rows", spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("c")))
    rows = stages.put("rows", rows.join(rows.groupBy("c").agg(F.min("k").alias("least")), "c"))
    until = time.monotonic() + 10  # files may go in the background
    while (left := blocks() - before) and time.monotonic() < until:
        time.sleep(0.1)
    assert not left and spark.conf.get(components.CLEANUP) == setting
    assert rows.count() == 700
    stages.drop("rows")


def test_no_folder_is_left_over(spark):
    """What the rounds wrote is gone; what the result reads goes with the process."""
    from strata import session

    before = set(session._scratch)
    docs = spark.createDataFrame([(i, t) for i, t in corpus()[:60]], "doc_id long, text string")
    jaccard_join.jaccard_components(docs).collect()
    from strata.sources.paths import path_exists

    left = [p for p in set(session._scratch) - before if path_exists(spark, p)]
    assert sorted(p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in left) in (["stage-labels", "stage-links", "stage-members"], ["stage-members"])


@pytest.mark.parametrize("run", [jaccard_join.jaccard_components, substring_dedup.remove_repeats])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pieces_leave_an_equal_one():
    for low, above in ((6, 9), (42, 63), (94, 141), (316, 474), (5000, 7500)):
        most, pieces, spare = jaccard_join._pieces(low, above, 85)
        assert most == 15 * (above - 1) // 85
        assert pieces - most >= (2 if above <= jaccard_join.PAIRED_BELOW else spare + 1)


def test_short_texts_with_words_added_and_dropped(spark):
    rng = random.Random(6)
    rows = []
    for f in range(12):
        base = text(rng, rng.randrange(8, 60), 10**6).split()
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                at = rng.choice([0, len(copy)])
                copy[at:at] = [f"x{rng.randrange(30)}"]
            rows.append((len(rows), " ".join(copy[rng.randrange(0, 3) :])))
    out = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)[0]


def brute_removed(rows, n=13):
    first = {}
    for d, t in rows:
        w = WORD.findall(t or "")
        if d is not None:
            for j in range(len(w) - n + 1):
                key = tuple(w[j : j + n])
                first[key] = min(d, first.get(key, d))
    out = []
    for d, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for j in range(len(w) - n + 1):
            if d is not None and first[tuple(w[j : j + n])] < d:
                gone[j : j + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((-1 if d is None else d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_substring_dedup_equals_brute_force(docs):
    found = substring_dedup.remove_repeats(docs).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found)
    assert got == brute_removed(corpus())
    for r in found:
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
        assert sum(b - a for a, b in r.removed) == r.n_removed


def test_substring_dedup_other_lengths(spark):
    rows = [(i, t) for i, t in corpus() if i is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring_dedup.remove_repeats(df, window=6, anchor=3, partitions=3).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == brute_removed(rows, 6)


def test_components_of_random_edges(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(50)]
    edges += [(None, 4), (7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in label:
        for a, b in edges:
            if a in label and b in label:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pack_keeps_any_numbers():
    for values in ([], [5], [-(2**63), 2**63 - 1], [10, 300, 70000], [2**40, 2**40 + 255]):
        a = np.array(values, np.int64)
        assert exchange.unpack(exchange.pack(a)).tolist() == values


def test_split_words():
    import pyarrow as pa

    ids, vocabulary, offsets = words.split_words(pa.array([" a  b\tA", None, "", "a\x0b\x0cé x "]), lower=True)
    assert [vocabulary[i].as_py() for i in ids] == ["a", "b", "a", "a", "é x"]
    assert offsets.tolist() == [0, 3, 3, 3, 5]
