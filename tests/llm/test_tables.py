"""URL filters, source mix, chat formatting, quality rules and the pipeline."""

import itertools
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pytest

import corpus_pipeline
from strata.llm import chat, mix, quality_rules, url_rules


def in_duckdb(sql, **tables):
    """Rows of ``sql`` over DataFrames."""
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def assert_equal(df, sql, **tables):
    columns, want = in_duckdb(sql, **tables)
    assert sorted(columns) == sorted(df.columns)
    got = [tuple(r) for r in df.select(columns).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


# --- URL filters

URLS = [
    "http://a.net/x", "https://EXAMPLE.net/en/1", "https://www.example.net/de/1", "http://example.com/de/", "http://m.example.com/de/7?x=1#y", "http://example.com/den/",
    "http://x.org/fr/1", "http://xorg/fr/1", "http://org/fr/", "http://x.net", "http://x.net?a=/", "ftp://net/#", "no scheme", "", None, "://net/", "http://a/b://net/", "http://É.NET/",
]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(url):
    host, path = plain_parts(url)
    fits = [r for r in url_rules.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def test_fixed_rules_on_odd_urls(spark):
    pages = spark.createDataFrame([(i, u, "html", 1) for i, u in enumerate(URLS)] + [(None, URLS[0], None, None)], "page_id long, url string, host string, size int")
    labels = spark.createDataFrame([(0, 0, 1), (None, 0, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    out = url_rules.judge(pages, labels).collect()
    assert len(out) == len(URLS) + 1
    for r in out:
        url = URLS[0] if r.page_id is None else URLS[r.page_id]
        rule = plain_rule(url)
        assert (r.host, r.path) == plain_parts(url), url
        assert (r.rule, r.verdict) == ((rule.name, rule.verdict) if rule else (None, "allow")), url
    assert url_rules.judge(pages.limit(0), labels.limit(0)).count() == 0


def test_mined_rules_equal_counting(spark):
    """Every minimal token set of enough support and confidence, by enumeration, and the verdicts it gives."""
    rng = random.Random(5)
    hosts, paths = ["good", "farm", "pills", "news"], ["buy", "read", "talk"]
    rows = [(i, f"http://{rng.choice(hosts)}.test/{rng.choice(paths)}/{i}?{rng.choice(['id', 'ref'])}=1") for i in range(400)]
    bad = lambda u: "pills" in u or "farm" in u and "/buy/" in u
    marks = {i: int(not bad(u)) if rng.random() > 0.03 else rng.randrange(2) for i, u in rows if i % 2 == 0}
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, q, 0) for i, q in marks.items()], "doc_id long, quality int, toxic int")
    tokens = {r.page_id: frozenset(r.t) for r in pages.select("page_id", url_rules.tokens(pages["url"]).alias("t")).collect()}
    seen, blocked = Counter(), Counter()
    for i, q in marks.items():
        for n in range(1, len(tokens[i]) + 1):
            for c in itertools.combinations(sorted(tokens[i]), n):
                seen[c] += 1
                blocked[c] += q == 0
    good = {c: blocked[c] / seen[c] for c in seen if blocked[c] >= 8 and blocked[c] / seen[c] >= 0.8}
    minimal = {c for c, sure in good.items() if not any(set(d) < set(c) and good[d] >= sure for d in good)}
    rules = url_rules.mine(pages, labels, 0.02, 0.8, 8)
    assert {tuple(r.tokens) for r in rules.collect()} == minimal and ("h:pills",) in minimal
    out = {r.page_id: r for r in url_rules.judge(pages, labels, (), 0.02, 0.8, 8).collect()}
    for i, _ in rows:
        assert out[i].verdict == ("block" if any(set(c) <= tokens[i] for c in minimal) else "allow")


# --- mixing


def plain_targets(sizes):
    """Share, stop, share again, with exact fractions."""
    total, weight = sum(sizes.values()), {}
    for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode()))):
        weight[s] = (5, 2, 1)[k % 3]
    stopped = set()
    while True:
        free = [s for s in sizes if s not in stopped]
        rest = total - sum(3 * sizes[s] for s in stopped)
        target = {s: Fraction(3 * sizes[s]) if s in stopped else Fraction(rest * weight[s], sum(weight[x] for x in free)) for s in sizes}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            return target
        stopped |= above


def mixed(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2) for r in rows], "doc_id long, source string, text string, size int, key string, budget int")


def test_mix_shares_and_thresholds(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice(["b", "a", "é", "Z", None, "hot", "hot", "hot"]), "w " * rng.choice([0, 1, 5, 30, 200])) for i in range(1500)]
    rows += [(9000, "tiny", "one two"), (9001, "none", None), (9001, "none", ""), (None, "hot", "a b"), (3, "hot", "again and again")]
    df = mixed(spark, rows)
    out = mix.mix_sources(df).collect()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len(re.findall(mix.WORD, t or ""))
    targets, taken = plain_targets(sizes), Counter()
    most = Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - float(targets[r.source])) < 1e-6
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
    for s, target in targets.items():
        assert abs(taken[s] - target) <= most[s]
    again = mix.mix_sources(df.repartition(9)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    assert_equal(mix.mix_sources(df), mix.ORACLE_SQL, documents=df)
    assert mix.mix_sources(df.limit(0)).count() == 0


def test_mix_of_texts_without_words(spark):
    out = mix.mix_sources(mixed(spark, [(1, "a", None), (2, None, " ")])).collect()
    assert [(r.size, r.taken) for r in out] == [(0, 0), (0, 0)]


# --- chat

TALK = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi é"), (1, 2, "assistant", "Hello\nthere"), (1, 3, "user", None),
    (2, 5, "anna", "a"), (2, 1, "bob", "b"), (2, 3, "carl", ""), (2, 3, "carl", ""), (2, None, "anna", "first"), (2, 4, None, "who?"),
    (3, 0, "system", "alone"), (4, 0, None, "nobody"), (None, 0, "user", "no id"), (None, 1, "user", "no id"),
]


def plain_views(rows, part_turns):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn, role, text or ""))
    low = lambda x: (x is not None, x)
    out = []
    for conv, turns in talks.items():
        for speaker in {r for _, r, _ in turns if r not in (None, "system")}:
            parts = defaultdict(list)
            for t in sorted(turns, key=lambda t: (low(t[0]), low(t[1]), t[2])):
                parts[(t[0] or 0) // part_turns].append(t)
            for part, some in parts.items():
                text, mask, n = "", [], 0
                for _, role, body in some:
                    name = "assistant" if role == speaker else "user" if role is None else "system" if role == "system" else f"user name={role}"
                    text += f"<|im_start|>{name}\n"
                    start = len(text)
                    text += body + "<|im_end|>"
                    if role == speaker:
                        mask.append(f"{start}-{len(text)}")
                    text += "\n"
                out.append((conv, speaker, part, len(some), len(mask), text, ",".join(mask)))
    return sorted(map(str, out))


@pytest.mark.parametrize("part_turns", [512, 2])
def test_views_of_every_speaker(spark, part_turns):
    df = spark.createDataFrame([(*r, 1, "x") for r in TALK], "conv_id long, turn long, role string, text string, part int, speaker string")
    out = [tuple(r) for r in chat.perspectives(df, part_turns).collect()]
    assert sorted(map(str, out)) == plain_views(TALK, part_turns)
    assert chat.perspectives(df.limit(0)).count() == 0


def test_views_of_a_long_dialogue(spark):
    rows = [(1, t, f"p{t % 3}", f"turn {t}") for t in range(1500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = [tuple(r) for r in chat.perspectives(df).collect()]
    assert sorted(map(str, out)) == plain_views(rows, 512)
    assert_equal(chat.perspectives(df), chat.ORACLE_SQL, conversations=df)


# --- quality rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(runs)
    covered = {i + j for i, r in enumerate(runs) if times[r] > 1 for j in range(5)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_quality_rules_counts_and_thresholds(spark):
    rng = random.Random(11)
    prose = lambda n: " ".join(rng.choice(["alpha", "be", "c", "dé", "ee\u00a0e"]) + str(rng.randrange(500)) for _ in range(n))
    rows = [(i, rng.choice(["en", "fr"]), rng.choice(["a", "b", None]), prose(rng.randrange(5, 80))) for i in range(400)]
    rows += [(500 + i, "en", "a", " ".join(w + "%%#" for w in prose(40).split())) for i in range(5)]
    rows += [(600, None, "a", "x\n x\nx\n\n \n" + prose(30)), (601, "en", "a", "one two three four five " * 12), (602, "en", "a", None), (603, "en", "a", "\t\n "), (604, "fr", "b", " lead and trail \n" + prose(20) + " ")]
    rows += [(605, "en", "rare", prose(50)), (None, "en", "a", prose(30)), (7, "en", "a", prose(30)), (606, "en", "a", "again and on " * 7000)]
    df = spark.createDataFrame([(*r, 3, "m") for r in rows], "doc_id long, lang string, source string, text string, n int, metric string")
    out = quality_rules.judge(df)
    got = sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in out.collect())
    assert got == sorted(str((i, *plain_counts(t))) for i, _, _, t in rows)
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert not any(kept[500 + i] for i in range(5)) and kept[605]
    assert all(kept[r.doc_id] for r in out.filter("NOT base_failed").collect() if r.doc_id is not None and r.doc_id < 400)
    assert_equal(out, quality_rules.ORACLE_SQL, documents=df)
    assert quality_rules.judge(df.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [15, 30, 45])
def test_junk_in_a_source_does_not_let_itself_in(spark, percent):
    """A source with much junk beside clean ones; one that has more symbols by nature, and a small one, stay."""
    rng = random.Random(percent)

    def doc(symbols):
        words = [rng.choice(["plain", "words", "of", "a", "text", "here", "some"]) + str(rng.randrange(10**4)) for _ in range(60)]
        return " ".join(w if rng.random() > symbols else rng.choice("#$%&|<>") * 3 for w in words)

    rows = []
    for source, n in (("clean", 300), ("dirty", 200), ("code", 200), ("few", 5)):
        for _ in range(n):
            junk = source == "dirty" and rng.random() < percent / 100
            rows.append((len(rows), doc(0.85 if junk else 0.12 if source == "code" else 0.0), "en", source, int(junk)))
    out = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk int")).collect()}
    assert not any(out[i].kept for i, *_, junk in rows if junk)
    assert all(out[i].kept for i, _, _, source, junk in rows if not junk and source != "code")
    assert sum(out[i].kept for i, _, _, source, _ in rows if source == "code") > 150


def test_buckets_keep_order_and_precision(spark):
    values = list(range(200)) + [2**k + d for k in range(8, 50, 3) for d in (-1, 0, 1)]
    df = spark.createDataFrame([(v,) for v in values], "x long").withColumn("b", quality_rules.bucket("x").cast("long")).withColumn("low", quality_rules.least_of("b"))
    rows = sorted(df.collect())
    assert all(r.low <= r.x < r.low + max(1, r.low / 32) + 1 for r in rows)
    assert [r.b for r in rows] == sorted(r.b for r in rows)


# --- pipeline


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(12)
    prose = lambda n: " ".join("".join(rng.choice(["the", "an", "in", "er", "re", "ing", "o"]) for _ in range(rng.randrange(1, 5))) for _ in range(n))
    rows = [(i, prose(80), "en", f"s{i % 4}") for i in range(120)]
    copy = rows[3][1].split()
    rows += [(300, " ".join([*copy[:40], "changed", *copy[41:]]), "en", "s0"), (301, rows[5][1], "en", "s1")]
    item = prose(30)
    rows += [(302, f"{prose(30)} {item} {prose(30)}", "en", "s2"), (303, "$$%% ##&& " * 60, "en", "s1"), (304, None, "en", None)]
    rows += [(305, prose(5000) + " write to someone@mail.example.org soon", "en", "s3")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    at = str(tmp_path)
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    now, kept = spark.read.parquet(f"{at}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, at)
        assert now.columns == docs.columns
        now.write.parquet(f"{at}/{name}")
        now = spark.read.parquet(f"{at}/{name}")
        kept[name] = {r.doc_id: r.text for r in now.collect()}
    ids = {name: set(k) for name, k in kept.items()}
    clean = set(range(120))
    assert clean | {300, 301, 302, 305} == ids["quality"]
    assert ids["near_duplicates"] == clean | {302, 305}
    assert ids["decontamination"] == ids["personal_data"] == clean | {305}
    assert "<email>" in kept["personal_data"][305] and "someone@" not in kept["personal_data"][305]
    assert all(kept["personal_data"][i] == rows[i][1] for i in clean)
    last = corpus_pipeline.run(spark, at).collect()
    assert {r.doc_id for r in last} <= clean | {305} and all(0 < r.taken <= 3 * r.size for r in last)
    want = mix.mix_sources(now).filter("taken > 0").collect()
    assert sorted(map(str, last)) == sorted(map(str, want))


def test_near_duplicate_stage_links_from_80_percent(spark):
    base = [f"a{i}" for i in range(104)]  # 100 shingles of five words
    copy = lambda name, n: " ".join(f"{name}{w}" for w in base[: len(base) - n] + [f"b{i}" for i in range(n)])  # noqa: E731  n shingles differ on each side
    rows = [(1, copy("x", 0)), (2, copy("x", 10)), (3, copy("y", 0)), (4, copy("y", 12))]  # 90 of 110, 88 of 112
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [1, 3, 4]


def test_near_duplicate_stage_decides_row_by_row(spark):
    """One row of each group stays, where rows repeat an id or have none; no row without shingles goes."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyz")
    near = one + " more"
    rows = [
        (5, one, "a", 1), (5, one, "a", 1), (5, near, "b", 2), (None, one, "c", 3), (9, near, "d", 4),      # one group: one row of id 5 stays
        (None, two, "e", 5), (None, two, "e", 5), (None, two + " word", "f", 6),                             # one group without an id
        (5, three, "g", 7),                                                                                 # the same id, another text
        (5, None, "h", 8), (None, "", "i", 9), (None, "", "i", 9), (6, "  ", None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class string, component int").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted((tuple(r) for r in kept.collect()), key=str)
    alone = sorted((r for r in rows if not (r[1] or "").strip()), key=str)
    assert [r for r in got if not (r[1] or "").strip()] == alone
    named, nameless = [r for r in got if r[0] == 5 and r[1] and r[1].strip()], [r for r in got if r[0] is None and r[1]]
    assert len(named) == 2 and (5, three, "g", 7) in named and {r[1] for r in named} <= {one, near, three}
    assert len(nameless) == 1 and nameless[0][1].startswith(two) and len(got) == 3 + len(alone)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0
