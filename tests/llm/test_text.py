"""Decontamination, personal data, quality model, licence scan."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate, license_scan, pii, quality_model


def distance(pattern, text):
    """Least edit distance of the pattern to a substring, by the plain table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best


def test_best_match_equals_the_plain_table():
    rng = random.Random(3)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 80)))
        t = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 90)))
        got, end = decontaminate.best_match(p, t)
        assert got == distance(p, t)
        assert distance(p, t[:end]) == got


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        at = rng.randrange(len(text))
        text[at : at + 1] = rng.choice([[], ["#"], [text[at], "#"]])
    return "".join(text)


def test_matches_equal_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.randrange(12, 30))) for i in range(8)] + [(8, "too short"), (9, None), (None, prose(20)), (0, prose(15))]
    docs = [(i, prose(40)) for i in range(10)] + [(100, None), (101, ""), (None, items[1][1])]
    for k, (i, t) in enumerate(items[:8]):
        for n in (0, 2, 4, 6, 9):
            docs.append((1000 + 10 * k + n, f"{prose(10)}\n {edited(rng, t, n).upper()}  {prose(8)}"))
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, item_id int, distance int")
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.matches(d, b, block=300).collect()}
    want = set()
    for i, t in docs:
        for j, item in items:
            p = decontaminate.normalized(item)
            if j is not None and len(p) >= decontaminate.LEAST_CHARS:
                n = distance(p, decontaminate.normalized(t))
                if n <= int(len(p) * decontaminate.ERROR_RATE):
                    want.add((i, j, n))
    assert got == want and len(want) > 15
    for r in decontaminate.matches(d, b).filter("distance = 0 AND doc_id IS NOT NULL").collect():
        text = decontaminate.normalized(dict(docs)[r.doc_id])[r.start : r.end]
        assert text in [decontaminate.normalized(t) for j, t in items if j == r.item_id]
    kept = decontaminate.decontaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in {w[0] for w in want})


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    d = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert decontaminate.matches(d, none).count() == 0
    assert decontaminate.decontaminated(d, none).count() == 1
    assert decontaminate.matches(d.limit(0), spark.createDataFrame([(1, "x" * 50)], "item_id long, text string")).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card" and 14 <= len(digits) <= 19 and pii.passes_luhn(digits)
                or kind == "phone" and 10 <= len(digits) <= 15
            ):
                out.append((m.start(), n, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


def test_base_spans_equal_the_patterns():
    rng = random.Random(6)
    parts = ["a@b.c", "@", ".", "x-y_z%+@h.o-st.net", "4111111111111111", "4111 1111 1111 1111", "1.2.3.4", "256.1.1.1", "0255.1.1.001", "+1 (555) 010-9999", "+", "-", " ", "  ", "7", "é", "a", "555-0199", "a@b", "b.c@d.e@f.g"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))
        assert pii.base_spans(t) == plain_base(t), t


def test_base_spans_are_linear():
    for t in ("a" * 200_000 + "@", "1" * 200_000, "1 " * 100_000, "1." * 100_000, "+1" * 100_000, "@" * 100_000):
        pii.base_spans(t)


def personal(rng, i):
    phone = f"{rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    return f"call +1 ({phone} or write u{i}@mail.example.com from 10.0.{i % 250}.7 now"


def test_crf_carries_labels_to_repeated_numbers(spark):
    rng = random.Random(8)
    rows = [(i, personal(rng, i) + " and some plain words") for i in range(60)] + [(i, "nothing here, only words") for i in range(100, 160)]
    target = "reach +1 (743) 555-3824 in the day; at night the same 555-3824 will do; ask for room 12"
    rows += [(900, target), (901, "the plan of 1999 has 12 parts"), (902, None), (903, ""), (None, personal(rng, 5)), (900, target)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int")
    out = pii.find_spans(df).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id == 900:
            extra = [target[s.start : s.end] for s in r.spans if s not in r.base]
            assert extra == ["555-3824"] and {s.kind for s in r.spans} == {"phone"}
        if r.doc_id in (901, 902, 903):
            assert r.base == [] and r.spans == []
        assert all(s in r.spans for s in r.base)
    told = {r.doc_id: r for r in pii.digest(pii.find_spans(df)).collect()}
    base = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_base(target))
    assert told[900].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and told[900].n_phone == 1
    assert told[902].base_sha256 == hashlib.sha256(b"").hexdigest() and told[902].spans == ""
    again = pii.digest(pii.find_spans(df.repartition(7))).collect()
    assert sorted(map(str, again)) == sorted(map(str, pii.digest(pii.find_spans(df)).collect()))


def test_partly_overlapping_spans_are_masked_whole():
    text = "10.0.0.0 4111 1111 1111 1111"
    assert pii.base_spans(text) == [("ip", 0, 8), ("card", 7, 28)]
    assert pii.masked(text, pii.base_spans(text)) == "<ip>"
    assert pii.masked("a bcd ef", [("phone", 0, 5), ("card", 2, 4), ("ip", 6, 8)]) == "<phone> <ip>"
    assert pii.masked("abcd", [("ip", 0, 2), ("card", 2, 4)]) == "<ip><card>"


def test_masked_documents_keep_their_shape(spark):
    df = spark.createDataFrame([(1, "mail a@b.org now", 16, "s"), (2, None, None, None), (None, "plain", 5, "s")], "doc_id long, text string, n_chars long, source string")
    out = pii.mask_documents(df)
    assert out.schema == df.schema
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == "mail <email> now" and got[1].n_chars == len(got[1].text)
    assert got[2].text is None and got[None].text == "plain"
    assert pii.mask_documents(df.limit(0)).count() == 0


def test_belief_propagation_is_exact_on_a_chain():
    """Without loops the marginals equal sums over all labellings."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    w = pii.Potentials(rng.normal(size=(pii.FEATURES + 1, 5)), rng.normal(size=(5, 5)), 1.3)
    g = pii.Graph([(0, 0, 1)] * 4, [3, 17, 40, 64], [0, 2, 0, 0], [(0, 1), (2, 3)], [(1, 2)])
    local = pii.shape_matrix(np.array(g.shapes)) @ w.node
    total = np.zeros((4, 5))
    for labels in itertools.product(range(5), repeat=4):
        if labels[1] != 2:
            continue
        score = sum(local[i, k] for i, k in enumerate(labels) if i != 1) + sum(w.chain[labels[a], labels[b]] for a, b in g.chain) + sum(w.skip * (labels[a] == labels[b]) for a, b in g.skip)
        for i, k in enumerate(labels):
            total[i, k] += np.exp(score)
    assert np.allclose(pii.posteriors(g, w), total / total.sum(1, keepdims=True), atol=1e-3)


def brute_model(words, order):
    """Interpolated modified Kneser-Ney probabilities from dictionaries."""
    from collections import Counter

    counts = Counter()
    for w in words:
        row = "\x01" * (order - 1) + w + "\x02"
        counts.update(row[i : i + order] for i in range(len(row) - order + 1))
    tables = {order: counts}
    for k in range(order - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])

    def discounts(c):
        n = [sum(1 for v in c.values() if v == i) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0
        out = [0.0]
        for i in (1, 2, 3):
            exact = i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] and n[0] and n[1] else 0
            out.append(exact if exact > 0 else 0.5 * i)
        return out

    cuts = {k: discounts(c) for k, c in tables.items()}

    def p(gram):
        k = len(gram)
        if k == 0:
            return quality_model.FLOOR
        after = {g: v for g, v in tables[k].items() if g[:-1] == gram[:-1]}
        lower = p(gram[1:])
        if not after:
            return lower
        d, total, c = cuts[k], sum(after.values()), tables[k][gram]
        rest = sum(d[min(v, 3)] for v in after.values())
        return ((c - d[min(c, 3)]) + rest * lower) / total

    return p


def test_perplexity_equals_a_plain_model(spark):
    import math

    rng = random.Random(1)
    prose = lambda n: " ".join("".join(rng.choice("aabbcde") for _ in range(rng.randrange(1, 6))) for _ in range(n))
    rows = [(i, "en" if i % 3 else "fr", prose(20)) for i in range(30)] + [(50, "en", "ZZ!! Q"), (51, "xx", "abc"), (52, None, "abc"), (53, "en", None), (54, "en", " "), (None, "en", "abc de")]
    labels = [(i, 1, 0) for i in range(20)] + [(20, 1, 1), (21, 0, 0), (22, None, None), (None, 1, 0), (5, 1, 0)]
    d = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, lang string, text string, block int, language string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    trusted = {i for i, q, t in labels if q == 1 and not t and i is not None}
    models = {lang: brute_model([w for i, la, t in rows if la == lang and i in trusted for w in (t or "").split()], 3) for lang in ("en", "fr", "xx")}
    models[""] = models["xx"]
    got = quality_model.perplexities(d, lab, order=3).collect()
    assert len(got) == len(rows)
    texts = {(i, la or ""): t for i, la, t in rows}
    for r in got:
        t = texts[r.doc_id, r.language] or ""
        grams = ["".join(x) for w in t.split() for row in ["\x01\x01" + w + "\x02"] for x in zip(row, row[1:], row[2:])]
        assert r.n_grams == len(grams)
        assert math.isclose(r.logp, sum(math.log(models[r.language](g)) for g in grams), rel_tol=1e-9, abs_tol=1e-9)


def test_classifier_keeps_clean_text_and_rejects_noise(spark):
    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choice(["the", "an", "in", "er", "re", "ing"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    noise = lambda n: " ".join("".join(rng.choice("#$%&XQZ!") for _ in range(5)) for _ in range(n))
    rows = [(i, "en", prose(60)) for i in range(300)] + [(i, "en", noise(60)) for i in range(300, 330)] + [(400, "zz", noise(5)), (401, "en", ""), (402, "en", None)]
    d = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    lab = spark.createDataFrame([(i, 1, 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r.kept for r in quality_model.classify(d, lab).collect()}
    assert all(out[i] for i in range(300)) and not any(out[i] for i in range(300, 330))
    assert out[400] and not out[401] and not out[402]
    assert quality_model.classify(d.limit(0), lab).count() == 0
    assert all(r.kept for r in quality_model.classify(d, lab.limit(0)).filter("n_grams > 0").collect())


def test_perplexity_across_words_equals_a_plain_model(spark, monkeypatch):
    import math

    monkeypatch.setattr(quality_model, "CHUNK_CHARS", 150)
    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choice("aabbcdeé") for _ in range(rng.randrange(1, 6))) for _ in range(n))
    texts = {i: prose(15) for i in range(20)} | {30: "abc", 31: None, 32: " ", 33: "ZZ! a  b\n"}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("doc_id", "'en' AS lang", "text")
    lab = spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    whole = {i: "\x02".join((t or "").split()) for i, t in texts.items()}
    model = brute_model([whole[i] for i in range(12)], 3)
    for r in quality_model.perplexities(d, lab, order=3, across=True).collect():
        row = "\x01\x01" + whole[r.doc_id] + "\x02" if whole[r.doc_id] else ""
        grams = ["".join(g) for g in zip(row, row[1:], row[2:])]
        assert r.n_grams == len(grams)
        assert math.isclose(r.logp, sum(math.log(model(g)) for g in grams), rel_tol=1e-9, abs_tol=1e-9)


def test_classifier_hears_the_order_of_words(spark):
    """A repeated word and shuffled words are made of trusted words, but do not read like trusted text."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["the", "an", "in", "er", "re", "ing"]) for _ in range(rng.randrange(1, 4)))
    sentence = lambda: " ".join([word().capitalize(), *[word() for _ in range(6)]]) + "."
    texts = [" ".join(sentence() for _ in range(12)) for _ in range(200)]
    shuffled = [" ".join(rng.sample(t.split(), len(t.split()))) for t in texts[:20]]
    rows = [*enumerate(texts), *enumerate(["Thean " * 80, "Rein. " * 80], 300), *enumerate(shuffled, 400)]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "'en' AS lang", "text")
    lab = spark.createDataFrame([(i, 1, 0) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality_model.classify(d, lab).collect()}
    assert all(kept[i] for i in range(200))
    assert not kept[300] and not any(kept[400 + i] for i in range(20))


def test_classifier_keeps_short_clean_text(spark):
    """The mean of few n-grams varies more; long noise is still rejected, and short noise too."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices(["the", "an", "in", "er", "re", "ing", "ou", "xy"], [30, 20, 20, 10, 10, 10, 2, 1])[0] for _ in range(rng.randrange(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, prose(150)) for i in range(400)] + [(i, prose(rng.choice([1, 2, 3, 4]))) for i in range(400, 500)]
    rows += [(500, "$%& XQZ! #$%"), (501, "#$%&XQZ! " * 60), (502, prose(75) + " QZXJ!" * 40)]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "'en' AS lang", "text")
    lab = spark.createDataFrame([(i, 1, 0) for i in [*range(400), 400, 401]], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality_model.classify(d, lab).collect()}
    assert all(out[i].kept for i in range(400)) and sum(out[i].kept for i in range(400, 500)) >= 99
    assert not any(out[i].kept for i in (500, 501, 502))
    assert out[500].threshold > out[501].threshold


def test_rows_without_or_with_one_id_are_dealt_out(spark, monkeypatch):
    rng = random.Random(6)
    prose = lambda: " ".join("".join(rng.choice("abcde") for _ in range(4)) for _ in range(8))
    rows = [(None, prose()) for _ in range(300)] + [(7, prose()) for _ in range(300)] + [(1000 + i, prose()) for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "'en' AS lang", "text")
    lab = spark.createDataFrame([(7, 1, 0), (1000, 1, 0)], "doc_id long, quality int, toxic int")
    dealt, packed = [], quality_model.packed
    monkeypatch.setattr(quality_model, "packed", lambda df: (dealt.append(df), packed(df))[1])
    out = quality_model.perplexities(d, lab, 3, 20, True).collect()
    assert dealt[0].groupBy("block").count().agg(F.max("count")).first()[0] < 60
    assert len(out) == len(rows) and sum(r.trusted for r in out) == 301
    assert all(r.trusted == (r.doc_id in (7, 1000)) for r in out)
    model = brute_model(["\x02".join(t.split()) for i, t in rows if i in (7, 1000)], 3)
    import math

    want = sorted(sum(math.log(model("".join(g))) for g in zip(row, row[1:], row[2:])) for i, t in rows if i is None for row in ["\x01\x01" + "\x02".join(t.split()) + "\x02"])
    assert sorted(r.logp for r in out if r.doc_id is None) == pytest.approx(want)


def test_license_scan_finds_families(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choice(["the", "an", "in", "er", "re", "ing", "of"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    notices = [(f, t) for f in license_scan.TEMPLATES for t in license_scan.TEMPLATES[f]]
    rows = [(i, "\n".join(prose(12) for _ in range(6))) for i in range(250)]
    rows += [(1000 + k, f"{prose(10)}\n{t}\n{prose(9)}") for k, (_, t) in enumerate(notices)]
    rows += [(2000, None), (2001, ""), (2002, "  \n\n "), (2003, notices[0][1] + "\n" + notices[-1][1]), (None, prose(5))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, family string, p int")
    model = license_scan.fit(df)
    got = {r.doc_id: r for r in license_scan.scan(df, model).collect()}
    assert len(got) == len(rows)
    assert all(got[i].families == "" for i in range(250))
    right = sum(got[1000 + k].families == f for k, (f, _) in enumerate(notices))
    assert right >= len(notices) - 1
    assert got[2000].families == got[2001].families == got[2002].families == ""
    assert got[2003].n_paragraphs == 2
    assert license_scan.scan(df.limit(0), model).count() == 0
    # held-out accuracy: notices with other words around and some words missing
    other = [(i, f, " ".join(["note:"] + [w for w in t.split() if rng.random() > 0.1])) for i, (f, t) in enumerate(notices * 3)]
    told = {r.doc_id: r.families for r in license_scan.scan(spark.createDataFrame([(i, t) for i, _, t in other], "doc_id long, text string"), model).collect()}
    assert sum(told[i] in (f, "unknown") for i, f, _ in other) / len(other) > 0.9
    assert sum(told[i] == f for i, f, _ in other) / len(other) > 0.7


def test_license_scores_equal_plain_logistic_scoring(spark):
    """Every line of every row by the weights, in plain Python; repeated rows and ids score like one row."""
    rng = random.Random(8)
    prose = lambda n: " ".join("".join(rng.choice(["the", "an", "in", "er", "re"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    notices = [t for f in license_scan.TEMPLATES for t in license_scan.TEMPLATES[f]]
    corpus = [(i, "\n".join(prose(12) for _ in range(4))) for i in range(200)]
    model = license_scan.fit(spark.createDataFrame(corpus, "doc_id long, text string"))
    lines = ["Licensed under the License Foo version 9 terms apply", "source code is subject to the terms of a contract", "Released under the FOO License."]
    lines += [" ".join(w for w in t.split() if rng.random() > 0.2) for t in notices * 2] + [prose(9) for _ in range(20)]
    rows = [(i, f"{a}\n{prose(8)}\n{b}") for i, (a, b) in enumerate(zip(lines, lines[::-1]))] + [(500 + i, t) for i, t in enumerate(lines)]
    rows += [(500, lines[0])] * 2 + [(None, lines[1])] * 3 + [(501, lines[4]), (7, None), (8, ""), (9, " ".join([lines[3]] + [prose(5000)]))]

    def plain(line):
        words = re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", line.lower())
        held = {*words, *(" ".join(p) for p in zip(words, words[1:]))}
        z = [b + sum(model.weights[k][j] for j, g in enumerate(model.features) if g in held) for k, b in enumerate(model.intercepts)]
        e = [math.exp(x - max(z)) for x in z]
        p = [x / sum(e) for x in e]
        if not held & set(model.features) or p[0] >= 0.5:
            return None
        best = max(range(1, len(p)), key=lambda k: p[k])
        family = license_scan.FAMILIES[best]
        templates = [set(re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", t.lower())) for t in license_scan.TEMPLATES[family]]
        similar = max(len(t & set(words)) / len(t) for t in templates)
        return family if p[best] >= model.least and similar >= license_scan.LEAST_SIMILARITY else "unknown"

    want = []
    for doc, text in rows:
        found = [f for f in map(plain, (text or "").split("\n")) if f]
        want.append((str(doc), len(found), ",".join(sorted(set(found)))))
    got = [(str(r.doc_id), r.n_paragraphs, r.families) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), model).collect()]
    assert sorted(got) == sorted(want)
    assert {f for *_, f in want} >= {"unknown", "mit", "apache"}
    assert model.least > 0.5 and plain(lines[2]) == "unknown"


def test_license_clue_misses_nothing(spark):
    """Paragraphs that the pattern leaves out have no weight for any family."""
    df = spark.createDataFrame([(i, f"plain words number {i} of a text that is long") for i in range(100)], "doc_id long, text string")
    m = license_scan.fit(df)
    useful = [g for k, g in enumerate(m.features) if any(w[k] > m.weights[0][k] + 1e-9 for w in m.weights[1:])]
    told = spark.createDataFrame([(g,) for g in useful], "g string").select(F.col("g").rlike(m.clue).alias("ok"))
    assert told.filter("NOT ok").count() == 0


@pytest.mark.parametrize("empty", [quality_model.classify])
def test_empty_labels_and_documents(spark, empty):
    d = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert empty(d, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
