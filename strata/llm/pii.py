"""Personal data: fixed patterns, and a skip-chain CRF that carries their labels to similar tokens."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Documents the potentials are estimated on, at most about; posterior from which a token is added.
SAMPLE_DOCS = 20_000
LEAST_POSTERIOR = 0.95
ROUNDS = 20

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that could start inside a run of digits also starts at the run's start.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CLUE = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_NOT_KEY = re.compile(r"[^a-z0-9@.]+")

Span = tuple[str, int, int]


def passes_luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Each address has one @: grow left over local characters, right by the domain; linear in the text."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield "email", start, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the fixed patterns, leftmost without overlap per kind, by start and then kind."""
    if not _CLUE.search(text):
        return []
    found = list(_emails(text))
    for m in _IP.finditer(text):
        if all(int(p) <= 255 for p in m[0].split(".") if len(p) <= 4000) and all(len(p.lstrip("0")) <= 3 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and passes_luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _features(token: str) -> int:
    """Shape of a token as a bit mask."""
    digits = len(_NOT_DIGIT.sub("", token))
    tests = (
        "@" in token, digits == 0, 1 <= digits <= 3, digits == 4, 5 <= digits <= 9, 10 <= digits <= 13, 14 <= digits <= 19, digits >= 20,
        token[0] == "+", "(" in token or ")" in token, token.count(".") >= 3, "-" in token, token.isascii() and any(map(str.isalpha, token)), "=" in token or '"' in token,
    )
    return sum(1 << i for i, t in enumerate(tests) if t)


FEATURES = 14


def _key(token: str) -> str:
    """What similar tokens share: an address in lower case, or four digits and more; else nothing."""
    if "@" in token:
        return _NOT_KEY.sub("", token.lower()).strip(".")
    digits = _NOT_DIGIT.sub("", token)
    return digits if len(digits) >= 4 else ""


@dataclass
class Graph:
    """Tokens with a digit or an @ as nodes; neighbours and similar tokens joined by edges."""

    spans: list[tuple[int, int, int]]  # document, start, end
    shapes: list[int]
    labels: list[int]  # base label (0: none of the patterns)
    chain: list[tuple[int, int]]  # next to each other in the text
    skip: list[tuple[int, int]]  # a token and the one before it with the same key in its document


def build_graph(texts: list[str], bases: list[list[Span]]) -> Graph:
    g = Graph([], [], [], [], [])
    for d, (text, base) in enumerate(zip(texts, bases)):
        if not _CLUE.search(text):
            continue
        seen: dict[str, int] = {}
        last, i = None, 0
        open_spans: list[Span] = []
        for m in _TOKEN.finditer(text):
            token, (a, b) = m[0], m.span()
            if not _CLUE.search(token):
                last = None
                continue
            while i < len(base) and base[i][1] < b:
                open_spans.append(base[i])
                i += 1
            open_spans = [s for s in open_spans if s[2] > a]
            node = len(g.spans)
            g.spans.append((d, a, b))
            g.shapes.append(_features(token))
            g.labels.append(KINDS.index(open_spans[0][0]) + 1 if open_spans else 0)
            if last is not None:
                g.chain.append((last, node))
            if key := _key(token):
                if key in seen:
                    g.skip.append((seen[key], node))
                seen[key] = node
            last = node
    return g


@dataclass
class Potentials:
    node: np.ndarray  # (features + 1, labels)
    chain: np.ndarray  # (labels, labels)
    skip: float  # log potential of equal labels


def shape_matrix(shapes: np.ndarray) -> np.ndarray:
    return np.c_[(shapes[:, None] >> np.arange(FEATURES)) & 1, np.ones(len(shapes), np.int64)].astype(float)


def fit(shapes: Counter, chain: Counter, skip: Counter) -> Potentials:
    """Piecewise training: each kind of factor on its own counts.

    Node: multinomial logistic regression of the label on the shape (L2,
    fixed number of gradient steps). Chain: log ratio of the counts of
    neighbouring labels to independence. Skip: log odds that similar tokens
    agree, between 0 and 4.
    """
    size = len(KINDS) + 1
    patterns = sorted({s for s, _ in shapes})
    node = np.zeros((FEATURES + 1, size))
    if patterns:
        x = shape_matrix(np.array(patterns))
        y = np.array([[shapes[p, k] for k in range(size)] for p in patterns], float)
        total = y.sum()
        for step in range(500):
            z = x @ node
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            node -= 4.0 * (x.T @ (p * y.sum(1, keepdims=True) - y) / total + 1e-4 * node)
    pairs = np.array([[chain[i, j] for j in range(size)] for i in range(size)], float) + 1
    independent = pairs.sum(1, keepdims=True) * pairs.sum(0, keepdims=True) / pairs.sum()
    agree = sum(n for (i, j), n in skip.items() if i == j)
    odds = np.log((agree + 1) / (sum(skip.values()) - agree + 1))
    return Potentials(node, np.log(pairs / independent), float(np.clip(odds, 0, 4)))


def posteriors(g: Graph, w: Potentials) -> np.ndarray:
    """Loopy belief propagation with base labels observed: (nodes, labels) marginals.

    All documents of a batch are one graph of separate parts; the number of
    rounds is fixed, so a document's result does not depend on its batch.
    """
    size, labels = len(KINDS) + 1, np.array(g.labels, np.int64)
    local = shape_matrix(np.array(g.shapes, np.int64)) @ w.node
    seen = labels > 0
    local[seen] = -30
    local[seen, labels[seen]] = 0
    edges = np.array(g.chain + g.skip, np.int64).reshape(-1, 2)
    is_skip = np.r_[np.zeros(len(g.chain), bool), np.ones(len(g.skip), bool)]
    factor = np.where(is_skip[:, None, None], w.skip * np.eye(size), w.chain)
    source, target = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
    factor = np.concatenate([factor, factor.transpose(0, 2, 1)])
    back = np.r_[np.arange(len(edges)) + len(edges), np.arange(len(edges))]
    message = np.zeros((len(source), size))
    belief = local.copy()
    for _ in range(ROUNDS if len(source) else 0):
        free = (belief[source] - message[back])[:, :, None] + factor
        top = free.max(1)
        new = top + np.log(np.exp(free - top[:, None, :]).sum(1))
        new -= new.max(1, keepdims=True)
        message = 0.5 * message + 0.5 * new
        belief = local.copy()
        np.add.at(belief, target, message)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(texts: list[str], bases: list[list[Span]], w: Potentials, least: float = LEAST_POSTERIOR) -> list[list[Span]]:
    """Spans of tokens outside all base spans whose posterior label is an entity, neighbours of a number joined."""
    out: list[list[Span]] = [[] for _ in texts]
    g = build_graph(texts, bases)
    if not g.spans:
        return out
    p = posteriors(g, w)
    label = np.where((p.max(1) >= least) & (np.array(g.labels) == 0), p.argmax(1), 0)
    neighbour = {b: a for a, b in g.chain}
    for node in np.flatnonzero(label):
        (d, a, b), kind = g.spans[node], KINDS[label[node] - 1]
        text = texts[d]
        while a < b and not (text[a] in "+(" or text[a].isascii() and text[a].isalnum()):
            a += 1
        while b > a and not (text[b - 1].isascii() and text[b - 1].isalnum()):
            b -= 1
        if a == b:
            continue
        before = out[d][-1] if out[d] else None
        if kind in ("card", "phone") and before and node in neighbour and g.spans[neighbour[node]][1] < before[2] and before[0] == kind:
            out[d][-1] = (kind, before[1], b)  # one number written in several tokens
        else:
            out[d].append((kind, a, b))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans are one, of the first's kind."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def potentials(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Potentials:
    """Potentials estimated on about ``sample`` documents at most, picked by a hash of their ids."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    count = docs.count()
    share = min(1.0, sample / count) if count else 1.0
    picked = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < round(share * 1_000_000))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            g = build_graph(texts, [base_spans(t) for t in texts])
            seen = Counter(("node", s, k) for s, k in zip(g.shapes, g.labels))
            for name, edges in (("chain", g.chain), ("skip", g.skip)):
                seen.update((name, g.labels[i], g.labels[j]) for i, j in edges)
            if seen:
                yield pa.RecordBatch.from_pydict({"factor": [k[0] for k in seen], "x": [k[1] for k in seen], "y": [k[2] for k in seen], "n": list(seen.values())})

    tallies: dict[str, Counter] = {"node": Counter(), "chain": Counter(), "skip": Counter()}
    for r in picked.mapInArrow(counted, "factor string, x long, y long, n long").groupBy("factor", "x", "y").agg(F.sum("n").alias("n")).collect():
        tallies[r.factor][r.x, r.y] = r.n
    return fit(tallies["node"], tallies["chain"], tallies["skip"])


def _found(texts: list[str], w: Potentials, least: float) -> Iterator[tuple[list[Span], list[Span]]]:
    bases = [base_spans(t) for t in texts]
    for base, more in zip(bases, added_spans(texts, bases, w, least)):
        yield base, sorted([*base, *more], key=lambda s: (s[1], KINDS.index(s[0])))


def find_spans(docs: DataFrame, sample: int = SAMPLE_DOCS, least: float = LEAST_POSTERIOR) -> DataFrame:
    """(doc_id, base, spans): personal data as arrays of (kind, start, end) by start, code points, end exclusive.

    ``base`` are the fixed patterns: email, ip (parts up to 255), card (14 to
    19 digits passing Luhn) and phone (10 to 15 digits). ``spans`` adds what
    the skip-chain CRF finds: tokens with a digit or an @ are its nodes, base
    spans are observed, neighbouring tokens and the occurrences of one number
    or address in a document are joined by edges, and loopy message passing
    makes their labels agree; a token is added from a posterior of ``least``.
    The potentials are estimated from base labels on about ``sample``
    documents. One row per input row; null and empty texts have no spans;
    null and repeated doc_ids do no harm (each row is judged alone); an empty
    table gives no rows. Other columns are ignored.
    """
    w = potentials(docs, sample)
    entry = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_found([t or "" for t in batch.column("text").to_pylist()], w, least))
            rows = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f[k]] for f in found], pa.list_(entry)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *rows], ["doc_id", "base", "spans"])

    kind = "array<struct<kind:string,start:long,end:long>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(spans, f"doc_id long, base {kind}, spans {kind}")


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans as text."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def mask_documents(docs: DataFrame, sample: int = SAMPLE_DOCS, least: float = LEAST_POSTERIOR) -> DataFrame:
    """``docs``, all rows and columns, with personal data in ``text`` replaced by ``<kind>``; null texts stay null.

    ``n_chars``, if there, becomes the length of the new text.
    """
    w = potentials(docs, sample)
    at = docs.columns.index("text")

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = _found([t or "" for t in texts], w, least)
            new = [t if t is None else masked(t, spans) for t, (_, spans) in zip(texts, found)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    out = docs.mapInArrow(mask, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
