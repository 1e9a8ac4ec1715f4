"""N-gram Jaccard join: parity sketches, pigeonhole join per size band, exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.blocks import block_count, packed_rows, unpacked
from strata.llm.components import Stages, components, typed
from strata.llm.exchange import shared_keys
from strata.llm.words import STEP, chunks, mix, windows, word_hashes

#: Near-duplicate defaults: words of a shingle, and similarity in percent.
SHINGLE_WORDS, THRESHOLD = 5, 85
#: What the registered query links on.
QUERY_WORDS, QUERY_THRESHOLD = 4, 85
#: Bands of sets below this size join pairs of pieces.
PAIRED_BELOW = 64
#: A group of at most so many classes is compared in one round.
SMALL_GROUP = 16
#: Pieces that a task combines at once (bounds its memory).
KEYS_AT_ONCE = 200_000
#: Text bytes taken apart at once (a longer text stands alone).
TEXT_BYTES = 1 << 20
#: Words of 64 bits of a class's dense sketch.
SKETCH_WORDS = 8
_SKETCH = tuple(f"s{i}" for i in range(SKETCH_WORDS))
#: Bits of the filter that tells which texts a round compares.
FILTER_BITS = 1 << 23
_TEXTS = pa.schema([("class", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()), ("text", pa.string())])
_CLASSES = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("class", pa.int64()), *((c, pa.int64()) for c in _SKETCH)])


def _bands(top: int) -> tuple[int, ...]:
    """Lower bounds of the size bands, up to one above ``top``: each about 1.5 times the one before."""
    bounds = [1]
    while bounds[-1] <= top:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 3 // 2))
    return (*bounds, bounds[-1] * 3 // 2)


def _pieces(low: int, above: int, threshold: int) -> tuple[int, int, int]:
    """(differences, pieces, spare) of a band, for pairs whose smaller set has low <= size < above.

    Sets of Jaccard similarity >= t whose smaller one has a elements differ in
    at most d = a (1 - t) / t. Of d + 1 + spare pieces of two such sketches
    more than ``spare`` are untouched: equal, and made of the same elements.
    An empty piece says nothing (all sets that hold nothing there would come
    together); as soon as one of the two sketches has at most ``spare`` of
    them, another piece is equal too. ``spare`` is set above the number that
    chance gives, as far as that does not thin the pieces further. Small sets
    have few elements a piece;
    of their d + 2 pieces two are untouched, and pairs of pieces are joined.
    """
    most = (100 - threshold) * (above - 1) // threshold
    if above <= PAIRED_BELOW:
        return most, most + 2, 0
    spare = 0
    while spare < most // 2 + 2:
        mean = low / (most + 1 + spare)
        weak = (most + 1 + spare) * math.exp(-mean)
        if spare >= weak + 3 * math.sqrt(weak) + 1:
            break
        spare += 1
    return most, most + 1 + spare, spare


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each text's distinct ``k``-word shingles, sorted; a shorter text is one shingle."""
    hashes, offsets = word_hashes(texts, lower=True)
    counts = np.diff(offsets)
    full = windows(hashes, k)
    short = [(i, mix(np.uint64(n) + sum((hashes[offsets[i] + j : offsets[i] + j + 1] * STEP ** np.uint64(j + 1) for j in range(n)), np.zeros(1, np.uint64)))) for i, n in enumerate(counts) if 0 < n < k]
    sizes = np.maximum(counts - k + 1, 0)
    sizes[[i for i, _ in short]] = 1
    bounds = np.r_[0, np.cumsum(sizes)]
    out = np.empty(bounds[-1], np.uint64)
    for i in np.flatnonzero(counts >= k):
        a = bounds[i]
        out[a : bounds[i + 1]] = full[offsets[i] : offsets[i] + sizes[i]]
        out[a : bounds[i + 1]].sort()
    for i, value in short:
        out[bounds[i]] = value[0]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    new = np.r_[True, (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])] if len(out) else np.empty(0, bool)
    return out[new], np.r_[0, np.cumsum(np.bincount(owner[new], minlength=len(sizes)))].astype(np.int64)


def _set_ids(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit id of each set: equal sets, equal ids."""
    total = np.r_[np.uint64(0), np.cumsum(mix(sets ^ STEP))]
    return mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64) * STEP).view(np.int64)


def _parts(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch; unused memory goes back afterwards, for idle workers count as the executor's too."""
    yield from chunks(batch, column, TEXT_BYTES)
    pa.default_memory_pool().release_unused()


def dense_sketches(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64 * ``SKETCH_WORDS`` bits for each set, as int64 columns: every element toggles one bit.

    The Hamming distance of two sketches is at most the symmetric difference
    of their sets: elements that both hold toggle the same bit in both.
    """
    bits = 64 * SKETCH_WORDS
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    spot = rows * bits + (mix(sets ^ np.uint64(int(STEP) * 3 % (1 << 64))) >> np.uint64(64 - (bits - 1).bit_length())).astype(np.int64)
    odd = (np.bincount(spot, minlength=(len(offsets) - 1) * bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(-1, SKETCH_WORDS)


def wide_sketches(sets: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> list[bytes]:
    """Like ``dense_sketches``, for some sets, in at least as many bits as the set has elements (a power of two)."""
    spread = mix(sets ^ np.uint64(int(STEP) * 3 % (1 << 64)))
    out = []
    for i in rows.tolist():
        own = spread[offsets[i] : offsets[i + 1]]
        power = max(64 * SKETCH_WORDS, len(own)) - 1
        bits = np.bincount((own >> np.uint64(64 - power.bit_length())).astype(np.int64), minlength=1 << power.bit_length())
        out.append(np.packbits(bits & 1).tobytes())
    return out


def sketch_distance(a: bytes, b: bytes) -> int:
    """Bits in which two sketches of ``wide_sketches`` differ, the wider one folded to the width of the other."""
    x, y = sorted((np.unpackbits(np.frombuffer(v, np.uint8)) for v in (a, b)), key=len)
    return int(np.count_nonzero(x ^ np.bitwise_xor.reduce(y.reshape(len(x), -1), axis=1)))


def class_filter(classes: DataFrame) -> np.ndarray:
    """A filter of fixed size for ``classes`` (class): bit ``class`` modulo its size is set for each of them."""
    at = F.shiftright(F.col("class").bitwiseAND(F.lit(FILTER_BITS - 1)), 6).cast("int")
    words = classes.groupBy(at.alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(class & 63 AS INT))")).alias("bits")).toArrow()
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return held.view(np.uint64)


def _in_filter(held: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Whether classes may be among those of the filter (never wrong about those that are)."""
    spot = classes.view(np.uint64) & np.uint64(len(held) * 64 - 1)
    return (held[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) != 0


def _may_link(threshold: int) -> Column:
    """Whether a class (n, s0...) and a pivot (pivot_n, pivot_s0...) can link, by their sizes and sketches.

    Sets of a similarity of t percent or more differ in at most
    (n + m) (100 - t) / (100 + t) elements.
    """
    sizes = 100 * F.least("n", "pivot_n") >= threshold * F.greatest("n", "pivot_n")
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"pivot_{c}"))) for c in _SKETCH), F.lit(0))
    return sizes & ((100 + threshold) * differ <= (100 - threshold) * (F.col("n") + F.col("pivot_n")))


def _piece_keys(sets: np.ndarray, offsets: np.ndarray, rows: np.ndarray, band: int, low: int, above: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of the sketch pieces of some sets, as members of a band.

    A sketch has K pieces of 2**32 bits; an element toggles one bit of one
    piece, so the Hamming distance of two sketches is at most the symmetric
    difference of their sets. A piece is kept as the XOR of the codes of its
    set bits; its key also holds the band and the piece's number.
    """
    _, count, spare = _pieces(low, above, threshold)
    sizes = np.diff(offsets)[rows]
    at = np.repeat(offsets[rows] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
    elements = mix(sets[at] + np.uint64((band + 1) * int(STEP) % (1 << 64)))
    slot = np.repeat(np.arange(len(rows)), sizes) * count + (((elements >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    slot, codes = slot[order], mix((elements & np.uint64(0xFFFFFFFF)) + STEP)[order]
    starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.empty(0, np.int64)
    if not len(slot):
        return codes, rows[:0]
    value, slot = np.bitwise_xor.reduceat(codes, starts), slot[starts]
    if above <= PAIRED_BELOW:
        sketch = np.zeros(len(rows) * count, np.uint64)
        sketch[slot] = value
        i, j = np.triu_indices(count, 1)
        name = mix((i * count + j).astype(np.uint64) + np.uint64(band << 32) + STEP)
        sketch = sketch.reshape(-1, count)
        return mix(mix(sketch[:, i] ^ name) + sketch[:, j]).ravel(), np.repeat(rows, len(i))
    strong = value != 0
    weak = count - np.bincount(slot[strong] // count, minlength=len(rows))
    rare = weak > spare  # such a set also lists its empty pieces
    keep = strong | rare[slot // count]
    more = [np.setdiff1d(np.arange(count) + i * count, slot[slot // count == i]) for i in np.flatnonzero(rare)]
    missing = np.concatenate([np.empty(0, np.int64), *more])
    slot, value = np.r_[slot[keep], missing], np.r_[value[keep], np.zeros(len(missing), np.uint64)]
    return mix(value ^ mix((slot % count).astype(np.uint64) + np.uint64(band << 32) + STEP)), rows[slot // count]


def _joined(stages: Stages, labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Component labels after more links: components of the components the links connect."""
    if labels is None:
        return stages.put("labels", components(links, stages))
    for end in "ab":
        known = labels.select(F.col("node").alias(end), F.col("component").alias("c"))
        links = links.join(known, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    merged = stages.put("merged", components(links, stages))
    old = labels.join(merged.select(F.col("node").alias("component"), F.col("component").alias("c")), "component", "left")
    old = old.select("node", F.coalesce("c", "component").alias("component"))
    return stages.put("labels", old.union(merged.join(labels.select("node"), "node", "left_anti")))


def with_class(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` and, as ``__class``, the class of each row's text; null without shingles."""
    schema = T.StructType([*docs.schema.fields, T.StructField("__class", T.LongType())])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                sets, offsets = shingle_sets(part.column("text"), k)
                ids = pa.array(_set_ids(sets, offsets), mask=np.diff(offsets) == 0)
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*part.schema.names, "__class"])

    return docs.mapInArrow(named, schema)


def one_of_each(docs: DataFrame, k: int = SHINGLE_WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group of linked rows one stays.

    It is the row with the least doc_id (rows without one come last, ties by
    the class of the text, then by the row's values). Rows without shingles
    link with nothing and stay. The columns are those of ``docs``.
    """
    found = jaccard_components(docs, k, threshold).filter("group IS NOT NULL")
    first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "class")).alias("first")).select("first.*")
    rows = found.groupBy("doc_id", "class").agg(F.count("*").alias("rows"))
    first = first.join(rows.select(F.col("doc_id").alias("id"), F.col("class").alias("c"), "rows"), (F.col("class") == F.col("c")) & F.col("doc_id").eqNullSafe(F.col("id")))
    stay = first.select(F.col("id").alias("__id"), F.col("class").alias("__stays"), F.col("rows").alias("__rows"))
    named = with_class(docs, k)
    kept = named.join(stay, (F.col("__class") == F.col("__stays")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = kept.filter("__rows = 1").select(*columns)
    least = kept.filter("__rows > 1").groupBy("__class", "__id").agg(F.min(F.struct(*columns)).alias("row")).select("row.*")
    return once.unionByName(least).unionByName(named.filter("__class IS NULL").select(*columns))


def jaccard_components(docs: DataFrame, k: int = SHINGLE_WORDS, threshold: int = THRESHOLD, partitions: int | None = None) -> DataFrame:
    """Link documents whose sets of ``k``-word shingles have a Jaccard similarity of ``threshold`` percent or more.

    Returns doc_id, n_shingles (set size), class (id of documents with equal
    sets), n_links (linked classes found and verified for its class),
    component_id (least doc_id reachable by links, itself included) and group
    (id of the component, also where it has no doc_id; null without
    shingles), one row per input row. Words are those of the lower-cased (A-Z) text; a text of
    fewer than ``k`` words is one shingle, one without words or a null text
    has none and links with nothing. Rows that repeat a doc_id, or have none,
    link by their own texts like any other; a component of rows without a
    doc_id has a null component_id. Other columns are ignored.

    Method: equal sets form classes. Every class toggles one bit of a sparse
    sketch per shingle; the sketch is split into more pieces than linked sets
    can differ in, so linked classes share a piece (pigeonhole), in the band
    of the smaller set's size. Classes sharing a piece are candidates, unless
    their dense sketches differ in more bits than linked sets can; what is
    left after wider sketches, of a bit or more for each shingle, have been
    compared too is verified on whole shingle sets. Groups with the same members are
    looked at once. In each group a few pivots are compared with the others
    per round (8 times as many in each), taken from outside the group's
    largest component; whatever is already connected needs no further
    comparison, and a group is done when its members are one component or
    all outside the largest one have been pivots: no link between components
    can be missed, and no large group is expanded into pairs up front.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = typed(docs, doc_id="bigint", text="string")

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                sets, offsets = shingle_sets(part.column("text"), k)
                sketches = dense_sketches(sets, offsets)
                columns = [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(_set_ids(sets, offsets)), *(pa.array(sketches[:, i]) for i in range(SKETCH_WORDS))]
                yield pa.RecordBatch.from_arrays(columns, schema=_CLASSES)

    def pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        keys, ids, seen = [], [], set()
        for part in _parts(batch):
            sets, offsets = shingle_sets(part.column("text"), k)
            named, sizes = _set_ids(sets, offsets), np.diff(offsets)
            fresh = [i for i, c in enumerate(named.tolist()) if sizes[i] and not (c in seen or seen.add(c))]
            if not fresh:
                continue
            fresh = np.array(fresh)
            bounds = np.array(_bands(int(sizes.max())))
            own = np.searchsorted(bounds, sizes[fresh], side="right") - 1
            for band in range(int(own.max()) + 1):
                low, above = int(bounds[band]), int(bounds[band + 1])
                # members, and larger sets that a member of the band may be linked with
                rows = fresh[(own == band) | ((own > band) & (100 * (above - 1) >= threshold * sizes[fresh]))]
                if len(rows) and _pieces(low, above, threshold)[0]:  # else only equal sets link
                    found, at = _piece_keys(sets, offsets, rows, band, low, above, threshold)
                    keys.append(found)
                    ids.append(named[at])
            if sum(map(len, keys)) >= KEYS_AT_ONCE:
                yield np.concatenate(keys), np.concatenate(ids)
                keys, ids = [], []
        if keys:
            yield np.concatenate(keys), np.concatenate(ids)

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, "text_b"):
                left = part.column("a").to_numpy()
                first = np.unique(left, return_index=True)[1]
                mine = dict(zip(left[first].tolist(), np.arange(len(first))))
                sets, offsets = shingle_sets(part.column("text_a").take(pa.array(first)), k)
                others, bounds = shingle_sets(part.column("text_b"), k)
                ok = np.empty(part.num_rows, bool)
                for i, a in enumerate(left.tolist()):
                    x = sets[offsets[mine[a]] : offsets[mine[a] + 1]]
                    y = others[bounds[i] : bounds[i + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok[i] = 100 * both >= threshold * (len(x) + len(y) - both)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(ok)], ["a", "b", "ok"])

    def alike_by_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            differ = [sketch_distance(x, y) for x, y in zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist())]
            may = (100 + threshold) * np.array(differ, np.int64) <= (100 - threshold) * sizes
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(may)], ["a", "b", "may"])

    def class_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One text of each class of a batch, packed for the block the class belongs to."""
        for batch in batches:
            found, seen = [], set()
            for part in _parts(batch):
                sets, offsets = shingle_sets(part.column("text"), k)
                ids = _set_ids(sets, offsets)
                fresh = [i for i, c in enumerate(ids.tolist()) if offsets[i + 1] > offsets[i] and not (c in seen or seen.add(c))]
                texts = part.column("text").take(pa.array(fresh, pa.int64()))
                sketches = pa.array(wide_sketches(sets, offsets, np.array(fresh, np.int64)), pa.binary())
                found.append(pa.table({"block": np.mod(ids[fresh], blocks), "class": ids[fresh], "n": np.diff(offsets)[fresh], "sketch": sketches, "text": texts}))
            for rows in pa.concat_tables(found).combine_chunks().to_batches() if found else ():
                yield from packed_rows(rows)

    def wanted_texts(d: pa.Table, w: pa.Table) -> pa.Table:
        """One text of each of the block's wanted classes."""
        rows = unpacked(d)
        if rows is None or not w.num_rows:
            return pa.Table.from_pylist([], _TEXTS)
        first = np.unique(rows.column("class").to_numpy(), return_index=True)[1]
        rows = rows.take(pa.array(first))
        return rows.filter(pc.is_in(rows.column("class"), w.column("class").combine_chunks())).cast(_TEXTS)

    stages = Stages(spark)
    layout = ", ".join(f"{c} long" for c in ("doc_id", "n_shingles", "class", *_SKETCH))
    members = stages.put("members", docs.mapInArrow(classes, layout))
    blocks = block_count(members.count())
    # one row of each class; all rows of a class agree
    known = members.filter("n_shingles > 0").groupBy("class").agg(F.first("n_shingles").alias("n"), *[F.first(c).alias(c) for c in _SKETCH])
    found = stages.put("found", shared_keys(docs, pieces, partitions, as_rows=True).withColumnRenamed("doc_id", "class"))
    # groups of the same classes need one look: by two independent sums over their members
    same = [F.bit_xor(F.xxhash64("class", F.lit(i))).alias(f"h{i}") for i in (1, 2)]
    alike = found.groupBy("key").agg(F.count("*").alias("m"), *same).filter("m > 1").groupBy("m", "h1", "h2").agg(F.min("key").alias("key"))
    groups = found.join(alike.select("key"), "key", "left_semi").join(known, "class")
    left = stages.put("left", groups.withColumn("component", F.col("class")))
    stages.drop("found")
    wanted = left.select("class").distinct()
    told = docs.select("text").mapInArrow(class_texts, "block long, rows binary").groupBy("block")
    wanted = wanted.select(F.pmod("class", F.lit(blocks)).alias("block"), "class").groupBy("block")
    texts = stages.put("texts", told.cogroup(wanted).applyInArrow(wanted_texts, "class long, n long, sketch binary, text string"))
    sketch_a, sketch_b = (texts.select(F.col("class").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "ab")

    def texts_of(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(a, text_a) and (b, text_b) of the classes of some pairs, and of few others."""
        held = class_filter(pairs.select(F.col("a").alias("class")).union(pairs.select("b")))

        def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(_in_filter(held, batch.column("class").to_numpy())))

        some = texts.select("class", "text").mapInArrow(named, "class long, text string")
        return tuple(some.select(F.col("class").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")


    labels, tested, links, pivots = None, None, None, 1
    own = ("class", "component", "n", *_SKETCH)
    while True:
        sizes = left.groupBy("key", "component").agg(F.count("*").alias("c")).groupBy("key")
        several = sizes.agg(F.count("*").alias("parts"), F.sum("c").alias("m"), F.max(F.struct("c", "component"))["component"].alias("main"))
        left = stages.put("left", left.drop("m", "main").join(several.filter("parts > 1").drop("parts"), "key"))
        if left.isEmpty():
            break
        # the same classes are pivots of all the groups they are in
        order = F.xxhash64("class")
        slot = F.when(F.col("m") <= SMALL_GROUP, F.col("class")).otherwise(F.pmod(order, F.lit(pivots)))
        pivot = left.filter("component <> main").groupBy("key", slot.alias("slot")).agg(F.min(F.struct(order.alias("order"), *own)).alias("p"))
        pivot = pivot.select("key", *[F.col(f"p.{c}").alias(f"pivot_{c}") for c in own])
        other = F.col("component") != F.col("pivot_component")
        pairs = left.join(pivot, "key").filter(other & _may_link(threshold))
        pairs = pairs.select(F.least("class", "pivot_class").alias("a"), F.greatest("class", "pivot_class").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = pairs.join(sketch_b, "b").join(sketch_a, "a").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
        pairs = stages.put("pairs", pairs.mapInArrow(alike_by_sketch, "a long, b long, may boolean"))
        # texts move for pairs that both sketches leave, and only theirs
        near = pairs.filter("may").select("a", "b")
        text_a, text_b = texts_of(near)
        told = near.join(text_b, "b").join(text_a, "a").select("a", "b", "text_a", "text_b")
        told = stages.put("told", told.mapInArrow(verified, "a long, b long, ok boolean"))
        new = told.filter("ok").select("a", "b")
        tested = stages.put("tested", pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b")))
        links = stages.put("links", new if links is None else links.union(new))
        labels = _joined(stages, labels, new)
        left = left.drop("component").join(pivot.select("key", F.col("pivot_class").alias("class")), ["key", "class"], "left_anti")
        left = left.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
        pivots *= 8
    stages.drop("left", "texts", "pairs", "told", "tested", "stars", "merged")

    known = members.filter("n_shingles > 0")
    if links is None:
        known = known.withColumns({"component": F.col("class"), "n_links": F.lit(0).cast("long")})
    else:
        degree = links.union(links.select("b", "a")).groupBy(F.col("a").alias("class")).agg(F.count("*").alias("n_links"))
        by_class = labels.withColumnRenamed("node", "class").join(degree, "class", "left")
        known = known.join(by_class, "class", "left").withColumns({"component": F.coalesce("component", "class"), "n_links": F.coalesce("n_links", F.lit(0))})
    least = known.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    known = known.join(least, "component").select("doc_id", "n_shingles", "class", "n_links", "component_id", F.col("component").alias("group"))
    alone = members.filter("n_shingles = 0").select("doc_id", "n_shingles", "class", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("group"))
    return known.union(alone)


#: DuckDB: intersections counted by joining shingles, components by walking the links.
ORACLE_SQL = rf"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT id, doc_id, CASE WHEN len(words) < {QUERY_WORDS} THEN words ELSE words[i : i + {QUERY_WORDS - 1}] END AS s
  FROM (SELECT id, doc_id, words, unnest(range(1, greatest(len(words) - {QUERY_WORDS - 2}, 2))) AS i FROM texts WHERE len(words) > 0)),
sizes AS (SELECT id, doc_id, count(*) AS n FROM shingles GROUP BY id, doc_id),
common AS (SELECT a.id AS x, b.id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.id < b.id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.id = x JOIN sizes q ON q.id = y WHERE 100 * shared >= {QUERY_THRESHOLD} * (p.n + q.n - shared)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT id AS origin, id AS node FROM texts UNION SELECT origin, y FROM reach JOIN edges ON x = node)
SELECT t.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN texts t ON t.id = origin JOIN texts o ON o.id = node LEFT JOIN sizes s ON s.id = t.id GROUP BY t.id, t.doc_id
"""
