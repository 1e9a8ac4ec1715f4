"""Approximate nearest neighbours: an inverted multi-index over two vector halves."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.blocks import packed, packed_rows, unpacked
from strata.session import scratch_path

#: What the registered query asks for: nearest rows, of every vec_id that this divides.
QUERY_NEAREST, QUERY_EVERY = 5, 50
#: Rows the centroids are fitted on, at most, and centroids of a half, at most.
SAMPLE_ROWS, MAX_CENTROIDS = 16384, 256
#: Queries the depth of the traversal is measured on, at most, and the recall it has to reach there.
SAMPLE_QUERIES, RECALL = 256, 0.97
#: Entries of a block of the index and queries of a packed row, about.
BLOCK_ENTRIES, PACK_QUERIES = 4096, 1024
#: Blocks and queries that a task holds at once, at most (about).
TILE_BLOCKS, TILE_QUERIES = 8, 1 << 15
#: Scores this close to the last one kept are computed again in one fixed order.
NEAR = 1e-9
_ENTRY = "key long, vec_id long, vector binary"
_FOUND = "query_id long, ask long, vec_id long, key long, score double, cell long"


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """One row of doubles for each binary of ``vectors``."""
    return np.frombuffer(b"".join(vectors.to_pylist()), np.float64).reshape(-1, dims)


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with the same row of ``y``, always summed in one order."""
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each centroid."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1), 0)


def centroids(x: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    """k-means of the distinct rows of ``x``; the start is spread over the sample in its own order."""
    x = np.unique(x, axis=0)
    found = x[np.linspace(0, len(x) - 1, min(count, len(x))).astype(int)]
    for _ in range(rounds):
        own = _distances(x, found).argmin(1)
        size = np.bincount(own, minlength=len(found))
        total = np.zeros_like(found)
        np.add.at(total, own, x)
        found = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], found)
    return found


def traverse(left: np.ndarray, right: np.ndarray, held: np.ndarray, depth: int) -> list[int]:
    """Cells that hold entries, nearest first, until they hold ``depth`` entries together.

    ``left`` and ``right`` are one query's squared distances to the centroids
    of its halves, ``held`` the entries of each cell (left * len(right) +
    right). Pairs go by the sum of their distances; only as many as the depth
    takes are put in order.
    """
    if depth <= 0:
        return []
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    cells = (a[:, None] * len(right) + b).ravel()
    full = np.flatnonzero(held[cells])
    cells, sums = cells[full], (left[a][:, None] + right[b]).ravel()[full]
    few = 64
    while few < len(cells):
        last = np.partition(sums, few)[few]
        near = sums <= last
        if held[cells[near]].sum() >= depth:
            cells, sums = cells[near], sums[near]
            break
        few *= 8
    cells = cells[np.argsort(sums, kind="stable")]
    return cells[: int(np.searchsorted(np.cumsum(held[cells]), depth)) + 1].tolist()


def _best(queries: np.ndarray, asks: list[int], vectors: np.ndarray, keys: list[int], ids: list[int | None], may: np.ndarray | None, nearest: int, least: np.ndarray | None = None) -> Iterator[tuple[int, float, int]]:
    """(query, score, entry) of the nearest entries of each query, its own one left out; none below ``least`` where it is given."""
    scores = _units(queries) @ _units(vectors).T
    if may is not None:
        scores[~may] = -np.inf
    at = {key: i for i, key in enumerate(keys)}
    for i in range(len(asks)) if least is None else np.flatnonzero(scores.max(1) >= least - NEAR).tolist():
        row, ask = scores[i], asks[i]
        if ask in at:
            row[at[ask]] = -np.inf
        last = np.partition(row, len(row) - nearest)[len(row) - nearest] if len(row) > nearest else -np.inf
        last = last if least is None else max(last, least[i])
        some = np.flatnonzero((row >= last - NEAR) & (row > -np.inf))
        exact = cosines(np.broadcast_to(queries[i], (len(some), queries.shape[1])), vectors[some])
        ranked = heapq.nsmallest(nearest, ((-s, ids[e] is None, ids[e] or 0, keys[e], e) for s, e in zip(exact.tolist(), some.tolist())))
        for negative, *_, e in ranked:
            yield i, -negative, e


def _found(rows: list[tuple]) -> pa.RecordBatch:
    names = ["query_id", "ask", "vec_id", "key", "score", "cell"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _ranked(found: DataFrame, nearest: int) -> DataFrame:
    """The best ``nearest`` rows of each query, with their rank."""
    by_query = Window.partitionBy("query_id", "ask").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "key")
    return found.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= nearest)


def blocks_of(held: np.ndarray, block_entries: int = BLOCK_ENTRIES) -> tuple[np.ndarray, np.ndarray]:
    """(first block, blocks) of each cell: small cells share one, a cell of more than ``block_entries`` has its own."""
    parts = np.maximum(-(-held // block_entries), 1)
    start, block, filled = np.zeros(len(held), np.int64), 0, 0
    for cell, (size, n) in enumerate(zip(held.tolist(), parts.tolist())):
        if filled and (n > 1 or filled + size > block_entries):
            block, filled = block + 1, 0
        start[cell] = block
        if n > 1:
            block += n
        else:
            filled += size
    return start, parts


def depth_for(recall: float, wanted: dict[int, list[int]], cells: Callable[[int], list[int]], held: np.ndarray) -> int:
    """Entries to walk so that the share ``recall`` of all wanted (query -> cells of its true neighbours) is met."""
    needs = []
    for query, own in wanted.items():
        walk = cells(query)
        before = dict(zip(walk, np.r_[0, np.cumsum(held[walk])[:-1]].tolist()))
        needs += [before[c] + 1 for c in own]
    needs.sort()
    return needs[max(0, int(np.ceil(recall * len(needs))) - 1)] if needs else 1


def _sampled(rows: DataFrame, order: Column, most: int, n: int) -> DataFrame:
    """At most ``most`` of the ``n`` rows, the first by a hash; tasks send twice as many together, however many tasks there are."""
    share = min(1.0, 2 * most / max(n, 1))
    some = rows.withColumn("__order", order).filter(F.shiftrightunsigned("__order", 32) <= int(share * (2**32 - 1)))
    return some.orderBy("__order", "vector").limit(most)


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, copies, vector), distinct, and the number of components.

    ``vector`` holds doubles, scaled by a power of two (that changes no
    cosine, and no sum overflows). Left out: null vectors, those without a
    component other than zero, those with null or non-finite components, and
    those of another length than most (of equally many, the longer).
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    clean = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.filter(F.col("v").isNotNull() & clean)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dims = lengths["n"] if lengths else 1

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None]) + 0.0  # no negative zeros
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary())], ["vec_id", "vector"])

    same = rows.filter(F.size("v") == dims).mapInArrow(scaled, "vec_id long, vector binary")
    return same.groupBy("vec_id", "vector").agg(F.count("*").alias("copies")), dims


def nearest_rows(vectors: DataFrame, nearest: int = 10, every: int = QUERY_EVERY, recall: float = RECALL) -> DataFrame:
    """The ``nearest`` rows by cosine of each row whose vec_id ``every`` divides, against all rows.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller
    vec_id, rows without a vec_id come last and are no queries. Vectors that
    take part: see ``usable``. A query's own row is no candidate; a row that
    repeats its vec_id is one, and each of repeated query rows gets its own
    result rows. With fewer candidates all are returned, with none no rows,
    as for an empty table. Other columns are ignored.

    Method: k-means on a bounded sample gives centroids of the left and the
    right halves of the unit vectors; a cell is a pair of them, and cells in
    order are cut into blocks of about ``BLOCK_ENTRIES`` entries (a larger
    cell is dealt over several). Each query walks the cells by summed
    distance and goes to the blocks it meets, where the entries of its cells
    are compared in double precision. Blocks meet queries in tiles: some
    blocks, held once, and the queries that meet them, each with the distance
    of its last cell instead of a list of them; a tile answers with the best
    rows of each query. How deep a query walks is measured: the
    share of all entries within which a bounded sample of queries, compared
    with every row, has ``recall`` of its true neighbours. Every row is
    indexed; of equal vectors the first ``nearest`` + 1 rows stand for all,
    for no query can return more. Vectors without neighbourhoods (random
    directions) need a large share, clustered ones a small one.
    """
    spark = vectors.sparkSession
    at = scratch_path(spark, "multi-index")
    found, dims = usable(vectors)
    found.write.parquet(f"{at}/rows")
    rows = spark.read.parquet(f"{at}/rows")
    key, one = F.xxhash64("vec_id", "vector", "copy").alias("key"), F.lit(1).cast("long")
    asks = rows.filter(F.col("vec_id") % every == 0).withColumn("copy", F.explode(F.sequence(one, "copies"))).select(key, "vec_id", "vector")
    first = rows.withColumn("copy", F.explode(F.sequence(one, F.least("copies", F.lit(nearest + 1).cast("long"))))).select(key, "vec_id", "vector")
    same = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last(), "key")
    first = first.withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= nearest + 1).drop("nth")

    n, half = rows.count(), max(dims // 2, 1)
    sample = _sampled(rows, F.xxhash64("vector", "vec_id"), SAMPLE_ROWS, n).select("vector").toArrow()
    units = _units(_matrix(sample.column("vector"), dims)) if n else np.ones((1, dims))
    count = int(min(MAX_CENTROIDS, max(1, round((n / 16) ** 0.5))))
    left, right = centroids(units[:, :half], count), centroids(units[:, half:], count)

    def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u = _units(x)
        return _distances(u[:, :half], left), _distances(u[:, half:], right)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = halves(_matrix(batch.column("vector"), dims))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(a.argmin(1) * len(right) + b.argmin(1))], [*batch.schema.names, "cell"])

    first.mapInArrow(cells, f"{_ENTRY}, cell long").write.parquet(f"{at}/entries")
    entries = spark.read.parquet(f"{at}/entries")
    held = np.zeros(len(left) * len(right), np.int64)  # at most MAX_CENTROIDS ** 2
    for r in entries.groupBy("cell").count().collect():
        held[r["cell"]] = r["count"]
    total = int(held.sum())

    # the depth, from a bounded sample of queries against every row
    n_asks = asks.count()
    tried = _sampled(asks, F.xxhash64("key"), SAMPLE_QUERIES, n_asks).toArrow()
    tests, test_keys, test_ids = _matrix(tried.column("vector"), dims), tried.column("key").to_pylist(), tried.column("vec_id").to_pylist()

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and len(tests):
                keys, ids, cell = (batch.column(c).to_pylist() for c in ("key", "vec_id", "cell"))
                best = _best(tests, test_keys, _matrix(batch.column("vector"), dims), keys, ids, None, nearest)
                yield _found([(test_ids[q], test_keys[q], ids[e], keys[e], score, cell[e]) for q, score, e in best])

    wanted: dict[int, list[int]] = {}
    position = {k: i for i, k in enumerate(test_keys)}
    for r in _ranked(entries.mapInArrow(compared, _FOUND), nearest).collect():
        wanted.setdefault(position[r["ask"]], []).append(r["cell"])
    a, b = halves(tests) if len(tests) else (None, None)
    depth = depth_for(recall, wanted, lambda q: traverse(a[q], b[q], held, total), held)
    start, parts = blocks_of(held)

    # a tile: some blocks and a slice of the queries, so that neither side of one grows with the table
    slices = max(1, -(-n_asks // TILE_QUERIES))
    blocks = int((start + parts).max())
    each = min(TILE_BLOCKS, max(1, blocks // (2 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    first_tile, last_tile = start // each, (start + parts - 1) // each

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            several = parts[cell]
            salt = [zlib.crc32(v) % m if m > 1 else 0 for v, m in zip(batch.column("vector").to_pylist(), several.tolist())]
            tile = (start[cell] + np.array(salt, np.int64)) // each
            for i in range(slices):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tile * slices + i)], [*batch.schema.names, "block"])

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each tile the queries that meet it, with the distance of the last cell they walk to."""
        for batch in batches:
            for some in (batch.slice(i, PACK_QUERIES) for i in range(0, batch.num_rows, PACK_QUERIES)):
                a, b = halves(_matrix(some.column("vector"), dims))
                far, query, tile = np.empty(some.num_rows), [], []
                for q in range(some.num_rows):
                    own = np.array(traverse(a[q], b[q], held, depth))
                    far[q] = a[q, own[-1] // len(right)] + b[q, own[-1] % len(right)]
                    wide = own[last_tile[own] > first_tile[own]].tolist()
                    met = np.unique(np.concatenate([first_tile[own], *(np.arange(first_tile[c] + 1, last_tile[c] + 1) for c in wide)]))
                    query.append(np.full(len(met), q))
                    tile.append(met)
                query, tile = np.concatenate(query), np.concatenate(tile)
                own_slice = (some.column("key").to_numpy().view(np.uint64) % np.uint64(slices)).astype(np.int64)
                named = pa.RecordBatch.from_arrays([*some.columns, pa.array(far)], [*some.schema.names, "far"])
                for t in np.unique(tile).tolist():
                    here = query[tile == t]
                    yield from packed_rows(pa.RecordBatch.from_arrays([*named.take(pa.array(here)).columns, pa.array(t * slices + own_slice[here])], [*named.schema.names, "block"]))

    def reranked(q: pa.Table, e: pa.Table) -> pa.Table:
        """The best rows of each query of a tile."""
        by, of = unpacked(q), unpacked(e)
        if by is None or of is None:
            return pa.Table.from_batches([_found([])])
        of = of.take(pa.array(np.argsort(of.column("cell").to_numpy(), kind="stable")))
        rows = []
        for asked in (by.slice(i, PACK_QUERIES) for i in range(0, by.num_rows, PACK_QUERIES)):
            x, asked_keys, asked_ids, far = _matrix(asked.column("vector"), dims), asked.column("key").to_pylist(), asked.column("vec_id").to_pylist(), asked.column("far").to_numpy()
            a, b = halves(x)
            best: list[list] = [[] for _ in asked_keys]
            least = np.full(len(best), -np.inf)
            for part in (of.slice(i, BLOCK_ENTRIES) for i in range(0, of.num_rows, BLOCK_ENTRIES)):
                cell, at_cell = np.unique(part.column("cell").to_numpy(), return_inverse=True)
                # distances may differ in their last digits from those the query walked by
                may = a[:, cell // len(right)] + b[:, cell % len(right)] <= far[:, None] + NEAR
                keys, ids = part.column("key").to_pylist(), part.column("vec_id").to_pylist()
                more: dict[int, list] = {}
                for i, score, j in _best(x, asked_keys, _matrix(part.column("vector"), dims), keys, ids, None if may.all() else may[:, at_cell], nearest, least):
                    more.setdefault(i, []).append((-score, ids[j] is None, ids[j] or 0, keys[j], int(cell[at_cell[j]])))
                for i, new in more.items():
                    best[i] = sorted(best[i] + new)[:nearest]
                    least[i] = -best[i][-1][0] if len(best[i]) == nearest else -np.inf
            rows += [(asked_ids[i], asked_keys[i], None if none else j, key, -negative, c) for i, own in enumerate(best) for negative, none, j, key, c in own]
        return pa.Table.from_batches([_found(rows)])

    index = packed(entries.mapInArrow(dealt, f"{_ENTRY}, cell long, block long"))
    packs = asks.repartition(max(1, -(-n_asks // PACK_QUERIES)), "key").mapInArrow(walked, "block long, rows binary")
    found = packs.groupBy("block").cogroup(index.groupBy("block")).applyInArrow(reranked, _FOUND)
    return _ranked(found, nearest).select("query_id", "rank", "vec_id", "score")
