"""Approximate nearest neighbours by inner product with an inverted multi-index.

Each half of a vector is quantised by its own codebook, and a cell is a pair of centroids. A query walks the pairs in
the order of the summed inner products of its halves with the centroids, the next one always on top of a heap of rows.
It stops when the cells it has met hold ``share`` of all entries; in this sum a cell counts for 32 times the mean
cell at most, so that one crowded cell can't end the walk. The sum at which the walk stops, its reach, says which
cells it met. All entries of these cells are reranked by the exact inner product.

Codebooks are fitted on at most ``sample`` vectors, those with the smallest hash of their id; every vector is indexed.
The index lies in shards of about ``block`` entries, filled cell by cell; a crowded cell is dealt over shards of its own
by a hash of the id. A query goes only to the shards of cells that it met, and queries meet a shard in blocks, so no
task's size grows with the input.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored


def codebook(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Lloyd's centroids of the distinct rows of ``x``."""
    x = np.unique(x, axis=0)
    k = min(k, len(x))
    c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1)[None, :] - 2 * (x @ c.T), axis=1)


def walk(a: np.ndarray, b: np.ndarray, weight: list[float], least: float) -> float:
    """The sum a[i] + b[j] of the last cell met when cells are taken by falling sums until their weights reach ``least``."""
    order_a, order_b = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
    va, vb = (-a[order_a]).tolist(), (-b[order_b]).tolist()
    rows, columns, width = (order_a * len(b)).tolist(), order_b.tolist(), len(b)
    heap, at, held, last = [(va[0] + vb[0], 0)], [0] * len(va), 0.0, va[0] + vb[0]
    while heap and held < least:
        last, i = heap[0]
        j = at[i]
        held += weight[rows[i] + columns[j]]
        if not j and i + 1 < len(va):  # a row enters once the row above it has been met; row i stays on top, also in a tie
            heapq.heappush(heap, (va[i + 1] + vb[0], i + 1))
        at[i] = j = j + 1
        if j < width:
            heapq.heapreplace(heap, (va[i] + vb[j], i))
        else:
            heapq.heappop(heap)
    return -last


def layout(count: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """For each cell its first shard and how many shards are its own; small cells share one, in order, up to ``block`` entries."""
    own = np.maximum(1, -(-count.astype(np.int64) // block))
    first, shard, held = np.zeros(len(count), np.int64), 0, 0
    for c, n in enumerate(count.astype(np.int64).tolist()):
        if held and held + n > block:
            shard, held = shard + 1, 0
        first[c] = shard
        held += n
        if own[c] > 1:
            shard, held = shard + int(own[c]), 0
    return first, own


def shards_of(cells: np.ndarray, first: np.ndarray, own: np.ndarray) -> np.ndarray:
    """All shards of some cells."""
    n = own[cells]
    return np.unique(np.repeat(first[cells] - (np.cumsum(n) - n), n) + np.arange(n.sum()))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and v: rows whose vector is whole and finite, not zero, and of the commonest length."""
    v = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    )
    return v


def search(
    vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20, share: float = 0.55, sample: int = 20000, block: int = 16384, askers: int = 8192, walkers: int = 256
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest vectors found for each query, but the query's own.

    Vectors that are null, zero, or hold null or non-finite components take no part, neither do vectors of another
    length than the commonest. Ties go to the smaller id. ``share`` suits vectors without any cluster structure, the
    hardest case, at every size: it is the same for small tables and for large ones. Repeated rows of ``vectors`` are entries of their
    own; of query rows with one id, that with the smallest vector asks, once, and no row with its id is found for it.
    Extra columns are not read, whatever their names; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    v, q = usable(vectors, key, vector), usable(queries, key, vector)
    sizes = v.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = int(sizes[0]["dim"]), int(sizes[0]["count"])
    v, q = v.where(F.size("v") == dim), q.where(F.size("v") == dim)
    half = max(1, dim // 2)
    fitted = v.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toArrow().column("v").combine_chunks()
    x = _matrix(fitted, dim)
    wide = int(np.clip(np.sqrt(n) * 3, 4, 128))
    books = codebook(x[:, :half], wide), codebook(x[:, half:], wide) if dim > 1 else np.zeros((1, 0))
    width = len(books[1])

    def cells(m: np.ndarray) -> np.ndarray:
        return nearest(m[:, :half], books[0]) * width + (nearest(m[:, half:], books[1]) if dim > 1 else 0)

    kind = v.schema["v"].dataType.simpleString()

    def cell_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(cells(_matrix(batch.column("v"), dim)).astype(np.int32))], ["cell"])

    # At most len(book) ** 2 rows, 16,384 with the largest books.
    count = np.zeros(len(books[0]) * width)
    for r in v.select("v").mapInArrow(cell_only, "cell int").groupBy("cell").count().collect():
        count[r["cell"]] = r["count"]
    first_shard, own_shards = layout(count, block)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = cells(_matrix(batch.column("v"), dim))
                shard = first_shard[cell] + batch.column("h").to_numpy() % own_shards[cell]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cell.astype(np.int32)), batch.column("v"), pa.array(shard)], ["vec_id", "cell", "v", "shard"])

    placed = v.withColumn("h", F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 40))).select("vec_id", "v", "h").mapInArrow(place, f"vec_id long, cell int, v {kind}, shard long")
    weight = np.minimum(count, max(8.0, 32 * n / max(1, (count > 0).sum())))
    # A walk goes on until it has met enough to fill the answer.
    least = min(weight.sum(), max(weight.sum() * share, float(k + 1)))
    weight = weight.tolist()

    filled = np.flatnonzero(count)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch.column("v"), dim)
                a, b = m[:, :half] @ books[0].T, m[:, half:] @ books[1].T
                reach = [walk(a[i], b[i], weight, least) for i in range(len(m))]
                met = [filled[a[i][filled // width] + b[i][filled % width] >= reach[i] - 1e-9] for i in range(len(m))]
                shards = [shards_of(c, first_shard, own_shards) for c in met]
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), pa.array(reach), batch.column("v"), pa.array(shards, pa.list_(pa.int64()))], ["query_id", "reach", "q", "shards"])

    # Each id asks once. The queries are dealt out before the walk, which costs more than the reading.
    asked = q.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    asks = asked.count()
    visits = asked.repartition(max(1, -(-asks // walkers)), "query_id").mapInArrow(visit, f"query_id long, reach double, q {kind}, shards array<long>")
    sets = max(1, -(-asks // askers))
    visits = stored(visits, "visits")
    right = visits.select(F.explode("shards").alias("shard"), F.pmod(F.xxhash64("query_id"), F.lit(sets)).cast("int").alias("asked"), "query_id", "reach", "q")
    # Entries go to the blocks of queries that met their shard, not to all.
    needed = right.select(F.col("shard").alias("of"), F.col("asked").alias("to")).distinct()
    left = placed.join(needed, F.col("shard") == F.col("of")).select("shard", F.col("to").alias("asked"), "vec_id", "cell", "v")

    def rerank(entries: pa.Table, own: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(entries) and len(own):
            ids, cell = (entries.column(c).combine_chunks().to_numpy() for c in ("vec_id", "cell"))
            order = np.lexsort((ids, cell))
            ids, cell, m = ids[order], cell[order], _matrix(entries.column("v").combine_chunks(), dim)[order]
            lists, first, n_entries = np.unique(cell, return_index=True, return_counts=True)
            row, column = lists // width, lists % width
            for asker, reach, v in zip(own.column("query_id").to_pylist(), own.column("reach").to_pylist(), _matrix(own.column("q").combine_chunks(), dim), strict=True):
                a, b = books[0] @ v[:half], books[1] @ v[half:]
                met = a[row] + b[column] >= reach - 1e-9
                at = np.repeat(first[met] - np.concatenate(([0], np.cumsum(n_entries[met])[:-1])), n_entries[met]) + np.arange(n_entries[met].sum())
                # A matrix product finds what can be among the nearest, then each score is summed alone, in one order.
                at = at[ids[at] != asker]
                if len(at) > k:
                    near = m[at] @ v
                    at = at[near >= np.partition(near, len(near) - k)[len(near) - k] - 1e-9 * (1 + np.abs(near).max())]
                s = (m[at] * v).sum(axis=1)
                best = np.lexsort((ids[at], -s))[:k]
                out.append((np.full(len(best), asker), ids[at][best], s[best]))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    near = left.groupBy("shard", "asked").cogroup(right.groupBy("shard", "asked")).applyInArrow(rerank, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
