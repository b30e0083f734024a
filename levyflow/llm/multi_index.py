"""Nearest neighbours by inner product from an inverted multi-index.

Both halves of the vectors have their own centroids, and a cell is a pair of them, so few centroids
make many cells. A query visits the cells in the order of its summed closeness to both centroids, from
a heap, until they hold enough entries; these are scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from levyflow.llm.caps import as_vector, usable
from levyflow.llm.shared import ship_package, stored

NEAREST = 20
# Vectors that the centroids are fitted on at most, those with the smallest hashes of their keys.
SAMPLE = 20_000
FIT_ROUNDS = 10
# Centroids of a half: about ENTRIES_PER_CELL vectors a cell. The counts of all cells are sent to every
# task, which bounds the number of centroids.
LEAST_CENTROIDS, MOST_CENTROIDS, ENTRIES_PER_CELL = 64, 512, 12
# Share of all vectors that a query's cells hold at least. Vectors without any clusters need this much
# for a recall of 0.95; clustered ones need far less.
SHARE, LEAST_ENTRIES = 0.6, 1024
# Vectors and queries that a task scores against each other.
ENTRY_BLOCK, QUERY_BLOCK = 8192, 2048


def centroids_for(rows: int) -> int:
    wanted = math.sqrt(max(1, rows / ENTRIES_PER_CELL))
    return min(MOST_CENTROIDS, max(LEAST_CENTROIDS, 1 << int(math.log2(wanted))))


def fit_centroids(sample: np.ndarray, centroids: int) -> tuple[np.ndarray, np.ndarray]:
    """k-means of either half, from evenly spaced starting points of the sample."""
    half = sample.shape[1] // 2
    return tuple(_kmeans(part, centroids) for part in (sample[:, :half], sample[:, half:]))


def _kmeans(points: np.ndarray, k: int) -> np.ndarray:
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(FIT_ROUNDS):
        own = _nearest(points, centres)
        sizes = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(points @ centres.T - (centres * centres).sum(axis=1) / 2, axis=1)


def visited_cells(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> np.ndarray:
    """The cells to visit, as a mask: by falling ``first[i] + second[j]`` until ``wanted`` entries are in them.

    The multi-sequence walk: a pair is put on the heap once both its better neighbours are visited. What
    is visited of a row is a beginning of its order, so one number for each row tells it all.
    """
    by_first, by_second = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b = first[by_first].tolist(), second[by_second].tolist()
    sizes = counts[np.ix_(by_first, by_second)].tolist()
    reach, heap, entries = [0] * len(a), [(-(a[0] + b[0]), 0, 0)], 0
    while heap and entries < wanted:
        _, i, j = heappop(heap)
        entries += sizes[i][j]
        reach[i] = j + 1
        if i + 1 < len(a) and reach[i + 1] == j:
            heappush(heap, (-(a[i + 1] + b[j]), i + 1, j))
        if j + 1 < len(b) and (i == 0 or reach[i - 1] > j + 1):
            heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
    mask = np.zeros(counts.shape, dtype=bool)
    for i, n in enumerate(reach):
        mask[by_first[i], by_second[:n]] = True
    return mask


def nearest(
    vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = NEAREST,
    sample: int = SAMPLE, share: float = SHARE, centroids: int | None = None, least: int = LEAST_ENTRIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest rows found for each row where ``is_query`` holds
    (a condition on the column ``key``), by inner product in double precision; ties go to the smaller key.

    All rows but the query's own are candidates, and every row is in the index. Rows with a null key, and
    vectors that are null, zero or hold null or non-finite components, take no part; neither do vectors of
    another length than most. Rows that repeat a key are rows of their own, as candidates and as queries. If
    there are fewer than ``k`` candidates, all are returned. An empty table gives no rows. Other columns
    are not read.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(key).cast("long").alias("key"), as_vector(vectors, vector).alias("v"))
    rows = rows.where(F.col("key").isNotNull() & usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, total = sizes
    rows = stored(
        rows.where(F.size("v") == dim).select(F.monotonically_increasing_id().alias("row"), "key", "v"), "vectors")
    drawn = rows.orderBy(F.xxhash64("key"), "row").select("v").limit(sample).toArrow()
    kinds = centroids or centroids_for(total)
    books = fit_centroids(_stack(drawn.column("v").combine_chunks()), kinds)
    entries = stored(_assigned(rows, books), "entries")

    counts = np.zeros((kinds, kinds), dtype=np.int64)
    for r in entries.groupBy("i", "j").count().collect():  # at most centroids squared
        counts[r["i"], r["j"]] = r["count"]
    queries = entries.where(is_query(F.col("key"))).select("row", "key", "v")
    walks = _walks(queries, books, counts, max(least, math.ceil(share * total)))

    # Entries of a first centroid are dealt to chunks, and queries to blocks; every chunk meets every block.
    chunks = np.maximum(1, -(-counts.sum(axis=1) // ENTRY_BLOCK))
    chunk_count = F.element_at(F.array(*[F.lit(int(n)).cast("long") for n in chunks]), F.col("i") + 1)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    left = entries.withColumn("chunk", F.pmod(F.xxhash64("row"), chunk_count)).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    right = walks.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunk_count - 1)))
    group = ("i", "chunk", "block")
    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(
        lambda a, b: _scored(a, b, k), "query long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def _stack(lists: pa.ListArray) -> np.ndarray:
    return lists.values.to_numpy().astype(np.float64).reshape(len(lists), -1) if len(lists) else np.zeros((0, 2))


def _assigned(rows: DataFrame, books: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Adds the cell ``i, j``."""
    kind = dict(rows.dtypes)["v"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.stack([np.asarray(v, dtype=np.float64) for v in batch.column(2).to_numpy(zero_copy_only=False)])
            half = points.shape[1] // 2
            cell = [_nearest(p, c).astype(np.int32) for p, c in zip((points[:, :half], points[:, half:]), books)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, cell)], ["row", "key", "v", "i", "j"])

    return rows.mapInArrow(work, f"row long, key long, v {kind}, i int, j int")


def _walks(queries: DataFrame, books: tuple[np.ndarray, np.ndarray], counts: np.ndarray, wanted: int) -> DataFrame:
    """For each query and first centroid it visits, the second centroids, as packed bits."""
    kind = dict(queries.dtypes)["v"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.stack([np.asarray(v, dtype=np.float64) for v in batch.column(2).to_numpy(zero_copy_only=False)])
            half = points.shape[1] // 2
            scores = [p @ c.T for p, c in zip((points[:, :half], points[:, half:]), books)]
            for at, (first, second) in enumerate(zip(*scores)):
                mask = visited_cells(first, second, counts, wanted)
                rows = np.flatnonzero(mask.any(axis=1))
                bits = [np.packbits(m).tobytes() for m in mask[rows]]
                own = [c.take(pa.array(np.full(len(rows), at))) for c in batch.columns]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(rows.astype(np.int32)), pa.array(bits, pa.binary())], ["row", "key", "v", "i", "seconds"])

    return queries.mapInArrow(work, f"row long, key long, v {kind}, i int, seconds binary")


def _scored(entries: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The best of a chunk for each query of a block, with exact scores."""
    out: list[tuple[np.ndarray, ...]] = []
    if entries.num_rows and queries.num_rows:
        row, key, cell = (entries.column(c).to_numpy() for c in ("row", "key", "j"))
        points = _stack(entries.column("v").combine_chunks())
        asked, asked_key = (queries.column(c).to_numpy() for c in ("row", "key"))
        wanted = _stack(queries.column("v").combine_chunks())
        seconds = [np.unpackbits(np.frombuffer(b, dtype=np.uint8)) for b in queries.column("seconds").to_pylist()]
        for at in range(0, len(wanted), 256):
            part = slice(at, at + 256)
            rough = wanted[part] @ points.T
            rough[np.stack(seconds[part])[:, cell] == 0] = -np.inf
            rough[asked[part][:, None] == row[None, :]] = -np.inf
            for q, scores in enumerate(rough, at):
                # Products of matrices round differently from place to place: near the edge all are
                # scored again, in one fixed order, so that equal vectors tie.
                edge = np.partition(scores, -k)[-k] if len(scores) > k else -np.inf
                margin = 1e-9 * max(1.0, abs(edge)) if np.isfinite(edge) else 0.0
                near = np.flatnonzero((scores >= edge - margin) & (scores > -np.inf))
                exact = (points[near] * wanted[q]).sum(axis=1)
                best = np.lexsort((key[near], -exact))[:k]
                out.append((np.full(len(best), asked[q]), np.full(len(best), asked_key[q]), key[near][best], exact[best]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [[]] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query", "query_id", "vec_id", "score"])
