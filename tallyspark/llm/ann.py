"""Nearest neighbours with an inverted multi-index.

Vectors are cut in two halves, and each half has a codebook of K centroids; a
pair of centroids is one of K x K cells.  The index is the table of all
vectors with their cell.  A query walks the cells in order of the sum of its
two squared distances, with a heap over pairs of sorted centroids, until the
cells visited hold ``share`` of all distinct vectors; their vectors are then
compared exactly, in double precision.

The index is written in ranges of the cell and stays where it is: queries
pass over it in broadcast blocks of ``QUERY_BLOCK``, each with the sum at which its walk
ended, so a task knows by its codebooks which of its cells a query visits.  A
task returns at most ``k + 1`` entries for each query of the block.

Equal vectors are one entry with its ``k + 1`` smallest ids, all that a result
can show, found before any shuffle by the window's group limit; so one vector
that fills a third of the table costs one entry.

The codebooks are fitted on at most ``FIT`` distinct vectors (those with the
smallest hash of the id); every vector is indexed.  K grows as the root of the
number of distinct vectors, to ``MAX_CENTROIDS`` at most, which bounds the
codebooks and the table of cell sizes that are broadcast.

``share`` sets recall against work.  Where vectors are much alike in distance
(the shared test tables: the tenth neighbour at 1.09, the average vector at
1.41) a high recall takes a large share.

Rows with a null id, and vectors that are null, empty, all zero, of another
dimension than most, or with a null or non-finite component, take no part.
Rows that repeat an id with another vector are entries of their own.  Ties go
to the smaller id.  Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.frames import arrow_map, keep
from tallyspark.session import shared_path

FIT = 16_384
MAX_CENTROIDS = 256
SHARE = 0.65
#: Fewest vectors that a query is compared with.
LEAST = 2048
QUERY_BLOCK = 16_384


def _rows(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec, h1, h2) of the rows that take part."""
    vec = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).where(
        F.col("vec_id").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return (rows.where(F.size("vec") == (sizes.n if sizes else 0))
            .withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(1), "vec")))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(uid, vec, h1, h2, ids): each vector once, with its k + 1 smallest ids;
    uid is the smallest."""
    order = Window.partitionBy("h1", "h2").orderBy("vec_id")
    few = rows.withColumn("nr", F.row_number().over(order)).where(F.col("nr") <= k + 1)
    return (few.groupBy("h1", "h2").agg(F.min("vec_id").alias("uid"), F.first("vec").alias("vec"),
                                        F.array_sort(F.collect_list("vec_id")).alias("ids")))


def fit_codebook(points: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Centroids by Lloyd's algorithm."""
    rng = np.random.default_rng(3)
    centers = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        near = ((centers ** 2).sum(axis=1) - 2 * points @ centers.T).argmin(axis=1)
        counts = np.bincount(near, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, near, points)
        centers[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centers


class Index:
    """Codebooks and cell sizes."""

    def __init__(self, sample: np.ndarray, k: int):
        half = sample.shape[1] // 2
        self.parts = (slice(0, half), slice(half, sample.shape[1]))
        self.books = [fit_codebook(sample[:, p], k) for p in self.parts]
        self.sizes = np.zeros((len(self.books[0]), len(self.books[1])), dtype=np.int64)

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        """Squared distances to the centroids of both halves."""
        return [((x[:, None, p] - b[None]) ** 2).sum(axis=2) for p, b in zip(self.parts, self.books, strict=True)]

    def cells(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.concatenate([d.argmin(axis=1) for d in ds]) if ds else np.zeros(0, np.int64)
                for ds in zip(*(self.distances(x[i:i + 512]) for i in range(0, max(len(x), 1), 512)), strict=True)]

    def walk(self, one: np.ndarray, two: np.ndarray, goal: int) -> Iterator[tuple[int, int]]:
        """Cells in order of the summed distance, until they hold ``goal``
        vectors.  The heap holds the border of the visited staircase."""
        a, b = np.argsort(one, kind="stable").tolist(), np.argsort(two, kind="stable").tolist()
        d1, d2 = one[a].tolist(), two[b].tolist()
        heap = [(d1[0] + d2[0], 0, 0)]
        reached = [0] * (len(a) + 1)  # next place of the second half, for each place of the first
        held = 0
        while heap and held < goal:
            _, i, j = heapq.heappop(heap)
            reached[i] = j + 1
            if n := int(self.sizes[a[i], b[j]]):
                held += n
                yield a[i], b[j]
            # A cell enters when both its smaller neighbours are done.
            if i + 1 < len(a) and reached[i + 1] == j:
                heapq.heappush(heap, (d1[i + 1] + d2[j], i + 1, j))
            if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (d1[i] + d2[j + 1], i, j + 1))


def _assign(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = shared.value.cells(_rows(batch.column("vec"))) if batch.num_rows else ([], [])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(one, pa.int32()), pa.array(two, pa.int32())],
                                             names=[*batch.schema.names, "c1", "c2"])
    return run


def _limits(shared, goal: int):
    """Per query the summed distance of the last cell of its walk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                limits = []
                for one, two in zip(*index.distances(_rows(rows.column("vec"))), strict=True):
                    *_, (i, j) = index.walk(one, two, goal)
                    limits.append(one[i] + two[j])
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(limits, pa.float64())],
                                                 names=[*rows.schema.names, "limit"])
    return run


class Block:
    """A block of queries, with their distances to the centroids."""

    def __init__(self, table: pa.Table, index: Index):
        self.uid, self.limit = table.column("uid").to_numpy(), table.column("limit").to_numpy()
        self.vec = _rows(table.column("vec").combine_chunks())
        parts = [index.distances(self.vec[i:i + 512]) for i in range(0, len(self.vec), 512)]
        self.one, self.two = (np.concatenate([p[k] for p in parts]) for k in (0, 1))


def _compare(shared, k: int):
    """Nearest ``k + 1`` entries of a task's part of the index for each query of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        n = len(block.uid)
        near = np.full((n, k + 1), np.inf)
        best = np.full((n, k + 1), -1)
        for batch in batches:
            if not batch.num_rows:
                continue
            vec, uid = _rows(batch.column("vec")), batch.column("uid").to_numpy()
            cell, place = np.unique(np.stack([batch.column("c1").to_numpy(), batch.column("c2").to_numpy()]),
                                    axis=1, return_inverse=True)
            for q in range(n):
                # The walk's own sums, so the comparison is exact.
                visited = block.one[q, cell[0]] + block.two[q, cell[1]] <= block.limit[q]
                at = np.flatnonzero(visited[place])
                if not len(at):
                    continue
                dist = np.sqrt(((vec[at] - block.vec[q]) ** 2).sum(axis=1))
                close = np.flatnonzero(dist <= near[q, -1])
                dist = np.concatenate([near[q], dist[close]])
                ids = np.concatenate([best[q], uid[at[close]]])
                first = np.lexsort((ids, dist))[:k + 1]
                near[q], best[q] = dist[first], ids[first]
        q, j = np.nonzero(best >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(block.uid[q]), pa.array(best[q, j]), pa.array(near[q, j])],
                                         names=["quid", "uid", "dist"])
    return run


RESULT = "query_id long, rank int, vec_id long, score double"


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, share: float = SHARE,
            query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` (vec_id
    and embedding, rows of ``vectors``) its ``k`` nearest other rows found."""
    rows = valid_vectors(vectors)
    entries = keep(distinct_vectors(rows, k), "vectors")
    total = entries.count()
    asked = keep(valid_vectors(queries).join(entries.select("h1", "h2", "uid"), ["h1", "h2"])
                 .select(F.col("vec_id").alias("query_id"), "uid"), "queries")
    wanted = asked.select("uid").distinct()
    sample = entries.select("uid", "vec").orderBy(F.xxhash64("uid"), "uid").limit(FIT).toArrow()
    if not total:
        return vectors.sparkSession.createDataFrame([], RESULT)
    centroids = int(min(MAX_CENTROIDS, max(1, 2 ** round(np.log2(max(np.sqrt(total) / 4, 1))))))
    index = Index(_rows(sample.column("vec").combine_chunks()), centroids)
    sc = vectors.sparkSession.sparkContext
    placed = keep(arrow_map(entries.select("uid", "vec"), _assign(sc.broadcast(index)),
                            "uid long, vec array<double>, c1 int, c2 int"), "index")
    for c in placed.groupBy("c1", "c2").count().collect():  # at most MAX_CENTROIDS squared
        index.sizes[c.c1, c.c2] = c["count"]
    goal = max(int(np.ceil(share * total)), LEAST)
    placed = keep(placed.repartitionByRange("c1", "c2", "uid").sortWithinPartitions("c1", "c2"), "cells")
    queries = keep(arrow_map(placed.join(wanted, "uid", "left_semi").select("uid", "vec"),
                             _limits(sc.broadcast(index), goal), "uid long, vec array<double>, limit double"), "limits")
    blocks = -(-queries.count() // query_block)
    path = shared_path(vectors.sparkSession, "near")
    found_schema = "quid long, uid long, dist double"
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == b).toArrow()
        if block.num_rows:
            shared = sc.broadcast(Block(block, index))
            arrow_map(placed, _compare(shared, k), found_schema).write.mode("append").parquet(path)
            shared.unpersist()
    if not blocks:
        return vectors.sparkSession.createDataFrame([], RESULT)
    near = vectors.sparkSession.read.schema(found_schema).parquet(path)
    self_pairs = wanted.select(F.col("uid").alias("quid"), "uid", F.lit(0.0).alias("dist"))
    first = Window.partitionBy("quid").orderBy("dist", "uid")
    best = (near.where("quid <> uid").union(self_pairs).withColumn("nr", F.row_number().over(first))
            .where(F.col("nr") <= k + 1).drop("nr"))
    # Entries back to rows: the k + 1 nearest ids of each distinct query.
    found = (best.join(entries.select("uid", "ids"), "uid")
             .select("quid", F.explode(F.transform("ids", lambda i: F.struct(F.col("dist"), i.alias("vec_id"))))
                     .alias("x")).select("quid", "x.*"))
    by_id = Window.partitionBy("quid").orderBy("dist", "vec_id")
    lists = (found.withColumn("nr", F.row_number().over(by_id)).where(F.col("nr") <= k + 1)
             .groupBy("quid").agg(F.array_sort(F.collect_list(F.struct("dist", "vec_id"))).alias("near")))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (asked.join(lists, F.col("uid") == F.col("quid"))
            .select("query_id", F.posexplode(others).alias("place", "x"))
            .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "x.vec_id",
                    F.col("x.dist").alias("score")))

