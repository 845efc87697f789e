"""Exact search of the largest integer inner products with a pivot table.

Components x become floor(1024 * x).  For a query q and a vector v the inner
product is (|q|^2 + |v|^2 - d(q, v)^2) / 2, and by the triangle inequality
d(q, v) >= |d(q, p) - d(v, p)| for every pivot p.  The table holds the
distances of all vectors to ``PIVOTS`` pivots (the origin among them), so the
greatest of these lower bounds gives an upper bound of the product that costs
no look at the vector.  Candidates are evaluated in the order of their bounds
until the next bound is below the k-th best product found: what is left
cannot enter the result, which is exact whatever the pivots are.

The work.  Equal vectors are one entry with its ``k + 1`` smallest ids, all
that a result can show, found before any shuffle by the window's group limit;
a vector that fills a third of the table costs one entry.  The table is
written in ranges of (nearest pivot, distance to it), so that a batch of it
covers a short stretch of distances and is passed over as a whole by queries
that are far from it.  Queries go over the table in broadcast blocks of
``QUERY_BLOCK``; a task returns at most ``k + 1`` entries for each query of
the block.  Each query starts from the k-th best product among the ``FIT``
sampled vectors that the pivots are chosen from (a fixed number).

Products are sums of whole numbers in double precision, exact below 2^53:
vectors take part if their scaled squared length is below that (components to
about 92,000).  Rows with a null id and vectors that are null, empty, of
another dimension than most, or that hold a null or non-finite component take
no part; zero vectors do.  Candidates are rows: one that repeats a query's id
or its vector is a candidate, the query's own row is not.  Repeated queries
have a result each.  Ties go to the smaller id.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.frames import arrow_map, keep
from tallyspark.session import shared_path

PIVOTS = 32
FIT = 4096
QUERY_BLOCK = 16_384
#: Queries bounded at once in a task, and candidates evaluated at first.
ROWS, FIRST = 128, 256
EXACT = float(1 << 53)
RESULT = "query_id long, rank int, vec_id long, score long"


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec) of the rows that take part, scaled."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("raw"))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("raw") > 0) & F.forall(
        "raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 26))))
    scaled = rows.select("vec_id", F.transform("raw", lambda x: F.floor(x * 1024)).alias("v"))
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return scaled.where(length < EXACT).select("vec_id", F.col("v").cast("array<int>").alias("vec"))


def _usual_size(rows: DataFrame) -> DataFrame:
    """The rows of the commonest dimension (the smaller one of two)."""
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (sizes.n if sizes else 0))


def distinct_entries(rows: DataFrame, most: int) -> DataFrame:
    """(uid, h, vec, ids): each vector once, with its ``most`` smallest ids."""
    rows = rows.withColumn("h", F.xxhash64("vec"))
    few = (rows.withColumn("nr", F.row_number().over(Window.partitionBy("h", "vec").orderBy("vec_id")))
           .where(F.col("nr") <= most))
    return (few.groupBy("h", "vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
            .select(F.monotonically_increasing_id().alias("uid"), "h", "vec", "ids"))


class Pivots:
    """Pivots chosen far from each other, and the sample they come from."""

    def __init__(self, uids: np.ndarray, sample: np.ndarray, n: int):
        self.uids, self.sample = uids, sample.astype(np.float64)
        chosen = [np.zeros(sample.shape[1])]
        reach = np.sqrt((self.sample ** 2).sum(axis=1))
        for _ in range(min(n - 1, len(sample))):
            far = int(reach.argmax())
            if reach[far] == 0:
                break
            chosen.append(self.sample[far])
            reach = np.minimum(reach, np.sqrt(((self.sample - chosen[-1]) ** 2).sum(axis=1)))
        self.points = np.array(chosen)

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Distances to all pivots; squares are whole numbers, so only the root rounds."""
        square = ((x ** 2).sum(axis=1)[:, None] + (self.points ** 2).sum(axis=1)[None] - 2 * (x @ self.points.T))
        return np.sqrt(np.maximum(square, 0))

    def floors(self, uid: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
        """The k-th best product in the sample, the query's own entry left out."""
        if len(self.uids) <= k:
            return np.full(len(x), -np.inf)
        scores = x @ self.sample.T
        scores[self.uids[None] == uid[:, None]] = -np.inf
        return -np.partition(-scores, k - 1, axis=1)[:, k - 1]


def _table(shared):
    """The pivot table: distances to the pivots, the nearest one but the origin, its distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            x = _matrix(batch.column("vec")).astype(np.float64)
            d = pivots.distances(x) if len(x) else np.zeros((0, len(pivots.points)))
            others = d[:, 1:] if d.shape[1] > 1 else d
            near = others.argmin(axis=1) if len(x) else np.zeros(0, np.int64)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1, dtype=np.int32) * d.shape[1]),
                                            pa.array(d.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("least"), batch.column("vec"), flat, pa.array(near, pa.int32()),
                 pa.array(others[np.arange(len(x)), near])], names=["uid", "least", "vec", "d", "near", "reach"])
    return run


def _floors(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = _matrix(part.column("vec")).astype(np.float64)
                floor = shared.value.floors(part.column("uid").to_numpy(), x, k)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(floor)], names=[*part.schema.names, "floor"])
    return run


class Block:
    """A block of queries: what is broadcast."""

    def __init__(self, table: pa.Table):
        self.uid = table.column("uid").to_numpy()
        self.vec = _matrix(table.column("vec")).astype(np.int32)
        self.d = _matrix(table.column("d"))
        self.floor = table.column("floor").to_numpy()


class Best:
    """The best entries so far of each query of a block, in one task."""

    def __init__(self, floor: np.ndarray, most: int):
        n = len(floor)
        self.most = most
        self.floor = floor.copy()  # no entry below it can be among the best
        self.score = np.full((n, most), -np.inf)
        self.least = np.full((n, most), np.iinfo(np.int64).max)
        self.uid = np.full((n, most), -1)

    def add(self, q: int, score: np.ndarray, least: np.ndarray, uid: np.ndarray) -> None:
        at = score >= self.floor[q]
        if not at.any():
            return
        score = np.concatenate([self.score[q], score[at]])
        least = np.concatenate([self.least[q], least[at]])
        uid = np.concatenate([self.uid[q], uid[at]])
        best = np.lexsort((uid, least, -score))[:self.most]
        self.score[q], self.least[q], self.uid[q] = score[best], least[best], uid[best]
        self.floor[q] = max(self.floor[q], self.score[q, -1])


def evaluate(block: Block, best: Best, vec: np.ndarray, d: np.ndarray, uid: np.ndarray, least: np.ndarray) -> int:
    """Bring a batch of the table to every query of the block; returns how
    many products were taken."""
    taken = 0
    norm = (vec ** 2).sum(axis=1)
    low, high = d.min(axis=0), d.max(axis=0)
    own = (block.vec.astype(np.float64) ** 2).sum(axis=1)
    # Rounding of a root: far below 1e-9 of the largest distance at hand; single floats: below 1e-6 of it.
    slack = 2e-6 * (1 + max(float(high.max()), float(block.d.max()) if len(block.d) else 0.0))
    gap = np.maximum(np.maximum(low - block.d, block.d - high).max(axis=1) - slack, 0)
    live = np.flatnonzero((own + norm.max() - gap ** 2) / 2 + 1 >= best.floor)
    small = np.ascontiguousarray(d.T, dtype=np.float32)
    for at in range(0, len(live), ROWS):
        some = live[at:at + ROWS]
        dq = block.d[some].astype(np.float32)
        bound = np.zeros((len(some), len(vec)), np.float32)
        gap = np.empty_like(bound)
        for p in range(len(small)):
            np.subtract(dq[:, p, None], small[p][None], out=gap)
            np.abs(gap, out=gap)
            np.maximum(bound, gap, out=bound)
        for row, q in enumerate(some):
            lower = np.maximum(bound[row] - slack, 0)
            upper = (own[q] + norm - lower.astype(np.float64) ** 2) / 2 + 1
            left = np.flatnonzero(upper >= best.floor[q])
            left = left[np.argsort(-upper[left], kind="stable")]
            x = block.vec[q].astype(np.float64)
            begin, size = 0, FIRST
            while begin < len(left) and upper[left[begin]] >= best.floor[q]:
                part = left[begin:begin + size]
                best.add(q, vec[part] @ x, least[part], uid[part])
                taken += len(part)
                begin, size = begin + size, size * 2
    return taken


def _search(shared, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        best = Best(block.floor, most)
        for batch in batches:
            if batch.num_rows:
                evaluate(block, best, _matrix(batch.column("vec")).astype(np.float64), _matrix(batch.column("d")),
                         batch.column("uid").to_numpy(), batch.column("least").to_numpy())
        q, place = np.nonzero(best.uid >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.uid[q]), pa.array(best.uid[q, place]), pa.array(best.least[q, place]),
             pa.array(best.score[q, place].astype(np.int64))], names=["quid", "uid", "least", "score"])
    return run


def _without_own(near, uid, query_id, k: int):
    """The first ``k`` of ``near`` after the query's own row left."""
    own = F.array_position(F.transform(near, lambda x: (x["uid"] == uid) & (x["vec_id"] == query_id)), True)
    others = F.filter(near, lambda x, i: (own == 0) | (i + 1 != own))
    return F.slice(others, 1, k)


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 10, pivots: int = PIVOTS,
                 query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` (rows of
    ``vectors``) its ``k`` other rows of the largest integer inner product."""
    spark = vectors.sparkSession
    sc = spark.sparkContext
    rows = _usual_size(whole_vectors(vectors))
    entries = keep(distinct_entries(rows, k + 1), "entries")
    sample = entries.select("uid", "vec").orderBy(F.xxhash64("h"), "uid").limit(FIT).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], RESULT)
    chosen = sc.broadcast(Pivots(sample.column("uid").to_numpy(), _matrix(sample.column("vec")), pivots))
    table = arrow_map(entries.select("uid", F.col("ids")[0].alias("least"), "vec"), _table(chosen),
                      "uid long, least long, vec array<int>, d array<double>, near int, reach double")
    table = keep(table.repartitionByRange("near", "reach", "uid").sortWithinPartitions("near", "reach"), "pivot_table")
    asked = keep(whole_vectors(queries).withColumn("h", F.xxhash64("vec"))
                 .join(entries.select("h", "vec", "uid"), ["h", "vec"])
                 .select(F.col("vec_id").alias("query_id"), "uid"), "asked")
    wanted = asked.select("uid").distinct()
    blocks = -(-wanted.count() // query_block)
    if not blocks:
        return spark.createDataFrame([], RESULT)
    wanted = keep(arrow_map(table.join(wanted, "uid", "left_semi").select("uid", "vec", "d"), _floors(chosen, k),
                            "uid long, vec array<int>, d array<double>, floor double"), "wanted")
    path = shared_path(spark, "products")
    for b in range(blocks):
        block = wanted.where(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == b).toArrow()
        if not block.num_rows:
            continue
        shared = sc.broadcast(Block(block))
        (arrow_map(table.select("uid", "least", "vec", "d"), _search(shared, k + 1),
                   "quid long, uid long, least long, score long").write.mode("append").parquet(path))
        shared.unpersist()
    order = Window.partitionBy("quid").orderBy(F.desc("score"), "least", "uid")
    best = (spark.read.schema("quid long, uid long, least long, score long").parquet(path)
            .withColumn("nr", F.row_number().over(order)).where(F.col("nr") <= k + 1).select("quid", "uid", "score"))
    # Entries back to rows: sorted by falling score, then id.
    found = (best.join(entries.select("uid", "ids"), "uid")
             .groupBy("quid").agg(F.slice(F.array_sort(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(
                 (-F.col("score")).alias("fall"), i.alias("vec_id"), F.col("uid").alias("uid")))))), 1, k + 1)
                 .alias("near")))
    rest = _without_own(F.col("near"), F.col("uid"), F.col("query_id"), k)
    return (asked.join(found, F.col("uid") == F.col("quid"))
            .select("query_id", F.posexplode(rest).alias("place", "x"))
            .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "x.vec_id",
                    (-F.col("x.fall")).alias("score")))


#: The same in DuckDB: all rows against the queries.
ORACLE = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
