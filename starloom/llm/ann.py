"""Approximate nearest neighbours over low-dimensional stable projections.

Vectors are projected on ``DIMS`` Gaussian directions: a distance d becomes about
``d * sqrt(chi-square of DIMS)``. The projected space is cut by a kd-tree into cells of rows;
its planes come from a sample of ``SAMPLE`` rows at most, every row is in one cell. A query
first searches its own cell, which bounds its k-th distance, then the cells that the bound
reaches. Inside a cell, a kd-tree hands out the projected neighbours nearest first, each is
verified by its true distance, and the search ends when the next projected distance fails the
chi-square test against the k-th true distance so far. A true neighbour fails it with a chance of
``1 - CONFIDENCE`` at most, so that is the recall to expect at least. How many rows are verified depends on how
far the k-th neighbour stands out: on random directions in 64 dimensions, the worst case, about half.

Queries meet cells in blocks: a cell is repeated for every ``QUERY_BLOCK`` of the queries that reach it,
and a cell that none reaches is not read. Equal vectors can't be told apart: of each, the ``k + 1`` smallest
ids suffice for every query, so a very common vector doesn't load one cell; nothing else is left
out. Vectors that are null, zero, or hold null or non-finite components take no part. A row given
twice counts once; an id with several vectors is searched for each. Vectors of different lengths are
not comparable: each length has cells of its own. An empty table gives none.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import arrow_schema, map_batches, written

DIMS = 16
SEED = 11
SAMPLE = 20_000
CELL_ROWS = 8_000
QUERY_BLOCK = 2_000
LEAF = 256
CONFIDENCE = 0.95
# Rows verified between two looks at the k-th distance: few at first, while it still shrinks.
STEP, MAX_STEP = 32, 512

ROW = "vec_id long, embedding array<double>, p array<double>, cell string"
HIT = "query_id long, q_at long, vec_id long, score double"


def chi_square_bound(dims: int, confidence: float) -> float:
    """The quantile of the chi-square distribution, by bisection (even ``dims``: a finite sum)."""
    if dims % 2:
        raise ValueError("the number of projections has to be even")
    tail = lambda x: math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if tail(middle) > 1 - confidence else (low, middle)
    return high


def directions(size: int, dims: int = DIMS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, dims))


class Planes:
    """Cells of a kd-tree: split dimension and value per inner node, and every cell's box."""

    def __init__(self, sample: np.ndarray, cells: int):
        dims = sample.shape[1]
        self.split, self.boxes = {}, []
        depth = max(0, math.ceil(math.log2(max(1, cells))))

        def cut(path: int, rows: np.ndarray, low, high, left: int):
            widths = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(dims)
            if not left or not widths.any():
                self.split[path] = len(self.boxes)
                self.boxes.append((low, high))
                return
            d = int(widths.argmax())
            value = float(np.median(rows[:, d]))
            self.split[path] = (d, value)
            below, above = high.copy(), low.copy()
            below[d] = above[d] = value
            cut(2 * path, rows[rows[:, d] < value], low, below, left - 1)
            cut(2 * path + 1, rows[rows[:, d] >= value], above, high, left - 1)

        cut(1, sample, np.full(dims, -np.inf), np.full(dims, np.inf), depth)
        self.low, self.high = (np.array([b[i] for b in self.boxes]) for i in (0, 1))

    def cell(self, points: np.ndarray) -> np.ndarray:
        out, todo = np.zeros(len(points), np.int32), [(1, np.arange(len(points)))]
        while todo:
            path, rows = todo.pop()
            node = self.split[path]
            if isinstance(node, int):
                out[rows] = node
                continue
            right = points[rows, node[0]] >= node[1]
            todo += [(2 * path, rows[~right]), (2 * path + 1, rows[right])]
        return out

    def reach(self, point: np.ndarray) -> np.ndarray:
        """Squared projected distance from a point to every cell."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return (gap * gap).sum(axis=1)


class Tree:
    """A kd-tree over the projected points of a cell."""

    def __init__(self, points: np.ndarray):
        self.points, self.low, self.high, self.child, self.rows = points, [], [], [], []
        self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> int:
        own, node = self.points[rows], len(self.child)
        low, high = own.min(axis=0), own.max(axis=0)
        for column, value in zip((self.low, self.high, self.child, self.rows), (low, high, None, rows)):
            column.append(value)
        if len(rows) > LEAF and (high > low).any():
            d, half = int((high - low).argmax()), len(rows) // 2
            order = rows[np.argpartition(own[:, d], half)]
            self.child[node] = (self._build(order[:half]), self._build(order[half:]))
            self.rows[node] = None
        return node

    def nearest(self, point: np.ndarray):
        """(squared projected distances, rows) in pieces, nearest first throughout."""
        gap = np.maximum(np.maximum(np.array(self.low) - point, point - np.array(self.high)), 0)
        reach = (gap * gap).sum(axis=1)
        heap = [(reach[0], 0)]
        far, waiting = np.zeros(0), np.zeros(0, np.int64)
        while heap:
            node = heapq.heappop(heap)[1]
            if self.child[node] is None:
                rows = self.rows[node]
                gap = self.points[rows] - point
                far, waiting = np.concatenate([far, (gap * gap).sum(axis=1)]), np.concatenate([waiting, rows])
            else:
                for c in self.child[node]:
                    heapq.heappush(heap, (reach[c], c))
            # Rows nearer than every node that is left come next.
            ready = far <= heap[0][0] if heap else np.ones(len(far), bool)
            if ready.any():
                order = np.argsort(far[ready], kind="stable")
                yield far[ready][order], waiting[ready][order]
                far, waiting = far[~ready], waiting[~ready]


def search(
    tree: Tree, vectors, ids, query_id, query, point, k: int, bound: float, limit: float
) -> tuple[list[tuple[float, int]], int]:
    """The k nearest of a cell as (distance, id), and how many rows were verified. ``limit``: a distance already known to hold k rows."""
    best: list[tuple[float, int]] = []
    verified = 0
    for far, rows in tree.nearest(point):
        other = ids[rows] != query_id
        far, rows = far[other], rows[other]
        at, step = 0, STEP
        while at < len(rows):
            kth = min(limit, best[k - 1][0] if len(best) >= k else math.inf)
            stop = min(at + step, int(np.searchsorted(far, bound * kth * kth, side="right")))
            piece = rows[at:stop]
            gap = vectors[piece] - query
            true = np.sqrt((gap * gap).sum(axis=1))
            near = np.flatnonzero(true <= kth)
            best = sorted(best + list(zip(true[near].tolist(), ids[piece[near]].tolist())))[:k]
            verified += len(piece)
            if stop < min(at + step, len(rows)):
                return best, verified
            at, step = stop, min(2 * step, MAX_STEP)
    return best, verified


def _usable(vectors: DataFrame) -> DataFrame:
    given = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).filter("vec_id is not null and size(embedding) > 0")
    bad = "x is null or isnan(x) or abs(x) = double('Infinity')"
    rows = given.filter(f"not exists(embedding, x -> {bad}) and exists(embedding, x -> x != 0)")
    # -0.0 and 0.0 are one number, here and in grouping.
    return rows.withColumn("embedding", F.expr("transform(embedding, x -> x + 0D)")).dropDuplicates()


def _to_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_length(vectors: pa.Array):
    """(positions, matrix) of the vectors of each length."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    for size in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == size)
        yield at, _to_matrix(vectors.take(pa.array(at)))


def _projected(vectors: pa.Array) -> list[np.ndarray]:
    points = [np.zeros(0)] * len(vectors)
    for at, matrix in _by_length(vectors):
        for i, p in zip(at.tolist(), matrix @ directions(matrix.shape[1])):
            points[i] = p
    return points


def _planes(rows: DataFrame) -> dict[int, Planes]:
    """The planes of each length that has more rows than a cell holds. Only projections of a sample come to the driver."""
    size = F.size("embedding")
    counts = rows.groupBy(size.alias("n")).count().filter(F.col("count") > CELL_ROWS)
    totals = {r["n"]: r["count"] for r in counts.collect()}
    if not totals:
        return {}
    order = Window.partitionBy("n").orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id")
    large = rows.withColumn("n", size).filter(F.col("n").isin(list(totals)))
    picked = large.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= max(1, SAMPLE // len(totals)))
    points = map_batches(picked.select("n", "embedding"), "n int, p array<double>", lambda b: [b["n"], [p.tolist() for p in _projected(b["embedding"])]])
    samples: dict[int, list] = {}
    for row in points.collect():
        samples.setdefault(row["n"], []).append(row["p"])
    return {n: Planes(np.array(samples[n]), -(-total // CELL_ROWS)) for n, total in totals.items()}


def nearest(spark: SparkSession, vectors: DataFrame, is_query: str = "vec_id % 100 = 0", k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found for each query."""
    rows = written(spark, _usable(vectors), "ann-vectors")
    planes, bound = _planes(rows), chi_square_bound(DIMS, CONFIDENCE)

    def placed(batch):
        vectors = batch["embedding"]
        points, cells = _projected(vectors), [""] * len(vectors)
        for at, matrix in _by_length(vectors):
            size = matrix.shape[1]
            own = planes[size].cell(np.array([points[i] for i in at])) if size in planes else np.zeros(len(at), int)
            for i, cell in zip(at.tolist(), own.tolist()):
                cells[i] = f"{size}/{cell}"
        return [batch["vec_id"], vectors, [p.tolist() for p in points], cells]

    # Of equal vectors the smallest ids, limited before the shuffle.
    same = Window.partitionBy("embedding").orderBy("vec_id")
    kept = rows.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1).drop("copy")
    held = written(spark, map_batches(kept, ROW, placed), "ann-cells")
    queries = map_batches(rows.filter(is_query), ROW, placed).withColumn("q_at", F.xxhash64("vec_id", "embedding"))
    queries = written(spark, queries.withColumn("limit", F.lit(math.inf)).withColumn("home", F.col("cell")), "ann-queries")
    schema = arrow_schema(HIT)

    def visit(own: pa.Table, asked: pa.Table) -> pa.Table:
        hits = []
        if len(own) and len(asked):
            ids, data = own["vec_id"].to_numpy(), _to_matrix(own["embedding"])
            tree = Tree(_to_matrix(own["p"]))
            for q in asked.to_pylist():
                found, _ = search(tree, data, ids, q["vec_id"], np.array(q["embedding"]), np.array(q["p"]), k, bound, q["limit"])
                hits += [(q["vec_id"], q["q_at"], i, d) for d, i in found]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*hits) if hits else [[]] * 4, schema)], schema)

    def meet(asked: DataFrame) -> DataFrame:
        """Queries and cells, block by block."""
        # One row per cell at most, and the planes' sample bounds the cells.
        per = asked.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(QUERY_BLOCK)).cast("int").alias("blocks"))
        asked = asked.join(F.broadcast(per), "cell").withColumn("block", F.pmod("q_at", "blocks").cast("int")).drop("blocks")
        cells = held.join(F.broadcast(per), "cell").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).drop("blocks")
        return cells.groupBy("cell", "block").cogroup(asked.groupBy("cell", "block")).applyInArrow(visit, HIT)

    first = written(spark, meet(queries), "ann-home")
    far = first.groupBy("q_at").agg(F.expr(f"get(array_sort(collect_list(score)), {k - 1})").alias("kth"))

    def others(batch):
        out = [[] for _ in range(8)]
        for q in batch.to_pylist():
            limit = math.inf if q["kth"] is None else q["kth"]
            size = len(q["embedding"])
            reached = np.flatnonzero(planes[size].reach(np.array(q["p"])) <= bound * limit * limit) if size in planes else []
            for cell in (f"{size}/{number}" for number in reached):
                if cell != q["home"]:
                    for column, v in zip(out, (q["vec_id"], q["embedding"], q["p"], cell, q["q_at"], limit, q["home"])):
                        column.append(v)
        return out[:7]

    spread = map_batches(
        queries.drop("limit", "cell").join(far, "q_at", "left").select("vec_id", "embedding", "p", "home", "q_at", "kth"),
        f"{ROW}, q_at long, limit double, home string",
        others,
    )
    hits = first.unionByName(written(spark, meet(spread), "ann-others"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    # An id with several vectors is answered by the nearest of them.
    hits = hits.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
