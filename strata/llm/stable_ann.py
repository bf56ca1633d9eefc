"""Nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Vectors are projected to ``M`` Gaussian (2-stable) coordinates. A projected squared distance is the true one times
a chi-square variable with ``M`` degrees, so once the next projected neighbour is farther than the ``CHANCE``
quantile times the squared distance of the k-th neighbour so far, a nearer vector was missed with at most
``1 - CHANCE``. The kd-tree's upper levels deal the vectors into cells, its lower levels are built in each block of
a cell; a query visits its own cell first, then each cell that the test cannot rule out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

#: Projected coordinates, and the quantile of chi-square with M degrees at CHANCE = 0.98.
M, CHANCE, QUANTILE = 12, 0.98, 24.054
#: The upper levels come from at most SAMPLE projected vectors and make at most CELLS cells; a block holds about
#: BLOCK vectors, a leaf at most LEAF; a task of one block answers about QUERIES queries.
SAMPLE, CELLS, BLOCK, LEAF, QUERIES = 20_000, 512, 8192, 64, 4096


def projection(size: int) -> np.ndarray:
    return np.random.default_rng([size, M]).normal(size=(size, M))


def kd_split(points: np.ndarray, leaves: int) -> list[tuple]:
    """A kd-tree over sample points as ``(axis, cut, below, above)`` nodes; negative children are leaves, -1 - number."""
    nodes: list[tuple] = []
    numbers = iter(range(1 << 30))

    def grow(own: np.ndarray, n: int) -> int:
        axis = int(np.ptp(own, axis=0).argmax()) if len(own) else 0
        if n < 2 or len(own) < 2 or np.ptp(own[:, axis]) == 0:
            return -1 - next(numbers)
        cut = float(np.median(own[:, axis]))
        below = own[:, axis] < cut
        if not below.any():  # over half of the points share the median
            cut = float(own[:, axis][own[:, axis] > cut].min())
            below = own[:, axis] < cut
        me = len(nodes)
        nodes.append(())
        lo = grow(own[below], n // 2)
        nodes[me] = (axis, cut, lo, grow(own[~below], n - n // 2))
        return me

    grow(points, leaves)
    return nodes


def cells_of(nodes: list[tuple], points: np.ndarray) -> np.ndarray:
    """The leaf number of each point."""
    out = np.zeros(len(points), np.int64)
    todo = [(0 if nodes else -1, np.arange(len(points)))]
    while todo:
        node, at = todo.pop()
        if node < 0:
            out[at] = -1 - node
            continue
        axis, cut, lo, hi = nodes[node]
        below = points[at, axis] < cut
        todo += [(lo, at[below]), (hi, at[~below])]
    return out


def boxes(nodes: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """The lower and upper corners of the leaves."""
    found: dict[int, tuple] = {}
    todo = [(0 if nodes else -1, np.full(M, -np.inf), np.full(M, np.inf))]
    while todo:
        node, lo, hi = todo.pop()
        if node < 0:
            found[-1 - node] = (lo, hi)
            continue
        axis, cut, below, above = nodes[node]
        mid_hi, mid_lo = hi.copy(), lo.copy()
        mid_hi[axis], mid_lo[axis] = cut, cut
        todo += [(below, lo, mid_hi), (above, mid_lo, hi)]
    return tuple(np.array([found[i][k] for i in range(len(found))]) for k in (0, 1))


def _gap(lo: np.ndarray, hi: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances from a point to boxes."""
    d = np.maximum(np.maximum(lo - q, q - hi), 0)
    return (d * d).sum(axis=1)


class Tree:
    """The lower levels of the kd-tree: the vectors of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projected: np.ndarray) -> None:
        leaf = cells_of(nodes := kd_split(projected, max(1, -(-len(ids) // LEAF))), projected)
        order = np.lexsort((ids, leaf))
        self.ids, self.vectors, own = ids[order], vectors[order], projected[order]
        del nodes
        self.starts = np.flatnonzero(np.concatenate(([True], np.diff(leaf[order]) > 0)))
        self.ends = np.concatenate((self.starts[1:], [len(ids)]))
        self.lo, self.hi = np.minimum.reduceat(own, self.starts), np.maximum.reduceat(own, self.starts)

    def search(self, me: int | None, vector: np.ndarray, projected: np.ndarray, k: int, far: float) -> list[tuple[float, int]]:
        """Up to ``k`` nearest ``(distance, id)`` but ``me``. Leaves come by projected distance and are verified on
        the whole vectors, until the chi-square test holds for the next one. ``far`` bounds the k-th distance."""
        gap = _gap(self.lo, self.hi, projected)
        order = np.argsort(gap, kind="stable")
        near_d, near_i, at, step = np.empty(0), np.empty(0, np.int64), 0, 2
        while at < len(order):
            bound = min(far, near_d[-1] if len(near_d) == k else np.inf)
            take = order[at:at + step]
            take = take[gap[take] <= QUANTILE * bound * bound]
            if not len(take):
                break
            rows = np.concatenate([np.arange(s, e) for s, e in zip(self.starts[take], self.ends[take], strict=True)])
            diff = self.vectors[rows].astype(np.float64) - vector
            d, i = np.sqrt((diff * diff).sum(axis=1)), self.ids[rows]
            if me is not None:
                d, i = d[i != me], i[i != me]
            near_d, near_i = np.concatenate((near_d, d)), np.concatenate((near_i, i))
            best = np.lexsort((near_i, near_d))[:k]
            near_d, near_i = near_d[best], near_i[best]
            at, step = at + len(order[at:at + step]), min(step * 2, 64)
        return list(zip(near_d.tolist(), near_i.tolist(), strict=True))


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, v, size)`` of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    ok = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists(v, lambda x: x != 0)
    return vectors.filter(ok).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.size(vector_col).alias("size"))


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


def nearest(spark: SparkSession, vectors: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each row whose id is divisible by ``every``,
    among all other rows of its vector length, by Euclidean distance in double precision, ties to the smaller id.

    Rows with a null id, and vectors that are null, empty, zero or hold null or non-finite components, take no part.
    Rows that repeat an id are one candidate each (a query never finds its own id) and their query is asked once, for
    the smallest of its vectors. Fewer candidates than ``k`` are all returned. An empty table gives no rows; other
    columns are not read. Identical vectors fill a cell, which is dealt to as many blocks as its size asks for."""
    rows = stored(spark, _valid(vectors, id_col, vector_col), "ann-vectors")
    sizes = {r["size"]: r["n"] for r in rows.groupBy("size").agg(F.count("*").alias("n")).orderBy("size").collect()}
    out = None
    for size, n in sizes.items():
        part = _nearest(spark, rows.filter(F.col("size") == size), size, n, every, k)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return out


def _nearest(spark: SparkSession, rows: DataFrame, size: int, n: int, every: int, k: int) -> DataFrame:
    matrix = projection(size)
    # a bounded sample shapes the upper levels; every vector is dealt by them
    share = min(1.0, SAMPLE / n)
    chosen = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("v").limit(SAMPLE)
    sample = np.array([r["v"] for r in chosen.collect()], float).reshape(-1, size) @ matrix
    nodes = kd_split(sample, min(CELLS, max(1, -(-n // BLOCK))))
    lo, hi = boxes(nodes)

    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cells_of(nodes, _matrix(b.column(1)) @ matrix), pa.int64())],
                                                 ["vec_id", "v", "cell"])

    placed = stored(spark, rows.select("vec_id", "v").mapInArrow(cell, "vec_id long, v array<double>, cell long"), "ann-cells")
    held = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # at most CELLS rows
    blocks = F.create_map(*[F.lit(x) for c, m in sorted(held.items()) for x in (c, -(-m // BLOCK))])
    asked = placed.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("v", "cell")).alias("q")).select("vec_id", "q.v", "q.cell")
    asked = stored(spark, asked, "ann-queries")
    groups = max(1, -(-asked.count() // QUERIES))
    block = lambda salt: F.struct("cell", salt.alias("block"), F.col("group"))
    all_groups = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    data = (placed.select("*", all_groups)
            .select("vec_id", "v", block(F.pmod(F.xxhash64("vec_id", "v"), blocks[F.col("cell")])).alias("at")))

    def search(points: pa.Table, queries: pa.Table) -> pa.Table:
        ids, scores, of = [], [], []
        if points.num_rows and queries.num_rows:
            v = _matrix(points.column("v").combine_chunks())
            tree = Tree(points.column("vec_id").to_numpy(), v, v @ matrix)
            q = _matrix(queries.column("v").combine_chunks())
            for me, x, p, far in zip(queries.column("vec_id").to_pylist(), q, q @ matrix, queries.column("far").to_pylist(), strict=True):
                got = tree.search(me, x, p, k, far)
                of += [me] * len(got)
                scores += [d for d, _ in got]
                ids += [i for _, i in got]
        return pa.table({"query_id": pa.array(of, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())})

    def found(queries: DataFrame) -> DataFrame:
        salts = F.explode(F.sequence(F.lit(0), blocks[F.col("cell")].cast("int") - 1)).alias("salt")
        sent = (queries.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")).select("*", salts)
                .select("vec_id", "v", "far", block(F.col("salt").cast("long")).alias("at")))
        return data.groupBy("at").cogroup(sent.groupBy("at")).applyInArrow(search, "query_id long, vec_id long, score double")

    ranked = lambda df: df.withColumn("rank", F.row_number().over(
        Window.partitionBy("query_id").orderBy("score", "vec_id"))).filter(F.col("rank") <= k)
    home = stored(spark, ranked(found(asked.withColumn("far", F.lit(float("inf"))))).drop("rank"), "ann-home")
    far = home.groupBy(F.col("query_id").alias("of")).agg(F.when(F.count("*") >= k, F.max("score")).alias("far"))
    reach = asked.join(far, asked["vec_id"] == far["of"], "left").select("vec_id", "v", "cell", F.coalesce("far", F.lit(float("inf"))).alias("far"))
    some = sorted(held)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with the other cells that the test cannot rule out by their boxes."""
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                gap = _gap(lo[some], hi[some], (_matrix(one.column(1)) @ matrix)[0])
                d = one.column(3)[0].as_py()
                cells = [c for c, g in zip(some, gap, strict=True) if g <= QUANTILE * d * d and c != one.column(2)[0].as_py()]
                at = pa.array([0] * len(cells), pa.int64())
                yield pa.RecordBatch.from_arrays([one.column(0).take(at), one.column(1).take(at), pa.array(cells, pa.int64()), one.column(3).take(at)],
                                                 ["vec_id", "v", "cell", "far"])

    others = reach.mapInArrow(visit, "vec_id long, v array<double>, cell long, far double")
    best = ranked(home.unionByName(found(others)))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
