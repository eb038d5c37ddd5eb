"""Exact top-k by inner product with a pivot-distance index.

Vectors are whole numbers. With one more component, sqrt(M^2 - |x|^2) for a candidate x (M the
largest norm) and 0 for a query q, the squared distance is |q|^2 + M^2 - 2 q.x: the nearest
candidates are those with the highest inner product, and distances obey the triangle
inequality. Candidates are keyed by nearest pivot and by their distance from it, in sorted
annuli. A query looks into its most promising annuli first; the scores found there bound the
distance that can still matter, and an annulus is opened only if the triangle inequality allows
a candidate that near. Pivots come from a bounded sample; they decide the work, not the result.

Equal vectors are one class with its smallest ids, so a vector repeated any number of times is
one candidate. Annuli are put together, or cut, to blocks that fill a worker's memory. A block is
one partition: its candidates come first and are held, then the queries that look into it stream
past, a row each. Neither side is ever broadcast, and the driver gets the sample and one row per
annulus, whatever the size of the tables.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from msgledger.llm.common import map_arrow, small_batches, stage_table

SAMPLE = 4096  # classes that pivots and first bounds come from
BLOCK = 1024  # classes of a block at least, where there are cores for more blocks
BLOCK_BYTES = 2**25  # of a block's vectors at most
SLICE = 2048  # classes that are compared at once
RINGS = 8
MAX_PIVOTS = 256
FIRST = 4  # annuli that are opened first
LARGEST = 2.0**63


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x): the rows that take part."""
    x = F.col("x")
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("x")).where(
        F.col("vec_id").isNotNull() & x.isNotNull() & ~bad)


def extent(good: DataFrame) -> tuple[int, float]:
    """The dimension, and the size of the largest component."""
    dim, largest = good.agg(F.max(F.size("x")), F.max(F.greatest(F.array_max("x"), -F.array_min("x")))).first()
    return dim or 0, largest or 0.0


def whole(largest: float) -> str:
    """The shortest type for components up to ``largest`` once they are whole numbers."""
    return next((f"<i{b}" for b in (2, 4) if 256 * largest < 2.0 ** (8 * b - 1) - 1), "<i8")


def quantised(good: DataFrame, dim: int, kind: str) -> DataFrame:
    """(vec_id, v): 256 times each component, floored, as little-endian numbers of type ``kind``."""

    def run(batch: pa.RecordBatch):
        values = batch.column(1)
        v = np.zeros((len(values), dim))
        v[np.arange(dim) < values.value_lengths().to_numpy(zero_copy_only=False)[:, None]] = values.flatten().to_numpy(zero_copy_only=False)
        v = np.floor(256 * v)
        if np.abs(v).max(initial=0) >= LARGEST:
            raise ValueError("a vector has a component that does not fit 64 bits")
        yield pa.RecordBatch.from_arrays([batch.column(0), packed(v.astype(kind))], ["vec_id", "v"])

    return map_arrow(good, run, "vec_id long, v binary")


def packed(x: np.ndarray) -> pa.Array:
    """Each row of numbers as bytes."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))])


def classes(rows: DataFrame, ids: int) -> DataFrame:
    """(v, id, ids): equal vectors as one row with their smallest ids, at most ``ids``.

    The row limit works in every task before the shuffle, so no vector is too frequent.
    """
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.distinct().withColumn("rank", rank).where(F.col("rank") <= ids)
    return few.groupBy("v").agg(F.min("vec_id").alias("id"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def matrix(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; as floats where these hold them."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:
        kind = np.float32 if most < 2**24 else np.float64
        return a.astype(kind) @ b.astype(kind).T
    if most >= LARGEST and (np.abs(a) @ np.abs(b).T).max(initial=0) >= LARGEST:
        raise ValueError("an inner product may not fit 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


class Index:
    """Pivots, and what queries need to know of each annulus."""

    def __init__(self, sample: np.ndarray, sample_ids: list[list[int]], top: float, n: int):
        self.dim = sample.shape[1]
        self.top = top
        self.sample = Classes(sample, np.array([i for ids in sample_ids for i in ids], np.int64), np.array([len(ids) for ids in sample_ids], np.int64))
        lifted = self.lift(sample)
        wanted = int(min(MAX_PIVOTS, max(4, n**0.5 / 16)))
        self.pivots = _spread(lifted, min(wanted, len(lifted)))
        far = self.distances(lifted).min(axis=1)
        self.edges = np.quantile(far, np.linspace(0, 1, RINGS + 1)[1:-1]) if len(far) else np.zeros(0)

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.hstack((x, np.sqrt(np.maximum(self.top - (x * x).sum(axis=1, keepdims=True), 0))))

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        """From each row to each pivot."""
        square = (lifted**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * lifted @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Annulus and distance from the nearest pivot."""
        far = self.distances(self.lift(x))
        nearest = far.argmin(axis=1)
        distance = far[np.arange(len(x)), nearest]
        return nearest * (len(self.edges) + 1) + np.searchsorted(self.edges, distance), distance

    def bounds(self, q: np.ndarray, cell: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least distance at which each query can have a candidate in each annulus."""
        far = self.distances(np.hstack((q, np.zeros((len(q), 1)))))
        own = far[:, cell // (len(self.edges) + 1)]
        return np.maximum(np.maximum(own - high, low - own), (own - far.min(axis=1, keepdims=True)) / 2).clip(0)

    def reach(self, q: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """The distance of a candidate whose score is ``floor``, with room for rounding."""
        square = (q * q).sum(axis=1) + self.top - 2 * floor
        rounding = 1e-3 + 1e-7 * q.shape[1]**0.5 * (np.sqrt((q * q).sum(axis=1)) + self.top**0.5)
        return np.sqrt(np.maximum(square, 0)) * (1 + 1e-9) + rounding


def _spread(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` pivots, each the point farthest from those before it."""
    if not n:
        return np.zeros((1, points.shape[1]))
    chosen = [0]
    far = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < n:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


class Classes:
    """Vectors and, for each of them, its ids."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, counts: np.ndarray):
        self.x, self.ids, self.counts = x, ids, counts
        self.starts = np.cumsum(counts) - counts

    @classmethod
    def of(cls, x: list[np.ndarray], ids: list[pa.Array]) -> Classes:
        counts = [i.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for i in ids]
        return cls(np.concatenate(x), np.concatenate([i.flatten().to_numpy(zero_copy_only=False) for i in ids]), np.concatenate(counts))

    def rows(self, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of classes ``j``, and which of ``j`` each belongs to."""
        n = self.counts[j]
        which = np.repeat(np.arange(len(j)), n)
        return self.ids[np.repeat(self.starts[j] - (np.cumsum(n) - n), n) + np.arange(len(which))], which


class Best:
    """The ``k`` best (score, id) of each query at or above its floor, which rises as they come."""

    def __init__(self, q: np.ndarray, floor: np.ndarray, k: int):
        self.q, self.floor, self.k = q, floor.copy(), k
        self.row, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, held: Classes, low: int, high: int, rows: np.ndarray) -> None:
        """Compare classes ``low`` to ``high`` with the queries of ``rows``."""
        q = self.q[rows].astype(np.float64)
        for lo in range(low, high, SLICE):
            points = scores(q, held.x[lo:min(lo + SLICE, high)].astype(np.float64))
            some = np.flatnonzero(points.max(axis=1) >= self.floor[rows].astype(points.dtype))  # most queries have no hit
            points, mine = points[some], rows[some]
            hit = np.flatnonzero(points >= self.floor[mine, None].astype(points.dtype))
            last = points.shape[1] - self.k
            if last > 0 and len(hit) > 8 * self.k * len(mine):
                self.floor[mine] = np.maximum(self.floor[mine], np.partition(points, last, axis=1)[:, last].astype(np.int64))
                hit = np.flatnonzero(points >= self.floor[mine, None].astype(points.dtype))
            if len(hit):
                r, j = np.divmod(hit, points.shape[1])
                ids, which = held.rows(lo + j)
                self._keep(mine[r][which], points.ravel()[hit].astype(np.int64)[which], ids)

    def _keep(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        row, score, ids = np.concatenate((self.row, row)), np.concatenate((self.score, score)), np.concatenate((self.id, ids))
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        last = rank == self.k - 1
        self.floor[row[last]] = np.maximum(self.floor[row[last]], score[last])
        self.row, self.score, self.id = (x[rank < self.k] for x in (row, score, ids))


def sample(candidates: DataFrame, n: int) -> DataFrame:
    """The SAMPLE classes with the smallest hashes. Only about twice as many are sorted, so tasks send that much together."""
    hashed = F.xxhash64("v")
    if n > 2 * SAMPLE:
        candidates = candidates.where(hashed < -(2**63) + 2**64 * 2 * SAMPLE // n)
    return candidates.orderBy(hashed, "id").limit(SAMPLE)


def deal(sizes: list[int], most: int) -> tuple[list[int], list[int]]:
    """For annuli of these sizes the first block and the number of blocks: small ones share a block, a large one is cut."""
    first, parts, block, left = [], [], -1, 0
    for n in sizes:
        m = -(-n // most)
        if n > left:
            block, left = block + 1, most if m == 1 else 0
        first.append(block)
        parts.append(m)
        block, left = block + m - 1, max(0, left - n)
    return first, parts


def search(candidates: DataFrame, queries: DataFrame, k: int, dim: int, kind: str) -> DataFrame:
    """(q, score, vec_id): the k best candidates of every query class.

    ``candidates``: classes (v, id, ids). ``queries``: (id, v), one row per class.
    """
    spark = queries.sparkSession
    norm = candidates.agg(F.count("*").alias("n"), F.max(_norm(dim, kind)("v")).alias("top")).first()
    n, top = norm["n"], norm["top"] or 0.0
    if not n:
        return spark.createDataFrame([], "q long, score long, vec_id long")
    drawn = sample(candidates, n).collect()
    vectors = np.frombuffer(b"".join(bytes(r["v"]) for r in drawn), kind).reshape(-1, dim).astype(np.float64)
    index = Index(vectors, [list(r["ids"]) for r in drawn], top, n)

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        cell, distance = index.cells(matrix(batch.column(0), dim, kind).astype(np.float64))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(distance)], ["v", "ids", "cell", "far"])

    keyed = stage_table(map_arrow(candidates.select("v", "ids"), place, "v binary, ids array<long>, cell long, far double"), "topk-keyed")
    # At most MAX_PIVOTS * RINGS rows, whatever the size of the tables.
    annuli = keyed.groupBy("cell").agg(F.count("*").alias("n"), F.min("far").alias("low"), F.max("far").alias("high")).orderBy("cell").collect()
    cell, low, high = (np.array([a[c] for a in annuli], t) for c, t in (("cell", np.int64), ("low", float), ("high", float)))
    cores = spark.sparkContext.defaultParallelism
    most = max(1, min(BLOCK_BYTES // (dim * int(kind[2:])), max(BLOCK, -(-n // (4 * cores)))))
    first_block, parts = deal([a["n"] for a in annuli], most)
    blocks = first_block[-1] + parts[-1]
    # The annuli of each block, as places in ``cell``.
    start, stop = np.full(blocks, len(cell)), np.zeros(blocks, int)
    for c, (b, m) in enumerate(zip(first_block, parts, strict=True)):
        start[b:b + m], stop[b:b + m] = np.minimum(start[b:b + m], c), c + 1

    def of_cell(values: list[int]) -> Column:
        by = dict(zip(cell.tolist(), values, strict=True))
        return F.get(F.expr(f"array({', '.join(f'{by.get(c, 0)}L' for c in range(int(cell[-1]) + 1))})"), F.col("cell").cast("int"))

    block = of_cell(first_block) + F.pmod(F.xxhash64("v"), of_cell(parts))
    dealt = keyed.select((block * HOLDS + F.col("cell")).alias("place"), F.lit(None).cast("bigint").alias("q"), "v", "ids",
                         F.lit(None).cast("bigint").alias("floor"), F.lit(None).cast("binary").alias("wanted"))

    def prepare(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """The floor that the sample gives, and the annuli to open first, fixed here for both visits."""
        q = matrix(batch.column(1), dim, kind)
        best = Best(q, np.full(len(q), NOTHING), k)
        best.add(index.sample, 0, len(index.sample.x), np.arange(len(q)))
        order = np.argsort(index.bounds(q.astype(np.float64), cell, low, high), axis=1, kind="stable")[:, :FIRST]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best.floor), pa.array(order.tolist(), pa.list_(pa.int64()))], ["id", "v", "floor", "near"])

    def open_annuli(choose: Callable) -> Callable:
        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            q = matrix(batch.column(1), dim, kind).astype(np.float64)
            floor = batch.column(2).to_numpy(zero_copy_only=False)
            near = np.zeros((len(q), len(cell)), bool)
            np.put_along_axis(near, batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(q), -1), True, axis=1)
            wanted = choose(near, q, floor)
            for b in range(blocks):
                own = wanted[:, start[b]:stop[b]]
                rows = np.flatnonzero(own.any(axis=1))
                if len(rows):
                    part = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), (b + 1) * HOLDS - 1)), part.column(0), part.column(1),
                         pa.nulls(len(rows), pa.list_(pa.int64())), part.column(2), packed(np.packbits(own[rows], axis=1))],
                        ["place", "q", "v", "ids", "floor", "wanted"])

        return run

    def near_ones(near: np.ndarray, q: np.ndarray, floor: np.ndarray) -> np.ndarray:
        return near

    def rest(near: np.ndarray, q: np.ndarray, floor: np.ndarray) -> np.ndarray:
        # Without k candidates so far, nothing bounds the search.
        limit = np.where(floor == NOTHING, np.inf, index.reach(q, np.where(floor == NOTHING, 0, floor).astype(float)))
        return (index.bounds(q, cell, low, high) <= limit[:, None]) & ~near

    def answer(held: Classes, cells: np.ndarray, b: int, asks: pa.RecordBatch) -> pa.RecordBatch:
        own = cell[start[b]:stop[b]]
        left, right = np.searchsorted(cells, own, "left"), np.searchsorted(cells, own, "right")
        bits = np.frombuffer(b"".join(asks.column(5).to_pylist()), np.uint8).reshape(asks.num_rows, -1)
        wanted = np.unpackbits(bits, axis=1, count=len(own)).astype(bool)
        best = Best(matrix(asks.column(2), dim, kind), asks.column(4).to_numpy(zero_copy_only=False), k)
        c = 0
        while c < len(own):  # neighbours that the same queries look into are compared together
            end = c + 1
            while end < len(own) and (wanted[:, end] == wanted[:, c]).all():
                end += 1
            if wanted[:, c].any():
                best.add(held, left[c], right[end - 1], np.flatnonzero(wanted[:, c]))
            c = end
        return pa.RecordBatch.from_arrays([asks.column(1).take(pa.array(best.row)), pa.array(best.score), pa.array(best.id)], ["q", "score", "vec_id"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by place: of each block the candidates by annulus, then the queries."""
        of, x, ids, cells, held = -1, [], [], [], None
        for batch in batches:
            places = batch.column(0).to_numpy(zero_copy_only=False)
            asks = places % HOLDS == HOLDS - 1
            turns = np.flatnonzero(np.diff(places // HOLDS * 2 + asks)) + 1
            for lo, hi in zip([0, *turns], [*turns, len(places)], strict=True):
                part = batch.slice(lo, hi - lo)
                if lo == hi:
                    continue
                if places[lo] // HOLDS != of:
                    of, x, ids, cells, held = int(places[lo] // HOLDS), [], [], [], None
                if not asks[lo]:
                    x.append(matrix(part.column(2), dim, kind))
                    ids.append(part.column(3))
                    cells.append(places[lo:hi] % HOLDS)
                    continue
                if held is None:
                    held, cells = Classes.of(x, ids), np.concatenate(cells)
                    x, ids = [], []
                yield answer(held, cells, of, part)

    def visit(asking: DataFrame, choose: Callable) -> DataFrame:
        asked = map_arrow(asking, open_annuli(choose), "place long, q long, v binary, ids array<long>, floor long, wanted binary")
        met = dealt.unionByName(asked).repartitionById(blocks, F.shiftright("place", 32).cast("int")).sortWithinPartitions("place")
        return met.mapInArrow(compare, "q long, score long, vec_id long")

    tasks = min(cores, -(-queries.count() // 500))
    asking = queries.select("id", "v").repartition(max(1, tasks), "id")
    asking = stage_table(map_arrow(asking, prepare, "id long, v binary, floor long, near array<long>"), "topk-asking")
    first = stage_table(_best_of(visit(asking, near_ones), k), "topk-first")
    floors = first.groupBy("q").agg(F.when(F.count("*") >= k, F.min("score")).alias("reached"))
    asking = asking.join(floors, asking["id"] == floors["q"], "left").select("id", "v", F.greatest("floor", "reached").alias("floor"), "near")
    return _best_of(first.unionByName(visit(asking, rest)), k)


NOTHING = -(2**63)
HOLDS = 2**32  # places of a block: its annuli, and last its queries


def _norm(dim: int, kind: str):
    @F.arrow_udf(T.DoubleType())
    def norm(v: pa.Array) -> pa.Array:
        x = matrix(v, dim, kind).astype(np.float64)
        return pa.array((x * x).sum(axis=1))

    return norm


def _best_of(found: DataFrame, k: int, keys: str = "q") -> DataFrame:
    """The row limit works in every task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(keys).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def top_k(rows: DataFrame, query_rows: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` highest inner products among ``rows``.

    A row whose id is the query's own is no candidate of it; ties go to the smaller id; with fewer
    candidates than ``k`` all are returned. Rows whose id or vector is null, or whose vector holds
    null or non-finite components, take no part. Shorter vectors count as padded with zeros,
    repeated rows count once, and numbers that do not fit 64 bits are an error. Other columns are ignored;
    an empty table gives no rows.
    """
    small_batches(rows.sparkSession, 500)
    every, asked = usable(rows, vec_id, vector), usable(query_rows, vec_id, vector)
    (dim, largest), (wide, most) = extent(every), extent(asked)
    dim = max(1, dim)
    if wide > dim:
        raise ValueError("queries have more components than the rows")
    kind = whole(max(largest, most))
    asked = stage_table(quantised(asked, dim, kind).distinct(), "topk-queries")
    held = stage_table(classes(quantised(every, dim, kind), k + 1), "topk-classes")
    of = stage_table(asked.groupBy("v").agg(F.min("vec_id").alias("id")), "topk-asked")
    found = stage_table(search(held, of, k + 1, dim, kind), "topk-found")
    names = asked.join(of, "v").select(F.col("vec_id").alias("query_id"), "id")
    pairs = names.join(found, F.col("id") == F.col("q")).where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
