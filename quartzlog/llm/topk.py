"""Exact top-k inner-product search by no-random-access aggregation.

A task reads its candidates in place, in blocks of BLOCK vectors. A block has one sorted list per dimension. A query reads
the lists sequentially, each with a cursor of its own, those of positive weight from the top and those of negative weight
from the bottom; next comes the list whose unread values can still differ most. What a cursor last read bounds all that it
has not, so every candidate has a lower and an upper score, and a candidate that was met in no list has the threshold as
its upper score. Candidates below the k-th best lower score (of this block, or final scores of earlier ones) are outsiders.
Reading stops when at most RESOLVE candidates, or 1 / 32 of the block, are left, at once if the threshold rules the whole
block out, and also when reading does not pay: if a trial share of the entries leaves more than three quarters of the
candidates. The trial is an eighth at first; for each query it halves where reading did not pay and doubles where it did. The
final scores of all that are left are resolved, exactly.

Queries come to the candidates, CHUNK_BYTES of them at a time as a broadcast; a task emits k rows a query. Work grows with
queries times candidates where vectors do not prune; memory does not.

Scaled components are integers of any size. Bounds are doubles with a margin for rounding; where final scores may pass
2**53 the nearest contenders are compared as whole numbers. A score beyond a long is given as the nearest long, its rank is
still by the whole number (up to 2**124).

Cases: vectors that are null or hold null or non-finite components take no part, nor do rows of null id; shorter vectors
count as padded with zeros; ties go to the smaller id; rows that repeat an id are candidates of their own, but never of a
query with that id, and queries that repeat an id share its ranks; no queries, no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import durable

BLOCK, RESOLVE, TRIAL = 4096, 64, 1 / 8
CHUNK_BYTES = 32 << 20
EXACT, LONG, LIMB = float(1 << 53), (1 << 63) - 1, 62


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    bad = lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf"))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad))


def matrix(column: pa.Array, scale: float) -> np.ndarray:
    """Rows of floor(scale * x), short ones padded with zeros."""
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), int(size.max(initial=0))))
    out[np.arange(out.shape[1]) < size[:, None]] = np.floor(column.flatten().to_numpy(zero_copy_only=False) * scale)
    return out


def padded(x: np.ndarray, dims: int) -> np.ndarray:
    return x if x.shape[1] >= dims else np.pad(x, ((0, 0), (0, dims - x.shape[1])))


class Lists:
    """A block of candidates and its sorted lists."""

    def __init__(self, ids: np.ndarray, block: np.ndarray):
        self.ids, self.block = ids, block
        self.order = np.ascontiguousarray(np.argsort(block, axis=0, kind="stable").T.astype(np.int32))
        self.values = np.take_along_axis(block.T, self.order, 1)
        self.largest = np.abs(block).max(axis=0, initial=0)


def read(query: np.ndarray, lists: Lists, own: int, k: int, least: float = -np.inf, trial: float = TRIAL) -> tuple[np.ndarray, float, bool]:
    """Positions of the candidates that may be among the query's k best and reach the score `least`, the share of the
    lists' entries that was read to tell, and whether that paid. Candidates of id `own` take no part."""
    n, dims = len(lists.ids), np.flatnonzero(query)
    others = np.flatnonzero(lists.ids != own)
    total = n * len(dims)
    if not total or not len(others):
        return others, 0.0, True
    weight = query[dims]
    top = weight > 0
    far = np.where(top, lists.values[dims, 0], lists.values[dims, -1]) * weight
    near = np.where(top, lists.values[dims, -1], lists.values[dims, 0]) * weight
    margin = float(np.abs(weight) @ lists.largest[dims])
    margin = 0.0 if margin < EXACT else margin * len(dims) * 2.0**-50
    if near.sum() + margin < least:
        return others[:0], 0.0, True
    known, seen, place = np.zeros(n), np.zeros((len(dims), n)), np.zeros(len(dims), np.int64)
    base, step, reads, check = far.sum(), max(16, n // 8), 0, total * min(trial, 1 / 16)
    while True:
        j = int(np.argmax(near - far))
        if near[j] > far[j]:
            a = int(place[j])
            b = min(n, a + step)
            run = slice(n - b, n - a) if top[j] else slice(a, b)
            at, value = lists.order[dims[j], run], lists.values[dims[j], run] * weight[j]
            known[at] += value - far[j]
            seen[j, at] = 1.0
            near[j], place[j] = (far[j] if b == n else value[0 if top[j] else -1]), b
            reads += b - a
        gap = near - far
        all_read = reads == total or not gap.any()
        if reads < check and not all_read:
            continue
        check += total / 16
        lower = base + known[others]
        kth = max(least, np.partition(lower, len(lower) - k)[len(lower) - k]) if len(lower) > k else least
        left = others[lower + gap.sum() + margin >= kth - margin]
        met = (gap @ seen)[left] if len(left) > n / 4 else gap @ seen[:, left]
        left = left[base + known[left] + (gap.sum() - met) + margin >= kth - margin]
        few = len(left) <= max(RESOLVE, n // 32)
        if all_read or few or reads >= total * trial and len(left) > n * 3 / 4:
            return left, reads / total, few


def whole(query: np.ndarray, rows: np.ndarray) -> list[int]:
    """Inner products as whole numbers of any size."""
    own = [int(x) for x in query]
    return [sum(a * int(b) for a, b in zip(own, row) if a) for row in rows]


def resolve(query: np.ndarray, lists: Lists, left: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(score, id) of the k best among these positions, best first; ties to the smaller id."""
    if not len(left):
        return []
    with np.errstate(over="ignore", invalid="ignore"):
        score = (lists.block @ query)[left] if len(left) > len(lists.ids) / 4 else lists.block[left] @ query
        most = float(np.abs(query) @ lists.largest)
    if most >= EXACT:
        if most < 1e300 and len(left) > k:  # what rounding cannot lift into the k best goes
            margin = most * len(query) * 2.0**-50
            left = left[score + margin >= np.partition(score, len(score) - k)[len(score) - k] - margin]
        score = whole(query, lists.block[left])
        return sorted(zip(score, lists.ids[left].tolist()), key=lambda x: (-x[0], x[1]))[:k]
    best = np.lexsort((lists.ids[left], -score))[:k]
    return [(int(s), int(i)) for s, i in zip(score[best], lists.ids[left[best]])]


def search(ids: np.ndarray, queries: np.ndarray, blocks, k: int):
    """For each query its k best (score, id) over all blocks (ids, matrix), and the mean share of entries read."""
    best: list[list] = [[] for _ in ids]
    shares, count, trial = np.zeros(len(ids)), 0, np.full(len(ids), TRIAL)
    for own_ids, block in blocks:
        dims = max(queries.shape[1], block.shape[1])
        queries, count = padded(queries, dims), count + 1
        lists = Lists(own_ids, padded(block, dims))
        huge = float(np.abs(queries).max(initial=0)) * float(lists.largest.max(initial=0)) * max(1, dims) >= 1e300
        for at, query in enumerate(queries):
            own = int(ids[at])
            least = float(best[at][-1][0]) if len(best[at]) == k and not huge else -np.inf
            if EXACT <= abs(least) < np.inf:
                least -= abs(least) * 2.0**-50
            left, share, paid = (np.flatnonzero(own_ids != own), 0.0, False) if huge else read(query, lists, own, k, least, trial[at])
            shares[at] += share
            trial[at] = min(TRIAL, trial[at] * 2) if paid else max(TRIAL / 64, trial[at] / 2)
            if len(left):
                best[at] = sorted(best[at] + resolve(query, lists, left, k), key=lambda x: (-x[0], x[1]))[:k]
    return best, shares / max(1, count)


def _search(k: int, scale: float, shared):
    def blocks(batches):
        held, n = [], 0
        for batch in batches:
            for a in range(0, len(batch), BLOCK):
                some = batch.slice(a, BLOCK)
                held.append((some.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64), matrix(some.column("v"), scale)))
                n += len(some)
                if n >= BLOCK:
                    yield joined(held)
                    held, n = [], 0
        if n:
            yield joined(held)

    def joined(held):
        dims = max(x.shape[1] for _, x in held)
        return np.concatenate([i for i, _ in held]), np.concatenate([padded(x, dims) for _, x in held])

    def run(batches):
        ids, queries = joined([(np.frombuffer(i, "<i8"), np.frombuffer(x, "<f8").reshape(len(i) // 8, -1)) for i, x in shared.value])
        best, shares = search(ids, queries, blocks(batches), k)
        rows = [(int(q), i, max(-(1 << 61), min((1 << 61) - 1, s >> LIMB)), s & (1 << LIMB) - 1, share) for q, found, share in zip(ids, best, shares.tolist()) for s, i in found]
        names, kinds = ["query_id", "vec_id", "high", "low", "depth"], [pa.int64()] * 4 + [pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], names)

    return run


def _pack(scale: float):
    def run(batches):
        for batch in batches:
            ids, values = batch.column("vec_id").to_numpy(zero_copy_only=False).astype("<i8"), matrix(batch.column("v"), scale)
            yield pa.RecordBatch.from_pydict({"ids": pa.array([ids[a : a + 256].tobytes() for a in range(0, len(ids), 256)], pa.binary()), "x": pa.array([values[a : a + 256].astype("<f8").tobytes() for a in range(0, len(ids), 256)], pa.binary())})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score, depth: each query's k highest inner products of floor(scale * x), its own id excluded;
    depth is the mean share of list entries that the hit's task read for the query."""
    candidates, context = usable(vectors, id_col, vec_col), vectors.sparkSession.sparkContext
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("high"), F.desc("low"), "vec_id"))
    fits = F.col("high").isin(-2, -1, 0, 1)  # 62 bits below, the sign above
    score = F.when(fits, F.shiftleft(F.col("high"), LIMB).bitwiseOR(F.col("low"))).otherwise(F.when(F.col("high") > 0, LONG).otherwise(-LONG - 1))

    def found(chunk) -> DataFrame:
        rows = candidates.mapInArrow(_search(k, scale, context.broadcast(chunk)), "query_id long, vec_id long, high long, low long, depth double")
        return rows.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"), "depth")

    out, chunk, size = None, [], 0
    for row in usable(queries, id_col, vec_col).mapInArrow(_pack(scale), "ids binary, x binary").toLocalIterator():
        if size and size + len(row["x"]) > CHUNK_BYTES:  # a chunk's results are kept before the next one is held
            part = durable(found(chunk))
            out, chunk, size = part if out is None else out.unionByName(part), [], 0
        chunk.append((row["ids"], row["x"]))
        size += len(row["x"]) + len(row["ids"])
    part = found(chunk) if chunk else None
    if part is None:
        return out if out is not None else candidates.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long, depth double")
    return part if out is None else out.unionByName(part)
