"""Exact top-k inner products by an impact-ordered index, score at a time.

Components become integers, ``floor(scale * x)``. The vectors are dealt into blocks of about
``block_rows``, each in a task of its own. A block's index has, per dimension, its postings in segments of equal quantised
impact. For each query of a block of queries, segments of all dimensions are taken by descending
quantised contribution, a step at a time; postings of a segment add their exact products to the
accumulators. After each step a vector's score lies between what it has plus the least and plus
the most that its dimensions not yet met can give, by the segments not yet taken. A query stops
once only few vectors' upper bounds reach the k-th best lower bound: this proves that no other
vector belongs to the result. Those that remain are rescored exactly from their components.
Accumulators of all queries of a block advance together, as matrix products over segments.

The queries go to all tasks, in parts of at most ``QUERY_BYTES``; more queries take more passes.
A block hands on at most k rows per query, of which the k best are kept; nothing else is shuffled
but the vectors, once a pass. The work grows with queries times vectors, which no exact search
escapes; blocks keep every task of bounded size.

Bounds are computed in doubles, of vectors scaled to 1 by powers of two, and widened by what
rounding may amount to, which is nothing where all sums are below 2**53. Exact scores are integers
of any size, so vectors of any finite components are answered; a score beyond 64 bits is ranked
exactly and reported as the nearest 64-bit number.

Vectors that are null, empty, or hold null or non-finite components, also after scaling, take no
part, nor do those with a null id. Shorter vectors count as if filled up with zeros. Of rows that
share an id, all are candidates, the smallest vector is the query, and none is its own candidate.
Equal scores go to the smaller id. Empty tables give no rows. Only the named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarmac.llm.shared import Stage

K = 5
SCALE = 256.0
BLOCK_ROWS = 4096
#: Queries that advance together, and the bytes of queries that are sent to all tasks at once.
QUERY_ROWS = 512
QUERY_BYTES = 32 << 20
#: Quantised impacts of a dimension, and steps in which a query takes its segments.
LEVELS = 6
STEPS = 6


def usable(vectors: DataFrame, vec_id: str, embedding: str, scale: float) -> DataFrame:
    """(id, v) of the rows that take part, components scaled and whole, as doubles."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("e"))
    rows = rows.where("id is not null and size(e) > 0")
    scaled = F.transform("e", lambda x: F.lit(float(scale)) * x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    # A function that floors to 64 bits would cut large numbers; those are whole already.
    whole = F.transform(
        "v", lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)
    )
    return rows.select("id", scaled.alias("v")).where(finite).select("id", whole.alias("v"))


def _exponent(matrix: np.ndarray) -> int:
    """The least power of two that no component reaches."""
    largest = np.abs(matrix).max(initial=0.0)
    return int(np.frexp(largest)[1]) if largest else 0


class ImpactIndex:
    """The vectors of a block with their postings in segments.

    ``products[j]`` holds the components of level j, ``present[j]`` where they are; level j of
    dimension d spans ``low[j, d]`` to ``high[j, d]``. Empty levels span nothing.
    """

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        """``vectors`` are doubles that are whole numbers."""
        self.whole = vectors
        self.exponent = _exponent(vectors)
        self.vectors = np.ldexp(vectors, -self.exponent)
        self.reach = np.abs(self.vectors).max(axis=0)
        bottom, top = self.vectors.min(axis=0), self.vectors.max(axis=0)
        width = np.maximum((top - bottom) / levels, 1e-12)
        level = np.minimum(((self.vectors - bottom) / width).astype(np.int64), levels - 1)
        self.present = [(level == j).astype(np.float64) for j in range(levels)]
        self.products = [self.vectors * here for here in self.present]
        self.empty = np.stack([~here.any(axis=0) for here in self.present])
        wide = [np.where(here > 0, self.vectors, np.nan) for here in self.present]
        self.low = np.stack([np.where(e, 0, np.nanmin(np.where(e, 0, w), axis=0)) for w, e in zip(wide, self.empty)])
        self.high = np.stack([np.where(e, 0, np.nanmax(np.where(e, 0, w), axis=0)) for w, e in zip(wide, self.empty)])

    def candidates(self, queries: np.ndarray, k: int, own: list[np.ndarray], steps: int = STEPS) -> list[np.ndarray]:
        """Per query, the rows that may be among its k best other than ``own``; few, by proof."""
        n, dims = self.vectors.shape
        exponent = _exponent(queries)
        queries = np.ldexp(queries, -exponent)
        # What rounding may add to or take from a sum; whole numbers below 2**53 are not rounded.
        slack = (queries.shape[1] + 4 * len(self.products) * steps) * 2.0**-50
        slack = slack * (np.abs(queries) @ self.reach) + dims * 2.0**-1000
        if exponent + self.exponent + dims.bit_length() <= 53:
            slack[:] = 0
        levels = len(self.products)
        most = np.maximum(queries[:, None] * self.low, queries[:, None] * self.high)
        least = np.minimum(queries[:, None] * self.low, queries[:, None] * self.high)
        most[:, self.empty], least[:, self.empty] = -np.inf, np.inf
        rank = np.argsort(np.argsort(-most.reshape(len(queries), -1), axis=1), axis=1)
        turn = (rank * steps // (levels * dims)).reshape(most.shape)  # the step that takes a segment
        score = np.zeros((len(queries), n))
        found: list[np.ndarray | None] = [None] * len(queries)
        asking = np.arange(len(queries))
        for step in range(steps):
            now, later = turn[asking] == step, turn[asking] > step
            gained = np.zeros((len(asking), n))
            for j in range(levels):
                gained += (queries[asking] * now[:, j]) @ self.products[j].T
            score[asking] += gained
            # Of a dimension not met yet: the best and the worst segment that is still to come.
            best = np.where(later, most[asking], -np.inf).max(axis=1)
            worst = np.where(later, least[asking], np.inf).min(axis=1)
            best, worst = np.where(np.isinf(best), 0, best), np.where(np.isinf(worst), 0, worst)
            upper, lower = score[asking], score[asking]
            for j in range(levels):
                upper = upper + (best * later[:, j]) @ self.present[j].T
                lower = lower + (worst * later[:, j]) @ self.present[j].T
            open_ = []
            for i, q in enumerate(asking):
                floor = lower[i] - slack[q]
                floor[own[q]] = -np.inf
                upper[i][own[q]] = -np.inf
                left = min(k, n - len(own[q]))
                if left <= 0:
                    found[q] = np.zeros(0, dtype=np.int64)
                    continue
                kth = np.partition(floor, n - left)[n - left]
                alive = np.flatnonzero((upper[i] + slack[q] >= kth) & (upper[i] > -np.inf))
                if len(alive) <= max(8 * k, n // 32) or step == steps - 1:
                    found[q] = alive
                else:
                    open_.append(q)
            asking = np.array(open_, dtype=np.int64)
            if not len(asking):
                break
        return found

    def top(self, queries: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int):
        """(query id, id, score) of the k best of this block for each query; scores are exact."""
        by_id = np.argsort(ids, kind="stable")
        a = np.searchsorted(ids[by_id], query_ids, side="left")
        b = np.searchsorted(ids[by_id], query_ids, side="right")
        own = [by_id[x:y] for x, y in zip(a, b)]
        small = _exponent(queries) + self.exponent + queries.shape[1].bit_length() <= 62
        exact = self.whole.astype(np.int64) if small else None
        for q, rows in enumerate(self.candidates(queries, k, own)):
            if small:
                scores = (exact[rows] @ queries[q].astype(np.int64)).tolist()
            else:
                query = [int(x) for x in queries[q]]
                scores = [sum(int(x) * y for x, y in zip(self.whole[r], query)) for r in rows]
            found = sorted(zip([-x for x in scores], ids[rows].tolist()))[:k]
            for score, key in found:
                yield int(query_ids[q]), key, -score


def _matrix(table: pa.Table | pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, filled up with zeros."""
    lists = table["v"].combine_chunks() if isinstance(table, pa.Table) else table["v"]
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), dims))
    out[np.arange(dims)[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return np.array(table["id"].to_numpy(), dtype=np.int64), out


def _order(score: int) -> bytes:
    """Bytes that sort like the numbers they stand for, whatever their size."""
    size = (abs(score).bit_length() + 7) // 8
    raw = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return b"\x01" + raw if score >= 0 else b"\x00" + bytes(255 - b for b in raw)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = K,
    scale: float = SCALE,
    block_rows: int = BLOCK_ROWS,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row that ``is_query`` picks.

    ``is_query`` refers to the id as column ``id``.
    """
    rows = usable(vectors, vec_id, embedding, scale)
    size = rows.agg(
        F.count("*").alias("n"),
        F.count(F.when(is_query, 1)).alias("queries"),
        F.max(F.size("v")).alias("dims"),
    ).first()
    dims = size.dims or 1
    blocks = max(1, math.ceil(size.n / block_rows))
    parts = max(1, math.ceil(size.queries * dims * 8 / query_bytes))
    context = vectors.sparkSession.sparkContext
    stage = Stage(vectors.sparkSession, "topk")
    # Dealt by position, not by id: an id that repeats without end fills no block alone.
    dealt = rows.withColumn(
        "block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    ).repartition(blocks, "block")
    queries = rows.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    best = None
    for part in range(parts):
        own = queries.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).toArrow()
        asked = context.broadcast(_matrix(own.combine_chunks(), dims))
        found = dealt.groupBy("block").applyInArrow(
            _searched(asked, dims, k), "query_id long, vec_id long, score long, by binary"
        )
        found = stage.table(f"best-{part}", found)
        asked.destroy()
        best = found if best is None else best.unionByName(found)
    order = Window.partitionBy("query_id").orderBy(F.desc("by"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _searched(asked, dims: int, k: int):
    """The search of one block for all queries of a part."""

    def search(table: pa.Table) -> pa.Table:
        ids, matrix = _matrix(table, dims)
        query_ids, queries = asked.value
        index = ImpactIndex(matrix)
        found: list[tuple[int, int, int]] = []
        for at in range(0, len(query_ids), QUERY_ROWS):
            some = slice(at, at + QUERY_ROWS)
            found.extend(index.top(queries[some], query_ids[some], ids, k))
        query, key, score = zip(*found) if found else ((), (), ())
        clipped = [min(max(s, -(1 << 63)), (1 << 63) - 1) for s in score]
        return pa.table(
            [
                pa.array(query, pa.int64()),
                pa.array(key, pa.int64()),
                pa.array(clipped, pa.int64()),
                pa.array([_order(s) for s in score], pa.binary()),
            ],
            names=["query_id", "vec_id", "score", "by"],
        )

    return search
