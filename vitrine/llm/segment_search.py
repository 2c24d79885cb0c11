"""Exact search for the highest inner products, by bounds from segment means and deviations.

Components become whole numbers, ``floor(scale * x)``.  A vector is cut into
4, 16 and 32 segments; of each segment the mean and the deviation are kept.
For two vectors, ``sum(length * ((m - m')^2 + (s - s')^2))`` over the segments
never exceeds their squared distance, so with the two norms it bounds their
inner product from above.  The bounds are tried from coarse to fine against the
k-th best score known so far, and only what survives the finest is scored in
whole numbers.

Queries (rows whose id is divisible by ``every``) are met with all rows in
blocks: a grid of query blocks and row blocks of bounded size, each of them one
task's work, whose best few rows per query are ranked at the end.

Null vectors and vectors with null or non-finite components take no part.  Of
vectors of different length the inner product covers the components both have;
an empty vector scores 0.  Rows that repeat another are listed each; a row with
the id of the query is never its result.  Rows without an id can be found,
after all others of their score, but ask nothing.  Different query vectors with
one id are ranked each for itself.  Scores beyond a long count as the largest
or smallest long.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vitrine.llm.vectors import by_length, floored, usable
from vitrine.sources.scratch import cut_lineage

EVERY, BEST, SCALE = 50, 5, 256
LEVELS = (4, 16, 32)

#: Rows and queries of a block.  Blocks grow with the table up to these sizes, then their number does.
BLOCK_ROWS, BLOCK_QUERIES = (2048, 65_536), 16_384
CHUNK_ROWS, CHUNK_QUERIES = 4096, 256

#: Products of norms below this have inner products that doubles hold exactly.
EXACT = 2.0 ** 52
_LONG = np.iinfo(np.int64)


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Weighted means and deviations, so that the inner product of two rows bounds that of their vectors.

    The last column pays for rounding: a part in 10^9 of the product of the norms.
    """
    edges = np.unique(np.linspace(0, vectors.shape[1], segments + 1).astype(int))
    sizes = np.diff(edges)
    roots = np.sqrt(sizes)
    means = np.add.reduceat(vectors, edges[:-1], axis=1) / sizes
    off = vectors - np.repeat(means, sizes, axis=1)
    spread = np.sqrt(np.add.reduceat(off * off, edges[:-1], axis=1))
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.concatenate([means * roots, spread, norms * 10 ** -4.5], axis=1)


class Leaders:
    """The best rows of each query so far: highest score, then earliest place."""

    def __init__(self, queries: int, best: int):
        self.best = best
        self.query, self.score, self.place = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.least = np.full(queries, _LONG.min)

    def add(self, query: np.ndarray, score: np.ndarray, place: np.ndarray) -> None:
        if not len(query):
            return
        query, score, place = (np.concatenate(x) for x in zip(
            (self.query, self.score, self.place), (query, score, place)))
        order = np.lexsort((place, -1 - score, query))  # -1 - score orders like -score and cannot overflow
        query, score, place = query[order], score[order], place[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kept = rank < self.best
        self.query, self.score, self.place = query[kept], score[kept], place[kept]
        last = rank == self.best - 1
        self.least[query[last]] = score[last]


def _whole_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of any size, held to the range of a long."""
    exact = np.array([[int(x) for x in q] for q in queries], dtype=object).reshape(queries.shape)
    other = np.array([[int(x) for x in r] for r in rows], dtype=object).reshape(rows.shape)
    return np.clip(exact @ other.T, _LONG.min, _LONG.max).astype(np.int64)


class Block:
    """Queries and rows of one length each, and their statistics at all levels."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.levels = [statistics(vectors, n) for n in LEVELS] if vectors.shape[1] else []


def _scan(leaders: Leaders, queries: Block, ask_ids: np.ndarray,
          places: np.ndarray, rows: Block, row_ids: np.ndarray) -> None:
    """Try a chunk of rows for a chunk of queries; ``places`` number the rows, ids below 0 match nothing."""
    own = ask_ids[:, None] == row_ids[None, :]
    alive = ~own
    if rows.levels:
        bounds = queries.levels[0] @ rows.levels[0].T
        bounds[own] = -np.inf
        # the rows that look best set the score to beat
        few = min(leaders.best + 3, bounds.shape[1])
        seeds = np.argpartition(-bounds, few - 1, axis=1)[:, :few]
        scores = np.einsum("qd,qsd->qs", queries.vectors, rows.vectors[seeds])
        scores[np.take_along_axis(own, seeds, axis=1)] = -np.inf
        known = leaders.least.astype(np.float64)
        if few >= leaders.best:
            known = np.maximum(known, -np.sort(-scores, axis=1)[:, leaders.best - 1])
        known -= 0.5  # whole numbers below 2^52
        alive &= bounds >= known[:, None]
        for ask, row in zip(queries.levels[1:], rows.levels[1:]):
            if alive.sum() * 16 > alive.size:
                alive &= ask @ row.T >= known[:, None]
            else:
                q, r = np.nonzero(alive)
                alive[q, r] = np.einsum("pd,pd->p", ask[q], row[r]) >= known[q]
    if alive.sum() * 16 > alive.size:
        q, r = np.nonzero(alive)
        score = (queries.vectors @ rows.vectors.T)[q, r]
    else:
        q, r = np.nonzero(alive)
        score = np.einsum("pd,pd->p", queries.vectors[q], rows.vectors[r])
    score = score.astype(np.int64)
    fit = score >= leaders.least[q]
    leaders.add(q[fit], score[fit], places[r[fit]])


def _split(vectors: pa.ListArray, scale: int, chunk: int):
    """Chunks of equal length: places, whole components, and whether their products may pass ``EXACT``."""
    for places, components in by_length(vectors):
        whole = floored(components, scale)
        with np.errstate(over="ignore"):
            large = (whole * whole).sum(axis=1) >= EXACT
        for size in (False, True):
            at = np.flatnonzero(large == size)
            for part in np.array_split(at, -(-len(at) // chunk)) if len(at) else ():
                yield places[part], whole[part], size


def best_of_block(queries: pa.Table, rows: pa.Table, best: int, scale: int) -> pa.Table:
    """The best rows of one block for each of its queries; all of ``rows`` are candidates."""
    queries, rows = queries.combine_chunks(), rows.combine_chunks()
    rows = rows.sort_by([("vec_id", "ascending")])  # nulls come last
    # a row that repeats counts as often as ranks can hold
    copies = np.minimum(rows.column("copies").to_numpy(), best)
    rows = rows.take(pa.array(np.repeat(np.arange(len(rows)), copies))).combine_chunks()

    def one(table: pa.Table, name: str) -> pa.Array:
        column = table.column(name)
        return column.chunk(0) if column.num_chunks else pa.array([], column.type)

    # ids are compared by their number among the ids of the rows; a query whose id no row has matches none
    ids = one(rows, "vec_id")
    number = np.unique(ids.drop_null().to_numpy(), return_inverse=True)
    row_ids = np.full(len(ids), -1, dtype=np.int64)
    row_ids[ids.is_valid().to_numpy(zero_copy_only=False)] = number[1]
    asked = one(queries, "vec_id").to_numpy()
    at = np.minimum(np.searchsorted(number[0], asked), max(0, len(number[0]) - 1))
    ask_ids = np.where(number[0][at] == asked, at, -2) if len(number[0]) else np.full(len(asked), -2)

    found = []
    row_chunks = [(p, v, large, {}) for p, v, large in _split(one(rows, "embedding"), scale, CHUNK_ROWS)]
    for asks, ask_vectors, ask_large in _split(one(queries, "embedding"), scale, CHUNK_QUERIES):
        ask_blocks: dict[int, Block] = {}
        leaders = Leaders(len(asks), best)
        for places, vectors, large, blocks in row_chunks:
            shared = min(vectors.shape[1], ask_vectors.shape[1])
            if ask_large or large:
                for some in np.array_split(np.arange(len(places)), -(-len(places) // 256)):
                    score = _whole_products(ask_vectors[:, :shared], vectors[some, :shared])
                    q, r = np.nonzero(ask_ids[asks][:, None] != row_ids[places[some]][None, :])
                    leaders.add(q, score[q, r], places[some][r])
                continue
            for kept, whole in ((ask_blocks, ask_vectors), (blocks, vectors)):
                if shared not in kept:
                    kept[shared] = Block(whole[:, :shared])
            _scan(leaders, ask_blocks[shared], ask_ids[asks], places, blocks[shared], row_ids[places])
        found.append((asks[leaders.query], leaders.place, leaders.score))
    ask, place, score = (np.concatenate([f[i] for f in found] or [np.zeros(0, dtype=np.int64)]) for i in range(3))
    return pa.table({
        "query_id": one(queries, "vec_id").take(pa.array(ask)),
        "query_hash": one(queries, "query_hash").take(pa.array(ask)),
        "vec_id": ids.take(pa.array(place)), "score": pa.array(score, pa.int64())})


def search(vectors: DataFrame, every: int = EVERY, best: int = BEST, scale: int = SCALE,
           block_rows: tuple[int, int] = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``best`` highest scores of every query, ties to the smaller id."""
    rows = cut_lineage(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(usable())
                       .groupBy("vec_id", "embedding").agg(F.count("*").alias("copies")))
    asks = rows.where(F.col("vec_id") % every == 0).withColumn("query_hash", F.xxhash64("embedding"))
    n, n_asks = rows.count(), asks.count()
    size = min(max(block_rows[0], n // 64), block_rows[1])
    row_blocks, ask_blocks = max(1, -(-n // size)), max(1, -(-n_asks // block_queries))

    def block(count: int, salt: str):
        return F.pmod(F.xxhash64("vec_id", "embedding", F.lit(salt)), F.lit(count)).cast("int")

    def all_of(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = asks.select("vec_id", "embedding", "query_hash", block(ask_blocks, "query").alias("ask_block"),
                       all_of(row_blocks).alias("row_block"))
    right = rows.select("vec_id", "embedding", "copies", block(row_blocks, "row").alias("row_block"),
                        all_of(ask_blocks).alias("ask_block"))
    keys = ["ask_block", "row_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        lambda q, r: best_of_block(q, r, best, scale), "query_id long, query_hash long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select(
        "query_id", "rank", "vec_id", "score")
