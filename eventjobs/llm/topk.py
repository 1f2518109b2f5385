"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Vectors are dealt into shards. A shard's index keeps, for every dimension, its vectors in posting segments by
quantised value. A query sees a segment's quantised impact: how much it adds for sure over the dimension's least
contribution. Each query processes its segments by its own descending impact into accumulators of lower bounds, looks
at them after growing parts, and stops only on proof: when the k-th best lower bound shows that all but a few vectors
cannot reach the result. Those possible members (ties included) are rescored exactly, and the shards' best are ranked
together.

A vector goes to its own shard only, whose index is made once; all queries are streamed past it, a batch at a time, so
no task holds more than one shard and one batch. Queries are copied to every shard, as an exact search must look at each.

Defined cases. A vector that is null, or holds a null or a component that is not finite, takes no part, neither as a
query nor as a candidate. Vectors of different lengths: missing components count as 0. Ties go to the smaller vec_id;
rows that repeat a vec_id are candidates of their own, except for a query of the same id. Rows with a null id take no
part. Further columns are not looked at; vectors of any length are used whole. With fewer than k candidates all are returned. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import spread, written

#: Vectors of a shard, on average.
SHARD = 16384
#: Segments of a dimension at most.
SEGMENTS = 32
#: Parts of the segments after which the bounds are looked at.
LOOKS = (0.3, 0.5, 0.65, 0.75, 0.85, 0.93)
OUT = "query_id long, vec_id long, score long"


def quantised(embedding: Column) -> Column:
    """floor(256 * x) of each component as a long; null if the vector cannot take part."""
    whole = F.forall(embedding, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return F.when(whole, F.transform(embedding, lambda x: F.floor(x.cast("double") * 256)))


class ShardIndex:
    """Posting segments of a matrix of integers (rows: vectors): for each dimension, the rows of each quantised value.

    A quantised value stands for `width` whole numbers in a row, so a vector that is wholly processed is known but for
    width - 1 in each dimension, which is the same for all."""

    def __init__(self, vectors: np.ndarray, segments: int = SEGMENTS):
        self.vectors = vectors
        low, high = int(vectors.min(initial=0)), int(vectors.max(initial=0))
        self.width = max(1, -(-(high - low + 1) // segments))
        self.most = max(abs(low), abs(high)) + self.width
        levels = (vectors - low) // self.width
        ids, level, dim = [], [], []
        for d in range(vectors.shape[1]):
            order = np.argsort(levels[:, d], kind="stable")
            held, starts = np.unique(levels[order, d], return_index=True)
            for x, a, b in zip(held, starts, [*starts[1:], order.size], strict=True):
                ids.append(order[a:b].astype(np.int32))
                level.append(x)
                dim.append(d)
        self.ids, self.sizes = ids, np.array([x.size for x in ids], dtype=np.int64)
        self.low, self.dim = np.array(level, dtype=np.int64) * self.width + low, np.array(dim, dtype=np.int64)

    def possible(self, q: np.ndarray, k: int) -> tuple[np.ndarray, int]:
        """Rows that hold every member of query q's best k, ties included, mostly few; and the postings that were read."""
        n, dims = self.vectors.shape
        if n <= k:
            return np.arange(n), 0
        at = q[self.dim]
        least = np.where(at >= 0, at * self.low, at * (self.low + self.width - 1))
        base = np.full(dims, np.iinfo(np.int64).max)
        np.minimum.at(base, self.dim, least)
        impact = least - base[self.dim]  # what a posting adds for sure, over the least that its dimension adds
        unsure = int(np.abs(q).sum()) * (self.width - 1)
        order = np.argsort(-impact, kind="stable")
        order = order[: np.count_nonzero(impact)]  # segments of no impact add nothing
        sure, read, done = np.zeros(n), 0, 0
        for part in (*LOOKS, 1.0):
            now = order[done : int(part * order.size)]
            done += now.size
            if now.size:
                posted = np.concatenate([self.ids[s] for s in now])
                read += posted.size
                # Sums of whole numbers far below 2^53: exact.
                sure += np.bincount(posted, weights=np.repeat(impact[now].astype(float), self.sizes[now]), minlength=n)
            # What a dimension can still add is its largest unprocessed impact.
            rest = np.zeros(dims, dtype=np.int64)
            np.maximum.at(rest, self.dim[order[done:]], impact[order[done:]])
            can = np.flatnonzero(sure >= np.partition(sure, n - k)[n - k] - unsure - rest.sum())
            if can.size <= max(64, n // 64):
                break
        return can, read


def _matrix(vectors: list[np.ndarray], dims: int) -> np.ndarray:
    return np.array([x if len(x) == dims else np.pad(x, (0, dims - len(x))) for x in vectors], dtype=np.int64).reshape(len(vectors), dims)


class Shard:
    """One shard as its rows come: first its vectors, of which the index is made once, then all queries past it."""

    def __init__(self, k: int):
        self.k, self.ids, self.vectors, self.index = k, [], [], None

    def add(self, ids: np.ndarray, vectors: list[np.ndarray]) -> None:
        self.ids.append(ids)
        self.vectors += vectors

    def ask(self, names: np.ndarray, queries: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """query_id, vec_id, score of the shard's best k of each query."""
        if not self.vectors:
            return (np.zeros(0, dtype=np.int64),) * 3
        if self.index is None:
            self.dims = max(map(len, self.vectors))
            self.index, self.ids = ShardIndex(_matrix(self.vectors, self.dims)), np.concatenate(self.ids)
            held, times = np.unique(self.ids, return_counts=True)
            self.own = dict(zip(held.tolist(), times.tolist(), strict=True))  # rows that a query must not find
        found = []
        for query_id, q in zip(names.tolist(), queries, strict=True):
            q = _matrix([q[: self.dims]], self.dims)[0]  # what the shard's vectors lack counts as 0
            rows, _ = self.index.possible(q, self.k + self.own.get(query_id, 0))
            rows = rows[self.ids[rows] != query_id]
            scores = self.index.vectors[rows] @ q
            best = np.lexsort((self.ids[rows], -scores))[: self.k]
            found.append((np.full(best.size, query_id), self.ids[rows][best], scores[best]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The best of each shard from rows sorted by shard and kind (0: its vectors, 1: queries)."""
    number, shard = None, Shard(k)
    for batch in batches:
        shards, kinds, ids = (batch.column(c).to_numpy() for c in ("shard", "kind", "vec_id"))
        column = batch.column(batch.schema.get_field_index("v"))
        flat, at = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), column.offsets.to_numpy() - column.offsets[0].as_py()
        code = shards.astype(np.int64) * 2 + kinds
        cuts = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), code.size] if code.size else []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if shards[a] != number:
                number, shard = shards[a], Shard(k)
            vectors = [flat[at[x] : at[x + 1]] for x in range(a, b)]
            if kinds[a] == 0:
                shard.add(ids[a:b].copy(), [v.copy() for v in vectors])
            else:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in shard.ask(ids[a:b], vectors)], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """vectors (vec_id, v: array of whole numbers) -> query_id, rank, vec_id, score for the rows where is_query holds."""
    vectors = written(vectors.select("vec_id", "v", F.coalesce(is_query, F.lit(False)).alias("asks")).where("v is not null and vec_id is not null"))
    shards = max(1, math.ceil(vectors.count() / SHARD))
    held = vectors.select(spread(F.struct("vec_id", "v"), shards, 1).cast("int").alias("shard"), F.lit(0).alias("kind"), "vec_id", "v")
    # Every query meets every shard, in blocks as they come; a vector is sent once, to its own shard.
    asked = vectors.where("asks").select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "vec_id", "v")
    stream = held.union(asked).repartition(max(shards, 1), "shard").sortWithinPartitions("shard", "kind")
    found = stream.select("shard", "kind", F.col("vec_id").cast("long"), "v").mapInArrow(partial(_searched, k=k), OUT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of exact's (query_id, vec_id) that found has: 1 for this operator, as a test shows."""
    n = exact.count()
    return 1.0 if not n else exact.join(found, ["query_id", "vec_id"], "left_semi").count() / n
