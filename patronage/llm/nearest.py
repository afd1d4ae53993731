"""Nearest neighbours by vantage-point trees, one per shard, with triangle-inequality pruning relaxed by a factor.

Vectors are dealt to shards of bounded size by a hash of their id. In a shard's tree every node has a vantage point and two
halves by distance to it, each with the least and greatest such distance. A query at distance d from the vantage point can
be no nearer than ``low - d`` or ``d - high`` to a half; the half is skipped when that bound exceeds ``factor`` times the
query's tenth best distance so far. Factor one never skips a neighbour; smaller factors skip more and may.

Queries travel in blocks: each block meets each shard once and gets its best from there, and the best of all shards are
merged per query. Halves are split by position, so a shard full of equal vectors still gives a balanced tree.

Edge cases: vectors that are NULL, all zero, or hold NULL or non-finite components take no part; only vectors of the same
length are compared; rows that share the query's id are its own; rows repeated with an id are candidates each; rows without
id take no part; ties go to the smaller id; fewer candidates than asked for give all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import ship

SLACK = 1e-12


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, dim, vector) of the rows that take part; components become doubles."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    some = F.exists("vector", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.coalesce(some, F.lit(False))
                      ).select("vec_id", F.size("vector").alias("dim"), "vector")


@dataclass
class Tree:
    """Rows in tree order. Node i covers rows [start, end); its vantage point is the first of them, unless it is a leaf."""

    ids: np.ndarray
    rows: np.ndarray
    leaf: int
    #: per inner node (start, end): least and greatest distance of the nearer half, then of the farther half
    rims: dict[tuple[int, int], tuple[float, float, float, float]]

    @staticmethod
    def build(ids: np.ndarray, rows: np.ndarray, leaf: int = 64) -> Tree:
        order = np.argsort(ids, kind="stable")
        ids, rows = ids[order], rows[order]
        tree = Tree(ids, rows, leaf, {})
        place = np.arange(ids.size)
        waiting = [(0, ids.size)]
        while waiting:
            start, end = waiting.pop()
            if end - start <= leaf:
                continue
            own = place[start:end]
            # the row farthest from the first is a vantage point at the rim, which separates best
            far = int(np.argmax(distances(rows[own], rows[own[0]])))
            own[0], own[far] = own[far], own[0]
            d = distances(rows[own[1:]], rows[own[0]])
            by = np.argsort(d, kind="stable")
            own[1:], half = own[1:][by], (end - start - 1) // 2
            middle = start + 1 + half
            tree.rims[start, end] = tuple(map(float, (d[by[0]], d[by[half - 1]], d[by[half]], d[by[-1]])))
            waiting += [(start + 1, middle), (middle, end)]
        tree.ids, tree.rows = ids[place], rows[place]
        return tree

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(distances, ids) of the ``k`` nearest per query; missing ones are infinite."""
        best = np.full((query_ids.size, k), np.inf)
        found = np.zeros((query_ids.size, k), np.int64)  # places in the tree

        def offer(active: np.ndarray, d: np.ndarray, start: int, end: int) -> None:
            d = np.where(self.ids[None, start:end] == query_ids[active][:, None], np.inf, d)
            d = np.concatenate([best[active], d], axis=1)
            both = np.concatenate([found[active], np.broadcast_to(np.arange(start, end), (active.size, end - start))], axis=1)
            order = np.lexsort((self.ids[both], d), axis=1)[:, :k]
            best[active], found[active] = np.take_along_axis(d, order, 1), np.take_along_axis(both, order, 1)

        def visit(start: int, end: int, active: np.ndarray) -> None:
            if not active.size or start >= end:
                return
            if end - start <= self.leaf:
                offer(active, pairwise(queries[active], self.rows[start:end]), start, end)
                return
            d = distances(queries[active], self.rows[start])
            offer(active, d[:, None], start, start + 1)
            middle = start + 1 + (end - start - 1) // 2
            halves = ((start + 1, middle), (middle, end))
            rims = self.rims[start, end]
            lows, highs = rims[::2], rims[1::2]
            inner = d <= (highs[0] + lows[1]) / 2
            for side, first in ((inner, 0), (~inner, 1)):
                for half in (first, 1 - first):
                    # bounds are taken when the half is due, after the nearer one has tightened the best
                    bound = np.maximum(lows[half] - d[side], d[side] - highs[half])
                    limit = best[active[side], k - 1] * factor
                    visit(halves[half][0], halves[half][1], active[side][bound <= limit * (1 + SLACK) + SLACK])

        visit(0, self.ids.size, np.arange(query_ids.size))
        # the score is summed component by component, as a plain loop over the vectors would
        exact = np.sqrt(np.cumsum(np.square(queries[:, None, :] - self.rows[found]), axis=-1)[..., -1])
        return np.where(np.isinf(best), np.inf, exact), self.ids[found]


def distances(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(rows - point).sum(axis=-1))


def pairwise(a: np.ndarray, b: np.ndarray, cells: int = 1 << 21) -> np.ndarray:
    """Exact distances of all rows of ``a`` and ``b`` by differences, a bounded block at a time."""
    step = max(1, cells // max(1, b.size))
    return np.concatenate([np.sqrt(np.square(a[i:i + step, None, :] - b[None, :, :]).sum(axis=-1)) for i in range(0, len(a), step)])


def packed(rows: DataFrame, group: list[str], name: str) -> DataFrame:
    """One row per group with ids and vectors as bytes. A group has a bounded expected size, as its number is a hash."""
    dim_at = group.index("dim")

    def run(key, table):
        ids = table.column("vec_id").to_numpy()
        flat = table.column("vector").combine_chunks().flatten().to_numpy()
        order = np.argsort(ids, kind="stable")
        vectors = flat.reshape(ids.size, key[dim_at].as_py())[order]
        return pa.table({**{g: pa.array([k.as_py()], k.type) for g, k in zip(group, key, strict=True)},
                         f"{name}_ids": pa.array([ids[order].tobytes()], pa.binary()), f"{name}_rows": pa.array([vectors.tobytes()], pa.binary())})

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([*(f"{g} {kinds[g]}" for g in group), f"{name}_ids binary", f"{name}_rows binary"])
    return rows.groupBy(*group).applyInArrow(run, schema)


def search(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 10,
           factor: float = 1.0, shard_rows: int = 8192, block_rows: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``vectors`` per row of ``queries``, score the Euclidean distance.

    Both tables have the columns ``vec_id`` and ``vector``. Query rows that share an id count once, with the smallest vector.
    """
    rows = usable(vectors, vec_id, vector)
    asked = usable(queries, vec_id, vector).groupBy("vec_id", "dim").agg(F.min("vector").alias("vector"))
    shards = {r["dim"]: -(-r["count"] // shard_rows) for r in rows.groupBy("dim").count().collect()}  # one row per vector length
    blocks = {r["dim"]: -(-r["count"] // block_rows) for r in asked.groupBy("dim").count().collect()}

    def number(counts: dict[int, int]):
        if not counts:
            return F.lit(1)
        return F.element_at(F.create_map(*[F.lit(x) for pair in counts.items() for x in pair]), F.col("dim"))

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), number(shards)))
    index = materialize(packed(dealt, ["dim", "shard"], "tree"), "vantage-shards")
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), number(blocks)))
    block = packed(dealt, ["dim", "block"], "query")
    known = F.coalesce(number(shards), F.lit(0))
    to = F.explode(F.when(known > 0, F.sequence(F.lit(0).cast("long"), known.cast("long") - 1)))
    met = block.withColumn("shard", to).join(index.withColumn("shard", F.col("shard").cast("long")), ["dim", "shard"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tree = None, None
        for batch in batches:
            for dim, shard, ids, data, tree_ids, tree_rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last != (dim, shard):
                    last, tree = (dim, shard), Tree.build(np.frombuffer(tree_ids, np.int64), np.frombuffer(tree_rows).reshape(-1, dim))
                query_ids = np.frombuffer(ids, np.int64)
                best, found = tree.search(query_ids, np.frombuffer(data).reshape(-1, dim), k, factor)
                real = np.isfinite(best)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(query_ids, real.sum(axis=1))), pa.array(found[real]), pa.array(best[real])],
                                                 names=["query_id", "vec_id", "score"])

    near = (met.select("dim", "shard", "query_ids", "query_rows", "tree_ids", "tree_rows").sortWithinPartitions("dim", "shard")
            .mapInArrow(run, "query_id long, vec_id long, score double"))
    best = W.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ship(__name__)
