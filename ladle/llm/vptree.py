"""Nearest neighbours by cosine: one vantage-point tree per shard, searched in batches.

On unit vectors the chord length is a metric that falls as the cosine rises.  A tree node keeps a
vantage point and, for both halves of its points, the least and greatest distance to it.  A half
is skipped if by the triangle inequality it cannot hold a point nearer than the k-th best so far;
the bound is multiplied by ``relax``: 1 gives exact results, above 1 prunes more and may miss.

Vectors are dealt to shards of about ``SHARD_ROWS`` rows by a hash of their row.  Each shard's
task first reads its vectors and builds the tree, then streams the queries past it in blocks, so
memory is bounded by the shard and one block.  The best k of every shard are merged by a second,
small aggregation.  Scores are cosines of the original vectors in double precision.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no
part, nor do rows with a null id; vectors whose length differs from the query's are no candidates;
ties go to the smaller id; rows that repeat an id are candidates of their own (a query never returns
its own id); with fewer candidates than k all are returned; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.common import scratch_table

SHARD_ROWS = 8192
LEAF_ROWS = 128
BLOCK_ROWS = 512
#: distances carry rounding errors of about the square root of a double's; pruning allows for them
SLACK = 1e-7


class VPTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 3):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.unit = vectors / self.norms[:, None]
        self.rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(ids)))

    def _chord(self, at, to: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.unit[at] @ to)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= LEAF_ROWS:
            return rows
        # a vantage point that tells points apart: the best of a few by the spread of its distances
        tried = self.rng.choice(rows, 4, replace=False)
        probe = self.rng.choice(rows, min(len(rows), 64), replace=False)
        vantage = max(tried, key=lambda v: (float(self._chord(probe, self.unit[v]).std()), -int(v)))
        d = self._chord(rows, self.unit[vantage])
        order = np.argsort(d, kind="stable")
        rows, d, half = rows[order], d[order], len(rows) // 2
        return (vantage, (d[0], d[half - 1], self._build(rows[:half])), (d[half], d[-1], self._build(rows[half:])))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, relax: float = 1.0) -> list[list[tuple[float, int]]]:
        """For each query the k best (score, id), best first."""
        norms = np.sqrt((queries * queries).sum(axis=1))
        unit = queries / norms[:, None]
        best: list[list[tuple[float, int]]] = [[] for _ in queries]
        reach = np.full(len(queries), np.inf)  # chord of each query's k-th best so far

        def scan(rows: np.ndarray, active: np.ndarray) -> None:
            rough = unit[active] @ self.unit[rows].T
            least = 1.0 - (reach[active] + SLACK) ** 2 / 2.0
            for j, q in enumerate(active):
                close = rows[rough[j] >= least[j]] if np.isfinite(least[j]) else rows
                close = close[self.ids[close] != query_ids[q]]
                if not len(close):
                    continue
                exact = (self.vectors[close] * queries[q]).sum(axis=1) / (self.norms[close] * norms[q])
                merged = best[q] + list(zip(exact.tolist(), self.ids[close].tolist()))
                merged.sort(key=lambda x: (-x[0], x[1]))
                best[q] = merged[:k]
                if len(merged) >= k:
                    reach[q] = np.sqrt(max(0.0, 2.0 - 2.0 * best[q][-1][0]))

        def visit(node, active: np.ndarray) -> None:
            if not len(active):
                return
            if isinstance(node, np.ndarray):
                scan(node, active)
                return
            vantage, near, far = node
            d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (unit[active] @ self.unit[vantage])))
            inner_first = d <= (near[1] + far[0]) / 2

            def go(half, who: np.ndarray) -> None:
                low, high, child = half
                bound = np.maximum(0.0, np.maximum(low - d[who], d[who] - high))
                visit(child, active[who][relax * bound <= reach[active[who]] + SLACK])
            go(near, np.flatnonzero(inner_first))
            go(far, np.flatnonzero(~inner_first))
            go(far, np.flatnonzero(inner_first))
            go(near, np.flatnonzero(~inner_first))
        visit(self.root, np.arange(len(queries)))
        return best


def _clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
    d = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.alias("vec"))
    # |x| <= max double is false for infinities and NaN (which sorts above them), and unknown for nulls
    finite = F.forall("vec", lambda x: F.coalesce(F.abs(x) <= 1.7976931348623157e308, F.lit(False)))
    return d.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0.0))


def nearest(vectors: DataFrame, queries, k: int = 5, relax: float = 1.0, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every row that the condition ``queries`` on ``id`` picks."""
    rows = scratch_table(_clean(vectors, id_col, vector_col).withColumn("row", F.monotonically_increasing_id()), "ann-vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    candidates = rows.select(F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "row", "id", "vec")
    asked = rows.where(queries).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "row", "id", "vec")
    # a partition may hold several shards; within one, vectors come before queries
    dealt = (candidates.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind", "row")
                       .select("shard", "kind", "row", "id", "vec"))
    names = ["query_row", "query_id", "vec_id", "score"]
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, trees, kept = None, None, []

        def answers(part: list) -> Iterator[pa.RecordBatch]:
            for width in sorted({len(v) for _, _, v in part} & trees.keys()):
                block = [(r, i, v) for r, i, v in part if len(v) == width]
                found = trees[width].search(np.array([i for _, i, _ in block]), np.array([v for _, _, v in block]), k, relax)
                out = [(r, i, vec_id, score) for (r, i, _), best in zip(block, found) for score, vec_id in best]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)

        def grown() -> dict[int, VPTree]:
            widths = sorted({len(v) for _, v in kept})
            return {w: VPTree(np.array([i for i, v in kept if len(v) == w]), np.array([v for _, v in kept if len(v) == w])) for w in widths}
        asked_now: list = []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            flat, ends = batch.column(4).values.to_numpy(zero_copy_only=False), batch.column(4).offsets.to_numpy()
            for j, (s, kind, row, vec_id) in enumerate(zip(*columns)):
                if s != shard:
                    yield from answers(asked_now) if asked_now else ()
                    shard, trees, kept, asked_now = s, None, [], []
                vec = flat[ends[j]:ends[j + 1]]
                if kind == 0:
                    kept.append((vec_id, vec.copy()))
                    continue
                if trees is None:
                    trees, kept = grown(), []
                asked_now.append((row, vec_id, vec.copy()))
                if len(asked_now) >= BLOCK_ROWS:
                    yield from answers(asked_now)
                    asked_now = []
        yield from answers(asked_now) if asked_now else ()
    found = dealt.mapInArrow(task, "query_row bigint, query_id bigint, vec_id bigint, score double").select(names)
    # k rows of each shard and query: small next to the vectors
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"))
