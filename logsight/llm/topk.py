"""Exact largest inner products by branch and bound in a ball tree per shard."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsight.llm.scratch import written
from logsight.llm.text import prepare

LEAF = 64
SHARD_ROWS = 8192
QUERY_ROWS = 256
NO_BAR = np.iinfo(np.int64).min


class BallTree:
    """Balls over the rows of a matrix; a node's two children split it at the median of its widest direction."""

    def __init__(self, rows: np.ndarray):
        self.order = np.arange(len(rows))
        self.rows = rows
        self.low, self.high, self.child = [], [], []
        centre, radius = [], []
        todo = [(0, len(rows), -1)]
        while todo:
            lo, hi, parent = todo.pop()
            node = len(self.low)
            own = rows[self.order[lo:hi]]
            mid = own.mean(axis=0)
            away = np.sqrt(((own - mid) ** 2).sum(axis=1))
            self.low.append(lo)
            self.high.append(hi)
            self.child.append([])
            centre.append(mid)
            radius.append(away.max())
            if parent >= 0:
                self.child[parent].append(node)
            if hi - lo > LEAF and radius[-1] > 0:
                one = own[away.argmax()]
                other = own[((own - one) ** 2).sum(axis=1).argmax()]
                half = (hi - lo) // 2
                split = np.argpartition(own @ (other - one), half)
                self.order[lo:hi] = self.order[lo:hi][split]
                todo += [(lo, lo + half, node), (lo + half, hi, node)]
        self.centre, self.radius = np.array(centre), np.array(radius)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No row of a node has a larger inner product with a query; rounding is allowed for."""
        length = np.sqrt((queries**2).sum(axis=1))[:, None]
        size = np.sqrt((self.centre**2).sum(axis=1)) + self.radius
        return queries @ self.centre.T + length * self.radius + 1e-9 * length * size + 0.5


class Search:
    """The best rows of one shard for one block of queries."""

    def __init__(self, tree: BallTree, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
        self.tree, self.ids, self.queries, self.query_ids, self.k = tree, ids, queries, query_ids, k
        self.bound = tree.bounds(queries)

    def best(self, query: int, least: int, leaves: int | None = None) -> list[tuple[int, int]]:
        """(score, -id) of the k best rows with scores of at least `least`, best first.

        Nodes are taken by their bound, largest first. The k-th score found so far, or `least` while that is
        larger, is the bar: once no node's bound reaches it, the rest is cut off. A node whose bound equals the
        bar may hold a smaller id, so it is looked at. leaves ends the search after so many leaves.
        """
        bound, q = self.bound[query], self.queries[query]
        heap: list[tuple[int, int]] = []
        bar, seen = least, 0
        nodes = [(-bound[0], 0)]
        while nodes and -nodes[0][0] >= bar and (leaves is None or seen < leaves):
            _, node = heapq.heappop(nodes)
            if self.tree.child[node]:
                for c in self.tree.child[node]:
                    if bound[c] >= bar:
                        heapq.heappush(nodes, (-bound[c], c))
                continue
            seen += 1
            at = self.tree.order[self.tree.low[node] : self.tree.high[node]]
            scores = _products(self.tree.rows[at], q)
            for i in np.flatnonzero(scores >= bar):
                own = int(self.ids[at[i]])
                if own == self.query_ids[query]:
                    continue
                item = (int(scores[i]), -own)
                if len(heap) < self.k:
                    heapq.heappush(heap, item)
                else:
                    heapq.heappushpop(heap, item)
            if len(heap) == self.k:
                bar = max(bar, heap[0][0])
        return sorted(heap, reverse=True)


def _products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in floating point while they fit, else in 64-bit integers."""
    if np.abs(rows).max(initial=0) * np.abs(query).max(initial=0) * rows.shape[1] < 2.0**53:
        return (rows @ query).astype(np.int64)
    return rows.astype(np.int64) @ query.astype(np.int64)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k rows with the largest inner products with each query.

    Components count as floor(scale * x) of x as a double; equal scores rank the smaller id first. A row is
    never a result for a query with its own id. Vectors that are null, empty or hold null or non-finite
    components, and null ids, take no part; vectors of different lengths do not meet. Rows with the same id
    and vector are one; a query id with several vectors has a ranking for each. Other columns are not read.

    Vectors are dealt into shards of a bounded size by a hash of the id, queries into blocks. Each block goes to
    each shard as one row. First every shard looks at its most promising leaf only; the largest k-th score of
    these is a bar that the search in every shard then starts with.
    """
    spark = prepare(vectors.sparkSession)
    rows = written(_whole(vectors, id_col, vector_col, scale), "vectors")
    asked = _whole(queries, id_col, vector_col, scale).withColumn("tag", F.xxhash64("v"))
    shards, n_blocks = (max(4, -(-n // size)) for n, size in ((rows.count(), SHARD_ROWS), (asked.count(), QUERY_ROWS)))
    held = _packed(rows.withColumn("tag", F.lit(0).cast("bigint")), shards, "shard").select(
        "shard", "dim", F.col("ids").alias("shard_ids"), F.col("data").alias("shard_data")
    )
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))

    def meet(blocks: DataFrame) -> DataFrame:
        return blocks.withColumn("shard", F.explode(every)).join(held, ["shard", "dim"])

    pairs = meet(_packed(asked.withColumn("bar", F.lit(None).cast("bigint")), n_blocks, "block"))
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))

    near = pairs.repartition(spread, "shard", "block").mapInArrow(_bars(k), "query_id bigint, tag bigint, bar bigint")
    bars = written(near.groupBy("query_id", "tag").agg(F.max("bar").alias("bar")), "bars")
    barred = asked.join(bars.withColumnRenamed("query_id", "id"), ["id", "tag"], "left")
    found = meet(_packed(barred, n_blocks, "block")).repartition(spread, "shard", "block")
    found = found.mapInArrow(_searched(k), "query_id bigint, tag bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id", "tag").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(id_col), "score")


def _whole(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v) with whole components as doubles."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).where("id is not null and size(v) > 0")
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("v", lambda x: F.floor(x * scale).cast("double"))
    return rows.where(usable).select("id", whole.alias("v")).distinct()


def _packed(rows: DataFrame, parts: int, name: str) -> DataFrame:
    """(name, dim, ids, tags, bars, data) with the rows of a part as one row."""
    rows = rows if "bar" in rows.columns else rows.withColumn("bar", F.lit(None).cast("bigint"))
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).alias(name)
    schema = f"{name} bigint, dim bigint, ids binary, tags binary, bars binary, data binary"

    def run(table: pa.Table) -> pa.Table:
        out: dict = {n: [table.column(n)[0].as_py()] for n in (name, "dim")}
        for to, of in (("ids", "id"), ("tags", "tag"), ("bars", "bar")):
            out[to] = [table.column(of).combine_chunks().fill_null(NO_BAR).to_numpy().astype("<i8").tobytes()]
        out["data"] = [np.concatenate([c.flatten().to_numpy() for c in table.column("v").chunks]).astype("<f8").tobytes()]
        return pa.table(out, schema=pa.schema([(n, pa.int64() if n in (name, "dim") else pa.binary()) for n in out]))

    wanted = rows.select(part, F.size("v").cast("bigint").alias("dim"), "id", "tag", "bar", "v")
    return wanted.groupBy(name, "dim").applyInArrow(run, schema)


def _searches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[dict, Search]]:
    trees: dict = {}
    for batch in batches:
        for row in batch.to_pylist():
            shape = (-1, row["dim"])
            key = row["shard"], row["dim"]
            if key not in trees:
                trees = {key: BallTree(np.frombuffer(row["shard_data"], "<f8").reshape(shape))}
            ids, own = np.frombuffer(row["shard_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
            yield row, Search(trees[key], ids, np.frombuffer(row["data"], "<f8").reshape(shape), own, k)


def _bars(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, s in _searches(batches, k):
            tags = np.frombuffer(row["tags"], "<i8")
            best = [s.best(q, NO_BAR, leaves=1) for q in range(len(tags))]
            known = [(int(s.query_ids[q]), int(tags[q]), b[-1][0]) for q, b in enumerate(best) if len(b) == k]
            yield _columns(known, "query_id", "tag", "bar")

    return run


def _searched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, s in _searches(batches, k):
            tags, bars = (np.frombuffer(row[c], "<i8") for c in ("tags", "bars"))
            found = [
                (int(s.query_ids[q]), int(tags[q]), -i, score)
                for q in range(len(tags))
                for score, i in s.best(q, int(bars[q]))
            ]
            yield _columns(found, "query_id", "tag", "vec_id", "score")

    return run


def _columns(rows: list[tuple], *names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names=list(names))
