"""Top-k retrieval by vector similarity: exact, or over an inverted-file index.

Few queries (checked by size) go to every task. Each task multiplies its corpus
vectors with them and passes on its own best rows only, so the corpus is read
once and never shuffled, and no table of pairs exists. Many queries come in
blocks of that size, each a pass over the corpus. ``build_index`` puts items in folders of
their nearest centroid; ``indexed_top_k`` reads the folders nearest to the queries only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

# Queries sent to every task hold at most this many bytes of vectors; more go in blocks of this size.
BLOCK_BYTES = 32 * 1024 * 1024
# Tasks of a scan whose candidates meet in one task of the merge.
MERGED_TASKS = 64
# Scores are compared at this many digits, so that equal vectors tie exactly.
SCORE_DIGITS = 9
# Scores held at a time: queries times the items of one step.
STEP_SCORES = 4_000_000
METRICS = ("cosine", "dot", "euclidean")

CANDIDATE = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("raw_score", T.DoubleType()),
    ]
)


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _scores(block: np.ndarray, dense: np.ndarray, metric: str) -> np.ndarray:
    """Queries x items. ``euclidean`` is 1 - (squared distance / sqrt 2)."""
    if metric == "cosine":
        return _unit_rows(block) @ _unit_rows(dense).T
    products = block @ dense.T
    if metric == "dot":
        return products
    squared = (block * block).sum(axis=1)[:, None] + (dense * dense).sum(axis=1)[None, :] - 2 * products
    return 1 - squared / np.sqrt(2.0)


class _Best:
    """The best ``keep`` items per query seen so far; its size does not grow with the corpus."""

    def __init__(self, query_ids: np.ndarray, block: np.ndarray, metric: str, keep: int):
        self.query_ids, self.block, self.metric, self.keep = query_ids, block, metric, keep
        self.ids = np.empty((len(query_ids), 0), dtype=np.int64)
        self.scores = np.empty((len(query_ids), 0))

    def add(self, ids: np.ndarray, dense: np.ndarray) -> None:
        step = max(1, STEP_SCORES // len(self.query_ids))
        for at in range(0, len(ids), step):
            self._add_step(ids[at : at + step], dense[at : at + step])

    def _add_step(self, ids: np.ndarray, dense: np.ndarray) -> None:
        scores = np.round(_scores(self.block, dense, self.metric), SCORE_DIGITS)
        all_scores = np.concatenate([self.scores, scores], axis=1)
        all_ids = np.concatenate([self.ids, np.broadcast_to(ids, scores.shape)], axis=1)
        pick = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.keep]
        self.scores = np.take_along_axis(all_scores, pick, axis=1)
        self.ids = np.take_along_axis(all_ids, pick, axis=1)

    def columns(self) -> list[pa.Array]:
        return [
            pa.array(np.repeat(self.query_ids, self.ids.shape[1]), type=pa.int64()),
            pa.array(self.ids.ravel(), type=pa.int64()),
            pa.array(self.scores.ravel(), type=pa.float64()),
        ]


def _dense(ids, vectors) -> tuple[np.ndarray, np.ndarray]:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return ids.to_numpy(zero_copy_only=False).astype(np.int64), flat.reshape(len(vectors), -1)


def _scan_with(shared, metric: str, keep: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(*shared.value, metric, keep)
        for batch in batches:
            if batch.num_rows and len(best.query_ids):
                best.add(*_dense(batch.column(0), batch.column(1)))
        yield pa.RecordBatch.from_arrays(best.columns(), names=CANDIDATE.names)

    return scan


def top_k(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 4,
    threshold: float = 0.6,
    query_id: str = "query_id",
    item_id: str = "item_id",
    vector: str = "embedding",
    metric: str = "cosine",
) -> DataFrame:
    """Best ``k`` corpus items per query: fetch 2k, keep scores above ``threshold``, cut to k.

    Returns (query_id, rank, item_id, score), the score with 3 digits; equal
    scores rank by id. Ids are unique on either side. ``metric`` is one of
    ``METRICS``.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    asked, source = _vectors(queries, query_id, vector), _vectors(corpus, item_id, vector)
    scan = lambda block: source.mapInArrow(_scan_with(block, metric, 2 * k), CANDIDATE)
    return rank_candidates(_in_blocks(asked, scan), k, threshold, _salts(source))


def _salts(source: DataFrame) -> int:
    """How many groups the tasks of a scan form, so that no task of the merge meets candidates of more than ``MERGED_TASKS``."""
    return -(-source.rdd.getNumPartitions() // MERGED_TASKS)


def _in_blocks(asked: DataFrame, scan) -> DataFrame:
    """``scan`` with the queries in blocks of ``BLOCK_BYTES``, one in memory at a time.

    One block is scanned when the result is. Of several, each is a pass over the
    corpus where it lies, and its candidates are written to the shared folder.
    """
    spark = asked.sparkSession
    n_queries, width = asked.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    blocks = max(1, -(-n_queries * 8 * max(width, 1) // BLOCK_BYTES))
    found = []
    for b in range(blocks):
        rows = (asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b)).collect()
        block = np.array([r["vector"] for r in rows], dtype=np.float64).reshape(len(rows), width)
        shared = spark.sparkContext.broadcast((np.array([r["id"] for r in rows], dtype=np.int64), block))
        if blocks == 1:
            return scan(shared)
        path = scratch_path(spark, "candidates")
        scan(shared).write.parquet(path)
        found.append(path)
        shared.unpersist()
    return spark.read.schema(CANDIDATE).parquet(*found)


def _vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.filter(F.col(vector).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    )


def rank_candidates(candidates: DataFrame, k: int, threshold: float, salts: int = 1) -> DataFrame:
    """The best of each query; with many tasks, first the best of each group of tasks."""
    best = lambda *keys: F.row_number().over(Window.partitionBy("query_id", *keys).orderBy(F.desc("raw_score"), F.asc("item_id")))
    if salts > 1:
        salted = candidates.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        candidates = salted.withColumn("rank", best("salt")).filter(F.col("rank") <= 2 * k).drop("rank", "salt")
    return (
        candidates.withColumn("rank", best())
        .filter((F.col("rank") <= 2 * k) & (F.col("raw_score") > threshold))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "item_id", F.round("raw_score", 3).alias("score"))
    )


# ---- inverted-file index: items in folders of their nearest centroid --------------------------------


def _nearest(vectors: np.ndarray, centroids: np.ndarray, count: int, metric: str) -> np.ndarray:
    """The ``count`` cells whose centroids score best for each vector, best first; ties to the smaller cell."""
    scores = np.round(_scores(vectors, centroids, metric), SCORE_DIGITS)
    return np.argsort(-scores, axis=1, kind="stable")[:, :count]


def fit_centroids(corpus: DataFrame, cells: int, metric: str, sample: int, rounds: int) -> np.ndarray:
    """Centroids by rounds of assignment and means over a sample of at most ``sample`` vectors (first in hash order).

    A round is one aggregate: tasks sum the vectors of each cell, Spark adds the sums up, and
    the driver sees one row per cell and component. A cell left empty keeps its centroid.
    """
    spark = corpus.sparkSession
    path = scratch_path(spark, "index_sample")
    corpus.orderBy(F.xxhash64("id"), "id").limit(sample).write.parquet(path)
    sampled = spark.read.parquet(path)
    first = [r["vector"] for r in sampled.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(cells).collect()]
    centroids = np.array(first, dtype=np.float64)

    def sums(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(shared.value), shared.value.shape[1] + 1))
            for batch in batches:
                _, dense = _dense(batch.column(0), batch.column(1))
                if len(dense):
                    cell = _nearest(dense, shared.value, 1, metric)[:, 0]
                    own = _unit_rows(dense) if metric == "cosine" else dense
                    np.add.at(total, cell, np.concatenate([own, np.ones((len(own), 1))], axis=1))
            used = np.flatnonzero(total[:, -1])
            place = np.tile(np.arange(total.shape[1]), len(used))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used, total.shape[1]), pa.int32()), pa.array(place, pa.int32()), pa.array(total[used].ravel())], names=["cell", "place", "total"]
            )

        return run

    for _ in range(rounds if len(centroids) else 0):
        shared = spark.sparkContext.broadcast(centroids)
        rows = sampled.mapInArrow(sums(shared), "cell int, place int, total double").groupBy("cell", "place").agg(F.sum("total").alias("total")).collect()
        total = np.zeros((len(centroids), centroids.shape[1] + 1))
        for r in rows:
            total[r.cell, r.place] = r.total
        centroids = np.where(total[:, -1:] > 0, total[:, :-1] / np.maximum(total[:, -1:], 1), centroids)
        shared.unpersist()
    return centroids


@dataclass(frozen=True)
class CellIndex:
    """Items in folders by cell, and the cells' centroids (a small table beside them)."""

    spark: SparkSession
    path: str
    metric: str

    @property
    def items(self) -> DataFrame:
        return self.spark.read.schema("id bigint, vector array<double>, cell int").parquet(f"{self.path}/items")

    def centroids(self) -> np.ndarray:
        rows = self.spark.read.parquet(f"{self.path}/centroids").orderBy("cell").collect()
        return np.array([r["vector"] for r in rows], dtype=np.float64)


def build_index(
    corpus: DataFrame, path: str, cells: int, item_id: str = "item_id", vector: str = "embedding", metric: str = "cosine",
    sample: int = 100_000, rounds: int = 8,
) -> CellIndex:
    """Write every item into the folder of its cell. Only the centroids come from a sample."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    spark = corpus.sparkSession
    source = _vectors(corpus, item_id, vector)
    centroids = fit_centroids(source, cells, metric, sample, rounds)
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, dense = _dense(batch.column(0), batch.column(1))
            cell = _nearest(dense, shared.value, 1, metric)[:, 0] if len(dense) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], names=["id", "vector", "cell"])

    placed = source.mapInArrow(assign, "id bigint, vector array<double>, cell int")
    # A cell with very many items is split over several files; AQE sizes them.
    placed.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/items")
    table = [(n, [float(x) for x in row]) for n, row in enumerate(centroids)]
    spark.createDataFrame(table, "cell int, vector array<double>").coalesce(1).write.parquet(f"{path}/centroids")
    return CellIndex(spark, path, metric)


def indexed_top_k(
    queries: DataFrame, index: CellIndex, probes: int, k: int = 4, threshold: float = 0.6, query_id: str = "query_id", vector: str = "embedding"
) -> DataFrame:
    """``top_k`` over the ``probes`` nearest cells of each query; exact when these are all.

    A block of queries reads the folders of its cells only, each file once, and no item
    is shuffled: a task compares the items of a cell with the queries that probe it.
    """
    asked, centroids, metric = _vectors(queries, query_id, vector), index.centroids(), index.metric
    if not len(centroids):
        return rank_candidates(index.spark.createDataFrame([], CANDIDATE), k, threshold)

    def scan(shared) -> DataFrame:
        ids, block = shared.value
        probed = _nearest(block, centroids, probes, metric) if len(ids) else np.zeros((0, 0), np.int64)
        by_cell = {c: np.flatnonzero((probed == c).any(axis=1)) for c in np.unique(probed).tolist()}
        of_cell = index.spark.sparkContext.broadcast(by_cell)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, _Best] = {}
            for batch in batches:
                cells = batch.column(2).to_numpy()
                for c in np.unique(cells).tolist():
                    own = of_cell.value[c]
                    if c not in best:
                        best[c] = _Best(shared.value[0][own], shared.value[1][own], metric, 2 * k)
                    part = batch.filter(pa.array(cells == c))
                    best[c].add(*_dense(part.column(0), part.column(1)))
            for b in best.values():
                yield pa.RecordBatch.from_arrays(b.columns(), names=CANDIDATE.names)

        return index.items.filter(F.col("cell").isin(list(by_cell))).select("id", "vector", "cell").mapInArrow(run, CANDIDATE)

    return rank_candidates(_in_blocks(asked, scan), k, threshold, _salts(index.items))
