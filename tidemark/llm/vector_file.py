"""Exact top-k search over a vector-approximation file.

The components of a vector are scaled and floored to whole numbers. The file has
one row per distinct vector: its cells (one byte per component, each of ``2^bits``
equally wide cells between the component's smallest and largest value), the exact
vector, and its smallest ids. For a query q and a vector in cells with middles m
the inner product lies within ``q.m`` plus or minus ``sum |q| * half a cell``.

The queries run in blocks of a bounded size against all rows, in two passes each:

1. Every task scans the cells alone and keeps, per query, the largest lower
   bounds; merged over all tasks, the last one kept is a score that the kth result reaches.
2. Every task scans the cells again. Vectors whose upper bound reaches that score
   are candidates; their exact vectors are read in order of the bound, until
   the bound of the next one is below what is already certain.

What is left per query is a little more than k rows, ranked in one window whose
tasks keep no more than k + 1 rows of a query before the shuffle. Copies of one vector are one row of
the file with its k + 1 smallest ids, and copies among the queries are searched once, so a
vector that a third of all rows share costs no more than any other.

Edge cases: vectors that are NULL or hold a NULL or non-finite component, and rows
without an id, take no part; a vector shorter than the longest counts as zero
beyond its end, an empty one scores 0; repeated rows count once; an id with
several vectors takes part with each of them, and is left out only against itself;
ties go to the smaller id; extra columns are ignored; an empty table gives no
rows. Scores must fit in 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import stored

SCALE = 256.0
BITS = 6
#: Bytes of query vectors that one pass over the file carries.
BLOCK_BYTES = 16 << 20
#: Queries whose bounds are computed and merged together.
TILE = 256
#: Exact vectors read between two looks at what is certain.
STRIDE = 32

RESULT = "query_id long, rank int, vec_id long, score long"


def _whole(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, usable rows and concatenated whole-number components of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a NULL component becomes NaN
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(scale * values)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(scaled))])
    at = np.concatenate([[0], np.cumsum(size)])
    usable = (bad[at[1:]] == bad[at[:-1]]) & np.array(pc.is_valid(column))
    return size, usable, np.clip(np.where(np.isfinite(scaled), scaled, 0), -(2.0**62), 2.0**62).astype(np.int64)


def _dense(size: np.ndarray, usable: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """The usable rows as a matrix, zero beyond a vector's end."""
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros((len(size), width), np.int64)
    own = usable[row]
    out[row[own], place[own]] = values[own]
    return out[usable]


@dataclass
class Grid:
    """Cells of each component: ``low + n * width`` is where the nth begins."""

    low: np.ndarray
    width: np.ndarray
    kind: str  # numpy type of stored exact components
    exact_floats: bool  # every inner product is exact in doubles
    largest: float

    @property
    def size(self) -> int:
        return len(self.low)

    def cells(self, exact: np.ndarray) -> np.ndarray:
        return ((exact - self.low) // self.width).astype(np.uint8)

    def middles(self, cells: np.ndarray) -> np.ndarray:
        return self.low + cells * self.width.astype(np.float64) + (self.width - 1) / 2

    def slack(self, queries: np.ndarray) -> np.ndarray:
        """How far an inner product can be from the one with the middles, and a margin for rounding."""
        return np.abs(queries) @ ((self.width - 1) / 2) + np.abs(queries).sum(axis=1) * self.largest * 2.0**-40

    def rows(self, column: pa.Array) -> np.ndarray:
        return _matrix(column, self.kind, self.size)


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """A column of equally long byte strings as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), width)


def fit_grid(vectors: DataFrame, scale: float, bits: int) -> Grid | None:
    """The cells from the range of each component over all vectors; None without a vector."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: dict[int, tuple[int, int]] = {}
        for batch in batches:
            size, usable, values = _whole(batch.column("vector"), scale)
            for n in np.unique(size[usable]).tolist():
                same = _dense(size, usable & (size == n), values, n)
                pairs = zip([-1, *range(n)], [n, *same.min(axis=0).tolist()], [n, *same.max(axis=0).tolist()])
                for d, a, b in pairs:
                    x, y = low.get(d, (a, b))
                    low[d] = (min(a, x), max(b, y))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(low), pa.int32()), pa.array([v[0] for v in low.values()], pa.int64()), pa.array([v[1] for v in low.values()], pa.int64())],
            names=["d", "low", "high"],
        )

    found = vectors.mapInArrow(ranges, "d int, low long, high long").groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    of = {r.d: (r.low, r.high) for r in found.collect()}  # one row per component
    if not of:
        return None
    shortest, longest = of[-1]
    low, high = (np.array([of[d][k] for d in range(longest)], np.int64) for k in (0, 1))
    if shortest < longest:
        low, high = np.minimum(low, 0), np.maximum(high, 0)
    largest = float(max(abs(int(low.min(initial=0))), abs(int(high.max(initial=0)))))
    kind = next((t for t in ("<i2", "<i4") if largest <= np.iinfo(t).max), "<i8")
    return Grid(low, np.maximum(1, -(-(high - low + 1) // (1 << bits))), kind, largest * largest * longest < 2**52, largest)


def _packed(vectors: DataFrame, grid: Grid, scale: float) -> DataFrame:
    """(id, exact): each usable row once, its vector as the bytes of whole numbers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, usable, values = _whole(batch.column("vector"), scale)
            exact = _dense(size, usable, values, grid.size).astype(grid.kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").filter(pa.array(usable)), pa.array([r.tobytes() for r in exact], pa.binary())], names=["id", "exact"]
            )

    return vectors.mapInArrow(pack, "id long, exact binary").distinct()


def build_file(packed: DataFrame, grid: Grid, ids: int) -> DataFrame:
    """The vector-approximation file: (cells, exact, ids) per distinct vector, written to the shared folder."""

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = grid.cells(grid.rows(batch.column("exact")).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in cells], pa.binary()), batch.column("exact"), batch.column("ids")], names=["cells", "exact", "ids"]
            )

    place = F.row_number().over(Window.partitionBy("exact").orderBy("id"))
    least = packed.withColumn("place", place).filter(F.col("place") <= ids)
    distinct = least.groupBy("exact").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return stored(distinct.mapInArrow(approximate, "cells binary, exact binary, ids array<long>"), "vector_file")


def _largest(a: np.ndarray, b: np.ndarray, keep: int) -> np.ndarray:
    """The largest ``keep`` values of each row of two matrices."""
    both = np.concatenate([a, b], axis=1)
    return np.partition(both, both.shape[1] - keep, axis=1)[:, -keep:]


def _lower_bounds(block, grid: Grid, keep: int):
    """Pass 1 of a task: per tile of queries the largest lower bounds over its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = block.value[1].astype(np.float64)
        slack = grid.slack(queries)
        best = np.full((len(queries), keep), -np.inf)
        for batch in batches:
            middles = grid.middles(_matrix(batch.column("cells"), "u1", grid.size)).T
            for t in range(0, len(queries), TILE):
                best[t:t + TILE] = _largest(best[t:t + TILE], queries[t:t + TILE] @ middles - slack[t:t + TILE, None], keep)
        tiles = range(0, len(queries), TILE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(tiles), pa.int32()), pa.array([best[t:t + TILE].tobytes() for t in tiles], pa.binary())], names=["tile", "bounds"]
        )

    return run


def _merged_bounds(keep: int):
    """The bounds of all tasks, one matrix per tile held at a time for each tile of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for tile, raw in zip(batch.column("tile").to_pylist(), batch.column("bounds").to_pylist()):
                own = np.frombuffer(raw).reshape(-1, keep)
                best[tile] = _largest(best[tile], own, keep) if tile in best else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(best), pa.int32()), pa.array([m.min(axis=1).tobytes() for m in best.values()], pa.binary())], names=["tile", "reached"]
        )

    return run


def _refined(block, reached: np.ndarray, grid: Grid, keep: int):
    """Pass 2 of a task: exact scores of the candidates, read in order of their upper bounds."""
    kind = np.float64 if grid.exact_floats else np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, own = block.value
        queries, products = own.astype(np.float64), own.astype(kind)
        slack = grid.slack(queries)
        certain = reached.copy()
        best: dict[int, list[tuple]] = {}  # query: (-score, ids, same), best first
        for batch in batches:
            middles = grid.middles(_matrix(batch.column("cells"), "u1", grid.size)).T
            exact, ids = grid.rows(batch.column("exact")), batch.column("ids")
            for t in range(0, len(queries), TILE):
                upper = queries[t:t + TILE] @ middles + slack[t:t + TILE, None]
                for i in np.flatnonzero((upper >= certain[t:t + TILE, None]).any(axis=1)).tolist():
                    q, bounds = t + i, upper[i]
                    near = np.flatnonzero(bounds >= certain[q])
                    near = near[np.argsort(-bounds[near], kind="stable")]
                    for k in range(0, len(near), STRIDE):
                        if bounds[near[k]] < certain[q]:
                            break
                        read = near[k:k + STRIDE]
                        score = (exact[read].astype(kind) @ products[q]).astype(np.int64)
                        good = score >= certain[q]
                        new = [(-s, ids[r].as_py(), bool((exact[r] == own[q]).all())) for s, r in zip(score[good].tolist(), read[good].tolist())]
                        if new:
                            best[q] = sorted([*best.get(q, []), *new])[:keep]
                            if len(best[q]) == keep:
                                certain[q] = max(certain[q], -best[q][-1][0])
        rows = [(int(numbers[q]), -s, own_ids, same) for q, found in best.items() for s, own_ids, same in found]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.bool_()),
            ],
            names=["number", "score", "ids", "same"],
        )

    return run


def _block(file: DataFrame, own: DataFrame, grid: Grid, keep: int) -> DataFrame:
    """Candidates with exact scores of one block of queries, written to the shared folder."""
    context = file.sparkSession.sparkContext
    rows = own.select("number", "exact").toArrow()
    block = context.broadcast((rows.column("number").to_numpy(), grid.rows(rows.column("exact"))))
    tiles = -(-rows.num_rows // TILE)
    bounds = file.select("cells").mapInArrow(_lower_bounds(block, grid, keep), "tile int, bounds binary")
    merged = bounds.repartition(tiles, "tile").mapInArrow(_merged_bounds(keep), "tile int, reached binary").collect()
    reached = np.concatenate([np.frombuffer(r.reached) for r in sorted(merged, key=lambda r: r.tile)])
    found = stored(file.mapInArrow(_refined(block, reached, grid, keep), "number long, score long, ids array<long>, same boolean"), "candidates")
    block.unpersist()
    return found


def top_k(
    items: DataFrame, queries: DataFrame, vector: str = "embedding", item_id: str = "vec_id", query_id: str = "vec_id",
    k: int = 5, scale: float = SCALE, bits: int = BITS, leave_out_self: bool = True, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each query's ``k`` items of highest inner product, ties to the smaller id: (query_id, rank, vec_id, score).

    With ``leave_out_self`` an item that is the query's own row (same id and vector) is no result of it.
    """
    spark = items.sparkSession
    read = lambda df, name: df.select(F.col(name).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).filter("id IS NOT NULL")
    rows, asked = read(items, item_id), read(queries, query_id)
    grid = fit_grid(rows.unionByName(asked), scale, bits)
    if grid is None:
        return spark.createDataFrame([], RESULT)
    keep = k + 1
    file = build_file(_packed(rows, grid, scale), grid, keep)
    members = stored(_packed(asked, grid, scale), "queries")
    distinct = members.groupBy("exact").agg(F.lit(1).alias("one"))
    numbered = stored(distinct.select(F.monotonically_increasing_id().alias("number"), "exact"), "numbered")
    count = numbered.count()
    blocks = -(-count * grid.size * np.dtype(grid.kind).itemsize // block_bytes) or 1
    found = [_block(file, numbered.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == b), grid, keep) for b in range(blocks)] if count else []
    if not found:
        return spark.createDataFrame([], RESULT)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    each = pairs.select("number", "score", F.explode("ids").alias("id"), "same")
    place = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), "id"))
    top = each.withColumn("place", place).filter(F.col("place") <= keep)
    lists = top.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score", "same"))).alias("list"))
    answer = lists.join(numbered, "number").select("exact", "list").join(members, "exact")
    own = F.filter("list", lambda r: ~(r["same"] & (r["id"] == F.col("id")))) if leave_out_self else F.col("list")
    return answer.select(F.col("id").alias("query_id"), F.posexplode(F.slice(own, 1, k)).alias("at", "r")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("r.id").alias("vec_id"), F.col("r.score").alias("score")
    )
