"""Approximate nearest neighbours with an inverted multi-index.

Vectors are scaled to length 1, so the nearest by cosine is the nearest by distance. Each
half of a vector is quantised by its own small codebook; a pair of codes is a cell. A
query sorts the centroids of both halves by distance and walks the pairs in order of
summed distance with a heap, until the cells it has met hold ``visit`` of all entries.
The entries of these cells are ranked by their exact cosine in double precision.

Spark does the walk over the data: entries lie by first code and chunk, queries by
block; each group is one matrix product over two bounded sides, and gives the best few
of each query. A code that holds a third of all entries is cut into more chunks.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import importable, staged

# Bounds: vectors the codebooks are fitted to, entries in a chunk, queries in a block.
FIT_VECTORS = 20_000
LEAST = 20  # times k, the entries that the opened cells hold at least
CHUNK_ROWS, BLOCK_ROWS = 8192, 2048


@dataclass
class Index:
    books: tuple[np.ndarray, np.ndarray]  # centroids of the two halves
    cells: np.ndarray  # entries in each pair of codes
    entries: DataFrame  # vec_id, vec (float64 bytes, as given), first, second, chunk


def kmeans(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    centres = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        count = np.bincount(near, minlength=len(centres))
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1)[None] - 2 * points @ centres.T).argmin(1)


def traverse(first: np.ndarray, second: np.ndarray, cells: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Pairs of codes by summed distance, until their cells hold ``enough`` entries."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, met, held, found = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}, 0, []
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        size = int(cells[a[i], b[j]])
        if size:
            held += size
            found.append((int(a[i]), int(b[j])))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in met:
                met.add((x, y))
                heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))
    return found


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vec) of the vectors that take part: not null, with no null or non-finite
    component, not zero, and of the most common length (the longest of equally common)."""
    plain = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vec"))
    sound = plain.filter("vec_id is not null and vec is not null and size(vec) > 0").filter(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))) & F.exists("vec", lambda x: x != 0)
    )
    lengths = sound.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return sound.filter(F.size("vec") == (lengths[0]["n"] if lengths else -1))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def unit(rows: np.ndarray) -> np.ndarray:
    peak = np.abs(rows).max(1, keepdims=True)  # scaled first: no overflow, no underflow
    rows = rows / peak
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def build_index(vectors: DataFrame, codes: int = 16, rounds: int = 10, seed: int = 1) -> Index | None:
    """Fit the codebooks to at most FIT_VECTORS vectors (by a hash of the id) and place
    every vector. None if no vector takes part."""
    sample = vectors.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(FIT_VECTORS).toArrow()
    if not sample.num_rows:
        return None
    points = unit(matrix(sample.column("vec")))
    half = points.shape[1] - points.shape[1] // 2
    books = tuple(kmeans(p, codes, rounds, seed) if p.shape[1] else np.zeros((1, 0)) for p in (points[:, :half], points[:, half:]))
    importable(vectors.sparkSession)

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                rows = unit(matrix(batch.column(1)))
                codes_ = [nearest(p, b) for p, b in zip((rows[:, :half], rows[:, half:]), books)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int32()) for c in codes_)], ["vec_id", "vec", "first", "second"])

    placed = staged(vectors.mapInArrow(place, "vec_id long, vec array<double>, first int, second int"), "vectors")
    cells = np.zeros((len(books[0]), len(books[1])), np.int64)
    for r in placed.groupBy("first", "second").count().collect():  # at most codes * codes rows
        cells[r["first"], r["second"]] = r["count"]
    return Index(books, cells, placed)


def search(index: Index, queries: DataFrame, k: int, visit: float) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best entries met, other than the query
    itself, by exact cosine, ties to the smaller id."""
    books, cells = index.books, index.cells
    half = books[0].shape[1]
    enough = max(math.ceil(visit * cells.sum()), LEAST * k) + 1  # one more: the query is an entry as well
    chunks = np.maximum(1, -(-cells.sum(1) // CHUNK_ROWS)).tolist()
    blocks = max(1, -(-queries.count() // BLOCK_ROWS))

    def route(batches):
        for batch in batches:
            rows = unit(matrix(batch.column(1))) if batch.num_rows else np.zeros((0, half))
            out: list = [[], [], [], []]
            for at, row in enumerate(rows):
                d = [((b - p) ** 2).sum(1) for b, p in zip(books, (row[:half], row[half:]))]
                by_first: dict = {}
                for a, b in traverse(d[0], d[1], cells, enough):
                    by_first.setdefault(a, []).append(b)
                for a, seconds in by_first.items():
                    for chunk in range(chunks[a]):
                        for column, value in zip(out, (at, a, chunk, seconds)):
                            column.append(value)
            at = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.list_(pa.int32()))],
                ["vec_id", "vec", "first", "chunk", "seconds"],
            )

    asked = queries.select("vec_id", "vec").mapInArrow(route, "vec_id long, vec array<double>, first int, chunk int, seconds array<int>")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int"))
    many = F.element_at(F.array(*[F.lit(c) for c in chunks]), F.col("first") + 1)
    entries = index.entries.withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(3)), many).cast("int"))
    entries = entries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list = [[], [], []]
        if left.num_rows and right.num_rows:
            ids, asked_ids = right.column("vec_id").to_numpy(), left.column("vec_id").to_numpy()
            theirs, ours = matrix(right.column("vec")), matrix(left.column("vec"))
            near = unit(ours) @ unit(theirs).T
            open_ = np.zeros((left.num_rows, len(books[1])), bool)
            for row, seconds in enumerate(left.column("seconds").to_pylist()):
                open_[row, seconds] = True
            near[~open_[:, right.column("second").to_numpy()] | (asked_ids[:, None] == ids[None])] = -np.inf
            for row in range(left.num_rows):
                line = near[row]
                top = np.partition(line, -k)[-k] if len(line) > k else -np.inf
                close = np.flatnonzero((line >= top - 1e-9) & (line > -np.inf))  # near ties are decided exactly
                exact = cosine(ours[row], theirs[close])
                best = np.lexsort((ids[close], -exact))[:k]
                found[0].extend([int(asked_ids[row])] * len(best))
                found[1].extend(ids[close][best].tolist())
                found[2].extend(exact[best].tolist())
        return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())], ["query_id", "vec_id", "score"])

    met = asked.groupBy("first", "chunk", "block").cogroup(entries.groupBy("first", "chunk", "block")).applyInArrow(compare, "query_id long, vec_id long, score double")
    ranked = met.distinct().withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def cosine(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row, the same to the last bit for equal rows."""
    dot = (many * one).sum(1)
    score = dot / (np.sqrt((one * one).sum()) * np.sqrt((many * many).sum(1)))
    bad = ~np.isfinite(score)
    if bad.any():  # squares beyond the range of doubles
        score[bad] = (unit(many[bad]) * unit(one[None])).sum(1)
    return score


def neighbours(vectors: DataFrame, every: int = 50, k: int = 5, visit: float = 0.65, codes: int = 16, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest others of every vector whose id is divisible by ``every``.

    ``visit`` is the share of all entries a query ranks exactly, LEAST * ``k`` of them at
    least; recall grows with it.
    Vectors that are null, zero, or hold null or non-finite components, and rows without
    an id, take no part, neither as queries nor as candidates. Rows that repeat an id
    and a vector are one entry; a query never meets its own id. Fewer candidates than
    ``k`` are all returned; an empty table gives no rows, and other columns don't matter.
    """
    sound = staged(usable(vectors, key, vector), "sound-vectors")
    index = build_index(sound, codes)
    if index is None:
        return sound.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(index, sound.filter(F.col("vec_id") % every == 0), k, visit)
