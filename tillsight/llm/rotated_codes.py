"""Nearest neighbours by randomly rotated one-bit codes.

A vector, less the centre, is turned by a random rotation and kept as the signs of its components,
packed to bits, with two scalars: its length, and the inner product of its direction with its code.
From these the inner product with a query is estimated without bias, and a bound on the error
follows from the same scalar. Within a block of vectors the k best estimates are measured exactly; of
the rest only those whose lower bound does not exceed the k-th of these distances are.

The centre is the mean of a bounded sample (`SAMPLE_ROWS`); every row is coded. Rows and queries are
packed into blocks, and each pair of blocks is one row of work, so no task holds all of either. A task
keeps k + 1 rows per query over the blocks it is given, and the rank over them has Spark's limit per
group before its shuffle.

Vectors that are null, zero, or hold null or non-finite components take no part; rows with a null id
neither. Vectors are compared with those of their own length; each length has its own centre and
rotation. Rows that share an id are rows of their own: each that is asked for is a query, answered under
the same id, and finds the others. Of a query's own row and its exact copies under the same id one is
left out, whichever it is. Only the id and the vector are read.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.text import map_arrow
from tillsight.workspace import Workspace

SAMPLE_ROWS = 16_384
BLOCK_ROWS = 2_048
QUERY_ROWS = 256
SEED = 20_240_101
# Answers a task holds before it reduces them, and passes them on if that is not enough.
HELD_ROWS = 1 << 20
# Error bounds in standard deviations of the estimate.
WIDTH = 2.5


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Ids and vectors that take part, in double precision."""
    rows = vectors.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    )
    return rows


def centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """For each length the mean of the rows whose hashed ids are smallest."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").toArrow()
    lists = sample.column(0).combine_chunks()
    return {size: vectors.mean(axis=0) for size, _, vectors in by_length(lists)}


def by_length(lists) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and vectors of each length among lists of numbers."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    found = []
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        found.append((size, rows, np.ascontiguousarray(flat[starts[rows][:, None] + np.arange(size)])))
    return found


@functools.lru_cache(maxsize=8)
def rotation_of(size: int) -> np.ndarray:
    """An orthogonal matrix from a fixed seed."""
    rotation, upper = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))
    return rotation * np.sign(np.diag(upper))


def encode(vectors: np.ndarray, centre: np.ndarray, rotation: np.ndarray):
    """Packed signs, lengths and code products of vectors."""
    moved = vectors - centre
    length = np.linalg.norm(moved, axis=1)
    turned = moved @ rotation.T / np.where(length > 0, length, 1)[:, None]
    product = np.abs(turned).sum(axis=1) / math.sqrt(vectors.shape[1])
    return np.packbits(turned > 0, axis=1), length, np.where(length > 0, product, 1.0)


def bounds(codes, length, product, queries: np.ndarray, centre, rotation):
    """Lower and upper bounds of squared distances, one row per vector, one column per query."""
    size = queries.shape[1]
    moved = (queries - centre) @ rotation.T
    reach = np.linalg.norm(moved, axis=1)
    signs = np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1
    inner = (signs @ moved.T.astype(np.float32)).astype(np.float64) / math.sqrt(size) / product[:, None]
    spread = np.sqrt(np.maximum(1 - product**2, 0)) / product / math.sqrt(max(size - 1, 1))
    middle = length[:, None] ** 2 + reach[None] ** 2 - 2 * length[:, None] * inner
    error = 2 * WIDTH * length[:, None] * spread[:, None] * reach[None] + 1e-4 * (length.max(initial=0) + reach[None]) ** 2
    return middle - error, middle + error


def _flat(column, size: int) -> np.ndarray:
    return np.frombuffer(column, dtype=np.float64).reshape(-1, size)


def nearest_in_block(block: dict, queries: dict, centre, rotation, k: int):
    """For each query of a block its k nearest of a block of vectors: query rows, ids, ids, distances."""
    size = len(centre)
    ids, vectors = np.frombuffer(block["ids"], np.int64), _flat(block["vectors"], size)
    wanted, asked = np.frombuffer(queries["ids"], np.int64), _flat(queries["vectors"], size)
    codes = np.frombuffer(block["codes"], np.uint8).reshape(len(ids), -1)
    lower, upper = bounds(
        codes, np.frombuffer(block["lengths"]), np.frombuffer(block["products"]), asked, centre, rotation
    )
    # The exact distances of the k best estimates bound the k-th distance from above.
    if len(ids) > k:
        best = np.argpartition(lower + upper, k - 1, axis=0)[:k]
        limit = ((vectors[best] - asked[None]) ** 2).sum(axis=2).max(axis=0)
    else:
        limit = np.full(len(wanted), np.inf)
    rows, columns = np.nonzero(lower <= limit)
    distance = np.empty(len(rows))
    for lo in range(0, len(rows), 1 << 16):
        part = slice(lo, lo + (1 << 16))
        distance[part] = np.sqrt(((vectors[rows[part]] - asked[columns[part]]) ** 2).sum(axis=1))
    place = np.frombuffer(queries["places"], np.int64)
    return _best([place[columns], wanted[columns], ids[rows], distance], k)


def _best(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The k nearest of each query row."""
    order = np.lexsort((found[2], found[3], found[0]))
    place = found[0][order]
    top = order[np.arange(len(place)) - np.searchsorted(place, place) < k]
    return [f[top] for f in found]


def _packed(rows: DataFrame, limit: int, middle: dict[int, np.ndarray], codes: bool) -> DataFrame:
    """Rows of one length packed into blocks of at most `limit`, with codes or with the rows' places."""
    names = ["ids", "vectors"] + (["codes", "lengths", "products"] if codes else ["places"])

    def block(size, ids, places, vectors):
        parts = [ids, vectors]
        if codes:
            parts += encode(vectors, middle.get(size, np.zeros(size)), rotation_of(size))
        else:
            parts.append(places)
        return [size, *(p.tobytes() for p in parts)]

    def run(batches):
        for batch in batches:
            ids, places = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "place"))
            for size, mine, vectors in by_length(batch.column("v")):
                made = []
                for lo in range(0, len(mine), limit):
                    part = mine[lo : lo + limit]
                    made.append(block(size, ids[part], places[part], vectors[lo : lo + limit]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m[0] for m in made], pa.int32())]
                    + [pa.array([m[k + 1] for m in made], pa.binary()) for k in range(len(names))],
                    ["size", *names],
                )

    placed = rows.select("id", "v", F.monotonically_increasing_id().alias("place"))
    return map_arrow(placed, run, "size int, " + ", ".join(f"{n} binary" for n in names))


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    ws: Workspace | None = None,
) -> DataFrame:
    """The k nearest rows of each query: query_id, rank, vec_id, score (Euclidean distance)."""
    ws = ws or Workspace(vectors.sparkSession)
    rows = usable(vectors, key, vector)
    middle = centres(rows)
    index = ws.save(_packed(rows, BLOCK_ROWS, middle, True), "index")
    sought = ws.save(_packed(usable(queries, key, vector), QUERY_ROWS, middle, False), "queries")
    # The stated queries against all rows, block by block: rows of this product are pairs of blocks.
    work = index.select(F.struct(*index.columns).alias("block")).crossJoin(
        sought.select(F.struct(*sought.columns).alias("queries"))
    )
    names = ["place", "query_id", "vec_id", "score"]

    def run(batches):
        held, many = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                size = row["block"]["size"]
                if size != row["queries"]["size"]:
                    continue
                centre = middle.get(size, np.zeros(size))
                held.append(nearest_in_block(row["block"], row["queries"], centre, rotation_of(size), k + 1))
                many += len(held[-1][0])
                if many > HELD_ROWS:
                    held = [_best([np.concatenate(c) for c in zip(*held)], k + 1)]
                    many = len(held[0][0])
                    if many > HELD_ROWS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(f) for f in held[0]], names)
                        held, many = [], 0
        if held:
            best = _best([np.concatenate(c) for c in zip(*held)], k + 1)
            yield pa.RecordBatch.from_arrays([pa.array(f) for f in best], names)

    near = map_arrow(work, run, "place long, query_id long, vec_id long, score double")
    order = Window.partitionBy("place").orderBy("score", "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
    # Of the query's own row and its copies, which are alike in every column, one is left out.
    same = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == 0)
    own = F.min(F.when(same, F.col("rank"))).over(Window.partitionBy("place"))
    others = ranked.withColumn("own", own).where(F.col("own").isNull() | (F.col("rank") != F.col("own")))
    later = F.coalesce(F.col("rank") > F.col("own"), F.lit(False)).cast("int")
    return others.withColumn("rank", F.col("rank") - later).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
