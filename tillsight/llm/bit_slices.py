"""Exact top-k by inner product on a bit-sliced index.

Components are quantised to whole numbers. A block of rows keeps, for each component, one bitmap per
binary digit of its distance from the block's least value: a slice has one bit per row. The products of
a query's components with a slice are sums of that slice at shifted places; a negative component takes
the complements. All addends of one place are summed by full adders on whole bitmaps, three in, one out
and one carried to the next place, so the scores of all rows of a block come out as slices again. Rows
are then chosen from the most significant slice downward: those that have the digit are taken while no
more than k are, else only they go on; what is left at the end are rows of one equal score, of which
those with the smallest ids are taken. Every step is exact.

Blocks of rows and blocks of queries are paired; a task keeps k rows per query over all its blocks.

Rows whose vector is null or holds null or non-finite components take no part, nor do rows with a null
id, nor vectors with a component so large that a score might not fit in a long (`fits`). Vectors are
compared with those of their own length. Rows that share an id are rows of their own: each may be
found by the others, and each that is asked for is a query, answered under the same id; repeated vectors
tie, and ties go to the smaller id. Only the id and the vector are read, whatever the other columns are
called. An empty table has no answers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.text import map_arrow
from tillsight.workspace import Workspace

BLOCK_ROWS = 8_192
QUERY_ROWS = 256
# Answers a task holds before it reduces them to k per query, and passes them on if that is not enough.
HELD_ROWS = 1 << 20
INDEX = ["ids", "places", "least", "widths", "slices", "asked", "vectors"]
FOUND = ["query", "query_id", "place", "vec_id", "score"]


def quantised(vectors: DataFrame, key: str, vector: str, scale: float, asked: Column) -> DataFrame:
    """Ids, whole-number vectors, and whether a row is a query, of the rows that take part."""
    rows = vectors.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{vector}`").cast("array<double>").alias("x"),
        F.coalesce(asked, F.lit(False)).alias("asked"),
    )
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.where(F.col("id").isNotNull() & F.col("x").isNotNull() & finite)
    rows = rows.where(fits(F.col("x"), scale))
    return rows.select("id", "asked", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))


def fits(x: Column, scale: float) -> Column:
    """Whether products of such vectors, summed over all components, stay below 2^62."""
    largest = F.aggregate(x, F.lit(0.0), lambda a, b: F.greatest(a, F.abs(b)))
    return F.pow(largest * scale + 1, F.lit(2.0)) * F.size(x) < F.lit(2.0**62)


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least value and number of digits of each component, and all slices: one row per component and
    digit, least digit first, 64 rows of the block to a word."""
    least = values.min(axis=0)
    above = (values - least).astype(np.uint64)
    widths = np.array([int(top).bit_length() for top in above.max(axis=0)], dtype=np.int64)
    words = -(-len(values) // 64)
    made = np.zeros((int(widths.sum()), words * 64), dtype=np.uint8)
    at = 0
    for j, width in enumerate(widths):
        for digit in range(width):
            made[at, : len(values)] = (above[:, j] >> np.uint64(digit)) & np.uint64(1)
            at += 1
    return least, widths, np.packbits(made, axis=1, bitorder="little").view(np.uint64)


class Block:
    """A block of the index, ready to be asked."""

    def __init__(self, ids, places, least, widths, slices):
        self.ids, self.places, self.least, self.widths = ids, places, least, widths
        self.words = -(-len(ids) // 64)
        own = slices.reshape(-1, self.words)
        self.slices = np.concatenate([own, ~own])
        self.component = np.repeat(np.arange(len(widths)), widths)
        self.digit = np.arange(len(own)) - np.repeat(np.cumsum(widths) - widths, widths)
        bits = np.zeros(self.words * 64, dtype=np.uint8)
        bits[: len(ids)] = 1
        self.rows = np.packbits(bits, bitorder="little").view(np.uint64)
        self.row_of = {int(p): i for i, p in enumerate(places)}

    def sums(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of every row's score less a constant, least digit first, and the constant."""
        size = np.abs(query)
        negative = query < 0
        # A complement counts down from the largest number of its digits.
        full = np.array([(1 << int(w)) - 1 for w in self.widths], dtype=object)
        base = np.where(negative, -(full + self.least.astype(object)), self.least.astype(object))
        constant = int(sum(int(s) * int(b) for s, b in zip(size, base)))
        weight = size[self.component]
        source = np.arange(len(weight)) + np.where(negative[self.component], len(weight), 0)
        parts: dict[int, list[np.ndarray]] = {}
        for digit in range(int(size.max(initial=0)).bit_length()):
            set_ = np.flatnonzero((weight >> digit) & 1)
            order = set_[np.argsort(self.digit[set_], kind="stable")]
            heights, first = np.unique(self.digit[order], return_index=True)
            for height, chosen in zip(heights, np.split(order, first[1:])):
                parts.setdefault(int(height) + digit, []).append(source[chosen])
        result, carried, place = [], [], 0
        while carried or place <= max(parts, default=-1):
            addends = [self.slices[np.concatenate(parts[place])]] if place in parts else []
            held = np.concatenate([*addends, *carried]) if addends or carried else np.zeros((0, self.words), np.uint64)
            carried = []
            while len(held) > 2:
                third = len(held) // 3
                a, b, c = held[:third], held[third : 2 * third], held[2 * third : 3 * third]
                odd = a ^ b
                carried.append((a & b) | (odd & c))
                held = np.concatenate([odd ^ c, held[3 * third :]])
            if len(held) == 2:
                carried.append(held[:1] & held[1:])
                held = held[:1] ^ held[1:]
            result.append(held[0] if len(held) else np.zeros(self.words, np.uint64))
            place += 1
        return result, constant

    def top(self, query: np.ndarray, place: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the k best scores, the query's own row left out, and these scores."""
        sums, constant = self.sums(query)
        open_ = self.rows.copy()
        own = self.row_of.get(place)
        if own is not None:
            open_[own // 64] &= ~np.uint64(1 << (own % 64))
        taken, count = np.zeros_like(open_), 0
        for digits in reversed(sums):
            with_digit = open_ & digits
            more = int(np.bitwise_count(with_digit).sum())
            if count + more > k:
                open_ = with_digit
            else:
                taken |= with_digit
                count += more
                open_ &= ~digits
            if count == k:
                break
        rows = np.flatnonzero(np.unpackbits(taken.view(np.uint8), bitorder="little"))
        if count < k:
            # The rest have equal scores, and rows are in the order of their ids.
            equal = np.flatnonzero(np.unpackbits(open_.view(np.uint8), bitorder="little"))
            rows = np.concatenate([rows, equal[: k - count]])
        scores = np.zeros(len(rows), dtype=np.int64)
        word, bit = rows // 64, (rows % 64).astype(np.uint64)
        for p, digits in enumerate(sums):
            scores += ((digits[word] >> bit) & np.uint64(1)).astype(np.int64) << p
        return rows, scores + constant


def _index(rows: DataFrame, limit: int) -> DataFrame:
    """Blocks of at most `limit` rows of one length, each with the queries among its rows."""

    def made(ids, places, values, asked):
        order = np.lexsort((places, ids))
        ids, places, values, asked = ids[order], places[order], values[order], asked[order]
        least, widths, slices = slices_of(values)
        return [values.shape[1], *(x.tobytes() for x in (ids, places, least, widths, slices, asked, values[asked]))]

    def emit(found):
        columns = [pa.array([f[0] for f in found], pa.int32())]
        columns += [pa.array([f[i] for f in found], pa.binary()) for i in range(1, len(INDEX) + 1)]
        return pa.RecordBatch.from_arrays(columns, ["size", *INDEX])

    def run(batches):
        held: dict[int, list] = {}

        def flush(size):
            parts = held.pop(size)
            whole = [np.concatenate([p[i] for p in parts]) for i in range(4)]
            return [made(*(w[lo : lo + limit] for w in whole)) for lo in range(0, len(whole[0]), limit)]

        for batch in batches:
            ids, places = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "place"))
            asked = batch.column("asked").to_numpy(zero_copy_only=False).astype(bool)
            lists = batch.column("v")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes):
                mine = np.flatnonzero(sizes == size)
                values = flat[(starts[mine][:, None] + np.arange(size)).astype(np.int64)]
                held.setdefault(int(size), []).append((ids[mine], places[mine], values, asked[mine]))
                if sum(len(p[0]) for p in held[int(size)]) >= limit:
                    yield emit(flush(int(size)))
            if sum(len(p[0]) for parts in held.values() for p in parts) >= 2 * limit:
                yield emit([block for size in list(held) for block in flush(size)])
        rest = [block for size in list(held) for block in flush(size)]
        if rest:
            yield emit(rest)

    # A block holds `limit` rows where there are that many; the row's place is fixed once written.
    parts = max(1, -(-rows.count() // limit))
    placed = rows.repartition(parts).withColumn("place", F.monotonically_increasing_id())
    schema = "size int, " + ", ".join(f"{name} binary" for name in INDEX)
    return map_arrow(placed, run, schema)


def _queries(index: DataFrame, limit: int) -> DataFrame:
    """The queries of all blocks, `limit` to a row."""

    def run(batches):
        for batch in batches:
            for row in batch.select(["size", "ids", "places", "asked", "vectors"]).to_pylist():
                asked = np.frombuffer(row["asked"], dtype=bool)
                if not asked.any():
                    continue
                ids, places = (np.frombuffer(row[c], np.int64)[asked] for c in ("ids", "places"))
                vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), row["size"])
                cuts = range(0, len(ids), limit)
                parts = [[x[lo : lo + limit].tobytes() for lo in cuts] for x in (ids, places, vectors)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["size"]] * len(cuts), pa.int32()), *(pa.array(p, pa.binary()) for p in parts)],
                    ["q_size", "q_ids", "q_places", "q_vectors"],
                )

    return map_arrow(index, run, "q_size int, q_ids binary, q_places binary, q_vectors binary")


def _best(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The k best answers of each query."""
    query, _, place, ids, scores = found
    order = np.lexsort((place, ids, -scores, query))
    query = query[order]
    top = order[np.arange(len(query)) - np.searchsorted(query, query) < k]
    return [f[top] for f in found]


def search(
    vectors: DataFrame,
    asked: Column,
    k: int = 20,
    scale: float = 64,
    key: str = "vec_id",
    vector: str = "embedding",
    ws: Workspace | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k rows of largest inner product for each row that is `asked` for: query_id, rank, vec_id, score."""
    ws = ws or Workspace(vectors.sparkSession)
    index = ws.save(_index(quantised(vectors, key, vector, scale, asked), block_rows), "slices")
    queries = ws.save(_queries(index, QUERY_ROWS), "asked")
    # The stated queries against all rows: rows of this product are pairs of blocks, not of rows.
    work = index.select("size", *INDEX[:5]).crossJoin(queries)

    def run(batches):
        held: list[list[np.ndarray]] = []
        rows = 0
        last, block = None, None
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if row["size"] != row["q_size"]:
                    continue
                if last != (row["size"], row["places"]):
                    last = (row["size"], row["places"])
                    block = Block(*(np.frombuffer(row[c], np.uint64 if c == "slices" else np.int64) for c in INDEX[:5]))
                ids, places = (np.frombuffer(row[c], np.int64) for c in ("q_ids", "q_places"))
                asked_for = np.frombuffer(row["q_vectors"], np.int64).reshape(len(ids), row["size"])
                for i, (id_, place) in enumerate(zip(ids, places)):
                    chosen, scores = block.top(asked_for[i], int(place), k)
                    same = np.full(len(chosen), 1, dtype=np.int64)
                    held.append([same * place, same * id_, block.places[chosen], block.ids[chosen], scores])
                    rows += len(chosen)
                if rows > HELD_ROWS:
                    held = [_best([np.concatenate(c) for c in zip(*held)], k)]
                    rows = len(held[0][0])
                    if rows > HELD_ROWS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], FOUND)
                        held, rows = [], 0
        if held:
            best = _best([np.concatenate(c) for c in zip(*held)], k)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in best], FOUND)

    near = map_arrow(work, run, ", ".join(f"{name} long" for name in FOUND))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "place")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
