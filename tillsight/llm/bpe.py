"""Byte-level BPE encoding and decoding.

Text is cut into pieces without a regex. Every code point gets a class; a small automaton then runs
over the classes. Its transition functions compose associatively, so a block is cut into columns
that are scanned side by side: first each column's whole function, then the state each column starts
in, then the boundaries. Pieces tile the text, so equal ones are found by dictionary encoding, and
only pieces that the worker has not met before are merged, all of one length at a time.

Null and empty texts have no ids and decode to nothing. Repeated rows are encoded one by one; all
columns of the input but the text column stay as they are, unless an output column has their name.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import unicodedata
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.text import blocks, coded, map_arrow, ragged, slices, tiles

# Classes of code points.
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
# Symbols: classes with what the next code points decide.
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_SPACE, S_JOIN, S_LAST = range(8)
# States: within a run of a class, after a joining space, letters of a contraction left, ended.
LETTERS, NUMBERS, OTHERS, SPACES, JOIN, ONE_LEFT, TWO_LEFT, ENDED = range(8)
N_STATES = 8
INTS = T.ArrayType(T.IntegerType())
COLUMN = 256
# A block's arrays take some 60 bytes for each byte of text.
BLOCK = 2 << 20
CACHE_PIECES = 300_000
CACHE_BYTES = 16 << 20
LONG_PIECE = 64
MERGE_ROWS = 1 << 16
NO_RANK = np.int32(2**31 - 1)


@functools.cache
def _classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = NUMBER
    # Code points with the property White_Space.
    table[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    table[0x2000:0x200B] = SPACE
    return table


@functools.cache
def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a piece starts here" for every (symbol, state); symbols 8-15 start a row."""
    step = np.zeros((16, N_STATES), dtype=np.uint8)
    starts = np.ones((16, N_STATES), dtype=bool)
    for symbol, run in ((S_LETTER, LETTERS), (S_NUMBER, NUMBERS), (S_OTHER, OTHERS)):
        step[symbol] = run
        starts[symbol, [run, JOIN]] = False
    step[S_LETTER, TWO_LEFT], starts[S_LETTER, TWO_LEFT] = ONE_LEFT, False
    step[S_LETTER, ONE_LEFT], starts[S_LETTER, ONE_LEFT] = ENDED, False
    for symbol, left in ((S_SHORT, ONE_LEFT), (S_LONG, TWO_LEFT)):
        step[symbol] = left
        step[symbol, [OTHERS, JOIN]] = OTHERS
        starts[symbol, [OTHERS, JOIN]] = False
    step[S_SPACE] = SPACES
    starts[S_SPACE, SPACES] = False
    step[S_JOIN] = JOIN
    step[S_LAST] = SPACES
    step[8:] = step[:8, [ENDED]]
    return step.ravel(), starts.ravel()


def _symbols(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The symbol of every code point; `first` marks the first one of each row."""
    kind = _classes()[codes]
    n = len(codes)
    kind_ahead = np.full(n, SPACE, dtype=np.uint8)  # the end of a text counts as white space
    same = np.zeros(n, dtype=bool)
    same[:-1] = ~first[1:]
    kind_ahead[:-1][same[:-1]] = kind[1:][same[:-1]]
    symbol = kind.copy()
    space = kind == SPACE
    last = space & (kind_ahead != SPACE)
    symbol[space] = S_SPACE
    symbol[last] = np.where(codes[last] == 32, S_JOIN, S_LAST)
    quote = np.flatnonzero(codes == 39)
    if len(quote):
        row_end = np.append(np.flatnonzero(first)[1:], n)
        end = row_end[np.searchsorted(row_end, quote, side="right")]
        one = np.where(quote + 1 < end, codes[np.minimum(quote + 1, n - 1)], 0)
        two = np.where(quote + 2 < end, codes[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
        long |= (one == ord("l")) & (two == ord("l"))
        symbol[quote[short]] = S_SHORT
        symbol[quote[long]] = S_LONG
    symbol[first] += 8
    return symbol


def piece_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places where pieces start, by a scan of transition functions."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    step, starts = _automaton()
    columns = -(-n // COLUMN)
    padded = np.zeros(columns * COLUMN, dtype=np.uint8)
    padded[:n] = _symbols(codes, first)
    grid = np.ascontiguousarray(padded.reshape(columns, COLUMN).T) * np.uint8(N_STATES)
    whole = np.tile(np.arange(N_STATES, dtype=np.uint8), (columns, 1))
    for row in grid:
        whole = step[row[:, None] + whole]
    # Exclusive scan: compose each column's function with those before it, doubling the reach.
    reach = 1
    while reach < columns:
        later = whole.copy()
        later[reach:] = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), axis=1)
        whole, reach = later, reach * 2
    state = np.full(columns, ENDED, dtype=np.uint8)
    state[1:] = whole[:-1, ENDED]
    found = np.empty((COLUMN, columns), dtype=bool)
    for k, row in enumerate(grid):
        at = row + state
        found[k] = starts[at]
        state = step[at]
    return np.flatnonzero(found.T.ravel()[:n])


class Vocabulary:
    """Ranks of a byte-level BPE vocabulary, with a bounded cache of merged pieces.

    The cache maps a piece to its place in one flat pool of ids; it is emptied when it is full.
    """

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = max(self.ranks.values()) + 1
        names = [b""] * size
        for token, rank in self.ranks.items():
            names[rank] = token
        self.tokens = pa.array(names, pa.binary())
        self.decimals = pa.array([b"%d " % i for i in range(size)], pa.binary())
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        keys, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        order = np.argsort(keys)
        self.pairs = np.array(keys, dtype=np.int64)[order]
        self.merged = np.array(merged, dtype=np.int32)[order]
        self._empty()

    def _empty(self) -> None:
        self.cache: dict[bytes, int] = {}
        self.cached_bytes = 0
        self.pool = np.zeros(1 << 16, dtype=np.int32)
        self.pool_at = np.zeros(1 << 14, dtype=np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.merged[at], NO_RANK)

    def _merge_equal(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge pieces of one length together; of equal ranks the leftmost pair goes first.

        Returns the ids, filled up with -1, and how many there are in each row."""
        n, width = pieces.shape
        ids = self.byte_ids[pieces]
        out, counts = np.full((n, width), -1, dtype=np.int32), np.zeros(n, dtype=np.int64)
        rows = np.arange(n)
        rank = self._rank(ids[:, :-1], ids[:, 1:])
        while len(rows):
            width = ids.shape[1]
            if width > 1:
                at = rank.argmin(axis=1)
                best = rank[np.arange(len(rows)), at]
                done = best == NO_RANK
            else:
                done = np.ones(len(rows), dtype=bool)
            out[rows[done], :width] = ids[done]
            counts[rows[done]] = width
            if done.all():
                break
            go = ~done
            rows, ids, at, best, rank = rows[go], ids[go], at[go], best[go], rank[go]
            each = np.arange(len(rows))
            column = np.arange(width - 1)
            ids = np.take_along_axis(ids, column[None] + (column[None] > at[:, None]), axis=1)
            ids[each, at] = best
            column = column[:-1]
            rank = np.take_along_axis(rank, column[None] + (column[None] >= at[:, None]), axis=1)
            left, right = each[at > 0], each[at < ids.shape[1] - 1]
            rank[left, at[left] - 1] = self._rank(ids[left, at[left] - 1], ids[left, at[left]])
            rank[right, at[right]] = self._rank(ids[right, at[right]], ids[right, at[right] + 1])
        return out, counts

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """Merge one long piece with a heap, in n log n."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        start = self._rank(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, k, ids[k], ids[k + 1]) for k, r in enumerate(start) if r != NO_RANK]
        heapq.heapify(heap)

        def push(k: int) -> None:
            if k >= 0 and after[k] < n:
                pair = ids[k] << 32 | ids[after[k]]
                at = int(np.searchsorted(self.pairs, pair))
                if at < len(self.pairs) and self.pairs[at] == pair:
                    heapq.heappush(heap, (int(self.merged[at]), k, ids[k], ids[after[k]]))

        while heap:
            rank, k, left, right = heapq.heappop(heap)
            gone = after[k]
            if ids[k] != left or gone >= n or ids[gone] != right:
                continue
            ids[k], ids[gone] = rank, -1
            after[k] = after[gone]
            if after[k] < n:
                before[after[k]] = k
            push(before[k])
            push(k)
        return np.array([i for i in ids if i >= 0], dtype=np.int32)

    def _merged(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, one after the other, and where each one's start."""
        raw, offsets = tiles(pieces)
        size = np.diff(offsets)
        whole = np.fromiter(map(self.ranks.get, pieces.to_pylist(), repeat(-1)), np.int64, len(pieces))
        counts = np.ones(len(pieces), dtype=np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        split = whole < 0
        for width in np.unique(size[split]).tolist():
            group = np.flatnonzero(split & (size == width))
            if width <= LONG_PIECE:
                for lo in range(0, len(group), MERGE_ROWS):
                    some = group[lo : lo + MERGE_ROWS]
                    ids, counts[some] = self._merge_equal(raw[offsets[some][:, None] + np.arange(width)])
                    parts.append((some, ids[ids >= 0]))
            else:
                for k in group.tolist():
                    ids = self._merge_long(raw[offsets[k] : offsets[k + 1]].tobytes())
                    counts[k] = len(ids)
                    parts.append((np.array([k]), ids))
        at = np.concatenate([[0], np.cumsum(counts)])
        flat = np.empty(at[-1], dtype=np.int32)
        flat[at[:-1][~split]] = whole[~split]
        for some, ids in parts:
            flat[ragged(at[some], counts[some])] = ids
        return flat, at

    def merge(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids and, for each of the distinct pieces, its first place and number of ids."""
        if len(self.cache) > CACHE_PIECES or self.cached_bytes > CACHE_BYTES:
            self._empty()
        names = pieces.to_pylist()
        at = np.fromiter(map(self.cache.get, names, repeat(-1)), np.int64, len(names))
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            flat, offsets = self._merged(pieces.take(pa.array(fresh)))
            known = len(self.cache)
            used = int(self.pool_at[known])
            self.pool = _grown(self.pool, used + len(flat))
            self.pool[used : used + len(flat)] = flat
            self.pool_at = _grown(self.pool_at, known + len(fresh) + 1)
            self.pool_at[known : known + len(offsets)] = offsets + used
            at[fresh] = known + np.arange(len(fresh))
            self.cached_bytes += sum(len(names[k]) for k in fresh.tolist())
            self.cache.update(zip([names[k] for k in fresh.tolist()], at[fresh].tolist(), strict=True))
        return self.pool, self.pool_at[at], self.pool_at[at + 1] - self.pool_at[at]


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    larger = np.zeros(max(size, 2 * len(array)), dtype=array.dtype)
    larger[: len(array)] = array
    return larger


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_block(
    vocab: Vocabulary, buf: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a block's texts with each row's range, their decimals with each row's range, and the
    byte place where each piece starts."""
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    codes = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    first = np.zeros(len(codes), dtype=bool)
    rows = np.searchsorted(lead, offsets[:-1][offsets[1:] > offsets[:-1]])
    first[rows] = True
    starts = lead[piece_starts(codes, first)] if len(codes) else lead
    if len(starts) == 0:
        none = np.zeros(len(offsets), dtype=np.int64)
        return np.zeros(0, np.int32), none, np.zeros(0, np.uint8), none, starts
    code, pieces = coded(slices(buf, np.append(starts, len(buf))))
    pool, place, count = vocab.merge(pieces)
    count = count[code]
    ids = pool[ragged(place[code], count)]
    id_at = np.concatenate([[0], np.cumsum(count)])
    bounds = id_at[np.searchsorted(starts, offsets)]
    text, text_at = tiles(vocab.decimals.take(pa.array(ids)))
    return ids, bounds, text, text_at[bounds], starts


def decode_block(vocab: Vocabulary, ids: np.ndarray, bounds: np.ndarray):
    """Bytes of all texts of a block, and each row's range."""
    raw, at = tiles(vocab.tokens.take(pa.array(ids)))
    return raw, at[bounds]


def _replaced(batch: pa.RecordBatch, columns: dict[str, pa.Array], drop: str) -> pa.RecordBatch:
    keep = [n for n in batch.schema.names if n not in columns and n != drop]
    return pa.RecordBatch.from_arrays(
        [batch.column(n) for n in keep] + list(columns.values()), keep + list(columns)
    )


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Each row with `ids` (array of int) and `piece_offsets` (byte places where pieces start) in
    place of its text; decode() gives the text back."""

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch.column(text), BLOCK):
                ids, bounds, _, _, starts = encode_block(vocab, buf, offsets)
                cut = np.searchsorted(starts, offsets)
                row = np.repeat(np.arange(hi - lo), np.diff(cut))
                columns = {
                    "ids": pa.ListArray.from_arrays(
                        pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())
                    ),
                    "piece_offsets": pa.ListArray.from_arrays(
                        pa.array(cut, pa.int32()), pa.array(starts - offsets[row], pa.int32())
                    ),
                }
                yield _replaced(batch.slice(lo, hi - lo), columns, text)

    kept = [f for f in docs.schema.fields if f.name not in ("ids", "piece_offsets", text)]
    schema = docs.select(*[f"`{f.name}`" for f in kept]).schema
    schema = schema.add("ids", INTS).add("piece_offsets", INTS)
    return map_arrow(docs, run, schema)


def encoded_and_checked(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Each row with `ids`, `n_tokens` and `decoded_sha256`, the digest of the ids' bytes, in place of
    its text."""
    names = ("ids", "n_tokens", "decoded_sha256")

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch.column(text), BLOCK):
                ids, bounds, _, _, _ = encode_block(vocab, buf, offsets)
                raw, at = decode_block(vocab, ids, bounds)
                columns = {
                    "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                    "n_tokens": pa.array(np.diff(bounds)),
                    "decoded_sha256": pa.array(_digests(raw, at), pa.string()),
                }
                yield _replaced(batch.slice(lo, hi - lo), columns, text)

    kept = [f for f in docs.schema.fields if f.name not in (*names, text)]
    schema = docs.select(*[f"`{f.name}`" for f in kept]).schema
    schema = schema.add("ids", INTS).add("n_tokens", "long").add("decoded_sha256", "string")
    return map_arrow(docs, run, schema)


def _digests(data: np.ndarray, at: np.ndarray, less: int = 0) -> list[str]:
    """SHA-256 of each row's bytes, without its last `less`."""
    view, at = memoryview(np.ascontiguousarray(data)), at.tolist()
    return [hashlib.sha256(view[a : max(a, b - less)]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Each row with the bytes of its ids as `decoded`, in place of the ids."""

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            column = batch.column(ids)
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.array([len(x) if x is not None else 0 for x in column])
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            raw, at = decode_block(vocab, values, bounds)
            yield _replaced(batch, {"decoded": slices(raw, at).cast(pa.binary())}, ids)

    kept = [f for f in encoded.schema.fields if f.name not in ("decoded", ids)]
    schema = encoded.select(*[f"`{f.name}`" for f in kept]).schema.add("decoded", "binary")
    return map_arrow(encoded, run, schema)


def encoded_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the key, the number of ids, the digest of the ids, and the digest of what they
    decode to. Ids never leave the task, so nothing is written or shuffled."""
    schema = docs.select(F.col(f"`{key}`")).schema
    schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            keys = batch.column(key)
            for lo, hi, buf, offsets in blocks(batch.column(text), BLOCK):
                ids, bounds, decimals, at, _ = encode_block(vocab, buf, offsets)
                raw, raw_at = decode_block(vocab, ids, bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(lo, hi - lo),
                        pa.array(np.diff(bounds)),
                        pa.array(_digests(decimals, at, 1), pa.string()),
                        pa.array(_digests(raw, raw_at), pa.string()),
                    ],
                    schema.names,
                )

    return map_arrow(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")), run, schema)
