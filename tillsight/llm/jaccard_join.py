"""N-gram Jaccard self-join by grouped prefixes, and its classes.

A text's set holds its distinct five-word shingles as 64-bit hashes. If two sets reach the
similarity, then under any one order of shingles their prefixes share one. The order is by
frequency, rare first, so shared passages seldom stand in a prefix.

1. One pass writes size and digest of every set, and packs the shingles for counting. The most
   frequent ones, `FREQUENT` at most, order the rest of the work; any order is right.
2. A second pass emits prefixes. Texts of equal prefix and size are one group: they are one entry in
   the lists of groups by shingle, and their members are kept apart.
3. Group pairs of close size are read off short lists. To find classes not every pair of a long list
   is needed: first each group is compared with its neighbour in the list, and each set with the one
   of its list that is in most lists: an original, as its copies have shingles of their own in their
   prefixes. Links found make classes. Then, for every long list whose groups are still in several classes, all pairs
   across classes follow, cut into cells of bounded size, so no link between classes is lost and no
   list is one task's.
4. Pairs of groups are expanded to members. Pairs whose parity sketches differ in more bits than
   similar sets can differ in shingles are dropped; the rest are verified on their whole sets.

Equal sets are one node throughout, so copies never become pairs. Sets are told apart by 64-bit
digests and sizes.

Defined cases: a null text, or one without words, has an empty set and is its own class. A text of
fewer than five words has its whole sequence as its one shingle. Repeated rows are one class. A null
id never names a class unless all ids of the class are null. Only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillsight.llm.components import components
from tillsight.llm.text import LOWER, blocks, coded, free_names, map_arrow, words
from tillsight.workspace import Workspace

SHINGLE = 5
PERCENT = 80
FREQUENT = 1 << 20
CHUNK_BYTES = 4 << 20
FLUSH = 1 << 20
COUNT_BITS = 24  # shingles are counted by places of so many bits within a chunk; the order may err
CELL = 256
SMALL = 8  # lists of so many groups are read off pair by pair
SKETCH_WORDS = 8  # 64-bit words of a set's parity sketch
BITMAP = (20, 28)  # least and most bits of an address in the candidates' bitmap: 128 KB to 32 MB
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a sum over the whole hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(buf: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The set of each text of a block, sorted."""
    array, _, bounds = words(LOWER[buf], offsets)
    code, names = coded(array)
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names.to_pylist()), np.uint64, len(names))
    word = own[code] if len(code) else np.zeros(0, np.uint64)
    n = max(len(word) - SHINGLE + 1, 0)
    total = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        total += word[j : j + n] * _MULTIPLIERS[j]
    total = _mixed(total)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(total[a : b - SHINGLE + 1]))
        elif b > a:
            short = (word[a:b] * _MULTIPLIERS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(_mixed(np.array([short], np.uint64)))
        else:
            out.append(total[:0])
    return out


def set_id(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes(), seed=len(shingles)) - (1 << 63)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of the shingles by hashed place. Two sketches differ in no more bits than their sets
    in shingles."""
    bits = np.bincount((shingles >> np.uint64(17)).astype(np.int64) % (64 * SKETCH_WORDS), minlength=64 * SKETCH_WORDS)
    return np.packbits((bits & 1).astype(np.uint8))


def _address(h: np.ndarray, chunks: int, bits: int = 32) -> np.ndarray:
    """Chunk and a place of so many bits within it, as one number that sorts by both."""
    chunk = ((h >> np.uint64(32)) * np.uint64(chunks)) >> np.uint64(32)
    return chunk << np.uint64(bits) | h & np.uint64((1 << bits) - 1)


def _planes(values: np.ndarray) -> bytes:
    """Numbers by byte planes: planes of zeros cost next to nothing once compressed."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(data: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, n).T).view(kind).ravel()


def _by_chunk(address: np.ndarray, bits: int = 32):
    """(chunk, first, end) of each run of sorted addresses."""
    chunk = (address >> np.uint64(bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(chunk)) + 1
    for lo, hi in zip(np.append(0, cuts).tolist(), np.append(cuts, len(chunk)).tolist(), strict=True):
        if hi > lo:
            yield int(chunk[lo]), lo, hi


def _steps(low: np.ndarray) -> np.ndarray:
    return np.diff(low, prepend=np.uint32(0)).astype(np.uint32)


def _low(address: np.ndarray, bits: int = 32) -> np.ndarray:
    return (address & np.uint64((1 << bits) - 1)).astype(np.uint32)


def _sizes_and_counts(docs: DataFrame, chunks: int) -> DataFrame:
    """Per row key, size and set id; besides, packed shingles by chunk for counting."""
    schema = docs.select("key").schema.add("n", "integer").add("sid", "long")
    schema = schema.add("chunk", "integer").add("blob", "binary")
    names = schema.names

    def packed(held: list[np.ndarray], kind) -> pa.RecordBatch:
        address = np.sort(_address(np.concatenate(held), chunks, COUNT_BITS))
        low, rows = _low(address, COUNT_BITS), list(_by_chunk(address, COUNT_BITS))
        blobs = [_planes(_steps(low[lo:hi])) for _, lo, hi in rows]
        none = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(none, kind), pa.nulls(none, pa.int32()), pa.nulls(none, pa.int64()),
             pa.array([r[0] for r in rows], pa.int32()), pa.array(blobs, pa.binary())], names,
        )

    def run(batches):
        held, size, kind = [], 0, None
        for batch in batches:
            kind = batch.column(0).type
            for lo, hi, buf, offsets in blocks(batch.column(1)):
                sets = shingle_sets(buf, offsets)
                ids = [set_id(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int32()),
                     pa.array(ids, pa.int64()), pa.nulls(hi - lo, pa.int32()), pa.nulls(hi - lo, pa.binary())], names,
                )
                held += [s for s in sets if len(s)]
                size += sum(map(len, sets))
                if size > FLUSH:
                    yield packed(held, kind)
                    held, size = [], 0
        if held:
            yield packed(held, kind)

    return map_arrow(docs, run, schema)


def _frequent(counts: DataFrame) -> DataFrame:
    """Addresses that occur eight times or more, with their counts."""

    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        parts = [b.as_py() for b in table.column("blob")]
        low = [np.cumsum(_from_planes(b, len(b) // 4, np.uint32), dtype=np.uint32) for b in parts]
        found, n = np.unique(np.concatenate(low), return_counts=True)
        often = n >= 8
        address = np.uint64(chunk) << np.uint64(COUNT_BITS) | found[often].astype(np.uint64)
        return pa.table({"address": address.astype(np.int64), "n": n[often].astype(np.int64)})

    return counts.groupBy("chunk").applyInArrow(run, "address long, n long")


def _order(frequent: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent addresses, FREQUENT at most, and their counts: at most 16 MB.

    Whole classes of counts are taken from the top, so the cut does not depend on row order."""
    grade = F.floor(F.log2("n") * 8).cast("int")
    sizes = frequent.groupBy(grade.alias("g")).count().orderBy(F.desc("g")).collect()  # some 300 rows
    room, lowest = FREQUENT, None
    for row in sizes:
        room -= row["count"]
        if room < 0:
            break
        lowest = row["g"]
    if lowest is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    kept = frequent.where(grade >= lowest).toArrow()
    address = kept.column("address").to_numpy().astype(np.uint64)
    order = np.argsort(address)
    return address[order], kept.column("n").to_numpy()[order]


def prefix_length(n: int) -> int:
    return n - (PERCENT * n + 99) // 100 + 1


def _prefixes(docs: DataFrame, chunks: int, order) -> DataFrame:
    """Packed (shingle, group, size) of prefixes, and packed (group, set, size, sketch) of members."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def packed(kind: int, key: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
        address = _address(key, chunks)
        at = np.argsort(address, kind="stable")
        address, columns = address[at], [c[at] for c in columns]
        low, rows = _low(address), list(_by_chunk(address))
        blobs = [_planes(_steps(low[lo:hi])) + b"".join(_planes(c[lo:hi]) for c in columns) for _, lo, hi in rows]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([kind] * len(rows), pa.int32()), pa.array(blobs, pa.binary())],
            ["chunk", "kind", "blob"],
        )

    def flush(held):
        sizes = np.array([len(h[3]) for h in held])
        group = np.array([h[0] for h in held], np.uint64)
        sid = np.array([h[1] for h in held], np.int64)
        n = np.array([h[2] for h in held], np.uint32)
        bits = np.concatenate([h[4] for h in held]).view(np.uint64).reshape(len(held), SKETCH_WORDS)
        # Texts of equal prefix and size are one entry of the lists.
        _, first = np.unique(group, return_index=True)
        tokens = np.concatenate([held[k][3] for k in first])
        yield packed(0, tokens, np.repeat(group[first], sizes[first]), np.repeat(n[first], sizes[first]))
        yield packed(1, group, group, sid, n, bits)

    def run(batches):
        address, often = shared.value
        maybe = np.zeros(1 << 22, dtype=bool)
        maybe[(address & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        held, seen, size = [], set(), 0
        for batch in batches:
            for _, _, buf, offsets in blocks(batch.column(0)):
                for shingles in shingle_sets(buf, offsets):
                    n = len(shingles)
                    if n == 0:
                        continue
                    sid = set_id(shingles)
                    if sid in seen:
                        continue
                    seen.add(sid)
                    p = prefix_length(n)
                    hot = np.flatnonzero(maybe[(shingles & np.uint64((1 << 22) - 1)).astype(np.int64)])
                    if len(hot):
                        count = np.zeros(n, np.int64)
                        sought = _address(shingles[hot], chunks, COUNT_BITS)
                        at = np.minimum(np.searchsorted(address, sought), len(address) - 1)
                        count[hot] = np.where(address[at] == sought, often[at], 0)
                        prefix = shingles[np.argsort(count, kind="stable")[:p]]
                    else:
                        prefix = shingles[:p].copy()  # a view would keep the whole set
                    group = xxhash.xxh3_64_intdigest(np.sort(prefix).tobytes(), seed=n)
                    held.append((group, sid, n, prefix, sketch(shingles)))
                    size += p
                if size > FLUSH // 2:
                    yield from flush(held)
                    held, seen, size = [], set(), 0
        if held:
            yield from flush(held)

    return map_arrow(docs.select("text"), run, "chunk int, kind int, blob binary")


PAIR, LIST, MEMBER = 0, 1, 2


def _lists(packed: DataFrame) -> DataFrame:
    """Of each chunk: near group pairs (PAIR a b), lists of several groups (LIST list group size),
    and members (MEMBER group set size sketch)."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        postings, members = [], []
        for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist(), strict=True):
            width = 16 if kind == 0 else 24 + 8 * SKETCH_WORDS
            n = len(blob) // width
            if kind == 0:
                low = np.cumsum(_from_planes(blob[: 4 * n], n, np.uint32), dtype=np.uint32)
                group = _from_planes(blob[4 * n : 12 * n], n, np.uint64)
                postings.append((low, group, _from_planes(blob[12 * n :], n, np.uint32)))
            else:
                group = _from_planes(blob[4 * n : 12 * n], n, np.uint64)
                sid = _from_planes(blob[12 * n : 20 * n], n, np.int64)
                size = _from_planes(blob[20 * n : 24 * n], n, np.uint32)
                bits = np.frombuffer(blob[24 * n :], np.uint8).reshape(8 * SKETCH_WORDS, n).T
                members.append((group, sid, size, np.ascontiguousarray(bits)))
        if postings:
            low, group, size = (np.concatenate(c) for c in zip(*postings, strict=True))
            order = np.lexsort((group, size, low))
            low, group, size = low[order], group[order], size[order]
            new = np.ones(len(low), dtype=bool)
            new[1:] = (low[1:] != low[:-1]) | (group[1:] != group[:-1])
            low, group, size = low[new], group[new], size[new]
            first = np.ones(len(low), dtype=bool)
            first[1:] = low[1:] != low[:-1]
            start = np.flatnonzero(first)
            length = np.diff(np.append(start, len(low)))
            many = np.repeat(length > 1, length)
            low, group, size = low[many], group[many], size[many].astype(np.int64)
            length = length[length > 1]
            start = np.cumsum(length) - length
            if len(start):
                # Equal lists are one: shared text puts the same groups under many shingles.
                mark = np.add.reduceat(_mixed(group + np.uint64(length.max())), start) + length.astype(np.uint64)
                name, at = np.unique(mark, return_index=True)
                start, length = start[at], length[at]
                place = np.repeat(start - (np.cumsum(length) - length), length) + np.arange(length.sum())
                group_of, size_of = group[place], size[place]
                head = np.repeat(np.cumsum(length) - length, length)
                at = np.arange(len(place))
                long = np.repeat(length > SMALL, length)
                out.append((np.full(int(long.sum()), LIST), np.repeat(name, length)[long], group_of[long], size_of[long]))
                pairs = []
                for step in range(1, SMALL):
                    near = at - step >= head
                    near &= ~long if step > 1 else True
                    pairs.append((at[near] - step, at[near]))
                one, two = (np.concatenate(c) for c in zip(*pairs, strict=True))
                near = (one != two) & (100 * np.minimum(size_of[one], size_of[two]) >= PERCENT * np.maximum(size_of[one], size_of[two]))
                pair = np.unique(np.stack([group_of[one[near]], group_of[two[near]]], axis=1), axis=0)
                out.append((np.full(len(pair), PAIR), pair[:, 0], pair[:, 1], np.zeros(len(pair), np.int64)))
        sketches = [None] * sum(len(o[0]) for o in out)
        if members:
            group, sid, size, bits = (np.concatenate(c) for c in zip(*members, strict=True))
            _, at = np.unique(np.stack([group.view(np.int64), sid], axis=1), axis=0, return_index=True)
            out.append((np.full(len(at), MEMBER), group[at], sid[at].view(np.uint64), size[at].astype(np.int64)))
            words = bits[at].view(np.int64)
            sketches += words.tolist()
        kind, a, b, n = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4
        return pa.table(
            {
                "kind": kind.astype(np.int32), "a": a.astype(np.uint64).view(np.int64), "b": b.astype(np.uint64).view(np.int64),
                "n": n.astype(np.int32), "bits": pa.array(sketches, pa.list_(pa.int64())),
            }
        )

    return packed.groupBy("chunk").applyInArrow(run, "kind int, a long, b long, n int, bits array<long>")


def _bitmap(ids: DataFrame, count: int) -> np.ndarray:
    """A bitmap of hashed ids, eight bits or more for each up to its largest size. It lets too many
    through, never too few."""
    bits = min(max((8 * count).bit_length(), BITMAP[0]), BITMAP[1])
    word = F.expr(f"cast((sid & {(1 << bits) - 1}L) div 64 AS int)")
    rows = ids.groupBy(word.alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(sid & 63 AS int))")).alias("bits")
    )
    rows = rows.toArrow()
    found = np.zeros(1 << (bits - 6), np.int64)
    found[rows.column("w").to_numpy()] = rows.column("bits").to_numpy()
    return found


def _sets_of(docs: DataFrame, pairs: DataFrame, ws: Workspace) -> DataFrame:
    """(sid, shingles) of the sets in pairs, from another pass over the texts."""
    ids = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
    seen = Observation()
    ids = ws.save(ids.observe(seen, F.count(F.lit(1)).alias("rows")), "wanted")
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(ids, seen.get.get("rows") or 0))

    def run(batches):
        bits = shared.value
        for batch in batches:
            seen = set()
            for _, _, buf, offsets in blocks(batch.column(0)):
                found = []
                for shingles in shingle_sets(buf, offsets):
                    if len(shingles):
                        sid = set_id(shingles)
                        at = sid & (64 * len(bits) - 1)
                        if sid not in seen and int(bits[at >> 6]) >> (at & 63) & 1:
                            seen.add(sid)
                            found.append((sid, shingles.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary())],
                    ["sid", "shingles"],
                )

    sets = map_arrow(docs.select("text"), run, "sid long, shingles binary")
    # Not written: both joins of the verification read this one shuffle.
    return sets.join(ids, "sid", "left_semi").dropDuplicates(["sid"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets that reach the similarity, with their other columns."""
    names = pairs.columns
    joined = (
        pairs.join(sets.select(F.col("sid").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("sid").alias("b"), F.col("shingles").alias("y")), "b")
        .select(*names, "x", "y")
    )

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                short, long = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(long, short), len(long) - 1)
                both = int((long[at] == short).sum())
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select(names).filter(pa.array(keep, pa.bool_()))

    return map_arrow(joined, run, pairs.schema)


def _alike(an: str, bn: str, abits: str, bbits: str):
    """Whether sizes and sketches of two sets allow the similarity."""
    apart = F.lit(0)
    for k in range(SKETCH_WORDS):
        apart = apart + F.bit_count(F.col(abits)[k].bitwiseXOR(F.col(bbits)[k]))
    both = F.col(an).cast("long") + F.col(bn)
    return _close(an, bn) & ((100 + PERCENT) * apart <= (100 - PERCENT) * both)


def _possible(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs of sets whose sizes and sketches allow the similarity."""
    sets = members.select("sid", "n", "bits").dropDuplicates(["sid"])

    def side(x: str) -> DataFrame:
        return sets.select(F.col("sid").alias(x), F.col("n").alias(f"{x}n"), F.col("bits").alias(f"{x}bits"))

    return pairs.join(side("a"), "a").join(side("b"), "b").where(_alike("an", "bn", "abits", "bbits")).select("a", "b")


def _ordered(pairs: DataFrame) -> DataFrame:
    """Pairs with the smaller first, each once."""
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _close(x: str, y: str):
    small, large = F.least(F.col(x), F.col(y)), F.greatest(F.col(x), F.col(y))
    return 100 * small.cast("long") >= PERCENT * large.cast("long")


def _with_originals(lists: DataFrame) -> DataFrame:
    """Pairs of each set with that of its list that is in most lists; (list, sid, n) given.

    All of it is maxima of partial maxima and joins to one row per list."""
    weight = lists.groupBy("sid").agg(F.count(F.lit(1)).alias("w"))
    best = lists.join(weight, "sid").groupBy("list").agg(F.max(F.struct("w", "sid")).alias("m"))
    return lists.join(best, "list").select(F.col("m.sid").alias("a"), F.col("sid").alias("b"))


def _across(rows: DataFrame) -> DataFrame:
    """Pairs in one list but in different classes, from rows (list, sid, n, bits, root), as far as
    sizes and sketches allow them.

    A list is cut into blocks of about CELL sets; a pair of blocks is one cell of the join. Sketches
    are part of the join's condition, so a cell's pairs are tested where they meet and never listed.
    """
    open_lists = rows.groupBy("list").agg(
        F.count(F.lit(1)).alias("rows"), F.min("root").alias("lowest"), F.max("root").alias("highest")
    )
    open_lists = open_lists.where("lowest != highest").select("list", F.ceil(F.col("rows") / CELL).cast("int").alias("parts"))
    cut = rows.join(open_lists, "list").withColumn("part", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int"))

    def side(x: str, i, j) -> DataFrame:
        own = [F.col(c).alias(f"{x}{short}") for c, short in (("sid", ""), ("n", "n"), ("bits", "bits"), ("root", "r"))]
        return cut.select("list", i.alias("i"), j.alias("j"), *own)

    part, last = F.col("part"), F.col("parts") - 1
    left, right = side("a", part, F.explode(F.sequence(part, last))), side("b", F.explode(F.sequence(F.lit(0), part)), part)
    apart = (F.col("ar") != F.col("br")) & ((F.col("i") != F.col("j")) | (F.col("a") < F.col("b")))
    joined = left.join(right, ["list", "i", "j"]).where(apart & _alike("an", "bn", "abits", "bbits"))
    swap = F.col("a") > F.col("b")
    ends = [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("b", "a"), ("ar", "br"), ("br", "ar"))]
    return joined.select(*ends).distinct()


def _expanded(found: DataFrame, members: DataFrame, crowded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of sets from pairs of groups, and lists of sets (list, sid, n, bits) from lists of groups.

    A pair of groups of at most SMALL * SMALL member pairs is expanded whole; a larger one is a list,
    and so is a group of more than SMALL sets. Lists give pairs of heads to begin with."""
    near = found.where(F.col("kind") == PAIR).select("a", "b").distinct()
    sizes = crowded.select("g", "head", "size")
    one = F.lit(1).cast("long")

    def sized(x: str) -> DataFrame:
        return sizes.select(F.col("g").alias(x), F.col("size").alias(f"{x}s"))

    near = near.join(sized("a"), "a", "left").join(sized("b"), "b", "left")
    product = F.coalesce("as", one) * F.coalesce("bs", one)
    whole, large = near.where(product <= SMALL * SMALL).select("a", "b"), near.where(product > SMALL * SMALL).select("a", "b")
    of = lambda x, y: members.select(F.col("g").alias(x), F.col("sid").alias(y))
    pairs = whole.join(of("a", "x"), "a").join(of("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    heads = members.groupBy("g").agg(F.min("sid").alias("sid"))
    first = lambda x, y: heads.select(F.col("g").alias(x), F.col("sid").alias(y))
    pairs = pairs.union(
        large.join(first("a", "x"), "a").join(first("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    inside = members.join(sizes, "g")
    few = inside.where(F.col("size") <= SMALL)
    pairs = pairs.union(
        few.select("g", F.col("sid").alias("a")).join(few.select("g", F.col("sid").alias("b")), "g").where("a < b").select("a", "b")
    )
    pairs = pairs.union(inside.where(F.col("size") > SMALL).select(F.col("head").alias("a"), F.col("sid").alias("b")))
    name = F.xxhash64("a", "b")
    groups = (
        found.where(F.col("kind") == LIST).select(F.col("a").alias("list"), F.col("b").alias("g")).distinct()
        .union(large.select(name.alias("list"), F.col("a").alias("g")))
        .union(large.select(name.alias("list"), F.col("b").alias("g")))
        .union(sizes.where(F.col("size") > SMALL).select(F.col("g").alias("list"), "g"))
    )
    return pairs, groups.join(members, "g").select("list", "sid", "n", "bits")


def classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", ws: Workspace | None = None
) -> DataFrame:
    """Per row the key, n_shingles, and component_id: the smallest key that links reach."""
    found = classes_with_sets(docs, key, text, ws)
    return found.select(F.col("key").alias(key), "n_shingles", "component_id")


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", ws: Workspace | None = None
) -> DataFrame:
    """The rows without those whose class has a smaller key, all columns as they are.

    Rows that may have to go are told by a bitmap of hashed keys; only these are joined, so most
    texts are not shuffled. Of rows equal in key and set one stays. Rows without a key stay, as
    nothing tells which of them a class is named after."""
    ws = ws or Workspace(docs.sparkSession)
    found = ws.save(classes_with_sets(docs, key, text, ws).where("key is not null"), "classes")
    name = F.xxhash64("key").alias("sid")
    repeated = found.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    doubtful = found.where("key != component_id").select(name).union(repeated.select(name))
    seen = Observation()
    doubtful = ws.save(doubtful.observe(seen, F.count(F.lit(1)).alias("rows")), "doubtful")
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(doubtful, seen.get.get("rows") or 0))
    tag, set_name, kept_key, kept_set = free_names(docs.columns, 4)
    hashed = docs.withColumn(tag, F.xxhash64(F.col(f"`{key}`")))

    def part(wanted: bool):
        def run(batches):
            table = bits.value
            for batch in batches:
                at = batch.column(tag).to_numpy(zero_copy_only=False) & (64 * len(table) - 1)
                hit = (table[at >> 6] >> (at & 63)) & 1 == 1
                hit &= batch.column(key).is_valid().to_numpy(zero_copy_only=False)
                rows = batch.filter(pa.array(hit == wanted))
                if not wanted:
                    yield rows.select([c for c in rows.schema.names if c != tag])
                    continue
                for lo, hi, buf, offsets in blocks(rows.column(text)):
                    ids = [set_id(s) if len(s) else 0 for s in shingle_sets(buf, offsets)]
                    some = rows.slice(lo, hi - lo)
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(ids, pa.int64())], [*some.schema.names, set_name])

        return run

    sure = map_arrow(hashed, part(False), docs.schema)
    unsure = map_arrow(hashed, part(True), hashed.select("*", F.lit(0).cast("long").alias(set_name)).schema)
    kept = found.where("key = component_id").select(
        F.col("key").alias(kept_key), F.coalesce("sid", F.lit(0)).alias(kept_set)
    )
    same = (unsure[f"`{key}`"] == kept[kept_key]) & (unsure[set_name] == kept[kept_set])
    stays = unsure.join(kept, same, "left_semi").dropDuplicates([key, set_name])
    return sure.unionByName(stays.drop(tag, set_name))


def classes_with_sets(docs: DataFrame, key: str, text: str, ws: Workspace | None) -> DataFrame:
    """Per row `key`, `sid`, n_shingles and component_id."""
    ws = ws or Workspace(docs.sparkSession)
    docs = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = max(int(size) // CHUNK_BYTES, 256)
    first = ws.save(_sizes_and_counts(docs, chunks), "sizes")
    rows = first.where(F.col("chunk").isNull()).select("key", "n", "sid")
    counts = first.where(F.col("chunk").isNotNull()).select("chunk", "blob")
    order = _order(ws.save(_frequent(counts), "frequent"))
    found = ws.save(_lists(_prefixes(docs, chunks, order)), "lists")
    members = found.where(F.col("kind") == MEMBER)
    members = members.select(F.col("a").alias("g"), F.col("b").alias("sid"), "n", "bits").dropDuplicates(["g", "sid"])
    members = ws.save(members, "members")
    size = members.groupBy("g").agg(F.min("sid").alias("head"), F.count(F.lit(1)).alias("size"))
    crowded = ws.save(size.where("size > 1"), "crowded")
    pairs, lists = _expanded(found, members, crowded)
    lists = ws.save(lists, "long")
    near = ws.save(_possible(_ordered(pairs.union(_with_originals(lists))), members), "near")
    roots = components(_verified(near, _sets_of(docs, near, ws)), ws)
    # Long lists: pairs across the classes found so far.
    placed = lists.join(roots.withColumnRenamed("node", "sid"), "sid", "left")
    placed = placed.withColumn("root", F.coalesce("root", "sid"))
    across = ws.save(_across(ws.save(placed, "placed")), "across")
    if across.limit(1).count():
        # Links between classes join these; what lies within them is left alone.
        late = _verified(across, _sets_of(docs, across, ws)).select(F.col("ar").alias("a"), F.col("br").alias("b"))
        roots = _joined(roots, components(late, ws))
    return _named(rows, roots)


def _joined(roots: DataFrame, later: DataFrame) -> DataFrame:
    """Roots of nodes after their classes were joined; a class of one may have had no root yet."""
    moved = later.select(F.col("node").alias("root"), F.col("root").alias("to"))
    known = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return known.union(later.join(roots.select("node"), "node", "left_anti"))


def _named(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Classes named by their smallest key. Equal sets meet in partial minima first."""
    sids = rows.where("sid is not null").groupBy("sid").agg(F.min("key").alias("least"))
    sids = sids.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    names = sids.groupBy("root").agg(F.min("least").alias("component_id"))
    named = sids.join(names, "root").select("sid", "component_id")
    joined = rows.join(named, "sid", "left")
    own = F.when(F.col("sid").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return joined.select("key", "sid", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))
