"""The trie of conversations by their first turns, with sums over subtrees by centroid decomposition.

Every conversation is rebuilt: the first h turns of a base conversation, then its own turns after its
first h. A node is a distinct sequence of first turns; it is named by the smallest conversation that
starts with it, and its depth. Sequences are told apart by two running sums of hashes of (depth, turn),
128 bits in all over 120 bits of each turn's SHA-256; sums can be made in slices, so a conversation of
any length is no single task.

Sums over subtrees. A node's weight is the number of conversations that start with it, so the weight of
its subtree is known from the rows: the turns that its members have from it on. In a component with a top,
the nodes that hold more than half of the component's weight form a path down from the top; its last node
is the centroid. The subtrees below the centroid, and what is left above, each hold at most half, and are
the next components. The totals of the centroid and all below it are added to every node of the path,
and its weight is taken off them. When every node has been a centroid its sums are whole.

A node's conversation also tells its ancestors: the ancestor at a depth is where that conversation is
then. So one lookup by (conversation, depth) tells each node under which child of the centroid it lies. All
components are split at once, level by level, each level written; those of at most `local_weight` are
gathered and finished in numpy, many to a task, by the same steps.

Turns are ordered by (turn, role, text), null turns first, so ties have an order and a repeated row is a
turn of its own. A null role or text is empty. Rows with a null conversation take no part. Only the four
columns are read, whatever the others are called. An empty table has no node, not even the root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillsight.llm.text import map_arrow
from tillsight.operators.ordering import number_placed, place_in_order, running_sums
from tillsight.workspace import Workspace

# A component of at most so many turns is finished in one task.
LOCAL_WEIGHT = 4_096
# Every fifth conversation is a base, and at most eight of its turns are taken over.
BASE_STEP = 5
SHARED_TURNS = 9
NO_ENDS = hashlib.sha256(b"").hexdigest()
VALUES = ("leaves", "saved")
NODE = ("conv_id", "depth")
TOP = ("top_conv", "top_depth")


def _sixty_bits(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("long")


def turns_in_order(conversations: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """Turns with their place in the conversation, from 1, and the conversations with their lengths."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("c"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where("c is not null")
    order = ["c", F.asc_nulls_first("turn"), "role", "text"]
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    placed = place_in_order(rows, order).select(
        "c", "_at", F.octet_length("text").cast("long").alias("bytes"), digest.alias("digest")
    )
    placed = placed.select("c", "_at", "bytes", _sixty_bits(F.col("digest"), 1).alias("a"), _sixty_bits(F.col("digest"), 16).alias("b"))
    numbered = number_placed(ws.save(placed, "turns"), [])
    convs = ws.save(numbered.groupBy("c").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n")), "convs")
    turns = numbered.join(convs.select("c", "first"), "c").withColumn("pos", F.col("seq") - F.col("first") + 1)
    return turns.select("c", "pos", "bytes", "a", "b"), convs.select("c", "n")


def rebuilt(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns with their depth, and every conversation with its rebuilt length."""
    shared = (F.crc32(F.col("c").cast("string")) % SHARED_TURNS).cast("long")
    known = convs.withColumns({"base": F.col("c") - F.col("c") % BASE_STEP, "h": shared})
    bases = convs.select(F.col("c").alias("base"), F.col("n").alias("n_base"))
    plan = known.join(bases, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("n_base", F.lit(0).cast("long")))
    )
    plan = plan.withColumn("size", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    own = (
        turns.join(plan.select("c", "h", "taken", "size"), "c")
        .where(F.col("pos") > F.col("h"))
        .select("c", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "size", "bytes", "a", "b")
    )
    # A base has few conversations and few turns that they can take over.
    first = turns.where(F.col("pos") < SHARED_TURNS).withColumnRenamed("c", "base")
    taken = (
        first.join(plan.select("base", "c", "h", "size"), "base")
        .where(F.col("pos") <= F.col("h"))
        .select("c", F.col("pos").alias("depth"), "size", "bytes", "a", "b")
    )
    return own.unionByName(taken), plan.select("c", "size")


def keyed(rows: DataFrame, ws: Workspace) -> DataFrame:
    """Rows with the key of their node (x, y at a depth) and of its parent."""
    terms = {f"t{k}": F.xxhash64(F.lit(k), "depth", "a", "b").cast("decimal(20,0)") for k in (1, 2)}
    slim = rows.withColumns(terms).drop("a", "b")
    summed = running_sums(slim, ["c"], F.col("depth"), list(terms), ws)
    return summed.select(
        "c",
        "depth",
        "size",
        "bytes",
        *[(F.col(f"before_t{k}") + F.col(f"t{k}")).cast("decimal(38,0)").alias(n) for k, n in ((1, "x"), (2, "y"))],
        *[F.col(f"before_t{k}").cast("decimal(38,0)").alias(n) for k, n in ((1, "up_x"), (2, "up_y"))],
    )


def nodes_of(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Nodes with key, parent's key, name, members, and the weight of their subtree."""
    zero = F.lit(0).cast("decimal(38,0)")
    grouped = rows.groupBy("depth", "x", "y").agg(
        F.min("c").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("size") - F.col("depth") + 1).alias("weight"),
        F.min("bytes").alias("bytes"),
        F.min("up_x").alias("up_x"),
        F.min("up_y").alias("up_y"),
    )
    root = sizes.agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("size") + 1).alias("weight")
    ).where("n_convs > 0")
    root = root.select(
        F.lit(0).cast("long").alias("depth"), zero.alias("x"), zero.alias("y"), "conv_id", "n_convs", "weight",
        F.lit(0).cast("long").alias("bytes"), zero.alias("up_x"), zero.alias("up_y"),
    )
    return grouped.unionByName(root)


def linked(nodes: DataFrame) -> DataFrame:
    """Nodes with their parents' names and the number of their children."""
    above = [F.col("depth") - 1, F.col("up_x"), F.col("up_y")]
    key = ["depth", "x", "y"]
    children = (
        nodes.where("depth > 0")
        .groupBy(*[c.alias(n) for c, n in zip(above, key)])
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("up_x"), F.col("y").alias("up_y"), F.col("conv_id").alias("parent_conv_id")
    )
    return (
        nodes.join(children, key, "left")
        .fillna(0, ["n_children"])
        .join(parents, ["depth", "up_x", "up_y"], "left")
        .withColumn("leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
        .drop("up_x", "up_y", "bytes")
    )


def split_components(parts: DataFrame, lineage: DataFrame, ws: Workspace) -> tuple[DataFrame, bool]:
    """One level: every component is split at its centroid, which is done; whether a large one is left."""
    path = F.col("weight") * 2 > F.col("total")
    centroids = (
        parts.where(path)
        .groupBy(*TOP)
        .agg(F.max(F.struct("depth", "conv_id")).alias("found"))
        .select(*TOP, F.col("found.depth").alias("c_depth"), F.col("found.conv_id").alias("c_conv"))
    )
    marked = parts.join(centroids, list(TOP)).withColumn("path", path)
    # Where the node's conversation is one turn below the centroid's depth, and whose child that is.
    asked = F.when(~F.col("path") & (F.col("depth") > F.col("c_depth")), F.col("c_depth") + 1)
    here = lineage.select(
        F.col("c").alias("conv_id"), F.col("depth").alias("asked"), F.col("owner").alias("branch"), F.col("parent_conv_id").alias("fork")
    )
    marked = marked.withColumn("asked", asked).join(here, ["conv_id", "asked"], "left")
    below = F.coalesce(F.col("fork") == F.col("c_conv"), F.lit(False))
    done = (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
    marked = ws.save(
        marked.withColumns({"below": below, "done": done})
        .withColumns(
            {
                "new_conv": F.when(F.col("below"), F.col("branch")).otherwise(F.col("top_conv")),
                "new_depth": F.when(F.col("below"), F.col("asked")).otherwise(F.col("top_depth")),
            }
        )
        .drop("asked", "branch", "fork", "c_conv", "c_depth", "total"),
        "marked",
    )
    sums = [F.sum("n_convs").alias("total"), *[F.sum(v).alias(f"sum_{v}") for v in VALUES]]
    totals = ws.save(marked.groupBy(*TOP, "new_conv", "new_depth", "below", "done").agg(*sums), "totals")
    of_centroid = (
        totals.where("below or done")
        .groupBy(*TOP)
        .agg(F.sum("total").alias("off"), *[F.sum(f"sum_{v}").alias(f"add_{v}") for v in VALUES])
    )
    left = totals.where("not done").select("new_conv", "new_depth", "total")
    moved = (
        marked.join(of_centroid, list(TOP))
        .join(left, ["new_conv", "new_depth"], "left")
        .withColumns({f"acc_{v}": F.col(f"acc_{v}") + F.when(F.col("path"), F.col(f"add_{v}")).otherwise(0) for v in VALUES})
        .withColumn("weight", F.col("weight") - F.when(F.col("path"), F.col("off")).otherwise(0))
        .withColumn("total", F.when(F.col("done"), 0).otherwise(F.col("total")))
        .drop(*TOP, "path", "below", "off", *[f"add_{v}" for v in VALUES])
        .withColumnsRenamed({"new_conv": "top_conv", "new_depth": "top_depth"})
    )
    return moved


def finish_block(top: np.ndarray, conv, depth, parent, weight, values, acc) -> np.ndarray:
    """Sums over subtrees in whole components at once; `top` numbers them. By the same steps as above."""
    n = len(conv)
    order = np.lexsort((conv, depth, top))
    names, code = np.unique(np.concatenate([conv, parent]), return_inverse=True)
    mine, above = code[:n], code[n:]
    _, level = np.unique(depth, return_inverse=True)
    base, levels = len(names), int(level.max(initial=0)) + 2
    key = (top * levels + level) * base + mine
    sorted_key = key[order]
    wanted = (top * levels + level - 1) * base + above
    at = np.minimum(np.searchsorted(sorted_key, wanted), n - 1)
    up = order[at]
    found = (sorted_key[at] == wanted) & (level > 0) & (depth[up] == depth - 1)
    up = np.where(found, up, np.arange(n))
    label = np.arange(n)  # the top of each node's component
    firsts = np.flatnonzero(~found)
    by_top = np.zeros(int(top.max(initial=-1)) + 1, dtype=np.int64)
    by_top[top[firsts]] = firsts
    label = by_top[top]
    weight, acc = weight.copy(), acc.copy()
    centroid = np.zeros(n, dtype=np.int64)
    totals = np.zeros_like(acc)
    open_ = order[np.argsort(depth[order], kind="stable")]
    while len(open_):
        component = label[open_]
        path = 2 * weight[open_] > weight[component]
        on_path = open_[path]
        centroid[label[on_path]] = on_path  # the deepest, as nodes go by depth
        c = centroid[component]
        stop = (open_ == component) | (up[open_] == c) | (open_ == c)
        jump = np.arange(n)
        jump[open_] = np.where(stop, open_, up[open_])
        while True:
            further = jump[jump[open_]]
            if (further == jump[open_]).all():
                break
            jump[open_] = further
        part = (further != component) | (open_ == c)
        totals[component] = 0
        np.add.at(totals, component[part], values[open_[part]])
        acc[on_path] += totals[label[on_path]]
        weight[on_path] -= weight[c[path]]
        label[open_] = further
        open_ = open_[open_ != c]
    return acc


def finished(parts: DataFrame) -> DataFrame:
    """Sums over subtrees of nodes in components of bounded size."""
    names = [*TOP, *NODE, "parent_conv_id", "weight", *VALUES, *[f"acc_{v}" for v in VALUES]]
    rows = parts.select(*names).fillna(0, ["parent_conv_id"])
    rows = rows.repartition(*TOP).sortWithinPartitions(*TOP, "depth")

    def block(batch):
        column = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in names}
        new = np.ones(batch.num_rows, dtype=bool)
        new[1:] = (column["top_conv"][1:] != column["top_conv"][:-1]) | (column["top_depth"][1:] != column["top_depth"][:-1])
        values, acc = (np.stack([column[p + v] for v in VALUES], axis=1) for p in ("", "acc_"))
        sums = finish_block(
            np.cumsum(new) - 1, column["conv_id"], column["depth"], column["parent_conv_id"], column["weight"], values, acc
        )
        return pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("depth"), pa.array(sums[:, 0]), pa.array(sums[:, 1])], [*NODE, *VALUES]
        )

    def run(batches):
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if batch.num_rows == 0:
                continue
            tops = [batch.column(name).to_numpy(zero_copy_only=False) for name in TOP]
            same = np.flatnonzero((tops[0] == tops[0][-1]) & (tops[1] == tops[1][-1]))
            # The last component may go on in the next batch.
            if same[0]:
                yield block(batch.slice(0, int(same[0])))
            held = batch.slice(int(same[0]))
        if held is not None:
            yield block(held)

    return map_arrow(rows, run, ", ".join(f"{name} long" for name in (*NODE, *VALUES)))


def subtree_sums(nodes: DataFrame, total: int, lineage: DataFrame, ws: Workspace, local_weight: int) -> DataFrame:
    """Sums of the values over each node's subtree; the whole trie weighs `total`."""
    start = nodes.select(
        *NODE, "parent_conv_id", "n_convs", "weight", *VALUES, *[F.lit(0).cast("long").alias(f"acc_{v}") for v in VALUES]
    )
    parts = start.withColumns(
        {"top_conv": F.lit(0).cast("long"), "top_depth": F.lit(0).cast("long"), "total": F.lit(total).cast("long"), "done": F.lit(False)}
    )
    small = F.col("total") <= local_weight
    ready, ended = [parts.where(small)], []
    largest = total
    while largest > local_weight:
        seen = Observation()
        moved = split_components(parts.where(~small & ~F.col("done")), lineage, ws)
        parts = ws.save(moved.observe(seen, F.max("total").alias("largest")), "parts")
        largest = seen.get.get("largest") or 0
        ready.append(parts.where(small & ~F.col("done")))
        ended.append(parts.where("done").select(*NODE, *[F.col(f"acc_{v}").alias(v) for v in VALUES]))
    left = ready[0]
    for more in ready[1:]:
        left = left.unionByName(more)
    sums = finished(left)
    for more in ended:
        sums = sums.unionByName(more)
    return sums


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node, in order and comma-joined.

    Ids are first joined in pieces of bounded size; the digest then streams over a node's pieces.
    """
    ids = F.sort_array(F.collect_list("c"))
    pieces = ends.groupBy(*NODE, F.shiftright("c", 12).alias("piece")).agg(
        F.array_join(F.transform(ids, lambda c: c.cast("string")), ",").alias("ids")
    )
    pieces = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece")

    def run(batches):
        node, digest = None, None
        for batch in batches:
            made = []
            columns = [batch.column(name).to_pylist() for name in (*NODE, "ids")]
            for conv, depth, ids in zip(*columns):
                if (conv, depth) == node:
                    digest.update(b",")
                else:
                    if node:
                        made.append((*node, digest.hexdigest()))
                    node, digest = (conv, depth), hashlib.sha256()
                digest.update(ids.encode())
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], [*NODE, "ends_sha256"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, digest.hexdigest())], [*NODE, "ends_sha256"])

    return map_arrow(pieces, run, "conv_id long, depth long, ends_sha256 string")


def trie(conversations: DataFrame, ws: Workspace | None = None, local_weight: int = LOCAL_WEIGHT) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    ws = ws or Workspace(conversations.sparkSession)
    turns, convs = turns_in_order(conversations, ws)
    rows, sizes = rebuilt(turns, convs)
    sizes = ws.save(sizes, "sizes")
    rows = ws.save(keyed(rows, ws), "rows")
    nodes = ws.save(linked(nodes_of(rows, sizes)), "nodes")
    names = nodes.select("depth", "x", "y", F.col("conv_id").alias("owner"), "parent_conv_id")
    lineage = ws.save(
        rows.select("c", "depth", "size", "x", "y").join(names, ["depth", "x", "y"]).select("c", "depth", "size", "owner", "parent_conv_id"),
        "lineage",
    )
    root = nodes.where("depth = 0").select("conv_id", "weight").first() or (None, 0)
    sums = subtree_sums(nodes, root[1], lineage, ws, local_weight)
    ended = lineage.where(F.col("depth") == F.col("size")).select(F.col("owner").alias("conv_id"), "depth", "c")
    turnless = sizes.where("size = 0").select(F.lit(root[0]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), "c")
    ends = end_digests(ended.unionByName(turnless))
    return (
        nodes.select(*NODE, "parent_conv_id", "n_convs", "n_children")
        .join(sums, list(NODE))
        .join(ends, list(NODE), "left")
        .select(
            *NODE,
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
