"""The prefix trie of conversations: a node for each distinct sequence of first turns, with counts of every subtree.

Method: padded turn-id matrices. A turn is the MD5 digest of its role and text, a conversation the row of its turns'
digests (its path). Paths are range-partitioned and sorted by Spark, and a task reads its shard in chunks of about CHUNK
turns. In a chunk turns get small ids, and conversations become rows of matrices of BAND columns, padded with -1; longer
conversations go on in the next band, so that padding is bounded by a band per conversation. `np.lexsort` orders the
rows; masks of column changes, OR-accumulated from the left, mark the rows that start a node of each depth; `reduceat`
aggregates every depth over those starts and, from the deepest up, every subtree.

A node that holds the first or the last row of a chunk may go on in the next one: it is open, all others are final. Open
nodes lie on two paths per chunk. Their partial sums are recombined by Spark: sums per node, then each node's own value
is given to one path that it lies on and summed along the paths from below (a window within one path), then over the
paths of a node. So a conversation or first turn of a third of all rows is only cut into more chunks.

Memory: a task holds one chunk (or one longer conversation): some 100 bytes a turn, texts never. The turns' digests of
one conversation meet in one row. Hashes of the members that end in an open node are sequential by nature: their ids
stream through one task in parts of PART ids, in bounded memory.

Defined results: turns are ordered by turn, null first, then by digest; repeated rows are repeated turns; null role or
text is empty; rows without an id belong to no conversation; a table without conversations has no nodes, a conversation
without turns is a member of the root. Ids are whole numbers. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from reviewloom.session import cut_lineage

#: turns (and rows) that a task holds at once; columns of a matrix; ids in one part of a hash
CHUNK, BAND, PART = 400_000, 16, 4096

NODE, OPEN, ENDS = 0, 1, 2
FOUND = pa.schema([
    ("kind", pa.int8()), ("conv", pa.int64()), ("depth", pa.int64()), ("parent", pa.int64()), ("parent_key", pa.binary()),
    ("n", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.binary()),
    ("key", pa.binary()), ("path_no", pa.int64()), ("chars", pa.int64()), ("part", pa.int64()), ("ids", pa.string()),
])
KINDS = {pa.int8(): "byte", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
FOUND_DDL = ", ".join(f"{f.name} {KINDS[f.type]}" for f in FOUND)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_paths(
    conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """id and turns of each conversation: its turns in order, each the digest (key) and the code points of its text."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    at = F.col(f"`{turn}`")
    rows = conversations.select(F.col(f"`{id}`").cast("long").alias("id"), F.struct(
        at.isNotNull().alias("there"), at.alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("key"),
        F.char_length(text).alias("chars"),
    ).alias("turn"))
    grouped = rows.where("id is not null").groupBy("id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return grouped.select("id", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["chars"].alias("chars"))).alias("turns"))


def prefix_trie(paths: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The nodes of the trie over rows of (id, turns) as `turn_paths` gives them, one row per id. Runs jobs when called.

    conv_id: smallest member; depth; parent_conv_id; n_convs: members; n_children; n_leaves: childless nodes in the
    subtree; saved_tokens: the subtree's sum of (members - 1) x code points of a node's last text; ends_sha256: of the
    comma-joined ids of the members that end in the node.
    """
    spark = paths.sparkSession
    rows = cut_lineage(paths.select(
        "id", F.unhex(F.array_join(F.transform("turns", lambda t: t["key"]), "")).alias("path"),
        F.transform("turns", lambda t: t["chars"]).alias("chars"),
    ), "paths")
    turns = rows.agg(F.sum(F.size("chars") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // chunk + 1)
    ordered = rows.repartitionByRange(shards, "path", "id").sortWithinPartitions("path", "id")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        for number, table in enumerate(chunks(batches, chunk)):
            yield from chunk_nodes(table, shard << 32 | number)

    found = cut_lineage(ordered.mapInArrow(grow, FOUND_DDL), "trie")
    shared = open_nodes(found.where(F.col("kind") == OPEN))
    closed = found.where(F.col("kind") == NODE)
    names = shared.select(F.col("key").alias("parent_key"), F.col("conv").alias("parent_conv"))
    inner = closed.where("parent_key is null").withColumn("parent_conv", F.col("parent"))
    below = closed.where("parent_key is not null").join(names, "parent_key")
    top = shared.drop("ends").join(open_ends(found.where(F.col("kind") == ENDS)), "key", "left").join(names, "parent_key", "left")
    columns = ["conv", "depth", "parent_conv", "n", "children", "leaves", "saved", "ends"]
    nodes = inner.select(columns).unionByName(below.select(columns)).unionByName(top.select(columns))
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce(F.lower(F.hex("ends")), F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def open_nodes(rows: DataFrame) -> DataFrame:
    """One row per open node, from its rows of all chunks."""
    per_node = rows.groupBy("key").agg(
        F.min("parent_key").alias("parent_key"), F.min("depth").alias("depth"), F.min("conv").alias("conv"),
        F.sum("n").alias("n"), F.max("chars").alias("chars"), F.sum("children").alias("children"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.min("path_no").alias("first"),
    )
    per_node = cut_lineage(per_node, "open")
    kids = per_node.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("kids"))
    own = per_node.join(kids, "key", "left").withColumn("children", F.col("children") + F.coalesce("kids", F.lit(0)))
    own = own.withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.col("chars"))
    own = own.withColumn("leaves", F.col("leaves") + (F.col("children") == 0).cast("long"))
    own = cut_lineage(own.drop("kids"), "own")
    # each node counts on the first of its paths; along a path everything from the deepest node up is of one subtree
    here = F.col("path_no") == F.col("first")
    steps = rows.select("key", "path_no", "depth").join(own.select("key", "first", "saved", "leaves"), "key")
    below = Window.partitionBy("path_no").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.select("key", *[F.sum(F.when(here, F.col(c)).otherwise(0)).over(below).alias(c) for c in ("saved", "leaves")])
    totals = steps.groupBy("key").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    return cut_lineage(own.drop("saved", "leaves").join(totals, "key").withColumn("ends", F.lit(None).cast("binary")), "shared")


def open_ends(rows: DataFrame) -> DataFrame:
    """key and the hash of the ids that end there, read in the order of chunks and parts."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hasher = None, None
        for batch in batches:
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if key != last:
                    if hasher:
                        yield pa.RecordBatch.from_pylist([{"key": last, "ends": hasher.digest()}])
                    last, hasher = key, hashlib.sha256()
                else:
                    hasher.update(b",")
                hasher.update(ids.encode())
        if hasher:
            yield pa.RecordBatch.from_pylist([{"key": last, "ends": hasher.digest()}])

    parts = rows.select("key", "path_no", "part", "ids").repartition("key").sortWithinPartitions("key", "path_no", "part")
    return parts.select("key", "ids").mapInArrow(digest, "key binary, ends binary")


def chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """The rows in order, in tables of about `limit` turns and rows, one row at least."""
    held: list[pa.RecordBatch] = []
    weight = 0
    for batch in batches:
        sizes = np.cumsum(batch.column("chars").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        at, done = 0, 0
        while at < len(batch):
            to = int(np.searchsorted(sizes, done + limit - weight, "right"))
            to = max(to, at + 1) if not held else to
            if to > at:
                held.append(batch.slice(at, to - at))
                weight += int(sizes[to - 1]) - done
                at, done = to, int(sizes[to - 1])
            if at < len(batch):
                yield pa.Table.from_batches(held)
                held, weight = [], 0
    if held:
        yield pa.Table.from_batches(held)


class Matrix:
    """Rows of turn ids in order, and the starts of the nodes of each depth.

    levels[d] is (at, starts): the sorted places of the rows of at least d turns, and which of these start a node.
    """

    def __init__(self, path: np.ndarray, lengths: np.ndarray, conv: np.ndarray):
        self.ids, self.lengths, self.first = turn_ids(path), lengths, np.cumsum(lengths) - lengths
        n = len(lengths)
        order, group, places = np.arange(n), np.zeros(n, np.int64), np.arange(n)
        self.levels = [(places, np.zeros(1, np.int64))]
        band = 0
        while len(places):
            rows = order[places]
            cells = self.cells(rows, band)
            goes_on = lengths[rows] > band + BAND
            by = np.lexsort((conv[rows], goes_on, *cells.T[::-1], group[places]))
            rows, cells = rows[by], cells[by]
            order[places] = rows
            change = np.ones(cells.shape, bool)
            change[1:] = cells[1:] != cells[:-1]
            change[1:, 0] |= group[places][1:] != group[places][:-1]
            change = np.logical_or.accumulate(change, axis=1)
            group[places] = np.cumsum(change[:, -1])
            for column in range(BAND):
                at = np.flatnonzero(lengths[rows] > band + column)
                if not len(at):
                    break
                self.levels.append((places[at], np.flatnonzero(change[at, column])))
            places = places[lengths[rows] > band + BAND]
            band += BAND
        self.order = order

    def cells(self, rows: np.ndarray, band: int) -> np.ndarray:
        """The ids of turns band .. band + BAND of the rows, -1 beyond their end."""
        column = band + np.arange(BAND)
        there = column[None, :] < self.lengths[rows][:, None]
        out = np.full(there.shape, -1, np.int64)
        out[there] = self.ids[(self.first[rows][:, None] + column[None, :])[there]]
        return out


def turn_ids(path: np.ndarray) -> np.ndarray:
    """A small number for each 16-byte digest, in the order of the digests."""
    words = path.view(">u8").astype(np.uint64).reshape(-1, 2)
    order = np.lexsort((words[:, 1], words[:, 0]))
    new = np.zeros(len(order), np.int64)
    new[1:] = (words[order[1:]] != words[order[:-1]]).any(axis=1)
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def prefix_keys(path: bytes) -> list[bytes]:
    """A digest of each prefix of a path, the empty one first."""
    hasher = hashlib.md5(b"")
    keys = [hasher.digest()]
    for at in range(0, len(path), 16):
        hasher.update(path[at:at + 16])
        keys.append(hasher.digest())
    return keys


def chunk_nodes(table: pa.Table, number: int) -> Iterator[pa.RecordBatch]:
    """The final nodes of a chunk, the partial sums of its open nodes, and the parts of their hashes."""
    table = table.combine_chunks()
    conv = table.column("id").to_numpy().astype(np.int64)
    column = table.column("path").chunk(0)
    path, bounds = raw_binary(column)
    lengths = np.diff(bounds) // 16
    chars = table.column("chars").chunk(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    matrix = Matrix(path, lengths, conv)
    order, levels = matrix.order, matrix.levels
    conv, lengths = conv[order], lengths[order]
    names = [str(c) for c in conv.tolist()]
    depths = len(levels)
    sides = [0, len(order) - 1]
    keys = [prefix_keys(path[bounds[order[s]]:bounds[order[s]] + 16 * lengths[s]].tobytes()) for s in sides]

    size, low, last, up, is_open = [], [], [], [], []
    node_of = np.zeros(len(order), np.int64)
    for depth, (at, starts) in enumerate(levels):
        size.append(np.diff(np.append(starts, len(at))))
        low.append(np.minimum.reduceat(conv[at], starts))
        first = order[at[starts]]
        last.append(chars[matrix.first[first] + depth - 1] if depth else np.zeros(1, np.int64))
        up.append(node_of[at[starts]])
        marks = np.zeros(len(at), np.int64)
        marks[starts] = 1
        node_of[at] = np.cumsum(marks) - 1
        flags = np.zeros(len(starts), bool)
        flags[0] |= depth <= lengths[0]
        flags[-1] |= depth <= lengths[-1]
        is_open.append(flags)

    kids = [np.zeros(len(s), np.int64) for s in size]
    saved = [np.where(o, 0, (s - 1) * c) for o, s, c in zip(is_open, size, last)]
    leaves = [np.zeros(len(s), np.int64) for s in size]
    for depth in range(depths - 1, -1, -1):
        closed = ~is_open[depth]
        leaves[depth][closed & (kids[depth] == 0)] = 1
        if depth:
            runs = np.flatnonzero(np.append(True, up[depth][1:] != up[depth][:-1]))
            to = up[depth][runs]
            kids[depth - 1][to] += np.add.reduceat(closed.astype(np.int64), runs)
            saved[depth - 1][to] += np.add.reduceat(np.where(closed, saved[depth], 0), runs)
            leaves[depth - 1][to] += np.add.reduceat(np.where(closed, leaves[depth], 0), runs)

    parts: list[dict] = []
    out: dict[str, list] = {f.name: [] for f in FOUND}
    for depth, (at, starts) in enumerate(levels):
        ending = np.add.reduceat((lengths[at] == depth).astype(np.int64), starts)
        ends: list[bytes | None] = [None] * len(starts)
        front = 0 if depth <= lengths[0] else -1
        back = len(starts) - 1 if depth <= lengths[-1] else -1
        for node in np.flatnonzero(ending).tolist():
            begin = int(at[starts[node]])
            here = names[begin:begin + int(ending[node])]
            if is_open[depth][node]:
                key = keys[0][depth] if node == front else keys[1][depth]
                for part in range(0, len(here), PART):
                    parts.append({"kind": ENDS, "key": key, "path_no": number, "part": part, "ids": ",".join(here[part:part + PART])})
            else:
                ends[node] = hashlib.sha256(",".join(here).encode()).digest()
        closed = np.flatnonzero(~is_open[depth])
        if len(closed):
            above = up[depth][closed]
            orphan = is_open[depth - 1][above]
            in_front = (above == 0) & (depth - 1 <= lengths[0])
            parent_key = [None if not o else keys[0][depth - 1] if f else keys[1][depth - 1] for o, f in zip(orphan.tolist(), in_front.tolist())]
            yield batch_of(
                kind=np.full(len(closed), NODE), conv=low[depth][closed], depth=np.full(len(closed), depth),
                parent=pa.array(low[depth - 1][above], mask=orphan), parent_key=parent_key, n=size[depth][closed],
                children=kids[depth][closed], leaves=leaves[depth][closed], saved=saved[depth][closed],
                ends=[ends[i] for i in closed.tolist()],
            )
        for side, node in enumerate((front, back)):
            if node < 0:
                continue
            again = side == 1 and node == front  # on both paths: counted on one
            row = {
                "kind": OPEN, "key": keys[side][depth], "parent_key": keys[side][depth - 1] if depth else None,
                "path_no": 2 * number + side, "depth": depth, "conv": int(low[depth][node]), "chars": int(last[depth][node]),
            }
            for name, values in (("n", size), ("children", kids), ("leaves", leaves), ("saved", saved)):
                row[name] = 0 if again else int(values[depth][node])
            parts.append(row)
        if len(parts) > 256:
            yield pa.RecordBatch.from_pylist(parts, FOUND)
            parts = []
    if parts:
        yield pa.RecordBatch.from_pylist(parts, FOUND)


def raw_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values in a row and the n + 1 offsets."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return np.ascontiguousarray(flat[bounds[0]:bounds[-1]]), bounds - bounds[0]


def batch_of(**columns) -> pa.RecordBatch:
    n = len(columns["kind"])
    return pa.RecordBatch.from_arrays([
        pa.nulls(n, f.type) if f.name not in columns else columns[f.name].cast(f.type) if isinstance(columns[f.name], pa.Array)
        else pa.array(columns[f.name], f.type) for f in FOUND
    ], schema=FOUND)
