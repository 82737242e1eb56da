"""Near duplicates: exact Jaccard join of word n-gram sets, size-aware, heavy and light apart.

Method. Two sets are linked if 100 * |a & b| >= percent * |a | b|. Sets of at most `boundary` shingles are
light: for each size that a light partner can have, they enumerate all subsets of the size of the overlap
that is needed; equal subsets are links, without a check. Larger sets are heavy: their shingles go to
inverted lists, and lists are scanned. The boundary is the size from which the subsets of a set cost more
than its list entries (`boundary`); sets just below it also go to the lists, so no pair falls in between.

Heavy part, all exact:
1. One pass over the texts makes the sets and sends packed list entries to the owners of the shingles. A
   shingle that occurs twice in a piece of texts is sent once for the piece, so a list has one entry per piece
   at most, however many documents hold the shingle.
2. Owners return which shingles lie in more than one document, and in how many. A document with less than
   `percent` of its shingles shared has no partner; that settles nearly all documents.
3. Documents with equal sets are one from here on. Each remaining set takes its rarest shingles, as many as a
   partner can't avoid (prefix filter); sets that meet in such a list are candidates of one group.
4. A group is cut by size (partners differ by a factor 100/percent at most) and then by hash into blocks of
   about BLOCK sets. Each pair of blocks that can hold links is one small task that counts all overlaps in a
   matrix product and returns only a spanning forest of the links.
Components of these links are the classes. Shingles and sets are 64-bit digests, of which lists carry 48 bits: a chance
collision of two shingles of a pair of texts needs some 10^14 / (words of one x words of the other) pairs.

Defined results: null texts and texts without words have no shingles, no links and are their own class; with
fewer words than `size` the whole sequence is one shingle; rows with the same id are one node with the links
of all their texts (texts without words aside); rows without an id have no links and a null class; empty tables give empty results; other
columns don't matter. Texts are looked at whole.

Recovery: intermediate rows are tables in the shared folder. Pieces of texts are numbered by partition and
position, so rows must come in the same order when a task runs again (true for files and sorted rows).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewloom.llm.components import components, runs
from reviewloom.llm.shipping import ship
from reviewloom.llm.urls import OTHER_BASE, filled
from reviewloom.llm.words import Words, mix, pieces, text_digests
from reviewloom.session import cut_lineage

#: words of a shingle, and the least similarity in hundredths
SIZE, PERCENT = 5, 80
#: relative costs of a subset key, a list entry and handling one heavy set
COST_SUBSET, COST_ENTRY, COST_SET = 1.0, 0.3, 8.0
#: list entries of one owner, and sets of a block
OWNED, BLOCK = 2_000_000, 384

#: bits of the filter of ids that one_of_each broadcasts (8 MB)
MAYBE_BITS = 1 << 26

#: lists know shingles by the upper 48 bits of their digests
SHORT = np.uint64(16)
MANY = 0xFFFF  # stands for "several documents of the piece"


def least_partner(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def overlap_needed(a: int, b: int, percent: int) -> int:
    """The least |a & b| of linked sets of these sizes: 100 o >= percent (a + b - o)."""
    return -(-percent * (a + b) // (100 + percent))


def partner_sizes(n: int, percent: int, most: int) -> list[tuple[int, int]]:
    """(size, overlap needed) of light partners."""
    sizes = range(least_partner(n, percent), min(most, 100 * n // percent) + 1)
    return [(m, o) for m in sizes if (o := overlap_needed(n, m, percent)) <= min(n, m)]


def boundary(percent: int) -> int:
    """The largest light size: beyond it enumerating subsets costs more than list entries."""
    n = 0
    while sum(comb(n + 1, o) for _, o in partner_sizes(n + 1, percent, 2 * n + 2)) * COST_SUBSET <= (n + 1) * COST_ENTRY + COST_SET:
        n += 1
    return n


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of every text."""
    digests = words.digests()
    rolled = digests[: max(0, len(digests) - size + 1)].copy()
    for j in range(1, size):
        rolled = mix(rolled) + digests[j:j + len(rolled)]
    rolled = mix(rolled)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            h = np.uint64(b - a)
            for d in digests[a:b]:
                h = mix(np.array([h], np.uint64))[0] ^ d
            out.append(mix(np.array([h], np.uint64) + np.uint64(1)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


_ENTRY = (
    "target int, kind int, chunk long, id {id}, n long, f1 long, f2 long, spot int, h binary, i binary, c binary"
)


def _cells(length: int, **values) -> dict:
    """Columns of `length` rows of _ENTRY (but id) with nulls where nothing is given."""
    kinds = dict(target=pa.int32(), kind=pa.int32(), chunk=pa.int64(), n=pa.int64(), f1=pa.int64(), f2=pa.int64(),
                 spot=pa.int32(), h=pa.binary(), i=pa.binary(), c=pa.binary())
    return {k: pa.array(values[k], t) if k in values else pa.nulls(length, t) for k, t in kinds.items()}


def _batch(cells: dict, ids: pa.Array) -> pa.RecordBatch:
    names = ["target", "kind", "chunk", "id", "n", "f1", "f2", "spot", "h", "i", "c"]
    return pa.RecordBatch.from_arrays([ids if k == "id" else cells[k] for k in names], names)


def _packed(h: np.ndarray) -> bytes:
    """The upper 48 bits of digests that were shifted down by 16, six bytes each."""
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(np.uint64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_entries(rows: DataFrame, size: int, percent: int, light: int, owners: int) -> DataFrame:
    """Pass 1: one row per document (kind 2), packed list entries for owners (kind 0), entries of shingles
    that are known to be shared inside the piece (kind 1)."""
    first_heavy = least_partner(light + 1, percent)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for piece in pieces(batches, "text"):
            for at in range(0, len(piece), MANY):
                yield from one(piece.slice(at, MANY), chunk)
                chunk += 1

    def one(piece: pa.RecordBatch, chunk: int) -> Iterator[pa.RecordBatch]:
        sets = shingle_sets(Words(piece.column("text"), "blank"), size)
        n = np.array([len(s) for s in sets])
        home = chunk % owners
        cells = _cells(
            len(sets), target=np.full(len(sets), home), kind=np.full(len(sets), 2), chunk=np.full(len(sets), chunk),
            n=n, f1=[int(_signed(mix(s).sum(keepdims=True))[0]) for s in sets],
            f2=[int(_signed(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True))[0]) for s in sets],
            spot=np.arange(len(sets)), h=[s.tobytes() if len(s) <= light else None for s in sets],
        )
        yield _batch(cells, piece.column("id"))
        usable = (n >= first_heavy) & np.asarray(piece.column("id").is_valid())
        if not usable.any():
            return
        none = pa.nulls(1, piece.column("id").type)
        h = np.concatenate([s for s, u in zip(sets, usable) if u])
        spot = np.repeat(np.flatnonzero(usable), n[usable]).astype(np.uint16)
        order = np.argsort(h)
        h, spot = h[order], spot[order]
        new = np.concatenate(([True], h[1:] != h[:-1]))
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(h)))
        known = np.repeat(count > 1, count)
        if known.any():
            yield _batch(_cells(1, target=[home], kind=[1], chunk=[chunk], h=[_packed(h[known] >> SHORT)], i=[spot[known].tobytes()]), none)
        sent, where = h[begin], np.where(count > 1, MANY, spot[begin]).astype(np.uint16)
        owner = ((sent >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)  # rises with the shingle
        cut = np.concatenate(([0], np.flatnonzero(owner[1:] != owner[:-1]) + 1, [len(owner)]))
        parts = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
        yield _batch(
            _cells(
                len(parts), target=owner[cut[:-1]].astype(np.int64), kind=np.zeros(len(parts), np.int64),
                chunk=np.full(len(parts), chunk), h=[_packed(sent[a:b] >> SHORT) for a, b in parts],
                i=[where[a:b].tobytes() for a, b in parts],
                c=[count[a:b][where[a:b] == MANY].astype(np.uint32).tobytes() for a, b in parts],
            ),
            pa.nulls(len(parts), piece.column("id").type),
        )

    return rows.mapInArrow(make, _ENTRY.format(id=dict(rows.dtypes)["id"]))


def scan_lists(entries: DataFrame) -> DataFrame:
    """Owners: the entries of shared shingles go back to their pieces, with the number of documents."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "target"):
            kind = np.asarray(table.column("kind"))
            for batch in table.filter(pa.array(kind != 0)).combine_chunks().to_batches():
                yield batch
            lists = table.filter(pa.array(kind == 0))
            if not len(lists):
                continue
            texts = [_unpacked(x) for x in lists.column("h").to_pylist()]
            spots = [np.frombuffer(x, np.uint16) for x in lists.column("i").to_pylist()]
            size = [len(x) for x in texts]
            h, spot = np.concatenate(texts), np.concatenate(spots)
            count = np.ones(len(h), np.uint32)
            count[spot == MANY] = np.concatenate([np.frombuffer(x, np.uint32) for x in lists.column("c").to_pylist()])
            order = np.argsort(h)
            new = np.concatenate(([True], h[order][1:] != h[order][:-1]))
            total = np.add.reduceat(count[order].astype(np.int64), np.flatnonzero(new))
            df = np.empty(len(h), np.uint32)
            df[order] = np.minimum(np.repeat(total, np.diff(np.append(np.flatnonzero(new), len(h)))), 2**32 - 1)
            shared = df > 1
            cut = np.concatenate(([0], np.cumsum(size)))
            chunks = lists.column("chunk").to_pylist()
            out = []
            for chunk, a, b in zip(chunks, cut[:-1].tolist(), cut[1:].tolist()):
                keep = shared[a:b]
                if keep.any():
                    out.append((chunk, _packed(h[a:b][keep]), spot[a:b][keep].tobytes(), df[a:b][keep].tobytes()))
            if out:
                chunk, hs, spots, dfs = zip(*out)
                cells = _cells(len(out), kind=np.zeros(len(out), np.int64), chunk=chunk, h=hs, i=spots, c=dfs)
                yield _batch(cells, pa.nulls(len(out), table.column("id").type))

    return entries.mapInArrow(scan, entries.schema)


def settle(replies: DataFrame, percent: int, light: int) -> DataFrame:
    """Pieces: one row per document. `items` are all shingles of a light set, else the shared ones of a set that
    can have partners; `prefix` are its rarest shingles, of which a partner must hold one."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "chunk"):
            kind = np.asarray(table.column("kind"))
            part = {k: table.filter(pa.array(kind == k)) for k in (0, 1, 2)}
            docs = part[2]
            if not len(docs):
                continue
            read = lambda k, c, t: np.concatenate([np.zeros(0, t), *(np.frombuffer(x, t) if t != np.uint64 else _unpacked(x) for x in part[k].column(c).to_pylist())])
            h, spot, df = read(0, "h", np.uint64), read(0, "i", np.uint16), read(0, "c", np.uint32)
            inside, inside_spot = read(1, "h", np.uint64), read(1, "i", np.uint16)
            several = spot == MANY
            if len(inside):
                by = np.argsort(h[several])
                table_h, table_df = h[several][by], df[several][by]
                h = np.concatenate([h[~several], inside])
                spot = np.concatenate([spot[~several], inside_spot])
                df = np.concatenate([df[~several], table_df[np.searchsorted(table_h, inside)]])
            order = np.lexsort((h, df, spot))
            h, spot = h[order], spot[order].astype(np.int64)
            places = np.asarray(docs.column("spot")).astype(np.int64)
            n = np.asarray(docs.column("n"))
            begin, end = np.searchsorted(spot, places), np.searchsorted(spot, places, "right")
            shared = end - begin
            alive = (shared * 100 >= percent * n) & (n > light)
            heavy = (shared * 100 >= percent * n) & (shared > 0)
            took = n - -(-percent * n // 100) + 1 - (n - shared)  # rarest shared shingles of the prefix
            items, prefix = [], []
            for small, a, b, k, whole, ok in zip(docs.column("h").to_pylist(), begin.tolist(), end.tolist(), took.tolist(), alive.tolist(), heavy.tolist()):
                items.append(_packed(np.sort(h[a:b])) if whole else small)
                prefix.append(_signed(h[a:a + k]) if ok else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *(docs.column(c).combine_chunks() for c in ("id", "n", "f1", "f2")),
                    pa.array(items, pa.binary()), pa.array(prefix, pa.list_(pa.int64())),
                ],
                ["id", "n", "f1", "f2", "items", "prefix"],
            )

    kind = dict(replies.dtypes)["id"]
    return replies.mapInArrow(judge, f"id {kind}, n long, f1 long, f2 long, items binary, prefix array<long>")


def light_links(sets: DataFrame, light: int, percent: int) -> DataFrame:
    """Links between sets of at most `light` shingles: equal subsets of the size of the overlap needed.

    Under the key of two sizes all members of the smaller size are linked with each other and with those of
    the larger one, so a star around one of the smaller size holds the class; without one there is no link.
    """
    def enumerate_subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.asarray(batch.column("n"))
            for m in np.unique(n).tolist():
                rows = np.flatnonzero(n == m)
                values = mix(np.frombuffer(b"".join(batch.column("items").take(pa.array(rows)).to_pylist()), np.uint64).reshape(-1, m))
                for other, need in partner_sizes(m, percent, light):
                    left_out = np.array(list(combinations(range(m), m - need)), np.int64).reshape(comb(m, need), m - need)
                    sums = values.sum(axis=1)[:, None] - values[:, left_out].sum(axis=2, dtype=np.uint64)
                    salt = np.uint64((min(m, other) * 1000 + max(m, other)) * 1000 + need)
                    keys = mix(mix(sums) + salt)
                    owner = np.repeat(rows, left_out.shape[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_signed(keys.reshape(-1))), pa.array(np.full(len(owner), m <= other)), batch.column("id").take(pa.array(owner))],
                        ["key", "smaller", "id"],
                    )

    small = sets.where((F.col("n") > 0) & (F.col("n") <= light))
    kind = dict(sets.dtypes)["id"]
    keys = cut_lineage(small.select("id", "n", "items").mapInArrow(enumerate_subsets, f"key long, smaller boolean, id {kind}").distinct(), "subsets")
    stars = keys.groupBy("key").agg(F.min(F.when(F.col("smaller"), F.col("id"))).alias("b"), F.count(F.lit(1)).alias("rows")).where("rows > 1 and b is not null")
    return keys.join(stars, "key").where("id <> b").select(F.col("id").alias("a"), "b").distinct()


def heavy_links(sets: DataFrame, light: int, percent: int) -> DataFrame:
    """Links between sets that meet in the inverted list of a rare shingle."""
    entries = cut_lineage(sets.where(F.col("prefix").isNotNull()).select("id", F.explode("prefix").alias("h")), "lists")
    stars = entries.groupBy("h").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    met = entries.join(stars, "h").where("id <> b").select(F.col("id").alias("a"), "b")
    groups = components(met)
    ratio = float(np.log(100 / percent))
    member = sets.join(groups.withColumnRenamed("node", "id"), "id").select(
        "id", "n", "items", F.col("component").alias("grp"), F.floor(F.log("n") / ratio + 1e-9).cast("int").alias("band")
    )
    member = cut_lineage(member, "members")
    cuts = member.groupBy("grp", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("k"))
    near = cuts.select("grp", F.explode(F.array([F.col("band") + d for d in (-1, 0, 1)])).alias("band"), F.col("band").alias("at"), "k")
    cut = cuts.join(near.groupBy("grp", "band").agg(
        *[F.coalesce(F.max(F.when(F.col("at") == F.col("band") + d, F.col("k"))), F.lit(0)).alias(c) for d, c in ((-1, "k_down"), (1, "k_up"))]
    ), ["grp", "band"])
    spread = member.join(cut, ["grp", "band"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    indexes = lambda k: F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>"))
    own, band = F.col("own"), F.col("band")
    task = lambda b, i, c, j, left: F.struct(b.alias("b"), i.alias("i"), c.alias("c"), j.alias("j"), F.lit(left).alias("left"))
    tasks = F.concat(
        # the same band: pairs of blocks (i, j), i <= j; next band: (this, next)
        F.transform(F.filter(indexes(F.col("k")), lambda j: j >= own), lambda j: task(band, own, band, j, True)),
        F.transform(F.filter(indexes(F.col("k")), lambda j: j < own), lambda j: task(band, j, band, own, False)),
        F.transform(indexes(F.col("k_up")), lambda j: task(band, own, band + 1, j, True)),
        F.transform(indexes(F.col("k_down")), lambda j: task(band - 1, j, band, own, False)),
    )
    spread = spread.select("grp", "id", "n", "items", F.explode(tasks).alias("t")).select("grp", "t.*", "id", "n", "items")
    spread = spread.repartition("grp", "b", "i", "c", "j").sortWithinPartitions("grp", "b", "i", "c", "j")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "grp", "b", "i", "c", "j"):
            if len(table) < 2:
                continue
            size = np.asarray(table.column("n"))
            sets = [
                _unpacked(x) if n > light else np.frombuffer(x, np.uint64) >> SHORT
                for x, n in zip(table.column("items").to_pylist(), size.tolist())
            ]
            a, b = linked_rows(sets, size, np.asarray(table.column("left")), percent)
            if len(a):
                ids = table.column("id").combine_chunks()
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b))], ["a", "b"])

    kind = dict(sets.dtypes)["id"]
    return spread.mapInArrow(verify, f"a {kind}, b {kind}")


def linked_rows(sets: list[np.ndarray], n: np.ndarray, left: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between left and right rows (or among the left ones, if all are left)."""
    rows = np.flatnonzero(left)
    cols = rows if left.all() else np.flatnonzero(~left)
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    met = times[at] > 1
    at, owner = np.unique(at[met], return_inverse=True)[1], owner[met]
    both = np.zeros((len(rows), len(cols)), np.float32)
    place = np.full((2, len(sets)), -1)
    place[0, rows], place[1, cols] = np.arange(len(rows)), np.arange(len(cols))
    width = 4096
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    for begin in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        use = slice(*np.searchsorted(at, [begin, begin + width]))
        grids = []
        for side, size in ((0, len(rows)), (1, len(cols))):
            grid = np.zeros((size, width), np.float32)
            p = place[side, owner[use]]
            grid[p[p >= 0], at[use][p >= 0] - begin] = 1
            grids.append(grid)
        both += grids[0] @ grids[1].T
    union = n[rows][:, None] + n[cols][None, :] - both
    link = 100 * both >= percent * union
    # labels fall to the smallest row reachable
    label = np.arange(len(sets))
    while True:
        low = np.minimum(label[rows], np.where(link, label[cols][None, :], len(sets)).min(axis=1))
        after = label.copy()
        after[rows] = low
        after[cols] = np.minimum(after[cols], np.where(link, after[rows][:, None], len(sets)).min(axis=0))
        if (after == label).all():
            break
        label = after
    a = np.flatnonzero(label != np.arange(len(sets)))
    return a, label[a]


def near_duplicates(
    docs: DataFrame, text: str = "text", id: str = "doc_id", size: int = SIZE, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row (see above). Runs jobs when called."""
    spark = docs.sparkSession
    light = boundary(percent)
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    owners = max(4 * width, int(chars // (6 * OWNED)) + 1)
    entries = list_entries(rows, size, percent, light, owners)
    replies = scan_lists(entries.repartition("target").sortWithinPartitions("target"))
    settled = settle(replies.repartition("chunk").sortWithinPartitions("chunk"), percent, light)
    settled = cut_lineage(settled, "sets")

    usable = settled.where(F.col("id").isNotNull() & (F.col("n") > 0))
    twins = usable.groupBy("n", "f1", "f2").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("rows"))
    twins = cut_lineage(twins.where("rows > 1").drop("rows"), "twins")
    # one row of each distinct set, found by keys that no group of copies shares
    firsts = usable.groupBy("n", "f1", "f2").agg(F.min("id").alias("id"))
    kept = usable.where("items is not null or prefix is not null").join(firsts, ["id", "n", "f1", "f2"])
    kept = cut_lineage(kept.dropDuplicates(["id", "n", "f1", "f2"]), "distinct")
    own = usable.join(twins, ["n", "f1", "f2"], "left").withColumn("b", F.coalesce("b", "id"))
    links = heavy_links(kept, light, percent).unionByName(light_links(kept, light, percent))
    # an id with several texts holds their classes together
    several = own.groupBy("id").agg(F.min("b").alias("m"), F.max("b").alias("x")).where("m <> x").select("id", "m")
    same = own.join(several, "id").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    classes = components(links.unionByName(same))
    nodes = settled.select("id", "n", "f1", "f2").join(twins, ["n", "f1", "f2"], "left")
    nodes = nodes.select("id", "n", F.when(F.col("n") > 0, F.coalesce("b", "id")).alias("node"))
    found = nodes.join(classes, "node", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id"))
    return found.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with the smallest id of each class; all columns, rows without an id stay. Runs jobs when called.

    Where ids repeat, each (id, text) is a document of its own, so a row only goes if its own text has a near copy that
    stays; of rows of one id and text one stays.
    """
    classes = cut_lineage(near_duplicates(docs, id=id, text=text, **options).where(F.col(id).isNotNull()), "classes")
    if not classes.groupBy(id).count().where("count > 1").head(1):
        return _without(docs, classes, id)
    number = F.lpad((F.col(f"`{id}`").cast("decimal(38,0)") + F.lit("9223372036854775808").cast("decimal(38,0)")).cast("string"), 20, "0")
    place = number if docs.schema[id].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint") else F.col(f"`{id}`").cast("string")
    own = F.concat(place, F.lit(" "), F.coalesce(F.md5(F.col(f"`{text}`").cast("string")), F.lit("")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"), own.alias("key"))
    classes = cut_lineage(near_duplicates(rows, id="key", **options).where("key is not null"), "classes")
    return _without(rows, classes, "key").select("row.*")


def _without(docs: DataFrame, classes: DataFrame, id: str) -> DataFrame:
    """The rows whose id is its class, each id once, and the rows without an id.

    Ids that are dropped or repeat fill a Bloom filter of at most MAYBE_BITS; documents that fail it stay without a
    shuffle, the others (with those it takes in wrongly) are joined with the exact list.
    """
    spark = docs.sparkSession
    dropped = classes.where(F.col(id) != F.col("component_id")).select(F.col(id).alias("_gone")).distinct()
    repeated = classes.groupBy(F.col(id).alias("_gone")).count().where("count > 1").select("_gone")
    keys = cut_lineage(dropped.unionByName(repeated).distinct().select(F.col("_gone").cast("string").alias("key")), "special")
    load = ship(spark, filled(keys, keys.count(), 0.01, 7, MAYBE_BITS))

    @F.pandas_udf("boolean")
    def maybe(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = load()
        for values in ids:
            col = pa.array(values, pa.string())
            yield pd.Series(own.has(text_digests(col), text_digests(col, OTHER_BASE)).astype(bool) & values.notna().to_numpy())

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("row"), F.col(f"`{id}`").alias("key"), maybe.asNondeterministic()(F.col(f"`{id}`").cast("string")).alias("maybe"))
    sure = rows.where("not maybe").select("row")
    order = F.hash(*[F.col(f"row.`{c}`") for c, kind in docs.dtypes if not kind.startswith("map")])
    rest = rows.where("maybe").join(dropped, F.col("key") == F.col("_gone"), "left_anti").withColumn("order", order)
    return sure.unionByName(rest.groupBy("key").agg(F.min_by("row", "order").alias("row")).select("row")).select("row.*")
