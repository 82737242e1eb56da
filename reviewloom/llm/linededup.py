"""Line dedup that can be taken back: reference counts of lines, sharded cuckoo filters of the repeated ones.

Method. An index of documents holds three tables in the shared folder. References: which documents hold a line's key.
Counts: for each key the exact number of its documents and the largest of their ids. Filters: the keys held by at least
`at_least` documents, in cuckoo filters of one shard of the keys each. Inserting documents adds their references, raises the
counts and inserts the keys that became repeated into the filters; deleting documents lowers the counts, looks up the
largest remaining id where it went, and deletes the keys that are repeated no more from the filters. Each change gives
a new index and leaves the old one as it was, so every step can be taken back, and a lost executor repeats its part.

Cleaning reads the texts against the filters; only the lines that pass are looked up in the counts. Where the counts of all
repeated keys fit EXACT bytes, tasks hold them too and the texts are read once, in place. Beyond that the lines that pass are
joined with the counts, and the documents that lose lines with what they lose. False positives end at the exact counts.

A line's key is the line without blanks at both ends, A-Z lower-cased; keys of fewer than `shortest` code points are never
repeated. Keys are 128-bit digests. A repeated key loses its lines everywhere but in the largest id that holds it.

Skew and memory: a piece of texts sends a key once, with the ids that hold it there, so a line of a third of all documents
is one row per piece and is summed on both sides of the shuffle. A task holds one piece, or one shard of the filters
(SLOTS slots of 2 bytes) and its changed keys. Filters are broadcast while all shards together stay below SHIPPED bytes;
beyond that every line is looked up in the counts, by the same join. The number of shards doubles, from the exact
counts, when they fill up; a key that finds no place is kept whole beside its shard.

Defined results: a null or empty text is one empty line; ids are whole numbers, a document without an id is in no index
and keeps its lines; inserting an id that the index holds replaces its document, and rows that repeat an id in one
table count as one document with the lines of all of them; an empty table changes nothing; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewloom.llm.components import runs
from reviewloom.llm.shipping import ship
from reviewloom.llm.urls import OTHER_BASE, filled
from reviewloom.llm.words import BASE, LOWER, mix, pieces, raw, span_digests, text_digests
from reviewloom.session import cut_lineage

#: slots of a shard's filter, four to a bucket, and the share of them that may be taken before shards double
SLOTS, FULL = 1 << 18, 0.75
#: bytes of filters, and of counts of repeated keys, that may be broadcast; bits of the filter of documents that lose lines
SHIPPED, EXACT, TOUCHED_BITS = 64 << 20, 64 << 20, 1 << 26

BLANKS = np.zeros(256, bool)
BLANKS[32] = BLANKS[9:14] = True


class Lines:
    """The lines of texts: begin and end of each in the bytes, of which text, and digests of the keys that are long enough."""

    def __init__(self, texts: pa.Array, shortest: int):
        data, offsets = raw(texts)
        breaks = np.flatnonzero(data == 10)
        self.data = data
        self.starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
        self.ends = np.sort(np.concatenate([breaks, offsets[1:]]))
        self.counts = np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]) + 1
        self.owner = np.repeat(np.arange(len(offsets) - 1), self.counts)
        seen = np.flatnonzero(~BLANKS[data])
        a, b = np.searchsorted(seen, self.starts), np.searchsorted(seen, self.ends)
        some = np.flatnonzero(a < b)
        start, end = seen[a[some]], seen[b[some] - 1] + 1
        points = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=points[1:])
        long = points[end] - points[start] >= shortest
        #: the lines with a key, and the two halves of its digest
        self.keyed = some[long]
        lowered = LOWER[data]
        self.hi, self.lo = (span_digests(lowered, start[long], end[long], base) for base in (BASE, OTHER_BASE))


class Cuckoo:
    """A cuckoo filter: 16-bit fingerprints, four to a bucket, each in one of two buckets; `over` holds keys without a place."""

    def __init__(self, slots: int):
        self.table = np.zeros((slots // 4, 4), np.uint16)
        self.over: set[int] = set()

    def _at(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = (lo >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = (hi & np.uint64(len(self.table) - 1)).astype(np.int64)
        return mark, first, self._other(mark, first)

    def _other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(mark.astype(np.uint64)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def has(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        mark, one, two = self._at(hi, lo)
        out = (self.table[one] == mark[:, None]).any(axis=1) | (self.table[two] == mark[:, None]).any(axis=1)
        if self.over:
            out |= np.isin(hi, np.fromiter(self.over, np.uint64))
        return out

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Adds keys that are not in the filter. All keys move at once; of those that find a full bucket one takes a slot
        from an older key, which moves on to its other bucket. If that does not end, the new keys are kept whole."""
        before = self.table.copy()
        mark, bucket, _ = self._at(hi, lo)
        for turn in range(400):
            if not len(mark):
                return
            order = np.argsort(bucket, kind="stable")
            mark, bucket = mark[order], bucket[order]
            new = np.append(True, bucket[1:] != bucket[:-1])
            rank = np.arange(len(bucket)) - np.flatnonzero(new)[np.cumsum(new) - 1]
            taken = self.table[bucket] != 0
            free = 4 - taken.sum(axis=1)
            fits, pushes = rank < free, rank == free
            slot = np.argsort(taken, axis=1, kind="stable")[np.arange(len(bucket)), np.minimum(rank, 3)]
            self.table[bucket[fits], slot[fits]] = mark[fits]
            full = bucket[pushes]
            victims = self.table[full, turn % 4]
            self.table[full, turn % 4] = mark[pushes]
            rest = rank > free
            mark = np.concatenate([victims, mark[rest]])
            bucket = self._other(mark, np.concatenate([full, bucket[rest]]))
        self.table = before
        self.over.update(hi.tolist())

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Takes out keys that are in the filter, one fingerprint each."""
        if self.over:
            inside = np.array([h not in self.over for h in hi.tolist()], bool)
            self.over.difference_update(hi.tolist())
            hi, lo = hi[inside], lo[inside]
        mark, one, two = self._at(hi, lo)
        todo = np.arange(len(mark))
        while len(todo):
            cells = np.concatenate([self.table[one[todo]], self.table[two[todo]]], axis=1) == mark[todo, None]
            found = cells.any(axis=1)
            todo, column = todo[found], cells[found].argmax(axis=1)
            place = np.where(column < 4, one[todo], two[todo]) * 4 + column % 4
            _, first = np.unique(place, return_index=True)
            self.table.reshape(-1)[place[first]] = 0
            todo = np.delete(todo, first)

    def pack(self) -> tuple[bytes, bytes]:
        return self.table.tobytes(), np.array(sorted(self.over), np.uint64).tobytes()

    @classmethod
    def unpack(cls, table: bytes, over: bytes) -> "Cuckoo":
        out = cls(4)
        out.table = np.frombuffer(table, np.uint16).reshape(-1, 4).copy()
        out.over = set(np.frombuffer(over, np.uint64).tolist())
        return out


class Shards:
    """All shards of the filters in a task; a key's shard is told by the low bits of the lower half of its digest."""

    def __init__(self, count: int, filters: dict[int, Cuckoo]):
        self.count, self.filters = count, filters

    def has(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        shard = lo & np.uint64(self.count - 1)
        out = np.zeros(len(hi), bool)
        for number, own in self.filters.items():
            at = np.flatnonzero(shard == number)
            if len(at):
                out[at] = own.has(hi[at], lo[at])
        return out


class Counts:
    """The repeated keys and the largest id of each, sorted by digest, behind the filters."""

    def __init__(self, filters: Shards, hi: np.ndarray, lo: np.ndarray, last: np.ndarray):
        order = np.lexsort((lo, hi))
        self.filters, self.hi, self.lo, self.last = filters, hi[order], lo[order], last[order]

    def dropped(self, hi: np.ndarray, lo: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Which lines lie in another document than the one that keeps them."""
        out = np.zeros(len(hi), bool)
        at = np.flatnonzero(self.filters.has(hi, lo)) if len(self.hi) else np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.hi, hi[at]), len(self.hi) - 1)
        out[at] = (self.hi[place] == hi[at]) & (self.lo[place] == lo[at]) & (self.last[place] != doc[at])
        return out


KEY = ["hi", "lo"]
REFERENCES = "hi long, lo long, docs array<long>"
FILTERS = "shard int, filter binary, over binary"


def references(rows: DataFrame, shortest: int, load: Callable[[], Shards] | None = None) -> DataFrame:
    """The keys of (doc, text) rows, each once per piece with the ids that hold it there; with filters, only keys that pass."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = load and load()
        for piece in pieces(batches, "text"):
            lines = Lines(piece.column("text"), shortest)
            doc = piece.column("doc").to_numpy()[lines.owner[lines.keyed]]
            hi, lo = lines.hi, lines.lo
            if filters:
                some = filters.has(hi, lo)
                doc, hi, lo = doc[some], hi[some], lo[some]
            order = np.lexsort((doc, lo, hi))
            doc, hi, lo = doc[order], hi[order], lo[order]
            other = np.append(True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))[:len(hi)]
            once = other | np.append(True, doc[1:] != doc[:-1])[:len(hi)]
            starts = np.flatnonzero(other[once])
            doc, hi, lo = doc[once], hi[once][starts], lo[once][starts]
            docs = pa.ListArray.from_arrays(pa.array(np.append(starts, len(doc)), pa.int32()), pa.array(doc, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), docs], ["hi", "lo", "docs"])

    return rows.where("doc is not null").mapInArrow(find, REFERENCES)


def changed_filters(old: DataFrame, changes: DataFrame, shards: int, slots: int) -> DataFrame:
    """The filters after inserting (sign 1) and deleting (sign -1) keys; a task holds one shard."""
    empty = F.lit(None)
    rows = old.select("shard", "filter", "over", *[empty.cast(t).alias(c) for c, t in (("hi", "long"), ("lo", "long"), ("sign", "int"))])
    rows = rows.unionByName(changes.select(
        F.pmod("lo", F.lit(shards)).cast("int").alias("shard"), empty.cast("binary").alias("filter"),
        empty.cast("binary").alias("over"), "hi", "lo", F.col("sign").cast("int").alias("sign"),
    ))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "shard"):
            shard = rows.column("shard")[0].as_py()
            kept = [i for i, there in enumerate(rows.column("filter").is_valid().to_pylist()) if there]
            own = Cuckoo.unpack(rows.column("filter")[kept[0]].as_py(), rows.column("over")[kept[0]].as_py()) if kept else Cuckoo(slots)
            keys = rows.filter(rows.column("sign").is_valid())
            hi, lo = (keys.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in KEY)
            sign = keys.column("sign").to_numpy()
            own.delete(hi[sign < 0], lo[sign < 0])
            own.insert(hi[sign > 0], lo[sign > 0])
            table, over = own.pack()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([table]), pa.array([over])], ["shard", "filter", "over"])

    return rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(apply, FILTERS)


@dataclass(frozen=True)
class LineIndex:
    """The tables of a set of documents. Start with `LineIndex.empty`; `insert` and `delete` give a new index."""

    spark: SparkSession
    shortest: int
    at_least: int
    slots: int
    batch: int
    shards: int
    ids: DataFrame  #: doc
    refs: DataFrame  #: hi, lo, docs, batch
    gone: DataFrame  #: doc, batch: references of the doc up to this batch don't count
    counts: DataFrame  #: hi, lo, n, last
    filters: DataFrame

    @classmethod
    def empty(cls, spark: SparkSession, shortest: int = 20, at_least: int = 3, slots: int = SLOTS) -> "LineIndex":
        """Keys count from `shortest` code points and repeat from `at_least` documents on; slots: a power of two."""
        def none(schema: str) -> DataFrame:
            return spark.createDataFrame([], schema)

        return cls(
            spark, shortest, at_least, slots, 0, 1, none("doc long"), none(REFERENCES + ", batch int"), none("doc long, batch int"),
            none("hi long, lo long, n long, last long"), none(FILTERS),
        )

    def insert(self, docs: DataFrame, text: str = "text", id: str = "doc_id") -> "LineIndex":
        """The index with these documents; those of ids that it holds are replaced. Runs jobs when called."""
        rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
        ids = cut_lineage(rows.where("doc is not null").groupBy("doc").agg(F.count(F.lit(1)).alias("rows")), "ids")
        base = self
        if self.batch:
            known = cut_lineage(ids.join(self.ids, "doc", "left_semi").select("doc"), "known")
            base = self.delete(known, "doc") if known.head(1) else self
        batch = base.batch + 1
        refs = cut_lineage(references(rows, self.shortest), "references")
        if ids.where("rows > 1").head(1):  # an id of several rows counts once
            once = refs.select("hi", "lo", F.explode("docs").alias("doc")).distinct()
            refs = cut_lineage(once.select("hi", "lo", F.array("doc").alias("docs")), "references")
        added = refs.groupBy(KEY).agg(F.sum(F.size("docs")).alias("more"), F.max(F.array_max("docs")).alias("top"))
        if self.batch:
            both = base.counts.join(added, KEY, "full")
        else:
            both = added.select("*", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("last"))
        before, more = F.coalesce("n", F.lit(0)), F.coalesce("more", F.lit(0))
        counts = cut_lineage(both.select(
            "hi", "lo", (before + more).alias("n"), F.greatest("last", "top").alias("last"),
            ((before < self.at_least) & (before + more >= self.at_least)).alias("rises"),
        ), "counts")
        grown = replace(
            base, batch=batch, ids=base.ids.unionByName(ids.select("doc")) if self.batch else ids.select("doc"),
            refs=base.refs.unionByName(refs.withColumn("batch", F.lit(batch))) if self.batch else refs.withColumn("batch", F.lit(batch)),
            counts=counts.drop("rises"),
        )
        return grown._filtered(counts.where("rises").select("hi", "lo", F.lit(1).alias("sign")))

    def delete(self, ids: DataFrame, id: str = "doc_id") -> "LineIndex":
        """The index without the documents of these ids; other ids don't matter. Runs jobs when called."""
        doomed = ids.select(F.col(f"`{id}`").cast("long").alias("doc")).distinct().join(self.ids, "doc", "left_semi")
        doomed = cut_lineage(doomed, "doomed")
        alive = self.alive()
        fewer = alive.join(doomed, "doc", "left_semi").groupBy(KEY).agg(F.count(F.lit(1)).alias("less"), F.max("doc").alias("top"))
        after = cut_lineage(self.counts.join(fewer, KEY, "left").select(
            "hi", "lo", "n", "last", (F.col("n") - F.coalesce("less", F.lit(0))).alias("left"), (F.col("top") == F.col("last")).alias("lost"),
        ), "after")
        orphans = after.where("lost and left > 0").select(KEY)
        heirs = alive.join(doomed, "doc", "left_anti").join(orphans, KEY, "left_semi").groupBy(KEY).agg(F.max("doc").alias("heir"))
        counts = after.where("left > 0").join(heirs, KEY, "left")
        counts = cut_lineage(counts.select("hi", "lo", F.col("left").alias("n"), F.coalesce("heir", "last").alias("last")), "counts")
        shrunk = replace(
            self, ids=cut_lineage(self.ids.join(doomed, "doc", "left_anti"), "ids"), counts=counts,
            gone=self.gone.unionByName(doomed.withColumn("batch", F.lit(self.batch))),
        )
        falls = after.where((F.col("n") >= self.at_least) & (F.col("left") < self.at_least))
        return shrunk._filtered(falls.select("hi", "lo", F.lit(-1).alias("sign")))

    def alive(self) -> DataFrame:
        """hi, lo, doc of every document of the index."""
        rows = self.refs.select("hi", "lo", F.explode("docs").alias("doc"), "batch").alias("r")
        fits = (F.col("r.doc") == F.col("g.doc")) & (F.col("r.batch") <= F.col("g.batch"))
        return rows.join(self.gone.alias("g"), fits, "left_anti").select("hi", "lo", "doc")

    def repeated(self) -> DataFrame:
        """hi, lo, n, last of the repeated keys."""
        return self.counts.where(F.col("n") >= self.at_least)

    def _filtered(self, changes: DataFrame) -> "LineIndex":
        """The index with filters that hold the repeated keys, from those before and what changed."""
        needed, old, shards = self.repeated().count(), self.filters, self.shards
        while needed > FULL * self.slots * shards:
            shards *= 2
        if shards != self.shards:
            old, changes = old.limit(0), self.repeated().select("hi", "lo", F.lit(1).alias("sign"))
        return replace(self, shards=shards, filters=cut_lineage(changed_filters(old, changes, shards, self.slots), "filters"))

    def load(self) -> Shards | None:
        """The filters, if all shards together are small enough to broadcast."""
        if self.shards * self.slots * 2 > SHIPPED:
            return None
        return Shards(self.shards, {r["shard"]: Cuckoo.unpack(bytes(r["filter"]), bytes(r["over"])) for r in self.filters.collect()})

    def clean(self, docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
        """id, n_lines, n_dropped and kept (the text of the other lines) of every row. Runs jobs when called."""
        rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{id}`").cast("long").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        kind = f"id {dict(rows.dtypes)['id']}, n_lines long, n_dropped long, kept string"
        filters = self.load()
        if filters and self.repeated().count() * 24 <= EXACT:
            found = self.repeated().select("hi", "lo", "last").toArrow()
            hi, lo, last = (found.column(c).to_numpy().astype(np.int64) for c in ("hi", "lo", "last"))
            counts = ship(self.spark, Counts(filters, hi.view(np.uint64), lo.view(np.uint64), last))
            return rows.mapInArrow(without_lines(self.shortest, counts), kind).withColumnRenamed("id", id)
        asked = references(rows.select("doc", "text"), self.shortest, filters and ship(self.spark, filters))
        found = asked.join(self.repeated().select("hi", "lo", "last"), KEY).select(F.explode("docs").alias("doc"), "hi", "last")
        drops = cut_lineage(found.where("doc <> last").groupBy("doc").agg(F.collect_set("hi").alias("drop")), "drops")
        keys = drops.select(F.col("doc").cast("string").alias("key"))
        touched = ship(self.spark, filled(keys, drops.count(), 0.01, 12, TOUCHED_BITS))

        @F.pandas_udf("boolean")
        def maybe(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = touched()
            for values in ids:
                col = pa.array(values, pa.string())
                yield pd.Series(own.has(text_digests(col), text_digests(col, OTHER_BASE)).astype(bool) & values.notna().to_numpy())

        marked = rows.withColumn("maybe", maybe.asNondeterministic()(F.col("doc").cast("string")))
        breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
        whole = marked.where("not maybe").select("id", breaks.cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.col("text").alias("kept"))
        cut = marked.where("maybe").join(drops, "doc", "left").select("id", "text", "drop").mapInArrow(without_lines(self.shortest), kind)
        return whole.unionByName(cut).withColumnRenamed("id", id)


def without_lines(shortest: int, load: Callable[[], Counts] | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts without the lines that the counts drop; without counts, those that the row's list `drop` holds."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = load and load()
        for piece in pieces(batches, "text"):
            texts = piece.column("text").to_pylist()
            lines = Lines(piece.column("text"), shortest)
            owner, dropped = lines.owner[lines.keyed], np.zeros(len(lines.starts), bool)
            if counts:
                doc = piece.column("doc")
                there = np.asarray(doc.is_valid())[owner]
                dropped[lines.keyed] = counts.dropped(lines.hi, lines.lo, doc.fill_null(0).to_numpy()[owner]) & there
            else:
                first, drop = np.searchsorted(owner, np.arange(len(piece) + 1)), piece.column("drop")
                for i in np.flatnonzero(np.asarray(drop.is_valid())):
                    here = slice(first[i], first[i + 1])
                    dropped[lines.keyed[here][np.isin(lines.hi[here], drop[i].values.to_numpy().view(np.uint64))]] = True
            line = np.cumsum(lines.counts) - lines.counts
            n_dropped = np.add.reduceat(dropped.astype(np.int64), line)
            data = lines.data.tobytes()
            for i in np.flatnonzero(n_dropped).tolist():
                stay = line[i] + np.flatnonzero(~dropped[line[i]:line[i] + lines.counts[i]])
                texts[i] = b"\n".join(data[a:b] for a, b in zip(lines.starts[stay].tolist(), lines.ends[stay].tolist())).decode()
            yield pa.RecordBatch.from_arrays([
                piece.column("id"), pa.array(lines.counts, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string()),
            ], ["id", "n_lines", "n_dropped", "kept"])

    return cut
