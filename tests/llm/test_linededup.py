"""Line dedup against brute force through inserts and deletions, the cuckoo filter, and odd inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import linededup
from reviewloom.llm.linededup import Cuckoo, LineIndex

CLASH = ["id", "doc", "row", "hi", "lo", "docs", "drop", "maybe", "kept", "n_lines", "shard", "batch", "last"]
BLANKS = " \t\n\x0b\x0c\r"


def table(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


def key_of(line, shortest=20):
    key = line.strip(BLANKS).translate({c: c + 32 for c in range(65, 91)})
    return key if len(key) >= shortest else None


def repeated(held, at_least=3):
    docs = {}
    for doc, text in held:
        for line in (text or "").split("\n"):
            if doc is not None and key_of(line):
                docs.setdefault(key_of(line), set()).add(doc)
    return {k: max(d) for k, d in docs.items() if len(d) >= at_least}


def brute(held, asked):
    last, out = repeated(held), []
    for doc, text in asked:
        lines = (text or "").split("\n")
        stay = [x for x in lines if doc is None or last.get(key_of(x), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def cleaned(index, df):
    return sorted((tuple(r) for r in index.clean(df).collect()), key=repr)


def state(index):
    return sorted(tuple(r) for r in index.counts.collect())


def documents(seed, n, start=0):
    rng = random.Random(seed)
    common = [f"  Line number {i} of the common ones é " for i in range(12)] + ["short", "", "x" * 20, "é" * 19, "é" * 20 + "\r"]
    out = []
    for i in range(start, start + n):
        lines = [rng.choice([rng.choice(common), rng.choice(common).upper(), f"a line of its own, number {rng.random()}"]) for _ in range(rng.randint(0, 9))]
        out.append((i, "\n".join(lines)))
    return out


def test_cuckoo_filter():
    rng = np.random.default_rng(5)
    hi, lo = rng.integers(0, 1 << 63, (2, 9000), np.uint64) * np.uint64(2) + np.uint64(1)
    own = Cuckoo(1 << 13)
    own.insert(hi[:3000], lo[:3000])
    own.insert(hi[3000:6000], lo[3000:6000])
    assert not own.over and own.has(hi[:6000], lo[:6000]).all() and own.has(hi[6000:], lo[6000:]).mean() < 0.01
    own = Cuckoo.unpack(*own.pack())
    own.delete(hi[:3000], lo[:3000])
    assert own.has(hi[3000:6000], lo[3000:6000]).all() and own.has(hi[:3000], lo[:3000]).mean() < 0.01
    own.insert(hi[:1000], lo[:1000])
    own.delete(hi[:6000][np.r_[0:1000, 3000:6000]], lo[:6000][np.r_[0:1000, 3000:6000]])
    assert not own.table.any() and not own.has(hi, lo).any()


def test_cuckoo_filter_beyond_its_room():
    rng = np.random.default_rng(6)
    hi, lo = rng.integers(0, 1 << 63, (2, 300), np.uint64)
    own = Cuckoo(128)
    own.insert(hi[:80], lo[:80])
    own.insert(hi[80:], lo[80:])
    assert own.over and own.has(hi, lo).all()
    own = Cuckoo.unpack(*own.pack())
    own.delete(hi[40:], lo[40:])
    assert own.has(hi[:40], lo[:40]).all() and own.has(hi[40:], lo[40:]).mean() < 0.1


def test_equal_fingerprints_are_counted():
    own = Cuckoo(64)
    hi, lo = np.full(3, 7, np.uint64), np.full(3, 9 << 48, np.uint64)
    own.insert(hi, lo)
    own.delete(hi[:1], lo[:1])
    assert (own.table != 0).sum() == 2 and own.has(hi, lo).all()


@pytest.mark.parametrize("shipped,exact", [(64 << 20, 64 << 20), (64 << 20, 0), (0, 0)])
def test_inserts_and_deletions_can_be_taken_back(spark, monkeypatch, shipped, exact):
    monkeypatch.setattr(linededup, "SHIPPED", shipped)
    monkeypatch.setattr(linededup, "EXACT", exact)
    first, second = documents(1, 60), documents(2, 50, 60)
    empty = LineIndex.empty(spark, slots=16)  # shards must double
    one = empty.insert(table(spark, first))
    assert cleaned(one, table(spark, first)) == brute(first, first)
    two = one.insert(table(spark, second))
    assert two.shards > 1 or two.repeated().count() <= 12
    assert cleaned(two, table(spark, first + second)) == brute(first + second, first + second)
    assert state(two) == state(empty.insert(table(spark, first + second)))
    back = two.delete(table(spark, second))
    assert state(back) == state(one) and cleaned(back, table(spark, first)) == brute(first, first)
    assert cleaned(one, table(spark, first)) == brute(first, first)  # the old index is as it was
    again = back.insert(table(spark, second))
    assert state(again) == state(two) and cleaned(again, table(spark, second)) == brute(first + second, second)
    some = [r for r in first + second if r[0] % 3]
    few = again.delete(table(spark, [r for r in first + second if r[0] % 3 == 0] + [(10_000, "never there")]))
    assert state(few) == state(empty.insert(table(spark, some)))
    assert cleaned(few, table(spark, some)) == brute(some, some)
    changed = [(i, t + "\n" + "one more line in many documents") for i, t in second]
    assert cleaned(few.insert(table(spark, changed)), table(spark, changed)) == brute(
        [r for r in some if r[0] < 60] + changed, changed)


def test_filters_hold_just_the_repeated_keys(spark):
    docs = documents(3, 80)
    index = LineIndex.empty(spark).insert(table(spark, docs))
    marks = sum(int((Cuckoo.unpack(bytes(r["filter"]), bytes(r["over"])).table != 0).sum()) for r in index.filters.collect())
    assert marks == index.repeated().count() == len(repeated(docs)) > 5
    gone = index.delete(table(spark, docs))
    assert state(gone) == [] and not any(any(r["filter"]) for r in gone.filters.collect())


@pytest.mark.parametrize("exact", [64 << 20, -1])
def test_edges(spark, monkeypatch, exact):
    monkeypatch.setattr(linededup, "EXACT", exact)
    line = "This line is in all documents\r"
    long = "\n".join(f"line {i} of a very long text" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, "\n"), (4, line), (5, f"{line}\n{line}\n\n{line}"), (5, line + "\nmore"), (6, " " + line.lower()),
            (None, line), (None, None), (7, long + "\n" + line), (8, long), (9, long + "\nend"), (-3, "THIS LINE is in all documents")]
    index = LineIndex.empty(spark).insert(table(spark, rows))
    assert cleaned(index, table(spark, rows)) == brute(rows, rows)
    other = [(1, line), (99, line), (None, line)]  # texts that the index does not hold
    assert cleaned(index, table(spark, other)) == brute(rows, other)
    nothing = LineIndex.empty(spark).insert(table(spark, []))
    assert cleaned(nothing, table(spark, [])) == [] and cleaned(nothing, table(spark, rows)) == brute([], rows)
    assert state(nothing.insert(table(spark, rows)).delete(table(spark, []))) == state(index)
