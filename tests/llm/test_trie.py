"""The prefix trie against a plain dictionary of prefixes, with chunks of a few rows, and odd inputs."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from reviewloom.llm.queries import with_shared_starts
from reviewloom.llm.trie import prefix_trie, turn_paths

SCHEMA = "conv_id long, turn long, role string, text string"
CLASH = ["id", "turns", "key", "path", "n", "depth", "kind", "there", "chars"]


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts).select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


def brute(rows):
    """The nodes of (conv, [(role, text), ...])."""
    members = {}
    for conv, turns in rows.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    own = {p: (len(m) - 1) * len(p[-1][1]) if p else 0 for p, m in members.items()}
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path in members:
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += own[path]
    out = set()
    for path, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(rows[c]) == len(path)))
        parent = min(members[path[:-1]]) if path else None
        out.add((min(m), len(path), parent, len(m), len(kids.get(path, [])), leaves[path], saved[path],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def conversations(rows):
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            found.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1] or 0))] for c, turns in found.items()}


def random_rows(seed, convs=120, hot=True):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-300, 3000), convs):
        n = rng.choice([1, 2, 3, 5, 17, 40]) if hot else rng.randint(1, 6)
        same = rng.random() < 0.4  # the first n turns of one long conversation
        for turn in range(n):
            text = f"t{turn}" if same or rng.random() < 0.8 else rng.choice(["", "é漢", "x y", None])
            rows.append((conv, turn if turn else None, rng.choice(["user", "user", None]) if not same else "user", text))
    for conv in range(5000, 5060):  # copies
        rows += [(conv, t, "user", f"copy{t}") for t in range(20)]
    return rows


@pytest.mark.parametrize("chunk", [7, 60, 100_000])
def test_trie_matches_brute_force(spark, chunk):
    rows = random_rows(chunk)
    rows += [(None, 0, "user", "nobody")]
    assert result(prefix_trie(turn_paths(table(spark, rows)), chunk)) == brute(conversations(rows))


def test_shared_starts(spark):
    import zlib

    rows = [r for r in random_rows(3, 400, hot=False) if r[0] % 100] + [(100 * i, t, "user", f"first{t}") for i in range(-3, 30) for t in range(i % 7)]
    own = conversations(rows)
    rebuilt = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(c / 100) * 100
        rebuilt[c] = own.get(c - base, [])[:h] + turns[h:]
    assert any(not turns for turns in rebuilt.values())
    paths = with_shared_starts(turn_paths(table(spark, rows)))
    assert result(prefix_trie(paths, 50)) == brute(rebuilt)


def test_edges(spark):
    assert result(prefix_trie(turn_paths(table(spark, [])))) == set()
    rows = [(None, 1, "user", "x")]
    assert result(prefix_trie(turn_paths(table(spark, rows)))) == set()
    long = "word " * 200_000
    rows = [(1, 0, "user", long), (2, 0, "user", long), (3, 0, "user", long + "."), (3, 0, "user", long + "."), (4, None, None, None)]
    assert result(prefix_trie(turn_paths(table(spark, rows)))) == brute(conversations(rows))


def test_equal_turn_numbers_have_one_order(spark):
    """Turns of one number are ordered by digest, whatever order the rows come in."""
    rows = [(1, 5, "user", "b"), (1, 5, "user", "a"), (1, 5, "assistant", "b"), (1, None, "z", "z")]
    runs = [result(prefix_trie(turn_paths(table(spark, rows[i:] + rows[:i], 1)))) for i in range(4)]
    assert all(r == runs[0] for r in runs) and len(runs[0]) == 5


def test_role_and_text_do_not_run_together(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc")]
    assert len(result(prefix_trie(turn_paths(table(spark, rows))))) == 3
