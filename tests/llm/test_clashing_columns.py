"""Operators whose inner column names meet equal names in the input, and ids of other types."""

import pytest
from pyspark.sql import functions as F

from reviewloom.llm import chat, mixing

TURNS = [
    (0, 1, "user", "hi"), (0, 2, "assistant", "A"), (1, 1, "user", "yo"), (1, 2, "assistant", "B"), (1, 3, "user", "more"),
    (2, 1, "assistant", "C"), (3, 1, "user", "alone"), (4, 1, "assistant", None), (None, 1, "assistant", "N"), (5, None, None, "x"),
    (-2, 1, "assistant", "x"), (-2, 1, "assistant", "y"), (-1, 7, "assistant", "z"), (-1, 7, "assistant", "z"),
]
INNER = ["_conv", "_last", "_other", "_there", "conv", "last", "other", "there", "number", "row", "said", "reply", "a.b"]


def swapped(rows, number):
    """with_other_replies by dictionaries."""
    last, reply = {}, {}
    for c, t, r, x in rows:
        if r == "assistant" and c is not None and t is not None:
            last[number[c]] = max(last.get(number[c], t), t)
    for c, t, r, x in rows:
        if r == "assistant" and c is not None and t == last.get(number[c]):
            reply[number[c]] = max(reply.get(number[c], ""), x or "") if x is not None or number[c] in reply else None
    out = []
    for c, t, r, x in rows:
        n = number.get(c)
        if c is not None and r == "assistant" and t == last.get(n):
            if n ^ 1 in reply:
                out.append((c, t, r, reply[n ^ 1]))
        else:
            out.append((c, t, r, x))
    return sorted(out, key=str)


def test_other_replies_with_clashing_columns(spark):
    rows = spark.createDataFrame(TURNS, "conv_id long, turn int, role string, text string")
    wide = rows.select("*", *[F.lit(i).alias(c) for i, c in enumerate(INNER)])
    got = chat.with_other_replies(wide)
    assert got.columns == wide.columns
    want = swapped(TURNS, {c: c for c, *_ in TURNS if c is not None})
    assert sorted([tuple(r)[:4] for r in got.collect()], key=str) == want
    assert all(tuple(r)[4:] == tuple(range(len(INNER))) for r in got.collect())
    assert chat.with_other_replies(wide.limit(0)).count() == 0


def test_other_replies_of_named_conversations(spark):
    rows = [(None if c is None else f"c{c}", t, r, x) for c, t, r, x in TURNS]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    number = {r.conv_id: r.n for r in chat.number_values(df, "conv_id", "n").collect()}
    assert sorted(number.values()) == list(range(len(number)))
    assert sorted(map(tuple, chat.with_other_replies(df).collect()), key=str) == swapped(rows, number)


@pytest.mark.parametrize("names", [["mix_epoch", "mix_words"], ["MIX_EPOCH"], ["row", "size", "taken", "target", "a.b"]])
def test_mixture_with_clashing_columns(spark, tmp_path, names):
    rows = [(i, f"s{i % 3}", "word " * (1 + i % 5)) for i in range(40)] + [(None, None, None), (40, "s0", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    want = sorted(map(tuple, mixing.mixture(docs).collect()), key=str)
    got = mixing.mixture(docs.select("*", *[F.lit("own").alias(c) for c in names]))
    got.write.parquet(str(tmp_path / "m"))
    kept = [c for c in names if not c.lower().startswith("mix_")]
    assert got.columns == ["doc_id", "source", "text", *kept, "mix_epoch", "mix_words"]
    back = spark.read.parquet(str(tmp_path / "m"))
    assert sorted(map(tuple, back.select("doc_id", "source", "text", "mix_epoch", "mix_words").collect()), key=str) == want
    assert {r[c] for c in kept for r in back.collect()} <= {"own"}
