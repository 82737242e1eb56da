"""Tokenizer alignment against the libraries and plain loops, its perfect hash, and odd inputs."""

import bisect
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import alignment
from reviewloom.llm.alignment import PerfectHash, Tokenizers, alignments, build_hash, shard_of
from reviewloom.llm.queries import QUERIES, tokenizer

A, B = (lambda: tokenizer("byte_bpe_50k.json")), (lambda: tokenizer("piece_bpe_32k.model"))
CLASH = ["id", "n", "code", "shard", "counts", "digest", "groups", "n_a", "n_links", "task"]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.fixture(scope="module")
def libraries():
    tokenizers = pytest.importorskip("tokenizers")
    sentencepiece = pytest.importorskip("sentencepiece")
    a = tokenizers.Tokenizer.from_file(A())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B())


def letters():
    """The byte of each printable letter of the vocabulary."""
    from reviewloom.llm.token_counts import byte_letters

    return {c: i for i, c in enumerate(byte_letters())}


def spelled(libraries, text):
    a, b = libraries
    byte = letters()
    left = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    return left, right


def brute(libraries, rows):
    docs, pairs = [], {}
    for doc, text in rows:
        left, right = spelled(libraries, text) if text else ([], [])
        want = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in left) != want or b"".join(t for _, t in right) != want:
            left, right = [], []
        spans = []
        for side in (left, right):
            at, found = 0, []
            for i, t in side:
                found.append((at, at + len(t), i))
                at += len(t)
            spans.append(found)
        links, j = [], 0
        for s, e, i in spans[0]:
            while j and spans[1][j][0] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((i, spans[1][k][2]))
                k += 1
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = [([], []) for _ in cuts]
        for n, side in enumerate(spans):
            for _, e, i in side:
                groups[bisect.bisect_left(cuts, e)][n].append(str(i))
        groups = ["|".join(map(",".join, g)) for g in groups]
        docs.append((doc, len(left), len(right), len(cuts), links, ";".join(groups)))
        for pair in set(links):
            pairs[pair] = pairs.get(pair, 0) + 1
    best = {}
    for (a, _), n in pairs.items():
        best[a] = max(best.get(a, 0), n)
    return sorted([(d, na, nb, ng, len(ls), sum(pairs[p] == best[p[0]] for p in ls), sum(pairs[p] for p in ls), g)
                   for d, na, nb, ng, ls, g in docs], key=repr)


def table(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


def result(df):
    return sorted((tuple(r[c] for c in ["doc_id", *COLUMNS]) for r in df.collect()), key=repr)


def test_query_matches_brute_force(spark, sf, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 20000").collect()]
    whole = {r.doc_id: r for r in QUERIES["op13_tokenizer_alignment"](spark, sf).collect()}
    assert len(whole) == spark.read.parquet(f"{sf}/documents.parquet").count()
    want = brute(libraries, rows)
    got = result(alignments(spark.createDataFrame(rows, "doc_id long, text string"), A(), B()))
    assert got == want
    for doc, n_a, n_b, n_groups, n_links, _, _, groups in want:  # what other documents don't change
        r = whole[doc]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (n_a, n_b, n_groups, n_links)
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if n_a else "")


def odd_rows(seed=1):
    rng = random.Random(seed)
    bits = ["the ", "Tion", " ", "  ", "\n", "\t", "é", "漢字", "🙂", "<|endoftext|>", "<s>", "</s>", "<0x41>", "▁", "ﬁ", "1234", "don't", "\x00", "á", "unbreakable "]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 25)))) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, " "), (7, rows[7][1]), (8, "another text of the same id"), (None, "no id"), (None, None), (503, "x " * 1500)]


@pytest.mark.parametrize("block", [alignment.BLOCK, 200])
def test_odd_texts(spark, libraries, monkeypatch, block):
    """Also in blocks of 200 pairs, with vectors summed three at a time and pairs sent early."""
    if block == 200:
        monkeypatch.setattr(alignment, "FAN", 3)
        monkeypatch.setattr(alignment, "PAIRS", 50)
    rows = odd_rows()
    assert result(alignments(table(spark, rows, 8), A(), B(), shard=64, block=block)) == brute(libraries, rows)


def test_empty_table(spark):
    assert result(alignments(table(spark, []), A(), B())) == []
    assert result(alignments(table(spark, [(1, None), (2, "")]), A(), B())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_very_long_texts(spark, libraries):
    long = "word " * 120_000
    blanks = "x" + " " * 400_000 + "y"
    got = result(alignments(table(spark, [(1, long), (2, blanks), (3, "a word")]), A(), B()))
    for row, text in zip(got, [long, blanks, "a word"]):
        left, right = spelled(libraries, text)
        same = b"".join(t for _, t in right) == (" " + text).encode()
        assert row[1:3] == ((len(left), len(right)) if same else (0, 0))
        assert row[4] == row[1] + row[2] - row[3]


def test_perfect_hash():
    rng = np.random.default_rng(3)
    codes = np.unique(rng.integers(0, 1 << 31, 20_000))
    own = codes[::2]
    shard = shard_of(own, 7)
    parts = {s: build_hash(own[shard == s]) for s in range(7)}
    pairs = PerfectHash(7, parts)
    assert sorted(pairs.find(own).tolist()) == list(range(len(own))) and (pairs.keys[pairs.find(own)] == own).all()
    some = PerfectHash(7, {s: parts[s] for s in (2, 5)})
    held = np.isin(shard, [2, 5])
    found = some.find(own)
    assert (found[~held] == -1).all() and sorted(found[held].tolist()) == list(range(held.sum()))
    with pytest.raises(ValueError):
        pairs.find(codes[1::2])
    assert len(PerfectHash(3, {}).find(own)) == len(own)


def test_tokenizers_travel(libraries):
    import pickle

    own = pickle.loads(pickle.dumps(Tokenizers(A(), B())))
    for _, text in odd_rows(9):
        if text:
            assert own.encode_a(text).tolist() == libraries[0].encode(text, add_special_tokens=False).ids
