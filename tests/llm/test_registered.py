"""Registered queries of the corpus operators against SQL and against brute force, on the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import reviewloom.llm.queries as corpus
from reviewloom.llm import langid

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(corpus.SQL))
def test_query_matches_sql(spark, sf, duck, name):
    df = corpus.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(repr([row[c] for c in cols]) for row in df.collect())
    cursor = duck.execute(corpus.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == cols
    want = sorted(repr([row[names.index(c)] for c in cols]) for row in cursor.fetchall())
    assert got == want


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in corpus.QUERIES) == list(range(1, 14))


def test_token_counts_match_the_library(spark, sf):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(corpus.tokenizer("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = corpus.QUERIES["op2_token_counts"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)


def test_language_on_held_out_documents(spark, sf):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = corpus.QUERIES["op3_language_centroids"](spark, sf).collect()
    held = [r for r in rows if r.held_out]
    assert 20 < len(held) < len(rows) == len(lang)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("strange", ["de", "en"])
def test_left_out_language_is_rejected(spark, sf, strange):
    """On sf0.01: the smallest table has too few long texts for limits of their own."""
    docs = spark.read.parquet(f"{sf}/../sf0.01/documents.parquet").where("length(text) >= 200").select("doc_id", "text", "lang")
    model = langid.train(docs, (F.col("lang") != strange) & ~langid.held_out())
    rejected = {True: [], False: []}
    for r in langid.with_language(docs.where(langid.held_out() | (F.col("lang") == strange)), model).collect():
        rejected[r.row.lang == strange].append(r.rejected)
    assert len(rejected[True]) > 100 and sum(rejected[True]) >= 0.9 * len(rejected[True])
    assert len(rejected[False]) > 50 and sum(rejected[False]) <= 0.02 * len(rejected[False])


def test_pipeline(spark, sf):
    """Every stage against a plain reading of its own input."""
    from reviewloom.llm import decontam, jaccard, pii
    from reviewloom.session import cut_lineage

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        seen.append(docs)
        docs = cut_lineage(stage(spark, docs, sf), "test")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == seen[0].columns
    languages, classes, clean, private, mixed = [{r.doc_id: r.text for r in d.collect()} for d in seen[1:] + [docs]]
    assert set(languages) <= {r.doc_id for r in seen[0].collect()} and len(languages) >= 0.99 * seen[0].count()
    smallest = {r.doc_id for r in jaccard.near_duplicates(seen[1]).collect() if r.doc_id == r.component_id}
    assert set(classes) == smallest < set(languages)
    hit = {r.doc_id for r in decontam.contamination(seen[2], spark.read.parquet(f"{sf}/benchmark.parquet")).collect() if r.contaminated}
    assert hit and set(clean) == set(classes) - hit
    assert set(private) == set(clean)
    for doc, text in clean.items():
        found = pii.mentions(text or "")
        assert (private[doc] == text) == (not found)
        assert not any(text[a:b] in private[doc] for a, b, *_ in found)
    sizes = {r.doc_id: len((r.text or "").split()) for r in seen[4].collect()}
    taken = {}
    for r in docs.collect():
        assert 0 < r.mix_words <= sizes[r.doc_id] or sizes[r.doc_id] == 0
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.mix_words
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) < 60
    assert set(mixed) == set(taken) <= set(private)


def test_registered_in_the_entry_module():
    import __spark_entry__ as entry

    assert set(corpus.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(corpus.SQL) <= set(entry.oracle_sql())
