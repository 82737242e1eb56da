"""Work that follows what is there, not the width or the number of usual parts."""

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.sql import functions as F

from reviewloom.operators import corpus as T, topics as L
from reviewloom.plans import catalog_models as M, fixtures as V
from reviewloom.plans.catalog import QUERIES


def test_cells_of_wide_vectors(spark):
    """Laid out as an array, a vector of this width has no room."""
    dtm = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "b", 3)], "review_id long, term string, n long")
    terms = spark.createDataFrame([("a", 5), ("b", 2_000_000_000)], "term string, index int")
    cells = L.vector_cells(L.doc_vectors(dtm, terms, 2_100_000_000))
    assert sorted(map(tuple, cells.collect())) == [(1, 5, 2.0), (1, 2_000_000_000, 1.0), (2, 2_000_000_000, 3.0)]


def test_parts_of_texts_follow_their_length(spark, tmp_path, monkeypatch):
    """The usual number of parts held all texts before, however long."""
    monkeypatch.setattr(V, "PART_CHARS", 100)
    rows = [(i, "x" * 50, "src1", 50 if i % 2 else None) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    texts = V.text_review(spark, str(tmp_path))
    assert texts.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert texts.agg(F.sum(F.length("text"))).first()[0] == 2_000
    spark.createDataFrame([], "doc_id long, text string, source string, n_chars int").write.parquet(str(tmp_path / "none/documents.parquet"))
    assert V.text_review(spark, str(tmp_path / "none")).count() == 0


def test_bound_looks_at_the_terms_of_a_document(spark, monkeypatch):
    """The bound of Spark ML's model, which raises the whole topic matrix to powers for each document."""
    rows = [(d, f"t{(d * 7 + i * (1 + d % 3)) % 40}", 1 + (d + i) % 4) for d in range(50) for i in range(9)]
    dtm = spark.createDataFrame(rows, "review_id long, term string, n long")
    vectors = L.doc_vectors(dtm, *L.term_table(dtm))
    for model in (LDA(k=3, seed=5, maxIter=5, featuresCol="features", **kinds).fit(vectors) for kinds in ({}, {"topicConcentration": 0.3}, {"optimizer": "em"})):
        wanted = model.logLikelihood(vectors)
        assert abs(L.log_likelihood(model, vectors) - wanted) < 1e-3 * abs(wanted)
    monkeypatch.setattr(LDAModel, "logLikelihood", None)  # not run
    assert L.fit_topics(dtm, 3, seeds=[5, 63], iterations=2).log_likelihood < 0


def test_stems_are_looked_up_by_part(spark, monkeypatch):
    """Every word of every text was a row of a shuffle before; now the distinct words of a part are."""
    monkeypatch.setattr(T, "PART_CHARS", 100)
    lookups = []
    word_stems = T.word_stems
    monkeypatch.setattr(T, "word_stems", lambda words, *more: lookups.append(words.count()) or word_stems(words, *more))
    rows = [(i, "running dogs " * 10 + f"w{i}", i % 2) for i in range(20)] + [(None, "x", 0), (30, None, 0), (31, "a b", 7), (31, "c", 8)]
    texts = spark.createDataFrame(rows, "doc long, t string, extra int")
    out = T.stem_texts(texts, "doc", "t")
    assert out.columns == ["doc", "extra", "t"]
    wanted = [(i, i % 2, "run dog " * 10 + f"w{i}") for i in range(20)] + [(31, 7, "a c b"), (31, 8, "a c b")]
    assert sorted(map(tuple, out.collect())) == wanted
    assert len(lookups) == 1 and lookups[0] < 80  # 420 words
    assert T.stem_texts(texts.limit(0), "doc", "t").count() == 0


def test_raw_json_is_compressed(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "scratch_path", lambda spark, name: str(tmp_path / name))
    QUERIES["o8_etl_from_json"](spark, sf)
    parts = [p for p in (tmp_path / "raw").rglob("part-*")]
    assert len({p.parent.name for p in parts}) == 5 and all(p.name.endswith(".gz") for p in parts)


def test_shuffles_by_term_follow_the_rows(spark, monkeypatch):
    """The usual number of tasks got all rows before, and each use of a matrix computed it again."""
    rows = [(d, f"t{(d * i) % 23}", 1 + (d + i) % 3) for d in range(40) for i in range(12)]
    made = spark.createDataFrame(rows, "review_id long, term string, n long").groupBy("review_id", "term").agg(F.sum("n").alias("n"))
    docs = made.select("review_id").distinct()

    def results():
        found = T.prune_bigrams(made, 30, stop=["t1"]), T.tfidf(made, "smooth"), T.drop_sparse(made, docs, 0.5)
        return found, [sorted((r[0], r[1], round(r[2], 9)) for r in df.collect()) for df in found]

    _, usual = results()
    assert T.stored_matrix(made)[1] is None and all(usual)
    monkeypatch.setattr(T, "PART_ROWS", 20)
    many, split = results()
    assert split == usual
    parts = T.stored_matrix(made)[1]
    assert parts > int(spark.conf.get("spark.sql.shuffle.partitions")) and many[0].rdd.getNumPartitions() == parts
