"""Corpus cleaning, document-term matrices, n-grams and TF-IDF, all in long form (doc, term, n)."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window as W, functions as F

from reviewloom.functions.stemming import Rules, steps
from reviewloom.functions.text import blank_words, corpus_text, explode_words, ngrams
from reviewloom.functions.words import CORPUS_STOP_WORDS, STOP_BIGRAMS, STOP_WORDS
from reviewloom.operators.aggregates import business_stats, doc_freq, doc_freq_by, term_totals
from reviewloom.operators.cohorts import top_n_ties
from reviewloom.operators.filters import drop_terms, for_business, terms_in_all_parts
from reviewloom.operators.joins import bind_meta, left_stats, spread_join
from reviewloom.operators.ordering import global_positions
from reviewloom.operators.ranking import top_words_limit
from reviewloom.session import cut_lineage

# tasks get the functions of this module with the query, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: characters of the texts that are stemmed together, and of those of a small table
PART_CHARS, SMALL_CHARS = 6_000_000, 500_000
#: rows of a matrix in a task of a shuffle by term, if the usual number of tasks would get more
PART_ROWS = 1_000_000


def word_stems(words: DataFrame, col: str, name: str = "stem", rules: Rules = steps) -> DataFrame:
    """The distinct words of a column with their stems, written once: rules that are inlined into filters or joins
    above would grow without end."""
    out = words.select(F.col(col).alias("_word")).distinct()
    for step, sql in rules("_word"):
        out = out.withColumn(step, F.expr(sql))
    return cut_lineage(out.select(F.col("_word").alias(col), F.col("_stem").alias(name)), "stems")


def stem_terms(df: DataFrame, col: str, name: str = "stem", by: str | None = None, rules: Rules = steps) -> DataFrame:
    """Adds the stem of a word column. A common word is in most rows, so rows are dealt out by the column `by`."""
    return spread_join(df, word_stems(df, col, name, rules), col, by or col)


def _put_stems(doc: str, text: str):
    """The texts of a part with each word replaced by its stem. Rows of one document are one text, its words in order of place."""
    def put(texts: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        stems = dict(zip(table["_word"], table["_stemmed"]))
        out = texts[[doc, text]].copy()
        out[text] = [" ".join([stems[w] for w in t.split(" ")]) for t in texts[text]]
        for _, same in out[out[doc].duplicated(keep=False)].groupby(doc):
            places = sorted((at, w) for t in same[text] for at, w in enumerate(t.split(" ")))
            out.loc[same.index, text] = " ".join(w for _, w in places)
        return out

    return put


def stem_texts(texts: DataFrame, doc: str, text: str) -> DataFrame:
    """The texts with every blank-separated word stemmed, in order; `doc` must be unique. Runs jobs when called.

    Texts are dealt by document into parts of about PART_CHARS characters. Stems are looked up for the distinct words of a
    part, and put in where its texts are, so no word of a text is a row of a shuffle.
    """
    kept = cut_lineage(texts.filter(F.col(doc).isNotNull() & F.col(text).isNotNull()), "texts")
    chars = kept.agg(F.sum(F.length(text).cast("double"))).first()[0] or 0.0
    usual = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(math.ceil(chars / PART_CHARS), min(usual, math.ceil(chars / SMALL_CHARS)), 1)
    dealt = kept.withColumn("_part", F.pmod(F.xxhash64(doc), F.lit(parts)).cast("int"))
    placed = dealt.select("_part", F.explode(F.array_distinct(F.split(text, " "))).alias("_word"))
    words = cut_lineage(placed.distinct(), "part-words")
    table = words.join(word_stems(words, "_word", "_stemmed"), "_word")
    kind = texts.schema[doc].dataType.simpleString()
    stemmed = dealt.select("_part", doc, text).repartition(parts, "_part").groupBy("_part").cogroup(
        table.repartition(parts, "_part").groupBy("_part")).applyInPandas(_put_stems(doc, text), f"`{doc}` {kind}, `{text}` string")
    if set(texts.columns) == {doc, text}:
        return stemmed
    return kept.drop(text).join(stemmed.dropDuplicates([doc]), doc)


def clean_corpus(review: DataFrame, text: str = "text", stem: bool = True, words: Sequence[str] = CORPUS_STOP_WORDS,
                 name: str = "clean", doc: str = "review_id") -> DataFrame:
    """Adds the cleaned text: lower case, no digits, stop words or punctuation, stemmed, single blanks.

    Stemming needs `doc`, a unique id: words leave their texts to be stemmed once each, and are put back in order.
    """
    cleaned = review.withColumn(name, corpus_text(text, words))
    if not stem:
        return cleaned
    texts = stem_texts(cleaned.select(doc, F.coalesce(name, F.lit("")).alias(name)), doc, name)
    return review.join(texts, doc)


def corpus_tokens(cleaned: DataFrame, *cols: str, n: int = 1, text: str = "clean") -> DataFrame:
    """Words, or n-grams of consecutive words, of a cleaned text."""
    tokens = blank_words(text)
    return cleaned.select(*cols, (ngrams(tokens, n) if n > 1 else tokens).alias("tokens"))


def doc_terms(tokens: DataFrame, doc: str | Sequence[str] = "review_id", min_len: int = 3, col: str = "tokens") -> DataFrame:
    """(doc, term, n) with terms of at least `min_len` characters."""
    docs = [doc] if isinstance(doc, str) else list(doc)
    terms = explode_words(tokens, col, "term", *docs).filter(F.length("term") >= min_len)
    return terms.groupBy(*docs, "term").agg(F.count(F.lit(1)).alias("n"))


def count_docs(dtm: DataFrame, doc: str) -> DataFrame:
    """Documents of a matrix, in one row; keeps n for the reason given at doc_freq."""
    return dtm.groupBy(doc).agg(F.max("n").alias("_m")).agg(F.count_if(F.col("_m") > 0).alias("docs"))


def stored_matrix(dtm: DataFrame) -> tuple[DataFrame, int | None]:
    """The matrix, written once in order of the terms (neighbours pack well in files and shuffles), and the parts for its
    shuffles by term: enough that their rows fit into memory, or None for the usual number. Runs jobs when called."""
    kept = cut_lineage(dtm.sortWithinPartitions("term"), "matrix")
    rows, usual = kept.count(), int(dtm.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return kept, math.ceil(rows / PART_ROWS) if rows > usual * PART_ROWS else None


def _by_term(dtm: DataFrame, parts: int | None) -> DataFrame:
    return dtm if parts is None else dtm.repartition(parts, "term")


def drop_sparse(dtm: DataFrame, docs: DataFrame, sparsity: float, part_rows: int | None = None,
                doc: str = "review_id", in_all_parts: bool = False) -> DataFrame:
    """Terms in more than (1 - sparsity) of the documents.

    At most (terms per document) / (1 - sparsity) terms can pass, whatever the size of the data, so the
    kept list is broadcast. With `part_rows` the rule holds within parts of that many documents in id
    order, and the part number is added; `in_all_parts` then keeps terms that passed in every part.
    """
    share = 1.0 - sparsity
    if part_rows is None:
        total = docs.agg(F.count(F.lit(1))).scalar()
        dtm, parts = stored_matrix(dtm)
        kept = doc_freq(_by_term(dtm.select("term", "n"), parts)).filter(F.col("num") > total * share).select("term")
        return dtm.join(F.broadcast(kept), "term").select(*dtm.columns)
    numbered = global_positions(docs.select(doc), doc, "_n").select(
        doc, F.floor((F.col("_n") - 1) / part_rows).alias("part")
    )
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("_docs"))
    placed = dtm.join(numbered, doc)
    kept = (
        placed.groupBy("part", "term").agg(F.count_if(F.col("n") > 0).alias("_df")).join(sizes, "part")
        .filter(F.col("_df") > F.col("_docs") * share).select("part", "term")
    )
    dense = placed.join(kept, ["part", "term"]).select(*placed.columns)
    return dense.join(terms_in_all_parts(kept, "part", parts=sizes), "term", "left_semi") if in_all_parts else dense


def bigram_dtm(review: DataFrame, sparsity: float | None = 0.98, doc: str = "review_id", text: str = "text",
               stem: bool = True) -> DataFrame:
    """Bigram matrix of the cleaned texts, without sparse bigrams unless sparsity is None."""
    tokens = corpus_tokens(clean_corpus(review, text, stem, doc=doc), doc, n=2)
    dtm = doc_terms(tokens, doc)
    return dtm if sparsity is None else drop_sparse(dtm, review, sparsity, doc=doc)


def bigram_recommendations(review: DataFrame, n: int = 5, sparsity: float | None = 0.98, stem: bool = True,
                           key: str = "business_id", doc: str = "review_id") -> DataFrame:
    """Top bigrams of each business (by reviews that hold them, ties kept) with its mean stars and reviews."""
    held = bind_meta(bigram_dtm(review, sparsity, doc, stem=stem), review, doc, [key])
    return left_stats(top_n_ties(doc_freq_by(held, key), key, "num", n), business_stats(review, key), key)


def business_bigrams(freq: DataFrame, business_id, n: int = 30, key: str = "business_id") -> DataFrame:
    """The n most frequent bigrams of one business from a table of doc_freq_by."""
    return top_words_limit(for_business(freq, business_id, key), key, n, "num", "term")


def prune_vocab(dtm: DataFrame, docs: DataFrame, min_df: int = 20, max_share: float = 0.1,
                keep: int | None = 100_000) -> DataFrame:
    """Terms in at least `min_df` and at most `max_share` of the documents, the `keep` most common of them (None: all)."""
    total = docs.agg(F.count(F.lit(1))).scalar()
    terms = doc_freq(dtm).filter((F.col("num") >= min_df) & (F.col("num") <= total * max_share))
    return terms if keep is None else terms.orderBy(F.desc("num"), "term").limit(keep)  # at most `keep` rows


def bow_by_business(dtm: DataFrame, key: str = "business_id", vocab: DataFrame | None = None) -> DataFrame:
    """(business, term, n): all reviews of a business as one document, from a matrix that holds the business.

    Counts are added per business; the tokens of a business never meet in one row.
    """
    if vocab is not None:
        dtm = spread_join(dtm, vocab.select("term"), "term", [c for c in dtm.columns if c not in ("term", "n")][0])
    return dtm.groupBy(key, "term").agg(F.sum("n").alias("n"))


def tfidf(dtm: DataFrame, variant: str = "log2", doc: str = "review_id") -> DataFrame:
    """(doc, term, weight), each document scaled to length 1.

    log2: n * log2(N / df); terms in every document weigh nothing and are left out.
    smooth: n * (ln((1 + N) / (1 + df)) + 1).
    """
    dtm, parts = stored_matrix(dtm.select(doc, "term", "n"))
    total = count_docs(dtm, doc).scalar().cast("double")
    df = doc_freq(_by_term(dtm.select("term", "n"), parts))
    if variant == "log2":
        idf = F.log2(total / F.col("num"))
    elif variant == "smooth":
        idf = F.log((1 + total) / (1 + F.col("num"))) + 1
    else:
        raise ValueError(f"unknown variant {variant!r}")
    weighted = spread_join(dtm, df.select("term", idf.alias("_idf")), "term", doc, parts=parts).select(
        doc, "term", (F.col("n") * F.col("_idf")).alias("_w")
    ).filter(F.col("_w") != 0)
    # a window holds the distinct terms of one document
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(doc)))
    return weighted.select(doc, "term", (F.col("_w") / norm).alias("weight"))


def stemmed_tfidf(texts: DataFrame, doc: str = "file_name", text: str = "text",
                  words: Sequence[str] = STOP_WORDS, rules: Rules = steps) -> DataFrame:
    """Smoothed TF-IDF over the stems of a directory of texts.

    Punctuation goes first, words are counted per document, each distinct word is stemmed once (`rules`: `steps`, or
    `porter_steps` for the first English stemmer), and the counts of words with one stem are added. Stems in `words` are
    left out.
    """
    bare = F.regexp_replace(F.lower(text), r"\p{Punct}+", "")
    tokens = texts.select(doc, F.filter(F.split(bare, r"\s+"), lambda w: w != "").alias("tokens"))
    counted = doc_terms(tokens, doc, min_len=1)
    stems = stem_terms(counted, "term", by=doc, rules=rules).filter(~F.col("stem").isin(list(words)))
    merged = stems.groupBy(doc, F.col("stem").alias("term")).agg(F.sum("n").alias("n"))
    return tfidf(merged, "smooth", doc)


def prune_bigrams(dtm: DataFrame, min_total: int = 300, stop: Sequence[str] = STOP_BIGRAMS,
                  doc: str = "review_id") -> DataFrame:
    """Bigrams with a column total of at least `min_total` that are no stop bigrams.

    Documents without any kept bigram have no row left. Runs jobs when called, which write the matrix.
    """
    dtm, parts = stored_matrix(dtm)
    kept = term_totals(drop_terms(_by_term(dtm.select("term", "n"), parts), stop), min_total).select("term")
    return spread_join(dtm, kept, "term", doc, parts=parts).select(*dtm.columns)

