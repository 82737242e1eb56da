"""Registered queries: words, corpus, n-grams, TF-IDF, models, composites."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.functions.porter import porter_steps
from reviewloom.functions.stemming import stemmed_sql, steps
from reviewloom.functions.text import blank_words, drop_stopwords, ngrams, simple_tokens, tokenize
from reviewloom.functions.words import CORPUS_STOP_WORDS, STOP_BIGRAMS, STOP_WORDS
from reviewloom.operators import aggregates as A, corpus as T, filters as P, ranking as K, reviewwords as R
from reviewloom.operators.joins import bind_meta
from reviewloom.plans import fixtures as V
from reviewloom.plans.registry import query


def r6(col):
    return F.round(col, 6)


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


# ---- tokens

_STOP = f"({_quoted(STOP_WORDS)})"
_TOKENS = f"""
t AS (SELECT review_id, business_id, stars, list_filter(regexp_split_to_array(lower(text), '\\W+'),
 lambda w: w <> '' AND w NOT IN {_STOP}) AS tokens FROM v_text_review),
w AS (SELECT review_id, business_id, stars, unnest(tokens) AS word FROM t)"""


@query("t1_tokenize", """
SELECT review_id, array_to_string(list_filter(regexp_split_to_array(lower(text), '\\W+'), lambda w: w <> ''), ' ') AS words FROM v_text_review""")
def _(spark, sf):
    return V.text_review(spark, sf).select("review_id", F.array_join(tokenize("text"), " ").alias("words"))


@query("t2_drop_stopwords", "WITH " + _TOKENS + " SELECT review_id, array_to_string(tokens, ' ') AS words FROM t")
def _(spark, sf):
    return V.text_review(spark, sf).select("review_id", F.array_join(drop_stopwords(tokenize("text")), " ").alias("words"))


@query("a17_token_counts", "WITH " + _TOKENS + " SELECT business_id, word, count(*) AS frequency FROM w GROUP BY 1, 2")
def _(spark, sf):
    return A.token_counts(R.review_tokens(V.text_review(spark, sf), "business_id"), "business_id")


def _top_words_sql(where: str) -> str:
    return "WITH " + _TOKENS + f""", c AS (SELECT business_id, word, count(*) AS n FROM w WHERE {where} GROUP BY 1, 2)
SELECT business_id, word, round(n / max(n) OVER (PARTITION BY business_id) * 60.0::DOUBLE, 6) AS frequency FROM c
QUALIFY row_number() OVER (PARTITION BY business_id ORDER BY n DESC, word) <= 35"""


def _top_words(kind):
    def run(spark, sf):
        return R.top_words(V.text_review(spark, sf), kind).withColumn("frequency", r6("frequency"))

    return run


query("t3_top_words", _top_words_sql("true"))(_top_words("all"))
query("t3_top_good_words", _top_words_sql("stars >= 4"))(_top_words("good"))
query("t3_top_bad_words", _top_words_sql("stars < 3"))(_top_words("bad"))


@query("k2_top_words_limit", "WITH " + _TOKENS + """, c AS (SELECT business_id, word, count(*) AS frequency FROM w GROUP BY 1, 2)
SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY business_id ORDER BY frequency DESC, word) <= 30""")
def _(spark, sf):
    counts = A.token_counts(R.review_tokens(V.text_review(spark, sf), "business_id"), "business_id")
    return K.top_words_limit(counts, "business_id", 30)


_CLASSES = _TOKENS + """,
c AS (SELECT business_id, word, count(*) FILTER (stars >= 4) AS g, count(*) FILTER (stars < 4) AS b FROM w GROUP BY 1, 2),
k AS (SELECT business_id FROM v_text_review GROUP BY 1 HAVING bool_or(stars >= 4) AND bool_or(stars < 4))"""


@query("t4_word_ratios", "WITH " + _CLASSES + """,
m AS (SELECT business_id, sum(g) AS ng, sum(b) AS nb, count(*) AS v FROM c GROUP BY 1)
SELECT business_id, word, round((b + 1)::DOUBLE / (nb + v), 9) AS p_bad, round((g + 1)::DOUBLE / (ng + v), 9) AS p_good,
round(((g + 1)::DOUBLE / (ng + v)) / ((b + 1)::DOUBLE / (nb + v)), 6) AS ratio FROM c JOIN m USING (business_id) WHERE business_id IN (SELECT business_id FROM k)""")
def _(spark, sf):
    ratios = R.word_ratios(V.text_review(spark, sf))
    return ratios.select("business_id", "word", F.round("p_bad", 9).alias("p_bad"), F.round("p_good", 9).alias("p_good"),
                         r6("ratio").alias("ratio"))


@query("t4_telling_words", "WITH " + _CLASSES + """,
r AS (SELECT business_id, word, (g + 1)::DOUBLE / (b + 1) AS r FROM c WHERE business_id IN (SELECT business_id FROM k)),
h AS (SELECT business_id, 'good' AS part, word, r AS f FROM r QUALIFY row_number() OVER (PARTITION BY business_id ORDER BY r DESC, word) <= 30),
l AS (SELECT business_id, 'bad' AS part, word, 1 / r AS f FROM r QUALIFY row_number() OVER (PARTITION BY business_id ORDER BY r, word DESC) <= 30)
SELECT business_id, part, word, round(f / max(f) OVER (PARTITION BY business_id, part) * 60.0::DOUBLE, 6) AS frequency FROM (SELECT * FROM h UNION ALL SELECT * FROM l)""")
def _(spark, sf):
    return R.telling_words(V.text_review(spark, sf)).withColumn("frequency", r6("frequency"))


@query("t5_holdout_accuracy", "WITH " + _TOKENS + """,
d AS (SELECT review_id, business_id, stars >= 4 AS good,
 ('0x' || substr(md5('1234#' || review_id), 1, 8))::BIGINT < 2576980377 AS train FROM v_text_review),
p AS (SELECT business_id, count(*) FILTER (train AND good) AS dg, count(*) FILTER (train AND NOT good) AS db FROM d GROUP BY 1),
x AS (SELECT d.review_id, d.business_id, good, train, word FROM w JOIN d ON d.review_id = w.review_id),
c AS (SELECT business_id, word, count(*) FILTER (train AND good) AS g, count(*) FILTER (train AND NOT good) AS b FROM x GROUP BY 1, 2),
m AS (SELECT business_id, sum(g) AS ng, sum(b) AS nb, count(*) AS v FROM c GROUP BY 1),
s AS (SELECT x.review_id, sum(ln((g + 1)::DOUBLE / (ng + v)) - ln((b + 1)::DOUBLE / (nb + v))) AS margin
 FROM x JOIN c ON c.business_id = x.business_id AND c.word = x.word JOIN m ON m.business_id = x.business_id WHERE NOT train GROUP BY 1)
SELECT d.business_id, count(*) AS tested, round(avg(((ln((dg + 1)::DOUBLE / (db + 1)) + coalesce(margin, 0) > 0) = good)::INTEGER), 6) AS accuracy
FROM d JOIN p ON p.business_id = d.business_id AND dg > 0 AND db > 0 LEFT JOIN s ON s.review_id = d.review_id WHERE NOT train GROUP BY 1""")
def _(spark, sf):
    return R.holdout_accuracy(V.text_review(spark, sf)).withColumn("accuracy", r6("accuracy"))


@query("t13_simple_tokens", f"""
SELECT review_id, array_to_string(list_filter(regexp_extract_all(lower(text), '[\\p{{L}}_]+'), lambda w: length(w) BETWEEN 2 AND 15
 AND NOT starts_with(w, '_') AND w NOT IN {_STOP}), ' ') AS words FROM v_text_review""")
def _(spark, sf):
    return V.text_review(spark, sf).select("review_id", F.array_join(simple_tokens("text"), " ").alias("words"))


@query("a23_tokens_per_key", "WITH " + _TOKENS + """
SELECT business_id, array_to_string(flatten(list(tokens ORDER BY review_id)), ' ') AS words FROM t GROUP BY 1""")
def _(spark, sf):
    # rows of 1,000 documents each; joined here because the SQL has one row per business
    tokens = R.review_tokens(V.text_review(spark, sf), "business_id", "review_id")
    chunks = A.tokens_per_key(tokens, "business_id", "review_id")
    return chunks.groupBy("business_id").agg(
        F.array_join(F.flatten(F.sort_array(F.collect_list(F.struct("chunk", "tokens")))["tokens"]), " ").alias("words")
    )


# ---- corpus. Words are marked on both sides, so that a pattern without look-around finds whole words.

_MARKED = "|".join(
    "\\x01" + w.replace("'", "\\x02''\\x01") + "\\x02" for w in sorted(CORPUS_STOP_WORDS, key=lambda w: (-len(w), w))
)
_CLEAN = f"""
m AS (SELECT review_id, business_id, stars, regexp_replace(regexp_replace(lower(text), '[0-9]+', '', 'g'),
 '([\\p{{L}}\\p{{M}}\\p{{N}}_]+)', chr(1) || '\\1' || chr(2), 'g') AS t FROM v_text_review),
cl AS (SELECT review_id, business_id, stars, trim(regexp_replace(regexp_replace(regexp_replace(t, '{_MARKED}', '', 'g'),
 '[[:punct:]\\x01\\x02]+', '', 'g'), '\\s+', ' ', 'g'), ' ') AS clean FROM m),
tk AS MATERIALIZED (SELECT review_id, business_id, stars, list_filter(string_split(clean, ' '), lambda w: w <> '') AS tokens FROM cl)"""
_STEMMED = _CLEAN.replace("cl AS (", "c0 AS (").split(",\ntk AS")[0] + f""",
sp AS MATERIALIZED (SELECT review_id, unnest(string_split(clean, ' ')) AS word, generate_subscripts(string_split(clean, ' '), 1) AS pos FROM c0),
st AS MATERIALIZED (SELECT word, _stem FROM {stemmed_sql("(SELECT DISTINCT word FROM sp)", "word")}),
sc AS (SELECT review_id, string_agg(_stem, ' ' ORDER BY pos) AS clean FROM sp JOIN st USING (word) GROUP BY 1),
cl AS (SELECT review_id, business_id, stars, sc.clean FROM c0 JOIN sc USING (review_id)),
tk""" + " AS" + _CLEAN.split(",\ntk AS")[1]
_DTM = _CLEAN + """,
dtm AS MATERIALIZED (SELECT review_id, term, count(*) AS n FROM (SELECT review_id, unnest(tokens) AS term FROM tk) WHERE length(term) >= 3 GROUP BY 1, 2)"""
_GRAMS = """,
bg AS MATERIALIZED (SELECT review_id, business_id, list_transform(list_zip(tokens[:-2], tokens[2:]), lambda p: p[1] || ' ' || p[2]) AS grams FROM tk WHERE len(tokens) >= 2),
dtm AS MATERIALIZED (SELECT review_id, any_value(business_id) AS business_id, term, count(*) AS n FROM (SELECT review_id, business_id, unnest(grams) AS term FROM bg) WHERE length(term) >= 3 GROUP BY review_id, term)"""
_BIGRAMS = _CLEAN + _GRAMS


def _clean(spark, sf, stem=False):
    return T.clean_corpus(V.text_review(spark, sf), stem=stem)


def _dtm(spark, sf):
    return T.doc_terms(T.corpus_tokens(_clean(spark, sf), "review_id"))


def _bigrams(spark, sf):
    return T.bigram_dtm(V.text_review(spark, sf), sparsity=None, stem=False)


@query("t6_clean_corpus", "WITH " + _CLEAN + " SELECT review_id, clean FROM cl")
def _(spark, sf):
    return _clean(spark, sf).select("review_id", "clean")


@query("t6_clean_stemmed_corpus", "WITH " + _STEMMED + " SELECT review_id, clean FROM cl")
def _(spark, sf):
    return _clean(spark, sf, stem=True).select("review_id", "clean")


@query("t7_stem_terms", "WITH " + _DTM + " SELECT term, _stem AS stem FROM " + stemmed_sql("(SELECT DISTINCT term FROM dtm)", "term"))
def _(spark, sf):
    return T.word_stems(_dtm(spark, sf), "term")


@query("t8_doc_terms", "WITH " + _DTM + " SELECT * FROM dtm")
def _(spark, sf):
    return _dtm(spark, sf)


@query("t9_drop_sparse", "WITH " + _DTM + """
SELECT review_id, term, n FROM dtm WHERE term IN (SELECT term FROM dtm GROUP BY 1 HAVING count(*) > (SELECT count(*) FROM v_text_review) * (1.0 - 0.95::DOUBLE))""")
def _(spark, sf):
    return T.drop_sparse(_dtm(spark, sf), V.text_review(spark, sf), 0.95).select("review_id", "term", "n")


_PARTS = _DTM + """,
pt AS (SELECT review_id, CAST(floor((row_number() OVER (ORDER BY review_id) - 1) / 250) AS BIGINT) AS part FROM v_text_review),
sz AS (SELECT part, count(*) AS docs FROM pt GROUP BY 1),
kp AS (SELECT part, term FROM dtm JOIN pt USING (review_id) JOIN sz USING (part) GROUP BY part, term HAVING count(*) > any_value(docs) * (1.0 - 0.95::DOUBLE))"""


@query("t9_drop_sparse_by_part", "WITH " + _PARTS + " SELECT review_id, part, term, n FROM dtm JOIN pt USING (review_id) JOIN kp USING (part, term)")
def _(spark, sf):
    sparse = T.drop_sparse(_dtm(spark, sf), V.text_review(spark, sf), 0.95, part_rows=250)
    return sparse.select("review_id", "part", "term", "n")


@query("t9_terms_of_all_parts", "WITH " + _PARTS + """, al AS (SELECT term FROM kp GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT part) FROM sz))
SELECT review_id, part, term, n FROM dtm JOIN pt USING (review_id) JOIN kp USING (part, term) WHERE term IN (SELECT term FROM al)""")
def _(spark, sf):
    sparse = T.drop_sparse(_dtm(spark, sf), V.text_review(spark, sf), 0.95, part_rows=250, in_all_parts=True)
    return sparse.select("review_id", "part", "term", "n")


@query("t10_ngrams", "WITH " + _BIGRAMS + " SELECT review_id, array_to_string(grams, '|') AS grams FROM bg")
def _(spark, sf):
    grams = _clean(spark, sf).select("review_id", ngrams(blank_words("clean")).alias("grams"))
    return grams.filter(F.size("grams") > 0).select("review_id", F.array_join("grams", "|").alias("grams"))


@query("a14_doc_freq", "WITH " + _DTM + " SELECT term, count(*) AS num FROM dtm GROUP BY 1")
def _(spark, sf):
    return A.doc_freq(_dtm(spark, sf))


@query("a15_doc_freq_by_business", "WITH " + _BIGRAMS + " SELECT business_id, term, count(*) AS num FROM dtm GROUP BY 1, 2")
def _(spark, sf):
    held = bind_meta(_bigrams(spark, sf), V.text_review(spark, sf), cols=["business_id"])
    return A.doc_freq_by(held)


@query("a16_term_totals", "WITH " + _DTM + " SELECT term, CAST(sum(n) AS BIGINT) AS freq FROM dtm GROUP BY 1 HAVING sum(n) >= 300")
def _(spark, sf):
    return A.term_totals(_dtm(spark, sf), 300)


@query("j10_bind_meta", "WITH " + _DTM + " SELECT dtm.review_id, term, n, business_id, stars FROM dtm JOIN v_text_review USING (review_id)")
def _(spark, sf):
    return bind_meta(_dtm(spark, sf), V.text_review(spark, sf))


@query("k12_cloud_feed", "WITH " + _DTM + ", f AS (SELECT term, CAST(sum(n) AS BIGINT) AS freq FROM dtm GROUP BY 1) SELECT * FROM f WHERE freq >= 3 ORDER BY freq DESC, term LIMIT 300")
def _(spark, sf):
    return K.cloud_feed(A.term_totals(_dtm(spark, sf)))


@query("k13_first_docs", "SELECT review_id, business_id, stars FROM v_text_review ORDER BY review_id LIMIT 200")
def _(spark, sf):
    return K.first_docs(V.text_review(spark, sf), 200).select("review_id", "business_id", "stars")


_TOP_GRAMS = """,
fr AS (SELECT business_id, term, count(*) AS num FROM kept GROUP BY 1, 2),
tp AS (SELECT * FROM fr QUALIFY rank() OVER (PARTITION BY business_id ORDER BY num DESC) <= 5)
SELECT business_id, term, num, round(avg_stars, 6) AS avg_stars, num_reviews FROM tp LEFT JOIN
(SELECT business_id, avg(stars) AS avg_stars, count(*) AS num_reviews FROM v_text_review GROUP BY 1) USING (business_id)"""


_KEPT_GRAMS = """,
kept AS (SELECT * FROM dtm WHERE term IN (SELECT term FROM dtm GROUP BY 1 HAVING count(*) > (SELECT count(*) FROM v_text_review) * (1.0 - 0.98::DOUBLE)))"""


@query("t11_bigram_recommendations", "WITH " + _BIGRAMS + _KEPT_GRAMS + _TOP_GRAMS)
def _(spark, sf):
    return T.bigram_recommendations(V.text_review(spark, sf), stem=False).withColumn("avg_stars", r6("avg_stars"))


@query("t11_stemmed_recommendations", "WITH " + _STEMMED + _GRAMS + _KEPT_GRAMS + _TOP_GRAMS)
def _(spark, sf):
    return T.bigram_recommendations(V.text_review(spark, sf)).withColumn("avg_stars", r6("avg_stars"))


@query("t12_business_bigrams", "WITH " + _BIGRAMS + """
SELECT business_id, term, count(*) AS num FROM dtm WHERE business_id = 'src3' GROUP BY 1, 2 ORDER BY num DESC, term LIMIT 30""")
def _(spark, sf):
    one = P.for_business(V.text_review(spark, sf), "src3")
    grams = T.bigram_dtm(one, sparsity=None, stem=False)
    return T.business_bigrams(A.doc_freq_by(bind_meta(grams, one, cols=["business_id"])), "src3")


_SIMPLE = f"""
st AS (SELECT review_id, business_id, unnest(list_filter(regexp_extract_all(lower(text), '[\\p{{L}}_]+'), lambda w: length(w) BETWEEN 2 AND 15
 AND NOT starts_with(w, '_') AND w NOT IN {_STOP})) AS term FROM v_text_review),
vo AS (SELECT term, count(DISTINCT review_id) AS num FROM st GROUP BY 1 HAVING num >= 20 AND num <= (SELECT count(*) FROM v_text_review) * 0.1::DOUBLE
 ORDER BY num DESC, term LIMIT 100000)"""


def _simple(spark, sf):
    tokens = V.text_review(spark, sf).select("review_id", "business_id", simple_tokens("text").alias("tokens"))
    return T.doc_terms(tokens, ["review_id", "business_id"], min_len=1)


def _bow(spark, sf):
    dtm = _simple(spark, sf)
    return T.bow_by_business(dtm, vocab=T.prune_vocab(dtm, V.text_review(spark, sf)))


@query("t14_prune_vocab", "WITH " + _SIMPLE + " SELECT term, num FROM vo")
def _(spark, sf):
    return T.prune_vocab(_simple(spark, sf), V.text_review(spark, sf))


@query("t15_bow_by_business", "WITH " + _SIMPLE + " SELECT business_id, term, count(*) AS n FROM st WHERE term IN (SELECT term FROM vo) GROUP BY 1, 2")
def _(spark, sf):
    return _bow(spark, sf)


@query("t16_tfidf_log2", "WITH " + _SIMPLE + """,
bw AS (SELECT business_id, term, count(*) AS n FROM st WHERE term IN (SELECT term FROM vo) GROUP BY 1, 2),
wt AS (SELECT business_id, term, n * log2((SELECT count(DISTINCT business_id) FROM bw) / count(*) OVER (PARTITION BY term)) AS w FROM bw)
SELECT business_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY business_id)), 6) AS weight FROM wt WHERE w <> 0""")
def _(spark, sf):
    return T.tfidf(_bow(spark, sf), "log2", "business_id").withColumn("weight", r6("weight"))


@query("t17_tfidf_smooth", "WITH " + _DTM + """,
wt AS (SELECT review_id, term, n * (ln((1 + (SELECT count(DISTINCT review_id) FROM dtm))::DOUBLE / (1 + count(*) OVER (PARTITION BY term))) + 1) AS w FROM dtm)
SELECT review_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY review_id)), 6) AS weight FROM wt""")
def _(spark, sf):
    return T.tfidf(_dtm(spark, sf), "smooth").withColumn("weight", r6("weight"))


def _stemmed_weights(rules):
    return f"""
WITH w AS MATERIALIZED (SELECT doc_id, unnest(regexp_split_to_array(regexp_replace(lower(text), '[[:punct:]]+', '', 'g'), '[ \\t\\n\\x0B\\f\\r]+')) AS word FROM documents),
c AS MATERIALIZED (SELECT doc_id, word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1, 2),
st AS MATERIALIZED (SELECT word, _stem FROM {stemmed_sql("(SELECT DISTINCT word FROM c)", "word", rules)}),
dtm AS MATERIALIZED (SELECT doc_id, _stem AS term, sum(n) AS n FROM c JOIN st USING (word) WHERE _stem NOT IN ({_quoted(STOP_WORDS)}) GROUP BY 1, 2),
wt AS (SELECT doc_id, term, n * (ln((1 + (SELECT count(DISTINCT doc_id) FROM dtm))::DOUBLE / (1 + count(*) OVER (PARTITION BY term))) + 1) AS w FROM dtm)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM wt"""


@query("t17_stemmed_tfidf", _stemmed_weights(steps))
def _(spark, sf):
    texts = V.raw(spark, sf, "documents").select("doc_id", "text")
    return T.stemmed_tfidf(texts, doc="doc_id").withColumn("weight", r6("weight"))


@query("t17_first_porter_tfidf", _stemmed_weights(porter_steps))
def _(spark, sf):
    texts = V.raw(spark, sf, "documents").select("doc_id", "text")
    return T.stemmed_tfidf(texts, doc="doc_id", rules=porter_steps).withColumn("weight", r6("weight"))


_PRUNED = _BIGRAMS + f""",
tt AS (SELECT term FROM dtm WHERE term NOT IN ({_quoted(STOP_BIGRAMS)}) GROUP BY 1 HAVING sum(n) >= 10),
pr AS (SELECT review_id, term, n FROM dtm WHERE term IN (SELECT term FROM tt))"""


def _pruned(spark, sf):
    return T.prune_bigrams(_bigrams(spark, sf), 10)


@query("f10_drop_empty_docs", "WITH " + _PRUNED + " SELECT review_id, business_id FROM v_text_review WHERE review_id IN (SELECT review_id FROM pr)")
def _(spark, sf):
    docs = V.text_review(spark, sf).select("review_id", "business_id")
    return P.drop_empty_docs(docs, _pruned(spark, sf), "review_id")


@query("f11_drop_terms", "WITH " + _DTM + " SELECT * FROM dtm WHERE term NOT IN ('con', 'las', 'los')")
def _(spark, sf):
    return P.drop_terms(_dtm(spark, sf), ["con", "las", "los"])


@query("t21_prune_bigrams", "WITH " + _PRUNED + " SELECT * FROM pr")
def _(spark, sf):
    return _pruned(spark, sf)
