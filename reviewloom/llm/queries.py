"""One registered query per operator, over whole tables, and its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewloom.llm.alignment import alignments
from reviewloom.llm.chat import flat, preference_examples, with_other_replies
from reviewloom.llm.decontam import contamination
from reviewloom.llm.jaccard import near_duplicates
from reviewloom.llm.langid import language_table
from reviewloom.llm.licenses import license_labels
from reviewloom.llm.linededup import LineIndex
from reviewloom.llm.mixing import mix_sizes
from reviewloom.llm.pii import surrogate_texts
from reviewloom.llm.token_counts import token_counts
from reviewloom.llm.topk import top_products
from reviewloom.llm.trie import prefix_trie, turn_paths
from reviewloom.llm.urls import hosts_with_words, rule_table, url_verdicts

#: of the registered queries; real use passes a secret key
SURROGATE_KEY = "registered query"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_token_counts")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(read(spark, sf, "documents"), tokenizer("byte_bpe_50k.json"))


#: parts of the SQL: lower case of A-Z only, words of the two kinds
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
BLANK = rf"regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+')"


@query("op7_jaccard_join", f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {BLANK} AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
u AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT a AS x, a AS y FROM u UNION SELECT r.x, u.b FROM r JOIN u ON r.y = u.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.y, d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT x, min(y) AS y FROM r GROUP BY 1) c ON c.x = d.doc_id
""")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(read(spark, sf, "documents"), size=4, percent=85)


@query("op9_decontaminate", f"""
WITH i AS (SELECT item_id, {ALNUM} AS w FROM benchmark),
v AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
d AS MATERIALIZED (SELECT doc_id, {ALNUM} AS w FROM documents),
k AS (SELECT DISTINCT k FROM v),
x AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d CROSS JOIN k WHERE len(w) >= k)),
m AS MATERIALIZED (SELECT x.doc_id, x.p, x.k, v.item_id FROM x JOIN v ON x.k = v.k AND x.g = v.g),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
  SELECT doc_id, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT doc_id, p, k FROM m)) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
""")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return contamination(read(spark, sf, "documents"), read(spark, sf, "benchmark")).drop("longest")


#: The rules that decide before the method does
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
#: hosts of the corpus with one of these as a part of their name make up the list of unwanted hosts
UNWANTED = ("adult", "ads", "bets", "casino", "pills", "spam")


@query("op1_url_cascade", f"""
WITH r(rhost, rpath, v) AS (VALUES {', '.join(str(r) for r in URL_RULES)}),
a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS h FROM a),
c AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, len(h) + 1), '^([^?#]*)', 1) AS path FROM b),
m AS (SELECT page_id, arg_max(struct_pack(rule := rhost || rpath, v := v), len(rhost || rpath) * 10000 + len(rhost)) AS best
  FROM c JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY 1)
SELECT c.page_id, host, path, best.rule AS rule, CASE WHEN best IS NOT NULL THEN best.v
  WHEN regexp_matches(host, '(^|[.-])({'|'.join(UNWANTED)})([.-]|$)') THEN 'block' ELSE 'allow' END AS verdict
FROM c LEFT JOIN m ON m.page_id = c.page_id
""")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    pages = read(spark, sf, "pages")
    return url_verdicts(pages, rule_table(spark, URL_RULES), hosts_with_words(pages, UNWANTED))


@query("op6_preference_format", """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role,
  replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') AS text FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text FROM t WHERE role = 'assistant' GROUP BY 1),
x AS (SELECT t.conv_id, t.turn, t.role, CASE WHEN l.turn = t.turn AND t.role = 'assistant' THEN o.text ELSE t.text END AS text
  FROM t LEFT JOIN l ON l.conv_id = t.conv_id LEFT JOIN l o ON o.conv_id = xor(t.conv_id, 1)
  WHERE NOT coalesce(l.turn = t.turn AND t.role = 'assistant' AND o.conv_id IS NULL, false)),
c AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS p FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS p FROM x),
k AS (SELECT conv_id, coalesce(min(CASE WHEN c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text THEN p END) - 1, max(p)) AS n
  FROM c FULL JOIN r USING (conv_id, p) GROUP BY 1),
s AS (SELECT conv_id, p, 1 AS side, role, text FROM c UNION ALL SELECT conv_id, p, 2, role, text FROM r),
g AS (SELECT s.*, n, '<|im_start|>' || role || chr(10) AS head, text || '<|im_end|>' || chr(10) AS body FROM s JOIN k ON k.conv_id = s.conv_id),
f AS (SELECT *, CAST(-len(head) AS VARCHAR) || ',' || CAST(CASE WHEN role = 'assistant' THEN len(body) ELSE -len(body) END AS VARCHAR) AS mask FROM g)
SELECT conv_id, max(n) AS n_prompt,
  coalesce(string_agg(head || body, '' ORDER BY p) FILTER (WHERE side = 1 AND p <= n), '') AS prompt,
  coalesce(string_agg(head || body, '' ORDER BY p) FILTER (WHERE side = 1 AND p > n), '') AS chosen,
  coalesce(string_agg(mask, ',' ORDER BY p) FILTER (WHERE side = 1 AND p > n), '') AS chosen_mask,
  coalesce(string_agg(head || body, '' ORDER BY p) FILTER (WHERE side = 2 AND p > n), '') AS rejected,
  coalesce(string_agg(mask, ',' ORDER BY p) FILTER (WHERE side = 2 AND p > n), '') AS rejected_mask
FROM f GROUP BY 1
""")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    turns = read(spark, sf, "conversations")
    pairs = preference_examples(turns, with_other_replies(turns))
    (chosen, chosen_mask), (rejected, rejected_mask) = flat("chosen"), flat("rejected")
    return pairs.select(
        "conv_id", "n_prompt", "prompt", chosen.alias("chosen"), chosen_mask.alias("chosen_mask"),
        rejected.alias("rejected"), rejected_mask.alias("rejected_mask"),
    )


@query("op8_mix_to_weights", """
WITH d AS (SELECT doc_id, source, md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS key,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, [5e0, 2e0, 1e0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, source_size * 2e0 AS cap FROM s),
c AS (SELECT *, coalesce(sum(cap) OVER b, 0e0) AS capped, coalesce(sum(weight) OVER b, 0e0) AS gone,
  1.5e0 * CAST(sum(source_size) OVER () AS DOUBLE) AS budget, sum(weight) OVER () AS weights FROM w
  WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (budget - capped) / (weights - gone) AS level FROM c),
t AS (SELECT source, source_size, least(cap, coalesce(
  (SELECT level FROM l WHERE level <= cap / weight ORDER BY cap / weight, gone LIMIT 1) * weight, cap)) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM t),
q AS (SELECT d.doc_id, d.size, p.*, sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS first
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size,
  CAST(floor(target) AS BIGINT) - whole * source_size - first)) AS BIGINT) AS taken FROM q
""")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return mix_sizes(read(spark, sf, "documents"))


@query("op4_top_products", """
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024e0 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
""")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return top_products(read(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op5_license_scan")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return license_labels(read(spark, sf, "documents")).drop("spans")


@query("op3_language_centroids")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return language_table(read(spark, sf, "documents"))


@query("op10_surrogates")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return surrogate_texts(read(spark, sf, "documents"), SURROGATE_KEY)


@query("op11_prefix_trie", """
WITH o AS MATERIALIZED (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
  ORDER BY turn NULLS FIRST, md5(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(CAST(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda crc, b: CASE WHEN xor(crc, b) % 2 = 1 THEN xor(xor(crc, b) >> 1, CAST(3988292384 AS BIGINT)) ELSE xor(crc, b) >> 1 END) AS BIGINT),
    CAST(4294967295 AS BIGINT)) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM o)),
t AS (SELECT h.conv_id, 0 AS side, p, role, text FROM h JOIN o ON o.conv_id = h.base AND p <= h
  UNION ALL SELECT h.conv_id, 1, p, role, text FROM h JOIN o ON o.conv_id = h.conv_id AND p > h),
l AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY side, p) AS turns FROM t GROUP BY 1),
r AS MATERIALIZED (SELECT h.conv_id, coalesce(turns, []) AS turns FROM h LEFT JOIN l ON l.conv_id = h.conv_id),
n AS MATERIALIZED (SELECT turns[:d] AS path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(turns) = d), '') AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM r) GROUP BY 1, 2),
k AS (SELECT path[:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
v AS MATERIALIZED (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * len(n.path[depth].t) ELSE 0 END AS own
  FROM n LEFT JOIN k ON k.path = n.path),
s AS (SELECT path[:d] AS path, d AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(own) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM v) GROUP BY 1, 2)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, sha256(v.ends) AS ends_sha256
FROM v JOIN s ON s.path = v.path AND s.depth = v.depth LEFT JOIN n u ON v.depth > 0 AND u.depth = v.depth - 1 AND u.path = v.path[:v.depth - 1]
""")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie(with_shared_starts(turn_paths(read(spark, sf, "conversations"))))


def with_shared_starts(paths: DataFrame) -> DataFrame:
    """Each conversation with its first h turns replaced by those of the first conversation of its hundred."""
    first = paths.where("id % 100 = 0").select(F.col("id").alias("base"), F.slice("turns", 1, 5).alias("start"))
    h = (F.crc32(F.col("id").cast("string")) % 6).cast("int")
    both = paths.select("*", h.alias("h"), (F.col("id") - F.col("id") % 100).alias("base")).join(first, "base", "left")
    own = F.expr("slice(turns, h + 1, size(turns))")
    return both.select("id", F.when(F.col("start").isNull(), own).otherwise(F.concat(F.expr("slice(start, 1, h)"), own)).alias("turns"))


@query("op12_line_dedup", """
WITH l AS (SELECT *, unnest(range(1, len(lines) + 1)) AS p FROM (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
b AS (SELECT list_reduce(list_transform([32, 9, 10, 11, 12, 13], lambda c: chr(c)), lambda x, y: x || y) AS blanks),
k AS MATERIALIZED (SELECT r, doc_id, p, lines[p] AS line,
  translate(trim(lines[p], blanks), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l, b),
n AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE doc_id <> last) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE doc_id <> last IS NOT TRUE), '')) AS kept_sha256
FROM k LEFT JOIN n USING (key) GROUP BY r
""")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    found = LineIndex.empty(spark).insert(docs).clean(docs)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_tokenizer_alignment")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    found = alignments(read(spark, sf, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))
