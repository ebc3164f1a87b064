"""Registered queries of this package and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import ball_tree, chat_format, compression_quality, lang_id, language_model, packing, piece_lattice, quality_rules, sharding, simhash, source_audit, topk, url_filters
from tillroll.llm.common import crc_mod, table
from tillroll.llm.url_filters import Rule

URL_RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
             Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]
QUALITY_THRESHOLD = 0.3


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign_shards(table(spark, sf_dir, "documents"), shards=16)
    return out.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def listed_urls(pages: DataFrame) -> DataFrame:
    """A block list as the tables hold none: by the digest of the canonical URL one in 16 of the pages' URLs, and one
    in 16 with a further path segment, which are mostly no page's."""
    url = F.col("url").cast("string")
    canonical = url_filters.canonical_url(url_filters.url_host(url), url_filters.url_path(url))
    digit = F.substring(F.md5(F.col("canonical").cast("binary")), 1, 1)
    return (pages.select(canonical.alias("canonical")).where(F.col("canonical") != "")
            .select(F.when(digit == "0", F.col("canonical")).when(digit == "1", F.concat("canonical", F.lit("/listed"))).alias("url"))
            .where(F.col("url").isNotNull()))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.filter_urls(pages, URL_RULES, listed_urls(pages)).drop("maybe_listed")


def op2_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lattice.nbest_segmentations(table(spark, sf_dir, "documents"), n=3)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge_quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_dedup(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return out.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), window=2048, end_id=1)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = crc_mod("doc_id", 7)
    docs = table(spark, sf_dir, "documents")
    out = language_model.score_texts(docs, learn=part != 2, deleted=part == 5)
    return out.select("doc_id", (part == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def language_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(crc_mod("doc_id", 4) != 2)


def naive_bayes(spark: SparkSession, sf_dir: str) -> lang_id.LanguageModel:
    return lang_id.train(language_rows(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = naive_bayes(spark, sf_dir)
    out = table(spark, sf_dir, "documents").select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"),
        lang_id.predict(spark, F.col("text"), model).alias("lang"))
    return out.select("doc_id", "held_out", "lang.lang_pred", "lang.score")


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def quality_model(spark: SparkSession, sf_dir: str) -> compression_quality.CompressionModel:
    learn = crc_mod("doc_id", 5) != 0
    return compression_quality.train(table(spark, sf_dir, "documents").where(learn),
                                     table(spark, sf_dir, "labels").where(learn))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = compression_quality.quality_score(spark, F.col("text"), quality_model(spark, sf_dir))
    return (table(spark, sf_dir, "documents")
            .select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= QUALITY_THRESHOLD).cast("int")))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit_sources(table(spark, sf_dir, "documents"))


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's conversations and one, -1, whose texts are control strings."""
    hard = spark.createDataFrame([(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))],
                                 "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return chat_format.read_back(chat_format.format_turns(rows))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES = {f.__name__: f for f in (op1_sharding, op2_sentencepiece_nbest, op3_quality_rules, op4_simhash_dedup, op5_packing, op6_lm_scoring, op7_language_id, op8_url_filters,
                                op9_exact_topk, op10_quality_classifier, op11_source_audit, op12_chat_formatting, op13_ranked_search)}

ORACLE = {
    "op13_ranked_search": r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
d AS (SELECT *, len(terms) AS n FROM t WHERE len(terms) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS documents, CAST(sum(n) AS BIGINT) AS total FROM d),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
g AS (SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * documents) // total))) AS gain FROM tf, s),
i AS (
  SELECT DISTINCT q, item_id, term FROM (
    SELECT row_number() OVER () AS q, item_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)),
x AS (SELECT q, item_id, r, doc_id, CAST(sum(w * gain) AS BIGINT) AS score FROM i JOIN w USING (term) JOIN g USING (term) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 50
""",
    "op12_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
f AS (
  SELECT *, CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 6 WHEN 'system' THEN 18
                 ELSE 23 + length(role) + len(regexp_extract_all(role, '[<\[]\\*(/?s>|</?SYS>>|/?INST\]|ROLE\]|/?TEXT\])')) END
         + length(text) + len(regexp_extract_all(text, '[<\[]\\*(/?s>|</?SYS>>|/?INST\]|ROLE\]|/?TEXT\])')) AS formatted
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
""",
    "op11_source_audit": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
w AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM d),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM grp LEFT JOIN counts USING (lang, source) GROUP BY ALL),
p AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
         1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5) // (t.total + 5 * l.v) AS p,
         1 + CAST(1000000000 AS HUGEINT) * (k.lang_n + 5) // (l.total + 5 * l.v) AS q
  FROM totals t JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
""",
    "op9_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op3_quality_rules": r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\f\r]+') AS words
  FROM documents),
grams AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
starts AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1),
repeated AS (
  SELECT doc_id, sum(least(3, coalesce(following - i, 3))) AS n_repeat_words FROM starts GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\f\r]')) AS lines FROM w),
stops AS (
  SELECT doc_id, len(list_filter(string_split(regexp_replace(lower(text), '[ \t\n\x0b\f\r.,;:]', ' ', 'g'), ' '),
                                 lambda x: list_contains(STOP_WORDS, x))) AS n_stop_words FROM w),
c AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[ \t\n\x0b\f\r]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l.lines) AS BIGINT) AS n_lines,
         CAST(len(l.lines) - len(list_distinct(l.lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n_repeat_words, 0) AS BIGINT) AS n_repeat_words, s.n_stop_words
  FROM w JOIN lines l USING (doc_id) JOIN stops s USING (doc_id) LEFT JOIN repeated r USING (doc_id)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 2.0 * n_words AND word_chars <= 14.0 * n_words
       AND n_symbols <= 0.1 * n_words AND n_stop_words >= 0.06 * n_words AND n_dup_lines <= 0.4 * n_lines AS kept
FROM j
""".replace("STOP_WORDS", str(quality_rules.STOP_WORDS)),
    "op8_url_filters": r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
c AS (SELECT *, host || regexp_replace(path, '/+$', '') AS canonical FROM p),
listed AS (
  SELECT canonical FROM c WHERE canonical <> '' AND md5(canonical)[1] = '0'
  UNION
  SELECT canonical || '/listed' FROM c WHERE canonical <> '' AND md5(canonical)[1] = '1'),
rules(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT page_id, host, path, r.verdict, r.rule_host || r.rule_path AS rule,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(r.rule_host || r.rule_path) DESC) AS rn
  FROM (SELECT DISTINCT page_id, host, path FROM c) JOIN rules r
    ON (host = r.rule_host OR ends_with(host, '.' || r.rule_host)) AND starts_with(path, r.rule_path))
SELECT c.page_id, c.host, c.path, f.rule,
       coalesce(f.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN fits f ON f.rn = 1 AND f.page_id = c.page_id AND f.host = c.host AND f.path = c.path
LEFT JOIN listed l ON l.canonical = c.canonical
""",
}
