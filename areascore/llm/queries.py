"""The operators of this folder as queries over a folder of given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areascore.llm import (
    bpe,
    collocations,
    conversation_repair,
    decontaminate,
    hidden_markov,
    language_id,
    line_dedup,
    passage_chain,
    quality_rules,
    secret_scan,
    set_join,
    suffix_dedup,
    url_rules,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark, sf_dir):
    judged = quality_rules.apply_rules(given(spark, sf_dir, "documents").select("doc_id", "text"))
    asked = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select(*asked, *(c for c in judged.columns if c not in (*asked, "text")))


_KNOWN = ", ".join(f"'{w}', '{w.capitalize()}'" for w in quality_rules.STOP_WORDS)
SQL["op1_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines
  FROM documents
), s AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS c
  FROM (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d))
), r AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM s WHERE c > 1)
  GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda x: x IN ({_KNOWN})))::BIGINT AS n_stop_words
  FROM d LEFT JOIN r ON r.doc_id = d.doc_id
), v AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         concat_ws(',', CASE WHEN n_words < 10 THEN 'short' END,
           CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 'repeated' END,
           CASE WHEN n_words >= 10 AND 4 * n_symbols > n_words THEN 'symbols' END,
           CASE WHEN n_words >= 50 AND n_words > 25 * n_stop_words THEN 'stop_words' END,
           CASE WHEN n_words >= 10 AND 2 * n_dup_lines > n_lines THEN 'duplicate_lines' END,
           CASE WHEN n_words >= 10 AND word_chars > 15 * n_words THEN 'long_words' END,
           CASE WHEN n_words >= 10 AND 2 * n_words > word_chars THEN 'short_words' END) AS failed_rules
  FROM m
)
SELECT *, failed_rules = '' AS kept FROM v
"""

@query
def op2_secret_scans(spark, sf_dir):
    spans = F.sort_array("secret_spans")
    base = F.filter(spans, lambda s: s["kind_order"] < len(secret_scan.BASE_KINDS))
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind_order"] == k)).cast("long").alias(f"n_{secret_scan.KINDS[k]}")
    n_base = len(secret_scan.BASE_KINDS)
    found = secret_scan.scan(given(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *map(count, range(n_base)),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(spans).alias("spans"),
        *map(count, range(n_base, len(secret_scan.KINDS))),
    )


@query
def op3_suffix_dedup(spark, sf_dir):
    cut = suffix_dedup.removed(given(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query
def op4_jaccard_join(spark, sf_dir):
    return set_join.join(given(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_decontamination(spark, sf_dir):
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark(docs, given(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query
def op6_lm_scoring(spark, sf_dir):
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    return hidden_markov.score(docs, language_id.remainder(F.col("doc_id"), 7) != 2)


@query
def op7_language_id(spark, sf_dir):
    docs = given(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    part = language_id.remainder(F.col("doc_id"), 5)
    model = language_id.train(docs.where(part != 0))
    rows = docs.select("doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), "text")
    return language_id.predict(rows, model).drop("text")


#: Where the vocabulary file lies; a parameter of the operator.
TOKENIZER = "word_bpe_49k.json"


@query
def op8_bpe_encoding(spark, sf_dir):
    import public_tokenizers

    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_texts(docs, public_tokenizers.path(TOKENIZER))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op9_passage_chains(spark, sf_dir):
    return passage_chain.passages(given(spark, sf_dir, "documents").select("doc_id", "text"))


# The rules the query is asked for.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@query
def op10_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(list(URL_RULES), url_rules.RULE_SCHEMA)
    return url_rules.judge(given(spark, sf_dir, "pages"), rules)


_ROWS = ", ".join(str(r) for r in URL_RULES)
SQL["op10_url_filters"] = rf"""
WITH rest AS (
  SELECT page_id, row_number() OVER () AS n,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), u AS (
  SELECT page_id, n, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), r(rule_host, rule_path, verdict) AS (VALUES {_ROWS}),
best AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM u JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN best USING (n)
"""


@query
def op13_line_dedup(spark, sf_dir):
    cut = line_dedup.drop_shared_lines(given(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL["op13_line_dedup"] = r"""
WITH l AS (
  SELECT r, doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line
  FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), k AS (
  SELECT r, doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), shared AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10
), m AS (
  SELECT k.*, shared.key IS NOT NULL AS gone FROM k LEFT JOIN shared ON k.key = shared.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""


def _damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """The rows as the query has them damaged, and how often each stands there."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", known("conv_id"), known("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(known("role")).alias("role"), text.alias("text"), kind.alias("kind")
    )
    return rows, F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)


@query
def op12_conversation_repair(spark, sf_dir):
    rows, times = _damaged(given(spark, sf_dir, "conversations"))
    return conversation_repair.repair(rows, times=times)


@query
def op11_collocations(spark, sf_dir):
    return collocations.mine(given(spark, sf_dir, "documents").select("text", "lang"))


SQL["op11_collocations"] = r"""
WITH p AS (
  SELECT lang, row_number() OVER () AS p, words FROM (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^ \t]+') AS words
    FROM documents)
), g AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i
        FROM (SELECT *, unnest([1, 2, 3, 4]) AS k FROM p))
), total AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (
  SELECT c.lang, c.phrase, c.a, i, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS i FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:i], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[i + 1:], ' ')
), weakest AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
), part AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c WHERE k > 2))
  GROUP BY 1, 2
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, encode(w.phrase)) AS rank,
         w.phrase, a, l, r, n, score::BIGINT AS score
  FROM weakest w JOIN total ON total.lang = w.lang
  LEFT JOIN part ON part.lang = w.lang AND part.phrase = w.phrase WHERE NOT coalesce(100 * most >= 80 * a, false))
WHERE rank <= 2000
"""
