"""The training-data operators over the given tables, next to the SQL that states their results.

Each query applies its operator, with production parameters, to its whole
table.  Where there is no SQL (trained models, a hash or a vocabulary that SQL
lacks), tests/llm compares the query with a plain version in Python.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bloom_cascade, bond_negatives, decontaminate, edit_counts, extendible, filter_audit, hidden_markov, line_frequency
from millrace.llm import mil_quality, record_files, secret_tests, simhash_trie, soft_mix
from millrace.llm.common import table
from millrace.session import stage

#: The rules of the url filter.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
BLOCK_WORDS = ("adult", "ads", "bets", "casino", "pills", "spam")
WINDOW = 10
MAX_LINE_DOCS, MAX_LINE_SHARE, DEPLETED = 20, 0.001, 0.5
THRESHOLD = 0.7
MIX = {"fine": 0.76, "poor": 0.14, "toxic": 0.10}
SHARD_BYTES = 64 << 20
END_ID = 2
#: What is redacted before tokens are counted again: pattern, quick test, replacement.
REDACTIONS = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "@", "[EMAIL]"),
    (r"[0-9a-fA-F]{32,}", "[0-9a-fA-F]{32}", "[KEY]"),
    (r"(?<![0-9A-Za-z])\+?[0-9][0-9 ().-]{7,}[0-9](?![0-9A-Za-z])", "[0-9][0-9 ().-]{7}", "[NUMBER]"),
    (r"Licensed under the [^\n]*", "Licensed under the ", ""),
)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pretoken_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the verdict of cross-document line frequency."""
    return line_frequency.judge_lines(table(spark, sf_dir, "documents"), MAX_LINE_DOCS, MAX_LINE_SHARE, DEPLETED)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all urls by rules and a block list held in Bloom filter cascades."""
    return bloom_cascade.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, BLOCK_WORDS)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in each document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), WINDOW)
    return found.drop("text_hash")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts before and after redaction, by edits to kept trees."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("edits", edit_counts.redactions(F.col("text"), REDACTIONS))
    return edit_counts.count_edited(docs, vocabulary("byte_bpe_50k.tiktoken"), pretoken_pattern())


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids by the tokenizer file as it is, written to record files and read back."""
    docs = table(spark, sf_dir, "documents")
    return record_files.round_trip(spark, docs, vocabulary("byte_bpe_50k.json"), END_ID, special_as_text=False)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors, fitted rates and whole copies of every document."""
    labels = soft_mix.domains_of_labels(table(spark, sf_dir, "labels"))
    rated, *_ = soft_mix.mix(table(spark, sf_dir, "documents"), labels, MIX)
    return rated.withColumn("copies", soft_mix.copies(F.col("rate"), F.col("doc_id")))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = mil_quality.fit(docs, labels.where(~mil_quality.held_out()))
    scored = mil_quality.scores(docs, model)
    return scored.select(
        "doc_id", mil_quality.held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components of all documents."""
    found = simhash_trie.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_trie.hex64("fp").alias("fingerprint"), "component_id")


def _of_kind(kind: str, span: Column) -> Column:
    return span["kind"] == kind


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets by form, and random runs beside them."""
    found = secret_tests.scan(table(spark, sf_dir, "documents"))
    kinds = [F.size(F.filter("base", partial(_of_kind, k))).cast("bigint").alias(f"n_{k}") for k, *_ in secret_tests.BASE]
    base = F.sha2(secret_tests.digest(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *kinds, base, secret_tests.digest(F.array_sort(F.concat("base", "added"))).alias("spans"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, with the shard's size."""
    docs = table(spark, sf_dir, "documents")
    sharded = extendible.assign_shards(docs, SHARD_BYTES)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    rows = stage(sharded.select("doc_id", "shard", size.alias("n_bytes")), "sharded")
    sizes = rows.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_docs"))
    out = rows.join(sizes.withColumnRenamed("shard", "_s"), F.col("shard") == F.col("_s"))
    return out.select("doc_id", "n_bytes", "shard", F.length("shard").alias("depth"), "shard_bytes", "shard_docs")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of all orders of five filters for each language."""
    counts = filter_audit.failure_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit(counts)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    vec_id, label = F.col("vec_id"), F.col("label").cast("bigint")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return bond_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, moved)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likelihoods of all documents under a hidden Markov model of nine tenths of them."""
    tenth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    scored = hidden_markov.score_texts(table(spark, sf_dir, "documents"), tenth != 0)
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), *scored.columns[2:])


_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
grams AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
often AS (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM often WHERE n > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, ln, list_filter(regexp_split_to_array(ln, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS lw
  FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS ln FROM d)),
worded AS (
  SELECT doc_id, source, ln, len(lw) AS n,
         regexp_replace({_LOW.format("array_to_string(lw, ' ')")}, '[0-9]', '0', 'g') AS k
  FROM lines WHERE len(lw) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT ln) AS n_dup_lines FROM worded GROUP BY doc_id),
hosts AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
frequent AS (
  SELECT w.source, k FROM worded w JOIN hosts h ON w.source IS NOT DISTINCT FROM h.source
  GROUP BY w.source, k, docs HAVING count(DISTINCT doc_id) > {MAX_LINE_DOCS} AND count(DISTINCT doc_id) > docs * {MAX_LINE_SHARE}),
lost AS (
  SELECT doc_id, sum(n) AS n_removed_words
  FROM worded w JOIN frequent f ON w.source IS NOT DISTINCT FROM f.source AND w.k = f.k GROUP BY doc_id),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_removed_words, 0)::BIGINT AS n_removed_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_removed_words <= n_words * {DEPLETED} AS kept,
       n_removed_words
FROM m
"""

_FITS = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"

OP2_SQL = rf"""
WITH u AS (
  SELECT page_id, coalesce({_LOW.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE WHEN {_FITS.format("www.example.com", "/en/")} THEN 'www.example.com/en/'
                 WHEN {_FITS.format("example.com", "/en/")} THEN 'example.com/en/'
                 WHEN {_FITS.format("net", "/es/")} THEN 'net/es/'
                 WHEN {_FITS.format("net", "/fr/")} THEN 'net/fr/'
                 WHEN {_FITS.format("com", "/")} THEN 'com/' END AS rule,
         regexp_extract(host, '(?:^|\.)((?:[^.]*-)?(?:{"|".join(BLOCK_WORDS)})(?:-[^.]*)?(?:\..*)?)$', 1) AS bad
  FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bad <> '' THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN bad <> '' THEN bad || '/' END AS listed_host
FROM r
"""

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP3_SQL = rf"""
WITH items AS (SELECT item_id, {_WORDS.format(_LOW.format("coalesce(text, '')"))} AS ws FROM benchmark),
cut AS (
  SELECT item_id, ws, least(len(ws), {WINDOW}) AS m, unnest(range(1, len(ws) - least(len(ws), {WINDOW}) + 2)) AS i
  FROM items WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(ws[i:i + m - 1], ' ') AS g FROM cut),
docs AS (SELECT doc_id, {_WORDS.format(_LOW.format("coalesce(text, '')"))} AS ws FROM documents),
place AS (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM docs, (SELECT DISTINCT m FROM win)),
hit AS (SELECT doc_id, a.i, a.m, item_id FROM place a JOIN win w ON a.m = w.m AND array_to_string(a.ws[a.i:a.i + a.m - 1], ' ') = w.g),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP10_SQL = f"""
WITH d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes,
         ('0x' || left(md5(doc_id::VARCHAR), 13))::BIGINT AS h
  FROM documents),
buckets AS (
  SELECT depth, h >> (52 - depth) AS p, sum(n_bytes) AS b, count(*) AS n
  FROM d, (SELECT unnest(range(0, 53))::INTEGER AS depth) GROUP BY ALL),
leaves AS (
  SELECT doc_id, n_bytes, h, min(depth) AS depth
  FROM d JOIN buckets ON p = h >> (52 - depth) WHERE b <= {SHARD_BYTES} OR n = 1 GROUP BY ALL)
SELECT doc_id, n_bytes, left(lpad(bin(h), 52, '0'), l.depth) AS shard, l.depth::INTEGER AS depth,
       b::BIGINT AS shard_bytes, n AS shard_docs
FROM leaves l JOIN buckets k ON l.depth = k.depth AND k.p = l.h >> (52 - l.depth)
"""

_CUT = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP11_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_CUT.format("coalesce(text, '')")} AS ws FROM documents),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
         + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * (doc_id > min(doc_id) OVER (PARTITION BY t))::INT AS mask
  FROM d LEFT JOIN marks USING (doc_id)),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY ALL),
grown AS (
  SELECT '' AS filter_order
  UNION ALL
  SELECT filter_order || f FROM grown, (SELECT unnest(string_split('ABCDE', '')) AS f)
  WHERE length(filter_order) < 5 AND NOT contains(filter_order, f)),
steps AS (
  SELECT filter_order, step, filter_order[step] AS f, 1 << (ascii(filter_order[step]) - 65) AS bit,
         list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))) AS before
  FROM (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM grown WHERE length(filter_order) = 5)),
seen AS (
  SELECT part, filter_order, step, f, n, good, toxic, mask & bit > 0 AS fails, mask & coalesce(before, 0)::INT = 0 AS reached, mask = bit AS alone
  FROM steps, counts),
summed AS (
  SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (reached AND NOT fails), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (reached AND fails), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (NOT reached AND fails), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (reached AND fails), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (reached AND fails), 0)::BIGINT AS toxic_lost
  FROM seen GROUP BY ALL)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM summed
"""

OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
best AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
       (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other))::INT AS rank
FROM best p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT same
     AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) <= 10
"""

QUERIES = {
    "op1_line_frequency": (op1, OP1_SQL),
    "op2_bloom_cascade": (op2, OP2_SQL),
    "op3_benchmark_windows": (op3, OP3_SQL),
    "op4_edit_token_counts": (op4, None),
    "op5_record_files": (op5, None),
    "op6_soft_mixing": (op6, None),
    "op7_mil_quality": (op7, None),
    "op8_simhash_trie": (op8, None),
    "op9_secret_tests": (op9, None),
    "op10_extendible_shards": (op10, OP10_SQL),
    "op11_filter_audit": (op11, OP11_SQL),
    "op12_bond_negatives": (op12, OP12_SQL),
    "op13_hidden_markov": (op13, None),
}
