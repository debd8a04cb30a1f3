"""Registered queries of the operators, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe, chat_format, cotraining, exact_dedup, lexical, mixing, multi_index, ngram_join, repair, toxicity, training_order, url_filter, warc,
)
from ledgerloom.llm.common import pick, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return add


@register(
    "op10_exact_dedup",
    r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
r AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.labelled(table(spark, sf_dir, "documents"))


# The rules of the contract.
URL_RULES = [
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]


@register(
    "op8_url_filter",
    r"""
WITH r(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (
  SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY page_id)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m USING (page_id)""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pick(table(spark, sf_dir, "pages"), ("page_id", "long"), ("url", "string"))
    return url_filter.judge(pages, URL_RULES).drop("url")


@register("op2_source_mix")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def ranks(name: str = "byte_bpe_50k.tiktoken") -> str:
    """The content of a public rank file, read where the query is built."""
    import public_tokenizers

    with open(public_tokenizers.path(name)) as file:
        return file.read()


@register("op9_byte_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), ("doc_id", "long"), ("text", "string"))
    encoded = bpe.encode(docs, ranks()).drop("text")
    decoded = bpe.decode(encoded, ranks())
    joined = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op5_ngram_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_similar(table(spark, sf_dir, "documents"))


@register("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.classify(docs, labels).drop("passages")


@register("op1_multi_index")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.neighbours(table(spark, sf_dir, "embeddings"))


@register("op7_warc")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


END_OF_TEXT = 50256  # the id that is free in the rank file


@register("op4_training_order")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sequence as read back from the shards; token_ids_sha256 is over the
    little-endian ids, the end mark included."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    path, layout, n = training_order.materialise(docs, key=4, end_id=END_OF_TEXT, vocabulary=END_OF_TEXT + 1, encoder=bpe.encoder(ranks()))
    schema = "slot long, shard long, byte_offset long, doc_id long, part int, n_tokens int, token_ids_sha256 string"
    if not n:
        return spark.createDataFrame([], schema)
    return training_order.read_shards(spark, path, layout).withColumn("token_ids_sha256", F.sha2("ids", 256)).drop("ids")


@register("op6_cotrained_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op11_structure_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digests(table(spark, sf_dir, "conversations"))


CHAT_TEST = "</s>[INST] ok [/INST]"  # fixed value: the text of the conversation that is added


@register(
    "op12_prefix_targets",
    r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, floor(turn / 64) AS page,
         length(text) + len(regexp_extract_all(text, '[\[<]\\*(/?(INST|OUT|ROLE|TEXT)\]|/?s>)')) AS size,
         length(role) + len(regexp_extract_all(role, '[\[<]\\*(/?(INST|OUT|ROLE|TEXT)\]|/?s>)')) AS role_size
  FROM t),
m AS (
  SELECT *, size + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 ELSE 19 + role_size END AS marked FROM e),
x AS (
  SELECT *, sum(marked) OVER (w ROWS UNBOUNDED PRECEDING) AS upto,
         row_number() OVER (PARTITION BY conv_id, page ORDER BY turn DESC, role DESC, text DESC) = 1 AS whole
  FROM m WINDOW w AS (PARTITION BY conv_id, page ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(upto) FILTER (role = 'assistant' OR whole)::BIGINT AS formatted_chars
FROM x GROUP BY conv_id""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = [F.struct(F.lit(-1).alias("conv_id"), F.lit(n).alias("turn"), F.lit(role).alias("role"), F.lit(CHAT_TEST).alias("text")) for n, role in enumerate(("user", "assistant"))]
    return chat_format.digests(rows.unionByName(spark.range(1).select(F.inline(F.array(*added)))))


@register(
    "op13_lexical_search",
    r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, terms, len(terms)::BIGINT AS n FROM t WHERE len(terms) > 0),
s AS (SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_terms FROM d),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
p AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM p, s GROUP BY term, all_docs),
g AS (
  SELECT item_id, r, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * all_docs) // all_terms))))::BIGINT AS score
  FROM p JOIN i USING (term) JOIN w USING (term), s GROUP BY item_id, r, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM g WHERE score > 0
QUALIFY rank <= 10""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
