"""Registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwelltide.llm.hard_negatives import hard_negatives
from dwelltide.llm.language import held_out, identify_languages, learn_languages
from dwelltide.llm.mixing import plan_mix, taken_words
from dwelltide.llm.neighbours import nearest_neighbours
from dwelltide.llm.packing import pack_sequences
from dwelltide.llm import pii
from dwelltide.llm.prefix_trie import prefix_trie
from dwelltide.llm.secret_scan import BASE_KINDS, find_secrets, joined_spans
from dwelltide.llm.simhash import hex_fingerprint, near_duplicates
from dwelltide.llm.token_counts import count_tokens
from dwelltide.llm.top_scores import top_scores
from dwelltide.llm.url_lists import listed_captures, url_host
from dwelltide.llm.warc import read_records, write_archives
from dwelltide.session import run_folder


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_embeddings(spark, sf_dir), F.col("vec_id") % 20 == 0, k=20)


def best_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_scores(_embeddings(spark, sf_dir), F.col("vec_id") % 50 == 0, k=5)


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(plan_mix(_documents(spark, sf_dir)))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found = pii.find_pii(docs, pii.fit_pii(docs))
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = learn_languages(docs.filter(~held_out("doc_id")))
    found = identify_languages(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "lang_pred",
        "score",
        F.col("lang_accepted").alias("accepted"),
    )


#: Start of the year in which the pages count as fetched.
YEAR_START = 1_704_067_200


def _captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time that their id gives."""
    seconds = (F.col("page_id") * 7919 % 366) * 86_400 + F.col("page_id") % 86_400
    return pages.select("page_id", "url", (F.lit(YEAR_START) + seconds).alias("fetched_at"))


def _list_history(pages: DataFrame) -> DataFrame:
    """Dated lists over the pages' own hosts, domains and URLs: what is listed, and when, follows
    from a hash of it. A third of the entries is removed again, half of those come back."""
    host = url_host(F.col("url"))
    domain = F.regexp_extract(host, r"[^.]+\.[^.]+$", 0)
    plain = F.regexp_replace("url", r"#.*$", "")
    values = F.array(
        F.struct(F.lit("domain").alias("kind"), host.alias("value")),
        F.struct(F.lit("domain").alias("kind"), domain.alias("value")),
        F.struct(F.lit("url").alias("kind"), plain.alias("value")),
    )
    listed = pages.select(F.inline(values)).filter("value <> ''").distinct()
    digits = F.md5("value")

    def number(at: int) -> F.Column:
        return F.conv(F.substring(digits, at, 2), 16, 10).cast("long")

    dated = listed.select(
        "kind", "value", number(1).alias("which"),
        (F.lit(YEAR_START) + number(3) * 86_400).alias("added"),
        (number(5) * 86_400 + 1).alias("days"), number(7).alias("later"),
    ).filter("which < 96")
    def step(action: str, at: F.Column) -> F.Column:
        return F.struct(F.lit(action).alias("action"), at.alias("at"))

    added, days, later = F.col("added"), F.col("days"), F.col("later")
    steps = F.array_compact(
        F.array(
            step("add", added),
            F.when(later % 3 == 0, step("remove", added + days)),
            F.when(later % 6 == 0, step("add", added + 2 * days)),
        )
    )
    name = F.when(F.col("which") < 32, "trusted").when(F.col("which") < 64, "spam")
    return dated.select(
        name.otherwise("unsafe").alias("list"), "kind", "value", F.inline(steps)
    )


def url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    found = listed_captures(_captures(pages), _list_history(pages), allow_lists=("trusted",))
    return found.withColumn("matches", F.array_join("matches", ","))


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_sequences(_documents(spark, sf_dir))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("spans", lambda s: ~s["confirmed"])

    def number(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )


def simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(_documents(spark, sf_dir), shingle=3, max_bits=2)
    return rows.select(
        "doc_id",
        hex_fingerprint().alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _embeddings(spark, sf_dir).withColumn("label", label)
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    own = F.col("conv_id")
    return prefix_trie(turns, own - own % 100, F.crc32(own.cast("string")) % 6, max_head=5)


def web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "warc")
    index = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_records(index, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_nearest_neighbours": neighbours,
        "op2_url_lists": url_lists,
        "op3_source_mix": source_mix,
        "op4_token_counts": token_counts,
        "op5_top_scores": best_scores,
        "op6_personal_data": personal_data,
        "op7_languages": languages,
        "op8_simhash_classes": simhash_classes,
        "op9_packed_sequences": packed_sequences,
        "op10_secrets": secrets,
        "op11_hard_negatives": mined_negatives,
        "op12_prefix_trie": conversation_trie,
        "op13_web_archives": web_archives,
    }


_SIZED = r"""
sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5(coalesce(text, '')), 1, 15) AS tie
  FROM documents
)
"""

# Levels by weight: sources whose stop lies lowest for their weight stop first.
_TARGETS = f"""
{_SIZED},
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sums
),
stops AS (
  SELECT *,
         sum(source_size) OVER () AS all_size,
         coalesce(sum(2 * source_size) OVER before, 0) AS stopped,
         sum(w) OVER (ORDER BY source_size / w, source NULLS LAST
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
  FROM weighted
  WINDOW before AS (ORDER BY source_size / w, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (
  SELECT (1.5 * all_size - stopped)::DOUBLE / w_left AS height
  FROM stops
  WHERE 2 * source_size >= (1.5 * all_size - stopped)::DOUBLE / w_left * w
  ORDER BY source_size / w, source NULLS LAST LIMIT 1
),
targets AS (
  SELECT source, source_size, least(w * height, 2.0 * source_size)::DOUBLE AS target
  FROM weighted, level
)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_nearest_neighbours": """
WITH good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(place AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
      FROM scored)
WHERE place <= 20
""",
        "op2_url_lists": f"""
WITH captures AS (
  SELECT page_id, url, {YEAR_START} + (page_id * 7919 % 366) * 86400 + page_id % 86400 AS fetched_at
  FROM pages
),
hosts AS (
  SELECT DISTINCT url,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host,
         regexp_replace(url, '#.*$', '') AS plain
  FROM pages WHERE url IS NOT NULL
),
listed AS (
  SELECT 'domain' AS kind, host AS value FROM hosts
  UNION SELECT 'domain', regexp_extract(host, '[^.]+\\.[^.]+$') FROM hosts
  UNION SELECT 'url', plain FROM hosts
),
dated AS (
  SELECT kind, value, ('0x' || substr(md5(value), 1, 2))::BIGINT AS which,
         {YEAR_START} + ('0x' || substr(md5(value), 3, 2))::BIGINT * 86400 AS added,
         ('0x' || substr(md5(value), 5, 2))::BIGINT * 86400 + 1 AS days,
         ('0x' || substr(md5(value), 7, 2))::BIGINT AS later
  FROM listed WHERE value <> ''
),
named AS (
  SELECT *, CASE WHEN which < 32 THEN 'trusted' WHEN which < 64 THEN 'spam' ELSE 'unsafe' END AS list
  FROM dated WHERE which < 96
),
active AS (
  SELECT list, kind, value, added AS valid_from,
         CASE WHEN later % 3 = 0 THEN added + days END AS valid_to FROM named
  UNION ALL
  SELECT list, kind, value, added + 2 * days, NULL FROM named WHERE later % 6 = 0
),
labels AS (SELECT url, host, string_split(host, '.') AS parts FROM hosts WHERE host <> ''),
keys AS (
  SELECT url, 'domain' AS kind, array_to_string(parts[i:], '.') AS value
  FROM (SELECT url, parts, unnest(range(1, len(parts) + 1)) AS i FROM labels)
  UNION SELECT url, 'url', plain FROM hosts
),
met AS (
  SELECT c.page_id, a.list, a.list || ':' || a.kind || ':' || a.value AS entry
  FROM captures c JOIN keys k ON c.url = k.url
  JOIN active a ON a.kind = k.kind AND a.value = k.value
   AND c.fetched_at >= a.valid_from AND (a.valid_to IS NULL OR c.fetched_at < a.valid_to)
)
SELECT c.page_id, c.url, c.fetched_at,
       coalesce(string_agg(DISTINCT m.entry, ',' ORDER BY m.entry), '') AS matches,
       coalesce(bool_or(m.list <> 'trusted') AND NOT bool_or(m.list = 'trusted'), false) AS blocked
FROM captures c LEFT JOIN met m ON c.page_id = m.page_id
GROUP BY ALL
""",
        "op5_top_scores": """
WITH good AS (
  SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(place AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
      FROM scored)
WHERE place <= 5
""",
        "op3_source_mix": f"""
WITH {_TARGETS},
keyed AS (
  SELECT s.*, t.source_size, t.target, substr(md5('7|' || coalesce(doc_id::VARCHAR, '')), 1, 15) AS place,
         CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
summed AS (
  SELECT *, floor(target + 0.5)::BIGINT - passes * source_size AS rest,
         sum(size) OVER (PARTITION BY source ORDER BY place, tie ROWS UNBOUNDED PRECEDING) AS so_far
  FROM keyed
)
SELECT doc_id, size, source_size, target,
       (passes * size + greatest(0, least(size, rest - so_far + size)))::BIGINT AS taken
FROM summed
""",
        "op11_hard_negatives": """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
         list_dot_product(a.v, c.v)::BIGINT AS score
  FROM good a JOIN good c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
  WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
        FROM scored WHERE alike)
  WHERE place <= 5
)
SELECT anchor_id, positive_id, CAST(place AS INT) AS rank, negative_id, positive_score, negative_score
FROM (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS place
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.alike
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
WHERE place <= 10
""",
        # The CRC-32 of an id's digits, bit by bit; a node is named by its turns' joined hashes.
        "op12_prefix_trie": r"""
WITH convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda acc, c: xor(acc >> 8, list_reduce(
             list_prepend(xor(acc, c) & 255, list_transform(range(8), lambda i: i::BIGINT)),
             lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))
         ), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) AS i
  FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name
        FROM conversations)
),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, o.i, o.name, o.chars
  FROM convs c JOIN ordered o ON o.conv_id = c.base AND o.i <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.i, o.name, o.chars FROM convs c JOIN ordered o ON o.conv_id = c.conv_id AND o.i > c.h
),
paths AS (
  SELECT conv_id, row_number() OVER way AS depth, chars, string_agg(name, '') OVER way AS path
  FROM rebuilt WINDOW way AS (PARTITION BY conv_id ORDER BY part, i)
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs
),
members AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS is_end FROM paths),
nodes AS (
  SELECT depth, path, left(path, 64 * (depth - 1)) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
         max(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM members GROUP BY depth, path
),
children AS (SELECT above AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
counted AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.path = c.path),
tops AS (
  SELECT left(path, 64 * d) AS path, count(*) FILTER (n_children = 0) AS n_leaves,
         sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM counted) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves, t.saved_tokens, n.ends_sha256
FROM counted n JOIN tops t ON n.path = t.path LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.above
""",
        # Five hex digits are four base32 ones.
        "op13_web_archives": """
WITH pages_read AS (
  SELECT page_id, html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(encode(coalesce(html, ''))) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5))::BIGINT
                    >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1)), '') AS payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM pages_read
""",
    }
