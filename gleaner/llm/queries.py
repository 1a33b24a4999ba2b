"""The digest queries of the operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import bpe, html_text, language, mixing, packing, quality, records, sharding, simhash, trie, vectors, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op3_language")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


@query("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op5_html")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


@query("op6_vectors")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.vector_links(table(spark, sf_dir, "embeddings"))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), by_source AS (
  SELECT *, (ARRAY[5.0, 2.0, 1.0])[1 + place % 3]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM sized GROUP BY source)
), turned AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, place) AS turn FROM by_source
), levelled AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER done, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER done, 0)) AS level
  FROM turned WINDOW done AS (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, place, least(cap, weight * coalesce(
    (SELECT level FROM levelled WHERE level * weight <= cap ORDER BY turn LIMIT 1), 1e300)) AS target,
    ceil(source_size / 8.0)::BIGINT AS blocks
  FROM levelled
), tried AS (
  SELECT place, row_number() OVER (ORDER BY target / (2 * seat + 1) DESC, place, seat) AS turn
  FROM (SELECT place, target, unnest(range(0, 2 * blocks)) AS seat FROM targets WHERE target > 0)
), won AS (
  SELECT place, count(*) AS seats FROM tried WHERE turn <= (SELECT floor(sum(target) / 8) FROM targets) GROUP BY place
), lined AS (
  SELECT s.doc_id, s.size, t.*, coalesce(w.seats, 0) AS seats,
    CASE WHEN blocks > 0 THEN ('0x' || substr(md5('7:start:' || t.place), 1, 13))::BIGINT % blocks ELSE 0 END AS start,
    coalesce(sum(s.size) OVER (PARTITION BY t.place
      ORDER BY substr(md5('7:' || coalesce(s.doc_id::VARCHAR, '')), 1, 13), s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS line
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN won w ON w.place = t.place
)
SELECT doc_id, size::BIGINT AS size, source_size, target, (
  greatest(0, least(least(start + seats, blocks) * 8 - line, size) - greatest(start * 8 - line, 0))
  + greatest(0, least(least(start + seats - blocks, blocks) * 8 - line, size) - greatest(greatest(start - blocks, 0) * 8 - line, 0))
  + greatest(0, least(least(start + seats - 2 * blocks, blocks) * 8 - line, size) - greatest(-line, 0))
  )::BIGINT AS taken
FROM lined
"""


@query("op7_mixing", MIX_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *[f"counts.{c}" for c in base], "base_failed", "kept")


@query("op9_records")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_table(spark, table(spark, sf_dir, "documents"))


@query("op10_warc")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_table(spark, table(spark, sf_dir, "pages"))


#: crc32 is worked out bit by bit; a node is the list of its turns' digests.
TRIE_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'d': md5(length(role) || ':' || role || text), 's': octet_length(encode(text))::BIGINT}
    ORDER BY turn NULLS FIRST, role, substr(text, 1, 32), md5(length(role) || ':' || role || text)) AS t
  FROM turns GROUP BY conv_id
), coded AS (
  SELECT *, list_reduce(list_concat([4294967295::BIGINT], [ord(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')]),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda v, z: xor(v >> 1, 3988292384::BIGINT * (v & 1)))) AS crc
  FROM own
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.t[1 : xor(c.crc, 4294967295) % 9], []), c.t[xor(c.crc, 4294967295) % 9 + 1 :]) AS t
  FROM coded c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
), members AS (
  SELECT conv_id, depth, [x.d FOR x IN t[1 : depth]] AS node, CASE WHEN depth > 0 THEN t[depth].s ELSE 0 END AS size, depth = len(t) AS ends
  FROM (SELECT *, unnest(range(0, len(t) + 1)) AS depth FROM rebuilt)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY node, depth
), children AS (
  SELECT node[1 : depth - 1] AS parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), above AS (
  SELECT n.node[1 : up] AS node, sum(n.saved) AS saved_tokens, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM nodes) n LEFT JOIN children c ON c.parent = n.node GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, a.n_leaves,
  a.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN above a ON a.node = n.node LEFT JOIN children c ON c.parent = n.node
  LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1 : n.depth - 1]
"""


@query("op11_trie", TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query("op13_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"))
