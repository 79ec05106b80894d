"""Named queries of the numbered operators that run on column expressions alone."""

from __future__ import annotations

from pyspark.sql import functions as F

from .blocks import text_bytes
from .external_shuffle import ROW_BYTES, shuffle_to_shards
from .line_quality import with_line_verdict
from .registry import query
from .winnowing import edited, fingerprint, fingerprint_text, hash_set, likeness, with_next


def table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")


N_SHARDS = 40


@query("op5_external_shuffle")
def op5(spark, folder):
    shards = shuffle_to_shards(table(spark, folder, "documents"), N_SHARDS)
    text = F.coalesce("record.text", F.lit(""))
    return shards.select("record.doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                         F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


OP7_SQL = r"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws, source, text FROM docs),
grams AS (SELECT doc_id, i, list_slice(ws, i, i + 4) AS gram FROM words, unnest(range(1, len(ws) - 3)) AS t(i)),
repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM repeated, unnest(range(0, 5)) AS t(o) GROUP BY doc_id),
lines AS (SELECT doc_id, source, text, unnest(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))) AS line
          FROM docs),
normal AS (SELECT *, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm FROM lines),
hosts AS (SELECT source, count(DISTINCT text) AS n FROM docs GROUP BY source),
often AS (SELECT n.source, n.norm FROM normal n JOIN hosts h ON n.source IS NOT DISTINCT FROM h.source
          GROUP BY n.source, n.norm, h.n HAVING count(DISTINCT n.text) > greatest(3, h.n / 10)),
gone AS (SELECT n.doc_id, sum(len(regexp_split_to_array(n.norm, ' '))) AS n FROM normal n
         JOIN often o ON n.source IS NOT DISTINCT FROM o.source AND n.norm = o.norm GROUP BY n.doc_id),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
base AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(d.n, 0)::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(g.n, 0) AS gone
  FROM words w LEFT JOIN dups d USING (doc_id) LEFT JOIN covered c USING (doc_id) LEFT JOIN gone g USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (gone > 0 AND n_words - gone < 0.2 * n_words) AS kept
FROM base
"""


@query("op7_line_quality", OP7_SQL)
def op7(spark, folder):
    judged = with_line_verdict(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op8_winnowing")
def op8(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("tie", F.xxhash64("text"))
    prints = docs.withColumn("prints", fingerprint(F.col("text"))).withColumn("hashes", hash_set(F.col("prints")))
    pairs = with_next(prints, "doc_id", ["text", "hashes"], text_bytes(docs), "tie")
    changed = pairs.select("doc_id", F.length("text").cast("long").alias("n_chars"), "prints", "hashes", "next_hashes",
                           edited(F.col("text"), F.col("next_text")).alias("edited"))
    printed = changed.withColumn("edited_prints", fingerprint(F.col("edited")))
    return printed.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text(F.col("prints")).alias("fingerprint"),
        fingerprint_text(F.col("edited_prints")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), hash_set(F.col("edited_prints"))).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"))
