"""Named queries: splitters, training sequences, splits and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chunking, ordering, sequences
from ..session import spread, table
from .registry import query

SQL_TOKENS = r"list_filter(regexp_split_to_array({0}, '[ \t\n\x0B\f\r]+'), lambda x: x <> '')"
SQL_HASH = "CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT)"


def sql_ids(text: str) -> str:
    return f"list_transform({SQL_TOKENS.format(text)}, lambda w: {SQL_HASH.format('w')} % {sequences.VOCABULARY})"


def sql_chunks(size: int, overlap: int) -> str:
    step = size - overlap
    return f"""
w AS (SELECT doc_id, {SQL_TOKENS.format('text')} AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(0, greatest(len(words) - 1 - {overlap}, 0) + 1, {step})) AS st FROM w WHERE len(words) > 0),
chunks AS (SELECT doc_id, CAST(st // {step} AS INTEGER) AS chunk_no, array_to_string(words[st + 1 : st + {size}], ' ') AS chunk FROM starts)"""


def _md5_list(column: str):
    return F.md5(F.array_join(F.col(column).cast("array<string>"), ","))


def _texts(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


_SQL_MD5_LIST = "md5(array_to_string(CAST({0} AS VARCHAR[]), ','))"


@query("spl1_token_chunks", f"WITH {sql_chunks(256, 32)} SELECT doc_id, chunk_no, chunk FROM chunks")
def token_chunks(spark, sf):
    docs = _texts(spark, sf)
    return chunking.split_tokens(docs, "text", 256, 32, adjacent=False).select("doc_id", "chunk_no", "chunk")


_SQL_SENTENCES = rf"""
s AS (SELECT doc_id, unnest(list_filter(string_split(regexp_replace(text, '([.!?])[ \t\n\x0B\f\r]+', '\1' || chr(1), 'g'), chr(1)),
             lambda x: x <> '')) AS sent, generate_subscripts(list_filter(string_split(regexp_replace(text,
             '([.!?])[ \t\n\x0B\f\r]+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> ''), 1) AS sno FROM documents),
t AS (SELECT doc_id, sno, {SQL_TOKENS.format('sent')} AS words FROM s),
p AS (SELECT doc_id, sno, st, words[st + 1 : st + {{size}}] AS piece
      FROM (SELECT *, unnest(range(0, len(words), {{size}})) AS st FROM t WHERE len(words) > 0)),
items AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sno, st) AS i,
                 array_to_string(piece, ' ') AS piece, len(piece) AS n FROM p),
fill AS (SELECT doc_id, i, 0 AS chunk_no, n AS used FROM items WHERE i = 1
         UNION ALL
         SELECT it.doc_id, it.i, CASE WHEN f.used + it.n <= {{size}} THEN f.chunk_no ELSE f.chunk_no + 1 END,
                CASE WHEN f.used + it.n <= {{size}} THEN f.used + it.n ELSE it.n END
         FROM fill f JOIN items it ON it.doc_id = f.doc_id AND it.i = f.i + 1)"""


@query("spl2_sentence_chunks", f"""
WITH RECURSIVE {_SQL_SENTENCES.format(size=256)}
SELECT doc_id, chunk_no, string_agg(piece, ' ' ORDER BY i) AS chunk FROM fill JOIN items USING (doc_id, i) GROUP BY 1, 2""")
def sentence_chunks(spark, sf):
    docs = _texts(spark, sf)
    return chunking.split_sentences(docs, "text", 256, adjacent=False).select("doc_id", "chunk_no", "chunk")


_SQL_LINES = r"([^\n]*\n|[^\n]+)"


def _sql_refine(name: str, source: str, pattern: str) -> str:
    """Cut the pieces that are still over budget; ``path`` keeps the reading order."""
    return rf"""
{name} AS (SELECT doc_id, list_append(path, 0) AS path, piece FROM {source} WHERE length(piece) <= 1024
  UNION ALL SELECT doc_id, list_append(path, unnest(range(len(parts)))), unnest(parts)
  FROM (SELECT doc_id, path, regexp_extract_all(piece, '{pattern}', 1) AS parts FROM {source} WHERE length(piece) > 1024))"""


@query("spl3_character_chunks", rf"""
WITH RECURSIVE p0 AS (SELECT doc_id, [CAST(0 AS BIGINT)] AS path, text || repeat(chr(1), 1025) AS piece FROM documents),
p1 AS (SELECT doc_id, path, replace(piece, chr(1), '') AS piece FROM (SELECT doc_id, list_append(path, unnest(range(len(parts)))) AS path, unnest(parts) AS piece
  FROM (SELECT doc_id, path, regexp_extract_all(piece, '(?s)(.+?(?:\n\n|\z))', 1) AS parts FROM p0))),
{_sql_refine('p2', 'p1', _SQL_LINES)}, {_sql_refine('p3', 'p2', '([^ ]* |[^ ]+)')},
p4 AS (SELECT doc_id, list_append(path, s) AS path, substring(piece, s * 1024 + 1, 1024) AS piece
       FROM (SELECT *, unnest(range(CAST(ceil(length(piece) / 1024.0) AS BIGINT))) AS s FROM p3)),
items AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY path) AS i, piece, length(piece) AS n FROM p4 WHERE piece <> ''),
fill AS (SELECT doc_id, i, 0 AS chunk_no, n AS used FROM items WHERE i = 1
         UNION ALL
         SELECT it.doc_id, it.i, CASE WHEN f.used + it.n <= 1024 THEN f.chunk_no ELSE f.chunk_no + 1 END,
                CASE WHEN f.used + it.n <= 1024 THEN f.used + it.n ELSE it.n END
         FROM fill f JOIN items it ON it.doc_id = f.doc_id AND it.i = f.i + 1)
SELECT doc_id, chunk_no, string_agg(piece, '' ORDER BY i) AS chunk FROM fill JOIN items USING (doc_id, i) GROUP BY 1, 2""")
def character_chunks(spark, sf):
    docs = _texts(spark, sf)
    return chunking.split_characters(docs, "text", 1024, adjacent=False).select("doc_id", "chunk_no", "chunk")


@query("spl4_adjacent_chunks", f"""
WITH {sql_chunks(256, 0)}
SELECT doc_id, chunk_no, md5(chunk) AS chunk_md5, md5(lag(chunk) OVER w) AS prev_md5, md5(lead(chunk) OVER w) AS next_md5
FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_no)""")
def adjacent_chunks(spark, sf):
    docs = _texts(spark, sf)
    return chunking.split_tokens(docs, "text", 256).select(
        "doc_id", "chunk_no", F.md5("chunk").alias("chunk_md5"), F.md5("prev").alias("prev_md5"), F.md5("next").alias("next_md5"))


@query("jn11_neighbour_join", f"""
WITH {sql_chunks(256, 0)}
SELECT c.doc_id, c.chunk_no, md5(p.chunk) AS prev_md5, md5(n.chunk) AS next_md5
FROM chunks c LEFT JOIN chunks p ON p.doc_id = c.doc_id AND p.chunk_no = c.chunk_no - 1
     LEFT JOIN chunks n ON n.doc_id = c.doc_id AND n.chunk_no = c.chunk_no + 1 WHERE contains(c.chunk, 'the ')""")
def neighbour_join(spark, sf):
    docs = _texts(spark, sf)
    chunks = chunking.split_tokens(docs, "text", 256, adjacent=False).select("doc_id", "chunk_no", "chunk")
    hits = chunks.where(F.col("chunk").contains("the ")).select("doc_id", "chunk_no")
    return chunking.neighbours_by_join(hits, chunks, "doc_id").select(
        "doc_id", "chunk_no", F.md5("prev").alias("prev_md5"), F.md5("next").alias("next_md5"))


@query("spl5_chars_per_token", f"""
WITH r AS (SELECT text FROM documents ORDER BY doc_id LIMIT 400),
s AS (SELECT CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST(sum(len({SQL_TOKENS.format('text')})) AS BIGINT) AS n_tokens FROM r)
SELECT n_chars, n_tokens, round(n_chars / n_tokens, 6) AS chars_per_token FROM s""")
def chars_per_token(spark, sf):
    return sequences.chars_per_token(table(spark, sf, "documents"), "doc_id", "text")


def _ids(spark, sf):
    return _texts(spark, sf).select("doc_id", sequences.token_ids(F.col("text")).alias("ids"))


@query("spl6_constant_length", f"""
WITH d AS (SELECT doc_id, length(text) AS c, list_append({sql_ids('text')}, {sequences.EOS_ID}) AS toks FROM documents),
b AS (SELECT doc_id, toks, CAST((sum(c) OVER (ORDER BY doc_id) - c) // 1887436 AS BIGINT) AS buffer_no FROM d),
u AS (SELECT buffer_no, doc_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM b),
o AS (SELECT buffer_no, tok, row_number() OVER (PARTITION BY buffer_no ORDER BY doc_id, pos) - 1 AS st FROM u)
SELECT buffer_no, st // 512 AS seq_no, md5(string_agg(CAST(tok AS VARCHAR), ',' ORDER BY st)) AS ids_md5
FROM o GROUP BY 1, 2 HAVING count(*) = 512""")
def constant_length(spark, sf):
    """Buffers of 512 * 3.6 * 1024 characters."""
    rows = _texts(spark, sf).select("doc_id", F.length("text").alias("n_chars"), sequences.token_ids(F.col("text")).alias("ids"))
    return sequences.pack_constant_length(rows, "doc_id", "ids", "n_chars", 512).select(
        "buffer_no", "seq_no", _md5_list("input_ids").alias("ids_md5"))


def _sql_fim(truncate: bool) -> str:
    def h(salt):
        return SQL_HASH.format(f"doc_id || ':{salt}:7'")
    cut = 3 if truncate else 0
    return f"""
WITH d AS (SELECT doc_id, {sql_ids('text')} AS ids FROM documents),
c AS (SELECT *, len(ids) AS n, least({h('cut1')} % (len(ids) + 1), {h('cut2')} % (len(ids) + 1)) AS lo,
             greatest({h('cut1')} % (len(ids) + 1), {h('cut2')} % (len(ids) + 1)) AS hi FROM d),
x AS (SELECT *, ids[1 : lo] AS a, ids[lo + 1 : hi] AS m, ids[hi + 1 : n - {cut}] AS z FROM c)
SELECT doc_id, {_SQL_MD5_LIST.format(f'''
  CASE WHEN {h('fim')} % 10000 >= 5000 OR n - hi <= {cut if truncate else -1} THEN ids
       WHEN {h('spm')} % 10000 < 5000 THEN [50001, 50003] || z || [50002] || a || m
       ELSE [50001] || a || [50003] || z || [50002] || m END''')} AS ids_md5 FROM x"""


@query("spl7_fill_in_middle", _sql_fim(False))
def fill_in_middle(spark, sf):
    return sequences.fill_in_middle(_ids(spark, sf), "doc_id", "ids", prefix=50001, middle=50002, suffix=50003,
                                    seed=7).select("doc_id", _md5_list("ids").alias("ids_md5"))


@query("spl8_fill_in_middle_same_length", _sql_fim(True))
def fill_in_middle_same_length(spark, sf):
    return sequences.fill_in_middle(_ids(spark, sf), "doc_id", "ids", prefix=50001, middle=50002, suffix=50003,
                                    seed=7, truncate=True).select("doc_id", _md5_list("ids").alias("ids_md5"))


@query("spl9_head_and_rest", """
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= 100 THEN 'valid' ELSE 'train' END AS split FROM documents""")
def head_and_rest(spark, sf):
    return ordering.head_and_rest(table(spark, sf, "documents").select("doc_id"), "doc_id", 100)


@query("spl10_seeded_shuffle", f"""
SELECT doc_id, row_number() OVER (ORDER BY {SQL_HASH.format("doc_id || ':42'")}, doc_id) - 1 AS position FROM documents""")
def seeded_shuffle(spark, sf):
    return ordering.shuffle_position(table(spark, sf, "documents").select("doc_id"), "doc_id", 42)


@query("spl11_train_test_split", f"""
SELECT vec_id, CASE WHEN {SQL_HASH.format("vec_id || ':23'")} % 100 < 25 THEN 'test' ELSE 'train' END AS split FROM embeddings""")
def train_test_split(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", ordering.split_by_hash(F.col("vec_id"), 23).alias("split"))


@query("spl12_global_batches", """
SELECT o_orderkey, CAST((rn - 1) // 64 AS BIGINT) AS batch_no, CAST(least((rn - 1) % 64 // 16, 3) AS INTEGER) AS worker
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)""")
def global_batches(spark, sf):
    return ordering.global_batches(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 64, 4)


@query("spl13_epochs", f"""
SELECT epoch, item_id, {SQL_HASH.format("item_id || ':' || epoch || ':5'")} AS order_key
FROM benchmark, (SELECT CAST(unnest(range(1, 4)) AS INTEGER) AS epoch)""")
def epochs(spark, sf):
    from ..functions.keys import stable_hash

    return ordering.epochs(table(spark, sf, "benchmark"), 3).select(
        "epoch", "item_id", stable_hash(5, F.col("item_id"), F.col("epoch")).alias("order_key"))


@query("spl14_sample_packing", f"""
WITH RECURSIVE d AS (SELECT doc_id, {sql_ids('text')} AS ids FROM documents),
p AS (SELECT (dense_rank() OVER (ORDER BY doc_id) - 1) // 64 AS shard, doc_id, st, ids[st + 1 : st + 1024] AS piece
      FROM (SELECT *, unnest(range(0, len(ids), 1024)) AS st FROM d WHERE len(ids) > 0)),
items AS (SELECT shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, st) AS i, piece, len(piece) AS n FROM p),
fill AS (SELECT shard, i, 0 AS bin_no, n AS used FROM items WHERE i = 1
         UNION ALL
         SELECT it.shard, it.i, CASE WHEN f.used + it.n <= 1024 THEN f.bin_no ELSE f.bin_no + 1 END,
                CASE WHEN f.used + it.n <= 1024 THEN f.used + it.n ELSE it.n END
         FROM fill f JOIN items it ON it.shard = f.shard AND it.i = f.i + 1),
b AS (SELECT shard, bin_no, count(*) AS n_samples, flatten(list(piece ORDER BY i)) AS ids FROM fill JOIN items USING (shard, i) GROUP BY 1, 2)
SELECT shard, bin_no, CAST(n_samples AS INTEGER) AS n_samples, CAST(1024 - len(ids) AS INTEGER) AS n_pad,
       {_SQL_MD5_LIST.format("ids || list_transform(range(1024 - len(ids)), lambda x: 0)")} AS ids_md5 FROM b""")
def sample_packing(spark, sf):
    return sequences.pack_samples(_ids(spark, sf), "doc_id", "ids", 1024, samples_per_shard=64).select(
        "shard", "bin_no", "n_samples", "n_pad", _md5_list("input_ids").alias("ids_md5"))


_SQL_PROMPT = "E'### Instruction:\\n' || u.text || E'\\n\\n### Response:\\n'"


def _sql_instructions(source: str) -> str:
    return f"""
WITH u AS (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM {source} WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
r AS (SELECT conv_id, turn, {sql_ids(_SQL_PROMPT)} AS p, {sql_ids('answer')} AS a FROM u WHERE role = 'user' AND next_role = 'assistant')
SELECT conv_id, turn, {_SQL_MD5_LIST.format('p || a')} AS input_md5,
       {_SQL_MD5_LIST.format('list_transform(p, lambda x: -100) || a')} AS labels_md5 FROM r"""


def _instructions(messages):
    return sequences.instruction_rows(messages).select(
        "conv_id", "turn", _md5_list("input_ids").alias("input_md5"), _md5_list("labels").alias("labels_md5"))


@query("spl15_instruction_rows", f"""
{_sql_instructions("conversations")}""")
def instruction_rows(spark, sf):
    return _instructions(table(spark, sf, "conversations"))


@query("spl15_instruction_rows_over_gaps", _sql_instructions("(SELECT * FROM conversations WHERE turn % 3 <> 1)"))
def instruction_rows_over_gaps(spark, sf):
    """Conversations with every third turn removed."""
    return _instructions(table(spark, sf, "conversations").where(F.col("turn") % 3 != 1))
