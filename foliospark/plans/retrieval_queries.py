"""Named queries: vectors, retrieval, cache, context assembly and whole question answering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants, embedding, keys, vectors
from ..functions.generate import posexplode_rows
from ..operators import chunking, retrieval, sequences, terms
from ..operators.similarity import top_k_similar
from ..session import materialise, spread, table, work_folder
from .registry import query
from .splitting_queries import SQL_HASH, SQL_TOKENS, sql_chunks


def sql_embed(name: str, source: str, key: str, text: str) -> str:
    """CTEs ``<name>`` (key, slot, v) and ``<name>_norm`` (key, norm): signed hashed token counts."""
    return f"""
{name}_tok AS (SELECT {key} AS id, {SQL_HASH.format('w')} AS h FROM (SELECT {key}, unnest({SQL_TOKENS.format(text)}) AS w FROM {source})),
{name} AS (SELECT id, h % 64 AS slot, sum(CASE WHEN (h // 64) % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS v FROM {name}_tok GROUP BY 1, 2),
{name}_norm AS (SELECT id, sqrt(sum(v * v)) AS norm FROM {name} GROUP BY 1 HAVING sum(v * v) > 0)"""


def sql_scores(left: str, right: str) -> str:
    return f"""
SELECT qn.id AS question_id, cn.id AS doc_id, round(coalesce(d.dot, 0) / (qn.norm * cn.norm), 6) + 0.0 AS score
FROM {left}_norm qn CROSS JOIN {right}_norm cn
LEFT JOIN (SELECT a.id AS qid, b.id AS cid, sum(a.v * b.v) AS dot FROM {left} a JOIN {right} b USING (slot) GROUP BY 1, 2) d
       ON d.qid = qn.id AND d.cid = cn.id"""


@query("vec1_embed_texts", f"""
WITH {sql_embed('e', 'documents', 'doc_id', 'text')}, slots AS (SELECT unnest(range(64)) AS slot)
SELECT doc_id, CAST(s.slot AS INTEGER) AS slot, coalesce(e.v, 0.0) AS value
FROM documents CROSS JOIN slots s LEFT JOIN e ON e.id = doc_id AND e.slot = s.slot""")
def embed_texts(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id").select("doc_id", embedding.embed(F.col("text")).alias("vector"))
    return posexplode_rows(docs, ["doc_id"], "vector", "slot", "value")


@query("vec2_l2_normalise", """
WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE) * 3) AS e FROM embeddings),
n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda v: v * v))) AS norm FROM x)
SELECT vec_id, CAST(unnest(range(64)) AS INTEGER) AS pos, round(unnest(e) / norm, 6) + 0.0 AS value FROM n""")
def l2_normalise(spark, sf):
    scaled = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double") * 3).alias("e"))
    rows = scaled.select("vec_id", vectors.l2_normalise(F.col("e")).alias("u"))
    return posexplode_rows(rows, ["vec_id"], "u", "pos", "v").select("vec_id", "pos", F.round("v", 6).alias("value"))


@query("vec3_cosine", """
SELECT a.vec_id, round(list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)), 6) + 0.0 AS score
FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) a
JOIN (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) b ON b.vec_id = a.vec_id + 1""")
def cosine(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    following = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return rows.join(following, "vec_id").select("vec_id", vectors.cosine(F.col("embedding"), F.col("other")).alias("score"))


_SQL_VECTORS = """
v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm FROM embeddings),
pairs AS (SELECT a.vec_id AS question_id, b.vec_id AS doc_id, a.label AS q_label, b.label AS d_label,
                 round(list_dot_product(a.e, b.e) / (a.norm * b.norm), 6) + 0.0 AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM pairs)"""


def stored_neighbours(spark, sf, k: int = 3):
    rows = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return top_k_similar(rows, rows, k, question_id="vec_id", doc_id="vec_id", exclude_self=True)


@query("vec4_top_k_vectors", f"WITH {_SQL_VECTORS} SELECT question_id, doc_id, score, rank FROM ranked WHERE rank <= 3")
def top_k_vectors(spark, sf):
    return stored_neighbours(spark, sf)


def chunk_table(spark, sf):
    """Chunks of all documents with their neighbours and a numeric id."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "source", "text"), "doc_id")
    return chunking.split_tokens(docs, "text", 256).select(
        keys.chunk_id(F.col("doc_id"), F.col("chunk_no")).alias("chunk_id"), "doc_id", "source", "chunk_no", "chunk", "prev", "next")


def question_table(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))


def sql_chunk_id(*key: str) -> str:
    return f"CAST('0x' || substr(md5({" || ':' || ".join(key)}), 1, 15) AS BIGINT)"


def sql_hits(chunks: str) -> str:
    """The five nearest chunks of each question among ``chunks`` (chunk_id, chunk)."""
    return f"""{sql_embed('q', 'benchmark', 'item_id', 'text')}, {sql_embed('c', chunks, 'chunk_id', 'chunk')},
scored AS ({sql_scores('q', 'c')}),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank FROM scored) WHERE rank <= 5)"""


SQL_RETRIEVED = f"""{sql_chunks(256, 0)},
ck AS (SELECT {sql_chunk_id('doc_id', 'chunk_no')} AS chunk_id, doc_id, chunk_no, chunk FROM chunks),
{sql_hits('ck')},
both_texts AS (SELECT h.question_id, h.doc_id AS chunk_id, ck.doc_id, ck.chunk_no, h.score, h.rank, b.text AS question, ck.chunk,
    list_distinct({SQL_TOKENS.format('lower(b.text)')}) AS qt, list_distinct({SQL_TOKENS.format('lower(ck.chunk)')}) AS ct
    FROM hits h JOIN ck ON ck.chunk_id = h.doc_id JOIN benchmark b ON b.item_id = h.question_id),
jac AS (SELECT *, round(len(list_intersect(qt, ct)) / (len(qt) + len(ct) - len(list_intersect(qt, ct))), 6) AS rerank_score FROM both_texts),
reranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY rerank_score DESC, rank) AS INTEGER) AS new_rank FROM jac)"""


def reranked(spark, sf):
    """The chunks are written once: the search and the join of its few hits read them."""
    chunks = materialise(chunk_table(spark, sf), "chunks")
    return retrieval.rerank(retrieval.retrieve_chunks(question_table(spark, sf), chunks), question_table(spark, sf), chunks)


@query("jn3_vector_search", f"WITH {SQL_RETRIEVED} SELECT question_id, doc_id AS chunk_id, score, CAST(rank AS INTEGER) AS rank FROM hits WHERE rank <= 3")
def vector_search(spark, sf):
    return retrieval.retrieve_chunks(question_table(spark, sf), chunk_table(spark, sf), 3, 0)


@query("vec5_rerank", f"WITH {SQL_RETRIEVED} SELECT question_id, chunk_id, score, rerank_score, new_rank FROM reranked")
def rerank(spark, sf):
    return reranked(spark, sf).select("question_id", "chunk_id", "score", "rerank_score", "new_rank")


_SQL_TERMS = f"""
toks AS (SELECT chunk_id, unnest({SQL_TOKENS.format('lower(chunk)')}) AS w FROM ck),
df AS (SELECT w, count(DISTINCT chunk_id) AS df FROM toks GROUP BY 1),
tf AS (SELECT chunk_id, w, count(*) AS tf FROM toks GROUP BY 1, 2),
len AS (SELECT chunk_id, count(*) AS len FROM toks GROUP BY 1),
tot AS (SELECT count(*) AS n, sum(len) / count(*) AS avg_len FROM len),
gain AS (SELECT h.question_id, h.chunk_id, ln(1 + (tot.n - df.df + 0.5) / (df.df + 0.5)) * tf.tf * 2.2 / (tf.tf + 1.2 * (0.25 + 0.75 * len.len / tot.avg_len)) AS g
         FROM (SELECT question_id, chunk_id, unnest(qt) AS w FROM both_texts) h JOIN df USING (w) JOIN tf ON tf.chunk_id = h.chunk_id AND tf.w = h.w
         JOIN len ON len.chunk_id = h.chunk_id CROSS JOIN tot),
bm AS (SELECT b.question_id, b.chunk_id, b.score, b.rank, round(coalesce(sum(g), 0.0), 6) AS rerank_score FROM both_texts b LEFT JOIN gain USING (question_id, chunk_id) GROUP BY ALL)"""


@query("vec5_rerank_by_terms", f"""WITH {SQL_RETRIEVED}, {_SQL_TERMS}
SELECT question_id, chunk_id, score, rerank_score, CAST(row_number() OVER (PARTITION BY question_id ORDER BY rerank_score DESC, rank) AS INTEGER) AS new_rank FROM bm""")
def rerank_by_terms(spark, sf):
    """Statistics of two appends, the second one repeated."""
    chunks, store = materialise(chunk_table(spark, sf), "chunks"), terms.TermStore(spark, work_folder(spark, "terms"))
    for batch, part in (("even", F.col("doc_id") % 2 == 0), ("odd", F.col("doc_id") % 2 != 0), ("odd", F.col("doc_id") % 2 != 0)):
        store.append(chunks.where(part), "chunk", batch)
    hits = retrieval.retrieve_chunks(question_table(spark, sf), chunks)
    return terms.rerank_by_terms(hits, question_table(spark, sf), chunks, store).select("question_id", "chunk_id", "score", "rerank_score", "new_rank")


@query("vec6_max_sources", f"WITH {SQL_RETRIEVED} SELECT question_id, chunk_id, new_rank FROM reranked WHERE new_rank <= 3")
def max_sources(spark, sf):
    return retrieval.keep_sources(reranked(spark, sf), 3).select("question_id", "chunk_id", "new_rank")


@query("vec7_contexts", f"""WITH {SQL_RETRIEVED}
SELECT question_id, string_agg(chunk, E'\\n---\\n' ORDER BY new_rank) AS context FROM reranked WHERE new_rank <= 3 GROUP BY 1""")
def contexts(spark, sf):
    return retrieval.joined_context(retrieval.keep_sources(reranked(spark, sf), 3), "chunk", "\n---\n")


@query("vec8_references", f"""WITH {SQL_RETRIEVED},
named AS (SELECT question_id, ' [' || doc_id || ']' AS name, min(new_rank) AS r FROM reranked WHERE new_rank <= 3 GROUP BY 1, 2)
SELECT question_id, string_agg(name, '' ORDER BY r) AS "references" FROM named GROUP BY 1""")
def references(spark, sf):
    kept = retrieval.keep_sources(reranked(spark, sf), 3).withColumn(
        "name", F.concat(F.lit(" ["), F.col("doc_id").cast("string"), F.lit("]")))
    return retrieval.references(kept, "name")


def _sql_window(source: str) -> str:
    return f"""
SELECT conv_id, turn, coalesce(array_to_string(h, '|'), '') AS history, text
FROM (SELECT *, list(text) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS h FROM {source})
WHERE role = 'user'"""


def _windows(messages):
    return retrieval.chat_window(messages).select("conv_id", "turn", F.array_join("history", "|").alias("history"), "text")


@query("vec9_chat_window", _sql_window("conversations"))
def chat_window(spark, sf):
    return _windows(table(spark, sf, "conversations"))


@query("vec9_chat_window_over_gaps", _sql_window("(SELECT * FROM conversations WHERE turn % 3 <> 1)"))
def chat_window_over_gaps(spark, sf):
    """Conversations with every third turn removed."""
    return _windows(table(spark, sf, "conversations").where(F.col("turn") % 3 != 1))


@query("vec10_token_budget", f"""WITH {SQL_RETRIEVED},
t AS (SELECT question_id, chunk_id, new_rank, len({SQL_TOKENS.format('chunk')}) AS n FROM reranked),
u AS (SELECT *, sum(n) OVER (PARTITION BY question_id ORDER BY new_rank) AS used FROM t)
SELECT question_id, chunk_id, new_rank, CAST(used AS BIGINT) AS used_tokens FROM u WHERE used <= 600""")
def token_budget(spark, sf):
    return retrieval.within_budget(reranked(spark, sf), 600, "chunk").select("question_id", "chunk_id", "new_rank", "used_tokens")


_SQL_MODEL = "CASE r.question_id % 3 WHEN 0 THEN 'gpt-4' WHEN 1 THEN 'gpt-3.5-turbo' ELSE 'gpt-35-turbo' END"


@query("vec10_model_budget", f"""WITH {SQL_RETRIEVED},
m(model_id, model_name, max_length, token_limit) AS (VALUES {constants.sql_values(constants.MODELS)}),
t AS (SELECT r.question_id, r.chunk_id, new_rank, m.token_limit, len({SQL_TOKENS.format('chunk')}) AS n FROM reranked r JOIN m ON m.model_id = {_SQL_MODEL}),
u AS (SELECT *, sum(n) OVER (PARTITION BY question_id ORDER BY new_rank) AS used FROM t)
SELECT question_id, chunk_id, new_rank, CAST(used AS BIGINT) AS used_tokens FROM u WHERE used <= token_limit // 10""")
def model_budget(spark, sf):
    """A tenth of the token limit of each question's model."""
    q = F.col("question_id")
    model = F.when(q % 3 == 0, "gpt-4").when(q % 3 == 1, "gpt-3.5-turbo").otherwise("gpt-35-turbo")
    limited = reranked(spark, sf).withColumn("model_id", model).join(constants.model_table(spark), "model_id")
    return retrieval.within_budget(limited, F.floor(F.col("token_limit") / 10), "chunk").select(
        "question_id", "chunk_id", "new_rank", "used_tokens")


@query("vec11_question_batches", f"""WITH {SQL_RETRIEVED},
b AS (SELECT item_id, (row_number() OVER (ORDER BY item_id) - 1) // 16 AS batch_no FROM benchmark)
SELECT batch_no, question_id, chunk_id FROM reranked JOIN b ON item_id = question_id WHERE new_rank = 1""")
def question_batches(spark, sf):
    batches = retrieval.question_batches(question_table(spark, sf)).select("question_id", "batch_no")
    return retrieval.keep_sources(reranked(spark, sf), 1).join(batches, "question_id").select("batch_no", "question_id", "chunk_id")


@query("vec12_training_groups", f"""
WITH {_SQL_VECTORS},
pos AS (SELECT question_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS r
        FROM pairs WHERE q_label = d_label) WHERE r = 1),
neg AS (SELECT question_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS r
        FROM pairs WHERE q_label <> d_label) WHERE r = 1),
clip AS (SELECT doc_id, array_to_string({SQL_TOKENS.format('text')}[1:64], ' ') AS q64, array_to_string({SQL_TOKENS.format('text')}[1:256], ' ') AS p256 FROM documents)
SELECT question_id, pos.doc_id AS positive_id, neg.doc_id AS negative_id, q.q64 AS query_text, md5(p.p256) AS positive_md5, md5(n.p256) AS negative_md5
FROM pos JOIN neg USING (question_id) JOIN clip q ON q.doc_id = question_id JOIN clip p ON p.doc_id = pos.doc_id JOIN clip n ON n.doc_id = neg.doc_id""")
def training_groups(spark, sf):
    groups = retrieval.training_groups(table(spark, sf, "embeddings"), key="vec_id", vector="embedding", group="label")
    docs = table(spark, sf, "documents")
    texts = {role: docs.select(F.col("doc_id").alias(key), text.alias(out)) for role, key, text, out in (
        ("q", "question_id", sequences.clip_tokens(F.col("text"), 64), "query_text"),
        ("p", "positive_id", F.md5(sequences.clip_tokens(F.col("text"), 256)), "positive_md5"),
        ("n", "negative_id", F.md5(sequences.clip_tokens(F.col("text"), 256)), "negative_md5"))}
    return (groups.join(texts["q"], "question_id").join(texts["p"], "positive_id").join(texts["n"], "negative_id")
            .select("question_id", "positive_id", "negative_id", "query_text", "positive_md5", "negative_md5"))


_SQL_CACHE = f"""
inc AS (SELECT conv_id * 1000 + turn AS question_id, text AS question FROM conversations WHERE role = 'user' AND turn > 0),
cache AS (SELECT min(conv_id) AS cache_id, text AS question FROM conversations WHERE role = 'user' AND turn = 0 GROUP BY text),
{sql_embed('i', 'inc', 'question_id', 'question')}, {sql_embed('k', 'cache', 'cache_id', 'question')},
sc AS ({sql_scores('i', 'k')}),
r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank FROM sc),
n AS (SELECT *, rank = 1 AND score >= {{hit}} AS hit FROM r WHERE rank <= 4),
f AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY rank) AS fr FROM n WHERE NOT hit AND score >= {{near}}),
g AS (SELECT question_id, max(score) AS best_score, max(CASE WHEN hit THEN doc_id END) AS cache_id FROM n GROUP BY 1),
s AS (SELECT question_id, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rank) AS suggestions FROM f WHERE fr <= 3 GROUP BY 1)"""


def cache_lookup(spark, sf, threshold=0.90, suggestion_threshold=0.85):
    users = table(spark, sf, "conversations").where(F.col("role") == "user")
    incoming = users.where(F.col("turn") > 0).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("question_id"), F.col("text").alias("question"))
    cache = users.where(F.col("turn") == 0).select(F.col("conv_id").alias("cache_id"), F.col("text").alias("question"))
    return retrieval.question_cache(incoming, cache, threshold=threshold, suggestion_threshold=suggestion_threshold)


_SQL_CACHE_STATUS = f"""
WITH {_SQL_CACHE}
SELECT inc.question_id, CASE WHEN g.cache_id IS NOT NULL THEN 'hit' WHEN suggestions IS NOT NULL THEN 'suggest' ELSE 'miss' END AS status,
       CAST(g.cache_id AS VARCHAR) AS cache_id, g.best_score, coalesce(suggestions, '') AS suggestions
FROM inc LEFT JOIN g USING (question_id) LEFT JOIN s USING (question_id)"""


def _flat(looked_up):
    return looked_up.withColumns({"cache_id": F.col("cache_id").cast("string"),
                                  "suggestions": F.array_join(F.col("suggestions").cast("array<string>"), ",")})


@query("jn4_question_cache", _SQL_CACHE_STATUS.format(hit=0.90, near=0.85))
def question_cache(spark, sf):
    return _flat(cache_lookup(spark, sf))


@query("jn4_question_cache_wide", _SQL_CACHE_STATUS.format(hit=0.6, near=0.5))
def question_cache_wide(spark, sf):
    return _flat(cache_lookup(spark, sf, 0.6, 0.5))
