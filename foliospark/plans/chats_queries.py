"""Named queries: conversations, import and export, joins on ids, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants
from ..functions.keys import document_key
from ..operators import chat, chunking, joins, ordering, sets
from ..operators.search import PostingIndex
from ..session import materialise, table, work_folder
from ..sources.buckets import BucketTable
from .chat_import import refused_bundles
from .registry import query
from .splitting_queries import sql_chunks


def _messages(spark, sf):
    return table(spark, sf, "conversations")


_SQL_TITLES = """
titles AS (SELECT conv_id, CASE WHEN length(t) > 30 THEN substring(t, 1, 30) || '...' ELSE t END AS title
           FROM (SELECT conv_id, arg_min(text, turn) AS t FROM conversations GROUP BY 1))"""


@query("prj15_conversation_title", f"WITH {_SQL_TITLES} SELECT conv_id, title FROM titles")
def conversation_title(spark, sf):
    return chat.titles(_messages(spark, sf))


def _old_conversations(spark, sf):
    """One conversation struct per message row, with fields missing or empty by turn."""
    t, c = F.col("turn"), F.col("conv_id")
    message = F.struct("role", F.col("text").alias("content"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("boolean").alias("feedback"))
    model = F.struct(F.lit("gpt-4").alias("id"), F.lit("GPT-4").alias("name"), F.lit(24000).alias("maxLength"), F.lit(8000).alias("tokenLimit"))
    return _messages(spark, sf).select("conv_id", "turn", F.struct(
        F.concat_ws(":", c.cast("string"), t.cast("string")).alias("id"), F.col("role").alias("name"),
        F.when(t % 2 == 0, F.array(message)).alias("messages"), F.when(c % 3 == 0, model).alias("model"),
        F.when(t % 3 == 0, "Be brief.").when(t % 3 == 1, "").alias("prompt"),
        F.when(c % 2 == 0, 0.5).when(c % 4 == 1, 0.0).alias("temperature"),
        F.when(t % 4 == 0, "f1").when(t % 4 == 1, "").alias("folderId")).alias("c"))


@query("prj17_conversation_defaults", f"""
SELECT conv_id || ':' || turn AS id, CASE WHEN turn % 2 = 0 THEN 1 ELSE 0 END AS n_messages,
       CASE WHEN conv_id % 3 = 0 THEN 'gpt-4' ELSE 'gpt-3.5-turbo' END AS model_id,
       CASE WHEN turn % 3 = 0 THEN 'Be brief.' ELSE '{constants.DEFAULT_PROMPT.replace("'", "''")}' END AS prompt,
       CAST(CASE WHEN conv_id % 2 = 0 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS temperature,
       CASE WHEN turn % 4 = 0 THEN 'f1' END AS folder_id FROM conversations""")
def conversation_defaults(spark, sf):
    clean = _old_conversations(spark, sf).select(chat.clean_conversation(F.col("c")).alias("c"))
    return clean.select("c.id", F.size("c.messages").alias("n_messages"), F.col("c.model.id").alias("model_id"),
                        "c.prompt", "c.temperature", F.col("c.folderId").alias("folder_id"))


def _bundles(spark, sf):
    """One export bundle per message row, of a version chosen by turn."""
    number = (F.col("conv_id") * 100 + F.col("turn")).cast("string")
    old = F.concat(F.lit('{"id":'), number, F.lit(',"name":"c'), number, F.lit('","messages":[{"role":"'), F.col("role"),
                   F.lit('","content":"m"}]}'))
    new = F.concat(F.lit('{"id":"'), number, F.lit('","name":"c","messages":[],"model":{"id":"gpt-4","name":"GPT-4","maxLength":24000,'
                   '"tokenLimit":8000},"prompt":"p","temperature":1,"folderId":null}'))
    t = F.col("turn")
    raw = (F.when(t % 6 == 0, F.concat(F.lit("["), old, F.lit(",null]")))
           .when(t % 6 == 1, F.concat(F.lit('{"history":['), old, F.lit('],"folders":[{"id":7,"name":"seven"},{"id":8,"name":"eight"}]}')))
           .when(t % 6 == 2, F.lit('{"history":null,"folders":null}'))
           .when(t % 6 == 3, F.concat(F.lit('{"version":3,"history":['), new, F.lit('],"folders":[{"id":"a","name":"A","type":"prompt"}]}')))
           .when(t % 6 == 4, F.concat(F.lit('{"version":4,"history":['), new, F.lit('],"folders":[],"prompts":[{"id":"p1","name":"P"}]}')))
           .otherwise(F.lit('{"version":5,"history":[],"folders":[]}')))
    return _messages(spark, sf).select("conv_id", "turn", raw.alias("raw"))


@query("prj18_bundle_upgrade", f"""
WITH b AS (SELECT conv_id, turn, turn % 6 AS v FROM conversations)
SELECT conv_id, turn, CAST(CASE v WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4 ELSE 0 END AS INTEGER) AS version_found,
       CASE WHEN v IN (0, 1, 3, 4) THEN 1 ELSE 0 END AS n_history,
       CASE WHEN v IN (0, 1, 3, 4) THEN CAST(conv_id * 100 + turn AS VARCHAR) END AS first_id,
       CASE WHEN v IN (0, 1) THEN 'gpt-3.5-turbo' WHEN v IN (3, 4) THEN 'gpt-4' END AS first_model,
       CASE WHEN v IN (0, 1) THEN '{constants.DEFAULT_PROMPT.replace("'", "''")}' WHEN v IN (3, 4) THEN 'p' END AS first_prompt,
       CASE WHEN v = 1 THEN '7/chat,8/chat' WHEN v = 3 THEN 'a/prompt' WHEN v IN (0, 2, 4) THEN '' END AS folders,
       CASE WHEN v = 4 THEN 1 ELSE 0 END AS n_prompts FROM b""")
def bundle_upgrade(spark, sf):
    up = chat.upgrade_bundles(_bundles(spark, sf), "raw")
    known, first = F.col("version_found").isNotNull(), F.get("history", 0)
    return up.select(
        "conv_id", "turn", F.coalesce("version_found", F.lit(0)).alias("version_found"), F.when(known, F.size("history")).otherwise(0).alias("n_history"), first["id"].alias("first_id"),
        first["model"]["id"].alias("first_model"), first["prompt"].alias("first_prompt"),
        F.when(known, F.array_join(F.transform("folders", lambda f: F.concat_ws("/", f["id"], f["type"])), ",")).alias("folders"),
        F.when(known, F.size("prompts")).otherwise(0).alias("n_prompts"))


def _sql_search(term: str) -> str:
    return f"""WITH {_SQL_TITLES}
SELECT conv_id FROM (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS body FROM conversations GROUP BY 1) JOIN titles USING (conv_id)
WHERE contains(lower(title || ' ' || body), '{term}')"""


def _search(spark, sf, term):
    names = chat.titles(_messages(spark, sf)).withColumnRenamed("title", "name")
    return chat.search_conversations(_messages(spark, sf), names, term)


@query("prj19_conversation_search", _sql_search("tion"))
def conversation_search(spark, sf):
    return _search(spark, sf, "TION")


@query("prj19_conversation_phrase_search", _sql_search("... the"))
def conversation_phrase_search(spark, sf):
    return _search(spark, sf, "... The")


@query("prj19_indexed_search", _sql_search("... the"))
def indexed_conversation_search(spark, sf):
    """Messages and names stored with posting lists in two appends; only the candidates' messages are searched."""
    messages, names = _messages(spark, sf), chat.titles(_messages(spark, sf))
    index = PostingIndex(spark, work_folder(spark, "search"), 16)
    index.append(messages, "conv_id", "text", "messages")
    index.append(names, "conv_id", "title", "names")
    found = materialise(index.candidates("... The", across_texts=True), "candidates").withColumnRenamed("key", "conv_id")
    return chat.search_conversations(messages.join(found, "conv_id", "left_semi"), names.join(found, "conv_id", "left_semi").withColumnRenamed(
        "title", "name"), "... The")


_SQL_HEAD = """'{"version":4,"history":[{"id":"' || conv_id || '","name":' || to_json(title) || ',"model":{"id":"gpt-3.5-turbo","name":"GPT-3.5",'
 || '"maxLength":12000,"tokenLimit":4000},"prompt":"Prompt ' || conv_id || '","temperature":0.5,"messages":['"""


@query("snk4_chat_export", f"""
WITH {_SQL_TITLES}
SELECT conv_id, CAST(-1 AS BIGINT) AS position, {_SQL_HEAD} AS fragment FROM titles
UNION ALL SELECT conv_id, position, CASE WHEN position > 0 THEN ',' ELSE '' END || to_json({{'role': role, 'content': text}})
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position FROM conversations)
UNION ALL SELECT conv_id, count(*), ']}}],"folders":[],"prompts":[]}}' FROM conversations GROUP BY 1""")
def chat_export(spark, sf):
    number = F.col("conv_id").cast("string")
    settings = chat.titles(_messages(spark, sf)).select(
        "conv_id", F.col("title").alias("name"), chat.default_model().alias("model"), F.concat(F.lit("Prompt "), number).alias("prompt"),
        F.lit(0.5).alias("temperature"), F.lit(None).cast("string").alias("folderId"))
    return chat.export_fragments(_messages(spark, sf), settings)


_SQL_MODEL_JSON = '{"id":"gpt-3.5-turbo","name":"GPT-3.5","maxLength":12000,"tokenLimit":4000}'


@query("snk4_whole_bundle", f"""
WITH {_SQL_TITLES}, first AS (SELECT min(conv_id) AS c FROM conversations),
o AS (SELECT conv_id, CASE WHEN conv_id > first.c THEN ',' ELSE '' END || '{{"id":"' || conv_id || '","name":' || to_json(title) || ',"model":{_SQL_MODEL_JSON},'
      || '"prompt":"Prompt ' || conv_id || '","temperature":0.5,"folderId":"' || conv_id % 25 || '","messages":[' AS fragment FROM titles, first)
SELECT 0 AS section, CAST(0 AS BIGINT) AS item, CAST(0 AS BIGINT) AS position, '{{"version":4,"history":[' AS fragment
UNION ALL SELECT 2, 0, 0, '],"folders":[' UNION ALL SELECT 4, 0, 0, '],"prompts":[' UNION ALL SELECT 6, 0, 0, ']}}'
UNION ALL SELECT 1, conv_id, -1, fragment FROM o
UNION ALL SELECT 1, conv_id, position, CASE WHEN position > 0 THEN ',' ELSE '' END || to_json({{'role': role, 'content': text}})
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position FROM conversations)
UNION ALL SELECT 1, conv_id, count(*), ']}}' FROM conversations GROUP BY conv_id
UNION ALL SELECT 3, no, 0, CASE WHEN no > 1 THEN ',' ELSE '' END || to_json({{'id': id, 'name': n_name, 'type': 'chat'}})
FROM (SELECT *, CAST(n_nationkey AS VARCHAR) AS id, row_number() OVER (ORDER BY CAST(n_nationkey AS VARCHAR)) AS no FROM nation)
UNION ALL SELECT 5, no, 0, CASE WHEN no > 1 THEN ',' ELSE '' END || to_json({{'id': id, 'name': p_name, 'description': p_type, 'content': p_brand, 'folderId': CAST(p_partkey % 25 AS VARCHAR)}})
FROM (SELECT *, CAST(p_partkey AS VARCHAR) AS id, row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) AS no FROM part)""")
def whole_bundle(spark, sf):
    number = F.col("conv_id").cast("string")
    settings = chat.titles(_messages(spark, sf)).select(
        "conv_id", F.col("title").alias("name"), chat.default_model().alias("model"), F.concat(F.lit("Prompt "), number).alias("prompt"),
        F.lit(0.5).alias("temperature"), (F.col("conv_id") % 25).cast("string").alias("folderId"))
    folders = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"), F.lit("chat").alias("type"))
    prompts = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("description"),
                                              F.col("p_brand").alias("content"), (F.col("p_partkey") % 25).cast("string").alias("folderId"))
    return chat.export_whole_bundle(_messages(spark, sf), settings, folders, prompts)


@query("agg9_assemble_conversation", """
SELECT conv_id, position, CASE WHEN position > 0 THEN chr(10) ELSE '' END || role || ': ' || text AS fragment
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position FROM conversations)""")
def assemble_conversation(spark, sf):
    return chat.transcript(_messages(spark, sf))


@query("prj18_refused_bundles", "SELECT conv_id, turn, 'Unsupported data format' AS reason FROM conversations WHERE turn % 6 = 5")
def refused(spark, sf):
    return refused_bundles(_bundles(spark, sf), "raw").select("conv_id", "turn", "reason")


@query("win1_first_ids", "SELECT doc_id FROM labels ORDER BY doc_id LIMIT 50")
def first_ids(spark, sf):
    return ordering.first_rows(table(spark, sf, "labels").select("doc_id"), "doc_id", 50)


@query("win2_last_message", "SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text FROM conversations GROUP BY 1")
def last_message(spark, sf):
    return chat.last_message(_messages(spark, sf)).select("conv_id", "turn", "text")


@query("win3_second_to_last", """
SELECT conv_id, turn, role, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 2""")
def second_to_last(spark, sf):
    return chat.nth_from_end(_messages(spark, sf), 2)


@query("win4_replace_tail", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS b FROM conversations)
SELECT conv_id, turn, role, text FROM r WHERE conv_id % 2 = 1 OR b > 2
UNION ALL SELECT conv_id, min(turn), 'user', 'edited' FROM r WHERE conv_id % 2 = 0 AND b <= 2 GROUP BY conv_id""")
def replace_tail(spark, sf):
    edits = _messages(spark, sf).where(F.col("conv_id") % 2 == 0).select("conv_id").distinct().select(
        "conv_id", F.lit("user").alias("role"), F.lit("edited").alias("text"))
    return chat.replace_tail(_messages(spark, sf), edits, 2)


def _sql_deleted(source: str) -> str:
    return f"""
SELECT conv_id, turn, role FROM (SELECT *, lag((conv_id + turn) % 4 = 0) OVER (PARTITION BY conv_id ORDER BY turn) AS pd FROM {source})
WHERE NOT ((conv_id + turn) % 4 = 0 OR (coalesce(pd, false) AND role = 'assistant'))"""


def _deleted(rows):
    gone = rows.where((F.col("conv_id") + F.col("turn")) % 4 == 0)
    return chat.delete_with_reply(rows, gone).select("conv_id", "turn", "role")


@query("win5_delete_with_reply", _sql_deleted("conversations"))
def delete_with_reply(spark, sf):
    return _deleted(_messages(spark, sf))


@query("win5_delete_with_reply_over_gaps", _sql_deleted("(SELECT * FROM conversations WHERE turn % 3 <> 1)"))
def delete_with_reply_over_gaps(spark, sf):
    """Conversations with every third turn removed."""
    return _deleted(_messages(spark, sf).where(F.col("turn") % 3 != 1))


@query("win4_append_message", """
SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT conv_id, max(turn) + 1, 'user', 'new' FROM conversations GROUP BY conv_id""")
def append_message(spark, sf):
    """Nothing dropped: the message comes behind the last."""
    edits = _messages(spark, sf).select("conv_id").distinct().select("conv_id", F.lit("user").alias("role"), F.lit("new").alias("text"))
    return chat.replace_tail(_messages(spark, sf), edits, 0)


@query("win6_newest_item", "SELECT conv_id, turn, md5(text) AS text_md5 FROM conversations ORDER BY conv_id * 1000 + turn DESC LIMIT 1")
def newest_item(spark, sf):
    rows = _messages(spark, sf).select((F.col("conv_id") * 1000 + F.col("turn")).alias("position"), "conv_id", "turn", F.md5("text").alias("text_md5"))
    return chat.newest(rows, "position").drop("position")


@query("win7_sorted_folders", "SELECT n_nationkey, n_name FROM nation ORDER BY lower(n_name), n_name")
def sorted_folders(spark, sf):
    return chat.sorted_folders(table(spark, sf, "nation").select("n_nationkey", "n_name"), "n_name")


@query("win8_inherited_settings", """
WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type IN ('signup', 'purchase') THEN event_type || event_id END AS own FROM events)
SELECT event_id, user_id, coalesce(last_value(own IGNORE NULLS) OVER w, 'default') AS setting,
       'Prompt ' || row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS name
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def inherited_settings(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", "user_id", "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        F.when(F.col("event_type").isin("signup", "purchase"), F.concat("event_type", F.col("event_id").cast("string"))).alias("own"))
    # Pieces of the time axis with a bounded number of rows, so a busy user of one day is several tasks.
    pieces = ordering.segmented(rows, "at", 50_000, "event_id")
    pieces = rows.withColumn("_segment", F.lit(0)) if pieces is None else pieces
    carried = ordering.carry_forward(pieces, ["user_id"], ["ts", "event_id"], "_segment", {"setting": "own"}, number="n")
    return carried.select("event_id", "user_id", F.coalesce("setting", F.lit("default")).alias("setting"),
                          F.concat(F.lit("Prompt "), F.col("n").cast("string")).alias("name"))


@query("set1_merge_first_wins", """
SELECT id, name, position FROM (SELECT doc_id AS id, md5(text) AS name, doc_id AS position, 0 AS src FROM documents
 UNION ALL SELECT page_id * 7, url, page_id, 1 FROM pages UNION ALL SELECT page_id * 7, 'again', page_id + 1000, 1 FROM pages)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY src, position) = 1""")
def merge_first_wins(spark, sf):
    old = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.md5("text").alias("name"), F.col("doc_id").alias("position"))
    pages = table(spark, sf, "pages")
    new = pages.select((F.col("page_id") * 7).alias("id"), F.col("url").alias("name"), F.col("page_id").alias("position"))
    again = pages.select((F.col("page_id") * 7).alias("id"), F.lit("again").alias("name"), (F.col("page_id") + 1000).alias("position"))
    return sets.merge_first_wins([old, new.unionByName(again)], "id", "position")


@query("set2_distinct_by_key", """
SELECT doc_id, source, md5(text) AS text_md5 FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1""")
def distinct_by_key(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source", F.md5("text").alias("text_md5"))
    return sets.first_per_key(rows, ["text_md5"], ["doc_id"])


@query("set3_delete_ids", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def delete_ids(spark, sf):
    return sets.delete_ids(table(spark, sf, "documents").select("doc_id", "source"),
                           table(spark, sf, "labels").where(F.col("toxic") == 1), "doc_id")


@query("set3_clear_type", "SELECT event_id, event_type FROM events WHERE event_type <> 'view'")
def clear_type(spark, sf):
    return sets.clear_type(table(spark, sf, "events").select("event_id", "event_type"), "event_type", "view")


@query("set4_upsert", """
SELECT doc_id AS id, source AS value FROM documents WHERE doc_id NOT IN (SELECT page_id * 5 FROM pages)
UNION ALL SELECT page_id * 5, url FROM pages""")
def upsert(spark, sf):
    base = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("value"))
    updates = table(spark, sf, "pages").select((F.col("page_id") * 5).alias("id"), F.col("url").alias("value"))
    return sets.upsert(base, updates, "id")


@query("set4_stored_upsert", """
SELECT doc_id AS id, source AS value FROM documents WHERE doc_id NOT IN (SELECT page_id * 5 FROM pages)
UNION ALL SELECT page_id * 5, url FROM pages""")
def stored_upsert(spark, sf):
    """The same on a stored table, in buckets; the change is run twice."""
    stored = BucketTable(spark, work_folder(spark, "items"), "id long, value string", "id", 16)
    stored.upsert(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("value")))
    updates = table(spark, sf, "pages").select((F.col("page_id") * 5).alias("id"), F.col("url").alias("value"))
    for _ in range(2):
        stored.upsert(updates)
    return stored.read()


@query("set3_stored_delete", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def stored_delete(spark, sf):
    stored = BucketTable(spark, work_folder(spark, "items"), "doc_id long, source string", "doc_id", 16)
    stored.upsert(table(spark, sf, "documents").select("doc_id", "source"))
    stored.delete(table(spark, sf, "labels").where(F.col("toxic") == 1).select("doc_id"))
    return stored.read()


@query("set5_missing_ids", "SELECT vec_id * 7 AS doc_id FROM embeddings EXCEPT SELECT doc_id FROM documents")
def missing_ids(spark, sf):
    wanted = table(spark, sf, "embeddings").select((F.col("vec_id") * 7).alias("doc_id"))
    return joins.missing_ids(wanted, table(spark, sf, "documents"), "doc_id")


@query("jn1_lookup_by_id", """
SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN '' ELSE text END AS text FROM documents JOIN labels USING (doc_id)""")
def lookup_by_id(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 10 != 0, F.col("text")).alias("text"))
    return joins.lookup_by_id(table(spark, sf, "labels").select("doc_id"), rows, "doc_id", "text")


@query("jn1_lookup_misses", "SELECT DISTINCT o_custkey AS doc_id FROM orders WHERE o_custkey NOT IN (SELECT doc_id FROM documents)")
def lookup_misses(spark, sf):
    wanted = table(spark, sf, "orders").select(F.col("o_custkey").alias("doc_id"))
    return joins.missing_ids(wanted, table(spark, sf, "documents"), "doc_id")


@query("jn2_chunk_documents", f"""
WITH {sql_chunks(256, 0)}
SELECT sha256(source || doc_id) AS dockey, chunk_no, md5(chunk) AS chunk_md5, source, lang FROM chunks JOIN documents USING (doc_id)""")
def chunk_documents(spark, sf):
    docs = table(spark, sf, "documents").withColumn("dockey", document_key(F.col("source"), F.col("doc_id").cast("string")))
    chunks = chunking.split_tokens(docs.select(F.col("dockey").alias("doc"), "text"), "text", 256, adjacent=False)
    return joins.chunks_with_documents(chunks, docs.select("dockey", "source", "lang")).select(
        "dockey", "chunk_no", F.md5("chunk").alias("chunk_md5"), "source", "lang")


_EVENT_MODELS = [("view", "gpt-4"), ("click", "gpt-35-turbo"), ("signup", "unknown-model"), ("error", "gpt-4-32k")]


@query("jn6_known_models", f"""
WITH r(event_type, model_id) AS (VALUES {constants.sql_values(_EVENT_MODELS)}),
m(model_id, model_name, max_length, token_limit) AS (VALUES {constants.sql_values(constants.MODELS)})
SELECT event_id, model_id, model_name FROM events JOIN r USING (event_type) JOIN m USING (model_id)""")
def known_models(spark, sf):
    wanted = constants.values_frame(spark, ["event_type", "model_id"], _EVENT_MODELS)
    requests = table(spark, sf, "events").select("event_id", "event_type").join(wanted, "event_type")
    return joins.known_models(requests, constants.model_table(spark), "model_id").select("event_id", "model_id", "model_name")


@query("jn7_attach_feedback", """
WITH f AS (SELECT user_id AS conv_id, event_id % 9 AS turn, arg_max(CASE WHEN event_type = 'click' THEN 'positive' ELSE 'negative' END, (ts, event_id)) AS nf
           FROM events WHERE event_type IN ('click', 'error') GROUP BY 1, 2)
SELECT conv_id, turn, coalesce(nf, CASE WHEN turn = 1 THEN 'positive' END) AS feedback FROM conversations LEFT JOIN f USING (conv_id, turn)""")
def attach_feedback(spark, sf):
    messages = _messages(spark, sf).select("conv_id", "turn", F.when(F.col("turn") == 1, "positive").alias("feedback"))
    posts = table(spark, sf, "events").where(F.col("event_type").isin("click", "error")).select(
        F.col("user_id").alias("conv_id"), (F.col("event_id") % 9).alias("turn"), "ts", "event_id",
        F.when(F.col("event_type") == "click", "positive").otherwise("negative").alias("feedback"))
    return joins.attach_feedback(messages, posts, ["conv_id", "turn"], ["ts", "event_id"])


@query("jn8_drop_dangling", """
SELECT c_custkey, CASE WHEN n_regionkey <> 2 THEN CAST(c_nationkey AS VARCHAR) END AS folder_id FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def drop_dangling(spark, sf):
    folders = table(spark, sf, "nation").where(F.col("n_regionkey") != 2)
    items = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("folder_id"))
    kept = joins.drop_dangling(items, folders, "folder_id", "n_nationkey")
    return kept.withColumn("folder_id", F.col("folder_id").cast("string"))


@query("jn9_filed_items", """
SELECT c_custkey, CAST(folder_id AS VARCHAR) AS folder_id, n_name FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS folder_id FROM customer)
LEFT JOIN nation ON n_nationkey = folder_id""")
def filed_items(spark, sf):
    items = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("folder_id"))
    return joins.filed_items(items, table(spark, sf, "nation").select("n_nationkey", "n_name"), "folder_id", "n_nationkey",
                             "n_name", "c_custkey").select("c_custkey", F.col("folder_id").cast("string").alias("folder_id"), "n_name")
