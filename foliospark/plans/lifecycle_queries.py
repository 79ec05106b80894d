"""Named queries: whole jobs, and the plug-in points."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants, embedding, keys
from ..functions.tables import line_splitter
from ..functions.text import judge_score
from ..operators import chat, evaluation, retrieval
from ..operators.sizes import BROADCAST_ROWS, at_most, broadcast_when
from ..session import materialise, spread, table, work_folder
from ..sources import datasets
from .answer import AnswerCache, AnswerSettings, acronym_expander, answer_questions, personal_data_remover, post_process
from .chat_import import import_bundles, import_history
from .chats_queries import _bundles
from .ingest import ingest_documents
from .evaluate import evaluation_run
from .metrics_queries import _SQL_PAIRS, answer_pairs, truth_table
from .registry import query
from .retrieval_queries import SQL_RETRIEVED, chunk_table, question_table, reranked, sql_chunk_id, sql_embed, sql_hits, sql_scores
from .scalars_queries import SQL_JUDGED, judge_replies
from .splitting_queries import SQL_TOKENS, sql_chunks
from .training import export_chunks, read_shards

_SQL_SOURCES = f"""{SQL_RETRIEVED},
nb AS (SELECT doc_id, chunk_no, concat_ws(' ', lag(chunk) OVER w, chunk, lead(chunk) OVER w) AS body FROM chunks
       WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_no)),
src AS (SELECT r.question_id, r.question, r.doc_id, new_rank, body, sum(len({SQL_TOKENS.format('body')})) OVER (PARTITION BY r.question_id ORDER BY new_rank) AS used
        FROM reranked r JOIN nb ON nb.doc_id = r.doc_id AND nb.chunk_no = r.chunk_no WHERE new_rank <= 3),
named AS (SELECT question_id, 'doc ' || doc_id AS name, min(new_rank) AS r FROM src WHERE used <= 1024 GROUP BY 1, 2),
refs AS (SELECT question_id, string_agg(name, ', ' ORDER BY r) AS "references" FROM named GROUP BY 1),
ctx AS (SELECT question_id, string_agg(body, E'\\n\\n' ORDER BY new_rank) AS context FROM src WHERE used <= 1024 GROUP BY 1)"""
_SQL_PROMPT = "E'Answer the question from the sources.\\n\\nSources:\\n' || coalesce(context, '') || E'\\n\\nQuestion: ' || text || E'\\n'"


def _named_chunks(spark, sf):
    return chunk_table(spark, sf).withColumn("name", F.concat(F.lit("doc "), F.col("doc_id").cast("string")))


def _flat(answered):
    return answered.withColumn("cache_id", F.col("cache_id").cast("string"))


@query("lifecycle_answers", f"""
WITH {_SQL_SOURCES}
SELECT item_id AS question_id, 'miss' AS status, CAST(NULL AS VARCHAR) AS cache_id, context, "references", {_SQL_PROMPT} AS prompt
FROM benchmark LEFT JOIN ctx ON ctx.question_id = item_id LEFT JOIN refs ON refs.question_id = item_id""")
def answers(spark, sf):
    return _flat(answer_questions(question_table(spark, sf), _named_chunks(spark, sf)))


@query("lifecycle_cached_answers", f"""
WITH {_SQL_SOURCES},
cache AS (SELECT min(conv_id) AS cache_id, text FROM (SELECT conv_id, text FROM conversations WHERE role = 'user'
          UNION ALL SELECT 1000000 + item_id, text FROM benchmark) GROUP BY text),
{sql_embed('i', 'benchmark', 'item_id', 'text')}, {sql_embed('k', 'cache', 'cache_id', 'text')},
sc AS ({sql_scores('i', 'k')}),
best AS (SELECT question_id, doc_id AS cache_id, score FROM sc QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) = 1)
SELECT item_id AS question_id, CASE WHEN score >= 0.9 THEN 'hit' WHEN score >= 0.85 THEN 'suggest' ELSE 'miss' END AS status,
       CASE WHEN score >= 0.9 THEN CAST(cache_id AS VARCHAR) END AS cache_id, CASE WHEN score < 0.9 THEN context END AS context,
       CASE WHEN score < 0.9 THEN "references" END AS "references", CASE WHEN score < 0.9 THEN {_SQL_PROMPT} END AS prompt
FROM benchmark JOIN best ON best.question_id = item_id LEFT JOIN ctx ON ctx.question_id = item_id LEFT JOIN refs ON refs.question_id = item_id""")
def cached_answers(spark, sf):
    users = table(spark, sf, "conversations").where(F.col("role") == "user")
    cache = users.select(F.col("conv_id").alias("cache_id"), F.col("text").alias("question")).unionByName(
        table(spark, sf, "benchmark").select((F.col("item_id") + 1_000_000).alias("cache_id"), F.col("text").alias("question")))
    return _flat(answer_questions(question_table(spark, sf), _named_chunks(spark, sf), cache))


def _rewritten(questions):
    """Stand-in for a rewriting model: two rewrites, one below the threshold, and every seventh reply broken."""
    def rewrite(text, score):
        return F.struct(text.alias("question"), F.lit("g").alias("group"), F.lit("t").alias("topic"), F.lit(score).alias("similarity_score"))

    q, first = F.col("question"), F.split_part("question", F.lit("."), F.lit(1))
    good = F.to_json(F.array(rewrite(first, "7"), rewrite(F.concat(F.lit("How to "), q), "5"), rewrite(F.reverse(q), "4")))
    return questions.select("question_id", F.when(F.col("question_id") % 7 == 0, F.lit("no JSON")).otherwise(good).alias("reply"))


@query("lifecycle_fused_answers", f"""
WITH {sql_chunks(256, 0)},
ck AS (SELECT {sql_chunk_id('doc_id', 'chunk_no')} AS chunk_id, doc_id, chunk_no, chunk FROM chunks),
rw AS (SELECT item_id AS question_id, unnest([split_part(text, '.', 1), 'How to ' || text]) AS question FROM benchmark WHERE item_id % 7 <> 0
       UNION ALL SELECT item_id, text FROM benchmark WHERE item_id % 7 = 0),
asked AS (SELECT DISTINCT question_id, question, {sql_chunk_id('question')} AS text_id FROM rw),
texts AS (SELECT DISTINCT text_id, question FROM asked),
{sql_embed('q', 'texts', 'text_id', 'question')}, {sql_embed('c', 'ck', 'chunk_id', 'chunk')},
scored AS ({sql_scores('q', 'c')}),
hits AS (SELECT question_id AS text_id, doc_id AS chunk_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank FROM scored) WHERE rank <= 5),
fused AS (SELECT question_id, chunk_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM asked JOIN hits USING (text_id) GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id) AS rank FROM fused),
m(model_id, model_name, max_length, token_limit) AS (VALUES {constants.sql_values(constants.MODELS)}),
lim AS (SELECT b.item_id AS question_id, m.token_limit // 10 AS token_limit FROM benchmark b JOIN m ON m.model_id = CASE WHEN b.item_id % 2 = 0 THEN 'gpt-4' ELSE 'gpt-3.5-turbo' END),
src AS (SELECT r.question_id, ck.doc_id, r.rank, ck.chunk, sum(len({SQL_TOKENS.format('chunk')})) OVER (PARTITION BY r.question_id ORDER BY r.rank) AS used
        FROM ranked r JOIN ck USING (chunk_id) WHERE r.rank <= 3),
kept AS (SELECT src.* FROM src JOIN lim USING (question_id) WHERE used <= token_limit),
named AS (SELECT question_id, 'doc ' || doc_id AS name, min(rank) AS r FROM kept GROUP BY 1, 2),
refs AS (SELECT question_id, string_agg(name, ', ' ORDER BY r) AS "references" FROM named GROUP BY 1),
ctx AS (SELECT question_id, md5(string_agg(chunk, E'\\n\\n' ORDER BY rank)) AS context_md5 FROM kept GROUP BY 1)
SELECT item_id AS question_id, context_md5, "references" FROM benchmark LEFT JOIN ctx ON ctx.question_id = item_id LEFT JOIN refs ON refs.question_id = item_id""")
def fused_answers(spark, sf):
    """Every rewrite above the threshold is searched, lists are fused, and the context keeps to the limit of each question's model."""
    models = constants.model_table(spark).select("model_id", F.floor(F.col("token_limit") / 10).alias("token_limit"))
    asked = question_table(spark, sf).withColumn("model_id", F.when(F.col("question_id") % 2 == 0, "gpt-4").otherwise("gpt-3.5-turbo")).join(models, "model_id")
    settings = AnswerSettings(rewriter=_rewritten, confidence_threshold=5, use_adjacent=False, rerank=False, rerank_top_k=5, top_k=5)
    found = answer_questions(asked.drop("model_id"), materialise(_named_chunks(spark, sf), "chunks"), settings=settings)
    return found.select("question_id", F.md5("context").alias("context_md5"), "references")


@query("lifecycle_cache_write_back", f"""
SELECT item_id AS question_id, 'hit' AS status, CAST({sql_chunk_id('text')} AS VARCHAR) AS cache_id FROM benchmark""")
def cache_write_back(spark, sf):
    """Answers to questions the empty cache missed are written back; asked again, every question is a hit."""
    cache, asked = AnswerCache(spark, work_folder(spark, "answer-cache")), question_table(spark, sf)
    first = retrieval.question_cache(asked, cache.entries()).where("status = 'miss'")
    answered = asked.join(first.select("question_id"), "question_id").withColumn("answer", F.concat(F.lit("answer to "), "question"))
    for _ in range(2):  # an answer written again replaces itself
        cache.remember(answered)
    return retrieval.question_cache(asked, cache.entries()).select("question_id", "status", F.col("cache_id").cast("string").alias("cache_id"))


@query("lifecycle_ingest_and_search", f"""
WITH {sql_chunks(256, 0)}, names AS (SELECT DISTINCT source, unnest([source, 'again' || source]) AS dataset FROM documents),
stored AS (SELECT n.dataset, sha256(n.dataset || doc_id) AS doc, chunk_no, chunk FROM chunks JOIN documents USING (doc_id) JOIN names n USING (source)),
ck AS (SELECT {sql_chunk_id('dataset', 'doc', 'chunk_no')} AS chunk_id, * FROM stored), {sql_hits('ck')}
SELECT question_id, dataset, doc, chunk_no, score, CAST(rank AS INTEGER) AS rank FROM hits JOIN ck ON chunk_id = doc_id WHERE rank <= 3""")
def ingest_and_search(spark, sf):
    """Two data sets hold the same documents under the same ids; every hit is one chunk of one of them."""
    store = datasets.DatasetStore(spark, work_folder(spark, "searchable"))
    docs = spread(table(spark, sf, "documents").select("doc_id", "source", "text"), "doc_id")
    docs = docs.withColumn("dataset", F.explode(F.array("source", F.concat(F.lit("again"), "source"))))
    ingest_documents(store, docs.select(
        "dataset", keys.document_key(F.col("dataset"), F.col("doc_id").cast("string")).alias("dockey"),
        "doc_id", "text"), unique_keys=True, embedder=embedding.embed)
    chunks = store.search_table()
    hits = materialise(retrieval.retrieve_chunks(question_table(spark, sf), chunks, 3, 0), "hits")
    few = broadcast_when(hits, at_most(hits, BROADCAST_ROWS))
    return chunks.select("chunk_id", "dataset", "doc", "chunk_no").join(few, "chunk_id").select("question_id", "dataset", "doc", "chunk_no", "score", "rank")


@query("lifecycle_evaluation", f"""
WITH {SQL_RETRIEVED},
truth AS (SELECT b.item_id AS question_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
f AS (SELECT t.question_id, min(r.new_rank) AS first_rank FROM truth t LEFT JOIN (SELECT * FROM reranked WHERE new_rank <= 3) r USING (question_id, doc_id) GROUP BY 1),
m AS (SELECT 1 AS run_id, CAST(count(*) AS DOUBLE) AS n_questions, round(avg(CASE WHEN first_rank IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS hit_rate,
             round(avg(coalesce(1.0 / first_rank, 0.0)), 6) AS mrr FROM f)
SELECT run_id, metric, value FROM m UNPIVOT (value FOR metric IN (n_questions, hit_rate, mrr))""")
def run_evaluation(spark, sf):
    kept = retrieval.keep_sources(reranked(spark, sf), 3)
    metrics = evaluation.retrieval_metrics(evaluation.first_relevant(kept, truth_table(spark, sf), "new_rank"))
    return datasets.append_metrics(metrics.select(F.lit(1).alias("run_id"), "*"), ["run_id"])


@query("lifecycle_full_evaluation", f"""
WITH r AS (WITH {SQL_RETRIEVED},
  truth AS (SELECT b.item_id AS question_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)
            UNION SELECT item_id, item_id * 3 FROM benchmark),
  f AS (SELECT t.question_id, min(r.new_rank) AS first_rank FROM truth t LEFT JOIN (SELECT * FROM reranked WHERE new_rank <= 3) r USING (question_id, doc_id) GROUP BY 1)
  SELECT CAST(count(*) AS DOUBLE) AS n_questions, round(avg(CASE WHEN first_rank IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS hit_rate,
         round(avg(coalesce(1.0 / first_rank, 0.0)), 6) AS mrr FROM f),
e AS ({_SQL_PAIRS} SELECT round(avg(score), 6) AS similarity, CAST(count(*) AS DOUBLE) AS n_answers,
      round(avg(CASE WHEN turn % 11 >= 1 THEN turn % 11 END), 6) AS correctness, CAST(count(*) FILTER (turn % 11 = 0) AS DOUBLE) AS n_unscored FROM c)
SELECT 1 AS run_id, metric, value FROM (SELECT * FROM r, e) UNPIVOT (value FOR metric IN (n_questions, hit_rate, mrr, similarity, n_answers, correctness, n_unscored))""")
def full_evaluation(spark, sf):
    """Both evaluators and both retrieval metrics in one run, over the verbatim and a logged ground truth."""
    kept = retrieval.keep_sources(reranked(spark, sf), 3)
    logged = table(spark, sf, "benchmark").select(F.col("item_id").alias("question_id"), (F.col("item_id") * 3).alias("doc_id"))
    answers = answer_pairs(spark, sf).withColumn("judge_output", F.concat(F.lit("Score: "), ((F.col("turn") + 1) % 11).cast("string")))
    return evaluation_run(1, kept, [truth_table(spark, sf), logged], answers)


@query("lifecycle_training_chunks", f"""
WITH {sql_chunks(256, 0)}, ck AS (SELECT {sql_chunk_id('doc_id', 'chunk_no')} AS chunk_id, doc_id, chunk FROM chunks),
f AS (SELECT chunk, row_number() OVER (ORDER BY chunk_id) - 1 AS n FROM ck WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT printf('0-%06d', n // 100) AS shard, md5(chunk) AS chunk_md5 FROM f""")
def training_chunks(spark, sf):
    """All chunks of the labelled documents."""
    id_file, folder = work_folder(spark, "chunk-ids"), work_folder(spark, "text-chunks")
    chunks = chunk_table(spark, sf)
    chunks.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi").select("chunk_id").write.option(
        "header", "true").csv(id_file)
    export_chunks(chunks, id_file, folder, shard_size=100)
    return read_shards(spark, folder).select("shard", F.md5("chunk").alias("chunk_md5"))


@query("lifecycle_chat_import", """
WITH b AS (SELECT conv_id, turn, CAST(conv_id * 100 + turn AS VARCHAR) AS id FROM conversations WHERE turn % 6 IN (0, 1, 3, 4))
SELECT coalesce(s.id, b.id) AS id, CASE WHEN s.id IS NOT NULL THEN 'stored' WHEN turn % 6 < 2 THEN 'c' || b.id ELSE 'c' END AS name
FROM b FULL JOIN (SELECT CAST(page_id * 100 AS VARCHAR) AS id FROM pages) s ON s.id = b.id""")
def chat_import(spark, sf):
    stored = table(spark, sf, "pages").select(F.struct(
        (F.col("page_id") * 100).cast("string").alias("id"), F.lit("stored").alias("name"), F.lit(None).alias("messages"),
        F.lit(None).alias("model"), F.lit(None).alias("prompt"), F.lit(None).alias("temperature"),
        F.lit(None).alias("folderId")).cast(chat.CONVERSATION).alias("c"), F.col("page_id")).select(
        "c.*", F.struct(F.col("page_id").alias("bundle"), F.lit(0).alias("item")).alias("position"))
    bundles = _bundles(spark, sf).withColumn("order_no", F.col("conv_id") * 100 + F.col("turn"))
    return import_history(stored, bundles, "raw", "order_no").select("id", "name")


@query("lifecycle_bundle_import", """
WITH v AS (SELECT DISTINCT turn % 6 AS v FROM conversations),
f AS (SELECT '7' AS id, 'mine' AS name UNION ALL SELECT r_regionkey || 's', r_name FROM region
      UNION ALL SELECT '8', 'eight' FROM v WHERE v = 1 UNION ALL SELECT 'a', 'A' FROM v WHERE v = 3),
p AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name FROM part UNION ALL SELECT 'p1', 'P' FROM v WHERE v = 4)
SELECT 'folder' AS kind, id, name FROM f UNION ALL SELECT 'prompt', id, name FROM p""")
def bundle_import(spark, sf):
    """Folders and prompts of all bundles merged with stored ones, as the history is."""
    stored_folders = table(spark, sf, "region").select(F.concat(F.col("r_regionkey").cast("string"), F.lit("s")).alias("id"), F.col("r_name").alias("name")).union(
        spark.createDataFrame([("7", "mine")], "id string, name string")).withColumns({
            "type": F.lit("chat"), "position": F.struct(F.lit(0).cast("long").alias("bundle"), F.lit(0).alias("item"))})
    none = F.lit(None).cast("string")
    stored_prompts = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("description"), none.alias("content"),
        F.lit(None).cast(chat.MODEL).alias("model"), none.alias("folderId"),
        F.struct(F.col("p_partkey").alias("bundle"), F.lit(0).alias("item")).alias("position"))
    bundles = _bundles(spark, sf).withColumn("order_no", F.col("conv_id") * 100 + F.col("turn"))
    merged = import_bundles({"folders": stored_folders, "prompts": stored_prompts}, bundles, "raw", "order_no")
    return merged["folders"].select(F.lit("folder").alias("kind"), "id", "name").unionByName(
        merged["prompts"].select(F.lit("prompt").alias("kind"), "id", "name"))


@query("udx1_table_function", r"""
SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no, unnest(string_split(text, chr(10))) AS line
FROM documents""")
def table_function(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    spark.udtf.register("split_lines", line_splitter(docs.schema))
    return spark.sql("SELECT doc_id, line_no, line FROM split_lines(TABLE({docs}) PARTITION BY doc_id)", docs=docs)


@query("udx2_metadata_extractor", "SELECT page_id, length(html) AS n_html, 'page' AS kind FROM pages")
def metadata_extractor(spark, sf):
    def extract(df):
        return df.withColumns({"n_html": F.length("html").cast("long"), "kind": F.lit("page")})

    return table(spark, sf, "pages").transform(extract).select("page_id", "n_html", "kind")


@query("udx3_output_parser", f"SELECT doc_id, CASE WHEN score > 5 THEN 'yes' WHEN score IS NOT NULL THEN 'no' END AS passed FROM ({SQL_JUDGED})")
def output_parser(spark, sf):
    def passed(output):
        score = judge_score(output)
        return F.when(score > 5, "yes").when(score.isNotNull(), "no")

    return judge_replies(spark, sf).select("doc_id", passed(F.col("judge_output")).alias("passed"))


@query("udx4_post_processors", r"""
SELECT item_id AS question_id, array_to_string(list_transform(string_split(text, ' '),
       lambda w: CASE w WHEN 'the' THEN 'THE' ELSE w END), ' ') AS question FROM benchmark""")
def post_processors(spark, sf):
    return post_process(question_table(spark, sf), [acronym_expander({"the": "THE"}), personal_data_remover])


@query("udx5_evaluator_list", f"""
SELECT source, round(avg(score), 6) AS correctness, count(*) FILTER (score IS NULL) AS n_unscored, count(*) AS n_replies
FROM ({SQL_JUDGED}) GROUP BY 1""")
def evaluator_list(spark, sf):
    evaluation.register_evaluator("volume", lambda answers, group: answers.groupBy(*group).agg(F.count(F.lit(1)).alias("n_replies")))
    try:
        return evaluation.evaluate(judge_replies(spark, sf), ["correctness", "volume"], ["source"])
    finally:
        evaluation.EVALUATORS.pop("volume")


def length_client():
    """A stand-in for a model endpoint: vector of token count and character count."""
    import numpy as np

    return lambda texts: np.array([[len(t.split()), len(t)] for t in texts], dtype=float)


@query("udx6_model_hook", f"""
SELECT item_id, CAST(len({SQL_TOKENS.format('text')}) AS DOUBLE) AS n_tokens, CAST(length(text) AS DOUBLE) AS n_chars FROM benchmark""")
def model_hook(spark, sf):
    rows = table(spark, sf, "benchmark").select("item_id", embedding.embed(F.col("text"), length_client, batch_size=10).alias("v"))
    return rows.select("item_id", F.get("v", 0).alias("n_tokens"), F.get("v", 1).alias("n_chars"))


