"""Named queries: row-wise projections and filters. None of them shuffles, except where noted."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants, html, keys, text, vectors
from ..functions.generate import non_null
from ..operators import joins
from ..operators.search import PostingIndex
from ..session import spread, table, work_folder
from ..sources import files
from .registry import query

_SP = text.BROWSER_SPACE


def _sql_trim(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_SP}+', ''), '{_SP}+$', '')"


def _sql_clean(x: str) -> str:
    return (rf"regexp_replace(replace(regexp_replace(replace(regexp_replace({_sql_trim(x)}, '\n{{4,}}', E'\n\n\n', 'g'), "
            rf"E'\n\n', ' '), ' {{3,}}', '  ', 'g'), E'\t', ''), '\n+({_SP}*\n)*', E'\n', 'g')")


# Entities that the given pages hold; the ampersand comes last.
_PAGE_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def _sql_entities(x: str) -> str:
    for entity, character in _PAGE_ENTITIES:
        x = f"replace({x}, '{entity}', '{character}')"
    return x


_SQL_TITLE = _sql_trim(_sql_entities(r"regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1)"))
# The given pages mark their article; the code finds it without looking for the mark.
_SQL_PAGES = rf"""
WITH marked AS (SELECT page_id, url, html, regexp_extract(html, '(?is)<article[^>]*>(.*)</article>', 1) AS a FROM pages),
flat AS (SELECT page_id, url, html, regexp_replace(regexp_replace(regexp_replace(a, '(?s)<!--.*?-->', '', 'g'),
                '(?i)<br ?/?>|</p>|</h1>|</h2>|</li>|</ul>|</tr>|</table>|</div>|</section>', E'\n', 'g'), '<[^>]+>', '', 'g') AS t FROM marked),
readable AS (SELECT page_id, url, {_SQL_TITLE} AS title, {_sql_trim(_sql_entities('t'))} AS readable FROM flat)
"""


@query("prj1_file_metadata", r"""
SELECT page_id, regexp_extract(url, '([^/]+)$', 1) AS file_name,
       CASE WHEN regexp_extract(url, '[^/](\.[^./]+)$', 1) IN ('.txt', '.json', '.htm', '.html') THEN '1' END AS page_label
FROM pages""")
def file_metadata(spark, sf):
    return files.with_file_metadata(table(spark, sf, "pages"), "url").select("page_id", "file_name", "page_label")


@query("prj2_document_key", "SELECT doc_id, sha256(source || '/' || doc_id) AS dockey FROM documents")
def document_key(spark, sf):
    return table(spark, sf, "documents").select("doc_id", keys.document_key(
        F.col("source"), F.concat(F.lit("/"), F.col("doc_id").cast("string"))).alias("dockey"))


def language_extractor(df):
    """A sample metadata extractor: any DataFrame -> DataFrame function will do."""
    return df.withColumns({"lang_source": F.concat_ws("/", "lang", "source"),
                           "length_class": F.when(F.col("n_chars") < 1000, "short").otherwise("long")})


@query("prj3_custom_metadata", """
SELECT doc_id, lang || '/' || source AS lang_source, CASE WHEN n_chars < 1000 THEN 'short' ELSE 'long' END AS length_class
FROM documents""")
def custom_metadata(spark, sf):
    return table(spark, sf, "documents").transform(language_extractor).select("doc_id", "lang_source", "length_class")


@query("prj4_clean_source_text", f"SELECT doc_id, md5({_sql_clean('text')}) AS clean_md5 FROM documents")
def clean_source_text(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id").select("doc_id", F.md5(text.clean_source_text(F.col("text"))).alias("clean_md5"))


@query("prj5_clip_source_text", f"""
SELECT doc_id, substring({_sql_clean('text')}, 1, 2000) AS clipped FROM documents""")
def clip_source_text(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id").select("doc_id", text.clip(text.clean_source_text(F.col("text"))).alias("clipped"))


def readable_pages(pages):
    """Pages with a title and readable text; pages without readable text are dropped."""
    return non_null(pages, ["page_id", "url", html.html_title(F.col("html")).alias("title")],
                    html.readable_text(F.col("html")), "readable")


@query("prj6_readable_html", f"""{_SQL_PAGES}
SELECT page_id, title, readable FROM readable WHERE readable <> ''""")
def readable_html(spark, sf):
    return readable_pages(spread(table(spark, sf, "pages"), "page_id")).select("page_id", "title", "readable")


@query("prj7_source_block", f"""{_SQL_PAGES}
SELECT page_id, title || ' (' || url || E'):\\n' || substring({_sql_clean('readable')}, 1, 2000) AS block
FROM readable WHERE readable <> ''""")
def source_block(spark, sf):
    return readable_pages(spread(table(spark, sf, "pages"), "page_id")).select("page_id", text.source_block(
        F.col("title"), F.col("url"), text.clip(text.clean_source_text(F.col("readable")))).alias("block"))


_TEMPLATE = "Tell {{name}} about {{brand}}: {{name}} or {{type}}, size {{size}}"


def _templates(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.concat(
        F.lit(_TEMPLATE), F.when(F.col("p_size") % 2 == 0, " {{name}}").otherwise(" {{brand}}!")).alias("template"),
        F.create_map(F.lit("name"), "p_name", F.lit("brand"), "p_brand", F.lit("type"), "p_type").alias("vars"))


_SQL_TEMPLATE = f"'{_TEMPLATE}' || CASE WHEN p_size % 2 = 0 THEN ' {{{{name}}}}' ELSE ' {{{{brand}}}}!' END"


@query("prj8_placeholders", f"""
WITH t AS (SELECT p_partkey, regexp_extract_all({_SQL_TEMPLATE}, '\\{{\\{{(.*?)\\}}\\}}', 1) AS all_names FROM part),
u AS (SELECT p_partkey, unnest(all_names) AS name, generate_subscripts(all_names, 1) AS pos FROM t),
f AS (SELECT p_partkey, name, min(pos) AS pos FROM u GROUP BY 1, 2)
SELECT p_partkey, string_agg(name, ',' ORDER BY pos) AS names FROM f GROUP BY 1""")
def placeholders(spark, sf):
    return _templates(spark, sf).select("p_partkey", F.array_join(text.placeholders(F.col("template")), ",").alias("names"))


@query("prj9_substitute", f"""
SELECT p_partkey, replace(replace(replace({_SQL_TEMPLATE}, '{{{{name}}}}', p_name), '{{{{brand}}}}', p_brand),
                          '{{{{type}}}}', p_type) AS prompt FROM part""")
def substitute(spark, sf):
    return _templates(spark, sf).select("p_partkey", text.substitute(F.col("template"), F.col("vars")).alias("prompt"))


_PROMPT = ("Analyse the scenario and answer with a JSON list shaped like {json_format}.\n"
           "Scenario: {scenario}\nKeep {other} marks.")
_FORMAT = '[{"question": "...", "group": "...", "topic": "...", "similarity_score": "..."}]'


@query("prj10_prompt_fill", f"""
SELECT item_id AS question_id,
       replace(replace('{_PROMPT}', '{{json_format}}', '{_FORMAT}'), '{{scenario}}', text) AS prompt
FROM benchmark""")
def prompt_fill(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("question_id"), text.fill_prompt(
        _PROMPT, json_format=F.lit(_FORMAT), scenario=F.col("text")).alias("prompt"))


def _rewrites(spark, sf):
    item, score = F.col("item_id"), (F.col("item_id") % 12).cast("string")
    good = F.to_json(F.array(
        F.struct(F.col("text").alias("question"), F.lit("g1").alias("group"), F.lit("t1").alias("topic"),
                 F.when(item % 5 == 0, "high").otherwise(score).alias("similarity_score")),
        F.struct(F.concat(F.lit("How to "), F.col("text")).alias("question"), F.lit("g2").alias("group"),
                 F.lit("t2").alias("topic"), F.lit("0").alias("similarity_score")),
        F.struct(F.lit("n/a").alias("question"), F.lit("g3").alias("group"), F.lit("t3").alias("topic"),
                 F.lit("9").alias("similarity_score"))))
    return table(spark, sf, "benchmark").select(
        item.alias("question_id"), F.when(item % 7 == 0, F.lit("[{not json")).when(item % 7 == 1, F.lit("[]"))
        .otherwise(good).alias("reply"))


@query("prj11_rewritten_questions", """
SELECT item_id AS question_id, text AS question, 'g1' AS "group", 't1' AS topic, CAST(item_id % 12 AS INTEGER) AS similarity_score
FROM benchmark WHERE item_id % 7 > 1 AND item_id % 5 <> 0 AND item_id % 12 >= 1""")
def rewritten_questions(spark, sf):
    return joins.rewritten_questions(_rewrites(spark, sf), "reply", confidence_threshold=1)


@query("prj11_rewrite_report", """
SELECT count(*) AS n_replies, CAST(count(*) FILTER (item_id % 7 = 0) AS BIGINT) AS n_malformed,
       CAST(count(*) FILTER (item_id % 7 = 1) AS BIGINT) AS n_empty FROM benchmark""")
def rewrite_report(spark, sf):
    return joins.rewrite_report(_rewrites(spark, sf), "reply")


# A fixed dictionary for the two acronym queries.
_ACRONYMS = {"it": "information technology", "of": "outlier factor", "the": "total health estimate", "en": "east north"}
_SQL_EXPAND = f"""
WITH dict(acr, full_form) AS (VALUES {constants.sql_values(list(_ACRONYMS.items()))}),
w AS (SELECT item_id, unnest(string_split(text, ' ')) AS tok, generate_subscripts(string_split(text, ' '), 1) AS pos FROM benchmark)
SELECT item_id AS question_id, string_agg(coalesce(full_form, tok), ' ' ORDER BY pos) AS question
FROM w LEFT JOIN dict ON acr = tok GROUP BY 1"""


@query("prj12_acronym_literals", _SQL_EXPAND)
def acronym_literals(spark, sf):
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("question_id"), text.expand_acronyms(F.col("text"), _ACRONYMS).alias("question"))


@query("prj12_acronym_table", _SQL_EXPAND)
def acronym_table(spark, sf):
    dictionary = constants.values_frame(spark, ["acronym", "full_form"], list(_ACRONYMS.items()))
    questions = table(spark, sf, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))
    return joins.expand_from_table(questions, "question_id", "question", dictionary)


_SQL_JUDGE = """CASE doc_id % 6 WHEN 0 THEN 'Score: ' || (doc_id % 13) || ' of 10' WHEN 1 THEN 'no score' WHEN 2 THEN ''
 WHEN 3 THEN CAST(doc_id % 10 + 1 AS VARCHAR) WHEN 4 THEN '99999999999999999999' ELSE 'about ' || (doc_id % 11) END"""


def judge_replies(spark, sf):
    doc, word = F.col("doc_id"), lambda c: c.cast("string")
    return table(spark, sf, "documents").select("doc_id", "source", (
        F.when(doc % 6 == 0, F.concat(F.lit("Score: "), word(doc % 13), F.lit(" of 10"))).when(doc % 6 == 1, "no score")
        .when(doc % 6 == 2, "").when(doc % 6 == 3, word(doc % 10 + 1)).when(doc % 6 == 4, "99999999999999999999")
        .otherwise(F.concat(F.lit("about "), word(doc % 11)))).alias("judge_output"))


SQL_JUDGED = rf"""
SELECT doc_id, source, CASE WHEN s BETWEEN 1 AND 10 THEN s END AS score
FROM (SELECT doc_id, source, TRY_CAST(regexp_extract({_SQL_JUDGE}, '([0-9]+)', 1) AS INTEGER) AS s FROM documents)"""


@query("prj13_judge_score", f"SELECT doc_id, CAST(score AS VARCHAR) AS score FROM ({SQL_JUDGED})")
def judge_score(spark, sf):
    return judge_replies(spark, sf).select("doc_id", text.judge_score(F.col("judge_output")).cast("string").alias("score"))


@query("prj14_redact", f"""
SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '{text.EMAIL}', '<EMAIL>', 'g'),
  '{text.IP_ADDRESS}', '<IP>', 'g'), '{text.LONG_NUMBER}', '<ID>', 'g'), '{text.PHONE}', '<PHONE>', 'g')) AS redacted_md5
FROM documents""")
def redact(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id").select("doc_id", F.md5(text.redact(F.col("text"))).alias("redacted_md5"))


@query("prj16_length_limit", f"""
WITH m(model_id, model_name, max_length, token_limit) AS (VALUES {constants.sql_values(constants.MODELS)})
SELECT doc_id, model_id, n AS n_chars, max_length
FROM (SELECT doc_id, length(text) AS n, CASE doc_id % 4 WHEN 0 THEN 'gpt-4' WHEN 1 THEN 'gpt-4-32k' ELSE 'gpt-3.5-turbo' END AS model_id
      FROM documents) JOIN m USING (model_id) WHERE n > max_length""")
def length_limit(spark, sf):
    doc = F.col("doc_id")
    texts = table(spark, sf, "documents").select("doc_id", F.length("text").cast("long").alias("n_chars"), F.when(
        doc % 4 == 0, "gpt-4").when(doc % 4 == 1, "gpt-4-32k").otherwise("gpt-3.5-turbo").alias("model_id"))
    return joins.over_length(texts, constants.model_table(spark), "n_chars").select(
        "doc_id", "model_id", "n_chars", "max_length")


@query("prj20_prompt_search", """
SELECT p_partkey, p_name FROM part
WHERE contains(lower(p_name) || ' ' || lower(p_brand) || ' ' || lower(p_type), 'brand#1')""")
def prompt_search(spark, sf):
    searchable = F.concat_ws(" ", "p_name", "p_brand", "p_type")
    return table(spark, sf, "part").where(text.contains_folded(searchable, "Brand#1")).select("p_partkey", "p_name")


@query("prj20_indexed_search", """
SELECT p_partkey, p_name FROM part
WHERE contains(lower(p_name) || ' ' || lower(p_brand) || ' ' || lower(p_type), 'brand#1')""")
def indexed_prompt_search(spark, sf):
    """The same through stored posting lists; a repeated append changes nothing."""
    parts = table(spark, sf, "part")
    index = PostingIndex(spark, work_folder(spark, "search"), 16)
    for _ in range(2):
        index.append(parts.select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("text")), "p_partkey", "text", "all")
    return parts.join(index.search("Brand#1").withColumnRenamed("key", "p_partkey"), "p_partkey").select("p_partkey", "p_name")


@query("prj20_prompt_name_search", "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring')")
def prompt_name_search(spark, sf):
    return table(spark, sf, "part").where(text.contains_folded(F.col("p_name"), "RING")).select("p_partkey", "p_name")


@query("prj21_mixed_dates", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 24 YEAR AS DATE) AS VARCHAR) END AS day FROM orders""")
def mixed_dates(spark, sf):
    day = F.add_months(F.col("o_orderdate").cast("date"), 288)
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "yyyy-MM-dd")).when(
        F.col("o_orderkey") % 3 == 1, F.date_format(day, "MMMM dd yy")).otherwise("last week")
    return table(spark, sf, "orders").select("o_orderkey", text.mixed_date(raw).cast("string").alias("day"))


@query("prj22_scale_features", """
SELECT vec_id, CAST(label AS BIGINT) AS label, pos - 1 AS pos, round(x / 255, 6) + 0.0 AS scaled, round((x - 0.1307) / 0.3081, 6) + 0.0 AS standard
FROM (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
             CAST(generate_subscripts(embedding, 1) AS INTEGER) AS pos FROM embeddings)""")
def scale_features(spark, sf):
    e = F.col("embedding")
    both = table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").cast("bigint").alias("label"),
        F.posexplode(F.arrays_zip(vectors.scale_by(e).alias("a"), vectors.standardise(e).alias("b"))).alias("pos", "z"))
    return both.select("vec_id", "label", "pos", F.round(F.col("z")["a"], 6).alias("scaled"),
                       F.round(F.col("z")["b"], 6).alias("standard"))


@query("prj23_arg_max", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS arg_max FROM embeddings""")
def arg_max(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", vectors.arg_max(F.col("embedding")).alias("arg_max"))


@query("prj24_class_name", f"""
WITH c(i, class_name) AS (VALUES {constants.sql_values(list(enumerate(constants.CLASS_NAMES)))})
SELECT vec_id, coalesce(class_name, 'Not found') AS class_name
FROM (SELECT vec_id, label + vec_id % 2 AS l FROM embeddings) LEFT JOIN c ON c.i = l""")
def class_name(spark, sf):
    label = (F.col("label") + F.col("vec_id") % 2).cast("int")
    return table(spark, sf, "embeddings").select("vec_id", joins.class_name(label).alias("class_name"))


@query("prj25_url_pieces", r"""
SELECT page_id, replace(url_encode(url), '%7E', '~') AS encoded, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme
FROM pages""")
def url_pieces(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select("page_id", text.url_component(url).alias("encoded"), text.url_scheme(url).alias("scheme"))


@query("prj26_faq_pairs", f"""
SELECT item_id AS question_id, {_sql_trim("split_part(text, '.', 1)")} AS question,
       {_sql_trim("substring(text, length(split_part(text, '.', 1)) + 1)")} AS answer
FROM benchmark""")
def faq_pairs(spark, sf):
    first = F.split_part(F.col("text"), F.lit("."), F.lit(1))
    raw = table(spark, sf, "benchmark").select(
        "item_id", first.alias("question"),
        F.concat(first, F.lit("\n          \n        \n"), F.expr("substring(text, length(split_part(text, '.', 1)) + 1)")).alias("text"))
    question, answer = text.split_faq(F.col("question"), F.col("text"))
    return raw.where(F.col("question").isNotNull()).select(
        F.col("item_id").alias("question_id"), question.alias("question"), answer.alias("answer"))


@query("prj27_reject_blank", f"""
SELECT conv_id, turn FROM (SELECT *, CASE WHEN turn % 3 = 2 THEN E' \\n\\t ' ELSE text END AS t FROM conversations)
WHERE length({_sql_trim('t')}) > 0""")
def reject_blank(spark, sf):
    rows = table(spark, sf, "conversations").withColumn("text", F.when(F.col("turn") % 3 == 2, " \n\t ").otherwise(F.col("text")))
    return rows.where(~text.is_blank(F.col("text"))).select("conv_id", "turn")


@query("agg3_ingest_report", f"""{_SQL_PAGES}
SELECT split_part(url, '/', 4) AS lang_level, count(*) AS total, count(*) FILTER (readable <> '' AND page_id % 9 <> 0) AS ingested,
       count(*) FILTER (readable = '' OR page_id % 9 = 0) AS skipped FROM readable GROUP BY 1""")
def ingest_report(spark, sf):
    from .ingest import ingest_report as report

    pages = spread(table(spark, sf, "pages"), "page_id").select(
        F.split_part("url", F.lit("/"), F.lit(4)).alias("lang_level"),
        html.readable_text(F.when(F.col("page_id") % 9 != 0, F.col("html"))).alias("readable"))
    return report(pages, "readable", ["lang_level"])
