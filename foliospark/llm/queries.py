"""Named queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import queries_conversations, queries_licenses, queries_models, queries_native, queries_spelling  # noqa: F401  register their queries
from .packing import pack_documents
from .registry import query
from .texts import read_vocabulary
from .token_counts import token_counts
from .url_filter import UrlRule, fit_url_model, judge_urls, labelled_by_rules
from .word_codec import encode_decode_digests


def table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return read_vocabulary(public_tokenizers.path(name))


MAX_TOKENS = 1024


@query("op2_token_counts")
def op2(spark, folder):
    counts = token_counts(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


# The rules the operator's contract states.
URL_RULES = [UrlRule("com/", "allow"), UrlRule("example.com/en/", "block"), UrlRule("www.example.com/en/", "allow"),
             UrlRule("net/es/", "block"), UrlRule("net/fr/", "block")]


@query("op4_url_filter")
def op4(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    model = fit_url_model(labelled_by_rules(pages, URL_RULES))
    return judge_urls(pages, URL_RULES, model).select("page_id", "host", "path", "rule", "verdict")


SEQUENCE_TOKENS = 2048


@query("op6_pattern_packing")
def op6(spark, folder):
    packed = pack_documents(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), SEQUENCE_TOKENS)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op10_word_codec")
def op10(spark, folder):
    return encode_decode_digests(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))
