"""Readable text and title of raw HTML, as column expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .article import article_of
from .text import trim_space

# Parts of a page that a browser does not show.
HIDDEN = (r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>"
          r"|<noscript\b.*?</noscript\s*>|<template\b.*?</template\s*>")
LINE_END = r"(?i)<br\s*/?>|</(p|div|li|tr|h[1-6]|section|article|table|ul|ol)\s*>"
ANY_TAG = r"<[^>]*>"

ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
# By rule: the names of the HTML standard, and the numbers 128 to 159 read as Windows-1252. No-break spaces become spaces.
NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")} | {"nbsp": " "}
RENUMBERED = {str(n): bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (129, 141, 143, 144, 157)} | {"160": " "}


def _literal_map(entries: dict[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def _character(name: Column) -> Column:
    """Text of an entity's inner name, null for an unknown name; a number that is no character gives U+FFFD."""
    digits = F.when(F.lower(F.substring(name, 1, 2)) == "#x", F.conv(F.substring(name, 3, 8), 16, 10)).otherwise(F.substring(name, 2, 8))
    code = digits.try_cast("long")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    number = F.coalesce(F.try_element_at(_literal_map(RENUMBERED), code.cast("string")), plain)
    return F.when(F.startswith(name, F.lit("#")), number).otherwise(F.try_element_at(_literal_map(NAMED), name))


def decode_entities(text: Column) -> Column:
    """Named, decimal and hexadecimal entities in one pass; unknown names stay."""
    between = F.split(text, ENTITY)
    names = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(1))
    pieces = F.zip_with(between, names, lambda t, n: F.concat(
        t, F.coalesce(_character(n), F.concat(F.lit("&"), n, F.lit(";")), F.lit(""))))
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def html_title(html: Column) -> Column:
    return trim_space(decode_entities(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)))


def readable_text(html: Column) -> Column:
    """Article text of a page, one line per block; null when nothing readable is left."""
    body = article_of(F.regexp_replace(html, HIDDEN, ""))
    lines = F.regexp_replace(body, LINE_END, "\n")
    text = trim_space(decode_entities(F.regexp_replace(lines, ANY_TAG, "")))
    return F.when(text != "", text)
