"""Named query of the license scan and its SQL counterpart."""

from __future__ import annotations

from ..session import table
from .license_scan import Region, license_report, parse
from .license_templates import PHRASES, TEMPLATES
from .registry import query


def _pattern(parts: list) -> str:
    """Regular expression of parsed markup over words that each end with a blank."""
    out = ""
    for part in parts:
        if isinstance(part, list):
            out += f"(?:{_pattern(part)})?"
        elif isinstance(part, Region):
            out += f"(?:(?:{part.match or '[^ ]+'}) ){{{part.least},{part.most}}}"
        else:
            out += part.decode() + " "
    return out


def _phrase_places(phrase: str) -> str:
    words = phrase.lower().split()
    tests = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words))
    return f"list_transform(list_filter(range(1, len(w) - {len(words) - 2}), lambda i: {tests}), lambda i: i - 1)"


def _sql() -> str:
    labels = sorted({label for label, _ in TEMPLATES})
    proven = []
    for label in labels:
        tests = " OR ".join(f"regexp_matches(j, ' {_pattern(parse(markup))}')" for own, markup in TEMPLATES if own == label)
        proven.append(f"CASE WHEN {tests} THEN '{label}' END")
    places = ", ".join(f"{_phrase_places(phrase)} AS p_{label}" for label, phrase in PHRASES)
    every = ", ".join(f"p_{label}" for label, _ in PHRASES)
    base = ", ".join(f"CASE WHEN len(p_{label}) > 0 THEN '{label}' END" for label, _ in PHRASES)
    return f"""
        WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        p AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS j, {places} FROM t),
        l AS (SELECT doc_id, w, flatten([{every}]) AS places, list_filter([{base}], lambda x: x IS NOT NULL) AS based,
                     list_filter([{', '.join(proven)}], lambda x: x IS NOT NULL) AS proven FROM p),
        f AS (SELECT *, list_sort(list_distinct(list_concat(based, proven))) AS every FROM l)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, CAST(list_min(places) AS BIGINT) AS first_word,
               CAST(list_max(places) AS BIGINT) AS last_word, coalesce(array_to_string(list_sort(based), ','), '') AS base_labels,
               coalesce(array_to_string(every, ','), '') AS labels,
               CASE WHEN len(every) > 0 THEN CAST(len(proven) AS DOUBLE) / len(every) ELSE 0.0 END AS score
        FROM f"""


@query("op11_license_scan", _sql())
def op11(spark, folder):
    return license_report(table(spark, folder, "documents"), PHRASES, TEMPLATES)
