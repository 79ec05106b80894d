"""Column expressions over text: tokens, clean-up, templates, parsing, redaction."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space a browser trims, as characters and as a regex class Java and RE2 both read.
SPACE_CHARACTERS = ("\t\n\x0b\x0c\r \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff")
BROWSER_SPACE = (r"[\s\x{0B}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]")
TOKEN_GAP = r"[ \t\n\x0B\f\r]+"

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IP_ADDRESS = r"[0-9]{1,3}(\.[0-9]{1,3}){3}"
LONG_NUMBER = r"[0-9]{12,19}"
# A plus sign, a bracketed area code, or groups of 3-3-4 digits; bare numbers and dates are none.
PHONE = (r"\+[0-9][0-9() .-]{6,}[0-9]|\([0-9]{2,5}\)[ .-]?[0-9]{2,4}[ .-]?[0-9]{2,4}|\b[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}\b")

PLACEHOLDER = r"\{\{(.*?)\}\}"


def tokens(text: Column) -> Column:
    """Whitespace tokens; blank text has none."""
    return F.array_remove(F.split(text, TOKEN_GAP), "")


def token_count(text: Column) -> Column:
    return F.size(tokens(text))


def trim_space(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARACTERS))


def clean_source_text(text: Column) -> Column:
    """Trim a fetched page text and squeeze its blank runs; the order of the steps matters."""
    text = trim_space(text)
    text = F.regexp_replace(text, r"\n{4,}", "\n\n\n")
    text = F.replace(text, F.lit("\n\n"), F.lit(" "))
    text = F.regexp_replace(text, r" {3,}", "  ")
    text = F.replace(text, F.lit("\t"), F.lit(""))
    # A newline, with any blank lines behind it, becomes one newline.
    return F.regexp_replace(text, f"\\n({BROWSER_SPACE}*\\n)?", "\n")


def clip(text: Column, length: int = 2000) -> Column:
    return F.substring(text, 1, length)


def is_blank(text: Column) -> Column:
    return F.length(trim_space(F.coalesce(text, F.lit("")))) == 0


def title_of(first_message: Column, length: int = 30) -> Column:
    """Conversation title: the first message, cut with an ellipsis when longer."""
    return F.when(F.length(first_message) > length,
                  F.concat(F.substring(first_message, 1, length), F.lit("..."))).otherwise(first_message)


def source_block(title: Column, link: Column, text: Column) -> Column:
    return F.concat(title, F.lit(" ("), link, F.lit("):\n"), text)


def placeholders(template: Column) -> Column:
    """Names inside ``{{...}}``, first occurrence of each, in order."""
    return F.array_distinct(F.regexp_extract_all(template, F.lit(PLACEHOLDER), F.lit(1)))


def substitute(template: Column, values: Column) -> Column:
    """Replace each ``{{name}}`` by ``values[name]`` in one pass; unbound names stay as they are.

    One pass means a value that itself contains ``{{...}}`` is not expanded again.
    """
    between = F.split(template, r"\{\{.*?\}\}")
    names = F.regexp_extract_all(template, F.lit(PLACEHOLDER), F.lit(1))
    pieces = F.zip_with(
        between, names,
        lambda text, name: F.concat(text, F.coalesce(
            F.try_element_at(values, name), F.concat(F.lit("{{"), name, F.lit("}}")), F.lit(""))))
    return F.array_join(pieces, "")


def fill_prompt(template: str, **slots: Column) -> Column:
    """Fill the ``{slot}`` marks of a literal template in one pass; marks without a value stay, also inside values."""
    if not slots:
        return F.lit(template)
    parts = re.split(r"\{(" + "|".join(map(re.escape, slots)) + r")\}", template)
    return F.concat(*[slots[part] if i % 2 else F.lit(part) for i, part in enumerate(parts)])


def contains_folded(haystack: Column, term: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(haystack).contains(term.lower())


def expand_acronyms(text: Column, dictionary: Mapping[str, str]) -> Column:
    """Replace whole space-separated tokens found in a literal dictionary; ``joins.expand_from_table`` takes a table."""
    lookup = F.from_json(F.lit(json.dumps(dict(dictionary))), "map<string,string>")
    return F.array_join(
        F.transform(F.split(text, " "), lambda t: F.coalesce(F.try_element_at(lookup, t), t)), " ")


def judge_score(output: Column) -> Column:
    """First whole number of a judge's reply when it lies in 1..10, else null."""
    number = F.regexp_extract(output, r"([0-9]+)", 1).try_cast("int")
    return F.when(number.between(1, 10), number)


def redact(text: Column) -> Column:
    """Mask mail addresses, IP addresses, long id numbers and phone numbers."""
    text = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL, "<EMAIL>")).otherwise(text)
    text = F.regexp_replace(text, IP_ADDRESS, "<IP>")
    text = F.regexp_replace(text, LONG_NUMBER, "<ID>")
    return F.regexp_replace(text, PHONE, "<PHONE>")


def mixed_date(text: Column) -> Column:
    """Dates written ``2023-04-18`` or ``February 02 24``; anything else is null."""
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "MMMM dd yy"))


def split_faq(question: Column, text: Column) -> tuple[Column, Column]:
    """(question, answer) of a record whose text repeats the question first."""
    rest = F.substring(text, F.length(question) + 1, F.length(text))
    answer = F.when(F.startswith(text, question), trim_space(rest)).otherwise(trim_space(text))
    return trim_space(question), answer


def url_component(text: Column) -> Column:
    """Percent-encode the way browsers encode one URL component."""
    out = F.url_encode(text)
    # Characters a browser leaves alone and the form encoding does not.
    for encoded, literal in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(encoded), F.lit(literal))
    return out


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
