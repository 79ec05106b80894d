import datetime as dt

import pytest
from pyspark.sql import functions as F

from foliospark.functions import html, keys, text, vectors
from foliospark.functions.article import article_html
from foliospark.operators.joins import expand_from_table
from foliospark.plans.answer import acronym_expander


def test_clean_source_text(one):
    c = text.clean_source_text(F.col("t"))
    assert one(c, t="  a\n\n\n\n\nb\n\nc    d\te\n \n\nf \u00a0\n") == "a \nb c  de\n  f"
    assert one(c, t="\u00a0\t") == ""
    assert one(c, t="a\n  \n   \nb") == "a\nb"


def test_tokens(one):
    assert one(text.tokens(F.col("t")), t=" a\tb\n\nc ") == ["a", "b", "c"]
    assert one(text.tokens(F.col("t")), t=" \n ") == []


def test_placeholders_are_filled_in_one_pass(one):
    t = "{{a}} {{b}} {{a}} {{zz}} {{}}"
    values = F.create_map(F.lit("a"), F.lit("{{b}}"), F.lit("b"), F.lit("2"))
    assert one(text.placeholders(F.col("t")), t=t) == ["a", "b", "zz", ""]
    assert one(text.substitute(F.col("t"), F.col("v")), t=t, v=values) == "{{b}} 2 {{b}} {{zz}} {{}}"
    assert one(text.substitute(F.col("t"), F.col("v")), t="plain", v=values) == "plain"


def test_judge_score(one):
    for reply, score in (("Score: 7/10", 7), ("none", None), ("0", None), ("11", None), ("", None), ("9" * 30, None)):
        assert one(text.judge_score(F.col("t")), t=reply) == score


def test_mixed_dates(one):
    for raw, day in (("February 02 24", dt.date(2024, 2, 2)), ("2023-04-18", dt.date(2023, 4, 18)), ("soon", None), ("", None)):
        assert one(text.mixed_date(F.col("t")), t=raw) == day


def test_redact(one):
    got = one(text.redact(F.col("t")), t="mail a.b@c.example.com from 10.1.2.3 or +1 (743) 555-3824, card 4994226020900891")
    assert got == "mail <EMAIL> from <IP> or <PHONE>, card <ID>"


def test_dates_and_number_lists_are_no_phone_numbers(one):
    kept = "on 2024-01-15 at 100 200 300, sizes 12 - 14 - 16, id 123-4567"
    assert one(text.redact(F.col("t")), t=kept) == kept
    assert one(text.redact(F.col("t")), t="call 555-123-4567 or (030) 1234 567 or +49 30 1234567") == "call <PHONE> or <PHONE> or <PHONE>"


def test_prompts_are_filled_in_one_pass(one):
    assert one(text.fill_prompt("{a}-{b}-{c}-{a}", a=F.col("x"), b=F.col("y")), x="{b}", y="{a}") == "{b}-{a}-{c}-{b}"
    assert one(text.fill_prompt("plain {x}")) == "plain {x}"


def test_acronyms_of_any_number(one, spark):
    forms = {f"K{i}": f"key {i}" for i in range(5000)}
    assert one(text.expand_acronyms(F.col("t"), forms), t="K1 and K4999 K5000") == "key 1 and key 4999 K5000"
    rows = spark.createDataFrame([(1, "VP of VP"), (2, None)], "question_id long, question string")
    twice = spark.createDataFrame([("VP", "vice president"), ("VP", "value point")], "acronym string, full_form string")
    got = {r.question_id: r.question for r in expand_from_table(rows, "question_id", "question", twice).collect()}
    assert got == {1: "value point of value point", 2: None}
    asked = acronym_expander(forms)(spark.createDataFrame([(1, "K7 x"), (2, "y")], "question_id long, question string"))
    assert {r.question_id: r.question for r in asked.collect()} == {1: "key 7 x", 2: "y"}


def test_entities(one):
    raw = "&#147;a&#148; &#8217; &#x2014; &#X41; &eacute;&Aacute; &hellip; &#038; &nbsp;| &#160;| &amp;lt; &bogus; &; & &#0; &#55296; &#99999999; &#128512;"
    plain = "“a” ’ — A éÁ … &  |  | &lt; &bogus; &; & \ufffd \ufffd &#99999999; 😀"
    assert one(html.decode_entities(F.col("t")), t=raw) == plain
    assert one(html.decode_entities(F.col("t")), t="none") == "none"


def test_faq_split(one):
    q, a = text.split_faq(F.col("q"), F.col("t"))
    assert one(q, q="What? ", t="") == "What?"
    assert one(a, q="What?", t="What?\n   \nThis.") == "This."
    assert one(a, q="What?", t="That.") == "That."


def test_url_component_follows_the_browser(one):
    assert one(text.url_component(F.col("t")), t="a b&c/(d)!'*~é") == "a%20b%26c%2F(d)!'*~%C3%A9"
    assert one(text.url_scheme(F.col("t")), t="S3a://bucket") == "s3a"
    assert one(text.url_scheme(F.col("t")), t="/local/path") == ""


def test_title(one):
    assert one(text.title_of(F.col("t")), t="x" * 30) == "x" * 30
    assert one(text.title_of(F.col("t")), t="x" * 31) == "x" * 30 + "..."


def test_readable_html(one):
    page = ("<!DOCTYPE html><HTML><head><title> A &amp; B </title><style>p{}</style></head><body><nav>menu</nav>"
            "<!-- note --><ARTICLE><h1>T</h1><p>one<br>two &amp;lt; &copy;<script>x('</p>')</script></p></ARTICLE><footer>f</footer></body>")
    assert one(html.html_title(F.col("h")), h=page) == "A & B"
    assert one(html.readable_text(F.col("h")), h=page) == "T\none\ntwo &lt; ©"
    assert one(html.readable_text(F.col("h")), h="<nav>only menu</nav>") is None


BLOG = """<body><div class="wrap"><div id="top"><a href="/">Home</a> <a href="/a">About us</a> <a href="/b">All our stories, sorted</a></div>
<div><div><h2>The ferry stops early</h2>
<p>The last boat now leaves at nine, an hour before the old timetable, and the harbour office blames the crew shortage.</p>
<p>Regular passengers, most of them nurses on late shifts, say that nobody asked them; the council, however, says it did.</p>
<ul><li><a href="/1">Five more stories about boats, harbours and islands</a></li><li><a href="/2">Subscribe to our newsletter, it is free</a></li></ul>
<p>A petition, signed by two hundred people, will be read on Monday.</p></div>
<div><a href="/x">Older: the bridge, the tolls and the bill</a> <a href="/y">Newer: a walk, a dog and a storm</a></div></div>
<div>Copyright 2021, the paper &amp; its owners</div></div></body>"""
SPLIT = """<table><tr><td><a href=1>One, two, three, four and five</a><a href=2>Six, seven, eight, nine and ten</a></td>
<td>The first column tells, in plain words, how the seed was sown, when the rain came, and what grew of it in the end.
<td>The second column tells, in plain words, who took the grain, where it was sold, and what became of the money.</tr></table>"""
FORUM = """<div><div><p>It hums, I think, because the valve is worn; mine did, and a new one, for ten euros, cured it.</p></div>
<div><p>ok</p></div><div><p>Agreed, the valve, though mine, oddly, needed a new seal, a longer hose, and some grease too.</p></div></div>"""


@pytest.mark.parametrize("page, text", [
    (BLOG, "The ferry stops early\n\nThe last boat now leaves at nine, an hour before the old timetable, and the harbour office blames the crew "
           "shortage.\n\nRegular passengers, most of them nurses on late shifts, say that nobody asked them; the council, however, says it did."
           "\n\n\nA petition, signed by two hundred people, will be read on Monday."),
    (SPLIT, "The first column tells, in plain words, how the seed was sown, when the rain came, and what grew of it in the end.\n"
            "The second column tells, in plain words, who took the grain, where it was sold, and what became of the money."),
    (FORUM, "It hums, I think, because the valve is worn; mine did, and a new one, for ten euros, cured it.\n\n"
            "Agreed, the valve, though mine, oddly, needed a new seal, a longer hose, and some grease too."),
    ("<div class='sidebar'>" + "Buy this, buy that, buy now, and save a lot of money today. " * 3 + "</div><div>A short, true note about the sea, the wind.</div>",
     "A short, true note about the sea, the wind."),
    ("plain words only", "plain words only"), ("<p>unclosed <b>bold <div>block</span></section>", "unclosed bold block"), ("", None), (None, None)])
def test_article_without_marks(one, page, text):
    found = one(html.readable_text(F.col("h")), h=F.lit(page).cast("string"))
    assert (found and [line for line in found.split("\n") if line]) == (text and [line for line in text.split("\n") if line])


def test_article_of_a_deep_and_a_long_page():
    deep = "<div>" * 20_000 + "Words, many words, and commas to score, at the very bottom of it." + "</div>" * 20_000
    assert "very bottom" in article_html(deep)
    long = "<p>" + "some words, " * 300_000
    assert article_html(long) == long


def test_records_without_a_question(spark):
    rows = spark.createDataFrame([("How? ", "How? \n Like this."), (None, "Only text"), ("Why?", " Other ")], "q string, t string")
    question, answer = text.split_faq(F.col("q"), F.col("t"))
    assert [tuple(r) for r in rows.select(question, answer).collect()] == [("How?", "Like this."), (None, "Only text"), ("Why?", "Other")]


def test_vectors(one):
    zero, unit = F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(3.0), F.lit(4.0))
    assert one(vectors.l2_normalise(F.col("v")), v=unit) == [0.6, 0.8]
    assert one(vectors.l2_normalise(F.col("v")), v=zero) is None
    assert one(vectors.cosine(F.col("v"), F.col("w")), v=unit, w=zero) is None
    assert one(vectors.arg_max(F.col("v")), v=F.array(F.lit(1.0), F.lit(5.0), F.lit(5.0))) == 1


def test_hash_is_the_agreed_one(one):
    assert one(keys.stable_hash(1, F.col("a"), F.col("b")), a=7, b=42) == 3769085115
