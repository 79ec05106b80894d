"""License automata against regular expressions over the same words, and the query against plain Python."""

import random
import re

import pytest

from foliospark.llm.license_scan import MAX_WORDS, TokenAutomaton, license_report, license_spans, parse, spans, words_of
from foliospark.llm.license_templates import BSD_CONDITIONS, BSD_ENDORSEMENT, MIT_GRANT, PHRASES, TEMPLATES
from foliospark.llm.queries_licenses import _pattern, op11

FOLDER = "/root/testdata/sf0.001"
MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
       "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
       "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
       "to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all "
       "copies or substantial portions of the Software.")
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
       "conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
       "following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
       "the following disclaimer in the documentation and/or other materials provided with the distribution.\n")
THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
         "from this software without specific prior written permission.")
NOTICES = ["Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.",
           "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "no license", "MIT  license mit-license MIT\x85License",
           "general public license", "the GNU Lesser General Public License", "licensed under the terms of the mit license"]
ODD = [None, "", " \n", "license", "licensed under the", MIT, MIT.upper(), MIT.replace("hereby", "thereby"), MIT.replace("the Software", "SOFTWARE"),
       BSD, BSD + THIRD, BSD + THIRD.replace("written ", ""), "é MIT License " * 3, "mit mit license license", *NOTICES, "pad " * 30_000 + MIT + " mit license"]


def plain(text):
    """n_words, places, base labels, labels and score by regular expressions."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, base = [], set()
    for label, phrase in PHRASES:
        want = phrase.lower().split()
        here = [i for i in range(len(words)) if words[i:i + len(want)] == want]
        places += here
        base |= {label} if here else set()
    joined = " " + " ".join(words) + " "
    proven = {label for label, markup in TEMPLATES if re.search(" " + _pattern(parse(markup)), joined)}
    every = base | proven
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(every)),
            len(proven) / len(every) if every else 0.0)


def test_odd_texts_equal_regular_expressions(spark):
    frame = spark.createDataFrame([(i % 20, t, "x", 1) for i, t in enumerate(ODD)], "doc_id long, text string, spans string, n_words int")
    rows = license_report(frame, PHRASES, TEMPLATES).collect()
    assert sorted((tuple(r) for r in rows), key=str) == sorted(((i % 20, *plain(t)) for i, t in enumerate(ODD)), key=str)
    assert license_report(frame.limit(0), PHRASES, TEMPLATES).count() == 0


def test_query_equals_regular_expressions(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert {r.doc_id: tuple(r)[1:] for r in op11(spark, FOLDER).collect()} == {i: plain(t) for i, t in texts.items()}


def test_mandatory_wording_is_exact():
    names = [label for label, _ in TEMPLATES]

    def labels(text):
        return {names[t] for t, _, _ in spans(text, tuple(m for _, m in TEMPLATES))[1]}

    assert labels(MIT) == {"mit"} and labels("Copyright (c) 2020 Ann\n" + MIT.replace(",", "") + " THE SOFTWARE IS PROVIDED") == {"mit"}
    assert labels(BSD) == {"bsd-2-clause"} and labels(BSD + THIRD) == {"bsd-2-clause", "bsd-3-clause"}
    words = MIT.split()
    mandatory = {b"hereby", b"granted", b"sublicense", b"portions", b"restriction", b"furnished"}
    for i, word in enumerate(words):
        if words_of(word) and words_of(word)[0] in mandatory:
            assert labels(" ".join(words[:i] + words[i + 1:])) == set()
            assert labels(" ".join([*words[:i], "other", *words[i + 1:]])) == set()
    assert labels(MIT.replace("this permission notice", "this permission notice (including the next paragraph)")) == {"mit"}


def test_random_markup_equals_regular_expressions():
    rng = random.Random(11)

    def markup(depth=0):
        parts = ["a"] if depth == 0 else []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.random()
            if kind < 0.6 or depth > 2:
                parts.append(rng.choice("abc1"))
            elif kind < 0.8:
                low = rng.randrange(3)
                parts.append(f"<<var;words={low}-{low + rng.randrange(3)}{rng.choice(['', ';match=[0-9]+', ';match=[ab]'])}>>")
            else:
                parts.append(f"<<beginOptional>>{markup(depth + 1)}<<endOptional>>")
        return " ".join(parts)

    for _ in range(300):
        marks = tuple(markup() for _ in range(3))
        patterns = [re.compile(_pattern(parse(m))) for m in marks]
        text = " ".join(rng.choice("abc12") for _ in range(30))
        n, found = spans(text, marks)
        assert n == 30
        words = text.split()
        expected = set()
        for i in range(30):
            for t, p in enumerate(patterns):
                ends = [j for j in range(i, 30) if p.fullmatch(" ".join(words[i:j + 1]) + " ")]
                if ends:
                    expected.add((t, i, max(ends)))
        assert set(found) == expected and len(found) == len(expected)


def test_spans_and_refused_markup(spark):
    frame = spark.createDataFrame([(None, "x " + BSD + THIRD)], "doc_id long, text string")
    row = license_spans(frame, PHRASES, [("bsd", BSD_CONDITIONS + BSD_ENDORSEMENT), ("mit", MIT_GRANT)]).first()
    assert [tuple(s) for s in row.spans] == [("bsd", "template", 1, row.n_words - 1)]
    for bad in ("", "<<var;words=1-2>> a", "a <<beginOptional>> b", "a <<endOptional>>", "a <<other>>", f"a <<var;words=1-{MAX_WORDS + 1}>>"):
        with pytest.raises(ValueError):
            TokenAutomaton([bad])
