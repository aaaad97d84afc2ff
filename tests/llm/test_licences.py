import random
import re

import pytest

from rosterlake.llm import licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in licences.BASE_PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


BASE = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def test_base_of_given_and_odd_rows(spark, given, odd, odd_rows, none, by_row):
    docs, texts = given
    assert by_row(licences.scan(docs), *BASE) == sorted(((i, *slow(t)) for i, t in texts.items()), key=repr)
    assert by_row(licences.scan(odd), *BASE) == sorted(((i, *slow(t)) for i, t in odd_rows), key=repr)
    assert licences.scan(none).count() == 0
    own = [(1, "CC BY cc by CC, by. General Public License all rights reserved? ALL RIGHTS RESERVEDé all rights reserved"), (2, "ccc by"),
           (3, "cc by\ncc-by general public licenses")]
    assert by_row(licences.scan(spark.createDataFrame(own, "doc_id bigint, text string")), *BASE) == sorted(((i, *slow(t)) for i, t in own), key=repr)


@pytest.mark.parametrize("text, names, score", [
    ("MIT", {"mit"}, 0.1), ("mit or gpl-3.0-only", {"mit", "gpl-3.0-only"}, 0.1), ("mit and gpl-3.0", {"mit", "gpl-3.0"}, 0.8),
    ("mit or apache-2.0 and gpl-2.0", {"mit", "apache-2.0", "gpl-2.0"}, 0.1),
    ("(mit or apache-2.0) and gpl-2.0", {"mit", "apache-2.0", "gpl-2.0"}, 0.8),
    ("gpl-2.0 with classpath", {"gpl-2.0", "gpl-2.0-with-classpath"}, 0.8 * 0.75),
    ("gpl-2.0 with a with b", {"gpl-2.0", "gpl-2.0-with-a"}, 0.8 * 0.75), ("mit and (gpl-2.0 or mit", {"mit"}, 0.1),
    ("(mit or gpl-2.0) with a", {"mit", "gpl-2.0"}, 0.1), ("((mit))", {"mit"}, 0.1), ("apache-2.0 or mit mit", {"apache-2.0", "mit"}, 0.1),
    ("mit and gpl-2.0+ with a or epl-2.0", {"mit", "gpl-2.0+", "gpl-2.0+-with-a", "epl-2.0"}, 0.5),
    ("mit or", {"mit"}, 0.1), ("mit )", {"mit"}, 0.1), ("mit; more", {"mit"}, 0.1),
])
def test_expressions(text, names, score):
    found, value = licences.evaluate(text.lower())
    assert found == names and value == pytest.approx(score)


@pytest.mark.parametrize("text", ["", "or mit", "(", "()", "and", "(mit"])
def test_no_expression(text):
    assert licences.evaluate(text) is None


def test_long_expressions_take_linear_time():
    words = ["mit", "gpl-2.0", "apache-2.0", "gpl-2.0 with classpath-exception-2.0"]
    for glue in (" or ", " and ", " with "):
        text = glue.join(words[i % 4] for i in range(10_000))
        names, value = licences.evaluate(text)
        assert len(names) <= 4 and 0 <= value <= 1
    nested = "(" * 5000 + "mit" + ")" * 5000
    assert licences.evaluate(nested) == ({"mit"}, 0.1) and licences.evaluate(nested[:-1]) is None


def slow_value(tokens):
    """Restriction of a valid expression by recursive descent."""

    def level(at, names):
        value, at = group(at, 0) if names[at] == "(" else (licences.restriction(names[at]), at + 1)
        if at < len(names) and names[at] == "with":
            value, at = value * 0.75, at + 2
        return value, at

    def both(at, names):
        value, at = level(at, names)
        while at < len(names) and names[at] == "and":
            more, at = level(at + 1, names)
            value = max(value, more)
        return value, at

    def group(at, _):
        value, at = either(at + 1, tokens)
        return value, at + 1

    def either(at, names):
        value, at = both(at, names)
        while at < len(names) and names[at] == "or":
            more, at = both(at + 1, names)
            value = min(value, more)
        return value, at

    return either(0, tokens)[0]


def test_generated_expressions_and_tagged_texts(spark):
    """Random expressions against recursive descent, and their labels and score in tagged texts."""
    rnd = random.Random(9)
    ids = ["mit", "gpl-2.0", "gpl-3.0+", "apache-2.0", "epl-2.0", "lgpl-2.1", "zlib", "licenseref-own"]

    def made(depth):
        if depth and rnd.random() < 0.4:
            return ["(", *made(depth - 1), ")"] if rnd.random() < 0.4 else [*made(depth - 1), rnd.choice(["and", "or"]), *made(depth - 1)]
        one = [rnd.choice(ids)]
        return [*one, "with", rnd.choice(licences.EXCEPTIONS)] if rnd.random() < 0.2 else one

    rows, wanted = [], {}
    for i in range(300):
        tokens = made(4)
        names = {t for j, t in enumerate(tokens) if t in ids} | {f"{tokens[j - 1]}-with-{tokens[j + 1]}" for j, t in enumerate(tokens) if t == "with"}
        found, value = licences.evaluate(" ".join(tokens))
        assert found == names and value == pytest.approx(slow_value(tokens))
        rows.append((i, f"code\n// {rnd.choice(['SPDX-License-Identifier:', 'License:'])} {' '.join(tokens).upper()}\nmore words"))
        wanted[i] = (",".join(sorted(names)), slow_value(tokens))
    rows += [(1000, "SPDX-License-Identifier: something else"), (1001, "SPDX-License-Identifier: MIT WITH no-such-exception")]
    wanted |= {1000: ("", 0.0), 1001: ("", 0.0)}
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {i: (n, pytest.approx(v)) for i, (n, v) in wanted.items()} == found


def test_labels_of_tags_and_notices(spark):
    rows = [(1, "# SPDX-License-Identifier: MIT OR Apache-2.0\ncode"), (2, "License: this work is ours"), (3, "License: BSD-3-Clause"),
            (4, "Licensed under the Apache License, Version 2.0."), (5, "nothing here"), (6, "All rights reserved.")]
    found = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[1]["labels"] == "apache-2.0,mit" and found[1]["score"] == pytest.approx(0.1)
    assert found[2]["labels"] == "" and found[3]["labels"] == "bsd-3-clause"
    assert "apache-2.0" in found[4]["labels"].split(",") and found[5]["score"] == 0 and found[6]["score"] == 1
    assert found[6]["labels"] == found[6]["base_labels"] == "reserved"
