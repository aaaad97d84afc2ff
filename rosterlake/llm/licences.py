"""Licence scan: Aho-Corasick over words and tags, and a shunting-yard evaluation of licence expressions."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import bounded_batches, plain_words

# The contract's phrases and labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Further notice phrases of well-known licences, as words.
NOTICE_PHRASES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "creative commons": "cc",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "isc license": "isc",
    "unlicense": "unlicense",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "zlib license": "zlib",
    "artistic license": "artistic",
    "open software license": "osl",
    "academic free license": "afl",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "python software foundation license": "psf",
    "open data commons": "odc",
    "open database license": "odbl",
    "sil open font license": "ofl",
    "microsoft public license": "ms-pl",
    "do what the fuck you want to public license": "wtfpl",
    "without warranty of any kind": "no-warranty",
}

# Tags that an expression follows on the same line.
TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:")

#: How far a licence restricts reuse, by the first part of its name: 0 free, 1 all rights reserved.
FREEDOM = {
    "0bsd": 0.0, "cc0": 0.0, "unlicense": 0.0, "public": 0.0, "mit": 0.1, "isc": 0.1, "bsd": 0.1, "zlib": 0.1,
    "apache": 0.2, "cc": 0.3, "epl": 0.5, "mpl": 0.5, "lgpl": 0.6, "gpl": 0.8, "agpl": 0.9, "reserved": 1.0,
    "proprietary": 1.0, "bsl": 0.1, "x11": 0.1, "ntp": 0.1, "hpnd": 0.1, "ncsa": 0.1, "postgresql": 0.1, "psf": 0.1, "python": 0.1,
    "ruby": 0.2, "wtfpl": 0.0, "afl": 0.2, "artistic": 0.3, "ofl": 0.3, "openssl": 0.2, "php": 0.2, "curl": 0.1, "icu": 0.1,
    "unicode": 0.1, "vim": 0.3, "ms": 0.4, "cddl": 0.5, "cpl": 0.5, "ipl": 0.5, "eupl": 0.6, "osl": 0.7, "odbl": 0.6, "odc": 0.3,
    "pddl": 0.0, "sspl": 0.95, "busl": 0.95, "elastic": 0.9, "gfdl": 0.6, "no": 0.0,
}
UNKNOWN = 0.5
# Names of exceptions that may follow "with".
EXCEPTIONS = (
    "autoconf-exception-2.0", "autoconf-exception-3.0", "bison-exception-2.2", "bootloader-exception", "classpath-exception-2.0",
    "fltk-exception", "font-exception-2.0", "gcc-exception-2.0", "gcc-exception-3.1", "gpl-3.0-linking-exception", "gpl-cc-1.0",
    "libtool-exception", "linux-syscall-note", "llvm-exception", "ocaml-lgpl-linking-exception", "openjdk-assembly-exception-1.0",
    "openssl-exception", "qt-lgpl-exception-1.1", "swift-exception", "u-boot-exception-2.0", "universal-foss-exception-1.0",
    "wxwindows-exception-3.1",
)
#: Beginnings of names that an expression may give to licences of its own.
OWN = ("licenseref-", "documentref-")
#: An exception named after "with" takes this share off what the licence restricts.
EXCEPTION = 0.25

BINDS = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+_-]*")


def restriction(label: str) -> float:
    """How far one licence restricts reuse, 0 to 1; 0.5 if its family is not known."""
    family = label.split("-")[0]
    return next((FREEDOM[x] for x in (label, family, family.rstrip("0123456789.+")) if x in FREEDOM), UNKNOWN)


def known(label: str) -> bool:
    """Whether a label's licence family, and the exception to it, is in the tables, or it is a name of the text's own."""
    licence, _, exception = label.partition("-with-")
    if exception and exception not in EXCEPTIONS:
        return False
    return licence.startswith(OWN) or licence in FREEDOM or licence.split("-")[0].rstrip("0123456789.+") in FREEDOM


def parsed(expression: str) -> list[tuple[str, str]]:
    """Kinds and tokens of the longest valid expression at the start of a text, empty if there is none.

    Kinds are ``licence``, ``exception``, ``(``, ``)`` and the operators. "with" stands between one licence and one
    exception, so neither a group nor an exception can have another exception.
    """
    tokens: list[tuple[str, str]] = []
    whole, depth, at = 0, 0, 0
    while True:
        while at < len(expression) and expression[at] in " \t":
            at += 1
        found = _TOKEN.match(expression, at)
        if not found:
            break
        token, at = found[0], found.end()
        last = tokens[-1][0] if tokens else "("
        wants = last in ("(", "and", "or")  # a licence or a group comes next
        if token == "(" and wants:
            tokens.append(("(", token))
            depth += 1
        elif token == ")" and depth and last in ("licence", "exception", ")"):
            tokens.append((")", token))
            depth -= 1
        elif token == "with" and last == "licence":
            tokens.append(("with", token))
        elif token in ("and", "or") and last in ("licence", "exception", ")"):
            tokens.append((token, token))
        elif token not in BINDS and token not in "()" and (wants or last == "with"):
            tokens.append(("exception" if last == "with" else "licence", token.rstrip(".-_") or token))
        else:
            break
        if not depth and tokens[-1][0] in ("licence", "exception", ")"):
            whole = len(tokens)
    return tokens[:whole]


def evaluate(expression: str) -> tuple[set[str], float] | None:
    """Licences and restriction of the longest valid expression at the start of a text, else nothing.

    Its tokens pass a shunting yard: "with" binds before "and", "and" before "or". "or" leaves a choice and takes
    the lesser restriction, "and" the greater one, "with" an exception to the licence before it. Time and memory grow with
    the expression's length.
    """
    tokens = parsed(expression)
    if not tokens:
        return None
    names: set[str] = set()
    values: list[float] = []
    operators: list[str] = []

    def apply(name: str) -> None:
        right, left = values.pop(), values.pop()
        values.append(left * (1 - EXCEPTION) if name == "with" else min(left, right) if name == "or" else max(left, right))

    for i, (kind, token) in enumerate(tokens):
        if kind == "licence":
            names.add(token)
            values.append(restriction(token))
        elif kind == "exception":
            names.add(f"{tokens[i - 2][1]}-with-{token}")
            values.append(0.0)
        elif kind == "(":
            operators.append(kind)
        elif kind == ")":
            while operators[-1] != "(":
                apply(operators.pop())
            operators.pop()
        else:
            while operators and operators[-1] != "(" and BINDS[operators[-1]] >= BINDS[kind]:
                apply(operators.pop())
            operators.append(kind)
    while operators:
        apply(operators.pop())
    return names, values[0]


@functools.cache
def automata(phrases: tuple[tuple[str, str, bool], ...], tags: tuple[str, ...]) -> tuple:
    """One automaton over space-joined words, one over lower-cased text; built once in each worker."""
    notices, marks = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label, base in phrases:
        padded = f" {phrase} "
        notices.add_word(padded, (len(padded), label, base))
    for tag in tags:
        marks.add_word(tag, tag)
    notices.make_automaton()
    marks.make_automaton()
    return notices, marks


def scan_text(text: bytes, phrases: tuple[tuple[str, str, bool], ...], tags: tuple[str, ...] = TAGS) -> dict:
    """What one whole text says about its licence; see ``scan``."""
    notices, marks = automata(phrases, tags)
    words = plain_words(text)
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    starts: list[int] = []
    base: set[str] = set()
    more: set[str] = set()
    for end, (length, label, is_base) in notices.iter(joined):
        more.add(label)
        if is_base:
            base.add(label)
            starts.append(end - length + 1)
    if starts:  # the n-th space stands before the n-th word
        spaces = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
        places = np.searchsorted(spaces, starts)
    low = text.lower().decode("latin-1")
    expressions = []
    for end, tag in marks.iter(low):
        stop = low.find("\n", end)
        found = evaluate(low[end + 1:stop if stop >= 0 else len(low)])
        if found and all(known(x) for x in found[0]):
            expressions.append(found)
            more |= found[0]
    if expressions:
        score = max(r for _, r in expressions)
    else:
        score = max((restriction(x) for x in more), default=0.0)
    return {
        "n_words": len(words), "n_base": len(starts),
        "first_word": int(places.min()) if starts else None, "last_word": int(places.max()) if starts else None,
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(x.encode("latin-1").decode("utf-8", "replace") for x in more)),
        "score": float(score), "n_expressions": len(expressions),
    }


FIELDS = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
          "score double, n_expressions bigint")


def scan(docs: DataFrame, base: dict[str, str] = BASE_PHRASES, notices: dict[str, str] = NOTICE_PHRASES,
         tags: tuple[str, ...] = TAGS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence labels of every document.

    Texts are read whole: lower-cased words meet the phrases in one pass of an Aho-Corasick automaton, so
    overlapping places all count, and a second automaton finds the tags whose rest of line is read as a licence
    expression; one with a name that is in no table says nothing. ``n_base``, ``first_word`` and ``last_word`` speak of the base phrases, ``base_labels`` of their
    labels, ``labels`` of those, the notices and the expressions' licences. ``score`` tells how far reuse is
    restricted (0 free or nothing found, 1 reserved): by the strictest expression if there is one, else by the
    strictest label. A null text counts as empty: no words, no labels, score 0. Rows are independent of each
    other: repeated rows repeat, an empty table gives an empty result, other columns are left behind.
    """
    bounded_batches(docs.sparkSession)
    phrases = tuple((p, label, True) for p, label in base.items())
    phrases += tuple((p, label, False) for p, label in notices.items() if p not in base)
    arrow = pa.struct([(f.split()[0], {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}[f.split()[1]])
                       for f in FIELDS.split(", ")])

    @F.arrow_udf(f"struct<{FIELDS.replace(' ', ':').replace(',:', ', ')}>")
    def found(each: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in each:
            yield pa.array([scan_text(t or b"", phrases, tags) for t in texts.to_pylist()], arrow)

    one = docs.select(F.col(id_col).alias("doc_id"), found(F.col(text_col).cast("string").cast("binary")).alias("s"))
    return one.select("doc_id", "s.*")
