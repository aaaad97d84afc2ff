import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from rosterlake.llm import infill

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def slow(rows, marks=infill.MARKS, changed=90):
    """Units, form, lengths and output of each row by plain string work."""
    p, s, m = marks
    out = []
    for i, text in rows:
        text = text or ""
        units = UNIT.findall(text)
        assert "".join(units) == text
        digits = hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest()
        h = [int(digits[8 * k:8 * k + 8], 16) for k in range(4)]
        a, b = sorted(x % (len(units) + 1) for x in h[:2])
        prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not text or any(x in text for x in marks) or h[2] % 100 >= changed:
            out.append((i, len(units), "plain", None, None, text))
        elif h[3] % 100 < 20:
            out.append((i, len(units), "spm", len(prefix), len(middle), f"{s}{suffix}{p}{prefix}{m}{middle}"))
        else:
            out.append((i, len(units), "psm", len(prefix), len(middle), f"{p}{prefix}{s}{suffix}{m}{middle}"))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")


def test_given_documents(given, by_row):
    docs, texts = given
    assert by_row(infill.transform(docs), *COLUMNS) == slow(texts.items())
    report = by_row(infill.report(docs), "doc_id", "output_sha256", "restored_sha256")
    outputs = {r[0]: r[5] for r in slow(texts.items())}
    assert report == sorted(((i, hashlib.sha256(outputs[i].encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
                             for i, t in texts.items()), key=repr)


def test_odd_rows(odd, odd_rows, none, by_row):
    more = [(100 + i, t) for i, t in enumerate(["has <P> inside", "<S>", "a<M>", "<P", "P><S", "<", "<<<>>>", "<P<S<M" * 9, "x" * 7, "x" * 8,
                                                "x" * 9, "é" * 8, "𝒜b" * 5, "\U0010ffff", "a\r\n\n b", "[`{@", "Z[z{A@a`"])]
    docs = odd.select("doc_id", "text", "words").union(
        odd.sparkSession.createDataFrame([(*r, "w") for r in more], "doc_id bigint, text string, words string"))
    rows = [*odd_rows, *more]
    assert by_row(infill.transform(docs), *COLUMNS) == slow(rows)
    made = infill.transform(docs)
    back = made.select("doc_id", infill.restored(F.col("output"), F.col("form")).alias("text"))
    assert by_row(back, "doc_id", "text") == sorted(((i, t or "") for i, t in rows), key=repr)
    assert infill.transform(none).count() == 0 and infill.report(none).count() == 0


def test_ids_and_marks_of_other_kinds(spark, by_row):
    rows = [("a1", "some text with enough units, 1 2 3"), ("b2", "[PRE]"), ("c3", "[pre] other"), ("d4", "")]
    marks = ("[PRE]", "[SUF]", "[MID]")
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    made = infill.transform(docs, changed=100, marks=marks)
    assert by_row(made, *COLUMNS) == slow(rows, marks, 100)
    back = made.select("doc_id", infill.restored(F.col("output"), F.col("form"), marks).alias("text"))
    assert by_row(back, "doc_id", "text") == sorted(rows)


def test_rank_and_select_by_words():
    rnd = np.random.default_rng(3)
    letters = list("abZ @[`{1é日𝒜\n")
    for size in (0, 1, 7, 8, 9, 63, 64, 65, 1000):
        texts = ["".join(rnd.choice(letters, size)) for _ in range(3)] + [""]
        draws = rnd.integers(0, 1 << 32, (4, 2), np.uint64)
        n, one, two, before, middle = infill.cuts([t.encode() for t in texts], draws)
        for i, text in enumerate(texts):
            units = UNIT.findall(text)
            a, b = sorted(int(d) % (len(units) + 1) for d in draws[i])
            assert n[i] == len(units) and one[i] == len("".join(units[:a]).encode()) and two[i] == len("".join(units[:b]).encode())
            assert before[i] == len("".join(units[:a])) and middle[i] == len("".join(units[a:b]))


def test_long_texts_are_cut_in_blocks(monkeypatch):
    text = "some words, é and 日本 " * 400
    whole = infill.cuts([text.encode()], np.array([[12345, 99999]]))
    monkeypatch.setattr(infill, "BLOCK", 3)
    assert all((a == b).all() for a, b in zip(whole, infill.cuts([text.encode()], np.array([[12345, 99999]])), strict=True))
