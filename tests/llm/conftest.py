import random

import pytest

FOLDER = "/root/testdata/sf0.001"
EXTRA = "key bigint, text2 string, start int, words string, fp bigint, term string, score double"


@pytest.fixture(scope="session")
def given(spark):
    """The documents of the smallest tables and their texts by id."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs, {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.fixture(scope="session")
def odd_rows():
    """Ids and texts with nulls, empties, repeated rows, equal ids, copies, odd white space and a very long text."""
    rnd = random.Random(7)
    words = ["alpha", "Beta", "gamma", "délta", "epsilon", "the", "of", "and", "42", "x.", "CC", "BY", "license"]
    prose = " ".join(rnd.choice(words) + str(rnd.randrange(300)) for _ in range(400))
    long = " ".join(rnd.choice(words) + str(rnd.randrange(2000)) for _ in range(60_000))
    return [
        (1, prose), (2, prose), (2, prose), (3, None), (4, ""), (None, prose), (None, None), (5, "   "), (6, " lead"),
        (7, "trail "), (8, "two  spaces\tand\na line end \n"), (9, "one"), (9, "one other text of the same id"), (10, long),
        (11, prose[:700] + " changed " + prose[700:]), (12, "a" * 3000), (13, "日本語 テキスト – ünïcode ▁mark"),
        (14, "<|endoftext|> and <s> inside"), (-5, "negative id"), (15, "\u0000 control \u001f marks"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows as documents with further columns whose names operators use themselves."""
    rows = [(i, t, i, t, 1, "w", 7, "t", 0.5) for i, t in odd_rows]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, {EXTRA}").repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], f"doc_id bigint, text string, {EXTRA}")


@pytest.fixture(scope="session")
def by_row():
    """Rows of a result as a sorted list of tuples of the named columns."""

    def collect(df, *columns):
        return sorted(map(tuple, df.select(*columns).collect()), key=repr)

    return collect
