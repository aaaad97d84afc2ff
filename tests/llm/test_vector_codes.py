import hashlib
import math

import numpy as np
import pytest

from rosterlake.llm import vector_codes

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def slow(rows, parts, entries, rounds, scale=256):
    """Codes of (id, vector, label) rows by whole searches in plain Python."""
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = [r for r in kept if r[1] and len(r[1]) % parts == 0]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        far = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        found = [[nearest(p, c[p])[0] for p in range(parts)] for c in cut]
        books = [[[sum(xs) // len(xs) for xs in zip(*mine, strict=True)] if (mine := [c[p] for c, f in zip(cut, found, strict=True) if f[p] == e])
                  else books[p][e] for e in range(len(books[p]))] for p in range(parts)]
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(f for _, f in row) for row in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for e, _ in row), e, by_label[label], digest)
                   for (i, _, label), row, e in zip(kept, found, errors, strict=True)), key=repr)


def test_given_vectors(spark, by_row):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    assert by_row(vector_codes.compress(table), *COLUMNS) == slow(rows, 16, 64, 2)


@pytest.mark.parametrize("parts, entries", [(1, 3), (2, 5), (4, 64)])
def test_odd_rows(spark, by_row, parts, entries):
    nan, inf = float("nan"), float("inf")
    rnd = np.random.default_rng(parts)
    rows = [(int(i), [float(x) for x in rnd.integers(-3, 4, 4) / 256], int(i) % 3 or None) for i in rnd.integers(-20, 40, 50)]
    rows += [(1, None, 1), (2, [], 1), (3, [0.1, nan, 0.2, 0.3], 1), (4, [0.1, inf, 0.2, 0.3], 1), (5, [0.1, -inf, 0.2, 0.3], 1),
             (6, [0.1, None, 0.2, 0.3], 1), (7, [0.1, 0.2, 0.3], 1), (8, [0.1] * 8, 1), (None, [0.5] * 4, None), (None, None, None),
             (9, [-0.001, 0.001, -0.0, 0.0], 7), (9, [-0.001, 0.001, -0.0, 0.0], 7), (10, [900.0, -900.0, 0.0, 3.5], 8)]
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows],
                                  "vec_id bigint, embedding array<double>, label int, code string, error int, vector int").repartition(4)
    assert by_row(vector_codes.compress(table, parts, entries), *COLUMNS) == slow(rows, parts, entries, 2)
    assert vector_codes.compress(table.limit(0), parts, entries).count() == 0
    assert vector_codes.compress(table.filter("vec_id = 1 AND embedding IS NULL"), parts, entries).count() == 0


def test_huge_components_are_held(spark):
    rows = [(i, [s * 1e300, s * 3e38, s * 1e9, 0.0], 1) for i, s in enumerate([1, -1, 1, -1, 0])]
    found = vector_codes.compress(spark.createDataFrame(rows, "vec_id int, embedding array<double>, label int"), 2, 2).collect()
    assert len(found) == 5 and all(r["error"] >= 0 for r in found)
    assert {r["code"] for r in found if r["vec_id"] in (0, 2)} == {"0000"}


def test_search_is_exact_on_ties():
    rnd = np.random.default_rng(4)
    for width, spread in ((1, 3), (2, 2), (4, 2), (5, 400)):
        entries = rnd.integers(-spread, spread + 1, (3, 40, width))
        x = rnd.integers(-spread, spread + 1, (300, 3 * width))
        at, far = vector_codes.nearest(vector_codes.codebooks(entries), x)
        whole = ((x.reshape(300, 3, 1, width) - entries[None]) ** 2).sum(axis=3)
        assert (at == whole.argmin(axis=2)).all() and (far == whole.min(axis=2)).all()


def test_too_many_entries_for_a_code(spark):
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame([], "vec_id int, embedding array<double>, label int"), 2, 257)
