import itertools
import zlib

import numpy as np
import pytest

from rosterlake.llm import line_crf


def test_marginals_are_those_of_all_labellings():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 3, 5):
        good, steps = rnd.normal(size=n), rnd.normal(size=4)
        weights = {}
        for labels in itertools.product((0, 1), repeat=n):
            value = sum(g for g, y in zip(good, labels, strict=True) if y)
            value += sum(steps[2 * a + b] for a, b in itertools.pairwise(labels))
            weights[labels] = np.exp(value)
        total = sum(weights.values())
        slow = [sum(w for y, w in weights.items() if y[i]) / total for i in range(n)]
        assert line_crf.marginals(good, steps) == pytest.approx(slow)


def test_extreme_lines_stay_finite():
    found = line_crf.marginals(np.array([900.0, -900.0, 900.0, 0.0]), np.array([5.0, -5.0, -5.0, 5.0]))
    assert np.isfinite(found).all()
    model = line_crf.Model(np.full(line_crf.WIDTH, 50.0), np.zeros(4))
    for text in ("", "\n\n", "a" * 100_000, "%%% " * 5000, None):
        assert 0 <= line_crf.score_text(text, model) <= 1


def test_fit_finds_the_likelihood_optimum():
    """The fitted weights separate lines by one feature, and like neighbours attract."""
    rnd = np.random.default_rng(2)
    xs, labels = [], []
    for i in range(200):
        x = np.zeros((rnd.integers(1, 6), line_crf.WIDTH))
        x[:, -1], x[:, 0] = 1, rnd.normal((1 if i % 2 else -1), 1.5, len(x))
        xs.append(x)
        labels.append(i % 2)
    model = line_crf.fit(xs, labels, [np.ones(len(x)) for x in xs])
    bb, bg, gb, gg = model.steps
    assert model.weights[0] > 0 and bb + gg > bg + gb
    right = [(line_crf.marginals(x @ model.weights, model.steps).mean() > 0.5) == y for x, y in zip(xs, labels, strict=True)]
    assert np.mean(right) > 0.8


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = line_crf.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels).collect()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    judged = [(r["predicted"], truth[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in truth]
    assert len(judged) > 50 and np.mean([a == b for a, b in judged]) > 0.95


def test_held_out_labels_are_not_learnt(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F
    turned = labels.withColumn("quality", F.when(line_crf.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (line_crf.train(docs, x) for x in (labels, turned))
    assert np.array_equal(one.weights, two.weights) and (one.scale, one.shift) == (two.scale, two.shift)


def test_odd_rows(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (12, 0, 0), (None, 1, 0), (8, 0, 0), (11, 1, 0), (11, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    found = line_crf.classify(odd, labels).collect()
    assert len(found) == len(odd_rows) and all(r["score"] is not None and r["held_out"] is not None for r in found)
    assert line_crf.classify(none, labels).count() == 0
    assert {r["score"] for r in line_crf.classify(odd, labels.limit(0)).collect()} == {0.5}


def test_whole_texts_are_learnt_from(spark):
    """Documents that are bad after their 200th line only: a model that saw beginnings alone could not tell them."""
    good, bad = "A plain line of prose that ends as it should.", "$$ ## @@ 77 %% ^^ ** 99 && !! == 00"
    rows = [(i, "\n".join([good] * 250 + [bad if i % 2 else good] * 250), i % 2 == 0) for i in range(1, 60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(ok)) for i, _, ok in rows], "doc_id bigint, quality int")
    model = line_crf.train(docs, labels)
    assert all((line_crf.score_text(t, model) >= 0.5) == ok for _, t, ok in rows)
    # the bound is on lines in all, and texts that do not fit are not cut
    assert line_crf.train(docs, labels, lines=499) is None and line_crf.train(docs, labels, longest=499) is None
    assert line_crf.train(docs, labels, lines=1200) is not None


def test_string_ids(spark):
    docs = spark.createDataFrame([(f"d{i}", "good prose. " * 5 if i % 2 else "## $$ %%") for i in range(40)], "doc_id string, text string")
    labels = spark.createDataFrame([(f"d{i}", i % 2) for i in range(40)], "doc_id string, quality int")
    model = line_crf.train(docs, labels)
    assert line_crf.score_text("good prose. " * 5, model) > line_crf.score_text("## $$ %%", model)
