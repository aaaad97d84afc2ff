"""Quality classifier: a linear-chain conditional random field labels lines, and documents add up their marginals."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.llm.common import bounded_batches
from rosterlake.session import settle

#: Bounds of the training sample: labelled documents, lines in all, and lines of one document.
SAMPLE_DOCS, SAMPLE_LINES, LONGEST_DOC = 4000, 60_000, 1000
THRESHOLD = 0.7
#: Strength of the pull of weights to zero, and steps of the fit.
RIDGE, STEPS = 1e-3, 250

_WORD = re.compile(r"\w+")
_SIGNS = re.compile(r"[^\w\s.,;:!?'\"()-]")
_PARTS = 12


def line_parts(line: str, seen: dict[str, int]) -> list[float]:
    """Numbers that describe one line by itself; ``seen`` counts the document's lines so far."""
    n = len(line)
    words = line.split()
    m = len(words)
    names = _WORD.findall(line)
    signs = len(_SIGNS.findall(line))
    ends = line.count(".") + line.count("!") + line.count("?")
    short = sum(1 for w in names if len(w) <= 3)
    again = seen.get(line, 0)
    seen[line] = again + 1
    return [
        min(np.log1p(n), 8.0) / 4, min(m, 60) / 30, min(sum(map(len, words)) / m, 20) / 8 if m else 0.0,
        min(signs / m, 2.0) if m else 0.0, min(10 * signs / n, 3.0) if n else 0.0, min(ends / m, 1.0) if m else 0.0,
        short / len(names) if names else 0.0, len(set(words)) / m if m else 0.0,
        min(20 * sum(map(str.isdigit, line)) / n, 3.0) if n else 0.0,
        min(10 * sum(map(str.isupper, line)) / n, 3.0) if n else 0.0,
        1.0 if line[-1:] in ".!?" else 0.0, min(again, 3) / 3,
    ]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """One row of features per line (its own parts, their squares, both neighbours' parts, a constant), and lengths."""
    lines = text.split("\n")
    seen: dict[str, int] = {}
    own = np.array([line_parts(line, seen) for line in lines])
    edge = np.zeros((1, _PARTS))
    before, after = np.concatenate([edge, own[:-1]]), np.concatenate([own[1:], edge])
    first = np.zeros((len(own), 2))
    first[0, 0] = first[-1, 1] = 1.0
    x = np.concatenate([own, own ** 2, before, after, first, np.ones((len(own), 1))], axis=1)
    return x, np.array([len(line) + 1.0 for line in lines])


WIDTH = 4 * _PARTS + 3


@dataclass
class Model:
    """Weights of a good line, the pull of equal neighbours (bad-bad, bad-good, good-bad, good-good), and a calibration."""

    weights: np.ndarray
    steps: np.ndarray
    scale: float = 1.0
    shift: float = 0.0


def marginals(good: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Probability of a good line for each line of one chain, by scaled forward and backward passes.

    ``good`` are the log-odds of the lines' features, ``steps`` the log weights of neighbouring labels.
    """
    n = len(good)
    if n == 1:
        return 1 / (1 + np.exp(-good))
    top = np.maximum(good, 0)
    one, zero = np.exp(good - top).tolist(), np.exp(-top).tolist()
    bb, bg, gb, gg = np.exp(steps - steps.max()).tolist()
    forward, a, b = [], zero[0], one[0]
    for z, o in zip(zero[1:], one[1:], strict=True):
        total = a + b
        a, b = a / total, b / total
        forward.append((a, b))
        a, b = (a * bb + b * gb) * z, (a * bg + b * gg) * o
    total = a + b
    forward.append((a / total, b / total))
    out, c, d = [forward[-1][1]], 1.0, 1.0
    for i in range(n - 1, 0, -1):
        z, o = zero[i] * c, one[i] * d
        c, d = bb * z + bg * o, gb * z + gg * o
        total = c + d
        c, d = c / total, d / total
        a, b = forward[i - 1]
        out.append(b * d / (a * c + b * d))
    return np.array(out[::-1])


def raw_score(text: str, model: Model) -> float:
    """Log-odds of the length-weighted mean marginal of a text's lines."""
    x, lengths = features(text)
    p = float(np.average(marginals(x @ model.weights, model.steps), weights=lengths))
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def score_text(text: str | None, model: Model) -> float:
    """Probability that a document is good."""
    return float(1 / (1 + np.exp(-np.clip(model.scale * raw_score(text or "", model) + model.shift, -30, 30))))


def chains(xs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Chains side by side, longest first: one row per line, ordered by place and then chain; and the chains at each place."""
    lengths = np.array([len(x) for x in xs])
    at = [int((lengths > t).sum()) for t in range(lengths.max())]
    rows = np.concatenate([np.stack([xs[k][t] for k in range(n)]) for t, n in enumerate(at)])
    return rows, np.concatenate([[0], np.cumsum(at)]), at


def fit(xs: list[np.ndarray], labels: list[int], lengths: list[np.ndarray]) -> Model:
    """Maximum likelihood of the lines' labels, each a copy of its document's, with a ridge; and a calibration of documents.

    The gradient is expected less observed features, from forward and backward passes over all chains at once.
    """
    order = sorted(range(len(xs)), key=lambda i: -len(xs[i]))
    xs, labels, lengths = ([v[i] for i in order] for v in (xs, labels, lengths))
    y = np.array(labels, float)
    rows, begin, at = chains(xs)
    truth = np.concatenate([y[:n] for n in at])
    # every document counts the same, good and bad ones together as much
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    weight = share / np.array([len(x) for x in xs])
    per_row = np.concatenate([weight[:n] for n in at])
    w, steps = np.zeros(WIDTH), np.zeros(4)
    m1, m2 = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
    observed = np.zeros(4)
    for n in at[1:]:
        observed += [(weight[:n] * (1 - y[:n])).sum(), 0, 0, (weight[:n] * y[:n]).sum()]

    def passes(good: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top = np.maximum(good, 0)
        e = np.stack([np.exp(-top), np.exp(good - top)], axis=1)
        k = np.exp(steps - steps.max()).reshape(2, 2)
        f = np.empty_like(e)
        f[:at[0]] = e[:at[0]] / e[:at[0]].sum(1, keepdims=True)
        for t in range(1, len(at)):
            n, i, j = at[t], begin[t], begin[t - 1]
            v = (f[j:j + n] @ k) * e[i:i + n]
            f[i:i + n] = v / v.sum(1, keepdims=True)
        b = np.ones_like(e)
        pairs = np.zeros(4)
        for t in range(len(at) - 1, 0, -1):
            n, i, j = at[t], begin[t], begin[t - 1]
            v = e[i:i + n] * b[i:i + n]
            joint = f[j:j + n, :, None] * k[None] * v[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            pairs += (joint * weight[:n, None, None]).sum(0).ravel()
            v = v @ k.T
            b[j:j + n] = v / v.sum(1, keepdims=True)
        p = f * b
        return p[:, 1] / p.sum(1), pairs

    for step in range(1, STEPS + 1):
        p, pairs = passes(rows @ w, steps)
        g = np.concatenate([rows.T @ (per_row * (p - truth)) + RIDGE * w, pairs - observed + RIDGE * steps])
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g ** 2
        move = 0.1 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-9)
        w, steps = w - move[:-4], steps - move[-4:]
    model = Model(w, steps)
    raw = []
    for x, n in zip(xs, lengths, strict=True):
        p = min(max(float(np.average(marginals(x @ w, steps), weights=n)), 1e-6), 1 - 1e-6)
        raw.append(np.log(p / (1 - p)))
    model.scale, model.shift = calibrated(np.array(raw), y)
    return model


def calibrated(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic curve through the documents' labels, by Newton steps with a ridge."""
    z, v = np.stack([raw, np.ones(len(raw))], axis=1), np.zeros(2)
    goal = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ v, -30, 30)))
        g = z.T @ (p - y) + 1e-1 * (v - goal)
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-1 * np.eye(2)
        move = np.linalg.solve(h, g)
        v = v - np.clip(move, -2, 2)
    return float(max(v[0], 1e-3)), float(v[1])


def held_out(doc_id: Column) -> Column:
    """Whether labels of a document must not be learnt from; a null id is never learnt from, but is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          sample: int = SAMPLE_DOCS, lines: int = SAMPLE_LINES, longest: int = LONGEST_DOC) -> Model | None:
    """A model from labelled documents that are not held out: at most ``sample`` of them, with at most ``lines`` lines in all.

    Documents come in the order of a hash of their ids, each with its whole text; one with more than ``longest`` lines, or that
    does not fit in what is left of the lines, is not learnt from. So the features that come to the driver are bounded by ``lines``, whatever the texts' lengths.
    Null labels and ids are left out; without any labelled document there is no model.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    order = F.xxhash64("id")
    picked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        "id IS NOT NULL AND label IN (0, 1)").filter(~held_out(F.col("id")))
    picked = settle(picked.groupBy("id").agg(F.max("label").alias("label")).orderBy(order, "id").limit(sample), "sample")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(picked, "id")
    # repeated rows of one id: the least text, so that the sample keeps its bound
    one = texts.groupBy("id", "label").agg(F.min("text").alias("text")).withColumn("place", order)
    out = pa.schema([("place", pa.int64()), ("label", pa.int32()), ("n", pa.int64()), ("x", pa.binary()), ("lengths", pa.binary())])

    def described(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for place, label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, n = features(text or "")
                row = ([place], [label], [len(n)], [np.asarray(x, "<f8").tobytes()], [np.asarray(n, "<f8").tobytes()])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, out.types, strict=True)], schema=out)

    given = one.select("place", "label", "text").mapInArrow(described, "place bigint, label int, n bigint, x binary, lengths binary")
    made = settle(given, "features")
    chosen, room = [], lines
    for place, n in sorted(map(tuple, made.select("place", "n").collect())):
        if n <= min(room, longest):
            chosen.append((place,))
            room -= n
    if not chosen:
        return None
    rows = made.join(spark.createDataFrame(chosen, "place bigint"), "place", "left_semi").collect()
    rows.sort(key=lambda r: (r["place"], r["label"], r["x"]))
    return fit([np.frombuffer(r["x"], "<f8").reshape(-1, WIDTH) for r in rows], [r["label"] for r in rows],
               [np.frombuffer(r["lengths"], "<f8") for r in rows])


def quality(text: Column, model: Model | None) -> Column:
    """Score of a text column, 0 to 1: higher, better. A null text counts as empty; without a model it is 0.5."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def scored(found: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in found:
            yield pa.array([score_text(t, model) for t in texts.to_pylist()], pa.float64())

    return scored(text.cast("string"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Per document ``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 if the score reaches the threshold).

    Scores depend on the text alone. Repeated rows repeat; other columns are left behind; an empty table gives an empty result.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    one = docs.select(F.col(id_col).alias("doc_id"), quality(F.col(text_col), model).alias("score"))
    return one.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
