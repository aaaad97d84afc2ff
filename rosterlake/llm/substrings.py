"""Substring dedup: word windows that start in an earlier document too are removed, as maximal intervals."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import bitmap, in_bitmap, keyed, space_words
from rosterlake.llm.rolling import WordHashes, sliding_min, windows
from rosterlake.session import settle

WINDOW, GRAM = 50, 10
#: Bits of the filter of anchors (16 MB); more anchors make it let more windows through, never fewer.
FILTER_BITS = 1 << 27
#: Bits of the filter of first documents (4 MB); more of them let more copies through.
HEAD_BITS = 1 << 25
NOTHING = hashlib.sha256(b"").hexdigest()


def sequence(words: list[bytes]) -> tuple[int, int]:
    """Two signed 64-bit numbers that stand for a word sequence."""
    d = xxhash.xxh3_128_digest(b" ".join(words))
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def anchors_of(hashes: np.ndarray, size: int, gram: int) -> np.ndarray:
    """The anchor of each window: the least hash of the runs of ``gram`` words in it. Equal windows have equal anchors."""
    grams = windows(hashes, gram)
    return sliding_min(grams, size - gram + 1) if len(grams) > size - gram else np.empty(0, np.uint64)


def merged(starts: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal intervals ``[begin, end)`` of words that windows at the starts cover."""
    if not len(starts):
        return []
    s = np.unique(starts)
    new = np.flatnonzero(np.diff(s) > size) + 1
    begins, lasts = s[np.concatenate([[0], new])], s[np.concatenate([new - 1, [len(s) - 1]])]
    return list(zip(begins.tolist(), (lasts + size).tolist(), strict=True))


def remove_repeated(docs: DataFrame, size: int = WINDOW, gram: int = GRAM, with_text: bool = False,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``spans`` (removed word intervals).

    A word goes if a window of ``size`` words over it also starts in a document with a smaller id; windows are
    judged on the input. With ``with_text``, ``kept`` has the words left, joined by one space.

    Every window's Rabin-Karp hash is made once, in the task that reads the text. Before windows are written and shuffled, two exact
    steps leave out those that cannot count: copies of a whole word sequence are found by its digest (later
    ones lose all words), and a window is counted only if its anchor, the least hash of the ``gram``-word runs in
    it, stands in two different sequences. The anchors that do are held in a bitmap of fixed size, which may let
    windows through but stops none that repeat. The rest are counted by 128-bit hash; the first owner is a partial
    aggregate, so a window of any number of documents is no hot group.

    Null texts have no words. A document with a null id takes nothing from others and loses nothing. Rows with the
    same id and text share a result; rows with the same id and different texts do not remove from each other.
    An empty table gives an empty result; other columns are left behind.
    """
    spark = docs.sparkSession
    texts = keyed(docs, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    first = pa.schema([("doc_id", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("anchors", pa.list_(pa.int64()))])

    def described(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in found:
            out: list[list] = [[], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = space_words(text)
                if doc is not None and len(words) >= size:
                    a = np.unique(anchors_of(known.of(words), size, gram)).view(np.int64)
                    for column, value in zip(out, (doc, *sequence(words), a), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, first.types, strict=True)], schema=first)

    described_docs = settle(texts.mapInArrow(described, "doc_id bigint, s1 bigint, s2 bigint, anchors array<bigint>"), "sequences")
    shared = described_docs.select("s1", F.explode("anchors").alias("a")).groupBy("a").agg(
        F.min("s1").alias("low"), F.max("s1").alias("high")).filter("low <> high")
    passing = bitmap(spark, shared, "a", FILTER_BITS)
    owned = settle(described_docs.groupBy("s1", "s2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")), "heads")
    # later copies of a sequence lose all words and own no window, so only the first of each sends its windows
    heads = bitmap(spark, owned.select(F.col("s1").bitwiseXOR(F.col("owner")).alias("k")), "k", HEAD_BITS)

    def hits(words: list[bytes], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
        hashes = known.of(words)
        return np.flatnonzero(in_bitmap(passing.value, anchors_of(hashes, size, gram))), hashes

    flat = pa.schema([("doc_id", pa.int64()), ("s1", pa.int64()), ("start", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])

    def candidates(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in found:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = space_words(text)
                if doc is None or len(words) < size:
                    continue
                seq = sequence(words)[0]
                if not in_bitmap(heads.value, np.array([seq ^ doc], np.int64).view(np.uint64))[0]:
                    continue
                at, hashes = hits(words, known)
                if not len(at):
                    continue
                n = len(at)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, doc, np.int64)), pa.array(np.full(n, seq, np.int64)), pa.array(at.astype(np.int32)),
                    *(pa.array(windows(hashes, size, half)[at].view(np.int64)) for half in (0, 1)),
                ], schema=flat)

    # read twice, so written: making them costs far more than reading them
    each = settle(texts.mapInArrow(candidates, "doc_id bigint, s1 bigint, start int, h1 bigint, h2 bigint"), "candidates")
    owners = each.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
    # written, so that the join below stands alone and Spark can split a window that fills a partition
    owners = settle(owners.filter("owner < last").select("h1", "h2", "owner"), "owners")
    again = each.join(owners, ["h1", "h2"]).filter("owner < doc_id").select("doc_id", "s1", "start")
    starts = again.groupBy("doc_id", "s1").agg(F.collect_set("start").alias("starts"))
    copies = described_docs.select("doc_id", "s1", "s2").join(owned.filter("owner < last"), ["s1", "s2"])
    copies = copies.filter("owner < doc_id").select("doc_id", "s1").distinct()
    marks = starts.withColumn("copy", F.lit(False)).unionByName(
        copies.select("doc_id", "s1", F.lit(None).cast("array<int>").alias("starts"), F.lit(True).alias("copy")))
    marks = marks.groupBy("doc_id", "s1").agg(F.max("copy").alias("copy"), F.max_by("starts", F.size("starts")).alias("starts"))

    whole = pa.schema([("doc_id", pa.int64()), ("s1", pa.int64()), ("n_words", pa.int64()), ("whole_sha256", pa.string()),
                       ("text", pa.binary())])

    def judged(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in found:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = space_words(text)
                joined = b" ".join(words)
                needed = with_text or len(words) >= size and len(hits(words, known)[0])
                for column, value in zip(out, (doc, sequence(words)[0], len(words), hashlib.sha256(joined).hexdigest(),
                                               joined if needed else None), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, whole.types, strict=True)], schema=whole)

    left = texts.mapInArrow(judged, "doc_id bigint, s1 bigint, n_words bigint, whole_sha256 string, text binary")
    final = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                       ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                       *([("kept", pa.string())] if with_text else [])])

    def cut(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            rows = []
            for r in batch.to_pylist():
                n, text = r["n_words"], r["text"]
                spans = [(0, n)] if r["copy"] else merged(np.array(r["starts"] or [], np.int64), size)
                row = {"doc_id": r["doc_id"], "n_words": n, "n_removed": sum(e - b for b, e in spans),
                       "spans": [{"begin": b, "end": e} for b, e in spans]}
                if r["copy"]:
                    row |= {"kept_sha256": NOTHING, "kept": ""}
                elif not spans:
                    row |= {"kept_sha256": r["whole_sha256"], "kept": text}
                else:
                    words, kept, done = text.split(b" "), [], 0
                    for b, e in spans:
                        kept += words[done:b]
                        done = e
                    kept = b" ".join(kept + words[done:])
                    row |= {"kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept}
                if with_text and isinstance(row["kept"], bytes):
                    row["kept"] = row["kept"].decode("utf-8", "replace")
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=final)

    schema = ("doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, "
              "spans array<struct<begin:bigint,end:bigint>>" + (", kept string" if with_text else ""))
    return left.join(marks, ["doc_id", "s1"], "left").select(
        "doc_id", "n_words", "whole_sha256", "text", "copy", "starts").mapInArrow(cut, schema)
