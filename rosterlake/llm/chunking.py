"""Document fingerprints: content-defined chunks cut by a normalised gear hash, and weighted containment."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import id_tops, keyed

#: Bytes of a chunk: least, normal, most. Before the normal length a cut needs HARD zero bits, after it EASY ones.
LEAST, NORMAL, MOST = 8, 24, 96
HARD, EASY = 6, 4
#: Bytes that the gear hash looks back.
REACH = 16
#: A random number per byte value.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 42) for b in range(256)], np.uint32)
#: Bytes hashed at once, so that a very long text needs no more memory.
SPAN = 1 << 22

CHUNK = np.dtype([("digest", "<u4"), ("length", "u1")])


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: the last ``REACH`` bytes' numbers, shifted left once per byte since."""
    h, width = GEAR[data], 1
    while width < REACH:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def candidates(data: np.ndarray) -> tuple[list[int], list[bool]]:
    """Ends of possible chunks, and whether they are fit before the normal length too."""
    ends, hard = [], []
    for begin in range(0, len(data), SPAN):
        back = min(begin, REACH - 1)
        # the low bits of the sum are those that the last bytes alone decide; cuts look at bits that all REACH bytes reach
        h = gear(data[begin - back:begin + SPAN])[back:] >> np.uint32(REACH - HARD)
        at = np.flatnonzero((h & np.uint32((1 << EASY) - 1)) == 0)
        ends.append(at + begin + 1)
        hard.append((h[at] & np.uint32((1 << HARD) - 1)) == 0)
    return np.concatenate(ends).tolist(), np.concatenate(hard).tolist()


def cuts(text: bytes) -> list[int]:
    """Ends of the chunks of a text: the first fit end at each length, or the greatest length."""
    n = len(text)
    if n <= LEAST:
        return [n] if n else []
    out, begin = [], 0
    for end, hard in zip(*candidates(np.frombuffer(text, np.uint8)), strict=True):
        while end - begin > MOST:
            begin += MOST
            out.append(begin)
        length = end - begin
        if length >= NORMAL or (hard and length >= LEAST):
            out.append(end)
            begin = end
    while n - begin > MOST:
        begin += MOST
        out.append(begin)
    if begin < n:
        out.append(n)
    return out


def chunks_of(text: bytes) -> dict[int, int]:
    """The set of chunks of a text: 32-bit digest and length in bytes of each."""
    digest, out, begin = xxhash.xxh32_intdigest, {}, 0
    for end in cuts(text):
        out[digest(text[begin:end])] = end - begin
        begin = end
    return out


def written(chunks: dict[int, int]) -> str:
    """A fingerprint as text: the chunks, by digest, as base64 of 5 bytes each."""
    return base64.b64encode(np.array(sorted(chunks.items()), CHUNK).tobytes()).decode() if chunks else ""


def read(fingerprint: str) -> dict[int, int]:
    """The chunks of a fingerprint."""
    return dict(np.frombuffer(base64.b64decode(fingerprint), CHUNK).tolist())


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of a's length in chunks that b has too; without chunks, 1 if both have none."""
    whole = sum(a.values())
    return sum(n for d, n in a.items() if d in b) / whole if whole else float(not b)


RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness; see ``RESULT``.

    The edited text has the last half of the code points (rounded down) replaced by the first as many, or all, of the
    next document in descending id order; the last document's next is the first. ``near_edited`` and ``near_next`` are the
    length-weighted containment of the document's chunks in the edited text's and in the next document's.

    Documents go once through one shuffle: ranges of ids, cut at ids of the table, become partitions, sorted and read
    as a stream that holds two documents at a time. A range's greatest documents also go to the range before it, as
    the successors of its last. Null texts count as empty. Null ids come last; rows with equal ids follow each other
    by text. A single row is its own next; an empty table gives an empty result; other columns are left behind.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = keyed(docs, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ids = docs.select(F.col(id_col).cast("bigint").alias("doc_id"))
    # a range holds the ids up to one of the tops and above the next smaller one; the last range has the null ids too
    low = np.array(id_tops(ids, parts), np.int64)
    n, tops = max(len(low), 1), set(low.tolist())

    @F.arrow_udf("array<struct<part:int,next:boolean>>")
    def places(found: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("part", pa.int32()), ("next", pa.bool_())]))
        for each in found:
            out = []
            for doc in each.to_pylist():
                part = n - 1 if doc is None else n - 1 - int(np.searchsorted(low, doc, "left"))
                heads = doc in tops if tops else True  # without any id all rows may be the first
                out.append([{"part": part, "next": False}, *([{"part": (part - 1) % n, "next": True}] if heads else [])])
            yield pa.array(out, kind)

    out = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def compared(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size, range_no, done = None, [], 0, None, False

        def row(one: tuple, after: tuple) -> tuple:
            doc, text, chunks = one
            chars = text.decode("utf-8", "replace")
            half = len(chars) // 2
            edited = (chars[:len(chars) - half] + after[1].decode("utf-8", "replace")[:half]).encode()
            other = chunks_of(edited)
            return (doc, len(chars), hashlib.sha256(edited).hexdigest(), written(chunks), written(other),
                    containment(chunks, other), containment(chunks, after[2]))

        for batch in found:
            for part, is_next, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != range_no:
                    held, range_no, done = None, part, False
                if done:
                    continue  # only the first of the next range's rows is a successor
                now = (doc, text, chunks_of(text))
                if held:
                    rows.append(row(held, now))
                    size += len(held[1])
                held, done = now, is_next
                if size > 4 << 20 or len(rows) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), out.types, strict=True)], schema=out)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), out.types, strict=True)], schema=out)

    placed = texts.select(F.explode(places("doc_id")).alias("p"), "doc_id", "text").select("p.part", "p.next", "doc_id", "text")
    ordered = placed.repartitionById(n, "part").sortWithinPartitions(
        "part", "next", F.col("doc_id").desc_nulls_last(), "text")
    return ordered.mapInArrow(compared, RESULT)
