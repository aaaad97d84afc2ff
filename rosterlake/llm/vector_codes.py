"""Product codes of vectors: the nearest codebook entry of every part, found by an equal-average search."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.llm.common import bounded_batches
from rosterlake.session import settle

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Gap to the entry before the first and after the last.
_NONE = np.int64(1) << np.int64(62)


class Codebooks(NamedTuple):
    """``entries`` by part, entry and position; ``sums`` of each part's entries in ascending order, with an end on
    either side; ``order`` the entries in that order."""

    entries: np.ndarray
    sums: np.ndarray
    order: np.ndarray


def codebooks(entries: np.ndarray) -> Codebooks:
    """Codebooks ready to be searched."""
    sums = entries.sum(axis=2)
    order = np.argsort(sums, axis=1, kind="stable")
    ends = np.full((len(sums), 1), _NONE)
    return Codebooks(entries, np.hstack([-ends, np.take_along_axis(sums, order, 1), ends]), order)


def nearest(books: Codebooks, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and its squared distance, by vector and part; ties go to the lower index.

    Entries are tried in the order of how far their component sum is from the part's, to either side. The squared
    gap over the dimension never exceeds the squared distance, so a part is done once it is strictly larger than the
    best distance so far. Parts of all vectors go on together until the last is done.
    """
    n, parts = len(vectors), len(books.entries)
    width = books.entries.shape[2]
    x = vectors.reshape(n * parts, width)
    part = np.tile(np.arange(parts), n)
    total = x.sum(axis=1)
    right = np.empty(n * parts, np.int64)  # place in the sums, ends counted
    for p in range(parts):
        right[p::parts] = np.searchsorted(books.sums[p, 1:-1], total[p::parts], "left") + 1
    left = right - 1
    best, limit = (np.full(n * parts, np.iinfo(np.int64).max) for _ in range(2))  # limit: best times the dimension
    index, live = np.full(n * parts, books.order.shape[1]), np.arange(n * parts)
    while len(live):
        p, lo, hi, s = part[live], left[live], right[live], total[live]
        below = np.where(lo > 0, s - books.sums[p, lo], _NONE)
        above = np.where(hi <= books.order.shape[1], books.sums[p, hi] - s, _NONE)
        up = above < below
        gap = np.where(up, above, below)
        go = (gap < _NONE) & (gap * gap <= limit[live])
        live, p, lo, hi, up = live[go], p[go], lo[go], hi[go], up[go]
        entry = books.order[p, np.where(up, hi, lo) - 1]
        apart = x[live] - books.entries[p, entry]
        far = (apart * apart).sum(axis=1)
        better = (far < best[live]) | ((far == best[live]) & (entry < index[live]))
        won = live[better]
        best[won], index[won], limit[won] = far[better], entry[better], far[better] * width
        left[live], right[live] = lo - ~up, hi + up
    return index.reshape(n, parts), best.reshape(n, parts)


def greatest_component(width: int, parts: int) -> int:
    """Bound on integer components at which no distance and no squared gap leaves 64 bits."""
    return math.isqrt((1 << 62) // (width * parts * width)) // 2


def integers(arrays: pa.Array, scale: int, width: int, parts: int) -> np.ndarray:
    """Vectors as integers: floor of each component times the scale, held within ``greatest_component``."""
    flat = arrays.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    top = greatest_component(width, parts)
    return np.clip(np.floor(np.clip(flat, -top, top) * scale), -top, top).astype(np.int64).reshape(-1, width * parts)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def first_vectors(kept: DataFrame, entries: int, parts: int) -> list[list[float]]:
    """The vectors of the smallest ids, all of the first one's length; at most ``entries`` come to the driver."""
    cuttable = kept.filter(F.size("vector") > 0).filter(F.size("vector") % parts == 0)
    ordered = cuttable.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector")
    rows = [r[0] for r in ordered.limit(entries).collect()]
    if any(len(r) != len(rows[0]) for r in rows):
        rows = [r[0] for r in ordered.filter(F.size("vector") == len(rows[0])).limit(entries).collect()]
    return rows


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray | None:
    """Codebook entries by part, entry and position, or None without a vector.

    They begin as the parts of the smallest ids' vectors. In a round every task adds its vectors' parts up by entry,
    Spark adds the tasks' sums, and the means, rounded down, become the entries; only these come to the driver.
    """
    rows = first_vectors(kept, entries, parts)
    if not rows:
        return None
    width = len(rows[0]) // parts
    arrow = pa.array(rows, pa.list_(pa.float64()))
    now = integers(arrow, scale, width, parts).reshape(len(rows), parts, width).transpose(1, 0, 2).copy()
    same = kept.filter(F.size("vector") == width * parts).select("vector")
    out = pa.schema([("place", pa.int32()), ("total", pa.int64()), ("n", pa.int64())])
    for _ in range(rounds):
        books = codebooks(now)

        def summed(found: Iterator[pa.RecordBatch], books: Codebooks = books) -> Iterator[pa.RecordBatch]:
            shape = books.entries.shape
            slots = shape[0] * shape[1]
            totals, counts = np.zeros((slots, shape[2]), np.int64), np.zeros(slots, np.int64)
            for batch in found:
                x = integers(batch.column(0), scale, shape[2], shape[0])
                at = (nearest(books, x)[0] + np.arange(shape[0]) * shape[1]).ravel()
                np.add.at(totals, at, x.reshape(-1, shape[2]))
                counts += np.bincount(at, minlength=slots)
            used = np.flatnonzero(np.repeat(counts, shape[2]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(totals.ravel()[used]), pa.array(np.repeat(counts, shape[2])[used])], schema=out)

        sums = same.mapInArrow(summed, "place int, total bigint, n bigint").groupBy("place").agg(
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        now = now.copy()
        for place, total, n in sums.collect():  # at most one row per component of the codebooks
            now.reshape(-1)[place] = int(total) // n
    return now


def digest(entries: np.ndarray | None) -> str:
    """SHA-256 of all entries' components, by part, entry and position, as decimals with commas between."""
    return hashlib.sha256(",".join(map(str, [] if entries is None else entries.ravel().tolist())).encode()).hexdigest()


def encode(kept: DataFrame, entries: np.ndarray | None, scale: int = SCALE) -> DataFrame:
    """The rows of ``vector``'s length with ``code`` (two hex digits a part) and ``error``, other columns but ``vector`` kept."""
    others = [c for c in kept.columns if c != "vector"]
    if entries is None:
        return kept.limit(0).select(*others, F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
    books = codebooks(entries)
    parts, _, width = entries.shape

    @F.arrow_udf("struct<code:string,error:bigint>")
    def coded(found: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in found:
            at, far = nearest(books, integers(vectors, scale, width, parts))
            codes = [bytes(row).hex() for row in at.astype(np.uint8)]
            yield pa.StructArray.from_arrays([pa.array(codes, pa.string()), pa.array(far.sum(axis=1), pa.int64())], ["code", "error"])

    same = kept.filter(F.size("vector") == width * parts).withColumn("_coded", coded("vector"))
    return same.select(*others, "_coded.code", "_coded.error")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per vector ``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``.

    ``error`` is the sum over the parts of the squared distance to the nearest entry, ``label_error`` the sum of it
    over all vectors of the same label; null labels belong together. A sum that no longer fits a long is null.

    Rows whose vector is null, or holds a null or a component that is not finite, are dropped; so are those whose length
    is not that of the usable vector with the smallest id whose length ``parts`` divides. Null ids come last. With
    fewer vectors than entries the codebooks are so much shorter. Of rows with the same id the smaller vector comes first;
    repeated rows count each and stay. Integer components are held within ``greatest_component`` (2^26 for
    16 parts of 4). An empty table gives an empty result; other columns are left behind. At most 256 entries have codes.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part")
    bounded_batches(vectors.sparkSession)
    named = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"),
                           F.col(label_col).alias("label"))
    kept = named.filter(usable(F.col("vector")))
    books = train(kept, parts, entries, rounds, scale)
    codes = settle(encode(kept, books, scale), "codes")
    sums = settle(codes.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error")), "label_errors")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
