"""SimHash near-duplicates: 64-bit fingerprints linked within a few bits, found by a pigeonring index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.llm.common import bounded_batches, row_key, space_words
from rosterlake.llm.components import components
from rosterlake.session import settle

SHINGLE, MAX_BITS, SEED = 3, 3, 42
#: Shingles whose bits are counted at once, so that a very long text needs no more memory.
BLOCK = 1 << 16


def fingerprint_of(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """Bits set in over half of the XXH64 hashes of a text's word shingles; 0 without words."""
    words = space_words(text.lower())
    if not words:
        return 0
    shingle = xxhash.xxh64_intdigest
    if len(words) < size:
        return shingle(b" ".join(words), seed)
    counts, total = np.zeros(64, np.int64), len(words) - size + 1
    for begin in range(0, total, BLOCK):
        part = words[begin:begin + BLOCK + size - 1]
        runs = zip(*(part[i:] for i in range(size)), strict=False)
        h = np.array([shingle(b" ".join(run), seed) for run in runs], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, size: int = SHINGLE, seed: int = SEED) -> Column:
    """The fingerprint of a text column as a signed 64-bit number; a null text has no words."""

    @F.arrow_udf("bigint")
    def prints(found: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in found:
            each = np.array([fingerprint_of(t or b"", size, seed) for t in texts.to_pylist()], np.uint64)
            yield pa.array(each.view(np.int64))

    return prints(text.cast("string").cast("binary"))


def ring(max_bits: int) -> list[tuple[int, int]]:
    """Start and width of ``max_bits + 1`` segments of 64 bits."""
    n = max_bits + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``u``, ``v`` of different fingerprints (column ``fp``, distinct) at most ``max_bits`` bits apart.

    The 64 bits are a ring of ``n = max_bits + 1`` segments. Two fingerprints within the distance have a
    segment from which every chain of l segments differs in at most ``l * max_bits / n`` bits: none in the first, one at
    most in the first two, and so on. The index key is a chain of two segments; one side probes it as it is
    and, if its second segment has an even number of ones, with each bit of that segment flipped (of two
    segments one bit apart, exactly one is even). Longer chains are then held against their budgets before
    the whole distance. A bucket of the index holds fingerprints equal in about 64 * 2 / n bits, so
    candidates stay near the number of links.
    """
    if max_bits < 1:
        return prints.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    segments = ring(max_bits)
    n = len(segments)

    def piece(i: int) -> str:
        start, width = segments[i % n]
        return f"(shiftrightunsigned(fp, {start}) & {(1 << width) - 1}L)"

    def mask(i: int, length: int) -> int:
        bits = 0
        for start, width in (segments[(i + j) % n] for j in range(length)):
            bits |= ((1 << width) - 1) << start
        return bits - (1 << 64) if bits >> 63 else bits

    index, probe = [], []
    for i in range(n):
        width = segments[(i + 1) % n][1]
        index.append(f"struct({i} AS i, {piece(i)} AS a, {piece(i + 1)} AS b)")
        flips = ", ".join(f"struct({i} AS i, {piece(i)} AS a, {piece(i + 1)} ^ {1 << k}L AS b, true AS flip)" for k in range(width))
        probe.append(f"array(struct({i} AS i, {piece(i)} AS a, {piece(i + 1)} AS b, false AS flip))")
        probe.append(f"IF(bit_count({piece(i + 1)}) % 2 = 0, array({flips}), array())")
    stored = prints.select("fp", F.explode(F.expr(f"array({', '.join(index)})")).alias("k"))
    stored = stored.select(F.col("fp").alias("v"), "k.i", "k.a", "k.b")
    asked = prints.select("fp", F.explode(F.expr(f"concat({', '.join(probe)})")).alias("k"))
    asked = asked.select(F.col("fp").alias("u"), "k.i", "k.a", "k.b", "k.flip")
    apart = " AND ".join(
        f"(i <> {i} OR bit_count((u ^ v) & {mask(i, length)}L) <= {length * max_bits // n})"
        for i in range(n) for length in range(3, n)
    ) or "true"
    met = asked.join(stored, ["i", "a", "b"]).filter(
        f"(flip OR u < v) AND u <> v AND {apart} AND bit_count(u ^ v) <= {max_bits}"
    )
    return met.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def grouped(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
            text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``key``, ``fp`` of all rows, and ``fp``, ``root``, ``component_id`` of all fingerprints.

    Copies share a fingerprint, so groups of copies of any size are one row of the second table. The
    component's id is the smallest document id reachable over links; null ids count only if there is no other.
    """
    bounded_batches(docs.sparkSession)
    ids = settle(docs.select(
        F.col(id_col).alias("doc_id"), row_key(F.col(id_col), F.col(text_col).cast("string")).alias("key"),
        fingerprint(F.col(text_col), size).alias("fp"),
    ), "simhash")
    prints = settle(ids.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    stars = components(links(prints.select("fp"), max_bits))
    rooted = prints.join(stars.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return ids, rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``.

    Null and empty texts have fingerprint 0 and link like any other. Repeated rows stay repeated; other
    columns of the table are left behind; an empty table gives an empty result.
    """
    ids, groups = grouped(docs, size, max_bits, id_col, text_col)
    return ids.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The documents without near-duplicates: one of each component, that with the smallest id, stays once.

    Only the keys of the documents kept are joined to the table. Among rows with the smallest id, or in a
    component without any id, the smallest key decides.
    """
    ids, groups = grouped(docs, size, max_bits, id_col, text_col)
    kept = ids.join(groups, "fp").filter("doc_id <=> component_id").groupBy("root").agg(F.min("key").alias("__key"))
    kept = settle(kept.select("__key"), "kept")
    marked = docs.withColumn("__key", row_key(F.col(id_col), F.col(text_col).cast("string")))
    return marked.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
