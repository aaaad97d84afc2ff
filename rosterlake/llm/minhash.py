"""MinHash near-dedup: min-max signatures in bands find candidates, whole shingle sets confirm them."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from rosterlake.llm.common import bitmap, bounded_batches, in_bitmap, space_words
from rosterlake.llm.components import components
from rosterlake.llm.rolling import WordHashes, windows
from rosterlake.session import settle

SHINGLE, PERCENT = 2, 80
#: Bands, and permutations per band; each permutation gives a band its minimum and its maximum.
BANDS, ROWS = 48, 3
#: Hashes that are permuted at once, so that a long text needs no more memory.
BLOCK = 1 << 13
#: Bits of the filter of documents whose texts are compared (2 MB); more documents let more rows through, never fewer.
TEXT_BITS = 1 << 24


def shingle_set(text: bytes, size: int = SHINGLE) -> set[tuple[bytes, ...]]:
    """Distinct word shingles of a text; with fewer words the whole sequence is the only one."""
    words = space_words(text.lower())
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def shingle_hashes(text: bytes, known: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Ascending distinct 64-bit hashes of the shingles of ``shingle_set``."""
    words = space_words(text.lower())
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows(known.of(words), min(size, len(words))))


@functools.lru_cache(8)
def permutations(number: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and odd factors of ``number`` permutations of the 64-bit numbers, and of the bands' keys."""
    made = np.random.default_rng(20).integers(0, 1 << 63, (2, number, 1), np.int64).astype(np.uint64) * np.uint64(2)
    return made[0] ^ (made[1] >> np.uint64(32)), made[1] | np.uint64(1)


def min_max(hashes: np.ndarray, number: int) -> np.ndarray:
    """Least and greatest value of the hashes under each permutation, one row of two per permutation.

    Both come from one evaluation of the permutation. Each agrees between two sets with the probability of their Jaccard
    similarity, and the two are all but independent, so ``number`` evaluations give twice as many values.
    """
    offsets, factors = permutations(number)
    low, high = np.full(number, ~np.uint64(0)), np.zeros(number, np.uint64)
    for at in range(0, len(hashes), BLOCK):
        mixed = (hashes[None, at:at + BLOCK] ^ offsets) * factors
        np.minimum(low, mixed.min(axis=1), out=low)
        np.maximum(high, mixed.max(axis=1), out=high)
    return np.stack([low, high], axis=1)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band, of the band's number and all its minima and maxima."""
    each = signature.reshape(bands, -1)
    factors = permutations(each.size)[1].reshape(each.shape)
    mixed = ((each ^ (each >> np.uint64(31))) * factors).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def prints(docs: DataFrame, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per document: ``rid`` (its number), ``doc_id``, ``text``, ``n`` shingles, digest ``d1``, ``d2`` of the set, ``keys``.

    It is written out, so that the numbers stay; steps that need no text do not read it again.
    """
    bounded_batches(docs.sparkSession)
    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    out = pa.schema([("doc_id", pa.int64()), ("text", pa.binary()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                     ("keys", pa.list_(pa.int64()))])

    def described(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in found:
            sizes, digests, keys = [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingle_hashes(text or b"", known, size)
                sizes.append(len(hashes))
                digests.append(np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64))
                keys.append(band_keys(min_max(hashes, bands * rows), bands).view(np.int64) if len(hashes) else np.empty(0, np.int64))
            both = np.array(digests, np.int64).reshape(-1, 2)
            ends = np.cumsum([0, *map(len, keys)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *keys])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                                              pa.array(both[:, 0]), pa.array(both[:, 1]), lists], schema=out)

    made = given.mapInArrow(described, "doc_id bigint, text binary, n bigint, d1 bigint, d2 bigint, keys array<bigint>")
    return settle(made.withColumn("rid", F.monotonically_increasing_id()), "prints")


def _with_texts(pairs: DataFrame, each: DataFrame):
    """Pairs ``u``, ``v`` of document numbers with their texts ``a``, ``b``, and the filter that reads only texts wanted."""
    spark = pairs.sparkSession
    wanted = bitmap(spark, pairs.select("u").union(pairs.select("v")).distinct().select(F.xxhash64("u").alias("h")), "h", TEXT_BITS)

    @F.arrow_udf("boolean")
    def asked(found: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for hashes in found:
            yield pa.array(in_bitmap(wanted.value, hashes.to_numpy(zero_copy_only=False).view(np.uint64)))

    texts = each.filter("n > 0").select("rid", "text", F.xxhash64("rid").alias("h")).filter(asked("h"))
    met = pairs.join(texts.select(F.col("rid").alias("v"), F.col("text").alias("b")), "v").join(
        texts.select(F.col("rid").alias("u"), F.col("text").alias("a")), "u")
    return met, wanted


def confirmed(pairs: DataFrame, each: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``u``, ``v`` of document numbers whose whole shingle sets are similar enough, compared word by word."""

    @F.arrow_udf("boolean")
    def similar(found: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last, held = None, set()
        for left, right in found:
            out = []
            for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True):
                if a != last:  # pairs come sorted by the first one
                    last, held = a, shingle_set(a, size)
                out.append(alike(held, shingle_set(b, size), percent))
            yield pa.array(out, pa.bool_())

    met, wanted = _with_texts(pairs, each)
    links = settle(met.filter(similar("a", "b")).select("u", "v"), "links")
    wanted.destroy()  # what needed it is written
    return links


def alike(one: set, other: set, percent: int) -> bool:
    both = len(one & other)
    return 100 * both >= percent * (len(one) + len(other) - both)


def apart(members: DataFrame, each: DataFrame, size: int, percent: int) -> DataFrame:
    """The members with ``linked`` (are they similar enough to their pivot ``u``), and ``diff``, the hashes of the shingles that
    only one of the two has."""
    out = pa.struct([("linked", pa.bool_()), ("diff", pa.list_(pa.int64()))])

    @F.arrow_udf("struct<linked:boolean,diff:array<bigint>>")
    def compared(found: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known, last, held, hashes = WordHashes(), None, set(), np.empty(0, np.uint64)
        for left, right in found:
            rows = []
            for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True):
                if a != last:
                    last, held, hashes = a, shingle_set(a, size), shingle_hashes(a, known, size)
                diff = np.setxor1d(hashes, shingle_hashes(b, known, size), assume_unique=True)
                rows.append({"linked": alike(held, shingle_set(b, size), percent), "diff": diff.view(np.int64)})
            yield pa.array(rows, out)

    met, wanted = _with_texts(members, each)
    found = settle(met.withColumn("c", compared("a", "b")).select(*members.columns, "c.linked", "c.diff"), "apart")
    wanted.destroy()
    return found


def difference_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs ``u``, ``v`` of members of a cluster that can be similar enough, and that the pivot does not join already.

    What parts two sets is what parts their differences from the pivot: if it may be ``part`` shingles at most, two
    differences of x and y shingles share at least o = (x + y - part) / 2 of them. In an order of the shingles by how
    many of the cluster's differences have them, two that share o meet in the first x - o + 1 of the one and y - o + 1 of
    the other. Members near the pivot are joined by it, so one of a pair is not near it, o is at least 1, and the rare
    shingles by which a copy alone differs from the pivot come first and meet nothing.
    """
    near, far = 100 - percent, 100 + percent
    each = members.select("cluster", "node", "n", "joined", "linked", F.size("diff").alias("m"), F.explode("diff").alias("h"))
    counts = settle(each.groupBy("cluster", "h").agg(F.count("*").alias("c")).filter("c > 1"), "differences")
    own = Window.partitionBy("node")
    ranked = each.join(counts, ["cluster", "h"]).withColumns({
        # shingles of this member alone come first
        "rank": F.col("m") - F.count("*").over(own) + F.row_number().over(own.orderBy("c", "h"))})
    longest = F.when(F.col("linked"), F.col("rank") * far <= 100 * F.col("m") + far).otherwise(
        F.col("rank") * percent <= near * F.col("n") + percent)
    first = settle(ranked.filter(longest).drop("c"), "first_differences")
    x = first.filter("NOT linked").select("cluster", "h", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "joined", "m", "rank")])
    both = x.join(first, ["cluster", "h"])
    least = (F.col("x_m") + F.col("m")) * far - near * (F.col("x_n") + F.col("n"))
    met = both.filter(
        (F.col("x_joined") != F.col("joined")) & (F.col("linked") | (F.col("x_node") < F.col("node")))
        & (100 * F.least("x_n", "n") >= percent * F.greatest("x_n", "n"))
        & (least <= 2 * far * (F.col("x_m") - F.col("x_rank") + 1)) & (least <= 2 * far * (F.col("m") - F.col("rank") + 1)))
    return settle(met.select(F.least("x_node", "node").alias("u"), F.greatest("x_node", "node").alias("v")).distinct(), "pairs")


def classes(each: DataFrame, nodes: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``node`` and ``root`` of the distinct sets that have links; ``nodes`` has ``node`` and ``n``.

    Sets with an equal band key form a bucket. First every set is held against one other only, the smallest of all its
    buckets; that joins most of a group of near copies. Buckets whose sets are then of one component are done. The others,
    together with those they share sets with, are clusters. A cluster's pivot, a set of its largest component, is held
    against all its sets, and pairs that are left are found by what they share of their differences from the
    pivot. So every pair with an equal key is compared, or proved too far apart, or joined by other links, and a
    group's pairs are never listed.
    """
    rows = each.select("rid", "keys").join(nodes.select(F.col("node").alias("rid")), "rid")
    rows = rows.select(F.explode("keys").alias("key"), F.col("rid").alias("node"))
    shared = rows.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("least")).filter("c > 1").select("key", "least")
    buckets = settle(rows.join(settle(shared, "keys"), "key"), "buckets")
    pairs = buckets.filter("node <> least").groupBy("node").agg(F.min("least").alias("u")).select("u", F.col("node").alias("v"))
    roots = components(confirmed(settle(pairs, "pairs"), each, size, percent))
    sizes = settle(roots.groupBy("root").agg(F.count("*").alias("size")), "sizes")
    roots = settle(roots.join(sizes, "root").select("node", "root", "size"), "roots")
    placed = settle(buckets.join(roots, "node", "left").select("key", "least", "node", F.coalesce("root", "node").alias("root")), "placed")
    several = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key")
    several = settle(several, "open")
    if several.isEmpty():
        return roots.select("node", "root")
    clusters = components(placed.join(several, "key").select(F.col("least").alias("u"), F.col("node").alias("v")))
    members = clusters.select("node", F.col("root").alias("cluster")).join(nodes.select("node", "n"), "node").join(roots, "node", "left")
    members = settle(members.select("cluster", "node", "n", F.coalesce("root", "node").alias("root"), F.coalesce("size", F.lit(1)).alias("size")), "members")
    pivots = members.groupBy("cluster").agg(F.min(F.struct((-F.col("size")).alias("s"), "node", "root")).alias("p"))
    pivots = settle(pivots.select("cluster", F.col("p.node").alias("u"), F.col("p.root").alias("u_root")), "pivots")
    held = members.join(pivots, "cluster").filter("node <> u").withColumnRenamed("node", "v")
    known = apart(settle(held, "held"), each, size, percent)
    joined = F.when(F.col("linked"), F.col("u_root")).otherwise(F.col("root"))
    left = difference_pairs(known.withColumn("joined", joined).withColumnRenamed("v", "node"), percent)
    links = confirmed(left, each, size, percent).union(known.filter("linked").select("u", "v"))
    return components(links.union(roots.select(F.col("root").alias("u"), F.col("node").alias("v"))))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if their sets of distinct ``size``-word shingles (lower-cased A-Z; fewer words: the whole
    sequence) share at least ``percent`` of their union. ``component_id`` is the smallest id reachable over links,
    ``kept`` tells whether it is the document's own.

    Equal sets are one set from the start, however many documents have it. Two sets of similarity s miss each other in
    all bands with a probability of (1 - s^6)^48: 5e-7 at 0.8, 9e-6 for two sets of five shingles or fewer. Null and empty texts and those
    without words have no shingles and are linked with nothing: their component is their own id. Repeated rows stay repeated. A null id
    counts only where there is no other; its row is kept if its component has no id. An empty table gives an empty
    result; other columns are left behind.
    """
    each = prints(docs, size, bands, rows, id_col, text_col)
    sets = each.filter("n > 0").groupBy("d1", "d2").agg(
        F.min("rid").alias("node"), F.min("doc_id").alias("least"), F.max("n").alias("n"))
    sets = settle(sets, "sets")
    roots = classes(each, sets, size, percent)
    rooted = sets.join(roots, "node", "left").select("d1", "d2", "least", F.coalesce("root", "node").alias("root"))
    rooted = settle(rooted, "rooted")
    least = settle(rooted.groupBy("root").agg(F.min("least").alias("component")), "components")
    known = settle(rooted.join(least, "root").select("d1", "d2", "component"), "classes")
    whole = each.select("doc_id", "n", "d1", "d2").join(known, ["d1", "d2"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return whole.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"))
