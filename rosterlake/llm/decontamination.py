"""Benchmark decontamination: a positional inverted index of the training texts, searched from the rarest terms."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import bitmap, hits, in_bitmap, keyed, plain_bytes, plain_words, row_key
from rosterlake.llm.rolling import _POWERS, mixed
from rosterlake.session import settle

#: Words of a window, and how far from its place a term may stand in production: one word put in or left out every nine
#: leaves no 10 words in a row equal, but each within one word of its place.
WINDOW, SLOP = 10, 1
#: Bits of the filter of benchmark terms for each window length (512 KB); more terms let more postings through.
TERM_BITS = 1 << 22
#: Bytes whose words a task hashes at once.
BYTES_AT_ONCE = 1 << 18


def phrases_of(items: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``phrase`` (its words joined by a space), ``terms`` and ``item_id``: all windows of ``size`` consecutive words.

    An item of fewer words, but not none, is one window. Null texts have no words.
    """
    texts = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    out = pa.schema([("item_id", pa.string()), ("phrase", pa.string()), ("terms", pa.list_(pa.string()))])

    def cut(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = [w.decode("utf-8", "replace") for w in plain_words(text or b"")]
                many = [words[i:i + size] for i in range(max(1, len(words) - size + 1))] if words else []
                for begin in range(0, len(many), 10_000):
                    part = many[begin:begin + 10_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([item] * len(part), pa.string()), pa.array([" ".join(p) for p in part], pa.string()),
                        pa.array(part, out.field("terms").type)], schema=out)

    return texts.mapInArrow(cut, "item_id string, phrase string, terms array<string>").distinct()


class Words:
    """All words of many texts: where they begin and end in ``data``, their hashes, and how many each text has.

    Words are hashed as stretches of a running sum over the bytes, about ``BYTES_AT_ONCE`` at a time.
    """

    def __init__(self, texts: list[bytes]):
        self.data = plain_bytes(b" ".join(texts))
        lengths = np.array([len(text) for text in texts], np.int64)
        begins, ends, hashes, at = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
        while at < len(self.data):
            end = self.data.find(b" ", at + BYTES_AT_ONCE)
            end = len(self.data) if end < 0 else end
            part = np.frombuffer(self.data, np.uint8, end - at, at)
            edges = np.flatnonzero(np.diff(part != 32, prepend=False, append=False))
            up, down = _POWERS[0].upto(len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part + np.uint64(1)) * up, out=sums[1:])
            begin, upto = edges[::2], edges[1::2]
            hashes.append(mixed((sums[upto] - sums[begin]) * down[begin]))
            begins.append(begin + at)
            ends.append(upto + at)
            at = end
        self.begins, self.ends, self.hashes = np.concatenate(begins), np.concatenate(ends), np.concatenate(hashes)
        last = np.cumsum(lengths + 1)  # the place after each text
        self.counts = np.searchsorted(self.begins, last) - np.searchsorted(self.begins, last - lengths - 1)

    def __getitem__(self, at: int) -> bytes:
        return self.data[self.begins[at]:self.ends[at]]


def crowded(at: np.ndarray, need: int, span: int) -> np.ndarray:
    """Which of the ascending positions stand with ``need`` of them, themselves among those, in ``span`` words in a row."""
    if len(at) < need:
        return np.zeros(len(at), bool)
    begins = np.flatnonzero(at[need - 1:] - at[:len(at) - need + 1] < span)
    steps = np.zeros(len(at) + 1, np.int64)
    steps[begins] += 1
    steps[begins + need] -= 1
    return np.cumsum(steps[:-1]) > 0


def paired(at: np.ndarray, h: np.ndarray, pairs: np.ndarray, slop: int) -> np.ndarray:
    """Which of the ascending positions of words, given by hashes, have one as near as neighbouring terms may be, with a phrase's
    neighbour of theirs."""
    turned = h << np.uint64(1) | h >> np.uint64(63)
    fit = in_bitmap(pairs, h ^ turned)  # one word may serve two equal terms
    for step in range(1, min(2 + 2 * slop, len(at))):
        left = np.flatnonzero(at[step:] - at[:-step] <= 1 + 2 * slop)
        right = left + step
        met = in_bitmap(pairs, h[left] ^ turned[right]) | in_bitmap(pairs, h[right] ^ turned[left])
        fit[left[met]] = fit[right[met]] = True
    return fit


def places(words: Words, filters: dict[int, np.ndarray], fewest: dict[int, int], pairs: np.ndarray | None = None, slop: int = 0) -> np.ndarray:
    """The words, as places among all, that a window could cover: among as many that windows of that length hold as it needs.

    With a slop, a term may stand so many words before or after its place. A window's terms then stand in ``2 * slop``
    more words than it has, neighbouring terms at most ``1 + 2 * slop`` apart, and one word may serve several equal terms.
    """
    # texts are laid side by side, further apart than any window reaches
    apart = max(filters, default=0) + 2 * slop + 1
    at = np.arange(len(words.hashes)) + np.repeat(np.arange(len(words.counts)) * apart, words.counts)
    fit = np.zeros(len(at), bool)
    for length, whole in filters.items():
        need, span = fewest[length] if slop else length, length + 2 * slop
        inside = hits(whole, words.hashes)
        inside = inside[crowded(at[inside], need, span)]
        if slop and length > 1 and len(inside):
            inside = inside[paired(at[inside], words.hashes[inside], pairs, slop)]
            inside = inside[crowded(at[inside], need, span)]
        fit[inside] = True
    return np.flatnonzero(fit)


def store_index(docs: DataFrame, phrases: DataFrame, slop: int = 0) -> tuple[DataFrame, DataFrame]:
    """The written index ``term``, ``key``, ``positions``, and ``doc_id``, ``key``, ``n_words`` of all documents.

    Postings are kept where a phrase could stand: terms no phrase holds, and places with too few others for any phrase,
    are not stored. Which terms those are is told to tasks by bitmaps of fixed size, one for each window length in use, and
    with a slop one more for phrases' neighbouring terms.
    """
    spark = docs.sparkSession

    @F.arrow_udf("bigint")
    def word_hash(found: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for words in found:
            yield pa.array(Words([w.encode() for w in words.to_pylist()]).hashes.view(np.int64))

    terms = phrases.select(F.size("terms").alias("length"), F.explode("terms").alias("term")).distinct()
    fewest = dict(phrases.groupBy(F.size("terms")).agg(F.min(F.size(F.array_distinct("terms")))).collect())
    hashed = settle(terms.select("length", word_hash("term").alias("h")), "terms")
    filters = {n: bitmap(spark, hashed.filter(F.col("length") == n), "h", TERM_BITS) for n in sorted(fewest)}
    # a hash for two neighbouring terms: that of the first, and that of the second turned by a bit
    second = F.col("hb")
    turned = F.shiftleft(second, 1).bitwiseOR(F.shiftrightunsigned(second, 63))
    neighbours = phrases.select(F.explode(F.arrays_zip(F.expr("slice(terms, 1, size(terms) - 1)").alias("a"),
                                                       F.expr("slice(terms, 2, size(terms) - 1)").alias("b"))).alias("p")).select("p.a", "p.b").distinct()
    neighbours = neighbours.select(word_hash("a").alias("ha"), word_hash("b").alias("hb"))
    pairs = bitmap(spark, neighbours.select(F.col("ha").bitwiseXOR(turned).alias("h")), "h", TERM_BITS) if slop else None
    out = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("n_words", pa.int64()),
                     ("terms", pa.list_(pa.string())), ("positions", pa.list_(pa.list_(pa.int32())))])

    def posted(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = {n: f.value for n, f in filters.items()}
        for batch in found:
            terms, positions = [], []
            words = Words(batch.column("text").to_pylist())
            found_at, begin = places(words, told, fewest, pairs.value if slop else None, slop), np.cumsum(words.counts) - words.counts
            cuts = np.searchsorted(found_at, np.append(begin, len(words.hashes)))
            for first, low, high in zip(begin.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                lists: dict[bytes, list[int]] = {}
                for p in found_at[low:high].tolist():
                    lists.setdefault(words[p], []).append(p - first)
                terms.append([w.decode("utf-8", "replace") for w in lists])
                positions.append(list(lists.values()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(words.counts, pa.int64()),
                                              pa.array(terms, out.field("terms").type),
                                              pa.array(positions, out.field("positions").type)], schema=out)

    texts = keyed(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "key", "text")
    rows = settle(texts.mapInArrow(posted, "doc_id bigint, key binary, n_words bigint, terms array<string>, "
                                           "positions array<array<int>>"), "postings")
    for told in [*filters.values(), *([pairs] if slop else [])]:
        told.destroy()  # the postings are written
    lists = rows.select("key", F.explode(F.arrays_zip("terms", "positions")).alias("p"))
    return lists.select(F.col("p.terms").alias("term"), "key", "p.positions"), rows.select("doc_id", "key", "n_words")


def search(index: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """``key``, ``phrase``, ``start``, ``length`` and ``exact`` of the phrases' places in the indexed texts.

    Each phrase starts from its rarest term: the places in that term's list, less the term's offset, are where the phrase
    may start. Those are intersected with the second-rarest term's list, and what is left with all others. With a
    slop, a term counts within so many words of its place, and matches that are not exact are proximity matches.
    """
    near = phrases.select("phrase", "terms").distinct()
    each = near.select("phrase", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term"))
    weights = settle(index.groupBy("term").agg(F.sum(F.size("positions")).alias("weight")), "weights")
    # a phrase with a term that is nowhere has no match
    known = each.join(weights, "term")
    ranked = known.groupBy("phrase", "length").agg(
        F.sort_array(F.collect_list(F.struct("weight", "offset", "term"))).alias("order")).filter("size(order) = length")
    ranked = settle(ranked, "phrases")

    def listed(rank: int) -> DataFrame:
        return ranked.filter(F.size("order") > rank).select("phrase", F.col("order")[rank]["offset"].alias("offset"),
                                                            F.col("order")[rank]["term"].alias("term"))

    def starts(asked: DataFrame, among: DataFrame | None = None) -> DataFrame:
        found = asked.join(index, "term")
        if among is not None:  # lists of texts in which the phrase can start at all
            found = found.join(among, ["phrase", "key"], "left_semi")
        found = found.select("phrase", "offset", "key", F.explode("positions").alias("at"))
        base = F.col("at") - F.col("offset")
        if not slop:
            return found.select("key", "phrase", "offset", base.alias("start"), F.lit(True).alias("exact")).filter("start >= 0")
        # the first term stands at or after the text's beginning, its place may be before it
        around = F.explode(F.sequence(base - slop, base + slop)).alias("start")
        return found.select("key", "phrase", "offset", base.alias("base"), around).select(
            "key", "phrase", "offset", "start", (F.col("start") == F.col("base")).alias("exact")).filter(F.col("start") >= -slop)

    on = ["key", "phrase", "start"]
    rarest = settle(starts(listed(0)).groupBy(*on).agg(F.max("exact").alias("exact")), "rarest")
    second = starts(listed(1), rarest.select("phrase", "key").distinct()).groupBy(*on).agg(F.max("exact").alias("exact2"))
    lengths = ranked.select("phrase", F.size("order").alias("length"))
    met = rarest.join(second, on, "left").join(lengths, "phrase").filter("length = 1 OR exact2 IS NOT NULL")
    met = settle(met.select(*on, "length", (F.col("exact") & F.coalesce("exact2", F.lit(True))).alias("exact")), "places")
    # the other terms: every place left asks for its terms in the lists of its own text
    rest = met.filter("length > 2").join(ranked.select("phrase", "order"), "phrase")
    rest = rest.select(*on, F.explode(F.slice("order", 3, F.col("length") - 2)).alias("o"))
    rest = rest.select(*on, "o.offset", "o.term").join(index, ["term", "key"])
    place = F.col("start") + F.col("offset")
    exact = F.array_contains("positions", place)
    fit = exact if not slop else F.exists("positions", lambda p: F.abs(p - place) <= slop)
    # repeated rows share a key and list its postings twice
    rest = rest.filter(fit).groupBy(*on).agg(F.count_distinct("offset").alias("n"), F.min(exact).alias("all_exact"))
    done = met.join(rest, on, "left").filter("length <= 2 OR n = length - 2")
    return done.select(*on, "length", (F.col("exact") & F.coalesce("all_exact", F.lit(True))).alias("exact"))


def find_items(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = 0, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``items``, ``n_near``, ``near``.

    A word is hit if an exact occurrence of an item's window covers it; ``items`` are the items with such windows,
    sorted as strings. ``near`` are the items that only match within the slop, term by term, sorted likewise, and ``n_near``
    is their number (none without a slop); they count neither as hits nor as contamination.
    Copies of a text and id share postings' key, so repeated rows share a result. Null texts have no words; null item ids
    count as the string "null"; empty tables give an empty result or one without hits; other columns are left behind.
    """
    one = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    phrases = settle(phrases_of(items, size, item_col, item_text).select(
        F.coalesce("item_id", F.lit("null")).alias("item_id"), "phrase", "terms"), "windows")
    index, rows = store_index(one, phrases, slop)
    matches = settle(search(index, phrases, slop), "matches")
    exact = matches.filter("exact")
    hits = exact.groupBy("key").agg(F.collect_set(F.struct("start", "length")).alias("spans"))

    def covered(spans):
        """Words under spans sorted by start: each adds what reaches beyond those before it."""
        zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))

        def add(s, x):
            end = x["start"] + x["length"]
            more = F.greatest(F.lit(0), end - F.greatest(s["end"], x["start"]))
            return F.struct((s["n"] + more).alias("n"), F.greatest(s["end"], end).alias("end"))

        return F.aggregate(F.sort_array(spans), zero, add, lambda s: s["n"])

    owners = phrases.select("phrase", "item_id")
    named = exact.select("key", "phrase").distinct().join(owners, "phrase").groupBy("key").agg(
        F.sort_array(F.collect_set("item_id")).alias("items"))
    found = hits.select("key", covered(F.col("spans")).alias("n_hit")).join(named, "key")
    if slop:
        near = matches.filter("NOT exact").select("key", "phrase").distinct().join(owners, "phrase").groupBy("key").agg(
            F.collect_set("item_id").alias("near"))
        found = found.join(near, "key", "full")
    else:
        found = found.withColumn("near", F.lit(None).cast("array<string>"))
    none = F.array().cast("array<string>")
    found = found.select("key", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), F.coalesce("items", none).alias("items"),
                         F.coalesce("near", none).alias("near"))
    found = found.withColumn("near", F.sort_array(F.array_except("near", "items")))
    return rows.join(found, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.coalesce("items", none).alias("items"),
        F.coalesce(F.size("near"), F.lit(0)).cast("bigint").alias("n_near"), F.coalesce("near", none).alias("near"),
    )


def without_items(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", slop: int = 0) -> DataFrame:
    """The documents that hold no window of an item, also not within the slop, with all their columns.

    Only keys of the others are joined to them.
    """
    one = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    phrases = settle(phrases_of(items, size, item_col, item_text), "windows")
    index, _ = store_index(one, phrases, slop)
    found = settle(search(index, phrases, slop).select(F.col("key").alias("__key")).distinct(), "contaminated")
    keys = docs.withColumn("__key", row_key(F.col(id_col), F.col(text_col).cast("string")))
    return keys.join(found, "__key", "left_anti").drop("__key")


def digest(items: list[str]) -> str:
    """SHA-256 of item ids sorted as strings and joined by commas."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
