"""Byte-level BPE: ranked merges folded by Spark's higher-order functions, and decoding from pieces."""

from __future__ import annotations

import base64
import functools
import gc
import hashlib
import json
from collections.abc import Callable, Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterlake.llm.common import as_strings, bounded_batches, chunk_of, cut_texts, give_back, keyed, put_together, trim
from rosterlake.llm.vocabulary import frequent, word_counts
from rosterlake.session import LARGE_ROWS, discard, held, run_folder, settle

#: Fields of a packed piece: rank of the pair it starts (or NO_PAIR), place of its first byte, its own id.
PAIR_BITS, PLACE_BITS, ID_BITS = 19, 24, 20
NO_PAIR = (1 << PAIR_BITS) - 1
#: Parts of texts whose ids a worker remembers, and the longest of them.
REMEMBERED, LONGEST = 150_000, 64
#: Words whose ids all tasks get; see ``frequent``.
HOT_WORDS = 1_000_000
#: Bytes and documents of text whose words are put together at once.
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 2000
#: Marks the number of a word that is still to be encoded among packed ids.
OPEN = 1 << 31


def load_ranks(rank_file: str) -> dict[bytes, int]:
    """Pieces and ranks of a rank file: a base64 piece and its rank per line."""
    with open(rank_file, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pair_table(ranks: dict[bytes, int]) -> tuple[list[int], tuple[int, int, int, int]]:
    """A table of ``left id, right id, id of both joined`` in which a pair stands in one of two slots.

    Returned with the factors of the two slot numbers. Every way to cut a piece into two pieces is a pair.
    """
    pairs = [(ranks[p[:i]], ranks[p[i:]], r) for p, r in ranks.items() for i in range(1, len(p)) if p[:i] in ranks and p[i:] in ranks]
    size = 1 << max(10, (9 * len(pairs) // 4).bit_length())
    for salt in range(32):
        f = (40503 + 2 * salt, 30011 + 14 * salt, 9973 + 6 * salt, 50411 + 10 * salt)
        slots: list = [None] * size
        for pair in pairs:
            at = (pair[0] * f[0] + pair[1] * f[1]) & (size - 1)
            for _ in range(200):
                pair, slots[at] = slots[at], pair
                if pair is None:
                    break
                one, two = (pair[0] * f[0] + pair[1] * f[1]) & (size - 1), (pair[0] * f[2] + pair[1] * f[3]) & (size - 1)
                at = two if at == one else one
            if pair is not None:
                break
        else:
            return [-1 if s is None else (s[0] << 2 * ID_BITS) | (s[1] << ID_BITS) | s[2] for s in slots], f
    raise ValueError("no collision-free pair table was found")


class ByteBpe:
    """Spark expressions that encode words by a rank table and decode ids.

    The rank map is a literal: a table of pairs of piece ids, and a map of the words that are a piece but do not
    merge to it. A word's state is one array with a number per piece, which holds the rank of the pair the piece starts, its place and
    its id, so that the array's minimum is the leftmost pair of the lowest rank. As the id of a piece is its
    rank, that rank is also the merged piece's id.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte needs a rank")
        if max(ranks.values()) >= NO_PAIR:
            raise ValueError(f"ranks must be below {NO_PAIR}")
        table, self._factors = pair_table(ranks)
        self._mask = len(table) - 1
        self._table = F.from_json(F.lit(json.dumps(table)), "array<bigint>")
        self._bytes = F.from_json(F.lit(json.dumps([ranks[bytes([b])] for b in range(256)])), "array<bigint>")
        # words that are a piece but do not merge to it: few, or none
        self._whole = {p.decode("latin-1"): r for p, r in ranks.items() if len(p) > 1 and merged_ids(p, ranks) != [r]}

    def _pair(self, table: Column, a: Column, b: Column) -> Column:
        """Rank of the piece that two pieces make, or ``NO_PAIR``."""
        f, key = self._factors, F.shiftleft(a, ID_BITS) + b
        one = F.get(table, (a * f[0] + b * f[1]).bitwiseAND(self._mask).cast("int"))
        two = F.get(table, (a * f[2] + b * f[3]).bitwiseAND(self._mask).cast("int"))
        low = (1 << ID_BITS) - 1
        return (F.when(F.shiftright(one, ID_BITS) == key, one.bitwiseAND(low))
                .when(F.shiftright(two, ID_BITS) == key, two.bitwiseAND(low)).otherwise(F.lit(NO_PAIR)))

    def _folded(self, table: Column, word: Column) -> Column:
        """Ids of a word: as long as a neighbouring pair has a rank, the leftmost of the lowest rank merges."""
        low, place = (1 << ID_BITS) - 1, ((1 << PLACE_BITS) - 1) << ID_BITS
        top = PLACE_BITS + ID_BITS

        def own(x: Column) -> Column:
            return x.bitwiseAND(low)

        def packed(pair: Column, rest: Column) -> Column:
            return F.shiftleft(pair.cast("bigint"), top) + rest

        def merged(s: Column, least: Column, at: Column) -> Column:
            made = F.shiftright(least, top)
            after, before = F.get(s, at + 1), F.get(s, at - 2)
            here = F.when(after.isNull(), F.lit(NO_PAIR)).otherwise(self._pair(table, made, own(after)))
            here = F.array(packed(here, least.bitwiseAND(place) + made))
            left = F.array(packed(self._pair(table, own(before), made), before.bitwiseAND(place + low)))
            rest = F.slice(s, at + 2, F.size(s))
            return F.when(at == 1, F.concat(here, rest)).otherwise(F.concat(F.slice(s, 1, at - 2), left, here, rest))

        def step(s: Column, _: Column) -> Column:
            return let(F.array_min(s), lambda least: F.when(F.shiftright(least, top) == NO_PAIR, s).otherwise(
                let(F.array_position(s, least).cast("int"), lambda at: merged(s, least, at))))

        def start(ids: Column) -> Column:
            def first(a: Column, i: Column) -> Column:
                b = F.get(ids, i + 1)
                pair = F.when(b.isNull(), F.lit(NO_PAIR)).otherwise(self._pair(table, a, b))
                return packed(pair, F.shiftleft(i.cast("bigint"), ID_BITS) + a)

            return F.transform(ids, first)

        # a byte is a character of ISO 8859-1 here
        chars = F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), "")
        ids = let(self._bytes, lambda known: F.transform(chars, lambda c: F.get(known, F.ascii(c))))
        rounds = F.sequence(F.lit(2), F.octet_length(word))
        return F.aggregate(rounds, let(ids, start), step, lambda s: F.transform(s, lambda x: own(x).cast("int")))

    def encode(self, words: Column) -> Column:
        """Ids of each word (match of the pre-token pattern) of an array of words that are not empty."""

        def coded(table: Column, word: Column) -> Column:
            one = let(self._bytes, lambda k: F.array(F.get(k, F.ascii(word)).cast("int")))
            ids = F.when(F.octet_length(word) < 2, one).otherwise(self._folded(table, word))
            if not self._whole:
                return ids
            known = F.create_map(*[F.lit(x) for pair in self._whole.items() for x in pair])
            whole = F.try_element_at(known, F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"))
            return let(whole, lambda w: F.when(w.isNotNull(), F.array(w)).otherwise(ids))

        return let(self._table, lambda table: F.transform(words, lambda word: coded(table, word)))


def merged_ids(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word by plain merging; used on the pieces themselves, when the rank map is made."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        pairs = [ranks.get(a + b, NO_PAIR) for a, b in zip(parts, parts[1:], strict=False)]
        least = min(pairs)
        if least == NO_PAIR:
            break
        at = pairs.index(least)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def pieces_by_id(ranks: dict[bytes, int]) -> list[bytes]:
    """The binary piece of each id."""
    out = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        out[rank] = piece
    return out


def little(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.array(ids, "<u4").tobytes()


def whole(column: pa.ChunkedArray) -> pa.Array:
    """A column as one array."""
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


class HotWords:
    """The frequent words and their ids, found by hash: columns sorted by hash, so that a worker holds no dictionary."""

    def __init__(self, found: DataFrame):
        table = found.select(F.xxhash64("word").alias("h"), "word", "ids").toArrow().combine_chunks()
        hashes = table.column("h").to_numpy()
        self.order = np.argsort(hashes, kind="stable").astype(np.int32)
        self.hashes = hashes[self.order]
        self.words, self.ids = (whole(table.column(c)) for c in ("word", "ids"))
        #: Ids of parts of texts that a worker has met and that hold only words of the table.
        self.parts: dict[str, bytes] = {}
        self.last: set[str] = set()

    def codes(self, words: list[str]) -> tuple[dict[str, bytes], list[str]]:
        """Packed ids of words that are here, and numbers, marked open, of the others, which are listed."""
        hit, at = np.zeros(len(words), bool), np.zeros(len(words), np.int64)
        if len(self.hashes) and words:
            asked = np.array([xxhash.xxh64_intdigest(w.encode(), 42) for w in words], np.uint64).view(np.int64)
            found = np.minimum(np.searchsorted(self.hashes, asked), len(self.hashes) - 1)
            at = self.order[found]
            same = pc.equal(self.words.take(pa.array(at)), pa.array(words, pa.string())).to_numpy(zero_copy_only=False)
            hit = (self.hashes[found] == asked) & same.astype(bool)
        codes = dict(zip(compress(words, hit), all_little(self.ids.take(pa.array(at[hit]))), strict=True)) if hit.any() else {}
        rare = list(compress(words, ~hit))
        numbers = (np.arange(len(rare), dtype="<u4") | np.uint32(OPEN)).tobytes()
        codes.update((w, numbers[4 * i:4 * i + 4]) for i, w in enumerate(rare))
        return codes, rare

    def parts_of(self, keys: list[str], split: Callable[[str], list[str]]) -> tuple[list[bytes], list[str]]:
        """Packed ids of each part of texts, with open numbers for the words that are listed."""
        known = self.parts
        made = list(map(known.get, keys))
        fresh = [i for i, ids in enumerate(made) if ids is None]
        words = [split(keys[i]) for i in fresh]
        codes, rare = self.codes(list(set(chain.from_iterable(words))))
        for i, parts in zip(fresh, words, strict=True):
            made[i] = codes[parts[0]] if len(parts) == 1 else b"".join([codes[w] for w in parts])
        asked = {keys[i] for i in fresh}
        if len(known) < REMEMBERED:  # what two blocks in a row hold is worth remembering
            again = asked & self.last
            for i, parts in zip(fresh, words, strict=True):
                key = keys[i]
                if key in again and len(key) <= LONGEST and not any(codes[w][3] & 128 for w in parts):
                    known[key] = made[i]
        self.last = asked
        return made, rare


def all_little(lists: pa.ListArray) -> list[bytes]:
    """Each list of ids as little-endian unsigned 32-bit integers."""
    flat = lists.flatten().to_numpy().astype("<u4").tobytes()
    ends = ((lists.offsets.to_numpy() - lists.offsets[0].as_py()) * 4).tolist()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


# Fixed value: the pre-token pattern of public byte-level tokenizers.
COMMON_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.cache
def pretokens_of(pattern: str) -> Callable[[str], list[str]]:
    """All matches of a pre-token pattern in the stretch of a marked part; compiled once in each worker."""
    matches = regex.compile(pattern).findall
    if pattern != COMMON_PATTERN:
        return lambda key: matches(chunk_of(key))

    def split(key: str) -> list[str]:
        # most parts are letters, with one mark of punctuation or none: two alternatives of the pattern
        if key.isalpha():
            return [" " + key]
        if key[-1] in ".,;:!?" and key[:-1].isalpha():
            return [" " + key[:-1], key[-1]]
        return matches(chunk_of(key))

    return split


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every document.

    The distinct words (matches of the pattern) of the corpus are counted. Spark expressions encode the
    frequent ones, a table of bounded size that all tasks get, and then, for each block of documents, the distinct
    words that it has besides. So texts are never shuffled, no word is a hot key, and a block
    needs no more than its own words. Coded blocks are written to the shared folder before ids are put together. Ids are put together per document and decoded by joining their binary
    pieces. One word takes time in proportion to the square of its length. Null texts count as empty (no tokens, digests
    of no bytes); repeated rows repeat; an empty table gives an empty result; other columns are left behind.
    """
    spark = docs.sparkSession
    give_back(spark)
    bpe = ByteBpe(ranks)
    counts = settle(word_counts(docs, functools.partial(pretokens_of, pattern), id_col, text_col), "words")
    texts = keyed(docs, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # tasks hold the table of words too, and so get smaller batches
    bounded_batches(spark, BLOCK_ROWS, BLOCK_BYTES)
    words = frequent(counts, HOT_WORDS).select("word").repartition(busy_partitions(spark))
    hot = spark.sparkContext.broadcast(HotWords(words.select("word", bpe.encode(F.array("word"))[0].alias("ids"))))
    give_back(spark)
    block = pa.schema([("doc_id", pa.list_(pa.int64())), ("coded", pa.list_(pa.binary())), ("words", pa.list_(pa.string()))])

    def blocks(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = pretokens_of(pattern)
        gc.disable()  # a block's many short lists hold no cycles
        try:
            for batch in found:
                for some in few(batch):
                    keys, number, begins = cut_texts(as_strings(some.column("text")))
                    made, rare = hot.value.parts_of(keys, split)
                    coded, ends = put_together(made, number, begins)
                    n = some.num_rows
                    each = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(coded)])
                    yield pa.RecordBatch.from_arrays([
                        pa.ListArray.from_arrays([0, n], some.column("doc_id")), pa.ListArray.from_arrays([0, n], each),
                        pa.array([rare], block.field(2).type),
                    ], schema=block)
                    del keys, number, begins, made, rare, coded, ends, each
                    trim()
        finally:
            gc.enable()

    pieces = spark.sparkContext.broadcast(pieces_by_id(ranks))
    final = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                       ("decoded_sha256", pa.string())])

    def assembled(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pa.array(pieces.value, pa.large_binary())
        for batch in found:
            for i in range(batch.num_rows):
                coded, codes = batch.column("coded")[i].values, batch.column("codes")[i].values
                begins = np.concatenate([[0], np.cumsum(pc.binary_length(coded).to_numpy(zero_copy_only=False))]).astype(np.int64) // 4
                ids = np.frombuffer(b"".join(coded.to_pylist()), "<u4")
                ids, begins = filled(ids, begins, codes.value_lengths().to_numpy(zero_copy_only=False), codes.flatten().to_numpy())
                _, ends, decoded = piece.take(pa.array(ids)).buffers()
                decoded = memoryview(decoded or b"")
                ends = np.frombuffer(ends, np.int64)[:len(ids) + 1][begins].tolist()
                bounds = begins.tolist()
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[i].values, pa.array(np.diff(begins), pa.int64()),
                    pa.array([hashlib.sha256(ids[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.string()),
                    pa.array([hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string()),
                ], schema=final)
                del coded, codes, begins, ids, ends, decoded, bounds
                trim()

    cut = texts.mapInArrow(blocks, "doc_id array<bigint>, coded array<binary>, words array<string>")
    each = cut.select("doc_id", "coded", bpe.encode(F.col("words")).alias("codes"))
    # written, so that the tasks that cut texts and those that put ids together do not hold their workers at once
    path = run_folder(spark, "coded")
    each.write.options(compression="zstd", **LARGE_ROWS).parquet(path)
    hot.destroy()
    coded = spark.read.schema(each.schema).parquet(path)
    done = coded.mapInArrow(assembled, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    # a row is a block, and Spark would read 4,096 rows at once
    with held(spark, {"spark.sql.parquet.columnarReaderBatchSize": "1"}):
        done = settle(done, "encoded")
    pieces.destroy()
    discard(spark, path)
    bounded_batches(spark)
    return done


def filled(coded: np.ndarray, begins: np.ndarray, length: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids with the numbers of open words replaced by the words' ids, which are so many each, and where texts begin then."""
    is_open = coded >= OPEN
    at = np.flatnonzero(is_open)
    if not len(at):
        return coded, begins
    word = (coded[at] - np.uint32(OPEN)).astype(np.int64)
    each, first = length[word].astype(np.int64), (np.cumsum(length) - length)[word]
    size = np.ones(len(coded), np.int64)
    size[at] = each
    place = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(place[-1], "<u4")
    out[place[:-1][~is_open]] = coded[~is_open]
    step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    out[np.repeat(place[at], each) + step] = codes[np.repeat(first, each) + step]
    return out, place[begins]


def few(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Documents in blocks of about ``BLOCK_BYTES`` of text; a longer text is a block of its own."""
    upto = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)])
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(upto, upto[begin] + BLOCK_BYTES, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def busy_partitions(spark: SparkSession) -> int:
    """Partitions for long work on a table of bounded size."""
    return max(4 * spark.sparkContext.defaultParallelism, 8)
