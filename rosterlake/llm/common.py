"""What the text operators share: keyed documents, word splitting, bounded bitmaps, document order."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import sys
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterlake.llm.rolling import mixed

#: Bounds on one Arrow batch, so that a Python worker's memory does not depend on the documents' lengths.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20

_UPPER_KEPT = bytes(range(256))
_JOINERS = bytes(0x20 if c < 0x30 or 0x3A <= c <= 0x60 or 0x7B <= c < 0x80 else c for c in range(256))


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches of the Python operators by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    # plans that hold a rank table as a literal are not described in full
    spark.conf.set("spark.sql.maxPlanStringLength", "20000")


def trim() -> None:
    """Return what this process has freed to the system; a worker that cuts texts for hours else grows by pieces between what it keeps."""
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)


def give_back(spark: SparkSession) -> None:
    """Return what the driver no longer uses, and let Spark delete the shuffles and broadcasts of frames that are gone."""
    gc.collect()
    trim()
    spark._jvm.System.gc()


def row_key(id_col: Column, text_col: Column) -> Column:
    """16 bytes that stand for a document's id and text; repeated rows share it, and so share a result."""
    return F.unhex(F.md5(F.concat_ws("\x1f", F.coalesce(id_col.cast("string"), F.lit("null")),
                                     F.coalesce(text_col, F.lit("")))))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``key`` and ``text`` as UTF-8 bytes; a null text counts as empty. Other columns are left behind."""
    bounded_batches(docs.sparkSession)
    one = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return one.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"),
                      F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def by_batch(df: DataFrame, work: Callable[[dict[str, list]], Iterator[dict[str, list]]], schema: str) -> DataFrame:
    """Run ``work`` on each Arrow batch, given and returning columns as lists."""
    arrow = pa.schema([(f.name, _arrow_type(f.dataType)) for f in _parsed(schema)])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for out in work(batch.to_pydict()):
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, schema)


def _parsed(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text."""
    return text.split()


def plain_words(text: bytes) -> list[bytes]:
    """Words of ``0-9a-z`` and non-ASCII characters after lower-casing A-Z, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return plain_bytes(text).split()


def plain_bytes(text: bytes) -> bytes:
    """The text, byte for byte, with A-Z lower-cased and a space for each character that is in no such word."""
    return text.lower().translate(_JOINERS)


#: White space as tokenizers may see it, the word mark of sentence pieces included.
WHITE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009" \
        "\u200a\u2028\u2029\u202f\u205f\u3000\u2581"
_BETWEEN = re.compile(f"(?<=[^{WHITE}]) (?=[^{WHITE}])")


def spaced_parts(text: str) -> list[str]:
    """The text cut at every single space between two characters that are not white space.

    No pre-token of a byte-level or sentence-piece tokenizer reaches across such a place, though it may begin with the
    space. So the pieces of a text are those of its first part, followed by those of each further part with a
    space before it. Parts joined by spaces are the text; only the first one may begin with a space.
    """
    if any(c in text and (c + " " in text or " " + c in text) for c in WHITE):
        return _BETWEEN.split(text)
    parts = text.split(" ")
    if len(parts) > 1:  # a lone space at an end of the text has a neighbour on one side only
        if parts[-1] == "":
            parts[-2:] = [parts[-2] + " "]
        if len(parts) > 1 and parts[0] == "":
            parts[:2] = [" " + parts[1]]
    return parts


def marked(parts: list[str]) -> list[str]:
    """Parts as keys that tell a first part from the others: it gets a space, with which no other part begins."""
    return [" " + parts[0], *parts[1:]]


def chunk_of(key: str) -> str:
    """The stretch of text that a marked part stands for."""
    return key[1:] if key[:1] == " " else " " + key


#: Texts in which a single space is no place to cut: it stands at an end, or beside other white space.
_NOT_BETWEEN = f"[{WHITE}] | [{WHITE}]|\\A | \\z"


def cut_texts(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct marked parts of an array of texts (strings), the number of each part of all texts, and where each text's parts begin.

    The beginnings have the number of parts as a last one. Texts are cut as by ``spaced_parts``, most of them by Arrow.
    A first part is listed for each text. An empty text has an empty first part.
    """
    odd = pc.match_substring_regex(texts, _NOT_BETWEEN).to_numpy(zero_copy_only=False).astype(bool)
    cut = pc.split_pattern(texts, " ")
    if odd.any():
        at, others = np.flatnonzero(odd), np.flatnonzero(~odd)
        by_hand = pa.array([spaced_parts(t) for t in texts.take(pa.array(at)).to_pylist()], cut.type)
        cut = pa.concat_arrays([cut.take(pa.array(others)), by_hand]).take(pa.array(np.argsort(np.concatenate([others, at]))))
    begins = np.concatenate([[0], np.cumsum(cut.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    coded = cut.flatten().dictionary_encode()
    # by numpy, which makes strings several times faster than to_pylist
    parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    number, first = coded.indices.to_numpy().astype(np.int64), begins[:-1]
    parts += [" " + parts[i] for i in number[first].tolist()]
    number[first] = np.arange(len(parts) - len(first), len(parts))
    used = np.zeros(len(parts), bool)
    used[number] = True
    return list(compress(parts, used)), (np.cumsum(used) - 1)[number], begins


def as_strings(texts: pa.Array) -> pa.Array:
    """UTF-8 bytes as strings; what is no UTF-8 is replaced."""
    try:
        return texts.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())


def put_together(values: list[bytes], number: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the numbered values side by side, and where those of each text begin, given where its numbers do."""
    taken = pa.array(values, pa.large_binary()).take(pa.array(number))
    _, ends, data = taken.buffers()
    return np.frombuffer(data or b"", np.uint8), np.frombuffer(ends, np.int64)[:len(number) + 1][begins]


#: Places of a hash at which the three bits of a filter are read from it.
SHIFTS = (0, 19, 37)


#: Hashes a task puts into a filter at once.
HASHES_AT_ONCE = 1 << 16


def bitmap(spark: SparkSession, hashes: DataFrame, column: str, bits: int):
    """A broadcast Bloom filter of ``bits`` bits (a power of two, 2^27 at most) of the 64-bit hashes in ``column``.

    Each hash sets three bits. The filter's size is ``bits / 8`` bytes whatever the number of hashes: blocks of 32,768
    bits are built by Spark's bitmap aggregate, and the driver puts at most ``bits / 32768`` of them side by side. More
    hashes only make more bits set, so that it lets more rows through; it never loses one.
    """
    slots = F.array(*[F.shiftrightunsigned(F.col(column), n).bitwiseAND(F.lit(bits - 1)) for n in SHIFTS])
    blocks = (
        hashes.select(F.explode(slots).alias("s"))
        .groupBy((F.shiftright("s", 15)).alias("b"))
        .agg(F.expr("bitmap_construct_agg(s & 32767)").alias("m"))
        .collect()
    )
    whole = np.zeros(max(bits // 8, 4096), np.uint8)
    for b, m in blocks:
        whole[b * 4096:(b + 1) * 4096] = np.frombuffer(bytes(m), np.uint8)
    return spark.sparkContext.broadcast(whole)


def array_bitmap(spark: SparkSession, hashes: DataFrame, column: str, bits: int, twice: bool = False):
    """The filter that ``bitmap`` makes, of the hashes in a column of arrays; ``twice`` sets six bits for each.

    Six bits let fewer others through while it has ten bits a hash or more, three do if it is fuller. Each task fills one of its own, and only the blocks it touched are grouped, so that many hashes need not be sorted by
    block. Null arrays and hashes set no bits.
    """
    size, out = max(bits // 8, 4096), pa.schema([("b", pa.int32()), ("m", pa.binary())])

    def filled(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, waiting, count = np.zeros(size, np.uint8), [], 0
        for batch in found:
            each = batch.column(0).flatten().drop_null()
            waiting.append(each.to_numpy(zero_copy_only=False))
            count += len(each)
            if count >= HASHES_AT_ONCE:
                set_bits(whole, np.concatenate(waiting).view(np.uint64), bits, twice)
                waiting, count = [], 0
        if waiting:
            set_bits(whole, np.concatenate(waiting).view(np.uint64), bits, twice)
        blocks = whole.reshape(-1, 4096)
        touched = np.flatnonzero(blocks.any(axis=1))
        for at in range(0, len(touched), 256):
            some = touched[at:at + 256]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([blocks[b].tobytes() for b in some.tolist()], pa.binary())],
                                             schema=out)

    found = hashes.select(column).mapInArrow(filled, "b int, m binary").groupBy("b").agg(F.bitmap_or_agg("m").alias("m")).collect()
    whole = np.zeros(size, np.uint8)
    for b, m in found:
        whole[b * 4096:(b + 1) * 4096] = np.frombuffer(bytes(m), np.uint8)
    return spark.sparkContext.broadcast(whole)


def set_bits(whole: np.ndarray, hashes: np.ndarray, bits: int, twice: bool = False) -> None:
    """Set the three bits of each hash, or six."""
    if twice:
        set_bits(whole, mixed(hashes), bits)
    for n in SHIFTS:
        slot = hashes >> np.uint64(n) & np.uint64(bits - 1)
        place, bit = (slot >> np.uint64(3)).astype(np.int64), slot & np.uint64(7)
        for i in range(8):
            whole[place[bit == i]] |= np.uint8(1 << i)  # equal places get an equal value


def hits(whole: np.ndarray, hashes: np.ndarray, twice: bool = False) -> np.ndarray:
    """Places of the hashes that a filter (filled ``twice``) may hold; most fail at the first of their bits."""
    mask, at = np.uint64(len(whole) * 8 - 1), np.arange(len(hashes))
    for n in SHIFTS:
        slot = hashes[at] >> np.uint64(n) & mask
        at = at[(whole[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return at[hits(whole, mixed(hashes[at]))] if twice else at


def in_bitmap(whole: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the unsigned 64-bit hashes have all their bits set."""
    mask, hit = np.uint64(len(whole) * 8 - 1), np.ones(len(hashes), bool)
    for n in SHIFTS:
        s = (hashes >> np.uint64(n)) & mask
        hit &= (whole[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return hit


def id_tops(ids: DataFrame, parts: int) -> list[int]:
    """The greatest ids of at most ``parts`` ranges that cut the column ``doc_id`` into about equal shares, ascending.

    Ranges come from approximate quantiles, which are of doubles; their greatest ids are ids of the table, also where
    neighbouring ids are the same double. Null ids are in no range.
    """
    known = ids.filter("doc_id IS NOT NULL")
    shares = [i / parts for i in range(1, parts)]
    cuts = np.unique(known.approxQuantile("doc_id", shares, 0.1 / parts) if shares else []).astype(np.float64)

    @F.arrow_udf("int")
    def place(found: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for each in found:
            yield pa.array(np.searchsorted(cuts, each.to_numpy(zero_copy_only=False).astype(np.float64), "left"), pa.int32())

    tops = known.groupBy(place("doc_id").alias("p")).agg(F.max("doc_id").alias("top"))
    return sorted(r["top"] for r in tops.collect())
