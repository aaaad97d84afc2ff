"""Fill-in-middle: texts are cut at two unit ends and put together anew, with 64-bit words of text at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.llm.common import bounded_batches

SEED, CHANGED, SUFFIX_FIRST = 1, 90, 20
#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: 64-bit words whose marks are made at once, so that a long text needs few copies of itself.
BLOCK = 1 << 16

_HIGH, _ONES = np.uint64(0x8080808080808080), np.uint64(0x0101010101010101)
_LOWER, _SEVEN = _ONES * np.uint64(0x20), _ONES * np.uint64(0x7F)
#: Added to seven bits, they carry into the eighth from "a" and from "{" on.
_FROM_A, _PAST_Z = _ONES * np.uint64(0x80 - 0x61), _ONES * np.uint64(0x80 - 0x7B)


def _after(marks: np.ndarray) -> np.ndarray:
    """Each byte's mark moved to the byte before it, for all words but the last."""
    return marks[:-1] >> np.uint64(8) | marks[1:] << np.uint64(56)


def byte_marks(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """High bits of the bytes that end a unit, and of those that begin a code point.

    ``words`` is UTF-8 as little-endian 64-bit words, the last one zero. A unit is a run of ASCII letters or one other
    code point: a byte ends it unless the next one continues its code point, or both are letters.
    """
    ends, begins = np.empty(len(words) - 1, np.uint64), np.empty(len(words) - 1, np.uint64)
    for at in range(0, len(ends), BLOCK):
        x = words[at:at + BLOCK + 1]
        folded = (x | _LOWER) & _SEVEN
        letters = (folded + _FROM_A) & ~(folded + _PAST_Z) & ~x & _HIGH
        inside = x & ~(x << np.uint64(1)) & _HIGH
        ends[at:at + BLOCK] = _HIGH & ~_after(inside) & ~(letters[:-1] & _after(letters))
        begins[at:at + BLOCK] = _HIGH & ~inside[:-1]
    return ends, begins


class MarkIndex:
    """Rank and select over byte marks: a popcount per word, summed up, and arithmetic inside a word."""

    def __init__(self, marks: np.ndarray):
        self.marks, self.before = marks, np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks in the bytes before each place."""
        word, rest = at >> 3, (at & 7).astype(np.uint64)
        inside = self.marks[word] & ((np.uint64(1) << (rest << np.uint64(3))) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)

    def select(self, number: np.ndarray) -> np.ndarray:
        """The place after each numbered mark, numbers from 1."""
        word = np.searchsorted(self.before, number, "left") - 1
        wanted = (number - self.before[word]).astype(np.uint64) * _ONES
        upto = (self.marks[word] >> np.uint64(7)) * _ONES  # each byte: marks up to and with it
        fewer = _HIGH & ~((upto | _HIGH) - wanted)
        return word * 8 + np.bitwise_count(fewer) + 1


def cuts(texts: Sequence[bytes], draws: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per text its units, where prefix and middle end in bytes, and the code points of prefix and middle.

    ``draws`` has two numbers per text; modulo units + 1 the smaller ends the prefix, the larger the middle.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    stop = np.cumsum(lengths)
    start = stop - lengths
    size = int(stop[-1]) if len(stop) else 0
    words = np.frombuffer(b"".join(texts) + bytes(16 - size % 8), "<u8")
    ends, begins = byte_marks(words)
    last = stop[lengths > 0] - 1  # the texts stand side by side: each one's last byte ends a unit
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << ((last & 7) << 3).astype(np.uint64))
    units, points = MarkIndex(ends), MarkIndex(begins)
    before = units.rank(start)
    n = units.rank(stop) - before
    chosen = np.sort(draws.astype(np.int64) % (n + 1)[:, None], axis=1)
    places = [np.where(k > 0, units.select(before + np.maximum(k, 1)), start) if size else start for k in chosen.T]
    first, second, third = (points.rank(p) for p in (start, *places))
    return n, places[0] - start, places[1] - start, second - first, third - second


def draws_of(ids: Sequence[str | None], seed: int = SEED) -> np.ndarray:
    """Four 32-bit numbers per id, of the SHA-256 of seed and id; a null id counts as the text "null"."""
    each = (hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(b"".join(each), ">u4").reshape(-1, 4)


def transform(docs: DataFrame, seed: int = SEED, changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST,
              marks: Sequence[str] = MARKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``form`` is plain (``output`` is the text), psm (prefix, suffix, middle, each after its mark) or spm (suffix, prefix,
    middle). ``changed`` percent of the ids are not plain, ``suffix_first`` percent of those are spm. Empty texts and
    texts that hold a mark are plain; plain rows have null lengths.

    Rows are independent: nothing is shuffled, and repeated rows give equal rows. Null texts count as empty, a null id
    draws as the text "null", an empty table gives an empty result, and other columns are left behind. All texts of
    an Arrow batch of bounded size are cut together; a very long text is a batch of its own, with memory of a few times its size.
    """
    bounded_batches(docs.sparkSession)
    head, tail, fill = (m.encode() for m in marks)
    out = pa.schema([("draw", pa.string()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                     ("middle_chars", pa.int64()), ("output", pa.binary())])

    def changed_texts(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            ids, texts = (c.to_pylist() for c in batch.columns)
            draws = draws_of(ids, seed)
            n, one, two, before, middle = cuts(texts, draws[:, :2])
            plain = np.array([not t or head in t or tail in t or fill in t for t in texts], bool) | (draws[:, 2] % 100 >= changed)
            late = draws[:, 3] % 100 < suffix_first
            form = np.where(plain, "plain", np.where(late, "spm", "psm"))
            outputs = []
            for text, kind, a, b in zip(texts, form.tolist(), one.tolist(), two.tolist(), strict=True):
                if kind == "psm":
                    text = b"".join((head, text[:a], tail, text[b:], fill, text[a:b]))
                elif kind == "spm":
                    text = b"".join((tail, text[b:], head, text[:a], fill, text[a:b]))
                outputs.append(text)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.string()), pa.array(n), pa.array(form.tolist(), pa.string()), pa.array(before, mask=plain),
                pa.array(middle, mask=plain), pa.array(outputs, pa.binary())], schema=out)

    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).cast("string").alias("draw"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    made = rows.mapInArrow(
        changed_texts, "draw string, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary")
    return made.select(F.col("draw").cast(kind).alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                       F.col("output").cast("string").alias("output"))


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text an output was made from. No mark stands in a text that is not plain, so the first of each kind is ours."""

    def split(text: Column, mark: str) -> tuple[Column, Column]:
        first = F.substring_index(text, mark, 1)
        return first, F.substring(text, F.length(first) + len(mark) + 1, F.length(text))

    head, tail, fill = marks
    prefix, rest = split(F.substring(output, F.lit(len(head) + 1), F.length(output)), tail)
    suffix, middle = split(rest, fill)
    psm = F.concat(prefix, middle, suffix)
    suffix, rest = split(F.substring(output, F.lit(len(tail) + 1), F.length(output)), head)
    prefix, middle = split(rest, fill)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)


def report(docs: DataFrame, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``transform`` with digests of the output and of the text rebuilt from it in place of the output."""
    made = transform(docs, seed, id_col=id_col, text_col=text_col)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
