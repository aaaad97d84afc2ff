"""Token ids in files of independent zstandard frames with a trailing seek table, as a Spark data source."""

from __future__ import annotations

import functools
import gc
import json
import os
import struct
import sys
import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from rosterlake.llm.byte_bpe import COMMON_PATTERN, few, pretokens_of
from rosterlake.llm.common import as_strings, chunk_of, cut_texts, id_tops, keyed, put_together
from rosterlake.llm.vocabulary import HOT_BYTES

#: Ids after which a frame is closed, and the level of compression.
FRAME_IDS, LEVEL = 1 << 16, 1
#: Parts of texts whose ids a worker remembers: the ones met lately, and as many met before them, which stay if met often.
LATELY = 150_000
#: Pre-tokens whose ids a worker remembers.
WORDS = 150_000

# The public seekable format of zstandard, and a skippable frame for the directory of documents.
SKIPPABLE, DIRECTORY, SEEKABLE = 0x184D2A5E, 0x184D2A5D, 0x8F92EAB1
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
DOCUMENT = np.dtype([("doc_id", "<i8"), ("frame", "<u4"), ("named", "u1"), ("begin", "<u4"), ("ids", "<u4")])
INDEX = "_index.json"


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or a local path."""
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))


class FrameFile:
    """Writes one file: frames of whole documents, then the directory, then the seek table."""

    def __init__(self, stream):
        self.stream, self.frames, self.documents, self.open, self.n_open = stream, [], [], [], 0
        self.squeeze = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        if self.open and self.n_open + n > FRAME_IDS:
            self.close_frame()
        self.documents.append((doc_id or 0, len(self.frames), doc_id is not None, self.n_open, n))
        self.open.append(ids)
        self.n_open += n

    def close_frame(self) -> None:
        plain = b"".join(self.open)
        packed = self.squeeze.compress(plain)
        self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.stream.write(packed)
        self.open, self.n_open = [], 0

    def close(self) -> None:
        if self.open:
            self.close_frame()
        listed = zstandard.ZstdCompressor(level=LEVEL).compress(np.array(self.documents, DOCUMENT).tobytes())
        self.stream.write(struct.pack("<II", DIRECTORY, len(listed)) + listed)
        table = np.array(self.frames, ENTRY).tobytes() + struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


def read_file(stream, size: int, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
    """Document id, ids before it in the file, and its ids; only frames that hold a wanted document are decompressed."""

    def at(begin: int, n: int) -> bytes:
        stream.seek(begin)
        return stream.read(n)

    count, flags, magic = struct.unpack("<IBI", at(size - 9, 9))
    if magic != SEEKABLE or not flags & 0x80:
        raise ValueError("no seek table with checksums at the end of the file")
    table = size - 9 - count * ENTRY.itemsize
    frames = np.frombuffer(at(table, count * ENTRY.itemsize), ENTRY)
    places = np.concatenate([[0], np.cumsum(frames["packed"].astype(np.int64))])
    mark, length = struct.unpack("<II", at(int(places[-1]), 8))
    if mark != DIRECTORY:
        raise ValueError("no directory of documents after the frames")
    listed = np.frombuffer(zstandard.ZstdDecompressor().decompress(at(int(places[-1]) + 8, length)), DOCUMENT)
    before = np.concatenate([[0], np.cumsum(listed["ids"].astype(np.int64))])
    frame, plain = -1, b""
    for i, (doc_id, number, named, begin, n) in enumerate(listed.tolist()):
        if wanted is not None and not (named and doc_id in wanted):
            continue
        if number != frame:
            packed, length, check = frames[number].tolist()
            plain = zstandard.ZstdDecompressor().decompress(at(int(places[number]), packed), max_output_size=length)
            if len(plain) != length or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {number} is damaged")
            frame = number
        yield doc_id if named else None, int(before[i]), plain[begin * 4:(begin + n) * 4]


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote."""

    partition: int
    name: str | None
    documents: int
    ids: int


class TokenWriter(DataSourceArrowWriter):
    """One file per partition; a file counts only if the driver lists it in the index when all tasks have ended.

    So a task that is run twice leaves at most a file that nothing names, and the index, renamed into its place,
    is there whole or not at all.
    """

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        number, out, n_docs, n_ids, name = TaskContext.get().partitionId(), None, 0, 0, None
        fs, folder = opened(self.path)
        stream = None
        try:
            for batch in iterator:
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                    if out is None:
                        fs.create_dir(folder, recursive=True)
                        name = f"part-{number:05d}-{uuid.uuid4().hex}.zst"
                        stream = fs.open_output_stream(f"{folder}/{name}", compression=None)
                        out = FrameFile(stream)
                    out.add(doc_id, ids)
                    n_docs, n_ids = n_docs + 1, n_ids + len(ids) // 4
            if out:
                out.close()
        finally:
            if stream:
                stream.close()
        return Written(number, name, n_docs, n_ids)

    def commit(self, messages: list[Written]) -> None:
        fs, folder = opened(self.path)
        fs.create_dir(folder, recursive=True)
        files, start = [], 0
        for m in sorted((m for m in messages if m and m.name), key=lambda m: m.partition):
            files.append({"name": m.name, "start": start, "ids": m.ids, "documents": m.documents})
            start += m.ids
        with fs.open_output_stream(f"{folder}/{INDEX}.new") as stream:
            stream.write(json.dumps(files).encode())
        fs.move(f"{folder}/{INDEX}.new", f"{folder}/{INDEX}")

    def abort(self, messages: list[Written]) -> None:
        """Files that no index names are never read."""


@dataclass
class TokenPart(InputPartition):
    """One file and the ids in the files before it."""

    name: str
    start: int


class TokenReader(DataSourceReader):
    def __init__(self, path: str, wanted: set[int] | None):
        self.path, self.wanted = path, wanted

    def partitions(self) -> list[TokenPart]:
        fs, folder = opened(self.path)
        with fs.open_input_stream(f"{folder}/{INDEX}") as stream:
            return [TokenPart(f["name"], f["start"]) for f in json.loads(stream.read())] or [TokenPart("", 0)]

    def read(self, partition: TokenPart) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        fs, folder = opened(self.path)
        path = f"{folder}/{partition.name}"
        rows, held = [], 0
        with fs.open_input_file(path) as stream:
            for doc_id, before, ids in read_file(stream, stream.size(), self.wanted):
                rows.append((doc_id, partition.start + before, len(ids) // 4, ids))
                held += len(ids)
                if held > 8 << 20:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)


COLUMNS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), COLUMNS, strict=True)], schema=COLUMNS)


class TokenFiles(DataSource):
    """``spark.read.format("token_files")``: ``doc_id``, ``start``, ``n_tokens``, ``ids`` (little-endian 32-bit).

    The option ``doc_ids``, numbers joined by commas, picks documents.
    """

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return "doc_id bigint, start bigint, n_tokens bigint, ids binary"

    def reader(self, schema) -> TokenReader:
        picked = self.options.get("doc_ids")
        return TokenReader(self.options["path"], {int(x) for x in picked.split(",")} if picked else None)

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        return TokenWriter(self.options["path"])


def byte_chars() -> dict[int, int]:
    """The character that byte-level tokenizers show each byte as: itself if it is printable, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(others)}


BYTE_CHARS = byte_chars()
SPACE = chr(BYTE_CHARS[0x20])


class Encoder:
    """Ids of whole texts by a tokenizers file; what a worker remembers of their parts is not encoded again."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Ids as bytes of this type.
        self.kind = "<u4" if self.tokenizer.get_vocab_size() > 1 << 16 else "<u2"
        self.code = "I" if self.kind == "<u4" else "H"
        self.lately: dict[str, bytes] = {}
        self.often: dict[str, bytes] = {}
        own = json.loads(self.tokenizer.to_str())
        step = own["pre_tokenizer"] or {}
        #: Whether the library only cuts a text by the common pattern and maps its bytes before the merges.
        self.byte_level = (own["normalizer"] is None and step.get("type") == "ByteLevel" and step.get("use_regex")
                           and not step.get("add_prefix_space"))
        self.words: dict[str, bytes] = {}

    def direct(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def word(self, word: str) -> bytes:
        """Ids of one pre-token by the library's merges."""
        ids = self.words.get(word)
        if ids is None:
            if word.isalpha() and word.isascii():
                mapped = word
            elif word[0] == " " and word[1:].isalpha() and word.isascii():
                mapped = SPACE + word[1:]
            else:
                mapped = word.encode().decode("latin-1").translate(BYTE_CHARS)
            made = array(self.code, [t.id for t in self.tokenizer.model.tokenize(mapped)])
            if sys.byteorder == "big":
                made.byteswap()
            ids = made.tobytes()
            if len(self.words) >= WORDS:
                self.words.clear()
            if len(word) <= HOT_BYTES:
                self.words[word] = ids
        return ids

    def parts(self, keys: list[str]) -> list[bytes]:
        """Ids of marked parts: by their pre-tokens if the tokenizer is of the byte-level kind, else by the whole library."""
        if not self.byte_level:
            return self.direct([chunk_of(k) for k in keys])
        split, word = pretokens_of(COMMON_PATTERN), self.word
        return [b"".join([word(w) for w in split(key)]) for key in keys]

    def known(self, keys: list[str]) -> list[bytes]:
        """Ids of distinct marked parts, from those that were met lately if they are there."""
        made = list(map(self.lately.get, keys))
        new: dict[str, bytes] = {}
        missing = [i for i, ids in enumerate(made) if ids is None]
        older = list(map(self.often.get, map(keys.__getitem__, missing)))
        fresh = [i for i, ids in zip(missing, older, strict=True) if ids is None]
        for i, ids in zip(missing, older, strict=True):
            if ids is not None:
                made[i] = new[keys[i]] = ids
        for i, ids in zip(fresh, self.parts([keys[i] for i in fresh]), strict=True):
            made[i] = ids
            if len(keys[i]) <= HOT_BYTES:
                new[keys[i]] = ids
        if len(self.lately) + len(new) > LATELY:
            # what is used is met again soon, and then counts as lately met
            self.often, self.lately = self.lately, {}
        self.lately.update(new)
        return made

    def ids(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of each text, as ``kind``; texts that hold an added token's string go to the library whole."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        held = [pc.match_substring(texts, s).to_numpy(zero_copy_only=False).astype(bool) for s in self.special]
        whole = np.flatnonzero(np.logical_or.reduce(held)) if held else np.empty(0, np.int64)
        plain = np.setdiff1d(np.arange(len(texts)), whole)
        keys, number, begins = cut_texts(texts.take(pa.array(plain)) if len(whole) else texts)
        data, ends = put_together(self.known(keys), number, begins)
        data, ends = memoryview(data), ends.tolist()
        out = [b""] * len(texts)
        for i, a, b in zip(plain.tolist(), ends[:-1], ends[1:], strict=True):
            out[i] = bytes(data[a:b])
        for i, ids in zip(whole.tolist(), self.direct(texts.take(pa.array(whole)).to_pylist()) if len(whole) else [], strict=True):
            out[i] = ids
        return out


@functools.cache
def encoder(file: str) -> Encoder:
    """One for each worker process, which keeps it from task to task."""
    return Encoder(file)


def write_tokens(docs: DataFrame, tokenizer_file: str, path: str, end_id: int = 2, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Encode whole texts, end each with ``end_id``, and write the ids to ``path`` in ascending document order.

    Only ids are shuffled, as 16-bit numbers if the vocabulary allows it. Ranges of document ids, cut at ids of
    the table, become partitions, so files follow each other in order and each task writes one file as it reads
    its sorted rows. Null texts have the end id alone; null ids come first; rows with equal ids follow each other by
    their ids' bytes; an empty table gives an index without files; other columns are left behind.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = keyed(docs, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    cuts = np.array(id_tops(docs.select(F.col(id_col).cast("bigint").alias("doc_id")), parts)[:-1], np.int64)
    kind = encoder(tokenizer_file).kind
    end = np.array([end_id], kind).tobytes()
    schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("ids", pa.binary())])

    def encoded(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_file)
        gc.disable()  # many short lists without cycles
        try:
            for batch in found:
                for some in few(batch):
                    packed = [x + end for x in encode.ids(as_strings(some.column("text")))]
                    docs = some.column("doc_id")
                    # a null id is in the first range
                    known = docs.fill_null(int(cuts[0]) if len(cuts) else 0).to_numpy()
                    ranges = np.searchsorted(cuts, known, "left").astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(ranges), docs, pa.array(packed, pa.binary())], schema=schema)
        finally:
            gc.enable()

    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def widened(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            ids = [np.frombuffer(x, kind).astype("<u4").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], schema=out)

    rows = texts.mapInArrow(encoded, "part int, doc_id bigint, ids binary")
    rows = rows.repartitionById(len(cuts) + 1, "part").sortWithinPartitions("doc_id", "ids").select("doc_id", "ids")
    spark.dataSource.register(TokenFiles)
    rows.mapInArrow(widened, "doc_id bigint, ids binary").write.format("token_files").mode("append").option("path", path).save()


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The documents of written token files, or those with the given ids."""
    spark.dataSource.register(TokenFiles)
    reader = spark.read.format("token_files").option("path", path)
    if doc_ids is not None:
        reader = reader.option("doc_ids", ",".join(map(str, doc_ids)))
    return reader.load()
