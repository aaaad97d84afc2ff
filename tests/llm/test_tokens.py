import hashlib
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.dataset as ds
import pytest
import sentencepiece
import tiktoken
from hypothesis import given as cases, settings, strategies as st
from tokenizers import Tokenizer

from rosterlake.llm import byte_bpe, common, token_counts, token_files, vocabulary
from rosterlake.session import LARGE_ROWS, discard, run_folder, settle

MODEL, JSON = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference_bpe(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def small_tables(monkeypatch):
    """Leave most words out of the table of frequent ones, so that the other way is taken too."""
    for module in (token_counts, byte_bpe):
        monkeypatch.setattr(module, "frequent", lambda counts, _=0: vocabulary.frequent(counts, 100))


@settings(max_examples=300, deadline=None)
@cases(st.text(alphabet=" a\n\t▁é.'  x", max_size=14))
def test_parts_make_up_the_text(text):
    parts = common.spaced_parts(text)
    assert " ".join(parts) == text == "".join(map(common.chunk_of, common.marked(parts)))
    assert all(a[-1] not in common.WHITE and b[0] not in common.WHITE for a, b in zip(parts, parts[1:], strict=False))


@settings(max_examples=300, deadline=None)
@cases(st.lists(st.text(alphabet=" a\n\t▁é.'  x", max_size=14), max_size=5))
def test_texts_are_cut_together(texts):
    """Each distinct part of a block is listed once, beside the first parts; parts by number are those of each text."""
    keys, number, begins = common.cut_texts(pa.array(texts, pa.string()))
    bounds = list(zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True))
    assert [[keys[i] for i in number[a:b].tolist()] for a, b in bounds] == [common.marked(common.spaced_parts(t)) for t in texts]
    others = [k for k in keys if k[:1] != " "]
    assert len(others) == len(set(others)) and "" not in keys
    joined, ends = common.put_together([k.encode() for k in keys], number, begins)
    assert [joined[a:b].tobytes().decode() for a, b in zip(ends[:-1], ends[1:], strict=True)] == ["".join(common.marked(common.spaced_parts(t))) for t in texts]


def test_invalid_bytes_are_replaced():
    assert common.as_strings(pa.array([b"a \xff b", b"ok"])).to_pylist() == ["a \ufffd b", "ok"]


def test_words_of_a_block_are_looked_up_once(ranks, monkeypatch):
    """A block's repeated parts cost no look-up each: what is split and counted are its distinct parts."""
    asked = []
    split = byte_bpe.pretokens_of(byte_bpe.COMMON_PATTERN)
    keys, number, begins = common.cut_texts(pa.array(["same words again and again " * 500 + "end"] * 3))
    hot = object.__new__(byte_bpe.HotWords)
    hot.hashes, hot.parts, hot.last = np.empty(0, np.int64), {}, set()
    made, rare = hot.parts_of(keys, lambda key: asked.append(key) or split(key))
    assert len(asked) == len(keys) <= 8 and set(rare) == {"same", " same", " words", " again", " and", " end"}
    coded, ends = common.put_together(made, number, begins)
    coded = np.frombuffer(coded.tobytes(), "<u4")
    codes = [byte_bpe.merged_ids(w.encode(), ranks) for w in rare]
    ids, bounds = byte_bpe.filled(coded, ends // 4, np.array([len(c) for c in codes]), np.array(sum(codes, [])))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = own.encode_ordinary("same words again and again " * 500 + "end")
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [wanted] * 3


def test_remembered_parts_are_encoded_once(monkeypatch):
    """Parts met again are not encoded again, also when those met lately were put aside in between."""
    monkeypatch.setattr(token_files, "LATELY", 4)
    encoder, asked = token_files.Encoder(JSON), []
    parts = encoder.parts
    monkeypatch.setattr(encoder, "parts", lambda keys: asked.append(keys) or parts(keys))
    first = encoder.ids(["one two three"])
    assert encoder.ids(["four five six"]) and encoder.ids(["one two three"]) == first
    assert [len(a) for a in asked] == [3, 3, 0]


@settings(max_examples=500, deadline=None)
@cases(st.text(alphabet="ab é1٣.,!'-\n ªǅ中 s", max_size=8))
def test_short_cut_is_the_pattern(text):
    import regex
    assert public_tokenizers.PATTERN == byte_bpe.COMMON_PATTERN
    for key in common.marked([text, text or "x"]):
        wanted = regex.findall(byte_bpe.COMMON_PATTERN, common.chunk_of(key))
        assert byte_bpe.pretokens_of(byte_bpe.COMMON_PATTERN)(key) == wanted


@pytest.mark.parametrize("hot", [True, False])
def test_piece_counts(given, odd, odd_rows, none, by_row, monkeypatch, hot):
    if not hot:
        small_tables(monkeypatch)
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)

    def wanted(rows):
        each = [(i, t or "") for i, t in rows]
        return sorted(((i, len(t.encode()), n := len(model.encode(t)), n > 4096) for i, t in each), key=repr)

    columns = ("doc_id", "n_bytes", "n_tokens", "over_limit")
    docs, texts = given
    assert by_row(token_counts.count_tokens(docs, MODEL), *columns) == wanted(texts.items())
    assert by_row(token_counts.count_tokens(odd, MODEL), *columns) == wanted(odd_rows)
    assert token_counts.count_tokens(none, MODEL).count() == 0


@pytest.mark.parametrize("hot", [True, False])
def test_byte_bpe(given, odd, odd_rows, none, by_row, ranks, reference_bpe, monkeypatch, hot):
    if not hot:
        small_tables(monkeypatch)

    def wanted(rows):
        out = []
        for i, t in rows:
            ids = reference_bpe.encode_ordinary(t or "")
            packed = struct.pack(f"<{len(ids)}I", *ids)
            out.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
        return sorted(out, key=repr)

    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    docs, texts = given
    pattern = public_tokenizers.PATTERN
    assert by_row(byte_bpe.encode_documents(docs, ranks, pattern), *columns) == wanted(texts.items())
    assert by_row(byte_bpe.encode_documents(odd, ranks, pattern), *columns) == wanted(odd_rows)
    assert byte_bpe.encode_documents(none, ranks, pattern).count() == 0


def test_coded_blocks_are_held_one_at_a_time(spark, ranks, monkeypatch):
    """A writer ends pages and row groups after a block, not after a hundred, and the reader takes one block, not all of a file."""
    size, groups, rows = "spark.sql.parquet.columnarReaderBatchSize", [], {}
    monkeypatch.setitem(LARGE_ROWS, "parquet.block.size", "1")
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 1000)

    def kept(session, path):
        for file in ds.dataset(path.removeprefix("file:")).get_fragments():
            groups.extend(g.num_rows for g in file.row_groups)
        discard(session, path)

    def written(df, label, by=()):
        rows[label] = spark.conf.get(size)
        return settle(df, label, by)

    monkeypatch.setattr(byte_bpe, "discard", kept)
    monkeypatch.setattr(byte_bpe, "settle", written)
    docs = spark.createDataFrame([(i, f"word{i} and others " * 60) for i in range(12)], "doc_id bigint, text string").coalesce(1)
    usual = spark.conf.get(size)
    assert byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN).count() == 12
    assert groups == [1] * 12
    assert rows == {"words": usual, "encoded": "1"} and spark.conf.get(size) == usual


def test_merges_take_the_leftmost_lowest_rank(spark):
    """A made-up table in which a merged pair may rank below its parts."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"xab": 260, b"aa": 270, b"aaa": 265, b"ba": 400, b"bab": 257}
    own = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    words = ["xab", "aaaa", "aaaaaaa", "abab", "babab", "xabab", "aabaa", "b", "é", "xaba"]
    bpe = byte_bpe.ByteBpe(ranks)
    df = spark.createDataFrame([(w,) for w in words], "w string")
    from pyspark.sql import functions as F
    found = {r["w"]: list(r["x"]) for r in df.select("w", bpe.encode(F.array("w"))[0].alias("x")).collect()}
    assert found == {w: own.encode_ordinary(w) for w in words}


def library_ids(rows):
    library = Tokenizer.from_file(JSON)
    out, start = [], 0
    named = sorted(((i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows),
                   key=lambda r: (r[0] is not None, r[0] or 0, struct.pack(f"<{len(r[1])}H", *r[1])))
    for i, ids in named:
        out.append((i, start, len(ids), struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    return out


@settings(max_examples=300, deadline=None)
@cases(st.lists(st.text(alphabet="ab é1.,'!\n\t 中 s😀", max_size=12), max_size=5))
def test_cached_parts_are_the_library(texts):
    library = token_files.encoder(JSON).tokenizer
    wanted = [struct.pack(f"<{len(e.ids)}H", *e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_files.encoder(JSON).ids(texts) == wanted
    token_files.encoder(JSON).often.clear()
    token_files.encoder(JSON).lately.clear()
    token_files.encoder(JSON).words.clear()
    assert token_files.encoder(JSON).byte_level
    for _ in range(3):
        assert token_files.encoder(JSON).ids(texts) == wanted


def test_token_files(spark, given, odd, odd_rows, none):
    docs, texts = given
    for frame, rows in ((docs, texts.items()), (odd, odd_rows)):
        path = run_folder(spark, "tokens")
        token_files.write_tokens(frame, JSON, path)
        found = sorted((tuple(r) for r in token_files.read_tokens(spark, path).collect()), key=lambda r: r[1])
        assert [(i, s, n, bytes(b)) for i, s, n, b in found] == library_ids(rows)
    some = {r["doc_id"]: bytes(r["ids"]) for r in token_files.read_tokens(spark, path, [10, 13]).collect()}
    assert some == {i: b for i, _, _, b in library_ids(odd_rows) if i in (10, 13)}
    path = run_folder(spark, "tokens")
    token_files.write_tokens(none, JSON, path)
    assert token_files.read_tokens(spark, path).count() == 0


def test_damaged_frame_is_told(tmp_path):
    path = tmp_path / "one.zst"
    with path.open("wb") as stream:
        out = token_files.FrameFile(stream)
        for i in range(4):
            out.add(i, struct.pack("<40000I", *range(40000)))
        out.close()
    whole = path.read_bytes()
    import io
    assert [x[:2] for x in token_files.read_file(io.BytesIO(whole), len(whole))] == [(i, 40000 * i) for i in range(4)]
    import zstandard
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(whole), read_across_frames=True) as plain:
        assert zlib.crc32(plain.read()) == zlib.crc32(struct.pack("<40000I", *range(40000)) * 4)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.read_file(io.BytesIO(whole[:200] + b"??" + whole[202:]), len(whole)))
    with pytest.raises(ValueError):
        list(token_files.read_file(io.BytesIO(whole[:-1]), len(whole) - 1))
