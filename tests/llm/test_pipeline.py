import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from test_simhash import expected as simhash_components
from test_text import slow_items, slow_lines

import __spark_entry__ as entry
import corpus_pipeline
from rosterlake.llm import byte_bpe, line_crf
from rosterlake.session import settle

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    queries = entry.queries()
    assert corpus_pipeline.run and "pipeline" in queries
    assert sorted(int(q[2:].split("_")[0]) for q in queries if q.startswith("op")) == list(range(1, 14))


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage and after each."""
    out = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], FOLDER), name))
    return out


def rows_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_every_stage_against_plain_code(spark, stages):
    docs, good, lines, single, clean, ids = stages
    assert all(x.columns == docs.columns for x in (good, lines, single, clean))
    model = line_crf.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert sorted(rows_of(good)) == sorted((i, t) for i, t in rows_of(docs) if line_crf.score_text(t, model) >= 0.7)
    report = {r[0]: r for r in slow_lines(rows_of(good))}
    left = dict(rows_of(lines))
    for i, t in rows_of(good):
        if i in left:
            assert hashlib.sha256(left[i].encode()).hexdigest() == report[i][5]
        else:
            assert report[i][2] and report[i][5] in {hashlib.sha256(b"\n" * n).hexdigest() for n in range(len(t))}
    assert sorted(i for i, _ in rows_of(single)) == sorted({c for _, _, c in simhash_components(list(left.items()))})
    bench = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(i for i, _ in rows_of(clean)) == sorted(r[0] for r in slow_items(rows_of(single), bench) if not r[5])
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = {}
    for i, t in rows_of(clean):
        x = bpe.encode_ordinary(t)
        wanted[i] = (len(x), hashlib.sha256(struct.pack(f"<{len(x)}I", *x)).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in ids.collect()} == wanted


def test_stages_take_odd_rows(spark, odd, none):
    slim = [x.select("doc_id", "text", "text2") for x in (odd, none)]
    for docs in slim:
        for name, stage in corpus_pipeline.STAGES:
            docs = settle(stage(spark, docs, FOLDER), name)
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert docs.count() == 0
