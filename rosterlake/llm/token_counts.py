"""Token counts: pieces of each distinct pre-token, joined to the documents' pre-token frequencies."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import keyed, spaced_parts
from rosterlake.llm.vocabulary import Lookup, frequent, word_counts
from rosterlake.session import settle


@functools.cache
def processor(model_file: str) -> sentencepiece.SentencePieceProcessor:
    """The model, loaded once in each worker."""
    return sentencepiece.SentencePieceProcessor(model_file=model_file)


def check_model(model_file: str) -> None:
    """Raise unless pieces follow from single pre-tokens in this model: a dummy prefix, white space kept, and no
    piece with a word mark after another character."""
    model = processor(model_file)
    texts = {"a  b ": ["▁a", "▁", "▁b", "▁"], " a": None, "": []}
    joined = {t: "".join(model.encode(t, out_type=str)) for t in texts}
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    if (joined["a  b "] != "▁a▁▁b▁" or joined[" a"] != "▁▁a" or joined[""]
            or any("▁" in p.lstrip("▁") for p in pieces if not model.is_control(model.piece_to_id(p)))):
        raise ValueError(f"{model_file}: pieces may reach across white space")


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (over ``limit`` tokens) of every document.

    The distinct pre-tokens of the corpus are counted once by the model, in parallel. The most frequent of
    them, a table of bounded size, go to all tasks: they make up most of any text and would be hot keys of a
    join. A document's other pre-tokens are joined by the word, with their frequency in it, and summed. No ids
    are made per document. Texts are read whole; null counts as empty (no bytes, no tokens); repeated rows
    repeat; an empty table gives an empty result; other columns are left behind.
    """
    check_model(model_file)
    spark = docs.sparkSession

    # the model puts a word mark before any text, as the space before a part that is not the first one would
    @F.arrow_udf("int")
    def pieces_of(found: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = processor(model_file)
        for words in found:
            ids = model.encode(words.to_pylist(), num_threads=1)
            yield pa.array([len(x) for x in ids], pa.int32())

    counts = word_counts(docs, None, id_col, text_col)
    pieces = settle(counts.select("word", "n", pieces_of("word").alias("pieces")), "pieces")
    hot = spark.sparkContext.broadcast(Lookup(frequent(pieces).select("word", "pieces")))
    schema = "uid bigint, doc_id bigint, n_bytes bigint, base bigint, words array<string>, times array<int>"
    out = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("base", pa.int64()),
                     ("words", pa.list_(pa.string())), ("times", pa.list_(pa.int32()))])

    def summed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hot.value.known.get
        for batch in found:
            texts = batch.column("text").to_pylist()
            base, words, times = [], [], []
            for text in texts:
                total, rare, often = 0, [], []
                if text:
                    for word, n in Counter(spaced_parts(text.decode("utf-8", "replace"))).items():
                        p = known(word)
                        if p is None:
                            rare.append(word)
                            often.append(n)
                        else:
                            total += p * n
                base.append(total)
                words.append(rare)
                times.append(often)
            yield pa.RecordBatch.from_arrays([
                batch.column("uid"), batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                pa.array(base, pa.int64()), pa.array(words, out.field("words").type), pa.array(times, out.field("times").type),
            ], schema=out)

    texts = keyed(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )
    # written once: the row numbers must not change between the two reads below
    sums = settle(texts.mapInArrow(summed, schema), "sums")
    rare = sums.select("uid", F.explode(F.arrays_zip("words", "times")).alias("w")).select("uid", "w.words", "w.times")
    rest = rare.join(pieces.select(F.col("word").alias("words"), "pieces"), "words").groupBy("uid").agg(
        F.sum(F.col("times").cast("bigint") * F.col("pieces")).alias("rest")
    )
    total = F.col("base") + F.coalesce("rest", F.lit(0))
    return sums.select("uid", "doc_id", "n_bytes", "base").join(rest, "uid", "left").select(
        "doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit")
    )
