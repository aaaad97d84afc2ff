"""Distinct words of a corpus, and the frequent ones of them as a table of bounded size."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import as_strings, cut_texts, keyed, spaced_parts, trim

#: Distinct words counted in a task before they go on to the shuffle.
TASK_WORDS = 500_000
#: Bounds of the table of frequent words that tasks hold: entries, and UTF-8 bytes of one entry's word.
HOT_WORDS, HOT_BYTES = 1_000_000, 64


class Lookup:
    """A bounded table of words and values, sent to tasks in columns; a worker makes it a dictionary once."""

    def __init__(self, found: DataFrame):
        self.table = found.toArrow().combine_chunks()

    @functools.cached_property
    def known(self) -> dict:
        words, values = self.table.columns
        return dict(zip(words.to_pylist(), values.to_pylist(), strict=True))


def word_counts(docs: DataFrame, splitter: Callable[[], Callable[[str], list[str]]] | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n``: how often each word stands in all whole texts.

    Words are the text's parts (see ``spaced_parts``); or, with a ``splitter``, what the function it gives makes of each
    marked part (see ``marked``). Tasks count before the shuffle, so a word that fills the corpus is one row of each
    task. Null texts have no words.
    """
    texts = keyed(docs, id_col, text_col).select("text")
    out = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def counted(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter() if splitter else None
        counts: Counter[str] = Counter()

        def flushed() -> Iterator[pa.RecordBatch]:
            words = counts
            if split:
                words = Counter()
                for key, n in counts.items():
                    for word in split(key):
                        words[word] += n
            names, each = list(words), list(words.values())
            for i in range(0, len(names), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[i:i + 50_000], pa.string()), pa.array(each[i:i + 50_000], pa.int64())], schema=out
                )
            counts.clear()

        for batch in found:
            if split:
                keys, number, _ = cut_texts(as_strings(batch.column(0)))
                for key, n in zip(keys, np.bincount(number, minlength=len(keys)).tolist(), strict=True):
                    counts[key] += n
            else:
                for text in batch.column(0).to_pylist():
                    if text:
                        counts.update(spaced_parts(text.decode("utf-8", "replace")))
            if len(counts) > TASK_WORDS:
                yield from flushed()
        yield from flushed()
        trim()

    return texts.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, at_most: int = HOT_WORDS) -> DataFrame:
    """Words of at most ``HOT_BYTES`` bytes seen so often that at most ``at_most`` words are.

    The cut is taken from a histogram of log-scaled counts of under 1,100 bins. The table only says which words
    a task looks up in memory: results are the same with any cut.
    """
    short = counts.filter(f"octet_length(word) <= {HOT_BYTES}")
    scaled = F.floor(F.log2("n") * 16)
    bins = sorted(short.groupBy(scaled.alias("b")).agg(F.count("*").alias("c")).collect(), reverse=True)
    room, least = at_most, None
    for b, c in bins:
        if c > room:
            break
        room, least = room - c, b
    if least is None:
        return short.limit(0)
    return short.filter(scaled >= least)
