"""Token counts by a two-tier lookup in the tasks; no pre-token is shuffled for the counting.

A byte-level BPE splits a text into pre-tokens before it merges. A blank that stands between two
visible characters starts a pre-token, so the pieces between such blanks are tokenized
independently of each other, and their lengths in tokens can be looked up:

* tier 1, a broadcast table of the most frequent pieces of the whole input. Each task counts the
  pieces of its rows in a summary of bounded size, and only these summaries are merged;
* tier 2, a cache in each Python worker for pieces that are not in the table. Its misses are
  encoded by the tokenizer itself.

A text with a piece that is empty or has white space at an end (runs of blanks, a blank beside a
line feed) is encoded whole, since white space there depends on its neighbours.

The table and the cache decide the speed alone. Both have a size that does not grow with the data.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressflow.llm.support import shared, text_of

#: Pieces in the broadcast table, and pieces that a task reports to it.
TABLE_PIECES = 16_384
TASK_PIECES = 4_096
#: Pieces that a task's summary holds before its rarest half is dropped.
SUMMARY_PIECES = 262_144
#: Entries of a worker's cache, and the longest piece it holds.
CACHE_PIECES = 400_000
CACHED_CHARS = 64


def _frequent_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update(text.split(" "))
            if len(seen) > SUMMARY_PIECES:
                seen = Counter(dict(seen.most_common(SUMMARY_PIECES // 2)))
    top = [(piece, n) for piece, n in seen.most_common(TASK_PIECES)
           if 0 < len(piece) <= CACHED_CHARS]
    yield pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
        ["piece", "n"])


class PieceLengths:
    """Lengths in tokens of pieces; lives once in each Python worker."""

    def __init__(self, tokenizer_json: str, frequent: list[str]):
        self.tokenizer_json = tokenizer_json
        self.tokenizer = self.cache = None
        self.frequent = dict(zip(frequent, self.encoded([" " + p for p in frequent]), strict=True))

    def __getstate__(self):
        return self.__dict__ | {"tokenizer": None, "cache": None}

    def encoded(self, texts: list[str]) -> list[int]:
        if self.tokenizer is None:
            import os

            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.tokenizer = Tokenizer.from_str(self.tokenizer_json)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        if self.cache is None:
            self.cache = dict(self.frequent)
        known, whole, counts = self.cache.get, [], []
        for i, text in enumerate(texts):
            first, *pieces = text.split(" ")
            lengths = list(map(known, pieces))
            if None in lengths:
                missing = list({p for p, n in zip(pieces, lengths, strict=True) if n is None})
                if not all(self.independent(p) for p in missing):
                    whole.append(i)
                    counts.append(0)
                    continue
                found = dict(zip(missing, self.encoded([" " + p for p in missing]), strict=True))
                self.remember(found)
                lengths = [found[p] if n is None else n
                           for p, n in zip(pieces, lengths, strict=True)]
            # the first piece has no blank before it; if it ends in white space, so does the text
            # or a blank follows that white space
            if first[-1:].isspace() or (not first and pieces):
                whole.append(i)
                counts.append(0)
                continue
            counts.append(sum(lengths) + self.start(first))
        for i, n in zip(whole, self.encoded([texts[i] for i in whole]), strict=True):
            counts[i] = n
        return counts

    @staticmethod
    def independent(piece: str) -> bool:
        return bool(piece) and not (piece[0].isspace() or piece[-1].isspace())

    def start(self, piece: str) -> int:
        if not piece:
            return 0
        key = " " + piece  # no piece holds a blank, so these keys are apart from the others
        n = self.cache.get(key)
        if n is None:
            n = self.encoded([piece])[0]
            self.remember({key: n})
        return n

    def remember(self, found: dict[str, int]) -> None:
        if len(self.cache) < CACHE_PIECES:
            self.cache.update((p, n) for p, n in found.items() if len(p) <= CACHED_CHARS)


def frequent_pieces(texts: DataFrame, text: str) -> list[str]:
    """The most frequent pieces of all texts, at most ``TABLE_PIECES``; ties by the piece."""
    merged = (texts.select(text_of(text).alias("text"))
              .mapInArrow(_frequent_pieces, "piece string, n bigint")
              .groupBy("piece").agg(F.sum("n").alias("n")))
    rows = merged.orderBy(F.desc("n"), "piece").limit(TABLE_PIECES).collect()
    return [r["piece"] for r in rows]


def token_counts(df: DataFrame, tokenizer_json: str, text: str = "text",
                 out: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of each whole text in the column ``out``.

    ``tokenizer_json`` is the content of a byte-level BPE file of the tokenizers library whose
    pre-tokenizer adds no blank in front. A null or empty text has no tokens; special strings in a
    text count as the library counts them. An empty table gives an empty table. A column of ``df``
    that is called like ``out`` is replaced; rows, repeated ones too, keep their other columns.
    """
    spark = df.sparkSession
    lengths = shared(spark, PieceLengths(tokenizer_json, frequent_pieces(df, text)))
    schema = T.StructType([f for f in df.schema if f.name != out]
                          + [T.StructField(out, T.LongType())])
    keep = [f.name for f in df.schema if f.name != out]

    def counted(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            n = pa.array(lengths().count(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [n], [*keep, out])

    return df.mapInArrow(counted, schema)
