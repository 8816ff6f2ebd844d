"""Exact ranked search by the Best Position Algorithm over impact lists.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are
lower-cased. Scores are whole numbers, so they do not depend on the order of a sum:

* a term's weight is ``floor(1000 * ln((2 N + 2) / (2 df + 1)))``;
* a document's length measure is ``m = 10 + (90 n N) div L``;
* an impact is ``weight * ((10^9 tf) div (1000 tf + 8 m))``, and a score the sum of the impacts of
  the item's distinct terms.

Each task turns its documents into shards of bounded size: a vocabulary with document frequencies
and the postings. The index is stored once. Items come in blocks of bounded size; a block's terms
get their document frequencies from the vocabularies of all shards, so that every shard ranks with
the same numbers. In a shard an item's terms are lists of documents, from the highest impact down.
The lists are read side by side in growing steps:

* a document met for the first time is looked up in all other lists (direct access), which gives
  its full score and its positions there;
* the best position of a list is the last one before its first position that nobody has seen, by
  reading or by direct access. A document not met yet stands behind the best position of every
  list that holds it, so its score is at most the sum of the impacts at the best positions;
* reading stops once this sum is strictly below the k-th best score, so that ties are never lost.

A shard gives at most k documents for an item, and the k best of all shards are the answer.
"""

from __future__ import annotations

import math
import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pressflow.llm.support import stored, text_of
from pressflow.session import working_dir

TOP = 10
#: Documents and terms after which a shard is closed; a posting numbers its document with 16 bits.
SHARD_DOCS, SHARD_TERMS = 32_768, 4_000_000
#: Characters of items that are broadcast together.
ITEM_CHARS = 8_000_000
#: Positions of each list that are read at first; every step reads twice as many as the last.
FIRST_STEP = 32

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return (text or "").encode().translate(_FOLD).split()


def _packed(value) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, protocol=5))


def _unpacked(blob: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


class ShardWriter:
    """Documents on their way into one shard."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.ids, self.found, self.n_terms = [], [], 0

    def add(self, doc_id, text: str | None) -> None:
        words = terms(text)
        self.ids.append(doc_id)
        self.found.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
        self.n_terms += len(words)

    @property
    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.n_terms >= SHARD_TERMS

    def blobs(self) -> tuple[bytes, bytes]:
        """The vocabulary with document frequencies, and postings by term and document."""
        lengths = np.array([len(f) for f in self.found], np.int64)
        keys = np.concatenate(self.found) << 16 | np.repeat(np.arange(len(lengths)), lengths)
        keys, counts = np.unique(keys, return_counts=True)
        frequency = np.bincount(keys >> 16, minlength=len(self.numbers))
        vocabulary = b" ".join(self.numbers), frequency.astype(np.uint32)
        return _packed(vocabulary), _packed(((keys & 0xFFFF).astype(np.uint16), counts.astype(np.uint32), lengths))


def build_index(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each shard: ``ids``, ``n_docs``, ``n_terms``, ``vocabulary`` and ``postings``.

    ``n_docs`` counts the documents with a term. Null texts count as empty; every row is a document,
    repeated rows and null ids too.
    """
    id_type = df.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("n_docs", T.LongType()),
        T.StructField("n_terms", T.LongType()), T.StructField("vocabulary", T.BinaryType()),
        T.StructField("postings", T.BinaryType())])
    kinds = [pa.list_(to_arrow_type(id_type)), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def row(shard: ShardWriter) -> pa.RecordBatch:
        values = shard.ids, sum(len(f) > 0 for f in shard.found), shard.n_terms, *shard.blobs()
        return pa.RecordBatch.from_arrays(
            [pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)], schema.names)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = ShardWriter()
        for batch in batches:
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard.add(i, value)
                if shard.full:
                    yield row(shard)
                    shard = ShardWriter()
        if shard.ids:
            yield row(shard)

    return df.select(F.col(doc_id), text_of(text)).mapInArrow(shards, schema)


class ImpactLists:
    """The postings of a shard for the terms of a block of items, as impact lists.

    ``weights`` maps a term to its number in the block and its weight. Postings are held by (term,
    document), for direct access, each with its impact and its position in the term's list.
    """

    def __init__(self, vocabulary: bytes, postings: bytes, weights: dict[bytes, tuple[int, int]],
                 n_docs: int, n_terms: int):
        names, frequency = _unpacked(vocabulary)
        docs, counts, lengths = _unpacked(postings)
        known = sorted((weights[t], at) for at, t in enumerate(names.split(b" ")) if t in weights)
        ends = np.cumsum(frequency, dtype=np.int64)
        taken = [np.arange(ends[at] - frequency[at], ends[at]) for _, at in known]
        sizes = np.array([len(t) for t in taken], np.int64)
        at = np.concatenate(taken) if taken else np.empty(0, np.int64)
        doc, tf = docs[at].astype(np.int64), counts[at].astype(np.int64)
        weight = np.repeat(np.array([w for (_, w), _ in known], np.int64), sizes)
        number = np.repeat(np.array([n for (n, _), _ in known], np.int64), sizes)
        # whole numbers of Python do not overflow, however long a text is
        measure = np.array([10 + 90 * n * n_docs // n_terms if n else 0 for n in lengths.tolist()], np.int64)
        self.impact = weight * (10**9 * tf // (1000 * tf + 8 * measure[doc]))
        self.key = number << 16 | doc
        self.order = np.lexsort((doc, -self.impact, number))  # postings in the order of the lists
        starts = np.cumsum(sizes) - sizes
        self.position = np.empty(len(at), np.int64)
        self.position[self.order] = np.arange(len(at)) - np.repeat(starts, sizes)
        self.lists = {n: (s, size) for ((n, _), _), s, size in
                      zip(known, starts.tolist(), sizes.tolist(), strict=True)}

    def best(self, query: list[int], k: int) -> list[tuple[int, int]]:
        """Score and document of the best of this shard: the k best and all ties with the last."""
        numbers = np.array([t for t in query if t in self.lists], np.int64)
        if not len(numbers):
            return []
        spans = [self.lists[t] for t in numbers.tolist()]
        seen = [np.zeros(size, bool) for _, size in spans]
        best_position = [0] * len(spans)
        met, score = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, step = 0, FIRST_STEP
        while True:
            read = np.concatenate([self.order[s + depth:s + min(depth + step, size)] for s, size in spans])
            depth, step = depth + step, step * 2
            new = np.setdiff1d(self.key[read] & 0xFFFF, met)
            met = np.concatenate((met, new))
            score = np.concatenate((score, self._look_up(numbers, new, spans, seen)))
            bound = 0
            for i, (s, size) in enumerate(spans):
                rest = seen[i][best_position[i]:]
                unseen = int(rest.argmin()) if len(rest) else 0
                best_position[i] += unseen if len(rest) and not rest[unseen] else len(rest)
                # a list seen to its end holds no further document
                if best_position[i] < size:
                    bound += int(self.impact[self.order[s + max(best_position[i] - 1, 0)]])
            kth = int(np.partition(score, len(score) - k)[len(score) - k]) if len(score) >= k else 0
            if bound < kth or not bound or all(depth >= size for _, size in spans):
                near = np.flatnonzero(score >= max(kth, 1))
                return list(zip(score[near].tolist(), met[near].tolist(), strict=True))

    def _look_up(self, numbers, docs, spans, seen) -> np.ndarray:
        """Full scores of documents by direct access; marks their positions as seen."""
        wanted = numbers[:, None] << 16 | docs[None, :]
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        there = self.key[at] == wanted
        for i in range(len(spans)):
            seen[i][self.position[at[i][there[i]]]] = True
        return np.where(there, self.impact[at], 0).sum(axis=0)


def _frequencies(index: DataFrame, numbers) -> DataFrame:
    def counted(batches):
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                names, frequency = _unpacked(blob)
                found = [(numbers.value[t], n) for t, n in
                         zip(names.split(b" "), frequency.tolist(), strict=False) if t in numbers.value]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in found], pa.int32()), pa.array([n for _, n in found], pa.int64())],
                    ["term", "df"])

    return index.select("vocabulary").mapInArrow(counted, "term int, df bigint").groupBy("term").agg(
        F.sum("df").alias("df"))


def _answers(index: DataFrame, block, id_type: T.DataType, k: int) -> DataFrame:
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", id_type),
                           T.StructField("score", T.LongType())])

    def searched(batches):
        items, weights, n_docs, n_terms = block.value
        for batch in batches:
            for ids, *blobs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard, rows = ImpactLists(*blobs, weights, n_docs, n_terms), []
                for number, query in items:
                    found = sorted((-s, ids[d] is None, ids[d] if ids[d] is not None else 0)
                                   for s, d in shard.best(query, k))
                    rows += [(number, None if missing else i, -s) for s, missing, i in found[:k]]
                columns = list(zip(*rows, strict=True)) or [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema, strict=True)],
                    schema.names)

    return index.select("ids", "vocabulary", "postings").mapInArrow(searched, schema)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def ranked(spark: SparkSession, index: DataFrame, items: DataFrame, id_type: T.DataType, *,
           item_id: str = "item_id", item_text: str = "text", k: int = TOP) -> DataFrame:
    """The k best documents of a stored ``index`` for each item, see ``search``."""
    total = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"),
                      F.coalesce(F.sum("n_terms"), F.lit(0)).alias("terms")).first()
    asked = items.select(F.col(item_id).alias("item_id"), text_of(item_text).alias("text")).distinct()
    asked = stored(asked.withColumn("item", F.monotonically_increasing_id()), "items")
    chars = asked.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    n_blocks = -(-chars // ITEM_CHARS) if total["terms"] else 0
    folder = working_dir(spark, "answers")
    for block in range(n_blocks):
        numbers: dict[bytes, int] = {}
        queries = [(r["item"], [numbers.setdefault(t, len(numbers)) for t in dict.fromkeys(terms(r["text"]))])
                   for r in asked.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).collect()]
        sent = spark.sparkContext.broadcast(numbers)
        df = {r["term"]: r["df"] for r in _frequencies(index, sent).collect()}
        sent.unpersist()
        weights = {t: (n, weight(total["docs"], df[n])) for t, n in numbers.items() if n in df}
        sent = spark.sparkContext.broadcast((queries, weights, total["docs"], total["terms"]))
        _answers(index, sent, id_type, k).write.mode("append").parquet(folder)
        sent.unpersist()
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", id_type),
                           T.StructField("score", T.LongType())])
    found = spark.read.schema(schema).parquet(folder) if n_blocks else spark.createDataFrame([], schema)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def search(df: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", *,
           item_id: str = "item_id", item_text: str = "text", k: int = TOP) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``k`` best documents of each item.

    A document without any of an item's terms, or whose terms all weigh nothing, is no answer, so
    a null or empty item has none. Equal scores go to the smaller id, null ids last. Rows of ``df``
    that are repeated are documents of their own, of which each can be an answer; repeated rows of
    ``items`` are one item, and rows of one id with different texts are items of their own, ranked
    apart. Empty tables give an empty result; other columns of both tables are left out.
    """
    index = stored(build_index(df, doc_id, text), "index")
    return ranked(df.sparkSession, index, items, df.schema[doc_id].dataType,
                  item_id=item_id, item_text=item_text, k=k)
