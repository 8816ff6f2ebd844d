"""Exact top-k search by BM25: an inverted index in shards, block-max WAND within, exact merge.

Each task turns its documents into shards of bounded size: postings of each term, and the length of
each document. The index is stored once. Queries come in blocks of bounded size; their terms get
their document frequencies from all shards, so every shard scores with the same statistics. In a
shard, for each query:

* the terms fall into frequent ones, which a large share of the shard's documents has, and others;
* the others' postings are summed up: few, and they decide most scores;
* for the frequent terms each run of ``BLOCK`` documents has an upper bound, the sum of the terms'
  greatest impacts in it. Only documents whose sum and bound reach the threshold, the least full
  score among the documents with the highest bounds, make their block be looked into; the other
  blocks are skipped;
* in those blocks the frequent terms are summed up in single precision, and only documents that may
  reach the threshold within its error are scored exactly.

Bounds are never below a score, so the result is that of scoring every document. A shard gives at
most k documents for a query; the k best of all shards are the answer. A block is answered first by
some of the shards, as many as the root of their number. The others then give only documents that
come before the k-th of these, so answers on the way grow with that root, not with the shards.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressflow.llm.support import stored, text_of
from pressflow.session import working_dir

K1, B = 1.2, 0.75
TOP = 10
#: A shard's documents and characters at most; documents in a block of upper bounds.
SHARD_DOCS, SHARD_CHARS = 60_000, 16_000_000
BLOCK = 64
#: A term is frequent in a shard if one of so many documents has it.
FREQUENT_SHARE = 16
#: Characters of queries that are broadcast together, and queries that a shard answers at once.
QUERY_CHARS = 10_000_000
TOGETHER = 64
#: Sums in another order differ by less than this.
_SLACK = 1e-9

_WORD = re.compile(r"\w+")


def terms(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class _Postings:
    """Postings of the documents added so far; of their texts nothing else is kept."""

    def __init__(self):
        self.numbers: defaultdict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.term_ids, self.counts, self.lengths, self.chars = [], [], [], 0

    def add(self, text: str) -> None:
        found = terms(text)
        ids, n = np.unique(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)),
                           return_counts=True)
        self.term_ids.append(ids)
        self.counts.append(n.astype(np.int32))
        self.lengths.append(len(found))
        self.chars += len(text)

    def packed(self) -> tuple[int, bytes]:
        """Number of terms, and postings by term: documents in order, how often, and their lengths."""
        docs = np.repeat(np.arange(len(self.lengths), dtype=np.uint16), [len(ids) for ids in self.term_ids])
        term_ids, counts = np.concatenate(self.term_ids), np.concatenate(self.counts)
        order = np.argsort(term_ids, kind="stable")
        ends = np.cumsum(np.bincount(term_ids, minlength=len(self.numbers)))
        small = np.uint16 if not len(order) or counts.max() < 65_536 else np.uint32
        return sum(self.lengths), pickle.dumps(
            (list(self.numbers), ends, docs[order], counts[order].astype(small), np.array(self.lengths, np.int64)),
            protocol=5)


def build_index(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each shard: ``ids`` of its documents, ``n_docs``, ``n_terms`` and ``postings``.

    Null texts count as empty; every row is a document, repeated rows and null ids too.
    """
    schema = T.StructType([
        T.StructField("ids", T.ArrayType(df.schema[doc_id].dataType)), T.StructField("n_docs", T.LongType()),
        T.StructField("n_terms", T.LongType()), T.StructField("postings", T.BinaryType())])
    id_type = pa.list_(_arrow(df.schema[doc_id].dataType))

    def row(ids, postings):
        n_terms, blob = postings.packed()
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], id_type), pa.array([len(ids)], pa.int64()),
             pa.array([n_terms], pa.int64()), pa.array([blob], pa.binary())],
            ["ids", "n_docs", "n_terms", "postings"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, postings = [], _Postings()
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(i.as_py())
                postings.add(t.as_py())
                if len(ids) >= SHARD_DOCS or postings.chars >= SHARD_CHARS:
                    yield row(ids, postings)
                    ids, postings = [], _Postings()
        if ids:
            yield row(ids, postings)

    return df.select(F.col(doc_id), text_of(text).alias("text")).mapInArrow(shards, schema)


def _arrow(data_type: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(data_type)


class ShardSearch:
    """A shard prepared for the terms of a block of queries.

    ``numbers`` numbers the block's terms, and ``idf`` has their inverse document frequencies.
    """

    def __init__(self, blob: bytes, numbers: dict[str, int], idf: np.ndarray, mean_length: float):
        names, ends, docs, counts, lengths = pickle.loads(blob)
        self.n = n = len(lengths)
        norm = K1 * (1 - B + B * lengths / max(mean_length, 1e-9))
        sizes = np.diff(ends, prepend=0)
        number = np.fromiter((numbers.get(name, -1) for name in names), np.int64, len(names))
        often = sizes * FREQUENT_SHARE >= n

        def chosen(here):
            """Postings of some of the shard's terms: documents and impacts."""
            at = _places(ends[here] - sizes[here], sizes[here])
            doc, tf = docs[at], counts[at].astype(np.float64)
            return doc, np.repeat(idf[number[here]], sizes[here]) * tf * (K1 + 1) / (tf + norm[doc])

        rare = np.flatnonzero((number >= 0) & ~often)
        self.docs, self.impacts = chosen(rare)
        self.sizes, self.starts = np.zeros((2, len(idf)), np.int64)
        self.sizes[number[rare]] = sizes[rare]
        self.starts[number[rare]] = np.cumsum(sizes[rare]) - sizes[rare]
        frequent = np.flatnonzero((number >= 0) & often)
        self.blocks = -(-n // BLOCK)
        self.frequent = np.full(len(idf), -1, np.int32)
        self.frequent[number[frequent]] = np.arange(len(frequent))
        doc, impact = chosen(frequent)
        term = np.repeat(np.arange(len(frequent), dtype=np.int32), sizes[frequent])
        #: Impacts of frequent terms, rounded; sums of them are off by this share at most.
        self.dense = np.zeros((self.blocks * BLOCK, len(frequent)), np.float32)
        self.dense[doc, term] = impact
        self.off = (len(frequent) + 4) * 2.0 ** -23
        self.bound = self.dense.reshape(self.blocks, BLOCK, len(frequent)).max(axis=1)
        order = np.argsort(doc, kind="stable")
        self.frequent_terms, self.frequent_impacts = term[order], impact[order]
        self.frequent_ends = np.cumsum(np.bincount(doc, minlength=n))

    def search(self, queries: list[np.ndarray], k: int, floors: np.ndarray) -> list[list[tuple[float, int]]]:
        """The k best documents with a positive score for each query, as score and place here; those
        below the query's floor may be missing.

        Upper bounds of all blocks and queries are one product of matrices. So are the frequent
        terms' rounded scores, of those blocks that a query has to look into. Documents that may be
        among the best by these are scored exactly.
        """
        common = np.zeros((self.dense.shape[1], len(queries)), np.float32)
        rare = np.empty((len(queries), self.blocks * BLOCK))
        for q, query in enumerate(queries):
            at = self.frequent[query]
            common[at[at >= 0], q] = 1
            rare[q] = self._rare_scores(query)
        bounds = (self.bound @ common).T * (1 + self.off)
        highest = rare.reshape(len(queries), self.blocks, BLOCK).max(axis=2) + bounds
        least = floors.tolist()
        for q in range(len(queries)):
            if least[q] <= 0 and self.n > k:
                bound = (rare[q] + np.repeat(bounds[q], BLOCK))[:self.n]
                probes = np.argpartition(bound, self.n - k)[self.n - k:]
                least[q] = max(self._exact(rare[q], common[:, q], probes).min() - _SLACK, 0.0)
        blocks = np.flatnonzero((highest >= np.array(least)[:, None]).any(axis=0))
        looked_at = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        looked_at = looked_at[looked_at < self.n]
        rounded = common.T @ self.dense[looked_at].T if len(looked_at) < self.n else common.T @ self.dense[:self.n].T
        out = []
        for q in range(len(queries)):
            score = rare[q][looked_at] if len(looked_at) < self.n else rare[q][:self.n]
            near = np.flatnonzero(score + rounded[q] * (1 + self.off) >= least[q])
            if len(near) > k:
                sure = score[near] + rounded[q, near] * (1 - self.off)
                kth = np.partition(sure, len(near) - k)[len(near) - k] - _SLACK
                near = near[score[near] + rounded[q, near] * (1 + self.off) >= kth]
            places = looked_at[near]
            out.append(self._best(self._exact(rare[q], common[:, q], places), places, least[q], k))
        return out

    def _rare_scores(self, query: np.ndarray) -> np.ndarray:
        at = _places(self.starts[query], self.sizes[query])
        return np.bincount(self.docs.take(at), self.impacts.take(at), self.blocks * BLOCK)

    def _exact(self, rare: np.ndarray, common: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Full scores of some documents."""
        ends = self.frequent_ends[places]
        sizes = ends - np.where(places > 0, self.frequent_ends[places - 1], 0)
        at = _places(ends - sizes, sizes)
        impacts = self.frequent_impacts[at] * common[self.frequent_terms[at]]
        return rare[places] + np.bincount(np.repeat(np.arange(len(places)), sizes), impacts, len(places))

    @staticmethod
    def _best(score: np.ndarray, places: np.ndarray, least: float, k: int) -> list[tuple[float, int]]:
        near = np.flatnonzero((score >= least) & (score > 0))
        if len(near) > k:  # ties with the k-th stay until ids decide
            kth = np.partition(score[near], len(near) - k)[len(near) - k]
            near = near[score[near] >= kth - _SLACK]
        return list(zip(score[near].tolist(), places[near].tolist(), strict=True))


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs, one run after the other."""
    ends = np.cumsum(sizes)
    places = np.repeat(starts - (ends - sizes), sizes)
    places += np.arange(len(places))
    return places


def _block_terms(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, int]]:
    """Keys of the queries, the numbers of their distinct terms one after the other, where each query
    ends there, and the numbering."""
    numbers: dict[str, int] = {}
    queries = [np.array([numbers.setdefault(t, len(numbers)) for t in dict.fromkeys(terms(r["text"]))], np.int32)
               for r in rows]
    ends = np.cumsum([len(query) for query in queries], dtype=np.int64)
    return (np.array([r["query"] for r in rows], np.int64), np.concatenate([np.empty(0, np.int32), *queries]),
            ends, numbers)


def _frequencies(index: DataFrame, asked: DataFrame) -> DataFrame:
    """``block``, ``term`` and ``df`` of the terms of each block of queries that documents have. The
    index is read once for all blocks."""
    def listed(batches):
        for batch in batches:
            for blob in batch.column(0):
                names, ends = pickle.loads(blob.as_py())[:2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(np.diff(ends, prepend=0), pa.int64())], ["term", "df"])

    def wanted(batches):
        for batch in batches:
            found = {(b, t) for b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                     for t in terms(text)}
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int64()),
                                              pa.array([t for _, t in found], pa.string())], ["block", "term"])

    counted = index.select("postings").mapInArrow(listed, "term string, df bigint").groupBy("term").agg(
        F.sum("df").alias("df"))
    needed = asked.select("block", "text").mapInArrow(wanted, "block bigint, term string").distinct()
    # not left to Spark, which sizes the terms as if each query had one
    return needed.hint("shuffle_hash").join(counted, "term").select("block", "term", "df")


def _answers(index: DataFrame, block, schema: T.StructType, k: int) -> DataFrame:
    """Answers of shards, at most ``k`` for each query, that come before the query's last one so far."""
    kinds = [_arrow(f.dataType) for f in schema]

    def searched(batches):
        keys, flat, ends, numbers, idf, mean_length, last = block.value
        floors = np.array([0.0 if key not in last else -last[key][0] - 1e-6 - _SLACK for key in keys.tolist()])
        keys, queries = keys.tolist(), np.split(flat, ends[:-1])[:len(keys)]
        for batch in batches:
            for ids, blob in zip(batch.column(0), batch.column(1), strict=True):
                ids, shard = ids.as_py(), ShardSearch(blob.as_py(), numbers, idf, mean_length)
                out = [], [], []
                for at in range(0, len(queries), TOGETHER):
                    answers = shard.search(queries[at:at + TOGETHER], k, floors[at:at + TOGETHER])
                    for key, found in zip(keys[at:at + TOGETHER], answers, strict=True):
                        best = sorted((-round(s, 6), ids[d] is None, ids[d] if ids[d] is not None else 0, d)
                                      for s, d in found)[:k]
                        if key in last:
                            best = [x for x in best if x[:3] < last[key]]
                        for s, missing, i, _ in best:
                            out[0].append(key)
                            out[1].append(None if missing else i)
                            out[2].append(-s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(out, kinds, strict=True)], schema.names)

    return index.select("ids", "postings").mapInArrow(searched, schema)


def search(df: DataFrame, queries: DataFrame, doc_id: str = "doc_id", text: str = "text", *,
           query_id: str = "query_id", query_text: str = "query_text", k: int = TOP) -> DataFrame:
    """``query_id``, ``doc_id``, ``score`` and ``rank`` of the ``k`` best documents of each query.

    Terms are lower-case runs of word characters; a query's repeated terms count once. Scores are
    rounded to six decimals; ties go to the smaller id, null ids last. A document without any of a
    query's terms is no answer, so a null or empty query has none. Rows of ``df`` that are repeated
    are documents of their own; repeated rows of ``queries`` are one query, and rows of one id with
    different texts are queries of their own, ranked apart. Empty tables give an empty result; other
    columns are left out. Each block's answers are written before the next block is broadcast.
    """
    spark = df.sparkSession
    index = stored(build_index(df, doc_id, text).withColumn("shard", F.monotonically_increasing_id()), "index")
    shards = sorted(r["shard"] for r in index.select("shard").collect())
    early = F.col("shard").isin(shards[::math.isqrt(len(shards)) or 1])
    total = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("terms")).first()
    asked = queries.select(F.col(query_id).alias("query_id"), text_of(query_text).alias("text")).distinct()
    asked = stored(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    chars = asked.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    n, n_blocks = total["n"], -(-chars // QUERY_CHARS) if total["n"] else 0
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(max(n_blocks, 1))))
    frequencies = stored(_frequencies(index, asked), "frequencies") if n_blocks else None
    schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("doc_id", df.schema[doc_id].dataType),
                           T.StructField("score", T.DoubleType())])
    folder = working_dir(spark, "answers")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for number in range(n_blocks):
        keys, flat, ends, numbers = _block_terms(asked.where(F.col("block") == number).collect())
        idf = np.zeros(len(numbers))
        for r in frequencies.where(F.col("block") == number).collect():
            idf[numbers[r["term"]]] = math.log(1 + (n - r["df"] + 0.5) / (r["df"] + 0.5))
        last = {}
        for here, name in ((early, "early"), (~early, "late")):
            sent = spark.sparkContext.broadcast((keys, flat, ends, numbers, idf, total["terms"] / n, last))
            _answers(index.where(here), sent, schema, k).write.parquet(f"{folder}/{number}/{name}")
            sent.unpersist()
            if name == "early":
                so_far = spark.read.schema(schema).parquet(f"{folder}/{number}/early")
                last = {r["query"]: (-r["score"], r["doc_id"] is None, 0 if r["doc_id"] is None else r["doc_id"])
                        for r in so_far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).collect()}
    found = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder) if n_blocks else spark.createDataFrame([], schema)
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.join(asked.select("query", "query_id"), "query").select("query_id", "doc_id", "score", "rank")
