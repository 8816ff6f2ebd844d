"""SimHash near-duplicates: fingerprints that differ in a few bits, and the groups they link into.

A fingerprint's bits are cut into segments, and the counts of set bits in the segments are a point
on a grid. One differing bit moves one count by one, so two fingerprints within ``max_bits`` lie
within ``max_bits`` of each other by Manhattan distance: a lower bound of the bit distance. The
range join on the grid gives each point a row for every grid point in half of that range and joins
the rows to the points there by equality; the bit distance of the pairs found is then computed
exactly. Equal fingerprints are one point, however many documents have them.

Groups are the connected components of the links, found by alternating large-star and small-star
steps, which need no group in one place.
"""

from __future__ import annotations

from itertools import combinations_with_replacement, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressflow.llm.support import discard, stored, text_of

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
SEGMENTS = 10
#: Shingles whose bits are summed at once.
_BLOCK = 65_536


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of UTF-8 text, as a signed number."""
    from xxhash import xxh64_intdigest

    parts = text.lower().split()  # of bytes: A-Z, and the blanks 20 and 09-0D
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    last = ends[min(words, len(parts)) - 1:].tolist()
    first = [0, *(ends[:max(0, len(parts) - words)] + 1).tolist()]
    hashes = np.fromiter(
        (xxh64_intdigest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)),
        np.uint64, len(last))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = hashes[at:at + _BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", *,
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """Id column and ``fp`` (signed 64-bit) of each row; a null text counts as empty, which has 0."""
    schema = T.StructType([T.StructField(doc_id, df.schema[doc_id].dataType),
                           T.StructField("fp", T.LongType())])

    def hashed(batches):
        for batch in batches:
            found = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())],
                                             [doc_id, "fp"])

    texts = df.select(F.col(doc_id), text_of(text).cast("binary").alias("text"))
    return texts.mapInArrow(hashed, schema)


def _segments(count: int) -> list[tuple[int, int]]:
    """Offset and width of each segment of 64 bits."""
    edges = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _grid_point(fp: Column, segments: int) -> Column:
    """The counts of set bits, each in five bits of one number (a count is at most 16)."""
    total = F.lit(0).cast("long")
    for i, (offset, width) in enumerate(_segments(segments)):
        ones = F.bit_count(F.shiftrightunsigned(fp, offset).bitwiseAND((1 << width) - 1))
        total = total + F.shiftleft(ones.cast("long"), 5 * i)
    return total


def _half_range(segments: int, reach: int) -> list[int]:
    """Differences of grid points within ``reach``, one of each two opposite ones, and zero."""
    found = set()
    units = [s * (1 << 5 * i) for i, s in product(range(segments), (1, -1))]
    for parts in combinations_with_replacement([0, *units], reach):
        found.add(abs(sum(parts)))
    return sorted(found)


def links(fps: DataFrame, *, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Pairs ``a``, ``b`` of different values of ``fp`` within ``max_bits`` bits.

    ``fps`` holds each value once. A pair comes once, or twice if both lie on one grid point.
    Neither side is broadcast: Spark sizes the probes as if each point had one.
    """
    if not 4 <= segments <= 12:
        raise ValueError("4 to 12 segments")
    points = fps.select(F.col("fp").alias("a"), _grid_point(F.col("fp"), segments).alias("point"))
    reach = F.array(*(F.lit(d).cast("long") for d in _half_range(segments, max_bits)))
    probes = points.select(F.col("a").alias("b"), "point", F.explode(reach).alias("step")).select(
        "b", (F.col("point") + F.col("step")).alias("point"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    same = probes["point"] == points["point"]
    return probes.hint("merge").join(points, same & (F.col("a") != F.col("b")) & near).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its group's smallest node) of each node that has an edge ``a``-``b``."""
    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20)"))).first()

    edges = stored(edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before, now = None, state(edges)
    while now != before:
        # large star: neighbours above a node are linked to the least of the node's neighbourhood
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # small star: a node and its lower neighbours are linked to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, edges = edges, stored(small.union(least.select("a", F.col("m").alias("b")))
                                    .where("a != b").distinct(), "links")
        discard(last)
        before, now = now, state(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _labels(hashed: DataFrame, order: Column, max_bits: int, segments: int) -> DataFrame:
    """``fp``, ``root`` of its group and ``first``, the least ``order`` in the group.

    ``hashed`` is a stored table with ``fp``.
    """
    points = stored(hashed.groupBy("fp").agg(F.min(order).alias("first")), "points")
    roots = components(links(points, max_bits=max_bits, segments=segments))
    grouped = points.join(roots, points["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")
    least = grouped.groupBy("root").agg(F.min("first").alias("first"))
    return grouped.drop("first").join(least, "root")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", *,
                    words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    segments: int = SEGMENTS) -> DataFrame:
    """Id column, ``fingerprint`` (16 hex digits) and ``component_id`` of each row.

    ``component_id`` is the smallest id in the row's group; null ids count only where a group has
    no other. Rows stay as they are, repeated ones too; texts without words share the fingerprint
    zero and are linked like any other. Other columns are left out. An empty table gives an empty
    table.
    """
    hashed = stored(fingerprints(df, doc_id, text, words=words).select(
        F.col(doc_id).alias("doc"), "fp"), "fingerprints")
    labels = _labels(hashed, F.col("doc"), max_bits, segments)
    return hashed.join(labels, "fp").select(
        F.col("doc").alias(doc_id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first").alias("component_id"))


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", *,
                words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                segments: int = SEGMENTS) -> DataFrame:
    """One row of ``df`` for each group of near-duplicates, with all its columns and no others.

    The row with the smallest id stays; of rows without id or with equal ids, the one with the least
    hash of id and text, and of rows that agree in both any one. An empty table stays empty.
    """
    key = F.xxhash64(F.col(doc_id), F.col(text))
    keyed = df.select(key.alias("key"), F.struct(F.col(doc_id).alias("doc"), key.alias("key")).alias("order"),
                      F.col(text).alias("text"))
    hashed = stored(fingerprints(keyed, "order", "text", words=words), "fingerprints")
    # null ids sort before others, so whether there is one comes first
    order = F.struct(F.col("order.doc").isNull(), F.col("order.doc"), F.col("order.key"))
    labels = _labels(hashed, order, max_bits, segments)
    chosen = stored(labels.select(F.col("first.key").alias("_key")).distinct(), "chosen")
    rows = df.select(key.alias("_key"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"))
    again = Window.partitionBy("_key").orderBy(F.lit(0))
    return (rows.join(chosen, "_key").withColumn("_n", F.row_number().over(again)).where("_n = 1")
            .select("_row.*"))
