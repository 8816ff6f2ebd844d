"""Removal of long byte strings that occur more than once, by distributed prefix doubling.

Prefix doubling ranks the strings that start at each position by growing lengths: pairs of a rank
and what follows at the next offset are sorted, equal pairs get one rank, and positions whose rank
is unique are done. Here Spark sorts and counts the pairs, with two changes that keep the number of
rows near the number of repeats instead of the number of bytes:

* Only *anchors* are ranked. The anchor of the string that starts at ``i`` is the position of the
  least hash among its first ``WINDOW`` eight-byte words, the leftmost one of equals. It depends on
  the string alone, so equal strings have their anchors at equal distances, and an anchor at ``p``
  stands for a whole range of starts ``p - d``, ``low <= d <= high``. There is about one in 80 bytes.
* Lengths grow around the anchor. What all starts of a range of distances have in common is the
  *core* of the range, ``p - low`` to ``p - high + 200``; what they cover together is its *span*,
  ``p - high`` to ``p - low + 200``. A rank is a 64-bit fingerprint of those bytes.

A range whose core is unique has no repeat: done. One whose span occurs again has only repeats:
past the threshold, done. Of the others, one for each different span, the range is cut into smaller
ones, whose cores are longer, and these are ranked again: 41 bytes, 169, 193, and at last 200 bytes
for single starts. Those are few: they lie where a repeat begins or ends.

Spans enter a result only as a pair with their core, so it takes a collision of two fingerprints
of different strings to err.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressflow.llm.support import stored, text_of

LENGTH = 200
#: Widths of the ranges of distances of each round; the first is the window of the anchors.
WIDTHS = (160, 32, 8, 1)
_WORD = 8
#: Starts that are looked at together; a position within takes 24 bits beside its hash.
_SLAB = 1 << 22
_MIX = np.uint64(0x9E3779B97F4A7C15)


def anchors(data: bytes, length: int = LENGTH, window: int = WIDTHS[0]) -> np.ndarray:
    """Anchor, least and greatest distance of the starts it stands for; rows in order of starts."""
    starts, found = len(data) - length + 1, []
    for slab in range(0, max(starts, 0), _SLAB):
        here = min(_SLAB, starts - slab)
        words = np.ndarray(here + window - 1, "<u8", data, offset=slab, strides=(1,)) * _MIX
        words ^= words >> np.uint64(29)
        words *= _MIX
        words &= np.uint64(0xFFFFFFFFFF000000)
        words |= np.arange(len(words), dtype=np.uint64)
        least, width = words, 1
        while 2 * width <= window:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < window:
            least = np.minimum(least[:here], least[window - width:window - width + here])
        at = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        last = np.concatenate((first[1:] - 1, [here - 1]))
        point = at[first]
        found.append(np.stack((point + slab, point - last, point - first), axis=1))
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _ranks(data: bytes, found: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the core of the whole window and of the span, for each anchor."""
    from xxhash import xxh3_64_intdigest as digest

    core = length - window + 1
    rows = found.tolist()
    return (_signed([digest(data[p:p + core]) for p, _, _ in rows]),
            _signed([digest(data[p - high:p - low + length], high << 8 | low)
                     for p, low, high in rows]))


def _counted(core: np.ndarray, span: np.ndarray) -> list[np.ndarray]:
    order = np.lexsort((span, core))
    core, span = core[order], span[order]
    new = np.flatnonzero(np.concatenate(([True], (core[1:] != core[:-1]) | (span[1:] != span[:-1]))))
    return [core[new], span[new], np.diff(np.append(new, len(core)))]


def _rank_counts(texts: DataFrame, length: int) -> DataFrame:
    """``core``, ``span`` and how often a batch of rows has the pair."""
    def counted(batches):
        for batch in batches:
            pairs = [_ranks(d, anchors(d, length), length, WIDTHS[0])
                     for d in batch.column(0).to_pylist() if len(d) >= length]
            if pairs:
                columns = _counted(*(np.concatenate(c) for c in zip(*pairs, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["core", "span", "n"])

    return texts.select("data").mapInArrow(counted, "core bigint, span bigint, n bigint")


def _positions(texts: DataFrame, length: int) -> DataFrame:
    """``span``, ``core``, the row's key, and the anchor with its distances of each anchor."""
    def located(batches):
        for batch in batches:
            keys, pairs, ats = [], [], []
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if len(data) >= length:
                    found = anchors(data, length)
                    pairs.append(_ranks(data, found, length, WIDTHS[0]))
                    ats.append(found[:, 0] << 16 | found[:, 1] << 8 | found[:, 2])
                    keys.append(np.full(len(found), key, np.int64))
            if pairs:
                core, span = (np.concatenate(c) for c in zip(*pairs, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (core, span, np.concatenate(keys), np.concatenate(ats))],
                    ["core", "span", "row", "at"])

    return texts.select("row", "data").mapInArrow(
        located, "core bigint, span bigint, row bigint, at bigint")


def _contexts(examples: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """``core``, ``span``, distances and covered bytes of one example of each undecided pair."""
    wanted = examples.groupBy("row").agg(F.collect_list(F.struct("core", "span", "at")).alias("wanted"))

    def cut(batches):
        for batch in batches:
            rows = []
            for data, list_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w in list_:
                    p, low, high = w["at"] >> 16, w["at"] >> 8 & 255, w["at"] & 255
                    rows.append((w["core"], w["span"], low, high, data[p - high:p - low + length]))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["core", "span", "low", "high", "bytes"])

    return (texts.join(wanted, "row").select("data", "wanted")
            .mapInArrow(cut, "core bigint, span bigint, low int, high int, bytes binary"))


def _rerank(undecided: DataFrame, contexts: DataFrame, width: int, length: int) -> DataFrame:
    """The next smaller ranges of undecided ones with the ranks of their cores and spans.

    Columns: the pair ``core``, ``span`` the range belongs to, ``low`` (of the fixed cut of
    distances), ``from`` and ``to`` (its own distances), ``inner`` and ``outer`` ranks.
    """
    def cut(batches):
        from xxhash import xxh3_64_intdigest as digest

        for batch in batches:
            rows = []
            for core, span, low, high, data, ranges in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                for begin, end in sorted((r["low"], r["high"]) for r in ranges):
                    for a in range(begin, end + 1, width):
                        b = a + width - 1
                        own_a, own_b = max(a, low), min(b, high)
                        if own_a <= own_b:  # the anchor is at ``high`` in ``data``
                            inner = digest(data[high - a:high - b + length], a)
                            outer = digest(data[high - own_b:high - own_a + length], own_b << 8 | own_a)
                            rows.append((core, span, a, own_a, own_b, inner, outer))
            c = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()),
                 *(pa.array(x, pa.int32()) for x in c[2:5]), *(pa.array(_signed(x)) for x in c[5:])],
                ["core", "span", "low", "from", "to", "inner", "outer"])

    ranges = undecided.groupBy("core", "span").agg(
        F.collect_list(F.struct("low", "high")).alias("ranges"))
    joined = contexts.join(ranges, ["core", "span"])
    return joined.select("core", "span", "low", "high", "bytes", "ranges").mapInArrow(
        cut, "core bigint, span bigint, low int, from int, to int, inner bigint, outer bigint")


def repeated_ranges(texts: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Positions of anchors whose core is repeated, and the ranges of starts that are repeats.

    ``texts`` has ``row`` (key) and ``data`` (binary). The first result has ``core``, ``span``,
    ``row`` and ``at``; the second ``core``, ``span``, ``from`` and ``to``.
    """
    # a batch has each pair once, so copies are summed before the shuffle; with all pairs of a core
    # in one place the window needs no further one, and it keeps them as rows
    counts = _rank_counts(texts, length).repartition("core")
    pairs = counts.groupBy("core", "span").agg(F.sum("n").alias("n"))
    same = Window.partitionBy("core")
    pairs = stored(pairs.select("core", "span", "n", F.sum("n").over(same).alias("all"),
                                F.count("*").over(same).alias("spans"))
                   .where("all > 1").drop("all"), "ranks")
    found = stored(_positions(texts, length).join(pairs, ["core", "span"]), "anchors")
    low, high = F.expr("cast(at >> 8 & 255 AS int)"), F.expr("cast(at & 255 AS int)")

    examples = found.where("spans > 1").groupBy("core", "span").agg(
        F.min(F.struct("row", "at")).alias("example"))
    contexts = stored(_contexts(examples.select("core", "span", "example.*"), texts, length)
                      .dropDuplicates(["core", "span"]), "contexts")
    repeats = [found.where("n > 1").select("core", "span", low.alias("from"), high.alias("to")).distinct()]
    undecided = contexts.select("core", "span", F.lit(0).alias("low"), F.lit(WIDTHS[0] - 1).alias("high"))
    for width in WIDTHS[1:]:
        ranges = stored(_rerank(undecided, contexts, width, length), f"ranges-{width}")
        pairs = ranges.groupBy("inner", "outer").agg(F.count("*").alias("n"))
        sizes = pairs.join(pairs.groupBy("inner").agg(F.count("*").alias("spans")), "inner")
        ranked = stored(ranges.join(sizes, ["inner", "outer"]), f"ranked-{width}")
        repeats.append(ranked.where("n > 1").select("core", "span", "from", "to"))
        undecided = ranked.where("spans > 1").select(
            "core", "span", "low", (F.col("low") + width - 1).alias("high"))
    # ranges that touch become one: nearly all pairs are left with a single one
    together = reduce(DataFrame.union, repeats).groupBy("core", "span").agg(
        F.sort_array(F.collect_set(F.struct("from", "to"))).alias("ranges"))
    joined = F.expr("""
        aggregate(ranges, slice(ranges, 1, 1), (done, r) -> if(
            r.from <= element_at(done, -1).to + 1,
            concat(slice(done, 1, size(done) - 1), array(named_struct(
                'from', element_at(done, -1).from, 'to', greatest(element_at(done, -1).to, r.to)))),
            concat(done, array(r))))""")
    return found.select("core", "span", "row", "at"), together.select("core", "span", F.inline(joined))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open intervals; those that touch become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def removable_spans(df: DataFrame, text: str = "text", *, length: int = LENGTH) -> DataFrame:
    """``df`` with ``spans``: array of the byte ranges ``begin``, ``end`` that repeats cover.

    Every byte is covered that lies in a string of ``length`` bytes which starts at another place
    too, in the same text or another. A null text counts as empty; shorter texts have no span;
    texts of rows that are repeated are covered whole. A column ``spans`` of ``df`` is replaced.
    An empty table gives an empty table.
    """
    data = text_of(text).cast("binary")
    key = F.xxhash64(data, F.lit("row"))
    # equal texts have one key; two of them make all of their bytes repeats
    copies = df.select(key.alias("row"), data.alias("data"))
    positions, ranges = repeated_ranges(copies, length)
    spans = (positions.join(ranges, ["core", "span"])
             .select("row", (F.expr("(at >> 16)") - F.col("to")).alias("begin"),
                     (F.expr("(at >> 16)") - F.col("from") + length).alias("end"))
             # a set: rows with one text have one key, and each brings the same spans
             .groupBy("row").agg(F.collect_set(F.struct("begin", "end")).alias("_spans")))
    kept = df.drop("spans")
    joined = kept.withColumn("_row", key).join(
        spans.withColumnRenamed("row", "_row"), "_row", "left").drop("_row")
    return joined.withColumnRenamed("_spans", "spans")


def cut_text(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]])


def without_repeats(df: DataFrame, text: str = "text", *, length: int = LENGTH,
                    as_text: bool = False) -> DataFrame:
    """``df`` with its texts cut: every byte of a repeat goes.

    Added columns: ``spans`` (array of ``begin``, ``end``, merged), ``n_bytes`` (before) and ``kept``,
    what is left: binary, or with ``as_text`` a string without the characters that a cut goes
    through. Columns of these names are replaced. See ``removable_spans``.
    """
    found = removable_spans(df, text, length=length)
    fields = [f for f in found.schema if f.name not in ("spans", "n_bytes", "kept")]
    span = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()),
                                     T.StructField("end", T.LongType())]))
    schema = T.StructType([*fields, T.StructField("spans", span), T.StructField("n_bytes", T.LongType()),
                           T.StructField("kept", T.StringType() if as_text else T.BinaryType())])
    names = [f.name for f in fields]

    def cut(batches):
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name))
            all_spans, sizes, left = [], [], []
            ranges = get("spans")
            ends, flat = ranges.value_lengths().fill_null(0).to_numpy().cumsum(), ranges.flatten()
            begin, end = (flat.field(k).to_numpy() for k in (0, 1))
            for value, last, n in zip(get(text).to_pylist(), ends.tolist(),
                                      np.diff(ends, prepend=0).tolist(), strict=True):
                data = (value or "").encode()
                spans = merged(list(zip(begin[last - n:last].tolist(), end[last - n:last].tolist(), strict=True)))
                all_spans.append([{"begin": a, "end": b} for a, b in spans])
                sizes.append(len(data))
                kept = cut_text(data, spans)
                left.append(kept.decode("utf-8", "ignore") if as_text else kept)
            yield pa.RecordBatch.from_arrays(
                [*(get(n) for n in names),
                 pa.array(all_spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                 pa.array(sizes, pa.int64()), pa.array(left, pa.string() if as_text else pa.binary())],
                [*names, "spans", "n_bytes", "kept"])

    return found.mapInArrow(cut, schema)
