"""Alignment of two tokenizations, with counts of linked id pairs from inverted bitmaps.

A text with a blank in front is tokenized by a byte-level BPE (A) and by a sentencepiece BPE with
byte fallback (B). Offsets where tokens of both end cut them into groups; the two tokens that end
there are linked.

Tokens never reach over a single blank or line feed between visible characters, as ``Aligner``
makes sure of from the vocabularies. So a text is cut there into units, units are aligned once in
each Python worker, and a text is the sequence of its units.

Counts come from an inverted index. The documents of a task are numbered in blocks of bounded size.
For each id pair a block has a bitmap of the documents that hold it, and one for each binary digit
of how often they do (multiplicity planes): the document bitmap is the OR of its planes, a pair has
as many documents as bits in it, and as many links as the sum of its planes' bits, each times its
power of two. Bitmaps are compressed: the numbers of the documents where these are few, bits
elsewhere. Blocks have no document in common, so their counts add up. The counts then go back to
the postings, and the postings return them to the documents of their block.

What is shuffled is one row for each pair and block, whatever a pair's number of links: a pair that
a third of all links have is no more rows than any other pair that every block knows.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pressflow.llm.support import shared, stored, text_of

#: Documents and links after which a block is closed; a document's number in it has 15 bits.
BLOCK_DOCS, BLOCK_LINKS = 32_768 - 32, 4_000_000
#: Units that a worker remembers.
CACHE_UNITS = 300_000

#: A unit begins at a blank or line feed between visible characters.
_UNITS = re.compile(r"(?<=\S)(?=[ \n]\S)")
_TWO_BLANKS = re.compile(r"\s\s")
_PAIR_SHIFT = 16
#: Texts whose new units are tokenized together.
TEXTS = 32


def _byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = sorted(set(range(256)) - set(visible))
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Aligned units and their numbers; lives in a Python worker."""

    def __init__(self, tokenizer_json: str, sentencepiece_model: bytes):
        self.tokenizer_json, self.sentencepiece_model = tokenizer_json, sentencepiece_model
        self._forget_all()

    def _forget_all(self):
        self.a = self.b = None
        self.forget()

    def __getstate__(self):
        return {"tokenizer_json": self.tokenizer_json, "sentencepiece_model": self.sentencepiece_model}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget_all()

    def forget(self) -> None:
        """Number units anew; numbers given before are void."""
        self.numbers: dict[str, int] = {}
        self.groups: list[str] = []
        #: Four numbers for each unit: tokens of A and of B, groups, and whether the tokens give it back.
        self.sizes = array("q")
        #: The linked pairs of all units, one after the other; a unit has as many as groups.
        self.links = array("q")

    def _open(self) -> None:
        import os

        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(self.tokenizer_json)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        settings = json.loads(self.tokenizer_json)
        split = settings["pre_tokenizer"] or {}
        if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) \
                or settings.get("normalizer"):
            raise ValueError("A must be a byte-level BPE that splits by pattern and adds no blank")
        alphabet = _byte_alphabet()
        ordered = sorted(settings["model"]["vocab"].items(), key=lambda t: t[1])
        self.a_bytes = [bytes(alphabet.get(c, 0) for c in t) for t, _ in ordered]
        self.b = SentencePieceProcessor(model_proto=self.sentencepiece_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("\n" in p or "▁" in p.lstrip("▁") for p in pieces) or "▁" not in pieces:
            raise ValueError("B has a piece that reaches over a blank or a line feed")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.lengths = [np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes)]
        # how an id is written: within its side of a group, and as the last of its side
        self.written = [[f"{i}{mark}" for i in range(len(side)) for mark in (",", end)]
                        for side, end in ((self.a_bytes, "|"), (self.b_bytes, ";"))]
        self.written = self.written[0] + self.written[1]

    def _tokens(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of a text by A and by B, or None if they do not give it back.

        The text begins with a blank or line feed. B writes a blank in front, which is that of the
        text if it has one, and else a token of its own, as no piece reaches over a line feed.
        """
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = self.b.encode(text[1:]) if text[0] == " " else self.b.encode(text)[1:]
        data = text.encode()
        whole = (b"".join(map(self.a_bytes.__getitem__, a)) == data
                 and b"".join(map(self.b_bytes.__getitem__, b)) == data)
        return (a, b) if whole else None

    def _align(self, raw: list[str]) -> bool:
        """Align and number units that follow each other; false if their tokens do not give them back."""
        found = self._tokens("".join(raw))
        if found is None:
            return False
        ids = [np.array(side, np.int64) for side in found]
        ends = [np.cumsum(length[side]) for length, side in zip(self.lengths, ids, strict=True)]
        cuts = np.intersect1d(*ends, assume_unique=True)
        last = [np.searchsorted(end, cuts) for end in ends]
        unit_ends = np.cumsum([len(r.encode()) for r in raw])
        group_end = np.searchsorted(cuts, unit_ends) + 1
        if not np.array_equal(cuts[group_end - 1], unit_ends):
            return False
        # ids as they are written, by group: first those of A
        marks, groups = [], []
        for side, at in zip(ids, last, strict=True):
            is_last = np.zeros(len(side), np.int64)
            is_last[at] = 1
            marks.append(2 * side + is_last)
            groups.append(np.cumsum(is_last) - is_last)
        order = np.argsort(np.concatenate((2 * groups[0], 2 * groups[1] + 1)), kind="stable")
        codes = np.concatenate((marks[0], marks[1] + 2 * len(self.a_bytes)))[order]
        parts = list(map(self.written.__getitem__, codes.tolist()))
        n = [np.diff(at[group_end - 1] + 1, prepend=0) for at in last]
        n_groups = np.diff(group_end, prepend=0)
        part_ends = np.cumsum(n[0] + n[1]).tolist()
        start = 0
        for end in part_ends:
            self.groups.append("".join(parts[start:end])[:-1])
            start = end
        self.sizes.frombytes(np.stack((*n, n_groups, np.ones_like(n_groups)), axis=1).astype(np.int64).tobytes())
        self.links.frombytes((ids[0][last[0]] << _PAIR_SHIFT | ids[1][last[1]]).tobytes())
        return True

    def _learn(self, raw: dict[str, str]) -> None:
        """Align and number units, given as key and text. Plain ones are one text together."""
        if self.a is None:
            self._open()
        plain = {k: r for k, r in raw.items() if " " not in k}
        odd = {k: r for k, r in raw.items() if " " in k}
        for units in ([plain] if plain else []) + [{k: r} for k, r in odd.items()]:
            at = len(self.groups)
            if self._align(list(units.values())):
                self.numbers.update(zip(units, range(at, len(self.groups)), strict=True))
                continue
            for key, text in units.items():  # one of them is not given back; alone, the others are
                self.numbers[key] = len(self.groups)
                if len(units) == 1 or not self._align([text]):
                    self.groups.append("")
                    self.sizes.extend((0, 0, 0, 0))

    def _cut(self, text: str) -> list[tuple[str, str]] | None:
        """Keys and texts of the units of a text with more white space than between words.

        None if there is just one blank or line feed between visible characters each time.
        """
        if not (text[0].isspace() or text[-1].isspace() or _TWO_BLANKS.search(text)):
            return None
        raw = _UNITS.split(" " + text)
        # a unit that a plain text can have gets its key there, any other one a key with a blank
        return [(r if r[0] == "\n" else r[1:], r) if self._plain(r) else (" " + r, r) for r in raw]

    @staticmethod
    def _plain(raw: str) -> bool:
        word = raw[1:]
        return not (" " in word or "\n" in word[:1] or word[:1].isspace() or word[-1:].isspace()) and bool(word)

    def units(self, texts: list[str]) -> list[list[int]]:
        """Numbers of the units of each text, which are not empty.

        A key without a blank stands for the unit with a blank in front, or with the line feed it
        begins with. What is not known yet is learned for all texts together.
        """
        known, keys, missing = self.numbers.get, [], {}
        for text in texts:
            mine = text.replace("\n", " \n").split(" ")
            found = list(map(known, mine))
            if None in found:
                cut = self._cut(text)
                if cut is None:
                    missing.update((k, k if k[0] == "\n" else " " + k)
                                   for k, n in zip(mine, found, strict=True) if n is None)
                else:
                    mine = [k for k, _ in cut]
                    missing.update((k, r) for k, r in cut if k not in self.numbers)
            keys.append(mine)
        if missing:
            self._learn(missing)
        return [list(map(self.numbers.__getitem__, mine)) for mine in keys]

    @property
    def crowded(self) -> bool:
        return len(self.groups) > CACHE_UNITS


def encode_bitmaps(starts: np.ndarray, docs: np.ndarray) -> pa.Array:
    """Binary values of runs of sorted document numbers: the numbers, or bits where these are shorter.

    Values of an even length are numbers of 16 bits, those of an odd length a zero byte and bits.
    """
    lengths = np.diff(np.append(starts, len(docs)))
    last = docs[starts + lengths - 1].astype(np.int64) if len(starts) else np.empty(0, np.int64)
    size = last // 16 * 2 + 2  # bytes of the bits, an even number
    dense = size + 1 < 2 * lengths
    if not dense.any():
        offsets = np.append(starts, len(docs)).astype(np.int32) * 2
        return pa.Array.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(docs.astype("<u2").tobytes())])
    raw, out = docs.astype("<u2"), []
    for s, n, d, bytes_ in zip(starts.tolist(), lengths.tolist(), dense.tolist(), size.tolist(), strict=True):
        if d:
            bits = np.zeros(bytes_ * 8, np.uint8)
            bits[raw[s:s + n]] = 1
            out.append(b"\0" + np.packbits(bits, bitorder="little").tobytes())
        else:
            out.append(raw[s:s + n].tobytes())
    return pa.array(out, pa.binary())


def decode_bitmap(value: bytes) -> np.ndarray:
    """The document numbers of a bitmap, sorted."""
    if len(value) % 2:
        return np.flatnonzero(np.unpackbits(np.frombuffer(value, np.uint8, offset=1), bitorder="little"))
    return np.frombuffer(value, "<u2").astype(np.int64)


def block_postings(kinds: np.ndarray, of: np.ndarray, docs: np.ndarray) -> tuple[list[pa.Array], int]:
    """Columns ``a``, ``b``, ``plane``, ``bits``, ``n_bits`` of a block's links, and their rows.

    A link is the place of its pair in the sorted ``kinds`` and its document. Plane -1 is the
    document bitmap, the OR of the others.
    """
    held, times = np.unique(of.astype(np.int64) << 15 | docs, return_counts=True)
    columns, rows = [[], [], [], [], []], 0
    for plane in range(-1, int(times.max(initial=0)).bit_length()):
        entry = held if plane < 0 else held[times >> plane & 1 == 1]
        if not len(entry):
            continue
        pair, doc = entry >> 15, entry & 32_767
        starts = np.flatnonzero(np.diff(pair, prepend=-1))
        kind = kinds[pair[starts]]
        values = (pa.array(kind >> _PAIR_SHIFT, pa.int32()), pa.array(kind & (1 << _PAIR_SHIFT) - 1, pa.int32()),
                  pa.array(np.full(len(starts), plane), pa.int32()), encode_bitmaps(starts, doc),
                  pa.array(np.diff(np.append(starts, len(pair))), pa.int64()))
        for column, value in zip(columns, values, strict=True):
            column.append(value)
        rows += len(starts)
    return [pa.concat_arrays(c) if c else None for c in columns], rows


class Block:
    """Documents of a task until their block is closed."""

    def __init__(self):
        self.ids, self.units, self.digests, self.n_units = [], [], [], 0

    def add(self, doc_id, units: list[int], digest: str) -> None:
        self.ids.append(doc_id)
        self.units.append(np.array(units, np.int64))
        self.digests.append(digest)
        self.n_units += len(units)

    @property
    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or 2 * self.n_units >= BLOCK_LINKS


_POSTING = [T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
            T.StructField("plane", T.IntegerType()), T.StructField("bits", T.BinaryType()),
            T.StructField("n_bits", T.LongType())]
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def aligned(df: DataFrame, tokenizer_json: str, sentencepiece_model: bytes, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """Rows of two kinds, to be stored: documents (``plane`` null) and postings (``doc`` null).

    Both have ``block``; ``doc`` numbers the documents in their block. A document has its id, ``n_a``,
    ``n_b``, ``n_groups``, ``n_links`` and ``groups_sha256``; a posting ``a``, ``b``, ``plane``,
    ``bits`` and ``n_bits``.
    """
    worker = shared(df.sparkSession, Aligner(tokenizer_json, sentencepiece_model))
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("doc", T.IntegerType()),
        T.StructField("doc_id", df.schema[doc_id].dataType), *(T.StructField(n, T.LongType()) for n in _COUNTS),
        T.StructField("groups_sha256", T.StringType()), *_POSTING])
    kinds = [to_arrow_type(f.dataType) for f in schema]
    n_posting = len(_POSTING)

    def rows(block: Block, number: int, aligner: Aligner) -> Iterator[pa.RecordBatch]:
        lengths = np.array([len(u) for u in block.units], np.int64)
        units = np.concatenate(block.units)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        sizes = np.frombuffer(aligner.sizes, np.int64).reshape(-1, 4)
        broken = np.bincount(owner, sizes[units, 3] == 0, len(lengths)) > 0
        counts = [np.bincount(owner, sizes[units, c], len(lengths)).astype(np.int64) * ~broken for c in (0, 1, 2, 2)]
        digests = ["" if x else d for d, x in zip(block.digests, broken.tolist(), strict=True)]
        n = len(lengths)
        values = [np.full(n, number), np.arange(n), block.ids, *counts, digests]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, kind) for v, kind in zip(values, kinds, strict=False)]
            + [pa.nulls(n, kind) for kind in kinds[-n_posting:]], schema.names)
        # the links of every occurrence of a unit
        kinds_, flat = np.unique(np.frombuffer(aligner.links, np.int64), return_inverse=True)
        n_links = sizes[:, 2]
        whole = ~broken[owner]
        units, owner = units[whole], owner[whole]
        each, first = n_links[units], np.cumsum(n_links) - n_links
        within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        columns, n = block_postings(kinds_, flat[np.repeat(first[units], each) + within], np.repeat(owner, each))
        if n:
            arrays = [pa.array(np.full(n, number), pa.int64()), *(pa.nulls(n, kind) for kind in kinds[1:-n_posting]),
                      *columns]
            yield from pa.Table.from_arrays(arrays, schema.names).to_batches(max_chunksize=20_000)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, number, aligner = Block(), TaskContext.get().partitionId() << 32, worker()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                texts = part.column(1).to_pylist()
                found = iter(aligner.units([t for t in texts if t]))
                for i, text in zip(part.column(0).to_pylist(), texts, strict=True):
                    units = next(found) if text else []
                    joined = ";".join(map(aligner.groups.__getitem__, units))
                    block.add(i, units, sha256(joined.encode()).hexdigest() if units else "")
                if block.full or aligner.crowded:
                    yield from rows(block, number, aligner)
                    block, number = Block(), number + 1
                    if aligner.crowded:
                        aligner.forget()
        if block.ids:
            yield from rows(block, number, aligner)

    return df.select(F.col(doc_id), text_of(text)).mapInArrow(align, schema)


def pair_counts(found: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n_docs`` and ``n_links`` of each linked id pair, from the bits of its postings."""
    bits, plane = F.col("n_bits"), F.col("plane")
    return found.where("plane IS NOT NULL").groupBy("a", "b").agg(
        F.sum(F.when(plane < 0, bits).otherwise(0)).alias("n_docs"),
        F.sum(F.when(plane >= 0, bits * F.pow(F.lit(2.0), plane).cast("long")).otherwise(0)).alias("n_links"))


def _returned(postings: DataFrame) -> DataFrame:
    """``block``, ``doc``, ``n_best`` and ``count_sum``: what the postings of a block give its documents."""
    schema = "block long, doc int, n_best long, count_sum long"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, best, total = None, None, None

        def out() -> pa.RecordBatch:
            docs = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(docs), current), pa.int64()), pa.array(docs, pa.int32()),
                 pa.array(best[docs], pa.int64()), pa.array(total[docs], pa.int64())],
                ["block", "doc", "n_best", "count_sum"])

        for batch in batches:
            for block, plane, bits, links, top in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != current:
                    if current is not None:
                        yield out()
                    current, best, total = block, np.zeros(32_768, np.int64), np.zeros(32_768, np.int64)
                docs = decode_bitmap(bits)
                total[docs] += links << plane
                if top:
                    best[docs] += 1 << plane
        if current is not None:
            yield out()

    by_block = postings.select("block", "plane", "bits", "n_links", "best").repartition("block")
    return by_block.sortWithinPartitions("block").mapInArrow(sums, schema)


def align_texts(df: DataFrame, tokenizer_json: str, sentencepiece_model: bytes, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """One row for each row of ``df``: its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum`` and ``groups_sha256``.

    ``n_best`` counts the links whose pair has its B id's highest count of all documents, ties
    included, and ``count_sum`` sums the counts of the links. A null or empty text, and one that the
    tokens of A or B do not give back, has zeros and an empty digest and adds to no count. Repeated
    rows are documents of their own, null ids too; an empty table gives an empty result; other
    columns are left out.
    """
    found = stored(aligned(df, tokenizer_json, sentencepiece_model, doc_id, text), "aligned")
    counts = pair_counts(found)
    most = counts.groupBy("b").agg(F.max("n_links").alias("most"))
    ranked = stored(counts.join(most, "b").select(
        "a", "b", "n_links", (F.col("n_links") == F.col("most")).alias("best")), "pairs")
    planes = found.where(F.col("plane") >= 0).select("block", "a", "b", "plane", "bits")
    sums = _returned(planes.join(ranked, ["a", "b"]))
    docs = found.where("plane IS NULL").select("block", "doc", "doc_id", *_COUNTS, "groups_sha256")
    zero = F.lit(0).cast("long")
    return docs.join(sums, ["block", "doc"], "left").select(
        F.col("doc_id").alias(doc_id), *_COUNTS, F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
