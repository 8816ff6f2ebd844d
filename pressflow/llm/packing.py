"""Packing of tokenized documents into windows by best fit, longest pieces first.

A document's tokens, closed by an end id, are cut into full windows and a rest. A full window is a
sequence of its own. The rests are packed without further cuts: from the longest to the shortest,
each goes into the open window with the least room that still holds it. A segment tree over the
possible amounts of room, 0 to the window's length, finds that window in a few steps.

Rests are dealt at random over groups of bounded size, one for each task, and packed within their
group; best fit over tens of thousands of rests leaves next to no room. Only lengths, offsets and
checksums are shuffled, never token ids. Cutting, which needs the ids, is done where the text is read.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressflow.llm.support import shared, stored

WINDOW = 2048
END_ID = 1
#: Pieces that one task packs.
GROUP_PIECES = 65_536
#: Entries of a worker's cache of chunks; the longest chunk in it.
CACHE_CHUNKS = 1_000_000
CACHED_CHARS = 64
#: Texts whose new chunks are encoded together.
TEXTS = 32

def _byte_table() -> dict[int, int]:
    """From the characters that byte-level vocabularies write bytes with to these bytes."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {256 + i: b for i, b in enumerate(sorted(set(range(256)) - set(visible)))}


_BYTES = _byte_table()


#: A full stop or comma alone at the end of a chunk, after a letter: the model parts it from the word.
_POINT = re.compile(r"(?<=[a-z])([.,])(?=\s)")


class ChunkIds:
    """Token ids of the white-space separated chunks of texts; lives in a Python worker.

    The model's words never reach over white space, so chunks are encoded independently.
    """

    def __init__(self, tokenizer_json: str):
        self.tokenizer_json = tokenizer_json
        self.special = [t["content"].lower() for t in json.loads(tokenizer_json).get("added_tokens", [])]
        self.tokenizer, self.cache = None, {}

    def __getstate__(self):
        return {"tokenizer_json": self.tokenizer_json, "special": self.special, "tokenizer": None, "cache": {}}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        if self.tokenizer is None:
            import os

            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.tokenizer = Tokenizer.from_str(self.tokenizer_json)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            self.tokens = [t.removesuffix("</w>").translate(_BYTES).encode("latin-1", "replace") for t, _ in
                           sorted(self.tokenizer.get_vocab().items(), key=lambda t: t[1])]
            self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        return self._cut(texts) or [ids.tobytes() for ids in self._ids(texts)]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _cut(self, chunks: list[str]) -> list[bytes] | None:
        """Ids of chunks that are encoded as one text, cut where the bytes of a chunk end.

        The library's work on one text of many chunks is far less than on as many texts. None if
        the ids do not stand for the chunks as the model reads them (lower-case, composed).
        """
        joined = " ".join(chunks)
        ids = self._ids([joined])[0]
        if joined.isascii():
            read, sizes = joined.lower().replace(" ", "").encode(), list(map(len, chunks))
        else:
            parts = [unicodedata.normalize("NFC", c).lower().encode() for c in chunks]
            read, sizes = b"".join(parts), list(map(len, parts))
        if b"".join(map(self.tokens.__getitem__, ids.tolist())) != read:
            return None
        ends = np.cumsum(sizes)
        token_ends = np.cumsum(self.sizes[ids])
        at = np.searchsorted(token_ends, ends)
        if not np.array_equal(token_ends[at], ends):
            return None
        data, cuts = ids.tobytes(), [0, *(4 * (at + 1)).tolist()]
        return [data[s:e] for s, e in zip(cuts, cuts[1:], strict=False)]

    def _chunks(self, text: str) -> list[str]:
        """White-space separated chunks in which A-Z are lower-case, as the model reads them, so that
        more of them are the same; as written where that would make a special string."""
        lower = text.encode().lower().decode()
        return (text if any(s in lower for s in self.special) else _POINT.sub(r" \1", lower)).split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as unsigned 32-bit little-endian numbers."""
        # str.split also splits at four control characters that are no white space to the model
        whole = {i for i, t in enumerate(texts) if any(c in t for c in "\x1c\x1d\x1e\x1f")}
        chunked = [[] if i in whole else self._chunks(t) for i, t in enumerate(texts)]
        found = [list(map(self.cache.get, chunks)) for chunks in chunked]
        missing = list(dict.fromkeys(
            c for chunks, ids in zip(chunked, found, strict=True) if None in ids
            for c, f in zip(chunks, ids, strict=True) if f is None))
        new = dict(zip(missing, self._encoded(missing), strict=True)) if missing else {}
        if len(self.cache) < CACHE_CHUNKS:
            self.cache.update((c, f) for c, f in new.items() if len(c) <= CACHED_CHARS)
        out = [b"".join([new[c] if f is None else f for c, f in zip(chunks, ids, strict=True)] if None in ids else ids)
               for chunks, ids in zip(chunked, found, strict=True)]
        for i in whole:
            out[i] = self._encoded([texts[i]])[0]
        return out


class Rooms:
    """Segment tree over amounts of room: how many open windows have each amount."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, which: int) -> None:
        self.open[room].append(which)
        self._change(room, 1)

    def take(self, needed: int) -> tuple[int, int] | None:
        """The window with the least room that is enough, and its room; None if there is none."""
        node = needed + self.leaves
        if not self.count[node]:
            # up to the first subtree to the right that has an open window, then down its left edge
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                node += not self.count[node]
        room = node - self.leaves
        self._change(room, -1)
        return self.open[room].pop(), room

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1


def best_fit_decreasing(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """Sequence and offset of each piece; equal lengths go in their given order."""
    rooms, placed, sequences = Rooms(window), [(0, 0)] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[i])
        if found is None:
            found, sequences = (sequences, window), sequences + 1
        which, room = found
        placed[i] = which, window - room
        if room > lengths[i]:
            rooms.add(room - lengths[i], which)
    return placed


def token_pieces(df: DataFrame, tokenizer_json: str, doc_id: str = "doc_id", text: str = "text", *,
                 window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The pieces of each document: full windows and a rest that is never empty.

    Columns: ``piece`` (unique), the id column, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``
    and, with ``with_ids``, ``ids`` (unsigned 32-bit little-endian). Each row of ``df`` is a
    document, repeated rows and null ids included; a null text counts as empty and has the end id
    alone. A document that ends on a window has no rest. Other columns of ``df`` are left out.
    """
    worker = shared(df.sparkSession, ChunkIds(tokenizer_json))
    end, id_type = end_id.to_bytes(4, "little"), df.schema[doc_id].dataType
    fields = [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, owners = [], []
            texts = [value or "" for value in batch.column(1).to_pylist()]
            encoded = (ids for at in range(0, len(texts), TEXTS) for ids in worker().encode(texts[at:at + TEXTS]))
            for i, ids in enumerate(encoded):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start:4 * (start + window)]
                    rows.append((start, len(part) // 4, zlib.crc32(part), total, part))
                    owners.append(i)
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
            if with_ids:
                arrays.append(pa.array(columns[4], pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owners, pa.int64())), *arrays],
                [doc_id, *(f.name for f in fields)])

    schema = T.StructType([T.StructField(doc_id, id_type), *fields])
    pieces = df.select(F.col(doc_id), F.col(text)).mapInArrow(cut, schema)
    return pieces.select(F.monotonically_increasing_id().alias("piece"), "*")


def pack(pieces: DataFrame, *, length: str = "length", window: int = WINDOW,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, packed by best fit.

    Rows should be narrow: a task holds ``group_pieces`` of them on average. Lengths are 1 to
    ``window``. Columns of these names are replaced. An empty table gives an empty table.
    """
    pieces = pieces.drop("sequence_id", "offset")
    groups = max(1, -(-pieces.count() // group_pieces))
    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def packed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId()
        batches = list(frames)
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        placed = best_fit_decreasing(rows.column(length).to_pylist(), window)
        # a group's sequences are numbered apart from those of all others
        rows = rows.append_column("sequence_id", pa.array([s * groups + group for s, _ in placed], pa.int64()))
        rows = rows.append_column("offset", pa.array([o for _, o in placed], pa.int64()))
        yield from rows.to_batches(max_chunksize=10_000)

    return pieces.repartition(groups).mapInArrow(packed, schema)


def pack_documents(df: DataFrame, tokenizer_json: str, doc_id: str = "doc_id", text: str = "text",
                   *, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each document, with the sequence and offset it is packed at."""
    pieces = stored(token_pieces(df, tokenizer_json, doc_id, text, window=window, end_id=end_id),
                    "pieces")
    return pack(pieces, window=window).drop("piece")


def sequences(pieces: DataFrame, packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """The packed token sequences themselves: ``sequence_id``, ``n_tokens`` and ``ids`` (binary).

    ``pieces`` is a stored table made with ``with_ids``; ``packed`` is what ``pack`` made of its
    narrow columns. A sequence holds at most ``window`` ids, and the last one is not padded.
    """
    placed = packed.select("piece", "sequence_id", "offset")
    parts = pieces.select("piece", "length", "ids").join(placed, "piece")
    return parts.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.expr("aggregate(array_sort(collect_list(struct(offset, ids))), x'', "
               "(joined, part) -> concat(joined, part.ids))").alias("ids"))
