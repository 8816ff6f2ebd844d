"""Language-model scoring with a hierarchical Pitman-Yor model whose seating is sampled by Gibbs.

The model has three layers of restaurants. Each word (or a text's start) is the restaurant of the
words that follow it. Their parent is the word restaurant: words are its dishes, each table of the
words that follow is its customer, and what it has not served is drawn from a spelling model, in which each context of up to three preceding bytes of the word is
a restaurant. Like the base score, the model knows the words of the learned texts and one type for
all others; that type has the probability of being served a new dish that is none of those words.
A context's parent is the context shortened by its farthest byte, so contexts that end
alike share their parents, up to the restaurant without context, whose base is uniform over the 256
bytes and the word's end. Every table of a restaurant is a customer of its parent, and each table of
the word restaurant spells its word once. Within contexts bytes count by class (32 classes), which
bounds the number of restaurants, and with it the size of the spelling model, whatever the corpus.

A sweep samples the seating: a dish's customers are taken out and seated again one by one, given the
other tables and the parent's predictive probability. First come the words (their tables need the
spelling model), then the pairs of words, then the spelling contexts from the longest to the
shortest. A pair seen once has one table, so only the others are seated. Over the sweeps after the
burn-in the words' predictive probabilities, and the tables of pairs and of their restaurants, are
averaged; scores and perplexities are made of the averages.

Words are counted over the whole corpus. Texts are read once: each task numbers the words of a block
of texts and stores the block as numbers, with the keys of its words. Pairs are summed within a block
and then by buckets of their words' keys; a block gets back a number for each of its pairs, in the
order it sent them. The vocabulary is cut into parts by key. Buckets and blocks ask each part for
what their words have there, and buckets tell it their tables, as packed columns, so no row is made
of a pair or of a block's word but to count the vocabulary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressflow.llm import support
from pressflow.llm.support import discard, shared, text_of

SWEEPS, BURN_IN, SEED = 3, 1, 11
#: Strength of all restaurants; discounts of the contexts by their length.
STRENGTH = 1.0
CONTEXT_DISCOUNTS = (0.5, 0.5, 0.6, 0.7)
#: Rounds in which a context's restaurants are seated within a sweep.
ROUNDS = 2
#: Bytes of text whose words are numbered together; a row counts as some more, and words are found
#: in smaller parts.
BLOCK_BYTES, ROW_BYTES, PART_BYTES = 16_000_000, 64, 2_000_000
#: Words that are seated or counted together, and their bytes.
RUN_WORDS, RUN_BYTES = 60_000, 1_000_000
#: Buckets of pairs for each block, and the share of all tokens from which a word's pairs are spread.
BUCKETS_A_BLOCK = 2
SPREAD_SHARE = 0.001

CLASSES, SYMBOLS = 32, 257
#: Customers that are seated one by one before tables are skipped to.
_SINGLE = 32


def _classes() -> np.ndarray:
    """Class of each byte: start 0, letters 1-26, digits 27, other ASCII 28, and by UTF-8 place."""
    of = np.full(257, 28, np.int64)
    of[ord("a"):ord("z") + 1] = np.arange(1, 27)
    of[ord("0"):ord("9") + 1] = 27
    of[0x80:0xA0], of[0xA0:0xC0], of[0xC0:256], of[256] = 30, 31, 29, 0
    return of


def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Cell (context and symbol) of each byte and end of the words, and where each word begins."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(lengths) - lengths
    symbols = np.full(int(lengths.sum()), 256, np.int64)
    inner = np.ones(len(symbols), bool)
    inner[starts + lengths - 1] = False
    symbols[inner] = np.frombuffer(b"".join(words), np.uint8)
    kinds = _classes()[symbols]  # a word's end has the class of a start, and stands before the next
    context = np.zeros(len(symbols), np.int64)
    place = np.arange(len(symbols)) - np.repeat(starts, lengths)
    for back in (1, 2, 3):
        before = np.zeros(len(symbols), np.int64)
        before[back:] = kinds[:-back]
        context += np.where(place >= back, before, 0) * CLASSES ** (back - 1)
    return context * SYMBOLS + symbols, starts


class Draws:
    """Random numbers for dishes of several batches, each batch's from a generator of its own."""

    def __init__(self, rngs: list[np.random.Generator], lengths: list[int]):
        self.rngs, self.ends = rngs, np.cumsum(lengths)

    def at(self, here: np.ndarray) -> np.ndarray:
        cuts = np.searchsorted(here, self.ends).tolist()
        return np.concatenate([rng.random(b - a) for rng, a, b in zip(self.rngs, [0, *cuts], cuts) if b > a])


def seat(rng: np.random.Generator | Draws, customers: np.ndarray, base: np.ndarray, others: np.ndarray,
         strength: float, discount: float) -> np.ndarray:
    """Tables that the customers of each dish take, seated one by one.

    ``others`` is the number of tables with other dishes. A customer takes a new table in proportion
    to ``(strength + discount * tables) * base``, else one of the dish's tables in proportion to
    its customers less the discount. After the first customers, the number of the one who takes the
    next new table is drawn at once, from the continuous form of its distribution.
    """
    draws = rng.at if isinstance(rng, Draws) else lambda here: rng.random(len(here))
    tables = np.minimum(customers, 1).astype(np.int64)
    for seated in range(1, min(_SINGLE, int(customers.max(initial=0)))):
        here = np.flatnonzero(customers > seated)
        t = tables[here]
        new = (strength + discount * (others[here] + t)) * base[here]
        tables[here] += draws(here) * (seated - discount * t + new) < new
    here = np.flatnonzero(customers > _SINGLE)
    at = np.full(len(here), float(_SINGLE))
    while len(here):
        t = tables[here]
        new = np.maximum((strength + discount * (others[here] + t)) * base[here], 1e-300)
        shift = (new - 1) / 2 - discount * t
        with np.errstate(over="ignore"):
            at = np.maximum(np.ceil((at + shift) * draws(here) ** (-1 / new) - shift), at)
        more = at < customers[here]
        here, at = here[more], at[more] + 1
        tables[here] += 1
    return np.minimum(tables, customers)


def predictive(customers, tables, base, strength: float, discount: float):
    """Probability of each dish; dishes are in the last axis."""
    total, all_tables = customers.sum(-1, keepdims=True), tables.sum(-1, keepdims=True)
    return (customers - discount * tables + (strength + discount * all_tables) * base) / (strength + total)


def seat_contexts(rng: np.random.Generator, counts: np.ndarray, root: np.ndarray):
    """Seat all contexts whose last byte has one class.

    ``counts`` has the customers of the longest contexts (two farther classes, class before that,
    symbol); ``root`` is the predictive probability without context. Returns the tables of the
    one-byte context and, for the longest contexts, the probability that a dish has of its own, the
    share that is left to the parent, and the parents' probabilities.
    """
    _, d1, d2, d3 = CONTEXT_DISCOUNTS
    three = counts.reshape(CLASSES, CLASSES, SYMBOLS)  # farthest, middle
    t3 = np.minimum(three, 1)
    two = t3.sum(axis=0)
    t2 = np.minimum(two, 1)
    one = t2.sum(axis=0)
    t1 = np.minimum(one, 1)

    def again(c, t, base, discount):
        filled = np.nonzero(c)
        others = np.broadcast_to(t.sum(-1, keepdims=True), c.shape)[filled] - t[filled]
        out = np.zeros_like(t)
        out[filled] = seat(rng, c[filled], np.broadcast_to(base, c.shape)[filled], others, STRENGTH, discount)
        return out

    for _ in range(ROUNDS):
        p1 = predictive(one, t1, root, STRENGTH, d1)
        p2 = predictive(two, t2, p1, STRENGTH, d2)
        t3 = again(three, t3, p2, d3)
        two = t3.sum(axis=0)
        t2 = again(two, np.minimum(t2, two), p1, d2)
        one = t2.sum(axis=0)
        t1 = again(one, np.minimum(t1, one), root, d1)
    p1 = predictive(one, t1, root, STRENGTH, d1)
    p2 = predictive(two, t2, p1, STRENGTH, d2)
    total = STRENGTH + three.sum(axis=-1)
    own = (three - d3 * t3) / total[..., None]
    left = (STRENGTH + d3 * t3.sum(axis=-1)) / total
    return t1, own.reshape(counts.shape), left.ravel(), p2


@dataclass
class Spelling:
    """Predictive probabilities of the longest contexts.

    ``cells`` are those that were seen, in order, and ``own`` what they have of their own; ``left``
    is the share each context leaves to its parent, and ``parents`` holds the parents' probabilities.
    There are at most 32768 contexts of 257 symbols, of which a corpus shows a few in a hundred.
    """

    cells: np.ndarray
    own: np.ndarray
    left: np.ndarray
    parents: np.ndarray
    root: np.ndarray

    @cached_property
    def seen_logs(self) -> np.ndarray:
        return np.log(self._unseen(self.cells) + self.own)

    def _unseen(self, cells: np.ndarray) -> np.ndarray:
        context, symbol = np.divmod(cells, SYMBOLS)
        return self.left[context] * self.parents[context % CLASSES ** 2, symbol]

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0)
        cells, starts = spelled(words)
        if not len(self.cells):
            return np.add.reduceat(np.log(self._unseen(cells)), starts)
        at = np.minimum(np.searchsorted(self.cells, cells), len(self.cells) - 1)
        logs = self.seen_logs[at]
        other = np.flatnonzero(self.cells[at] != cells)
        logs[other] = np.log(self._unseen(cells[other]))
        return np.add.reduceat(logs, starts)


def stored(df: DataFrame, name: str) -> DataFrame:
    return support.stored(df, name, tidy=True)


def _rng(*key: int) -> np.random.Generator:
    return np.random.default_rng([SEED, *key])


#: What separates words, and bytes in lower case.
_GAP, _LOWER = np.zeros(256, bool), np.arange(256, dtype=np.uint8)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER[ord("A"):ord("Z") + 1] += 32
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _pack(values: np.ndarray) -> bytes:
    return len(values).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(
        np.ascontiguousarray(values).tobytes(), asbytes=True)


def _unpack(blob: bytes, kind) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little") * np.dtype(kind).itemsize
    return np.frombuffer(pa.Codec("zstd").decompress(blob[8:], size, asbytes=True), kind)


def _order(values: np.ndarray) -> np.ndarray:
    """The stable order of numbers from 0 on. Where they leave room for their places, both are sorted
    as one number, which is faster than to sort places."""
    bits = max(len(values) - 1, 0).bit_length()
    if int(values.max(initial=0)).bit_length() + bits > 63:
        return np.argsort(values, kind="stable")
    return np.sort(values.astype(np.int64) << bits | np.arange(len(values))) & ((1 << bits) - 1)


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of numbers from 0 on, sorted, and the place there of each."""
    order = _order(values)
    values = values[order]
    new = np.diff(values, prepend=-1) != 0
    where = np.empty(len(order), np.int64)
    where[order] = np.cumsum(new) - 1
    return values[new], where


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the place there of each; for keys that recur often."""
    at, distinct = pd.factorize(keys)
    order = np.argsort(distinct)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return distinct[order], rank[at]


def _mixed(h: np.ndarray) -> np.ndarray:
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _words(texts: list[bytes]):
    """The words of texts in lower case, and each text's end as an empty word: the bytes they lie in,
    where each begins, its length and its key (63 bits that are mixed of all its bytes), and how many
    each text has."""
    raw = _LOWER[np.frombuffer(b" ".join([*texts, bytes(8)]), np.uint8)]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    gap = _GAP[raw]
    gap[-9:] = True
    edges = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    begins, n = edges[0::2], edges[1::2] - edges[0::2]
    after = np.searchsorted(begins, np.cumsum(lengths + 1))  # words up to the end of each text
    place = np.arange(len(begins)) + np.repeat(np.arange(len(texts)), np.diff(after, prepend=0))
    starts, sizes = np.zeros((2, len(begins) + len(texts)), np.int64)
    starts[place], sizes[place] = begins, n
    eights = np.ndarray(len(raw) - 7, "<u8", raw.data, strides=(1,))
    keys = _mixed(sizes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at, here = 0, np.flatnonzero(sizes)
    while len(here):
        left = np.minimum(sizes[here] - at, 8)
        keys[here] = _mixed(keys[here] ^ (eights[starts[here] + at] & _LOW_BYTES[left]))
        at, here = at + 8, here[left == 8]
        here = here[sizes[here] > at]
    return raw, starts, sizes, (keys >> np.uint64(1)).astype(np.int64), np.diff(after, prepend=0) + 1


def _cut_out(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of bytes one after the other, and where they begin and end."""
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return raw[np.repeat(starts - ends[:-1], sizes) + np.arange(int(ends[-1]))], ends


def _blocks(batches: Iterator[pa.RecordBatch]):
    """Runs of rows whose texts make a block: the columns ``doc`` and ``held_out``, and the texts."""
    docs, held_out, texts, size = [], [], [], 0
    for batch in batches:
        for doc, held, data in zip(batch.column("doc"), batch.column("held_out").to_pylist(),
                                   batch.column("data"), strict=True):
            if size >= BLOCK_BYTES:
                yield docs, held_out, texts
                docs, held_out, texts, size = [], [], [], 0
            docs.append(doc)
            held_out.append(held)
            texts.append(data.as_py())
            size += len(texts[-1]) + ROW_BYTES
    if docs:
        yield docs, held_out, texts


def _parts(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of texts whose words are found together."""
    at, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= PART_BYTES:
            yield texts[at:k + 1]
            at, size = k + 1, 0
    if at < len(texts):
        yield texts[at:]


#: The number and the key of a text's end, which is an empty word and has no place in a block's words.
END, _END_KEY = 0, _words([b""])[3][0]


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block: its words, and its texts as numbers of words.

    Numbers are given in the order of appearance, so that frequent words have small ones."""
    task = TaskContext.get().partitionId()
    for k, (docs, held_out, texts) in enumerate(_blocks(batches)):
        known, ids, sizes, words = np.array([_END_KEY]), [], [], []
        for part in _parts(texts):
            raw, starts, lengths, found, per_text = _words(part)
            numbers, distinct = pd.factorize(found)
            firsts = np.empty(len(distinct), np.int64)
            firsts[numbers[::-1]] = np.arange(len(numbers))[::-1]
            where = pd.Index(known).get_indexer(distinct)
            new = np.flatnonzero(where < 0)
            where[new] = len(known) + np.arange(len(new))
            words.append(_cut_out(raw, starts[firsts[new]], lengths[firsts[new]] + 1)[0])  # with what ends them
            known = np.concatenate((known, distinct[new]))
            ids.append(where[numbers].astype(np.int32))
            sizes.append(per_text)
        yield pa.RecordBatch.from_arrays(
            [pa.array([task << 20 | k], pa.int64()), *(pa.array([_pack(np.concatenate(x))]) for x in (words, ids, sizes)),
             pa.array([_pack(np.array(held_out, bool))]),
             pa.array([[doc.as_py() for doc in docs]], pa.list_(docs[0].type))],
            ["block", "words", "ids", "sizes", "held", "docs"])


def _named(row: dict):
    """A block's words: the bytes they lie in, where each begins, its length and its key."""
    raw, starts, lengths, keys, _ = _words([_unpack(row["words"], np.uint8).tobytes()])
    return raw, *(np.concatenate((x[-1:], x[:-1])) for x in (starts, lengths, keys))  # the end comes first


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        raw, starts, lengths, keys = _named(row)
        learned = np.repeat(~_unpack(row["held"], bool), _unpack(row["sizes"], np.int64))
        n = np.bincount(_unpack(row["ids"], np.int32), learned, len(keys)).astype(np.int64)
        for at in range(0, len(keys), 50_000):
            here = slice(at, at + 50_000)
            values, ends = _cut_out(raw, starts[here], lengths[here])
            words = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
                None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])
            yield pa.RecordBatch.from_arrays([pa.array(keys[here]), words, pa.array(n[here])], ["key", "word", "n"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Wide rows, one at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _codes(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Keys of a block's words, its texts as numbers, and each token with the one before it as a
    number; a text's first word comes after an end."""
    keys, ids = _named(row)[3], _unpack(row["ids"], np.int32)
    before = np.concatenate(([END], ids[:-1])).astype(np.int64)
    return keys, ids, _joined(before, ids, len(keys))


def _joined(first: np.ndarray, second: np.ndarray, n: int) -> np.ndarray:
    """Pairs of places below ``n`` as one number each."""
    return first.astype(np.int64) << n.bit_length() | second


def _parted(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    return codes >> n.bit_length(), codes & ((1 << n.bit_length()) - 1)


def _ordered_pairs(codes: np.ndarray, keys: np.ndarray, spread: np.ndarray, buckets: int):
    """Both words of each pair, its bucket, and the order by bucket; ``codes`` are sorted numbers of pairs.

    A pair's bucket follows from its first word, and from both if that is one of ``spread``.
    """
    first, second = _parted(codes, len(keys))
    mixed = keys[first] + np.where(np.isin(keys, spread)[first], keys[second] * 31, 0)
    bucket = ((mixed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets
    return first, second, bucket, _order(bucket)


def _block_pairs(spread: np.ndarray, buckets: int):
    """Distinct pairs of each block: keys of both words and how often they are learned, by bucket."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys, _, codes = _codes(row)
            learned = np.repeat(~_unpack(row["held"], bool), _unpack(row["sizes"], np.int64))
            codes = np.sort(codes * 2 + learned)
            starts = np.flatnonzero(np.diff(codes >> 1, prepend=-1))
            n, codes = np.add.reduceat(codes & 1, starts), codes[starts] >> 1
            first, second, bucket, order = _ordered_pairs(codes, keys, spread, buckets)
            first, second = first[order], second[order]
            n, cuts = n[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[k], cuts[k + 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]], pa.int64()), pa.array([k], pa.int32()),
                     pa.array([_pack(keys[first[part]])]), pa.array([keys[second[part]].tobytes()]),
                     pa.array([_pack(n[part])])], ["block", "bucket", "first", "second", "n"])

    return pairs


_PAIRS = ("block bigint, index binary, bucket int, keys binary, first binary, second binary, c binary, "
          "ones bigint, twos bigint, part int, own binary")
_SEATED = ("bucket int, keys binary, first binary, second binary, c binary, t binary, t_sum binary, "
           "part int, own binary")


def _by_part(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys by their part of the vocabulary, and where each part begins in it."""
    part = keys % parts
    order = _order(part)
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _table(rows: list[dict], ddl: str) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.Table.from_pylist(rows, pa.schema(
        [(name, kinds[kind]) for name, kind in map(str.split, ddl.split(","))]))


def _told(keys: np.ndarray, own: np.ndarray, c: np.ndarray, parts: int) -> list[dict]:
    """Tables that words have and are served at, as rows for each part of the vocabulary."""
    order, cuts = _by_part(keys, parts)
    return [{"part": int(k), "keys": keys[here].tobytes(), "own": _pack(own[here]), "c": _pack(c[here])}
            for k in np.flatnonzero(np.diff(cuts)) for here in [order[cuts[k]:cuts[k + 1]]]]


def _merged(parts: int):
    """The pairs of a bucket, summed over the blocks.

    Three kinds of rows: a row with the pairs seen twice or more, which name their words by their
    place in ``keys``; for each part of the vocabulary how many pairs seen once its words begin
    (``own``) and end (``c``); and for each block the places of its pairs: 0 if never learned, 1 if
    seen once, else 2 and the pair's place in the bucket's row.
    """
    def merged(rows: pa.Table) -> pa.Table:
        unpacked = [[_unpack(x, np.int64) if packed else np.frombuffer(x, np.int64)
                     for x in rows.column(name).to_pylist()]
                    for name, packed in (("first", True), ("second", False), ("n", True))]
        first, second, n = (np.concatenate(x) for x in unpacked)
        words, named = _ranked(np.concatenate((first, second)))
        pair = _joined(named[:len(first)], named[len(first):], len(words))
        del first, second, named
        order = _order(pair)
        pair = pair[order]
        new = np.diff(pair, prepend=-1) != 0
        group = np.cumsum(new) - 1
        c = np.bincount(group, n[order]).astype(np.int64)
        a, b = _parted(pair[new], len(words))
        often = c >= 2
        place = np.where(often, 1 + np.cumsum(often), np.minimum(c, 1)).astype(np.int32)

        def named_by(these):
            """The keys of some pairs' words, and the places there of the first and the second ones."""
            used = np.zeros(len(words), bool)
            used[a[these]] = used[b[these]] = True
            at = np.cumsum(used) - 1
            return words[used], at[a[these]], at[b[these]]

        where = np.empty(len(order), np.int32)
        where[order] = place[group]
        ends = np.cumsum([len(x) for x in unpacked[0]])
        out = [{"block": block, "bucket": bucket, "index": _pack(where[e - len(x):e])} for block, bucket, e, x in zip(
            rows.column("block").to_pylist(), rows.column("bucket").to_pylist(), ends, unpacked[0], strict=True)]
        keys, firsts, seconds = named_by(often)
        out.append({
            "bucket": rows.column("bucket")[0].as_py(), "keys": keys.tobytes(), "c": _pack(c[often]),
            "first": _pack(firsts.astype(np.int32)), "second": _pack(seconds.astype(np.int32)),
            "ones": int((c == 1).sum()), "twos": int((c == 2).sum())})
        once, firsts, seconds = named_by(c == 1)
        out += _told(once, np.bincount(firsts, minlength=len(once)), np.bincount(seconds, minlength=len(once)), parts)
        return _table(out, _PAIRS)

    return merged


def _asked(parts: int):
    """Rows with an ``asker`` and the keys of its words, cut by part of the vocabulary."""
    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys = np.frombuffer(row["keys"], np.int64) if "keys" in row else _named(row)[3]
            order, cuts = _by_part(keys, parts)
            for k in np.flatnonzero(np.diff(cuts)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["asker"]], pa.int64()), pa.array([k], pa.int32()),
                     pa.array([keys[order[cuts[k]:cuts[k + 1]]].tobytes()])], ["asker", "part", "keys"])

    return asked


#: How columns of the vocabulary are sent; probabilities need no more than seven digits.
_SENT = {"c": np.int64, "own": np.float64, "p": np.float32, "base": np.float32}


def _looked_up(names: list[str]):
    """What each asker's words have in columns of the vocabulary, packed."""
    schema = "asker bigint, part int, " + ", ".join(f"{name} binary" for name in names)

    def looked_up(asked: pa.Table, words: pa.Table) -> pa.Table:
        known, rows = words.column("key").to_numpy(), []
        order = np.argsort(known)
        known, columns = known[order], [words.column(name).to_numpy().astype(_SENT[name])[order] for name in names]
        for asker, part, keys in zip(*(asked.column(x).to_pylist() for x in ("asker", "part", "keys")), strict=True):
            at = np.searchsorted(known, np.frombuffer(keys, np.int64))
            rows.append({"asker": asker, "part": part} | {
                name: _pack(values[at]) for name, values in zip(names, columns, strict=True)})
        return _table(rows, schema)

    return looked_up


def _answers(asked: DataFrame, words: DataFrame, parts: int, *names: str) -> DataFrame:
    """``asker``, ``part`` and what the asker's words have in columns of ``words``, by part."""
    placed = words.select("key", *names, F.expr(f"cast(pmod(key, {parts}) as int) AS part"))
    return asked.groupBy("part").cogroup(placed.groupBy("part")).applyInArrow(
        _looked_up(list(names)), "asker bigint, part int, " + ", ".join(f"{name} binary" for name in names))


def _in_order(keys: np.ndarray, parts: int, answers: pa.Table, name: str) -> np.ndarray:
    """An answered column in the order of the asker's keys."""
    found = sorted(zip(answers.column("part").to_pylist(), answers.column(name).to_pylist(), strict=True))
    out = np.empty(len(keys))
    out[_by_part(keys, parts)[0]] = np.concatenate([np.empty(0), *(_unpack(x, _SENT[name]) for _, x in found)])
    return out


def _pair_tables(row: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables of a bucket's pairs, one each before the first sweep, and their sum so far."""
    if row["t"] is None:
        return np.ones(n, np.int64), np.zeros(n, np.int64)
    return _unpack(row["t"], np.int64), _unpack(row["t_sum"], np.int64)


def _seat_pairs(discount: float, sweep: int, parts: int, counts: bool):
    """Seat a bucket's pairs, given their restaurants' tables ``own`` and the words' probability
    ``base``; the tables are told to the words too. ``t_sum`` are those of the sweeps that count."""
    def seated(seen: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in seen.to_pylist():
            keys = np.frombuffer(row["keys"], np.int64)
            first, second = _unpack(row["first"], np.int32), _unpack(row["second"], np.int32)
            c = _unpack(row["c"], np.int64)
            before, t_sum = _pair_tables(row, len(c))
            own, base = (_in_order(keys, parts, answers, name) for name in ("own", "base"))
            others = np.maximum(own[first].astype(np.int64) - before, 0)
            t = seat(_rng(sweep, row["bucket"], len(c)), c, base[second], others, STRENGTH, discount)
            out.append(row | {"t": _pack(t), "t_sum": _pack(t_sum + before if counts else t_sum)})
            out += _told(keys, np.bincount(first, t, len(keys)).astype(np.int64),
                         np.bincount(second, t, len(keys)).astype(np.int64), parts)
        return _table(out, _SEATED)

    return seated


def _tables_first(parts: int):
    """Before the first sweep each pair has one table."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            n = len(row["keys"]) // 8
            out = _told(np.frombuffer(row["keys"], np.int64), *(
                np.bincount(_unpack(row[side], np.int32), minlength=n) for side in ("first", "second")), parts)
            yield from _table(out, "part int, keys binary, own binary, c binary").to_batches()

    return first


def _summed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = [np.frombuffer(x, np.int64) for x in rows.column("keys").to_pylist()]
    keys, where = _ranked(np.concatenate(found))
    return keys, *(np.bincount(where, np.concatenate([_unpack(x, np.int64) for x in rows.column(name).to_pylist()]),
                               len(keys)).astype(np.int64) for name in ("own", "c"))


def _summed_part(rows: pa.Table) -> pa.Table:
    """What is told to a part of the vocabulary, as one row."""
    keys, own, c = _summed(rows)
    return _table([{"part": rows.column("part")[0].as_py(), "keys": keys.tobytes(), "own": _pack(own), "c": _pack(c)}],
                  "part int, keys binary, own binary, c binary")


def _summed_rows(rows: pa.Table) -> pa.Table:
    """The same as a row for each word."""
    return pa.table(dict(zip(("key", "own", "c"), _summed(rows), strict=True)))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches of words joined to longer ones, with the lengths of those they are made of: a round of
    seating costs much the same for a few words."""
    held, n, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        n, size = n + batch.num_rows, size + batch.column("word").nbytes
        if n >= RUN_WORDS or size >= RUN_BYTES:
            yield pa.concat_batches(held), [len(x) for x in held]
            held, n, size = [], 0, 0
    if held:
        yield pa.concat_batches(held), [len(x) for x in held]


def _seat_words(spelling, total_tables: int, discount: float, sweep: int):
    """Seat the words of stored rows; ``spelled`` is their probability in the spelling model."""
    def seated(batches):
        k = 0
        for batch, lengths in _runs(batches):
            words, c = batch.column("word").to_pylist(), batch.column("c").to_numpy()
            t = batch.column("t").to_numpy()
            base = np.exp(spelling().log_probability(words))
            ends = np.cumsum(lengths).tolist()
            rngs = [_rng(sweep, k + i, zlib.crc32(words[end - n] if n else b""), n)
                    for i, (n, end) in enumerate(zip(lengths, ends, strict=True))]
            k += len(lengths)
            t = seat(Draws(rngs, lengths), c, base, np.maximum(total_tables - t, 0), STRENGTH, discount)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("word", "key", "n", "own", "c", "p", "own_sum")), pa.array(t),
                 pa.array(base)], ["word", "key", "n", "own", "c", "p", "own_sum", "t", "spelled"])

    return seated


def _cell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often the words' tables spell each cell, by batch."""
    for batch, _ in _runs(batches):
        t = batch.column("t").to_numpy()
        used = np.flatnonzero(t)
        words = batch.column("word").take(pa.array(used)).to_pylist()
        if not words:
            continue
        cells, starts = spelled(words)
        weights = np.repeat(t[used], np.diff(np.append(starts, len(cells))))
        found, where = np.unique(cells, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(np.bincount(where, weights, len(found)).astype(np.int64))], ["cell", "n"])


def _spelling(vocabulary: DataFrame, root: np.ndarray, sweep: int) -> Spelling:
    """One sweep of the contexts' seating, given the words' tables."""
    cells = vocabulary.select("word", "t").where("t > 0").mapInArrow(_cell_counts, "cell bigint, n bigint") \
        .groupBy("cell").agg(F.sum("n").alias("n")) \
        .withColumn("last", F.expr(f"cell div {SYMBOLS} % {CLASSES}"))

    def contexts(frame: pd.DataFrame) -> pd.DataFrame:
        last = int(frame["last"].iloc[0])  # at most 32 * 32 * 257 rows have one class
        counts = np.zeros(CLASSES * CLASSES * SYMBOLS, np.int64)
        cell = frame["cell"].to_numpy()
        counts[cell // SYMBOLS // CLASSES * SYMBOLS + cell % SYMBOLS] = frame["n"].to_numpy()
        t1, own, left, p2 = seat_contexts(_rng(sweep, last), counts.reshape(CLASSES * CLASSES, SYMBOLS), root)
        cell = np.sort(cell)
        value = own[cell // SYMBOLS // CLASSES, cell % SYMBOLS]
        return pd.DataFrame({"last": [last], "tables": [t1.astype(np.int64).tobytes()], "cells": [cell.tobytes()],
                             "own": [value.tobytes()], "left": [left.tobytes()], "p2": [p2.tobytes()]})

    found = cells.groupBy("last").applyInPandas(
        contexts, "last bigint, tables binary, cells binary, own binary, left binary, p2 binary").collect()
    left, parents = np.ones(CLASSES ** 3), np.tile(root, (CLASSES ** 2, 1))
    customers, seen, values = np.zeros(SYMBOLS, np.int64), [np.empty(0, np.int64)], [np.empty(0)]
    for row in found:  # a row for each class: the spelling model has a fixed size
        left[np.arange(CLASSES ** 2) * CLASSES + row["last"]] = np.frombuffer(row["left"])
        parents[np.arange(CLASSES) * CLASSES + row["last"]] = np.frombuffer(row["p2"]).reshape(CLASSES, SYMBOLS)
        customers += np.frombuffer(row["tables"], np.int64)
        seen.append(np.frombuffer(row["cells"], np.int64))
        values.append(np.frombuffer(row["own"]))
    base = np.full(SYMBOLS, 1 / SYMBOLS)
    tables = seat(_rng(sweep, CLASSES), customers, base, np.zeros(SYMBOLS), STRENGTH, CONTEXT_DISCOUNTS[0])
    order = np.argsort(np.concatenate(seen))
    return Spelling(np.concatenate(seen)[order], np.concatenate(values)[order], left, parents,
                    predictive(customers, tables, base, STRENGTH, CONTEXT_DISCOUNTS[0]))


_STATE = ("word binary, key bigint, n bigint, own bigint, c bigint, p double, own_sum bigint, t bigint, "
          "spelled double")


def _discount(ones: int, twos: int) -> float:
    """The usual estimate of a discount from how many dishes are seen once and twice."""
    return min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)


def _sampled(vocabulary: DataFrame, pairs: DataFrame, parts: int, sweeps: int,
             burn_in: int) -> tuple[DataFrame, DataFrame, float]:
    """Words (``key``, ``c``, ``p``, ``own``), pairs seen again, and the discount of pairs.

    ``vocabulary`` has ``word``, ``key`` and ``n``; ``pairs`` is what ``_merged`` makes. ``p`` is the
    averaged predictive probability and ``own`` the averaged tables of the word's restaurant. Pairs
    have ``bucket`` and packed ``c``, ``t`` and ``t_sum``, see ``_seat_pairs``.
    Words with ``c`` zero all have the averaged probability of an unknown word.
    """
    spark, zero, told = vocabulary.sparkSession, F.lit(0).cast("bigint"), ["part", "keys", "own", "c"]
    single = stored(pairs.where("part IS NOT NULL").select(*told).groupBy("part").applyInArrow(
        _summed_part, "part int, keys binary, own binary, c binary"), "single")
    seen = pairs.where("block IS NULL AND part IS NULL")
    ones, twos = seen.agg(F.sum("ones"), F.sum("twos")).first()
    pair_discount = _discount(ones or 0, twos or 0)
    none, columns = F.lit(None).cast("binary"), ["bucket", "keys", "first", "second", "c", "t", "t_sum"]
    seen = seen.withColumns({"t": none, "t_sum": none}).select(*columns)
    asked = stored(seen.select(F.col("bucket").cast("bigint").alias("asker"), "keys").mapInArrow(
        _asked(parts), "asker bigint, part int, keys binary"), "pairs-asked")

    def counted(words, tables, name, p, own_sum):
        summed = tables.unionByName(single).groupBy("part").applyInArrow(
            _summed_rows, "key bigint, own bigint, c bigint")
        tables = words.join(summed, "key", "left").select(
            "word", "key", "n", F.coalesce("own", zero).alias("own"), F.coalesce("c", zero).alias("c"),
            p.alias("p"), own_sum.alias("own_sum"))
        return stored(tables.withColumn("t", F.least("c", F.lit(1)).cast("bigint")), name)

    unknown, mixed = [], None
    state = counted(vocabulary, seen.select("keys", "first", "second").mapInArrow(
        _tables_first(parts), "part int, keys binary, own binary, c binary"), "seating-0", F.lit(0.0), zero)
    discard(vocabulary)
    spelling = _spelling(state, np.full(SYMBOLS, 1 / SYMBOLS), 0)
    for sweep in range(1, sweeps + 1):
        tables, total, ones, twos = state.agg(
            F.sum("t"), F.sum("c"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
        tables, total, discount = tables or 0, total or 0, _discount(ones, twos)
        step = _seat_words(shared(spark, spelling), tables, discount, sweep)
        before, state = state, stored(state.mapInArrow(step, _STATE), f"seating-{sweep}")
        discard(before)
        before = state
        tables, served = state.agg(F.sum("t"), F.sum(F.when(F.col("c") > 0, F.col("spelled")))).first()
        new = STRENGTH + discount * (tables or 0)
        now = (F.col("c") - discount * F.col("t") + new * F.col("spelled")) / (STRENGTH + total)
        if sweep > burn_in:
            unknown.append(new * max(1 - (served or 0.0), 0.0) / (STRENGTH + total))
            state = state.withColumn("p", F.col("p") + now).withColumn("own_sum", F.col("own_sum") + F.col("own"))
        if sweep < sweeps:
            spelling = _spelling(state, spelling.root, sweep)
            answers = _answers(asked, state.select("key", "own", now.alias("base")), parts, "own", "base")
            earlier, mixed = mixed, stored(seen.groupBy("bucket").cogroup(
                answers.withColumn("bucket", F.col("asker").cast("int")).groupBy("bucket")).applyInArrow(
                _seat_pairs(pair_discount, sweep, parts, sweep > burn_in), _SEATED), f"pairs-{sweep}")
            if earlier is not None:
                discard(earlier)
            seen = mixed.where("part IS NULL").select(*columns)
            state = counted(
                state.drop("own", "c"), mixed.where("part IS NOT NULL").select(*told), f"counted-{sweep}",
                F.col("p"), F.col("own_sum"))
            discard(before)
    m = len(unknown)
    known = F.when(F.col("n") > 0, F.col("p") / m).otherwise(sum(unknown) / m)
    model = stored(state.select("key", F.col("n").alias("c"), known.alias("p"), (F.col("own_sum") / m).alias("own")), "model")
    for table in (before, asked, single):
        discard(table)
    return model, seen.select("bucket", "c", "t", "t_sum"), pair_discount


def _values(discount: float, m: int):
    """What each pair of a block has of its own, in the block's order: customers less the discount of
    the tables, as they are on average."""
    def values(index: pa.Table, seen: pa.Table) -> pa.Table:
        row = seen.to_pylist()[0]
        c = _unpack(row["c"], np.int64)
        of = np.concatenate(([0, 1 - discount], c - discount * sum(_pair_tables(row, len(c))) / m)).astype(np.float32)
        return pa.table({"asker": index.column("block"), "number": index.column("bucket"), "values": pa.array(
            [_pack(of[_unpack(x, np.int32)]) for x in index.column("index").to_pylist()], pa.binary())})

    return values


def score_texts(df: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text", *,
                sweeps: int = SWEEPS, burn_in: int = BURN_IN) -> DataFrame:
    """Score each whole text; the model learns from rows where the column ``held_out`` is false.

    Words are runs of other bytes than 20 and 09-0D, with A-Z in lower case; a text's end is a
    token too, so a null or empty text has one. Columns: the id, ``held_out``, ``n_tokens``,
    ``n_known`` (tokens seen in learning), ``train_tokens``, ``base_score`` (additive smoothing of
    single tokens), ``score`` (log10 probability) and ``perplexity``. Without rows to learn from,
    every token is the unknown word, with probability one. Rows stay as they are, repeated ones
    too; other columns are left out; an empty table gives an empty table.

    ``df`` is read once.
    """
    id_type = df.schema[doc_id].dataType
    texts = df.select(F.col(doc_id).alias("doc"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                      text_of(text).cast("binary").alias("data"))
    blocks = stored(texts.mapInArrow(_coded, T.StructType([
        T.StructField("block", T.LongType()), T.StructField("words", T.BinaryType()), T.StructField("ids", T.BinaryType()),
        T.StructField("sizes", T.BinaryType()), T.StructField("held", T.BinaryType()),
        T.StructField("docs", T.ArrayType(id_type))])), "blocks")
    coded = blocks.drop("docs")
    vocabulary = stored(coded.mapInArrow(_block_words, "key bigint, word binary, n bigint").groupBy("key", "word").agg(
        F.sum("n").alias("n")).select("word", "key", "n"), "vocabulary")
    total, kinds = vocabulary.where("n > 0").agg(F.sum("n"), F.count("*")).first()
    total = total or 0
    often = vocabulary.where(F.col("n") > max(total * SPREAD_SHARE, 1)).select("key").collect()  # 1000 at most
    spread = np.array([r["key"] for r in often], np.int64)
    n_blocks = blocks.count()
    parts, buckets = max(n_blocks // 2, 1), BUCKETS_A_BLOCK * max(n_blocks, 1)
    pairs = stored(coded.mapInArrow(
        _block_pairs(spread, buckets), "block bigint, bucket int, first binary, second binary, n binary")
        .groupBy("bucket").applyInArrow(_merged(parts), _PAIRS), "pairs")
    model, seen, pair_discount = _sampled(vocabulary, pairs, parts, sweeps, burn_in)
    values = pairs.where("block IS NOT NULL").select("block", "bucket", "index").groupBy("bucket").cogroup(
        seen.groupBy("bucket")).applyInArrow(
        _values(pair_discount, sweeps - burn_in), "asker bigint, number int, values binary")
    asked = coded.select(F.col("block").alias("asker"), "words").mapInArrow(
        _asked(parts), "asker bigint, part int, keys binary")
    answers = stored(_answers(asked, model, parts, "c", "p", "own").unionByName(values, allowMissingColumns=True), "answers")
    for table in (pairs, seen, model):
        discard(table)

    def scored(rows: pa.Table, answers: pa.Table) -> pa.Table:
        row = rows.drop_columns(["docs"]).to_pylist()[0]
        is_word = answers.column("values").is_null()
        sent, answers = answers.filter(pc.invert(is_word)), answers.filter(is_word)
        keys, ids, codes = _codes(row)
        c, p, own = (_in_order(keys, parts, answers, name) for name in ("c", "p", "own"))
        base = np.log10((c + 0.5) / (total + 0.5 * (kinds + 1)))
        codes, where = _grouped(codes)
        first, second, _, by_bucket = _ordered_pairs(codes, keys, spread, buckets)
        value = np.empty(len(codes))
        value[by_bucket] = np.concatenate([_unpack(x, np.float32) for _, x in sorted(
            zip(sent.column("number").to_pylist(), sent.column("values").to_pylist(), strict=True))])
        chance = (value + (STRENGTH + pair_discount * own[first]) * p[second]) / (STRENGTH + c[first])
        logs = np.log10(np.maximum(chance, 1e-300))[where]
        sizes = _unpack(row["sizes"], np.int64)
        starts = np.cumsum(sizes) - sizes
        return pa.table({
            "doc": rows.column("docs").combine_chunks().flatten(), "held_out": pa.array(_unpack(row["held"], bool)),
            "n_tokens": pa.array(sizes), "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64)[ids], starts)),
            "base_score": pa.array(np.add.reduceat(base[ids], starts)),
            "score": pa.array(np.add.reduceat(logs, starts))})

    schema = T.StructType([
        T.StructField("doc", id_type), T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    result = blocks.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(scored, schema)
    return result.select(
        F.col("doc").alias(doc_id), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
