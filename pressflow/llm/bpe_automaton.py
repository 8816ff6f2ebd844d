"""BPE encoding by an automaton over tokens, and decoding by the labels of its arcs.

The automaton starts as one state with a loop for each base symbol, which accepts every sequence
of symbols. Each merge (u, v) -> t is then worked in by a gadget, in the order of the merges: the
state that arcs labelled u lead to, if it has an arc v, is copied without that arc, arcs u are led
to the copy, and an arc t is added beside each arc u, which leads where v led. What remains accepts
exactly one token sequence for each word, the one that applying the merges in order gives.

All arcs with one label lead to one state, so the automaton is three arrays: the target of each
label, and for each state the state it is a copy of and the arc that the copy lacks.

Words are read symbol by symbol. Where a reader stands is the set of arcs begun: pairs of a state
and the part of a label read since. For each prefix of a word just one arc can end there, since
each prefix has one token sequence, so a table of transitions gives the next set, and the length
and label of that arc. The table is deterministic; its rows are filled in as they are met. A word
costs a lookup for each symbol; its tokens are read off from the end.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressflow.llm.support import shared

#: Entries of a worker's cache of chunks and of its transition table, which is emptied beyond
#: them; the longest chunk in the cache.
CACHE_CHUNKS = 450_000
TABLE_ARCS = 500_000
CACHED_CHARS = 64

_ROOT = 0
#: The words of a lower-case chunk of printable ASCII characters (a fixed value of the tokenizer).
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


@dataclass
class Automaton:
    """Token automaton of a BPE model; ``ids`` maps a label to its id."""

    ids: dict[str, int]
    end: str
    special: dict[str, int]
    target: dict[int, int] = field(default_factory=dict)
    copied: list[int] = field(default_factory=lambda: [_ROOT])
    lacks: list[int] = field(default_factory=lambda: [-1])
    born: list[int] = field(default_factory=lambda: [-1])
    #: label -> its merge's number and left part; base symbols have none
    made: dict[int, tuple[int, int]] = field(default_factory=dict)
    gone: dict[int, dict[int, int]] = field(default_factory=dict)

    @classmethod
    def compile(cls, tokenizer_json: str) -> Automaton:
        parsed = json.loads(tokenizer_json)
        model = parsed["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("unk_token"):
            raise ValueError("a BPE model without dropout and unknown token is needed")
        automaton = cls(model["vocab"], model.get("end_of_word_suffix") or "",
                        {t["content"]: t["id"] for t in parsed["added_tokens"]})
        for number, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            automaton.merge(number, left, right)
        automaton.gone.clear()
        return automaton

    def merge(self, number: int, left: str, right: str) -> None:
        u, v, t = self.ids[left], self.ids[right], self.ids[left + right]
        after_u, after_v = self.target.get(u, _ROOT), self.target.get(v, _ROOT)
        if t in self.made or not self.has(after_u, v):
            raise ValueError(f"merge {number} ({left} {right}) can never apply first")
        self.copied.append(after_u)
        self.lacks.append(v)
        self.born.append(number)
        self.target[t] = after_v
        self.target[u] = len(self.born) - 1
        self.made[t] = number, u

    def has(self, state: int, label: int) -> bool:
        """Whether the state has an arc with the label.

        An arc made after the state exists beside the arc of its left part; an older one is there
        unless the state, or one it is a copy of, was made without it.
        """
        gone = self.gone.get(state)
        if gone is None:  # what the state and those it is a copy of were made without, and when
            gone, at = {}, state
            while at != _ROOT:
                gone[self.lacks[at]] = self.born[at]
                at = self.copied[at]
            self.gone[state] = gone
        until = self.born[state]
        while True:
            if gone.get(label, until + 1) <= until:
                return False
            since, left = self.made.get(label, (-1, -1))
            if since < 0:
                return True
            until, label = min(until, since), left


class WordEncoder:
    """Encodes and decodes in a Python worker, with its transition table and chunk cache.

    ``word`` and ``chunk`` need ``_prepare``; ``encode`` and ``decode`` see to it themselves.
    """

    def __init__(self, tokenizer_json: str):
        self.automaton = Automaton.compile(tokenizer_json)
        self.tokenizer_json = tokenizer_json
        self.clear()

    def clear(self):
        self.library = self.starts = self.labels = self.blank = self.marks = self.words = None
        self.empty_table()
        self.cache: dict[str, tuple[int, str, str]] = {}

    def __getstate__(self):
        automaton = dict(self.automaton.__dict__, gone={})
        return {"automaton": Automaton(**automaton), "tokenizer_json": self.tokenizer_json}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.clear()

    def _prepare(self):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(self.tokenizer_json)
        self.labels = {i: label for label, i in self.automaton.ids.items()}
        self.labels |= {i: label for label, i in self.automaton.special.items()}
        #: every beginning of a label: longer stretches of a word can hold no label
        end = self.automaton.end
        self.starts = {label[:i] for full in self.automaton.ids
                       for label in (full, full.removesuffix(end))
                       for i in range(1, len(label) + 1)}
        self.blank = regex.compile(r"[\x09-\x0D\x20\x85\xA0  -   "
                                   r"  　]+")
        marks = sorted(self.automaton.special, key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, marks))) if marks else None

    def step(self, row: int, symbol: str, final: bool) -> tuple[int, int, int]:
        """Work out a transition and enter it: the next row, the last arc's length and its label."""
        automaton = self.automaton
        ids, end = automaton.ids, automaton.end if final else ""
        begun, length, found = [], 0, None
        for state, part in self.rows[row]:
            part += symbol
            if part not in self.starts:
                continue
            begun.append((state, part))
            if found is None:
                label = ids.get(part + end)
                if label is not None and automaton.has(state, label):
                    length, found = len(part), label
        if found is None:
            raise ValueError(f"no arc for {symbol!r}")
        if final:
            after = -1
        else:
            begun.append((automaton.target.get(found, _ROOT), ""))
            key = tuple(begun)
            after = self.numbers.setdefault(key, len(self.rows))
            if after == len(self.rows):
                self.rows.append(key)
        entry = self.table[row << 22 | ord(symbol) << 1 | final] = after, length, found
        return entry

    def word(self, word: str) -> list[int]:
        """Ids of one pre-split word, given as the library's pre-tokenizer gives it."""
        if len(self.table) > TABLE_ARCS:
            self.empty_table()
        table, row, passed = self.table, 0, []
        for symbol in word[:-1]:
            entry = table.get(row << 22 | ord(symbol) << 1) or self.step(row, symbol, False)
            row = entry[0]
            passed.append(entry)
        symbol = word[-1]
        passed.append(table.get(row << 22 | ord(symbol) << 1 | 1) or self.step(row, symbol, True))
        found, at = [], len(word)
        while at:
            _, length, label = passed[at - 1]
            found.append(label)
            at -= length
        found.reverse()
        return found

    def empty_table(self) -> None:
        start = ((_ROOT, ""),)
        self.table: dict[int, tuple[int, int, int]] = {}
        self.rows = [start]
        self.numbers = {start: 0}

    def chunk(self, chunk: str) -> list[int]:
        """Ids of a stretch of text without white space."""
        parts, at = [], 0
        for mark in self.marks.finditer(chunk) if self.marks and "<" in chunk else ():
            parts += [chunk[at:mark.start()], self.automaton.special[mark[0]]]
            at = mark.end()
        found: list[int] = []
        for part in [*parts, chunk[at:]]:
            if isinstance(part, int):
                found.append(part)
            elif part:
                for word in self.pre_split(part):
                    found += self.word(word)
        return found

    def pre_split(self, part: str) -> list[str]:
        """The words of a chunk, normalized, with their bytes as the vocabulary writes them."""
        if part.isascii() and part.isprintable():  # of these, each byte is written as itself
            return _ASCII_WORDS.findall(part.lower())
        plain = self.library.normalizer.normalize_str(part)
        return [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def known(self, chunk: str) -> tuple[int, str, str]:
        """Number of ids of a chunk, the ids as text and its decoded text."""
        found = self.cache.get(chunk)
        if found is None:
            ids = self.chunk(chunk)
            found = len(ids), " ".join(map(str, ids)), self.decode(ids)
            if len(chunk) <= CACHED_CHARS and len(self.cache) < CACHE_CHUNKS:
                self.cache[chunk] = found
        return found

    def encode(self, text: str) -> tuple[int, str, str]:
        """Number of ids of a text, the ids as text, separated by blanks, and its decoded text."""
        if self.library is None:
            self._prepare()
        chunks = self.split(text)
        found = list(map(self.cache.get, chunks))
        if None in found:
            found = [self.known(c) if f is None else f for c, f in zip(chunks, found, strict=True)]
        if not found:
            return 0, "", ""
        counts, ids, decoded = zip(*found, strict=True)
        return sum(counts), " ".join(ids), " ".join(decoded)

    def split(self, text: str) -> list[str]:
        # str.split also splits at four control characters that are no white space in a text
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [c for c in self.blank.split(text) if c]
        return text.split()

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, joined as the library does without a decoder: by a blank."""
        if self.library is None:
            self._prepare()
        return " ".join([self.labels[i] for i in ids])


def check_tokenizer(tokenizer_json: str) -> None:
    """Refuse files whose words depend on the white space around them."""
    parsed = json.loads(tokenizer_json)
    if parsed.get("decoder") is not None or not parsed["model"].get("end_of_word_suffix"):
        raise ValueError("a word BPE with end-of-word suffix and without decoder is needed")


def encode_texts(df: DataFrame, tokenizer_json: str, text: str = "text", *,
                 digests: bool = False) -> DataFrame:
    """``df`` with ``ids`` (array of int) and ``decoded`` (text) of each whole text.

    With ``digests``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` come in their place, made
    in the same pass. A null or empty text, or one of white space alone, has no ids and decodes to
    the empty text. Words of any length are encoded whole. Columns of ``df`` that have a name of a
    result are replaced; repeated rows stay; an empty table gives an empty table.
    """
    check_tokenizer(tokenizer_json)
    worker = shared(df.sparkSession, WordEncoder(tokenizer_json))
    if digests:
        added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                 T.StructField("decoded_sha256", T.StringType())]
    else:
        added = [T.StructField("ids", T.ArrayType(T.IntegerType())),
                 T.StructField("decoded", T.StringType())]
    names = [f.name for f in added]
    keep = [f for f in df.schema if f.name not in names]

    def columns(texts):
        encoder = worker()
        rows = (encoder.encode(t or "") for t in texts)
        if not digests:
            rows = [(list(map(int, ids.split())), decoded) for _, ids, decoded in rows]
            return [pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[1] for r in rows], pa.string())]
        from hashlib import sha256

        rows = [(n, *(sha256(s.encode()).hexdigest() for s in strings)) for n, *strings in rows]
        return [pa.array([r[0] for r in rows], pa.int64()),
                *(pa.array([r[k] for r in rows], pa.string()) for k in (1, 2))]

    def encoded(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in keep] + columns(texts),
                [f.name for f in keep] + names)

    return df.mapInArrow(encoded, T.StructType(keep + added))


def decode_ids(df: DataFrame, tokenizer_json: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text that each array of ids decodes to; null arrays decode to null."""
    check_tokenizer(tokenizer_json)
    worker = shared(df.sparkSession, WordEncoder(tokenizer_json))

    @F.pandas_udf(T.StringType())
    def decoded(values):
        return values.map(lambda v: None if v is None else worker().decode(list(v)))

    return df.withColumn(out, decoded(F.col(ids)))
