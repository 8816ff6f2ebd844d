"""Chat formatting: a hidden Markov model recovers who speaks in each line of a raw transcript.

A state is a role and whether the line begins a turn. A line shows the model a speaker marker (one
of a fixed list, or none), whether a blank line or the transcript's start stands before it, its
length on a log scale and its last character's kind. Probabilities are counted on transcripts with
known roles, with additive smoothing; the counts are summed in the tasks, and what is left is a few
hundred numbers. The Viterbi path gives the turns, which are rendered in one canonical form.

A transcript comes in pieces, and a piece may hold any number of lines. Transcripts are decoded in
blocks of ``BLOCK`` pieces, so none has to fit into one task. For those of several blocks the best
score from each state before a block to each state at its end is computed first; chained over the
blocks, these give the scores a block starts from and the state it ends in.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressflow.llm.support import shared, stored, text_of

ROLES = ("system", "user", "assistant")
#: Roles, each as the beginning of a turn and as its continuation.
STATES = [(role, begins) for role in ROLES for begins in (True, False)]
MARKERS = ("system", "instructions", "note", "user", "human", "question", "q", "prompt",
           "assistant", "ai", "bot", "model", "answer", "a")
#: Pieces of a transcript that are decoded together.
BLOCK = 64
SMOOTHING = 0.5

_NAMES = "|".join(MARKERS)
_MARKER = re.compile(
    rf"\s*(?:#+\s*({_NAMES})\s*:?\s*$|<\|({_NAMES})\|>|\[({_NAMES})\]:?|\*\*({_NAMES}):?\*\*:?|({_NAMES})\s*:)\s*",
    re.IGNORECASE)
#: What is counted of a line, and how many values each feature has.
FEATURES = {"marker": len(MARKERS) + 1, "gap": 2, "length": 12, "last": 4}


def lines_of(pieces: Iterable[str], gap: bool) -> Iterator[tuple[int, int, tuple[int, ...], str, str, list[str]]]:
    """Piece, line within it, features, the line and its text without marker, if it is not blank; and
    the blank lines before it."""
    blanks: list[str] = []
    for number, piece in enumerate(pieces):
        for place, line in enumerate(piece.split("\n")):
            if not line.strip():
                gap = True
                blanks.append(line)
                continue
            found = _MARKER.match(line)
            marker = 1 + MARKERS.index(next(g for g in found.groups() if g).lower()) if found else 0
            text = line[found.end():] if found else line
            last = line.rstrip()[-1]
            kind = 1 if last == "?" else 2 if last == ":" else 3 if last in ".!" else 0
            yield number, place, (marker, int(gap), min(len(line).bit_length(), 11), kind), line, text, blanks
            gap, blanks = False, []


@dataclass(frozen=True)
class RoleModel:
    """Log probabilities: of the first state, of the next one, and of each feature's values."""

    first: np.ndarray
    after: np.ndarray
    emitted: tuple[np.ndarray, ...]

    @classmethod
    def from_counts(cls, counts: dict[tuple[str, int, int], int]) -> RoleModel:
        """From counts by kind (``first``, ``after`` or a feature), state and value."""
        def table(kind: str, values: int) -> np.ndarray:
            n = np.array([[counts.get((kind, s, v), 0) for v in range(values)] for s in range(len(STATES))])
            return np.log((n + SMOOTHING) / (n + SMOOTHING).sum(axis=1, keepdims=True))

        first = np.array([counts.get(("first", s, 0), 0) for s in range(len(STATES))]) + SMOOTHING
        after = table("after", len(STATES))
        for a, (role, _) in enumerate(STATES):
            for b, (other, begins) in enumerate(STATES):
                if not begins and other != role:
                    after[a, b] = -np.inf  # a turn goes on in its own role
        begins = np.array([b for _, b in STATES])
        return cls(np.where(begins, np.log(first / first.sum()), -np.inf), after,
                   tuple(table(kind, values) for kind, values in FEATURES.items()))

    def emissions(self, features: list[tuple[int, ...]]) -> np.ndarray:
        values = np.array(features).T
        return sum(table[:, v].T for table, v in zip(self.emitted, values, strict=True))

    def path(self, features: list[tuple[int, ...]], entry: np.ndarray | None, last: int) -> list[int]:
        """Most probable states; ``entry`` has scores before the block, ``last`` its end (or -1)."""
        emitted, back = self.emissions(features), []
        score = self.first if entry is None else None
        for k, line in enumerate(emitted):
            if score is None or k:
                steps = (entry if score is None else score)[:, None] + self.after
                back.append(steps.argmax(axis=0))
                score = steps.max(axis=0)
            score = score + line
        states = [int(score.argmax()) if last < 0 else last]
        for choice in reversed(back if entry is None else back[1:]):
            states.append(int(choice[states[-1]]))
        return states[::-1]

    def crossing(self, features: list[tuple[int, ...]]) -> np.ndarray:
        """Best score from each state before the lines to each state of the last one."""
        scores = np.where(np.eye(len(STATES), dtype=bool), 0.0, -np.inf)
        for line in self.emissions(features):
            scores = (scores[:, :, None] + self.after[None]).max(axis=1) + line
        return scores


def raw_pieces(df: DataFrame, conv_id: str, order: str, text: str, *more: Column) -> DataFrame:
    """``conv``, ``block``, ``place``, ``piece`` and more columns; see ``format_transcripts``.

    Rows are told apart by all their columns.
    """
    place = F.coalesce(F.col(order).cast("bigint"), F.lit(-1))
    whole = F.xxhash64(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    return df.select(F.col(conv_id).alias("conv"), F.floor(place / BLOCK).alias("block"), place.alias("place"),
                     text_of(text).alias("piece"), *more, whole.alias("whole")) \
        .where("conv IS NOT NULL").dropDuplicates().drop("whole")


def _blocks(batches: Iterator[pa.RecordBatch], extra: int = 0):
    """Rows of each conversation's block, from sorted batches; ``extra`` columns of the block."""
    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    for (conv, block), group in groupby(rows(), key=lambda r: (r[0], r[1])):
        group = list(group)
        yield conv, block, [r[2] for r in group], [r[3] for r in group], group[0][4:4 + extra]


def _in_blocks(pieces: DataFrame) -> DataFrame:
    return pieces.repartition("conv", "block").sortWithinPartitions("conv", "block", "place", "piece")


def train(df: DataFrame, conv_id: str = "conv_id", order: str = "turn", text: str = "text",
          role: str = "role") -> RoleModel:
    """Count states and features on pieces that are one turn of a known role each.

    Rows of other roles, or without conversation, are left out of the counts. A block's first line
    counts as the first of a transcript only in the first block. No rows at all give even chances.
    """
    known = df.where(F.col(role).isin(*ROLES))
    labelled = _in_blocks(raw_pieces(known, conv_id, order, text, F.col(role).alias("role")))
    names = list(FEATURES)

    def counted(batches):
        counts: Counter[tuple[str, int, int]] = Counter()

        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        for (_, block), group in groupby(rows(), key=lambda r: (r[0], r[1])):
            group, before, spoken = list(group), None, None
            for number, _, features, *_ in lines_of([r[3] for r in group], block <= 0):
                state = STATES.index((group[number][4], number != spoken))
                spoken = number
                if before is not None:
                    counts["after", before, state] += 1
                elif block <= 0:
                    counts["first", state, 0] += 1
                for name, value in zip(names, features, strict=True):
                    counts[name, state, value] += 1
                before = state
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([k[2] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())],
            ["kind", "state", "value", "n"])

    found = labelled.mapInArrow(counted, "kind string, state int, value int, n bigint") \
        .groupBy("kind", "state", "value").agg(F.sum("n").alias("n")).collect()
    return RoleModel.from_counts({(r["kind"], r["state"], r["value"]): r["n"] for r in found})


def _entries(pieces: DataFrame, model, conv_type: str) -> DataFrame:
    """Entry scores and last state of each block of conversations that have several."""
    n = len(STATES)
    long = pieces.groupBy("conv").agg(F.min("block").alias("a"), F.max("block").alias("b")).where("a < b")

    def crossings(batches):
        for conv, block, _, texts, _ in _blocks(batches):
            features = [f for _, _, f, *_ in lines_of(texts, False)]
            # a block without a line leaves every state as it is
            matrix = model().crossing(features) if features else np.where(np.eye(n, dtype=bool), 0.0, -np.inf)
            first = features and model().first + model().emissions(features[:1])[0]
            rest = model().crossing(features[1:]) if len(features) > 1 else None
            start = None if not features else (first if rest is None else (first[:, None] + rest).max(axis=0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv]), pa.array([block], pa.int64()),
                 pa.array([matrix.ravel().tolist()], pa.list_(pa.float64())),
                 pa.array([None if start is None else start.tolist()], pa.list_(pa.float64()))],
                ["conv", "block", "matrix", "start"])

    matrices = _in_blocks(pieces.join(long, "conv").select("conv", "block", "place", "piece")).mapInArrow(
        crossings, f"conv {conv_type}, block bigint, matrix array<double>, start array<double>")

    def chained(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block", ignore_index=True)
        entries, score = [], None
        for matrix, start in zip(frame["matrix"], frame["start"], strict=True):
            entries.append(score)
            if score is not None:
                score = (score[:, None] + np.array(matrix).reshape(n, n)).max(axis=0)
            elif start is not None:
                score = np.array(start)
        last, state = [0] * len(frame), -1
        for k in range(len(frame) - 1, -1, -1):
            if state < 0 and score is not None:
                state = int(score.argmax())
            last[k] = state
            if entries[k] is not None:
                state = int((entries[k] + np.array(frame["matrix"][k]).reshape(n, n)[:, state]).argmax())
        frame["entry"] = [None if e is None else e.tolist() for e in entries]
        frame["last"] = last
        return frame[["conv", "block", "entry", "last"]]

    return matrices.groupBy("conv").applyInPandas(
        chained, f"conv {conv_type}, block bigint, entry array<double>, last int")


def rendered(role: str | Column, content: str | Column) -> Column:
    """The canonical form of a turn."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), content, F.lit("\n<|end|>\n"))


def format_transcripts(df: DataFrame, model: RoleModel, conv_id: str = "conv_id", order: str = "turn",
                       text: str = "text") -> DataFrame:
    """The turns of raw transcripts: id, ``first_piece``, ``first_line``, ``role``, ``marker``, ``content``,
    ``rendered``.

    Each row of ``df`` is a piece of the transcript ``conv_id``; pieces go by ``order``, equal ones
    by their text, and pieces without order come first. A row that is repeated in whole, with all
    its columns, counts once. Rows without ``conv_id`` belong to no transcript and are left out. The
    content is a turn's text from its first line to its last one that is not blank, blank lines
    between them included; what is cut off the first line is ``marker``. A null or blank piece has
    no line, and a transcript without lines no turn. A turn that is a marker alone has empty
    content. An empty table gives an empty table.
    """
    conv_type = df.schema[conv_id].dataType.simpleString()
    worker = shared(df.sparkSession, model)
    pieces = stored(raw_pieces(df, conv_id, order, text), "pieces")
    entries = stored(_entries(pieces, worker, conv_type), "entries")

    def turns(batches):
        for conv, _, places, texts, (entry, last) in _blocks(batches, 2):
            lines = list(lines_of(texts, entry is None))
            if not lines:
                continue
            path = worker().path([f for _, _, f, *_ in lines], None if entry is None else np.array(entry), last)
            parts = []
            for (number, place, _, line, after_marker, blanks), state in zip(lines, path, strict=True):
                role, begins = STATES[state]
                content = after_marker if begins else line  # within a turn nothing is a marker
                if begins or not parts:
                    marker = line[:len(line) - len(after_marker)] if begins else ""
                    parts.append([places[number], place, role, begins, marker, [] if begins else list(blanks)])
                elif parts[-1][5]:
                    parts[-1][5] += blanks
                if content:
                    parts[-1][5].append(content)
            # blank lines at the end belong to the turn if it goes on in the next block
            if last >= 0 and parts[-1][5]:
                after = "\n".join(texts).split("\n")
                end = next((k for k in range(len(after), 0, -1) if after[k - 1].strip()), 0)
                parts[-1][5] += after[end:]
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.string())
            columns = list(zip(*parts, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv] * len(parts)), *(pa.array(c, k) for c, k in zip(columns[:5], kinds, strict=True)),
                 pa.array(["\n".join(c) for c in columns[5]], pa.string())],
                ["conv", "first_piece", "first_line", "role", "begins", "marker", "content"])

    prepared = pieces.join(entries, ["conv", "block"], "left").select(
        "conv", "block", "place", "piece", "entry", F.coalesce("last", F.lit(-1)).alias("last"))
    parts = stored(_in_blocks(prepared).mapInArrow(
        turns, f"conv {conv_type}, first_piece bigint, first_line int, role string, begins boolean, marker string, "
               "content string"),
        "turns")
    # a turn that goes on over blocks: its later parts go to the last part that began one
    split = parts.where("NOT begins").select("conv").distinct()
    so_far = Window.partitionBy("conv").orderBy("first_piece", "first_line")
    at = F.when(F.col("begins"), F.struct("first_piece", "first_line"))
    joined = parts.join(split, "conv").withColumn("at", F.last(at, ignorenulls=True).over(so_far)) \
        .groupBy("conv", "at").agg(
            F.first("role").alias("role"), F.max("marker").alias("marker"),
            F.array_sort(F.collect_list(F.struct("first_piece", "first_line", "content"))).alias("parts")) \
        .select("conv", "at.first_piece", "at.first_line", "role", "marker",
                F.array_join(F.filter(F.col("parts.content"), lambda c: c != ""), "\n").alias("content"))
    whole = parts.join(split, "conv", "left_anti").select("conv", "first_piece", "first_line", "role", "marker", "content")
    # blank lines at a seam of blocks that turned out to be the turn's end or beginning
    shown = F.regexp_replace("content", r"(?:\n[^\S\n]*)+\z|\A(?:[^\S\n]*\n)+", "")
    return whole.union(joined).withColumn("content", shown).select(
        F.col("conv").alias(conv_id), "first_piece", "first_line", "role", "marker", "content",
        rendered(F.col("role"), F.col("content")).alias("rendered"))


#: Ways to name the speakers of a transcript: markers of system, user and assistant, in that order.
STYLES = [("System: ", "User: ", "Assistant: "), ("Instructions: ", "Human: ", "AI: "),
          ("Note: ", "Q: ", "A: "), ("### System\n", "### User\n", "### Assistant\n"),
          ("<|system|>", "<|user|>", "<|assistant|>"), ("[system] ", "[prompt] ", "[model] ")]
#: One of so many turns has lost its marker.
UNMARKED = 7


def transcripts(df: DataFrame, conv_id: str = "conv_id", order: str = "turn", text: str = "text",
                role: str = "role") -> DataFrame:
    """``df`` with its texts as a raw transcript has them: markers in one of several styles.

    The style follows from the conversation; some turns have no marker, and half of the
    conversations part their turns by a blank line. Used to make transcripts of known turns.
    """
    conv = F.col(conv_id).cast("string")
    style = F.pmod(F.xxhash64(conv, F.lit("style")), F.lit(len(STYLES)))
    marker = F.lit("")
    for s, names in enumerate(STYLES):
        for r, name in zip(ROLES, names, strict=True):
            marker = F.when((style == s) & (F.col(role) == r), name).otherwise(marker)
    lost = F.pmod(F.xxhash64(conv, order), F.lit(UNMARKED)) == 0
    gap = F.when(F.pmod(F.xxhash64(conv, F.lit("gap")), F.lit(2)) == 0, "\n").otherwise("")
    return df.withColumn(text, F.concat(F.when(lost, "").otherwise(marker), text_of(text), gap))
