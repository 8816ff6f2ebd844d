"""URL filter by rules and, where none fits, by the ratio of two character language models.

Rules name a host and the beginning of a path. A rule fits its host and all subdomains, if the
URL's path starts with the rule's; the longest fitting rule decides.

URLs that a rule allows or blocks are the examples of two Markov models of variable order over the
URL's characters. A model keeps a context of up to ``ORDER`` characters if the context makes up
``MIN_SHARE`` of the model's characters, so a model has at most ``ORDER / MIN_SHARE`` contexts at
every size of the input, and behaves alike at every size. The chance of a character after a context
is drawn towards that after the shorter context (Witten-Bell), down to equal chances.

The score of a URL is the difference of its two log-likelihoods (accepted less rejected, in nats)
divided by its number of characters, end included. One fold of the examples is held out of the
models; the threshold is the one that best separates their scores: the greatest sum of the shares
of allowed URLs at or above it and of blocked URLs below it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressflow.llm.support import remainder, shared, stored, text_of

ORDER, MIN_SHARE = 5, 1 / 4000
#: Examples with this remainder of the URL's crc32 calibrate the threshold.
FOLDS, CALIBRATION = 5, 1
#: Scores are counted in bins of this width within the limit on both sides.
BIN, LIMIT = 1 / 256, 8.0
ALLOW, BLOCK = "allow", "block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A printable ASCII character stands for itself, "\x01" for all others, "\x02" for the end; "\x03"
#: stands before the beginning.
OTHER, END, START = "\x01", "\x02", "\x03"
SYMBOLS = [OTHER, END, *(chr(c) for c in range(32, 127) if not 65 <= c <= 90)]


@dataclass(frozen=True)
class Rule:
    """``host`` is lower-case without a dot in front; ``path`` begins with a slash."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: str | Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty if there is none."""
    return lower_ascii(F.regexp_extract(text_of(url), r"^[\s\S]*?://([^/?#]*)", 1))


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.regexp_extract(text_of(url), r"^[\s\S]*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: str, path: str, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``, or null.

    Of rules of one length the first of the list counts.
    """
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        # of equal lengths the first is applied last
        fits = ((F.col(host) == rule.host) | F.col(host).endswith("." + rule.host)) & F.col(path).startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
                        ).otherwise(chosen)
    return chosen


def symbols_of(url: str | Column) -> Column:
    """The URL in the models' characters, its end included."""
    return F.concat(F.regexp_replace(lower_ascii(text_of(url)), r"[^\x20-\x7E]", OTHER), F.lit(END))


def context_counts(examples: DataFrame) -> DataFrame:
    """Counts of each context of ``ORDER`` characters with the next one, by ``verdict``.

    ``examples`` has ``verdict`` and ``symbols``. Counts are summed inside each task first.
    """
    padded = F.concat(F.lit(START * ORDER), "symbols")
    at = F.explode(F.sequence(F.lit(1), F.length("symbols")))
    windows = examples.select("verdict", padded.alias("padded"), at.alias("at")).select(
        "verdict", F.substring("padded", F.col("at"), F.lit(ORDER + 1)).alias("window"))
    return windows.groupBy("verdict", "window").agg(F.count(F.lit(1)).alias("n"))


def kept_contexts(counts: DataFrame) -> DataFrame:
    """``verdict``, ``context``, ``symbol`` and ``n`` of the contexts of all lengths that are kept."""
    total = counts.groupBy("verdict").agg(F.sum("n").alias("total"))
    length = F.explode(F.sequence(F.lit(0), F.lit(ORDER)))
    every = counts.select("verdict", "window", "n", length.alias("length")).select(
        "verdict", F.expr(f"substring(window, {ORDER} + 1 - length, length)").alias("context"),
        F.substring("window", ORDER + 1, 1).alias("symbol"), "n")
    followed = every.groupBy("verdict", "context", "symbol").agg(F.sum("n").alias("n"))
    seen = followed.groupBy("verdict", "context").agg(F.sum("n").alias("seen")).join(total, "verdict")
    kept = seen.where(F.col("seen") >= MIN_SHARE * F.col("total")).select("verdict", "context")
    return followed.join(kept, ["verdict", "context"])


class RatioModel:
    """Two models in one automaton over the contexts that either of them keeps.

    ``follow[state, symbol]`` is the longest kept context after a symbol, and ``gain[state, symbol]``
    the difference of the two log-chances. Without examples of one kind all gains of that model are
    those of equal chances.
    """

    def __init__(self, counts: list[tuple[str, str, str, int]]):
        number = {s: i for i, s in enumerate(SYMBOLS)}
        rows = {v: {} for v in (ALLOW, BLOCK)}
        for verdict, context, symbol, n in counts:
            row = rows[verdict].setdefault(context, np.zeros(len(SYMBOLS)))
            row[number[symbol]] += n
        contexts = sorted({"", *rows[ALLOW], *rows[BLOCK]}, key=lambda c: (len(c), c))
        state = {c: i for i, c in enumerate(contexts)}
        self.follow = np.zeros((len(contexts), len(SYMBOLS)), np.int32)
        self.gain = np.zeros((len(contexts), len(SYMBOLS)))
        chances = {v: np.empty((len(contexts), len(SYMBOLS))) for v in rows}
        for length, group in groupby(contexts, len):
            group = list(group)
            # contexts are closed under dropping the first or the last character; what a context
            # leads to is known once the next longer ones are, so these are linked to it first
            for context in group:
                if context and context[-1] in number:
                    self.follow[state[context[:-1]], number[context[-1]]] = state[context]
            for context in group if length else ():
                self.follow[state[context]] = self.follow[state[context[1:]]]
        for i, context in enumerate(contexts):
            for verdict, sign in ((ALLOW, 1), (BLOCK, -1)):
                row = rows[verdict].get(context)
                base = chances[verdict][state[context[1:]]] if context else np.full(len(SYMBOLS), 1 / len(SYMBOLS))
                if row is not None:
                    kinds = np.count_nonzero(row)
                    base = (row + kinds * base) / (row.sum() + kinds)
                chances[verdict][i] = base
                self.gain[i] += sign * np.log(base)
        self.start = max((i for c, i in state.items() if set(c) <= {START}), default=0)
        self.threshold = 0.0
        self.codes = np.zeros(128, np.int64)
        for symbol, i in number.items():
            self.codes[ord(symbol)] = i

    def scores(self, texts: list[str]) -> np.ndarray:
        """Score of each text of symbols; all texts go through the automaton side by side."""
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        starts, codes = (np.cumsum(lengths) - lengths)[order], self.codes[data]
        sorted_lengths = lengths[order]
        states, sums = np.full(len(texts), self.start, np.int32), np.zeros(len(texts))
        active = len(texts)
        for at in range(int(lengths.max(initial=0))):
            while active and sorted_lengths[active - 1] <= at:
                active -= 1
            symbol = codes[starts[:active] + at]
            sums[:active] += self.gain[states[:active], symbol]
            states[:active] = self.follow[states[:active], symbol]
        out = np.empty(len(texts))
        out[order] = sums / np.maximum(sorted_lengths, 1)
        return out


def with_scores(df: DataFrame, model: RatioModel, symbols: str = "symbols", out: str = "score") -> DataFrame:
    """``df`` with the score of each row."""
    worker, keep = shared(df.sparkSession, model), [f for f in df.schema if f.name != out]
    schema = T.StructType([*keep, T.StructField(out, T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = worker().scores(batch.column(batch.schema.get_field_index(symbols)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(f.name)) for f in keep] + [pa.array(found, pa.float64())],
                schema.names)

    return df.mapInArrow(scored, schema)


def best_threshold(scored: DataFrame) -> float:
    """The threshold that separates ``score`` by ``verdict`` best, the one nearest to zero of equals.

    Zero if there are no rows of one kind. What reaches the driver is one row for each bin.
    """
    bins = int(LIMIT / BIN)
    bin_of = F.greatest(F.lit(-bins), F.least(F.lit(bins - 1), F.floor(F.col("score") / BIN))).cast("int")
    rows = scored.groupBy(bin_of.alias("bin")).agg(
        F.count_if(F.col("verdict") == ALLOW).alias("allowed"),
        F.count_if(F.col("verdict") == BLOCK).alias("blocked")).collect()
    allowed, blocked = np.zeros(2 * bins), np.zeros(2 * bins)
    for r in rows:
        allowed[r["bin"] + bins], blocked[r["bin"] + bins] = r["allowed"], r["blocked"]
    if not allowed.sum() or not blocked.sum():
        return 0.0
    below = np.concatenate(([0.0], np.cumsum(blocked))) / blocked.sum()
    above = 1 - np.concatenate(([0.0], np.cumsum(allowed))) / allowed.sum()
    value = np.round(below + above, 12)
    edges = np.arange(-bins, bins + 1) * BIN
    best = np.flatnonzero(value == value.max())
    return float(edges[best[np.argmin(np.abs(edges[best]))]])


def fit(examples: DataFrame) -> RatioModel:
    """Models and threshold from ``verdict`` and ``symbols`` of URLs whose verdict is known.

    The folds are told by the symbols, so equal URLs are in one fold; a repeated row counts again.
    Only kept contexts (their number is bounded) and bins reach the driver.
    """
    held_out = remainder("symbols", FOLDS) == CALIBRATION
    counts = context_counts(examples.where(~held_out))
    kept = kept_contexts(stored(counts, "contexts")).collect()
    model = RatioModel([(r["verdict"], r["context"], r["symbol"], r["n"]) for r in kept])
    model.threshold = best_threshold(with_scores(examples.where(held_out), model))
    return model


def judge_urls(df: DataFrame, rules: list[Rule], url: str = "url", key: str = "page_id") -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of each row.

    ``rule`` is null where none fits; the verdict is then ``allow`` if the score reaches the model's
    threshold, else ``block``. A null URL counts as empty and has no host; an empty URL is scored by
    its end alone. Rows that are repeated are judged each; other columns are left out. If no rule
    fits any row, the models have no examples, all scores are zero and all rows allowed. An empty
    table gives an empty result.
    """
    parts = df.select(F.col(key), host_of(url).alias("host"), path_of(url).alias("path"), symbols_of(url).alias("symbols"))
    ruled = stored(parts.withColumn("by_rule", longest_rule("host", "path", rules)), "urls")
    model = fit(ruled.where("by_rule IS NOT NULL").select("by_rule.verdict", "symbols"))
    by_model = F.when(F.col("score") >= model.threshold, ALLOW).otherwise(BLOCK)
    return with_scores(ruled, model).select(
        key, "host", "path", F.col("by_rule.rule").alias("rule"),
        F.coalesce("by_rule.verdict", by_model).alias("verdict"), "score")
