"""Quality classifier: a sparse ensemble of rules over text statistics.

Trees of a small random forest are grown on labelled rows. The path to each of their nodes is a
rule: a conjunction of comparisons of statistics. A logistic regression with lasso penalty over the
rules as 0/1 columns gives most of them the weight zero. Those left are compiled into one Spark
column expression, so scoring reads a text once and needs no Python.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressflow.llm.support import BLANKS, stored, text_of

#: Labelled rows that the model is fitted on at most: those with the least hash of their id.
FIT_ROWS = 50_000
TREES, DEPTH, SEED = 24, 3, 7
#: Lasso penalty, and the decimals that scores are rounded to.
PENALTY = 0.0005
DECIMALS = 9


def statistics(text: str | Column) -> Column:
    """A struct of the statistics rules are made of; a null text counts as empty, with all at 0."""
    def of(value):
        words = F.filter(F.split(value, BLANKS), lambda w: w != "")

        def counts(words_):
            n_words, chars = F.greatest(F.size(words_), F.lit(1)), F.greatest(F.length(value), F.lit(1))

            def share(pattern, whole):
                return F.regexp_count(value, F.lit(pattern)) / whole

            return F.struct(
                F.log(F.size(words_) + 1.0).alias("log_words"),
                (F.length(value) / n_words).alias("word_length"),
                (F.size(F.array_distinct(words_)) / n_words).alias("distinct_words"),
                share(r"[#*$%&|<>]", n_words).alias("symbols"),
                share("!", n_words).alias("exclamations"),
                share(r"[.,]", n_words).alias("stops"),
                share(r"\p{Lu}", chars).alias("capitals"),
                share("[0-9]", chars).alias("digits"),
                share("\n", n_words).alias("lines"))

        return F.element_at(F.transform(F.array(words), counts), 1)

    return F.element_at(F.transform(F.array(text_of(text)), of), 1)


STATISTICS = ["log_words", "word_length", "distinct_words", "symbols", "exclamations", "stops",
              "capitals", "digits", "lines"]

#: A rule: comparisons of a statistic (its number) with a threshold; true means at most.
Rule = tuple[tuple[int, bool, float], ...]


def _paths(printed: str) -> list[Rule]:
    """The path to each node below the root of a tree as Spark prints it."""
    found, path = [], []
    for line in printed.splitlines():
        split = re.search(r"(If|Else) \(feature (\d+) (<=|>) ([-0-9.Ee]+)\)", line)
        if split:
            depth = len(line) - len(line.lstrip())
            path = [p for p in path if p[0] < depth]
            path.append((depth, (int(split[2]), split[3] == "<=", float(split[4]))))
            found.append(tuple(condition for _, condition in path))
    return found


def _simplified(rule: Rule) -> Rule:
    """One bound for each statistic and direction, in a fixed order."""
    bounds: dict[tuple[int, bool], float] = {}
    for which, at_most, threshold in rule:
        tighter = min if at_most else max
        bounds[which, at_most] = tighter(bounds.get((which, at_most), threshold), threshold)
    return tuple((which, at_most, t) for (which, at_most), t in sorted(bounds.items()))


def _holds(rule: Rule, stats: Column) -> Column:
    holds = F.lit(True)
    for which, at_most, threshold in rule:
        value = stats[STATISTICS[which]]
        holds = holds & (value <= threshold if at_most else value > threshold)
    return holds


@dataclass(frozen=True)
class RuleModel:
    """Rules with their weights; ``score`` is the compiled expression."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    @classmethod
    def fit(cls, labelled: DataFrame, *, fit_rows: int = FIT_ROWS) -> RuleModel:
        """Fit on rows with ``key`` (long), ``stats`` (struct) and ``label`` (0 or 1).

        Of more than ``fit_rows`` rows those with the least hash of the key are taken. Labels of
        one kind alone give a model without rules that always says so; without labels it is 0.5.
        """
        sample = labelled.where("label IS NOT NULL").orderBy(F.xxhash64("key"), "key").limit(fit_rows)
        sample = stored(sample.select("stats", F.col("label").cast("double").alias("label"))
                        .repartition(4), "labelled")
        kinds = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
        if len(kinds) < 2:
            return cls({0.0: -20.0, 1.0: 20.0}[next(iter(kinds))] if kinds else 0.0, ())
        vectors = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(
            sample.select("label", "stats.*"))
        forest = RandomForestClassifier(
            numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="0.5",
            minInstancesPerNode=5).fit(vectors)
        rules = sorted({_simplified(p) for tree in forest.trees for p in _paths(tree.toDebugString)})
        if not rules:
            share = kinds[1.0] / sum(kinds.values())
            import math

            return cls(math.log(share / (1 - share)), ())
        names = [f"rule_{i}" for i in range(len(rules))]
        flags = sample.select("label", *(
            _holds(rule, F.col("stats")).cast("double").alias(n) for n, rule in zip(names, rules, strict=True)))
        lasso = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, maxIter=60,
                                   standardization=False).fit(
            VectorAssembler(inputCols=names, outputCol="features").transform(flags))
        weights = lasso.coefficients.toArray().tolist()
        return cls(float(lasso.intercept),
                   tuple((r, w) for r, w in zip(rules, weights, strict=True) if w))

    def score(self, stats: Column) -> Column:
        """Probability of label 1 from a struct of statistics.

        The struct is bound to a variable of the expression: the rules look at it many times, and
        wherever the optimizer moves the expression, the statistics are made once for a row.
        """
        def compiled(bound: Column) -> Column:
            logit = F.lit(self.intercept)
            for rule, weight in self.rules:
                logit = logit + F.when(_holds(rule, bound), weight).otherwise(0.0)
            return F.round(1 / (1 + F.exp(-logit)), DECIMALS)

        return F.element_at(F.transform(F.array(stats), compiled), 1)


def labelled_statistics(df: DataFrame, labels: DataFrame, learnable: Column, doc_id: str = "doc_id",
                        label: str = "quality") -> DataFrame:
    """``key``, ``stats`` and ``label`` of the labelled rows that may be learned from.

    ``df`` has the id column and ``stats``. A row without id has no label; an id with several
    labels comes with each.
    """
    known = labels.where(F.col(label).isNotNull()).select(
        F.col(doc_id).alias("key"), F.col(label).alias("label"))
    return (df.where(learnable).select(F.col(doc_id).alias("key"), "stats").join(known, "key"))
